"""Operators for large training corpora, and their registered queries (``queries``)."""
