"""Imports every module of queries."""

from . import audits, daily, events, matching, scans, scores, selection  # noqa: F401
from .base import QUERIES

FLAGSHIP = QUERIES.get("e0_brier_by_forecast_day")
