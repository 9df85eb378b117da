"""Small tables with every hazard, and plain versions to compare with."""

import random
import re

from skillgrid.llm.common import ship_package

CLASHING = {"score": 1.5, "node": "n", "t": "t", "class": 3, "_r": "r", "part": 1, "x": 0, "label": "l", "n": 2, "_found": 4, "_match": "m", "_lang": 5, "_toxic": 6, "_pii": 7, "_more": 8}


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def table(spark, rows, schema="doc_id bigint, text string"):
    """Rows with extra columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    ship_package(spark)
    frame = spark.createDataFrame(rows, schema)
    return frame.select("*", *[F.lit(v).alias(k) for k, v in CLASHING.items() if k not in frame.columns])


def hard_texts():
    """(id, text): null id, null and empty texts, ties, repeated rows, a very long text, odd characters."""
    base = prose(1, 60)
    return [
        (1, base), (2, base), (2, base), (3, base.replace("w", "W", 2)), (4, None), (5, ""), (6, "  \n\t "), (7, "one two"),
        (None, base), (8, prose(2, 60_000, 5000)), (9, "x" * 300_000), (10, "Ünïcode ñandú — “quoted” 北京 \x1c\x85 \u00a0 e\u0301 İstanbul"),
        (11, "a <|endoftext|> b  c\n\n d\t e   f"), (12, base + " more words here"), (13, "..."), (14, base + " " + prose(3, 40)),
    ]


def word_grams(text, n=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def components_of(sets, percent=85):
    """Smallest key reachable by links, from all pairs."""
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: root(k) for k in sets}
