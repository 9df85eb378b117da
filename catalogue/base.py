"""Registration of queries and a common output form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Moves exact ties at the seventh decimal off the rounding edge, in both engines alike.
NUDGE = 3e-10


def comparable(frame: DataFrame) -> DataFrame:
    """Doubles to six decimals, whole numbers as bigint, dates and times as text."""
    out = []
    for f in frame.schema:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind in ("double", "float"):
            c = F.round(c.cast("double") + NUDGE, 6)
        elif kind in ("byte", "short", "integer", "long"):
            c = c.cast("bigint")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return frame.select(*out)


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its check where SQL can express it."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: comparable(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return fn

    return add


def r(expr: str, name: str | None = None) -> str:
    return f"round(CAST({expr} AS DOUBLE)+{NUDGE},6)+0.0 AS {name or expr}"


def n(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {name or expr}"


def d(expr: str, name: str | None = None) -> str:
    return f"strftime({expr},'%Y-%m-%d') AS {name or expr}"


def t(expr: str, name: str | None = None) -> str:
    return f"strftime({expr},'%Y-%m-%d %H:%M:%S') AS {name or expr}"


CELL = "latitude, longitude"
