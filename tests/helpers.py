from datetime import date, datetime

from pyspark.sql import functions as F


def ts(text):
    return datetime.fromisoformat(text)


def day(text):
    return date.fromisoformat(text)


def rows(frame, *columns, by=None):
    """Selected columns as sorted tuples, doubles to nine digits."""
    picked = frame.select(*columns) if columns else frame
    order = by or columns[: max(1, len(columns) - 1)]
    picked = picked.orderBy(*order)
    return [tuple(round(x, 9) if isinstance(x, float) else x for x in row) for row in picked.collect()]


def one(frame, column):
    (row,) = frame.select(column).collect()
    return row[0]


def ntz(column="init_time"):
    return F.col(column).cast("timestamp_ntz")


def executed(frame):
    """The physical plan before adaptive execution, outermost node first."""
    return frame._jdf.queryExecution().executedPlan().toString()
