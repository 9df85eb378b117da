"""Sums and means of doubles that do not depend on the order in which rows are added.

A double is cut into two whole numbers, the part down to 2**-20 and the rest down to 2**-62; bits below that are
dropped from each value. Whole numbers add up exactly in any order, so a total that is compared with a limit is the same for
every number of partitions. It is the double nearest to the exact sum. Values are finite; a sum of more than two
million rows, or beyond 2**43, overflows and stops the job rather than give another number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

COARSE_BITS, FINE_BITS = 20, 42
COARSE, FINE = float(1 << COARSE_BITS), float(1 << FINE_BITS)


def parts(value: Column) -> tuple[Column, Column]:
    """The two whole numbers of a value; both add up."""
    scaled = value.cast("double") * COARSE
    coarse = F.floor(scaled)
    return coarse, ((scaled - coarse) * FINE).cast("bigint")


def joined(coarse: Column, fine: Column) -> Column:
    """The double nearest to a sum of parts, rounded in one addition of two exact doubles."""
    carry = F.shiftright(fine, FINE_BITS)
    return (coarse + carry) / F.lit(COARSE) + (fine - F.shiftleft(carry, FINE_BITS)) / F.lit(COARSE * FINE)


def exact_sum(value: Column | str) -> Column:
    """Sum of a group; NULL without values."""
    coarse, fine = parts(F.col(value) if isinstance(value, str) else value)
    return joined(F.sum(coarse), F.sum(fine))


def exact_mean(value: Column | str) -> Column:
    """Mean of a group; NULL without values."""
    return F.try_divide(exact_sum(value), F.count(value))


def named(value: Column, body: Callable[[Column], Column]) -> Column:
    """An expression that uses a value several times and evaluates it once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _high(value: Column) -> Column:
    """The upper 26 bits of a double; products of such halves are exact."""
    scaled = value * 134217729.0
    return scaled - (scaled - value)


def fused(a: Column, b: Column, c: Column) -> Column:
    """``a * b + c`` of doubles below 1e290, with the product's rounding error added back before the sum is rounded."""
    given = F.struct(a.alias("a"), b.alias("b"), c.alias("c"), (a * b).alias("product"), _high(a).alias("a_high"), _high(b).alias("b_high"))

    def parts(x: Column) -> Column:
        a_low, b_low = x["a"] - x["a_high"], x["b"] - x["b_high"]
        error = a_low * b_low - (((x["product"] - x["a_high"] * x["b_high"]) - a_low * x["b_high"]) - x["a_high"] * b_low)
        return F.struct(x["product"], x["c"], error.alias("error"), (x["product"] + x["c"]).alias("total"))

    def rounded(x: Column) -> Column:
        added = x["total"] - x["product"]
        rest = (x["product"] - (x["total"] - added)) + (x["c"] - added)
        return x["total"] + (rest + x["error"])

    return named(named(given, parts), rounded)
