"""Places and neighbours on an axis laid out over partitions."""

import bisect
import random

import pytest
from helpers import executed, rows
from pyspark.sql import functions as F

from skillgrid.operators import audit, axis, regrid


def doubles(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double")


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_neighbours_are_those_of_a_sorted_list(spark, partitions):
    rng = random.Random(partitions)
    points = sorted({round(rng.uniform(-90, 90), 2) for _ in range(300)} | {0.0, 1e-9})
    asked = sorted({round(rng.uniform(-100, 100), 1) for _ in range(200)} | set(points[::20]))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = {r.t: (r.lo, r.hi) for r in axis.neighbours(doubles(spark, points), doubles(spark, asked)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = {}
    for t in asked:
        i, j = bisect.bisect_right(points, t), bisect.bisect_left(points, t)
        want[t] = (points[i - 1] if i else None, points[j] if j < len(points) else None)
    assert got == want


def test_no_points_and_nothing_asked(spark):
    assert axis.neighbours(doubles(spark, []), doubles(spark, [1.0])).collect() == [(1.0, None, None)]
    assert axis.neighbours(doubles(spark, [1.0]), doubles(spark, [])).count() == 0


def test_places_are_those_of_the_distinct_values(spark):
    values = [random.Random(3).randrange(50) for _ in range(400)]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int")
    want = [(v, k, len(set(values))) for k, v in enumerate(sorted(set(values)))]
    assert rows(axis.numbered(frame, "v"), "v", "idx", "size") == want


def test_ends_and_middle(spark):
    pick = lambda values: [r.v for r in audit._ends_and_middle(spark.createDataFrame([(v,) for v in values], "v int"), "v").orderBy("v").collect()]
    assert pick(range(10)) == [0, 5, 9] and pick([3, 3]) == [3] and pick([1, 2]) == [1, 2]


def test_no_axis_is_gathered(spark):
    cells = spark.createDataFrame([(float(a), float(b), float(a + b)) for a in range(5) for b in range(5)], "latitude double, longitude double, value double")
    for method in ("linear", "nearest"):
        assert "collect_list" not in executed(regrid.axis_weights(cells, cells, "latitude", method))
    half = cells.withColumns({"latitude": F.col("latitude") / 2, "longitude": F.col("longitude") / 2})
    got = {(r.latitude, r.longitude): r.value for r in regrid.to_grid(cells, half).collect()}
    assert got == {(a / 2, b / 2): (a + b) / 2 for a in range(5) for b in range(5)}
