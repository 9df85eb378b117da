import hashlib
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from skillgrid.session import scratch_path
from skillgrid.sources import versions

SCHEMA = "day int, month string, v double"


def digests(path):
    files = Path(path).glob("data/version=*/*/*/*.parquet")
    return {str(f.relative_to(path)): hashlib.sha256(f.read_bytes()).hexdigest() for f in files}


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def stored(spark, path, number=None):
    return rows(versions.read_version(spark, path, number), "day", "month", "v", by=("day", "month", "v"))


OLD = [(1, "1995-01", 1.0), (1, "1995-02", 2.0), (2, "1995-01", 3.0), (2, "1995-01", 4.0)]


def test_only_touched_partitions_are_written(spark):
    path = scratch_path(spark, "versions")
    assert versions.replace_partitions(table(spark, OLD), path, ["day", "month"]) == 1
    before = digests(path)
    assert versions.upsert(table(spark, [(2, "1995-01", 9.0), (3, "1995-01", 5.0)]), path, ["day", "month"]) == 2
    after = digests(path)
    # Files that were there stay byte for byte; the new ones hold two partitions.
    assert {k: after[k] for k in before} == before
    assert {Path(k).parent.parent.name + "/" + Path(k).parent.name for k in after.keys() - before.keys()} == {"day=2/month=1995-01", "day=3/month=1995-01"}
    new = [(1, "1995-01", 1.0), (1, "1995-02", 2.0), (2, "1995-01", 9.0), (3, "1995-01", 5.0)]
    assert stored(spark, path) == new and stored(spark, path, 1) == OLD
    assert versions.read_version(spark, path).schema.simpleString() == "struct<day:int,month:string,v:double>"
    plan = versions.read_version(spark, path).where("day = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "(day#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_a_failed_write_leaves_the_old_version(spark):
    path = scratch_path(spark, "versions")
    versions.replace_partitions(table(spark, OLD), path, ["day"])
    bad = table(spark, [(2, "x", 1.0), (7, "x", 2.0)]).withColumn("v", F.when(F.col("day") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        versions.upsert(bad, path, ["day"])
    assert stored(spark, path) == OLD and versions.versions(spark, path) == [1]
    # A version file that its writer left unfinished counts as none, and its number is not used again.
    Path(path, "versions/0000000002.jsonl").write_text('{"schema": {}, "keys": ["day"]}\n{"partition": "day=1", "wri')
    assert stored(spark, path) == OLD and versions.versions(spark, path) == [1]
    assert versions.upsert(table(spark, [(9, "y", 1.0)]), path, ["day"]) == 3
    assert stored(spark, path) == [*OLD, (9, "y", 1.0)]


def test_two_writers_of_one_version(spark):
    path = scratch_path(spark, "versions")
    versions.replace_partitions(table(spark, OLD), path, ["day"])
    number, schema, keys, writes = versions._state(spark, path)
    versions.upsert(table(spark, [(1, "a", 8.0)]), path, ["day"])
    with pytest.raises(versions.VersionConflict):
        versions._publish(spark, path, number + 1, schema, keys, writes)


def test_nulls_odd_names_new_columns_and_no_rows(spark):
    path = scratch_path(spark, "versions")
    odd = spark.createDataFrame([("a/b=c %+", 1.0), (None, 2.0), ("", 3.0)], "k string, v double").where("k is null or k <> ''")
    versions.replace_partitions(odd, path, ["k"])
    wide = spark.createDataFrame([(None, 7.0, "new")], "k string, v double, w string")
    versions.upsert(wide, path, ["k"])
    out = versions.read_version(spark, path)
    assert {tuple(r) for r in out.collect()} == {("a/b=c %+", 1.0, None), (None, 7.0, "new")}
    assert versions.upsert(wide.where("false"), path, ["k"]) == 3
    assert versions.read_version(spark, path).count() == 2
    versions.drop_partitions(spark, path, "k = 'a/b=c %+'")
    assert [r.w for r in versions.read_version(spark, path).collect()] == ["new"]
    with pytest.raises(ValueError, match="double"):
        versions.upsert(spark.createDataFrame([("a", "x")], "k string, v string"), path, ["k"])
    with pytest.raises(ValueError, match="partitioned"):
        versions.upsert(wide, path, ["w"])
    versions.replace_partitions(wide.where("false"), path, ["k"], whole=True)
    assert versions.read_version(spark, path).count() == 0
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, scratch_path(spark, "none"))


def test_old_versions_can_be_dropped(spark):
    path = scratch_path(spark, "versions")
    for v in (1.0, 2.0, 3.0):
        versions.upsert(table(spark, [(1, "a", v), (int(v) + 1, "a", v)]), path, ["day"])
    want = stored(spark, path)
    assert versions.keep_versions(spark, path, 2) == []
    assert stored(spark, path, 2)[0] == (1, "a", 2.0)
    versions.replace_partitions(table(spark, [(1, "a", 4.0)]), path, ["day"], whole=True)
    assert len(versions.keep_versions(spark, path, 1)) == 3
    assert versions.versions(spark, path) == [4] and stored(spark, path) == [(1, "a", 4.0)] and len(want) == 4
