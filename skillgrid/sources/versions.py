"""Tables whose partitions are replaced one by one, each change a new version.

Layout: ``data/version=<id>/<keys>/`` holds the files of one write, ``versions/<number>.jsonl`` says which
write each partition is read from. A change writes its partitions beside the old ones and then its version
file, so files of other partitions stay as they are, readers see the old version until the new one is
complete, and a write that fails leaves only files that no version names. A version file has one line per
partition, which is what Spark lists for a partitioned table anyway; no row passes the driver.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .sinks import _laid_out, remove


class VersionConflict(RuntimeError):
    """Another writer published the version first; apply the change again to the newest one."""


def _files(spark: SparkSession, pattern: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [str(status.getPath().toString()) for status in fs.globStatus(path) or []]


def _lines(spark: SparkSession, number: int, path: str) -> list[dict]:
    """Lines of a version file, none if its writer was lost before the last one."""
    text = "".join(row.value for row in spark.read.text(_version_file(path, number), wholetext=True).collect())
    lines = [json.loads(line) for line in text.splitlines() if line.endswith("}")]
    return lines if lines and "end" in lines[-1] else []


def _version_file(path: str, number: int) -> str:
    return f"{path}/versions/{number:010d}.jsonl"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(f.rsplit("/", 1)[1].split(".")[0]) for f in _files(spark, f"{path}/versions/*.jsonl"))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions, oldest first."""
    return [x for x in _numbers(spark, path) if _lines(spark, x, path)]


def _state(spark: SparkSession, path: str, number: int | None = None):
    """Version number, schema, keys and the write of each partition."""
    for candidate in [number] if number is not None else reversed(_numbers(spark, path)):
        lines = _lines(spark, candidate, path)
        if lines:
            head = lines[0]
            return candidate, StructType.fromJson(head["schema"]), head["keys"], {x["partition"]: x["write"] for x in lines[1:-1]}
    if number is not None:
        raise FileNotFoundError(f"{path} has no version {number}")
    return None, None, None, {}


def _publish(spark: SparkSession, path: str, number: int, schema: StructType, keys: list[str], writes: dict[str, str]) -> None:
    """Create the version file; creation fails if another writer took the number."""
    lines = [{"schema": schema.jsonValue(), "keys": keys}]
    lines += [{"partition": p, "write": w} for p, w in sorted(writes.items())]
    lines.append({"end": len(writes)})
    target = spark._jvm.org.apache.hadoop.fs.Path(_version_file(path, number))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target):
        raise VersionConflict(f"version {number} of {path} exists")
    try:
        out = fs.create(target, False)
    except Exception as error:
        if fs.exists(target):
            raise VersionConflict(f"version {number} of {path} exists") from error
        raise
    out.write(bytearray("\n".join(json.dumps(x) for x in lines).encode()))
    out.close()


def _merged(old: StructType | None, new: StructType) -> StructType:
    """Columns of both; one that changes its type is refused."""
    if old is None:
        return new
    fields = {f.name: f for f in old.fields}
    for f in new.fields:
        if f.name in fields and fields[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} is {fields[f.name].dataType.simpleString()} in the table, {f.dataType.simpleString()} in the rows")
        fields.setdefault(f.name, f)
    return StructType(list(fields.values()))


def _check_keys(schema: StructType, keys: list[str], known: list[str] | None) -> None:
    missing = [k for k in keys if k not in schema.names]
    if missing or not keys:
        raise ValueError(f"keys {keys} are not all columns of the rows")
    if known is not None and known != keys:
        raise ValueError(f"the table is partitioned by {known}, not {keys}")


def replace_partitions(frame: DataFrame, path: str, keys: list[str], whole: bool = False) -> int:
    """Replace exactly the partitions that the rows belong to; returns the new version's number.

    With ``whole`` the rows become the whole table. Rows without a key value form a partition of their own.
    No rows: a version equal to the last one (or an empty table with ``whole``).
    """
    spark = frame.sparkSession
    before, schema, known, writes = _state(spark, path)
    _check_keys(frame.schema, keys, known)
    schema = _merged(None if whole else schema, frame.schema)
    taken = _numbers(spark, path)
    write = uuid.uuid4().hex
    folder = f"{path}/data/version={write}"
    _laid_out(frame, keys).write.partitionBy(*keys).parquet(folder)
    found = _files(spark, f"{folder}/" + "/".join(f"{k}=*" for k in keys))
    touched = {"/".join(f.rsplit("/", len(keys))[1:]): write for f in found}
    number = (taken[-1] if taken else 0) + 1
    _publish(spark, path, number, schema, keys, {**({} if whole else writes), **touched})
    return number


def drop_partitions(spark: SparkSession, path: str, condition) -> int:
    """A version without the partitions whose keys meet the condition; no file is read or written."""
    _, schema, keys, writes = _state(spark, path)
    if keys is None:
        raise FileNotFoundError(f"{path} has no version")
    types = {f.name: f.dataType for f in schema.fields}
    parts = spark.createDataFrame([(p,) for p in writes] or [], "partition string")
    segments = F.split("partition", "/")
    values = {}
    for i, k in enumerate(keys):
        text = F.url_decode(F.replace(F.substring_index(F.element_at(segments, i + 1), "=", -1), F.lit("+"), F.lit("%2B")))
        values[k] = F.when(text != "__HIVE_DEFAULT_PARTITION__", text).cast(types[k])
    gone = {row.partition for row in parts.withColumns(values).where(condition).select("partition").collect()}
    number = _numbers(spark, path)[-1] + 1
    _publish(spark, path, number, schema, keys, {p: w for p, w in writes.items() if p not in gone})
    return number


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The newest version of a table, or an older one; filters on keys prune partitions."""
    found, schema, _, writes = _state(spark, path, number)
    if found is None:
        raise FileNotFoundError(f"{path} has no version")
    if not writes:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/data/version={w}/{p}" for p, w in sorted(writes.items())]
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)


def upsert(frame: DataFrame, path: str, keys: list[str]) -> int:
    """Rows of new key values are added, those of known ones replace what the table holds (see ``replace_partitions``)."""
    return replace_partitions(frame, path, keys)


def keep_versions(spark: SparkSession, path: str, count: int = 1) -> list[str]:
    """Drop all but the newest ``count`` versions and the writes that none of them names; returns those writes.

    Not beside a running writer: its files are named by no version yet.
    """
    if count < 1:
        raise ValueError("at least one version stays")
    kept = versions(spark, path)[-count:]
    named = {w for x in kept for w in _state(spark, path, x)[3].values()}
    for x in _numbers(spark, path):
        if kept and x < kept[0]:
            remove(spark, _version_file(path, x))
    stale = [f for f in _files(spark, f"{path}/data/version=*") if f.rsplit("=", 1)[1] not in named]
    for f in stale:
        remove(spark, f)
    return [f.rsplit("=", 1)[1] for f in stale]
