"""Tables as snapshots: data files that are never changed, and manifests that say which of them count.

Every write puts its files under a token of its own, ``data/<partition>/_v=<token>/``, and then one manifest,
``manifests/<number>.json``, which must not exist yet: that single create is the commit.  The last whole
manifest is the table.  A write that dies leaves the old one in force, a reader keeps the files it has
planned with, and nothing is ever renamed or copied, which object stores could not do at once.  Of two
writers that start from the same snapshot, the second fails.  Partitions that a write does not touch keep
their files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from retailmarts.session import remove, write_once

TOKEN = "_v"
#: Snapshots whose files are kept.
KEEP = 3
#: Ids of hexadecimal digits take half the space of Spark's default, which finds repeats only.
CODEC = "zstd"


@dataclass
class Snapshot:
    """What one manifest says.  ``parts`` has the tokens of each partition, by its folder's name (``a=1/b=2``, ''
    if the table has no partitions); ``notes`` are the writer's own, ``rows`` is what the last write added."""

    number: int
    schema: StructType
    by: list[str]
    parts: dict[str, list[str]]
    notes: dict = field(default_factory=dict)


class ConcurrentWrite(RuntimeError):
    """Another writer has committed since this one looked."""


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _files(spark, path)
    return files.exists(where)


def _list(spark: SparkSession, pattern: str) -> list[str]:
    files, where = _files(spark, pattern)
    return [s.getPath().toString() for s in files.globStatus(where) or []]


def _manifest(path: str, number: int) -> str:
    return f"{path}/manifests/{number:012d}.json"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(f.rsplit("/", 1)[1].split(".")[0]) for f in _list(spark, f"{path}/manifests/*.json"))


def snapshot(spark: SparkSession, path: str, number: int | None = None) -> Snapshot | None:
    """The snapshot with that number, by default the last whole one; None if there is none.

    A manifest that its writer did not finish is no JSON, and the one before it counts."""
    for n in reversed(_numbers(spark, path)):
        if number is None or n == number:
            files, where = _files(spark, _manifest(path, n))
            stream = files.open(where)
            try:
                told = json.loads(bytes(stream.readAllBytes()).decode())
            except ValueError:
                continue
            finally:
                stream.close()
            return Snapshot(n, StructType.fromJson(told["schema"]), told["by"], told["parts"], told["notes"])
    return None


def _commit(spark: SparkSession, path: str, new: Snapshot) -> None:
    told = {"schema": new.schema.jsonValue(), "by": new.by, "parts": new.parts, "notes": new.notes}
    files, where = _files(spark, _manifest(path, new.number))
    try:
        stream = files.create(where, False)
    except Exception as error:
        if "FileAlreadyExists" in str(error):
            raise ConcurrentWrite(f"{path}: snapshot {new.number} exists") from error
        raise
    stream.write(bytearray(json.dumps(told).encode()))
    stream.close()


# The characters that Spark escapes in the names of partition folders, besides control characters.
_ESCAPED = "\"#%'*/:=?\\{[]^\x7f"


def partition(**values) -> str:
    """The name of a partition in ``Snapshot.parts``."""

    def shown(value) -> str:
        if value is None or value == "":
            return "__HIVE_DEFAULT_PARTITION__"
        return "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 else c for c in str(value))

    return "/".join(f"{name}={shown(value)}" for name, value in values.items())


def write(
    df: DataFrame, path: str, by: Iterable[str] = (), touched: Iterable[str] | None = None, add: Iterable[str] = (),
    notes: dict | None = None, keep: int | None = KEEP, options: dict | None = None,
) -> Snapshot:
    """Commit ``df`` as the next snapshot of the table at ``path``, partitioned by the columns ``by``.

    By default it replaces the table.  With ``touched``, a list of partitions, it replaces those only, also by
    nothing, and ``df`` must have no rows of others; partitions in ``add`` gain the rows instead.  Its
    rows are counted on the way (``notes['rows']``).  Files that only snapshots before the last ``keep`` name
    are deleted (None: never)."""
    spark, by, token, counted = df.sparkSession, list(by), uuid.uuid4().hex, Observation()
    before = snapshot(spark, path)
    number = max(_numbers(spark, path), default=0) + 1
    marked = df.observe(counted, F.count(F.lit(1)).alias("rows")).withColumn(TOKEN, F.lit(token))
    with write_once(spark):
        marked.write.mode("append").options(compression=CODEC, **(options or {})).partitionBy(*by, TOKEN).parquet(f"{path}/data")
    folders = _list(spark, f"{path}/data/{'*/' * len(by)}{TOKEN}={token}")
    written = {"/".join(f.split("/")[-1 - len(by):-1]) if by else "": [token] for f in folders}
    parts = written
    if touched is not None and before:
        replaced = set(touched)
        strange = set(written) - replaced - set(add)
        if strange:
            raise ValueError(f"{path}: rows of {sorted(strange)[:3]}, which are not to be replaced")
        parts = {p: t for p, t in before.parts.items() if p not in replaced}
        for p, t in written.items():
            parts[p] = [*parts.get(p, []), *t]
    new = Snapshot(number, df.schema, by, parts, {**(notes or {}), "rows": counted.get["rows"]})
    _commit(spark, path, new)
    if keep is not None:
        expire(spark, path, keep)
    return new


def scratch(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to a folder that its user removes, and read back."""
    with write_once(df.sparkSession):
        df.write.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, path: str, parts: Iterable[str] | None = None, number: int | None = None) -> DataFrame | None:
    """The table at ``path`` as of one snapshot, by default the last; None if there is none.

    ``parts`` names the partitions to read, by default all."""
    found = snapshot(spark, path, number)
    if found is None:
        return None
    files = _read(spark, path, found, found.parts if parts is None else parts)
    return files.select(found.schema.names)


def _read(spark: SparkSession, path: str, found: Snapshot, parts: Iterable[str]) -> DataFrame:
    """The files of some partitions, with their tokens."""
    wanted = {p: found.parts[p] for p in parts if p in found.parts}
    folders = [f"{path}/data/{_folder(p)}{TOKEN}={t}" for p, tokens in wanted.items() for t in tokens]
    schema = StructType([*found.schema.fields, StructField(TOKEN, StringType())])
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders)


def partition_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows per partition (its columns, ``n_rows``) from the files' footers alone: no page of data is read.

    Only Spark's newer file reader does so, and only for groups by all partition columns."""
    found = snapshot(spark, path)
    settings = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        counts = _read(spark, path, found, found.parts).groupBy(*found.by, TOKEN).agg(F.count(F.lit(1)).alias("n_rows"))
        whole = counts.groupBy(*found.by).agg(F.sum("n_rows").alias("n_rows"))
        whole._jdf.queryExecution().executedPlan()  # planned while the settings hold
        return whole
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _folder(part: str) -> str:
    return f"{part}/" if part else ""


def expire(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Forget all but the last ``keep`` snapshots, and delete the files that only they name."""
    numbers = _numbers(spark, path)
    old, kept = numbers[:-keep], numbers[-keep:]

    def named(ns: list[int]) -> set[str]:
        found = [s for n in ns if (s := snapshot(spark, path, n))]
        return {f"{_folder(p)}{TOKEN}={t}" for s in found for p, tokens in s.parts.items() for t in tokens}

    for folder in named(old) - named(kept):
        remove(spark, f"{path}/data/{folder}")
    for n in old:
        remove(spark, _manifest(path, n))
