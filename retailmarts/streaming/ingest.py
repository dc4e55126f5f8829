"""Files arriving in a landing folder → an append-only log, and the table's current state.

A delivery is what lies under one name in the landing folder: a file, or a folder of part files.  Arrival
is at least once: files may come again under another name.  The stream's checkpoint and the file sink's
log make every file count once.  A second stream merges what is new in the log into the state: one row
per file that came, and the current rows in hash buckets of their keys, of which a batch rewrites those that
it has keys of.  Both are snapshots that name the batch they include, so a replayed batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailmarts.functions import columns
from retailmarts.sources import raw, snapshots
from retailmarts.sources.layers import MONTH
from retailmarts.sources.schemas import DECIMAL, INSTANT, RAW, TEXT, WHOLE

ARRIVED = "arrived_at"
FILE = "arrived_from"
DELIVERY = "arrived_with"

# The state: rows with the time of their delivery and their bucket; rows without a key are in bucket -1.
WHEN = "delivered_at"
BUCKET = "key_bucket"
#: Buckets of a new state.  One is rewritten as a whole: let it have about a gigabyte.
BUCKETS = 32
#: Shares of a bucket, each in one task and one file.
_SPREAD = 16
#: While rows are shuffled, the number of their file and that of its delivery stand for the names.
_FILE, _NTH, _SHARE = "_file", "_nth", "_share"
#: As many files that came are broadcast, not shuffled with the rows.
_FEW = 200_000

_STORED = {TEXT: "string", WHOLE: "bigint", DECIMAL: "double", INSTANT: "timestamp"}


def _delivery(spark: SparkSession, landing: str) -> str:
    """The path of a file as far as the first name below the landing folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(landing)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().getPath()
    names = len([n for n in whole.split("/") if n]) + 1
    below = "regexp_replace(_metadata.file_path, '^[A-Za-z][^:/]*:(//[^/]*)?', '')"
    return f"substring_index({below}, '/', {names + 1})"


def ingest(
    spark: SparkSession, table: str, landing: str, target: str, checkpoint: str, header: bool = True,
    files_per_batch: int = 10_000, buckets: int = BUCKETS,
) -> None:
    """Parse all files that are new since the last run, append them to the log ``target`` and bring the
    state up to date.

    A backlog is worked off in batches of files, so that a lost batch costs little.  ``buckets`` counts when
    a state is first written.
    """
    spec = RAW[table]
    origin = (
        f"_metadata.file_modification_time AS {ARRIVED}", f"_metadata.file_path AS {FILE}",
        f"{_delivery(spark, landing)} AS {DELIVERY}",
    )
    records = raw.scan_stream(spark, table, landing, header, files_per_batch, keep=origin)
    rows = raw.parse(records, table, keep=(ARRIVED, FILE, DELIVERY))
    if spec.month_of:
        rows = rows.withColumn(MONTH, F.date_format(spec.month_of, "yyyy-MM"))
    writer = rows.writeStream.format("parquet").option("compression", snapshots.CODEC).outputMode("append")
    (
        (writer.partitionBy(MONTH) if spec.month_of else writer)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    if snapshots.exists(spark, target):
        settle(spark, table, target, f"{checkpoint}__state", buckets)


def settle(spark: SparkSession, table: str, target: str, checkpoint: str, buckets: int = BUCKETS) -> None:
    """Merge what is new in the log into the state."""
    log = spark.readStream.schema(_log_schema(table)).parquet(target)
    (
        log.writeStream
        .foreachBatch(lambda batch, n: merge(table, target, batch, n, buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _log_schema(table: str) -> str:
    stored = {n: _STORED[t] for n, t in RAW[table].columns.items()}
    stored |= {ARRIVED: "timestamp", FILE: "string", DELIVERY: "string"}
    return ", ".join(f"{n} {t}" for n, t in stored.items())


def _arrived(spark: SparkSession, table: str, target: str) -> DataFrame:
    """All rows that came.  In tables written before deliveries were noted, each file is one."""
    return _whole(spark.read.schema(_log_schema(table)).parquet(target), table)


def _whole(rows: DataFrame, table: str) -> DataFrame:
    return rows.select(*RAW[table].names, ARRIVED, FILE, F.coalesce(DELIVERY, FILE).alias(DELIVERY))


def _contents(arrived: DataFrame, table: str) -> DataFrame:
    """One row per file: when it came, its number of rows and two sums of their hashes."""
    content = f"struct({', '.join(RAW[table].names)})"
    return arrived.groupBy(DELIVERY, FILE).agg(*columns(
        _at=f"min({ARRIVED})", _rows="count(*)", _a=f"bit_xor(xxhash64({content}))",
        _b=f"sum(pmod(xxhash64('b', {content}), 4294967296L))",
    ))


def _files(contents: DataFrame) -> DataFrame:
    """The files with the time of their delivery, and the first and the last delivery before it with a file of
    this content.  Equal files of one delivery are compared with as many of another."""
    timed = contents.select("*", *columns(
        _when=f"min(_at) OVER (PARTITION BY {DELIVERY})",
        _copy=f"row_number() OVER (PARTITION BY {DELIVERY}, _rows, _a, _b ORDER BY {FILE})",
    ))
    alike = f"(PARTITION BY _rows, _a, _b, _copy ORDER BY _when, {DELIVERY})"
    return timed.select("*", *columns(
        _first=f"first_value({DELIVERY}) OVER {alike}", _before=f"lag({DELIVERY}) OVER {alike}",
    )).withColumn("_new", F.col("_before").isNull())


def _deliveries(files: DataFrame) -> DataFrame:
    """One row per delivery: whether it repeats a whole earlier delivery, however that was cut into files,
    and whether it has nothing but some files of one."""
    sums = files.groupBy(DELIVERY).agg(*columns(
        _when="min(_when)", _n="sum(_rows)", _x="bit_xor(_a)", _y="sum(CAST(_b AS DECIMAL(20, 0)))",
        _of_one="NOT bool_or(_new) AND (min(_first) = max(_first) OR min(_before) = max(_before))",
    ))
    first = f"first_value({DELIVERY}) OVER (PARTITION BY _n, _x, _y ORDER BY _when, {DELIVERY})"
    return sums.select("*", *columns(_again=f"{first} <> {DELIVERY}")).select(
        DELIVERY, "_when", "_again", *columns(_part="_of_one AND NOT _again")
    )


def _known(table: str) -> str:
    """Whether a row has its key."""
    return " AND ".join([f"coalesce(string({k}), '') <> ''" for k in RAW[table].key] or ["false"])


def _latest(keyed: DataFrame, table: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Of each key the rows of the last delivery that has it.  Rows that lie by ``by``, columns that follow from
    the key, are not shuffled again."""
    nth = F.col(_NTH) if _NTH in keyed.columns else F.struct(WHEN, DELIVERY)
    last = F.max(nth).over(Window.partitionBy(*by, *RAW[table].key))
    return keyed.withColumn("_last", last).where(nth == F.col("_last")).drop("_last")


def _told(files: DataFrame) -> DataFrame:
    """One row per file that came: its number, that of its delivery by time, and what counts of it."""
    of_delivery = _deliveries(files).select(DELIVERY, "_part", "_again")
    return files.join(of_delivery, DELIVERY).select(DELIVERY, FILE, "_new", "_part", "_again", *columns(**{
        WHEN: "_when", _FILE: f"row_number() OVER (ORDER BY _when, {DELIVERY}, {FILE})",
        _NTH: f"dense_rank() OVER (ORDER BY _when, {DELIVERY})",
    }))


def _counting(arrived: DataFrame, files: DataFrame, table: str) -> tuple[DataFrame | None, DataFrame]:
    """The rows of ``arrived`` that can count, given all ``files`` so far: those with a key (None if the table
    has none), with the time of their delivery, and those without."""
    return _that_count(arrived, _told(files), table)


def _that_count(arrived: DataFrame, told: DataFrame, table: str) -> tuple[DataFrame | None, DataFrame]:
    rest = arrived.where(f"NOT ({_known(table)})").join(told.where("_new AND NOT _again"), [DELIVERY, FILE])
    if not RAW[table].key:
        return None, rest
    return arrived.where(_known(table)).join(told.where("NOT _part"), [DELIVERY, FILE]), rest


def _bucketed(rows: DataFrame, table: str, buckets: int | None) -> DataFrame:
    """Rows with their bucket and their share of it; None for rows without a key."""
    key, names = RAW[table].key, RAW[table].names
    bucket = F.lit(-1) if buckets is None else F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
    share = F.xxhash64(*names, _FILE) if buckets is None else F.xxhash64(F.lit("share"), *key)
    return rows.select(*names, _FILE, _NTH, bucket.alias(BUCKET), F.pmod(share, F.lit(_SPREAD)).cast("int").alias(_SHARE))


def state_path(target: str) -> str:
    """Where the state of the log ``target`` is."""
    return f"{target}__state"


def _paths(target: str) -> tuple[str, str]:
    return f"{target}__files", state_path(target)


def merge(table: str, target: str, batch: DataFrame, number: int, buckets: int = BUCKETS) -> None:
    """Bring the state up to batch ``number`` of the log; one that it includes already changes nothing.

    Rows of a key that the batch has are compared with those of its bucket alone.  That settles all, unless
    a file came late: where it changes the time or the standing of an earlier delivery, or of its files, the
    state is derived from the whole log again.
    """
    spark, (files_at, state_at) = batch.sparkSession, _paths(target)
    state = snapshots.snapshot(spark, state_at)
    if state and state.notes["batch"] >= number:
        return
    buckets = state.notes["buckets"] if state else buckets
    arrived = _whole(batch, table)
    came = _contents(arrived, table)
    before = snapshots.read(spark, files_at, number=state.notes["files"]) if state else None
    if before is not None:
        came = before.unionByName(came).groupBy(DELIVERY, FILE).agg(*columns(
            _at="min(_at)", _rows="sum(_rows)", _a="bit_xor(_a)", _b="sum(_b)",
        ))
    written = snapshots.write(came, files_at, keep=None)
    files = _files(snapshots.read(spark, files_at, number=written.number))
    whole = before is None or _moved(_files(before), files)
    told = _told(files)
    if written.notes["rows"] <= _FEW:
        told = F.broadcast(told)
    # Of the log only what the files table has, as the join sees to: later batches come later.
    keyed, rest = _that_count(_arrived(spark, table, target) if whole else arrived, told, table)
    notes = {"batch": number, "buckets": buckets, "files": written.number}
    bare = snapshots.partition(**{BUCKET: -1})
    rows, touched = _bucketed(rest, table, None).repartition(BUCKET, _SHARE), []
    if keyed is not None:
        dealt = _bucketed(keyed, table, buckets)
        if not whole:
            touched = [
                snapshots.partition(**{BUCKET: r[0]}) for r in dealt.select(BUCKET).distinct().collect()  # buckets at most
            ]
            held = snapshots.read(spark, state_at, touched).drop(WHEN).join(told, [DELIVERY, FILE])
            dealt = dealt.unionByName(_bucketed(held, table, buckets))
        rows = rows.unionByName(_latest(dealt.repartition(BUCKET, _SHARE), table, (BUCKET, _SHARE)))
    rows = rows.join(told.select(_FILE, FILE, DELIVERY, WHEN), _FILE).select(*RAW[table].names, FILE, DELIVERY, WHEN, BUCKET)
    if whole:
        snapshots.write(rows, state_at, [BUCKET], notes=notes)
    else:
        snapshots.write(rows, state_at, [BUCKET], touched=touched, add=[bare], notes=notes)
    snapshots.expire(spark, files_at)


def _moved(before: DataFrame, after: DataFrame) -> bool:
    """Whether what was known of the earlier files and deliveries has changed."""
    told = [DELIVERY, FILE, "_at", "_rows", "_a", "_b", "_when", "_new"]
    if before.select(told).exceptAll(after.select(told)).head(1):
        return True
    return bool(_deliveries(before).select(DELIVERY, "_when", "_again", "_part").exceptAll(
        _deliveries(after).select(DELIVERY, "_when", "_again", "_part")
    ).head(1))


def current(spark: SparkSession, table: str, target: str) -> DataFrame:
    """What the arrived files say by now.

    A key's rows are those of the last delivery that has it, all of them, whatever files they are in: a key
    need not be unique.  A delivery of nothing but some files of an earlier one updates no key.  Rows with a
    NULL or blank key, and those of a table without one, stay as often as they came, but for files and
    deliveries that repeat the content of an earlier delivery's.  The state is read as it is; a log without
    one is settled on the way.
    """
    names = RAW[table].names
    settled = snapshots.read(spark, _paths(target)[1])
    if settled is not None:
        return settled.select(names)
    arrived = _arrived(spark, table, target)
    keyed, rest = _counting(arrived, _files(_contents(arrived, table)), table)
    rest = rest.select(names)
    return rest if keyed is None else _latest(keyed, table).select(names).unionByName(rest)
