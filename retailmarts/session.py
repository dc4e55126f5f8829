"""Session settings and the shared scratch folder."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Instants are UTC everywhere.  Sums that overflow fail.  Joins are left to adaptive execution, which may split a hot key even
# where that costs one more shuffle further up (the second option).  The CSV reader must tokenise whole
# records: with column pruning it stops checking the number of fields.  A join to few of many rows, like that of items to
# delivered orders, drops most of the others by a Bloom filter before they are shuffled.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.csv.parser.columnPruning.enabled": "false",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "32MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "4GB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the jobs rely on to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def session(app: str = "retailmarts") -> SparkSession:
    """The active session, or a new one, with the settings applied."""
    return configure(SparkSession.builder.appName(app).getOrCreate())


# Spark keeps the files of a shuffle until the driver happens to collect its garbage.  A write runs once, so its own can go
# when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# A side of a lookup that has been measured to be below this is broadcast, so that the many rows are not shuffled.
_MEASURED, SMALL = "spark.sql.adaptive.autoBroadcastJoinThreshold", "100MB"

_LOCK, _USERS = threading.RLock(), {}


@contextmanager
def _set_while_used(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting that holds while anyone, of several threads, uses it; one that is set already stays."""
    mine = (id(spark), key)
    with _LOCK:
        users, before = _USERS.get(mine, (0, spark.conf.get(key, None)))
        _USERS[mine] = (users + 1, before)
        if before is None:
            spark.conf.set(key, value)
    try:
        yield
    finally:
        with _LOCK:
            users, before = _USERS.pop(mine)
            if users > 1:
                _USERS[mine] = (users - 1, before)
            elif before is None:
                spark.conf.unset(key)


@contextmanager
def write_once(spark: SparkSession) -> Iterator[None]:
    """A write within it leaves no shuffle files."""
    with _set_while_used(spark, _CLEANUP, "true"):
        yield


@contextmanager
def small_sides(spark: SparkSession) -> Iterator[None]:
    """Writes within it broadcast what they measure to be small, unless broadcasts are off."""
    if spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        yield
        return
    with _set_while_used(spark, _MEASURED, SMALL):
        yield


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, under the cluster's ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it is, if it exists."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
