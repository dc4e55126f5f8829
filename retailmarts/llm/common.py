"""Helpers shared by the corpus operators: settings, scratch tables and global prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from retailmarts.session import configure, shared_dir

#: A word of the contracts: a run of anything but the six ASCII white space characters.
SPACES = "\t\n\x0b\x0c\r "
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of one Arrow batch: texts are long, so batches are short.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """The settings of the library, and Arrow batches that fit in a Python worker."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


class Scratch:
    """Tables of one run in the shared folder.  A saved table cuts the lineage: a lost executor costs
    the tasks since the last saved table only, and every reader sees the same rows."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.root, self.count = spark, shared_dir(spark, purpose), 0

    def save(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Delete a saved table that nothing reads any more."""
        jvm = self.spark._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, whatever the optimiser inlines."""
    return F.transform(F.array(value), use)[0]


def word_count(text: str | Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def local_sums(values: list[str]):
    """A mapInPandas function: adds ``_pid`` and, for each value, ``_local_<value>``, its sum over the
    earlier rows of the partition.  Only one batch and the running numbers are in memory."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid, before = TaskContext.get().partitionId(), dict.fromkeys(values, 0)
        for pdf in batches:
            if len(pdf):
                more: dict[str, object] = {"_pid": pid}
                for v in values:
                    numbers = pdf[v].to_numpy(np.int64)
                    ends = before[v] + np.cumsum(numbers)
                    more[f"_local_{v}"], before[v] = ends - numbers, int(ends[-1])
                yield pdf.assign(**more)

    return add


def partition_starts(saved: DataFrame, values: list[str]) -> DataFrame:
    """The totals of the partitions that precede: ``_pid``, ``_start_<value>``.  One row per task of the
    job that wrote ``saved``, which bounds the window here and the broadcast of the result."""
    totals = saved.groupBy("_pid").agg(*[F.sum(v).alias(f"_total_{v}") for v in values])
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_pid", *[
        F.coalesce(F.sum(f"_total_{v}").over(earlier), F.lit(0)).alias(f"_start_{v}") for v in values
    ])


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, str], scratch: Scratch) -> DataFrame:
    """Add each name of ``sums``: the sum of its value over all rows that precede in ``order``, over the
    whole table.

    Range partitioning spreads the rows whatever their keys; each task adds up its own rows and the
    totals of the tasks, one row each, give the rest.  Saved once, so both passes see one layout.
    """
    values = list(dict.fromkeys(sums.values()))
    schema = StructType(
        [*df.schema, StructField("_pid", IntegerType()), *[StructField(f"_local_{v}", LongType()) for v in values]]
    )
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    saved = scratch.save(ordered.mapInPandas(local_sums(values), schema))
    return saved.join(F.broadcast(partition_starts(saved, values)), "_pid").select(
        *df.columns, *[(F.col(f"_local_{v}") + F.col(f"_start_{v}")).alias(name) for name, v in sums.items()]
    )


def spread_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on ``on`` and its hash.  A side that was aggregated by ``on`` is then shuffled for the join,
    as is the other, and adaptive execution can split a hot key of either."""
    mark = F.xxhash64(*on)
    joined = left.withColumn("_mark", mark).join(right.withColumn("_mark", mark), [*on, "_mark"], how)
    return joined.drop("_mark")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of ``edges`` (a, b): (node, component), the component being its smallest
    node.  Nodes without an edge to another node are left out.

    Alternates the large and the small star: each node's larger neighbours, then its smaller ones, are
    hung under its smallest neighbour.  Both steps are aggregations and joins, so a node with millions of
    neighbours is spread like any other key; each round is saved, the number of rounds is logarithmic.
    """
    links = scratch.save(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while True:
        parents = links.groupBy("a").agg(F.count("*").alias("n"))
        unfinished = parents.where("n > 1").limit(1).count() or links.join(
            links.select(F.col("b").alias("a")).distinct(), "a", "left_semi"
        ).limit(1).count()
        if not unfinished:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = spread_join(both, least, ["a"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.save(large.where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = spread_join(large, least, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, links = links, scratch.save(
            small.where("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        )
        scratch.drop(before)
        scratch.drop(large)
