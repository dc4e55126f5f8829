"""Table layers (raw, staging, mart): where tables live, how they are written and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailmarts.functions import columns
from retailmarts.sources import snapshots

DEFAULT_LAYER = "staging"
MONTH = "order_month"


def layer_name(layer: str | None = None) -> str:
    """A model goes to exactly the layer it names, otherwise to the default layer."""
    return DEFAULT_LAYER if layer is None else layer.strip()


def table_path(root: str, layer: str | None, table: str) -> str:
    return f"{root.rstrip('/')}/{layer_name(layer)}/{table}"


Order = tuple[tuple[str, bool], ...]  # columns and whether the largest come first


def in_order(df: DataFrame, order: Order) -> DataFrame:
    """Rows by columns, NULL last."""
    return df.orderBy(*[F.desc_nulls_last(c) if falling else F.asc_nulls_last(c) for c, falling in order])


def write_table(df: DataFrame, root: str, layer: str | None, table: str, order: Order = ()) -> str:
    """Create or replace a table; running it again gives the same table.

    It becomes the table's next snapshot, so a failed write changes nothing.  ``order`` is kept with the table:
    whatever files it is written as, it is read in that order."""
    path = table_path(root, layer, table)
    snapshots.write(df, path, notes={"order": order} if order else None)
    return path


def write_clustered(
    df: DataFrame, root: str, layer: str | None, table: str,
    cluster: tuple[str, ...], month_of: str | None = None, found_by: tuple[str, ...] = (),
) -> str:
    """Create or replace a table laid out by month and clustering columns.

    Files hold ranges of the clustering columns, so that Parquet statistics skip the rest.  A hash of the
    row breaks ties: a value that holds too many rows is cut into several ranges, and no task ever has to
    write a whole hot month.  Columns in ``found_by`` get Bloom filters: a lookup of one value skips the row
    groups that do not have it, wherever its rows lie.
    """
    path = table_path(root, layer, table)
    keys = [MONTH, *cluster] if month_of else list(cluster)
    if month_of:
        df = df.withColumn(MONTH, F.date_format(month_of, "yyyy-MM"))
    if keys:
        df = df.repartitionByRange(*keys, F.xxhash64(*df.columns)).sortWithinPartitions(*keys)
    blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in found_by}
    snapshots.write(df, path, [MONTH] if month_of else [], options=blooms)
    return path


def write_quoted_csv(df: DataFrame, path: str) -> str:
    """CSV with a header and every field quoted, so that no value can shift columns; blanks stay."""
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, quoteAll=True, escape='"', emptyValue="", **blanks).csv(path)
    return path


def publish_table(df: DataFrame, layer: str | None, table: str) -> DataFrame:
    """Materialise a model as a catalog table of its layer."""
    spark, layer = df.sparkSession, layer_name(layer)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    df.write.mode("overwrite").saveAsTable(f"{layer}.{table}")
    return spark.table(f"{layer}.{table}")


def publish_bucketed(df: DataFrame, layer: str | None, table: str, key: str, buckets: int) -> DataFrame:
    """Materialise a model as a catalog table dealt into sorted buckets by ``key``.

    Tables with as many buckets of one key are joined and grouped by it where they lie.  A bucket is one file:
    let it have some hundred megabytes; a hot key cannot be split."""
    spark, layer = df.sparkSession, layer_name(layer)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(f"{layer}.{table}")
    return spark.table(f"{layer}.{table}")


def create_view(spark: SparkSession, layer: str | None, table: str, sql: str) -> DataFrame:
    """Materialise a model as a view of the catalog, which every session of it reads."""
    layer = layer_name(layer)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    spark.sql(f"CREATE OR REPLACE VIEW {layer}.{table} AS {sql}")
    return spark.table(f"{layer}.{table}")


def publish_view(df: DataFrame, table: str) -> DataFrame:
    """Materialise a model as a view of this session: it is computed where it is used."""
    df.createOrReplaceTempView(table)
    return df.sparkSession.table(table)


def read_table(spark: SparkSession, root: str, layer: str | None, table: str) -> DataFrame:
    """A table as of its last snapshot, in its order; a plain folder of files is read as it is."""
    path = table_path(root, layer, table)
    last = snapshots.snapshot(spark, path)
    if last is None:
        return spark.read.parquet(path)
    found = snapshots.read(spark, path, number=last.number)
    return in_order(found, last.notes["order"]) if last.notes.get("order") else found


def between(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """Rows of a month-partitioned table whose instant lies in ``[first, last]``.

    The months are implied by the instants and are what prunes directories.
    """
    lo, hi = F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp")
    months = F.col(MONTH).between(F.date_format(lo, "yyyy-MM"), F.date_format(hi, "yyyy-MM"))
    return df.where(months & F.col(column).between(lo, hi))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, largest first."""
    counts = [
        df.agg(*columns(table_name=f"'{name}'", row_count="count(*)"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy(F.desc("row_count"), "table_name")
