"""Tables as snapshots."""

import os

import pytest
from pyspark.sql import functions as F

from retailmarts.sources import layers, snapshots
from tests.conftest import rows


def table(spark, *values):
    return spark.createDataFrame(list(values), "k STRING, n BIGINT")


def test_write_read_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    assert snapshots.read(spark, path) is None
    first = snapshots.write(table(spark, ("a", 1), ("b", 2)), path)
    assert (first.number, first.notes["rows"]) == (1, 2)
    snapshots.write(table(spark, ("c", 3)), path)
    assert rows(snapshots.read(spark, path)) == [("c", 3)]
    assert rows(snapshots.read(spark, path, number=1)) == [("a", 1), ("b", 2)]
    snapshots.write(table(spark), path)
    assert snapshots.read(spark, path).schema == table(spark).schema and snapshots.read(spark, path).count() == 0


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write(table(spark, ("a", 1)), path)
    bad = spark.range(0, 8, 1, 4).select(F.lit("x").alias("k"), F.expr("IF(id = 7, raise_error('lost'), id)").cast("long").alias("n"))
    with pytest.raises(Exception, match="lost"):
        snapshots.write(bad, path)
    assert rows(snapshots.read(spark, path)) == [("a", 1)]


def test_an_unfinished_manifest_does_not_count(spark, tmp_path):
    """The writer dies while it writes the manifest; the next write goes on."""
    path = tmp_path / "t"
    snapshots.write(table(spark, ("a", 1)), str(path))
    (path / "manifests" / "000000000002.json").write_text('{"schema": {"ty')
    assert rows(snapshots.read(spark, str(path))) == [("a", 1)]
    assert snapshots.write(table(spark, ("b", 2)), str(path)).number == 3
    assert rows(snapshots.read(spark, str(path))) == [("b", 2)]


def test_a_reader_keeps_its_version(spark, tmp_path):
    layers.write_table(table(spark, ("a", 1), ("b", 2)), str(tmp_path), "mart", "t")
    reader = layers.read_table(spark, str(tmp_path), "mart", "t")
    layers.write_table(table(spark, ("c", 3)), str(tmp_path), "mart", "t")
    assert rows(reader) == [("a", 1), ("b", 2)]
    # A table may be made of itself.
    layers.write_table(layers.read_table(spark, str(tmp_path), "mart", "t").withColumn("n", F.col("n") + 1), str(tmp_path), "mart", "t")
    assert rows(layers.read_table(spark, str(tmp_path), "mart", "t")) == [("c", 4)]


def test_of_two_writers_one_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    snapshots.write(table(spark, ("a", 1)), path)
    seen = snapshots._numbers(spark, path)
    snapshots.write(table(spark, ("b", 2)), path)
    with monkeypatch.context() as m:
        m.setattr(snapshots, "_numbers", lambda *_: seen)
        with pytest.raises(snapshots.ConcurrentWrite):
            snapshots.write(table(spark, ("c", 3)), path)
    assert rows(snapshots.read(spark, path)) == [("b", 2)]


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    part = snapshots.partition
    snapshots.write(table(spark, ("a", 1), ("b", 2), ("c d/e", 3), (None, 4)), path, ["k"])
    kept = {f for f in files(path) if "k=b" in f}
    snapshots.write(table(spark, ("a", 5)), path, ["k"], touched=[part(k="a"), part(k="c d/e")])
    assert rows(snapshots.read(spark, path)) == [("a", 5), ("b", 2), (None, 4)]
    assert kept <= files(path)
    snapshots.write(table(spark, (None, 6), ("a", 7)), path, ["k"], touched=[part(k="a")], add=[part(k=None)])
    assert rows(snapshots.read(spark, path)) == [("a", 7), ("b", 2), (None, 4), (None, 6)]
    assert rows(snapshots.read(spark, path, [part(k="b"), part(k="none")])) == [("b", 2)]
    with pytest.raises(ValueError, match="k=z"):
        snapshots.write(table(spark, ("z", 1)), path, ["k"], touched=[part(k="a")])


def test_old_snapshots_expire(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(6):
        snapshots.write(table(spark, ("a", n), ("b", n)), path, ["k"], touched=[snapshots.partition(k="a"), snapshots.partition(k="b")], keep=2)
    assert snapshots._numbers(spark, path) == [5, 6]
    assert len(files(path)) == 4
    assert rows(snapshots.read(spark, path, number=5)) == [("a", 4), ("b", 4)]


def test_counts_come_from_the_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    part = snapshots.partition
    snapshots.write(table(spark, ("a", 1), ("a", None), ("b", 2), (None, 4)), path, ["k"])
    snapshots.write(table(spark, ("b", 5)), path, ["k"], touched=[], add=[part(k="b")])
    counts = snapshots.partition_counts(spark, path)
    assert rows(counts) == [("a", 2), ("b", 2), (None, 1)]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(" in plan and "PushedGroupBy: [k, _v]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_a_table_is_read_in_its_order(spark, tmp_path):
    """Written as many files by tasks in no order."""
    many = spark.range(2000).selectExpr("string(id % 7) AS k", "nullif(id % 13, 5) AS n").repartition(9, F.rand(2))
    layers.write_table(many, str(tmp_path), "mart", "t", (("n", True), ("k", False)))
    assert len(files(tmp_path)) == 9
    got = [(r["n"], r["k"]) for r in layers.read_table(spark, str(tmp_path), "mart", "t").collect()]
    assert got == sorted(got, key=lambda r: (r[0] is None, -(r[0] or 0), r[1])) and len(got) == 2000


def test_written_marts_keep_their_order(spark, tmp_path):
    from retailmarts.plans import marts

    states = spark.createDataFrame([(f"s{i}", i % 5 * 1.5) for i in range(40)], "customer_state STRING, late_pct DOUBLE")
    order = marts.ORDER["mart_delivery_performance"]
    layers.write_table(states.repartition(8, F.rand(1)), str(tmp_path), "mart", "m", order)
    got = [tuple(r) for r in layers.read_table(spark, str(tmp_path), "mart", "m").collect()]
    assert got == sorted(got, key=lambda r: (-r[1], r[0]))


def rows_read(df):
    """Rows that the scan of a query gives out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if "Adaptive" in plan.nodeName() else plan
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_a_lookup_of_one_key_skips_row_groups(spark, tmp_path, settings):
    settings(adaptive__coalescePartitions__enabled="false")  # several files
    orders = spark.range(40_000).selectExpr("md5(string(id)) AS order_id", "string(id % 50) AS order_status")
    read = {}
    for name, keys in (("plain", ()), ("found", ("order_id",))):
        layers.write_clustered(orders.repartition(8), str(tmp_path), "raw", name, ("order_status",), None, keys)
        read[name] = rows_read(layers.read_table(spark, str(tmp_path), "raw", name).where(f"order_id = '{_md5(777)}'"))
    assert read["plain"] == 40_000 and 1 <= read["found"] < 25_000


def _md5(n):
    import hashlib

    return hashlib.md5(str(n).encode()).hexdigest()
