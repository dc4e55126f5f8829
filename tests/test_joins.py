import pytest
from pyspark.sql import functions as F

from retailmarts.operators import lookup as J
from tests.conftest import rows


def test_lookup_takes_the_smallest_match(spark):
    left = spark.createDataFrame([(1, "k"), (2, "none"), (3, ""), (4, None), (5, "k")], "id int, key string")
    right = spark.createDataFrame([("k", "b", "1"), ("k", "a", "2"), ("k", "a", "3"), ("", "blank", "0"),
                                   ("orphan", "z", "9"), (None, "null", "n")], "key string, x string, y string")
    assert rows(J.lookup(left, right, "key", ["x", "y"])) == sorted([
        (1, "k", "a", "2"), (2, "none", None, None), (3, "", "blank", "0"), (4, None, None, None),
        (5, "k", "a", "2")], key=repr)
    filled = J.lookup(left, right, "key", ["x"], missing="")
    assert {r.id: r.x for r in filled.collect()} == {1: "a", 2: "", 3: "blank", 4: "", 5: "a"}


def test_unused_lookup_disappears(spark):
    left = spark.range(10).selectExpr("id", "string(id) AS key")
    right = spark.range(10).selectExpr("string(id) AS key", "string(id) AS x")
    plan = J.lookup(left, right, "key", ["x"]).select("id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


@pytest.fixture
def hot(spark, settings):
    """Three quarters of the rows have one key; no broadcast; thresholds small enough to split it."""
    settings(
        autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB", adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="10KB", adaptive__coalescePartitions__enabled="false",
    )
    # Text that does not compress well gives the partitions a size.
    return spark.range(0, 20_000, 1, 8).selectExpr(
        "id", "CASE WHEN id % 4 < 3 THEN 'hot' ELSE string(id) END AS key", "sha2(string(id), 512) AS pad"
    )


def test_hot_key_is_split_in_lookups(spark, hot):
    right = spark.range(0, 20_000, 1, 4).selectExpr(
        "CASE WHEN id = 0 THEN 'hot' ELSE string(id) END AS key", "string(id * 2) AS x"
    )
    joined = J.lookup(hot, right, "key", ["x"])
    got = {r.id: r.x for r in joined.collect()}
    assert got == {i: "0" if i % 4 < 3 else str(i * 2) for i in range(20_000)}
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split_in_inner_joins(spark, hot):
    other = spark.range(0, 20_000, 1, 4).selectExpr("CASE WHEN id = 0 THEN 'hot' ELSE string(id) END AS key")
    joined = hot.join(other, "key")
    assert joined.collect().__len__() == 20_000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_orphans(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "")], "id int, k string")
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "pk string")
    assert rows(J.orphans(child, parent, "k", "pk")) == [(2, "b"), (4, "")]


def largest(joined, column):
    """Rows of the largest task of the join."""
    tasks = joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max(column))
    return max(r["n"] for r in tasks.collect())


@pytest.mark.parametrize("odd", ["''", "CAST(NULL AS STRING)"])
def test_rows_without_a_key_are_spread_in_plain_joins(spark, settings, odd):
    """Three quarters of the rows have no key; no task of the join gets many of them, none is lost."""
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false", shuffle__partitions="16")
    left = spark.range(0, 20_000, 1, 8).selectExpr("id", f"CASE WHEN id % 4 < 3 THEN {odd} ELSE string(id) END AS key")
    right = spark.range(0, 20_000, 1, 4).selectExpr("CASE WHEN id < 3 THEN '' ELSE string(id) END AS key", "string(id * 2) AS x")
    joined = J.lookup(left, right, "key", ["x"], hot=False)
    blank = "0" if odd == "''" else None
    assert {r.id: r.x for r in joined.collect()} == {i: blank if i % 4 < 3 else str(i * 2) for i in range(20_000)}
    assert largest(joined, "x") < 2 * 20_000 / 16


def test_a_frequent_blank_order_is_spread_in_the_marts(spark, settings):
    from retailmarts.operators.rollups import item_totals, order_facts

    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false", shuffle__partitions="16")
    orders = spark.range(0, 8_000, 1, 4).selectExpr("id", "CASE WHEN id % 4 < 3 THEN '' ELSE string(id) END AS order_id")
    items = spark.range(0, 8_000, 1, 4).selectExpr(
        "CASE WHEN id % 2 = 0 THEN '' ELSE string(id) END AS order_id", "1D AS price", "2D AS freight_value", "3D AS total_item_value")
    payments = items.selectExpr("order_id", "2L AS payment_installments")
    for totals, column, some, one in (
        (order_facts(items, payments), "value_cents", 4_000 * 300, 300), (item_totals(items), "value_units", 4_000 * 30_000, 30_000),
    ):
        joined = J.attach(orders, totals[0], "order_id", totals[1])
        found = {r["id"]: r[column] for r in joined.collect()}
        assert found == {i: some if i % 4 < 3 else one for i in range(8_000)}
        assert largest(joined, column) < 2 * 8_000 / 16
    # Without rows of the blank order there is nothing to attach.
    known = items.where("order_id <> ''")
    assert J.attach(orders.where("order_id = ''"), item_totals(known)[0], "order_id", item_totals(known)[1]).where(
        "value_units IS NOT NULL").count() == 0
