"""Bucketed tables, lasting views, and how often a report reads its tables."""

from collections import Counter

import __spark_entry__ as entry
from retailmarts.operators import quality
from retailmarts.plans import enrich, load, marts
from retailmarts.sources import layers
from retailmarts.sources.schemas import RAW
from retailmarts.sources.tables import Tables
from tests.conftest import SF, rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_are_joined_where_they_lie(spark, settings):
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    stg = entry._staged(spark, SF)
    raw = entry._raw(spark, SF)
    try:
        orders = layers.publish_bucketed(stg["stg_orders"], "placed", "stg_orders", "order_id", 6)
        items = layers.publish_bucketed(stg["stg_order_items"], "placed", "stg_order_items", "order_id", 6)
        sold = marts.sold_items(orders, items)
        assert "Exchange" not in plan_of(sold) and "SortMergeJoin" in plan_of(sold)
        assert rows(sold) == rows(marts.sold_items(stg["stg_orders"], stg["stg_order_items"]))
        listed = layers.publish_bucketed(raw["order_items"], "placed", "items_by_product", "product_id", 6)
        products = layers.publish_bucketed(raw["products"], "placed", "products", "product_id", 6)
        named = enrich.items_with_products(listed, products, placed=True)
        assert "Exchange" not in plan_of(named) and "SortMergeJoin" in plan_of(named)
        assert rows(named) == rows(enrich.items_with_products(raw["order_items"], raw["products"]))
    finally:
        spark.sql("DROP DATABASE IF EXISTS placed CASCADE")


def test_another_session_reads_the_staging_views(spark, tmp_path):
    try:
        built = load.build(spark, entry._raw(spark, SF), str(tmp_path / "b"), catalog=True)
        other = spark.newSession()
        for name in ("stg_orders", "stg_order_items", "stg_payments", "stg_geolocation"):
            assert other.catalog.getTable(f"staging.{name}").tableType == "VIEW"
            seen = other.table(f"staging.{name}")
            assert seen.columns == built[name].columns and rows(seen) == rows(built[name])
    finally:
        for name in ("mart", "staging"):
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_a_report_reads_each_table_once_but_for_duplicates_and_orphans(spark, tmp_path):
    raw = entry._raw(spark, SF)
    for name in RAW:
        raw[name].write.parquet(str(tmp_path / name))
    tables = Tables({t: (lambda t=t: spark.read.parquet(str(tmp_path / t))) for t in RAW})
    keys = {name: spec.key for name, spec in RAW.items() if spec.key}
    plan = quality.validations(tables, keys)._jdf.queryExecution().optimizedPlan()
    seen = Counter(
        leaf.relation().location().rootPaths().head().getName()
        for leaf in (plan.collectLeaves().apply(i) for i in range(plan.collectLeaves().size()))
    )
    want = Counter(list(RAW)) + Counter(list(keys)) + Counter(["geolocation"])
    want += Counter(t for child, _, parent, _ in quality.RELATIONSHIPS for t in (child, parent))
    assert seen == want
