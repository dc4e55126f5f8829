"""How much the jobs shuffle and write: what large tables need of disk."""

import time
from pathlib import Path

from pyspark.sql import functions as F

from retailmarts.operators import lookup
from retailmarts.plans import enrich, incremental, marts
from retailmarts.session import SMALL, small_sides
from retailmarts.sources import snapshots
from retailmarts.streaming import ingest
from tests.conftest import rows
from tests.test_incremental import TABLES, tables


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_a_merge_shuffles_the_rows_once(spark, settings):
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    came = spark.range(40).selectExpr(
        "string(id % 20) AS order_id", "1L AS order_item_id", "'p' AS product_id", "'s' AS seller_id",
        "timestamp_seconds(0) AS shipping_limit_date", "double(id) AS price", "1D AS freight_value",
        f"timestamp_seconds(id div 20) AS {ingest.ARRIVED}", f"string(id div 20) AS {ingest.FILE}",
        f"string(id div 20) AS {ingest.DELIVERY}",
    )
    told = F.broadcast(ingest._told(ingest._files(ingest._contents(came, "order_items"))))
    keyed, rest = ingest._that_count(came, told, "order_items")
    dealt = ingest._bucketed(keyed, "order_items", 4).repartition(ingest.BUCKET, ingest._SHARE)
    last = ingest._latest(dealt, "order_items", (ingest.BUCKET, ingest._SHARE))
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(key_bucket") == 1 and "Exchange hashpartitioning(order_id" not in plan
    assert rows(last.select("price")) == [(float(i),) for i in range(20, 40)] and rest.count() == 0


def test_snapshots_are_compressed_more(spark, tmp_path):
    df = spark.range(20_000).selectExpr("md5(string(id)) AS x")
    df.coalesce(1).write.parquet(str(tmp_path / "plain"))
    snapshots.write(df.coalesce(1), str(tmp_path / "t"))
    size = {n: sum(f.stat().st_size for f in (tmp_path / n).rglob("*.parquet")) for n in ("plain", "t")}
    assert size["t"] < 0.6 * size["plain"]


def test_sellers_are_not_expanded(spark, settings):
    """After the join of items and orders: a shuffle by seller, month and category, and one by seller."""
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    orders = spark.range(4).selectExpr(
        "string(id) AS order_id", "'delivered' AS order_status", "id AS delivery_delay_days", "id > 1 AS is_late_delivery",
        "string(id % 2) AS order_month",
    )
    items = spark.range(8).selectExpr(
        "'s' || id div 100 AS seller_id", "'x' AS seller_state", "'y' AS seller_city", "string(id % 4) AS order_id", "1D AS price",
        "2D AS total_item_value", "CASE WHEN id < 4 THEN 'a' ELSE 'b' END AS category_display",
    )
    figures = marts.seller_figures(marts.sold_items(orders, items))
    plan = figures._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and exchanges(figures) == 4
    assert [tuple(r) for r in figures.collect()] == [("s0", "x", "y", 4, 8, 8.0, 1.0, 16.0, 1.5, 4, 100.0, "a", 2)]


def test_a_refresh_does_not_shuffle_for_its_files(spark, tmp_path, monkeypatch):
    plans, write = [], snapshots.write

    def told(df, path, by=(), **more):
        if by:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, path, by, **more)

    monkeypatch.setattr(snapshots, "write", told)
    incremental.refresh(spark, str(tmp_path), tables(spark, TABLES))
    assert len(plans) == 9 and not any("rangepartitioning" in p for p in plans)


def test_items_of_other_orders_are_dropped_before_the_shuffle(spark, settings):
    name = "spark.sql.optimizer.runtime.bloomFilter"
    assert spark.conf.get(f"{name}.applicationSideScanSizeThreshold") == "32MB"
    assert spark.conf.get(f"{name}.creationSideThreshold") == "4GB"


def shuffle_files(spark):
    """The files of shuffles on this machine."""
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f.name for d in dirs for f in Path(str(d)).rglob("shuffle_*")}


def new_shuffle_files(spark, before):
    """How many there are besides ``before``, some seconds later, as they are deleted in the background."""
    for _ in range(50):
        if not (new := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return len(new)


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    before = shuffle_files(spark)
    df = spark.range(100).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    snapshots.write(df, str(tmp_path / "t"), ["k"])
    assert len(rows(snapshots.scratch(df.repartition(2, "k"), str(tmp_path / "s")))) == 7
    assert new_shuffle_files(spark, before) == 0
    assert len(rows(snapshots.read(spark, str(tmp_path / "t")))) == 7
    assert spark.conf.get(name, None) == was


def test_a_refresh_leaves_no_shuffle_files_while_it_runs(spark, tmp_path, monkeypatch):
    seen, write, before = [], snapshots.write, shuffle_files(spark)

    def told(df, path, by=(), **more):
        if "/facts/stg_order_items" in path or "/partial/" in path:
            seen.append(new_shuffle_files(spark, before))
        return write(df, path, by, **more)

    monkeypatch.setattr(snapshots, "write", told)
    incremental.refresh(spark, str(tmp_path), tables(spark, TABLES))
    assert len(seen) == 6 and max(seen) == 0


def test_small_sides_are_measured(spark, settings):
    name = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    with small_sides(spark), small_sides(spark):
        assert spark.conf.get(name) == SMALL
    assert spark.conf.get(name, None) is None
    settings(adaptive__autoBroadcastJoinThreshold="7")
    with small_sides(spark):
        assert spark.conf.get(name) == "7"
    settings(autoBroadcastJoinThreshold="-1")
    spark.conf.unset(name)
    with small_sides(spark):
        assert spark.conf.get(name, None) is None


def test_few_sellers_do_not_shuffle_the_items(spark, settings):
    """Nothing is known to be small before it runs; the products are too many."""
    settings(autoBroadcastJoinThreshold="1", adaptive__autoBroadcastJoinThreshold="20000")
    items = spark.range(2000).selectExpr(
        "string(id) AS order_id", "1L AS order_item_id", "md5(string(id % 1500)) AS product_id", "'s' || id % 5 AS seller_id",
        "timestamp_seconds(0) AS shipping_limit_date", "1D AS price", "2D AS freight_value",
    )
    products = spark.range(1500).selectExpr("md5(string(id)) AS product_id", "'k' || id % 2 AS product_category_name")
    sellers = spark.range(4).selectExpr("'s' || id AS seller_id", "'SP' AS seller_state", "'x' AS seller_city")
    kinds = spark.createDataFrame([("k0", "even")], "product_category_name string, product_category_name_english string")
    found = enrich.order_items_enriched(items, sellers, products, kinds)
    got = found.selectExpr("product_category_name", "product_category_name_english", "seller_state", "order_id", "product_id").collect()
    plan = found._jdf.queryExecution()
    assert len(got) == 2000 and {tuple(r)[:3] for r in got} == {
        ("k0", "even", "SP"), ("k1", "", "SP"), ("k0", "even", None), ("k1", "", None),
    }
    assert {(r.order_id, r.product_id) for r in got} == {(r.order_id, r.product_id) for r in items.collect()}
    found.collect()
    shown = plan.executedPlan().toString().split("== Initial Plan ==")[0]
    assert shown.count("BroadcastHashJoin") == 2 and shown.count("SortMergeJoin") == 1


def test_packed_ids(spark):
    digits = "0123456789abcdef"
    ids = [
        None, "", " ", "a", digits * 2, digits.upper() * 2, digits, digits[:15], "x" * 15, "é" * 7 + "a", "\0" * 15, "\0" * 16, "ÿ" * 8,
        "g" * 32, digits * 2 + "0", "0" * 32, "f" * 30, "f" * 32, "é" * 32,
    ]
    df = spark.createDataFrame([(x, n) for n, x in enumerate(ids)], "id string, n int")
    packed = lookup.pack(df, "id")
    assert packed.columns == ["id", "n"] and lookup.unpack(packed, "id").orderBy("n").collect() == df.orderBy("n").collect()
    made = [r.id for r in packed.orderBy("n").collect()]
    assert len({bytes(b) for b in made if b is not None}) == len(ids) - 1 and made[0] is None
    assert [len(made[ids.index(x)]) for x in (digits * 2, "f" * 32, digits[:15])] == [16, 16, 17]
    assert [i for i, b in enumerate(made) if b is not None and len(b) == 16] == [4, 15, 17]
