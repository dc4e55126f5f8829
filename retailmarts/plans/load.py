"""Raw load and the whole build, written table by table."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from retailmarts.plans import enrich, marts, staging
from retailmarts.session import remove, shared_dir, small_sides, write_once
from retailmarts.sources import layers, raw
from retailmarts.sources.schemas import RAW
from retailmarts.sources.tables import Tables
from retailmarts.streaming import ingest

#: Tables that are loaded at once: while one ends in a few tasks, the next has work for the other cores.
SIDE_BY_SIDE = 3


def load_raw(
    spark: SparkSession, root: str, table: str, path: str, max_bad: int | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """Load one raw file strictly and replace its table; bad rows go to the layer ``rejects``.

    The file is parsed once, into a scratch table in the shared folder that is removed afterwards, and the
    bad records are counted on the way; a load over budget fails before the old table is touched.
    ``multi_line`` allows quoted line breaks, by default for reviews only.
    """
    spec, seen = RAW[table], Observation(f"load_{table}")
    scratch = shared_dir(spark, f"load-{table}")
    try:
        checked = raw.check_load(raw.scan(spark, table, path, multi_line), table)
        with write_once(spark):
            checked.observe(seen, F.expr("count_if(_bad) AS bad")).write.parquet(scratch)
        rows = spark.read.schema(checked.schema).parquet(scratch)
        layers.write_table(rows.where("_bad").drop("_bad"), root, "rejects", table)
        raw.within_budget(seen.get["bad"], table, max_bad)
        good = rows.where("NOT _bad").drop("_bad")
        keys = tuple(k for k in spec.required if k not in spec.cluster)
        layers.write_clustered(good, root, "raw", table, spec.cluster, spec.month_of, keys)
    finally:
        remove(spark, scratch)
    return layers.read_table(spark, root, "raw", table)


def load_all(spark: SparkSession, root: str, landing: str, multi_line: bool | None = None) -> DataFrame:
    """Load every raw table from ``<landing>/<table>.csv``, some side by side, and report the rows of each."""
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        loaded = pool.map(lambda t: load_raw(spark, root, t, f"{landing}/{t}.csv", multi_line=multi_line), RAW)
        return layers.row_counts(dict(zip(RAW, loaded)))


def landed(spark: SparkSession, landing: str) -> Tables:
    """The raw tables as leniently parsed from ``<landing>/<table>.csv``."""
    return Tables({t: (lambda t=t: raw.read_raw(spark, t, f"{landing}/{t}.csv")) for t in RAW})


def ingested(spark: SparkSession, root: str) -> Tables:
    """The raw tables as the files ingested under ``root`` give them by now."""
    return Tables({
        t: (lambda t=t: ingest.current(spark, t, layers.table_path(root, "landed", t))) for t in RAW
    })


def write_rejects(spark: SparkSession, landing: str, root: str) -> DataFrame:
    """The records that ``landed`` drops, as a table: table and start of the record."""
    dropped = [raw.rejects(raw.scan(spark, t, f"{landing}/{t}.csv"), t) for t in RAW if t != "reviews"]
    layers.write_table(reduce(DataFrame.unionByName, dropped), root, "rejects", "records")
    return layers.read_table(spark, root, "rejects", "records")


def enriched_tables(source: Tables) -> Tables:
    """The four enriched tables of the raw ones."""
    return Tables({
        "orders_enriched": lambda: enrich.orders_enriched(source["orders"], source["customers"]),
        "order_items_enriched": lambda: enrich.order_items_enriched(
            source["order_items"], source["sellers"], source["products"], source["category_translation"]
        ),
        "payments": lambda: enrich.payments(source["payments"]),
        "geolocation_deduped": lambda: enrich.geolocation_deduped(source["geolocation"]),
    })


def staging_models(enriched: Tables) -> Tables:
    """The four staging models of the enriched tables."""
    return Tables({
        "stg_orders": lambda: staging.stg_orders(enriched["orders_enriched"]),
        "stg_order_items": lambda: staging.stg_order_items(enriched["order_items_enriched"]),
        "stg_payments": lambda: staging.stg_payments(enriched["payments"]),
        "stg_geolocation": lambda: staging.stg_geolocation(enriched["geolocation_deduped"]),
    })


def mart_models(stg: Tables) -> Tables:
    """The five marts of the staging models."""
    orders, items = "stg_orders", "stg_order_items"
    payments, geolocation = "stg_payments", "stg_geolocation"
    return Tables({
        "mart_order_kpis": lambda: marts.mart_order_kpis(stg[orders], stg[items], stg[payments]),
        "mart_seller_performance": lambda: marts.mart_seller_performance(stg[orders], stg[items]),
        "mart_delivery_performance": lambda: marts.mart_delivery_performance(stg[orders]),
        "mart_geo_sales": lambda: marts.mart_geo_sales(stg[orders], stg[items], stg[geolocation]),
        "mart_payment_analysis": lambda: marts.mart_payment_analysis(stg[payments], stg[orders]),
    })


def build(
    spark: SparkSession, source: Tables, root: str, catalog: bool = False
) -> dict[str, DataFrame]:
    """Write enriched tables and marts under ``root``; staging stays lazy on top of the written tables.

    With ``catalog`` the enriched tables and the marts are also tables of the catalog, and the staging models
    views of it on the enriched tables, which other sessions read as well.
    """

    def written(layer: str, models: Tables) -> dict[str, DataFrame]:
        for name in models.makers:
            layers.write_table(models[name], root, layer, name, marts.ORDER.get(name, ()))
        return {name: layers.read_table(spark, root, layer, name) for name in models.makers}

    with small_sides(spark):
        enriched = written("staging", enriched_tables(source))
        stg = staging_models(enriched)
        built = written("mart", mart_models(stg))
    if catalog:
        for name, table in enriched.items():
            layers.publish_table(table, None, name)
        for name, model in staging.MODELS.items():
            layers.create_view(spark, None, name, model.sql(layers.layer_name()))
            layers.publish_view(stg[name], name)
        for name, mart in built.items():
            layers.publish_table(mart, "mart", name)
    return {**enriched, **stg.pick(stg.makers), **built}
