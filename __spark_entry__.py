"""Registered queries over the given tables, each with its expected result as SQL.

The given tables are mapped to raw retail tables (``fixtures/raw_tables.py``); every query runs a job
of the library over all of their rows.  Queries that need files write them to the shared folder.
"""

from __future__ import annotations

import os
import sys
import tempfile
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession

from fixtures import oracle as O
from fixtures import raw_tables as R
from retailmarts.functions import columns
from retailmarts.operators import quality, review_repair, rollups
from retailmarts.plans import enrich, incremental, kpis, load, marts, staging
from retailmarts.session import configure, shared_dir
from retailmarts.sources import layers, raw, snapshots
from retailmarts.sources.schemas import RAW
from retailmarts.sources.tables import Tables
from retailmarts.streaming import ingest

try:  # the corpus operators are optional: nothing else depends on them
    import corpus_pipeline
    from retailmarts.llm import queries as corpus
except ImportError:
    corpus = corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

PARSED = list(O.KINDS)  # all raw tables but the reviews, which are repaired instead


def entry(spark: SparkSession) -> DataFrame:
    """Delivery performance per customer state."""
    return queries()["mart_delivery_performance"](spark, "/root/testdata/sf0.001")


# ---------------------------------------------------------------- inputs


def _ready(spark: SparkSession) -> SparkSession:
    """The session with the settings of the library, and a folder of its own where no shared one is set."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="retailmarts-"))
    return configure(spark)


def _raw(spark: SparkSession, sf_dir: str) -> Tables:
    return R.raw_tables(spark, sf_dir)


def _enriched(spark: SparkSession, sf_dir: str) -> Tables:
    return load.enriched_tables(_raw(spark, sf_dir))


def _staged(spark: SparkSession, sf_dir: str) -> Tables:
    return load.staging_models(_enriched(spark, sf_dir))


def _records(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    lines = R.review_lines(spark, sf_dir) if table == "reviews" else R.damaged_lines(spark, sf_dir, table)
    return raw.scan_lines(lines, table)


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review_repair.reviews_typed(review_repair.reviews_clean(_records(spark, sf_dir, "reviews")))


_BUILT: dict[tuple[str, str], dict[str, DataFrame]] = {}


def _built(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All layers, written once per application: checks run on written tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = load.build(spark, _raw(spark, sf_dir), shared_dir(spark, "warehouse"))
    return _BUILT[key]


_REFRESHED: dict[tuple[str, str], dict[str, DataFrame]] = {}


def _refreshed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The marts after two deliveries, made once per application: orders until mid-1995 with all items and
    payments of the first three lines, then all the rest."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _REFRESHED:
        root, every = shared_dir(spark, "refreshed"), _raw(spark, sf_dir)
        early = "order_purchase_timestamp < '1995-07-01'"
        came = {
            "orders": every["orders"].where(early), "order_items": every["order_items"].where("order_item_id <= 3"),
            "payments": every["payments"].where("payment_sequential <= 3"),
        }
        first = Tables({t: (lambda t=t: came[t] if t in came else every[t]) for t in RAW})
        incremental.refresh(spark, root, first)
        late = [
            every["orders"].where(f"NOT coalesce({early}, false)"), every["order_items"].where("NOT order_item_id <= 3"),
            every["payments"].where("NOT payment_sequential <= 3"),
        ]
        changed = quality.union([rows.select("order_id") for rows in late])
        _REFRESHED[key] = incremental.refresh(spark, root, every, changed)
    return _REFRESHED[key]


def _sold(t: Tables) -> DataFrame:
    return marts.sold_items(t["stg_orders"], t["stg_order_items"])


# ---------------------------------------------------------------- queries that need files


def _clustered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, spec = shared_dir(spark, "clustered"), RAW["orders"]
    orders = R.raw_table(spark, sf_dir, "orders")
    layers.write_clustered(orders, root, "raw", "orders", spec.cluster, spec.month_of)
    return layers.read_table(spark, root, "raw", "orders")


def _partition_pruned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.between(
        _clustered_orders(spark, sf_dir), "order_purchase_timestamp",
        "1996-01-15 00:00:00", "1996-06-30 23:59:59",
    ).select("order_id", "order_status", "order_purchase_timestamp")


def _partition_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, spec = shared_dir(spark, "clustered"), RAW["orders"]
    orders = R.raw_table(spark, sf_dir, "orders")
    layers.write_clustered(orders, root, "raw", "orders", spec.cluster, spec.month_of)
    return snapshots.partition_counts(spark, layers.table_path(root, "raw", "orders"))


def _quoted_csv_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "quoted")
    layers.write_quoted_csv(R.raw_table(spark, sf_dir, "customers"), path)
    return raw.read_raw(spark, "customers", path)


def _stream_ingest(table: str) -> Query:
    """Delivered twice, as a folder of part files each time, and settled."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = shared_dir(spark, "stream")
        landing, target, progress = f"{base}/landing", f"{base}/{table}", f"{base}/progress"
        lines = R.damaged_lines(spark, sf_dir, table)
        for n in range(2):
            # A compressed file is read by one task: let none have too much.
            lines.write.option("maxRecordsPerFile", 250_000).text(f"{landing}/{n}", compression="gzip")
            ingest.ingest(spark, table, landing, target, progress, header=False)
        return ingest.current(spark, table, target)

    return query


def _raw_load_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A strict load from files with headers: scan, check, clustered write, read back."""
    base, names = shared_dir(spark, "rawload"), RAW["orders"].names
    records = raw.parse(_records(spark, sf_dir, "orders"), "orders")
    layers.write_quoted_csv(records.select(columns(**{n: f"string({n})" for n in names})), f"{base}/orders.csv")
    return load.load_raw(spark, base, "orders", f"{base}/orders.csv").select(names)


def _raw_load_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A strict load of records whose messages span lines."""
    base = shared_dir(spark, "rawload")
    layers.write_quoted_csv(R.told_reviews(spark, sf_dir), f"{base}/reviews.csv")
    return load.load_raw(spark, base, "reviews", f"{base}/reviews.csv")


def _raw_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = {
        t: raw.check_load(_records(spark, sf_dir, t), t).where("NOT _bad") for t in RAW
    }
    return layers.row_counts(accepted)


def _bad_record_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.union([
        raw.load_report(raw.check_load(_records(spark, sf_dir, t), t), t) for t in RAW
    ])


# ---------------------------------------------------------------- registry


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {}

    def on_records(name: str, job: Callable[[DataFrame], DataFrame], table: str) -> None:
        found[name] = lambda spark, sf: job(_records(_ready(spark), sf, table))

    def on(source: Callable[[SparkSession, str], Tables], **jobs: Callable[[Tables], DataFrame]) -> None:
        for name, job in jobs.items():
            found[name] = lambda spark, sf, job=job: job(source(_ready(spark), sf))

    def plain(**jobs: Query) -> None:
        for name, job in jobs.items():
            found[name] = lambda spark, sf, job=job: job(_ready(spark), sf)

    for table in PARSED:
        short = {"order_items": "items", "category_translation": "translation"}.get(table, table)
        on_records(f"parse_{short}", lambda r, table=table: raw.parse(r, table), table)
    plain(
        parse_rejects=lambda spark, sf: quality.union(
            [raw.rejects(_records(spark, sf, t), t) for t in PARSED]
        ),
        raw_load_counts=_raw_load_counts,
        bad_record_budget=_bad_record_budget,
        partition_pruned_orders=_partition_pruned_orders,
        partition_stats=_partition_stats,
        quoted_csv_customers=_quoted_csv_customers,
        stream_ingest_orders=_stream_ingest("orders"),
        stream_ingest_items=_stream_ingest("order_items"),
        stream_ingest_geolocation=_stream_ingest("geolocation"),
        raw_load_orders=_raw_load_orders,
        raw_load_reviews=_raw_load_reviews,
    )

    on(
        _raw,
        delivery_delay=lambda t: enrich.with_delay(t["orders"]).select(
            "order_id", "delivery_delay_days", "is_late_delivery"
        ),
        lookup_orders_customers=lambda t: enrich.orders_with_customers(t["orders"], t["customers"]),
        lookup_items_sellers=lambda t: enrich.items_with_sellers(t["order_items"], t["sellers"]),
        lookup_items_products=lambda t: enrich.items_with_products(t["order_items"], t["products"]),
        lookup_items_translation=lambda t: enrich.items_with_translation(
            enrich.items_with_products(t["order_items"], t["products"]), t["category_translation"]
        ),
        stg_customers=lambda t: staging.stg_customers(t["customers"]),
        stg_products=lambda t: staging.stg_products(t["products"]),
        stg_sellers=lambda t: staging.stg_sellers(t["sellers"]),
        row_counts=lambda t: layers.row_counts(t.pick(RAW)),
        dq_primary_keys=lambda t: quality.primary_key_findings(
            t, {name: spec.key for name, spec in RAW.items() if spec.key}
        ),
        dq_orphans=quality.orphan_counts,
        dq_validations=lambda t: quality.validations(t, {name: spec.key for name, spec in RAW.items() if spec.key}),
        dq_null_rates=lambda t: quality.null_rates(
            t["orders"], "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date",
        ),
        dq_status_dist=lambda t: rollups.distribution(t["orders"], "order_status"),
        dq_payment_dist=lambda t: rollups.distribution(t["payments"], "payment_type"),
        dq_date_range=lambda t: quality.date_range(t["orders"], "order_purchase_timestamp"),
        dq_total_gmv=lambda t: quality.total_gmv(t["order_items"]),
        dq_multi_zip=lambda t: quality.duplicate_keys(t["geolocation"], "geolocation_zip_code_prefix"),
        dq_positive_price=lambda t: quality.non_positive_prices(t["order_items"]),
        kpi_customers_by_state=lambda t: kpis.customers_by_state(t["customers"]),
    )
    on(
        _enriched,
        orders_enriched=lambda t: t["orders_enriched"],
        order_items_enriched=lambda t: t["order_items_enriched"],
        payments_raw=lambda t: t["payments"],
        geolocation_deduped=lambda t: t["geolocation_deduped"],
    )
    on(
        _staged,
        stg_orders=lambda t: t["stg_orders"],
        stg_order_items=lambda t: t["stg_order_items"],
        stg_payments=lambda t: t["stg_payments"],
        stg_geolocation=lambda t: t["stg_geolocation"],
        order_values=lambda t: rollups.order_values(t["stg_order_items"]),
        order_payments=lambda t: rollups.order_payments(t["stg_payments"]),
        seller_rollup=lambda t: marts.seller_figures(_sold(t)).drop("top_category"),
        top_category_per_seller=lambda t: rollups.top_category_per_seller(_sold(t)),
        sold_items=_sold,
        paid_orders=lambda t: marts.paid_orders(t["stg_payments"], t["stg_orders"]),
        order_totals=lambda t: marts.order_totals(t["stg_orders"], t["stg_order_items"]).select(
            "order_id", "customer_state", "customer_zip_code_prefix",
            *columns(order_value="value_units / 10000D"),
        ),
        state_rollup=lambda t: marts.state_rollup(marts.order_totals(t["stg_orders"], t["stg_order_items"])),
        state_centroid=lambda t: rollups.state_centroid(t["stg_geolocation"]),
        payment_share=lambda t: load.mart_models(t)["mart_payment_analysis"].select(
            "payment_type", "order_month", "pct_of_monthly_orders"
        ),
        kpi_category_revenue=lambda t: kpis.category_revenue(t["stg_orders"], t["stg_order_items"]),
        kpi_on_time_rate=lambda t: kpis.on_time_rate(t["stg_orders"]),
        kpi_aov_by_payment=lambda t: kpis.aov_by_payment(t["stg_payments"], t["stg_orders"]),
        kpi_monthly_active=lambda t: kpis.monthly_active(t["stg_orders"]),
        kpi_customer_ltv=lambda t: kpis.customer_ltv(t["stg_orders"], t["stg_order_items"]),
        kpi_processing_hours=lambda t: kpis.processing_hours(t["stg_orders"]),
        kpi_status_by_month=lambda t: kpis.status_by_month(t["stg_orders"]),
    )
    for mart in (
        "mart_order_kpis", "mart_seller_performance", "mart_delivery_performance", "mart_geo_sales",
        "mart_payment_analysis",
    ):
        on(_staged, **{mart: lambda t, mart=mart: load.mart_models(t)[mart]})

    for mart in incremental.MARTS:
        on(_refreshed, **{f"incremental_{mart}": lambda t, mart=mart: t[mart]})

    on(
        _built,
        dq_not_null=lambda t: quality.run_checks(t, quality.checks_of("not_null")),
        dq_unique=lambda t: quality.run_checks(t, quality.checks_of("unique")),
        dq_accepted_values=lambda t: quality.run_checks(t, quality.checks_of("accepted_values")),
        dq_unexpected_payment_types=lambda t: quality.unexpected_values(
            t["stg_payments"], "payment_type",
            next(c.values for c in quality.CHECKS if c.table == "stg_payments" and c.values),
        ),
        dq_report=lambda t: quality.report(quality.run_checks(t)),
    )

    on_records("reviews_clean", review_repair.reviews_clean, "reviews")
    on_records("reviews_stats", review_repair.reviews_stats, "reviews")
    plain(
        reviews_typed=_reviews,
        kpi_review_by_state=lambda spark, sf: kpis.review_by_state(
            _reviews(spark, sf), _staged(spark, sf)["stg_order_items"]
        ),
        kpi_review_dist=lambda spark, sf: kpis.review_distribution(_reviews(spark, sf)),
        kpi_score_by_delivery=lambda spark, sf: kpis.score_by_delivery(
            _reviews(spark, sf), _staged(spark, sf)["stg_orders"]
        ),
    )
    if corpus:
        plain(**corpus.queries(), pipeline=corpus_pipeline.run)
    return found


def oracle_sql() -> dict[str, str]:
    from fixtures.expected import EXPECTED

    found = {name: O.query(sql) for name, sql in EXPECTED.items()}
    if corpus:
        found |= corpus.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
