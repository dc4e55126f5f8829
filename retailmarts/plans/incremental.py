"""Marts kept up to date delivery by delivery.

Every order has a home, the first month of its rows, and all that belongs to it lies there: orders, items and
payments as staging models (the facts), partitioned by home.  A delivery names the orders it changed; only
their homes are rewritten.  Each mart has a partial state per home, made of numbers that add up (counts,
decimal sums, least and greatest values) and of distinct keys.  As an order is in one home only, its distinct
counts add up too.  The partial states of the rewritten homes are replaced, and the marts are worked
out from all partial states, which are small.

Facts, partial states and homes are snapshots, written in this order: a refresh that dies is repeated.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailmarts.functions import columns
from retailmarts.functions.exact import mean_1dp, mean_money, money, percent, round_div, sum_units, units
from retailmarts.functions.labels import delivery_grade
from retailmarts.operators.lookup import pack, unpack
from retailmarts.operators.rollups import delivered
from retailmarts.plans import load, marts
from retailmarts.session import remove, shared_dir, small_sides
from retailmarts.sources import layers, snapshots
from retailmarts.sources.schemas import RAW
from retailmarts.sources.tables import Tables
from retailmarts.streaming import ingest

HOME = "home"
#: The home of orders without a month, and of items and payments whose order has not come.
NOWHERE = "none"
FACTS = ("stg_orders", "stg_order_items", "stg_payments")
#: Buckets of the table of homes.
BUCKETS = 64
#: As many changed orders are broadcast, not shuffled with the rows.
_FEW = 200_000
_IDS = ("order_id", "product_id", "seller_id", "customer_id", "customer_unique_id")

_MONTH = ["order_month", "order_year", "order_month_num"]


def _sums(*names: str, **others: str) -> list:
    return columns(**{n: f"sum({n})" for n in names}, **others)


# ---------------------------------------------------------------- partial states


def order_kpi_parts(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Per home and month: figures, and one row per state."""
    per_order = marts.kpi_orders(orders, items, payments, HOME)
    figures = per_order.groupBy(HOME, *_MONTH).agg(*columns(
        orders="count(DISTINCT order_id)", n="count(*)", revenue="sum(revenue)", freight="sum(freight)",
        value="sum(value)", items="sum(items)", late="count_if(is_late_delivery)",
        on_time="count_if(NOT is_late_delivery)", delay="sum(delivery_delay_days)",
        delayed="count(delivery_delay_days)", parts="sum(parts_tenths)", max_parts="sum(max_parts)",
    ))
    states = per_order.select(HOME, *_MONTH, "customer_state").distinct()
    return figures.unionByName(states, allowMissingColumns=True)


def order_kpis(parts: DataFrame) -> DataFrame:
    figures = ["orders", "n", "revenue", "freight", "value", "items", "late", "on_time", "delay", "delayed", "parts", "max_parts"]
    added = parts.groupBy(*_MONTH).agg(*_sums(*figures, states="count(DISTINCT customer_state)"))
    return added.select(*_MONTH, *columns(
        total_orders="orders", states_served="states", gmv_brl="revenue / 100D", total_freight_brl="freight / 100D",
        aov_brl=f"{round_div('value', 'n')} / 100D", total_items_sold="double(items)", late_orders="late",
        on_time_orders="on_time", avg_delivery_delay_days=mean_1dp("delay", "delayed"),
        late_delivery_pct=percent("late", "orders"), avg_installments=f"{round_div('parts', 'n')} / 10D",
        avg_max_installments=mean_1dp("max_parts", "n"),
    )).orderBy(F.asc_nulls_last("order_year"), F.asc_nulls_last("order_month_num"))


def seller_parts(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Per home, seller, month and category: orders that are counted there, and totals."""
    return marts.seller_parts(marts.sold_items(orders, items, HOME), HOME)


def seller_performance(parts: DataFrame) -> DataFrame:
    return marts.seller_mart(marts.seller_rows(parts))


def delivery_parts(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    delay = "delivery_delay_days"
    return delivered(orders).where(f"{delay} IS NOT NULL").groupBy(HOME, "customer_state").agg(*columns(
        orders="count(DISTINCT order_id)", n="count(*)", early=f"count_if({delay} < 0)", on_time=f"count_if({delay} = 0)",
        late=f"count_if({delay} > 0)", very_late=f"count_if({delay} > 7)", delay=f"sum({delay})",
        best=f"min({delay})", worst=f"max({delay})",
    ))


def delivery_performance(parts: DataFrame) -> DataFrame:
    added = parts.groupBy("customer_state").agg(*_sums(
        "orders", "n", "early", "on_time", "late", "very_late", "delay", best="min(best)", worst="max(worst)"
    ))
    return added.select("customer_state", *columns(
        total_delivered_orders="orders", early_deliveries="early", on_time_deliveries="on_time", late_deliveries="late",
        very_late_deliveries="very_late", late_pct=percent("late", "n"), early_pct=percent("early", "n"),
        avg_delay_days=mean_1dp("delay", "n"), best_delivery_days="best", worst_delivery_days="worst",
        delivery_grade=delivery_grade(percent("late", "n")),
    )).orderBy(F.desc_nulls_last("late_pct"), "customer_state")


def geo_parts(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Per home and state: figures, and one row per ZIP."""
    totals = marts.order_totals(orders, items, HOME).withColumnRenamed("customer_state", "state")
    figures = totals.groupBy(HOME, "state").agg(*columns(
        orders="count(DISTINCT order_id)", value="sum(value_units)", valued="count(value_units)"
    ))
    zips = totals.selectExpr(HOME, "state", "customer_zip_code_prefix AS zip").distinct()
    return figures.unionByName(zips, allowMissingColumns=True)


def geo_sales(parts: DataFrame, geolocation: DataFrame) -> DataFrame:
    added = parts.groupBy("state").agg(*_sums("orders", "value", "valued", zips="count(DISTINCT zip)"))
    return marts.geo_mart(added.select("state", *columns(
        total_orders="orders", total_gmv_brl=money("value"), avg_order_value_brl=mean_money("value", "valued"),
        distinct_zips="zips",
    )), geolocation)


_PAID = ["payment_type", "order_month", "order_year"]


def payment_parts(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    return marts.paid_orders(payments, orders, HOME).groupBy(HOME, *_PAID).agg(*columns(
        orders="count(DISTINCT order_id)", value=sum_units("payment_value"), valued=f"count({units('payment_value')})",
        instalments="count_if(is_instalment_purchase)", parts="sum(payment_installments)",
        parted="count(payment_installments)", most="max(payment_installments)",
    ))


def payment_analysis(parts: DataFrame) -> DataFrame:
    added = parts.groupBy(*_PAID).agg(*_sums("orders", "value", "valued", "instalments", "parts", "parted", most="max(most)"))
    return marts.payment_mart(added.select(*_PAID, *columns(
        total_orders="orders", total_payment_value_brl=money("value"), avg_payment_value_brl=mean_money("value", "valued"),
        instalment_orders="instalments", avg_installments=mean_1dp("parts", "parted"), max_installments="most",
    )))


#: Per mart: its partial state from the facts, and the mart from all partial states (and the staged geolocation).
MARTS: dict[str, tuple[Callable, Callable]] = {
    "mart_order_kpis": (order_kpi_parts, lambda parts, geo: order_kpis(parts)),
    "mart_seller_performance": (seller_parts, lambda parts, geo: seller_performance(parts)),
    "mart_delivery_performance": (delivery_parts, lambda parts, geo: delivery_performance(parts)),
    "mart_geo_sales": (geo_parts, geo_sales),
    "mart_payment_analysis": (payment_parts, lambda parts, geo: payment_analysis(parts)),
}


# ---------------------------------------------------------------- refresh


def _of(source: Tables, ids: DataFrame | None) -> Tables:
    """The staging models of the orders ``ids`` (None: all)."""

    def raw(table: str) -> DataFrame:
        rows = source[table]
        return rows if ids is None or table not in ("orders", "order_items", "payments") else rows.join(ids, "order_id", "left_semi")

    return load.staging_models(load.enriched_tables(Tables({t: (lambda t=t: raw(t)) for t in RAW})))


def _homes(spark: SparkSession, path: str, ids: DataFrame | None) -> DataFrame | None:
    """The known homes of ``ids``, from their buckets alone."""
    if ids is None:
        return None
    buckets = [r[0] for r in ids.select(_bucket()).distinct().collect()]  # BUCKETS at most
    known = snapshots.read(spark, path, [snapshots.partition(bucket=b) for b in buckets])
    return None if known is None else known.join(ids, "order_id", "left_semi")


def _slim_join(rows: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """``rows`` joined by order to ``right``, whose order_ids are packed; its own are while they are shuffled."""
    ids = [c for c in _IDS if c in rows.columns]
    return unpack(pack(rows, *ids).join(right, "order_id", how), *ids)


def _places(orders: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Per order of ``ids`` (None: of ``orders``), packed: its home, NULL if it has not come, and whether its
    rows have several months."""
    first, last, known = "min(order_month)", "max(order_month)", "count(order_month)"
    homes = pack(orders.select("order_id", "order_month"), "order_id").groupBy("order_id").agg(*columns(
        home=f"coalesce({first}, '{NOWHERE}')", several=f"{known} > 0 AND ({first} <> {last} OR {known} < count(*))",
    ))
    return homes if ids is None else pack(ids, "order_id").join(homes, "order_id", "left")


def _bucket():
    return F.pmod(F.xxhash64("order_id"), F.lit(BUCKETS)).cast("int").alias("bucket")


def refresh(spark: SparkSession, root: str, source: Tables, changed: DataFrame | None = None, notes: dict | None = None) -> dict[str, DataFrame]:
    """Bring facts, partial states and marts under ``root`` up to date with the raw tables ``source``.

    ``changed`` has the order_ids of all rows of orders, items and payments that came, went or changed, or whose
    customers, sellers, products or category names did; None stands for all, as for the first time.
    ``notes`` are kept with the homes, which are written last.
    """
    homes_at = layers.table_path(root, "facts", "homes")
    if snapshots.snapshot(spark, homes_at) is None:
        changed = None
    scratch = shared_dir(spark, "refresh")
    try:
        with small_sides(spark):
            _refresh_parts(spark, root, source, changed, notes, homes_at, scratch)
    finally:
        remove(spark, scratch)
    geolocation = _of(source, None)["stg_geolocation"]
    for name, (_, whole) in MARTS.items():
        partial = snapshots.read(spark, layers.table_path(root, "partial", name))
        layers.write_table(whole(partial, geolocation), root, "mart", name, marts.ORDER[name])
    return {name: layers.read_table(spark, root, "mart", name) for name in MARTS}


def _refresh_parts(spark: SparkSession, root: str, source: Tables, changed: DataFrame | None, notes: dict | None, homes_at: str, scratch: str) -> None:
    """Facts, partial states and homes brought up to date.

    Few changed orders are broadcast, and only their raw rows are looked up.  Where most have changed, the rows are
    joined after their lookups: that join gives them their homes as well, and they are shuffled by order once."""
    ids, few, most = None, False, True
    if changed is not None:
        named = pack(changed.select("order_id").where("order_id IS NOT NULL"), "order_id").distinct()
        ids = snapshots.scratch(unpack(named, "order_id"), f"{scratch}/ids")
        n = ids.count()
        few, most = n <= _FEW, n > max(_FEW, snapshots.read(spark, homes_at).count() // 2)
    known = F.broadcast(ids) if few else ids
    staged, old = _of(source, None if most else known), _homes(spark, homes_at, known)
    came = staged["stg_orders"]
    if most and ids is not None:
        came = _slim_join(came, pack(ids, "order_id"), "left_semi")
    came = snapshots.scratch(came, f"{scratch}/orders")
    places = snapshots.scratch(_places(came, ids), f"{scratch}/places")
    new = unpack(places.where(f"{HOME} IS NOT NULL").select("order_id", HOME), "order_id")
    touched, held = None, None
    if old is not None:  # months, and orders that have not come
        found = new.select(HOME).unionByName(old.select(HOME)).distinct().collect()
        touched = sorted({snapshots.partition(home=h) for h in [NOWHERE, *(r[0] for r in found)]})
        held = _held(spark, root, touched, known, few, scratch)
    # Orders have their month themselves, so that only those of several months, hardly any, are looked up.
    moved = snapshots.scratch(unpack(places.where("several").select("order_id", F.col(HOME).alias("_first")), "order_id"), f"{scratch}/moved")
    fresh = {"stg_orders": came.join(moved, "order_id", "left").withColumn(HOME, F.expr(f"coalesce(_first, order_month, '{NOWHERE}')")).drop("_first")}
    for name in FACTS[1:]:
        rows = staged[name]
        if name == "stg_order_items" and not few:  # the files of the shuffle for their lookups go before the next one
            rows = snapshots.scratch(rows, f"{scratch}/items")
        rows = _slim_join(rows, places.drop("several"), "left" if ids is None else "inner")
        fresh[name] = rows.withColumn(HOME, F.coalesce(HOME, F.lit(NOWHERE)))
    facts = {name: _write_facts(spark, root, name, fresh[name], held and held[name], touched) for name in FACTS}
    orders, items, payments = facts["stg_orders"], *(facts[n].drop(HOME) for n in FACTS[1:])
    for name, (parts, _) in MARTS.items():
        snapshots.write(parts(orders, items, payments), layers.table_path(root, "partial", name), [HOME], touched=touched)
    _write_homes(spark, homes_at, new, known, notes)


def _held(spark: SparkSession, root: str, touched: list[str], ids: DataFrame, few: bool, scratch: str) -> dict[str, DataFrame]:
    """The facts that the touched homes hold of other orders than ``ids``.

    Where many orders have changed few may be left in these homes: they are told from order_ids alone, and if
    they can be broadcast, the facts are not shuffled."""
    there = {name: snapshots.read(spark, layers.table_path(root, "facts", name), touched) for name in FACTS}
    if few:
        return {name: rows.join(ids, "order_id", "left_anti") for name, rows in there.items()}
    orders = reduce(DataFrame.unionByName, [pack(rows.select("order_id"), "order_id") for rows in there.values()])
    rest = snapshots.scratch(orders.distinct().join(pack(ids, "order_id"), "order_id", "left_anti"), f"{scratch}/rest")
    return {name: _slim_join(rows, rest, "left_semi") for name, rows in there.items()}


def _write_facts(spark: SparkSession, root: str, name: str, fresh: DataFrame, held: DataFrame | None, touched: list[str] | None) -> DataFrame:
    """Replace the touched homes by ``fresh`` and what they hold of other orders; returns the facts of these homes.

    They are not shuffled for the write: each task of the join to the homes writes its rows of every home."""
    path = layers.table_path(root, "facts", name)
    snapshots.write(fresh if held is None else held.unionByName(fresh), path, [HOME], touched=touched)
    return snapshots.read(spark, path, touched)


def _write_homes(spark: SparkSession, path: str, new: DataFrame, ids: DataFrame | None, notes: dict | None) -> None:
    rows, touched = new.select("order_id", HOME, _bucket()), None
    if ids is not None:
        buckets = [r[0] for r in ids.select(_bucket()).distinct().collect()]
        touched = [snapshots.partition(bucket=b) for b in buckets]
        rows = snapshots.read(spark, path, touched).join(ids, "order_id", "left_anti").unionByName(rows)
    snapshots.write(rows, path, ["bucket"], touched=touched, notes=notes)


# ---------------------------------------------------------------- from ingested files


def _state(root: str, table: str) -> str:
    return ingest.state_path(layers.table_path(root, "landed", table))


def _changed_rows(spark: SparkSession, root: str, table: str, since: int | None, key: str) -> DataFrame | None:
    """The values of ``key`` of rows that came or went after snapshot ``since`` of the table's state; None if
    that snapshot is no longer there.  Only buckets with new files are read."""
    path = _state(root, table)
    now = snapshots.snapshot(spark, path)
    if now is None or now.number == since:
        return spark.createDataFrame([], f"{key} string")
    if since is None:
        return snapshots.read(spark, path).select(key).distinct()
    then = snapshots.snapshot(spark, path, since)
    if then is None:
        return None
    parts = [p for p in {*now.parts, *then.parts} if now.parts.get(p) != then.parts.get(p)]
    names = RAW[table].names
    signed = [
        snapshots.read(spark, path, parts, number=n).select(key, F.xxhash64(*names).alias("row"), F.lit(sign).alias("sign"))
        for n, sign in ((now.number, 1), (since, -1))
    ]
    moved = signed[0].unionByName(signed[1]).groupBy(key, "row").agg(F.sum("sign").alias("sign")).where("sign <> 0")
    return moved.select(key).distinct()


def changed_orders(spark: SparkSession, root: str, since: dict[str, int], source: Tables) -> DataFrame | None:
    """The orders that the ingested tables have changed since the given snapshots; None if that cannot be told.

    A changed customer, seller, product or category name changes the orders that mention it; for these only
    the keys of orders, items and products are read."""

    def keys(table: str, key: str) -> DataFrame | None:
        return _changed_rows(spark, root, table, since.get(table), key)

    own = [keys(t, "order_id") for t in ("orders", "order_items", "payments")]
    found = {k: keys(t, k) for t, k in (
        ("customers", "customer_id"), ("sellers", "seller_id"), ("products", "product_id"),
        ("category_translation", "product_category_name"),
    )}
    if any(x is None for x in [*own, *found.values()]):
        return None
    category = "product_category_name"
    renamed = source["products"].join(found[category], category, "left_semi").select("product_id")
    products = found["product_id"].unionByName(renamed).distinct()
    mentions = [
        source["orders"].join(found["customer_id"], "customer_id", "left_semi"),
        source["order_items"].join(found["seller_id"], "seller_id", "left_semi"),
        source["order_items"].join(products, "product_id", "left_semi"),
    ]
    return reduce(DataFrame.unionByName, [*own, *(m.select("order_id") for m in mentions)])


def refresh_ingested(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Bring the marts up to date with the files ingested under ``root`` so far."""
    homes = snapshots.snapshot(spark, layers.table_path(root, "facts", "homes"))
    found = {t: snapshots.snapshot(spark, _state(root, t)) for t in RAW}
    now = {t: s.number for t, s in found.items() if s}
    source = Tables({t: (lambda t=t: snapshots.read(spark, _state(root, t), number=now[t]).select(RAW[t].names)
                         if t in now else spark.createDataFrame([], RAW[t].schema)) for t in RAW})
    changed = changed_orders(spark, root, homes.notes["since"], source) if homes else None
    return refresh(spark, root, source, changed, notes={"since": now})
