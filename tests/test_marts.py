import datetime

import pytest

from retailmarts.operators import rollups
from retailmarts.plans import enrich, kpis, marts, staging
from retailmarts.sources.schemas import ENRICHED, RAW
from tests.conftest import rows

T = datetime.datetime


def order(order_id, status="delivered", month=1, delay=0, state="SP", zip_code="1", unique="u1"):
    late = None if delay is None else delay > 0
    return (order_id, "c", status, T(2018, month, 1), None, None, None, None, delay, late, state, "city",
            zip_code, unique)


def item(order_id, price, freight=0.0, seller="s1", product="p1", state="SP", category="toys", english=""):
    return (order_id, 1, product, seller, None, price, freight, state, "city", category, english)


def stg_orders(spark, *orders):
    return staging.stg_orders(spark.createDataFrame(list(orders), ENRICHED["orders_enriched"]))


def stg_items(spark, *items):
    return staging.stg_order_items(spark.createDataFrame(list(items), ENRICHED["order_items_enriched"]))


def stg_payments(spark, *payments):
    return staging.stg_payments(spark.createDataFrame(list(payments), ENRICHED["payments"]))


def test_staging_filters(spark):
    kept = stg_orders(spark, order("a"), order(None), order("b", status="lost"), order(""), order("c", status=None))
    assert [r.order_id for r in kept.orderBy("order_id").collect()] == ["", "a"]  # blank keys stay
    items = stg_items(spark, item("a", 1.0, None), item("a", None), item(None, 1.0), item("a", 0.0, 2.345))
    assert rows(items.select("price", "total_item_value")) == [(0.0, 2.35), (1.0, 1.0)]
    nan = float("nan")
    paid = stg_payments(spark, ("a", 1, "boleto", 1, 5.0), ("a", 2, "x", 2, 0.0), ("a", 3, "x", 2, -1.0),
                        ("a", 4, "x", 2, nan), ("a", 5, None, None, 1.0))
    assert rows(paid) == [("a", 1, "Boleto", 1, 5.0, False), ("a", 5, "Unknown", None, 1.0, None)]


def test_order_without_items_or_payments_uses_defaults(spark):
    kpis_ = marts.mart_order_kpis(
        stg_orders(spark, order("a"), order("b", delay=None, state=None), order("c", status="shipped")),
        stg_items(spark, item("a", 10.0, 1.0), item("a", 5.0, 1.0), item("c", 99.0)),
        stg_payments(spark, ("a", 1, "boleto", 4, 10.0), ("a", 2, "voucher", 1, 7.0), ("c", 1, "x", 9, 1.0)),
    )
    r = kpis_.collect()
    assert len(r) == 1
    assert r[0].asDict() == {
        "order_month": "2018-01", "order_year": 2018, "order_month_num": 1, "total_orders": 2,
        "states_served": 1, "gmv_brl": 15.0, "total_freight_brl": 2.0, "aov_brl": 8.5,
        "total_items_sold": 2.0, "late_orders": 0, "on_time_orders": 1, "avg_delivery_delay_days": 0.0,
        "late_delivery_pct": 0.0, "avg_installments": 1.8, "avg_max_installments": 2.5,
    }


def test_duplicated_order_counts_once_but_sums_twice(spark):
    k = marts.mart_order_kpis(
        stg_orders(spark, order("a"), order("a")), stg_items(spark, item("a", 10.0)),
        stg_payments(spark, ("a", 1, "boleto", 1, 10.0)),
    ).head()
    assert (k.total_orders, k.gmv_brl, k.total_items_sold) == (1, 20.0, 2.0)


def test_seller_ties_tiers_and_late_over_100(spark):
    orders = stg_orders(spark, order("a", delay=3), order("b", month=2, delay=None), order("x", status="shipped"))
    sold = marts.mart_seller_performance(orders, stg_items(
        spark,
        item("a", 40000.0, category="b"), item("a", 20000.0, category="a"), item("x", 1.0, seller="s9"),
        item("b", 1000.0, seller="s2", category=""), item("b", 0.004, seller="s3", english="en"),
    ))
    got = {r.seller_id: r for r in sold.collect()}
    assert list(got) == ["s1", "s2", "s3"]  # by revenue; shipped orders do not count
    s1 = got["s1"]
    assert (s1.top_category, s1.late_deliveries, s1.total_orders, s1.late_delivery_pct) == ("a", 2, 1, 200.0)
    assert (s1.seller_tier, got["s2"].seller_tier, got["s3"].seller_tier) == ("Platinum", "Silver", "Bronze")
    assert (got["s2"].top_category, got["s3"].top_category) == ("unknown", "en")
    assert got["s2"].avg_delivery_delay_days is None and got["s2"].late_delivery_pct == 0.0


def test_seller_in_two_places_shares_its_top_category(spark):
    sold = marts.sold_items(stg_orders(spark, order("a"), order("b", month=2)), stg_items(
        spark, item("a", 1.0, state="SP", category="x"), item("b", 1.0, state="RJ", category="y"),
        item("b", 1.0, state="RJ", category="x")))
    got = {r.seller_state: r for r in marts.seller_figures(sold).collect()}
    assert {s: (r.top_category, r.total_orders, r.active_months) for s, r in got.items()} == {
        "SP": ("x", 1, 1), "RJ": ("x", 1, 1)}
    assert rows(rollups.top_category_per_seller(sold)) == [("s1", "x")]


def test_delivery_grades_and_null_state(spark):
    on_time = [order(f"o{i}") for i in range(19)]
    got = marts.mart_delivery_performance(stg_orders(
        spark, *on_time, order("late", delay=8), order("n", state=None, delay=-2), order("u", delay=None)))
    by_state = {r.customer_state: r for r in got.collect()}
    sp = by_state["SP"]
    assert (sp.total_delivered_orders, sp.on_time_deliveries, sp.late_deliveries, sp.very_late_deliveries) == (
        20, 19, 1, 1)
    assert (sp.late_pct, sp.delivery_grade, sp.avg_delay_days) == (5.0, "Excellent", 0.4)
    assert by_state[None].early_pct == 100.0


def test_geo_rank_ties_and_nulls(spark):
    orders = stg_orders(spark, order("a", state="A"), order("b", state="B"), order("c", state="C"),
                        order("d", state="D"), order("e", state=None, status="shipped"), order("f", status="created"))
    items = stg_items(spark, item("a", 5.0), item("b", 5.0), item("c", 9.0), item("e", 1.0), item("f", 77.0))
    geo = spark.createDataFrame([("1", 1.00005, 2.0, "city", "A"), ("2", 3.0, 4.0, "city", "A")],
                                "zip_code_prefix string, latitude double, longitude double, city string, state string")
    got = {r.state: r for r in marts.mart_geo_sales(orders, items, geo).collect()}
    assert {s: r.gmv_rank for s, r in got.items()} == {"C": 1, "A": 2, "B": 2, None: 4, "D": 5}
    assert got["D"].total_gmv_brl is None and got["D"].avg_order_value_brl is None
    assert (got["A"].state_lat, got["A"].state_lng) == (2.0, 3.0)
    assert got[None].state_lat is None


def test_payment_share_counts_an_order_per_method(spark):
    got = marts.mart_payment_analysis(
        stg_payments(spark, ("a", 1, "boleto", 2, 1.0), ("a", 2, "boleto", 3, 1.0), ("a", 3, "voucher", 1, 1.0),
                     ("b", 1, "boleto", 1, 1.0), ("c", 1, "boleto", 1, 1.0)),
        stg_orders(spark, order("a"), order("b"), order("c", status="shipped")),
    ).collect()
    assert [(r.payment_type, r.total_orders, r.instalment_orders, r.pct_of_monthly_orders) for r in got] == [
        ("Boleto", 2, 2, 66.7), ("Voucher", 1, 0, 33.3)]


def test_orders_keep_their_row_without_a_customer(spark):
    orders = spark.createDataFrame([("o", "nobody", "created") + (None,) * 5], RAW["orders"].schema)
    customers = spark.createDataFrame([("c", "u", "1", "city", "SP")], RAW["customers"].schema)
    assert rows(enrich.orders_enriched(orders, customers)) == [
        ("o", "nobody", "created") + (None,) * 11]


def test_items_without_product_have_blank_category(spark):
    items = spark.createDataFrame([("o", 1, "p", "s", None, 1.0, 1.0)], RAW["order_items"].schema)
    empty = {t: spark.createDataFrame([], RAW[t].schema) for t in ("sellers", "products", "category_translation")}
    got = enrich.order_items_enriched(items, *empty.values()).head()
    assert (got.seller_state, got.product_category_name, got.product_category_name_english) == (None, "", "")


def test_geolocation_average(spark):
    points = [("1", 1.0, 10.0, "b", "SP"), ("1", None, 20.0, "a", "SP"), ("1", 2.0, None, "z", "RJ"),
              ("2", None, 1.0, "x", "X"), ("3", 1 / 3, 2 / 3, "x", "X")]
    got = enrich.geolocation_deduped(spark.createDataFrame(points, RAW["geolocation"].schema))
    assert rows(got) == [("1", 1.5, 15.0, "RJ", "z"), ("3", 0.333333, 0.666667, "X", "x")]


def test_one_hot_seller_order_and_state(spark, settings):
    """A third of all rows on one key, small shuffles: the same figures as plain Python."""
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
             adaptive__skewJoin__skewedPartitionThresholdInBytes="1KB", adaptive__skewJoin__skewedPartitionFactor="1.1",
             adaptive__advisoryPartitionSizeInBytes="1KB")
    n = 3000
    orders = stg_orders(spark, *[order(f"o{i}", month=i % 3 + 1, delay=i % 5 - 2, state="HOT" if i % 3 else f"S{i % 7}")
                                 for i in range(n)])
    lines = [("o1" if i % 3 == 0 else f"o{i}", i % 11 + 0.25, "hot" if i % 3 else f"s{i % 50}") for i in range(n)]
    items = stg_items(spark, *[item(o, p, 1.0, seller=s) for o, p, s in lines])
    got = {r.seller_id: r for r in marts.mart_seller_performance(orders, items).collect()}
    for seller in {s for _, _, s in lines}:
        mine = [(o, p) for o, p, s in lines if s == seller]
        assert got[seller].total_items_sold == len(mine)
        assert got[seller].total_orders == len({o for o, _ in mine})
        assert got[seller].total_revenue_brl == pytest.approx(sum(p for _, p in mine), abs=0.005)
    kpi = marts.mart_order_kpis(orders, items, stg_payments(spark, *[(o, 1, "boleto", 1, 1.0) for o, _, _ in lines]))
    assert sum(r.total_items_sold for r in kpi.collect()) == n
    ltv = kpis.customer_ltv(orders, items).collect()
    assert [(r.customer_unique_id, r.orders) for r in ltv] == [("u1", n)]
