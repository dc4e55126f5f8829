"""Raw tables → enriched tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from retailmarts.functions import columns
from retailmarts.functions.labels import delay_days
from retailmarts.operators.lookup import lookup, pack, unpack
from retailmarts.sources.schemas import ENRICHED, conform


#: The ids of an item.
_IDS = ("order_id", "product_id", "seller_id")


def with_delay(orders: DataFrame) -> DataFrame:
    """Delivery delay in days and whether the order was late; NULL where a date is missing."""
    delay = delay_days("order_delivered_customer_date", "order_estimated_delivery_date")
    return orders.select("*", *columns(delivery_delay_days=delay, is_late_delivery=f"{delay} > 0"))


def orders_with_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders keep their row without a customer; customers without an order are left out."""
    geography = ["customer_state", "customer_city", "customer_zip_code_prefix", "customer_unique_id"]
    # A customer id belongs to one order, so none is hot but the blank one.
    return lookup(orders, customers, "customer_id", geography, hot=False)


def items_with_sellers(items: DataFrame, sellers: DataFrame) -> DataFrame:
    return lookup(items, sellers, "seller_id", ["seller_state", "seller_city"])


def items_with_products(items: DataFrame, products: DataFrame, placed: bool = False) -> DataFrame:
    return lookup(items, products, "product_id", ["product_category_name"], missing="", placed=placed)


def items_with_translation(items: DataFrame, translation: DataFrame) -> DataFrame:
    return lookup(
        items, translation, "product_category_name", ["product_category_name_english"], missing=""
    )


def orders_enriched(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return conform(orders_with_customers(with_delay(orders), customers), ENRICHED["orders_enriched"])


def order_items_enriched(
    items: DataFrame, sellers: DataFrame, products: DataFrame, translation: DataFrame
) -> DataFrame:
    # Products are most, so their lookup shuffles the items: it comes before the others widen the rows.
    slim = pack(items, *_IDS)
    rows = items_with_translation(items_with_products(slim, pack(products, "product_id")), translation)
    found = items_with_sellers(rows, pack(sellers, "seller_id"))
    return conform(unpack(found, *_IDS), ENRICHED["order_items_enriched"])


def payments(raw_payments: DataFrame) -> DataFrame:
    return conform(raw_payments, ENRICHED["payments"])


def geolocation_deduped(geolocation: DataFrame) -> DataFrame:
    """One row per ZIP: mean of the known coordinates, smallest (state, city).

    ZIPs without any latitude or any longitude are left out.  Points are first added up per
    (ZIP, state, city), a plain hash aggregation; only its few rows meet the ordering of the second.
    Coordinates are added as decimals with 15 places, so the order of rows does not matter; beyond 1e13 a
    number is no coordinate.
    """
    places = geolocation.selectExpr(
        "geolocation_zip_code_prefix AS zip_code_prefix", "geolocation_state", "geolocation_city",
        "try_cast(geolocation_lat AS DECIMAL(28, 15)) AS lat", "try_cast(geolocation_lng AS DECIMAL(28, 15)) AS lng",
    ).groupBy("zip_code_prefix", "geolocation_state", "geolocation_city").agg(
        *columns(lat="sum(lat)", lats="count(lat)", lng="sum(lng)", lngs="count(lng)")
    )
    return (
        places.groupBy("zip_code_prefix")
        .agg(
            *columns(
                avg_lat="double(round(try_divide(sum(lat), sum(lats)), 6))",
                avg_lng="double(round(try_divide(sum(lng), sum(lngs)), 6))",
                place="min(struct(geolocation_state, geolocation_city))",
            )
        )
        .where("avg_lat IS NOT NULL AND avg_lng IS NOT NULL")
        .select("zip_code_prefix", "avg_lat", "avg_lng", "place.*")
    )
