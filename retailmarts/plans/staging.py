"""Enriched tables → cleaned staging models; each stays lazy, like a view."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from retailmarts.functions import columns
from retailmarts.functions.labels import VALID_STATUSES, category_label, listed, payment_label


def _present(*names: str) -> str:
    """All columns are non-NULL; unlike ``dropna`` this keeps NaN."""
    return " AND ".join(f"{name} IS NOT NULL" for name in names)


def _has_key(df: DataFrame, key: str) -> DataFrame:
    return df.where(f"{_present(key)} AND {key} <> ''")


@dataclass(frozen=True)
class Model:
    """A staging model as text: the enriched table it reads, its filter and its columns.

    The same text makes a DataFrame and a view."""

    source: str
    where: str
    select: dict[str, str]

    def of(self, df: DataFrame) -> DataFrame:
        return df.where(self.where).select(columns(**self.select))

    def sql(self, layer: str) -> str:
        listed_columns = ", ".join(f"{sql} AS {name}" for name, sql in self.select.items())
        return f"SELECT {listed_columns} FROM {layer}.{self.source} WHERE {self.where}"


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


_INSTANTS = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]
_PURCHASE = "CAST(order_purchase_timestamp AS TIMESTAMP)"

MODELS = {
    # Orders with keys and a known status, plus date parts of the purchase.
    "stg_orders": Model(
        "orders_enriched",
        f"{_present('order_id', 'customer_id')} AND order_status IN ({listed(VALID_STATUSES)})",
        {
            **_same("order_id", "customer_id", "customer_unique_id", "order_status"),
            **{c: f"CAST({c} AS TIMESTAMP)" for c in _INSTANTS},
            **_same(
                "delivery_delay_days", "is_late_delivery", "customer_state", "customer_city",
                "customer_zip_code_prefix",
            ),
            "order_date": f"to_date({_PURCHASE})",
            "order_month": f"date_format({_PURCHASE}, 'yyyy-MM')",
            "order_year": f"bigint(year({_PURCHASE}))",
            "order_month_num": f"bigint(month({_PURCHASE}))",
        },
    ),
    # Line items with keys and a price, plus their total value and shown category.
    "stg_order_items": Model(
        "order_items_enriched",
        _present("order_id", "product_id", "seller_id", "price"),
        {
            **_same("order_id", "order_item_id", "product_id", "seller_id"),
            "shipping_limit_date": "CAST(shipping_limit_date AS TIMESTAMP)",
            **_same("price", "freight_value"),
            "total_item_value": "round(coalesce(price, 0D) + coalesce(freight_value, 0D), 2)",
            **_same("seller_state", "seller_city", "product_category_name", "product_category_name_english"),
            "category_display": category_label("product_category_name_english", "product_category_name"),
        },
    ),
    # Payments of a positive amount, with readable types and an instalment flag.
    "stg_payments": Model(
        "payments",
        f"{_present('order_id', 'payment_value')} AND payment_value > 0 AND NOT isnan(payment_value)",
        {
            **_same("order_id", "payment_sequential"),
            "payment_type": payment_label("payment_type"),
            **_same("payment_installments", "payment_value"),
            "is_instalment_purchase": "payment_installments > 1",
        },
    ),
    "stg_geolocation": Model(
        "geolocation_deduped",
        _present("zip_code_prefix", "avg_lat", "avg_lng"),
        {
            "zip_code_prefix": "zip_code_prefix", "latitude": "avg_lat", "longitude": "avg_lng",
            "city": "geolocation_city", "state": "geolocation_state",
        },
    ),
}


def stg_orders(enriched: DataFrame) -> DataFrame:
    return MODELS["stg_orders"].of(enriched)


def stg_order_items(enriched: DataFrame) -> DataFrame:
    return MODELS["stg_order_items"].of(enriched)


def stg_payments(payments: DataFrame) -> DataFrame:
    return MODELS["stg_payments"].of(payments)


def stg_geolocation(deduped: DataFrame) -> DataFrame:
    return MODELS["stg_geolocation"].of(deduped)


def stg_customers(customers: DataFrame) -> DataFrame:
    """Declared model: raw customers with a key."""
    return _has_key(customers, "customer_id")


def stg_products(products: DataFrame) -> DataFrame:
    """Declared model: raw products with a key."""
    return _has_key(products, "product_id")


def stg_sellers(sellers: DataFrame) -> DataFrame:
    """Declared model: raw sellers with a key."""
    return _has_key(sellers, "seller_id")
