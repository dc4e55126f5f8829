"""Declared schemas of all tables; nothing is ever inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from retailmarts.functions import columns

TEXT, WHOLE, DECIMAL, INSTANT, FLAG = (
    T.StringType(), T.LongType(), T.DoubleType(), T.TimestampType(), T.BooleanType(),
)


@dataclass(frozen=True)
class RawTable:
    """One raw file: typed columns, the keys it must have, and how its table is laid out."""

    columns: dict[str, T.DataType]
    required: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    cluster: tuple[str, ...] = ()
    month_of: str | None = None
    max_bad: int = 0
    multi_line: bool = False

    @property
    def names(self) -> list[str]:
        return list(self.columns)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t) for n, t in self.columns.items()])


# Columns, required keys, partitioning, clustering and bad-record budgets.
RAW: dict[str, RawTable] = {
    "orders": RawTable(
        {
            "order_id": TEXT,
            "customer_id": TEXT,
            "order_status": TEXT,
            "order_purchase_timestamp": INSTANT,
            "order_approved_at": INSTANT,
            "order_delivered_carrier_date": INSTANT,
            "order_delivered_customer_date": INSTANT,
            "order_estimated_delivery_date": INSTANT,
        },
        required=("order_id", "customer_id"),
        key=("order_id",),
        cluster=("order_status",),
        month_of="order_purchase_timestamp",
    ),
    "order_items": RawTable(
        {
            "order_id": TEXT,
            "order_item_id": WHOLE,
            "product_id": TEXT,
            "seller_id": TEXT,
            "shipping_limit_date": INSTANT,
            "price": DECIMAL,
            "freight_value": DECIMAL,
        },
        required=("order_id",),
        key=("order_id", "order_item_id"),
        cluster=("seller_id", "product_id"),
    ),
    "payments": RawTable(
        {
            "order_id": TEXT,
            "payment_sequential": WHOLE,
            "payment_type": TEXT,
            "payment_installments": WHOLE,
            "payment_value": DECIMAL,
        },
        required=("order_id",),
        key=("order_id", "payment_sequential"),
        cluster=("payment_type",),
    ),
    # Free text with quoted line breaks: loaded as text, cast only after the repair.
    "reviews": RawTable(
        {
            "review_id": TEXT,
            "order_id": TEXT,
            "review_score": TEXT,
            "review_comment_title": TEXT,
            "review_comment_message": TEXT,
            "review_creation_date": TEXT,
            "review_answer_timestamp": TEXT,
        },
        key=("review_id",),
        max_bad=500,
        multi_line=True,
    ),
    "customers": RawTable(
        {
            "customer_id": TEXT,
            "customer_unique_id": TEXT,
            "customer_zip_code_prefix": TEXT,
            "customer_city": TEXT,
            "customer_state": TEXT,
        },
        required=("customer_id",),
        key=("customer_id",),
        cluster=("customer_state",),
    ),
    "products": RawTable(
        {
            "product_id": TEXT,
            "product_category_name": TEXT,
            "product_name_length": WHOLE,
            "product_description_length": WHOLE,
            "product_photos_qty": WHOLE,
            "product_weight_g": DECIMAL,
            "product_length_cm": DECIMAL,
            "product_height_cm": DECIMAL,
            "product_width_cm": DECIMAL,
        },
        required=("product_id",),
        key=("product_id",),
        cluster=("product_category_name",),
    ),
    "sellers": RawTable(
        {
            "seller_id": TEXT,
            "seller_zip_code_prefix": TEXT,
            "seller_city": TEXT,
            "seller_state": TEXT,
        },
        required=("seller_id",),
        key=("seller_id",),
        cluster=("seller_state",),
    ),
    "geolocation": RawTable(
        {
            "geolocation_zip_code_prefix": TEXT,
            "geolocation_lat": DECIMAL,
            "geolocation_lng": DECIMAL,
            "geolocation_city": TEXT,
            "geolocation_state": TEXT,
        },
        required=("geolocation_zip_code_prefix",),
        cluster=("geolocation_state",),
    ),
    "category_translation": RawTable(
        {
            "product_category_name": TEXT,
            "product_category_name_english": TEXT,
        },
        key=("product_category_name",),
    ),
}

ENRICHED: dict[str, T.StructType] = {
    "orders_enriched": T.StructType(
        RAW["orders"].schema.fields
        + [
            T.StructField("delivery_delay_days", WHOLE),
            T.StructField("is_late_delivery", FLAG),
            T.StructField("customer_state", TEXT),
            T.StructField("customer_city", TEXT),
            T.StructField("customer_zip_code_prefix", TEXT),
            T.StructField("customer_unique_id", TEXT),
        ]
    ),
    "order_items_enriched": T.StructType(
        RAW["order_items"].schema.fields
        + [
            T.StructField("seller_state", TEXT),
            T.StructField("seller_city", TEXT),
            T.StructField("product_category_name", TEXT),
            T.StructField("product_category_name_english", TEXT),
        ]
    ),
    "payments": RAW["payments"].schema,
    "geolocation_deduped": T.StructType(
        [
            T.StructField("zip_code_prefix", TEXT),
            T.StructField("avg_lat", DECIMAL),
            T.StructField("avg_lng", DECIMAL),
            T.StructField("geolocation_state", TEXT),
            T.StructField("geolocation_city", TEXT),
        ]
    ),
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in order, with the declared types."""
    return df.select(
        columns(**{f.name: f"CAST({f.name} AS {f.dataType.simpleString()})" for f in schema.fields})
    )
