"""Data-quality checks, each a Spark job that returns its findings as rows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from retailmarts.functions import columns
from retailmarts.functions.exact import money, percent, sum_units
from retailmarts.functions.labels import (
    GRADES,
    LOWEST_GRADE,
    LOWEST_TIER,
    PAYMENT_LABELS,
    TIERS,
    VALID_STATUSES,
    listed,
)
from retailmarts.operators.lookup import orphans

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Check:
    """One declared column test."""

    table: str
    column: str
    test: str
    values: tuple[str, ...] = ()


# The declared column tests.
_NOT_NULL = {
    "orders_enriched": ["order_id", "customer_id", "order_status"],
    "order_items_enriched": ["order_id", "product_id", "seller_id"],
    "payments": ["order_id", "payment_value"],
    "geolocation_deduped": ["zip_code_prefix"],
    "stg_orders": ["order_id", "customer_id", "order_status"],
    "stg_order_items": ["order_id", "product_id", "seller_id", "price"],
    "stg_payments": ["order_id", "payment_value"],
    "stg_geolocation": ["zip_code_prefix", "latitude", "longitude"],
    "mart_order_kpis": ["order_month", "total_orders", "gmv_brl"],
    "mart_seller_performance": ["seller_id", "total_revenue_brl"],
    "mart_delivery_performance": ["customer_state"],
    "mart_geo_sales": ["state", "total_gmv_brl"],
    "mart_payment_analysis": ["payment_type", "order_month"],
}
_UNIQUE = {
    "orders_enriched": "order_id",
    "geolocation_deduped": "zip_code_prefix",
    "stg_orders": "order_id",
    "stg_geolocation": "zip_code_prefix",
    "mart_order_kpis": "order_month",
    "mart_seller_performance": "seller_id",
    "mart_delivery_performance": "customer_state",
    "mart_geo_sales": "state",
}
_ACCEPTED = {
    ("stg_orders", "order_status"): VALID_STATUSES,
    ("stg_payments", "payment_type"): [*PAYMENT_LABELS.values(), "Unknown"],
    ("mart_seller_performance", "seller_tier"): [LOWEST_TIER, *(name for _, name in TIERS)],
    ("mart_delivery_performance", "delivery_grade"): [*(name for _, name in GRADES), LOWEST_GRADE],
}
CHECKS: list[Check] = (
    [Check(t, c, "not_null") for t, columns in _NOT_NULL.items() for c in columns]
    + [Check(t, c, "unique") for t, c in _UNIQUE.items()]
    + [Check(t, c, "accepted_values", tuple(v)) for (t, c), v in _ACCEPTED.items()]
)

# Fixed values: (child table, key, parent table, key) of every relationship.
RELATIONSHIPS = [
    ("reviews", "order_id", "orders", "order_id"),
    ("payments", "order_id", "orders", "order_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("customers", "customer_zip_code_prefix", "geolocation", "geolocation_zip_code_prefix"),
    ("sellers", "seller_zip_code_prefix", "geolocation", "geolocation_zip_code_prefix"),
    ("products", "product_category_name", "category_translation", "product_category_name"),
]


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(f"{column} IS NULL")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once; NULL keys are no keys."""
    return (
        df.where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
        .groupBy(*keys)
        .agg(*columns(n_rows="count(*)"))
        .where("n_rows > 1")
    )


def unexpected_values(df: DataFrame, column: str, values) -> DataFrame:
    """Values outside the list, with their number of rows."""
    outside = df.where(f"{column} NOT IN ({listed(values)})")
    return outside.groupBy(column).agg(*columns(n_rows="count(*)"))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _as_rows(df: DataFrame, findings: list[dict[str, str]]) -> DataFrame:
    """One pass over ``df``: a row per finding, whose columns are aggregate expressions."""
    structs = [
        "named_struct(" + ", ".join(f"'{name}', {sql}" for name, sql in finding.items()) + ")"
        for finding in findings
    ]
    return df.agg(*columns(found=f"array({', '.join(structs)})")).selectExpr("inline(found)")


def _finding(check: Check, failures: str) -> dict[str, str]:
    return {
        "table_name": f"'{check.table}'",
        "column_name": f"'{check.column}'",
        "test": f"'{check.test}'",
        "failures": failures,
    }


def run_checks(tables: Tables, checks: list[Check] = CHECKS) -> DataFrame:
    """Failures per check: NULL rows, duplicated values, or distinct unexpected values.

    All not-null and accepted-values checks of a table share one pass over it.
    """

    def counted(check: Check) -> str:
        if check.test == "not_null":
            return f"count_if({check.column} IS NULL)"
        inside = f"{check.column} IN ({listed(check.values)})"
        return f"count(DISTINCT CASE WHEN NOT {inside} THEN {check.column} END)"

    parts = []
    for name in dict.fromkeys(c.table for c in checks):
        mine = [c for c in checks if c.table == name]
        findings = [_finding(c, counted(c)) for c in mine if c.test != "unique"]
        if findings:
            parts.append(_as_rows(tables[name], findings))
        parts += [
            _as_rows(duplicate_keys(tables[name], c.column), [_finding(c, "count(*)")])
            for c in mine
            if c.test == "unique"
        ]
    return union(parts)


def checks_of(test: str) -> list[Check]:
    return [c for c in CHECKS if c.test == test]


def primary_key_findings(raw: Tables, keys: dict[str, tuple[str, ...]]) -> DataFrame:
    """Per raw table: rows with a NULL or blank part of the key, and keys that occur twice."""
    parts = []
    for name, key in keys.items():
        missing = " OR ".join(f"coalesce(string({k}), '') = ''" for k in key)
        table_name, nothing = f"'{name}'", "0L"
        parts += [
            raw[name].agg(*columns(table_name=table_name, null_keys=f"count_if({missing})", duplicate_keys=nothing)),
            duplicate_keys(raw[name], *key).agg(
                *columns(table_name=table_name, null_keys=nothing, duplicate_keys="count(*)")
            ),
        ]
    sums = columns(null_keys="sum(null_keys)", duplicate_keys="sum(duplicate_keys)")
    return union(parts).groupBy("table_name").agg(*sums)


def orphan_counts(raw: Tables, relationships=RELATIONSHIPS) -> DataFrame:
    """Rows per relationship whose key has no parent."""
    return union([
        orphans(raw[child], raw[parent], child_key, parent_key).agg(
            *columns(child=f"'{child}.{child_key}'", parent=f"'{parent}.{parent_key}'", orphans="count(*)")
        )
        for child, child_key, parent, parent_key in relationships
    ])


def null_rates(df: DataFrame, *names: str) -> DataFrame:
    """Per column: rows, NULL rows and their percentage, in one pass."""
    return _as_rows(df, [
        {
            "column_name": f"'{c}'",
            "n_rows": "count(*)",
            "null_rows": f"count_if({c} IS NULL)",
            "null_pct": percent(f"count_if({c} IS NULL)", "count(*)"),
        }
        for c in names
    ])


def date_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        *columns(
            first_at=f"min({column})",
            last_at=f"max({column})",
            months=f"count(DISTINCT date_format({column}, 'yyyy-MM'))",
        )
    )


def total_gmv(items: DataFrame) -> DataFrame:
    return items.agg(*columns(gmv_brl=money(sum_units("price"))))


def non_positive_prices(items: DataFrame) -> DataFrame:
    return items.where("price <= 0")


def report(findings: DataFrame) -> DataFrame:
    """Findings with a pass or fail status."""
    return findings.select("*", *columns(status="CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END"))


def validations(raw: Tables, keys: dict[str, tuple[str, ...]]) -> DataFrame:
    """All validations of the raw tables as one report: validation, subject, measure, status.

    The status is pass or fail, or info where a measure has no right value.  Each table is read once for all
    that one pass can tell; only duplicates and orphans read it again."""

    def told(validation: str, subject: str, measure: str, passes: str | None) -> dict[str, str]:
        status = "'info'" if passes is None else f"CASE WHEN {passes} THEN 'pass' ELSE 'fail' END"
        return {"validation": f"'{validation}'", "subject": f"'{subject}'", "measure": f"double({measure})", "status": status}

    def none(validation: str, subject: str, count: str) -> dict[str, str]:
        return told(validation, subject, count, f"{count} = 0")

    def distinct(value: str) -> str:
        return f"count(DISTINCT {value})"

    unexpected = distinct(f"CASE WHEN order_status NOT IN ({listed(VALID_STATUSES)}) THEN order_status END")
    months, gmv = distinct("date_format(order_purchase_timestamp, 'yyyy-MM')"), money(sum_units("price"))
    instants = [
        "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ]
    special = {
        "orders": [
            *[told("null_rate", c, percent(f"count_if({c} IS NULL)", "count(*)"), None) for c in instants],
            none("order_status", "orders", unexpected),
            told("date_range", "orders", months, f"{months} > 0"),
        ],
        "order_items": [
            told("total_gmv", "order_items", gmv, f"coalesce({gmv}, 0D) > 0"),
            none("positive_price", "order_items", "count_if(price <= 0)"),
        ],
        "payments": [told("payment_type", "payments", distinct("payment_type"), None)],
    }
    parts = []
    for name in raw.makers:
        findings = [told("row_count", name, "count(*)", "count(*) > 0"), *special.get(name, [])]
        if name in keys:
            missing = " OR ".join(f"coalesce(string({k}), '') = ''" for k in keys[name])
            findings.append(none("null_keys", name, f"count_if({missing})"))
            parts.append(_as_rows(duplicate_keys(raw[name], *keys[name]), [none("duplicate_keys", name, "count(*)")]))
        parts.append(_as_rows(raw[name], findings))
    zips = duplicate_keys(raw["geolocation"], "geolocation_zip_code_prefix")
    parts.append(_as_rows(zips, [told("multi_row_zip", "geolocation", "count(*)", None)]))
    orphaned = orphan_counts(raw).select(*columns(
        validation="'orphans'", subject="child", measure="double(orphans)",
        status="CASE WHEN orphans = 0 THEN 'pass' ELSE 'fail' END",
    ))
    return union([*parts, orphaned])
