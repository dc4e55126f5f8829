"""Given Parquet tables → raw retail tables, text records, and records with damage.

``_row`` numbers rows so that damage can be placed the same way in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailmarts.functions import columns
from retailmarts.sources.schemas import DECIMAL, INSTANT, RAW, TEXT, WHOLE
from retailmarts.sources.tables import Tables

DAMAGE_CLASSES = 31


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(key: str) -> str:
    """A hex id.  Keys are never NULL; saying so keeps Spark from hashing once more to filter on it."""
    return f"coalesce(md5(string({key})), '')"


def _after(days: str = "0", seconds: str = "0") -> str:
    """The purchase plus whole days and seconds."""
    return f"timestamp_seconds(unix_timestamp(timestamp(o_orderdate)) + ({days}) * 86400 + ({seconds}))"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = given(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = given(spark, sf_dir, "orders")
    return orders.join(customer, F.expr("o_custkey = c_custkey"), "left").select(columns(
        order_id=_id("o_orderkey"),
        customer_id=_id("o_custkey"),
        order_status="CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'"
                     " ELSE 'processing' END",
        order_purchase_timestamp="timestamp(o_orderdate)",
        order_approved_at=_after(seconds="o_orderkey % 48 * 3600"),
        order_delivered_carrier_date=_after("3"),
        order_delivered_customer_date="CASE WHEN o_orderstatus = 'F' AND o_orderkey % 33 <> 0 THEN "
                                      + _after("o_orderkey % 43", "o_orderkey * 7919 % 86400") + " END",
        order_estimated_delivery_date=_after("30 + c_nationkey % 10"),
        _row="o_orderkey",
    ))


def _order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "lineitem").select(columns(
        order_id=_id("l_orderkey"),
        order_item_id="bigint(l_linenumber)",
        product_id=_id("l_partkey"),
        seller_id=_id("l_suppkey"),
        shipping_limit_date="timestamp(l_shipdate)",
        price="(bigint(rint(l_extendedprice * 100D)) div CASE l_suppkey % 4 WHEN 0 THEN 100L"
              " WHEN 1 THEN 1000L WHEN 2 THEN 10000L ELSE 100000L END) / 100D",
        freight_value="l_quantity",
        _row="l_orderkey * 7 + l_linenumber",
    ))


def _payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = (
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto'"
        " WHEN '3-MEDIUM' THEN 'voucher' WHEN '4-NOT SPECIFIED' THEN 'debit_card' ELSE 'not_defined' END"
    )
    tenth = "(bigint(rint(o_totalprice * 100D)) div 10L) / 100D"
    names = "payment_sequential, payment_type, payment_installments, payment_value".split(", ")

    def payment(*values: str) -> str:
        return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in zip(names, values)) + ")"

    first = payment("1L", kind, "o_orderkey % 24 + 1", "o_totalprice")
    second = payment("2L", "'voucher'", "1L", f"CASE WHEN o_orderkey % 40 = 0 THEN 0D ELSE {tenth} END")
    return (
        given(spark, sf_dir, "orders")
        .selectExpr(
            "o_orderkey",
            f"inline(CASE WHEN o_orderkey % 20 = 0 THEN array({first}, {second}) ELSE array({first}) END)",
        )
        .selectExpr(
            f"{_id('o_orderkey')} AS order_id", "payment_sequential", "payment_type",
            "payment_installments", "payment_value", "o_orderkey * 2 + payment_sequential AS _row",
        )
    )


def _nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "nation").select("n_nationkey", "n_name")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = given(spark, sf_dir, "customer")
    return customer.join(_nation(spark, sf_dir), F.expr("c_nationkey = n_nationkey"), "left").select(columns(
        customer_id=_id("c_custkey"),
        customer_unique_id="md5('u' || c_custkey % 1000)",
        customer_zip_code_prefix="string(c_custkey % 12)",
        customer_city="'city_' || c_custkey % 50",
        customer_state="n_name",
        _row="c_custkey",
    ))


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "part").select(columns(
        product_id=_id("p_partkey"),
        product_category_name="CASE WHEN p_partkey % 50 = 0 THEN '' ELSE lower(p_type) END",
        product_name_length="bigint(length(p_name))",
        product_description_length="bigint(p_size * 10)",
        product_photos_qty="nullif(p_partkey % 6, 0L)",
        product_weight_g="double(p_size * 100)",
        product_length_cm="p_size + 0.5D",
        product_height_cm="p_size + 1D",
        product_width_cm="p_size + 2D",
        _row="p_partkey",
    ))


def _sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = given(spark, sf_dir, "supplier")
    return supplier.join(_nation(spark, sf_dir), F.expr("s_nationkey = n_nationkey"), "left").select(columns(
        seller_id=_id("s_suppkey"),
        seller_zip_code_prefix="string(s_suppkey % 15)",
        seller_city="'city_' || s_suppkey % 10",
        seller_state="n_name",
        _row="s_suppkey",
    ))


def _geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "embeddings").select(columns(
        geolocation_zip_code_prefix="string(label)",
        geolocation_lat="double(get(embedding, 0))",
        geolocation_lng="double(get(embedding, 1))",
        geolocation_city="'city_' || vec_id % 3",
        geolocation_state="'NATION_' || label",
        _row="vec_id",
    ))


def _category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = given(spark, sf_dir, "part").where("p_type <> 'PROMO'").select("p_type").distinct()
    return kinds.select(columns(
        product_category_name="lower(p_type)",
        product_category_name_english="'en_' || lower(p_type)",
        _row="bigint(length(p_type))",
    ))


_ONE_LINE = "translate(text, '\\t\\n\\u000b\\u000c\\r\"', '      ')"


def _reviews(spark: SparkSession, sf_dir: str, message: str = _ONE_LINE) -> DataFrame:
    """Reviews before any damage, by default with messages of one line."""

    def at(seconds: str) -> str:
        return f"date_format(timestamp_seconds(1514764800 + {seconds}), 'yyyy-MM-dd HH:mm:ss')"

    return given(spark, sf_dir, "documents").select(columns(
        review_id="md5('r' || doc_id)",
        order_id=_id("doc_id"),
        review_score="string(doc_id % 5 + 1)",
        review_comment_title="source",
        review_comment_message=message,
        review_creation_date=at("doc_id * 3600"),
        review_answer_timestamp=at("doc_id * 3600 + 86400"),
        _row="doc_id",
    ))


_MAPPINGS = {
    "orders": _orders,
    "order_items": _order_items,
    "payments": _payments,
    "reviews": _reviews,
    "customers": _customers,
    "products": _products,
    "sellers": _sellers,
    "geolocation": _geolocation,
    "category_translation": _category_translation,
}


def raw_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return _MAPPINGS[table](spark, sf_dir).select(RAW[table].names)


def raw_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables({name: (lambda name=name: raw_table(spark, sf_dir, name)) for name in RAW})


def damaged_lines(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The table as CSV records; the class ``_row % 31`` says what is wrong with each.

    1 last field missing; 2 one field too many; 3 all fields padded with whitespace; 4 typed fields
    hold garbage; 5 typed fields are blank; 6 text fields are quoted and hold a comma and quotes;
    7 whole numbers have a fraction, decimals are ``1e3``, instants have a fraction of a second.
    """
    garbage = {WHOLE: "5d", DECIMAL: "nan", INSTANT: "2018-02-30 10:00:00"}
    odd = {WHOLE: "'1.5'", DECIMAL: "'1e3'", INSTANT: "{c} || CASE WHEN {c} = '' THEN '' ELSE '.250' END"}

    def plain(name: str, kind) -> str:
        shown = f"date_format({name}, 'yyyy-MM-dd HH:mm:ss')" if kind == INSTANT else f"string({name})"
        return f"coalesce({shown}, '')"

    def damaged(name: str, kind) -> str:
        padded = f"WHEN 3 THEN ' \\t' || {name} || '  '"
        if kind == TEXT:
            return f"CASE _class {padded} WHEN 6 THEN '\"' || {name} || ', \"\"q\"\"\"' ELSE {name} END"
        return (
            f"CASE _class {padded} WHEN 4 THEN '{garbage[kind]}' WHEN 5 THEN ' '"
            f" WHEN 7 THEN {odd[kind].format(c=name)} ELSE {name} END"
        )

    spec = RAW[table].columns
    as_text = columns(**{n: plain(n, t) for n, t in spec.items()}, _class=f"_row % {DAMAGE_CLASSES}")
    fields = columns(**{n: damaged(n, t) for n, t in spec.items()}, _class="_class")
    names = RAW[table].names
    whole, short = (f"concat_ws(',', {', '.join(n)})" for n in (names, names[:-1]))
    line = f"CASE _class WHEN 1 THEN {short} WHEN 2 THEN {whole} || ',surplus' ELSE {whole} END"
    return _MAPPINGS[table](spark, sf_dir).select(as_text).select(fields).select(columns(line=line))


def told_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews as their author wrote them: messages with line breaks, commas and quotes."""
    return _reviews(spark, sf_dir, "text").select(RAW["reviews"].names)


def review_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews as CSV records: every 4th has an unquoted message, every 10th lacks the answer date,
    every 50th has a broken id."""
    message = "review_comment_message"
    fields = [
        "CASE WHEN _row % 50 = 0 THEN 'x' || review_id ELSE review_id END",
        "order_id",
        "review_score",
        "review_comment_title",
        f"CASE WHEN _row % 4 = 0 THEN {message} ELSE '\"' || {message} || '\"' END",
        "review_creation_date",
        # concat_ws leaves a NULL out together with its comma.
        "CASE WHEN _row % 10 <> 0 THEN review_answer_timestamp END",
    ]
    return _reviews(spark, sf_dir).select(columns(line=f"concat_ws(',', {', '.join(fields)})"))
