"""Repair of review records whose unquoted text has shifted the columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retailmarts.functions import columns, once
from retailmarts.functions import text as X
from retailmarts.functions.exact import percent
from retailmarts.sources import layers, raw
from retailmarts.sources.raw import BROKEN
from retailmarts.sources.schemas import RAW

NAMES = RAW["reviews"].names
GOOD, RECONSTRUCTED, SKIPPED = "already_good", "reconstructed", "skipped"


def _rebuilt(fields: str, places: str) -> str:
    """Seven fields rebuilt around the ids, the score and the last two timestamps, or NULL.

    Of what lies between score and creation date the first field is the title, the rest the message.
    With one timestamp there is no answer date; without any the record is lost.  Text after the
    creation date that is not the last timestamp is lost too.
    """
    anchored = " AND ".join([
        f"size({fields}) >= 3",
        X.is_hex_id(f"get({fields}, 0)"),
        X.is_hex_id(f"get({fields}, 1)"),
        X.is_score(f"get({fields}, 2)"),
        f"size({places}) >= 1",
    ])
    two = f"size({places}) >= 2"
    created_at = f"get({places}, greatest(size({places}) - 2, 0))"
    answered_at = f"get({places}, size({places}) - 1)"
    middle = f"slice({fields}, 4, {created_at} - 3)"
    message = f"array_join(slice({fields}, 5, greatest({created_at} - 4, 0)), ', ')"
    rebuilt = ", ".join([
        *(f"get({fields}, {i})" for i in range(3)),
        f"coalesce(get({middle}, 0), '')",
        message,
        f"get({fields}, {created_at})",
        f"CASE WHEN {two} THEN get({fields}, {answered_at}) ELSE '' END",
    ])
    return f"CASE WHEN {anchored} THEN array({rebuilt}) END"


def classify(records: DataFrame) -> DataFrame:
    """Untyped review records → seven text columns and the outcome of each record.

    A record with seven fields is kept as it is, whatever they hold.  Any other is rebuilt if its
    anchors allow, else skipped, with all columns NULL.
    """
    whole = f"{BROKEN} IS NULL"
    kept = ", ".join(f"coalesce({n}, '')" for n in NAMES)
    fields = f"transform({X.csv_fields(BROKEN)}, f -> {X.stripped('f')})"
    places = f"filter(transform(_fields, (f, i) -> CASE WHEN {X.is_instant('f')} THEN i END), i -> i IS NOT NULL)"
    outcome = f"CASE WHEN _whole THEN '{GOOD}' WHEN _row IS NOT NULL THEN '{RECONSTRUCTED}' ELSE '{SKIPPED}' END"
    return (
        records.select("*", once(_fields=fields))
        .select("*", once(_places=places))
        .select(
            once(
                _whole=whole,
                _row=f"CASE WHEN {whole} THEN array({kept}) ELSE {_rebuilt('_fields', '_places')} END",
            )
        )
        .select(columns(**{n: f"get(_row, {i})" for i, n in enumerate(NAMES)}, outcome=outcome))
    )


def check_header(spark: SparkSession, path: str) -> None:
    """Fail unless the header of every file has as many columns as a review.

    Only the first block of each file is read."""
    starts = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start").where(
        "file_block_start = 0"
    )
    headers = starts.selectExpr("value", "file_path", "monotonically_increasing_id() AS place").groupBy("file_path").agg(
        *columns(header="min_by(value, place)")
    )
    wrong = headers.select("file_path", *columns(n=f"size({X.csv_fields('header')})")).where(f"n <> {len(NAMES)}").head()
    if wrong is not None:
        raise ValueError(f"{wrong.file_path}: expected {len(NAMES)} header columns, got {wrong.n}")
    if not headers.head(1):
        raise ValueError(f"{path}: expected {len(NAMES)} header columns, got none")


def read_records(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Untyped records of the review file(s) at ``path``.

    A quoted message may hold line breaks: lines are put together to records after a shuffle, which
    ``multi_line=False`` saves where there are none.
    """
    check_header(spark, path)
    return raw.scan(spark, "reviews", path, multi_line)


def repair_file(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Write the repaired reviews of ``source`` with every field quoted; returns the statistics."""
    records = read_records(spark, source)
    layers.write_quoted_csv(reviews_clean(records), target)
    return reviews_stats(records)


def reviews_clean(records: DataFrame) -> DataFrame:
    """All records that could be kept or rebuilt, as text."""
    return classify(records).where(f"outcome <> '{SKIPPED}'").select(NAMES)


def reviews_stats(records: DataFrame) -> DataFrame:
    """One row: output, good, reconstructed and skipped records, recovery in percent."""
    output = f"count_if(outcome <> '{SKIPPED}')"
    return classify(records).agg(
        *columns(
            total_output=output,
            already_good=f"count_if(outcome = '{GOOD}')",
            reconstructed=f"count_if(outcome = '{RECONSTRUCTED}')",
            skipped=f"count_if(outcome = '{SKIPPED}')",
            recovery_rate=percent(output, "count(*)"),
        )
    )


def reviews_typed(clean: DataFrame) -> DataFrame:
    """Declared model: well-formed reviews with score and dates typed."""
    valid = [X.is_hex_id("review_id"), X.is_hex_id("order_id"), X.is_score("review_score")]
    return (
        clean.select(columns(**{n: X.stripped(n) for n in NAMES}))
        .where(" AND ".join(valid))
        .select(
            "review_id",
            "order_id",
            *columns(review_score=X.to_bigint("review_score")),
            "review_comment_title",
            "review_comment_message",
            *columns(**{n: X.to_instant(n) for n in ("review_creation_date", "review_answer_timestamp")}),
        )
        .where("review_creation_date IS NOT NULL")
    )
