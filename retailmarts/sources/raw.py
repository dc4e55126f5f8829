"""Raw delimited files: lenient parsing, rejects, strict loading with a bad-record budget."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailmarts.functions import columns, once
from retailmarts.functions import text as X
from retailmarts.functions.exact import OVERSIZE
from retailmarts.sources import records as R
from retailmarts.sources.schemas import DECIMAL, INSTANT, RAW, TEXT, WHOLE

BROKEN = "_broken_record"  # the whole record where its number of fields is wrong, else NULL

_CONVERT = {TEXT: X.text, WHOLE: X.to_bigint, DECIMAL: X.to_double, INSTANT: X.to_instant}


# Files are read as whole lines: a column separator and quotes that no line holds.  The reader still drops
# the header of each file and splits large files into many tasks.
_LINES = {"sep": "\u0001\u0002\u0001\u0002", "quote": "", "escape": ""}


def scan(
    spark: SparkSession, table: str, path: str, multi_line: bool | None = None, header: bool = True
) -> DataFrame:
    """All records of the file(s) at ``path`` as untyped fields plus ``_broken_record``.

    The first record of each file is a header.  Files split into many tasks, and a record has any length and
    number of fields.  One line is one record; with ``multi_line`` (by default for reviews) quoted text may
    hold line breaks, for which the lines are shuffled once.
    """
    multi_line = RAW[table].multi_line if multi_line is None else multi_line
    if multi_line:
        return scan_lines(R.records(R.file_lines(spark, path), header), table)
    lines = spark.read.schema("line string").options(**_LINES, header=header).csv(path)
    return scan_lines(lines, table)


def scan_stream(
    spark: SparkSession, table: str, path: str, header: bool = True, files_per_batch: int = 10_000,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Like ``scan`` for files as they arrive in the folder ``path`` and the folders below; ``keep`` are
    expressions on a file's ``_metadata`` that are carried along."""
    options = {**_LINES, "header": header, "maxFilesPerTrigger": files_per_batch, "recursiveFileLookup": True}
    lines = spark.readStream.schema("line string").options(**options).csv(path)
    return scan_lines(lines.selectExpr("line", *keep), table)


def scan_lines(lines: DataFrame, table: str, column: str = "line") -> DataFrame:
    """Like ``scan`` for records that are already rows of text; blank lines are no records.  Other columns
    are carried along."""
    names = RAW[table].names
    others = [c for c in lines.columns if c != column]
    # A generator, as in ``once``: each record is parsed one time.
    made = once(
        _fields=X.csv_fields(column), _record=column, _blank=f"{X.stripped(column)} = ''",
        **{c: c for c in others},
    )
    parsed = lines.where(f"{column} IS NOT NULL").select(made).where("NOT _blank")
    fits = f"size(_fields) = {len(names)}"
    found = {n: f"CASE WHEN {fits} THEN nullif(get(_fields, {i}), '') END" for i, n in enumerate(names)}
    found[BROKEN] = f"CASE WHEN NOT {fits} THEN _record END"
    return parsed.select(*columns(**found), *others)


def _and_a_field(condition: str, table: str) -> str:
    """``condition`` on the broken record, which Spark refuses to read alone, with a field next to it."""
    return f"{condition} AND length(coalesce({RAW[table].names[0]}, '')) >= 0"


def parse(records: DataFrame, table: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed rows; records with a wrong number of fields or an oversize amount are dropped, bad values
    become NULL."""
    spec = RAW[table].columns
    fields = columns(**{n: X.stripped(n) for n in spec})
    typed = columns(**{n: _CONVERT[t](n) for n, t in spec.items()})
    whole = records.where(_and_a_field(f"{BROKEN} IS NULL", table))
    rows = whole.select(*fields, *keep).select(*typed, *keep)
    amounts = [n for n, t in spec.items() if t == DECIMAL]
    if not amounts:
        return rows
    # A generator, as in ``once``: the optimiser would copy all that makes an amount into the filter, several times,
    # and code of that length is not compiled.
    made = once(**{f"_{n}": n for n in amounts})
    big = " OR ".join(f"abs(_{n}) >= {OVERSIZE}D" for n in amounts)
    kept = rows.select(*[n for n in rows.columns if n not in amounts], made).where(f"NOT coalesce({big}, false)")
    return kept.select(*columns(**{n: f"_{n}" if n in amounts else n for n in spec}), *keep)


def _oversize(table: str) -> str:
    """A decimal field that is a number, and one that sums have no room for."""
    amounts = [n for n, t in RAW[table].columns.items() if t == DECIMAL]
    # Nearly all amounts are short, which is all that is looked at; long ones have digits or an exponent.
    big = [
        f"(length({n}) > 14 OR {n} RLIKE '[eE]') AND abs(coalesce({X.to_double(X.stripped(n))}, 0D)) >= {OVERSIZE}D"
        for n in amounts
    ]
    return f"coalesce({' OR '.join(f'({b})' for b in big)}, false)" if big else "false"


def rejects(records: DataFrame, table: str) -> DataFrame:
    """The records ``parse`` drops: table and first 80 characters (of the fields, for an oversize amount)."""
    record = f"coalesce({BROKEN}, concat_ws(',', {', '.join(RAW[table].names)}))"
    return records.where(_and_a_field(f"({BROKEN} IS NOT NULL OR {_oversize(table)})", table)).select(
        *columns(table_name=f"'{table}'", record_start=f"substring({record}, 1, 80)")
    )


def read_raw(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Parsed rows of the file(s) at ``path``."""
    return parse(scan(spark, table, path), table)


def check_load(records: DataFrame, table: str) -> DataFrame:
    """Strictly typed rows with a ``_bad`` flag, the way a warehouse load would judge them.

    Missing trailing fields are NULL; surplus fields, values of the wrong type and missing or blank
    required keys make the row bad.  Text is kept as it is, with its blanks.
    """
    spec = RAW[table]
    fields = {
        n: f"CASE WHEN {BROKEN} IS NULL THEN {n} ELSE nullif(get(_fields, {i}), '') END"
        for i, n in enumerate(spec.names)
    }
    clean = {n: n if t == TEXT else X.stripped(n) for n, t in spec.columns.items()}
    surplus = _and_a_field(f"{BROKEN} IS NOT NULL AND size(_fields) > {len(spec.names)}", table)
    typed = {n: n if t == TEXT else _CONVERT[t](n) for n, t in spec.columns.items()}
    # Of the typed fields, as many must have a value as are filled in.
    checked = [n for n, t in spec.columns.items() if t != TEXT]
    filled = " + ".join(["0", *(f"int(coalesce({n} <> '', false))" for n in checked)])
    valued = " + ".join(["0", *(f"int({n} IS NOT NULL)" for n in checked)])
    keyless = " OR ".join(["false", *(f"coalesce({X.stripped(f'string({n})')}, '') = ''" for n in spec.required)])
    return (
        records.select("*", *columns(_fields=X.csv_fields(BROKEN)))
        .select(columns(**fields, _surplus=surplus))
        .select(once(**clean, _surplus="_surplus"))
        .select(columns(**typed, _surplus="_surplus", _filled=filled))
        .select(*spec.names, *columns(_bad=f"_surplus OR _filled <> {valued} OR {keyless}"))
    )


def load_report(checked: DataFrame, table: str, max_bad: int | None = None) -> DataFrame:
    """One row: accepted and bad rows, the budget, and whether the load passes."""
    budget = RAW[table].max_bad if max_bad is None else max_bad
    return checked.agg(
        *columns(
            table_name=f"'{table}'",
            row_count="count_if(NOT _bad)",
            bad_records="count_if(_bad)",
            max_bad=f"{budget}L",
            passes=f"count_if(_bad) <= {budget}",
        )
    )


class BadRecordBudgetExceeded(RuntimeError):
    """A load met more bad records than its table tolerates."""


def within_budget(bad: int, table: str, max_bad: int | None = None) -> None:
    budget = RAW[table].max_bad if max_bad is None else max_bad
    if bad > budget:
        raise BadRecordBudgetExceeded(f"{table}: {bad} bad records, at most {budget} allowed")
