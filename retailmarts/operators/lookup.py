"""Left joins to tables with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmarts.functions import columns, once
from retailmarts.functions import text as X

_SPREAD = "_key_hash"
JOINED = "_joined_key"
#: Values that stand for a blank key, so that its rows are spread over as many places.
_PLACES = 10_000


def pack(df: DataFrame, *ids: str) -> DataFrame:
    """``df`` with some of its ids as bytes, which take half the space in a shuffle.

    A generator, as in ``once``: later filters on an id do not repeat its packing."""
    made = once(**{f"_{c}": X.packed(c) for c in ids})
    return df.select(*[c for c in df.columns if c not in ids], made).select(*columns(**{c: f"_{c}" if c in ids else c for c in df.columns}))


def unpack(df: DataFrame, *ids: str) -> DataFrame:
    """The ids that ``pack`` made bytes of as they were."""
    return df.select(*columns(**{c: X.unpacked(c) if c in ids else c for c in df.columns}))


def one_per_key(df: DataFrame, key: str, wanted: list[str]) -> DataFrame:
    """One row per key: the smallest tuple of the wanted columns, the same on every run.

    Duplicates of a key collapse before the shuffle.
    """
    first = columns(_first=f"min(struct({', '.join(wanted)}))")
    return df.where(f"{key} IS NOT NULL").groupBy(key).agg(*first).select(key, "_first.*")


def of_blank(df: DataFrame, key: str, **aggregates: str) -> DataFrame:
    """The aggregates of the rows whose key is blank: one row, or none if there are no such rows.

    Without grouping, the rows are combined where they are."""
    whole = df.where(f"{key} = ''").agg(*columns(_rows="count(*)", **aggregates))
    return whole.where("_rows > 0").drop("_rows")


def _join(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Join to an aggregation on ``key`` such that a hot key of ``left`` can be split.

    ``right`` is already partitioned by the key, and Spark would join in that partitioning, where
    adaptive execution cannot split anything.  With a bit of the key's hash as a second join key both sides are
    shuffled for the join itself, and it can.  A bit takes no space in the shuffle, the whole hash would.  A side that Spark finds small enough is broadcast
    instead.
    """
    spread = F.pmod(F.xxhash64(key), F.lit(2))
    joined = left.withColumn(_SPREAD, spread).join(right.withColumn(_SPREAD, spread), [key, _SPREAD], how)
    return joined.drop(_SPREAD)


def attach(
    left: DataFrame, right: DataFrame, key: str, blank: DataFrame | None = None, by: list[str] | None = None
) -> DataFrame:
    """``left`` with the columns of ``right``, which has at most one row per ``key``.

    Any key may be frequent.  Where none can be but the blank one, which records without a key share,
    ``blank`` is what ``of_blank`` gives for ``right``: a plain join then uses the partitioning that the
    aggregated side has.  For it each blank or NULL key is one of many values that match nothing, so those rows
    are spread; they get the one row of ``blank`` afterwards.  With ``by``, the value follows from these columns,
    and the column ``JOINED`` stays, by which the result is partitioned.
    """
    if blank is None:
        return _join(left, right, key, "left")
    places = f"concat('\\0', pmod(xxhash64({', '.join(by or left.columns)}), {_PLACES}))"
    marked = left.withColumn(JOINED, F.expr(f"CASE WHEN {key} <> '' THEN {key} ELSE {places} END"))
    found = marked.join(right.withColumnRenamed(key, JOINED), JOINED, "left")
    added = [c for c in right.columns if c != key]
    one = blank.selectExpr(*[f"{c} AS _blank_{c}" for c in added])
    whole = found.join(F.broadcast(one), F.expr(f"{key} = ''"), "left")  # one row
    filled = columns(**{c: f"CASE WHEN {key} = '' THEN _blank_{c} ELSE {c} END" for c in added})
    return whole.select(*left.columns, *([JOINED] if by else []), *filled)


def attach_to_few(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``attach`` where ``left`` is an aggregation of one row per key."""
    return left.join(right, key, "left")


def lookup(
    left: DataFrame, right: DataFrame, key: str, wanted: list[str], missing: str | None = None,
    hot: bool = True, placed: bool = False,
) -> DataFrame:
    """First match of ``right`` for every row of ``left``; ``missing`` where there is none.

    With ``hot=False`` no key of ``left`` is frequent but the blank one.  With ``placed`` both are tables
    with as many buckets of the key, and nothing is shuffled."""
    if placed:
        filled = columns(**{c: c if missing is None else f"coalesce({c}, '{missing}')" for c in wanted})
        return left.join(one_per_key(right, key, wanted), key, "left").select(*left.columns, *filled)
    blank = None if hot else of_blank(right, key, _first=f"min(struct({', '.join(wanted)}))").select("_first.*")
    found = {c: c if missing is None else f"coalesce({c}, '{missing}')" for c in wanted}
    return attach(left, one_per_key(right, key, wanted), key, blank).select(*left.columns, *columns(**found))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose key has no row in ``parent``; a NULL key refers to nothing.

    The parent's keys are made distinct first, so that one it repeats often is never gathered.
    """
    keys = parent.selectExpr(f"{parent_key} AS {child_key}").distinct()
    found = _join(child.where(f"{child_key} IS NOT NULL"), keys, child_key, "left_anti")
    return found.select(child.columns)
