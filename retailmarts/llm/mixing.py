"""Mixing sources to target weights by highest quotients (Sainte-Laguë).

The documents of a source form one stream of words in a seeded order.  The stream is cut into equal
blocks, and runs of as many blocks form equal shards.  Sources get whole blocks by the highest quotients
``ideal / (2k + 1)``; so do the shards of a source, which weigh the same, so that ties decide, in seeded
order.  A shard takes whole passes over its blocks and one run of neighbouring blocks from a seeded
start: as the stream's order is random the run is a random choice, and documents stay whole but at its
two ends.  Block numbers are arithmetic on word offsets; there is no row per block anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmarts.llm.common import Scratch, running_sums, word_count

#: Words of a block, blocks of a shard, weights by rank of the source, most passes over a source.
BLOCK = 16
SHARD = 4096
WEIGHTS = (1, 2, 3)
PASSES = 3
SEED = 7


def water_level(sources: DataFrame) -> float:
    """The level whose targets ``least(PASSES * size, level * weight)`` add up to all sizes.

    Each pass over the sources raises the level by what capped sources leave; it stops when no further
    source is above its cap.  Only the level itself comes to the driver."""
    cap = F.col("size") * F.lit(float(PASSES))
    row = sources.agg(F.sum("size").alias("all"), F.sum("weight").alias("weights")).first()
    if not row["all"]:
        return 0.0
    level, total = row["all"] / row["weights"], row["all"]
    while True:
        above = cap < F.lit(level) * F.col("weight")
        row = sources.agg(
            F.sum(F.when(above, cap)).alias("capped"), F.sum(F.when(~above, F.col("weight"))).alias("free")
        ).first()
        if not row["free"]:
            return level
        risen = (total - (row["capped"] or 0.0)) / row["free"]
        if risen <= level:
            return level
        level = risen


def highest_quotients(parties: DataFrame, weight: str, seats: int, order: list, scratch: Scratch) -> DataFrame:
    """Add ``seats``: how many of the highest ``seats`` quotients weight/1, weight/3, weight/5 ... each
    row has.  Ties go to the rows that come first in ``order``.

    The lowest winning quotient is enclosed by counting, for 31 limits a pass, until at most one
    quotient of a row is in doubt; those are then ranked.  Weights of zero or null get nothing."""
    share = parties.where(F.col(weight) > 0).agg(F.sum(weight).alias("all"), F.count("*").alias("n")).first()
    if seats <= 0 or not share["n"]:
        return parties.withColumn("seats", F.lit(0).cast("long"))

    def won(limit: float):
        return F.coalesce(F.floor((F.col(weight) / F.lit(limit) + 1) / 2), F.lit(0)).cast("long")

    # Rounding moves a row by at most half a seat, which encloses the limit.
    low = share["all"] / (seats + share["n"] / 2) / 2 * (1 - 1e-9)
    high = share["all"] / max(seats - share["n"] / 2, 0.25) / 2 * (1 + 1e-9)
    while True:
        steps = [low + (high - low) * i / 32 for i in range(1, 32)]
        row = parties.agg(
            F.max(won(low) - won(high)).alias("doubt"), *[F.sum(won(x)).alias(f"c{i}") for i, x in enumerate(steps)]
        ).first()
        if row["doubt"] <= 1 or high / low <= 1 + 1e-14:
            break
        counts = [row[f"c{i}"] for i in range(len(steps))]
        low, high = (
            max([x for x, c in zip(steps, counts) if c >= seats], default=low),
            min([x for x, c in zip(steps, counts) if c < seats], default=high),
        )
    counted = parties.withColumns({"_sure": won(high), "_tie": won(low) - won(high)})
    counted = counted.withColumn("_next", F.col(weight) / (2 * F.col("_sure") + 1))
    left = seats - counted.agg(F.sum("_sure")).first()[0]
    placed = running_sums(counted, [F.col("_next").desc_nulls_last(), *order], {"_before": "_tie"}, scratch)
    extra = F.greatest(F.lit(0), F.least(F.col("_tie"), F.lit(left) - F.col("_before")))
    return placed.withColumn("seats", (F.col("_sure") + extra).cast("long")).drop("_sure", "_tie", "_next", "_before")


def plan_sources(sized: DataFrame, scratch: Scratch, seed: int) -> DataFrame:
    """One row per source: size, start of its stream, target, shards, blocks of a shard, quota in blocks."""
    order = [F.col("source").asc_nulls_last()]
    totals = sized.groupBy("source").agg(F.sum("_size").alias("size")).withColumn("_one", F.lit(1).cast("long"))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("_rank") % len(WEIGHTS) + 1).cast("int"))
    sources = running_sums(totals, order, {"start": "size", "_rank": "_one"}, scratch)
    sources = scratch.save(sources.select("source", "size", "start", weight.alias("weight")))
    level = water_level(sources)
    shards = F.greatest(F.lit(1), F.round(F.col("size") / (BLOCK * SHARD))).cast("long")
    sources = (
        sources.withColumn("target", F.least(F.col("size") * float(PASSES), F.col("weight") * level))
        .withColumn("shards", shards)
        .withColumn("blocks", F.greatest(F.lit(1), F.round(F.col("size") / (F.col("shards") * BLOCK))).cast("long"))
        .withColumn("words", F.col("size") / (F.col("shards") * F.col("blocks")))  # of a block
        .withColumn("ideal", F.when(F.col("words") > 0, F.col("target") / F.col("words")))
    )
    seats = sources.agg(F.round(F.sum("ideal"))).first()[0] or 0
    seated = highest_quotients(sources, "ideal", int(seats), order, scratch)
    most = F.col("shards") * F.col("blocks") * PASSES
    return scratch.save(seated.select(
        F.col("source").alias("_source"), F.col("size").alias("source_size"), F.col("start").alias("_start"),
        "target", F.col("shards").alias("_shards"), F.col("blocks").alias("_blocks"), F.col("words").alias("_words"),
        F.least("seats", most).alias("_quota"), F.xxhash64(F.lit(seed), F.col("source")).alias("_seed"),
    ))


#: The parts of a document, in its own words, that pass number ``p`` takes: for each shard that the
#: document touches, all of it, or what the run covers, in up to two pieces.
_EDGE = (
    "CASE WHEN {k} >= _shards * _blocks THEN source_size ELSE CAST(floor(({k}) * _words) AS BIGINT) END"
)
_SHARD = f"""
  transform(
    sequence(greatest(0L, CAST(floor(_a / (_words * _blocks)) AS BIGINT) - 1),
             least(_shards - 1, CAST(floor(_b / (_words * _blocks)) AS BIGINT) + 1)),
    j -> named_struct(
      'j', j,
      'quota', _quota DIV _shards
        + IF(pmod(j + _seed, _shards) < _quota % _shards, 1L, 0L),
      'at', pmod(xxhash64(_seed, j), _blocks)))
"""


def _parts(p: int) -> str:
    edge = lambda k: _EDGE.format(k=k)
    first = "s.j * _blocks"
    rest = "(s.quota % _blocks)"
    whole = f"array(named_struct('lo', {edge(first)}, 'hi', {edge('(s.j + 1) * _blocks')}))"
    run = f"""array(
      named_struct('lo', {edge(first)}, 'hi', {edge(f'{first} + greatest(0L, s.at + {rest} - _blocks)')}),
      named_struct('lo', {edge(f'{first} + s.at')}, 'hi', {edge(f'{first} + least(_blocks, s.at + {rest})')}))"""
    none = "CAST(array() AS ARRAY<STRUCT<lo: BIGINT, hi: BIGINT>>)"
    return f"""
    filter(
      transform(
        flatten(transform(_shard, s -> CASE
          WHEN s.quota DIV _blocks >= {p} THEN {whole}
          WHEN s.quota DIV _blocks = {p - 1} AND {rest} > 0 THEN {run}
          ELSE {none} END)),
        i -> named_struct('lo', greatest(i.lo, _a) - _a, 'hi', least(i.hi, _b) - _a)),
      i -> i.hi > i.lo)"""


def mix(docs: DataFrame, scratch: Scratch, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, text, size, source_size, target, taken, ``parts`` (for
    each pass the word ranges that the mix takes) and ``extra``, a struct of all other columns.

    ``docs`` has doc_id, source and text, or instead of text its number of words as ``size`` and a hash of it
    as ``mark``.  A null or blank text has size 0 and gives nothing.  A null source is a source, the last one.
    Rows that share doc_id and source are ordered by their texts; equal rows count as separate documents
    and change places freely; a null doc_id is allowed; an empty table stays empty; other columns may have any
    name.
    """
    own = [c for c in ("doc_id", "source", "text") if c in docs.columns]
    size = word_count("text") if "text" in own else F.col("size")
    other = [c for c in docs.columns if c not in own and ("text" in own or c not in ("size", "mark"))]
    extra = F.struct(*[F.col(f"`{c}`") for c in other]) if other else F.lit(None).cast("string")
    sized = docs.select(*own, extra.alias("extra"), size.alias("_size"), F.xxhash64(
        F.lit(seed), *[F.col(c) for c in ("doc_id", "text" if "text" in own else "mark") if c in docs.columns]
    ).alias("_key"))
    order = [F.col("source").asc_nulls_last(), F.col("_key"), F.col("doc_id"), F.col("_size")]
    placed = running_sums(sized, order, {"_from": "_size"}, scratch)
    sources = plan_sources(placed.select("source", "_size"), scratch, seed)
    located = placed.join(sources, F.col("source").eqNullSafe(F.col("_source"))).withColumns({
        "_a": F.col("_from") - F.col("_start"), "_b": F.col("_from") - F.col("_start") + F.col("_size"),
    })
    taken = " + ".join(
        f"aggregate(parts[{p}], 0L, (n, i) -> n + i.hi - i.lo)" for p in range(PASSES)
    )
    return (
        located.withColumn("_shard", F.when(F.col("_size") > 0, F.expr(_SHARD)).otherwise(F.array()))
        .withColumn("parts", F.array(*[F.expr(_parts(p)) for p in range(1, PASSES + 1)]))
        .withColumn("taken", F.expr(taken))
        .select(*own, "extra", F.col("_size").alias("size"), "source_size", "target", "taken", "parts")
    )


def mixed_texts(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The documents of the mix: a row for each pass that takes some of a document, with the text that it
    takes.  Texts taken as a whole are unchanged."""
    word = r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"
    cut = F.expr(
        f"array_join(flatten(transform(_part, i -> slice(regexp_extract_all(text, r'{word}', 0),"
        " CAST(i.lo + 1 AS INT), CAST(i.hi - i.lo AS INT)))), '')"
    )
    covered = F.expr("aggregate(_part, 0L, (n, i) -> n + i.hi - i.lo)")
    rows = mixed.withColumn("_part", F.explode("parts")).withColumn("_covered", covered).where("_covered > 0")
    text = F.when(F.col("_covered") == F.col("size"), F.col("text")).otherwise(cut)
    rows = rows.withColumn("text", text)

    def column(name: str):
        if name in ("doc_id", "source", "text"):
            return F.col(name)
        return F.length("text").cast("long").alias(name) if name == "n_chars" else F.col("extra")[name].alias(name)

    return rows.select(*map(column, columns))
