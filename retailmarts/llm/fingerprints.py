"""Document fingerprints: one-permutation MinHash, densified and packed, in DataFrame expressions alone.

The shingles of a text (five words, lower case) are hashed once.  The top bits of a hash name its bin, and
each of ``BINS`` bins keeps its least hash.  An empty bin borrows from a full one: its own random probes
visit bins, the same for every text, until one is full (optimal densification).  Of each bin the lowest
``BITS`` bits are kept; two fingerprints then agree in a bin by chance with probability ``2^-BITS``, which
``likeness`` takes off.

A document's successor is the next one by descending doc_id.  Rows are dealt into ranges of doc_ids between
literal limits, so that two passes agree on them; the last row of each range also goes to the next range as
a guest, and within a range the successor is a window away.  Texts are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retailmarts.llm.common import bound

#: Words of a shingle; bins, a power of two; bits kept of each bin, a multiple of four.
SHINGLE = 5
BINS = 256
BITS = 8
#: Probes of an empty bin that are tried one by one; bins full of it that are left are ranked as a whole.
PROBES = 8
#: Characters of a range of documents, and ranges at most (a range of more text is a longer sort, no more).
RANGE_CHARS = 2_000_000
RANGES = 65_536

_SPACE = r"[\x20\x09-\x0D]+"


def shingles(text: Column) -> Column:
    """Hashes of all runs of five words of a text in lower case; a shorter text is one run.  A text without
    words has none.

    Words are hashed first, so that a run is the hash of five numbers.  Hashing skips the nulls past the
    end, and the runs that are cut short there are dropped."""
    words = F.array_remove(F.split(F.lower(text), _SPACE), "")

    def runs(hashed: Column) -> Column:
        run = F.transform(hashed, lambda w, i: F.xxhash64(w, *[F.get(hashed, i + k) for k in range(1, SHINGLE)]))
        return F.slice(run, F.lit(1), F.greatest(F.size(hashed) - (SHINGLE - 1), F.lit(1)))

    return bound(F.transform(words, lambda w: F.xxhash64(w)), runs)


def _bin(hashed: Column, bins: int) -> Column:
    """The number of a hash's bin, in the order of signed numbers."""
    return F.shiftright(hashed, 64 - (bins.bit_length() - 1)) + bins // 2


def _probes(bins: int) -> list[list[int]]:
    """``PROBES`` bins for each bin, from a multiplicative hash: fixed for all texts and runs."""
    mask = (1 << 64) - 1

    def mixed(x: int) -> int:
        x = (x * 0x9E3779B97F4A7C15 + 0x7F4A7C159E3779B9) & mask
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
        return x ^ (x >> 31)

    return [[mixed(t * bins + j) % bins for j in range(bins)] for t in range(PROBES)]


def minima(hashes: Column, bins: int = BINS) -> Column:
    """The least hash of each bin, null where it is empty.

    The largest number of every bin is added as a mark; after sorting, each bin starts with its least
    hash, or with its mark if it has none."""
    shift = 64 - (bins.bit_length() - 1)
    marks = [((j - bins // 2) << shift) | ((1 << shift) - 1) for j in range(bins)]
    every = F.sort_array(F.concat(hashes, F.array(*[F.lit(m).cast("long") for m in marks])))

    def heads(s: Column) -> Column:
        return F.filter(s, lambda h, i: (i == 0) | (_bin(h, bins) != _bin(F.get(s, i - 1), bins)))

    low = (1 << shift) - 1
    return F.transform(bound(every, heads), lambda h: F.when(h.bitwiseAND(F.lit(low)) != low, h))


def densified(filled: Column, bins: int = BINS) -> Column:
    """Every empty bin with the value of the first full bin among its probes.

    After ``PROBES`` single probes, the full bins are ranked by a hash of both numbers, which is one more
    random order of them: there is always a first.  Without any full bin all stay null."""
    tables = [F.array(*[F.lit(p) for p in probes]) for probes in _probes(bins)]
    numbers = F.sequence(F.lit(0), F.lit(bins - 1))

    def complete(v: Column) -> Column:
        def fill(full: Column) -> Column:
            def ranked(j: Column) -> Column:
                order = F.array_min(F.transform(full, lambda i: F.struct(F.xxhash64(j, i).alias("h"), i.alias("i"))))
                return F.get(v, order["i"])

            return F.transform(v, lambda x, j: F.coalesce(x, *[F.get(v, F.get(t, j)) for t in tables], ranked(j)))

        return bound(F.filter(numbers, lambda i: F.get(v, i).isNotNull()), fill)

    return bound(filled, complete)


def sketch(text: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """The low bits of all bins of a text, as numbers; an empty array if it has no words."""
    hashes = shingles(F.coalesce(text, F.lit("")))

    def low(h: Column) -> Column:
        kept = F.transform(
            densified(minima(h, bins), bins), lambda x: x.bitwiseAND(F.lit((1 << bits) - 1)).cast("smallint")
        )
        return F.when(F.size(h) > 0, kept).otherwise(F.array().cast("array<smallint>"))

    return bound(hashes, low)


def packed(low: Column, bits: int = BITS) -> Column:
    """The bits of all bins one after the other, as hexadecimal digits; '' for a text without words."""
    digits = bits // 4
    return F.array_join(F.transform(low, lambda x: F.lower(F.lpad(F.hex(x.cast("long")), digits, "0"))), "")


def likeness(a: Column, b: Column, bits: int = BITS) -> Column:
    """The estimated share of common shingles of two texts, of their low bits: the share of equal bins less
    what chance gives.  Two texts without words are alike, one without is unlike any other."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    share, chance = equal / F.size(a), 2.0 ** -bits
    some = F.greatest(F.lit(0.0), (share - chance) / (1 - chance))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(some)


def edited(text: Column, following: Column) -> Column:
    """A text whose last half is replaced by as much of the start of the following one, or all of it."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


# ---------------------------------------------------------------- successors


def _limits(texts: DataFrame) -> tuple[list[int], int]:
    """Ascending doc_ids that cut all rows into ranges of about ``RANGE_CHARS``, where frequent ids repeat,
    and as many more ranges for rows without an id, if there are any."""
    size = texts.agg(
        F.sum(F.char_length("text")).alias("chars"), F.count("doc_id").alias("n"), F.count("*").alias("rows")
    ).first()
    ranges = min(RANGES, size["n"] or 1, max(1, (size["chars"] or 0) // RANGE_CHARS))
    nameless = ranges if size["rows"] > size["n"] else 0
    if ranges < 2:
        return [], nameless
    return texts.agg(F.percentile_approx(
        "doc_id", [i / ranges for i in range(1, ranges)], max(10_000, 20 * ranges)
    )).first()[0], nameless


def _below(limits: Column, n: int, value: Column, equal: bool) -> Column:
    """How many of the ``n`` ascending limits are below ``value``, or equal to it: bisection."""
    steps = F.array(*[F.lit(1 << k) for k in range(n.bit_length() - 1, -1, -1)])

    def step(at: Column, s: Column) -> Column:
        limit = F.get(limits, at + s - 1)
        return F.when(F.coalesce((limit <= value) if equal else (limit < value), F.lit(False)), at + s).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def _ranged(texts: DataFrame, limits: list[int], nameless: int) -> DataFrame:
    """Add ``range`` and ``copies``: rows without an id come first (negative ranges), then ranges of ids.

    Rows of an id that fills several ranges, or of none, are spread over these by the hash of their texts;
    equal rows of such an id are one row, counted in ``copies``."""
    frequent = sorted({a for a, b in zip(limits, limits[1:]) if a == b})
    rows = texts.withColumn("copies", F.lit(1).cast("long"))
    if frequent or nameless:
        often = F.col("doc_id").isNull() | F.coalesce(F.col("doc_id").isin(frequent), F.lit(False))
        joined = texts.where(often).groupBy("doc_id", "h1", "h2").agg(
            F.min("text").alias("text"), F.count("*").alias("copies")
        )
        rows = rows.where(~often).unionByName(joined)
    share = F.shiftrightunsigned("h1", 33) / float(1 << 30)
    low = high = F.lit(0)
    if limits:
        table = F.expr(f"CAST(split('{' '.join(map(str, limits))}', ' ') AS ARRAY<BIGINT>)")
        low, high = (_below(table, len(limits), F.col("doc_id"), equal) for equal in (False, True))
    rows = rows.withColumns({"_low": low, "_high": high})
    known = F.col("_low") + F.floor(share * (F.col("_high") - F.col("_low") + 1))
    unknown = F.floor(share * nameless) - nameless
    return rows.withColumn(
        "range", F.when(F.col("doc_id").isNull(), unknown).otherwise(known).cast("int")
    ).drop("_low", "_high")


def with_successors(docs: DataFrame, add=None) -> DataFrame:
    """doc_id, text (null is empty) and ``successor``, a struct of the text and the columns of ``add`` of the
    next document by descending doc_id (after the last: the first), for each row of ``docs``.

    Equal ids are ordered by a hash of their texts, documents without an id come last; the successor of
    all but one of several equal rows is their own text.  ``add`` makes further columns from ``text``."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    marked = texts.withColumns({"h1": F.shiftrightunsigned(F.xxhash64("text"), 1), "h2": F.xxhash64(F.lit(1), "text")})
    ranged = _ranged(marked, *_limits(texts))
    key = ["doc_id", "h1", "h2"]
    # Ascending, a row's successor is the row before it: the last of the range before is its first one's.
    last = ranged.groupBy("range").agg(F.max(F.struct(*key)).alias("key"))
    ranges = Window.orderBy("range")  # one row per range
    first = F.first("range").over(ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    moved = last.select("key.*", "range", F.coalesce(F.lead("range").over(ranges), first).alias("to"))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"l.{c}")) for c in [*key, "range"]]
    guests = (
        ranged.alias("r").join(F.broadcast(moved.alias("l")), same).select("r.*", "to").dropDuplicates(["to"])
        .select(*key, "text", F.lit(0).cast("long").alias("copies"), F.col("to").alias("range"))
    )
    rows = ranged.select(*guests.columns).unionByName(guests).repartition("range")
    rows = add(rows) if add else rows
    more = [c for c in rows.columns if c not in guests.columns]
    own = F.struct("text", *more)
    before = Window.partitionBy("range").orderBy(
        (F.col("copies") > 0).asc(), F.col("doc_id").asc_nulls_first(), "h1", "h2"
    )
    found = rows.withColumn("successor", F.lag(own).over(before)).where("copies > 0")
    # Of equal rows that were joined, one has the successor; the others have themselves.
    turn = F.explode(F.when(F.col("copies") == 1, F.array(F.lit(1).cast("long"))).otherwise(
        F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return found.withColumn("_turn", turn).select(
        "doc_id", "text", *more, F.when(F.col("_turn") == 1, F.col("successor")).otherwise(own).alias("successor")
    )


def judge(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    A null text is empty; empty and blank texts have the fingerprint '', alike among themselves and
    unlike others.  Equal texts have equal fingerprints.  Ties: see ``with_successors``; a single document
    is its own successor.  Repeated rows give as many rows; an empty table gives none; other columns are
    ignored, so their names cannot clash.  Every shingle of the whole text counts."""
    rows = with_successors(docs, lambda d: d.withColumn("low", sketch(F.col("text"))))
    changed = rows.withColumn("edit", edited(F.col("text"), F.col("successor.text")))
    both = changed.withColumn("edit_low", F.explode(F.array(sketch(F.col("edit")))))  # computed once
    return both.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edit", 256).alias("edited_sha256"),
        packed(F.col("low")).alias("fingerprint"), packed(F.col("edit_low")).alias("edited_fingerprint"),
        likeness(F.col("low"), F.col("edit_low")).alias("near_edited"),
        likeness(F.col("low"), F.col("successor.low")).alias("near_next"),
    )
