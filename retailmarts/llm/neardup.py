"""Near duplicates by SetSketch registers.

A document is the set of its five-word shingles.  Each shingle throws exponentially spaced points at the
registers of a sketch; a register keeps the smallest one, truncated to a power of ``BASE``.  Registers
are mergeable, and two of them agree about as often as the sets overlap.  Bands of registers give
candidates; the likelihood of the register comparison, with the known set sizes, drops pairs that are
clearly too far; what is left is confirmed on the full sets.

No rows are made that grow with the square of a group.  Equal sets are one node.  A bucket first links
its members to its smallest one; only buckets that then still hold several components are compared
further, in blocks, and only the links that join components leave a task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmarts.llm.common import Scratch, components, spread_join

SHINGLE = 5
BASE = 1.1
REGISTERS = 504
#: Registers of a band and number of bands by similarity in per cent.  A pair just at the limit shares no
#: band with a probability below one in a million.
BANDS = {85: (7, 36), 80: (6, 42)}
#: Standard errors below the limit at which a pair is dropped without a look at its sets.
MARGIN = 4.5
#: Rows of a block of a bucket, and first bands of the rounds in which buckets are compared.
BLOCK = 1024
ROUNDS = (0, 4)
#: Points made at once, and characters split at once: a text of any length needs memory for its set only.
POINTS = 200_000
STRETCH = 1 << 20

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(text: str) -> np.ndarray:
    data, parts, start = text.encode("utf-8", "surrogatepass").lower(), [], 0  # bytes: A-Z only
    while start < len(data):
        cut = _SPACE.search(data, min(start + STRETCH, len(data)))
        end = cut.start() if cut else len(data)
        words = data[start:end].split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        start = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """The set of hashes of five-word shingles, in order; of a shorter text one of all its words."""
    words = _word_hashes(text or "")
    if not len(words):
        return words
    width = min(SHINGLE, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        total = _mixed(total + words[i : len(words) - width + 1 + i])
    return np.unique(total)


def sketches(sets: list[np.ndarray], size: int = REGISTERS) -> np.ndarray:
    """Registers of each set: level of the smallest point thrown at each, 0 to 255, higher for smaller.

    An item throws points at random registers in rising order, a Poisson process, until they pass the
    largest register of its set.  Sets of similar sizes are worked on together, a block of points of all
    their items at a time."""
    least = np.full((len(sets), size), np.inf)
    order = sorted((i for i, s in enumerate(sets) if len(s)), key=lambda i: len(sets[i]))
    while order:
        smallest, group, points = len(sets[order[0]]), [], 0
        while order and len(sets[order[0]]) <= 2 * smallest and (not group or points < POINTS):
            group.append(order.pop(0))
            points += max(size, len(sets[group[-1]]))
        least[group] = _least([sets[i] for i in group], max(1, -(-size // smallest)), size)
    with np.errstate(divide="ignore"):
        levels = np.floor(1 + (np.log(20.0) - np.log(least)) / np.log(BASE))
    return np.clip(levels, 0, 255).astype(np.uint8)


def _least(sets: list[np.ndarray], count: int, size: int) -> np.ndarray:
    """The smallest point of each register; ``count`` points of an item are made at once."""
    least = np.full(len(sets) * size, np.inf)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    items, reached, thrown = _mixed(np.concatenate(sets)), np.zeros(len(owner)), 0
    while len(items):
        rounds = np.arange(thrown, thrown + count, dtype=np.uint64)
        bits = _mixed(items[:, None] + rounds[None, :] * _GOLDEN)
        gaps = -np.log1p(-(bits >> np.uint64(11)).astype(np.float64) * 2.0**-53) / size
        points = reached[:, None] + np.cumsum(gaps, axis=1)
        at = (_mixed(bits ^ _GOLDEN) % np.uint64(size)).astype(np.int64) + owner[:, None] * size
        np.minimum.at(least, at.ravel(), points.ravel())
        reached, thrown = points[:, -1], thrown + count
        alive = reached < least.reshape(-1, size).max(axis=1)[owner]
        items, owner, reached = items[alive], owner[alive], reached[alive]
    return least.reshape(-1, size)


def _more(x: np.ndarray) -> np.ndarray:
    """Probability that a register of one set exceeds the other's, from the share of items it has alone."""
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def similarity(more: np.ndarray, less: np.ndarray, na: np.ndarray, nb: np.ndarray, size: int = REGISTERS) -> np.ndarray:
    """Joint maximum-likelihood estimate of the Jaccard similarity, from how many registers of a exceed
    and fall below those of b, and the set sizes.  Bisection on the slope of the concave likelihood."""
    u, v = na / (na + nb), nb / (na + nb)
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    rate = (BASE - 1) / BASE / np.log(BASE)
    for _ in range(20):
        j = (low + high) / 2
        x, y = u - v * j, v - u * j
        p, q = _more(x), _more(y)
        dp, dq = -v * rate / (1 - x * (BASE - 1) / BASE), -u * rate / (1 - y * (BASE - 1) / BASE)
        slope = (
            more * dp / np.maximum(p, 1e-12) + less * dq / np.maximum(q, 1e-12)
            - (size - more - less) * (dp + dq) / np.maximum(1 - p - q, 1e-12)
        )
        low, high = np.where(slope >= 0, j, low), np.where(slope >= 0, high, j)
    return high


def floor_of(limit: int) -> float:
    """The estimate below which a pair is dropped."""
    j = limit / 100
    return j - MARGIN * (j * (1 - j) / REGISTERS) ** 0.5


# ---------------------------------------------------------------- stages


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = lambda items: int(np.add.reduce(_mixed(items)).astype(np.int64))
    for batch in batches:
        sets = [shingles(t) for t in batch["text"].to_pylist()]
        registers = sketches(sets)
        yield pa.RecordBatch.from_arrays(
            [batch["row"], batch["doc_id"], batch["text_hash"], pa.array([len(s) for s in sets], pa.int64()),
             pa.array([total(s) for s in sets], pa.int64()), pa.array([total(s ^ _GOLDEN) for s in sets], pa.int64()),
             pa.array([r.tobytes() for r in registers], pa.binary())],
            names=["row", "doc_id", "text_hash", "n", "a", "b", "registers"],
        )


def _confirm(limit: int):
    """Links among pairs with both texts; the last set is kept, as pairs of one document come together."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for batch in batches:
            x, y = batch["x"].to_pylist(), batch["y"].to_pylist()
            found = []
            for i, (tx, ty) in enumerate(zip(batch["text_x"], batch["text_y"])):
                if last[0] != y[i]:
                    last = y[i], shingles(ty.as_py())
                mine = shingles(tx.as_py())
                both = len(np.intersect1d(mine, last[1], assume_unique=True))
                if 100 * both >= limit * (len(mine) + len(last[1]) - both):
                    found.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for i in found], pa.int64()), pa.array([y[i] for i in found], pa.int64())],
                names=["a", "b"],
            )

    return links


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """The rows of each (bucket, i, j) of a sorted partition; one group and one batch are in memory."""
    rest = None
    for pdf in batches:
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            continue
        key = pdf[["bucket", "i", "j"]].to_numpy(np.int64)
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        for s, e in zip(starts[:-1], starts[1:]):
            yield tuple(key[s]), pdf.iloc[s:e]
        rest = pdf.iloc[starts[-1] :]
    if rest is not None and len(rest):
        yield tuple(rest[["bucket", "i", "j"]].iloc[0]), rest


def _pairs(pdf: pd.DataFrame, limit: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of a group, each row with the later rows of other components whose estimate is not too low.

    A pair belongs to the first band that it agrees in, so that it turns up in one bucket only."""
    width, count = BANDS[limit]
    least, band = floor_of(limit), int(pdf["band"].iloc[0])
    comps, sizes = pdf["component"].to_numpy(np.int64), pdf["n"].to_numpy(float)
    regs = np.frombuffer(b"".join(pdf["registers"]), np.uint8).reshape(len(pdf), -1)
    earlier = regs[:, : band * width].reshape(len(pdf), band, width).astype(np.uint64)
    scale = _mixed(np.arange(1, width + 1, dtype=np.uint64))
    earlier = (earlier * scale).sum(axis=2)  # one number for each earlier band
    for i in range(len(pdf) - 1):
        others = np.flatnonzero(comps[i + 1 :] != comps[i]) + i + 1
        ratio = np.minimum(sizes[others], sizes[i]) / np.maximum(sizes[others], sizes[i])
        others = others[(100 * ratio >= limit) & ~(earlier[others] == earlier[i]).any(axis=1)]
        if len(others):
            more, less = (regs[i] > regs[others]).sum(axis=1), (regs[i] < regs[others]).sum(axis=1)
            j = similarity(more, less, np.full(len(others), sizes[i]), sizes[others])
            if (j >= least).any():
                yield i, others[j >= least]


def _open_rows(limit: int):
    """(bucket, i, j, row) of the rows that have a likely partner in another component."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (bucket, i, j), pdf in _groups(batches):
            likely = np.zeros(len(pdf), bool)
            for x, others in _pairs(pdf, limit):
                likely[x] = True
                likely[others] = True
            if likely.any():
                yield pd.DataFrame({"bucket": bucket, "i": i, "j": j, "row": pdf["row"].to_numpy()[likely]})

    return rows


def _linked_rows(limit: int):
    """A spanning forest of the links of a group, confirmed on the full sets: pairs that links join
    already are not looked at."""

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, pdf in _groups(batches):
            root: dict[int, int] = {}

            def top(x: int) -> int:
                while (up := root.get(x, x)) != x:
                    root[x] = root.get(up, up)
                    x = up
                return x

            comps, rows = pdf["component"].tolist(), pdf["row"].tolist()
            sets: dict[int, np.ndarray] = {}
            found = []
            for x, others in _pairs(pdf, limit):
                for y in others.tolist():
                    if top(comps[x]) == top(comps[y]):
                        continue
                    for k in (x, y):
                        if k not in sets:
                            sets[k] = shingles(pdf["text"].iat[k])
                    both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                    if 100 * both >= limit * (len(sets[x]) + len(sets[y]) - both):
                        root[top(comps[x])] = top(comps[y])
                        found.append((rows[x], rows[y]))
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])

    return links


class _Search:
    """Links between the distinct sets of a corpus, found in rounds."""

    def __init__(self, docs: DataFrame, scratch: Scratch, limit: int):
        self.scratch, self.limit = scratch, limit
        width, count = BANDS[limit]
        numbered = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).withColumn(
            "row", F.monotonically_increasing_id()  # fixed by the saved table
        )
        self.all = scratch.save(numbered.select("row", "doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
            _sketched,
            "row BIGINT, doc_id BIGINT, text_hash BIGINT, n BIGINT, a BIGINT, b BIGINT, registers BINARY",
        ))
        key = ["n", "a", "b"]
        self.classes = (
            self.all.where("n > 0").groupBy(*key)
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
            .select(*key, F.col("first.row").alias("node"))
        )
        nodes = self.all.join(self.classes.select(F.col("node").alias("row")), "row")
        self.nodes = scratch.save(nodes.select("row", "doc_id", "text_hash", *key, "registers"))
        bands = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.xxhash64(
            i, F.col("registers").substr(i * width + 1, F.lit(width))
        ))
        members = self.nodes.select("row", F.posexplode(bands).alias("band", "bucket"))
        buckets = members.groupBy("bucket").agg(F.count("*").alias("size"), F.min("row").alias("hub"))
        self.members = scratch.save(spread_join(members, buckets.where("size > 1"), ["bucket"]))
        self.texts = scratch.save(self._texts(docs))
        self.links = None
        self.components = self.nodes.select(F.col("row").alias("node"), F.col("row").alias("component")).limit(0)

    def _candidates(self, docs: DataFrame) -> DataFrame:
        """Rows of ``docs`` with a node of their doc_id and hash of the text that shares a bucket."""
        wanted = self.nodes.join(self.members.select("row").distinct(), "row", "left_semi").select(
            F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "row", "n", "a", "b"
        )
        source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
        return source.join(
            wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash"))
        )

    def _texts(self, docs: DataFrame) -> DataFrame:
        """Texts of the nodes that share a bucket.  Rows are found by doc_id and a hash of the text; should two
        texts have the same, the set tells which it is."""
        found = self._candidates(docs)

        def same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = []
                for text, n, a in zip(batch["text"].to_pylist(), batch["n"].to_pylist(), batch["a"].to_pylist()):
                    items = shingles(text)
                    keep.append(len(items) == n and int(np.add.reduce(_mixed(items)).astype(np.int64)) == a)
                yield batch.select(["row", "text"]).filter(pa.array(keep, pa.bool_()))

        return (
            found.select("row", "text", "n", "a").mapInArrow(same, "row BIGINT, text STRING")
            .groupBy("row").agg(F.min("text").alias("text"))
        )

    def link(self, found: DataFrame) -> None:
        """Add links and bring the components up to date."""
        self.links = self.scratch.save(found if self.links is None else self.links.unionByName(found))
        self.components = self.scratch.save(components(self.links, self.scratch))

    def to_hubs(self) -> None:
        """Links of each node with the smallest member of its buckets: one pair for each node."""
        hubs = self.members.where("row <> hub").groupBy("row").agg(F.min("hub").alias("hub"))
        known = self.nodes.select("row", "n", "registers")
        hub = self.nodes.select(F.col("row").alias("hub"), F.col("n").alias("m"), F.col("registers").alias("others"))
        rows = hubs.join(known, "row").join(hub, "hub")
        least = floor_of(self.limit)

        def close(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    a, b = (
                        np.frombuffer(b"".join(pdf[c]), np.uint8).reshape(len(pdf), -1) for c in ("registers", "others")
                    )
                    j = similarity((a > b).sum(axis=1), (a < b).sum(axis=1), *(
                        pdf[c].to_numpy(float) for c in ("n", "m")
                    ))
                    yield pdf.loc[j >= least, ["row", "hub"]].set_axis(["x", "y"], axis=1)

        pairs = rows.select("row", "hub", "n", "m", "registers", "others").mapInPandas(close, "x BIGINT, y BIGINT")
        x = self.texts.select(F.col("row").alias("x"), F.col("text").alias("text_x"))
        y = self.texts.select(F.col("row").alias("y"), F.col("text").alias("text_y"))
        self.link(self.scratch.save(pairs).join(x, "x").join(y, "y").select("x", "y", "text_x", "text_y").mapInArrow(
            _confirm(self.limit), "a BIGINT, b BIGINT"
        ))

    def across(self, first: int, end: int) -> None:
        """Links between different components that share a bucket of the bands from ``first`` to ``end``.

        Buckets are compared in blocks, first by their sketches; then the texts of the rows that have a
        likely partner go to the same blocks."""
        labels = self.components.select(F.col("node").alias("row"), "component")
        members = self.scratch.save(
            self.members.where(F.col("band").between(first, end - 1)).select("bucket", "band", "row", "size")
            .join(labels, "row", "left")
            .withColumn("component", F.coalesce("component", "row"))
        )
        mixed = members.groupBy("bucket").agg(
            F.min("component").alias("low"), F.max("component").alias("high")
        ).where("low <> high").select("bucket")
        blocks = F.ceil(F.col("size") / BLOCK).cast("long")
        group = ["bucket", "i", "j"]
        rows = self.scratch.save(
            spread_join(members, mixed, ["bucket"])
            .withColumn("mine", F.pmod(F.xxhash64("row"), blocks))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
            .select(
                "bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                "band", "row", "component",
            )
        )

        def dealt(some: DataFrame, *columns: str) -> DataFrame:
            return some.repartition(*group).sortWithinPartitions(*group, "row").select(
                *group, "band", "row", "component", "n", "registers", *columns
            )

        sketched = self.nodes.select("row", "n", "registers")
        likely = self.scratch.save(dealt(rows.join(sketched, "row")).mapInPandas(
            _open_rows(self.limit), "bucket BIGINT, i BIGINT, j BIGINT, row BIGINT"
        ))
        whole = rows.join(likely, [*group, "row"]).join(sketched, "row").join(self.texts, "row")
        self.link(dealt(whole, "text").mapInPandas(_linked_rows(self.limit), "a BIGINT, b BIGINT"))
        self.scratch.drop(members)


def near_duplicates(docs: DataFrame, scratch: Scratch, limit: int = 85) -> DataFrame:
    """One row per row of ``docs``: row, text_hash, doc_id, n_shingles, component_id, kept.

    Rows are linked if their sets overlap by ``limit`` per cent or more.  component_id is the smallest
    doc_id that links reach.  Kept is one row of each component: the one of that doc_id, of repeated rows
    the first.  A null, empty or blank text has no shingles, is linked with nothing and kept.  A null
    doc_id can be linked but names no component that has another id; an empty table stays empty; other
    columns of ``docs`` are ignored.
    """
    search = _Search(docs, scratch, limit)
    search.to_hubs()
    # A few bands join most of what belongs together, so the others need not find it once more each.
    for first, end in zip(ROUNDS, [*ROUNDS[1:], BANDS[limit][1]]):
        search.across(first, end)
    key = ["n", "a", "b"]
    node = spread_join(search.all.drop("registers"), search.classes, key, "left").select(
        "row", "text_hash", "doc_id", "n", F.coalesce("node", "row").alias("node")
    )
    node = node.join(search.components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    node = scratch.save(node.drop("node"))
    first = node.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    ).select("component", F.col("first.doc_id").alias("component_id"), F.col("first.row").alias("first"))
    return spread_join(node, first, ["component"]).select(
        "row", "text_hash", "doc_id", F.col("n").alias("n_shingles"), "component_id",
        (F.col("row") == F.col("first")).alias("kept"),
    )


def keep_one(docs: DataFrame, scratch: Scratch, limit: int = 85) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, all columns unchanged.

    Rows are found again by doc_id, null or not, and a hash of the text.  Repeated rows share both: they
    are set aside and one of them comes back if one is kept."""
    told = near_duplicates(docs, scratch, limit)
    key = ["__id", "__none", "__hash"]
    groups = scratch.save(
        told.groupBy(
            F.coalesce("doc_id", F.lit(0)).alias("__id"), F.col("doc_id").isNull().alias("__none"),
            F.col("text_hash").alias("__hash"),
        ).agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("k")).where("k < n")
    )
    marked = docs.select(  # the document as one value, whatever its columns are called
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.coalesce("doc_id", F.lit(0)).alias("__id"), F.col("doc_id").isNull().alias("__none"),
        F.xxhash64(F.col("text").cast("string")).alias("__hash"),
    )
    left = marked.join(groups.select(*key), key, "left_anti")
    trimmed = groups.where("k > 0").select(*key)
    if trimmed.limit(1).count():
        left = left.unionByName(marked.join(trimmed, key, "left_semi").dropDuplicates(key))
    return left.select("doc.*")
