"""Ranked lexical search: K2-treaps over the grid of terms and documents.

Documents are indexed in shards of bounded size.  A shard's grid has a row per term (frequent ones first) and
a column per document (those with the same frequent terms side by side); a cell holds the impact of the term on the document, without the term's weight.
The grid is a quadtree, level by level: each node has a mask of its four quarters and the greatest impact in
it; a quarter with a single cell is a leaf and ends there.

An item is a set of rows.  Their paths descend the tree together over ranges of documents: the bound of
a range is the sum of the rows' weights times the greatest impact of their nodes there.  An item's ranges with
the highest bounds are halved first, until no bound reaches the lowest score of its best found; single
documents have their exact score as bound.  A task keeps an item's best documents over all its shards.  The
first shards of all tasks are searched first: their best scores are a floor for the search of all.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retailmarts.llm.common import Scratch, running_sums

#: A term: letters and digits of ASCII, and all other characters.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Results of an item.
BEST = 50
#: Cells of a shard's grid (a longer document is a shard alone), documents at most, frequent terms by which
#: documents are put in order, and bytes of text looked at at once.
CELLS = 1 << 18
DOCUMENTS = 1 << 16
SIGNS = 32
CHUNK = 1 << 20
#: Bytes of terms of the items that are searched for in one pass.
ITEM_BYTES = 4 << 20
#: Items that descend a tree side by side, and ranges of each that are halved in one step, the highest bounds first.
ITEMS = 16
STEP = 32
#: Groups that an item's results are first ranked in.
SALTS = 64

#: Bytes of terms as they are, A-Z in lower case, others a blank.  Bytes from 128 on are parts of letters.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or re.match(rb"[0-9a-z]", bytes([b])) else 32 for b in range(256)
)


def terms(text: bytes) -> Counter:
    """Occurrences of each term of a text, as bytes."""
    found, plain, at = Counter(), text.translate(_LETTERS), 0
    while at < len(plain):
        end = plain.find(b" ", at + CHUNK)
        end = len(plain) if end < 0 else end
        found.update(plain[at:end].split())
        at = end
    return found


# ---------------------------------------------------------------- the tree


def _spread(x: np.ndarray) -> np.ndarray:
    """The 32 bits of numbers with a free bit before each."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def build(row: np.ndarray, column: np.ndarray, value: np.ndarray) -> dict:
    """The tree of cells (row, column, value), all different places.

    Nodes of all levels lie one after the other (``starts`` per level).  ``mask`` has a bit per quarter,
    2 for the lower rows and 1 for the right columns; 0 is a leaf.  ``child`` is the first child, or the cell
    of a leaf."""
    height = max(int(max(row.max(), column.max())).bit_length(), 1)
    code = (_spread(row) << np.uint64(1)) | _spread(column)
    order = np.argsort(code)
    code, value = code[order], value[order]
    place = np.arange(len(code))
    masks, tops, children, starts = [], [], [], [0]
    for level in range(height + 1):
        prefix = code >> np.uint64(2 * (height - level))
        new = np.empty(len(prefix), bool)
        new[0], new[1:] = True, prefix[1:] != prefix[:-1]
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(prefix)))
        if level:  # hang the nodes under those of the level above
            quarter = (prefix[first] & np.uint64(3)).astype(np.uint8)
            above = prefix[first] >> np.uint64(2)
            parent = inner[np.cumsum(np.append(True, above[1:] != above[:-1])) - 1]
            np.bitwise_or.at(masks[-1], parent, np.left_shift(np.uint8(1), quarter))
            children[-1][parent[::-1]] = starts[-1] + np.arange(len(first))[::-1]
        masks.append(np.zeros(len(first), np.uint8))
        tops.append(np.maximum.reduceat(value, first))
        children.append(place[first].astype(np.int64))
        starts.append(starts[-1] + len(first))
        inner = np.flatnonzero(count > 1)
        if not len(inner):
            break
        kept = np.repeat(count > 1, count)
        code, value, place = code[kept], value[kept], place[kept]
    return {
        "height": height, "starts": starts, "mask": np.concatenate(masks),
        "top": np.concatenate(tops).astype(np.int32), "child": np.concatenate(children).astype(np.int32),
        "row": row[order].astype(np.int32), "column": column[order].astype(np.uint16),
    }


_ONES = np.array([bin(x).count("1") for x in range(16)], np.int64)


class Tree:
    """One shard's tree.  A node is a number; -2 - c stands for the single cell c, -1 for nothing.

    A leaf's greatest value is that of its cell."""

    def __init__(self, height: int, mask, top, child, row, column):
        self.height, self.mask, self.top, self.child, self.row, self.column = height, mask, top, child, row, column
        leaf = np.flatnonzero(mask == 0)
        self.value = np.empty(len(row), np.int64)
        self.value[child[leaf]] = top[leaf]
        #: The level at which one range holds all documents.
        self.first = height - max(int(column.max()).bit_length(), 1)

    def _single(self, nodes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Leaves as their cells, or as nothing where the cell is in another row."""
        at = np.maximum(nodes, 0)
        leaf = (nodes >= 0) & (self.mask[at] == 0)
        cell = np.where(leaf, self.child[at], 0)
        return np.where(leaf, np.where(self.row[cell] == rows, -2 - cell, -1), nodes)

    def half(self, nodes: np.ndarray, rows: np.ndarray, bit, right: int) -> np.ndarray:
        """Nodes on the paths of their rows → those of the left or right half of their range.  ``bit`` of
        a row or column tells the halves apart (``height - level - 1`` for nodes of a level)."""
        inner = nodes >= 0
        at, cell = np.where(inner, nodes, 0), np.where(nodes < -1, -2 - nodes, 0)
        mask, quarter = self.mask[at], 2 * ((rows >> bit) & 1) + right
        there = inner & ((mask >> quarter) & 1 > 0)
        child = np.where(there, self.child[at] + _ONES[mask & ((1 << quarter) - 1)], -1)
        same = (nodes < -1) & ((self.column[cell] >> bit) & 1 == right)
        return np.where(same, nodes, self._single(child, rows))

    def starts(self, rows: np.ndarray) -> np.ndarray:
        """The nodes of the rows' paths at the level ``first``."""
        nodes = self._single(np.zeros(len(rows), np.int64), rows)
        for level in range(self.first):
            nodes = self.half(nodes, rows, self.height - level - 1, 0)
        return nodes

    def tops(self, nodes: np.ndarray) -> np.ndarray:
        inner = nodes >= 0
        return np.where(inner, self.top[np.where(inner, nodes, 0)], self.value[np.where(nodes < -1, -2 - nodes, 0)])


class _Ranges:
    """Ranges of documents that items wait for: item, level, start and bound of each, and for each the rows
    that have something in it.  ``owner`` numbers the range of each (row, weight, node), ascending."""

    def __init__(self, item, level, start, bound, owner, row, weight, node):
        self.item, self.level, self.start, self.bound = item, level, start, bound
        self.owner, self.row, self.weight, self.node = owner, row, weight, node

    @classmethod
    def of(cls, tree: Tree, item, level, start, owner, row, weight, node) -> "_Ranges":
        """Ranges with what is in them; those without anything are left out."""
        there = node != -1
        owner, row, weight, node = owner[there], row[there], weight[there], node[there]
        new = np.ones(len(owner), bool)
        new[1:] = owner[1:] != owner[:-1]
        first = np.flatnonzero(new)
        bound = np.add.reduceat(weight * tree.tops(node), first) if len(first) else np.zeros(0, np.int64)
        held = owner[first]
        return cls(item[held], level[held], start[held], bound, np.cumsum(new) - 1, row, weight, node)

    def pick(self, chosen: np.ndarray) -> "_Ranges":
        """The ranges marked in ``chosen``."""
        entry, number = chosen[self.owner], np.cumsum(chosen) - 1
        return _Ranges(
            self.item[chosen], self.level[chosen], self.start[chosen], self.bound[chosen],
            number[self.owner[entry]], self.row[entry], self.weight[entry], self.node[entry],
        )

    def plus(self, more: "_Ranges") -> "_Ranges":
        join = lambda name: np.concatenate([getattr(self, name), getattr(more, name)])
        return _Ranges(
            *map(join, ("item", "level", "start", "bound")),
            np.concatenate([self.owner, more.owner + len(self.bound)]), *map(join, ("row", "weight", "node")),
        )

    def halves(self, tree: Tree) -> "_Ranges":
        bit = tree.height - self.level[self.owner] - 1
        node = np.concatenate([tree.half(self.node, self.row, bit, side) for side in (0, 1)])
        start = np.concatenate([2 * self.start, 2 * self.start + 1])
        owner = np.concatenate([self.owner, self.owner + len(self.start)])
        twice = lambda x: np.concatenate([x, x])
        return _Ranges.of(
            tree, twice(self.item), twice(self.level + 1), start, owner, twice(self.row), twice(self.weight), node
        )


def _rank(group: np.ndarray, *order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows sorted by group and ``order``, and the rank of each within its group, from 0."""
    at = np.lexsort((*order[::-1], group))
    sorted_ = group[at]
    new = np.ones(len(at), bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    return at, np.arange(len(at)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(at) else np.zeros(0, np.int64)


def best_documents(
    tree: Tree, item: np.ndarray, row: np.ndarray, node: np.ndarray, weight: np.ndarray, floor: np.ndarray,
    best: int = BEST,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, column, score) of at least each item's ``best`` highest scores of its floor and more, ties
    included.

    ``item`` is ascending and says whose row each is; ``node`` is the row's where the search starts
    (``Tree.starts``); ``floor`` has a score per item."""
    floor, none = floor.copy(), np.zeros(0, np.int64)
    count = len(floor)
    found_item, found_at, found = none, none, none
    whole = np.zeros(count, np.int64)
    waiting = _Ranges.of(tree, np.arange(count), whole + tree.first, whole, item, row, weight, node)
    while True:
        waiting = waiting.pick(waiting.bound >= floor[waiting.item])
        if not len(waiting.bound):
            break
        at, rank = _rank(waiting.item, -waiting.bound)
        chosen = np.zeros(len(at), bool)
        chosen[at[rank < STEP]] = True
        halves = waiting.pick(chosen).halves(tree)
        halves = halves.pick(halves.bound >= floor[halves.item])
        single = halves.level == tree.height
        if single.any():
            found_item = np.concatenate([found_item, halves.item[single]])
            found_at = np.concatenate([found_at, halves.start[single]])
            found = np.concatenate([found, halves.bound[single]])
            at, rank = _rank(found_item, -found)
            last = at[rank == best - 1]
            floor[found_item[last]] = np.maximum(floor[found_item[last]], found[last])
            held = found >= floor[found_item]
            found_item, found_at, found = found_item[held], found_at[held], found[held]
        waiting = waiting.pick(~chosen).plus(halves.pick(~single))
    return found_item, found_at, found


# ---------------------------------------------------------------- the index


INDEX = (
    "docs ARRAY<BIGINT>, terms BINARY, df BINARY, height INT, mask BINARY, top BINARY, child BINARY, "
    "`row` BINARY, `column` BINARY"
)
_INDEX = pa.schema([
    ("docs", pa.list_(pa.int64())), ("terms", pa.binary()), ("df", pa.binary()), ("height", pa.int32()),
    ("mask", pa.binary()), ("top", pa.binary()), ("child", pa.binary()), ("row", pa.binary()), ("column", pa.binary()),
])


class _Shard:
    """Documents of one shard while they are gathered."""

    def __init__(self):
        self.numbers: defaultdict = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.docs, self.rows, self.counts, self.lengths = [], [], [], []
        self.cells = 0

    def add(self, doc_id, found: Counter) -> None:
        self.docs.append(doc_id)
        self.rows.append(np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found)))
        self.counts.append(np.fromiter(found.values(), np.int64, len(found)))
        self.lengths.append(int(self.counts[-1].sum()))
        self.cells += len(found)

    def index(self, documents: int, length: int) -> pa.RecordBatch:
        row, tf = np.concatenate(self.rows), np.concatenate(self.counts)
        column = np.repeat(np.arange(len(self.docs)), [len(r) for r in self.rows])
        df = np.bincount(row, minlength=len(self.numbers))
        order = np.argsort(-df, kind="stable")  # frequent terms are neighbours
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        sign, often = np.zeros(len(self.docs), np.int64), rank[row] < SIGNS
        np.bitwise_or.at(sign, column[often], 1 << (SIGNS - 1 - rank[row][often]))
        ordered = np.argsort(sign, kind="stable")
        place = np.empty_like(ordered)
        place[ordered] = np.arange(len(ordered))
        norm = np.array([50 + (50 * n * documents) // length for n in self.lengths], np.int64)
        tree = build(rank[row], place[column], (1_000_000_000 * tf) // (1000 * tf + 20 * norm[column]))
        words = list(self.numbers)
        return pa.RecordBatch.from_pydict({
            "docs": [[self.docs[i] for i in ordered]], "terms": [b" ".join([words[i] for i in order])],
            "df": [df[order].astype(np.int32).tobytes()], "height": [tree["height"]],
            **{n: [tree[n].tobytes()] for n in ("mask", "top", "child", "row", "column")},
        }, schema=_INDEX)


def _indexer(documents: int, length: int, cells: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                found = terms(text.as_py())
                if found:
                    if shard.cells and (shard.cells + len(found) > cells or len(shard.docs) == DOCUMENTS):
                        yield shard.index(documents, length)
                        shard = _Shard()
                    shard.add(doc_id, found)
        if shard.cells:
            yield shard.index(documents, length)

    return index


def index(docs: DataFrame, scratch: Scratch, cells: int = CELLS) -> tuple[DataFrame, int]:
    """The saved index of ``docs`` (doc_id, text), one row per shard, and the number of documents with a
    term.  Every document with a term is in it, whole."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL")
    sizes = texts.select(F.regexp_count("text", F.lit(TERM)).cast("long").alias("n"))
    total = sizes.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("length")).first()
    shards = texts.withColumn("text", F.col("text").cast("binary")).mapInArrow(
        _indexer(total["documents"], total["length"] or 0, cells), INDEX
    )
    return scratch.save(shards), total["documents"]


# ---------------------------------------------------------------- items


def _items(items: DataFrame, scratch: Scratch) -> DataFrame:
    """number, item_id, terms and block of each item; a block has a bounded number of bytes (or one item)."""
    plain = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(plain, F.lit("")), F.lit(TERM), F.lit(0)))
    rows = items.select("item_id", found.alias("terms")).withColumns({
        "_bytes": (F.octet_length(F.array_join("terms", " ")) + 1).cast("long"), "_one": F.lit(1).cast("long"),
    })
    placed = running_sums(rows, [F.col("item_id").asc_nulls_last(), F.xxhash64("terms")], {"at": "_bytes", "number": "_one"}, scratch)
    return scratch.save(placed.select("number", "item_id", "terms", F.floor(F.col("at") / ITEM_BYTES).alias("block")))


def _words(batch: pa.RecordBatch, i: int) -> dict[bytes, int]:
    return {t: n for n, t in enumerate(batch["terms"][i].as_py().split(b" "))}


def _frequencies(wanted: list[bytes]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                at, df = _words(batch, i), np.frombuffer(batch["df"][i].as_py(), np.int32)
                total += np.array([df[at[t]] if t in at else 0 for t in wanted], np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(used, pa.int64()), "df": pa.array(total[used], pa.int64())})

    return count


class _Best:
    """The best documents of each item so far."""

    def __init__(self, floor: np.ndarray, best: int):
        self.floor, self.best, none = floor.copy(), best, np.zeros(0, np.int64)
        self.item, self.score, self.doc, self.nameless = none, none, none, none.astype(bool)

    def add(self, item, score, doc, nameless) -> None:
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        doc, nameless = np.concatenate([self.doc, doc]), np.concatenate([self.nameless, nameless])
        at, rank = _rank(item, -score, nameless, doc)
        last = at[rank == self.best - 1]
        self.floor[item[last]] = np.maximum(self.floor[item[last]], score[last])
        at = at[rank < self.best]
        self.item, self.score, self.doc, self.nameless = item[at], score[at], doc[at], nameless[at]


def _searcher(wanted: list[bytes], weights: np.ndarray, items: list[np.ndarray], floor: np.ndarray, best: int, first: bool):
    """A mapInArrow function: each task's best documents of every item, by its place in ``items``; with
    ``first`` of its first shard only."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, seen = _Best(floor, best), 0
        sizes = [len(i) for i in items]
        every = np.concatenate([*items, np.zeros(0, np.int64)])
        whose = np.repeat(np.arange(len(items)), sizes)
        for batch in batches:
            for i in range(0 if first and seen else batch.num_rows):
                seen += 1
                at = _words(batch, i)
                rows = np.array([at.get(t, -1) for t in wanted], np.int64)
                get = lambda name, kind: np.frombuffer(batch[name][i].as_buffer(), kind)  # noqa: E731, B023
                tree = Tree(
                    batch["height"][i].as_py(), get("mask", np.uint8), get("top", np.int32), get("child", np.int32),
                    get("row", np.int32), get("column", np.uint16),
                )
                docs = batch["docs"][i].values
                doc, nameless = docs.fill_null(0).to_numpy(), docs.is_null().to_numpy(zero_copy_only=False)
                here = np.flatnonzero(rows >= 0)
                nodes = np.full(len(rows), -1, np.int64)
                nodes[here] = tree.starts(rows[here])
                used = nodes[every] != -1
                term, owner = every[used], whose[used]
                for start in range(0, len(items), ITEMS):
                    a, b = np.searchsorted(owner, [start, start + ITEMS])
                    part = term[a:b]
                    found = best_documents(
                        tree, owner[a:b] - start, rows[part], nodes[part], weights[part],
                        top.floor[start:start + ITEMS], best,
                    )
                    top.add(found[0] + start, found[2], doc[found[1]], nameless[found[1]])
                if first:
                    break
        yield pa.RecordBatch.from_pydict({
            "number": pa.array(top.item), "doc_id": pa.array(top.doc, mask=top.nameless), "score": pa.array(top.score),
        })

    return search


def _ranked(found: DataFrame, best: int) -> DataFrame:
    """The best rows of each item with their rank.  Groups of an item are cut to size first, so that no
    task sorts the results of all tasks."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = Window.partitionBy("number", "salt").orderBy(*order)
    few = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).withColumn(
        "at", F.row_number().over(part)
    ).where(F.col("at") <= best)
    rank = F.row_number().over(Window.partitionBy("number").orderBy(*order))
    return few.withColumn("rank", rank).where(F.col("rank") <= best).select("number", "rank", "doc_id", "score")


def search(index: DataFrame, documents: int, items: DataFrame, scratch: Scratch, best: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the ``best`` documents of each row of ``items`` (item_id, text) with a
    score above 0; see ``rank_documents``."""
    numbered = _items(items, scratch)
    results = []
    for block in range((numbered.agg(F.max("block")).first()[0] or 0) + 1):
        rows = numbered.where(F.col("block") == block).select("number", "terms").collect()  # ITEM_BYTES of them
        wanted = sorted({t.encode() for r in rows for t in r["terms"]})
        place = {t: i for i, t in enumerate(wanted)}
        asked = [r for r in rows if r["terms"]]
        numbers = [np.array([place[t.encode()] for t in r["terms"]], np.int64) for r in asked]
        counted = index.select("terms", "df").mapInArrow(_frequencies(wanted), "term BIGINT, df BIGINT")
        weights = np.zeros(len(wanted), np.int64)
        for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():  # a row per wanted term
            weights[r["term"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * r["df"] + 1)))
        floor = np.ones(len(asked), np.int64)
        for first in (True, False):
            task = _searcher(wanted, weights, numbers, floor, best, first)
            found = index.mapInArrow(task, "number BIGINT, doc_id BIGINT, score BIGINT")
            ranked = scratch.save(_ranked(found, best))
            if first:
                for r in ranked.where(F.col("rank") == best).select("number", "score").collect():  # at most one per item
                    floor[r["number"]] = r["score"]
        names = index.sparkSession.createDataFrame([(i, r["number"]) for i, r in enumerate(asked)], "at INT, number BIGINT")
        results.append(ranked.withColumnRenamed("number", "at").join(names, "at").drop("at"))
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    return found.join(numbered.select("number", "item_id"), "number").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"
    )


def rank_documents(docs: DataFrame, items: DataFrame, scratch: Scratch, best: int = BEST) -> DataFrame:
    """The ``best`` highest-scoring rows of ``docs`` (doc_id, text) for each row of ``items`` (item_id,
    text): item_id, rank (from 1, unique), doc_id, score.

    Equal scores are ranked by doc_id, null ones last; equal rows take ranks side by side.  Null, empty
    and blank texts have no terms: such documents are never found, such items find nothing.  Rows of ``items``
    that are equal are ranked each.  Long texts are indexed whole.  Without documents or items there is no
    row; other columns are ignored."""
    spark, few = docs.sparkSession, {
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1", "spark.sql.parquet.columnarReaderBatchSize": "4",
    }
    built, documents = index(docs, scratch)
    before = {k: spark.conf.get(k) for k in few}
    try:
        for k, v in few.items():  # a shard has megabytes; all that reads them runs in ``search``
            spark.conf.set(k, v)
        return search(built, documents, items, scratch, best)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


#: The same in SQL: every term of every document is counted.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
i AS (
  SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(t)) AS BIGINT) AS total FROM d WHERE len(t) > 0),
tf AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, CAST(len(t) AS BIGINT) AS n, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf CROSS JOIN s GROUP BY term, docs),
scored AS (
  SELECT q, item_id, r, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total)))) AS BIGINT) AS score
  FROM (SELECT q, item_id, unnest(t) AS term FROM i) JOIN tf USING (term) JOIN w USING (term) CROSS JOIN s
  GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0) WHERE rank <= 50
"""
