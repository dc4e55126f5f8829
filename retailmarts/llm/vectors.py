"""Near-duplicate vectors by a robust-pruned flat graph.

Vectors go to the shards of their nearest pivots, several each, so that shards overlap.  A shard is cut
into clusters that overlap as well; in each a graph is built whose edges are pruned to point in different
directions, and the adjacency lists of a vector's clusters are united.  A search descends greedily from
the medoids and then expands over all neighbours in range.  Cosines are confirmed in double precision,
recall is audited against brute force, and the overlap is doubled if it falls short.  Where that would cost
more than all cosines, these are compared instead.

Links of a shard are counted where they are found; only counts and a spanning forest leave a task.  A
shard beyond ``BLOCK`` vectors is cut into blocks, so its size is not limited: a block is searched by its
graph, two blocks are compared by all their cosines, since a search from another block has no node to start at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmarts.llm.common import Scratch, bound, components, spread_join

LIMIT = 0.98
#: Vectors a pivot stands for, pivots at most, sampled vectors they are chosen from, and the cosine that
#: two pivots may not reach, so that a dense group has one.
SHARD = 512
PIVOTS = 16_384
SAMPLE = 20_000
APART = 0.9
OVERLAP = 2
BLOCK = 2048
#: Of a graph: vectors of a cluster, clusters of a vector, edges per cluster, slack of pruning.
CLUSTER = 512
CLUSTERS = 2
DEGREE = 16
ALPHA = 1.2
#: Of a search: nodes expanded at once, greedy rounds, how far below the limit neighbours are still
#: expanded, queries and expansions at once.
WIDTH = 8
ROUNDS = 8
SLACK = 0.02
QUERIES = 256
EXPANDED = 10_000
#: Vectors asked for links by brute force, at first and at most; how many of them must have some, vectors of
#: large families (by links) aside; and the recall below which the overlap is doubled.
AUDIT = 512
AUDITS = 8192
AUDITED = 100
LARGE = 64
RECALL = 0.95


# ---------------------------------------------------------------- graph


def prune(cosines: np.ndarray, node: int, candidates: np.ndarray) -> list[int]:
    """Robust pruning of a node's candidates, nearest first: each chosen one drops those that are ALPHA
    times nearer to it than to the node."""
    chosen: list[int] = []
    while len(candidates) and len(chosen) < DEGREE:
        best, candidates = int(candidates[0]), candidates[1:]
        chosen.append(best)
        candidates = candidates[ALPHA * (1 - cosines[best, candidates]) > 1 - cosines[node, candidates]]
    return chosen


def build(units: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adjacency of the united graphs of overlapping clusters, as the end of each node's list and the
    lists one after the other, and the clusters' medoids, where searches start."""
    n = len(units)
    count = max(1, -(-n // CLUSTER))
    picks = np.random.default_rng(seed).choice(n, count, replace=False)
    near = np.argsort(-(units @ units[picks].T), axis=1, kind="stable")[:, : min(CLUSTERS, count)]
    lists: list[set[int]] = [set() for _ in range(n)]
    medoids = []
    for c in range(count):
        members = np.flatnonzero((near == c).any(axis=1))
        if not len(members):
            continue
        cosines = units[members] @ units[members].T
        medoids.append(int(members[cosines.sum(axis=1).argmax()]))
        order = np.argsort(-cosines, axis=1, kind="stable")[:, : 4 * DEGREE + 1]
        for i, node in enumerate(members):
            own = order[i][order[i] != i]
            for j in members[prune(cosines, i, own)]:
                lists[node].add(int(j))
                lists[int(j)].add(int(node))  # edges work both ways
    ends = np.cumsum([len(x) for x in lists])
    return ends, np.array([j for x in lists for j in sorted(x)], np.int64), np.array(sorted(set(medoids)), np.int64)


def search(
    queries: np.ndarray, units: np.ndarray, ends: np.ndarray, edges: np.ndarray, medoids: np.ndarray,
    limit: float, own: np.ndarray | None = None,
) -> np.ndarray:
    """Which nodes each query reaches with a cosine of ``limit`` or more: a boolean matrix.

    Greedy rounds from the medoids (and, where queries are nodes, from these) expand the best nodes seen;
    then all nodes in range are expanded until no new one turns up."""
    n = len(units)
    found = np.zeros((len(queries), n), bool)
    for start in range(0, len(queries), QUERIES):
        part = queries[start : start + QUERIES]
        rows = np.arange(len(part))
        score = np.full((len(part), n), -2.0)
        score[:, medoids] = part @ units[medoids].T
        if own is not None:
            score[rows, own[start : start + QUERIES]] = 1.0
        waiting = np.where(score > -2.0, score, -3.0)  # seen and not expanded yet

        def expand(q: np.ndarray, nodes: np.ndarray) -> None:
            waiting[q, nodes] = -3.0
            for s in range(0, len(q), EXPANDED):
                some = nodes[s : s + EXPANDED]
                sizes = ends[some] - np.where(some, ends[some - 1], 0)
                last = np.cumsum(sizes)
                to = edges[np.arange(last[-1]) + np.repeat(ends[some] - last, sizes)]
                at = np.repeat(q[s : s + EXPANDED], sizes) * n + to
                at = np.unique(at[score.ravel()[at] == -2.0])
                i, j = np.divmod(at, n)
                score[i, j] = waiting[i, j] = np.einsum("ij,ij->i", part[i], units[j])

        width = min(WIDTH, n)
        for _ in range(ROUNDS):
            best = np.argpartition(-waiting, width - 1, axis=1)[:, :width]
            q, k = np.nonzero(waiting[rows[:, None], best] > -3.0)
            expand(q, best[q, k])
        while True:
            q, nodes = np.nonzero(waiting >= limit - SLACK)
            if not len(q):
                break
            expand(q, nodes)
        found[start : start + QUERIES] = score >= limit
    return found


def _spanning(pairs: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix the first node of its component."""
    root = np.full(len(pairs), -1)
    for i in range(len(pairs)):
        if root[i] < 0:
            new = np.array([i])
            while len(new):
                root[new] = i
                new = np.flatnonzero(pairs[new].any(axis=0) & (root < 0))
    return root


def across(units: np.ndarray, others: np.ndarray, limit: float) -> np.ndarray:
    """Which pairs of two blocks have a cosine of ``limit`` or more, by all cosines."""
    return units @ others.T >= limit


def _links(limit: float, exact: bool = False):
    """Counts and a spanning forest of the links between blocks i and j of a shard."""

    def links(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        shard, i, j = key[2], key[3], key[4]
        pdf = pdf.sort_values("row").reset_index(drop=True)
        units = np.stack(pdf["unit"].to_list()).astype(float)
        block = pdf["mine"].to_numpy()
        linked = np.zeros((len(pdf), len(pdf)), bool)
        if i == j and exact:
            linked |= across(units, units, limit)
        elif i == j:
            linked |= search(units, units, *build(units), limit, np.arange(len(units)))
        else:
            nodes, other = np.flatnonzero(block == i), np.flatnonzero(block == j)
            linked[np.ix_(nodes, other)] = across(units[nodes], units[other], limit)
        linked |= linked.T
        np.fill_diagonal(linked, False)
        # A pair that shares several shards counts in the first of them.
        shards = np.stack(pdf["shards"].to_list())
        a, b = np.nonzero(linked)
        both = (shards[a][:, :, None] == shards[b][:, None, :]).any(axis=2)
        both &= shards[a] >= 0  # fillers are no shards
        counts = np.where(both, shards[a], np.iinfo(np.int32).max).min(axis=1) == shard
        times = np.bincount(a[counts], pdf["copies"].to_numpy()[b[counts]], len(pdf)).astype(np.int64)
        rows = pdf["row"].to_numpy()
        out = pd.DataFrame({"a": rows, "b": rows[_spanning(linked)], "n": times})
        return out[(out["a"] != out["b"]) | (out["n"] > 0)]

    return links


# ---------------------------------------------------------------- jobs


def clean(vectors: DataFrame) -> DataFrame:
    """Rows with a number and the unit vector; null where a vector cannot be linked."""
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    usable = (
        F.col("label").isNotNull() & F.col("embedding").isNotNull()
        & F.coalesce(F.forall(numbers, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))), F.lit(False))
        & F.coalesce(F.exists(numbers, lambda x: x != 0), F.lit(False))
    )

    def divided(v, by):
        return bound(by, lambda n: F.transform(v, lambda x: x / n))

    def unit_of(v):
        scaled = divided(v, F.array_max(F.transform(v, lambda x: F.abs(x))))
        return bound(scaled, lambda s: divided(s, F.sqrt(F.aggregate(s, F.lit(0.0), lambda t, x: t + x * x))))

    unit = F.when(usable, bound(numbers, unit_of))
    return vectors.select("vec_id", "label", unit.alias("unit")).withColumn("row", F.monotonically_increasing_id())


def choose_pivots(nodes: DataFrame) -> dict[tuple, np.ndarray]:
    """Pivots of each (label, dim) from a sample of at most ``SAMPLE`` vectors, one for ``SHARD`` vectors
    of the label, ``PIVOTS`` in all at most, no two closer than ``APART``.  Only they are sampled: every
    vector is indexed and searched."""
    sizes = {(r["label"], r["dim"]): r["count"] for r in nodes.groupBy("label", "dim").count().orderBy(
        F.desc("count"), "label", "dim").limit(PIVOTS).collect()}
    share = max(SHARD, sum(sizes.values()) / PIVOTS)
    sample = nodes.select("row", "label", "dim", "unit").orderBy(F.xxhash64("row"), "row").limit(SAMPLE).toPandas()
    pivots = {}
    for key, pdf in sample.groupby(["label", "dim"]):
        units, chosen = np.stack(pdf["unit"].to_list()), []
        for x in units:
            if not chosen or (np.stack(chosen) @ x).max() < APART:
                chosen.append(x)
            if len(chosen) >= -(-sizes.get(key, 1) // share):
                break
        pivots[key] = np.stack(chosen)
    return pivots


def assign(nodes: DataFrame, pivots: dict[tuple, np.ndarray], overlap: int) -> DataFrame:
    """Adds ``shards``: the numbers of the ``overlap`` nearest pivots."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            shards = np.zeros((len(pdf), overlap), np.int32) - np.arange(overlap, dtype=np.int32)
            for key, at in pdf.groupby(["label", "dim"]).indices.items():
                if key in pivots:
                    near = np.argsort(-(np.stack(pdf["unit"].iloc[at].to_list()) @ pivots[key].T), axis=1, kind="stable")
                    shards[at, : min(overlap, near.shape[1])] = near[:, :overlap]
            yield pdf.assign(shards=list(shards))

    return nodes.mapInPandas(
        add, "row BIGINT, label BIGINT, dim INT, unit ARRAY<DOUBLE>, copies BIGINT, shards ARRAY<INT>"
    )


def find(
    nodes: DataFrame, pivots: dict[tuple, np.ndarray], overlap: int, scratch: Scratch, exact: bool = False
) -> DataFrame:
    """(a, b, n): a vector with links, another of its component or itself, and how many links were seen."""
    assigned = scratch.save(assign(nodes, pivots, overlap))
    placed = assigned.withColumn("shard", F.explode(F.filter("shards", lambda x: x >= 0)))
    group = ["label", "dim", "shard"]
    sizes = placed.groupBy(*group).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    pairs = (
        spread_join(placed, sizes, group).withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("*", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    )
    return scratch.save(
        pairs.select("row", "unit", "copies", "shards", "mine", *group, "i", "j").groupBy(*group, "i", "j")
        .applyInPandas(_links(LIMIT, exact), "a BIGINT, b BIGINT, n BIGINT")
    )


def known_links(nodes: DataFrame, scratch: Scratch) -> DataFrame | None:
    """(row, n, large) of sampled vectors that have links: how many, by brute force over all vectors, in blocks,
    and whether to more than ``LARGE`` others.  Vectors are asked until ``AUDITED`` with few links are known,
    ``AUDITS`` at most.  None if no vector is asked."""
    asked = AUDIT
    while True:
        chosen = nodes.select("row", "label", "dim", "unit").orderBy(F.xxhash64("row", F.lit(1)), "row").limit(asked)
        pdf = chosen.toPandas()
        if not len(pdf):
            return None
        groups = {k: (p["row"].to_numpy(), np.stack(p["unit"].to_list())) for k, p in pdf.groupby(["label", "dim"])}
        known = scratch.save(
            nodes.mapInPandas(_counter(groups), "row BIGINT, n BIGINT, others BIGINT").groupBy("row")
            .agg(F.sum("n").alias("n"), (F.sum("others") > LARGE).alias("large"))
        )
        if len(pdf) < asked or asked >= AUDITS or known.where("NOT large").count() >= AUDITED:
            return known
        asked = min(4 * asked, AUDITS)


def _counter(groups: dict[tuple, tuple[np.ndarray, np.ndarray]]):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for key, at in pdf.groupby(["label", "dim"]).indices.items():
                if key in groups:
                    rows, units = groups[key]
                    part = pdf.iloc[at]
                    linked = across(units, np.stack(part["unit"].to_list()), LIMIT)
                    linked &= rows[:, None] != part["row"].to_numpy()[None, :]
                    out = pd.DataFrame({
                        "row": rows, "n": linked @ part["copies"].to_numpy(), "others": linked.sum(axis=1),
                    })
                    yield out[out["others"] > 0]

    return count


def audit(known: DataFrame | None, found: DataFrame) -> float:
    """Mean share of the links of a vector that were found: of vectors with few links or of those in large
    families, whichever is less."""
    if known is None:
        return 1.0
    seen = found.groupBy(F.col("a").alias("row")).agg(F.sum("n").alias("seen"))
    share = F.least(F.lit(1.0), F.coalesce("seen", F.lit(0)) / F.col("n"))
    means = known.join(seen, "row", "left").groupBy("large").agg(F.avg(share).alias("share"))
    return means.agg(F.coalesce(F.min("share"), F.lit(1.0))).first()[0]


def near_duplicates(vectors: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): row, vec_id, n_links, component_id, kept.

    Only vectors with equal labels, not null, and equal length are compared.  Null, empty and zero
    vectors and those with a null or non-finite component link with nothing and are kept.  Equal vectors
    are one node with a number of copies, so repeated rows are links without being searched.  Of each
    component the row with the smallest vec_id is kept, of repeated rows the first; a null vec_id can be
    linked but names a component only if nothing else does.  An empty table gives no row; other columns
    are ignored.
    """
    all_rows = scratch.save(clean(vectors.select("vec_id", F.col("label").cast("bigint"), "embedding")))
    key = ["label", "h1", "h2"]
    hashed = all_rows.where("unit IS NOT NULL").select(
        "row", "vec_id", "label", "unit", F.xxhash64("unit").alias("h1"), F.xxhash64(F.lit(1), "unit").alias("h2")
    )
    classes = hashed.groupBy(*key).agg(F.min("row").alias("node"), F.count("*").alias("copies"))
    member = scratch.save(spread_join(hashed.drop("unit"), classes, key).select("row", "node", "copies"))
    nodes = scratch.save(
        all_rows.join(member.where("row = node").select("row", "copies"), "row")
        .select("row", "label", F.size("unit").alias("dim"), "unit", "copies")
    )
    pivots, overlap = choose_pivots(nodes), OVERLAP
    found = find(nodes, pivots, overlap, scratch)
    known, most = known_links(nodes, scratch), max(map(len, pivots.values()), default=0)
    while audit(known, found) < RECALL:
        overlap *= 2
        # Shards that overlap so often hold more pairs than there are, and graphs may miss some: all cosines.
        exact = overlap * overlap > most
        if exact:
            pivots, overlap = {key: units[:1] for key, units in pivots.items()}, 1
        found = find(nodes, pivots, overlap, scratch, exact)
        if exact:
            break
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    parts = components(found.select("a", "b"), scratch)
    named = (
        all_rows.select("row", "vec_id").join(member, "row", "left")
        .withColumns({"node": F.coalesce("node", "row"), "copies": F.coalesce("copies", F.lit(1))})
    )
    named = spread_join(named, counts, ["node"], "left")
    named = scratch.save(
        spread_join(named, parts, ["node"], "left").select(
            "row", "vec_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    first = named.groupBy("component").agg(
        F.min(F.struct(F.col("vec_id").isNull(), "vec_id", "row")).alias("first")
    ).select("component", F.col("first.vec_id").alias("component_id"), F.col("first.row").alias("first"))
    return spread_join(named, first, ["component"]).select(
        "row", "vec_id", "n_links", "component_id", (F.col("row") == F.col("first")).alias("kept")
    )
