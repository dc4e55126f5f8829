"""Links across blocks, and an audit that sees rare links and small groups."""

import numpy as np

from retailmarts.llm import vectors
from tests.llm.test_vectors import compare, families


def dense(rng, sizes, dim=32):
    """Families of close vectors in one dense region: below the limit from each other, but with one pivot."""
    middle, rows = rng.normal(size=dim), []
    middle /= np.linalg.norm(middle)
    for size in sizes:
        away = rng.normal(size=dim)
        center = middle + 0.32 * away / np.linalg.norm(away)
        rows += [center + rng.normal(size=dim) * 0.012 for _ in range(size)]
    return rows


def test_families_across_blocks(spark, scratch, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 400)
    monkeypatch.setattr(vectors, "RECALL", 0.0)
    rng = np.random.default_rng(3)
    rows = [(i, list(map(float, v)), 1) for i, v in enumerate(dense(rng, [150] * 8))]
    compare(spark, scratch, rows)


def test_audit_weighs_vectors_not_links(spark, scratch):
    """A family of 300 found whole does not hide that every pair was missed."""
    rng = np.random.default_rng(5)
    units = np.array(families(rng, [300] + [2] * 60, 0.02))
    units /= np.linalg.norm(units, axis=1)[:, None]
    nodes = spark.createDataFrame(
        [(i, 1, 32, u.tolist(), 1) for i, u in enumerate(units)], "row BIGINT, label BIGINT, dim INT, unit ARRAY<DOUBLE>, copies BIGINT")
    found = spark.createDataFrame([(i, 0, 299) for i in range(300)], "a BIGINT, b BIGINT, n BIGINT")
    known = vectors.known_links(nodes, scratch)
    assert {r["row"]: r["n"] for r in known.collect()} == {i: 299 if i < 300 else 1 for i in range(420)}
    assert vectors.audit(known, found) == 0.0


def test_a_recall_that_stays_low_ends_in_all_cosines(spark, scratch, monkeypatch):
    """A search that finds nothing, and rare links: more vectors are asked and all are compared exactly."""
    monkeypatch.setattr(vectors, "AUDIT", 4)
    graphs, saw = vectors.find, []

    def find(nodes, pivots, overlap, scratch, exact=False):
        saw.append(exact)
        found = graphs(nodes, pivots, overlap, scratch, exact)
        return found if exact else found.limit(0)

    monkeypatch.setattr(vectors, "find", find)
    rng = np.random.default_rng(6)
    rows = [(i, list(map(float, v)), i % 2) for i, v in enumerate(families(rng, [2, 2, 3] + [1] * 300, 0.02))]
    rows += [(1000 + i, v, 1 - label) for i, v, label in rows]
    compare(spark, scratch, rows)
    assert saw[-1] and not saw[0]


def test_spanning_of_a_chain():
    pairs = np.zeros((6, 6), bool)
    for a, b in ((4, 2), (2, 5), (1, 3)):
        pairs[a, b] = pairs[b, a] = True
    assert vectors._spanning(pairs).tolist() == [0, 1, 2, 1, 2, 2]
