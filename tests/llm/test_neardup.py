import random

import numpy as np
import pytest

from retailmarts.llm import neardup
from retailmarts.llm.common import read
from retailmarts.llm.queries import op9_near_duplicates
from tests.conftest import SF


def sets(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} if words else set()


def brute(docs, limit=85):
    """(doc_id, set size, component) by comparing all pairs."""
    found, root = [sets(t) for _, t in docs], list(range(len(docs)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if found[a] and found[b] and top(a) != top(b):
                both = len(found[a] & found[b])
                if 100 * both >= limit * (len(found[a]) + len(found[b]) - both):
                    root[max(top(a), top(b))] = min(top(a), top(b))
    out = []
    for k, (i, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if top(j) == top(k) and docs[j][0] is not None]
        out.append((i, len(found[k]), min(ids, default=None)))
    return out


def order(row):
    return [(x is None, x or 0) for x in row]


def check(rows, docs, limit=85):
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows]
    assert sorted(got, key=order) == sorted(brute(docs, limit), key=order)


def family(rng, size, length, edits):
    base = [f"b{rng.randrange(10**6)}" for _ in range(length)]
    out = []
    for _ in range(size):
        words = list(base)
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(length)] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in read(spark, SF, "documents").collect()]
    rows = op9_near_duplicates(spark, SF).collect()
    check(rows, docs)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


@pytest.mark.parametrize("limit, block", [(85, 1024), (80, 16)])
def test_families(scratch, documents, monkeypatch, limit, block):
    """Groups around the limit, whose members are linked with some of the others only."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(limit)
    texts = family(rng, 120, 200, 9) + family(rng, 60, 60, 4) + family(rng, 30, 12, 2) + family(rng, 40, 400, 40)
    texts += ["copy of one text that is long enough"] * 50
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    check(neardup.near_duplicates(documents([(i, t, "s") for i, t in docs]), scratch, limit).collect(), docs, limit)


def test_odd_rows(scratch, documents):
    long = " ".join(f"w{i}" for i in range(60_000))
    docs = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (None, "a b c d e f g"),
        (7, "A B C D E F G"), (None, "only null has this text here"), (8, long), (9, long + " end"), (10, "x"), (10, "x"),
        (11, "ä b c d e"), (12, "Ä b c d e"), (13, "same id first text of two"), (13, "same id second one with more words"),
    ]
    rows = neardup.near_duplicates(documents([(i, t, None) for i, t in docs]), scratch).collect()
    check(rows, docs)
    assert sum(r["kept"] for r in rows if r["doc_id"] == 10) == 1
    kept = neardup.keep_one(documents([(i, t, None) for i, t in docs]), scratch)
    left = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1] or ""))
    assert [i for i, _ in left] == [1, 2, 3, 4, 6, 7, 8, 10, 11, 12, 13, 13, None]


def test_empty(scratch, documents):
    docs = documents([])
    assert neardup.near_duplicates(docs, scratch).count() == 0
    assert neardup.keep_one(docs, scratch).columns == docs.columns


def test_sketches_estimate_and_merge():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    for n, shared in ((1, 1), (20, 18), (400, 340), (1000, 500)):
        a, b = np.unique(pool[:n]), np.unique(pool[n - shared : 2 * n - shared])
        ra, rb, union = neardup.sketches([a, b, np.union1d(a, b)])
        assert (np.maximum(ra, rb) == union).all()  # registers are mergeable
        one = lambda x: np.array([x], float)
        j = neardup.similarity(one((ra > rb).sum()), one((ra < rb).sum()), one(n), one(n))[0]
        exact = shared / (2 * n - shared)
        assert abs(j - exact) < 5 * (exact * (1 - exact) / neardup.REGISTERS) ** 0.5 + 0.01


def test_sketches_do_not_depend_on_their_neighbours():
    rng = np.random.default_rng(2)
    items = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (0, 1, 3, 50, 60, 900, 5000)]
    together = neardup.sketches(items)
    assert all((neardup.sketches([x])[0] == r).mean() > 0.99 for x, r in zip(items, together))


def test_stretches_make_no_difference(monkeypatch):
    text = " ".join(f"Word{i}" for i in range(300))
    whole = neardup.shingles(text)
    monkeypatch.setattr(neardup, "STRETCH", 50)
    assert (neardup.shingles(text) == whole).all() and len(whole) == 296
