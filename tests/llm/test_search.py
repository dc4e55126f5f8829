import re
from collections import Counter
from math import floor, log

import numpy as np
import pytest

from retailmarts.llm import search
from retailmarts.llm.common import read
from tests.conftest import SF

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(LETTERS, LETTERS.lower())


def plain_terms(text):
    return re.findall(search.TERM, (text or "").translate(LOWER))


def brute(docs, items, best=search.BEST):
    """Every item against every document, by the formula."""
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, length = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in counts:
            m = 50 + (50 * n * n_docs) // length
            score = sum(
                floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(plain_terms(text)) if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:best], 1)]
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame([(i, t, "a", 1) for i, t in rows], "item_id BIGINT, text STRING, terms STRING, number INT")


@pytest.mark.parametrize("text", ["", "Ab-c ÀÉ ß9_x\x00y\x7fz", " \n\t", "日本 語ABC", "a" * 50 + " b " * 400])
def test_terms(text, monkeypatch):
    monkeypatch.setattr(search, "CHUNK", 7)
    assert {t.decode(): n for t, n in search.terms(text.encode()).items()} == Counter(plain_terms(text))


@pytest.mark.parametrize("seed", range(6))
def test_tree_finds_what_all_cells_give(seed, monkeypatch):
    monkeypatch.setattr(search, "STEP", 3)
    rng = np.random.default_rng(seed)
    rows, columns = (int(x) for x in rng.integers(1, 60, 2))
    grid = rng.integers(1, 9, (rows, columns)) * (rng.random((rows, columns)) < rng.choice([0.05, 0.3, 0.9]))
    grid[0, 0] = 5
    row, column = np.nonzero(grid)
    made = search.build(row, column, grid[row, column])
    made.pop("starts")
    tree = search.Tree(**made)
    asked = [rng.permutation(rows)[: int(rng.integers(1, rows + 1))] for _ in range(5)]
    weights = [rng.integers(0, 4, len(a)) for a in asked]
    item = np.repeat(np.arange(5), [len(a) for a in asked])
    row = np.concatenate(asked)
    for floor, best in ((1, 5), (1, 1000), (20, 3)):
        floors = np.array([floor, 1, floor, 10**9, floor])
        found = search.best_documents(tree, item, row, tree.starts(row), np.concatenate(weights), floors, best)
        for n in range(5):
            want = weights[n] @ grid[asked[n]]
            least = max(floors[n], *np.sort(want)[::-1][best - 1: best].tolist()) if len(want) >= best else floors[n]
            got = {int(c): int(s) for i, c, s in zip(*found) if i == n}
            assert got == {c: int(w) for c, w in enumerate(want) if w >= least}


def test_given_tables(spark, scratch):
    docs, bench = read(spark, SF, "documents"), read(spark, SF, "benchmark")
    got = result(search.rank_documents(docs.repartition(7), bench, scratch))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])


def test_odd_rows(scratch, documents, items, monkeypatch):
    monkeypatch.setattr(search, "CELLS", 4)
    monkeypatch.setattr(search, "ITEM_BYTES", 8)
    docs = [(i, "same words here", "a") for i in range(70)]
    docs += [(None, "same words here", "a"), (5, "same words here", "a"), (None, None, None), (80, "", "a"), (81, " - ", "a")]
    docs += [(82, "long " * 30_000 + "tail Words", "a"), (83, "Éa éa", "a"), (83, "other", "b")]
    asked = [(1, "WORDS words here"), (2, None), (3, ""), (None, "tail éa"), (4, "absent"), (5, "other"), (5, "other")]
    table = documents(docs).drop("score")
    assert result(search.rank_documents(table, items(asked), scratch)) == brute([d[:2] for d in docs], asked)


def test_empty(scratch, documents, items):
    assert search.rank_documents(documents([]), items([(1, "a")]), scratch).count() == 0
    assert search.rank_documents(documents([(1, "a", "b")]), items([]), scratch).count() == 0
