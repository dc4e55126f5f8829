import numpy as np
import pytest

from retailmarts.llm import vectors
from retailmarts.llm.common import read


def brute(rows):
    """(vec_id: n_links, component_id, kept) by all cosines."""
    unit, root = {}, {}
    for k, (i, v, label) in enumerate(rows):
        root[k] = k
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            a = np.array(v, float)
            unit[k] = a / np.abs(a).max() / np.linalg.norm(a / np.abs(a).max())
    n = dict.fromkeys(root, 0)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in unit:
        for b in unit:
            if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98:
                n[a] += 1
                n[b] += 1
                root[max(top(a), top(b))] = min(top(a), top(b))
    out = []
    for k, (i, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in root if top(j) == top(k) and rows[j][0] is not None]
        out.append((i, n[k], min(ids, default=None)))
    return out


def result(df, scratch):
    return vectors.near_duplicates(df, scratch).collect()


def compare(spark, scratch, rows, recall=1.0):
    df = spark.createDataFrame([(*r, 1.5) for r in rows], "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, unit DOUBLE")
    got = result(df, scratch)
    want = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], s) for i, v, s in rows])
    order = lambda t: (t[0] is None, t[0] or 0, *map(str, t[1:]))
    have = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=order)
    assert sum(t[1] for t in have) >= recall * sum(t[1] for t in want)
    if recall == 1.0:
        assert have == sorted(want, key=order)
    return got


def families(rng, sizes, noise, dim=32):
    rows = []
    for size in sizes:
        center = rng.normal(size=dim)
        rows += [center + rng.normal(size=dim) * noise for _ in range(size)]
    return rows


def test_families_copies_and_blocks(spark, scratch, monkeypatch):
    rng = np.random.default_rng(1)
    vs = families(rng, [300, 40, 2, 2, 1, 1, 1] + [1] * 200, 0.1)
    rows = [(i, list(map(float, v)), 1) for i, v in enumerate(vs)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(50)] + [(2000, rows[0][1], 2), (2001, [2 * x for x in rows[5][1]], 1)]
    compare(spark, scratch, rows)


def test_odd_vectors(spark, scratch):
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, float("nan")], 1),
        (6, [1.0, float("inf")], 1), (7, [1.0, 0.0], None), (8, [1.0, 0.0], None), (9, [1.0, 0.0], 1),
        (10, [3.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1), (12, [1e30, 1e28], 1), (None, [1.0, 0.01], 1),
        (13, [-1.0, 0.0], 1), (14, [1.0, 0.0], 2), (14, [1.0, 0.0], 2), (None, None, None),
    ]
    got = compare(spark, scratch, rows)
    assert sorted(r["vec_id"] for r in got if r["kept"] and r["vec_id"] is not None) == [
        1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 13, 14,
    ]


def test_empty(spark, scratch):
    df = spark.createDataFrame([], "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT")
    assert result(df, scratch) == []


def test_given_table(spark, scratch):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in read(spark, "/root/testdata/sf0.1", "embeddings").collect()]
    compare(spark, scratch, rows, recall=0.99)


@pytest.mark.parametrize("n", [1, 2, 40, 1500])
def test_search_reaches_what_is_in_range(n):
    rng = np.random.default_rng(n)
    units = np.array(families(rng, [max(1, n // 3)] + [1] * (n - max(1, n // 3)), 0.08))
    units /= np.linalg.norm(units, axis=1)[:, None]
    exact = units @ units.T >= 0.98
    found = vectors.search(units, units, *vectors.build(units), 0.98)  # from the medoids alone
    assert not (found & ~exact).any()
    assert found.sum() >= 0.95 * exact.sum()
