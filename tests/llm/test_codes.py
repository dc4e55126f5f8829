import hashlib
import random

import numpy as np
import pytest

from retailmarts.llm import codes
from retailmarts.llm.common import read
from tests.conftest import SF

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, code STRING, v INT, n INT"


def brute(rows, parts=codes.PARTS, entries=codes.ENTRIES, rounds=codes.ROUNDS):
    """Plain lists, all distances in full."""
    kept = [
        (i, [int(np.floor(np.float64(np.float32(x)) * 4096)) for x in v], label) for i, v, label in rows
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def near(x, book):
        far = [(sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book)]
        return min(far)

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for _, v, _ in kept:
                held.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [
                [sum(c) // len(held[k]) for c in zip(*held[k])] if k in held else e for k, e in enumerate(books[p])
            ]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out, total = [], {}
    for i, v, label in kept:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        total[label] = total.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    return sorted(((i, c, e, total[label], sha) for i, c, e, label in out), key=repr)


def result(df):
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_given_table(spark, scratch):
    vectors = read(spark, SF, "embeddings")
    want = brute([(r.vec_id, r.embedding, r.label) for r in vectors.collect()])
    assert result(codes.compress(vectors.repartition(5), scratch)) == want


@pytest.mark.parametrize("length", [1, 2, 3, 5, 8, 11])
@pytest.mark.parametrize("scale", [3, 10_000, 1 << 40])
def test_nearest(length, scale):
    """Ties, all lengths, and numbers whose squares exceed 64 bits."""
    rng = np.random.default_rng(length)
    parts, entries = (rng.integers(-3, 4, (n, length)) * (scale // 3) for n in (200, 16))
    code, far = codes.nearest(parts, entries)
    for x, k, d in zip(parts.tolist(), code.tolist(), far.tolist()):
        all_far = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in entries.tolist()]
        assert (d, k) == (min(all_far), all_far.index(min(all_far)))


@pytest.mark.parametrize("length", [1, 2, 4, 8, 16])
def test_transform_is_in_sequency_order_and_scales_distances(length):
    h = codes.sequency_transform(length)
    assert (h @ h.T == length * np.eye(length, dtype=int)).all()
    assert [(r[1:] != r[:-1]).sum() for r in h] == list(range(length))


def odd(width):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(width)], rng.choice([1, 2, None])) for i in range(40)]
    rows += [rows[0], rows[1], (None, rows[2][1], 1), (3, rows[5][1], None)]
    bad = [None, [None] * width, [float("nan")] * width, [float("inf")] + [0.0] * (width - 1)]
    return rows + [(50 + k, v, 1) for k, v in enumerate(bad)]


@pytest.mark.parametrize("width", [8, 24, 40])
def test_odd_rows(spark, scratch, width):
    rows = odd(width)
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    assert result(codes.compress(table, scratch)) == brute(rows)


def test_fewer_vectors_than_entries(spark, scratch):
    rows = [(i, [float(i)] * 8, None) for i in range(3)]
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = result(codes.compress(table, scratch))
    assert got == brute(rows) and {r[2] for r in got} == {0}


def test_empty(spark, scratch):
    assert result(codes.compress(spark.createDataFrame([], SCHEMA), scratch)) == []


def test_lengths_without_common_parts(spark, scratch):
    for vectors in ([[1.0] * 8, [1.0] * 16], [[1.0] * 9]):
        table = spark.createDataFrame([(1, v, 1, "x", 1, 2) for v in vectors], SCHEMA)
        with pytest.raises(ValueError):
            codes.compress(table, scratch)


def test_decode(spark, scratch):
    cleaned = codes.clean(read(spark, SF, "embeddings"), scratch)
    books = codes.fit(cleaned)
    row = codes.encode(cleaned, books).first()
    vector = cleaned.where(f"vec_id = {row.vec_id}").first()["v"]
    far = sum((a - b * codes.SCALE) ** 2 for a, b in zip(vector, codes.decode(row["code"], books)))
    assert far == row["error"]
