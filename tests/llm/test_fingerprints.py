import hashlib
import re

import pytest
from pyspark.sql import functions as F

from retailmarts.llm import fingerprints as P
from retailmarts.llm.common import read
from tests.conftest import SF

SPACE = r"[\x20\x09-\x0D]+"


def hashes(spark, runs):
    """Shingle hashes by Spark's hash function: word hashes, then the hash of up to five of them."""
    rows = spark.createDataFrame([(r,) for r in runs], "r ARRAY<STRING>")
    words = [F.xxhash64(F.get("r", i)) for i in range(P.SHINGLE)]
    held = [F.when(F.size("r") > i, w) for i, w in enumerate(words)]
    return dict(zip([tuple(r) for r in runs], [x[0] for x in rows.select(F.xxhash64(*held)).collect()]))


def runs_of(text):
    words = [w for w in re.split(SPACE, text.lower()) if w]
    if not words:
        return []
    return [tuple(words[i:i + P.SHINGLE]) for i in range(max(len(words) - P.SHINGLE + 1, 1))]


def order_of(spark, bins):
    rows = spark.range(bins * bins).select(
        F.xxhash64((F.col("id") / bins).cast("int"), (F.col("id") % bins).cast("int"))
    ).collect()
    return [[rows[j * bins + i][0] for i in range(bins)] for j in range(bins)]


def brute_sketch(values, order, probes):
    """Bins filled one hash at a time; empty ones by their probes, then by rank."""
    if not values:
        return ""
    least = {}
    for h in values:
        b = (h >> 56) + 128
        least[b] = min(h, least.get(b, h))
    out = []
    for j in range(P.BINS):
        at = j
        if j not in least:
            tried = [t[j] for t in probes if t[j] in least]
            at = tried[0] if tried else min(least, key=lambda i: (order[j][i], i))
        out.append(least[at] & 255)
    return bytes(out).hex()


def alike(a, b):
    if not a or not b:
        return float(a == b)
    equal = sum(x == y for x, y in zip(bytes.fromhex(a), bytes.fromhex(b))) / P.BINS
    return max(0.0, (equal - 1 / 256) / (1 - 1 / 256))


def chain(spark, rows):
    """Documents in descending order (ids of None last, equal ids by the hashes) and their edited texts."""
    texts = sorted({t or "" for _, t in rows})
    marks = spark.createDataFrame([(t,) for t in texts], "t STRING").select(
        "t", F.shiftrightunsigned(F.xxhash64("t"), 1), F.xxhash64(F.lit(1), "t")).collect()
    mark = {m[0]: (m[1], m[2]) for m in marks}
    down = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, mark[r[1]]), reverse=True)
    out = []
    for k, (i, t) in enumerate(down):
        following = down[(k + 1) % len(down)][1]
        half = len(t) // 2
        out.append((i, t, t[:len(t) - half] + following[:half], following))
    return out


def brute(spark, rows):
    linked = chain(spark, rows)
    found = hashes(spark, sorted({r for _, t, e, f in linked for x in (t, e, f) for r in runs_of(x)}) or [("a",)])
    order, probes = order_of(spark, P.BINS), P._probes(P.BINS)
    made = {}

    def sketch(t):
        if t not in made:
            made[t] = brute_sketch([found[r] for r in runs_of(t)], order, probes)
        return made[t]

    return sorted(((
        i, len(t), hashlib.sha256(e.encode()).hexdigest(), sketch(t), sketch(e),
        round(alike(sketch(t), sketch(e)), 9), round(alike(sketch(t), sketch(f)), 9),
    ) for i, t, e, f in linked), key=repr)


def result(df):
    assert df.columns == [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    ]
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in df.collect()), key=repr)


def test_given_table(spark):
    docs = read(spark, SF, "documents").repartition(3)
    assert result(P.judge(docs)) == brute(spark, [(r.doc_id, r.text) for r in docs.collect()])


ODD = [
    (3, None, "a"), (3, "", "a"), (None, "no id but some words in it", "a"), (None, None, None), (7, " \n\t ", "b"),
    (8, "one", "a"), (9, "Two words", "a"), (10, "w " * 40_000 + "end", "a"), (11, "same text for these rows here", "a"),
    (11, "same text for these rows here", "a"), (12, "same text for these rows here", "b"), (13, "日本 語 é 𝒳y ß", "c"),
    (-5, "five words and then some more", "a"), (14, "x", "a"),
]


@pytest.mark.parametrize("chars", [2_000_000, 5_000, 200])
def test_odd_rows(spark, documents, monkeypatch, chars):
    monkeypatch.setattr(P, "RANGE_CHARS", chars)
    assert result(P.judge(documents(ODD))) == brute(spark, [(i, t) for i, t, _ in ODD])


@pytest.mark.parametrize("doc_id", [5, None])
def test_an_id_with_most_rows_is_spread(spark, documents, monkeypatch, doc_id):
    monkeypatch.setattr(P, "RANGE_CHARS", 100)
    rows = [(doc_id, f"text number {i % 40} of a frequent id", "a") for i in range(120)] + [(i, f"plain {i}", "a") for i in range(10, 70)]
    table = documents(rows)
    texts = table.select("doc_id", "text").withColumns({"h1": F.shiftrightunsigned(F.xxhash64("text"), 1), "h2": F.lit(0)})
    ranged = P._ranged(texts, *P._limits(texts)).where(F.col("doc_id").eqNullSafe(F.lit(doc_id)))
    assert ranged.select("range").distinct().count() > 10
    assert ranged.agg(F.count("*"), F.sum("copies")).first()[:] == (40, 120)
    assert result(P.judge(table)) == brute(spark, [(i, t) for i, t, _ in rows])


def test_one_row_and_none(spark, documents):
    assert result(P.judge(documents([(1, "a b c d e f", "a")]))) == brute(spark, [(1, "a b c d e f")])
    assert P.judge(documents([])).count() == 0


def test_likeness_follows_common_shingles(spark):
    """Over pairs of known overlap the mean estimate is near the true share."""
    rows = []
    for overlap in (0, 50, 80, 95):
        for k in range(30):
            words = [f"w{overlap}x{k}x{i}" for i in range(400)]
            rows.append((overlap, " ".join(words[:200]), " ".join(words[200 - 2 * overlap:400 - 2 * overlap])))
    table = spark.createDataFrame(rows, "overlap INT, a STRING, b STRING")
    near = P.likeness(P.sketch(F.col("a")), P.sketch(F.col("b")))
    found = {r[0]: r[1] for r in table.groupBy("overlap").agg(F.avg(near)).collect()}
    for overlap, mean in found.items():
        common = max(0, 2 * overlap - 4)
        assert abs(mean - common / (2 * 196 - common)) < 0.02


def test_main_path_is_native(spark):
    plan = P.judge(read(spark, SF, "documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
