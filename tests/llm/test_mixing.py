import heapq
import random

import pytest
from pyspark.sql import functions as F

from retailmarts.llm import mixing
from retailmarts.llm.queries import op4_source_mix
from tests.conftest import SF


def targets(sizes, weights, passes=3):
    """Water-filling as stated: cap, share the rest anew, until none is above."""
    target, free, left = {}, set(sizes), float(sum(sizes.values()))
    while free:
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = [s for s in free if share[s] > passes * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = passes * sizes[s]
            left -= target[s]
            free.remove(s)
    return target


def quotients(weights, seats):
    heap = [(-w, i, 0) for i, w in enumerate(weights) if w > 0]
    heapq.heapify(heap)
    won = [0] * len(weights)
    while seats and heap:
        _, i, k = heapq.heappop(heap)
        won[i] += 1
        heapq.heappush(heap, (-weights[i] / (2 * k + 3), i, k + 1))
        seats -= 1
    return won


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 12345])
def test_highest_quotients(spark, scratch, seats):
    rng = random.Random(seats)
    weights = [rng.choice([0.0, 1.0, 1.0, 5.5, rng.random() * 1000]) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(weights)), "i INT, w DOUBLE")
    got = mixing.highest_quotients(df, "w", seats, [F.col("i")], scratch)
    assert [r["seats"] for r in got.orderBy("i").collect()] == quotients(weights, seats)


def check(rows):
    """Targets, limits and closeness of a result of the query."""
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(r["size"] for r in rows if r["source"] == s) for s in sources}
    want = targets(sizes, {s: i % 3 + 1 for i, s in enumerate(sources)})
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"]
    for s in sources:
        taken = sum(r["taken"] for r in rows if r["source"] == s)
        assert abs(taken - want[s]) <= max(mixing.BLOCK, 0.01 * want[s]), s


def test_query(spark):
    once, again = (sorted(map(tuple, op4_source_mix(spark, SF).collect())) for _ in range(2))
    assert once == again
    check(op4_source_mix(spark, SF).collect())


def test_hot_and_small_sources(spark, scratch, documents):
    rng = random.Random(3)
    text = lambda n: " ".join(["w"] * n)
    rows = [(i, text(rng.randrange(1, 90)), "hot") for i in range(400)]
    rows += [(1000 + i, text(rng.randrange(1, 300)), s) for i in range(60) for s in ("", "b", None)]
    rows += [(5000, text(30_000), "c"), (5001, None, "d"), (None, "", "d"), (5002, text(20), "e"), (5002, text(20), "e")]
    docs = documents(rows)
    mixed = mixing.mix(docs, scratch)
    got = mixed.collect()
    assert len(got) == len(rows)
    check(got)
    # The texts of the mix hold the words that were counted, and nothing else changes.
    texts = mixing.mixed_texts(mixed, docs.columns)
    assert texts.columns == docs.columns
    words = {}
    for r in texts.collect():
        assert (r["kept"], r["size"], r["n_chars"]) == ("x", "y", len(r["text"]))
        words[r["source"]] = words.get(r["source"], 0) + len(r["text"].split())
    for s in words:
        assert words[s] == sum(r["taken"] for r in got if r["source"] == s)


def test_cut_texts_are_runs_of_words(spark, scratch, documents):
    docs = documents([(1, " ".join(f"w{i}" for i in range(500)), "a"), (2, " ".join(f"v{i}" for i in range(3000)), "b")])
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in mixing.mixed_texts(mixing.mix(docs, scratch), ["doc_id", "text"]).collect():
        parts = r["text"].split()
        starts = [i for i in range(len(parts)) if i == 0 or int(parts[i][1:]) != int(parts[i - 1][1:]) + 1]
        assert len(starts) <= 2 and set(parts) <= set(whole[r["doc_id"]].split())


def test_empty(documents, scratch):
    docs = documents([])
    mixed = mixing.mix(docs, scratch)
    assert mixed.count() == 0 and mixing.mixed_texts(mixed, docs.columns).count() == 0


def test_rows_that_share_an_id_are_mixed_alike_in_any_layout(spark):
    from pyspark.sql import functions as F

    from retailmarts.llm.common import Scratch, word_count

    rows = [(i % 300 if i < 300 else 7, f"w{i} " * (i % 23), "s") for i in range(600)]
    table = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING").union(
        spark.createDataFrame([(1, "x " * 400, "t")], "doc_id BIGINT, text STRING, source STRING"))

    def taken(docs, whole):
        if not whole:
            docs = docs.select("doc_id", "source", word_count("text").alias("size"), F.xxhash64("text").alias("mark"), "text")
            docs = docs.withColumnRenamed("text", "told")
        told = mixing.mix(docs, Scratch(spark, "test")).select("doc_id", "text" if whole else "extra.told", "taken")
        return sorted(map(tuple, told.collect()))

    for whole in (True, False):
        once = taken(table.coalesce(1), whole)
        assert once == taken(table.orderBy(F.rand(3)).repartition(5), whole)
