import itertools
import random

from pyspark.sql import functions as F

from retailmarts.llm.common import components, running_sums, word_count


def test_running_sums(spark, scratch):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(50), rng.randrange(1, 9)) for _ in range(500)]
    df = spark.createDataFrame(rows, "g STRING, k INT, v BIGINT").repartition(7)
    got = running_sums(df, [F.col("g").asc_nulls_last(), F.col("k"), F.col("v")], {"before": "v"}, scratch)
    got = sorted(tuple(r) for r in got.select("before", "v").collect())
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1], r[2]))
    want = list(zip([0, *itertools.accumulate(r[2] for r in ordered)], [r[2] for r in ordered]))
    assert got == sorted(want)


def test_running_sums_of_nothing(spark, scratch):
    df = spark.createDataFrame([], "k INT, v BIGINT")
    assert running_sums(df, [F.col("k")], {"before": "v"}, scratch).count() == 0


def smallest(edges):
    root = {x: x for e in edges for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {x: top(x) for x in root}


def test_components(spark, scratch):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(500 + i, 500) for i in range(1, 60)]
    loose = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(130)]
    edges = chain + star + loose + star[:5]
    got = components(spark.createDataFrame(edges, "a BIGINT, b BIGINT"), scratch).collect()
    want = smallest([e for e in edges if e[0] != e[1]])
    assert {r["node"]: r["component"] for r in got} == want
    assert len(got) == len(want)


def test_components_of_nothing(spark, scratch):
    assert components(spark.createDataFrame([(1, 1)], "a BIGINT, b BIGINT"), scratch).count() == 0


def test_words(spark):
    texts = [(None, 0), ("", 0), (" \t\n\x0b\x0c\r", 0), ("a  b c\nd", 3), ("x", 1)]
    df = spark.createDataFrame(texts, "t STRING, n BIGINT")
    assert df.where(word_count("t") != F.col("n")).count() == 0
