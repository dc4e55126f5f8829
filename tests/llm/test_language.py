import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailmarts.llm import language
from retailmarts.llm.common import read
from retailmarts.llm.queries import op6_language
from tests.conftest import SF


def plain_grams(text):
    counts = Counter()
    for word in language._LETTERS.findall((text or "").lower()):
        marked = f" {word} "
        for n in range(1, language.LONGEST + 1):
            counts.update(g for i in range(len(marked) - n + 1) if (g := marked[i : i + n]) != " ")
    return counts


def code(gram):
    total = 0
    for unit in np.frombuffer(gram.encode("utf-16-le"), "<u2").tolist():
        total = (total << 16) | unit
    return total


@pytest.mark.parametrize("text", [None, "", "12 %", "a", "The the, thé!", "ab-cd ef_gh1i", "é" * 9, "x y z " * 40])
@pytest.mark.parametrize("stretch", [7, 200_000])
def test_grams(monkeypatch, text, stretch):
    monkeypatch.setattr(language, "STRETCH", stretch)
    codes, counts = language.gram_counts(text)
    assert dict(zip(codes.tolist(), counts.tolist())) == {code(g): n for g, n in plain_grams(text).items()}


def test_out_of_place_distance():
    profiles = {"b": np.array([1, 2, 3]), "a": np.array([3, 2, 1])}
    tables = language._tables(profiles)
    counts = {1: 9, 2: 5, 4: 1}
    original = language.gram_counts
    try:
        language.gram_counts = lambda _: (np.array(list(counts)), np.array(list(counts.values())))
        lang, score = language.identify("x", tables, 3)
    finally:
        language.gram_counts = original
    assert (lang, score) == ("b", pytest.approx(1 - 3 / 9))  # only the unknown n-gram costs, three places


def test_query(spark):
    got = {r["doc_id"]: r for r in op6_language(spark, SF).collect()}
    docs = read(spark, SF, "documents").collect()
    assert len(got) == len(docs)
    right = total = 0
    for r in docs:
        held = zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        assert got[r["doc_id"]]["held_out"] == held and 0 <= got[r["doc_id"]]["score"] <= 1
        if held and r["lang"]:
            total += 1
            right += got[r["doc_id"]]["lang_pred"] == r["lang"]
    assert right >= 0.95 * total  # held-out accuracy


def test_profiles_are_those_of_all_rows(spark):
    rows = [(f"wort{i % 7} der die", "de") for i in range(30)] + [("the of and", "en"), (None, "en"), ("x", None)]
    df = spark.createDataFrame(rows, "text STRING, lang STRING").repartition(5)
    got = language.learn(df, 5)
    counts = Counter()
    for t, lang in rows:
        if lang == "de":
            counts += plain_grams(t)
    want = sorted(counts, key=lambda g: (-counts[g], code(g)))[:5]
    assert got["de"].tolist() == [code(g) for g in want] and set(got) == {"de", "en"}


def test_odd_rows(spark, documents):
    df = documents([(1, None, "a"), (2, "", "a"), (3, "123 ...", None), (None, "the of and the", "a"), (4, "the " * 99999, "a")])
    profiles = language.learn(spark.createDataFrame([("the of and", "en"), ("der die das", "de")], "text STRING, lang STRING"))
    got = {r["doc_id"]: (r["lang_pred"], r["score"] > 0) for r in language.predict(df, profiles).collect()}
    assert got == {1: ("und", False), 2: ("und", False), 3: ("und", False), None: ("en", True), 4: ("en", True)}
    assert {r["lang_pred"] for r in language.predict(df, {}).collect()} == {"und"}
    kept = language.accept(df, profiles, 0.1)
    assert kept.columns == df.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 4]
    assert language.predict(df.limit(0), profiles).count() == 0
    assert language.learn(df.select("text", F.lit(None).cast("string").alias("lang"))) == {}
