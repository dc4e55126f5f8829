import pytest

from compare import difference
from retailmarts.llm import quality
from tests.conftest import SF


def test_query(spark):
    assert difference(spark, SF, "op1_line_frequency") == ""


def plain(text):
    """The base figures in plain Python."""
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    places = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(places))


TEXTS = [
    None, "", " \n\t", "a", "a b c", "a b c d", "a b c a b c", "a a a a", "x # * $ % & | < >", "ü 日本 𝄞 é",
    "l\nl\nl \nm\n\nl", "a b c", "a b c x a b c y b c x", "r\rr\x0bs", "k " * 200,
]


def test_base_figures(spark, scratch, documents):
    docs = documents([(i, t, "s") for i, t in enumerate(TEXTS)])
    got = {r["doc_id"]: tuple(r)[1:6] for r in quality.judge(docs, scratch).collect()}
    assert got == {i: plain(t) for i, t in enumerate(TEXTS)}


def verdicts(docs, scratch):
    return {r["doc_id"]: (r["kept"], r["n_boilerplate_words"]) for r in quality.judge(docs, scratch).collect()}


def own(i, n):
    return " ".join(f"w{i}x{k}" for k in range(n))


@pytest.mark.parametrize("host", ["a", None])
def test_common_lines_deplete(documents, scratch, host):
    """A line of more than ten documents of a host goes; copies of a document count once."""
    common = "Share, this PAGE 2024 with everyone " + own(777, 60)
    same = "share this page 1999 WITH everyone " + own(777, 60)  # the same normal form
    rows = [(i, own(i, 100) + "\n" + (common if i % 2 else same), host) for i in range(11)]
    rows += [(50, common + "\n" + own(50, 10), host), (51, own(51, 100), host), (52, common, "other")]
    rows += [(100 + i, own(999, 80), host) for i in range(40)]  # copies of one clean document
    got = verdicts(documents(rows), scratch)
    assert got[0] == (True, 66) and got[50] == (False, 66) and got[51] == (True, 0) and got[52] == (True, 0)
    assert all(got[100 + i] == (True, 0) for i in range(40))


def test_ties_stay(documents, scratch):
    rows = [(i, own(i, 60) + "\nshared line", "a") for i in range(10)]
    assert all(v == (True, 0) for v in verdicts(documents(rows), scratch).values())


def test_removed_lines(spark, scratch, documents):
    rows = [(i, own(i, 60) + "\nShared Line!\n\nend" + own(i, 2), "a") for i in range(12)]
    docs = documents(rows)
    judged = quality.judge(docs, scratch).withColumnRenamed("doc_id", "id")
    texts = docs.join(judged, docs["doc_id"] == judged["id"]).select(
        "doc_id", quality.without_lines(docs["text"], judged["boilerplate"]).alias("text")
    )
    assert {r["text"] for r in texts.collect()} == {own(i, 60) + "\n\nend" + own(i, 2) for i in range(12)}


def test_repeated_rows_and_empty(documents, scratch):
    rows = [(1, own(1, 60), "a"), (1, own(1, 60), "a"), (None, own(2, 60), None)]
    assert quality.judge(documents(rows), scratch).count() == 3
    assert quality.judge(documents([]), scratch).count() == 0
