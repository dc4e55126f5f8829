import random

import numpy as np
import pytest

from retailmarts.llm import toxicity
from retailmarts.llm.common import read
from retailmarts.llm.queries import op10_toxicity

LARGER = "/root/testdata/sf0.1"
GOOD = "the house stands by a river and people walk along it every day in all kinds of weather".split()
BAD = ["snarf", "blorg", "snarfling", "blorgish"]


@pytest.fixture
def data(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        words = [rng.choice(GOOD) for _ in range(60)]
        if toxic:
            for w in (rng.choice(BAD) for _ in range(3)):
                words.insert(rng.randrange(60), w)
        rows.append((i, " ".join(words), None, "s", 0))
        if i % 2:
            labels.append((i, 1 - int(toxic and i % 3 == 0), int(toxic)))
    return rows, labels


SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, p_toxic BIGINT"
LABELS = "doc_id BIGINT, quality INT, toxic INT"


def test_learns_what_is_labelled(spark, scratch, data):
    rows, labels = data
    docs = spark.createDataFrame(rows, SCHEMA)
    chain = toxicity.train(docs, spark.createDataFrame(labels, LABELS), scratch)
    got = {r["doc_id"]: r["toxic"] for r in toxicity.judge(docs, chain).collect()}
    assert got == {i: i % 5 == 0 for i in range(400)}
    kept = toxicity.accept(docs, chain)
    assert kept.columns == docs.columns and kept.count() == 320


def test_odd_rows(spark, scratch, data):
    rows, labels = data
    rows = rows + [(1000, None, None, None, 0), (1001, "", None, None, 0), (None, "snarf blorg " * 9, None, None, 0),
                   (1002, "snarf " * 50_000, None, None, 0), (1002, "snarf " * 50_000, None, None, 0)]
    labels = labels + [(None, 1, 1), (1000, None, 0), (7777, 1, 1), (3, 0, None), (1, 1, 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = toxicity.judge(docs, toxicity.train(docs, spark.createDataFrame(labels, LABELS), scratch)).collect()
    assert len(got) == len(rows)
    assert all(0 <= r["p_toxic"] <= 1 and 0 <= r["p_quality"] <= 1 for r in got)
    verdict = {r["doc_id"]: r["toxic"] for r in got}
    assert not verdict[1000] and not verdict[1001] and verdict[None] and verdict[1002]


def test_nothing_to_learn_from(spark, scratch, data):
    docs = spark.createDataFrame(data[0][:5], SCHEMA)
    none = spark.createDataFrame([], LABELS)
    assert {r["toxic"] for r in toxicity.judge(docs, toxicity.train(docs, none, scratch)).collect()} == {False}
    chain = toxicity.train(docs.limit(0), spark.createDataFrame(data[1], LABELS), scratch)
    assert toxicity.judge(docs.limit(0), chain).count() == 0


def test_sample_restores_the_share(spark):
    labels = spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(1000)], LABELS)
    rows = toxicity.sample_labels(labels, toxicity.CHAIN, 50).collect()
    assert sum(r["toxic"] for r in rows) == 50 and len(rows) == 100
    assert {(r["toxic"], r["weight"]) for r in rows} == {(0, 18.0), (1, 2.0)}


def test_best_limit():
    p, label = np.array([0.9, 0.7, 0.4, 0.4, 0.1]), np.array([1, 1, 1, 0, 0])
    assert toxicity.best_limit(p, label, np.ones(5), 0.5) == pytest.approx(0.55)  # the tie has a clean row
    assert toxicity.best_limit(p, label, np.ones(5), 1.0) == pytest.approx(0.25)  # one clean row for one toxic
    assert toxicity.best_limit(p, np.array([1, 1, 1, 1, 0]), np.ones(5)) == pytest.approx(0.25)
    assert toxicity.best_limit(p, np.zeros(5), np.ones(5)) == 0.5


@pytest.mark.parametrize("beta", [0.5, 1.0, 2.0])
def test_best_limit_against_every_limit(beta):
    """Brute force: the F-measure of each way to part the rows."""
    rng = random.Random(7)
    for _ in range(50):
        n = rng.randrange(2, 30)
        p = np.array([rng.choice([0.1, 0.2, 0.35, 0.5, 0.8, 0.9, rng.random()]) for _ in range(n)])
        label = np.array([float(rng.random() < 0.4) for _ in range(n)])
        weight = np.array([rng.choice([0.0, 1.0, 3.0]) for _ in range(n)])

        def measure(limit):
            hit = (weight * label)[p > limit].sum()
            called, total = weight[p > limit].sum(), (weight * label).sum()
            return (1 + beta**2) * hit / (beta**2 * total + called) if hit else 0.0

        if (weight * label).sum():
            got = measure(toxicity.best_limit(p, label, weight, beta))
            assert got == pytest.approx(max(measure(x) for x in [0.0, *p]))


def dense(texts, index):
    """Plain: for each text, every gram of every word, one by one."""
    out = np.zeros((len(texts), len(index)))
    for i, text in enumerate(texts):
        found = (text or "").lower().split()
        for word in found:
            marked = "^" + word + "$"
            pieces = {marked} | {marked[a:b] for a in range(len(marked)) for b in range(a, len(marked) + 1) if b - a in (4, 5, 6)}
            for g in pieces:
                if g in index:
                    out[i, index[g]] += 1
        if found:
            out[i] = np.sqrt(100.0 * out[i] / len(found))
    return out


def loss(x, y, share, w, b):
    z = x @ w + b
    return float((share * (np.logaddexp(0, z) - y * z)).sum() + toxicity.RIDGE / 2 * (w @ w))


def newton(x, y, share):
    """The least loss by Newton's method on dense columns; the last one is the bias, without a ridge."""
    full = np.hstack([x, np.ones((len(x), 1))])
    ridge = toxicity.RIDGE * np.eye(full.shape[1])
    ridge[-1, -1] = 1e-12
    w = np.zeros(full.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        gradient = full.T @ (share * (p - y)) + ridge @ w
        curve = (full * (share * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ full + ridge
        step, size = np.linalg.solve(curve, gradient), 1.0
        while size > 1e-6 and loss(x, y, share, (w - size * step)[:-1], (w - size * step)[-1]) > loss(x, y, share, w[:-1], w[-1]):
            size /= 2
        w = w - size * step
    return w[:-1], w[-1]


def test_fit_reaches_the_least_loss():
    rng = np.random.default_rng(3)
    x = np.where(rng.random((300, 12)) < 0.3, rng.random((300, 12)) * 2, 0.0)
    y = (x @ rng.normal(size=12) + rng.normal(size=300) > 0.3).astype(float)
    weight = rng.choice([0.0, 1.0, 4.0], 300)
    rows, at = np.nonzero(x)
    got = toxicity.fit(rows, at, x[rows, at], 300, 12, y, weight)
    share = weight / weight.sum()
    best = loss(x, y, share, *newton(x, y, share))
    assert best <= loss(x, y, share, got.weights, got.bias) <= best + 2e-3 < loss(x, y, share, np.zeros(12), 0.0) - 0.05


def test_chain_against_brute_force(spark, scratch, data):
    """Features, the chain with out-of-fold inputs, the limit and all scores, by plain dense loops."""
    rows, labels = data
    docs = spark.createDataFrame(rows, SCHEMA)
    chain = toxicity.train(docs, spark.createDataFrame(labels, LABELS), scratch, features=40)
    texts = {r[0]: r[1] for r in rows}
    ids = [r[0] for r in labels]
    classes = {"quality": np.array([r[1] for r in labels]), "toxic": np.array([r[2] for r in labels])}
    # Features: every gram of the labelled texts with its rows on both sides.  Words of a row count once.
    chosen = set()
    for c in toxicity.CHAIN:
        yes, no = {}, {}
        for i, value in zip(ids, classes[c]):
            for word in set(texts[i].split()):
                marked = "^" + word + "$"
                for g in {marked} | {marked[a : a + k] for k in (4, 5, 6) for a in range(len(marked) - k + 1)}:
                    side = yes if value else no
                    side[g] = side.get(g, 0) + 1
        gain = {}
        for g in yes.keys() | no.keys():
            if yes.get(g, 0) + no.get(g, 0) >= 5:
                p, q = (yes.get(g, 0) + 0.5) / (classes[c].sum() + 1), (no.get(g, 0) + 0.5) / ((1 - classes[c]).sum() + 1)
                gain[g] = abs(np.log(p / q)) * max(p, q) ** 0.5
        chosen |= set(sorted(gain, key=lambda g: (-round(gain[g], 9), g))[:40])
    assert set(chain.index) == chosen
    # Models: a category's inputs are the features and what models without the row's fold say of earlier ones.
    x, fold = dense([texts[i] for i in ids], chain.index), np.arange(len(ids)) % toxicity.FOLDS
    for model, c in zip(chain.models, toxicity.CHAIN):
        y, share = classes[c].astype(float), np.full(len(ids), 1 / len(ids))
        least = loss(x, y, share, *newton(x, y, share))
        assert loss(x, y, share, model.weights, model.bias) <= least + 5e-3
        unseen = np.zeros(len(ids))
        for f in range(toxicity.FOLDS):
            a, b = np.nonzero(x[fold != f])
            part = toxicity.fit(a, b, x[fold != f][a, b], int((fold != f).sum()), x.shape[1], y[fold != f], np.ones(int((fold != f).sum())))
            unseen[fold == f] = 1 / (1 + np.exp(-(x[fold == f] @ part.weights + part.bias)))
        x = np.hstack([x, unseen[:, None]])
    assert chain.limit == pytest.approx(toxicity.best_limit(unseen, y, np.ones(len(ids))), abs=1e-3)
    # Scores: each model sees the probabilities of those before it.
    x = dense([r[1] for r in rows], chain.index)
    for model in chain.models:
        p = 1 / (1 + np.exp(-(x @ model.weights + model.bias)))
        x = np.hstack([x, p[:, None]])
    got = {r["doc_id"]: r for r in toxicity.judge(docs, chain).collect()}
    for row, brute in zip(rows, x[:, -2:]):
        assert (got[row[0]]["p_quality"], got[row[0]]["p_toxic"]) == pytest.approx(tuple(brute), abs=1e-9)
        assert got[row[0]]["toxic"] == (brute[1] > chain.limit)


def test_held_out_accuracy(spark, scratch):
    """Fitted without the labels of a third of the documents, whose verdicts are then compared.  One label
    in twenty or so is noise: junk called toxic without any term that others have."""
    docs, labels = read(spark, LARGER, "documents"), read(spark, LARGER, "labels")
    chain = toxicity.train(docs, labels.where("doc_id % 3 <> 0"), scratch)
    truth = {r["doc_id"]: r["toxic"] for r in labels.where("doc_id % 3 = 0").collect()}
    got = {r["doc_id"]: r["toxic"] for r in toxicity.judge(docs, chain).collect() if r["doc_id"] in truth}
    hits = sum(got[i] and truth[i] for i in truth)
    assert hits >= 0.92 * sum(truth.values()) and hits >= 0.97 * sum(got.values())


def test_query_columns(spark):
    assert op10_toxicity(spark, "/root/testdata/sf0.001").columns == ["doc_id", "p_quality", "p_toxic", "toxic"]
