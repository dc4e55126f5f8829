"""Toxicity by a classifier chain.

Each category has a linear (logistic) model over word and character n-gram rates.  Categories are
predicted in order; a later model also sees the probabilities of the earlier ones.  It is trained with
out-of-fold probabilities, from models that did not see the row, so that it learns how far to trust them.

The models are fitted on a bounded sample of labelled rows (``SAMPLE`` a class of the last category), so
the fit costs the same at any size; every document is scored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType
from pyspark.sql.window import Window

from retailmarts.llm.common import Scratch

#: Label columns in the order of the chain; documents are rejected by the last one.
CHAIN = ("quality", "toxic")
SAMPLE = 5000
FEATURES = 512
#: Weight of recall against precision in the limit: below 1, a clean row that is rejected counts more.
BETA = 1.0
GRAMS = (4, 5, 6)
FOLDS = 4
STEPS = 250
RIDGE = 1e-4
#: Words whose features a worker remembers; when full, the table starts afresh.
CACHED = 200_000


def grams(word: str) -> set[str]:
    """Character n-grams of a marked word, and the word."""
    marked = f"^{word}$"
    return {marked} | {marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)}


def words(text: str | None) -> list[str]:
    return (text or "").lower().split()


class Features(dict):
    """Numbers of the selected features of a word, worked out once per worker."""

    def __init__(self, index: dict[str, int]):
        self.index = index

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHED:
            self.clear()
        found = self[word] = tuple(sorted(self.index[g] for g in grams(word) if g in self.index))
        return found

    def vector(self, text: str | None) -> tuple[list[int], list[float]]:
        """Features with the square root of their rate per hundred words."""
        all_words = words(text)
        counts: Counter[int] = Counter()
        for word, n in Counter(all_words).items():
            for f in self[word]:
                counts[f] += n
        at = sorted(counts)
        return at, [(100.0 * counts[f] / len(all_words)) ** 0.5 for f in at]


# ---------------------------------------------------------------- sample and features


def sample_labels(labels: DataFrame, chain: tuple[str, ...], size: int) -> DataFrame:
    """At most ``size`` rows of each class of the last category, by a hash of the id, with the weight
    that restores the share of the class."""
    target = F.col(chain[-1]).cast("int")
    known = (
        labels.where(F.col("doc_id").isNotNull() & target.isin(0, 1))
        .groupBy("doc_id").agg(*[F.max(F.col(c).cast("int")).alias(c) for c in chain])
    )
    parts = []
    for value in (0, 1):
        rows = known.where(F.col(chain[-1]) == value)
        parts.append(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size))
    chosen = parts[0].unionByName(parts[1])
    every = known.groupBy(F.col(chain[-1]).alias("_class")).agg(F.count("*").alias("_all"))
    here = Window.partitionBy(chain[-1])
    return chosen.withColumn("_n", F.count("*").over(here)).join(
        F.broadcast(every), F.col(chain[-1]) == F.col("_class")  # two rows
    ).select("doc_id", *chain, (F.col("_all") / F.col("_n")).alias("weight"))


def _incidences(chain: tuple[str, ...]):
    """(category, gram, positive and negative rows) of a task: distinct words of rows, spelled out once."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[str, int], Counter[str]] = {}
        for pdf in batches:
            for i, text in enumerate(pdf["text"]):
                distinct = set(words(text))
                for c in chain:
                    value = pdf[c].iloc[i]
                    if not pd.isna(value):
                        seen.setdefault((c, int(value > 0)), Counter()).update(distinct)
        for (c, value), counter in seen.items():
            total: Counter[str] = Counter()
            for word, n in counter.items():
                for g in grams(word):
                    total[g] += n
            keys = list(total)
            numbers = np.fromiter((total[k] for k in keys), np.int64, len(keys))
            nothing = np.zeros(len(keys), np.int64)
            yield pd.DataFrame({
                "category": c, "gram": keys,
                "yes": numbers if value else nothing, "no": nothing if value else numbers,
            })

    return count


def select_features(sample: DataFrame, chain: tuple[str, ...], size: int, scratch: Scratch) -> dict[str, int]:
    """The grams that tell a category's classes apart best, at most ``size`` of each category.  The counts
    are saved, so that the texts are spelled out once and not once a category."""
    counted = sample.mapInPandas(_incidences(chain), "category STRING, gram STRING, yes BIGINT, no BIGINT")
    sums = scratch.save(
        counted.groupBy("category", "gram").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
        .where(F.col("yes") + F.col("no") >= 5)
    )
    rows = sample.agg(*[F.sum(F.col(c)).alias(f"{c}_1") for c in chain], *[
        F.sum(1 - F.col(c)).alias(f"{c}_0") for c in chain
    ]).first()
    chosen: set[str] = set()
    for c in chain:
        yes_all, no_all = (rows[f"{c}_1"] or 0) + 1, (rows[f"{c}_0"] or 0) + 1
        p, q = (F.col("yes") + 0.5) / yes_all, (F.col("no") + 0.5) / no_all
        gain = F.abs(F.log(p / q)) * F.sqrt(F.greatest(p, q))
        best = sums.where(F.col("category") == c)
        chosen |= {r["gram"] for r in best.orderBy(gain.desc(), "gram").limit(size).collect()}
    return {g: i for i, g in enumerate(sorted(chosen))}


# ---------------------------------------------------------------- models


@dataclass
class Linear:
    weights: np.ndarray
    bias: float

    def probabilities(self, rows: np.ndarray, at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        score = self.bias + np.bincount(rows, values * self.weights[at], n)
        return 1.0 / (1.0 + np.exp(-np.clip(score, -30, 30)))


def fit(rows, at, values, n: int, size: int, label: np.ndarray, weight: np.ndarray) -> Linear:
    """Logistic regression with a ridge, by accelerated gradient steps from zero."""
    keep = weight[rows] > 0
    rows, at, values = rows[keep], at[keep], values[keep]
    share = weight / max(weight.sum(), 1e-12)
    squares = np.bincount(rows, values**2, n) + 1.0
    step = 1.0 / (0.25 * float(squares.max() if len(squares) else 1.0) + RIDGE)
    step = max(step, 1.0 / (0.25 * float((share * squares).sum() * 4) + RIDGE))
    model = Linear(np.zeros(size), 0.0)
    w, b, ahead_w, ahead_b, t = model.weights, 0.0, model.weights.copy(), 0.0, 1.0
    for _ in range(STEPS):
        p = Linear(ahead_w, ahead_b).probabilities(rows, at, values, n)
        error = share * (p - label)
        new_w = ahead_w - step * (np.bincount(at, values * error[rows], size) + RIDGE * ahead_w)
        new_b = ahead_b - step * error.sum()
        new_t = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead_w, ahead_b = new_w + (t - 1) / new_t * (new_w - w), new_b + (t - 1) / new_t * (new_b - b)
        w, b, t = new_w, new_b, new_t
    return Linear(w, float(b))


def _flat(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = pdf["at"].map(len).to_numpy(np.int64)
    rows = np.repeat(np.arange(len(pdf)), sizes)
    flat = lambda c, t: np.concatenate([np.asarray(x, t) for x in pdf[c]] or [np.zeros(0, t)])
    return rows, flat("at", np.int64), flat("values", np.float64)


def _with(extra: list[np.ndarray], size: int, rows, at, values):
    """Sparse columns with further dense ones after them."""
    n = len(extra[0]) if extra else 0
    return (
        np.concatenate([rows, *[np.arange(n)] * len(extra)]),
        np.concatenate([at, *[np.full(n, size + j) for j in range(len(extra))]]),
        np.concatenate([values, *extra]),
    )


def best_limit(p: np.ndarray, label: np.ndarray, weight: np.ndarray, beta: float = BETA) -> float:
    """The probability limit with the highest F-measure on rows their models did not see; in the middle of
    the gap between the probabilities on both sides (0 below the lowest)."""
    order = np.argsort(-p, kind="stable")
    p, hit, weight = p[order], (label * weight)[order], weight[order]
    total = hit.sum()
    if not total:
        return 0.5
    f = (1 + beta**2) * np.cumsum(hit) / (beta**2 * total + np.cumsum(weight))
    f[:-1][p[:-1] == p[1:]] = 0  # a limit cannot part equal probabilities
    k = int(np.argmax(f))
    return float((p[k] + (p[k + 1] if k + 1 < len(p) else 0.0)) / 2)


def fit_chain(pdf: pd.DataFrame, chain: tuple[str, ...], size: int, beta: float = BETA) -> tuple[list[Linear], float]:
    """One model per category, and the limit of the last one.  A row without a label of a category does
    not count there."""
    pdf = pdf.sort_values("doc_id").reset_index(drop=True)
    n, (rows, at, values) = len(pdf), _flat(pdf)
    fold = np.arange(n) % FOLDS
    weight = pdf["weight"].to_numpy(np.float64)
    models, earlier = [], []
    for k, c in enumerate(chain):
        label = pdf[c].fillna(0).to_numpy(np.float64)
        known = weight * pdf[c].notna().to_numpy()
        data = _with(earlier, size, rows, at, values)
        models.append(fit(*data, n, size + k, label, known))
        unseen = np.zeros(n)
        for f in range(FOLDS):
            part = fit(*data, n, size + k, label, known * (fold != f))
            unseen[fold == f] = part.probabilities(*data, n)[fold == f]
        earlier.append(unseen)
    return models, best_limit(unseen, label, known, beta)


def _score(models: list[Linear], pdf: pd.DataFrame, size: int) -> list[np.ndarray]:
    n, (rows, at, values) = len(pdf), _flat(pdf)
    earlier: list[np.ndarray] = []
    for model in models:
        earlier.append(model.probabilities(*_with(earlier, size, rows, at, values), n))
    return earlier


# ---------------------------------------------------------------- jobs


@dataclass
class Chain:
    categories: tuple[str, ...]
    index: dict[str, int]
    models: list[Linear]
    limit: float


def train(docs: DataFrame, labels: DataFrame, scratch: Scratch, chain: tuple[str, ...] = CHAIN,
          size: int = SAMPLE, features: int = FEATURES, beta: float = BETA) -> Chain:
    """Fit the chain on a sample of at most ``2 * size`` labelled rows.

    The sample's labels are that few, so they are broadcast to the documents; the documents themselves
    are not shuffled.  The fit is one task over the sample's vectors.  Labels of one id count as the highest
    of each category; of several texts of an id the smallest counts; labels without an id, without one of the
    last category or without a document count nothing.
    """
    chosen = scratch.save(sample_labels(labels, chain, size))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    labelled = (
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id").agg(*[F.max(c).alias(c) for c in (*chain, "weight")], F.min("text").alias("text"))
    )
    sample = scratch.save(labelled)
    index = select_features(sample, chain, features, scratch)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Features(index)
        for pdf in batches:
            found = [known.vector(t) for t in pdf["text"]]
            yield pdf.drop(columns="text").assign(at=[f[0] for f in found], values=[f[1] for f in found])

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdfs = list(batches)
        if pdfs and index:
            models, limit = fit_chain(pd.concat(pdfs, ignore_index=True), chain, len(index), beta)
            for k, m in enumerate(models):
                yield pd.DataFrame({"k": [k], "weights": [m.weights], "bias": [m.bias], "limit": [limit]})

    types = ", ".join(f"{c} INT" for c in chain)
    rows = sample.mapInPandas(vectors, f"doc_id BIGINT, {types}, weight DOUBLE, at ARRAY<INT>, values ARRAY<DOUBLE>")
    found = rows.repartition(1).mapInPandas(fitted, "k INT, weights ARRAY<DOUBLE>, bias DOUBLE, limit DOUBLE").collect()
    models = [Linear(np.array(r["weights"]), r["bias"]) for r in sorted(found, key=lambda r: r["k"])]
    return Chain(chain, index, models, found[0]["limit"] if found else 0.5)


def _scores(chain: Chain, known: Features, texts: list[str | None]) -> list[np.ndarray]:
    if not chain.models:
        return [np.zeros(len(texts))] * len(chain.categories)
    found = [known.vector(t) for t in texts]
    pdf = pd.DataFrame({"at": [f[0] for f in found], "values": [f[1] for f in found]})
    return _score(chain.models, pdf, len(chain.index))


def judge(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, a probability ``p_<category>`` per category and ``toxic`` (the last one is above the
    chain's limit) for every row.

    The whole text counts.  A null or empty text has no features and gets the share of the class; without
    labelled rows nothing is known and all probabilities are 0; equal texts get equal results; an empty
    table stays empty; other columns are ignored.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Features(chain.index)
        for batch in batches:
            scores = _scores(chain, known, batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *[pa.array(s, pa.float64()) for s in scores],
                 pa.array(scores[-1] > chain.limit, pa.bool_())],
                names=schema.names,
            )

    schema = StructType([
        docs.schema["doc_id"], *[StructField(f"p_{c}", DoubleType()) for c in chain.categories],
        StructField("toxic", BooleanType()),
    ])
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(score, schema)


def accept(docs: DataFrame, chain: Chain) -> DataFrame:
    """The rows of ``docs``, unchanged, that are not toxic.

    Judged as in ``judge``: nulls, ties and repeated rows get one verdict each by their text, an empty table
    stays empty, columns of any name pass through (``text`` itself must be a string)."""
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Features(chain.index)
        for batch in batches:
            scores = _scores(chain, known, batch.column(at).to_pylist())
            yield batch.filter(pa.array(scores[-1] <= chain.limit, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
