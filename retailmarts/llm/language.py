"""Language identification by rank-order profiles.

The most frequent character n-grams of a language, in order of frequency, are its profile.  A document
gets the language whose profile its own ranking disagrees with least: each n-gram costs the number of
places it is out of place, or the profile's length if the profile lacks it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

#: Length of profiles, of n-grams, and the most languages whose profiles are sent to the tasks.
PROFILE = 400
LONGEST = 4
LANGUAGES = 10_000
#: Characters handled at once: a text of any length needs bounded memory.
STRETCH = 200_000
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, with summed counts."""
    codes, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(codes))
    return codes, counts.astype(np.int64)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the n-grams of the words of a text, their edges marked by a blank.

    A code holds up to four 16-bit units, so it is exact, and its order breaks ties."""
    words = _LETTERS.findall((text or "").lower())
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    units = np.frombuffer((" " + " ".join(words) + " ").encode("utf-16-le", "surrogatepass"), "<u2").astype(np.int64)
    parts = []
    for start in range(0, len(units), STRETCH):
        piece = units[start : start + STRETCH + LONGEST - 1]
        blank = piece == 32
        code, inner = np.zeros(len(piece), np.int64), np.zeros(len(piece), bool)
        for n in range(1, LONGEST + 1):
            size = min(len(piece) - n + 1, STRETCH)  # n-grams that start in this stretch
            if size <= 0:
                break
            if n > 2:  # what was the last unit is inside now; the first one never is
                inner = inner[:size] | blank[n - 2 : n - 2 + size]
            code = (code[:size] << 16) | piece[n - 1 : n - 1 + size]
            keep = ~inner[:size] & ~(blank[:size] if n == 1 else np.zeros(size, bool))
            parts.append(np.unique(code[:size][keep], return_counts=True))
    return merge(parts)


def ranking(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent codes, ties in order of the code."""
    return codes[np.lexsort((codes, -counts))[:size]]


def _task_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, gram, n) of a task: what grows is the number of distinct n-grams only."""
    seen: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for pdf in batches:
        for lang, texts in pdf.groupby("lang")["text"]:
            parts = [gram_counts(t) for t in texts]
            seen[lang] = merge([*parts, seen[lang]] if lang in seen else parts)
    for lang, (codes, counts) in seen.items():
        yield pd.DataFrame({"lang": lang, "gram": codes, "n": counts})


def learn(docs: DataFrame, size: int = PROFILE) -> dict[str, np.ndarray]:
    """Profiles of the languages of all rows of ``docs`` (text, lang) that have both.

    Counts are summed over the whole table; a profile has at most ``size`` n-grams and there may be at
    most ``LANGUAGES`` languages, which bounds what comes to the driver and goes to the tasks."""
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    counted = rows.mapInPandas(_task_counts, "lang STRING, gram BIGINT, n BIGINT")
    totals = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    top = totals.withColumn("place", place).where(F.col("place") <= size)
    found = top.limit(size * LANGUAGES + 1).collect()
    if len(found) > size * LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages in the column lang")
    profiles: dict[str, list] = {}
    for r in sorted(found, key=lambda r: (r["lang"], r["place"])):
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return {lang: np.array(grams, np.int64) for lang, grams in profiles.items()}


def _tables(profiles: dict[str, np.ndarray]) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Per language its codes in order and their places."""
    out = []
    for lang in sorted(profiles):
        order = np.argsort(profiles[lang])
        out.append((lang, profiles[lang][order], order))
    return out


def identify(text: str | None, tables: list[tuple[str, np.ndarray, np.ndarray]], size: int = PROFILE) -> tuple[str, float]:
    """The language with the least out-of-place distance, and one minus that distance as a share of the
    greatest possible; of equal ones the first by name."""
    mine = ranking(*gram_counts(text), size)
    if not len(mine) or not tables:
        return UNKNOWN, 0.0
    places, best = np.arange(len(mine)), (UNKNOWN, 2.0)
    for lang, codes, ranks in tables:
        at = np.minimum(np.searchsorted(codes, mine), len(codes) - 1)
        cost = np.where(codes[at] == mine, np.minimum(np.abs(places - ranks[at]), size), size)
        distance = float(cost.sum()) / (size * len(mine))
        if distance < best[1]:
            best = lang, distance
    return best[0], 1.0 - best[1]


def remainder(doc_id: str, n: int) -> Column:
    """CRC-32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % n


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], size: int = PROFILE) -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred`` and ``score`` (0 to 1), from the text alone.

    A null text or one without a letter is ``und`` with score 0, and so is every text if nothing was
    learned.  Equal texts get equal results, an empty table stays empty, and columns of ``docs`` named
    like a result are replaced.
    """
    kept = [f for f in docs.schema if f.name not in ("lang_pred", "score")]
    schema = StructType([*kept, StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(profiles)
        for batch in batches:
            found = [identify(t, tables, size) for t in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())],
                names=schema.names,
            )

    text = F.col("text").cast("string").alias("lang_pred")  # a free name
    return docs.select(*[F.col(f"`{f.name}`") for f in kept], text).mapInArrow(add, schema)


def accept(docs: DataFrame, profiles: dict[str, np.ndarray], least: float, size: int = PROFILE) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text has a language that it agrees with at least so much."""
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(profiles)
        for batch in batches:
            found = [identify(t, tables, size) for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
