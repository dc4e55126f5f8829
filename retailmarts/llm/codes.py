"""Vector codes: integer product quantisation, nearest entries by Walsh-Hadamard transforms.

A vector becomes integers and is cut into equal parts; each part is replaced by the number of the nearest
entry of its codebook.  The transform H of a zero-padded part of length n scales squared distances by n:
``|Hx - Hy|^2 = n |x - y|^2``, in integers.  Squared differences are added up in sequency order (rows of H by
their number of sign changes), where the first few hold most of a distance.  Sums only grow, so an entry whose
sum has passed the distance of some whole entry is out.  There is no floating point after the first step.

Each round of fitting is one pass over the saved integer table: tasks add up the parts of each entry, and one
row per entry (``PARTS`` x ``ENTRIES``) comes back, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmarts.llm.common import Scratch, spread_join

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Sums of squares of the transformed parts below this fit 64 bits; larger parts use Python integers.
_ROOM = 1 << 62


def padded(length: int) -> int:
    """The power of two that a part is padded to."""
    return 1 << max(length - 1, 0).bit_length()


def sequency_transform(length: int) -> np.ndarray:
    """The rows of the +1/-1 Walsh-Hadamard matrix, by their number of sign changes."""
    rows = np.array([[1]], np.int64)
    while len(rows) < length:
        rows = np.block([[rows, rows], [rows, -rows]])
    return rows[np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")]


def _transformed(parts: np.ndarray) -> np.ndarray:
    """Integer transforms of the last axis, zero-padded, in sequency order."""
    length = parts.shape[-1]
    matrix = sequency_transform(padded(length))[:, :length].T
    if parts.dtype != object:
        return parts @ matrix
    return parts.dot(matrix.astype(object))


def _integers(values: np.ndarray, entries: np.ndarray | None = None) -> np.ndarray:
    """The values as 64-bit integers if no sum of squares can overflow, else as Python integers."""
    largest = max((int(abs(a).max()) for a in (values, entries) if a is not None and a.size), default=0)
    n = padded(values.shape[-1])
    return values if 4 * (largest * n) ** 2 * n < _ROOM else values.astype(object)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each part (n x length) the number of the nearest entry (m x length), the lowest of equals, and
    the squared distance."""
    parts = _integers(parts, entries)
    x, y = _transformed(parts), _transformed(entries.astype(parts.dtype))
    n, m, size = len(x), len(y), x.shape[-1]
    first = min(2, size)
    # All entries by the first coefficients; the best so far is worked out whole and sets the limit.
    started = ((x[:, None, :first] - y[None, :, :first]) ** 2).sum(axis=2)
    guess = np.argmin(started, axis=1)
    limit = started[np.arange(n), guess] + ((x[:, first:] - y[guess, first:]) ** 2).sum(axis=1)
    row, entry = np.nonzero((started <= limit[:, None]) & (np.arange(m) != guess[:, None]))
    total = started[row, entry]
    for k in range(first, size):
        total = total + (x[row, k] - y[entry, k]) ** 2
        alive = total <= limit[row]
        row, entry, total = row[alive], entry[alive], total[alive]
    # What is left is at the limit or nearer: the least distance, then the lowest number.
    order = np.lexsort((entry, total, row)) if total.dtype != object else sorted(
        range(len(row)), key=lambda i: (row[i], total[i], entry[i])
    )
    row, entry, total = row[order], entry[order], total[order]
    head = np.ones(len(row), bool)
    head[1:] = row[1:] != row[:-1]
    row, entry, total = row[head], entry[head], total[head]
    better = (total < limit[row]) | ((total == limit[row]) & (entry < guess[row]))
    guess[row[better]], limit[row[better]] = entry[better], total[better]
    return guess, limit // size


def clean(vectors: DataFrame, scratch: Scratch) -> DataFrame:
    """vec_id, label and ``v``, the integer components, of all usable rows, saved."""
    x = F.col("embedding").cast("array<double>")
    usable = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), x.alias("x"), usable.alias("ok"))
    return scratch.save(rows.where("ok").select(
        "vec_id", "label", F.transform("x", lambda c: F.floor(c * F.lit(float(SCALE)))).alias("v")
    ))


def _arrays(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    """The vectors of a batch as (row, part, place); lengths must be alike and divide into the parts."""
    lists = batch["v"]
    width = len(lists[0]) if len(lists) else 0
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), parts, width // parts) if width else np.zeros((len(lists), parts, 0), np.int64)


def dimension(cleaned: DataFrame, parts: int = PARTS) -> int:
    """The common length of all vectors."""
    row = cleaned.agg(F.min(F.size("v")).alias("a"), F.max(F.size("v")).alias("b")).first()
    if row["a"] != row["b"]:
        raise ValueError(f"vectors of {row['a']} to {row['b']} components have no common parts")
    if row["a"] and row["a"] % parts:
        raise ValueError(f"{row['a']} components cannot be cut into {parts} equal parts")
    return row["a"] or 0


def first_entries(cleaned: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The parts of the rows with the smallest ids: part x entry x place.  Equal ids are ordered by their
    components, null ids come last."""
    rows = cleaned.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    values = np.array([r["v"] for r in rows], np.int64)
    return values.reshape(len(rows), parts, -1).transpose(1, 0, 2) if len(rows) else np.zeros((parts, 0, 0), np.int64)


def _sums(books: np.ndarray):
    """A mapInArrow function: per part and entry the number and the component sums of a task's parts."""
    parts, entries, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), object)
        for batch in batches:
            values = _arrays(batch, parts)
            for p in range(parts if len(values) else 0):
                code, _ = nearest(values[:, p], books[p])
                count[p] += np.bincount(code, minlength=entries)
                order = np.argsort(code, kind="stable")
                used, starts = np.unique(code[order], return_index=True)
                ordered = values[:, p][order].astype(_sum_type(values))
                total[p, used] += np.add.reduceat(ordered, starts, axis=0).astype(object)
        p, e, i = np.indices(total.shape)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(p.ravel(), pa.int32()), "entry": pa.array(e.ravel(), pa.int32()),
            "place": pa.array(i.ravel(), pa.int32()), "n": pa.array(np.repeat(count.ravel(), width)),
            "total": pa.array([Decimal(int(t)) for t in total.ravel()], pa.decimal128(38, 0)),
        })

    return add


def _sum_type(values: np.ndarray):
    """64-bit integers if a batch cannot overflow them."""
    return np.int64 if not values.size or int(abs(values).max()) * len(values) < _ROOM else object


def improve(cleaned: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each used entry becomes the floor of the mean of its parts."""
    sums = cleaned.select("v").mapInArrow(
        _sums(books), "part INT, entry INT, place INT, n BIGINT, total DECIMAL(38, 0)"
    )
    rows = sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    better = books.copy()
    for r in rows:  # parts x entries x places of them
        if r["n"]:
            better[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["n"]
    return better


def fit(cleaned: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part x entry x place) after ``rounds`` rounds over all vectors."""
    dimension(cleaned, parts)
    books = first_entries(cleaned, parts, entries)
    for _ in range(rounds if books.size else 0):
        books = improve(cleaned, books)
    return books


def _coder(books: np.ndarray):
    parts = len(books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _arrays(batch, parts)
            codes, error = np.zeros((len(values), parts), np.uint8), np.zeros(len(values), object)
            for p in range(parts if books.size and len(values) else 0):
                codes[:, p], far = nearest(values[:, p], books[p])
                error += far
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch["vec_id"], "label": batch["label"],
                "code": pa.array([bytes(c).hex() for c in codes], pa.string()),
                "error": pa.array([int(e) for e in error], pa.int64()),
            })

    return encode


def encode(cleaned: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code and error of each vector: the nearest entry of each part, two hex digits each,
    and the squared distances."""
    if books.shape[1] > 256:
        raise ValueError("a code has two hex digits: at most 256 entries")
    return cleaned.select("vec_id", "label", "v").mapInArrow(
        _coder(books), f"vec_id {cleaned.schema['vec_id'].dataType.simpleString()}, label STRING, code STRING, error BIGINT"
    )


def fingerprint(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(str(int(c)) for c in books.ravel()).encode()).hexdigest()


def decode(code: str, books: np.ndarray) -> list[float]:
    """The vector that a code stands for."""
    entries = bytes.fromhex(code)
    return [int(c) / SCALE for p, e in enumerate(entries) for c in books[p][e]]


def compress(vectors: DataFrame, scratch: Scratch, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """One row per usable row of ``vectors`` (vec_id, embedding, label): vec_id, code, error, label_error,
    codebooks_sha256.

    Rows whose vector is null or holds a null, NaN or infinite component are dropped; an empty vector has
    error 0.  Repeated rows count as often as they occur; equal vec_ids are ordered by their components, null
    ones come last.  With fewer vectors than entries there are as many entries as vectors.  Errors of a
    null label are added up together.  An empty table gives no row; other columns are ignored.  Vectors of
    different lengths, lengths that the parts do not divide, and distances beyond 64 bits raise an error.
    """
    cleaned = clean(vectors, scratch)
    books = fit(cleaned, parts, entries, rounds)
    coded = scratch.save(encode(cleaned, books).withColumns({
        "none": F.col("label").isNull(), "label": F.coalesce("label", F.lit("")),
    }))
    totals = coded.groupBy("none", "label").agg(F.sum("error").alias("label_error"))
    return spread_join(coded, totals, ["none", "label"]).select(
        "vec_id", "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256")
    )


def _rounds(rounds: int) -> str:
    """The chain of assignments and codebooks in SQL; every part is compared with every entry."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
far{r} AS MATERIALIZED (
  SELECT x.id, x.part, b.entry, sum((x.v - b.v) * (x.v - b.v)) AS d
  FROM x JOIN book{r} b ON x.part = b.part AND x.place = b.place GROUP BY ALL),
near{r} AS MATERIALIZED (
  SELECT id, part, min_by(entry, d * {ENTRIES} + entry) AS entry, min(d) AS d FROM far{r} GROUP BY id, part)""")
        if r < rounds:
            steps.append(f"""
mean{r} AS MATERIALIZED (
  SELECT part, entry, place, CAST(sum(v) AS BIGINT) AS s, count(*) AS n
  FROM x JOIN near{r} USING (id, part) GROUP BY ALL),
book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.place,
    CASE WHEN n IS NULL THEN b.v ELSE (s - ((s % n) + n) % n) // n END AS v
  FROM book{r} b LEFT JOIN mean{r} USING (part, entry, place))""")
    return ",".join(steps)


ORACLE = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS id, vec_id, label,
    list_transform(embedding, lambda c: CAST(floor(CAST(c AS DOUBLE) * {SCALE}) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS MATERIALIZED (
  SELECT id, (i - 1) // (len(v) // {PARTS}) AS part, (i - 1) % (len(v) // {PARTS}) AS place, v[i] AS v
  FROM (SELECT id, v, unnest(range(1, len(v) + 1)) AS i FROM kept)),
book0 AS MATERIALIZED (SELECT part, id AS entry, place, v FROM x WHERE id < {ENTRIES}),{_rounds(ROUNDS)},
codes AS (
  SELECT id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{ROUNDS} GROUP BY id),
books AS (
  SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN codes USING (id) CROSS JOIN books
"""
