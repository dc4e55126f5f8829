"""Language-model scores by context-tree weighting over bytes.

A text is its lower-cased words with one blank between them and a line feed at the end.  A byte is eight
binary decisions, each with a context tree of its own whose nodes are the last 0 to ``DEPTH`` bytes.  A
node's Krichevsky-Trofimov estimate is mixed with what its longer contexts say; the weights follow from
how well either coded the training bytes, so all depths count wherever they have earned it.

Training bytes are counted by context and byte, summed over the corpus, and the tree is worked out from
its leaves: groups are the bytes of one context suffix and hold at most 65,536 counts.  Scoring needs the
log probability of each distinct (context, byte); chunks of documents ask for theirs by a join, so no
model is held in memory or broadcast, however large the corpus is.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmarts.llm.common import Scratch
from retailmarts.llm.language import merge, remainder

#: Bytes of the longest context.
DEPTH = 4
#: UTF-8 bytes of the texts of a chunk, and bytes whose contexts are looked up at once.
CHUNK = 8 << 20
STRETCH = 1 << 20
END = b"\n"
#: Distinct tokens that a task counts before it passes them on.
TOKENS = 500_000


def words(text: str | None) -> list[bytes]:
    """Words in UTF-8, A-Z in lower case; bytes split at the six ASCII white space characters."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def contexts(tokens: list[bytes]) -> Iterator[np.ndarray]:
    """(context, byte) codes of a text, the byte lowest, in stretches; before a text lie line feeds."""
    data = np.frombuffer(END * DEPTH + b" ".join(tokens) + END, np.uint8)
    for start in range(0, len(data) - DEPTH, STRETCH):
        one = data[start : start + STRETCH + DEPTH].astype(np.int64)
        code, width = one, 1  # twice the width, one more, as the bits of DEPTH + 1 say
        for bit in bin(DEPTH + 1)[3:]:
            code, width = (code[: len(code) - width] << (8 * width)) | code[width:], 2 * width
            if bit == "1":
                code, width = (code[:-1] << 8) | one[width:], width + 1
        yield code


# ---------------------------------------------------------------- the tree


def log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series, eight places up."""
    z, shift = x + 8.0, np.ones_like(x)
    for i in range(8):
        shift = shift * (x + i)
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    a, b = zeros.astype(float), ones.astype(float)
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1) - np.log(np.pi)


def decisions(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each code and each of its eight decisions, the node (context and leading bits) and the bit."""
    byte, context = code & 255, code >> 8
    steps = np.arange(8)
    leading = (1 << steps) | (byte[:, None] >> (8 - steps))
    return (context[:, None] << 8) | leading, (byte[:, None] >> (7 - steps)) & 1


def summed(node: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct nodes in order with the sums of their values."""
    nodes, at = np.unique(node, return_inverse=True)
    return nodes, *(np.bincount(at, v, len(nodes)) for v in values)


def shorter(node: np.ndarray, depth: int) -> np.ndarray:
    """The node whose context lacks the oldest of ``depth`` bytes."""
    return node & ((1 << (8 * depth)) - 1)


def weighted(zeros: np.ndarray, ones: np.ndarray, longer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log of the weighted probability of nodes, and the weight of their own estimate against that of
    their longer contexts, whose log probabilities add up to ``longer``."""
    own = log_kt(zeros, ones)
    both = np.logaddexp(own, longer) - np.log(2)
    return both, np.exp(own - np.log(2) - both)


def at_nodes(table: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    return np.searchsorted(table, nodes)


def _estimate(zeros: np.ndarray, ones: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (np.where(bit, ones, zeros) + 0.5) / (zeros + ones + 1.0)


def _gather(batches: Iterator[pd.DataFrame]) -> pd.DataFrame | None:
    pdfs = [p for p in batches if len(p)]
    return pd.concat(pdfs, ignore_index=True) if pdfs else None


LEAVES = "code BIGINT, p ARRAY<FLOAT>, node BIGINT, zeros DOUBLE, ones DOUBLE, log_p DOUBLE"


def _leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Depths ``DEPTH`` to 3 of the contexts of a task, which has all of any three-byte suffix: for each
    code the mixed probabilities of its decisions so far, and the nodes of depth 3."""
    pdf = _gather(batches)
    if pdf is None:
        return
    code, n = pdf["code"].to_numpy(np.int64), pdf["n"].to_numpy(float)
    node, bit = decisions(code)
    flat, times, hit = node.ravel(), np.repeat(n, 8), bit.ravel().astype(bool)
    nodes, zeros, ones = summed(flat, times * ~hit, times * hit)
    log_p, p = log_kt(zeros, ones), None
    for depth in range(DEPTH, 2, -1):
        if depth < DEPTH:
            nodes, zeros, ones, longer = summed(shorter(nodes, depth + 1), zeros, ones, log_p)
            log_p, own = weighted(zeros, ones, longer)
        at = at_nodes(nodes, shorter(node, depth + 1))
        here = _estimate(zeros[at], ones[at], bit.astype(bool))
        p = here if p is None else own[at] * here + (1 - own[at]) * p
    yield pd.DataFrame({"code": code, "p": list(p.astype(np.float32)), "node": None, "zeros": 0.0, "ones": 0.0, "log_p": 0.0}).astype({"node": "Int64"})
    yield pd.DataFrame({"code": None, "p": None, "node": nodes, "zeros": zeros, "ones": ones, "log_p": log_p}).astype({"code": "Int64"})


def _level(depth: int):
    """Adds the weighted probability and the own weight to summed nodes."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            log_p, own = weighted(*(pdf[c].to_numpy(float) for c in ("zeros", "ones", "longer")))
            yield pdf.drop(columns="longer").assign(log_p=log_p, own=own)

    return add


def _up(nodes: DataFrame, depth: int) -> DataFrame:
    """Nodes of one byte less: sums over their longer contexts."""
    node = F.col("node").bitwiseAND(F.lit((1 << (8 * (depth + 1))) - 1))
    sums = nodes.groupBy(node.alias("node")).agg(
        F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("log_p").alias("longer")
    )
    return sums.mapInPandas(_level(depth), "node BIGINT, zeros DOUBLE, ones DOUBLE, log_p DOUBLE, own DOUBLE")


def _finish(top: pd.DataFrame):
    """Mixes in depths 2 (from the rows), 1 and 0 (at most 65,535 nodes, given) and takes logs."""
    tables = {}
    for depth in (0, 1):
        part = top[top["depth"] == depth].sort_values("node")
        tables[depth] = tuple(part[c].to_numpy() for c in ("node", "zeros", "ones", "own"))

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = _gather(batches)
        if pdf is None:
            return
        two = pdf[pdf["node"].notna()].sort_values("node")
        levels = {2: (two["node"].to_numpy(np.int64), *(two[c].to_numpy(float) for c in ("zeros", "ones", "own")))}
        levels |= tables
        rows = pdf[pdf["code"].notna()]
        for start in range(0, len(rows), 100_000):
            part = rows.iloc[start : start + 100_000]
            code = part["code"].to_numpy(np.int64)
            p = np.stack(part["p"].to_list()).astype(float)
            node, bit = decisions(code)
            for depth in (2, 1, 0):
                nodes, zeros, ones, own = levels[depth]
                at = at_nodes(nodes, shorter(node, depth + 1))
                p = own[at] * _estimate(zeros[at], ones[at], bit.astype(bool)) + (1 - own[at]) * p
            yield pd.DataFrame({"code": code, "value": np.log10(p).sum(axis=1)})

    return finish


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """(code, n) of a task; codes of documents that do not train count nothing but are there."""
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    for pdf in batches:
        parts = [[], []]
        for text, held in zip(pdf["text"], pdf["held_out"]):
            parts[bool(held)] += list(contexts(words(text)))
        for held, codes in enumerate(parts):
            if codes:
                distinct, n = np.unique(np.concatenate(codes), return_counts=True)
                kept.append((distinct, n * (1 - held)))
        if len(kept) > 8:
            kept = [merge(kept)]
    if kept:
        codes, n = merge(kept)
        yield pd.DataFrame({"code": codes, "n": n})


def learn(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(code, value): log10 probability of the byte after its context, for every code of ``docs``
    (text, held_out); documents that are held out do not count.  The sums cover the whole table."""
    counted = docs.select("text", "held_out").mapInPandas(_count, "code BIGINT, n BIGINT")
    counts = scratch.save(counted.groupBy("code").agg(F.sum("n").alias("n")))
    suffix = lambda c, n: F.shiftright(c, 8).bitwiseAND(F.lit((1 << (8 * n)) - 1))
    leaves = scratch.save(counts.repartition(suffix(F.col("code"), 3)).mapInPandas(_leaves, LEAVES))
    scratch.drop(counts)
    two = scratch.save(_up(leaves.where("node IS NOT NULL"), 2))
    one = scratch.save(_up(two, 1))
    zero = _up(one, 0)
    fields = ["node", "zeros", "ones", "own"]
    top = one.select(F.lit(1).alias("depth"), *fields).unionByName(zero.select(F.lit(0).alias("depth"), *fields))
    no = F.lit(None)
    rows = leaves.where("code IS NOT NULL").select(
        suffix(F.col("code"), 2).alias("at"), "code", "p",
        *[no.cast("bigint" if f == "node" else "double").alias(f) for f in fields],
    ).unionByName(two.select(
        F.shiftright("node", 8).alias("at"), no.cast("bigint").alias("code"), no.cast("array<float>").alias("p"), *fields
    ))
    return scratch.save(rows.repartition("at").mapInPandas(_finish(top.toPandas()), "code BIGINT, value DOUBLE"))


# ---------------------------------------------------------------- scoring


def _training_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, n): how often the tokens of a task occur in training; those that do not are there with 0."""

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counter), pa.binary()), pa.array(list(counter.values()), pa.int64())], names=["token", "n"]
        )

    counter: Counter[bytes] = Counter()
    for batch in batches:
        for held, text in zip(*(batch[c].to_pylist() for c in ("held_out", "text"))):
            tokens = words(text)
            counter.update(dict.fromkeys(tokens, 0) if held else tokens)
            counter[END] += not held
        if len(counter) > TOKENS:
            yield rows()
            counter.clear()
    if counter:
        yield rows()


def _chunk_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, token): the distinct tokens of a task's chunks."""
    seen: dict[int, set[bytes]] = {}
    for batch in batches:
        for chunk, text in zip(batch["chunk"].to_pylist(), batch["text"].to_pylist()):
            seen.setdefault(chunk, {END}).update(words(text))
    for chunk, tokens in seen.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk] * len(tokens), pa.int64()), pa.array(list(tokens), pa.binary())], names=["chunk", "token"]
        )


def _chunk_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, code): the distinct codes of a task's chunks."""
    seen: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        new: dict[int, list[np.ndarray]] = {}
        for chunk, text in zip(batch["chunk"].to_pylist(), batch["text"].to_pylist()):
            new.setdefault(chunk, []).extend(contexts(words(text)))
        for chunk, parts in new.items():
            known = seen.setdefault(chunk, [])
            known.append(np.unique(np.concatenate(parts)))
            if len(known) > 8:
                known[:] = [np.unique(np.concatenate(known))]
    for chunk, parts in seen.items():
        codes = np.unique(np.concatenate(parts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(codes), chunk)), pa.array(codes)], names=["chunk", "code"]
        )


SCORES = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("n_bytes", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("vocabulary", pa.int64()),
    ("trained", pa.int64()),
])


def _table(codes: np.ndarray, values: np.ndarray):
    """A lookup of the values of known codes: a hash table, and a search for codes that share a slot."""
    bits = max(10, int(8 * len(codes)).bit_length())
    slots = lambda x: (x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
    order = np.argsort(codes)
    codes, values = codes[order], values[order]
    at = slots(codes)
    table = np.zeros(1 << bits)
    table[at] = values
    shared = np.bincount(at.astype(np.int64), minlength=1 << bits) > 1
    table[shared] = np.nan

    def value_of(x: np.ndarray) -> np.ndarray:
        found = table[slots(x)]
        unsure = np.flatnonzero(np.isnan(found))
        found[unsure] = values[np.searchsorted(codes, x[unsure])]
        return found

    return value_of


def _score(docs: pa.Table, asked: pa.Table) -> pa.Table:
    """Scores of the documents of a chunk.  A chunk of the vocabulary, below zero, gives its totals."""
    tokens = asked["token"].is_valid()
    counts = asked["value"].filter(tokens).to_numpy()
    names = asked["token"].filter(tokens).to_pylist()
    if not docs.num_rows:
        row = [None, None, 0, 0, 0, 0.0, 0.0, int((counts > 0).sum()), int(counts.sum())]
        return pa.table([pa.array([v], f.type) for v, f in zip(row, SCORES)], schema=SCORES)
    logs = dict(zip(names, np.log10(counts + 0.1).tolist()))
    grams = asked["code"].is_valid()
    codes, values = (asked[c].filter(grams).to_numpy() for c in ("code", "value"))
    value_of = _table(codes, values)
    out = []
    for doc_id, held, text in zip(*(docs[c].to_pylist() for c in ("doc_id", "held_out", "text"))):
        found = words(text)
        base = np.fromiter(map(logs.__getitem__, [*found, END]), float, len(found) + 1)
        score, n_bytes = 0.0, 0
        for stretch in contexts(found):
            score += float(value_of(stretch).sum())
            n_bytes += len(stretch)
        out.append((doc_id, held, len(base), int((base > 0).sum()), n_bytes, float(base.sum()), score, None, None))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), SCORES)], schema=SCORES)


def score(docs: DataFrame, scratch: Scratch, held_out_of: int = 10) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte.

    Learns from the documents whose CRC-32 of the id, modulo ``held_out_of``, is not 0.  A null, empty or
    blank text is its end alone; a null doc_id counts as empty text for the remainder; repeated rows are
    counted and scored as often as they occur; without a training row all estimates are those of empty
    counts; an empty table gives no row; other columns of ``docs`` are ignored.
    """
    texts = docs.select(
        F.col("doc_id"), F.col("text").cast("string").alias("text"),
        (remainder("doc_id", held_out_of) == 0).alias("held_out"),
    )
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    model = learn(texts, scratch)
    chunks = max(1, -(-size // CHUNK))
    chunked = texts.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    dealt = chunked.repartition(max(1, -(-chunks // 2)), "chunk")  # one exchange, read three times

    known = texts.mapInArrow(_training_tokens, "token BINARY, n BIGINT")
    known = scratch.save(known.groupBy("token").agg(F.sum("n").alias("n")))
    # A frequent token is in every chunk: a row for each, which the join may split.
    tokens = dealt.mapInArrow(_chunk_tokens, "chunk BIGINT, token BINARY").join(known, "token")
    # Each token also goes to one of the chunks of the vocabulary, which count it.
    counted = (-1 - F.pmod(F.xxhash64("token"), F.lit(chunks))).alias("chunk")
    asked_tokens = tokens.select("chunk", "token", "n").unionByName(known.select(counted, "token", "n")).select(
        "chunk", "token", F.lit(None).cast("bigint").alias("code"), F.col("n").cast("double").alias("value")
    )
    codes = dealt.mapInArrow(_chunk_codes, "chunk BIGINT, code BIGINT")
    asked_codes = codes.join(model, "code").select(
        "chunk", F.lit(None).cast("binary").alias("token"), "code", "value"
    )
    asked = asked_tokens.unionByName(asked_codes)
    schema = (
        "doc_id BIGINT, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, n_bytes BIGINT, base DOUBLE,"
        " score DOUBLE, vocabulary BIGINT, trained BIGINT"
    )
    scored = scratch.save(
        dealt.groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInArrow(_score, schema)
    )
    totals = scored.agg(F.sum("vocabulary").alias("v"), F.sum("trained").alias("n")).first()
    trained, distinct = totals["n"] or 0, totals["v"] or 0
    rest = float(np.log10(trained + 0.1 * (distinct + 1)))
    return scored.where("vocabulary IS NULL").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(trained).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(rest)).alias("base_score"), "score",
        (-F.col("score") * float(np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
