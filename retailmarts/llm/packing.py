"""Packing: concatenate all token sequences and cut the stream into windows of a fixed length.

Two passes.  The first turns each document into ids and notes where it starts within its task.  The
totals of the tasks (one row each) give every task its place in the one global stream.  The second pass
cuts each document at the multiples of the window; a document that crosses a boundary leaves one
boundary record on either side.  Nothing is shuffled but the task totals.
"""

from __future__ import annotations

import base64
import json
import zlib
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmarts.llm.common import Scratch, partition_starts

WINDOW = 2048
END = 1
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json").removesuffix(".json")
#: Units kept per Python worker, about 100 MB; when full, the table starts afresh.
CACHED = 300_000


class Units(dict):
    """Ids of ` word` by word, as little-endian 16-bit bytes.

    The pattern of the vocabulary never joins a character that is no white space to white space after
    it, so text cut there gives the same ids piece by piece; invented and rare words are encoded once.
    ``vocabulary`` names two files of one vocabulary: ``.json`` says what the ids are and encodes texts that
    hold one of its special tokens; ``.tiktoken`` encodes all others (the tests compare the ids)."""

    def __init__(self, vocabulary: str):
        ranks = {
            base64.b64decode(a): int(b)
            for a, b in (line.split() for line in open(f"{vocabulary}.tiktoken", "rb"))
        }
        self.coder = tiktoken.Encoding(
            "corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.vocabulary = vocabulary
        told = open(f"{vocabulary}.json", encoding="utf-8").read()
        added = told.index("[", told.index('"added_tokens"'))
        self.special = [t["content"] for t in json.JSONDecoder().raw_decode(told, added)[0]]

    @cached_property
    def tokenizer(self):
        """Loaded by workers that meet a special token only: library and file take much memory."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(f"{self.vocabulary}.json")

    def whole(self, text: str) -> bytes:
        if any(t in text for t in self.special):
            return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return array("H", self.coder.encode_ordinary(text)).tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED:
            self.clear()
        ids = self[word] = self.whole(" " + word)
        return ids

    def encode(self, text: str) -> bytes:
        words = text.split(" ")
        # A blank after white space belongs to a run, whose cut depends on its length: no shortcut.
        if any(t in text for t in self.special) or any(not w or w[-1].isspace() for w in words[:-1]) or not words[-1]:
            return self.whole(text)
        return self.whole(words[0]) + b"".join([self[w] for w in words[1:]])


_UNITS: dict[str, Units] = {}


def units(vocabulary: str) -> Units:
    if vocabulary not in _UNITS:
        _UNITS[vocabulary] = Units(vocabulary)
    return _UNITS[vocabulary]


ENCODED = pa.schema([
    ("doc_id", pa.int64()), ("ids", pa.binary()), ("n", pa.int64()), ("_pid", pa.int32()), ("_local_n", pa.int64()),
])
PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("boundary", pa.bool_()),
    ("ids", pa.list_(pa.int32())),
])


def _encoder(vocabulary: str, end: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, pid, before = units(vocabulary), TaskContext.get().partitionId(), 0
        last = array("H", [end]).tobytes()
        for batch in batches:
            coded = [coder.encode(t or "") + last for t in batch["text"].to_pylist()]
            sizes = np.fromiter((len(c) // 2 for c in coded), np.int64, len(coded))
            ends = before + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(coded, pa.binary()), pa.array(sizes),
                 pa.array(np.full(len(coded), pid, np.int32)), pa.array(ends - sizes)],
                schema=ENCODED,
            )
            before = int(ends[-1]) if len(coded) else before

    return encode


def _cutter(window: int, keep_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, coded, n, at in zip(
                batch["doc_id"].to_pylist(), batch["ids"], batch["n"].to_pylist(), batch["_at"].to_pylist()
            ):
                ids = np.frombuffer(coded.as_buffer(), "<u2").astype("<u4")
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, window)
                    stop = min(n, start + window - offset)
                    piece = ids[start:stop]
                    out.append((
                        doc_id, start, stop - start, zlib.crc32(piece.tobytes()), n, sequence, offset,
                        stop - start < n, piece.astype(np.int32) if keep_ids else None,
                    ))
                    start = stop
            columns = list(zip(*out)) if out else [()] * len(PIECES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES
            )

    return cut


def pack(
    docs: DataFrame, scratch: Scratch, window: int = WINDOW, vocabulary: str = VOCABULARY, end: int = END,
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces of all documents in sequences of ``window`` ids; only the last sequence is shorter.

    A document is its ids and one end mark.  A null or empty text is the end mark alone; special tokens of the
    vocabulary inside a text have their own ids; repeated rows are packed as often as they occur; a null
    doc_id is kept; an empty table gives no piece; other columns are ignored.  ``boundary`` marks the
    pieces of a document that a boundary cut, ``ids`` holds a piece's ids.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    encoded = scratch.save(texts.mapInArrow(
        _encoder(vocabulary, end), "doc_id BIGINT, ids BINARY, n BIGINT, _pid INT, _local_n BIGINT"
    ))
    placed = (
        encoded.join(F.broadcast(partition_starts(encoded, ["n"])), "_pid")
        .select("doc_id", "ids", "n", (F.col("_local_n") + F.col("_start_n")).alias("_at"))
    )
    return placed.mapInArrow(
        _cutter(window, keep_ids),
        "doc_id BIGINT, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT,"
        " sequence_id BIGINT, offset BIGINT, boundary BOOLEAN, ids ARRAY<INT>",
    )


def padded_length(length: int, window: int = WINDOW) -> int:
    """A sequence is padded to the window, unless its length is a power of two."""
    return length if length & (length - 1) == 0 else window
