import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from retailmarts.llm import packing
from retailmarts.llm.common import read
from retailmarts.llm.queries import op5_packing
from tests.conftest import SF

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


TEXTS = [
    "a b", " a", "a ", "a  b", "a   b", "a\n b", "a\n  b", "a \n b", "\n", "", "it's 12,5% x y", "  z", "é  ü",
    "\t\ta", "a\t b", "don't  stop", "<|endoftext|> x", "a<|endoftext|>b", "a <|endoftext|>", "日本 語", "a\r\nb", "x " * 50, "\u0085 q", "q  r",
]


@pytest.mark.parametrize("text", TEXTS)
def test_units_encode_as_whole_text(text):
    coded = np.frombuffer(packing.units(packing.VOCABULARY).encode(text), "<u2").tolist()
    assert [*coded, 1] == ids(text)


def check(pieces, texts):
    """Exact round trip: the pieces of each document are its ids, sequences are full and gapless."""
    want = sorted((i if i is not None else -1, ids(t)) for i, t in texts)
    got = {}
    for p in pieces:
        got.setdefault((p["doc_id"] if p["doc_id"] is not None else -1, p["sequence_id"] * packing.WINDOW + p["offset"] - p["start"]), []).append(p)
    found = []
    for (doc_id, _), parts in got.items():
        parts.sort(key=lambda p: p["start"])
        flat = [x for p in parts for x in p["ids"]]
        assert [p["start"] for p in parts] == [sum(q["length"] for q in parts[:i]) for i in range(len(parts))]
        assert all(p["doc_tokens"] == len(flat) for p in parts)
        assert all(p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes()) for p in parts)
        assert all(p["boundary"] == (len(parts) > 1) for p in parts)
        found.append((doc_id, flat))
    assert sorted(found) == want
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    total = sum(len(x) for _, x in want)
    for s, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == min(packing.WINDOW, total - s * packing.WINDOW)


def test_round_trip(spark, scratch):
    docs = read(spark, SF, "documents").repartition(5)
    pieces = packing.pack(docs, scratch).collect()
    check(pieces, [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_odd_rows(scratch, documents):
    rows = [(1, None, "a"), (2, "", None), (None, "x y", "a"), (3, "word " * 9000, "a"), (4, "same", "a"), (4, "same", "a")]
    check(packing.pack(documents(rows), scratch).collect(), [(i, t) for i, t, _ in rows])


def test_query_columns(spark):
    assert op5_packing(spark, SF).columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
    ]


def test_empty(scratch, documents):
    assert packing.pack(documents([]), scratch).count() == 0


def test_padding():
    assert [packing.padded_length(n) for n in (1, 3, 1024, 2047, 2048)] == [1, 2048, 1024, 2048, 2048]
