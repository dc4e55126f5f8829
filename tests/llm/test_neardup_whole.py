"""Texts are found again without pairing all rows that share a doc_id."""

import pytest

from retailmarts.llm import neardup


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_that_share_a_doc_id_are_not_paired(scratch, documents, doc_id):
    text = lambda i: " ".join(f"w{i // 2}x{k}" for k in range(80)) + (" tail" if i % 2 else "")
    docs = documents([(doc_id, text(i), "s") for i in range(40)] + [(doc_id, text(0), "s")])
    search = neardup._Search(docs, scratch, 85)
    assert search.texts.count() == 40
    assert search._candidates(docs).count() == 41
    assert sum(r["kept"] for r in neardup.near_duplicates(docs, scratch).collect()) == 20
