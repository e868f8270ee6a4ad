import zlib

import numpy as np
import pytest
from hypothesis import given as over, settings, strategies as st
from tokenizers import Tokenizer

from citelake.llm.token_files import Encoder, read_documents, read_tokens, token_index, tokenizer_path, write_tokens
from tests.llm.tables import ODD_ROWS, SF, documents, given, widened


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


TEXTS = st.lists(
    st.sampled_from(
        ["a", "the", "don't", "'s", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", " ", " ", "​",
         "﻿", "é", "ß", "漢字", "١٢", "½", "!", "...", "<|endoftext|>", "\U0001f600", "x1", "_"]
    ) | st.characters(exclude_categories=["Cs"]),
    max_size=25,
).map("".join)


@settings(max_examples=600, deadline=None)
@over(TEXTS)
def test_pieces_encode_like_the_whole(text):
    if not hasattr(test_pieces_encode_like_the_whole, "held"):
        path = tokenizer_path()
        test_pieces_encode_like_the_whole.held = (Tokenizer.from_file(path), Encoder(path, most=50))
    whole, encode = test_pieces_encode_like_the_whole.held
    assert np.frombuffer(encode([text])[0], "<u4").tolist() == ids(whole, text)


def expected(tokenizer, rows):
    out, start = [], 0
    for doc_id, text in rows:
        got = ids(tokenizer, text)
        out.append((doc_id, start, len(got), zlib.crc32(np.array(got, "<u4").tobytes())))
        start += len(got)
    return out


def test_given_table(spark, tmp_path, tokenizer):
    path = str(tmp_path / "out")
    write_tokens(spark.read.parquet(f"{SF}/documents.parquet"), path)
    rows = sorted((d["doc_id"], d["text"]) for d in given("documents"))
    assert sorted(map(tuple, token_index(spark, path).collect())) == expected(tokenizer, rows)
    some = read_documents(spark, path, [5, 77]).collect()
    texts = dict(rows)
    assert {r.doc_id: r.ids for r in some} == {i: ids(tokenizer, texts[i]) for i in (5, 77)}
    plan = read_documents(spark, path, [5, 77])._jdf.queryExecution().toString()
    assert "PushedFilters: [In(doc_id" in plan


def test_odd_rows(spark, tmp_path, tokenizer):
    path = str(tmp_path / "out")
    write_tokens(widened(documents(spark, ODD_ROWS)), path)
    rows = sorted(map(tuple, token_index(spark, path).collect()), key=lambda r: r[1])
    order = [r[0] for r in rows]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert rows[0][1] == 0 and all(a[1] + a[2] == b[1] for a, b in zip(rows, rows[1:]))
    want = sorted((len(ids(tokenizer, t)), zlib.crc32(np.array(ids(tokenizer, t), "<u4").tobytes())) for _, t, _ in ODD_ROWS)
    assert sorted(r[2:] for r in rows) == want
    assert {r.part for r in read_tokens(spark, path).collect()}


def test_empty(spark, tmp_path):
    path = str(tmp_path / "out")
    write_tokens(documents(spark, []), path)
    assert token_index(spark, path).collect() == []
