import re

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pricelake.llm import bpe

TOK = bpe.load_tokenizer(bpe.default_tokenizer())

ODD = [
    None, "", " ", "  ", "a  b", "a \n b ", "x\n\n y", "it's they'll  we've", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "foo\n <|endoftext|>",
    "naïve ünïcode 日本語 テキスト", "🙂 🙃​﻿ ᠎ x", "tab\tand nbsp em \u0085nel", "a" * 3000, "\r\n \r\n", " lead", "trail ", "1 22 333²", "\x00\x1c \x1d", "same words", "same words",
]


def expected(text):
    ids = TOK.encode(text or "", add_special_tokens=False).ids
    return ids, TOK.decode(ids, skip_special_tokens=False)


@settings(max_examples=400, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sabZ1.<|>"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_words_join_and_encode_like_the_text(text):
    words = bpe.cut_words(text, None)
    assert "".join(words) == text
    assert [i for w in words for i in TOK.encode(w, add_special_tokens=False).ids] == expected(text)[0] or "<|endoftext|>" in text


@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.sampled_from([t or "" for t in ODD]), st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sabZ1.<|>"), st.characters(exclude_categories=["Cs"])), max_size=40)), min_size=1, max_size=6))
def test_distinct_words_join_to_the_texts(texts):
    special = re.compile(r"(<\|endoftext\|>)")
    order, lens, codes, words = bpe._distinct_words(pa.array(texts), special)
    flat, ends = words.take(pa.array(codes)).to_pylist(), lens.cumsum()
    assert sorted(order.tolist()) == list(range(len(texts)))
    for i, n, end in zip(order.tolist(), lens, ends):
        own = flat[end - n : end]
        assert "".join(own) == texts[i]
        assert [t for w in own for t in TOK.encode(w, add_special_tokens=False).ids] == expected(texts[i])[0]


def test_more_buckets_than_words_and_no_table_left(spark, docs_of, monkeypatch):
    monkeypatch.setattr(bpe, "BUCKET_CHARS", 1)
    before = {t.name for t in spark.catalog.listTables()}
    rows = [(i, f"word{i % 7} and  more {i}") for i in range(40)]
    got = {r.doc_id: list(r.ids) for r in bpe.encode(docs_of(rows).repartition(4), block_chars=100).collect()}
    assert got == {i: expected(t)[0] for i, t in rows}
    assert {t.name for t in spark.catalog.listTables()} == before


def test_a_very_long_text(spark, docs_of):
    long = "Words of a long text, 日本 \n and  more. " * 30_000
    got = {r.doc_id: (list(r.ids), r.decoded) for r in bpe.encode(docs_of([(1, long), (2, "x" * 200_000)]), block_chars=1000, decoded=True).collect()}
    assert got == {1: expected(long), 2: expected("x" * 200_000)}


@pytest.mark.parametrize("block_chars", [20, 10**6])
def test_ids_and_round_trip_equal_the_library(spark, docs_of, block_chars):
    rows = list(enumerate(ODD)) + [(None, "no id")]
    docs = docs_of(rows).repartition(3)
    encoded = bpe.encode(docs, block_chars=block_chars)
    for frame in (bpe.decode(encoded), bpe.encode(docs, block_chars=block_chars, decoded=True)):
        got = {r.doc_id: (list(r.ids), r.decoded) for r in frame.collect()}
        assert len(got) == len(rows)
        for i, t in rows:
            assert got[i] == expected(t), (i, t)


def test_empty_table_and_repeated_rows(spark, docs_of):
    assert bpe.encode(docs_of([])).count() == 0
    got = bpe.encode(docs_of([(1, "a b"), (1, "a b"), (1, None)])).collect()
    assert sorted(len(r.ids) for r in got) == [0, 2, 2]


def test_decode_skips_unknown_ids(spark):
    df = spark.createDataFrame([([15496, None, 999_999, -4],), (None,), ([],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(df).collect()] == ["Hello", "", ""]
