import zlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pricelake.llm import simple8b
from pricelake.llm.bpe import load_tokenizer

TOK = load_tokenizer(simple8b.default_tokenizer())

ODD = [
    None, "", " ", "\t\n\v\f\r", "a  b", "It's they'll, WE'VE. x's,", "<|endoftext|>", "a <|EndOfText|> b<|endoftext|>, c<|startoftext|>.", "naïve Ünïcode ÀÉ, 日本語 テキスト。", "é É, ́, a ̸",
    "🙂 🙃​﻿ ᠎ x", "nbsp em nel\u0085x", "a" * 3000, "1 22, 333² 4.", "\x00\x1c \x1d", "ΑΣ Σ, ΟΔΟΣ.", "İI, ıi.", "...!!! ?!, ,", "end.", "same words", "same words", "'s 's, s' 't.", "x" + "," * 50, "don't,",
]


def expected(text):
    return [*TOK.encode(text or "", add_special_tokens=False).ids, simple8b.END_ID]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=400))
def test_words_unpack_to_what_was_packed(values):
    words, escapes = simple8b.pack(np.array(values, np.uint64))
    assert simple8b.unpack(words, escapes, len(values)).tolist() == values
    assert sorted(escapes.tolist()) == sorted(v for v in values if v >= 2**60)


def test_a_word_takes_as_many_values_as_fit():
    for count, width in zip(simple8b.COUNTS[1:], simple8b.WIDTHS[1:]):
        words, _ = simple8b.pack(np.full(int(count), (1 << int(width)) - 1, np.uint64))
        assert len(words) == 1


@settings(max_examples=300, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t',.!sTabZ1<|>"), st.characters(exclude_categories=["Cs"])), max_size=30), min_size=1, max_size=5))
def test_texts_encode_like_the_library(texts):
    import pyarrow as pa

    ids, sizes = simple8b.encode_texts(pa.array(texts), WORDS)
    ends = np.cumsum(sizes)
    assert [ids[b - n : b].tolist() for b, n in zip(ends, sizes)] == [expected(t)[:-1] for t in texts]


WORDS = simple8b._Words(simple8b.default_tokenizer())


@pytest.mark.parametrize(("block", "file_ids"), [(7, 40), (simple8b.BLOCK, simple8b.FILE_IDS)])
def test_files_hold_all_documents_in_order(spark, docs_of, block, file_ids):
    rows = [(i * 3 - 20, t) for i, t in enumerate(ODD)] + [(None, "no id"), (None, None), (2**62, "far"), (-(2**62), "low")]
    manifest = simple8b.write_ids(docs_of(rows).repartition(5), block=block, file_ids=file_ids)
    got = sorted(simple8b.read_ids(manifest, ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, None, *sorted(d for d, _ in rows if d is not None)]
    of, at = dict(rows), 0
    for r in got:
        assert r.start == at
        want = expected(of[r.doc_id]) if r.doc_id is not None else list(r.ids)
        assert list(r.ids) == want and r.n_tokens == len(want)
        assert r.ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
        at += r.n_tokens
    assert sorted(list(r.ids) for r in got[:2]) == sorted([expected("no id"), expected(None)])
    assert manifest.agg({"n_ids": "sum"}).first()[0] == at


def test_repeated_rows_empty_table_and_a_long_text(spark, docs_of):
    assert simple8b.read_ids(simple8b.write_ids(docs_of([]))).count() == 0
    long = "Some words, of a long text. " * 40_000
    got = simple8b.read_ids(simple8b.write_ids(docs_of([(1, "a b"), (1, "a b"), (2, long), (1, "c")]))).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == [(1, 2), (1, 3), (1, 3), (2, len(expected(long)))]
    assert sorted(r.start for r in got) == [0, *np.cumsum([r.n_tokens for r in sorted(got, key=lambda r: r.start)])[:-1].tolist()]


def test_a_damaged_file_is_refused(tmp_path):
    import pyarrow.fs

    (tmp_path / "x").write_bytes(b"0" * 64)
    with pyarrow.fs.LocalFileSystem().open_input_file(str(tmp_path / "x")) as f, pytest.raises(ValueError, match="no file"):
        simple8b.IdFile(f, 64)
