import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from pricelake.llm import substrings as S
from pricelake.llm.fm_index import FMIndex


def brute(rows, window):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - window + 1):
                g = tuple(w[k : k + window])
                least[g] = min(i, least.get(g, i))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and least[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((str(i), len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(400)}"
    passage = [word() for _ in range(70)]
    rows = []
    for i in range(60):
        w = [word() for _ in range(rnd.randrange(0, 160))]
        if i % 3 == 0:
            at = rnd.randrange(len(w) + 1)
            w[at:at] = passage[rnd.randrange(15) : 70 - rnd.randrange(15)]
        rows.append((rnd.randrange(1000), " ".join(w)))
    rows += [(1000 + i, rows[i][1]) for i in range(0, 20, 2)] + [rows[4], (None, rows[0][1]), (2000, None), (2001, "\t \n"), (2002, " ".join(passage * 3)), (2003, " ".join(passage))]
    return list({str(r[0]): r for r in rows if r[0] is not None}.values()) + [rows[4], (None, rows[0][1])]


@pytest.mark.parametrize("words", [60, 300_000])
def test_equal_to_brute_force(spark, docs_of, monkeypatch, words):
    monkeypatch.setattr(S, "SHARD_WORDS", words)
    rows = corpus(words)
    got = S.remove_repeats(docs_of(rows).repartition(3), window=20, gram=5).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(rows, 20)
    for r in got:
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
        assert sum(x.end - x.start for x in r.removed) == r.n_removed


def test_large_batches_are_taken_apart_in_slices():
    # Of a whole batch of 10,000 long texts the words, segments and windows would be held at once.
    texts = [" ".join(f"w{i}x{j}" for j in range(300)) for i in range(8000)]
    ids = pa.array(range(len(texts)), pa.int64())
    few, none = pa.array([[0]] * len(texts), pa.list_(pa.int64())), pa.array([None] * len(texts), pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts), few], names=["doc_id", "version", "text", "known"])
    passes = [
        (list(S._anchor_rows([batch.select(["doc_id", "text"])], 50, 8)), None),
        (list(S._first_pass([batch], 50, 8, False)), len(texts)),
        (list(S._second_pass([pa.RecordBatch.from_arrays([ids, ids, ids, batch.column(2), none], names=list("abcde"))], 50, False)), len(texts)),
    ]
    for out, n in passes:
        assert len(out) >= 3 and max(b.num_rows for b in out) < 0.6 * sum(b.num_rows for b in out)
        assert n is None or sum(b.num_rows for b in out) == n
    assert [x for b in passes[1][0] for x in b.column(0).to_pylist()] == list(range(len(texts)))
    words = pa.array([S.pack40(np.arange(i, i + 92, dtype=np.uint64)) for i in range(5000)])
    ids = pa.array(range(5000), pa.int64())
    cut = list(S._cut_windows([pa.RecordBatch.from_arrays([ids, ids, ids, words], names=list("abcd"))], 50))
    assert sum(b.num_rows for b in cut) == 5000 * 43 and max(b.num_rows for b in cut) < 50_000


def test_empty_table(spark, docs_of):
    assert S.remove_repeats(docs_of([])).count() == 0


def test_matching_statistics_equal_brute_force():
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 3, rng.integers(1, 40)).astype(np.uint64) for _ in range(30)]
    index = FMIndex(texts, np.arange(30), 6)
    queries = [rng.integers(0, 4, 50).astype(np.uint64) for _ in range(10)] + texts[:5]
    found, least = index.matching_statistics(queries)
    for q, f, m in zip(queries, found, least):
        for i in range(len(q) - 5):
            own = [k for k, t in enumerate(texts) if any((t[j : j + 6] == q[i : i + 6]).all() for j in range(len(t) - 5))]
            assert (f[i] == 6) == bool(own) and m[i] == (min(own) if own else -1)
