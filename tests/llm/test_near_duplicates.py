import random
from collections import Counter

import numpy as np

from pricelake.llm import bagminhash as B
from pricelake.llm.words import mix


def multiset(text):
    w = (text or "").encode().split()
    n = min(5, len(w))
    return Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if w else Counter()


def brute(rows):
    up = {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = [(i, multiset(t)) for i, t in rows]
    for a, x in enumerate(sets):
        for y in sets[:a]:
            both, total = sum((x[1] & y[1]).values()), sum((x[1] | y[1]).values())
            if total and both >= 0.8 * total - 1e-9:
                p, q = sorted((root(x[0]), root(y[0])))
                up[q] = p
    return {i: root(i) for i, _ in rows}


def copies(seed=3):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6)))
    rows, n = [], 0
    for _ in range(25):
        base = [word() for _ in range(rnd.randint(8, 220))]
        for _ in range(rnd.choice([1, 1, 2, 5, 30])):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                w[rnd.randrange(len(w))] = word()
            rows.append((n, " ".join(w)))
            n += 1
    rows += [(n, "a b a b a b a b a b"), (n + 1, "a b a b a b a b a b a b a b"), (n + 2, "one two"), (n + 3, "one two"), (n + 4, None), (n + 5, ""), (n + 6, " \n")]
    return rows


def test_classes_equal_brute_force(spark, docs_of):
    rows = copies()
    got = {r.doc_id: r.class_id for r in B.classes(docs_of(rows).repartition(4)).collect()}
    assert got == brute(rows)


def test_large_group_of_near_copies_is_one_class(spark, docs_of):
    rnd = random.Random(1)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(300):
        w = list(base)
        w[rnd.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(base)) for i in range(300)]
    assert {r.class_id for r in B.classes(docs_of(rows)).collect()} == {0}


def star(copies=300, words=200, changed=3):
    """An original with a middle id and copies linked to it, hardly to each other."""
    rnd = random.Random(7)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(words)]
    rows = []
    for i in range(copies):
        w = list(base)
        for k in range(changed):  # far apart: 5 shingles each
            part = words // changed
            w[k * part + rnd.randrange(5, part - 5)] = f"x{i}_{k}"
        rows.append((i + (i >= copies // 2), " ".join(w)))
    return [*rows, (copies // 2, " ".join(base))]


def test_copies_of_an_original_with_a_middle_id_are_one_class(spark, docs_of):
    rows = star()
    sets = dict((i, multiset(t)) for i, t in rows)
    alike = lambda a, b: sum((sets[a] & sets[b]).values()) / sum((sets[a] | sets[b]).values())
    assert all(alike(150, i) >= 0.85 for i in range(0, 301, 10))
    assert sum(alike(a, b) < 0.8 for a in range(0, 100, 5) for b in range(101, 150, 5)) > 150
    got = {r.doc_id: r.class_id for r in B.classes(docs_of(rows)).collect()}
    assert got == brute(rows)


def test_pairs_of_large_buckets_meet_without_any_first_candidate(spark, docs_of, monkeypatch):
    rows = star(120)
    monkeypatch.setattr(B, "SMALL", 2)
    monkeypatch.setattr(B, "BLOCK", 16)
    monkeypatch.setattr(B, "promising", lambda pairs, marks: pairs.selectExpr("a", "b", "0 same").where("false"))
    got = {r.doc_id: r.class_id for r in B.classes(docs_of(rows)).collect()}
    assert got == brute(rows)


def test_repeated_rows_null_ids_and_empty_table(spark, docs_of):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (9, None)]
    got = sorted(((r.doc_id, r.class_id) for r in B.classes(docs_of(rows)).collect()), key=str)
    assert got == sorted([(5, 2), (5, 2), (2, 2), (None, None), (9, 9)], key=str)
    assert B.classes(docs_of([])).count() == 0
    kept = B.one_of_each_class(docs_of(rows))
    assert sorted((str(r.doc_id), r.spans) for r in kept.collect()) == [("2", "x"), ("9", "x"), ("None", "x")]


def test_signatures_estimate_weighted_jaccard_without_bias():
    rng = np.random.default_rng(0)
    errors = []
    for t in range(60):
        keys = mix(np.arange(300, dtype=np.uint64) + np.uint64(10_000 * t))
        w = rng.integers(1, 6, 300).astype(float)
        v = w + np.where(np.arange(300) < 60, 2, 0)
        live = np.arange(300) >= 30
        true = np.minimum(w, v)[live].sum() / (np.maximum(w, v)[live].sum() + w[~live].sum())
        s = B.signatures(np.r_[np.zeros(300, int), np.ones(270, int)], np.r_[keys, keys[live]], np.r_[w, v[live]], 2)
        errors.append((s[0] == s[1]).mean() - true)
    assert abs(np.mean(errors)) < 4 * np.std(errors) / np.sqrt(len(errors)) + 1e-3
