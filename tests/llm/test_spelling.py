import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from pricelake.llm import spelling


def counts_of(rows, least=7):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if doc is not None and (crc := zlib.crc32(f"{doc}:{run}".encode())) % 31 == 0:
                run = run[: crc % len(run)] + run[crc % len(run) + 1 :]
            if len(run) >= least:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(counts):
    links = {w: [] for w in counts}
    for a, b in itertools.combinations(counts, 2):
        if near(a, b):
            links[a].append(b)
            links[b].append(a)
    form = {}
    for w, them in links.items():
        best = min(them, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(links[w]), None if form[w] is None else counts[form[w]]))
    return sorted(out)


def run(spark, words, hot):
    frame = spark.createDataFrame(list(words.items()) or [], "word string, n bigint")
    formed = spelling.forms(frame, spelling.near_pairs(frame, hot=hot))
    return sorted(tuple(r) for r in spelling.with_roots(formed).select("word", "form", "root", "n", "n_near", "form_n").collect())


def edits(rng, word, letters="abé"):
    i = rng.randrange(len(word) + 1)
    return rng.choice([word[:i] + rng.choice(letters) + word[i:], word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i + 1 :]])


@pytest.mark.parametrize("hot", [2, 6, 100])
def test_pairs_forms_and_roots_equal_all_pairs(spark, hot):
    rng, words = random.Random(hot), set()
    for _ in range(25):
        word = "".join(rng.choice("ab") for _ in range(rng.randrange(7, 12)))
        for _ in range(8):
            words.add(word)
            word = edits(rng, word)
    counts = {w: rng.choice([2, 3, 20, 30, 300, 4000]) for w in sorted(words) if len(w) >= 7}
    assert run(spark, counts, hot) == expected(counts)


def test_a_half_shared_by_most_words(spark):
    rng = random.Random(5)
    words = {"prefixed" + "".join(rng.choice("ab") for _ in range(8)) for _ in range(150)} | {"".join(rng.choice("ab") for _ in range(8)) + "suffixed" for _ in range(150)} | {"aaaaaaa" + "a" * k for k in range(30)}
    counts = {w: rng.choice([2, 2, 25, 260]) for w in sorted(words)}
    assert run(spark, counts, 10) == expected(counts)


def test_chain_of_forms_and_ties(spark):
    counts = {"edition": 2_000_000, "editions": 200_000, "editionsx": 20_000, "editionsxy": 2_000, "editionsxyz": 200, "editionsxyzz": 20, "editionsxyzzz": 2, "tieword": 2, "tieworda": 20, "tiewordb": 20, "alonexx": 5}
    got = run(spark, counts, 100)
    assert got == expected(counts)
    assert dict((r[0], r[2]) for r in got)["editionsxyzzz"] == "edition"
    assert dict((r[0], r[1]) for r in got)["tieword"] == "tieworda"


def test_words_of_documents(spark, docs_of):
    rng = random.Random(3)
    vocabulary = ["Edition", "edItioN", "résumés", "ÀLAmodes", "short", "x" * 400, "d×d÷ddddd", "straßenbahn"]
    rows = [(i, " ".join(rng.choice(vocabulary) + rng.choice([",", "1", "-", ""]) for _ in range(30))) for i in range(80)]
    rows += [(None, "Edition edition unchanged unchanged"), (5, None), (6, ""), (7, "y" * 50_000 + " " + "y" * 50_000), rows[0], rows[0]]
    got = {r.word: r.n for r in spelling.count_words(docs_of(rows)).collect()}
    assert got == counts_of(rows)
    assert run(spark, got, 100) == expected(got)


def test_empty_table(spark, docs_of):
    words = spelling.count_words(docs_of([]))
    assert spelling.with_roots(spelling.forms(words, spelling.near_pairs(words))).collect() == []
