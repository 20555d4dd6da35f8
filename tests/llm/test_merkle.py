import zlib
from hashlib import sha256

import pytest

from pricelake.llm import merkle

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, place double, tree string, n string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(doc, text, lang, source, n):
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc, source, lang, n, text)))


def tree(nodes):
    """All levels, by joining one level after the other."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k : k + 3]) for k in range(0, len(out[-1]), 3)])
    return out


def proof(levels, at):
    out = []
    for level in levels[:-1]:
        first = at - at % 3
        out.append((level[first:at], level[at + 1 : first + 3]))
        at //= 3
    return out


def expected(rows):
    key = lambda x: (x is not None, x if x is not None else 0)
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        mine = sorted((r for r in rows if r[3] == s), key=lambda r: (key(r[0]), leaf(*r)))
        trees[s] = mine, tree([leaf(*r) for r in mine])
    top = tree([trees[s][1][-1][0] for s in sources])
    out = []
    for i, s in enumerate(sources):
        mine, levels = trees[s]
        for at, r in enumerate(mine):
            steps = proof(levels, at) + proof(top, i)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[1] is not None
            folded = leaf(r[0], r[1].replace("\n", ""), *r[2:]) if tampered else leaf(*r)
            for a, b in steps:
                folded = h(*a, folded, *b)
            out.append((r[0], leaf(*r), levels[-1][0], top[-1][0], h(*(d for a, b in steps for d in a + b)), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def run(spark, rows, **how):
    frame = spark.createDataFrame([(*r, 0.5, "x", "y") for r in rows], COLUMNS)
    return sorted((tuple(r) for r in merkle.manifest(frame.repartition(3), **how).collect()), key=repr)


ODD = [
    (1, "a\nb", "en", "s", 3), (2, "a\nb", None, "s", None), (3, None, "en", None, 0), (4, "", "en", "é", 0), (None, "no id\n", "en", "s", 5), (None, None, None, None, None),
    (7, "same\n", "en", "s", 4), (7, "same\n", "en", "s", 4), (7, "other", "en", "s", 4), (-5, "naïve\n日本", "de", "z", 8), (6, "x\n" * 100_000, "en", "s", 9), (2**62, "\n", "en", "lone", 1),
]


@pytest.mark.parametrize("block", [1, 2, 7])
def test_equals_level_by_level_trees(spark, block):
    rows = ODD + [(100 + i, f"text {i}\nend", "en", f"source {i % 2}" if i % 5 else "hot", i) for i in range(60)]
    assert run(spark, rows, block=block) == expected(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28])
def test_one_source_of_n_leaves(spark, n):
    rows = [(i, f"t{i}\n", "en", "s", i) for i in range(n)]
    assert run(spark, rows, block=1) == expected(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_block_helpers_agree_with_plain_trees():
    leaves = [h(str(i)) for i in range(20)]
    levels = tree(leaves)
    top, nodes = merkle.climb([bytes.fromhex(x) for x in leaves], merkle.levels(20))
    assert top.hex() == levels[-1][0] and [[x.hex() for x in level] for level in nodes] == levels
    for at, suffix in enumerate(merkle.descend(nodes, b"")):
        assert suffix.hex() == "".join(d for a, b in proof(levels, at) for d in a + b)
        assert merkle.fold(leaves[at], suffix.hex(), merkle.path(at, 20)) == levels[-1][0]
        assert merkle.fold(h("forged"), suffix.hex(), merkle.path(at, 20)) != levels[-1][0]
