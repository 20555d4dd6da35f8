"""The decontamination operator against its definition, written out in loops."""

import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pricelake.llm import decontaminate as D


def tokens_of(text):
    """(kind, value, opens a sentence with a capital) of each template token."""
    out, start = [], True
    for chunk in (text or "").split():
        kind, value, ends, capital = D.kind_of(chunk)
        if value:
            if capital and not start:
                kind = D.NAME
            if kind == D.NAME and out and out[-1][0] == D.NAME:
                out[-1] = (D.NAME, out[-1][1] + " " + value, False)
            else:
                out.append((kind, value, capital and start))
        start = ends if value else start or ends
    return out


def windows_of(tokens, size):
    """(positions that it stands for, form, key, slots) of every window."""
    shown = lambda part: tuple(k or v for k, v, *_ in part)
    slots = lambda part: [f"{k}{v}" for k, v, *_ in part if k]
    out = [([i], 0, shown(tokens[i : i + size]), slots(tokens[i : i + size])) for i in range(len(tokens) - size + 1)]
    merged = []  # (kind, value, holds an opener, positions)
    for i, (kind, value, opener) in enumerate(tokens):
        if opener or kind == D.NAME:
            if merged and merged[-1][0] == D.NAME:
                k, v, o, at = merged[-1]
                merged[-1] = (k, v + " " + value, o or opener, [*at, i])
            else:
                merged.append((D.NAME, value, opener, [i]))
        else:
            merged.append((kind, value, False, [i]))
    # a run of names without an opener is one token already, so positions are those of the first form
    for i in range(len(merged) - size + 1):
        part = merged[i : i + size]
        if any(p[2] for p in part):
            out.append((part[0][3], 1, shown(part), slots(part)))
    return out


def expected(docs, items, coverage=D.COVERAGE):
    out = set()
    for item, text in items:
        tokens = tokens_of(text)
        size = min(D.WINDOW, len(tokens))
        if not size:
            continue
        literal = all(k for k, *_ in tokens) or not any(any(not k for k, *_ in tokens[i : i + size]) for i in range(len(tokens) - size + 1))
        words = lambda ts: [(0, v, False) for _, v, _ in ts]
        mine = windows_of(words(tokens), size) if literal else [w for w in windows_of(tokens, size) if any(isinstance(x, str) for x in w[2])]
        counted = {w[0][0] for w in mine if w[1] == 0}
        mine = [(p, f, key, slots) for at, f, key, slots in mine for p in at if p in counted]
        for doc, body in docs:
            if doc is None:
                continue
            found = tokens_of(body)
            theirs = windows_of(words(found), size) if literal else windows_of(found, size)
            by_key = defaultdict(list)
            for at, form, key, slots in theirs:
                by_key[key].append((at[0], form, slots))
            places = defaultdict(set)
            for p, form, key, slots in mine:
                for q, dform, dslots in by_key[key]:
                    places[form, dform, q - p].add((p, tuple(zip(slots, dslots))))
            covered = set()
            for hits in places.values():
                votes = Counter((i, d) for _, pairs in hits for i, d in set(pairs))
                stands = {i: max((n, d) for (j, d), n in votes.items() if j == i)[1] for i, _ in votes}
                covered |= {p for p, pairs in hits if all(stands[i] == d for i, d in pairs)}
            if len(covered) >= coverage * len(counted):
                out.add((doc, item))
    return out


NAMES = ["Anna", "Bob", "Carl", "Lee", "Kim"]
WORDS = "buys sells eats and then has gives the a red old new box hat of to for with near".split()


def sentence(rnd):
    words = [rnd.choice(NAMES) if rnd.random() < 0.2 else str(rnd.randrange(9)) if rnd.random() < 0.2 else rnd.choice(["km", "kg", "five"]) if rnd.random() < 0.05 else rnd.choice(WORDS) for _ in range(rnd.randrange(4, 9))]
    if rnd.random() < 0.7:
        words[0] = words[0].capitalize()
    return " ".join(words) + rnd.choice([".", "?", "!", ","])


def reparameterised(rnd, text):
    names, numbers = dict(zip(NAMES, rnd.sample([*NAMES, "Tom Ford", "Eve"], len(NAMES)))), {str(i): str(rnd.randrange(20)) for i in range(9)}
    out = []
    for w in text.split(" "):
        bare = w.rstrip(".?!,")
        out.append((names.get(bare) or numbers.get(bare) or bare) + w[len(bare) :])
    if rnd.random() < 0.4:
        out[rnd.randrange(len(out))] = rnd.choice(["7", "Zoe", "changed", "x y"])
    return " ".join(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_leaks_equal_the_definition(spark, docs_of, seed):
    rnd = random.Random(seed)
    items = [(i, " ".join(sentence(rnd) for _ in range(rnd.randrange(1, 4)))) for i in range(25)]
    items += [(100, items[0][1]), (101, "3 4 5 6"), (102, "short one"), (103, ""), (104, "Anna Lee has 12 apples."), (105, "Bob")]
    docs = [(i, " ".join([*(sentence(rnd) for _ in range(rnd.randrange(3))), reparameterised(rnd, rnd.choice(items)[1]), *(sentence(rnd) for _ in range(rnd.randrange(3)))])) for i in range(60)]
    docs += [(200, None), (201, ""), (202, "so Carl has 9 apples"), (203, "it is a short one, really"), (204, "the 3 4 5 6 and"), (205, "Kim has 9 apples. Anna Lee has 12 apples."), (None, items[0][1])]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in D.leaks(docs_of(docs).repartition(3), frame).collect()}
    want = expected(docs, items)
    assert got == want and len(want) > 40


def test_two_names_at_a_sentence_start_are_one_placeholder(spark, docs_of):
    items = spark.createDataFrame([(1, "Anna Lee has 12 apples and buys 5 more."), (2, "Once Ann has 3 hats. Tom sells 4 old hats to her.")], "item_id bigint, text string")
    rows = [(1, "Carl has 9 apples and buys 2 more."), (2, "Maria Lopez has 9 apples and buys 2 more."), (3, "Once Ann has 3 hats. Tom Ford Kay sells 4 old hats to her."), (4, "Carl had 9 pears and sold 2 more.")]
    assert sorted((r.doc_id, r.item_id) for r in D.leaks(docs_of(rows), items).collect()) == [(1, 1), (2, 1), (3, 2)]


def test_one_changed_number_costs_its_windows_only(spark, docs_of):
    item = "first take 5 parts of salt and of lime then add them to water for the old pot and stir it well until the mix is thick enough to cut before you add 5 parts of sand"
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    got = {r.doc_id: r for r in D.leaks(docs_of([(1, item.replace("add 5", "add 6")), (2, item.replace("5", "8"))]), items).collect()}
    assert set(got) == {1, 2} and got[1].covered < 1 and (got[2].covered, got[2].changed) == (1.0, 1)


def test_an_item_given_twice_a_shared_window_and_a_long_text(spark, docs_of):
    shared = "what is the value of"
    items = [(i, f"{shared} the {w} thing in this long question number one") for i, w in enumerate(WORDS)] + [(0, "zzz never")]
    long = "some words that say nothing here at all. " * 20_000
    docs = [(1, long + items[3][1] + " " + long), (2, shared), (3, f"{shared} it all")]
    got = {(r.doc_id, r.item_id) for r in D.leaks(docs_of(docs), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == expected(docs, items[:-1]) and (1, 3) in got and not {d for d, _ in got} & {2, 3}


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet=st.sampled_from("aZé5.,:;!?$%°'-km"), min_size=1, max_size=6), st.sampled_from(["Five", "km.", "KG", "USA", "iPhone", "Ünï", "two,", "€", "$5", "ǅa"])), min_size=1, max_size=5))
def test_short_cuts_agree_with_the_definition_of_kinds(pieces):
    values, _, facts = D.Chunks()(pieces)
    assert [(int(f) & 3, v, bool(f & 8), bool(f & 16)) for v, f in zip(values, facts)] == [D.kind_of(p) for p in pieces]


def test_templates_of_several_texts_are_those_of_each():
    rnd = random.Random(9)
    texts = [" ".join(sentence(rnd) for _ in range(4)) for _ in range(20)] + ["", None, "..."]
    t = D.Templates(pa.array(texts), D.Chunks())
    for n, text in enumerate(texts):
        mine = [i for i in range(len(t.kind)) if t.text[i] == n]
        assert [(int(t.kind[i]), t.value(i), bool(t.opener[i])) for i in mine] == tokens_of(text)
        assert [int(t.place[i]) for i in mine] == list(range(len(mine)))
