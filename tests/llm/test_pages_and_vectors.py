import hashlib
import random

import numpy as np
import pytest

from pricelake.llm import html as H
from pricelake.llm import topk as T
from pricelake.llm import warc as W


@pytest.fixture(scope="module")
def pages(spark):
    big = "<html><body><nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1>Title &amp; more</h1><p>First   paragraph of the story, with words.<p>Second one&nbsp;here.<br>Same block.</article><footer>&copy; me</footer></body></html>"
    rows = [(1, "http://a/\r\nX: y", big), (2, None, big.replace("First", "Other")), (3, "u", None), (4, "u", ""), (5, "u", "x" * 1200), (9, "u", "x" * 1200), (7, "u", "x" * 1200), (6, "u", "x" * 10), (8, "u", "x" * 10), (9, "u", "x" * 1200), (None, "u", "x" * 1200), (10, "u", "é" * 600), (11, "u", big * 400)]
    return spark.createDataFrame([(*r, "q") for r in rows], "page_id bigint, url string, html string, text string")


def test_warc_round_trip(spark, pages):
    index = W.write_archives(pages.repartition(2), roll=2000)
    got = W.read_records(index).collect()
    assert len(got) == pages.count() == index.count()
    rows = {}
    for r in got:
        rows.setdefault(r.page_id, r)
    for p in pages.collect():
        data = (p.html or "").encode()
        r = rows[p.page_id]
        assert (r.payload_bytes, r.digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == data
    assert [(rows[i].record_type, rows[i].refers_to) for i in (9, 5, 7, None, 6, 8, 3, 4)] == [("response", None), ("revisit", 9), ("revisit", 9), ("revisit", 9)] + [("response", None)] * 4
    assert rows[1].url == "http://a/%0D%0AX: y" and rows[2].url is None
    assert sorted(r.page_id for r in W.read_records(index.where("page_id in (1, 6)"), payload=False).collect()) == [1, 6]
    assert W.write_archives(pages.limit(0)).count() == 0


@pytest.fixture(scope="module")
def model():
    rng = random.Random(5)
    made = []
    for _ in range(250):
        blocks = H.leaf_blocks(H.built_page(rng))
        made.append((blocks, [int(b.mark or 0) for b in blocks]))
    return H.fit(made, epochs=6)


def test_html_held_out_pages(model):
    rng = random.Random(77)
    paths = H.PathScores(model.weights)
    right = total = 0
    for _ in range(100):
        blocks = H.leaf_blocks(H.built_page(rng))
        scores = [float(model.weights[list(paths[tuple(b.path)] | set(H.hashed(H.text_features(b))))].sum()) for b in blocks]
        for b, z in zip(blocks, H.viterbi(scores, model.step)):
            right += int(b.mark or 0) == z
            total += 1
    assert right / total > 0.97


def test_html_blocks_and_text(spark, pages, model):
    got = H.extract(pages, model).collect()
    by = {r.page_id: r.text for r in got}
    assert len(got) == pages.count() and by[3] == by[4] == ""
    assert by[1] == "Title & more\n\nFirst paragraph of the story, with words.\n\nSecond one here. Same block."
    cut = "<article><p>one<p>two &am"
    assert [b.text for b in H.leaf_blocks(cut)] == ["one", "two &am"]
    assert [b.text for b in H.leaf_blocks("<p>a<!-- <p>no</p> --><script>if (a < b) '</p>'</script>b</p><p class='x")] == ["ab"]
    assert [b.text for b in H.leaf_blocks("1 < 2 &lt;b&gt; <div>x<br>y<hr>z</div><li>p<li>q")] == ["1 < 2 <b>", "x y", "z", "p", "q"]
    assert H.leaf_blocks("") == [] and H.extract(pages.limit(0), model).count() == 0


@pytest.mark.parametrize("tag", sorted(H.RAW - {"head"}))
def test_unclosed_raw_elements_swallow_nothing_but_scripts_and_styles(tag):
    texts = [b.text for b in H.leaf_blocks(f"<article><p>one</p><{tag} src=a><p>two</p><p>three")]
    assert texts == (["one"] if tag in ("script", "style") else ["one", "two", "three"])
    closed = [b.text for b in H.leaf_blocks(f"<article><p>one</p><{tag}><p>not</p></{tag.upper()} ><p>two</p>")]
    assert closed == ["one", "two"]


def test_deep_nesting_takes_linear_time():
    import time

    start = time.time()
    blocks = H.leaf_blocks("<div class=a>x" * 50_000 + "</div>" * 50_000 + "<p>end</p>")
    many = H.leaf_blocks("<p>a</p><video>" * 20_000)
    assert time.time() - start < 20
    assert len(blocks) == 50_001 and max(len(b.path) for b in blocks) <= H.MAX_DEPTH and [t for t, _ in blocks[-1].path] == ["p"]
    assert len(many) == 20_000


def test_elements_below_the_deepest_close_themselves():
    page = "<div>" * (H.MAX_DEPTH + 5) + "deep" + "</div>" * 5 + "<section>s</section>" + "</div>" * (H.MAX_DEPTH - 1) + "<p>top</p>"
    blocks = H.leaf_blocks(page)
    assert [b.text for b in blocks] == ["deep", "s", "top"]
    assert [len(b.path) for b in blocks] == [H.MAX_DEPTH, H.MAX_DEPTH, 2]


def test_large_components(spark):
    schema = "vec_id bigint, embedding array<double>"
    with pytest.raises(T.ScoreRange, match="64-bit"):
        T.top_k(spark.createDataFrame([(0, [3e30, 0.0]), (50, [1.0, 2.0])], schema))
    rows = [(0, [5e6, -2e6]), (50, [3e6, 1e3]), (7, [-5e6, 5.5]), (8, [2e5, 2e6])]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in T.top_k(spark.createDataFrame(rows, schema), k=3).collect())
    q = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    want = []
    for i in (0, 50):
        best = sorted((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in q if j != i)
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert got == sorted(want)


def test_viterbi_equals_enumeration():
    import itertools

    rng = np.random.default_rng(1)
    for _ in range(50):
        s, m = rng.normal(size=6), rng.normal(size=(2, 2))
        best = max(itertools.product((0, 1), repeat=6), key=lambda y: sum(s[i] * y[i] for i in range(6)) + sum(m[a, b] for a, b in zip(y, y[1:])))
        assert tuple(H.viterbi(s.tolist(), m)) == best


def exact(vectors, k, every):
    rows = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            q = [int(np.floor(256 * float(np.float32(x)))) for x in v]
            rows[i] = min(rows.get(i, q), q)
    out = []
    for q in rows:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(rows[q], v)), i) for i, v in rows.items() if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("lists", [1, 2, 3])
def test_top_k_equals_brute_force(spark, lists):
    rng = np.random.default_rng(lists)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=9))]) for i in range(150)]
    rows += [(200 + i, rows[7][1]) for i in range(20)]  # ties
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 9), (303, [float("inf")] * 9), (None, rows[0][1]), (304, [1.0, 2.0]), (305, []), rows[3], (350, [0.0] * 9)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<float>, label int, score int")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in T.top_k(df, k=4, every=10, lists=lists).collect())
    assert got == exact(rows, 4, 10)


def test_top_k_of_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0]), (50, [2.0])], "vec_id bigint, embedding array<float>")
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in T.top_k(df).collect()) == [(0, 1, 50, 131072), (50, 1, 0, 131072)]
    assert T.top_k(df.limit(0)).count() == 0
