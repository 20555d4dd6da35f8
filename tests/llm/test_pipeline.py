import os

import pytest

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/documents.parquet"), reason="driver tables absent")


def test_stages_keep_columns_and_decide(spark):
    import corpus_pipeline as C
    from pricelake.llm import bagminhash, decontaminate, pii, toxicity
    from pricelake.llm.common import materialize, table

    docs = table(spark, SF, "documents")
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "bpe"]
    model = toxicity.train(docs, table(spark, SF, "labels"))
    clean = {r.doc_id for r in toxicity.score(docs, model).where(f"score < {toxicity.THRESHOLD}").collect()}
    out = docs
    for name, stage in C.STAGES:
        before, out = out, materialize(stage(spark, out, SF), name)
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        if name == "toxicity":
            assert ids == clean
        if name == "near_dedup":
            assert ids == {r.class_id for r in bagminhash.classes(before).collect()}
        if name == "decontamination":
            bad = {r.doc_id for r in decontaminate.leaks(before, table(spark, SF, "benchmark")).collect()}
            assert ids == {r.doc_id for r in before.select("doc_id").collect()} - bad
        if name == "pii":
            assert all(not any(pii.base_spans(r.text)) for r in out.select("text").collect())
        if name != "bpe":
            assert out.columns == docs.columns
        else:
            texts = {r.doc_id: r.text for r in before.collect()}
            assert all(r.decoded == texts[r.doc_id] and r.n_tokens == len(r.ids) for r in out.collect())
    assert {r.doc_id for r in C.run(spark, SF).select("doc_id").collect()} == ids


SCHEMAS = {"documents": "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, class_id bigint", "labels": "doc_id bigint, quality int, toxic int", "benchmark": "item_id bigint, text string"}


def tables(spark, folder, **rows):
    for name, schema in SCHEMAS.items():
        spark.createDataFrame(rows.get(name, []), schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_nulls_repeats_long_texts_and_other_columns(spark, tmp_path):
    import corpus_pipeline as C

    item = "which of the seven old bridges over the quiet river was built before the great fire of the town"
    long = " ".join(f"word{i}" for i in range(30_000))
    texts = [None, "", long, "write to me@x.org today or never at all", "so " + item + " and so on", long + " end", "a plain text of some few words here"]
    docs = [(i, t, "en", "s", 1, 0.5, 7) for i, t in enumerate(texts)] + [(None, None, None, None, None, None, None), (None, "no id but words", "en", "s", 1, 0.5, 7), (6, texts[6], "en", "s", 1, 0.5, 7)]
    sf = tables(spark, tmp_path, documents=docs, benchmark=[(1, item), (2, None), (None, item)], labels=[(0, 1, 0), (None, 1, 1), (3, None, None), (99, 1, 1)])
    got = [(r.doc_id, r.decoded, len(r.ids) == r.n_tokens) for r in C.run(spark, sf).collect()]
    assert all(ok for _, _, ok in got)
    want = [(None, ""), (None, "no id but words"), (0, ""), (1, ""), (2, long), (3, "write to <EMAIL> today or never at all"), (6, texts[6])]
    assert sorted([g[:2] for g in got], key=str) == sorted(want, key=str)


def test_empty_tables(spark, tmp_path):
    import corpus_pipeline as C

    assert C.run(spark, tables(spark, tmp_path)).collect() == []


@pytest.mark.parametrize("key", ["op9_warc", "op10_exact_top_k", "op12_merkle_manifest", "op13_spelling_variants"])
def test_query_matches_sql(spark, key):
    import duckdb

    from pricelake.llm.queries import ORACLE, QUERIES

    con = duckdb.connect()
    for t in ("pages", "embeddings", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[key](spark, SF)
    res = con.execute(ORACLE[key])
    cols = [d[0] for d in res.description]
    assert sorted(map(str, res.fetchall())) == sorted(str(tuple(r)) for r in df.select(*cols).collect())
