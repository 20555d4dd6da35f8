"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir),
works on every document that its predecessor kept and returns the columns of
``documents``. The last stage returns the encoded documents:

1. toxicity: documents whose score reaches the threshold go;
2. near_dedup: of each class of near copies the smallest doc_id stays;
3. decontamination: documents that hold a benchmark item go;
4. pii: personal data in the text is replaced by its kind;
5. bpe: the text becomes ids, which are decoded again as a check.

Defined cases: documents with a null or empty text are clean in every stage and
end without ids and with an empty decoded text; rows without doc_id are kept by
every filter (they have no class and cannot be named by a leak) and encoded; of
rows with one doc_id and one text one stays; texts of any length are
worked on whole; labels and benchmark may be empty; an empty table of documents
gives an empty result; other columns are carried to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm import bagminhash, bpe, decontaminate, pii, toxicity
from pricelake.llm.common import fresh, materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    score, spans = fresh("score"), fresh("spans")
    scored = toxicity.score(docs, model, score_col=score, spans_col=spans)
    return scored.where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bagminhash.one_of_each_class(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """n_chars is left as it came: the length of the text as written."""
    return pii.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the decoded text."""
    done = bpe.encode(docs, decoded=True)
    return done.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", mask_pii),
    ("bpe", encode),
]

#: No stage's rows can be said in SQL (trained models, signatures, a tokenizer): tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
