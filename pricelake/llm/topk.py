"""Exact top-k inner products by a three-phase uniform threshold.

The components of the quantised vectors are dealt into ``lists`` runs; list j
scores a (query, candidate) pair by the inner product over its run, so the sum
over the lists is the score. Candidates are dealt into blocks by a hash of
their id, queries into blocks likewise, and a task holds one (query block,
candidate block, list):

1. each list gives its local k best entries per query; the scores of these few
   candidates are completed exactly, and the k-th best of them is a safe
   cutoff: no result can lie below it;
2. the cutoff goes back to the lists with the query rows; a result must reach
   cutoff / lists in at least one list, so each list gives all entries that do;
3. the entries are added up; what could still reach the cutoff has its missing
   lists resolved exactly, and the k best are kept.

Work grows with queries x candidates in dense blocks of BLAS products over
integers below 2**53 (Python integers beyond), data moved with the entries.

Defined cases: a vector that is null or holds a null or non-finite component
and a row without vec_id take no part; a vec_id that comes several times counts
once (its smallest vector); shorter vectors count as padded with zeros; ties go
to the smaller vec_id; fewer than k candidates give fewer rows; other columns
are ignored; an empty table gives an empty result. Scores are 64-bit integers:
vectors so large that the product of two lengths may leave that range are
refused with a ``ScoreRange`` error, none is rounded or left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelake.llm.common import materialize, pieces, table

LISTS = 2
BLOCK, QUERY_BLOCK, LEAST_BLOCKS = 4096, 1024, 24


class ScoreRange(ValueError):
    """The vectors' inner products may not fit 64-bit integers."""


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, of the vectors that take part."""
    x = F.col("_v").cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("_v"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("_v").isNotNull() & fine)
    return rows.select("vec_id", F.transform(x, lambda c: F.floor(c * scale)).alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(column: pd.Series) -> np.ndarray:
    width = max((len(v) for v in column), default=0)
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of a with all of b."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    top = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * max(1, d)
    if top < 2.0**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return (a.astype(object) @ b.T.astype(object)) if d else np.zeros((len(a), len(b)), np.int64)


def _local_best(k: int):
    def best(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(candidates):
            ids = candidates["vec_id"].to_numpy()
            p = _products(_matrix(queries["v"]), _matrix(candidates["v"]))
            for q, j, row in zip(queries["query_id"], queries["j"], p):
                row, own = row[ids != q], ids[ids != q]
                top = np.argsort(-row, kind="stable")[:k] if len(row) <= 4 * k else np.argpartition(-row, k)[:k]
                out += [(q, j, int(own[i]), int(row[i])) for i in top]
        return pd.DataFrame(out, columns=["query_id", "j", "vec_id", "part"])

    return best


def _entries(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
    """All entries of a list at or above the query's threshold; without one, all."""
    out = []
    if len(queries) and len(candidates):
        ids = candidates["vec_id"].to_numpy()
        p = _products(_matrix(queries["v"]), _matrix(candidates["v"]))
        for q, j, least, row in zip(queries["query_id"], queries["j"], queries["least"], p):
            hit = (ids != q) if pd.isna(least) else (ids != q) & (row >= int(least))
            out.append(pd.DataFrame({"query_id": q, "j": j, "vec_id": ids[hit], "part": row[hit].astype(np.int64)}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "j": [], "vec_id": [], "part": []}, dtype="int64")


def _resolved(vectors: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """The part of each asked (query, candidate) in this task's list."""
    if not len(asked):
        return pd.DataFrame({"query_id": [], "j": [], "vec_id": [], "part": []}, dtype="int64")
    m = _matrix(vectors["v"])
    if m.size and float(np.abs(m.astype(float)).max()) ** 2 * m.shape[1] >= 2.0**62:
        m = m.astype(object)
    place = {True: {}, False: {}}
    for i, (of_query, vec) in enumerate(zip(vectors["is_query"], vectors["vec_id"])):
        place[bool(of_query)][vec] = i
    a = m[[place[True][q] for q in asked["query_id"]]]
    b = m[[place[False][v] for v in asked["vec_id"]]]
    return pd.DataFrame({"query_id": asked["query_id"], "j": asked["j"], "vec_id": asked["vec_id"], "part": (a * b).sum(1)})


_PART = "query_id bigint, j int, vec_id bigint, part bigint"


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, lists: int = LISTS) -> DataFrame:
    """(query_id, rank, vec_id, score): of each vector whose id is divisible by ``every`` the k candidates of the highest inner product."""
    vecs = materialize(quantised(vectors, id_col, vector_col, scale), "topk-vectors")
    is_query = F.col("vec_id") % every == 0
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    counts = F.count("*"), F.count(F.when(is_query, 1)), F.max(F.size("v")), F.max(length), F.max(F.when(is_query, length))
    n, n_queries, width, longest, longest_query = vecs.agg(*counts).first()
    if (longest or 0.0) * max(1.0, longest_query or 0.0) >= 2.0**62:
        raise ScoreRange(f"scores up to {longest * max(1.0, longest_query or 0.0):.3g} do not fit 64-bit integers: scale the vectors down (scale={scale})")
    blocks, query_blocks = pieces(n, BLOCK, LEAST_BLOCKS), pieces(n_queries, QUERY_BLOCK)
    run = max(1, -(-(width or 0) // lists))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    query_block = lambda c: F.pmod(F.xxhash64(F.col(c), F.lit("query")), F.lit(query_blocks)).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    cut = vecs.withColumn("j", each(lists)).withColumn("v", F.slice("v", F.col("j") * run + 1, run))
    candidates = cut.select(each(query_blocks).alias("qb"), block.alias("cb"), "j", "vec_id", "v").toDF("qb", "cb", "j", "vec_id", "v")
    queries = cut.where(F.col("vec_id") % every == 0).select(query_block("vec_id").alias("qb"), each(blocks).alias("cb"), "j", F.col("vec_id").alias("query_id"), "v").toDF("qb", "cb", "j", "query_id", "v")
    key = ["qb", "cb", "j"]

    def resolve(asked: DataFrame) -> DataFrame:
        """The parts of (query_id, vec_id, j)."""
        both = candidates.withColumn("is_query", F.lit(False)).unionByName(queries.withColumnRenamed("query_id", "vec_id").withColumn("is_query", F.lit(True)))
        asked = asked.select(query_block("query_id").alias("qb"), block.alias("cb"), "j", "query_id", "vec_id").toDF("qb", "cb", "j", "query_id", "vec_id")
        both = both.toDF(*both.columns)
        return both.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(_resolved, _PART)

    def ranked(scores: DataFrame):
        return F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))

    # Phase 1: local lists, their best k, the exact scores of these, the cutoff.
    local = queries.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInPandas(_local_best(k), _PART)
    order = Window.partitionBy("query_id", "j").orderBy(F.desc("part"), "vec_id")
    seen = local.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).select("query_id", "vec_id").distinct()
    seen = materialize(seen, "topk-local")
    exact = resolve(seen.withColumn("j", each(lists))).groupBy("query_id", "vec_id").agg(F.sum("part").alias("score"))
    cutoff = exact.withColumn("_r", ranked(exact)).where(F.col("_r") == k).select("query_id", F.col("score").alias("cutoff"))
    cutoff = materialize(cutoff, "topk-cutoff")

    # Phase 2: all entries at or above cutoff / lists in some list.
    asked = queries.join(cutoff, "query_id", "left").withColumn("least", F.ceil(F.col("cutoff") / lists)).drop("cutoff")
    entries = asked.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInPandas(_entries, _PART)
    entries = materialize(entries, "topk-entries")

    # Phase 3: add up, keep what can reach the cutoff (a missing part lies below the threshold), resolve what is missing.
    sums = entries.groupBy("query_id", "vec_id").agg(F.sum("part").alias("known"), F.collect_set("j").alias("has"))
    sums = sums.join(cutoff, "query_id", "left")
    upper = F.col("known") + (lists - F.size("has")) * (F.ceil(F.col("cutoff") / lists) - 1)
    sums = materialize(sums.where(F.col("cutoff").isNull() | (upper >= F.col("cutoff"))).select("query_id", "vec_id", "known", "has"), "topk-sums")
    missing = sums.select("query_id", "vec_id", F.explode(F.array_except(F.sequence(F.lit(0), F.lit(lists - 1)), "has")).alias("j"))
    parts = resolve(missing).select("query_id", "vec_id", "part").unionByName(sums.select("query_id", "vec_id", F.col("known").alias("part")))
    scores = parts.groupBy("query_id", "vec_id").agg(F.sum("part").alias("score"))
    return scores.withColumn("rank", ranked(scores).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per query its 5 best: query_id, rank, vec_id, score."""
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH good AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM good q, good c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
