"""Merkle manifest of a dataset by time-forward processing.

A leaf is the digest of a row. Within a source the leaves, by doc_id, are joined
three at a time into their digest until one node remains; the nodes that remain
of all sources, by source, are joined in the same way into the root.

Nodes carry the label (level, place). Time-forward processing goes through the
nodes by label, and every node sends its digest to its parent through a
priority queue ordered by label, so a node meets its children's digests when its
turn comes. The queue is external: places are cut into blocks of ``3 ** BLOCK``
nodes; a block's part of the queue lies in its task (a heap of no more than the
block's nodes), and what leaves the block, one digest per block, goes through
Spark's sorted shuffle into the next round, whose nodes are the tops of the
blocks. No source's tree lies in one task, and a round divides its size by
``3 ** BLOCK``. The reversed sweep goes through the rounds from the top: each
block is sent the proof suffix of its top node and gives every node, by falling
label, its siblings and its parent's suffix, down to the leaves.

Defined cases: null fields are written as ``-`` in the leaf; a null source is a
source of its own and the first; null doc_ids come first in their source; rows
with equal doc_ids are ordered by their leaves, and equal rows are
interchangeable; a lone leaf is its source's node and a lone source's node is
the root; other columns are ignored, whatever their names; texts of any length
are hashed whole; an empty table has no rows.
"""

from __future__ import annotations

import heapq
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelake.llm.common import materialize, pieces, shuffle_partitions, table

ARITY = 3
BLOCK = 7
TASK_ROWS = 2_000_000


def levels(n: int) -> int:
    """How many times n nodes are joined until one remains."""
    done = 0
    while n > 1:
        n, done = -(-n // ARITY), done + 1
    return done


def join(digests: list[bytes]) -> bytes:
    """The digest of some digests, which are hashed as hex text."""
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def climb(digests: list[bytes], rise: int) -> tuple[bytes, list[list[bytes]]]:
    """The top of a block after ``rise`` levels, and the nodes of each level.

    Messages (level, place, digest) wait in a queue ordered by label; all that
    wait for the smallest label are taken, and their digest is sent on."""
    nodes: list[list[bytes]] = [[] for _ in range(rise + 1)]
    queue = [(0, place, d) for place, d in enumerate(digests)]
    while queue:
        level, place, digest = heapq.heappop(queue)
        nodes[level].append(digest)
        if level == rise:
            continue
        run = [digest]
        while queue and queue[0][0] == level and queue[0][1] // ARITY == place // ARITY:
            run.append(heapq.heappop(queue)[2])
        nodes[level] += run[1:]
        heapq.heappush(queue, (level + 1, place // ARITY, join(run)))
    return nodes[rise][0], nodes


def descend(nodes: list[list[bytes]], suffix: bytes) -> list[bytes]:
    """The proof suffix of each node of the lowest level: its siblings, then its parent's suffix. Labels fall."""
    above = [suffix]
    for level in nodes[-2::-1]:
        below = []
        for place in range(len(level)):
            first = place - place % ARITY
            below.append(b"".join(d for k, d in enumerate(level[first : first + ARITY], first) if k != place) + above[place // ARITY])
        above = below
    return above


def path(place: int, n: int) -> list[tuple[int, int]]:
    """For each level from a leaf to the top: its place in its run, and the run's size."""
    out = []
    while n > 1:
        out.append((place % ARITY, min(ARITY, n - (place - place % ARITY))))
        place, n = place // ARITY, -(-n // ARITY)
    return out


def fold(leaf: str, proof: str, way: list[tuple[int, int]]) -> str:
    """The root that a leaf and its siblings give, all in hex."""
    at = 0
    for place, size in way:
        here, at = at + 64 * place, at + 64 * (size - 1)
        leaf = sha256((proof[at - 64 * (size - 1) : here] + leaf + proof[here:at]).encode()).hexdigest()
    return leaf


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Adds ``place``, the row's number (from 0) in its group by ``order``, without a group in one task.

    Rows are dealt by ranges of (group, order) and numbered inside a range; the
    ranges' counts (a row per group and range) give the rest. Returns the rows
    and the table of groups with their number of rows. ``order`` has no ties."""
    spark = rows.sparkSession
    ranges = pieces(rows.count(), TASK_ROWS, shuffle_partitions(spark))
    dealt = materialize(rows.repartitionByRange(ranges, group, *order).withColumn("_range", F.spark_partition_id()), f"{name}-ranges")
    counts = dealt.groupBy(group, "_range").agg(F.count("*").alias("n"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(counts.withColumn("_start", F.coalesce(F.sum("n").over(before), F.lit(0))), f"{name}-starts")
    own = Window.partitionBy("_range", group).orderBy(*order)
    placed = dealt.withColumn("_own", F.row_number().over(own) - 1).alias("a").join(starts.alias("b"), (F.col("a._range") == F.col("b._range")) & F.col(f"a.{group}").eqNullSafe(F.col(f"b.{group}")))
    kept = [F.col(f"a.{c}") for c in rows.columns]
    return placed.select(*kept, (F.col("_start") + F.col("_own")).cast("bigint").alias("place")), starts.groupBy(group).agg(F.sum("n").alias("n"))


def _rise(total: int, at: int, block: int) -> int:
    """The levels that a block climbs whose lowest nodes have the level ``at`` in a tree of ``total`` leaves."""
    return max(0, min(block, levels(int(total)) - at))


def _tops(at: int, block: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        top, _ = climb(pdf["digest"].tolist(), _rise(pdf["n"].iloc[0], at, block))
        return pd.DataFrame({"tree": [pdf["tree"].iloc[0]], "place": [pdf["block"].iloc[0]], "n": [pdf["n"].iloc[0]], "digest": [top]})

    return run


def _in_blocks(nodes: DataFrame, block: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"place div {ARITY**block}"))


def rounds(most: int, block: int) -> int:
    """Rounds in which a tree of ``most`` leaves reaches its top, at least one."""
    return max(1, -(-levels(most) // block))


def rise(nodes: DataFrame, most: int, block: int, name: str) -> list[DataFrame]:
    """Nodes (tree, place, n, digest) of all trees, round by round; the last table has one node per tree."""
    out = [nodes]
    for k in range(rounds(most, block)):
        tops = _in_blocks(out[-1].select("tree", "place", "n", "digest"), block).groupBy("tree", "block").applyInPandas(_tops(k * block, block), "tree bigint, place bigint, n bigint, digest binary")
        out.append(materialize(tops, f"{name}-round-{k + 1}"))
    return out


def _suffixes(at: int, block: int):
    def run(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        nodes, top = nodes.sort_values("place"), above.iloc[0]
        _, inner = climb(nodes["digest"].tolist(), _rise(nodes["n"].iloc[0], at, block))
        same = {c: [top[c]] * len(nodes) for c in ("subroot", "root", "sources")}
        return pd.DataFrame({"tree": nodes["tree"], "place": nodes["place"], "suffix": descend(inner, top["suffix"]), **same})

    return run


_SENT = "tree bigint, place bigint, suffix binary, subroot binary, root binary, sources bigint"


def _leaves(nodes: pd.DataFrame, above: pd.DataFrame, block: int) -> pd.DataFrame:
    """The result rows of a block of leaves."""
    nodes, top = nodes.sort_values("place"), above.iloc[0]
    total = int(nodes["n"].iloc[0])
    _, inner = climb(nodes["digest"].tolist(), _rise(total, 0, block))
    over = path(int(nodes["tree"].iloc[0]), int(top["sources"]))
    root, folded, proofs = top["root"].hex(), [], []
    for place, leaf, tampered, proof in zip(nodes["place"].tolist(), nodes["digest"], nodes["tampered"], descend(inner, top["suffix"])):
        proof = proof.hex()
        folded.append(fold((leaf if tampered is None else tampered).hex(), proof, path(place, total) + over))
        proofs.append(sha256(proof.encode()).hexdigest())
    return pd.DataFrame({
        "doc_id": nodes["doc_id"].astype("Int64"), "leaf": [x.hex() for x in nodes["digest"]], "subroot": top["subroot"].hex(), "root": root,
        "proof_sha256": proofs, "folded_root": folded, "verified": [x == root for x in folded],
    })


_RESULT = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def sink(tables: list[DataFrame], tops: DataFrame, block: int, name: str, leaves: bool = False) -> DataFrame:
    """The reversed sweep: what ``tops`` holds (tree, suffix, subroot, root, sources) is sent down round by round."""
    sent = tops.withColumn("place", F.lit(0).cast("bigint"))
    for k in range(len(tables) - 2, -1, -1):
        below = _in_blocks(tables[k], block).groupBy("tree", "block").cogroup(sent.withColumnRenamed("place", "block").groupBy("tree", "block"))
        if leaves and not k:
            return below.applyInPandas(lambda nodes, above: _leaves(nodes, above, block), _RESULT)
        sent = materialize(below.applyInPandas(_suffixes(k * block, block), _SENT), f"{name}-down-{k}")
    return sent


def _field(c: Column) -> Column:
    return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))


def manifest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", lang_col: str = "lang", chars_col: str = "n_chars", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified."""
    key, text = F.col(id_col).cast("bigint"), F.col(text_col)
    fields = lambda t: F.concat(*(_field(c) for c in (key.cast("string"), F.col(source_col).cast("string"), F.col(lang_col).cast("string"), F.col(chars_col).cast("string"), t)))
    digest = lambda t: F.unhex(F.sha2(fields(t), 256))
    tampered = F.when(F.crc32(key.cast("string")) % 2 == 0, digest(F.replace(text, F.lit("\n"), F.lit(""))))
    rows = docs.select(F.col(source_col).cast("string").alias("source"), key.alias("doc_id"), digest(text).alias("digest"), tampered.alias("tampered"), F.monotonically_increasing_id().alias("tie"))
    placed, sources = numbered(materialize(rows, "merkle-leaves"), "source", ["doc_id", "digest", "tie"], "merkle")
    ordered, _ = numbered(sources.withColumn("_all", F.lit(0)), "_all", ["source"], "merkle-sources")
    sources = materialize(ordered.select("source", F.col("place").alias("tree"), "n"), "merkle-trees")
    n_sources, most = sources.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()

    leaves = placed.alias("a").join(sources.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")))
    leaves = materialize(leaves.select("tree", "place", "n", "digest", "tampered", "doc_id"), "merkle-nodes")
    up = rise(leaves, most, block, "merkle")
    subroots = up[-1].select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("place"), F.lit(n_sources).cast("bigint").alias("n"), "digest")
    over = rise(subroots, n_sources, block, "merkle-top")
    top = over[-1].select("tree", F.lit(b"").alias("suffix"), F.col("digest").alias("subroot"), F.col("digest").alias("root"), F.lit(n_sources).cast("bigint").alias("sources"))
    suffixes = sink(over, top, block, "merkle-top")
    tops = suffixes.select(F.col("place").alias("tree"), "suffix", "root", "sources").join(up[-1].select("tree", F.col("digest").alias("subroot")), "tree")
    return sink(up, tops, block, "merkle", leaves=True)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified."""
    return manifest(table(spark, sf_dir, "documents"))


_FIELD = "coalesce(CAST(octet_length(encode({0})) AS VARCHAR) || ':' || {0}, '-')"
_HASH = "sha256(" + " || ".join(_FIELD.format(c) for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)")) + " || " + _FIELD + ")"
CRC32 = """xor(list_reduce(list_transform(range(1, octet_length(encode({0})) + 1), lambda i: CAST('0x' || substring(hex(encode({0})), 2 * i - 1, 2) AS BIGINT)),
  lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda x, s: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295), 4294967295)"""

ORACLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_HASH.format("text")} AS leaf, CASE WHEN {CRC32.format("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_HASH.format("replace(text, chr(10), '')")} ELSE {_HASH.format("text")} END AS shown
  FROM documents
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM leaves
), up AS (
  SELECT CAST(tree AS BIGINT) AS tree, CAST(0 AS BIGINT) AS lvl, CAST(pos AS BIGINT) AS pos, CAST(n AS BIGINT) AS n, leaf AS d FROM numbered
  UNION ALL
  SELECT tree, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY tree, lvl, pos // 3, n
), subroots AS (
  SELECT tree, d, lvl AS depth FROM up WHERE n = 1
), top AS (
  SELECT CAST(0 AS BIGINT) AS lvl, CAST(tree AS BIGINT) AS pos, CAST(count(*) OVER () AS BIGINT) AS n, d FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 3, n
), nodes AS (
  SELECT tree, lvl, pos, d FROM up WHERE n > 1
  UNION ALL
  SELECT CAST(-1 AS BIGINT), lvl, pos, d FROM top WHERE n > 1
), steps AS (
  SELECT a.tree AS doc_tree, a.pos AS doc_pos, a.tree, l AS lvl, CAST(l AS BIGINT) AS step, a.pos // CAST(pow(3, l) AS BIGINT) AS pos
  FROM numbered a JOIN subroots s USING (tree), range(0, 40) AS r(l) WHERE l < s.depth
  UNION ALL
  SELECT a.tree, a.pos, CAST(-1 AS BIGINT), l, s.depth + l, a.tree // CAST(pow(3, l) AS BIGINT)
  FROM numbered a JOIN subroots s USING (tree), range(0, 40) AS r(l) WHERE l < (SELECT max(lvl) FROM top)
), siblings AS (
  SELECT s.doc_tree, s.doc_pos, s.step, string_agg(u.d, '' ORDER BY u.pos) FILTER (u.pos < s.pos) AS lefts, string_agg(u.d, '' ORDER BY u.pos) FILTER (u.pos > s.pos) AS rights
  FROM steps s JOIN nodes u ON u.tree = s.tree AND u.lvl = s.lvl AND u.pos // 3 = s.pos // 3 GROUP BY s.doc_tree, s.doc_pos, s.step
), proofs AS (
  SELECT doc_tree, doc_pos, string_agg(coalesce(lefts, '') || coalesce(rights, ''), '' ORDER BY step) AS proof, max(step) + 1 AS depth FROM siblings GROUP BY doc_tree, doc_pos
), folds AS (
  SELECT CAST(tree AS BIGINT) AS tree, CAST(pos AS BIGINT) AS pos, CAST(0 AS BIGINT) AS step, shown AS d FROM numbered
  UNION ALL
  SELECT f.tree, f.pos, f.step + 1, sha256(coalesce(s.lefts, '') || f.d || coalesce(s.rights, '')) FROM folds f JOIN siblings s ON s.doc_tree = f.tree AND s.doc_pos = f.pos AND s.step = f.step
)
SELECT a.doc_id, a.leaf, s.d AS subroot, r.d AS root, sha256(coalesce(p.proof, '')) AS proof_sha256, f.d AS folded_root, f.d = r.d AS verified
FROM numbered a JOIN subroots s USING (tree) JOIN (SELECT d FROM top WHERE n = 1) r ON true
LEFT JOIN proofs p ON p.doc_tree = a.tree AND p.doc_pos = a.pos
JOIN folds f ON f.tree = a.tree AND f.pos = a.pos AND f.step = coalesce(p.depth, 0)
"""
