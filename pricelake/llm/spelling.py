r"""Spelling variants: words one edit apart, found with asymmetric q-chunks.

The shorter word of a pair (either, if they are equally long) is cut into two
disjoint chunks, its halves; one edit leaves one of them whole. The other word
gives its positional grams of the same length, of which those matter that are
at a chunk's place or shifted by one behind the edit. Words meet by an
equi-join on (length, place, chunk), so the first half meets grams at its own
place and the second half meets grams at its place or one further on. What is
left open is a window: the half in which the edit must lie.

A chunk that many words share (``HOT`` and more) is not joined. Its words' open
windows are cut in two, the kept rest of the word is the new chunk, and so on,
until a chunk is rare or the window is one code point long, which no more words
can share than there are letters. So no word or pair is left out and no group
is compared in full.

Every pair is verified by its edit distance and kept in one window only: that
of the first code point in which the words differ.

Words and forms. A word's form is its near word of largest count, if that is
``RATIO`` times its own count or more; counts grow by that factor along forms,
so they end, and roots are found by doubling the steps.

Defined cases: null texts have no words; with a null doc_id no run is changed;
repeated rows count again; equal counts go to the word first in code-point
order; runs of any length are taken whole; other columns are ignored, whatever
their names; an empty table has no words.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import materialize, table
from pricelake.llm.merkle import CRC32

LEAST_CHARS = 7
LEAST_COUNT = 2
RATIO = 10
DROP = 31
HOT = 100
_HELD = 400_000

_LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(doc_id: int | None, text: str, least: int, drop: int) -> Counter:
    """The counts of a document's words of at least ``least`` code points; a run whose checksum ``drop`` divides has lost a code point."""
    runs: Counter = Counter()
    for run, n in Counter(re.findall(rf"[A-Za-zÀ-ÿ]{{{least},}}", text)).items():
        runs[run.lower() if run.isascii() else run.translate(_LOWER)] += n
    if doc_id is None:
        return runs
    seed, out = zlib.crc32(f"{doc_id}:".encode()), Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), seed)
        if h % drop:
            out[run] += n
        elif len(run) > least:
            at = h % len(run)
            out[run[:at] + run[at + 1 :]] += n
    return out


def _count(batches, least: int, drop: int):
    counts: Counter = Counter()
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts.update(words_of(doc, text.as_py() or "", least, drop))
            if len(counts) >= _HELD:
                yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
                counts.clear()
    if counts:
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_CHARS, least_count: int = LEAST_COUNT, drop: int = DROP) -> DataFrame:
    """The words (word, n) of all documents that occur ``least_count`` times or more."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    counted = rows.mapInArrow(lambda batches: _count(batches, least, drop), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _left(word: Column | str, n: Column | str) -> Column:
    return F.substring(word, F.lit(1), F.col(n) if isinstance(n, str) else n)


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds the key of the word's chunk: all of the word but the window [a, b) in a word of ``size``; ``shift`` is the word's own length less ``size``."""
    rest = F.substring("word", F.col("b") + F.col("shift") + 1, F.char_length("word"))
    return rows.withColumn("key", F.xxhash64("size", "a", "b", _left("word", "a"), rest))


def chunks(words: DataFrame, least: int = LEAST_CHARS) -> DataFrame:
    """The halves of each word, as a word of its own length (shift 0) and, as grams, of one code point less (shift 1)."""
    size = F.char_length("word").cast("int")
    sizes = words.withColumn("shift", F.explode(F.when(size > least, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).withColumn("size", size - F.col("shift"))
    half = F.floor(F.col("size") / 2).cast("int")
    windows = F.array(F.struct(F.lit(0).alias("a"), half.alias("b")), F.struct(half.alias("a"), F.col("size").alias("b")))
    return _keyed(sizes.withColumn("w", F.explode(windows)).select("word", "n", "shift", "size", "w.a", "w.b"))


def _halved(rows: DataFrame) -> DataFrame:
    """The rows with each half of their windows."""
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    windows = F.array(F.struct(F.col("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b")))
    return _keyed(rows.withColumn("w", F.explode(windows)).select("word", "n", "shift", "size", "w.a", "w.b"))


def _meet(rows: DataFrame) -> DataFrame:
    """Pairs of words that share a chunk and are one edit apart: (one, one_n, two, two_n)."""
    one = rows.where("shift = 0").select("key", "size", "a", "b", F.col("word").alias("one"), F.col("n").alias("one_n"))
    two = rows.select("key", "shift", F.col("word").alias("two"), F.col("n").alias("two_n"))
    once = (F.col("shift") == 1) | (F.col("one") < F.col("two"))
    here = (_left("one", "a") == _left("two", "a")) & ((F.col("b") == F.col("size")) | (_left("one", "b") != _left("two", "b")))
    return one.join(two, "key").where(once & here & (F.levenshtein("one", "two", 1) == 1)).select("one", "one_n", "two", "two_n")


def near_pairs(words: DataFrame, least: int = LEAST_CHARS, hot: int = HOT) -> DataFrame:
    """Every pair of words (word, n) of at least ``least`` code points that are one edit apart, once: (one, one_n, two, two_n)."""
    found, rows = [], chunks(words, least)
    while rows is not None:
        keys = rows.groupBy("key").agg(F.count_if(F.col("shift") == 0).alias("own"), F.count("*").alias("all")).where("own >= 1 AND all >= 2")
        shared = materialize(rows.join(keys.select("key", (F.col("all") >= hot).alias("hot")), "key"), "spelling-chunks")
        split = F.col("hot") & (F.col("b") - F.col("a") > 1)
        found.append(materialize(_meet(shared.where(~split)), "spelling-pairs"))
        more = shared.where(split)
        rows = None if more.isEmpty() else _halved(more)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Adds to the words their n_near, form and form_n."""
    both = F.array(F.struct(F.col("one").alias("word"), F.col("two").alias("near"), F.col("two_n").alias("near_n")), F.struct(F.col("two").alias("word"), F.col("one").alias("near"), F.col("one_n").alias("near_n")))
    links = pairs.select(F.explode(both).alias("l")).select("l.*")
    best = links.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    strong = -F.col("best.less") >= ratio * F.col("n")
    return words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"),
        F.when(strong, -F.col("best.less")).alias("form_n"),
    )


def with_roots(formed: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Adds the root: the last word that the forms lead to, the word itself if it has no form."""
    most = formed.agg(F.max("n")).first()[0] or 1
    steps = math.floor(math.log(most) / math.log(ratio)) + 1  # the counts along forms grow by the ratio
    known = materialize(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(max(0, math.ceil(math.log2(steps)))):
        further = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        known = materialize(known.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return formed.join(known, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per word: word, form, root, n, n_near and form_n."""
    words = materialize(count_words(table(spark, sf_dir, "documents")), "spelling-words")
    formed = materialize(forms(words, near_pairs(words)), "spelling-forms")
    return with_roots(formed).select("word", "form", "root", "n", "n_near", "form_n")


ORACLE = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents) WHERE length(run) >= 7
), counted AS (
  SELECT doc_id, run, count(*) AS c, coalesce(CAST(doc_id AS VARCHAR) || ':', '') || run AS named FROM runs GROUP BY doc_id, run
), hashed AS (
  SELECT run, c, CASE WHEN doc_id IS NULL THEN 1 ELSE {CRC32.format("named")} END AS h FROM counted
), words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substring(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, c FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2
), cut AS (
  SELECT word, n, i, left(word, i) || substring(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)
), pairs AS (
  SELECT a.word AS word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION
  SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS top FROM pairs GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top >= 10 * w.n THEN b.top END AS form_n,
    CASE WHEN b.top >= 10 * w.n THEN (SELECT min(p.near) FROM pairs p WHERE p.word = w.word AND p.near_n = b.top) END AS form
  FROM words w LEFT JOIN best b ON b.word = w.word
), walk AS (
  SELECT word, word AS at FROM words
  UNION ALL
  SELECT k.word, f.form FROM walk k JOIN formed f ON f.word = k.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, k.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM formed f JOIN walk k ON k.word = f.word JOIN formed l ON l.word = k.at WHERE l.form IS NULL
"""
