"""Removal of long word sequences that a document with a smaller id holds, too.

Words are ``[^\\x20\\x09-\\x0D]+``. A window is ``window`` words of one document;
the words of a window whose sequence also occurs in a document with a smaller
doc_id go.

Comparing every document with an index of all others would not scale, so the
text is dealt into shards by content. Every window has an anchor: its ``GRAM``
words with the smallest hash (the last such on ties); equal windows have equal
anchors at the same place.

1. Anchors that only one document has are left out (a count per anchor).
2. Of every other anchor a document gives a segment: the words of all windows
   that have this anchor. Equal segments are collapsed to the smallest doc_id
   before they are gathered.
3. The segments of an anchor go to one shard. The shard builds a compressed
   FM-index of them (``fm_index``); the segments are streamed through it by
   backward search, and the matching statistics that reach ``window`` words
   name the smallest document that holds each window.
4. An anchor whose segments have more words than a shard holds (a passage in
   many surroundings) would make its shard too large: its segments are cut into single windows,
   of which those in more than one segment are dealt over all shards by their
   hash and go through the same index.
5. The intervals of every occurrence are joined back to the documents.

Words are told apart by 40 bits of a 64-bit hash; a false match needs two
windows that differ in nothing but colliding words.

Defined cases: a null, empty or blank text has no words and is kept as an empty
text; texts shorter than a window are kept whole (with single spaces); repeated
rows have the same doc_id, so none of them removes words of another; rows
without doc_id neither lose words nor take others' words; a window that a
document repeats within itself stays; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import materialize, pieces, shuffle_partitions, slices, table
from pricelake.llm.fm_index import FMIndex
from pricelake.llm.words import WordHashes, gram_hashes, words_of

WINDOW, GRAM = 50, 8
SHARD_WORDS = 300_000
# Bytes of texts, and of segments to be cut into windows, that a worker takes apart at once.
TEXT_BYTES, CUT_BYTES = 4 << 20, 1 << 18


def anchors(grams: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` grams the place of the smallest, the last on ties."""
    at = np.arange(len(grams))
    size = 1
    while size < span:
        step = min(size, span - size)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(grams[right] <= grams[left], right, left)
        size += step
    return at


def hashes_of(words: list[bytes], memo: WordHashes) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def pack40(words: np.ndarray) -> bytes:
    return np.ascontiguousarray(words, "<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpack40(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def _windows_of(words: list[bytes], memo: WordHashes, window: int, gram: int):
    """(word hashes, gram hashes, anchor place of each window)."""
    h = hashes_of(words, memo)
    g = gram_hashes(h, gram)
    return h, g, anchors(g, window - gram + 1)


def _anchor_rows(batches, window: int, gram: int):
    memo = WordHashes()
    for batch in slices(batches, TEXT_BYTES):
        docs, marks = [], []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = words_of(text.as_py())
            if len(words) >= window:
                _, g, at = _windows_of(words, memo, window, gram)
                own = np.unique(g[at])
                marks.append(own)
                docs.append(np.full(len(own), doc))
        if marks:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(marks).view(np.int64)), pa.array(np.concatenate(docs))], names=["anchor", "doc_id"])


def _segments(h, g, at, known: set, window: int):
    """(anchor, start, words) of the segments of one document; known: its anchors that other documents have."""
    places, first = np.unique(at, return_index=True)
    last = np.r_[first[1:], len(at)]  # windows first..last-1 have this anchor
    shared = np.fromiter((int(x) in known for x in g[places].view(np.int64)), bool, len(places))
    for place, a, b, ok in zip(places.tolist(), first.tolist(), last.tolist(), shared.tolist()):
        if ok:
            yield int(g[place : place + 1].view(np.int64)[0]), a, h[a : b - 1 + window]


_SEGMENTS = "array<struct<anchor:bigint,start:int,size:int,mark:bigint,words:binary>>"
_SEGMENT_TYPE = pa.list_(pa.struct([("anchor", pa.int64()), ("start", pa.int32()), ("size", pa.int32()), ("mark", pa.int64()), ("words", pa.binary())]))


def _first_pass(batches, window: int, gram: int, texts: bool):
    """Documents without shared anchors are done; the others give their segments and keep their text."""
    memo = WordHashes()
    for batch in slices(batches, TEXT_BYTES):
        n, kept, digest, raw, segments = [], [], [], [], []
        for text, known in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            words = words_of(text)
            own = []
            if known and len(words) >= window:
                h, g, at = _windows_of(words, memo, window, gram)
                for anchor, start, part in _segments(h, g, at, set(known), window):
                    packed = pack40(part)
                    own.append({"anchor": anchor, "start": start, "size": len(part), "mark": xxhash.xxh64_intdigest(packed) - (1 << 63), "words": packed})
            whole = b" ".join(words) if not own else None
            n.append(len(words))
            kept.append(whole.decode("utf-8") if texts and whole is not None else None)
            digest.append(hashlib.sha256(whole).hexdigest() if whole is not None else None)
            raw.append(text if own else None)
            segments.append(own)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(kept, pa.string()), pa.array(digest, pa.string()), pa.array(raw, pa.string()), pa.array(segments, _SEGMENT_TYPE)],
            names=["doc_id", "version", "n_words", "kept", "kept_sha256", "text", "segments"],
        )


def _search(window: int):
    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        """One shard: the windows of each segment that a smaller document than the segment's own holds."""
        parts = [unpack40(x) for x in pdf["words"]]
        index = FMIndex(parts, pdf["least"].to_numpy(), window)
        _, least = index.matching_statistics(parts)
        starts = [np.flatnonzero((x >= 0) & (x < own)).astype(np.int32) for x, own in zip(least, pdf["least"])]
        hit = np.fromiter(map(len, starts), np.int64, len(starts)) > 0
        found = pd.Series([s for s in starts if len(s)], dtype=object)
        return pd.DataFrame({"anchor": pdf["anchor"].to_numpy()[hit], "mark": pdf["mark"].to_numpy()[hit], "starts": found})

    return search


def _cut_windows(batches, window: int):
    """Single windows of the segments of hot anchors."""
    for batch in slices(batches, CUT_BYTES):
        out = []
        for anchor, mark, least, words in zip(*(batch.column(i).to_pylist() for i in range(4))):
            for i in range(len(words) // 5 - window + 1):
                part = words[5 * i : 5 * (i + window)]
                out.append((anchor, mark, least, i, xxhash.xxh64_intdigest(part) - (1 << 63), part))
        names = ["anchor", "mark", "least", "start", "hash", "words"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types], names=names)


def _second_pass(batches, window: int, texts: bool):
    for batch in slices(batches, TEXT_BYTES):
        removed, kept, digest, gone = [], [], [], []
        for text, starts in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
            words = words_of(text)
            edge = np.zeros(len(words) + 1, np.int64)
            s = np.unique(np.array(starts or [], np.int64))
            np.add.at(edge, s, 1)
            np.add.at(edge, s + window, -1)
            drop = np.cumsum(edge[:-1]) > 0
            whole = b" ".join(w for w, d in zip(words, drop.tolist()) if not d)
            bounds = np.flatnonzero(np.diff(np.r_[0, drop, 0]))
            removed.append(int(drop.sum()))
            gone.append([{"start": a, "end": b} for a, b in bounds.reshape(-1, 2).tolist()])
            kept.append(whole.decode("utf-8") if texts else None)
            digest.append(hashlib.sha256(whole).hexdigest())
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(removed, pa.int64()), pa.array(digest, pa.string()), pa.array(kept, pa.string()), pa.array(gone, span)], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "removed"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, texts: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, kept (null without ``texts``) and the removed spans of words."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("version", F.xxhash64("text"))  # rows of one doc_id may differ
    named = rows.where("doc_id is not null")

    found = materialize(named.select("doc_id", "text").mapInArrow(lambda b: _anchor_rows(b, window, gram), "anchor bigint, doc_id bigint"), "repeat-anchors")
    shared = found.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a < z").select("anchor")
    shared = materialize(shared, "repeat-shared")
    known = found.join(shared, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("known"))
    passed = rows.join(known, "doc_id", "left").select("doc_id", "version", "text", "known")
    schema = f"doc_id bigint, version bigint, n_words bigint, kept string, kept_sha256 string, text string, segments {_SEGMENTS}"
    passed = materialize(passed.mapInArrow(lambda b: _first_pass(b, window, gram, texts), schema), "repeat-first-pass")

    occurrences = passed.select("doc_id", "version", F.explode("segments").alias("s")).select("doc_id", "version", "s.*")
    distinct = occurrences.groupBy("anchor", "mark").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.first("words").alias("words"), F.first("size").alias("size"))
    distinct = materialize(distinct, "repeat-segments")
    per_anchor = distinct.groupBy("anchor").agg(F.count("*").alias("n"), F.min("least").alias("a"), F.max("most").alias("z"), F.sum("size").alias("size"))
    per_anchor = materialize(per_anchor.where("a < z"), "repeat-per-anchor")
    fits = (F.col("n") > 1) & (F.col("size") <= SHARD_WORDS)
    total = per_anchor.where(fits).agg(F.sum("size")).first()[0] or 0
    shards = pieces(total, SHARD_WORDS, shuffle_partitions(spark))
    result = "anchor bigint, mark bigint, starts array<int>"

    cool = distinct.join(per_anchor.where(fits).select("anchor"), "anchor")
    cool = cool.select("anchor", "mark", "least", "words", F.pmod(F.xxhash64("anchor", F.lit("shard")), F.lit(shards)).alias("_shard"))
    hits = cool.groupBy("_shard").applyInPandas(_search(window), result)

    hot = distinct.join(per_anchor.where(F.col("size") > SHARD_WORDS).select("anchor"), "anchor").select("anchor", "mark", "least", "words")
    cut = hot.mapInArrow(lambda b: _cut_windows(b, window), "anchor bigint, mark bigint, least bigint, start int, hash bigint, words binary")
    cut = materialize(cut, "repeat-hot-windows")
    ends = F.array(*(F.struct(of("least").alias("least"), by("words", "least").alias("words")) for of, by in ((F.min, F.min_by), (F.max, F.max_by))))
    several = cut.groupBy("hash").agg(F.min("least").alias("a"), F.max("least").alias("z"), ends.alias("ends")).where("a < z")
    several = materialize(several, "repeat-hot")
    words = several.count() * window * 2
    # Equal hashes propose a window; the words of the largest document must find those of the smallest through the index.
    both = several.select("hash", F.explode("ends").alias("e")).select("hash", "e.least", "e.words")
    both = both.select(F.col("hash").alias("anchor"), F.col("least").alias("mark"), "least", "words", F.pmod(F.xxhash64("hash", F.lit("hot")), F.lit(pieces(words, SHARD_WORDS, shuffle_partitions(spark)))).alias("_shard"))
    confirmed = materialize(both.groupBy("_shard").applyInPandas(_search(window), result).select(F.col("anchor").alias("hash")), "repeat-hot-found")
    confirmed = confirmed.join(several.select("hash", "a"), "hash")
    hot_hits = cut.select("anchor", "mark", "least", "start", "hash").join(materialize(confirmed, "repeat-hot-least"), "hash").where("a < least")
    hot_hits = hot_hits.groupBy("anchor", "mark").agg(F.collect_set("start").alias("starts"))

    # An occurrence beyond its segment's smallest document loses all windows, the smallest loses those found.
    found_of = hits.unionByName(hot_hits)
    judged = distinct.select("anchor", "mark", "least", "most", "size").join(found_of, ["anchor", "mark"], "left").where(F.col("starts").isNotNull() | (F.col("least") < F.col("most")))
    judged = materialize(judged.select("anchor", "mark", "least", "starts"), "repeat-judged")
    places = occurrences.select("anchor", "mark", "doc_id", "version", F.col("start").alias("_start"), "size").join(judged, ["anchor", "mark"])
    all_windows = F.sequence(F.lit(0), F.col("size") - window)
    mine = F.when(F.col("doc_id") > F.col("least"), all_windows).otherwise(F.coalesce("starts", F.array().cast("array<int>")))
    gone = places.select("doc_id", "version", F.transform(mine, lambda i: i + F.col("_start")).alias("starts")).where(F.size("starts") > 0)
    gone = gone.groupBy("doc_id", "version").agg(F.flatten(F.collect_list("starts")).alias("starts"))

    out = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string, removed array<struct<start:int,end:int>>"
    whole = passed.where("kept_sha256 is not null").select("doc_id", "n_words", F.lit(0).cast("bigint").alias("n_removed"), "kept_sha256", "kept", F.array().cast("array<struct<start:int,end:int>>").alias("removed"))
    rest = passed.where("kept_sha256 is null").select("doc_id", "version", "n_words", "text").join(gone, ["doc_id", "version"], "left")
    rest = rest.select("doc_id", "version", "n_words", "text", "starts").mapInArrow(lambda b: _second_pass(b, window, texts), out)
    return whole.unionByName(rest)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    return remove_repeats(table(spark, sf_dir, "documents"), texts=False).select("doc_id", "n_words", "n_removed", "kept_sha256")
