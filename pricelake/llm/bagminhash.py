"""Near-duplicate classes by BagMinHash signatures.

A document is the multiset of its five-word shingles. Its signature follows
the weighted minimum of hierarchical Poisson processes: the weight axis of
each shingle is cut at 0, 1, 2, 4, 8, ...; each cell has its own process whose
points arrive at the rate of the cell's width, fall on a random place of the
cell and into a random register. A document of weight w sees the points that
lie below w, and a register keeps the earliest. Two documents agree in a
register with the probability of their weighted Jaccard similarity, unbiased.
Only points up to a time by which all registers are almost surely filled are
drawn (the time is raised for the documents where one is empty), so a document
costs about its shingles plus m log m points, not m per shingle.

Exact copies are collapsed, then signatures are banded (32 bands of 5 registers:
a pair at similarity 0.8 shares no bucket with a chance of 3e-6). Candidates are
all pairs in a bucket of at most ``SMALL`` documents; in a larger one first every
member with ``CENTRES`` members (of each hash slot the one whose large buckets
hold most documents, as an original's among its copies do), and, within the finer
buckets that two neighbouring bands make (10 registers), every member with the
smallest id. So these candidates grow with the members of the buckets, not their
squares, and a member of a large group meets the centres of all buckets it is in.

A candidate whose signatures agree in under ``LEAST`` registers is dropped (a
pair at similarity 0.8 does so with a chance under 1e-8). Of the others the exact
multiset overlap is counted: of each document the most agreeing pair first, then
all whose ends are not connected by these. Then the pairs of large buckets that
are still in two classes are compared, too: the bucket is dealt into blocks of
about ``BLOCK`` members, those of its largest class apart, since they need not meet
one another; each pair of blocks is one task's group and gives only the edges that
join two classes of it. So rows grow with members x blocks, and no pair of a bucket
is left out.

Defined cases: null, empty and blank texts have no shingle and are alone in
their class; a text of one to four words is one shingle; repeated rows share
the class; rows of one doc_id with different texts count as one document that
links their classes; rows without doc_id get a null class; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import materialize, table
from pricelake.llm.words import WordHashes, gram_hashes, mix, words_of

BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
SHINGLE = 5
SIMILARITY = 0.8
#: Buckets of at most so many documents give all their pairs.
SMALL = 32
#: Centres of a larger bucket.
CENTRES = 2
#: About so many members of a larger bucket meet as many others in one group.
BLOCK = 256
#: Registers (of 160, by one byte each) in which a pair has to agree to be verified.
LEAST = 96
_EMPTY = np.inf


def shingles(words: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Shingle hashes of a document; fewer than n words make one shingle."""
    return gram_hashes(words, min(n, len(words))) if len(words) else np.zeros(0, np.uint64)


def _uniform(bits: np.ndarray) -> np.ndarray:
    """In (0, 1]."""
    return ((bits >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def signatures(doc: np.ndarray, item: np.ndarray, weight: np.ndarray, n_docs: int, registers: int = REGISTERS) -> np.ndarray:
    """[n_docs, registers] arrival times; rows (doc, item, weight) are distinct items with weight >= 1, ordered by doc. Documents without items stay infinite."""
    out = np.full((n_docs, registers), _EMPTY)
    mass = np.bincount(doc, weight, n_docs)
    todo = np.flatnonzero(mass > 0)
    cells = 1 + np.ceil(np.log2(weight)).astype(np.int64)
    limit = np.full(n_docs, 0.0)
    limit[todo] = registers * (np.log(registers) + 4) / mass[todo]
    while todo.size:
        use = np.isin(doc, todo) if todo.size < n_docs else slice(None)
        d, w, c = doc[use], weight[use], cells[use]
        cell = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        d, w = np.repeat(d, c), np.repeat(w, c)
        state = mix(np.repeat(item[use], c) + cell.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        low = np.where(cell > 0, np.exp2(cell - 1.0), 0.0)
        width = np.where(cell > 0, low, 1.0)
        time = np.zeros(len(d))
        flat = np.full(n_docs * registers, _EMPTY)
        while d.size:
            state = state + np.uint64(0x9E3779B97F4A7C15)
            a = mix(state)
            time = time - np.log(_uniform(a)) / width
            alive = time <= limit[d]
            if not alive.all():
                d, w, low, width, state, time, a = (v[alive] for v in (d, w, low, width, state, time, a))
            b = mix(a ^ np.uint64(0xA0761D6478BD642F))
            seen = low + _uniform(mix(b)) * width <= w
            slot = d * registers + (b % np.uint64(registers)).astype(np.int64)
            np.minimum.at(flat, slot[seen], time[seen])
        got = flat.reshape(n_docs, registers)
        full = todo[np.isfinite(got[todo]).all(1)]
        out[full] = got[full]
        todo = np.setdiff1d(todo, full, assume_unique=True)
        limit[todo] *= 2
    return out


def band_keys(times: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """[n_docs, bands] bucket keys."""
    bits = mix(np.ascontiguousarray(times).view(np.uint64)).reshape(len(times), bands, -1)
    out = np.full((len(times), bands), 0, np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(bits.shape[2]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, r])
    return out.view(np.int64)


def multisets(texts: list, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, item, weight) of many texts, ordered by doc and item."""
    doc, item = [], []
    for i, t in enumerate(texts):
        words = words_of(t)
        s = shingles(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
        item.append(s)
        doc.append(np.full(len(s), i))
    doc, item = np.concatenate(doc), np.concatenate(item)
    order = np.lexsort((item, doc))
    doc, item = doc[order], item[order]
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])]) if len(doc) else np.zeros(0, int)
    return doc[first], item[first], np.diff(np.r_[first, len(doc)]).astype(np.float64)


def _sign(batches):
    hashes = WordHashes()
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for a in range(0, len(texts), 512):
            part = texts[a : a + 512].to_pylist()
            doc, item, weight = multisets(part, hashes)
            times = signatures(doc, item, weight, len(part))
            has = np.isfinite(times[:, 0])
            keys = band_keys(times)
            digest = [xxhash.xxh3_128_hexdigest(b" ".join(words_of(t))) if h else None for t, h in zip(part, has)]
            bands = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
            low = mix(np.ascontiguousarray(times).view(np.uint64)).astype(np.uint8)
            marks = pa.array([row.tobytes() for row in low], pa.binary())
            yield pa.RecordBatch.from_arrays([ids[a : a + 512], pa.array(digest, pa.string()), bands, marks], names=["doc_id", "digest", "bands", "marks"])


def _elements(batches):
    """Distinct (shingle, occurrence) hashes: the intersection of two such sets is the multiset overlap."""
    hashes = WordHashes()
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for a in range(0, len(texts), 128):
            doc, item, weight = multisets(texts[a : a + 128].to_pylist(), hashes)
            n = weight.astype(np.int64)
            nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            items = np.repeat(item, n)
            items = np.where(nth > 0, mix(items + nth.astype(np.uint64)), items).view(np.int64)
            ends = np.r_[0, np.cumsum(np.bincount(doc, weight, len(ids[a : a + 128])))].astype(np.int32)
            yield pa.RecordBatch.from_arrays([ids[a : a + 128], pa.ListArray.from_arrays(pa.array(ends), pa.array(items))], names=["doc_id", "items"])


def _agreeing(batches):
    for batch in batches:
        if len(batch):
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(len(batch), -1) for k in (2, 3))
            same = (x == y).sum(1)
            good = pa.array(same >= LEAST)
            yield pa.RecordBatch.from_arrays([c.filter(good) for c in (*batch.columns[:2], pa.array(same.astype(np.int32)))], names=["a", "b", "same"])


def promising(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """(a, b, same): those pairs whose signatures agree enough, in how many registers; marks: (rep, marks)."""
    one = materialize(pairs.join(marks.toDF("b", "_y"), "b").select("a", "b", "_y"), "minhash-marked")
    both = one.join(marks.toDF("a", "_x"), "a").select("a", "b", "_x", "_y")
    return materialize(both.mapInArrow(_agreeing, "a bigint, b bigint, same int"), "minhash-promising")


def verified(pairs: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """Those pairs (a, b) whose multisets of shingles overlap enough; items: (doc_id, items)."""
    one = materialize(pairs.join(items.select(F.col("doc_id").alias("b"), F.col("items").alias("y")), "b"), "minhash-half")
    both = one.join(items.select(F.col("doc_id").alias("a"), F.col("items").alias("x")), "a")
    common = F.size(F.array_intersect("x", "y"))
    return materialize(both.where(common >= similarity * (F.size("x") + F.size("y") - common) - 1e-9).select("a", "b"), "minhash-edges")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of the edges (a, b); comp is the smallest node of its component.

    Rounds of taking the smallest label of the neighbours, then of following
    one's label to that node's label; each round's labels are written out, so
    the plan stays short and AQE can split a hub's partition."""
    both = materialize(edges.union(edges.select("b", "a")).toDF("src", "dst").distinct(), "components-edges")
    labels = materialize(both.groupBy(F.col("src").alias("node")).agg(F.least(F.col("node"), F.min("dst")).alias("comp")), "components")
    while True:
        heard = both.join(labels.select(F.col("node").alias("src"), "comp"), "src").groupBy(F.col("dst").alias("node")).agg(F.min("comp").alias("_heard"))
        told = materialize(labels.join(heard, "node").select("node", F.least("comp", "_heard").alias("_to"), F.col("comp").alias("_was")), "components-told")
        after = told.join(told.select(F.col("node").alias("_to"), F.col("_to").alias("comp")), "_to")
        after = materialize(after.select("node", "comp", (F.col("comp") != F.col("_was")).alias("_moved")), "components")
        labels = after.select("node", "comp")
        if not after.where("_moved").limit(1).count():
            return labels


def candidates(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a < b) of (rep, bands) to look at first; (bucket, rep) of the members of large buckets."""
    members = reps.select("rep", F.posexplode("bands").alias("_band", "bucket"), F.col("bands"))
    finer = F.xxhash64("bucket", F.col("bands")[F.pmod(F.col("_band") + 1, F.lit(BANDS))])
    members = members.select("rep", "bucket", finer.alias("finer"))
    sizes = members.groupBy("bucket").agg(F.min("rep").alias("_a"), F.max("rep").alias("_z"), F.count("*").alias("n")).where("_a < _z").drop("_a", "_z")
    shared = materialize(members.join(materialize(sizes, "minhash-buckets"), "bucket"), "minhash-shared")
    large = shared.where(F.col("n") > SMALL)
    degrees = materialize(large.groupBy("rep").agg(F.sum("n").alias("degree")), "minhash-degrees")
    large = materialize(large.drop("n").join(degrees, "rep"), "minhash-large")
    centres = large.groupBy("bucket", F.pmod(F.xxhash64("rep"), F.lit(CENTRES)).alias("_slot")).agg((-F.max(F.struct("degree", (-F.col("rep")).alias("c")))["c"]).alias("c"))
    star = large.join(materialize(centres.select("bucket", "c"), "minhash-centres"), "bucket").where("c != rep").select(F.least("c", "rep").alias("a"), F.greatest("c", "rep").alias("b"))
    centres = materialize(large.groupBy("finer").agg(F.min("rep").alias("a")), "minhash-fine-centres")
    fine = large.join(centres, "finer").where("a < rep").select("a", F.col("rep").alias("b"))
    few = shared.where(F.col("n") <= SMALL).groupBy("bucket").agg(F.sort_array(F.collect_set("rep")).alias("r"))  # at most SMALL each
    few = few.select(F.explode(F.expr("flatten(transform(r, (x, i) -> transform(slice(r, i + 2, size(r)), y -> struct(x as a, y as b))))")).alias("p")).select("p.a", "p.b")
    return star.union(fine).union(few).distinct(), large.select("bucket", "rep").distinct()


def _crossing(similarity: float):
    """Edges between classes of one group (bucket, i, j): members of block i against those of block j."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        rep, label, block, i, j, bucket = (group[k].to_numpy() for k in ("rep", "comp", "block", "i", "j", "bucket"))
        label, bucket, n = label.copy(), bucket[0], len(rep)
        marks = np.frombuffer(b"".join(group["marks"].to_pylist()), np.uint8).reshape(n, -1)
        bands = group["bands"].combine_chunks().flatten().to_numpy().reshape(n, -1)
        items = group["items"].combine_chunks()
        size = items.value_lengths().to_numpy()
        x, y = np.flatnonzero(block == i[0]), np.flatnonzero(block == j[0])
        edges = []
        for at, one in enumerate(x):
            others = x[at + 1 :] if i[0] == j[0] else y
            others = others[(label[others] != label[one]) & (np.minimum(size[others], size[one]) >= similarity * np.maximum(size[others], size[one]) - 1e-9)]
            same = (marks[others] == marks[one]).sum(1)
            others, same = others[same >= LEAST], same[same >= LEAST]
            # A pair is looked at in the first bucket it shares.
            here = bands[one][(bands[others] == bands[one]).argmax(1)] == bucket
            others, same = others[here], same[here]
            mine = items[one].values.to_numpy() if len(others) else None
            for other in others[np.argsort(-same, kind="stable")]:
                if label[other] != label[one]:
                    common = len(np.intersect1d(mine, items[other].values.to_numpy(), assume_unique=True))
                    if common >= similarity * (size[one] + size[other] - common) - 1e-9:
                        edges.append((rep[one], rep[other]))
                        label[label == label[other]] = label[one]
        a, b = np.array(edges, np.int64).reshape(-1, 2).T
        return pa.table({"a": pa.array(np.ascontiguousarray(a)), "b": pa.array(np.ascontiguousarray(b))})

    return run


def across(large: DataFrame, labels: DataFrame, reps: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """Verified edges (a, b) between members of a large bucket in different classes, enough of them to connect all that are linked.

    large: (bucket, rep), labels: (node, comp) of those with an edge, reps: (rep, bands, marks), items: (doc_id, items)."""
    met = large.join(labels.toDF("rep", "comp"), "rep", "left").select("bucket", "rep", F.coalesce("comp", "rep").alias("comp"))
    met = materialize(met, "minhash-met")
    parts = met.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    parts = parts.groupBy("bucket").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("n")).where("n > top.n")
    parts = parts.select("bucket", F.col("top.comp").alias("main"), F.ceil(F.col("top.n") / BLOCK).alias("mains"), F.ceil((F.col("n") - F.col("top.n")) / BLOCK).alias("others"))
    met = met.join(materialize(parts, "minhash-classes-met"), "bucket")
    dealt = F.xxhash64("rep")
    met = met.withColumn("block", F.expr("if(comp = main, others, 0)") + F.when(F.col("comp") == F.col("main"), F.pmod(dealt, F.col("mains"))).otherwise(F.pmod(dealt, F.col("others"))))
    met = met.withColumn("_with", F.explode(F.expr("sequence(0L, if(comp = main, others, others + mains) - 1)")))
    met = met.select("bucket", F.least("block", "_with").alias("i"), F.greatest("block", "_with").alias("j"), "block", "rep", "comp")
    full = materialize(reps.select("rep", "bands", "marks").join(items.toDF("rep", "items"), "rep"), "minhash-full")
    met = met.join(full.join(large.select("rep").distinct(), "rep", "left_semi"), "rep")
    return materialize(met.groupBy("bucket", "i", "j").applyInArrow(_crossing(similarity), "a bigint, b bigint"), "minhash-across")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id``, ``class_id`` (the smallest doc_id of the class) for every row."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    signed = materialize(texts.mapInArrow(_sign, "doc_id bigint, digest string, bands array<bigint>, marks binary"), "minhash-signed")
    known = signed.where("doc_id is not null and digest is not null")
    reps = known.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("marks").alias("marks"))
    reps = materialize(reps, "minhash-reps")
    marks = materialize(reps.groupBy("rep").agg(F.first("marks").alias("marks")), "minhash-marks")
    pairs, large = candidates(reps)
    pairs, large = materialize(pairs, "minhash-pairs"), materialize(large, "minhash-large-members")
    likely = promising(pairs, marks)
    ids = likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).union(large.select("rep")).distinct()
    # ids grow with the input: the join is a shuffle at every size, not a broadcast at small ones.
    items = texts.where("doc_id is not null").join(ids.hint("merge"), "doc_id", "left_semi").mapInArrow(_elements, "doc_id bigint, items array<bigint>")
    items = materialize(items, "minhash-items")

    best = likely.groupBy("b").agg(F.max(F.struct("same", (-F.col("a")).alias("a"))).alias("m")).select((-F.col("m.a")).alias("a"), "b")
    best = materialize(best, "minhash-best")
    edges = verified(best, items, similarity)
    labels = components(edges)
    rest = likely.select("a", "b").join(best, ["a", "b"], "left_anti").join(labels.toDF("a", "_ca"), "a", "left").join(labels.toDF("b", "_cb"), "b", "left")
    rest = materialize(rest.where(F.coalesce("_ca", "a") != F.coalesce("_cb", "b")).select("a", "b"), "minhash-rest")
    edges = edges.union(verified(rest, items, similarity))
    labels = components(edges)
    labels = components(edges.union(across(large, labels, reps, items, similarity)))
    rep_class = reps.select("digest", "rep").join(labels.toDF("rep", "comp"), "rep", "left")
    rep_class = materialize(rep_class.groupBy("digest").agg(F.min(F.coalesce("comp", "rep")).alias("class_id")), "minhash-classes")
    out = signed.select("doc_id", "digest").join(rep_class, "digest", "left")
    return out.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id and class_id."""
    return classes(table(spark, sf_dir, "documents"))


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its class, one row per doc_id; rows without doc_id stay."""
    keep = classes(docs, id_col, text_col).where("doc_id = class_id").select(F.col("doc_id").alias(id_col)).distinct()
    kept = docs.where(F.col(id_col).isNotNull()).join(keep, id_col, "left_semi").dropDuplicates([id_col])
    return kept.unionByName(docs.where(F.col(id_col).isNull()))
