"""Benchmark decontamination by template canonicalisation.

Words that an exam writer would vary become typed placeholders: ``<num>`` for
tokens with digits or a number word, ``<unit>`` for units of measure and
currencies, ``<name>`` for capitalised words inside a sentence (a run of names
is one placeholder). Capitalised words that open a sentence may be names or
not: a window that holds one is also taken in a second form, in which it is a
name and joins the names beside it. The rest is lower-cased without
punctuation. Documents and benchmark items are cut into windows of five
template tokens; windows of placeholders alone say nothing about a template and
take no part.

The windows are joined by hash, whatever their forms: a filter of fixed size,
built from the benchmark's windows, lets through every document window that can
match. A leak covers ``COVERAGE`` of an item's windows, so it holds one of any
(1 - COVERAGE) n + 1 of them: the join first takes the windows of each item that
the fewest items share, and only the (document, item) pairs found there meet
with all windows of the item. So a window that many items share pairs no
document with all of them.

Matches of a (document, item) pair are grouped by diagonal (the item's token
numbers run along with the document's). Along a diagonal an item's slot value
stands for one value of the document, the one that most windows agree on; a
window with another value there does not count. A pair is reported if the
item's windows that are left, over all diagonals, are at least ``COVERAGE`` of
its windows; ``slots`` counts the slot values of its best diagonal, ``changed``
those with another value in the document (0: copied word for word).

Defined cases: null and empty texts have no window; an item with fewer than
five template tokens is one window; an item all of whose windows are
placeholders is matched by its literal words instead; items without item_id
are ignored, of several texts with one item_id the smallest counts; repeated
rows of one doc_id are taken together; rows without doc_id cannot be named, so
they are never reported; other columns are ignored; very long texts are taken
whole; empty tables give no row.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelake.llm.common import materialize, table
from pricelake.llm.words import _ODD, gram_hashes, mix

WINDOW = 5
COVERAGE = 0.8
#: Bits of the filter of benchmark windows (2 MB, whatever the benchmark's size).
FILTER_BITS = 1 << 24

# Number words and units that become placeholders.
NUMBER_WORDS = frozenset("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split())
UNITS = frozenset("mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years mph kmh dollar dollars euro euros cent cents usd eur gbp percent degree degrees celsius fahrenheit volt volts watt watts joule joules newton newtons hz khz mhz".split())
SYMBOL_UNITS = "$€£%°"

NUM, UNIT, NAME = 1, 2, 3
_STRIP = re.compile(r"^\W+|\W+$")
_DIGIT = re.compile(r"\d")
_END = re.compile(r"[.!?:]\W*$")


_MEMO = 300_000
_CLOSING = ".,;:!?"


def kind_of(chunk: str) -> tuple[int, str, bool, bool]:
    """(kind, value, ends a sentence, capitalised) of a piece between white space; kind 0 is an ordinary word, an empty value is punctuation alone."""
    bare = _STRIP.sub("", chunk)
    low = bare.lower()
    mark = chunk.strip(_CLOSING)
    kind = NUM if _DIGIT.search(chunk) or low in NUMBER_WORDS else UNIT if low in UNITS or (not bare and mark and mark in SYMBOL_UNITS) else 0
    capital = kind == 0 and bare[:1].isupper() and not bare.isupper()
    return kind, low if bare else ("" if kind == 0 else chunk), bool(_END.search(chunk)), capital


class Chunks:
    """What is known of each piece of text, by number: kind, value, hash of the value, whether it ends a sentence and is capitalised."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.values: list[str] = []
        self.facts: list[tuple[int, int]] = []  # (hash, kind + flags)

    def __call__(self, chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Values, hashes and facts (kind, 4: has a value, 8: ends, 16: capitalised) of the pieces."""
        if len(self.number) > _MEMO:
            self.clear()
        at = []
        for c in chunks:
            n = self.number.get(c)
            if n is None:
                word = c[:-1] if c[-1:] in _CLOSING else c
                if word.isalpha():  # what most pieces are: letters and at most one closing mark
                    low = word.lower()
                    kind = NUM if low in NUMBER_WORDS else UNIT if low in UNITS else 0
                    got = kind, low, c[-1] in ".!?:", kind == 0 and word[0].isupper() and not word.isupper()
                else:
                    got = kind_of(c)
                self.number[c] = n = len(self.values)
                self.values.append(got[1])
                self.facts.append((xxhash.xxh64_intdigest(got[1].encode("utf-8")), got[0] | 4 * bool(got[1]) | 8 * got[2] | 16 * got[3]))
            at.append(n)
        got = [self.facts[n] for n in at]
        return [self.values[n] for n in at], np.array([g[0] for g in got], np.uint64), np.array([g[1] for g in got], np.uint8)


class Templates:
    """The template tokens of several texts, one after the other.

    ``text`` tells a token's text, ``place`` its number there; ``kind`` and
    ``token`` (its hash in a window), ``opener``: a capitalised word that opens
    a sentence; ``merged``: numbers of the tokens in the second form, where the
    openers are names and runs of names one token."""

    def __init__(self, texts: pa.Array, chunks: Chunks):
        lists = pc.utf8_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
        coded = lists.flatten().dictionary_encode()
        values, hashes, facts = chunks(coded.dictionary.to_pylist())
        at = coded.indices.to_numpy(zero_copy_only=False)
        ends = lists.offsets.to_numpy().astype(np.int64)
        sizes = np.diff(ends)
        fact = facts[at] if len(at) else np.zeros(0, np.uint8)
        ended = np.concatenate([[0], np.cumsum(fact >> 3 & 1, dtype=np.int64)])
        valued = np.flatnonzero(fact >> 2 & 1)
        text = np.repeat(np.arange(len(texts)), sizes)[valued]
        same = np.zeros(len(valued), bool)
        same[1:] = text[1:] == text[:-1]
        start = ~same  # a token opens a sentence if it is the first or one ended since the token before
        start[1:] |= ended[valued[1:]] > ended[valued[:-1]]
        fact = fact[valued]
        kind, capital = fact & 3, fact >> 4 & 1 > 0
        kind = np.where(capital & ~start, NAME, kind)
        run = np.zeros(len(kind), bool)
        run[1:] = same[1:] & (kind[1:] == NAME) & (kind[:-1] == NAME)
        self.first = np.flatnonzero(~run)
        self.values, self.at = values, at[valued]
        self.ends = np.append(self.first[1:], len(kind))
        self.text, self.kind = text[self.first], kind[self.first].astype(np.int64)
        self.opener = (capital & start)[self.first]
        begin = np.searchsorted(self.text, np.arange(len(texts)))
        self.place = np.arange(len(self.text)) - begin[self.text] if len(self.text) else np.zeros(0, np.int64)
        self.word = hashes[self.at[self.first]] if len(self.first) else np.zeros(0, np.uint64)
        self.token = np.where(self.kind > 0, mix(self.kind.astype(np.uint64)), self.word)
        name = self.opener | (self.kind == NAME)
        run = np.zeros(len(name), bool)
        run[1:] = name[1:] & name[:-1] & (self.text[1:] == self.text[:-1])
        self.merged = np.flatnonzero(~run)

    def value(self, i: int, end: int | None = None) -> str:
        """The words of a token, or of the tokens from ``i`` to ``end``."""
        return " ".join(self.values[k] for k in self.at[self.first[i] : self.ends[(i if end is None else end - 1)]])

    def literal(self) -> np.ndarray:
        """The tokens' hashes as words, names with all their words."""
        word = self.word.copy()
        for i in np.flatnonzero(self.ends - self.first > 1):
            word[i] = xxhash.xxh64_intdigest(self.value(i).encode("utf-8"))
        return word

    def windows(self, n: int, tokens: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(first token, hash) of the windows of n tokens inside a text, in the first form (or with other token hashes)."""
        tokens = self.token if tokens is None else tokens
        found = gram_hashes(tokens, n)
        whole = np.flatnonzero(self.text[n - 1 :] == self.text[: len(found)])
        return whole, found[whole]

    def second(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first token, token behind the last, hash) of the windows that hold a sentence opener, in the second form."""
        if len(self.merged) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        last = np.append(self.merged[1:], len(self.kind))
        opened = np.concatenate([[0], np.cumsum(self.opener)])
        has = opened[last] > opened[self.merged]
        kind = np.where(has, NAME, self.kind[self.merged])
        token = np.where(has, mix(np.array([NAME], np.uint64))[0], self.token[self.merged])
        text = self.text[self.merged]
        held = np.concatenate([[0], np.cumsum(has)])
        at = np.flatnonzero((held[n:] > held[:-n]) & (text[n - 1 :] == text[: len(text) - n + 1]))
        out = np.zeros(len(at), np.uint64)
        for j in range(n):
            out *= _ODD
            out += token[at + j]
        self.second_kind = kind
        return at, at + n, mix(out)

    def slots(self, i: int, n: int) -> list[str]:
        """The slot values of a window in the first form."""
        return [f"{self.kind[k]}{self.value(k)}" for k in range(i, i + n) if self.kind[k]]

    def second_slots(self, i: int, n: int) -> list[str]:
        """The slot values of a window in the second form (numbers of merged tokens)."""
        ends = np.append(self.merged[1:], len(self.kind))
        return [f"{self.second_kind[k]}{self.value(self.merged[k], ends[k])}" for k in range(i, i + n) if self.second_kind[k]]


_ITEM = pa.schema([("hash", pa.int64()), ("item_id", pa.int64()), ("ipos", pa.int32()), ("form", pa.int32()), ("n_windows", pa.int32()), ("size", pa.int32()), ("literal", pa.bool_()), ("islots", pa.list_(pa.string()))])


def _signed(h: np.uint64) -> int:
    return int(np.uint64(h).view(np.int64))


def item_windows(texts: list[str | None]) -> list[tuple]:
    """(number of the item, hash, ipos, form, n_windows, size, literal, slots) of the items' windows.

    A window of the second form stands for every window of the first form that
    begins in its first token (more than one if names were joined there)."""
    out, chunks = [], Chunks()
    for item, text in enumerate(texts):
        t = Templates(pa.array([text], pa.string()), chunks)
        size = min(WINDOW, len(t.kind))
        if not size:
            continue
        at, found = t.windows(size)
        plain = np.array([bool((t.kind[i : i + size] == 0).any()) for i in at])
        literal = not plain.any()
        if literal:
            at, found = t.windows(size, t.literal())
            plain[:] = True
        n = int(plain.sum())
        out += [(item, _signed(h), int(i), 0, n, size, literal, t.slots(i, size)) for i, h, ok in zip(at, found, plain) if ok]
        if not literal:
            counted = {int(i) for i, ok in zip(at, plain) if ok}
            ends = np.append(t.merged[1:], len(t.kind))
            for i, j, h in zip(*t.second(size)):
                if (t.second_kind[i:j] == 0).any():
                    out += [(item, _signed(h), int(k), 1, n, size, False, t.second_slots(i, size)) for k in range(t.merged[i], ends[i]) if k in counted]
    return out


def _items(batches):
    for batch in batches:
        ids = batch.column(0).to_pylist()
        rows = [(h, ids[i], *rest) for i, h, *rest in item_windows(batch.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], f.type) for j, f in enumerate(_ITEM)], schema=_ITEM)


_DOC = pa.schema([("hash", pa.int64()), ("form", pa.int32()), ("doc_id", pa.int64()), ("dpos", pa.int32()), ("dslots", pa.list_(pa.string()))])
_SLICE = 4 << 20


def _doc_windows(bits: np.ndarray, sizes: list[int], any_literal: bool):
    """Windows of documents that the filter lets through. sizes: those of the items' windows."""

    def passing(found: np.ndarray) -> np.ndarray:
        slot = (found & np.uint64(FILTER_BITS - 1)).astype(np.int64)
        return np.flatnonzero(bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)

    def rows(ids: list[int], texts: pa.Array, chunks: Chunks):
        t = Templates(texts, chunks)
        for n in sizes:
            plain = [t.windows(n)] + ([t.windows(n, t.literal())] if any_literal else [])
            for at, found in plain:
                for k in passing(found):
                    i = at[k]
                    yield _signed(found[k]), 0, ids[t.text[i]], int(t.place[i]), t.slots(i, n)
            at, _, found = t.second(n)
            for k in passing(found):
                i = t.merged[at[k]]
                yield _signed(found[k]), 1, ids[t.text[i]], int(t.place[i]), t.second_slots(at[k], n)

    def run(batches):
        chunks = Chunks()
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            a = 0
            while a < len(batch):
                b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + _SLICE, side="right")))
                part = batch.slice(a, b - a)
                out = list(rows(part.column(0).to_pylist(), part.column(1), chunks))
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], f.type) for j, f in enumerate(_DOC)], schema=_DOC)
                a = b

    return run


def _names(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "bigint", pa.int32(): "int", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {kinds.get(f.type, 'array<string>')}" for f in schema)


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """(doc_id, item_id, covered, slots, changed) of every leaked item."""
    spark = docs.sparkSession
    items = benchmark.where(F.col(item_col).isNotNull()).groupBy(F.col(item_col).cast("bigint").alias("item_id")).agg(F.min(text_col).alias("text"))
    windows = materialize(items.mapInArrow(_items, _names(_ITEM)), "leak-items")
    # The filter: which of its FILTER_BITS are set, gathered as at most FILTER_BITS / 8 bytes.
    slots = windows.select(F.col("hash").bitwiseAND(F.lit(FILTER_BITS - 1)).cast("int").alias("s")).distinct()
    bytes_of = slots.groupBy(F.shiftright("s", 3).alias("b")).agg(F.expr("bit_or(cast(shiftleft(1, s & 7) as int))").alias("v"))
    bits = np.zeros(FILTER_BITS >> 3, np.uint8)
    got = bytes_of.toPandas()
    bits[got["b"].to_numpy(dtype=np.int64)] = got["v"].to_numpy(dtype=np.int64).astype(np.uint8)
    sizes, literal = windows.agg(F.sort_array(F.collect_set("size")), F.max("literal")).first()  # at most WINDOW sizes
    shared, run = spark.sparkContext.broadcast(bits), _doc_windows
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    passed = materialize(texts.mapInArrow(lambda batches: run(shared.value, sizes, bool(literal))(batches), _names(_DOC)), "leak-windows")

    # Candidates: documents that hold one of the item's rarest windows, of which a leak cannot miss all.
    shared_by = windows.groupBy("hash").agg(F.count_distinct("item_id").alias("items"))
    rarity = windows.join(shared_by, "hash").groupBy("item_id", "ipos").agg(F.max("items").alias("items"), F.max("n_windows").alias("n"))
    order = Window.partitionBy("item_id").orderBy("items", "ipos")
    rare = rarity.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= F.floor(F.lit(1 - coverage + 1e-9) * F.col("n")) + 1)
    rare = windows.join(rare.select("item_id", "ipos"), ["item_id", "ipos"]).select("item_id", "hash").distinct()
    pairs = passed.select("doc_id", "hash").join(rare, "hash").select("doc_id", "item_id").distinct()
    hits = pairs.join(windows, "item_id").join(passed.withColumnRenamed("form", "dform"), ["doc_id", "hash"])
    where = ["doc_id", "item_id", "form", "dform", "diagonal"]
    hits = hits.where(F.size("dslots") == F.size("islots")).select(
        *where[:4], (F.col("dpos") - F.col("ipos")).alias("diagonal"), "ipos", "n_windows", F.arrays_zip(F.col("islots").alias("i"), F.col("dslots").alias("d")).alias("slots")
    )
    hits = materialize(hits.distinct(), "leak-hits")
    # Along a diagonal: of each of the item's slot values, the document's value that most windows agree on.
    votes = hits.select(*where, "ipos", F.explode(F.array_distinct("slots")).alias("s")).groupBy(*where, F.col("s.i").alias("i"), F.col("s.d").alias("d")).agg(F.count("*").alias("votes"))
    stands = votes.groupBy(*where, "i").agg(F.max(F.struct("votes", "d"))["d"].alias("d")).groupBy(*where).agg(F.map_from_entries(F.collect_list(F.struct("i", "d"))).alias("stands"))
    good = hits.join(stands, where, "left").where(F.forall("slots", lambda x: F.element_at("stands", x["i"]) == x["d"]))
    diagonal = good.groupBy(*where).agg(
        F.collect_set("ipos").alias("found"), F.max("n_windows").alias("n"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots")
    )
    # A text with an insertion goes on along another diagonal: the windows found add up.
    whole = diagonal.groupBy("doc_id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("found")))).alias("found"),
        F.max("n").alias("n"),
        F.max(F.struct(F.size("found").alias("found"), F.size("slots").alias("slots"), F.size(F.filter("slots", lambda x: x["i"] != x["d"])).alias("changed"))).alias("best"),
    )
    return whole.where(F.col("found") >= F.lit(coverage) * F.col("n")).select("doc_id", "item_id", (F.col("found") / F.col("n")).alias("covered"), "best.slots", "best.changed")


def op1_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leak: doc_id, item_id, covered, slots, changed."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    bad = leaks(docs, benchmark, id_col=id_col, text_col=text_col).select(F.col("doc_id").alias(id_col)).distinct()
    # Written first, so that the planner knows its size: the texts are shuffled only where the ids are too many to broadcast.
    return docs.join(materialize(bad, "leak-documents"), id_col, "left_anti")
