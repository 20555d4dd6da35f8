"""Token ids in word-aligned files: Simple-8b words, blocks, per-block offsets.

A 64-bit word holds a selector (its four high bits) and as many values as fit
with the selector's width. Selector 0 is the escape: its payload is the place,
in the block's table of escapes, of a value that needs more than 60 bits.

A file holds, in this order: a magic number; blocks of ``BLOCK`` ids; a footer
with the symbols (the ids of the file by falling frequency; the blocks hold
ranks in this list, so that frequent ids take few bits), the doc_ids as
differences, the number of ids of each document, and the offset of each block;
the footer's offset; the magic number. Every part is coded with the same words.
Blocks are decoded by themselves, one vectorised step per selector.

The query writes files in ascending doc_id order: documents are dealt by ranges
of (doc_id, hash of the text), sorted, encoded and written by the task that has
the range. Texts are cut at ASCII white space, which the pre-tokenizer drops;
one closing mark behind a letter or digit is a word of its own, as it is for
the pre-tokenizer; a worker remembers the ids of the words that it has met.
Files are named by the manifest, which only holds files of committed tasks.

Defined cases: a null text is empty and has the end id alone; null doc_ids come
first; rows with equal doc_ids follow each other in the order of their texts'
hashes, repeated rows are all kept; other columns are ignored, whatever their
names; an empty table gives no file and no row; a text of any length is encoded
whole and lies in one file.
"""

from __future__ import annotations

import uuid
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelake.llm.bpe import load_tokenizer
from pricelake.llm.common import materialize, pieces, scratch_path, shuffle_partitions, table
from pricelake.llm.warc import _make, _open

#: Values of a word and their width in bits, by selector; selector 0 is the escape.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])

MAGIC = b"s8b-ids1"
BLOCK = 1 << 16
FILE_IDS = 8 << 20
TASK_BYTES = 64 << 20
SLICE_BYTES = 8 << 20
MEMO_WORDS = 2_000_000
END_ID = 2


def _least_selector(values: np.ndarray) -> np.ndarray:
    """The selector of the smallest width that holds each value; 16 for an escape."""
    limits = np.array([(1 << int(w)) - 1 for w in WIDTHS[1:]], np.uint64)
    return (np.searchsorted(limits, values, side="left") + 1).astype(np.uint8)


def _longest(least: np.ndarray) -> np.ndarray:
    """For every place, the selector that takes most values from there on (values beyond the end are zeros)."""
    n = len(least)
    pad = np.concatenate([least, np.ones(int(COUNTS.max()), np.uint8)])
    powers, step = {1: pad}, 1
    while 2 * step <= COUNTS.max():
        last = powers[step]
        powers[2 * step] = np.maximum(last[: len(last) - step], last[step:])
        step *= 2
    best = np.where(least > 15, 0, 15).astype(np.uint8)
    for s in range(14, 0, -1):
        count = int(COUNTS[s])
        p = 1 << (count.bit_length() - 1)
        most = np.maximum(powers[p][:n], powers[p][count - p : count - p + n])
        best[most <= s] = s
    return best


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, escapes) of unsigned 64-bit values."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    best = _longest(_least_selector(values))
    jump = COUNTS[best].astype(np.uint8).tobytes()
    at, starts = 0, []
    while at < n:
        starts.append(at)
        at += jump[at]
    starts = np.array(starts, np.int64)
    selectors = best[starts]
    words = selectors.astype(np.uint64) << np.uint64(60)
    escaped = np.flatnonzero(selectors == 0)
    words[escaped] |= np.arange(len(escaped), dtype=np.uint64)
    padded = np.concatenate([values, np.zeros(int(COUNTS.max()), np.uint64)])
    for s in range(2, 16):
        if (mine := np.flatnonzero(selectors == s)).size:
            total, first = np.zeros(len(mine), np.uint64), starts[mine]
            for k in range(int(COUNTS[s])):
                total |= padded[first + k] << np.uint64(k * int(WIDTHS[s]))
            words[mine] |= total
    return words, values[starts[escaped]]


def unpack(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` values of the words."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selectors]
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    payload = words & np.uint64((1 << 60) - 1)
    for s in range(2, 16):
        if (mine := np.flatnonzero(selectors == s)).size:
            mask, first, got = np.uint64((1 << int(WIDTHS[s])) - 1), starts[mine], payload[mine]
            for k in range(int(COUNTS[s])):
                out[first + k] = (got >> np.uint64(k * int(WIDTHS[s]))) & mask
    escaped = np.flatnonzero(selectors == 0)
    out[starts[escaped]] = escapes[payload[escaped].astype(np.int64)]
    return out[:n]


def to_bytes(values: np.ndarray) -> bytes:
    """Numbers of values, words and escapes, then the words and the escapes."""
    words, escapes = pack(values)
    head = np.array([len(values), len(words), len(escapes)], "<u8")
    return b"".join([head.tobytes(), words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes()])


def from_bytes(data, at: int = 0) -> tuple[np.ndarray, int]:
    """The values that begin at a byte, and the byte behind them."""
    n, n_words, n_escapes = (int(x) for x in np.frombuffer(data, "<u8", 3, at))
    words = np.frombuffer(data, "<u8", n_words, at + 24)
    end = at + 24 + 8 * (n_words + n_escapes)
    return unpack(words, np.frombuffer(data, "<u8", n_escapes, at + 24 + 8 * n_words), n), end


def write_file(out, doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> None:
    """Writes the documents' ids to a stream."""
    counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    symbols = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
    rank = np.zeros(len(counts), np.uint64)
    rank[symbols] = np.arange(len(symbols), dtype=np.uint64)
    out.write(MAGIC)
    offset, offsets = len(MAGIC), []
    for a in range(0, len(ids), block):
        data = to_bytes(rank[ids[a : a + block]])
        out.write(data)
        offsets.append(offset)
        offset += len(data)
    known = np.array([0 if d is None else d for d in doc_ids], np.int64)
    parts = (np.array([d is None for d in doc_ids]), np.diff(known.astype(np.uint64), prepend=np.uint64(0)), sizes, symbols, np.diff(np.array(offsets, np.uint64), prepend=np.uint64(0)), [block])
    out.write(b"".join(to_bytes(np.asarray(p).astype(np.uint64)) for p in parts) + np.array([offset], "<u8").tobytes() + MAGIC)


class IdFile:
    """A file of ids, opened for reading."""

    def __init__(self, f, size: int):
        self.f = f
        tail = f.read_at(16, size - 16)
        if tail[8:] != MAGIC or f.read_at(8, 0) != MAGIC:
            raise ValueError("no file of packed ids")
        self.end = int(np.frombuffer(tail, "<u8", 1)[0])
        footer, at, parts = f.read_at(size - 16 - self.end, self.end), 0, []
        for _ in range(6):
            part, at = from_bytes(footer, at)
            parts.append(part)
        self.nulls, known, sizes, symbols, offsets, block = parts
        self.doc_ids = np.cumsum(known, dtype=np.uint64).astype(np.int64)
        self.sizes, self.symbols, self.block = sizes.astype(np.int64), symbols.astype(np.int64), int(block[0])
        self.offsets = np.append(np.cumsum(offsets, dtype=np.uint64).astype(np.int64), self.end)

    def block_ids(self, k: int) -> np.ndarray:
        data = self.f.read_at(int(self.offsets[k + 1] - self.offsets[k]), int(self.offsets[k]))
        return self.symbols[from_bytes(data)[0].astype(np.int64)]

    def documents(self):
        """(doc_id, start in the file, ids) of each document; one block is held at a time besides the document's own ids."""
        held, k, start = np.zeros(0, np.int64), 0, 0
        for null, doc, n in zip(self.nulls.tolist(), self.doc_ids.tolist(), self.sizes.tolist()):
            if len(held) < n:
                more, have = [held], len(held)
                while have < n:
                    more.append(self.block_ids(k))
                    have, k = have + len(more[-1]), k + 1
                held = np.concatenate(more)
            yield (None if null else doc), start, held[:n]
            held, start = held[n:], start + n


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_MARKS = ".,;:!?"


class _Words:
    """The ids of words that were met, as one flat array; ``number`` gives the words' places in it. The closing marks come first."""

    def __init__(self, path: str):
        self.tok = load_tokenizer(path)
        self.clear()

    def clear(self) -> None:
        self.known, self.size, self.ids = pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self._add(pa.array(list(_MARKS)))

    def _add(self, new: pa.Array) -> None:
        got = [e.ids for a in range(0, len(new), 20_000) for e in self.tok.encode_batch_fast(new[a : a + 20_000].to_pylist(), add_special_tokens=False)]
        self.size = np.append(self.size, np.fromiter(map(len, got), np.int32, len(got)))
        self.ids = np.append(self.ids, np.fromiter(chain.from_iterable(got), np.int32))
        self.known = pa.concat_arrays([self.known, new])

    def number(self, words: pa.Array) -> np.ndarray:
        """The number of each (distinct) word; unknown ones are encoded."""
        if len(self.known) > MEMO_WORDS:
            self.clear()
        found = pc.index_in(words, value_set=self.known)
        missing, out = found.is_null().to_numpy(zero_copy_only=False), pc.fill_null(found, 0).to_numpy(zero_copy_only=False).astype(np.int32)
        if missing.any():
            out[missing] = np.arange(len(self.known), len(self.known) + np.count_nonzero(missing))
            self._add(words.filter(pa.array(missing)))
        return out


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ...; all below 2 ** 31."""
    ends = np.cumsum(size, dtype=np.int32)
    return np.repeat((start - (ends - size)).astype(np.int32), size) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)


_CLOSING = np.zeros(256, bool)
_CLOSING[list(_MARKS.encode())] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")] = True
_MARK_NUMBER = np.zeros(256, np.int32)
_MARK_NUMBER[list(_MARKS.encode())] = np.arange(len(_MARKS))
_KNOWN: dict[str, _Words] = {}


def encode_texts(texts: pa.Array, words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """(ids, number of ids of each text) of texts without nulls."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.string()))
    coded = lists.flatten().dictionary_encode()
    distinct = coded.dictionary
    if not len(distinct):
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    # "word," is "word" and ",": what closes a word is encoded apart, so that fewer words differ.
    raw = np.frombuffer(distinct.buffers()[2] or b"\0", np.uint8)
    ends = np.frombuffer(distinct.buffers()[1], np.int32)[distinct.offset : distinct.offset + len(distinct) + 1].astype(np.int64)
    long = np.diff(ends) >= 2
    last = raw[np.maximum(ends[1:] - 1, 0)] if len(raw) else np.zeros(len(distinct), np.uint8)
    closed = long & _CLOSING[last] & _ALNUM[raw[np.maximum(ends[1:] - 2, 0)]]
    core = pc.if_else(pa.array(closed), pc.utf8_slice_codeunits(distinct, 0, -1), distinct)
    core = pc.if_else(pc.match_substring(core, "<|"), core, pc.ascii_lower(core))  # special tokens are told by their case
    cores = core.dictionary_encode()
    core_of = words.number(cores.dictionary)[cores.indices.to_numpy(zero_copy_only=False)]
    # The ids of each distinct word, then those of each occurrence.
    start = np.cumsum(words.size, dtype=np.int64) - words.size
    pair = np.stack([core_of, _MARK_NUMBER[last]], axis=1)
    size = words.size[pair]
    size[~closed, 1] = 0
    pool = words.ids[_ranges(start[pair].ravel(), size.ravel())]
    size = size.sum(axis=1, dtype=np.int32)
    at = coded.indices.to_numpy(zero_copy_only=False)
    taken = size[at]
    ids = pool[_ranges((np.cumsum(size, dtype=np.int32) - size)[at], taken)]
    ends = lists.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    total = np.concatenate([[0], np.cumsum(taken, dtype=np.int64)])
    return ids, total[ends[1:]] - total[ends[:-1]]


def _slices(batch: pa.RecordBatch, most: int):
    """Parts of a batch whose texts (column 2) have about ``most`` bytes together."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(batch):
        b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + most, side="right")))
        yield batch.slice(a, b - a)
        a = b


_MANIFEST = "task string, first_id bigint, first_key bigint, seq int, file string, n_docs bigint, n_ids bigint"


def _write(batches, folder: str, path: str, end_id: int, block: int, file_ids: int):
    """Writes the task's documents, which come sorted, to files in their order; gives a manifest row per file."""
    fs, where = _open(folder)
    if path not in _KNOWN:
        _KNOWN[path] = _Words(path)
    words = _KNOWN[path]
    task, first, seq = uuid.uuid4().hex, None, 0
    docs, sizes, ids, held = [], [], [], 0

    def flush():
        name = f"{task}-{seq:06d}.s8b"
        flat, size = np.concatenate(ids), np.concatenate(sizes)
        with fs.open_output_stream(f"{where}/{name}", compression=None) as out:
            write_file(out, docs, size, flat, block)
        row = [task, *first, seq, f"{folder}/{name}", len(docs), len(flat)]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=[c.split()[0] for c in _MANIFEST.split(", ")])

    for batch in batches:
        for part in _slices(batch, SLICE_BYTES):
            first = first or (part.column(0)[0].as_py(), part.column(1)[0].as_py())
            flat, size = encode_texts(pc.fill_null(part.column(2), ""), words)
            ids.append(np.insert(flat, np.cumsum(size), end_id))
            sizes.append(size + 1)
            docs += part.column(0).to_pylist()
            held += len(ids[-1])
            if held >= file_ids:
                yield flush()
                docs, sizes, ids, held, seq = [], [], [], 0, seq + 1
    if docs:
        yield flush()


def write_ids(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the ids of all documents in ascending doc_id order into files of the shared ``folder``.

    Returns the manifest, a written table: file, n_docs, n_ids and ``base``,
    the number of ids in all files before it."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "ids")
    _make(folder)
    path = tokenizer or default_tokenizer()
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = rows.repartitionByRange(pieces(total, TASK_BYTES, shuffle_partitions(spark)), "doc_id", "key").sortWithinPartitions("doc_id", "key")
    files = materialize(rows.mapInArrow(lambda batches: _write(batches, folder, path, end_id, block, file_ids), _MANIFEST), "ids-manifest")
    # Ids before a file: those of the tasks before (a row per task), then those of the task's own files before.
    tasks = files.groupBy("task", "first_id", "first_key").agg(F.sum("n_ids").alias("n"))
    order = Window.orderBy("first_id", "first_key").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("task", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    own = Window.partitionBy("task").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    based = files.join(tasks, "task").select("file", "n_docs", "n_ids", (F.col("before") + F.coalesce(F.sum("n_ids").over(own), F.lit(0))).alias("base"))
    return materialize(based, "ids-files")


_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int64()))])


def _read(batches, ids: bool):
    schema = pa.schema(list(_READ)[: 5 if ids else 4])
    for batch in batches:
        for uri, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            fs, path = _open(uri)
            with fs.open_input_file(path) as f:
                rows, held = [], 0
                for doc, start, got in IdFile(f, f.size()).documents():
                    rows.append((doc, base + start, len(got), zlib.crc32(got.astype("<u4").tobytes()), *([got] if ids else [])))
                    held += len(got) if ids else 1
                    if held >= 1 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


def read_ids(manifest: DataFrame, ids: bool = False) -> DataFrame:
    """Reads the files of a manifest: doc_id, start, n_tokens, ids_crc32 and, if asked for, the ids of each document."""
    # Tasks by the ids to read: AQE would size them by the manifest's rows, which are small.
    total = manifest.agg(F.sum("n_ids")).first()[0] or 0
    files = manifest.select("file", "base").repartition(pieces(total, 4 * FILE_IDS, shuffle_partitions(manifest.sparkSession)), "file")
    return files.mapInArrow(lambda b: _read(b, ids), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * ids)


def op11_simple8b_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, read back from the files: doc_id, start, n_tokens and ids_crc32."""
    return read_ids(write_ids(table(spark, sf_dir, "documents")))
