"""Byte-level BPE encoding and decoding through a distinct-word table.

Encoding. Texts are cut in front of every space that a non-space character
follows. The pre-tokenizer always has a boundary there, and both sides are
tokenized as they would be alone, so these *words* can be encoded one by one:

1. every task deals its documents into blocks of about ``block_chars``
   characters and writes, for each block, the distinct words (dealt into
   buckets by a hash of the word) and the word numbers of each document;
2. each bucket gathers the words of all blocks and encodes each distinct word
   once, then answers every block with the ids of its words;
3. the answers meet the blocks again (the block table is bucketed by block, so
   it is not shuffled) and the ids are put back by position.

A hot word costs one entry per block, not one per occurrence, so no key is
hot. Decoding joins each id with its piece (a broadcast table, bounded by the
vocabulary) and reads the joined bytes as UTF-8.

Defined cases: a null text counts as empty and has no ids; repeated rows and
null doc_ids are kept as they are, row by row; other columns of the input are
ignored, whatever their names; an empty table gives an empty result; a text of
any length is encoded whole (one that exceeds a block makes its own block).
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import fresh, pack, pieces, scratch_path, shuffle_partitions, squeeze, table, unpack, unsqueeze

BLOCK_CHARS = 12_000_000
BUCKET_CHARS = 8_000_000
MOST_FILES = 20_000  # a bucketed table has 100,000 buckets at most

# A space is no cut where white space (or a character that some engines count as such) follows, or the text ends.
_KEEP = re.compile("[ ](?=[\\s\u180e\u200b\ufeff]|$)")
_CUT = re.compile("(?=[ ][^\\s\u180e\u200b\ufeff])")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def special_strings(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        return [t["content"] for t in json.load(f)["added_tokens"]]


def cut_words(text: str, specials: re.Pattern | None) -> list[str]:
    """The words of a text; they join to the text again."""
    if specials is not None and specials.search(text):
        return [w for part in specials.split(text) if part for w in ([part] if specials.fullmatch(part) else _cut(part))]
    return _cut(text)


def _cut(text: str) -> list[str]:
    if _KEEP.search(text):
        return [w for w in _CUT.split(text) if w]
    head, *rest = text.split(" ")
    words = [" " + w for w in rest]
    return [head, *words] if head else words


# Where a text is cut in the ordinary way, at every space: no space before white space or at the end.
_ODD = "[ ](?:[\\x{09}-\\x{0d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200b}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]|$)"

_BLOCK = "block string, ids array<bigint>, lens binary, seq binary, words array<struct<bucket:int,text:binary>>, codes array<struct<bucket:int,codes:binary>>"
_BLOCK_SCHEMA = pa.schema([("block", pa.string()), ("ids", pa.list_(pa.int64())), ("lens", pa.binary()), ("seq", pa.binary()), ("words", pa.list_(pa.struct([("bucket", pa.int32()), ("text", pa.binary())]))), ("codes", pa.list_(pa.struct([("bucket", pa.int32()), ("codes", pa.binary())])))])


def _distinct_words(texts: pa.Array, special: re.Pattern | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(order of the texts, words per text, word numbers, distinct words): the texts cut at spaces, then the odd ones cut one by one."""
    odd = pc.match_substring_regex(texts, _ODD)
    if special is not None:
        odd = pc.or_(odd, pc.match_substring_regex(texts, special.pattern))
    odd = odd.to_numpy(zero_copy_only=False)
    plain = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
    parts = plain.flatten().dictionary_encode()
    at = plain.offsets.to_numpy().astype(np.int64)
    codes = 2 * parts.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1  # a part behind a space
    if len(codes):
        codes[at[:-1] - at[0]] -= 1  # the first of a text
    used, codes = np.unique(codes, return_inverse=True)
    words = [pc.binary_join_element_wise(pa.array(np.array(["", " "], object)[used % 2], pa.string()), parts.dictionary.take(pa.array(used // 2)), "")] if len(used) else []
    cut = [cut_words(t.as_py(), special) for t in texts.filter(pa.array(odd))]
    rest = pa.array([w for x in cut for w in x], pa.string()).dictionary_encode()
    codes = np.concatenate([codes, rest.indices.to_numpy(zero_copy_only=False) + len(used)])
    order = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
    return order, np.concatenate([np.diff(at), np.fromiter(map(len, cut), np.int64, len(cut))]), codes, pa.concat_arrays([*words, rest.dictionary])


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, ends) of an array of strings that is no slice."""
    ends = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1).astype(np.int64) if len(words) else np.zeros(1, np.int64)
    data = words.buffers()[2] if len(words) else None
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), ends


def _flush(ids: list, texts: pa.Array, special: re.Pattern | None, buckets: int) -> pa.RecordBatch:
    """The row of one block: its documents as word numbers, its distinct words by bucket (of those that have any)."""
    order, lens, flat, words = _distinct_words(texts, special)
    rank = np.empty(len(words), np.uint32)
    rank[np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")] = np.arange(len(words), dtype=np.uint32)
    of = np.zeros(len(words), np.uint32)
    for a in range(0, len(words), 50_000):
        part = words[a : a + 50_000]
        of[a : a + len(part)] = np.fromiter((zlib.crc32(w.encode("utf-8")) for w in part.to_pylist()), np.uint32, len(part))
    of %= buckets
    by = np.lexsort((rank, of))
    data, ends = _bytes_of(pa.concat_arrays([words.take(pa.array(by))]))
    mine, first = np.unique(of[by], return_index=True)
    out, places = [], []
    for bucket, a, b in zip(mine.tolist(), first, [*first[1:], len(by)]):
        sizes = pack(np.diff(ends[a : b + 1]))
        places.append({"bucket": bucket, "codes": pack(np.diff(rank[by[a:b]].astype(np.int64), prepend=0))})
        out.append({"bucket": bucket, "text": len(sizes).to_bytes(4, "little") + sizes + squeeze(data[ends[a] : ends[b]].tobytes())})
    row = {"block": uuid.uuid4().hex, "ids": [ids[i] for i in order], "lens": pack(lens), "seq": pack(rank[flat]), "words": out, "codes": places}
    return pa.RecordBatch.from_pylist([row], schema=_BLOCK_SCHEMA)


def _blocks(batches, specials: list[str], buckets: int, block_chars: int):
    """One row per block of whole documents of about ``block_chars`` bytes."""
    special = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None
    ids, texts, held = [], [], 0
    for batch in batches:
        column = pc.fill_null(batch.column(1).cast(pa.string()), "")
        size = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
        a = 0
        while a < len(batch):
            b = min(len(batch), max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + block_chars - held)) + 1))
            ids += batch.column(0).slice(a, b - a).to_pylist()
            texts.append(column.slice(a, b - a))
            held += int(size[b - 1] - (size[a - 1] if a else 0))
            a = b
            if held >= block_chars:
                yield _flush(ids, pa.concat_arrays(texts), special, buckets)
                ids, texts, held = [], [], 0
    if ids:
        yield _flush(ids, pa.concat_arrays(texts), special, buckets)


def _unpack_words(data: bytes) -> pa.Array:
    n = int.from_bytes(data[:4], "little")
    ends = np.concatenate([[0], np.cumsum(unpack(data[4 : 4 + n]))]).astype(np.int32)
    return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(unsqueeze(data[4 + n :])))


_TOKENIZERS: dict = {}


def _tokenizer(path: str):
    """The tokenizer, loaded once per worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = load_tokenizer(path)
    return _TOKENIZERS[path]


_ANSWER = pa.schema([("block", pa.string()), ("bucket", pa.int32()), ("n", pa.binary()), ("tokens", pa.binary())])


def _answers(batches, path: str):
    """Rows (block, bucket, text) come sorted by bucket: every distinct word of a bucket is encoded once, and each block gets the ids of its words."""
    tok = _tokenizer(path)

    def encode(bucket: int, names: list[str], asked: list[pa.Array]):
        coded = pa.concat_arrays(asked).dictionary_encode()
        lens, flat = [], []
        for a in range(0, len(coded.dictionary), 10_000):
            for e in tok.encode_batch_fast(coded.dictionary[a : a + 10_000].to_pylist(), add_special_tokens=False):
                got = e.ids
                lens.append(len(got))
                flat.append(got)
        size = np.array(lens, np.int64)
        ids, start = np.fromiter(chain.from_iterable(flat), np.uint32, int(size.sum())), np.cumsum(size) - size
        which, at = coded.indices.to_numpy(zero_copy_only=False), 0
        for name, words in zip(names, asked):
            w = which[at : at + len(words)]
            at += len(words)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([bucket], pa.int32()), pa.array([pack(size[w])], pa.binary()), pa.array([pack(ids[_spans(start[w], size[w])])], pa.binary())], schema=_ANSWER)

    bucket, names, asked = None, [], []
    for batch in batches:
        for name, b, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if b != bucket and names:
                yield from encode(bucket, names, asked)
                names, asked = [], []
            bucket = b
            names.append(name)
            asked.append(_unpack_words(text.as_py()))
    if names:
        yield from encode(bucket, names, asked)


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    total = int(size.sum())
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(total)


_PLACED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
_AT_ONCE = 1 << 20


def _place(blocks: pa.Table, answers: pa.Table, texts_of=None) -> pa.Table:
    """Puts the ids of each word back at the positions of the word; texts_of, if given, decodes the lists of ids."""
    schema = pa.schema(list(_PLACED)[: 2 if texts_of is None else 3])
    if not len(blocks):
        return schema.empty_table()
    of = {c["bucket"]: c["codes"] for c in blocks.column("codes")[0].as_py()}
    order = answers.column("bucket").to_pylist()
    codes = [np.cumsum(unpack(of[b]), dtype=np.uint32) for b in order]
    n = sum(map(len, codes))
    size, start = np.zeros(n, np.int32), np.zeros(n, np.int64)
    pool, base = [], 0
    for c, s, t in zip(codes, answers.column("n"), answers.column("tokens")):
        s, t = unpack(s.as_py()).astype(np.int32), unpack(t.as_py()).astype(np.int32)
        size[c], start[c] = s, base + np.cumsum(s) - s
        base += len(t)
        pool.append(t)
    pool = np.concatenate(pool) if pool else np.zeros(0, np.int32)
    seq, lens = unpack(blocks.column("seq")[0].as_py()), unpack(blocks.column("lens")[0].as_py()).astype(np.int64)
    ids, ends = blocks.column("ids")[0].values, np.cumsum(lens)
    out, a = [], 0
    while a < len(lens):  # so many documents at once that their words are about _AT_ONCE
        first = int(ends[a] - lens[a])
        b = max(a + 1, int(np.searchsorted(ends, first + _AT_ONCE, side="right")))
        at = seq[first : int(ends[b - 1])]
        taken = size[at]
        total = np.concatenate([[0], np.cumsum(taken, dtype=np.int64)])
        flat, cuts = pool[_spans(start[at], taken)], total[np.concatenate([[0], ends[a:b] - first])]
        columns = [ids.slice(a, b - a), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat))]
        if texts_of is not None:
            columns.append(pa.array([texts_of(flat[i:j]) for i, j in zip(cuts[:-1], cuts[1:])], pa.string()))
        out.append(pa.RecordBatch.from_arrays(columns, schema=schema))
        a = b
    return pa.Table.from_batches(out, schema)


def encode(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS, decoded: bool = False) -> DataFrame:
    """``doc_id``, ``ids`` (array of int) of every row of ``docs``; with ``decoded`` also the text that ``decode`` gives, made in the same tasks."""
    spark = docs.sparkSession
    path = tokenizer or default_tokenizer()
    specials = special_strings(path)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    chars = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = pieces(chars, BUCKET_CHARS, shuffle_partitions(spark))
    files = min(buckets, MOST_FILES)
    name = fresh("bpe_blocks")
    (
        rows.mapInArrow(lambda batches: _blocks(batches, specials, buckets, block_chars), _BLOCK)
        .write.bucketBy(files, "block")
        .option("path", scratch_path(spark, name))
        .saveAsTable(name)
    )
    blocks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # out of the catalog; the files stay, and the frame has been resolved
    asked = blocks.select("block", F.explode("words").alias("w")).select("block", "w.bucket", "w.text")
    asked = asked.repartition(files, "bucket").sortWithinPartitions("bucket")
    answers = asked.mapInArrow(lambda batches: _answers(batches, path), "block string, bucket int, n binary, tokens binary")
    met = blocks.select("block", "ids", "lens", "seq", "codes").groupBy("block").cogroup(answers.groupBy("block"))
    if not decoded:
        return met.applyInArrow(lambda a, b: _place(a, b), "doc_id bigint, ids array<int>")
    shared = _shared_pieces(spark, path)
    return met.applyInArrow(lambda a, b: _place(a, b, lambda ids: _text_of(ids, *shared.value)), "doc_id bigint, ids array<int>, decoded string")


def _shared_pieces(spark: SparkSession, tokenizer: str):
    """The id-to-piece table as (bytes of all pieces, their start, their size), broadcast: it is as large as the vocabulary at most."""
    table_of = piece_table(tokenizer)
    size = np.array([len(p or b"") for p in table_of], np.int64)
    return spark.sparkContext.broadcast((np.frombuffer(b"".join(p or b"" for p in table_of), np.uint8), np.cumsum(size) - size, size))


def _text_of(ids: np.ndarray, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> str:
    """The join of ids with their pieces, read as UTF-8."""
    got = ids[(ids >= 0) & (ids < len(size))]
    parts = [raw[_spans(start[x], size[x])].tobytes() for x in (got[a : a + 200_000] for a in range(0, len(got), 200_000))]
    return b"".join(parts).decode("utf-8", "replace")


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE: printable Latin-1 stands for itself, the rest for 256 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


def piece_table(tokenizer: str) -> list[bytes | None]:
    """The bytes of each id; its length is that of the vocabulary."""
    with open(tokenizer, encoding="utf-8") as f:
        spec = json.load(f)
    chars = _byte_of_char()
    vocab = dict(spec["model"]["vocab"]) | {t["content"]: t["id"] for t in spec["added_tokens"]}
    out: list[bytes | None] = [None] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        out[i] = bytes(chars[c] for c in piece) if all(c in chars for c in piece) else piece.encode("utf-8")
    return out


def decode(encoded: DataFrame, tokenizer: str | None = None, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """Adds the decoded text. Ids outside the vocabulary and null ids are skipped, bytes that are no UTF-8 become U+FFFD, null lists give an empty text."""
    shared = _shared_pieces(encoded.sparkSession, tokenizer or default_tokenizer())
    names = encoded.columns
    at = names.index(ids_col)

    def run(batches):
        for batch in batches:
            texts = []
            for ids in batch.column(at):
                values = ids.values
                got = np.zeros(0, np.int64) if values is None else (values.drop_null() if values.null_count else values).to_numpy(zero_copy_only=False).astype(np.int64)
                texts.append(_text_of(got, *shared.value))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, to])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields), f"`{to}` string"])
    return encoded.mapInArrow(run, schema)


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 and decoded_sha256."""
    done = encode(table(spark, sf_dir, "documents"), decoded=True)
    return done.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
