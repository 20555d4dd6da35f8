"""Token counts per document by a scan of flat token files for separators.

A flat file holds the ids of its documents as little-endian 16-bit integers,
each document followed by the end-of-document id; there is no index. Files are
cut into blocks of ``BLOCK`` ids, wherever documents begin. A task reads its
blocks and finds their separators by one vectorised comparison; a block gives
the place of its first and last separator, their number and the lengths between
them. A prefix scan over the blocks (over groups of ``GROUP`` blocks first, then
inside a group, so no task holds more than a group) carries the last separator
before each block and the number of separators so far, which stitches the
documents that cross block boundaries, however many they cross.

Defined cases: two separators in a row are an empty document; ids after the
last separator are a last, unterminated document; an empty file has none. The
writer counts null texts as empty, keeps repeated rows and null doc_ids, writes
the separator's own text inside a document as ordinary text, ignores other
columns; an empty table gives no file and no row.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelake.llm.bpe import cut_words, default_tokenizer, load_tokenizer
from pricelake.llm.common import materialize, pieces, scratch_path, table
from pricelake.llm.warc import _make, _open

BLOCK = 1 << 20
GROUP = 1024
SEPARATOR = "<|endoftext|>"
_MEMO = 300_000


def _write(batches, folder: str, tokenizer: str, separator: str):
    """Appends the ids of each document to a file of this task; gives (file, ordinal, doc_id, size) rows."""
    fs, path = _open(folder)
    tok = load_tokenizer(tokenizer)
    end = np.array([tok.token_to_id(separator)], "<u2").tobytes()
    tok.encode_special_tokens = True
    if tok.get_vocab_size() > 1 << 16:
        raise ValueError("the vocabulary does not fit 16-bit ids")
    memo: dict[str, bytes] = {}
    out, name, ordinal = None, f"{uuid.uuid4().hex}.bin", 0
    schema = pa.schema([("file", pa.string()), ("ordinal", pa.int64()), ("doc_id", pa.int64())])
    try:
        for batch in batches:
            if out is None and len(batch):
                out = fs.open_output_stream(f"{path}/{name}", compression=None)
            for text in batch.column(1):
                words = cut_words(text.as_py() or "", None)
                if len(memo) > _MEMO:
                    memo.clear()
                new = list({w for w in words if w not in memo})
                for w, e in zip(new, tok.encode_batch(new, add_special_tokens=False)):
                    memo[w] = np.array(e.ids, "<u2").tobytes()
                out.write(b"".join([*map(memo.__getitem__, words), end]))
            n = len(batch)
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"] * n), pa.array(np.arange(ordinal, ordinal + n)), batch.column(0)], schema=schema)
            ordinal += n
    finally:
        if out is not None:
            out.close()


def write_token_files(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None, separator: str = SEPARATOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes flat token files into the shared ``folder``; the manifest (file, ordinal, doc_id) tells which document is which."""
    folder = folder or scratch_path(docs.sparkSession, "tokens")
    _make(folder)
    path = tokenizer or default_tokenizer()
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return materialize(rows.mapInArrow(lambda batches: _write(batches, folder, path, separator), "file string, ordinal bigint, doc_id bigint"), "tokens-manifest")


def _sizes(batches):
    for pdf in batches:
        if len(pdf):
            ids = []
            for uri in pdf["file"]:
                fs, path = _open(uri)
                ids.append(fs.get_file_info(path).size // 2)
            yield pd.DataFrame({"file": pdf["file"], "ids": ids})


def _scan(batches, separator: int, block: int):
    """One row per block: its separators (absolute places) and the lengths between them."""
    for pdf in batches:
        out = []
        for uri, number, ids in zip(pdf["file"], pdf["block"], pdf["ids"]):
            fs, path = _open(uri)
            start = int(number) * block
            with fs.open_input_file(path) as f:
                data = f.read_at(2 * min(block, int(ids) - start), 2 * start)
            at = np.flatnonzero(np.frombuffer(data, "<u2") == separator)
            first, last = (start + int(at[0]), start + int(at[-1])) if at.size else (None, None)
            out.append((uri, number, len(at), first, last, np.diff(at) - 1))
        done = pd.DataFrame(out, columns=["file", "block", "n", "first", "last", "between"])
        yield done.astype({"first": "Int64", "last": "Int64"})


def count_tokens(files: DataFrame, separator: int, block: int = BLOCK, group: int = GROUP) -> DataFrame:
    """(file, ordinal, n_tokens) of every document in the flat files named by the column ``file``."""
    sizes = materialize(files.select("file").distinct().mapInPandas(_sizes, "file string, ids bigint"), "tokens-sizes")
    blocks = sizes.where("ids > 0").withColumn("block", F.explode(F.sequence(F.lit(0), ((F.col("ids") - 1) / block).cast("int"))))
    # Tasks by the ids to scan: AQE would size them by the block rows, which are small.
    total = sizes.agg(F.sum("ids")).first()[0] or 0
    blocks = blocks.repartition(pieces(total, 8 * block), "file", "block")
    found = blocks.mapInPandas(lambda b: _scan(b, separator, block), "file string, block int, n bigint, first bigint, last bigint, between array<bigint>")
    found = materialize(found.withColumn("group", F.floor(F.col("block") / group)), "tokens-blocks")

    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    groups = found.groupBy("file", "group").agg(F.max("last").alias("last"), F.sum("n").alias("n"))
    over = before("file").orderBy("group")
    groups = groups.select("file", "group", F.max("last").over(over).alias("_last"), F.coalesce(F.sum("n").over(over), F.lit(0)).alias("_n"))
    over = before("file", "group").orderBy("block")
    stitched = found.join(groups, ["file", "group"]).select(
        "file",
        (F.col("_n") + F.coalesce(F.sum("n").over(over), F.lit(0))).alias("ordinal"),
        (F.col("first") - 1 - F.coalesce(F.max("last").over(over), F.col("_last"), F.lit(-1))).alias("open"),
        "between",
    )
    whole = stitched.where("open is not null").select("file", "ordinal", F.posexplode(F.concat(F.array("open"), "between")).alias("_at", "n_tokens"))
    whole = whole.select("file", (F.col("ordinal") + F.col("_at")).alias("ordinal"), "n_tokens")
    tails = found.groupBy("file").agg(F.max("last").alias("last"), F.sum("n").alias("ordinal")).join(sizes, "file")
    tails = tails.select("file", "ordinal", (F.col("ids") - 1 - F.coalesce("last", F.lit(-1))).alias("n_tokens")).where("n_tokens > 0")
    return whole.unionByName(tails)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens."""
    manifest = write_token_files(table(spark, sf_dir, "documents"))
    counts = count_tokens(manifest, load_tokenizer(default_tokenizer()).token_to_id(SEPARATOR))
    return manifest.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens")
