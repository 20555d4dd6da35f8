"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.session import materialize, scratch_path  # noqa: F401  (re-exported)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(prefix: str) -> str:
    """A column or table name that no input column can clash with."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def pieces(total: int, each: int, least: int = 1) -> int:
    """How many pieces of at most about ``each`` make ``total``."""
    return max(least, math.ceil(total / each))


def slices(batches, most: int):
    """The rows of the Arrow batches in slices of about ``most`` bytes: what a worker makes of a batch at once stays small."""
    for batch in batches:
        rows = max(1, batch.num_rows * most // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    pa.default_memory_pool().release_unused()  # a worker lives on, for other queries, too


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers as byte planes (all low bytes, then all second bytes...), compressed."""
    raw = np.ascontiguousarray(values, dtype="<u4")
    return zstandard.ZstdCompressor(level=1).compress(raw.view(np.uint8).reshape(-1, 4).T.tobytes()) if len(raw) else b""


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint32)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)
