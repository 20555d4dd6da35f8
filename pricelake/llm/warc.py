"""WARC archives: written with an index, read back by coalesced byte ranges.

Writing. Equal payloads of at least ``least`` bytes share one response record,
that of the largest page_id; the others become revisit records that refer to
it. Every task appends its records, each a gzip member of its own, to archives
of its own (a new one every ``roll`` bytes) in the shared folder and returns
an index row per record: archive, offset, length, URL and digest. The index is
written as a Parquet table first; only archives of committed tasks are in it,
so what a lost or repeated task left behind is never read.

Reading. The index rows of the wanted records are grouped by archive and
``STRETCH`` of offsets, sorted, and neighbours at most ``GAP`` bytes apart are
fetched by one read; the records are parsed from the bytes and the payload's
SHA-1 is compared with the header's.

The folder is opened by its URI through pyarrow's file systems in the tasks
(file, hdfs, s3, gs).

Defined cases: a null html is an empty payload; repeated rows are one record
each, and rows that share the largest page_id of their payload are all
responses; a row without page_id is written, too, and revisits if an equal
payload has a page_id; a null URL is left out of the header; line breaks in
URLs are percent-encoded; other columns are ignored; an empty table gives an
empty index.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import materialize, pieces, scratch_path, table

LEAST = 1000
ROLL = 256 << 20
STRETCH = 8 << 20
GAP = 64 << 10

_INDEX = "page_id bigint, url string, archive string, offset bigint, length bigint, digest string, record_type string"
_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("digest", pa.string()), ("record_type", pa.string())])


def _open(uri: str):
    """(file system, path) of a URI; s3a is s3 there."""
    return pa.fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _name(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    return None if (x := name[len("<urn:page:") : -1]) == "none" else int(x)


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record, uncompressed."""
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_name(refers_to)}"]
    block = http if refers_to is not None else http + payload
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of a record: page_id, url, record_type, refers_to, digest, payload (None of a revisit) and payload_bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']}: the payload does not fit its digest")
    return {
        "page_id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
        "refers_to": _page(fields["WARC-Refers-To"]) if revisit else None, "digest": digest, "payload": None if revisit else payload, "payload_bytes": size,
    }


def _write(batches, folder: str, roll: int, date: str):
    fs, path = _open(folder)
    out = name = None
    offset = 0
    try:
        for batch in batches:
            rows = []
            for page, url, html, digest, refers_to in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if out is None or offset >= roll:
                    if out is not None:
                        out.close()
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = packer.compress(record(page, url, (html or "").encode("utf-8"), digest, refers_to, date)) + packer.flush()
                out.write(data)
                rows.append((page, url, f"{folder}/{name}", offset, len(data), digest, "response" if refers_to is None else "revisit"))
                offset += len(data)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)] if rows else [pa.array([], f.type) for f in _SCHEMA], schema=_SCHEMA)
    finally:
        if out is not None:
            out.close()


def write_archives(pages: DataFrame, folder: str | None = None, least: int = LEAST, roll: int = ROLL, date: str = "1970-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the archives into ``folder`` (a shared one) and returns their index, itself a written table."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    _make(folder)
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    copies = rows.where(F.octet_length("html") >= least).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    copies = materialize(copies.where("n > 1").select("digest", "first"), "warc-copies")
    joined = rows.join(copies, "digest", "left")
    refers_to = F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first"))
    index = joined.select("page_id", "url", "html", "digest", refers_to.alias("refers_to")).mapInArrow(lambda batches: _write(batches, folder, roll, date), _INDEX)
    return materialize(index, "warc-index")


def _make(folder: str) -> None:
    fs, path = _open(folder)
    fs.create_dir(path, recursive=True)


def _read(pdf: pd.DataFrame, payload: bool) -> pd.DataFrame:
    """The records of one archive's stretch: sorted, neighbours by one read."""
    pdf = pdf.drop_duplicates(["offset"]).sort_values("offset")
    fs, path = _open(pdf["archive"].iloc[0])
    spans, start, end = [], None, None
    for a, n in zip(pdf["offset"], pdf["length"]):
        if start is not None and a - end <= GAP:
            spans[-1][1].append((a, n))
        else:
            start = a
            spans.append((a, [(a, n)]))
        end = a + n
    out = []
    with fs.open_input_file(path) as f:
        for start, members in spans:
            data = memoryview(f.read_at(members[-1][0] + members[-1][1] - start, start))
            out += [parse(zlib.decompress(data[a - start : a - start + n], 31)) for a, n in members]
    done = pd.DataFrame(out)
    for c in ("page_id", "refers_to", "payload_bytes"):
        done[c] = done[c].astype("Int64")
    return done[["page_id", "url", "record_type", "refers_to", "digest", "payload_bytes", *(["payload"] if payload else [])]]


def read_records(index: DataFrame, payload: bool = True) -> DataFrame:
    """The records that the rows of an index name, each once: page_id, url, record_type, refers_to, digest, payload_bytes and, if asked for, payload."""
    schema = "page_id bigint, url string, record_type string, refers_to bigint, digest string, payload_bytes bigint" + ", payload binary" * payload
    wanted = index.select("archive", "offset", "length", F.floor(F.col("offset") / STRETCH).alias("_stretch"))
    # Tasks by the bytes to fetch: AQE would size them by the index rows, which are small.
    total = wanted.agg(F.sum("length")).first()[0] or 0
    wanted = wanted.repartition(pieces(total, 4 * STRETCH), "archive", "_stretch")
    return wanted.groupBy("archive", "_stretch").applyInPandas(lambda pdf: _read(pdf, payload), schema)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page, read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    index = write_archives(table(spark, sf_dir, "pages"))
    return read_records(index, payload=False).select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


ORACLE = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
