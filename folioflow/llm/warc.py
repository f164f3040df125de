"""WARC archives of web pages, compressed record by record with a Zstandard dictionary of their own.

An archive file starts with a skippable frame that holds the dictionary, trained on records of that archive, followed
by one Zstandard frame per record: any record can be read knowing the dictionary and its offset. Of pages with equal
payloads the one with the largest page_id is a response record, the others are revisit records that refer to it.

Equal payloads meet by their SHA-256 in rows of a few bytes only; the pages themselves learn by id and digest whether
they are revisits. Archives are written by the tasks to the shared
folder under names of the task attempt and moved into place when complete; readers take only the files that the
manifest lists, which holds those of successful attempts.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, chunks, materialize, pick, scratch_path

#: First four bytes of the leading skippable frame.
MAGIC = 0x184D2A5D
#: Payload bytes of an archive; a larger page makes an archive of its own.
ARCHIVE_BYTES = 24 << 20
DICTIONARY_BYTES = 64 << 10
#: Bytes of records that a dictionary is trained on at most, taken evenly from the archive.
TRAINING_BYTES = 3 << 20
LEVEL = 6
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC/1.1 response record, or a revisit record if refers_to is given: HTTP head, and payload unless revisited."""
    uri = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "about:blank")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    sha = digest(payload)
    name = lambda i: f"<urn:page:{'' if i is None else i}:{sha}>"  # noqa: E731  pages that share an id differ in their payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{sha}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers_to)}"]
    return "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Fields of a record made by record(); the payload of a response is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    length = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
    sha = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != length or digest(payload) != sha):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    own, to = (fields.get(k, "")[len("<urn:page:") : -1].partition(":")[0] for k in ("WARC-Record-ID", "WARC-Refers-To"))
    return {"page_id": int(own) if own else None, "payload_bytes": length, "payload_digest": sha, "record_type": fields["WARC-Type"], "refers_to": int(to) if to else None, "payload": payload if fields["WARC-Type"] == "response" else None}


def archive(records: list[bytes]) -> bytes:
    """A .warc.zst file: the dictionary's skippable frame, then one frame per record."""
    import zstandard as z

    total = sum(map(len, records))
    step = max(1, -(-total // TRAINING_BYTES))
    samples = [r[i : i + 8192] for r in records[::step] for i in range(0, len(r), 8192)]
    try:
        trained = z.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except z.ZstdError:  # too few or too small records to learn from: they are the dictionary
        trained = b"".join(samples)[:DICTIONARY_BYTES] or b"\0" * 8
    compressor = z.ZstdCompressor(level=LEVEL, dict_data=z.ZstdCompressionDict(trained), write_checksum=True, write_content_size=True)
    return struct.pack("<II", MAGIC, len(trained)) + trained + b"".join(compressor.compress(r) for r in records)


def records_of(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one at a time."""
    import zstandard as z

    magic, size = struct.unpack_from("<II", data)
    if magic != MAGIC:
        raise ValueError("no leading dictionary frame")
    view = memoryview(data)
    decompressor = z.ZstdDecompressor(dict_data=z.ZstdCompressionDict(bytes(view[8 : 8 + size])))
    at = 8 + size
    while at < len(data):
        d = decompressor.decompressobj()
        yield d.decompress(view[at:])
        if not d.eof:
            raise ValueError("truncated archive")
        at = len(data) - len(d.unused_data)


def save(path: str, data: bytes) -> None:
    """Write a file to a local or shared folder, or by Arrow to a remote store; a partial file never gets the name."""
    if "://" in path and not path.startswith("file:"):
        from pyarrow import fs

        store, where = fs.FileSystem.from_uri(path)
        store.create_dir(os.path.dirname(where), recursive=True)
        with store.open_output_stream(f"{where}.tmp") as f:
            f.write(data)
        store.move(f"{where}.tmp", where)
        return
    where = path.removeprefix("file:")
    where = "/" + where.lstrip("/")
    os.makedirs(os.path.dirname(where), exist_ok=True)
    partial = f"{where}.{os.getpid()}.tmp"
    with open(partial, "wb") as f:
        f.write(data)
    os.replace(partial, where)


def with_referrals(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload and refers_to (null: response).

    Payload is the html in UTF-8, null being empty. Payloads of fewer than `least` bytes never refer. Rows that
    repeat the largest page_id of a payload are responses each; pages without a page_id are responses.
    """
    p = pick(pages, page_id="page_id bigint", url="url string", html="html string").withColumn("html", F.coalesce("html", F.lit("")))
    key = F.when(F.octet_length("html") >= least, F.sha2("html", 256))
    keys = p.select("page_id", key.alias("k")).where("k is not null and page_id is not null")
    twice = keys.groupBy("k").agg(F.max("page_id").alias("top"), F.min("page_id").alias("low")).where("top > low").drop("low")
    twice = materialize(twice, "payloads")
    again = keys.join(broadcast_if_small(twice, 100), "k").where("page_id < top").select("page_id", "k", "top").distinct()
    again = broadcast_if_small(materialize(again, "revisits"), 108)
    joined = p.withColumn("k", key).join(again, ["page_id", "k"], "left")  # beyond a broadcast pages meet by their ids, never by payload
    return joined.select("page_id", "url", F.col("html").cast("binary").alias("payload"), F.col("top").alias("refers_to"))


def write_archives(pages: DataFrame, path: str, least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write pages (page_id, url, html) as WARC files under path; (file, records, bytes), one row per file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (tuple(c[i].as_py() for c in b.columns) for b in batches for i in range(b.num_rows))
        attempt = TaskContext.get().taskAttemptId()
        for n, held in enumerate(chunks(rows, lambda r: len(r[2]), archive_bytes)):
            data = archive([record(*r) for r in held])
            name = f"pages-{attempt:09d}-{n:04d}.warc.zst"
            save(f"{path}/{name}", data)
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [len(held)], "bytes": [len(data)]})

    return materialize(with_referrals(pages, least).mapInArrow(run, "file string, records bigint, bytes bigint"), "manifest")


def read_archives(spark: SparkSession, path: str, manifest: DataFrame | None = None, payloads: bool = False) -> DataFrame:
    """One row per record of the archives under path, decompressed, parsed and checked; manifest: only the files it lists."""
    columns = {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"} | ({"payload": "binary"} if payloads else {})
    types = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(k, types[t]) for k, t in columns.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                for held in chunks(map(parse, records_of(b.column(0)[i].as_py())), lambda r: r["payload_bytes"] if payloads else 1, 8 << 20 if payloads else 10_000):
                    yield pa.RecordBatch.from_pylist([{k: r[k] for k in columns} for r in held], schema=arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path)
    if manifest is not None:
        files = files.join(manifest.select("file"), F.element_at(F.split("path", "/"), -1) == F.col("file"), "left_semi")
    return files.select("content").mapInArrow(run, ", ".join(f"{k} {t}" for k, t in columns.items()))


def op3_warc(spark, sf_dir: str) -> DataFrame:
    from .common import table

    path = scratch_path(spark, "warc")
    manifest = write_archives(table(spark, sf_dir, "pages"), path)
    if manifest.limit(1).count() == 0:
        return spark.createDataFrame([], "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")
    return read_archives(spark, path, manifest)


SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS hex FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY b) AS top FROM p),
bits AS (
    SELECT *, list_transform(range(0, 32), lambda i: (
        (('0x' || substr(hex || '00', CAST(floor(i * 5 / 8) AS INTEGER) * 2 + 1, 2))::INTEGER * 256
         + ('0x' || substr(hex || '00', CAST(floor(i * 5 / 8) AS INTEGER) * 2 + 3, 2))::INTEGER)
        >> (11 - (i * 5) % 8)) & 31) AS five
    FROM m
)
SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(five, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(x AS INTEGER) + 1, 1)), '') AS payload_digest,
    CASE WHEN page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id < top THEN top END AS refers_to
FROM bits
"""
