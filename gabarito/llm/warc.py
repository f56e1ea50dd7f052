"""Deterministic sharded WARC archives: written from Spark tasks, and read back.

Rows are dealt to key ranges whose bounds come from a hash-ordered sample, so they depend on the
rows alone. A task writes a range in key order into gzip members, one per record, and begins a
new file when the compressed size reaches the limit. A file appears under its name only when it
is complete, and only files that the manifest lists are ever read.
"""

import base64
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gabarito.llm.common import SLICE_BYTES, slices
from gabarito.staging import small_join

SMALLEST_REVISIT = 1000
LAST_KEY = (1 << 63) - 1  # where rows without a page_id lie
FILE_BYTES = 64 << 20
RANGE_BYTES = 1 << 30  # raw payload bytes that one key range should hold
LEAST_RANGES = 32
SAMPLE_PER_RANGE = 32
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "warc-record")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"
MANIFEST = "file string, records long, compressed_bytes long, sha1 string, first_key long, last_key long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, str(page_id))}>"


def sha1(raw: bytes) -> str:
    return hashlib.sha1(raw).hexdigest()


def base32(hex_digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, original: int | None) -> bytes:
    """One WARC record: headers and digests made anew from the row."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if original is not None else http + payload
    target = "".join(" " if c in "\r\n" else c for c in url or "")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if original is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: {base32(digest)}",
        f"WARC-Block-Digest: {base32(sha1(block))}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
        f"Payload-Length: {len(payload)}",
    ]
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if original is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(original)}", f"Refers-To-Page-ID: {original}"]
    return CRLF.join(line.encode() for line in lines) + CRLF * 2 + block + CRLF * 2


def member(raw: bytes) -> bytes:
    """A gzip member without time or name, so that equal records have equal bytes."""
    press = zlib.compressobj(LEVEL, zlib.DEFLATED, 16 + zlib.MAX_WBITS)
    return press.compress(raw) + press.flush()


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The store behind a URI, for tasks; a path without a scheme is local."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class Roller:
    """Writes the records of one range into files of bounded compressed size."""

    def __init__(self, folder: str, range_: int, file_bytes: int):
        self.store, self.folder = file_system(folder)
        self.range, self.file_bytes, self.number = range_, file_bytes, 0
        self.out = None

    def add(self, page_id: int | None, raw: bytes) -> Iterator[tuple]:
        packed = member(raw)
        if self.out and self.size + len(packed) > self.file_bytes:
            yield self.close()
        if not self.out:
            self.name = f"range-{self.range:06d}-{self.number:04d}.warc.gz"
            self.temporary = f"{self.folder}/.{self.name}.{uuid.uuid4().hex}"
            self.out = self.store.open_output_stream(self.temporary, compression=None)
            self.size, self.records, self.digest, self.first = 0, 0, hashlib.sha1(), page_id
        self.out.write(packed)
        self.digest.update(packed)
        self.size, self.records, self.last = self.size + len(packed), self.records + 1, page_id

    def close(self) -> tuple:
        self.out.close()
        # A repeated task writes the same bytes under the same name.
        self.store.move(self.temporary, f"{self.folder}/{self.name}")
        self.out, self.number = None, self.number + 1
        return (self.name, self.records, self.size, self.digest.hexdigest(), self.first, self.last)


def payload_of(html: str = "html") -> Column:
    return F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")


def with_originals(pages: DataFrame) -> DataFrame:
    """`pages` (page_id, url, html) with `digest` and `original`, the page that holds an equal payload."""
    pages = pages.withColumn("digest", F.sha1(payload_of()))
    large = (F.octet_length(payload_of()) >= SMALLEST_REVISIT) & F.col("page_id").isNotNull()
    shared = (
        pages.where(large)
        .select("page_id", "digest")
        .groupBy("digest")
        .agg(F.max("page_id").alias("holder"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "holder")
    )
    found = small_join(pages, shared, ["digest"], how="left", spread=F.col("page_id"))
    return found.withColumn("original", F.when(F.col("holder") != F.col("page_id"), F.col("holder"))).drop("holder")


def range_bounds(pages: DataFrame) -> list[int]:
    """Keys that cut the rows into ranges of about RANGE_BYTES, from the rows of smallest hash."""
    total, rows = pages.agg(F.sum(F.octet_length("html").cast("long")), F.count("*")).first()
    ranges = max(LEAST_RANGES, -(-(total or 0) // RANGE_BYTES))
    drawn = ranges * SAMPLE_PER_RANGE
    share = min(1.0, 4 * drawn / max(1, rows))
    place = F.pmod(F.xxhash64("page_id"), F.lit(1 << 30))
    sample = (
        pages.select("page_id", place.alias("place"))
        .where(F.col("place") < int(share * (1 << 30)))
        .orderBy("place", "page_id")
        .limit(drawn)
        .select("page_id")
        .collect()
    )
    keys = sorted(r["page_id"] for r in sample if r["page_id"] is not None)
    return sorted({keys[len(keys) * k // ranges] for k in range(1, ranges)}) if keys else []


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write `page_id`, `url` and `html` of every row as WARC records; returns the manifest.

    Records lie in order of page_id; files and their bytes depend on the rows alone. Of records
    with equal payloads of at least 1000 bytes the one with the largest page_id is the response
    and the others are revisits of it; smaller ones are all responses. A null html is an empty
    payload and a null url an empty target. A row without a page_id comes last and is always a
    response; rows that repeat a page_id are all written. Other columns are not read. An empty
    table leaves an empty manifest. `folder` must be reachable from every
    executor; the manifest is a Parquet table in it, written last.
    """
    pages = pages.select("page_id", "url", "html")
    bounds = np.array(range_bounds(pages), np.int64)
    ranges = len(bounds) + 1
    shared = pages.sparkSession.sparkContext.broadcast(bounds)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared.value, keys.to_numpy(), side="right").astype(np.int32))

    dealt = with_originals(pages).withColumn("range", range_of(F.coalesce("page_id", F.lit(LAST_KEY))))
    dealt = dealt.repartition(ranges, "range").sortWithinPartitions("range", "page_id")
    columns = ["range", "page_id", "url", "html", "digest", "original"]
    names = [x.split()[0] for x in MANIFEST.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = None
        done: list[tuple] = []
        for batch in batches:
            for part in slices(batch, 3):
                for range_, page_id, url, html, digest, original in zip(*(c.to_pylist() for c in part.columns)):
                    if roller is None or roller.range != range_:
                        if roller:
                            done.append(roller.close())
                        roller = Roller(folder, range_, file_bytes)
                    done += roller.add(page_id, record(page_id, url, (html or "").encode(), digest, original))
        if roller:
            done.append(roller.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)

    spark = pages.sparkSession
    store, path = file_system(folder)
    store.create_dir(path, recursive=True)
    manifest = f"{folder}/manifest"
    dealt.select(columns).mapInArrow(run, MANIFEST).write.mode("error").parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def parsed(raw: bytes) -> tuple:
    """(page_id, url, type, refers_to, payload bytes, payload digest, payload) of one record; checked."""
    head, _, block = raw.partition(CRLF * 2)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    if base32(sha1(block)) != fields["WARC-Block-Digest"]:
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    payload = None
    if fields["WARC-Type"] == "response":
        payload = block.partition(CRLF * 2)[2]
        if sha1(payload) != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    refers = fields.get("Refers-To-Page-ID")
    return (
        int(fields["Page-ID"]) if "Page-ID" in fields else None,
        fields["WARC-Target-URI"],
        fields["WARC-Type"],
        None if refers is None else int(refers),
        int(fields["Payload-Length"]),
        digest,
        payload,
    )


def records(stream: io.RawIOBase) -> Iterator[bytes]:
    """Gzip members of a file, one at a time."""
    rest = b""
    while True:
        opened, out = zlib.decompressobj(16 + zlib.MAX_WBITS), []
        while not opened.eof:
            if not rest:
                rest = stream.read(1 << 20)
                if not rest:
                    if out:
                        raise ValueError("the last record is cut off")
                    return
            out.append(opened.decompress(rest))
            rest = opened.unused_data
        yield b"".join(out)


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Every record of the archives that the manifest in `folder` lists, digests verified.

    Payloads of revisits are null; their length and digest are those of the full payload.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    names = [x.split()[0] for x in RECORD.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = file_system(folder)

        def batch(held: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)

        for listed in batches:
            for name in listed.column(0).to_pylist():
                held, size = [], 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for raw in records(stream):
                        found = parsed(raw)
                        size += len(raw) if with_payload else 256
                        held.append(found if with_payload else (*found[:-1], None))
                        if size > SLICE_BYTES:
                            yield batch(held)
                            held, size = [], 0
                if held:
                    yield batch(held)

    files = manifest.select("file").repartition(max(1, manifest.count()))
    return files.mapInArrow(run, RECORD)
