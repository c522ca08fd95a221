"""Web archives (.warc.zst) with a dictionary.

Each file starts with a skippable frame that holds a Zstandard dictionary built from its
own records; then every record is a frame of its own, compressed with that dictionary. A
reader needs nothing but the file, and one record can be read by its offset.

Of records with equal payloads of at least LEAST_REVISIT bytes, the one with the largest
page_id is a response and the others are revisit records, which hold no payload but its
digest and length. Equal means equal SHA-1 and length. All rows that share the largest
page_id are responses. A row without page_id is below all others. NULL is an empty
payload; a page without url has an empty target.

The dictionary of a file is trained on some SAMPLE_BYTES of its records, cut into even pieces
of at most PIECE_BYTES and taken at even steps over the whole file, and has at most DICTIONARY_BYTES; a file whose records cannot
train one has an empty dictionary frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from itertools import islice
from uuid import uuid4

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.files import read_file, write_file
from plumbline.session import materialize, shared_folder

LEAST_REVISIT = 1000
FILE_BYTES = 32 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20
PIECE_BYTES = 128 << 10

# Fixed value: the magic number of the dictionary's skippable frame.
DICTIONARY_MAGIC = 0x184D2A5D
LEVEL = 3
_READ_BYTES = 16 << 10


def record(page_id, url, payload: bytes, digest: str, refers_to, refers: bool, length: int) -> bytes:
    """One record: its header, a blank line, the payload and two line ends."""
    name = "" if page_id is None else str(page_id)
    body = b"" if refers else payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {''.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"X-Payload-Length: {length}",
    ]
    if refers:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: text/html", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def train(records: list[bytes]) -> bytes:
    """A dictionary from pieces of the records at even steps, or no bytes if they are too few."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    cuts = ((r, i, -(-len(r) // PIECE_BYTES)) for r in records for i in range(-(-len(r) // PIECE_BYTES)))
    sample = [r[len(r) * i // n : len(r) * (i + 1) // n] for r, i, n in islice(cuts, 0, None, step)]
    try:
        # segment and match lengths are given: a search for better ones costs far more than it saves
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, sum(map(len, sample)) // 8)), sample, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def archive(records: list[bytes]) -> tuple[list[bytes], list[int]]:
    """The pieces of a file, and the offset of each record."""
    dictionary = train(records)
    pieces = [struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary]
    held = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    packer = zstandard.ZstdCompressor(level=LEVEL, **held)
    offsets, at = [], len(pieces[0])
    for r in records:
        pieces.append(packer.compress(r))
        offsets.append(at)
        at += len(pieces[-1])
    return pieces, offsets


def open_archive(data: bytes) -> Iterator[bytes]:
    """The records of a file, one after the other."""
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the file does not start with a dictionary frame")
    held = {"dict_data": zstandard.ZstdCompressionDict(data[8 : 8 + size])} if size else {}
    reader = zstandard.ZstdDecompressor(**held)
    view, at = memoryview(data), 8 + size
    while at < len(view):
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            piece = view[at : at + _READ_BYTES]
            if not piece:
                raise ValueError("the file ends inside a record")
            parts.append(frame.decompress(piece))
            at += len(piece)
        at -= len(frame.unused_data)
        yield b"".join(parts)


def read_record(uri: str, offset: int, length: int) -> bytes:
    """One record of a file by its place, reading only the dictionary and its frame."""
    _, size = struct.unpack("<II", read_file(uri, 0, 8))
    held = {"dict_data": zstandard.ZstdCompressionDict(read_file(uri, 8, size))} if size else {}
    return zstandard.ZstdDecompressor(**held).decompress(read_file(uri, offset, length))


def records_of(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, html, digest, length, refers_to, refers) per page."""
    body = F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), body.alias("html"), F.sha1(body).alias("digest"), F.octet_length(body).cast("long").alias("length"))
    large = rows.where(F.col("length") >= LEAST_REVISIT).select("page_id", "digest", "length")
    # one row per payload that several pages have; stored, so that Spark knows its size
    # before it decides whether the pages must be shuffled for the join
    shared = large.groupBy("digest", "length").agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = rows.join(materialize(shared), ["digest", "length"], "left")
    refers = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return joined.withColumn("refers", refers).withColumn("refers_to", F.when(refers, F.col("response"))).drop("response")


_INDEX = "uri string, n long, bytes long, offsets array<long>"


def write(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write ``pages`` as archives under ``folder``; (uri, n, bytes, offsets) per file.

    Files hold pages by the hash of their id, sorted, so a repeated task writes the same file.
    """
    rows = records_of(pages, page_id, url, html)
    total = pages.agg(F.sum(F.octet_length(f"`{html}`"))).first()[0] or 0
    files = max(1, -(-total // file_bytes))
    dealt = rows.withColumn("file", F.pmod(F.xxhash64("page_id", "digest"), F.lit(files)).cast("int"))

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["page_id"] is None, r["page_id"] or 0, r["digest"], r["url"] or ""))
        if not rows:
            return pa.Table.from_pylist([], schema=_INDEX_ARROW)
        pieces, offsets = archive([record(r["page_id"], r["url"], r["html"], r["digest"], r["refers_to"], r["refers"], r["length"]) for r in rows])
        uri = f"{folder}/part-{rows[0]['file']:06d}.warc.zst"
        write_file(uri, pieces)
        return pa.Table.from_pylist([{"uri": uri, "n": len(rows), "bytes": sum(map(len, pieces)), "offsets": offsets}], schema=_INDEX_ARROW)

    return dealt.groupBy("file").applyInArrow(run, _INDEX)


_INDEX_ARROW = pa.schema([("uri", pa.string()), ("n", pa.int64()), ("bytes", pa.int64()), ("offsets", pa.list_(pa.int64()))])
_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string, stored_ok boolean"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = lambda x: int(x) if x else None
    for batch in batches:
        for uri in batch.column("uri").to_pylist():
            out = []
            for data in open_archive(read_file(uri)):
                fields, payload = parse(data)
                digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                kind = fields["WARC-Type"]
                name = lambda key: number(fields.get(key, "").removeprefix("<urn:page:").removesuffix(">"))  # noqa: E731, B023
                good = kind == "revisit" or (hashlib.sha1(payload).hexdigest() == digest and len(payload) == int(fields["X-Payload-Length"]))
                out.append((name("WARC-Record-ID"), int(fields["X-Payload-Length"]), digest, kind, name("WARC-Refers-To"), uri, good))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_())
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri", "stored_ok"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def read(index: DataFrame) -> DataFrame:
    """The records of written archives, from their files: one row per record, with the
    header's values, and whether a stored payload has its digest and length."""
    uris = index.select("uri")
    return uris.repartition(max(1, min(uris.count(), 4 * index.sparkSession.sparkContext.defaultParallelism)), "uri").mapInArrow(_read, _READ)


def report(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) as read back from the
    archives of ``pages``."""
    folder = folder or f"{shared_folder(pages.sparkSession)}/plumbline/warc-{uuid4().hex}"
    index = materialize(write(pages, folder))
    return read(index).where(F.expr("assert_true(stored_ok, 'a payload differs from its digest') IS NULL")).drop("uri", "stored_ok")
