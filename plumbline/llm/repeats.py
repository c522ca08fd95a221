"""Substring dedup: words inside windows that occur more than once are removed.

Every window of ``window`` consecutive words gets a Rabin-Karp hash. The hashes are
dealt out by their leading bits, counted, and the positions of repeated ones go back
to where they came from and merge into maximal intervals.

A task packs the hashes of some 16 MB of text (a block) into one sorted row per range
of hashes, each hash once, so a passage that fills a third of the corpus arrives once
per block, and a window takes about 8 bytes in the shuffle. Nothing is sampled or
capped. Two different windows with one 64-bit hash would be taken for equal: that is
expected for n*n/2**65 of n windows, 0.0005 for 135 million.

NULL and blank texts have no words and stay as they are. Texts shorter than a window
are never touched. A row that repeats a doc_id and its text shares its windows, so both
lose them. The frame should be a stored table, read in the same order on a retry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import fresh, slices, spans, utf8
from plumbline.llm.words import rolling_hashes, whole_windows, word_hashes

WINDOW = 35
BLOCK_BYTES = 16 << 20

# Text bytes whose window hashes meet in one group of the count.
GROUP_BYTES = 24 << 20

# In place of a window's word: the block holds the hash several times.
_MANY = np.uint32(0xFFFFFFFF)

_PACKED = "part int, block string, kind string, n int, keys binary, more binary"
_SPANS = "row_id long, row_text long, starts array<int>, ends array<int>"


def pack(values: np.ndarray) -> bytes:
    """Integers as a compressed string: bytes of like weight side by side."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, n: int, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=max(1, n * np.dtype(dtype).itemsize)), np.uint8)
    return np.ascontiguousarray(raw.reshape(-1, n).T).view(dtype).reshape(n)


def _hash_pieces(pieces: Iterator[pa.RecordBatch], window: int, block_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Table]]:
    """Neighbouring texts until they hold ``block_bytes``: the hashes of their windows, the
    words these start at, the words before each text, and the texts' keys. Texts are
    hashed as they come and not held."""
    hashes, places, counts, keys, size, words = [], [], [np.zeros(1, np.int64)], [], 0, 0

    def block():
        h, place = np.concatenate(hashes), np.concatenate(places)
        return h, place, np.concatenate(counts), pa.Table.from_batches(keys)

    for piece in pieces:
        data, at = utf8(piece.column("text"))
        size += len(data)
        found, first = word_hashes(data, at)
        inside = whole_windows(first, window)
        hashes.append(rolling_hashes(found, window)[inside])
        places.append((np.flatnonzero(inside) + words).astype(np.uint32))
        counts.append(first[1:] + words)
        words += int(first[-1])
        # taken, as a slice would hold the texts as well
        keys.append(piece.select(["row_id", "row_text"]).take(pa.array(np.arange(piece.num_rows))))
        if size >= block_bytes:
            yield block()
            hashes, places, counts, keys, size, words = [], [], [np.zeros(1, np.int64)], [], 0, 0
    if sum(k.num_rows for k in keys):
        yield block()


def _again(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted values: which equal the one before, and which the one after."""
    same = h[1:] == h[:-1]
    return np.append(np.zeros(min(len(h), 1), bool), same), np.append(same, np.zeros(min(len(h), 1), bool))


def _pack_block(h: np.ndarray, place: np.ndarray, words: np.ndarray, keys: pa.Table, block: str, groups: int) -> Iterator[dict]:
    """One row per hash range, and one with the texts' keys and what the block knows itself."""
    order = np.argsort(h, kind="stable")
    h, place = h[order], place[order]
    del order
    old, many = _again(h)
    known = np.sort(place[old | many])
    place[many] = _MANY
    h, place = h[~old], place[~old]
    # the first hash of each range: part = (h >> 32) * groups >> 32
    edge = np.searchsorted(h, np.array([-(-(g << 32) // groups) << 32 for g in range(1, groups)], np.uint64))
    edge = [0, *edge.tolist(), len(h)]
    for g, (a, b) in enumerate(zip(edge[:-1], edge[1:])):
        if a < b:
            yield {"part": g, "block": block, "kind": "keys", "n": b - a, "keys": pack(np.diff(h[a:b], prepend=np.uint64(0))), "more": pack(place[a:b])}
    texts = keys.combine_chunks().append_column("end", pa.array(words[1:]))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, texts.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(texts)
    yield {"part": -1 - hash_of(block) % groups, "block": block, "kind": "texts", "n": len(known), "keys": pack(np.diff(known, prepend=np.uint32(0))) if len(known) else b"", "more": sink.getvalue().to_pybytes()}


def hash_of(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=4).digest(), "big")


def _packer(window: int, groups: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for i, held in enumerate(_hash_pieces(slices(batches, "text"), window, block_bytes)):
            for row in _pack_block(*held, f"{task}-{i}", groups):
                yield pa.RecordBatch.from_pylist([row], schema=_PACKED_ARROW)

    return run


_PACKED_ARROW = pa.schema([("part", pa.int32()), ("block", pa.string()), ("kind", pa.string()), ("n", pa.int32()), ("keys", pa.binary()), ("more", pa.binary())])


def _count_group(table: pa.Table) -> pa.Table:
    """Hashes of one range from all blocks: the places of those seen more than once.
    The rows with the texts' keys pass through."""
    if table.num_rows and table.column("kind")[0].as_py() == "texts":
        return table
    count = table.column("n").to_numpy()
    edge = np.concatenate([[0], np.cumsum(count)])
    h, place = np.empty(edge[-1], np.uint64), np.empty(edge[-1], np.uint32)
    for a, n, keys, more in zip(edge, count, table.column("keys"), table.column("more")):
        np.cumsum(unpack(keys.as_buffer(), n, np.uint64), out=h[a : a + n])
        place[a : a + n] = unpack(more.as_buffer(), n, np.uint32)
    order = np.argsort(h, kind="stable")
    old, many = _again(h[order])
    repeated = np.empty(len(h), bool)
    repeated[order] = old | many
    repeated &= place != _MANY  # the block knows those itself
    out = []
    for a, b, part, block in zip(edge[:-1], edge[1:], table.column("part").to_pylist(), table.column("block").to_pylist()):
        found = np.sort(place[a:b][repeated[a:b]])
        if len(found):
            out.append({"part": part, "block": block, "kind": "places", "n": len(found), "keys": pack(np.diff(found, prepend=np.uint32(0))), "more": None})
    return pa.Table.from_pylist(out, schema=_PACKED_ARROW)


def _merger(window: int):
    def run(table: pa.Table) -> pa.Table:
        """All places of one block, merged into intervals of words per text."""
        rows = table.to_pylist()
        (head,) = [r for r in rows if r["kind"] == "texts"]
        texts = pa.ipc.open_stream(head["more"]).read_all()
        ends = texts.column("end").to_numpy()
        total = int(ends[-1]) if len(ends) else 0
        edge = np.zeros(total + 1, np.int32)
        for r in rows:
            if r["n"]:
                place = np.cumsum(unpack(r["keys"], r["n"], np.uint32), dtype=np.int64)
                edge[place] += 1
                edge[place + window] -= 1
        starts, stops, owner = cut_at(*spans(np.cumsum(edge[:-1]) > 0), ends)
        offset = np.concatenate([[0], ends[:-1]]) if len(ends) else np.zeros(0, np.int64)
        held, where = np.unique(owner, return_index=True)
        bounds = np.append(where, len(owner)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array((x - offset[owner]).astype(np.int32))) for x in (starts, stops)]
        keys = texts.take(pa.array(held))
        return pa.Table.from_arrays([keys.column("row_id").combine_chunks(), keys.column("row_text").combine_chunks(), *lists], ["row_id", "row_text", "starts", "ends"])

    return run


def cut_at(starts: np.ndarray, stops: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals cut where a text ends, and the text of each; ``ends`` are the texts' ends."""
    inner = ends[:-1]
    low, high = np.searchsorted(inner, starts, side="right"), np.searchsorted(inner, stops, side="left")
    more = high - low
    index = np.repeat(np.arange(len(starts)), more + 1)
    step = np.arange(len(index)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
    cut = low[index] + step
    a = np.where(step == 0, starts[index], inner[np.maximum(cut - 1, 0)] if len(inner) else 0)
    b = np.where(step == more[index], stops[index], inner[np.minimum(cut, len(inner) - 1)] if len(inner) else 0)
    full = a < b
    a, b = a[full], b[full]
    return a, b, np.searchsorted(ends, a, side="right")


def count_groups(docs: DataFrame, text: str, group_bytes: int) -> int:
    """How many groups the keys of a corpus are dealt into, by its bytes of text."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, -(-total // group_bytes))


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The two columns the operator reads, and a hash of the text that tells apart rows
    that share a doc_id."""
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("row_id"), F.xxhash64(f"`{text}`").alias("row_text"), F.col(f"`{text}`").alias("text"))


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(row_id, row_text, starts, ends): per text with repeated windows, the maximal
    intervals of word positions that they cover. One row per doc_id and text."""
    rows = keyed(docs, doc_id, text)
    groups = count_groups(rows, "text", group_bytes)
    packed = rows.mapInArrow(_packer(window, groups, block_bytes), _PACKED)
    places = packed.groupBy("part").applyInArrow(_count_group, _PACKED)
    found = places.groupBy("block").applyInArrow(_merger(window), _SPANS)
    return found.groupBy("row_id", "row_text").agg(F.first("starts").alias("starts"), F.first("ends").alias("ends"))


def with_spans(docs: DataFrame, doc_id: str, text: str, found: DataFrame, names: tuple[str, str]) -> DataFrame:
    """``docs`` with the two list columns of ``found``; NULL where nothing was found."""
    mark = fresh("row_text_hash", docs)
    right = found.select(F.col("row_id").alias(f"{mark}_id"), F.col("row_text").alias(f"{mark}_text"), F.col("starts").alias(names[0]), F.col("ends").alias(names[1]))
    joined = docs.withColumn(mark, F.xxhash64(f"`{text}`")).join(
        right, F.col(f"`{doc_id}`").cast("long").eqNullSafe(F.col(f"{mark}_id")) & (F.col(mark) == F.col(f"{mark}_text")), "left"
    )
    return joined.drop(mark, f"{mark}_id", f"{mark}_text")


def _kept(text: bytes, starts, ends) -> tuple[int, int, bytes]:
    words = text.split()
    n = len(words)
    removed = 0
    for a, b in zip(starts[::-1], ends[::-1]):
        del words[a:b]
        removed += b - a
    return n, removed, b" ".join(words)


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, **sizes: int) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per row of ``docs``: the digest is that of
    the kept words joined by one space."""
    found = repeated_spans(docs, doc_id, text, window, **sizes)
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, a, b in zip(batch.column("text"), batch.column("starts"), batch.column("ends")):
                n, removed, kept = _kept((t.as_py() or "").encode(), a.as_py() or (), b.as_py() or ())
                out.append((n, removed, hashlib.sha256(kept).hexdigest()))
            n, removed, digest = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return with_spans(rows, "doc_id", "text", found, ("starts", "ends")).mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, **sizes: int) -> DataFrame:
    """``docs`` without the repeated words. A text that loses words has the rest joined by
    one space; all other texts, and all other columns, stay as they are."""
    found = repeated_spans(docs, doc_id, text, window, **sizes)
    a, b = fresh("span_starts", docs), fresh("span_ends", docs)

    @F.pandas_udf("string")
    def kept(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
        return pd.Series([t if s is None or not len(s) else _kept((t or "").encode(), s, e)[2].decode() for t, s, e in zip(texts, starts, ends)], dtype=object)

    joined = with_spans(docs, doc_id, text, found, (a, b))
    cleaned = F.when(F.col(a).isNull(), F.col(f"`{text}`")).otherwise(kept(F.col(f"`{text}`"), F.col(a), F.col(b)))
    return joined.withColumn(text, cleaned).select(*[f"`{c}`" for c in docs.columns])
