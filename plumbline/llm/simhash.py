"""SimHash near-dedup by pigeonhole blocks.

A text's fingerprint has 64 bits: a bit is set if more than half of the hashes of its
three-word shingles, repeats included, have it set. Two fingerprints that differ in at most
three bits agree on one of four blocks of bits, so fingerprints are joined on each block
and verified by their Hamming distance.

A bucket (the fingerprints that agree on some bits) with more than BUCKET members is not
compared as it stands: its bits that are still free are cut into four blocks again, and a
close pair agrees on one of those as well. As fingerprints in a bucket are distinct, this
ends: a bucket with twelve free bits has at most 4,096 members. A bucket hands on one link
per member, to the first one it is tied to, never its pairs. Links join fingerprints into
connected components.

A-Z are lower-cased; a word is a run without blanks; shingles are joined by one space. A
text of fewer words is one shingle; NULL and a text without words have fingerprint zero and
are linked like any other. Rows that repeat a doc_id are rows of their own. A component is
named by its smallest doc_id, NULL only if it has none. Texts are hashed in pieces, so a
task holds a few MB of one whatever its length, and texts are not shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import slices, utf8
from plumbline.llm.components import components
from plumbline.operators.skew import left_join_unique
from plumbline.session import materialize

SHINGLE = 3
SEED = 42
BITS = 64
DISTANCE = 3
BLOCKS = DISTANCE + 1
BUCKET = 4096
PIECE_BYTES = 1 << 20

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BLANK = re.compile(rb"[ \t-\r]")


def _hashes(words: list[bytes]) -> np.ndarray:
    """The hashes of all runs of SHINGLE words."""
    joined = b" ".join(words)
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    n, digest = len(words) - SHINGLE + 1, xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[SHINGLE:])), np.uint64, max(n, 0))


def shingle_hashes(text) -> Iterator[np.ndarray]:
    """The hashes of a text's shingles, piece by piece; none for a text without words."""
    held, start, some = [], 0, False
    while start < len(text):
        blank = _BLANK.search(text, start + PIECE_BYTES) if start + PIECE_BYTES < len(text) else None
        stop = blank.start() if blank else len(text)
        words = held + bytes(text[start:stop]).translate(_LOWER).split()
        if len(words) >= SHINGLE:
            some = True
            yield _hashes(words)
            held = words[1 - SHINGLE :]
        else:
            held = words
        start = stop
    if held and not some:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def fingerprints(texts: list) -> np.ndarray:
    """The fingerprint of each text, as 64 unsigned bits."""
    ones, total = np.zeros((len(texts), BITS), np.int64), np.zeros(len(texts), np.int64)
    held, owners = [], []

    def count():
        if held:
            bits = np.unpackbits(np.concatenate(held).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
            sizes = np.array([len(h) for h in held])
            np.add.at(ones, owners, np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.int64))
            np.add.at(total, owners, sizes)
            held.clear(), owners.clear()

    for i, text in enumerate(texts):
        for h in shingle_hashes(text):
            held.append(h)
            owners.append(i)
            if sum(map(len, held[-1:])) * BITS >= PIECE_BYTES:
                count()
    count()
    return np.packbits((2 * ones > total[:, None]).astype(np.uint8), axis=1).view("<u8").ravel()


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches, "text", PIECE_BYTES):
        data, at = utf8(piece.column("text"))
        held = memoryview(np.ascontiguousarray(data))
        fp = fingerprints([held[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())])
        yield pa.RecordBatch.from_arrays([piece.column("row_id"), pa.array(fp.view(np.int64))], ["row_id", "fp"])


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: each member with the least one it is tied to inside."""
    held = np.empty((0, 3), np.int64)
    for batch in batches:
        held = np.concatenate([held, np.column_stack([batch.column(c).to_numpy() for c in ("mask", "value", "fp")])])
        edges = np.flatnonzero((held[1:, :2] != held[:-1, :2]).any(axis=1)) + 1
        if len(edges):
            yield _tied(held[:, 2], [0, *edges.tolist()])
            held = held[edges[-1] :]
    if len(held):
        yield _tied(held[:, 2], [0, len(held)])


def _tied(fps: np.ndarray, edges: list[int]) -> pa.RecordBatch:
    """Each bucket walked from its least member: what is met is left out of later
    comparisons, and no pair is kept."""
    a, b = [], []
    for start, stop in zip(edges, edges[1:]):
        rest = fps[start:stop].view(np.uint64) if fps.flags.c_contiguous else fps[start:stop].copy().view(np.uint64)
        while len(rest) > 1:
            first, rest = rest[0], rest[1:]
            queue = [first]
            while queue and len(rest):
                close = np.bitwise_count(rest ^ queue.pop()) <= DISTANCE
                if close.any():
                    met = rest[close]
                    a.append(np.full(len(met), first))
                    b.append(met)
                    queue.extend(met)
                    rest = rest[~close]
    join = lambda x: pa.array((np.concatenate(x) if x else np.empty(0, np.uint64)).view(np.int64))
    return pa.RecordBatch.from_arrays([join(a), join(b)], ["a", "b"])


def _finer(mask: int) -> list[int]:
    """The masks that add one of BLOCKS blocks of the free bits to a mask."""
    free = [i for i in range(BITS) if not mask >> i & 1]
    cuts = [len(free) * k // BLOCKS for k in range(BLOCKS + 1)]
    return [mask | sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def _as_long(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def close_links(marks: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that tie together all fingerprints ``fp`` (distinct rows) that are joined
    by steps of at most DISTANCE bits."""
    if bucket < 1 << BLOCKS - 1:
        raise ValueError("A bucket with fewer free bits than blocks cannot be cut")
    spark, links = marks.sparkSession, None
    first = F.array(*[F.lit(_as_long(m)) for m in _finer(0)])
    members = marks.select("fp", F.explode(first).alias("mask"))
    while True:
        members = materialize(members.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp"))
        sizes = members.groupBy("mask", "value").agg(F.count("*").alias("size")).where("size > 1")
        sized = materialize(left_join_unique(members, sizes, ["mask", "value"], spread_by=["fp"]).where("size > 1"))
        dealt = sized.where(F.col("size") <= bucket).repartition("mask", "value").sortWithinPartitions("mask", "value", "fp")
        found = materialize(dealt.select("mask", "value", "fp").mapInArrow(_stars, "a long, b long"))
        links = found if links is None else links.unionByName(found)
        crowded = sized.where(F.col("size") > bucket).select("mask", "fp")
        # at most BLOCKS ** level masks, and a level fixes a quarter of the free bits: with 4,096
        # members a bucket there are at most 4 ** 6 of them
        masks = [r.mask for r in crowded.select("mask").distinct().collect()]
        if not masks:
            return links.distinct()
        steps = [(m, _as_long(f)) for m in masks for f in _finer(m % (1 << BITS))]
        finer = F.broadcast(spark.createDataFrame(steps, "mask long, finer long"))
        members = crowded.join(finer, "mask").select("fp", F.col("finer").alias("mask"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """(row_id, fp, component_id) per row of ``docs``."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("row_id"), F.col(f"`{text}`").alias("text"))
    signed = materialize(rows.mapInArrow(_signed, "row_id long, fp long"))
    marks = materialize(signed.groupBy("fp").agg(F.min("row_id").alias("least")))
    found = components(close_links(marks.select("fp"), bucket), "a", "b")
    labelled = materialize(marks.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("label")))
    names = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = left_join_unique(labelled, names, ["label"], spread_by=["fp"])
    return left_join_unique(signed, named.select("fp", "component_id"), ["fp"], spread_by=["row_id"])


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``."""
    return near_duplicates(docs, doc_id, text).select(F.col("row_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
