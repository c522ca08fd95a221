"""MinHash near-dedup with odd sketches.

A text becomes the set of its five-word shingles (A-Z lower-cased). Equal sets are one
class. Bands of MinHash samples are the buckets of a class; classes that share a bucket
are candidates.

The odd sketch of a class folds its smallest hashes, all of them in a set of fewer than
2 * SAMPLE shingles and a half, a quarter, ... in larger ones, into a parity bitmap. Two
bitmaps differ in at most as many bits as the folded sets differ in hashes, so a pair that
differs in more than its sizes allow is dropped without loss; for sampled sets the bound
has eight standard deviations of slack. What is left is confirmed on the full sets, and
the links form connected components.

* A pair at the threshold of ``percent`` shares no bucket with a probability of
  (1 - 0.85**4)**32 = 6e-11 at 85 and (1 - 0.8**4)**32 = 5e-8 at 80.
* In a bucket every class is first compared with one centre, the class whose buckets are
  the fullest, not with all others. Only in buckets that still hold several components do
  the left-over classes meet the rest, in blocks of bounded size, by their sketches; a
  block hands on at most one pair per component that it could join. If any of these is
  not confirmed, one more round hands on all pairs that are still open.

NULL texts and texts without words have no shingles and are linked with nothing. Fewer
than five words count as one shingle. Rows that repeat a doc_id are told apart by their
text; a component is named by its smallest doc_id, NULL only if it has none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import fresh, mixed, slices, utf8
from plumbline.llm.components import components
from plumbline.llm.repeats import keyed
from plumbline.llm.words import word_hashes
from plumbline.session import materialize

SHINGLE = 5
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
PERCENT = 85

SAMPLE = 1024
SKETCH_BITS = 2048
BLOCK = 2000

# Bitmaps of 32,768 bits that mark the rows of the compared classes: 2 MB, whatever the input.
BITMAPS = 512

_SIGNED = "row_id long, row_text long, node long, n_shingles long, bands array<long>, level int, sketch array<long>, half array<long>"
_FACTORS = (mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1))


def shingle_sets(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, text after text, sorted within a text, and how
    many precede each text."""
    words, first = word_hashes(data, at, fold=True)
    count = np.diff(first)
    n = np.where(count >= SHINGLE, count - SHINGLE + 1, np.minimum(count, 1))
    owner = np.repeat(np.arange(len(count)), n)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + first[owner]
    h = np.zeros(len(owner), np.uint64)
    for j in range(SHINGLE):
        inside = j < count[owner]
        word = words[np.minimum(start + j, max(len(words) - 1, 0))] if len(words) else h
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + np.where(inside, word, np.uint64(j + 1)))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(len(at)))


def _names(h: np.ndarray, first: np.ndarray) -> list[int | None]:
    """A 64-bit name for each set; None for an empty one."""
    raw = h.astype("<u8").tobytes()
    return [int.from_bytes(hashlib.blake2b(raw[8 * a : 8 * b], digest_size=8).digest(), "little", signed=True) if a < b else None for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


def bands_of(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Band hashes of the non-empty sets that start at ``starts``, one row each."""
    samples = np.empty((len(starts), SAMPLES), np.uint64)
    for i, factor in enumerate(_FACTORS):
        samples[:, i] = np.minimum.reduceat((h * factor) >> np.uint64(20), starts)
    bands = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(starts), 1))
    for j in range(ROWS):
        bands = mixed(bands * np.uint64(0x9E3779B97F4A7C15) + samples[:, j::ROWS])
    return bands.view(np.int64)


def levels(size: np.ndarray) -> np.ndarray:
    """How often a set's sample is halved: 0 below 2 * SAMPLE, one more for each doubling."""
    return np.maximum(np.frexp(np.maximum(size, 1) / SAMPLE)[1] - 1, 0).astype(np.int32)


def odd_sketches(h: np.ndarray, starts: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Parity bitmaps of the hashes below 2**(64 - level) of each set, one row each."""
    owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(h))))
    taken = (level[owner] == 0) | (h >> np.maximum(64 - level[owner], 1).astype(np.uint64) == 0)
    bit = (h[taken] & np.uint64(SKETCH_BITS - 1)).astype(np.int64) + owner[taken] * SKETCH_BITS
    odd = np.bincount(bit, minlength=len(starts) * SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(-1, 8), axis=1).reshape(len(starts), -1).view(np.int64)


def _lists(rows: np.ndarray, present: np.ndarray) -> pa.Array:
    width = rows.shape[1]
    offsets = np.concatenate([[0], np.cumsum(np.where(present, width, 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).ravel()))


def _signer(percent: int):
    least_half = 2 * SAMPLE * percent // 100  # sets of fewer shingles have no partner on the next level

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text"):
            h, first = shingle_sets(*utf8(piece.column("text")))
            size = np.diff(first)
            present = size > 0
            starts, level = first[:-1][present], levels(size)
            wide = size >= least_half
            if present.any():
                bands, sketch = bands_of(h, starts), odd_sketches(h, starts, level[present])
                half = odd_sketches(h, starts, level[present] + 1)[wide[present]]
            else:
                bands, sketch, half = (np.empty((0, n), np.int64) for n in (BANDS, SKETCH_BITS // 64, SKETCH_BITS // 64))
            columns = [pa.array(_names(h, first), pa.int64()), pa.array(size), _lists(bands, present), pa.array(level), _lists(sketch, present), _lists(half, wide)]
            names = ["node", "n_shingles", "bands", "level", "sketch", "half"]
            yield pa.RecordBatch.from_arrays([piece.column("row_id"), piece.column("row_text"), *columns], ["row_id", "row_text", *names])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches, "text"):
        h, first = shingle_sets(*utf8(piece.column("text")))
        yield pa.RecordBatch.from_arrays([piece.column("node"), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(h.view(np.int64)))], ["node", "shingles"])


def _marked(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows that are among ``keys`` by (row_id, row_text), and a few others: the hashes of
    the keys are bits of BITMAPS bitmaps, which go to every task. A join with ``keys`` then
    moves these rows only, not the texts of all."""
    place = F.pmod(F.xxhash64("row_id", "row_text"), F.lit(BITMAPS << 15))
    bits = keys.select(F.shiftright(place, 15).alias("bitmap"), place.bitwiseAND(32767).alias("bit")).groupBy("bitmap").agg(F.bitmap_construct_agg("bit").alias("bits"))
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.shiftright(place.bitwiseAND(32767), 3).cast("int") + 1, 1)), 16, 10).cast("int")
    held = F.getbit(byte, place.bitwiseAND(7).cast("int")) == 1
    return rows.join(F.broadcast(bits), (F.shiftright(place, 15) == F.col("bitmap")) & held, "left_semi")


def _differing_bits(a: Column, b: Column) -> Column:
    bits = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int"))
    return F.aggregate(bits, F.lit(0), lambda s, x: s + x)


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _close(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their sizes and sketches allow to be links."""
    named = lambda x: nodes.select(F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n_shingles", "level", "sketch", "half")])
    both = pairs.join(named("a"), "a").join(named("b"), "b").where(_sizes_fit("n_shingles_a", "n_shingles_b", percent))
    at_level = lambda x, y: F.when(F.col(f"level_{x}") < F.col(f"level_{y}"), F.col(f"half_{x}")).otherwise(F.col(f"sketch_{x}"))
    level = F.greatest("level_a", "level_b")
    most = F.floor((F.col("n_shingles_a") + F.col("n_shingles_b")) * (100 - percent) / (100 + percent))
    part = most / F.pow(F.lit(2.0), level)
    bound = F.when(level == 0, most.cast("double")).otherwise(part + 8 * F.sqrt(part) + 8)
    return both.where(_differing_bits(at_level("a", "b"), at_level("b", "a")) <= bound).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are links by their full sets."""
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    shared = both.select("a", "b", F.size("set_a").alias("n_a"), F.size("set_b").alias("n_b"), F.size(F.array_intersect("set_a", "set_b")).alias("n"))
    return shared.where(100 * F.col("n") >= percent * (F.col("n_a") + F.col("n_b") - F.col("n"))).select("a", "b")


def _bitmaps(column: pa.ChunkedArray) -> np.ndarray:
    """The bitmaps of all rows; zeros for an empty one."""
    array = column.combine_chunks()
    out = np.zeros((len(array), SKETCH_BITS // 64), np.uint64)
    held = pc.fill_null(pc.list_value_length(array), 0).to_numpy() > 0
    out[held] = np.asarray(array.flatten()).reshape(-1, SKETCH_BITS // 64).view(np.uint64)
    return out


def _crosser(thin: bool, percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Left-over classes of a bucket against a block of its classes, by their sketches.
        With ``thin``, only pairs that join components not yet joined here."""
        node, comp, n, level = (table.column(c).to_numpy() for c in ("node", "label", "n_shingles", "level"))
        loose = table.column("loose").to_numpy(zero_copy_only=False).astype(bool)
        sketch, half = _bitmaps(table.column("sketch")), _bitmaps(table.column("half"))
        parent = {c: c for c in comp.tolist()}

        def root(c):
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        rows = np.flatnonzero(~loose)
        found = []
        for i in np.flatnonzero(loose):
            able = rows[(comp[rows] != comp[i]) & (100 * np.minimum(n[rows], n[i]) >= percent * np.maximum(n[rows], n[i]))]
            up, down = level[able] > level[i], level[able] < level[i]
            mine = np.where(up[:, None], half[i], sketch[i])
            theirs = np.where(down[:, None], half[able], sketch[able])
            bits = np.bitwise_count(mine ^ theirs).sum(axis=1)
            most = ((n[able] + n[i]) * (100 - percent)) // (100 + percent)
            top = np.maximum(level[able], level[i])
            part = most / 2.0**top
            near = bits <= np.where(top == 0, most, part + 8 * np.sqrt(part) + 8)
            able, rest = able[near], (bits - most)[near]
            for j in able[np.argsort(rest, kind="stable")].tolist():
                if thin:
                    a, b = root(int(comp[i])), root(int(comp[j]))
                    if a == b:
                        continue
                    parent[a] = b
                found.append((int(node[i]), int(node[j])))
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs.min(axis=1) if len(pairs) else pairs[:, 0], "b": pairs.max(axis=1) if len(pairs) else pairs[:, 1]})

    return run


def _left_over_pairs(buckets: DataFrame, labels: DataFrame, nodes: DataFrame, thin: bool, percent: int) -> DataFrame:
    """Close pairs across components inside the buckets that hold several.

    In such a bucket the largest component is left alone; the classes of the others (the
    loose ones) meet all classes of the bucket. Both are split into blocks, so a group
    has at most about two blocks of rows however full the bucket is.
    """
    labelled = buckets.join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("label"))
    sizes = labelled.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    open_ = sizes.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("n").alias("all"), F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("most")).where("parts > 1")
    # stored, as the steps below read it four times: each would repeat all exchanges above, and
    # the driver keeps a thread and its memory for every exchange of a plan
    members = materialize(labelled.join(open_, "bucket").withColumn("loose", F.col("label") != F.col("main")))
    # one bucket of several with the same classes is enough
    same = members.groupBy("bucket").agg(F.expr("bit_xor(xxhash64(node))").alias("mark"), F.count("*").alias("n")).groupBy("mark", "n").agg(F.min("bucket").alias("bucket"))
    members = members.join(same.select("bucket"), "bucket", "left_semi").join(nodes, "node")
    blocks = members.selectExpr("*", f"cast(ceil(all / {BLOCK}) AS int) AS wide", f"cast(ceil((all - most) / {BLOCK}) AS int) AS high")
    columns = ("bucket", "node", "label", "n_shingles", "level", "sketch", "half")
    block = "pmod(xxhash64(node, 'x'), wide)", "pmod(xxhash64(node, 'y'), high)"
    plain = blocks.selectExpr(*columns, f"{block[0]} AS x", "explode(sequence(0, high - 1)) AS y", "false AS loose")
    loose = blocks.where("loose").selectExpr(*columns, "explode(sequence(0, wide - 1)) AS x", f"{block[1]} AS y", "true AS loose")
    grouped = plain.withColumn("x", F.col("x").cast("int")).unionByName(loose.withColumn("y", F.col("y").cast("int")), allowMissingColumns=False)
    return grouped.groupBy("bucket", "x", "y").applyInArrow(_crosser(thin, percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(row_id, row_text, n_shingles, component_id) per row of ``docs``; sets with a Jaccard
    similarity of ``percent`` or more are linked."""
    rows = keyed(docs, doc_id, text)
    signed = materialize(rows.mapInArrow(_signer(percent), _SIGNED))
    nodes = signed.where("node IS NOT NULL").groupBy("node").agg(F.min("row_id").alias("least"), F.min_by(F.struct("row_id", "row_text"), F.coalesce("row_id", "row_text")).alias("row"), F.first("n_shingles").alias("n_shingles"))
    nodes = materialize(nodes)
    chosen = signed.select("node", "row_id", "row_text", "n_shingles", "level", "sketch", "half")
    first = nodes.select(F.col("node").alias("the_node"), "row.row_id", "row.row_text")
    # the one row of each class, without its lists in a shuffle of all rows' keys
    entries = signed.where("node IS NOT NULL").select("node", F.explode("bands").alias("bucket"))
    full = entries.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high").select("bucket")
    buckets = materialize(entries.join(full, "bucket").distinct())

    able = buckets.select("node").distinct()
    keys = materialize(first.join(able, F.col("the_node") == F.col("node"), "left_semi"))
    same = F.col("r.row_id").eqNullSafe(F.col("k.row_id")) & (F.col("r.row_text") == F.col("k.row_text"))
    sketches = materialize(_marked(chosen, keys).alias("r").join(keys.alias("k"), same).select("r.node", "r.n_shingles", "r.level", "r.sketch", "r.half").dropDuplicates(["node"]))
    texts = _marked(rows, keys).alias("r").join(keys.alias("k"), same).select(F.col("the_node").alias("node"), "r.text")
    sets = materialize(texts.mapInArrow(_sets, "node long, shingles array<long>").dropDuplicates(["node"]))

    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("size"))
    pull = buckets.join(sizes, "bucket").groupBy("node").agg(F.sum("size").alias("pull"))
    pulled = buckets.join(pull, "node")
    centres = pulled.groupBy("bucket").agg(F.max_by("node", F.struct("pull", "node")).alias("a"))
    stars = buckets.join(centres, "bucket").where("a != node").select("a", F.col("node").alias("b")).distinct()
    links = materialize(_confirmed(_close(stars, sketches, percent), sets, percent))
    labels = components(links, "a", "b")
    asked = materialize(_left_over_pairs(buckets, labels, sketches, True, percent))
    more = materialize(_confirmed(asked, sets, percent))
    confirmed = more.count()
    # components go on from the ones found before; every step is a plan that the driver keeps
    found = components(labels.toDF("a", "b").unionByName(more), "a", "b") if confirmed else labels
    if asked.count() > confirmed:  # else every close pair is inside a component by now
        more = _confirmed(_left_over_pairs(buckets, found, sketches, False, percent), sets, percent)
        found = components(found.toDF("a", "b").unionByName(more), "a", "b")

    labelled = nodes.select("node", "least").join(found, "node", "left").select("node", "least", F.coalesce("component", "node").alias("label"))
    named = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = labelled.join(named, "label").select("node", "component_id")
    out = signed.select("row_id", "row_text", "node", "n_shingles").join(named, "node", "left")
    return out.select("row_id", "row_text", "n_shingles", F.when(F.col("node").isNull(), F.col("row_id")).otherwise(F.col("component_id")).alias("component_id"))


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs``."""
    kept = F.col("row_id").eqNullSafe(F.col("component_id"))
    return near_duplicates(docs, doc_id, text).select(F.col("row_id").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows whose doc_id names their component, columns unchanged: one document of each
    group stays. Rows that repeat that doc_id stay with it."""
    found = near_duplicates(docs, doc_id, text, percent).where(F.col("row_id").eqNullSafe(F.col("component_id")))
    mark = fresh("row_text_hash", docs)
    keys = found.select(F.col("row_id").alias(f"{mark}_id"), F.col("row_text").alias(f"{mark}_text"))
    same = F.col(f"`{doc_id}`").cast("long").eqNullSafe(F.col(f"{mark}_id")) & (F.col(mark) == F.col(f"{mark}_text"))
    return docs.withColumn(mark, F.xxhash64(f"`{text}`")).join(keys, same, "left_semi").drop(mark)
