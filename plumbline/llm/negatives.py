"""Hard negatives by exact search in a GNAT-style multiway hyperplane tree.

A node of the tree has SPLITS split points; a vector goes to the nearest one (the
hyperplanes between them bound the subtrees). For each split point the node stores the
least and greatest distance to the vectors of each subtree. A search for the vectors in an
annulus around an anchor (a ball, or a window of scores) leaves out a subtree if for any
split point its distance range, widened by the distance of the anchor, misses the annulus.
What is left are leaves, whose vectors are all scored.

Scores are inner products, so vectors get one more component that gives all the same
length; then a higher score is a smaller distance. Split points are chosen from at most
SAMPLE vectors (the smallest hashes of their ids); that steers the speed only: every
vector is in the tree, ranges are taken over all, and the result is exact.

Three passes over the leaves: each anchor's own leaf gives a bound on its last positive, the
leaves that the bound leaves open complete the positives, and then the leaves that the
positives' windows touch give the negatives. A leaf is cut into blocks of vectors and its
anchors into blocks of anchors, so a task holds one block of each; a task hands on the
first few rows of each window only.

Rows without an id, label, vector, or with a NULL or non-finite component take no part.
Vectors of different lengths are filled up with zeros. Scores and components have to fit a
long. A row that repeats the anchor's id is not its positive; an anchor row that repeats
whole counts once, other repeated rows are rows of their own. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import materialize

SPLITS = 8
LEVELS = 2
SAMPLE = 4096
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100  # percent of the positive's score

ROW_BLOCK = 16_384
ANCHOR_BLOCK = 8_192
SCORES_AT_ONCE = 1 << 22

_NONE = np.iinfo(np.int64).min


def prepared(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, q) of the rows that take part: labels shifted where the contract
    says so, components as whole numbers."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    usable = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"), shifted.cast("long").alias("label"), whole.alias("q")
    )


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of whole numbers as rows, filled up with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.asarray(lists.flatten(), np.int64)
    out = np.zeros((len(lists), max(width, 1)), np.int64)
    row = np.repeat(np.arange(len(lists)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


@dataclass(frozen=True)
class Tree:
    """Split points per node, level by level. Node 0 is the root; child k of a node n is
    n * splits + k + 1; the nodes below the last level are the leaves."""

    width: int
    square: float  # the greatest squared length of all vectors
    points: dict[int, np.ndarray]
    splits: int

    def lengthened(self, q: np.ndarray, anchors: bool = False) -> np.ndarray:
        """Vectors with the component that gives them equal length; 0 for anchors, which
        turns distances into scores."""
        x = q.astype(np.float64)
        more = np.zeros(len(x)) if anchors else np.sqrt(np.maximum(self.square - (x * x).sum(axis=1), 0))
        return np.column_stack([x, more])

    def distances(self, node: int, x: np.ndarray) -> np.ndarray:
        p = self.points[node]
        square = (x * x).sum(axis=1)[:, None] + (p * p).sum(axis=1) - 2 * x @ p.T
        return np.sqrt(np.maximum(square, 0))

    def descend(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Node by node: which rows are in it, their distances, and the subtree each takes."""
        at = np.zeros(len(x), np.int64)
        for node in sorted(self.points):
            rows = np.flatnonzero(at == node)
            if len(rows):
                d = self.distances(node, x[rows])
                child = d.argmin(axis=1)
                at[rows] = node * self.splits + child + 1
                yield node, rows, d, child

    def leaf(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        for node, rows, _, child in self.descend(x):
            at[rows] = node * self.splits + child + 1
        return at


def plant(sample: np.ndarray, width: int, square: float, splits: int = SPLITS, levels: int = LEVELS) -> Tree:
    """A tree over a sample: the split points of a node are far from each other."""
    tree = Tree(width, square, {}, splits)
    x = tree.lengthened(sample)
    level = {0: x}
    for _ in range(levels):
        below = {}
        for node, held in level.items():
            if not len(held):
                held = x
            chosen, away = [0], ((held - held[0]) ** 2).sum(axis=1)
            while len(chosen) < splits:
                chosen.append(int(away.argmax()))
                away = np.minimum(away, ((held - held[chosen[-1]]) ** 2).sum(axis=1))
            tree.points[node] = held[chosen]
            child = tree.distances(node, held).argmin(axis=1)
            below |= {node * splits + k + 1: held[child == k] for k in range(splits)}
        level = below
    return tree


def _placer(tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = matrix(batch.column("q"), tree.width)
            leaf = tree.leaf(tree.lengthened(q))
            raw = pa.array([r.tobytes() for r in _narrow(q)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(leaf), raw], ["vec_id", "label", "leaf", "raw"])

    return run


def _narrow(q: np.ndarray) -> np.ndarray:
    """Two bytes a component where that holds them all, else eight."""
    return q.astype("<i2") if np.abs(q).max(initial=0) < 1 << 15 else q.astype("<i8")


def _wide(raw: pa.Array, width: int) -> np.ndarray:
    """The rows that ``_narrow`` wrote; a table may hold both kinds."""
    raw = raw.combine_chunks() if isinstance(raw, pa.ChunkedArray) else raw
    out = np.empty((len(raw), max(width, 1)), np.int64)
    size = pc.binary_length(raw).to_numpy(zero_copy_only=False)
    for bytes_each, kind in ((2, "<i2"), (8, "<i8")):
        rows = np.flatnonzero(size == bytes_each * out.shape[1])
        if len(rows):
            out[rows] = np.frombuffer(b"".join(raw.take(pa.array(rows)).to_pylist()), kind).reshape(len(rows), -1)
    return out


def _ranger(tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Least and greatest distances from split point i of a node to its subtree j."""
        low = {n: np.full((tree.splits, tree.splits), np.inf) for n in tree.points}
        high = {n: np.full((tree.splits, tree.splits), -1.0) for n in tree.points}
        for batch in batches:
            for node, _, d, child in tree.descend(tree.lengthened(_wide(batch.column("raw"), tree.width))):
                for j in np.unique(child):
                    low[node][:, j] = np.minimum(low[node][:, j], d[child == j].min(axis=0))
                    high[node][:, j] = np.maximum(high[node][:, j], d[child == j].max(axis=0))
        found = [(n, i, j, low[n][i, j], high[n][i, j]) for n in low for i in range(tree.splits) for j in range(tree.splits) if high[n][i, j] >= 0]
        names = ["node", "i", "j", "low", "high"]
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate([pa.int64()] * 3 + [pa.float64()] * 2)], names)

    return run


@dataclass(frozen=True)
class Ranges:
    """The tree with the distance ranges of all vectors."""

    tree: Tree
    low: dict[int, np.ndarray]
    high: dict[int, np.ndarray]

    def leaves(self, anchors: np.ndarray, least: np.ndarray, most: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Leaf by leaf, the anchors for which it may hold a score from least to most."""
        x = self.tree.lengthened(anchors, anchors=True)
        square = (x * x).sum(axis=1) + self.tree.square
        # a distance is the root of the squares less twice the score; with room for rounding
        room = 1e-6 * np.sqrt(square) + 1e-3
        far = np.sqrt(np.maximum(square - 2 * least.astype(np.float64), 0)) + room
        near = np.sqrt(np.maximum(square - 2 * np.minimum(most.astype(np.float64), square / 2), 0)) - room
        open_ = {0: np.arange(len(x))}
        for node in sorted(self.tree.points):
            rows = open_.pop(node, np.empty(0, np.int64))
            if not len(rows):
                continue
            d, low, high = self.tree.distances(node, x[rows]), self.low[node], self.high[node]
            for j in range(self.tree.splits):
                if high[0, j] < 0:
                    continue  # an empty subtree
                closest = np.maximum(np.maximum(d - high[:, j], low[:, j] - d), 0)
                furthest = d + high[:, j]
                kept = rows[((closest <= far[rows, None]) & (furthest >= near[rows, None])).all(axis=1)]
                child = node * self.tree.splits + j + 1
                if child in self.tree.points:
                    open_[child] = kept
                elif len(kept):
                    yield child, kept


def _first_rows(score: np.ndarray, ids: np.ndarray, allowed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line of scores, where its first ``n`` allowed entries stand: by score from the
    highest, ties by id. ``ids`` are ascending."""
    held = np.where(allowed, score, _NONE)
    if held.shape[1] > n:
        floor = np.partition(held, held.shape[1] - n, axis=1)[:, held.shape[1] - n]
        allowed = allowed & (held >= floor[:, None])
    line, place = np.nonzero(allowed)
    order = np.lexsort((place, -held[line, place], line))
    line, place = line[order], place[order]
    start = np.searchsorted(line, np.arange(len(score)))
    first = np.arange(len(line)) - start[line] < n
    return line[first], place[first]


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products; in floating point where every sum fits its 53 bits."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _window(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest score from LOW to HIGH percent of p, without a product that
    leaves 64 bits."""
    whole, rest = np.divmod(p, 100)
    return LOW * whole - (-LOW * rest) // 100, HIGH * whole + HIGH * rest // 100


def _searcher(width: int, windows: int, n: int):
    """Scores a block of vectors against a block of anchors. With ``windows``, an anchor has
    a list of that many positive scores at most and takes rows of other labels in the window
    below each; else the other rows of its label."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        names = ["anchor", "window", "vec_id", "score"]
        out: list[list[np.ndarray]] = [[], [], [], []]
        if rows.num_rows and anchors.num_rows:
            rows = rows.sort_by("vec_id")
            ids, labels, q = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), _wide(rows.column("raw"), width)
            key, own, label, a = (*(anchors.column(c).to_numpy() for c in ("anchor", "anchor_id", "label")), _wide(anchors.column("raw"), width))
            tops = anchors.column("tops").to_pylist()
            step = max(1, SCORES_AT_ONCE // len(ids))
            for s in range(0, len(key), step):
                part = slice(s, s + step)
                score = _scores(a[part], q)
                same = labels[None, :] == label[part, None]
                if windows:
                    top = np.array([t + [None] * (windows - len(t)) for t in tops[part]], object)
                    tasks = []
                    for w in range(windows):
                        given = np.array([x is not None for x in top[:, w]])
                        p = np.where(given, top[:, w], 0).astype(np.int64)[:, None]
                        low, high = _window(p)
                        tasks.append(~same & given[:, None] & (low <= score) & (score <= high))
                else:
                    tasks = [same & (ids[None, :] != own[part, None])]
                for w, allowed in enumerate(tasks):
                    line, place = _first_rows(score, ids, allowed, n)
                    for held, found in zip(out, (key[part][line], np.full(len(line), w), ids[place], score[line, place])):
                        held.append(found)
        return pa.table([pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64()) for x in out], names)

    return run


def _visitor(ranges: Ranges, kind: str):
    """The leaves each anchor has to look at: its own ('home'), all others that may hold a
    score from ``least`` up ('rest'), or all that may hold one from ``least`` to ``most``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a = _wide(batch.column("raw"), ranges.tree.width)
            home = ranges.tree.leaf(ranges.tree.lengthened(a))
            if kind == "home":
                pairs = [(int(leaf), np.flatnonzero(home == leaf)) for leaf in np.unique(home)]
            else:
                least, most = (batch.column(c).to_numpy() for c in ("least", "most"))
                pairs = [(leaf, rows[home[rows] != leaf] if kind == "rest" else rows) for leaf, rows in ranges.leaves(a, least, most)]
            at = np.concatenate([rows for _, rows in pairs]) if pairs else np.empty(0, np.int64)
            leaf = np.repeat([leaf for leaf, _ in pairs], [len(rows) for _, rows in pairs]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("anchor").take(pa.array(at)), pa.array(leaf)], ["anchor", "leaf"])

    return run


def _grid(counts: DataFrame, size: int, name: str) -> DataFrame:
    """The number of blocks per leaf; a row per leaf of the tree."""
    return counts.groupBy("leaf").agg(F.ceil(F.count("*") / size).cast("int").alias(name))


def _block(key: str, n: str) -> Column:
    return F.expr(f"cast(pmod(xxhash64({key}), {n}) AS int)")


def _search(index: DataFrame, sizes: DataFrame, anchors: DataFrame, ranges: Ranges, kind: str, n: int, windows: int = 0) -> DataFrame:
    """(anchor, window, vec_id, score): the first ``n`` of every window that each pair of
    blocks holds. ``anchors`` has anchor, anchor_id, label, raw, tops, least and most."""
    visits = materialize(anchors.select("anchor", "raw", "least", "most").mapInArrow(_visitor(ranges, kind), "anchor long, leaf long"))
    grid = F.broadcast(sizes.join(_grid(visits, ANCHOR_BLOCK, "high"), "leaf"))  # a row per leaf of the tree
    rows = index.join(grid, "leaf").select("leaf", _block("row", "wide").alias("x"), F.explode(F.expr("sequence(0, high - 1)")).alias("y"), "vec_id", "label", "raw")
    asked = visits.join(grid, "leaf").join(anchors, "anchor")
    asked = asked.select("leaf", F.explode(F.expr("sequence(0, wide - 1)")).alias("x"), _block("anchor", "high").alias("y"), "anchor", "anchor_id", "label", "raw", "tops")
    search = _searcher(ranges.tree.width, windows, n)
    return rows.groupBy("leaf", "x", "y").cogroup(asked.groupBy("leaf", "x", "y")).applyInArrow(search, "anchor long, window long, vec_id long, score long")


def _best(found: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of each window, with their rank from 1."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def hard_negatives(vectors: DataFrame, anchors: Column, splits: int = SPLITS, levels: int = LEVELS, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the
    rows of ``vectors`` (vec_id, label, q) that ``anchors`` picks."""
    square = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    width, most = vectors.agg(F.max(F.size("q")), F.max(square)).first()
    width, most = width or 0, most or 0.0
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "label").limit(SAMPLE).select("q").toArrow()  # at most SAMPLE rows
    tree = plant(matrix(sample.column("q"), width) if sample.num_rows else np.zeros((1, max(width, 1)), np.int64), width, most, splits, levels)
    index = materialize(vectors.mapInArrow(_placer(tree), "vec_id long, label long, leaf long, raw binary").withColumn("row", F.monotonically_increasing_id()))
    held = index.select("raw").mapInArrow(_ranger(tree), "node long, i long, j long, low double, high double")
    low = {node: np.full((splits, splits), np.inf) for node in tree.points}
    high = {node: np.full((splits, splits), -1.0) for node in tree.points}
    for r in held.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():  # splits squared per node
        low[r.node][r.i, r.j], high[r.node][r.i, r.j] = r.low, r.high
    ranges = Ranges(tree, low, high)
    sizes = materialize(_grid(index, ROW_BLOCK, "wide"))

    picked = index.where(anchors).select(F.col("vec_id").alias("anchor_id"), "label", "raw").distinct()
    picked = materialize(picked.withColumn("anchor", F.monotonically_increasing_id()))
    none, lowest, highest = F.expr("cast(array() AS array<long>)"), F.lit(_NONE).cast("long"), F.lit(-1 - _NONE).cast("long")

    home = materialize(_search(index, sizes, picked.select("*", none.alias("tops"), lowest.alias("least"), highest.alias("most")), ranges, "home", positives))
    bound = _best(home, positives).where(F.col("rank") == positives).select("anchor", F.col("score").alias("least"))
    bounded = materialize(picked.join(bound, "anchor", "left").select("anchor", "anchor_id", "label", "raw", none.alias("tops"), F.coalesce("least", lowest).alias("least"), highest.alias("most")))
    rest = _search(index, sizes, bounded, ranges, "rest", positives)
    chosen = materialize(_best(home.unionByName(rest), positives).select("anchor", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))

    ordered = F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda x: x["positive_score"])
    windows = chosen.groupBy("anchor").agg(ordered.alias("tops"), F.max("positive_score").alias("most"), F.min("positive_score").alias("last"))
    # windows of scores below zero are empty
    asked = materialize(picked.join(windows.where("most >= 0"), "anchor").select("*", F.expr(f"cast(floor(greatest(last, 0) * {LOW}D / 100) AS long)").alias("least")))
    found = _best(_search(index, sizes, asked, ranges, "windows", negatives, positives), negatives)
    named = found.join(chosen, (found.anchor == chosen.anchor) & (found.window + 1 == chosen.place)).drop(chosen.anchor)
    return named.join(picked.select("anchor", "anchor_id"), "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def report(vectors: DataFrame) -> DataFrame:
    """Hard negatives of the rows whose vec_id is divisible by 100."""
    return hard_negatives(materialize(prepared(vectors)), F.col("vec_id") % 100 == 0)
