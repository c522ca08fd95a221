"""Small helpers the text operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Separators of the word pattern [^\x20\x09-\x0D]+.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[ \\t-\\r]+"

# Text bytes handled at once inside a Python task.
SLICE_BYTES = 1 << 20


def share_code(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where the driver found it."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known.get("PYTHONPATH")]))
    return spark


def fresh(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, in any case."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_list(text: Column) -> Column:
    """The words of a text as an array; none for NULL and for text without words."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.expr("cast(array() AS array<string>)")).otherwise(F.split(trimmed, BLANK_RUN))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column end to end, and where each row starts (one entry more
    than rows). NULL is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    return data, at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of at most ``limit`` bytes of text; a longer text is a piece alone."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def gathered(pieces: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring pieces joined until they hold ``limit`` bytes of text."""
    held, size = [], 0
    for piece in pieces:
        held.append(piece)
        size += pc.sum(pc.binary_length(piece.column(text))).as_py() or 0
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if sum(p.num_rows for p in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit value made to depend on all of its bits."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def starts_of_runs(values: np.ndarray) -> np.ndarray:
    """Where a run of equal neighbours starts in a sorted array."""
    return np.flatnonzero(np.concatenate([np.ones(min(len(values), 1), bool), values[1:] != values[:-1]]))


def spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true entries."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
