"""Byte-level BPE in Spark's own expressions: ranked merges folded over byte arrays.

A text is cut into words by the tokenizer's pattern; a word is encoded by folding over
its bytes: each step looks up the rank of every neighbouring pair in a literal rank map
and merges the pair of the lowest rank, leftmost first. The id of a merged piece is its
rank.

Work is done once per distinct word where it pays. The corpus' parts (what stands
between spaces) are counted, and with them the words in them. The most frequent words (at
most MOST_WORDS of at most LONGEST bytes and as many ids each, usually some 10 MB
together) go through the fold as rows. Tasks look the words of their texts up in that
table, which is broadcast. All other words are merged where they stand by the same ranks in
Python, some thirty times as fast as the interpreted fold, so none is left out. Texts are
never shuffled, only the counts of distinct parts and words are.

Words over LONGEST bytes keep their pairs in a heap, so a long run of letters takes
n log n steps.

NULL encodes to no ids, as the empty text does.
"""

from __future__ import annotations

import base64
import json
import re
import uuid
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from plumbline.llm.common import fresh, let, slices
from plumbline.session import materialize

# The tokenizer's pattern, with the characters of Unicode white space spelled out.
_SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
PATTERN = rf" ?\p{{L}}+| ?\p{{N}}+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
# A space before anything but white space always starts a word.
CHUNK_START = rf"(?= [^{_SPACE}])"
MOST_WORDS = 1 << 17
LONGEST = 48
# Chunks a Python worker remembers, and characters of a text it cuts at once.
MOST_CHUNKS = 1 << 17
STRETCH = 1 << 20
# The same patterns as the regex module writes them.
_PYTHON_PATTERN, _PYTHON_CHUNK = (re.sub(r"\\x\{(\w+)\}", lambda m: chr(int(m[1], 16)), p) for p in (PATTERN, CHUNK_START))
_PYTHON_CHUNK = re.compile(_PYTHON_CHUNK)

# An entry of the pair table: left id + 1, then 20 bits of rank, then a spare bit.
_RANK = 1 << 20
_PAIR_SLOTS = 1 << 18
_PLACE = 1 << 24
_NONE = 1 << 60


@lru_cache(maxsize=4)
def _ranks(path: str) -> dict[bytes, int]:
    """The rank file: the rank of each piece is its id."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


@lru_cache(maxsize=4)
def _vocabulary(path: str) -> tuple[str, str, str, str]:
    """The rank file as literals (JSON): where each left id's row of pairs starts, the pairs,
    the id of each byte, and the hexadecimal bytes of each id.

    Rows of the sparse (left, right) table are laid over each other where they are empty.
    """
    ranks = _ranks(path)
    rows: dict[int, dict[int, int]] = defaultdict(dict)
    for token, rank in ranks.items():
        for cut_at in range(1, len(token)):
            left, right = ranks.get(token[:cut_at]), ranks.get(token[cut_at:])
            if left is not None and right is not None:
                rows[left][right] = rank
    most = max(ranks.values()) + 1
    start, slots = [0] * most, [0] * (_PAIR_SLOTS + most)
    for left, row in sorted(rows.items(), key=lambda x: -len(x[1])):
        at = left * 40503 % _PAIR_SLOTS
        while any(slots[at + right] for right in row):
            at = (at + 7919) % _PAIR_SLOTS
        start[left] = at
        for right, rank in row.items():
            slots[at + right] = (left + 1) * 2 * _RANK + 2 * rank
    pieces = [""] * most
    for token, rank in ranks.items():
        pieces[rank] = token.hex()
    return json.dumps(start), json.dumps(slots), json.dumps([ranks[bytes([b])] for b in range(256)]), json.dumps(pieces)


def _pair(start: Column, slots: Column, left: Column, right: Column, place: Column) -> Column:
    """Rank of a pair of ids, above its place in the word; _NONE for a pair that is no token."""
    slot = F.get(slots, (F.get(start, left.cast("int")) + right).cast("int"))
    return F.when(F.shiftright(slot, 21) == left + 1, F.shiftleft(slot.bitwiseAND(F.lit(2 * _RANK - 1)), 24)).otherwise(F.lit(_NONE)).bitwiseOR(place)


def _pairs(start: Column, slots: Column, ids: Column) -> Column:
    inner = F.slice(ids, F.lit(1), F.greatest(F.size(ids) - 1, F.lit(0)))
    return F.transform(inner, lambda left, i: _pair(start, slots, left, F.get(ids, i + 1), i.cast("long")))


def _id(pair: Column) -> Column:
    return F.shiftright(pair, 25).bitwiseAND(F.lit(_RANK - 1))


def _merge_one(start: Column, slots: Column, ids: Column, pairs: Column, low: Column) -> Column:
    """The pair ``low`` merged; only the pairs on its two sides are looked up anew."""

    def at_place(k: Column) -> Column:
        merged, size = _id(low), F.size(ids)
        before = F.when(k > 1, F.array(_pair(start, slots, F.get(ids, k - 2), merged, F.get(pairs, k - 2).bitwiseAND(F.lit(_PLACE - 1)))))
        after = F.when(k < size - 1, F.array(_pair(start, slots, merged, F.get(ids, k + 1), low.bitwiseAND(F.lit(_PLACE - 1)))))
        none = F.expr("cast(array() AS array<bigint>)")
        return F.struct(
            F.concat(F.slice(ids, F.lit(1), k - 1), F.array(merged), F.slice(ids, k + 2, size)).alias("ids"),
            F.concat(F.slice(pairs, F.lit(1), F.greatest(k - 2, F.lit(0))), F.coalesce(before, none), F.coalesce(after, none), F.slice(pairs, k + 2, size)).alias("pairs"),
        )

    return let(F.array_position(pairs, low).cast("int"), at_place)


def _fold(start: Column, slots: Column, ids: Column) -> Column:
    """Merges until no pair has a rank; the steps that remain then do nothing."""

    def step(state: Column, _: Column) -> Column:
        def merge(low: Column) -> Column:
            args = start, slots, state["ids"], state["pairs"], low
            done = F.struct(state["ids"].alias("ids"), F.expr("cast(array() AS array<bigint>)").alias("pairs"))
            return F.when(low >= _NONE, done).otherwise(_merge_one(*args))

        return F.when(F.size(state["pairs"]) == 0, state).otherwise(let(F.array_min(state["pairs"]), merge))

    steps = F.sequence(F.lit(1), F.greatest(F.size(ids) - 1, F.lit(1)))
    return F.aggregate(steps, F.struct(ids.alias("ids"), _pairs(start, slots, ids).alias("pairs")), step)["ids"]


def _constant(spark: SparkSession, **parts: tuple[str, str]) -> Column:
    """One constant struct of nested values given as (JSON, type). As a scalar subquery it is
    parsed once, and planning does not walk through its entries."""
    row = spark.createDataFrame([tuple(text for text, _ in parts.values())], ", ".join(f"{name} string" for name in parts))
    return row.select(F.struct(*[F.from_json(name, kind).alias(name) for name, (_, kind) in parts.items()])).scalar()


def with_constants(df: DataFrame, into: str, constants: dict[str, Column], body) -> DataFrame:
    """``df`` with a column ``into``: ``body`` of the constants, each bound once.

    Subqueries may not stand inside lambdas, so they start as columns; each is used in one
    place, which lets the planner put it there instead of carrying it along with the rows.
    """
    names = {key: fresh(f"constant_{key}", df) for key in constants}

    def bind(keys: list[str], bound: dict[str, Column]) -> Column:
        if not keys:
            return body(bound)
        return let(F.col(names[keys[0]]), lambda v: bind(keys[1:], bound | {keys[0]: v}))

    held = df.select("*", *[c.alias(names[key]) for key, c in constants.items()])
    return held.withColumn(into, bind([*constants], {})).drop(*names.values())


def merges(spark: SparkSession, path: str) -> Column:
    """The rank map and the ids of single bytes, as one constant."""
    start, slots, single, _ = _vocabulary(path)
    longs = "array<bigint>"
    return _constant(spark, start=(start, longs), slots=(slots, longs), single=(single, longs))


def encode_word(v: Column, word: Column) -> Column:
    """Ids of one word by the fold, as an array of longs; ``v`` is the constant of ``merges``."""
    letters = F.split(F.decode(word.cast("binary"), "ISO-8859-1"), "")
    return let(F.transform(letters, lambda c: F.get(v["single"], F.ascii(c))), lambda ids: _fold(v["start"], v["slots"], ids))


def cut(text: Column) -> Column:
    """The words of a text by the tokenizer's pattern; their concatenation is the text."""
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def _frequent(counted: DataFrame, most: int) -> DataFrame:
    """The words of (word, n) above the lowest half power of two that leaves at most
    ``most`` of them. The driver sees one number per level."""
    levelled = counted.where(f"octet_length(word) BETWEEN 1 AND {LONGEST}").select("word", F.floor(2 * F.log2("n")).cast("int").alias("level"))
    total, least = 0, None
    per_level = {r["level"]: r["count"] for r in levelled.groupBy("level").count().collect()}
    for at in sorted(per_level, reverse=True):
        total += per_level[at]
        if total > most:
            break
        least = at
    return levelled.where(F.lit(False) if least is None else F.col("level") >= least).select("word")


def frequent_words(docs: DataFrame, path: str, text: str = "text", most: int = MOST_WORDS) -> bytes:
    """The frequent words of a corpus and their ids, as an Arrow stream: at most ``most``
    words of at most LONGEST bytes. Their distinct rows go through the fold."""
    spark = docs.sparkSession
    # cut at every space, as words that this shows otherwise than the pattern are merged later
    parts = F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), " ")
    found = docs.select(F.explode(parts).alias("part")).groupBy("part").agg(F.count("*").alias("n")).select(F.concat(F.lit(" "), "part").alias("word"), "n")
    words = found.select(F.explode(cut(F.col("word"))).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("n"))
    kept = _frequent(materialize(words), most)
    spread = kept.repartition(2 * spark.sparkContext.defaultParallelism, "word")
    coded = with_constants(spread, "ids", {"m": merges(spark, path)}, lambda c: encode_word(c["m"], F.col("word")))
    table = coded.select(F.col("word").cast("binary"), "ids").toArrow()
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as stream:
        stream.write_table(table)
    return out.getvalue().to_pybytes()


def _word_table(stream: bytes) -> dict[str, bytes]:
    """Words and their ids as 64-bit numbers, from ``frequent_words``."""
    table = {}
    for batch in pa.ipc.open_stream(stream):
        ids = batch.column("ids")
        raw, ends = ids.flatten().to_numpy().tobytes(), np.cumsum(pc.list_value_length(ids).to_numpy()) * 8
        start = 0
        for word, end in zip(batch.column("word").to_pylist(), ends.tolist()):
            table[word.decode()] = raw[start:end]
            start = end
    return table


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the neighbouring pieces whose union ranks lowest are merged first,
    leftmost first."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > LONGEST:
        return _merged_by_heap(word, ranks)
    pieces = [word[i : i + 1] for i in range(len(word))]
    rank = [ranks.get(word[i : i + 2], _NONE) for i in range(len(word) - 1)]
    while (low := min(rank, default=_NONE)) < _NONE:
        i = rank.index(low)
        pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
        del rank[i]
        if i:
            rank[i - 1] = ranks.get(pieces[i - 1] + pieces[i], _NONE)
        if i < len(rank):
            rank[i] = ranks.get(pieces[i] + pieces[i + 1], _NONE)
    return [ranks[piece] for piece in pieces]


def _merged_by_heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same in n log n steps: a heap holds the pairs."""
    n = len(word)
    end, before = [*range(1, n + 1)], [*range(-1, n)]
    pairs = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(word[i : i + 2])) is not None]
    heapify(pairs)
    while pairs:
        _, start, stop = heappop(pairs)
        middle = end[start]
        if not middle or middle >= n or end[middle] != stop:
            continue  # one of the two has been merged with another since
        end[start], end[middle], before[stop] = stop, 0, start
        if start and (rank := ranks.get(word[before[start] : stop])) is not None:
            heappush(pairs, (rank, before[start], stop))
        if stop < n and (rank := ranks.get(word[start : end[stop]])) is not None:
            heappush(pairs, (rank, start, end[stop]))
    return [ranks[word[i:j]] for i, j in enumerate(end) if j]


# What a Python worker has unpacked last; its tasks of one job share it.
_UNPACKED: dict[str, Callable[[list[str]], bytes]] = {}


def _chunk_coder(name: str, shared) -> Callable[[list[str]], bytes]:
    """The ids of chunks, as 64-bit numbers. Words that are not in the table
    are merged here; the chunks a task meets over and over are remembered."""
    if name not in _UNPACKED:
        stream, ranks = shared.value
        table, words = _word_table(stream), regex.compile(_PYTHON_PATTERN).findall

        def alone(word: str) -> bytes:
            return array("q", merged(word.encode(), ranks)).tobytes()

        def one(chunk: str) -> bytes:
            if chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha()):
                return alone(chunk)  # letters only: one word, and not in the table
            return b"".join([table.get(word) or alone(word) for word in words(chunk)])

        remembered = lru_cache(maxsize=MOST_CHUNKS)(one)

        def coded(found: list[str]) -> bytes:
            return b"".join([ids or (remembered if len(x) <= LONGEST else one)(x) for ids, x in zip(map(table.get, found), found)])

        _UNPACKED.clear()
        _UNPACKED[name] = coded
    return _UNPACKED[name]


def _stretches(text: str) -> Iterator[str]:
    """A text in stretches of some STRETCH characters, cut where a chunk starts."""
    at = 0
    while at < len(text):
        found = _PYTHON_CHUNK.search(text, at + STRETCH)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "ids", most: int = MOST_WORDS) -> DataFrame:
    """``docs`` with the ids of ``text`` as an array column ``into``."""
    name = uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast((frequent_words(docs, path, text, most), _ranks(path)))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = _chunk_coder(name, shared)
        for batch in slices(batches, text):
            texts = pc.fill_null(batch.column(text).cast(pa.binary()), b"").to_pylist()
            found = [b"".join(coded(_PYTHON_CHUNK.split(s)) for s in _stretches(t.decode("utf-8", "replace"))) for t in texts]
            ends = np.cumsum([0, *map(len, found)]) // 8
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, into])

    return docs.mapInArrow(look_up, StructType([*docs.schema, StructField(into, ArrayType(LongType()))]))


def decode(df: DataFrame, ids: str, path: str, into: str = "decoded") -> DataFrame:
    """``df`` with the bytes that ids stand for: their binary pieces one after the other.

    The pieces are a literal, not a subquery: as a column of its own next to the ids, that
    would be copied into every row.
    """
    pieces = F.from_json(F.lit(_vocabulary(path)[3]), "array<string>")
    joined = let(pieces, lambda p: F.array_join(F.transform(F.col(f"`{ids}`"), lambda i: F.get(p, i.cast("int"))), ""))
    return df.withColumn(into, F.unhex(joined))


def report(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", most: int = MOST_WORDS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row of ``docs``."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    coded = decode(encode(rows, path, "text", "ids", most), "ids", path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
