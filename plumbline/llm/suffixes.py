"""Suffix-array dedup: bytes in strings that an earlier document already has.

Every 50-byte string has a minimizer, the smallest hash of its 16-byte runs. Neighbouring
strings mostly share it, so a text is a chain of stretches, each with one minimizer, and
equal strings have equal minimizers. That is used twice:

* A minimizer seen in one document only cannot belong to a shared string. Its stretches
  are left out: packed minimizers are dealt by their value, counted over the documents,
  and the answer goes back to the block they came from.
* All other stretches are dealt by their minimizer, so equal strings meet in one group
  however far apart their documents are.
* A minimizer is hot if its distinct stretches, block by block, hold more than half a
  group's bytes, as those at the edge of a line that many documents share in another
  context. Its stretches are cut into single strings, dealt by their own hash: a group gets
  a string once per block, and no minimizer fills it.

In a group the distinct stretches, each with its smallest doc_id, are sorted by external
induced sorting (``induced``): strings that share WINDOW bytes stand next to each other
with a common prefix of that length, and the smallest doc_id among them is theirs. Each
document then removes the strings whose smallest doc_id is below its own.

A stretch that fills a third of the corpus is sent once per block of text and sorted once.
Stretches are told apart by 64 bits of hash and their length.

A block has a row per group, so the rows would grow with the square of the corpus: from
twice FEW groups on, neighbouring ones travel as one row (a bundle) and are sorted one after
the other.

NULL is an empty text. A row without doc_id is later than all others. Rows that share a
doc_id never remove from each other. Matches never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import gathered, mixed, slices, starts_of_runs, utf8
from plumbline.llm.induced import sorted_suffixes
from plumbline.llm.repeats import count_groups, cut_at, hash_of, keyed, pack, unpack, with_spans
from plumbline.llm.words import _VALUES, powers, whole_windows

WINDOW = 50
GRAM = 16
BLOCK_BYTES = 16 << 20

# Text bytes hashed at once, so that the arrays stay in a core's cache, and bytes of the rows
# that a task hands on at once.
PIECE_BYTES = 1 << 18
BATCH_BYTES = 1 << 20

# Text bytes per group of the count and of the sort, and the unit, rounded up, in which the
# bytes of a minimizer are counted: one stretch is one unit.
GROUP_BYTES = 4 << 20
UNIT = 128

# Groups are bundled if this many bundles are left, up to so many in a bundle: a task holds
# the strings of a bundle, but sorts those of one group at a time.
FEW = 512
BUNDLE = 8

# Leading bits of a minimizer by which it is counted. Two that share them count as one, so a
# stretch may be sent in vain (1 of 700 at 30 GB), but none is left out.
COUNT_BITS = 40
LAST_ID = (1 << 63) - 1

_ROWS = "part int, block string, kind string, n int, a binary, b binary, c binary, texts binary"
_ROWS_ARROW = pa.schema([("part", pa.int32()), ("block", pa.string()), ("kind", pa.string()), ("n", pa.int32()), *[(x, pa.binary()) for x in ("a", "b", "c", "texts")]])
_RUNS = "row_id long, row_text long, starts array<int>, ends array<int>"


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    """Rows by their named values; many small ones are handed on at once."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(row.get(x) or b"") for x in ("a", "b", "c", "texts"))
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=_ROWS_ARROW)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_ROWS_ARROW)


def _bundled(groups: int) -> tuple[int, int]:
    """How many bundles there are, and how many groups each has."""
    each = min(BUNDLE, max(1, groups // FEW))
    return -(-groups // each), each


def _order(values: np.ndarray, bits: int) -> np.ndarray:
    """A stable order of 64-bit values below ``2**bits``: sorted with their place beside them."""
    if len(values) > 1 << (64 - bits):
        return np.argsort(values, kind="stable")
    beside = np.uint64(64 - bits)
    return (np.sort(values << beside | np.arange(len(values), dtype=np.uint64)) & ((np.uint64(1) << beside) - np.uint64(1))).astype(np.int64)


def _prefix_sums(data: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[False][data] * powers(len(data)), dtype=np.uint64)])


def minimizers(data: np.ndarray, at: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of windows with one minimizer: its hash, where the stretch starts, how many
    windows it has; and the prefix sums of the bytes' hash."""
    n = len(data) - window + 1
    sums = _prefix_sums(data)
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), sums
    grams = len(data) - gram + 1
    least = mixed((sums[gram:] - sums[:grams]) * powers(grams, inverse=True))
    width, reach = 1, window - gram + 1
    while 2 * width <= reach:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < reach:
        least = np.minimum(least[: width - reach], least[reach - width :])
    place = np.flatnonzero(whole_windows(at, window))
    least = least[place]
    new = np.ones(len(place), bool)
    new[1:] = (least[1:] != least[:-1]) | (place[1:] != place[:-1] + 1)
    # windows that follow each other may lie in two texts only if one crosses the edge, and
    # those were left out
    start = np.flatnonzero(new)
    # smallest values are all small: mixed again, they spread evenly over the groups
    return mixed(least[start]), place[start], np.diff(np.append(start, len(place))), sums


def _texts(batch: pa.RecordBatch, ends: np.ndarray) -> bytes:
    table = pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("row_text"), pa.array(ends)], ["row_id", "row_text", "end"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(table)
    return sink.getvalue().to_pybytes()


def _part_of(h: np.ndarray, groups: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)).astype(np.int64)


def _names(sums: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each stretch, wherever it stands."""
    return mixed((sums[start + length] - sums[start]) * powers(len(sums), inverse=True)[start]) if len(start) else np.empty(0, np.uint64)


def _marked(batch: pa.RecordBatch, block: str, window: int, gram: int, groups: int) -> Iterator[dict]:
    found, ends, total, docs = [], [], 0, 0
    for piece in slices(iter([batch]), "text", PIECE_BYTES):
        data, at = utf8(piece.column("text"))
        h, start, count, sums = minimizers(data, at, window, gram)
        h >>= np.uint64(64 - COUNT_BITS)
        doc = np.searchsorted(at[1:], start, side="right") + docs
        found.append((h, (start + total).astype(np.uint32), count.astype(np.uint32), doc.astype(np.uint32), _names(sums, start, count + window - 1)))
        ends.append(at[1:] + total)
        total, docs = total + len(data), docs + piece.num_rows
    h, start, count, doc, name = (np.concatenate([x[k] for x in found]) for k in range(5))
    del found
    ends = np.concatenate(ends).astype(np.int64)
    order = _order(h, COUNT_BITS)
    h, start, count, doc = h[order], start[order], count[order], doc[order]
    run = starts_of_runs(h)
    size = np.diff(np.append(run, len(h)))
    many = np.zeros(len(run), bool)
    many[np.searchsorted(run, np.flatnonzero((h[1:] == h[:-1]) & (doc[1:] != doc[:-1])), side="right") - 1] = True
    # a stretch counts once; only those that share a minimizer can be equal
    held = count.astype(np.int64) + window - 1
    several = np.flatnonzero(np.repeat(size > 1, size))
    name = name[order[several]]
    again = np.lexsort((name, h[several]))
    name, several = name[again], several[again]
    held[several[1:][(h[several[1:]] == h[several[:-1]]) & (name[1:] == name[:-1]) & (count[several[1:]] == count[several[:-1]])]] = 0
    held = np.add.reduceat(held, run) if len(run) else held
    h = h[run]
    edge = np.searchsorted(_part_of(h << np.uint64(64 - COUNT_BITS), groups), np.arange(groups + 1))
    for g in np.flatnonzero(np.diff(edge)).tolist():
        a, b = int(edge[g]), int(edge[g + 1])
        yield {"part": g, "block": block, "kind": "keys", "n": b - a, "a": pack(np.diff(h[a:b], prepend=np.uint64(0))), "b": np.packbits(many[a:b]).tobytes(), "c": pack((-(-held[a:b] // UNIT)).astype(np.uint32))}
    packed = [pack(x.astype(np.uint32)) for x in (start, count, size)] if len(start) else [b"", b"", b""]
    head = np.array([len(start), len(size), groups], "<i8").tobytes() + edge.astype("<i8").tobytes()
    yield {"part": -1 - hash_of(block) % groups, "block": block, "kind": "head", "n": len(head), "a": packed[0], "b": packed[1], "c": head + packed[2], "texts": _texts(batch, ends)}


def _mark_block(batch: pa.RecordBatch, block: str, window: int, gram: int, groups: int) -> Iterator[pa.RecordBatch]:
    """The block's distinct minimizers per range, with the bytes of their distinct stretches,
    and its stretches in the same order."""
    return _batches(_marked(batch, block, window, gram, groups))


def _marker(window: int, gram: int, groups: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for i, batch in enumerate(gathered(slices(batches, "text"), "text", block_bytes)):
            yield from _mark_block(batch, f"{task}-{i}", window, gram, groups)

    return run


def _counter(hot_bytes: int):
    def run(table: pa.Table) -> pa.Table:
        """Which minimizers of a range stand in several documents, and which are hot, per block."""
        rows = table.to_pylist()
        if rows and rows[0]["kind"] == "head":
            return table
        h = np.concatenate([np.cumsum(unpack(r["a"], r["n"], np.uint64), dtype=np.uint64) for r in rows])
        many = np.concatenate([np.unpackbits(np.frombuffer(r["b"], np.uint8), count=r["n"]) for r in rows]).astype(bool)
        held = np.concatenate([unpack(r["c"], r["n"], np.uint32) for r in rows]).astype(np.int64)
        order = np.argsort(h, kind="stable")
        first = starts_of_runs(h[order])
        size = np.diff(np.append(first, len(order)))
        shared, hot = np.empty(len(h), bool), np.empty(len(h), bool)
        shared[order] = np.repeat((size > 1) | np.logical_or.reduceat(many[order], first), size)
        hot[order] = np.repeat(UNIT * np.add.reduceat(held[order], first) > hot_bytes, size)
        cut = np.cumsum([0] + [r["n"] for r in rows])
        out = [{"part": r["part"], "block": r["block"], "kind": "shared", "n": r["n"], "a": np.packbits(shared[a:b]).tobytes(), "b": np.packbits(hot[a:b]).tobytes()} for r, a, b in zip(rows, cut[:-1], cut[1:])]
        return pa.Table.from_pylist([x | {"c": None, "texts": None} for x in out], schema=_ROWS_ARROW)

    return run


def _per_text(texts: pa.Table, owner: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Table:
    """Intervals, sorted by their text, as lists per text."""
    held, where = np.unique(owner, return_index=True)
    bounds = pa.array(np.append(where, len(owner)).astype(np.int32))
    keys = texts.take(pa.array(held))
    lists = [pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32))) for x in (starts, ends)]
    return pa.Table.from_arrays([keys.column("row_id").combine_chunks(), keys.column("row_text").combine_chunks(), *lists], ["row_id", "row_text", "starts", "ends"])


def _shared_runs(table: pa.Table) -> pa.Table:
    """A block's stretches with a shared minimizer, per text, neighbours joined: start and
    number of windows, negative for hot ones. Their minimizers part them again."""
    rows = table.to_pylist()
    (head,) = [r for r in rows if r["kind"] == "head"]
    n_runs, n_keys, groups = np.frombuffer(head["c"], "<i8", 3).tolist()
    edge = np.frombuffer(head["c"], "<i8", groups + 1, 24)
    texts = pa.ipc.open_stream(head["texts"]).read_all()
    if not n_runs:
        return _per_text(texts, *[np.empty(0, np.int64)] * 3)
    shared, hot = np.zeros(n_keys, bool), np.zeros(n_keys, bool)
    for r in rows:
        if r["kind"] == "shared":
            for bits, x in ((shared, "a"), (hot, "b")):
                bits[edge[r["part"]] : edge[r["part"] + 1]] = np.unpackbits(np.frombuffer(r[x], np.uint8), count=r["n"])
    size = unpack(head["c"][24 + 8 * (groups + 1) :], n_keys, np.uint32)
    of_run = np.repeat(shared, size)
    start = unpack(head["a"], n_runs, np.uint32)[of_run].astype(np.int64)
    count = unpack(head["b"], n_runs, np.uint32)[of_run].astype(np.int64)
    count = np.where(np.repeat(hot, size)[of_run], -count, count)
    order = np.argsort(start)
    start, count = start[order], count[order]
    ends = texts.column("end").to_numpy()
    if len(start):
        # no window crosses an edge between texts, so neighbours are of one text
        new = np.ones(len(start), bool)
        new[1:] = (start[1:] != start[:-1] + np.abs(count[:-1])) | ((count[1:] < 0) != (count[:-1] < 0))
        first = np.flatnonzero(new)
        start, count = start[first], np.add.reduceat(count, first)
    owner = np.searchsorted(ends, start, side="right")
    begin = np.concatenate([[0], ends[:-1]])
    return _per_text(texts, owner, start - begin[owner], count)


def _send_block(pieces: list, block: str, window: int, bundles: int, each: int) -> Iterator[dict]:
    """The block's distinct stretches per bundle of ranges of minimizers, each with its
    smallest doc_id, and which text has which."""
    name, least, length, data, at, doc, start = (np.concatenate([p[k] for p in pieces]) for k in range(7))
    # by minimizer, and in it by name: 40 and 24 bits bring equal strings together
    order = np.argsort((least >> np.uint64(24) << np.uint64(24)) | (name >> np.uint64(40)), kind="stable")
    name, least, length, at, doc, start = name[order], least[order], length[order], at[order], doc[order], start[order]
    new = np.ones(len(order), bool)
    new[1:] = (name[1:] != name[:-1]) | (length[1:] != length[:-1]) | (least[1:] != least[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(order)))
    ids = np.concatenate([p[7] for p in pieces])
    lowest = np.minimum.reduceat(ids[doc], first) if len(first) else np.empty(0, np.int64)
    least, length, at = least[first], length[first], at[first]
    edge = np.searchsorted(_part_of(least, bundles * each), np.arange(bundles * each + 1))
    body = data.tobytes()
    del data, name, least, new
    packer = zstandard.ZstdCompressor(level=3)
    for g in np.flatnonzero(np.diff(edge[::each])).tolist():
        cut = edge[g * each : (g + 1) * each + 1]
        a, b = int(cut[0]), int(cut[-1])
        text = b"".join([body[s : s + n] for s, n in zip(at[a:b].tolist(), length[a:b].tolist())])
        yield {"part": g, "block": block, "kind": "strings", "n": b - a, "a": packer.compress(text), "b": pack(length[a:b].astype(np.uint32)), "c": pack(lowest[a:b]), "texts": np.diff(cut).astype("<i4").tobytes()}
    ends = np.cumsum(np.concatenate([p[8] for p in pieces]))
    batch = pa.Table.from_batches([p[9] for p in pieces]).combine_chunks().to_batches()[0]
    packed = [pack(x.astype(np.uint32)) for x in (start, doc, np.concatenate([size, length]))] if len(order) else [b"", b"", b""]
    head = np.array([len(order), len(size)], "<i8").tobytes()
    yield {"part": -1 - hash_of(block) % bundles, "block": block, "kind": "head", "n": len(head), "a": packed[0], "b": packed[1], "c": head + packed[2], "texts": _texts(batch, ends)}


def _sender(window: int, gram: int, bundles: int, each: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held, size, docs, total, sent = [], 0, 0, 0, 0
        for piece in slices(batches, "text", PIECE_BYTES):
            data, at = utf8(piece.column("text"))
            starts, counts = piece.column("starts"), piece.column("ends")
            holder = np.repeat(np.arange(piece.num_rows), np.diff(starts.offsets.to_numpy()))
            low = at[holder] + starts.flatten().to_numpy()
            n = counts.flatten().to_numpy().astype(np.int64)
            h, begin, count, sums = minimizers(data, at, window, gram)
            # the stretches that lie in an interval
            of = np.searchsorted(low, begin, side="right") - 1
            run = np.flatnonzero((of >= 0) & (begin < (low + np.abs(n))[of])) if len(low) else np.empty(0, np.int64)
            of, h, begin, count = of[run], h[run], begin[run], count[run]
            owner, hot = holder[of], n[of] < 0
            # the strings of a hot stretch go one by one
            parts = np.where(hot, count, 1)
            step = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
            owner, hot, least, where = np.repeat(owner, parts), np.repeat(hot, parts), np.repeat(h, parts), np.repeat(begin, parts) + step
            inner = where - at[owner]
            length = np.where(hot, 1, np.repeat(count, parts)) + window - 1
            name = _names(sums, where, length)
            least = np.where(hot, mixed(name), least)
            ids = piece.column("row_id").fill_null(LAST_ID).to_numpy()
            keys = pa.RecordBatch.from_arrays([piece.column("row_id"), piece.column("row_text")], ["row_id", "row_text"])
            held.append((name, least, length, data, where + total, owner + docs, inner, ids, np.diff(at), keys))
            docs, total, size = docs + piece.num_rows, total + len(data), size + int(length.sum())
            if max(size, total) >= 2 * block_bytes:
                yield from _batches(_send_block(held, f"{task}-{sent}", window, bundles, each))
                held, size, docs, total, sent = [], 0, 0, 0, sent + 1
        if held:
            yield from _batches(_send_block(held, f"{task}-{sent}", window, bundles, each))

    return run


def _least(strings: list[bytes], ids: np.ndarray, window: int) -> np.ndarray:
    """The smallest id of every window of every string, string after string; ``ids`` are
    those of the strings."""
    known: dict[bytes, int] = {}
    mine = np.array([known.setdefault(x, len(known)) for x in strings])
    lowest = np.full(len(known), np.iinfo(ids.dtype).max, ids.dtype)
    np.minimum.at(lowest, mine, ids)
    size = np.fromiter(map(len, known), np.int64, len(known))
    begin = np.cumsum(size + 1) - size - 1
    text = np.frombuffer(b"\x00".join(known), np.uint8).astype(np.uint16) + np.uint16(2)
    text[begin[1:] - 1] = 1
    windows = size - window + 1
    offset = np.cumsum(windows) - windows
    doc_of = np.repeat(lowest, windows)
    place = np.arange(len(doc_of)) + np.repeat(begin - offset, windows)
    number = np.full(len(text) + 1, -1, np.int32)
    number[place] = np.arange(len(place), dtype=np.int32)
    del place, known
    order, common = sorted_suffixes(np.append(text, np.uint16(0)), window)
    number = number[order]
    del order
    at = np.flatnonzero(number >= 0)
    number = number[at]
    group = np.ones(len(at), bool)
    if len(at) > 1:
        group[1:] = np.minimum.reduceat(common[: at[-1] + 1], at[:-1] + 1) < window
    first = np.flatnonzero(group)
    least = np.empty_like(doc_of)
    least[number] = np.repeat(np.minimum.reduceat(doc_of[number], first), np.diff(np.append(first, len(number))))
    n = windows[mine]
    return least[np.arange(int(n.sum())) + np.repeat(offset[mine] - (np.cumsum(n) - n), n)]


def _sorter(window: int):
    def run(table: pa.Table) -> pa.Table:
        """The smallest doc_id of every window of every stretch of a bundle, per block: a
        value for each run of windows, and where the runs start."""
        rows = table.to_pylist()
        if rows and rows[0]["kind"] == "head":
            return table
        unzip = zstandard.ZstdDecompressor()
        body = b"".join([unzip.decompress(r.pop("a")) for r in rows])
        size = np.concatenate([unpack(r["b"], r["n"], np.uint32) for r in rows]).astype(np.int64)
        # ids by their rank
        ids, rank = np.unique(np.concatenate([unpack(r["c"], r["n"], np.int64) for r in rows]), return_inverse=True)
        rank = rank.astype(np.int32)
        per_group = np.concatenate([np.frombuffer(r["texts"], "<i4") for r in rows])
        each = len(per_group) // len(rows)
        group = np.repeat(np.tile(np.arange(each), len(rows)), per_group)
        order = np.argsort(group, kind="stable")
        edge = np.searchsorted(group[order], np.arange(each + 1)).tolist()
        cut = np.cumsum(size) - size
        windows = size - window + 1
        offset = np.cumsum(windows) - windows
        least = np.empty(int(windows.sum()), np.int32)
        for a, b in zip(edge[:-1], edge[1:]):
            if a < b:
                some = order[a:b]
                found = _least([body[x : x + n] for x, n in zip(cut[some].tolist(), size[some].tolist())], rank[some], window)
                n = windows[some]
                least[np.arange(len(found)) + np.repeat(offset[some] - (np.cumsum(n) - n), n)] = found
        new = np.ones(len(least), bool)
        new[1:] = least[1:] != least[:-1]
        new[offset] = True
        out, low, strings = [], 0, 0
        for r in rows:
            strings += r["n"]
            high = int(offset[strings]) if strings < len(offset) else len(least)
            starts = new[low:high]
            out.append({"part": r["part"], "block": r["block"], "kind": "least", "n": high - low, "a": pack(ids[least[low:high][starts]]), "b": np.packbits(starts).tobytes()})
            low = high
        return pa.Table.from_pylist(out, schema=_ROWS_ARROW)

    return run


def _remover(window: int):
    def run(table: pa.Table) -> pa.Table:
        """The bytes that each text of a block loses, as intervals."""
        rows = table.to_pylist()
        (head,) = [r for r in rows if r["kind"] == "head"]
        n_runs, n_strings = np.frombuffer(head["c"], "<i8", 2).tolist()
        texts = pa.ipc.open_stream(head["texts"]).read_all()
        if not n_runs:
            return _per_text(texts, *[np.empty(0, np.int64)] * 3)
        both = unpack(head["c"][16:], 2 * n_strings, np.uint32).astype(np.int64)
        size, windows = both[:n_strings], both[n_strings:] - window + 1
        answers = sorted((r for r in rows if r["kind"] == "least"), key=lambda r: r["part"])
        new = [np.unpackbits(np.frombuffer(r["b"], np.uint8), count=r["n"]) for r in answers]
        least = np.concatenate([unpack(r["a"], int(np.count_nonzero(x)), np.int64) for r, x in zip(answers, new)])
        first = np.flatnonzero(np.concatenate(new))
        # the runs of windows with one value, per string and then wherever the string stands
        offset = np.cumsum(windows) - windows
        run = np.searchsorted(first, offset)
        runs = np.diff(np.append(run, len(first)))
        length = np.diff(np.append(first, int(windows.sum())))
        first -= np.repeat(offset, runs)
        start, doc = (unpack(head[x], n_runs, np.uint32).astype(np.int64) for x in ("a", "b"))
        ends = texts.column("end").to_numpy()
        begin = np.concatenate([[0], ends[:-1]])
        ids = texts.column("row_id").combine_chunks().fill_null(LAST_ID).to_numpy()
        of = np.repeat(np.arange(n_strings), size)
        n = runs[of]
        step = np.arange(int(n.sum())) + np.repeat(run[of] - (np.cumsum(n) - n), n)
        lost = least[step] < np.repeat(ids[doc], n)
        place = np.repeat(begin[doc] + start, n)[lost] + first[step[lost]]
        step = step[lost]
        order = np.argsort(place)
        low, high = place[order], np.maximum.accumulate((place + length[step] + window - 1)[order])
        apart = np.ones(len(low), bool)
        apart[1:] = low[1:] > high[:-1]
        edge = np.append(np.flatnonzero(apart), len(low))
        starts, stops, owner = cut_at(low[edge[:-1]], high[edge[1:] - 1], ends)
        return _per_text(texts, owner, starts - begin[owner], stops - begin[owner])

    return run


def covered_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, block_bytes: int = BLOCK_BYTES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(row_id, row_text, starts, ends): per text, the byte intervals covered by strings of
    ``window`` bytes that also start in a document with a smaller doc_id."""
    rows = keyed(docs, doc_id, text)
    bundles, each = _bundled(count_groups(rows, "text", group_bytes))
    marked = rows.mapInArrow(_marker(window, gram, bundles, block_bytes), _ROWS)
    runs = marked.groupBy("part").applyInArrow(_counter(group_bytes // 2), _ROWS).groupBy("block").applyInArrow(_shared_runs, _RUNS)
    one = runs.groupBy("row_id", "row_text").agg(F.first("starts").alias("starts"), F.first("ends").alias("ends"))
    texts = with_spans(rows, "row_id", "text", one, ("starts", "ends")).where("starts IS NOT NULL")
    sent = texts.select("row_id", "row_text", "text", "starts", "ends").mapInArrow(_sender(window, gram, bundles, each, block_bytes), _ROWS)
    found = sent.groupBy("part").applyInArrow(_sorter(window), _ROWS).groupBy("block").applyInArrow(_remover(window), _RUNS)
    return found.groupBy("row_id", "row_text").agg(F.first("starts").alias("starts"), F.first("ends").alias("ends"))


def _kept(text: bytes, starts, ends) -> bytes:
    edges = [0, *[x for pair in zip(starts, ends) for x in pair], len(text)]
    return b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2])])


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, **sizes: int) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``."""
    found = covered_spans(docs, doc_id, text, window, **sizes)
    rows = keyed(docs, doc_id, text)  # as in covered_spans, so that Spark shuffles the texts once for both joins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, a, b in zip(batch.column("text"), batch.column("starts"), batch.column("ends")):
                data, a, b = (t.as_py() or "").encode(), a.as_py() or (), b.as_py() or ()
                kept = _kept(data, a, b)
                out.append((len(data), len(data) - len(kept), len(a), hashlib.sha256(kept).hexdigest()))
            columns = [pa.array(x, k) for x, k in zip(zip(*out) if out else [()] * 4, (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return with_spans(rows, "row_id", "text", found, ("starts", "ends")).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
