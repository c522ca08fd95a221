"""Token ids in grammar-compressed files with random access (Re-Pair).

Texts are encoded and written in ascending doc_id order, each document closed by an end
id. A file (shard) holds a grammar: in rounds, the RULES_PER_ROUND most frequent neighbouring
pairs are replaced by new symbols until none stands LEAST_COUNT times or a round makes the
file no smaller, and each rule keeps its expanded length. No symbol reaches over
a document's end, so a document is a run of symbols and is read without the rest.

File layout, all little-endian: MAGIC, then six 8-byte counts (documents, symbols,
tokens, first rule symbol, rules, end id), then per document its id (8 bytes), whether it
has one (1 byte), and where its symbols and its tokens start (8 bytes each, one entry more
than documents), then the rules (two 4-byte symbols each), their expanded lengths (4 bytes
each), and the symbols (2 bytes each, or 4 if one needs them; the width stands before).

The words between ASCII white space are encoded once per task and kept in a bounded cache,
as the tokenizer never joins them; marks after a word's last letter are encoded apart. NULL is an empty text, so only the end id. Rows that
share a doc_id are ordered by their text's hash.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import chain
from itertools import count as count_up
from unicodedata import is_normalized
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import slices
from plumbline.llm.files import read_file, write_file
from plumbline.session import materialize, shared_folder

END_ID = 1
FILE_BYTES = 16 << 20
SHARD_TOKENS = 4 << 20
# Text bytes encoded at once: a larger slice repeats more of its words.
ENCODED_BYTES = 4 << 20
RULES_PER_ROUND, LEAST_COUNT = 2048, 16
MAGIC = b"RPTOK001"
CACHED_WORDS = 1 << 19

_COUNT_SLOTS = 1 << 20


# Two symbols and the expanded length.
_RULE_BYTES = 12


def _width(top: int) -> int:
    """Bytes of a symbol below ``top``."""
    return 2 if top <= 1 << 16 else 4


# -- grammar ---------------------------------------------------------------
def _slot(code: np.ndarray) -> np.ndarray:
    return ((code.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).view(np.int64)


def _frequent_pairs(code: np.ndarray, open_: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent codes, sorted; where they stand, and which stands there. Counted by
    a hash first: only codes in the fullest slots are counted one by one, unless none of
    these is frequent enough."""
    slot = _slot(code)
    full = np.bincount(slot, minlength=_COUNT_SLOTS)
    for least in sorted({LEAST_COUNT, max(LEAST_COUNT, int(np.partition(full, -4 * most)[-4 * most]))}, reverse=True):
        place = np.flatnonzero((full >= least)[slot] & open_)
        held = code[place]
        found, count = np.unique(held, return_counts=True)
        found, count = found[count >= LEAST_COUNT], count[count >= LEAST_COUNT]
        if len(found):
            break
    chosen = np.sort(found[np.lexsort((found, -count))[:most]])
    if not len(chosen):
        return chosen, place[:0], place[:0]
    # looked up by slot; of two chosen codes with one slot the other waits for the next round
    mine = _slot(chosen)
    number = np.full(_COUNT_SLOTS, -1, np.int32)
    number[mine] = np.arange(len(chosen))
    chosen = chosen[number[mine] == np.arange(len(chosen))]
    number[_slot(chosen)] = np.arange(len(chosen))
    at = number[slot[place]]
    hit = np.flatnonzero(chosen[at] == held)  # -1 takes the last code, which is not there
    return chosen, place[hit], at[hit].astype(np.int64)


def compress(tokens: np.ndarray, end_id: int = END_ID, rounds: int | None = None, per_round: int = RULES_PER_ROUND) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbols, rules (pairs of symbols) and the first rule's symbol; ``rounds`` bounds the
    rounds."""
    first = int(max(tokens.max(initial=0), end_id)) + 1
    seq, rules, closes = tokens.astype(np.int64), [], np.zeros(first, bool)
    closes[end_id] = True
    top = first
    held = lambda n: n * _width(top) + _RULE_BYTES * (top - first)
    for _ in count_up() if rounds is None else range(rounds):
        if len(seq) < 2:
            break
        before, old = held(len(seq)), seq
        code = (seq[:-1] << 32) | seq[1:]
        open_ = ~closes[seq[:-1]]
        chosen, place, at = _frequent_pairs(code, open_, per_round)
        if not len(chosen):
            break
        # of overlapping places every other one, from the left
        run = np.flatnonzero(np.diff(place, prepend=-2) > 1)
        even = (place - np.repeat(place[run], np.diff(np.append(run, len(place))))) & 1 == 0
        place, at = place[even], at[even]
        keep = np.ones(len(seq), bool)
        keep[place + 1] = False
        seq = seq.copy()
        seq[place] = top + at
        seq = seq[keep]
        top += len(chosen)
        if held(len(seq)) >= before:
            seq = old
            break
        pairs = np.stack([chosen >> 32, chosen & 0xFFFFFFFF], axis=1)
        rules.append(pairs)
        closes = np.concatenate([closes, closes[pairs[:, 1]]])
    return seq, np.concatenate(rules) if rules else np.empty((0, 2), np.int64), first


def lengths(rules: np.ndarray, first: int) -> np.ndarray:
    """Expanded length of each rule; a rule refers to tokens and to earlier rules only."""
    out = np.ones(len(rules), np.int64)
    size = lambda s: 1 if s < first else out[s - first]
    for i, (a, b) in enumerate(rules.tolist()):
        out[i] = size(a) + size(b)
    return out


def expand(seq: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """The tokens that symbols stand for: every pass opens all symbols by one level."""
    seq = seq.astype(np.int64)
    while len(rules) and (big := seq >= first).any():
        at = np.cumsum(np.where(big, 2, 1)) - np.where(big, 2, 1)
        out = np.empty(int(at[-1]) + (2 if big[-1] else 1), np.int64)
        out[at[~big]] = seq[~big]
        pair = rules[seq[big] - first]
        out[at[big]], out[at[big] + 1] = pair[:, 0], pair[:, 1]
        seq = out
    return seq


# -- file ------------------------------------------------------------------
def to_bytes(ids: list[int | None], counts: np.ndarray, tokens: np.ndarray, end_id: int = END_ID) -> bytes:
    """A file's content from documents' ids, their numbers of tokens, and all tokens."""
    seq, rules, first = compress(tokens, end_id)
    size = lengths(rules, first)
    width = np.where(seq >= first, size[np.maximum(seq - first, 0)] if len(rules) else 1, 1)
    begins = np.concatenate([[0], np.cumsum(width)])
    starts = np.concatenate([[0], np.cumsum(counts)]).astype("<i8")
    symbols = np.searchsorted(begins, starts).astype("<i8")
    kind = f"<u{_width(first + len(rules))}"
    head = struct.pack("<6q", len(ids), len(seq), len(tokens), first, len(rules), end_id)
    known = np.array([i is not None for i in ids], np.uint8)
    parts = [MAGIC, head, np.array([i or 0 for i in ids], "<i8"), known, symbols, starts, rules.astype("<u4"), size.astype("<u4"), struct.pack("<q", int(kind[2])), seq.astype(kind)]
    return b"".join(p if isinstance(p, bytes) else p.tobytes() for p in parts)


class TokenFile:
    """A file's index; ``read(start, length)`` gives bytes of the file."""

    def __init__(self, read):
        at = len(MAGIC)
        head = read(0, at + 48)
        if head[:at] != MAGIC:
            raise ValueError("not a token file")
        self.n, self.n_symbols, self.n_tokens, self.first, n_rules, self.end_id = struct.unpack_from("<6q", head, at)
        sizes = [8 * self.n, self.n, 8 * (self.n + 1), 8 * (self.n + 1), 8 * n_rules, 4 * n_rules, 8]
        body = read(at + 48, sum(sizes))
        cuts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
        part = lambda i, kind: np.frombuffer(body[cuts[i] : cuts[i + 1]], kind)
        self.ids = [int(i) if k else None for i, k in zip(part(0, "<i8"), part(1, np.uint8))]
        self.symbols, self.starts = part(2, "<i8"), part(3, "<i8")
        self.rules, self.size = part(4, "<u4").reshape(-1, 2).astype(np.int64), part(5, "<u4")
        self.width = int(part(6, "<i8")[0])
        self._read, self._at = read, at + 48 + sum(sizes)

    def tokens(self, low: int, high: int) -> np.ndarray:
        """The tokens of documents ``low`` to ``high`` (excluded), reading only their symbols."""
        a, b = int(self.symbols[low]), int(self.symbols[high])
        seq = np.frombuffer(self._read(self._at + a * self.width, (b - a) * self.width), f"<u{self.width}")
        return expand(seq, self.rules, self.first)


# -- encoding --------------------------------------------------------------
# ASCII marks that the tokenizer cuts from a letter before them, and that begin neither a
# contraction nor a special token.
_TAIL = ".,;:!?*$%&#@^~=+-_/\\()[]{}\"`"
# Letters up to here never join a space, and stay letters in lower case.
_LATIN = "\u0250"
_JOINED = 1000
# Letters that stay one letter in lower case and in normal form, so that marks after them
# are cut off: Latin, Cyrillic, kana, Chinese characters, Hangul syllables.
_LAST_LETTER = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{24f}\x{400}-\x{481}\x{48a}-\x{52f}\x{3041}-\x{3096}\x{30a1}-\x{30fa}\x{4e00}-\x{9fa5}\x{ac00}-\x{d7a3}]$"


def _gather(flat: np.ndarray, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin at ``begin`` and have ``n`` entries, end to end."""
    before = np.cumsum(n) - n
    return flat[np.arange(int(n.sum())) + np.repeat(begin - before, n)]


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()  # many times as fast as to_pylist


def _joins(word: str) -> bool:
    """Whether a word is one run of letters for the tokenizer, also among others."""
    if word.isascii():
        return word.isalpha()
    return max(word) < _LATIN and word.isalpha() and word.lower().isalpha() and is_normalized("NFC", word)


class _Cache:
    """Ids of words seen by this Python worker, end to end in one array.

    At most CACHED_WORDS entries are kept, beyond what one slice of texts needs; then it
    starts over.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {"": 0}
        self.flat, self.used = np.empty(1 << 20, np.uint32), 0
        self.start, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def _store(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        """Keep the ids of new words, which stand end to end."""
        at, low = self.used, len(self.number)
        high, self.used = low + len(words), self.used + len(ids)
        if self.used > len(self.flat):
            self.flat = np.concatenate([self.flat[:at], np.empty(2 * self.used - at, np.uint32)])
        if high > len(self.start):
            self.start, self.count = (np.concatenate([x[:low], np.zeros(2 * high - low, np.int64)]) for x in (self.start, self.count))
        self.flat[at : self.used] = ids
        self.start[low:high], self.count[low:high] = at + np.cumsum(counts) - counts, counts
        self.number.update(zip(words, range(low, high)))

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Encode new words. Runs of letters are encoded many at a time as one text, in which
        the last id of each word is marked; all others alone."""
        alone, joined = [], []
        for w in words:
            (joined if _joins(w) else alone).append(w)
        parts = [joined[i : i + _JOINED] for i in range(0, len(joined), _JOINED)]
        for part, found in zip(parts, self._encoded([" ".join(p) for p in parts])):
            ids = np.array(found, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part):
                self._store(part, ids, np.diff(stops, prepend=0))
            else:  # a letter that the tokenizer does not know as one
                alone += part
        lists = self._encoded(alone)
        self._store(alone, np.fromiter(chain.from_iterable(lists), np.uint32), np.fromiter(map(len, lists), np.int64, len(lists)))

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """The entry of each word or tail, learned where it is new."""
        coded = pieces.dictionary_encode()
        distinct = _strings(coded.dictionary)
        self._learn([x for x in distinct if x not in self.number])
        return np.fromiter((self.number[x] for x in distinct), np.int64, len(distinct))[coded.indices.to_numpy()]

    def chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks end to end, and how many each has."""
        words, tails = _split(chunks)
        if len(self.number) + len(words) > CACHED_WORDS:
            self.clear()
        which = np.stack([self._numbers(words), self._numbers(tails)], axis=1).ravel()
        n = self.count[which]
        return _gather(self.flat, self.start[which], n), n[::2] + n[1::2]


_CACHES: dict[str, _Cache] = {}


def _split(chunks: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Chunks as words and the marks after them, where these are encoded apart. A plain word
    is put in lower case, as the tokenizer does."""
    core = pc.ascii_rtrim(chunks, characters=_TAIL)
    apart = pc.match_substring_regex(core, _LAST_LETTER)
    words = pc.if_else(apart, core, chunks)
    plain = pc.match_substring_regex(words, "^[A-Za-z]+$")
    words = pc.if_else(plain, pc.ascii_lower(words), words)
    # a tail is what its chunk has beyond the word
    n = pc.subtract(pc.binary_length(chunks), pc.binary_length(words)).to_numpy(zero_copy_only=False)
    tails = [""] * len(chunks)
    held = np.flatnonzero(n)
    for i, chunk, k in zip(held.tolist(), _strings(chunks.take(pa.array(held))), n[held].tolist()):
        tails[i] = chunk[-k:]
    return words, pa.array(tails, pa.large_string())


def encode(texts: pa.Array, path: str, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of the texts, each closed by the end id, and how many each text has."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    cache = _CACHES.get(path) or _CACHES.setdefault(path, _Cache(path))
    flat, count = cache.chunks(coded.dictionary)
    index = coded.indices.to_numpy()
    n = count[index]
    bounds = lists.offsets.to_numpy()
    bounds = bounds - bounds[0]
    # the end id is one more piece after each text's last chunk
    upto = np.concatenate([[0], np.cumsum(n)])
    per_text = upto[bounds[1:]] - upto[bounds[:-1]] + 1
    out = np.full(int(per_text.sum()), end_id, np.uint32)
    kept = np.ones(len(out), bool)
    kept[np.cumsum(per_text) - 1] = False
    out[kept] = _gather(flat, (np.cumsum(count) - count)[index], n)
    return out, per_text


# -- Spark -----------------------------------------------------------------
_INDEX = "part long, piece long, uri string, n long, n_tokens long"
_READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _writer(folder: str, path: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        piece = 0

        def flush() -> pa.RecordBatch:
            ids = [i for x, _, _ in held for i in x]
            counts, tokens = (np.concatenate([x[k] for x in held]) for k in (1, 2))
            uri = f"{folder}/part-{task:06d}-{piece:04d}.tok"
            write_file(uri, [to_bytes(ids, counts, tokens, end_id)])
            return pa.RecordBatch.from_pydict({"part": [task], "piece": [piece], "uri": [uri], "n": [len(ids)], "n_tokens": [len(tokens)]})

        for batch in slices(batches, "text", ENCODED_BYTES):
            tokens, counts = encode(batch.column("text"), path, end_id)
            held.append((batch.column("doc_id").to_pylist(), counts, tokens))
            if sum(len(x[2]) for x in held) >= shard_tokens:
                yield flush()
                held, piece = [], piece + 1
        if held:
            yield flush()

    return run


def write(docs: DataFrame, folder: str, path: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID, file_bytes: int = FILE_BYTES, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the ids of ``docs`` under ``folder``; (part, piece, uri, n, n_tokens) per file,
    whose order is that of (part, piece)."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{text}`").alias("row_text"))
    total = docs.agg(F.sum(F.octet_length(f"`{text}`"))).first()[0] or 0
    parts = max(1, -(-total // file_bytes))
    ordered = rows.repartitionByRange(parts, F.asc_nulls_first("doc_id"), F.asc_nulls_first("row_text")).sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc_nulls_first("row_text"))
    return ordered.select("doc_id", "text").mapInArrow(_writer(folder, path, end_id, shard_tokens), _INDEX)


def with_starts(index: DataFrame, group: int = 4096) -> DataFrame:
    """The files with the number of tokens before each, in two levels of running sums."""
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("sum")).withColumn("g", F.floor(F.col("part") / group))
    # one row per ``group`` parts
    groups = parts.groupBy("g").agg(F.sum("sum").alias("total")).selectExpr("g", "sum(total) OVER (ORDER BY g) - total AS before_group")
    parts = parts.selectExpr("part", "g", "sum(sum) OVER (PARTITION BY g ORDER BY part) - sum AS before_part")
    pieces = index.selectExpr("*", "sum(n_tokens) OVER (PARTITION BY part ORDER BY piece) - n_tokens AS before_piece")
    return pieces.join(parts, "part").join(groups, "g").selectExpr("uri", "n", "n_tokens", "before_group + before_part + before_piece AS start")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, start in zip(batch.column("uri").to_pylist(), batch.column("start").to_pylist()):
            data = memoryview(read_file(uri))
            file = TokenFile(lambda a, n: data[a : a + n])  # noqa: B023
            tokens = file.tokens(0, file.n).astype("<u4")
            cuts = file.starts
            sums = [zlib.crc32(tokens[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(file.ids, pa.int64()), pa.array(cuts[:-1] + start), pa.array(np.diff(cuts)), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from its file."""
    spread = files.select("uri", "start").repartition(max(1, min(files.count(), 4 * files.sparkSession.sparkContext.defaultParallelism)), "uri")
    return spread.mapInArrow(_reader, _READ)


def report(docs: DataFrame, path: str, folder: str | None = None, **sizes: int) -> DataFrame:
    """Write the ids of ``docs`` and report each document as read back."""
    folder = folder or f"{shared_folder(docs.sparkSession)}/plumbline/tokens-{uuid4().hex}"
    index = materialize(write(docs, folder, path, **sizes))
    return read(materialize(with_starts(index)))
