"""Suffixes in sorted order by induced sorting, with queues that spill to disk.

The suffixes that start a descent's end (S*) are sorted first: in memory when they are few,
else by naming their substrings and sorting the string of names the same way, one level
down. All others are induced: a pass over the buckets in ascending order puts every suffix
that is larger than its follower behind it, and a pass in descending order all the rest.
What a pass finds for a later bucket waits in a queue of (position, common prefix) tuples.

A queue takes tuples in the order in which they leave it, as both passes visit sources in
suffix order; so the priority queue is a first-in-first-out queue per bucket, and beyond
``memory`` tuples they are written to an unnamed scratch file of the task and read back
bucket by bucket. A lost task starts over and leaves nothing behind.

The common prefix of neighbours travels along: one more than the smallest value between
their sources. It is exact up to ``cap``, and so is the order.
"""

from __future__ import annotations

import tempfile

import numpy as np

from plumbline.llm.common import starts_of_runs

MEMORY = 1 << 24
BASE = 1 << 23


class Queues:
    """One queue per bucket of (position, common prefix) tuples."""

    def __init__(self, memory: int):
        self._memory, self._held, self._size = memory, {}, 0
        self._file, self._spilled = None, {}

    def push(self, bucket: int, place: np.ndarray, prefix: np.ndarray) -> None:
        self._held.setdefault(bucket, []).append((place, prefix))
        self._size += len(place)
        if self._size > self._memory:
            self._spill()

    def _spill(self) -> None:
        self._file = self._file or tempfile.TemporaryFile()
        self._file.seek(0, 2)
        for bucket, parts in self._held.items():
            for place, prefix in parts:
                self._spilled.setdefault(bucket, []).append((self._file.tell(), len(place)))
                self._file.write(place.astype(np.int64).tobytes() + prefix.tobytes())
        self._held, self._size = {}, 0

    def pop(self, bucket: int) -> tuple[np.ndarray, np.ndarray]:
        """All tuples of a bucket, in the order they were pushed."""
        parts = []
        for at, n in self._spilled.pop(bucket, ()):
            self._file.seek(at)
            data = self._file.read(9 * n)
            parts.append((np.frombuffer(data, np.int64, n), np.frombuffer(data, np.uint8, n, 8 * n)))
        held = self._held.pop(bucket, [])
        self._size -= sum(len(p) for p, _ in held)
        parts += held
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.uint8)
        return np.concatenate([p for p, _ in parts]), np.concatenate([x for _, x in parts])

    def close(self) -> None:
        if self._file:
            self._file.close()


def _types(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix is smaller than the next one (S), and how often its first symbol
    is repeated. The last symbol must be the only smallest one."""
    n = len(text)
    run = starts_of_runs(text)
    size = np.diff(np.append(run, n))
    follower = np.append(text[run[1:]], -1)
    smaller = np.repeat(text[run] < follower, size)
    smaller[-1] = True
    repeat = np.repeat(run + size, size) - np.arange(n)
    return smaller, np.minimum(repeat, 255).astype(np.uint8)


class _Words:
    """As many symbols as fit into 64 bits, from every place on: they compare like the
    symbols. Past the end there are zeros."""

    def __init__(self, symbols: np.ndarray):
        held = np.bincount(symbols) > 0
        self.bits = int(np.count_nonzero(held)).bit_length()
        words = np.cumsum(held).astype(np.uint64)[symbols]
        self.per = 1
        while 2 * self.per * self.bits <= 64:
            after = np.concatenate([words[self.per :], np.zeros(min(self.per, len(words)), np.uint64)])
            words <<= np.uint64(self.per * self.bits)
            words |= after
            self.per *= 2
        self.at = words

    def cut(self, words: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The first ``n`` (1 at least) symbols of each word."""
        rest = (np.maximum(self.per - n, 0) * self.bits).astype(np.uint64)
        return words >> rest << rest


def _rank(words: _Words, starts: np.ndarray, ends: np.ndarray | None, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the strings at ``starts`` (to ``ends``, or ``depth`` symbols of the suffix)
    and the rank of each; equal strings share one. A word at a time, ties only. The last
    symbol of the text is unique, so what is tied lies inside."""
    rank = np.zeros(len(starts), np.int64)
    whole, tied, old, done = np.arange(len(starts)), np.arange(len(starts)), rank, 0
    while len(tied) and (ends is not None or done < depth):
        # what is tied stands by its rank: its number goes before as many symbols as fit
        first = starts_of_runs(old)
        count = np.diff(np.append(first, len(old)))
        fit = min(words.per, (64 - (len(first) - 1).bit_length()) // words.bits)
        key = words.at[starts[tied] + done]
        if ends is not None:
            key = words.cut(key, ends[tied] - starts[tied] - done)
        key >>= np.uint64((words.per - fit) * words.bits)
        if len(first) > 1:
            key |= np.repeat(np.arange(len(first), dtype=np.uint64) << np.uint64(fit * words.bits), count)
        order = np.argsort(key, kind="stable" if done else None)
        key, tied = key[order], tied[order]
        base = np.repeat(old[first] - first, count)
        whole[base + np.arange(len(base))] = tied
        group = starts_of_runs(key)
        size = np.diff(np.append(group, len(order)))
        old = base + np.repeat(group, size)
        rank[tied] = old
        done += fit
        more = np.repeat(size > 1, size)
        if ends is not None:
            more &= starts[tied] + done < ends[tied]
        tied, old = tied[more], old[more]
    return whole, rank


def _common(words: _Words, order: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it, up to ``cap``."""
    out = np.zeros(len(order), np.uint8)
    left, done = np.arange(1, len(order)), 0
    steps = np.uint64(1) << (np.arange(words.per) * words.bits).astype(np.uint64)
    while len(left) and done < cap:
        differ = words.at[order[left - 1] + done] ^ words.at[order[left] + done]
        out[left] = np.minimum(done + words.per - np.searchsorted(steps, differ, side="right"), cap)
        left, done = left[differ == 0], done + words.per
    return out


# The largest power of two, and which, in each small number from 1.
_LEVEL = (np.frexp(np.arange(1 << 16))[1] - 1).astype(np.int64)
_POWER = np.int64(1) << np.maximum(_LEVEL, 0)


class _Range:
    """Smallest value between two places of an array, for many pairs at once."""

    def __init__(self, values: np.ndarray):
        self._size = len(values)
        self._tables = np.empty((len(values).bit_length(), len(values)), np.uint8)
        self._tables[0] = values
        for k in range(1, len(self._tables)):
            half = 1 << (k - 1)
            np.minimum(self._tables[k - 1, :-half], self._tables[k - 1, half:], out=self._tables[k, :-half])

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Over low .. high, both included; low <= high."""
        size = high - low + 1
        if len(size) and size.max() < len(_LEVEL):
            level, power = _LEVEL[size], _POWER[size]
        else:
            level = np.frexp(size.astype(np.float64))[1].astype(np.int64) - 1
            power = 1 << level
        row, flat = level * self._size, self._tables.reshape(-1)
        return np.minimum(flat[row + low], flat[row + high - power + 1])


class _Pass:
    """One induction pass: takes batches of sources in order, fills the queues."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, alphabet: int, cap: int, memory: int):
        self.cap = cap
        # the symbol before each suffix if that is wanted, else 0, which stands before none
        self.before = np.zeros(len(text), text.dtype)
        np.multiply(text[:-1], wanted[:-1], out=self.before[1:])
        self.queues = Queues(memory)
        # smallest common prefix among the sources since the last tuple of each bucket
        self.since = np.full(alphabet, 255, np.uint8)
        self.fresh = np.ones(alphabet, bool)

    def feed(self, place: np.ndarray, prefix: np.ndarray) -> None:
        if not len(place):
            return
        symbol = self.before[place]
        able = np.flatnonzero(symbol)
        if not len(able):
            np.minimum(self.since, prefix.min(), out=self.since)
            return
        symbol = symbol[able]
        order = np.argsort(symbol, kind="stable")
        source, symbol = able[order], symbol[order]
        group = starts_of_runs(symbol)
        least = _Range(prefix)
        low = np.zeros(len(source), np.int64)
        low[1:] = source[:-1] + 1
        low[group] = 0
        value = least.least(low, source)
        heads = symbol[group]
        value[group] = np.minimum(value[group], self.since[heads])
        value = np.minimum(value, np.uint8(self.cap - 1)) + np.uint8(1)
        value[group[self.fresh[heads]]] = 0
        np.minimum(self.since, prefix.min(), out=self.since)
        ends = np.append(group[1:], len(source))
        last = source[ends - 1] + 1
        rest = np.full(len(group), 255, np.uint8)
        inner = last < len(prefix)
        if inner.any():
            rest[inner] = least.least(last[inner], np.full(int(inner.sum()), len(prefix) - 1))
        self.since[heads], self.fresh[heads] = rest, False
        found = place[source] - 1
        for c, a, b in zip(heads.tolist(), group.tolist(), ends.tolist()):
            self.queues.push(c, found[a:b], value[a:b])

    def drain(self, bucket: int) -> tuple[np.ndarray, np.ndarray]:
        """All of a bucket, while it still feeds itself."""
        parts = []
        while len((part := self.queues.pop(bucket))[0]):
            parts.append(part)
            self.feed(*part)
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.uint8)
        return np.concatenate([p for p, _ in parts]), np.concatenate([x for _, x in parts])


def _starred_order(text: np.ndarray, words: _Words, smaller: np.ndarray, starred: np.ndarray, cap: int, memory: int, base: int) -> np.ndarray:
    """The S* positions in suffix order."""
    if len(starred) <= base:
        return starred[_rank(words, starred, None, cap)[0]]
    ends = np.append(starred[1:] + 1, len(text))
    _, rank = _rank(_Words(2 * text.astype(np.int64) + smaller), starred, ends, 0)
    names = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    order, _ = sorted_suffixes(names, cap, memory, base) if names.max() + 1 < len(names) else (np.argsort(names), None)
    return starred[order]


def sorted_suffixes(text: np.ndarray, cap: int, memory: int = MEMORY, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """Suffix positions in order and each one's common prefix with the one before it, both
    exact for ``cap`` (at most 254) symbols. ``text`` is of small integers from 0 and ends
    with its only 0."""
    # a stable sort of symbols of 8 bits takes one pass, of 16 bits two
    text = text.astype(np.uint8 if text.max() < 1 << 8 else np.uint16 if text.max() < 1 << 16 else np.int64)
    if len(text) == 1:
        return np.zeros(1, np.int64), np.zeros(1, np.uint8)
    smaller, repeat = _types(text)
    is_star = smaller.copy()
    is_star[0] = False
    is_star[1:] &= ~smaller[:-1]
    words = _Words(text)
    star = _starred_order(text, words, smaller, np.flatnonzero(is_star), cap, memory, base)
    star_prefix = _common(words, star, cap)
    del words
    alphabet = int(text.max()) + 1
    symbols = np.flatnonzero(np.bincount(text, minlength=alphabet)).tolist()
    cut = np.searchsorted(text[star], np.arange(alphabet + 1))

    def meet(low: np.ndarray, high: np.ndarray) -> int:
        return min(int(repeat[low[-1]]), int(repeat[high[0]]), cap)

    up = _Pass(text, ~smaller, alphabet, cap, memory)
    larger = {}
    try:
        for c in symbols:
            place, prefix = up.drain(c)
            larger[c] = place, prefix
            own, own_prefix = star[cut[c] : cut[c + 1]], star_prefix[cut[c] : cut[c + 1]].copy()
            if len(own):
                own_prefix[0] = meet(place, own) if len(place) else 0
                up.feed(own, own_prefix)
    finally:
        up.queues.close()

    down = _Pass(text, smaller, alphabet, cap, memory)
    done = []
    try:
        for c in reversed(symbols):
            place, prefix = down.drain(c)
            low, low_prefix = larger.pop(c)
            if c == 0:
                place, prefix = np.array([len(text) - 1]), np.zeros(1, np.uint8)
            if len(low):
                shifted = np.append(low_prefix[1:], np.uint8(0))[::-1].copy()
                shifted[0] = meet(low, place[::-1]) if len(place) else 0
                down.feed(low[::-1], shifted)
            # ascending: the larger ones, then those of this pass turned round
            turned = np.append(np.uint8(0), prefix[1:][::-1]) if len(place) else prefix
            if len(place) and len(low):
                turned[0] = meet(low, place[::-1])
            done.append((np.concatenate([low, place[::-1]]), np.concatenate([low_prefix, turned])))
    finally:
        down.queues.close()
    done.reverse()
    return np.concatenate([p for p, _ in done]), np.concatenate([x for _, x in done])
