from __future__ import annotations

import numpy as np
import pytest

from plumbline.llm.induced import _common, _Words, sorted_suffixes


@pytest.mark.parametrize("memory", [3, 1 << 20])
@pytest.mark.parametrize("base", [1, 1 << 20])
@pytest.mark.parametrize("cap", [6, 100])
def test_suffixes_in_order_with_their_common_prefixes(memory, base, cap):
    """Small memory spills the queues, a small base takes the recursion."""
    rng = np.random.default_rng(cap + base)
    for n in range(60):
        text = rng.integers(1, rng.integers(2, 6), rng.integers(0, 60))
        text = np.append(np.tile(text, 3) if n % 3 == 0 else text, 0)
        order, common = sorted_suffixes(text, cap, memory, base)
        assert sorted(order.tolist()) == list(range(len(text)))
        strings = [tuple(text[i : i + cap]) for i in order]
        assert strings == sorted(strings)
        for a, b, k in zip(strings, strings[1:], common[1:]):
            assert k == next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("symbols", [2, 4, 200, 255, 400, 70000])
def test_words_compare_like_their_symbols(symbols):
    """Many symbols are compared at once, as many as 64 bits hold."""
    rng = np.random.default_rng(symbols)
    text = np.append(rng.integers(1, symbols, 300), 0)
    words = _Words(text)
    assert words.per == (8 if symbols in (200, 255) else words.per) and words.per * words.bits <= 64
    strings = [tuple(text[i : i + words.per]) for i in range(len(text))]
    assert sorted(strings) == [strings[i] for i in np.argsort(words.at, kind="stable")]
    order = np.array(sorted(range(len(text)), key=lambda i: tuple(text[i:])))
    for k, a, b in zip(_common(words, order, 50)[1:], order, order[1:]):
        assert k == next(j for j in range(301) if text[a + j] != text[b + j] or j == 50)
