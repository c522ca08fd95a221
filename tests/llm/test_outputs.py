"""Shards, archives, token files, licences and BPE: laws, round trips and public libraries."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import textwrap
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from plumbline.llm import bpe, licenses, shards, token_files, warc
from plumbline.llm.files import read_file, write_file

public_tokenizers = pytest.importorskip("public_tokenizers")
ODD = [
    None, "", " ", " \n\t ", "one", "Hello world, it's a test. Don't!", "  two\n\n spaces \t x  ", "é à 12a34 ß ÀÉ İstanbul ΣΑΣ", "a" * 300, " ab" * 3 + "ab" * 90,
    "日本語 テキスト 😀😀.", "tab nbsp em　wide", "word,,. ... !?;", "x\x1cy\x85z", "abc " * 50 + " ", "'s 't 're've 'm'll 'd",
    "́ combining é ̈́", "١٢٣ ४५ ²³", "<|endoftext|> <|x|>", " ".join(f"word{i}" for i in range(3000)),
]


def test_differencing_is_close_and_consistent():
    rnd = random.Random(3)
    singles = np.zeros((500, 8), np.int64)
    singles[:, 0] = [rnd.randint(1, 10_000) for _ in range(500)]
    sums, places = shards.difference(singles)
    check = np.zeros(8, np.int64)
    for row, place in zip(singles, places):
        check[place] += row
    assert sorted(check) == sorted(sums) and check.sum() == singles.sum()
    assert check.max() - check.min() < 20
    assert shards.difference([np.zeros(3)])[0].tolist() == [0, 0, 0]


@pytest.mark.parametrize("groups_per_task", [50_000, 200])
def test_shards(docs, groups_per_task):
    rnd = random.Random(5)
    texts = ["x" * rnd.randint(0, 400) + str(i) for i in range(1500)] + ["copy " * 30] * 200 + [None, "", (7, "again"), (7, "again"), (None, "no id")]
    got = shards.report(docs(texts), groups_per_task=groups_per_task).collect()
    assert len(got) == len(texts)
    by_text, sums = {}, dict.fromkeys(range(40), 0)
    for r in got:
        by_text.setdefault((r.text_crc32, r.size), set()).add(r.shard)
        sums[r.shard] += r["size"]
    assert all(len(x) == 1 for x in by_text.values())
    others = sorted(sums.values())[:-1]  # the copies are one group, larger than a fair share
    if groups_per_task > 1000:
        assert max(others) - min(others) < 0.01 * min(others)
    for shard in sums:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert {r.law for r in got} == {"bytes"} and all(r.grown_shard is None for r in got)
    (again,) = {(r["size"], r.text_crc32) for r in got if r.doc_id == 7 and r["size"] == 21}
    assert again == (21, zlib.crc32(b"again"))
    assert shards.report(docs([])).collect() == []


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")


def test_archives_round_trip(spark, tmp_path):
    rnd = random.Random(9)
    words = ["<p>", "</p>", "<div class=a>", "alpha", "beta", "é"]
    body = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    same = body(500)
    rows = [(i, f"http://h/{i}", body(rnd.randint(0, 400))) for i in range(120)]
    rows += [(200, "u", same), (205, "u", same), (203, None, same), (None, "u", same), (205, "again", same), (300, "u", None), (301, "a b", ""), (302, "u", "short"), (303, "u", "short")]
    got = warc.report(pages(spark, rows), f"file://{tmp_path}/a").collect()
    size = lambda h: len((h or "").encode())
    expected = []
    for i, _, h in rows:
        twins = [x for x, _, y in rows if (y or "") == (h or "") and x is not None]
        revisit = size(h) >= 1000 and len([1 for _, _, y in rows if y == h]) > 1 and i != max(twins)
        expected.append((i, size(h), hashlib.sha1((h or "").encode()).hexdigest(), "revisit" if revisit else "response", max(twins) if revisit else None))
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    assert warc.report(pages(spark, []), f"file://{tmp_path}/b").collect() == []


def test_an_archive_stands_alone(spark, tmp_path):
    """Offsets give single records, and the standard library of the format reads the file."""
    rows = [(i, f"http://h/{i}", f"<html><body>{'text ' * 50}{i}</body></html>") for i in range(300)]
    index = warc.write(pages(spark, rows), f"file://{tmp_path}/a", file_bytes=40_000).collect()
    assert len(index) > 1 and sum(r.n for r in index) == 300
    for r in index:
        data = read_file(r.uri)
        assert data[:4] == bytes.fromhex("5d2a4d18") and len(data) == r.bytes
        ends = [*r.offsets[1:], r.bytes]
        alone = [warc.read_record(r.uri, a, b - a) for a, b in zip(r.offsets, ends)]
        assert alone == list(warc.open_archive(data))
        ids = [int(warc.parse(x)[0]["WARC-Record-ID"].removeprefix("<urn:page:").rstrip(">")) for x in alone]
        assert ids == sorted(ids)
        plain = sum(len(zstandard.compress(x, 3)) for x in alone)
        assert len(data) - r.offsets[0] < plain


def test_files_are_replaced_whole(tmp_path):
    uri = f"file://{tmp_path}/x/y.bin"
    write_file(uri, [b"old"])
    write_file(uri, [b"new", b"er"])
    assert read_file(uri) == b"newer" and read_file(uri, 1, 2) == b"ew"
    assert [p.name for p in (tmp_path / "x").iterdir()] == ["y.bin"]


def test_dictionary_sees_the_whole_of_long_records():
    rnd = random.Random(6)
    tail = rnd.randbytes(600)
    records = [rnd.randbytes(140 << 10) + tail * 20 for _ in range(12)]
    dictionary = warc.train(records)
    assert any(tail[i : i + 100] in dictionary for i in range(0, 500, 50))
    pieces, _ = warc.archive(records)
    assert list(warc.open_archive(b"".join(pieces))) == records


def test_grammar_round_trip():
    rng = np.random.default_rng(2)
    for end in (1, 7):
        tokens = np.concatenate([np.tile(rng.integers(2, 6, 9), 400), rng.integers(0, 50_000, 3000), np.full(5000, 3), [end] * 50]).astype(np.uint32)
        seq, rules, first = token_files.compress(tokens, end)
        assert len(seq) < len(tokens) / 2
        assert (token_files.expand(seq, rules, first) == tokens).all()
        for size, pair in zip(token_files.lengths(rules, first), rules):
            assert len(token_files.expand(pair, rules, first)) == size
    empty = token_files.to_bytes([], np.empty(0, np.int64), np.empty(0, np.uint32))
    assert token_files.TokenFile(lambda a, n: empty[a : a + n]).n == 0


def test_words_are_encoded_as_the_library_does():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    ids, count = token_files.encode(pa.array(ODD), path)
    at = np.concatenate([[0], np.cumsum(count)])
    for text, a, b in zip(ODD, at[:-1], at[1:]):
        assert ids[a:b].tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], text


def test_words_and_marks_of_all_kinds_are_encoded_as_the_library_does():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rnd = random.Random(8)
    parts = ["a", "Word", "\u00e9t\u00e9", "\u00c9T\u00c9", "\u0130", "\u0149", "\u01f0", "\u00aa", "\u00df", "W\u030a", "e\u0301", "\u0301", "\u4e2d\u6587", "\u0958", "\ufb1d", "\u0438\u0439", "7", "\u00b2", "'s", "'", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "$$$", "***", "%", "#", "...", "!?", "_", "-", ")", "\"", "`", "\\", "\u00a0", "\u200b", "\u2014", "\U0001f600", "\x1c"]
    texts = ["".join(rnd.choices([*parts, " "], k=rnd.randint(1, 12))) for _ in range(4000)]
    ids, count = token_files.encode(pa.array(texts), path)
    at = np.concatenate([[0], np.cumsum(count)])
    for text, a, b in zip(texts, at[:-1], at[1:]):
        assert ids[a:b].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1], ascii(text)


def test_the_word_cache_starts_over(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}," for i in range(k, k + 90)) for k in range(0, 500, 45)]
    whole = token_files.encode(pa.array(texts), path)
    monkeypatch.setattr(token_files, "CACHED_WORDS", 200)
    monkeypatch.setattr(token_files, "_CACHES", {})
    parts = [token_files.encode(pa.array([t]), path) for t in texts]
    assert (np.concatenate([p[0] for p in parts]) == whole[0]).all()
    assert len(token_files._CACHES[path].number) <= 200


def test_rounds_go_on_until_nothing_is_frequent():
    rnd = np.random.default_rng(4)
    passage = rnd.integers(2, 30_000, 1500)
    tokens = np.concatenate([np.concatenate([passage, rnd.integers(2, 30_000, 3), [token_files.END_ID]]) for _ in range(40)])
    seq, rules, first = token_files.compress(tokens)
    assert (token_files.expand(seq, rules, first) == tokens).all()
    assert len(seq) <= 40 * 6  # the passage is one symbol or two; six rounds leave some 24
    found = np.unique(np.stack([seq[:-1], seq[1:]])[:, seq[:-1] != token_files.END_ID], axis=1, return_counts=True)[1]
    assert found.max() < token_files.LEAST_COUNT


def test_token_files(docs, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = [(1000 - i, t) for i, t in enumerate(ODD * 2)] + [(None, "no id"), (5, "twice"), (5, "twice")]
    folder = f"file://{tmp_path}/t"
    got = token_files.report(docs(rows), path, folder, file_bytes=9000, shard_tokens=2000).collect()
    expected, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected
    index = token_files.write(docs(rows), f"{folder}2", path, file_bytes=9000, shard_tokens=2000).collect()
    assert len(index) > 3
    for r in index:
        file = token_files.TokenFile(lambda a, n: read_file(r.uri, a, n))  # noqa: B023
        whole = file.tokens(0, file.n)
        for k in range(file.n):
            assert (file.tokens(k, k + 1) == whole[file.starts[k] : file.starts[k + 1]]).all()
    assert token_files.report(docs([]), path, f"{folder}3").collect() == []


def dice(a, b):
    cut = lambda t: "".join(c if c.isascii() and c.isalnum() else " " for c in t).lower().split()
    pairs = lambda t: {(x, y) for x, y in zip(cut(t), cut(t)[1:])}
    a, b = pairs(a), pairs(b)
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0.0


def test_licenses(docs):
    long = licenses.TEMPLATES[1][1]
    texts = [
        "prose\nReleased under the MIT License.\nmore prose", "RELEASED under the *MIT* license", long.replace(" You may", "\nYou may"), f"x\n{long} and a few more words", "Licensed under CC BY-NC 4.0.",
        "Licensed under CC BY 4.0!", "the MIT License", None, "", "\n\n", "MIT " * 300, "Released under the MIT License.\nLicensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License version 2",
    ]
    got = {r.doc_id: r for r in licenses.report(docs(texts)).collect()}
    for i, text in enumerate(texts):
        lines = (text or "").split("\n")
        units = lines + [text or ""] if len(lines) > 1 else lines
        scores = [[(dice(u, t), n) for n, t in licenses.TEMPLATES] for u in units]
        hits = [[s for s in unit if s[0] >= licenses.LEAST_DICE] for unit in scores]
        best = min((s for unit in hits for s in unit), key=lambda s: (-s[0], s[1]), default=(None, None))
        r = got[i]
        assert (r.n_units, r.licenses, r.best_license, r.best_dice) == (sum(map(bool, hits)), ",".join(sorted({n for unit in hits for _, n in unit})), best[1], best[0]), text
    assert licenses.report(docs([])).collect() == []


def test_license_windows_end_where_they_are_too_wide(docs):
    notice = " ".join(f"clause{i} term{i}" for i in range(30))
    templates = [("one", notice)]
    filler = lambda n, k: " ".join(f"w{i % k}" for i in range(n))
    texts = [f"{filler(3000, 3000)} {notice} {filler(4000, 4000)} clause0 term0 clause1", f"clause0 term0 {filler(2500, 60)} {notice} {filler(2500, 60)} clause29 term29", f"{notice[:200]} {filler(4, 4)} {notice[200:]}", f"{notice[:200]} {filler(400, 400)} {notice[200:]}"]
    rows = licenses.report(docs(list(enumerate(texts))), templates=templates).orderBy("doc_id").collect()

    def best(text):
        words, known = text.split(), set(zip(notice.split(), notice.split()[1:]))
        pairs = list(zip(words, words[1:]))
        hits = [i for i, p in enumerate(pairs) if p in known]
        found = [0.0]
        for start in hits:
            own = set()
            for p in pairs[start : hits[-1] + 1]:
                own.add(p)
                if p in known:
                    found.append(2 * len(own & known) / (len(own) + len(known)))
        return max(found) if max(found) >= licenses.LEAST_DICE else None

    expected = [best(t) for t in texts]
    assert [r.best_dice for r in rows] == expected
    assert expected[:2] == [1.0, 1.0] and expected[2] and not expected[3]


def test_licenses_wherever_lines_break(docs):
    """Windows against every window of words, and whole licence texts as files hold them."""
    dice_of = lambda w, t: 2 * len(w & t) / (len(w) + len(t))
    pairs_of = lambda t: list(zip(x := re.findall("[a-z0-9]+", t.lower()), x[1:]))
    few = [x for x in licenses.NOTICES if len(x[1]) < 300]
    mit = dict(licenses.TEMPLATES)["MIT"]
    texts = [
        "The tool is described below. Released under the MIT License. See the manual for more about how it works.",
        "code\nReleased under\nthe MIT\nLicense.\nmore code\nand it is released\nunder the MIT\nlicense as the other one",
        "a released under the mit released under the mit license license or the mit license " * 3,
        "\n".join(textwrap.wrap("words before it " * 9 + licenses.NOTICES[9][1] + " words after it" * 9, 40)), "the mit\nlicense is mentioned here under the license", "Licensed under CC\nBY-SA 4.0, or\nthe Unlicense",
    ]
    got = {r.doc_id: r for r in licenses.report(docs(texts), templates=few).collect()}
    for i, text in enumerate(texts):
        pairs, units, expected = pairs_of(text), [*text.split("\n"), text], {}
        lines = {(n, t): max(dice(u, t) for u in units) for n, t in few}
        known = {p for (_, t), d in lines.items() if d >= licenses.LEAST_DICE for p in pairs_of(t)}
        for (name, t), d in lines.items():
            want = set(pairs_of(t))
            spans = (set(pairs[a:b]) for a in range(len(pairs)) for b in range(a + 1, len(pairs) + 1))
            best = max([d, *(dice_of(w, want) for w in spans if w & want - known)])
            if best >= licenses.LEAST_DICE:
                expected[name] = max(best, expected.get(name, 0))
        assert (got[i].licenses, got[i].best_dice) == (",".join(sorted(expected)), max(expected.values(), default=None)), text
    assert [got[i].n_units for i in (0, 1)] == [1, 2]
    code = "".join(f"def f{i}(x): return x + {i} * y{i}\n" for i in range(40))
    whole = dict(licenses.TEMPLATES)
    held = [f"{n} License\n\nCopyright (c) 2020 Some One\n\n{whole[n]}" for n in ("MIT", "BSD-3-Clause", "ISC", "GPL-3.0", "Unlicense")]
    held += ["\n".join(textwrap.wrap(mit, 60)) + "\n" + code, "\n".join("# " + x for x in textwrap.wrap(licenses.NOTICES[1][1], 70)) + "\n" + code, code + whole["Apache-2.0"] + code * 5]
    best = [r.best_license for r in sorted(licenses.report(docs(held)).collect(), key=lambda r: r.doc_id)]
    assert best == ["MIT", "BSD-3-Clause", "ISC", "GPL-3.0", "Unlicense", "MIT", "Apache-2.0", "Apache-2.0"]


@pytest.mark.parametrize("most", [bpe.MOST_WORDS, 0])
def test_byte_bpe(docs, most):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choice(["a", "th", "e ", " \n", "é", "1", ".", "in", "g", "_"]) for _ in range(rnd.randint(1, 300))) for _ in range(40)]
    got = {r.doc_id: r for r in bpe.report(docs(texts).where("text IS NULL OR true"), path, most=most).collect()}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    for i, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode())), text
    assert bpe.report(docs([]), path).collect() == []


def test_byte_bpe_merges():
    """Words of any length as the library merges them, whether by list or by heap."""
    import tiktoken

    ranks = bpe._ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcdefgéи漢") for _ in range(n)) for n in [*range(1, 80), 500, 50_000]] + ["a" * 3000, "ab" * 1500]
    for word in words:
        want = library.encode_ordinary(word)
        assert bpe.merged(word.encode(), ranks) == want and bpe._merged_by_heap(word.encode(), ranks) == want


def test_byte_bpe_stretches(monkeypatch):
    """A text is cut at once or in stretches with the same result."""
    text = "one two  three\n four's 5, six \u3000seven\x85 eight\x1c nine " * 40
    whole = bpe._PYTHON_CHUNK.split(text)
    monkeypatch.setattr(bpe, "STRETCH", 7)
    assert [c for s in bpe._stretches(text) for c in bpe._PYTHON_CHUNK.split(s) if c] == whole
    assert "".join(whole) == text
