"""The operators on documents against plain Python, with odd rows."""

from __future__ import annotations

import os
import random
import tempfile
import tracemalloc
from functools import partial
from types import SimpleNamespace

import brute
import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from plumbline.llm import components, decontaminate, near_dups, quality, repeats, suffixes


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.fixture(scope="module")
def corpus():
    """Prose with copies, near copies, shared passages, and odd texts."""
    rnd = random.Random(7)
    vocabulary = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6))) for _ in range(300)]
    prose = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    passage, base = prose(45), prose(120).split()
    texts = [prose(rnd.randint(1, 150)) for _ in range(30)]
    texts += [f"{prose(20)}\n{passage}\t{prose(9)}" for _ in range(5)] + [texts[3]] * 4 + [texts[3].upper()]
    for _ in range(12):
        near = list(base)
        for _ in range(rnd.randint(0, 4)):
            near[rnd.randrange(len(near))] = rnd.choice(vocabulary)
        texts.append(" ".join(near))
    texts += ["", " \n\t ", None, "one", "one two three", "One TWO three", "É é", "a " * 400, passage + " " + passage, "\x0b".join(passage.split()), prose(5000)]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [rows[3], (3, "another text with this id"), (None, passage), (None, None)]


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 2000, "group_bytes": 1500}])
def test_repeated_windows(docs, corpus, sizes):
    got = repeats.report(docs(corpus), window=8, **sizes).collect()
    assert ordered(got) == ordered(brute.repeats(corpus, 8))


def test_remove_repeats_keeps_columns_and_untouched_texts(docs, corpus):
    table = docs(corpus)
    out = repeats.remove_repeats(table, window=35)
    assert out.columns == table.columns
    lost = {i for i, _, n, _ in brute.repeats(corpus, 35) if n}
    kept = {r.doc_id: r.text for r in out.collect()}
    assert all(kept[i] == t for i, t in corpus if i not in lost and i != 3)
    assert out.count() == len(corpus)


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 3000, "group_bytes": 1000}])
def test_earlier_strings(docs, corpus, sizes):
    got = suffixes.report(docs(corpus), **sizes).collect()
    assert ordered(got) == ordered(brute.earlier(corpus, 50))


def test_a_line_in_many_contexts_fills_no_group(docs, monkeypatch, tmp_path):
    """Each document has a line between other words: its edges spread over the groups."""
    rnd = random.Random(5)
    noise = lambda: "".join(rnd.choice("abcdefghij klmnop") for _ in range(90))
    line = "this very line of some hundred and twenty bytes stands in all of the documents, each time between other words than before"
    rows = [(i, f"{noise()}{line}{noise()}") for i in range(300)]
    monkeypatch.setattr(suffixes, "count_groups", lambda *_: 16)
    sort, folder = suffixes._sorter, str(tmp_path)

    def watched(window):
        def run(table):
            if table.column("kind")[0].as_py() == "strings":
                size = sum(len(zstandard.ZstdDecompressor().decompress(x)) for x in table.column("a").to_pylist())
                tempfile.NamedTemporaryFile(dir=folder, suffix=f"-{size}", delete=False).close()
            return sort(window)(table)

        return run

    monkeypatch.setattr(suffixes, "_sorter", watched)
    share = []
    for group_bytes in (6000, 1 << 30):  # with the large one nothing is hot
        before = set(os.listdir(folder))
        got = suffixes.report(docs(rows), group_bytes=group_bytes).collect()
        assert ordered(got) == ordered(brute.earlier(rows, 50))
        seen = [int(x.rpartition("-")[2]) for x in set(os.listdir(folder)) - before]
        share.append(max(seen) / sum(seen))
    assert share[0] < 0.15 < 0.3 < share[1]


def test_rows_grow_with_the_blocks_not_with_their_square(docs, monkeypatch, tmp_path):
    """Of many groups, neighbouring ones travel as one row of a block; the strings of each
    are still sorted among themselves."""
    rnd = random.Random(6)
    texts = ["".join(rnd.choices("abcdefgh ", k=rnd.randrange(3000))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate([*texts, *reversed(texts), texts[0] + texts[1]])]
    monkeypatch.setattr(suffixes, "count_groups", lambda *_: 3000)
    folder = str(tmp_path)

    def watching(name):
        made = getattr(suffixes, name)

        def make(*args):
            def run(table):
                kind = table.column("kind")[0].as_py()
                blocks = "-".join(sorted(set(table.column("block").to_pylist())))
                tempfile.NamedTemporaryFile(dir=folder, suffix=f"_{name}_{kind}_{table.num_rows}_{blocks}", delete=False).close()
                return made(*args)(table)

            return run

        monkeypatch.setattr(suffixes, name, make)

    watching("_counter")
    watching("_sorter")
    got = suffixes.report(docs(rows)).collect()
    assert ordered(got) == ordered(brute.earlier(rows, 50))
    seen = [x.rsplit("_", 4)[1:] for x in os.listdir(folder)]
    for name, kind in (("counter", "keys"), ("sorter", "strings")):
        blocks = sum(int(n) for by, k, n, _ in seen if by == name and k == "head")
        assert 0 < sum(int(n) for by, k, n, _ in seen if by == name and k == kind) <= 1024 * blocks


@pytest.mark.parametrize("bits", [8, 40, 62])
def test_order_of_values_with_their_place(bits):
    values = np.random.default_rng(bits).integers(0, 1 << min(bits, 6), 500).astype(np.uint64)
    assert suffixes._order(values, bits).tolist() == np.argsort(values, kind="stable").tolist()


def test_near_duplicates(docs, corpus):
    got = near_dups.report(docs(corpus)).collect()
    assert ordered(got) == ordered(brute.near(corpus))


def test_one_of_each_group_stays(docs, corpus):
    table = docs(corpus)
    out = near_dups.keep_first(table)
    assert out.columns == table.columns
    assert ordered(out.select("doc_id", F.md5("text")).collect()) == ordered(
        docs([(i, t) for (i, t), (_, _, _, kept) in zip(corpus, brute.near(corpus)) if kept]).select("doc_id", F.md5("text")).collect()
    )


def test_left_over_classes_meet_every_block(docs, monkeypatch):
    """A chain: each text is near to the next only, so one centre cannot link them."""
    monkeypatch.setattr(near_dups, "BLOCK", 3)
    words = [f"w{i}" for i in range(200)]
    chain = [" ".join(words[:k] + [f"v{i}" for i in range(k)] + words[k:]) for k in range(0, 60, 4)]
    got = near_dups.report(docs(chain)).collect()
    assert ordered(got) == ordered(brute.near(list(enumerate(chain))))


def test_only_rows_of_compared_classes_travel(spark):
    """Rows without an id or a text are told by their hash as well; no row is shuffled."""
    rows = spark.range(20000).selectExpr("if(id % 1000 = 0, null, id) AS row_id", "xxhash64(nullif(id, 300)) AS row_text", "id")
    keys = rows.where("id % 100 = 0").select("row_id", "row_text")
    kept = near_dups._marked(rows, keys)
    assert {r.id for r in kept.collect()} >= set(range(0, 20000, 100))
    assert kept.count() < 300
    # the only exchanges are those of the bitmaps
    assert "hashpartitioning(row_" not in kept._jdf.queryExecution().executedPlan().toString()
    assert near_dups._marked(rows, keys.limit(0)).count() == 0


def test_benchmark_passages(spark, docs, corpus):
    items = [(1, corpus[34][1]), (2, "one two"), (3, None), (4, "!!"), (None, corpus[5][1]), (2, "One, two"), (7, " ".join(corpus[0][1].split()[:4])), (8, "a a a")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.report(docs(corpus), benchmark).collect()
    assert ordered(got) == ordered(brute.leaks(corpus, items))
    kept = decontaminate.drop_contaminated(docs(corpus), benchmark)
    assert kept.count() == sum(1 for r in brute.leaks(corpus, items) if not r[-1])
    empty = decontaminate.report(docs(corpus), benchmark.limit(0))
    assert ordered(empty.collect()) == ordered(brute.leaks(corpus, []))


def test_quality_measures(docs, corpus):
    more = corpus + [(900, "x y z\nx y z\n\n x y z\nq # * <b>"), (901, "the cat " * 40), (902, "word " * 60), (903, "tab\tof\x0bthe\x0cd\re")]
    got = quality.report(docs(more)).collect()
    shown = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got]
    assert ordered(shown) == ordered([(i, *brute.measures(t)) for i, t in more])
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_quality_table_decides(docs):
    prose = " ".join(f"the word{i} and text{i}" for i in range(20))
    texts = [prose, prose + " ### $$$ %%%" * 12, " ".join(f"word{i}" for i in range(80)), "\n".join([prose] + ["the end of it"] * 3), " ".join(f"the {'long' * 8}{i}" for i in range(60))]
    table = docs(texts)
    out = quality.keep_good(table)
    assert out.columns == table.columns
    assert [r.doc_id for r in out.collect()] == [0]


def test_packed_places_of_a_long_text(docs, monkeypatch):
    monkeypatch.setattr(quality, "_PLACE_BITS", 4)
    text = "a b c d e f a b c x a b c " * 3
    (row,) = quality.report(docs([text])).collect()
    assert row.n_repeat_words == brute.measures(text)[4]


@pytest.mark.parametrize("operator", [repeats.report, suffixes.report, near_dups.report, quality.report, repeats.remove_repeats, near_dups.keep_first])
def test_empty_tables(docs, operator):
    assert operator(docs([])).collect() == []
    assert operator(docs([None, ""])).count() == 2


@pytest.mark.parametrize("bits", [3, suffixes.COUNT_BITS])
def test_neighbouring_shared_stretches_travel_as_one(bits, monkeypatch):
    """A copied text is one interval, and minimizers that only share their leading bits are
    sent in vain but never left out."""
    monkeypatch.setattr(suffixes, "COUNT_BITS", bits)
    rng = random.Random(5)
    copied, alone = ("".join(rng.choices("abcdefgh ", k=700)) for _ in range(2))
    batch = pa.RecordBatch.from_pydict({"row_id": pa.array([1, 2, 3]), "row_text": pa.array([7, 7, 9]), "text": [copied, copied, alone]})
    marked = pa.Table.from_batches(list(suffixes._mark_block(batch, "b", 50, 16, 4)))
    kinds, parts = (marked.column(c).to_pylist() for c in ("kind", "part"))
    answers = [marked.filter(pa.array([k == "head" for k in kinds]))]
    for part in sorted({p for p, k in zip(parts, kinds) if k == "keys"}):
        answers.append(suffixes._counter(1 << 20)(marked.filter(pa.array([p == part for p in parts]))))
    found = {r["row_id"]: (r["starts"], r["ends"]) for r in suffixes._shared_runs(pa.concat_tables(answers)).to_pylist()}
    assert found[1] == found[2] == ([0], [651])
    assert (3 in found) == (bits == 3)


def test_left_over_pairs_are_a_small_plan(spark):
    """Every exchange of a plan takes a thread and memory of the driver."""
    buckets = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (2, 10), (2, 11), (3, 11), (3, 12)], "bucket long, node long")
    labels = spark.createDataFrame([(10, 10), (11, 10)], "node long, component long")
    nodes = spark.createDataFrame([(n, 5, 0, [0] * 32, []) for n in (10, 11, 12)], "node long, n_shingles long, level int, sketch array<long>, half array<long>")
    pairs = near_dups._left_over_pairs(buckets, labels, nodes, False, 85)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 12
    assert sorted(map(tuple, pairs.collect())) == [(10, 12), (11, 12)]


def test_packing_and_counting_windows_hold_few_arrays(monkeypatch):
    words = np.random.default_rng(7).integers(0, 50_000, 400_000)
    texts = [" ".join(f"w{w}" for w in words[a : a + 400]) for a in range(0, len(words), 400)]
    batch = pa.RecordBatch.from_pydict({"row_id": pa.array(range(len(texts)), pa.int64()), "row_text": pa.array(range(len(texts)), pa.int64()), "text": texts})
    monkeypatch.setattr(repeats, "slices", partial(repeats.slices, limit=1 << 16))
    monkeypatch.setattr(repeats.TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    peaks = []
    tracemalloc.start()
    try:
        for work in (lambda: [r for b in repeats._packer(35, 1, 16 << 20)(iter([batch])) for r in b.to_pylist()], lambda: repeats._count_group(table)):
            tracemalloc.reset_peak()
            start = tracemalloc.get_traced_memory()[0]
            out = work()
            peaks.append((tracemalloc.get_traced_memory()[1] - start) / len(words))
            table = pa.Table.from_pylist([r for r in out if r["kind"] == "keys"], schema=repeats._PACKED_ARROW) if isinstance(out, list) else None
    finally:
        tracemalloc.stop()
    assert peaks[0] < 62 and peaks[1] < 45, peaks  # bytes a window


def test_settled_links_take_no_step(spark, monkeypatch):
    """A step is a plan of some ten exchanges, and the driver keeps what it needs for each."""
    steps, nearest = [], components._nearest
    monkeypatch.setattr(components, "_nearest", lambda edges: steps.append(1) or nearest(edges))
    found = lambda pairs: dict(components.components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect())
    assert found([(1, 2), (3, 1), (5, 9), (4, 4), (2, 1)]) == {1: 1, 2: 1, 3: 1, 5: 5, 9: 5}
    assert found([(4, 4)]) == {} and not steps
    assert found([(1, 2), (2, 3), (9, 3), (9, 8), (7, 8), (11, 10)]) == {**dict.fromkeys((1, 2, 3, 7, 8, 9), 1), 10: 10, 11: 10} and len(steps) < 4
