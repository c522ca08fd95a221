"""The pipeline against plain Python, and its guard."""

from __future__ import annotations

import os
import random

import brute
import pytest

from plumbline.llm import near_dups

corpus_pipeline = pytest.importorskip("corpus_pipeline")
STOP = ["the", "and", "of", "to"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 8))) for _ in range(500)]
    prose = lambda n: " ".join(rnd.choice(STOP) if i % 3 == 0 else rnd.choice(words) for i in range(n))
    texts = [prose(rnd.randint(80, 200)) for _ in range(25)]
    shared, leak = prose(50), prose(14)
    near = texts[0].split()
    near[40] = "changed"
    texts += [texts[1], " ".join(near), f"{prose(70)} {shared} {prose(60)}", f"{prose(70)} {shared}", f"{prose(60)}\n{leak}\n{prose(30)}", prose(10), "$$$ ### " * 60, "", None]
    root = tmp_path_factory.mktemp("tables")
    rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, leak), (2, "unseen words only " * 5)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), list(enumerate(texts)), [(1, leak)]


def good(text):
    n, chars, symbols, dup, repeat = brute.measures(text)
    if n < 50 or 100 * repeat > 50 * n:
        return False
    lines = [x for x in text.split("\n") if brute.WORD.search(x)]
    stop = sum(w.lower() in {*STOP, "a", "in", "is", "it", "as", "be"} for w in brute.WORD.findall(text))
    return 2 <= chars / n <= 15 and symbols / n <= 0.3 and stop / n >= 0.01 and dup / len(lines) <= 0.3


def test_stages_in_order(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    expected = [r for r in rows if good(r[1])]
    steps = []
    steps.append(dict(expected))
    expected = [r for r, (*_, kept) in zip(expected, brute.near(expected)) if kept]
    steps.append(dict(expected))
    lost = {i: digest for i, _, n, digest in brute.repeats(expected, 35) if n}
    assert lost and len(steps[1]) < len(steps[0]) < len(rows)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = spark.createDataFrame(stage(spark, docs, path).collect(), docs.schema)
        assert docs.columns == columns
        got = {r.doc_id: r.text for r in docs.collect()}
        if k < 2:
            assert got == steps[k]
        if k == 2:
            assert got.keys() == steps[1].keys()
            assert all(brute.sha(got[i]) == lost[i] if i in lost else got[i] == steps[1][i] for i in got)
            leaking = {r[0] for r in brute.leaks(sorted(got.items()), items) if r[-1]}
            assert leaking
        if k == 3:
            assert got.keys() == steps[1].keys() - leaking
    last = corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()
    assert {r.doc_id for r in last} == got.keys() and all(r.round_trip and r.n_tokens == len(r.ids) for r in last)


def test_near_dedup_links_from_four_fifths(spark, docs):
    """Texts of 100 shingles with some fresh words: similarities around 0.80 and 0.85."""
    words = [f"w{i}" for i in range(2000)]
    texts = []
    for k in (8, 10, 11, 12, 13):  # 100 of 100 + 2k shingles are in both
        base = [f"t{k}x{w}" for w in words[:104]]
        texts += [" ".join(base + [f"a{k}{i}" for i in range(k)]), " ".join(base + [f"b{k}{i}" for i in range(k)])]
    long = [f"l{w}" for w in words]  # sampled sketches: 1,996 of 2,436 shingles, 0.82
    texts += [" ".join(long + [f"c{i}" for i in range(220)]), " ".join(long + [f"d{i}" for i in range(220)])]
    rows = list(enumerate(texts))
    want = [{i for i, _, _, kept in brute.near(rows, percent) if kept} for percent in (80, 85)]
    assert len(want[0]) < len(want[1])
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert {r.doc_id for r in stage(spark, docs(texts), "").collect()} == want[0]
    assert {r.doc_id for r in near_dups.report(docs(texts)).where("kept").collect()} == want[1]


def test_run(spark, folder):
    path, rows, _ = folder
    out = corpus_pipeline.run(spark, path)
    assert 0 < out.count() < len(rows) and out.where("NOT round_trip").count() == 0


def test_every_operator_has_a_query():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_else_imports_the_text_operators():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, files in os.walk(os.path.join(root, "plumbline")):
        if os.path.basename(folder) != "llm":
            for name in files:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name)) as file:
                        assert "plumbline.llm" not in file.read()
