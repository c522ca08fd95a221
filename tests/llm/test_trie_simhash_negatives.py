"""Prefix trie, SimHash and hard negatives against plain Python, with odd rows."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import negatives, prefix_trie, simhash
from plumbline.session import materialize


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, str(x)) for x in r))


TURNS = "conv_id long, turn long, role string, text string, part string, place long, x string, depth string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "p", 7, "x", "d") for r in rows], TURNS)


def chats():
    """Conversations with shared heads, copies, prefixes of others, and odd turns."""
    rnd = random.Random(11)
    said = ["", "a b", "c\td e", None, "é\x0b", "f"]
    rows = []
    for c in range(130):
        for turn in range(rnd.randint(1, 6)):
            rows.append((c, turn, rnd.choice(["user", "assistant", None, ""]), rnd.choice(said)))
    for c in range(200, 260):  # copies, and proper prefixes of them
        rows += [(c, t, "user", f"copy {t}") for t in range(3 + c % 3)]
    rows += [(300, None, "user", "no number"), (300, 1, "user", "one"), (300, 1, "user", "one"), (300, 1, None, "one"), (300, -5, "user", None)]
    rows += [(-7, 0, "user", "below zero"), (-20, 0, "user", "below"), (-27, 1, "user", "zero"), (None, 0, "user", "nobody's")]
    rows += [(c, 0, "user", "short") for c in range(1000, 1060)]  # heads take all of their own turns
    rnd.shuffle(rows)
    return rows


def test_prefix_trie(spark):
    rows = chats()
    assert ordered(prefix_trie.report(conversations(spark, rows)).collect()) == ordered(brute.trie(rows))


def test_long_conversation_is_cut_into_ranges(spark):
    """One conversation with most rows, dealt out over several ranges."""
    rows = [(40, t, "user", f"turn {t % 7}") for t in range(400)] + [(60 + c, t, "user", f"turn {t % 7}") for c in range(3) for t in range(30)]
    table = conversations(spark, rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        places = materialize(prefix_trie.ordered_turns(table))
        got = prefix_trie.report(table).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert places.where("conv = 40").select("part").distinct().count() > 1
    assert ordered(got) == ordered(brute.trie(rows))


def test_many_ends_are_hashed_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ID_BLOCK", 5)
    rows = [(c, t, "user", "same") for c in [*range(-30, 90), 10**12] for t in range(4)]
    assert ordered(prefix_trie.report(conversations(spark, rows)).collect()) == ordered(brute.trie(rows))


def test_trie_of_nothing(spark):
    assert prefix_trie.report(conversations(spark, [])).collect() == []
    assert prefix_trie.report(conversations(spark, [(None, 1, "user", "x")])).collect() == []


def texts():
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(50)]
    base = [rnd.choice(words) for _ in range(200)]
    out = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 60))) for _ in range(40)]
    for _ in range(40):
        near = list(base)
        near[rnd.randrange(200)] = rnd.choice(words)
        out.append(" ".join(near))
    out += [out[3]] * 5 + [out[3].upper(), "", None, " \n\t", "one", "ONE", "one two", "É é", "é É", "a " * 3000]
    rows = list(enumerate(out))
    return rows + [rows[3], (3, "another text"), (None, out[5]), (None, "alone and without an id")]


@pytest.mark.parametrize("bucket", [64, 8])
def test_simhash(docs, bucket):
    rows = texts()
    got = simhash.near_duplicates(docs(rows), bucket=bucket)
    got = got.select("row_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id").collect()
    assert ordered(got) == ordered(brute.simhash(rows))


def test_simhash_of_long_texts_in_pieces(docs, monkeypatch):
    text = " ".join(f"word{i % 977}é" for i in range(60_000))
    want = brute.simhash([(1, text)])[0][1]
    assert f"{simhash.fingerprints([text.encode()])[0]:016x}" == want
    monkeypatch.setattr(simhash, "PIECE_BYTES", 1000)
    assert f"{simhash.fingerprints([memoryview(text.encode())])[0]:016x}" == want
    # words longer than a piece
    odd = "x" * 5000 + " " + "y" * 5000
    assert f"{simhash.fingerprints([odd.encode()])[0]:016x}" == brute.simhash([(1, odd)])[0][1]


def test_simhash_of_nothing(docs):
    assert simhash.report(docs([])).collect() == []


def test_links_of_crowded_buckets_are_refined(spark):
    """Fingerprints around a few centres, far more than a bucket holds, against all pairs."""
    rnd = random.Random(5)
    marks = set()
    for centre in (0, 0x0F0F00FF12345678, (1 << 64) - 1):
        for _ in range(250):
            x = centre
            for _ in range(rnd.randint(0, 9)):
                x ^= 1 << rnd.randrange(64)
            marks.add(x)
    marks = sorted(marks)
    signed = [x - (1 << 64) if x >> 63 else x for x in marks]
    found = simhash.close_links(spark.createDataFrame([(x,) for x in signed], "fp long"), bucket=64).collect()
    assert len(found) < 40 * len(marks)

    def parts(pairs):
        parent = {x: x for x in signed}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            parent[root(a)] = root(b)
        groups = {}
        for x in signed:
            groups.setdefault(root(x), set()).add(x)
        return {frozenset(g) for g in groups.values()}

    v = np.array(marks, np.uint64)
    a, b = np.nonzero(np.triu(np.bitwise_count(v[:, None] ^ v[None]) <= 3, 1))
    assert parts((r.a, r.b) for r in found) == parts((signed[i], signed[j]) for i, j in zip(a, b))


def vectors(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return table.withColumn("leaf", F.lit("x")).withColumn("row", F.lit(1)).withColumn("q", F.lit("q"))


def embedded(n, seed=1):
    rnd = np.random.default_rng(seed)
    centre = rnd.normal(size=(12, 8))
    x = centre[rnd.integers(0, 12, n)] + 0.4 * rnd.normal(size=(n, 8))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    rows = [(i, x[i].tolist(), int(rnd.integers(0, 3))) for i in range(n)]
    odd = [(n, None, 1), (n + 1, x[0].tolist(), None), (n + 2, [0.5, None], 1), (n + 3, [float("nan")] * 8, 1), (n + 4, [float("inf")] * 8, 1), (None, x[1].tolist(), 1)]
    same = [(n + 10 + i, x[5].tolist(), i % 3) for i in range(40)]  # ties
    return rows + odd + same + [rows[7]] * 3 + [rows[100]] * 2 + [(900_000, [], 1), (900_100, [0.5], 2), (900_200, [-3.0] * 8, 9)]


def test_hard_negatives(spark):
    rows = embedded(900)
    assert ordered(negatives.report(vectors(spark, rows)).collect()) == ordered(brute.hard_negatives(rows))


def test_hard_negatives_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROW_BLOCK", 50)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 3)
    rows = embedded(700, seed=2)
    assert ordered(negatives.report(vectors(spark, rows)).collect()) == ordered(brute.hard_negatives(rows))


def test_hard_negatives_of_large_values(spark):
    rows = [(i, [float((i * 7919) % 1000 - 300) * 1e4, float(i % 17) * 1e5], i % 4) for i in range(300)]
    assert ordered(negatives.report(vectors(spark, rows)).collect()) == ordered(brute.hard_negatives(rows))


def test_hard_negatives_of_nothing(spark):
    assert negatives.report(vectors(spark, [])).collect() == []
    assert negatives.report(vectors(spark, [(100, [0.5], 1)])).collect() == []


def test_tree_leaves_out_only_what_cannot_match():
    """Clustered vectors: every row inside a window lies in a leaf that is visited, and most
    leaves are not visited."""
    rnd = np.random.default_rng(4)
    q = np.floor(256 * np.repeat(rnd.normal(size=(30, 6)), 40, axis=0) + rnd.normal(size=(1200, 6))).astype(np.int64)
    square = float((q * q).sum(axis=1).max())
    tree = negatives.plant(q[::7], 6, square, 6, 2)
    x = tree.lengthened(q)
    low, high = {n: np.full((6, 6), np.inf) for n in tree.points}, {n: np.full((6, 6), -1.0) for n in tree.points}
    for node, _, d, child in tree.descend(x):
        for j in np.unique(child):
            low[node][:, j], high[node][:, j] = d[child == j].min(axis=0), d[child == j].max(axis=0)
    leaf, ranges = tree.leaf(x), negatives.Ranges(tree, low, high)
    score = q[:20] @ q.T
    most = np.sort(score, axis=1)[:, -4]
    least = (most * 0.95).astype(np.int64)
    visited = np.zeros((20, leaf.max() + 1), bool)
    for name, rows in ranges.leaves(q[:20], least, most):
        visited[rows, name] = True
    wanted = (score >= least[:, None]) & (score <= most[:, None])
    assert all(visited[i, leaf[j]] for i, j in zip(*np.nonzero(wanted)))
    assert visited[:, np.unique(leaf)].mean() < 0.7
