from __future__ import annotations

import hashlib
from collections import Counter

from helpers import rows
from pyspark.sql import functions as F

from plumbline.operators import rules, skew


def skewed(spark, n=30_000):
    """A third of the rows under one key, a tenth without key, the rest spread."""
    key = F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 10 = 1 THEN NULL ELSE concat('k', id % 4000) END")
    return spark.range(n).select(F.col("id"), key.alias("k"))


def test_hot_keys_are_found_and_bounded(spark):
    df = skewed(spark)
    hot = skew.find_hot_keys(df, ["k"], ["id"])
    expected = df.select(F.xxhash64(F.lit("hot"))).first()[0]
    assert hot[0].hashes == (expected,) and hot[0].many_nulls
    assert hot[1].hashes == () and not hot[1].many_nulls and not hot[1].any


def test_left_join_unique_matches_a_plain_join_under_skew(spark):
    df = skewed(spark)
    lookup = spark.createDataFrame([("hot", 1, None), ("k5", 2, "b"), ("k7", 3, "c"), (None, 9, "never")], "k string, a int, b string")
    got = skew.left_join_unique(df, lookup, ["k"])
    plain = df.join(lookup, "k", "left").select("id", "k", "a", "b")
    assert got.count() == df.count()
    assert got.select("id", "k", "a", "b").exceptAll(plain).count() == 0
    assert got.where("k IS NULL AND a IS NOT NULL").count() == 0


def test_salt_spreads_the_hot_key(spark):
    df = skewed(spark)
    lookup = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("a"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = skew.left_join_unique(df, lookup, ["k"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(sizes) == 1 or max(sizes) < 0.5 * sum(sizes)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_duplicate_counts_under_skew_match_brute_force(spark):
    df = skewed(spark)
    counted = rules.add_duplicate_count(df, ["k"], "n", spread_by=["id"])
    data = [tuple(r) for r in df.collect()]
    copies = Counter(k for _, k in data)
    expected = sorted((i, copies[k] if k is not None else 1) for i, k in data)
    assert sorted(tuple(r) for r in counted.select("id", "n").collect()) == expected


def test_keep_one_per_key_is_whole_and_deterministic(frame):
    df = frame([("a", 1, "x", None), ("a", 2, None, "p"), ("b", None, "z", "q"), ("b", 1, "w", "r")], "k string, t int, u string, v string")
    assert rows(skew.keep_one_per_key(df, ["k"], ["t", "u"])) == [("a", 2, None, "p"), ("b", 1, "w", "r")]
    assert rows(skew.keep_one_per_key(df, ["k"], ["t", "u"], newest=False)) == [("a", 1, "x", None), ("b", None, "z", "q")]


def test_smallest_by_hash_takes_exactly_n(spark):
    df = spark.range(5000).select(F.concat(F.lit("R-"), "id").alias("id"))
    ids = [r.id for r in df.collect()]
    order = sorted(ids, key=lambda i: (hashlib.md5(("s" + i).encode()).hexdigest(), i))
    for n in (0, 1, 137, 4999, 5000, 6000):
        got = sorted(r.id for r in skew.smallest_by_hash(df, "id", n, "s").collect())
        assert got == sorted(order[:n]), n


def test_smallest_by_hash_with_a_null_key(frame):
    df = frame([(str(i),) for i in range(20)] + [(None,)], "id string")
    assert skew.smallest_by_hash(df, "id", 7).count() == 7
