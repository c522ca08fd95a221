"""Joins and selections that stay balanced when one key holds most rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.clean import is_true, quoted

# A key is hot when it holds more than 1/HOT_KEY_BOUND of all rows. Fewer than
# HOT_KEY_BOUND keys can do so, whatever the data: that is the size bound which
# makes broadcasting the hot keys safe.
HOT_KEY_BOUND = 1000

# Number of buckets used to locate the n-th smallest hash (three hex digits).
HASH_BUCKETS = 4096


def _all_present(keys: Sequence[str]) -> Column:
    return F.expr(" AND ".join(f"{quoted(key)} IS NOT NULL" for key in keys))


def count_per_key(df: DataFrame, keys: Sequence[str], name: str = "row_count") -> DataFrame:
    """Rows per key, keys with a NULL part left out. Counted before the shuffle,
    so a hot key sends one row per task."""
    return df.where(_all_present(keys)).groupBy(*keys).agg(F.count("*").alias(name))


@dataclass(frozen=True)
class HotKeys:
    """What ``find_hot_keys`` saw of one set of key columns."""

    keys: tuple[str, ...]
    hashes: tuple[int, ...]
    many_nulls: bool

    @property
    def any(self) -> bool:
        return bool(self.hashes) or self.many_nulls


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def find_hot_keys(df: DataFrame, *key_sets: Sequence[str]) -> list[HotKeys]:
    """Keys that hold more than their share of rows, for several key sets at once.

    One narrow pass: every task keeps a small frequent-items sketch per key set,
    the sketches are merged, and at most HOT_KEY_BOUND hashes per set reach the
    driver. Keys are not shuffled. The outcome decides how rows travel in a join,
    never what they match, so an estimate is enough.
    """
    measures = [F.count("*").alias("total")]
    for i, keys in enumerate(key_sets):
        named = [quoted(k) for k in keys]
        present = " AND ".join(f"{k} IS NOT NULL" for k in named)
        sketch = f"approx_top_k(xxhash64({', '.join(named)}), {HOT_KEY_BOUND}, 20000) FILTER (WHERE {present})"
        measures += [F.expr(sketch).alias(f"top_{i}"), F.count_if(~F.expr(present)).alias(f"nulls_{i}")]
    seen = df.agg(*measures).first()
    found = []
    for i, keys in enumerate(key_sets):
        hashes = tuple(e["item"] for e in seen[f"top_{i}"] or () if e["count"] * HOT_KEY_BOUND > seen["total"])
        found.append(HotKeys(tuple(keys), hashes, seen[f"nulls_{i}"] * HOT_KEY_BOUND > seen["total"]))
    return found


def left_join_unique(
    fact: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    *,
    spread_by: Sequence[str] | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Left join ``fact`` to a ``lookup`` that has at most one row per key.

    Without hot keys this is an ordinary join. Otherwise the rows of a hot key
    get their match from a broadcast of the hot keys' lookup rows (fewer than
    HOT_KEY_BOUND), and in the shuffle they carry a salt, as do rows with a NULL
    key: they spread over all tasks instead of meeting in one. ``hot`` hands in
    what ``find_hot_keys`` saw, when it was measured on a cheaper plan.
    """
    keys = list(keys)
    hot = find_hot_keys(fact, keys)[0] if hot is None else hot
    usable = lookup.where(_all_present(keys))
    if not hot.any:
        return fact.join(usable, keys, "left")

    payload = [c for c in lookup.columns if c not in keys]
    packed = usable.select(*keys, F.struct(*payload).alias("_match"))
    is_hot = is_true(_hash(keys).isin(*hot.hashes)) if hot.hashes else F.lit(False)
    hot_matches = packed.where(is_hot).withColumnRenamed("_match", "_hot_match")
    spread = F.xxhash64(*(spread_by or fact.columns)).bitwiseOR(F.lit(1))
    alone = is_hot | ~_all_present(keys)
    joined = (
        fact.withColumn("_salt", F.when(alone, spread).otherwise(F.lit(0)))
        .join(packed.withColumn("_salt", F.lit(0).cast("bigint")), [*keys, "_salt"], "left")
        .join(F.broadcast(hot_matches), keys, "left")
    )
    return joined.selectExpr(
        *[quoted(c) for c in fact.columns],
        *[f"coalesce(_match, _hot_match).{quoted(c)} AS {quoted(c)}" for c in payload],
    )


def keep_one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, *, newest: bool = True) -> DataFrame:
    """One whole row per key: the last (or first) by ``order``.

    An aggregate, not a window: each task reduces its own rows before the
    shuffle, so a key with very many rows costs one row per task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if newest else F.min_by
    packed = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return packed.selectExpr(*[quoted(c) if c in keys else f"_row.{quoted(c)}" for c in df.columns])


def smallest_by_hash(df: DataFrame, key: str, n: int, seed: str = "") -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer) chosen by the order of a key hash.

    The choice depends on the keys and the seed only, so a rerun gives the same
    rows. A plain sort and limit would bring n rows of every task into one; here
    a count per hash bucket (at most HASH_BUCKETS rows) finds the bucket in which
    the n-th row lies, lower buckets are taken whole and in place, and only that
    one bucket is sorted. ``key`` should be unique.
    """
    if n <= 0:
        return df.limit(0)
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.lit(seed), text).cast("binary"))
    hashed = df.withColumn("_digest", digest).withColumn("_bucket", F.substring("_digest", 1, 3))
    sizes = sorted(hashed.groupBy("_bucket").count().collect())  # at most HASH_BUCKETS rows
    taken = 0
    for bucket, size in sizes:
        if taken + size >= n:
            break
        taken += size
    else:
        return df
    whole = hashed.where(F.col("_bucket") < bucket)
    partial = hashed.where(F.col("_bucket") == bucket).orderBy("_digest", key).limit(n - taken)
    return whole.unionByName(partial).drop("_digest", "_bucket")
