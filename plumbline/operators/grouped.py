"""Group summaries with exact distinct counts and sets, without expanding rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GROUP = ("_group_a", "_group_b")


def _group_hash(keys: Sequence[str]) -> dict[str, Column]:
    """A group as two 64-bit numbers. A hash skips NULL parts, so it also takes in which
    parts are NULL."""
    missing = [F.when(F.col(k).isNull(), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, k in enumerate(keys)]
    mark = reduce(add, missing, F.lit(0).cast("bigint"))
    return {GROUP[0]: F.xxhash64(mark, *keys), GROUP[1]: F.xxhash64(F.lit("b"), mark, *keys)}


def summarize(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Column],
    reads: Sequence[str],
    *,
    distinct: Mapping[str, str] | None = None,
    sets: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per group: its keys (NULL being a value; at most 62), ``measures`` of the
    columns ``reads``, the number of ``distinct`` values of columns, and ``sets`` as sorted
    arrays of their values.

    Measures add up in each task, by the keys themselves. Distinct values and sets are
    reduced in two steps, to one row per group and value before they meet, with the group
    as two numbers instead of wide keys; so no row is copied per count and a group with
    most rows is spread over all tasks until its values are few.

    Measures are one pass over ``df``, the sets one and each count one more: ``df`` should
    be a stored table. A plan that uses only measures of the result reads ``df`` once, as
    Spark leaves out the left joins it has no use for.
    """
    distinct, sets = distinct or {}, sets or {}
    used = df.select(*dict.fromkeys([*keys, *reads, *distinct.values(), *sets.values()]))
    group = [c.alias(name) for name, c in _group_hash(keys).items()]
    measured = used.groupBy(*keys).agg(*measures)
    out = measured.select(*group, *measured.columns)
    if sets:
        values = {f"_set_{i}": source for i, source in enumerate(sets.values())}
        faces = used.select(*group, *[F.col(s).alias(n) for n, s in values.items()]).distinct()
        gathered = [F.array_sort(F.collect_set(v)).alias(name) for v, name in zip(values, sets)]
        out = out.join(faces.groupBy(*GROUP).agg(*gathered), list(GROUP), "left")
    for name, source in distinct.items():
        met = used.where(F.col(source).isNotNull()).select(*group, F.col(source).alias("_value")).distinct()
        out = out.join(met.groupBy(*GROUP).agg(F.count("*").alias(name)), list(GROUP), "left")
    counts = {name: F.coalesce(name, F.lit(0).cast("bigint")) for name in distinct}
    return out.select(*measured.columns, *sets, *[c.alias(name) for name, c in counts.items()])
