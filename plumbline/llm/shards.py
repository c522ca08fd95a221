"""Shards of nearly equal bytes, by Karmarkar-Karp differencing.

Documents with equal texts form a group that stays together. A partial partition is a
list of shard sums; combining two adds the largest sums of one to the smallest of the
other, and always the two with the largest spread (largest minus smallest sum) are
combined, until one is left.

Groups are counted in Spark, one row per distinct text. Tasks of bounded size difference
their groups down to one partial partition each. These, a few numbers per task, are
differenced further on the driver, and every task's shards are renamed by the outcome.
So the driver holds shards x tasks numbers and a task GROUPS_PER_TASK groups.

NULL is as the empty text, and both are one group. Rows that repeat a doc_id follow their
texts. A group larger than a fair share makes its shard that much larger.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import materialize

SHARDS = 40
ROW_BYTES = 16
GROUPS_PER_TASK = 50_000
SLOT_ROWS = 20_000


def difference(sums: Iterable[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The sums of the final partition, and for every input the shard that each of its
    own shards goes to. Inputs are vectors of one length."""
    vectors = [np.asarray(x, np.int64) for x in sums]
    shards = len(vectors[0])
    heap, tree = [], []
    for i, v in enumerate(vectors):
        order = np.argsort(-v, kind="stable")
        heap.append((-int(v.max() - v.min()), i, v[order]))
        tree.append((order, None, None))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, i, a = heapq.heappop(heap)
        _, j, b = heapq.heappop(heap)
        total = a + b[::-1]
        order = np.argsort(-total, kind="stable")
        total = total[order]
        tree.append((order, i, j))
        heapq.heappush(heap, (-int(total[0] - total[-1]), len(tree) - 1, total))
    # from the last combination down: where does each place of a node end up?
    place: list[np.ndarray | None] = [None] * len(tree)
    place[-1] = np.arange(shards)
    for node in range(len(tree) - 1, -1, -1):
        order, i, j = tree[node]
        before = np.empty(shards, np.int64)
        before[order] = place[node]  # place before this node's sums were sorted
        place[node] = before
        if i is not None:
            place[i], place[j] = before, before[::-1]
    return heap[0][2], [place[i] for i in range(len(vectors))]


def _differ(shards: int):
    def run(table: pa.Table) -> pa.Table:
        """One task's groups, each with its place in the task's partial partition."""
        size = table.column("size").to_numpy()
        order = np.lexsort((table.column("digest").to_pylist(), -size)) if len(size) else np.empty(0, np.int64)
        singles = np.zeros((len(size), shards), np.int64)
        singles[:, 0] = size[order]
        _, places = difference(singles)
        place = np.empty(len(size), np.int32)
        place[order] = [p[0] for p in places]
        return pa.table({"digest": table.column("digest"), "task": table.column("task"), "size": table.column("size"), "place": pa.array(place)})

    return run


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def assign(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, groups_per_task: int = GROUPS_PER_TASK) -> DataFrame:
    """(doc_id, size, text_crc32, shard) per row of ``docs``."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_bytes(F.col(f"`{text}`")).alias("size"), F.crc32(body).alias("text_crc32"), F.unhex(F.sha1(body)).alias("digest"))
    rows = materialize(rows)
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size"))
    groups = materialize(groups)
    tasks = max(1, -(-groups.count() // groups_per_task))
    dealt = groups.withColumn("task", F.pmod(F.xxhash64("digest"), F.lit(tasks)).cast("int"))
    placed = materialize(dealt.groupBy("task").applyInArrow(_differ(shards), "digest binary, task int, size long, place int"))

    partial = np.zeros((tasks, shards), np.int64)
    for r in placed.groupBy("task", "place").agg(F.sum("size").alias("size")).collect():  # tasks x shards numbers
        partial[r["task"], r["place"]] = r["size"]
    _, places = difference(partial)
    renamed = [(t, p, int(s)) for t, row in enumerate(places) for p, s in enumerate(row)]
    names = docs.sparkSession.createDataFrame(renamed, "task int, place int, shard int")
    of_group = placed.join(names, ["task", "place"]).select("digest", "shard")
    return rows.join(of_group, "digest").select("doc_id", "size", "text_crc32", "shard")


def with_slots(rows: DataFrame, key: str, order: list[str], into: str = "slot", slot_rows: int = SLOT_ROWS) -> DataFrame:
    """``rows`` with a number from 0 without gaps inside each ``key``.

    A key's rows are numbered in buckets of about ``slot_rows``, each a sort of its own, and
    the buckets' offsets are sums of their counts: a key with a third of all rows is many
    tasks' work.
    """
    counts = rows.groupBy(key).count()
    buckets = max(1, -(-(counts.agg(F.max("count")).first()[0] or 0) // slot_rows))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sizes = dealt.groupBy(key, "bucket").count()
    # one row per key and bucket
    ahead = sizes.selectExpr("*", f"sum(count) OVER (PARTITION BY {key} ORDER BY bucket) - count AS ahead").drop("count")
    numbered = dealt.selectExpr("*", f"row_number() OVER (PARTITION BY {key}, bucket ORDER BY {', '.join(order)}) - 1 AS inside")
    return numbered.join(ahead, [key, "bucket"]).withColumn(into, (F.col("inside") + F.col("ahead")).cast("long")).drop("inside", "ahead", "bucket")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, **sizes: int) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) per row of ``docs``."""
    placed = materialize(assign(docs, doc_id, text, shards, **sizes))
    slotted = with_slots(placed, "shard", ["doc_id", "text_crc32", "size"])
    return slotted.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
