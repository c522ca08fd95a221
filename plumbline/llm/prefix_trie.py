"""Trie of the prefixes that conversations share, by whole-sequence collapse.

Identical conversations are grouped into one weighted sequence with the list of the
conversations that end there. Sequences that are a proper prefix of another one are taken
out by an anti-join; what is left are the leaves. Each sequence, not each conversation,
is then spread into its prefixes, and a node is the sum of the weights of the prefixes
that are equal. All steps are linear in the number of turns:

* A prefix is named by two 64-bit values, each the exclusive or of hashes of (place, turn)
  over its turns. They are running values, so a conversation of any length is cut: turns
  are dealt out by ranges of (conversation, turn), a range adds up its own turns, and what
  earlier ranges of the same conversation hold is carried over, one row per range.
* Words of the nodes below a node are not summed over pairs of nodes. Every node belongs
  to the sequence of its smallest member, which owns a lower part of its own path; a
  sequence adds to a node the words of what it owns from that depth on.
* Conversation ids that end at a node are joined to text in blocks of neighbouring ids; a
  task then hashes the blocks of a node in order, holding one block at a time.

Turns of a conversation are ordered by ``turn``, NULL first; turns of one number by the
MD5 of role and text, so rows that repeat are turns of their own. NULL role or text is
empty. Rows without a conv_id take no part. No conversations give no nodes; one without
turns is a member of the root only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.skew import left_join_unique
from plumbline.session import materialize

WORD = r"[^\\x20\\x09-\\x0D]+"
HEAD_OF = 20
HEAD_TURNS = 4
ID_BLOCK = 4096

_NODE = ["depth", "a", "b"]
_NOTHING = hashlib.sha256().hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, part, place, digest, words): the turns in order from place 0, dealt out by
    ranges; ``part`` grows with the place inside a conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.md5(F.concat_ws(":", F.length(role).cast("string"), role, text)).alias("digest"),
        F.expr(f"cast(regexp_count(coalesce(text, ''), '{WORD}') AS long)").alias("words"),
    )
    order = [F.asc_nulls_first("turn"), F.asc("digest")]
    dealt = materialize(turns.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()))
    blocks = dealt.groupBy("conv", "part").agg(F.count("*").alias("n"))
    carried = blocks.select("conv", "part", _carry(F.sum("n"), "n").alias("before"))
    inside = F.row_number().over(Window.partitionBy("conv", "part").orderBy(*order)) - 1
    return dealt.join(carried, ["conv", "part"]).select("conv", "part", (F.col("before") + inside).alias("place"), "digest", "words")


def _carry(value: Column, name: str) -> Column:
    """What the earlier ranges of a conversation add up to; one row per range."""
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(value.over(earlier), F.lit(0).cast("long"))


def rebuilt(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv), and their turns (conv, part, depth, digest, words) with depth
    from 1, after each conversation c got the first h turns of c - c % 20 in place of its
    own; h is the CRC-32 of its decimal id modulo 4."""
    blocks = places.groupBy("conv", "part").agg(F.count("*").alias("n"))
    sizes = blocks.groupBy("conv").agg(F.sum("n").alias("n"))
    asked = sizes.select("conv", (F.col("conv") - F.col("conv") % HEAD_OF).alias("donor"), (F.crc32(F.col("conv").cast("string").cast("binary")) % HEAD_TURNS).alias("h"))
    given = sizes.select(F.col("conv").alias("donor"), F.col("n").alias("held"))
    heads = materialize(asked.join(given, "donor", "left").select("conv", "donor", "h", F.least("h", F.coalesce("held", F.lit(0))).alias("head")))
    # joined by range, so that a very long conversation stays spread out
    by_block = blocks.join(heads, "conv").select("conv", "part", "h", "head")
    own = places.join(by_block, ["conv", "part"]).where("place >= h").select("conv", "part", (F.col("head") + F.col("place") - F.col("h") + 1).alias("depth"), "digest", "words")
    first = places.where(F.col("place") < HEAD_TURNS - 1).withColumnRenamed("conv", "donor")
    lent = first.join(heads, "donor").where("place < head").select("conv", F.lit(-1).alias("part"), (F.col("place") + 1).alias("depth"), "digest", "words")
    return heads.select("conv"), own.unionByName(lent)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the id blocks of each node; rows come sorted by node and block."""
    node, state = None, None

    def done(rows):
        names = ["depth", "a", "b", "ends_sha256"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    for batch in batches:
        out = []
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "ids"))):
            if key != node:
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield done(out)
    if node is not None:
        yield done([(*node, state.hexdigest())])


def _ends(members: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of the nodes where conversations end."""
    ids = F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string"))
    blocks = members.groupBy(*_NODE, F.expr(f"conv div {ID_BLOCK}").alias("block")).agg(F.array_join(ids, ",").alias("ids"))
    dealt = blocks.repartition(*_NODE).sortWithinPartitions(*_NODE, "block")
    return dealt.select(*_NODE, "ids").mapInArrow(_hash_ends, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie over ``convs`` (conv) and their ``turns`` (conv, part, depth,
    digest, words); ``part`` is any split of a conversation into consecutive stretches.

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.
    """
    hashed = materialize(turns.select("conv", "part", "depth", "words", F.xxhash64(F.lit(1), "depth", "digest").alias("x"), F.xxhash64(F.lit(2), "depth", "digest").alias("y")))
    blocks = materialize(hashed.groupBy("conv", "part").agg(F.count("*").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("words").alias("words")))
    whole = blocks.groupBy("conv").agg(F.sum("n").alias("depth"), F.bit_xor("x").alias("a"), F.bit_xor("y").alias("b"), F.sum("words").alias("words"))
    members = materialize(convs.join(whole, "conv", "left").na.fill(0, ["depth", "a", "b", "words"]))
    sequences = materialize(members.groupBy(*_NODE).agg(F.min("conv").alias("conv"), F.count("*").alias("weight"), F.min("words").alias("total")))

    # the prefixes of each sequence, spread out once
    carried = blocks.select("conv", "part", _carry(F.bit_xor("x"), "x").alias("x0"), _carry(F.bit_xor("y"), "y").alias("y0"), _carry(F.sum("words"), "words").alias("words0"))
    known = carried.join(sequences.select("conv", "weight", "total", F.col("depth").alias("length")), "conv")
    so_far = Window.partitionBy("conv", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = hashed.join(known, ["conv", "part"]).select(
        "conv", "part", "depth", "words", "weight", "length", "x", "y",
        F.col("x0").bitwiseXOR(F.bit_xor("x").over(so_far)).alias("a"),
        F.col("y0").bitwiseXOR(F.bit_xor("y").over(so_far)).alias("b"),
        (F.col("total") - F.col("words0") - F.sum("words").over(so_far) + F.col("words")).alias("rest"),
    )
    below = running.select("conv", "part", "depth", "words", "weight", "length", "a", "b", F.col("a").bitwiseXOR(F.col("x")).alias("up_a"), F.col("b").bitwiseXOR(F.col("y")).alias("up_b"), "rest")
    top = sequences.selectExpr("conv", "-2 AS part", "0L AS depth", "0L AS words", "weight", "depth AS length", "0L AS a", "0L AS b", "cast(NULL AS long) AS up_a", "cast(NULL AS long) AS up_b", "total AS rest")
    prefixes = materialize(below.unionByName(top))

    nodes = materialize(
        prefixes.groupBy(*_NODE).agg(
            F.min("conv").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum(F.col("weight") * F.col("rest")).alias("member_words"),
            F.min("words").alias("words"), F.min("up_a").alias("up_a"), F.min("up_b").alias("up_b"),
        )
    )
    proper = prefixes.where("depth < length").select(*_NODE).distinct()
    leaves = sequences.join(proper, _NODE, "left_anti").select("conv", F.lit(1).alias("leaf"))
    owned = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.min("depth").alias("owned_from"), F.sum("words").alias("owned_words"))
    facts = sequences.select("conv").join(owned, "conv", "left").join(leaves, "conv", "left").na.fill(0, ["leaf", "owned_words"])
    by_block = prefixes.select("conv", "part").distinct().join(facts, "conv")
    own_words = F.when(F.col("depth") >= F.col("owned_from"), F.col("rest")).otherwise(F.col("owned_words"))
    sums = prefixes.join(by_block, ["conv", "part"]).groupBy(*_NODE).agg(F.sum("leaf").alias("n_leaves"), F.sum(own_words).alias("node_words"))

    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count("*").alias("n_children"))
    filled = nodes.join(sums, _NODE).join(children, _NODE, "left").join(_ends(members.select("conv", *_NODE)), _NODE, "left")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"))
    # a node may have a third of all nodes as children
    tied = left_join_unique(materialize(filled), parents, ["depth", "up_a", "up_b"], spread_by=["a", "b"])
    return tied.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves",
        (F.col("member_words") - F.col("node_words")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"),
    )


def report(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations, a row per node."""
    return prefix_trie(*rebuilt(materialize(ordered_turns(conversations))))
