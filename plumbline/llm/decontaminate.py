"""Benchmark decontamination by winnowing.

Words: A-Z lower-cased, runs of letters, digits and all characters beyond ASCII. A
benchmark item is covered by its windows of WINDOW words; a shorter item is one window.

Of every window in documents and items, the smallest hash of its GRAM-word runs is the
fingerprint. Equal windows have equal fingerprints, so every shared span of WINDOW words
shares one: documents without a benchmark fingerprint hold no window. Neighbouring windows
mostly share their fingerprint, which leaves two of seven to be joined. The documents
that are left are extended: all their windows are compared with the items' windows by
96 bits of hash. Everything is built-in functions and joins whose small side Spark picks
by its size.

NULL and blank texts have no words; an item without words has no window. Items with the
same id count once; an item without id is named by the empty string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import fresh, let
from plumbline.llm.repeats import keyed
from plumbline.session import materialize

WINDOW = 10
GRAM = 5
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.length(text)
    folded = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(folded, NON_WORD), "")


def _runs(values: Column, length: int, of) -> Column:
    """``of`` every ``length`` neighbours in an array; empty if it has fewer."""
    rest = lambda x, i: of(x, *[F.get(values, i + j) for j in range(1, length)])
    return F.transform(F.slice(values, F.lit(1), F.greatest(F.size(values) - (length - 1), F.lit(0))), rest)


def fingerprints(hashes: Column, length: int) -> Column:
    """The fingerprint of every window of ``length`` words, from the words' hashes."""
    gram = min(GRAM, length)
    wide = length - gram + 1
    grams = _runs(hashes, gram, lambda *h: F.xxhash64(F.lit(gram), *h))
    return let(grams, lambda g: _runs(g, wide, lambda *h: F.least(*h))) if wide > 1 else grams


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _windows(hashes: Column, length: int) -> Column:
    """(length, two hashes) of every window of ``length`` words."""
    return _runs(hashes, length, lambda *h: F.struct(F.lit(length).alias("length"), F.xxhash64(*h).alias("h1"), F.hash(*h).alias("h2")))


def item_windows(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(item, length, fingerprint, h1, h2) of the items' windows."""
    name = F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("item")
    items = benchmark.select(name, _hashes(F.col(f"`{text}`")).alias("hashes")).where("size(hashes) > 0")
    # one expression per length an item can have: only the last has several windows
    of = lambda n: F.arrays_zip(fingerprints(F.col("hashes"), n).alias("f"), _windows(F.col("hashes"), n).alias("w"))
    by_length = F.when(F.size("hashes") >= window, of(window))
    for n in range(1, window):
        by_length = by_length.when(F.size("hashes") == n, of(n))
    rows = items.select("item", F.explode(by_length).alias("x"))
    return rows.selectExpr("item", "x.w.length", "x.f AS fingerprint", "x.w.h1", "x.w.h2").distinct()


def hits(docs: DataFrame, benchmark: DataFrame, doc_id: str, text: str, item_id: str, item_text: str, window: int) -> DataFrame:
    """(row_id, row_text, n_hit, items) of the documents that hold a window of an item."""
    items = materialize(item_windows(benchmark, item_id, item_text, window))
    lengths = sorted(r[0] for r in items.select("length").distinct().collect())  # at most ``window`` numbers
    rows = keyed(docs, doc_id, text)
    every = lambda of: F.flatten(F.array(*[of(F.col("hashes"), n) for n in lengths]))
    if not lengths:
        return rows.where("false").select("row_id", "row_text", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))

    hashed = rows.select("row_id", "row_text", _hashes(F.col("text")).alias("hashes"))
    marks = hashed.select("row_id", "row_text", F.explode(F.array_distinct(every(fingerprints))).alias("fingerprint"))
    able = marks.join(items.select("fingerprint").distinct(), "fingerprint", "left_semi").select("row_id", "row_text").distinct()
    able = materialize(able)

    same = F.col("d.row_id").eqNullSafe(F.col("a.row_id")) & (F.col("d.row_text") == F.col("a.row_text"))
    left = rows.alias("d").join(able.alias("a"), same, "left_semi").dropDuplicates(["row_id", "row_text"])
    placed = lambda h, n: F.transform(_windows(h, n), lambda w, i: F.struct(i.alias("place"), w.alias("w")))
    windows = left.select("row_id", "row_text", _hashes(F.col("text")).alias("hashes")).select("row_id", "row_text", F.explode(every(placed)).alias("x"))
    windows = windows.selectExpr("row_id", "row_text", "x.place", "x.w.length", "x.w.h1", "x.w.h2")
    known = items.select("length", "h1", "h2").distinct()
    found = materialize(windows.join(known, ["length", "h1", "h2"], "left_semi"))

    keys = ["row_id", "row_text"]
    spans = found.groupBy(*keys, "place").agg(F.max("length").alias("length")).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("place", "length"))).alias("spans"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
    covered = F.aggregate(
        "spans", start,
        lambda a, s: F.struct((a["n"] + F.greatest(s["place"] + s["length"] - F.greatest(s["place"], a["upto"]), F.lit(0))).alias("n"), F.greatest(a["upto"], s["place"] + s["length"]).alias("upto")),
    )
    named = found.select(*keys, "length", "h1", "h2").distinct().join(items.select("item", "length", "h1", "h2").distinct(), ["length", "h1", "h2"])
    named = named.groupBy(*keys).agg(F.sort_array(F.collect_set("item")).alias("items"))
    both = spans.select(*keys, covered["n"].alias("n_hit")).alias("s").join(named.alias("i"), F.col("s.row_id").eqNullSafe(F.col("i.row_id")) & (F.col("s.row_text") == F.col("i.row_text")))
    return both.select("s.row_id", "s.row_text", "n_hit", "items")


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per row of ``docs``."""
    found = hits(docs, benchmark, doc_id, text, item_id, item_text, window)
    counted = keyed(docs, doc_id, text).select("row_id", "row_text", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    same = F.col("d.row_id").eqNullSafe(F.col("f.row_id")) & (F.col("d.row_text") == F.col("f.row_text"))
    joined = counted.alias("d").join(found.alias("f"), same, "left")
    items = F.coalesce(F.col("f.items"), F.expr("cast(array() AS array<string>)"))
    n_hit = F.coalesce(F.col("f.n_hit"), F.lit(0).cast("long"))
    return joined.select(
        F.col("d.row_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows without any window of an item, columns unchanged."""
    found = hits(docs, benchmark, doc_id, text, item_id, item_text, window)
    mark = fresh("row_text_hash", docs)
    keys = found.select(F.col("row_id").alias(f"{mark}_id"), F.col("row_text").alias(f"{mark}_text"))
    same = F.col(f"`{doc_id}`").cast("long").eqNullSafe(F.col(f"{mark}_id")) & (F.col(mark) == F.col(f"{mark}_text"))
    return docs.withColumn(mark, F.xxhash64(f"`{text}`")).join(keys, same, "left_anti").drop(mark)
