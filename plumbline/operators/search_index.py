"""Substring search by an index of letter triples.

The index holds each distinct lower-cased value of the searched columns once, and for each
run of three characters the values that have it, in parts by a hash of the triple and
sorted inside. A search reads only the parts of the rarest triples of its text, takes the
values that have them all, and tests those exactly. A meter id that stands in millions of
rows is one value.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.clean import quoted

GRAM = 3
PARTS = 256
# Triples of a text that are looked up: more would read more and leave out little.
LOOKED_UP = 3


def _lowered(column: str) -> Column:
    return F.lower(F.col(quoted(column)).cast("string"))


def _part(gram: Column | str) -> Column:
    return F.expr(f"cast(pmod(xxhash64(gram), {PARTS}) AS int)") if isinstance(gram, str) else F.pmod(F.xxhash64(gram), F.lit(PARTS)).cast("int")


def build_index(df: DataFrame, columns: Sequence[str], path: str) -> None:
    """Write the index of ``columns`` to a folder: values, triples with their values, and how
    many values each triple has."""
    spark = df.sparkSession
    values = df.select(F.explode(F.array(*[_lowered(c) for c in columns])).alias("value")).where("value IS NOT NULL").distinct()
    values.write.mode("overwrite").parquet(f"{path}/values")
    held = spark.read.schema("value string").parquet(f"{path}/values")
    places = F.when(F.length("value") >= GRAM, F.sequence(F.lit(1), F.length("value") - (GRAM - 1)))
    grams = held.select("value", F.explode(F.array_distinct(F.transform(places, lambda i: F.substr(F.col("value"), i, F.lit(GRAM))))).alias("gram"))
    dealt = grams.withColumn("part", _part("gram")).repartitionByRange("part", "gram", "value").sortWithinPartitions("part", "gram")
    dealt.write.mode("overwrite").partitionBy("part").parquet(f"{path}/triples")
    triples = spark.read.schema("value string, gram string, part int").parquet(f"{path}/triples")
    counts = triples.groupBy("part", "gram").agg(F.count("*").alias("n")).repartitionByRange("part", "gram").sortWithinPartitions("part", "gram")
    counts.write.mode("overwrite").parquet(f"{path}/counts")


def matching_values(spark: SparkSession, path: str, text: str) -> DataFrame:
    """The indexed values that contain the text, ignoring case."""
    wanted = text.lower()
    values = spark.read.schema("value string").parquet(f"{path}/values")
    grams = sorted({wanted[i : i + GRAM] for i in range(len(wanted) - GRAM + 1)})
    if grams:
        at = {r.gram: r.part for r in spark.createDataFrame([(g,) for g in grams], "gram string").select("gram", _part("gram").alias("part")).collect()}
        counts = spark.read.schema("part int, gram string, n long").parquet(f"{path}/counts")
        known = {r.gram: r.n for r in counts.where(F.col("part").isin(*at.values()) & F.col("gram").isin(*grams)).collect()}  # one per triple of the text
        rarest = sorted(grams, key=lambda g: (known.get(g, 0), g))[:LOOKED_UP]
        triples = spark.read.schema("value string, gram string, part int").parquet(f"{path}/triples")
        met = triples.where(F.col("part").isin(*{at[g] for g in rarest}) & F.col("gram").isin(*rarest))
        values = met.groupBy("value").agg(F.count("*").alias("n")).where(F.col("n") == len(rarest)).select("value")
    return values.where(F.contains("value", F.lit(wanted)))


def indexed_search(df: DataFrame, path: str, text: str, columns: Sequence[str]) -> DataFrame:
    """What ``investigate.text_search`` returns, by the index of the same rows and columns.
    Empty text filters nothing; text shorter than a triple is looked for in all values."""
    if not text:
        return df
    found = matching_values(df.sparkSession, path, text)
    marks = {c: f"_found_{i}" for i, c in enumerate(columns)}
    out = df
    for c, mark in marks.items():
        hits = found.select(F.col("value").alias(mark))
        out = out.join(hits, _lowered(c) == F.col(mark), "left")
    return out.where(reduce(or_, [F.col(m).isNotNull() for m in marks.values()])).select(*[F.col(quoted(c)) for c in df.columns])
