"""Catalog tables: write, replace, probe, list."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.clean import quoted, sql_text
from plumbline.operators.publish import require_identifier
from plumbline.session import materialize


def _qualified(name: str) -> str:
    return ".".join(require_identifier(part, "table name") for part in name.split("."))


def use_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {require_identifier(database, 'database name')}")


def table_exists(spark: SparkSession, name: str) -> bool:
    recover_table(spark, name)
    return spark.catalog.tableExists(_qualified(name))


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(require_identifier(database, "database name")))


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame with a row counter that is filled by whatever action runs it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_table(
    df: DataFrame, name: str, *, file_format: str = "parquet", partition_by: Sequence[str] = (), rebalance: bool = True, path: str | None = None
) -> int:
    """Write a whole table (schema replaceable) and return its row count.

    The count is observed during the write: no second scan. Partitioned tables
    are rebalanced first, which splits large and merges small partitions, so a
    day with most of the rows still becomes many files of ordinary size. With ``path`` the
    table's files stay in that folder.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    frame, seen = counted(df)
    writer = frame.write.format(file_format).mode("overwrite").option("overwriteSchema", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(_qualified(name))
    return seen.get["rows"]


def recover_table(spark: SparkSession, name: str) -> bool:
    """Finish a replacement that broke off: a table that is gone while its new version
    stands beside it gets that version. Call it before reading; true if it did."""
    target = _qualified(name)
    if spark.catalog.tableExists(target) or not spark.catalog.tableExists(target + "__next"):
        return False
    spark.sql(f"ALTER TABLE {target}__next RENAME TO {target}")
    return True


def replace_table(df: DataFrame, name: str, **options) -> int:
    """Write a table whose new content is computed from its old content.

    A table cannot be overwritten while it is read: the new version is written
    beside it and takes its name afterwards. If that breaks off after the old
    version is dropped, the new one is complete: ``recover_table`` renames it.
    """
    spark, target = df.sparkSession, _qualified(name)
    beside = target + "__next"
    recover_table(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {beside}")
    rows = write_table(df, beside, **options)
    spark.sql(f"DROP TABLE IF EXISTS {target}")
    spark.sql(f"ALTER TABLE {beside} RENAME TO {target}")
    return rows


def append_table(df: DataFrame, name: str, file_format: str = "parquet") -> int:
    frame, seen = counted(df)
    frame.write.format(file_format).mode("append").saveAsTable(_qualified(name))
    return seen.get["rows"]


def overwrite_partitions(df: DataFrame, name: str, column: str, values: Sequence) -> None:
    """Replace the partitions of a table where ``column`` is one of ``values`` by the rows of
    ``df``, which must hold no other; one that ``df`` has no rows for is emptied. Other
    partitions are neither read nor written. ``df`` may be computed from the table: it is
    stored before anything changes."""
    spark, target = df.sparkSession, _qualified(name)
    stored = materialize(df.select(*[F.col(quoted(c)) for c in spark.table(target).columns]))
    stored.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(target)
    left = {r[0] for r in stored.select(column).distinct().collect()}  # at most as many as values
    for value in set(values) - left:
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({require_identifier(column, 'column')} = {sql_text(value if isinstance(value, int) else str(value))})")


# The partition column of a keyed table, and how many parts it has by default.
BUCKET, BUCKETS = "_bucket", 64


def _bucket_of(key: str, buckets: int) -> Column:
    return F.expr(f"cast(pmod(xxhash64({quoted(key)}), {int(buckets)}) AS int)")


def write_keyed_table(df: DataFrame, name: str, key: str, buckets: int = BUCKETS, path: str | None = None) -> int:
    """Write a state table in parts by a hash of its key, so that a change of a few keys
    rewrites a few parts. The number of parts is kept in the table's properties."""
    rows = write_table(df.withColumn(BUCKET, _bucket_of(key, buckets)), name, partition_by=(BUCKET,), path=path)
    target = _qualified(name)
    df.sparkSession.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ('keyed_by' = '{require_identifier(key, 'key')}', 'buckets' = '{int(buckets)}')")
    return rows


def read_keyed_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(_qualified(name)).drop(BUCKET)


def change_keyed_table(name: str, incoming: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
    """Replace the parts of a keyed table that hold a key of ``incoming`` by what ``change``
    makes of their rows and ``incoming``; returns how many parts that were.

    ``change`` must treat each key by itself, as upserts and deletes by key do. Only the
    touched parts are read and written, whatever the size of the table; the new rows are
    stored before the old ones go. The parts change one after the other: if that breaks
    off, running an idempotent change once more completes it.
    """
    spark, target = incoming.sparkSession, _qualified(name)
    known = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {target}").collect()}
    if "keyed_by" not in known:
        raise ValueError(f"{name} is not a keyed table")
    key, buckets = known["keyed_by"], int(known["buckets"])
    at = _bucket_of(key, buckets)
    incoming = materialize(incoming)
    touched = [r[0] for r in incoming.select(at).distinct().collect()]  # at most one per part
    if not touched:
        return 0
    old = spark.table(target).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    overwrite_partitions(change(old, incoming).withColumn(BUCKET, at), name, BUCKET, touched)
    return len(touched)


def delete_keys(name: str, gone: DataFrame, keys: Sequence[str]) -> int:
    """Delete the rows of a keyed table that match ``gone`` on ``keys``; NULL matches
    nothing. Its key must be among them."""
    return change_keyed_table(name, gone.select(*keys).distinct(), lambda old, keys_gone: old.join(keys_gone, list(keys), "left_anti").select(*old.columns))
