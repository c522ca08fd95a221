"""Warehouse targets over the DataFrame reader and writer (JDBC by default).

Rows go from the executors straight to the target; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.operators.publish import require_identifier


def read_remote(spark: SparkSession, options: Mapping[str, str], query: str, source: str = "jdbc") -> DataFrame:
    """The result of a query at the target."""
    return spark.read.format(source).options(**options).option("query", query.strip().rstrip(";")).load()


def read_remote_table(
    spark: SparkSession, options: Mapping[str, str], table: str, source: str = "jdbc",
    split: Mapping[str, str] | None = None,
) -> DataFrame:
    """A whole table or view. ``split`` (partitionColumn, lowerBound, upperBound,
    numPartitions) reads a large one with many tasks."""
    reader = spark.read.format(source).options(**options).option("dbtable", require_identifier(table, "table name"))
    return reader.options(**(split or {})).load()


def remote_row_count(spark: SparkSession, options: Mapping[str, str], table: str, source: str = "jdbc") -> int:
    query = f"SELECT COUNT(*) AS row_total FROM {require_identifier(table, 'table name')}"
    return int(read_remote(spark, options, query, source).first()[0])


def table_schema(spark: SparkSession, options: Mapping[str, str], table: str, source: str = "jdbc") -> StructType:
    """The columns that a target table has now."""
    return read_remote_table(spark, options, table, source).schema


def run_in_transaction(spark: SparkSession, options: Mapping[str, str], statements: Sequence[str]) -> None:
    """Statements at the target, all or none: an error takes back what ran before it."""
    jvm = spark.sparkContext._jvm
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    driver = loader.loadClass(options["driver"]).newInstance()
    known = jvm.java.util.Properties()
    for key, value in options.items():
        if key not in ("url", "driver"):
            known.setProperty(key, value)
    link = driver.connect(options["url"], known)
    try:
        link.setAutoCommit(False)
        for text in statements:
            call = link.createStatement()
            call.executeUpdate(text)
            call.close()
        link.commit()
    except Exception:
        link.rollback()
        raise
    finally:
        link.close()


def publish(
    df: DataFrame,
    options: Mapping[str, str],
    table: str,
    *,
    keep_definition: bool = True,
    source: str = "jdbc",
    batch_rows: int = 1000,
    max_connections: int = 16,
) -> tuple[int, int]:
    """Replace a target table; returns (source rows, rows found there afterwards).

    ``df`` should be a stored table: it is counted (from file metadata) besides
    being written, as a JDBC write reports no counts of its own.

    ``keep_definition`` truncates the table, so views on it survive; without it
    the table is dropped and created anew. ``max_connections`` bounds how many
    tasks write at once.
    """
    require_identifier(table, "target table")
    (
        df.write.format(source)
        .options(**options)
        .option("dbtable", table)
        .option("truncate", keep_definition)
        .option("batchsize", batch_rows)
        .option("numPartitions", max_connections)
        .mode("overwrite")
        .save()
    )
    return df.count(), remote_row_count(df.sparkSession, options, table, source)


def publish_summary(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """One row per published table: names, counts, status (see reconcile.publish_status)."""
    from plumbline.operators.reconcile import publish_status

    schema = (
        "publish_run_id string, source_table string, target_table string, description string, "
        "expected_rows bigint, source_rows bigint, written_rows bigint, published_at_utc string"
    )
    return spark.createDataFrame(rows, schema).withColumn("status", publish_status())


def view_summary(views: Mapping[str, DataFrame], run_id: str, expected: Mapping[str, int] | None = None) -> DataFrame:
    """One row per view with its row count. With ``expected`` (rows of the table a view shows)
    the status tells whether the view shows them all: PASS, CHECK, or CREATED where nothing
    is expected; without it a view that can be read passes."""
    from plumbline.operators.reconcile import layer_status, row_counts

    wanted = expected or {}
    labelled = [(df, {"publish_run_id": run_id, "view_name": name, "expected_rows": wanted.get(name)}) for name, df in views.items()]
    counts = row_counts(labelled).withColumnRenamed("row_count", "view_rows").withColumn("expected_rows", F.col("expected_rows").cast("bigint"))
    status = layer_status("expected_rows", "view_rows") if expected is not None else F.lit("PASS")
    return counts.select("publish_run_id", "view_name", "view_rows", status.alias("status"))
