"""CSV packages and event-document files."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.keys import record_hash, sha256
from plumbline.operators.events import flatten_documents, of_batch, parse_documents, reject_reason
from plumbline.operators.standardize import FILE_NAMES, SPECS, source_columns
from plumbline.session import shared_folder


def _run_stamp(run_at: str | None):
    return F.current_timestamp() if run_at is None else F.lit(run_at).cast("timestamp")


def read_csv_source(
    spark: SparkSession, path: str, table: str, run_id: str, *, run_at: str | None = None
) -> DataFrame:
    """One CSV file (or folder of files) of the source package, all text, with lineage.

    The header names the columns, whatever their order; a column of the contract
    that the file lacks is an error. Names that only the files use are taken as ours.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    ours = {theirs: name for theirs, name in FILE_NAMES.get(table, {}).items() if name not in raw.columns}
    raw = raw.withColumnsRenamed(ours)
    wanted = source_columns(SPECS[table])
    missing = [c for c in wanted if c not in raw.columns]
    if missing:
        raise ValueError(f"{table}: source columns missing: {', '.join(missing)}")
    return raw.select(
        *wanted,
        record_hash(wanted).alias("_record_hash"),
        F.lit(run_id).alias("_bronze_run_id"),
        F.lit("csv").alias("_source_type"),
        F.col("_metadata.file_name").alias("_source_file"),
        F.col("_metadata.file_path").alias("_source_path"),
        _run_stamp(run_at).alias("_ingested_at"),
    )


def add_bronze_metadata(
    flat: DataFrame,
    run_id: str,
    *,
    source_type: str = "event_store",
    database: str | None = None,
    collection: str | None = None,
    source_filter: str | None = None,
    run_at: str | None = None,
) -> DataFrame:
    """Lineage of event rows; the hash covers the preserved document."""
    return flat.withColumns(
        {
            "_record_hash": sha256("raw_document_json"),
            "_bronze_run_id": F.lit(run_id),
            "_source_type": F.lit(source_type),
            "_source_database": F.lit(database).cast("string"),
            "_source_collection": F.lit(collection).cast("string"),
            "_source_filter": F.lit(source_filter).cast("string"),
            "_ingested_at": _run_stamp(run_at),
        }
    )


@dataclass(frozen=True)
class Landing:
    """What a batch of received lines became. ``received`` is the stored text of every line
    with its route; ``documents`` and ``rejects`` read the two routes back."""

    received: DataFrame
    documents: DataFrame
    rejects: DataFrame
    received_rows: int
    rejected_rows: int

    @property
    def accepted_rows(self) -> int:
        return self.received_rows - self.rejected_rows


def land_lines(lines: DataFrame, into: str, run_id: str, *, run_at: str | None = None) -> tuple[int, int]:
    """Store received lines (``value``, and any lineage columns) in folder ``into``, each in
    the part of its route, and return how many were received and rejected.

    One pass: every line is routed by a test of its own text, and both counts are observed
    while the lines are written. Nothing is dropped: a rejected line is kept byte for byte
    with its reason.
    """
    seen = Observation()
    routed = lines.withColumn("reject_reason", reject_reason()).select(
        F.col("value").alias("raw_document_json"),
        *[c for c in lines.columns if c != "value"],
        "reject_reason",
        sha256("value").alias("_record_hash"),
        F.lit(run_id).alias("_bronze_run_id"),
        _run_stamp(run_at).alias("_ingested_at"),
        F.when(F.col("reject_reason").isNull(), "documents").otherwise("rejects").alias("route"),
    )
    counted = routed.observe(seen, F.count(F.lit(1)).alias("rows"), F.count("reject_reason").alias("rejected"))
    counted.write.mode("overwrite").partitionBy("route").parquet(into)
    return seen.get["rows"], seen.get["rejected"]


LANDED = (
    "raw_document_json string, _source_file string, reject_reason string, _record_hash string, "
    "_bronze_run_id string, _ingested_at timestamp, route string"
)


def read_event_documents(
    spark: SparkSession,
    path: str,
    run_id: str,
    *,
    batch_id: str | None = None,
    run_at: str | None = None,
    into: str | None = None,
) -> Landing:
    """JSON-lines event documents, landed and split: documents flattened with lineage, and
    the lines that hold none. ``into`` is where the landed lines stay (by default a new
    folder among the shared ones). A batch is chosen among the documents; rejects belong to
    no batch, and are all there."""
    into = into or f"{shared_folder(spark)}/plumbline/landed-{uuid.uuid4().hex}"
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("_source_file"))
    rows, rejected = land_lines(lines, into, run_id, run_at=run_at)
    received = spark.read.schema(LANDED).parquet(into)
    flat = flatten_documents(parse_documents(received.where("route = 'documents'"), "raw_document_json"))
    if batch_id is not None:
        flat = of_batch(flat, batch_id)
    chosen = None if batch_id is None else f"seed_batch_id={batch_id}"
    documents = add_bronze_metadata(flat, run_id, source_filter=chosen, run_at=run_at)
    return Landing(received, documents, received.where("route = 'rejects'").drop("route"), rows, rejected)


def export_csv(df: DataFrame, path: str) -> None:
    """A result as CSV files with header; complex columns must be text already."""
    df.write.mode("overwrite").option("header", True).csv(path)
