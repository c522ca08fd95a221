"""New files only: the batch rules on a file stream.

Standardizing, the master join and all row-wise rules hold for a stream as they
are. The duplicate rule and the event context look at other rows and stay in the
batch pipeline; here a reading counts as its own only copy, without event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.operators import rules
from plumbline.operators.enrich import EVENT_COLUMNS, join_master
from plumbline.operators.standardize import SPECS, source_columns, standardize_table
from plumbline.session import shared_folder


def stream_csv_source(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Text rows of new CSV files; all files must have the contract's column order."""
    schema = ", ".join(f"{c} string" for c in source_columns(SPECS[table]))
    return spark.readStream.schema(schema).option("header", True).csv(path)


def check_stream(raw: DataFrame, meters: DataFrame, facilities: DataFrame, ctx: rules.RuleContext) -> DataFrame:
    """Typed, enriched and classified readings of a stream."""
    readings = standardize_table(raw, "raw_polling_readings")
    alone = {"duplicate_meter_timestamp_count": F.lit(1).cast("bigint")}
    without_event = {f"event_{name}": F.lit(None).cast("string") for name in EVENT_COLUMNS.values()}
    return rules.check_readings(join_master(readings.withColumns(alone | without_event), meters, facilities), ctx)


def run_available(checked: DataFrame, path: str, name: str) -> StreamingQuery:
    """Append everything that has arrived to a Parquet folder, each row once, and
    stop. Progress is kept in the shared folder, so the next run goes on from there."""
    progress = f"{shared_folder(checked.sparkSession)}/plumbline/streams/{name}"
    return (
        checked.writeStream.format("parquet")
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .outputMode("append")
        .start(path)
    )
