"""Source-to-target checkpoints and write/publish checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.clean import safe_divide

# The eight stages: layer, object, metric type and note (fixed values).
STAGES = (
    ("source", "raw_polling_readings.csv", "raw_source_rows",
     "Generated structured CSV source records."),
    ("bronze", "bronze_raw_polling_readings", "bronze_raw_rows",
     "Raw CSV records landed in Databricks Bronze."),
    ("silver", "silver_meter_reading_enriched", "silver_enriched_rows",
     "Standardized readings joined to master and MongoDB context."),
    ("silver", "silver_meter_reading_valid", "silver_valid_or_review_rows",
     "Records classified as VALID or REVIEW."),
    ("silver", "silver_meter_reading_exceptions", "silver_exception_rows",
     "Records with one or more DQ flags."),
    ("gold", "fact_meter_reading_daily", "gold_meter_day_rows",
     "Aggregated meter-day measurement fact."),
    ("gold", "fact_facility_volume_daily", "gold_facility_day_rows",
     "Aggregated facility-day KPI fact."),
    ("gold", "fact_data_quality_exception", "gold_exception_fact_rows",
     "One row per failed DQ rule per affected reading."),
)

# The six layer counts after the Silver step: layer, object and note (fixed values).
SILVER_COUNTS = (
    ("bronze", "bronze_raw_polling_readings", "Structured raw readings from CSV source package."),
    ("bronze", "bronze_meter_polling_events", "Raw MongoDB Atlas event documents."),
    ("silver", "silver_meter_reading_enriched",
     "Standardized readings joined to master data and MongoDB context."),
    ("silver", "silver_meter_reading_valid", "Records with status VALID or REVIEW after Silver checks."),
    ("silver", "silver_meter_reading_exceptions", "Records with one or more DQ exceptions."),
    ("silver", "silver_data_quality_exceptions", "One row per failed rule per affected reading."),
)

# What a checkpoint's metric type says about its count: the first phrase that
# occurs decides (fixed values).
INTERPRETATIONS = (
    ("raw_source", "Original generated source record count."),
    ("bronze_raw", "Bronze landing count should match the raw structured source count."),
    ("silver_enriched",
     "Silver enriched count should preserve the raw reading grain after standardization/enrichment."),
    ("silver_valid",
     "Rows classified as valid or review. Lower than raw is expected when exceptions are separated."),
    ("silver_exception", "Readings with one or more data-quality exceptions."),
    ("gold_meter_day", "Expected grain change: hourly readings are aggregated to meter-day facts."),
    ("gold_facility_day", "Expected grain change: meter-day facts are aggregated to facility-day KPIs."),
    ("gold_exception_fact",
     "One row per failed DQ rule per affected reading. This can exceed unique affected readings."),
)
EXCEPTION_OBJECT = "Exception-focused output used for investigation and triage."
OTHERWISE = "Review metric type and grain before interpreting this count as loss or mismatch."


def layer_status(expected: str | Column = "expected_rows", written: str | Column = "written_rows") -> Column:
    """CREATED without an expectation, PASS when it is met, else CHECK."""
    want = F.col(expected) if isinstance(expected, str) else expected
    got = F.col(written) if isinstance(written, str) else written
    return F.when(want.isNull(), "CREATED").when(want == got, "PASS").otherwise("CHECK")


def two_sided_status(expected: str = "expected_rows", source: str = "source_rows", written: str = "written_rows") -> Column:
    """As ``layer_status``, but source and written counts must both meet it."""
    want = F.col(expected)
    met = (want == F.col(source)) & (want == F.col(written))
    return F.when(want.isNull(), "CREATED").when(met, "PASS").otherwise("CHECK")


def publish_status(expected: str = "expected_rows", source: str = "source_rows", written: str = "written_rows") -> Column:
    """PASS when all agree, a warning when only the expectation moved, else FAIL."""
    want, have, got = F.col(expected), F.col(source), F.col(written)
    return (
        F.when((have == want) & (got == want), "PASS")
        .when(have == got, "WARN_EXPECTED_COUNT_CHANGED")
        .otherwise("FAIL")
    )


def failed_checks(summary: DataFrame, bad: Sequence[str] = ("CHECK",)) -> DataFrame:
    return summary.where(F.col("status").isin(*bad))


def require_all_pass(summary: DataFrame) -> None:
    """Raise with the names of all targets whose status is not PASS."""
    rows = summary.where("status IS NULL OR status != 'PASS'").select("target_table", "status").collect()
    if rows:
        listed = ", ".join(f"{r.target_table} ({r.status})" for r in rows)
        raise RuntimeError(f"Publish checks did not pass: {listed}")


def row_counts(stages: Sequence[tuple[DataFrame, Mapping[str, object]]]) -> DataFrame:
    """One row per frame with its measured count and the given labels.

    Counts are aggregates of one plan, so they run as parallel stages instead of
    one driver action each.
    """
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            *[F.lit(v).alias(k) for k, v in labels.items()], "row_count"
        )
        for df, labels in stages
    ]
    return reduce(DataFrame.unionByName, counts)


def checkpoints(frames: Sequence[DataFrame]) -> DataFrame:
    """The eight source-to-target stages with their measured counts."""
    labelled = [
        (df, {"stage_order": n, "layer": layer, "object_name": name, "metric_type": metric, "notes": note})
        for n, (df, (layer, name, metric, note)) in enumerate(zip(frames, STAGES, strict=True), start=1)
    ]
    return row_counts(labelled)


def silver_counts(frames: Sequence[DataFrame]) -> DataFrame:
    labelled = [
        (df, {"layer": layer, "object_name": name, "notes": note})
        for df, (layer, name, note) in zip(frames, SILVER_COUNTS, strict=True)
    ]
    return row_counts(labelled)


def add_stage_deltas(stages: DataFrame, run_column: str | None = None) -> DataFrame:
    """Previous stage's count, the change and its share.

    The window holds the stages of one run, a handful of rows by construction.
    """
    order = Window.partitionBy(*([run_column] if run_column else [F.lit(0)])).orderBy("stage_order")
    previous = F.col("previous_row_count")
    change = F.col("row_count") - previous
    return stages.withColumn("previous_row_count", F.lag("row_count").over(order)).withColumns(
        {
            "row_count_delta_from_previous": change,
            "row_count_delta_pct_from_previous": safe_divide(change, previous),
        }
    )


def interpretation(metric_type: str = "metric_type", object_name: str = "object_name") -> Column:
    """Plain sentence on how to read a checkpoint."""
    metric = F.lower(F.coalesce(F.col(metric_type), F.lit("")))
    about = F.lower(F.coalesce(F.col(object_name), F.lit("")))
    first = F.coalesce(*[F.when(metric.contains(phrase), text) for phrase, text in INTERPRETATIONS])
    fallback = F.when(about.contains("exception"), EXCEPTION_OBJECT).otherwise(OTHERWISE)
    return F.coalesce(first, fallback)


def reconciliation_fact(frames: Sequence[DataFrame]) -> DataFrame:
    """Checkpoints with deltas and interpretation, computed once and stored."""
    return add_stage_deltas(checkpoints(frames)).withColumn("interpretation", interpretation())


def layer_summary(stages: DataFrame) -> DataFrame:
    return stages.groupBy("layer").agg(
        F.count("object_name").alias("checkpoint_count"),
        F.min("row_count").alias("min_row_count"),
        F.max("row_count").alias("max_row_count"),
        F.min("stage_order").alias("first_stage"),
        F.max("stage_order").alias("last_stage"),
    )


def publish_deltas(summary: DataFrame) -> DataFrame:
    written = F.col("written_rows")
    return summary.withColumns(
        {
            "source_vs_written_delta": written - F.col("source_rows"),
            "expected_vs_written_delta": written - F.col("expected_rows"),
        }
    )
