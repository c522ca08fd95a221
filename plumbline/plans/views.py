"""Serving views: named projections of the published tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.clean import is_true
from plumbline.operators import publish

# View -> (table, columns). Column lists are fixed values.
INVESTIGATION_VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "pipeline_health": ("pipeline_health_summary", (
        "pipeline_name", "latest_run_id", "latest_status", "latest_run_started_at",
        "latest_run_completed_at", "latest_duration_minutes", "latest_rows_read",
        "latest_rows_accepted", "latest_rows_rejected", "latest_error_message", "run_count",
        "success_count", "failed_count", "partial_load_count", "runs_with_errors_count",
        "failure_rate", "overall_rejected_rate",
    )),
    "exception_detail": ("fact_data_quality_exception", (
        "exception_id", "rule_id", "exception_type", "severity", "business_reason",
        "raw_reading_id", "meter_id", "facility_id", "facility_name", "region", "basin",
        "production_date", "reading_timestamp", "source_system", "polling_platform", "volume",
        "quality_code", "raw_status", "event_device_status", "event_communication_status",
        "event_signal_quality", "event_scenario_id", "primary_exception_type", "exception_status",
        "assigned_to", "analyst_notes", "days_since_production_date",
    )),
    "exception_summary": ("exception_summary_daily", (
        "production_date", "facility_id", "facility_name", "region", "basin", "exception_type",
        "severity", "exception_rule_failure_count", "exception_count", "affected_reading_count",
        "affected_meter_count", "source_systems", "polling_platforms", "device_statuses",
        "communication_statuses", "signal_qualities", "first_detected_at", "last_detected_at",
        "exception_group_id",
    )),
    "facility_kpi_daily": ("fact_facility_volume_daily", (
        "reporting_facility_id", "master_facility_name", "master_region", "master_basin",
        "master_state", "master_asset_type", "master_operator", "master_product",
        "production_date", "gas_day", "meter_count", "hourly_reading_count",
        "valid_reading_count", "review_reading_count", "exception_reading_count",
        "valid_volume", "accepted_or_review_volume", "all_nonnegative_volume",
        "raw_volume_sum", "exception_rate", "valid_record_rate", "reporting_readiness_score",
        "has_data_quality_issue",
    )),
    "actual_vs_nominated": ("fact_actual_vs_nominated_daily", (
        "facility_id", "facility_name", "region", "basin", "state", "production_date", "product",
        "actual_volume", "valid_volume", "nominated_volume", "actual_vs_nominated_delta",
        "actual_vs_nominated_pct", "nomination_count", "exception_rate",
        "reporting_readiness_score", "has_data_quality_issue",
    )),
    "reconciliation": ("fact_source_to_target_reconciliation", (
        "stage_order", "layer", "object_name", "row_count", "metric_type", "notes",
    )),
    "rca_context": ("rca_context", (
        "exception_group_id", "production_date", "facility_id", "facility_name", "region",
        "basin", "exception_type", "severity", "exception_count", "affected_reading_count",
        "affected_meter_count", "source_systems_text", "polling_platforms_text",
        "device_statuses_text", "communication_statuses_text", "signal_qualities_text",
        "scenario_id", "scenario_name", "scenario_description", "expected_root_cause",
        "recommended_next_step", "rca_summary_seed",
    )),
}

# Business views show whole tables.
BUSINESS_VIEWS = {
    "kpi_daily": "fact_facility_volume_daily",
    "facility_volume_trend": "fact_facility_volume_daily",
    "actual_vs_nominated": "fact_actual_vs_nominated_daily",
    "flow_reconciliation": "fact_flow_reconciliation_daily",
    "data_quality_impact": "exception_summary_daily",
    "reporting_readiness": "pipeline_health_summary",
}

# Support views show whole support tables, that is, tables aligned to their
# target definition (operators.publish.SUPPORT_TABLES).
SUPPORT_VIEWS = {
    "pipeline_health": "pipeline_health_summary",
    "exception_backlog": "fact_data_quality_exception",
    "exception_summary_daily": "exception_summary_daily",
    "reconciliation_status": "fact_source_to_target_reconciliation",
    "ticket_rca": "fact_support_ticket",
}


def investigation_view(name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The view's columns, and publish metadata if the table carries it."""
    table, columns = INVESTIGATION_VIEWS[name]
    source = tables[table]
    stamps = [c for c in source.columns if c.endswith(("_publish_run_id", "_published_at_utc"))]
    return source.select(*columns, *stamps)


def _overview_row(group: str, df: DataFrame, passing: Column, attention: Column) -> DataFrame:
    return df.agg(
        F.lit(group).alias("metric_group"),
        F.count("*").alias("metric_count"),
        F.sum(is_true(passing).cast("bigint")).alias("passing_count"),
        F.sum(is_true(attention).cast("bigint")).alias("attention_count"),
    )


def reliability_overview(health: DataFrame, exceptions: DataFrame, stages: DataFrame) -> DataFrame:
    """Total, passing and attention counts of the three reliability groups. A NULL
    status or severity counts as neither."""
    status, severity, count = F.col("latest_status"), F.col("severity"), F.col("row_count")
    minor = severity.isin("Low", "Medium")
    rows = [
        _overview_row("pipeline_health", health, status == "SUCCESS", status != "SUCCESS"),
        _overview_row("data_quality_exceptions", exceptions, minor, ~minor),
        _overview_row("source_to_target_reconciliation", stages, count.isNotNull(), count.isNull()),
    ]
    return reduce(DataFrame.unionByName, rows)


def business_view(table: DataFrame) -> DataFrame:
    """A whole table as the business target shows it: plain values, normalized names."""
    return publish.normalize_columns(publish.normalize_values(table))


def support_view(name: str, table: DataFrame) -> DataFrame:
    """A table in the columns of its support definition, and publish metadata if it has it."""
    stamps = [c for c in table.columns if c.endswith(("_publish_run_id", "_published_at_utc"))]
    held = [(c, "varchar(200)" if c.endswith("_id") else "datetime2(3)") for c in stamps]
    return publish.align_to_target(table, (*publish.SUPPORT_TABLES[name], *held), publish.SUPPORT_ALIASES.get(name))


def register_views(tables: Mapping[str, DataFrame]) -> list[str]:
    """Register every view whose table is present as a temporary view, in the shape its
    audience is served."""
    made = []
    served = {f"vw_investigation_{n}": (t, lambda n=n: investigation_view(n, tables)) for n, (t, _) in INVESTIGATION_VIEWS.items()}
    served |= {f"vw_business_{n}": (t, lambda t=t: business_view(tables[t])) for n, t in BUSINESS_VIEWS.items()}
    served |= {f"vw_support_{n}": (t, lambda t=t: support_view(t, tables[t])) for n, t in SUPPORT_VIEWS.items()}
    for name, (table, view) in served.items():
        if table in tables:
            view().createOrReplaceTempView(name)
            made.append(name)
    return made
