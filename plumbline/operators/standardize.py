"""Raw text tables to typed tables, driven by one spec per table.

A spec is a list of ``name:kind`` entries, or ``name:kind<source`` when the
output name differs from the source column. Kinds are the keys of
``plumbline.functions.clean.KINDS``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.clean import kind_sql, quoted
from plumbline.functions.keys import record_hash

# Lineage columns of the raw layer that get a new name in the typed layer.
LINEAGE_RENAMES = {"_ingested_at": "_bronze_ingested_at", "_record_hash": "_bronze_record_hash"}

# Column contracts of the ten source tables (fixed values).
SPECS: dict[str, tuple[str, ...]] = {
    "facility_master": (
        "facility_id:text", "facility_name:text", "region:text", "basin:text", "state:text",
        "asset_type:text", "operator:text", "active_flag:code", "is_active:flag<active_flag",
        "effective_start_date:date", "effective_end_date:date",
        "latitude:double", "longitude:double", "source_system:text",
    ),
    "meter_master": (
        "meter_id:text", "facility_id:text", "meter_name:text", "meter_type:text", "product:text",
        "measurement_type:text", "custody_transfer_flag:code",
        "is_custody_transfer:flag<custody_transfer_flag", "source_system:text",
        "polling_platform:text", "install_date:date", "active_flag:code", "is_active:flag<active_flag",
        "expected_min_volume:double", "expected_max_volume:double", "sample_interval_minutes:int",
    ),
    "raw_polling_readings": (
        "raw_reading_id:text", "meter_id:text", "source_facility_id:text<facility_id",
        "reading_timestamp:timestamp", "production_date:date", "gas_day:date",
        "poll_timestamp:timestamp", "source_system:text", "polling_platform:text",
        "volume:double", "pressure:double", "temperature:double",
        "quality_code:code", "raw_status:code", "load_timestamp:timestamp", "batch_id:text",
    ),
    "meter_polling_events": (
        "object_id:text", "event_id:text", "raw_reading_id:text", "source_system:text",
        "polling_platform:text", "meter_id:text", "facility_id:text",
        "event_timestamp:timestamp", "production_date:date", "gas_day:date",
        "poll_timestamp:timestamp", "load_timestamp:timestamp", "payload_type:text",
        "payload_volume:double", "payload_pressure:double", "payload_temperature:double",
        "payload_quality_code:code", "payload_raw_status:code", "payload_device_status:code",
        "payload_communication_status:code", "payload_battery_status:code",
        "payload_polling_error_code:text", "payload_signal_quality:code",
        "payload_retry_count:int", "payload_schema_version:text", "raw_message_source:text",
        "source_file:text", "source_batch_id:text", "seed_batch_id:text", "scenario_id:text",
        "event_ingested_at:timestamp<ingested_at", "last_seed_attempt_at:timestamp",
        "last_seed_batch_id:text", "payload_json:text", "raw_document_json:text",
    ),
    "flow_computer_extract": (
        "flow_record_id:text", "meter_id:text", "facility_id:text", "production_date:date",
        "gas_day:date", "measured_volume:double", "corrected_volume:double",
        "estimated_flag:code", "is_estimated:flag<estimated_flag", "validation_status:code",
        "exception_code:code", "approved_flag:code", "is_approved:flag<approved_flag",
        "close_status:code", "flow_batch_id:text", "extracted_timestamp:timestamp",
        "last_updated_timestamp:timestamp",
    ),
    "nominations_daily": (
        "nomination_id:text", "facility_id:text", "production_date:date", "product:text",
        "nominated_volume:double", "customer_group:text", "contract_type:text", "status:code",
        "effective_start_date:date", "effective_end_date:date",
    ),
    "support_tickets": (
        "ticket_id:text", "opened_datetime:timestamp", "closed_datetime:timestamp",
        "system_name:text", "issue_type:text", "severity:text", "facility_id:text",
        "meter_id:text", "reported_by_team:text", "ticket_status:text", "business_impact:text",
        "root_cause_category:text", "resolution_summary:text", "related_batch_id:text",
        "related_exception_code:text",
    ),
    "pipeline_run_log": (
        "run_id:text", "pipeline_name:text", "source_file:text", "started_at:timestamp",
        "completed_at:timestamp", "status:code", "rows_read:long", "rows_accepted:long",
        "rows_rejected:long", "error_count:long", "warning_count:long", "error_message:text",
        "trigger_type:text", "environment:text",
    ),
    "dq_rules_reference": (
        "rule_id:text", "rule_name:text", "layer:text", "field_name:text", "rule_type:text",
        "condition_description:text", "severity:text", "business_reason:text",
        "owner_team:text", "active_flag:code", "is_active:flag<active_flag",
    ),
    "known_issue_scenarios": (
        "scenario_id:text", "scenario_name:text", "description:text",
        "affected_facility_id:text", "affected_meter_ids:text", "start_datetime:timestamp",
        "end_datetime:timestamp", "expected_exception_type:text", "expected_root_cause:text",
        "recommended_next_step:text",
    ),
}


def spec_columns(spec: Sequence[str]) -> list[str]:
    """One SQL expression per entry of a spec."""
    out = []
    for entry in spec:
        name, _, rule = entry.partition(":")
        kind, _, source = rule.partition("<")
        out.append(f"{kind_sql(kind, source or name)} AS {quoted(name)}")
    return out


# Names that columns have in the files of a source, where ours differ (fixed values).
FILE_NAMES = {"flow_computer_extract": {"flowcal_record_id": "flow_record_id", "flowcal_batch_id": "flow_batch_id"}}


def source_columns(spec: Sequence[str]) -> list[str]:
    """The raw columns a spec reads, each once, in order."""
    names = (entry.partition("<")[2] or entry.partition(":")[0] for entry in spec)
    return list(dict.fromkeys(names))


def standardize(raw: DataFrame, spec: Sequence[str]) -> DataFrame:
    """Typed columns of ``spec`` plus whatever lineage columns the raw table has."""
    lineage = [
        f"{quoted(c)} AS {quoted(LINEAGE_RENAMES.get(c, c))}" for c in raw.columns if c.startswith("_")
    ]
    return raw.selectExpr(*spec_columns(spec), *lineage)


def standardize_table(raw: DataFrame, table: str) -> DataFrame:
    return standardize(raw, SPECS[table])


def add_layer_metadata(df: DataFrame, layer: str, source: str, run_id: str, run_at: str | None = None) -> DataFrame:
    """Run id, source and processing time of a layer, and a reproducible row hash."""
    stamp = F.current_timestamp() if run_at is None else F.lit(run_at).cast("timestamp")
    columns = {
        f"_{layer}_run_id": F.lit(run_id),
        f"_{layer}_source": F.lit(source),
        f"_{layer}_processed_at": stamp,
        f"_{layer}_record_hash": record_hash(df.columns),
    }
    return df.withColumns(columns)
