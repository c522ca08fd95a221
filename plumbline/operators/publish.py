"""Shaping frames for a publish target."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.clean import quoted

COMPLEX = (T.ArrayType, T.StructType, T.MapType)
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")

# Target column -> source names to try, per support table (fixed values).
SUPPORT_ALIASES: dict[str, dict[str, tuple[str, ...]]] = {
    "fact_pipeline_run": {
        "started_at": ("started_at", "run_started_at", "run_started_at_utc", "latest_run_started_at"),
        "completed_at": ("completed_at", "run_completed_at", "run_completed_at_utc", "latest_run_completed_at"),
        "status": ("status", "run_status", "latest_status"),
        "error_message": ("error_message", "latest_error_message"),
    },
    "pipeline_health_summary": {
        "latest_run_started_at": ("latest_run_started_at", "started_at", "run_started_at", "run_started_at_utc"),
        "latest_run_completed_at": ("latest_run_completed_at", "completed_at", "run_completed_at", "run_completed_at_utc"),
        "latest_error_message": ("latest_error_message", "error_message"),
    },
    "fact_data_quality_exception": {
        "exception_status": ("exception_status", "status", "triage_status"),
        "mongo_device_status": ("event_device_status",),
        "mongo_communication_status": ("event_communication_status",),
        "mongo_signal_quality": ("event_signal_quality",),
        "mongo_scenario_id": ("event_scenario_id",),
    },
    "exception_summary_daily": {
        "source_systems_text": ("source_systems_text", "source_systems"),
        "polling_platforms_text": ("polling_platforms_text", "polling_platforms"),
        "device_statuses_text": ("device_statuses_text", "device_statuses"),
        "communication_statuses_text": ("communication_statuses_text", "communication_statuses"),
        "signal_qualities_text": ("signal_qualities_text", "signal_qualities"),
    },
    "fact_support_ticket": {"ticket_status": ("ticket_status", "status")},
    "quality_rule_summary": {"active_flag": ("active_flag", "is_active", "active")},
}

# Columns and SQL types of the support tables (fixed values).
SUPPORT_TABLES: dict[str, tuple[tuple[str, str], ...]] = {
    "fact_pipeline_run": (
        ("pipeline_run_key", "varchar(200)"), ("run_id", "varchar(200)"),
        ("pipeline_name", "varchar(200)"), ("source_file", "varchar(500)"),
        ("started_at", "datetime2(3)"), ("completed_at", "datetime2(3)"), ("status", "varchar(100)"),
        ("rows_read", "bigint"), ("rows_accepted", "bigint"), ("rows_rejected", "bigint"),
        ("error_count", "bigint"), ("warning_count", "bigint"), ("error_message", "varchar(max)"),
        ("trigger_type", "varchar(100)"), ("environment", "varchar(100)"),
    ),
    "pipeline_health_summary": (
        ("pipeline_name", "varchar(200)"), ("latest_status", "varchar(100)"),
        ("latest_run_started_at", "datetime2(3)"), ("latest_run_completed_at", "datetime2(3)"),
        ("latest_duration_minutes", "decimal(18,4)"), ("latest_rows_read", "bigint"),
        ("latest_rows_accepted", "bigint"), ("latest_rows_rejected", "bigint"),
        ("run_count", "bigint"), ("success_count", "bigint"), ("failed_count", "bigint"),
        ("partial_load_count", "bigint"), ("runs_with_errors_count", "bigint"),
        ("failure_rate", "decimal(18,6)"), ("overall_rejected_rate", "decimal(18,6)"),
        ("latest_error_message", "varchar(max)"),
    ),
    "fact_data_quality_exception": (
        ("exception_id", "varchar(500)"), ("rule_id", "varchar(200)"),
        ("exception_type", "varchar(200)"), ("severity", "varchar(100)"),
        ("business_reason", "varchar(max)"), ("raw_reading_id", "varchar(200)"),
        ("meter_id", "varchar(100)"), ("facility_id", "varchar(100)"),
        ("facility_name", "varchar(300)"), ("region", "varchar(100)"), ("basin", "varchar(100)"),
        ("production_date", "date"), ("reading_timestamp", "datetime2(3)"),
        ("source_system", "varchar(200)"), ("polling_platform", "varchar(200)"),
        ("volume", "decimal(18,6)"), ("quality_code", "varchar(100)"),
        ("raw_status", "varchar(100)"), ("mongo_device_status", "varchar(100)"),
        ("mongo_communication_status", "varchar(100)"), ("mongo_signal_quality", "varchar(100)"),
        ("mongo_scenario_id", "varchar(100)"), ("primary_exception_type", "varchar(200)"),
        ("exception_status", "varchar(100)"), ("detected_at", "datetime2(3)"),
    ),
    "exception_summary_daily": (
        ("production_date", "date"), ("facility_id", "varchar(100)"),
        ("facility_name", "varchar(300)"), ("region", "varchar(100)"), ("basin", "varchar(100)"),
        ("exception_type", "varchar(200)"), ("severity", "varchar(100)"),
        ("exception_count", "bigint"), ("affected_reading_count", "bigint"),
        ("affected_meter_count", "bigint"), ("source_systems_text", "varchar(max)"),
        ("polling_platforms_text", "varchar(max)"), ("device_statuses_text", "varchar(max)"),
        ("communication_statuses_text", "varchar(max)"), ("signal_qualities_text", "varchar(max)"),
    ),
    "fact_source_to_target_reconciliation": (
        ("stage_order", "int"), ("layer", "varchar(100)"), ("object_name", "varchar(300)"),
        ("row_count", "bigint"), ("previous_row_count", "bigint"),
        ("row_count_delta_from_previous", "bigint"),
        ("row_count_delta_pct_from_previous", "decimal(18,6)"), ("metric_type", "varchar(200)"),
        ("notes", "varchar(max)"), ("interpretation", "varchar(max)"),
    ),
    "fact_support_ticket": (
        ("ticket_id", "varchar(200)"), ("opened_datetime", "datetime2(3)"),
        ("closed_datetime", "datetime2(3)"), ("system_name", "varchar(200)"),
        ("issue_type", "varchar(200)"), ("severity", "varchar(100)"),
        ("facility_id", "varchar(100)"), ("meter_id", "varchar(100)"),
        ("reported_by_team", "varchar(200)"), ("ticket_status", "varchar(100)"),
        ("business_impact", "varchar(max)"), ("root_cause_category", "varchar(200)"),
        ("resolution_summary", "varchar(max)"), ("related_batch_id", "varchar(200)"),
    ),
    "quality_rule_summary": (
        ("rule_id", "varchar(200)"), ("rule_name", "varchar(300)"), ("layer", "varchar(100)"),
        ("field_name", "varchar(200)"), ("rule_type", "varchar(200)"),
        ("condition_description", "varchar(max)"), ("severity", "varchar(100)"),
        ("business_reason", "varchar(max)"), ("owner_team", "varchar(200)"), ("active_flag", "bit"),
        ("exception_count", "bigint"), ("affected_reading_count", "bigint"),
        ("affected_meter_count", "bigint"),
    ),
}

# SQL type name -> Spark type; anything else is text (fixed values).
SQL_TYPES = {
    "bigint": "bigint",
    "int": "int", "smallint": "int", "tinyint": "int",
    "float": "double", "real": "double",
    "bit": "boolean",
    "date": "date",
    "datetime": "timestamp", "datetime2": "timestamp", "smalldatetime": "timestamp",
    "datetimeoffset": "timestamp",
}


def require_identifier(name: str, what: str = "name") -> str:
    """Guard for names that end up in SQL text."""
    if not IDENTIFIER.fullmatch(name):
        raise ValueError(f"Unsafe {what}: {name!r}")
    return name


def flat_text(column: str | Column, data_type: T.DataType, array_as: str = "json") -> Column:
    """A complex value as text: JSON, or for arrays the values joined by a comma."""
    value = F.col(column) if isinstance(column, str) else column
    if array_as == "joined" and isinstance(data_type, T.ArrayType) and isinstance(data_type.elementType, T.AtomicType):
        return F.array_join(value.cast("array<string>"), ", ")
    return F.to_json(value)


def flatten_complex(df: DataFrame, array_as: str = "json") -> DataFrame:
    """Arrays, structs and maps to text, decimals to double."""
    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, COMPLEX):
            columns.append(flat_text(f.name, f.dataType, array_as).alias(f.name))
        elif isinstance(f.dataType, T.DecimalType):
            columns.append(F.col(f.name).cast("double").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


def normalize_names(names: Sequence[str]) -> list[str]:
    """Upper-case names of letters, digits and single underscores; a name must not
    start with a digit, and a repeated name gets a number."""
    taken: dict[str, int] = {}
    out: list[str] = []
    for name in names:
        words = re.findall(r"[A-Za-z0-9]+", str(name))
        base = "_".join(words).upper() or "COL"
        base = f"COL_{base}" if base[0].isdigit() else base
        name, taken[base] = base, taken.get(base, 0) + 1
        while name in out:  # a generated name may be another column's own
            name = f"{base}_{max(2, taken[base])}"
            taken[base] = max(2, taken[base]) + (name in out)
        out.append(name)
    return out


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*normalize_names(df.columns))


def normalize_values(df: DataFrame) -> DataFrame:
    """NaN to NULL, decimals to double, complex values to JSON."""
    flat = flatten_complex(df)
    fixed = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in flat.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return flat.withColumns(fixed) if fixed else flat


def spark_type(sql_type: str) -> str:
    """Spark type for a SQL column type such as ``decimal(18,6)``."""
    name, _, size = sql_type.lower().partition("(")
    if name in ("decimal", "numeric"):
        return f"decimal({size.rstrip(')') or '18,6'})"
    return SQL_TYPES.get(name, "string")


Target = Sequence[tuple[str, str]] | T.StructType


def target_columns(target: Target) -> list[tuple[str, str]]:
    """Names and Spark types of a target: of a definition in SQL types, or of the schema
    that a live table has now."""
    if isinstance(target, T.StructType):
        return [(f.name, f.dataType.simpleString()) for f in target.fields]
    return [(name, spark_type(sql_type)) for name, sql_type in target]


def _sources(df: DataFrame, target: Target, aliases: Mapping[str, Sequence[str]] | None) -> list[tuple[str, str, str | None]]:
    """Each target column with its type and the source column it takes, if any: its own
    name, else the first alias present, both ignoring case."""
    by_lower = {c.lower(): c for c in df.columns}
    out = []
    for name, wanted in target_columns(target):
        candidates = (name, *(aliases or {}).get(name.lower(), ()))
        out.append((name, wanted, next((by_lower[c.lower()] for c in candidates if c.lower() in by_lower), None)))
    return out


def _aligned(df: DataFrame, found: str, wanted: str) -> Column:
    """A source column in the target's type; a value that does not fit is NULL."""
    kind = df.schema[found].dataType
    if wanted == "string" and isinstance(kind, COMPLEX):
        return flat_text(found, kind, "joined")
    value = F.col(quoted(found))
    return value.try_cast(wanted) if isinstance(kind, (T.DecimalType, T.NumericType, T.StringType)) else value.cast(wanted)


def align_to_target(
    df: DataFrame,
    target: Target,
    aliases: Mapping[str, Sequence[str]] | None = None,
    metadata: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Exactly the target's columns, in order and type; ``target`` is a definition or the
    schema of the live table.

    A target column takes the source column of its own name, else the first
    alias present (both ignoring case), else publish metadata, else NULL. A value
    that does not fit the target type becomes NULL instead of failing the load.
    """
    columns = []
    for name, wanted, found in _sources(df, target, aliases):
        value = (metadata or {}).get(name.lower(), F.lit(None)).cast(wanted) if found is None else _aligned(df, found, wanted)
        columns.append(value.cast(wanted).alias(name))
    return df.select(*columns)


# Whole and floating numbers from the narrowest; digits that whole numbers can have.
NUMBER_WIDTH = {"tinyint": 1, "smallint": 2, "int": 3, "bigint": 4, "float": 5, "double": 6}
WHOLE_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def _decimal(kind: str) -> tuple[int, int] | None:
    found = re.fullmatch(r"decimal\((\d+),(\d+)\)", kind)
    return (int(found.group(1)), int(found.group(2))) if found else None


def fits(source: str, wanted: str) -> bool:
    """Whether every value of one Spark type has its place in another."""
    if source == wanted or wanted == "string":
        return True
    have, want = _decimal(source), _decimal(wanted)
    if want:
        whole = have[0] - have[1] if have else WHOLE_DIGITS.get(source)
        return whole is not None and want[0] - want[1] >= whole and want[1] >= (have[1] if have else 0)
    if have:
        return wanted == "double"
    if source in NUMBER_WIDTH and wanted in NUMBER_WIDTH:
        return NUMBER_WIDTH[source] <= NUMBER_WIDTH[wanted]
    return source == "date" and wanted in ("timestamp", "timestamp_ntz") or {source, wanted} == {"timestamp", "timestamp_ntz"}


@dataclass(frozen=True)
class SchemaChange:
    """How one column differs. ADDED: the target has it, the source has not (NULL, or publish
    metadata). MISSING: the source has it, the target has not (left out). RENAMED: taken
    from an alias. NARROWED: its type does not hold every value of the source."""

    column: str
    change: str
    source_type: str | None
    target_type: str | None


def schema_changes(df: DataFrame, target: Target, aliases: Mapping[str, Sequence[str]] | None = None) -> list[SchemaChange]:
    """What differs between a frame and its target, the target's columns first."""
    changes, used = [], set()
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for name, wanted, found in _sources(df, target, aliases):
        if found is None:
            changes.append(SchemaChange(name, "ADDED", None, wanted))
            continue
        used.add(found)
        if found.lower() != name.lower():
            changes.append(SchemaChange(name, "RENAMED", kinds[found], wanted))
        if not fits(kinds[found], wanted):
            changes.append(SchemaChange(name, "NARROWED", kinds[found], wanted))
    return changes + [SchemaChange(c, "MISSING", kinds[c], None) for c in df.columns if c not in used]


def lost_values(df: DataFrame, target: Target, aliases: Mapping[str, Sequence[str]] | None = None) -> dict[str, Column]:
    """For each narrowed column, whether a row's value gets lost: it is there, and NULL once
    it is in the target's type."""
    return {
        name: F.col(quoted(found)).isNotNull() & _aligned(df, found, wanted).isNull()
        for name, wanted, found in _sources(df, target, aliases)
        if found is not None and not fits(df.schema[found].dataType.simpleString(), wanted)
    }


def stamp_publish(df: DataFrame, target: str, run_id: str, published_at: str | None = None) -> DataFrame:
    """Publish run id and time, named after the target."""
    when = F.current_timestamp() if published_at is None else F.lit(published_at).cast("timestamp")
    return df.withColumns(
        {f"_{target}_publish_run_id": F.lit(run_id), f"_{target}_published_at_utc": when}
    )


def publish_metadata(df: DataFrame, target: str) -> DataFrame:
    """The distinct publish runs present in a published table."""
    return df.select(f"_{target}_publish_run_id", f"_{target}_published_at_utc").distinct()
