"""Root-cause context and its facts-only texts, for all groups at once."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.clean import clean_string, is_true
from plumbline.operators.events import json_text
from plumbline.operators.investigate import first_related

DEFAULT_NEXT_STEP = "review source data, mapping, timing, and recent pipeline runs."

# Layers to check first, in order: exception types, then words in the device,
# communication or signal text (fixed values).
LAYER_RULES: tuple[tuple[str, dict[str, tuple[str, ...]]], ...] = (
    ("Source / polling platform", {"type": ("NO_SIGNAL", "STALE_READING", "ZERO_VOLUME")}),
    ("Source / device communication", {"device": ("NO_SIGNAL",), "communication": ("FAILED",)}),
    ("Polling platform / source data freshness", {"signal": ("STALE", "UNKNOWN")}),
    ("Master/reference data", {"type": ("INVALID_METER", "INACTIVE_METER_REPORTING", "FACILITY_MISMATCH")}),
    ("Ingestion / retry / duplicate handling", {"type": ("DUPLICATE_READING", "DUPLICATE_RETRY")}),
    ("Pipeline timing / schedule", {"type": ("LATE_ARRIVAL",)}),
    ("Source date mapping / validation rule", {"type": ("FUTURE_DATE",)}),
    ("Source status mapping / business-rule validation", {"type": ("INVALID_QUALITY_CODE",)}),
)
PIPELINE_LAYER = "Pipeline / load reliability"
DEFAULT_LAYER = "Silver validation / data-quality rules"
TROUBLED_RUNS = ("FAILED", "PARTIAL_SUCCESS")

# Next checks, by words in the layer, exact types or words in the type (fixed values).
CHECK_RULES: tuple[tuple[dict[str, tuple[str, ...]], tuple[str, ...]], ...] = (
    ({"layer": ("SOURCE", "POLLING")}, (
        "Check whether the source system produced the record at the expected timestamp.",
        "Compare event timestamp, poll timestamp, load timestamp, and report refresh timing.",
        "Review device status, communication status, signal quality, and polling platform context.",
    )),
    ({"layer": ("MASTER",), "type": ("INVALID_METER", "INACTIVE_METER_REPORTING", "FACILITY_MISMATCH")}, (
        "Validate meter_id and facility_id against the master/reference table.",
        "Check active_flag and effective-date logic for the meter and facility.",
        "Confirm whether source facility assignment conflicts with master data.",
    )),
    ({"layer": ("INGESTION",), "type_word": ("DUPLICATE",)}, (
        "Group by meter_id, production_date, reading timestamp, and source system to confirm duplicate grain.",
        "Check retry behavior, duplicate source files, and repeated batch IDs.",
        "Confirm whether duplicate records are intentional business events or load artifacts.",
    )),
    ({"layer": ("TIMING",), "type": ("LATE_ARRIVAL",)}, (
        "Check the last successful run, first bad run, and whether late records arrived after refresh.",
        "Compare load_timestamp to report cutoff or expected refresh time.",
        "Review pipeline job history for partial loads, retries, or delayed upstream extracts.",
    )),
    ({"type": ("FUTURE_DATE",)}, (
        "Confirm whether production_date is mapped from the correct source field.",
        "Check time-zone and date-window logic.",
        "Reject or quarantine future-dated records until the source/date mapping is corrected.",
    )),
    ({"type": ("INVALID_QUALITY_CODE",)}, (
        "Compare the source quality code to the accepted value list.",
        "Confirm whether the source introduced a new code that needs business approval.",
        "Update the mapping/rule reference only after business confirmation.",
    )),
)
DEFAULT_CHECKS = (
    "Compare source, Bronze, Silver, Gold, and BigQuery row counts for the affected date/facility.",
    "Review the DQ rule definition and confirm the business rule with the owning team.",
    "Use the selected exception detail and raw event context to validate the likely failure layer.",
)

# Cautions: three always, the others by type (fixed values).
GENERAL_CAUTIONS = (
    "Do not assume the business volume is wrong until source data, timing, and rule filters are checked.",
    "Do not assume the dashboard is the root cause before validating upstream source-to-target counts.",
    "Do not change business rules without confirming the intended definition with the owning business/data team.",
)
TYPE_CAUTIONS = (
    (("ZERO_VOLUME", "NO_SIGNAL", "STALE_READING"),
     "Do not assume a zero/stale reading is invalid until field conditions or device communication context are reviewed."),
    (("INVALID_METER", "INACTIVE_METER_REPORTING", "FACILITY_MISMATCH"),
     "Do not assume the source is wrong until master-data effective dates and mappings are confirmed."),
    (("DUPLICATE_READING", "DUPLICATE_RETRY"),
     "Do not delete duplicate-looking records until the intended business grain is confirmed."),
)

TEXT_SETS = ("source_systems", "polling_platforms", "device_statuses", "communication_statuses", "signal_qualities")
SAMPLE_FIELDS = (
    "exception_id", "rule_id", "raw_reading_id", "meter_id", "quality_code", "raw_status",
    "event_device_status", "event_communication_status", "event_signal_quality",
)


def rca_context(summary: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Exception groups with the known scenario of their facility and type, and a
    one-sentence seed for the analysis."""
    known = scenarios.select(
        F.col("affected_facility_id").alias("facility_id"),
        F.col("expected_exception_type").alias("exception_type"),
        "scenario_id", "scenario_name", F.col("description").alias("scenario_description"),
        "expected_root_cause", "recommended_next_step",
    )
    joined = summary.join(known, ["facility_id", "exception_type"], "left").select(
        "exception_group_id", "production_date", "facility_id", "facility_name", "region", "basin",
        "exception_type", "severity", "exception_count", "affected_reading_count", "affected_meter_count",
        *[F.array_join(c, ", ").alias(c + "_text") for c in TEXT_SETS],
        "scenario_id", "scenario_name", "scenario_description", "expected_root_cause", "recommended_next_step",
    )
    return joined.withColumn("rca_summary_seed", _seed())


def _seed() -> Column:
    def known(column: str, otherwise: str) -> Column:
        return F.coalesce(F.col(column), F.lit(otherwise))

    sentence = (
        ("On", F.col("production_date").cast("string")),
        ("facility", known("facility_id", "UNKNOWN")),
        ("has", F.col("exception_count").cast("string")),
        ("exception records of type", known("exception_type", "UNKNOWN")),
        ("with severity", known("severity", "UNKNOWN")),
        (". Device context:", known("device_statuses_text", "none")),
        (". Communication context:", known("communication_statuses_text", "none")),
        (". Suggested next step:", known("recommended_next_step", DEFAULT_NEXT_STEP)),
    )
    return F.concat_ws(" ", *[part for word, value in sentence for part in (F.lit(word), value)])


def _upper(column: str) -> Column:
    return F.upper(F.coalesce(clean_string(column), F.lit("")))


def _holds(tests: dict[str, tuple[str, ...]], layer: Column | None = None) -> Column:
    """True when any test of a rule holds: exact types, or words within a text."""
    texts = {
        "device": _upper("device_statuses_text"),
        "communication": _upper("communication_statuses_text"),
        "signal": _upper("signal_qualities_text"),
        "type_word": _upper("exception_type"),
    }
    if layer is not None:
        texts["layer"] = F.upper(layer)
    found = []
    for what, words in tests.items():
        if what == "type":
            found.append(_upper("exception_type").isin(*words))
        else:
            found.extend(F.contains(texts[what], F.lit(word)) for word in words)
    return reduce(or_, found)


def any_troubled_pipeline(health: DataFrame) -> Column:
    """Whether any pipeline's latest run failed or loaded partially (scalar)."""
    troubled = is_true(F.upper("latest_status").isin(*TROUBLED_RUNS))
    return health.agg(F.coalesce(F.bool_or(troubled), F.lit(False)).alias("troubled")).scalar()


def likely_layer(troubled_pipeline: Column) -> Column:
    """The layer to check first."""
    by_rule = [F.when(_holds(tests), F.lit(layer)) for layer, tests in LAYER_RULES]
    return F.coalesce(*by_rule, F.when(troubled_pipeline, F.lit(PIPELINE_LAYER)), F.lit(DEFAULT_LAYER))


def _texts(values: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def suggested_checks(layer: Column) -> Column:
    """What to check next: an ordered list without repeats."""
    none = F.array().cast("array<string>")
    parts = [F.when(_holds(tests, layer), _texts(checks)).otherwise(none) for tests, checks in CHECK_RULES]
    listed = F.array_distinct(F.concat(*parts))
    return F.when(F.size(listed) > 0, listed).otherwise(_texts(DEFAULT_CHECKS))


def cautions() -> Column:
    """What not to assume yet."""
    none = F.array().cast("array<string>")
    kind = _upper("exception_type")
    special = [F.when(kind.isin(*types), _texts((text,))).otherwise(none) for types, text in TYPE_CAUTIONS]
    return F.concat(_texts(GENERAL_CAUTIONS), *special)


def _shown(column: str) -> Column:
    return F.coalesce(clean_string(column), F.lit("N/A"))


def _number(column: str) -> Column:
    return F.format_number(F.coalesce(F.col(column), F.lit(0)), 0)


def summary_text(layer: Column) -> Column:
    """The group in plain English."""
    optional_cause = clean_string("expected_root_cause")
    optional_step = clean_string("recommended_next_step")
    return F.concat(
        F.lit("On "), _shown("production_date"), F.lit(", facility "), _shown("facility_id"),
        F.lit(" ("), _shown("facility_name"), F.lit(") has "), _number("exception_count"),
        F.lit(" exception records of type "), _shown("exception_type"),
        F.lit(" with severity "), _shown("severity"),
        F.lit(". The affected set includes approximately "), _number("affected_reading_count"),
        F.lit(" readings across "), _number("affected_meter_count"),
        F.lit(" meter(s). Device context shows "), _shown("device_statuses_text"),
        F.lit("; communication context shows "), _shown("communication_statuses_text"),
        F.lit("; signal quality context shows "), _shown("signal_qualities_text"),
        F.lit(". The first layer to check should be: "), layer, F.lit("."),
        F.coalesce(F.concat(F.lit(" Known scenario/root-cause context suggests: "), optional_cause, F.lit(".")), F.lit("")),
        F.coalesce(F.concat(F.lit(" Recommended next step: "), optional_step), F.lit("")),
    )


def explain_groups(context: DataFrame, health: DataFrame) -> DataFrame:
    """Likely layer, checks, cautions and summary for every exception group."""
    layered = context.withColumn("likely_layer", likely_layer(any_troubled_pipeline(health)))
    layer = F.col("likely_layer")
    return layered.withColumns(
        {
            "suggested_checks": suggested_checks(layer),
            "cautions": cautions(),
            "rca_summary_text": summary_text(layer),
        }
    )


def _rows_as_json(df: DataFrame, columns: tuple[str, ...]) -> Column:
    """A small context table (one row per stage or pipeline) as one JSON value,
    rows in the order of its columns."""
    rows = F.array_sort(F.collect_list(F.struct(*columns)))
    return df.agg(json_text(rows).alias("rows")).scalar()


def evidence() -> Column:
    """The facts an explanation may use, as one struct."""
    counts = ("exception_count", "affected_reading_count", "affected_meter_count")
    texts = (
        "production_date", "facility_id", "facility_name", "region", "basin", "exception_type", "severity",
        *[c + "_text" for c in TEXT_SETS],
        "scenario_id", "scenario_name", "expected_root_cause", "recommended_next_step",
    )
    return F.struct(
        *[_shown(c).alias(c) for c in texts],
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts],
    )


def rca_packets(
    context: DataFrame, exceptions: DataFrame, health: DataFrame, stages: DataFrame, samples: int
) -> DataFrame:
    """Per group, everything a reviewer or a text model may use and nothing else:
    evidence, layer, checks, cautions, sample exceptions, checkpoints, pipelines.

    Each group's sample is limited before it is collected.
    """
    explained = explain_groups(context, health).withColumn("evidence", evidence())
    keys = ["facility_id", "exception_type", "production_date"]
    sample = (
        first_related(exceptions, samples, SAMPLE_FIELDS)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("position", *SAMPLE_FIELDS))).alias("sample_rows"))
        .select(*[F.col(k).alias("_" + k) for k in keys], "sample_rows")
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col("_" + k)) for k in keys])
    checkpoint_rows = _rows_as_json(stages, ("stage_order", "layer", "object_name", "row_count", "metric_type", "notes"))
    pipeline_rows = _rows_as_json(
        health,
        ("pipeline_name", "latest_status", "latest_rows_read", "latest_rows_accepted",
         "latest_rows_rejected", "run_count", "failed_count", "partial_load_count"),
    )
    return explained.join(sample, same, "left").select(
        "exception_group_id",
        "scenario_id",
        "likely_layer",
        "rca_summary_text",
        json_text("evidence").alias("evidence_json"),
        json_text("suggested_checks").alias("checks_json"),
        json_text("cautions").alias("cautions_json"),
        json_text(F.coalesce("sample_rows", F.array().cast(sample.schema["sample_rows"].dataType))).alias("sample_rows_json"),
        checkpoint_rows.alias("checkpoints_json"),
        pipeline_rows.alias("pipelines_json"),
    )
