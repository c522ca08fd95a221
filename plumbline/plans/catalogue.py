"""Every operator as a named query over the test tables.

A query gets the ``Domain`` and returns a DataFrame of plain columns: arrays as
joined text, whole numbers as bigint, doubles rounded, times without zone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import clean, keys
from plumbline.operators import (
    enrich, events, facts, investigate, publish, rca, reconcile, rule_table, rules, search_index, state, summaries,
)
from plumbline.operators.skew import keep_one_per_key
from plumbline.operators.standardize import add_layer_metadata
from plumbline.plans import medallion, views
from plumbline.plans.bindings import AS_OF, DETECTED_AT, FIRST_BATCH, RETRY_BATCH, Domain
from plumbline.session import materialize, shared_folder
from plumbline.sources import tables

Query = Callable[[Domain], DataFrame]
QUERIES: dict[str, Query] = {}

# Doubles are compared after rounding. A sum of doubles depends on the order of its
# rows in the last digits, so a value that lies on a rounding boundary is nudged
# off it first.
ROUND, NUDGE = 4, 1e-9
SAMPLE_SIZE = 250
ATTEMPTED_AT = "2024-03-01 00:00:00"
PUBLISHED_AT = "2024-03-01 12:00:00"
RUN_ID = "run-0001"


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ", ")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double") + F.lit(NUDGE), ROUND)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(QUERIES[name](Domain(spark, sf_dir)))


# -- sources -----------------------------------------------------------------
@query("event_flatten")
def _(d):
    return events.flatten_documents(events.parse_documents(d.document_lines).drop("_raw_text")).drop("object_id", "raw_document_json")


@query("lenient_cast")
def _(d):
    return d.raw_readings.select(
        "raw_reading_id",
        clean.lenient_cast("volume", "double").alias("volume"),
        clean.lenient_cast("raw_status", "double").alias("status_number"),
        clean.lenient_cast(F.substring("batch_id", 7, 8), "int").alias("batch_day"),
    )


@query("event_to_json")
def _(d):
    shown = ("event_id", "event_timestamp", "payload", "production_date", "scenario_id")
    return events.with_iso_times(d.documents).select("event_id", events.json_text(F.struct(*shown)).alias("document"))


@query("batch_filter")
def _(d):
    return events.of_batch(d.flat_events, RETRY_BATCH).select("event_id", "raw_reading_id", "seed_batch_id", "payload_raw_status")


@query("bronze_record_hash")
def _(d):
    from plumbline.sources.files import add_bronze_metadata

    flat = events.flatten_documents(events.parse_documents(d.document_lines).drop("_raw_text"))
    return add_bronze_metadata(flat, RUN_ID, source_filter=None).select("event_id", "_record_hash", "_bronze_run_id", "_source_type")


@query("event_landing")
def _(d):
    return d.landing.documents.select("event_id", "raw_reading_id", "seed_batch_id", "raw_document_json", "_record_hash", "payload_quality_code")


@query("event_rejects")
def _(d):
    return d.landing.rejects.select("reject_reason", "raw_document_json", "_record_hash")


@query("event_landing_counts")
def _(d):
    return d.landing.received.groupBy("route", "reject_reason").agg(F.count("*").alias("line_count"))


def _run_checks(d: Domain) -> DataFrame:
    """Pipeline runs as load checks: rows read are expected, rows accepted written."""
    return d.runs.select(
        F.col("run_id").alias("table_name"),
        F.nullif("rows_read", F.lit(0)).alias("expected_rows"),
        F.when(F.col("warning_count") == 0, F.col("rows_accepted")).otherwise(F.col("rows_read")).alias("source_rows"),
        F.col("rows_accepted").alias("written_rows"),
    )


@query("layer_write_status")
def _(d):
    return _run_checks(d).withColumns(
        {"status": reconcile.layer_status(), "two_sided_status": reconcile.two_sided_status()}
    )


@query("failed_checks")
def _(d):
    return reconcile.failed_checks(_run_checks(d).withColumn("status", reconcile.layer_status()))


# -- standardization ---------------------------------------------------------
@query("clean_string")
def _(d):
    cleaned = [clean.clean_string(c).alias(c) for c in ("meter_id", "source_system", "batch_id")]
    return d.raw_readings.select("raw_reading_id", *cleaned)


@query("yes_no_flag")
def _(d):
    return d.raw_meters.select(
        "meter_id", clean.yes_no("active_flag").alias("is_active"),
        clean.yes_no("custody_transfer_flag").alias("is_custody_transfer"),
    )


@query("upper_code")
def _(d):
    return d.raw_readings.select("raw_reading_id", clean.upper_code("quality_code").alias("quality_code"), clean.upper_code("raw_status").alias("raw_status"))


@query("parse_dates")
def _(d):
    return d.raw_readings.select(
        "raw_reading_id", clean.parse_timestamp("reading_timestamp").alias("reading_timestamp"),
        clean.parse_date("production_date").alias("production_date"),
        clean.parse_timestamp("poll_timestamp").alias("poll_timestamp"),
    )


@query("parse_numbers")
def _(d):
    return d.raw_runs.select(
        "run_id", clean.parse_long("rows_read").alias("rows_read"),
        clean.parse_long("error_count").alias("error_count"),
        clean.parse_int("error_message").alias("message_number"),
        clean.parse_double("rows_accepted").alias("rows_accepted"),
    )


@query("record_hash")
def _(d):
    stamped = add_layer_metadata(d.meters, "silver", "meter_master", RUN_ID, PUBLISHED_AT)
    return stamped.select("meter_id", "_silver_run_id", "_silver_source", "_silver_processed_at", "_silver_record_hash")


@query("surrogate_key")
def _(d):
    return d.meters.select("meter_id", keys.surrogate_key("meter_id").alias("meter_key"), keys.surrogate_key("facility_id").alias("facility_key"))


@query("standardize_table")
def _(d):
    return d.readings


@query("standardize_flow_extract")
def _(d):
    return d.flow


@query("safe_divide")
def _(d):
    return d.runs.select("run_id", clean.safe_divide("rows_accepted", "rows_read").alias("accepted_rate"))


# -- rules -------------------------------------------------------------------
RULE = {r.exception_type: r for r in (*rules.READING_RULES, *rules.FLOW_RULES, *rules.NOMINATION_RULES, *rules.RUN_RULES, *rules.LINEAGE_RULES, *rules.PAYLOAD_RULES)}


def _failures(df: DataFrame, d: Domain, kind: str) -> DataFrame:
    return rules.failures_only(df, [RULE[kind]], d.ctx)


def _with_master(d: Domain) -> DataFrame:
    return enrich.join_master(d.readings, d.meters, d.facilities)


@query("dq_null")
def _(d):
    return _failures(d.readings, d, "NULL_VOLUME").select("raw_reading_id", "meter_id", "production_date")


@query("dq_zero_active")
def _(d):
    return _failures(_with_master(d), d, "ZERO_VOLUME").select("raw_reading_id", "meter_id", "volume", "master_meter_is_active")


@query("dq_negative")
def _(d):
    return _failures(d.readings, d, "NEGATIVE_VOLUME").select("raw_reading_id", "meter_id", "volume")


@query("dq_future_date")
def _(d):
    return _failures(d.readings, d, "FUTURE_DATE").select("raw_reading_id", "production_date")


@query("dq_missing_master")
def _(d):
    return _failures(_with_master(d), d, "INVALID_METER").select("raw_reading_id", "meter_id", "source_facility_id")


@query("dq_inactive_master")
def _(d):
    return _failures(_with_master(d), d, "INACTIVE_METER_REPORTING").select("raw_reading_id", "meter_id", "master_meter_active_flag")


@query("dq_ref_mismatch")
def _(d):
    return _failures(_with_master(d), d, "FACILITY_MISMATCH").select("raw_reading_id", "source_facility_id", "master_facility_id")


@query("dq_accepted_values")
def _(d):
    return _failures(d.readings, d, "INVALID_QUALITY_CODE").select("raw_reading_id", "quality_code")


@query("dq_late_arrival")
def _(d):
    return _failures(d.readings, d, "LATE_ARRIVAL").select("raw_reading_id", "reading_timestamp", "load_timestamp")


@query("dq_stale")
def _(d):
    joined = enrich.join_event_context(d.stored("readings"), d.events)
    return _failures(joined, d, "STALE_READING").select("raw_reading_id", "quality_code", "raw_status", "event_quality_code", "event_raw_status")


@query("dq_duplicate_grain")
def _(d):
    lines = d.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    counted = rules.add_duplicate_count(lines, ("l_orderkey", "l_linenumber"), "copies")
    return counted.where("copies > 1")


@query("dq_duplicate_reading")
def _(d):
    counted = rules.add_duplicate_count(d.stored("readings"))
    return _failures(counted, d, "DUPLICATE_READING").select("raw_reading_id", "meter_id", "reading_timestamp", "duplicate_meter_timestamp_count")


@query("dq_approved_closed")
def _(d):
    return _failures(d.flow, d, "UNAPPROVED_RECORD").select("flow_record_id", "meter_id", "is_approved", "close_status")


@query("dq_correction_variance")
def _(d):
    return _failures(d.flow, d, "CORRECTION_VARIANCE").select("flow_record_id", "meter_id", "measured_volume", "corrected_volume")


@query("dq_nomination_variance")
def _(d):
    return _failures(d.actual_vs_nominated, d, "NOMINATION_VARIANCE").select(
        "facility_id", "production_date", "product", "actual_volume", "nominated_volume"
    )


@query("dq_run_success")
def _(d):
    return _failures(d.runs, d, "RUN_NOT_SUCCESSFUL").select("run_id", "pipeline_name", "status")


@query("dq_rejected_threshold")
def _(d):
    return _failures(d.runs, d, "REJECTED_ROWS").select("run_id", "rows_rejected")


@query("dq_required_fields")
def _(d):
    failed = rules.failures_only(d.readings, rules.LINEAGE_RULES, d.ctx)
    return failed.select("raw_reading_id", *[r.flag for r in rules.LINEAGE_RULES])


@query("dq_payload_preserved")
def _(d):
    kept = F.expr("CASE cast(get_json_object(props, '$.k') AS int) WHEN 44 THEN NULL WHEN 66 THEN substring(props, 1, 4) ELSE props END")
    stored = d.table("events").select("event_id", kept.alias("raw_document_json"))
    return _failures(stored, d, "MISSING_RAW_PAYLOAD").select("event_id", "raw_document_json")


@query("dq_payload_received")
def _(d):
    return _failures(d.landing.received, d, "MISSING_RAW_PAYLOAD").select("raw_document_json", "reject_reason")


@query("dq_exception_count")
def _(d):
    return d.checked.select("raw_reading_id", *[r.flag for r in rules.READING_RULES], "dq_exception_count")


@query("dq_has_exception")
def _(d):
    return d.checked.select("raw_reading_id", "dq_has_exception")


@query("dq_primary_type")
def _(d):
    return d.checked.select("raw_reading_id", "primary_exception_type")


@query("dq_record_status")
def _(d):
    return d.checked.select("raw_reading_id", "record_quality_status")


@query("split_valid")
def _(d):
    return rules.split_valid(d.checked).select("raw_reading_id", "meter_id", "record_quality_status", "volume")


@query("split_exceptions")
def _(d):
    return rules.split_exceptions(d.checked).select("raw_reading_id", "meter_id", "primary_exception_type", "volume")


@query("exception_explode")
def _(d):
    return d.exceptions


@query("exception_id")
def _(d):
    return d.exceptions.select("raw_reading_id", "rule_id", "exception_id")


@query("rule_catalogue_join")
def _(d):
    return rules.join_rule_catalogue(d.exceptions, d.catalogue).select("exception_id", "rule_id", "rule_name", "layer", "owner_team")


@query("rules_from_catalogue")
def _(d):
    in_force = rule_table.compile_rules(d.tuned_catalogue)
    checked = rules.check_readings(d.enriched, d.ctx, in_force.rules, in_force.order)
    return rules.explode_exceptions(checked, in_force.rules, detected_at=DETECTED_AT).select(
        "exception_id", "rule_id", "exception_type", "severity", "business_reason", "raw_reading_id", "primary_exception_type"
    )


@query("rule_outcomes")
def _(d):
    outcome = rule_table.compile_rules(d.tuned_catalogue).outcome
    listed = d.spark.createDataFrame(sorted(outcome.items()), "rule_id string, outcome string")
    return listed.join(d.exceptions.groupBy("rule_id").agg(F.count("*").alias("untuned_failures")), "rule_id", "left")


@query("rule_summary_named")
def _(d):
    return summaries.ranked_rule_summary(d.stored("exceptions"), d.catalogue)


# -- joins -------------------------------------------------------------------
@query("join_enrich")
def _(d):
    return _with_master(d).select(
        "raw_reading_id", "meter_id", "source_facility_id", "master_meter_id", "master_facility_id",
        "master_meter_name", "master_product", "master_is_custody_transfer", "master_install_date",
        "master_facility_name", "master_region", "master_latitude",
    )


@query("join_event_context")
def _(d):
    joined = enrich.join_event_context(d.stored("readings"), d.events)
    return joined.select("raw_reading_id", *[c for c in joined.columns if c.startswith("event_")])


@query("dim_facility")
def _(d):
    return facts.dim_facility(d.facilities)


@query("dim_meter")
def _(d):
    return facts.dim_meter(d.meters, d.facilities)


@query("scenario_interval_join")
def _(d):
    return enrich.tag_scenarios(d.readings, d.scenarios).select("raw_reading_id", "meter_id", "reading_timestamp", "scenario_id")


@query("calendar_densify")
def _(d):
    days = d.flow.groupBy("meter_id", "production_date").agg(F.sum("measured_volume").alias("measured_volume"), F.count("*").alias("record_count"))
    return enrich.densify_calendar(d.meters, days, ["meter_id"], "2024-01-01", "2024-01-31", ["measured_volume", "record_count"])


@query("related_context_fallback")
def _(d):
    d.stored("exception_fact")
    related = investigate.related_context(d.exception_fact, d.rca_context)
    return related.select("exception_id", "related_by", "related_count", "related_group_id", "related_scenario_name", "related_next_step", "related_summary")


@query("related_exceptions")
def _(d):
    d.stored("exception_fact")
    return investigate.related_exceptions(d.rca_context, d.exception_fact, 250).select("exception_group_id", "position", "exception_id", "meter_id")


# -- daily facts -------------------------------------------------------------
@query("volume_measures")
def _(d):
    return facts.volume_measures(d.checked).select(
        "raw_reading_id", "reporting_facility_id", "is_valid_record", "is_review_record", "is_exception_record",
        *facts.VOLUME_SUMS,
    )


@query("meter_daily")
def _(d):
    return d.meter_days


@query("readiness_score")
def _(d):
    return d.meter_days.select("meter_id", "source_facility_id", "production_date", "gas_day", "source_system", "polling_platform", "exception_rate", "valid_record_rate", "reporting_readiness_score", "has_data_quality_issue")


@query("facility_daily")
def _(d):
    return d.facility_days


@query("nomination_daily")
def _(d):
    return facts.nomination_daily(d.nominations)


@query("actual_vs_nominated")
def _(d):
    return d.actual_vs_nominated


@query("flow_daily")
def _(d):
    return facts.flow_daily(d.flow)


@query("flow_reconciliation")
def _(d):
    return d.flow_reconciliation


@query("flow_reconciliation_per_meter_day")
def _(d):
    return facts.flow_reconciliation(d.meter_day_measures, d.flow, per_meter_day=True)


@query("exception_fact")
def _(d):
    return d.exception_fact


@query("run_fact")
def _(d):
    return d.run_fact


@query("ticket_fact")
def _(d):
    return d.ticket_fact


@query("source_day_profile")
def _(d):
    return facts.source_day_profile(d.readings, rules.ACCEPTED_QUALITY_CODES)


@query("first_match_code")
def _(d):
    profile = facts.source_day_profile(d.readings, rules.ACCEPTED_QUALITY_CODES)
    return facts.first_match_code(profile).select("meter_id", "source_facility_id", "production_date", "exception_code", "validation_status", "estimated_flag")


# -- summaries ---------------------------------------------------------------
@query("rule_summary")
def _(d):
    return summaries.rule_summary(d.stored("exceptions"))


@query("severity_rank")
def _(d):
    return summaries.ranked_rule_summary(d.stored("exceptions")).select("rule_id", "severity", "severity_rank")


@query("exception_summary_daily")
def _(d):
    return d.exception_summary


@query("pipeline_health")
def _(d):
    return d.health


@query("latest_run")
def _(d):
    return summaries.latest_run(d.run_fact)


@query("latest_run_per_customer")
def _(d):
    by_customer = d.table("orders").selectExpr("concat('C-', o_custkey) AS pipeline_name", "o_orderkey AS run_id", "o_orderstatus AS status", "o_orderdate AS started_at", "o_totalprice AS rows_read")
    return keep_one_per_key(by_customer, ["pipeline_name"], ["started_at", "run_id"])


@query("status_counts")
def _(d):
    return medallion.status_counts(d.checked)


@query("exception_kpis")
def _(d):
    return summaries.exception_kpis(d.stored("exception_fact"))


@query("event_kpis")
def _(d):
    return summaries.event_kpis(d.stored("exception_fact"))


@query("pipeline_kpis")
def _(d):
    return summaries.pipeline_kpis(d.health)


@query("rca_kpis")
def _(d):
    return summaries.rca_kpis(d.rca_context)


@query("reconciliation_kpis")
def _(d):
    return summaries.reconciliation_kpis(d.stages)


@query("publish_kpis")
def _(d):
    return summaries.publish_kpis(_published(d))


@query("filter_options")
def _(d):
    return summaries.filter_options(d.exception_fact, ["severity", "exception_type", "region", "facility_id", "source_system", "polling_platform"])


CUBE_FACETS = ("severity", "exception_type", "region", "facility_id", "source_system", "polling_platform", "event_device_status", "event_communication_status", "event_signal_quality")


@query("facet_cube")
def _(d):
    return summaries.facet_cube(d.exception_fact, CUBE_FACETS)


@query("facet_cube_options")
def _(d):
    cube = materialize(summaries.facet_cube(d.exception_fact, CUBE_FACETS[:6]))
    return summaries.options_of(cube)


@query("facet_cube_distributions")
def _(d):
    cube = materialize(summaries.facet_cube(d.exception_fact, CUBE_FACETS))
    chosen = investigate.faceted_filter(cube, {}, start="2024-01-05", end="2024-01-20")
    return summaries.distributions_of(chosen, ["event_device_status", "polling_platform", "severity"])


@query("filtered_exception_summary")
def _(d):
    chosen = investigate.faceted_filter(d.exception_fact, {"severity": ["High", "Medium/High"]}, start="2024-01-05", end="2024-01-20")
    return summaries.filtered_exception_summary(chosen)


@query("value_counts")
def _(d):
    facets = ["event_device_status", "event_communication_status", "event_signal_quality", "polling_platform", "severity", "source_system", "production_date"]
    return summaries.distributions(d.exception_fact, facets)


@query("latest_status_counts")
def _(d):
    return summaries.value_counts(d.health, "latest_status", "pipeline_count")


@query("top_exception_types")
def _(d):
    return summaries.top_groups(d.exception_fact, ["exception_type"], 10)


@query("top_facilities")
def _(d):
    return summaries.top_groups(d.exception_fact, ["facility_id", "facility_name"], 10)


@query("ordered_detail")
def _(d):
    way = {"production_date": "desc", "facility_id": "asc", "meter_id": "asc", "exception_type": "asc"}
    return summaries.ordered(d.exception_fact, way).select(*way, "exception_id")


@query("facility_kpi_sample")
def _(d):
    order = ["production_date", "reporting_facility_id", "master_product", "gas_day"]
    columns = ["reporting_facility_id", "master_region", "master_product", "production_date", "gas_day", "meter_count", "hourly_reading_count", "accepted_or_review_volume", "exception_reading_count", "reporting_readiness_score"]
    return summaries.sample_rows(d.facility_days, columns, [F.asc_nulls_last(c) for c in order], 25)


@query("drilldown_labels")
def _(d):
    parts = ["production_date", "facility_id", "meter_id", "exception_type", F.substring("exception_id", 1, 12)]
    return summaries.drilldown_labels(d.exception_fact, "exception_id", parts)


# -- reconciliation ----------------------------------------------------------
@query("silver_counts")
def _(d):
    checked = d.stored("checked")
    return reconcile.silver_counts([d.raw_readings, d.flat_events, checked, rules.split_valid(checked), rules.split_exceptions(checked), d.exceptions])


@query("checkpoints")
def _(d):
    return reconcile.checkpoints(d.stage_frames)


@query("reconciliation_deltas")
def _(d):
    return d.stages.drop("notes", "interpretation")


@query("checkpoint_interpretation")
def _(d):
    return d.stages.select("stage_order", "metric_type", "interpretation")


@query("layer_summary")
def _(d):
    return reconcile.layer_summary(d.stages)


def _published(d: Domain) -> DataFrame:
    return _run_checks(d).withColumn("status", reconcile.publish_status())


@query("publish_status")
def _(d):
    return _published(d)


@query("publish_deltas")
def _(d):
    return reconcile.publish_deltas(_published(d)).select("table_name", "source_vs_written_delta", "expected_vs_written_delta")


@query("publish_status_counts")
def _(d):
    return summaries.value_counts(_published(d), "status", "target_count")


# -- event documents ---------------------------------------------------------
@query("select_anomalies")
def _(d):
    return events.select_anomalies(d.readings).select("raw_reading_id", "volume", "quality_code", "raw_status")


@query("anomaly_plus_sample")
def _(d):
    return events.anomalies_plus_sample(d.stored("readings"), SAMPLE_SIZE).select("raw_reading_id", "quality_code", "raw_status")


@query("event_context")
def _(d):
    return d.readings.select("raw_reading_id", events.event_context().alias("c")).select("raw_reading_id", "c.*")


@query("scenario_lookup")
def _(d):
    return d.readings.select("raw_reading_id", "raw_status", events.scenario_of_status().alias("scenario_id"))


@query("event_document")
def _(d):
    return d.document_lines.select(F.col("value").alias("document"))


@query("event_upsert")
def _(d):
    stored = events.flatten_documents(d.first_documents).select(
        "event_id", "raw_reading_id", "payload_raw_status", "seed_batch_id", "ingested_at",
        F.lit("2024-02-01 00:00:00").alias("last_seed_attempt_at"), F.col("seed_batch_id").alias("last_seed_batch_id"),
    )
    retried = events.flatten_documents(d.retry_documents).select(
        F.when(F.col("payload_pressure") < 701, F.concat(F.lit("EVT-"), "raw_reading_id")).otherwise(F.col("event_id")).alias("event_id"),
        "raw_reading_id", "payload_raw_status", "seed_batch_id", "ingested_at",
    )
    return events.upsert_documents(stored, retried, ATTEMPTED_AT)


@query("batch_reset")
def _(d):
    return events.without_batch(d.flat_events, FIRST_BATCH).select("event_id", "seed_batch_id")


# -- publishing --------------------------------------------------------------
@query("flatten_complex")
def _(d):
    grouped = d.exception_summary.select("exception_group_id", "region", "source_systems", "signal_qualities", F.col("exception_count").cast("decimal(12,2)").alias("exception_count"))
    return publish.flatten_complex(grouped)


@query("normalize_columns")
def _(d):
    untidy = d.runs.selectExpr("run_id AS `run id`", "run_id AS `Run-ID`", "rows_read AS `2nd rows`", "status AS `__status__`", "warning_count AS `warn  count`")
    return publish.normalize_columns(untidy)


@query("normalize_values")
def _(d):
    rate = clean.safe_divide("rows_rejected", "rows_read")
    untidy = d.runs.select("run_id", F.when(F.col("warning_count") == 1, F.lit(float("nan"))).otherwise(rate).alias("rejected_rate"), F.array("status", "pipeline_name").alias("tags"))
    return publish.normalize_values(untidy)


def _aligned(d: Domain, table: str, source: DataFrame) -> DataFrame:
    when = F.lit(PUBLISHED_AT).cast("timestamp_ntz")
    target = (*publish.SUPPORT_TABLES[table], ("_publish_run_id", "varchar(200)"), ("_published_at_utc", "datetime2(3)"))
    return publish.align_to_target(source, target, publish.SUPPORT_ALIASES.get(table), {"_publish_run_id": F.lit(RUN_ID), "_published_at_utc": when})


@query("align_to_target")
def _(d):
    return _aligned(d, "fact_pipeline_run", d.run_fact)


# A target that has become narrower than the run facts.
NARROW_RUNS = (("run_id", "int"), ("pipeline_name", "varchar(200)"), ("rows_read", "decimal(5,0)"), ("rows_rejected", "int"), ("accepted_rate", "decimal(3,2)"), ("error_message", "float"))


@query("narrowed_values")
def _(d):
    lost = publish.lost_values(d.run_fact, NARROW_RUNS)
    counts = d.run_fact.agg(*[F.count_if(c).alias(name) for name, c in lost.items()])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("lost_count")) for c in lost])))


@query("publish_metadata")
def _(d):
    health = publish.stamp_publish(d.run_fact, "support", RUN_ID, PUBLISHED_AT)
    return publish.publish_metadata(health, "support")


@query("view_summary")
def _(d):
    from plumbline.sources.remote import view_summary

    tables = {"dim_facility": facts.dim_facility(d.facilities), "fact_pipeline_run": d.run_fact, "fact_support_ticket": d.ticket_fact, "flow_daily": facts.flow_daily(d.flow)}
    return view_summary(tables, RUN_ID)


# -- serving views -----------------------------------------------------------
def _gold(d: Domain, table: str) -> DataFrame:
    return {
        "pipeline_health_summary": lambda: d.health,
        "fact_data_quality_exception": lambda: d.exception_fact,
        "exception_summary_daily": lambda: d.exception_summary,
        "fact_facility_volume_daily": lambda: d.facility_days,
        "fact_actual_vs_nominated_daily": lambda: d.actual_vs_nominated,
        "fact_flow_reconciliation_daily": lambda: d.flow_reconciliation,
        "fact_source_to_target_reconciliation": lambda: d.stages,
        "fact_support_ticket": lambda: d.ticket_fact,
        "rca_context": lambda: d.rca_context,
    }[table]()


def _investigation(name: str) -> Query:
    table = views.INVESTIGATION_VIEWS[name][0]
    return lambda d: views.investigation_view(name, {table: _gold(d, table)})


def _business(table: str) -> Query:
    return lambda d: publish.normalize_columns(publish.normalize_values(_gold(d, table)))


def _support(table: str) -> Query:
    return lambda d: _aligned(d, table, _gold(d, table))


for _name in views.INVESTIGATION_VIEWS:
    QUERIES[f"view_investigation_{_name}"] = _investigation(_name)
for _name, _table in views.BUSINESS_VIEWS.items():
    QUERIES[f"view_business_{_name}"] = _business(_table)
for _name, _table in views.SUPPORT_VIEWS.items():
    QUERIES[f"view_support_{_name}"] = _support(_table)


@query("reliability_overview")
def _(d):
    d.stored("checked")
    return views.reliability_overview(d.health, d.exception_fact, d.stages)


# -- investigation -----------------------------------------------------------
@query("faceted_filter")
def _(d):
    chosen = {"severity": ["High"], "region": ["ASIA", "EUROPE"], "polling_platform": [], "not_a_column": ["x"]}
    return investigate.faceted_filter(d.exception_fact, chosen, start="2024-01-03", end="2024-01-25").select("exception_id", "severity", "region", "production_date")


@query("text_search")
def _(d):
    return investigate.text_search(d.exception_fact, "r-0001", ["meter_id", "raw_reading_id"]).select("exception_id", "meter_id", "raw_reading_id")


@query("text_search_indexed")
def _(d):
    columns, path = ["meter_id", "raw_reading_id"], f"{shared_folder(d.spark)}/plumbline/index-{uuid.uuid4().hex}"
    fact = d.stored("exception_fact")
    search_index.build_index(fact, columns, path)
    return search_index.indexed_search(fact, path, "r-0001", columns).select("exception_id", *columns)


@query("exception_context_json")
def _(d):
    return investigate.exception_context(d.exception_fact)


# -- root cause and review state ---------------------------------------------
@query("rca_context")
def _(d):
    return d.rca_context


@query("likely_layer")
def _(d):
    return d.rca_context.select("exception_group_id", "exception_type", "scenario_id", rca.likely_layer(rca.any_troubled_pipeline(d.health)).alias("likely_layer"))


def _explained(d: Domain) -> DataFrame:
    return rca.explain_groups(d.rca_context, d.health)


@query("suggested_checks")
def _(d):
    return _explained(d).select("exception_group_id", "scenario_id", "suggested_checks")


@query("cautions")
def _(d):
    return _explained(d).select("exception_group_id", "scenario_id", "cautions")


@query("rca_summary_text")
def _(d):
    return _explained(d).select("exception_group_id", "scenario_id", "rca_summary_text")


@query("rca_packet")
def _(d):
    d.stored("checked")
    d.stored("exception_fact")
    return rca.rca_packets(d.rca_context, d.exception_fact, d.health, d.stages, 5)


@query("group_key")
def _(d):
    return d.raw_reviews.select("exception_id", keys.review_group_key("production_date", "facility_id", "exception_type", "severity").alias("exception_group_key"))


@query("review_decision")
def _(d):
    return d.old_reviews.unionByName(d.new_reviews).select("exception_id", "status", "priority", "reviewer_decision", "reviewer_comments", "accepted_flag")


@query("triage_keyed_upsert")
def _(d):
    name = f"triage_{uuid.uuid4().hex}"
    tables.write_keyed_table(d.stored_triage, name, "exception_group_key", path=f"{shared_folder(d.spark)}/plumbline/{name}")
    tables.change_keyed_table(name, d.new_reviews, state.triage_upsert)
    return tables.read_keyed_table(d.spark, name)


@query("triage_upsert")
def _(d):
    return state.triage_upsert(d.stored_triage, d.new_reviews)


@query("review_append")
def _(d):
    return state.note_rows(d.old_reviews).unionByName(state.note_rows(d.new_reviews))


@query("review_log_append")
def _(d):
    return state.review_log_rows(d.old_reviews).unionByName(state.review_log_rows(d.new_reviews))


@query("activity_append")
def _(d):
    return state.activity_rows(d.reviews)


@query("delete_by_key")
def _(d):
    return state.delete_by_key(state.note_rows(d.reviews), created_by="user_1", note_text="check totals")


@query("app_state_counts")
def _(d):
    return state.state_counts(state.triage_upsert(d.stored_triage, d.new_reviews), state.note_rows(d.reviews), state.review_log_rows(d.reviews), state.activity_rows(d.reviews))


@query("dedupe_by_key")
def _(d):
    lines = d.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return keep_one_per_key(lines, ["l_orderkey", "l_linenumber"], order, newest=False)
