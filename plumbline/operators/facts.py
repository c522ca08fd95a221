"""Dimensions, daily facts, variances and run/ticket facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.clean import is_true, safe_divide
from plumbline.functions.keys import surrogate_key
from plumbline.operators.grouped import summarize
from plumbline.operators.rules import READING_RULES, SUCCESS_STATUSES

# Grain of the meter-day and facility-day facts (fixed values).
METER_DAY_KEYS = (
    "meter_id", "master_meter_id", "reporting_facility_id", "source_facility_id",
    "master_facility_id", "master_facility_name", "master_region", "master_basin",
    "master_state", "master_asset_type", "master_operator", "master_product",
    "master_meter_type", "master_measurement_type", "master_is_custody_transfer",
    "production_date", "gas_day", "source_system", "polling_platform",
)
FACILITY_DAY_KEYS = (
    "reporting_facility_id", "master_facility_name", "master_region", "master_basin",
    "master_state", "master_asset_type", "master_operator", "master_product",
    "production_date", "gas_day",
)
VOLUME_SUMS = ("valid_volume", "accepted_or_review_volume", "all_nonnegative_volume")
READING_COUNTS = ("hourly_reading_count", "valid_reading_count", "review_reading_count", "exception_reading_count")
FLAG_COUNTS = tuple(r.flag.removeprefix("dq_") + "_count" for r in READING_RULES)

# Severities that make a ticket urgent (fixed values).
URGENT_TICKET_SEVERITIES = ("HIGH", "CRITICAL", "SEV1", "SEV2")


def sorted_set(column: str) -> Column:
    """Distinct non-NULL values in order (a plain set has no stable order)."""
    return F.array_sort(F.collect_set(column)).alias(column)


def dim_facility(facilities: DataFrame) -> DataFrame:
    columns = [c for c in facilities.columns if not c.startswith("_")]
    return facilities.select(surrogate_key("facility_id").alias("facility_key"), *columns)


def dim_meter(meters: DataFrame, facilities: DataFrame) -> DataFrame:
    """Meters with the attributes of their facility."""
    own = [c for c in meters.columns if not c.startswith("_")]
    attributes = ["facility_name", "region", "basin", "state", "asset_type", "operator"]
    return meters.select(*own).join(facilities.select("facility_id", *attributes), "facility_id", "left").select(
        surrogate_key("meter_id").alias("meter_key"),
        surrogate_key("facility_id").alias("facility_key"),
        *own,
        *attributes,
    )


def volume_measures(checked: DataFrame) -> DataFrame:
    """Reporting facility, status booleans and the three usable-volume measures."""
    status = F.col("record_quality_status")
    usable = F.when(F.col("volume") >= 0, F.col("volume")).otherwise(F.lit(0.0))

    def volume_if(accepted: Column) -> Column:
        return F.when(accepted, usable).otherwise(F.lit(0.0))

    return checked.withColumns(
        {
            "reporting_facility_id": F.coalesce("master_facility_id", "source_facility_id"),
            "is_valid_record": status == "VALID",
            "is_review_record": status == "REVIEW",
            "is_exception_record": status == "EXCEPTION",
            "valid_volume": volume_if(status == "VALID"),
            "accepted_or_review_volume": volume_if(status.isin("VALID", "REVIEW")),
            "all_nonnegative_volume": usable,
        }
    )


def add_readiness(daily: DataFrame) -> DataFrame:
    """Exception and valid rates, the 0-100 readiness score and the issue flag."""
    total = "hourly_reading_count"
    rate = safe_divide("exception_reading_count", total)
    return daily.withColumns(
        {
            "exception_rate": rate,
            "valid_record_rate": safe_divide("valid_reading_count", total),
            "reporting_readiness_score": F.round(100.0 * (1.0 - F.coalesce(rate, F.lit(0.0))), 2),
            "has_data_quality_issue": F.col("exception_reading_count") > 0,
        }
    )


def meter_daily(checked: DataFrame) -> DataFrame:
    """Meter-day fact. NULL key parts stay their own group."""
    flag_counts = [
        F.count_if(r.flag).alias(name) for r, name in zip(READING_RULES, FLAG_COUNTS, strict=True)
    ]
    sets = {
        "exception_types": "primary_exception_type",
        "quality_codes": "quality_code",
        "raw_statuses": "raw_status",
        "event_device_statuses": "event_device_status",
        "event_communication_statuses": "event_communication_status",
        "event_signal_qualities": "event_signal_quality",
    }
    measures = [
        F.count("*").alias("hourly_reading_count"),
        F.count_if("is_valid_record").alias("valid_reading_count"),
        F.count_if("is_review_record").alias("review_reading_count"),
        F.count_if("is_exception_record").alias("exception_reading_count"),
        *[F.sum(c).alias(c) for c in VOLUME_SUMS],
        F.sum(F.coalesce("volume", F.lit(0.0))).alias("raw_volume_sum"),
        F.avg("pressure").alias("avg_pressure"),
        F.avg("temperature").alias("avg_temperature"),
        F.min("reading_timestamp").alias("first_reading_timestamp"),
        F.max("reading_timestamp").alias("last_reading_timestamp"),
        F.min("poll_timestamp").alias("first_poll_timestamp"),
        F.max("poll_timestamp").alias("last_poll_timestamp"),
        F.max("load_timestamp").alias("latest_load_timestamp"),
        *flag_counts,
        F.max("dq_exception_count").alias("max_exception_count_on_reading"),
    ]
    counts = {"batch_count": "batch_id", "raw_reading_count": "raw_reading_id"}
    reads = [
        "is_valid_record", "is_review_record", "is_exception_record", *VOLUME_SUMS, "volume", "pressure", "temperature", "reading_timestamp",
        "poll_timestamp", "load_timestamp", "dq_exception_count", *[r.flag for r in READING_RULES],
    ]
    daily = summarize(volume_measures(checked), METER_DAY_KEYS, measures, reads, distinct=counts, sets=sets)
    return add_readiness(daily)


def facility_daily(meter_days: DataFrame) -> DataFrame:
    """Facility-day fact from meter-days; pressures and temperatures are the plain
    average of the meters' averages."""
    sums = [*READING_COUNTS, *VOLUME_SUMS, "raw_volume_sum", *FLAG_COUNTS]
    daily = meter_days.groupBy(*FACILITY_DAY_KEYS).agg(
        F.count_distinct("meter_id").alias("meter_count"),
        *[F.sum(c).alias(c) for c in sums],
        F.avg("avg_pressure").alias("avg_pressure"),
        F.avg("avg_temperature").alias("avg_temperature"),
        F.min("first_reading_timestamp").alias("first_reading_timestamp"),
        F.max("last_reading_timestamp").alias("last_reading_timestamp"),
        F.max("latest_load_timestamp").alias("latest_load_timestamp"),
    )
    return add_readiness(daily)


def nomination_daily(nominations: DataFrame) -> DataFrame:
    """Nominated volume per facility, day and product."""
    return nominations.groupBy("facility_id", "production_date", "product").agg(
        F.sum("nominated_volume").alias("nominated_volume"),
        F.count_distinct("nomination_id").alias("nomination_count"),
        sorted_set("customer_group").alias("customer_groups"),
        sorted_set("contract_type").alias("contract_types"),
        sorted_set("status").alias("nomination_statuses"),
    )


def add_variance(df: DataFrame, actual: str, base: str, delta: str, pct: str) -> DataFrame:
    """``actual - base`` and the same as a share of ``base``."""
    difference = F.col(actual) - F.col(base)
    return df.withColumns({delta: difference, pct: safe_divide(difference, base)})


def actual_vs_nominated(facility_days: DataFrame, nominations: DataFrame) -> DataFrame:
    """Facility-day actuals next to their nomination. Days without one keep NULLs;
    a NULL product matches nothing."""
    actual = facility_days.select(
        F.col("reporting_facility_id").alias("facility_id"),
        F.col("master_facility_name").alias("facility_name"),
        F.col("master_region").alias("region"),
        F.col("master_basin").alias("basin"),
        F.col("master_state").alias("state"),
        "production_date",
        F.col("master_product").alias("product"),
        F.col("accepted_or_review_volume").alias("actual_volume"),
        "valid_volume", "exception_rate", "reporting_readiness_score", "has_data_quality_issue",
    )
    joined = actual.join(nomination_daily(nominations), ["facility_id", "production_date", "product"], "left")
    return add_variance(
        joined, "actual_volume", "nominated_volume", "actual_vs_nominated_delta", "actual_vs_nominated_pct"
    )


def flow_daily(extract: DataFrame, keys: Sequence[str] = ("meter_id", "facility_id", "production_date")) -> DataFrame:
    """Flow-computer records per meter, facility and day.

    Records are first added up per status and code, as plain numbers and in one pass; the
    sets are collected of the few rows that are left, not of every record.
    """
    added = extract.groupBy(*keys, "validation_status", "exception_code").agg(
        F.sum("measured_volume").alias("flow_measured_volume"),
        F.sum("corrected_volume").alias("flow_corrected_volume"),
        F.count("*").alias("flow_record_count"),
        F.count_if(~F.col("is_approved")).alias("unapproved_flow_count"),
        F.count_if(F.col("close_status") != "CLOSED").alias("open_flow_count"),
        F.max("last_updated_timestamp").alias("flow_last_updated_timestamp"),
    )
    sums = ("flow_measured_volume", "flow_corrected_volume", "flow_record_count", "unapproved_flow_count", "open_flow_count")
    return added.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in sums],
        sorted_set("validation_status").alias("flow_validation_statuses"),
        sorted_set("exception_code").alias("flow_exception_codes"),
        F.max("flow_last_updated_timestamp").alias("flow_last_updated_timestamp"),
    )


def flow_reconciliation(meter_days: DataFrame, extract: DataFrame, *, per_meter_day: bool = False) -> DataFrame:
    """Meter-day volume against the flow computer's corrected volume.

    By default every meter-day row is kept, so on a day when a meter reported
    under two facilities both rows get the meter's flow-computer volume. With
    ``per_meter_day`` the meter-days are summed per meter and day first.
    """
    volumes = ("accepted_or_review_volume", "valid_volume")
    if per_meter_day:
        readings = meter_days.groupBy("meter_id", "production_date").agg(
            *[F.sum(c).alias("source_" + c) for c in volumes],
            *[F.sum(c).alias(c) for c in ("exception_reading_count", "valid_reading_count", "hourly_reading_count")],
        )
        readings = add_readiness(readings).select(
            "meter_id", "production_date", *["source_" + c for c in volumes],
            "exception_rate", "reporting_readiness_score",
        )
        flow = flow_daily(extract, ("meter_id", "production_date"))
    else:
        readings = meter_days.select(
            "meter_id", "reporting_facility_id", "master_facility_id", "master_facility_name",
            "master_region", "master_basin", "production_date",
            F.col("master_product").alias("product"),
            *[F.col(c).alias("source_" + c) for c in volumes],
            "exception_rate", "reporting_readiness_score",
        )
        flow = flow_daily(extract).drop("facility_id")
    return add_variance(
        readings.join(flow, ["meter_id", "production_date"], "left"),
        "flow_corrected_volume",
        "source_accepted_or_review_volume",
        "corrected_vs_source_delta",
        "corrected_vs_source_pct",
    )


def exception_fact(exceptions: DataFrame, as_of: str) -> DataFrame:
    """Exception detail with business names, workflow columns and age in days."""
    renames = {
        "master_facility_id": "facility_id", "master_facility_name": "facility_name",
        "master_region": "region", "master_basin": "basin",
    }
    kept = [F.col(c).alias(renames.get(c, c)) for c in exceptions.columns if not c.startswith("_")]
    return exceptions.select(
        *kept,
        F.lit("New").alias("exception_status"),
        F.lit(None).cast("string").alias("assigned_to"),
        F.lit(None).cast("string").alias("analyst_notes"),
        F.date_diff(F.lit(as_of).cast("date"), "production_date").alias("days_since_production_date"),
    )


def run_fact(runs: DataFrame) -> DataFrame:
    """Pipeline runs with duration, rates and outcome flags."""
    seconds = F.timestamp_diff("SECOND", F.col("started_at"), F.col("completed_at"))
    status = F.col("status")
    return runs.select([c for c in runs.columns if not c.startswith("_")]).withColumns(
        {
            "duration_seconds": seconds,
            "duration_minutes": F.round(seconds / 60.0, 2),
            "accepted_rate": safe_divide("rows_accepted", "rows_read"),
            "rejected_rate": safe_divide("rows_rejected", "rows_read"),
            "is_success": status.isin(*SUCCESS_STATUSES),
            "is_failed": status == "FAILED",
            "is_partial_load": status == "PARTIAL_SUCCESS",
            "has_errors": is_true(F.col("error_count") > 0),
        }
    )


def ticket_fact(tickets: DataFrame, as_of: str) -> DataFrame:
    """Support tickets with open flag, age in days and urgency."""
    closed = F.coalesce(F.col("closed_datetime").cast("date"), F.lit(as_of).cast("date"))
    return tickets.select([c for c in tickets.columns if not c.startswith("_")]).withColumns(
        {
            "is_open": F.col("closed_datetime").isNull(),
            "ticket_age_days": F.date_diff(closed, F.col("opened_datetime").cast("date")),
            "is_high_severity": F.upper("severity").isin(*URGENT_TICKET_SEVERITIES),
        }
    )


def source_day_profile(readings: DataFrame, accepted_codes: Sequence[str]) -> DataFrame:
    """Per meter, facility and day of the raw source: volume and counts of bad values."""
    volume, code = F.col("volume"), F.col("quality_code")
    return readings.groupBy("meter_id", "source_facility_id", "production_date").agg(
        F.coalesce(F.sum("volume"), F.lit(0.0)).alias("measured_volume"),
        F.count_if(volume.isNull()).alias("null_count"),
        F.count_if(volume == 0).alias("zero_count"),
        F.count_if(volume < 0).alias("negative_count"),
        F.count_if(code == "STALE").alias("stale_count"),
        F.count_if(~is_true(code.isin(*accepted_codes))).alias("bad_quality_count"),
    )


# Exception code of a source day: the first count that is not zero (fixed order).
SOURCE_DAY_CODES = (
    ("null_count", "NULL_VOLUME"),
    ("zero_count", "ZERO_VOLUME"),
    ("negative_count", "NEGATIVE_VOLUME"),
    ("stale_count", "STALE_READING"),
    ("bad_quality_count", "INVALID_QUALITY_CODE"),
)


def first_match_code(profile: DataFrame) -> DataFrame:
    """First matching exception code of a source day, its status and estimated flag."""
    code = F.coalesce(*[F.when(F.col(c) > 0, F.lit(name)) for c, name in SOURCE_DAY_CODES])
    estimated = (F.col("null_count") > 0) | (F.col("zero_count") > 0) | (F.col("stale_count") > 0)
    return profile.withColumns(
        {
            "exception_code": code,
            "validation_status": F.when(code.isNull(), "VALIDATED").otherwise("EXCEPTION"),
            "estimated_flag": F.when(estimated, "Y").otherwise("N"),
        }
    )
