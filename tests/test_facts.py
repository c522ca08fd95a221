from __future__ import annotations

from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from plumbline.operators import facts, rules, summaries
from plumbline.plans import views


@pytest.fixture(scope="module")
def checked(spark):
    """Four readings of one meter-day and one of another facility's day."""
    text = ["meter_id", "master_meter_id", "source_facility_id", "master_facility_id", *[k for k in facts.METER_DAY_KEYS if k.startswith("master_") and k not in ("master_meter_id", "master_facility_id", "master_is_custody_transfer")]]
    base = {c: "x" for c in text} | {"source_system": "S", "polling_platform": "P", "batch_id": "B1", "raw_status": "VALID", "quality_code": "GOOD", "primary_exception_type": None, "event_device_status": None, "event_communication_status": None, "event_signal_quality": None}
    readings = [
        base | {"raw_reading_id": "1", "status": "VALID", "volume": 10.0, "pressure": 1.0},
        base | {"raw_reading_id": "2", "status": "REVIEW", "volume": 5.0, "pressure": 3.0, "quality_code": "ESTIMATED", "batch_id": "B2"},
        base | {"raw_reading_id": "3", "status": "EXCEPTION", "volume": -4.0, "pressure": None, "primary_exception_type": "NEGATIVE_VOLUME"},
        base | {"raw_reading_id": "4", "status": "EXCEPTION", "volume": None, "pressure": None, "primary_exception_type": "NULL_VOLUME"},
        base | {"raw_reading_id": "5", "status": "VALID", "volume": 7.0, "pressure": 8.0, "meter_id": "y", "master_facility_id": None, "source_facility_id": "x"},
    ]
    schema = ", ".join(f"{c} {'double' if c in ('volume', 'pressure') else 'string'}" for c in readings[0])
    df = spark.createDataFrame([tuple(r[c] for c in readings[0]) for r in readings], schema)
    when = F.lit("2024-01-05 12:00:00").cast("timestamp_ntz")
    flags = {r.flag: F.col("primary_exception_type").eqNullSafe(r.exception_type) for r in rules.READING_RULES}
    return df.withColumns(
        {"record_quality_status": F.col("status"), "temperature": F.lit(1.0), "master_is_custody_transfer": F.lit(None).cast("boolean"),
         "production_date": F.lit("2024-01-05").cast("date"), "gas_day": F.lit("2024-01-05").cast("date"), "reading_timestamp": when,
         "poll_timestamp": when, "load_timestamp": when, "dq_exception_count": F.when(F.col("status") == "EXCEPTION", 1).otherwise(0)} | flags
    )


def test_meter_day_measures(checked):
    day = facts.meter_daily(checked).where("meter_id = 'x'").first()
    assert (day.hourly_reading_count, day.valid_reading_count, day.review_reading_count, day.exception_reading_count) == (4, 1, 1, 2)
    assert (day.valid_volume, day.accepted_or_review_volume, day.all_nonnegative_volume, day.raw_volume_sum) == (10.0, 15.0, 15.0, 11.0)
    assert (day.avg_pressure, day.batch_count, day.raw_reading_count) == (2.0, 2, 4)
    assert (day.null_volume_count, day.negative_volume_count, day.zero_volume_count) == (1, 1, 0)
    assert (day.exception_types, day.quality_codes, day.event_device_statuses) == (["NEGATIVE_VOLUME", "NULL_VOLUME"], ["ESTIMATED", "GOOD"], [])
    assert (day.exception_rate, day.valid_record_rate, day.reporting_readiness_score, day.has_data_quality_issue) == (0.5, 0.25, 50.0, True)


def test_facility_day_averages_meters_not_readings(checked):
    day = facts.facility_daily(facts.meter_daily(checked)).first()
    assert (day.meter_count, day.hourly_reading_count, day.avg_pressure) == (2, 5, 5.0)
    assert day.reporting_readiness_score == 60.0


def test_nomination_join_never_matches_null_product(frame):
    days = frame([("F1", date(2024, 1, 1), "GAS", 110.0), ("F1", date(2024, 1, 1), None, 5.0), ("F2", date(2024, 1, 1), "GAS", 5.0)],
                 "reporting_facility_id string, production_date date, master_product string, accepted_or_review_volume double")
    days = days.selectExpr("*", "'n' master_facility_name", "'r' master_region", "'b' master_basin", "'s' master_state", "0D valid_volume", "0D exception_rate", "100D reporting_readiness_score", "false has_data_quality_issue")
    nominations = frame([("n1", "F1", date(2024, 1, 1), "GAS", 60.0, "c", "k", "ACTIVE"), ("n2", "F1", date(2024, 1, 1), "GAS", 40.0, "c", "j", "ACTIVE"), ("n3", "F2", date(2024, 1, 1), "GAS", 0.0, None, None, None), ("n4", "F9", date(2024, 1, 1), "GAS", 1.0, None, None, None)],
                        "nomination_id string, facility_id string, production_date date, product string, nominated_volume double, customer_group string, contract_type string, status string")
    got = rows(facts.actual_vs_nominated(days, nominations), "facility_id", "product", "nominated_volume", "actual_vs_nominated_delta", "actual_vs_nominated_pct", "nomination_count")
    assert got == [("F1", None, None, None, None, None), ("F1", "GAS", 100.0, 10.0, 0.1, 2), ("F2", "GAS", 0.0, 5.0, None, 1)]


def test_runs_tickets_and_health(frame):
    t = datetime(2024, 1, 1)
    runs = frame(
        [("r1", "p", t, datetime(2024, 1, 1, 0, 1, 30), "SUCCESS", 100, 90, 10, 0), ("r2", "p", t, None, "FAILED", 0, 0, 0, 2), ("r3", "p", None, None, "PARTIAL_SUCCESS", 10, 5, 5, None), ("r4", "q", t, t, None, None, None, None, None)],
        "run_id string, pipeline_name string, started_at timestamp_ntz, completed_at timestamp_ntz, status string, rows_read long, rows_accepted long, rows_rejected long, error_count long",
    ).withColumn("error_message", F.lit(None).cast("string"))
    fact = facts.run_fact(runs)
    got = rows(fact, "run_id", "duration_seconds", "duration_minutes", "accepted_rate", "is_success", "has_errors")
    assert got == [("r1", 90, 1.5, 0.9, True, False), ("r2", None, None, None, False, True), ("r3", None, None, 0.5, False, False), ("r4", 0, 0.0, None, None, False)]
    health = {r.pipeline_name: r for r in summaries.pipeline_health(fact).collect()}
    p = health["p"]
    assert (p.latest_run_id, p.latest_status, p.run_count, p.failed_count, p.success_count, p.total_rows_read) == ("r2", "FAILED", 3, 1, 1, 110)
    assert p.overall_rejected_rate == pytest.approx(15 / 110) and p.failure_rate == pytest.approx(1 / 3)
    assert rows(summaries.latest_run(fact), "pipeline_name", "latest_run_id") == [("p", "r2"), ("q", "r4")]

    tickets = frame([("t1", t, datetime(2024, 1, 4, 1), "sev1"), ("t2", t, None, "Low"), ("t3", t, None, None)], "ticket_id string, opened_datetime timestamp_ntz, closed_datetime timestamp_ntz, severity string")
    got = rows(facts.ticket_fact(tickets, "2024-01-11"), "ticket_id", "is_open", "ticket_age_days", "is_high_severity")
    assert got == [("t1", False, 3, True), ("t2", True, 10, False), ("t3", True, 10, None)]


def test_source_day_first_match(frame):
    readings = frame([("m", "f", date(2024, 1, 1), None, "GOOD"), ("m", "f", date(2024, 1, 1), 0.0, "GOOD"), ("m", "f", date(2024, 1, 2), -1.0, "STALE"), ("m", "f", date(2024, 1, 3), 1.0, None), ("m", "f", date(2024, 1, 4), 1.0, "GOOD")],
                     "meter_id string, source_facility_id string, production_date date, volume double, quality_code string")
    coded = facts.first_match_code(facts.source_day_profile(readings, rules.ACCEPTED_QUALITY_CODES))
    assert rows(coded, "production_date", "exception_code", "validation_status", "estimated_flag") == [
        (date(2024, 1, 1), "NULL_VOLUME", "EXCEPTION", "Y"), (date(2024, 1, 2), "NEGATIVE_VOLUME", "EXCEPTION", "Y"),
        (date(2024, 1, 3), "INVALID_QUALITY_CODE", "EXCEPTION", "N"), (date(2024, 1, 4), None, "VALIDATED", "N"),
    ]


def test_severity_rank(frame):
    df = frame([("Medium/High",), ("high",), ("Medium",), ("Low",), (None,)], "severity string")
    assert [r[0] for r in df.select(summaries.severity_rank()).collect()] == [1, 1, 2, 3, 3]


def test_reliability_overview_ignores_missing_values(frame):
    health = frame([("SUCCESS",), ("RETRY_SUCCESS",), (None,)], "latest_status string")
    exceptions = frame([("Low",), ("Medium",), ("Medium/High",), (None,)], "severity string")
    stages = frame([(1,), (None,)], "row_count long")
    assert rows(views.reliability_overview(health, exceptions, stages)) == [
        ("data_quality_exceptions", 4, 2, 1), ("pipeline_health", 3, 1, 1), ("source_to_target_reconciliation", 2, 1, 1),
    ]


def test_distributions_top_and_options(frame):
    df = frame([("a", "x"), ("a", None), ("b", " x "), (None, "")], "p string, q string")
    assert rows(summaries.distributions(df, ["p"])) == [("p", None, 1), ("p", "a", 2), ("p", "b", 1)]
    assert [tuple(r) for r in summaries.filter_options(df, ["p", "q"]).collect()] == [("p", "a"), ("p", "b"), ("q", "x")]
    assert [tuple(r) for r in summaries.top_groups(df, ["p"], 2).collect()] == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in summaries.ordered(df.dropna(), {"p": "desc", "q": "asc"}).collect()] == [("b", " x "), ("a", "x")]
    labels = summaries.drilldown_labels(df.withColumn("i", F.lit("1")), "i", ["p", "q"], 10)
    assert ("1", "UNKNOWN | ") in rows(labels) and ("1", "a | UNKNOWN") in rows(labels)
