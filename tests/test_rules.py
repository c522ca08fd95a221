from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from helpers import rows

from plumbline.operators import enrich, rules
from plumbline.operators.standardize import SPECS, spec_columns
from pyspark.sql import functions as F

READING = "raw_reading_id string, meter_id string, source_facility_id string, reading_timestamp timestamp_ntz, production_date date, gas_day date, poll_timestamp timestamp_ntz, source_system string, polling_platform string, volume double, pressure double, temperature double, quality_code string, raw_status string, load_timestamp timestamp_ntz, batch_id string"
NOON = datetime(2024, 1, 5, 12)


def reading(rid, **change):
    row = {
        "raw_reading_id": rid, "meter_id": "M1", "source_facility_id": "F1", "reading_timestamp": NOON, "production_date": date(2024, 1, 5),
        "gas_day": date(2024, 1, 5), "poll_timestamp": NOON, "source_system": "S", "polling_platform": "P", "volume": 10.0, "pressure": 1.0,
        "temperature": 1.0, "quality_code": "GOOD", "raw_status": "VALID", "load_timestamp": NOON, "batch_id": "B",
    }
    row.update(change)
    return tuple(row.values())


@pytest.fixture(scope="module")
def masters(spark):
    meters = spark.createDataFrame(
        [("M1", "F1", True), ("M2", "F1", False), ("M3", "F1", None), ("M4", None, True)], "meter_id string, facility_id string, is_active boolean"
    )
    meters = meters.select("*", *[F.lit(None).cast("string").alias(c) for c in enrich.METER_COLUMNS if c not in meters.columns])
    facilities = spark.createDataFrame([("F1", "North")], "facility_id string, facility_name string")
    facilities = facilities.select("*", *[F.lit(None).cast("string").alias(c) for c in enrich.FACILITY_COLUMNS if c not in facilities.columns])
    return meters, facilities


def events_frame(spark, items):
    schema = "event_id string, raw_reading_id string, event_ingested_at timestamp_ntz, payload_quality_code string, payload_raw_status string, payload_device_status string, payload_communication_status string"
    df = spark.createDataFrame(items, schema)
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in enrich.EVENT_COLUMNS if c not in df.columns])


def check(spark, masters, readings, events=()):
    df = spark.createDataFrame(readings, READING)
    enriched = enrich.enrich_readings(df, *masters, events_frame(spark, list(events)))
    return rules.check_readings(enriched, rules.RuleContext(as_of="2024-01-10"))


CASES = {
    "good": ({}, None, "VALID"),
    "null": ({"volume": None}, "NULL_VOLUME", "EXCEPTION"),
    "zero": ({"volume": 0.0}, "ZERO_VOLUME", "EXCEPTION"),
    "zero_null_active": ({"volume": 0.0, "meter_id": "M3"}, None, "VALID"),
    "negative": ({"volume": -1.0}, "NEGATIVE_VOLUME", "EXCEPTION"),
    "future": ({"production_date": date(2024, 1, 11)}, "FUTURE_DATE", "EXCEPTION"),
    "as_of_day": ({"production_date": date(2024, 1, 10)}, None, "VALID"),
    "unknown_meter": ({"meter_id": "M9"}, "INVALID_METER", "EXCEPTION"),
    "null_meter": ({"meter_id": None}, "INVALID_METER", "EXCEPTION"),
    "inactive": ({"meter_id": "M2"}, "INACTIVE_METER_REPORTING", "EXCEPTION"),
    "null_active": ({"meter_id": "M3"}, None, "VALID"),
    "mismatch": ({"source_facility_id": "F2"}, "FACILITY_MISMATCH", "EXCEPTION"),
    "null_facility": ({"source_facility_id": None}, None, "VALID"),
    "master_without_facility": ({"meter_id": "M4"}, None, "VALID"),
    "bad_code": ({"quality_code": "BAD"}, "INVALID_QUALITY_CODE", "EXCEPTION"),
    "null_code": ({"quality_code": None}, "INVALID_QUALITY_CODE", "EXCEPTION"),
    "exactly_24h": ({"load_timestamp": NOON + timedelta(hours=24)}, None, "VALID"),
    "over_24h": ({"load_timestamp": NOON + timedelta(hours=24, seconds=1)}, "LATE_ARRIVAL", "EXCEPTION"),
    "stale_code": ({"quality_code": "STALE"}, "STALE_READING", "EXCEPTION"),
    "stale_status": ({"raw_status": "STALE"}, "STALE_READING", "EXCEPTION"),
    "review_code": ({"quality_code": "ESTIMATED"}, None, "REVIEW"),
    "review_status": ({"raw_status": "REVIEW"}, None, "REVIEW"),
    "null_status": ({"raw_status": None}, None, "VALID"),
}


def test_each_rule_on_its_boundary(spark, masters):
    readings = []
    for i, (name, (change, _, _)) in enumerate(CASES.items()):
        # One hour per case, so that no two readings share a timestamp.
        shift = timedelta(hours=i)
        load = change.get("load_timestamp", NOON)
        readings.append(reading(name, **(change | {"reading_timestamp": NOON + shift, "load_timestamp": load + shift})))
    checked = check(spark, masters, readings)
    got = {r.raw_reading_id: (r.primary_exception_type, r.record_quality_status) for r in checked.collect()}
    assert got == {name: (kind, status) for name, (_, kind, status) in CASES.items()}
    flags = [r.flag for r in rules.READING_RULES]
    assert checked.where(" OR ".join(f"{f} IS NULL" for f in flags)).count() == 0


def test_all_copies_are_duplicates_but_null_keys_never(spark, masters):
    readings = [reading("a"), reading("b"), reading("c", reading_timestamp=None), reading("d", reading_timestamp=None), reading("e", meter_id="M3")]
    checked = check(spark, masters, readings)
    got = {r.raw_reading_id: (r.duplicate_meter_timestamp_count, r.dq_duplicate_meter_timestamp) for r in checked.collect()}
    assert got == {"a": (2, True), "b": (2, True), "c": (1, False), "d": (1, False), "e": (1, False)}


def test_latest_event_of_a_reading_counts_and_rows_stay(spark, masters):
    early, late = datetime(2024, 1, 6), datetime(2024, 1, 7)
    events = [
        ("e1", "a", early, "GOOD", "STALE", "OFFLINE", None), ("e2", "a", late, "GOOD", "VALID", "FAILED", None),
        ("e3", "b", early, "STALE", None, None, None), ("e4", None, early, "STALE", None, None, None),
        ("e5", "c", early, "GOOD", "VALID", "ONLINE", "DEGRADED"),
    ]
    readings = [reading(x, reading_timestamp=NOON + timedelta(hours=i), load_timestamp=NOON + timedelta(hours=i)) for i, x in enumerate("abc")]
    readings.append(reading(None, reading_timestamp=NOON + timedelta(hours=9), load_timestamp=NOON))
    checked = check(spark, masters, readings, events)
    got = rows(checked, "raw_reading_id", "event_id", "dq_stale_reading", "record_quality_status")
    assert got == [
        (None, None, False, "VALID"), ("a", "e2", False, "REVIEW"), ("b", "e3", True, "EXCEPTION"), ("c", "e5", False, "REVIEW"),
    ]


def test_exception_rows_one_per_failed_rule_with_stable_ids(spark, masters):
    checked = check(spark, masters, [reading("a", volume=-1.0, quality_code="X", meter_id="M2"), reading("b")])
    exceptions = rules.explode_exceptions(checked, detected_at="2024-01-10 00:00:00")
    got = rows(exceptions, "raw_reading_id", "rule_id", "exception_type", "severity", "primary_exception_type")
    assert got == [
        ("a", "DQ_ACTIVE_METER_ONLY", "INACTIVE_METER_REPORTING", "Medium/High", "NEGATIVE_VOLUME"),
        ("a", "DQ_QUALITY_CODE_VALID", "INVALID_QUALITY_CODE", "Medium", "NEGATIVE_VOLUME"),
        ("a", "DQ_VOLUME_NON_NEGATIVE", "NEGATIVE_VOLUME", "High", "NEGATIVE_VOLUME"),
    ]
    again = rules.explode_exceptions(checked, detected_at="2024-01-10 00:00:00")
    assert rows(exceptions, "exception_id") == rows(again, "exception_id")
    assert checked.where("dq_exception_count = 3").count() == 1
    assert rows(rules.split_valid(checked), "raw_reading_id") == [("b",)]


def test_catalogue_join_keeps_active_rules_only(frame):
    exceptions = frame([("e1", "R1"), ("e2", "R2"), ("e3", "R3")], "exception_id string, rule_id string")
    catalogue = frame([("R1", "One", "Silver", "Team", True), ("R2", "Two", "Silver", "Team", False), ("R3", "Three", "Gold", "Team", None)],
                      "rule_id string, rule_name string, layer string, owner_team string, is_active boolean")
    assert rows(rules.join_rule_catalogue(exceptions, catalogue), "exception_id", "rule_name") == [("e1", "One")]


def test_declared_rules_on_other_tables(frame):
    ctx = rules.RuleContext(as_of="2024-01-10", max_rejected_rows=10)
    flow = frame([("a", True, "CLOSED", 100.0, 104.0), ("b", False, "CLOSED", 100.0, 106.0), ("c", True, "OPEN", 0.0, 1.0), ("d", None, None, None, 1.0)],
                 "id string, is_approved boolean, close_status string, measured_volume double, corrected_volume double")
    got = rows(rules.add_flags(flow, rules.FLOW_RULES, ctx), "id", "dq_unapproved_record", "dq_correction_variance")
    assert got == [("a", False, False), ("b", True, True), ("c", True, True), ("d", True, False)]
    runs = frame([("a", "SUCCESS", 10), ("b", "RETRY_SUCCESS", 11), ("c", "FAILED", None), ("d", None, 0)], "id string, status string, rows_rejected long")
    got = rows(rules.add_flags(runs, rules.RUN_RULES, ctx), "id", "dq_run_not_successful", "dq_rejected_rows")
    assert got == [("a", False, False), ("b", False, True), ("c", True, False), ("d", True, False)]


def test_rules_run_on_other_column_names(frame):
    ctx = rules.RuleContext(as_of="2024-01-10", columns={"volume": "amount"})
    df = frame([("a", -1.0), ("b", 1.0)], "id string, amount double")
    negative = [r for r in rules.READING_RULES if r.exception_type == "NEGATIVE_VOLUME"]
    assert rows(rules.failures_only(df, negative, ctx), "id") == [("a",)]


def test_scenario_bounds_are_inclusive(frame):
    scenarios = frame([("S1", "M1; M2 ;", datetime(2024, 1, 1), datetime(2024, 1, 2))], "scenario_id string, affected_meter_ids string, start_datetime timestamp_ntz, end_datetime timestamp_ntz")
    readings = frame([("a", "M1", datetime(2024, 1, 1)), ("b", "M2", datetime(2024, 1, 2)), ("c", "M1", datetime(2024, 1, 2, 0, 0, 1)), ("d", "M3", datetime(2024, 1, 1)), ("e", "M1", None)],
                     "id string, meter_id string, reading_timestamp timestamp_ntz")
    assert rows(enrich.tag_scenarios(readings, scenarios), "id", "scenario_id") == [("a", "S1"), ("b", "S1")]


def test_calendar_is_dense(frame):
    entities = frame([("M1",), ("M2",)], "meter_id string")
    facts = frame([("M1", date(2024, 1, 2), 5.0), ("M9", date(2024, 1, 1), 1.0)], "meter_id string, production_date date, v double")
    dense = enrich.densify_calendar(entities, facts, ["meter_id"], "2024-01-01", "2024-01-03", ["v"])
    assert rows(dense, "meter_id", "production_date", "v") == sorted(
        (m, date(2024, 1, d), 5.0 if (m, d) == ("M1", 2) else 0.0) for m in ("M1", "M2") for d in (1, 2, 3)
    )


def test_specs_and_reading_schema_agree():
    names = [c.rpartition(" AS ")[2].strip("`") for c in spec_columns(SPECS["raw_polling_readings"])]
    assert names == [part.strip().split(" ")[0] for part in READING.split(",")]
