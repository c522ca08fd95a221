"""What the readings' plans compute per row, and the odd texts their parsers meet."""

from __future__ import annotations

import re

import pytest
from helpers import rows
from pyspark.sql import functions as F

from plumbline.functions.clean import KINDS, TEXT
from plumbline.operators.enrich import latest_event_context
from plumbline.operators.facts import flow_daily
from plumbline.plans.bindings import Domain

SMALL = "/root/testdata/sf0.001"
WHOLE_KINDS = {
    "date": f"try_cast({TEXT} AS date)",
    "timestamp": f"CASE WHEN {TEXT} RLIKE '[0-9]:[0-9.:]+ *([zZ]|[+-][0-9:]+)$' THEN cast(to_utc_timestamp(try_cast({TEXT} AS timestamp), current_timezone()) AS timestamp_ntz) ELSE try_cast({TEXT} AS timestamp_ntz) END",
}
ODD_TEXTS = (
    None, "", "  ", "\t", "\n", " 2024-01-02 ", "\t2024-01-02\n", "2024-1-2", "2024", "2024-01", "2024-01-02T03", "2024-01-02 03:04:05", " 2024-01-02T03:04:05.123456 ",
    "2024-01-02T03:04:05Z", "2024-01-02T03:04:05 z  ", "2024-01-02T03:04:05+02:00", "2024-01-02T03:04:05-0530", "2024-01-02T03:04:05-05:30 ", "2024-01-02T03:04:05Z\n",
    "2024-01-02T03:04:05Z \n", "2024-01-02T03:04:05Z\n ", "2024-01-02T03:04:05 Europe/Berlin", "2024-02-30", "2024-13-45", "n/a", "03:04:05", "T03:04", "+12024-01-02", "-0001-01-01", "2024-01-02T24:00:00",
)


@pytest.fixture
def whole_plans(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    yield lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")


@pytest.mark.parametrize("kind", sorted(WHOLE_KINDS))
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_are_read_as_if_trimmed(spark, frame, kind, zone):
    kept = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = frame([(t,) for t in ODD_TEXTS], "x string")
        got = df.selectExpr("x", f"{KINDS[kind].format('x')} AS got", f"{WHOLE_KINDS[kind].format('x')} AS want")
        assert rows(got.where("NOT got <=> want")) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)


def test_readings_format_their_time_once(spark, whole_plans):
    plan = whole_plans(Domain(spark, SMALL).raw_readings)
    assert len(re.findall(r"date_format\(cast\(ts#", plan)) == 1


def test_time_text_is_not_trimmed_for_every_use(spark, whole_plans):
    plan = whole_plans(Domain(spark, SMALL).readings.select("reading_timestamp"))
    assert plan.count("trim(") == 1


def test_meter_day_measures_carry_no_unread_event_column(spark, whole_plans):
    plan = whole_plans(Domain(spark, SMALL).facility_days)
    assert "payload_quality_code" in plan
    assert "payload_retry_count" not in plan and "payload_battery_status" not in plan


def test_latest_context_of_equal_events_is_the_greater(frame):
    events = frame(
        [("R1", "E1", "2024-01-01", None), ("R1", "E1", "2024-01-01", "A"), ("R1", "E1", "2024-01-01", "B"), ("R1", "E0", "2024-01-01", "Z"),
         ("R2", "E9", None, "A"), ("R2", "E1", "2024-01-01", None), (None, "E5", "2024-01-01", "A")],
        "raw_reading_id string, event_id string, event_ingested_at string, payload_raw_status string",
    )
    for order in (F.asc("payload_raw_status"), F.desc("payload_raw_status")):
        got = latest_event_context(events.orderBy(order))
        assert rows(got, "raw_reading_id", "event_id", "event_raw_status") == [("R1", "E1", "B"), ("R2", "E1", None)]


def test_flow_sets_are_collected_of_added_up_rows(frame, whole_plans):
    records = frame(
        [("M1", "F1", "d1", 1.0, 2.0, True, "CLOSED", "A", None, "t1"), ("M1", "F1", "d1", 4.0, None, False, "OPEN", "B", "X", "t3"),
         ("M1", "F1", "d1", 8.0, 1.0, None, None, "A", "X", "t2"), (None, "F1", "d1", None, None, False, "OPEN", None, None, None)],
        "meter_id string, facility_id string, production_date string, measured_volume double, corrected_volume double, is_approved boolean, "
        "close_status string, validation_status string, exception_code string, last_updated_timestamp string",
    )
    got = flow_daily(records)
    assert rows(got) == [(None, "F1", "d1", None, None, 1, 1, 1, [], [], None), ("M1", "F1", "d1", 13.0, 3.0, 3, 1, 1, ["A", "B"], ["X"], "t3")]
    sets, added = [line for line in whole_plans(got).splitlines() if "Aggregate [" in line]
    assert "collect_set" in sets and "collect_set" not in added
