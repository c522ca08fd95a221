from __future__ import annotations

from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from plumbline.operators import rule_table, rules, summaries

CTX = rules.RuleContext(as_of="2024-01-10")
COLUMNS = "rule_id string, rule_name string, layer string, field_name string, rule_type string, condition_description string, severity string, business_reason string, owner_team string, is_active boolean"


def row(rule_id, kind="check", condition="", field="", *, layer="Silver", severity=None, active=True):
    return (rule_id, f"Name of {rule_id}", layer, field, kind, condition, severity, "Because.", "Team", active)


@pytest.fixture(scope="module")
def values(spark):
    return spark.createDataFrame(
        [
            (1, 10.0, "GOOD", "a", date(2024, 1, 5), datetime(2024, 1, 5), datetime(2024, 1, 5, 3), 1),
            (2, -1.0, "BAD", None, date(2024, 1, 11), datetime(2024, 1, 5), datetime(2024, 1, 6, 1), 3),
            (3, None, None, "c", None, None, None, 2),
        ],
        "id int, volume double, quality_code string, batch_id string, production_date date, reading_timestamp timestamp_ntz, load_timestamp timestamp_ntz, duplicate_meter_timestamp_count long",
    )


@pytest.mark.parametrize(
    ("kind", "field", "condition", "failing"),
    [
        ("range", "volume", "volume >= 0", {2}),
        ("range", "volume", "volume < 10.0", {1}),
        ("range", "volume", "volume != -1", {2}),
        ("date_window", "production_date", "production_date <= current_date", {2}),
        ("date_window", "production_date", "production_date < 2024-01-05", {1, 2}),
        ("timeliness", "load_timestamp", "load_timestamp <= reading_timestamp + 24 hours", {2}),
        ("accepted_values", "quality_code", "quality_code in GOOD, STALE", {2, 3}),
        ("status", "quality_code", "quality_code in BAD", {1, 3}),
        ("not_null", "batch_id,volume", "batch_id IS NOT NULL", {2, 3}),
        ("unique_grain", "meter_id,reading_timestamp", "COUNT(*) by meter_id + reading_timestamp <= 2", {2}),
    ],
)
def test_conditions(values, kind, field, condition, failing):
    fails = rule_table.predicate(kind, field, condition)
    got = values.where(rules.is_true(fails(CTX))).select("id").collect()
    assert {r.id for r in got} == failing


@pytest.mark.parametrize(
    ("kind", "condition"),
    [("conditional", "volume = 0 for active meter requires review"), ("range", "volume >= 0; drop"), ("timeliness", "load_timestamp <= expected_report_refresh_time"),
     ("threshold", "rows_rejected <= configured threshold"), ("unique_grain", "COUNT(*) by other + grain <= 1"), ("accepted_values", ""), ("not_null", "")],
)
def test_conditions_that_are_not_understood(kind, condition):
    assert rule_table.predicate(kind, "", condition) is None


def test_catalogue_switches_tightens_and_adds(spark, values):
    listed = [
        row("DQ_NULL_VOLUME", active=False), row("DQ_QUALITY_CODE_VALID", "accepted_values", "quality_code in GOOD, BAD", severity="High"),
        row("DQ_VOLUME_NON_NEGATIVE"), row("DQ_SMALL_VOLUME", "range", "volume >= 11", severity="Low"),
        row("DQ_ODD", "conditional", "who knows"), row("DQ_NOT_YET", "range", "volume > 0", active=False), row("DQ_ELSEWHERE", "range", "volume > 0", layer="Gold"),
        row(None),
    ]
    found = rule_table.compile_rules(spark.createDataFrame(listed, COLUMNS))
    assert dict(found.outcome) == {
        "DQ_NULL_VOLUME": "OFF", "DQ_QUALITY_CODE_VALID": "COMPILED", "DQ_VOLUME_NON_NEGATIVE": "BUILT_IN", "DQ_SMALL_VOLUME": "COMPILED",
        "DQ_ODD": "UNREAD", "DQ_NOT_YET": "OFF",
    }
    assert len(found.rules) == len(rules.READING_RULES) + 1 and found.order[-1] == "SMALL_VOLUME"
    wanted = {"DQ_NULL_VOLUME", "DQ_QUALITY_CODE_VALID", "DQ_VOLUME_NON_NEGATIVE", "DQ_SMALL_VOLUME"}
    in_force = [r for r in found.rules if r.rule_id in wanted]
    flagged = rules.add_flags(values, in_force, CTX).withColumn("primary_exception_type", rules.primary_type(in_force, found.order))
    timed = flagged.withColumns({"raw_reading_id": F.col("id").cast("string"), "meter_id": F.lit("M")})
    exceptions = rules.explode_exceptions(timed, in_force, detected_at="2024-02-01 00:00:00")
    assert rows(exceptions, "raw_reading_id", "rule_id", "severity", "primary_exception_type") == [
        ("1", "DQ_SMALL_VOLUME", "Low", "SMALL_VOLUME"), ("2", "DQ_SMALL_VOLUME", "Low", "NEGATIVE_VOLUME"),
        ("2", "DQ_VOLUME_NON_NEGATIVE", "High", "NEGATIVE_VOLUME"), ("3", "DQ_QUALITY_CODE_VALID", "High", "INVALID_QUALITY_CODE"),
    ]


def test_an_empty_catalogue_leaves_the_built_in_rules(spark):
    found = rule_table.compile_rules(spark.createDataFrame([], COLUMNS))
    assert found.rules == rules.READING_RULES and not found.outcome and found.order == rules.PRIMARY_TYPE_ORDER


def test_too_large_a_catalogue_is_refused(spark, monkeypatch):
    monkeypatch.setattr(rule_table, "MOST_RULES", 1)
    with pytest.raises(ValueError, match="more than 1"):
        rule_table.compile_rules(spark.createDataFrame([row("a"), row("b")], COLUMNS))


def test_rule_summary_names_its_rules(spark):
    exceptions = spark.createDataFrame(
        [("DQ_A", "A", "High", "M1", "F1", date(2024, 1, 1)), ("DQ_A", "A", "High", "M2", "F1", date(2024, 1, 2)), ("DQ_B", "B", "Low", "M1", None, None)],
        "rule_id string, exception_type string, severity string, meter_id string, master_facility_id string, production_date date",
    )
    named = summaries.ranked_rule_summary(exceptions, spark.createDataFrame([row("DQ_A"), row("DQ_A"), row("DQ_C")], COLUMNS))
    assert rows(named, "rule_id", "exception_count", "rule_name", "layer", "owner_team") == [("DQ_A", 2, "Name of DQ_A", "Silver", "Team"), ("DQ_B", 1, None, None, None)]
