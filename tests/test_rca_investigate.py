from __future__ import annotations

import json
from datetime import date

from helpers import rows

from plumbline.operators import investigate, rca

CONTEXT = "exception_group_id string, production_date date, facility_id string, facility_name string, region string, basin string, exception_type string, severity string, exception_count long, affected_reading_count long, affected_meter_count long, source_systems_text string, polling_platforms_text string, device_statuses_text string, communication_statuses_text string, signal_qualities_text string, scenario_id string, scenario_name string, expected_root_cause string, recommended_next_step string, rca_summary_seed string"


def group(gid, kind, device="", comms="", signal="", **change):
    row = dict(
        exception_group_id=gid, production_date=date(2024, 1, 5), facility_id="F1", facility_name="North", region="R", basin="B", exception_type=kind, severity="High",
        exception_count=1234, affected_reading_count=1200, affected_meter_count=4, source_systems_text="S", polling_platforms_text="P", device_statuses_text=device,
        communication_statuses_text=comms, signal_qualities_text=signal, scenario_id=None, scenario_name=None, expected_root_cause=None, recommended_next_step=None, rca_summary_seed="seed",
    )
    row.update(change)
    return tuple(row.values())


def test_likely_layer_order(frame):
    df = frame([
        group("1", "ZERO_VOLUME", device="NO_SIGNAL"), group("2", "LATE_ARRIVAL", comms="OK, FAILED"), group("3", "INVALID_METER", signal="unknown"),
        group("4", "INVALID_METER"), group("5", "DUPLICATE_READING"), group("6", "LATE_ARRIVAL"), group("7", "NULL_VOLUME"), group("8", None),
    ], CONTEXT)
    for status, default in (("SUCCESS", rca.DEFAULT_LAYER), ("partial_success", rca.PIPELINE_LAYER)):
        health = frame([("p", status), ("q", None)], "pipeline_name string, latest_status string")
        got = [r.likely_layer for r in rca.explain_groups(df, health).orderBy("exception_group_id").collect()]
        assert got == [
            "Source / polling platform", "Source / device communication", "Polling platform / source data freshness", "Master/reference data",
            "Ingestion / retry / duplicate handling", "Pipeline timing / schedule", default, default,
        ]


def test_checks_cautions_and_summary(frame):
    health = frame([("p", "SUCCESS")], "pipeline_name string, latest_status string")
    df = frame([
        group("1", "FUTURE_DATE", scenario_id="S", expected_root_cause="bad window", recommended_next_step="look"),
        group("2", "NULL_VOLUME", facility_id=None, exception_count=None), group("3", "FACILITY_MISMATCH", signal="STALE"),
    ], CONTEXT)
    one, two, three = rca.explain_groups(df, health).orderBy("exception_group_id").collect()
    assert len(one.suggested_checks) == 6 and one.suggested_checks[3].startswith("Confirm whether production_date")
    assert two.suggested_checks == list(rca.DEFAULT_CHECKS)
    assert len(three.suggested_checks) == 6 and len(set(three.suggested_checks)) == 6
    assert len(one.cautions) == 3 and len(three.cautions) == 4
    assert one.rca_summary_text == (
        "On 2024-01-05, facility F1 (North) has 1,234 exception records of type FUTURE_DATE with severity High. "
        "The affected set includes approximately 1,200 readings across 4 meter(s). Device context shows N/A; communication context shows N/A; "
        "signal quality context shows N/A. The first layer to check should be: Source date mapping / validation rule. "
        "Known scenario/root-cause context suggests: bad window. Recommended next step: look"
    )
    assert "facility N/A (North) has 0 exception records" in two.rca_summary_text


EXC = "exception_id string, facility_id string, exception_type string, production_date date, event_scenario_id string, rule_id string, raw_reading_id string, meter_id string, quality_code string, raw_status string, event_device_status string, event_communication_status string, event_signal_quality string"


def exc(eid, facility="F1", kind="LATE_ARRIVAL", scenario=None, meter="M1"):
    return (eid, facility, kind, date(2024, 1, 5), scenario, "R", "r", meter, "GOOD", "VALID", None, None, None)


def test_related_context_prefers_scenario_then_falls_back(frame):
    context = frame([
        group("g1", "LATE_ARRIVAL", scenario_id="S1", scenario_name="One", production_date=date(2024, 1, 1)),
        group("g2", "LATE_ARRIVAL", scenario_id="S1", scenario_name="One", production_date=date(2024, 1, 3), facility_id="F2"),
        group("g3", "STALE_READING", facility_id="F3"),
    ], CONTEXT)
    exceptions = frame([exc("a", scenario="S1"), exc("b", scenario="S9"), exc("c", facility="F3", kind="STALE_READING"), exc("d", facility="F9"), exc("e", facility=None)], EXC)
    got = rows(investigate.related_context(exceptions, context), "exception_id", "related_by", "related_count", "related_group_id")
    assert got == [("a", "scenario", 2, "g2"), ("b", "facility_and_type", 1, "g1"), ("c", "facility_and_type", 1, "g3"), ("d", None, 0, None), ("e", None, 0, None)]


def test_related_exceptions_first_n_null_safe(frame):
    context = frame([group("g1", "LATE_ARRIVAL"), group("g2", "LATE_ARRIVAL", facility_id=None)], CONTEXT)
    exceptions = frame([exc(f"x{i}", meter=f"M{9 - i}") for i in range(5)] + [exc("n1", facility=None), exc("z", facility="F7")], EXC)
    got = rows(investigate.related_exceptions(context, exceptions, 2), "exception_group_id", "position", "exception_id")
    assert got == [("g1", 1, "x4"), ("g1", 2, "x3"), ("g2", 1, "n1")]


def test_packet_holds_bounded_samples_and_context(frame):
    context = frame([group("g1", "LATE_ARRIVAL"), group("g2", "NULL_VOLUME")], CONTEXT)
    exceptions = frame([exc(f"x{i}") for i in range(9)], EXC)
    health = frame([("q", "SUCCESS", 1, 1, 0, 1, 0, 0), ("p", "FAILED", 1, 0, 1, 1, 1, 0)], "pipeline_name string, latest_status string, latest_rows_read long, latest_rows_accepted long, latest_rows_rejected long, run_count long, failed_count long, partial_load_count long")
    stages = frame([(2, "b", "o2", 5, "m", "n"), (1, "a", "o1", 5, "m", "n")], "stage_order int, layer string, object_name string, row_count long, metric_type string, notes string")
    first, second = rca.rca_packets(context, exceptions, health, stages, 5).orderBy("exception_group_id").collect()
    assert [r["exception_id"] for r in json.loads(first.sample_rows_json)] == ["x0", "x1", "x2", "x3", "x4"]
    assert json.loads(second.sample_rows_json) == []
    assert [s["stage_order"] for s in json.loads(first.checkpoints_json)] == [1, 2]
    assert [p["pipeline_name"] for p in json.loads(first.pipelines_json)] == ["p", "q"]
    assert json.loads(first.evidence_json)["device_statuses_text"] == "N/A"


def test_filter_search_and_context(frame):
    df = frame([("a", "High", "N.1", date(2024, 1, 1)), ("b", None, "n21", date(2024, 1, 2)), ("c", "Low", None, None)], "exception_id string, severity string, meter_id string, production_date date")
    assert rows(investigate.faceted_filter(df, {"severity": ["High", "Low"], "none": ["x"]}), "exception_id") == [("a",), ("c",)]
    assert rows(investigate.faceted_filter(df, {"severity": []}, start="2024-01-01", end="2024-01-02"), "exception_id") == [("a",), ("b",)]
    assert rows(investigate.text_search(df, "n.", ["meter_id"]), "exception_id") == [("a",)]
    assert investigate.text_search(df, "", ["meter_id"]).count() == 3
    context = json.loads(investigate.exception_context(df, "b").first().context_json)
    assert context == {"exception_id": "b", "production_date": "2024-01-02", "meter_id": "n21"}


def test_rca_context_joins_known_scenarios(frame):
    summary = frame([("g", date(2024, 1, 1), "F1", "n", "r", "b", "LATE_ARRIVAL", "Medium", 3, 3, 1, ["S"], [], ["A", "B"], [], [])],
                    "exception_group_id string, production_date date, facility_id string, facility_name string, region string, basin string, exception_type string, severity string, exception_count long, affected_reading_count long, affected_meter_count long, source_systems array<string>, polling_platforms array<string>, device_statuses array<string>, communication_statuses array<string>, signal_qualities array<string>")
    scenarios = frame([("S4", "Late", "d", "F1", "LATE_ARRIVAL", "cause", None)], "scenario_id string, scenario_name string, description string, affected_facility_id string, expected_exception_type string, expected_root_cause string, recommended_next_step string")
    row = rca.rca_context(summary, scenarios).first()
    assert row.scenario_id == "S4" and row.device_statuses_text == "A, B"
    assert row.rca_summary_seed == (
        "On 2024-01-01 facility F1 has 3 exception records of type LATE_ARRIVAL with severity Medium . Device context: A, B "
        ". Communication context:  . Suggested next step: review source data, mapping, timing, and recent pipeline runs."
    )
