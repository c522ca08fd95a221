from __future__ import annotations

import json
from datetime import datetime

from helpers import rows
from pyspark.sql import functions as F

from plumbline.operators import events, state


def test_lenient_flatten_keeps_the_raw_document(frame):
    lines = frame(
        [('{"event_id":"e1","raw_reading_id":"r1","payload":{"volume":"bad","pressure":1.5,"retry_count":2,"quality_code":"GOOD"},"seed_batch_id":"b1"}',),
         ('{"event_id":"e2","payload":null}',), ("not json",)], "value string")
    docs = events.parse_documents(lines)
    flat = events.flatten_documents(docs).orderBy("event_id").collect()
    by_id = {r.event_id: r for r in flat}
    assert len(flat[0]) == 35
    assert (by_id["e1"].payload_volume, by_id["e1"].payload_pressure, by_id["e1"].payload_retry_count) == (None, 1.5, 2)
    stored = json.loads(by_id["e1"].raw_document_json)
    assert stored["payload"]["volume"] == "bad"
    assert by_id["e1"].raw_document_json == next(r.value for r in lines.collect() if "e1" in r.value)
    rebuilt = json.loads(next(r for r in events.flatten_documents(docs.drop("_raw_text")).collect() if r.event_id == "e1").raw_document_json)
    assert list(rebuilt) == sorted(rebuilt) and list(rebuilt["payload"]) == sorted(rebuilt["payload"])
    assert by_id["e2"].payload_quality_code is None and None in by_id


def test_event_context_precedence(frame):
    cases = [
        (1, "NO_SIGNAL", "STALE", 0.0, ("NO_SIGNAL", "FAILED", "LOW", "COMMUNICATION_FAILURE", "NONE", 0)),
        (2, "VALID", "STALE", 1.0, ("ONLINE", "STALE", "OK", "STALE_TAG", "STALE", 0)),
        (3, "DUPLICATE_RETRY", "GOOD", 1.0, ("ONLINE", "RETRY_DUPLICATE", "OK", "DUPLICATE_RETRY", "GOOD", 1)),
        (4, "NULL_VOLUME", None, None, ("ONLINE", "NORMAL", "OK", "INVALID_QUALITY_CODE", "UNKNOWN", 0)),
        (5, "VALID", "GOOD", None, ("ONLINE", "NORMAL", "OK", "NULL_VOLUME", "GOOD", 0)),
        (6, "NEGATIVE_VOLUME", "GOOD", -1.0, ("SENSOR_ANOMALY", "NORMAL", "OK", "NEGATIVE_VOLUME", "BAD", 0)),
        (7, "VALID", "GOOD", 1.0, ("ONLINE", "NORMAL", "OK", None, "GOOD", 0)),
    ]
    df = frame([c[:4] for c in cases], "id int, raw_status string, quality_code string, volume double")
    got = df.select("id", events.event_context().alias("c")).select("id", "c.*").orderBy("id").collect()
    assert [tuple(r)[1:] for r in got] == [c[4] for c in cases]


def test_anomalies_and_repeatable_sample(spark):
    df = spark.range(300).select(F.concat(F.lit("r"), "id").alias("raw_reading_id"), F.when(F.col("id") % 50 == 0, 0.0).otherwise(1.0).alias("volume"), F.lit("GOOD").alias("quality_code"), F.lit("VALID").alias("raw_status"))
    picked = events.anomalies_plus_sample(df, 20)
    again = events.anomalies_plus_sample(df.repartition(7), 20)
    assert picked.count() == 26 and rows(picked) == rows(again)
    assert events.anomalies_plus_sample(df, 0).count() == 6


def test_upsert_is_insert_if_absent_and_idempotent(frame):
    stored = frame([("a", "old", "b1", datetime(2024, 1, 1), "b1"), ("b", "old", "b1", datetime(2024, 1, 1), "b1")], "event_id string, body string, seed_batch_id string, last_seed_attempt_at timestamp_ntz, last_seed_batch_id string")
    incoming = frame([("b", "new", "b2"), ("c", "new", "b2")], "event_id string, body string, seed_batch_id string")
    once = events.upsert_documents(stored, incoming, "2024-02-01 00:00:00")
    expected = [
        ("a", "old", "b1", datetime(2024, 1, 1), "b1"), ("b", "old", "b1", datetime(2024, 2, 1), "b2"), ("c", "new", "b2", datetime(2024, 2, 1), "b2"),
    ]
    assert rows(once) == expected
    assert rows(events.upsert_documents(once, incoming, "2024-02-01 00:00:00")) == expected


def test_batch_filter_and_reset_keep_rows_without_batch(frame):
    df = frame([("a", "b1"), ("b", None), ("c", "b2")], "id string, seed_batch_id string")
    assert rows(events.of_batch(df, "b1"), "id") == [("a",)]
    assert rows(events.without_batch(df, "b1"), "id") == [("b",), ("c",)]


REVIEW = "production_date string, facility_id string, exception_type string, severity string, exception_id string, status string, note_text string, updated_by string, reviewed_at timestamp_ntz"


def review(day, status, note, at, fac="F1", user="ann"):
    return (day, fac, "LATE", "High", "x", status, note, user, datetime(2024, 3, at))


def test_triage_latest_wins_and_keeps_creation(frame):
    first = state.clean_reviews(frame([review("2024-01-01", "Investigating", "hello", 1), review("2024-01-02", "", " ", 1)], REVIEW))
    empty = first.limit(0).withColumns({"updated_at": F.col("reviewed_at"), "created_at": F.col("reviewed_at")})
    stored = state.triage_upsert(empty, first)
    second = state.clean_reviews(frame([review("2024-01-01", "Resolved", None, 3), review("2024-01-01", "Ignored", "none", 2), review("2024-01-03", "Resolved", "x", 2, fac=None, user="")], REVIEW))
    merged = state.triage_upsert(stored, second)
    got = rows(merged, "exception_group_key", "status", "priority", "updated_by", "updated_at", "created_at")
    assert got == [
        ("2024-01-01|F1|LATE|High", "Resolved", "Medium", "ann", datetime(2024, 3, 3), datetime(2024, 3, 1)),
        ("2024-01-02|F1|LATE|High", "Not reviewed", "Medium", "ann", datetime(2024, 3, 1), datetime(2024, 3, 1)),
        ("2024-01-03|unknown_facility|LATE|High", "Resolved", "Medium", "app_user", datetime(2024, 3, 2), datetime(2024, 3, 2)),
    ]
    assert rows(state.note_rows(second), "note_text") == [("x",)]
    log = rows(state.review_log_rows(second), "reviewer_decision", "accepted_flag")
    assert log == [("Ignored", False), ("Resolved", True), ("Resolved", True)]
    detail = json.loads(state.activity_rows(first).where("object_id LIKE '2024-01-01%'").first().activity_detail)
    assert detail == {"status": "Investigating", "priority": "Medium", "assigned_to": None, "note_inserted": True}
    assert rows(state.state_counts(stored, state.note_rows(first), state.review_log_rows(first), state.activity_rows(first))) == [(2, 1, 2, 2)]


def test_delete_by_key_keeps_null_rows(frame):
    df = frame([("k", "u"), ("k", None), ("j", "u")], "key string, user string")
    assert rows(state.delete_by_key(df, key="k", user="u")) == [("j", "u"), ("k", None)]
