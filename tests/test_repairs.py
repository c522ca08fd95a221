"""What must hold outside the tidy test tables."""

from __future__ import annotations

import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from plumbline.functions.clean import kind_sql
from plumbline.operators import enrich, events
from plumbline.operators.publish import normalize_names
from plumbline.plans.bindings import METER_TEXT, text_columns
from plumbline.sources import tables


def test_meter_ids_of_many_customers_are_distinct(spark):
    wide = spark.range(150_000).selectExpr("id AS c_custkey", "'n' AS c_name", "1 AS c_nationkey", "'s' AS c_mktsegment", "0D AS c_acctbal")
    assert wide.selectExpr(*text_columns(METER_TEXT)).select("meter_id").distinct().count() == 150_000


def test_a_repeated_master_id_does_not_multiply_readings(frame):
    readings = frame([("r1", "m1"), ("r2", "m2"), ("r3", None)], "raw_reading_id string, meter_id string")
    meters = frame([("m1", "f1", "a"), ("m1", "f1", "b"), (None, "f1", "c")], "meter_id string, facility_id string, meter_name string")
    facilities = frame([("f1", "F")], "facility_id string, facility_name string")
    assert enrich.join_master(readings, meters, facilities).count() == 3


def test_received_documents_are_preserved(frame):
    lines = ['{"event_id": "e1", "unknown": [1], "payload": {"volume": 12.5}}', "not json", "[1]", '{"event_id": "e2"}']
    table = frame([(x,) for x in lines], "value string")
    flat = events.flatten_documents(events.parse_documents(table))
    kept = {r.event_id: r.raw_document_json for r in flat.where("event_id IS NOT NULL").collect()}
    assert json.loads(kept["e1"]) == {"event_id": "e1", "unknown": [1], "payload": {"volume": 12.5}}
    assert [r.payload_volume for r in flat.where("event_id = 'e1'").collect()] == [12.5]
    assert rows(events.unreadable_lines(table)) == [("[1]",), ("not json",)]


def test_upsert_keeps_columns_of_both_sides(frame):
    stored = frame([("a", "old", "s", None, "b1")], "event_id string, body string, only_stored string, last_seed_attempt_at string, last_seed_batch_id string")
    new = frame([("a", "new", "n", "b2"), ("b", "new", "n", "b2")], "event_id string, body string, only_new string, seed_batch_id string")
    out = events.upsert_documents(stored, new, "2024-01-01 00:00:00")
    assert rows(out, "event_id", "body", "only_stored", "only_new") == [("a", "old", "s", None), ("b", "new", None, "n")]


@pytest.mark.parametrize("step", ["DROP TABLE IF EXISTS repaired", "ALTER TABLE repaired__next"])
def test_a_replacement_that_breaks_off_loses_nothing(spark, monkeypatch, step):
    tables.write_table(spark.range(3), "repaired")
    run = type(spark).sql

    def broken(self, text, *args, **options):
        if text.startswith(step) and not text.startswith("DROP TABLE IF EXISTS repaired__next"):
            raise RuntimeError("lost")
        return run(self, text, *args, **options)

    monkeypatch.setattr(type(spark), "sql", broken)
    with pytest.raises(RuntimeError):
        tables.replace_table(spark.range(5), "repaired")
    monkeypatch.undo()
    assert tables.table_exists(spark, "repaired")
    assert spark.table("repaired").count() in (3, 5)
    assert tables.replace_table(spark.range(4), "repaired") == 4
    assert spark.table("repaired").count() == 4
    spark.sql("DROP TABLE repaired")


def test_generated_names_are_registered():
    assert normalize_names(["a", "A", "a_2", "a"]) == ["A", "A_2", "A_2_2", "A_3"]
    assert len({*normalize_names(["x_2", "x", "x", "X_3", "x"])}) == 5


def test_offsets_become_utc(frame):
    texts = ["2024-01-01T10:00:00+05:00", "2024-01-01T10:00:00", "2024-01-01 10:00:00Z", "2024-01-01", "x", None]
    df = frame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", F.expr(kind_sql("timestamp", "t")).cast("string").alias("t"))
    assert [r.t for r in df.orderBy("i").collect()] == ["2024-01-01 05:00:00", "2024-01-01 10:00:00", "2024-01-01 10:00:00", "2024-01-01 00:00:00", None, None]
