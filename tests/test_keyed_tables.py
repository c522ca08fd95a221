from __future__ import annotations

import os
from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from plumbline.operators import events, state
from plumbline.sources import tables

REVIEW = "production_date string, facility_id string, exception_type string, severity string, exception_id string, status string, note_text string, updated_by string, reviewed_at timestamp_ntz"


def part_files(spark, name):
    """Modification time of each data file, by its path."""
    place = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first().data_type.removeprefix("file:")
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(place) for f in names if f.endswith(".parquet")}


def parts_of(files):
    return {p.rsplit("/", 2)[1] for p in files}


@pytest.fixture
def database(spark):
    tables.use_database(spark, "t_keyed")
    return "t_keyed"


def reviews(spark, items):
    made = [(f"2024-01-{day:02d}", "F1", "LATE", "High", "x", status, None, "ann", datetime(2024, 3, at)) for day, status, at in items]
    return state.clean_reviews(spark.createDataFrame(made, REVIEW))


def test_an_upsert_rewrites_only_the_parts_of_its_keys(spark, database):
    first = reviews(spark, [(d, "Investigating", 1) for d in range(1, 29)])
    empty = first.limit(0).withColumns({"updated_at": F.col("reviewed_at"), "created_at": F.col("reviewed_at")})
    whole = state.triage_upsert(empty, first)
    name = f"{database}.triage"
    assert tables.write_keyed_table(whole, name, "exception_group_key", 16) == 28
    before = part_files(spark, name)
    second = reviews(spark, [(3, "Resolved", 5), (30, "Ignored", 5)])
    touched = tables.change_keyed_table(name, second, state.triage_upsert)
    after = part_files(spark, name)
    assert touched <= 2
    same = {p for p, at in before.items() if after.get(p) == at}
    assert len(parts_of(before) - parts_of(same)) <= 2 and len(same) >= len(before) - 2
    assert rows(tables.read_keyed_table(spark, name)) == rows(state.triage_upsert(whole, second))
    assert tables.change_keyed_table(name, second, state.triage_upsert) == touched  # once more changes nothing
    assert rows(tables.read_keyed_table(spark, name)) == rows(state.triage_upsert(whole, second))


def test_documents_are_merged_by_key(spark, database):
    schema = "event_id string, body string, seed_batch_id string, last_seed_attempt_at timestamp_ntz, last_seed_batch_id string"
    stored = spark.createDataFrame([(f"e{i}", "old", "b1", datetime(2024, 1, 1), "b1") for i in range(50)], schema)
    incoming = spark.createDataFrame([("e7", "new", "b2"), ("e99", "new", "b2")], "event_id string, body string, seed_batch_id string")
    merge = lambda old, new: events.upsert_documents(old, new, "2024-02-01 00:00:00")
    name = f"{database}.documents"
    tables.write_keyed_table(stored, name, "event_id")
    assert tables.change_keyed_table(name, incoming, merge) <= 2
    assert rows(tables.read_keyed_table(spark, name), *stored.columns) == rows(merge(stored, incoming), *stored.columns)


def test_deletes_by_key_and_empty_parts(spark, database):
    stored = spark.createDataFrame([("a", "u"), ("a", "v"), ("b", "u"), ("c", None), (None, "u")], "k string, user string")
    name = f"{database}.notes"
    tables.write_keyed_table(stored, name, "k", 8)
    tables.delete_keys(name, spark.createDataFrame([("a", "u"), ("c", None), (None, "u")], "k string, user string"), ["k", "user"])
    assert rows(tables.read_keyed_table(spark, name)) == [(None, "u"), ("a", "v"), ("b", "u"), ("c", None)]
    tables.delete_keys(name, spark.createDataFrame([("a",), ("b",)], "k string"), ["k"])
    assert rows(tables.read_keyed_table(spark, name)) == [(None, "u"), ("c", None)]
    tables.delete_keys(name, spark.createDataFrame([("c",)], "k string"), ["k"])
    assert rows(tables.read_keyed_table(spark, name)) == [(None, "u")]


def test_nothing_incoming_and_tables_without_a_key(spark, database):
    stored = spark.createDataFrame([("a", 1)], "k string, n int")
    name = f"{database}.plain"
    tables.write_table(stored, name)
    with pytest.raises(ValueError, match="not a keyed table"):
        tables.change_keyed_table(name, stored, lambda old, new: old)
    tables.write_keyed_table(stored, f"{database}.keyed", "k")
    assert tables.change_keyed_table(f"{database}.keyed", stored.limit(0), lambda old, new: old) == 0
    assert rows(tables.read_keyed_table(spark, f"{database}.keyed")) == [("a", 1)]
