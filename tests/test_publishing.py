from __future__ import annotations

import uuid

import pytest
from helpers import rows
from pyspark.sql import functions as F

from plumbline.operators import publish
from plumbline.plans import publishing
from plumbline.sources import remote


@pytest.fixture
def derby():
    """An in-process database; it opens no port and ends with the session."""
    return {"url": f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def numbers(spark, n, name="a"):
    return spark.range(n).select(F.col("id").alias("ID"), F.lit(name).alias("NAME"))


def content(spark, derby, table):
    return rows(remote.read_remote_table(spark, derby, table).select("ID", "NAME"))


def test_all_targets_change_together(spark, derby):
    first = [publishing.PublishTarget("T_ONE", numbers(spark, 3)), publishing.PublishTarget("T_TWO", numbers(spark, 2), expected_rows=2)]
    summary = publishing.publish_all(spark, derby, first, "run-1", published_at="2024-03-01 12:00:00")
    assert rows(summary, "target_table", "expected_rows", "source_rows", "written_rows", "lost_values", "status") == [
        ("T_ONE", 3, 3, 3, 0, "PASS"), ("T_TWO", 2, 2, 2, 0, "PASS")]
    stamped = remote.read_remote_table(spark, derby, "T_ONE")
    assert rows(stamped.select("_warehouse_publish_run_id").distinct()) == [("run-1",)]
    second = [publishing.PublishTarget("T_ONE", numbers(spark, 5, "b")), publishing.PublishTarget("T_TWO", numbers(spark, 0, "b"))]
    publishing.publish_all(spark, derby, second, "run-2")
    assert len(content(spark, derby, "T_ONE")) == 5 and content(spark, derby, "T_TWO") == []
    with pytest.raises(Exception):  # noqa: B017  # the staged tables are gone
        remote.read_remote_table(spark, derby, "T_ONE__staged").count()


def test_one_failing_target_leaves_all_as_they_were(spark, derby):
    publishing.publish_all(spark, derby, [publishing.PublishTarget("T_ONE", numbers(spark, 3)), publishing.PublishTarget("T_TWO", numbers(spark, 2))], "run-1")
    wrong = [publishing.PublishTarget("T_ONE", numbers(spark, 5, "b")), publishing.PublishTarget("T_TWO", numbers(spark, 4, "b"), expected_rows=9)]
    with pytest.raises(publishing.PublishAborted, match="T_TWO \\(WARN_EXPECTED_COUNT_CHANGED\\)") as stopped:
        publishing.publish_all(spark, derby, wrong, "run-2")
    assert rows(stopped.value.summary, "target_table", "status") == [("T_ONE", "PASS"), ("T_TWO", "WARN_EXPECTED_COUNT_CHANGED")]
    assert content(spark, derby, "T_ONE") == [(0, "a"), (1, "a"), (2, "a")] and len(content(spark, derby, "T_TWO")) == 2


def test_an_error_in_the_exchange_takes_all_back(spark, derby):
    publishing.publish_all(spark, derby, [publishing.PublishTarget("T_ONE", numbers(spark, 3))], "run-1")
    with pytest.raises(Exception):  # noqa: B017
        remote.run_in_transaction(spark, derby, ["DELETE FROM T_ONE", "DELETE FROM no_such_table"])
    assert len(content(spark, derby, "T_ONE")) == 3


def test_a_value_the_target_refuses_stops_the_whole_set(spark, derby):
    """Spark reads SMALLINT as int, so only the target sees that the value does not fit."""
    publishing.publish_all(spark, derby, [publishing.PublishTarget("T_ONE", numbers(spark, 3))], "run-1")
    remote.run_in_transaction(spark, derby, ['CREATE TABLE T_SMALL ("ID" SMALLINT)', "INSERT INTO T_SMALL VALUES (1)"])
    large = spark.createDataFrame([(70_000,)], "ID int")
    with pytest.raises(Exception, match="SMALLINT"):  # noqa: B017
        publishing.publish_all(spark, derby, [publishing.PublishTarget("T_ONE", numbers(spark, 5)), publishing.PublishTarget("T_SMALL", large)], "run-2")
    assert len(content(spark, derby, "T_ONE")) == 3 and rows(remote.read_remote_table(spark, derby, "T_SMALL")) == [(1,)]


def test_targets_are_checked_by_name(spark, derby):
    with pytest.raises(ValueError, match="twice"):
        publishing.publish_all(spark, derby, [publishing.PublishTarget("T_ONE", numbers(spark, 1)), publishing.PublishTarget("t_one", numbers(spark, 1))], "r")
    with pytest.raises(ValueError, match="Unsafe"):
        publishing.publish_all(spark, derby, [publishing.PublishTarget("T; DROP", numbers(spark, 1))], "r")
    with pytest.raises(ValueError, match="Nothing"):
        publishing.publish_all(spark, derby, [], "r")


def test_a_live_target_with_other_columns(spark, derby):
    """The target has a narrower number, a column of its own, and lacks one of the source."""
    remote.run_in_transaction(spark, derby, ['CREATE TABLE T_LIVE ("ID" INTEGER, "LABEL" VARCHAR(20), "OWNER" VARCHAR(20))'])
    frame = spark.createDataFrame([(1, "x", 1.0), (5_000_000_000, "y", 2.0), (None, "z", None)], "id long, name string, extra double")
    target = publishing.PublishTarget("T_LIVE", frame, aliases={"label": ("name",)})
    summary = publishing.publish_all(spark, derby, [target], "run-1")
    assert rows(summary, "lost_values", "schema_changes", "status") == [(1, "NARROWED ID, RENAMED LABEL, ADDED OWNER, MISSING extra", "PASS")]
    assert rows(remote.read_remote_table(spark, derby, "T_LIVE")) == [(None, "y", None), (None, "z", None), (1, "x", None)]
    with pytest.raises(publishing.PublishAborted):
        publishing.publish_all(spark, derby, [target], "run-2", abort_on_loss=True)


def test_a_changed_parquet_target(spark, tmp_path):
    path = str(tmp_path / "target")
    spark.createDataFrame([(1, "a")], "id int, name string").write.parquet(path)
    spark.createDataFrame([(2, None, ["x"])], "id int, note string, tags array<string>").write.mode("overwrite").parquet(path)
    live = spark.read.parquet(path).schema
    frame = spark.createDataFrame([(5_000_000_000, "n", 2.0), (7, "m", None)], "ID long, name string, price double")
    changes = publish.schema_changes(frame, live, {"note": ("name",)})
    assert [(c.column, c.change, c.source_type, c.target_type) for c in changes] == [
        ("id", "NARROWED", "bigint", "int"), ("note", "RENAMED", "string", "string"), ("tags", "ADDED", None, "array<string>"), ("price", "MISSING", "double", None)]
    shaped = publish.align_to_target(frame, live, {"note": ("name",)})
    assert [f.dataType for f in shaped.schema.fields] == [f.dataType for f in live.fields]
    assert rows(shaped) == [(None, "n", None), (7, "m", None)]
    lost = publish.lost_values(frame, live, {"note": ("name",)})
    assert list(lost) == ["id"] and frame.where(lost["id"]).count() == 1


@pytest.mark.parametrize(
    ("source", "wanted", "held"),
    [("int", "bigint", True), ("bigint", "int", False), ("int", "string", True), ("string", "int", False), ("date", "timestamp", True), ("timestamp", "date", False),
     ("int", "decimal(12,2)", True), ("bigint", "decimal(12,2)", False), ("decimal(8,2)", "decimal(10,2)", True), ("decimal(8,3)", "decimal(10,2)", False),
     ("double", "decimal(18,6)", False), ("decimal(8,2)", "double", True), ("boolean", "int", False), ("float", "double", True)],
)
def test_which_types_hold_all_values(source, wanted, held):
    assert publish.fits(source, wanted) is held


def test_support_tables_are_published_by_their_definitions(spark, derby):
    stages = spark.createDataFrame([(1, "source", "file", 10, None)], "stage_order int, layer string, object_name string, row_count long, previous_row_count long")
    targets = publishing.support_targets({"fact_source_to_target_reconciliation": stages, "unknown": stages}, {"fact_source_to_target_reconciliation": 1})
    assert [t.table for t in targets] == ["fact_source_to_target_reconciliation"]
    publishing.publish_all(spark, derby, targets, "run-1", warehouse="support")
    back = remote.read_remote_table(spark, derby, "fact_source_to_target_reconciliation")
    assert len(back.columns) == len(publish.SUPPORT_TABLES["fact_source_to_target_reconciliation"]) + 2
    assert rows(back, "row_count", "interpretation", "_support_publish_run_id") == [(10, None, "run-1")]
