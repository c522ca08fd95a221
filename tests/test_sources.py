from __future__ import annotations

import json
import uuid

import pytest
from helpers import rows
from pyspark.sql import functions as F

from plumbline.operators import publish, rules
from plumbline.operators.standardize import SPECS, source_columns, standardize_table
from plumbline.plans import views
from plumbline.sources import files, remote, tables
from plumbline.streaming import incremental


def write_text(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def reading_line(rid, meter="M1", volume="1.5", code="GOOD"):
    values = {"raw_reading_id": rid, "meter_id": meter, "facility_id": "F1", "reading_timestamp": "2024-01-05T12:00:00", "production_date": "2024-01-05", "volume": volume, "quality_code": code, "raw_status": "VALID", "load_timestamp": "2024-01-05T12:05:00"}
    return ",".join(values.get(c, "") for c in source_columns(SPECS["raw_polling_readings"]))


HEADER = ",".join(source_columns(SPECS["raw_polling_readings"]))


def test_csv_source_has_lineage_and_checks_its_contract(spark, tmp_path):
    folder = tmp_path / "csv"
    write_text(folder, "one.csv", [HEADER, reading_line("r1"), reading_line("r2", volume="")])
    raw = files.read_csv_source(spark, str(folder), "raw_polling_readings", "run-1")
    got = raw.orderBy("raw_reading_id").collect()
    assert [r._source_file for r in got] == ["one.csv", "one.csv"] and got[0]._bronze_run_id == "run-1"
    assert got[0]._source_path.endswith("one.csv") and len(got[0]._record_hash) == 64
    again = files.read_csv_source(spark, str(folder), "raw_polling_readings", "run-2")
    assert rows(raw, "_record_hash") == rows(again, "_record_hash")
    typed = standardize_table(raw, "raw_polling_readings")
    assert [r.volume for r in typed.orderBy("raw_reading_id").collect()] == [1.5, None]
    write_text(tmp_path / "bad", "x.csv", ["raw_reading_id", "r1"])
    with pytest.raises(ValueError, match="meter_id"):
        files.read_csv_source(spark, str(tmp_path / "bad"), "raw_polling_readings", "run-1")


def test_flow_files_by_their_own_names(spark, tmp_path):
    wanted = source_columns(SPECS["flow_computer_extract"])
    theirs = {"flow_record_id": "flowcal_record_id", "flow_batch_id": "flowcal_batch_id"}
    for folder, header in (("ours", wanted), ("theirs", [theirs.get(c, c) for c in wanted])):
        write_text(tmp_path / folder, "f.csv", [",".join(header), ",".join(f"v{i}" for i in range(len(wanted)))])
        got = files.read_csv_source(spark, str(tmp_path / folder), "flow_computer_extract", "run-1")
        assert rows(got, "flow_record_id", "flow_batch_id") == [("v0", f"v{wanted.index('flow_batch_id')}")]


def test_event_documents_of_one_batch(spark, tmp_path):
    docs = [{"_id": str(i), "event_id": f"e{i}", "raw_reading_id": f"r{i}", "seed_batch_id": f"b{i % 2}", "payload": {"volume": i, "retry_count": "x"}} for i in range(4)]
    write_text(tmp_path / "docs", "d.json", [json.dumps(d) for d in docs])
    got = files.read_event_documents(spark, str(tmp_path / "docs"), "run-1", batch_id="b1").documents
    assert rows(got, "object_id", "event_id", "payload_volume", "payload_retry_count") == [("1", "e1", 1.0, None), ("3", "e3", 3.0, None)]
    assert got.first()._source_filter == "seed_batch_id=b1" and len(got.first()._record_hash) == 64
    from plumbline.operators.events import require_nonempty

    with pytest.raises(RuntimeError, match="batch b7"):
        require_nonempty(files.read_event_documents(spark, str(tmp_path / "docs"), "run-1", batch_id="b7").documents, "batch b7")


def test_broken_lines_are_split_off_and_counted(spark, tmp_path):
    good = '{"event_id": "e1",  "seed_batch_id": "b1", "payload": {"volume": 1.50}}'
    sent = [good, '{"event_id": "e2", "pay', "", "  ", '["e3"]', '"e4"', "17", "{}", '  {"event_id": "e5"}']
    write_text(tmp_path / "lines", "d.json", sent)
    into = str(tmp_path / "landed")
    landing = files.read_event_documents(spark, str(tmp_path / "lines"), "run-1", into=into)
    assert (landing.received_rows, landing.accepted_rows, landing.rejected_rows) == (9, 3, 6)
    assert rows(landing.documents, "event_id") == [(None,), ("e1",), ("e5",)]
    assert rows(landing.rejects, "reject_reason", "raw_document_json") == [
        ("BLANK_LINE", ""), ("BLANK_LINE", "  "), ("BROKEN_JSON", '{"event_id": "e2", "pay'),
        ("NOT_AN_OBJECT", '"e4"'), ("NOT_AN_OBJECT", "17"), ("NOT_AN_OBJECT", '["e3"]'),
    ]
    assert landing.documents.where("event_id = 'e1'").first().raw_document_json == good  # byte for byte
    assert {r._source_file for r in landing.received.collect()} == {"d.json"}
    # the payload rule sees the received text: what is no JSON is red
    red = rules.failures_only(landing.received, rules.PAYLOAD_RULES, rules.RuleContext(as_of="2024-01-10"))
    assert rows(red, "reject_reason") == [("BLANK_LINE",), ("BLANK_LINE",), ("BROKEN_JSON",)]
    again = files.read_event_documents(spark, str(tmp_path / "lines"), "run-1", into=into)
    assert again.received.count() == 9  # landing once more replaces, it does not add


def test_landing_of_nothing(spark, tmp_path):
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "d.json").write_text("")
    landing = files.read_event_documents(spark, str(tmp_path / "none"), "run-1")
    assert (landing.received_rows, landing.rejected_rows) == (0, 0)
    assert landing.documents.count() == landing.rejects.count() == 0


def test_table_write_count_replace_and_list(spark):
    tables.use_database(spark, "t_state")
    assert tables.write_table(spark.range(10), "t_state.numbers") == 10
    assert tables.table_exists(spark, "t_state.numbers") and not tables.table_exists(spark, "t_state.other")
    grown = spark.table("t_state.numbers").unionByName(spark.range(10, 15))
    assert tables.replace_table(grown, "t_state.numbers") == 15
    assert tables.append_table(spark.range(3), "t_state.numbers") == 3
    assert spark.table("t_state.numbers").count() == 18
    by_day = spark.range(20).select("id", (F.col("id") % 2).alias("day"))
    assert tables.write_table(by_day, "t_state.by_day", partition_by=("day",)) == 20
    assert tables.write_table(by_day.withColumn("more", F.lit("x")), "t_state.by_day", partition_by=("day",)) == 20
    assert "more" in spark.table("t_state.by_day").columns
    assert tables.list_tables(spark, "t_state") == ["by_day", "numbers"]
    with pytest.raises(ValueError):
        tables.table_exists(spark, "t_state.x; drop")


@pytest.fixture
def derby():
    """An in-process database; it opens no port and ends with the session."""
    return {"url": f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_publish_over_jdbc_recreate_truncate_and_read(spark, derby):
    first = spark.range(5).select(F.col("id").alias("ID"), F.lit("a").alias("NAME"))
    assert remote.publish(first, derby, "target_one", keep_definition=False) == (5, 5)
    second = spark.range(3).select(F.col("id").alias("ID"), F.lit("b").alias("NAME"))
    assert remote.publish(second, derby, "target_one", keep_definition=True) == (3, 3)
    got = remote.read_remote(spark, derby, "SELECT MAX(ID) AS TOP_ID, COUNT(*) AS N FROM target_one;")
    assert rows(got) == [(2, 3)]
    assert remote.read_remote_table(spark, derby, "target_one").count() == 3
    with pytest.raises(ValueError):
        remote.publish(first, derby, "bad name")


def test_publish_summary_and_views(spark):
    summary = remote.publish_summary(spark, [
        {"publish_run_id": "p", "source_table": "s", "target_table": "t", "description": "d", "expected_rows": 5, "source_rows": 5, "written_rows": 5, "published_at_utc": "now"},
        {"publish_run_id": "p", "source_table": "s", "target_table": "u", "description": "d", "expected_rows": 5, "source_rows": 5, "written_rows": 4, "published_at_utc": "now"},
    ])
    assert rows(summary, "target_table", "status") == [("t", "PASS"), ("u", "FAIL")]
    health = spark.createDataFrame([tuple("x" for _ in views.INVESTIGATION_VIEWS["pipeline_health"][1])], ", ".join(f"{c} string" for c in views.INVESTIGATION_VIEWS["pipeline_health"][1]))
    stamped = publish.stamp_publish(health, "warehouse", "run-1")
    made = views.register_views({"pipeline_health_summary": stamped})
    assert made == ["vw_investigation_pipeline_health", "vw_business_reporting_readiness", "vw_support_pipeline_health"]
    assert "_warehouse_publish_run_id" in spark.table("vw_investigation_pipeline_health").columns
    assert rows(remote.view_summary({"v": health}, "run-1")) == [("run-1", "v", 1, "PASS")]
    checked = remote.view_summary({"v": health, "w": health, "x": health}, "run-1", {"v": 1, "w": 2})
    assert rows(checked, "view_name", "status") == [("v", "PASS"), ("w", "CHECK"), ("x", "CREATED")]
    # each audience gets its own shape
    assert [c for c in spark.table("vw_business_reporting_readiness").columns if c != c.upper()] == []
    support = spark.table("vw_support_pipeline_health")
    wanted = [c for c, _ in publish.SUPPORT_TABLES["pipeline_health_summary"]]
    assert support.columns == [*wanted, "_warehouse_publish_run_id", "_warehouse_published_at_utc"]
    assert dict(support.dtypes)["failure_rate"] == "decimal(18,6)" and support.first()._warehouse_publish_run_id == "run-1"


def test_csv_export(spark, tmp_path):
    files.export_csv(spark.createDataFrame([(1, "a,b"), (2, None)], "id int, note string"), str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert rows(back) == [("1", "a,b"), ("2", None)]


def test_stream_checks_only_new_files(spark, tmp_path):
    source, target = tmp_path / "incoming", str(tmp_path / "checked")
    meters = spark.createDataFrame([("M1", "F1", True)], "meter_id string, facility_id string, is_active boolean")
    facilities = spark.createDataFrame([("F1", "North")], "facility_id string, facility_name string")
    stream_name = uuid.uuid4().hex

    def run():
        raw = incremental.stream_csv_source(spark, str(source), "raw_polling_readings")
        checked = incremental.check_stream(raw, meters, facilities, rules.RuleContext(as_of="2024-01-10"))
        query = incremental.run_available(checked.select("raw_reading_id", "record_quality_status", "primary_exception_type"), target, stream_name)
        assert query.awaitTermination(120)

    write_text(source, "a.csv", [HEADER, reading_line("r1"), reading_line("r2", meter="M9")])
    run()
    write_text(source, "b.csv", [HEADER, reading_line("r3", volume="-1")])
    run()
    assert rows(spark.read.parquet(target)) == [("r1", "VALID", None), ("r2", "EXCEPTION", "INVALID_METER"), ("r3", "EXCEPTION", "NEGATIVE_VOLUME")]
