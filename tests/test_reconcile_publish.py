from __future__ import annotations

from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from plumbline.operators import publish, reconcile


def test_statuses(frame):
    df = frame([(None, 5, 5), (5, 5, 5), (5, 6, 6), (5, 6, 5), (5, 5, None)], "expected_rows long, source_rows long, written_rows long")
    got = [tuple(r) for r in df.select(reconcile.layer_status(), reconcile.two_sided_status(), reconcile.publish_status()).collect()]
    assert got == [
        ("CREATED", "CREATED", "WARN_EXPECTED_COUNT_CHANGED"), ("PASS", "PASS", "PASS"), ("CHECK", "CHECK", "WARN_EXPECTED_COUNT_CHANGED"),
        ("PASS", "CHECK", "FAIL"), ("CHECK", "CHECK", "FAIL"),
    ]


def test_non_pass_aborts_with_names(frame):
    summary = frame([("good", "PASS"), ("moved", "WARN_EXPECTED_COUNT_CHANGED"), ("lost", None)], "target_table string, status string")
    with pytest.raises(RuntimeError, match="moved") as caught:
        reconcile.require_all_pass(summary)
    assert "lost" in str(caught.value) and "good" not in str(caught.value)
    reconcile.require_all_pass(summary.where("status = 'PASS'"))


def test_stage_deltas_and_interpretation(spark):
    frames = [spark.range(n) for n in (10, 10, 8, 0, 4, 2, 1, 3)]
    fact = reconcile.reconciliation_fact(frames).orderBy("stage_order").collect()
    assert [r.row_count for r in fact] == [10, 10, 8, 0, 4, 2, 1, 3]
    assert [r.previous_row_count for r in fact] == [None, 10, 10, 8, 0, 4, 2, 1]
    assert [r.row_count_delta_pct_from_previous for r in fact] == [None, 0.0, -0.2, -1.0, None, -0.5, -0.5, 2.0]
    assert fact[0].interpretation == "Original generated source record count."
    assert fact[7].interpretation.startswith("One row per failed DQ rule")


def test_interpretation_fallbacks(frame):
    df = frame([("x", "Exception_table"), ("x", "table"), (None, None)], "metric_type string, object_name string")
    got = [r[0] for r in df.select(reconcile.interpretation()).collect()]
    assert got == [reconcile.EXCEPTION_OBJECT, reconcile.OTHERWISE, reconcile.OTHERWISE]


def test_names_are_sanitized_and_unique():
    got = publish.normalize_names(["a b", "A-B", "2x", "", "__y__", "a  b", "é"])
    assert got == ["A_B", "A_B_2", "COL_2X", "COL", "Y", "A_B_3", "COL_2"]
    with pytest.raises(ValueError):
        publish.require_identifier("a; drop")


def test_flatten_and_normalize(frame):
    df = frame([(1, ["b", "a"], {"k": 1}, Decimal("1.50"), float("nan")), (2, None, None, None, 2.0)], "id int, tags array<string>, m map<string,int>, amount decimal(10,2), rate double")
    flat = publish.flatten_complex(df)
    assert rows(flat, "id", "tags", "m", "amount")[0] == (1, '["b","a"]', '{"k":1}', 1.5)
    assert rows(publish.flatten_complex(df, "joined"), "id", "tags")[0] == (1, "b, a")
    assert [r.rate for r in publish.normalize_values(df).orderBy("id").collect()] == [None, 2.0]


def test_align_to_target(frame):
    df = frame([("r1", "2024-01-01 05:00:00", "12", ["x", "y"], 1.23456789), ("r2", "bad", "oops", None, None)], "RUN_ID string, run_started_at string, rows_read string, source_systems array<string>, rate double")
    target = (("run_id", "varchar(200)"), ("started_at", "datetime2(3)"), ("rows_read", "bigint"), ("source_systems_text", "varchar(max)"), ("rate", "decimal(18,4)"), ("missing", "int"), ("_stamp", "varchar(50)"))
    aliases = {"started_at": ("started_at", "run_started_at"), "source_systems_text": ("source_systems",)}
    aligned = publish.align_to_target(df, target, aliases, {"_stamp": F.lit("run")})
    assert [f.dataType.simpleString() for f in aligned.schema] == ["string", "timestamp", "bigint", "string", "decimal(18,4)", "int", "string"]
    got = [tuple(r)[:1] + tuple(r)[2:] for r in aligned.orderBy("run_id").collect()]
    assert got == [("r1", 12, "x, y", Decimal("1.2346"), None, "run"), ("r2", None, None, None, None, "run")]
    assert aligned.where("started_at IS NULL").count() == 1
    assert publish.spark_type("numeric(10,2)") == "decimal(10,2)" and publish.spark_type("nvarchar(5)") == "string" and publish.spark_type("bit") == "boolean"


def test_publish_metadata_is_distinct(spark):
    df = publish.stamp_publish(spark.range(3), "support", "run-1", "2024-01-01 00:00:00")
    assert publish.publish_metadata(df, "support").count() == 1
