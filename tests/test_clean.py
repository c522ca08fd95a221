from __future__ import annotations

from datetime import date, datetime

from helpers import rows
from pyspark.sql import functions as F

from plumbline.functions import clean, keys
from plumbline.operators.standardize import SPECS, add_layer_metadata, source_columns, standardize_table


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_clean_string_trims_and_nulls_blank(frame):
    df = frame([(" a ",), ("",), ("   ",), (None,), ("b c",)], "x string")
    assert values(df, clean.clean_string("x")) == ["a", None, None, None, "b c"]


def test_yes_no_any_case_and_padding(frame):
    df = frame([("Y",), (" n ",), ("y",), ("yes",), ("",), (None,)], "x string")
    assert values(df, clean.yes_no("x")) == [True, False, True, None, None, None]


def test_parsers_give_null_for_unreadable_text(frame):
    df = frame([("2024-01-02", "2024-01-02T03:04:05", "1.5", "7"), ("2024-13-01", "soon", "x", "7.5"), ("", " ", "", "")], "d string, t string, f string, i string")
    got = df.select(clean.parse_date("d"), clean.parse_timestamp("t"), clean.parse_double("f"), clean.parse_int("i")).collect()
    assert tuple(got[0]) == (date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5), 1.5, 7)
    assert tuple(got[1]) == (None, None, None, None)
    assert tuple(got[2]) == (None, None, None, None)


def test_safe_divide_zero_and_null(frame):
    df = frame([(6, 3), (1, 0), (1, None), (None, 2)], "a int, b int")
    assert values(df, clean.safe_divide("a", "b")) == [2.0, None, None, None]


def test_record_hash_ignores_lineage_and_column_order(frame):
    one = frame([(1, "x", "run-1")], "a int, b string, _run string")
    two = frame([("x", 1, "run-2")], "b string, a int, _run string")
    assert values(one, keys.record_hash(one.columns)) == values(two, keys.record_hash(two.columns))


def test_review_group_key_fallbacks(frame):
    schema = "d string, f string, t string, s string"
    df = frame([("2024-01-02T00:00:00", " FAC-1 ", "LATE", "High"), ("2024-01-02 05:00", "nan", "None", ""), (None, None, None, None)], schema)
    assert values(df, keys.review_group_key("d", "f", "t", "s")) == [
        "2024-01-02|FAC-1|LATE|High",
        "2024-01-02|unknown_facility|unknown_exception_type|unknown_severity",
        "unknown_date|unknown_facility|unknown_exception_type|unknown_severity",
    ]


def test_exception_id_skips_nulls_and_is_stable(frame):
    df = frame([("r1", "m1", None), ("r1", "m1", datetime(2024, 1, 1))], "r string, m string, t timestamp_ntz")
    import hashlib

    expected = [hashlib.sha256(t.encode()).hexdigest() for t in ("RULE||r1||m1", "RULE||r1||m1||2024-01-01 00:00:00")]
    assert values(df, keys.exception_id("RULE", "r", "m", "t")) == expected


def test_standardize_meter_keeps_lineage(spark):
    names = source_columns(SPECS["meter_master"])
    row = {c: " v " for c in names} | {
        "install_date": "2020-02-30", "active_flag": " y", "custody_transfer_flag": "N", "expected_min_volume": "1.5",
        "expected_max_volume": "oops", "sample_interval_minutes": "60", "_ingested_at": "now", "_record_hash": "h", "_source_file": "f",
    }
    raw = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in row))
    got = standardize_table(raw, "meter_master").first().asDict()
    assert got["meter_id"] == "v" and got["install_date"] is None and got["active_flag"] == "Y"
    assert got["is_active"] is True and got["is_custody_transfer"] is False
    assert (got["expected_min_volume"], got["expected_max_volume"], got["sample_interval_minutes"]) == (1.5, None, 60)
    assert (got["_bronze_ingested_at"], got["_bronze_record_hash"], got["_source_file"]) == ("now", "h", "f")


def test_layer_metadata_hash_is_reproducible(frame):
    df = frame([(1, "a")], "id int, name string")
    first = add_layer_metadata(df, "gold", "t", "run-1").first()
    second = add_layer_metadata(df, "gold", "t", "run-2").first()
    assert first["_gold_record_hash"] == second["_gold_record_hash"]
    assert (first["_gold_run_id"], second["_gold_run_id"]) == ("run-1", "run-2")


def test_every_spec_reads_each_source_column_once():
    for name, spec in SPECS.items():
        assert len(set(source_columns(spec))) == len(source_columns(spec)), name


def test_is_true_counts_null_as_false(frame):
    df = frame([(True,), (False,), (None,)], "x boolean")
    assert rows(df.select(clean.is_true(F.col("x")).alias("x"))) == [(False,), (False,), (True,)]
