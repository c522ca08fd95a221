"""The whole pipeline on a compact fixture with known anomalies.

125 meters report hourly for 60 days; known issues are seeded by rule, so every
count below follows from the shapes in ``SEEDED``.
"""

from __future__ import annotations

import os

import pytest
from helpers import rows
from pyspark.sql import functions as F

from plumbline.operators import enrich, events, rules
from plumbline.operators.standardize import SPECS, source_columns, standardize_table
from plumbline.plans import medallion
from plumbline.sources.files import add_bronze_metadata

AS_OF = "2026-06-02"
INACTIVE = (11, 37, 63, 88, 104, 119)

# Seeded issues: first meter, meters, day, first hour, hours.
SEEDED = {
    "outage": (31, 4, "2026-04-12", 2, 9), "late": (56, 4, "2026-04-26", 0, 24), "stale": (16, 4, "2026-05-05", 4, 9),
    "mismatch": (86, 4, "2026-05-15", 8, 11), "bad_code": (96, 4, "2026-05-18", 6, 9), "null": (66, 3, "2026-05-21", 2, 6),
    "negative": (101, 3, "2026-05-23", 10, 7), "copied": (11, 5, "2026-04-18", 6, 6),
}


def inside(issue):
    first, count, day, hour, hours = SEEDED[issue]
    return (
        F.col("m").between(first, first + count - 1)
        & (F.to_date("ts") == F.lit(day).cast("date"))
        & F.hour("ts").between(hour, hour + hours - 1)
    )


def hours(spark, first, count, day, hour, n):
    return spark.range(first, first + count).select(
        F.col("id").alias("m"),
        F.explode(F.sequence(F.lit(f"{day} {hour:02d}:00:00").cast("timestamp_ntz"), F.lit(f"{day} {hour:02d}:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(n - 1)), F.expr("INTERVAL 1 HOUR"))).alias("ts"),
    )


def text_readings(spark):
    grid = hours(spark, 1, 125, "2026-04-01", 0, 60 * 24).withColumns(
        {"facility": F.floor((F.col("m") - 1) / 5) + 1, "kind": F.lit("normal"), "volume": F.lit(100.0), "code": F.lit("GOOD"), "status": F.lit("VALID"), "load_hours": F.lit(0)}
    )
    seeded = grid.withColumns(
        {
            "volume": F.when(inside("outage"), 0.0).when(inside("negative"), -5.0).when(~inside("null"), F.col("volume")),
            "code": F.when(inside("outage") | inside("stale"), "STALE").when(inside("bad_code"), "BAD_CODE_X").otherwise("GOOD"),
            "status": F.when(inside("outage"), "NO_SIGNAL").when(inside("late"), "LATE_ARRIVAL").when(inside("stale"), "STALE").when(inside("mismatch"), "FACILITY_MISMATCH")
            .when(inside("bad_code"), "INVALID_QUALITY_CODE").when(inside("null"), "NULL_VOLUME").when(inside("negative"), "NEGATIVE_VOLUME").otherwise("VALID"),
            "facility": F.when(inside("mismatch"), 1).otherwise(F.col("facility")),
            "load_hours": F.when(inside("late"), 36).otherwise(0),
        }
    )
    copies = seeded.where(inside("copied")).withColumns({"kind": F.lit("copy"), "status": F.lit("DUPLICATE_RETRY")})
    shared = {"volume": F.lit(100.0), "code": F.lit("GOOD"), "load_hours": F.lit(0)}
    unknown = hours(spark, 998, 2, "2026-04-20", 8, 7).withColumns({"facility": F.lit(5), "kind": F.lit("unknown"), "status": F.lit("INVALID_METER")} | shared)
    future = hours(spark, 6, 3, "2026-06-03", 1, 4).withColumns({"facility": F.lit(2), "kind": F.lit("future"), "status": F.lit("FUTURE_DATE")} | shared)
    everything = seeded.unionByName(copies).unionByName(unknown).unionByName(future)
    stamp = "yyyy-MM-dd'T'HH:mm:ss"
    text = everything.select(
        F.concat_ws("-", F.lit("RAW"), "kind", "m", F.date_format("ts", "MMddHH")).alias("raw_reading_id"),
        F.format_string("MTR-%03d", "m").alias("meter_id"),
        F.format_string("FAC-%03d", F.col("facility").cast("int")).alias("facility_id"),
        F.date_format("ts", stamp).alias("reading_timestamp"),
        F.date_format("ts", "yyyy-MM-dd").alias("production_date"),
        F.date_format("ts", "yyyy-MM-dd").alias("gas_day"),
        F.date_format("ts", stamp).alias("poll_timestamp"),
        F.lit("SRC").alias("source_system"), F.lit("PLATFORM").alias("polling_platform"),
        F.col("volume").cast("string").alias("volume"), F.lit("780").alias("pressure"), F.lit("72").alias("temperature"),
        F.col("code").alias("quality_code"), F.col("status").alias("raw_status"),
        F.date_format(F.col("ts") + F.make_dt_interval(hours=F.col("load_hours")), stamp).alias("load_timestamp"),
        F.concat(F.lit("B-"), F.date_format("ts", "yyyyMMddHH")).alias("batch_id"),
    )
    return text.select(*source_columns(SPECS["raw_polling_readings"]))


def text_table(spark, name, columns, count):
    """A table of ``count`` text rows with the given expressions of ``id``."""
    wanted = source_columns(SPECS[name])
    return spark.range(1, count + 1).selectExpr(*[f"cast({columns.get(c, 'NULL')} AS string) AS {c}" for c in wanted])


@pytest.fixture(scope="module")
def run(spark):
    raw = text_readings(spark)
    bronze = {
        "raw_polling_readings": raw,
        "facility_master": text_table(spark, "facility_master", {"facility_id": "format_string('FAC-%03d', id)", "facility_name": "concat('Facility ', id)", "region": "'R'", "active_flag": "if(id IN (23, 25), 'N', 'Y')"}, 25),
        "meter_master": text_table(spark, "meter_master", {"meter_id": "format_string('MTR-%03d', id)", "facility_id": "format_string('FAC-%03d', cast(floor((id - 1) / 5) + 1 AS int))", "product": "if(id % 5 < 2, 'GAS', 'NGL')", "active_flag": f"if(id IN {INACTIVE}, 'N', 'Y')"}, 125),
        "flow_computer_extract": text_table(spark, "flow_computer_extract", {"flow_record_id": "id", "meter_id": "format_string('MTR-%03d', cast((id - 1) % 125 + 1 AS int))", "facility_id": "'FAC-001'", "production_date": "date_add(DATE '2026-04-01', cast(floor((id - 1) / 125) AS int))", "measured_volume": "2400", "corrected_volume": "2500", "approved_flag": "'Y'", "close_status": "'closed'"}, 7500),
        "nominations_daily": text_table(spark, "nominations_daily", {"nomination_id": "id", "facility_id": "format_string('FAC-%03d', cast((id - 1) % 25 + 1 AS int))", "production_date": "date_add(DATE '2026-04-01', cast(floor((id - 1) / 25) AS int))", "product": "'GAS'", "nominated_volume": "5000"}, 1500),
        "support_tickets": text_table(spark, "support_tickets", {"ticket_id": "id", "opened_datetime": "'2026-05-01T00:00:00'", "severity": "'High'"}, 350),
        "pipeline_run_log": text_table(spark, "pipeline_run_log", {"run_id": "id", "pipeline_name": "concat('p', id % 5)", "status": "if(id % 5 = 0, 'FAILED', 'SUCCESS')", "started_at": "date_format(TIMESTAMP_NTZ'2026-05-01 00:00:00' + make_dt_interval(0, cast(id AS int)), \"yyyy-MM-dd'T'HH:mm:ss\")", "rows_read": "100", "rows_rejected": "1"}, 150),
        "dq_rules_reference": text_table(spark, "dq_rules_reference", {"rule_id": "id", "active_flag": "'Y'"}, 20),
        "known_issue_scenarios": text_table(spark, "known_issue_scenarios", {"scenario_id": "id", "affected_facility_id": "'FAC-012'", "expected_exception_type": "if(id = 4, 'LATE_ARRIVAL', 'NONE')"}, 15),
    }
    # Device events of the seeded outage, kept as documents.
    readings = standardize_table(raw, "raw_polling_readings")
    docs = events.build_documents(readings.where("raw_status = 'NO_SIGNAL'"), "SEED-1", ingested_at="2026-06-01T00:00:00")
    bronze["meter_polling_events"] = add_bronze_metadata(events.flatten_documents(docs), "run-1")
    expected = {
        "silver.facility_master": 25, "silver.meter_master": 125, "silver.raw_polling_readings": 180_056, "silver.meter_reading_enriched": 180_056,
        "gold.fact_data_quality_exception": 9_055, "gold.quality_rule_summary": 11, "gold.fact_meter_reading_daily": 7_509,
        "gold.exception_summary_daily": 371, "gold.rca_context": 371, "gold.pipeline_health_summary": 5, "gold.fact_pipeline_run": 150,
        "gold.fact_support_ticket": 350, "gold.fact_source_to_target_reconciliation": 8, "gold.fact_facility_volume_daily": 3_003, "silver.known_issue_scenarios": 14,
    }
    return medallion.run_pipeline(spark, bronze, AS_OF, expected=expected)


def test_every_expected_count_is_met(run):
    from plumbline.operators.reconcile import failed_checks

    summary = run.summary()
    assert rows(failed_checks(summary), "table_name", "expected_rows", "written_rows") == [("silver.known_issue_scenarios", 14, 15)]
    assert summary.where("status = 'PASS'").count() == 14
    assert summary.where("status = 'CREATED'").count() == summary.count() - 15


def test_failures_per_rule(spark, run):
    got = {r.exception_type: r.exception_count for r in spark.table("gold.quality_rule_summary").collect()}
    assert got == {
        "INACTIVE_METER_REPORTING": 8_646, "LATE_ARRIVAL": 96, "STALE_READING": 72, "DUPLICATE_READING": 60, "FACILITY_MISMATCH": 44, "ZERO_VOLUME": 36,
        "INVALID_QUALITY_CODE": 36, "NEGATIVE_VOLUME": 21, "NULL_VOLUME": 18, "INVALID_METER": 14, "FUTURE_DATE": 12,
    }
    assert spark.table("silver.meter_reading_exceptions").count() == 8_996
    assert spark.table("silver.meter_reading_valid").count() == 171_060


def test_future_rule_depends_on_as_of_only(spark, run):
    readings = spark.table("silver.raw_polling_readings")
    future = [r for r in rules.READING_RULES if r.exception_type == "FUTURE_DATE"]
    assert rules.failures_only(readings, future, rules.RuleContext(as_of="2026-06-03")).count() == 0


def test_gold_is_consistent(spark, run):
    stages = spark.table("gold.fact_source_to_target_reconciliation").orderBy("stage_order").collect()
    assert [s.row_count for s in stages] == [180_056, 180_056, 180_056, 171_060, 8_996, 7_509, 3_003, 9_055]
    assert stages[3].row_count_delta_from_previous == 171_060 - 180_056
    outage = spark.table("gold.exception_summary_daily").where("exception_type = 'ZERO_VOLUME'").first()
    assert (outage.exception_count, outage.affected_meter_count, outage.device_statuses) == (36, 4, ["NO_SIGNAL"])
    known = spark.table("gold.rca_context").where("scenario_id IS NOT NULL").collect()
    assert [(k.exception_type, k.facility_id) for k in known] == [("LATE_ARRIVAL", "FAC-012")]
    mismatch = spark.table("gold.fact_flow_reconciliation_daily").where("meter_id = 'MTR-086' AND production_date = DATE '2026-05-15'")
    assert mismatch.count() == 2 and mismatch.where("flow_corrected_volume = 2500").count() == 2
    day = spark.table("gold.fact_actual_vs_nominated_daily").where("facility_id = 'FAC-001' AND production_date = DATE '2026-04-02' AND product = 'GAS'").first()
    assert (day.actual_volume, day.nominated_volume, day.actual_vs_nominated_delta) == (2 * 2400.0, 5000.0, -200.0)


def test_scenario_window_finds_the_seeded_rows(spark, run):
    from datetime import datetime

    scenarios = spark.createDataFrame([("S4", ";".join(f"MTR-{m:03d}" for m in range(56, 60)), datetime(2026, 4, 26), datetime(2026, 4, 26, 23))], "scenario_id string, affected_meter_ids string, start_datetime timestamp_ntz, end_datetime timestamp_ntz")
    assert enrich.tag_scenarios(spark.table("silver.raw_polling_readings"), scenarios).count() == 96


def day_files(spark, table):
    place = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first().data_type.removeprefix("file:")
    return {(d.rsplit("=", 1)[-1], f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(place) for f in names if f.endswith(".parquet")}


def test_late_rows_rebuild_their_day_only(spark, run):
    """Runs last: it changes the stored tables."""
    from datetime import date

    day, names = date(2026, 4, 20), medallion.DAILY_FACTS
    counted = lambda: {t: rows(spark.table(f"gold.{t}").where(F.col("production_date") != F.lit(day)).agg(F.count("*"), F.bit_xor(F.xxhash64("production_date")))) for t in names}
    before, files, rest = counted(), {t: day_files(spark, f"gold.{t}") for t in names}, spark.table("gold.fact_meter_reading_daily").count()
    old = spark.table("gold.fact_meter_reading_daily").where((F.col("production_date") == F.lit(day)) & (F.col("meter_id") == "MTR-001")).first()
    enriched = spark.table("silver.meter_reading_enriched").where((F.col("production_date") == F.lit(day)) & (F.col("meter_id") == "MTR-001")).limit(1)
    late = enriched.withColumns({"raw_reading_id": F.lit("RAW-late"), "volume": F.lit(1000.0)})
    late.select(*spark.table("silver.meter_reading_enriched").columns).write.mode("append").insertInto("silver.meter_reading_enriched")
    spark.catalog.refreshTable("silver.meter_reading_enriched")
    medallion.refresh_days(spark, [day], AS_OF)
    new = spark.table("gold.fact_meter_reading_daily").where((F.col("production_date") == F.lit(day)) & (F.col("meter_id") == "MTR-001")).first()
    assert (new.hourly_reading_count, new.raw_volume_sum) == (old.hourly_reading_count + 1, old.raw_volume_sum + 1000.0)
    assert spark.table("gold.fact_meter_reading_daily").count() == rest and counted() == before
    for t in names:
        now = day_files(spark, f"gold.{t}")
        others = {k: at for k, at in files[t].items() if k[0] != str(day)}
        assert others and others.items() <= now.items() and {k[0] for k in now.keys() - others.keys()} <= {str(day)}
    medallion.refresh_days(spark, [], AS_OF)
