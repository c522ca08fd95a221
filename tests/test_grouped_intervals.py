from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F

from plumbline.operators import enrich, facts, summaries
from plumbline.operators.grouped import summarize


def test_groups_counts_and_sets(spark):
    data = [
        ("a", None, 1.0, "x", "r1"), ("a", None, 2.0, "x", "r1"), ("a", None, None, None, None), (None, "a", 4.0, "y", "r2"),
        (None, None, 5.0, "z", "r3"), ("a", "b", 6.0, "b", "r1"), ("a", "b", 7.0, "a", "r2"), ("", "", None, None, None),
    ]
    df = spark.createDataFrame(data, "k string, j string, v double, code string, rid string")
    got = summarize(df, ["k", "j"], [F.count("*").alias("n"), F.sum("v").alias("v")], ["v"], distinct={"ids": "rid", "codes": "code"}, sets={"all": "code"})
    assert got.columns == ["k", "j", "n", "v", "all", "ids", "codes"]
    assert rows(got) == sorted(
        [(None, None, 1, 5.0, ["z"], 1, 1), (None, "a", 1, 4.0, ["y"], 1, 1), ("", "", 1, None, [], 0, 0), ("a", None, 3, 3.0, ["x"], 1, 1), ("a", "b", 2, 13.0, ["a", "b"], 2, 2)],
        key=lambda r: tuple((x is not None, str(x)) for x in r))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_groups_of_nothing_and_one_group_with_most_rows(spark):
    empty = spark.createDataFrame([], "k string, v double, code string")
    assert summarize(empty, ["k"], [F.count("*").alias("n")], [], distinct={"c": "code"}, sets={"s": "code"}).collect() == []
    many = spark.range(20_000).select(F.when(F.col("id") < 19_000, "hot").otherwise(F.col("id").cast("string")).alias("k"), (F.col("id") % 7).alias("code"), "id")
    got = summarize(many, ["k"], [F.count("*").alias("n")], [], distinct={"ids": "id", "codes": "code"}).where("k = 'hot'").first()
    assert (got.n, got.ids, got.codes) == (19_000, 19_000, 7)


def test_measures_alone_are_one_pass(spark):
    df = spark.range(0, 1000, 1, 3).selectExpr("cast(id % 40 AS string) AS k", "id", "cast(id % 3 AS string) AS code")
    got = summarize(df, ["k"], [F.count("*").alias("n")], [], distinct={"ids": "id"}, sets={"all": "code"}).select("k", "n")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Range (") == 1
    assert rows(got) == sorted((str(k), 25) for k in range(40))


def test_facility_days_store_no_checked_readings(spark):
    from plumbline.plans.bindings import Domain

    d = Domain(spark, "/root/testdata/sf0.001")
    assert d.facility_days.count() > 0 and d.flow_reconciliation.count() > 0
    assert "checked" not in d._stored


def test_no_fact_expands_its_rows():
    import inspect

    for fn in (facts.meter_daily, summaries.exception_summary_daily):
        assert "count_distinct" not in inspect.getsource(fn)


@pytest.mark.parametrize("width", [None, 60, 10**9])
def test_intervals_against_all_pairs(spark, width):
    rnd = random.Random(9)
    base = datetime(2024, 1, 1)
    moment = lambda: base + timedelta(minutes=rnd.randint(-3000, 3000))
    points = [(i, rnd.choice(["m1", "m2", None]), moment() if rnd.random() < 0.95 else None) for i in range(200)]
    spans = [(i, rnd.choice(["m1", "m2", "m3", None]), moment(), moment()) for i in range(40)]
    spans += [(100, "m1", None, base), (101, "m1", base, None), (102, "m2", points[3][2], points[3][2]), (103, "m1", base - timedelta(days=2), base + timedelta(days=2))]
    spans += [(104, "m1", base, base), (104, "m1", base, base)]
    want = sorted((p, s) for p, k, at in points for s, key, a, b in spans if at and k and k == key and a and b and a <= at <= b)
    left = spark.createDataFrame(points, "id int, meter string, at timestamp_ntz")
    right = spark.createDataFrame(spans, "span int, meter string, start timestamp_ntz, stop timestamp_ntz")
    got = enrich.join_intervals(left, right, "meter", "at", "start", "stop", width)
    assert sorted((r.id, r.span) for r in got.collect()) == want
    assert got.columns == ["meter", "id", "at", "span"]


def test_buckets_stay_few_whatever_the_lengths(spark):
    start = datetime(1990, 1, 1)
    spans = [(datetime(2024, 1, 1), datetime(2024, 1, 1, 1))] * 50 + [(start, datetime(2090, 1, 1))]
    df = spark.createDataFrame(spans, "a timestamp_ntz, b timestamp_ntz")
    width = enrich.bucket_seconds(df, "a", "b")
    assert sum((b - a).total_seconds() / width + 2 for a, b in spans) <= (enrich.BUCKETS_PER_INTERVAL + 2) * len(spans)
    assert enrich.bucket_seconds(df.limit(0), "a", "b") == enrich.LEAST_BUCKET_SECONDS


def test_facet_cube_answers_options_and_counts(spark):
    data = [("2024-01-01", "High", " a "), ("2024-01-01", "High", None), ("2024-01-02", None, ""), (None, "Low", "b"), ("2024-01-02", "Low", "b")]
    df = spark.createDataFrame(data, "production_date string, severity string, kind string")
    facets = ["severity", "kind"]
    cube = summaries.facet_cube(df, facets)
    assert rows(summaries.options_of(cube)) == rows(summaries.filter_options(df, facets))
    assert rows(summaries.distributions_of(cube, facets)) == rows(summaries.distributions(df, facets))
    day = F.col("production_date") == "2024-01-02"
    assert rows(summaries.distributions_of(cube.where(day), facets)) == rows(summaries.distributions(df.where(day), facets))
    assert rows(cube.where("facet IS NULL"), "production_date", "row_count") == [(None, 1), ("2024-01-01", 2), ("2024-01-02", 2)]
    assert summaries.facet_cube(df.limit(0), facets).collect() == []
