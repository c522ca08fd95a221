"""The registered queries against their SQL on an independent engine.

A selection runs by default; PLUMBLINE_ALL_QUERIES=1 runs every query.
"""

from __future__ import annotations

import math
import os

import pytest

from plumbline.plans import catalogue, oracle

duckdb = pytest.importorskip("duckdb")
pd = pytest.importorskip("pandas")

FOLDER = os.environ.get("PLUMBLINE_DATA", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
SELECTED = (
    "event_flatten", "bronze_record_hash", "standardize_table", "record_hash", "dq_stale", "dq_duplicate_grain", "dq_record_status",
    "exception_explode", "join_enrich", "scenario_interval_join", "calendar_densify", "related_context_fallback", "related_exceptions",
    "meter_daily", "facility_daily", "actual_vs_nominated", "flow_reconciliation", "pipeline_health", "exception_summary_daily",
    "reconciliation_deltas", "anomaly_plus_sample", "event_upsert", "align_to_target", "view_support_exception_backlog",
    "reliability_overview", "rca_packet", "triage_upsert", "dedupe_by_key",
)
CHOSEN = sorted(catalogue.QUERIES) if os.environ.get("PLUMBLINE_ALL_QUERIES") else SELECTED

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def canonical(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool) or type(value).__name__ == "bool":
        return str(bool(value))
    if isinstance(value, (int, float)):
        return float(value) + 0.0
    return str(pd.Timestamp(value)) if hasattr(value, "isoformat") else str(value)


def table_of(df):
    columns = sorted(df.columns)
    rows = zip(*[[canonical(v) for v in df[c].tolist()] for c in columns])
    return columns, sorted(rows, key=lambda r: [(x is not None, str(x)) for x in r])


def test_every_query_has_sql():
    assert set(oracle.statements()) == set(catalogue.QUERIES)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_sql(spark, engine, name):
    got = table_of(catalogue.run(name, spark, FOLDER).toPandas())
    expected = table_of(engine.execute(oracle.statement(name)).df())
    assert got[0] == expected[0]
    assert got[1] == expected[1]
