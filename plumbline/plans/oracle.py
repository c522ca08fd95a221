"""Plain SQL for the queries of ``catalogue``, for an independent engine.

Written directly against the test tables: common table expressions per domain
table, and one final SELECT per query. ``statements`` puts both together.
"""

from __future__ import annotations

import re

from plumbline.operators import events, investigate, publish, rca, reconcile, rules
from plumbline.operators.facts import FACILITY_DAY_KEYS, FLAG_COUNTS, METER_DAY_KEYS
from plumbline.plans import bindings, catalogue, views


def lit(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def rounded(expr: str) -> str:
    """The rounding of ``catalogue.plain``; never a negative zero."""
    return f"CASE WHEN abs({expr}) < 0.00005 THEN CAST(0 AS DOUBLE) ELSE round({expr} + {catalogue.NUDGE:.9f}, {catalogue.ROUND}) END"


def listed(values) -> str:
    return ", ".join(lit(v) for v in values)


def values_rows(rows) -> str:
    return ", ".join("(" + listed(row) + ")" for row in rows)


def joined_set(column: str) -> str:
    return f"coalesce(string_agg(DISTINCT {column}, ', ' ORDER BY {column}), '')"


def case_context(field: str) -> str:
    branches = "".join(
        f" WHEN kind = {lit(name)} THEN {lit(case[field])}" for name, case in events.CONTEXT_CASES if field in case
    )
    return f"CASE{branches} ELSE {lit(events.CONTEXT_DEFAULTS[field])} END AS {field}"


ACCEPTED = listed(rules.ACCEPTED_QUALITY_CODES)
FLAGS = [r.flag for r in rules.READING_RULES]
FLAG_OF = {r.exception_type: r.flag for r in rules.READING_RULES}

# Predicates of the eleven reading rules, in SQL.
FLAG_SQL = {
    "dq_null_volume": "volume IS NULL",
    "dq_zero_volume": "volume = 0 AND master_meter_is_active",
    "dq_negative_volume": "volume < 0",
    "dq_future_date": f"production_date > DATE '{bindings.AS_OF}'",
    "dq_invalid_meter": "master_meter_id IS NULL",
    "dq_inactive_meter_reporting": "master_meter_id IS NOT NULL AND master_meter_is_active = false",
    "dq_facility_mismatch": "source_facility_id IS NOT NULL AND master_facility_id IS NOT NULL AND source_facility_id <> master_facility_id",
    "dq_invalid_quality_code": f"NOT coalesce(quality_code IN ({ACCEPTED}), false)",
    "dq_late_arrival": "load_timestamp > reading_timestamp + INTERVAL 24 HOUR",
    "dq_stale_reading": "coalesce(quality_code = 'STALE', false) OR coalesce(raw_status = 'STALE', false) OR coalesce(event_quality_code = 'STALE', false) OR coalesce(event_raw_status = 'STALE', false)",
    "dq_duplicate_meter_timestamp": "duplicate_meter_timestamp_count > 1",
}

CTES: dict[str, str] = {}

CTES["ev"] = "SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k, date_trunc('hour', ts) AS hour FROM events"

CTES["readings"] = """
SELECT 'RAW-' || printf('%09d', event_id) AS raw_reading_id,
       CASE WHEN k = 88 THEN 'MTX-' ELSE 'MTR-' END || printf('%05d', user_id) AS meter_id,
       'FAC-' || lpad(CAST((user_id + CASE WHEN k = 97 THEN 1 ELSE 0 END) % 25 AS VARCHAR), 3, '0') AS source_facility_id,
       CASE WHEN event_type = 'error' AND k = 99 THEN NULL ELSE hour END AS reading_timestamp,
       CASE WHEN event_type = 'view' AND k = 98 THEN NULL ELSE CAST(ts AS DATE) END AS production_date,
       CAST(ts AS DATE) AS gas_day,
       CASE WHEN k = 55 THEN NULL ELSE hour + INTERVAL 3 MINUTE END AS poll_timestamp,
       CASE WHEN k = 44 THEN NULL ELSE 'SRC_' || upper(event_type) END AS source_system,
       'PLATFORM_' || CAST(k % 4 AS VARCHAR) AS polling_platform,
       CASE WHEN k IN (7, 17) THEN NULL WHEN k = 11 THEN 0.0 WHEN k = 13 THEN -value ELSE value END AS volume,
       CAST(700 + k * 1.5 AS DOUBLE) AS pressure,
       CAST(60 + k * 0.25 AS DOUBLE) AS temperature,
       CASE WHEN event_type IN ('view', 'click') THEN 'GOOD' WHEN event_type = 'purchase' THEN 'ESTIMATED'
            WHEN event_type = 'signup' THEN 'QUESTIONABLE' WHEN k < 10 THEN 'STALE' WHEN k < 20 THEN 'BAD_CODE_X'
            WHEN k < 25 THEN NULL ELSE 'MISSING' END AS quality_code,
       CASE WHEN k = 7 THEN 'NULL_VOLUME' WHEN k = 13 THEN 'NEGATIVE_VOLUME' WHEN k = 97 THEN 'FACILITY_MISMATCH'
            WHEN k > 97 THEN 'LATE_ARRIVAL' WHEN event_type = 'error' AND k < 5 THEN 'NO_SIGNAL'
            WHEN event_type = 'error' AND k < 10 THEN 'STALE' WHEN event_type = 'signup' THEN 'REVIEW' ELSE 'VALID' END AS raw_status,
       hour + to_minutes(k * 15) AS load_timestamp,
       CASE WHEN k = 66 THEN NULL ELSE 'BATCH-' || strftime(ts, '%Y%m%d') END AS batch_id
FROM ev"""

CTES["meters"] = """
SELECT 'MTR-' || printf('%05d', c_custkey) AS meter_id,
       'FAC-' || lpad(CAST(c_custkey % 25 AS VARCHAR), 3, '0') AS facility_id,
       c_name AS meter_name, 'TYPE_' || CAST(c_nationkey % 5 AS VARCHAR) AS meter_type, c_mktsegment AS product,
       CASE WHEN c_acctbal > 5000 THEN 'CUSTODY_TRANSFER' ELSE 'OPERATIONAL' END AS measurement_type,
       CASE WHEN c_acctbal > 5000 THEN 'Y' ELSE 'N' END AS custody_transfer_flag,
       c_acctbal > 5000 AS is_custody_transfer, 'SRC_MASTER' AS source_system, 'PLATFORM_0' AS polling_platform,
       DATE '2015-01-01' + CAST(c_nationkey * 30 AS INTEGER) AS install_date,
       CASE WHEN c_acctbal < 0 THEN 'N' WHEN c_acctbal < 200 THEN NULL ELSE 'Y' END AS active_flag,
       CASE WHEN c_acctbal < 0 THEN false WHEN c_acctbal < 200 THEN NULL ELSE true END AS is_active,
       CAST(10.5 AS DOUBLE) AS expected_min_volume, CAST(500.25 AS DOUBLE) AS expected_max_volume,
       CAST(60 AS BIGINT) AS sample_interval_minutes
FROM customer"""

CTES["facilities"] = """
SELECT 'FAC-' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS facility_id, n_name AS facility_name, r_name AS region,
       'BASIN_' || CAST(n_regionkey AS VARCHAR) AS basin, 'ST_' || CAST(n_nationkey AS VARCHAR) AS state,
       'ASSET_' || CAST(n_nationkey % 3 AS VARCHAR) AS asset_type, 'OPERATOR_' || CAST(n_nationkey % 4 AS VARCHAR) AS operator,
       CASE WHEN n_nationkey = 23 THEN 'N' ELSE 'Y' END AS active_flag, n_nationkey <> 23 AS is_active,
       DATE '2019-01-01' AS effective_start_date, CAST(NULL AS DATE) AS effective_end_date,
       CAST(n_nationkey + 0.5 AS DOUBLE) AS latitude, CAST(-n_nationkey - 0.25 AS DOUBLE) AS longitude,
       'SRC_MASTER' AS source_system
FROM nation JOIN region ON n_regionkey = r_regionkey"""

CTES["flow"] = """
SELECT 'FLOW-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS flow_record_id,
       'MTR-' || printf('%05d', l_suppkey) AS meter_id,
       'FAC-' || lpad(CAST(l_suppkey % 25 AS VARCHAR), 3, '0') AS facility_id,
       make_date(2024, 1, CAST(day(l_shipdate) AS INTEGER)) AS production_date,
       make_date(2024, 1, CAST(day(l_shipdate) AS INTEGER)) AS gas_day,
       CASE WHEN l_discount = 0 THEN 0.0 ELSE l_quantity END AS measured_volume,
       l_quantity * (1 + l_tax) AS corrected_volume,
       CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS estimated_flag, l_returnflag = 'R' AS is_estimated,
       CASE l_returnflag WHEN 'A' THEN 'VALIDATED' WHEN 'N' THEN 'PENDING_APPROVAL' ELSE 'CORRECTED' END AS validation_status,
       CASE WHEN l_returnflag = 'R' THEN 'FLOW_MISMATCH' END AS exception_code,
       CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS approved_flag, l_linestatus = 'F' AS is_approved,
       CASE WHEN l_linestatus = 'F' THEN 'CLOSED' ELSE 'OPEN' END AS close_status,
       'FB-' || strftime(l_shipdate, '%d') AS flow_batch_id,
       make_date(2024, 1, CAST(day(l_shipdate) AS INTEGER)) + INTERVAL 6 HOUR AS extracted_timestamp,
       make_date(2024, 1, CAST(day(l_shipdate) AS INTEGER)) + INTERVAL 7 HOUR AS last_updated_timestamp
FROM lineitem"""

CTES["nominations"] = """
SELECT 'NOM-' || CAST(o_orderkey AS VARCHAR) AS nomination_id,
       'FAC-' || lpad(CAST(o_custkey % 25 AS VARCHAR), 3, '0') AS facility_id,
       make_date(2024, 1, CAST(day(o_orderdate) AS INTEGER)) AS production_date, c_mktsegment AS product,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN NULL WHEN o_custkey % 25 = 7 THEN 0.0 ELSE o_totalprice END AS nominated_volume,
       o_orderpriority AS customer_group, 'CONTRACT_' || o_orderstatus AS contract_type, upper(o_orderstatus) AS status
FROM orders JOIN customer ON o_custkey = c_custkey"""

CTES["sized"] = """
SELECT *, CASE WHEN CAST(floor(o_totalprice) AS BIGINT) % 50 = 0 THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) END AS rows_read FROM orders"""

CTES["runs"] = """
SELECT 'RUN-' || printf('%09d', o_orderkey) AS run_id, o_orderpriority AS pipeline_name, 'orders.csv' AS source_file,
       o_orderdate AS started_at, o_orderdate + to_seconds(rows_read % 7200) AS completed_at,
       CASE WHEN o_orderstatus = 'F' THEN 'FAILED' WHEN o_orderstatus = 'P' THEN 'PARTIAL_SUCCESS' WHEN rows_read > 300000 THEN 'RETRY_SUCCESS' ELSE 'SUCCESS' END AS status,
       rows_read, rows_read - rejected AS rows_accepted, rejected AS rows_rejected,
       CAST(CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'P' THEN 0 END AS BIGINT) AS error_count,
       CAST(o_orderkey % 5 AS BIGINT) AS warning_count,
       CASE WHEN o_orderstatus = 'F' THEN 'Load failed' END AS error_message, 'SCHEDULED' AS trigger_type, 'DEV' AS environment
FROM (SELECT *, CAST(CASE o_orderstatus WHEN 'F' THEN rows_read // 10 WHEN 'P' THEN rows_read // 100 ELSE 0 END AS BIGINT) AS rejected FROM sized)"""

CTES["tickets"] = """
SELECT 'TKT-' || printf('%09d', o_orderkey) AS ticket_id, o_orderdate AS opened_datetime,
       CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_days(CAST(o_orderkey % 40 AS INTEGER)) END AS closed_datetime,
       'SYS_' || CAST(o_custkey % 3 AS VARCHAR) AS system_name, 'ISSUE_' || o_orderstatus AS issue_type,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Critical' WHEN '2-HIGH' THEN 'High' WHEN '3-MEDIUM' THEN 'Medium' WHEN '5-LOW' THEN 'Low' ELSE 'sev2' END AS severity,
       'FAC-' || lpad(CAST(o_custkey % 25 AS VARCHAR), 3, '0') AS facility_id,
       'MTR-' || printf('%05d', o_custkey) AS meter_id,
       'TEAM_' || CAST(o_custkey % 4 AS VARCHAR) AS reported_by_team,
       CASE WHEN o_orderstatus = 'O' THEN 'Open' ELSE 'Closed' END AS ticket_status, 'Reporting delayed' AS business_impact,
       'CAUSE_' || CAST(o_orderkey % 6 AS VARCHAR) AS root_cause_category, CAST(NULL AS VARCHAR) AS resolution_summary,
       'BATCH-' || strftime(o_orderdate, '%Y%m%d') AS related_batch_id, CAST(NULL AS VARCHAR) AS related_exception_code
FROM orders"""

CTES["scenarios"] = f"""
SELECT scenario_id, scenario_name, description, affected_facility_id, affected_meter_ids,
       CAST(start_datetime AS TIMESTAMP) AS start_datetime, CAST(end_datetime AS TIMESTAMP) AS end_datetime,
       expected_exception_type, expected_root_cause, nullif(recommended_next_step, '') AS recommended_next_step
FROM (VALUES {values_rows(bindings.scenario_rows())}) AS s(scenario_id, scenario_name, description, affected_facility_id,
      affected_meter_ids, start_datetime, end_datetime, expected_exception_type, expected_root_cause, recommended_next_step)"""

CTES["catalogue"] = f"""
SELECT rule_id, rule_name, layer, owner_team, upper(trim(active_flag)) = 'Y' AS is_active
FROM (VALUES {values_rows(bindings.catalogue_rows())}) AS c(rule_id, rule_name, layer, field_name, rule_type,
      condition_description, severity, business_reason, owner_team, active_flag)"""

# Kind of anomaly in order of precedence, then the fields it sets.
KINDS = f"""CASE WHEN raw_status = 'NO_SIGNAL' THEN 'NO_SIGNAL'
       WHEN raw_status = 'STALE' OR quality_code = 'STALE' THEN 'STALE'
       WHEN raw_status = 'LATE_ARRIVAL' THEN 'LATE_ARRIVAL' WHEN raw_status = 'DUPLICATE_RETRY' THEN 'DUPLICATE_RETRY'
       WHEN raw_status = 'INVALID_METER' THEN 'INVALID_METER'
       WHEN raw_status = 'INVALID_QUALITY_CODE' OR NOT coalesce(quality_code IN ({ACCEPTED}), false) THEN 'INVALID_QUALITY_CODE'
       WHEN raw_status = 'NULL_VOLUME' OR volume IS NULL THEN 'NULL_VOLUME'
       WHEN raw_status = 'NEGATIVE_VOLUME' THEN 'NEGATIVE_VOLUME' WHEN raw_status = 'FACILITY_MISMATCH' THEN 'FACILITY_MISMATCH'
       WHEN raw_status = 'FUTURE_DATE' THEN 'FUTURE_DATE' ELSE 'NORMAL' END"""
SCENARIO = "CASE raw_status " + " ".join(
    f"WHEN {lit(k)} THEN {lit(v)}" for k, v in events.SCENARIO_OF_STATUS.items()
) + " END"
CONTEXT = ", ".join(case_context(f) for f in events.CONTEXT_DEFAULTS)

CTES["device_readings"] = "SELECT * FROM readings"
CTES["docs"] = f"""
SELECT *, {CONTEXT}, {SCENARIO} AS scenario_id FROM (
  SELECT *, {KINDS} AS kind FROM (
    SELECT *, 'EVT-' || raw_reading_id AS event_id, '{bindings.FIRST_BATCH}' AS seed_batch_id,
           TIMESTAMP '2024-02-01 00:00:00' AS ingested_at FROM device_readings
    UNION ALL
    SELECT * REPLACE ('STALE' AS raw_status), 'EVT-' || raw_reading_id || '-R1', '{bindings.RETRY_BATCH}',
           TIMESTAMP '2024-02-01 01:00:00' FROM device_readings WHERE pressure < 704))"""

CTES["ctx"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY raw_reading_id ORDER BY ingested_at DESC, event_id DESC) AS rn FROM docs) WHERE rn = 1"""

CTES["enriched"] = """
SELECT r.*, m.meter_id AS master_meter_id, m.facility_id AS master_facility_id, m.meter_name AS master_meter_name,
       m.meter_type AS master_meter_type, m.product AS master_product, m.measurement_type AS master_measurement_type,
       m.is_custody_transfer AS master_is_custody_transfer, m.install_date AS master_install_date,
       m.active_flag AS master_meter_active_flag, m.is_active AS master_meter_is_active,
       f.facility_name AS master_facility_name, f.region AS master_region, f.basin AS master_basin, f.state AS master_state,
       f.asset_type AS master_asset_type, f.operator AS master_operator, f.latitude AS master_latitude,
       coalesce(d.n, 1) AS duplicate_meter_timestamp_count,
       c.event_id, c.quality_code AS event_quality_code, c.raw_status AS event_raw_status,
       c.device_status AS event_device_status, c.communication_status AS event_communication_status,
       c.battery_status AS event_battery_status, c.polling_error_code AS event_polling_error_code,
       c.signal_quality AS event_signal_quality, CAST(c.retry_count AS BIGINT) AS event_retry_count,
       CASE WHEN c.event_id IS NOT NULL THEN 'meter_event_v1' END AS event_payload_schema_version,
       c.seed_batch_id AS event_seed_batch_id, c.scenario_id AS event_scenario_id
FROM readings r
LEFT JOIN (SELECT meter_id, reading_timestamp, count(*) AS n FROM readings GROUP BY ALL) d
       ON r.meter_id = d.meter_id AND r.reading_timestamp = d.reading_timestamp
LEFT JOIN ctx c ON r.raw_reading_id = c.raw_reading_id
LEFT JOIN meters m ON r.meter_id = m.meter_id
LEFT JOIN facilities f ON m.facility_id = f.facility_id"""

CTES["flagged"] = "SELECT *, " + ", ".join(f"coalesce({FLAG_SQL[f]}, false) AS {f}" for f in FLAGS) + " FROM enriched"

PRIMARY = "CASE " + " ".join(f"WHEN {FLAG_OF[t]} THEN '{t}'" for t in rules.PRIMARY_TYPE_ORDER) + " END"
CTES["checked"] = f"""
SELECT *, CASE WHEN dq_has_exception THEN 'EXCEPTION'
       WHEN coalesce(quality_code <> 'GOOD', false) OR coalesce(raw_status <> 'VALID', false)
         OR coalesce(event_device_status IN ({listed(rules.DEVICE_FAULTS)}), false)
         OR coalesce(event_communication_status IN ({listed(rules.COMMUNICATION_FAULTS)}), false) THEN 'REVIEW' ELSE 'VALID' END AS record_quality_status
FROM (SELECT *, CAST({' + '.join(f'CAST({f} AS INTEGER)' for f in FLAGS)} AS BIGINT) AS dq_exception_count,
             ({' OR '.join(FLAGS)}) AS dq_has_exception, {PRIMARY} AS primary_exception_type FROM flagged)"""

EXC_COLS = ", ".join(rules.EXCEPTION_DETAIL_COLUMNS)
CTES["exceptions"] = "\nUNION ALL\n".join(
    f"SELECT sha256(concat_ws('||', {lit(r.rule_id)}, raw_reading_id, meter_id, CAST(reading_timestamp AS VARCHAR))) AS exception_id, "
    f"{lit(r.rule_id)} AS rule_id, {lit(r.exception_type)} AS exception_type, {lit(r.severity)} AS severity, {lit(r.reason)} AS business_reason, "
    f"{EXC_COLS}, TIMESTAMP '{bindings.DETECTED_AT}' AS detected_at FROM checked WHERE {r.flag}"
    for r in rules.READING_RULES
)

CTES["exc_fact"] = f"""
SELECT * EXCLUDE (master_facility_id, master_facility_name, master_region, master_basin),
       master_facility_id AS facility_id, master_facility_name AS facility_name, master_region AS region, master_basin AS basin,
       'New' AS exception_status, CAST(NULL AS VARCHAR) AS assigned_to, CAST(NULL AS VARCHAR) AS analyst_notes,
       CAST(DATE '{bindings.AS_OF}' - production_date AS BIGINT) AS days_since_production_date
FROM exceptions"""

CTES["measures"] = """
SELECT *, coalesce(master_facility_id, source_facility_id) AS reporting_facility_id,
       record_quality_status = 'VALID' AS is_valid_record, record_quality_status = 'REVIEW' AS is_review_record,
       record_quality_status = 'EXCEPTION' AS is_exception_record,
       CASE WHEN record_quality_status = 'VALID' AND volume >= 0 THEN volume ELSE 0.0 END AS valid_volume,
       CASE WHEN record_quality_status IN ('VALID', 'REVIEW') AND volume >= 0 THEN volume ELSE 0.0 END AS accepted_or_review_volume,
       CASE WHEN volume >= 0 THEN volume ELSE 0.0 END AS all_nonnegative_volume
FROM checked"""

RATES = """exception_reading_count / nullif(CAST(hourly_reading_count AS DOUBLE), 0) AS exception_rate,
       valid_reading_count / nullif(CAST(hourly_reading_count AS DOUBLE), 0) AS valid_record_rate,
       round((1.0 - coalesce(exception_reading_count / nullif(CAST(hourly_reading_count AS DOUBLE), 0), 0.0)) * 100.0, 2) AS reporting_readiness_score,
       exception_reading_count > 0 AS has_data_quality_issue"""

FLAG_COUNT_SQL = ", ".join(f"count(*) FILTER (WHERE {f}) AS {c}" for f, c in zip(FLAGS, FLAG_COUNTS, strict=True))
CTES["meter_days"] = f"""
SELECT *, {RATES} FROM (
  SELECT {', '.join(METER_DAY_KEYS)}, count(*) AS hourly_reading_count,
         count(*) FILTER (WHERE is_valid_record) AS valid_reading_count, count(*) FILTER (WHERE is_review_record) AS review_reading_count,
         count(*) FILTER (WHERE is_exception_record) AS exception_reading_count,
         sum(valid_volume) AS valid_volume, sum(accepted_or_review_volume) AS accepted_or_review_volume,
         sum(all_nonnegative_volume) AS all_nonnegative_volume, sum(coalesce(volume, 0.0)) AS raw_volume_sum,
         avg(pressure) AS avg_pressure, avg(temperature) AS avg_temperature,
         min(reading_timestamp) AS first_reading_timestamp, max(reading_timestamp) AS last_reading_timestamp,
         min(poll_timestamp) AS first_poll_timestamp, max(poll_timestamp) AS last_poll_timestamp,
         max(load_timestamp) AS latest_load_timestamp, count(DISTINCT batch_id) AS batch_count,
         count(DISTINCT raw_reading_id) AS raw_reading_count, {FLAG_COUNT_SQL},
         max(dq_exception_count) AS max_exception_count_on_reading,
         {joined_set('primary_exception_type')} AS exception_types, {joined_set('quality_code')} AS quality_codes,
         {joined_set('raw_status')} AS raw_statuses, {joined_set('event_device_status')} AS event_device_statuses,
         {joined_set('event_communication_status')} AS event_communication_statuses,
         {joined_set('event_signal_quality')} AS event_signal_qualities
  FROM measures GROUP BY {', '.join(METER_DAY_KEYS)})"""

SUMMED = ("hourly_reading_count", "valid_reading_count", "review_reading_count", "exception_reading_count")
VOLUMES = ("valid_volume", "accepted_or_review_volume", "all_nonnegative_volume", "raw_volume_sum")
CTES["facility_days"] = f"""
SELECT *, {RATES} FROM (
  SELECT {', '.join(FACILITY_DAY_KEYS)}, count(DISTINCT meter_id) AS meter_count,
         {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in (*SUMMED, *FLAG_COUNTS))},
         {', '.join(f'sum({c}) AS {c}' for c in VOLUMES)},
         avg(avg_pressure) AS avg_pressure, avg(avg_temperature) AS avg_temperature,
         min(first_reading_timestamp) AS first_reading_timestamp, max(last_reading_timestamp) AS last_reading_timestamp,
         max(latest_load_timestamp) AS latest_load_timestamp
  FROM meter_days GROUP BY {', '.join(FACILITY_DAY_KEYS)})"""

CTES["nom_days"] = f"""
SELECT facility_id, production_date, product, sum(nominated_volume) AS nominated_volume, count(DISTINCT nomination_id) AS nomination_count,
       {joined_set('customer_group')} AS customer_groups, {joined_set('contract_type')} AS contract_types, {joined_set('status')} AS nomination_statuses
FROM nominations GROUP BY facility_id, production_date, product"""

CTES["avn"] = """
SELECT *, actual_volume - nominated_volume AS actual_vs_nominated_delta,
       (actual_volume - nominated_volume) / nullif(nominated_volume, 0) AS actual_vs_nominated_pct
FROM (SELECT a.reporting_facility_id AS facility_id, a.master_facility_name AS facility_name, a.master_region AS region,
             a.master_basin AS basin, a.master_state AS state, a.production_date, a.master_product AS product,
             a.accepted_or_review_volume AS actual_volume, a.valid_volume, a.exception_rate, a.reporting_readiness_score, a.has_data_quality_issue,
             n.nominated_volume, n.nomination_count, n.customer_groups, n.contract_types, n.nomination_statuses
      FROM facility_days a LEFT JOIN nom_days n ON a.reporting_facility_id = n.facility_id
        AND a.production_date = n.production_date AND a.master_product = n.product)"""

FLOW_AGGS = f"""sum(measured_volume) AS flow_measured_volume, sum(corrected_volume) AS flow_corrected_volume, count(*) AS flow_record_count,
       count(*) FILTER (WHERE is_approved = false) AS unapproved_flow_count, count(*) FILTER (WHERE close_status <> 'CLOSED') AS open_flow_count,
       {joined_set('validation_status')} AS flow_validation_statuses, {joined_set('exception_code')} AS flow_exception_codes,
       max(last_updated_timestamp) AS flow_last_updated_timestamp"""
CTES["flow_days"] = f"SELECT meter_id, facility_id, production_date, {FLOW_AGGS} FROM flow GROUP BY meter_id, facility_id, production_date"

FLOW_COLS = ("flow_measured_volume", "flow_corrected_volume", "flow_record_count", "unapproved_flow_count", "open_flow_count",
             "flow_validation_statuses", "flow_exception_codes", "flow_last_updated_timestamp")
FLOW_LIST = ", ".join(f"f.{c}" for c in FLOW_COLS)
FLOW_DELTA = """flow_corrected_volume - source_accepted_or_review_volume AS corrected_vs_source_delta,
       (flow_corrected_volume - source_accepted_or_review_volume) / nullif(source_accepted_or_review_volume, 0) AS corrected_vs_source_pct"""
CTES["flow_rec"] = f"""
SELECT *, {FLOW_DELTA} FROM (
  SELECT m.meter_id, m.reporting_facility_id, m.master_facility_id, m.master_facility_name, m.master_region, m.master_basin,
         m.production_date, m.master_product AS product, m.accepted_or_review_volume AS source_accepted_or_review_volume,
         m.valid_volume AS source_valid_volume, m.exception_rate, m.reporting_readiness_score, {FLOW_LIST}
  FROM meter_days m LEFT JOIN flow_days f ON m.meter_id = f.meter_id AND m.production_date = f.production_date)"""

CTES["run_fact"] = """
SELECT *, date_diff('second', started_at, completed_at) AS duration_seconds,
       round(date_diff('second', started_at, completed_at) / 60.0, 2) AS duration_minutes,
       rows_accepted / nullif(CAST(rows_read AS DOUBLE), 0) AS accepted_rate, rows_rejected / nullif(CAST(rows_read AS DOUBLE), 0) AS rejected_rate,
       status IN ('SUCCESS', 'RETRY_SUCCESS') AS is_success, status = 'FAILED' AS is_failed, status = 'PARTIAL_SUCCESS' AS is_partial_load,
       coalesce(error_count, 0) > 0 AS has_errors
FROM runs"""

CTES["ticket_fact"] = f"""
SELECT *, closed_datetime IS NULL AS is_open,
       CAST(coalesce(CAST(closed_datetime AS DATE), DATE '{bindings.AS_OF}') - CAST(opened_datetime AS DATE) AS BIGINT) AS ticket_age_days,
       upper(severity) IN ('HIGH', 'CRITICAL', 'SEV1', 'SEV2') AS is_high_severity
FROM tickets"""

CTES["latest"] = """
SELECT pipeline_name, run_id AS latest_run_id, status AS latest_status, started_at AS latest_run_started_at, completed_at AS latest_run_completed_at,
       duration_minutes AS latest_duration_minutes, rows_read AS latest_rows_read, rows_accepted AS latest_rows_accepted,
       rows_rejected AS latest_rows_rejected, error_message AS latest_error_message
FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_name ORDER BY started_at DESC NULLS LAST, run_id DESC) AS rn FROM run_fact) WHERE rn = 1"""

CTES["health"] = """
SELECT l.*, r.* EXCLUDE (pipeline_name), failed_count / nullif(CAST(run_count AS DOUBLE), 0) AS failure_rate,
       total_rows_rejected / nullif(CAST(total_rows_read AS DOUBLE), 0) AS overall_rejected_rate
FROM latest l JOIN (
  SELECT pipeline_name, count(*) AS run_count, count(*) FILTER (WHERE is_success) AS success_count, count(*) FILTER (WHERE is_failed) AS failed_count,
         count(*) FILTER (WHERE is_partial_load) AS partial_load_count, count(*) FILTER (WHERE has_errors) AS runs_with_errors_count,
         avg(duration_minutes) AS avg_duration_minutes, max(duration_minutes) AS max_duration_minutes,
         CAST(sum(rows_read) AS BIGINT) AS total_rows_read, CAST(sum(rows_accepted) AS BIGINT) AS total_rows_accepted,
         CAST(sum(rows_rejected) AS BIGINT) AS total_rows_rejected
  FROM run_fact GROUP BY pipeline_name) r ON l.pipeline_name = r.pipeline_name"""

GROUP_KEYS = "production_date, facility_id, facility_name, region, basin, exception_type, severity"
CTES["exc_summary"] = f"""
SELECT *, sha256(concat_ws('||', coalesce(CAST(production_date AS VARCHAR), ''), coalesce(facility_id, ''), coalesce(exception_type, ''), coalesce(severity, ''))) AS exception_group_id
FROM (SELECT {GROUP_KEYS}, count(*) AS exception_rule_failure_count, count(DISTINCT exception_id) AS exception_count,
             count(DISTINCT raw_reading_id) AS affected_reading_count, count(DISTINCT meter_id) AS affected_meter_count,
             {joined_set('source_system')} AS source_systems, {joined_set('polling_platform')} AS polling_platforms,
             {joined_set('event_device_status')} AS device_statuses, {joined_set('event_communication_status')} AS communication_statuses,
             {joined_set('event_signal_quality')} AS signal_qualities, min(detected_at) AS first_detected_at, max(detected_at) AS last_detected_at
      FROM exc_fact GROUP BY {GROUP_KEYS})"""

CTES["rca_ctx"] = f"""
SELECT *, concat_ws(' ', 'On', CAST(production_date AS VARCHAR), 'facility', coalesce(facility_id, 'UNKNOWN'), 'has', CAST(exception_count AS VARCHAR),
       'exception records of type', coalesce(exception_type, 'UNKNOWN'), 'with severity', coalesce(severity, 'UNKNOWN'),
       '. Device context:', coalesce(device_statuses_text, 'none'), '. Communication context:', coalesce(communication_statuses_text, 'none'),
       '. Suggested next step:', coalesce(recommended_next_step, {lit(rca.DEFAULT_NEXT_STEP)})) AS rca_summary_seed
FROM (SELECT e.exception_group_id, e.production_date, e.facility_id, e.facility_name, e.region, e.basin, e.exception_type, e.severity,
             e.exception_count, e.affected_reading_count, e.affected_meter_count, e.source_systems AS source_systems_text,
             e.polling_platforms AS polling_platforms_text, e.device_statuses AS device_statuses_text,
             e.communication_statuses AS communication_statuses_text, e.signal_qualities AS signal_qualities_text,
             s.scenario_id, s.scenario_name, s.description AS scenario_description, s.expected_root_cause, s.recommended_next_step
      FROM exc_summary e LEFT JOIN scenarios s ON e.facility_id = s.affected_facility_id AND e.exception_type = s.expected_exception_type)"""

STAGE_SOURCES = ("events", "readings", "checked", "checked WHERE record_quality_status IN ('VALID', 'REVIEW')",
                 "checked WHERE dq_has_exception", "meter_days", "facility_days", "exceptions")
CTES["points"] = "\nUNION ALL\n".join(
    f"SELECT CAST({n} AS BIGINT) AS stage_order, {lit(layer)} AS layer, {lit(name)} AS object_name, {lit(metric)} AS metric_type, "
    f"{lit(note)} AS notes, count(*) AS row_count FROM {source}"
    for n, ((layer, name, metric, note), source) in enumerate(zip(reconcile.STAGES, STAGE_SOURCES, strict=True), start=1)
)
CTES["stages"] = f"""
SELECT *, row_count - previous_row_count AS row_count_delta_from_previous,
       (row_count - previous_row_count) / nullif(CAST(previous_row_count AS DOUBLE), 0) AS row_count_delta_pct_from_previous,
       CASE {' '.join(f"WHEN contains(lower(metric_type), '{p}') THEN {lit(t)}" for p, t in reconcile.INTERPRETATIONS)}
            WHEN contains(lower(object_name), 'exception') THEN {lit(reconcile.EXCEPTION_OBJECT)} ELSE {lit(reconcile.OTHERWISE)} END AS interpretation
FROM (SELECT *, lag(row_count) OVER (ORDER BY stage_order) AS previous_row_count FROM points)"""

CTES["checks"] = """
SELECT run_id AS table_name, nullif(rows_read, 0) AS expected_rows, CASE WHEN warning_count = 0 THEN rows_accepted ELSE rows_read END AS source_rows,
       rows_accepted AS written_rows FROM runs"""
CTES["published"] = """
SELECT *, CASE WHEN source_rows = expected_rows AND written_rows = expected_rows THEN 'PASS'
               WHEN source_rows = written_rows THEN 'WARN_EXPECTED_COUNT_CHANGED' ELSE 'FAIL' END AS status FROM checks"""

CTES["profile"] = f"""
SELECT meter_id, source_facility_id, production_date, coalesce(sum(volume), 0.0) AS measured_volume, count(*) FILTER (WHERE volume IS NULL) AS null_count,
       count(*) FILTER (WHERE volume = 0) AS zero_count, count(*) FILTER (WHERE volume < 0) AS negative_count,
       count(*) FILTER (WHERE quality_code = 'STALE') AS stale_count,
       count(*) FILTER (WHERE NOT coalesce(quality_code IN ({ACCEPTED}), false)) AS bad_quality_count
FROM readings GROUP BY meter_id, source_facility_id, production_date"""


def present(expr: str) -> str:
    text = f"nullif(trim({expr}), '')"
    return f"CASE WHEN lower({text}) NOT IN ('nan', 'nat', 'none', 'null') THEN {text} END"


CTES["raw_reviews"] = """
SELECT strftime(o_orderdate, '%Y-01-01') AS production_date, CASE WHEN o_custkey % 25 = 7 THEN 'none' ELSE 'FAC-' || lpad(CAST(o_custkey % 25 AS VARCHAR), 3, '0') END AS facility_id,
       'Facility' AS facility_name, 'ISSUE_' || o_orderstatus AS exception_type, CASE WHEN o_orderpriority = '5-LOW' THEN ' NaN' ELSE o_orderpriority END AS severity,
       'EX-' || CAST(o_orderkey AS VARCHAR) AS exception_id, CASE o_orderstatus WHEN 'F' THEN 'Resolved' WHEN 'O' THEN 'Ignored' ELSE '' END AS status,
       CASE WHEN o_totalprice > 400000 THEN 'High' ELSE 'null' END AS priority, CASE WHEN o_custkey % 3 = 0 THEN 'nat' ELSE 'analyst_' || CAST(o_custkey % 7 AS VARCHAR) END AS assigned_to,
       CASE WHEN o_totalprice > 250000 THEN ' check totals ' ELSE '' END AS note_text, CASE WHEN o_custkey % 5 = 0 THEN '' ELSE 'user_' || CAST(o_custkey % 5 AS VARCHAR) END AS updated_by,
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds(o_orderkey) AS reviewed_at, o_orderdate
FROM orders"""
CTES["reviews"] = f"""
SELECT concat_ws('|', production_date, coalesce(facility_id, 'unknown_facility'), coalesce(exception_type, 'unknown_exception_type'), coalesce(severity, 'unknown_severity')) AS exception_group_key,
       *, status AS reviewer_decision, note_text AS reviewer_comments, CASE status WHEN 'Resolved' THEN true WHEN 'Ignored' THEN false END AS accepted_flag
FROM (SELECT production_date || 'T00:00:00' AS production_timestamp, production_date, {present('facility_id')} AS facility_id, facility_name, {present('exception_type')} AS exception_type, {present('severity')} AS severity, exception_id,
             coalesce({present('status')}, 'Not reviewed') AS status, coalesce({present('priority')}, 'Medium') AS priority, {present('assigned_to')} AS assigned_to,
             {present('note_text')} AS note_text, coalesce({present('updated_by')}, 'app_user') AS updated_by, reviewed_at, o_orderdate FROM raw_reviews)"""
CTES["triage"] = """
SELECT r.exception_group_key, exception_id, production_timestamp AS production_date, facility_id, facility_name, exception_type, severity, status, priority, assigned_to, updated_by,
       reviewed_at AS updated_at, created_at
FROM (SELECT *, row_number() OVER (PARTITION BY exception_group_key ORDER BY is_new DESC, reviewed_at DESC) AS rn,
             first_value(reviewed_at) OVER (PARTITION BY exception_group_key ORDER BY is_new, reviewed_at) AS created_at
      FROM (SELECT *, o_orderdate >= DATE '1999-01-01' AS is_new FROM reviews)) r WHERE rn = 1"""

# Doubles of the result columns; everything else is compared as it is.
DOUBLES = {
    "volume", "pressure", "temperature", "measured_volume", "corrected_volume", "nominated_volume", "latitude", "longitude",
    "expected_min_volume", "expected_max_volume", "valid_volume", "accepted_or_review_volume", "all_nonnegative_volume",
    "raw_volume_sum", "avg_pressure", "avg_temperature", "exception_rate", "valid_record_rate", "reporting_readiness_score",
    "actual_volume", "actual_vs_nominated_delta", "actual_vs_nominated_pct", "flow_measured_volume", "flow_corrected_volume",
    "source_accepted_or_review_volume", "source_valid_volume", "corrected_vs_source_delta", "corrected_vs_source_pct",
    "duration_minutes", "accepted_rate", "rejected_rate", "latest_duration_minutes", "avg_duration_minutes", "max_duration_minutes",
    "failure_rate", "overall_rejected_rate", "row_count_delta_pct_from_previous", "master_latitude",
    "payload_volume", "payload_pressure", "payload_temperature",
}


def columns(names) -> str:
    return ", ".join(f"{rounded(c)} AS {c}" if c in DOUBLES else c for c in names)


READING_COLS = ("raw_reading_id", "meter_id", "source_facility_id", "reading_timestamp", "production_date", "gas_day", "poll_timestamp",
                "source_system", "polling_platform", "volume", "pressure", "temperature", "quality_code", "raw_status", "load_timestamp", "batch_id")
FLOW_TABLE_COLS = ("flow_record_id", "meter_id", "facility_id", "production_date", "gas_day", "measured_volume", "corrected_volume", "estimated_flag",
                   "is_estimated", "validation_status", "exception_code", "approved_flag", "is_approved", "close_status", "flow_batch_id",
                   "extracted_timestamp", "last_updated_timestamp")
METER_DAY_MEASURES = (*SUMMED, *VOLUMES, "avg_pressure", "avg_temperature", "first_reading_timestamp", "last_reading_timestamp",
                      "first_poll_timestamp", "last_poll_timestamp", "latest_load_timestamp", "batch_count", "raw_reading_count", *FLAG_COUNTS,
                      "max_exception_count_on_reading", "exception_types", "quality_codes", "raw_statuses", "event_device_statuses",
                      "event_communication_statuses", "event_signal_qualities", "exception_rate", "valid_record_rate", "reporting_readiness_score", "has_data_quality_issue")
FACILITY_DAY_COLS = (*FACILITY_DAY_KEYS, "meter_count", *SUMMED, *VOLUMES, *FLAG_COUNTS, "avg_pressure", "avg_temperature", "first_reading_timestamp",
                     "last_reading_timestamp", "latest_load_timestamp", "exception_rate", "valid_record_rate", "reporting_readiness_score", "has_data_quality_issue")
AVN_COLS = ("facility_id", "facility_name", "region", "basin", "state", "production_date", "product", "actual_volume", "valid_volume", "nominated_volume",
            "actual_vs_nominated_delta", "actual_vs_nominated_pct", "nomination_count", "customer_groups", "contract_types", "nomination_statuses",
            "exception_rate", "reporting_readiness_score", "has_data_quality_issue")
FLOW_REC_COLS = ("meter_id", "reporting_facility_id", "master_facility_id", "master_facility_name", "master_region", "master_basin", "production_date", "product",
                 "source_accepted_or_review_volume", "source_valid_volume", *FLOW_COLS, "corrected_vs_source_delta", "corrected_vs_source_pct", "exception_rate", "reporting_readiness_score")
RUN_COLS = ("run_id", "pipeline_name", "source_file", "started_at", "completed_at", "status", "rows_read", "rows_accepted", "rows_rejected", "error_count",
            "warning_count", "error_message", "trigger_type", "environment", "duration_seconds", "duration_minutes", "accepted_rate", "rejected_rate",
            "is_success", "is_failed", "is_partial_load", "has_errors")
HEALTH_COLS = ("pipeline_name", "latest_run_id", "latest_status", "latest_run_started_at", "latest_run_completed_at", "latest_duration_minutes", "latest_rows_read",
               "latest_rows_accepted", "latest_rows_rejected", "latest_error_message", "run_count", "success_count", "failed_count", "partial_load_count",
               "runs_with_errors_count", "avg_duration_minutes", "max_duration_minutes", "total_rows_read", "total_rows_accepted", "total_rows_rejected",
               "failure_rate", "overall_rejected_rate")
EXC_FACT_COLS = ("exception_id", "rule_id", "exception_type", "severity", "business_reason", "raw_reading_id", "meter_id", "source_facility_id", "facility_id",
                 "facility_name", "region", "basin", "reading_timestamp", "production_date", "poll_timestamp", "load_timestamp", "source_system", "polling_platform",
                 "batch_id", "volume", "quality_code", "raw_status", "event_id", "event_device_status", "event_communication_status", "event_battery_status",
                 "event_signal_quality", "event_scenario_id", "primary_exception_type", "detected_at", "exception_status", "assigned_to", "analyst_notes", "days_since_production_date")
SUMMARY_COLS = ("production_date", "facility_id", "facility_name", "region", "basin", "exception_type", "severity", "exception_rule_failure_count", "exception_count",
                "affected_reading_count", "affected_meter_count", "source_systems", "polling_platforms", "device_statuses", "communication_statuses", "signal_qualities",
                "first_detected_at", "last_detected_at", "exception_group_id")
RCA_COLS = views.INVESTIGATION_VIEWS["rca_context"][1]
TICKET_COLS = ("ticket_id", "opened_datetime", "closed_datetime", "system_name", "issue_type", "severity", "facility_id", "meter_id", "reported_by_team", "ticket_status",
               "business_impact", "root_cause_category", "resolution_summary", "related_batch_id", "related_exception_code", "is_open", "ticket_age_days", "is_high_severity")

PAYLOAD_ORDER = ("volume", "pressure", "temperature", "quality_code", "raw_status", *events.CONTEXT_DEFAULTS, "schema_version")


def json_object(fields) -> str:
    """JSON object text with the given (name, expression) pairs, NULLs kept."""
    return "CAST(json_object(" + ", ".join(f"{lit(n)}, {e}" for n, e in fields) + ") AS VARCHAR)"


def payload_pairs(names, as_text: bool):
    out = []
    for n in names:
        expr = "'meter_event_v1'" if n == "schema_version" else n
        out.append((n, f"CAST({expr} AS VARCHAR)" if as_text else expr))
    return out


ISO = "'%Y-%m-%dT%H:%M:%S'"
DOC_TEXT = {
    "event_id": "event_id", "raw_reading_id": "raw_reading_id", "source_system": "source_system", "polling_platform": "polling_platform",
    "meter_id": "meter_id", "facility_id": "source_facility_id", "event_timestamp": f"strftime(reading_timestamp, {ISO})",
    "production_date": "CAST(production_date AS VARCHAR)", "gas_day": "CAST(gas_day AS VARCHAR)", "poll_timestamp": f"strftime(poll_timestamp, {ISO})",
    "load_timestamp": f"strftime(load_timestamp, {ISO})", "payload_type": "'meter_reading'", "raw_message_source": "'plumbline'",
    "source_file": "'raw_polling_readings.csv'", "source_batch_id": "batch_id", "seed_batch_id": "seed_batch_id", "scenario_id": "scenario_id",
    "ingested_at": f"strftime(ingested_at, {ISO})",
}
DOC_JSON = json_object(sorted([*DOC_TEXT.items(), ("payload", f"json_object({', '.join(f'{lit(n)}, {e}' for n, e in payload_pairs(PAYLOAD_ORDER, False))})")]))
TEXT_PAYLOAD = f"json_object({', '.join(f'{lit(n)}, {e}' for n, e in payload_pairs(sorted(PAYLOAD_ORDER), True))})"
STORED_JSON = json_object(sorted([*DOC_TEXT.items(), ("payload", TEXT_PAYLOAD), ("_id", "NULL"), ("last_seed_attempt_at", "NULL"), ("last_seed_batch_id", "NULL")]))
FLAT_COLS = ", ".join(
    [f"{e} AS {n}" for n, e in DOC_TEXT.items()]
    + [f"{rounded(n) if n in ('volume', 'pressure', 'temperature') else ('CAST(' + n + ' AS BIGINT)' if n == 'retry_count' else n)} AS payload_{n}" for n in PAYLOAD_ORDER if n != "schema_version"]
    + ["'meter_event_v1' AS payload_schema_version", "CAST(NULL AS VARCHAR) AS last_seed_attempt_at", "CAST(NULL AS VARCHAR) AS last_seed_batch_id",
       f"CAST({TEXT_PAYLOAD} AS VARCHAR) AS payload_json"]
)

HAS = "contains(upper(coalesce({0}, '')), '{1}')"


def holds(tests, layer: str | None = None) -> str:
    texts = {"device": "device_statuses_text", "communication": "communication_statuses_text", "signal": "signal_qualities_text", "type_word": "exception_type", "layer": layer}
    parts = []
    for what, words in tests.items():
        if what == "type":
            parts.append(f"upper(exception_type) IN ({listed(words)})")
        else:
            parts.extend(HAS.format(texts[what], w) for w in words)
    return "(" + " OR ".join(f"coalesce({p}, false)" for p in parts) + ")"


CTES["explained"] = f"""
SELECT *, CASE {' '.join(f"WHEN {holds(t)} THEN {lit(layer)}" for layer, t in rca.LAYER_RULES)}
       WHEN (SELECT count(*) FROM health WHERE upper(latest_status) IN ({listed(rca.TROUBLED_RUNS)})) > 0 THEN {lit(rca.PIPELINE_LAYER)}
       ELSE {lit(rca.DEFAULT_LAYER)} END AS likely_layer FROM rca_ctx"""

CHECK_TEXT = "concat_ws(', ', " + ", ".join(
    f"CASE WHEN {holds(t, 'likely_layer')} THEN {lit(', '.join(texts))} END" for t, texts in rca.CHECK_RULES
) + ")"
CAUTION_TEXT = f"concat_ws(', ', {lit(', '.join(rca.GENERAL_CAUTIONS))}, " + ", ".join(
    f"CASE WHEN upper(exception_type) IN ({listed(types)}) THEN {lit(text)} END" for types, text in rca.TYPE_CAUTIONS
) + ")"


def shown(c: str) -> str:
    return f"coalesce(nullif(trim(CAST({c} AS VARCHAR)), ''), 'N/A')"


SUMMARY_TEXT = f"""'On ' || {shown('production_date')} || ', facility ' || {shown('facility_id')} || ' (' || {shown('facility_name')} || ') has '
  || format('{{:,}}', exception_count) || ' exception records of type ' || {shown('exception_type')} || ' with severity ' || {shown('severity')}
  || '. The affected set includes approximately ' || format('{{:,}}', affected_reading_count) || ' readings across ' || format('{{:,}}', affected_meter_count)
  || ' meter(s). Device context shows ' || {shown('device_statuses_text')} || '; communication context shows ' || {shown('communication_statuses_text')}
  || '; signal quality context shows ' || {shown('signal_qualities_text')} || '. The first layer to check should be: ' || likely_layer || '.'
  || coalesce(' Known scenario/root-cause context suggests: ' || expected_root_cause || '.', '')
  || coalesce(' Recommended next step: ' || recommended_next_step, '')"""

CTES["ranked_exc"] = """
SELECT *, row_number() OVER (PARTITION BY facility_id, exception_type, production_date ORDER BY meter_id NULLS LAST, exception_id) AS position FROM exc_fact"""

SAMPLE_JSON = "json_object('position', position, " + ", ".join(f"'{f}', {f}" for f in rca.SAMPLE_FIELDS) + ")"
EVIDENCE_TEXTS = ("production_date", "facility_id", "facility_name", "region", "basin", "exception_type", "severity",
                  *[c + "_text" for c in rca.TEXT_SETS], "scenario_id", "scenario_name", "expected_root_cause", "recommended_next_step")
EVIDENCE_JSON = json_object([(c, shown(c)) for c in EVIDENCE_TEXTS] + [(c, c) for c in ("exception_count", "affected_reading_count", "affected_meter_count")])
CONTEXT_JSON = json_object([(c, f"CAST({c} AS VARCHAR)" if c in ("production_date", "reading_timestamp") else c) for c in
                            investigate.CONTEXT_FIELDS])

DIST = ("event_device_status", "event_communication_status", "event_signal_quality", "polling_platform", "severity", "source_system", "production_date")
OPTIONS = ("severity", "exception_type", "region", "facility_id", "source_system", "polling_platform")

Q: dict[str, str] = {}


def simple(name: str, cols, source: str) -> None:
    Q[name] = f"SELECT {columns(cols)} FROM {source}"


Q["event_flatten"] = f"SELECT {FLAT_COLS} FROM docs"
Q["lenient_cast"] = f"""SELECT raw_reading_id, {rounded('volume')} AS volume, CAST(NULL AS DOUBLE) AS status_number,
  CAST(strftime(CASE WHEN k <> 66 THEN ts END, '%Y%m%d') AS BIGINT) AS batch_day FROM readings JOIN ev ON raw_reading_id = 'RAW-' || printf('%09d', event_id)"""
Q["event_to_json"] = "SELECT event_id, " + json_object([
    ("event_id", "event_id"), ("event_timestamp", DOC_TEXT["event_timestamp"]),
    ("payload", f"json_object({', '.join(f'{lit(n)}, {e}' for n, e in payload_pairs(PAYLOAD_ORDER, False))})"),
    ("production_date", "CAST(production_date AS VARCHAR)"), ("scenario_id", "scenario_id")]) + " AS document FROM docs"
Q["batch_filter"] = f"SELECT event_id, raw_reading_id, seed_batch_id, raw_status AS payload_raw_status FROM docs WHERE seed_batch_id = '{bindings.RETRY_BATCH}'"
Q["bronze_record_hash"] = f"SELECT event_id, sha256({STORED_JSON}) AS _record_hash, '{catalogue.RUN_ID}' AS _bronze_run_id, 'event_store' AS _source_type FROM docs"
RECEIVED = f"""SELECT *, CAST(substring(raw_reading_id, 5) AS BIGINT) % 97 AS n, {DOC_JSON} AS line FROM docs"""
SENT = "CASE n WHEN 5 THEN line[1:40] WHEN 6 THEN '[' || line || ']' WHEN 7 THEN '   ' ELSE line END"
WHY = "CASE n WHEN 5 THEN 'BROKEN_JSON' WHEN 6 THEN 'NOT_AN_OBJECT' WHEN 7 THEN 'BLANK_LINE' END"
Q["event_landing"] = f"""SELECT event_id, raw_reading_id, seed_batch_id, line AS raw_document_json, sha256(line) AS _record_hash, quality_code AS payload_quality_code
  FROM ({RECEIVED}) WHERE n NOT IN (5, 6, 7)"""
Q["event_rejects"] = f"SELECT {WHY} AS reject_reason, {SENT} AS raw_document_json, sha256({SENT}) AS _record_hash FROM ({RECEIVED}) WHERE n IN (5, 6, 7)"
Q["event_landing_counts"] = f"""SELECT CASE WHEN n IN (5, 6, 7) THEN 'rejects' ELSE 'documents' END AS route, {WHY} AS reject_reason, count(*) AS line_count
  FROM ({RECEIVED}) GROUP BY ALL"""
Q["dq_payload_received"] = f"SELECT {SENT} AS raw_document_json, {WHY} AS reject_reason FROM ({RECEIVED}) WHERE n IN (5, 7)"
LAYER_STATUS = "CASE WHEN expected_rows IS NULL THEN 'CREATED' WHEN expected_rows = written_rows THEN 'PASS' ELSE 'CHECK' END"
Q["layer_write_status"] = f"SELECT *, {LAYER_STATUS} AS status, CASE WHEN expected_rows IS NULL THEN 'CREATED' WHEN expected_rows = source_rows AND expected_rows = written_rows THEN 'PASS' ELSE 'CHECK' END AS two_sided_status FROM checks"
Q["failed_checks"] = f"SELECT * FROM (SELECT *, {LAYER_STATUS} AS status FROM checks) WHERE status = 'CHECK'"
simple("clean_string", ("raw_reading_id", "meter_id", "source_system", "batch_id"), "readings")
simple("yes_no_flag", ("meter_id", "is_active", "is_custody_transfer"), "meters")
simple("upper_code", ("raw_reading_id", "quality_code", "raw_status"), "readings")
simple("parse_dates", ("raw_reading_id", "reading_timestamp", "production_date", "poll_timestamp"), "readings")
Q["parse_numbers"] = "SELECT run_id, rows_read, error_count, CAST(NULL AS BIGINT) AS message_number, CAST(rows_accepted AS DOUBLE) AS rows_accepted FROM runs"
METER_TABLE_COLS = ("meter_id", "facility_id", "meter_name", "meter_type", "product", "measurement_type", "custody_transfer_flag", "is_custody_transfer",
                    "source_system", "polling_platform", "install_date", "active_flag", "is_active", "expected_min_volume", "expected_max_volume", "sample_interval_minutes")
METER_JSON = json_object([(c, "CAST(install_date AS VARCHAR)" if c == "install_date" else c) for c in sorted(METER_TABLE_COLS)])
Q["record_hash"] = f"SELECT meter_id, '{catalogue.RUN_ID}' AS _silver_run_id, 'meter_master' AS _silver_source, TIMESTAMP '{catalogue.PUBLISHED_AT}' AS _silver_processed_at, sha256({METER_JSON}) AS _silver_record_hash FROM meters"
Q["surrogate_key"] = "SELECT meter_id, sha256(meter_id) AS meter_key, sha256(facility_id) AS facility_key FROM meters"
simple("standardize_table", READING_COLS, "readings")
simple("standardize_flow_extract", FLOW_TABLE_COLS, "flow")
simple("safe_divide", ("run_id", "accepted_rate"), "run_fact")
simple("dq_null", ("raw_reading_id", "meter_id", "production_date"), "flagged WHERE dq_null_volume")
simple("dq_zero_active", ("raw_reading_id", "meter_id", "volume", "master_meter_is_active"), "flagged WHERE dq_zero_volume")
simple("dq_negative", ("raw_reading_id", "meter_id", "volume"), "flagged WHERE dq_negative_volume")
simple("dq_future_date", ("raw_reading_id", "production_date"), "flagged WHERE dq_future_date")
simple("dq_missing_master", ("raw_reading_id", "meter_id", "source_facility_id"), "readings r WHERE NOT EXISTS (SELECT 1 FROM meters m WHERE m.meter_id = r.meter_id)")
simple("dq_inactive_master", ("raw_reading_id", "meter_id", "master_meter_active_flag"), "flagged WHERE dq_inactive_meter_reporting")
simple("dq_ref_mismatch", ("raw_reading_id", "source_facility_id", "master_facility_id"), "flagged WHERE dq_facility_mismatch")
simple("dq_accepted_values", ("raw_reading_id", "quality_code"), "flagged WHERE dq_invalid_quality_code")
simple("dq_late_arrival", ("raw_reading_id", "reading_timestamp", "load_timestamp"), "flagged WHERE dq_late_arrival")
simple("dq_stale", ("raw_reading_id", "quality_code", "raw_status", "event_quality_code", "event_raw_status"), "flagged WHERE dq_stale_reading")
Q["dq_duplicate_grain"] = "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity, copies FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem) WHERE copies > 1"
simple("dq_duplicate_reading", ("raw_reading_id", "meter_id", "reading_timestamp", "duplicate_meter_timestamp_count"), "flagged WHERE dq_duplicate_meter_timestamp")
simple("dq_approved_closed", ("flow_record_id", "meter_id", "is_approved", "close_status"), "flow WHERE NOT (is_approved AND close_status = 'CLOSED')")
simple("dq_correction_variance", ("flow_record_id", "meter_id", "measured_volume", "corrected_volume"),
       "flow WHERE (measured_volume <> 0 AND abs(abs(corrected_volume - measured_volume) / measured_volume) > 0.05) OR (measured_volume = 0 AND corrected_volume <> 0)")
simple("dq_nomination_variance", ("facility_id", "production_date", "product", "actual_volume", "nominated_volume"),
       "avn WHERE (nominated_volume <> 0 AND abs(abs(actual_volume - nominated_volume) / nominated_volume) > 0.1) OR (nominated_volume = 0 AND actual_volume <> 0)")
simple("dq_run_success", ("run_id", "pipeline_name", "status"), "runs WHERE status NOT IN ('SUCCESS', 'RETRY_SUCCESS')")
simple("dq_rejected_threshold", ("run_id", "rows_rejected"), "runs WHERE rows_rejected > 1000")
Q["dq_required_fields"] = """SELECT raw_reading_id, source_system IS NULL AS dq_missing_source_system, batch_id IS NULL AS dq_missing_batch_id, poll_timestamp IS NULL AS dq_missing_poll_timestamp
  FROM readings WHERE source_system IS NULL OR batch_id IS NULL OR poll_timestamp IS NULL"""
Q["dq_payload_preserved"] = "SELECT event_id, CASE WHEN k = 66 THEN substr(props, 1, 4) END AS raw_document_json FROM ev WHERE k IN (44, 66)"
simple("dq_exception_count", ("raw_reading_id", *FLAGS, "dq_exception_count"), "checked")
simple("dq_has_exception", ("raw_reading_id", "dq_has_exception"), "checked")
simple("dq_primary_type", ("raw_reading_id", "primary_exception_type"), "checked")
simple("dq_record_status", ("raw_reading_id", "record_quality_status"), "checked")
simple("split_valid", ("raw_reading_id", "meter_id", "record_quality_status", "volume"), "checked WHERE record_quality_status <> 'EXCEPTION'")
simple("split_exceptions", ("raw_reading_id", "meter_id", "primary_exception_type", "volume"), "checked WHERE dq_exception_count > 0")
simple("exception_explode", ("exception_id", "rule_id", "exception_type", "severity", "business_reason", *rules.EXCEPTION_DETAIL_COLUMNS, "detected_at"), "exceptions")
simple("exception_id", ("raw_reading_id", "rule_id", "exception_id"), "exceptions")
Q["rule_catalogue_join"] = "SELECT exception_id, e.rule_id, rule_name, layer, owner_team FROM exceptions e JOIN catalogue c ON e.rule_id = c.rule_id WHERE is_active"
# The rules as the changed catalogue has them: flag, type, id, severity, reason.
TUNED_SQL = FLAG_SQL | {
    "dq_stale_reading": "false", "dq_late_arrival": "load_timestamp > reading_timestamp + INTERVAL 20 HOUR",
    "dq_negative_volume": "volume < 5", "dq_invalid_quality_code": "NOT coalesce(quality_code IN ('GOOD', 'ESTIMATED'), false)",
    "dq_pressure_high": "pressure > 840",
}
TUNED = [(r.flag, r.exception_type, r.rule_id, "High" if r.flag == "dq_invalid_quality_code" else r.severity, r.reason) for r in rules.READING_RULES]
TUNED.append(("dq_pressure_high", "PRESSURE_HIGH", "DQ_PRESSURE_HIGH", "Low", "Pressure above the range of the device."))
TUNED_PRIMARY = "CASE " + " ".join(
    f"WHEN {flag} THEN '{kind}'" for wanted in (*rules.PRIMARY_TYPE_ORDER, "PRESSURE_HIGH") for flag, kind, *_ in TUNED if kind == wanted) + " END"
Q["rules_from_catalogue"] = "WITH tuned AS (SELECT *, " + TUNED_PRIMARY + " AS primary_exception_type FROM (SELECT *, " + ", ".join(
    f"coalesce({sql}, false) AS {flag}" for flag, sql in TUNED_SQL.items()) + " FROM enriched))\n" + "\nUNION ALL\n".join(
    f"SELECT sha256(concat_ws('||', {lit(rule)}, raw_reading_id, meter_id, CAST(reading_timestamp AS VARCHAR))) AS exception_id, {lit(rule)} AS rule_id, "
    f"{lit(kind)} AS exception_type, {lit(severity)} AS severity, {lit(reason)} AS business_reason, raw_reading_id, primary_exception_type FROM tuned WHERE {flag}"
    for flag, kind, rule, severity, reason in TUNED)
OUTCOMES = [(r.rule_id, {"DQ_STALE_READING": "OFF"}.get(r.rule_id, "COMPILED" if r.rule_id in bindings.TUNED_RULES else "BUILT_IN")) for r in rules.READING_RULES]
Q["rule_outcomes"] = f"""SELECT rule_id, outcome, n AS untuned_failures FROM (VALUES {values_rows([*OUTCOMES, ('DQ_PRESSURE_HIGH', 'COMPILED')])}) AS o(rule_id, outcome)
  LEFT JOIN (SELECT rule_id, count(*) AS n FROM exceptions GROUP BY rule_id) USING (rule_id)"""
simple("join_enrich", ("raw_reading_id", "meter_id", "source_facility_id", "master_meter_id", "master_facility_id", "master_meter_name", "master_product",
                       "master_is_custody_transfer", "master_install_date", "master_facility_name", "master_region", "master_latitude"), "enriched")
simple("join_event_context", ("raw_reading_id", "event_id", "event_quality_code", "event_raw_status", "event_device_status", "event_communication_status",
                              "event_battery_status", "event_polling_error_code", "event_signal_quality", "event_retry_count", "event_payload_schema_version",
                              "event_seed_batch_id", "event_scenario_id"), "enriched")
Q["dim_facility"] = "SELECT sha256(facility_id) AS facility_key, * FROM facilities"
Q["dim_meter"] = """SELECT sha256(m.meter_id) AS meter_key, sha256(m.facility_id) AS facility_key, m.*, f.facility_name, f.region, f.basin, f.state, f.asset_type, f.operator
  FROM meters m LEFT JOIN facilities f ON m.facility_id = f.facility_id"""
Q["scenario_interval_join"] = """SELECT raw_reading_id, r.meter_id, reading_timestamp, scenario_id FROM readings r
  JOIN (SELECT *, trim(unnest(string_split(affected_meter_ids, ';'))) AS one_meter FROM scenarios) s ON r.meter_id = s.one_meter AND reading_timestamp BETWEEN start_datetime AND end_datetime"""
Q["calendar_densify"] = f"""SELECT s.meter_id, s.production_date, {rounded('coalesce(d.measured_volume, 0)')} AS measured_volume, coalesce(d.record_count, 0) AS record_count
  FROM (SELECT meter_id, CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS production_date FROM meters) s
  LEFT JOIN (SELECT meter_id, production_date, sum(measured_volume) AS measured_volume, count(*) AS record_count FROM flow GROUP BY ALL) d USING (meter_id, production_date)"""
NEWEST = "row_number() OVER (PARTITION BY {0} ORDER BY production_date DESC NULLS LAST, exception_group_id DESC, coalesce(scenario_id, '') DESC) AS rn, count(*) OVER (PARTITION BY {0}) AS n"
Q["related_context_fallback"] = f"""
  WITH by_s AS (SELECT * FROM (SELECT *, {NEWEST.format('scenario_id')} FROM rca_ctx WHERE scenario_id IS NOT NULL) WHERE rn = 1),
       by_p AS (SELECT * FROM (SELECT *, {NEWEST.format('facility_id, exception_type')} FROM rca_ctx WHERE facility_id IS NOT NULL AND exception_type IS NOT NULL) WHERE rn = 1)
  SELECT e.exception_id, CASE WHEN s.n IS NOT NULL THEN 'scenario' WHEN p.n IS NOT NULL THEN 'facility_and_type' END AS related_by, coalesce(s.n, p.n, 0) AS related_count,
         CASE WHEN s.n IS NOT NULL THEN s.exception_group_id ELSE p.exception_group_id END AS related_group_id,
         CASE WHEN s.n IS NOT NULL THEN s.scenario_name ELSE p.scenario_name END AS related_scenario_name,
         CASE WHEN s.n IS NOT NULL THEN s.recommended_next_step ELSE p.recommended_next_step END AS related_next_step,
         CASE WHEN s.n IS NOT NULL THEN s.rca_summary_seed ELSE p.rca_summary_seed END AS related_summary
  FROM exc_fact e LEFT JOIN by_s s ON e.event_scenario_id = s.scenario_id LEFT JOIN by_p p ON e.facility_id = p.facility_id AND e.exception_type = p.exception_type"""
Q["related_exceptions"] = """SELECT g.exception_group_id, x.position, x.exception_id, x.meter_id FROM (SELECT DISTINCT exception_group_id, facility_id, exception_type, production_date FROM rca_ctx) g
  JOIN ranked_exc x ON g.facility_id IS NOT DISTINCT FROM x.facility_id AND g.exception_type IS NOT DISTINCT FROM x.exception_type AND g.production_date IS NOT DISTINCT FROM x.production_date
  WHERE x.position <= 250"""
simple("volume_measures", ("raw_reading_id", "reporting_facility_id", "is_valid_record", "is_review_record", "is_exception_record", "valid_volume", "accepted_or_review_volume", "all_nonnegative_volume"), "measures")
simple("meter_daily", (*METER_DAY_KEYS, *METER_DAY_MEASURES), "meter_days")
simple("readiness_score", ("meter_id", "source_facility_id", "production_date", "gas_day", "source_system", "polling_platform", "exception_rate", "valid_record_rate", "reporting_readiness_score", "has_data_quality_issue"), "meter_days")
simple("facility_daily", FACILITY_DAY_COLS, "facility_days")
simple("nomination_daily", ("facility_id", "production_date", "product", "nominated_volume", "nomination_count", "customer_groups", "contract_types", "nomination_statuses"), "nom_days")
simple("actual_vs_nominated", AVN_COLS, "avn")
simple("flow_daily", ("meter_id", "facility_id", "production_date", *FLOW_COLS), "flow_days")
simple("flow_reconciliation", FLOW_REC_COLS, "flow_rec")
Q["flow_reconciliation_per_meter_day"] = f"""SELECT {columns(("meter_id", "production_date", "source_accepted_or_review_volume", "source_valid_volume", "exception_rate", "reporting_readiness_score", *FLOW_COLS, "corrected_vs_source_delta", "corrected_vs_source_pct"))} FROM (
  SELECT *, {FLOW_DELTA} FROM (
  SELECT m.meter_id, m.production_date, m.source_accepted_or_review_volume, m.source_valid_volume, m.bad / CAST(m.n AS DOUBLE) AS exception_rate,
         round((1.0 - m.bad / CAST(m.n AS DOUBLE)) * 100.0, 2) AS reporting_readiness_score, {FLOW_LIST}
  FROM (SELECT meter_id, production_date, sum(accepted_or_review_volume) AS source_accepted_or_review_volume, sum(valid_volume) AS source_valid_volume,
               sum(exception_reading_count) AS bad, sum(hourly_reading_count) AS n FROM meter_days GROUP BY meter_id, production_date) m
  LEFT JOIN (SELECT meter_id, production_date, {FLOW_AGGS} FROM flow GROUP BY meter_id, production_date) f ON m.meter_id = f.meter_id AND m.production_date = f.production_date))"""
simple("exception_fact", EXC_FACT_COLS, "exc_fact")
simple("run_fact", RUN_COLS, "run_fact")
simple("ticket_fact", TICKET_COLS, "ticket_fact")
simple("source_day_profile", ("meter_id", "source_facility_id", "production_date", "measured_volume", "null_count", "zero_count", "negative_count", "stale_count", "bad_quality_count"), "profile")
Q["first_match_code"] = """SELECT meter_id, source_facility_id, production_date, exception_code, CASE WHEN exception_code IS NULL THEN 'VALIDATED' ELSE 'EXCEPTION' END AS validation_status,
  CASE WHEN null_count > 0 OR zero_count > 0 OR stale_count > 0 THEN 'Y' ELSE 'N' END AS estimated_flag
  FROM (SELECT *, CASE WHEN null_count > 0 THEN 'NULL_VOLUME' WHEN zero_count > 0 THEN 'ZERO_VOLUME' WHEN negative_count > 0 THEN 'NEGATIVE_VOLUME'
               WHEN stale_count > 0 THEN 'STALE_READING' WHEN bad_quality_count > 0 THEN 'INVALID_QUALITY_CODE' END AS exception_code FROM profile)"""
Q["rule_summary"] = """SELECT rule_id, exception_type, severity, count(*) AS exception_count, count(DISTINCT meter_id) AS affected_meter_count,
  count(DISTINCT master_facility_id) AS affected_facility_count, min(production_date) AS first_production_date, max(production_date) AS last_production_date
  FROM exceptions GROUP BY rule_id, exception_type, severity"""
Q["rule_summary_named"] = """SELECT r.*, CAST(CASE WHEN upper(r.severity) LIKE '%HIGH%' THEN 1 WHEN upper(r.severity) LIKE '%MEDIUM%' THEN 2 ELSE 3 END AS BIGINT) AS severity_rank,
  c.rule_name, c.layer, c.owner_team FROM (""" + Q["rule_summary"] + """) r LEFT JOIN catalogue c ON r.rule_id = c.rule_id"""
Q["severity_rank"] = "SELECT DISTINCT rule_id, severity, CAST(CASE WHEN upper(severity) LIKE '%HIGH%' THEN 1 WHEN upper(severity) LIKE '%MEDIUM%' THEN 2 ELSE 3 END AS BIGINT) AS severity_rank FROM exceptions"
simple("exception_summary_daily", SUMMARY_COLS, "exc_summary")
simple("pipeline_health", HEALTH_COLS, "health")
simple("latest_run", HEALTH_COLS[:10], "latest")
Q["latest_run_per_customer"] = f"""SELECT pipeline_name, run_id, status, started_at, {rounded('rows_read')} AS rows_read FROM (
  SELECT 'C-' || CAST(o_custkey AS VARCHAR) AS pipeline_name, o_orderkey AS run_id, o_orderstatus AS status, o_orderdate AS started_at, o_totalprice AS rows_read,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1"""
Q["status_counts"] = """SELECT 'record_quality_status' AS facet, record_quality_status AS value, count(*) AS row_count FROM checked GROUP BY record_quality_status
  UNION ALL SELECT 'primary_exception_type', primary_exception_type, count(*) FROM checked GROUP BY primary_exception_type"""
Q["exception_kpis"] = """SELECT count(*) AS rule_failures, count(DISTINCT raw_reading_id) AS affected_readings, count(DISTINCT meter_id) AS affected_meters,
  count(DISTINCT facility_id) AS affected_facilities, count(*) FILTER (WHERE upper(severity) LIKE '%HIGH%') AS high_severity_failures FROM exc_fact"""
DEVICE = f"coalesce(upper(event_device_status) IN ({listed(rules.DEVICE_FAULTS)}), false)"
COMMS = f"coalesce(upper(event_communication_status) IN ({listed(rules.COMMUNICATION_FAULTS)}), false)"
Q["event_kpis"] = f"""SELECT count(*) AS event_context_rows, count(DISTINCT raw_reading_id) AS raw_readings, count(DISTINCT meter_id) AS meters, count(DISTINCT facility_id) AS facilities,
  count(*) FILTER (WHERE {DEVICE}) AS device_issues, count(*) FILTER (WHERE {COMMS}) AS communication_issues,
  count(*) FILTER (WHERE {DEVICE}) + count(*) FILTER (WHERE {COMMS}) AS device_or_communication_issues FROM exc_fact"""
Q["pipeline_kpis"] = f"""SELECT count(*) AS pipelines, CAST(sum(run_count) AS BIGINT) AS total_runs, CAST(sum(failed_count) AS BIGINT) AS failures, CAST(sum(partial_load_count) AS BIGINT) AS partial_loads,
  CAST(sum(latest_rows_rejected) AS BIGINT) AS latest_rejected_rows, {rounded('sum(failed_count) / CAST(sum(run_count) AS DOUBLE)')} AS overall_failure_rate FROM health"""
Q["rca_kpis"] = """SELECT count(*) AS rca_groups, CAST(sum(exception_count) AS BIGINT) AS exception_records, CAST(sum(affected_reading_count) AS BIGINT) AS affected_readings,
  CAST(sum(affected_meter_count) AS BIGINT) AS affected_meters, count(DISTINCT scenario_id) AS known_scenarios FROM rca_ctx"""
Q["reconciliation_kpis"] = "SELECT count(*) AS checkpoints, count(DISTINCT layer) AS layers, max(row_count) AS max_row_count, min(row_count) AS min_row_count FROM stages"
Q["publish_kpis"] = "SELECT count(*) AS publish_targets, count(*) FILTER (WHERE status = 'PASS') AS publish_passes FROM published"
Q["filter_options"] = "\nUNION ALL ".join(f"SELECT DISTINCT '{c}' AS facet, trim({c}) AS value FROM exc_fact WHERE trim({c}) <> ''" for c in OPTIONS)
Q["filtered_exception_summary"] = f"""SELECT {GROUP_KEYS}, count(exception_id) AS exception_rows, count(DISTINCT raw_reading_id) AS affected_readings, count(DISTINCT meter_id) AS affected_meters
  FROM exc_fact WHERE severity IN ('High', 'Medium/High') AND production_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY {GROUP_KEYS}"""
Q["value_counts"] = "\nUNION ALL ".join(f"SELECT '{c}' AS facet, CAST({c} AS VARCHAR) AS value, count(*) AS row_count FROM exc_fact GROUP BY {c}" for c in DIST)
Q["facet_cube"] = "\nUNION ALL ".join([
    *[f"SELECT production_date, '{c}' AS facet, CAST({c} AS VARCHAR) AS value, count(*) AS row_count FROM exc_fact GROUP BY production_date, {c}" for c in catalogue.CUBE_FACETS],
    "SELECT production_date, NULL AS facet, NULL AS value, count(*) AS row_count FROM exc_fact GROUP BY production_date"])
Q["facet_cube_options"] = Q["filter_options"]
Q["facet_cube_distributions"] = "\nUNION ALL ".join(
    f"SELECT '{c}' AS facet, CAST({c} AS VARCHAR) AS value, count(*) AS row_count FROM exc_fact WHERE production_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY {c}"
    for c in ("event_device_status", "polling_platform", "severity"))
Q["latest_status_counts"] = "SELECT latest_status, count(*) AS pipeline_count FROM health GROUP BY latest_status"
Q["top_exception_types"] = "SELECT exception_type, count(*) AS exception_rows FROM exc_fact GROUP BY exception_type ORDER BY exception_rows DESC, exception_type NULLS LAST LIMIT 10"
Q["top_facilities"] = "SELECT facility_id, facility_name, count(*) AS exception_rows FROM exc_fact GROUP BY facility_id, facility_name ORDER BY exception_rows DESC, facility_id NULLS LAST, facility_name NULLS LAST LIMIT 10"
simple("ordered_detail", ("production_date", "facility_id", "meter_id", "exception_type", "exception_id"), "exc_fact")
KPI_SAMPLE = ("reporting_facility_id", "master_region", "master_product", "production_date", "gas_day", "meter_count", "hourly_reading_count", "accepted_or_review_volume", "exception_reading_count", "reporting_readiness_score")
Q["facility_kpi_sample"] = f"SELECT {columns(KPI_SAMPLE)} FROM (SELECT * FROM facility_days ORDER BY production_date NULLS LAST, reporting_facility_id NULLS LAST, master_product NULLS LAST, gas_day NULLS LAST LIMIT 25)"
Q["drilldown_labels"] = """SELECT DISTINCT exception_id, concat_ws(' | ', coalesce(CAST(production_date AS VARCHAR), 'UNKNOWN'), coalesce(facility_id, 'UNKNOWN'), coalesce(meter_id, 'UNKNOWN'),
  coalesce(exception_type, 'UNKNOWN'), substr(exception_id, 1, 12)) AS label FROM exc_fact ORDER BY exception_id, label"""
SILVER_SOURCES = ("readings", "docs", "checked", "checked WHERE record_quality_status <> 'EXCEPTION'", "checked WHERE dq_has_exception", "exceptions")
Q["silver_counts"] = "\nUNION ALL ".join(f"SELECT {lit(layer)} AS layer, {lit(name)} AS object_name, {lit(note)} AS notes, count(*) AS row_count FROM {src}"
                                          for (layer, name, note), src in zip(reconcile.SILVER_COUNTS, SILVER_SOURCES, strict=True))
Q["checkpoints"] = "SELECT * FROM points"
simple("reconciliation_deltas", ("stage_order", "layer", "object_name", "metric_type", "row_count", "previous_row_count", "row_count_delta_from_previous", "row_count_delta_pct_from_previous"), "stages")
simple("checkpoint_interpretation", ("stage_order", "metric_type", "interpretation"), "stages")
Q["layer_summary"] = "SELECT layer, count(object_name) AS checkpoint_count, min(row_count) AS min_row_count, max(row_count) AS max_row_count, min(stage_order) AS first_stage, max(stage_order) AS last_stage FROM stages GROUP BY layer"
Q["publish_status"] = "SELECT * FROM published"
Q["publish_deltas"] = "SELECT table_name, written_rows - source_rows AS source_vs_written_delta, written_rows - expected_rows AS expected_vs_written_delta FROM published"
Q["publish_status_counts"] = "SELECT status, count(*) AS target_count FROM published GROUP BY status"
ANOMALY = f"(volume IS NULL OR volume <= 0 OR NOT coalesce(quality_code IN ({ACCEPTED}), false) OR raw_status NOT IN ('VALID', 'REVIEW'))"
simple("select_anomalies", ("raw_reading_id", "volume", "quality_code", "raw_status"), f"readings WHERE {ANOMALY}")
Q["anomaly_plus_sample"] = f"""SELECT raw_reading_id, quality_code, raw_status FROM readings WHERE {ANOMALY}
  UNION ALL SELECT raw_reading_id, quality_code, raw_status FROM (SELECT * FROM readings WHERE NOT {ANOMALY} ORDER BY md5('42' || raw_reading_id), raw_reading_id LIMIT {catalogue.SAMPLE_SIZE})"""
Q["event_context"] = f"SELECT raw_reading_id, {CONTEXT.replace('END AS retry_count', 'END::BIGINT AS retry_count')} FROM (SELECT *, {KINDS} AS kind FROM readings)"
Q["scenario_lookup"] = f"SELECT raw_reading_id, raw_status, {SCENARIO} AS scenario_id FROM readings"
Q["event_document"] = f"SELECT {DOC_JSON} AS document FROM docs"
Q["event_upsert"] = f"""
  WITH old AS (SELECT event_id, raw_reading_id, raw_status AS payload_raw_status, seed_batch_id, {DOC_TEXT['ingested_at']} AS ingested_at FROM docs WHERE seed_batch_id = '{bindings.FIRST_BATCH}'),
       new AS (SELECT CASE WHEN pressure < 701 THEN 'EVT-' || raw_reading_id ELSE event_id END AS event_id, raw_reading_id, raw_status AS payload_raw_status, seed_batch_id, {DOC_TEXT['ingested_at']} AS ingested_at FROM docs WHERE seed_batch_id = '{bindings.RETRY_BATCH}')
  SELECT coalesce(old.event_id, new.event_id) AS event_id, coalesce(old.raw_reading_id, new.raw_reading_id) AS raw_reading_id,
         CASE WHEN old.event_id IS NOT NULL THEN old.payload_raw_status ELSE new.payload_raw_status END AS payload_raw_status,
         coalesce(old.seed_batch_id, new.seed_batch_id) AS seed_batch_id, coalesce(old.ingested_at, new.ingested_at) AS ingested_at,
         CASE WHEN new.event_id IS NOT NULL THEN TIMESTAMP '{catalogue.ATTEMPTED_AT}' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS last_seed_attempt_at,
         coalesce(new.seed_batch_id, old.seed_batch_id) AS last_seed_batch_id
  FROM old FULL JOIN new ON old.event_id = new.event_id"""
Q["batch_reset"] = f"SELECT event_id, seed_batch_id FROM docs WHERE seed_batch_id <> '{bindings.FIRST_BATCH}'"


def json_array(column: str) -> str:
    """The joined set as a JSON array (values contain no separators or quotes)."""
    return f"CASE WHEN {column} = '' THEN '[]' ELSE '[\"' || replace({column}, ', ', '\",\"') || '\"]' END"


Q["flatten_complex"] = f"SELECT exception_group_id, region, {json_array('source_systems')} AS source_systems, {json_array('signal_qualities')} AS signal_qualities, CAST(exception_count AS DOUBLE) AS exception_count FROM exc_summary"
Q["normalize_columns"] = 'SELECT run_id AS "RUN_ID", run_id AS "RUN_ID_2", rows_read AS "COL_2ND_ROWS", status AS "STATUS", warning_count AS "WARN_COUNT" FROM runs'
Q["normalize_values"] = f"""SELECT run_id, CASE WHEN warning_count <> 1 THEN {rounded('rejected_rate')} END AS rejected_rate, '["' || status || '","' || pipeline_name || '"]' AS tags FROM run_fact"""


def aligned(table: str, source: str, available) -> str:
    """SELECT list of a support table over what the gold table offers."""
    out = []
    for name, sql_type in publish.SUPPORT_TABLES[table]:
        found = next((c for c in (name, *publish.SUPPORT_ALIASES.get(table, {}).get(name, ())) if c in available), None)
        base = sql_type.split("(")[0]
        kind = {"bigint": "BIGINT", "int": "BIGINT", "bit": "BOOLEAN", "date": "DATE", "datetime2": "TIMESTAMP"}.get(base, "VARCHAR")
        if base == "decimal":
            places = sql_type.split(",")[1].rstrip(")")
            out.append(f"{rounded(f'round(CAST({found} AS DOUBLE), {places})')} AS {name}")
        else:
            out.append(f"CAST({found or 'NULL'} AS {kind}) AS {name}")
    out.append(f"'{catalogue.RUN_ID}' AS _publish_run_id, TIMESTAMP '{catalogue.PUBLISHED_AT}' AS _published_at_utc")
    return f"SELECT {', '.join(out)} FROM {source}"


STAGE_COLS = ("stage_order", "layer", "object_name", "row_count", "metric_type", "notes", "previous_row_count", "row_count_delta_from_previous", "row_count_delta_pct_from_previous", "interpretation")
GOLD = {
    "pipeline_health_summary": ("health", HEALTH_COLS),
    "fact_data_quality_exception": ("exc_fact", EXC_FACT_COLS),
    "exception_summary_daily": ("exc_summary", SUMMARY_COLS),
    "fact_facility_volume_daily": ("facility_days", FACILITY_DAY_COLS),
    "fact_actual_vs_nominated_daily": ("avn", AVN_COLS),
    "fact_flow_reconciliation_daily": ("flow_rec", FLOW_REC_COLS),
    "fact_source_to_target_reconciliation": ("stages", STAGE_COLS),
    "fact_support_ticket": ("ticket_fact", TICKET_COLS),
    "rca_context": ("rca_ctx", RCA_COLS),
}
Q["align_to_target"] = aligned("fact_pipeline_run", "run_fact", RUN_COLS)
Q["publish_metadata"] = f"SELECT DISTINCT '{catalogue.RUN_ID}' AS _support_publish_run_id, TIMESTAMP '{catalogue.PUBLISHED_AT}' AS _support_published_at_utc FROM runs"
Q["view_summary"] = "\nUNION ALL ".join(f"SELECT '{catalogue.RUN_ID}' AS publish_run_id, '{name}' AS view_name, count(*) AS view_rows, 'PASS' AS status FROM {src}"
                                         for name, src in (("dim_facility", "facilities"), ("fact_pipeline_run", "runs"), ("fact_support_ticket", "tickets"), ("flow_daily", "flow_days")))
for _name, (_table, _cols) in views.INVESTIGATION_VIEWS.items():
    simple(f"view_investigation_{_name}", _cols, GOLD[_table][0])
ARRAYS = {"source_systems", "polling_platforms", "device_statuses", "communication_statuses", "signal_qualities", "customer_groups", "contract_types",
          "nomination_statuses", "flow_validation_statuses", "flow_exception_codes"}
for _name, _table in views.BUSINESS_VIEWS.items():
    _source, _cols = GOLD[_table]
    # Sets of an unmatched row are NULL, sets of a matched row without values are empty.
    _list = ", ".join(
        f"{json_array(c)} AS \"{c.upper()}\"" if c in ARRAYS else (f"{rounded(c)} AS \"{c.upper()}\"" if c in DOUBLES else f'{c} AS "{c.upper()}"') for c in _cols
    )
    Q[f"view_business_{_name}"] = f"SELECT {_list} FROM {_source}"
for _name, _table in views.SUPPORT_VIEWS.items():
    _source, _cols = GOLD[_table]
    Q[f"view_support_{_name}"] = aligned(_table, _source, _cols)
Q["reliability_overview"] = """SELECT 'pipeline_health' AS metric_group, count(*) AS metric_count, count(*) FILTER (WHERE latest_status = 'SUCCESS') AS passing_count, count(*) FILTER (WHERE latest_status <> 'SUCCESS') AS attention_count FROM health
  UNION ALL SELECT 'data_quality_exceptions', count(*), count(*) FILTER (WHERE severity IN ('Low', 'Medium')), count(*) FILTER (WHERE severity NOT IN ('Low', 'Medium')) FROM exc_fact
  UNION ALL SELECT 'source_to_target_reconciliation', count(*), count(row_count), count(*) - count(row_count) FROM stages"""
simple("faceted_filter", ("exception_id", "severity", "region", "production_date"), "exc_fact WHERE severity = 'High' AND region IN ('ASIA', 'EUROPE') AND production_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-25'")
simple("text_search", ("exception_id", "meter_id", "raw_reading_id"), "exc_fact WHERE contains(lower(meter_id), 'r-0001') OR contains(lower(raw_reading_id), 'r-0001')")
Q["text_search_indexed"] = Q["text_search"]
Q["exception_context_json"] = f"SELECT exception_id, {CONTEXT_JSON} AS context_json FROM exc_fact"
simple("rca_context", RCA_COLS, "rca_ctx")
simple("likely_layer", ("exception_group_id", "exception_type", "scenario_id", "likely_layer"), "explained")
Q["suggested_checks"] = f"SELECT exception_group_id, scenario_id, CASE WHEN checks = '' THEN {lit(', '.join(rca.DEFAULT_CHECKS))} ELSE checks END AS suggested_checks FROM (SELECT *, {CHECK_TEXT} AS checks FROM explained)"
Q["cautions"] = f"SELECT exception_group_id, scenario_id, {CAUTION_TEXT} AS cautions FROM explained"
Q["rca_summary_text"] = f"SELECT exception_group_id, scenario_id, {SUMMARY_TEXT} AS rca_summary_text FROM explained"
Q["group_key"] = "SELECT exception_id, exception_group_key FROM reviews"
simple("review_decision", ("exception_id", "status", "priority", "reviewer_decision", "reviewer_comments", "accepted_flag"), "reviews")
Q["triage_upsert"] = "SELECT * FROM triage"
Q["review_append"] = "SELECT exception_group_key, exception_id, note_text, updated_by AS created_by, reviewed_at AS created_at FROM reviews WHERE note_text IS NOT NULL"
Q["review_log_append"] = """SELECT exception_group_key, exception_id, CAST(NULL AS VARCHAR) AS ai_provider, CAST(NULL AS VARCHAR) AS prompt_text, CAST(NULL AS VARCHAR) AS response_text,
  reviewer_decision, accepted_flag, reviewer_comments, updated_by AS reviewed_by, reviewed_at FROM reviews"""
Q["activity_append"] = "SELECT updated_by AS user_id, 'SAVE_AI_RCA_REVIEW' AS action_type, 'exception_group' AS object_type, exception_group_key AS object_id, " + json_object([
    ("status", "status"), ("priority", "priority"), ("assigned_to", "assigned_to"), ("note_inserted", "note_text IS NOT NULL")]) + \
    " AS activity_detail, reviewed_at AS created_at FROM reviews"
Q["delete_by_key"] = """SELECT exception_group_key, exception_id, note_text, updated_by AS created_by, reviewed_at AS created_at FROM reviews
  WHERE note_text IS NOT NULL AND NOT (updated_by = 'user_1' AND note_text = 'check totals')"""
Q["app_state_counts"] = """SELECT count(DISTINCT exception_group_key) AS triage_rows, count(note_text) AS note_rows, count(*) AS ai_review_rows, count(*) AS activity_rows
  FROM reviews"""
Q["dedupe_by_key"] = """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1"""

PIPE_COLS = ("pipeline_name", "latest_status", "latest_rows_read", "latest_rows_accepted", "latest_rows_rejected", "run_count", "failed_count", "partial_load_count")
POINT_COLS = ("stage_order", "layer", "object_name", "row_count", "metric_type", "notes")


def json_rows(cols, source: str, order: str) -> str:
    obj = "json_object(" + ", ".join(f"'{c}', {c}" for c in cols) + ")"
    return f"'[' || string_agg(CAST({obj} AS VARCHAR), ',' ORDER BY {order}) || ']' FROM {source}"


Q["rca_packet"] = f"""
  WITH samples AS (SELECT facility_id, exception_type, production_date, '[' || string_agg(CAST({SAMPLE_JSON} AS VARCHAR), ',' ORDER BY position) || ']' AS rows
                   FROM ranked_exc WHERE position <= 5 GROUP BY facility_id, exception_type, production_date)
  SELECT exception_group_id, scenario_id, likely_layer, {SUMMARY_TEXT} AS rca_summary_text, {EVIDENCE_JSON} AS evidence_json,
         CASE WHEN {CHECK_TEXT.replace("', ', ", "'', ", 1)} = '' THEN {lit('["' + '","'.join(rca.DEFAULT_CHECKS) + '"]')} ELSE '["' || concat_ws('","', {', '.join(f"CASE WHEN {holds(t, 'likely_layer')} THEN " + lit('","'.join(x)) + " END" for t, x in rca.CHECK_RULES)}) || '"]' END AS checks_json,
         '["' || concat_ws('","', {lit('","'.join(rca.GENERAL_CAUTIONS))}, {', '.join(f"CASE WHEN upper(exception_type) IN ({listed(t)}) THEN {lit(x)} END" for t, x in rca.TYPE_CAUTIONS)}) || '"]' AS cautions_json,
         coalesce(s.rows, '[]') AS sample_rows_json,
         (SELECT {json_rows(POINT_COLS, 'points', 'stage_order')}) AS checkpoints_json, (SELECT {json_rows(PIPE_COLS, 'health', 'pipeline_name')}) AS pipelines_json
  FROM (SELECT * FROM explained) e LEFT JOIN (SELECT facility_id AS sf, exception_type AS st, production_date AS sd, rows FROM samples) s
    ON e.facility_id IS NOT DISTINCT FROM s.sf AND e.exception_type IS NOT DISTINCT FROM s.st AND e.production_date IS NOT DISTINCT FROM s.sd"""

Q["narrowed_values"] = """
SELECT unnest(['run_id', 'rows_read', 'rows_rejected', 'accepted_rate', 'error_message']) AS column_name,
       unnest([count(*) FILTER (WHERE run_id IS NOT NULL), count(*) FILTER (WHERE abs(rows_read) >= 100000), count(*) FILTER (WHERE abs(rows_rejected) > 2147483647),
               count(*) FILTER (WHERE abs(accepted_rate) >= 9.995), count(*) FILTER (WHERE error_message IS NOT NULL)]) AS lost_count FROM run_fact"""
Q["triage_keyed_upsert"] = Q["triage_upsert"]

NAMES = re.compile(r"\b(" + "|".join(CTES) + r")\b")


def needed(sql: str) -> list[str]:
    """The common table expressions a statement uses, parents first."""
    found: list[str] = []

    def visit(text: str, own: str | None) -> None:
        for name in NAMES.findall(re.sub(r"'[^']*'", "''", text)):
            if name != own and name not in found:
                visit(CTES[name], name)
                if name not in found:
                    found.append(name)

    visit(sql, None)
    return found


def statement(name: str) -> str:
    final = Q[name].strip()
    ctes = [f"{c} AS ({CTES[c].strip()})" for c in needed(final)]
    if final.startswith("WITH "):
        return "WITH " + ",\n".join([*ctes, final.removeprefix("WITH ")])
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + final


def statements() -> dict[str, str]:
    return {name: statement(name) for name in Q}
