"""The operators' domain tables, derived by Spark from the test tables.

Readings come from ``events``, the meter master from ``customer``, facilities
from ``nation`` and ``region``, flow-computer records from ``lineitem``, and
nominations, pipeline runs, tickets and reviews from ``orders``. Everything is
first given as untidy text, as a raw source would, and then standardized.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import enrich, events, facts, rca, reconcile, rules, state, summaries
from plumbline.operators.standardize import SPECS, standardize_table
from plumbline.session import materialize, shared_folder
from plumbline.sources.files import Landing, read_event_documents

# What the rules read of an event, and the meter-days' sets.
RULE_EVENT_COLUMNS = (
    "payload_quality_code", "payload_raw_status", "payload_device_status", "payload_communication_status", "payload_signal_quality",
)
AS_OF = "2024-01-28"
DETECTED_AT = "2024-02-01 00:00:00"
FIRST_BATCH, RETRY_BATCH = "SEED-001", "SEED-002"

READING_TEXT = """
    concat('RAW-', if(event_id BETWEEN 0 AND 999999999, lpad(event_id, 9, '0'), format_string('%09d', event_id))) AS raw_reading_id
    concat(if(k = 88, ' MTX-', ' MTR-'), if(user_id BETWEEN 0 AND 99999, lpad(user_id, 5, '0'), format_string('%05d', user_id))) AS meter_id
    concat('FAC-', lpad((user_id + if(k = 97, 1, 0)) % 25, 3, '0')) AS facility_id
    if(event_type = 'error' AND k = 99, 'n/a', concat(hour, ':00:00')) AS reading_timestamp
    if(event_type = 'view' AND k = 98, '2024-13-45', substring_index(hour, 'T', 1)) AS production_date
    substring_index(hour, 'T', 1) AS gas_day
    if(k = 55, '', concat(hour, ':03:00')) AS poll_timestamp
    if(k = 44, '  ', concat('SRC_', upper(event_type))) AS source_system
    concat('PLATFORM_', k % 4) AS polling_platform
    CASE k WHEN 7 THEN '' WHEN 11 THEN '0' WHEN 13 THEN cast(-value AS string) WHEN 17 THEN 'n/a' ELSE cast(value AS string) END AS volume
    cast(700 + k * 1.5D AS string) AS pressure
    cast(60 + k * 0.25D AS string) AS temperature
    CASE WHEN event_type = 'view' THEN 'GOOD' WHEN event_type = 'click' THEN ' good ' WHEN event_type = 'purchase' THEN 'ESTIMATED' WHEN event_type = 'signup' THEN 'questionable' WHEN k < 10 THEN 'STALE' WHEN k < 20 THEN 'BAD_CODE_X' WHEN k < 25 THEN '' ELSE 'MISSING' END AS quality_code
    CASE WHEN k = 7 THEN 'NULL_VOLUME' WHEN k = 13 THEN 'NEGATIVE_VOLUME' WHEN k = 97 THEN 'FACILITY_MISMATCH' WHEN k > 97 THEN 'LATE_ARRIVAL' WHEN event_type = 'error' AND k < 5 THEN 'NO_SIGNAL' WHEN event_type = 'error' AND k < 10 THEN 'STALE' WHEN event_type = 'signup' THEN 'review' ELSE 'valid' END AS raw_status
    date_format(cast(concat(hour, ':00:00') AS timestamp_ntz) + make_dt_interval(0, 0, k * 15), "yyyy-MM-dd'T'HH:mm:ss") AS load_timestamp
    if(k = 66, '', concat('BATCH-', replace(substring_index(hour, 'T', 1), '-', ''))) AS batch_id
"""

METER_TEXT = """
    concat('MTR-', if(c_custkey BETWEEN 0 AND 99999, lpad(c_custkey, 5, '0'), format_string('%05d', c_custkey))) AS meter_id
    concat('FAC-', lpad(c_custkey % 25, 3, '0')) AS facility_id
    c_name AS meter_name
    concat('TYPE_', c_nationkey % 5) AS meter_type
    c_mktsegment AS product
    if(c_acctbal > 5000, 'CUSTODY_TRANSFER', 'OPERATIONAL') AS measurement_type
    if(c_acctbal > 5000, ' y ', 'N') AS custody_transfer_flag
    'SRC_MASTER' AS source_system
    'PLATFORM_0' AS polling_platform
    cast(date_add(DATE '2015-01-01', c_nationkey * 30) AS string) AS install_date
    CASE WHEN c_acctbal < 0 THEN 'n' WHEN c_acctbal < 200 THEN '' ELSE 'Y ' END AS active_flag
    '10.5' AS expected_min_volume
    '500.25' AS expected_max_volume
    '60' AS sample_interval_minutes
"""

FACILITY_TEXT = """
    concat('FAC-', lpad(n_nationkey, 3, '0')) AS facility_id
    n_name AS facility_name
    r_name AS region
    concat('BASIN_', n_regionkey) AS basin
    concat('ST_', n_nationkey) AS state
    concat('ASSET_', n_nationkey % 3) AS asset_type
    concat('OPERATOR_', n_nationkey % 4) AS operator
    if(n_nationkey = 23, 'N', 'Y') AS active_flag
    '2019-01-01' AS effective_start_date
    '' AS effective_end_date
    cast(n_nationkey + 0.5D AS string) AS latitude
    cast(-n_nationkey - 0.25D AS string) AS longitude
    'SRC_MASTER' AS source_system
"""

FLOW_TEXT = """
    concat('FLOW-', l_orderkey, '-', l_linenumber) AS flow_record_id
    concat('MTR-', if(l_suppkey BETWEEN 0 AND 99999, lpad(l_suppkey, 5, '0'), format_string('%05d', l_suppkey))) AS meter_id
    concat('FAC-', lpad(l_suppkey % 25, 3, '0')) AS facility_id
    concat('2024-01-', lpad(day(l_shipdate), 2, '0')) AS production_date
    concat('2024-01-', lpad(day(l_shipdate), 2, '0')) AS gas_day
    cast(if(l_discount = 0, 0, l_quantity) AS string) AS measured_volume
    cast(l_quantity * (1 + l_tax) AS string) AS corrected_volume
    if(l_returnflag = 'R', 'Y', 'n') AS estimated_flag
    CASE l_returnflag WHEN 'A' THEN 'validated' WHEN 'N' THEN 'pending_approval' ELSE 'corrected' END AS validation_status
    if(l_returnflag = 'R', 'flow_mismatch', '') AS exception_code
    if(l_linestatus = 'F', 'Y', 'N') AS approved_flag
    if(l_linestatus = 'F', 'closed', 'open') AS close_status
    concat('FB-', lpad(day(l_shipdate), 2, '0')) AS flow_batch_id
    concat('2024-01-', lpad(day(l_shipdate), 2, '0'), 'T06:00:00') AS extracted_timestamp
    concat('2024-01-', lpad(day(l_shipdate), 2, '0'), 'T07:00:00') AS last_updated_timestamp
"""

NOMINATION_TEXT = """
    concat('NOM-', o_orderkey) AS nomination_id
    concat('FAC-', lpad(o_custkey % 25, 3, '0')) AS facility_id
    concat('2024-01-', lpad(day(o_orderdate), 2, '0')) AS production_date
    c_mktsegment AS product
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN 'n/a' WHEN o_custkey % 25 = 7 THEN '0' ELSE cast(o_totalprice AS string) END AS nominated_volume
    o_orderpriority AS customer_group
    concat('CONTRACT_', o_orderstatus) AS contract_type
    lower(o_orderstatus) AS status
    '2024-01-01' AS effective_start_date
    '2024-01-31' AS effective_end_date
"""

RUN_TEXT = """
    concat('RUN-', format_string('%09d', o_orderkey)) AS run_id
    o_orderpriority AS pipeline_name
    'orders.csv' AS source_file
    date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss") AS started_at
    date_format(o_orderdate + make_dt_interval(0, 0, 0, rows_read % 7200), "yyyy-MM-dd'T'HH:mm:ss") AS completed_at
    CASE WHEN o_orderstatus = 'F' THEN 'failed' WHEN o_orderstatus = 'P' THEN 'partial_success' WHEN rows_read > 300000 THEN 'RETRY_SUCCESS' ELSE 'SUCCESS' END AS status
    cast(rows_read AS string) AS rows_read
    cast(rows_read - rows_rejected AS string) AS rows_accepted
    cast(rows_rejected AS string) AS rows_rejected
    CASE o_orderstatus WHEN 'F' THEN '3' WHEN 'P' THEN '0' ELSE '' END AS error_count
    cast(o_orderkey % 5 AS string) AS warning_count
    if(o_orderstatus = 'F', 'Load failed', ' ') AS error_message
    'SCHEDULED' AS trigger_type
    'DEV' AS environment
"""

TICKET_TEXT = """
    concat('TKT-', format_string('%09d', o_orderkey)) AS ticket_id
    date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss") AS opened_datetime
    CASE o_orderstatus WHEN 'O' THEN '' ELSE date_format(o_orderdate + make_dt_interval(cast(o_orderkey % 40 AS int)), "yyyy-MM-dd'T'HH:mm:ss") END AS closed_datetime
    concat('SYS_', o_custkey % 3) AS system_name
    concat('ISSUE_', o_orderstatus) AS issue_type
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Critical' WHEN '2-HIGH' THEN 'High' WHEN '3-MEDIUM' THEN 'Medium' WHEN '5-LOW' THEN 'Low' ELSE 'sev2' END AS severity
    concat('FAC-', lpad(o_custkey % 25, 3, '0')) AS facility_id
    concat('MTR-', format_string('%05d', o_custkey)) AS meter_id
    concat('TEAM_', o_custkey % 4) AS reported_by_team
    if(o_orderstatus = 'O', 'Open', 'Closed') AS ticket_status
    'Reporting delayed' AS business_impact
    concat('CAUSE_', o_orderkey % 6) AS root_cause_category
    ' ' AS resolution_summary
    concat('BATCH-', date_format(o_orderdate, 'yyyyMMdd')) AS related_batch_id
    '' AS related_exception_code
"""

REVIEW_TEXT = """
    date_format(o_orderdate, "yyyy-01-01'T'00:00:00") AS production_date
    if(o_custkey % 25 = 7, 'none', concat('FAC-', lpad(o_custkey % 25, 3, '0'))) AS facility_id
    'Facility' AS facility_name
    concat('ISSUE_', o_orderstatus) AS exception_type
    if(o_orderpriority = '5-LOW', ' NaN', o_orderpriority) AS severity
    concat('EX-', o_orderkey) AS exception_id
    CASE o_orderstatus WHEN 'F' THEN 'Resolved' WHEN 'O' THEN ' Ignored ' ELSE '' END AS status
    CASE WHEN o_totalprice > 400000 THEN 'High' ELSE 'null' END AS priority
    if(o_custkey % 3 = 0, 'nat', concat('analyst_', o_custkey % 7)) AS assigned_to
    if(o_totalprice > 250000, ' check totals ', '') AS note_text
    if(o_custkey % 5 = 0, '', concat('user_', o_custkey % 5)) AS updated_by
    timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, o_orderkey) AS reviewed_at
"""

# Known scenarios: id, facility, meters, start, end, type, cause, step.
SCENARIOS = (
    ("SCN-001", "FAC-003", "MTR-00003;MTR-00028 ;", "2024-01-02T00:00:00", "2024-01-20T00:00:00",
     "ZERO_VOLUME", "Polling/device communication outage", "Check the polling platform."),
    ("SCN-004", "FAC-012", "MTR-00012;MTR-00037", "2024-01-05T06:00:00", "2024-01-25T18:00:00",
     "LATE_ARRIVAL", "Timing/schedule issue", "Compare event, poll and load timestamps."),
    ("SCN-005", "FAC-004", "MTR-00004;MTR-00029;MTR-00054", "2024-01-01T00:00:00", "2024-01-31T00:00:00",
     "STALE_READING", "Polling source returned stale values", "Check tag freshness."),
    ("SCN-011", "FAC-010", "MTR-00010", "2024-01-10T00:00:00", "2024-01-12T23:00:00",
     "INVALID_QUALITY_CODE", "Source/status code mapping issue", "Review accepted values."),
    ("SCN-014", "FAC-001", "MTR-00001;MTR-00026", "2024-01-01T00:00:00", "2024-01-31T00:00:00",
     "NEGATIVE_VOLUME", "Bad sensor/source calculation", ""),
)


def text_columns(block: str) -> list[str]:
    return [line.strip() for line in block.strip().splitlines()]


def scenario_rows() -> list[tuple[str, ...]]:
    return [
        (sid, f"Scenario {sid}", f"Seeded issue {sid}", facility, meters, start, end, kind, cause, step)
        for sid, facility, meters, start, end, kind, cause, step in SCENARIOS
    ]


def catalogue_rows() -> list[tuple[str, ...]]:
    """The rule catalogue as a source would deliver it; one rule is switched off."""
    groups = (
        ("Silver", "Data Engineering", rules.READING_RULES),
        ("Gold", "Measurement", (*rules.FLOW_RULES, *rules.NOMINATION_RULES, *rules.RUN_RULES)),
        ("Bronze", "Data Governance", (*rules.LINEAGE_RULES, *rules.PAYLOAD_RULES)),
    )
    return [
        (r.rule_id, f"Rule {r.exception_type}", layer, r.flag, "check", r.flag, r.severity, r.reason, team,
         "n" if r.exception_type == "LATE_ARRIVAL" else " y ")
        for layer, team, listed in groups
        for r in listed
    ]


# Changes to the catalogue: what a user would edit to switch, tighten and add rules.
TUNED_RULES = {
    "DQ_STALE_READING": {"active_flag": "N"},
    "DQ_LATE_ARRIVAL": {"active_flag": "Y", "rule_type": "timeliness", "condition_description": "load_timestamp <= reading_timestamp + 20 hours"},
    "DQ_VOLUME_NON_NEGATIVE": {"rule_type": "range", "condition_description": "volume >= 5"},
    "DQ_QUALITY_CODE_VALID": {"rule_type": "accepted_values", "condition_description": "quality_code in GOOD, ESTIMATED", "severity": "High"},
    "DQ_PRESSURE_HIGH": {
        "rule_id": "DQ_PRESSURE_HIGH", "rule_name": "Pressure within its range", "layer": "Silver", "field_name": "pressure", "rule_type": "range",
        "condition_description": "pressure <= 840", "severity": "Low", "business_reason": "Pressure above the range of the device.",
        "owner_team": "Operations", "active_flag": "Y"},
}


class Domain:
    """Lazily derived domain tables over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._stored: dict[str, DataFrame] = {}
        self.ctx = rules.RuleContext(as_of=AS_OF, max_rejected_rows=1000)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def stored(self, name: str) -> DataFrame:
        """A derived table written once and read back, as the pipeline does with its
        silver tables: for plans that read it several times or aggregate it widely."""
        if name not in self._stored:
            self.__dict__[name] = self._stored[name] = materialize(getattr(self, name))
        return self._stored[name]

    # -- raw text tables ---------------------------------------------------
    @cached_property
    def raw_readings(self) -> DataFrame:
        hour = """date_format(ts, "yyyy-MM-dd'T'HH") AS hour"""  # formatted once, as it is the dear part of a row
        keyed = self.table("events").selectExpr("*", "cast(get_json_object(props, '$.k') AS int) AS k", hour)
        return keyed.selectExpr(*text_columns(READING_TEXT))

    @cached_property
    def raw_meters(self) -> DataFrame:
        return self.table("customer").selectExpr(*text_columns(METER_TEXT))

    @cached_property
    def raw_facilities(self) -> DataFrame:
        joined = self.table("nation").join(self.table("region"), F.expr("n_regionkey = r_regionkey"))
        return joined.selectExpr(*text_columns(FACILITY_TEXT))

    @cached_property
    def raw_flow(self) -> DataFrame:
        return self.table("lineitem").selectExpr(*text_columns(FLOW_TEXT))

    @cached_property
    def raw_nominations(self) -> DataFrame:
        joined = self.table("orders").join(self.table("customer"), F.expr("o_custkey = c_custkey"))
        return joined.selectExpr(*text_columns(NOMINATION_TEXT))

    @cached_property
    def raw_runs(self) -> DataFrame:
        sized = self.table("orders").selectExpr(
            "*", "if(floor(o_totalprice) % 50 = 0, 0, floor(o_totalprice)) AS rows_read"
        )
        rejected = sized.selectExpr(
            "*", "CASE o_orderstatus WHEN 'F' THEN rows_read div 10 WHEN 'P' THEN rows_read div 100 ELSE 0 END AS rows_rejected"
        )
        return rejected.selectExpr(*text_columns(RUN_TEXT))

    @cached_property
    def raw_tickets(self) -> DataFrame:
        return self.table("orders").selectExpr(*text_columns(TICKET_TEXT))

    @cached_property
    def raw_scenarios(self) -> DataFrame:
        columns = [entry.partition(":")[0] for entry in SPECS["known_issue_scenarios"]]
        return self.spark.createDataFrame(scenario_rows(), ", ".join(f"{c} string" for c in columns))

    @cached_property
    def raw_catalogue(self) -> DataFrame:
        columns = [e.partition(":")[0] for e in SPECS["dq_rules_reference"] if "<" not in e]
        return self.spark.createDataFrame(catalogue_rows(), ", ".join(f"{c} string" for c in columns))

    @cached_property
    def tuned_catalogue(self) -> DataFrame:
        columns = [e.partition(":")[0] for e in SPECS["dq_rules_reference"] if "<" not in e]
        rows = {r[0]: dict(zip(columns, r, strict=True)) for r in catalogue_rows()}
        for rule_id, change in TUNED_RULES.items():
            rows[rule_id] = rows.get(rule_id, {}) | change
        raw = self.spark.createDataFrame([tuple(r[c] for c in columns) for r in rows.values()], ", ".join(f"{c} string" for c in columns))
        return standardize_table(raw, "dq_rules_reference")

    # -- typed tables ------------------------------------------------------
    @cached_property
    def readings(self) -> DataFrame:
        return standardize_table(self.raw_readings, "raw_polling_readings")

    @cached_property
    def meters(self) -> DataFrame:
        return standardize_table(self.raw_meters, "meter_master")

    @cached_property
    def facilities(self) -> DataFrame:
        return standardize_table(self.raw_facilities, "facility_master")

    @cached_property
    def flow(self) -> DataFrame:
        return standardize_table(self.raw_flow, "flow_computer_extract")

    @cached_property
    def nominations(self) -> DataFrame:
        return standardize_table(self.raw_nominations, "nominations_daily")

    @cached_property
    def runs(self) -> DataFrame:
        return standardize_table(self.raw_runs, "pipeline_run_log")

    @cached_property
    def tickets(self) -> DataFrame:
        return standardize_table(self.raw_tickets, "support_tickets")

    @cached_property
    def scenarios(self) -> DataFrame:
        return standardize_table(self.raw_scenarios, "known_issue_scenarios")

    @cached_property
    def catalogue(self) -> DataFrame:
        return standardize_table(self.raw_catalogue, "dq_rules_reference")

    # -- event documents ---------------------------------------------------
    @cached_property
    def first_documents(self) -> DataFrame:
        """An event for every reading."""
        return events.build_documents(self.stored("readings"), FIRST_BATCH, ingested_at="2024-02-01T00:00:00")

    @cached_property
    def retry_documents(self) -> DataFrame:
        """A second, later event for readings at low pressure, now stale."""
        chosen = self.stored("readings").where("pressure < 704")
        later = events.build_documents(
            chosen.withColumn("raw_status", F.lit("STALE")), RETRY_BATCH, ingested_at="2024-02-01T01:00:00"
        )
        return later.withColumn("event_id", F.concat("event_id", F.lit("-R1")))

    @cached_property
    def documents(self) -> DataFrame:
        return self.first_documents.unionByName(self.retry_documents)

    @cached_property
    def document_lines(self) -> DataFrame:
        """The documents as JSON text, one per row."""
        columns = sorted(self.documents.columns)
        return events.with_iso_times(self.documents).select(events.json_text(F.struct(*columns)).alias("value"))

    @cached_property
    def received_lines(self) -> DataFrame:
        """The documents' lines as a source may send them: some cut short, some in an array,
        some blank."""
        columns = sorted(self.documents.columns)
        line = events.json_text(F.struct(*columns))
        n = F.expr("cast(substring(raw_reading_id, 5) AS bigint) % 97")
        sent = F.when(n == 5, F.substring(line, 1, 40)).when(n == 6, F.concat(F.lit("["), line, F.lit("]"))).when(n == 7, "   ").otherwise(line)
        return events.with_iso_times(self.documents).select(sent.alias("value"))

    @cached_property
    def landing(self) -> Landing:
        """The received lines as a file of text, landed."""
        folder = f"{shared_folder(self.spark)}/plumbline/received-{uuid.uuid4().hex}"
        self.received_lines.write.text(folder)
        return read_event_documents(self.spark, folder, "run-0001")

    @cached_property
    def flat_events(self) -> DataFrame:
        return events.flatten_documents(self.documents)

    @cached_property
    def events(self) -> DataFrame:
        return standardize_table(self.flat_events, "meter_polling_events")

    # -- checked readings and facts ----------------------------------------
    @cached_property
    def enriched(self) -> DataFrame:
        readings = self.stored("readings")
        return enrich.enrich_readings(readings, self.meters, self.facilities, self.events)

    @cached_property
    def checked(self) -> DataFrame:
        return rules.check_readings(self.enriched, self.ctx)

    @cached_property
    def exceptions(self) -> DataFrame:
        return rules.explode_exceptions(self.checked, detected_at=DETECTED_AT)

    @cached_property
    def exception_fact(self) -> DataFrame:
        return facts.exception_fact(self.exceptions, AS_OF)

    @cached_property
    def meter_days(self) -> DataFrame:
        return facts.meter_daily(self.stored("checked"))

    @cached_property
    def meter_day_measures(self) -> DataFrame:
        """Meter-days for plans that use neither their sets nor their distinct counts: one
        pass over the readings, which are stored only if something else asked for it, with
        only those columns of the events that rules and measures read."""
        if "checked" in self._stored:
            return facts.meter_daily(self.checked)
        context = self.events.select("raw_reading_id", "event_ingested_at", "event_id", *RULE_EVENT_COLUMNS)
        enriched = enrich.enrich_readings(self.stored("readings"), self.meters, self.facilities, context)
        return facts.meter_daily(rules.check_readings(enriched, self.ctx))

    @cached_property
    def facility_days(self) -> DataFrame:
        return facts.facility_daily(self.meter_day_measures)

    @cached_property
    def actual_vs_nominated(self) -> DataFrame:
        return facts.actual_vs_nominated(self.facility_days, self.nominations)

    @cached_property
    def flow_reconciliation(self) -> DataFrame:
        return facts.flow_reconciliation(self.meter_day_measures, self.flow)

    @cached_property
    def run_fact(self) -> DataFrame:
        return facts.run_fact(self.runs)

    @cached_property
    def ticket_fact(self) -> DataFrame:
        return facts.ticket_fact(self.tickets, AS_OF)

    @cached_property
    def exception_summary(self) -> DataFrame:
        return summaries.exception_summary_daily(self.stored("exception_fact"))

    @cached_property
    def health(self) -> DataFrame:
        return summaries.pipeline_health(self.run_fact)

    @cached_property
    def rca_context(self) -> DataFrame:
        return rca.rca_context(self.exception_summary, self.scenarios)

    @cached_property
    def stage_frames(self) -> list[DataFrame]:
        checked = self.stored("checked")
        return [
            self.raw_readings, self.readings, checked, rules.split_valid(checked),
            rules.split_exceptions(checked), self.meter_days, self.facility_days, self.exception_fact,
        ]

    @cached_property
    def stages(self) -> DataFrame:
        return reconcile.reconciliation_fact(self.stage_frames)

    # -- review state ------------------------------------------------------
    @cached_property
    def raw_reviews(self) -> DataFrame:
        return self.table("orders").selectExpr(*text_columns(REVIEW_TEXT), "o_orderdate")

    @cached_property
    def old_reviews(self) -> DataFrame:
        return state.clean_reviews(self.raw_reviews.where("o_orderdate < DATE '1999-01-01'"))

    @cached_property
    def new_reviews(self) -> DataFrame:
        return state.clean_reviews(self.raw_reviews.where("o_orderdate >= DATE '1999-01-01'"))

    @cached_property
    def reviews(self) -> DataFrame:
        return self.old_reviews.unionByName(self.new_reviews)

    @cached_property
    def stored_triage(self) -> DataFrame:
        empty = self.old_reviews.limit(0).withColumns(
            {"updated_at": F.col("reviewed_at"), "created_at": F.col("reviewed_at")}
        )
        return state.triage_upsert(empty, self.old_reviews)
