"""The raw -> typed and checked -> business-ready pipeline."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import facts, rca, reconcile, rule_table, rules, summaries
from plumbline.operators.enrich import enrich_readings
from plumbline.operators.standardize import SPECS, add_layer_metadata, standardize_table
from plumbline.sources import tables
from plumbline.sources.tables import use_database, write_table


def silver_readings(silver: Mapping[str, DataFrame], ctx: rules.RuleContext, in_force: rule_table.RuleSet) -> DataFrame:
    """Enriched, checked and classified readings from the typed tables."""
    enriched = enrich_readings(
        silver["raw_polling_readings"], silver["meter_master"], silver["facility_master"],
        silver["meter_polling_events"],
    )
    return rules.check_readings(enriched, ctx, in_force.rules, in_force.order)


def gold_plans(silver: Mapping[str, DataFrame], as_of: str) -> dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]]:
    """Business tables in the order they can be built. Each plan sees the tables
    built before it, so a stored parent is read back instead of recomputed."""
    s = silver
    return {
        "dim_facility": lambda g: facts.dim_facility(s["facility_master"]),
        "dim_meter": lambda g: facts.dim_meter(s["meter_master"], s["facility_master"]),
        "fact_meter_reading_daily": lambda g: facts.meter_daily(s["meter_reading_enriched"]),
        "fact_facility_volume_daily": lambda g: facts.facility_daily(g["fact_meter_reading_daily"]),
        "fact_actual_vs_nominated_daily": lambda g: facts.actual_vs_nominated(
            g["fact_facility_volume_daily"], s["nominations_daily"]),
        "fact_flow_reconciliation_daily": lambda g: facts.flow_reconciliation(
            g["fact_meter_reading_daily"], s["flow_computer_extract"]),
        "fact_data_quality_exception": lambda g: facts.exception_fact(s["data_quality_exceptions"], as_of),
        "fact_pipeline_run": lambda g: facts.run_fact(s["pipeline_run_log"]),
        "fact_support_ticket": lambda g: facts.ticket_fact(s["support_tickets"], as_of),
        "exception_summary_daily": lambda g: summaries.exception_summary_daily(g["fact_data_quality_exception"]),
        "pipeline_health_summary": lambda g: summaries.pipeline_health(g["fact_pipeline_run"]),
        "quality_rule_summary": lambda g: summaries.ranked_rule_summary(
            s["data_quality_exceptions"], s["dq_rules_reference"]),
        "rca_context": lambda g: rca.rca_context(g["exception_summary_daily"], s["known_issue_scenarios"]),
    }


# Gold tables whose rows belong to one day, made of that day's rows only.
DAILY_FACTS = (
    "fact_meter_reading_daily", "fact_facility_volume_daily", "fact_actual_vs_nominated_daily", "fact_flow_reconciliation_daily",
    "fact_data_quality_exception", "exception_summary_daily",
)
# The typed and checked tables they are made of.
DAILY_SOURCES = ("meter_reading_enriched", "nominations_daily", "flow_computer_extract", "data_quality_exceptions")


def refresh_days(spark: SparkSession, days: Sequence[date], as_of: str, run_id: str | None = None) -> None:
    """Rebuild the daily facts of ``days`` from the stored ``silver`` tables, after late rows
    came in there. Only these days are read, and only their partitions written, whatever the
    history holds; later facts are made of the refreshed days of earlier ones."""
    if not days:
        return
    run_id = run_id or f"run_{uuid.uuid4().hex[:12]}"
    chosen = F.col("production_date").isin(*days)
    silver = {name: spark.table(f"silver.{name}") for name in (*SPECS, *DAILY_SOURCES)}
    silver |= {name: silver[name].where(chosen) for name in DAILY_SOURCES}
    plans, gold = gold_plans(silver, as_of), {}
    for table in DAILY_FACTS:
        name = f"gold.{table}"
        tables.overwrite_partitions(add_layer_metadata(plans[table](gold), "gold", name, run_id), name, "production_date", days)
        gold[table] = spark.table(name).where(chosen)


@dataclass
class Run:
    """Writes each table once, reads it back, and remembers its row count."""

    spark: SparkSession
    run_id: str = field(default_factory=lambda: f"run_{uuid.uuid4().hex[:12]}")
    file_format: str = "parquet"
    expected: Mapping[str, int] = field(default_factory=dict)
    written: list[dict] = field(default_factory=list)

    def store(self, df: DataFrame, layer: str, table: str, partition_by: tuple[str, ...] = (), *, stamp: bool = True) -> DataFrame:
        """Without ``stamp`` the table gets no columns of its own: raw tables bring theirs."""
        name = f"{layer}.{table}"
        stamped = add_layer_metadata(df, layer, name, self.run_id) if stamp else df
        rows = write_table(stamped, name, file_format=self.file_format, partition_by=partition_by)
        self.written.append({"table_name": name, "expected_rows": self.expected.get(name), "written_rows": rows})
        return self.spark.table(name)

    def rows_of(self, name: str) -> int:
        """Rows observed while a table was written."""
        return next(w["written_rows"] for w in reversed(self.written) if w["table_name"] == name)

    def summary(self) -> DataFrame:
        """One row per written table with its status."""
        schema = "table_name string, expected_rows bigint, written_rows bigint"
        return self.spark.createDataFrame(self.written, schema).withColumn("status", reconcile.layer_status())


def run_pipeline(
    spark: SparkSession,
    bronze: Mapping[str, DataFrame],
    as_of: str,
    *,
    file_format: str = "parquet",
    expected: Mapping[str, int] | None = None,
) -> Run:
    """Build and store the ``bronze``, ``silver`` and ``gold`` databases from raw tables.

    Every raw table is stored as received before anything reads it; all later tables are
    built from the stored ones. The rows that the source hands over are counted on their
    way in, and the stored Bronze rows are counted by themselves, so a lost row shows.
    The rules in force come from the stored rule catalogue.
    """
    run = Run(spark, file_format=file_format, expected=expected or {})
    for database in ("bronze", "silver", "gold"):
        use_database(spark, database)
    ctx = rules.RuleContext(as_of=as_of)

    landed = {name: run.store(bronze[name], "bronze", name, stamp=False) for name in SPECS}
    silver = {name: run.store(standardize_table(landed[name], name), "silver", name) for name in SPECS}
    in_force = rule_table.compile_rules(silver["dq_rules_reference"])
    outcome = spark.createDataFrame(sorted(in_force.outcome.items()), "rule_id string, outcome string")
    run.store(outcome, "silver", "rule_outcomes")
    by_day = ("production_date",)
    enriched = run.store(silver_readings(silver, ctx, in_force), "silver", "meter_reading_enriched", by_day)
    silver["meter_reading_enriched"] = enriched
    valid = run.store(rules.split_valid(enriched), "silver", "meter_reading_valid", by_day)
    failed = run.store(rules.split_exceptions(enriched), "silver", "meter_reading_exceptions", by_day)
    detail = rules.explode_exceptions(failed, in_force.rules)
    silver["data_quality_exceptions"] = run.store(detail, "silver", "data_quality_exceptions", by_day)
    run.store(summaries.rule_summary(silver["data_quality_exceptions"]), "silver", "quality_rule_summary")

    gold: dict[str, DataFrame] = {}
    for table, plan in gold_plans(silver, as_of).items():
        gold[table] = run.store(plan(gold), "gold", table, by_day if table in DAILY_FACTS else ())

    raw = landed["raw_polling_readings"]
    run.store(
        reconcile.silver_counts(
            [raw, landed["meter_polling_events"], enriched, valid, failed, silver["data_quality_exceptions"]]
        ),
        "silver", "reconciliation_counts",
    )
    source = spark.range(run.rows_of("bronze.raw_polling_readings"))  # as many as the source handed over
    stages = [
        source, raw, enriched, valid, failed, gold["fact_meter_reading_daily"],
        gold["fact_facility_volume_daily"], gold["fact_data_quality_exception"],
    ]
    run.store(reconcile.reconciliation_fact(stages), "gold", "fact_source_to_target_reconciliation")
    return run


def status_counts(checked: DataFrame) -> DataFrame:
    """Readings per record status and per primary exception type, largest first."""
    return summaries.distributions(checked, ["record_quality_status", "primary_exception_type"]).orderBy(
        "facet", F.desc("row_count"), F.asc_nulls_last("value")
    )
