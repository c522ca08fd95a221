"""Publishing a set of tables to one warehouse, all or none.

Every table is shaped to what its target looks like now and written beside it, its rows
counted on the way. Only if every staged table passes its check do the targets change, and
then in one transaction at the target: a reader sees the old set or the new one. If a check
or the exchange fails, all targets keep their old rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import publish, reconcile
from plumbline.session import materialize
from plumbline.sources import remote

STAGED = "__staged"


@dataclass(frozen=True)
class PublishTarget:
    """A table to publish. ``definition`` (columns and SQL types) creates a target that does
    not exist yet; one that exists is taken as it is. Without ``expected_rows`` the source
    rows are what is expected."""

    table: str
    frame: DataFrame
    definition: publish.Target | None = None
    description: str = ""
    expected_rows: int | None = None
    aliases: Mapping[str, Sequence[str]] = field(default_factory=dict)


class PublishAborted(RuntimeError):
    """A check did not pass. ``summary`` has a row per table; no target has changed."""

    def __init__(self, message: str, summary: DataFrame):
        super().__init__(message)
        self.summary = summary


SUMMARY = (
    "publish_run_id string, target_table string, description string, expected_rows bigint, source_rows bigint, "
    "written_rows bigint, lost_values bigint, schema_changes string, published_at_utc string"
)


def _live_schema(spark: SparkSession, options: Mapping[str, str], target: PublishTarget, stamps: Mapping[str, Column]) -> publish.Target:
    """What the target looks like now; a missing one is created, empty."""
    try:
        return remote.table_schema(spark, options, target.table)
    except Exception as problem:  # drivers raise their own kinds
        if "not exist" not in str(problem).lower() and "not found" not in str(problem).lower():
            raise
    wanted = target.definition or target.frame.schema
    empty = publish.align_to_target(target.frame.limit(0), wanted, target.aliases)
    empty = publish.flatten_complex(empty.select("*", *[c.alias(n) for n, c in stamps.items() if n not in empty.columns]))
    remote.publish(empty, options, target.table, keep_definition=False)
    return remote.table_schema(spark, options, target.table)


def _stage(spark: SparkSession, options: Mapping[str, str], target: PublishTarget, stamps: Mapping[str, Column]) -> dict:
    """Write one table beside its target; what was read, written and lost. The shaped table
    is stored first, which computes it once and counts it on the way: a write over JDBC
    reports no counts."""
    live = _live_schema(spark, options, target, stamps)
    by_name = {name.lower(): value for name, value in stamps.items()}
    changes = [c for c in publish.schema_changes(target.frame, live, target.aliases) if c.column.lower() not in by_name]
    lost = publish.lost_values(target.frame, live, target.aliases)
    seen = Observation()
    total = sum((F.count_if(c) for c in lost.values()), F.lit(0))
    observed = target.frame.observe(seen, F.count(F.lit(1)).alias("rows"), total.cast("bigint").alias("lost"))
    aligned = materialize(publish.align_to_target(observed, live, target.aliases, by_name))
    _, written = remote.publish(aligned, options, target.table + STAGED, keep_definition=False)
    return {
        "target_table": target.table,
        "description": target.description,
        "expected_rows": seen.get["rows"] if target.expected_rows is None else target.expected_rows,
        "source_rows": seen.get["rows"],
        "written_rows": written,
        "lost_values": seen.get["lost"],
        "schema_changes": ", ".join(f"{c.change} {c.column}" for c in changes),
        "columns": [f.name for f in live.fields],
    }


def publish_all(
    spark: SparkSession,
    options: Mapping[str, str],
    targets: Sequence[PublishTarget],
    run_id: str,
    *,
    warehouse: str = "warehouse",
    published_at: str | None = None,
    abort_on_loss: bool = False,
) -> DataFrame:
    """Publish all ``targets`` or none; returns a row per table with its status.

    A table whose counts do not agree, or with ``abort_on_loss`` one that loses values to a
    narrower column, stops the whole set with ``PublishAborted``; the staged tables stay
    for a look at them. ``options`` are those of a JDBC target, driver included.
    """
    if not targets:
        raise ValueError("Nothing to publish")
    names = [publish.require_identifier(t.table, "target table").lower() for t in targets]
    if len({*names}) < len(names):
        raise ValueError("A target is named twice")
    when = published_at or datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S")
    stamps = {f"_{warehouse}_publish_run_id": F.lit(run_id), f"_{warehouse}_published_at_utc": F.lit(when).cast("timestamp")}
    staged = [_stage(spark, options, t, stamps) for t in targets]
    rows = [{k: v for k, v in s.items() if k != "columns"} | {"publish_run_id": run_id, "published_at_utc": when} for s in staged]
    status = reconcile.publish_status()
    if abort_on_loss:
        status = F.when(F.col("lost_values") > 0, "FAIL").otherwise(status)
    summary = spark.createDataFrame(rows, SUMMARY).withColumn("status", status)
    try:
        reconcile.require_all_pass(summary)
    except RuntimeError as problem:
        raise PublishAborted(str(problem), summary) from None
    exchange = []
    for s in staged:
        columns = ", ".join('"' + c.replace('"', '""') + '"' for c in s["columns"])
        exchange += [f"DELETE FROM {s['target_table']}", f"INSERT INTO {s['target_table']} ({columns}) SELECT {columns} FROM {s['target_table']}{STAGED}"]
    remote.run_in_transaction(spark, options, exchange)
    remote.run_in_transaction(spark, options, [f"DROP TABLE {s['target_table']}{STAGED}" for s in staged])
    return summary


def support_targets(tables: Mapping[str, DataFrame], expected: Mapping[str, int] | None = None) -> list[PublishTarget]:
    """The support tables that are present, with their definitions and aliases."""
    stamps = (("_support_publish_run_id", "varchar(200)"), ("_support_published_at_utc", "datetime2(3)"))
    return [
        PublishTarget(name, tables[name], (*publish.SUPPORT_TABLES[name], *stamps), expected_rows=(expected or {}).get(name), aliases=publish.SUPPORT_ALIASES.get(name, {}))
        for name in publish.SUPPORT_TABLES
        if name in tables
    ]
