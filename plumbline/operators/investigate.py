"""Finding and explaining exceptions: filters, search, context."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.events import json_text
from plumbline.operators.skew import find_hot_keys, left_join_unique

# What the context of one exception shows (fixed values).
CONTEXT_FIELDS = (
    "exception_id", "rule_id", "raw_reading_id", "production_date", "reading_timestamp",
    "facility_id", "facility_name", "region", "basin", "meter_id", "source_system",
    "polling_platform", "volume", "quality_code", "raw_status", "event_device_status",
    "event_communication_status", "event_signal_quality", "event_scenario_id",
    "primary_exception_type",
)
RELATED_FIELDS = (
    "exception_id", "rule_id", "business_reason", "raw_reading_id", "meter_id", "reading_timestamp",
    "source_system", "polling_platform", "volume", "quality_code", "raw_status",
    "event_device_status", "event_communication_status", "event_signal_quality", "event_scenario_id",
)


def faceted_filter(
    df: DataFrame,
    facets: Mapping[str, Sequence[str]],
    *,
    date_column: str = "production_date",
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Rows within the date range (both ends included) and, per facet, with one of
    the chosen values. A facet without choices, or one the table lacks, filters
    nothing; a facet with choices drops rows where it is NULL."""
    if start is not None:
        df = df.where(F.col(date_column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(date_column) <= F.lit(end).cast("date"))
    for column, values in facets.items():
        if values and column in df.columns:
            df = df.where(F.col(column).cast("string").isin(*values))
    return df


def text_search(df: DataFrame, text: str, columns: Sequence[str]) -> DataFrame:
    """Rows where any of the columns contains the text, ignoring case. The text is
    taken literally; empty text filters nothing."""
    if not text:
        return df
    hits = [
        F.contains(F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit(text.lower())) for c in columns
    ]
    return df.where(reduce(or_, hits))


def _context_value(df: DataFrame, name: str) -> Column:
    """Dates and times go into the JSON as plain text."""
    kind = df.schema[name].dataType.typeName()
    value = F.col(name)
    return (value.cast("string") if kind in ("date", "timestamp", "timestamp_ntz") else value).alias(name)


def exception_context(fact: DataFrame, exception_id: str | None = None, fields: Sequence[str] = CONTEXT_FIELDS) -> DataFrame:
    """Exceptions with their context as JSON: one by id, or all."""
    rows = fact if exception_id is None else fact.where(F.col("exception_id") == exception_id)
    present = [_context_value(rows, c) for c in fields if c in rows.columns]
    return rows.select("exception_id", json_text(F.struct(*present)).alias("context_json"))


def _first_context(context: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Per key: how many groups are related, and what the newest says."""
    said = F.struct("exception_group_id", "scenario_name", "recommended_next_step", "rca_summary_seed")
    newest = F.max_by(said, F.struct("production_date", "exception_group_id", F.coalesce("scenario_id", F.lit(""))))
    return (
        context.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias(prefix + "count"), newest.alias(prefix + "newest"))
    )


def related_context(exceptions: DataFrame, context: DataFrame) -> DataFrame:
    """Each exception with its related root-cause context: by known scenario, or,
    when that finds nothing, by facility and exception type.

    Context is summarized per key first, so an exception gets one row however
    many groups are related.
    """
    by_scenario = _first_context(context, ["scenario_id"], "_s_").withColumnRenamed("scenario_id", "event_scenario_id")
    by_place = _first_context(context, ["facility_id", "exception_type"], "_p_")
    spread = ["exception_id"]
    place = ["facility_id", "exception_type"]
    hot_scenario, hot_place = find_hot_keys(exceptions, ["event_scenario_id"], place)
    joined = left_join_unique(exceptions, by_scenario, ["event_scenario_id"], spread_by=spread, hot=hot_scenario)
    joined = left_join_unique(joined, by_place, place, spread_by=spread, hot=hot_place)
    found = F.coalesce("_s_newest", "_p_newest")
    return joined.select(
        *exceptions.columns,
        F.when(F.col("_s_count").isNotNull(), "scenario")
        .when(F.col("_p_count").isNotNull(), "facility_and_type")
        .alias("related_by"),
        F.coalesce("_s_count", "_p_count", F.lit(0)).alias("related_count"),
        found["exception_group_id"].alias("related_group_id"),
        found["scenario_name"].alias("related_scenario_name"),
        found["recommended_next_step"].alias("related_next_step"),
        found["rca_summary_seed"].alias("related_summary"),
    )


def first_related(exceptions: DataFrame, n: int | None, fields: Sequence[str] = RELATED_FIELDS) -> DataFrame:
    """The first n exceptions (all without n) of every facility, type and day, by meter and id.

    Spark applies the limit inside each task before the shuffle, so a very large
    group sends n rows per task.
    """
    group = ["facility_id", "exception_type", "production_date"]
    order = Window.partitionBy(*group).orderBy(F.asc_nulls_last("meter_id"), "exception_id")
    ranked = exceptions.select(*group, *[f for f in fields if f in exceptions.columns])
    placed = ranked.withColumn("position", F.row_number().over(order))
    return placed if n is None else placed.where(F.col("position") <= n)


def related_exceptions(context: DataFrame, exceptions: DataFrame, n: int | None = None) -> DataFrame:
    """Every root-cause group with its first n exceptions, or all (missing facility equals
    missing facility, as in the group itself)."""
    groups = context.select(
        "exception_group_id",
        F.col("facility_id").alias("_f"), F.col("exception_type").alias("_t"), F.col("production_date").alias("_d"),
    ).distinct()
    rows = first_related(exceptions, n)
    same = (
        F.col("_f").eqNullSafe(F.col("facility_id"))
        & F.col("_t").eqNullSafe(F.col("exception_type"))
        & F.col("_d").eqNullSafe(F.col("production_date"))
    )
    return groups.join(rows, same).drop("_f", "_t", "_d")
