"""Review state: triage status, notes, review log and activity.

State tables are plain tables. An update is a new version of the table computed
from the old one and the incoming rows (see sources.tables.replace_table).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.clean import is_true
from plumbline.functions.keys import present_text, review_group_key
from plumbline.operators.events import json_text

DEFAULTS = {"status": "Not reviewed", "priority": "Medium", "updated_by": "app_user"}
ACTION = "SAVE_AI_RCA_REVIEW"
TRIAGE_FIELDS = (
    "exception_id", "production_date", "facility_id", "facility_name", "exception_type", "severity",
    "status", "priority", "assigned_to", "updated_by",
)


def accepted_flag(decision: str = "status") -> Column:
    """Resolved accepts, Ignored rejects, anything else leaves it open."""
    return F.when(F.col(decision) == "Resolved", True).when(F.col(decision) == "Ignored", False)


def clean_reviews(reviews: DataFrame) -> DataFrame:
    """Incoming reviews with group key, cleaned texts and defaults.

    Optional columns that are absent count as missing.
    """
    optional = (
        "exception_id", "facility_name", "assigned_to", "note_text", "updated_by", "prompt_text",
        "response_text", "ai_provider", "reviewer_decision", "reviewer_comments", "priority", "status",
    )
    filled = reviews.withColumns(
        {c: F.lit(None).cast("string") for c in optional if c not in reviews.columns}
    )
    keyed = filled.withColumn(
        "exception_group_key", review_group_key("production_date", "facility_id", "exception_type", "severity")
    )
    texts = [*optional, "facility_id", "exception_type", "severity"]
    cleaned = keyed.withColumns({c: present_text(c) for c in texts})
    defaulted = cleaned.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in DEFAULTS.items()})
    return defaulted.withColumns(
        {
            "reviewer_decision": F.coalesce("reviewer_decision", "status"),
            "reviewer_comments": F.coalesce("reviewer_comments", "note_text"),
            "accepted_flag": accepted_flag("status"),
        }
    )


def triage_upsert(stored: DataFrame, reviews: DataFrame, at: str = "reviewed_at") -> DataFrame:
    """One row per group key: the latest review wins, the creation time stays."""
    key = "exception_group_key"
    body = F.struct(*TRIAGE_FIELDS, F.col("updated_at"))
    old = stored.select(key, body.alias("body"), F.lit(0).alias("side"), "created_at")
    new = reviews.withColumn("updated_at", F.col(at)).select(
        key, body.alias("body"), F.lit(1).alias("side"), F.col(at).alias("created_at")
    )
    latest = F.max_by("body", F.struct("side", F.col("body.updated_at"), F.xxhash64("body")))
    created = F.min_by("created_at", F.struct("side", "created_at"))
    merged = old.unionByName(new).groupBy(key).agg(latest.alias("body"), created.alias("created_at"))
    return merged.select(key, "body.*", "created_at")


def note_rows(reviews: DataFrame, at: str = "reviewed_at") -> DataFrame:
    """A note per review that has one."""
    return reviews.where(F.col("note_text").isNotNull()).select(
        "exception_group_key", "exception_id", "note_text",
        F.col("updated_by").alias("created_by"), F.col(at).alias("created_at"),
    )


def review_log_rows(reviews: DataFrame, at: str = "reviewed_at") -> DataFrame:
    return reviews.select(
        "exception_group_key", "exception_id", "ai_provider", "prompt_text", "response_text",
        "reviewer_decision", "accepted_flag", "reviewer_comments",
        F.col("updated_by").alias("reviewed_by"), F.col(at).alias("reviewed_at"),
    )


def activity_rows(reviews: DataFrame, at: str = "reviewed_at") -> DataFrame:
    """Audit row per review, its detail as JSON."""
    detail = F.struct(
        "status", "priority", "assigned_to", F.col("note_text").isNotNull().alias("note_inserted")
    )
    return reviews.select(
        F.col("updated_by").alias("user_id"),
        F.lit(ACTION).alias("action_type"),
        F.lit("exception_group").alias("object_type"),
        F.col("exception_group_key").alias("object_id"),
        json_text(detail).alias("activity_detail"),
        F.col(at).alias("created_at"),
    )


def delete_by_key(df: DataFrame, **equal: str) -> DataFrame:
    """All rows but those where every named column has the given value."""
    same = reduce(lambda a, b: a & b, [is_true(F.col(c) == v) for c, v in equal.items()])
    return df.where(~same)


def state_counts(triage: DataFrame, notes: DataFrame, log: DataFrame, activity: DataFrame) -> DataFrame:
    """Rows per state table, as one row."""
    named = {"triage_rows": triage, "note_rows": notes, "ai_review_rows": log, "activity_rows": activity}
    tagged = [df.select(F.lit(name).alias("what")) for name, df in named.items()]
    everything = reduce(DataFrame.unionByName, tagged)
    return everything.agg(*[F.count_if(F.col("what") == name).alias(name) for name in named])
