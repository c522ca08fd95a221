"""Reproducible keys and hashes.

Hashes cover business columns only. Run ids and processing times are left out,
so loading the same row twice gives the same hash.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.clean import as_column, kind_sql, sql_text

KEY_SEPARATOR = "||"

# Words that mean "no value" in text typed or exported by people (fixed values).
MISSING_WORDS = ("nan", "nat", "none", "null")


def sha256(value: str | Column) -> Column:
    return F.sha2(as_column(value).cast("string"), 256)


def record_hash(columns: Iterable[str]) -> Column:
    """SHA-256 over the JSON form of the given columns, in name order.

    Lineage columns (leading underscore) never take part. Map columns, which
    have no stable order, must be turned into text first.
    """
    business = sorted(c for c in columns if not c.startswith("_"))
    return F.sha2(F.to_json(F.struct(*business), {"ignoreNullFields": "false"}), 256)


def surrogate_key(column: str | Column) -> Column:
    return sha256(column)


def exception_id(rule_id: str | Column, reading_id: str, entity_id: str, timestamp: str) -> Column:
    """Stable id of one failed rule on one reading. NULL parts are skipped."""
    rule = F.lit(rule_id) if isinstance(rule_id, str) else rule_id
    parts = [rule, F.col(reading_id), F.col(entity_id), F.col(timestamp).cast("string")]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)


def exception_group_id(*columns: str) -> Column:
    """Stable id of an exception group. NULL parts count as empty text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)


def present_text(name: str) -> Column:
    """Trimmed text, with blanks and the missing words as NULL."""
    text = kind_sql("text", name)
    words = ", ".join(sql_text(w) for w in MISSING_WORDS)
    return F.expr(f"CASE WHEN lower({text}) NOT IN ({words}) THEN {text} END")


def review_group_key(production_date: str, facility: str, exception_type: str, severity: str) -> Column:
    """Readable key of a review group: date|facility|type|severity."""
    day = F.substring_index(F.substring_index(present_text(production_date), " ", 1), "T", 1)
    parts = (
        (day, "unknown_date"),
        (present_text(facility), "unknown_facility"),
        (present_text(exception_type), "unknown_exception_type"),
        (present_text(severity), "unknown_severity"),
    )
    return F.concat_ws("|", *[F.coalesce(part, F.lit(missing)) for part, missing in parts])
