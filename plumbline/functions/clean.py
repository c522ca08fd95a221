"""Text cleaning and lenient parsing.

Every parser returns NULL for text it cannot read: ANSI mode is on in current
Spark, so the strict casts would fail the whole job on one bad row. The kinds are
SQL templates, so a wide table is one ``selectExpr`` and not hundreds of calls
into the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT = "nullif(trim(cast({0} AS string)), '')"
CODE = f"upper({TEXT})"

# What each kind of a table spec means (see operators/standardize.py).
KINDS = {
    # Trimmed text; blank text becomes NULL.
    "text": TEXT,
    # A cleaned status code in upper case.
    "code": CODE,
    # Y/N in any case and padding to boolean, anything else to NULL.
    "flag": f"CASE {CODE} WHEN 'Y' THEN true WHEN 'N' THEN false END",
    # A cast leaves out blanks around a date or time by itself, and takes blank text for NULL.
    "date": "try_cast(cast({0} AS string) AS date)",
    # Zone-free; text with an offset becomes UTC.
    "timestamp": "CASE WHEN trim(cast({0} AS string)) RLIKE '[0-9]:[0-9.:]+ *([zZ]|[+-][0-9:]+)$' THEN cast(to_utc_timestamp(try_cast(cast({0} AS string) AS timestamp), current_timezone()) AS timestamp_ntz) ELSE try_cast(cast({0} AS string) AS timestamp_ntz) END",
    "double": "try_cast({0} AS double)",
    "int": "try_cast({0} AS int)",
    "long": "try_cast({0} AS bigint)",
}


def quoted(name: str) -> str:
    """A column or nested field name for use in SQL text."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def sql_text(value: object) -> str:
    """A literal for use in SQL text."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value).lower() if isinstance(value, bool) else str(value)


def kind_sql(kind: str, name: str) -> str:
    return KINDS[kind].format(quoted(name))


def clean_string(name: str) -> Column:
    return F.expr(kind_sql("text", name))


def upper_code(name: str) -> Column:
    return F.expr(kind_sql("code", name))


def yes_no(name: str) -> Column:
    return F.expr(kind_sql("flag", name))


def parse_date(name: str) -> Column:
    return F.expr(kind_sql("date", name))


def parse_timestamp(name: str) -> Column:
    return F.expr(kind_sql("timestamp", name))


def parse_double(name: str) -> Column:
    return F.expr(kind_sql("double", name))


def parse_int(name: str) -> Column:
    return F.expr(kind_sql("int", name))


def parse_long(name: str) -> Column:
    return F.expr(kind_sql("long", name))


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def lenient_cast(value: str | Column, data_type: str) -> Column:
    """Any scalar to ``data_type``; an unreadable value is NULL, never an error."""
    return as_column(value).try_cast(data_type)


def is_true(condition: Column) -> Column:
    """Null-safe boolean: NULL counts as false."""
    return F.coalesce(condition, F.lit(False))


def safe_divide(numerator: str | Column, denominator: str | Column) -> Column:
    """Double division; a NULL or zero denominator gives NULL."""
    return F.try_divide(as_column(numerator).cast("double"), as_column(denominator).cast("double"))
