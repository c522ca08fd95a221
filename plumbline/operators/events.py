"""Event documents: selecting rows, building, flattening and merging documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.clean import is_true, quoted, sql_text
from plumbline.operators.rules import ACCEPTED_QUALITY_CODES
from plumbline.operators.skew import smallest_by_hash

# Statuses of a reading that needs no event (fixed values).
NORMAL_STATUSES = ("VALID", "REVIEW")

# Known scenario of a raw status (fixed values).
SCENARIO_OF_STATUS = {
    "NO_SIGNAL": "SCN-001",
    "DUPLICATE_RETRY": "SCN-002",
    "INVALID_METER": "SCN-003",
    "LATE_ARRIVAL": "SCN-004",
    "STALE": "SCN-005",
    "FUTURE_DATE": "SCN-006",
    "FACILITY_MISMATCH": "SCN-010",
    "INVALID_QUALITY_CODE": "SCN-011",
    "NULL_VOLUME": "SCN-013",
    "NEGATIVE_VOLUME": "SCN-014",
}

# What the device reported, by kind of anomaly, in order of precedence; a field
# not named keeps its default (fixed values).
CONTEXT_DEFAULTS = {
    "device_status": "ONLINE",
    "communication_status": "NORMAL",
    "battery_status": "OK",
    "polling_error_code": None,
    "signal_quality": "GOOD",
    "retry_count": 0,
}
CONTEXT_CASES = (
    ("NO_SIGNAL", {"device_status": "NO_SIGNAL", "communication_status": "FAILED",
                   "battery_status": "LOW", "polling_error_code": "COMMUNICATION_FAILURE",
                   "signal_quality": "NONE"}),
    ("STALE", {"communication_status": "STALE", "polling_error_code": "STALE_TAG",
               "signal_quality": "STALE"}),
    ("LATE_ARRIVAL", {"communication_status": "DELAYED", "polling_error_code": "LATE_ARRIVAL"}),
    ("DUPLICATE_RETRY", {"communication_status": "RETRY_DUPLICATE",
                         "polling_error_code": "DUPLICATE_RETRY", "retry_count": 1}),
    ("INVALID_METER", {"device_status": "UNKNOWN_DEVICE", "communication_status": "UNKNOWN",
                       "polling_error_code": "METER_NOT_IN_MASTER", "signal_quality": "UNKNOWN"}),
    ("INVALID_QUALITY_CODE", {"polling_error_code": "INVALID_QUALITY_CODE",
                              "signal_quality": "UNKNOWN"}),
    ("NULL_VOLUME", {"polling_error_code": "NULL_VOLUME"}),
    ("NEGATIVE_VOLUME", {"device_status": "SENSOR_ANOMALY", "polling_error_code": "NEGATIVE_VOLUME",
                         "signal_quality": "BAD"}),
    ("FACILITY_MISMATCH", {"polling_error_code": "FACILITY_MISMATCH"}),
    ("FUTURE_DATE", {"polling_error_code": "FUTURE_DATE"}),
)

# Document layout (fixed values). All scalars are read as text and cast
# leniently, so one bad number never costs the rest of the document.
PAYLOAD_FIELDS = {
    "volume": "double", "pressure": "double", "temperature": "double", "quality_code": "string",
    "raw_status": "string", "device_status": "string", "communication_status": "string",
    "battery_status": "string", "polling_error_code": "string", "signal_quality": "string",
    "retry_count": "int", "schema_version": "string",
}
HEAD_FIELDS = (
    "event_id", "raw_reading_id", "source_system", "polling_platform", "meter_id", "facility_id",
    "event_timestamp", "production_date", "gas_day", "poll_timestamp", "load_timestamp", "payload_type",
)
TAIL_FIELDS = (
    "raw_message_source", "source_file", "source_batch_id", "seed_batch_id", "scenario_id",
    "ingested_at", "last_seed_attempt_at", "last_seed_batch_id",
)


KEEP_NULLS = "map('ignoreNullFields', 'false')"


def document_schema() -> T.StructType:
    """Schema of a stored document; fields in name order, as they are written."""
    payload = T.StructType([T.StructField(f, T.StringType()) for f in sorted(PAYLOAD_FIELDS)])
    fields = {f: T.StringType() for f in ("_id", *HEAD_FIELDS, *TAIL_FIELDS)}
    fields["payload"] = payload
    return T.StructType([T.StructField(f, fields[f]) for f in sorted(fields)])


def parse_documents(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON text to document columns; the text itself is kept as ``_raw_text``."""
    doc = F.from_json(F.col(column), document_schema(), {"mode": "PERMISSIVE"})
    return lines.select(F.col(column).alias("_raw_text"), doc.alias("d")).select("_raw_text", "d.*")


# Why a received line is no document (our own names).
BLANK_LINE, BROKEN_JSON, NOT_AN_OBJECT = "BLANK_LINE", "BROKEN_JSON", "NOT_AN_OBJECT"


def reject_reason(column: str = "value") -> Column:
    """Why a received line holds no JSON document; NULL if it holds one."""
    text = F.col(column)
    return (
        F.when(text.isNull() | (F.trim(text) == ""), BLANK_LINE)
        .when(F.try_parse_json(text).isNull(), BROKEN_JSON)
        .when(~F.ltrim(text).startswith("{"), NOT_AN_OBJECT)
    )


def unreadable_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The lines that hold no JSON document, as received: a reject table."""
    return lines.where(reject_reason(column).isNotNull())


def flatten_documents(docs: DataFrame) -> DataFrame:
    """Nested documents to the 35 flat event columns, raw JSON preserved: the received text
    where ``parse_documents`` kept it, else the document written out again."""
    present = [f for f in document_schema().fieldNames() if f in docs.columns]

    def text(name: str) -> str:
        return iso_sql(docs, name) if name in present else "cast(NULL AS string)"

    stored = ", ".join(f"'{f}', {f if f == 'payload' else text(f)}" for f in present)
    received = "_raw_text" if "_raw_text" in docs.columns else f"to_json(named_struct({stored}), {KEEP_NULLS})"
    return docs.selectExpr(
        f"{text('_id')} AS object_id",
        *[f"{text(f)} AS {f}" for f in HEAD_FIELDS],
        *[f"try_cast(payload.{f} AS {kind}) AS payload_{f}" for f, kind in PAYLOAD_FIELDS.items()],
        *[f"{text(f)} AS {f}" for f in TAIL_FIELDS],
        f"to_json(payload, {KEEP_NULLS}) AS payload_json",
        f"{received} AS raw_document_json",
    )


def iso_sql(df: DataFrame, column: str) -> str:
    """Any scalar as text; times in ISO form, fractions kept."""
    is_time = isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType))
    value = f"cast({quoted(column)} AS string)"
    return f"replace({value}, ' ', 'T')" if is_time else value


def with_iso_times(df: DataFrame) -> DataFrame:
    """Time columns as ISO text, ready to go into JSON."""
    times = (T.TimestampType, T.TimestampNTZType)
    return df.selectExpr(
        *[
            f"{iso_sql(df, f.name)} AS {quoted(f.name)}" if isinstance(f.dataType, times) else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def json_text(value: str | Column) -> Column:
    """JSON with NULL fields kept, as text that can be hashed."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def of_batch(df: DataFrame, batch_id: str, column: str = "seed_batch_id") -> DataFrame:
    return df.where(F.col(column) == batch_id)


def without_batch(df: DataFrame, batch_id: str, column: str = "seed_batch_id") -> DataFrame:
    """Everything but one batch; rows without a batch stay."""
    return df.where(~is_true(F.col(column) == batch_id))


def require_nonempty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise RuntimeError(f"No rows found: {what}")
    return df


def is_anomaly() -> Column:
    """Missing or non-positive volume, unknown code, or a status that is not normal."""
    volume = F.col("volume")
    return (
        volume.isNull()
        | is_true(volume <= 0)
        | ~is_true(F.col("quality_code").isin(*ACCEPTED_QUALITY_CODES))
        | ~is_true(F.col("raw_status").isin(*NORMAL_STATUSES))
    )


def select_anomalies(readings: DataFrame) -> DataFrame:
    return readings.where(is_anomaly())


def anomalies_plus_sample(readings: DataFrame, n: int, seed: str = "42", key: str = "raw_reading_id") -> DataFrame:
    """All anomalies and n normal rows, the choice repeatable for a seed."""
    normal = readings.where(~is_anomaly())
    return select_anomalies(readings).unionByName(smallest_by_hash(normal, key, n, seed))


def _context_literal(values: Mapping[str, object]) -> str:
    types = {"retry_count": "int"}
    fields = (
        f"'{f}', cast({sql_text(v)} AS {types.get(f, 'string')})" for f, v in (CONTEXT_DEFAULTS | dict(values)).items()
    )
    return f"named_struct({', '.join(fields)})"


def event_context() -> Column:
    """Six device fields of a reading as a struct: its kind of anomaly, looked up
    in a literal table."""
    accepted = ", ".join(sql_text(c) for c in ACCEPTED_QUALITY_CODES)
    tests = {
        "STALE": "raw_status = 'STALE' OR quality_code = 'STALE'",
        "INVALID_QUALITY_CODE": f"raw_status = 'INVALID_QUALITY_CODE' OR NOT coalesce(quality_code IN ({accepted}), false)",
        "NULL_VOLUME": "raw_status = 'NULL_VOLUME' OR volume IS NULL",
    }
    cases = " ".join(
        f"WHEN {tests.get(kind, f'raw_status = {sql_text(kind)}')} THEN {sql_text(kind)}" for kind, _ in CONTEXT_CASES
    )
    table = ", ".join(f"{sql_text(kind)}, {_context_literal(values)}" for kind, values in (("NORMAL", {}), *CONTEXT_CASES))
    return F.expr(f"try_element_at(map({table}), CASE {cases} ELSE 'NORMAL' END)")


def scenario_of_status(status: str = "raw_status") -> Column:
    pairs = [F.lit(x) for pair in SCENARIO_OF_STATUS.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.col(status))


def build_documents(
    readings: DataFrame,
    batch_id: str,
    *,
    ingested_at: str | None = None,
    schema_version: str = "meter_event_v1",
    message_source: str = "plumbline",
    source_file: str = "raw_polling_readings.csv",
) -> DataFrame:
    """One nested event document per reading."""
    stamp = "current_timestamp()" if ingested_at is None else sql_text(ingested_at)
    context = ", ".join(f"'{f}', _context.{f}" for f in CONTEXT_DEFAULTS)
    measured = ", ".join(f"'{f}', {f}" for f in ("volume", "pressure", "temperature", "quality_code", "raw_status"))
    return readings.withColumn("_context", event_context()).select(
        F.expr("concat('EVT-', raw_reading_id)").alias("event_id"),
        "raw_reading_id", "source_system", "polling_platform", "meter_id",
        F.col("source_facility_id").alias("facility_id"),
        F.col("reading_timestamp").alias("event_timestamp"),
        "production_date", "gas_day", "poll_timestamp", "load_timestamp",
        F.lit("meter_reading").alias("payload_type"),
        F.expr(f"named_struct({measured}, {context}, 'schema_version', {sql_text(schema_version)})").alias("payload"),
        F.lit(message_source).alias("raw_message_source"),
        F.lit(source_file).alias("source_file"),
        F.col("batch_id").alias("source_batch_id"),
        F.lit(batch_id).alias("seed_batch_id"),
        scenario_of_status().alias("scenario_id"),
        F.expr(f"cast({stamp} AS timestamp_ntz)").alias("ingested_at"),
    )


def upsert_documents(
    stored: DataFrame, incoming: DataFrame, attempted_at: str, key: str = "event_id", batch: str = "seed_batch_id"
) -> DataFrame:
    """Insert-if-absent: a stored body always wins, the last-attempt fields are
    refreshed for every incoming id. Running it twice changes nothing more. The
    result has the columns of both sides.

    One aggregation over both sides; each task merges its own rows first.
    """
    last = ("last_seed_attempt_at", "last_seed_batch_id")
    skip = {key, *last}
    kinds = {f.name: f.dataType for df in (incoming, stored) for f in df.schema.fields if f.name not in skip}
    body = [*kinds]
    missing = lambda df: df.withColumns({c: F.lit(None).cast(t) for c, t in kinds.items() if c not in df.columns})
    stored, incoming = missing(stored), missing(incoming)
    old = stored.select(
        key, F.lit(0).alias("_side"), F.struct(*body).alias("_body"),
        F.col(last[0]).cast("timestamp_ntz").alias(last[0]), F.col(last[1]).alias(last[1]),
    )
    new = incoming.select(
        key, F.lit(1).alias("_side"), F.struct(*body).alias("_body"),
        F.lit(attempted_at).cast("timestamp_ntz").alias(last[0]), F.col(batch).alias(last[1]),
    )
    fresh = F.struct(*last)
    rank = F.struct("_side", last[0], last[1])
    merged = old.unionByName(new).groupBy(key).agg(
        F.min_by("_body", F.struct("_side", F.xxhash64("_body"))).alias("_body"), F.max_by(fresh, rank).alias("_last")
    )
    return merged.select(key, "_body.*", "_last.*")
