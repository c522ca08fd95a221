"""Joining master data, event context and known scenarios to readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.clean import quoted
from plumbline.operators.rules import add_duplicate_count
from plumbline.operators.skew import HotKeys, find_hot_keys, keep_one_per_key, left_join_unique

# Names the master columns get next to a reading (fixed values): the source
# column, and the name without the "master_" prefix where it differs.
METER_COLUMNS = {
    "meter_id": "meter_id", "facility_id": "facility_id", "meter_name": "meter_name",
    "meter_type": "meter_type", "product": "product", "measurement_type": "measurement_type",
    "custody_transfer_flag": "custody_transfer_flag", "is_custody_transfer": "is_custody_transfer",
    "source_system": "source_system", "polling_platform": "polling_platform",
    "install_date": "install_date", "active_flag": "meter_active_flag",
    "is_active": "meter_is_active", "expected_min_volume": "expected_min_volume",
    "expected_max_volume": "expected_max_volume",
    "sample_interval_minutes": "sample_interval_minutes",
}
FACILITY_COLUMNS = {
    "facility_name": "facility_name", "region": "region", "basin": "basin", "state": "state",
    "asset_type": "asset_type", "operator": "operator", "active_flag": "facility_active_flag",
    "is_active": "facility_is_active", "latitude": "latitude", "longitude": "longitude",
}
EVENT_COLUMNS = {
    "event_id": "id", "payload_quality_code": "quality_code", "payload_raw_status": "raw_status",
    "payload_device_status": "device_status",
    "payload_communication_status": "communication_status",
    "payload_battery_status": "battery_status",
    "payload_polling_error_code": "polling_error_code",
    "payload_signal_quality": "signal_quality", "payload_retry_count": "retry_count",
    "payload_schema_version": "payload_schema_version", "seed_batch_id": "seed_batch_id",
    "scenario_id": "scenario_id",
}
# The preserved JSON. Joined only on request: it is by far the widest part of an
# event and no rule or fact reads it.
RAW_EVENT_COLUMNS = {"payload_json": "payload_json", "raw_document_json": "raw_document_json"}


def prefixed(df: DataFrame, prefix: str, names: dict[str, str]) -> list[str]:
    """The columns of ``names`` that ``df`` has, under the prefix."""
    present = set(df.columns)
    return [f"{quoted(c)} AS {quoted(prefix + name)}" for c, name in names.items() if c in present]


def master_dimension(meters: DataFrame, facilities: DataFrame) -> DataFrame:
    """Meters with the facility the MASTER assigns to them, under ``master_`` names."""
    meter = meters.selectExpr(*prefixed(meters, "master_", METER_COLUMNS))
    facility = facilities.selectExpr(
        "facility_id AS master_facility_id", *prefixed(facilities, "master_", FACILITY_COLUMNS)
    )
    joined = meter.join(facility, "master_facility_id", "left")
    return joined.select(*meter.columns, *[c for c in facility.columns if c not in meter.columns])


def join_master(readings: DataFrame, meters: DataFrame, facilities: DataFrame) -> DataFrame:
    """Reading, its meter, and the meter's facility.

    The two masters are joined to each other first, so the readings take part in
    one join only. Spark broadcasts the masters while they are small, else it
    shuffles on the meter and splits hot meters at run time. A master id that is
    repeated counts once, so readings are never multiplied.
    """
    rows = master_dimension(meters, facilities).where("master_meter_id IS NOT NULL")
    master = keep_one_per_key(rows, ["master_meter_id"], [F.xxhash64(*rows.columns)])
    return readings.join(master, F.col("meter_id") == F.col("master_meter_id"), "left")


def latest_event_context(
    events: DataFrame,
    *,
    keep_raw: bool = False,
    order: tuple[str, ...] = ("event_ingested_at", "event_id"),
) -> DataFrame:
    """One event per reading id, the latest, under ``event_`` names, with whatever columns
    of an event's context ``events`` has. Of events alike in ``order`` the one with the
    greater values counts."""
    names = EVENT_COLUMNS | RAW_EVENT_COLUMNS if keep_raw else EVENT_COLUMNS
    wanted = dict.fromkeys(["raw_reading_id", *order, *[c for c in names if c in events.columns]])
    usable = events.where(F.col("raw_reading_id").isNotNull()).select(*wanted)
    rest = [c for c in wanted if c != "raw_reading_id" and c not in order]
    newest = usable.groupBy("raw_reading_id").agg(F.max(F.struct(*order, *rest)).alias("_row")).select("raw_reading_id", "_row.*")
    return newest.selectExpr("raw_reading_id", *prefixed(newest, "event_", names))


def join_event_context(
    readings: DataFrame,
    events: DataFrame,
    *,
    keep_raw: bool = False,
    hot: HotKeys | None = None,
    spread_by: list[str] | None = None,
) -> DataFrame:
    """Reading and the context of its latest event. Never multiplies readings."""
    context = latest_event_context(events, keep_raw=keep_raw)
    return left_join_unique(readings, context, ["raw_reading_id"], hot=hot, spread_by=spread_by)


def enrich_readings(
    readings: DataFrame, meters: DataFrame, facilities: DataFrame, events: DataFrame, *, keep_raw: bool = False
) -> DataFrame:
    """Readings with duplicate count, event context, meter and facility.

    The two shuffles run on the narrow readings, before the master columns widen
    the rows.
    """
    spread_by = ["meter_id", "reading_timestamp", "raw_reading_id", "batch_id"]
    hot_grain, hot_ids = find_hot_keys(readings, ["meter_id", "reading_timestamp"], ["raw_reading_id"])
    counted = add_duplicate_count(readings, hot=hot_grain, spread_by=spread_by)
    with_events = join_event_context(counted, events, keep_raw=keep_raw, hot=hot_ids, spread_by=spread_by)
    return join_master(with_events, meters, facilities)


def scenario_intervals(scenarios: DataFrame, separator: str = ";") -> DataFrame:
    """One row per scenario and affected meter."""
    ids = F.filter(
        F.transform(F.split("affected_meter_ids", separator), lambda m: F.trim(m)),
        lambda m: F.length(m) > 0,
    )
    return scenarios.select(
        "scenario_id", "start_datetime", "end_datetime", F.explode(ids).alias("meter_id")
    )


# Buckets that an average interval is spread over, and the narrowest bucket.
BUCKETS_PER_INTERVAL, LEAST_BUCKET_SECONDS = 32, 3600


def _seconds(column: str) -> Column:
    """Seconds of a zone-free time, by its own calendar whatever the session's zone."""
    return F.expr(f"timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', cast({quoted(column)} AS timestamp_ntz))")


def bucket_seconds(spans: DataFrame, start: str, end: str) -> int:
    """The width of time buckets that spreads n intervals over at most
    (BUCKETS_PER_INTERVAL + 2) * n of them, however long some are."""
    length = (_seconds(end) - _seconds(start)).cast("double")
    n, total = spans.where(F.col(end) >= F.col(start)).agg(F.count("*"), F.sum(length)).first()
    return max(LEAST_BUCKET_SECONDS, int((total or 0) / (BUCKETS_PER_INTERVAL * max(n, 1))) + 1)


def join_intervals(
    points: DataFrame, spans: DataFrame, key: str, at: str, start: str, end: str, width: int | None = None
) -> DataFrame:
    """Points with the intervals of their key that hold them, both ends included; an
    interval without a start, end or key, or that ends before it starts, holds none.

    Each interval stands once in every time bucket it touches, each point in its own, and
    they are joined on key and bucket: a point meets the intervals around it, not all of
    its key. The exact bounds are tested after. Keys that hold many points are spread by
    their buckets, and Spark splits what is still skewed.
    """
    spans = spans.where(F.col(end) >= F.col(start))
    width = bucket_seconds(spans, start, end) if width is None else width
    bucket = lambda c: F.floor(_seconds(c) / F.lit(width)).cast("bigint")
    spread = spans.withColumn("_bucket", F.explode(F.sequence(bucket(start), bucket(end))))
    inside = F.col(at).between(F.col(start), F.col(end))
    return points.withColumn("_bucket", bucket(at)).join(spread, [key, "_bucket"]).where(inside).drop("_bucket", start, end)


def tag_scenarios(readings: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Readings inside a known scenario: meter on its list, time within its bounds
    (both inclusive)."""
    return join_intervals(readings, scenario_intervals(scenarios), "meter_id", "reading_timestamp", "start_datetime", "end_datetime")


def densify_calendar(
    entities: DataFrame,
    facts: DataFrame,
    keys: list[str],
    start: str,
    end: str,
    measures: list[str],
    date_column: str = "production_date",
) -> DataFrame:
    """One row per entity and day, measures 0 where no fact exists.

    The calendar is generated inside each entity row, so no cross join is needed.
    """
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))
    spine = entities.select(*keys).distinct().withColumn(date_column, F.explode(days))
    filled = {m: F.coalesce(F.col(m), F.lit(0).cast(facts.schema[m].dataType)) for m in measures}
    return spine.join(facts.select(*keys, date_column, *measures), [*keys, date_column], "left").withColumns(filled)
