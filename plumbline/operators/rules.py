"""Row-level data-quality rules, classification and the exception table.

Rules are data: an id, a type, a severity, a reason and a predicate that is true
when the row FAILS. All flags of a table are computed in one projection and the
exception table comes from one pass over it, however many rules there are.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.clean import is_true, quoted, safe_divide, sql_text
from plumbline.functions.keys import exception_id
from plumbline.operators.skew import HotKeys, count_per_key, left_join_unique

# Fixed values of the quality model.
ACCEPTED_QUALITY_CODES = ("GOOD", "ESTIMATED", "QUESTIONABLE", "STALE", "MISSING")
DEVICE_FAULTS = ("NO_SIGNAL", "OFFLINE", "FAILED")
COMMUNICATION_FAULTS = ("FAILED", "DEGRADED")
SUCCESS_STATUSES = ("SUCCESS", "RETRY_SUCCESS")


@dataclass(frozen=True)
class RuleContext:
    """Everything a predicate may depend on besides the row."""

    as_of: str = field(default_factory=lambda: date.today().isoformat())
    late_hours: int = 24
    accepted_codes: Sequence[str] = ACCEPTED_QUALITY_CODES
    correction_threshold: float = 0.05
    nomination_threshold: float = 0.10
    max_rejected_rows: int = 0
    columns: Mapping[str, str] = field(default_factory=dict)

    def col(self, name: str) -> Column:
        """The column that plays the role ``name`` in the table at hand."""
        return F.col(self.columns.get(name, name))


@dataclass(frozen=True)
class Rule:
    rule_id: str
    exception_type: str
    severity: str
    flag: str
    reason: str
    fails: Callable[[RuleContext], Column]

    def flag_column(self, ctx: RuleContext) -> Column:
        """The predicate as a flag that is never NULL."""
        return is_true(self.fails(ctx)).alias(self.flag)


def _late(c: RuleContext) -> Column:
    limit = c.col("reading_timestamp") + F.make_dt_interval(hours=F.lit(c.late_hours))
    return c.col("load_timestamp") > limit


def _stale(c: RuleContext) -> Column:
    roles = ("quality_code", "raw_status", "event_quality_code", "event_raw_status")
    return reduce(or_, [is_true(c.col(r) == "STALE") for r in roles])


# The eleven rules on enriched readings (ids, types, severities and reasons are
# fixed values).
READING_RULES: tuple[Rule, ...] = (
    Rule("DQ_NULL_VOLUME", "NULL_VOLUME", "High", "dq_null_volume",
         "Missing volume can undercount or break downstream reporting.",
         lambda c: c.col("volume").isNull()),
    Rule("DQ_ZERO_VOLUME", "ZERO_VOLUME", "Medium/High", "dq_zero_volume",
         "Zero volume on an active meter may be real, but requires source/polling review.",
         lambda c: (c.col("volume") == 0) & c.col("master_meter_is_active")),
    Rule("DQ_VOLUME_NON_NEGATIVE", "NEGATIVE_VOLUME", "High", "dq_negative_volume",
         "Negative volume is invalid for this measurement dataset.",
         lambda c: c.col("volume") < 0),
    Rule("DQ_PRODUCTION_DATE_NOT_FUTURE", "FUTURE_DATE", "Medium", "dq_future_date",
         "Future production dates indicate source/date mapping issues.",
         lambda c: c.col("production_date") > F.lit(c.as_of).cast("date")),
    Rule("DQ_METER_MUST_EXIST_IN_MASTER", "INVALID_METER", "High", "dq_invalid_meter",
         "Unmapped meters can disappear from reports or break joins.",
         lambda c: c.col("master_meter_id").isNull()),
    Rule("DQ_ACTIVE_METER_ONLY", "INACTIVE_METER_REPORTING", "Medium/High", "dq_inactive_meter_reporting",
         "Inactive meters reporting data require effective-date or business-rule review.",
         lambda c: c.col("master_meter_id").isNotNull() & ~c.col("master_meter_is_active")),
    Rule("DQ_FACILITY_MUST_MATCH_MASTER", "FACILITY_MISMATCH", "High", "dq_facility_mismatch",
         "Facility mismatch can move volumes to the wrong asset.",
         lambda c: c.col("source_facility_id") != c.col("master_facility_id")),
    Rule("DQ_QUALITY_CODE_VALID", "INVALID_QUALITY_CODE", "Medium", "dq_invalid_quality_code",
         "Unexpected quality/status codes can break rule interpretation.",
         lambda c: ~is_true(c.col("quality_code").isin(*c.accepted_codes))),
    Rule("DQ_LATE_ARRIVAL", "LATE_ARRIVAL", "Medium", "dq_late_arrival",
         "Late-arriving data can cause reports to be wrong at refresh time.",
         _late),
    Rule("DQ_STALE_READING", "STALE_READING", "Medium/High", "dq_stale_reading",
         "Stale readings can look valid unless freshness and source context are checked.",
         _stale),
    Rule("DQ_DUPLICATE_METER_TIMESTAMP", "DUPLICATE_READING", "High", "dq_duplicate_meter_timestamp",
         "Duplicate meter/timestamp records can inflate totals.",
         lambda c: c.col("duplicate_meter_timestamp_count") > 1),
)

# Which failed rule names the row (fixed order, first match wins).
PRIMARY_TYPE_ORDER = (
    "INVALID_METER", "DUPLICATE_READING", "NULL_VOLUME", "NEGATIVE_VOLUME", "ZERO_VOLUME",
    "FUTURE_DATE", "FACILITY_MISMATCH", "INVALID_QUALITY_CODE", "LATE_ARRIVAL",
    "STALE_READING", "INACTIVE_METER_REPORTING",
)


def _variance_above(actual: str, base: str, threshold: str) -> Callable[[RuleContext], Column]:
    """Fails when |actual - base| / base exceeds the threshold; a zero base with a
    non-zero actual has no finite variance and fails too."""

    def fails(c: RuleContext) -> Column:
        ratio = safe_divide(F.abs(c.col(actual) - c.col(base)), c.col(base))
        beyond = F.abs(ratio) > F.lit(getattr(c, threshold))
        return is_true(beyond) | is_true((c.col(base) == 0) & (c.col(actual) != 0))

    return fails


# Rules that the rule catalogue declares for other tables (ids, severities and
# conditions are fixed values; types are our own names).
FLOW_RULES: tuple[Rule, ...] = (
    Rule("DQ_FLOWCAL_APPROVED_FOR_REPORTING", "UNAPPROVED_RECORD", "High", "dq_unapproved_record",
         "Unapproved measurements should not feed final reports.",
         lambda c: ~(is_true(c.col("is_approved")) & is_true(c.col("close_status") == "CLOSED"))),
    Rule("DQ_FLOWCAL_CORRECTION_VARIANCE", "CORRECTION_VARIANCE", "Medium/High", "dq_correction_variance",
         "Large corrections require measurement review.",
         _variance_above("corrected_volume", "measured_volume", "correction_threshold")),
)
NOMINATION_RULES: tuple[Rule, ...] = (
    Rule("DQ_NOMINATION_VARIANCE", "NOMINATION_VARIANCE", "Medium", "dq_nomination_variance",
         "Business users need to understand plan-vs-actual differences.",
         _variance_above("actual_volume", "nominated_volume", "nomination_threshold")),
)
RUN_RULES: tuple[Rule, ...] = (
    Rule("DQ_PIPELINE_RUN_SUCCESS", "RUN_NOT_SUCCESSFUL", "High", "dq_run_not_successful",
         "Failed/partial loads affect downstream trust.",
         lambda c: ~is_true(c.col("status").isin(*SUCCESS_STATUSES))),
    Rule("DQ_ROWS_REJECTED_THRESHOLD", "REJECTED_ROWS", "Medium/High", "dq_rejected_rows",
         "Rejected rows need triage.",
         lambda c: c.col("rows_rejected") > c.max_rejected_rows),
)
LINEAGE_RULES: tuple[Rule, ...] = (
    Rule("DQ_SOURCE_SYSTEM_PRESENT", "MISSING_SOURCE_SYSTEM", "Medium", "dq_missing_source_system",
         "Lineage depends on source metadata.",
         lambda c: c.col("source_system").isNull()),
    Rule("DQ_BATCH_ID_PRESENT", "MISSING_BATCH_ID", "Medium", "dq_missing_batch_id",
         "Batch metadata supports reconciliation and reruns.",
         lambda c: c.col("batch_id").isNull()),
    Rule("DQ_POLL_TIMESTAMP_PRESENT", "MISSING_POLL_TIMESTAMP", "Medium", "dq_missing_poll_timestamp",
         "Polling timestamp supports freshness checks.",
         lambda c: c.col("poll_timestamp").isNull()),
)
PAYLOAD_RULES: tuple[Rule, ...] = (
    Rule("DQ_RAW_PAYLOAD_PRESERVED", "MISSING_RAW_PAYLOAD", "Medium", "dq_missing_raw_payload",
         "Raw context helps explain exceptions.",
         lambda c: F.try_parse_json(c.col("raw_document_json")).isNull()),
)

# What an exception row keeps of the reading it belongs to.
EXCEPTION_DETAIL_COLUMNS = (
    "raw_reading_id", "meter_id", "source_facility_id", "master_facility_id",
    "master_facility_name", "master_region", "master_basin", "reading_timestamp",
    "production_date", "poll_timestamp", "load_timestamp", "source_system",
    "polling_platform", "batch_id", "volume", "quality_code", "raw_status", "event_id",
    "event_device_status", "event_communication_status", "event_battery_status",
    "event_signal_quality", "event_scenario_id", "primary_exception_type",
)


def add_flags(df: DataFrame, rules: Sequence[Rule], ctx: RuleContext) -> DataFrame:
    """One boolean column per rule, true when the row fails it."""
    return df.select("*", *[rule.flag_column(ctx) for rule in rules])


def exception_count(rules: Sequence[Rule]) -> Column:
    return F.expr(" + ".join(f"cast(coalesce({quoted(r.flag)}, false) AS int)" for r in rules))


def has_exception(rules: Sequence[Rule]) -> Column:
    return F.expr(" OR ".join(f"coalesce({quoted(r.flag)}, false)" for r in rules))


def primary_type(rules: Sequence[Rule], order: Sequence[str] = PRIMARY_TYPE_ORDER) -> Column:
    flags = {r.exception_type: quoted(r.flag) for r in rules}
    return F.expr("CASE " + " ".join(f"WHEN {flags[t]} THEN {sql_text(t)}" for t in order if t in flags) + " END")


def needs_review(ctx: RuleContext) -> Column:
    """A row without exceptions that is still not plainly good."""
    return (
        is_true(ctx.col("quality_code") != "GOOD")
        | is_true(ctx.col("raw_status") != "VALID")
        | is_true(ctx.col("event_device_status").isin(*DEVICE_FAULTS))
        | is_true(ctx.col("event_communication_status").isin(*COMMUNICATION_FAULTS))
    )


def classify(
    flagged: DataFrame, ctx: RuleContext, rules: Sequence[Rule] = READING_RULES, order: Sequence[str] = PRIMARY_TYPE_ORDER
) -> DataFrame:
    """Exception count, primary type and record status from the flags."""
    any_failed = has_exception(rules)
    status = F.when(any_failed, "EXCEPTION").when(needs_review(ctx), "REVIEW").otherwise("VALID")
    return flagged.select(
        "*",
        exception_count(rules).alias("dq_exception_count"),
        any_failed.alias("dq_has_exception"),
        primary_type(rules, order).alias("primary_exception_type"),
        status.alias("record_quality_status"),
    )


def check_readings(
    enriched: DataFrame, ctx: RuleContext, rules: Sequence[Rule] = READING_RULES, order: Sequence[str] = PRIMARY_TYPE_ORDER
) -> DataFrame:
    """The enriched readings with all flags and their classification; ``rules`` and
    ``order`` may come from the rule catalogue (see ``rule_table``)."""
    return classify(add_flags(enriched, rules, ctx), ctx, rules, order)


def split_valid(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("record_quality_status").isin("VALID", "REVIEW"))


def split_exceptions(checked: DataFrame) -> DataFrame:
    return checked.where("dq_has_exception")


def failures_only(df: DataFrame, rules: Sequence[Rule], ctx: RuleContext) -> DataFrame:
    """Rows that fail at least one of ``rules``, flags attached."""
    return add_flags(df, rules, ctx).where(has_exception(rules))


def add_duplicate_count(
    readings: DataFrame,
    keys: Sequence[str] = ("meter_id", "reading_timestamp"),
    name: str = "duplicate_meter_timestamp_count",
    spread_by: Sequence[str] | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """How many rows share the key; 1 when any part of the key is NULL.

    Counts are pre-aggregated, only keys that repeat are joined back, and keys
    holding a large share of all rows are matched by broadcast (see
    ``left_join_unique``), so no task ever receives all copies of a key.
    """
    repeated = count_per_key(readings, keys, name).where(F.col(name) > 1)
    joined = left_join_unique(readings, repeated, keys, spread_by=spread_by, hot=hot)
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(1)).cast("bigint"))


def explode_exceptions(
    checked: DataFrame,
    rules: Sequence[Rule] = READING_RULES,
    *,
    reading_id: str = "raw_reading_id",
    entity_id: str = "meter_id",
    timestamp: str = "reading_timestamp",
    keep: Sequence[str] | None = None,
    detected_at: str | None = None,
) -> DataFrame:
    """One row per failed rule per reading, with the rule's metadata and a stable id.

    Each failing row explodes the array of its rules and keeps those it failed, so
    the table is read once rather than once per rule.
    """
    failed = ", ".join(
        f"CASE WHEN {quoted(r.flag)} THEN named_struct('rule_id', {sql_text(r.rule_id)}, "
        f"'exception_type', {sql_text(r.exception_type)}, 'severity', {sql_text(r.severity)}, "
        f"'business_reason', {sql_text(r.reason)}) END"
        for r in rules
    )
    carried = [c for c in (keep or EXCEPTION_DETAIL_COLUMNS) if c in checked.columns]
    seen = F.current_timestamp() if detected_at is None else F.lit(detected_at).cast("timestamp_ntz")
    return (
        checked.where(has_exception(rules))
        .select(F.expr(f"explode(array({failed}))").alias("rule"), *carried)
        .where(F.col("rule").isNotNull())
        .select(
            exception_id(F.col("rule.rule_id"), reading_id, entity_id, timestamp).alias("exception_id"),
            "rule.*",
            *carried,
            seen.alias("detected_at"),
        )
    )


def join_rule_catalogue(exceptions: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Name, layer and owner of the rule, for rules that are active in the catalogue."""
    active = catalogue.where("is_active").select("rule_id", "rule_name", "layer", "owner_team")
    return exceptions.join(active, "rule_id")
