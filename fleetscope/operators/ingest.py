"""Validation and shaping of decoded readings (operators 3, 4, 8, 9).

All checks are column expressions evaluated in one projection; the valid
and rejected sides are two filters over the same plan (cache or write
the checked frame once if both sides are consumed by separate jobs).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.functions.expressions import parse_event_time
from fleetscope.schemas import (DECIMAL_TYPES, EVENT_COLUMNS, EVENT_TYPES, MONITORED_METRICS, NUMERIC_FIELDS,
                                TEXT_FIELDS, TEXT_LENGTHS, VALUE_RANGES)
from fleetscope.sources.messages import CORRUPT

REQUIRED = TEXT_FIELDS + ["timestamp"] + NUMERIC_FIELDS + ["event_type"]


def _reason(cond: Column, text: str) -> Column:
    return F.when(cond, F.lit(text))


def _finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) != float("inf"))


def stored_value(field: str) -> Column:
    """A wire number as the table stores it: rounded to its decimal type,
    NULL if it is not finite or does not fit."""
    p, s = DECIMAL_TYPES[field]
    return F.col(field).try_cast(f"decimal({p},{s})")


def _checks(df: DataFrame, stored: dict[str, Column], at: Column) -> list[Column]:
    """For every rule its name where the decoded row breaks it, else NULL. ``stored``: the numbers as the table stores
    them; ``at``: the parsed timestamp."""
    malformed = F.col(CORRUPT).isNotNull() | F.coalesce(F.col("_not_object"), F.lit(False))
    checks = [_reason(malformed, "malformed")]
    ok = ~malformed
    for f in REQUIRED:
        checks.append(_reason(ok & F.col(f).isNull(), f"missing:{f}"))
    for f in NUMERIC_FIELDS:
        x = F.col(f)
        checks.append(_reason(ok & ~_finite(x), f"not_finite:{f}"))
        # the table checks the value it stores, after rounding; a value that
        # its type cannot hold is out of range too
        v = stored[f]
        lo, hi = VALUE_RANGES[f]
        bad = v.isNull()
        if lo is not None:
            bad = bad | (v < lo)
        if hi is not None:
            bad = bad | (v > hi)
        checks.append(_reason(ok & _finite(x) & bad, f"out_of_range:{f}"))
    checks.append(_reason(ok & F.col("event_type").isNotNull()
                          & ~F.col("event_type").isin(*EVENT_TYPES), "bad_value:event_type"))
    for f, n in TEXT_LENGTHS.items():
        checks.append(_reason(ok & (F.length(F.col(f)) > n), f"too_long:{f}"))
    checks.append(_reason(ok & F.col("timestamp").isNotNull() & at.isNull(), "bad_value:timestamp"))
    return checks


def _broken(checks: list[Column]) -> Column:
    # unlike F.filter this stays in generated code; reasons never repeat
    return F.array_except(F.array(*checks), F.array(F.lit(None).cast("string")))


def reject_reasons(df: DataFrame) -> Column:
    """array<string> of every rule the decoded row breaks (empty = valid)."""
    return _broken(_checks(df, {f: stored_value(f) for f in NUMERIC_FIELDS}, parse_event_time(F.col("timestamp"))))


#: Rules that are checked in one generated method (see ``quarantine_invalid``).
_RULES_AT_ONCE = 9


# -- operator 3 ------------------------------------------------------------
def quarantine_invalid(decoded: DataFrame) -> DataFrame:
    """Adds ``reject_reasons``; rows with an empty list are valid.

    All rules in one expression make a method of more than 8,000 bytes, which the JVM never compiles; the filters on
    the reasons would carry it along. So the rules are checked some at a time, each lot in a step that Spark keeps to
    itself: inline(array(x)), one row for one row, as in ``decode_telemetry``."""
    names = decoded.columns
    step = lambda df, new: df.select("*", F.inline(F.array(F.struct(*new))))
    rows = step(decoded, [*[stored_value(f).alias(f"_stored_{f}") for f in NUMERIC_FIELDS],
                          parse_event_time(F.col("timestamp")).alias("_at")])
    checks = _checks(decoded, {f: F.col(f"_stored_{f}") for f in NUMERIC_FIELDS}, F.col("_at"))
    lots = [checks[i:i + _RULES_AT_ONCE] for i in range(0, len(checks), _RULES_AT_ONCE)]
    for k, lot in enumerate(lots):
        rows = step(rows, [_broken(lot).alias(f"_reasons_{k}")])
    return rows.select(*names, F.concat(*[F.col(f"_reasons_{k}") for k in range(len(lots))]).alias("reject_reasons"))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) from ``quarantine_invalid`` output."""
    n = F.size("reject_reasons")
    return checked.where(n == 0).drop("reject_reasons"), checked.where(n > 0)


# -- operator 4 ------------------------------------------------------------
def conform_event(valid: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Wire fields -> stored-table columns and types: ``timestamp`` ->
    ``event_timestamp`` (instant), numbers -> NUMERIC(p, 2) rounded half
    away from zero, fixed column order."""
    keep = keep or []
    cols = []
    for c in EVENT_COLUMNS:
        if c == "event_timestamp":
            cols.append(parse_event_time(F.col("timestamp")).alias(c))
        elif c in DECIMAL_TYPES:
            cols.append(stored_value(c).alias(c))
        else:
            cols.append(F.col(c))
    return valid.select(*keep, *cols)


def detector_readings(decoded: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Decoded messages -> rows for the detector: it needs a device, a time
    and finite metrics only. A metric that is missing, not finite or too
    large to store is NULL, which the detector skips by itself; fields that
    only the table checks do not matter here."""
    keep = keep or []
    at = parse_event_time(F.col("timestamp"))
    readable = F.col(CORRUPT).isNull() & ~F.coalesce(F.col("_not_object"), F.lit(False))
    rows = decoded.where(readable & F.col("device_id").isNotNull() & at.isNotNull())
    return rows.select(*keep, "device_id", at.alias("event_timestamp"),
                       *[stored_value(m).alias(m) for m in MONITORED_METRICS])


# -- operator 8 ------------------------------------------------------------
def dedup_events(df: DataFrame, key_cols: list[str] | None = None,
                 watermark_col: str | None = None) -> DataFrame:
    """Insert-once: keep one row per message identity (default the source
    position, partition + offset). In a stream with ``watermark_col`` the
    state of a key is kept only until the watermark passes it."""
    key_cols = key_cols or ["partition", "offset"]
    if df.isStreaming and watermark_col:
        return df.dropDuplicatesWithinWatermark(key_cols)
    return df.dropDuplicates(key_cols)


# -- operator 9 ------------------------------------------------------------
def stamp_ingest_time(df: DataFrame, at: Column | None = None, col: str = "ingested_at") -> DataFrame:
    """Row creation time: ``at`` (e.g. a fixed as_of) or the query's start."""
    return df.withColumn(col, at if at is not None else F.current_timestamp())


def ingest_lag_ms(ingested: str, event: str) -> Column:
    """(ingested - event) in milliseconds, exact to the microsecond."""
    return F.timestamp_diff("MICROSECOND", F.col(event), F.col(ingested)) / 1000.0
