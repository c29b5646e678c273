"""Column expressions (JVM-side, codegen friendly). No Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetscope.schemas import CRITICAL_RULE, DEGRADED_RULE, VALUE_RANGES


def col_of(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def int_div(a, b) -> Column:
    """Exact integer division of non-negative integers (SQL ``div``)."""
    a, b = col_of(a), col_of(b)
    return F.floor(a.cast("decimal(38,0)") / b.cast("decimal(38,0)")).cast("long")


def div_half_up(num, den) -> Column:
    """Integer ``num / den`` (den > 0) rounded half away from zero, exactly.

    Used instead of ``round(double, k)`` wherever two engines must agree
    bit for bit: the binary double of a tie is not a tie.
    """
    num, den = col_of(num), col_of(den)
    q = int_div(F.abs(num) * 2 + den, den * 2)
    return F.when(num < 0, -q).otherwise(q)


def to_cents(x) -> Column:
    """2-decimal value -> exact BIGINT number of hundredths."""
    return F.round(col_of(x).cast("double") * 100).cast("long")


# -- operator 11 -----------------------------------------------------------
def clamp_metrics(df, cols: dict | None = None):
    """Clamp readings into their valid ranges and round to 2 places.

    cpu and memory to 0..100, signal to -120..-40, throughput to >= 0;
    battery is only rounded. Rounding is half away from zero, once. A
    reading that is missing or NaN has no place in a range and stays so.
    """
    cols = cols or {
        "cpu_usage_pct": VALUE_RANGES["cpu_usage_pct"],
        "memory_usage_pct": VALUE_RANGES["memory_usage_pct"],
        "signal_strength_dbm": VALUE_RANGES["signal_strength_dbm"],
        "throughput_mbps": VALUE_RANGES["throughput_mbps"],
        "battery_pct": (None, None),
    }
    out = df
    for name, (lo, hi) in cols.items():
        c = F.col(name).cast("double")
        if lo is not None:
            c = F.greatest(c, F.lit(float(lo)))
        if hi is not None:
            c = F.least(c, F.lit(float(hi)))
        own = F.col(name).cast("double")
        out = out.withColumn(name, F.when(own.isNull() | F.isnan(own), own).otherwise(F.round(c, 2)))
    return out


# -- operator 12 -----------------------------------------------------------
def event_type_expr(cpu="cpu_usage_pct", signal="signal_strength_dbm",
                    throughput="throughput_mbps") -> Column:
    cpu, signal, throughput = col_of(cpu), col_of(signal), col_of(throughput)

    def hit(rule):
        return ((cpu > F.lit(rule["cpu_above"])) | (signal < F.lit(rule["signal_below"]))
                | (throughput < F.lit(rule["throughput_below"])))

    return (F.when(hit(CRITICAL_RULE), F.lit("critical"))
            .when(hit(DEGRADED_RULE), F.lit("degraded"))
            .otherwise(F.lit("normal")))


def classify_event_type(df, out_col: str = "event_type"):
    """critical > degraded > normal, all comparisons strict."""
    return df.withColumn(out_col, event_type_expr())


# -- operator 13 -----------------------------------------------------------
def parse_event_time(text) -> Column:
    """ISO-8601 text with a zone offset (or Z), with or without a fraction
    of a second, to an instant (TimestampType). Unparseable text -> NULL."""
    t = col_of(text)
    return F.coalesce(
        F.try_to_timestamp(t, F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]XXX")),
        F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S]XXX")),
    )


def iso_text(ts) -> Column:
    """Instant -> ISO-8601 text with microseconds and offset, as sent on the wire."""
    return F.date_format(col_of(ts).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


# -- operator 14 -----------------------------------------------------------
def render_time(ts) -> Column:
    """Timestamp -> text for results. Sort on the timestamp before this."""
    return col_of(ts).cast("string")
