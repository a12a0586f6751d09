"""Time conversions as Column expressions (all JVM side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_to_ts(ms) -> Column:
    """Epoch milliseconds -> TIMESTAMP (exact; no double division)."""
    return F.timestamp_millis(col_(ms))


def epoch_s_to_ts(s) -> Column:
    return F.timestamp_seconds(col_(s))


def ts_to_epoch_ms(ts) -> Column:
    """Timestamp (with or without zone; session zone is UTC) -> epoch ms."""
    return F.unix_millis(col_(ts).cast("timestamp"))


def epoch_ms_to_iso(ms) -> Column:
    """ISO-8601 text like Python's ``datetime.isoformat()``: the fraction is
    written with 6 digits and left out when it is zero."""
    ts = F.timestamp_millis(col_(ms))
    return F.when(col_(ms) % 1000 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")) \
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def ts_to_iso(ts) -> Column:
    t = col_(ts)
    return F.when(F.date_format(t, "SSSSSS") == "000000", F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")) \
        .otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def trunc_ntz(unit: str, ts) -> Column:
    """``date_trunc`` that keeps a TIMESTAMP_NTZ input NTZ."""
    return F.date_trunc(unit, col_(ts)).cast("timestamp_ntz")


def epoch_seconds(ts) -> Column:
    """Whole seconds since the epoch, computed from wall-clock fields, so a
    TIMESTAMP_NTZ gives the same number under any session zone."""
    t = col_(ts)
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def chunk_index(ts, width_seconds: int) -> Column:
    """Index of the fixed-width time chunk (epoch aligned) holding ``ts``."""
    return F.floor(epoch_seconds(ts) / F.lit(int(width_seconds))).cast("long")
