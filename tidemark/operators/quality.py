"""Data quality: the reference's per-record validator re-aimed
as DataFrame jobs. Errors and warnings are ``array<string>`` columns built
from ``when`` chains; metrics are one aggregation with ``count_if``; metric
rows are produced with ``stack``. Nothing is collected to the driver except
schema metadata.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import KNOWN_SYMBOLS, MAX_PRICE_CHANGE_PCT, TRACKED_SYMBOLS

# The reference's per-symbol bounds and thresholds.
PRICE_BOUNDS = [
    ("BTCUSDT", 10000.0, 500000.0, 0.0, 100_000_000_000.0),
    ("ETHUSDT", 500.0, 50000.0, 0.0, 50_000_000_000.0),
    ("BNBUSDT", 100.0, 5000.0, 0.0, 10_000_000_000.0),
]
STALE_SECONDS = 300
EXTREME_CHANGE = MAX_PRICE_CHANGE_PCT
VWAP_ROUNDING = 1e-9
# Bounds tables of at most so many (counted) rows are broadcast.
BROADCAST_ROWS = 100_000
REQUIRED = ["symbol", "price", "volume", "timestamp"]
BOUNDS_SCHEMA = "symbol string, min_price double, max_price double, min_volume double, max_volume double"


def reference_bounds(spark) -> DataFrame:
    return spark.createDataFrame(PRICE_BOUNDS, BOUNDS_SCHEMA)


def _msgs(*pairs) -> Column:
    """array of the messages whose condition holds (nulls filtered out)."""
    return F.filter(F.array(*[F.when(c, m) for c, m in pairs]), lambda x: x.isNotNull())


def _txt(c) -> Column:
    return F.col(c).cast("string")


def bounds_lookup(records: DataFrame, bounds: DataFrame) -> DataFrame:
    """Left join to the per-symbol bounds; symbols without bounds pass. The
    bounds (one narrow row per symbol) are counted, up to the limit: a small
    table is broadcast, a larger one shuffle-joins."""
    small = bounds.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return records.join(F.broadcast(bounds) if small else bounds, on="symbol", how="left")


def validate_prices(records: DataFrame, bounds: DataFrame, as_of, stale_seconds: int = STALE_SECONDS, known=KNOWN_SYMBOLS) -> DataFrame:
    """Per record: ``valid``, ``errors``, ``warnings``, upper-cased symbol and
    ``unknown_symbol``. A schema error (missing required field, price <= 0,
    volume < 0) makes the record invalid and suppresses all warnings."""
    sym_up = F.upper(F.col("symbol"))
    r = records.withColumn("symbol", sym_up)
    r = bounds_lookup(r, bounds)
    errors = _msgs(*[(F.col(c).isNull(), f"Schema validation failed: {c} missing") for c in REQUIRED],
                   (F.col("price") <= 0, "Schema validation failed: Price must be positive"),
                   (F.col("volume") < 0, "Schema validation failed: Volume cannot be negative"))
    as_of_ms = F.unix_millis(F.lit(as_of).cast("timestamp"))
    age_s = (as_of_ms - F.col("timestamp")) / 1000.0
    warnings = _msgs(
        ((F.col("price") < F.col("min_price")) | (F.col("price") > F.col("max_price")),
         F.concat(F.lit("Price "), _txt("price"), F.lit(" outside expected range ["),
                  _txt("min_price"), F.lit(", "), _txt("max_price"), F.lit("]"))),
        ((F.col("volume") < F.col("min_volume")) | (F.col("volume") > F.col("max_volume")),
         F.concat(F.lit("Volume "), _txt("volume"), F.lit(" outside expected range ["),
                  _txt("min_volume"), F.lit(", "), _txt("max_volume"), F.lit("]"))),
        ((F.col("timestamp") > 0) & (age_s > stale_seconds),
         F.concat(F.lit("Stale data: "), F.bround(age_s, 0).cast("long").cast("string"), F.lit("s old"))),
        (F.abs(F.col("price_change_percent")) > EXTREME_CHANGE,
         F.concat(F.lit("Extreme price change: "), _txt("price_change_percent"), F.lit("%"))),
    )
    valid = F.size(errors) == 0
    return (r.withColumn("errors", errors)
             .withColumn("valid", valid)
             .withColumn("warnings", F.when(valid, warnings).otherwise(F.array().cast("array<string>")))
             .withColumn("unknown_symbol", sym_up.isNotNull() & ~sym_up.isin(list(known)))
             .drop("min_price", "max_price", "min_volume", "max_volume"))


def route_validated(results: DataFrame) -> DataFrame:
    """One pass: each record with its route, ``valid`` or ``invalid``."""
    return results.withColumn("route", F.when(F.col("valid"), "valid").otherwise("invalid"))


def split_valid_invalid(results: DataFrame):
    """The same as two tables."""
    return results.filter(F.col("valid")), results.filter(~F.col("valid"))


def validate_ohlc(candles: DataFrame) -> DataFrame:
    """Invalid: high < low, negative volume. Warn: open > high, close < low,
    VWAP outside [low, high] (the reference checks only these sides). A VWAP
    is a quotient of sums: it is outside only beyond their rounding."""
    h, l, o, c, v = (F.col(x) for x in ("high", "low", "open", "close", "vwap"))
    errors = _msgs((h < l, F.concat(F.lit("High ("), _txt("high"), F.lit(") < Low ("), _txt("low"), F.lit(")"))),
                   (F.coalesce(F.col("volume"), F.lit(0.0)) < 0, F.lit("Negative volume")))
    warnings = _msgs(
        (o > h, F.concat(F.lit("Open ("), _txt("open"), F.lit(") > High ("), _txt("high"), F.lit(")"))),
        (c < l, F.concat(F.lit("Close ("), _txt("close"), F.lit(") < Low ("), _txt("low"), F.lit(")"))),
        ((v < l - VWAP_ROUNDING * F.abs(l)) | (v > h + VWAP_ROUNDING * F.abs(h)),
         F.concat(F.lit("VWAP ("), F.format_string("%.6f", v), F.lit(") outside OHLC range ["),
                                     _txt("low"), F.lit(", "), _txt("high"), F.lit("]"))))
    return (candles.withColumn("errors", errors)
                   .withColumn("valid", F.size("errors") == 0)
                   .withColumn("warnings", warnings))


def quality_metrics(results: DataFrame, by: list[str] | None = None, as_of=None) -> DataFrame:
    """total / valid / invalid / with-warnings counts and rates (percent);
    ``by`` gives one row per batch or time bucket (the period reset)."""
    aggs = [F.count(F.lit(1)).alias("total_records"),
            F.count_if(F.col("valid")).alias("valid_records"),
            F.count_if(~F.col("valid")).alias("invalid_records"),
            F.count_if(F.size("warnings") > 0).alias("records_with_warnings")]
    g = results.groupBy(*(by or [])).agg(*aggs)
    g = (g.withColumn("validity_rate", F.col("valid_records") * 100.0 / F.col("total_records"))
          .withColumn("warning_rate", F.col("records_with_warnings") * 100.0 / F.col("total_records")))
    if as_of is not None:
        g = g.withColumn("last_checked", F.lit(as_of).cast("timestamp_ntz"))
    return g


def expectation_suite(df: DataFrame) -> DataFrame:
    """The bronze suite: symbol / price exist, are not null, price is a float.
    Column existence and type come from the schema (driver metadata); the
    null checks are one aggregation."""
    cols = set(df.columns)
    types = dict(df.dtypes)
    counts = df.agg(F.count(F.lit(1)).alias("n"),
                    *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("symbol", "price")
                      if c in cols])
    rows = []
    for c in ("symbol", "price"):
        rows.append(F.struct(F.lit("expect_column_to_exist").alias("expectation"), F.lit(c).alias("column"),
                             F.lit(c in cols).alias("success"), F.lit(0).cast("long").alias("unexpected_count")))
    for c in ("symbol", "price"):
        u = F.col(f"null_{c}") if c in cols else F.col("n")
        rows.append(F.struct(F.lit("expect_column_values_to_not_be_null").alias("expectation"),
                             F.lit(c).alias("column"), (u == 0).alias("success"),
                             u.cast("long").alias("unexpected_count")))
    is_float = types.get("price") in ("double", "float")
    rows.append(F.struct(F.lit("expect_column_values_to_be_of_type").alias("expectation"),
                         F.lit("price").alias("column"), F.lit(is_float).alias("success"),
                         F.lit(0).cast("long").alias("unexpected_count")))
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _status(value: Column, threshold: Column, higher_is_better: bool) -> Column:
    """PASS within the threshold, WARN within twice its distance, else FAIL."""
    if higher_is_better:
        return (F.when(value >= threshold, "PASS")
                 .when(value >= threshold - (100 - threshold), "WARN").otherwise("FAIL"))
    return F.when(value <= threshold, "PASS").when(value <= threshold * 2, "WARN").otherwise("FAIL")


def _as_time(table: DataFrame, time_col: str, name: str) -> Column:
    """Column ``name``, a time or epoch milliseconds as ``time_col`` of ``table`` is, as a time."""
    ms = table.schema[time_col].dataType.typeName() == "long"
    return (F.timestamp_millis(name).cast("timestamp_ntz") if ms else F.col(name)).alias(name)


def check_freshness(table: DataFrame, as_of, time_col: str = "event_time",
                    max_age_seconds: int = STALE_SECONDS) -> DataFrame:
    """Age of the newest row against ``as_of`` (a global max: partial
    aggregation, one row out). ``time_col`` is a time or epoch milliseconds; the
    latter of a ``footer_table`` is answered from the files' footers."""
    now = F.lit(as_of).cast("timestamp_ntz")
    g = table.agg(F.max(time_col).alias("latest")).select(_as_time(table, time_col, "latest"))
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("latest").cast("timestamp"))) / 1e6
    return g.select("latest", age.alias("age_seconds"), (age <= max_age_seconds).alias("fresh"))


def check_completeness(table: DataFrame, spark, as_of, symbols=TRACKED_SYMBOLS,
                       lookback_minutes: int = 60, time_col: str = "event_time") -> DataFrame:
    """Every tracked symbol has data in the last ``lookback_minutes``: the
    expected-symbol list left-joined to the per-symbol latest time (one row
    per symbol after a partial aggregation; ``time_col`` as in ``check_freshness``)."""
    now = F.lit(as_of).cast("timestamp_ntz")
    latest = table.groupBy("symbol").agg(F.max(time_col).alias("last_seen")).select("symbol", _as_time(table, time_col, "last_seen"))
    exp = table.sparkSession.createDataFrame([(s,) for s in symbols], "symbol string")
    j = exp.join(F.broadcast(latest.filter(F.col("symbol").isin(list(symbols)))), "symbol", "left")
    recent = F.coalesce(F.col("last_seen") > now - F.make_dt_interval(mins=F.lit(lookback_minutes)),
                        F.lit(False))
    return j.select("symbol", "last_seen", recent.alias("has_recent_data"))


def quality_metric_rows(results: DataFrame, table_name: str, as_of) -> DataFrame:
    """Metric rows (check_time, table_name, metric_name, metric_value,
    threshold, status) from validation results — the writer the serving API
    expects. One aggregation, then ``stack`` into rows."""
    m = quality_metrics(results)
    stacked = m.select(F.expr(
        "stack(3, 'validity_rate', validity_rate, CAST(95 AS DOUBLE), true, "
        "'warning_rate', warning_rate, CAST(10 AS DOUBLE), false, "
        "'invalid_records', CAST(invalid_records AS DOUBLE), CAST(0 AS DOUBLE), false) "
        "AS (metric_name, metric_value, threshold, higher_is_better)"))
    status = F.when(F.col("higher_is_better"), _status(F.col("metric_value"), F.col("threshold"), True)) \
        .otherwise(F.when(F.col("metric_value") <= F.col("threshold"), "PASS")
                   .when(F.col("metric_value") <= F.greatest(F.col("threshold") * 2, F.lit(1.0)), "WARN")
                   .otherwise("FAIL"))
    return stacked.select(F.lit(as_of).cast("timestamp_ntz").alias("check_time"),
                          F.lit(table_name).alias("table_name"), "metric_name", "metric_value",
                          "threshold", status.alias("status"))


def validate_record(records: DataFrame, bounds: DataFrame, as_of, **kw) -> DataFrame:
    """The single-record entry point of the reference is the same call."""
    return validate_prices(records, bounds, as_of, **kw)
