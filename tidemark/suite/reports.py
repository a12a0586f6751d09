"""Registered report, quality-check and maintenance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.candles import ohlc_candles
from ..operators.insights import market_sentiment, price_movements, sentiment_signals, volume_spikes
from ..operators.maintenance import compact_table, register_layer_views, scan_path
from ..operators.quality import (
    check_completeness, check_freshness, expectation_suite, quality_metric_rows, quality_metrics,
    route_validated, validate_ohlc, validate_prices,
)
from ..operators.reports import (
    cumcount, describe_tables, direction_distribution, insight_counts, last_n_per_symbol,
    latest_per_symbol, load_insights, signal_distribution, store_insights, throughput_stats, volatility_long,
)
from ..operators.warehouse import materialize_table, materialize_view, stg_crypto_prices
from ..registry import register
from ..session import scratch_path
from ..sources.fixtures import AS_OF, base_ticks, sentiment, validation_bounds, ticks
from .insights import TEST_MINUTES
from ..sources.footers import footer_table
from .layers import bronze, layer_footers, written_layer
from .serving import METRIC_ROWS_SQL
from .sqlviews import (
    BASE_TICKS, BRONZE, SENTIMENT, STG_PRICES, VALIDATED, candles_cte, moves_v2_sql, signals_v2_sql,
    spikes_sql,
)

MOVES = moves_v2_sql(TEST_MINUTES)
CORR = signals_v2_sql(TEST_MINUTES)


def _moves(spark, sf_dir):
    return price_movements(base_ticks(spark, sf_dir), minutes=TEST_MINUTES)


def _corr(spark, sf_dir):
    return sentiment_signals(sentiment(spark, sf_dir), base_ticks(spark, sf_dir), TEST_MINUTES)


def _insight_tables(spark, sf_dir):
    return {"price_movements": _moves(spark, sf_dir),
            "volume_spikes": volume_spikes(base_ticks(spark, sf_dir)),
            "market_sentiment": market_sentiment(sentiment(spark, sf_dir)),
            "sentiment_price_correlation": _corr(spark, sf_dir)}


def _stored_paths(spark, sf_dir):
    """The four insight tables as they are stored: computed once per session and input."""
    tables = _insight_tables(spark, sf_dir)
    return {name: written_layer(spark, sf_dir, f"insight-{name}", lambda *_, df=df: df, by=()) for name, df in tables.items()}


def _stored(spark, sf_dir):
    return {name: spark.read.parquet(p) for name, p in _stored_paths(spark, sf_dir).items()}


#: Per table: time, key and value column of the compared answer.
INSIGHT_COLUMNS = {
    "price_movements": ("window_end", "symbol", "price_change_pct"),
    "volume_spikes": ("spike_time", "symbol", "spike_multiplier"),
    "market_sentiment": ("recorded_time", "fear_greed_class", "fear_greed_index"),
    "sentiment_price_correlation": ("window_end", "correlation_signal", "btc_price_change"),
}
SENTIMENT_ROWS = f"""WITH {SENTIMENT}
SELECT event_time AS recorded_time, CAST(value AS INTEGER) AS fear_greed_index, classification AS fear_greed_class
FROM sentiment"""
INSIGHT_SQL = {"price_movements": MOVES, "volume_spikes": spikes_sql(), "market_sentiment": SENTIMENT_ROWS,
               "sentiment_price_correlation": CORR}


def insight_rows(tables):
    """Rows of all insight tables side by side: table, time, key, value, stamped."""
    out = None
    for name, (t, k, v) in INSIGHT_COLUMNS.items():
        df = tables[name]
        stamped = F.col("created_at").isNotNull() if "created_at" in df.columns else F.lit(False)
        one = df.select(F.lit(name).alias("table_name"), F.col(t).alias("at"), F.col(k).alias("key"),
                        F.col(v).cast("double").alias("value"), stamped.alias("stamped"))
        out = one if out is None else out.unionByName(one)
    return out


def insight_rows_sql(sql, stamped: bool) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {t} AS at, {k} AS key, CAST({v} AS DOUBLE) AS value, {stamped} AS stamped FROM ({sql[name]})"
        for name, (t, k, v) in INSIGHT_COLUMNS.items())


@register("load_insights", doubles=["value"], sql=insight_rows_sql(INSIGHT_SQL, True))
def q_load_insights(spark, sf_dir):
    """All four tables, stored with their audit stamp and loaded again, each in the order of its own time."""
    root = scratch_path(spark, "insights")
    store_insights(_insight_tables(spark, sf_dir), root)
    order = {name: t for name, (t, _, _) in INSIGHT_COLUMNS.items()}
    return insight_rows(load_insights(spark, root, order))


@register("insight_counts", sql=f"""
WITH {BASE_TICKS}, {SENTIMENT}
SELECT 'price_movements' AS table_name, (SELECT count(*) FROM ({MOVES})) AS records
UNION ALL SELECT 'volume_spikes', (SELECT count(*) FROM ({spikes_sql()}))
UNION ALL SELECT 'market_sentiment', (SELECT count(*) FROM sentiment)
UNION ALL SELECT 'sentiment_price_correlation', (SELECT count(*) FROM ({CORR}))""")
def q_insight_counts(spark, sf_dir):
    """From the stored tables' footers."""
    return insight_counts({name: footer_table(spark, p) for name, p in _stored_paths(spark, sf_dir).items()})


@register("latest_per_symbol", doubles=["avg_price", "price_change_pct"], sql=f"""
SELECT symbol, arg_max(avg_price, (window_end, kafka_offset)) AS avg_price,
       arg_max(price_change_pct, (window_end, kafka_offset)) AS price_change_pct, max(window_end) AS window_end
FROM ({MOVES}) GROUP BY symbol""")
def q_latest_per_symbol(spark, sf_dir):
    return latest_per_symbol(_moves(spark, sf_dir), "window_end",
                             ["avg_price", "price_change_pct", "window_end"], "kafka_offset")


@register("last_n_per_symbol", doubles=["price_change_pct"], sql=f"""
SELECT symbol, window_end, price_change_pct FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC, kafka_offset DESC) AS rn
  FROM ({MOVES})) WHERE rn <= 10""")
def q_last_n_per_symbol(spark, sf_dir):
    return last_n_per_symbol(_moves(spark, sf_dir), "window_end", 10, "kafka_offset").select(
        "symbol", "window_end", "price_change_pct")


@register("cumcount", sql=f"""
SELECT symbol, window_end, row_number() OVER (PARTITION BY symbol ORDER BY window_end, kafka_offset) - 1 AS n
FROM ({MOVES})""")
def q_cumcount(spark, sf_dir):
    m = _moves(spark, sf_dir).select("symbol", "window_end", "kafka_offset")
    return cumcount(m, "window_end", "kafka_offset").select("symbol", "window_end", "n")


@register("volatility_pivot", doubles=["volatility"], sql=f"""
WITH m AS ({MOVES}),
c AS (SELECT symbol, volatility,
             row_number() OVER (PARTITION BY symbol ORDER BY window_end, kafka_offset) - 1 AS n FROM m)
SELECT symbol, n, avg(volatility) AS volatility FROM c
WHERE (SELECT count(*) FROM m) > 20 GROUP BY symbol, n""")
def q_volatility_pivot(spark, sf_dir):
    return volatility_long(_moves(spark, sf_dir))


@register("signal_distribution", sql=f"""
SELECT correlation_signal, count(*) AS count FROM ({CORR}) GROUP BY 1""")
def q_signal_distribution(spark, sf_dir):
    return signal_distribution(_stored(spark, sf_dir)["sentiment_price_correlation"])


@register("direction_distribution", doubles=["percent"], sql=f"""
SELECT market_direction, count(*) AS count,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS percent
FROM ({CORR}) GROUP BY 1""")
def q_direction_distribution(spark, sf_dir):
    return direction_distribution(_stored(spark, sf_dir)["sentiment_price_correlation"])


@register("throughput_stats", doubles=["rate_per_second"], sql=f"""
WITH {BASE_TICKS}
SELECT time_bucket(INTERVAL '1 hour', event_time) AS window_start, count(*) AS messages,
       count(*) / 3600.0 AS rate_per_second
FROM base_ticks GROUP BY 1""")
def q_throughput_stats(spark, sf_dir):
    return throughput_stats(base_ticks(spark, sf_dir))


def _describe_sql() -> str:
    parts = []
    for name, (t, _, _) in INSIGHT_COLUMNS.items():
        parts.append(f"""
SELECT * FROM (SELECT '{name}' AS table_name, row_number() OVER (ORDER BY {t} DESC) AS nth, {t} AS at,
       (SELECT string_agg(column_name, ',') FROM (DESCRIBE {INSIGHT_SQL[name]})) AS columns,
       count(*) OVER () AS row_count
FROM ({INSIGHT_SQL[name]})) WHERE nth <= 5""")
    return " UNION ALL ".join(parts)


@register("describe_tables", sql=_describe_sql())
def q_describe_tables(spark, sf_dir):
    order = {name: t for name, (t, _, _) in INSIGHT_COLUMNS.items()}
    d = describe_tables(_stored(spark, sf_dir), order)
    return d.select("table_name", F.col("nth").cast("long").alias("nth"), "at", "columns", "row_count")


# --- quality ---------------------------------------------------------------

def _validated(spark, sf_dir):
    return validate_prices(bronze(spark, sf_dir, cut=True), validation_bounds(spark), AS_OF)


@register("quality_metrics", doubles=["validity_rate", "warning_rate"], sql=f"""
WITH {VALIDATED}
SELECT symbol, count(*) AS total_records, count_if(valid) AS valid_records,
       count_if(NOT valid) AS invalid_records, count_if(warnings_text <> '') AS records_with_warnings,
       count_if(valid) * 100.0 / count(*) AS validity_rate,
       count_if(warnings_text <> '') * 100.0 / count(*) AS warning_rate,
       TIMESTAMP '{AS_OF}' AS last_checked
FROM validated GROUP BY symbol""")
def q_quality_metrics(spark, sf_dir):
    return quality_metrics(_validated(spark, sf_dir), by=["symbol"], as_of=AS_OF)


@register("split_valid_invalid", sql=f"""
WITH {VALIDATED}
SELECT kafka_offset, symbol, CASE WHEN valid THEN 'valid' ELSE 'invalid' END AS route, errors_text FROM validated""")
def q_split_valid_invalid(spark, sf_dir):
    """Both sides in one pass over the validated records."""
    return route_validated(_validated(spark, sf_dir)).select(
        "kafka_offset", "symbol", "route", F.concat_ws("; ", "errors").alias("errors_text"))


WARN_PREFIX = {"warn_price_bounds": "Price ", "warn_volume_bounds": "Volume ",
               "warn_stale": "Stale data: ", "warn_extreme_change": "Extreme price change: "}


def _mk_warn(prefix):
    def fn(spark, sf_dir):
        v = _validated(spark, sf_dir)
        flag = F.exists("warnings", lambda x: x.startswith(prefix))
        return v.groupBy("symbol").agg(F.count_if(flag).alias("n"))
    return fn


for _name, _prefix in WARN_PREFIX.items():
    register(_name, sql=f"""
WITH {VALIDATED}
SELECT symbol, count_if(warnings_text LIKE '{_prefix}%' OR warnings_text LIKE '%; {_prefix}%') AS n
FROM validated GROUP BY symbol""")(_mk_warn(_prefix))


@register("warn_unknown_symbol", sql=f"""
WITH {VALIDATED} SELECT unknown_symbol, count(*) AS n FROM validated GROUP BY 1""")
def q_warn_unknown_symbol(spark, sf_dir):
    return _validated(spark, sf_dir).groupBy("unknown_symbol").agg(F.count(F.lit(1)).alias("n"))


@register("validate_ohlc", sql=f"""
WITH {BASE_TICKS}, {candles_cte('1 hour')}
SELECT symbol, window_start,
       concat_ws('; ',
         CASE WHEN high < low THEN 'High (' || CAST(high AS VARCHAR) || ') < Low (' || CAST(low AS VARCHAR) || ')' END,
         CASE WHEN coalesce(volume, 0.0) < 0 THEN 'Negative volume' END) AS errors_text,
       errors_text = '' AS valid,
       concat_ws('; ',
         CASE WHEN open > high THEN 'Open (' || CAST(open AS VARCHAR) || ') > High (' || CAST(high AS VARCHAR) || ')' END,
         CASE WHEN close < low THEN 'Close (' || CAST(close AS VARCHAR) || ') < Low (' || CAST(low AS VARCHAR) || ')' END,
         CASE WHEN vwap < low - 1e-9 * abs(low) OR vwap > high + 1e-9 * abs(high) THEN
           'VWAP (' || printf('%.6f', vwap) || ') outside OHLC range [' || CAST(low AS VARCHAR) || ', ' || CAST(high AS VARCHAR) || ']'
         END) AS warnings_text
FROM candles""")
def q_validate_ohlc(spark, sf_dir):
    v = validate_ohlc(ohlc_candles(base_ticks(spark, sf_dir), "1 hour"))
    return v.select("symbol", "window_start", F.concat_ws("; ", "errors").alias("errors_text"), "valid",
                    F.concat_ws("; ", "warnings").alias("warnings_text"))


EXPECT_SQL = f"""
WITH {BRONZE},
c AS (SELECT count_if(symbol IS NULL) AS ns, count_if(price IS NULL) AS np FROM bronze)
SELECT 'expect_column_to_exist' AS expectation, 'symbol' AS "column", TRUE AS success, 0::BIGINT AS unexpected_count
UNION ALL SELECT 'expect_column_to_exist', 'price', TRUE, 0::BIGINT
UNION ALL SELECT 'expect_column_values_to_not_be_null', 'symbol', ns = 0, ns FROM c
UNION ALL SELECT 'expect_column_values_to_not_be_null', 'price', np = 0, np FROM c
UNION ALL SELECT 'expect_column_values_to_be_of_type', 'price', TRUE, 0::BIGINT"""


@register("expectation_suite", sql=EXPECT_SQL)
def q_expectation_suite(spark, sf_dir):
    return expectation_suite(bronze(spark, sf_dir))


@register("check_validity", sql=f"""
SELECT count_if(NOT success) AS failed, count(*) AS checked, count_if(NOT success) = 0 AS passed
FROM ({EXPECT_SQL})""")
def q_check_validity(spark, sf_dir):
    e = expectation_suite(bronze(spark, sf_dir))
    return e.agg(F.count_if(~F.col("success")).alias("failed"), F.count(F.lit(1)).alias("checked"),
                 (F.count_if(~F.col("success")) == 0).alias("passed"))


@register("check_freshness", doubles=["age_seconds"], sql=f"""
WITH {BRONZE}
SELECT max(event_time) AS latest,
       (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(event_time))) / 1e6 AS age_seconds,
       (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(event_time))) / 1e6 <= 300 AS fresh
FROM bronze""")
def q_check_freshness(spark, sf_dir):
    return check_freshness(layer_footers(spark, sf_dir, "bronze"), AS_OF, "timestamp")


@register("check_completeness", sql=f"""
WITH {BRONZE},
l AS (SELECT symbol, max(event_time) AS last_seen FROM bronze GROUP BY symbol)
SELECT e.symbol, l.last_seen,
       coalesce(l.last_seen > TIMESTAMP '{AS_OF}' - INTERVAL 60 MINUTE, FALSE) AS has_recent_data
FROM (VALUES ('BTCUSDT'), ('ETHUSDT'), ('BNBUSDT')) AS e(symbol) LEFT JOIN l ON e.symbol = l.symbol""")
def q_check_completeness(spark, sf_dir):
    return check_completeness(layer_footers(spark, sf_dir, "bronze"), spark, AS_OF, time_col="timestamp")


@register("quality_report", doubles=["metric_value", "threshold"], sql=METRIC_ROWS_SQL)
def q_quality_report(spark, sf_dir):
    rows = quality_metric_rows(_validated(spark, sf_dir), "bronze_prices", AS_OF)
    path = scratch_path(spark, "data_quality_metrics")
    materialize_table(rows, path)
    return spark.read.parquet(path)


# --- tables, views, maintenance ---------------------------------------------

@register("materialize_table", sql=f"WITH {STG_PRICES} SELECT event_date, count(*) AS n FROM stg GROUP BY 1")
def q_materialize_table(spark, sf_dir):
    path = scratch_path(spark, "fact_by_date")
    materialize_table(stg_crypto_prices(ticks(spark, sf_dir)).drop("ingested_at"), path, ["event_date"])
    return spark.read.parquet(path).groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))


@register("materialize_view", sql=f"WITH {STG_PRICES} SELECT symbol, count(*) AS n FROM stg GROUP BY 1")
def q_materialize_view(spark, sf_dir):
    materialize_view(stg_crypto_prices(ticks(spark, sf_dir)), "stg_crypto_prices")
    return spark.sql("SELECT symbol, count(*) AS n FROM stg_crypto_prices GROUP BY symbol")


@register("src_layer_views", sql=f"""
WITH {BASE_TICKS}, {candles_cte('1 minute')}
SELECT 'bronze_prices' AS view_name, (SELECT count(*) FROM base_ticks) AS records
UNION ALL SELECT 'silver_ohlc', (SELECT count(*) FROM candles)""")
def q_src_layer_views(spark, sf_dir):
    root = scratch_path(spark, "layers")
    base_ticks(spark, sf_dir).write.mode("overwrite").partitionBy("symbol").parquet(f"{root}/bronze")
    ohlc_candles(base_ticks(spark, sf_dir), "1 minute").write.mode("overwrite").partitionBy(
        "symbol").parquet(f"{root}/silver")
    names = register_layer_views(spark, {"bronze_prices": f"{root}/bronze", "silver_ohlc": f"{root}/silver",
                                         "gold_analytics": f"{root}/gold"})  # gold missing: tolerated
    parts = [spark.table(n).agg(F.count(F.lit(1)).alias("records")).select(F.lit(n).alias("view_name"), "records")
             for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("src_delta_scan", doubles=["price"], sql=f"""
WITH {BASE_TICKS} SELECT symbol, max(price) AS price, count(*) AS n FROM base_ticks GROUP BY 1""")
def q_src_delta_scan(spark, sf_dir):
    path = scratch_path(spark, "bronze_scan")
    base_ticks(spark, sf_dir).write.mode("overwrite").parquet(path)
    return scan_path(spark, path).groupBy("symbol").agg(F.max("price").alias("price"),
                                                         F.count(F.lit(1)).alias("n"))


@register("compact_table", sql=f"""
WITH {BASE_TICKS} SELECT symbol, count(*) AS n, CAST(sum(kafka_offset) AS BIGINT) AS offsets FROM base_ticks GROUP BY 1""")
def q_compact_table(spark, sf_dir):
    src = scratch_path(spark, "small_files")
    # many small files: one per (task, symbol)
    base_ticks(spark, sf_dir).repartition(64).write.mode("overwrite").partitionBy("symbol").parquet(src)
    out = compact_table(spark, src)
    return out.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("kafka_offset").alias("offsets"))
