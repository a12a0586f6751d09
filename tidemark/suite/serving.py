"""Registered serving and wire-decoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.candles import market_analytics
from ..operators.insights import price_movements
from ..operators.quality import quality_metric_rows, validate_prices
from ..operators.serving import (
    analytics_latest, dashboard_analytics, latest_price_correlated, latest_price_semi,
    layer_counts, list_symbols, ohlc_latest, price_history, price_history_simple,
    quality_latest, quality_pass_rate, recent_movements, recent_summary,
)
from ..operators.warehouse import dim_symbols, stg_crypto_prices
from ..registry import register
from ..sources.decode import decode_price_json, kafka_envelope
from ..sources.fixtures import AS_OF, base_ticks, kafka_price_records, validation_bounds, ticks
from ..sources.footers import footer_table
from .layers import bronze, bronze_table, gold, last_prices, layer_footers, silver, written_layer
from .market import gold_sql
from .sqlviews import BASE_TICKS, BRONZE, BRONZE_CUT, CANDLE_COLS, DIM, VALIDATED, candles_cte, moves_v2_sql

SYMBOL = "BTCUSDT"
PRICE_DOUBLES = ["price", "volume", "price_change_percent"]


@register("kafka_envelope", sql=f"""
WITH {BRONZE}
SELECT symbol_key, CAST(kafka_timestamp AS TIMESTAMP) AS kafka_timestamp, kafka_partition AS "partition",
       kafka_offset AS "offset"
FROM bronze""")
def q_kafka_envelope(spark, sf_dir):
    return kafka_envelope(kafka_price_records(spark, sf_dir)).drop("raw_json")


BRONZE_DOUBLES = ["price", "volume", "price_change_percent", "high_24h", "low_24h"]


@register("decode_price_json", doubles=BRONZE_DOUBLES, sql=f"""
WITH {BRONZE_CUT}
SELECT symbol_key, symbol, price, volume, price_change_percent, high_24h, low_24h, "timestamp",
       human_time, kafka_timestamp, kafka_partition, kafka_offset
FROM bronze""")
def q_decode_price_json(spark, sf_dir):
    return decode_price_json(kafka_envelope(kafka_price_records(spark, sf_dir, cut=True)))


@register("bronze_ingest", doubles=BRONZE_DOUBLES, sql=f"WITH {BRONZE} SELECT * FROM bronze")
def q_bronze_ingest(spark, sf_dir):
    return bronze(spark, sf_dir)


@register("epoch_ms_to_ts", sql=f"""
WITH {BRONZE} SELECT kafka_offset, event_time FROM bronze""")
def q_epoch_ms_to_ts(spark, sf_dir):
    return bronze(spark, sf_dir).select("kafka_offset", "event_time")


@register("latest_price_correlated", doubles=PRICE_DOUBLES, sql=f"""
WITH {BRONZE}
SELECT symbol, price, volume, coalesce(price_change_percent, 0.0) AS price_change_percent, event_time
FROM bronze b1
WHERE event_time = (SELECT max(event_time) FROM bronze b2 WHERE b2.symbol = b1.symbol)""")
def q_latest_price_correlated(spark, sf_dir):
    return latest_price_correlated(spark, last_prices(spark, sf_dir))


@register("latest_price_semi", doubles=PRICE_DOUBLES, sql=f"""
WITH {BRONZE}
SELECT symbol, price, volume, price_change_percent, event_time
FROM bronze
WHERE (symbol, event_time) IN (SELECT symbol, max(event_time) FROM bronze GROUP BY symbol)""")
def q_latest_price_semi(spark, sf_dir):
    return latest_price_semi(last_prices(spark, sf_dir))


@register("null_to_zero", doubles=["price_change_percent"], sql=f"""
WITH {BRONZE}
SELECT kafka_offset, coalesce(price_change_percent, 0.0) AS price_change_percent FROM bronze""")
def q_null_to_zero(spark, sf_dir):
    from ..functions.columns import null_to_zero
    return bronze(spark, sf_dir).select("kafka_offset", null_to_zero("price_change_percent")
                                        .alias("price_change_percent"))


@register("price_history", doubles=PRICE_DOUBLES, sql=f"""
WITH {BRONZE}
SELECT symbol, price, volume, coalesce(price_change_percent, 0.0) AS price_change_percent,
       event_time, kafka_offset
FROM bronze
WHERE symbol = '{SYMBOL}' AND event_time > TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR
ORDER BY event_time DESC, kafka_offset DESC LIMIT 100""")
def q_price_history(spark, sf_dir):
    return price_history(bronze_table(spark, sf_dir), SYMBOL.lower(), AS_OF, hours=24, limit=100)


@register("price_history_simple", doubles=PRICE_DOUBLES, sql=f"""
WITH {BRONZE}
SELECT symbol, price, volume, price_change_percent, event_time, kafka_offset
FROM bronze WHERE symbol = 'ETHUSDT'
ORDER BY event_time DESC, kafka_offset DESC LIMIT 50""")
def q_price_history_simple(spark, sf_dir):
    return price_history_simple(bronze_table(spark, sf_dir), "ethusdt", limit=50)


@register("ohlc_latest", doubles=["open", "high", "low", "close", "volume", "vwap", "candle_change_pct"],
          sql=f"""
WITH {BASE_TICKS}, {candles_cte('1 minute', 'raw_candles')}, candles AS (SELECT {CANDLE_COLS} FROM raw_candles)
SELECT symbol, window_start, window_end, open, high, low, close, volume, vwap, trade_count,
       candle_change_pct
FROM candles WHERE symbol = 'SOLUSDT' ORDER BY window_start DESC LIMIT 200""")
def q_ohlc_latest(spark, sf_dir):
    return ohlc_latest(silver(spark, sf_dir), "SOLUSDT", limit=200)


ANALYTICS_SQL = f"""
SELECT symbol, period_start, period_end, price_change_pct, coalesce(avg_volatility, 0.0) AS volatility,
       signal, volume_signal, total_trades
FROM ({gold_sql('1 minute', 15, 5)}) WHERE symbol = 'XRPUSDT'
ORDER BY period_end DESC, period_start DESC"""


@register("analytics_latest", doubles=["price_change_pct", "volatility"],
          sql=ANALYTICS_SQL + " LIMIT 200")
def q_analytics_latest(spark, sf_dir):
    return analytics_latest(gold(spark, sf_dir), "XRPUSDT", limit=200)


@register("analytics_all", doubles=["price_change_pct", "volatility"], sql=ANALYTICS_SQL)
def q_analytics_all(spark, sf_dir):
    return analytics_latest(gold(spark, sf_dir), "XRPUSDT", limit=None)


@register("dashboard_analytics", doubles=["price_change_pct"], sql=f"""
SELECT symbol, price_change_pct, signal, volume_signal, total_trades
FROM ({gold_sql('1 hour', 720, 240)})""")
def q_dashboard_analytics(spark, sf_dir):
    return dashboard_analytics(market_analytics(silver(spark, sf_dir, "1 hour"), "12 hours", "4 hours"))


@register("list_symbols", sql=f"""
WITH {DIM}
SELECT symbol, base_currency, quote_currency, currency_name, market_tier FROM dim WHERE is_active""")
def q_list_symbols(spark, sf_dir):
    return list_symbols(dim_symbols(stg_crypto_prices(ticks(spark, sf_dir))))


@register("recent_movements", doubles=["price_change_pct", "avg_price"], sql=f"""
SELECT symbol, price_change_pct, avg_price, window_end, window_start
FROM ({moves_v2_sql()}) ORDER BY window_end DESC, kafka_offset DESC LIMIT 20""")
def q_recent_movements(spark, sf_dir):
    return recent_movements(price_movements(base_ticks(spark, sf_dir)))


@register("table_row_count", sql=f"SELECT count(*) AS total FROM ({moves_v2_sql()})")
def q_table_row_count(spark, sf_dir):
    """Rows of the stored table, from its footers."""
    moves = written_layer(spark, sf_dir, "movements", lambda spark, sf_dir: price_movements(base_ticks(spark, sf_dir)))
    return footer_table(spark, moves).agg(F.count(F.lit(1)).alias("total"))


@register("recent_summary", doubles=["avg_change", "min_price", "max_price", "avg_price_overall"], sql=f"""
WITH m AS ({moves_v2_sql()}),
r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_end DESC, kafka_offset DESC) AS rn
      FROM m WHERE symbol IN ('BTCUSDT', 'ETHUSDT', 'BNBUSDT'))
SELECT symbol, avg(price_change_pct) AS avg_change, min(avg_price) AS min_price,
       max(avg_price) AS max_price, avg(avg_price) AS avg_price_overall
FROM r WHERE rn <= 100 GROUP BY symbol
HAVING avg(price_change_pct) IS NOT NULL AND avg(price_change_pct) <> 0""")
def q_recent_summary(spark, sf_dir):
    return recent_summary(price_movements(base_ticks(spark, sf_dir)))


@register("layer_counts", sql=f"""
WITH {BASE_TICKS}, {candles_cte('1 minute')}
SELECT 'bronze' AS layer, (SELECT count(*) FROM base_ticks) AS records
UNION ALL SELECT 'silver', (SELECT count(*) FROM candles)
UNION ALL SELECT 'gold', (SELECT count(*) FROM ({gold_sql('1 minute', 15, 5)}))""")
def q_layer_counts(spark, sf_dir):
    return layer_counts(*[layer_footers(spark, sf_dir, name) for name in ("bronze", "silver", "gold")])


def _metric_rows(spark, sf_dir):
    res = validate_prices(bronze(spark, sf_dir, cut=True), validation_bounds(spark), AS_OF)
    return quality_metric_rows(res, "bronze_prices", AS_OF)


METRIC_ROWS_SQL = f"""
WITH {VALIDATED},
m AS (
    SELECT count(*) AS total, count_if(valid) AS valid_n, count_if(NOT valid) AS invalid_n,
           count_if(warnings_text <> '') AS warn_n
    FROM validated
),
r AS (
    SELECT 'validity_rate' AS metric_name, valid_n * 100.0 / total AS metric_value, 95.0 AS threshold,
           TRUE AS hib FROM m
    UNION ALL SELECT 'warning_rate', warn_n * 100.0 / total, 10.0, FALSE FROM m
    UNION ALL SELECT 'invalid_records', CAST(invalid_n AS DOUBLE), 0.0, FALSE FROM m
)
SELECT TIMESTAMP '{AS_OF}' AS check_time, 'bronze_prices' AS table_name, metric_name,
       CAST(metric_value AS DOUBLE) AS metric_value, CAST(threshold AS DOUBLE) AS threshold,
       CASE WHEN hib THEN CASE WHEN metric_value >= threshold THEN 'PASS'
                               WHEN metric_value >= threshold - (100 - threshold) THEN 'WARN'
                               ELSE 'FAIL' END
            ELSE CASE WHEN metric_value <= threshold THEN 'PASS'
                      WHEN metric_value <= greatest(threshold * 2, 1.0) THEN 'WARN'
                      ELSE 'FAIL' END END AS status
FROM r"""


@register("quality_latest", doubles=["metric_value", "threshold"],
          sql=f"SELECT * FROM ({METRIC_ROWS_SQL}) ORDER BY check_time DESC, table_name, metric_name LIMIT 20")
def q_quality_latest(spark, sf_dir):
    return quality_latest(_metric_rows(spark, sf_dir), 20)


@register("quality_pass_rate", doubles=["pass_rate"], sql=f"""
SELECT coalesce(avg(CASE WHEN status = 'PASS' THEN 100.0 ELSE 0.0 END), 0.0) AS pass_rate
FROM ({METRIC_ROWS_SQL})""")
def q_quality_pass_rate(spark, sf_dir):
    return quality_pass_rate(_metric_rows(spark, sf_dir))


@register("quality_metric_rows", doubles=["metric_value", "threshold"], sql=METRIC_ROWS_SQL)
def q_quality_metric_rows(spark, sf_dir):
    return _metric_rows(spark, sf_dir)


@register("validate_prices", sql=f"WITH {VALIDATED} SELECT * FROM validated")
def q_validate_prices(spark, sf_dir):
    res = validate_prices(bronze(spark, sf_dir, cut=True), validation_bounds(spark), AS_OF)
    return res.select("kafka_offset", "symbol", "valid",
                      F.concat_ws("; ", "errors").alias("errors_text"),
                      F.concat_ws("; ", "warnings").alias("warnings_text"), "unknown_symbol")
