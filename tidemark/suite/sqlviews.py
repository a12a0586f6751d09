"""DuckDB text of the fixtures (oracle side), mirroring ``sources.fixtures``.

Kept deliberately naive: whole-symbol windows and plain joins, the obvious
way to state each definition, so the oracle checks the chunked Spark plans.
"""

SYMBOL_CASE = ("CASE event_type WHEN 'click' THEN 'BTCUSDT' WHEN 'view' THEN 'ETHUSDT' "
               "WHEN 'purchase' THEN 'BNBUSDT' WHEN 'signup' THEN 'SOLUSDT' "
               "WHEN 'error' THEN 'XRPUSDT' END")

BASE_TICKS = f"""base_ticks AS (
    SELECT {SYMBOL_CASE} AS symbol,
           value AS price,
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume,
           ts AS event_time,
           event_id AS kafka_offset,
           CAST(user_id % 3 AS INTEGER) AS kafka_partition,
           epoch_us(ts) // 1000 AS "timestamp"
    FROM events
)"""

TICKS = BASE_TICKS + """,
ticks AS (
    SELECT *,
           max(price) OVER w24 AS high_24h,
           min(price) OVER w24 AS low_24h,
           (price - arg_min(price, (event_time, kafka_offset)) OVER w24)
             / NULLIF(arg_min(price, (event_time, kafka_offset)) OVER w24, 0) * 100
             AS price_change_percent
    FROM base_ticks
    WINDOW w24 AS (PARTITION BY symbol ORDER BY event_time
                   RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)
)"""


def candles_cte(interval: str, name: str = "candles", src: str = "base_ticks") -> str:
    """Tumbling candles: ``interval`` is a DuckDB interval literal body."""
    return f"""{name} AS (
    SELECT symbol,
           time_bucket(INTERVAL '{interval}', event_time) AS window_start,
           time_bucket(INTERVAL '{interval}', event_time) + INTERVAL '{interval}' AS window_end,
           arg_min(price, (event_time, kafka_offset)) AS open,
           max(price) AS high,
           min(price) AS low,
           arg_max(price, (event_time, kafka_offset)) AS close,
           sum(volume) AS volume,
           count(*) AS trade_count,
           sum(price * volume) / NULLIF(sum(volume), 0) AS vwap,
           stddev_samp(price) AS price_volatility
    FROM {src}
    GROUP BY symbol, time_bucket(INTERVAL '{interval}', event_time)
)"""


CANDLE_COLS = ("symbol, window_start, window_end, open, high, low, close, volume, trade_count, "
               "vwap, price_volatility, (close - open) / NULLIF(open, 0) * 100 AS candle_change_pct")

SENTIMENT = """hourly_k AS (
    SELECT time_bucket(INTERVAL '1 hour', ts) + INTERVAL 1 HOUR AS event_time,
           CAST(floor(avg(CAST(json_extract_string(props, '$.k') AS BIGINT))) AS BIGINT) AS value
    FROM events GROUP BY 1
),
sentiment AS (
    SELECT 'fear_greed_index' AS type, value,
           CASE WHEN value < 30 THEN 'Extreme Fear' WHEN value < 45 THEN 'Fear'
                WHEN value < 55 THEN 'Neutral' WHEN value < 70 THEN 'Greed'
                WHEN value <= 100 THEN 'Extreme Greed' END AS classification,
           epoch_us(event_time) // 1000 AS "timestamp",
           epoch_us(event_time) // 1000000 AS index_timestamp,
           event_time,
           epoch_us(event_time) // 3600000000 AS msg_id
    FROM hourly_k
)"""


def iso_ms(ms: str) -> str:
    """Python isoformat() of epoch ms, DuckDB side."""
    return (f"CASE WHEN {ms} % 1000 = 0 THEN strftime(epoch_ms({ms}), '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime(epoch_ms({ms}), '%Y-%m-%dT%H:%M:%S.%f') END")

STG_PRICES = TICKS + """,
stg AS (
    SELECT symbol, price, volume, price_change_percent, high_24h, low_24h, event_time,
           kafka_partition, kafka_offset,
           CASE WHEN price <= 0 THEN TRUE WHEN volume < 0 THEN TRUE
                WHEN abs(price_change_percent) > 50 THEN TRUE ELSE FALSE END AS is_anomaly,
           date_trunc('hour', event_time) AS event_hour,
           date_trunc('day', event_time) AS event_date
    FROM ticks
    WHERE symbol IS NOT NULL AND price IS NOT NULL AND event_time IS NOT NULL
)"""


def stg_candles_cte(interval: str = "1 minute") -> str:
    return BASE_TICKS + ", " + candles_cte(interval, "raw_candles") + f""",
candles AS (SELECT {CANDLE_COLS} FROM raw_candles),
stg_c AS (
    SELECT *,
           CASE WHEN high < low THEN TRUE WHEN open > high OR open < low THEN TRUE
                WHEN close > high OR close < low THEN TRUE ELSE FALSE END AS has_integrity_issue,
           CASE WHEN close > open THEN 'BULLISH' WHEN close < open THEN 'BEARISH'
                ELSE 'DOJI' END AS candle_type,
           abs(close - open) AS body_size,
           high - greatest(open, close) AS upper_wick,
           least(open, close) - low AS lower_wick
    FROM candles
    WHERE symbol IS NOT NULL AND window_start IS NOT NULL
)"""


FACT = STG_PRICES + """,
lagged AS (
    SELECT *,
           lag(price) OVER (PARTITION BY symbol ORDER BY event_time, kafka_offset) AS prev_price,
           lag(volume) OVER (PARTITION BY symbol ORDER BY event_time, kafka_offset) AS prev_volume
    FROM stg WHERE NOT is_anomaly
),
fact AS (
    SELECT md5(concat_ws('-', coalesce(CAST(symbol AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
                              coalesce(CAST(event_time AS VARCHAR), '_dbt_utils_surrogate_key_null_')))
             AS trade_id,
           symbol, event_time, event_hour, event_date, price, prev_price,
           price - coalesce(prev_price, price) AS price_change,
           CASE WHEN prev_price > 0 THEN (price - prev_price) / prev_price * 100 ELSE 0.0 END
             AS price_change_pct,
           volume, prev_volume, volume - coalesce(prev_volume, volume) AS volume_change,
           high_24h, low_24h, price_change_percent AS change_24h_pct,
           CASE WHEN high_24h > low_24h THEN (price - low_24h) / (high_24h - low_24h) * 100
                ELSE 50.0 END AS position_in_range_pct,
           kafka_partition, kafka_offset
    FROM lagged
)"""

HOURLY = stg_candles_cte() + """,
hourly AS (
    SELECT symbol, date_trunc('hour', window_start) AS hour_start,
           date_trunc('day', date_trunc('hour', window_start)) AS event_date,
           arg_min(open, window_start) AS hour_open, max(high) AS hour_high,
           min(low) AS hour_low, arg_max(close, window_start) AS hour_close,
           sum(volume) AS total_volume, CAST(sum(trade_count) AS BIGINT) AS total_trades,
           avg(vwap) AS avg_vwap, avg(price_volatility) AS avg_volatility,
           count(*) AS candle_count,
           CAST(count_if(candle_type = 'BULLISH') AS BIGINT) AS bullish_candles,
           CAST(count_if(candle_type = 'BEARISH') AS BIGINT) AS bearish_candles,
           CAST(count_if(candle_type = 'DOJI') AS BIGINT) AS doji_candles
    FROM stg_c WHERE NOT has_integrity_issue
    GROUP BY 1, 2
),
hourly_stats AS (
    SELECT symbol, hour_start, event_date, hour_open, hour_high, hour_low, hour_close,
           (hour_close - hour_open) / NULLIF(hour_open, 0) * 100 AS hour_change_pct,
           total_volume, total_trades, avg_vwap, avg_volatility, candle_count,
           bullish_candles, bearish_candles, doji_candles,
           CAST(bullish_candles AS DOUBLE) / NULLIF(candle_count, 0) AS bullish_ratio,
           CASE WHEN bullish_candles > bearish_candles * 1.5 THEN 'STRONG_BULLISH'
                WHEN bullish_candles > bearish_candles THEN 'BULLISH'
                WHEN bearish_candles > bullish_candles * 1.5 THEN 'STRONG_BEARISH'
                WHEN bearish_candles > bullish_candles THEN 'BEARISH'
                ELSE 'NEUTRAL' END AS hour_sentiment
    FROM hourly
)"""

DIM = STG_PRICES + """,
dim AS (
    SELECT symbol,
           CASE WHEN symbol LIKE '%USDT' THEN replace(symbol, 'USDT', '')
                WHEN symbol LIKE '%USD' THEN replace(symbol, 'USD', '')
                WHEN symbol LIKE '%BTC' THEN replace(symbol, 'BTC', '')
                ELSE symbol END AS base_currency,
           CASE WHEN symbol LIKE '%USDT' THEN 'USDT' WHEN symbol LIKE '%USD' THEN 'USD'
                WHEN symbol LIKE '%BTC' THEN 'BTC' ELSE 'UNKNOWN' END AS quote_currency,
           CASE WHEN symbol = 'BTCUSDT' THEN 'Bitcoin' WHEN symbol = 'ETHUSDT' THEN 'Ethereum'
                WHEN symbol = 'BNBUSDT' THEN 'Binance Coin' WHEN symbol = 'SOLUSDT' THEN 'Solana'
                WHEN symbol = 'XRPUSDT' THEN 'Ripple' ELSE 'Unknown' END AS currency_name,
           CASE WHEN symbol IN ('BTCUSDT', 'ETHUSDT') THEN 'TIER_1'
                WHEN symbol IN ('BNBUSDT', 'SOLUSDT', 'XRPUSDT') THEN 'TIER_2'
                ELSE 'TIER_3' END AS market_tier,
           TRUE AS is_active
    FROM (SELECT DISTINCT symbol FROM stg)
)"""


def spikes_sql(window: int = 50, min_history: int = 10, mult: float = 1.5) -> str:
    return f"""
WITH {BASE_TICKS},
v AS (SELECT * REPLACE (coalesce(volume, 0.0) AS volume) FROM base_ticks),
w AS (
    SELECT *, count(*) OVER w50 AS n, avg(volume) OVER w50 AS volume_baseline
    FROM v
    WINDOW w50 AS (PARTITION BY symbol ORDER BY event_time, kafka_offset
                   ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW)
),
m AS (
    SELECT *, CASE WHEN volume_baseline > 0 THEN volume / volume_baseline ELSE 0.0 END
                AS spike_multiplier
    FROM w WHERE n >= {min_history}
)
SELECT event_time AS spike_time, symbol, volume, volume_baseline, spike_multiplier,
       price AS price_at_spike
FROM m WHERE spike_multiplier >= {mult} AND price IS NOT NULL"""


SEQ_TICKS = """seqd AS (
    SELECT symbol, event_time, kafka_offset, price,
           row_number() OVER (PARTITION BY symbol ORDER BY event_time, kafka_offset) AS rn
    FROM base_ticks WHERE price IS NOT NULL
)"""


def moves_v2_sql(minutes: int = 20, max_rows: int = 100, min_points: int = 3,
                 threshold: float = 0.1) -> str:
    return f"""
WITH {BASE_TICKS}, {SEQ_TICKS},
win AS (
    SELECT a.symbol, a.event_time AS window_end, a.kafka_offset, a.price AS last_price,
           count(*) AS n, min(b.event_time) AS window_start,
           arg_min(b.price, b.rn) AS first_price, avg(b.price) AS avg_price,
           coalesce(stddev_samp(b.price), 0.0) AS volatility
    FROM seqd a JOIN seqd b
      ON a.symbol = b.symbol AND b.rn BETWEEN a.rn - {max_rows - 1} AND a.rn
     AND b.event_time >= a.event_time - INTERVAL {minutes} MINUTE
    GROUP BY a.symbol, a.event_time, a.kafka_offset, a.price
)
SELECT window_start, window_end, symbol,
       (last_price - first_price) / NULLIF(first_price, 0) * 100 AS price_change_pct,
       avg_price, volatility, kafka_offset
FROM win
WHERE n >= {min_points}
  AND abs((last_price - first_price) / NULLIF(first_price, 0) * 100) >= {threshold}"""


def moves_v1_sql(minutes: int = 20, min_points: int = 10) -> str:
    return f"""
WITH {BASE_TICKS},
priced AS (SELECT * FROM base_ticks WHERE price IS NOT NULL),
win AS (
    SELECT a.symbol, a.event_time AS window_end, a.kafka_offset, a.price AS last_price,
           count(*) AS n, min(b.event_time) AS window_start,
           arg_min(b.price, (b.event_time, b.kafka_offset)) AS first_price,
           avg(b.price) AS avg_price
    FROM priced a JOIN priced b
      ON a.symbol = b.symbol AND b.event_time > a.event_time - INTERVAL {minutes} MINUTE
     AND (b.event_time < a.event_time OR (b.event_time = a.event_time AND b.kafka_offset <= a.kafka_offset))
    GROUP BY a.symbol, a.event_time, a.kafka_offset, a.price
)
SELECT window_start, window_end, symbol,
       (last_price - first_price) / NULLIF(first_price, 0) * 100 AS price_change_pct, avg_price
FROM win WHERE n >= {min_points}"""


def asof_sql(minutes: int = 20, strict: bool = False) -> str:
    cmp = ">" if strict else ">="
    return f"""{BASE_TICKS}, {SENTIMENT},
seqd AS (
    SELECT symbol, event_time, kafka_offset, price,
           row_number() OVER (PARTITION BY symbol ORDER BY event_time, kafka_offset) AS rn
    FROM base_ticks WHERE symbol IN ('BTCUSDT', 'ETHUSDT') AND price IS NOT NULL
),
st AS (
    SELECT a.symbol, a.event_time, a.kafka_offset, count(*) AS n_points,
           (a.price - arg_min(b.price, b.rn)) / NULLIF(arg_min(b.price, b.rn), 0) * 100 AS change
    FROM seqd a JOIN seqd b
      ON a.symbol = b.symbol AND b.rn BETWEEN a.rn - 9 AND a.rn
     AND b.event_time {cmp} a.event_time - INTERVAL {minutes} MINUTE
    GROUP BY a.symbol, a.event_time, a.kafka_offset, a.price
),
sy AS (SELECT s.*, v.symbol FROM sentiment s, (VALUES ('BTCUSDT'), ('ETHUSDT')) AS v(symbol)),
asofj AS (
    SELECT sy.msg_id, sy.event_time, sy.value, sy.classification, sy.symbol, st.n_points, st.change
    FROM sy ASOF LEFT JOIN st ON sy.symbol = st.symbol AND sy.event_time >= st.event_time
),
pairs AS (
    SELECT msg_id, event_time, value, classification,
           max(CASE WHEN symbol = 'BTCUSDT' THEN change END) AS btc_price_change,
           max(CASE WHEN symbol = 'ETHUSDT' THEN change END) AS eth_price_change
    FROM asofj GROUP BY 1, 2, 3, 4
    HAVING min(coalesce(n_points, 0)) >= 5
)"""


def signals_v2_sql(minutes: int = 20) -> str:
    return f"""
WITH {asof_sql(minutes)},
d AS (
    SELECT *, CASE WHEN btc_price_change > 0.3 AND eth_price_change > 0.3 THEN 'BULLISH'
                   WHEN btc_price_change < -0.3 AND eth_price_change < -0.3 THEN 'BEARISH'
                   ELSE 'MIXED' END AS market_direction
    FROM pairs
),
s AS (
    SELECT *, CASE WHEN value < 30 AND market_direction = 'BEARISH' THEN 'STRONG_BUY'
                   WHEN value > 70 AND market_direction = 'BULLISH' THEN 'STRONG_SELL'
                   WHEN value < 30 AND market_direction = 'BULLISH' THEN 'REVERSAL_UP'
                   WHEN value > 70 AND market_direction = 'BEARISH' THEN 'REVERSAL_DOWN'
                   WHEN value < 45 AND btc_price_change > 0.3 THEN 'BUY_SIGNAL'
                   WHEN value > 55 AND btc_price_change < -0.3 THEN 'SELL_SIGNAL'
                   WHEN market_direction <> 'MIXED' THEN 'CORRELATION'
                   ELSE 'NEUTRAL' END AS correlation_signal
    FROM d
)
SELECT event_time - INTERVAL 10 MINUTE AS window_start, event_time AS window_end,
       CAST(value AS INTEGER) AS fear_greed_index, classification AS fear_greed_class,
       btc_price_change, eth_price_change, market_direction, correlation_signal
FROM s WHERE correlation_signal <> 'NEUTRAL'"""


def signals_v1_sql(minutes: int = 20) -> str:
    return f"""
WITH {asof_sql(minutes, strict=True)},
d AS (
    SELECT *, CASE WHEN btc_price_change > 0 AND eth_price_change > 0 THEN 'BULLISH'
                   WHEN btc_price_change < 0 AND eth_price_change < 0 THEN 'BEARISH'
                   ELSE 'MIXED' END AS market_direction
    FROM pairs
)
SELECT event_time - INTERVAL 15 MINUTE AS window_start, event_time AS window_end,
       CAST(value AS INTEGER) AS fear_greed_index, classification AS fear_greed_class,
       btc_price_change, eth_price_change, market_direction,
       CASE WHEN value < 25 AND market_direction = 'BEARISH' THEN 'BUY_SIGNAL'
            WHEN value > 75 AND market_direction = 'BULLISH' THEN 'SELL_SIGNAL'
            WHEN value < 25 AND market_direction = 'BULLISH' THEN 'REVERSAL_CONFIRMED'
            ELSE 'NEUTRAL' END AS correlation_signal
FROM d"""


def _bronze(bad: str) -> str:
    """Bronze rows; where ``bad`` holds the message is broken on the wire."""
    return TICKS + f""",
bronze AS (
    SELECT symbol AS symbol_key,
           CASE WHEN bad THEN NULL ELSE symbol END AS symbol,
           CASE WHEN bad THEN NULL ELSE price END AS price,
           CASE WHEN bad THEN NULL ELSE volume END AS volume,
           CASE WHEN bad THEN NULL ELSE price_change_percent END AS price_change_percent,
           CASE WHEN bad THEN NULL ELSE high_24h END AS high_24h,
           CASE WHEN bad THEN NULL ELSE low_24h END AS low_24h,
           CASE WHEN bad THEN NULL ELSE "timestamp" END AS "timestamp",
           CASE WHEN bad THEN NULL ELSE {iso_ms('"timestamp"')} END AS human_time,
           epoch_ms(t."timestamp") AS kafka_timestamp, kafka_partition, kafka_offset,
           CASE WHEN bad THEN NULL ELSE epoch_ms(t."timestamp") END AS event_time
    FROM (SELECT *, {bad} AS bad FROM ticks) AS t
)"""


BRONZE = _bronze("FALSE")
BRONZE_CUT = _bronze("kafka_offset % 97 = 0")

TEST_BOUNDS_SQL = """bounds AS (
    SELECT * FROM (VALUES ('BTCUSDT', 1.0, 200.0, 0.0, 90.0), ('ETHUSDT', 1.0, 200.0, 0.0, 90.0),
                          ('BNBUSDT', 1.0, 200.0, 0.0, 90.0))
           AS t(symbol, min_price, max_price, min_volume, max_volume)
)"""

AS_OF_MS = "epoch_ms(TIMESTAMP '2024-01-31 00:00:00')"

VALIDATED = BRONZE_CUT + ", " + TEST_BOUNDS_SQL + f""",
v0 AS (
    SELECT b.*, bd.min_price, bd.max_price, bd.min_volume, bd.max_volume,
           concat_ws('; ',
             CASE WHEN b.symbol IS NULL THEN 'Schema validation failed: symbol missing' END,
             CASE WHEN b.price IS NULL THEN 'Schema validation failed: price missing' END,
             CASE WHEN b.volume IS NULL THEN 'Schema validation failed: volume missing' END,
             CASE WHEN b."timestamp" IS NULL THEN 'Schema validation failed: timestamp missing' END,
             CASE WHEN b.price <= 0 THEN 'Schema validation failed: Price must be positive' END,
             CASE WHEN b.volume < 0 THEN 'Schema validation failed: Volume cannot be negative' END
           ) AS errors_text
    FROM bronze b LEFT JOIN bounds bd ON upper(b.symbol) = bd.symbol
),
validated AS (
    SELECT kafka_offset, upper(symbol) AS symbol, errors_text = '' AS valid, errors_text,
           CASE WHEN errors_text = '' THEN concat_ws('; ',
             CASE WHEN price < min_price OR price > max_price THEN
               'Price ' || CAST(price AS VARCHAR) || ' outside expected range [' ||
               CAST(min_price AS VARCHAR) || ', ' || CAST(max_price AS VARCHAR) || ']' END,
             CASE WHEN volume < min_volume OR volume > max_volume THEN
               'Volume ' || CAST(volume AS VARCHAR) || ' outside expected range [' ||
               CAST(min_volume AS VARCHAR) || ', ' || CAST(max_volume AS VARCHAR) || ']' END,
             CASE WHEN "timestamp" > 0 AND ({AS_OF_MS} - "timestamp") / 1000.0 > 300 THEN
               'Stale data: ' || CAST(CAST(round_even(({AS_OF_MS} - "timestamp") / 1000.0, 0) AS BIGINT) AS VARCHAR) || 's old' END,
             CASE WHEN abs(price_change_percent) > 50 THEN
               'Extreme price change: ' || CAST(price_change_percent AS VARCHAR) || '%' END
           ) ELSE '' END AS warnings_text,
           upper(symbol) IS NOT NULL AND upper(symbol) NOT IN ('BTCUSDT', 'ETHUSDT', 'BNBUSDT', 'SOLUSDT', 'XRPUSDT')
             AS unknown_symbol
    FROM v0
)"""


def iso_ts(t: str) -> str:
    return (f"CASE WHEN epoch_us({t}) % 1000000 = 0 THEN strftime({t}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({t}, '%Y-%m-%dT%H:%M:%S.%f') END")


AS_OF_TS = "TIMESTAMP '2024-01-31 00:00:00'"

RSS = f"""rss AS (
    SELECT 'news_article' AS type, md5(coalesce(text, '')) AS id, source,
           coalesce(split_part(text, chr(10), 1), '') AS title, coalesce(text, '') AS summary, coalesce(text, '') AS link,
           CASE WHEN lang = 'en' THEN source END AS author0,
           coalesce(CASE WHEN lang IN ('en', 'fr') THEN TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id AS INTEGER)) END,
                    CASE WHEN lang <> 'de' THEN TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id AS INTEGER)) + INTERVAL 30 SECOND END,
                    {AS_OF_TS}) AS t,
           lang || ',' || source AS tags_text,
           doc_id AS entry_id, 1 AS source_rank
    FROM documents
)"""

NEWSAPI = f"""newsapi AS (
    SELECT 'news_article' AS type, md5(coalesce(text, '')) AS id,
           CASE WHEN n_chars % 2 = 0 THEN source ELSE 'NewsAPI' END AS source,
           coalesce(split_part(text, chr(10), 1), '') AS title, coalesce(text, '') AS summary, coalesce(text, '') AS link,
           source AS author0,
           CASE WHEN n_chars % 3 = 0 THEN {AS_OF_TS}
                ELSE TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id AS INTEGER)) END AS t,
           '' AS tags_text,
           doc_id AS entry_id, 0 AS source_rank
    FROM documents
)"""


def article_cols(src: str) -> str:
    return f"""SELECT type, id, source, title, summary, link, coalesce(author0, 'Unknown') AS author,
       epoch_us(t) / 1e6 AS created_utc, epoch_ms({AS_OF_TS}) AS "timestamp",
       {iso_ts('t')} AS human_time, tags_text, entry_id, source_rank FROM {src}"""


POLLS = SENTIMENT + """,
polls AS (
    SELECT msg_id AS poll_id, event_time AS poll_time, CAST(value AS VARCHAR) AS value,
           classification AS value_classification,
           CAST((index_timestamp // 86400) * 86400 AS VARCHAR) AS "timestamp",
           CASE WHEN index_timestamp % 3600 = 0 THEN ''
                ELSE CAST(3600 - index_timestamp % 3600 AS VARCHAR) END AS time_until_update
    FROM sentiment
)"""
