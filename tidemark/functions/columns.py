"""Scalar operators: small functions returning ``Column``.

They know nothing about batch or stream and compile to built-in
expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timecols import col_

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------
MAX_PRICE_CHANGE_PCT = 50.0
KNOWN_SYMBOLS = ["BTCUSDT", "ETHUSDT", "BNBUSDT", "SOLUSDT", "XRPUSDT"]
TRACKED_SYMBOLS = ["BTCUSDT", "ETHUSDT", "BNBUSDT"]
CURRENCY_NAMES = {
    "BTCUSDT": "Bitcoin",
    "ETHUSDT": "Ethereum",
    "BNBUSDT": "Binance Coin",
    "SOLUSDT": "Solana",
    "XRPUSDT": "Ripple",
}
TIER_1 = ["BTCUSDT", "ETHUSDT"]
TIER_2 = ["BNBUSDT", "SOLUSDT", "XRPUSDT"]
QUOTE_SUFFIXES = ["USDT", "USD", "BTC"]  # tested in this order
SENTIMENT_LABELS = {
    "Extreme Fear": "[EXTREME FEAR]",
    "Fear": "[FEAR]",
    "Neutral": "[NEUTRAL]",
    "Greed": "[GREED]",
    "Extreme Greed": "[EXTREME GREED]",
}
SENTIMENT_UNKNOWN_LABEL = "[UNKNOWN]"
# Sentiment zone bands [lo, hi) and names, the last band closed at 100.
SENTIMENT_ZONES = [(0, 30, "Extreme Fear"), (30, 45, "Fear"), (45, 55, "Neutral"),
                   (55, 70, "Greed"), (70, 100, "Extreme Greed")]
TREND_STRONG = 2.0
TREND_WEAK = 0.5
HIGH_VOLUME = 1_000_000
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def safe_ratio(x, y) -> Column:
    """x / NULLIF(y, 0): null instead of an ANSI divide-by-zero error."""
    return F.try_divide(col_(x), F.nullif(col_(y), F.lit(0)))


def pct_change(new, old) -> Column:
    """(new - old) / old * 100; null when old is 0 or null."""
    return safe_ratio(col_(new) - col_(old), old) * 100


# --- staging ---------------------------------------------------------------

def flag_anomaly(price="price", volume="volume", change="price_change_percent",
                 max_change: float = MAX_PRICE_CHANGE_PCT) -> Column:
    return (F.when(col_(price) <= 0, True)
            .when(col_(volume) < 0, True)
            .when(F.abs(col_(change)) > max_change, True)
            .otherwise(False))


def flag_ohlc_integrity(o="open", h="high", l="low", c="close") -> Column:
    return (F.when(col_(h) < col_(l), True)
            .when((col_(o) > col_(h)) | (col_(o) < col_(l)), True)
            .when((col_(c) > col_(h)) | (col_(c) < col_(l)), True)
            .otherwise(False))


def candle_type(o="open", c="close") -> Column:
    return (F.when(col_(c) > col_(o), "BULLISH")
            .when(col_(c) < col_(o), "BEARISH")
            .otherwise("DOJI"))


def body_size(o="open", c="close") -> Column:
    return F.abs(col_(c) - col_(o))


def upper_wick(o="open", h="high", c="close") -> Column:
    return col_(h) - F.greatest(col_(o), col_(c))


def lower_wick(o="open", l="low", c="close") -> Column:
    return F.least(col_(o), col_(c)) - col_(l)


# --- symbols -----------------------------------------------------------------

def split_symbol(symbol="symbol"):
    """(base, quote). Like SQL REPLACE, *every* occurrence of the matched quote
    text is removed, not only the suffix."""
    s = col_(symbol)
    base = F.when(s.endswith("USDT"), F.replace(s, F.lit("USDT"), F.lit(""))) \
        .when(s.endswith("USD"), F.replace(s, F.lit("USD"), F.lit(""))) \
        .when(s.endswith("BTC"), F.replace(s, F.lit("BTC"), F.lit(""))) \
        .otherwise(s)
    quote = F.when(s.endswith("USDT"), "USDT").when(s.endswith("USD"), "USD") \
        .when(s.endswith("BTC"), "BTC").otherwise("UNKNOWN")
    return base, quote


def currency_name(symbol="symbol") -> Column:
    s = col_(symbol)
    expr = None
    for k, v in CURRENCY_NAMES.items():
        expr = F.when(s == k, v) if expr is None else expr.when(s == k, v)
    return expr.otherwise("Unknown")


def market_tier(symbol="symbol") -> Column:
    s = col_(symbol)
    return F.when(s.isin(TIER_1), "TIER_1").when(s.isin(TIER_2), "TIER_2").otherwise("TIER_3")


# --- marts -------------------------------------------------------------------

def position_in_range(price="price", high="high_24h", low="low_24h") -> Column:
    return F.when(col_(high) > col_(low),
                  (col_(price) - col_(low)) / (col_(high) - col_(low)) * 100).otherwise(F.lit(50.0))


def surrogate_key(*cols) -> Column:
    """md5 over '-'-joined text of the columns, nulls replaced by a marker
    (the public dbt_utils definition)."""
    parts = [F.coalesce(col_(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def hour_sentiment(bull="bullish_candles", bear="bearish_candles") -> Column:
    b, r = col_(bull), col_(bear)
    return (F.when(b > r * 1.5, "STRONG_BULLISH")
            .when(b > r, "BULLISH")
            .when(r > b * 1.5, "STRONG_BEARISH")
            .when(r > b, "BEARISH")
            .otherwise("NEUTRAL"))


# --- gold --------------------------------------------------------------------

def trend_signal(pct="price_change_pct") -> Column:
    p = col_(pct)
    return (F.when(p > TREND_STRONG, "STRONG_BULLISH")
            .when(p > TREND_WEAK, "BULLISH")
            .when(p < -TREND_STRONG, "STRONG_BEARISH")
            .when(p < -TREND_WEAK, "BEARISH")
            .otherwise("NEUTRAL"))


def volume_signal(volume="period_volume", threshold: float = HIGH_VOLUME) -> Column:
    return F.when(col_(volume) > threshold, "HIGH_VOLUME").otherwise("NORMAL_VOLUME")


def direction_label(x, flat: bool = True) -> Column:
    """UP / DOWN / FLAT for ticker changes; with ``flat=False`` (moves) UP if >0
    else DOWN."""
    c = col_(x)
    if flat:
        return F.when(c > 0, "UP").when(c < 0, "DOWN").otherwise("FLAT")
    return F.when(c > 0, "UP").otherwise("DOWN")


def null_to_zero(c) -> Column:
    return F.coalesce(col_(c), F.lit(0.0))


# --- sentiment ---------------------------------------------------------------

def sentiment_label(classification="classification") -> Column:
    m = F.create_map(*[x for k, v in SENTIMENT_LABELS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, col_(classification)), F.lit(SENTIMENT_UNKNOWN_LABEL))


def sentiment_zone(index="fear_greed_index") -> Column:
    v = col_(index)
    expr = None
    for i, (lo, hi, name) in enumerate(SENTIMENT_ZONES):
        last = i == len(SENTIMENT_ZONES) - 1
        cond = (v >= lo) & ((v <= hi) if last else (v < hi))
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr


def significant_move(pct="price_change_pct", threshold: float = 0.5) -> Column:
    return F.abs(col_(pct)) > threshold
