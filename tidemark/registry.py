"""Named queries: a Spark plan plus the DuckDB SQL that must give the same rows.

Computed doubles (sums, means, deviations, ratios) are rounded in *both*
wrappers (never inside the operators) to 6 decimals after a 1e-9 nudge, so
float sums taken in a different order, or a value sitting exactly on a rounding
tie, hash the same on both sides. Values that are only passed through are
compared as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from .session import prepare

ROUND_DIGITS = 6
NUDGE = 1e-9
# Passed through or picked (first, last, largest, smallest), never computed.
EXACT = {"price", "prev_price", "open", "high", "low", "close", "high_24h", "low_24h", "price_at_spike",
         "period_open", "period_high", "period_low", "period_close", "hour_open", "hour_high", "hour_low", "hour_close"}


@dataclass
class QuerySpec:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doubles: list[str] = field(default_factory=list)
    headline: bool = False

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        df = self.build(spark, sf_dir)
        # Zoned timestamps leave as UTC wall-clock NTZ values, so results do
        # not depend on the reading process's local time zone.
        ltz = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
        if ltz:
            df = df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ltz})
        if self.doubles:
            df = df.withColumns({c: F.round(F.col(c) + F.lit(NUDGE), ROUND_DIGITS) for c in self.doubles})
        return df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        if not self.doubles:
            return self.sql
        rep = ", ".join(f"round({c} + {NUDGE}, {ROUND_DIGITS}) AS {c}" for c in self.doubles)
        return f"SELECT * REPLACE ({rep}) FROM (\n{self.sql}\n) AS q"


REGISTRY: dict[str, QuerySpec] = {}


def register(name: str, sql: str | None = None, doubles: list[str] | None = None,
             headline: bool = False):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = QuerySpec(name, fn, sql, [c for c in doubles or [] if c not in EXACT], headline)
        return fn
    return deco
