"""Connected components of a distributed edge list.

Alternating large-star / small-star rounds (every node hooks its neighbours to
the smallest one it sees). Each round is two aggregations with partial
combine plus two equi-joins, its result is written to the shared folder, and
the edge list never leaves the executors. A hub node is one hot join key, on an
inner sort-merge join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _state(df: DataFrame) -> tuple:
    r = df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of an edge with the smallest node it reaches.

    Self-loops, repeated edges and null ends are ignored; no edges gives no rows.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("u <> v").distinct())
    e = materialise(e, "cc")
    before = _state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        large = materialise(large, "cc")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = materialise(small, "cc")
        after = _state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
