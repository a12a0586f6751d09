"""Tables whose counts and extremes come from Parquet footers.

``count(*)`` and ``max`` of a written layer need no row: every file's footer
has its row count and its columns' extremes. Spark reads them from there when the Parquet reader of
its second data source API is used and aggregate push-down is on; both are settings of a session, so
such tables live in a session of their own beside the caller's (same application, same
executors, same temporary folders). Grouping by the partition column is pushed as well. Only whole
numbers, doubles, booleans and dates have extremes to push: ask for the epoch milliseconds
of a time, not for the timestamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare

#: The first data source API keeps every format but Parquet.
SETTINGS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_table(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet table at ``path``, for counts, minima and maxima (also by partition column)."""
    own = prepare(spark.newSession())
    for name, value in SETTINGS.items():
        own.conf.set(name, value)
    return own.read.parquet(path)
