"""Append-only landing zone partitioned by ingest (or event) day."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def land_partitioned(df: DataFrame, path: str, ts_col: str, mode: str = "append") -> None:
    """Write with year/month/day partition columns derived from ``ts_col``.

    A ``REBALANCE`` hint on the partition columns clusters rows by day so
    each task writes few day folders, and lets adaptive execution split a
    hot day over several tasks (a plain ``repartition`` by day would write
    a day holding a third of the data from one task).
    """
    out = df.withColumns(
        {
            "year": F.year(ts_col).cast("int"),
            "month": F.month(ts_col).cast("int"),
            "day": F.dayofmonth(ts_col).cast("int"),
        }
    )
    out = out.hint("rebalance", "year", "month", "day")
    out.write.mode(mode).partitionBy("year", "month", "day").parquet(path)


def read_day(spark: SparkSession, path: str, day: _dt.date, schema: T.StructType | None = None) -> DataFrame:
    """One day of the landing zone; the filter prunes partitions (folders)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    return df.where((F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day))
