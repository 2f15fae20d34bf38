"""Declarative table tests and load monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def not_null_failures(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row: for each output name, the number of rows where the column is null."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(name) for name, c in columns.items()])


def unique_failures(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def min_value_failures(df: DataFrame, column: str, minimum, keep: list[str]) -> DataFrame:
    """Rows whose value is below ``minimum`` (nulls are not failures)."""
    return df.where(F.col(column) < minimum).select(*keep, column)


def load_anomalies(counts: DataFrame, by: list[str], day: str, n: str, window: int = 7,
                   sigmas: float = 3.0) -> DataFrame:
    """Flag days whose count is more than ``sigmas`` sample deviations from the
    mean of the previous ``window`` days (all ``window`` days required).

    ``counts`` holds one row per (``by``, day), so each window partition is a
    calendar, not raw data.
    """
    w = Window.partitionBy(*by).orderBy(day).rowsBetween(-window, -1)
    k, m, s = F.count(F.lit(1)).over(w), F.avg(n).over(w), F.stddev_samp(n).over(w)
    flag = F.coalesce((k == window) & (F.abs(F.col(n) - m) > sigmas * s), F.lit(False))
    return counts.withColumn("anomalo", flag)
