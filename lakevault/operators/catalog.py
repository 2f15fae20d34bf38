"""Reference data: category catalogues and the calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def catalog_by_category(df: DataFrame, category: str, name: str) -> DataFrame:
    """One row per category holding ``map<category, sorted array<name>>``.

    For reference catalogues (a source list, nations by region), whose size is
    fixed by the catalogue, not by the data: each category's list is collected
    in its own group, never into one global row. Do not use it to fold a data
    table into lists; keep such data as rows.
    """
    lists = df.groupBy(category).agg(F.array_sort(F.collect_list(name)).alias("_names"))
    return lists.select(F.create_map(F.col(category), F.col("_names")).alias("catalogo"))


def flatten_catalog(catalog: DataFrame, column: str = "catalogo") -> DataFrame:
    """``map<category, array<name>>`` rows -> (categoria, nome, pos) rows."""
    by_cat = catalog.select(F.explode(column).alias("categoria", "_names"))
    return by_cat.select("categoria", F.posexplode("_names").alias("pos", "nome")).select(
        "categoria", "nome", F.col("pos").cast("int").alias("pos")
    )


def calendar(df: DataFrame, ts_col: str) -> DataFrame:
    """One row per day from the first to the last date of ``ts_col``, with parts.

    The span comes from a global min/max (partial aggregation); the day list
    is as long as the calendar, not the data.
    """
    bounds = df.agg(F.min(F.to_date(ts_col)).alias("lo"), F.max(F.to_date(ts_col)).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(
        "d",
        F.year("d").cast("int").alias("y"),
        F.month("d").cast("int").alias("m"),
        F.quarter("d").cast("int").alias("q"),
    )
