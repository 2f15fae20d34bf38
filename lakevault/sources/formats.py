"""One entry point for the formats a landing zone receives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakevault.sources.csv import NULL_TOKEN, ROBUST, TEXT_TIMESTAMPS, write_csv


def read_source(spark: SparkSession, fmt: str, path: str | None = None,
                schema: T.StructType | str | None = None, **options) -> DataFrame:
    """``fmt`` in json / csv / parquet / orc / jdbc. File formats take a path and
    (preferably) a schema; jdbc takes url/dbtable/... options and is read in
    parallel when ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions``
    are given."""
    reader = spark.read
    if schema is not None and fmt != "jdbc":
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.options(**ROBUST).option("nullValue", NULL_TOKEN)
    if fmt == "json":
        reader = reader.option("mode", "FAILFAST")
    reader = reader.options(**options)
    if fmt == "jdbc":
        return reader.format("jdbc").load()
    if fmt in ("json", "csv", "parquet", "orc", "text"):
        return reader.format(fmt).load(path)
    raise ValueError(f"unsupported source format {fmt!r}")


def write_source(df: DataFrame, fmt: str, path: str, mode: str = "overwrite") -> None:
    if fmt == "csv":
        write_csv(df, path, mode, null_token=NULL_TOKEN)
        return
    w = df.write.mode(mode)
    if fmt == "json":
        w = w.options(**TEXT_TIMESTAMPS)
    w.format(fmt).save(path)
