"""CSV at the edges of the lake.

The robust dialect reads what spreadsheet-style writers produce: quotes
doubled inside quoted fields, commas and newlines inside fields. It needs
``multiLine``, which makes each file one split, so land many files rather
than one big one. The writer keeps blanks and writes quotes the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ROBUST = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "mode": "FAILFAST"}

#: what this library's own CSV files hold for null, so that an empty text stays one
NULL_TOKEN = "\\N"

# Text writers keep full microsecond timestamps (their default formats stop at
# milliseconds, which silently truncates); readers parse these ISO forms as is.
TEXT_TIMESTAMPS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def read_csv_robust(spark: SparkSession, path: str, schema: T.StructType | str,
                    null_token: str | None = NULL_TOKEN) -> DataFrame:
    """Header + explicit schema, quoted fields may hold commas, ``""`` and newlines.

    Only ``null_token`` is null and ``""`` is an empty text. For spreadsheet exports,
    which write null and empty text alike, pass ``null_token=None``: an empty field is
    null then.
    """
    reader = spark.read.options(**ROBUST).schema(schema)
    if null_token is not None:
        reader = reader.option("nullValue", null_token)
    return reader.csv(path)


def read_csv_infer(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """Header + type inference (an extra pass over the sample; prefer a schema)."""
    return (
        spark.read.option("header", "true")
        .option("inferSchema", "true")
        .option("samplingRatio", str(sampling_ratio))
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", null_token: str | None = NULL_TOKEN) -> None:
    """Header, doubled quotes, blanks kept; ``null_token`` (e.g. ``\\N``) keeps
    null and empty text apart for readers that use the same token."""
    w = df.write.options(**TEXT_TIMESTAMPS)
    if null_token is not None:
        w = w.option("nullValue", null_token)
    (
        w.mode(mode)
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
