"""Gold layer: current-state dimension, SCD2 dimension, top-k reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.operators.history import changed_rows, latest_per_key, with_carried, with_neighbors
from lakevault.session import scratch_path
from lakevault.sources.versioned import folder_exists


def _cols(names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def current_dimension(
    hub: DataFrame,
    sat: DataFrame,
    hk: str,
    order,
    columns: dict[str, Column],
) -> DataFrame:
    """Latest satellite row per hub key joined to its hub (inner: a hub key
    without satellite rows, or the reverse, is not in the dimension).

    ``columns`` maps output names to expressions over the joined row; hub
    columns are reachable as ``key.<name>``, satellite columns as ``state.<name>``.
    """
    latest = latest_per_key(sat, [hk], _cols(order))
    joined = hub.alias("key").join(latest.alias("state"), F.col(f"key.{hk}") == F.col(f"state.{hk}"), "inner")
    return joined.select(*[expr.alias(name) for name, expr in columns.items()])


def scd2(changes: DataFrame, hk: str, order, from_col: str, chunk: Column | None = None) -> DataFrame:
    """Validity intervals from change rows: ``valid_from`` = the row's date,
    ``valid_to`` = the next change's date (null for the current row)."""
    d = with_neighbors(changes, [hk], _cols(order), nxt={"valid_to": from_col}, chunk=chunk)
    return d.withColumns(
        {"valid_from": F.col(from_col), "is_current": F.col("valid_to").isNull()}
    )


def scd2_of(rows: DataFrame, hk: str, order, compare, from_col: str) -> DataFrame:
    """Validity intervals of the versions of ``rows`` that differ from the one before.

    Both passes, the one for changes and the one for ``valid_to``, run over the same measured
    ranges, so the rows are range-sorted once; the changes are written, as the second pass reads
    them twice.
    """
    changes = _kept(changed_rows(rows, [hk], _cols(order), _cols(compare), keep_chunk=True), "scd2_changes")
    return scd2(changes, hk, order, from_col, chunk=F.col("_chunk")).drop("_chunk")


PART = "part"


def scd2_merge(
    spark: SparkSession, path: str, batch: DataFrame, history: DataFrame, hk: str, order, compare, from_col: str, buckets: int = 64
) -> None:
    """Merge a batch into the SCD2 dimension at ``path``; the result is that of ``scd2_of`` over all rows so far.

    The dimension is partitioned by a hash bucket of the key (``part``), and a merge rewrites the
    buckets of the batch's keys only. For a key whose rows all come after what it has seen,
    the batch closes the open interval: that interval's row and the batch's rows are compared,
    earlier intervals are left alone. The open row keeps how far its key has been seen
    (``seen``), as rows without a change leave no other trace. A late row that agrees with the
    version in force at its time changes nothing; one that does not splits an interval, at a
    place that only the rows of the ``history`` tell (the satellite, with or without the
    batch), and so the key's intervals are made anew from it. Merging a batch again has no effect, so
    a merge that failed anywhere is simply run again.
    """
    order, compare = _cols(order), _cols(compare)
    at, names = F.struct(*order), [hk, *order, *compare]
    part = F.pmod(F.xxhash64(hk), F.lit(buckets)).cast("int").alias(PART)
    rows = batch.select(*names)
    if not folder_exists(spark, path):
        _write_scd2(_with_seen(scd2_of(rows, hk, order, compare, from_col), rows.groupBy(hk).agg(F.max(at).alias("seen")), hk), part, path)
        return
    touched = _kept(rows.groupBy(hk).agg(F.min(at).alias("_lo"), F.max(at).alias("_hi")).withColumn(PART, part), "scd2_keys")
    parts = [r[PART] for r in touched.select(PART).distinct().collect()]  # at most ``buckets`` numbers
    here = spark.read.parquet(path).where(F.col(PART).isin(parts))
    mine = here.join(touched.select(hk), hk, "left_semi")
    current = mine.where("is_current")
    reached = touched.join(current.select(hk, "seen"), hk, "left")
    judged = rows.join(reached.select(hk, "seen"), hk, "left")
    late = judged.where(at <= F.col("seen")).drop("seen")
    split = touched.select(hk).limit(0)
    if not reached.where(F.col("_lo") <= F.col("seen")).isEmpty():
        value = F.struct(*compare)
        late_keys = reached.where(F.col("_lo") <= F.col("seen")).select(hk)
        known = mine.join(late_keys, hk, "left_semi").select(*names, F.lit(0).alias("_asks"))
        both = known.unionByName(late.withColumn("_asks", F.lit(1)))
        held = with_carried(both, [hk], [*order, "_asks"], "_force", F.when(F.col("_asks") == 0, value))
        split = _kept(held.where((F.col("_asks") == 1) & ~F.col("_force").eqNullSafe(value)).select(hk).distinct(), "scd2_split")
    closing = current.select(*names).unionByName(judged.where(F.col("seen").isNull() | (at > F.col("seen"))).select(*names))
    redo = history.select(*names).unionByName(rows).join(split, hk, "left_semi")
    made = scd2_of(closing.join(split, hk, "left_anti").unionByName(redo), hk, order, compare, from_col)
    seen = reached.select(hk, F.greatest("seen", "_hi").alias("seen"))
    closed = mine.where("NOT is_current").join(split, hk, "left_anti")
    others = here.join(touched.select(hk), hk, "left_anti")
    made = _with_seen(made, seen, hk).withColumn(PART, part)
    _write_scd2(others.unionByName(closed).unionByName(made.select(*others.columns)), F.col(PART), path)


def read_scd2(spark: SparkSession, path: str) -> DataFrame:
    """The dimension that ``scd2_merge`` keeps."""
    return spark.read.parquet(path).drop("seen", PART)


def _with_seen(intervals: DataFrame, seen: DataFrame, hk: str) -> DataFrame:
    """The intervals, the open ones with how far their key has been seen."""
    joined = intervals.join(seen, hk)
    return joined.withColumn("seen", F.when(F.col("is_current"), F.col("seen")))


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to a scratch table and read from it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _write_scd2(df: DataFrame, part: Column, path: str) -> None:
    out = df.withColumn(PART, part).hint("rebalance", PART)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """The k first rows in ``order`` (planned as TakeOrderedAndProject: each
    task keeps its own k best, only k rows per task reach the final merge)."""
    return df.orderBy(*order).limit(k)
