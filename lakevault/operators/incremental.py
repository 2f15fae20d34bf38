"""Marts kept by what has changed: signed sums per load, and distinct counts from slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.functions import bitmaps
from lakevault.operators.marts import MONEY
from lakevault.sources.versioned import VersionedTable


class SummedMart:
    """Counts and sums by group over a table kept load by load (counting method).

    Every load of the source is read once: its rows are counted and summed by group, and
    these sums are appended as a load of the mart. An erasure appends the same sums of the
    rows that go, negated. Reading adds up; a group whose count is 0 is gone. Sums are
    decimal, so that what is taken away is exactly what was added. Which loads the mart holds
    stands in its own rows (``_of``), so ``compact`` forgets none.

    ``by`` maps output columns to expressions over the source's rows, ``sums`` likewise.
    """

    def __init__(self, spark: SparkSession, path: str, by: dict[str, Column], sums: dict[str, Column]):
        self.spark, self.table, self.by, self.sums = spark, VersionedTable(spark, path), by, sums

    def _sums(self, rows: DataFrame, sign: int, of: str) -> DataFrame:
        keyed = rows.select(*[e.alias(k) for k, e in self.by.items()], *[e.cast(MONEY).alias(k) for k, e in self.sums.items()])
        totals = [(F.coalesce(F.sum(k), F.lit(0)) * sign).cast("decimal(38,2)").alias(k) for k in self.sums]
        sums = keyed.groupBy(*self.by).agg((F.count(F.lit(1)) * sign).alias("n"), *totals).withColumn("_of", F.lit(None).cast("string"))
        name = self.spark.createDataFrame([(of,)], "_of string")  # stays when the load has no rows
        return sums.unionByName(name, allowMissingColumns=True)

    def taken(self) -> set[str]:
        """Names of the source's loads whose rows the mart holds, and of its erasures."""
        if not self.table.exists():
            return set()
        return {r["_of"] for r in self.table.read().where(F.col("_of").isNotNull()).select("_of").distinct().collect()}

    def _add(self, rows: DataFrame, sign: int, of: str) -> None:
        self.table.write(self._sums(rows, sign, of), load_id=of)

    def refresh(self, source: VersionedTable) -> list[str]:
        """Take in the source's loads that the mart does not hold yet; only these are scanned."""
        taken = self.taken()
        new = [name for name in source.loads() if name not in taken]
        for name in new:
            self._add(source.read_load(name), 1, name)
        return new

    def forget(self, source: VersionedTable, subjects: DataFrame, key: str, request: str) -> None:
        """Take the subjects' rows out of the mart, then out of the source.

        ``request`` names the erasure; after a failure call again with the same name, before the
        next refresh. Loads that the mart does not hold yet are only erased.
        """
        taken, of = self.taken(), f"erased {request}"
        if of not in taken:
            held = source.read(with_load=True).where(F.col("load").isin([n for n in source.loads() if n in taken])).drop("load")
            self._add(held.join(subjects.select(key).distinct(), key, "left_semi"), -1, of)
        source.erase(subjects, key)

    def read(self) -> DataFrame:
        rows = self.table.read().where(F.col("_of").isNull())
        totals = [F.sum(k).cast("decimal(38,2)").alias(k) for k in self.sums]
        return rows.groupBy(*self.by).agg(F.sum("n").alias("n"), *totals).where("n != 0")

    def compact(self) -> None:
        """Fold the loads of the mart into one."""
        kept = self.read().withColumn("_of", F.lit(None).cast("string"))
        names = self.table.read().where(F.col("_of").isNotNull()).distinct()
        self.table.write(kept.unionByName(names.select(*kept.columns)), mode="overwrite")


class DistinctMart:
    """Exact distinct counts of a whole-number key per period, from slices that are counted once.

    A slice (``by``, for instance year and month) is a set of keys as bitmaps; a refresh appends the
    sets of the new rows, and a count over any union of slices merges their bitmaps. Rows that
    were already taken in change nothing.
    """

    def __init__(self, spark: SparkSession, path: str, by: dict[str, Column], key: Column):
        self.table, self.by, self.key = VersionedTable(spark, path), by, key

    def add(self, rows: DataFrame, load_id: str | None = None) -> None:
        keyed = rows.select(*[e.alias(k) for k, e in self.by.items()], (self.key + 1).alias("_key"))
        self.table.write(bitmaps.build(keyed, F.col("_key"), *self.by), load_id=load_id)

    def count(self, **period: Column) -> DataFrame:
        """(period, n): different keys per period, an expression over the slice's columns."""
        slices = self.table.read().select(*[e.alias(k) for k, e in period.items()], bitmaps.BUCKET, bitmaps.BITS)
        return bitmaps.count(slices, *period)

    def compact(self) -> None:
        """One set per slice."""
        self.table.write(bitmaps.merge(self.table.read(), *self.by), mode="overwrite")
