"""Per-key history: latest version, previous/next row, changed versions.

These sit under satellites, SCD2 dimensions, CDC and dedup, and are built so
one hot key (even a third of all rows) never lands whole in one task:

* ``latest_per_key`` is an aggregate (``max_by`` over an order struct), so
  each map task pre-combines its rows to one per key before the shuffle.
* ``with_neighbors`` windows rows per (key, chunk), a chunk being a measured
  range of equally many rows, or a calendar unit. The first/last row of each
  chunk is then stitched to the neighbouring chunk through a summary of one
  row per (key, chunk).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakevault.session import scratch_path


def _cols(names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def latest_per_key(df: DataFrame, keys, order, ascending: bool = False) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple (least if ``ascending``).

    ``order`` must end in a tie-break column so the choice is deterministic.
    Nulls in an order column rank below any value.
    """
    keys, order = _cols(keys), _cols(order)
    payload = [c for c in df.columns if c not in keys]
    pick = F.min_by if ascending else F.max_by
    best = pick(F.struct(*[F.col(c) for c in payload]), _order_struct(order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in payload])


def in_ranges(df: DataFrame, keys, order) -> DataFrame:
    """``df``, written, with ``_chunk``: the number of its range of (keys, order).

    The ranges come from a sample of the data (range partitioning), so they hold about
    equally many rows however hot a key, a day or an instant is, and a chunk never
    decreases along the order of a key. Writing fixes the ranges for all later reads.
    """
    path = scratch_path(df.sparkSession, "ranges")
    cut = df.repartitionByRange(*_cols(keys), *_cols(order)).withColumn("_chunk", F.spark_partition_id())
    cut.write.parquet(path)
    return df.sparkSession.read.schema(cut.schema).parquet(path)


def with_neighbors(
    df: DataFrame,
    keys,
    order,
    prev: dict | None = None,
    nxt: dict | None = None,
    chunk: Column | None = None,
    first: DataFrame | None = None,
) -> DataFrame:
    """Add the previous (``prev``) / next (``nxt``) row's columns within each key.

    ``first`` holds, by key, the ``prev`` columns of the row before the first one here (a stored
    predecessor); it meets the summary of the chunks only, never the rows.

    ``prev`` / ``nxt`` map an output name to a column name. Windows run per (key,
    chunk), and rows at chunk borders are filled from the neighbouring chunk, so no
    task holds a whole key. ``chunk`` must be non-null and non-decreasing along
    ``order`` inside a key; by default chunks are measured ranges of equally many
    rows (``in_ranges``), which also splits a key that is hot within one day.
    Calendar chunks (``day_chunk``, ``time_chunk``) save the write where no (key, day)
    can be hot. A null key is a key like any other.
    """
    keys, order = _cols(keys), _cols(order)
    prev, nxt = dict(prev or {}), dict(nxt or {})
    columns = df.columns
    if chunk is None:
        df, chunk = in_ranges(df, keys, order), F.col("_chunk")
    d = df.withColumn("_chunk", chunk)
    w = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    d = d.withColumns(
        {
            "_is_first": F.lag(F.lit(1)).over(w).isNull(),
            "_is_last": F.lead(F.lit(1)).over(w).isNull(),
            **{f"_in_{n}": F.lag(c).over(w) for n, c in prev.items()},
            **{f"_in_{n}": F.lead(c).over(w) for n, c in nxt.items()},
        }
    )
    # one row per (key, chunk). Catalyst computes it straight from the input
    # with a partial aggregate, so only (keys x chunks) rows are shuffled; a
    # summary built from the window's output would shuffle every row twice.
    ordk = _order_struct(order)
    aggs = []
    if prev:
        aggs.append(F.max_by(F.struct(*[F.col(c).alias(n) for n, c in prev.items()]), ordk).alias("_last"))
    if nxt:
        aggs.append(F.min_by(F.struct(*[F.col(c).alias(n) for n, c in nxt.items()]), ordk).alias("_first"))
    summary = d.groupBy(*keys, "_chunk").agg(*aggs)
    ws = Window.partitionBy(*keys).orderBy("_chunk")
    border = {}
    if prev:
        border["_before"] = F.lag("_last").over(ws)
    if nxt:
        border["_after"] = F.lead("_first").over(ws)
    summary = summary.select(*keys, "_chunk", *[e.alias(n) for n, e in border.items()])
    if first is not None:
        known = first.select(*[F.col(c).alias(f"_key_{c}") for c in keys], F.struct(*[F.col(n) for n in prev]).alias("_stored"))
        same = F.lit(True)
        for c in keys:
            same = same & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
        summary = summary.join(known, same, "left").withColumn("_before", F.coalesce("_before", "_stored"))
        summary = summary.select(*keys, "_chunk", *border)
    # equi-join on the window's own keys: the big side keeps its partitioning, only
    # the small summary is shuffled
    summary = summary.withColumnsRenamed({c: f"_of_{c}" for c in [*keys, "_chunk"]})
    same = F.lit(True)
    for c in [*keys, "_chunk"]:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    j = d.join(summary, same, "inner")
    filled = {}
    for n in prev:
        filled[n] = F.when(F.col("_is_first"), F.col(f"_before.{n}")).otherwise(F.col(f"_in_{n}"))
    for n in nxt:
        filled[n] = F.when(F.col("_is_last"), F.col(f"_after.{n}")).otherwise(F.col(f"_in_{n}"))
    return j.withColumns(filled).select(*columns, *filled.keys())


def with_carried(df: DataFrame, keys, order, name: str, value: Column, chunk: Column | None = None) -> DataFrame:
    """Add ``name``: the last non-null ``value`` up to each row, along ``order`` within ``keys``.

    An as-of join is this over the union of both sides, with ``value`` null on the side that
    asks; ``order`` then ends in a column that puts the answering side first (or last)
    where both have the same time. With no keys the order is global. Rows are windowed per
    (key, chunk), and a chunk's last value is handed on through a summary of one row per
    (key, chunk), so no task holds a whole key.
    """
    keys, order = _cols(keys), _cols(order)
    columns = df.columns
    df = df.withColumn("_value", value)
    if chunk is None:
        df, chunk = in_ranges(df, keys, order), F.col("_chunk")
    d = df.withColumn("_chunk", chunk)
    w = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("_inside", F.last("_value", ignorenulls=True).over(w))
    at = F.when(F.col("_value").isNotNull(), _order_struct(order))  # max_by passes over rows whose order is null
    summary = d.groupBy(*keys, "_chunk").agg(F.max_by("_value", at).alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(
        *[F.col(c).alias(f"_of_{c}") for c in [*keys, "_chunk"]], F.last("_last", ignorenulls=True).over(before).alias("_before")
    )
    same = F.lit(True)
    for c in [*keys, "_chunk"]:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return d.join(summary, same, "inner").withColumn(name, F.coalesce("_inside", "_before")).select(*columns, name)


def changed_rows(
    df: DataFrame,
    keys,
    order,
    compare: Sequence[str],
    chunk: Column | None = None,
    keep_chunk: bool = False,
    first: DataFrame | None = None,
) -> DataFrame:
    """Rows whose ``compare`` attributes differ from the previous row of the same key.

    The first row of a key always counts as a change, unless ``first`` (the keys and the
    ``compare`` attributes of stored predecessors) holds one it equals. Attributes are compared
    as one struct with null-safe equality (``("a", null)`` and ``(null, "a")``
    differ, null equals null), so no per-row hash is computed. ``keep_chunk`` leaves the
    ranges' numbers in ``_chunk``, for a next pass over the same order.
    """
    if keep_chunk and chunk is None:
        df, chunk = in_ranges(df, keys, order), F.col("_chunk")
    d = df.withColumns({"_cmp": F.struct(*[F.col(c) for c in compare]), "_one": F.lit(1)})
    if first is not None:
        first = first.select(*_cols(keys), F.struct(*[F.col(c) for c in compare]).alias("_prev_cmp"), F.lit(1).alias("_has_prev"))
    d = with_neighbors(d, keys, order, prev={"_prev_cmp": "_cmp", "_has_prev": "_one"}, chunk=chunk, first=first)
    first = F.col("_has_prev").isNull()
    changed = first | ~F.col("_prev_cmp").eqNullSafe(F.col("_cmp"))
    return d.where(changed).drop("_cmp", "_one", "_prev_cmp", "_has_prev")


def time_chunk(ts_col: str, unit: str = "day") -> Column:
    """Chunk column for ``with_neighbors``: the timestamp truncated to ``unit``
    (``day``, ``hour``, ``minute``...). A finer unit splits a key that is hot
    within one day; the border summary grows to keys x units, still bounded by
    the clock, not by the data. A null time goes to the earliest chunk, which
    is where the window's NULLS FIRST order puts it, so no row is lost.
    """
    earliest = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
    return F.coalesce(F.date_trunc(unit, F.col(ts_col)).cast("timestamp_ntz"), earliest)


def day_chunk(ts_col: str) -> Column:
    """Chunk column for ``with_neighbors``: the calendar day of a timestamp
    (null -> the earliest date, see ``time_chunk``)."""
    return F.coalesce(F.to_date(F.col(ts_col)), F.lit("0001-01-01").cast("date"))
