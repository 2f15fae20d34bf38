"""Data Vault loads: hubs, satellites, links, insert-only merges, CDC, point-in-time.

Row builders (``hub_rows``, ``sat_rows``, ``link_rows``, ``hub_multi_source``,
``cdc_apply``, ``sat_as_of``, ``cdc_read_state``) take DataFrames and column
names and return DataFrames. Loaders (``hub_load``, ``insert_new_keys``,
``sat_append_all``, ``sat_append_changed``, ``sat_rebuild``,
``cdc_append_changes``, ``cdc_compact``) write a ``VersionedTable`` and return the
load's name (``hub_load`` returns the rejected rows, ``sat_append_changed`` the
late ones). One load stamp (``load_ts``) is
passed to a whole batch, so hub and satellite rows of one run carry the same
load date.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakevault.functions.keys import hash_key, link_key
from lakevault.operators.history import changed_rows, in_ranges, latest_per_key, with_carried, with_neighbors
from lakevault.session import scratch_path
from lakevault.sources.bucketed import BucketedTable
from lakevault.sources.versioned import VersionedTable


def _cols(names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def ts_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal (UTC) from ``datetime`` or ``'YYYY-MM-DD[ HH:MM:SS]'`` text."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(_dt.timezone.utc)
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp_ntz(F.lit(str(value)))


# --------------------------------------------------------------------------- hubs
def hub_rows(
    df: DataFrame,
    business_key: str,
    hk: str = "hk",
    load_ts=None,
    record_source: str | None = None,
    algo: str = "md5",
) -> tuple[DataFrame, DataFrame]:
    """(hub, rejects): one row per business key; rows with a null key are rejected.

    Distinct keys are found first (partial aggregation pre-combines every
    key, hot or not, on the map side); the hash is computed once per key.
    """
    valid = df.where(F.col(business_key).isNotNull())
    rejects = df.where(F.col(business_key).isNull())
    hub = valid.select(business_key).distinct().select(hash_key(business_key, algo).alias(hk), business_key)
    extra = {}
    if load_ts is not None:
        extra["load_date"] = ts_literal(load_ts)
    if record_source is not None:
        extra["record_source"] = F.lit(record_source)
    return hub.withColumns(extra), rejects


def insert_new_keys(table: VersionedTable | BucketedTable, rows: DataFrame, keys, prefilter: bool = False,
                    load_id: str | None = None) -> str | None:
    """Insert-only merge: append the rows whose business ``keys`` the table does not hold yet.

    ``rows`` must be distinct on ``keys`` (``hub_rows`` and ``link_rows`` are). The
    anti join runs on the same keys as their ``distinct``, whose partitioning it
    reuses: the batch is shuffled once. The first load creates the table; a batch
    without new keys leaves no load and returns None.

    A ``BucketedTable`` on the same keys meets the batch bucket by bucket: the batch is dealt
    to its buckets and the stored keys are neither shuffled nor broadcast.

    ``prefilter`` is for small batches against a large table: the stored keys are
    first cut to those of the batch by a semi join, which Catalyst or AQE may run as
    a broadcast of the batch's keys (a size-checked decision); then the stored
    keys are scanned but not shuffled.
    """
    keys = _cols(keys)
    if not table.exists():
        return table.write(rows, mode="errorifexists", load_id=load_id)
    known = table.read().select(*keys)
    if prefilter:
        known = known.join(rows.select(*keys), keys, "left_semi")
    fresh = table.aligned(rows).join(known, keys, "left_anti")
    return table.write(fresh, mode="append", load_id=load_id, keep_empty=False)


def hub_load(table: VersionedTable | BucketedTable, batch: DataFrame, business_key: str, load_ts, record_source: str,
             hk: str = "hk", algo: str = "md5", load_id: str | None = None) -> DataFrame:
    """Build hub rows for a batch and merge them insert-only; returns the rejects."""
    hub, rejects = hub_rows(batch, business_key, hk, load_ts, record_source, algo)
    insert_new_keys(table, hub, business_key, load_id=load_id)
    return rejects


def hub_multi_source(sources: list[tuple[DataFrame, str, str]], key_name: str = "k", hk: str = "hk") -> DataFrame:
    """One hub from several systems: ``sources`` holds (df, key column, source name).

    A key seen by several systems keeps the smallest source name.
    """
    parts = [df.select(F.col(col).alias(key_name), F.lit(name).alias("record_source")) for df, col, name in sources]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    keyed = union.where(F.col(key_name).isNotNull()).groupBy(key_name).agg(F.min("record_source").alias("record_source"))
    return keyed.select(hash_key(key_name).alias(hk), key_name, "record_source")


# --------------------------------------------------------------------------- links
def link_rows(df: DataFrame, business_keys, hk: str = "hk_link") -> tuple[DataFrame, DataFrame]:
    """(links, rejects): distinct key combinations with their hash; rows with a null key are rejected."""
    keys = _cols(business_keys)
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    pairs = df.where(~missing).select(*keys).distinct()
    return pairs.select(link_key(*keys).alias(hk), *keys), df.where(missing)


# --------------------------------------------------------------------------- satellites
def sat_rows(df: DataFrame, business_key: str, attributes, load_date_col: str | None = None,
             load_ts=None, hk: str = "hk", record_source: str | None = None,
             algo: str = "md5") -> DataFrame:
    """Satellite rows: hash key, load date, attributes (no de-duplication).

    The load date is a column of the batch (``load_date_col``) or one stamp
    for the whole batch (``load_ts``).
    """
    if load_date_col is not None:
        load_date = F.col(load_date_col)
    else:
        load_date = ts_literal(load_ts if load_ts is not None else _dt.datetime.now(_dt.timezone.utc))
    cols = [hash_key(business_key, algo).alias(hk), load_date.alias("load_date")]
    cols += [F.col(a) for a in _cols(attributes)]
    if record_source is not None:
        cols.append(F.lit(record_source).alias("record_source"))
    return df.where(F.col(business_key).isNotNull()).select(*cols)


def sat_append_all(table: VersionedTable, rows: DataFrame, load_id: str | None = None) -> str:
    """Append every row of the batch (re-loading a batch doubles it, unless the
    retry carries the same ``load_id``)."""
    return table.write(rows, mode="append", load_id=load_id)


def sat_append_changed(table: VersionedTable, rows: DataFrame, hk: str, order, compare,
                       chunk: Column | None = None, seen: VersionedTable | None = None,
                       load_id: str | None = None) -> DataFrame:
    """Append the versions that differ from their predecessor; returns the late rows.

    A batch row's predecessor is the previous row of its key in the batch or, for
    the first, the key's latest stored row, an aggregate that meets one row per key and
    range of the batch. The batch is range-dealt and written once for all of this.

    A row is late if its key has been seen up to that order or beyond. ``seen`` keeps
    how far (a row per key and load), as unchanged rows are not stored; without it the
    latest stored row stands for it, which is right if batches come in order. A late
    row cannot be judged without the rows that were not stored: if it equals the
    version in force it is dropped (a batch sent again), else it is returned, for
    ``sat_rebuild`` from the full history. A row of the order of a stored one that holds other
    values, a correction, is late too. With a ``load_id`` a retry writes nothing twice.
    """
    order, compare = _cols(order), _cols(compare)
    at, columns = F.struct(*[F.col(c) for c in order]), rows.columns
    if chunk is None:  # dealt by ranges and written once, for all that follows
        rows, chunk = in_ranges(rows, [hk], order), F.col("_chunk")
    touched = rows.groupBy(hk).agg(F.min(at).alias("_lo"), F.max(at).alias("_hi"))
    late = rows.select(*columns).limit(0)
    if not table.exists():
        table.write(changed_rows(rows, [hk], order, compare, chunk).select(*columns), mode="errorifexists", load_id=load_id)
        if seen is not None:
            seen.write(_reached(touched, hk, order), load_id=load_id)
        return late
    stored = table.read().join(touched.select(hk), hk, "left_semi")
    latest = latest_per_key(stored, [hk], order).select(hk, at.alias("_at"), F.struct(*compare).alias("_cmp"))
    state = touched.join(latest, hk, "left")
    if seen is not None and seen.exists():
        high = seen.read().join(touched.select(hk), hk, "left_semi").groupBy(hk).agg(F.max(at).alias("_high"))
        state = state.join(high, hk, "left")
    else:
        state = state.withColumn("_high", F.col("_at"))
    state = _kept(state, "sat_state")
    newer, known = rows, state.where(F.col("_at").isNotNull()).select(hk, "_cmp.*")
    behind = state.where(F.col("_lo") <= F.col("_high")).select(hk, "_high")
    if not behind.isEmpty():
        judged = rows.join(behind, hk, "left")
        newer = judged.where(F.col("_high").isNull() | (at > F.col("_high"))).drop("_high")
        older = judged.where(at <= F.col("_high")).select(*columns)
        # those that differ from the version in force, the last stored one up to them; a stored row
        # comes before those of its order, so that a correction is held against it
        both = stored.join(behind.select(hk), hk, "left_semi").select(*columns, F.lit(0).alias("_later"))
        past = changed_rows(both.unionByName(older.withColumn("_later", F.lit(1))), [hk], [*order, "_later"], compare)
        of = stored.select(*[F.col(c).alias(f"_of_{c}") for c in [hk, *order, *compare]])
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [hk, *order, *compare]])
        # judged, and written, before the batch is added
        late = _kept(past.where("_later = 1").select(*columns).join(of, same, "left_anti"), "late")
    fresh = changed_rows(newer, [hk], order, compare, chunk, first=known)
    table.write(fresh.select(*columns), mode="append", load_id=load_id)
    if seen is not None:
        seen.write(_reached(state, hk, order), load_id=load_id)
        if len(seen.loads()) > SEEN_LOADS:
            seen.write(seen.read().groupBy(hk).agg(F.max(at).alias("_hi")).select(hk, "_hi.*"), mode="overwrite")
    return late


#: loads of a ``seen`` table before they are folded into one row per key
SEEN_LOADS = 64


def _reached(keys: DataFrame, hk: str, order: list[str]) -> DataFrame:
    """How far each key of a batch has been seen."""
    return keys.select(hk, *[F.col(f"_hi.{c}").alias(c) for c in order])


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to a scratch table and read from it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sat_rebuild(table: VersionedTable, history: DataFrame, keys: DataFrame, hk: str, order, compare,
                chunk: Column | None = None) -> str:
    """Store the changed versions of ``keys`` anew from their full ``history``; other keys keep theirs."""
    keys = keys.select(hk).distinct()
    redone = changed_rows(history.join(keys, hk, "left_semi"), [hk], _cols(order), _cols(compare), chunk)
    kept = table.read().join(keys, hk, "left_anti")
    return table.write(kept.unionByName(redone.select(*kept.columns)), mode="overwrite", rebalance=True)


def sat_as_of(sat: DataFrame, hk: str, ts_col: str, as_of, order) -> DataFrame:
    """State of every key at time ``as_of``: its latest row with ``ts_col <= as_of``."""
    return latest_per_key(sat.where(F.col(ts_col) <= ts_literal(as_of)), [hk], _cols(order))


def point_in_time(versions: DataFrame, dates: DataFrame, key: str, ts_col: str, order, date_col: str) -> DataFrame:
    """For every date and every key that has a version by then: the version in force at the end of that instant.

    ``order`` begins with ``ts_col`` and ends in a tie-break. Each version is first placed on the
    calendar: versions and dates are sorted together in measured ranges, and the number of the
    last date before is carried to the versions (an as-of join). The next version of the key
    tells where its span of dates ends, and only dates within the span are made, so
    the rows made are the rows returned. Dates are numbered over the distinct ones,
    one row each.
    """
    order = _cols(order)
    calendar = dates.select(F.col(date_col)).where(F.col(date_col).isNotNull()).distinct()
    calendar = calendar.select(date_col, F.row_number().over(Window.orderBy(date_col)).alias("_n"))
    rows = versions.where(F.col(ts_col).isNotNull())
    row = F.struct(*[F.col(c) for c in versions.columns])
    asks = rows.select(F.col(ts_col).alias("_t"), F.lit(0).alias("_kind"), row.alias("_row"), F.lit(None).cast("int").alias("_n"))
    marks = calendar.select(F.col(date_col).cast(versions.schema[ts_col].dataType).alias("_t"), F.lit(1).alias("_kind"),
                            F.lit(None).cast(asks.schema["_row"].dataType).alias("_row"), "_n")
    placed = with_carried(asks.unionByName(marks), [], ["_t", "_kind"], "_past", F.col("_n")).where("_kind = 0")
    placed = placed.select("_row.*", (F.coalesce("_past", F.lit(0)) + 1).alias("_from"))
    spans = with_neighbors(placed, [key], order, nxt={"_to": "_from"})
    last = calendar.select(F.max("_n")).scalar()
    made = spans.where(F.col("_from") < F.coalesce("_to", last + 1))
    made = made.withColumn("_n", F.explode(F.sequence("_from", F.coalesce("_to", last + 1) - 1)))
    return made.join(calendar, "_n").select(*versions.columns, date_col)


# --------------------------------------------------------------------------- CDC
def cdc_apply(state: DataFrame | None, changes: DataFrame, keys, order, is_delete: Column) -> DataFrame:
    """The state after a batch of changes: the latest change per key, stored or new, by ``order``.

    The state keeps the order columns and a ``_deleted`` row for a deleted key, so
    batches may come in any order, and again: an older change never replaces a newer
    one, and a deleted key does not come back. ``cdc_live`` leaves deleted keys out.
    """
    tagged = changes.withColumn("_deleted", F.coalesce(is_delete, F.lit(False)))
    if state is not None:
        tagged = state.unionByName(tagged.select(*state.columns))
    return latest_per_key(tagged, _cols(keys), _cols(order))


def cdc_live(state: DataFrame) -> DataFrame:
    """The rows of a CDC state that are not deleted."""
    return state.where(~F.col("_deleted")).drop("_deleted")


def cdc_append_changes(table: VersionedTable, changes: DataFrame, keys, order, is_delete: Column,
                       load_id: str | None = None) -> str:
    """Merge-on-read CDC, write side: append only the batch's latest change per key.

    The write is as large as the batch, not as the state (``cdc_apply`` with an
    overwrite writes the whole state)."""
    return table.write(cdc_apply(None, changes, keys, order, is_delete), mode="append", load_id=load_id)


def cdc_read_state(table: VersionedTable, keys, order) -> DataFrame:
    """Merge-on-read CDC, read side: latest stored change per key, deleted keys left out."""
    return cdc_live(latest_per_key(table.read(), _cols(keys), _cols(order)))


def cdc_compact(table: VersionedTable, keys, order) -> str:
    """Fold the appended changes into one snapshot, a row per key (deleted ones too, so that
    an older change arriving later stays without effect)."""
    return table.write(latest_per_key(table.read(), _cols(keys), _cols(order)), mode="overwrite", rebalance=True)
