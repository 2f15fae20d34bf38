"""Bronze layer: ingest stamps, contracts, idempotent re-ingest, de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.functions import bitmaps
from lakevault.functions.casts import literal
from lakevault.functions.keys import tuple_text
from lakevault.operators.history import latest_per_key
from lakevault.operators.vault import ts_literal
from lakevault.session import scratch_path
from lakevault.sources.versioned import VersionedTable


def _cols(names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def stamp_ingest(df: DataFrame, load_ts, column: str = "data_carga") -> DataFrame:
    """Add one load timestamp, identical for every row of the batch."""
    return df.withColumn(column, ts_literal(load_ts))


def contract_split(df: DataFrame, rules: dict[str, Column], types: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) under a contract.

    ``rules`` maps a reason to the condition that marks a violation; a condition that
    is null (its input is missing) is one too. ``types`` maps columns to the types
    they must cast to: a text that does not is rejected as ``type:<column>``, and
    valid rows carry the typed value; a column that is missing fails the call.
    Rejected rows are as they came, with ``reasons``, the names joined by ','.
    """
    types = types or {}
    missing = [c for c in types if c not in df.columns]
    if missing:
        raise ValueError(f"the contract's column(s) {missing} are missing")
    marks = [F.when(F.coalesce(cond, F.lit(True)), F.lit(name)) for name, cond in rules.items()]
    marks += [F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(f"type:{c}")) for c, t in types.items()]
    tagged = df.withColumn("_reasons", F.array_compact(F.array(*marks)))
    valid = tagged.where(F.size("_reasons") == 0).drop("_reasons").withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})
    rejected = tagged.where(F.size("_reasons") > 0).withColumn("reasons", F.concat_ws(",", "_reasons")).drop("_reasons")
    return valid, rejected


def with_checksum(df: DataFrame, columns, name: str = "checksum") -> DataFrame:
    """SHA-256 of the columns' tuple (``tuple_text``: nulls and separators tell tuples apart)."""
    return df.withColumn(name, F.sha2(tuple_text(*_cols(columns)), 256))


def ingest_by_checksum(table: VersionedTable, batch: DataFrame, columns, name: str = "checksum",
                       load_id: str | None = None, bitmap: VersionedTable | None = None) -> str | None:
    """Append only rows whose checksum is not stored yet (re-ingest is a no-op).

    Of rows with the same checksum the least one is kept (a partial aggregate, so
    repeated rows are combined before the shuffle). A batch of repeats leaves no load.

    ``bitmap`` keeps, per load, a set of positions that its checksums hash to. A row whose
    position is in no set is new, without a look at any stored checksum; only the others are
    joined with those. The sets are 4 bytes a row or less, and each lies in the
    partition of its range, where the batch's rows meet it. A load without its set (a failure
    came between) gets it first, and rows that were erased only make a set too large, so
    the result is the same with and without.
    """
    rows = with_checksum(batch, columns, name)
    if not table.exists():
        return table.write(_least_per(rows, name), mode="errorifexists", load_id=load_id)
    if bitmap is None:
        fresh = _least_per(rows, name).join(table.read().select(name), name, "left_anti")
        return table.write(fresh, mode="append", load_id=load_id, keep_empty=False)
    _add_bitmaps(table, bitmap, name)
    sums = _kept(_maybe_stored(rows.select(name).distinct(), bitmap, name), "checksums_asked")
    new, maybe = sums.where("NOT _maybe").select(name), sums.where("_maybe").select(name)
    if not maybe.isEmpty():
        new = new.unionByName(maybe.join(table.read().select(name), name, "left_anti"))
    # the rows themselves are looked at, and combined, for new checksums only
    fresh = _least_per(rows.join(new, name, "left_semi"), name).select(*rows.columns)
    written = table.write(fresh, mode="append", load_id=load_id, keep_empty=False)
    if written:
        _add_bitmap(table, bitmap, name, written, table.last_num_rows)
    return written


def _least_per(rows: DataFrame, name: str) -> DataFrame:
    """The least row of each checksum."""
    others = [c for c in rows.columns if c != name]
    least = F.min(F.struct(*[F.col(c) for c in others])).alias("_row")
    return rows.groupBy(name).agg(least).select(*[F.col(f"_row.{c}").alias(c) for c in others], name)


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to a scratch table and read from it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: bits of a set per row of its load, at least: 1 row in 32 that is new looks stored
BITS_PER_ROW = 32


def _position(name: str, bits: Column) -> Column:
    return F.pmod(F.xxhash64(name), bits) + 1


def _add_bitmaps(table: VersionedTable, bitmap: VersionedTable, name: str) -> None:
    """The sets of loads that have none yet."""
    for load in table.loads():
        if bitmap.find_load(load) is None:
            _add_bitmap(table, bitmap, name, load, table.read_load(load).count())


def _add_bitmap(table: VersionedTable, bitmap: VersionedTable, name: str, load: str, count: int) -> None:
    """The set of a load of ``count`` rows; it has a power of four times ``bitmaps.RANGE`` bits."""
    bits = bitmaps.RANGE
    while bits < BITS_PER_ROW * count:
        bits *= 4
    sized = table.read_load(load).select(name, F.lit(bits).cast("long").alias("size"))
    bitmap.write(bitmaps.build(sized, _position(name, F.col("size")), "size"), load_id=load)


def _maybe_stored(rows: DataFrame, bitmap: VersionedTable, name: str) -> DataFrame:
    """``rows`` with ``_maybe``: whether the position of a row's checksum is in a set of any size."""
    sets = bitmaps.merge(bitmap.read(), "size")
    hit = F.lit(False)
    for r in bitmap.read().select("size").distinct().collect():  # a few powers of four
        place = _position(name, F.lit(r["size"]))
        mine = sets.where(F.col("size") == r["size"]).select(F.col(bitmaps.BUCKET).alias(f"_b{r['size']}"), F.col(bitmaps.BITS).alias(f"_s{r['size']}"))
        rows = rows.join(mine, F.bitmap_bucket_number(place) == F.col(f"_b{r['size']}"), "left")
        hit = hit | bitmaps.holds(F.col(f"_s{r['size']}"), place)
    kept = [c for c in rows.columns if not c.startswith(("_b", "_s")) or not c[2:].isdigit()]
    return rows.select(*kept, hit.alias("_maybe"))


def newer_than_stored(table: VersionedTable, batch: DataFrame, ts_col: str) -> tuple[DataFrame, DataFrame]:
    """(new, held back): rows strictly newer than the stored maximum of ``ts_col``, and all others.

    Rows equal to the maximum, late ones and those without a time are held back, not
    lost: they need the checksum or key rule. The maximum is a scalar subquery.
    """
    if not table.exists():
        return batch.where(F.col(ts_col).isNotNull()), batch.where(F.col(ts_col).isNull())
    high = table.read().select(F.max(ts_col)).scalar()  # lazy; null for an empty table: then every dated row is new
    new = F.coalesce(F.col(ts_col) > high, high.isNull() & F.col(ts_col).isNotNull(), F.lit(False))
    return batch.where(new), batch.where(~new)


def ingest_newer(table: VersionedTable, batch: DataFrame, ts_col: str, load_id: str | None = None) -> DataFrame:
    """Append the rows newer than the stored maximum; returns the rows held back.

    Running it again with the same batch appends nothing. A retry with the ``load_id`` of a
    load that is complete holds the batch against the loads before that one, so it returns
    what the first run did.
    """
    done = table.find_load(load_id) if table.exists() else None
    stored = table.read_before(done) if done else table.read() if table.exists() else None
    before = stored.agg(F.max(ts_col)).first()[0] if stored is not None else None
    ts = F.col(ts_col)
    held = ts.isNull() if before is None else ts.isNull() | (ts <= literal(before, batch.schema[ts_col].dataType))
    if done is None:
        table.write(batch.where(~held), mode="errorifexists" if stored is None else "append", load_id=load_id)
    return batch.where(held)


def with_ingest_metadata(df: DataFrame, record_source: str, source_format: str,
                         file_column: str | None = "source_file") -> DataFrame:
    """Record source, original format and (for file scans) the file each row came from."""
    cols = {"record_source": F.lit(record_source), "source_format": F.lit(source_format)}
    if file_column:
        cols[file_column] = F.col("_metadata.file_path")
    return df.withColumns(cols)


def dedupe_exact(df: DataFrame, columns=None) -> DataFrame:
    """Drop repeated rows (or repeated combinations of ``columns``)."""
    return df.select(*_cols(columns)).distinct() if columns else df.distinct()


def dedupe_latest(df: DataFrame, keys, order) -> DataFrame:
    """Keep the newest row per business key (``order`` ends in a tie-break)."""
    return latest_per_key(df, keys, order)
