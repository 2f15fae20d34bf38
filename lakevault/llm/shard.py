"""Proportional stratified interleaving into shards.

Rows are put in a seeded order within their source, the k-th of a source's n rows
gets the fractional rank (k + jitter) / n, and all rows are sorted by it. Every
stretch of that order holds the sources in proportion, so cutting it into equal
counts gives shards that match the corpus mixture.

Both orders are taken without a window over a whole source or table. Hashes and
fractional ranks are spread evenly, so a row's bucket (a slice of their range)
holds about ``bucket_rows`` rows, whatever the sources' sizes; a rank is the sum
of the buckets before (counts, one row per bucket) and the place in the bucket.
A source holding a third of all rows is spread over a third of the buckets, and
a row that repeats any number of times is spread too, since each copy has a
number of its own in the seeded hash. The hash is of id, checksum, size and that number,
so the same rows get the same shards from whatever files they are read. The jitter, from the source's name, keeps a great
many one-row sources from sharing one rank.

Defined cases: a null text has the size of an empty one; a null source is a
source of its own; repeated rows are placed each on its own; extra columns pass
through, and result columns replace input columns of the same name; an empty
table gives no rows. The order of equal hashes follows id and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakevault.llm.common import require, stored

ROW_BYTES = 16
COPIES = 8192  # equal rows that are numbered at a time


def _running_start(counts: DataFrame, by: list[str], order: str) -> DataFrame:
    """Adds ``_before``: the rows in earlier buckets. One row per bucket comes in."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))


def _unit(*cols: Column) -> Column:
    """A hash of the columns in [0, 1)."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 53)) / F.lit(float(1 << 53))


def interleave(
    rows: DataFrame,
    *,
    shards: int,
    source_col: str = "source",
    id_col: str = "doc_id",
    row_col: str = "_row",
    seed: int = 17,
    bucket_rows: int = 8192,
) -> DataFrame:
    """``rows`` (written, with a row id) plus long ``_place``, int ``shard`` and long ``slot``.

    Shard counts differ by one row at most.
    """
    total = rows.count()
    buckets = max(1, -(-total // bucket_rows))
    seeded = rows.withColumn("_u", _unit(F.lit(seed), F.col(id_col), F.col(row_col)))
    seeded = seeded.withColumn("_b", F.floor(F.col("_u") * buckets).cast("long"))

    # rank within the source: rows in the source's earlier buckets + place in the bucket
    counts = seeded.groupBy(source_col, "_b").agg(F.count(F.lit(1)).alias("_n"))
    starts = _running_start(counts, [source_col], "_b").withColumn(
        "_of", F.sum("_n").over(Window.partitionBy(source_col))
    )
    starts = starts.select(F.col(source_col).alias("_s"), F.col("_b").alias("_sb"), "_before", "_of")
    in_bucket = Window.partitionBy(source_col, "_b").orderBy("_u", id_col, row_col)
    ranked = seeded.withColumn("_k", F.row_number().over(in_bucket) - 1)
    ranked = ranked.join(starts, ranked[source_col].eqNullSafe(starts["_s"]) & (ranked["_b"] == starts["_sb"]))
    jitter = _unit(F.lit(seed + 1), F.coalesce(F.col(source_col).cast("string"), F.lit("")))
    fraction = (F.col("_before") + F.col("_k") + jitter) / F.col("_of")
    ranked = ranked.withColumn("_f", fraction).drop("_s", "_sb", "_before", "_of", "_k", "_b")

    # place in the whole order, in the same way
    placed = ranked.withColumn("_b", F.least(F.floor(F.col("_f") * buckets), F.lit(buckets - 1)).cast("long"))
    counts = placed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    starts = _running_start(counts, [], "_b").select(F.col("_b").alias("_sb"), "_before")
    in_bucket = Window.partitionBy("_b").orderBy("_f", source_col, "_u", id_col, row_col)
    placed = placed.withColumn("_k", F.row_number().over(in_bucket) - 1)
    placed = placed.join(starts, placed["_b"] == starts["_sb"])
    place = F.col("_before") + F.col("_k")
    placed = placed.withColumn("_place", place)
    placed = placed.withColumn("shard", F.expr(f"cast(_place * {shards}L div {max(total, 1)}L as int)"))
    # first place of shard s: the least p with p * shards div total = s
    first = F.expr(f"(cast(shard as bigint) * {total}L + {shards - 1}L) div {shards}L")
    return placed.withColumn("slot", F.col("_place") - first).drop("_u", "_f", "_b", "_sb", "_before", "_k")


def shard_documents(
    docs: DataFrame,
    *,
    shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 17,
    bucket_rows: int = 8192,
) -> DataFrame:
    """One narrow row per document: id, source, size, text_crc32, shard and slot.

    Texts are read once, for their size and checksum, and are not shuffled.
    """
    require(docs, id_col, text_col, source_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col), F.col(source_col),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    # equal rows are counted and then told apart by a number, so nothing hangs on where a row was stored
    equal = narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias("_n"))
    some = equal.withColumn("_part", F.explode(F.sequence(F.lit(0), F.expr(f"(_n - 1) div {COPIES}"))))
    each = some.withColumn("_copy", F.explode(F.sequence(F.col("_part") * COPIES, F.least(F.col("_n"), (F.col("_part") + 1) * COPIES) - 1)))
    rows = stored(each.select(*narrow.columns, F.xxhash64("text_crc32", "size", "_copy").alias("_row")), "shard")
    return interleave(rows, shards=shards, source_col=source_col, id_col=id_col, seed=seed, bucket_rows=bucket_rows)


def op6_shards(docs: DataFrame) -> DataFrame:
    """The registered query: law ``rows``, 40 shards."""
    placed = shard_documents(docs, shards=40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )
