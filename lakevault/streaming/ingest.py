"""Structured Streaming versions of the ingest and vault loads.

All three run as ``trigger(availableNow=True)`` jobs over a landing folder:
each run takes what has arrived, commits its offsets in the checkpoint and
stops, so a rerun after a failure continues where the last commit left it.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.functions.casts import literal
from lakevault.operators.vault import hub_rows, insert_new_keys
from lakevault.sources.versioned import VersionedTable, folder_exists


def _file_stream(spark: SparkSession, src: str, schema: T.StructType, fmt: str = "parquet",
                 max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(src)


def stream_ingest(spark: SparkSession, src: str, schema: T.StructType, sink: str, checkpoint: str,
                  fmt: str = "parquet", max_files: int | None = None) -> dict:
    """Copy newly arrived files into a Parquet table (exactly once via the
    file sink's own log); returns the last progress report."""
    q = (
        _file_stream(spark, src, schema, fmt, max_files)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q.lastProgress or {}


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint, from its first start on."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def stream_dedupe(spark: SparkSession, src: str, schema: T.StructType, sink: str, checkpoint: str,
                  key: str, event_time: str, fmt: str = "parquet", max_files: int | None = None) -> None:
    """Store each ``key`` once, whatever the micro-batches and the order of arrival.

    The sink is partitioned by day of the event time (a repeated event repeats its
    time), so a micro-batch is compared with the stored keys of its own days only: a
    join on the partition column, pruned at run time. Late rows are stored like
    others. A micro-batch writes its own folder per day (``batch``), so a replay
    after a failure replaces it. There is no streaming state and nothing is dropped.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        mine = f"{checkpoint_id(spark, checkpoint)}-{batch_id}"
        rows = batch.withColumn("_day", F.coalesce(F.to_date(event_time), F.lit("0001-01-01").cast("date")))
        others = [c for c in rows.columns if c not in (key, "_day")]
        one = F.min(F.struct(*[F.col(c) for c in others])).alias("_one")
        rows = rows.groupBy("_day", key).agg(one).select("_day", key, *[F.col(f"_one.{c}").alias(c) for c in others])
        if folder_exists(spark, sink):
            stored = read_deduped(spark, schema, sink, keep_parts=True).where(F.col("batch") != mine)
            rows = _not_stored(rows, stored, key)
        (
            rows.withColumn("batch", F.lit(mine))
            .hint("rebalance", "_day")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("_day", "batch")
            .parquet(sink)
        )

    q = (
        _file_stream(spark, src, schema, fmt, max_files)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def _not_stored(rows: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """The rows whose day and key are not stored; a null key is a key like any other."""
    known = stored.select(F.col("_day").alias("_of_day"), F.col(key).alias("_of_key"))
    return rows.join(known, (F.col("_day") == F.col("_of_day")) & F.col(key).eqNullSafe(F.col("_of_key")), "left_anti")


def read_deduped(spark: SparkSession, schema: T.StructType, sink: str, keep_parts: bool = False) -> DataFrame:
    """The rows ``stream_dedupe`` has stored."""
    parts = [T.StructField("_day", T.DateType()), T.StructField("batch", T.StringType())]
    df = spark.read.schema(T.StructType([*schema.fields, *parts])).parquet(sink)
    return df if keep_parts else df.select(*schema.names)


SIDES = ("kept", "late", "counts")
#: rows that a task of ``stream_dedupe_accounted`` sorts; a row and its struct take about 1 KB there
ROWS_PER_TASK = 200_000


def stream_dedupe_accounted(spark: SparkSession, src: str, schema: T.StructType, sink: str, checkpoint: str, key: str,
                            event_time: str, delay: str, fmt: str = "parquet", max_files: int | None = None) -> None:
    """``stream_dedupe`` that also keeps late rows apart and accounts for every row offered.

    A row is late if its time lies more than ``delay`` (an interval text) before the greatest time
    in the files that landed before its own, in this run or any earlier one. So the watermark
    moves from file to file, not from micro-batch to micro-batch, and which rows are late does not
    depend on how many files a micro-batch takes. Late rows go to a side table. Of the others
    each key is kept once, its first in order of landing; the rest are repeats. For every
    micro-batch kept + late + repeated = offered.

    The state between micro-batches is in the sinks: the kept keys of the days that a micro-batch
    touches, and the greatest time so far, a row per micro-batch. All of a micro-batch's rows lie in
    folders named by checkpoint and micro-batch, so a replay replaces them, and a
    new checkpoint over the same sink loses and repeats nothing.

    Micro-batch and kept rows are dealt by day and key to as many tasks as they have
    ``ROWS_PER_TASK`` rows, and a day is written by as many tasks as its own rows ask for, so
    a task's memory grows neither with the files nor with what is kept.
    """
    paths = {s: f"{sink}/{s}" for s in SIDES}
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        mine = f"{checkpoint_id(spark, checkpoint)}-{batch_id}"

        def stored(side: str) -> DataFrame | None:
            if not folder_exists(spark, paths[side]):
                return None
            return _read_side(spark, schema, sink, side).where(F.col("batch") != mine)

        def write(df: DataFrame, side: str, *parts: str) -> None:
            out = df.withColumn("batch", F.lit(mine)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            out.partitionBy(*parts, "batch").parquet(paths[side])

        day = F.coalesce(F.to_date(event_time), F.lit("0001-01-01").cast("date")).alias("_day")
        of_days = batch.groupBy(day).agg(F.count(F.lit(1)).alias("n"), F.max(event_time).alias("top"))
        offered, fullest, seen = of_days.agg(F.sum("n"), F.max("n"), F.max("top")).first()
        landed = F.struct(F.col("_landed"), F.col("_file"))
        files = batch.groupBy("_landed", "_file").agg(F.max(event_time).alias("_top"))  # a row per file
        before = stored("counts")
        reached, held = before.agg(F.max("top"), F.sum("kept")).first() if before is not None else (None, 0)
        tasks = -(-((offered or 0) + (held or 0)) // ROWS_PER_TASK)
        conf = batch.sparkSession.conf  # of the stream's own session
        conf.set("spark.sql.shuffle.partitions", max(tasks, shuffles))
        past = F.max("_top").over(Window.orderBy("_landed", "_file").rowsBetween(Window.unboundedPreceding, -1))
        top = literal(reached, schema[event_time].dataType)
        marks = files.select(F.col("_file").alias("_of"), F.greatest(past, top).alias("_mark"))
        rows = batch.join(marks, F.col("_file") == F.col("_of"), "left").drop("_of")
        late = F.coalesce(F.col(event_time) < F.col("_mark") - F.expr(f"interval {delay}"), F.lit(False))
        write(rows.where(late).select(*schema.names), "late")
        others = [c for c in schema.names if c != key]
        first = F.min_by(F.struct(*others), F.struct(landed, *others)).alias("_one")
        fresh = rows.where(~late).withColumn("_day", day).groupBy("_day", key).agg(first)
        fresh = fresh.select("_day", key, *[F.col(f"_one.{c}").alias(c) for c in others])
        kept = stored("kept")
        if kept is not None:
            fresh = _not_stored(fresh, kept, key)
        share = F.pmod(F.xxhash64(key), F.lit(-(-(fullest or 0) // ROWS_PER_TASK) or 1))
        write(fresh.select(*schema.names, "_day").repartition(F.col("_day"), share), "kept", "_day")
        there = {s: _read_side(spark, schema, sink, s).where(F.col("batch") == mine).count() if folder_exists(spark, paths[s]) else 0
                 for s in ("kept", "late")}
        row = [(offered or 0, there["kept"], there["late"], (offered or 0) - there["kept"] - there["late"], seen)]
        write(spark.createDataFrame(row, _counts_schema(schema, event_time)), "counts")

    stream = _file_stream(spark, src, schema, fmt, max_files)
    stream = stream.select("*", F.col("_metadata.file_modification_time").alias("_landed"), F.col("_metadata.file_path").alias("_file"))
    q = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def _counts_schema(schema: T.StructType, event_time: str) -> T.StructType:
    numbers = [T.StructField(c, T.LongType()) for c in ("offered", "kept", "late", "repeated")]
    return T.StructType([*numbers, T.StructField("top", schema[event_time].dataType)])


def _read_side(spark: SparkSession, schema: T.StructType, sink: str, side: str) -> DataFrame:
    batch, path = T.StructField("batch", T.StringType()), f"{sink}/{side}"
    if side == "counts":
        return spark.read.parquet(path).withColumn("batch", F.col("batch").cast("string"))
    parts = [T.StructField("_day", T.DateType()), batch] if side == "kept" else [batch]
    return spark.read.schema(T.StructType([*schema.fields, *parts])).parquet(path)


def read_accounted(spark: SparkSession, schema: T.StructType, sink: str, side: str) -> DataFrame:
    """The ``kept`` or ``late`` rows of ``stream_dedupe_accounted``, or its ``counts``, a row per micro-batch."""
    if side not in SIDES:
        raise ValueError(f"{side!r} is none of {SIDES}")
    df = _read_side(spark, schema, sink, side)
    return df.drop("batch", "_day")


def stream_ingest_drift(spark: SparkSession, src: str, schema: T.StructType, sink: str, checkpoint: str,
                        max_files: int | None = None) -> None:
    """Copy newly arrived JSON lines into a Parquet table, whatever becomes of their fields.

    The fields of ``schema`` are columns. Fields that it does not know are kept as one VARIANT
    column, ``extra`` (null for none), with their own types, and can be asked for later
    (``try_variant_get``) without a new load. A line that is not a JSON object, or in which a known
    field does not fit its type, keeps its text in ``rescued`` beside what did fit. Nothing fails the
    stream and nothing is lost; blank lines are no rows.
    """
    lines = _file_stream(spark, src, T.StructType([T.StructField("value", T.StringType())]), "text", max_files)
    row = F.try_parse_json("_line")
    known = {f.name: F.try_variant_get("_row", f"$['{f.name}']", f.dataType.simpleString()) for f in schema.fields}
    told = [F.try_variant_get("_row", f"$['{f.name}']", "string").isNotNull() & F.col(f.name).isNull() for f in schema.fields]
    object_ = F.schema_of_variant("_row").startswith("OBJECT")
    fields = F.from_json(F.to_json("_row"), "map<string, variant>")
    extra = F.map_filter(fields, lambda k, _: ~k.isin([f.name for f in schema.fields]))
    out = (
        lines.withColumnRenamed("value", "_line").where(F.trim("_line") != "")
        .withColumn("_row", row)
        .withColumns(known)
        .withColumn("extra", F.when(F.col("_row").isNotNull() & object_, extra))
        .withColumn("extra", F.when(F.size("extra") > 0, F.parse_json(F.to_json("extra"))))
        .withColumn("rescued", F.when(F.col("_row").isNull() | ~object_ | reduce(or_, told), F.col("_line")))
        .drop("_line", "_row")
    )
    q = out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def stream_dedupe_within(spark: SparkSession, src: str, schema: T.StructType, sink: str, checkpoint: str,
                         key: str, event_time: str, delay: str = "1 day", fmt: str = "parquet",
                         max_files: int | None = None) -> dict:
    """Drop repeated ``key`` values within the watermark, with state bounded by ``delay``.

    Rows later than the watermark are dropped by Spark and only counted (in the
    returned progress reports), so use it where the landing order is known to stay
    within ``delay``; ``stream_dedupe`` has no such condition. Watermarks need a
    session-zone TIMESTAMP: a TIMESTAMP_NTZ event time is cast for the stream.
    """
    src_df = _file_stream(spark, src, schema, fmt, max_files)
    ntz = isinstance(schema[event_time].dataType, T.TimestampNTZType)
    wm_col = "_event_time"
    df = src_df.withColumn(wm_col, F.col(event_time).cast("timestamp") if ntz else F.col(event_time))
    out = df.withWatermark(wm_col, delay).dropDuplicatesWithinWatermark([key]).drop(wm_col)
    q = (
        out.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return {"progress": q.recentProgress}


def stream_hub_merge(spark: SparkSession, src: str, schema: T.StructType, table: VersionedTable,
                     checkpoint: str, business_key: str, load_ts, record_source: str,
                     hk: str = "hk", fmt: str = "parquet", max_files: int | None = None) -> None:
    """The batch hub load, applied to each micro-batch through ``foreachBatch``.

    The insert-only merge is idempotent and a micro-batch is a load of its own name,
    so one replayed after a failure adds nothing twice; one without new keys writes
    nothing. Micro-batches are small next to the hub, so the merge pre-filters the
    stored keys to the batch's keys.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        hub, _rejects = hub_rows(batch, business_key, hk, load_ts, record_source)
        insert_new_keys(table, hub, business_key, prefilter=True, load_id=f"{checkpoint}/{batch_id}")

    q = (
        _file_stream(spark, src, schema, fmt, max_files)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
