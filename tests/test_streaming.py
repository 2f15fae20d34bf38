import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakevault.operators.vault import hub_rows
from lakevault.sources.versioned import VersionedTable
from lakevault.streaming import ingest as streams

SCHEMA = "event_id long, ts timestamp_ntz, user_id long"


def _land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_late_row_is_dropped_and_counted(spark, tmp_root):
    src, out, ck = f"{tmp_root}/in", f"{tmp_root}/out", f"{tmp_root}/ck"
    schema = spark.createDataFrame([], SCHEMA).schema
    _land(spark, src, [(1, dt.datetime(2024, 1, 10), 1), (1, dt.datetime(2024, 1, 10), 1)])
    streams.stream_dedupe_within(spark, src, schema, out, ck, "event_id", "ts", delay="1 day")
    _land(spark, src, [(2, dt.datetime(2024, 1, 1), 2), (3, dt.datetime(2024, 1, 11), 3), (1, dt.datetime(2024, 1, 10), 1)])
    report = streams.stream_dedupe_within(spark, src, schema, out, ck, "event_id", "ts", delay="1 day")
    got = sorted(r.event_id for r in spark.read.schema(schema).parquet(out).collect())
    assert got == [1, 3]
    dropped = 0
    for p in report["progress"]:
        for op in p.stateOperators:
            dropped += op.numRowsDroppedByWatermark
    assert dropped >= 1


def test_streamed_hub_equals_batch_hub(spark, tmp_root):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = f"{tmp_root}/in"
    ev.repartition(3).write.parquet(src)
    t = VersionedTable(spark, f"{tmp_root}/hub")
    streams.stream_hub_merge(spark, src, ev.schema, t, f"{tmp_root}/ck", "user_id", "2024-02-01", "EVENTS",
                             max_files=1)
    batch, _ = hub_rows(ev, "user_id", "hk", "2024-02-01", "EVENTS")
    streamed = t.read()
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0
    # one load per micro-batch that had new keys, none for the others
    loads = len(t.loads())
    assert 1 <= loads <= 3
    batch.select("user_id").limit(0).count()
    ev.limit(5).write.mode("append").parquet(src)
    streams.stream_hub_merge(spark, src, ev.schema, t, f"{tmp_root}/ck", "user_id", "2024-02-01", "EVENTS", max_files=1)
    assert len(t.loads()) == loads


@pytest.mark.parametrize("max_files", [None, 1, 2])
def test_stream_dedupe_keeps_each_key_whatever_the_batches(spark, tmp_root, max_files):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = f"{tmp_root}/in"
    for _ in range(2):
        ev.repartition(3).write.mode("append").parquet(src)
    streams.stream_dedupe(spark, src, ev.schema, f"{tmp_root}/out", f"{tmp_root}/ck", "event_id", "ts", max_files=max_files)
    got = streams.read_deduped(spark, ev.schema, f"{tmp_root}/out")
    assert got.exceptAll(ev).count() == 0 and ev.exceptAll(got).count() == 0


def test_stream_ingest_copies_every_file_once(spark, tmp_root):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = f"{tmp_root}/in"
    ev.repartition(2).write.parquet(src)
    streams.stream_ingest(spark, src, ev.schema, f"{tmp_root}/out", f"{tmp_root}/ck", max_files=1)
    streams.stream_ingest(spark, src, ev.schema, f"{tmp_root}/out", f"{tmp_root}/ck", max_files=1)  # nothing new
    back = spark.read.schema(ev.schema).parquet(f"{tmp_root}/out")
    assert back.count() == ev.count()
    assert back.agg(F.countDistinct("event_id")).first()[0] == ev.count()


def test_json_files_stream_into_the_table(spark, tmp_root):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = f"{tmp_root}/json"
    from lakevault.sources.formats import write_source

    write_source(ev.repartition(2), "json", src)
    streams.stream_ingest(spark, src, ev.schema, f"{tmp_root}/out", f"{tmp_root}/ck", fmt="json")
    back = spark.read.schema(ev.schema).parquet(f"{tmp_root}/out")
    assert back.exceptAll(ev).count() == 0 and ev.exceptAll(back).count() == 0


def test_a_new_checkpoint_over_a_filled_sink_loses_nothing(spark, tmp_root):
    schema = spark.createDataFrame([], SCHEMA).schema
    day = dt.datetime(2024, 1, 10)
    for n, ids in enumerate((range(10), range(5, 15))):  # five of the second ten are stored already
        _land(spark, f"{tmp_root}/in{n}", [(i, day, i) for i in ids])
        streams.stream_dedupe(spark, f"{tmp_root}/in{n}", schema, f"{tmp_root}/out", f"{tmp_root}/ck{n}", "event_id", "ts")
    got = streams.read_deduped(spark, schema, f"{tmp_root}/out").collect()
    assert sorted(r.event_id for r in got) == list(range(15))
