"""Marts kept by changes, sets as bitmaps, accounted streams, drifting fields, erasure by key."""

import datetime as dt
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.functions import bitmaps
from lakevault.operators import bronze, privacy
from lakevault.operators.incremental import DistinctMart, SummedMart
from lakevault.plans.inspect import plan_text
from lakevault.sources.versioned import VersionedTable
from lakevault.streaming import ingest as streams

SALES = "who long, grp string, amount double"


def _sales(spark, rows):
    return spark.createDataFrame(rows, SALES)


def _mart(spark, root):
    return VersionedTable(spark, f"{root}/sales"), SummedMart(spark, f"{root}/mart", {"grp": F.col("grp")}, {"total": F.col("amount")})


def _totals(df):
    return {r.grp: (r.n, float(r.total)) for r in df.collect()}


def _direct(rows):
    n, total = Counter(), Counter()
    for _, grp, amount in rows:
        n[grp] += 1
        total[grp] += round(100 * (amount or 0))
    return {g: (n[g], total[g] / 100) for g in n}


# ------------------------------------------------------------------ signed sums
def test_signed_sums_equal_a_direct_aggregate(spark, tmp_root):
    dice = random.Random(3)
    t, mart = _mart(spark, tmp_root)
    rows = []
    for step in range(3):
        new = [(dice.randint(0, 9), dice.choice(["a", "b", None, f"only{step}"]), dice.choice([None, 0.1, 2.25, -7.05])) for _ in range(40)]
        t.write(_sales(spark, new))
        rows += new
        mart.refresh(t)
        gone = step + 5
        for _ in range(2):  # asked for twice
            mart.forget(t, spark.createDataFrame([(gone,)], "who long"), "who", f"r{step}")
        rows = [r for r in rows if r[0] != gone]
        assert _totals(mart.read()) == _direct(rows)
    mart.compact()
    assert mart.refresh(t) == [] and _totals(mart.read()) == _direct(rows) and len(mart.table.loads()) == 1
    t.write(_sales(spark, []))
    assert len(mart.refresh(t)) == 1 and mart.refresh(t) == []  # a load without rows is taken in once too


def test_an_erasure_that_failed_half_way_is_finished(spark, tmp_root, monkeypatch):
    t, mart = _mart(spark, tmp_root)
    t.write(_sales(spark, [(1, "a", 1.0), (2, "a", 2.0)]))
    mart.refresh(t)
    asked = spark.createDataFrame([(2,)], "who long")
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "erase", lambda *a: (_ for _ in ()).throw(OSError("simulated failure")))
        with pytest.raises(OSError):
            mart.forget(t, asked, "who", "r")
    mart.forget(t, asked, "who", "r")
    mart.refresh(t)
    assert _totals(mart.read()) == {"a": (1, 1.0)} and t.read().count() == 1


def test_a_refresh_scans_new_loads_only(spark, tmp_root):
    t, mart = _mart(spark, tmp_root)
    t.write(_sales(spark, [(1, "a", 1.0)]))
    mart.refresh(t)
    name = t.write(_sales(spark, [(2, "a", 2.0)]))
    text = plan_text(mart._sums(t.read_load(name), 1, name))
    assert f"(load#" in text and f"= {name})" in text.split("PartitionFilters")[1].split("]")[0] + ")"
    assert mart.refresh(t) == [name]


# ------------------------------------------------------------------ sets
def test_distinct_counts_from_slices(spark, tmp_root):
    dice = random.Random(4)
    rows = [(dice.randint(0, 90_000), dice.randint(2000, 2002), dice.randint(1, 12)) for _ in range(600)] + [(None, 2000, 1)]
    df = spark.createDataFrame(rows, "k long, y int, m int")
    mart = DistinctMart(spark, tmp_root, {"y": F.col("y"), "m": F.col("m")}, F.col("k"))
    for part in (df.where("m < 5"), df, df.where("y = 2000")):  # rows may come again
        mart.add(part)
    for _ in range(2):
        got = {r.year: r.n for r in mart.count(year=F.col("y")).collect()}
        assert got == {y: len({k for k, yy, _ in rows if yy == y and k is not None}) for y in (2000, 2001, 2002)}
        mart.compact()


def test_membership_of_a_bitmap(spark):
    inside = [1, 2, 8, 9, 32768, 32769, 70000]
    sets = bitmaps.build(spark.createDataFrame([(i,) for i in inside], "n long"), F.col("n"))
    asked = spark.createDataFrame([(i,) for i in [*inside, 3, 7, 10, 32767, 32770, 1_000_000]], "a long")
    joined = asked.join(sets, F.bitmap_bucket_number("a") == F.col("bucket"), "left")
    assert sorted(r.a for r in joined.where(bitmaps.holds(F.col("bits"), F.col("a"))).collect()) == inside


def _checked(spark, ids):
    return spark.createDataFrame([(i, f"text {i}") for i in ids], "id long, text string")


def test_checksums_with_and_without_sets_agree(spark, tmp_root):
    plain, fast, sets = (VersionedTable(spark, f"{tmp_root}/{n}") for n in ("plain", "fast", "sets"))
    for ids in (range(50), range(30, 3000), range(30, 3000), [5, 5, 9999]):
        bronze.ingest_by_checksum(plain, _checked(spark, ids), ["id", "text"])
        bronze.ingest_by_checksum(fast, _checked(spark, ids), ["id", "text"], bitmap=sets)
        assert sorted(r.id for r in fast.read().collect()) == sorted(r.id for r in plain.read().collect())
    assert len(fast.loads()) == 3  # the batch that was all repeats left no load


def test_a_batch_without_repeats_reads_no_stored_checksum(spark, tmp_root, monkeypatch):
    t, sets = VersionedTable(spark, f"{tmp_root}/t"), VersionedTable(spark, f"{tmp_root}/s")
    bronze.ingest_by_checksum(t, _checked(spark, range(20)), ["id", "text"], bitmap=sets)
    bronze._add_bitmaps(t, sets, "checksum")
    real = VersionedTable.read

    def trapped(self, *args, **kwargs):
        df = real(self, *args, **kwargs)
        if self.path != t.path or "with_load" in kwargs:
            return df
        return df.withColumn("checksum", F.raise_error(F.lit("stored checksums were read")).cast("string"))

    monkeypatch.setattr(VersionedTable, "read", trapped)
    new = next(ids for k in range(100) if not _hits(spark, t, sets, ids := range(1000 + 3 * k, 1003 + 3 * k)))
    bronze.ingest_by_checksum(t, _checked(spark, new), ["id", "text"], bitmap=sets)
    with pytest.raises(Exception, match="stored checksums were read"):
        bronze.ingest_by_checksum(t, _checked(spark, [3]), ["id", "text"], bitmap=sets)


def _hits(spark, t, sets, ids):
    rows = bronze.with_checksum(_checked(spark, ids), ["id", "text"])
    return not bronze._maybe_stored(rows, sets, "checksum").where("_maybe").isEmpty()


# ------------------------------------------------------------------ streams
EVENT = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("v", T.StringType())])


def _land(spark, path, rows):
    spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("max_files", [1, 2, None])
def test_every_offered_row_is_accounted_for(spark, tmp_root, max_files):
    day = [dt.datetime(2024, 1, d) for d in range(1, 31)]
    files = [
        [(1, day[9], "a"), (1, day[9], "b"), (2, day[4], "a")],  # no file before: nothing late
        [(1, day[9], "c"), (3, day[7], "a"), (4, day[6], "a")],  # 4 is more than two days before day 10
        [(5, day[20], "a"), (4, day[6], "a"), (None, day[20], "a")],
        [(6, day[19], "a"), (7, day[8], "a"), (5, day[20], "z"), (8, None, "a")],
    ]
    out = f"{tmp_root}/out"
    for rows in files:
        _land(spark, f"{tmp_root}/in", rows)
    streams.stream_dedupe_accounted(spark, f"{tmp_root}/in", EVENT, out, f"{tmp_root}/ck", "event_id", "ts", "2 days", max_files=max_files)
    kept = streams.read_accounted(spark, EVENT, out, "kept").collect()
    assert sorted((str(r.event_id), r.v) for r in kept) == [("1", "a"), ("2", "a"), ("3", "a"), ("5", "a"), ("6", "a"), ("8", "a"), ("None", "a")]
    late = streams.read_accounted(spark, EVENT, out, "late").collect()
    assert sorted(r.event_id for r in late) == [4, 4, 7]
    counts = streams.read_accounted(spark, EVENT, out, "counts").agg(*[F.sum(c).alias(c) for c in ("offered", "kept", "late", "repeated")]).first()
    assert (counts.offered, counts.kept, counts.late, counts.repeated) == (13, 7, 3, 3)
    _land(spark, f"{tmp_root}/in", [(9, day[20], "a")])
    streams.stream_dedupe_accounted(spark, f"{tmp_root}/in", EVENT, out, f"{tmp_root}/new", "event_id", "ts", "2 days", max_files=max_files)
    again = streams.read_accounted(spark, EVENT, out, "kept").collect()
    assert len(again) == 8 and {r.event_id for r in again} == {1, 2, 3, 5, 6, 8, 9, None}


def test_accounted_rows_are_dealt_to_tasks_of_a_bounded_size(spark, tmp_root, monkeypatch):
    day = dt.datetime(2024, 1, 5)
    _land(spark, f"{tmp_root}/in", [(k % 60, day, str(k)) for k in range(80)])  # one day
    monkeypatch.setattr(streams, "ROWS_PER_TASK", 8)
    args = (spark, f"{tmp_root}/in", EVENT, f"{tmp_root}/out", f"{tmp_root}/ck", "event_id", "ts", "2 days")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one task
    try:
        streams.stream_dedupe_accounted(*args)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    kept = spark.read.parquet(f"{tmp_root}/out/kept").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in kept) == 60
    assert len(kept) > 3 and max(r["count"] for r in kept) < 60  # before, one task wrote the day


def test_drifting_fields_are_kept_and_broken_lines_rescued(spark, tmp_root):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    lines = [
        {"id": 1, "name": "a"}, {"id": 2, "name": "b", "tags": ["x", "y"], "deep": {"n": 1.5}}, {"id": "three", "name": "c"}, {"name": None, "id": 4},
    ]
    texts = [*map(json.dumps, lines), "not json", "[1, 2]", "  "]
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(f"{tmp_root}/in")
    streams.stream_ingest_drift(spark, f"{tmp_root}/in", schema, f"{tmp_root}/out", f"{tmp_root}/ck")
    rows = spark.read.parquet(f"{tmp_root}/out").select("id", "name", F.to_json("extra").alias("extra"), "rescued").collect()
    got = {(r.id, r.name): (r.extra and json.loads(r.extra), r.rescued) for r in rows if r.id or r.name}
    assert got == {
        (1, "a"): (None, None), (2, "b"): ({"tags": ["x", "y"], "deep": {"n": 1.5}}, None), (None, "c"): (None, texts[2]), (4, None): (None, None),
    }
    assert sorted(r.rescued for r in rows if not (r.id or r.name)) == ["[1, 2]", "not json"]


# ------------------------------------------------------------------ erasure by key
def test_erased_keys_make_their_rows_unreadable_and_no_others(spark, tmp_root):
    keys, t = VersionedTable(spark, f"{tmp_root}/keys"), VersionedTable(spark, f"{tmp_root}/rows")
    df = spark.createDataFrame([(i, i % 5, f"secret {i}", None if i % 7 else 1.5) for i in range(40)], "id long, who long, note string, v double")
    privacy.issue_keys(keys, df, "who", "s")
    privacy.issue_keys(keys, df, "who", "s")
    issued = {r.who: bytes(r.data_key) for r in keys.read().collect()}
    assert len(issued) == 5 == len(set(issued.values())) and all(len(k) == 32 for k in issued.values())
    t.write(privacy.seal(df, keys, "who", ["note", "v"]))
    assert b"secret" not in b"".join(bytes(r.sealed) for r in t.read().collect())
    privacy.forget_keys(keys, spark.createDataFrame([(3,)], "who long"), "who")
    schema = "note string, v double"
    got = {r.id: (r.who, r.note, r.v) for r in privacy.unseal(t.read(), keys, "who", schema).collect()}
    assert got == {i: (i % 5, None if i % 5 == 3 else f"secret {i}", None if i % 5 == 3 or i % 7 else 1.5) for i in range(40)}
    privacy.issue_keys(keys, df, "who", "s")  # a new key does not open what the old one sealed
    assert privacy.unseal(t.read(), keys, "who", schema).where("who = 3 AND note IS NOT NULL").count() == 0
    moved = t.read().withColumn("who", F.pmod(F.col("who") + 1, F.lit(5)))  # a sealed value does not open for another subject
    assert privacy.unseal(moved, keys, "who", schema).where("note IS NOT NULL").count() == 0


def test_a_row_without_a_key_is_not_sealed_silently(spark, tmp_root):
    keys = VersionedTable(spark, f"{tmp_root}/keys")
    privacy.issue_keys(keys, spark.createDataFrame([(1,)], "who long"), "who", "s")
    df = spark.createDataFrame([(2, "x")], "who long, note string")
    with pytest.raises(Exception, match="no data key"):
        privacy.seal(df, keys, "who", ["note"]).collect()


@pytest.mark.parametrize("zone", ["Asia/Kolkata", "America/Sao_Paulo"])
def test_times_without_a_zone_do_not_depend_on_the_sessions(spark, tmp_root, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        t = VersionedTable(spark, f"{tmp_root}/t")
        rows = spark.createDataFrame([(d, dt.datetime(2024, 1, 1, d)) for d in range(20)], "id long, ts timestamp_ntz")
        bronze.ingest_newer(t, rows.where("id < 10"), "ts")
        assert sorted(r.id for r in bronze.ingest_newer(t, rows, "ts").collect()) == list(range(10))
        assert t.read().count() == 20
        day = [dt.datetime(2024, 1, 10, h) for h in range(24)]
        for n, files in enumerate(([(1, day[12], "a")], [(2, day[10], "a"), (3, day[9], "a")])):
            _land(spark, f"{tmp_root}/in", files)
            streams.stream_dedupe_accounted(spark, f"{tmp_root}/in", EVENT, f"{tmp_root}/out", f"{tmp_root}/ck", "event_id", "ts", "2 hours")
        assert [r.event_id for r in streams.read_accounted(spark, EVENT, f"{tmp_root}/out", "late").collect()] == [3]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
