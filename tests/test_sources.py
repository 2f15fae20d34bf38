import datetime as dt
import json
import os

import pytest
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.operators import bronze
from lakevault.sources import paged
from lakevault.sources.csv import read_csv_robust, write_csv
from lakevault.sources.formats import read_source, write_source
from lakevault.sources.landing import land_partitioned, read_day
from lakevault.sources.registry import SourceRegistry
from lakevault.sources.versioned import VersionedTable

ITEM = T.StructType([T.StructField("id", T.LongType()), T.StructField("nome", T.StringType())])


def _local_dir(prefix):
    # raw files a test hands to a reader; Spark outputs go to the shared root
    return tempfile.mkdtemp(prefix=prefix)


def test_csv_robust_dialect_keeps_quotes_commas_newlines(spark):
    d = _local_dir("csv-")
    with open(os.path.join(d, "raw.csv"), "w", encoding="utf-8-sig") as f:
        f.write('id,txt,v\n1,"a ""q"" b, c",10\n2,"line one\nline two",20\n3,,30\n')
    schema = "id int, txt string, v int"
    got = sorted(tuple(r) for r in read_csv_robust(spark, d, schema).collect())
    assert got == [(1, 'a "q" b, c', 10), (2, "line one\nline two", 20), (3, None, 30)]


def test_csv_roundtrip_keeps_blanks_and_empty_strings(spark, tmp_root):
    df = spark.createDataFrame([(1, "  pad  "), (2, ""), (3, None), (4, 'x "y"\nz')], "id int, t string")
    write_csv(df, tmp_root, null_token="\\N")
    back = sorted(tuple(r) for r in read_csv_robust(spark, tmp_root, df.schema, null_token="\\N").collect())
    assert back == [(1, "  pad  "), (2, ""), (3, None), (4, 'x "y"\nz')]
    # by default too, also through the format switch; a spreadsheet's dialect has null for both
    for k, (write, read) in enumerate([
        (lambda p: write_csv(df, p), lambda p: read_csv_robust(spark, p, df.schema)),
        (lambda p: write_source(df, "csv", p), lambda p: read_source(spark, "csv", p, schema=df.schema)),
    ]):
        write(f"{tmp_root}-{k}")
        assert sorted(tuple(r) for r in read(f"{tmp_root}-{k}").collect()) == back
    write_csv(df, tmp_root + "-plain", null_token=None)
    plain = sorted(tuple(r) for r in read_csv_robust(spark, tmp_root + "-plain", df.schema, null_token=None).collect())
    assert plain[1] == (2, None) and plain[0] == (1, "  pad  ")


def test_multi_format_read(spark, tmp_root):
    df = spark.createDataFrame([(1, "a")], "k int, n string")
    for fmt in ("json", "csv", "parquet", "orc"):
        write_source(df, fmt, f"{tmp_root}/{fmt}")
        assert [tuple(r) for r in read_source(spark, fmt, f"{tmp_root}/{fmt}", schema=df.schema).collect()] == [(1, "a")]


def _pages(spark, sizes, envelope=True):
    rows = []
    n = 0
    for i, size in enumerate(sizes):
        items = [{"id": n + j, "nome": f"p{n + j}"} for j in range(size)]
        n += size
        body = {"_embedded": {"projetos": items}} if envelope else {}
        rows.append((i * 100, json.dumps(body)))
    return spark.createDataFrame(rows, paged.PAGE_SCHEMA)


def test_pages_stop_at_first_empty_page(spark):
    out = paged.unwrap_pages(_pages(spark, [2, 0, 2]), ITEM)
    assert sorted(r.id for r in out.collect()) == [0, 1]


def test_missing_envelope_counts_as_empty(spark):
    pages = _pages(spark, [2], envelope=False).unionByName(_pages(spark, [3]).where("offset = 0")
                                                           .withColumn("offset", F.lit(100).cast("bigint")))
    assert paged.unwrap_pages(pages, ITEM).count() == 0


def test_row_cap_drops_pages_at_or_after_it(spark):
    out = paged.unwrap_pages(_pages(spark, [2, 2, 2]), ITEM, max_rows=200)
    assert out.count() == 4


def test_paged_http_source_reads_one_partition_per_page(spark):
    d = _local_dir("pages-")
    for off, size in ((0, 2), (100, 2), (200, 0)):
        items = [{"id": off + j, "nome": "x"} for j in range(size)]
        with open(os.path.join(d, f"page-{off}.json"), "w") as f:
            json.dump({"_embedded": {"projetos": items}}, f)
    paged.register(spark)
    raw = (
        spark.read.format("paged_http")
        .option("url", "file://" + d + "/page-{offset}.json")
        .option("limit", "100")
        .option("max_rows", "300")
        .load()
    )
    assert raw.rdd.getNumPartitions() == 3
    assert sorted(r.id for r in paged.unwrap_pages(raw, ITEM).collect()) == [0, 1, 100, 101]
    grouped = (
        spark.read.format("paged_http")
        .option("url", "file://" + d + "/page-{offset}.json")
        .option("limit", "100")
        .option("max_rows", "300")
        .option("pages_per_partition", "2")
        .load()
    )
    assert grouped.rdd.getNumPartitions() == 2
    assert sorted(r.id for r in paged.unwrap_pages(grouped, ITEM).collect()) == [0, 1, 100, 101]


def test_page_files_roundtrip(spark, tmp_root):
    df = spark.range(0, 250).select(F.col("id"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("nome"))
    paged.write_page_files(df, tmp_root, key="id", page_size=100)
    assert paged.read_page_files(spark, tmp_root, ITEM).count() == 250
    assert paged.read_page_files(spark, tmp_root, ITEM, max_rows=200).count() == 200


@pytest.mark.parametrize("body", ['{"_embedded": {"projetos": [{"id": 1', '{"error": "try later"}',
                                  '{"_embedded": {"projetos": [{"id": "x", "nome": 3}]}}'])
def test_bad_pages_fail_instead_of_vanishing(spark, tmp_root, body):
    good = json.dumps({"offset": 0, "_embedded": {"projetos": [{"id": 1, "nome": "a"}]}})
    bad = body if body.startswith('{"_embedded": {"projetos": [{"id": 1') else body[:-1] + ', "offset": 100}'
    spark.createDataFrame([(good,), (bad,)], "value string").coalesce(1).write.text(tmp_root)
    with pytest.raises(Exception):
        paged.read_page_files(spark, tmp_root, ITEM).collect()


def test_extract_finds_its_end(spark):
    d = _local_dir("pages-all-")
    for off in range(0, 900, 100):
        items = [{"id": off + j, "nome": "x"} for j in range(100 if off < 500 else 0)]
        with open(os.path.join(d, f"page-{off}.json"), "w") as f:
            json.dump({"_embedded": {"projetos": items}}, f)
    out = paged.extract_all(spark, "file://" + d + "/page-{offset}.json", ITEM, window=3)
    assert sorted(r.id for r in out.collect()) == list(range(500))


def test_contract_rejects_bad_types_and_unknown_conditions(spark):
    df = spark.createDataFrame([(1, "2.5"), (2, "x"), (3, None), (None, "1")], "k int, v string")
    valid, rejected = bronze.contract_split(df, {"small_key": F.col("k") < 2}, {"v": "double"})
    assert sorted((r.k, r.v) for r in valid.collect()) == [(3, None)]
    assert sorted((r.k or 0, r.reasons) for r in rejected.collect()) == [(0, "small_key"), (1, "small_key"), (2, "type:v")]
    with pytest.raises(ValueError):
        bronze.contract_split(df, {}, {"missing": "int"})


def test_checksum_ingest_keeps_every_distinct_tuple(spark, tmp_root):
    rows = [(1, None, "x"), (1, "x", None), (2, "p|q", "r"), (2, "p", "q|r"), (2, "p", "q|r"), (3, "", None), (3, None, "")]
    df = spark.createDataFrame(rows, "a int, b string, c string")
    t = VersionedTable(spark, tmp_root)
    for _ in range(2):
        bronze.ingest_by_checksum(t, df, ["a", "b", "c"])
    assert sorted(map(repr, ((r.a, r.b, r.c) for r in t.read().collect()))) == sorted(map(repr, set(rows)))


def test_landing_prunes_partitions(spark, tmp_root):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 5, 3)), (2, dt.datetime(2024, 1, 6, 4))], "event_id long, ts timestamp_ntz"
    )
    land_partitioned(df, tmp_root, "ts")
    day = read_day(spark, tmp_root, dt.date(2024, 1, 5))
    assert [r.event_id for r in day.collect()] == [1]
    from lakevault.plans.inspect import plan_text

    assert "PartitionFilters: [isnotnull(year" in plan_text(day)


def test_ingest_metadata_names_the_file(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    out = bronze.with_ingest_metadata(ev, "EVENTS_PARQUET", "parquet")
    assert out.where(F.col("source_file").isNull()).count() == 0
    assert out.select("source_file").first().source_file.endswith("events.parquet")


def test_checksum_reingest_is_idempotent(spark, tmp_root):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    t = VersionedTable(spark, tmp_root)
    for _ in range(3):
        bronze.ingest_by_checksum(t, df, ["id", "v"])
    assert t.read().count() == 2


def test_contract_split_is_a_partition_of_the_input(spark):
    df = spark.range(0, 50).withColumn("bal", F.col("id") - 10)
    valid, rejected = bronze.contract_split(df, {"negative": F.col("bal") < 0, "odd": F.col("id") % 2 == 1})
    assert valid.count() + rejected.count() == 50
    assert rejected.where("id = 1").first().reasons == "negative,odd"


def test_registry_resolves_source_markers(spark):
    reg = SourceRegistry(spark)
    reg.add("silver.hub", spark.createDataFrame([(1,)], "k int"))
    assert reg.sql("SELECT count(*) AS n FROM {{ source('silver', 'hub') }}").first().n == 1


def test_paged_http_falls_back_when_route_is_missing(spark):
    d = _local_dir("pages-fb-")
    with open(os.path.join(d, "page-0.json"), "w") as f:
        json.dump({"_embedded": {"projetos": [{"id": 7, "nome": "x"}]}}, f)
    paged.register(spark)
    raw = (
        spark.read.format("paged_http")
        .option("url", "file://" + d + "/missing/page-{offset}.json")
        .option("fallback_url", "file://" + d + "/page-{offset}.json")
        .option("limit", "100")
        .option("max_rows", "100")
        .load()
    )
    assert [r.id for r in paged.unwrap_pages(raw, ITEM).collect()] == [7]


def test_paged_http_without_fallback_fails_instead_of_truncating(spark):
    import pytest

    d = _local_dir("pages-missing-")
    paged.register(spark)
    raw = (
        spark.read.format("paged_http")
        .option("url", "file://" + d + "/page-{offset}.json")
        .option("limit", "100")
        .option("max_rows", "100")
        .load()
    )
    with pytest.raises(Exception):
        raw.collect()


def test_text_sinks_keep_microseconds(spark, tmp_root):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 0, 9, 58, 778549))], "id int, ts timestamp_ntz")
    for fmt in ("json", "csv"):
        write_source(df, fmt, f"{tmp_root}/{fmt}")
        back = read_source(spark, fmt, f"{tmp_root}/{fmt}", schema=df.schema).first()
        assert back.ts == dt.datetime(2024, 1, 1, 0, 9, 58, 778549), fmt
    write_csv(df, f"{tmp_root}/sink")
    assert read_csv_robust(spark, f"{tmp_root}/sink", df.schema).first().ts.microsecond == 778549


def test_high_watermark_against_empty_and_filled_table(spark, tmp_root):
    schema = "id long, ts timestamp_ntz"
    batch = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 3))], schema)
    t = VersionedTable(spark, tmp_root)
    t.write(spark.createDataFrame([], schema), mode="overwrite")
    new, held = bronze.newer_than_stored(t, batch, "ts")
    assert new.count() == 2 and held.count() == 0
    t.write(spark.createDataFrame([(0, dt.datetime(2024, 1, 2))], schema), mode="append")
    new, held = bronze.newer_than_stored(t, batch, "ts")
    assert [r.id for r in new.collect()] == [2] and [r.id for r in held.collect()] == [1]
    undated = batch.unionByName(spark.createDataFrame([(9, None)], schema))
    for _ in range(2):
        held = bronze.ingest_newer(t, undated, "ts")
    assert sorted(r.id for r in t.read().collect()) == [0, 2]
    assert sorted(r.id for r in held.collect()) == [1, 2, 9]


def test_a_retried_watermark_load_holds_back_what_the_first_run_did(spark, tmp_root):
    t = VersionedTable(spark, tmp_root)
    cols = "id long, ts timestamp_ntz"

    def at(*days):
        return spark.createDataFrame([(d, dt.datetime(2024, 1, d)) for d in days], cols)

    assert bronze.ingest_newer(t, at(1, 2), "ts", load_id="a").isEmpty()
    for batch, load_id, held in ((at(1, 2), "a", []), (at(2, 3), "b", [2]), (at(2, 3), "b", [2]), (at(1, 2), "a", [])):
        assert sorted(r.id for r in bronze.ingest_newer(t, batch, "ts", load_id=load_id).collect()) == held
    assert sorted(r.id for r in t.read().collect()) == [1, 2, 3]


def _site(pages: dict):
    """A folder of page files; returns the address template."""
    d = _local_dir("pages-site-")
    for off, body in pages.items():
        with open(os.path.join(d, f"page-{off}.json"), "w") as f:
            f.write(body if isinstance(body, str) else json.dumps({"_embedded": {"projetos": [{"id": i, "nome": "x"} for i in body]}}))
    return d, "file://" + d + "/page-{offset}.json"


def test_an_extract_is_taken_up_where_it_stopped(spark, tmp_root):
    d, url = _site({off: range(off, off + 100) for off in range(0, 700, 100)})
    with open(os.path.join(d, "page-300.json"), "w") as f:
        f.write("{broken")
    assert paged.resume_extract(spark, url, tmp_root, ITEM, pages=2) is False
    with pytest.raises(Exception):
        paged.resume_extract(spark, url, tmp_root, ITEM, pages=3)  # it fails on the broken page and lands nothing
    assert paged.read_extract(spark, tmp_root, ITEM).count() == 200
    with open(os.path.join(d, "page-300.json"), "w") as f:
        json.dump({"_embedded": {"projetos": [{"id": i, "nome": "x"} for i in range(300, 400)]}}, f)
    while not paged.resume_extract(spark, url, tmp_root, ITEM, pages=3):  # the end: page 700 is not there
        pass
    assert paged.resume_extract(spark, url, tmp_root, ITEM, pages=3) is True
    assert sorted(r.id for r in paged.read_extract(spark, tmp_root, ITEM).collect()) == list(range(700))


def test_an_extract_is_finished_in_few_calls_that_look_at_each_page_once(spark, tmp_root, monkeypatch):
    _, url = _site({off: range(off, off + 10) for off in range(0, 400, 10)})
    looked, look = [], paged._look_for_end
    monkeypatch.setattr(paged, "_look_for_end", lambda s, p, start, stop, *a: looked.append((start, stop)) or look(s, p, start, stop, *a))
    assert paged.resume_extract(spark, url, tmp_root, ITEM, 10, pages=2) is False
    paged.finish_extract(spark, url, tmp_root, ITEM, 10, pages=4)
    assert looked == [(0, 20), (20, 60), (60, 140), (140, 300), (300, 620)]
    paged.finish_extract(spark, url, tmp_root, ITEM, 10, pages=4)
    assert len(looked) == 5
    assert sorted(r.id for r in paged.read_extract(spark, tmp_root, ITEM).collect()) == list(range(400))
    # a run that landed pages and stopped before it looked at them
    spark.read.parquet(f"{tmp_root}/checked").where("stop <= 60").coalesce(1).write.parquet(f"{tmp_root}/two/checked")
    spark.read.parquet(f"{tmp_root}/pages").write.parquet(f"{tmp_root}/two/pages")
    assert paged.resume_extract(spark, url, f"{tmp_root}/two", ITEM, 10, pages=4) is True


@pytest.mark.parametrize("window", [1, 3, 1000])
def test_extract_ends_at_the_first_page_that_is_empty_or_not_found(spark, window):
    _, url = _site({0: range(100), 100: range(100, 130), 300: range(300, 400)})
    assert sorted(r.id for r in paged.extract_all(spark, url, ITEM, window=window).collect()) == list(range(130))
    _, url = _site({0: range(100), 100: [], 200: range(200, 300)})
    assert sorted(r.id for r in paged.extract_all(spark, url, ITEM, window=window).collect()) == list(range(100))


def test_an_extract_whose_first_page_is_not_found_fails(spark):
    _, url = _site({100: range(100)})
    with pytest.raises(Exception):
        paged.extract_all(spark, url, ITEM)


def test_an_extract_falls_back_page_by_page(spark):
    _, url = _site({0: range(100)})
    _, other = _site({100: range(100, 150)})
    assert paged.extract_all(spark, url, ITEM, fallback_url=other).count() == 150
