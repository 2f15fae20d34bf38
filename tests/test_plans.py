"""Physical-plan properties the operators promise (read with explain)."""

from pyspark.sql import functions as F

from lakevault.operators.gold import top_k
from lakevault.operators.history import latest_per_key
from lakevault.operators.vault import hub_rows
from lakevault.plans import medallion as md
from lakevault.plans import standins as S
from lakevault.plans.inspect import plan_text, python_udf_free

SF = "/root/testdata/sf0.001"


def test_top_k_is_take_ordered(spark):
    ev = S.table(spark, SF, "events")
    assert "TakeOrderedAndProject" in plan_text(top_k(ev, 10, [F.col("value").desc_nulls_last()]))


def test_latest_is_a_partial_aggregate_not_a_window(spark):
    sat = md.event_sat_rows(S.table(spark, SF, "events"))
    text = plan_text(latest_per_key(sat, ["hk"], md.SAT_ORDER))
    assert "partial_max_by" in text
    assert "Window" not in text


def test_hub_load_prunes_columns_and_pushes_filters(spark):
    ev = S._before_t(S.table(spark, SF, "events"))
    text = plan_text(hub_rows(ev, "user_id", "hk", S.LOAD_TS, "EVENTS")[0])
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in text
    assert "LessThan(ts," in text
    assert "HashAggregate" in text


def test_change_detection_windows_per_key_and_day(spark):
    sat = md.event_sat_rows(S.table(spark, SF, "events"))
    text = plan_text(md.sat_changes(sat), "simple")
    # the row-level window is partitioned by (hk, day chunk), never by hk alone
    row_windows = [line for line in text.splitlines() if "Window [" in line and "lag(_cmp" in line]
    assert row_windows
    for line in row_windows:
        assert "_chunk" in line.split("windowspecdefinition(")[1].split(",")[1]
    assert "sha2" not in text  # attributes are compared as a struct, not hashed per row


def test_versioned_read_prunes_to_visible_versions(spark, tmp_root):
    from lakevault.sources.versioned import VersionedTable

    t = VersionedTable(spark, tmp_root)
    df = spark.range(10).withColumnRenamed("id", "k")
    t.write(df, mode="overwrite")
    t.write(df, mode="overwrite")
    text = plan_text(t.read())
    assert "base=v0000000001" in text and "base=v0000000000" not in text
    t.write(df, mode="append")
    assert "PartitionFilters: [isnotnull(load" in plan_text(t.read(as_of=1))


def test_insert_only_merge_shuffles_the_batch_once(spark, tmp_root):
    from lakevault.operators import vault
    from lakevault.sources.versioned import VersionedTable

    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = VersionedTable(spark, tmp_root)
        events = S.table(spark, SF, "events")
        vault.hub_load(t, events, "user_id", "2024-02-01", "E")
        hub, _ = vault.hub_rows(events, "user_id")
        fresh = hub.join(t.read().select("user_id"), "user_id", "left_anti")
        text = plan_text(fresh, "simple")
        assert text.count("Exchange hashpartitioning") == 2  # the batch's distinct keys, and the stored keys
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


def test_registered_queries_run_no_python_udf(spark):
    for name in ("gold_dim_strict", "contract_tax_id", "mask_pii", "cast_tolerant", "nested_text_parse",
                 "mart_calls", "consent_filter", "catalog_flatten", "dim_calendar"):
        assert python_udf_free(S.QUERIES[name](spark, SF)), name


def test_sql_model_combines_before_the_shuffle(spark):
    from lakevault.sources.registry import SourceRegistry

    sat = md.event_sat_rows(S.table(spark, SF, "events"))
    hub = S.vault.hub_rows(S.table(spark, SF, "events"), "user_id")[0]
    reg = SourceRegistry(spark)
    reg.add("silver.sat", sat)
    reg.add("silver.hub", hub)
    text = plan_text(reg.sql(S.GOLD_MODEL))
    assert "partial_max_by" in text
