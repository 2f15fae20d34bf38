import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from lakevault.operators import gold, vault
from lakevault.operators.history import changed_rows, day_chunk, latest_per_key, with_neighbors
from lakevault.plans import medallion as md
from lakevault.sources.versioned import VersionedTable

T0 = dt.datetime(2024, 1, 1)


def _sat(spark, rows):
    return spark.createDataFrame(rows, "hk string, load_date timestamp_ntz, event_id long, nome string")


def test_latest_with_tie_takes_greater_tie_break(spark):
    df = _sat(spark, [("a", T0, 1, "x"), ("a", T0, 2, "y"), ("b", T0, 1, "z")])
    got = sorted((r.hk, r.nome) for r in latest_per_key(df, ["hk"], ["load_date", "event_id"]).collect())
    assert got == [("a", "y"), ("b", "z")]


def test_null_business_key_goes_to_rejects(spark, tmp_root):
    batch = spark.createDataFrame([(1, "x"), (None, "y")], "user_id long, v string")
    t = VersionedTable(spark, tmp_root)
    for _ in range(2):
        rejects = vault.hub_load(t, batch, "user_id", "2024-02-01 00:00:00", "SRC")
        assert rejects.count() == 1
    assert [r.user_id for r in t.read().collect()] == [1]


def test_reload_is_idempotent_for_hub_and_changed_sat(spark, tmp_root):
    ev = spark.createDataFrame(
        [(1, T0, 1, "a"), (1, T0 + dt.timedelta(hours=1), 2, "a"), (1, T0 + dt.timedelta(days=1), 3, "b"),
         (2, T0, 4, "c")],
        "user_id long, ts timestamp_ntz, event_id long, nome string",
    )
    rows = vault.sat_rows(ev, "user_id", ["event_id", "nome"], load_date_col="ts")
    hub_t = VersionedTable(spark, f"{tmp_root}/hub")
    all_t = VersionedTable(spark, f"{tmp_root}/all")
    chg_t = VersionedTable(spark, f"{tmp_root}/chg")
    for _ in range(2):
        vault.hub_load(hub_t, ev, "user_id", "2024-02-01", "SRC")
        vault.sat_append_all(all_t, rows)
        late = vault.sat_append_changed(chg_t, rows, "hk", ["load_date", "event_id"], ["nome"])
        assert late.count() == 0
    assert hub_t.read().count() == 2
    assert all_t.read().count() == 8
    assert sorted(r.event_id for r in chg_t.read().collect()) == [1, 3, 4]


def test_hub_without_satellite_is_not_in_gold(spark):
    hub = spark.createDataFrame([("a", 1), ("b", 2)], "hk string, user_id long")
    sat = _sat(spark, [("a", T0, 1, "x"), ("c", T0, 2, "y")])
    out = gold.current_dimension(hub, sat, "hk", ["load_date", "event_id"], {"codigo": F.col("key.user_id")})
    assert [r.codigo for r in out.collect()] == [1]


def test_cdc_apply_deletes_and_upserts(spark):
    first = _sat(spark, [("a", T0, 1, "x"), ("b", T0, 2, "y")])
    changes = _sat(spark, [("a", T0, 3, "error"), ("c", T0, 4, "new"), ("b", T0, 5, "upd")])
    for batches in ([first, changes], [changes, first], [first, changes, first]):  # in any order, and again
        state = None
        for batch in batches:
            state = vault.cdc_apply(state, batch, ["hk"], ["load_date", "event_id"], F.col("nome") == "error")
        assert sorted((r.hk, r.nome) for r in vault.cdc_live(state).collect()) == [("b", "upd"), ("c", "new")]


def test_late_versions_are_returned_and_rebuilt(spark, tmp_root):
    order = ["load_date", "event_id"]
    day = lambda d: T0 + dt.timedelta(days=d)
    history = _sat(spark, [("a", day(0), 1, "x"), ("a", day(5), 2, "y"), ("a", day(9), 3, "y"), ("b", day(1), 4, "x")])
    late_rows = _sat(spark, [("a", day(7), 5, "z"), ("a", day(6), 6, "y"), ("b", day(0), 7, "x")])
    t, seen = VersionedTable(spark, f"{tmp_root}/sat"), VersionedTable(spark, f"{tmp_root}/seen")
    vault.sat_append_changed(t, history, "hk", order, ["nome"], seen=seen)
    # event 3 was seen but, being unchanged, not stored: event 5 must not become the newest
    late = vault.sat_append_changed(t, late_rows, "hk", order, ["nome"], seen=seen)
    assert sorted(r.event_id for r in late.collect()) == [5, 7]  # event 6 equals the version in force
    assert sorted(r.event_id for r in t.read().collect()) == [1, 2, 4]
    everything = history.unionByName(late_rows)
    vault.sat_rebuild(t, everything, late, "hk", order, ["nome"])
    want = changed_rows(everything, ["hk"], order, ["nome"])
    assert sorted(r.event_id for r in t.read().collect()) == sorted(r.event_id for r in want.collect()) == [1, 2, 3, 5, 7]


def test_links_have_unique_keys_and_reject_nulls(spark, tmp_root):
    rows = [("1", "2"), ("1", "2"), ("1|1:2", ""), ("1", None), (None, "2"), ("1", "|2")]
    df = spark.createDataFrame(rows, "a string, b string")
    t = VersionedTable(spark, tmp_root)
    for _ in range(2):
        links, rejects = vault.link_rows(df, ["a", "b"])
        vault.insert_new_keys(t, links, ["a", "b"])
    assert rejects.count() == 2
    got = t.read().collect()
    assert len(got) == len({r.hk_link for r in got}) == 3


def test_multi_source_hub_keeps_one_row_per_key(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    hub = vault.hub_multi_source([(a, "k", "S1"), (b, "k", "S2")])
    assert sorted((r.k, r.record_source) for r in hub.collect()) == [(1, "S1"), (2, "S1"), (3, "S2")]


# ---------------------------------------------------------------- property tests
_events = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c"]),
        st.integers(min_value=0, max_value=72),  # hours from T0: spans several day chunks
        st.sampled_from(["x", "y", None]),
    ),
    min_size=1,
    max_size=40,
)


def _frame(spark, rows):
    data = [(k, T0 + dt.timedelta(hours=h), i, v) for i, (k, h, v) in enumerate(rows)]
    return _sat(spark, data)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=_events)
def test_chunked_neighbors_equal_plain_window(spark, rows):
    df = _frame(spark, rows)
    order = ["load_date", "event_id"]
    spec = dict(prev={"p": "nome", "pe": "event_id"}, nxt={"n": "nome", "ne": "event_id"})
    plain = with_neighbors(df, ["hk"], order, **spec)
    chunked = with_neighbors(df, ["hk"], order, chunk=day_chunk("load_date"), **spec)
    cols = ["event_id", "p", "pe", "n", "ne"]
    a = sorted(tuple(r[c] for c in cols) for r in plain.collect())
    b = sorted(tuple(r[c] for c in cols) for r in chunked.collect())
    assert a == b


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=_events)
def test_scd2_intervals_do_not_overlap_and_one_is_current(spark, rows):
    df = _frame(spark, rows)
    changes = changed_rows(df, ["hk"], ["load_date", "event_id"], ["nome"], chunk=day_chunk("load_date"))
    d = gold.scd2(changes, "hk", ["load_date", "event_id"], "load_date", chunk=day_chunk("load_date")).collect()
    by_key = {}
    for r in d:
        by_key.setdefault(r.hk, []).append(r)
    for key, versions in by_key.items():
        assert sum(1 for v in versions if v.is_current) == 1
        versions.sort(key=lambda v: (v.valid_from, v.event_id))
        for before, after in zip(versions, versions[1:]):
            assert before.valid_to == after.valid_from
    # consecutive stored versions always differ
    for versions in by_key.values():
        names = [v.nome for v in sorted(versions, key=lambda v: (v.valid_from, v.event_id))]
        assert all(x != y for x, y in zip(names, names[1:]))


def test_changed_rows_match_lag_definition(spark):
    rows = [("a", 0, "x"), ("a", 1, "x"), ("a", 30, "y"), ("a", 50, "x"), ("b", 2, None), ("b", 3, None)]
    df = _frame(spark, rows)
    got = sorted(r.event_id for r in changed_rows(df, ["hk"], ["load_date", "event_id"], ["nome"],
                                                   chunk=day_chunk("load_date")).collect())
    assert got == [0, 2, 3, 4]


def test_event_satellite_payload(spark):
    ev = spark.createDataFrame(
        [(1, T0, 7, "error", 1.5, '{"k": 1}'), (2, T0, 7, "view", 2.25, '{"k": 2}')],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    )
    got = sorted((r.event_id, r.valor_raw) for r in md.event_sat_rows(ev).collect())
    assert got == [(1, '{"k": 1}'), (2, "2.25")]


def test_csv_to_bronze_to_gold_flow(spark, tmp_root):
    from lakevault.sources.csv import write_csv

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    write_csv(ev, f"{tmp_root}/raw/raw_events_1700000000")
    bronze_t = VersionedTable(spark, f"{tmp_root}/bronze")
    md.ingest_bronze(spark, f"{tmp_root}/raw/raw_events_*", ev.schema, bronze_t, "2024-02-01 00:00:00")
    assert bronze_t.last_num_rows == ev.count()
    stored = bronze_t.read().drop("data_carga_bronze")
    silver = md.load_silver(spark, stored, f"{tmp_root}/silver", "2024-02-01 00:00:00")
    gold_rows = md.gold_dimension(silver).count()
    assert gold_rows == ev.select("user_id").distinct().count()


def test_prefiltered_merge_equals_plain_merge(spark, tmp_root):
    from lakevault.plans.inspect import plan_text

    old = spark.createDataFrame([(i,) for i in range(20)], "user_id long")
    new = spark.createDataFrame([(i,) for i in range(15, 30)], "user_id long")
    results = []
    for pre in (False, True):
        t = VersionedTable(spark, f"{tmp_root}/{pre}")
        vault.insert_new_keys(t, vault.hub_rows(old, "user_id")[0], "user_id", prefilter=pre)
        vault.insert_new_keys(t, vault.hub_rows(new, "user_id")[0], "user_id", prefilter=pre)
        results.append(sorted(r.user_id for r in t.read().collect()))
    assert results[0] == results[1] == list(range(30))
    stored = VersionedTable(spark, f"{tmp_root}/True").read().select("hk")
    reduced = stored.join(vault.hub_rows(new, "user_id")[0].select("hk"), "hk", "left_semi")
    assert "LeftSemi" in plan_text(reduced)


def test_null_load_date_is_kept_by_chunked_change_detection(spark):
    from lakevault.operators.history import time_chunk

    df = _sat(spark, [("a", None, 1, "x"), ("a", T0, 2, "x"), ("a", T0 + dt.timedelta(hours=2), 3, "y")])
    for chunk in (day_chunk("load_date"), time_chunk("load_date", "hour")):
        got = sorted(r.event_id for r in changed_rows(df, ["hk"], ["load_date", "event_id"], ["nome"], chunk=chunk).collect())
        assert got == [1, 3]


def test_merge_on_read_cdc_equals_copy_on_write(spark, tmp_root):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows = md.event_sat_rows(ev)
    split = F.col("load_date") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    is_delete = F.col("nome") == "error"
    cow = vault.cdc_apply(None, rows.where(split), ["hk"], md.SAT_ORDER, is_delete)
    cow = vault.cdc_apply(cow, rows.where(~split), ["hk"], md.SAT_ORDER, is_delete)
    t = VersionedTable(spark, tmp_root)
    vault.cdc_append_changes(t, rows.where(split), ["hk"], md.SAT_ORDER, is_delete)
    vault.cdc_append_changes(t, rows.where(~split), ["hk"], md.SAT_ORDER, is_delete)
    mor = vault.cdc_read_state(t, ["hk"], md.SAT_ORDER)
    cow = vault.cdc_live(cow)
    cols = ["hk", "event_id", "nome"]
    assert sorted(tuple(r) for r in mor.select(cols).collect()) == sorted(tuple(r) for r in cow.select(cols).collect())
    vault.cdc_compact(t, ["hk"], md.SAT_ORDER)
    after = vault.cdc_read_state(t, ["hk"], md.SAT_ORDER)
    assert after.select(cols).exceptAll(mor.select(cols)).count() == 0
    assert t.read().count() == ev.select("user_id").distinct().count()  # deleted keys keep a row


def test_silver_load_retry_with_same_load_id_is_idempotent(spark, tmp_root):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    n = ev.count()
    for _ in range(2):  # the retry of load "L1" writes nothing new
        silver = md.load_silver(spark, ev, tmp_root, "2024-02-01 00:00:00", load_id="L1")
    assert silver.sat.read().count() == n
    assert silver.hub.loads() == silver.sat.loads() == ["v0000000000.L1"]
    silver = md.load_silver(spark, ev, tmp_root, "2024-02-02 00:00:00", load_id="L2")
    assert silver.sat.read().count() == 2 * n  # a new load appends (append-all satellite)
    assert silver.hub.read().count() == ev.select("user_id").distinct().count()
    assert silver.sat.loads() == ["v0000000000.L1", "v0000000001.L2"]


def test_a_correction_of_equal_order_is_returned_and_stored_by_the_rebuild(spark, tmp_root):
    sat, seen = VersionedTable(spark, f"{tmp_root}/sat"), VersionedTable(spark, f"{tmp_root}/seen")
    cols = "hk string, seq long, v long"
    first = spark.createDataFrame([("a", 1, 99), ("a", 2, 10), ("b", 1, 5)], cols)
    assert vault.sat_append_changed(sat, first, "hk", ["seq"], ["v"], seen=seen).isEmpty()
    again = spark.createDataFrame([("a", 2, 99), ("a", 2, 10), ("b", 1, 5), ("b", 2, 5)], cols)
    late = vault.sat_append_changed(sat, again, "hk", ["seq"], ["v"], seen=seen)
    assert [tuple(r) for r in late.collect()] == [("a", 2, 99)]
    corrected = spark.createDataFrame([("a", 1, 99), ("a", 2, 99)], cols)
    vault.sat_rebuild(sat, corrected, late, "hk", ["seq"], ["v"])
    assert sorted(tuple(r) for r in sat.read().collect()) == [("a", 1, 99), ("b", 1, 5)]


@pytest.mark.parametrize("prefilter", [False, True])
def test_a_batch_without_new_keys_leaves_no_load(spark, tmp_root, prefilter):
    t = VersionedTable(spark, tmp_root)
    rows = spark.createDataFrame([("h1", 1), ("h2", 2)], "hk string, k long")
    assert vault.insert_new_keys(t, rows, "k", prefilter) is not None
    assert vault.insert_new_keys(t, rows, "k", prefilter) is None and len(t.loads()) == 1
