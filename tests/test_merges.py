"""Merges that move only what they must: bucketed hubs, SCD2 by closing intervals, point-in-time tables."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakevault.operators import gold, vault
from lakevault.operators.history import with_carried
from lakevault.plans.inspect import plan_text
from lakevault.sources.bucketed import BucketedTable
from lakevault.sources.versioned import SchemaMismatchError, TableExistsError

SAT = "hk string, load_date timestamp_ntz, event_id long, nome string"
ORDER = ["load_date", "event_id"]
T0 = dt.datetime(2024, 1, 1)


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# ------------------------------------------------------------------ bucketed merges
def _hub(spark, ids):
    return vault.hub_rows(spark.createDataFrame([(i,) for i in ids], "k long"), "k", load_ts="2024-01-01")[0]


@pytest.mark.parametrize("keys", [["k"], ["a", "b"]])
def test_a_merge_does_not_shuffle_the_stored_keys(spark, tmp_root, no_broadcast, keys):
    cols = ", ".join(f"{k} long" for k in keys)
    t = BucketedTable(spark, tmp_root, keys, buckets=8)
    rows = spark.createDataFrame([tuple([i] * len(keys)) for i in range(50)], cols)
    vault.insert_new_keys(t, rows, keys)
    fresh = t.aligned(rows.distinct()).join(t.read().select(*keys), keys, "left_anti")
    executed = fresh._jdf.queryExecution().executedPlan().toString()
    scan = executed.rindex("Scan parquet")
    # the join's right side: from its sort down to the table's scan there is no exchange, the others are the batch's
    assert "Bucketed: true" in executed[scan:] and "SortMergeJoin" in executed
    right = executed[executed.rindex("+- Sort", 0, scan) :]
    assert "Exchange" not in right and t.name in right


def test_bucketed_merge_equals_plain_set_union(spark, tmp_root):
    t = BucketedTable(spark, tmp_root, "k", buckets=4)
    for batch in (range(0, 20), range(10, 40), range(10, 40), [None, 41, 41]):
        vault.hub_load(t, spark.createDataFrame([(i,) for i in batch], "k long"), "k", "2024-01-01", "X")
    assert sorted(r.k for r in t.read().collect()) == [*range(40), 41]
    assert [r.k for r in t.find(k=17).collect()] == [17]
    with pytest.raises(TableExistsError):
        t.write(t.read(), mode="errorifexists")
    with pytest.raises(SchemaMismatchError):
        t.write(spark.createDataFrame([(1, "x")], "k long, other string"))


def test_a_new_session_finds_the_bucketed_table(spark, tmp_root):
    t = BucketedTable(spark, tmp_root, "k", buckets=4)
    vault.insert_new_keys(t, _hub(spark, range(10)), "k")
    spark.sql(f"DROP TABLE {t.name}")  # the catalog forgets it, its files stay
    again = BucketedTable(spark, tmp_root, "k", buckets=4)
    vault.insert_new_keys(again, _hub(spark, range(5, 15)), "k")
    assert sorted(r.k for r in again.read().collect()) == list(range(15))


# ------------------------------------------------------------------ SCD2 by closing intervals
def _history(seed, n=150, keys=6):
    dice = random.Random(seed)
    rows = [(f"k{dice.randint(0, keys)}", T0 + dt.timedelta(hours=dice.randint(0, 40)), i, dice.choice(["a", "b", None])) for i in range(n)]
    return rows + [("hot", T0 + dt.timedelta(hours=i // 4), 1000 + i, dice.choice("ab")) for i in range(120)]


def _intervals(df):
    return sorted(((r.hk, r.load_date, r.event_id, r.nome, r.valid_to, r.is_current) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_dimension_equals_the_full_one(spark, tmp_root, seed):
    dice = random.Random(seed + 10)
    rows = _history(seed)
    batches = [[], [], [], []]
    for r in rows:  # mostly in order, some late
        batches[min(3, (r[1] - T0).days * 2) if dice.random() < 0.8 else dice.randint(0, 3)].append(r)
    stored = []
    for batch in [*batches, batches[1]]:  # the last one again
        stored += batch
        frame, past = spark.createDataFrame(batch, SAT), spark.createDataFrame(stored, SAT)
        gold.scd2_merge(spark, tmp_root, frame, past, "hk", ORDER, ["nome"], "load_date", buckets=4)
        full = gold.scd2_of(past.distinct(), "hk", ORDER, ["nome"], "load_date")
        assert _intervals(gold.read_scd2(spark, tmp_root)) == _intervals(full)


def test_a_merge_rewrites_only_the_buckets_of_its_keys(spark, tmp_root):
    first = spark.createDataFrame([(f"k{i}", T0, i, "a") for i in range(40)], SAT)
    gold.scd2_merge(spark, tmp_root, first, first, "hk", ORDER, ["nome"], "load_date", buckets=8)

    def files():
        root = tmp_root.removeprefix("file:")
        return {d: sorted(f for f in os.listdir(f"{root}/{d}") if f.endswith(".parquet")) for d in os.listdir(root) if d.startswith("part=")}

    before = files()
    batch = spark.createDataFrame([("k3", T0 + dt.timedelta(days=1), 100, "b")], SAT)
    gold.scd2_merge(spark, tmp_root, batch, first.unionByName(batch), "hk", ORDER, ["nome"], "load_date", buckets=8)
    after = files()
    assert set(before) == set(after) and sum(before[d] != after[d] for d in before) == 1
    k3 = gold.read_scd2(spark, tmp_root).where("hk = 'k3'").orderBy("load_date").collect()
    assert [(r.nome, r.valid_to, r.is_current) for r in k3] == [("a", T0 + dt.timedelta(days=1), False), ("b", None, True)]


def test_a_late_row_splits_a_stored_interval(spark, tmp_root):
    day = [T0 + dt.timedelta(days=d) for d in range(6)]
    first = spark.createDataFrame([("k", day[0], 0, "a"), ("k", day[2], 2, "a"), ("k", day[4], 4, "a")], SAT)
    gold.scd2_merge(spark, tmp_root, first, first, "hk", ORDER, ["nome"], "load_date")
    late = spark.createDataFrame([("k", day[1], 1, "b"), ("k", day[3], 3, "a")], SAT)
    gold.scd2_merge(spark, tmp_root, late, first, "hk", ORDER, ["nome"], "load_date")
    got = [(r.nome, r.valid_from, r.valid_to) for r in gold.read_scd2(spark, tmp_root).orderBy("valid_from").collect()]
    assert got == [("a", day[0], day[1]), ("b", day[1], day[2]), ("a", day[2], None)]


# ------------------------------------------------------------------ carried values and point in time
def test_carried_value_equals_a_plain_window(spark):
    df = spark.createDataFrame(_history(3), SAT).repartition(5)
    w = Window.partitionBy("hk").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value = F.when(F.col("nome") == "a", F.col("event_id"))
    plain = df.withColumn("last_a", F.last(value, ignorenulls=True).over(w))
    assert sorted(with_carried(df, ["hk"], ORDER, "last_a", value).collect(), key=str) == sorted(plain.collect(), key=str)


def test_point_in_time_equals_a_state_per_date(spark):
    rows = [(k, T0.date() + dt.timedelta(days=d), i, v) for i, (k, d, v) in enumerate(
        [("a", 0, 1), ("a", 0, 2), ("a", 5, 3), ("b", 9, 4), ("b", 40, 5), ("c", 100, 6), (None, 2, 7)] + [("hot", d % 30, d) for d in range(400)])]
    versions = spark.createDataFrame(rows, "k string, day date, n long, v long").repartition(4)
    asked = [T0.date() + dt.timedelta(days=d) for d in (0, 4, 5, 31, 31, 60)]
    dates = spark.createDataFrame([(d,) for d in [*asked, None]], "at date")
    got = {(r.k, r["at"], r.n, r.v) for r in vault.point_in_time(versions, dates, "k", "day", ["day", "n"], "at").collect()}
    want = set()
    for d in set(asked):
        for k in {r[0] for r in rows}:
            past = [r for r in rows if r[0] == k and r[1] <= d]
            if past:
                best = max(past, key=lambda r: (r[1], r[2]))
                want.add((k, d, best[2], best[3]))
    assert got == want


def test_point_in_time_has_no_product_before_the_join(spark):
    versions = spark.createDataFrame([("a", T0.date(), 1, 1)], "k string, day date, n long, v long")
    dates = spark.createDataFrame([(T0.date(),)], "at date")
    text = plan_text(vault.point_in_time(versions, dates, "k", "day", ["day", "n"], "at"))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
