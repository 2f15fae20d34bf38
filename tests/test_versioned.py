import os

import pytest
from pyspark.sql import functions as F

from lakevault.operators.privacy import forget_subjects
from lakevault.sources import versioned
from lakevault.sources.versioned import SchemaMismatchError, TableExistsError, VersionedTable


def _ids(df, c="id"):
    return sorted(r[c] for r in df.collect())


def _frame(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id long")


def test_overwrite_append_and_earlier_states(spark, tmp_root):
    t = VersionedTable(spark, tmp_root)
    assert t.write(_frame(spark, 1, 2), mode="overwrite") == "v0000000000" and t.last_num_rows == 2
    assert t.write(_frame(spark, 3), mode="append") == "v0000000001"
    assert _ids(t.read()) == [1, 2, 3] and _ids(t.read(as_of=0)) == [1, 2]
    t.write(_frame(spark, 4), mode="overwrite")
    assert _ids(t.read()) == [4] and _ids(t.read(as_of=1)) == [1, 2, 3]
    assert _ids(t.read_load("v0000000002")) == [4]
    t.drop_old_snapshots()
    assert _ids(t.read()) == [4]
    with pytest.raises(FileNotFoundError):
        t.read(as_of=1)


def test_a_named_load_is_written_once(spark, tmp_root):
    t = VersionedTable(spark, tmp_root)
    for _ in range(2):
        t.write(_frame(spark, 1), load_id="day/2024-01-01")
        t.write(_frame(spark, 2), load_id="2024")
    assert _ids(t.read()) == [1, 2] and len(t.loads()) == 2


def test_create_fails_when_table_exists(spark, tmp_root):
    t = VersionedTable(spark, tmp_root)
    t.write(_frame(spark, 1), mode="errorifexists")
    with pytest.raises(TableExistsError):
        t.write(_frame(spark, 1), mode="errorifexists")


def test_schema_change_needs_overwrite_schema(spark, tmp_root):
    t = VersionedTable(spark, tmp_root)
    v0 = spark.createDataFrame([(1, "10.5", "x")], "codigo long, valor_projeto string, extra string")
    v1 = spark.createDataFrame([(1, 10.5)], "codigo long, valor_projeto double")
    t.write(v0, mode="overwrite")
    for mode in ("append", "overwrite"):
        with pytest.raises(SchemaMismatchError):
            t.write(v1, mode=mode)
    t.write(v1, mode="overwrite", overwrite_schema=True)
    assert dict(t.read().dtypes)["valor_projeto"] == "double"
    old = t.read(as_of=0)
    assert dict(old.dtypes)["valor_projeto"] == "string" and "extra" in old.columns


def test_an_unfinished_snapshot_is_invisible_and_its_retry_replaces_it(spark, tmp_root):
    t = VersionedTable(spark, tmp_root)
    t.write(_frame(spark, 1), mode="overwrite")
    crashed = f"{tmp_root}/base=v0000000001/load=v0000000001"
    _frame(spark, 99).write.parquet(crashed)
    versioned._Folder(spark, f"{crashed}/_SUCCESS").delete()
    assert _ids(t.read()) == [1]
    t.write(_frame(spark, 2), mode="overwrite")
    assert _ids(t.read()) == [2]


def test_compact_keeps_content(spark, tmp_root):
    t = VersionedTable(spark, tmp_root)
    for i in range(4):
        t.write(_frame(spark, i))
    t.compact()
    assert _ids(t.read()) == [0, 1, 2, 3] and len(t.loads()) == 1


@pytest.fixture()
def no_marks(spark):
    """Spark's committer leaves no marks, as is usual on object stores."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    yield
    conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_loads_do_not_depend_on_the_committers_marks(spark, tmp_root, no_marks):
    t = VersionedTable(spark, tmp_root)
    t.write(_frame(spark, 1))
    t.write(_frame(spark, 2))
    assert t.exists() and _ids(t.read()) == [1, 2] and len(t.loads()) == 2
    t.write(_frame(spark, 3, 4, 5))
    forget_subjects(t, _frame(spark, 4), "id")
    assert _ids(t.read()) == [1, 2, 3, 5] and len(t.loads()) == 3


def test_read_and_loads_agree_on_an_incomplete_load(spark, tmp_root):
    t = VersionedTable(spark, tmp_root)
    t.write(_frame(spark, 1))
    crashed = t.write(_frame(spark, 2))
    t.write(_frame(spark, 3))
    versioned._Folder(spark, f"{tmp_root}/base=v0000000000/load={crashed}/_SUCCESS").delete()
    assert t.loads() == ["v0000000000", "v0000000002"]
    assert _ids(t.read()) == [1, 3] and _ids(t.read(as_of=1)) == [1]
    t.write(_frame(spark, 4))  # never into a folder that is there
    assert _ids(t.read()) == [1, 3, 4] and t.loads()[-1] == "v0000000003"


def test_time_travel_counts_named_loads(spark, tmp_root):
    t = VersionedTable(spark, tmp_root)
    t.write(_frame(spark, 1))
    assert t.write(_frame(spark, 2), load_id="first/α " + "x" * 300).startswith("v0000000001.")
    t.write(_frame(spark, 3), load_id="b")
    assert [_ids(t.read(as_of=k)) for k in range(3)] == [[1], [1, 2], [1, 2, 3]]
    assert t.write(_frame(spark, 9), load_id="b") == "v0000000002.b" and _ids(t.read()) == [1, 2, 3]


def test_the_column_name_load_is_refused(spark, tmp_root):
    t = VersionedTable(spark, tmp_root)
    with pytest.raises(ValueError, match="load"):
        t.write(spark.createDataFrame([(1, 2)], "a long, load long"))


def test_a_table_without_any_mark_is_not_written_over(spark, tmp_root):
    _frame(spark, 1, 2).write.parquet(f"{tmp_root}/base=v0000000000/load=v0000000000")
    versioned._Folder(spark, f"{tmp_root}/base=v0000000000/load=v0000000000/_SUCCESS").delete()
    t = VersionedTable(spark, tmp_root)
    with pytest.raises(versioned.UnmarkedTableError):
        t.write(_frame(spark, 3))
    t.adopt_loads()
    t.write(_frame(spark, 3))
    assert _ids(t.read()) == [1, 2, 3]


def test_an_empty_append_can_be_taken_back(spark, tmp_root):
    t = VersionedTable(spark, tmp_root)
    assert t.write(_frame(spark, 1).limit(0), keep_empty=False) == "v0000000000"  # it creates the table
    assert t.write(_frame(spark, 1).limit(0), keep_empty=False) is None and len(t.loads()) == 1
    assert t.write(_frame(spark, 1)) == "v0000000001" and _ids(t.read()) == [1]


# ------------------------------------------------------------------ erasure
def _two_loads(spark, root):
    t = VersionedTable(spark, root)
    t.write(spark.createDataFrame([(1, 3), (2, 4)], "id long, user_id long"), mode="overwrite")
    t.write(spark.createDataFrame([(3, 3)], "id long, user_id long"))
    t.write(spark.createDataFrame([(4, 5), (5, 3)], "id long, user_id long"), mode="overwrite")
    return t


def _stored_users(spark, root):
    """All user ids in any Parquet file below the table's folder."""
    local = root.removeprefix("file:")
    files = [os.path.join(d, f) for d, _, names in os.walk(local) for f in names if f.endswith(".parquet")]
    found = set()
    for f in files:
        df = spark.read.parquet("file:" + f)
        found |= {r.user_id for r in df.select("user_id").collect()} if "user_id" in df.columns else set()
    return found


def test_erasure_reaches_every_snapshot(spark, tmp_root):
    t = _two_loads(spark, tmp_root)
    crashed = f"{tmp_root}/base=v0000000002/load=v0000000009"  # a write that never completed
    spark.createDataFrame([(9, 3)], "id long, user_id long").write.parquet(crashed)
    versioned._Folder(spark, f"{crashed}/_SUCCESS").delete()
    gone = spark.createDataFrame([(3,)], "user_id long")
    forget_subjects(t, gone, "user_id")
    assert _ids(t.read()) == [4] and _ids(t.read(as_of=1)) == [2]
    assert _stored_users(spark, tmp_root) == {4, 5}
    t.write(spark.createDataFrame([(6, 6)], "id long, user_id long"))
    assert _ids(t.read()) == [4, 6]
    forget_subjects(t, spark.createDataFrame([(77,)], "user_id long"), "user_id")
    assert _ids(t.read()) == [4, 6]


def test_erasure_keeps_unmarked_loads_and_their_state(spark, tmp_root):
    t = VersionedTable(spark, tmp_root)
    t.write(_frame(spark, 1, 2))
    name = t.write(_frame(spark, 2, 3))
    mark = versioned._Folder(spark, f"{tmp_root}/base=v0000000000/load={name}/_SUCCESS")
    mark.delete()
    forget_subjects(t, _frame(spark, 2), "id")
    assert _ids(t.read()) == [1] and not mark.exists()
    t.adopt_loads()
    assert _ids(t.read()) == [1, 3]


@pytest.mark.parametrize("crash_at", [0, 1, 2, 3, 4, 5, 6, 7, 8])
def test_erasure_finishes_after_a_failure(spark, tmp_root, monkeypatch, crash_at):
    t = _two_loads(spark, tmp_root)
    gone = spark.createDataFrame([(3,)], "user_id long")
    calls = {"n": -1}
    for name in ("delete", "mark_complete"):
        real = getattr(versioned._Folder, name)

        def flaky(self, real=real):
            calls["n"] += 1
            if calls["n"] == crash_at:
                raise OSError("simulated failure")
            return real(self)

        monkeypatch.setattr(versioned._Folder, name, flaky)
    try:
        forget_subjects(t, gone, "user_id")
    except OSError:
        forget_subjects(t, gone, "user_id")
    assert _ids(t.read()) == [4] and _ids(t.read(as_of=1)) == [2]
    assert _stored_users(spark, tmp_root) == {4, 5}
