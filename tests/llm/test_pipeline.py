"""The pipeline and the SQL of the queries on a whole small table."""

from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from lakevault.llm.queries import ORACLE_SQL, QUERIES
from lakevault.llm.tokens import END_ID, tokenizer_path
from lakevault.session import scratch_path
from tests.llm.helpers import SF, awkward, empty, hits, measured, near_groups, without_repeats


@pytest.mark.parametrize("name", sorted(k for k, v in ORACLE_SQL.items() if v))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    want = con.sql(ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    a = Counter(tuple(r[c] for c in columns) for r in got.collect())
    at = [want.columns.index(c) for c in columns]
    assert a == Counter(tuple(r[i] for i in at) for r in want.fetchall())


def plain_stages(rows: list[dict], benchmark: dict) -> list[list[dict]]:
    """The rows after each of the first four stages, by brute force."""
    out = []

    def failed(text):
        n, _, _, _, repeat = measured(text)
        return n < 50 or 100 * repeat > 50 * n

    rows = [r for r in rows if not failed(r["text"])]  # no source of the table is bad as a whole
    out.append(rows)
    groups = near_groups({r["doc_id"]: r["text"] for r in rows}, percent=80)
    rows = [r for r in rows if groups[r["doc_id"]] == r["doc_id"]]
    out.append(rows)
    rows = sorted(rows, key=lambda r: r["doc_id"])
    kept = without_repeats([(r["doc_id"], r["text"]) for r in rows])
    rows = [r | {"words": w} for r, (_, w) in zip(rows, kept, strict=True)]
    out.append(rows)
    rows = [r for r in rows if not hits(" ".join(r["words"]), benchmark)[1]]
    out.append(rows)
    return out


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    want = plain_stages([r.asDict() for r in docs.collect()], benchmark)
    last = None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(path := f"{tmp_path}/{name}")
        last = spark.read.parquet(path)
        if k < 4:
            rows = {r.doc_id: r for r in last.collect()}
            assert last.columns == docs.columns and set(rows) == {r["doc_id"] for r in want[k]} and last.count() == len(rows)
            for r in want[k]:
                got = rows[r["doc_id"]]
                assert got.text.split() == r["words"] if k > 1 else got.text == r["text"]
                assert got.n_chars == len(got.text) and (got.lang, got.source) == (r["lang"], r["source"])
            docs = last
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(f"{tokenizer_path()}.json")
    ids = {r.doc_id: [*tokenizer.encode(r.text, add_special_tokens=False).ids, END_ID] for r in docs.collect()}
    found = {k: [None] * len(v) for k, v in ids.items()}
    for p in last.collect():
        assert p.doc_tokens == len(ids[p.doc_id]) and p.length == len(p.ids)
        found[p.doc_id][p.start : p.start + p.length] = p.ids
    assert found == ids  # every id of every kept text is in a piece, once, at its place


def test_run_is_the_stages_in_a_row(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_substrings", "decontamination", "packing"]
    assert QUERIES["pipeline"](spark, SF).count() > 0


@pytest.mark.parametrize("which", ["awkward", "empty"])
def test_stages_take_awkward_rows(spark, tmp_path, which):
    frame = awkward(spark) if which == "awkward" else empty(spark)
    frame.write.parquet(f"{tmp_path}/in")
    docs = start = spark.read.parquet(f"{tmp_path}/in")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert out.columns == start.columns and [f.dataType for f in out.schema] == [f.dataType for f in start.schema]
            # and each stage also copes with rows that an earlier one would have taken out
            stage(spark, start, SF).count()
        docs = out
    if which == "awkward":
        assert docs.count() > 0 and np.all([p.length > 0 for p in docs.collect()])
    else:
        assert docs.count() == 0


def test_texts_just_below_the_threshold_make_few_pairs(spark, monkeypatch):
    """Near copies that share their edits, but too few of them, are told apart before any texts meet."""
    import random

    from lakevault.llm import near_dedup

    dice = random.Random(8)
    base = [f"w{k}" for k in range(200)]
    texts = {}
    for k in range(300):
        words = list(base)
        for at in dice.sample(range(200), 7):
            words[at] = f"x{dice.randint(0, 2)}"  # an edit that many others make too
        texts[k] = " ".join(words)
    pairs = []
    real = near_dedup._confirm

    def counted(some, *args):
        pairs.append(some.count())
        return real(some, *args)

    monkeypatch.setattr(near_dedup, "_confirm", counted)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    df.write.parquet(path := scratch_path(spark, "below"))
    _, rows = near_dedup.link_near_duplicates(spark.read.parquet(path))
    got = {r.id: r.component_id for r in rows.collect()}
    assert got == near_groups(texts) and sum(pairs) <= 30 * len(texts)
