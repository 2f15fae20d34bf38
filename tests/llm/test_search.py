"""Ranked search against its SQL, with segments, buckets and query parts of every size."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from lakevault.llm import search
from tests.llm.helpers import SF, awkward, empty

QUERIES = "item_id long, text string"


def by_sql(docs, items) -> list:
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    con.register("benchmark", items.select("item_id", "text").toArrow())
    return sorted(con.execute(search.ORACLE_OP12).fetchall(), key=str)


def rows(df) -> list:
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def zipf_docs(spark, n=600):
    """Many documents of a few lengths, so that strata are large and scores tie."""
    dice = random.Random(3)
    vocabulary = [f"t{k}" for k in range(200)]
    texts = [" ".join(vocabulary[min(199, int(dice.paretovariate(0.6)) - 1)] for _ in range(dice.choice([5, 5, 5, 9, 40]))) for _ in range(n)]
    ids = list(range(n))
    dice.shuffle(ids)
    return spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(5)


def some_queries(spark):
    texts = ["t0 t1 t2", "t7 T9 t9 t150", "t199", "zzz", "", None, " .,; ", "t3 t3 t3 t4", "t3 t3 t3 t4", "t0 " * 400]
    df = spark.createDataFrame([(k if k != 4 else None, t) for k, t in enumerate(texts)] + [(0, "t0 t1 t2")], QUERIES)
    return df.select("*", *[F.lit(1).alias(c) for c in ("key", "rank", "score", "terms", "n")])


@pytest.mark.parametrize(("segment", "bucket", "part"), [(300, 500, 3), (1 << 19, 1 << 22, 100_000), (1, 50, 5)])
def test_ranks_equal_sql(spark, segment, bucket, part):
    docs, items = zipf_docs(spark), some_queries(spark)
    index = search.build_index(docs, segment_postings=segment, bucket_terms=bucket)
    assert rows(search.search(index, items, part_terms=part)) == by_sql(docs, items)
    held = [r.ids for r in index.segments.select("ids").collect()]
    assert sorted(i for ids in held for i in ids) == list(range(600))  # every document is in one segment


def test_strata_hold_equal_m_and_postings_by_falling_tf(spark):
    index = search.build_index(zipf_docs(spark), segment_postings=2000)
    for r in index.segments.collect():
        assert r.m == sorted(set(r.m)) and len(r.stratum) == len(r.ids) and sum(r.df) == len(r.docs)
        for t, first in enumerate(r.first_run):
            last = r.first_run[t + 1] if t + 1 < len(r.first_run) else len(r.run_tf)
            runs = [(r.run_stratum[k], -r.run_tf[k]) for k in range(first, last)]
            assert runs == sorted(set(runs))  # one run, so one impact, for each tf of a stratum


def test_awkward_documents(spark):
    docs = awkward(spark).select("doc_id", "text", *[F.lit(0).alias(c) for c in ("m", "id", "bucket", "ids")])
    items = spark.createDataFrame([(1, "word1 of2 x"), (2, "é ü ß q"), (3, "line one here a b c")], QUERIES)
    found = rows(search.search(search.build_index(docs), items))
    want = by_sql(docs, items)
    assert [r[:1] + r[2:] for r in found] == [r[:1] + r[2:] for r in want] or sorted(found, key=str) == want


def test_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.createDataFrame([(1, "a")], QUERIES)
    assert search.op12_search(empty(spark), items).count() == 0
    assert search.op12_search(docs, items.limit(0)).count() == 0
