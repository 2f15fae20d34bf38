import datetime as dt

from pyspark.sql import functions as F

from lakevault.functions import (
    cpf_is_valid,
    currency_label,
    hash_key,
    hashdiff,
    link_key,
    mask_tax_id,
    parse_date_text,
    parse_nested_text,
    pseudonym,
    tolerant_double,
)


def test_tolerant_cast(spark):
    df = spark.createDataFrame([("1.5",), (" 1.5 ",), ("1,5",), ("[{'a'",), (None,)], "v string")
    got = [r.x for r in df.select(tolerant_double("v").alias("x")).collect()]
    assert got == [1.5, 1.5, None, None, None]


def test_date_text(spark):
    df = spark.createDataFrame([("01/03/2024",), ("xx",), (None,)], "v string")
    got = [r.d for r in df.select(parse_date_text("v").alias("d")).collect()]
    assert got == [dt.date(2024, 3, 1), None, None]


def test_hash_keys_match_known_digests(spark):
    df = spark.createDataFrame([(259797,), (None,)], "k int")
    rows = df.select(hash_key("k").alias("m"), hash_key("k", "sha256").alias("s")).collect()
    import hashlib

    assert rows[0].m == hashlib.md5(b"259797").hexdigest()
    assert rows[0].s == hashlib.sha256(b"259797").hexdigest()
    assert rows[1].m is None and rows[1].s is None


def test_link_key_tells_tuples_apart(spark):
    import hashlib

    df = spark.createDataFrame([("1", "2"), ("1|1:2", ""), ("1", "|2"), (None, "2"), ("p|q", "r"), ("p", "q|r")], "a string, b string")
    keys = [r.h for r in df.select(link_key("a", "b").alias("h")).collect()]
    assert keys[0] == hashlib.md5(b"1:1|1:2").hexdigest()
    assert keys[3] is None and len(set(keys)) == 6


def test_mask_covers_punctuated_ids(spark):
    df = spark.createDataFrame([("123.456.789-09",), ("12345678909",), ("12.345.678/0001-95",), (None,)], "id string")
    assert [r.m for r in df.select(mask_tax_id("id").alias("m")).collect()] == [
        "***456789**", "***456789**", "12.345.678/0001-95", None
    ]


def test_nested_text_knows_the_literals_words(spark):
    from lakevault.functions import nested_text_failed

    rows = ["[{'k': None, 't': 'x'}]", "[{'k': True, 't': 'None and True'}]", "[{'k': False, 't': \"it's None\"}]", "[{'k'", None]
    df = spark.createDataFrame([(r,) for r in rows], "s string")
    ddl = "array<struct<k:boolean,t:string>>"
    got = df.select(parse_nested_text("s", ddl).alias("v"), nested_text_failed("s", ddl).alias("f")).collect()
    assert [None if r.v is None else tuple(r.v[0]) for r in got] == [(None, "x"), (True, "None and True"), (False, "it's None"), None, None]
    assert [r.f for r in got] == [False, False, False, True, False]


def test_hashdiff_keeps_null_positions_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", None)], "x string, y string")
    hs = [r.h for r in df.select(hashdiff("x", "y").alias("h")).collect()]
    assert hs[0] != hs[1]
    assert hs[0] == hs[2]


def test_cpf_rule(spark):
    # 529.982.247-25 is the common textbook example of a valid CPF
    df = spark.createDataFrame(
        [("52998224725",), ("52998224724",), ("11111111111",), ("123",), (None,)], "v string"
    )
    got = [r.ok for r in df.select(cpf_is_valid("v").alias("ok")).collect()]
    assert got == [True, False, False, False, False]


def test_mask_keeps_company_ids(spark):
    df = spark.createDataFrame([("12306682899",), ("90479965000100",)], "v string")
    got = [r.m for r in df.select(mask_tax_id("v").alias("m")).collect()]
    assert got == ["***066828**", "90479965000100"]


def test_pseudonym_is_salted_sha256(spark):
    import hashlib

    df = spark.createDataFrame([("Ana",)], "v string")
    assert df.select(pseudonym("v", "s1").alias("p")).first().p == hashlib.sha256(b"s1Ana").hexdigest()


def test_currency_label(spark):
    df = spark.createDataFrame([(1234567.891,), (-5.5,)], "v double")
    got = [r.c for r in df.select(currency_label("v").alias("c")).collect()]
    assert got == ["R$ 1,234,567.89", "R$ -5.50"]


def test_nested_text(spark):
    df = spark.createDataFrame([("[{'municipio_ibge': '420170', 'n': 2}]",)], "v string")
    row = df.select(F.inline(parse_nested_text("v", "array<struct<municipio_ibge:string,n:int>>"))).first()
    assert (row.municipio_ibge, row.n) == ("420170", 2)
