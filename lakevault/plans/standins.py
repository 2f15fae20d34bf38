"""Every operator bound to the driver's tables (see SURVEY Appendix A).

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole input tables. Operators that are loads (sinks, versioned tables,
merges, streams) really write and re-read their tables in a fresh folder
under the shared checkpoint root.
"""

from __future__ import annotations

import datetime as _dt
import time
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.functions import (
    cpf_is_valid,
    currency_label,
    hash_key,
    mask_tax_id,
    parse_date_text,
    parse_nested_text,
    pseudonym,
    tolerant_double,
)
from lakevault.operators import bronze, catalog, gold, marts, privacy, quality, vault
from lakevault.operators.incremental import DistinctMart, SummedMart
from lakevault.plans import medallion as md
from lakevault.session import scratch_path
from lakevault.sources.bucketed import BucketedTable
from lakevault.sources.csv import read_csv_infer, read_csv_robust, write_csv
from lakevault.sources.formats import read_source, write_source
from lakevault.sources.landing import land_partitioned, read_day
from lakevault.sources import paged
from lakevault.sources.paged import read_page_files, write_page_files
from lakevault.sources.registry import SourceRegistry, cost_based
from lakevault.sources.versioned import VersionedTable
from lakevault.streaming import ingest as streams

# Fixed parameters of the stand-in scenarios (SURVEY Appendix A).
SPLIT_T = "2024-01-16 00:00:00"  # batch 1 = ts < T, batch 2 = the rest (or all rows)
LOAD_TS = "2024-02-01 00:00:00"  # load stamp literal
LOAD_TS_2 = "2024-02-02 00:00:00"  # second batch stamp
ACTIVE_SINCE = "2001-01-01 00:00:00"
EARLY_END = "2024-01-08 00:00:00"  # end of the first batch of the merged dimension
FIRST_DAY_END = "2024-01-02 00:00:00"  # end of the initial hub load


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def _before_t(df, col="ts"):
    return df.where(F.col(col) < vault.ts_literal(SPLIT_T))


def _from_t(df, col="ts"):
    return df.where(F.col(col) >= vault.ts_literal(SPLIT_T))


def _stored_sat(spark, sf_dir) -> VersionedTable:
    """The events satellite, written once (append of every row)."""
    t = VersionedTable(spark, scratch_path(spark, "sat"))
    vault.sat_append_all(t, md.event_sat_rows(_events(spark, sf_dir)))
    return t


# ----------------------------------------------------------------- sources / sinks
def csv_robust_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = scratch_path(spark, "csv_robust")
    write_csv(docs, path)
    return read_csv_robust(spark, path, docs.schema)


def csv_infer_schema(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "csv_infer")
    write_csv(orders, path)
    return read_csv_infer(spark, path).select("o_orderkey", "o_orderstatus", "o_totalprice")


def csv_roundtrip_sink(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = f"{scratch_path(spark, 'csv_sink')}/customer_{int(time.time())}"
    write_csv(cust, path)
    return read_csv_robust(spark, path, cust.schema)


def multi_format_scan(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    root = scratch_path(spark, "formats")
    out = None
    for fmt in ("json", "csv", "parquet"):
        write_source(nation, fmt, f"{root}/{fmt}")
        part = read_source(spark, fmt, f"{root}/{fmt}", schema=nation.schema).select(
            F.lit(fmt).alias("fmt"), "n_nationkey", "n_name"
        )
        out = part if out is None else out.unionByName(part)
    return out


def paged_json_unwrap(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    path = scratch_path(spark, "pages")
    write_page_files(cust, path, key="c_custkey", page_size=100)
    return read_page_files(spark, path, cust.schema).select("c_custkey", "c_name")


def paged_extract(spark, sf_dir):
    """An extract of unknown length from page addresses, stopped after two pages and taken up again."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    root = scratch_path(spark, "extract")
    size = 100
    offset = F.floor((F.col("c_custkey") - cust.select(F.min("c_custkey")).scalar()) / size) * size
    rows = F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))).alias("projetos")
    pages = cust.groupBy(offset.alias("offset")).agg(rows)
    # a file per page, at some 30 ms each: many tasks write them and move their own
    site = pages.select("offset", F.to_json(F.struct(F.struct("projetos").alias("_embedded"))).alias("value"))
    site = site.repartition(48, "offset").write.partitionBy("offset")
    site.option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(f"{root}/site")
    address = (root if ":" in root else f"file://{root}") + "/site/offset={offset}"
    args = (spark, address, f"{root}/landed", cust.schema, size)
    paged.resume_extract(*args, pages=2)
    paged.finish_extract(*args, pages=100)
    return paged.read_extract(spark, f"{root}/landed", cust.schema)


def bronze_ingest_stamp(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    path = scratch_path(spark, "bronze")
    bronze.stamp_ingest(orders, LOAD_TS, "data_carga").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def landing_partitioned(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "ts")
    path = scratch_path(spark, "landing")
    land_partitioned(ev, path, "ts")
    return read_day(spark, path, _dt.date(2024, 1, 5)).select("event_id", "year", "month", "day")


def source_registry_sql(spark, sf_dir):
    reg = SourceRegistry(spark)
    reg.add("tpch.nation", lambda: table(spark, sf_dir, "nation"))
    reg.add("tpch.region", lambda: table(spark, sf_dir, "region"))
    return reg.sql(
        "SELECT r_name, count(*) AS n FROM {{ source('tpch', 'nation') }} "
        "JOIN {{ source('tpch', 'region') }} ON n_regionkey = r_regionkey GROUP BY r_name"
    )


def load_counts(spark, sf_dir):
    root = scratch_path(spark, "counts")
    counted = []
    for name in ("orders", "customer"):
        t = VersionedTable(spark, f"{root}/{name}")
        t.write(table(spark, sf_dir, name), mode="overwrite")
        counted.append((name, t.last_num_rows))  # observed while writing
    return spark.createDataFrame(counted, "tbl string, n bigint")


# ----------------------------------------------------------------- bronze rules
def ingest_checksum(spark, sf_dir):
    # the second column is null for one kind of event, the third holds separators
    ev = _events(spark, sf_dir).withColumns(
        {
            "kind": F.when(F.col("event_type") != "view", F.col("event_type")),
            "detail": F.concat_ws("|", "event_type", "props"),
        }
    )
    root = scratch_path(spark, "checksum")
    t, sets = VersionedTable(spark, f"{root}/rows"), VersionedTable(spark, f"{root}/sets")
    cols = ["event_id", "kind", "detail"]
    for batch in (_before_t(ev), ev, ev):  # the last one re-ingests what is stored
        bronze.ingest_by_checksum(t, batch, cols, bitmap=sets)
    return t.read().select("event_id", "checksum")


def ingest_high_watermark(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "ts")
    t = VersionedTable(spark, scratch_path(spark, "hwm"))
    held = [bronze.ingest_newer(t, batch, "ts") for batch in (_before_t(ev), ev, ev)]
    stored = t.read().select("event_id", "ts", F.lit("stored").alias("side"))
    return stored.unionByName(held[1].select("event_id", "ts", F.lit("held back").alias("side")))


def ingest_metadata(spark, sf_dir):
    return bronze.with_ingest_metadata(_events(spark, sf_dir), "EVENTS_PARQUET", "parquet").select(
        "event_id", "record_source", "source_format"
    )


def normalize_dates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    # day-first date text; pending orders carry malformed text, which becomes null
    text = F.when(F.col("o_orderstatus") == "P", F.lit("xx/xx/xxxx")).otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy")
    )
    return orders.select("o_orderkey", parse_date_text(text).alias("o_date"))


def _contract(spark, sf_dir):
    """Customers under a domain and a type contract; the balance comes as text, malformed for one segment."""
    balance = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.col("c_acctbal").cast("string"), F.lit(" USD")))
    cust = table(spark, sf_dir, "customer").withColumn("balance", F.coalesce(balance, F.col("c_acctbal").cast("string")))
    rules = {"negative_balance": F.col("c_acctbal") < 0, "bad_segment": F.col("c_mktsegment") == "MACHINERY"}
    return bronze.contract_split(cust, rules, {"balance": "double"})


def contract_split(spark, sf_dir):
    return _contract(spark, sf_dir)[1].select("c_custkey", "reasons")


def contract_valid(spark, sf_dir):
    return _contract(spark, sf_dir)[0].select("c_custkey", "balance")


def _tax_ids(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    tid = F.concat(
        F.lpad((F.col("c_custkey") * 7919).cast("string"), 9, "0"),
        F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0"),
    )
    return cust.withColumn("id", tid)


def contract_tax_id(spark, sf_dir):
    return _tax_ids(spark, sf_dir).where(cpf_is_valid("id")).select("c_custkey", "id")


def nested_text_parse(spark, sf_dir):
    ev = _events(spark, sf_dir)
    text = F.concat(F.lit("["), F.regexp_replace("props", '"', "'"), F.lit("]"))
    parsed = ev.select("event_id", parse_nested_text(text, "array<struct<k:int>>").alias("_p"))
    return parsed.select("event_id", F.inline_outer("_p"))


def cast_tolerant(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return ev.select("event_id", tolerant_double(md.event_valor_raw(ev)).alias("valor"))


def dedupe_exact(spark, sf_dir):
    return bronze.dedupe_exact(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def dedupe_by_key_latest(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    latest = bronze.dedupe_latest(
        li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    )
    return latest.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey")


# ----------------------------------------------------------------- keys and vault
def hash_key_md5(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", hash_key("o_orderkey").alias("hk"))


def hash_key_sha256(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", hash_key("o_orderkey", "sha256").alias("hk"))


def hub_full_load(spark, sf_dir):
    t = VersionedTable(spark, scratch_path(spark, "hub"))
    hub, _rejects = vault.hub_rows(_events(spark, sf_dir), "user_id", "hk", LOAD_TS, "EVENTS")
    t.write(hub, mode="overwrite")
    return t.read().select("hk", "user_id", "load_date", "record_source")


def sat_full_load(spark, sf_dir):
    ev = _events(spark, sf_dir).withColumns({"nome": F.col("event_type"), "valor": F.col("value")})
    t = VersionedTable(spark, scratch_path(spark, "sat_full"))
    t.write(vault.sat_rows(ev, "user_id", ["nome", "valor"], load_date_col="ts"), mode="overwrite")
    return t.read().select("hk", "load_date", "nome", "valor")


def _buckets(spark) -> int:
    """As many buckets as a shuffle has partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hub_merge_insert_only(spark, sf_dir):
    ev = _events(spark, sf_dir)
    t = BucketedTable(spark, scratch_path(spark, "hub_merge"), "user_id", buckets=_buckets(spark))
    # initial load = the first day's events, then every event: keys already
    # in the hub keep their first stamp, the others are inserted
    vault.hub_load(t, ev.where(F.col("ts") < vault.ts_literal(FIRST_DAY_END)), "user_id", LOAD_TS, "EVENTS")
    vault.hub_load(t, ev, "user_id", LOAD_TS_2, "EVENTS")
    return t.read().select("hk", "user_id", "load_date")


def sat_append_all(spark, sf_dir):
    batch = md.event_sat_rows(_events(spark, sf_dir))
    t = VersionedTable(spark, scratch_path(spark, "sat_all"))
    vault.sat_append_all(t, batch.withColumn("load_no", F.lit(1)))
    vault.sat_append_all(t, batch.withColumn("load_no", F.lit(2)))
    return t.read().groupBy("user_id", "load_no").agg(F.count(F.lit(1)).alias("n"))


def _sat_changed(spark, sf_dir, batches):
    root = scratch_path(spark, "sat_changed")
    t, seen = VersionedTable(spark, f"{root}/sat"), VersionedTable(spark, f"{root}/seen")
    order, history = md.SAT_ORDER, md.event_sat_rows(_events(spark, sf_dir))
    for batch in batches:
        rows = md.event_sat_rows(batch)
        late = vault.sat_append_changed(t, rows, "hk", order, ["nome"], seen=seen)
        if not late.isEmpty():  # keys with late rows are stored anew from their whole history
            vault.sat_rebuild(t, history, late, "hk", order, ["nome"])
    return t.read().select("hk", "load_date", "nome")


def sat_append_changed(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return _sat_changed(spark, sf_dir, (_before_t(ev), _from_t(ev)))


def sat_append_changed_late(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return _sat_changed(spark, sf_dir, (_from_t(ev), _before_t(ev)))


def link_load(spark, sf_dir):
    # the second key holds the separator and is null for one flag: those rows are rejected
    flags = F.when(F.col("l_returnflag") != "N", F.concat_ws("|", "l_returnflag", "l_linestatus", "l_suppkey"))
    li = table(spark, sf_dir, "lineitem").withColumn("flags", flags)
    t = BucketedTable(spark, scratch_path(spark, "link"), ["l_orderkey", "flags"], buckets=_buckets(spark))
    first = li.where(F.col("l_shipdate") < vault.ts_literal("1998-01-01 00:00:00"))
    for batch in (first, li):
        links, _rejects = vault.link_rows(batch, ["l_orderkey", "flags"], "hk_link")
        vault.insert_new_keys(t, links, ["l_orderkey", "flags"])
    return t.read().select("hk_link", "l_orderkey", "flags")


def hub_multi_source(spark, sf_dir):
    return vault.hub_multi_source(
        [
            (table(spark, sf_dir, "customer"), "c_nationkey", "CUSTOMER"),
            (table(spark, sf_dir, "supplier"), "s_nationkey", "SUPPLIER"),
        ],
        key_name="k",
    )


def _cdc(spark, sf_dir, batches):
    t = VersionedTable(spark, scratch_path(spark, "cdc"))
    state = None
    for batch in batches:
        t.write(vault.cdc_apply(state, md.event_sat_rows(batch), ["hk"], md.SAT_ORDER, F.col("nome") == "error"), mode="overwrite")
        state = t.read()
    return vault.cdc_live(state).select("user_id", "nome", "load_date")


def cdc_apply(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return _cdc(spark, sf_dir, (_before_t(ev), _from_t(ev)))


def cdc_apply_out_of_order(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return _cdc(spark, sf_dir, (_from_t(ev), _before_t(ev), ev))


def cdc_merge_on_read(spark, sf_dir):
    """Changes appended in any order, resolved when read; folded once on the way."""
    ev = _events(spark, sf_dir)
    t = VersionedTable(spark, scratch_path(spark, "cdc_read"))
    for batch in (_from_t(ev), _before_t(ev)):
        vault.cdc_append_changes(t, md.event_sat_rows(batch), ["hk"], md.SAT_ORDER, F.col("nome") == "error")
    vault.cdc_compact(t, ["hk"], md.SAT_ORDER)
    vault.cdc_append_changes(t, md.event_sat_rows(ev), ["hk"], md.SAT_ORDER, F.col("nome") == "error")
    return vault.cdc_read_state(t, ["hk"], md.SAT_ORDER).select("user_id", "nome", "load_date")


def sat_as_of(spark, sf_dir):
    sat = _stored_sat(spark, sf_dir).read().select("hk", *md.SAT_ORDER, "nome")
    return vault.sat_as_of(sat, "hk", "load_date", SPLIT_T, md.SAT_ORDER).select("hk", "nome", "load_date")


def sat_point_in_time(spark, sf_dir):
    """Every customer's latest order as of every month end on which there is one."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("ordered"), "o_orderkey", "o_totalprice")
    ends = orders.select(F.last_day("ordered").alias("month_end"))
    return vault.point_in_time(orders, ends, "o_custkey", "ordered", ["ordered", "o_orderkey"], "month_end").select(
        "o_custkey", "month_end", "o_orderkey", "o_totalprice"
    )


def _two_version_table(spark, sf_dir) -> VersionedTable:
    ev = _events(spark, sf_dir).select("event_id", "user_id", "ts")
    t = VersionedTable(spark, scratch_path(spark, "versions"))
    t.write(_before_t(ev), mode="overwrite")
    t.write(_from_t(ev), mode="append")
    return t


def version_as_of(spark, sf_dir):
    return _two_version_table(spark, sf_dir).read(as_of=0).select("event_id", "user_id")


def table_history(spark, sf_dir):
    """What every load brought, the newest first: rows and span of the events in it."""
    rows = _two_version_table(spark, sf_dir).read(with_load=True)
    number = F.substring("load", 2, 10).cast("bigint").alias("version")
    history = rows.groupBy(number).agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return history.orderBy(F.desc("version"))


# ----------------------------------------------------------------- gold
def _silver(spark, sf_dir) -> md.Silver:
    return md.load_silver(spark, _events(spark, sf_dir), scratch_path(spark, "silver"), LOAD_TS)


def sat_latest(spark, sf_dir):
    return md.sat_latest(_stored_sat(spark, sf_dir).read(), ["user_id", "nome", "valor_raw"]).select(
        "hk", "user_id", "nome", "valor_raw", "load_date"
    )


def gold_dim_strict(spark, sf_dir):
    return md.gold_dimension(_silver(spark, sf_dir))


# the newest satellite row of each key, by one aggregate, beside its business key
GOLD_MODEL = """
SELECT keys.user_id                                            AS codigo,
       newest.state.nome                                       AS nome_projeto,
       coalesce(try_cast(newest.state.valor_raw AS double), 0) AS valor_projeto,
       newest.state.load_date                                  AS data_ultima_carga
FROM (SELECT hk, max_by(struct(nome, valor_raw, load_date), struct(load_date, event_id)) AS state
      FROM {{ source('silver', 'sat') }} GROUP BY hk) AS newest
JOIN {{ source('silver', 'hub') }} AS keys USING (hk)
"""


def gold_dim_coalesced(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    reg = SourceRegistry(spark)
    reg.add("silver.hub", silver.hub.read)
    reg.add("silver.sat", silver.sat.read)
    out = VersionedTable(spark, scratch_path(spark, "gold_model"))
    reg.materialize(GOLD_MODEL, out)
    return out.read()


# how often each user's newest state is that of its first days, by a model of named steps
STEPS_MODEL = """
WITH dated AS (
  SELECT hk, nome, load_date, event_id, min(load_date) OVER (PARTITION BY hk) AS since FROM {{ source('silver', 'sat') }}
),
begun AS (
  SELECT hk, max_by(nome, struct(load_date, event_id)) AS first_state FROM dated WHERE load_date < since + INTERVAL 3 DAYS GROUP BY hk
),
ended AS (
  SELECT hk, max_by(nome, struct(load_date, event_id)) AS last_state FROM dated GROUP BY hk
)
SELECT first_state, last_state, count(*) AS n
FROM begun JOIN ended USING (hk) JOIN {{ source('silver', 'hub') }} USING (hk)
GROUP BY first_state, last_state
"""


def gold_model_steps(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    reg = SourceRegistry(spark)
    reg.add("silver.hub", silver.hub.read)
    reg.add("silver.sat", silver.sat.read)
    out = VersionedTable(spark, scratch_path(spark, "gold_steps"))
    reg.materialize(STEPS_MODEL, out)
    return out.read()


def gold_schema_replace(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    t = VersionedTable(spark, scratch_path(spark, "gold"))
    v0 = gold.current_dimension(
        silver.hub.read(), silver.sat.read(), "hk", md.SAT_ORDER,
        {
            "codigo": F.col("key.user_id"),
            "nome_projeto": F.col("state.nome"),
            "valor_aprovado": F.col("state.valor_raw"),
            "valor_projeto": F.col("state.valor_raw"),
            "data_ultima_carga": F.col("state.load_date"),
        },
    )
    t.write(v0, mode="overwrite")
    t.write(md.gold_dimension(silver), mode="overwrite", overwrite_schema=True)
    return t.read().select("codigo", "valor_projeto")


def raw_to_gold(spark, sf_dir):
    """Raw CSV extract -> bronze -> vault -> gold."""
    ev = _events(spark, sf_dir)
    root = scratch_path(spark, "raw_to_gold")
    write_csv(ev.repartition(4), f"{root}/raw/events_{int(time.time())}")
    stored = VersionedTable(spark, f"{root}/bronze")
    md.ingest_bronze(spark, f"{root}/raw/events_*", ev.schema, stored, LOAD_TS)
    silver = md.load_silver(spark, stored.read().drop("data_carga_bronze"), f"{root}/silver", LOAD_TS)
    return md.gold_dimension(silver)


def gold_top10(spark, sf_dir):
    return md.gold_top(md.gold_dimension(_silver(spark, sf_dir)), 10)


def gold_top15(spark, sf_dir):
    return md.gold_top(md.gold_dimension(_silver(spark, sf_dir)), 15)


def dim_scd2(spark, sf_dir):
    d = gold.scd2_of(_stored_sat(spark, sf_dir).read(), "hk", md.SAT_ORDER, ["nome"], "load_date")
    return d.select("hk", "nome", "valid_from", "valid_to", "is_current")


def dim_scd2_merge(spark, sf_dir):
    """The dimension kept by merges: the first days, the last days, and then, late, those between."""
    ev = _events(spark, sf_dir)
    root = scratch_path(spark, "scd2_merge")
    early, late = F.col("ts") < vault.ts_literal(EARLY_END), F.col("ts") < vault.ts_literal(SPLIT_T)
    sat = VersionedTable(spark, f"{root}/sat")
    for batch in (ev.where(early), ev.where(~late), ev.where(~early & late)):
        rows = md.event_sat_rows(batch)
        vault.sat_append_all(sat, rows)
        gold.scd2_merge(spark, f"{root}/dim", rows, sat.read(), "hk", md.SAT_ORDER, ["nome"], "load_date", buckets=16)
    return gold.read_scd2(spark, f"{root}/dim").select("hk", "nome", "valid_from", "valid_to", "is_current")


def dim_calendar(spark, sf_dir):
    return catalog.calendar(table(spark, sf_dir, "orders"), "o_orderdate")


# ----------------------------------------------------------------- marts
def _stored_mart(compute):
    """The query of a mart: computed once, stored as a table of its own, and read from there."""

    @wraps(compute)
    def query(spark, sf_dir):
        t = VersionedTable(spark, scratch_path(spark, compute.__name__))
        t.write(compute(spark, sf_dir), mode="overwrite")
        return t.read()

    return query


@_stored_mart
def mart_calls(spark, sf_dir):
    return marts.calls_mart(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"),
        call="o_orderpriority", order_key="o_orderkey", line_key="l_orderkey", status="o_orderstatus",
        approved_value="F", amount="o_totalprice", opened="o_orderdate", shipped="l_shipdate",
    )


@_stored_mart
def mart_artist_activity(spark, sf_dir):
    return marts.activity_mart(
        table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"),
        agent_key="c_custkey", order_agent="o_custkey", order_date="o_orderdate",
        since=vault.ts_literal(ACTIVE_SINCE),
    )


def _customer_region(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return cust.join(nation, cust.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )


@_stored_mart
def mart_region_distribution(spark, sf_dir):
    return marts.share_by(_customer_region(spark, sf_dir), "r_name")


# money and lines per region and segment; the tables stand as the question names them, the largest first
STAR_MODEL = """
SELECT r_name, c_mktsegment, count(*) AS n, CAST(sum(CAST(l_extendedprice AS decimal(18,2))) AS double) AS total
FROM {{ source('star', 'lineitem') }} JOIN {{ source('star', 'orders') }} JOIN {{ source('star', 'customer') }}
  JOIN {{ source('star', 'nation') }} JOIN {{ source('star', 'region') }}
WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND c_nationkey = n_nationkey AND n_regionkey = r_regionkey
  AND r_name IN ('ASIA', 'EUROPE') AND o_orderstatus = 'P'
GROUP BY r_name, c_mktsegment
"""
STAR = {
    "lineitem": ["l_orderkey"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus"],
    "customer": ["c_custkey", "c_nationkey"],
    "nation": ["n_nationkey", "n_regionkey"],
    "region": ["r_regionkey", "r_name"],
}


def star_registry(spark, sf_dir) -> SourceRegistry:
    """The star's tables in the catalog, with statistics of their join and filter columns."""
    reg = SourceRegistry(spark)
    for name, columns in STAR.items():
        reg.publish(f"star.{name}", f"{sf_dir.rstrip('/')}/{name}.parquet", columns)
    return reg


def mart_star_regions(spark, sf_dir):
    reg = star_registry(spark, sf_dir)
    out = VersionedTable(spark, scratch_path(spark, "star"))
    with cost_based(spark):
        reg.materialize(STAR_MODEL, out)
    reg.unpublish()
    return out.read()


@_stored_mart
def mart_approved_history(spark, sf_dir):
    return marts.running_by_year(table(spark, sf_dir, "orders"), "o_orderdate", F.col("o_orderstatus") == "F")


@_stored_mart
def mart_revenue(spark, sf_dir):
    return marts.revenue_by(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"),
        fact_key="o_custkey", dim_key="c_custkey", group="c_mktsegment", amount="o_totalprice",
    )


@_stored_mart
def mart_budget(spark, sf_dir):
    return marts.budget_mart(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"),
        plan_key="o_orderkey", line_key="l_orderkey", category="o_orderpriority", status="o_orderstatus",
        planned="o_totalprice", line_amount="l_extendedprice",
    )


@_stored_mart
def mart_change_audit(spark, sf_dir):
    return marts.change_audit(md.sat_changes(_stored_sat(spark, sf_dir).read()), "user_id")


@_stored_mart
def mart_sla(spark, sf_dir):
    return marts.sla_mart(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"),
        call="o_orderpriority", order_key="o_orderkey", line_key="l_orderkey",
        opened="o_orderdate", closed="l_shipdate", max_days=365,
    )


def mart_incremental_refresh(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "ts", "event_type")
    root = scratch_path(spark, "mart_daily")
    for batch in (_before_t(ev), _from_t(ev)):
        land_partitioned(batch, f"{root}/landing", "ts")
        landing = spark.read.parquet(f"{root}/landing")
        days = batch.select(F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"))
        marts.refresh_daily_mart(f"{root}/mart", landing, days, ["event_type"])
    return spark.read.schema("event_type string, n bigint, dia date").parquet(f"{root}/mart").select(
        "dia", "event_type", "n"
    )


def _requests(ev: DataFrame) -> DataFrame:
    """Erasure requests: users whose first recorded event is an error."""
    first = ev.groupBy("user_id").agg(F.min_by("event_type", F.struct("ts", "event_id")).alias("first_type"))
    return first.where(F.col("first_type") == "error").select("user_id")


def mart_delta_refresh(spark, sf_dir):
    """Daily counts and values kept by signed changes: two loads, an erasure asked for twice, another load."""
    ev = _events(spark, sf_dir).select("event_id", "user_id", "ts", "event_type", "value")
    root = scratch_path(spark, "delta_mart")
    t = VersionedTable(spark, f"{root}/events")
    by = {"dia": F.to_date("ts"), "event_type": F.col("event_type")}
    mart = SummedMart(spark, f"{root}/mart", by, {"total": F.col("value")})
    early, requests = F.col("ts") < vault.ts_literal(EARLY_END), _requests(_events(spark, sf_dir))
    for batch in (ev.where(early), _before_t(ev.where(~early))):
        t.write(batch)
        mart.refresh(t)
    for _ in range(2):
        mart.forget(t, requests, "user_id", "first")
    t.write(_from_t(ev).join(requests, "user_id", "left_anti").select(*ev.columns))
    mart.refresh(t)
    mart.compact()
    mart.refresh(t)
    return mart.read().select("dia", "event_type", "n", F.col("total").cast("double").alias("total"))


def mart_active_customers(spark, sf_dir):
    """Customers with an order per month, quarter and year, from monthly sets that two loads brought."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderstatus")
    by = {"y": F.year("o_orderdate"), "m": F.month("o_orderdate")}
    mart = DistinctMart(spark, scratch_path(spark, "active"), by, F.col("o_custkey"))
    for load_id, batch in (("done", orders.where("o_orderstatus = 'F'")), ("all", orders)):
        mart.add(batch, load_id)
    year = F.col("y").cast("string")
    periods = [
        F.concat(year, F.lit("-"), F.lpad(F.col("m").cast("string"), 2, "0")),
        F.concat(year, F.lit(" Q"), F.ceil(F.col("m") / 3).cast("string")),
        year,
    ]
    return reduce(DataFrame.unionByName, [mart.count(period=p) for p in periods])


# ----------------------------------------------------------------- privacy
def mask_pii(spark, sf_dir):
    return _tax_ids(spark, sf_dir).select("c_custkey", mask_tax_id("id").alias("cpf"))


def pseudonymize(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    return cust.select(pseudonym("c_name", "s1").alias("pid"), "c_mktsegment")


def row_level_filter(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    rows = cust.join(nation, cust.c_nationkey == nation.n_nationkey).select("c_custkey", "n_regionkey")
    explicit = spark.createDataFrame([("analista", 1)], "usuario string, n_regionkey int")
    grants = privacy.build_grants(
        explicit, region.select(F.col("r_regionkey").alias("n_regionkey")), "n_regionkey", ["auditor"]
    )
    seen = [
        privacy.row_level_filter(rows, grants, "n_regionkey", "usuario", name).select(F.lit(name).alias("usuario"), "c_custkey")
        for name in ("analista", "auditor")
    ]
    return seen[0].unionByName(seen[1])


def forget_subjects(spark, sf_dir):
    t = _two_version_table(spark, sf_dir)
    privacy.forget_subjects(t, _requests(_events(spark, sf_dir)), "user_id")
    return t.read().select("event_id", "user_id")


def forget_by_key(spark, sf_dir):
    """Sealed event details after the keys of the subjects who asked for erasure are gone."""
    ev = _events(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "props")
    root = scratch_path(spark, "sealed")
    keys, t = VersionedTable(spark, f"{root}/keys"), VersionedTable(spark, f"{root}/events")
    privacy.issue_keys(keys, ev, "user_id", "a secret that only a test may hold")
    t.write(privacy.seal(ev, keys, "user_id", ["value", "props"]))
    privacy.forget_keys(keys, _requests(_events(spark, sf_dir)), "user_id")
    return privacy.unseal(t.read(), keys, "user_id", "value double, props string")


def consent_filter(spark, sf_dir):
    ev = _events(spark, sf_dir)
    sat = _stored_sat(spark, sf_dir).read()
    # the satellite carries the business key, so events join on it directly
    # (no hash computed per event row)
    ok = privacy.consenting(sat, "user_id", "nome", md.SAT_ORDER, "signup", "error")
    return privacy.consent_filter(ev, ok, "user_id").select("event_id")


def format_currency(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", currency_label("o_totalprice").alias("rotulo"))


def catalog_flatten(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    named = nation.join(region, nation.n_regionkey == region.r_regionkey).select("r_name", "n_name")
    return catalog.flatten_catalog(catalog.catalog_by_category(named, "r_name", "n_name"))


# ----------------------------------------------------------------- quality
def test_not_null(spark, sf_dir):
    return quality.not_null_failures(
        table(spark, sf_dir, "orders"), {"falhas_chave": "o_orderkey", "falhas_valor": "o_totalprice"}
    )


def test_unique(spark, sf_dir):
    return quality.unique_failures(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def test_min_value(spark, sf_dir):
    return quality.min_value_failures(table(spark, sf_dir, "customer"), "c_acctbal", 0, ["c_custkey"])


def load_anomaly(spark, sf_dir):
    ev = _events(spark, sf_dir)
    daily = ev.groupBy(F.lit("events").alias("tbl"), F.to_date("ts").alias("dia")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return quality.load_anomalies(daily, ["tbl"], "dia", "n").select("dia", "n", "anomalo")


# ----------------------------------------------------------------- streaming
def _land_files(df: DataFrame, path: str, files: int) -> None:
    df.repartition(files).write.mode("append").parquet(path)


def stream_ingest(spark, sf_dir):
    ev = _events(spark, sf_dir)
    root = scratch_path(spark, "stream_ingest")
    _land_files(ev, f"{root}/in", 4)
    streams.stream_ingest(spark, f"{root}/in", ev.schema, f"{root}/out", f"{root}/ckpt", max_files=2)
    return spark.read.schema(ev.schema).parquet(f"{root}/out").select("event_id", "user_id", "event_type")


def stream_dedupe(spark, sf_dir):
    ev = _events(spark, sf_dir)
    root = scratch_path(spark, "stream_dedupe")
    args = (spark, f"{root}/in", ev.schema, f"{root}/out", f"{root}/ckpt", "event_id", "ts")
    _land_files(ev, f"{root}/in", 3)
    _land_files(ev, f"{root}/in", 3)  # every row offered twice in the same run, in any order
    streams.stream_dedupe(*args, max_files=4)
    _land_files(ev, f"{root}/in", 3)  # and once more, late, in a second run
    streams.stream_dedupe(*args, max_files=4)
    return streams.read_deduped(spark, ev.schema, f"{root}/out").select("event_id", "user_id")


def stream_dedupe_accounted(spark, sf_dir):
    """The second half of the events; then, by a new checkpoint, those files again and all events."""
    ev = _events(spark, sf_dir)
    root = scratch_path(spark, "stream_accounted")
    src, out = f"{root}/in", f"{root}/out"
    _land_files(_from_t(ev), src, 2)
    streams.stream_dedupe_accounted(spark, src, ev.schema, out, f"{root}/ckpt", "event_id", "ts", "20 days", max_files=1)
    _land_files(ev, src, 2)
    streams.stream_dedupe_accounted(spark, src, ev.schema, out, f"{root}/again", "event_id", "ts", "20 days", max_files=3)
    rows = [
        streams.read_accounted(spark, ev.schema, out, side).select(F.lit(side).alias("side"), "event_id", F.lit(1).cast("long").alias("n"))
        for side in ("kept", "late")
    ]
    counts = streams.read_accounted(spark, ev.schema, out, "counts")
    for side in ("offered", "repeated"):
        rows.append(counts.agg(F.sum(side).alias("n")).select(F.lit(side).alias("side"), F.lit(None).cast("long").alias("event_id"), "n"))
    return reduce(DataFrame.unionByName, rows)


def stream_ingest_drift(spark, sf_dir):
    """JSON lines; the second files have a field more, a number that is text for one kind, and a broken line."""
    ev = _events(spark, sf_dir).select("event_id", "user_id", "value", "event_type", "ts")
    root = scratch_path(spark, "stream_drift")
    known = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType())])
    _before_t(ev).select(*known.names).repartition(2).write.json(f"{root}/in")
    streams.stream_ingest_drift(spark, f"{root}/in", known, f"{root}/out", f"{root}/ckpt", max_files=1)
    value = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    drifted = _from_t(ev).select("event_id", "user_id", value.alias("value"), F.struct("event_type").alias("detail"))
    broken = spark.createDataFrame([('{"event_id": 7, "user_id": ',)], "value string")
    lines = drifted.select(F.to_json(F.struct(*drifted.columns)).alias("value")).unionByName(broken)
    lines.repartition(2).write.mode("append").text(f"{root}/in")
    streams.stream_ingest_drift(spark, f"{root}/in", known, f"{root}/out", f"{root}/ckpt", max_files=1)
    got = spark.read.parquet(f"{root}/out")
    kind = F.try_variant_get("extra", "$.detail.event_type", "string")
    return got.select("event_id", "user_id", "value", kind.alias("event_type"), "rescued")


def stream_hub_merge(spark, sf_dir):
    ev = _events(spark, sf_dir)
    root = scratch_path(spark, "stream_hub")
    _land_files(ev, f"{root}/in", 3)
    t = VersionedTable(spark, f"{root}/hub")
    streams.stream_hub_merge(spark, f"{root}/in", ev.schema, t, f"{root}/ckpt", "user_id", LOAD_TS,
                             "EVENTS", max_files=1)
    return t.read().select("hk", "user_id")


QUERIES = {
    name: fn
    for name, fn in [
        ("csv_robust_scan", csv_robust_scan),
        ("csv_infer_schema", csv_infer_schema),
        ("csv_roundtrip_sink", csv_roundtrip_sink),
        ("multi_format_scan", multi_format_scan),
        ("paged_json_unwrap", paged_json_unwrap),
        ("paged_extract", paged_extract),
        ("bronze_ingest_stamp", bronze_ingest_stamp),
        ("landing_partitioned", landing_partitioned),
        ("source_registry_sql", source_registry_sql),
        ("load_counts", load_counts),
        ("ingest_checksum", ingest_checksum),
        ("ingest_high_watermark", ingest_high_watermark),
        ("ingest_metadata", ingest_metadata),
        ("normalize_dates", normalize_dates),
        ("contract_split", contract_split),
        ("contract_valid", contract_valid),
        ("contract_tax_id", contract_tax_id),
        ("nested_text_parse", nested_text_parse),
        ("cast_tolerant", cast_tolerant),
        ("dedupe_exact", dedupe_exact),
        ("dedupe_by_key_latest", dedupe_by_key_latest),
        ("hash_key_md5", hash_key_md5),
        ("hash_key_sha256", hash_key_sha256),
        ("hub_full_load", hub_full_load),
        ("sat_full_load", sat_full_load),
        ("hub_merge_insert_only", hub_merge_insert_only),
        ("sat_append_all", sat_append_all),
        ("sat_append_changed", sat_append_changed),
        ("sat_append_changed_late", sat_append_changed_late),
        ("link_load", link_load),
        ("hub_multi_source", hub_multi_source),
        ("cdc_apply", cdc_apply),
        ("cdc_apply_out_of_order", cdc_apply_out_of_order),
        ("cdc_merge_on_read", cdc_merge_on_read),
        ("sat_as_of", sat_as_of),
        ("sat_point_in_time", sat_point_in_time),
        ("version_as_of", version_as_of),
        ("table_history", table_history),
        ("sat_latest", sat_latest),
        ("raw_to_gold", raw_to_gold),
        ("gold_dim_strict", gold_dim_strict),
        ("gold_dim_coalesced", gold_dim_coalesced),
        ("gold_model_steps", gold_model_steps),
        ("gold_schema_replace", gold_schema_replace),
        ("gold_top10", gold_top10),
        ("gold_top15", gold_top15),
        ("dim_scd2", dim_scd2),
        ("dim_scd2_merge", dim_scd2_merge),
        ("dim_calendar", dim_calendar),
        ("mart_calls", mart_calls),
        ("mart_artist_activity", mart_artist_activity),
        ("mart_region_distribution", mart_region_distribution),
        ("mart_star_regions", mart_star_regions),
        ("mart_approved_history", mart_approved_history),
        ("mart_revenue", mart_revenue),
        ("mart_budget", mart_budget),
        ("mart_change_audit", mart_change_audit),
        ("mart_sla", mart_sla),
        ("mart_incremental_refresh", mart_incremental_refresh),
        ("mart_delta_refresh", mart_delta_refresh),
        ("mart_active_customers", mart_active_customers),
        ("mask_pii", mask_pii),
        ("pseudonymize", pseudonymize),
        ("row_level_filter", row_level_filter),
        ("forget_subjects", forget_subjects),
        ("forget_by_key", forget_by_key),
        ("consent_filter", consent_filter),
        ("format_currency", format_currency),
        ("catalog_flatten", catalog_flatten),
        ("test_not_null", test_not_null),
        ("test_unique", test_unique),
        ("test_min_value", test_min_value),
        ("load_anomaly", load_anomaly),
        ("stream_ingest", stream_ingest),
        ("stream_dedupe", stream_dedupe),
        ("stream_dedupe_accounted", stream_dedupe_accounted),
        ("stream_ingest_drift", stream_ingest_drift),
        ("stream_hub_merge", stream_hub_merge),
    ]
}
