"""A key holding a third of all rows must not land whole in one task."""

from pyspark.sql import functions as F

from lakevault.operators.history import day_chunk, latest_per_key, with_neighbors
from lakevault.plans.inspect import plan_text


def _skewed(spark, n=30000):
    # key "hot" holds 40% of the rows, spread over 30 days; 200 other keys share the rest
    ids = spark.range(n)
    return ids.select(
        F.when(F.col("id") % 5 < 2, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 200).cast("string"))).alias("hk"),
        F.timestamp_add("SECOND", (F.col("id") * 86).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("load_date"),
        F.col("id").alias("event_id"),
        (F.col("id") % 3).cast("string").alias("nome"),
    )


def _max_share(df):
    # max("p") needs the window's output, so the window is not pruned away
    tagged = df.select(F.spark_partition_id().alias("pid"), "p")
    counts = [r.n for r in tagged.groupBy("pid").agg(F.count(F.lit(1)).alias("n"), F.max("p")).collect()]
    return max(counts) / sum(counts)


def test_chunked_window_spreads_a_hot_key(spark):
    saved = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        df = _skewed(spark)
        spec = dict(prev={"p": "nome"})
        plain = with_neighbors(df, ["hk"], ["load_date", "event_id"], chunk=F.lit(0), **spec)
        chunked = with_neighbors(df, ["hk"], ["load_date", "event_id"], chunk=day_chunk("load_date"), **spec)
        assert _max_share(plain) >= 0.4
        assert _max_share(chunked) < 0.3
        # same answer either way
        a = plain.select("event_id", "p").exceptAll(chunked.select("event_id", "p")).count()
        assert a == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", saved)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_ranges_spread_a_key_that_is_hot_in_one_day(spark):
    saved = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        # 40 % of the rows: one key, one instant
        df = _skewed(spark).withColumn("load_date", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        spec = dict(prev={"p": "nome"})
        ranged = with_neighbors(df, ["hk"], ["load_date", "event_id"], **spec)
        by_day = with_neighbors(df, ["hk"], ["load_date", "event_id"], chunk=day_chunk("load_date"), **spec)
        assert _max_share(by_day) >= 0.4
        assert _max_share(ranged) < 0.25
        assert by_day.select("event_id", "p").exceptAll(ranged.select("event_id", "p")).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", saved)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_latest_pre_combines_before_the_shuffle(spark):
    df = _skewed(spark)
    text = plan_text(latest_per_key(df, ["hk"], ["load_date", "event_id"]), "simple")
    # the partial aggregate sits below the exchange: each map task sends one row per key
    partial = text.index("partial_max_by")
    exchange = text.index("Exchange hashpartitioning(hk")
    assert text.count("SortAggregate") >= 2 and partial > exchange  # the tree lists children below parents
