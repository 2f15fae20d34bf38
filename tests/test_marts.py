"""Mart and quality operators on hand-written rows (edge cases the generated data may not hold)."""

import datetime as dt

from pyspark.sql import functions as F

from lakevault.operators import marts, quality

D = dt.datetime


def _orders(spark):
    return spark.createDataFrame(
        [(1, "A", "F", 100.0, D(2024, 1, 1)), (2, "A", "O", 50.0, D(2024, 1, 3)), (3, "B", "F", 10.0, D(2023, 6, 1))],
        "o_orderkey long, prio string, status string, total double, odate timestamp_ntz",
    )


def _lines(spark):
    # order 3 has no lines; order 1 goes over budget
    return spark.createDataFrame(
        [(1, 60.0, D(2024, 1, 2)), (1, 50.0, D(2025, 3, 1)), (2, 20.0, D(2024, 1, 10))],
        "l_orderkey long, price double, ship timestamp_ntz",
    )


def test_budget_mart_counts_orders_without_lines_as_zero_executed(spark):
    out = {(r.categoria, r.status): r for r in marts.budget_mart(
        _orders(spark), _lines(spark), plan_key="o_orderkey", line_key="l_orderkey", category="prio",
        status="status", planned="total", line_amount="price").collect()}
    assert out[("A", "F")].executado == 110.0 and out[("A", "F")].conformidade == 0.0
    assert out[("A", "O")].conformidade == 100.0
    assert out[("B", "F")].executado == 0.0 and out[("B", "F")].conformidade == 100.0


def test_calls_and_sla_marts(spark):
    calls = {r.edital: r for r in marts.calls_mart(
        _orders(spark), _lines(spark), call="prio", order_key="o_orderkey", line_key="l_orderkey",
        status="status", approved_value="F", amount="total", opened="odate", shipped="ship").collect()}
    assert calls["A"].total_inscricoes == 2 and calls["A"].taxa_aprovacao == 50.0
    assert calls["A"].dias_medios == 4.0  # (1 + 7) / 2
    assert calls["B"].dias_medios is None  # no lines: no first action
    sla = {r.edital: r.sla_pct for r in marts.sla_mart(
        _orders(spark), _lines(spark), call="prio", order_key="o_orderkey", line_key="l_orderkey",
        opened="odate", closed="ship", max_days=365).collect()}
    assert sla == {"A": 50.0}  # order 1 closed after 425 days; order 3 has no lines (inner join)


def test_share_and_running_total(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",)], "g string")
    shares = {r.g: r.pct for r in marts.share_by(df, "g").collect()}
    assert shares == {"x": 66.6667, "y": 33.3333}
    hist = marts.running_by_year(_orders(spark), "odate", F.col("status") == "F").orderBy("ano").collect()
    assert [(r.ano, r.aprovados, r.acumulado) for r in hist] == [(2023, 1, 1), (2024, 1, 2)]


def test_anomaly_needs_seven_prior_days(spark):
    counts = [("t", dt.date(2024, 1, d), 10 + (d % 2)) for d in range(1, 9)] + [("t", dt.date(2024, 1, 9), 100)]
    df = spark.createDataFrame(counts, "tbl string, dia date, n long")
    flags = {r.dia.day: r.anomalo for r in quality.load_anomalies(df, ["tbl"], "dia", "n").collect()}
    assert flags[9] is True
    assert not any(flags[d] for d in range(1, 9))


def test_activity_mart_splits_active_and_inactive(spark):
    agents = spark.createDataFrame([(1,), (2,), (3,)], "c_custkey long")
    orders = spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2000, 1, 1))], "o_custkey long, odate timestamp_ntz")
    out = {r.situacao: r.n for r in marts.activity_mart(
        agents, orders, agent_key="c_custkey", order_agent="o_custkey", order_date="odate",
        since=F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")).collect()}
    assert out == {"ativo": 1, "inativo": 2}


def test_refresh_replaces_touched_days_and_drops_emptied_ones(spark, tmp_root):
    import datetime as dt

    from lakevault.operators.marts import refresh_daily_mart
    from lakevault.plans.inspect import plan_text
    from lakevault.sources.landing import land_partitioned
    from lakevault.sources.versioned import delete_folder

    schema = "id long, ts timestamp_ntz, kind string"
    days = [dt.datetime(2024, 1, d, 5) for d in (1, 2, 3)]
    rows = [(k, days[k % 3], "ab"[k % 2]) for k in range(12)]
    land_partitioned(spark.createDataFrame(rows, schema), f"{tmp_root}/landing", "ts")

    def refresh(touched):
        landing = spark.read.parquet(f"{tmp_root}/landing")
        refresh_daily_mart(f"{tmp_root}/mart", landing, touched, ["kind"])
        mart = spark.read.schema("kind string, n long, dia date").parquet(f"{tmp_root}/mart")
        return {(r.dia.day, r.kind): r.n for r in mart.collect()}, landing

    every = spark.createDataFrame([(2024, 1, d) for d in (1, 2, 3)], "year int, month int, day int")
    got, landing = refresh(every)
    assert got == {(d, k): 2 for d in (1, 2, 3) for k in "ab"}
    # a late row reopens day 1, and day 2 loses all its rows
    land_partitioned(spark.createDataFrame([(99, days[0], "a")], schema), f"{tmp_root}/landing", "ts")
    delete_folder(spark, f"{tmp_root}/landing/year=2024/month=1/day=2")
    got, landing = refresh(every.where("day < 3"))
    assert got == {(1, "a"): 3, (1, "b"): 2, (3, "a"): 2, (3, "b"): 2}
    pruned = landing.join(every.where("day = 1"), ["year", "month", "day"], "left_semi")
    assert "day" in plan_text(pruned).split("PartitionFilters:")[1].split("]")[0]


def test_statistics_order_the_joins_of_a_star(spark):
    from lakevault.plans import standins as S
    from lakevault.sources.registry import cost_based

    reg = S.star_registry(spark, "/root/testdata/sf0.001")

    def first_joined():
        plan = reg.sql(S.STAR_MODEL)._jdf.queryExecution().optimizedPlan().toString()
        depth = {t: next(line.index(" Relation") for line in plan.splitlines() if f"__{t}[" in line) for t in S.STAR}
        return {t for t in S.STAR if depth[t] == max(depth.values())}

    assert "lineitem" in first_joined()  # in the order of the statement
    with cost_based(spark):
        assert "lineitem" not in first_joined() and first_joined() & {"region", "nation", "customer"}
    assert spark.conf.get("spark.sql.cbo.enabled") == "false"
    reg.unpublish()
    assert not [t for t in spark.catalog.listTables() if "__star__" in t.name]


def test_a_refresh_reads_the_touched_days_only(spark, tmp_root, monkeypatch):
    from lakevault.operators import marts
    from lakevault.plans.inspect import plan_text
    from lakevault.sources.landing import land_partitioned

    rows = spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i % 9)) for i in range(90)], "id long, ts timestamp_ntz")
    land_partitioned(rows, f"{tmp_root}/landing", "ts")
    landing = spark.read.parquet(f"{tmp_root}/landing")
    marts.refresh_daily_mart(f"{tmp_root}/mart", landing, landing, [])
    days = spark.createDataFrame([(2024, 1, 3), (2024, 2, 1)], "year int, month int, day int")
    plans = []
    real = type(landing).collect
    monkeypatch.setattr(type(landing), "collect", lambda self: (plans.append(plan_text(self)), real(self))[1])
    marts.refresh_daily_mart(f"{tmp_root}/mart", landing, days, [])
    scans = [p for p in plans if "landing" in p]
    assert scans and all("PartitionFilters: [make_date" in p for p in scans)
    assert spark.read.parquet(f"{tmp_root}/mart").agg({"n": "sum"}).first()[0] == 90
