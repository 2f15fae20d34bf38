"""Star-schema marts: pre-computed counts, rates, means and sums.

Money is summed as DECIMAL(18,2) and turned into DOUBLE at the end; ratios
are percentages rounded to 4 places. Every mart is a grouped aggregate
(partial aggregation before the shuffle); the few global windows run over
already-aggregated rows (one per region / year), never over raw data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakevault.sources.versioned import delete_folder

DAY = ["year", "month", "day"]  # partition columns of a landing zone
MONEY = "decimal(18,2)"


def money_sum(c) -> Column:
    return F.sum(F.col(c).cast(MONEY) if isinstance(c, str) else c.cast(MONEY))


def pct(cond: Column) -> Column:
    """Share of rows meeting ``cond``, in percent, rounded to 4 places."""
    hits = F.sum(F.when(cond, 1).otherwise(0)).cast("double")
    return F.round(F.lit(100.0) * hits / F.count(F.lit(1)).cast("double"), 4)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(F.to_date(end), F.to_date(start))


def per_parent_extreme(child: DataFrame, key: str, col: str, fn: str, alias: str) -> DataFrame:
    """Child rows reduced to one value per parent key (min or max), partially
    aggregated before the shuffle, so a parent with many children is cheap."""
    agg = {"min": F.min, "max": F.max}[fn]
    return child.groupBy(key).agg(agg(col).alias(alias))


def calls_mart(orders: DataFrame, lines: DataFrame, *, call: str, order_key: str, line_key: str,
               status: str, approved_value: str, amount: str, opened: str, shipped: str) -> DataFrame:
    """Per call: submissions, approval rate %, mean value, mean days to first action."""
    first = per_parent_extreme(lines, line_key, shipped, "min", "_first_action")
    j = orders.join(first, orders[order_key] == first[line_key], "left")
    return j.groupBy(F.col(call).alias("edital")).agg(
        F.count(F.lit(1)).alias("total_inscricoes"),
        pct(F.col(status) == approved_value).alias("taxa_aprovacao"),
        F.round(money_sum(amount).cast("double") / F.count(F.lit(1)), 4).alias("valor_medio"),
        F.round(F.avg(days_between(F.col(opened), F.col("_first_action"))), 4).alias("dias_medios"),
    )


def activity_mart(agents: DataFrame, orders: DataFrame, *, agent_key: str, order_agent: str,
                  order_date: str, since) -> DataFrame:
    """Active (acted since ``since``) versus inactive agents."""
    active = orders.where(F.col(order_date) >= since).select(F.col(order_agent).alias("_a")).distinct()
    j = agents.join(active, agents[agent_key] == active["_a"], "left")
    state = F.when(F.col("_a").isNull(), "inativo").otherwise("ativo")
    return j.groupBy(state.alias("situacao")).agg(F.count(F.lit(1)).alias("n"))


def share_by(df: DataFrame, group: str, name: str = "n", pct_name: str = "pct") -> DataFrame:
    """Count per group and its share of the total.

    The total is a scalar subquery over the grouped counts, so no step moves
    all groups into one partition however many groups there are.
    """
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias(name))
    total = counts.select(F.sum(name)).scalar()
    return counts.withColumn(pct_name, F.round(F.lit(100.0) * F.col(name) / total, 4))


def running_by_year(df: DataFrame, date_col: str, cond: Column) -> DataFrame:
    """Rows meeting ``cond`` per year, and the running total over years."""
    per_year = df.where(cond).groupBy(F.year(date_col).cast("int").alias("ano")).agg(
        F.count(F.lit(1)).alias("aprovados")
    )
    w = Window.partitionBy().orderBy("ano").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_year.withColumn("acumulado", F.sum("aprovados").over(w).cast("bigint"))


def revenue_by(facts: DataFrame, dim: DataFrame, *, fact_key: str, dim_key: str, group: str,
               amount: str) -> DataFrame:
    j = facts.join(dim, facts[fact_key] == dim[dim_key], "inner")
    return j.groupBy(group).agg(money_sum(amount).cast("double").alias("receita"))


def budget_mart(plans: DataFrame, lines: DataFrame, *, plan_key: str, line_key: str, category: str,
                status: str, planned: str, line_amount: str) -> DataFrame:
    """Planned vs executed per category/status and the share of plans within budget."""
    executed = lines.groupBy(line_key).agg(money_sum(line_amount).alias("_ex"))
    j = plans.join(executed, plans[plan_key] == executed[line_key], "left")
    ex = F.coalesce(F.col("_ex"), F.lit(0).cast(MONEY))
    return j.groupBy(F.col(category).alias("categoria"), F.col(status).alias("status")).agg(
        money_sum(planned).cast("double").alias("previsto"),
        F.sum(ex).cast("double").alias("executado"),
        pct(ex <= F.col(planned).cast(MONEY)).alias("conformidade"),
    )


def change_audit(changes: DataFrame, key: str) -> DataFrame:
    """Tracked changes per key: stored versions minus the first one."""
    return changes.groupBy(key).agg((F.count(F.lit(1)) - 1).alias("mudancas"))


def sla_mart(orders: DataFrame, lines: DataFrame, *, call: str, order_key: str, line_key: str,
             opened: str, closed: str, max_days: int) -> DataFrame:
    """Share of cases closed within ``max_days`` of opening, per call."""
    last = per_parent_extreme(lines, line_key, closed, "max", "_closed")
    j = orders.join(last, orders[order_key] == last[line_key], "inner")
    return j.groupBy(F.col(call).alias("edital")).agg(
        pct(days_between(F.col(opened), F.col("_closed")) <= max_days).alias("sla_pct")
    )


def refresh_daily_mart(mart_path: str, landing: DataFrame, touched: DataFrame, by: list[str]) -> None:
    """Incremental refresh: recompute only the ``touched`` days (rows with year, month, day).

    ``landing`` is the source as ``land_partitioned`` stores it. The touched days, a date each, become
    a filter on its partition columns, so that both scans, the one for the counts and the one that
    asks which days still have rows, see these days' files only. The mart is partitioned by
    ``dia``; only the touched partitions are replaced (dynamic partition overwrite),
    and a touched day without any row left loses its partition.
    """
    spark = landing.sparkSession
    dia = F.make_date(*DAY)
    days = [r.dia for r in touched.select(dia.alias("dia")).where("dia IS NOT NULL").distinct().collect()]
    redo = landing.where(dia.isin(days))
    daily = redo.groupBy(dia.alias("dia"), *by).agg(F.count(F.lit(1)).alias("n"))
    (
        daily.hint("rebalance", "dia")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dia")
        .parquet(mart_path)
    )
    left = {r.dia for r in redo.select(dia.alias("dia")).distinct().collect()}
    for day in sorted(set(days) - left):
        delete_folder(spark, f"{mart_path}/dia={day.isoformat()}")
