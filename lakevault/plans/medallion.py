"""The bronze -> silver (Data Vault) -> gold flow, written against any entity
table with a business key, a load-date column and a tie-break column.

The driver's ``events`` table stands in for the projects extract: business
key ``user_id``, load date ``ts``, tie-break ``event_id``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.operators.bronze import stamp_ingest
from lakevault.operators.gold import current_dimension, top_k
from lakevault.operators.history import changed_rows, latest_per_key
from lakevault.operators.vault import hub_load, sat_append_all, sat_rows
from lakevault.sources.csv import read_csv_robust
from lakevault.sources.versioned import VersionedTable

SAT_ORDER = ["load_date", "event_id"]


@dataclass
class Silver:
    hub: VersionedTable
    sat: VersionedTable


def ingest_bronze(spark: SparkSession, source_glob: str, schema, table: VersionedTable, load_ts: str,
                  stamp_column: str = "data_carga_bronze") -> str:
    """Raw CSV extract(s) -> bronze: robust dialect, one load stamp, overwrite.

    The path is a glob (extracts carry a time stamp in their name). The row
    count is observed during the write (``table.last_num_rows``), so the load is
    read once.
    """
    raw = read_csv_robust(spark, source_glob, schema)
    return table.write(stamp_ingest(raw, load_ts, stamp_column), mode="overwrite")


def event_valor_raw(df: DataFrame) -> Column:
    """The stand-in for a free-text money column: text for one event type."""
    return F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.col("value").cast("string"))


def event_sat_rows(events: DataFrame) -> DataFrame:
    shaped = events.withColumns({"nome": F.col("event_type"), "valor_raw": event_valor_raw(events)})
    return sat_rows(shaped, "user_id", ["user_id", "event_id", "nome", "valor_raw"], load_date_col="ts",
                    record_source="EVENTS")


def load_silver(spark: SparkSession, events: DataFrame, root: str, load_ts: str,
                load_id: str | None = None) -> Silver:
    """Hub (insert-only merge) then satellite (append), same load stamp.

    With a ``load_id`` the pair is retry-safe: re-running a load that failed
    after the hub commit (or after both) writes nothing already committed.
    """
    silver = Silver(VersionedTable(spark, f"{root}/hub"), VersionedTable(spark, f"{root}/sat"))
    hub_load(silver.hub, events, "user_id", load_ts, "EVENTS", load_id=load_id)
    sat_append_all(silver.sat, event_sat_rows(events), load_id=load_id)
    return silver


def sat_latest(sat: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Latest version per hash key, carrying only ``columns`` (an aggregate's
    struct is not pruned by Catalyst, so unused columns are dropped first)."""
    if columns is not None:
        sat = sat.select("hk", *SAT_ORDER, *[c for c in columns if c not in ("hk", *SAT_ORDER)])
    return latest_per_key(sat, ["hk"], SAT_ORDER)


def sat_changes(sat: DataFrame) -> DataFrame:
    """Versions whose ``nome`` differs from the previous one."""
    return changed_rows(sat, ["hk"], SAT_ORDER, ["nome"])


def gold_dimension(silver: Silver, coalesce_value: float | None = None) -> DataFrame:
    valor = F.col("state.valor_raw").try_cast("double")
    if coalesce_value is not None:
        valor = F.coalesce(valor, F.lit(coalesce_value))
    return current_dimension(
        silver.hub.read().select("hk", "user_id"),
        silver.sat.read().select("hk", *SAT_ORDER, "nome", "valor_raw"),
        "hk",
        SAT_ORDER,
        {
            "codigo": F.col("key.user_id"),
            "nome_projeto": F.col("state.nome"),
            "valor_projeto": valor,
            "data_ultima_carga": F.col("state.load_date"),
        },
    )


def gold_top(gold: DataFrame, k: int) -> DataFrame:
    return top_k(gold, k, [F.col("valor_projeto").desc_nulls_last(), F.col("codigo").asc()]).select(
        "codigo", "valor_projeto"
    )
