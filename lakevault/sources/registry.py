"""Named sources (``silver.hub_projeto`` style) and SQL models over them."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


@contextmanager
def cost_based(spark: SparkSession) -> Iterator[None]:
    """Within it, joins are ordered by the cost that the catalog's statistics tell.

    A plan is made when a DataFrame is run, so write or collect it within. The session's settings come
    back at the end.
    """
    wanted = ("spark.sql.cbo.enabled", "spark.sql.cbo.planStats.enabled", "spark.sql.cbo.joinReorder.enabled")
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k in wanted:
            spark.conf.set(k, "true")
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


class SourceRegistry:
    """Maps names to DataFrame factories; ``sql`` registers those that a statement's
    ``{{ source('schema', 'table') }}`` markers name as temporary views, whose
    names are this registry's own, and runs it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._factories: dict[str, Callable[[], DataFrame]] = {}
        self._published: set[str] = set()
        self._prefix = f"source_{uuid.uuid4().hex[:8]}"

    def add(self, name: str, factory: Callable[[], DataFrame] | DataFrame) -> None:
        self._factories[name] = factory if callable(factory) else (lambda df=factory: df)

    def names(self) -> list[str]:
        return sorted(self._factories)

    def view_name(self, name: str) -> str:
        return f"{self._prefix}__{name.replace('.', '__')}"

    def get(self, name: str) -> DataFrame:
        return self._factories[name]()

    def sql(self, statement: str, **params) -> DataFrame:
        import re  # noqa: PLC0415

        used: set[str] = set()

        def resolve(m):
            name = f"{m.group(1)}.{m.group(2)}" if m.group(2) else m.group(1)
            if name not in self._factories:
                raise KeyError(f"unknown source {name!r}")
            used.add(name)
            return self.view_name(name)

        text = re.sub(
            r"\{\{\s*source\(\s*'([^']+)'\s*(?:,\s*'([^']+)'\s*)?\)\s*\}\}", resolve, statement
        )
        for name in sorted(used - self._published):
            self.get(name).createOrReplaceTempView(self.view_name(name))
        return self.spark.sql(text, args=params or None)

    def publish(self, name: str, path: str, columns: list[str] | None = None) -> str:
        """Make a Parquet folder a source that the catalog has statistics of; returns its table's name.

        The table is external: nothing is copied. Its row count, and size, range, nulls and distinct
        values of ``columns`` (all, by default; the keys of joins and the columns of filters are what
        matters) come from one scan of these columns. Publish again after the folder has changed.
        """
        table = self.view_name(name)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.spark.catalog.createTable(table, path=path, source="parquet")
        which = "FOR ALL COLUMNS" if columns is None else f"FOR COLUMNS {', '.join(f'`{c}`' for c in columns)}"
        self.spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS {which}")
        self._factories[name] = lambda: self.spark.table(table)
        self._published.add(name)
        return table

    def unpublish(self) -> None:
        """Take the published tables out of the catalog; their files stay."""
        for name in self._published:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.view_name(name)}")
            del self._factories[name]
        self._published.clear()

    def materialize(self, statement: str, table, overwrite_schema: bool = True, **params) -> str:
        """Run a model and store it as a new version of ``table`` (overwrite)."""
        return table.write(self.sql(statement, **params), mode="overwrite", overwrite_schema=overwrite_schema)
