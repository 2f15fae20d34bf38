"""Insert-only tables bucketed by their keys, so that merges never move what is stored.

A bucketed table is an ordinary external Parquet table of the session's catalog
(``bucketBy`` with ``saveAsTable``) at a path of its own. Its files are dealt by a hash of
the keys, so a batch that is dealt the same way meets the stored keys bucket by bucket:
Spark plans the join without an exchange, and without a broadcast, over the table.
``buckets`` is fixed when the table is created and has to be given again later; it
should be of the order of the cluster's cores, as a merge runs that many tasks.

A load is one append. If it fails while its files are being committed, some of its rows
may be there; an insert-only merge run again adds just the others, which is why
these tables need no marks. They have no loads to go back to: use ``VersionedTable``
for that.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakevault.sources.versioned import SchemaMismatchError, TableExistsError, folder_exists


class BucketedTable:
    """A Parquet table at ``path``, bucketed by ``keys``."""

    def __init__(self, spark: SparkSession, path: str, keys, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.name = "bucketed_" + hashlib.md5(self.path.encode()).hexdigest()[:20]

    def exists(self) -> bool:
        """Whether the table has been written; a session that meets it first enters it in its catalog."""
        if self.spark.catalog.tableExists(self.name):
            return True
        if not folder_exists(self.spark, self.path):
            return False
        columns = self.spark.read.parquet(self.path).schema
        self.spark.sql(
            f"CREATE TABLE {self.name} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in columns)}) USING parquet "
            f"CLUSTERED BY ({', '.join(f'`{k}`' for k in self.keys)}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        return True

    def aligned(self, df: DataFrame) -> DataFrame:
        """``df``, dealt as the table is."""
        return df.repartition(self.buckets, *self.keys)

    def write(self, df: DataFrame, mode: str = "append", load_id: str | None = None, keep_empty: bool = True) -> str | None:
        """Append ``df`` (``errorifexists``: create the table); returns the table's name.

        ``load_id`` is not needed, as an insert-only merge repeats nothing, and ignored; so is
        ``keep_empty``, as an append of no rows leaves nothing. ``last_num_rows`` is counted
        during the write.
        """
        if mode == "errorifexists" and self.exists():
            raise TableExistsError(self.path)
        if self.exists():
            have, want = ({f.name: f.dataType.simpleString() for f in d.schema} for d in (df, self.read()))
            if have != want:
                raise SchemaMismatchError(f"the table holds {want}, not {have}")
            df = df.select(*want)
        seen = Observation()
        out = self.aligned(df).observe(seen, F.count(F.lit(1)).alias("rows"))
        out.write.bucketBy(self.buckets, *self.keys).mode("append").option("path", self.path).saveAsTable(self.name)
        self.last_num_rows = int(seen.get.get("rows", 0))
        return self.name if self.last_num_rows else None

    def read(self) -> DataFrame:
        if not self.exists():
            raise FileNotFoundError(self.path)
        return self.spark.table(self.name)

    def find(self, **values) -> DataFrame:
        """The rows of some key values; Spark reads the files of their bucket only."""
        return self.read().where(reduce(lambda a, b: a & b, [F.col(k) == v for k, v in values.items()]))
