"""Tables that keep their loads apart: plain Parquet folders, named by load.

Layout: ``<path>/base=<b>/load=<l>/`` holds the rows of load ``l`` of snapshot
``b``. An append adds a load to the newest
base, an overwrite begins a new base, so earlier snapshots stay readable until
they are dropped. Everything else is Spark: ``load`` is a partition column, a
state as of an earlier load is a filter on it, and each base has its own schema.

Every load has the next number, a caller's ``load_id`` stands behind it, and no
write ever goes to a folder that is there. ``write`` marks its folder itself
once the job is done (``_SUCCESS``; whether Spark's committer does so too is a
setting on which nothing depends), and reads leave out folders without the mark.
So a failed write is invisible and its retry is a load of its own. A table in
which no load has a mark, but some have files, was not written this way: writing
to it fails until ``adopt_loads`` has marked them.

There is no log beside the data, and nothing about rows or loads is collected;
a writer lists the folders of one table (a name per snapshot and load) as Spark
itself does to read them. One writer per table is assumed. Users of a lake
format call that format's own API instead.
"""

from __future__ import annotations

import hashlib
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MODES = ("append", "overwrite", "errorifexists")
ERASING = "_erasing"


class TableExistsError(RuntimeError):
    pass


class SchemaMismatchError(RuntimeError):
    pass


class UnmarkedTableError(RuntimeError):
    pass


class _Folder:
    """Hadoop file system calls on one folder (names, existence, deletion)."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self.path = spark, path
        self._jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._jpath.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return bool(self._fs.exists(self._jpath))

    def names(self, prefix: str) -> list[str]:
        if not self.exists():
            return []
        found = (s.getPath().getName() for s in self._fs.listStatus(self._jpath))
        return sorted(n[len(prefix) :] for n in found if n.startswith(prefix))

    def mark_complete(self) -> None:
        self._fs.create(_Folder(self._spark, f"{self.path}/_SUCCESS")._jpath, True).close()

    def has_files(self) -> bool:
        """Whether a reader would find a file here."""
        return any(n[0] not in "_." for n in self.names(""))

    def rename_to(self, path: str) -> None:
        if not self._fs.rename(self._jpath, _Folder(self._spark, path)._jpath):
            raise OSError(f"could not rename {self.path} to {path}")

    def delete(self) -> None:
        if self.exists() and not self._fs.delete(self._jpath, True):
            raise OSError(f"could not delete {self.path}")


def folder_exists(spark: SparkSession, path: str) -> bool:
    return _Folder(spark, path).exists()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system Spark writes to, if it is there."""
    _Folder(spark, path).delete()


def _load_name(number: int, load_id: str | None = None) -> str:
    """``v0000000003``, with a caller's id ``v0000000003.<id>``; names sort by number."""
    return f"v{number:010d}" + (f".{_tag(load_id)}" if load_id is not None else "")


def _tag(load_id: str) -> str:
    """A caller's id as part of a folder name; a long one by its hash."""
    text = quote(load_id, safe="").replace("%", "~")
    return text if len(text) <= 100 else hashlib.sha256(load_id.encode()).hexdigest()


class VersionedTable:
    """A table written load by load; see the module docstring for the layout."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _folder(self, *parts: str) -> _Folder:
        return _Folder(self.spark, "/".join([self.path, *parts]))

    def _complete(self, base: str) -> list[str]:
        """Names of the complete loads of a snapshot."""
        return [n for n in self._names(base) if self._folder(f"base={base}", f"load={n}", "_SUCCESS").exists()]

    def _names(self, base: str) -> list[str]:
        """Names of all load folders of a snapshot."""
        return self._folder(f"base={base}").names("load=")

    def _bases(self) -> list[str]:
        """Snapshots with a complete load, oldest first."""
        return [b for b in self._folder().names("base=") if self._complete(b)]

    def exists(self) -> bool:
        return bool(self._bases())

    def loads(self) -> list[str]:
        """Names of the complete loads of the newest snapshot."""
        bases = self._bases()
        return self._complete(bases[-1]) if bases else []

    def find_load(self, load_id: str | None) -> str | None:
        """Name of the complete load of the newest snapshot that was written under ``load_id``."""
        if load_id is None:
            return None
        return next((n for n in self.loads() if n.partition(".")[2] == _tag(load_id)), None)

    # ------------------------------------------------------------------ writes
    def write(
        self, df: DataFrame, mode: str = "append", load_id: str | None = None, overwrite_schema: bool = False,
        rebalance: bool = False, keep_empty: bool = True,
    ) -> str | None:
        """Write ``df`` as a load; returns its name.

        ``mode``: ``append``, ``overwrite`` or ``errorifexists`` (create). A load whose
        ``load_id`` is complete in the newest snapshot is not written again. Appends,
        and overwrites without ``overwrite_schema``, must keep the table's names and
        types. ``last_num_rows`` is counted during the write. Without ``keep_empty`` an
        appended load of no rows is taken back, and None returned.
        """
        mode = mode.lower()
        if mode not in MODES:
            raise ValueError(f"unsupported mode {mode!r}")
        if "load" in df.columns:
            raise ValueError("the column name 'load' is the table's own: rename it")
        every = {b: self._names(b) for b in self._folder().names("base=")}
        bases = [b for b in every if self._complete(b)]
        if not bases:
            self._refuse_unmarked(every)
        if (name := self.find_load(load_id)) is not None:
            self.last_num_rows = 0
            return name
        if bases and mode == "errorifexists":
            raise TableExistsError(self.path)
        if bases and not (mode == "overwrite" and overwrite_schema):
            df = self._conform(df)
        number = max([int(n[1:11]) for n in [*every, *(n for names in every.values() for n in names)]], default=-1) + 1
        name = _load_name(number, load_id)
        base = bases[-1] if bases and mode == "append" else _load_name(number)
        folder = self._folder(f"base={base}", f"load={name}")
        seen = Observation()
        out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if rebalance:
            out = out.hint("rebalance")
        out.write.mode("errorifexists").parquet(folder.path)
        self.last_num_rows = int(seen.get.get("rows", 0))
        if not (keep_empty or self.last_num_rows or base == _load_name(number)):
            folder.delete()
            return None
        folder.mark_complete()
        return name

    def _refuse_unmarked(self, every: dict[str, list[str]]) -> None:
        for base, names in every.items():
            for name in names:
                if self._folder(f"base={base}", f"load={name}").has_files():
                    raise UnmarkedTableError(
                        f"{self.path} holds load {name!r}, but no load is marked complete: adopt_loads() takes what is there, or delete it"
                    )

    def adopt_loads(self) -> None:
        """Mark every load that has files as complete (a table copied without its marks)."""
        for base in self._folder().names("base="):
            for name in self._names(base):
                folder = self._folder(f"base={base}", f"load={name}")
                if folder.has_files():
                    folder.mark_complete()

    def aligned(self, df: DataFrame) -> DataFrame:
        """``df``, dealt as the table is: it is not dealt by anything."""
        return df

    def _conform(self, df: DataFrame) -> DataFrame:
        have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        want = {f.name: f.dataType.simpleString() for f in self.read().schema.fields}
        if have != want:
            raise SchemaMismatchError(f"the table holds {want}, not {have}; overwrite_schema=True replaces it")
        return df.select(*want)

    # ------------------------------------------------------------------ reads
    def _rows(self, base: str, leave_out: list[str]) -> DataFrame:
        """The rows of a snapshot with their load, without the given loads."""
        df = self.spark.read.parquet(f"{self.path}/base={base}")
        return df.where(~F.col("load").isin(leave_out)) if leave_out else df

    def read(self, as_of: int | None = None, with_load: bool = False) -> DataFrame:
        """The complete loads of the newest snapshot, or of the one as of load number ``as_of``."""
        bases = self._bases()
        if as_of is not None:
            bases = [b for b in bases if b <= _load_name(as_of)]
        if not bases:
            raise FileNotFoundError(self.path)
        complete = self._complete(bases[-1])
        df = self._rows(bases[-1], [n for n in self._names(bases[-1]) if n not in complete])
        if as_of is not None:
            df = df.where(F.col("load") < _load_name(as_of + 1))
        return df if with_load else df.drop("load")

    def read_before(self, name: str) -> DataFrame:
        """The rows of the newest snapshot's loads before load ``name``."""
        return self.read(with_load=True).where(F.col("load") < name).drop("load")

    def read_load(self, name: str) -> DataFrame:
        """Only the rows of one load of the newest snapshot."""
        return self.read(with_load=True).where(F.col("load") == name).drop("load")

    # ------------------------------------------------------------------ erasure
    def erase(self, subjects: DataFrame, key: str) -> None:
        """Remove every row whose ``key`` is in ``subjects`` from every load of every snapshot, marked or not.

        Loads that hold such a row are found by a scan of the key column. Their other
        rows are written once, beside the table; then the new folders take the place
        of the old ones, one by one, with the mark that the old one had. After a failure
        anywhere, calling again finishes: a staging that is ready is put in place
        first, another one is written anew. No load is dropped, an emptied one stays as
        an empty load; what a failed write left in its temporary folder goes. When
        the call returns, no file of the table holds a row of a subject.
        """
        gone = subjects.select(key).distinct()
        for base in self._folder().names("base="):
            stage = self._folder(ERASING, base)
            if self._folder(ERASING, base, "_SUCCESS").exists():
                self._swap(base)
            stage.delete()
            for name in self._names(base):
                self._folder(f"base={base}", f"load={name}", "_temporary").delete()
            unread = [n for n in self._names(base) if not self._folder(f"base={base}", f"load={n}").has_files()]
            if len(unread) == len(self._names(base)):
                continue
            rows = self._rows(base, unread)
            if key not in rows.columns:
                continue
            hit = [r.load for r in rows.join(gone, key, "left_semi").select("load").distinct().toLocalIterator()]  # names of loads
            if not hit:
                continue
            kept = rows.where(F.col("load").isin(hit)).join(gone, key, "left_anti").select(*rows.columns)
            kept.hint("rebalance", "load").write.partitionBy("load").parquet(f"{stage.path}/rows")
            complete = self._complete(base)
            for name in hit:
                new = self._folder(ERASING, base, "rows", f"load={name}")
                if not new.exists():
                    rows.limit(0).drop("load").write.parquet(new.path)
                _Folder(self.spark, f"{new.path}/_SUCCESS").delete()
                if name in complete:
                    new.mark_complete()
            stage.mark_complete()
            self._swap(base)

    def _swap(self, base: str) -> None:
        """Put the staged loads in place of the old ones."""
        for name in self._folder(ERASING, base, "rows").names("load="):
            place = self._folder(f"base={base}", f"load={name}")
            place.delete()
            self._folder(ERASING, base, "rows", f"load={name}").rename_to(place.path)
        self._folder(ERASING, base).delete()

    def compact(self) -> str:
        """Rewrite the newest snapshot as one load of evenly sized files."""
        return self.write(self.read(), mode="overwrite", rebalance=True)

    def drop_old_snapshots(self) -> None:
        """Delete all snapshots but the newest."""
        for base in self._bases()[:-1]:
            self._folder(f"base={base}").delete()
