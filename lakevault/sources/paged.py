"""Paged JSON extracts with a HAL envelope: ``{"_embedded": {"<items>": [...]}}``.

An API that serves ``limit``/``offset`` pages is read as one input partition
per page (``PagedHttpDataSource``), never as a driver loop that builds a
list. Page bodies are parsed and unwrapped by Spark (``from_json`` +
``inline``). The extract's stop rule is kept: pages at or after the first
empty page are dropped; that offset is a scalar subquery over page sizes.
A page that cannot be fetched fails the task (and is retried) instead of
silently counting as empty; an extract that looks for its end (``resume_extract``)
also ends at a page that the service does not know.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.session import scratch_path
from lakevault.sources.versioned import folder_exists

try:  # the Python data source API (PySpark 4)
    from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
except ImportError:  # pragma: no cover
    DataSource = DataSourceReader = DataSourceStreamReader = InputPartition = object

PAGE_SCHEMA = "offset bigint, body string"
CHECKED = "stop bigint, ended boolean"  # how far an extract was searched for its end
FETCHES = 256  # tasks that fetch a window

# Keys of the extract API's HAL envelope {"_embedded": {"projetos": [...]}}.
ENVELOPE = "_embedded"
ITEMS = "projetos"


def envelope_schema(item_schema: T.StructType, embedded: str = ENVELOPE, items: str = ITEMS) -> T.StructType:
    inner = T.StructType([T.StructField(items, T.ArrayType(item_schema))])
    return T.StructType([T.StructField(embedded, inner)])


def unwrap_pages(pages: DataFrame, item_schema: T.StructType, embedded: str = ENVELOPE,
                 items: str = ITEMS, max_rows: int | None = None) -> DataFrame:
    """(offset, body) page rows -> item rows.

    The extract ends at its first empty page (an envelope or list that is missing or
    empty); pages at and after it are dropped. A body that is not JSON, whose items
    do not fit the schema, or that reports an error (a top-level ``error`` or
    ``errors``) fails the job: nothing is taken for an empty page. ``max_rows``
    optionally leaves out pages from that offset on.
    """
    failed = F.get_json_object("body", "$.error").isNotNull() | F.get_json_object("body", "$.errors").isNotNull()
    told = F.raise_error(F.concat(F.lit("page at offset "), F.col("offset").cast("string"), F.lit(" reports an error: "), F.col("body")))
    body = F.when(failed, told.cast("string")).otherwise(F.col("body"))
    found = F.from_json(body, envelope_schema(item_schema, embedded, items), {"mode": "FAILFAST"})[embedded][items]
    parsed = pages.select("offset", found.alias("_items"))
    if max_rows is not None:
        parsed = parsed.where(F.col("offset") < max_rows)
    return _stop_at_first_empty(parsed).select(F.inline("_items"))


def _stop_at_first_empty(parsed: DataFrame) -> DataFrame:
    """Pages before the first empty one: parsed once, written, and the cut is a scalar over their sizes."""
    parsed = parsed.withColumn("_size", F.coalesce(F.size("_items"), F.lit(0)))
    path = scratch_path(parsed.sparkSession, "pages")
    parsed.write.parquet(path)
    parsed = parsed.sparkSession.read.schema(parsed.schema).parquet(path)
    first_empty = parsed.where(F.col("_size") <= 0).select(F.min("offset")).scalar()
    return parsed.where(F.coalesce(F.col("offset") < first_empty, F.lit(True)))


def read_page_files(spark: SparkSession, path: str, item_schema: T.StructType,
                    embedded: str = ENVELOPE, items: str = ITEMS,
                    max_rows: int | None = None) -> DataFrame:
    """Landed page responses (JSON lines with ``offset`` and the envelope) -> items, by the rules of ``unwrap_pages``."""
    lines = spark.read.text(path)
    pages = lines.select(
        F.from_json("value", "offset bigint", {"mode": "FAILFAST"})["offset"].alias("offset"), F.col("value").alias("body")
    )
    return unwrap_pages(pages, item_schema, embedded, items, max_rows)


def write_page_files(df: DataFrame, path: str, key: str, page_size: int = 100,
                     embedded: str = ENVELOPE, items: str = ITEMS) -> None:
    """Land a table as page responses (keyset pages: offset = key - key mod size).

    ``key`` must be unique (the API's item id): each page is then collected in
    its own group of at most ``page_size`` rows.
    """
    cols = [c for c in df.columns]
    off = (F.col(key) - F.pmod(F.col(key), F.lit(page_size))).cast("bigint")
    pages = df.groupBy(off.alias("offset")).agg(
        F.array_sort(F.collect_list(F.struct(*cols))).alias("_items")
    )
    out = pages.select("offset", F.struct(F.col("_items").alias(items)).alias(embedded))
    out.write.mode("overwrite").json(path)


class _Pages(InputPartition):
    def __init__(self, offsets: list[int]):
        self.offsets = offsets


class PagedHttpDataSource(DataSource):
    """``spark.read.format("paged_http")`` with options ``url`` (template with
    ``{offset}`` and ``{limit}``), ``limit`` (page size), ``start`` and
    ``max_rows`` (the range of offsets of this read), an optional ``fallback_url`` tried when the first route answers "not found",
    and ``pages_per_partition`` (default 1) to group pages into fewer tasks.
    Yields (offset, body); parse it with ``unwrap_pages``. With ``not_found`` = ``end`` a page
    after the first that neither route knows has a null body, which counts as empty; else it
    fails. As a stream it reads from the checkpoint's offset up to ``max_rows``."""

    @classmethod
    def name(cls) -> str:
        return "paged_http"

    def schema(self) -> str:
        return PAGE_SCHEMA

    def reader(self, schema):
        return _PagedReader(self.options)

    def streamReader(self, schema):  # noqa: N802 - Spark's name
        return _PagedStreamReader(self.options)


class _PagedReader(DataSourceReader):
    def __init__(self, options):
        self.url = options["url"]
        self.limit = int(options.get("limit", 100))
        self.start, self.max_rows = int(options.get("start", 0)), int(options["max_rows"])
        self.timeout = float(options.get("timeout", 45))
        self.fallback = options.get("fallback_url")
        self.group = max(1, int(options.get("pages_per_partition", 1)))
        self.ends = options.get("not_found", "fail") == "end"

    def partitions(self):
        return self._cut(self.start, self.max_rows)

    def _cut(self, start: int, stop: int) -> list:
        offsets = list(range(start, stop, self.limit))
        return [_Pages(offsets[i:i + self.group]) for i in range(0, len(offsets), self.group)]

    def _fetch(self, template: str, offset: int) -> str:
        import os  # noqa: PLC0415 - runs on the executor
        import urllib.parse  # noqa: PLC0415
        import urllib.request  # noqa: PLC0415

        url = template.format(offset=offset, limit=self.limit)
        parts = urllib.parse.urlsplit(url)
        if parts.scheme == "file" and os.path.isdir(parts.path):  # a page as Spark writes it
            files = sorted(n for n in os.listdir(parts.path) if n[0] not in "_.")
            return "".join(open(os.path.join(parts.path, n), encoding="utf-8-sig").read() for n in files)
        with urllib.request.urlopen(url, timeout=self.timeout) as resp:  # noqa: S310
            return resp.read().decode("utf-8-sig")

    @staticmethod
    def _not_found(err: Exception) -> bool:
        import urllib.error  # noqa: PLC0415

        if isinstance(err, urllib.error.HTTPError):
            return err.code == 404
        reason = getattr(err, "reason", err)
        return isinstance(reason, FileNotFoundError) or isinstance(err, FileNotFoundError)

    def read(self, partition):
        for offset in partition.offsets:
            try:
                body = self._fetch(self.url, offset)
            except Exception as err:  # only "not found" switches route; anything else fails the task
                if not self._not_found(err) or not (self.fallback or self._behind(offset)):
                    raise
                body = self._second(offset)
            if body is not None:
                json.loads(body)  # a malformed page fails the task, it is not "empty"
            yield (offset, body)

    def _behind(self, offset: int) -> bool:
        """Whether a page that is not found may be the end: the first one never is."""
        return self.ends and offset > 0

    def _second(self, offset: int) -> str | None:
        try:
            return self._fetch(self.fallback, offset) if self.fallback else None
        except Exception as err:
            if self._behind(offset) and self._not_found(err):
                return None
            raise


class _PagedStreamReader(DataSourceStreamReader, _PagedReader):
    """Pages as a stream: a batch runs from the offset in the checkpoint to ``max_rows``."""

    def __init__(self, options):
        _PagedReader.__init__(self, options)

    def initialOffset(self) -> dict:  # noqa: N802 - Spark's names
        return {"offset": self.start}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"offset": self.max_rows}

    def partitions(self, start: dict, end: dict):
        return self._cut(int(start["offset"]), int(end["offset"]))

    def read(self, partition):
        return _PagedReader.read(self, partition)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedHttpDataSource)


def _empty(item_schema: T.StructType, embedded: str, items: str):
    found = F.from_json("body", envelope_schema(item_schema, embedded, items))[embedded][items]
    return F.coalesce(F.size(found), F.lit(0)) <= 0


def resume_extract(spark: SparkSession, url: str, path: str, item_schema: T.StructType, limit: int = 100, pages: int = 64,
                   embedded: str = ENVELOPE, items: str = ITEMS, **options) -> bool:
    """Land the next ``pages`` pages of an extract under ``path``; whether its end is reached.

    The pages are fetched in parallel as one micro-batch of a stream, whose checkpoint (``path/_offsets``)
    holds how far the extract has come, and land exactly once. A run that is stopped or fails
    anywhere is taken up by the next call, in any session. The end is the first empty page or,
    after the first page, one that is not found; once it is landed nothing more is fetched.
    """
    register(spark)
    landed, checked = f"{path}/pages", f"{path}/checked"
    seen, ended, start = 0, False, 0
    if folder_exists(spark, checked):
        seen, ended = spark.read.schema(CHECKED).parquet(checked).agg(F.max("stop"), F.max("ended")).first()
    if ended:
        return True
    if folder_exists(spark, landed):
        top = spark.read.schema(PAGE_SCHEMA).parquet(landed).agg(F.max("offset")).first()[0]
        start = 0 if top is None else top + limit
    if start > seen:  # a run landed these and was stopped before it looked for the end
        if _look_for_end(spark, path, seen, start, item_schema, embedded, items):
            return True
    reader = spark.readStream.format("paged_http").option("url", url).option("limit", limit).option("not_found", "end")
    source = reader.option("max_rows", start + pages * limit).options(**options).load()
    sink = source.writeStream.format("parquet").option("path", landed).option("checkpointLocation", f"{path}/_offsets")
    sink.trigger(availableNow=True).start().awaitTermination()
    return _look_for_end(spark, path, start, start + pages * limit, item_schema, embedded, items)


def _look_for_end(spark: SparkSession, path: str, start: int, stop: int, item_schema: T.StructType, embedded: str, items: str) -> bool:
    """Whether the landed pages from ``start`` on hold the end; noted, so that no page is parsed for it again."""
    new = spark.read.schema(PAGE_SCHEMA).parquet(f"{path}/pages").where(F.col("offset") >= start)
    ended = not new.where(_empty(item_schema, embedded, items)).isEmpty()
    spark.createDataFrame([(stop, ended)], CHECKED).coalesce(1).write.mode("append").parquet(f"{path}/checked")
    return ended


def finish_extract(spark: SparkSession, url: str, path: str, item_schema: T.StructType, limit: int = 100, pages: int = 64,
                   embedded: str = ENVELOPE, items: str = ITEMS, **options) -> None:
    """Land an extract up to its end, from wherever it has come.

    Windows double from ``pages`` on, so the calls grow with the logarithm of the extract, and what is
    fetched behind the end is less than was found before it plus ``pages``. A window is at most
    ``FETCHES`` tasks, unless ``pages_per_partition`` says otherwise.
    """
    ended = False
    while not ended:
        group = {"pages_per_partition": max(1, -(-pages // FETCHES))} | options
        ended = resume_extract(spark, url, path, item_schema, limit, pages, embedded, items, **group)
        pages *= 2


def read_extract(spark: SparkSession, path: str, item_schema: T.StructType, embedded: str = ENVELOPE, items: str = ITEMS) -> DataFrame:
    """The items of the pages that ``resume_extract`` has landed, up to the first empty one."""
    return unwrap_pages(spark.read.schema(PAGE_SCHEMA).parquet(f"{path}/pages"), item_schema, embedded, items)


def extract_all(spark: SparkSession, url: str, item_schema: T.StructType, limit: int = 100, window: int = 1000,
                embedded: str = ENVELOPE, items: str = ITEMS, **options) -> DataFrame:
    """The whole extract, without knowing its length: windows of pages, each read in parallel,
    until one holds the end. The first windows are small and double up to ``window`` pages, so
    that what is fetched behind the end is less than was found before it."""
    path, pages = scratch_path(spark, "extract"), min(8, window)
    while not resume_extract(spark, url, path, item_schema, limit, pages, embedded, items, **options):
        pages = min(2 * pages, window)
    return read_extract(spark, path, item_schema, embedded, items)
