"""Ranked lexical search over an index whose documents are grouped by equal length normaliser.

A term's share of a score depends on its document only through the term's count ``tf`` and
the document's normaliser ``m``, so the index keeps documents of equal m together (a
stratum) and, within a stratum, the postings of a term by falling tf. A run of equal
(term, m, tf) has one impact, worked out once for however many documents it holds, and the
first run of a term in a stratum bounds all others. A search adds these bounds up per
stratum, visits strata in falling order of bound, and stops at the first that cannot
reach the k-th best score so far (one that can just equal it is visited, as the smaller
doc_id wins). Only visited strata have their postings expanded. No result is approximate.

Build. One pass measures lengths (N, L and quantiles of the length), one turns each text into
its distinct terms with counts and deals documents by length quantile, and each
task writes segments of at most ``segment_postings`` postings, or one document, in order
of m. A length that many documents share fills several quantiles, over which its
documents are dealt by hash. Terms are 64-bit hashes.

Search. Equal query texts are one query. Queries go to the tasks in parts of at most
``part_terms`` distinct terms each (or one query), one part after the other, so neither the driver nor
a task holds more of a large query set; every part meets every segment. A task returns
its k best documents per query, and Spark picks the k best of those.

Defined cases: a null text has no terms, a document without terms is not counted and
never found, a query without terms has no rows; a null doc_id comes before all others
(the least long stands for it); repeated documents are separate documents, repeated queries
are answered each; empty tables give no rows; other columns are ignored. A very long text
costs some 60 bytes per byte in one task, 16 MB of text then about 1 GB.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakevault.llm.common import U64, arrow_batches, discard, release_memory, require, slices, stored, word_hashes, word_spans
from lakevault.llm.decontaminate import NORMAL  # A-Z lowered, other ASCII but digits and letters to spaces

SEGMENT_POSTINGS = 1 << 17
SEGMENT_DOCS = 1 << 15
#: a segment is one row of about a MB: page and row group sizes are checked after every row, not every hundred
FILE_OPTIONS = {
    "parquet.block.size": 16 << 20,
    "parquet.block.size.row.check.min": 1,
    "parquet.block.size.row.check.max": 4,
    "parquet.page.size.row.check.min": 1,
    "parquet.page.size.row.check.max": 1,
    "parquet.enable.dictionary": "false",
}
BUCKET_TERMS = 1 << 19  # terms of a bucket of documents of about equal length
MAX_QUANTILES = 2000
PART_TERMS = 100_000
FIRST_VISIT = 64  # documents in the first strata that are expanded
NULL_ID = -(1 << 63)
TABLE = np.frombuffer(NORMAL, np.uint8)

SEGMENT = (
    "ids array<bigint>, m array<bigint>, stratum array<int>, terms array<bigint>, df array<int>, first_run array<int>, "
    "run_stratum array<int>, run_tf array<int>, run_at array<int>, docs array<int>"
)


def term_counts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice of rows: first row, end row, terms per row, and (row, term hash, tf) sorted by row and term."""
    for lo, hi, data, offsets in slices(column):
        data = TABLE[data]
        starts, ends, rows = word_spans(data, offsets)
        words = word_hashes(data, starts, ends).view(np.int64)
        n = np.bincount(rows, minlength=hi - lo)
        order = np.lexsort((words, rows))
        rows, words = rows[order], words[order]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (rows[1:] != rows[:-1]) | (words[1:] != words[:-1])
        at = np.flatnonzero(new)
        yield lo, hi, n, rows[at] + lo, words[at], np.diff(np.append(at, len(rows)))


def _lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _lengths(docs: DataFrame, text_col: str) -> DataFrame:
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            for lo, hi, data, offsets in slices(batch.column(0)):
                _, _, rows = word_spans(TABLE[data], offsets)
                n[lo:hi] = np.bincount(rows, minlength=hi - lo)
            yield pa.RecordBatch.from_arrays([pa.array(n)], ["n"])

    return docs.select(text_col).mapInArrow(measure, "n long")


def normaliser(n, total_docs: int, total_terms: int):
    return 25 + 75 * n * total_docs // total_terms


class Index:
    """Segments of an index, with N and L; ``discard`` deletes it."""

    def __init__(self, segments: DataFrame, n_docs: int, n_terms: int):
        self.segments, self.n_docs, self.n_terms = segments, n_docs, n_terms

    def discard(self) -> None:
        discard(self.segments)


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_postings: int = SEGMENT_POSTINGS, bucket_terms: int = BUCKET_TERMS
) -> Index:
    """Index all documents with at least one term, each with all its terms."""
    require(docs, id_col, text_col)
    with arrow_batches(docs.sparkSession):
        return _build(docs, id_col, text_col, segment_postings, bucket_terms)


def _build(docs: DataFrame, id_col: str, text_col: str, segment_postings: int, bucket_terms: int) -> Index:
    lengths = _lengths(docs, text_col).where("n > 0")
    n_docs, n_terms = lengths.agg(F.count("n"), F.coalesce(F.sum("n"), F.lit(0))).first()
    buckets = max(1, math.ceil(n_terms / bucket_terms))
    cuts = []
    if 1 < buckets:
        shares = [k / min(buckets, MAX_QUANTILES) for k in range(1, min(buckets, MAX_QUANTILES))]
        cuts = lengths.agg(F.percentile_approx("n", shares, 100 * len(shares) + 1000)).first()[0]
    spread, cuts = math.ceil(buckets / (len(cuts) + 1)), np.array(cuts, np.int64)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, n, rows, words, tf in term_counts(batch.column(1)):
                there = n > 0
                ids = np.asarray(batch.column(0).slice(lo, hi - lo).cast(pa.int64()).fill_null(NULL_ID)).astype(np.int64)[there]
                # documents of a length that spans several quantiles are dealt over all of them by hash
                first, last = np.searchsorted(cuts, n[there], "left"), np.searchsorted(cuts, n[there], "right")
                dice = _mixed(ids, words[np.flatnonzero(np.diff(rows, prepend=-1))])
                bucket = (first + dice % (last - first + 1)) * spread + (dice >> 20) % spread
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket), pa.array(normaliser(n[there].astype(np.int64), n_docs, n_terms)), pa.array(ids),
                        _lists(words, np.bincount(rows - lo, minlength=hi - lo)[there], pa.int64()),
                        _lists(tf, np.bincount(rows - lo, minlength=hi - lo)[there], pa.int32()),
                    ],
                    ["bucket", "m", "id", "terms", "tfs"],
                )

    dealt = docs.select(id_col, text_col).mapInArrow(vectors, "bucket long, m long, id long, terms array<bigint>, tfs array<int>")
    rows = dealt.repartition("bucket").sortWithinPartitions("bucket", "m", "id").drop("bucket")
    return Index(stored(rows.mapInArrow(partial(_segments, limit=segment_postings), SEGMENT), "search_index", **FILE_OPTIONS), n_docs, n_terms)


def _mixed(ids: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A number of 40 bits from a document's id and its least term."""
    x = ids.astype(np.int64).view(U64) * U64(0x9E3779B97F4A7C15) ^ words.view(U64)
    x = (x ^ (x >> U64(31))) * U64(0xBF58476D1CE4E5B9)
    return (x >> U64(24)).astype(np.int64)


def _segments(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Segments of documents that come in order of m."""
    held, postings, count = [], 0, 0
    for batch in batches:
        ends = np.asarray(batch.column(2).offsets).astype(np.int64)
        lo = 0
        while lo < batch.num_rows:
            room = max(0, limit - postings)
            hi = int(np.searchsorted(ends - ends[lo], room, "right")) - 1
            hi = min(max(hi, lo + (not held)), lo + SEGMENT_DOCS - count, batch.num_rows)
            if hi > lo:
                held.append(batch.slice(lo, hi - lo))
                postings, count = postings + int(ends[hi] - ends[lo]), count + hi - lo
            if hi < batch.num_rows or postings >= limit:
                yield _segment(held)
                held, postings, count = [], 0, 0
            lo = hi
    if held:
        yield _segment(held)


def _segment(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(batches).combine_chunks()
    m, ids = np.asarray(rows.column("m")), np.asarray(rows.column("id"))
    order = np.argsort(m, kind="stable")  # buckets that meet in a task may overlap
    place = np.empty(len(m), np.int64)
    place[order] = np.arange(len(m))
    lists = rows.column("terms").combine_chunks()
    doc = place[np.repeat(np.arange(len(m)), np.asarray(lists.value_lengths()))]
    term, tf = np.asarray(lists.flatten()), np.asarray(rows.column("tfs").combine_chunks().flatten()).astype(np.int64)
    m, ids = m[order], ids[order]
    value, stratum = np.unique(m, return_inverse=True)
    order = np.lexsort((doc, -tf, stratum[doc], term))
    doc, term, tf = doc[order], term[order], tf[order]
    s = stratum[doc]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (term[1:] != term[:-1]) | (s[1:] != s[:-1]) | (tf[1:] != tf[:-1])
    run = np.flatnonzero(new)
    fresh = np.ones(len(run), dtype=bool)
    fresh[1:] = term[run][1:] != term[run][:-1]
    first = np.flatnonzero(fresh)
    release_memory()

    def column(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return _lists(values, np.array([len(values)]), kind)

    return pa.RecordBatch.from_arrays(
        [
            column(ids, pa.int64()), column(value, pa.int64()), column(stratum, pa.int32()), column(term[run][first], pa.int64()),
            column(np.diff(np.append(run[first], len(doc))), pa.int32()), column(first, pa.int32()), column(s[run], pa.int32()),
            column(tf[run], pa.int32()), column(run, pa.int32()), column(doc, pa.int32()),
        ],
        [f.split()[0] for f in SEGMENT.split(", ")],
    )


def _array(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return np.asarray(batch.column(batch.schema.get_field_index(name))[row].values)


def _spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the given spans, one after the other."""
    lengths = ends - starts
    total = int(lengths.sum())
    if total == 0:
        return np.empty(0, np.int64)
    begins = np.cumsum(lengths) - lengths
    return np.repeat(starts - begins, lengths) + np.arange(total)


class Queries:
    """Some queries: their distinct terms (sorted), and per query its terms' places and counts."""

    def __init__(self, rows: list):
        self.keys = [r["key"] for r in rows]
        terms = [np.array(r["terms"], np.int64) for r in rows]
        self.terms = np.unique(np.concatenate(terms)) if rows else np.empty(0, np.int64)
        self.places = [np.searchsorted(self.terms, t) for t in terms]
        self.counts = [np.array(r["tfs"], np.int64) for r in rows]


def _frequencies(index: Index, terms: np.ndarray) -> np.ndarray:
    """The documents that hold each of ``terms``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                have, df = _array(batch, "terms", row), _array(batch, "df", row)
                at = np.minimum(np.searchsorted(have, terms), len(have) - 1)
                total += np.where(have[at] == terms, df[at], 0)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["term", "df"])

    out = np.zeros(len(terms), np.int64)
    sums = index.segments.select("terms", "df").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for r in sums.toLocalIterator():  # as many rows as the part has terms
        out[r["term"]] = r["df"]
    return out


def _better(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, by falling score and rising id."""
    return np.lexsort((ids, -score))[:k]


def _search(index: Index, queries: Queries, k: int) -> DataFrame:
    """(query, doc_id, score): at least the k best documents of every query, a few per task."""
    df = _frequencies(index, queries.terms)
    weight = np.array([math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    places, counts, terms = queries.places, queries.counts, queries.terms

    def visit(segment: dict, place: np.ndarray, share: np.ndarray, best: list | None) -> list | None:
        """Better documents of one segment for one query; ``share`` is each term's weight times its count."""
        runs = _spans(segment["first"][place], segment["last"][place])
        if len(runs) == 0:
            return best
        value = np.repeat(share, segment["last"][place] - segment["first"][place]) * segment["impact"][runs]
        s = segment["run_stratum"][runs]
        leads = segment["leads"][runs]
        bound = np.zeros(segment["strata"], np.int64)
        np.add.at(bound, s[leads], value[leads])
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        at, want = 0, FIRST_VISIT
        while at < len(order):
            floor = best[0][-1] if best is not None and len(best[0]) >= k else 1
            stop = int(np.searchsorted(-bound[order], -floor, "right"))  # bounds fall along the order
            if at >= stop:
                break
            size = np.cumsum(segment["sizes"][order[at:stop]])
            to = min(stop, at + int(np.searchsorted(size, want)) + 1)
            seen = np.zeros(segment["strata"], dtype=bool)
            seen[order[at:to]] = True
            mine = seen[s]
            begin, end = segment["run_at"][runs[mine]], segment["run_end"][runs[mine]]
            docs = segment["docs"][_spans(begin, end)]
            score = np.zeros(len(segment["ids"]), np.int64)
            np.add.at(score, docs, np.repeat(value[mine], end - begin))
            hit = np.flatnonzero(score >= floor)
            found, ids = score[hit], segment["ids"][hit]
            if best is not None:
                found, ids = np.concatenate([best[0], found]), np.concatenate([best[1], ids])
            top = _better(found, ids, k)
            best = [found[top], ids[top]]
            at, want = to, want * 4
        return best

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list = [None] * len(places)
        for batch in batches:
            for row in range(batch.num_rows):
                have = _array(batch, "terms", row)
                first = _array(batch, "first_run", row).astype(np.int64)
                tf, s = _array(batch, "run_tf", row).astype(np.int64), _array(batch, "run_stratum", row).astype(np.int64)
                at, docs = _array(batch, "run_at", row).astype(np.int64), _array(batch, "docs", row).astype(np.int64)
                m = _array(batch, "m", row)
                leads = np.zeros(len(tf), dtype=bool)  # the run of the highest tf of a term in a stratum
                leads[first] = True
                leads[1:] |= s[1:] != s[:-1]
                segment = {
                    "ids": _array(batch, "ids", row), "strata": len(m), "sizes": np.bincount(_array(batch, "stratum", row), minlength=len(m)),
                    "impact": 1_000_000_000 * tf // (1000 * tf + 8 * m[s]), "run_stratum": s, "run_at": at,
                    "run_end": np.append(at[1:], len(docs)), "docs": docs, "leads": leads,
                }
                spot = np.minimum(np.searchsorted(have, terms), len(have) - 1)
                there = have[spot] == terms
                segment["first"] = np.where(there, first[spot], 0)
                segment["last"] = np.where(there, np.append(first[1:], len(tf))[spot], 0)
                for q, place in enumerate(places):
                    best[q] = visit(segment, place, weight[place] * counts[q], best[q])
        rows = [(q, b) for q, b in enumerate(best) if b is not None]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat([q for q, _ in rows], [len(b[0]) for _, b in rows]).astype(np.int64)),
                pa.array(np.concatenate([b[1] for _, b in rows]) if rows else np.empty(0, np.int64)),
                pa.array(np.concatenate([b[0] for _, b in rows]) if rows else np.empty(0, np.int64)),
            ],
            ["query", "doc_id", "score"],
        )
        release_memory()

    return index.segments.mapInArrow(run, "query long, doc_id long, score long")


def search(
    index: Index, queries: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = 10, part_terms: int = PART_TERMS
) -> DataFrame:
    """(id, rank, doc_id, score): the k best documents of every query, by falling score, then rising doc_id."""
    require(queries, id_col, text_col)
    with arrow_batches(queries.sparkSession):
        return _answers(index, queries, id_col, text_col, k, part_terms)


def _answers(index: Index, queries: DataFrame, id_col: str, text_col: str, k: int, part_terms: int) -> DataFrame:
    spark = queries.sparkSession
    key = F.sha2(F.col(text_col), 256).alias("key")
    distinct = queries.where(F.col(text_col).isNotNull()).select(key, F.col(text_col).alias("text")).groupBy("key").agg(F.first("text").alias("text"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, n, rows, words, tf in term_counts(batch.column(1)):
                each = np.bincount(rows - lo, minlength=hi - lo)
                there = each > 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).filter(pa.array(there)), _lists(words, each[there], pa.int64()),
                     _lists(tf, each[there], pa.int32()), pa.array(each[there].astype(np.int64))],
                    ["key", "terms", "tfs", "n"],
                )

    terms = stored(distinct.mapInArrow(vectors, "key string, terms array<bigint>, tfs array<int>, n long"), "search_queries")
    parts = max(1, math.ceil((terms.agg(F.sum("n")).first()[0] or 0) / part_terms))
    found = None
    best = Window.partitionBy("key").orderBy(F.desc("score"), F.asc("doc_id"))
    for p in range(parts):
        mine = Queries(terms.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == p).select("key", "terms", "tfs").collect())  # at most about part_terms
        if not mine.keys or not index.n_docs:
            continue
        keys = spark.createDataFrame(list(enumerate(mine.keys)), "query long, key string")
        top = _search(index, mine, k).join(keys, "query").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        top = stored(top.select("key", "rank", "doc_id", "score"), "search_found")
        found = top if found is None else found.unionByName(top)
    discard(terms)
    if found is None:
        found = spark.createDataFrame([], "key string, rank int, doc_id long, score long")
    answers = queries.select(F.col(id_col), key).join(found, "key")
    return answers.select(
        id_col, F.col("rank").cast("int").alias("rank"), F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "score"
    )


def op12_search(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Each item's ten best documents."""
    index = build_index(documents)
    out = stored(search(index, benchmark), "search_result")
    index.discard()
    return out


ORACLE_OP12 = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
items AS (SELECT row_number() OVER () AS i, item_id, text FROM benchmark),
words AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs
), postings AS (SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT r, sum(tf) AS n FROM postings GROUP BY r),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths),
norms AS (SELECT r, 25 + CAST(75 * n * n_docs AS BIGINT) // n_terms AS m FROM lengths, totals),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM postings, totals GROUP BY term, n_docs
), asked AS (
  SELECT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM items
), scores AS (
  SELECT i, item_id, p.r, p.doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM (SELECT i, item_id, term, count(*) AS times FROM asked GROUP BY ALL) a, postings p, weights v, norms o
  WHERE a.term = p.term AND v.term = p.term AND o.r = p.r GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
