"""Benchmark decontamination with an Aho-Corasick automaton over normalised test items.

Normalisation works on UTF-8 bytes and keeps every position: A-Z become a-z,
every ASCII byte that is neither a digit nor a letter becomes a space, all
other bytes stay. Words are the runs between spaces, so a match found in the
normalised text maps to words, and through them to character offsets, of the
original text.

An item is cut into windows of ``window`` consecutive words (an item with fewer
words, but at least one, is a single window). All windows form one automaton;
each document is scanned once. The window strings are broadcast, so their size
is measured first: up to ``max_pattern_bytes`` they make one automaton, a larger
benchmark is split by window hash into several automata of that size and the
documents pass through one after the other, with the same result. A pattern comes
with a number only. The items of each set of numbers that a document was found with
are looked up in Spark, so however many items share a window, no task or driver gets
their list but the row whose result it is.

Defined cases: a null or empty text has no words and no hits; an item that is
null, empty or without words gives no window; items that repeat are one item;
an item without id marks words but is not listed; an input column with the name
of the result column is replaced; other columns pass through unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.llm.common import release_memory, require, slices, stored, text_batches

# digits, a-z and all non-ASCII bytes stay; A-Z turn to lower case; the rest turns to spaces
NORMAL = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("word_spans", T.ArrayType(SPAN)),
        T.StructField("char_spans", T.ArrayType(SPAN)),
    ]
)
#: what a scan finds: pattern numbers in place of item ids
FOUND = T.StructType([T.StructField("numbers", T.ArrayType(T.LongType())) if f.name == "items" else f for f in RESULT])
ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
ARROW_FOUND = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("numbers", pa.list_(pa.int64())),
        ("word_spans", ARROW_SPANS),
        ("char_spans", ARROW_SPANS),
    ]
)


def benchmark_windows(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """(pattern, item): each distinct normalised window with each id of its items."""
    require(benchmark, item_col, text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column(0).to_pylist()
            for lo, hi, data, offsets in slices(batch.column(1)):
                patterns, ids = [], []
                for i in range(lo, hi):
                    words = data[offsets[i - lo] : offsets[i - lo + 1]].tobytes().translate(NORMAL).split()
                    for k in range(max(1, len(words) - window + 1) if words else 0):
                        patterns.append(b" " + b" ".join(words[k : k + window]) + b" ")
                        ids.append(items[i])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(patterns, pa.binary()), pa.array(ids, pa.string())], ["pattern", "item"]
                )

    rows = benchmark.select(F.col(item_col).cast("string"), F.col(text_col))
    return rows.mapInArrow(cut, "pattern binary, item string").distinct()


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _matches(automaton, norm: bytes) -> tuple[list[tuple[int, int]], set[int]]:
    """Hit word ranges and the numbers of the patterns found in one normalised text."""
    spans: list[tuple[int, int]] = []
    numbers: set[int] = set()
    for end, (length, number) in automaton.iter(norm.decode("latin-1")):
        a, b = end - length + 1, end
        if spans and a <= spans[-1][1] and a >= spans[-1][0]:
            spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
        else:
            spans.append((a, b))
        numbers.add(number)
    if not spans:
        return [], numbers
    blanks = np.flatnonzero(np.frombuffer(norm, np.uint8) == 0x20)
    return [(int(np.searchsorted(blanks, a)), int(np.searchsorted(blanks, b))) for a, b in spans], numbers


def _char_spans(raw: bytes, normal: bytes, word_spans: list[tuple[int, int]]) -> list[dict]:
    """Character offsets of word ranges in the original text."""
    blank = np.frombuffer(normal, np.uint8) == 0x20
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return [{"start": int(chars[starts[a]]), "end": int(chars[ends[b - 1]])} for a, b in word_spans]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = 10,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    result_col: str = "contamination",
    keep_text: bool = True,
    max_pattern_bytes: int = 2 << 20,
) -> DataFrame:
    """``docs`` plus ``result_col``: n_words, n_hit, items, word_spans and char_spans.

    ``word_spans`` and ``char_spans`` are half-open ranges of hit words, as word
    numbers and as character offsets in the original text. ``keep_text=False``
    leaves the text column out of the result.

    The texts are scanned twice, for the sets of numbers and for the result, so that
    no text is shuffled or written; without the text the result is written instead.
    """
    require(docs, text_col)
    if result_col in docs.columns and result_col != text_col:
        docs = docs.drop(result_col)
    windows = stored(benchmark_windows(benchmark, window, item_col, item_text_col), "windows")
    patterns = stored(windows.select("pattern").distinct().withColumn("number", F.monotonically_increasing_id()), "patterns")
    size = patterns.agg(F.sum(F.length("pattern"))).first()[0] or 0
    parts = max(1, math.ceil(size / max_pattern_bytes))
    others = [c for c in docs.columns if c != text_col]
    state = docs.select(*others, F.col(text_col), F.lit(None).cast(FOUND).alias(result_col))
    for part in range(parts):
        mine = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(parts)) == part)
        mine = [(r[0], r[1]) for r in mine.collect()]
        if part < parts - 1:
            state = _scan(state, mine, text_col, state.columns)
    if keep_text:
        sets = _scan(state, mine, text_col, [result_col])
        state = _scan(state, mine, text_col, state.columns)
    else:
        sets = state = stored(_scan(state, mine, text_col, [*others, result_col]), "found")
    return _with_items(state, sets, windows.join(patterns, "pattern"), result_col).select(
        *[c for c in docs.columns if c in state.columns], result_col
    )


def _with_items(state: DataFrame, sets: DataFrame, windows: DataFrame, result_col: str) -> DataFrame:
    """``state`` with item ids in place of pattern numbers; ``sets`` holds the results alone."""
    mark = "_"
    while any(c.startswith(mark + "hit_") for c in state.columns):
        mark += "_"
    key, names = mark + "hit_numbers", mark + "hit_items"
    numbers = sets.select(F.col(result_col)["numbers"].alias(key)).where(F.size(key) > 0).distinct()
    listed = windows.where(F.col("item").isNotNull()).select("number", "item")
    items = numbers.select(key, F.explode(key).alias("number")).join(listed, "number")
    # written first, so that the join knows its size
    items = stored(items.groupBy(key).agg(F.sort_array(F.collect_set("item")).alias(names)), "items")
    found = F.col(result_col)
    listing = F.coalesce(F.col(names), F.array().cast("array<string>"))
    fields = [(listing if f == "items" else found[f]).alias(f) for f in RESULT.names]
    joined = state.join(items, found["numbers"] == F.col(key), "left")
    return joined.withColumn(result_col, F.struct(*fields)).drop(key, names)


def _scan(state: DataFrame, patterns: list[tuple[bytes, int]], text_col: str, emit: list[str]) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for pattern, number in patterns:
            automaton.add_word(bytes(pattern).decode("latin-1"), (len(pattern), number))
        if patterns:
            automaton.make_automaton()
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            before = batch.column(batch.num_columns - 1)
            results = []
            for lo, hi, data, offsets in slices(batch.column(at)):
                raw = data.tobytes()
                for i in range(lo, hi):
                    text = raw[offsets[i - lo] : offsets[i - lo + 1]]
                    normal = text.translate(NORMAL)
                    words = normal.split()
                    spans, numbers = [], set()
                    if patterns and words:
                        spans, numbers = _matches(automaton, b" " + b" ".join(words) + b" ")
                    if before[i].is_valid:
                        old = before[i].as_py()
                        spans += [(s["start"], s["end"]) for s in old["word_spans"]]
                        numbers |= set(old["numbers"])
                    spans = _merge(spans)
                    results.append(
                        {
                            "n_words": len(words),
                            "n_hit": sum(b - a for a, b in spans),
                            "numbers": sorted(numbers),
                            "word_spans": [{"start": a, "end": b} for a, b in spans],
                            "char_spans": _char_spans(text, normal, spans) if spans else [],
                        }
                    )
            columns = dict(zip(batch.schema.names, [*batch.columns[:-1], pa.array(results, ARROW_FOUND)], strict=True))
            yield pa.RecordBatch.from_arrays([columns[c] for c in emit], names=emit)
        release_memory()

    return text_batches(state).mapInArrow(scan, T.StructType([state.schema[c] for c in emit]))


def op10_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest columns of the registered query, one row per document."""
    found = find_contamination(docs.select("doc_id", "text"), benchmark, keep_text=False)
    c = F.col("contamination")
    return found.select(
        "doc_id",
        c["n_words"].alias("n_words"),
        c["n_hit"].alias("n_hit"),
        F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", c["items"]), 256).alias("items_sha256"),
        (c["n_hit"] > 0).alias("contaminated"),
    )


ORACLE_OP10 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
p AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM p),
dw AS (
  SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT dw.doc_id, dw.n, dw.k, p.item_id FROM dw JOIN p ON dw.n = p.n AND dw.win = p.win),
per AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hit GROUP BY doc_id),
words AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(k, k + n - 1)) AS pos FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN words USING (doc_id)
"""
