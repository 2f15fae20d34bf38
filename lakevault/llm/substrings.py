"""Substring deduplication with a count-min prefilter.

Every window of ``window`` (20) consecutive words that also starts earlier in the
corpus (in a smaller id, or earlier in the same document) has its words removed;
windows are judged on the input. Texts travel as compressed blocks, three times:

1. Sketch. A window's anchor is the smallest hash among its 8-word runs, so equal
   windows have equal anchors, at different places of the corpus. Every block
   counts its anchors' places in a partition sketch: two rows of cells, 0, 1 or 2
   and more, sparse. The merged sketch is never held whole: its pages (ranges of
   cells) are merged each in one group, and every block is told which of its own
   cells reach 2. A merged count is never below the true one, so no repeated
   window is lost. Its width follows the size of the input, so the share of
   chance hits and a page's load are the same at any size.
2. Exact grouping. Windows whose anchor reaches 2 in both rows are compared by
   96 bits of two independent hashes. A block sends its first place of each such
   window; per range of the hash the corpus-wide first place wins, and each block
   is told which of its windows have an earlier place.
3. Removal. Words covered by a window that is not the first are cut.

A passage found everywhere is one entry per block, at every step, so no group
grows with the number of its copies inside the blocks.

Defined cases: a null text has no words; a text shorter than a window is kept
whole; rows of one id are ordered by their place in the input, and a null id
comes last; extra columns pass through, a column of the result's name is
replaced; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.llm.blocks import MESSAGE, TEXT, Messages, exchange, expand, squeeze, with_answers, write_blocks
from lakevault.llm.common import U64, WORD_BASE, WORD_BASE_2, mix, require, slices, stored, window_hashes, word_hashes, word_spans

ANCHOR_WORDS = 8
PAGE_BITS = 20  # cells in a page of the sketch
#: cells per byte of text; a text has an anchor place every 40 bytes or so
CELLS_PER_BYTE = 0.5
#: bytes of text for each range of window hashes
BYTES_PER_RANGE = 8 << 20
#: addresses: pages of sketch rows 0 and 1, then ranges of window hashes
ROW_ADDRESS, RANGE_ADDRESS = 1 << 40, 1 << 50

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
ARROW_RESULT = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("text", pa.string())])


class Windows:
    """Words, windows and anchors of a block's texts."""

    def __init__(self, texts: pa.Array, size: int):
        words, rows, self.spans = [], [], []
        for lo, _, data, offsets in slices(texts):
            starts, ends, row = word_spans(data, offsets)
            words.append(word_hashes(data, starts, ends))
            rows.append(row + lo)
            self.spans.append((data, starts, ends))
        self.words = np.concatenate(words) if words else np.empty(0, U64)
        self.rows = np.concatenate(rows) if rows else np.empty(0, np.int64)
        self.at, self.h1 = window_hashes(self.words, self.rows, size, WORD_BASE)
        self.size = size

    def second_hash(self, at: np.ndarray) -> np.ndarray:
        _, h2 = window_hashes(self.words, self.rows, self.size, WORD_BASE_2)
        return (h2[np.searchsorted(self.at, at)] >> U64(32)).astype(np.uint32)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Anchor of each window, and the anchors at their distinct places (repeated if at several)."""
        n, runs = len(self.words), self.size - ANCHOR_WORDS + 1
        if len(self.at) == 0:
            return np.empty(0, U64), np.empty(0, U64)
        value = np.full(n, ~U64(0), U64)
        at, h = window_hashes(self.words, self.rows, ANCHOR_WORDS)
        value[at] = h
        least = _sliding(value, runs, np.minimum)
        mine = least[self.at]
        chosen = np.zeros(n, U64)  # the greatest anchor of the windows that hold the place
        chosen[self.at] = mine
        padded = np.concatenate([np.zeros(runs - 1, U64), chosen])
        greatest = _sliding(padded, runs, np.maximum)[:n]
        places = (greatest == value) & (value != ~U64(0))
        return mine, value[places]


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over ``width`` entries from each on; ends are cut short."""
    out, have = x.copy(), 1
    while have < width:
        step = min(have, width - have)
        if step < len(out):
            out[:-step] = pick(out[:-step], out[step:])
        have += step
    return out


class Sketch:
    """A block's own cells in one row of the count-min sketch, by page."""

    def __init__(self, places: np.ndarray, cells: int, row: int):
        self.cells, self.row = cells, row
        cell, count = np.unique(self.cell(places), return_counts=True)
        self.cell_of, self.twice = cell, count > 1
        page = (cell >> PAGE_BITS).astype(np.int64)
        self.pages, first = np.unique(page, return_index=True)
        self.bounds = np.append(first, len(cell))

    def cell(self, anchors: np.ndarray) -> np.ndarray:
        return (mix(anchors ^ U64(0xA5A5 + 7919 * self.row)) >> U64(1)).astype(np.int64) % self.cells

    def messages(self) -> Messages:
        out = []
        for k, page in enumerate(self.pages):
            a, b = self.bounds[k], self.bounds[k + 1]
            code = ((self.cell_of[a:b] & ((1 << PAGE_BITS) - 1)) << 1 | self.twice[a:b]).astype(np.int32)
            out.append((self.row * ROW_ADDRESS + int(page), squeeze(np.diff(code, prepend=0).astype(np.int32))))
        return out

    def repeated(self, anchors: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
        """Which anchors' cells reach 2 in the merged sketch."""
        hot = np.zeros(len(self.cell_of), dtype=bool)
        for k, page in enumerate(self.pages):
            a, b = int(self.bounds[k]), int(self.bounds[k + 1])
            bits = answers.get(self.row * ROW_ADDRESS + int(page))
            if bits is not None:
                hot[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
        return hot[np.searchsorted(self.cell_of, self.cell(anchors))]


def merge_page(_page: int, messages: list[tuple[int, bytes]]) -> list[tuple[int, bytes]]:
    """Add the partition sketches of a page up; tell each block which of its cells reach 2."""
    codes = [np.cumsum(expand(data)[0]) for _, data in messages]
    total = np.zeros(1 << PAGE_BITS, np.uint8)
    for code in codes:
        cell = code >> 1
        total[cell] = np.minimum(2, total[cell] + 1 + (code & 1))
    out = []
    for (block, _), code in zip(messages, codes, strict=True):
        hot = total[code >> 1] >= 2
        if hot.any():
            out.append((block, np.packbits(hot).tobytes()))
    return out


def first_places(_range: int, messages: list[tuple[int, bytes]]) -> list[tuple[int, bytes]]:
    """Tell each block which of its windows have an earlier place in another block."""
    parts = [expand(data) for _, data in messages]
    sizes = [len(p[0]) for p in parts]
    h1 = np.concatenate([p[0] for p in parts])
    h2 = np.concatenate([p[1] for p in parts])
    doc = np.concatenate([p[4][np.cumsum(p[2])] for p in parts])
    owner = np.repeat(np.arange(len(parts)), sizes)
    row = np.concatenate([p[5][np.cumsum(p[2])] for p in parts])
    start = np.concatenate([p[3] for p in parts])
    order = np.lexsort((start, row, owner, doc, h2, h1))
    same = np.concatenate([[False], (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])])
    later = np.zeros(len(h1), dtype=bool)
    later[order] = same
    out, at = [], 0
    for (block, _), size in zip(messages, sizes, strict=True):
        if later[at : at + size].any():
            out.append((block, np.packbits(later[at : at + size]).tobytes()))
        at += size
    return out


class Candidates:
    """The windows of a block that may be repeated, and its first place of each."""

    def __init__(self, windows: Windows, ids: np.ndarray, cells: int, ranges: int, answers: dict[int, bytes]):
        mine, places = windows.anchors()
        hot = np.ones(len(mine), dtype=bool)
        for row in (0, 1):
            hot &= Sketch(places, cells, row).repeated(mine, answers)
        self.at, h1 = windows.at[hot], windows.h1[hot]
        h2 = windows.second_hash(self.at)
        row = windows.rows[self.at]
        rank = np.empty(len(ids), np.int64)
        rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
        order = np.lexsort((self.at, rank[row], h2, h1))
        a, b = h1[order], h2[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[: len(a)]
        self.first = np.zeros(len(h1), dtype=bool)  # of its window, in this block
        self.first[order] = new
        self.group = np.empty(len(h1), np.int64)  # index of the window's first place among the firsts
        firsts = np.flatnonzero(self.first)
        self.address = RANGE_ADDRESS + ((h1[firsts] >> U64(32)).astype(np.int64) * ranges >> 32)
        self.order = np.argsort(self.address, kind="stable")
        self.firsts = firsts[self.order]
        self.address = self.address[self.order]
        self.h1, self.h2, self.row, self.ids = h1, h2, row, ids

    def _runs(self):
        parts, first = np.unique(self.address, return_index=True)
        for part, a, b in zip(parts, first, np.append(first, len(self.address))[1:], strict=True):
            yield int(part), self.firsts[a:b], slice(int(a), int(b))

    def messages(self) -> Messages:
        out = []
        for part, k, _ in self._runs():
            rows, number = np.unique(self.row[k], return_inverse=True)
            step = np.diff(number, prepend=0).astype(np.int32)
            out.append((part, squeeze(self.h1[k], self.h2[k], step, self.at[k].astype(np.int32), self.ids[rows], rows.astype(np.int32))))
        return out

    def repeated(self, answers: dict[int, bytes]) -> np.ndarray:
        """First words of the windows that start earlier somewhere."""
        later = ~self.first
        for part, k, _ in self._runs():
            if part in answers:
                later[k] = np.unpackbits(np.frombuffer(answers[part], np.uint8), count=len(k)).astype(bool)
        return self.at[later]


def _results(windows: Windows, starts: np.ndarray, texts: pa.Array, with_text: bool) -> pa.Array:
    """The results of a block's rows, the words of the windows from ``starts`` on being removed."""
    n = len(windows.words)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + windows.size, -1)
    gone = np.cumsum(change[:-1]) > 0
    n_words = np.bincount(windows.rows, minlength=len(texts))
    n_removed = np.bincount(windows.rows, gone, minlength=len(texts)).astype(np.int64)
    results: list[dict] = []
    at = 0
    for (lo, hi, data, offsets), (_, begins, ends) in zip(slices(texts), windows.spans, strict=True):
        raw, here = data.tobytes(), 0
        for i in range(lo, hi):
            k = int(n_words[i])
            whole = raw[offsets[i - lo] : offsets[i - lo + 1]]
            words, text = whole.split(), None  # the same words: bytes split at \x20 and \x09-\x0D
            if with_text:
                text = whole.decode()
            if n_removed[i]:
                kept = np.flatnonzero(~gone[at : at + k])
                words = [words[j] for j in kept]
                if with_text:  # what is kept keeps its own white space; cuts become one space
                    breaks = np.flatnonzero(np.diff(kept) > 1)
                    first = kept[np.concatenate([[0], breaks + 1])] if len(kept) else kept
                    last = kept[np.append(breaks, len(kept) - 1)] if len(kept) else kept
                    b, e = begins[here : here + k], ends[here : here + k]
                    text = b" ".join(raw[b[x] : e[y]] for x, y in zip(first, last, strict=True)).decode()
            digest = hashlib.sha256(b" ".join(words)).hexdigest()
            results.append({"n_words": k, "n_removed": int(n_removed[i]), "kept_sha256": digest, "text": text})
            at, here = at + k, here + k
    return pa.array(results, ARROW_RESULT)


def remove_repeats(
    docs: DataFrame,
    *,
    window: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    result_col: str = "dedup",
    with_text: bool = True,
) -> DataFrame:
    """``docs`` plus ``result_col``: n_words, n_removed, kept_sha256 and the kept text.

    ``with_text=False`` leaves out the text, in the result and among the columns.
    """
    require(docs, id_col, text_col)
    if window < ANCHOR_WORDS:
        raise ValueError(f"window must have at least {ANCHOR_WORDS} words")
    docs = docs.select(*[c for c in docs.columns if c != result_col])
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    cells = max(1 << PAGE_BITS, int(size * CELLS_PER_BYTE))
    ranges = max(1, size // BYTES_PER_RANGE)

    def ids_of(rows: pa.Table) -> np.ndarray:
        ids = rows.column(id_col).combine_chunks().cast(pa.int64())
        return np.asarray(ids.fill_null(np.iinfo(np.int64).max))

    def sketch(_block: int, rows: pa.Table) -> Messages:
        _, places = Windows(rows.column(text_col), window).anchors()
        return [m for row in (0, 1) for m in Sketch(places, cells, row).messages()]

    written = write_blocks(docs, text_col, "substrings", sketch)
    blocks = written.where(F.col("kind") == TEXT)
    repeated_cells = exchange(written.where(F.col("kind") == MESSAGE), merge_page)

    def group(block: int, rows: pa.Table, answers: dict[int, bytes]) -> pa.Table:
        found = Candidates(Windows(rows.column(text_col), window), ids_of(rows), cells, ranges, answers).messages()
        return pa.table(
            {
                "block": pa.array([block] * len(found), pa.int64()),
                "part": pa.array([p for p, _ in found], pa.int64()),
                "data": pa.array([d for _, d in found], pa.binary()),
            }
        )

    repeated_cells = stored(repeated_cells, "sketch")
    candidates = with_answers(blocks, repeated_cells, group, "block long, part long, data binary")
    answers = repeated_cells.unionByName(stored(exchange(candidates, first_places), "places"))
    keep = [c for c in docs.columns if with_text or c != text_col]
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(result_col, RESULT)])

    def remove(_block: int, rows: pa.Table, answers: dict[int, bytes]) -> pa.Table:
        texts = rows.column(text_col)
        windows = Windows(texts, window)
        starts = Candidates(windows, ids_of(rows), cells, ranges, answers).repeated(answers)
        return rows.select(keep).append_column(result_col, _results(windows, starts, texts.combine_chunks(), with_text))

    return with_answers(blocks, answers, remove, schema)


def op8_substrings(docs: DataFrame) -> DataFrame:
    """The registered query: windows of 20 words."""
    found = remove_repeats(docs.select("doc_id", "text"), with_text=False)
    return found.select("doc_id", *[F.col(f"dedup.{c}") for c in ("n_words", "n_removed", "kept_sha256")])


ORACLE_OP8 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, k, array_to_string(w[k : k + 19], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS k FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, k FROM (SELECT doc_id, k, row_number() OVER (PARTITION BY g ORDER BY doc_id, k) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, pos FROM (SELECT doc_id, unnest(generate_series(k, k + 19)) AS pos FROM later)),
word AS (SELECT doc_id, pos, w[pos] AS word FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS pos FROM d WHERE len(w) > 0)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
cut AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(cut.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN cut USING (doc_id)
"""
