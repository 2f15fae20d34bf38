"""Exact repeats of ``size`` bytes by the interval tree of an enhanced suffix array.

A suffix array over every byte of a corpus is many times its size, and its buckets of
common text have no bound. So the array is kept sparse. The ``size``-byte window at a position
picks one anchor: of its 32-byte grams, the leftmost one of the least hash. Equal windows
pick the same gram at the same offset, so a repeated window is repeated around an anchor
of the same gram, and only the suffixes at anchors (one in about 185 bytes) are sorted. The
bytes that an anchor's windows span are its hull.

* Hulls that are equal are repeated as they are; an aggregate finds them, however many there
  are, and one of them goes on. A gram with only one hull needs no more.
* The different hulls of a gram are sorted by the text from the anchor on, with the common
  prefixes (LCP) of neighbours. A stack scan closes the LCP intervals, innermost first. Where
  intervals meet, at a common right length r, the members of the smaller ones are placed
  among the largest one's in order of the text to the left of the anchor. Where neighbours
  there part after l bytes, the interval is left-diverse: l + r bytes are a maximal repeat,
  common to all members between which no smaller l lies. ``maximal_repeats`` returns these
  groups with all their occurrences; ``remove_repeated_bytes`` needs each member's reach
  only, for which the pairs of neighbours suffice (any other pair is no longer on either
  side).
* A gram with more than ``max_group`` different hulls (a passage in a great many places) is not
  sorted in one task. Its hulls' windows are counted by hash instead, by an aggregate that
  combines them before the shuffle; the result is the same.

Texts are written once with a row number; anchors, classes and spans are plain rows. Grams, hulls
and windows are compared by 64-bit hashes (hulls only among those of one gram), common
prefixes byte by byte.

Defined cases: a null text is empty; texts shorter than ``size`` bytes stay whole; repeated
rows are separate texts, so that equal texts of ``size`` bytes lose everything; periodic text
is covered by its own repeats; an empty table gives an empty result; other columns are
ignored. A long text is read in pieces of ``PIECE`` bytes and costs some 80 bytes per byte of
a piece, and its own size a few times over when its hulls are cut out and when it is
rewritten.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import BYTE_BASE, U64, arrow_batches, discard, mix, powers, release_memory, require, slices, stored, with_row_id

SIZE = 400
GRAM = 32
PIECE = 1 << 20
PLACE_BITS = 24  # of a key that orders grams by hash, then by place
MAX_GROUP = 1 << 15
ANCHOR = "rid long, g long, h long, lo long, a long, hi long, n long"


def _totals(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers(BYTE_BASE, len(data) + 1)
    return np.concatenate([np.zeros(1, U64), np.cumsum((data.astype(U64) + U64(1)) * up[:-1], dtype=U64)]), down


def sliding_least(key: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive keys."""
    n = len(key)
    pad = -n % width
    rows = np.concatenate([key, np.full(pad, np.iinfo(key.dtype).max, key.dtype)]).reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def anchors(data: np.ndarray, offsets: np.ndarray, size: int, gram: int) -> dict[str, np.ndarray]:
    """Anchors of the rows in ``data``: their row, gram hash g, hull hash h, and, within the row, lo, a and hi.

    The windows that pick the anchor at ``a`` start at ``lo`` to ``hi``; the hull is [lo, hi + size).
    """
    empty = np.empty(0, np.int64)
    if len(data) < size:
        return dict.fromkeys(("row", "g", "h", "lo", "a", "hi"), empty)
    total, down = _totals(data)
    at = np.arange(len(data) - gram + 1)
    g = mix((total[gram:] - total[:-gram]) * down[at])
    key = (g >> U64(PLACE_BITS) << U64(PLACE_BITS)) | at.astype(U64)
    pick = (sliding_least(key, size - gram + 1) & U64((1 << PLACE_BITS) - 1)).astype(np.int64)
    row = np.searchsorted(offsets, np.arange(len(pick)), side="right") - 1
    start = np.flatnonzero(np.arange(len(pick)) + size <= offsets[row + 1])
    if len(start) == 0:
        return dict.fromkeys(("row", "g", "h", "lo", "a", "hi"), empty)
    pick = pick[start]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (pick[1:] != pick[:-1]) | (row[start][1:] != row[start][:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    lo, hi, a = start[first], start[last], pick[first]
    hull = (total[hi + size] - total[lo]) * down[lo]
    base = offsets[row[lo]]
    return {
        "row": row[lo], "g": g[a].view(np.int64), "h": mix(hull ^ (hi - lo + 1).astype(U64) * U64(0xC2B2AE3D27D4EB4F)).view(np.int64),
        "lo": lo - base, "a": a - base, "hi": hi - base,
    }


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans, as maximal spans in order."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order]) if len(end) else end
    new = np.ones(len(start), dtype=bool)
    new[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(new)
    return start[first], end[np.append(first[1:], len(start)) - 1] if len(start) else end


def _pieces(column: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(rows, bytes, offsets, bytes before the first): slices of rows, a long row in overlapping pieces."""
    for lo, hi, data, offsets in slices(column, PIECE):
        if len(data) <= 2 * PIECE:
            yield np.arange(lo, hi), data, offsets, 0
            continue
        for k in range(0, len(data) - size + 1, PIECE):  # one row
            piece = data[k : k + PIECE + size - 1]
            yield np.arange(lo, hi), piece, np.array([0, len(piece)]), k


def _anchor_rows(texts: DataFrame, size: int, gram: int, every: bool) -> DataFrame:
    """Anchors, a class (g, h) once per piece with its number ``n``; spans of hulls repeated in a piece have g null.

    With ``every``, all anchors and no spans.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for rows, data, offsets, before in _pieces(batch.column(1), size):
                x = anchors(data, offsets, size, gram)
                if len(x["a"]) == 0:
                    continue
                rid = ids[rows[x["row"]]]
                order = np.lexsort((x["h"], x["g"]))
                g, h = x["g"][order], x["h"][order]
                new = np.ones(len(g), dtype=bool)
                new[1:] = every | (g[1:] != g[:-1]) | (h[1:] != h[:-1])
                n = np.diff(np.append(np.flatnonzero(new), len(g)))
                one = order[new]
                again = order[np.repeat(n > 1, n)]
                # spans of one row after the other, on one line
                line = offsets[x["row"][again]] * 2
                start, end = merged(line + x["lo"][again], line + x["hi"][again] + size)
                row = np.searchsorted(offsets * 2, start, side="right") - 1
                start, end = start - 2 * offsets[row], end - 2 * offsets[row]
                blank = len(row)

                def column(a: np.ndarray, spans: np.ndarray | None) -> pa.Array:
                    tail = pa.nulls(blank, pa.int64()) if spans is None else pa.array(spans.astype(np.int64))
                    return pa.concat_arrays([pa.array(a.astype(np.int64)), tail])

                yield pa.RecordBatch.from_arrays(
                    [
                        column(rid[one], ids[rows[row]]), column(x["g"][one], None), column(x["h"][one], None),
                        column(x["lo"][one] + before, start + before), column(x["a"][one] + before, None),
                        column(x["hi"][one] + before, end + before), column(n, None),
                    ],
                    ["rid", "g", "h", "lo", "a", "hi", "n"],
                )
                release_memory()

    return texts.select("rid", "text").mapInArrow(find, ANCHOR)


# ------------------------------------------------------------------ the interval tree of one gram
def common_prefix(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    low, high = 0, n  # x[:low] == y[:low], x[:high] != y[:high]
    while high - low > 1:
        mid = (low + high) // 2
        if x[low:mid] == y[low:mid]:
            low = mid
        else:
            high = mid
    return low


class _Least:
    """The least of any range of a list."""

    def __init__(self, values: list[int]):
        self.levels = [values]
        width = 1
        while 2 * width <= len(values):
            row = np.array(self.levels[-1])
            self.levels.append(np.minimum(row[:-width], row[width:]).tolist())
            width *= 2

    def of(self, low: int, high: int) -> int:
        level = (high - low).bit_length() - 1
        row = self.levels[level]
        return min(row[low], row[high - (1 << level)])


def intervals(lcp: list[int], floor: int) -> Iterator[tuple[int, int, int]]:
    """(l, first, last) of every maximal range of an array whose neighbours share l, for l of at least ``floor``."""
    stack = [(-1, 0)]  # (l, first)
    for k, l in enumerate([*lcp, -1]):  # noqa: E741
        first = k
        while stack[-1][0] > l:
            high, first = stack.pop()
            if high >= floor:
                yield high, first, k
        if stack[-1][0] < l:
            stack.append((l, first))


def reach(hulls: list[bytes], at: list[int], size: int, groups: list | None = None) -> list[tuple[int, int]]:
    """Per hull how far left and right of its anchor (place ``at``) repeats of ``size`` bytes or more reach; (0, 0) for none.

    ``groups`` collects the maximal repeats as (l, r, members).
    """
    count = len(hulls)
    right = [x[k:] for x, k in zip(hulls, at, strict=True)]
    left = [x[:k][::-1] for x, k in zip(hulls, at, strict=True)]
    array = sorted(range(count), key=right.__getitem__)
    lcp = [common_prefix(right[a], right[b]) for a, b in zip(array, array[1:], strict=False)]
    by_left = sorted(range(count), key=left.__getitem__)
    rank = [0] * count
    for k, x in enumerate(by_left):
        rank[x] = k
    least = _Least([common_prefix(left[a], left[b]) for a, b in zip(by_left, by_left[1:], strict=False)])
    longest = max(map(len, left))
    best_left, best_right = [0] * count, [0] * count  # by left rank

    def part(low: int, high: int, r: int) -> None:
        """Neighbours in left order that meet at r: where do they part?"""
        l = least.of(low, high)  # noqa: E741
        if l + r >= size:
            for x in (low, high):
                best_left[x], best_right[x] = max(best_left[x], l), max(best_right[x], r)

    def close(children: list[list[int]], r: int) -> list[int]:
        """The members of an LCP interval, in left order, from those of the intervals within it."""
        if r + longest < size:  # nothing here or further up is long enough
            return []
        if groups is not None:
            child = {x: k for k, c in enumerate(children) for x in c}
            members = sorted(child)
            parts = [least.of(a, b) for a, b in zip(members, members[1:], strict=False)]
            for l, first, last in intervals(parts, size - r):  # noqa: E741
                if len({child[x] for x in members[first : last + 1]}) > 1:  # else it goes on to the right
                    groups.append((l, r, [by_left[x] for x in members[first : last + 1]]))
        children = sorted(children, key=len)
        large = children.pop()
        while children:
            small = children.pop()
            for x in small:
                k = bisect_left(large, x)
                if k:
                    part(large[k - 1], x, r)
                if k < len(large):
                    part(x, large[k], r)
            if 8 * len(small) < len(large):
                for x in small:
                    insort(large, x)
            else:
                large = sorted(large + small)
        return large

    sets, joins = [[rank[array[0]]]], []  # the stack: intervals still open, and the LCP between each two

    def unwind(floor: int) -> None:
        while joins and joins[-1] > floor:
            r, children = joins[-1], [sets.pop()]
            while joins and joins[-1] == r:
                joins.pop()
                children.append(sets.pop())
            sets.append(close(children, r))

    for k in range(1, count):
        unwind(lcp[k - 1])
        joins.append(lcp[k - 1])
        sets.append([rank[array[k]]])
    unwind(-1)
    return [(best_left[rank[x]], best_right[rank[x]]) for x in range(count)]


def whole_hulls(hulls: list[bytes], at: list[int], n: list[int]) -> Iterator[tuple[int, int, list[int]]]:
    """(l, r, members) of every hull that is there more than once, with the other hulls that hold it."""
    array = sorted((x[k:], i) for i, (x, k) in enumerate(zip(hulls, at, strict=True)))
    for x, (hull, k) in enumerate(zip(hulls, at, strict=True)):
        if n[x] > 1:
            members, place = [], bisect_left(array, (hull[k:], -1))
            while place < len(array) and array[place][0].startswith(hull[k:]):
                y = array[place][1]
                if hulls[y][: at[y]].endswith(hull[:k]):
                    members.append(y)
                place += 1
            yield k, len(hull) - k, members


# ------------------------------------------------------------------ over all texts
class _Classes:
    """Hull classes and what is known of each; frames are written tables."""

    def __init__(self, docs: DataFrame, text_col: str, keep: list[str], size: int, max_group: int, every: bool = False):
        self.size = size
        rows = with_row_id(docs.select(*[F.col(c).alias(f"_{c}") for c in keep], F.coalesce(F.col(text_col), F.lit("")).alias("text")), "rid")
        self.texts = stored(rows, "repeat_texts", compression="zstd")
        self.rows = stored(_anchor_rows(self.texts, size, min(GRAM, max(1, size // 4)), every), "repeat_anchors")
        self.anchors = self.rows.where("g IS NOT NULL")
        one = F.min(F.struct("rid", "lo", "a", "hi")).alias("one")
        classes = self.anchors.groupBy("g", "h").agg(F.sum("n").alias("n"), one)
        self.classes = stored(classes, "repeat_classes")
        grams = self.classes.groupBy("g").agg(F.count("h").alias("d"), F.sum("n").alias("total")).where("total > 1")
        self.mixed = stored(self.classes.join(grams.where("d > 1").select("g", "d"), "g").select("g", "h", "n", "d", "one.*"), "repeat_mixed")
        self.hulls = stored(self._cut(self.mixed), "repeat_hulls", compression="zstd")
        self.max_group = max_group

    def _cut(self, wanted: DataFrame) -> DataFrame:
        """(g, h, n, d, at, hull): the bytes of one hull per class."""
        size = self.size
        per_text = wanted.groupBy("rid").agg(F.collect_list(F.struct("g", "h", "n", "d", "lo", "a", "hi")).alias("parts"))
        joined = per_text.join(self.texts.select("rid", "text"), "rid").select("text", "parts")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    text = batch.column(0)[k].as_buffer().to_pybytes()
                    parts = batch.column(1)[k].values
                    field = {f: np.asarray(parts.field(f)) for f in ("g", "h", "n", "d", "lo", "a", "hi")}
                    for low in range(0, len(parts), 1000):
                        x = {f: v[low : low + 1000] for f, v in field.items()}
                        hulls = [text[lo : hi + size] for lo, hi in zip(x["lo"], x["hi"], strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [*[pa.array(x[f]) for f in ("g", "h", "n", "d")], pa.array(x["a"] - x["lo"]), pa.array(hulls, pa.binary())],
                            ["g", "h", "n", "d", "at", "hull"],
                        )

        return joined.mapInArrow(cut, "g long, h long, n long, d long, at long, hull binary")

    def _grams(self) -> DataFrame:
        """Hulls of the grams that one task sorts, gram by gram."""
        return self.hulls.where(F.col("d") <= self.max_group).repartition("g").sortWithinPartitions("g", "h")

    def windows(self) -> DataFrame:
        """(x, g, h, n, o): the hash x of every window, o bytes into its hull, of grams with more hulls than that."""
        size = self.size

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    total, down = _totals(np.frombuffer(batch.column(3)[k].as_buffer(), np.uint8))
                    count = len(total) - size
                    x = mix((total[size:] - total[:-size]) * down[:count]).view(np.int64)
                    same = [pa.array(np.full(count, batch.column(c)[k].as_py(), np.int64)) for c in range(3)]
                    yield pa.RecordBatch.from_arrays([pa.array(x), *same, pa.array(np.arange(count))], ["x", "g", "h", "n", "o"])

        big = self.hulls.where(F.col("d") > self.max_group).select("g", "h", "n", "hull")
        return big.mapInArrow(spread, "x long, g long, h long, n long, o long")

    def extents(self) -> DataFrame:
        """(g, h, s, e): the repeated bytes [s, e) of the hulls of each class, those without any left out."""
        size = self.size

        def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for g, h, _, at, hulls in _by_gram(batches):
                far = np.array(reach(hulls, at, size), np.int64).reshape(-1, 2)
                hit = np.flatnonzero(far.any(axis=1))
                at = np.array(at, np.int64)
                if len(hit):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(hit), g, np.int64)), pa.array(np.array(h, np.int64)[hit]), pa.array((at - far[:, 0])[hit]), pa.array((at + far[:, 1])[hit])],
                        ["g", "h", "s", "e"],
                    )

        sorted_ = self._grams().mapInArrow(sort, "g long, h long, s long, e long")
        windows = self.windows()
        twice = windows.groupBy("x").agg(F.sum("n").alias("times")).where("times > 1").select("x")
        counted = windows.join(twice, "x").groupBy("g", "h").agg(F.min("o").alias("s"), (F.max("o") + size).alias("e"))
        whole = self.classes.where("n > 1").select("g", "h", F.lit(0).cast("long").alias("s"), (F.col("one.hi") - F.col("one.lo") + size).alias("e"))
        every = whole.unionByName(sorted_).unionByName(counted)
        return every.groupBy("g", "h").agg(F.min("s").alias("s"), F.max("e").alias("e"))

    def spans(self) -> DataFrame:
        """(rid, start, end): repeated bytes of the texts, overlapping."""
        found = self.anchors.join(self.extents(), ["g", "h"]).select("rid", (F.col("lo") + F.col("s")).alias("start"), (F.col("lo") + F.col("e")).alias("end"))
        return found.unionByName(self.rows.where("g IS NULL").select("rid", F.col("lo").alias("start"), F.col("hi").alias("end")))

    def discard(self) -> None:
        discard(self.texts, self.rows, self.classes, self.mixed, self.hulls)


def _by_gram(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list, list, list]]:
    """(g, h, n, at, hulls) of every gram in rows sorted by it."""
    gram, held = None, ([], [], [], [])
    for batch in batches:
        names = ("g", "h", "n", "at", "hull")
        for g, *rest in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names], strict=True):
            if g != gram:
                if gram is not None:
                    yield gram, *held
                gram, held = g, ([], [], [], [])
            for values, value in zip(held, rest, strict=True):
                values.append(value)
    if gram is not None:
        yield gram, *held


def _unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name = "_" + name
    return name


def remove_repeated_bytes(
    docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, size: int = SIZE, max_group: int = MAX_GROUP, with_text: bool = True
) -> DataFrame:
    """The columns ``keep`` (all but the text) and n_bytes, n_removed, n_spans, kept_sha256, kept (bytes).

    Every byte goes that a ``size``-byte string covers which also starts anywhere else, in the
    same text or another; strings are judged on the input. Cutting may leave half a character, so
    what is kept are bytes.
    """
    require(docs, text_col, *(keep or []))
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    spark = docs.sparkSession
    with arrow_batches(spark):
        classes = _Classes(docs, text_col, keep, size, max_group)
        spans = classes.spans().groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
        joined = classes.texts.join(spans, "rid", "left").select(*[f"_{c}" for c in keep], "text", "spans")
        fields = [f"`{f.name[1:]}` {f.dataType.simpleString()}" for f in joined.schema.fields[: len(keep)]]
        results = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for k in range(batch.num_rows):
                    text = batch.column(len(keep))[k].as_buffer()
                    pieces, removed = [], 0
                    found = batch.column(len(keep) + 1)[k].values
                    runs = 0
                    if found is not None and len(found):
                        start, end = merged(np.asarray(found.field("start")), np.asarray(found.field("end")))
                        runs, removed, last = len(start), int((end - start).sum()), 0
                        for s, e in zip(start.tolist(), end.tolist(), strict=True):
                            pieces.append(text[last:s])
                            last = e
                        pieces.append(text[last:])
                    else:
                        pieces = [text]
                    sha = hashlib.sha256()
                    for p in pieces:
                        sha.update(p)
                    out.append((text.size, removed, runs, sha.hexdigest(), b"".join(p.to_pybytes() for p in pieces) if with_text else None))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: 5 if with_text else 4]
                columns = [pa.array([r[c] for r in out], t) for c, t in enumerate(types)]
                names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: len(types)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *columns], names=[*keep, *names])

        out = stored(joined.mapInArrow(cut, ", ".join([*fields, results])), "repeat_result")
        classes.discard()
    return out


def maximal_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, max_group: int = MAX_GROUP) -> DataFrame:
    """(repeat, n_bytes, doc_id, start): every occurrence of the maximal repeats around anchors, ``repeat`` a hash of the string.

    A string is cut off where the hulls that hold it end, so one much longer than ``size`` shows as
    several that overlap. Equal hulls are a group; a gram with more than ``max_group`` hulls gives
    its repeated windows.
    """
    require(docs, id_col, text_col)
    with arrow_batches(docs.sparkSession):
        classes = _Classes(docs, text_col, [id_col], size, max_group, every=True)
        schema = "g long, h long, s long, e long, repeat string"

        def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for g, h, n, at, hulls in _by_gram(batches):
                groups: list = list(whole_hulls(hulls, at, n))
                reach(hulls, at, size, groups)
                rows = set()
                for l, r, members in groups:  # noqa: E741
                    name = hashlib.md5(hulls[members[0]][at[members[0]] - l : at[members[0]] + r]).hexdigest()
                    rows.update((g, h[x], at[x] - l, at[x] + r, name) for x in members)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*sorted(rows), strict=True)], ["g", "h", "s", "e", "repeat"])

        groups = classes._grams().mapInArrow(group, schema)
        windows = classes.windows()
        twice = windows.groupBy("x").agg(F.sum("n").alias("times")).where("times > 1").select("x")
        name = F.hex(F.col("x")).alias("repeat")
        counted = windows.join(twice, "x").select("g", "h", F.col("o").alias("s"), (F.col("o") + size).alias("e"), name)
        length = F.col("one.hi") - F.col("one.lo") + size
        alone = classes.classes.where("n > 1").join(classes.mixed.select("g").distinct(), "g", "left_anti")
        same = alone.select("g", "h", F.lit(0).cast("long").alias("s"), length.alias("e"), F.concat_ws("-", F.hex("g"), F.hex("h")).alias("repeat"))
        found = same.unionByName(groups).unionByName(counted)
        ids = classes.texts.select("rid", F.col(f"_{id_col}").alias(id_col))
        places = classes.anchors.join(found, ["g", "h"]).join(ids, "rid")
        return stored(places.select("repeat", (F.col("e") - F.col("s")).alias("n_bytes"), id_col, (F.col("lo") + F.col("s")).alias("start")), "repeat_groups")


def op11_repeats(documents: DataFrame) -> DataFrame:
    """Per document its bytes, those removed, their runs, and the hash of what is kept."""
    return remove_repeated_bytes(documents, keep=["doc_id"], with_text=False)


#: texts are hex, cut into pieces of 2000 bytes so that a window is found fast; runs of repeated starts at most 400 apart are spans
ORACLE_OP11 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT r, c, substr(x, 2 * c + 1, 4798) AS x FROM (SELECT r, x, unnest(range(0, length(x) // 2 - 399, 2000)) AS c FROM d)),
w AS (SELECT r, c + i AS i, md5(substr(x, 2 * i + 1, 800)) AS h FROM (SELECT r, c, x, unnest(range(least(2000, length(x) // 2 - 399))) AS i FROM p)),
again AS (SELECT r, i FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
runs AS (SELECT r, min(i) AS s, max(i) + 400 AS e FROM (
  SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM (
    SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 400 THEN 0 ELSE 1 END AS fresh FROM again)) GROUP BY r, run),
kept AS (SELECT r, s, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS a, s AS b FROM (
  SELECT r, s, e FROM runs UNION ALL SELECT r, length(x) // 2, length(x) // 2 FROM d)),
texts AS (SELECT k.r, string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a, b) AS x FROM kept k JOIN d ON d.r = k.r GROUP BY k.r)
SELECT doc_id, CAST(length(d.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, CAST(coalesce(c, 0) AS BIGINT) AS n_spans,
  sha256(unhex(t.x)) AS kept_sha256
FROM d JOIN texts t ON t.r = d.r LEFT JOIN (SELECT r, sum(e - s) AS n, count(*) AS c FROM runs GROUP BY r) g ON g.r = d.r
"""
