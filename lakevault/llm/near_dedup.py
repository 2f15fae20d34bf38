"""MinHash near-deduplication: one-permutation hashing, bands, star-shaped candidates.

A document's set holds its distinct 5-word shingles (lower-cased ASCII; a shorter
text is one shingle). One permutation puts every shingle into one of ``BINS``
bins by one hash and keeps the bin's smallest other hash; empty bins copy from a
full one by optimal densification (a random probe sequence per bin, the same for
all documents). ``BANDS`` bands of ``ROWS`` bins name buckets. At a similarity
of 0.85 two documents share no bucket with a chance of 2e-9.

Equal sets are one class (a digest of the set, grouped with partial aggregates),
so copies, however many, never meet in a bucket. In a bucket of classes the
candidates form a star: every member is compared with the one that has the most
company in all its buckets (in a group of near copies, the text they come from).
Links are confirmed on the full shingle sets of both texts and give components.

A bucket whose members are in one component is done. In the others no link may be
lost: every pair across components is a candidate again, unless a bound rules it
out. A shingle that occurs in no other component's active text cannot be shared
across components, so with at most m other shingles on the poorer side, n1 and
n2 in all, the similarity is at most m / (n1 + n2 - m). The same holds with the
sum, over hash groups of shingles, of the lesser number of other shingles for m,
which tells apart texts that lack different parts of what they come from. A text whose private
shingles alone rule out a link with anything drops out first. (Near copies that
are not alike enough differ by their own edits, which are private, so few of
their many pairs are left.) A pair is made in the first of its common buckets.

Texts of candidates are taken once from compressed blocks, by block key. Pairs
are joined with them by id, a join that Spark splits when a hub is hot.

Defined cases: a null text, or one without words, has an empty set and is linked
with nothing; rows that repeat an id are rows of their own, of which the first
with the component's smallest id is kept; a null id is never a component's id
unless all its ids are null; extra columns pass through; an empty table gives no
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.blocks import MESSAGE, TEXT, Messages, exchange, expand, squeeze, with_answers, write_blocks
from lakevault.llm.common import LOWER, U64, WORD_BASE, discard, mix, release_memory, require, slices, stored, window_hashes, word_hashes, word_spans
from lakevault.llm.components import components

SHINGLE = 5
BINS, BANDS, ROWS = 252, 42, 6
CHUNK = 1 << 14  # rows of one signature message
GROUPS = 64  # hash groups in which two rows' shingles are held against each other


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, row of each shingle, hash): each row's distinct shingles, sorted."""
    for lo, hi, data, offsets in slices(texts, max_rows=2048):
        data = LOWER[data]
        starts, ends, rows = word_spans(data, offsets)
        words = word_hashes(data, starts, ends)
        at, h = window_hashes(words, rows, size)
        owner = rows[at]
        count = np.bincount(rows, minlength=hi - lo)
        short = np.flatnonzero((count > 0) & (count < size))
        if len(short):  # the whole sequence as one shingle
            first = np.searchsorted(rows, short)
            for n in range(1, size):
                mine = count[short] == n
                k, hn = window_hashes(words, rows, n)
                whole = np.searchsorted(k, first[mine])
                owner = np.concatenate([owner, short[mine]])
                h = np.concatenate([h, mix(hn[whole] ^ U64(n))])
        order = np.lexsort((h, owner))
        owner, h = owner[order], h[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
        yield lo, hi, owner[new] + lo, h[new]


def _probe(bin_: np.ndarray, turn: int) -> np.ndarray:
    """The bin that an empty bin asks at its ``turn``-th try."""
    return (mix(bin_.astype(U64) * U64(0x51ED270B) + U64(turn * WORD_BASE & 0xFFFFFFFFFFFFFFFF)) >> U64(33)).astype(np.int64) % BINS


def signatures(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """n x BINS signatures of sorted (row, hash) sets; every row must have a shingle."""
    mixed = mix(hashes ^ U64(0x6A09E667F3BCC909))
    key = rows * BINS + (mixed >> U64(32)).astype(np.int64) % BINS
    value = mix(hashes ^ U64(0xBB67AE8584CAA73B))
    order = np.lexsort((value, key))
    key, value = key[order], value[order]
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    out = np.zeros(n * BINS, U64)
    full = np.zeros(n * BINS, dtype=bool)
    out[key[first]] = value[first]
    full[key[first]] = True
    empty = np.flatnonzero(~full)
    turn = 0
    while len(empty):
        turn += 1
        bins = empty % BINS
        asked = empty - bins + _probe(bins, turn)
        found = full[asked]
        out[empty[found]] = out[asked[found]]
        empty = empty[~found]
    return out.reshape(n, BINS)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """n x BANDS bucket names."""
    keys = np.zeros((len(signature), BANDS), U64)
    for r in range(ROWS):
        keys = mix(keys * U64(WORD_BASE) + signature[:, r::ROWS])
    return mix(keys + np.arange(BANDS, dtype=U64)[None, :] * U64(0x9E3779B97F4A7C15))


def _describe(block: int, rows: pa.Table, text_col: str, id_col: str) -> Messages:
    """Per CHUNK of rows: ids, set sizes, set digests and bucket names."""
    n = rows.num_rows
    sizes = np.zeros(n, np.int32)
    digest = np.zeros((n, 2), U64)
    keys = np.zeros((n, BANDS), U64)
    for _, _, owner, h in shingle_sets(rows.column(text_col)):
        if len(owner) == 0:
            continue
        mine, first, count = np.unique(owner, return_index=True, return_counts=True)
        sizes[mine] = count
        digest[mine, 0] = np.add.reduceat(mix(h ^ U64(0x3C6EF372FE94F82B)), first)
        digest[mine, 1] = np.add.reduceat(mix(h ^ U64(0xA54FF53A5F1D36F1)), first)
        keys[mine] = band_keys(signatures(np.repeat(np.arange(len(mine)), count), h, len(mine)))
    ids = rows.column(id_col).combine_chunks().cast(pa.int64())
    known = np.asarray(ids.is_valid())
    ids = np.asarray(ids.fill_null(0))
    return [
        (0, squeeze(np.arange(a, min(n, a + CHUNK)), ids[a : a + CHUNK], known[a : a + CHUNK], sizes[a : a + CHUNK],
                    digest[a : a + CHUNK, 0], digest[a : a + CHUNK, 1], keys[a : a + CHUNK].ravel()))
        for a in range(0, n, CHUNK)
    ]


def _unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            row, ids, known, sizes, d1, d2, keys = expand(data.as_py())
            for a in range(0, len(row), 2048):
                b = slice(a, a + 2048)
                flat = pa.array(keys.reshape(-1, BANDS)[b].ravel().view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block + row[b]),
                        pa.array(ids[b], mask=~known[b]),
                        pa.array(sizes[b]),
                        pa.array(d1[b].view(np.int64)),
                        pa.array(d2[b].view(np.int64)),
                        pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32), flat),
                    ],
                    ["row", "id", "n", "d1", "d2", "keys"],
                )


def _texts_of(blocks: DataFrame, wanted: DataFrame, text_col: str) -> DataFrame:
    """(row, text): the texts of the wanted rows, compressed."""

    def take(block: int, rows: pa.Table, answers: dict[int, bytes]) -> pa.Table:
        numbers = np.array(sorted(answers), np.int64)
        found = rows.column(text_col).take(pa.array(numbers)).to_pylist() if len(numbers) else []
        squeezer = zstandard.ZstdCompressor(level=3)
        packed = [squeezer.compress((t or "").encode()) for t in found]
        return pa.table({"row": pa.array(numbers + block), "text": pa.array(packed, pa.binary())})

    address = F.col("row").bitwiseAND(F.lit(0xFFFF))
    asked = wanted.select((F.col("row") - address).alias("block"), address.alias("part"), F.lit(b"").alias("data"))
    met = blocks.join(asked.select("block").distinct(), "block", "left_semi")
    return with_answers(met, asked, take, "row long, text binary")


def _confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets have a similarity of ``percent`` / 100 at least."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                n = part.num_rows
                sets = _plain_sets(pa.chunked_array([part.column(2), part.column(3)]))
                linked = []
                for k in range(n):
                    a, b = sets[k], sets[n + k]
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    linked.append(100 * both >= percent * (len(a) + len(b) - both) and both > 0)
                yield part.select(["u", "v"]).filter(pa.array(linked, pa.bool_()))
            release_memory()

    left = texts.select(F.col("row").alias("u"), F.col("text").alias("tu"))
    right = texts.select(F.col("row").alias("v"), F.col("text").alias("tv"))
    joined = pairs.join(right, "v").join(left, "u").select("u", "v", "tu", "tv")
    return joined.mapInArrow(check, "u long, v long")


def _plain_sets(packed: pa.ChunkedArray) -> list[np.ndarray]:
    """The sorted shingle set of every compressed text."""
    unzip = zstandard.ZstdDecompressor().decompress
    plain = pa.array([unzip(x.as_py()).decode() for x in packed], pa.string())
    sets: list[np.ndarray] = [np.empty(0, U64)] * len(plain)
    for _, _, owner, h in shingle_sets(plain):
        mine, first = np.unique(owner, return_index=True)
        for k, own in zip(mine, np.split(h, first[1:]), strict=True):
            sets[k] = own
    return sets


def _common(texts: DataFrame) -> DataFrame:
    """(row, common, groups): how many of a row's shingles also occur in a row of another component
    ``c``, in all and by hash group.

    A block sends each of its shingles once, with its smallest and largest component.
    """
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, size // (1 << 20))

    def parts(sets: list[np.ndarray]):
        """Owner and shingle number of every entry, the sorted shingles, and their slices by hash range."""
        every = np.concatenate(sets) if sets else np.empty(0, U64)
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        shingles, number = np.unique(every, return_inverse=True)
        address = (shingles >> U64(32)).astype(np.int64) * ranges >> 32
        places, first = np.unique(address, return_index=True)
        ends = np.append(first[1:], len(shingles))
        return owner, number, shingles, [(int(k), slice(a, b)) for k, a, b in zip(places, first, ends, strict=False)]

    def ask(_block: int, rows: pa.Table) -> Messages:
        owner, number, shingles, by_range = parts(_plain_sets(rows.column("text")))
        if len(shingles) == 0:
            return []
        component = np.asarray(rows.column("c").combine_chunks())[owner][np.argsort(number, kind="stable")]
        first = np.append(0, np.cumsum(np.bincount(number))[:-1])
        lo, hi = np.minimum.reduceat(component, first), np.maximum.reduceat(component, first)
        return [(k, squeeze(shingles[own], lo[own], hi[own])) for k, own in by_range]

    def tell(_range: int, messages: list[tuple[int, bytes]]) -> list[tuple[int, bytes]]:
        found = [expand(data) for _, data in messages]
        h, lo, hi = (np.concatenate([f[k] for f in found]) for k in range(3))
        order = np.argsort(h, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
        mixed = np.minimum.reduceat(lo[order], first) != np.maximum.reduceat(hi[order], first)
        wide = np.empty(len(h), dtype=bool)
        wide[order] = np.repeat(mixed, np.diff(np.append(first, len(h))))
        ends = np.cumsum([len(f[0]) for f in found])
        return [(b, np.packbits(x).tobytes()) for (b, _), x in zip(messages, np.split(wide, ends[:-1]), strict=True)]

    def count(_block: int, rows: pa.Table, answers: dict[int, bytes]) -> pa.Table:
        sets = _plain_sets(rows.column("text"))
        owner, number, shingles, by_range = parts(sets)
        wide = np.zeros(len(shingles), dtype=bool)
        for k, own in by_range:
            wide[own] = np.unpackbits(np.frombuffer(answers[k], np.uint8), count=own.stop - own.start).astype(bool)
        met = wide[number]
        group = (mix(shingles ^ U64(0x94D049BB133111EB)) >> U64(32)).astype(np.int64) % GROUPS
        groups = np.bincount(owner[met] * GROUPS + group[number][met], minlength=len(sets) * GROUPS).astype(np.int32)
        common = groups.reshape(-1, GROUPS).sum(axis=1, dtype=np.int64)
        lists = pa.ListArray.from_arrays(np.arange(0, len(groups) + 1, GROUPS, dtype=np.int32), groups)
        return pa.table({"row": rows.column("row"), "common": pa.array(common), "groups": lists})

    written = write_blocks(texts, "text", "common", ask, block_bytes=2 << 20)
    answers = exchange(written.where(F.col("kind") == MESSAGE), tell)
    return with_answers(written.where(F.col("kind") == TEXT), answers, count, "row long, common long, groups array<int>")


def link_near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = 85
) -> tuple[DataFrame, DataFrame]:
    """(blocks, rows): the written blocks, and per row its row key, id, n, component_id and kept."""
    require(docs, id_col, text_col)
    written = write_blocks(docs, text_col, "near", lambda b, r: _describe(b, r, text_col, id_col))
    blocks = written.where(F.col("kind") == TEXT)
    messages = written.where(F.col("kind") == MESSAGE).select("block", "data")
    rows = messages.mapInArrow(_unfold, "row long, id long, n int, d1 long, d2 long, keys array<long>")
    rows = stored(rows, "signatures")

    # classes of equal sets, named by one of their rows
    digest = ["n", "d1", "d2"]
    some = rows.where("n > 0")
    classes = stored(some.groupBy(*digest).agg(F.min("row").alias("class")), "classes")
    heads = some.join(classes.select(F.col("class").alias("row")), "row", "left_semi")
    members = stored(heads.select("row", "n", F.explode("keys").alias("bucket")), "members")
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stored(members.join(sizes, "bucket"), "buckets")
    texts = stored(_texts_of(blocks, shared.select("row").distinct(), text_col), "texts")

    # stars: each bucket's member with the most company is compared with the others
    company = shared.groupBy("row").agg(F.sum("size").alias("company"))
    first = F.max_by(F.struct(F.col("row").alias("hub"), F.col("n").alias("hub_n")), F.struct("company", -F.col("row")))
    hubs = shared.join(company, "row").groupBy("bucket").agg(first.alias("h")).select("bucket", "h.*")
    similar = F.expr(f"100L * least(n, hub_n) >= {percent}L * greatest(n, hub_n)")  # sizes alone can rule a pair out
    pairs = shared.join(hubs, "bucket").where((F.col("row") != F.col("hub")) & similar)
    pairs = pairs.select(F.least("row", "hub").alias("u"), F.greatest("row", "hub").alias("v")).distinct()
    links = stored(_confirm(pairs, texts, percent), "links")
    component = components(links)

    # buckets that still hold several components: all pairs across them that a link is possible for
    labelled = shared.join(component, F.col("row") == F.col("node"), "left")
    labelled = labelled.select("row", "n", "bucket", F.coalesce("component", "row").alias("c"))
    mixed = labelled.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("bucket")
    active = stored(labelled.join(mixed, "bucket", "left_semi"), "active")
    common = _common(texts.join(active.select("row", "c").distinct(), "row").select("row", "c", "text"))
    alive_rows = stored(common.join(active.select("row", "n").distinct(), "row").where(f"100 * common >= {percent} * n"), "alive")
    alive = active.select("row", "c", "bucket").join(alive_rows, "row").join(rows.select("row", "keys"), "row")
    side = lambda k: alive.select("bucket", *[F.col(c).alias(c + k) for c in ("row", "c", "n", "common", "groups", "keys")])
    # of the shingles of one group both can share the lesser number, at most
    shared_most = "aggregate(zip_with(groups1, groups2, (x, y) -> least(x, y)), 0L, (s, x) -> s + x)"
    possible = F.expr(
        f"100 * least(common1, common2) >= {percent} * (n1 + n2 - least(common1, common2))"
        f" and (100 + {percent}) * {shared_most} >= {percent} * (n1 + n2)"
        " and bucket = array_min(array_intersect(keys1, keys2))"  # once for each pair
    )
    pairs = side("1").join(side("2"), "bucket").where((F.col("row1") < F.col("row2")) & (F.col("c1") != F.col("c2")) & possible)
    more = stored(_confirm(pairs.select(F.col("row1").alias("u"), F.col("row2").alias("v")), texts, percent), "links")
    if not more.isEmpty():
        component = components(links.unionByName(more))

    # component of each row, through its class; then its smallest id
    of_class = classes.join(component, F.col("class") == F.col("node"), "left").select(
        *digest, F.coalesce("component", "class").alias("c")
    )
    placed = rows.select("row", "id", *digest).join(of_class, digest, "left")
    placed = stored(placed.select("row", "id", "n", F.coalesce("c", "row").alias("c")), "placed")
    discard(rows, classes, members, shared, texts, links, active, alive_rows, more)
    least = placed.groupBy("c").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("m"))
    out = placed.join(least, "c").select(
        "row", "id", "n", F.col("m.id").alias("component_id"), (F.col("row") == F.col("m.row")).alias("kept")
    )
    return blocks, out


def keep_one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """``docs`` without all but one document of each group of near duplicates; columns unchanged."""
    blocks, rows = link_near_duplicates(docs, id_col=id_col, text_col=text_col, percent=percent)
    address = F.col("row").bitwiseAND(F.lit(0xFFFF))
    gone = rows.where(~F.col("kept")).select(
        (F.col("row") - address).alias("block"), address.alias("part"), F.lit(b"").alias("data")
    )

    def drop(_block: int, table: pa.Table, answers: dict[int, bytes]) -> pa.Table:
        stays = np.ones(table.num_rows, dtype=bool)
        stays[np.array(list(answers), np.int64)] = False
        return table.filter(pa.array(stays))

    return with_answers(blocks, stored(gone, "gone"), drop, docs.schema)


def op4_near_dedup(docs: DataFrame) -> DataFrame:
    """The registered query: similarity of 0.85 on 5-word shingles."""
    _, rows = link_near_duplicates(docs.select("doc_id", "text"))
    return rows.select(
        F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


ORACLE_OP4 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[k : k + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (
  SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * common >= 85 * (a.n + b.n - common)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.v FROM r JOIN e ON r.y = e.u),
c AS (SELECT x, min(y) AS m FROM r GROUP BY x)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m AS component_id, doc_id = m AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN c ON c.x = doc_id
"""
