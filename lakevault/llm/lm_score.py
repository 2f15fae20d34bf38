"""Language-model scores: a causal self-attention model on subword ids, and a word unigram.

One pass cuts the texts into blocks, split into words and subword ids once and written
in that form; each sends its distinct words with their counts in training rows to the
word's hash range, and its counts of subword ids, for the model's classes. The ranges
add the words' counts up, over all documents, and answer every block for its own words.
The model is trained on all training rows, cut into windows that hold every token once
as what is to be predicted. Each round of local training takes its part of the rows:
tasks train on their blocks from the same start, and the average of the flat weights
(one row per task and weight, a partial aggregate) starts the next round. The last pass
meets each block with its words' counts and scores all whole texts in overlapping
windows, every token once.

Only figures of a fixed size reach the driver: two sums, the counts of the
tokenizer's ids and the model's weights.

Defined cases: a null or empty text is the end token alone; without training rows
the unigram is uniform over unknown words and the model stays as it was set up;
repeated rows are scored, and learned from, each; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.llm.attention import CONTEXT, LEAST_STEPS, Classes, Scorer, fresh, make_classes, train
from lakevault.llm.blocks import BLOCK_BYTES, MESSAGE, TEXT, Messages, exchange, expand, squeeze, unpack, with_answers, write_blocks
from lakevault.llm.common import LOWER, U64, arrow_batches, one_blas_thread, require, slices, stored, word_hashes, word_spans
from lakevault.llm.quality_model import remainder
from lakevault.llm.tokens import ByteBpe, tokenizer_path

END = 50256  # the tokenizer's end of text, also what stands before a text
VOCABULARY = 50257
BYTES_PER_RANGE = 16 << 20
BLOCKS_PER_TRAINER = 4
POOL = 1 << 17  # windows that are held, and gone through in a random order, at a time
KNOWN_WORDS = 1 << 19  # whose subword ids a task keeps
TOTALS, IDS = -1, 1 << 60
NONE = 255  # no class: beyond a text's end
BLOCK = b"words"  # the metadata of a block that holds its words


class Words:
    """A block's words in lower case: distinct ones by hash, and which each word is."""

    def __init__(self, texts: pa.Array):
        hashes, rows, spans = [], [], []
        for lo, _, data, offsets in slices(texts):
            data = LOWER[data]
            starts, ends, row = word_spans(data, offsets)
            hashes.append(word_hashes(data, starts, ends))
            rows.append(row + lo)
            spans.append((data, starts, ends))
        self.rows = np.concatenate(rows) if rows else np.empty(0, np.int64)
        every = np.concatenate(hashes) if hashes else np.empty(0, U64)
        order = np.argsort(every)
        sorted_hash = every[order]
        new = np.ones(len(every), dtype=bool)
        new[1:] = sorted_hash[1:] != sorted_hash[:-1]
        self.hash, shown = sorted_hash[new], order[new]  # any place where the word stands shows it
        self.number = np.empty(len(every), np.int32)
        self.number[order] = np.cumsum(new, dtype=np.int32) - 1
        bounds = np.cumsum([0, *(len(s[1]) for s in spans)])
        self.distinct: list[bytes] = [b""] * len(shown)
        part = np.searchsorted(bounds, shown, side="right") - 1
        for k, (data, starts, ends) in enumerate(spans):
            raw = data.tobytes()
            mine = np.flatnonzero(part == k)
            at = shown[mine] - bounds[k]
            for j, a, b in zip(mine.tolist(), starts[at].tolist(), ends[at].tolist(), strict=True):
                self.distinct[j] = raw[a:b]

    def ranges(self, count: int) -> Iterator[tuple[int, slice]]:
        """(range of hashes, the distinct words in it)."""
        address = (self.hash >> U64(32)).astype(np.int64) * count >> 32
        parts, first = np.unique(address, return_index=True)
        for part, a, b in zip(parts, first, np.append(first, len(address))[1:], strict=True):
            yield int(part), slice(int(a), int(b))


def _ids(bpe: ByteBpe, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids of words (each behind a blank), joined, and their number per word.

    The tokenizer cuts before a blank, so words are encoded many at a time, and the ids whose
    text begins with a blank tell where each begins. Words that hold white space of another
    kind, next to which it may cut otherwise, are encoded one by one.
    """
    texts = [w.decode("utf-8", "replace") for w in words]
    if " ".join(texts).split() != texts:
        plain = np.array([t.split() == [t] for t in texts], dtype=bool)
        if not plain.all():
            found = [bpe.fast.encode_ordinary(" " + t) for t, p in zip(texts, plain, strict=True) if not p]
            ids, lengths = _ids(bpe, [w for w, p in zip(words, plain, strict=True) if p])
            size = np.empty(len(words), np.int64)
            size[plain], size[~plain] = lengths, [len(f) for f in found]
            out = np.empty(int(size.sum()), np.int64)
            mine = np.repeat(plain, size)
            out[mine], out[~mine] = ids, [i for f in found for i in f]
            return out, size
    blank = _opening(bpe)
    parts = [np.array(bpe.fast.encode_ordinary(" " + " ".join(texts[k : k + 4096])), np.int64) for k in range(0, len(texts), 4096)]
    ids = np.concatenate(parts) if parts else np.empty(0, np.int64)
    begins = np.flatnonzero(blank[ids])
    if len(begins) != len(texts):
        raise ValueError("the vocabulary does not cut before blanks")
    return ids, np.diff(np.append(begins, len(ids)))


def _opening(bpe: ByteBpe) -> np.ndarray:
    """Which ids begin with a blank."""
    if not hasattr(bpe, "opening"):
        bpe.opening = np.array([k != END and bpe.fast.decode_single_token_bytes(k)[:1] == b" " for k in range(VOCABULARY)])
    return bpe.opening


class Subwords:
    """Subword ids of blocks' distinct words; a task encodes a word again only after KNOWN_WORDS others."""

    def __init__(self, path: str):
        self.bpe = ByteBpe(path)
        self._keep(np.empty(0, U64), np.empty(0, np.uint16), np.empty(0, np.int64))

    def _keep(self, hashes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.ids, order = ids, np.argsort(hashes, kind="stable")
        self.hash, self.lengths, self.starts = hashes[order], lengths[order], (np.cumsum(lengths) - lengths)[order]

    def _found(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.hash, hashes), max(0, len(self.hash) - 1))
        return at, self.hash[at] == hashes if len(self.hash) else np.zeros(len(hashes), dtype=bool)

    def __call__(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(ids, joined, and their number per distinct word)."""
        if len(self.hash) > KNOWN_WORDS:
            self._keep(self.hash[:0], self.ids[:0], self.lengths[:0])
        new = np.flatnonzero(~self._found(words.hash)[1])
        ids, lengths = _ids(self.bpe, [words.distinct[k] for k in new])
        if len(new):
            order = np.argsort(self.starts)  # the order of the ids
            self._keep(
                np.append(self.hash[order], words.hash[new]), np.append(self.ids, ids.astype(np.uint16)), np.append(self.lengths[order], lengths)
            )
        at, _ = self._found(words.hash)
        lengths = self.lengths[at]
        return self.ids[_spread(self.starts[at], lengths)], lengths


def _interpolated(model: np.ndarray, unigram: np.ndarray, shares: tuple[float, ...]) -> Iterator[np.ndarray]:
    """For each of ``shares``, log10 of the mean of two probabilities, the unigram's weighing that share."""
    ln10 = np.log(10)
    top = np.maximum(model, unigram)
    a, b = np.exp((unigram - top) * ln10), np.exp((model - top) * ln10)
    for share in shares:
        yield np.log(share * a + (1 - share) * b) / ln10 + top


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for ``lengths[0]`` entries, and so on."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def _windows(of: np.ndarray, rows: pa.Table, turn: int, turns: int) -> Iterator[np.ndarray]:
    """Windows of CONTEXT + 1 classes (NONE beyond a text's end) of a block's training rows of a turn.

    The last CONTEXT are to be predicted; together the windows hold every token of the rows so once.
    ``of`` are the classes of the ids.
    """
    number, ids, lengths, *_ = expand(rows.schema.metadata[BLOCK])
    n_words = np.asarray(rows.column("n_words"))
    chosen = np.asarray(rows.column("train").combine_chunks()).astype(bool) & (np.arange(len(n_words)) % turns == turn)
    of, classes, starts = of.astype(np.uint8), of[ids].astype(np.uint8), np.cumsum(lengths) - lengths
    last = np.cumsum(n_words)
    for lo, hi in _parts(last):
        mine = np.flatnonzero(chosen[lo:hi])
        if not len(mine):
            continue
        before = last[lo] - n_words[lo]
        owner = np.repeat(np.arange(hi - lo), n_words[lo:hi])
        kept = chosen[lo:hi][owner]
        words, owner = number[before : last[hi - 1]][kept], np.searchsorted(mine, owner[kept])
        size = lengths[words]
        tokens = np.bincount(owner, size, minlength=len(mine)).astype(np.int64) + 1
        ends = np.cumsum(tokens + 1)  # the end stands before and behind each text
        text = np.full(int(ends[-1]) + CONTEXT, of[END], np.uint8)
        inside = np.ones(int(ends[-1]), dtype=bool)
        inside[ends - 1] = inside[ends - tokens - 1] = False
        text[: len(inside)][inside] = classes[_spread(starts[words], size)]
        count = -(-tokens // CONTEXT)
        first = _spread(np.zeros(len(mine), np.int64), count) * CONTEXT + np.repeat(ends - tokens - 1, count)
        at = first[:, None] + np.arange(CONTEXT + 1)
        out = text[at]
        out[at >= np.repeat(ends, count)[:, None]] = NONE
        yield out


def _parts(last: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows from, to: some 100,000 words at a time; ``last`` are the words up to each row's end."""
    lo = 0
    while lo < len(last):
        hi = max(lo + 1, int(np.searchsorted(last, (last[lo - 1] if lo else 0) + 100_000, side="right")))
        yield lo, hi
        lo = hi


def _add_up(_range: int, messages: list[tuple[int, bytes]]) -> list[tuple[int, bytes]]:
    """Merges the word counts of a range; answers the blocks and TOTALS."""
    texts, counts = [], []
    for _, data in messages:
        joined, n = expand(data)
        texts += [joined, np.array([10], np.uint8)]  # every word ends in a line's end
        counts.append(n)
    joined = np.concatenate(texts)
    starts = np.append(0, np.flatnonzero(joined == 10) + 1)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(joined)])
    number = words.dictionary_encode().indices.to_numpy()
    total = np.bincount(number, np.concatenate(counts)).astype(np.int64)
    stops = np.cumsum([len(n) for n in counts])
    out = [(block, squeeze(total[number[stop - len(n) : stop]])) for (block, _), n, stop in zip(messages, counts, stops, strict=True)]
    known = total[total > 0]
    return [*out, (TOTALS, squeeze(np.array([known.sum(), len(known)], np.int64)))]


def _fit(blocks: DataFrame, trainers: int, classes: Classes, rounds: int, rate: float) -> np.ndarray:
    """Rounds of local training and averaging, each on its part of every block's training rows; the flat weights."""
    flat = fresh(classes.prior)
    blocks = blocks.select("data").coalesce(trainers)
    for turn in range(rounds):
        start, step = flat, rate / (turn + 1)

        def local(batches: Iterator[pa.RecordBatch], start=start, step=step, turn=turn) -> Iterator[pa.RecordBatch]:
            one_blas_thread()
            got, pool, seen, held = start, [], 0, 0

            def learn() -> None:
                nonlocal got, pool, seen, held
                found = np.concatenate(pool)
                valid = found[:, 1:] != NONE
                found[found == NONE] = 0
                got = train(got, found[:, :-1], found[:, 1:], valid, step, least_steps=0 if seen else LEAST_STEPS)
                seen, pool, held = seen + held, [], 0

            for batch in batches:
                for data in batch.column(0):
                    for found in _windows(classes.of, unpack(data.as_py()), turn, rounds):
                        pool.append(found)
                        held += len(found)
                        if held >= POOL:
                            learn()
            if held:
                learn()
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(got)), pa.int32()), pa.array(got.astype(float) * seen), pa.array(np.full(len(got), float(seen)))],
                    ["place", "weighted", "weight"],
                )

        trained = blocks.mapInArrow(local, "place int, weighted double, weight double")
        mean = trained.groupBy("place").agg((F.sum("weighted") / F.sum("weight")).alias("w"))
        with arrow_batches(blocks.sparkSession, rows=1):  # blocks reach a task one by one
            found = mean.toArrow()  # one row per weight of the model
        flat = flat.copy()
        flat[found.column("place").to_numpy()] = found.column("w").to_numpy()
    return flat


def score_texts(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    trainable: Column | None = None,
    vocabulary: str | None = None,
    rounds: int = 2,
    rate: float = 0.03,
    unigram_shares: tuple[float, ...] = (0.5, 0.8, 0.95, 0.999),
) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every document.

    A word's probability in ``score`` is the attention model's (the product over its
    subword ids) interpolated with the corpus' word unigram, which knows whole words.
    A text's probability is the mean over the interpolation weights ``unigram_shares``.
    """
    require(docs, id_col, text_col)
    path = vocabulary or tokenizer_path("byte_bpe_50k")
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(trainable if trainable is not None else F.lit(True), F.lit(False)).alias("train")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, size // BYTES_PER_RANGE)
    tokenizer: list[Subwords] = []

    def count(_block: int, table: pa.Table) -> tuple[Messages, pa.Table]:
        if not tokenizer:
            tokenizer.append(Subwords(path))
        words = Words(table.column("text"))
        trained = np.asarray(table.column("train").combine_chunks()).astype(bool)
        counts = np.bincount(words.number, trained[words.rows], minlength=len(words.distinct)).astype(np.int64)
        ids, lengths = tokenizer[0](words)
        own = list(words.ranges(ranges))
        parts = {part: (words.distinct[s], counts[s]) for part, s in own}
        ends = parts.setdefault(0, ([], np.empty(0, np.int64)))  # the end token is the empty word, of range 0
        parts[0] = ([*ends[0], b""], np.append(ends[1], trained.sum()))
        out = [(part, squeeze(np.frombuffer(b"\n".join(w), np.uint8), c)) for part, (w, c) in parts.items()]
        weight = np.bincount(ids, np.repeat(counts, lengths), minlength=VOCABULARY).astype(np.int64)
        weight[END] += trained.sum()
        used = np.flatnonzero(weight)
        out.append((IDS, squeeze(used.astype(np.uint16), weight[used])))
        n_words = np.bincount(words.rows, minlength=table.num_rows)
        rows = pa.table({"id": table.column("id"), "train": table.column("train"), "n_words": pa.array(n_words, pa.int64())})
        held = squeeze(
            words.number, ids, lengths.astype(np.int32), np.array([p for p, _ in own], np.int64), np.array([s.stop for _, s in own], np.int64)
        )
        return out, rows.replace_schema_metadata({BLOCK: held})

    written = write_blocks(rows, "text", "lm", count)
    messages, blocks = written.where(F.col("kind") == MESSAGE), written.where(F.col("kind") == TEXT)
    answers = stored(exchange(messages.where(F.col("part") != IDS), _add_up), "words")

    totals = [expand(r[0])[0] for r in answers.where(F.col("block") == TOTALS).select("data").toLocalIterator()]
    n_train, n_distinct = (int(x) for x in np.sum(totals, axis=0)) if totals else (0, 0)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                ids, weight = expand(data.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array(weight)], ["id", "n"])

    found = messages.where(F.col("part") == IDS).select("data").mapInArrow(listed, "id int, n long")
    found = found.groupBy("id").agg(F.sum("n").alias("n")).toArrow()  # at most the tokenizer's vocabulary
    id_counts = np.zeros(VOCABULARY)
    id_counts[found.column("id").to_numpy()] = found.column("n").to_numpy()
    classes = make_classes(id_counts, END, ByteBpe(path).text_order())
    flat = _fit(blocks, max(1, -(-size // (BLOCKS_PER_TRAINER * BLOCK_BYTES))), classes, rounds, rate)
    kind = docs.schema[id_col].dataType.simpleString()

    def score(_block: int, table: pa.Table, replies: dict[int, bytes]) -> pa.Table:
        one_blas_thread()
        scorer = Scorer(flat, classes)
        n = table.num_rows
        numbers, ids, lengths, parts, stops = expand(table.schema.metadata[BLOCK])
        n_words = np.asarray(table.column("n_words"))
        rows = np.repeat(np.arange(n), n_words)
        counts = np.zeros(len(lengths), np.int64)
        end_count = expand(replies[0])[0][-1]
        for part, a, b in zip(parts.tolist(), [0, *stops.tolist()], stops.tolist(), strict=False):
            counts[a:b] = expand(replies[part])[0][: b - a]
        smooth = np.log10(n_train + 0.5 * (n_distinct + 1))
        of_word = np.log10(counts + 0.5) - smooth
        base = np.bincount(rows, of_word[numbers], minlength=n).astype(float)
        base += np.log10(end_count + 0.5) - smooth
        n_known = np.bincount(rows, counts[numbers] > 0, minlength=n).astype(np.int64) + int(end_count > 0)
        starts = np.cumsum(lengths) - lengths
        result = np.zeros(n)
        last = np.cumsum(n_words)
        for lo, hi in _parts(last):
            number = numbers[(last[lo - 1] if lo else 0) : last[hi - 1]]
            owner = rows[(last[lo - 1] if lo else 0) : last[hi - 1]] - lo
            size = lengths[number]
            tokens = np.bincount(owner, size, minlength=hi - lo).astype(np.int64) + 1
            ends = np.cumsum(tokens)
            flat_ids = np.full(int(ends[-1]), END, np.int64)
            place = np.ones(len(flat_ids), dtype=bool)
            place[ends - 1] = False
            flat_ids[place] = ids[_spread(starts[number], size)]
            by_id = scorer.log10(flat_ids, tokens, END)
            by_word = np.add.reduceat(by_id[place], np.cumsum(size) - size) if len(size) else np.zeros(0)
            inner = _interpolated(by_word, of_word[number], unigram_shares)
            last_token = _interpolated(by_id[~place], np.full(hi - lo, np.log10(end_count + 0.5) - smooth), unigram_shares)
            by_share = [np.bincount(owner, i, minlength=hi - lo) + e for i, e in zip(inner, last_token, strict=True)]
            result[lo:hi] = np.logaddexp.reduce(np.array(by_share) * np.log(10)) / np.log(10) - np.log10(len(by_share))
        return pa.table(
            {
                "id": table.column("id"),
                "n_tokens": pa.array(n_words + 1, pa.int64()),
                "n_known": pa.array(n_known, pa.int64()),
                "train_tokens": pa.array(np.full(n, n_train), pa.int64()),
                "base_score": pa.array(base, pa.float64()),
                "score": pa.array(result, pa.float64()),
            }
        )

    schema = f"id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    replies = answers.where(F.col("block") >= 0)
    return with_answers(blocks, replies, score, schema).withColumnRenamed("id", id_col)


def op2_scores(docs: DataFrame) -> DataFrame:
    """The registered query: crc32(doc_id) mod 5 = 1 is held out."""
    scored = score_texts(docs, trainable=remainder("doc_id", 5) != 1)
    return scored.select(
        "doc_id", (remainder("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
