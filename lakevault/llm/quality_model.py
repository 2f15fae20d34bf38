"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts (byte classes, word and line repetition, lengths) are
counted with numpy, slice by slice of the Arrow batches. Trees are grown level by
level on binned statistics and flattened into arrays; a batch is scored by
stepping all rows through all trees at once, one gather per level.

The trees are fitted on the driver from at most ``max_training_rows`` labelled
rows, chosen by a hash of their id (a classifier's bounded sample); the feature
matrix there has that many rows of ``len(FEATURES)`` doubles, whatever the
corpus. Everything else runs over all documents in one narrow pass; only the
labelled rows' statistics are joined.

Defined cases: a null or empty text has all statistics zero and is scored like
any other; labels other than 0 and 1, and those of a null id, are ignored;
several labels of one id count as their mean; without training rows every score
is 0.5; repeated rows are scored each; extra input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import LOWER, mix, require, slices, stored, text_batches, window_hashes, word_hashes, word_spans

SYMBOLS = "#*$%&|<>"
FEATURES = (
    "log_words", "log_bytes", "upper", "lower", "digit", "blank", "newline", "non_ascii", "symbol", "exclamation",
    "full_stop", "comma", "pipe", "mean_word", "distinct_words", "top_word", "same_as_previous", "repeated_windows",
    "repeated_long_windows", "words_per_line", "capital_words", "punctuation",
)
#: labelled rows that the trees are fitted on, at most
MAX_TRAINING_ROWS = 20_000


def _per_row(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(rows, weights, minlength=n).astype(float)


def _repeats(rows: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: number of distinct hashes, of entries whose hash repeats, and the highest count."""
    if len(rows) == 0:
        return np.zeros(n), np.zeros(n), np.zeros(n)
    order = np.lexsort((hashes, rows))
    r, h = rows[order], hashes[order]
    first = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (h[1:] != h[:-1])]))
    count = np.diff(np.append(first, len(r)))
    owner = r[first]
    top = np.zeros(n)
    np.maximum.at(top, owner, count)
    return _per_row(owner, n), _per_row(owner, n, count * (count > 1)), top


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x FEATURES of the texts in one slice."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    row_of_byte = np.repeat(np.arange(n), np.diff(offsets))
    bytes_ = np.bincount(row_of_byte * 256 + data, minlength=n * 256).reshape(n, 256).astype(float)
    starts, ends, rows = word_spans(data, offsets)
    words = word_hashes(LOWER[data], starts, ends)
    n_words = _per_row(rows, n)
    per_byte, per_word = 1 / np.maximum(size, 1), 1 / np.maximum(n_words, 1)
    distinct, _, top = _repeats(rows, words, n)
    same = np.zeros(n) if len(rows) < 2 else _per_row(rows[1:][(words[1:] == words[:-1]) & (rows[1:] == rows[:-1])], n)
    at3, h3 = window_hashes(words, rows, 3)
    at8, h8 = window_hashes(words, rows, 8)
    capital = np.zeros(n) if len(starts) == 0 else _per_row(rows[(data[starts] >= 65) & (data[starts] <= 90)], n)
    codes = lambda chars: bytes_[:, [ord(c) for c in chars]].sum(1)
    columns = {
        "log_words": np.log1p(n_words),
        "log_bytes": np.log1p(size),
        "upper": bytes_[:, 65:91].sum(1) * per_byte,
        "lower": bytes_[:, 97:123].sum(1) * per_byte,
        "digit": bytes_[:, 48:58].sum(1) * per_byte,
        "blank": bytes_[:, 32] * per_byte,
        "newline": bytes_[:, 10] * per_byte,
        "non_ascii": bytes_[:, 128:].sum(1) * per_byte,
        "symbol": codes(SYMBOLS) * per_word,
        "exclamation": codes("!") * per_word,
        "full_stop": codes(".") * per_word,
        "comma": codes(",") * per_word,
        "pipe": codes("|") * per_word,
        "mean_word": _per_row(rows, n, (ends - starts).astype(float)) * per_word,
        "distinct_words": distinct * per_word,
        "top_word": top * per_word,
        "same_as_previous": same * per_word,
        "repeated_windows": _repeats(rows[at3], h3, n)[1] * per_word,
        "repeated_long_windows": _repeats(rows[at8], h8, n)[1] * per_word,
        "words_per_line": n_words / (bytes_[:, 10] + 1),
        "capital_words": capital * per_word,
        "punctuation": (bytes_[:, 33:48].sum(1) + bytes_[:, 58:65].sum(1)) * per_byte,
    }
    return np.column_stack([columns[f] for f in FEATURES])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, features): one row per document."""
    require(docs, id_col, text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(1), max_rows=2048):
                flat = pa.array(statistics(data, offsets).ravel())
                listed = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, len(FEATURES), dtype=np.int32), flat)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), listed], ["id", "features"])

    rows = text_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col))
    return rows.mapInArrow(count, "id long, features array<double>")


@dataclass
class Forest:
    """Complete binary trees of one depth as arrays: tree x inner node, tree x leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if len(self.feature) == 0:
            return total
        trees = np.arange(len(self.feature))[None, :]
        row = np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        for _ in range(int(np.log2(self.leaf.shape[1]))):
            right = x[row, self.feature[trees, node]] > self.threshold[trees, node]
            node = 2 * node + 1 + right
        return total + self.leaf[trees, node - self.feature.shape[1]].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def fit_forest(
    x: np.ndarray, y: np.ndarray, *, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, ridge: float = 1.0
) -> Forest:
    """Boosting of the logistic loss on quantile bins; ``y`` in 0..1."""
    inner = 2**depth - 1
    if len(x) == 0:
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), 0.0)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)])
    flat = binned + np.arange(x.shape[1]) * bins
    raw = np.full(len(x), np.log(mean / (1 - mean)))
    base = float(raw[0])
    feature, threshold = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            width = x.shape[1] * bins
            first = 2**level - 1
            key = ((node - first)[:, None] * width + flat).ravel()
            shape = (2**level, x.shape[1], bins)
            gs = np.bincount(key, np.repeat(g, x.shape[1]), minlength=2**level * width).reshape(shape).cumsum(2)
            hs = np.bincount(key, np.repeat(h, x.shape[1]), minlength=2**level * width).reshape(shape).cumsum(2)
            G, H = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs**2 / (hs + ridge) + (G - gs) ** 2 / (H - hs + ridge) - G**2 / (H + ridge)
            gain[(hs < 1) | (H - hs < 1)] = 0
            best = gain.reshape(2**level, -1).argmax(1)
            for k, b in enumerate(best):
                f, c = divmod(int(b), bins)
                if gain[k, f, c] > 1e-9 and c < len(cuts[f]):
                    feature[t, first + k], threshold[t, first + k] = f, cuts[f][c]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[t, node]] > threshold[t, node])
        node -= inner
        value = -np.bincount(node, g, minlength=inner + 1) / (np.bincount(node, h, minlength=inner + 1) + ridge)
        leaf[t] = rate * value
        raw += leaf[t][node]
    return Forest(feature, threshold, leaf, base)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    trainable: Column | None = None,
    max_training_rows: int = MAX_TRAINING_ROWS,
) -> DataFrame:
    """(id, score): the probability of label 1 for every document.

    ``trainable``, over the labels' columns, tells which labelled rows may be learned from.
    """
    require(labels, id_col, label_col)
    features = stored(document_statistics(docs, id_col, text_col), "quality")
    usable = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    if trainable is not None:
        usable = usable.where(trainable)
    usable = usable.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.avg(label_col).alias("y"))
    share = max_training_rows / max(1, usable.count())
    if share < 1:  # rows with a hash below the share, and no more than the bound of them
        usable = usable.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(int(0.98 * share * (1 << 30))))
    fitted = features.join(usable, "id").select("id", "features", "y").limit(max_training_rows).toArrow()
    ids = fitted.column("id").to_numpy()
    x = np.array(fitted.column("features").combine_chunks().flatten()).reshape(len(ids), len(FEATURES))
    order = np.argsort(ids, kind="stable")  # the same trees whatever the order of arrival
    forest = fit_forest(x[order], fitted.column("y").to_numpy()[order])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1)
            values = np.asarray(rows.flatten()).reshape(len(rows), len(FEATURES))
            parts = [forest.score(values[k : k + 4096]) for k in range(0, len(values), 4096)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts or [np.empty(0)]))], ["id", "score"])

    return features.mapInArrow(score, "id long, score double").withColumnRenamed("id", id_col)


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor


def op1_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered query: crc32(doc_id) mod 3 = 1 is held out."""
    scored = score_quality(docs, labels, trainable=remainder("doc_id", 3) != 1)
    return scored.select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
