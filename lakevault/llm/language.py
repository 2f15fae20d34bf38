"""Language identification by hierarchical discrimination.

Texts become hashed counts of byte 1- to 3-grams (letters lower-cased, other
ASCII turned to blanks), square-rooted and scaled to length one. Languages are
grouped into families by the likeness of their mean vectors (average linkage
down to about the square root of their number), so no fixed table of families
is needed. A first linear machine, one against the rest, names the family; in
it one-versus-one linear support vector machines (squared hinge) vote for the
language, ties going to the larger sum of margins.

Machines are fitted on the driver from at most ``max_training_rows`` labelled
texts in total, an equal share for every language, chosen by a hash of the id (a
classifier's bounded sample). All documents are scored in one narrow pass.

Defined cases: a null text, or one without any letter, is ``und`` with score 0;
rows with a null language are not learned from; with no training rows every text
is ``und``, with one language every text with a letter is that one; repeated
rows are scored each; extra input columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import require, slices, text_batches
from lakevault.llm.quality_model import remainder

UNDETERMINED = "und"
DIMS = 2048
#: labelled texts that the machines are fitted on, at most
MAX_TRAINING_ROWS = 6000

# letters of a word in lower case and all bytes of multi-byte characters; the rest are blanks
FOLD = np.full(256, 0x20, np.uint8)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)
_MAYBE_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _MAYBE_LETTER.finditer(text))


def vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x DIMS, each of length one (or zero)."""
    n = len(offsets) - 1
    out = np.zeros(n * DIMS)
    row = np.repeat(np.arange(n), np.diff(offsets)) * DIMS
    code = np.zeros(len(data), np.uint32)
    folded = FOLD[data].astype(np.uint32)
    for size in (1, 2, 3):
        if len(data) < size:
            break
        m = len(data) - size + 1
        code = code[:m] * np.uint32(257) + folded[size - 1 :]
        same = row[:m] == row[size - 1 :]
        hashed = ((code + np.uint32(size)) * np.uint32(2654435761)) >> np.uint32(32 - 11)
        out += np.bincount(row[:m][same] + hashed[same], minlength=n * DIMS)
    out = np.sqrt(out.reshape(n, DIMS))
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def linear_machine(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 150) -> tuple[np.ndarray, float]:
    """Weights and bias of a squared-hinge machine for y in {-1, 1}; classes weigh alike."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    look, momentum = w.copy(), 1.0
    step = 1 / (4 + ridge)  # rows have length sqrt(2): the loss' curvature is at most 4
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (a @ look))
        grad = -2 * (a.T @ (weight * y * slack)) + ridge * look
        new = look - step * grad
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        look, w, momentum = new + (momentum - 1) / following * (new - w), new, following
    return w[:-1], float(w[-1])


def families(means: np.ndarray, count: int) -> list[list[int]]:
    """Average-linkage groups of the rows of ``means``, ``count`` of them."""
    centred = means - means.mean(0)
    centred /= np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-12)
    like = centred @ centred.T
    groups = [[i] for i in range(len(means))]
    while len(groups) > count:
        pairs = [(like[np.ix_(a, b)].mean(), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j]
        _, i, j = max(pairs)
        groups[i] += groups.pop(j)
    return [sorted(g) for g in groups]


@dataclass
class Languages:
    names: list[str]
    groups: list[list[int]] = field(default_factory=list)
    family: tuple[np.ndarray, np.ndarray] | None = None
    pairs: dict[tuple[int, int], tuple[np.ndarray, float]] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language and a score in 0..1, per row."""
        n = len(x)
        if len(self.groups) > 1:
            margin = x @ self.family[0] + self.family[1]
            group = margin.argmax(1)
            ranked = np.sort(margin, axis=1)
            score = 1 / (1 + np.exp(-2 * (ranked[:, -1] - ranked[:, -2])))
        else:
            group, score = np.zeros(n, np.int64), np.ones(n)
        best = np.zeros(n, np.int64)
        for g, members in enumerate(self.groups):
            mine = np.flatnonzero(group == g)
            votes = np.zeros((len(mine), len(members)))
            margins = np.zeros((len(mine), len(members)))
            sure = np.ones((len(mine), len(members)))
            for i, a in enumerate(members):
                for j, b in enumerate(members):
                    if i < j:
                        w, bias = self.pairs[a, b]
                        m = x[mine] @ w + bias
                        votes[:, i] += m > 0
                        votes[:, j] += m <= 0
                        margins[:, i] += m
                        margins[:, j] -= m
                        p = 1 / (1 + np.exp(-2 * m))
                        sure[:, i] = np.minimum(sure[:, i], p)
                        sure[:, j] = np.minimum(sure[:, j], 1 - p)
            chosen = (votes + 1e-3 * np.tanh(margins)).argmax(1)
            best[mine] = np.asarray(members)[chosen]
            score[mine] *= sure[np.arange(len(mine)), chosen]
        return best, score


def fit_languages(x: np.ndarray, lang: list[str]) -> Languages:
    names = sorted(set(lang))
    y = np.array([names.index(v) for v in lang], dtype=np.int64)
    model = Languages(names)
    if not names:
        return model
    means = np.stack([x[y == k].mean(0) for k in range(len(names))])
    model.groups = families(means, max(1, round(len(names) ** 0.5)))
    if len(model.groups) > 1:
        machines = [linear_machine(x, np.where(np.isin(y, g), 1.0, -1.0)) for g in model.groups]
        model.family = np.column_stack([w for w, _ in machines]), np.array([b for _, b in machines])
    for members in model.groups:
        for i, a in enumerate(members):
            for b in members[i + 1 :]:
                mine = (y == a) | (y == b)
                model.pairs[a, b] = linear_machine(x[mine], np.where(y[mine] == a, 1.0, -1.0))
    return model


def predict_language(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    trainable: Column | None = None,
    max_training_rows: int = MAX_TRAINING_ROWS,
) -> DataFrame:
    """(id, lang_pred, score) for every document; learns from rows that ``trainable`` allows."""
    require(docs, id_col, text_col, lang_col)
    text_batches(docs)
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    if trainable is not None:
        usable = usable.where(trainable)
    counts = {r[0]: r[1] for r in usable.groupBy(F.col(lang_col).cast("string")).count().collect()}  # one row per language
    share = max_training_rows // max(1, len(counts))
    chosen = F.lit(False)
    for name, n in counts.items():
        below = F.pmod(F.xxhash64(F.lit("language"), id_col), F.lit(1 << 30)) < F.lit(min(1 << 30, int(0.95 * share / n * (1 << 30))))
        chosen = chosen | ((F.col(lang_col).cast("string") == name) & (below if n > share else F.lit(True)))

    def vectorise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(2), max_rows=512):
                rows = [v.astype(np.float32).tobytes() for v in vectors(data, offsets)]
                columns = [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "lang", "x"])

    sample = usable.where(chosen).select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"), text_col)
    fitted = sample.mapInArrow(vectorise, "id string, lang string, x binary").limit(max_training_rows).collect()
    fitted.sort(key=lambda r: (r[0] or "", r[1], r[2]))  # the same machines whatever the order of arrival
    x = np.frombuffer(b"".join(r[2] for r in fitted), np.float32).reshape(-1, DIMS).astype(float)
    model = fit_languages(x, [r[1] for r in fitted])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            for lo, hi, data, offsets in slices(column, max_rows=512):
                texts = data.tobytes()
                best, score = np.zeros(hi - lo, np.int64), np.zeros(hi - lo)
                if model.names:
                    best, score = model.predict(vectors(data, offsets))
                known = [bool(model.names) and has_letter(texts[offsets[i] : offsets[i + 1]].decode()) for i in range(hi - lo)]
                names = [model.names[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
                columns = [batch.column(0).slice(lo, hi - lo), pa.array(names), pa.array(np.where(known, score, 0.0))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_col)
    return rows.mapInArrow(predict, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def op7_language(docs: DataFrame) -> DataFrame:
    """The registered query: crc32(doc_id) mod 4 = 2 is held out."""
    found = predict_language(docs, trainable=remainder("doc_id", 4) != 2)
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
