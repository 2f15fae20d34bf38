"""A small causal self-attention model in numpy: one head, next-class prediction.

Token ids fall into ``classes`` (frequent ids alone, the others in groups of about
equal mass); the model predicts the next class from the context, and a class its
ids in proportion to their corpus counts. So the probabilities of all ids of the
vocabulary sum to one, and no softmax is wider than the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

WIDTH = 16  # of embeddings and head
CONTEXT = 32  # tokens in a window
STRIDE = 24  # tokens by which windows advance; the last STRIDE of a window are scored in it
CLASSES = 128
LEAST_STEPS = 150  # of training on few windows
CHUNK = 512  # places whose softmax is held at a time
SLAB = 8  # batches of windows whose places meet the softmax together
SHAPES = {
    "embed": (CLASSES, WIDTH), "place": (CONTEXT, WIDTH), "query": (WIDTH, WIDTH), "key": (WIDTH, WIDTH),
    "value": (WIDTH, WIDTH), "mix": (WIDTH, WIDTH), "out": (WIDTH, CLASSES), "pair": (CLASSES, CLASSES), "bias": (CLASSES,),
}
LOG2E, LN2 = float(np.log2(np.e)), float(np.log(2))  # powers of 2 take half the time of powers of e
CAUSAL = np.tril(np.ones((CONTEXT, CONTEXT), np.float32))


@dataclass
class Classes:
    """Class of every id, and log10 of its share in the class."""

    of: np.ndarray
    log_share: np.ndarray
    prior: np.ndarray


def make_classes(counts: np.ndarray, end: int, place: np.ndarray) -> Classes:
    """``counts`` of all ids of the vocabulary; ``end`` gets class 0 to itself.

    ``place`` orders the ids by their text: neighbours in it share a class.
    """
    mass = counts + 0.5
    order = np.argsort(-mass, kind="stable")
    order = order[order != end]
    alone = CLASSES * 6 // 10 - 1
    of = np.zeros(len(counts), np.int64)
    of[order[:alone]] = 1 + np.arange(alone)
    rest, groups = order[alone:], CLASSES - 1 - alone
    rest = rest[np.argsort(place[rest], kind="stable")]
    reached = np.cumsum(mass[rest])
    of[rest] = 1 + alone + np.minimum(groups - 1, (reached - mass[rest] / 2) / reached[-1] * groups).astype(np.int64)
    total = np.bincount(of, mass, minlength=CLASSES)
    share = np.log10(mass) - np.log10(total[of])
    return Classes(of, share, np.log(np.maximum(total, 0.5) / total.sum()))


def fresh(prior: np.ndarray) -> np.ndarray:
    """The flat weights to start from (the same everywhere)."""
    dice = np.random.default_rng(7)
    parts = {k: dice.normal(0, 0.25, v) for k, v in SHAPES.items()}
    parts["pair"] *= 0
    parts["bias"] = prior
    return np.concatenate([p.ravel() for p in parts.values()]).astype(np.float32)


def unflatten(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[k] = flat[at : at + n].reshape(shape)
        at += n
    return out


class Space:
    """Arrays that are filled again and again, by name: getting fresh ones of the system costs as much as a product."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, kind: np.dtype, *shape: int) -> np.ndarray:
        """An array of any content, the same memory at every call."""
        n = int(np.prod(shape))
        if name not in self.held or len(self.held[name]) < n or self.held[name].dtype != kind:
            self.held[name] = np.empty(n, kind)
        return self.held[name][:n].reshape(shape)


def _by_class(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the classes ``c``, and where each class begins in it (and the last one ends)."""
    return np.argsort(c, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(c, minlength=CLASSES))])


def _chunks(bounds: np.ndarray) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
    """(begin, end, [(class, begin, end)]) of rows in the order of their classes, some CHUNK rows at a time."""
    held: list[tuple[int, int, int]] = []
    for k, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        for at in range(lo, hi, CHUNK):
            if held and min(hi, at + CHUNK) - held[0][1] > CHUNK:
                yield held[0][1], held[-1][2], held
                held = []
            held.append((k, at, min(hi, at + CHUNK)))
    if held:
        yield held[0][1], held[-1][2], held


def _steep(longest: float, out: np.ndarray) -> bool:
    """Whether what a state of this length adds to a logit may be too large for a power as it is."""
    return not longest * np.sqrt((out * out).sum(0).max()) < 100


def _direct(w: dict[str, np.ndarray], out: np.ndarray) -> np.ndarray:
    """The part of the logits that depends on the class alone, for powers of 2; the largest of each class is 0, which changes no softmax."""
    direct = (w["pair"] + w["bias"]) * w["bias"].dtype.type(LOG2E) + w["embed"] @ out
    return direct - direct.max(1, keepdims=True)


def _mild(*lengths: float) -> bool:
    """Whether no product of vectors of these lengths comes near the limit of attention."""
    return np.prod(lengths) < 30 * LOG2E


def _attend(q: np.ndarray, k: np.ndarray, s: np.ndarray, mild: bool) -> None:
    """Fill ``s`` with the powers of how well the places ``q`` meet those of ``k`` up to their own."""
    np.matmul(q, k.transpose(0, 2, 1), out=s)
    if not mild:
        np.clip(s, -30 * LOG2E, 30 * LOG2E, out=s)
    np.exp2(s, out=s)
    s *= CAUSAL[k.shape[1] - q.shape[1] : k.shape[1], : k.shape[1]]


def _wider(a: np.ndarray, corner: float = 0) -> np.ndarray:
    """``a`` with one more row and column, of zeros but for the corner."""
    out = np.zeros((a.shape[0] + 1, a.shape[1] + 1), a.dtype)
    out[:-1, :-1], out[-1, -1] = a, corner
    return out


def _longest(a: np.ndarray) -> float:
    return float(np.sqrt(np.einsum("ij,ij->i", a, a).max()))


class Tables:
    """What a token brings to its window depends on its class and place only: query, key, value and 1 side by side."""

    def __init__(self, w: dict[str, np.ndarray], length: int = CONTEXT):
        kind = w["embed"].dtype
        self.project = np.concatenate([w["query"] * kind.type(LOG2E / np.sqrt(WIDTH)), w["key"], w["value"]], axis=1)
        self.of_class, self.of_place = (_wider(w[k] @ self.project)[:-1] for k in ("embed", "place"))
        self.of_class[:, -1], self.of_place = 1, self.of_place[:length]
        self.mix, self.place, self.out = _wider(w["mix"], 1), _wider(w["place"])[:length], w["out"] * kind.type(LOG2E)
        self.direct = _direct(w, self.out)
        q, k, v = (slice(j, j + WIDTH) for j in range(0, 3 * WIDTH, WIDTH))
        both = (self.of_class, self.of_place)
        self.mild = _mild(*(sum(_longest(t[:, j]) for t in both) for j in (q, k)))
        # attention takes a mean of values
        reach = sum(_longest(t[:, v] @ w["mix"]) for t in both) + _longest(w["place"])
        self.steep = _steep(reach, self.out)  # some state may be too long, if all meet the worst

    def fill(self, c: np.ndarray, whole: np.ndarray) -> None:
        np.take(self.of_class, c.ravel(), axis=0, out=whole.reshape(c.size, -1), mode="clip")
        whole += self.of_place


def _gradient(w: dict[str, np.ndarray], c: np.ndarray, y: np.ndarray, valid: np.ndarray, space: Space | None = None) -> np.ndarray:
    """Flat gradient of the mean loss of a batch of windows.

    The softmax of all places is worked off class by class: places of one class share a row of ``pair``.
    """
    n, length = c.shape
    size, kind = c.size, w["embed"].dtype
    space, tables = space or Space(), Tables(w, length)
    get = lambda name, *shape: space(name, kind, *shape)
    # values end in 1, so what they add up to ends in the sum of the weights and, divided by that, in 1
    whole, s, o = get("whole", n, length, 3 * WIDTH + 1), get("s", n, length, length), get("o", n, length, WIDTH + 1)
    tables.fill(c, whole)
    q, k, v = whole[:, :, :WIDTH], whole[:, :, WIDTH : 2 * WIDTH], whole[:, :, 2 * WIDTH :]
    _attend(q, k, s, tables.mild)
    np.matmul(s, v, out=o)
    part = o[:, :, -1:].copy()
    o /= part
    flat_o = o.reshape(size, -1)
    states, h = get("states", n, length, WIDTH + 1), get("h", size, WIDTH + 1)
    np.dot(flat_o, tables.mix, out=states.reshape(size, -1))
    states += tables.place
    order, bounds = _by_class(c.ravel())
    np.take(states.reshape(size, -1), order, axis=0, out=h, mode="clip")
    target, share = y.ravel()[order], (valid.ravel()[order] / max(1, valid.sum())).astype(kind)
    out, direct, ones = tables.out, tables.direct, np.ones(CLASSES, kind)
    steep = tables.steep and _steep(_longest(h[:, :-1]), out)
    head, back = np.concatenate([out, direct[:1]]), np.ascontiguousarray(w["out"].T)
    held, total, d_sorted = get("z", CHUNK, CLASSES), get("total", size), get("d_sorted", size, WIDTH)
    d_head, aim = get("d_head", CLASSES, WIDTH + 1, CLASSES), np.arange(CHUNK) * CLASSES
    d_head[np.diff(bounds) == 0] = 0
    begins = bounds.tolist()
    for lo, hi, parts in _chunks(bounds):
        z = held[: hi - lo]
        for j, a, b in parts:
            head[-1] = direct[j]
            np.dot(h[a:b], head, out=z[a - lo : b - lo])
        if steep:
            z -= z.max(-1, keepdims=True)
        np.exp2(z, out=z)
        mine = np.dot(z, ones, out=total[lo:hi])
        held.reshape(-1)[aim[: hi - lo] + target[lo:hi]] -= mine  # now the gradient of the logits, but for a factor of each row
        np.dot(z, back, out=d_sorted[lo:hi])
        np.divide(share[lo:hi], mine, out=mine)
        h[lo:hi] *= mine[:, None]
        for j, a, b in parts:
            if a == begins[j]:
                np.dot(h[a:b].T, z[a - lo : b - lo], out=d_head[j])
            else:
                d_head[j] += h[a:b].T @ z[a - lo : b - lo]
    d_sorted *= total[:, None]
    d_pair = d_head[:, -1]
    dh, do, ds, d = get("dh", size, WIDTH), get("do", n, length, WIDTH + 1), get("ds", n, length, length), get("d", n, length, 3 * WIDTH)
    back_order = np.empty_like(order)
    back_order[order] = np.arange(size)
    np.take(d_sorted, back_order, axis=0, out=dh, mode="clip")
    d_mix = (flat_o.T @ dh)[:-1]
    np.dot(dh, _wider(w["mix"].T)[:-1], out=do.reshape(size, -1))
    do *= np.divide(kind.type(LN2), part, out=part)
    do[:, :, -1] = -np.einsum("ijk,ijk->ij", do[:, :, :-1], o[:, :, :-1])
    np.matmul(do, v.transpose(0, 2, 1), out=ds)
    ds *= s
    np.matmul(ds, k, out=d[:, :, :WIDTH])
    np.matmul(ds.transpose(0, 2, 1), q, out=d[:, :, WIDTH : 2 * WIDTH])
    np.matmul(s.transpose(0, 2, 1), do[:, :, :-1], out=d[:, :, 2 * WIDTH :])
    # by class and by place; the gradients of what stands before the tables follow from these sums
    d_sum, one = np.empty((CLASSES, 3 * WIDTH), kind), np.ones(size, kind)
    d_order = np.take(d.reshape(size, -1), order, axis=0, out=get("d_order", size, 3 * WIDTH), mode="clip")
    for j, (lo, hi) in enumerate(zip(begins, begins[1:], strict=False)):
        np.dot(one[lo:hi], d_order[lo:hi], out=d_sum[j])
    d_by_place, h_by_place = d.sum(0), dh.reshape(n, length, -1).sum(0)
    d_project = w["embed"].T @ d_sum + w["place"][:length].T @ d_by_place
    project = tables.project
    project[:, 2 * WIDTH :] *= kind.type(LOG2E)  # as the last part of d is by a factor of LN2 too small
    d_query, d_key, d_value = np.split(d_project * kind.type(LOG2E), 3, axis=1)
    d_place = np.zeros_like(w["place"])
    d_place[:length] = d_by_place @ project.T + h_by_place
    d_embed = d_sum @ project.T + d_pair @ back
    d_out = d_head[:, :-1].sum(0) + w["embed"].T @ d_pair
    parts = {
        "embed": d_embed, "place": d_place, "query": d_query / kind.type(np.sqrt(WIDTH)), "key": d_key * kind.type(LN2), "value": d_value,
        "mix": d_mix, "out": d_out, "pair": d_pair, "bias": d_pair.sum(0),
    }
    return np.concatenate([parts[k].ravel() for k in SHAPES])


def train(flat: np.ndarray, c: np.ndarray, y: np.ndarray, valid: np.ndarray, rate: float, least_steps: int = LEAST_STEPS, batch: int = 256) -> np.ndarray:
    """Adam over the windows, from ``flat``; few windows are gone over again."""
    flat = flat.astype(np.float32).copy()
    if len(c) == 0:
        return flat
    m, v, by = np.zeros_like(flat), np.zeros_like(flat), np.empty_like(flat)
    per = -(-len(c) // batch)
    steps = max(per, min(least_steps, 50 * per))
    dice = np.random.default_rng(11)
    order, space = np.empty(0, np.int64), Space()
    for t in range(1, steps + 1):
        if len(order) < min(batch, len(c)):
            order = np.concatenate([order, dice.permutation(len(c))])
        k, order = order[:batch], order[batch:]
        g = _gradient(unflatten(flat), c[k], y[k], valid[k], space)
        m *= 0.9
        m += np.multiply(g, 0.1, out=by)
        v *= 0.99
        v += np.multiply(np.multiply(g, 0.01, out=by), g, out=by)
        np.sqrt(np.divide(v, 1 - 0.99**t, out=by), out=by)
        by += 1e-8
        step = np.divide(m, 1 - 0.9**t, out=g)
        step *= rate * (1 - 0.9 * t / steps)
        step /= by
        flat -= step
    return flat


class Scorer:
    """log10 probabilities of whole token sequences, by overlapping windows."""

    def __init__(self, flat: np.ndarray, classes: Classes, batch: int = 128):
        self.classes, self.batch = classes, batch
        self.of = classes.of.astype(np.uint8)
        self.tables = Tables(unflatten(flat.astype(np.float32)))
        both, k = (self.tables.of_class, self.tables.of_place), slice(WIDTH, 2 * WIDTH)
        self.mild = _mild(sum(float(np.abs(a[:, :WIDTH] @ b[:, k].T).max()) for a in both for b in both))
        self.weight = np.exp2(self.tables.direct)
        self.ones, self.space = np.ones(CLASSES, np.float32), Space()

    def log10(self, ids: np.ndarray, lengths: np.ndarray, start: int) -> np.ndarray:
        """Per id, its log10 probability in its sequence; ``start`` stands before each sequence."""
        target = self.of[ids]
        ends = np.cumsum(lengths)
        begins = ends - lengths
        source = np.empty(len(ids), np.uint8)
        source[1:] = target[:-1]
        source[begins[lengths > 0]] = self.of[start]
        out = np.zeros(len(ids))
        count = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - CONTEXT) // STRIDE)), 0)
        owner = np.repeat(np.arange(len(lengths)), count)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        first, last = begins[owner] + number * STRIDE, ends[owner]
        # the first window of a sequence is scored whole, the others in their last STRIDE places
        for from_place, chosen in ((0, np.flatnonzero(number == 0)), (CONTEXT - STRIDE, np.flatnonzero(number))):
            for top in range(0, len(chosen), self.batch * SLAB):
                slab = chosen[top : top + self.batch * SLAB]
                at = first[slab, None] + np.arange(CONTEXT)
                scored = np.flatnonzero((at < last[slab, None])[:, from_place:])
                np.minimum(at, len(ids) - 1, out=at)
                states = self._states(source[at], from_place)
                mine = at[:, from_place:].ravel()[scored]
                out[mine] = self._classes(source[mine], states, scored, target[mine])
        return out * np.log10(2) + self.classes.log_share[ids]

    def _states(self, c: np.ndarray, from_place: int) -> np.ndarray:
        """What the head sees at the places from ``from_place`` on of the windows ``c``, but for the embeddings."""
        get = lambda name, *shape: self.space(name, np.dtype(np.float32), *shape)
        length = CONTEXT - from_place
        states, mix, place = get("states", len(c), length, WIDTH), np.ascontiguousarray(self.tables.mix[:, :-1]), self.tables.place[from_place:, :-1]
        for lo in range(0, len(c), self.batch):
            n = min(self.batch, len(c) - lo)
            whole, s, o = get("whole", n, CONTEXT, 3 * WIDTH + 1), get("s", n, length, CONTEXT), get("o", n, length, WIDTH + 1)
            self.tables.fill(c[lo : lo + n], whole)
            _attend(whole[:, from_place:, :WIDTH], whole[:, :, WIDTH : 2 * WIDTH], s, self.mild)
            np.matmul(s, whole[:, :, 2 * WIDTH :], out=o)
            o /= o[:, :, -1:].copy()
            mine = states[lo : lo + n]
            np.dot(o.reshape(n * length, -1), mix, out=mine.reshape(n * length, -1))
            mine += place
        return states.reshape(-1, WIDTH)

    def _classes(self, c: np.ndarray, states: np.ndarray, rows: np.ndarray, y: np.ndarray) -> np.ndarray:
        """log2 probabilities of the classes ``y`` after ``c``, whose ``rows`` of states are given; worked off class by class of ``c``."""
        order, bounds = _by_class(c)
        h = self.space("h", states.dtype, len(rows), WIDTH)
        np.take(states, rows[order], axis=0, out=h, mode="clip")
        out, y = self.tables.out, y[order]
        steep = self.tables.steep and _steep(_longest(h), out)
        held, found, total = self.space("z", states.dtype, CHUNK, CLASSES), np.empty(len(c), np.float32), np.empty(len(c), np.float32)
        aim = np.arange(CHUNK) * CLASSES
        for lo, hi, parts in _chunks(bounds):
            z = held[: hi - lo]
            np.dot(h[lo:hi], out, out=z)
            if steep:  # the part of the class alone has to be in it before the largest is taken
                for j, a, b in parts:
                    z[a - lo : b - lo] += self.tables.direct[j]
                z -= z.max(-1, keepdims=True)
            np.take(held.reshape(-1), aim[: hi - lo] + y[lo:hi], out=found[lo:hi], mode="clip")
            np.exp2(z, out=z)
            for j, a, b in parts:
                np.dot(z[a - lo : b - lo], self.ones if steep else self.weight[j], out=total[a:b])
        found -= np.log2(total)
        if not steep:
            found += self.tables.direct.ravel()[c[order].astype(np.int64) * CLASSES + y]
        result = np.empty_like(found)
        result[order] = found
        return result
