"""Hierarchical multi-length packing of tokenised documents.

Each document's ids (byte-level BPE, then the end id 0) are cut into full
windows of the largest tier; what remains goes to the smallest tier that holds
it. Every tier's pieces open windows of the tier's size, longest first. The gap
behind a piece is filled with whole pieces of shorter tiers, the longest that
fits first; when none fits, one piece is cut to fit exactly and its rest moves
down the tiers. So all windows are full and, the tiers being powers of two,
unpadded; each task leaves at most one open window at its end.

Windows are dealt to step groups: ``step_tokens`` / tier windows of one tier
form a step, so steps hold equally many tokens; within a deal they are handed
out in snake order of their attention cost (sum of squared piece lengths).

The work is one narrow pass: each input partition packs its own documents, with
memory bounded by ``flush_tokens``, and nothing is shuffled. Read the input
from files (or a written table): a retried task then sees the same rows and
repeats the same windows. Sequence and step ids carry the partition number in
their upper bits.

Defined cases: a null or empty text is the single id 0; repeated rows are packed
each on its own; extra input columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import release_memory, require, text_batches
from lakevault.llm.tokens import END_ID, ByteBpe, tokenizer_path

TIERS = (128, 256, 512, 1024)

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "context long, step_group long"
)


class TierPacker:
    """Packs pieces (doc, start, length) into windows of the tiers' sizes."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers = tuple(sorted(tiers))
        if any(t & (t - 1) for t in self.tiers):
            raise ValueError(f"tiers must be powers of two: {tiers}")
        self.by_length: dict[int, list] = {}
        self.lengths = 0  # bit l is set if pieces of length l wait
        self.waiting = 0  # tokens
        self.windows: list[tuple[int, list]] = []  # (tier, pieces)

    def add(self, doc: int, total: int) -> None:
        top = self.tiers[-1]
        full = total // top
        for k in range(full):
            self.windows.append((top, [(doc, k * top, top)]))
        if total - full * top:
            self._put((doc, full * top, total - full * top))

    def _put(self, piece: tuple) -> None:
        self.by_length.setdefault(piece[2], []).append(piece)
        self.lengths |= 1 << piece[2]
        self.waiting += piece[2]

    def _pop(self, length: int) -> tuple:
        stack = self.by_length[length]
        piece = stack.pop()
        if not stack:
            self.lengths &= ~(1 << length)
        self.waiting -= length
        return piece

    def _longest(self, most: int) -> int:
        """The longest waiting length up to ``most``, 0 if none."""
        return (self.lengths & ((1 << (most + 1)) - 1)).bit_length() - 1 if self.lengths & ((1 << (most + 1)) - 1) else 0

    def _shortest(self, least: int) -> int:
        """The shortest waiting length of at least ``least``, 0 if none."""
        rest = self.lengths >> least
        return least + (rest & -rest).bit_length() - 1 if rest else 0

    def pack(self, last: bool) -> None:
        """Close windows tier by tier; without ``last``, an unfilled one's pieces wait on."""
        for tier in reversed(self.tiers):
            low = tier // 2 if tier != self.tiers[0] else 0
            while (length := self._longest(tier)) > low:
                pieces, gap = [self._pop(length)], tier - length
                while gap:
                    if fits := self._longest(min(gap, max(low, 1))):
                        pieces.append(self._pop(fits))
                        gap -= fits
                    elif longer := self._shortest(gap):
                        doc, start, size = self._pop(longer)
                        pieces.append((doc, start, gap))
                        if size > gap:
                            self._put((doc, start + gap, size - gap))
                        gap = 0
                    else:
                        break
                if gap and not last:
                    for p in pieces:
                        self._put(p)
                    return
                self.windows.append((tier, pieces))

    def take(self) -> list[tuple[int, list]]:
        out, self.windows = self.windows, []
        return out


class StepDealer:
    """Deals a tier's windows to steps of equally many tokens and near-equal attention cost."""

    def __init__(self, step_tokens: int, first_id: int, deal_steps: int = 8):
        self.step_tokens, self.next_id, self.deal_steps = step_tokens, first_id, deal_steps
        self.held: dict[int, list] = {}

    def deal(self, windows: list, last: bool) -> Iterator[tuple[int, int, list]]:
        """(step, tier, pieces) of the windows of every full deal; of all with ``last``."""
        for tier, pieces in windows:
            self.held.setdefault(tier, []).append(pieces)
        for tier, held in self.held.items():
            per_step = max(1, self.step_tokens // tier)
            while held and (last or len(held) >= per_step * self.deal_steps):
                now, self.held[tier] = held[: per_step * self.deal_steps], held[per_step * self.deal_steps :]
                held = self.held[tier]
                steps = -(-len(now) // per_step)
                now.sort(key=lambda pieces: -sum(p[2] ** 2 for p in pieces))
                for i, pieces in enumerate(now):
                    turn, k = divmod(i, steps)
                    yield self.next_id + (k if turn % 2 == 0 else steps - 1 - k), tier, pieces
                self.next_id += steps


def pack_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = 65536,
    flush_tokens: int = 1 << 21,
    vocabulary: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: where a run of a document's ids lies, and (``with_ids``) the ids themselves.

    ``context`` is the window's tier, ``offset`` the piece's place in the window,
    ``step_group`` the training step the window is dealt to.
    """
    require(docs, id_col, text_col)
    path = vocabulary or tokenizer_path("byte_bpe_50k")
    schema = PIECES + (", ids array<int>" if with_ids else "")
    arrow = pa.schema(
        [(c.split()[0], pa.int64()) for c in PIECES.split(", ")] + ([("ids", pa.list_(pa.int32()))] if with_ids else [])
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path)
        base = TaskContext.get().partitionId() << 40
        packer, dealer = TierPacker(tiers), StepDealer(step_tokens, base)
        known: dict[int, tuple] = {}  # number of the document in this task: its id and ids
        count = held = 0
        sequence = base

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, sequence
            packer.pack(last)
            rows: list[tuple] = []
            ids_out: list[np.ndarray] = []
            for step, tier, pieces in dealer.deal(packer.take(), last):
                at = 0
                for doc, start, length in pieces:
                    doc_id, ids = known[doc]
                    part = ids[start : start + length]
                    rows.append((doc_id, start, length, zlib.crc32(part.tobytes()), len(ids), sequence, at, tier, step))
                    if with_ids:
                        ids_out.append(part)
                    at += length
                sequence += 1
            used = {p[0] for stack in packer.by_length.values() for p in stack}
            used |= {p[0] for windows in dealer.held.values() for pieces in windows for p in pieces}
            for doc in [d for d in known if d not in used]:
                del known[doc]
            held = 0
            columns = list(zip(*rows, strict=True)) or [[]] * 9
            arrays = [pa.array(c, pa.int64()) for c in columns]
            if with_ids:
                arrays.append(pa.array([x.astype(np.int32) for x in ids_out], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for i, doc_id in enumerate(doc_ids):
                text = batch.column(1)[i].as_py()
                ids = np.append(bpe.encode(text or ""), np.uint32(END_ID)).astype("<u4")
                known[count] = (doc_id, ids)
                packer.add(count, len(ids))
                count += 1
                held += len(ids)
                if held >= flush_tokens:
                    yield from flush(False)
        yield from flush(True)
        release_memory()

    return text_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(pack, schema)


def op3_packing(docs: DataFrame) -> DataFrame:
    """The registered query: all documents in windows of at most 1024 tokens."""
    return pack_documents(docs)
