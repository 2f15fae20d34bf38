"""Blocks: whole rows of a table in compressed groups, written once and revisited by key.

Operators that need several rounds of questions and answers about every text
("which of my windows occur elsewhere?") cut the input into blocks of a bounded
size. A task of the first pass fills blocks from its partition, writes them as
single rows and, beside them, whatever the operator wants to ask about each
block. Later rounds shuffle only such compact questions and answers, and meet
the texts again by block key (``with_answers``); no text is ever a shuffle row
of its own, no block is larger than ``BLOCK_BYTES`` (or one row), and a lost
executor costs the re-reading of its blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lakevault.llm.common import release_memory, require, stored, text_batches

BLOCK_BYTES = 4 << 20
BLOCK_ROWS = 1 << 16

#: kind of a written row: the block itself, or a message with an address
TEXT, MESSAGE = 0, 1
SCHEMA = "kind int, block long, part long, data binary"
ARROW_SCHEMA = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("part", pa.int64()), ("data", pa.binary())])

#: (address, payload) pairs for one block
Messages = list[tuple[int, bytes]]


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed message; ``expand`` restores them."""
    head = np.array([len(arrays)], np.int64).tobytes()
    body = []
    for a in arrays:
        kind = np.dtype(a.dtype).str.encode().ljust(8)
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T  # like bytes lie together
        head += kind + np.array([len(a)], np.int64).tobytes()
        body.append(np.ascontiguousarray(planes).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(body))


def expand(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(bytes(data))
    count = int(np.frombuffer(raw, np.int64, 1)[0])
    at, out = 8 + 16 * count, []
    for k in range(count):
        kind = np.dtype(raw[8 + 16 * k : 16 + 16 * k].strip().decode())
        n = int(np.frombuffer(raw, np.int64, 1, 16 + 16 * k)[0])
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * kind.itemsize
    return out


def _pack(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    return zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes())


def unpack(data: bytes) -> pa.Table:
    """The rows of a block."""
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(bytes(data))).read_all().combine_chunks()


def write_blocks(
    docs: DataFrame,
    text_col: str,
    name: str,
    ask: Callable[[int, pa.Table], Messages | tuple[Messages, pa.Table]],
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Cut ``docs`` into blocks, with the messages that ``ask(block, rows)`` returns; written by kind.

    Where ``ask`` returns a table beside the messages, that is written in place of the rows.
    Block keys are unique; ``key | row`` names a row, rows counting from 0 in a block.
    """
    require(docs, text_col)
    at = docs.columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        count, held, size, n = 0, [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal count, held, size, n
            rows = pa.Table.from_batches(held).combine_chunks()
            block = base + (count << 16)
            messages = ask(block, rows)
            if isinstance(messages, tuple):
                messages, rows = messages
            yield pa.RecordBatch.from_arrays(
                [pa.array([TEXT], pa.int32()), pa.array([block]), pa.array([0]), pa.array([_pack(rows)], pa.binary())], schema=ARROW_SCHEMA
            )
            for lo in range(0, len(messages), 4096):
                part = messages[lo : lo + 4096]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([MESSAGE] * len(part), pa.int32()),
                        pa.array([block] * len(part), pa.int64()),
                        pa.array([p for p, _ in part], pa.int64()),
                        pa.array([d for _, d in part], pa.binary()),
                    ],
                    schema=ARROW_SCHEMA,
                )
            count, held, size, n = count + 1, [], 0, 0
            release_memory()

        for batch in batches:
            lengths = np.asarray(pa.compute.binary_length(batch.column(at)).fill_null(0)).astype(np.int64)
            ends = np.cumsum(lengths)
            lo = 0
            while lo < batch.num_rows:
                before = ends[lo - 1] if lo else 0
                hi = int(np.searchsorted(ends, before + max(0, block_bytes - size), side="right"))
                hi = min(max(hi, lo + (not held)), lo + BLOCK_ROWS - n, batch.num_rows)
                if hi > lo:
                    held.append(batch.slice(lo, hi - lo))
                    size, n = size + int(ends[hi - 1] - before), n + hi - lo
                if hi < batch.num_rows or size >= block_bytes:
                    yield from flush()
                lo = hi
        if held:
            yield from flush()

    return stored(text_batches(docs).mapInArrow(cut, SCHEMA), name, "kind")


def exchange(messages: DataFrame, answer: Callable[[int, list[tuple[int, bytes]]], list[tuple[int, bytes]]]) -> DataFrame:
    """(block, part, data): the answers to the messages of every address.

    ``answer(address, [(block, payload), ...])`` gets all messages of an address and
    returns (block, payload) answers.
    """

    def of_address(key: tuple, rows: pa.Table) -> pa.Table:
        address = key[0].as_py()
        pairs = sorted(zip(rows.column("block").to_pylist(), rows.column("data").to_pylist(), strict=True))
        found = answer(address, pairs)
        out = pa.table(
            {
                "block": pa.array([b for b, _ in found], pa.int64()),
                "part": pa.array([address] * len(found), pa.int64()),
                "data": pa.array([d for _, d in found], pa.binary()),
            }
        )
        del rows, pairs, found
        release_memory()
        return out

    return messages.select("block", "part", "data").groupBy("part").applyInArrow(of_address, "block long, part long, data binary")


def with_answers(blocks: DataFrame, answers: DataFrame, visit: Callable[[int, pa.Table, dict[int, bytes]], pa.Table], schema) -> DataFrame:
    """``visit(block, rows, {address: answer})`` for every block, answers or none."""

    def meet(key: tuple, texts: pa.Table, found: pa.Table) -> pa.Table:
        replies = dict(zip(found.column("part").to_pylist(), found.column("data").to_pylist(), strict=True))
        out = visit(key[0].as_py(), unpack(texts.column("data")[0].as_py()), replies)
        release_memory()
        return out

    left = blocks.select("block", "data").groupBy("block")
    return left.cogroup(answers.select("block", "part", "data").groupBy("block")).applyInArrow(meet, schema)
