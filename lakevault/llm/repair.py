"""Conversation repair: a generalised LR parser that may delete, rerole and insert turns.

The role initials of a repaired conversation are a word of the grammar below,
``(s?(ua)+)?``. Its LR table is built from the productions. A row can be kept (cost 0),
reroled to user or assistant (1) or deleted (2, and blank and duplicate rows must be); an
empty user or assistant turn can be inserted anywhere (5); a truncated row that stays
costs 5 more. All stacks that a prefix of the conversation can leave are kept at once, as
nodes of a graph (a node is a state on another node, and equal stacks are the same node).
Equal stacks merge by the least (cost, audit), where the audit spells the edits. Adding
the same edits to two candidates keeps their order, since of two audits for the same rows
and the same cost neither begins the other. The grammar is left-recursive, so only a
handful of stacks exist.

Scale. Rows that repeat are counted before any shuffle, and rows are dealt by measured
ranges of (conversation, turn), so that a conversation with a third of all rows lies in
many tasks. A task parses the conversations that lie inside it. One that reaches a
task's edge, or has more than ``chunk_rows`` rows, is cut into chunks: a chunk's effect
is a small table (stack before, stack after, cost, audit); the tables of a
conversation are folded in order, writing out what all live stacks agree on; then the
chunks are repaired in parallel. What passes through one task per conversation is its
result: the audit, and the repaired text as SHA-256 reads it, a chunk at a time.

Defined cases: a null role or text is one space; turns are ordered by (turn, role, text),
null turns first; conversations without id are one; a conversation whose rows all have
``copies`` 0, has zeros, an empty audit and the hash of no bytes; an empty table gives
an empty result; other columns are ignored, whatever their names. A very long text costs
its own size in one task.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.llm.common import arrow_batches, discard, require, stored

GRAMMAR = (
    ("Talk", ()),
    ("Talk", ("s", "Pairs")),
    ("Talk", ("Pairs",)),
    ("Pairs", ("Pairs", "Pair")),
    ("Pairs", ("Pair",)),
    ("Pair", ("u", "a")),
)
END = "$"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs
FINE, CUT_SHORT, MUST_GO = 0, 1, 2  # what a row's fault asks for
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
BLANKS = " \t\n\x0b\x0c\r"
CHUNK_ROWS, CHUNK_CHARS = 4096, 1 << 20

#: (cost, audit)
Weight = tuple[int, str]


class Table:
    """LR table of a grammar, as moves between whole stacks (nodes are numbered, 0 is the empty stack)."""

    def __init__(self, grammar: tuple):
        self.rules = (("Start", (grammar[0][0],)), *grammar)
        self.heads = {h for h, _ in self.rules}
        self.terminals = sorted({x for _, body in self.rules for x in body} - self.heads)
        self._follows()
        start = self._closure({(0, 0)})
        self.states, self.goto, todo = [start], {}, [start]
        while todo:
            state = todo.pop()
            for symbol in {self.rules[r][1][d] for r, d in state if d < len(self.rules[r][1])}:
                moved = {(r, d + 1) for r, d in state if d < len(self.rules[r][1]) and self.rules[r][1][d] == symbol}
                target = self._closure(moved)
                if target not in self.states:
                    self.states.append(target)
                    todo.append(target)
                self.goto[self.states.index(state), symbol] = self.states.index(target)
        self.nodes, self.next = [(0, None)], []
        for node in self._grow():  # until no move leads to a new stack
            self.next.append({t: n for t in self.terminals if (n := self._shift(node, t)) is not None})
        self.between = sorted({0}.union(*[self.next[n].values() for n in range(len(self.next))]))  # stacks between two rows
        self.accepts = {n for n in self.between if self._reduced(n, END) is None}

    def _closure(self, items: set) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            r, d = todo.pop()
            body = self.rules[r][1]
            for k, (head, _) in enumerate(self.rules):
                if d < len(body) and body[d] == head and (k, 0) not in items:
                    items.add((k, 0))
                    todo.append((k, 0))
        return frozenset(items)

    def _follows(self) -> None:
        empty, first = set(), {t: {t} for t in self.terminals} | {h: set() for h in self.heads}
        self.follow = {h: set() for h in self.heads} | {"Start": {END}}

        def size() -> tuple:
            return len(empty), sum(map(len, first.values())), sum(map(len, self.follow.values()))

        before = None
        while before != size():
            before = size()
            for head, body in self.rules:
                if all(x in empty for x in body):
                    empty.add(head)
                for k, x in enumerate(body):
                    if all(y in empty for y in body[:k]):
                        first[head] |= first[x]
                    rest = body[k + 1 :]
                    if x in self.heads:
                        for j, y in enumerate(rest):
                            if all(z in empty for z in rest[:j]):
                                self.follow[x] |= first[y]
                        if all(y in empty for y in rest):
                            self.follow[x] |= self.follow[head]

    def _grow(self) -> Iterator[int]:
        at = 0
        while at < len(self.nodes):
            yield at
            at += 1

    def _node(self, state: int, below: int | None) -> int:
        if (state, below) not in self.nodes:
            self.nodes.append((state, below))
        return self.nodes.index((state, below))

    def _reduced(self, node: int, ahead: str) -> int | None:
        """The stack after all reductions that ``ahead`` asks for; None when they accept."""
        while True:
            state = self.states[self.nodes[node][0]]
            done = [r for r, d in state if d == len(self.rules[r][1]) and ahead in self.follow[self.rules[r][0]]]
            if not done:
                return node
            if len(done) > 1 or (self.nodes[node][0], ahead) in self.goto:
                raise ValueError("the grammar has a conflict in this table")
            if done == [0]:
                return None
            head, body = self.rules[done[0]]
            for _ in body:
                node = self.nodes[node][1]
            node = self._node(self.goto[self.nodes[node][0], head], node)

    def _shift(self, node: int, terminal: str) -> int | None:
        node = self._reduced(node, terminal)
        target = self.goto.get((self.nodes[node][0], terminal))
        if target is None:
            return None
        node = self._node(target, node)
        # a state that only ends one production needs no look ahead to be reduced
        while len(self.states[self.nodes[node][0]]) == 1 and all(d == len(self.rules[r][1]) for r, d in self.states[self.nodes[node][0]]):
            ((rule, _),) = self.states[self.nodes[node][0]]
            for _ in self.rules[rule][1]:
                node = self.nodes[node][1]
            node = self._node(self.goto[self.nodes[node][0], self.rules[rule][0]], node)
        return node


TABLE = Table(GRAMMAR)


def symbol(role: str, fault: int) -> str:
    """One character for what the parser has to know of a row."""
    return chr(48 + 3 * ("sua".find(role[:1]) if role[:1] else -1) + fault + 3)


def _put(live: dict[int, Weight], node: int, weight: Weight) -> bool:
    if node not in live or weight < live[node]:
        live[node] = weight
        return True
    return False


def with_inserts(live: dict[int, Weight]) -> dict[int, Weight]:
    """``live`` and what inserted turns reach from it."""
    live, todo = dict(live), list(live)
    while todo:
        node = todo.pop()
        cost, audit = live[node]
        todo += [n for t, n in TABLE.next[node].items() if t in ROLES and _put(live, n, (cost + INSERT, audit + "I"))]
    return live


@functools.lru_cache(64)
def _moves(code: str) -> tuple[int, tuple]:
    role, fault = divmod(ord(code) - 48, 3)
    initial = " sua"[role]
    extra = TRUNCATED if fault == CUT_SHORT else 0
    moves = [(initial, KEEP + extra, "K")] if role else []
    moves += [(t, REROLE + extra, "R") for t in ROLES if t != initial]
    return fault, tuple(moves)


def step(live: dict[int, Weight], code: str) -> dict[int, Weight]:
    """The live stacks after one more row."""
    fault, moves = _moves(code)
    out: dict[int, Weight] = {}
    for node, (cost, audit) in with_inserts(live).items():
        _put(out, node, (cost + DELETE, audit + "D"))
        if fault != MUST_GO:
            for terminal, price, letter in moves:
                if (target := TABLE.next[node].get(terminal)) is not None:
                    _put(out, target, (cost + price, audit + letter))
    return out


def best_end(live: dict[int, Weight]) -> Weight:
    return min(w for n, w in with_inserts(live).items() if n in TABLE.accepts)


@functools.lru_cache(1 << 16)
def solve(symbols: str) -> Weight:
    """Least (cost, audit) of a whole conversation."""
    live = {0: (0, "")}
    for code in symbols:
        live = step(live, code)
    return best_end(live)


def transfer(symbols: str) -> list[tuple[int, int, int, str]]:
    """(stack before, stack after, cost, audit) of a chunk's rows."""
    out = []
    for start in TABLE.between:
        live = {start: (0, "")}
        for code in symbols:
            live = step(live, code)
        out += [(start, end, cost, audit) for end, (cost, audit) in live.items()]
    return out


def agreed(live: dict[int, Weight]) -> tuple[str, dict[int, Weight]]:
    """What all live audits begin with, and the stacks without it."""
    audits = [a for _, a in live.values()]
    low, high = min(audits), max(audits)
    n = next((k for k, (x, y) in enumerate(zip(low, high, strict=False)) if x != y), min(len(low), len(high)))
    return low[:n], {k: (c, a[n:]) for k, (c, a) in live.items()}


def repaired(audit: str, roles: list, texts: list, phase: str) -> tuple[list[tuple[str, str]], str]:
    """The (role, text) rows that ``audit`` leaves; ``phase`` is the initial due next ('' at the start)."""
    out, at = [], 0
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        role, text = ROLES[phase or "u"], ""
        if letter != "I":
            role, text, at = (roles[at] if letter == "K" else role), texts[at], at + 1
        out.append((role, text))
        phase = "a" if role[:1] == "u" else "u"
    return out, phase


def spoken(rows: list[tuple[str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for role, text in rows)


def _signed(value: int) -> int:
    return (value + (1 << 63)) % (1 << 64) - (1 << 63)


COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long"


class _Chunk:
    """Consecutive rows of one conversation, and what is counted in them."""

    def __init__(self):
        self.symbols, self.roles, self.texts, self.chars, self.initials = [], [], [], 0, []
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns: list[int] = []  # distinct, ascending

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        trimmed = text.rstrip(BLANKS)
        fault = FINE
        if not trimmed:
            self.blank, fault = self.blank + 1, MUST_GO
        elif again:
            self.duplicate, fault = self.duplicate + 1, MUST_GO
        elif trimmed[-1] not in ".!?":
            self.truncated, fault = self.truncated + 1, CUT_SHORT
        if self.initials:
            self.illegal += self.initials[-1] + role[:1] not in LEGAL
            self.initials = [self.initials[0], role[:1]]
        else:
            self.initials = [role[:1]]
        if turn is not None and (not self.turns or turn != self.turns[-1]):
            self.turns.append(turn)
        gone = fault == MUST_GO
        self.symbols.append(symbol(role, fault))
        self.roles.append(None if gone else role)
        self.texts.append(None if gone else text)
        self.chars += 0 if gone else len(text)

    def full(self, rows: int) -> bool:
        return len(self.symbols) >= rows or self.chars >= CHUNK_CHARS


def _piece_type(conv) -> T.StructType:
    rest = T.StructType.fromDDL(
        f"part int, chunk int, open boolean, n long, {COUNTS}, cost long, audit string, repaired_sha256 string, "
        "turns array<struct<role: string, text: string>>, "
        "first_turn long, last_turn long, n_turns long, first_role string, last_role string, "
        "roles array<string>, texts array<string>, moves array<struct<before: int, after: int, cost: long, audit: string>>"
    )
    return T.StructType([T.StructField("conv_id", conv), *rest])


def _rows_to_batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _pieces(rows: DataFrame, keep_turns: bool, chunk_rows: int) -> DataFrame:
    """Finished conversations, and the chunks of those that reach a task's edge.

    ``rows`` are sorted by (conv_id, turn, role, text) within partitions that are ranges of them.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = _piece_type(rows.schema["conv_id"].dataType)
    arrow = to_arrow_schema(schema)

    def closed(conv, chunk: _Chunk) -> dict:
        cost, audit = solve("".join(chunk.symbols)) if len(chunk.symbols) <= 64 else solve.__wrapped__("".join(chunk.symbols))
        turns, _ = repaired(audit, chunk.roles, chunk.texts, "")
        gaps = chunk.turns[-1] - chunk.turns[0] + 1 - len(chunk.turns) if chunk.turns else 0
        return {
            "conv_id": conv, "open": False, "n": len(chunk.symbols), "gaps": _signed(gaps), "blank": chunk.blank, "duplicate": chunk.duplicate,
            "truncated": chunk.truncated, "illegal": chunk.illegal, "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256(spoken(turns).encode("utf-8", "surrogatepass")).hexdigest(),
            "turns": [{"role": r, "text": t} for r, t in turns] if keep_turns else None,
        }

    def opened(conv, part: int, number: int, chunk: _Chunk) -> dict:
        return {
            "conv_id": conv, "part": part, "chunk": number, "open": True, "n": len(chunk.symbols), "blank": chunk.blank,
            "duplicate": chunk.duplicate, "truncated": chunk.truncated, "illegal": chunk.illegal,
            "first_turn": chunk.turns[0] if chunk.turns else None, "last_turn": chunk.turns[-1] if chunk.turns else None,
            "n_turns": len(chunk.turns), "first_role": chunk.initials[0] if chunk.initials else None,
            "last_role": chunk.initials[-1] if chunk.initials else None, "roles": chunk.roles, "texts": chunk.texts,
            "moves": [dict(zip(("before", "after", "cost", "audit"), m, strict=True)) for m in transfer("".join(chunk.symbols))],
        }

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out, chars = [], 0
        conv, chunk, number, edge = None, None, 0, True  # edge: the conversation may have begun before this task

        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "turn", "role", "text", "n", "seen")]
            for key, turn, role, text, n, seen in zip(*columns, strict=True):
                if chunk is None or key != conv:
                    if chunk is not None:
                        out.append(opened(conv, part, number, chunk) if edge else closed(conv, chunk))
                        edge = False
                    conv, chunk, number = key, _Chunk(), 0
                for k in range(n):
                    if chunk.full(chunk_rows):  # too long for one piece: its chunks are folded like those at an edge
                        out.append(opened(conv, part, number, chunk))
                        chars += chunk.chars
                        chunk, number, edge = _Chunk(), number + 1, True
                        if chars >= CHUNK_CHARS:
                            yield _rows_to_batch(out, arrow)
                            out, chars = [], 0
                    chunk.add(turn, role, text, seen or k > 0)
                    chars += len(text) if keep_turns or edge else 200
                if chars >= CHUNK_CHARS:
                    yield _rows_to_batch(out, arrow)
                    out, chars = [], 0
        if chunk is not None:
            out.append(opened(conv, part, number, chunk))
        if out:
            yield _rows_to_batch(out, arrow)

    return rows.mapInArrow(parse, schema)


def _fold(pieces: DataFrame) -> DataFrame:
    """Per chunk its audit and the initial due at its start; per conversation (part null) its counts and cost."""
    from pyspark.sql.pandas.types import to_arrow_schema

    conv = pieces.schema["conv_id"]
    rest = T.StructType.fromDDL(f"part int, chunk int, phase string, audit string, {COUNTS}, cost long")
    schema = T.StructType([T.StructField("conv_id", conv.dataType), *rest])
    arrow = to_arrow_schema(schema)
    wanted = "conv_id part chunk n blank duplicate truncated illegal first_turn last_turn n_turns first_role last_role roles moves".split()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def cut(text: str, due: list, last: bool) -> Iterator[dict]:
            """Deal the agreed audit to the chunks it covers."""
            state["text"] += text
            while due:
                part, chunk, n, roles = due[0]
                at, left = 0, n
                while left and at < len(state["text"]):
                    left -= state["text"][at] != "I"
                    at += 1
                if left or (len(due) == 1 and not last):
                    return
                if last and len(due) == 1:
                    at = len(state["text"])
                piece, state["text"] = state["text"][:at], state["text"][at:]
                due.pop(0)
                yield {"conv_id": state["conv"], "part": part, "chunk": chunk, "phase": state["phase"], "audit": piece}
                state["phase"] = repaired(piece, roles, [""] * n, state["phase"])[1]

        def finish() -> Iterator[dict]:
            cost, audit = best_end(state["live"])
            yield from cut(audit, state["due"], True)
            c = state["counts"]
            gaps = state["last"] - state["first"] + 1 - c["n_turns"] if state["first"] is not None else 0
            yield {"conv_id": state["conv"], "gaps": _signed(gaps), "cost": state["cost"] + cost, **{k: c[k] for k in ("blank", "duplicate", "truncated", "illegal")}}

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != state["conv"]:
                    if state is not None:
                        out += finish()
                    state = {
                        "conv": row["conv_id"], "live": {0: (0, "")}, "cost": 0, "due": [], "text": "", "phase": "", "role": None, "first": None,
                        "last": None, "counts": dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "n_turns"), 0),
                    }
                c = state["counts"]
                for k in c:
                    c[k] += row[k]
                if row["n"]:
                    c["illegal"] += state["role"] is not None and state["role"] + row["first_role"] not in LEGAL
                    state["role"] = row["last_role"]
                if row["first_turn"] is not None:
                    c["n_turns"] -= row["first_turn"] == state["last"]
                    state["first"] = row["first_turn"] if state["first"] is None else state["first"]
                    state["last"] = row["last_turn"]
                live: dict[int, Weight] = {}
                for m in row["moves"]:
                    if m["before"] in state["live"]:
                        cost, audit = state["live"][m["before"]]
                        _put(live, m["after"], (cost + m["cost"], audit + m["audit"]))
                least = min(cost for cost, _ in live.values())
                text, live = agreed({k: (cost - least, audit) for k, (cost, audit) in live.items()})
                state["live"], state["cost"] = live, state["cost"] + least
                state["due"].append((row["part"], row["chunk"], row["n"], row["roles"]))
                out += cut(text, state["due"], False)
            if out:
                yield _rows_to_batch(out, arrow)
        if state is not None:
            yield _rows_to_batch(list(finish()), arrow)

    rows = pieces.where("open").select(*wanted)
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk").mapInArrow(fold, schema)


def _apply(pieces: DataFrame, folded: DataFrame) -> DataFrame:
    """The repaired rows of every chunk, with its part of the audit."""
    from pyspark.sql.pandas.types import to_arrow_schema

    same = F.col("c.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("c.part") == F.col("f.part")) & (F.col("c.chunk") == F.col("f.chunk"))
    joined = pieces.where("open").alias("c").join(folded.where("part IS NOT NULL").alias("f"), same)
    rows = joined.select("c.conv_id", "c.part", "c.chunk", "c.roles", "c.texts", "f.phase", "f.audit")
    schema = T.StructType([*rows.schema.fields[:3], *T.StructType.fromDDL("audit string, turns array<struct<role: string, text: string>>")])
    arrow = to_arrow_schema(schema)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                turns, _ = repaired(row["audit"], row["roles"], row["texts"], row["phase"])
                kept = {k: row[k] for k in ("conv_id", "part", "chunk", "audit")}
                yield _rows_to_batch([{**kept, "turns": [{"role": r, "text": t} for r, t in turns]}], arrow)

    return rows.mapInArrow(edit, schema)


def _digests(edited: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256) of the conversations that were cut, their text read a chunk at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([edited.schema["conv_id"], *T.StructType.fromDDL("audit string, repaired_sha256 string")])
    arrow = to_arrow_schema(schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, sha, begun = None, None, None, False
        for batch in batches:
            for row in batch.to_pylist():
                if audit is None or row["conv_id"] != conv:
                    if audit is not None:
                        yield _rows_to_batch([{"conv_id": conv, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}], arrow)
                    conv, audit, sha, begun = row["conv_id"], [], hashlib.sha256(), False
                audit.append(row["audit"])
                if row["turns"]:
                    text = spoken([(t["role"], t["text"]) for t in row["turns"]])
                    sha.update((("\n" if begun else "") + text).encode("utf-8", "surrogatepass"))
                    begun = True
        if audit is not None:
            yield _rows_to_batch([{"conv_id": conv, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}], arrow)

    return edited.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk").mapInArrow(digest, schema)


def _prepared(rows: DataFrame, copies_col: str | None) -> tuple[DataFrame, DataFrame]:
    """Distinct rows with their number (``n``) and whether role and text were ``seen`` at an earlier turn, dealt by ranges; and the written table of repeats."""
    require(rows, "conv_id", "turn", "role", "text", *([copies_col] if copies_col else []))
    n = F.col(copies_col).cast("long") if copies_col else F.lit(1).cast("long")
    there = n > 0  # a row that is not there only tells that its conversation exists
    plain = rows.select(
        "conv_id",
        F.when(there, F.col("turn").cast("long")).alias("turn"),
        F.when(there, F.coalesce("role", F.lit(" "))).otherwise("").alias("role"),
        F.when(there, F.coalesce("text", F.lit(" "))).otherwise("").alias("text"),
        n.alias("n"),
    )
    distinct = plain.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    # two hashes stand for role and text; a null turn comes before all others
    said = {"_h1": F.xxhash64("role", "text"), "_h2": F.xxhash64(F.lit(1), "text", "role")}
    first = plain.where("n > 0").groupBy(F.col("conv_id").alias("_c"), *[e.alias(k) for k, e in said.items()]).agg(
        F.min("turn").alias("_first"), F.max("turn").alias("_last"), F.max(F.col("turn").isNull()).alias("_null")
    )
    # written, so that its size is known and few repeats do not make the rows move for the join
    again = stored(first.where("_first != _last OR (_null AND _first IS NOT NULL)").drop("_last"), "repair_again")
    marked = distinct.withColumns({f"{k}x": e for k, e in said.items()}).join(
        again, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_h1x") == F.col("_h1")) & (F.col("_h2x") == F.col("_h2")), "left"
    )
    seen = F.coalesce(F.when(F.col("_null"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("_first")), F.lit(False)).alias("seen")
    order = ["conv_id", "turn", "role", "text"]
    return marked.select(*order, "n", seen).repartitionByRange(*order).sortWithinPartitions(*order), again


def repair_conversations(
    rows: DataFrame, copies_col: str | None = None, keep_turns: bool = True, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Per conversation its faults, the least cost, the audit, the repaired turns' SHA-256, and the turns.

    ``rows`` has ``conv_id``, ``turn``, ``role`` and ``text``; ``copies_col`` says how often a row is
    there (once, without it). ``turns`` is an array of (role, text); a conversation that was cut
    into chunks has it null here, and its rows in ``repaired_chunks``.
    """
    prepared, again = _prepared(rows, copies_col)
    with arrow_batches(rows.sparkSession):
        pieces = stored(_pieces(prepared, keep_turns, chunk_rows), "repair_pieces", "open")
        folded = stored(_fold(pieces), "repair_fold")
        edited = stored(_apply(pieces, folded), "repair_chunks")
        digests = _digests(edited).withColumnRenamed("conv_id", "_c")
        counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
        cut = folded.where("part IS NULL").drop("audit").join(digests, F.col("conv_id").eqNullSafe(F.col("_c")))
        out = ["conv_id", *counts, "audit", "repaired_sha256", "turns"]
        cut = cut.withColumn("turns", F.lit(None).cast(pieces.schema["turns"].dataType)).select(*out)
        whole = stored(pieces.where("NOT open").select(*out).unionByName(cut), "repaired")
    discard(again, pieces, folded)
    whole.chunks = edited  # (conv_id, part, chunk, audit, turns) of the conversations that were cut
    return whole


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage: some rows dropped, emptied, cut short, doubled (``copies``) or said by another role."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *text)) % 20
    said, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(said, ".!?", "")).otherwise(said).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def op13_repair(conversations: DataFrame) -> DataFrame:
    """Per conversation: gaps, faults, cost, audit and the repaired rows' hash."""
    require(conversations, "conv_id", "turn", "role", "text")
    repaired_ = repair_conversations(damaged(conversations), "copies", keep_turns=False)
    discard(repaired_.chunks)
    return repaired_.drop("turns")


def _plus(weight: str, cost: str, letter: str) -> str:
    """SQL for a state's weight with one more edit; null for a state that is not reached."""
    return f"CASE WHEN {weight} IS NOT NULL THEN struct_pack(c := CAST({weight}.c + {cost} AS INTEGER), a := {weight}.a || '{letter}') END"


#: cost and audit are one struct, so that the least of them is SQL's least; z, s, a, p: nothing yet, after a
#: system turn, after a user turn, after a pair
ORACLE_OP13 = f"""
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n] || range(8),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), keyed AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295,
    list_reduce([4294967295] || list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT)),
      lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)]))) % 20 AS kind FROM keyed, t
), hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM hurt
), marked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said FROM ordered
), faulty AS (
  SELECT *, left(role, 1) AS r, CASE WHEN said = '' THEN 'blank' WHEN seen THEN 'duplicate'
    WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM marked
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM faulty GROUP BY conv_id
), convs AS (
  SELECT DISTINCT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(n, 0) AS n
  FROM conversations c LEFT JOIN counted d ON c.conv_id IS NOT DISTINCT FROM d.conv_id
), run AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, struct_pack(c := 0, a := '') AS z, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR)) AS s,
    CAST(NULL AS STRUCT(c INTEGER, a VARCHAR)) AS a, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR)) AS p FROM convs
  UNION ALL
  SELECT w.conv_id, w.i + 1,
    list_min([{_plus("z", "2", "D")}]),
    list_min([{_plus("s", "2", "D")}, CASE WHEN ok AND r = 's' THEN {_plus("z", "e", "K")} END]),
    list_min([{_plus("a2", "2", "D")}, CASE WHEN ok AND r = 'u' THEN {_plus("up", "e", "K")} END, CASE WHEN ok THEN {_plus("up", "e + 1", "R")} END]),
    list_min([{_plus("p2", "2", "D")}, CASE WHEN ok AND r = 'a' THEN {_plus("a2", "e", "K")} END, CASE WHEN ok THEN {_plus("a2", "e + 1", "R")} END])
  FROM (
    SELECT *, list_min([z, s, p2]) AS up FROM (
      SELECT *, list_min([p, {_plus("a2", "5", "I")}]) AS p2 FROM (
        SELECT run.*, list_min([a, {_plus("z", "5", "I")}, {_plus("s", "5", "I")}, {_plus("p", "5", "I")}]) AS a2, f.r, f.fault NOT IN ('blank', 'duplicate') AS ok,
          CASE WHEN f.fault = 'truncated' THEN 5 ELSE 0 END AS e
        FROM run JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM run.conv_id AND f.i = run.i + 1))) w
), done AS (
  SELECT *, list_min([z, p, {_plus("a2", "5", "I")}]) AS w FROM (
    SELECT v.*, z, p, list_min([a, {_plus("z", "5", "I")}, {_plus("s", "5", "I")}, {_plus("p", "5", "I")}]) AS a2
    FROM convs v JOIN run ON run.conv_id IS NOT DISTINCT FROM v.conv_id AND run.i = v.n)
), edits AS (
  SELECT conv_id, w.a AS audit, unnest(range(1, length(w.a) + 1)) AS j FROM done
), placed AS (
  SELECT e.conv_id, j, substr(audit, j, 1) AS letter, length(replace(left(audit, j), 'I', '')) AS i,
    length(replace(left(audit, j - 1), 'D', '')) AS before FROM edits e
), kept AS (
  SELECT p.*, f.role, f.text, first_value(letter = 'K' AND f.r = 's') OVER (PARTITION BY p.conv_id ORDER BY j) AS led
  FROM placed p LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i AND letter <> 'I' WHERE letter <> 'D'
), texts AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (before - CAST(led AS INTEGER)) % 2 = 0 THEN 'user' ELSE 'assistant' END
    || ':' || coalesce(text, ''), chr(10) ORDER BY j) AS said FROM kept GROUP BY conv_id
)
SELECT d.conv_id, gaps, blank, duplicate, truncated, illegal, CAST(w.c AS BIGINT) AS cost, w.a AS audit,
  sha256(coalesce(said, '')) AS repaired_sha256
FROM done d LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM d.conv_id
"""
