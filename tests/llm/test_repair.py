"""Conversation repair against every edit script, and against its SQL on awkward rows cut at every size."""

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from lakevault.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"


def least_script(symbols: str, inserts: int = 4) -> tuple:
    """Least (cost, audit) over all edit scripts."""
    found = []

    def go(i, out, cost, audit, left):
        if found and cost > found[0][0]:
            return
        if i == len(symbols) and re.fullmatch("(s?(ua)+)?", out):
            found[:] = [min([*found, (cost, audit)])]
        if left:
            for t in "ua":
                go(i, out + t, cost + 5, audit + "I", left - 1)
        if i < len(symbols):
            role, fault = divmod(ord(symbols[i]) - 48, 3)
            go(i + 1, out, cost + 2, audit + "D", left)
            if fault != repair.MUST_GO:
                extra = 5 * (fault == repair.CUT_SHORT)
                go(i + 1, out + " sua"[role], cost + extra, audit + "K", left)
                for t in "ua":
                    go(i + 1, out + t, cost + 1 + extra, audit + "R", left)

    go(0, "", 0, "", inserts)
    return found[0]


def test_the_parser_finds_the_least_script():
    dice = random.Random(5)
    for _ in range(150):
        rows = [(dice.choice(["system", "user", "assistant", "tool", ""]), dice.choice([0, 0, 0, 1, 2])) for _ in range(dice.randint(0, 5))]
        symbols = "".join(repair.symbol(*r) for r in rows)
        assert repair.solve(symbols) == least_script(symbols)


def test_chunks_compose_to_the_whole():
    dice = random.Random(6)
    for _ in range(40):
        symbols = "".join(chr(48 + 3 * dice.randint(0, 3) + dice.choice([0, 0, 1, 2])) for _ in range(30))
        live, text = {0: (0, "")}, ""
        for at in range(0, 30, 7):
            moved = {}
            for before, after, cost, audit in repair.transfer(symbols[at : at + 7]):
                if before in live:
                    repair._put(moved, after, (live[before][0] + cost, live[before][1] + audit))
            agreed, live = repair.agreed(moved)
            text += agreed
        cost, audit = repair.best_end(live)
        assert (cost, text + audit) == repair.solve(symbols)


def awkward_rows(spark):
    dice = random.Random(7)
    texts = ["Yes.", "No!", "cut", " \t\n", "", "What?  ", "Ünï. \x0b", None, "a" * 3000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "unknown"]
    rows = [(1, t, dice.choice(roles), dice.choice(texts)) for t in range(300)]  # long, faults of every kind
    rows += [(2, t, ["user", "assistant"][t % 2], f"turn {t}.") for t in range(80)]
    rows += [(3, 0, "user", "Hi."), (3, 0, "user", "Hi."), (3, 0, "user", "Hi!"), (3, None, "assistant", "So."), (3, None, None, None)]
    rows += [(None, 4, "assistant", "Lost."), (None, None, "user", "Lost."), (4, 5, "user", "Same.")] + [(5, 3, "user", "Copy.")] * 60
    rows += [(k, t, ["user", "assistant"][t % 2], dice.choice(texts)) for k in range(100, 140) for t in range(4)]
    dice.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.select(*df.columns, *[F.lit(1).alias(c) for c in ("part", "chunk", "n", "seen", "copies", "audit", "_c", "open", "turns")])


def by_sql(df) -> list:
    con = duckdb.connect()
    con.register("conversations", df.select("conv_id", "turn", "role", "text").toArrow())
    return con.execute(f"SELECT {COLUMNS} FROM ({repair.ORACLE_OP13})").fetchall()


COLUMNS = "conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256"


@pytest.mark.parametrize("chunk_rows", [4, 4096])
def test_awkward_rows_equal_sql(spark, chunk_rows):
    df = awkward_rows(spark)
    whole = repair.repair_conversations(repair.damaged(df), "copies", chunk_rows=chunk_rows)
    got = [tuple(r) for r in whole.select(*COLUMNS.split(", ")).collect()]
    assert sorted(got, key=str) == sorted(by_sql(df), key=str)
    if chunk_rows == 4:  # the turns of a conversation in chunks are in the chunks, in order
        rows = whole.chunks.where("conv_id = 2").orderBy("part", "chunk").collect()
        turns = [t for r in rows for t in r.turns]
        initials = "".join(t.role[:1] for t in turns)
        assert len(rows) > 5 and re.fullmatch("s?(ua)+", initials)


def test_repaired_turns_follow_the_grammar(spark):
    rows = repair.repair_conversations(awkward_rows(spark).drop("copies")).where("turns IS NOT NULL").collect()
    assert len(rows) > 30
    for r in rows:
        assert re.fullmatch("(s?(ua)+)?", "".join(t.role[:1] for t in r.turns))


def test_no_rows_and_only_dropped_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.op13_repair(none).count() == 0
    dropped = [k for k in range(200) if spark.range(1).select(F.crc32(F.lit(f"{k}:0"))).first()[0] % 20 == 0][:2]
    df = spark.createDataFrame([(k, 0, "user", "Hello.") for k in dropped], SCHEMA)
    rows = [tuple(r) for r in repair.op13_repair(df).select(*COLUMNS.split(", ")).collect()]
    nothing = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert sorted(rows) == [(k, 0, 0, 0, 0, 0, 0, "", nothing) for k in sorted(dropped)]
