"""Conversation repair against a plain search over all edit scripts."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blotter.llm import conversations as C
from blotter.llm import queries
from oracle_check import compare, duck

COLUMNS = "conv_id long, turn long, role string, text string, block string, place int"
LEGAL = re.compile(r"(s?(ua)+)?")


def plain_least(codes):
    """(cost, audit) of the least script: whole strings per state, row by row."""
    ends = {0: (0, "")}
    for code in codes:
        after = {}
        for state, (cost, audit) in ends.items():
            for after_state, more, letters in C.row_ways(code)[state]:
                way = (cost + more, audit + letters)
                after[after_state] = min(after.get(after_state, way), way)
        ends = after
    return min((c + 5 * C.TO_END[s], a + "I" * C.TO_END[s]) for s, (c, a) in ends.items())


def every_script(codes, inserts=2):
    """(cost, audit) of the least script, by listing the scripts and reading the roles."""
    best = None
    gaps = [list(itertools.product("ua", repeat=n)) for n in range(inserts + 1)]
    ways = []
    for code in codes:
        extra = 5 if code.isupper() else 0
        ways.append([("D", "", 2)] + ([] if code == "d" else [("K", code.lower(), extra), ("R", "u", 1 + extra), ("R", "a", 1 + extra)]))
    for said in itertools.product(*[sum(gaps, [])] * (len(codes) + 1)):
        for edits in itertools.product(*ways):
            roles = "".join("".join(s) + e[1] for s, e in zip(said, edits)) + "".join(said[-1])
            if LEGAL.fullmatch(roles):
                audit = "".join("I" * len(s) + e[0] for s, e in zip(said, edits)) + "I" * len(said[-1])
                way = (sum(e[2] for e in edits) + 5 * sum(map(len, said)), audit)
                best = way if best is None else min(best, way)
    return best


@pytest.mark.parametrize("codes", ["", *map("".join, itertools.chain(*(itertools.product("suaxdUA", repeat=n) for n in (1, 2))))])
def test_rows_against_all_scripts(codes):
    assert plain_least(codes) == every_script(codes)


@pytest.mark.parametrize("codes", ["sua", "auu", "uuu", "dad", "SuA", "xxx", "aaa"])
def test_three_rows_against_all_scripts(codes):
    assert plain_least(codes) == every_script(codes, 1)


def by_blocks(codes, size):
    blocks = ["".join(codes[i:i + size]) for i in range(0, len(codes), size)]
    parts = [C.block_ways(list(C.block_vectors(b))) for b in blocks]
    ahead, to_end = C.forward(parts, 0), [5 * n for n in C.TO_END]
    end = C.meeting(ahead, to_end)
    at = C.crossings(parts, 0, end)
    audit = "".join("".join(C.block_edits(b, x, y)) for b, x, y in zip(blocks, at, at[1:])) + "I" * C.TO_END[end]
    return ahead[0][end] + to_end[end], audit


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("suaxdSUAX"), max_size=40), st.sampled_from([1, 2, 3, 7, 100]))
def test_divide_and_conquer(codes, size):
    assert by_blocks(codes, size) == plain_least(codes)


def plain_repair(rows):
    """Report of every conversation, from Python lists."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [[r[1], r[2] if r[2] is not None else " ", r[3] if r[3] is not None else " "] for r in rows if r[0] == conv]
        key = [zlib.crc32(f"{' ' if conv is None else conv}:{' ' if r[0] is None else r[0]}".encode()) % 20 for r in mine]
        hurt = []
        for (turn, role, text), k in zip(mine, key):
            if k == 0:
                continue
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            hurt += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
        hurt.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, codes, faults = set(), "", [0, 0, 0]
        for _, role, text in hurt:
            bare = text.strip(" \t\n\x0b\x0c\r")
            code = role[:1] if role[:1] in ("s", "u", "a") else "x"
            if not bare or (role, text) in seen:
                faults[bool(bare)] += 1
                code = "d"
            elif bare[-1] not in ".!?":
                faults[2] += 1
                code = code.upper()
            seen.add((role, text))
            codes += code
        turns = [r[0] for r in hurt if r[0] is not None]
        cost, audit = plain_least(codes)
        illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(hurt, hurt[1:]))
        state, said, left = 0, [], list(hurt)
        for e in audit:
            if e == "I":
                state = C.NEXT[state]
                said.append(C.NAMES[state] + ":")
                continue
            _, role, text = left.pop(0)
            if e != "D":
                state = C.NEXT[state] if e == "R" else C.STEPS[state][role[0]]
                said.append((C.NAMES[state] if e == "R" else role) + ":" + text)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *faults, illegal, cost, audit,
                     hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def table_rows():
    rnd = random.Random(12)
    texts = ["Yes.", "no", "Why?", "", " \n", None, "same!", "a" * 3000 + ".", "été…", "x.\x1c", "x.\x0b", "line\nline.\n"]
    roles = ["user", "assistant", "system", "User", "", None, "unknown", "tool", "ü"]
    rows = []
    for conv in [*range(60), None]:
        alternate = rnd.random() < 0.6
        for turn in range(rnd.randrange(1, 9)):
            role = ("user", "assistant")[turn % 2] if alternate and rnd.random() < 0.9 else rnd.choice(roles)
            rows.append((conv, turn if rnd.random() < 0.95 else None, role, rnd.choice(texts) if rnd.random() < 0.5 else f"t{turn}."))
    rows += [rnd.choice(rows) for _ in range(30)]
    rows += [(1000, t, ("user", "assistant")[t % 2] if rnd.random() < 0.95 else "user", rnd.choice(["a.", "b", f"{t}."])) for t in range(700)]
    rows += [(1001, 5, "user", "again.")] * 50 + [(1002, None, "assistant", "only.")]
    rows += [(c, 0, "user", "gone.") for c in range(2000, 2060)]  # some of these lose their only row
    return [(*r, "b", 1) for r in rows]


def run(spark, rows):
    damaged, copies = C.damage(spark.createDataFrame(rows, COLUMNS).repartition(6))
    return C.with_digests(*C.repair(damaged, copies))


@pytest.mark.parametrize("bits", [1, 3, 11])
def test_equals_the_plain_repair(spark, monkeypatch, bits):
    monkeypatch.setattr(C, "BLOCK_BITS", bits)
    rows = table_rows()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a conversation in many ranges
    try:
        got = run(spark, rows).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = plain_repair(rows)
    assert len(got) == len(want)
    assert {r[0]: tuple(r[1:]) for r in got} == want


def test_turns_of_a_whole_table(spark):
    rows = [(1, 0, "assistant", "Hi.", "", 0), (1, 1, "user", "What?", "", 0), (1, 2, "user", "Say.", "", 0), (1, 3, "assistant", "So.", "", 0)]
    reports, turns = C.repair(spark.createDataFrame(rows, COLUMNS))
    assert (reports.first()["cost"], reports.first()["audit"]) == (2, "RRKK")
    assert [tuple(r) for r in turns.collect()] == [
        (1, 1, 0, "R", "user", "Hi."), (1, 2, 1, "R", "assistant", "What?"), (1, 3, 2, "K", "user", "Say."), (1, 4, 3, "K", "assistant", "So.")]
    reports, turns = C.repair(spark.createDataFrame(rows[1:3], COLUMNS).where("turn = 1"))
    assert [tuple(r) for r in turns.collect()] == [] and reports.first()["audit"] == "D"
    reports, turns = C.repair(spark.createDataFrame(rows[:2], COLUMNS))
    assert (reports.first()["cost"], reports.first()["audit"]) == (2, "RR")
    reports, turns = C.repair(spark.createDataFrame(rows[:1] * 2, COLUMNS), F.lit(2))
    assert reports.first()["audit"] == "DDDD" and turns.count() == 0 and reports.first()["duplicate"] == 3


def test_empty(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert run(spark, []) .count() == 0
    reports, turns = C.repair(none)
    assert (reports.count(), turns.count()) == (0, 0)


def test_query_equals_its_sql(spark, sf_small):
    name = "op12_conversation_repair"
    got = queries.QUERIES[name](spark, sf_small).toPandas()
    assert compare(got, duck(sf_small).execute(queries.ORACLES[name]).df())["ok"]
