import hashlib
import itertools
import random
import re
import zlib

import pytest

from llm_data import SMALL
from pyspark.sql import types as T
from tidepool.llm import repair
from tidepool.llm.queries import QUERIES

TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
BLANK = re.compile("[^\x20\x09-\x0D]")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def damage(rows):
    """conv_id -> rows after the damage."""
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        case = zlib.crc32(key.encode()) % 20
        if case == 0:
            continue
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        role = "user" if case == 4 else role
        mine += [(turn, role, text)] * (2 if case == 3 else 1)
    return out


def brute(rows):
    """Least cost and ASCII-least edits by a table over all rows and places,
    whole edit strings kept."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
        fault = "blank" if not BLANK.search(text) else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    # best[state]: (cost, edits, lines); states: "", "s", "u", "a" (last initial)
    steps = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def inserts(table):
        for _ in range(4):
            for state, (cost, edits, lines) in list(table.items()):
                for role in ("user", "assistant"):
                    if role[0] in steps[state]:
                        new = (cost + 2, edits + "I", (*lines, role + ":"))
                        if role[0] not in table or new[:2] < table[role[0]][:2]:
                            table[role[0]] = new
        return table

    for (_, role, text), fault in zip(rows, faults):
        now = {}

        def offer(state, entry):
            if state not in now or entry[:2] < now[state][:2]:
                now[state] = entry

        for state, (cost, edits, lines) in inserts(best).items():
            offer(state, (cost + 3, edits + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = fault == "truncated"
            if role[:1] and role[:1] in steps[state]:
                offer(role[0], (cost + extra, edits + "K", (*lines, f"{role}:{text}")))
            for new in ("user", "assistant"):
                if new[0] in steps[state]:
                    offer(new[0], (cost + 2 + extra, edits + "R", (*lines, f"{new}:{text}")))
        best = now
    cost, edits, lines = min((best := inserts(best))[s][:3] for s in ("", "a") if s in best)
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, edits, sha("\n".join(lines))


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def answer(df):
    return {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in df.collect()}


def made(seed, convs, longest):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(r.randint(1, longest)):
            if r.random() < 0.05:
                continue
            turn = None if r.random() < 0.03 else t
            text = r.choice([None, "", " \n", "yes.", "no", "why? ", f"text {t}.", f"text {t}", f"word {r.randint(0, 9)}!\n"])
            rows.append((c if c else None, turn, r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]), text))
    return rows


def test_cost_and_edits_against_all_edit_sequences():
    symbols = ["u", "U", "a", "A", "s", "S", "o", "O", repair.GONE]
    for n in range(4):
        for syms in itertools.product(symbols, repeat=n):
            rows = [(k, {"u": "user", "a": "assistant", "s": "system", "o": "tool"}.get(s.lower(), "x"), "" if s == repair.GONE else f"{k}" + ("" if s.isupper() else "."))
                    for k, s in enumerate(syms)]
            cost, found = repair.solve([(s, 1) for s in syms])
            assert (cost, "".join(e for e, _ in found)) == brute(rows)[5:7], syms


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 5000])
def test_runs_equal_single_rows(n):
    for syms in itertools.product("uaUo" + repair.GONE, repeat=2):
        runs = [(syms[0], n), (syms[1], 3)]
        single = [(s, 1) for s, k in runs for _ in range(k)]
        assert repair.solve(runs)[0] == repair.solve(single)[0]
        assert "".join(e for e, _ in repair.solve(runs)[1]) == "".join(e for e, _ in repair.solve(single)[1])


def test_damaged_conversations_against_brute_force(spark):
    rows = made(1, 150, 9)
    want = {c: brute(x) for c, x in damage(rows).items()}
    assert answer(repair.repair_report(spark.createDataFrame(rows, TURNS))) == want


def test_long_conversations_go_on_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK_ROWS", 16)
    rows = made(2, 3, 900) + made(3, 1, 700)
    rows = [r if k % 5 else (7, k, "user", "the same.") for k, r in enumerate(rows)]
    want = {c: brute(x) for c, x in damage(rows).items()}
    df = spark.createDataFrame(rows, TURNS).repartition(7)
    assert answer(repair.repair_report(df)) == want


def test_clashing_columns_repeats_and_empty_table(spark):
    rows = [(1, 0, "user", "hi."), (1, 1, "assistant", "ho.")]
    df = spark.createDataFrame(rows * 3, TURNS).selectExpr("*", "1 AS part", "'x' AS chunk", "2 AS _copies", "3 AS marker")
    assert answer(repair.repair_report(df)) == {1: brute(damage(rows * 3)[1])}
    assert repair.repair_report(spark.createDataFrame([], TURNS)).collect() == []


def test_general_interface_keeps_whole_conversations(spark):
    rows = [(5, 0, "user", "hi."), (5, 1, "assistant", "ho.")]
    got = repair.repair(spark.createDataFrame(rows, TURNS)).collect()[0]
    assert (got["cost"], got["audit"], got["repaired_sha256"]) == (0, "KK", sha("user:hi.\nassistant:ho."))


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert answer(QUERIES["op11_repair"](spark, SMALL)) == {c: brute(x) for c, x in damage(rows).items()}
