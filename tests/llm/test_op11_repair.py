import hashlib
import heapq
import random
import re
import zlib

import pytest

from tessera.llm import conversation_repair as cr

#: A plain automaton of (s?(ua)+)?: state, role initial, next state.
DFA = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "e", ("e", "u"): "u"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        words = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not words else "duplicate" if (role, text) in seen else None if words[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, fault):
    """Dijkstra over (rows done, automaton state) by (cost, audit), without a bound on anything."""
    heap, done = [(0, "", 0, "0", ())], set()
    while heap:
        cost, audit, i, q, lines = heapq.heappop(heap)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == len(rows) and q in "0e":
            return cost, audit, lines
        moves = [(5, "I", i, x, ("user" if x == "u" else "assistant", "")) for x in "ua"]
        if i < len(rows):
            _, role, text = rows[i]
            moves.append((2, "D", i + 1, None, None))
            if fault[i] not in ("blank", "duplicate"):
                more = 5 * (fault[i] == "truncated")
                moves.append((more, "K", i + 1, role[:1], (role, text)))
                moves += [(1 + more, "R", i + 1, x, ("user" if x == "u" else "assistant", text)) for x in "ua"]
        for price, edit, j, token, line in moves:
            to = q if token is None else DFA.get((q, token))
            if to:
                heapq.heappush(heap, (cost + price, audit + edit, j, to, lines + ((line,) if line else ())))


def brute(rows):
    """Of one conversation's rows after damage: (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    fault = faults(rows)
    cost, audit, lines = cheapest(rows, fault)
    turns = [t for t, *_ in rows if t is not None]
    initials = "".join(role[:1] for role, _ in lines)
    assert re.fullmatch("(s?(ua)+)?", initials)
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **{k: fault.count(k) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()}


def some(rnd, n):
    return [(rnd.choice([None, *range(12)]), rnd.choice(["user", "assistant", "system", "user", "assistant", "tool", " ", ""]),
             rnd.choice(["", " \n", "Yes.", "no", "So? ", f"{rnd.random()}!", f"{rnd.random()}", "　"])) for _ in range(n)]


def parsed(rows, conv="c"):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    parse, out = cr.Parse(conv), []
    for (turn, role, text), fault in zip(ordered, faults(ordered)):
        out += parse.row(turn, role, text, fault)
    return out + parse.end()


def test_least_cost_and_least_audit():
    rnd = random.Random(3)
    for i in range(1500):
        rows = some(rnd, i % 14)
        want = brute(rows)
        got = parsed(rows)
        assert ("".join(r[2] for r in got), sum(r[6] for r in got)) == (want["audit"], want["cost"]), rows
        kept = [r for r in got if r[2] != "D"]
        assert hashlib.sha256("\n".join(f"{r[7]}:{r[8]}" for r in kept).encode()).hexdigest() == want["repaired_sha256"]


def test_stacks_are_shared():
    """Equal stacks are one node, so that the graph is finite however long the conversation."""
    a = cr.step(cr.step(cr.START, "u"), "a")
    assert cr.step(cr.step(a, "u"), "a") is a and a.below is cr.START
    assert cr.step(cr.step(cr.step(cr.START, "s"), "u"), "a") is a
    assert cr.step(cr.START, "a") is None and cr.step(a, "s") is None


def test_long_conversation_is_settled_on_the_way():
    rnd = random.Random(1)
    parse, held = cr.Parse("c"), 0
    for i in range(30_000):
        role = rnd.choice(["user", "assistant"])
        parse.row(i, role, f"text {i}.", None if rnd.random() < .9 else "truncated")
        held = max(held, len(parse.rows))
    parse.end()
    assert held < 500


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(8)
    out = [(c, *r) for c in [None, *range(60)] for r in some(rnd, rnd.randrange(9))]
    out += [(900, i, "user" if i % 2 else "assistant", f"turn {i}." if i % 7 else "cut") for i in range(3000)]
    return out + out[5:9]


def test_spark(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, step int, edit string").repartition(7)
    got = {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"}
           for r in cr.summaries(cr.repair(cr.damage(df))).collect()}
    convs = {}
    for conv, *r in damaged(rows):
        convs.setdefault(None if conv is None else str(conv), []).append(tuple(r))
    assert got.keys() == convs.keys()
    for conv, rs in convs.items():
        assert got[conv] == brute(rs), conv


def test_one_exchange(spark):
    df = spark.createDataFrame([(1, 0, "user", "a.")], "conv_id long, turn long, role string, text string")
    plan = cr.summaries(cr.repair(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.repair(df).count() == 0 and cr.summaries(cr.repair(df)).count() == 0
