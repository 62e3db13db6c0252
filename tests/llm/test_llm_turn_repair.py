"""Operator 12: conversation repair against searches over whole edit strings."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

pytest.importorskip("pyarrow")
from herdfeed.llm.common import read_table
from herdfeed.llm.queries import queries
from herdfeed.llm.turn_repair import TurnRepair, fault_of, repair_report, repaired_turns
from conftest import SF_SMALL

GOOD = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """Fault of every ``(role, text)`` row, from its definition."""
    out, seen = [], set()
    for role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def outcomes(rows, found):
    """Every way to edit the rows, with at most two insertions in one place: (cost, audit, turns)."""
    def at_row(k):
        if k == len(rows):
            for n in range(3):
                for roles in itertools.product(("user", "assistant"), repeat=n):
                    yield 3 * n, "I" * n, [(r, "") for r in roles]
            return
        for n in range(3):
            for roles in itertools.product(("user", "assistant"), repeat=n):
                for rest in at_row(k + 1):
                    before = [(r, "") for r in roles]
                    yield 3 * n + 4 + rest[0], "I" * n + "D" + rest[1], before + rest[2]
                    if found[k] in ("blank", "duplicate"):
                        continue
                    more = 3 * n + 3 * (found[k] == "truncated") + rest[0]
                    yield more, "I" * n + "K" + rest[1], before + [rows[k]] + rest[2]
                    for role in ("user", "assistant"):
                        yield more + 3, "I" * n + "R" + rest[1], before + [(role, rows[k][1])] + rest[2]
    for cost, audit, turns in at_row(0):
        if GOOD.fullmatch("".join(r[:1] or "?" for r, _ in turns)):
            yield cost, audit, turns


def by_table(rows, found):
    """Cheapest edits by keeping the least complete string for each end of the repaired part."""
    best = {"": (0, "", [])}
    step = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    def inserted(table):
        out = dict(table)
        for _ in range(2):
            for end, (cost, audit, turns) in list(out.items()):
                role = step[end]
                new = (cost + 3, audit + "I", turns + [(role, "")])
                if role[0] not in out or new[:2] < out[role[0]][:2]:
                    out[role[0]] = new
        return out

    for (role, text), fault in zip(rows, found):
        then = {}
        # Insertions are tried one by one from every end, so that no cheaper end hides them.
        for end, start in best.items():
            for n in range(3):
                at, (cost, audit, turns) = end, start
                for _ in range(n):
                    cost, audit, turns, at = cost + 3, audit + "I", turns + [(step[at], "")], step[at][0]
                options = [(at, cost + 4, audit + "D", turns)]
                if fault not in ("blank", "duplicate"):
                    more = cost + 3 * (fault == "truncated")
                    first = role[:1]
                    if (first == "s" and at == "") or (first and first == step[at][0]):
                        options.append((first, more, audit + "K", turns + [(role, text)]))
                    options.append((step[at][0], more + 3, audit + "R", turns + [(step[at], text)]))
                for new, c, a, t in options:
                    if new not in then or (c, a) < then[new][:2]:
                        then[new] = (c, a, t)
        best = then
    closed = [(c + 3 * n, a + "I" * n, t + [("user", ""), ("assistant", "")][2 - n:]) for end, (c, a, t) in best.items()
              for n in [{"": 0, "s": 2, "u": 1, "a": 0}[end]]]
    return min(closed)


def own(rows, found):
    turns, audit = [], []

    def take(edit, row, role, text):
        audit.append(edit)
        if edit != "D":
            turns.append((role, text))

    repair = TurnRepair(take)
    for (role, text), fault in zip(rows, found):
        repair.add(role, text, fault)
    return repair.finish(), "".join(audit), turns


ROLES = ["system", "user", "assistant", "tool", " ", ""]
TEXTS = ["Yes.", "No!", "open", "", " \n", "x y?", "é"]


def some_rows(rng, n):
    return [(rng.choice(ROLES[:rng.choice((3, 3, 6))]), rng.choice(TEXTS)) for _ in range(n)]


@pytest.mark.parametrize("seed", range(40))
def test_cheapest_and_least_of_all_edits(seed):
    rng = random.Random(seed)
    rows = some_rows(rng, seed % 5)
    found = faults(rows)
    assert found == [fault_of(t, (r, t) in rows[:k]) for k, (r, t) in enumerate(rows)]
    assert own(rows, found) == min(outcomes(rows, found)) == by_table(rows, found)


@pytest.mark.parametrize("seed", range(300))
def test_long_conversations_against_complete_strings(seed):
    rng = random.Random(seed)
    kind = seed % 3
    n = rng.randint(0, 60)
    rows = some_rows(rng, n) if kind == 0 else [(rng.choice(("user", "assistant")), f"t{k}.") for k in range(n)] if kind == 1 else [("user", f"t{k}" + rng.choice(("", "."))) for k in range(n)]
    found = faults(rows)
    assert own(rows, found) == by_table(rows, found)


@pytest.mark.parametrize("rows", [
    [(("user", "assistant")[k % 2], f"t{k}.") for k in range(3000)],
    [("user", "") for _ in range(3000)],
    [("system", f"t{k}") for k in range(3000)],
    [(("user", "user", "assistant", "tool")[k * k % 7 % 4], f"t{k}" + ".!x"[k % 3]) for k in range(3000)],
])
def test_memory_holds_only_undecided_rows(rows):
    most, emitted = 0, []
    repair = TurnRepair(lambda edit, *a: emitted.append(edit))
    for role, text in rows:
        repair.add(role, text, fault_of(text, False))
        most = max(most, len(repair.waiting))
    repair.finish()
    assert most <= 8 and len(emitted) >= len(rows)


def reference_report(rows):
    """``{conv_id: report}`` of ``(conv_id, turn, role, text, live)`` rows."""
    held = defaultdict(list)
    for conv_id, turn, role, text, live in rows:
        held[conv_id] += [(turn, " " if role is None else role, " " if text is None else text)] if live else []
    out = {}
    for conv_id, own_rows in held.items():
        own_rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        pairs = [(r, t) for _, r, t in own_rows]
        found = faults(pairs)
        turns = [t for t, _, _ in own_rows if t is not None]
        cost, audit, repaired = by_table(pairs, found)
        initials = [r[:1] for r, _ in pairs]
        out[conv_id] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(found.count(x) for x in ("blank", "duplicate", "truncated")),
                        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest())
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def report(df):
    rows = df.select(COLUMNS).collect()
    out = {r[0]: tuple(r[1:]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_on_the_whole_table(spark):
    rows = []
    for conv_id, turn, role, text in read_table(spark, SF_SMALL, "conversations").select("conv_id", "turn", "role", "text").collect():
        kind = zlib.crc32(f"{conv_id}:{turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(conv_id, turn, "user" if kind == 4 else role, text, kind != 0)] * (2 if kind == 3 else 1)
    assert report(queries()["op12_turn_repair"](spark, SF_SMALL)) == reference_report(rows)


ODD = [(1, 0, "user", "Hi.", True), (1, 1, "assistant", "Yes.", True), (1, 1, "assistant", "Yes.", True), (1, None, "system", "S.", True), (1, None, None, "S.", True),
       (2, 5, "user", None, True), (2, 9, None, None, True), (3, 0, "user", "gone", False), (None, 3, "tool", "a. ", True), (None, 1, "", "b", True),
       (4, 2, "user", "long " * 40_000 + ".", True), (4, 2, "user", "long " * 40_000 + ".", True), (5, 7, "assistant", "\x1f", True), (1, 0, "user", "Hi.", True)]


def odd(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, live boolean")
    return df.withColumns({c: F.lit("x") for c in ("seen", "audit", "cost", "place", "edit", "copy")})


def test_odd_rows(spark):
    from pyspark.sql import functions as F

    got = report(repair_report(odd(spark, ODD), live=F.col("live")))
    assert got == reference_report(ODD)
    assert got[3] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert report(repair_report(odd(spark, ODD))) == reference_report([(*r[:4], True) for r in ODD])
    assert repair_report(odd(spark, []), live=F.col("live")).collect() == []


def test_repaired_turns_are_the_report_s(spark):
    from pyspark.sql import functions as F

    edits = defaultdict(list)
    for r in repaired_turns(odd(spark, ODD), live=F.col("live")).collect():
        edits[r.conv_id].append(r)
    for conv_id, (*_, audit, digest) in reference_report(ODD).items():
        rows = edits[conv_id]
        assert "".join(r.edit for r in rows) == audit
        kept = [r for r in rows if r.edit != "D"]
        assert [r.place for r in kept] == list(range(len(kept)))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in kept).encode()).hexdigest() == digest
        assert GOOD.fullmatch("".join(r.role[0] for r in kept))
    assert repaired_turns(odd(spark, [])).collect() == []


def test_shuffles_once(spark):
    plan = queries()["op12_turn_repair"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
