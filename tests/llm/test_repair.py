import hashlib
import itertools
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinmatch.llm.common import get_file, make_folder, table
from kinmatch.llm.queries import QUERIES
from kinmatch.llm.repair import Conversation, Machine, damaged, repair_conversations, repaired_rows

MACHINE = Machine()
BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def faults(rows):
    """The first fault of each row, written down from the rules."""
    out = []
    for k, (role, text) in enumerate(rows):
        end = text.rstrip(BLANKS)
        out.append(
            "blank" if not end else "duplicate" if (role, text) in rows[:k] else "truncated" if end[-1] not in ".!?" else ""
        )
    return out


def applied(rows, marks, audit):
    """Cost and result of edits, or None if they are not allowed or leave wrong roles."""
    cost, out, k = 0, [], 0
    for edit in audit:
        # what comes in or changes its role is whatever fits there
        fits = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if edit == "I":
            cost, out = cost + 3, [*out, (fits, "")]
            continue
        if k == len(rows):
            return None
        (role, text), mark, k = rows[k], marks[k], k + 1
        if edit == "D":
            cost += 4
            continue
        if mark in ("blank", "duplicate"):
            return None
        cost += 3 * (mark == "truncated") + 3 * (edit == "R")
        out.append((fits if edit == "R" else role, text))
    initials = "".join((role[:1] or "-") for role, _ in out)
    return (cost, out) if k == len(rows) and re.fullmatch("(s?(ua)+)?", initials) else None


def brute(rows):
    """The cheapest, ASCII-least of all edits with up to two insertions before each row and at the end."""
    marks, best = faults(rows), None
    for edits in itertools.product("DKR", repeat=len(rows)):
        for inserts in itertools.product(("", "I", "II"), repeat=len(rows) + 1):
            audit = "".join(i + e for i, e in zip(inserts, [*edits, ""]))
            found = applied(rows, marks, audit)
            if found and (best is None or (found[0], audit) < best[:2]):
                best = (found[0], audit, found[1])
    return best


def by_suffixes(rows):
    """The same by costs of what is left, from the last row to the first; no limit on the rows."""
    marks = faults(rows)
    nothing, system, user, assistant = range(4)
    inserted = {nothing: user, system: user, user: assistant, assistant: user}
    kept = {(nothing, "s"): system, (nothing, "u"): user, (system, "u"): user, (user, "a"): assistant, (assistant, "u"): user}
    left = [{nothing: (0, ""), assistant: (0, ""), user: (3, "I"), system: (6, "II")}]
    for (role, _), mark in zip(rows[::-1], marks[::-1]):
        after, now = left[-1], {}
        for state in range(4):
            ways = []
            for inserts in ("", "I", "II"):
                at, cost = state, 3 * len(inserts)
                for _ in inserts:
                    at = inserted[at]
                for edit in "DKR":
                    to = at if edit == "D" else inserted[at] if edit == "R" else kept.get((at, role[:1]))
                    if to is None or edit != "D" and mark in ("blank", "duplicate"):
                        continue
                    price = 4 if edit == "D" else 3 * (edit == "R") + 3 * (mark == "truncated")
                    ways.append((cost + price + after[to][0], inserts + edit + after[to][1]))
            now[state] = min(ways)
        left.append(now)
    cost, audit = left[-1][nothing]
    return cost, audit, applied(rows, marks, audit)[1]


def streamed(rows, folder="", held=1 << 20):
    now = Conversation(MACHINE, "c", folder, held)
    for k, ((role, text), mark) in enumerate(zip(rows, faults(rows))):
        now.add(k, mark, role, text)
    return now.report()


def check(rows, want, report):
    cost, audit, out = want
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    assert report[-3:] == (cost, audit, digest), (rows, audit, report)


roles = st.sampled_from(["user", "assistant", "system", "tool", "u", "", " "])
texts = st.sampled_from(["a.", "b!", "c?", "d", "e", "", " \n", "f. "])


@given(st.lists(st.tuples(roles, texts), max_size=4))
@settings(max_examples=150, deadline=None)
def test_against_all_edits(rows):
    want = brute(rows)
    check(rows, want, streamed(rows))
    assert by_suffixes(rows) == want


@given(st.lists(st.tuples(roles, st.sampled_from(["a.", "d", ""]) | st.integers(0, 99).map(lambda i: f"{i}.")), max_size=60))
@settings(max_examples=400, deadline=None)
def test_long_ones_against_the_costs_of_suffixes(rows):
    check(rows, by_suffixes(rows), streamed(rows))


def test_few_situations_whatever_comes():
    for k in range(30_000):
        row = zlib.crc32(str(k).encode()) % 12
        MACHINE.step(k % len(MACHINE.situations), row)
    assert len(MACHINE.situations) < 200


def test_steps_in_the_shared_folder(tmp_path):
    rows = [(("user", "assistant", "tool")[zlib.crc32(b"%d" % k) % 3], f"{k}.") for k in range(5_000)]
    make_folder(str(tmp_path / "steps"))
    check(rows, by_suffixes(rows), streamed(rows, str(tmp_path / "steps"), 64))
    assert not [*(tmp_path / "steps").iterdir()]
    with pytest.raises(FileNotFoundError):
        get_file(str(tmp_path / "steps"), "none")


def expected(table_rows):
    """Reports of all conversations by plain rules."""
    kept = {}
    for conv, turn, role, text in table_rows:
        rows = kept.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        rows += [(turn, "user" if h == 4 else role, text)] * {0: 0, 3: 2}.get(h, 1)
    out = {}
    for conv, rows in kept.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [r[0] for r in rows if r[0] is not None]
        rows = [r[1:] for r in rows]
        marks = faults(rows)
        initials = [r[0][:1] for r in rows]
        cost, audit, repaired = by_suffixes(rows)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out[conv] = (
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[marks.count(m) for m in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, digest,
        ), repaired
    return out


def awkward():
    rows = [(c, t, ("user", "assistant")[t % 2], f"Line {c} {t}{'.!?x'[t % 4]}") for c in range(30) for t in range(c % 9)]
    rows += [(40, None, "user", "no turn."), (40, None, None, None), (40, 3, "tool", "x."), (40, 3, "tool", "x."), (40, 9, "", "y")]
    rows += [(None, 0, "user", "A."), (None, 1, "assistant", "B."), (None, None, "system", " ")]
    rows += [(50, t, "user", "again.") for t in range(200)] + [(51, 7, "assistant", "long " * 40_000)]
    # all rows of these are dropped
    gone = [c for c in range(1_000, 2_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    return rows + [(c, 0, "user", "x.") for c in gone]


@pytest.mark.parametrize("held", [1 << 20, 7])
def test_rows_of_every_kind(spark, held):
    rows = awkward()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({n: F.lit("x") for n in ("conv", "there", "nth", "h", "fault")})
    broken, there = damaged(df)
    reports = repair_conversations(broken, there=there, held_steps=held)
    want = expected(rows)
    assert {r[0]: tuple(r) for r in reports.collect()} == {c: w for c, (w, _) in want.items()}
    if held > 7:
        out = {}
        for r in repaired_rows(broken, reports, there=there).orderBy("conv_id", "place").collect():
            out.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
        assert out == {c: w for c, (_, w) in want.items() if w}


def test_an_empty_table_and_one_shuffle(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert repair_conversations(df).count() == 0
    rows = spark.createDataFrame(awkward(), SCHEMA)
    plan = repair_conversations(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "MapInPandas" in plan


def test_query_against_plain_rules(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r) for r in QUERIES["op13_repair"](spark, sf).collect()}
    assert got == {c: w for c, (w, _) in expected(rows).items()}
