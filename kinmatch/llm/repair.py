"""Repair of conversation structure: the cheapest edits that make a conversation alternate properly.

Rows are shuffled once by conversation and streamed in turn order. The edits of a
conversation are found by dynamic programming over the four states of the pattern
``(s?(ua)+)?`` of role initials. What the programme knows after a row is, for each state,
its cost above the cheapest one and how the edits so far compare with those of the other states; after
dropping states that can no longer win, only a few dozen such situations exist. So a row
is one step of a small automaton (:class:`Machine`), a conversation of any length needs
the same memory, and of each row only the number of its step is kept to find the way back.
"""

from __future__ import annotations

import hashlib
import uuid
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import drop_file, get_file, make_folder, put_file

# Steps of one conversation held in memory; more are put into the shared folder.
HELD_STEPS = 1 << 20
RETAG, DELETE, INSERT, CUT = 3, 4, 3, 3

# States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
# What a state wants next, and the state after it.
WANTED = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
INITIALS = "sua "
LEGAL = {"su", "ua", "au"}
# What a row may be: fine, cut off, or to be deleted.
FINE, TRUNCATED, UNWANTED = range(3)


def _edits(state: int, initial: str, kind: int) -> Iterator[tuple[str, int, int]]:
    """``(edit, next state, cost)`` of one row."""
    yield "D", state, DELETE
    if kind == UNWANTED:
        return
    cut = CUT if kind == TRUNCATED else 0
    if (state, initial) in KEPT:
        yield "K", KEPT[state, initial], cut
    yield "R", WANTED[state][1], RETAG + cut


class Machine:
    """The dynamic programme as an automaton over (initial, kind) of rows, built as it is used.

    A situation holds for each state None, or its cost above the cheapest and its place
    in the ASCII order of the edits that lead to the states. After a row these edits
    all end in D, K or R, and different ones that have used as many rows at the same
    cost are never a prefix of one another, so places are all that later comparisons need.
    """

    def __init__(self):
        self.situations: dict[tuple, int] = {}
        self.steps: dict[tuple[int, int], int] = {}
        # per step: next situation, cost added, and per state reached (state, source, edits)
        self.found: list[tuple[int, int, tuple]] = []
        self.first = self._number(((0, 0), None, None, None))

    def _number(self, situation: tuple) -> int:
        return self.situations.setdefault(situation, len(self.situations))

    def step(self, situation: int, row: int) -> int:
        """The number of the step that a row, initial * 3 + kind, makes from a situation."""
        known = self.steps.get((situation, row))
        if known is None:
            known = self.steps[situation, row] = len(self.found)
            self.found.append(self._advance([*self.situations][situation], INITIALS[row // 3], row % 3))
        return known

    def _advance(self, situation: tuple, initial: str, kind: int) -> tuple[int, int, tuple]:
        best: dict[int, tuple] = {}
        for source, entry in enumerate(situation):
            if entry is None:
                continue
            cost, place = entry
            state, inserts = source, ""
            # a third insertion would only come back to the state after the first
            for _ in range(3):
                for edit, to, price in _edits(state, initial, kind):
                    way = (cost + price, place, inserts + edit, source)
                    best[to] = min(best.get(to, way), way)
                state, inserts, cost = WANTED[state][1], inserts + "I", cost + INSERT
        best = {s: way for s, way in best.items() if not self._beaten(s, best)}
        least = min(way[0] for way in best.values())
        order = sorted(best, key=lambda s: best[s][1:3])
        after = tuple((best[s][0] - least, order.index(s)) if s in best else None for s in range(4))
        return self._number(after), least, tuple((s, best[s][3], best[s][2]) for s in sorted(best))

    @staticmethod
    def _beaten(state: int, best: dict[int, tuple]) -> bool:
        """Whether another state surely ends cheaper: it can do the same from then on for this much more at most."""
        more = {
            (START, ASSISTANT): DELETE, (START, USER): DELETE + INSERT, (SYSTEM, ASSISTANT): 0, (SYSTEM, USER): INSERT,
            (USER, ASSISTANT): INSERT, (ASSISTANT, USER): INSERT,
        }
        return any(s == state and other in best and best[s][0] > best[other][0] + m for (s, other), m in more.items())

    def finish(self, situation: int) -> tuple[int, int, str]:
        """``(cost above the cheapest, state, insertions)`` of the best end."""
        ends = []
        for state, entry in enumerate([*self.situations][situation]):
            if entry is not None:
                inserts = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[state]
                ends.append((entry[0] + INSERT * inserts, entry[1], "I" * inserts, state))
        cost, _, inserts, state = min(ends)
        return cost, state, inserts


def _written(state: int, edits: str, role: str, text: str) -> bytes:
    """The rows that edits add to a repaired conversation, each after a line end."""
    out = []
    for edit in edits:
        if edit == "K":
            out.append(f"\n{role}:{text}")
        elif edit != "D":
            wanted, state = WANTED[state]
            out.append(f"\n{wanted}:{text if edit == 'R' else ''}")
    return "".join(out).encode()


class Conversation:
    """All that is known of one conversation while its rows come in; the same size at any length."""

    def __init__(self, machine: Machine, name: str | None, folder: str, held: int = HELD_STEPS):
        self.machine, self.name, self.folder, self.held = machine, name, folder, held
        self.situation, self.cost = machine.first, 0
        self.steps, self.spilled = array("I"), []
        # the repaired rows so far, for each state
        self.hashes = {START: None}
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.least = self.most = self.turn = None
        self.turns, self.initial = 0, None

    def add(self, turn: int | None, fault: str, role: str, text: str) -> None:
        if turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.most = self.turn = turn
            self.turns += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.initial = initial
        if fault:
            self.counts[fault] += 1
        kind = TRUNCATED if fault == "truncated" else UNWANTED if fault else FINE
        at = INITIALS.find(initial) if initial else 3
        step = self.machine.step(self.situation, (at if 0 <= at < 3 else 3) * 3 + kind)
        self.situation, cost, moves = self.machine.found[step]
        self.cost += cost
        hashes = {}
        for state, source, edits in moves:
            new = _written(source, edits, role, text)
            so_far = self.hashes[source]
            if new and so_far is None:
                hashes[state] = hashlib.sha256(new[1:])
            else:
                hashes[state] = so_far and so_far.copy()
                if new:
                    hashes[state].update(new)
        self.hashes = hashes
        self.steps.append(step)
        if len(self.steps) >= self.held:
            self.spilled.append(uuid.uuid4().hex)
            put_file(self.folder, self.spilled[-1], self.steps.tobytes())
            self.steps = array("I")

    def _way_back(self, state: int) -> Iterator[str]:
        """The edits of each row from the last to the first."""
        blocks = [self.steps]
        while blocks:
            for step in reversed(blocks.pop()):
                _, source, edits = next(m for m in self.machine.found[step][2] if m[0] == state)
                state = source
                yield edits
            if self.spilled:
                name = self.spilled.pop()
                blocks.append(array("I", get_file(self.folder, name)))
                drop_file(self.folder, name)

    def report(self) -> tuple:
        cost, state, inserts = self.machine.finish(self.situation)
        last = self.hashes[state]
        if inserts:
            new = _written(state, inserts, "", "")
            last = hashlib.sha256(new[1:]) if last is None else last
            if self.hashes[state] is not None:
                last.update(new)
        digest = (last or hashlib.sha256()).hexdigest()
        audit = "".join([*self._way_back(state)][::-1]) + inserts
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (self.name, gaps, *self.counts.values(), self.cost + cost, audit, digest)


def _trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows ``(conv, turn, role, text, there)`` with their fault, one conversation in one partition, in turn order.

    One shuffle, by conversation: the search for earlier equal rows and the order are two sorts within its partitions.
    """
    placed = rows.repartition("conv")
    alike = W.partitionBy("conv", "there", F.xxhash64("role", "text"), "role", "text").orderBy(F.asc_nulls_first("turn"))
    trimmed = _trimmed(F.col("text"))
    nth = placed.withColumn("nth", F.row_number().over(alike))
    fault = (
        F.when(trimmed == "", "blank").when(F.col("nth") > 1, "duplicate")
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "truncated").otherwise("")
    )
    return nth.withColumn("fault", fault).sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text", "nth")


def _named(rows: DataFrame, conv: str, turn: str, role: str, text: str, there: Column | None) -> DataFrame:
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), space(role).alias("role"), space(text).alias("text"),
        (F.lit(True) if there is None else there).alias("there"),
    )


REPORT = (
    "conv string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)


def repair_conversations(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    there: Column | None = None, held_steps: int = HELD_STEPS,
) -> DataFrame:
    """One row per conversation: its faults and the cheapest edits that give it role initials ``(s?(ua)+)?``.

    Columns: the conversation, ``gaps`` (turns missing between the first and the last), ``blank``,
    ``duplicate`` and ``truncated`` rows (the first that holds), ``illegal`` adjacent role initials, the ``cost`` of
    the edits, ``audit`` (their initials in order, the ASCII-least of the cheapest) and ``repaired_sha256`` (of
    the repaired ``role:text`` lines). Edits: Keep 0, Rerole to user or assistant 3,
    Delete 4, Insert an empty user or assistant row 3; a truncated row that stays adds 3; blank
    and duplicate rows must go. :func:`repaired_rows` applies an audit.

    Rows are taken by turn, NULL first, ties by role and text. A NULL role or text is one space. The
    rows of a NULL conversation are one conversation. Rows for which ``there`` is false only name their
    conversation; without others it has zeros, no edits and the hash of nothing. A
    conversation of any length is streamed through one task in bounded memory: the numbers of its
    steps go to the shared folder in blocks of ``held_steps``. Other columns are dropped;
    an empty table gives no row.
    """
    conv_type = rows.schema[conv].dataType
    folder = scratch_path(rows.sparkSession, "steps")
    make_folder(folder)
    ordered = _in_order(_named(rows, conv, turn, role, text, there)).select(
        F.col("conv").cast("string").alias("conv"), "there", F.coalesce("turn", F.lit(0)).alias("turn"),
        F.col("turn").isNotNull().alias("has_turn"), "fault", "role", "text",
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine, now, done = Machine(), None, []
        columns = ("conv", "there", "turn", "has_turn", "fault", "role", "text")
        names = [f.split()[0] for f in REPORT.split(", ")]
        for batch in batches:
            for name, there, turn, has_turn, fault, role, text in zip(*[batch[c].tolist() for c in columns]):
                if now is None or name != now.name:
                    if now is not None:
                        done.append(now.report())
                    now = Conversation(machine, name, folder, held_steps)
                if there:
                    now.add(turn if has_turn else None, fault, role, text)
            yield pd.DataFrame(done, columns=names)
            done = []
        if now is not None:
            yield pd.DataFrame([now.report()], columns=names)

    found = ordered.mapInPandas(run, schema=REPORT)
    return found.withColumn("conv", F.col("conv").cast(conv_type)).withColumnRenamed("conv", conv)


def repaired_rows(
    rows: DataFrame, reports: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    there: Column | None = None,
) -> DataFrame:
    """``(conv, place, role, text, edit)``: the rows of all conversations after the edits of ``reports``.

    Each audit is cut into the edits of one row each, which meet their row by its number; what
    comes in or changes its role follows from how many rows come before it. Takes the same rows as the reports did.
    """
    of_conv = W.partitionBy("conv")
    in_order = of_conv.orderBy(F.asc_nulls_first("turn"), "role", "text", "nth")
    numbered = _in_order(_named(rows, conv, turn, role, text, there)).where("there").withColumn("n", F.row_number().over(in_order))
    edits = F.regexp_extract_all(F.col("audit"), F.lit("I*[DKR]|I+$"), F.lit(0))
    steps = reports.select(F.col(conv).alias("conv"), F.posexplode(edits).alias("n", "edits"))
    steps = steps.select(F.col("conv").alias("of"), F.col("n") + 1, "edits").toDF("of", "at", "edits")
    # a step without a row holds the last insertions
    met = steps.join(numbered, F.col("of").eqNullSafe(F.col("conv")) & (F.col("at") == F.col("n")), "left")
    each = met.select("of", "at", "role", "text", F.posexplode(F.split("edits", "")).alias("k", "edit")).where("edit IN ('K', 'R', 'I')")
    place = F.row_number().over(W.partitionBy("of").orderBy("at", "k"))
    leads = F.max(F.when((F.col("place") == 1) & (F.col("edit") == "K") & F.startswith("role", F.lit("s")), 1).otherwise(0))
    placed = each.withColumn("place", place).withColumn("lead", leads.over(W.partitionBy("of")))
    wanted = F.when((F.col("place") - F.col("lead")) % 2 == 1, "user").otherwise("assistant")
    return placed.select(
        F.col("of").alias(conv), F.col("place").cast("bigint").alias("place"),
        F.when(F.col("edit") == "K", F.col("role")).otherwise(wanted).alias("role"),
        F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"), "edit",
    )


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """``conversations`` with a fault in one of four rows, told by crc32(``conv_id:turn``) % 20, and which rows are still there.

    0 drops the row, 1 empties its text, 2 takes ``.``, ``!`` and ``?`` from it, 3 repeats the row, 4 makes its role user. NULLs become one space.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    marked = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), fault.alias("h"))
    out = marked.select(
        "conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        "h", F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return out, F.col("h") != 0
