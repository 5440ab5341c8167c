"""Repair of the structure of conversations at least cost.

A repaired conversation is empty, or an optional system turn and then pairs of a user's and an assistant's turn. Going through
its rows, one can keep a row, give it the role user or assistant, delete it, or insert an empty turn of a user or an assistant
anywhere. These edits are the edges of a DAG whose nodes are (rows done, what the next turn must be).

One integer is a path's weight: its high digits are the cost, its low digits, as many as the longest path has edits, spell the
audit letters from the highest place on, with zeros after the last one. So the smaller integer is the cheaper path, and of
equally cheap ones the path whose letters come first in ASCII order; an ordinary minimum decides everything. Paths are built from
their ends: an edit in front moves the letters by one place and adds its cost.

A conversation is one record: its rows meet in one task, and its audit is one string. Rows go by turn (null first), then role
and text, so that ties have one order. Null roles and texts count as empty; rows that repeat an earlier role and text are
duplicates. Rows with a null id are a conversation of their own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"
STOPS = ".!?"
#: Digits of the audit letters, in their ASCII order; 0 is the padding.
DIGITS = {"D": 1, "I": 2, "K": 3, "R": 4}
_DIGIT_BITS = 3

#: What was written last decides which turn may follow: nothing yet, system, user, assistant. The last of these steps are those
#: of an inserted or reroled turn.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
_NEXT = {START: ("user", AFTER_USER), AFTER_SYSTEM: ("user", AFTER_USER), AFTER_USER: ("assistant", AFTER_ASSISTANT), AFTER_ASSISTANT: ("user", AFTER_USER)}
_KEPT = {(START, "s"): AFTER_SYSTEM, **{(s, role[0]): to for s, (role, to) in _NEXT.items()}}
_LEGAL = {"su", "ua", "au"}


@dataclass(frozen=True)
class Repair:
    cost: int
    audit: str
    turns: list[tuple[str, str]]


def faults(rows: list[tuple[str, str]]) -> list[str]:
    """First fault of every row (role, text): blank, duplicate, truncated, or an empty string."""
    seen: set[tuple[str, str]] = set()
    out = []
    for role, text in rows:
        body = text.rstrip(SPACE)
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if body[-1] in STOPS else "truncated")
        seen.add((role, text))
    return out


def repair(rows: list[tuple[str, str]], found: list[str]) -> Repair:
    """The cheapest edits of rows (role, text) with their faults; ties go to the letters that come first in ASCII order."""
    places = 3 * len(rows) + 2  # never more than two inserted turns in a row are of use
    bits = _DIGIT_BITS * places
    low, far = (1 << bits) - 1, 1 << (bits + 62)

    def before(letter: str, cost: int, rest: int) -> int:
        return ((rest >> bits) + cost << bits) | DIGITS[letter] << (bits - _DIGIT_BITS) | (rest & low) >> _DIGIT_BITS

    def with_inserts(best: list[int], act: list[tuple]) -> None:
        for _ in range(2):
            for state, (role, to) in _NEXT.items():
                weight = before("I", INSERT, best[to]) if best[to] < far else far
                if weight < best[state]:
                    best[state], act[state] = weight, ("I", role, to)

    best, act = [0, far, far, 0], [()] * 4
    with_inserts(best, act)
    acts = [act]
    for (role, _), fault in zip(reversed(rows), reversed(found)):
        then, best, act = best, [far] * 4, [()] * 4
        late = TRUNCATED if fault == "truncated" else 0
        for state, (turn, to) in _NEXT.items():
            choices = [(before("D", DELETE, then[state]), ("D", "", state))] if then[state] < far else []
            if fault not in ("blank", "duplicate"):
                kept = _KEPT.get((state, role[:1]))
                if kept is not None and then[kept] < far:
                    choices.append((before("K", KEEP + late, then[kept]), ("K", role, kept)))
                if then[to] < far:
                    choices.append((before("R", REROLE + late, then[to]), ("R", turn, to)))
            if choices:
                best[state], act[state] = min(choices)
        with_inserts(best, act)
        acts.append(act)
    acts.reverse()
    letters, turns, state, at = [], [], START, 0
    while act := acts[at][state]:
        letter, role, state = act
        letters.append(letter)
        if letter != "D":
            turns.append((role, "" if letter == "I" else rows[at][1]))
        at += letter != "I"
    return Repair(best[START] >> bits, "".join(letters), turns)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])


def _report(turns: list, rows: list[tuple[str, str]]) -> tuple:
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    found = faults(rows)
    initials = [role[:1] for role, _ in rows]
    illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
    done = repair(rows, found)
    return gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, done.cost, done.audit, done.turns


def repair_conversations(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: its id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired (its turns: role, text)."""
    kind = rows.schema[conv].dataType.simpleString()
    at = F.col(turn).cast("long")
    one = F.struct(at.isNotNull().alias("has"), at.alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    whole = rows.groupBy(F.col(conv).alias("conv")).agg(F.sort_array(F.collect_list(one)).alias("rows"))

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for r in batch.column("rows").to_pylist():
                out.append(_report([x["turn"] for x in r], [(x["role"], x["text"]) for x in r]))
            counts = [pa.array([r[i] for r in out], pa.int64()) for i in range(len(_COUNTS))]
            turns = pa.array([[{"role": a, "text": b} for a, b in r[7]] for r in out], pa.list_(_TURN))
            yield pa.RecordBatch.from_arrays([batch.column("conv"), *counts, pa.array([r[6] for r in out], pa.string()), turns], ["conv", *_COUNTS, "audit", "repaired"])

    kinds = f"conv {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, audit string, repaired array<struct<role: string, text: string>>"
    return whole.mapInArrow(run, kinds).withColumnRenamed("conv", conv)
