"""Repair of conversation structure by an auction for shortest paths over the lattice of edits.

A node of the lattice is a number of rows that are done and the state of the roles so far; an arc is an edit with an
integer cost. The auction holds a price per node, at first the cost that the remaining rows cannot avoid, and a path
from the start. At the path's end, the cheapest arc is the least cost plus price of the next node. Where that is more
than the node's own price, the price rises to it and the path gives up the node (contraction); otherwise the path takes
the arc (extension), of equal ones that of the least letter. Prices never exceed an arc's cost plus the next price, so
at the end they are dual to the path: its arcs are tight, every arc of any other cheapest path is tight as well, and
the path is the ASCII-least of them.

Rows are put in order over all conversations by ranges, and cut into segments of bounded size, so that a conversation
may be spread over many tasks. A conversation that is one segment is finished at once. For the others, each segment
tells the least cost between any two states; from the last segment backwards these give what the rest costs from each
state; then each segment is solved from each state, and a pass from the first segment on takes those that meet. Both
passes read their rows in order and hold one segment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.packs import arrow_schema
from pitwall.operators.hot import broadcast_if_small
from pitwall.session import materialise

DELETE, INSERT, REROLE, CUT = 3, 2, 2, 1
# Rows and text bytes of a segment.
SEGMENT_ROWS, SEGMENT_BYTES = 64, 1 << 20
# Characters of a row's role and text that the ranges look at.
RANGE_CHARS = 64

# States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
# The state that an inserted or reroled row leads to, and those that kept rows lead to.
GIVEN = (USER, USER, ASSISTANT, USER)
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
NAMES = {USER: "user", ASSISTANT: "assistant"}
REACHED = ((0, 1, 2, 3), (1, 2, 3), (2, 3), (2, 3))
# What inserts at the end cost from each state.
ENDS = (0, 2 * INSERT, INSERT, 0)
_NEVER = 1 << 60

_COUNTS = "rows long, blank long, duplicate long, truncated long, illegal long, turns long, least long, greatest long"
_PIECE = f"part int, seq long, conv_id long, {_COUNTS}, faults string, roles array<string>, texts array<string>, first_turn long, last_turn long"
_EDITED = (
    "conv_id long, part int, seq long, last boolean, turns array<struct<edit: string, role: string, text: string>>,"
    " gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, digest string"
)
_SEGMENT = f"{_PIECE}, costs array<long>, done struct<{_EDITED}>"
_REST = "part int, seq long, rest array<long>"
_SOLVED = f"{_PIECE}, paid array<long>, letters array<string>, states array<int>"


def auction(signs: list[str], faults: str, exits: list[int | None], entries: Iterable[int]) -> dict[int, tuple[int, str, int]]:
    """For each entry state: least cost, ASCII-least letters of that cost, and the state at the end.

    ``signs`` are the first letters of the rows' roles, ``faults`` b, d, t or a space for each; ``exits`` says what each
    state costs at the end, None where it must not be. Nothing is inserted after the last row.
    """
    n = len(signs)
    leads = [any(exits[r] is not None for r in REACHED[q]) for q in STATES]
    least = min(e for e in exits if e is not None)
    price = [0] * (4 * n + 4)
    for i in range(n, -1, -1):
        if i < n:
            least += DELETE if faults[i] in "bd" else CUT if faults[i] == "t" else 0
        price[4 * i : 4 * i + 4] = [least] * 4
    found = {}
    for entry in entries:
        path, letters = [entry], []
        while True:
            node = path[-1]
            i, state = divmod(node, 4)
            if i == n:
                value, letter, to = (_NEVER if exits[state] is None else exits[state]), "", -1
            else:
                value, letter, to = DELETE + price[node + 4], "D", node + 4
                given = GIVEN[state]
                if leads[given]:
                    if (cost := INSERT + price[4 * i + given]) < value:
                        value, letter, to = cost, "I", 4 * i + given
                fault = faults[i]
                if fault not in "bd":
                    cut = CUT if fault == "t" else 0
                    kept = KEPT[state].get(signs[i])
                    if kept is not None and leads[kept] and (cost := cut + price[4 * i + 4 + kept]) < value:
                        value, letter, to = cost, "K", 4 * i + 4 + kept
                    if leads[given] and (cost := REROLE + cut + price[4 * i + 4 + given]) < value:
                        value, letter, to = cost, "R", 4 * i + 4 + given
            if price[node] < value:
                price[node] = value
                if len(path) > 1:
                    path.pop()
                    letters.pop()
                elif value >= _NEVER:
                    raise ValueError("no edits lead to the wanted end")
            elif to < 0:
                found[entry] = price[entry], "".join(letters), state
                break
            else:
                path.append(to)
                letters.append(letter)
    return found


def costs_between(signs: list[str], faults: str) -> list[int]:
    """Least cost from each state to each state, row by row; very large where there is no way."""
    out = [_NEVER] * 16
    for to in STATES:
        entries = [q for q in STATES if to in REACHED[q] and (to != SYSTEM or q == SYSTEM or _has_system(signs, faults))]
        exits = [0 if q == to else None for q in STATES]
        for q, (cost, _, _) in auction(signs, faults, exits, entries).items():
            out[4 * q + to] = cost
    return out


def _has_system(signs: list[str], faults: str) -> bool:
    return any(s == "s" and f not in "bd" for s, f in zip(signs, faults, strict=True))


def edited(letters: str, state: int, roles: list[str], texts: list[str | None]) -> tuple[list[dict], int]:
    """The edits with the repaired rows, in order, and the state after them; a deleted row has neither role nor text."""
    out, i = [], 0
    for letter in letters:
        role, text = None, None
        if letter == "K":
            role, text, state = roles[i], texts[i], KEPT[state][roles[i][:1]]
        elif letter != "D":
            state = GIVEN[state]
            role, text = NAMES[state], "" if letter == "I" else texts[i]
        i += letter != "I"
        out.append({"edit": letter, "role": role, "text": text})
    return out, state


class _Digest:
    """SHA-256 of role:text lines, one at a time."""

    def __init__(self):
        self.sha, self.any = hashlib.sha256(), False

    def add(self, turns: list[dict]) -> None:
        for turn in turns:
            if turn["role"] is not None:
                self.sha.update(f"{chr(10) if self.any else ''}{turn['role']}:{turn['text']}".encode())
                self.any = True


def _legal(a: str, b: str) -> bool:
    return a[:1] + b[:1] in ("su", "ua", "au")


def _least(a: int | None, b: int | None, pick=min) -> int | None:
    return a if b is None else b if a is None else pick(a, b)


def _gaps(piece: dict) -> int:
    return 0 if piece["least"] is None else piece["greatest"] - piece["least"] + 1 - piece["turns"]


def _piece(part: int, seq: int, conv_id: int | None, rows: list[tuple]) -> dict:
    turns, roles, faults = [r[0] for r in rows], [r[1] for r in rows], "".join(r[3] for r in rows)
    known = [t for t in turns if t is not None]
    return {
        "part": part, "seq": seq, "conv_id": conv_id, "rows": len(rows),
        "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
        "illegal": sum(not _legal(a, b) for a, b in zip(roles[:-1], roles[1:], strict=True)),
        "turns": len(set(known)), "least": min(known, default=None), "greatest": max(known, default=None),
        "faults": faults, "roles": roles, "texts": [None if f in "bd" else r[2] for r, f in zip(rows, faults, strict=True)],
        "first_turn": turns[0], "last_turn": turns[-1], "costs": None, "done": None,
    }


def _signs(piece: dict) -> list[str]:
    return [role[:1] for role in piece["roles"]]


def _finish(piece: dict) -> dict:
    """The result of a conversation that is one segment."""
    cost, letters, state = auction(_signs(piece), piece["faults"], list(ENDS), [START])[START]
    letters += "I" * (ENDS[state] // INSERT)
    turns, _ = edited(letters, START, piece["roles"], piece["texts"])
    digest = _Digest()
    digest.add(turns)
    return {
        **{c: piece[c] for c in ("conv_id", "part", "seq", "blank", "duplicate", "truncated", "illegal")},
        "last": True, "turns": turns, "gaps": _gaps(piece), "cost": cost, "audit": letters, "digest": digest.sha.hexdigest(),
    }


def _records(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield from batch.slice(start, rows).to_pylist()


def _batches(records: Iterator[dict], schema: pa.Schema, rows: int = 256) -> Iterator[pa.RecordBatch]:
    held = []
    for record in records:
        held.append({name: record.get(name) for name in schema.names})
        if len(held) == rows:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _segments(schema: pa.Schema):
    """Segments of rows in order. A conversation at either end of a task's rows may go on in another task."""

    def pieces(batches):
        part, seq, now, first, rows, size = TaskContext.get().partitionId(), 0, None, True, [], 0
        opened = False  # whether ``rows`` begins its conversation, for certain
        for r in _records(batches):
            conv = (r["conv_id"],)
            if rows and (conv != now or len(rows) == SEGMENT_ROWS or size >= SEGMENT_BYTES):
                yield _piece(part, seq, now[0], rows), opened and conv != now
                seq, rows, size = seq + 1, [], 0
                opened = conv != now
            elif not rows:
                opened = not first
            now, first = conv, False
            rows.append((r["turn"], r["role"], r["text"], r["fault"]))
            size += len(r["text"])
        if rows:
            yield _piece(part, seq, now[0], rows), False

    def results(batches):
        for piece, whole in pieces(batches):
            if whole:
                done = _finish(piece)
                yield {"part": piece["part"], "seq": piece["seq"], "conv_id": piece["conv_id"], "done": done}
            else:
                yield {**piece, "costs": costs_between(_signs(piece), piece["faults"])}

    return lambda batches: _batches(results(batches), schema)


def _backwards(schema: pa.Schema):
    """What the rows after each segment cost from each state; segments come from the last to the first."""

    def results(batches):
        now, rest = None, None
        for r in _records(batches):
            if (r["conv_id"],) != now:
                now, rest = (r["conv_id"],), list(ENDS)
            yield {"part": r["part"], "seq": r["seq"], "rest": rest}
            rest = [min(r["costs"][4 * q + to] + rest[to] for to in STATES) for q in STATES]

    return lambda batches: _batches(results(batches), schema)


def _solve(schema: pa.Schema):
    """Each segment from each state, given what the rest costs."""

    def results(batches):
        for r in _records(batches, 16):
            found = auction(_signs(r), r["faults"], r["rest"], STATES)
            names = zip(("paid", "letters", "states"), zip(*(found[q] for q in STATES), strict=True), strict=True)
            yield {**r, **{name: list(values) for name, values in names}}

    return lambda batches: _batches(results(batches), schema, 16)


def _forwards(schema: pa.Schema):
    """The results along each conversation; segments come in order and the last one carries the totals."""

    def results(batches):
        total = held = None
        for r in _records(batches, 16):
            if held is not None and total["conv_id"] != r["conv_id"]:
                yield close(total, held)
                held = None
            if held is None:
                total = {**{c: 0 for c in ("blank", "duplicate", "truncated", "illegal", "turns")}, "conv_id": r["conv_id"]}
                total |= {"least": None, "greatest": None, "cost": r["paid"][START], "audit": [], "state": START, "digest": _Digest()}
                total |= {"role": None, "turn": None}
            else:
                yield held
            for c in ("blank", "duplicate", "truncated", "illegal", "turns"):
                total[c] += r[c]
            total["turns"] -= r["first_turn"] is not None and total["turn"] == r["first_turn"]
            total["illegal"] += total["role"] is not None and not _legal(total["role"], r["roles"][0])
            total["least"] = _least(total["least"], r["least"])
            total["greatest"] = _least(total["greatest"], r["greatest"], max)
            letters = r["letters"][total["state"]]
            turns, total["state"] = edited(letters, total["state"], r["roles"], r["texts"])
            total["digest"].add(turns)
            total["audit"].append(letters)
            total["role"], total["turn"] = r["roles"][-1], r["last_turn"]
            held = {"conv_id": r["conv_id"], "part": r["part"], "seq": r["seq"], "last": False, "turns": turns}
        if held is not None:
            yield close(total, held)

    def close(total, held):
        letters = "I" * (ENDS[total["state"]] // INSERT)
        more, _ = edited(letters, total["state"], [], [])
        total["digest"].add(more)
        return {
            **held, **{c: total[c] for c in ("blank", "duplicate", "truncated", "illegal", "cost")}, "last": True,
            "turns": held["turns"] + more, "gaps": _gaps(total), "audit": "".join(total["audit"]) + letters,
            "digest": total["digest"].sha.hexdigest(),
        }

    return lambda batches: _batches(results(batches), schema, 16)


def with_faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy, fault) of rows with conv_id, turn, role and text; equal rows get copy numbers.

    A fault is b (blank), d (same role and text in an earlier row), t (truncated) or a space. Only groups of rows that
    repeat are brought together, and equal rows of one turn are counted before.
    """
    rows = rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
    ).withColumn("_hash", F.sha2("text", 256))
    groups = rows.groupBy("conv_id", "role", "_hash").agg(F.count("*").alias("_many"), F.min(F.struct("turn")).alias("_first"))
    groups = groups.filter("_many > 1").select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("_hash").alias("_same"), "_first")
    groups = materialise(groups, "repeated_turns")
    keyed = broadcast_if_small(groups)
    match = rows["conv_id"].eqNullSafe(groups["_conv"]) & (rows["role"] == groups["_role"]) & (rows["_hash"] == groups["_same"])
    single = rows.join(keyed, match, "left_anti").select("conv_id", "turn", "role", "text", F.lit(0).cast("long").alias("copy"), F.lit(False).alias("again"))
    several = rows.join(keyed, match).groupBy("conv_id", "turn", "role", "text", "_first").agg(F.count("*").alias("_many"))
    several = several.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_many") - 1)))
    again = (F.col("copy") > 0) | (F.struct("turn") != F.col("_first"))
    several = several.select("conv_id", "turn", "role", "text", "copy", again.alias("again"))
    last = F.expr(r"right(rtrim(' \t\n\u000b\f\r', text), 1)")
    fault = (
        F.when(last == "", "b").when(F.col("again"), "d").when(~last.isin(".", "!", "?"), "t").otherwise(" ")
    )
    return single.unionByName(several).select("conv_id", "turn", "role", "text", "copy", fault.alias("fault"))


def repair(rows: DataFrame) -> DataFrame:
    """The repaired segments of conversations: conv_id, part, seq, last, turns; the last one of each carries the totals.

    ``rows`` has conv_id, turn, role and text; other columns are left alone. A conversation's rows stand by turn, nulls
    first, then role and text. Null roles and texts are one space. Blank rows and repeats are deleted for 3, others for
    3 as well; a row gets the role user or assistant for 2; an empty row of either role is inserted for 2; a truncated
    row that stays adds 1. The result alternates user and assistant, may begin with one system row, and ends with the
    assistant, or is empty. ``turns`` lists the edits (D, I, K, R) with role and text of what is kept. Totals: gaps in
    the turn numbers, rows by first fault, adjacent roles that must not meet, cost, audit (all letters), and the
    SHA-256 of the repaired rows. A null conv_id is a conversation. Empty tables give no segments.
    """
    ordered = with_faults(rows)
    front = lambda c: F.substring(c, 1, RANGE_CHARS)
    ordered = ordered.repartitionByRange("conv_id", "turn", front("role"), front("text"))
    ordered = ordered.sortWithinPartitions("conv_id", "turn", "role", "text", "copy").drop("copy")
    segments = materialise(ordered.mapInArrow(_segments(arrow_schema(_SEGMENT)), _SEGMENT), "segments")
    whole = segments.filter("done is not null").select("done.*")

    parted = segments.filter("done is null")
    back = parted.select("conv_id", "part", "seq", "costs").repartition("conv_id")
    back = back.sortWithinPartitions("conv_id", F.desc("part"), F.desc("seq"))
    rest = materialise(back.mapInArrow(_backwards(arrow_schema(_REST)), _REST), "rest_costs")
    solved = parted.drop("costs", "done").join(rest, ["part", "seq"]).mapInArrow(_solve(arrow_schema(_SOLVED)), _SOLVED)
    solved = solved.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return whole.unionByName(solved.mapInArrow(_forwards(arrow_schema(_EDITED)), _EDITED))


def repaired_rows(segments: DataFrame) -> DataFrame:
    """(conv_id, part, seq, at, role, text) of the rows that stay, in that order."""
    turns = segments.select("conv_id", "part", "seq", F.posexplode("turns").alias("at", "turn"))
    return turns.filter("turn.role is not null").select("conv_id", "part", "seq", "at", "turn.role", "turn.text")
