"""Repair of conversations: the cheapest edits that make the roles alternate, found with checkpoints instead of a full table.

Every row is kept (0), given the other role (3), or deleted (4, a must for blank rows and repeats); empty turns can be inserted anywhere (3), and
a truncated row costs 3 unless it is deleted.  What remains must read ``(s?(ua)+)?`` in initials of the roles, an automaton of four states.  Among the
cheapest edits the least string of initials (D, I, K, R) is taken.

The programme runs backward over the rows and keeps the vector of costs still to come, one number for each state, only at checkpoints about
a square root of the rows apart.  Walking forward, the vectors of one stretch at a time are computed again from the
checkpoint behind it, and the least tight edit is emitted.  The same holds between tasks: rows are sorted by conversation and
turn over all partitions, so a long conversation lies in several; it is cut into pieces of about ``piece_rows`` rows or
``PIECE_BYTES`` of text.  A piece that is no whole conversation is summed up by its costs from each state to each state; these are strung
together backward into one checkpoint for each piece and forward into the state it starts from, both as streams that hold one piece at a time.

Defined results: rows are taken by turn (NULL first), then role, then digest of the text; equal rows lie side by side and all but the first are repeats.
A NULL role or text is one space; NULL conversations belong together; extra columns are ignored.  A table without rows gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymart.llm.tables import written

PIECE_ROWS, PIECE_BYTES, FLUSH_BYTES = 4096, 16 << 20, 8 << 20
BLANKS = " \t\n\x0b\x0c\r"
DELETE, CUT = 4, 3  # costs of a deletion and of leaving a truncated row
PUT = 3  # cost of an insertion or a change of role

#: States: nothing yet, after system, after user, after assistant.  The role that a change or an insertion gives is the one that may follow.
STEP = (2, 2, 3, 2)
GIVEN = ("user", "user", "assistant", "user")
KEEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "": (None, None, None, None)}
LEGAL = {"su", "ua", "au"}
AT_END = (0, 2 * PUT, PUT, 0)
#: A kind of row: its role, and whether it must go or is truncated.
ROLES = "sua"
GONE, SHORT, WELL = 0, 1, 2


def kind(initial: str, fault: int) -> int:
    return ((ROLES.index(initial) if initial and initial in ROLES else 3) * 3) + fault


def _read(code: int) -> tuple[tuple, int]:
    return KEEP[(*ROLES, "")[code // 3]], code % 3


KINDS = [_read(code) for code in range(12)]


def before(code: int, after: tuple) -> tuple:
    """Costs to come before a row, from the costs after it; insertions before the row are counted."""
    keep, fault = KINDS[code]
    if fault == GONE:
        return tuple(DELETE + v for v in after)
    extra = CUT if fault == SHORT else 0
    best = []
    for state in range(4):
        cost = min(DELETE + after[state], PUT + extra + after[STEP[state]])
        if keep[state] is not None:
            cost = min(cost, extra + after[keep[state]])
        best.append(cost)
    user, assistant = min(best[2], PUT + best[3]), min(best[3], PUT + best[2])
    return min(best[0], PUT + user), min(best[1], PUT + user), user, assistant


def start(kinds: bytes, end: tuple) -> tuple:
    """Costs to come before all rows."""
    for code in reversed(kinds):
        end = before(code, end)
    return end


def between(kinds: bytes) -> list[int]:
    """Least costs from each state before the rows to each state after them, row by row; a large number where there is no way."""
    never = 1 << 60
    columns = [start(kinds, tuple(0 if s == t else never for s in range(4))) for t in range(4)]
    return [min(columns[t][s], never) for s in range(4) for t in range(4)]


def walk(kinds: bytes, state: int, end: tuple, last: bool) -> tuple[str, int, int]:
    """The edits from ``state`` on, the state after them, and their cost; ``last`` if the conversation ends here."""
    n, stride = len(kinds), max(1, isqrt(len(kinds)))
    checkpoints, costs = {n: end}, end
    for i in range(n - 1, -1, -1):
        costs = before(kinds[i], costs)
        if i % stride == 0:
            checkpoints[i] = costs
    edits, cost = [], 0
    for low in range(0, n, stride):
        high = min(low + stride, n)
        block = [checkpoints[high]]
        for i in range(high - 1, low - 1, -1):
            block.append(before(kinds[i], block[-1]))
        for i in range(low, high):
            now, after = block[high - i], block[high - i - 1]
            keep, fault = KINDS[kinds[i]]
            extra = CUT if fault == SHORT else 0
            while True:
                if now[state] == DELETE + after[state]:
                    edits.append("D")
                    cost += DELETE
                elif now[state] == PUT + now[STEP[state]]:
                    edits.append("I")
                    cost += PUT
                    state = STEP[state]
                    continue
                elif keep[state] is not None and now[state] == extra + after[keep[state]]:
                    edits.append("K")
                    cost += extra
                    state = keep[state]
                else:
                    edits.append("R")
                    cost += PUT + extra
                    state = STEP[state]
                break
    while last and AT_END[state]:
        edits.append("I")
        cost += PUT
        state = STEP[state]
    return "".join(edits), state, cost


def applied(audit: str, state: int, roles: list[str], texts: list[str]) -> list[dict]:
    """The repaired turns; ``roles`` and ``texts`` are those of the rows, repeats included."""
    turns, i = [], 0
    for edit in audit:
        if edit == "I":
            turns.append({"role": GIVEN[state], "text": ""})
            state = STEP[state]
            continue
        if edit == "K":
            turns.append({"role": roles[i], "text": texts[i]})
            state = KEEP[roles[i][:1]][state]
        elif edit == "R":
            turns.append({"role": GIVEN[state], "text": texts[i]})
            state = STEP[state]
        i += 1
    return turns


_TURNS = "array<struct<role: string, text: string>>"
_MEASURES = "n_blank long, n_duplicate long, n_truncated long, n_illegal long, first_initial string, last_initial string, first_turn long, last_turn long, n_turns long"


def _distinct(rows: DataFrame) -> DataFrame:
    """Each different row once, with the number of its copies and whether its role and text occur in no earlier turn.

    Copies are counted before the shuffle.  A text that a conversation repeats in many turns is found by an aggregation to its first turn; the join back
    is one that Spark can split.
    """
    digest = F.sha2("text", 256).alias("digest")
    each = rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies")).select("*", digest)
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    first = rows.select("conv", "role", digest, place.alias("place")).groupBy("conv", "role", "digest").agg(F.min("place").alias("first"))
    e, f = each.alias("e"), first.alias("f")
    same = F.col("e.conv").eqNullSafe(F.col("f.conv")) & (F.col("e.role") == F.col("f.role")) & (F.col("e.digest") == F.col("f.digest"))
    new = F.col("e.turn").eqNullSafe(F.col("f.first.turn"))
    return e.join(f, same).select("e.*", new.alias("new"))


def _faults(rows: DataFrame) -> DataFrame:
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    blank = bare == ""
    return rows.select("*", blank.alias("blank"), (~blank & ~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"))


class _Piece:
    """Rows of one conversation as they come; repeats are written out, as the edits name them one by one."""

    def __init__(self, conv):
        self.conv, self.kinds, self.roles, self.texts, self.size = conv, bytearray(), [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None

    def add(self, turn, role: str, text: str, copies: int, new: bool, blank: bool, cut: bool) -> None:
        initial = role[:1]
        for copy in range(copies):
            fresh = new and copy == 0
            self.blank += blank
            self.duplicate += not blank and not fresh
            self.truncated += cut and fresh
            self.kinds.append(kind(initial, GONE if blank or not fresh else SHORT if cut else WELL))
            if self.roles:
                self.illegal += (self.roles[-1][:1] + initial) not in LEGAL
            self.roles.append(role)
            self.texts.append(text)
        self.size += len(text) + 64
        if turn is not None:
            if self.first_turn is None:
                self.first_turn = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn

    def row(self, piece: int, whole: bool) -> dict:
        found = {
            "conv": self.conv, "piece": piece, "whole": whole, "n_blank": self.blank, "n_duplicate": self.duplicate, "n_truncated": self.truncated,
            "n_illegal": self.illegal, "first_initial": self.roles[0][:1], "last_initial": self.roles[-1][:1], "first_turn": self.first_turn,
            "last_turn": self.last_turn, "n_turns": self.turns,
        }
        if whole:
            audit, _, cost = walk(bytes(self.kinds), 0, AT_END, True)
            return found | {"audit": audit, "cost": cost, "turns": applied(audit, 0, self.roles, self.texts)}
        return found | {"kinds": bytes(self.kinds), "between": between(bytes(self.kinds)), "roles": self.roles, "texts": self.texts}


def _batched(rows: Iterator[dict], schema, size) -> Iterator:
    """Record batches of bounded bytes."""
    import pyarrow as pa

    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += size(row)
        if weight >= FLUSH_BYTES or len(held) >= 4096:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _arrow(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _streamed(frame: DataFrame, each, schema: T.StructType, size=lambda row: 256) -> DataFrame:
    """``each`` maps the dictionaries of a partition, in order, to dictionaries of ``schema``."""
    target = _arrow(schema)

    def step(batches):
        def rows():
            for batch in batches:
                for low in range(0, batch.num_rows, 256):
                    yield from batch.slice(low, 256).to_pylist()

        yield from _batched(each(rows()), target, size)

    return frame.mapInArrow(step, schema)


def _text_size(row: dict) -> int:
    return 256 + sum(len(t) for t in row.get("texts") or ()) + sum(len(t["text"]) for t in row.get("turns") or ())


def _cut(rows: DataFrame, conv_type: str, piece_rows: int) -> DataFrame:
    """Sorted rows to pieces.  The first and the last conversation of a partition may go on in another one."""
    schema = T.StructType.fromDDL(
        f"conv {conv_type}, piece long, whole boolean, {_MEASURES}, audit string, cost long, turns {_TURNS}, "
        "kinds binary, between array<long>, roles array<string>, texts array<string>"
    )

    def each(stream):
        number = TaskContext.get().partitionId() << 32
        piece, inside, open_end = None, False, False
        for r in stream:
            if piece is not None and piece.conv != r["conv"]:
                yield piece.row(number, inside and not open_end)
                number, piece, inside, open_end = number + 1, None, True, False
            elif piece is not None and (len(piece.kinds) >= piece_rows or piece.size >= PIECE_BYTES):
                yield piece.row(number, False)
                number, piece, open_end = number + 1, None, True
            if piece is None:
                piece = _Piece(r["conv"])
            piece.add(r["turn"], r["role"], r["text"], r["copies"], r["new"], r["blank"], r["cut"])
        if piece is not None:
            yield piece.row(number, False)

    return _streamed(rows, each, schema, _text_size)


def _by_conversation(frame: DataFrame, *order: Column) -> DataFrame:
    return frame.repartition("conv").sortWithinPartitions("conv", *order)


def _checkpoints(pieces: DataFrame, conv_type: str) -> DataFrame:
    """For every piece the costs to come behind it, strung together from the last piece backward."""
    schema = T.StructType.fromDDL("piece long, behind array<long>, last boolean")

    def each(stream):
        conv, costs, first = None, AT_END, True
        for r in stream:
            last = first or conv != r["conv"]
            if last:
                conv, costs, first = r["conv"], AT_END, False
            yield {"piece": r["piece"], "behind": list(costs), "last": last}
            way = r["between"]
            costs = tuple(min(way[4 * s + t] + costs[t] for t in range(4)) for s in range(4))

    return _streamed(_by_conversation(pieces.select("conv", "piece", "between"), F.col("piece").desc()), each, schema)


def _exits(pieces: DataFrame, conv_type: str) -> DataFrame:
    """For every piece the state behind it, for each state before it."""
    schema = T.StructType.fromDDL(f"conv {conv_type}, piece long, exits array<int>")

    def each(stream):
        for r in stream:
            ends = [walk(r["kinds"], s, tuple(r["behind"]), r["last"])[1] for s in range(4)]
            yield {"conv": r["conv"], "piece": r["piece"], "exits": ends}

    return _streamed(pieces.select("conv", "piece", "kinds", "behind", "last"), each, schema)


def _entries(exits: DataFrame) -> DataFrame:
    """For every piece the state before it, from the first piece forward."""
    schema = T.StructType.fromDDL("piece long, entry int")

    def each(stream):
        conv, state, first = None, 0, True
        for r in stream:
            if first or conv != r["conv"]:
                conv, state, first = r["conv"], 0, False
            yield {"piece": r["piece"], "entry": state}
            state = r["exits"][state]

    return _streamed(_by_conversation(exits, F.col("piece")), each, schema)


def _resolved(pieces: DataFrame, schema: T.StructType) -> DataFrame:
    names = set(schema.names)

    def each(stream):
        for r in stream:
            audit, _, cost = walk(r["kinds"], r["entry"], tuple(r["behind"]), r["last"])
            found = {"audit": audit, "cost": cost, "turns": applied(audit, r["entry"], r["roles"], r["texts"])}
            yield {k: v for k, v in (r | found).items() if k in names}

    return _streamed(pieces, each, schema, _text_size)


def repaired(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """Pieces of repaired conversations: ``conv, piece, turns`` (role and text), the edits (``audit``), their cost and what was found; in
    order of ``piece`` they make up a conversation, and most conversations are one piece."""
    conv_type = rows.schema[conv].dataType.simpleString()
    plain = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text")
    )
    order = ["conv", "turn", "role", "digest"]
    placed = _faults(_distinct(plain)).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = written(_cut(placed, conv_type, piece_rows))
    schema = T.StructType.fromDDL(f"conv {conv_type}, piece long, {_MEASURES}, audit string, cost long, turns {_TURNS}")
    whole = pieces.where("whole").select(*schema.names)
    rest = pieces.where("not whole")
    known = rest.join(_checkpoints(rest, conv_type), "piece")
    entries = _entries(_exits(known, conv_type))
    return whole.unionByName(_resolved(known.join(entries, "piece").select(*known.columns, "entry"), schema))


def summary(pieces: DataFrame) -> DataFrame:
    """One row for each conversation: ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    The digest is that of the repaired ``role:text`` lines; it takes the pieces one after the other, so none is held but the current one.
    """
    conv_type = pieces.schema["conv"].dataType.simpleString()
    schema = T.StructType.fromDDL(
        f"conv {conv_type}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    )

    def each(stream):
        done = None
        for r in stream:
            if done is None or done["conv"] != r["conv"]:
                if done is not None:
                    yield close(done)
                done = {"conv": r["conv"], "sha": hashlib.sha256(), "lines": 0, "audit": [], "low": None, "high": None, "turns": 0, "initial": None}
                done |= dict.fromkeys(("n_blank", "n_duplicate", "n_truncated", "n_illegal", "cost"), 0)
            for name in ("n_blank", "n_duplicate", "n_truncated", "n_illegal", "cost"):
                done[name] += r[name]
            if done["initial"] is not None:
                done["n_illegal"] += (done["initial"] + r["first_initial"]) not in LEGAL
            done["initial"] = r["last_initial"]
            if r["first_turn"] is not None:
                done["turns"] += r["n_turns"] - (done["high"] == r["first_turn"])
                done["low"] = r["first_turn"] if done["low"] is None else done["low"]
                done["high"] = r["last_turn"]
            for t in r["turns"]:
                done["sha"].update(f"{chr(10) if done['lines'] else ''}{t['role']}:{t['text']}".encode())
                done["lines"] += 1
            done["audit"].append(r["audit"])
        if done is not None:
            yield close(done)

    def close(done: dict) -> dict:
        gaps = 0 if done["low"] is None else done["high"] - done["low"] + 1 - done["turns"]
        return {
            "conv": done["conv"], "gaps": gaps, "blank": done["n_blank"], "duplicate": done["n_duplicate"], "truncated": done["n_truncated"],
            "illegal": done["n_illegal"], "cost": done["cost"], "audit": "".join(done["audit"]), "repaired_sha256": done["sha"].hexdigest(),
        }

    return _streamed(_by_conversation(pieces, F.col("piece")), each, schema)
