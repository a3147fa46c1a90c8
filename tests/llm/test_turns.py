"""Repair of conversations against a forward search over cost and edits."""

import hashlib
import random

import pytest

from daymart.llm import turn_repair

INF = (1 << 40, "~")


def cheapest(rows):
    """Least (cost, edits) over all sequences, forward; ``rows``: (initial, must go, truncated)."""
    step = {"": "u", "s": "u", "u": "a", "a": "u"}

    def inserted(states):
        for _ in range(3):
            for s, (cost, edits) in list(states.items()):
                states[step[s]] = min(states.get(step[s], INF), (cost + 3, edits + "I"))
        return states

    states = inserted({"": (0, "")})
    for initial, gone, cut in rows:
        after = {}

        def put(state, cost, edits):
            after[state] = min(after.get(state, INF), (cost, edits))

        for s, (cost, edits) in states.items():
            put(s, cost + 4, edits + "D")
            if not gone:
                extra = 3 if cut else 0
                put(step[s], cost + 3 + extra, edits + "R")
                if initial == step[s] or (initial, s) == ("s", ""):
                    put(initial, cost + extra, edits + "K")
        states = inserted(after)
    return min(states.get("", INF), states.get("a", INF))


@pytest.mark.parametrize("seed", range(300))
def test_walk_is_the_cheapest_and_least(seed):
    chance = random.Random(seed)
    rows = [(chance.choice("suax"), chance.random() < 0.25, chance.random() < 0.3) for _ in range(chance.randrange(0, 12))]
    kinds = bytes(turn_repair.kind(i, turn_repair.GONE if g else turn_repair.SHORT if c else turn_repair.WELL) for i, g, c in rows)
    audit, state, cost = turn_repair.walk(kinds, 0, turn_repair.AT_END, True)
    assert (cost, audit) == cheapest(rows) and state in (0, 3)
    # Cut anywhere, with the costs behind the cut, the pieces give the same.
    at = chance.randrange(0, len(kinds) + 1)
    behind = turn_repair.start(kinds[at:], turn_repair.AT_END)
    way = turn_repair.between(kinds[:at])
    assert tuple(min(way[4 * s + t] + behind[t] for t in range(4)) for s in range(4)) == turn_repair.start(kinds, turn_repair.AT_END)
    head, middle, first = turn_repair.walk(kinds[:at], 0, behind, False)
    tail, _, second = turn_repair.walk(kinds[at:], middle, turn_repair.AT_END, True)
    assert (head + tail, first + second) == (audit, cost)


def brute(rows):
    """The summary of one conversation's rows (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    counts, seen, marks = dict.fromkeys(("blank", "duplicate", "truncated"), 0), set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        marks.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    cost, audit = cheapest(marks)
    lines, i, last = [], 0, ""
    for edit in audit:
        if edit == "I":
            last = "assistant" if last[:1] == "u" else "user"
            lines.append(f"{last}:")
            continue
        if edit == "K":
            last = rows[i][1]
        elif edit == "R":
            last = "assistant" if last[:1] == "u" else "user"
        if edit != "D":
            lines.append(f"{last}:{rows[i][2]}")
        i += 1
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.mark.parametrize("piece_rows", [4096, 3])
def test_repaired(spark, piece_rows):
    """Nulls, ties, repeats, a long conversation in many pieces, columns with clashing names."""
    chance = random.Random(5)
    said = ["Yes.", "No", "", " \t\n", "Why?", "é…", None, "x" * 50_000 + ".", "two\nlines!"]
    given = [(c, chance.choice([None, *range(9)]), chance.choice(["system", "user", "assistant", "tool", "", None]), chance.choice(said))
             for c in [None, *range(40)] for _ in range(chance.randrange(1, 9))]
    given += [(77, chance.choice([None, *range(2000)]), chance.choice(["user", "assistant"]), f"{chance.randrange(300)}.") for _ in range(900)]
    given += [(78, 1, "user", "the same.")] * 500
    frame = spark.createDataFrame([(*r, "x", "x", 1, "x") for r in given], "conv_id long, turn long, role string, text string, digest string, conv string, copies int, kinds string")
    rows = turn_repair.summary(turn_repair.repaired(frame.repartition(6), piece_rows=piece_rows)).collect()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = {r["conv"]: tuple(r[n] for n in names) for r in rows}
    assert len(rows) == len(got)
    assert got == {c: brute([r[1:] for r in given if r[0] == c]) for c in {r[0] for r in given}}


def test_no_rows(spark):
    frame = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert turn_repair.summary(turn_repair.repaired(frame)).collect() == []
