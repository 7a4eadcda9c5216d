"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import random
import zlib

import pytest

from sparkkit.llm import repair

BLANK = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(marks):
    """The least (cost, audit) whose roles match, by best-first search over all edits of (initial, must go, truncated)."""
    heap = [(0, "", 0, "")]
    done = set()
    while heap:
        cost, audit, at, last = heapq.heappop(heap)
        # what may follow depends on the last initial only; least cost first, then least audit
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(marks) and last in ("", "a"):
            return cost, audit
        follows = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        if at < len(marks):
            initial, must, cut = marks[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, last))
            if not must:
                if initial and initial in follows:
                    heapq.heappush(heap, (cost + 3 * cut, audit + "K", at + 1, initial))
                for role in follows.replace("s", ""):
                    heapq.heappush(heap, (cost + 3 + 3 * cut, audit + "R", at + 1, role))
        for role in follows.replace("s", ""):
            heapq.heappush(heap, (cost + 3, audit + "I", at, role))


def brute(rows):
    """Result of the rows (turn, role, text) of a conversation."""
    marks, seen, counts = [], set(), [0, 0, 0]
    for _, role, text in rows:
        bare = text.strip(BLANK)
        fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        marks.append((role[:1], fault in (0, 1), fault == 2))
    cost, audit = cheapest(marks)
    out, left, last = [], list(rows), ""
    for letter in audit:
        if letter == "D":
            left.pop(0)
            continue
        nxt = {"": "user", "s": "user", "u": "assistant", "a": "user"}[last]
        _, role, text = (None, nxt, "") if letter == "I" else left.pop(0)
        role = nxt if letter == "R" else role
        out.append(f"{role}:{text}")
        last = role[:1]
    firsts = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def conversations(rng, n, longest):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "u", "agent"]
    texts = ["Yes.", "No!", "Why?", "cut", " ", None, "", "Fine. \n", "a. b", "long? " * 30]
    rows = []
    for conv in range(n):
        size = rng.randint(1, longest)
        for turn in rng.sample(range(-3, 2 * size), size):
            text = rng.choice(texts) if rng.random() < 0.5 else f"Text {rng.randint(0, 4 * size)}" + rng.choice([".", ""])
            role = rng.choice(roles) if rng.random() < 0.4 else ("user", "assistant")[turn % 2]
            rows.append((conv if conv % 17 else None, None if rng.random() < 0.02 and not conv % 17 == 0 else turn, role, text))
    return rows


@pytest.mark.parametrize("limits", [(repair.ROWS, repair.CHARS), (3, 1 << 20), (100, 40)])
def test_repair_against_search(spark, limits):
    rng = random.Random(limits[0])
    # one null turn per conversation at most, and the null conversation's turns are distinct, so the order is fixed
    rows, seen = [], set()
    for r in conversations(rng, 120, 12):
        if r[:2] not in seen:
            seen.add(r[:2])
            rows.append(r)
    rows += [("hot", t, ("user", "assistant")[t % 2], rng.choice(["same.", f"own {t}.", "cut"])) for t in range(600)]
    rows = [(None if c is None else str(c), *rest) for c, *rest in rows]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "conv_id string, turn long, role string, text string, copies string").repartition(7)
    by = {c: [] for c, *_ in rows}
    for c, turn, role, text in brute_damage(rows):
        by[c].append((turn, role, text))
    want = {c: brute(sorted(x, key=lambda r: (r[0] is not None, r[0] or 0))) for c, x in by.items()}
    got = {r[0]: tuple(r)[1:] for r in repair.repair(repair.damage(docs), *limits).collect()}
    assert got.keys() == want.keys()
    wrong = [(c, by[c], got[c], want[c]) for c in want if got[c] != want[c]]
    assert not wrong, wrong[:1]


def test_edge_cases(spark):
    schema = "conv long, turn long, role string, text string"
    empty = hashlib.sha256(b"").hexdigest()
    rows = [(1, 0, None, None), (2, None, "user", "Hi."), (2, None, "assistant", "Yes."), (3, 5, "system", "x."), (4, 0, "user", "b" * 400_000 + "."), (4, 1, "assistant", "Ja.")]
    got = {r[0]: tuple(r)[1:] for r in repair.repair(spark.createDataFrame(rows, schema)).collect()}
    assert got[1] == (0, 0, 0, 0, 0, 0, "", empty)
    # nulls first, rows of one turn by role: assistant, user
    assert got[2][:6] == (0, 0, 0, 0, 0, 6) and got[2][6] in ("IKKI", "RR")
    assert got[3][5:7] == (4, "D")
    assert got[4] == (0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(b"user:" + b"b" * 400_000 + b".\nassistant:Ja.").hexdigest())
    assert repair.repair(spark.createDataFrame([], schema)).count() == 0


def test_powers_equal_single_steps():
    rng = random.Random(5)
    for _ in range(300):
        symbols = "".join(c * rng.randint(1, 9) for c in rng.choices("suaoSUAOx", k=rng.randint(1, 8)))
        costs = repair.end_costs()
        for c in reversed(symbols):
            costs = repair.apply(repair.power(c, 0), costs)
        assert costs == repair.advance(symbols, repair.end_costs()) == repair.apply(repair.transition(symbols), repair.end_costs())
