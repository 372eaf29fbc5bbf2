"""Conversation repair against a shortest path over whole audits, on damaged conversations with the
awkward rows: nulls, empty and long texts, odd roles, repeated turns and rows, extra columns."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest

from labormart.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string, cost long, audit string"


def table():
    r = random.Random(5)
    roles = ["user", "assistant", "system", "user", "assistant", None, "tool", "", "umbrella"]
    texts = ["Yes.", "No", "Why?", " \t", "", None, "end! ", "a\x0bb.", "ünïcode…", "x" * 5000, "Go.\n\n"]
    rows = []
    for conv in [*range(150), None]:
        n = r.choice([0, 1, 2, 3, 5, 8, 13]) if conv is not None else 60
        for i in range(n):
            turn = r.choice([i, i, i, None, i + 3, 0])
            rows.append((conv, turn, r.choice(roles[: r.choice([2, 3, 9])]), r.choice(texts), 1, "clash"))
    rows += [(900, i, ("user", "assistant")[i % 2], f"turn {i}.", 1, "c") for i in range(300)]
    rows += [(901, 7, "user", "same.", 1, "c")] * 120
    # Kept out of every row: turn 0 of these conversations is dropped.
    gone = [c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    return rows + [(c, 0, "user", "Hello.", 1, "c") for c in gone] + rows[:5]


def damaged(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if d == 1:
            text = ""
        if d == 2:
            text = re.sub("[.!?]", "", text)
        if d == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    return out


def expected(rows):
    """One conversation: Dijkstra by (cost, audit), which is the contract's order."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, kinds = set(), []
    for _, _, role, text in rows:
        bare = re.findall(r"[^\x20\x09-\x0D]", text)
        kinds.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    pattern = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    name = {"u": "user", "a": "assistant"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            break
        for x in "ua":
            if (state, x) in pattern:
                heapq.heappush(heap, (cost + 2, audit + "I", i, x, (*out, name[x] + ":")))
        if i < len(rows):
            _, _, role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, out))
            if kinds[i] not in ("blank", "duplicate"):
                more = kinds[i] == "truncated"
                if (state, role[:1]) in pattern:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*out, f"{role}:{text}")))
                for x in "ua":
                    if (state, x) in pattern:
                        heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, x, (*out, f"{name[x]}:{text}")))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows[:-1], rows[1:], strict=True))
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


@pytest.mark.parametrize("long_rows", [4096, 7])
def test_repair_equals_shortest_path(spark, long_rows):
    rows = table()
    by: dict = {r[0]: [] for r in rows}
    for r in damaged(rows):
        by[r[0]].append(r)
    want = {k: expected(v) for k, v in by.items()}
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    pieces = C.materialize(C.repair(C.damage(docs), long_rows=long_rows), "test-pieces")
    got = C.digest(pieces).collect()
    assert len(got) == len(want)
    assert {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in got} == want
    assert (pieces.where("pieces > 1").count() > 0) == (long_rows == 7)


def test_repair_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert C.digest(C.repair(C.damage(none))).count() == 0
    lost = [c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][0]
    one = C.digest(C.repair(C.damage(spark.createDataFrame([(lost, 0, "user", "Hi.", 1, "")], SCHEMA)))).first()
    assert tuple(one) == (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_ranks_follow_the_audits():
    """Doubled ranks and pointers read the least path of a graph that is walked letter by letter."""
    initial = np.array([1, 3, 3, 2, 0, 2])
    must = np.array([False, False, True, False, False, False])
    cut = np.array([False, True, False, False, False, True])
    starts = np.array([0, 4, 4, 6])
    ends = np.tile(C._LAST, (3, 1))
    paths, costs = C.least_audits(initial, must, cut, starts, ends, np.zeros((3, 1), np.int64))
    node, letter, target = C.optimal_arcs(initial, must, cut, starts, ends, costs)
    for (letters, *_), begin in zip(paths, [0, None, 16], strict=True):
        walked = []
        while begin is not None and begin < 4 * len(initial):
            arc = min(zip(letter[node == begin].tolist(), target[node == begin].tolist(), strict=True))
            walked.append(arc[0])
            begin = arc[1]
        assert letters.tolist() == walked
