"""Conversation structure repair by cost DP and prefix-doubling path ranking.

A conversation's rows are taken by turn (nulls first), then role and text; repeated rows are separate
rows. Rows are kept, re-roled, deleted, or empty rows are inserted, so that the initials of the roles
read ``(s?(ua)+)?`` at the least cost (``COST``). Where one stands in that pattern is one of four states:
nothing yet, after s, after u, after a.

1. The cost DP gives the least cost to the end from every node (row, state); arcs that keep it are optimal.
2. Optimal arcs are ranked by their first letter, then by the first 2, 4, 8 ... letters of the audit that
   they begin: an arc's rank at the next length is that of (its rank, the rank of the best arc at the node
   that its half ends in), and its pointer doubles. A node's best arc is the one of least rank.
3. The audit that is least in ASCII order is read through the doubled pointers, all rows of a batch at once.

Conversations of up to ``LONG_ROWS`` rows and ``LONG_BYTES`` of text are repaired in batches, each whole
in one task. A longer one (a third of all rows, for example the rows without a conv_id) is dealt by ranges of
its rows and cut into chunks: each chunk's least costs from state to state form a 4 x 4 matrix, the matrices
are combined from the end (least costs behind each chunk) and the chunks' ends from the start, and every
chunk is repaired by itself in between. Equal rows are counted before they are dealt.

Nulls: a null conv_id is one conversation, null turns come first and count in no gap, null roles and texts
are one blank. Empty and blank texts are faults; very long texts are taken whole. A role whose initial is
none of s, u, a cannot be kept. Other columns are ignored; an empty table gives an empty result. A
conversation of which no row is left gives zeros, an empty audit and no messages.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labormart.llm.common import _array, _arrow_schema, load, materialize, ship_package

#: What the edits cost; a truncated row that stays costs one more.
COST = {"Delete": 3, "Insert": 2, "Keep": 0, "Rerole": 2}
LETTERS = np.frombuffer(b"\0DIKR", np.uint8)
END, DELETE, INSERT, KEEP, REROLE = range(5)
#: Conversations beyond these are dealt over several tasks, in chunks of at most these.
LONG_ROWS, LONG_BYTES = 4096, 16 << 20
SPACE = " \t\n\x0b\x0c\r"
FAR = 1 << 40
#: State after the next u or a, from each state; state after keeping initial (other, s, u, a), or -1.
_NEXT = np.array([2, 2, 3, 2])
_KEPT = np.array([[-1, -1, -1, -1], [1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1]])
#: Least costs behind the last row, and the inserts that they stand for.
_LAST = np.array([0, 4, 2, 0])
_PIECE = ("conv_id {id}, piece long, pieces long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, messages array<struct<role:string,text:string>>")


def least_costs(initial, must, truncated, starts, ends) -> np.ndarray:
    """Least cost from every (row, state) to the end of the row's segment.

    ``initial`` 0-3, ``must`` (delete) and ``truncated`` per row; segments are rows starts[i] to
    starts[i + 1]; ``ends`` (segments, 4, k): costs behind each segment, for k cases at once.
    """
    length = np.diff(starts)
    order = np.argsort(-length, kind="stable")
    cur = ends[order].astype(np.int64)
    out = np.empty((len(initial), 4, ends.shape[2]), np.int64)
    last = starts[1:][order] - 1
    live = len(order)
    for t in range(int(length.max(initial=0))):
        live = int(np.searchsorted(-length[order], -t, "left"))
        r = last[:live] - t
        here, tr, stop = cur[:live], truncated[r][:, None, None], np.where(must[r], FAR, 0)[:, None, None]
        best = here + COST["Delete"]
        best = np.minimum(best, here[:, _NEXT] + (COST["Rerole"] + tr + stop))
        kept = _KEPT[initial[r]]
        same = np.take_along_axis(here, np.maximum(kept, 0)[:, :, None], 1) + (COST["Keep"] + tr + stop) + np.where(kept < 0, FAR, 0)[:, :, None]
        best = np.minimum(best, same)
        two = np.minimum(best[:, 2], best[:, 3] + COST["Insert"])
        three = np.minimum(best[:, 3], best[:, 2] + COST["Insert"])
        cur[:live] = np.stack([np.minimum(best[:, 0], two + COST["Insert"]), np.minimum(best[:, 1], two + COST["Insert"]), two, three], 1)
        out[r] = cur[:live]
    return out


def optimal_arcs(initial, must, truncated, starts, ends, costs):
    """(node, letter, target) of the arcs that keep the least cost, by node and letter.

    Node 4 * row + state; behind the rows 4 * (rows + segment) + state, with an arc to itself.
    """
    n, segments = len(initial), len(starts) - 1
    row = np.arange(n)
    segment = np.repeat(np.arange(segments), np.diff(starts))
    final = row + 1 == starts[1:][segment]
    below = np.where(final[:, None], ends[segment], np.concatenate((costs[1:], costs[:1])) if n else costs)
    base = np.where(final, 4 * (n + segment), 4 * (row + 1))[:, None]
    state, tr, may = np.arange(4)[None, :], truncated.astype(np.int64)[:, None], ~must[:, None]
    kept = _KEPT[initial]
    steps = [
        (DELETE, below + COST["Delete"], base + state, np.ones((n, 4), bool)),
        (INSERT, costs[:, _NEXT] + COST["Insert"], 4 * row[:, None] + _NEXT[None, :], np.ones((n, 4), bool)),
        (KEEP, np.take_along_axis(below, np.maximum(kept, 0), 1) + tr + COST["Keep"], base + kept, may & (kept >= 0)),
        (REROLE, below[:, _NEXT] + tr + COST["Rerole"], base + _NEXT[None, :], np.broadcast_to(may, (n, 4))),
    ]
    node, letter, target = [], [], []
    for mark, cost, to, allowed in steps:
        at = np.flatnonzero(((cost == costs) & allowed).ravel())
        node.append(at)
        letter.append(np.full(len(at), mark))
        target.append(to.ravel()[at])
    sinks = 4 * n + np.arange(4 * segments)
    node, letter, target = (np.concatenate(x) for x in ((*node, sinks), (*letter, np.full(len(sinks), END)), (*target, sinks)))
    order = np.argsort(node * 8 + letter)
    return node[order], letter[order], target[order]


def doubled_pointers(node, letter, target, starting) -> tuple[np.ndarray, list[np.ndarray]]:
    """First letter of each node's least audit, and per level k where its first 2^k letters lead.

    Levels go on until every starting node's pointer has passed the last row. The arcs out of one node
    bear different letters, so a least audit has one path.
    """
    first = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
    arcs = len(node)
    rank, end, pointers = letter.astype(np.int64), target, []
    letters = None
    last = np.zeros(len(first), bool)
    last[node[letter == END]] = True
    while True:
        best = np.minimum.reduceat(rank * arcs + np.arange(arcs), first) % arcs
        letters = letter[best] if letters is None else letters
        pointers.append(end[best])
        if last[pointers[-1][starting]].all():
            return letters, pointers
        ahead = best[end]
        _, rank = np.unique(rank * (arcs + 5) + rank[ahead], return_inverse=True)
        end = end[ahead]


def read_paths(letters, pointers, starting, n) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the least audits of the starting nodes, in order, and which start each belongs to."""
    at, owner = starting.copy(), np.arange(len(starting))
    inside = at < 4 * n
    at, owner = at[inside], owner[inside]
    for jump in reversed(pointers[:-1] if len(pointers) > 1 else []):
        at, owner = np.stack((at, jump[at]), 1).ravel(), np.repeat(owner, 2)
        inside = at < 4 * n
        at, owner = at[inside], owner[inside]
    return at, owner


def least_audits(initial, must, truncated, starts, ends, entries):
    """Per segment and entry state: (letters, rows, new states, state behind the segment).

    ``entries`` (segments, e): states to start from; the results are per segment and entry, flat.
    """
    segments, n = len(starts) - 1, len(initial)
    costs = least_costs(initial, must, truncated, starts, ends[:, :, None])[:, :, 0]
    arcs = optimal_arcs(initial, must, truncated, starts, ends, costs)
    begin = np.where(np.diff(starts) > 0, 4 * starts[:-1], 4 * (n + np.arange(segments)))
    starting = (begin[:, None] + entries).ravel()
    letters, pointers = doubled_pointers(*arcs, starting)
    behind = pointers[-1][starting] % 4
    at, owner = read_paths(letters, pointers, starting, n)
    letter, after = letters[at], pointers[0][at] % 4
    cut = np.searchsorted(owner, np.arange(len(starting) + 1))
    return [(letter[a:b], at[a:b] // 4, after[a:b], int(e)) for a, b, e in zip(cut[:-1].tolist(), cut[1:].tolist(), behind.tolist(), strict=True)], costs


def messages(path, roles, texts) -> list[dict]:
    """The repaired rows of one path."""
    out = []
    for letter, row, state in zip(*(x.tolist() for x in path[:3]), strict=True):
        if letter == KEEP:
            out.append({"role": roles[row], "text": texts[row]})
        elif letter != DELETE:
            out.append({"role": "user" if state == 2 else "assistant", "text": texts[row] if letter == REROLE else ""})
    return out


def tail(state: int) -> tuple[str, list[dict]]:
    """Inserts behind the last row."""
    return {1: ("II", ["user", "assistant"]), 2: ("I", ["assistant"])}.get(state, ("", []))


def audit_text(letters) -> str:
    return LETTERS[letters].tobytes().decode()


def initials(roles: list[str]) -> np.ndarray:
    return np.array([{"s": 1, "u": 2, "a": 3}.get(x[:1], 0) for x in roles], np.int64)


def faults(roles, texts, earlier) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(blank, duplicate, truncated) per row; each row has one fault at most. ``earlier``: bool per row."""
    blank, cut = np.zeros(len(roles), bool), np.zeros(len(roles), bool)
    for i, text in enumerate(texts):
        bare = text.rstrip(SPACE)
        blank[i], cut[i] = not bare, bare[-1:] not in (".", "!", "?")
    duplicate = ~blank & earlier
    return blank, duplicate, cut & ~blank & ~duplicate


def illegal_pairs(initial: np.ndarray) -> np.ndarray:
    """Which adjacent pairs are none of su, ua, au."""
    a, b = initial[:-1], initial[1:]
    return ~(((a == 1) & (b == 2)) | ((a == 2) & (b == 3)) | ((a == 3) & (b == 2)))


def _long(x: int) -> int:
    """As a long, wrapped."""
    return (x + (1 << 63)) % (1 << 64) - (1 << 63)


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): by crc32 of ``conv_id:turn`` modulo 20, 0 drops a row (no
    copies), 1 empties its text, 2 removes ``[.!?]``, 3 repeats it, 4 makes it a user's."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                                F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("d"))
    text = F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("d") == 0, 0).when(F.col("d") == 3, 2).otherwise(1).cast("long")
    return rows.select("conv_id", "turn", F.when(F.col("d") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copies"))


_ORDER = ("conv_id", "turn", "role", "text")


def _runs(batches, columns):
    """Lists of whole conversations' columns from rows sorted by conversation, a batch at a time."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]).select(columns)
        table = table if rest is None else pa.concat_tables([rest, table])
        ids = table["conv_id"].to_pylist()
        cut = len(ids)
        while cut and ids[cut - 1] == ids[-1]:
            cut -= 1
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest


def _repair_whole(table: pa.Table) -> dict:
    """Pieces of whole conversations."""
    ids, copies = table["conv_id"].to_pylist(), table["copies"].to_pylist()
    turns, roles, texts = ([x for x, c in zip(table[k].to_pylist(), copies, strict=True) for _ in range(c)] for k in ("turn", "role", "text"))
    owner = [x for x, c in zip(ids, copies, strict=True) for _ in range(c)]
    names = [x for i, x in enumerate(ids) if not i or x != ids[i - 1]]
    starts, earlier, seen, at = [], np.zeros(len(owner), bool), set(), 0
    for name in names:
        starts.append(at)
        seen.clear()
        while at < len(owner) and owner[at] == name:
            row = (roles[at], texts[at])
            earlier[at] = row in seen
            seen.add(row)
            at += 1
    starts = np.array([*starts, at])
    blank, duplicate, cut = faults(roles, texts, earlier)
    initial = initials(roles)
    paths, costs = least_audits(initial, blank | duplicate, cut, starts, np.tile(_LAST, (len(names), 1)), np.zeros((len(names), 1), np.int64))
    out: dict = {k: [] for k in ("conv_id", "piece", "pieces", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "messages")}
    for i, (name, path) in enumerate(zip(names, paths, strict=True)):
        a, b = int(starts[i]), int(starts[i + 1])
        known = [x for x in turns[a:b] if x is not None]
        more, added = tail(path[3])
        row = (name, 0, 1, _long(known[-1] - known[0] + 1 - len(set(known))) if known else 0, int(blank[a:b].sum()), int(duplicate[a:b].sum()), int(cut[a:b].sum()),
               int(illegal_pairs(initial[a:b]).sum()), int(costs[a, 0]) if b > a else 0, audit_text(path[0]) + more, messages(path, roles, texts) + [{"role": x, "text": ""} for x in added])
        for k, v in zip(out, row, strict=True):
            out[k].append(v)
    return out


def _mapped(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` over a whole partition: ``fn`` gets its batches and yields dicts of columns."""
    ship_package(df.sparkSession)
    kind = _arrow_schema(schema)

    def run(batches):
        for cols in fn(batches):
            yield pa.RecordBatch.from_arrays([_array(cols[f.name], f.type) for f in kind], schema=kind)

    return df.mapInArrow(run, schema)


def repair(rows: DataFrame, long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """Repaired conversations of ``rows`` (conv_id, turn, role, text, copies), a row per piece: conv_id, piece
    (from 0), pieces, gaps, blank, duplicate, truncated, illegal, cost, audit and messages (role, text). A
    conversation that is not long is one piece; a long one's audit and messages go on over its pieces in order, and
    its counts stand in each."""
    id_type = dict(rows.dtypes)["conv_id"]
    piece = _PIECE.format(id=id_type)
    sizes = rows.groupBy("conv_id").agg(F.sum("copies").alias("n"), F.sum(F.octet_length("text") * F.col("copies")).alias("b"))
    long_ = materialize(sizes.where((F.col("n") > long_rows) | (F.col("b") > long_bytes)).select("conv_id"), "repair-long")
    some = not long_.isEmpty()
    same = rows["conv_id"].eqNullSafe(long_["conv_id"])
    short = rows.join(long_, same, "left_anti") if some else rows

    def whole(batches):
        for table in _runs(batches, [*_ORDER, "copies"]):
            yield _repair_whole(table)

    out = _mapped(short.select(*_ORDER, "copies").repartition("conv_id").sortWithinPartitions(*_ORDER), whole, piece)
    return out.unionByName(_repair_long(rows.join(long_, same, "left_semi"), id_type, long_rows, long_bytes)) if some else out


def _repair_long(rows: DataFrame, id_type: str, most_rows: int, most_bytes: int) -> DataFrame:
    """Pieces of long conversations, by chunks of ``most_rows`` rows (see the module's text)."""
    counted = rows.where("copies > 0").groupBy(*_ORDER).agg(F.sum("copies").alias("copies"))
    first = counted.groupBy("conv_id", "role", "text").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
    c, f = counted.alias("c"), first.alias("f")
    both = c.join(f.hint("merge"), F.expr("c.conv_id <=> f.conv_id and c.role = f.role and c.text = f.text"))
    parts = both.select("c.*", F.expr("c.turn <=> f.first.turn").alias("first"), F.explode(F.expr(f"sequence(0L, (copies - 1) div {most_rows})")).alias("part"))
    parts = parts.select(*_ORDER, "part", F.least(F.lit(most_rows), F.col("copies") - F.col("part") * most_rows).cast("int").alias("k"), (F.col("first") & (F.col("part") == 0)).alias("first"))
    dealt = parts.repartitionByRange(*_ORDER, "part").sortWithinPartitions(*_ORDER, "part")
    kind = (f"conv_id {id_type}, pid int, seq int, codes binary, roles array<string>, texts array<string>, distinct long, turn0 long, turn1 long, "
            "blank long, duplicate long, truncated long, illegal long, matrix array<long>")

    def chunked(batches):
        from pyspark import TaskContext

        pid, seq = TaskContext.get().partitionId(), 0
        for table in _chunks(batches, most_rows, most_bytes):
            conv, turns, roles, texts, earlier = table
            blank, duplicate, cut = faults(roles, texts, earlier)
            initial = initials(roles)
            must = blank | duplicate
            ends = np.where(np.eye(4, dtype=bool), 0, FAR)[None]
            known = [x for x in turns if x is not None]
            # A copy behind the first of equal rows needs no text: it is always deleted.
            yield {"conv_id": [conv], "pid": [pid], "seq": [seq], "codes": [(initial + 4 * must + 8 * cut).astype(np.uint8).tobytes()], "roles": [roles],
                   "texts": [["" if d else t for t, d in zip(texts, must.tolist(), strict=True)]], "distinct": [len(set(known))],
                   "turn0": [known[0] if known else None], "turn1": [known[-1] if known else None], "blank": [int(blank.sum())], "duplicate": [int(duplicate.sum())],
                   "truncated": [int(cut.sum())], "illegal": [int(illegal_pairs(initial).sum())],
                   "matrix": [least_costs(initial, must, cut, np.array([0, len(roles)]), ends)[0].ravel().tolist()]}
            seq += 1

    chunks = materialize(_mapped(dealt, chunked, kind), "repair-chunks")
    small = chunks.select("conv_id", "pid", "seq", "distinct", "turn0", "turn1", "blank", "duplicate", "truncated", "illegal", "matrix",
                          F.expr("ascii(substring(codes, 1, 1)) & 3").alias("initial0"), F.expr("ascii(substring(codes, -1, 1)) & 3").alias("initial1"))

    def totals(table: pa.Table) -> pa.Table:
        """Numbers of one long conversation, and the least costs behind each of its chunks."""
        rows = sorted(table.to_pylist(), key=lambda r: (r["pid"], r["seq"]))
        sums = {k: sum(r[k] for r in rows) for k in ("blank", "duplicate", "truncated", "illegal")}
        ends = np.array([(a["initial1"], b["initial0"]) for a, b in zip(rows[:-1], rows[1:], strict=True)]).reshape(-1, 2)
        sums["illegal"] += sum(int(illegal_pairs(x)[0]) for x in ends)
        known = [r for r in rows if r["distinct"]]
        split = sum(a["turn1"] == b["turn0"] for a, b in zip(known[:-1], known[1:], strict=True))
        gaps = known[-1]["turn1"] - known[0]["turn0"] + 1 - sum(r["distinct"] for r in known) + split if known else 0
        behind, out = _LAST.astype(np.int64), []
        for r in reversed(rows):
            out.append(behind.tolist())
            behind = (np.array(r["matrix"]).reshape(4, 4) + behind).min(1)
        n = len(rows)
        cols = {"conv_id": [r["conv_id"] for r in rows], "pid": [r["pid"] for r in rows], "seq": [r["seq"] for r in rows], "piece": range(n), "pieces": [n] * n,
                "gaps": [_long(gaps)] * n, **{k: [v] * n for k, v in sums.items()}, "cost": [int(behind[0])] * n, "behind": out[::-1]}
        return pa.Table.from_pydict(cols, schema=behind_schema)

    head = f"conv_id {id_type}, pid int, seq int, piece long, pieces long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    behind_schema, entry_schema = _arrow_schema(head + ", behind array<long>"), _arrow_schema(f"eid {id_type}, piece long, entry int, exit int")
    heads = materialize(small.groupBy("conv_id").applyInArrow(totals, head + ", behind array<long>"), "repair-behind")
    names = [x.split()[0] for x in head.split(", ")]
    h = heads.withColumnRenamed("conv_id", "hid")
    todo = chunks.select("conv_id", "pid", "seq", "codes", "roles", "texts").join(h, ["pid", "seq"]).where(F.expr("conv_id <=> hid")).drop("hid")

    def walk(batches):
        """Each chunk's least audit and messages from each of the four states."""
        for batch in batches:
            for r in batch.to_pylist():
                codes = np.frombuffer(r["codes"], np.uint8).astype(np.int64)
                paths, _ = least_audits(codes & 3, (codes & 4) > 0, (codes & 8) > 0, np.array([0, len(codes)]), np.array([r["behind"]]), np.arange(4)[None])
                found = [(audit_text(p[0]), messages(p, r["roles"], r["texts"]), p[3]) for p in paths]
                yield {**{k: [r[k]] for k in names}, "audits": [[x[0] for x in found]], "said": [[x[1] for x in found]], "exits": [[x[2] for x in found]]}

    walked = materialize(_mapped(todo, walk, head + ", audits array<string>, said array<array<struct<role:string,text:string>>>, exits array<int>"), "repair-walked")

    def enter(table: pa.Table) -> pa.Table:
        """The state in which the least audit enters each chunk."""
        state, out = 0, []
        for r in sorted(table.to_pylist(), key=lambda r: r["piece"]):
            out.append((r["conv_id"], r["piece"], state, r["exits"][state]))
            state = r["exits"][state]
        return pa.Table.from_pydict(dict(zip(("eid", "piece", "entry", "exit"), zip(*out, strict=True), strict=True)), schema=entry_schema)

    entries = walked.select("conv_id", "piece", "exits").groupBy("conv_id").applyInArrow(enter, f"eid {id_type}, piece long, entry int, exit int")
    done = walked.join(entries, "piece").where(F.expr("conv_id <=> eid"))
    last = F.col("piece") == F.col("pieces") - 1
    more = F.when(last & (F.col("exit") == 1), "II").when(last & (F.col("exit") == 2), "I").otherwise("")
    empty = lambda *roles: F.array(*[F.struct(F.lit(x).alias("role"), F.lit("").alias("text")) for x in roles])
    said = F.expr("said[entry]")
    said = F.when(last & (F.col("exit") == 1), F.concat(said, empty("user", "assistant"))).when(last & (F.col("exit") == 2), F.concat(said, empty("assistant"))).otherwise(said)
    return done.select("conv_id", "piece", "pieces", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", F.concat(F.expr("audits[entry]"), more).alias("audit"), said.alias("messages"))


def _chunks(batches, most_rows: int, most_bytes: int):
    """(conv_id, turns, roles, texts, earlier) of at most ``most_rows`` rows and about ``most_bytes``, in order."""
    conv, size, rows = None, 0, []

    def out():
        turns, roles, texts, earlier = (list(x) for x in zip(*rows, strict=True))
        return conv, turns, roles, texts, np.array(earlier, bool)

    for batch in batches:
        for r in batch.to_pylist():
            for i in range(r["k"]):
                if rows and (r["conv_id"] != conv or len(rows) >= most_rows or size > most_bytes):
                    yield out()
                    rows, size = [], 0
                conv = r["conv_id"]
                rows.append((r["turn"], r["role"], r["text"], i > 0 or not r["first"]))
                size += len(r["text"]) if not i else 0
    if rows:
        yield out()


def digest(pieces: DataFrame) -> DataFrame:
    """Per conversation: its numbers, the whole audit, and the SHA-256 of its repaired ``role:text`` lines.
    A long conversation's pieces are hashed one after the other, a piece at a time in memory."""
    lines = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    numbers = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    flat = pieces.select(*numbers, "audit", "piece", "pieces", lines.alias("lines"), F.size("messages").alias("n"))
    one = flat.where("pieces = 1").select(*numbers, "audit", F.sha2(F.col("lines").cast("binary"), 256).alias("repaired_sha256"))
    schema = one.schema

    def hashed(batches):
        now, audit, sha, some = None, [], None, False
        for batch in batches:
            for r in batch.to_pylist():
                if r["piece"] == 0:
                    now, audit, sha, some = r, [], hashlib.sha256(), False
                audit.append(r["audit"])
                if r["n"]:
                    sha.update((b"\n" if some else b"") + r["lines"].encode())
                    some = True
                if r["piece"] == r["pieces"] - 1:
                    yield {**{k: [now[k]] for k in numbers}, "audit": ["".join(audit)], "repaired_sha256": [sha.hexdigest()]}

    many = flat.where("pieces > 1").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return one.unionByName(_mapped(many, hashed, schema))


def repair_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(materialize(repair(damage(load(spark, sf_dir, "conversations"))), "repair-pieces"))
