"""Packing token sequences by cutting-stock column generation.

Each document is its tokens and an end id. Whole stretches of ``SIZE`` tokens fill sequences of their
own; the remainders (1 to SIZE - 1 tokens) are packed. Their length histogram, of at most SIZE - 1
numbers whatever the table's size, goes to the driver: remainders are grouped into classes whose width grows
with their length (``WIDTHS``; a remainder takes the place of its class's longest), a linear program over
patterns (how many of each class share a sequence) is solved by column generation, a knapsack dynamic
program pricing the next pattern, and its solution is rounded down. What rounding leaves over gets patterns
of its own: the longest remainder left and the knapsack's fullest filling of the rest of the sequence with what is
left. Documents get ranks within their length, and the patterns' slots are ranges of ranks, so every place
follows from (length, rank) by arithmetic.

Only what no pattern of a fill of ``LEAST_FILL`` can hold any more, a few sequences' worth, is laid end to
end and cut wherever a sequence is full; the last, shorter stretch is cut at powers of two, which
need no padding. Null texts are empty (only the end id); repeated rows are packed each; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labormart.llm.common import load, map_batches, materialize
from labormart.llm.tokens import vocabulary_path, worker_tokens

SIZE = 4096
END_ID = 2
#: Tokens that sizes are counted in, and (up to this length, width of the classes): a class wastes about half a
#: hundredth of its length.
UNIT = 2
WIDTHS = ((256, 2), (512, 4), (1024, 8), (2048, 16), (4096, 32))
#: Share of a sequence that the classes of a pattern fill at least.
LEAST_FILL = 0.99
#: Rows of a bucket within which ranks are counted in one task.
BUCKET_ROWS = 50_000
#: Up to so many cut texts, their fingerprints are broadcast to find them among the documents.
BROADCAST_TEXTS = 500_000
#: The linear program stops when its value is proven to be within this share of the optimum.
GAP = 1e-2


def price(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable pattern and how often it has each class."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.argsort(sizes, kind="stable")
    order = order[values[order] > 0]
    s, v = sizes[order], values[order]
    fit = np.searchsorted(s, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if fit[c]:
            got = v[: fit[c]] + best[c - s[: fit[c]]]
            k = int(got.argmax())
            if got[k] > best[c]:
                best[c], choice[c] = got[k], order[k]
    counts, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            counts[choice[c]] += 1
            c -= int(sizes[choice[c]])
    return float(best[capacity]), counts


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int, most: int = 1000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (classes x patterns) and how often to use each, in fractions: the least number of
    sequences that hold the demand of each class. Revised simplex with generated columns."""
    m = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(basis))
    x = inverse @ demand
    for _ in range(most):
        dual = inverse.sum(0)
        value, pattern = price(dual, sizes, capacity)
        if value <= 1 + GAP:
            break
        column = inverse @ pattern
        usable = column > 1e-9
        ratio = np.where(usable, x / np.where(usable, column, 1), np.inf)
        out = int(ratio.argmin())
        step = max(0.0, float(ratio[out]))
        x = x - step * column
        x[out] = step
        row = inverse[out] / column[out]
        inverse -= np.outer(column, row)
        inverse[out] = row
        basis[:, out] = pattern
    return basis.astype(np.int64), np.maximum(x, 0)


def fullest(sizes: np.ndarray, left: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each class fill ``capacity`` the most, with ``left`` of each: a bounded knapsack, a class's number
    being made up of 1, 2, 4 ... at once."""
    most = np.minimum(left, capacity // sizes)
    items = []
    for c in np.flatnonzero(most)[::-1].tolist():  # long ones first: short ones are kept for gaps
        n, k = int(most[c]), 1
        while n > 0:
            items.append((c, min(k, n)))
            n, k = n - k, 2 * k
    filled = np.zeros(capacity + 1, np.int64)
    taken = np.zeros((len(items), capacity + 1), bool)
    last = 0
    for i, (c, k) in enumerate(items):
        weight = int(sizes[c]) * k
        if weight <= capacity:
            more = filled[: capacity + 1 - weight] + weight
            better = more > filled[weight:]
            taken[i, weight:] = better
            filled[weight:] = np.where(better, more, filled[weight:])
        last = i + 1
        if filled[capacity] == capacity:
            break
    counts, at = np.zeros(len(sizes), np.int64), capacity
    for i in reversed(range(last)):
        if taken[i, at]:
            c, k = items[i]
            counts[c] += k
            at -= int(sizes[c]) * k
    return counts


@dataclass
class Plan:
    """Places of all remainders, from their exact length and their rank among those of that length."""

    class_of: np.ndarray  # per length: class
    rank_base: np.ndarray  # per length: rank of its first remainder within the class
    used: np.ndarray  # per class: ranks below this are in patterns
    rest_rank: np.ndarray  # per length: first rank (in the class) that is laid end to end
    rest_at: np.ndarray  # per length: where in that stretch its remainders begin
    ends: list[np.ndarray]  # per class: rank after the last remainder of each length
    lengths: list[np.ndarray]  # per class: those lengths
    ranges: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # per class: first rank, pattern, slots of that class
    patterns: list[list[tuple[int, int, int]]]  # (class, slots, first rank)
    first_sequence: np.ndarray  # per pattern
    rest_sequence: int  # first sequence of the stretch
    rest_tokens: int

    @property
    def bounds(self) -> np.ndarray:
        """Where the sequences of the stretch's last part begin and end (powers of two)."""
        whole = self.rest_tokens // SIZE * SIZE
        left = self.rest_tokens - whole
        return np.cumsum([whole] + [1 << b for b in reversed(range(SIZE.bit_length())) if left >> b & 1])

    @property
    def sequences(self) -> int:
        return self.rest_sequence + self.rest_tokens // SIZE + len(self.bounds) - 1

    def length_at(self, c: int, rank: np.ndarray) -> np.ndarray:
        return self.lengths[c][np.searchsorted(self.ends[c], rank, side="right")]


def class_sizes() -> np.ndarray:
    """Per length (0 to SIZE - 1) the size of its class in units."""
    length = np.arange(SIZE)
    width = np.select([length <= most for most, _ in WIDTHS], [w for _, w in WIDTHS])
    return -(-length // width) * width // UNIT


def plan(histogram: dict[int, int]) -> Plan:
    """``histogram``: remainders by length, 1 to SIZE - 1."""
    n = np.zeros(SIZE, np.int64)
    for length, count in histogram.items():
        n[length] = count
    units = class_sizes()
    present = np.unique(units[n > 0])
    class_of = np.searchsorted(present, units).clip(0, max(0, len(present) - 1))
    rank_base, ends, lengths = np.zeros(SIZE, np.int64), [], []
    for u in present:
        own = np.flatnonzero((units == u) & (n > 0))
        total = np.cumsum(n[own])
        rank_base[own] = total - n[own]
        ends.append(total)
        lengths.append(own)
    capacity = SIZE // UNIT
    used = np.zeros(len(present), np.int64)
    demand = np.array([e[-1] for e in ends], np.int64)
    patterns, times = [], []

    def use(counts: np.ndarray, copies: int) -> None:
        patterns.append([(int(c), int(counts[c]), int(used[c])) for c in np.flatnonzero(counts)])
        times.append(copies)
        used[:] += copies * counts

    if len(present):
        columns, x = solve(present, demand.astype(float), capacity)
        for j in np.argsort(-x, kind="stable"):
            column = columns[:, j]
            some = column > 0
            copies = min(int(x[j] + 1e-6), int(((demand - used)[some] // column[some]).min(initial=0)))
            if copies > 0 and int((present * column).sum()) >= LEAST_FILL * capacity:
                use(column, copies)
        hopeless = np.zeros(len(present), bool)
        while int((present * (left := np.where(hopeless, 0, demand - used))).sum()) >= LEAST_FILL * capacity:
            longest = int(np.flatnonzero(left)[-1])
            left[longest] -= 1
            counts = fullest(present, left, capacity - int(present[longest]))
            counts[longest] += 1
            if int((present * counts).sum()) < LEAST_FILL * capacity:
                hopeless[longest] = True  # nothing left fills a sequence with one of these
                continue
            some = counts > 0
            use(counts, int(((demand - used)[some] // counts[some]).min()))
    ranges = []
    for c in range(len(present)):
        own = [(first, j, a) for j, slots in enumerate(patterns) for k, a, first in slots if k == c]
        own.sort()
        ranges.append(tuple(np.array(z, np.int64) for z in (zip(*own, strict=True) if own else ((), (), ()))))
    rest_rank, rest_at, at = np.zeros(SIZE, np.int64), np.zeros(SIZE, np.int64), 0
    for c in range(len(present)):
        for length in lengths[c]:
            first = max(int(used[c]), int(rank_base[length]))
            rest_rank[length], rest_at[length] = first, at
            at += max(0, int(rank_base[length] + n[length]) - first) * int(length)
    first_sequence = np.cumsum([0, *times])
    return Plan(class_of, rank_base, used, rest_rank, rest_at, ends, lengths, ranges, patterns, first_sequence[:-1], int(first_sequence[-1]), at)


def place(p: Plan, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each remainder in a pattern; (-1, place in the stretch) of the others.
    The third array is True for those in a pattern."""
    c = p.class_of[length]
    r = p.rank_base[length] + rank
    inside = r < p.used[c]
    sequence, offset = np.full(len(length), -1, np.int64), p.rest_at[length] + (r - p.rest_rank[length]) * length
    pattern, copy, slot = (np.zeros(len(length), np.int64) for _ in range(3))
    for k in np.unique(c[inside]):
        rows = np.flatnonzero(inside & (c == k))
        first, which, slots = p.ranges[k]
        j = np.searchsorted(first, r[rows], side="right") - 1
        pattern[rows] = which[j]
        copy[rows], slot[rows] = np.divmod(r[rows] - first[j], slots[j])
    for j in np.unique(pattern[inside]):
        rows = np.flatnonzero(inside & (pattern == j))
        q = copy[rows]
        sequence[rows] = p.first_sequence[j] + q
        at = np.zeros(len(rows), np.int64)
        for k, slots, first in p.patterns[j]:
            mine = c[rows] == k
            for t in range(slots):
                here = mine & (slot[rows] == t)
                offset[rows[here]] = at[here]
                at += p.length_at(k, first + q * slots + t)
    return sequence, offset, inside


def cut_points(p: Plan, at: int, length: int, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(start, length, sequence, offset) of the pieces of a remainder that lies at ``at`` in the stretch."""
    out, pos, end = [], at, at + length
    while pos < end:
        if pos < bounds[0]:
            s, offset, stop = pos // SIZE, pos % SIZE, (pos // SIZE + 1) * SIZE
        else:
            k = int(np.searchsorted(bounds, pos, side="right")) - 1
            s, offset, stop = int(bounds[0]) // SIZE + k, pos - int(bounds[k]), int(bounds[k + 1])
        n = min(end, stop) - pos
        out.append((pos - at, n, p.rest_sequence + s, offset))
        pos += n
    return out


def lengths_table(docs: DataFrame, path: str) -> DataFrame:
    """Per row: its own number, a fingerprint of id and text, its token count, and the crc of each
    whole stretch and of the remainder."""
    get = worker_tokens(docs.sparkSession, path)
    tail = END_ID.to_bytes(4, "little")

    def run(batch) -> dict:
        ids = [x + tail for x in get().encode_all([t or "" for t in batch.column("text").to_pylist()])]
        crc = [[zlib.crc32(x[i : i + 4 * SIZE]) for i in range(0, len(x), 4 * SIZE)] for x in ids]
        return {"uid": batch.column("uid"), "doc_id": batch.column("doc_id"), "fp": batch.column("fp"), "fp2": batch.column("fp2"), "n": [len(x) // 4 for x in ids], "crcs": crc}

    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", *_fingerprints(), "text")
    return materialize(map_batches(rows, run, "uid long, doc_id long, fp long, fp2 long, n long, crcs array<long>"), "pack-lengths")


def _fingerprints() -> list:
    """Two hashes of id and text, by which a row's text is found again."""
    return [F.xxhash64("doc_id", "text").alias("fp"), F.xxhash64(F.lit(1), "doc_id", "text").alias("fp2")]


def ranked(lengths: DataFrame, buckets: int) -> DataFrame:
    """Adds each row's rank among the remainders of its length, and how many whole stretches stand
    before its own: counted within buckets, then the buckets before are added. The sums over the buckets
    are taken in one task, over a row per ``BUCKET_ROWS`` documents."""
    rows = lengths.withColumns({"bucket": F.pmod(F.xxhash64("uid"), F.lit(buckets)).cast("int"), "rem": (F.col("n") % SIZE).cast("int"), "whole": F.floor(F.col("n") / SIZE)})
    by_length = rows.groupBy("rem", "bucket").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("rem").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    by_length = by_length.select("rem", "bucket", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("rank_before"))
    by_bucket = rows.groupBy("bucket").agg(F.sum("whole").alias("w"))
    by_bucket = by_bucket.select("bucket", F.coalesce(F.sum("w").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("whole_before"))
    own = Window.partitionBy("bucket").orderBy("uid").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "rank_in": F.row_number().over(Window.partitionBy("bucket", "rem").orderBy("uid")) - 1,
        "whole_in": F.coalesce(F.sum("whole").over(own), F.lit(0)),
    })
    return rows.join(by_length, ["rem", "bucket"]).join(by_bucket, "bucket").select(
        "uid", "doc_id", "fp", "fp2", "n", "crcs", (F.col("rank_in") + F.col("rank_before")).alias("rank"), (F.col("whole_in") + F.col("whole_before")).alias("whole_before"))


PIECE = "uid long, fp long, fp2 long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def placed(rows: DataFrame, p: Plan) -> DataFrame:
    """All pieces; those of remainders that had to be cut still lack their crc."""
    shared = rows.sparkSession.sparkContext.broadcast(p)

    def run(batch) -> dict:
        p = shared.value
        n, rank, before = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "rank", "whole_before"))
        bounds, total = p.bounds, p.sequences
        uid, fp, fp2, doc, crcs = (batch.column(c).to_pylist() for c in ("uid", "fp", "fp2", "doc_id", "crcs"))
        rem = n % SIZE
        has = np.flatnonzero(rem)
        sequence, offset, inside = (np.zeros(len(n), kind) for kind in (np.int64, np.int64, bool))
        sequence[has], offset[has], inside[has] = place(p, rem[has], rank[has])
        out = []
        for i in range(len(n)):
            full = int(n[i]) // SIZE
            head = (uid[i], fp[i], fp2[i], doc[i])
            out += [(*head, k * SIZE, SIZE, crcs[i][k], int(n[i]), total + int(before[i]) + k, 0) for k in range(full)]
            if rem[i] and inside[i]:
                out.append((*head, full * SIZE, int(rem[i]), crcs[i][full], int(n[i]), int(sequence[i]), int(offset[i])))
            elif rem[i]:
                pieces = cut_points(p, int(offset[i]), int(rem[i]), bounds)
                for start, length, s, o in pieces:
                    out.append((*head, full * SIZE + start, length, crcs[i][full] if len(pieces) == 1 else None, int(n[i]), s, o))
        names = [x.split()[0] for x in PIECE.split(", ")]
        return dict(zip(names, map(list, zip(*out, strict=True)), strict=True)) if out else {k: [] for k in names}

    return materialize(map_batches(rows, run, PIECE, rows=1 << 20), "pack-placed")


def cut_crcs(docs: DataFrame, cut: DataFrame, path: str) -> DataFrame:
    """crc of each cut piece (fp, fp2, start, length): the texts concerned are encoded once more."""
    get = worker_tokens(docs.sparkSession, path)
    tail = END_ID.to_bytes(4, "little")
    wanted = materialize(cut.groupBy("fp", "fp2").agg(F.collect_set(F.struct("start", "length")).alias("pieces")), "pack-cut")
    keys = wanted.select("fp", "fp2")
    few = wanted.count() <= BROADCAST_TEXTS
    texts = docs.select(*_fingerprints(), "text").join(F.broadcast(keys) if few else keys, ["fp", "fp2"], "left_semi")
    # Rows of one pair of fingerprints have one text: a null text is an empty one.
    one = texts.groupBy("fp", "fp2").agg(F.max(F.coalesce("text", F.lit(""))).alias("text"))

    def run(batch) -> dict:
        out = []
        for fp, fp2, x, pieces in zip(batch.column("fp").to_pylist(), batch.column("fp2").to_pylist(), get().encode_all(batch.column("text").to_pylist()), batch.column("pieces").to_pylist(), strict=True):
            x += tail
            out += [(fp, fp2, q["start"], q["length"], zlib.crc32(x[4 * q["start"] : 4 * (q["start"] + q["length"])])) for q in pieces]
        return dict(zip(("fp", "fp2", "start", "length", "crc"), map(list, zip(*out, strict=True)), strict=True))

    return map_batches(one.join(wanted, ["fp", "fp2"]), run, "fp long, fp2 long, start long, length long, crc long")


def pack(docs: DataFrame, path: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    lengths = lengths_table(docs, path)
    histogram = {r["rem"]: r["c"] for r in lengths.groupBy((F.col("n") % SIZE).alias("rem")).agg(F.count(F.lit(1)).alias("c")).collect()}
    buckets = max(1, -(-sum(histogram.values()) // BUCKET_ROWS))
    histogram.pop(0, None)
    pieces = placed(ranked(lengths, buckets), plan(histogram))
    crcs = cut_crcs(docs, pieces.where(F.col("ids_crc32").isNull()), path)
    cut = pieces.where(F.col("ids_crc32").isNull()).drop("ids_crc32").join(crcs.withColumnRenamed("crc", "ids_crc32"), ["fp", "fp2", "start", "length"])
    return pieces.where(F.col("ids_crc32").isNotNull()).unionByName(cut).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents"), vocabulary_path())
