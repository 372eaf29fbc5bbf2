"""N-gram Jaccard join by set-relation skipping, and the connected groups of its links.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z folded; a document's set are its distinct shingles of ``words`` words (all
its words as one, if it has fewer). Equal sets form a class. Two classes link when their Jaccard similarity
reaches ``percent`` hundredths; every step below is exact.

Shingles are ordered by their hashes, those that are frequent in the corpus last. Two sets that reach a
similarity share a shingle within a prefix of this order, whose place in both also bounds what they can share.

1. *Relations.* A class whose set reaches ``RELATED`` hundredths of that of its hub (the least class with the same
   first shingle) is a member of it; the others are leaders. A member is stored as its difference from the leader.
2. *Index.* Only leaders are posted. By the triangle inequality of Jaccard distance, two sets link only
   if their leaders reach ``percent`` less the distance (100 - RELATED) of each that has members. Within a posting
   list, ordered by set size, the place of a shingle bounds the sizes that a partner may have; the rest of the list is
   skipped. Lists of frequent shingles, and lists beyond ``LONG`` leaders, are compared block by block on the
   full sets: a leader's overlaps with a block are taken over from the leader before it, and only the lists of
   shingles in which the two differ are read, if that is less. A block gives links that connect something new,
   never its pairs.
3. *Derived answers.* Leaders that reach ``percent`` link with all their members. Where they reach less, the members'
   overlaps follow from the leaders' overlap and the stored differences.

Pairs are compared only while their sides are not known to be connected. Null and empty texts and texts
without words have an empty set and link with nothing; rows without an id take part, and a component's id is its
least id that is not null (null if it has none; a row without words: its own id); repeated rows are one class; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labormart.llm.blocks import PAIR, dealt
from labormart.llm.common import _array, _arrow_schema, give_back, load, map_batches, materialize, ship_package, signed, text_bytes
from labormart.llm.components import components
from labormart.llm.minhash import _key_id, _text_keys, set_table, shingle_sets

RELATED, LONG = 96, 32
#: Numbers of up to so many classes are broadcast to find their rows.
BROADCAST_CLASSES = 500_000
#: Documents whose shingles are counted at once, and shingles that are kept apart until they are merged.
COUNT_ROWS, COUNT_SHINGLES = 1000, 2_000_000
#: A shingle is frequent if so many documents have it (as far as they are counted); of more than MOST_FREQUENT,
#: the most frequent ones are. Only the order of shingles rests on this, and so the length of posting lists.
LEAST_FREQUENT, MOST_FREQUENT = 16, 1_000_000
MEMBER_BLOCK = 512


def needed(percent, a, b):
    """Shingles that sets of a and b shingles share at least, if they reach ``percent`` hundredths."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(percent, n):
    """Of two sets that reach ``percent``, each has a shared shingle among so many of its first."""
    return n - -(-percent * n // 100) + 1


def frequent_shingles(docs: DataFrame, words: int, least: int, lowest: int) -> np.ndarray:
    """Frequent shingles, sorted: counted in each task, then over all tasks. A prefix holds about the
    ``100 - lowest`` hundredths of a set that have the least hashes, so shingles far beyond need no count. A
    task leaves out what it sees once (and, of very many, what it has seen once so far)."""
    below = np.uint64(min(1.5 * (1 - lowest / 100), 0.999) * 2**64)

    def merged(keys, counts):
        keys, at = np.unique(np.concatenate(keys), return_inverse=True)
        return keys, np.bincount(at, np.concatenate(counts), len(keys)).astype(np.int64)

    def run(batches):
        keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for batch in batches:
            for i in range(0, batch.num_rows, COUNT_ROWS):
                sets = shingle_sets(text_bytes(batch.column("text").slice(i, COUNT_ROWS)), words)
                k, c = np.unique(np.concatenate([s[: np.searchsorted(s, below)] for s in sets]), return_counts=True)
                keys.append(k)
                counts.append(c)
                if sum(map(len, keys[1:])) > COUNT_SHINGLES:
                    k, c = merged(keys, counts)
                    keys, counts = ([k], [c]) if len(k) <= 2 * COUNT_SHINGLES else ([k[c > 1]], [c[c > 1]])
        k, c = merged(keys, counts)
        k, c = k[c > 1], c[c > 1]
        del keys, counts
        give_back()
        for i in range(0, len(k), 1 << 16):
            yield pa.RecordBatch.from_pydict({"key": signed(k[i : i + (1 << 16)]), "c": c[i : i + (1 << 16)]})

    ship_package(docs.sparkSession)
    found = docs.select("text").mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c")).where(F.col("c") >= least)
    return np.sort(found.orderBy(F.desc("c"), "key").limit(MOST_FREQUENT).select("key").toArrow()["key"].to_numpy().view(np.uint64))


def in_order(s: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """A sorted set with its frequent shingles last."""
    if not len(frequent):
        return s
    late = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s
    return np.concatenate((s[~late], s[late]))


def features(docs: DataFrame, words: int, least: int, frequent) -> DataFrame:
    """Per row: a number of its own, id, set size, set fingerprint, and the longest prefix ever asked for."""

    def run(batch) -> dict:
        out: dict = {k: [] for k in ("n", "fp", "key0", "pre")}
        for i in range(0, batch.num_rows, COUNT_ROWS):
            for s in shingle_sets(text_bytes(batch.column("text").slice(i, COUNT_ROWS)), words):
                first = in_order(s, frequent.value)[: prefix_length(least, len(s))] if len(s) else s
                out["n"].append(len(s))
                out["fp"].append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                out["key0"].append(int(signed(first[:1])[0]) if len(s) else None)
                out["pre"].append(first.tobytes() if len(s) else None)
        give_back()
        return {**{c: batch.column(c) for c in ("uid", "doc_id", "h1", "h2")}, **out}

    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text", *_text_keys())
    return materialize(map_batches(rows, run, "uid long, doc_id long, h1 long, h2 long, n long, fp binary, key0 long, pre binary"), "join-rows")


def _sets(column) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def shared(x: np.ndarray, y: np.ndarray) -> int:
    """Shingles of the sorted set y that x has too."""
    if not len(x) or not len(y):
        return 0
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[at] == x).sum())


def _both(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """Pairs with columns of either side. A class may be in many pairs: sort-merge joins can be split."""
    for side in "ab":
        own = table.select(F.col("cls").alias(side), *[F.col(c).alias(c + side) for c in columns])
        pairs = pairs.join(own.hint("merge"), side)
    return pairs


def promising(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b, t) whose prefixes share as much as a similarity of t hundredths asks for."""

    def run(batch) -> dict:
        na, nb, t = (batch.column(c).to_numpy() for c in ("na", "nb", "t"))
        least = needed(t, na, nb)
        keep = []
        for x, y, p, q, m in zip(_sets(batch.column("prea")), _sets(batch.column("preb")), na.tolist(), nb.tolist(), least.tolist(), strict=True):
            keep.append(shared(x, np.sort(y)) >= min(len(x) - p, len(y) - q) + m)
        kept = batch.select(["a", "b", "t"]).filter(pa.array(keep, pa.bool_()))
        return {c: kept.column(c) for c in ("a", "b", "t")}

    near = _both(pairs, classes, "n", "pre").where("100 * least(na, nb) >= t * greatest(na, nb)")
    return materialize(map_batches(near, run, "a long, b long, t int"), "join-promising")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """Pairs that reach their t on the full sets, with the overlap ``o``, the similarity's floor in hundredths ``j``, and
    for related pairs what b adds to a and what it leaves out; and the full sets."""
    kind = "a long, b long, t int, o long, j long, na long, nb long, add binary, rem binary"
    if pairs.isEmpty():
        return pairs.sparkSession.createDataFrame([], kind), pairs.sparkSession.createDataFrame([], "cls long, s binary")
    ends = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    table = set_table(ends, classes, docs, words)

    def run(batch) -> dict:
        out: dict = {k: [] for k in ("a", "b", "t", "o", "j", "na", "nb", "add", "rem")}
        for a, b, t, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "t")), _sets(batch.column("sa")), _sets(batch.column("sb")), strict=True):
            if 100 * min(len(x), len(y)) < t * max(len(x), len(y)):
                continue
            o = shared(x, y)
            j = 100 * o // (len(x) + len(y) - o)
            if j >= t:
                near = j >= RELATED
                row = (a, b, t, o, j, len(x), len(y), np.setdiff1d(y, x, True).tobytes() if near else None, np.setdiff1d(x, y, True).tobytes() if near else None)
                for k, v in zip(out, row, strict=True):
                    out[k].append(v)
        return out

    both = _both(pairs, table, "s")
    return materialize(map_batches(both, run, kind), "join-verified"), table


def postings(leaders: DataFrame, percent: int, frequent, hot: bool) -> DataFrame:
    """(key, cls, n, pos, r) of the leaders' prefixes; of frequent shingles, or of the others."""

    def run(batch) -> dict:
        n, r, cls = (batch.column(c).to_numpy() for c in ("n", "r", "cls"))
        size = prefix_length(percent - r - (100 - RELATED), n)
        pre = [x[:k] for x, k in zip(_sets(batch.column("pre")), size.tolist(), strict=True)]
        size = np.array([len(x) for x in pre])
        keys = np.concatenate(pre)
        late = frequent.value[np.minimum(np.searchsorted(frequent.value, keys), len(frequent.value) - 1)] == keys if len(frequent.value) else np.zeros(len(keys), bool)
        pos = np.arange(len(keys)) - np.repeat(np.cumsum(size) - size, size)
        keep = late == hot
        return {"key": signed(keys)[keep], "pos": pos[keep].astype(np.int32), **{k: np.repeat(v, size)[keep] for k, v in (("cls", cls), ("n", n.astype(np.int32)), ("r", r))}}

    return map_batches(leaders.select("cls", "n", "r", "pre"), run, "key long, cls long, n int, pos int, r int")


def skipping_pairs(rows: dict, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, t) of one batch of whole posting lists, each ordered by size.

    Going down the list from each entry, the first partner too large for its size and place ends the walk.
    """
    key, cls, n, pos, r = (rows[k].astype(np.int64) for k in ("key", "cls", "n", "pos", "r"))
    wide = 100 - RELATED
    # With the least similarity that any partner may be asked for, shingles behind this place bound the partner's size.
    low = percent - r - wide
    most = np.minimum(100 * n // low, (100 + low) * (n - pos) // low - n)
    at, a, b, t = np.arange(len(key)), [], [], []
    for d in range(1, len(key)):
        at = at[at + d < len(key)]
        at = at[(key[at + d] == key[at]) & (n[at + d] <= most[at])]
        if not len(at):
            break
        i, j = at, at + d
        tau = percent - r[i] - r[j]
        ok = (np.minimum(n[i] - pos[i], n[j] - pos[j]) >= needed(tau, n[i], n[j])) & (100 * n[i] >= tau * n[j])
        i, j = i[ok], j[ok]
        a.append(np.minimum(cls[i], cls[j]))
        b.append(np.maximum(cls[i], cls[j]))
        t.append(tau[ok])
    empty = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(x or empty) for x in (a, b, t))


def probe(posted: DataFrame, percent: int, long_: int) -> DataFrame:
    """Pairs (a, b, t) of the lists of up to ``long_`` entries, and the longer lists' entries (key, a, n, pos, r)."""
    ship_package(posted.sparkSession)
    kind = "key long, a long, b long, t int, n int, pos int, r int"
    schema = _arrow_schema(kind)
    names = ("key", "cls", "n", "pos", "r")

    def out(**cols):
        size = len(next(iter(cols.values())))
        return pa.RecordBatch.from_arrays([_array(cols[f.name], f.type) if f.name in cols else pa.nulls(size, f.type) for f in schema], schema=schema)

    def run(batches):
        rest, too_long = {k: np.zeros(0, np.int64) for k in names}, None
        for batch in batches:
            rows = {k: np.concatenate((rest[k], batch.column(k).to_numpy())) for k in names}
            last = rows["key"][-1] if len(rows["key"]) else None
            whole = rows["key"] != last
            yield from lists({k: v[whole] for k, v in rows.items()}, too_long)
            rest = {k: v[~whole] for k, v in rows.items()}
            if last is not None and last != too_long:
                too_long = None
            if len(rest["key"]) > long_ or (len(rest["key"]) and last == too_long):
                too_long = last
                yield out(key=rest["key"], a=rest["cls"], n=rest["n"], pos=rest["pos"], r=rest["r"])
                rest = {k: v[:0] for k, v in rest.items()}
        yield from lists(rest, too_long)

    def lists(rows, too_long):
        """Whole lists; what is left of a long one goes the way of its beginning."""
        if not len(rows["key"]):
            return
        first = np.flatnonzero(np.concatenate(([True], rows["key"][1:] != rows["key"][:-1])))
        length = np.diff(np.append(first, len(rows["key"])))
        far = np.repeat((length > long_) | ((rows["key"][first] == too_long) if too_long is not None else False), length)
        if far.any():
            yield out(key=rows["key"][far], a=rows["cls"][far], n=rows["n"][far], pos=rows["pos"][far], r=rows["r"][far])
        several = np.repeat(length > 1, length) & ~far
        a, b, t = skipping_pairs({k: v[several] for k, v in rows.items()}, percent)
        for i in range(0, len(a), 1 << 16):
            yield out(a=a[i : i + (1 << 16)], b=b[i : i + (1 << 16)], t=t[i : i + (1 << 16)].astype(np.int32))

    return posted.repartition("key").sortWithinPartitions("key", "n", "cls").mapInArrow(run, kind)


def block_links(left: dict, right: dict, same: bool, percent: int) -> tuple[list, int, int]:
    """Links of two blocks of leaders that connect components which this block has not connected yet, and
    pairs with members that come within their members' reach of a link: (a, b, t, overlap, linked).

    The overlaps with all sets on the right are counted through the right's shingle lists, or derived from
    the overlaps of the leader before, whichever reads less. Also returned: how many sets' overlaps were
    derived, and how many counted from nothing.
    """
    size = right["n"]
    tokens = np.concatenate(right["s"])
    order = np.argsort(tokens, kind="stable")
    tokens, holder = tokens[order], np.repeat(np.arange(len(size)), size)[order]

    def counts(x: np.ndarray) -> np.ndarray:
        """How many of the shingles x each set on the right has."""
        a, b = np.searchsorted(tokens, x, "left"), np.searchsorted(tokens, x, "right")
        many = b - a
        at = np.repeat(a - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        return np.bincount(holder[at], minlength=len(size))

    # Components by number; a link gives both sides' rows one number.
    own, there = left["root"].copy(), right["root"].copy()
    found, near, derived, fresh, before, held = [], [], 0, 0, None, None
    for i in np.lexsort((left["cls"], left["n"], left["root"])).tolist():
        x = left["s"][i]
        if before is not None:
            more, less = np.setdiff1d(x, before, True), np.setdiff1d(before, x, True)
        if before is not None and len(more) + len(less) < len(x):
            held, derived = held + counts(more) - counts(less), derived + 1
        else:
            held, fresh = counts(x), fresh + 1
        before = x
        tau = percent - left["r"][i] - right["r"]
        # In one block both sides are the same rows: each pair is met from its first.
        apart = (there != own[i]) & (right["cls"] > left["cls"][i]) if same else there != own[i]
        within = apart & (held >= needed(tau, len(x), size))
        link = held >= needed(percent, len(x), size)
        while (hit := np.flatnonzero(within & link & (there != own[i]))).size:
            j = int(hit[0])
            found.append((int(left["cls"][i]), int(right["cls"][j]), int(tau[j]), int(held[j]), True))
            old, new = there[j], own[i]
            own[own == old] = new
            there[there == old] = new
        near += [(i, int(j), int(tau[j]), int(held[j])) for j in np.flatnonzero(within & ~link)]
    found += [(int(left["cls"][i]), int(right["cls"][j]), t, o, False) for i, j, t, o in near if own[i] != there[j]]
    return found, derived, fresh


_FOUND = "a long, b long, t int, o long, linked boolean"


def long_links(entries: DataFrame, leaders: DataFrame, classes: DataFrame, roots: DataFrame, docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links within the long lists (see :func:`block_links`), and the full sets of their leaders. Lists within one
    component are left out, lists with the same least member are put together (each leader once); they are cut by
    set size, and sizes that cannot link never meet."""
    spark = entries.sparkSession
    lowest = percent - 2 * (100 - RELATED)
    named = entries.join(roots.withColumnRenamed("v", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    lists = named.groupBy("key").agg(F.min("cls").alias("hub"), F.min("root").alias("r0"), F.max("root").alias("r1"))
    # Lists with one least member are compared as one: near sets share many lists, with about the same members.
    mixed = materialize(lists.where("r0 < r1").select("key", "hub"), "join-mixed")
    named = materialize(named.join(mixed.hint("merge"), "key").select("hub", "cls", "n", "root").distinct(), "join-active")
    if named.isEmpty():
        return spark.createDataFrame([], _FOUND), spark.createDataFrame([], "cls long, s binary")
    sets = set_table(named.select("cls").distinct(), classes, docs, words)
    rows = dealt(named, lowest).join(leaders.select("cls", "r").join(sets, "cls").hint("merge"), "cls")

    def compare(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        cols = {k: table[k].to_numpy().astype(np.int64) for k in ("cls", "root", "r")}
        own = np.empty(len(side), object)
        own[:] = _sets(table["s"])
        cols["n"] = np.array([len(x) for x in own])
        halves = [{**{k: v[side == k0] for k, v in cols.items()}, "s": own[side == k0]} for k0 in (0, 1)]
        same = not (side == 1).any()
        found = block_links(halves[0], halves[0] if same else halves[1], same, percent)[0]
        give_back()
        a, b, t, o, linked = zip(*found, strict=True) if found else ((), (), (), (), ())
        return pa.table({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64()), "t": pa.array(t, pa.int32()),
                         "o": pa.array(o, pa.int64()), "linked": pa.array(linked, pa.bool_())})

    found = rows.groupBy(*PAIR).applyInArrow(compare, _FOUND).distinct()
    return materialize(found, "join-long"), sets


def derived_links(pairs: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Which pairs of leaders (a, b, o) link by some of their members, although the leaders do not."""
    size = members.groupBy(F.col("a").alias("cls")).agg(F.ceil(F.count(F.lit(1)) / MEMBER_BLOCK).cast("int").alias("blocks"))
    nothing = F.lit(b"")
    kin = members.join(size, members["a"] == size["cls"]).select("cls", "blocks", F.expr("pmod(xxhash64(b), blocks)").cast("int").alias("block"), "add", "rem")
    ends = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    itself = ends.join(size, "cls", "left").select("cls", F.coalesce("blocks", F.lit(1)).alias("blocks"))
    # The leader itself is a member without a difference.
    kin = kin.unionByName(itself.select("cls", "blocks", F.lit(0).alias("block"), nothing.alias("add"), nothing.alias("rem")))
    count = itself.select("cls", "blocks")
    met = pairs.select("a", "b").join(count.select(F.col("cls").alias("a"), F.col("blocks").alias("m")), "a").join(count.select(F.col("cls").alias("b"), F.col("blocks").alias("k")), "b")
    met = materialize(met.withColumn("i", F.explode(F.expr("sequence(0, m - 1)"))).withColumn("j", F.explode(F.expr("sequence(0, k - 1)"))).drop("m", "k"), "join-kin")
    table = None
    for side, cls, block in ((0, "a", "i"), (1, "b", "j")):
        at = met.withColumn("cls", F.col(cls))
        rows = at.withColumn("block", F.col(block)).join(kin, ["cls", "block"]).select("a", "b", "i", "j", F.lit(side).alias("side"), "add", "rem", F.lit(None).cast("binary").alias("s"))
        rows = rows.unionByName(at.join(sets, "cls").select("a", "b", "i", "j", F.lit(side).alias("side"), nothing.alias("add"), nothing.alias("rem"), "s"))
        table = rows if table is None else table.unionByName(rows)

    def derive(t: pa.Table) -> pa.Table:
        rows = t.to_pylist()
        y, w = (next(np.frombuffer(r["s"], np.uint64) for r in rows if r["side"] == k and r["s"] is not None) for k in (0, 1))
        kin = [[(np.frombuffer(r["add"], np.uint64), np.frombuffer(r["rem"], np.uint64)) for r in rows if r["side"] == k and r["s"] is None] for k in (0, 1)]
        hit = linked_by_members(y, w, *kin, percent)
        return pa.table({"a": pa.array([rows[0]["a"]] * hit, pa.int64()), "b": pa.array([rows[0]["b"]] * hit, pa.int64())})

    return materialize(table.groupBy("a", "b", "i", "j").applyInArrow(derive, "a long, b long").distinct(), "join-derived")


def linked_by_members(y, w, left, right, percent: int) -> bool:
    """Whether a member of y and a member of w link. Members are (added, left out) of their leader's sorted set."""
    both = shared(y, w)
    for add, rem in left:
        n = len(y) + len(add) - len(rem)
        with_w = both + shared(add, w) - shared(rem, w)
        for more, less in right:
            m = len(w) + len(more) - len(less)
            least = needed(percent, n, m)
            if with_w + len(more) < least:
                continue
            # The overlap of the leader w with this member, put right where w's member differs from w.
            o = with_w + shared(more, y) + shared(more, add) - shared(more, rem) - (shared(less, y) + shared(less, add) - shared(less, rem))
            if o >= least:
                return True
    return False


def jaccard_groups(docs: DataFrame, words: int = 5, percent: int = 80, least: int = LEAST_FREQUENT, long_: int = LONG) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, and leader_set (the fingerprint of the row's set; equal sets are one class)."""
    sc = docs.sparkSession.sparkContext
    if percent <= 2 * (100 - RELATED):
        raise ValueError("too low a similarity")
    lowest = percent - 2 * (100 - RELATED)
    frequent = sc.broadcast(frequent_shingles(docs, words, least, lowest))
    rows = features(docs, words, lowest, frequent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id")).alias("first")
    sets = materialize(rows.where("n > 0").groupBy("fp").agg(F.min("uid").alias("cls"), first), "join-classes")
    first_rows = sets.select(F.col("cls").alias("uid"))
    first_rows = F.broadcast(first_rows) if sets.count() <= BROADCAST_CLASSES else first_rows
    classes = materialize(rows.join(first_rows, "uid", "left_semi").select(F.col("uid").alias("cls"), _key_id(), "h1", "h2", "n", "key0", "pre"), "join-sets")

    hubs = classes.groupBy("key0").agg(F.count(F.lit(1)).alias("c"), F.min("cls").alias("a")).where("c > 1").select("key0", "a")
    spokes = classes.select("key0", F.col("cls").alias("b")).join(hubs.hint("merge"), "key0").where("a <> b").select("a", "b", F.lit(percent).alias("t"))
    spokes, _ = verified(promising(spokes, classes), classes, docs, words)
    links = spokes.select("a", "b")
    members = spokes.where(F.col("j") >= RELATED)
    leading = members.select(F.col("a").alias("cls")).distinct().withColumn("r", F.lit(100 - RELATED))
    leaders = classes.join(members.select(F.col("b").alias("cls")), "cls", "left_anti").join(leading, "cls", "left").select("cls", "n", "pre", F.coalesce("r", F.lit(0)).alias("r"))
    leaders = materialize(leaders, "join-leaders")

    roots = components(links)
    found = materialize(probe(postings(leaders, percent, frequent, False), percent, long_), "join-probe")
    pairs = found.where("b is not null").select("a", "b", "t").distinct()
    near, near_sets = verified(promising(_apart(pairs, roots), classes), classes, docs, words)
    links = links.unionByName(near.where(F.col("j") >= percent).select("a", "b"))
    roots = components(links)

    entries = found.where("b is null").select("key", F.col("a").alias("cls"), "n").unionByName(postings(leaders, percent, frequent, True).select("key", "cls", "n"))
    far, far_sets = long_links(entries, leaders, classes, roots, docs, words, percent)
    if not far.where("linked").isEmpty():
        links = links.unionByName(far.where("linked").select("a", "b"))
        roots = components(links)
    frequent.destroy()

    close = near.where(F.col("j") < percent).select("a", "b", "t").unionByName(far.where("not linked").select("a", "b", "t"))
    close = materialize(_apart(close, roots), "join-close")
    if not close.isEmpty():
        every = near_sets.unionByName(far_sets).dropDuplicates(["cls"])
        links = links.unionByName(derived_links(close, members, every, percent))
        roots = components(links)

    named = sets.join(roots.withColumnRenamed("v", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    best = named.groupBy("root").agg(F.min("first").alias("best"))
    named = named.join(best, "root").select("fp", F.col("best.doc_id").alias("component"))
    out = rows.select("doc_id", "n", "fp").join(named, "fp", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"), F.hex("fp").alias("leader_set"))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b, t) whose sides are not yet known to be connected."""
    for side in "ab":
        pairs = pairs.join(roots.select(F.col("v").alias(side), F.col("root").alias("root_" + side)).hint("merge"), side, "left")
    return pairs.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b", "t")


def set_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(load(spark, sf_dir, "documents"), words=4, percent=85).drop("leader_set")
