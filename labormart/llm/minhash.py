"""MinHash near-duplicate detection by a signature-coordinate inverted join.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z folded; a document's set are its distinct shingles of
``words`` successive words (all its words as one shingle if it has fewer). Rows with equal sets form
a class, and classes are linked when their Jaccard similarity reaches ``percent`` hundredths.

A class's signature has ``K`` coordinates; two linked classes agree in at least ``matches(percent)``
of them but for a chance below ``MISS``. Coordinate-value pairs are ordered, very frequent ones last,
and each class is posted under its first ``prefix(percent)`` pairs only: classes that agree in that many
coordinates share at least ``shared(percent)`` of those. The long lists at the end of the order are skipped, and their
coordinates are counted on the signatures of the pairs that remain. Pairs with enough matches are
confirmed on the full sets, but not where both sides are known to be connected.

What grows with pairs or copies (signatures and texts of pairs, sets of blocks) is dealt with in passes over a bounded
share of it, and each table is deleted when nothing reads it any more: the disk taken stays in proportion to the
classes, however many pairs they form.

* Lists of up to ``SMALL`` classes are joined with themselves.
* In longer lists all classes are first paired with two of the list's members. Only lists whose
  classes are still in several components after that are compared in full: lists with one least member
  together, block by block (``blocks.dealt``). Pairs with enough matches are confirmed on the full sets there
  and then, unless the block has connected their components already, so a block gives links, never its pairs.

Null and empty texts and texts without words have an empty set and are linked with nothing; null
ids take part, a component's id is its least id that is not null (a row without words: its own id);
repeated rows are one class; an empty table gives an empty result. ``copies`` names rows, not ids.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labormart.llm.blocks import BLOCK, BLOCK_SHINGLES, PAIR, dealt
from labormart.llm.common import (
    constants, drop_others, drop_tables, give_back, gram_hash, hash_words, load, map_batches, materialize, mix, scratch_list,
    ship_package, text_bytes,
)
from labormart.llm.components import components

K, SHARED, MISS = 64, 6, 1e-6
SMALL = 32
#: A coordinate-value pair is very frequent above this share of all classes (and LEAST_FREQUENT):
#: there are at most K / share such pairs, which bounds what is broadcast.
FREQUENT_SHARE, LEAST_FREQUENT = 1 / 20_000, 16
#: Sets of up to this many classes are looked up in the documents by a broadcast of their ids.
BROADCAST_CLASSES = 500_000
#: A long list's second member is the first by one of so many orders, chosen by the list's key: a class that shares
#: many lists with the same others is paired with few of them.
ORDERS = 4
#: Pairs whose signatures are compared in one pass: so many for each class, and at least.
MATCHED_SHARE, LEAST_MATCHED = 2, 500_000
#: Pairs that are confirmed in one pass: this share of the classes, but at least and at most so many (their ends are broadcast).
CONFIRMED_SHARE, LEAST_CONFIRMED, MOST_CONFIRMED = 1 / 8, 25_000, 200_000
#: Bytes of sets and signatures that are dealt to blocks in one pass: so many for each class, and at least; and how many
#: times as large as usual those blocks are.
DEALT_BYTES, LEAST_DEALT, WIDE = 512, 1 << 26, 2
_A, _B = constants(K, 31), constants(K, 37)


def matches(percent: int) -> int:
    """Coordinates in which linked classes agree at least: the binomial tail below is under MISS."""
    p, tail = percent / 100, 0.0
    for m in range(K + 1):
        tail += math.comb(K, m) * p**m * (1 - p) ** (K - m)
        if tail >= MISS:
            break
    if m == 0:
        raise ValueError(f"{K} coordinates are too few for a similarity of {percent} hundredths")
    return m


def shared(percent: int) -> int:
    return min(SHARED, matches(percent))


def prefix(percent: int) -> int:
    return K - matches(percent) + shared(percent)


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    h, at = hash_words(texts, lower=True)
    grams = gram_hash(h, words)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(grams[a : b - words + 1]))
        elif b > a:
            out.append(mix(gram_hash(h[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """K least values of K hash functions (uint32)."""
    least = np.full(K, np.iinfo(np.uint64).max)
    for i in range(0, len(shingles), 2048):
        np.minimum(least, (shingles[None, i : i + 2048] * _A[:, None] + _B[:, None]).min(1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def features(docs: DataFrame, words: int) -> DataFrame:
    """Per row: a number of its own, id, set size, set fingerprint, signature, text fingerprints."""

    def run(batch) -> dict:
        sets = shingle_sets(text_bytes(batch.column("text")), words)
        return {
            **{c: batch.column(c) for c in ("uid", "doc_id", "h1", "h2")}, "n": [len(s) for s in sets],
            "fp": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
            "sig": [signature(s).tobytes() if len(s) else None for s in sets],
        }

    uid = F.col("uid") if "uid" in docs.columns else F.monotonically_increasing_id()
    rows = docs.select(uid.alias("uid"), "doc_id", "text", *_text_keys())
    return materialize(map_batches(rows, run, "uid long, doc_id long, h1 long, h2 long, n long, fp binary, sig binary"), "minhash")


def _text_keys() -> list:
    return [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")]


def signature_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, K)


def coordinate_keys(sig: np.ndarray) -> np.ndarray:
    """Coordinate number above, value below."""
    return (np.arange(K, dtype=np.int64) << 32)[None, :] | sig.astype(np.int64)


def frequent_keys(classes: DataFrame, total: int) -> np.ndarray:
    """Very frequent coordinate-value pairs. Only the order of postings rests on them, so counts of
    pairs that a task sees once are left out."""

    def run(batches):
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            k, c = np.unique(coordinate_keys(signature_rows(batch.column("sig"))), return_counts=True)
            keys, at = np.unique(np.concatenate((keys, k)), return_inverse=True)
            counts = np.bincount(at, np.concatenate((counts, c)), len(keys)).astype(np.int64)
            if len(keys) > 4_000_000:
                keys, counts = keys[counts > 1], counts[counts > 1]
        keys, counts = keys[counts > 1], counts[counts > 1]
        for i in range(0, len(keys), 1 << 16):
            yield pa.RecordBatch.from_pydict({"key": keys[i : i + (1 << 16)], "c": counts[i : i + (1 << 16)]})

    ship_package(classes.sparkSession)
    least = max(LEAST_FREQUENT, total * FREQUENT_SHARE)
    found = classes.select("sig").mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c")).where(F.col("c") >= least)
    return np.sort(found.select("key").toArrow()["key"].to_numpy())


def prefix_mask(keys: np.ndarray, frequent: np.ndarray, n: int) -> np.ndarray:
    """Which coordinates a class is posted under: the first n with very frequent ones last."""
    late = np.isin(keys, frequent, assume_unique=False) if len(frequent) else np.zeros(keys.shape, bool)
    order = np.argsort(late, axis=1, kind="stable")[:, :n]
    mask = np.zeros(keys.shape, bool)
    np.put_along_axis(mask, order, True, 1)
    return mask


def postings(classes: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
    n = prefix(percent)
    late = classes.sparkSession.sparkContext.broadcast(frequent)

    def run(batch) -> dict:
        keys = coordinate_keys(signature_rows(batch.column("sig")))
        mask = prefix_mask(keys, late.value, n)
        return {"key": keys[mask], "cls": np.repeat(batch.column("cls").to_numpy(zero_copy_only=False), n)}

    return map_batches(classes.select("cls", "sig"), run, "key long, cls long")


def lists(posted: DataFrame) -> DataFrame:
    """Postings of lists with two classes or more, with the list's length and two of its members. A list may hold a
    third of all classes: its postings are joined by sort and merge, which splits them over tasks."""
    heads = posted.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("cls").alias("hub"), F.min(F.struct(F.xxhash64("cls", F.pmod("key", F.lit(ORDERS))), "cls")).alias("other"))
    heads = materialize(heads.where(F.col("c") > 1).select("key", "c", "hub", F.col("other.cls").alias("other")), "minhash-heads")
    out = materialize(posted.join(heads.hint("merge"), "key"), "minhash-lists")
    drop_tables(heads)
    return out


def early_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of short lists that share enough postings, and of long lists' classes with two members."""
    short, long_ = rows.where(F.col("c") <= SMALL).select("key", "cls"), rows.where(F.col("c") > SMALL)
    a, b = short.select("key", F.col("cls").alias("a")), short.select("key", F.col("cls").alias("b"))
    within = a.join(b, "key").where(F.col("a") < F.col("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= shared(percent)).select("a", "b")
    heads = [long_.where(F.col("cls") != F.col(h)).select(F.least("cls", h).alias("a"), F.greatest("cls", h).alias("b")) for h in ("hub", "other")]
    return within.unionByName(heads[0].unionByName(heads[1])).distinct()


def passes(rows: DataFrame, n: int, most: int, *keys: str) -> list[DataFrame]:
    """A written table of ``n`` rows in parts of about ``most`` rows, dealt by ``keys``."""
    parts = max(1, -(-n // most))
    return [rows] if parts == 1 else [rows.where(F.pmod(F.xxhash64(F.lit(parts), *keys), F.lit(parts)) == k) for k in range(parts)]


def union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def matched(pairs: DataFrame, classes: DataFrame, percent: int, total: int) -> DataFrame:
    """Pairs whose signatures agree in ``matches(percent)`` coordinates at least, with that number."""
    least = matches(percent)
    sig = classes.select("cls", "sig")

    def run(batch) -> dict:
        m = (signature_rows(batch.column("sa")) == signature_rows(batch.column("sb"))).sum(1)
        kept = batch.select(["a", "b"]).filter(pa.array(m >= least))
        return {"a": kept.column(0), "b": kept.column(1), "m": m[m >= least].astype(np.int32)}

    pairs, out = materialize(pairs, "minhash-pairs"), []
    for part in passes(pairs, pairs.count(), max(LEAST_MATCHED, MATCHED_SHARE * total), "a", "b"):
        both = (part.join(sig.select(F.col("cls").alias("a"), F.col("sig").alias("sa")), "a")
                .join(sig.select(F.col("cls").alias("b"), F.col("sig").alias("sb")), "b"))
        out.append(materialize(map_batches(both.select("a", "b", "sa", "sb"), run, "a long, b long, m int"), "minhash-matched"))
    drop_tables(pairs)
    return union(out)


def set_table(ends: DataFrame, classes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """Full sets (cls, s) of some classes, made from their texts once more."""
    wanted = materialize(classes.select("cls", "key_id", "h1", "h2").join(ends, "cls", "left_semi"), "minhash-wanted")
    few = wanted.count() <= BROADCAST_CLASSES
    texts = docs.select(_key_id(), "text", *_text_keys()).join(F.broadcast(wanted) if few else wanted, ["key_id", "h1", "h2"]).select("cls", "text")

    def sets(batch) -> dict:
        return {"cls": batch.column("cls"), "s": [s.tobytes() for s in shingle_sets(text_bytes(batch.column("text")), words)]}

    # Repeated rows of one id and text have one set: any will do.
    out = materialize(map_batches(texts, sets, "cls long, s binary").dropDuplicates(["cls"]), "minhash-sets")
    drop_tables(wanted)
    return out


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach ``percent`` hundredths of Jaccard similarity."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int, total: int) -> DataFrame:
    """The pairs of a written table that are linked, by their full sets."""
    most = min(MOST_CONFIRMED, max(LEAST_CONFIRMED, int(CONFIRMED_SHARE * total)))
    return union([confirmed_part(part, classes, docs, words, percent) for part in passes(pairs.select("a", "b"), pairs.count(), most, "a", "b")])


def confirmed_part(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """A pair's texts meet in a cell: each b is sent to a's cell, or to one of several if a has many. So a text goes
    out once for each pair, as a text, and no set is ever written."""
    spark = pairs.sparkSession
    since = len(scratch_list(spark))
    keys = classes.select("cls", "key_id", "h1", "h2", "n")
    far = materialize(pairs.join(keys.withColumnRenamed("cls", "b"), "b"), "minhash-far")
    cells = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    each = materialize(far.groupBy("a").agg(cells.alias("m")), "minhash-each")
    many = far.agg(F.coalesce(cells, F.lit(1))).first()[0]
    cell = lambda part: F.pmod(F.xxhash64("a", part), F.lit(many)).cast("int").alias("cell")
    own = (each.withColumn("part", F.explode(F.expr("sequence(0, m - 1)"))).join(keys, F.col("a") == F.col("cls"))
           .select("a", F.col("a").alias("cls"), cell("part"), "key_id", "h1", "h2").distinct())
    sent = far.join(each, "a").select("a", F.col("b").alias("cls"), cell(F.expr("cast(pmod(xxhash64(b), m) as int)")), "key_id", "h1", "h2")
    sent = materialize(own.unionByName(sent).withColumn("w", F.monotonically_increasing_id()), "minhash-sent")
    texts = docs.select(_key_id(), "text", *_text_keys()).join(F.broadcast(sent), ["key_id", "h1", "h2"]).select("w", "cell", "a", "cls", "text")

    def once(batches):
        # Rows that repeat an id and text are one class: of each task one goes on.
        seen: set[int] = set()
        for batch in batches:
            w = batch.column("w").to_pylist()
            fresh = []
            for x in w:
                fresh.append(x not in seen)
                seen.add(x)
            yield batch.filter(pa.array(fresh, pa.bool_()))

    def check(table: pa.Table) -> pa.Table:
        at = np.unique(table["w"].to_numpy(), return_index=True)[1]
        table = table.take(at)
        a, cls = table["a"].to_pylist(), table["cls"].to_pylist()
        sets = shingle_sets(text_bytes(table["text"]), words)
        heads = {x: s for x, y, s in zip(a, cls, sets, strict=True) if x == y}
        links = [(x, y) for x, y, s in zip(a, cls, sets, strict=True) if x != y and similar(heads[x], s, percent)]
        give_back()
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    ship_package(spark)
    texts = texts.mapInArrow(once, "w long, cell int, a long, cls long, text string")
    out = materialize(texts.groupBy("cell").applyInArrow(check, "a long, b long"), "minhash-links")
    drop_others(spark, since, out)
    return out


def apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose sides are not yet known to be connected."""
    ra, rb = roots.select(F.col("v").alias("a"), F.col("root").alias("ra")), roots.select(F.col("v").alias("b"), F.col("root").alias("rb"))
    both = pairs.join(ra, "a", "left").join(rb, "b", "left")
    return both.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def block_links(left: dict, right: dict, same: bool, percent: int) -> list[tuple[int, int]]:
    """Links of two blocks of classes: pairs of enough matches that reach ``percent`` on the full sets, each of which
    connects two components that the block has not connected yet."""
    own, there, out, least = left["root"].copy(), right["root"].copy(), [], matches(percent)
    for i in range(len(own)):
        near = ((right["sig"] == left["sig"][i]).sum(1) >= least) & (there != own[i])
        if same:
            near &= right["cls"] > left["cls"][i]
        for j in np.flatnonzero(near).tolist():
            if there[j] != own[i] and similar(left["s"][i], right["s"][j], percent):
                out.append((int(left["cls"][i]), int(right["cls"][j])))
                old, new = there[j], own[i]
                own[own == old] = new
                there[there == old] = new
    return out


def late_links(rows: DataFrame, classes: DataFrame, roots: DataFrame, docs: DataFrame, words: int, percent: int, total: int) -> DataFrame:
    """Links between components within the long lists that hold several."""
    spark = rows.sparkSession
    since = len(scratch_list(spark))
    named = rows.where(F.col("c") > SMALL).select("key", "hub", "cls").join(roots.withColumnRenamed("v", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    mixed = materialize(named.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 < r1").select("key"), "minhash-mixed")
    active = named.join(mixed.hint("merge"), "key").select("hub", "cls", "root").distinct()
    active = materialize(active.join(classes.select("cls", "n"), "cls"), "minhash-active")
    if active.isEmpty():
        drop_others(spark, since)
        return spark.createDataFrame([], "a long, b long")
    wanted = materialize(active.select("cls", "n").distinct(), "minhash-wanted")
    # A document's set is about as large as its text: also the sets of many classes are made in passes over the documents.
    sets = union([set_table(part.select("cls"), classes, docs, words) for part in passes(wanted, wanted.count(), BROADCAST_CLASSES, "cls")])
    copies = materialize(dealt(active, percent, WIDE), "minhash-dealt")
    size = copies.join(wanted, "cls").agg(F.coalesce(F.sum(8 * F.col("n") + 4 * K), F.lit(0))).first()[0]
    sets = sets.join(classes.select("cls", "sig"), "cls")

    def compare(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        s = np.empty(len(side), object)
        s[:] = [np.frombuffer(x, np.uint64) for x in table["s"].to_pylist()]
        cols = {"cls": table["cls"].to_numpy(), "root": table["root"].to_numpy(), "sig": signature_rows(table["sig"]), "s": s}
        halves = [{k: v[side == x] for k, v in cols.items()} for x in (0, 1)]
        same = not (side == 1).any()
        links = block_links(halves[0], halves[0] if same else halves[1], same, percent)
        give_back()
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    parts = [materialize(part.join(sets.hint("merge"), "cls").groupBy(*PAIR).applyInArrow(compare, "a long, b long").distinct(), "minhash-links")
             for part in passes(copies, size, max(LEAST_DEALT, DEALT_BYTES * total), *PAIR)]
    drop_others(spark, since, *parts)
    return union(parts)


def _key_id():
    return F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("key_id")


def _named(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows' features, and each set's component with the row of it that comes first."""
    spark = docs.sparkSession
    since = len(scratch_list(spark))
    wide = features(docs, words)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")).alias("first")
    sets = wide.where(F.col("n") > 0).groupBy("fp").agg(F.min("uid").alias("cls"), first)
    sets = materialize(sets, "minhash-classes")
    classes = materialize(wide.join(sets.select(F.col("cls").alias("uid")), "uid", "left_semi").select(F.col("uid").alias("cls"), _key_id(), "h1", "h2", "n", "sig"), "minhash-sigs")
    rows = materialize(wide.select("uid", "doc_id", "n", "fp"), "minhash-rows")  # the signatures go on by class
    drop_tables(wide)
    total = classes.count()
    listed = lists(postings(classes, frequent_keys(classes, total), percent))
    early = matched(early_pairs(listed, percent), classes, percent, total)
    best = early.groupBy("b").agg(F.max(F.struct("m", (-F.col("a")).alias("a"))).alias("x")).select((-F.col("x.a")).alias("a"), "b")
    best = materialize(best, "minhash-best")
    links = confirmed(best, classes, docs, words, percent, total)
    roots = components(links)
    left = materialize(apart(early, roots), "minhash-apart")
    links = links.unionByName(confirmed(left, classes, docs, words, percent, total))
    drop_tables(best, left)
    roots = components(links)
    late = late_links(listed, classes, roots, docs, words, percent, total)
    if not late.isEmpty():
        roots = components(links.unionByName(late))
    named = sets.join(roots.withColumnRenamed("v", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    firsts = named.groupBy("root").agg(F.min("first").alias("first"))
    named = named.join(firsts.withColumnRenamed("first", "best"), "root")
    named = materialize(named.select("fp", F.col("best.doc_id").alias("component"), F.col("best.uid").alias("keeper")), "minhash-named")
    drop_others(spark, since, rows, named)
    return rows, named


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept (the row's id is its component's)."""
    rows, named = _named(docs, words, percent)
    out = rows.select("doc_id", "n", "fp").join(named.select("fp", "component"), "fp", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def copies(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``uid`` of every row but the first of its component, by doc_id (nulls last) and uid. ``docs`` is a written
    table with a ``uid`` per row. Rows without words are copies of nothing."""
    rows, named = _named(docs, words, percent)
    return rows.select("uid", "fp").join(named.select("fp", "keeper"), "fp").where(F.col("uid") != F.col("keeper")).select("uid")


def minhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"), words=3, percent=85)
