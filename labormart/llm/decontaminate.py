"""Benchmark decontamination by greedy string tiling.

Tokens are runs of ASCII letters, digits and bytes from 0x80 on, A-Z folded. A document and a test
item are joined on shared seeds (``LEAST`` successive tokens); the pair is then tiled: for shrinking
lengths, running Karp-Rabin hashes (sums along the tokens, worked out once, give the hash of any stretch)
find the matches, the longest unmarked ones are marked first and never overlap. The share of the item's
tokens under tiles is its coverage; a pair with coverage of at least ``THRESHOLD`` is reported. As tiles may
stand in any order, reordered passages count too.

Seeds that many items share make no candidates by themselves: of each item, its most common seeds are left
out of the index as long as the tokens under them stay below the threshold. A pair that has none of the
other seeds in common cannot reach it.

Items of fewer tokens than a seed are one seed of their own length. Null and empty items or texts
have no tokens and are never reported; repeated rows are judged each on its own; an empty table on
either side gives an empty result. The items are the stated query set: they are taken in blocks of at
most ``BLOCK_BYTES`` of text, one broadcast at a time, against all documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labormart.llm.common import gram_hash, hash_words, load, map_batches, materialize, prefix_hash, span_hash, text_bytes

LEAST = 4
THRESHOLD = 0.5
BLOCK_BYTES = 16 << 20
#: Bytes that stand between tokens.
APART = np.ones(256, bool)
APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
PAIR = "doc_id long, item_id long, matched_tokens long, item_tokens long, coverage double, n_tiles long"


def window_hash(sums: np.ndarray, n: int, s: int) -> np.ndarray:
    """Hashes of the windows of s tokens, from the running sums of n tokens."""
    start = np.arange(max(0, n - s + 1))
    return span_hash(sums, start, start + s)


def greedy_tiles(p: np.ndarray, t: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles (start in p, start in t, length) of two token arrays, longest first, without overlap."""
    tiles: list[tuple[int, int, int]] = []
    free_p, free_t = np.ones(len(p), bool), np.ones(len(t), bool)
    sums_p, sums_t = prefix_hash(p), prefix_hash(t)
    s = min(len(p), len(t))
    while s >= least:
        while True:
            found = []
            at: dict[int, list[int]] = {}
            hp, ht = window_hash(sums_p, len(p), s), window_hash(sums_t, len(t), s)
            # A window can be used if none of its tokens is marked.
            ok = lambda free: np.convolve(free, np.ones(s, int), "valid") == s
            for i in np.flatnonzero(ok(free_p)).tolist():
                at.setdefault(int(hp[i]), []).append(i)
            for j in np.flatnonzero(ok(free_t)).tolist():
                for i in at.get(int(ht[j]), ()):
                    if i and j and free_p[i - 1] and free_t[j - 1] and p[i - 1] == t[j - 1]:
                        continue  # not the start of a maximal match
                    k = s
                    while i + k < len(p) and j + k < len(t) and free_p[i + k] and free_t[j + k] and p[i + k] == t[j + k]:
                        k += 1
                    found.append((-k, i, j))
            marked = False
            for k, i, j in sorted(found):
                if free_p[i : i - k].all() and free_t[j : j - k].all():
                    free_p[i : i - k] = free_t[j : j - k] = False
                    tiles.append((i, j, -k))
                    marked = True
            if not marked:
                break
        s = max(least, s // 2) if s > least else 0
    return tiles


class Items:
    """One block of test items with its seeds."""

    def __init__(self, ids: list[int], texts: list[bytes], least: int = LEAST, threshold: float = THRESHOLD) -> None:
        tokens, at = hash_words(texts, lower=True, apart=APART)
        self.least, self.threshold = least, threshold
        self.ids, self.tokens = ids, [tokens[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        self.size = [min(least, len(x)) for x in self.tokens]
        self.own = [np.unique(gram_hash(x, n)) if n else np.zeros(0, np.uint64) for x, n in zip(self.tokens, self.size, strict=True)]
        self.seeds = {}
        for n in sorted(set(self.size) - {0}):
            here = [k for k, m in enumerate(self.size) if m == n]
            common, times = np.unique(np.concatenate([self.own[k] for k in here]), return_counts=True)
            kept = [self._indexed(k, n, common, times) for k in here]
            seed, item = np.concatenate(kept), np.repeat(here, [len(x) for x in kept])
            order = np.argsort(seed, kind="stable")
            bits = np.zeros(1 << 20, bool)
            bits[seed >> np.uint64(44)] = True
            self.seeds[n] = (bits, seed[order], item[order])

    def _indexed(self, k: int, n: int, common: np.ndarray, times: np.ndarray) -> np.ndarray:
        """The item's seeds without its most common ones, as far as these cover too little by themselves."""
        grams = gram_hash(self.tokens[k], n)
        often = times[np.searchsorted(common, self.own[k])]
        covered, out = np.zeros(len(self.tokens[k]), bool), set()
        for i in np.argsort(-often, kind="stable").tolist():
            if often[i] < 2:
                break
            under = covered.copy()
            for j in np.flatnonzero(grams == self.own[k][i]).tolist():
                under[j : j + n] = True
            if under.sum() >= self.threshold * len(under):
                break
            covered = under
            out.add(i)
        return np.delete(self.own[k], sorted(out))

    def matches(self, texts: list[bytes], threshold: float) -> list[tuple[int, int, int, int]]:
        """(text, item, matched tokens, tiles) of the pairs with enough coverage."""
        tokens, at = hash_words(texts, lower=True, apart=APART)
        candidates, hashes = [], {}
        for n, (bits, seed, item) in self.seeds.items():
            h = hashes[n] = gram_hash(tokens, n)
            pos = np.flatnonzero(bits[h >> np.uint64(44)])
            left, right = np.searchsorted(seed, h[pos]), np.searchsorted(seed, h[pos], side="right")
            hit = right > left
            pos, left, right = pos[hit], left[hit], right[hit]
            doc = np.searchsorted(at, pos, side="right") - 1
            inside = pos + n <= at[doc + 1]
            if not inside.any():
                continue
            # A document asks for a seed once, however often it holds it.
            asked, first = np.unique(np.stack((doc[inside], left[inside])), axis=1, return_index=True)
            left, right = left[inside][first], right[inside][first]
            many = right - left
            found = np.repeat(left - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            candidates.append(np.unique(np.repeat(asked[0], many) * len(self.ids) + item[found]))
        out = []
        for pair in np.sort(np.concatenate(candidates)).tolist() if candidates else []:
            d, k = divmod(pair, len(self.ids))
            p, n, a, b = self.tokens[k], self.size[k], int(at[d]), int(at[d + 1])
            start = a + np.flatnonzero(np.isin(hashes[n][a : max(a, b - n + 1)], self.own[k]))
            # Tokens under seeds bound the tiles from above: neither side can have more.
            if self._under(p, tokens, start, n) < threshold * len(p):
                continue
            t = _joined(tokens, start, n)
            tiles = greedy_tiles(p, t, n)
            matched = sum(x[2] for x in tiles)
            if matched >= threshold * len(p):
                out.append((d, k, matched, len(tiles)))
        return out

    @staticmethod
    def _under(p: np.ndarray, tokens: np.ndarray, start: np.ndarray, n: int) -> int:
        hit = np.isin(gram_hash(p, n), np.unique(gram_hash_at(tokens, start, n)))
        return int((np.convolve(hit, np.ones(n, int)) > 0).sum())


def gram_hash_at(tokens: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    return gram_hash(tokens[(start[:, None] + np.arange(n)).ravel()], n)[::n] if len(start) else np.zeros(0, np.uint64)


def _joined(tokens: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """The stretches of tokens under seeds, with a mark that equals no token between them."""
    cover = np.unique((start[:, None] + np.arange(n)).ravel())
    gap = np.flatnonzero(np.diff(cover) > 1) + 1
    marks = np.arange(1, len(gap) + 1, dtype=np.uint64)
    return np.insert(tokens[cover], gap, marks)


def item_blocks(benchmark: DataFrame, threshold: float, block_bytes: int):
    """Yields ``Items`` of at most about ``block_bytes`` of text each, one block at a time, and whether it is the last."""
    rows = benchmark.select(F.col("item_id").cast("long"), "text").where(F.length("text") > 0)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").toArrow()
        yield Items(part["item_id"].to_pylist(), text_bytes(part["text"]), threshold=threshold), b == blocks - 1


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and item with enough coverage. Each block's rows are written before the next block is
    broadcast, and its broadcast is released; the last block's are left to the caller."""
    spark, out = docs.sparkSession, None
    for items, last in item_blocks(benchmark, threshold, block_bytes):
        shared = spark.sparkContext.broadcast(items)

        def run(batch, shared=shared) -> dict:
            own = shared.value
            got = own.matches(text_bytes(batch.column("text")), threshold)
            ids = batch.column("doc_id").to_pylist()
            n = [len(own.tokens[k]) for _, k, _, _ in got]
            return {
                "doc_id": [ids[d] for d, *_ in got], "item_id": [own.ids[k] for _, k, _, _ in got], "matched_tokens": [m for _, _, m, _ in got],
                "item_tokens": n, "coverage": [m / x for (_, _, m, _), x in zip(got, n, strict=True)], "n_tiles": [x for *_, x in got],
            }

        part = map_batches(docs.select("doc_id", "text"), run, PAIR)
        if not last:
            part = materialize(part, "contaminated")
            shared.destroy()
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], PAIR) if out is None else out


def keep_clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that cover no item, with all their columns."""
    spark = docs.sparkSession
    for items, last in item_blocks(benchmark, threshold, block_bytes):
        shared = spark.sparkContext.broadcast(items)

        def run(batch, shared=shared) -> dict:
            bad = {d for d, *_ in shared.value.matches(text_bytes(batch.column("text")), threshold)}
            kept = batch.filter(pa.array([i not in bad for i in range(batch.num_rows)], pa.bool_()))
            return {name: kept.column(i) for i, name in enumerate(kept.schema.names)}

        docs = map_batches(docs, run, docs.schema)
        if not last:
            docs = materialize(docs, "clean-so-far")
            shared.destroy()
    return docs


def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
