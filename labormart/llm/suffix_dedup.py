"""Suffix-array dedup of bytes: front-coded sorted suffix runs merged by common-prefix-aware loser trees.

Each text is its UTF-8 bytes (null: empty). A byte goes if a string of ``LENGTH`` bytes that covers
it also starts in a document with a smaller id. Strings never cross documents and are judged on the
input; rows with one id are one document, a null id is the least.

``repeats`` settles whatever whole fragments settle. The suffixes of the open ones, cut to ``LENGTH``
bytes, are sorted in each block and kept front-coded (bytes shared with the predecessor, then the
rest). Runs are cut at sampled splitters, exchanged by key range, and each range's runs are merged by
a loser tree that compares two strings only from the prefix on that both are known to share with the
last winner. Equal strings meet there, and each run learns which of its strings an earlier document has.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labormart.llm.common import load, materialize
from labormart.llm.repeats import Block, Exchange, Symbols, mail, open_windows, pack, read_state, unpack

LENGTH = 50
#: Strings sampled per run, and runs sampled at most, for the splitters.
SAMPLE_KEYS, SAMPLE_RUNS = 64, 2000
BYTES = Symbols(window=LENGTH, gram=16, words=False, within=False)


def front_code(keys: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Sorted rows of bytes as shared prefix lengths and the bytes after them."""
    if not len(keys):
        return np.zeros(0, np.uint8), b""
    differ = keys[1:] != keys[:-1]
    lcp = np.concatenate(([0], np.where(differ.any(1), differ.argmax(1), keys.shape[1]))).astype(np.uint8)
    return lcp, keys[np.arange(keys.shape[1])[None, :] >= lcp[:, None]].tobytes()


def decode(lcp: np.ndarray, rest: bytes, width: int) -> np.ndarray:
    """Inverse of ``front_code``: each column repeats the last row that spells it out."""
    own = np.arange(width)[None, :] >= lcp[:, None]
    keys = np.zeros(own.shape, np.uint8)
    keys[own] = np.frombuffer(rest, np.uint8)
    rows = np.where(own, np.arange(len(lcp))[:, None], 0)
    return np.take_along_axis(keys, np.maximum.accumulate(rows, 0), 0)


def shared_prefix(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of two strings of one length that share ``at`` bytes already."""
    differ = int.from_bytes(a[at:], "big") ^ int.from_bytes(b[at:], "big")
    return len(a) - (differ.bit_length() + 7) // 8


class LoserTree:
    """Merges sorted runs of (key, prefix shared with the run's previous key).

    Every run's head carries the length of its common prefix with the last winner; -1 marks a run
    that has ended. Of two heads the one with the longer prefix is smaller; only heads with equal
    prefixes are compared, from there on.
    """

    def __init__(self, runs: list[tuple[list[bytes], list[int]]]) -> None:
        self.runs, self.k = runs or [([], [])], max(1, len(runs))
        self.key = [keys[0] if keys else b"" for keys, _ in self.runs]
        self.lcp = [0 if keys else -1 for keys, _ in self.runs]
        self.loser = [-1] * self.k
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        return self._play(node, self._build(2 * node), self._build(2 * node + 1))

    def _play(self, node: int, a: int, b: int) -> int:
        """Keeps the loser in the node, gives the winner; the loser's prefix is then with that winner."""
        p, q = self.lcp[a], self.lcp[b]
        if p < q:
            a, b = b, a
        elif p == q and p >= 0:
            x, y = self.key[a], self.key[b]
            n = shared_prefix(x, y, p)
            if n < len(x) and x[n] > y[n]:
                a, b = b, a
            self.lcp[b] = n
        self.loser[node] = b
        return a

    def __iter__(self):
        """(run, place in it, prefix shared with the string before in the merged order)."""
        key, lcp, loser, play = self.key, self.lcp, self.loser, self._play
        at = [0] * self.k
        r = self.winner
        while lcp[r] >= 0:
            yield r, at[r], lcp[r]
            at[r] = i = at[r] + 1
            keys, lcps = self.runs[r]
            if i < len(keys):
                key[r], lcp[r] = keys[i], lcps[i]
            else:
                lcp[r] = -1
            node = (r + self.k) >> 1
            while node:
                other = loser[node]
                p, q = lcp[r], lcp[other]
                if p == q:
                    r = play(node, r, other)
                elif p < q:
                    loser[node], r = r, other
                node >>= 1
        self.winner = r


def merge_runs(parts: list[dict[str, np.ndarray]]) -> list[np.ndarray]:
    """For each run, which of its strings a run with a smaller id has too."""
    keys = [decode(p["lcp"], p["rest"], LENGTH) for p in parts]
    tree = LoserTree([([k.tobytes() for k in ks], p["lcp"].tolist()) for ks, p in zip(keys, parts, strict=True)])
    ids = [p["id"].tolist() for p in parts]
    out = [np.zeros(len(x), bool) for x in ids]

    def close(equal: list[tuple[int, int, int]]) -> None:
        least = min(ids[r][i] for r, i, _ in equal)
        for r, i, _ in equal:
            out[r][i] = ids[r][i] > least

    equal: list[tuple[int, int, int]] = []
    for head in tree:
        if head[2] == LENGTH:
            equal.append(head)
            continue
        if len(equal) > 1:
            close(equal)
        equal = [head]
    if len(equal) > 1:
        close(equal)
    return out


def merged_verdicts(exchange: Exchange, known: DataFrame) -> DataFrame:
    """The open windows' verdicts: sorted runs, exchange by range, merge, answers."""

    def sort_block(block: Block, got: dict) -> pa.Table:
        s, code = read_state(got)
        if s is None:
            return mail([])
        own = open_windows(s, code, BYTES)
        if not len(own.k):
            return mail([])
        at_doc = np.cumsum([0, *map(len, block.texts)])
        raw = np.frombuffer(b"".join(block.texts), np.uint8)
        doc = s["doc"][own.run]
        key = np.lib.stride_tricks.sliding_window_view(raw, LENGTH)[at_doc[doc] + s["start"][own.run] + own.k]
        ids = block.ids[doc]
        text = _comparable(key)
        by_id = np.argsort(ids, kind="stable")
        order = by_id[np.argsort(text[by_id], kind="stable")]
        head = np.concatenate(([True], text[order][1:] != text[order][:-1]))
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(head) - 1
        least = ids[order][head]
        lcp, rest = front_code(key[order][head])
        some = key[order][head][np.linspace(0, len(lcp) - 1, min(SAMPLE_KEYS, len(lcp))).astype(int)]
        return mail([(block.number, 0, "sample", some.tobytes()), (block.number, 0, "run", pack(lcp=lcp, rest=rest, id=least)), (block.number, 0, "places", pack(at=at.astype(np.int32), known=ids > least[at]))])

    sent = materialize(exchange.with_mail(known, sort_block, "block long, shard int, kind string, data binary"), "suffix-runs")
    splitters = sampled_splitters(sent.where(F.col("kind") == "sample"), exchange.shards)

    def cut(batches):
        for batch in batches:
            rows = []
            for number, data in zip(batch.column("block").to_pylist(), batch.column("data").to_pylist(), strict=True):
                run = unpack(data)
                keys = decode(run["lcp"], run["rest"], LENGTH)
                bounds = [0, *np.searchsorted(_comparable(keys), _comparable(splitters)).tolist(), len(keys)] if len(splitters) else [0, len(keys)]
                for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    if a < b:
                        lcp, rest = front_code(keys[a:b])
                        rows.append((number, k, "part", pack(lcp=lcp, rest=rest, id=run["id"][a:b])))
            yield from mail(rows).to_batches()

    parts = sent.where(F.col("kind") == "run").mapInArrow(cut, "block long, shard int, kind string, data binary")

    def answer(rows: list[tuple[int, bytes]]):
        own = [unpack(d) for _, d in rows]
        return [(b, len(v).to_bytes(8, "little") + np.packbits(v).tobytes()) for (b, _), v in zip(rows, merge_runs(own), strict=True)]

    answers = materialize(exchange.at_shards(parts, answer), "suffix-verdicts")
    return sent.where(F.col("kind") == "places").unionByName(answers.withColumn("kind", F.lit("verdict")))


def _comparable(keys: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(keys).view(f"S{LENGTH}").ravel()


def sampled_splitters(sent: DataFrame, ranges: int) -> np.ndarray:
    """Strings that cut the keys into about equal ranges, from a bounded sample of runs."""

    some = sent.orderBy(F.xxhash64("block")).limit(SAMPLE_RUNS).select("data").collect()
    keys = sorted(bytes(r["data"][i : i + LENGTH]) for r in some for i in range(0, len(r["data"]), LENGTH))
    if not keys:
        return np.zeros((0, LENGTH), np.uint8)
    picked = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)})
    return np.frombuffer(b"".join(picked), np.uint8).reshape(-1, LENGTH)


ROW = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def byte_rows(block: Block, covers: list[list[tuple[int, int]]]) -> pa.Table:
    out = []
    for raw, text, spans in zip(block.raw_ids, block.texts, covers, strict=True):
        kept, at, merged = hashlib.sha256(), 0, []
        for a, b in sorted(spans):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        for a, b in merged:
            kept.update(text[at:a])
            at = b
        kept.update(text[at:])
        out.append((raw, len(text), sum(b - a for a, b in merged), len(merged), kept.hexdigest()))
    names = [x.split()[0] for x in ROW.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.string()]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: bytes, bytes and runs removed, digest of what is kept."""
    return Exchange(docs, BYTES).settle(merged_verdicts, ROW, byte_rows)


def suffix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(load(spark, sf_dir, "documents"))
