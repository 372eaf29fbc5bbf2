"""Substring dedup of words with a compressed FM-index per shard.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A window is ``LENGTH`` successive words of one
document; a word goes if a window that covers it has an equal that starts earlier (in a document with
a smaller id, or earlier in the same one). Windows are judged on the input; rows with one id are one
document, a null id is the least; null texts have no words.

``repeats`` settles whatever whole fragments settle. The open fragments of a shard are indexed
together: their suffixes are sorted, and the Burrows-Wheeler transform is kept in a wavelet matrix of
packed bits with block counts. The blocks' fragments are then streamed against the index: all
windows are extended to the left in step, one backward search step a word, and a window leaves as
soon as its interval holds nothing but itself. Those that reach ``LENGTH`` words are repeats, and the
least place in their interval tells whether an equal one starts earlier.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labormart.llm.common import hash_words, load, materialize
from labormart.llm.repeats import Block, Exchange, Symbols, mail, open_windows, pack, read_state, unpack

LENGTH = 20
WORDS = Symbols(window=LENGTH, gram=6, words=True, within=True)


class BitRank:
    """Packed bits with a count before each word of 64."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]))

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        w = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & below)


class FMIndex:
    """Of a text of symbols 0 .. sigma - 1 (each suffix differs from all others)."""

    def __init__(self, text: np.ndarray) -> None:
        self.n = len(text)
        self.suffixes = suffix_array(text)
        transform = text[self.suffixes - 1]
        sigma = int(text.max()) + 1 if self.n else 1
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))
        self.levels: list[tuple[int, BitRank, int]] = []
        for b in reversed(range(max(1, (sigma - 1).bit_length()))):
            bit = (transform >> b & 1).astype(np.uint8)
            self.levels.append((b, BitRank(bit), int(self.n - bit.sum())))
            transform = np.concatenate((transform[bit == 0], transform[bit == 1]))
        self.origin = self._down(np.arange(sigma), np.zeros(sigma, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Where place i of the transform leads to in the last row of the matrix, along the symbol's bits."""
        for b, rank, zeros in self.levels:
            one = rank.ones(i)
            i = np.where(symbol >> b & 1, zeros + one, i - one)
        return i

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one symbol more on the left."""
        base = self.first[symbol] - self.origin[symbol]
        return base + self._down(symbol, low), base + self._down(symbol, high)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Prefix doubling; stops once all ranks differ."""
    n, rank, k = len(text), np.asarray(text, np.int64), 1
    rank = np.unique(rank, return_inverse=True)[1]
    while True:
        after = np.zeros(n, np.int64)
        after[: n - k] = rank[k:] + 1 if k < n else 0
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if n == 0 or new[-1] == n - 1:
            return order
        k *= 2


def earlier_windows(words: np.ndarray, lens: np.ndarray, ids: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For every window of every fragment, whether an equal one has a smaller (id, start).

    ``words``: all fragments' words, one after the other; the windows come in the same order.
    """
    pieces, total = len(lens), int(lens.sum())
    at = np.cumsum(lens) - lens
    # Every fragment ends with a symbol of its own, below those of all words.
    symbol = np.unique(words, return_inverse=True)[1] + pieces
    owner = np.repeat(np.arange(pieces), lens)
    place = np.arange(total) + owner
    text = np.zeros(total + pieces, np.int64)
    text[place] = symbol
    text[at + lens + np.arange(pieces)] = np.arange(pieces)
    index = FMIndex(text)
    within = np.arange(total) - at[owner]
    where = starts[owner] + within
    sorted_ = np.lexsort((where, ids[owner]))
    a, b = where[sorted_], ids[owner][sorted_]
    order = np.zeros(total, np.int64)  # equal places (repeated rows) have equal ranks
    order[sorted_[1:]] = np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))
    by_place = np.full(len(text), total, np.int64)
    by_place[place] = order
    window = np.flatnonzero(within + length <= lens[owner])
    answer = np.zeros(len(window), bool)
    live, low, high = np.arange(len(window)), np.zeros(len(window), np.int64), np.full(len(window), len(text), np.int64)
    for t in reversed(range(length)):
        low, high = index.step(symbol[window[live] + t], low, high)
        several = high - low > 1
        live, low, high = live[several], low[several], high[several]
    if len(live):
        # Equal windows have one interval: the least place of each is worked out once.
        one, inverse = np.unique(low, return_inverse=True)
        end = np.zeros(len(one), np.int64)
        end[inverse] = high
        ranks = np.append(by_place[index.suffixes], total)
        least = np.minimum.reduceat(ranks, np.stack((one, end), 1).ravel())[::2]
        answer[live] = least[inverse] < order[window[live]]
    return answer


def indexed_verdicts(exchange: Exchange, known: DataFrame) -> DataFrame:
    """The open windows' verdicts, by one index per shard."""

    def send(block: Block, got: dict) -> pa.Table:
        s, code = read_state(got)
        if s is None:
            return mail([])
        own = open_windows(s, code, WORDS)
        if not len(own.k):
            return mail([])
        # Open windows that follow each other in a fragment go together.
        head = np.flatnonzero(np.concatenate(([True], (np.diff(own.frag) != 0) | (np.diff(own.k) != 1))))
        run, lens = own.run[head], np.diff(np.append(head, len(own.k))) + LENGTH - 1
        docs, at_doc = np.unique(s["doc"][run], return_inverse=True)
        words, at = hash_words([block.texts[d] for d in docs.tolist()])
        start = s["start"][run] + own.k[head]
        begin, shard, ids = at[at_doc] + start, s["shard"][own.frag[head]], block.ids[s["doc"][run]]
        rows = []
        cut = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            part = np.concatenate([words[x : x + n] for x, n in zip(begin[a:b].tolist(), lens[a:b].tolist(), strict=True)])
            rows.append((block.number, int(shard[a]), "part", pack(words=part, lens=lens[a:b], id=ids[a:b], start=start[a:b])))
        rows.append((block.number, -1, "places", pack(at=np.arange(len(own.k)), known=np.zeros(len(own.k), bool))))
        return mail(rows)

    sent = materialize(exchange.with_mail(known, send, "block long, shard int, kind string, data binary"), "substring-parts")

    def answer(rows: list[tuple[int, bytes]]):
        parts = [unpack(d) for _, d in rows]
        every = {k: np.concatenate([p[k] for p in parts]) for k in ("words", "lens", "id", "start")}
        found = earlier_windows(every["words"], every["lens"], every["id"], every["start"])
        at = np.cumsum([0, *(int((p["lens"] - LENGTH + 1).sum()) for p in parts)])
        out = [found[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        return [(b, len(v).to_bytes(8, "little") + np.packbits(v).tobytes()) for (b, _), v in zip(rows, out, strict=True)]

    answers = materialize(exchange.at_shards(sent.where(F.col("kind") == "part"), answer), "substring-verdicts")
    return sent.where(F.col("kind") == "places").unionByName(answers.withColumn("kind", F.lit("verdict")))


ROW = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def word_rows(block: Block, covers: list[list[tuple[int, int]]]) -> pa.Table:
    out = []
    for raw, text, spans in zip(block.raw_ids, block.texts, covers, strict=True):
        words = text.split()
        gone = np.zeros(len(words), bool)
        for a, b in spans:
            gone[a:b] = True
        kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]) if spans else b" ".join(words)
        out.append((raw, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    kinds = [pa.int64()] * 3 + [pa.string()]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[x.split()[0] for x in ROW.split(", ")])


def substring_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: words, words removed, digest of what is kept."""
    return Exchange(docs, WORDS).settle(indexed_verdicts, ROW, word_rows)


def substring_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(load(spark, sf_dir, "documents"))
