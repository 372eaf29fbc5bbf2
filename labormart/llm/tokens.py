"""Token counts of a word-level BPE vocabulary through the whole-token shortcut.

The vocabulary lower-cases, drops white space, splits a text into pre-tokens and merges within each
of them. ``whole_tokens`` proves beforehand, with the library itself, which pre-tokens come out as
one token; those are looked up, and only the others are merged. Words between white space never
share a pre-token, so each word's tokens are worked out once and kept while memory allows.

A text goes through the shortcut only if all its characters are of ``PLAIN``, where lower case,
normal form and white space are the same in Python and in the library, and if it holds no special
string; the library encodes every other text as a whole. A null text counts as empty (no tokens).
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from labormart.llm.common import AT_END, give_back, load, map_batches

VOCABULARY = "word_bpe_49k.json"
#: Characters that the shortcut takes: ASCII, Latin-1 letters and signs, typographic marks.
PLAIN = "\t\n\r\x20-\x7e\xa1-\xac\xae-\xffŒœ–—‘’“”•…€"
_ODD = re.compile(f"[^{PLAIN}]")
_PLAIN_CHARS = [c for c in map(chr, range(0x2100)) if not _ODD.match(c)]
_LETTERS = "".join(c for c in _PLAIN_CHARS if unicodedata.category(c)[0] == "L")
_NUMBERS = "".join(c for c in _PLAIN_CHARS if unicodedata.category(c)[0] == "N")
#: Fixed value: the vocabulary's pre-token pattern, with its classes spelled out over PLAIN.
PRE_TOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")
#: The same over words that stand one to a line.
PIECES = re.compile("\n|" + PRE_TOKEN.pattern)
#: Stands after a word's ids; no run of ids contains it, as their upper halves are zero.
WORD_END = b"\xff\xff\xff\xff"
#: Words whose tokens a Python worker keeps at most; then it starts anew.
KEPT_WORDS = 300_000
#: Words kept from one partition to the next at most.
KEPT_BETWEEN = 100_000
#: Characters of text whose new words are merged together.
GROUP = 1 << 20
OVER = 2048


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def whole_tokens(tok) -> dict[str, int]:
    """Pre-tokens that encode alone as one token, with its id. At most one per vocabulary entry."""
    byte_of = _byte_of_symbol()
    words = []
    for entry in tok.get_vocab():
        if entry.endswith("</w>"):
            try:
                word = bytes(byte_of[c] for c in entry[:-4]).decode()
            except (KeyError, UnicodeDecodeError):
                continue
            if not _ODD.search(word) and PRE_TOKEN.fullmatch(word) and word == word.lower():
                words.append(word)
    found = {}
    for i in range(0, len(words), 1000):
        part = words[i : i + 1000]
        found |= {w: e.ids[0] for w, e in zip(part, tok.encode_batch(part, add_special_tokens=False), strict=True) if len(e.ids) == 1}
    return found


def _byte_of_symbol() -> dict[str, int]:
    """The byte of each symbol of a byte-level vocabulary: printable Latin-1 stands for itself, the
    other bytes, in order, for the code points from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """The vocabulary's merges, applied to many pre-tokens at once.

    All symbols stand in one flat array. Each round looks up every neighbouring pair, and in each
    pre-token merges the first pair of least rank; pre-tokens without a pair left drop out.
    """

    NONE = np.int64(1 << 40)

    def __init__(self, path: str) -> None:
        model = json.loads(Path(path).read_text())["model"]
        vocab = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.inner, self.last = np.zeros(256, np.int64), np.zeros(256, np.int64)
        for symbol, byte in _byte_of_symbol().items():
            self.inner[byte], self.last[byte] = vocab[symbol], vocab[symbol + "</w>"]
        self.keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs] + [-1], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs] + [0], np.int64)
        # Two hash tables: what collides in the first goes to the second, whose multiplier is chosen so that nothing collides there.
        n = len(pairs)
        at = self._slot(self.keys[:n], 0x9E3779B97F4A7C15, 21)
        self.first = np.full(1 << 21, n, np.int32)
        self.first[at[::-1]] = np.arange(n - 1, -1, -1)
        rest = np.flatnonzero(self.first[at] != np.arange(n))
        for k in range(1, 1000):
            self.multiplier = 2 * k * 0x5851F42D4C957F2D + 1 & (1 << 64) - 1
            at = self._slot(self.keys[rest], self.multiplier, 21)
            if len(np.unique(at)) == len(rest):
                break
        else:
            raise ValueError("no second table without collisions")
        self.second = np.full(1 << 21, n, np.int32)
        self.second[at] = rest

    @staticmethod
    def _slot(keys: np.ndarray, multiplier: int, bits: int) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(multiplier)) >> np.uint64(64 - bits)

    def _ranks(self, key: np.ndarray) -> np.ndarray:
        rank = self.first[self._slot(key, 0x9E3779B97F4A7C15, 21)].astype(np.int64)
        miss = np.flatnonzero(self.keys[rank] != key)
        again = self.second[self._slot(key[miss], self.multiplier, 21)].astype(np.int64)
        rank[miss] = np.where(self.keys[again] == key[miss], again, self.NONE)
        return rank

    def _rank_at(self, rank: np.ndarray, sym: np.ndarray, owner: np.ndarray, at: np.ndarray) -> None:
        """Work out anew the ranks of the pairs that begin at ``at``."""
        rank[at] = self.NONE
        at = at[at + 1 < len(sym)]
        at = at[owner[at] == owner[at + 1]]
        rank[at] = self._ranks(sym[at] << 20 | sym[at + 1])

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece (not empty), little-endian unsigned 32 bit."""
        if not pieces:
            return []
        lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        sym = self.inner[flat]
        ends = np.cumsum(lens)
        sym[ends - 1] = self.last[flat[ends - 1]]
        owner = np.repeat(np.arange(len(pieces)), lens)
        rank = np.full(len(sym), self.NONE)
        self._rank_at(rank, sym, owner, np.arange(len(sym)))
        ready: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            start = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            best = np.repeat(np.minimum.reduceat(rank, start), np.diff(np.append(start, len(sym))))
            over = best == self.NONE
            if over.any():
                ready.append((owner[over], sym[over]))
                left = ~over
                owner, sym, rank, best = owner[left], sym[left], rank[left], best[left]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == best)
            at = at[np.concatenate(([True], owner[at[1:]] != owner[at[:-1]]))]
            sym[at] = self.made[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            owner, sym, rank = owner[keep], sym[keep], rank[keep]
            at -= np.arange(len(at))  # where the merged symbols stand now
            self._rank_at(rank, sym, owner, np.concatenate((at, at[at > 0] - 1)))
        owner, sym = (np.concatenate(x) for x in zip(*ready, strict=True))
        order = np.argsort(owner, kind="stable")
        cut = np.searchsorted(owner[order], np.arange(len(pieces) + 1)) * 4
        ids = sym[order].astype("<u4").tobytes()
        return [ids[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


class WordTokens:
    """Ids (little-endian unsigned 32 bit) of texts, by kept words."""

    def __init__(self, path: str) -> None:
        tok = _tokenizer(path)
        self.whole = {w: i.to_bytes(4, "little") for w, i in whole_tokens(tok).items()} | {"\n": WORD_END}
        self.special = [a.content for a in tok.get_added_tokens_decoder().values()]
        # Few texts need the library; it is large, and loaded again for the first of them.
        del tok
        self.path, self.tok, self.words = path, None, {}
        self.merge = Merges(path)
        give_back()

    def trim(self) -> None:
        if len(self.words) > KEPT_BETWEEN:
            self.words.clear()

    def _learn(self, words: list[str]) -> None:
        flat = PIECES.findall("\n".join(words).lower() + "\n")
        rest = list(set(flat).difference(self.whole))
        ids = self.whole | dict(zip(rest, self.merge([p.encode() for p in rest]), strict=True))
        self.words.update(zip(words, b"".join(map(ids.__getitem__, flat)).split(WORD_END), strict=False))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; texts go in groups, so that new words are merged many at a time."""
        out: list[bytes] = []
        group: list[str] = []
        size = 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size > GROUP:
                out += self._encode_group(group)
                group, size = [], 0
        return out + self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> list[bytes]:
        plain = [None if _ODD.search(t) or any(s in t for s in self.special) else t.split() for t in texts]
        if len(self.words) > KEPT_WORDS:
            self.words.clear()
        new = set().union(*(w for w in plain if w)).difference(self.words)
        if new:
            self._learn(list(new))
        get = self.words.__getitem__
        return [self._by_library(t) if w is None else b"".join(map(get, w)) for t, w in zip(texts, plain, strict=True)]

    def _by_library(self, text: str) -> bytes:
        if self.tok is None:
            self.tok = _tokenizer(self.path)
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def worker_tokens(spark: SparkSession, path: str) -> Callable[[], WordTokens]:
    """A function that gives each Python worker its ``WordTokens``. The shortcut table, no longer than the
    vocabulary, is proven once per worker; the driver loads no tokenizer."""

    def get() -> WordTokens:
        got = _WORKER.get(path)
        if got is None:
            got = _WORKER[path] = WordTokens(path)
            AT_END.append(got.trim)
        return got

    return get


_WORKER: dict[str, WordTokens] = {}


def count_tokens(docs: DataFrame, path: str, over: int = OVER) -> DataFrame:
    """Per document: UTF-8 bytes, tokens, and whether those are more than ``over``."""
    get = worker_tokens(docs.sparkSession, path)

    def run(batch) -> dict:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        n = np.array([len(x) // 4 for x in get().encode_all(texts)], np.int64)
        return {"doc_id": batch.column("doc_id"), "n_bytes": [len(t.encode()) for t in texts], "n_tokens": n, "over_limit": n > over}

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(load(spark, sf_dir, "documents"), vocabulary_path())

