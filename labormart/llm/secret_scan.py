"""Secret scans: fixed patterns plus sliding-window entropy over candidate strings.

``find_spans`` gives every span of one text; ``scan`` applies it to a table, ``redact`` replaces
the spans. A null text counts as empty and has no spans; repeated rows are scanned each on its own;
an empty table gives an empty table; other columns of the input are not read by ``scan``.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
from pyspark.sql import DataFrame

from labormart.llm.common import map_batches

# Patterns and least lengths of the three base kinds, in the order in which they are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "entropy")
LEAST = {"assign": 12, "access": 18, "hex": 16}

#: Every access and hex match of its least length lies in one maximal run of these characters.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
#: (characters, window length, least entropy in bits per character): one row per character class.
CLASSES = (
    (re.compile(r"[0-9a-fA-F]+"), 24, 3.0),
    (re.compile(r"[A-Za-z0-9]+"), 20, 3.7),
    (re.compile(r"[A-Za-z0-9+/_=-]+"), 20, 4.0),
)
#: Candidates with one of these forms are no secrets.
ALLOWED = (
    re.compile(r"[A-Za-z]+(?:[-_./=+]+[A-Za-z]+)*[-_./=+]*"),  # words and paths of words
    re.compile(r"[0-9.=+/_-]+"),  # numbers, dates, rulers
    re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),  # UUID
    re.compile(r"[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,6}"),  # host, or file with its extension
    # Words between separators, small, capitalised or in capitals, with a short number at the end of
    # each. Every character can be read in one way only, so the match is linear.
    re.compile(r"(?:(?:[A-Za-z][a-z]+|[A-Z]{2,})[0-9]{0,4}(?:[-_./=+]+|\Z))+"),
)
#: A host with a path behind it: what stands between the slashes is judged piece by piece.
HOST_PATH = re.compile(r"[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,6}/")
#: Alphabets written out are sequences, not secrets.
SEQUENCES = ("abcdefghijklmnopqrstuvwxyz", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def window_entropy_spans(s: str, window: int, least: float) -> list[tuple[int, int]]:
    """Maximal stretches of ``s`` covered by windows of at least ``least`` bits per character.

    Counts are kept up to date as the window moves, so each step costs two changes of
    sum(c * log2 c); the entropy is log2(window) - sum / window.
    """
    if len(s) < window:
        return []
    clog = [0.0] + [c * math.log2(c) for c in range(1, window + 2)]
    counts: dict[str, int] = {}
    total, spans, limit = 0.0, [], (math.log2(window) - least) * window + 1e-9
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        total += clog[c + 1] - clog[c]
        counts[ch] = c + 1
        if i >= window:
            old = s[i - window]
            c = counts[old]
            total += clog[c - 1] - clog[c]
            counts[old] = c - 1
        if i >= window - 1 and total <= limit:
            if spans and spans[-1][1] >= i - window + 1:
                spans[-1][1] = i + 1
            else:
                spans.append([i - window + 1, i + 1])
    return [(a, b) for a, b in spans]


def _suppressed(run: str) -> bool:
    return any(p.fullmatch(run) for p in ALLOWED) or any(q in run for q in SEQUENCES)


def _pieces(at: int, run: str) -> list[tuple[int, str]]:
    """The candidates of a run: the run itself, or the parts of the path behind a host."""
    host = HOST_PATH.match(run)
    if not host:
        return [(at, run)]
    out, start = [], host.end()
    for part in run[start:].split("/"):
        out.append((at + start, part))
        start += len(part) + 1
    return out


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by start and then kind as in ``KINDS``.

    Entropy spans that lie inside one base span add nothing and are left out.
    """
    base: list[tuple[str, int, int]] = []
    if ":" in text or "=" in text:
        base += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    runs = [(m.start(), m[0]) for m in CANDIDATE.finditer(text)]
    for at, run in runs:
        for kind, pattern in (("access", ACCESS), ("hex", HEX)):
            base += [(kind, at + m.start(), at + m.end()) for m in pattern.finditer(run) if m.end() - m.start() >= LEAST[kind]]
    found: list[tuple[int, int]] = []
    for at, run in (piece for at, run in runs for piece in _pieces(at, run)):
        if _suppressed(run):
            continue
        for chars, window, least in CLASSES:
            for m in chars.finditer(run):
                if m.end() - m.start() >= window and any(c.isdigit() for c in m[0]) and not _suppressed(m[0]):
                    found += [(at + m.start() + a, at + m.start() + b) for a, b in window_entropy_spans(m[0], window, least)]
    merged: list[list[int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    extra = [("entropy", a, b) for a, b in merged if not any(s <= a and b <= e for _, s, e in base)]
    return sorted(base + extra, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def spell(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts of base spans, a digest of them, and all spans."""

    def run(batch) -> dict:
        each = [find_spans(t or "") for t in batch.column("text").to_pylist()]
        base = [[x for x in spans if x[0] != "entropy"] for spans in each]
        count = lambda kind: np.array([sum(x[0] == kind for x in b) for b in base], np.int64)
        return {
            "doc_id": batch.column("doc_id"), "n_assign": count("assign"), "n_access": count("access"), "n_hex": count("hex"),
            "base_sha256": [hashlib.sha256(spell(b).encode()).hexdigest() for b in base], "spans": [spell(x) for x in each],
        }

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def cut_out(text: str, mark: str) -> str:
    """``text`` with every (merged) span replaced by ``mark``."""
    out, at = [], 0
    for _, a, b in find_spans(text):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join(out) + text[at:] if out else text


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``mark``; ``n_chars``, where present as a
    number, counts the new text. Rows, columns and null texts stay."""
    kinds = dict(docs.dtypes)

    def run(batch) -> dict:
        texts = batch.column("text").to_pylist()
        new = [t if t is None else cut_out(t, mark) for t in texts]
        cols = {name: batch.column(i) for i, name in enumerate(batch.schema.names)} | {"text": new}
        if kinds.get("n_chars") in ("bigint", "int"):
            old = batch.column(batch.schema.names.index("n_chars")).to_pylist()
            cols["n_chars"] = [n if a is b or a == b else len(b) for a, b, n in zip(texts, new, old, strict=True)]
        return cols

    return map_batches(docs, run, docs.schema)


def secrets_query(spark, sf_dir):
    from labormart.llm.common import load

    return scan(load(spark, sf_dir, "documents"))
