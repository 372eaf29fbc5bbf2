"""Finding windows that repeat across documents: the exchange that both exact dedup operators use.

A window is ``window`` successive symbols (words or bytes) of one document. Its anchor is the
``gram`` successive symbols in it of least hash (the leftmost of equals), so equal windows have
equal anchors at equal places. Neighbouring windows with one anchor form a run; a run's fragment are
the symbols that its windows cover. Texts are written once, in blocks of bounded size, into a table
bucketed by block; after that only hashes and fragments move:

1. Every block sends its distinct anchors to shards by hash; a shard answers which are repeated.
2. For runs with such anchors a block sends its distinct fragments (hash, anchor, first place, and
   the hash of each part's core: windows fall into ``PARTS`` parts by the anchor's place in them, and
   the core are the symbols that all windows of a part share). The answer: the fragment has come earlier
   elsewhere (all its windows are repeats), or which parts have a core that another fragment has too.
3. Only the windows of such parts, of one copy of each fragment, are open and go to the operator's own
   method, which answers per window.

Equal fragments meet once per block, so a passage that a third of all documents hold is sent no
oftener than there are blocks. Hashes have 64 bits.

Blocks and answers are joined by the block's number; nothing is kept by task or executor.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labormart.llm.common import give_back, hash_words, materialize, mix, prefix_hash, ship_package, text_bytes
from labormart.llm.common import _BYTE, _POWERS
from labormart.session import scratch_path

#: Bytes of text in a block, or one document.
BLOCK_BYTES = 4 << 20
#: Bytes of text per bucket and per shard, about.
SHARD_BYTES = 6 << 20
#: Parts into which a fragment's windows fall.
PARTS = 4
CORES = [f"core{k}" for k in range(PARTS)]
#: Code of a fragment all of whose windows are repeats; other codes are bits of open parts.
SETTLED = 255
_CHUNK = 1 << 17
_PLACE = np.uint64((1 << 20) - 1)
MAIL = "block long, shard int, kind string, data binary"
MAIL_ARROW = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("kind", pa.string()), ("data", pa.binary())])
LOWEST = -(1 << 63)
_ZIP, _UNZIP = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


@dataclass(frozen=True)
class Symbols:
    """What a window is made of. ``within``: an earlier start in the same document counts too."""

    window: int
    gram: int
    words: bool
    within: bool

    @property
    def part(self) -> int:
        """Places of the anchor that one part takes."""
        return -(-(self.window - self.gram + 1) // PARTS)

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts (words by their hashes, bytes as they are) and where each text's begin."""
        if self.words:
            return hash_words(texts)
        at = np.cumsum([0, *map(len, texts)])
        return np.frombuffer(b"".join(texts), np.uint8), at


def pack(**arrays) -> bytes:
    return _ZIP.compress(pickle.dumps(arrays, protocol=5))


def unpack(data: bytes) -> dict[str, np.ndarray]:
    return pickle.loads(_UNZIP.decompress(data))


def mail(rows: list[tuple[int, int, str, bytes]]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else ((), (), (), ()), MAIL_ARROW.types, strict=True)], schema=MAIL_ARROW)


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Least of every n successive values."""
    w = 1
    while 2 * w <= n:
        x = np.minimum(x[:-w], x[w:])
        w *= 2
    return np.minimum(x[: len(x) - (n - w)], x[n - w :]) if w < n else x


def runs(values: np.ndarray, at: np.ndarray, kind: Symbols, cores: bool = True) -> dict[str, np.ndarray]:
    """Runs of windows of one anchor: document (number in the block), start, windows, anchor, fragment
    hash, where the anchor begins in the fragment, and the hashes of the parts' cores."""
    size, gram = kind.window, kind.gram
    _POWERS.upto(_CHUNK + size + 2)
    found: list[tuple] = []
    i, docs = 0, len(at) - 1
    pieces = []  # (first symbol, symbol after the last, document ends)
    while i < docs:
        if at[i + 1] - at[i] > _CHUNK:
            for a in range(int(at[i]), int(at[i + 1]), _CHUNK):
                pieces.append((a, min(int(at[i + 1]), a + _CHUNK + size - 1)))
            i += 1
        else:
            j = i
            while j < docs and at[j + 1] - at[i] <= _CHUNK:
                j += 1
            pieces.append((int(at[i]), int(at[j])))
            i = j
    for a, b in pieces:
        n = b - a
        if n < size:
            continue
        v = values[a:b]
        p = prefix_hash(v if v.dtype == np.uint64 else _BYTE[v])
        down = _POWERS.down
        m = n - gram + 1
        g = mix((p[gram:] - p[:-gram]) * down[:m])
        low = sliding_min((g & ~_PLACE) | np.arange(m, dtype=np.uint64), size - gram + 1)
        first = np.arange(len(low))
        ends = at[np.searchsorted(at, a, side="right") : np.searchsorted(at, b, side="left") + 1]
        stop = np.minimum(np.append(ends[ends <= b], b) - a, n)
        owner_end = stop[np.searchsorted(stop, first, side="right").clip(max=len(stop) - 1)]
        ok = np.flatnonzero(first + size <= owner_end)
        if not len(ok):
            continue
        place = (low[ok] & _PLACE).astype(np.int64)
        head = np.flatnonzero(np.concatenate(([True], (np.diff(place) != 0) | (np.diff(ok) != 1))))
        s, count = ok[head], np.diff(np.append(head, len(ok)))
        frag = mix((p[s + count + size - 1] - p[s]) * down[s])
        doc = np.searchsorted(at, s + a, side="right") - 1
        where = place[head]
        lead, core = where - s, []
        for k in range(PARTS if cores else 0):
            least, most = k * kind.part, min((k + 1) * kind.part, size - gram + 1) - 1
            has = (lead >= least) & (lead - count + 1 <= most)
            left, right = np.where(has, where - least, 0), np.where(has, where + size - most, 0)
            core.append((mix((p[right] - p[left]) * down[left]) >> np.uint64(32)).astype(np.uint32))
        found.append((doc, s + a - at[doc], count, g[where], frag, lead, *core))
    names = ("doc", "start", "n", "anchor", "frag", "lead", *(CORES if cores else ()))
    kinds = (np.int32, np.int64, np.int32, np.uint64, np.uint64, np.int32, *[np.uint32] * (PARTS if cores else 0))
    return {k: np.concatenate([f[c].astype(t) for f in found]) if found else np.zeros(0, t) for c, (k, t) in enumerate(zip(names, kinds, strict=True))}


def shard_of(anchor: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of hashes, so sorted hashes stand shard by shard."""
    return ((anchor >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def by_shard(anchor: np.ndarray, shards: int):
    """(shard, first, after the last) of the stretches of sorted anchors."""
    s = shard_of(anchor, shards)
    cut = np.flatnonzero(np.diff(s)) + 1
    bounds = np.concatenate(([0], cut, [len(s)])) if len(s) else np.zeros(1, np.int64)
    return [(int(s[a]), int(a), int(b)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


class Block:
    """The documents of one block, by id."""

    def __init__(self, table: pa.Table) -> None:
        give_back()
        ids = [LOWEST if x is None else x for x in table["doc_id"].to_pylist()]
        texts = text_bytes(table["text"])
        order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        raw = table["doc_id"].to_pylist()
        self.number = table["block"][0].as_py()
        self.raw_ids = [raw[i] for i in order]
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.texts = [texts[i] for i in order]


class Exchange:
    """The blocks of a table and the three steps over them."""

    def __init__(self, docs: DataFrame, kind: Symbols) -> None:
        self.kind, self.spark = kind, docs.sparkSession
        ship_package(self.spark)
        rows = docs.select("doc_id", "text")
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        # Not below the session's shuffle width: Spark would else deal both sides anew.
        self.shards = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
        path = scratch_path(self.spark, "blocks")
        name = "labormart_" + path.rsplit("/", 1)[1].replace("-", "_")
        in_blocks(rows).write.bucketBy(self.shards, "block").option("compression", "zstd").option("path", path).saveAsTable(name)
        self.blocks = self.spark.table(name)

    def per_block(self, fn) -> DataFrame:
        """fn(Block) for each block."""
        return self.blocks.groupBy("block").applyInArrow(lambda t: fn(Block(t)), MAIL)

    def with_mail(self, answers: DataFrame, fn, schema: str) -> DataFrame:
        """fn(Block, {kind: [(shard, data)]}) for each block."""

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            got: dict[str, list] = {}
            for shard, kind, data in zip(right["shard"].to_pylist(), right["kind"].to_pylist(), right["data"].to_pylist(), strict=True):
                got.setdefault(kind, []).append((shard, data))
            return fn(Block(left), {k: [d for _, d in sorted(v)] for k, v in got.items()})

        to = answers.select(F.col("block").alias("to_block"), "shard", "kind", "data")
        return self.blocks.groupBy("block").cogroup(to.groupBy("to_block")).applyInArrow(run, schema)

    def at_shards(self, sent: DataFrame, fn) -> DataFrame:
        """fn([(block, data)]) for each shard; gives (block, answer) pairs."""

        def run(table: pa.Table) -> pa.Table:
            shard = table["shard"][0].as_py()
            give_back()
            rows = sorted(zip(table["block"].to_pylist(), table["data"].to_pylist(), strict=True))
            return mail([(b, shard, "answer", x) for b, x in fn(rows)])

        return sent.groupBy("shard").applyInArrow(run, MAIL)

    def anchors(self) -> DataFrame:
        """Step 1: per block, bits of its sorted distinct anchors: 1 if repeated."""
        kind, shards = self.kind, self.shards

        def send(block: Block) -> pa.Table:
            r = runs(*kind.of(block.texts), kind, cores=False)
            order = np.argsort(r["anchor"], kind="stable")
            anchor, first, count = np.unique(r["anchor"][order], return_index=True, return_counts=True)
            if kind.within:
                many = count > 1
            elif len(anchor):
                ids = block.ids[r["doc"][order]]
                many = np.minimum.reduceat(ids, first) < np.maximum.reduceat(ids, first)
            else:
                many = np.zeros(0, bool)
            return mail([(block.number, s, "anchors", anchor[a:b].tobytes() + np.packbits(many[a:b]).tobytes()) for s, a, b in by_shard(anchor, shards)])

        def answer(rows: list[tuple[int, bytes]]):
            hashes, many, sizes = [], [], []
            for _, data in rows:
                n = len(data) * 8 // 65  # 8 bytes and a bit each
                while 8 * n + (n + 7) // 8 < len(data):
                    n += 1
                hashes.append(np.frombuffer(data[: 8 * n], np.uint64))
                many.append(np.unpackbits(np.frombuffer(data[8 * n :], np.uint8), count=n))
                sizes.append(n)
            _, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
            repeated = np.bincount(inverse, 1 + np.concatenate(many))[inverse] > 1
            at = np.cumsum([0, *sizes])
            return [(b, np.packbits(repeated[at[i] : at[i + 1]]).tobytes()) for i, (b, _) in enumerate(rows)]

        return materialize(self.at_shards(self.per_block(send), answer), "repeats-anchors")

    def fragments(self, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Step 2: (state of each block, answers). State: the runs with repeated anchors, each with
        the number of its fragment and whether it is settled, and each fragment's shard and the place of
        its anchor; answers: a code per fragment (bits of its open parts, or SETTLED)."""
        kind, shards = self.kind, self.shards

        def send(block: Block, got: dict) -> pa.Table:
            r = runs(*kind.of(block.texts), kind)
            anchor = np.unique(r["anchor"])
            bits = [np.unpackbits(np.frombuffer(d, np.uint8), count=b - a) for d, (_, a, b) in zip(got.get("answer", []), by_shard(anchor, shards), strict=True)]
            again = anchor[np.concatenate(bits).astype(bool)] if bits else anchor[:0]
            flagged = np.isin(r["anchor"], again)
            r = {k: v[flagged] for k, v in r.items()}
            ids = block.ids[r["doc"]]
            order = np.lexsort((r["start"], ids, r["frag"], r["anchor"]))
            r, ids = {k: v[order] for k, v in r.items()}, ids[order]
            head = np.concatenate(([True], r["frag"][1:] != r["frag"][:-1])) if len(ids) else np.zeros(0, bool)
            number = np.cumsum(head) - 1
            first = np.flatnonzero(head)
            later = ids > ids[first][number]
            if kind.within:
                later |= (ids == ids[first][number]) & (r["start"] > r["start"][first][number])
            state = pack(doc=r["doc"].astype(np.int32), start=r["start"], n=r["n"].astype(np.int32), frag=number.astype(np.int32), settled=later, lead=r["lead"][first].astype(np.int32), shard=shard_of(r["anchor"][first], shards).astype(np.int32))
            rows = [(block.number, -1, "state", state)]
            u = {"anchor": r["anchor"][first], "frag": r["frag"][first], "id": ids[first], "start": r["start"][first], "lead": r["lead"][first].astype(np.int16), "n": r["n"][first].astype(np.int16)}
            u |= {k: r[k][first] for k in CORES}
            rows += [(block.number, s, "fragments", pack(**{k: v[a:b] for k, v in u.items()})) for s, a, b in by_shard(u["anchor"], shards)]
            return mail(rows)

        def answer(rows: list[tuple[int, bytes]]):
            parts = [unpack(d) for _, d in rows]
            at = np.cumsum([0, *(len(p["frag"]) for p in parts)])
            anchor, frag, ids, start = (np.concatenate([p[k] for p in parts]) for k in ("anchor", "frag", "id", "start"))
            order = np.lexsort((start, ids, frag, anchor))
            a, f = anchor[order], frag[order]
            new_a = np.concatenate(([True], a[1:] != a[:-1]))
            new = new_a | np.concatenate(([True], f[1:] != f[:-1]))
            first = np.flatnonzero(new)[np.cumsum(new) - 1]
            later = ids[order] > ids[order][first]
            if kind.within:
                later |= (ids[order] == ids[order][first]) & (start[order] > start[order][first])
            code = np.zeros(len(order), np.uint8)
            group = np.cumsum(new_a) - 1
            lead, n = (np.concatenate([p[k] for p in parts]).astype(np.int64)[order] for k in ("lead", "n"))
            for k in range(PARTS):
                least, most = k * kind.part, (k + 1) * kind.part - 1
                has = (lead >= least) & (lead - n + 1 <= most)
                one = np.flatnonzero(new & has)  # each distinct fragment once
                key = np.stack((group[one].astype(np.uint64), np.concatenate([p[CORES[k]] for p in parts])[order][one].astype(np.uint64)))
                _, inverse, count = np.unique(key[0] << np.uint64(32) | key[1], return_inverse=True, return_counts=True)
                code[order[one]] |= ((count[inverse] > 1).astype(np.uint8) << k).astype(np.uint8)
            # Rows that repeat a fragment's first place in another block share its code.
            code[order] = np.where(later, SETTLED, code[order][first])
            return [(b, code[at[i] : at[i + 1]].tobytes()) for i, (b, _) in enumerate(rows)]

        sent = materialize(self.with_mail(repeated, send, MAIL), "repeats-sent")
        answers = materialize(self.at_shards(sent.where(F.col("kind") == "fragments"), answer), "repeats-codes")
        return sent.where(F.col("kind") == "state"), answers.withColumn("kind", F.lit("codes"))

    def settle(self, own, schema: str, finish) -> DataFrame:
        """Runs all steps. ``own(exchange, state and codes)`` is the operator's method for the open
        fragments: it gives mail of the kinds ``places`` and ``verdict`` (see ``open_bits``);
        ``finish(block, covers)`` makes a block's rows from the covered stretches of each document."""
        kind = self.kind
        state, codes = self.fragments(self.anchors())
        known = materialize(state.unionByName(codes), "repeats-known")
        verdicts = own(self, known)

        def run(block: Block, got: dict) -> pa.Table:
            s, code = read_state(got)
            covers: list[list] = [[] for _ in block.texts]
            if s is not None:
                whole = s["settled"] | (code[s["frag"]] == SETTLED)
                for d, a, n in zip(s["doc"][whole].tolist(), s["start"][whole].tolist(), s["n"][whole].tolist(), strict=True):
                    covers[d].append((a, a + n - 1 + kind.window))
                if "places" in got:
                    bits = open_bits(got)
                    for r, k in repeated_windows(s, code, kind, bits):
                        cut = np.flatnonzero(np.diff(k) > 1) + 1
                        base = int(s["start"][r])
                        for part in np.split(k, cut):
                            covers[int(s["doc"][r])].append((base + int(part[0]), base + int(part[-1]) + kind.window))
            return finish(block, covers)

        return self.with_mail(known.unionByName(verdicts), run, schema)


def read_state(got: dict) -> tuple[dict | None, np.ndarray]:
    """The block's runs and the code of each of its fragments."""
    if "state" not in got:
        return None, np.zeros(0, np.uint8)
    code = np.frombuffer(b"".join(got.get("codes", [])), np.uint8)
    return unpack(got["state"][0]), code


@dataclass
class Open:
    """A block's open windows, fragment by fragment: the fragment's number, its first run, and the
    window's place in the fragment."""

    frag: np.ndarray
    run: np.ndarray
    k: np.ndarray


def open_windows(s: dict, code: np.ndarray, kind: Symbols) -> Open:
    first = np.unique(s["frag"], return_index=True)[1]
    number = np.flatnonzero((code != 0) & (code != SETTLED))
    n = s["n"][first[number]].astype(np.int64)
    frag = np.repeat(number, n)
    k = np.arange(len(frag)) - np.repeat(np.cumsum(n) - n, n)
    part = (s["lead"][frag] - k) // kind.part
    kept = (code[frag] >> part.astype(np.uint8) & 1).astype(bool)
    return Open(frag[kept], first[frag[kept]], k[kept])


def repeated_windows(s: dict, code: np.ndarray, kind: Symbols, bits: np.ndarray):
    """(run, places of its windows that are repeats) of the runs with open windows."""
    own = open_windows(s, code, kind)
    frag, k = own.frag[bits], own.k[bits]
    runs_of = np.flatnonzero(~s["settled"])
    left, right = np.searchsorted(frag, s["frag"][runs_of]), np.searchsorted(frag, s["frag"][runs_of], side="right")
    for r, a, b in zip(runs_of[right > left].tolist(), left[right > left].tolist(), right[right > left].tolist(), strict=True):
        yield r, k[a:b]


def open_bits(got: dict) -> np.ndarray:
    """The verdicts on the block's open windows, fragment by fragment. Answers, in order of shard,
    hold a count and that many bits; ``places`` tells which bit each window has, and which windows
    the block itself knows to be repeats."""
    where, bits = unpack(got["places"][0]), [np.zeros(0, np.uint8)]
    for d in got.get("verdict", []):
        bits.append(np.unpackbits(np.frombuffer(d[8:], np.uint8), count=int.from_bytes(d[:8], "little")))
    return np.concatenate(bits)[where["at"]].astype(bool) | where["known"]


def in_blocks(rows: DataFrame) -> DataFrame:
    """Numbers the rows by blocks of bounded bytes, within each input partition."""
    rows = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def run(batches):
        number, size = TaskContext.get().partitionId() << 24, 0
        for batch in batches:
            lens = [len(t) for t in text_bytes(batch.column("text"))]
            own = []
            for n in lens:
                if size and size + n > BLOCK_BYTES:
                    number, size = number + 1, 0
                size += n
                own.append(number)
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), batch.column("doc_id"), batch.column("text")], names=["block", "doc_id", "text"])

    return rows.mapInArrow(run, "block long, doc_id long, text string")
