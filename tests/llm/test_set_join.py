"""The Jaccard join against all pairs: graded near copies, common passages, rows that are hard to read."""

import random
import re

import numpy as np
import pytest

from labormart.llm import set_join as J

SCHEMA = "doc_id long, text string, n_shingles long, component_id string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(seed):
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdefghij", k=r.randint(2, 6))) for _ in range(300)]
    prose = lambda n: [r.choice(vocabulary) for _ in range(n)]
    texts = [None, "", " \t\n ", "one", "ONE", "two words", "Two  Words", "a\x0bb\x0cc d e", "same " * 200, "ünï cödé straße 日本 x"]
    passage = prose(40)
    for _ in range(12):
        base = prose(r.choice([30, 90, 200]))
        for _ in range(r.choice([1, 4, 15])):
            copy = list(base)
            for _ in range(r.choice([0, 1, 2, 3, 5, 8])):
                copy[r.randrange(len(copy))] = r.choice(vocabulary)
            if r.random() < 0.3:
                copy = copy + prose(r.randint(1, 12))
            texts.append(" ".join(copy))
    # Boilerplate with a few words around it: frequent shingles, sets about the threshold.
    texts += [" ".join(prose(r.randint(1, 7)) + passage + prose(r.randint(0, 4))) for _ in range(60)]
    texts += [" ".join(prose(20)) for _ in range(30)] + [" ".join(prose(3000))]
    rows = [(i, t, 0, "c") for i, t in enumerate(texts)]
    r.shuffle(rows)
    return [*rows, rows[5], (None, texts[12], 0, "c"), (None, " ".join(prose(50)), 0, "c"), (None, None, 0, "c"), (77, texts[20], 0, "c")]


def sets(text, words):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset([tuple(w[i : i + words]) for i in range(len(w) - words + 1)] if len(w) >= words else [tuple(w)] if w else [])


def expected(rows, words, percent):
    s = [sets(t, words) for _, t, *_ in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    links = 0
    for i in range(len(rows)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j]):
                up[top(i)] = top(j)
                links += 1
    least: dict = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return links, sorted(((d, len(s[i]), least.get(top(i)) if s[i] else d) for i, (d, *_) in enumerate(rows)), key=str)


@pytest.mark.parametrize(("seed", "words", "percent", "least", "long_"), [(1, 4, 85, 64, 256), (2, 4, 85, 5, 3), (3, 5, 80, 2, 2)])
def test_groups_equal_all_pairs(spark, seed, words, percent, least, long_):
    rows = table(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = J.jaccard_groups(docs, words, percent, least=least, long_=long_)
    links, want = expected(rows, words, percent)
    assert links > 100
    assert sorted((tuple(r)[:3] for r in got.collect()), key=str) == want


def test_empty(spark):
    assert J.jaccard_groups(spark.createDataFrame([], SCHEMA)).count() == 0
    one = J.jaccard_groups(spark.createDataFrame([(3, None, 0, ""), (2, "  ", 0, "")], SCHEMA)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in one) == [(2, 0, 2), (3, 0, 3)]


def _leaders(seed, n, size):
    r = np.random.default_rng(seed)
    base = r.integers(0, 1 << 60, size, dtype=np.uint64)
    out = []
    for _ in range(n):
        drop = r.random(size) < r.choice([0.01, 0.04, 0.08, 0.2])
        out.append(np.unique(np.concatenate((base[~drop], r.integers(0, 1 << 60, int(r.integers(0, 12)), dtype=np.uint64)))))
    return out


def _similar(x, y):
    o = len(np.intersect1d(x, y))
    return 100 * o / (len(x) + len(y) - o)


def test_posting_lists_skip_no_partner():
    """Of all pairs of sets that reach their similarity, none is skipped; some that cannot are."""
    sets_ = _leaders(1, 80, 120)
    r = [4 * (i % 3 == 0) for i in range(len(sets_))]
    rows = {k: [] for k in ("key", "cls", "n", "pos", "r")}
    for i, s in enumerate(sets_):
        for p, key in enumerate(s[: J.prefix_length(85 - r[i] - 4, len(s))]):
            for k, v in zip(rows, (key, i, len(s), p, r[i]), strict=True):
                rows[k].append(v)
    rows = {k: np.array(v, np.uint64 if k == "key" else np.int64) for k, v in rows.items()}
    order = np.lexsort((rows["cls"], rows["n"], rows["key"]))
    a, b, t = J.skipping_pairs({k: v[order].view(np.int64) for k, v in rows.items()}, 85)
    found = set(zip(a.tolist(), b.tolist(), strict=True))
    assert all(x == 85 - r[i] - r[j] for i, j, x in zip(a.tolist(), b.tolist(), t.tolist(), strict=True))
    want = {(i, j) for j in range(80) for i in range(j) if _similar(sets_[i], sets_[j]) >= 85 - r[i] - r[j]}
    assert want <= found and len(want) > 20 and len(found) < 80 * 79 / 2


def _connected(n, links):
    root = list(range(n))
    for a, b in links:
        ra, rb = root[a], root[b]
        root = [ra if x == rb else x for x in root]
    return [min(j for j in range(n) if root[j] == root[i]) for i in range(n)]


@pytest.mark.parametrize("cut", [None, 25])
def test_blocks_connect_what_links(cut):
    """One block with itself, or two blocks: the links connect what all linked pairs connect, at most one less
    than the sets there are; overlaps are mostly derived; close pairs with members are named."""
    sets_ = _leaders(2, 60, 200)
    r = np.array([4 * (i % 3 == 0) for i in range(60)])

    def side(i):
        own = np.empty(len(i), object)
        own[:] = [sets_[k] for k in i]
        return {"cls": np.array(i), "root": np.array(i), "n": np.array([len(sets_[k]) for k in i]), "r": r[i], "s": own}

    left, right = (range(60), range(60)) if cut is None else (range(cut), range(cut, 60))
    found, derived, fresh = J.block_links(side(list(left)), side(list(right)), cut is None, 85)
    pairs = [(i, j) for i in left for j in right if (i < j if cut is None else True)]
    linked = [(i, j) for i, j in pairs if _similar(sets_[i], sets_[j]) >= 85]
    groups = _connected(60, linked)
    got = [x[:2] for x in found if x[4]]
    assert _connected(60, got) == groups and len(got) < 60 and set(got) <= set(linked) and len(linked) > 2 * len(got)
    close = {(i, j) for i, j in pairs if 85 - r[i] - r[j] <= _similar(sets_[i], sets_[j]) < 85 and groups[i] != groups[j]}
    assert {x[:2] for x in found if not x[4]} == close
    assert all(o == len(np.intersect1d(sets_[a], sets_[b])) for a, b, _, o, _ in found)
    assert derived + fresh == len(left) and derived > len(left) / 3


def test_links_by_members():
    r = np.random.default_rng(5)
    hits = 0
    for _ in range(1500):
        y = np.unique(r.integers(0, 1 << 40, 100, dtype=np.uint64))
        w = np.unique(np.concatenate((y[int(r.integers(6, 12)) :], r.integers(0, 1 << 40, int(r.integers(0, 9)), dtype=np.uint64))))
        kin = []
        for s in (y, w):
            keep = [s[r.random(len(s)) > 0.03] for _ in range(3)]
            keep = [np.unique(np.concatenate((k, r.choice(np.concatenate((y, w)), 2)))) for k in keep]
            kin.append([s, *keep])
        own = [[(np.setdiff1d(k, s, True), np.setdiff1d(s, k, True)) for k in group] for s, group in zip((y, w), kin, strict=True)]
        want = any(_similar(a, b) >= 85 for a in kin[0] for b in kin[1])
        assert J.linked_by_members(y, w, *own, 85) == want
        hits += want and _similar(y, w) < 85
    assert hits > 5
