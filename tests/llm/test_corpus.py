"""Operators that look at the whole corpus, each against brute force."""

import hashlib
import math
import random
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from terrasift.llm import blocks, jaccard, lm, substring, trie

from .helpers import corpus, frame, words


@pytest.fixture(params=[1 << 30, 1500], ids=["one block", "many blocks"])
def block_bytes(request, monkeypatch):
    """Blocks of any size give the same results; local rows have an estimated size too."""
    monkeypatch.setattr(blocks, "BLOCK_BYTES", request.param)
    return request.param


def brute_removed(rows, window):
    seen = Counter()
    split = [words(t) for _, t in rows]
    for w in split:
        seen.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, split, strict=True):
        stays = [True] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                stays[i : i + window] = [False] * window
        kept = [x for x, s in zip(w, stays, strict=True) if s]
        out.append((doc, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("window", [35, 8, 1])
def test_substring_equals_brute_force(spark, block_bytes, window):
    rows = corpus(window)
    got = substring.mark(frame(spark, rows), window).drop("kept")
    assert Counter(map(tuple, got.collect())) == brute_removed(rows, window)


def test_substring_empty(spark):
    assert substring.mark(frame(spark, [])).count() == 0


@pytest.mark.parametrize("period", substring.COVERS)
def test_covers_meet_every_difference(period):
    d = substring.COVERS[period]
    assert {(a - b) % period for a in d for b in d} == set(range(period))


def brute_components(rows, size=5, percent=80):
    sets = []
    for _, t in rows:
        w = words(t, lower=True)
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)].append(doc)
    return Counter((doc, len(sets[i]), (min(least[find(i)], default=None) if sets[i] else doc)) for i, (doc, _) in enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_equals_brute_force(spark, block_bytes, seed):
    rows = corpus(seed, n=80)
    assert Counter(map(tuple, jaccard.link(frame(spark, rows)).collect())) == brute_components(rows)


def near_group(n, size, edits, seed):
    rng = random.Random(seed)
    base = [f"v{i}" for i in range(size)]
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(size)] = f"e{rng.randrange(10_000)}"
        rows.append((i, " ".join(text)))
    return rows


def test_product_cells_equal_set_overlaps():
    """Blocks of columns, repeated rows, rows of one shingle, and similarities at the bound."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    pool = np.unique(rng.integers(0, 1 << 48, 400, dtype=np.uint64))
    sets = [np.sort(rng.choice(pool, rng.integers(1, 200), replace=False)) for _ in range(20)]
    sets += [np.sort(np.delete(sets[i % 20], slice(0, k))) for i, k in enumerate((1, 2, 5, 20, 40) * 4) if len(sets[i % 20]) > k]
    sets += [pool[:100], pool[:80], pool[:79], pool[20:120], pool[:1]]
    pairs = [(i, j) for i in range(len(sets)) for j in range(len(sets)) if i < j]
    a, b = (np.array(x) for x in zip(*pairs, strict=True))
    data = [blocks.squeeze(x, jaccard.SET_BYTES) for x in sets]
    arrays = lambda x: (pa.array(x, pa.int64()), pa.array([len(sets[i]) for i in x], pa.int64()), pa.array([data[i] for i in x], pa.binary()))
    got = jaccard._cells(*arrays(a), *arrays(b), 80)
    want = []
    for i, j in pairs:
        both = len(np.intersect1d(sets[i], sets[j]))
        want.append(100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both))
    assert got.tolist() == want and 0 < sum(want) < len(want)


def test_jaccard_deals_long_columns(spark, block_bytes, monkeypatch):
    monkeypatch.setattr(jaccard, "COLUMN_ROWS", 3)
    monkeypatch.setattr(jaccard, "ENTRIES_AT_ONCE", 50)
    test_jaccard_equals_brute_force(spark, block_bytes, 6)


def test_jaccard_on_a_group_of_near_copies(spark):
    rows = near_group(120, 120, 7, 5)
    assert Counter(map(tuple, jaccard.link(frame(spark, rows, extra=False)).collect())) == brute_components(rows)


def test_jaccard_without_pivot_rounds(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PIVOT_ROUNDS", 0)
    rows = near_group(60, 100, 6, 6)
    assert Counter(map(tuple, jaccard.link(frame(spark, rows, extra=False)).collect())) == brute_components(rows)


def test_jaccard_edges(spark):
    assert jaccard.link(frame(spark, [])).count() == 0
    # Exactly 80 percent: 8 shared of 10.
    rows = [(1, " ".join(f"a{i}" for i in range(13))), (2, " ".join(f"a{i}" for i in range(12)) + " b c"), (3, "A b"), (4, "a  B"), (5, "a b c")]
    assert Counter(map(tuple, jaccard.link(frame(spark, rows)).collect())) == brute_components(rows)


def test_representatives(spark):
    rows = corpus(3, n=50)
    want = Counter()
    for (doc, _, component), n in brute_components(rows).items():
        if doc is None or component is None or doc == component:
            want[doc] += n if doc is None else 1
    kept = jaccard.representatives(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert Counter(r.doc_id for r in kept.collect()) == want


def test_representatives_with_clashing_names(spark):
    words = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, words, 7, "a"), (2, words, 8, "b"), (3, "else", 9, "c")], "doc_id int, text string, _id int, __id string")
    assert sorted(tuple(r) for r in jaccard.representatives(docs).collect()) == [(1, words, 7, "a"), (3, "else", 9, "c")]
    assert jaccard.representatives(docs.limit(0)).count() == 0


def brute_lm(rows):
    split = [(d, [*words(t, lower=True), "\n"]) for d, t in rows]
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    c, b = Counter(), Counter()
    for d, w in split:
        if not held[d]:
            c.update(w)
            b.update(zip(["\n", *w[:-1]], w, strict=True))
    kinds = Counter(v for v, _ in b)
    n, k = sum(c.values()), len(c)
    out = []
    for d, w in split:
        p1 = [(c[x] + 1) / (n + k + 1) for x in w]
        total = 0.0
        for v, x, p in zip(["\n", *w[:-1]], w, p1, strict=True):
            total += math.log10(max(b[v, x] - lm.DISCOUNT, 0) / c[v] + lm.DISCOUNT * kinds[v] / c[v] * p if c[v] else p)
        out.append((d, held[d], len(w), sum(c[x] > 0 for x in w), n, sum(map(math.log10, p1)), total))
    return out


@pytest.mark.parametrize("split", [1 << 18, 50])
def test_lm_equals_brute_force(spark, block_bytes, monkeypatch, split):
    monkeypatch.setattr(lm, "SPLIT", split)
    rows = corpus(9, n=70)
    order = lambda r: (r[0] is None, r[0] or 0, r[5])
    for g, w in zip(sorted(lm.score(frame(spark, rows)).collect(), key=order), sorted(brute_lm(rows), key=order), strict=True):
        assert tuple(g)[:5] == w[:5]
        assert g.base_score == pytest.approx(w[5], rel=1e-9)
        assert abs(g.score - w[6]) <= 0.021 * w[2]


def test_lm_edges(spark):
    assert lm.score(frame(spark, [])).count() == 0
    held = next(i for i in range(100) if lm.held_out(i))
    (r,) = lm.score(frame(spark, [(held, "a b")])).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)


def test_elias_fano_levels(tmp_path):
    rng = np.random.default_rng(4)
    for n, top in ((1, 5), (1000, 1 << 20), (5000, (1 << 62) - 1), (300, 310)):
        values = np.unique(rng.integers(0, top, n, dtype=np.uint64))
        for level in (trie.EliasFano(values), trie.EliasFano(values, tmp_path, f"l{n}")):
            assert (level.at(np.arange(len(values))) == values).all()
            asked = np.concatenate([values, values + np.uint64(1), rng.integers(0, top, 500, dtype=np.uint64), np.array([0, top, (1 << 63) - 1], np.uint64)])
            assert (level.successor(asked) == np.searchsorted(values, asked)).all()
            assert ((level.find(asked) >= 0) == np.isin(asked, values)).all()


def test_trie_holds_exactly_its_entries():
    """Dense contexts, words that differ in their last bit, and levels that stay packed."""
    rng = np.random.default_rng(7)
    contexts, words = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64)), np.arange(5_000, dtype=np.uint64) + np.uint64((1 << 56) - 5_000)
    key = np.unique(rng.integers(0, len(contexts) * len(words), 200_000))
    number, word = np.divmod(key, len(words))
    t = trie.Trie(contexts, words, number, word, rng.random(len(key)) * 0.9 + 0.05)
    assert (t.branching(contexts) == np.bincount(number, minlength=len(contexts))).all() and t.branching(contexts + np.uint64(1)).sum() == 0
    for i in (0, 17, 299):
        there = t.lookup(contexts[i : i + 1], np.array([len(words)]), words) != trie.ABSENT
        assert (np.flatnonzero(there) == word[number == i]).all()
    assert (t.lookup(contexts[:1], np.array([3]), np.array([0, 1, 2], np.uint64)) == trie.ABSENT).all()
    level = t.levels["successors"]
    assert level.low.nbytes + level.high.nbytes + level.ones.nbytes < 2 * len(key)
    empty = trie.Trie(contexts[:0], words[:0], key[:0], key[:0], np.zeros(0))
    assert empty.lookup(contexts[:2], np.array([1, 1]), words[:2]).tolist() == [trie.ABSENT] * 2 and empty.branching(contexts[:2]).sum() == 0


def test_quantised_probabilities():
    p = np.array([1.0, 0.5, 1e-3, 1e-9])
    assert np.abs(np.log10(trie.restore(trie.quantise(p))) - np.log10(p)).max() <= 0.5 / trie.STEPS + 1e-9
    assert trie.restore(np.array([trie.ABSENT], np.uint8))[0] == 0


@pytest.mark.parametrize("n", [1, 2, 7, 49, 300])
def test_each_block_has_its_own_partition(spark, n):
    names = blocks.block_names(n)
    assert len(set(names)) == n
    table = spark.createDataFrame([(b,) for b in names], "block int").repartition(n, "block").selectExpr("spark_partition_id() AS p")
    assert table.distinct().count() == n
    # Null and repeated ids are dealt too.
    rows = [(None, f"text {i}") for i in range(2_000)] + [(7, f"text {i}") for i in range(2_000)]
    sizes = [r["count"] for r in blocks.blocked(frame(spark, rows), "doc_id", "text", n).groupBy("block").count().collect()]
    assert len(sizes) == n and max(sizes) < 3 * 4_000 / n + 20


def test_window_hashes_depend_on_words_only():
    w = blocks.Words([b"a b c d e", b"x a b c d e y"], lower=False)
    h = w.windows(5)
    assert h[0] == h[6] and len({int(x) for x in h[w.fits(5)]}) == 3


@pytest.mark.parametrize("module", ["substring", "lm"])
def test_modules_import_what_they_use(module):
    """op2_substring_dedup, op8_lm_scoring: a fresh Python worker failed where nothing else had imported pyarrow.compute."""
    code = f"import sys, pyarrow; from terrasift.llm import {module}; sys.exit(not hasattr(pyarrow, 'compute'))"
    assert subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2]).returncode == 0
