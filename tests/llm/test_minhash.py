import random
import tracemalloc

import numpy as np
import pytest

from fleetmatch.llm import minhash, wordhash
from fleetmatch.llm.common import read_table
from fleetmatch.llm.graph import components
from tests.llm.helpers import by_id, documents, no_documents, odd_documents


def similarity(texts, inverse):
    """All pairs' similarity, by sets in plain Python."""
    sets = minhash.shingle_sets(texts)
    weights = minhash.weights_of(sets, inverse)
    listed = [dict(zip(sets.elements[a:b].tolist(), weights[a:b].tolist())) for a, b in zip(sets.first, sets.first[1:])]
    found = {}
    for i, a in enumerate(listed):
        for j, b in enumerate(listed[:i]):
            common = a.keys() & b.keys()
            if common:
                shared = sum(min(a[e], b[e]) for e in common)
                found[j, i] = shared / (sum(a.values()) + sum(b.values()) - shared)
    return found


def brute(texts):
    """The class of each text, by its first member."""
    counts = np.zeros(1 << minhash.FEATURE_BITS, np.int64)
    for text in texts:
        np.add.at(counts, np.unique(minhash.features_of(minhash.shingle_sets([text]).elements)), 1)
    inverse = minhash.inverse_frequencies(len(texts), counts)
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), share in similarity(texts, inverse).items():
        if share >= minhash.SIMILARITY:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    first = {}
    for i, text in enumerate(texts):
        a, b = sorted((root(i), root(first.setdefault(text or "", i))))
        parent[b] = a
    return [root(i) for i in range(len(texts))]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(words)


def test_samples_agree_as_often_as_the_similarity_says():
    rng = random.Random(1)
    base = [f"word{rng.randrange(400)}" for _ in range(400)]
    inverse = np.ones(1 << minhash.FEATURE_BITS)
    sampler, hits, expected = minhash.Sampler(), 0, 0.0
    for _ in range(40):
        texts = [edited(rng, base, 20), edited(rng, base, 20)]
        sets = minhash.shingle_sets(texts)
        bands = sampler.bands(sets, minhash.weights_of(sets, inverse))
        hits += (bands[0] == bands[1]).sum()
        shared = similarity(texts, inverse)[0, 1]
        expected += minhash.BANDS * shared ** minhash.ROWS
    assert abs(hits - expected) < 5 * np.sqrt(expected) + 10


def test_samples_take_bounded_memory_whatever_the_weights():
    rng = np.random.default_rng(7)
    elements = np.sort(rng.choice(1 << 40, 30000, replace=False)).astype(np.uint64)
    inverse = 1 + rng.integers(0, 17, 1 << minhash.FEATURE_BITS) / 16
    for most in (1, 1 << 14):  # one count for all; some 250 different weights
        sets = minhash.Sets(elements, rng.integers(1, most + 1, 30000), np.array([0, 10000, 30000]))
        weights = minhash.weights_of(sets, inverse)
        minhash.Sampler()
        tracemalloc.start()
        sampler = minhash.Sampler()
        sampler.bands(sets, weights)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 200 * len(elements), (len(np.unique(weights)), peak)


def test_words_are_the_same_in_slices_of_any_size(monkeypatch):
    texts = [None, "", "One two. three", "x" * 300, "a b " * 200, "é" * 90 + " end", "中文 words!", " \n"]
    whole = minhash.words_of(texts)
    for size in (1, 2, 5, 64, 1000):
        monkeypatch.setattr(wordhash, "SLICE", size)
        wordhash._powers.cache_clear()
        found = minhash.words_of(texts)
        assert (found.hashes == whole.hashes).all() and (found.first == whole.first).all()
    wordhash._powers.cache_clear()


def test_profiles_bound_what_texts_share(spark):
    rng = random.Random(8)
    base = [f"w{rng.randrange(90)}" for _ in range(150)]
    texts = [edited(rng, base, rng.randrange(60)) for _ in range(40)] + ["short", "a b c d e f " * 30]
    inverse = 1 + np.random.default_rng(8).integers(0, 17, 1 << minhash.FEATURE_BITS) / 16
    frame = spark.createDataFrame(list(enumerate(texts)), "node bigint, text string")
    rows = {r.node: r for r in minhash.profiles(frame, inverse).collect()}
    for (a, b), share in similarity(texts, inverse).items():
        most = sum(min(x, y) for x, y in zip(rows[a].fine, rows[b].fine))
        total = rows[a].total + rows[b].total
        assert most / (total - most) >= share - 1e-9
    pairs = spark.createDataFrame([(0, 0, i, i) for i in range(len(texts))], "band int, bucket bigint, node bigint, component bigint")
    kept = {(r.a, r.b) for r in minhash._all_pairs(pairs.join(minhash.profiles(frame, inverse), "node"), 0.5).collect()}
    similar = {pair for pair, share in similarity(texts, inverse).items() if share >= 0.5}
    assert similar and similar <= kept and len(kept) < len(texts) * (len(texts) - 1) / 2


def test_classes_are_those_of_all_pairs(spark):
    rng = random.Random(2)
    texts = []
    for group in range(25):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(40, 200))]
        texts += [edited(rng, base, rng.randrange(4)) for _ in range(rng.randrange(1, 14))]
    texts += texts[:20] + ["short text", "short text", "short", "", None, "!"]
    rng.shuffle(texts)
    rows = by_id(minhash.duplicate_digest(documents(spark, list(enumerate(texts)))))
    wanted = brute(texts)
    assert [rows[i][0][0] for i in range(len(texts))] == wanted
    assert all(rows[i][0][1] == wanted.count(wanted[i]) for i in range(len(texts)))


def test_a_large_group_and_a_common_passage(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(40))
    base = [f"b{i}" for i in range(150)]
    texts = [edited(rng, base, 1) for _ in range(300)] + [
        f"{passage} " + " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(100)) for _ in range(300)]
    rows = by_id(minhash.duplicate_digest(documents(spark, list(enumerate(texts)))))
    assert all(rows[i][0][:2] == (0, 300) for i in range(300))
    assert all(rows[i][0] == (i, 1) for i in range(300, 600))


def test_classes_of_the_documents(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    listed = sorted((r.doc_id, r.text) for r in docs.collect())
    wanted = brute([text for _, text in listed])
    rows = by_id(minhash.duplicate_digest(docs))
    assert [rows[i][0][0] for i, _ in listed] == [listed[w][0] for w in wanted]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = by_id(minhash.duplicate_digest(docs))
    assert rows[1] == [(1, 3)] * 2 and rows[None] == [(1, 3)]
    assert rows[2] == rows[3] == [(2, 2)] and rows[5] == [(5, 1)] and rows[4] == [(4, 1)]
    assert minhash.duplicate_digest(no_documents(spark)).count() == 0
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    assert sorted(str(r[0]) for r in kept.collect()) in (
        ["2", "4", "5", "6", "7", "8", "None"], ["1", "2", "4", "5", "6", "7", "8"])
    assert minhash.keep_one(no_documents(spark)).count() == 0


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(1, 2), (2, 1), (1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 200)],
    [(i, i ^ 1) for i in range(100)] + [(i, i ^ 8) for i in range(100)]])
def test_components(spark, edges):
    parent = {v: v for e in edges for v in e if e[0] != e[1]}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    assert {r.node: r.component for r in components(frame).collect()} == {v: root(v) for v in parent}
