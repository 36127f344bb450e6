import random

import numpy as np
import pytest

from fleetmatch.llm import decontaminate as dc
from fleetmatch.llm.common import read_table
from tests.llm.helpers import by_id, documents, no_documents, odd_documents


def table(pattern, text, anchored=False):
    """The distance table in full: best distance of the pattern ending anywhere, and where first."""
    row = list(range(len(text) + 1)) if anchored else [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        below = [i]
        for j, b in enumerate(text, 1):
            below.append(min(row[j] + 1, below[j - 1] + 1, row[j - 1] + (a != b)))
        row = below
    return min(row), row.index(min(row))


def test_bit_vectors_agree_with_the_table():
    rng = random.Random(0)
    for _ in range(3000):
        pattern = [rng.randrange(4) for _ in range(rng.randrange(1, 9))]
        text = [rng.randrange(4) for _ in range(rng.randrange(14))]
        for anchored in (False, True):
            assert dc.best_match(dc._masks(pattern), len(pattern), text, anchored) == table(pattern, text, anchored)
    long = [rng.randrange(50) for _ in range(200)]
    assert dc.best_match(dc._masks(long), 200, [1] + long[:100] + [99] + long[101:] + [2]) == (1, 201)


def items(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "item_id long, text string, TEXT string")


@pytest.mark.parametrize("size", [60, 6])  # with few words an item has many occurrences, better and worse ones
def test_every_edit_within_the_budget_is_found(spark, size):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(size)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(5, 30))) for _ in range(12)]
    rows, lists = [], [t.split() for t in texts]
    for i in range(250):
        words = list(rng.choice(lists))
        for _ in range(rng.randrange(8)):
            at = rng.randrange(len(words) + 1)
            words[at:at + rng.randrange(2)] = rng.choices(vocabulary, k=rng.randrange(2))
        before, after = (" ".join(rng.choices(vocabulary, k=rng.randrange(20))) for _ in range(2))
        rows.append((i, f"{before} {' '.join(words)} {after}".upper()))
    found = {(r.doc_id, r.item_id): r.distance for r in dc.leak_digest(documents(spark, rows), items(spark, texts)).collect()}
    wanted = {}
    for i, text in rows:
        for j, item in enumerate(lists):
            distance = table(item, text.lower().split())[0]
            if distance <= int(0.2 * len(item)):
                wanted[i, j] = distance
    assert found == wanted and len(wanted) > 100


def test_places_and_short_items(spark):
    docs = documents(spark, [(1, "Say: one TWO, three; four five six!"), (2, "yes"), (3, "yes it is"), (4, "Yes!")])
    found = by_id(dc.leak_digest(docs, items(spark, ["one two three four five", "yes", "", None])))
    assert found == {1: [(0, 0, 1, 6)], 2: [(1, 0, 0, 1)], 4: [(1, 0, 0, 1)]}


def test_the_benchmark_in_the_documents(spark):
    docs, bench = (read_table(spark, "/root/testdata/sf0.01", name) for name in ("documents", "benchmark"))
    wanted = set()
    listed = [(r.item_id, dc.words_of([r.text]).hashes) for r in bench.collect()]
    for doc in docs.collect():
        words = dc.words_of([doc.text]).hashes.tolist()
        for item_id, item in listed:
            # Without one run of eight words in common there is no occurrence of these items.
            runs = {tuple(item[i:i + 4].tolist()) for i in range(len(item) - 3)}
            if any(tuple(words[i:i + 4]) in runs for i in range(len(words) - 3)):
                if table(item.tolist(), words)[0] <= int(0.2 * len(item)):
                    wanted.add((doc.doc_id, item_id))
    found = dc.leak_digest(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == wanted and wanted
    kept = {r.doc_id for r in dc.drop_leaks(docs, bench).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {i for i, _ in wanted}


def test_items_in_blocks(spark, monkeypatch):
    texts = [f"alpha{i} beta{i} gamma{i} delta{i} epsilon{i} zeta{i}" for i in range(30)]
    docs = documents(spark, [(i, f"x {t} y") for i, t in enumerate(texts)])
    monkeypatch.setattr(dc, "BLOCK_BYTES", 200)
    assert sorted((r.doc_id, r.item_id) for r in dc.leak_digest(docs, items(spark, texts)).collect()) == [(i, i) for i in range(30)]
    assert dc.drop_leaks(docs, items(spark, texts)).count() == 0


def test_odd_rows(spark):
    docs, bench = odd_documents(spark), items(spark, ["lorem ipsum dolor sit amet", None, "one two three", "one two three"])
    found = dc.leak_digest(docs, bench).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in found) == sorted(
        [("4", 0)] + [(i, j) for i in ("1", "1", "None") for j in (2, 3)])
    kept = dc.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(r[0] for r in kept.collect()) == [2, 3, 5, 6, 7, 8]
    assert dc.leak_digest(no_documents(spark), bench).count() == 0
    assert dc.leak_digest(docs, bench.limit(0)).count() == 0 and dc.drop_leaks(docs, bench.limit(0)).count() == docs.count()
    assert np.array_equal(dc.words_of([None, "a b"]).first, [0, 0, 2])
