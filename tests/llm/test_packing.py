import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from fleetmatch.llm import packing
from fleetmatch.llm.common import read_table
from tests.llm.helpers import ODD_TEXTS, documents, no_documents, odd_documents


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(packing.DEFAULT_TOKENIZER)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [1]


def test_ids_are_those_of_the_library(library, monkeypatch):
    rng, encoder = random.Random(3), packing.ByteTokenizer(packing.DEFAULT_TOKENIZER)
    monkeypatch.setattr(packing.slices, "__defaults__", (7,))  # so that short texts are cut too
    parts = ["a", "B", "é", "'s", " ", " ", "\n", "\t", "<|endoftext|>", "\x85", " ", "́", "½", "7", "..", "中", "ß",
             "\r\n", "\x00", "\x1c", "\xa0", "ÀÉ", "<", "\x7f", "ǅ", "ªº", "᠎", "’t", "​", " word"]
    for latin in (True, False):
        known = [p for p in parts if not latin or max(map(ord, p)) < 0x250 and "<|" not in p]
        for _ in range(6000):
            text = "".join(rng.choice(known) for _ in range(rng.randrange(24)))
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() + [1] == ids_of(library, text), repr(text)


def test_long_runs_and_the_way_without_ranks(library):
    for ranks in (True, False):
        encoder = packing.ByteTokenizer(packing.DEFAULT_TOKENIZER)
        assert encoder.by_ranks
        encoder.by_ranks = encoder.by_ranks if ranks else None
        for text in (" " * 50000 + "a", "\n" * 3000, " \n" * 2000 + "x", "a" * 20000, "!" * 5000, "é" * 9000, "1 2\t3" * 900,
                     "中 " * 999, "one two " * 99999):
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() + [1] == ids_of(library, text)


def plain_windows(lengths, capacity, count):
    """The rule by plain lists: (document, start, length) per full window, and the windows left open."""
    full, open_windows = [], []
    for doc, length in enumerate(lengths):
        start = 0
        while length >= capacity:
            full.append([(doc, start, capacity)])
            start, length = start + capacity, length - capacity
        while length:
            spaces = [capacity - sum(p[2] for p in w) for w in open_windows]
            fitting = [space for space in spaces if space >= length]
            if fitting:
                window, taken = open_windows[spaces.index(min(fitting))], length
            elif len(open_windows) < count:
                window, taken = [], length
                open_windows.append(window)
            else:
                window, taken = open_windows[spaces.index(min(spaces))], min(spaces)
            window.append((doc, start, taken))
            start, length = start + taken, length - taken
            if sum(p[2] for p in window) == capacity:
                open_windows.remove(window)
                full.append(window)
    return full, open_windows


@pytest.mark.parametrize("capacity,count", [(8, 1), (16, 3), (50, 4), (64, 7)])
def test_windows_follow_the_rule(capacity, count):
    rng = random.Random(capacity)
    lengths = [rng.randrange(1, 2 * capacity) for _ in range(400)]
    windows = packing.Windows(capacity, count)
    full = [w for doc, n in enumerate(lengths) for _, w in windows.place(doc, 0, n)]
    wanted, still_open = plain_windows(lengths, capacity, count)
    assert full == wanted and len(still_open) <= count
    assert sorted(w for _, w in windows.rest()) == sorted(still_open)
    rest = [w for _, w in windows.finish()]
    sizes = [sum(p[2] for p in w) for w in rest]
    assert all(size == capacity or size.bit_count() == 1 for size in sizes)
    assert sum(sizes) == sum(p[2] for w in still_open for p in w)


def check(found, rows, library, capacity=packing.CAPACITY):
    """All ids of all rows, each once, in sequences without gaps that need no padding."""
    wanted = {}
    for doc_id, text in rows:
        wanted.setdefault((doc_id, tuple(ids_of(library, text))), []).append(1)
    ids = {}
    for r in found:
        piece = np.frombuffer(r.ids, "<u4").tolist()
        assert len(piece) == r.length > 0
        ids.setdefault((r.id, r.doc_tokens), []).append((r.start, piece))
    assert sum(len(p) for pieces in ids.values() for _, p in pieces) == sum(
        len(key[1]) * len(n) for key, n in wanted.items())
    if len({r[0] for r in rows}) == len(rows):
        for (doc_id, total), pieces in ids.items():
            whole = [i for _, piece in sorted(pieces) for i in piece]
            assert (doc_id, tuple(whole)) in wanted and len(whole) == total
            assert [s for s, _ in sorted(pieces)] == np.cumsum([0, *(len(p) for _, p in sorted(pieces))])[:-1].tolist()
    held = {}
    for r in found:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in held.values():
        place = 0
        for offset, length in sorted(pieces):
            assert offset == place
            place += length
        assert place == capacity or (place < capacity and place.bit_count() == 1)


def test_whole_table(spark, sf_dir, library):
    docs = read_table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(packing.pack(docs).collect(), rows, library)
    check(packing.pack(docs.repartition(7), capacity=100, windows=3, fan=2).collect(), rows, library, 100)
    tokens = {doc_id: ids_of(library, text) for doc_id, text in rows}
    for r in packing.packing_digest(docs).collect():
        part = tokens[r.doc_id][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes()) and r.doc_tokens == len(tokens[r.doc_id])


def test_odd_rows_and_none(spark, library):
    found = packing.pack(odd_documents(spark)).collect()
    check(found, ODD_TEXTS, library)
    assert {r.id for r in found} == {i for i, _ in ODD_TEXTS}
    assert packing.pack(no_documents(spark)).count() == 0
    # Without an end id, empty texts have no piece.
    bare = packing.pack(documents(spark, [(1, None), (2, ""), (3, "x")]), end_id=None).collect()
    assert [r.id for r in bare] == [3]


def test_sequences_are_padded(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    packed = packing.pack(docs.limit(40), capacity=100)
    for row in packing.sequences(packed, 100, pad_id=9).collect():
        ids = np.frombuffer(bytes(row.ids), "<u4")
        assert row.n_tokens == sum(p.length for p in row.pieces)
        assert len(ids) == (row.n_tokens if row.n_tokens.bit_count() == 1 else 100)
        assert (ids[row.n_tokens:] == 9).all()
