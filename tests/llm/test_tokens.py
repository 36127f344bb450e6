import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fleetmatch.llm import tokens
from tests.llm.helpers import ODD_TEXTS, documents, no_documents, odd_documents


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.DEFAULT_TOKENIZER)


def test_ids_are_those_of_the_library(library):
    rng, words = random.Random(2), tokens.WordTokenizer(tokens.DEFAULT_TOKENIZER, "<u4")
    parts = ["a", "B", "é", "'s", " ", "\n", "\t", "<|endoftext|>", "\x85", " ", "́", "½", "7", "..", "中", "İ", "ß",
             "\r\n", "K", "\x00", "\x1c", "\xa0", "ÀÉ", "<", "\x7f", "ǅ", "ªº"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(20)))
        assert np.frombuffer(next(words.encode([text])), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [1, 5, 63, 64, 65, 1000, 131072, 300001])
def test_round_trip_from_every_checkpoint(n):
    ids = np.random.default_rng(n).zipf(1.3, n).clip(1, 40000).astype(np.uint32)
    coder = tokens.Coder(tokens.Coder.scaled(np.bincount(ids)))
    lanes, words, marks = coder.encode(ids)
    for i, mark in enumerate(marks):
        stop = marks[i + 1][0] if i + 1 < len(marks) else None
        part = coder.decode(n, lanes, words, mark, stop)
        assert (part == ids[mark[0] * lanes:(n if stop is None else stop * lanes)]).all()


def test_frequencies_fill_the_scale():
    for counts in ([5], [0, 1], [1, 10 ** 12, 1], [1] * 49408):
        frequencies = tokens.Coder.scaled(np.array(counts))
        assert frequencies.sum() == 1 << tokens.SCALE and ((frequencies > 0) == (np.array(counts) > 0)).all()


def expected(rows, library):
    listed = [(i, library.encode(text or "", add_special_tokens=False).ids + [1]) for i, text in rows]
    start, out = 0, []
    for doc_id, ids in sorted(listed, key=lambda r: (r[0] is not None, r[0] or 0)):
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_digest_of_odd_rows(spark, library):
    found = sorted(map(tuple, tokens.token_digest(odd_documents(spark)).collect()), key=lambda r: r[1])
    assert found == expected(ODD_TEXTS, library)
    assert tokens.token_digest(no_documents(spark)).count() == 0


def test_documents_of_one_id_are_spread(spark, library):
    rows = [(7, f"text number {i}") for i in range(200)] + [(i, "x") for i in range(5)]
    found = sorted(map(tuple, tokens.token_digest(documents(spark, rows)).collect()), key=lambda r: r[1])
    assert len(found) == 205 and found[0][1] == 0
    for one, other in zip(found, found[1:]):
        assert one[0] <= other[0] and other[1] == one[1] + one[2]


def test_a_damaged_block_is_noticed(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "files")
    tokens.write_token_files(odd_documents(spark), path, files=2)
    spark.read.parquet(f"{path}/blocks").withColumn("crc32", F.col("crc32") + 1).write.parquet(f"{path}-bad/blocks")
    spark.read.parquet(f"{path}/table").write.parquet(f"{path}-bad/table")
    assert tokens.read_token_files(spark, path).count() == len(ODD_TEXTS)
    with pytest.raises(Exception, match="checksum"):
        tokens.read_token_files(spark, f"{path}-bad").collect()


def test_ids_are_counted_many_documents_at_a_time(monkeypatch):
    rng, calls = np.random.default_rng(5), []
    documents_ = [rng.integers(0, 50, rng.integers(0, 9)).astype("<u2") for _ in range(3000)]
    batches = [pa.RecordBatch.from_arrays([pa.array([d.tobytes() for d in documents_[a:b]], pa.binary())], ["ids"])
               for a, b in ((0, 1000), (1000, 1000), (1000, 3000))]
    whole = np.bincount(np.concatenate(documents_))
    counted = np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a, **b: calls.append(1) or counted(*a, **b))
    assert (tokens.id_counts(batches, "<u2") == whole).all() and len(calls) == 2
    monkeypatch.setattr(tokens, "BLOCK_IDS", 100)
    assert (tokens.id_counts(batches, "<u2") == whole).all()
    assert len(tokens.id_counts([], "<u2")) == 0


def test_tasks_of_a_worker_share_a_tokenizer():
    first = tokens.shared_tokenizer(tokens.DEFAULT_TOKENIZER, "<u2")
    assert tokens.shared_tokenizer(tokens.DEFAULT_TOKENIZER, "<u2") is first
    packed = tokens.shared_tokenizer(tokens.DEFAULT_TOKENIZER, "<u4")
    assert [len(next(t.encode(["a b"]))) for t in (first, packed)] == [4, 8]


def test_a_piece_is_looked_up_once_in_many_texts(library):
    words, asked = tokens.WordTokenizer(tokens.DEFAULT_TOKENIZER, "<u2"), []

    class Table(dict):
        def __getitem__(self, key):
            asked.append(key)
            return words._piece(key)

    words.pieces = Table()
    texts = ["The cat isn't", None, "the CAT", "", "cat, the"] * 200
    found = [np.frombuffer(ids, "<u2").tolist() for ids in words.encode(texts)]
    assert found == [library.encode(text or "", add_special_tokens=False).ids for text in texts]
    assert sorted(asked) == [b"'t", b",", b"cat", b"isn", b"the"]
    assert list(words.encode([])) == [] and list(words.encode([None, "", " \n", "\u2003"])) == [b""] * 4


def test_ids_of_many_texts_and_of_long_ones_are_those_of_the_library(library, monkeypatch):
    rng, words = random.Random(7), tokens.WordTokenizer(tokens.DEFAULT_TOKENIZER, "<u4")
    parts = ["a", "Be", "É", "œ", "Ⱥ", "İ", "ſ", "Σ", "ς", "K", "'", "'s", "'RE", "'l", "'ll", "'ve", "’", "“", "—", "…", "¿", "7", "٣",
             "½", ".", "!?", " ", " ", "\n", "\t", "\x85", "\xa0", "\u2003", "\x00", "\xad", "\u0301", "e\u0301", "中文", "가",
             "🙂", "×", "÷", "ʰ", "<|endoftext|>", "<|", "ɏ", "ɐ", "µ", "ª"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(20000)]
    wanted = [library.encode(text, add_special_tokens=False).ids for text in texts]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in words.encode(texts)] == wanted
    monkeypatch.setattr(tokens, "BATCH_BYTES", 9)
    assert [np.frombuffer(ids, "<u4").tolist() for ids in words.encode(texts)] == wanted
