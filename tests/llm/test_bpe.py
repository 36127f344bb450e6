import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from fleetmatch.llm import bpe
from tests.llm.helpers import ODD_TEXTS, by_id, no_documents, odd_documents


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(bpe.DEFAULT_RANKS),
                             special_tokens={})


def test_ids_are_those_of_the_library(library):
    codec, rng = bpe.codec(), random.Random(3)
    parts = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "ß", "İ", "中", "文", "🙂", "1", "23",
             "½", "'s", "'ll", ".", "!!", "$$$", "́", "א", "ш", "﻿", "\x00"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(30)))
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == library.encode_ordinary(text), text


def test_bounded_tables_do_not_change_results(library):
    small = bpe.Transducer(bpe.load_ranks(bpe.DEFAULT_RANKS), max_states=20)
    rng = random.Random(4)
    for _ in range(300):
        piece = "".join(rng.choice("abcdefghijklmno") for _ in range(rng.randrange(1, 40)))
        assert small.encode(piece.encode()) == library.encode_ordinary(piece)
    table = bpe.Pieces(small, most=3)
    words = ["hello", "there", "hello", "you", "again", "hello"] * 3
    assert [table[w] for w in words] == [bpe.Pieces(small)[w] for w in words]


def test_one_very_long_piece(library):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefgh") for _ in range(50000))
    assert np.frombuffer(bpe.codec().encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_stream_cuts_between_characters():
    codec = bpe.codec()
    text = "naïve 中文 🙂🙂 ok"
    assert list("".join(codec.decode_stream(codec.encode(text), step=1))) == list(text)
    for part in codec.decode_stream(codec.encode(text), step=1):
        part.encode("utf-8")
    broken = np.array([bpe.load_ranks(bpe.DEFAULT_RANKS)[b"\xe4"]], "<u4").tobytes()
    assert "".join(codec.decode_stream(broken)) == "�"


def test_digest_of_odd_rows(spark, library):
    rows = by_id(bpe.bpe_digest(odd_documents(spark)))
    for doc_id, text in ODD_TEXTS:
        ids = library.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        assert rows[doc_id][0] == (len(ids), hashlib.sha256(packed).hexdigest(),
                                   hashlib.sha256((text or "").encode()).hexdigest())
    assert len(rows[1]) == 2
    assert bpe.bpe_digest(no_documents(spark)).count() == 0
