import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetmatch.llm import divergence
from fleetmatch.llm.common import pick, read_table
from tests.llm.helpers import documents, no_documents, odd_documents
from tests.oracle import connect, difference


def plain(rows, least=30, top=50):
    """The contract, row by row: rows are (text, lang, source)."""
    rows = [tuple(value or "" for value in row) for row in rows]
    terms = [re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
             for text, _, _ in rows]
    out = set()
    for lang in {lang for _, lang, _ in rows}:
        held, counts = {}, {}
        for (_, row_lang, source), found in zip(rows, terms):
            if row_lang == lang:
                counts.setdefault(source, {})
                for term in found:
                    counts[source][term] = counts[source].get(term, 0) + 1
                for term in set(found):
                    held[term] = held.get(term, 0) + 1
        kept = sorted(term for term, n in held.items() if n >= least)
        counts[None] = {term: sum(c.get(term, 0) for c in counts.values()) for term in kept}
        shares = {}
        for source, counted in counts.items():
            total = sum(counted.get(term, 0) for term in kept)
            shares[source] = {t: 1 + 1000000000 * (counted.get(t, 0) + 5) // (total + 5 * len(kept)) for t in kept}
        for source in counts.keys() - {None}:
            pairs = [(other, sum(abs(shares[source][t] - shares[other][t]) for t in kept))
                     for other in counts.keys() - {None, source}]
            more = [(t, shares[source][t] - shares[None][t]) for t in kept
                    if counts[source].get(t) and shares[source][t] > shares[None][t]]
            for part, listed in (("pair", pairs), ("term", more)):
                listed.sort(key=lambda r: (-r[1], r[0].encode()))
                listed = listed if part == "pair" else listed[:top]
                out |= {(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(listed)}
    return out


def found(frame):
    rows = [tuple(r) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def random_docs(spark, rng, n=600):
    words = ["alpha", "Beta", "GAMMA", "é", "É", "naïve", "中文", "x", "don't", "a_b", "q9q", "k", "zeta", "eta", "\xa0"]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words[:rng.randrange(1, len(words))]) for _ in range(rng.randrange(12)))
        rows.append((i, rng.choice([text, text, None]), rng.choice(["en", "fr", None, ""]), rng.choice("abcdefg")))
    frame = documents(spark, [(i, t, l) for i, t, l, _ in rows])
    sources = spark.createDataFrame([(i, s) for i, _, _, s in rows], "doc_id bigint, source string")
    return frame.drop("source").join(sources, "doc_id"), [(t, l, s) for _, t, l, s in rows]


@pytest.mark.parametrize("bits", [64, 3, 1])
def test_random_documents_and_shared_digests(spark, bits):
    """With few bits every digest has several terms, some of them in too few documents."""
    frame, rows = random_docs(spark, random.Random(bits))
    assert found(divergence.divergence(frame, bits=bits)) == plain(rows)
    assert found(divergence.divergence(frame, bits=bits, min_documents=5, top=3)) == plain(rows, 5, 3)


def test_blocks_and_many_sources(spark, monkeypatch):
    frame, rows = random_docs(spark, random.Random(4))
    docs = pick(frame, {name: name for name in ("text", "lang", "source")})
    wanted = plain(rows)
    for cells, pairs, terms in ((8, 1 << 21, 10), (1 << 18, 60, 1000), (20, 4, 5)):
        # Set in the tasks too: the values are read from the module the functions carry.
        for name, value in (("BLOCK_CELLS", cells), ("PAIR_CELLS", pairs), ("TABLE_TERMS", terms)):
            monkeypatch.setattr(divergence, name, value)
        block = divergence._Block("en")
        block.absent = [3, 5]
        assert divergence.BLOCK_CELLS == cells and not block.is_full((1, b""))
        assert found(divergence.divergence(docs)) == wanted


def test_sql(spark, sf_dir):
    assert difference(divergence.divergence(read_table(spark, sf_dir, "documents")), connect(sf_dir),
                      divergence.ORACLE) is None


def test_whole_table(spark, sf_dir):
    table = read_table(spark, sf_dir, "documents")
    rows = [tuple(r) for r in table.select("text", "lang", "source").collect()]
    assert found(divergence.divergence(table, min_documents=3)) == plain(rows, 3)
    # Every text in one group but one: no pair loses a term.
    hot = table.withColumn("source", F.when(F.col("doc_id") > 0, "hot").otherwise("cold"))
    rows = [tuple(r) for r in hot.select("text", "lang", "source").collect()]
    assert found(divergence.divergence(hot)) == plain(rows)


def test_odd_rows_and_none(spark):
    frame = odd_documents(spark)
    rows = [tuple(r) for r in pick(frame, {name: name for name in ("text", "lang", "source")}).collect()]
    for least in (1, 30):
        assert found(divergence.divergence(frame, min_documents=least)) == plain(rows, least)
    empty = divergence.divergence(no_documents(spark))
    assert empty.count() == 0 and empty.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_slices_end_between_terms():
    text = "Ähm, wörd Wörd é... end".encode() * 50
    whole = divergence.terms_of(text)
    for most in (1, 2, 3, 10, 100):
        assert [t for part in divergence._slices(text, most) for t in divergence.terms_of(part)] == whole


def test_more_digests_than_tasks_are_given(spark, monkeypatch):
    frame, rows = random_docs(spark, random.Random(5), 300)
    wanted = plain(rows)
    monkeypatch.setattr(divergence, "MAX_SHIPPED", 0)
    for bits in (64, 2):
        assert found(divergence.divergence(frame, bits=bits)) == wanted


def test_a_task_tells_a_term_once_and_counts_by_number(spark, monkeypatch):
    from collections import Counter

    rng = random.Random(12)
    rows = [(" ".join(rng.choice(["Aa", "bb", "cé", "unwanted", "x" * 70]) for _ in range(30)), "en", rng.choice("st"))
            for _ in range(200)]
    kept = [b"aa", b"bb", "cé".encode(), b"x" * 70]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").coalesce(1)
    wanted = spark.sparkContext.broadcast({"en": np.sort(divergence._digests(kept, 64))})
    found = divergence.term_counts(docs, wanted, 64).collect()
    told = [r["word"] for r in found if r["word"] is not None]
    assert sorted(map(bytes, told)) == sorted(kept)
    digest = dict(zip(divergence._digests(kept, 64).tolist(), kept))
    counts = Counter({(r["source"], digest[r["digest"]]): r["n"] for r in found if r["n"] is not None})
    assert counts == Counter((source, word) for text, _, source in rows for word in divergence.terms_of(text.encode())
                             if word in kept)
    assert len([r for r in found if r["n"] is not None]) == len(counts)
