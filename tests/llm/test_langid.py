from zlib import crc32

from fleetmatch.llm import langid
from fleetmatch.llm.common import read_table
from tests.llm.helpers import by_id, documents, no_documents, odd_documents

ENGLISH = "the cat and the dog went to the house with their friends"
FRENCH = "le chat et le chien sont dans la maison avec les amis"


def learned(spark):
    return langid.fit(documents(spark, [(i, ENGLISH, "en") for i in range(5)] + [(i, FRENCH, "fr") for i in range(5)]))


def test_words_then_character_runs(spark):
    model = learned(spark)
    scorer = langid.Scorer(model)
    assert scorer.predict(["the house", "la maison", "housing", "chiens", None, "", "123 ²", "中文"])[0] == [
        "en", "fr", "en", "fr", "und", "und", "und", "en"]
    known, backed_off = scorer["house"], scorer["houses"]
    assert known < len(model.scores) <= backed_off


def test_unseen_words_are_forgotten_without_a_trace(spark, monkeypatch):
    model = learned(spark)
    monkeypatch.setattr(langid, "MAX_UNSEEN", 2)
    small, large = langid.Scorer(model), langid.Scorer(model)
    texts = [f"{w} houses chiens" for w in "abcdefgh"]
    one = [small.predict([t]) for t in texts]
    monkeypatch.setattr(langid, "MAX_UNSEEN", 1 << 20)
    assert one == [large.predict([t]) for t in texts]


def test_held_out_fold_and_its_accuracy(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    truth = {row.doc_id: row.lang for row in docs.collect()}
    rows = by_id(langid.language_digest(docs))
    assert len(rows) == len(truth)
    right = [truth[i] == pred for i, [(out, pred, score)] in rows.items() if out and 0 <= score <= 1]
    assert all(out == (crc32(str(i).encode()) % 4 == 2) for i, [(out, _, _)] in rows.items())
    assert len(right) > 200 and sum(right) / len(right) > 0.98


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    rows = [(i, ENGLISH if i % 2 else FRENCH, "en" if i % 2 else "fr") for i in range(40)]
    wrong = [(i, t, "xx") if crc32(str(i).encode()) % 4 == 2 else (i, t, lang) for i, t, lang in rows]
    assert by_id(langid.language_digest(documents(spark, rows))) == by_id(langid.language_digest(documents(spark, wrong)))


def test_odd_rows(spark):
    rows = by_id(langid.language_digest(odd_documents(spark)))
    assert len(rows[1]) == 2 and rows[1][0][1] == "en"
    assert rows[2][0][1:] == rows[3][0][1:] == rows[6][0][1:] == ("und", 0.0)
    assert langid.language_digest(no_documents(spark)).count() == 0
    unlabelled = documents(spark, [(1, "abc", None), (2, "", None)])
    assert {r[1] for [r] in by_id(langid.language_digest(unlabelled)).values()} == {"und"}
    assert [row.doc_id for row in langid.keep_identified(unlabelled).collect()] == [1]


def test_kept_rows_have_their_columns(spark):
    docs = odd_documents(spark)
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    assert sorted(str(row[0]) for row in kept.collect()) == ["1", "1", "4", "7", "8", "None"]


def test_the_sample_is_bounded(spark):
    docs = documents(spark, [(i, f"word{chr(97 + i % 26)} the cat", "en") for i in range(2000)])
    assert len(langid.fit(docs, max_rows=200).words) <= 30
