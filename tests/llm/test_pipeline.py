import numpy as np
import tiktoken

import corpus_pipeline
import public_tokenizers
from fleetmatch.llm import bpe, decontaminate, langid, minhash, pii
from fleetmatch.llm.common import read_table
from tests.llm.helpers import no_documents, odd_documents


def test_stages_are_named_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "pii", "byte_bpe"]


def test_each_stage_against_a_plain_version(spark, sf_dir):
    """Stage by stage on the whole table, each on its own input."""
    docs = read_table(spark, sf_dir, "documents")
    ids = [r.doc_id for r in docs.collect()]
    language, dedup, leaks, private, encode = (stage for _, stage in corpus_pipeline.STAGES)

    spoken = language(spark, docs, sf_dir).persist()
    assert spoken.columns == docs.columns
    model = langid.fit(docs)
    labels, scores = langid.Scorer(model).predict([r.text for r in docs.collect()])
    wanted = {i for i, label, score in zip(ids, labels, scores) if label != "und" and score >= 0.5}
    assert {r.doc_id for r in spoken.collect()} == wanted and len(wanted) > 0.9 * len(ids)

    single = dedup(spark, spoken, sf_dir).persist()
    classes = {r.class_id for r in minhash.duplicate_digest(spoken).collect()}
    assert {r.doc_id for r in single.collect()} == classes and single.columns == docs.columns

    clean = leaks(spark, single, sf_dir).persist()
    held = {r.id for r in decontaminate.find_leaks(single, read_table(spark, sf_dir, "benchmark")).collect()}
    assert {r.doc_id for r in clean.collect()} == classes - held

    redacted = private(spark, clean, sf_dir).persist()
    assert redacted.columns == docs.columns
    assert all(not pii.find_spans(r.text) and r.n_chars == len(r.text) for r in redacted.collect())

    library = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.load_ranks(bpe.DEFAULT_RANKS))
    texts = {r.doc_id: r.text for r in redacted.collect()}
    tokens = encode(spark, redacted, sf_dir)
    for row in tokens.collect():
        assert np.frombuffer(row.ids, "<u4").tolist() == library.encode_ordinary(texts[row.doc_id])
    assert tokens.count() == len(texts)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()) == sorted(texts)


def test_odd_and_no_rows(spark, sf_dir):
    for docs in (odd_documents(spark), no_documents(spark)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            out.collect()
            assert len(out.columns) == len(docs.columns)
