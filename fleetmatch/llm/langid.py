"""Language identification, word first.

A word that the model knows scores its log frequency in each language. A word it
does not know falls back to its character n-grams, the longest length of which
any is known, and scores the mean of their log frequencies. A document's
language is the one with the largest sum over its words; ties go to the
language that sorts first.

The model is fitted on a bounded sample of labelled rows (``max_rows``, by hash
of the row) and bounded itself (``max_words`` words and ``max_grams`` n-grams of
each length per language, the most frequent ones), so it can be broadcast
whatever the size of the table. Prediction reads every whole text.

``score`` (0 to 1) is the share of the language among all, from the mean
evidence of a word taken ``EVIDENCE`` times at most, so that long texts do not
all score 1. A null text, or one without a letter, is ``und`` with score 0, and
so is every text when there is nothing to learn from. Rows are independent:
repeated rows and repeated or null ids give repeated results; an empty table
gives an empty result; other columns do not matter.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetmatch.llm.common import numbered, pick, pieces, position_of

UNKNOWN = "und"
MAX_ROWS = 20_000      # labelled rows to learn from
MAX_WORDS = 30_000     # words kept per language
MAX_GRAMS = 10_000     # n-grams kept per language and length
LENGTHS = (4, 3, 2, 1)
SMOOTHING = 0.5
EVIDENCE = 16
MAX_UNSEEN = 1 << 15   # scores of unseen words kept at a time

_words = re.compile(r"[^\W\d_]+").findall


@dataclass
class Model:
    """Row ``i`` of ``scores`` has the log frequencies of the ``i``-th key of ``words`` or ``grams``."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    scores: np.ndarray


def _count_words(batches):
    for batch in batches:
        counts = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.update((lang, word) for word in _words(text.lower()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()),
             pa.array(list(counts.values()), pa.int64())], ["lang", "word", "n"])


def _log_frequencies(counts: pd.DataFrame, languages: list[str]) -> tuple[list[str], np.ndarray]:
    table = counts.pivot(index="key", columns="lang", values="n").reindex(columns=languages).fillna(0.0)
    smooth = table.to_numpy() + SMOOTHING
    return list(table.index), np.log(smooth / smooth.sum(axis=0))


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", usable: Column | None = None,
        max_rows: int = MAX_ROWS) -> Model:
    """A model of the rows with a text and a language, of about ``max_rows`` of them if there are more.

    ``usable`` is a condition on ``df`` for rows that may be learned from.
    """
    if usable is not None:
        df = df.filter(usable)
    rows = pick(df, {"lang": lang_col, "text": text_col}).filter("lang is not null and text is not null")
    total = rows.select("lang").count()
    if total > max_rows:
        rows = rows.filter(F.pmod(F.xxhash64("lang", "text"), F.lit(1 << 20)) < int((1 << 20) * max_rows / total))
    counts = (rows.mapInArrow(_count_words, "lang string, word string, n bigint")
              .groupBy("lang", "word").agg(F.sum("n").alias("n")).persist())
    best = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "key")
    padded = F.concat(F.lit(" "), "word", F.lit(" "))
    # From the space before the word to the one after it; the spaces alone say nothing.
    def runs(n: int) -> Column:
        first = 1 + int(n == 1)
        places = F.sequence(F.lit(first), F.greatest(F.length("word") + 4 - n - first, F.lit(first)))
        return F.when(F.length("word") + 2 >= n, F.transform(places, lambda at: F.substr(padded, at, F.lit(n)))).otherwise(
            F.array().cast("array<string>"))

    grams = counts.select("lang", "n", F.explode(F.flatten(F.array(*map(runs, LENGTHS)))).alias("key"))
    grams = grams.groupBy("lang", "key").agg(F.sum("n").alias("n")).withColumn("size", F.length("key"))
    kept = (counts.select("lang", F.col("word").alias("key"), "n", F.lit(0).alias("size")).unionByName(grams)
            .withColumn("place", F.row_number().over(best))
            .filter(F.col("place") <= F.when(F.col("size") == 0, MAX_WORDS).otherwise(MAX_GRAMS)))
    kept = kept.select("lang", "key", "n", "size").toPandas()  # bounded by the two limits per language
    counts.unpersist()

    languages = sorted(kept["lang"].unique())
    words, grams_at, parts, row = {}, {}, [], 0
    for size, group in kept.groupby("size"):
        keys, scores = _log_frequencies(group, languages)
        (words if size == 0 else grams_at).update(zip(keys, range(row, row + len(keys))))
        parts.append(scores)
        row += len(keys)
    scores = np.concatenate(parts) if parts else np.zeros((0, 0))
    return Model(languages, words, grams_at, scores)


class Scorer(dict):
    """Row of ``scores`` by word; rows of unseen words are added as they come."""

    def __init__(self, model: Model):
        super().__init__(model.words)
        self.model, self.size = model, len(model.scores)
        languages = len(model.languages)
        self.scores = np.concatenate([model.scores, np.zeros((1024, languages))])

    def __missing__(self, word: str) -> int:
        padded, grams, rows = f" {word} ", self.model.grams, []
        for n in LENGTHS:
            rows = [row for i in range(len(padded) - n + 1) if (row := grams.get(padded[i:i + n])) is not None]
            if rows:
                break
        if self.size == len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        self.scores[self.size] = self.model.scores[rows].mean(axis=0) if rows else 0.0
        self[word] = self.size
        self.size += 1
        return self.size - 1

    def forget(self) -> None:
        """Drop the unseen words when there are too many; between batches, as rows given out stay in use."""
        if self.size > len(self.model.scores) + MAX_UNSEEN:
            self.clear()
            self.update(self.model.words)
            self.size = len(self.model.scores)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        self.forget()
        languages = self.model.languages
        labels, shares = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not languages:
            return labels, shares
        rows, starts, places = [], [], []
        for place, text in enumerate(texts):
            words = _words(text.lower()) if text else ()
            if words and (any(map(str.isalpha, words)) or any(c.isalpha() for w in words for c in w)):
                starts.append(len(rows))
                places.append(place)
                rows += map(self.__getitem__, words)
        if not places:
            return labels, shares
        sums = np.add.reduceat(self.scores[np.array(rows)], starts, axis=0)
        counts = np.diff([*starts, len(rows)])
        evidence = sums * (np.minimum(counts, EVIDENCE) / counts)[:, None]
        weight = np.exp(evidence - evidence.max(axis=1, keepdims=True))
        best = sums.argmax(axis=1)
        share = weight[np.arange(len(best)), best] / weight.sum(axis=1)
        for place, language, value in zip(places, best.tolist(), share.tolist()):
            labels[place], shares[place] = languages[language], min(1.0, value)
        return labels, shares


def predict(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All rows and columns, and after them ``lang_pred`` and ``score``."""
    names = df.columns
    rows = numbered(df)
    text = f"_{position_of(df, text_col)}"
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields),
                        "lang_pred string, score double"])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in pieces(batches, text):
            labels, shares = scorer.predict(batch.column(batch.schema.get_field_index(text)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(labels, pa.string()), pa.array(shares, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    return rows.mapInArrow(run, schema).toDF(*names, "lang_pred", "score")


def held_out(id_column: Column) -> Column:
    """The fold that is never learned from; a null id is not in it."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_digest(df: DataFrame) -> DataFrame:
    """The contract's row per document."""
    rows = pick(df, {"doc_id": "doc_id", "text": "text", "lang": "lang"})
    model = fit(rows, usable=~held_out(F.col("doc_id")))
    # lang is not handed on: a prediction sees the text alone.
    return predict(rows.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(df: DataFrame, usable: Column | None = None, min_score: float = 0.5, text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """The rows and columns of ``df`` whose language is found with at least ``min_score``.

    Where nothing can be learned, only texts without a letter go.
    """
    model = fit(df, text_col, lang_col, usable)
    rows = predict(numbered(df), model, f"_{position_of(df, text_col)}")
    if model.languages:
        rows = rows.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    else:
        rows = rows.filter(F.coalesce(F.col(f"_{position_of(df, text_col)}").rlike(r"\p{L}"), F.lit(False)))
    return rows.drop("lang_pred", "score").toDF(*df.columns)
