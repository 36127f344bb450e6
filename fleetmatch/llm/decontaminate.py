"""Benchmark items in documents, by pigeonhole edit matching.

Texts are compared as sequences of case-folded words. An item of m words may be
found with up to ``floor(error_rate * m)`` word edits (insert, delete, replace).
It is split into one piece more than that budget, so every admissible occurrence
has at least one piece unchanged. Exact piece hits in the documents are found by
hash; around each, Myers' bit-parallel algorithm decides whether the whole item
is there within its budget, and where.

An item shorter than ``min_words`` would be found by chance; it counts only where
it is all the words of a document. Items without a word, and null items, are
never found; null and empty documents hold nothing. Repeated documents give
repeated rows, repeated items too. Both tables may be empty; other columns do
not matter.

Items are taken in blocks of bounded size, each block broadcast and matched
against all documents, so a large benchmark takes more passes, not more memory.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fleetmatch.llm.common import numbered, pick, pieces, position_of
from fleetmatch.llm.wordhash import window_hashes, words_of

ERROR_RATE = 0.2
MIN_WORDS = 5
BLOCK_BYTES = 8 << 20  # text of the items in one block


@dataclass
class Item:
    place: int                # in the block
    words: np.ndarray
    budget: int
    masks: dict[int, int]     # for each word, the bits of its positions
    mirrored: dict[int, int]  # the same for the item read backwards


def _masks(words: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for bit, word in enumerate(words):
        masks[word] = masks.get(word, 0) | 1 << bit
    return masks


def best_match(masks: dict[int, int], length: int, words: list[int], anchored: bool = False) -> tuple[int, int]:
    """(distance, end) of the best occurrence of a pattern in a sequence; the first of equal ones.

    ``anchored`` occurrences begin at the sequence's start. Myers' algorithm: the
    vertical differences of a column of the distance table are two bit vectors.
    """
    full = (1 << length) - 1
    top = 1 << (length - 1) if length else 0
    plus, minus, score = full, 0, length
    best = (score, 0)
    for end, word in enumerate(words, 1):
        match = masks.get(word, 0) | minus
        diagonal = (((match & plus) + plus) ^ plus) | match
        across_minus = plus & diagonal
        across_plus = minus | (full & ~(plus | diagonal))
        if across_plus & top:
            score += 1
        elif across_minus & top:
            score -= 1
        across_plus = (across_plus << 1 | anchored) & full
        plus = (across_minus << 1 | (full & ~(across_plus | diagonal))) & full
        minus = across_plus & diagonal
        if score < best[0]:
            best = (score, end)
    return best


class Matcher:
    """A block of items, ready to be looked for."""

    def __init__(self, texts: list[str | None], error_rate: float, min_words: int):
        table = words_of(texts)
        self.min_words = min_words
        self.items: dict[int, Item] = {}
        self.whole: dict[tuple[int, ...], list[int]] = {}
        found: dict[int, dict[int, list[tuple[int, int]]]] = {}  # length -> piece -> (item, offset)
        for place in range(len(texts)):
            words = table.hashes[table.first[place]:table.first[place + 1]]
            listed = words.tolist()
            if len(words) < min_words:
                if len(words):
                    self.whole.setdefault(tuple(listed), []).append(place)
                continue
            budget = int(error_rate * len(words))
            self.items[place] = Item(place, words, budget, _masks(listed), _masks(listed[::-1]))
            cuts = [len(words) * i // (budget + 1) for i in range(budget + 2)]
            for begin, end in zip(cuts, cuts[1:]):
                piece = int(window_hashes(words[begin:end], end - begin)[0])
                found.setdefault(end - begin, {}).setdefault(piece, []).append((place, begin))
        self.pieces = [(length, by_hash, self._filter(by_hash)) for length, by_hash in sorted(found.items())]

    @staticmethod
    def _filter(by_hash: dict[int, list]) -> np.ndarray:
        """A table that tells for the low bits of a hash whether it can be a piece."""
        bits = max(16, min(24, (16 * len(by_hash)).bit_length()))
        table = np.zeros(1 << bits, bool)
        table[np.array(list(by_hash), np.uint64) & np.uint64((1 << bits) - 1)] = True
        return table

    def find(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(text, item, distance, first word, end word): the best occurrence of each item in each text."""
        table = words_of(texts)
        hashes, first = table.hashes, table.first
        results: dict[tuple[int, int], tuple[int, int, int]] = {}
        if self.whole:
            for text in np.flatnonzero((np.diff(first) < self.min_words) & (np.diff(first) > 0)).tolist():
                for place in self.whole.get(tuple(hashes[first[text]:first[text + 1]].tolist()), ()):
                    results[text, place] = (0, 0, int(first[text + 1] - first[text]))
        for length, by_hash, likely in self.pieces:
            windows = window_hashes(hashes, length)
            places = np.flatnonzero(likely[windows & np.uint64(len(likely) - 1)])
            owners = np.searchsorted(first, places, "right") - 1
            inside = places + length <= first[owners + 1]
            for at, owner in zip(places[inside].tolist(), owners[inside].tolist()):
                for place, offset in by_hash.get(int(windows[at]), ()):
                    self._verify(results, hashes, first, at, owner, place, offset)
        return [(text, place, *result) for (text, place), result in sorted(results.items())]

    def _verify(self, results, hashes, first, at, owner, place, offset) -> None:
        known = results.get((owner, place))
        if known and known[0] == 0:
            return  # no occurrence can be better
        item = self.items[place]
        size = len(item.words)
        low, high = int(first[owner]), int(first[owner + 1])
        begin, end = max(low, at - offset - item.budget), min(high, at - offset + size + item.budget)
        window = hashes[begin:end].tolist()
        distance, stop = best_match(item.masks, size, window)
        if distance <= item.budget and (known is None or distance < known[0]):
            _, back = best_match(item.mirrored, size, window[:stop][::-1], anchored=True)
            results[owner, place] = (distance, begin + stop - back - low, begin + stop - low)


def _item_blocks(items: DataFrame, id_col: str, text_col: str):
    """The items, a bounded number of bytes at a time."""
    rows = pick(items, {"item_id": id_col, "text": text_col}).filter("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks or 1))
    for i in range(blocks):
        yield rows.filter(block == i).toPandas()


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id_col: str = "item_id", item_text_col: str = "text",
               error_rate: float = ERROR_RATE, min_words: int = MIN_WORDS) -> DataFrame:
    """``id``, ``item_id``, ``distance``, ``first_word``, ``end_word`` for every item found in every document."""
    rows = pick(docs, {"id": id_col, "text": text_col})
    item_field = items.schema[position_of(items, item_id_col)].dataType
    item_type, item_arrow = item_field.simpleString(), to_arrow_type(item_field)
    schema = (f"id {rows.schema['id'].dataType.simpleString()}, item_id {item_type}, "
              "distance int, first_word bigint, end_word bigint")
    found = None
    for block in _item_blocks(items, item_id_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast((block["item_id"].tolist(), block["text"].tolist()))

        def run(batches, shared=shared):
            ids, texts = shared.value
            matcher = Matcher(texts, error_rate, min_words)
            for batch in pieces(batches, "text"):
                leaks = matcher.find(batch.column(1).to_pylist())
                places, which, distances, begins, ends = zip(*leaks) if leaks else ((),) * 5
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(places, pa.int64())),
                    pa.array([ids[i] for i in which], item_arrow), pa.array(distances, pa.int32()),
                    pa.array(begins, pa.int64()), pa.array(ends, pa.int64())],
                    names=["id", "item_id", "distance", "first_word", "end_word"])

        part = rows.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", error_rate: float = ERROR_RATE,
               min_words: int = MIN_WORDS) -> DataFrame:
    """The rows and columns of ``docs`` without the documents that hold any item."""
    names = docs.columns
    rows = numbered(docs)
    text = f"_{position_of(docs, text_col)}"
    for block in _item_blocks(items, "item_id", "text"):
        shared = docs.sparkSession.sparkContext.broadcast(block["text"].tolist())

        def run(batches, shared=shared):
            matcher = Matcher(shared.value, error_rate, min_words)
            for batch in pieces(batches, text):
                leaks = matcher.find(batch.column(batch.schema.get_field_index(text)).to_pylist())
                held = {leak[0] for leak in leaks}
                yield batch.filter(pa.array([i not in held for i in range(batch.num_rows)], pa.bool_()))

        rows = rows.mapInArrow(run, rows.schema)
    return rows.toDF(*names)


def leak_digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and item found in it."""
    return find_leaks(docs, items).select(F.col("id").alias("doc_id"), "item_id", "distance", "first_word", "end_word")
