"""Token-id files: a static range asymmetric numeral system over interleaved lanes.

All ids of a corpus, in ascending order of the document id, are written as
independent blocks that share one frequency table, counted over all ids. A block
holds whole documents, about ``BLOCK_IDS`` ids. Inside it, id ``i`` belongs to
lane ``i mod lanes``; every lane is a coder state of its own, so a step of numpy
codes one id in each lane. A checkpoint every ``CHECKPOINT_STEPS`` steps keeps
all lane states and the place in the word stream, so that a long block can be
decoded from several places at once, and a checksum of the ids ends the block.

The files are Parquet tables below a path: ``blocks`` (the payload is stored as it
is) and ``table`` (id, frequency). Spark commits them task by task, so a lost
executor leaves no half-written file behind.

A null text counts as empty; the end id follows every document. Documents with
equal ids are kept apart and stand next to each other, null ids come first. An
empty table gives files without blocks. Other columns do not matter.
"""

from __future__ import annotations

import json
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmatch.llm.common import BATCH_BYTES, pick, pieces
from fleetmatch.session import scratch_path

DEFAULT_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
BLOCK_IDS = 1 << 17
LANES = 512
CHECKPOINT_STEPS = 256
SCALE = 20             # frequencies add up to 2 ** SCALE
LOW = 1 << 31          # states stay in [LOW, LOW << 32)
MAX_WORDS = 1 << 18    # ids of words kept at a time

_U32, _U64 = np.dtype("<u4"), np.dtype("<u8")


# Letters, numbers and white space below U+0250, written out.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
_not_latin = re.compile(r"[^\x00-\u024f]|\u0130").search  # U+0130 has no lower case of one letter
# The parts of a tokenizer that the rules below stand for.
_KNOWN_NORMALIZERS = ["NFC", {"Regex": r"\s+"}, "Lowercase"]
_KNOWN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_SPACE, _LETTER, _NUMBER, _OTHER, _HARD = range(5)


def _kind(char: str) -> int:
    if _not_latin(char):
        return _HARD
    return next((k for k, chars in ((_SPACE, _S), (_LETTER, _L), (_NUMBER, _N)) if re.match(f"[{chars}]", char)), _OTHER)


_KINDS = np.array([_kind(chr(i)) for i in range(0x250)], np.uint8)
_BYTE_KINDS = _KINDS[:128].tobytes() + bytes([_HARD]) * 128
_ASCII_LOWER = bytes(range(128)).lower() + bytes(range(128, 256))


def split_pieces(text: bytes) -> tuple[pa.BinaryArray, np.ndarray]:
    """The pieces of a text in UTF-8 that ends with white space, and the place where each begins.

    Pieces are those of the known pattern, A-Z and À-Þ in lower case. What stands between white space
    and holds a character that is not below U+0250, or U+0130, stays one piece, as it is.
    """
    raw, lower = np.frombuffer(text, np.uint8), np.frombuffer(bytearray(text.translate(_ASCII_LOWER)), np.uint8)
    kind = np.frombuffer(bytearray(text.translate(_BYTE_KINDS)), np.uint8)
    two = np.flatnonzero((raw >= 0xC2) & (raw < 0xCA))  # the first bytes of U+0080 to U+027F
    if len(two):
        code = (raw[two].astype(np.uint16) & 0x1F) << 6 | raw[two + 1] & 0x3F
        known = code < len(_KINDS)
        two, code = two[known], code[known]
        kind[two] = kind[two + 1] = _KINDS[code]
        lower[two[(code >= 0xC0) & (code <= 0xDE) & (code != 0xD7)] + 1] += 0x20
    start = np.empty(len(raw), bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start |= (kind == _NUMBER) & (raw & 0xC0 != 0x80)
    quote = np.flatnonzero((raw == ord("'")) & start)
    if len(quote):  # the text ends with white space, so a letter after a quote is never its last byte
        first = lower[quote + 1]
        second = lower[np.minimum(quote + 2, len(raw) - 1)]
        short = np.isin(first, np.frombuffer(b"stmd", np.uint8))
        long = (second == ord("e")) & ((first == ord("r")) | (first == ord("v"))) | (first == ord("l")) & (second == ord("l"))
        start[quote[short | long] + 1] = False
        start[quote[short] + 2] = start[quote[long] + 3] = True
    hard = np.flatnonzero(kind == _HARD)
    visible = kind != _SPACE
    if len(hard):
        change = np.flatnonzero(visible[1:] != visible[:-1]) + 1
        borders = np.concatenate([[0], change, [len(raw)]])
        part = np.unique(np.searchsorted(borders, hard, "right") - 1)
        inside = np.zeros(len(raw) + 1, np.int8)
        inside[borders[part]] = 1
        inside[borders[part + 1]] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
        lower = np.where(inside, raw, lower)
        start &= ~inside
        start[borders[part]] = True
    data = np.compress(visible, lower)
    offsets = np.append(np.flatnonzero(np.compress(visible, start)), len(data)).astype(np.int32)
    found = pa.BinaryArray.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return found, np.flatnonzero(start & visible)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints, else the next letter from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(byte if byte in shown else next(others)) for byte in range(256)]


class Recent(dict):
    """A bounded table: when full it becomes the old one, from which entries still in use come back."""

    def __init__(self, make, most: int = MAX_WORDS):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        if len(key) <= 64:
            self[key] = value
        return value


class WordTokenizer:
    """Ids of a text, put together from the library's ids of its parts.

    Texts are split, many at a time, into the pieces that the library's model gets
    one by one; each different piece is looked up once. The tokenizer splits at white
    space and drops it, so for any other text the ids are those of the parts between
    spaces and line breaks, one after the other; so are those of a part with
    characters that the split does not know. What stays in the tables of the pieces
    and parts used last is not encoded again.
    """

    def __init__(self, path: str, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype = Tokenizer.from_file(path), dtype
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        normalizers = [n.get("pattern", n["type"]) for n in (rules["normalizer"] or {}).get("normalizers", [])]
        splits = [p.get("pattern", {}).get("Regex") for p in (rules["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.known = normalizers == _KNOWN_NORMALIZERS and splits == [_KNOWN_PATTERN, None]
        self.pieces = Recent(self._piece)
        self.parts = Recent(self._part)

    def _packed(self, ids: list[int]) -> bytes:
        packed = array("H" if self.dtype == "<u2" else "I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _piece(self, key: bytes) -> bytes:
        piece = key.decode()
        if not key.isascii():
            if _not_latin(piece):
                return self._part(piece)
            key = piece.lower().encode()
        if not (key.isascii() and key.isalnum()):
            piece = "".join(map(self.letters.__getitem__, key))
        return self._packed([token.id for token in self.model.tokenize(piece)])

    def _part(self, part: str) -> bytes:
        return self._packed(self.tokenizer.encode(part, add_special_tokens=False).ids)

    def _by_parts(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, text.replace("\n", " ").split(" ")))

    def _by_pieces(self, texts: list[bytes]) -> list[bytes]:
        found, places = split_pieces(b"\n".join([*texts, b""]))
        coded = found.dictionary_encode()
        keys = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # faster than to_pylist
        packed = list(map(self.pieces.__getitem__, keys))
        ids = np.frombuffer(b"".join(packed), self.dtype)
        length = np.fromiter(map(len, packed), np.int64, len(packed)) // ids.itemsize
        piece = coded.indices.to_numpy()
        lengths = length[piece]
        ends = np.cumsum(lengths)
        shift = (np.cumsum(length) - length)[piece] - (ends - lengths)
        out = ids[np.arange(len(ids) and ends[-1]) + np.repeat(shift, lengths)].tobytes()
        borders = np.cumsum([0, *(len(text) + 1 for text in texts)])
        cuts = (np.concatenate([[0], ends])[np.searchsorted(places, borders)] * ids.itemsize).tolist()
        return [out[a:b] for a, b in zip(cuts, cuts[1:])]

    def _in_cuts(self, text: bytes) -> bytes:
        """A long text, taken from space to space, so that arrays made from it stay small."""
        out, begin = [], 0
        while begin < len(text):
            end = text.find(b" ", begin + BATCH_BYTES) + 1 or len(text)
            out += self._by_pieces([text[begin:end]])
            begin = end
        return b"".join(out)

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        known = [text.encode() if self.known and text and "<|" not in text else b"" for text in texts]
        found = self._by_pieces([text if len(text) <= BATCH_BYTES else b"" for text in known]) if known else []
        for text, data, ids in zip(texts, known, found):
            yield ids if not text or data and len(data) <= BATCH_BYTES else self._in_cuts(data) if data else self._by_parts(text)


@lru_cache(maxsize=1)
def shared_tokenizer(path: str, dtype: str) -> WordTokenizer:
    """The tokenizer of this process: the tasks that a Python worker runs one after the other share its tables."""
    return WordTokenizer(path, dtype)


def vocabulary_type(path: str) -> str:
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def tokenize(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = DEFAULT_TOKENIZER,
             end_id: int | None = END_ID, dtype: str = "<u4") -> DataFrame:
    """``id`` and ``ids``, packed little-endian integers of the type named, the end id included."""
    end = b"" if end_id is None else np.array([end_id], dtype).tobytes()

    def run(batches):
        tokenizer = shared_tokenizer(path, dtype)
        for batch in pieces(batches, "text", BATCH_BYTES):
            ids = [packed + end for packed in tokenizer.encode(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["id", "ids"])

    rows = pick(df, {"id": id_col, "text": text_col})
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids binary")


class Coder:
    """Encodes and decodes blocks with one table of frequencies, given by id."""

    def __init__(self, frequencies: np.ndarray):
        self.frequency = frequencies.astype(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(self.frequency)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(frequencies), dtype=np.uint32), frequencies)

    @staticmethod
    def scaled(counts: np.ndarray) -> np.ndarray:
        """Frequencies of the sum 2 ** SCALE, at least 1 for every id that occurs."""
        present = np.flatnonzero(counts)
        if len(present) > 1 << SCALE:
            raise ValueError("more different ids than the scale can hold")
        frequencies = np.zeros(len(counts), np.int64)
        if not len(present):
            return frequencies
        share = counts[present] / counts.sum()
        frequencies[present] = 1 + np.floor(share * ((1 << SCALE) - len(present))).astype(np.int64)
        frequencies[present[np.argmax(share)]] += (1 << SCALE) - frequencies.sum()
        return frequencies

    def encode(self, ids: np.ndarray) -> tuple[int, bytes, list[tuple[int, int, bytes]]]:
        """Lanes, the words, and the checkpoints (first step, words before it, states); the first is at step 0."""
        n = len(ids)
        lanes = max(1, min(LANES, n // 64))
        steps = -(-n // lanes)
        state = np.full(lanes, LOW, np.uint64)
        frequency, before = self.frequency[ids], self.before[ids]
        limit = frequency << np.uint64(63 - SCALE)
        words, marks = [None] * steps, {}
        down, up = np.uint64(32), np.uint64(SCALE)
        for step in range(steps - 1, -1, -1):
            span = slice(step * lanes, min(n, (step + 1) * lanes))
            x = state[:span.stop - span.start]
            full = x >= limit[span]
            words[step] = x[full].astype(_U32)
            x = np.where(full, x >> down, x)
            quotient, rest = np.divmod(x, frequency[span])
            state[:len(x)] = (quotient << up) + rest + before[span]
            if step % CHECKPOINT_STEPS == 0:
                marks[step] = state.astype(_U64).tobytes()
        ends = np.cumsum([0, *map(len, words)])
        return lanes, b"".join(w.tobytes() for w in words), [
            (step, int(ends[step]), marks[step]) for step in sorted(marks)]

    def decode(self, n: int, lanes: int, words: bytes, mark: tuple[int, int, bytes], stop: int | None = None) -> np.ndarray:
        """The ids from a checkpoint up to the step ``stop``, or the end."""
        first, place, states = mark
        state = np.frombuffer(states, _U64).astype(np.uint64)
        stream = np.frombuffer(words, _U32).astype(np.uint64)
        steps = -(-n // lanes) if stop is None else stop
        out = np.empty(min(n, steps * lanes) - first * lanes, np.uint32)
        mask, down, up, low = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32), np.uint64(LOW)
        for step in range(first, steps):
            count = min(n, (step + 1) * lanes) - step * lanes
            x = state[:count]
            slot = x & mask
            symbol = self.symbol[slot]
            x = self.frequency[symbol] * (x >> down) + slot - self.before[symbol]
            empty = np.flatnonzero(x < low)
            x[empty] = (x[empty] << up) | stream[place:place + len(empty)]
            place += len(empty)
            state[:count] = x
            out[(step - first) * lanes:(step - first) * lanes + count] = symbol
        return out


def id_counts(batches: Iterator[pa.RecordBatch], dtype: str) -> np.ndarray:
    """How often each id occurs in the packed ids of the only column, counted about ``BLOCK_IDS`` ids at a time."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        for piece in pieces([batch], batch.schema.names[0], BLOCK_IDS * np.dtype(dtype).itemsize):
            ids = np.frombuffer(b"".join(piece.column(0).to_pylist()), dtype)
            found = np.bincount(ids, minlength=len(total))
            found[:len(total)] += total
            total = found
    return total


def _block_schema(id_type: str) -> str:
    return (f"shard int, block bigint, shard_start bigint, n_ids bigint, doc_ids array<{id_type}>, "
            "lengths array<bigint>, lanes int, words binary, "
            "checkpoints array<struct<step:bigint,place:bigint,states:binary>>, crc32 bigint")


def write_token_files(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                      tokenizer: str = DEFAULT_TOKENIZER, end_id: int | None = END_ID, files: int | None = None) -> None:
    """Tokenize, order by id and write the files; ``files`` defaults to the number of shuffle partitions."""
    spark = df.sparkSession
    dtype = vocabulary_type(tokenizer)
    raw_path = scratch_path(spark, "token-ids")
    raw = tokenize(df, id_col, text_col, tokenizer, end_id, dtype)
    raw.write.option("compression", "zstd").parquet(raw_path)
    raw = spark.read.schema(raw.schema).parquet(raw_path)

    def count(batches):
        total = id_counts(batches, dtype)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], ["id", "n"])

    counted = raw.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    table = counted.toPandas()  # as many rows as the vocabulary has ids, at most
    counts = np.zeros(int(table["id"].max()) + 1 if len(table) else 0, np.int64)
    counts[table["id"].to_numpy(np.int64)] = table["n"].to_numpy(np.int64)
    frequencies = Coder.scaled(counts)
    rows = [(int(i), int(frequencies[i])) for i in np.flatnonzero(frequencies)]
    spark.createDataFrame(rows, "id bigint, frequency bigint").coalesce(1).write.parquet(f"{path}/table")

    shared = spark.sparkContext.broadcast(frequencies)
    id_field = raw.schema["id"].dataType
    schema = _block_schema(id_field.simpleString())

    def encode(batches):
        from pyspark import TaskContext

        coder, shard, number, done = Coder(shared.value), TaskContext.get().partitionId(), 0, 0
        doc_ids, parts, lengths, held = [], [], [], 0

        def block():
            ids = np.concatenate(parts)
            lanes, words, marks = coder.encode(ids)
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([number], pa.int64()), pa.array([done], pa.int64()),
                pa.array([len(ids)], pa.int64()), pa.array([doc_ids], pa.list_(id_arrow)),
                pa.array([lengths], pa.list_(pa.int64())), pa.array([lanes], pa.int32()),
                pa.array([words], pa.binary()),
                pa.array([[{"step": s, "place": p, "states": x} for s, p, x in marks]], pa.list_(pa.struct(
                    [("step", pa.int64()), ("place", pa.int64()), ("states", pa.binary())]))),
                pa.array([zlib.crc32(ids.astype(_U32).tobytes())], pa.int64())],
                names=["shard", "block", "shard_start", "n_ids", "doc_ids", "lengths", "lanes", "words",
                       "checkpoints", "crc32"])

        for batch in batches:
            id_arrow = batch.schema.field(0).type
            for doc_id, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(packed, dtype)
                if held and held + len(ids) > BLOCK_IDS:
                    yield block()
                    number, done = number + 1, done + held
                    doc_ids, parts, lengths, held = [], [], [], 0
                doc_ids.append(doc_id)
                parts.append(ids)
                lengths.append(len(ids))
                held += len(ids)
        if doc_ids:
            yield block()

    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("ids")
    ordered = raw.repartitionByRange(files, F.col("id").asc_nulls_first(), tie).sortWithinPartitions(
        F.col("id").asc_nulls_first(), tie)
    ordered.mapInArrow(encode, schema).write.option("compression", "none").parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``, packed as unsigned 32-bit integers.

    A block whose ids do not have its checksum fails the job.
    """
    table = spark.read.parquet(f"{path}/table").toPandas()
    frequencies = np.zeros(int(table["id"].max()) + 1 if len(table) else 0, np.int64)
    frequencies[table["id"].to_numpy(np.int64)] = table["frequency"].to_numpy(np.int64)
    blocks = spark.read.parquet(f"{path}/blocks")
    # One row per file comes to the driver.
    sums, offsets, before = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect(), [], 0
    for shard, n in sums:
        offsets.append((shard, before))
        before += n
    offset_table = spark.createDataFrame(offsets, "shard int, base bigint")
    shared = spark.sparkContext.broadcast(frequencies)
    id_type = blocks.schema["doc_ids"].dataType.elementType
    wanted = ["doc_ids", "lengths", "n_ids", "lanes", "words", "checkpoints", "crc32", "first"]

    def decode(batches):
        coder = Coder(shared.value)
        for batch in batches:
            for row in range(batch.num_rows):
                block = {name: batch.column(i)[row].as_py() for i, name in enumerate(wanted) if name != "doc_ids"}
                marks = [(m["step"], m["place"], m["states"]) for m in block["checkpoints"]]
                stops = [m[0] for m in marks[1:]] + [None]
                ids = np.concatenate([coder.decode(block["n_ids"], block["lanes"], block["words"], mark, stop)
                                      for mark, stop in zip(marks, stops)])
                packed = ids.astype(_U32).tobytes()
                if zlib.crc32(packed) != block["crc32"]:
                    raise ValueError("a token block does not have its checksum")
                ends = np.cumsum(block["lengths"])
                starts = ends - block["lengths"]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[row].values, pa.array(starts + block["first"], pa.int64()),
                    pa.array(ends - starts, pa.int64()),
                    pa.array([packed[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())], pa.binary())],
                    names=["id", "start", "n_tokens", "ids"])

    placed = blocks.join(F.broadcast(offset_table), "shard").withColumn("first", F.col("base") + F.col("shard_start"))
    return placed.select(*wanted).mapInArrow(
        decode, f"id {id_type.simpleString()}, start bigint, n_tokens bigint, ids binary")


def token_digest(df: DataFrame, path: str | None = None) -> DataFrame:
    """The contract's row per document, from the files read back."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_token_files(df, path)
    return read_token_files(spark, path).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
