"""Packing of documents into sequences of at most ``CAPACITY`` tokens, in bounded space.

Each partition is read once and keeps ``WINDOWS`` open sequences. A document is
cut into whole sequences and a rest; the rest goes where it leaves the least
space. When it fits nowhere, the fullest window takes as much of it as it can
hold and is emitted, and what is left of the piece is placed again. So an emitted
sequence is full. The windows still open at the end of a partition are merged in
rounds, ``FAN`` partitions at a time, by the same rule; the last round joins what
is left and cuts the end at powers of two, which need no padding. A round holds
``FAN * WINDOWS`` windows at most, whatever the size of the table.

A null text counts as empty; the end id follows every document, so each has a
piece. Rows with equal or null ids are documents of their own. A text is encoded
in slices of about ``SLICE`` characters that end before a space between two
visible characters; one without such a place is one slice. An empty table gives no
pieces; other columns do not matter.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmatch.llm.common import is_latin_1, pick, pieces
from fleetmatch.llm.tokens import Recent, byte_letters
from fleetmatch.session import scratch_path

DEFAULT_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 1
CAPACITY = 2048
WINDOWS = 64
FAN = 32
SLICE = 1 << 19
_SERIAL_BITS = 32      # of a sequence id; the bits above number the partition or merge

# The split of byte-level tokenizers, for texts below U+0250, with letters, numbers and spaces written out.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
_latin_pieces = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+").findall
_not_latin = re.compile("[^\x00-ɏ]").search
_many_spaces = re.compile(rf"[{_S}]{{1000}}").search  # as one piece, more than a library's stack may hold
_KNOWN_SPLIT = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}

# A space between visible characters begins a piece, whatever the text around it.
_cut = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")
_parts = re.compile(r"(?<=[!-~\w])(?= [!-~\w])").split


def slices(text: str, most: int = SLICE) -> Iterator[str]:
    """The text in parts that can be encoded one by one."""
    begin = 0
    while len(text) - begin > most:
        place = _cut.search(text, begin + most)
        if place is None:
            break
        yield text[begin:place.start()]
        begin = place.start()
    yield text[begin:]


class ByteTokenizer:
    """The library's ids of a text, found faster.

    Where the merges of the file are in the order of their ids, they are ranks, and a
    text of Latin letters, whose split is the same everywhere, is encoded by ranks.
    Else it is split into the pieces that the library's model gets one by one. Any
    other text is cut at spaces between visible characters and the library encodes
    the parts. The pieces and parts used last are not encoded again.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        split = rules["pre_tokenizer"] or {}
        self.known = rules["normalizer"] is None and all(split.get(k) == v for k, v in _KNOWN_SPLIT.items())
        self.added = [token["content"] for token in rules["added_tokens"]]
        # Before a part that a token with white space of its own could reach into, nothing may be cut.
        self.cuts = self.known and not any(t["lstrip"] or t["rstrip"] or " " in t["content"] for t in rules["added_tokens"])
        self.pieces = Recent(self._piece)
        self.parts = Recent(self._part)
        self.by_ranks = self._by_ranks(rules["model"]) if self.known else None

    def _by_ranks(self, model: dict):
        """An encoder by ranks, or nothing if the file's merges cannot be told by rank."""
        import tiktoken

        byte = {letter: bytes([i]) for i, letter in enumerate(self.letters)}
        ranks = {b"".join(map(byte.__getitem__, token)): i for token, i in model["vocab"].items()}
        merges = [merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"]]
        merged = [model["vocab"][first + second] for first, second in merges]
        if len(ranks) != len(merges) + 256 or any(a >= b for a, b in zip(merged, merged[1:])):
            return None
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        packed = array("I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _piece(self, piece: str) -> bytes:
        if not (piece.isascii() and piece.isalnum()):
            piece = "".join(map(self.letters.__getitem__, piece.encode()))
        return self._packed([token.id for token in self.model.tokenize(piece)])

    def _part(self, part: str) -> bytes:
        return self._packed(self.tokenizer.encode(part, add_special_tokens=False).ids)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.cuts:
            return self._part(text)
        by_pieces = not any(token in text for token in self.added) and (is_latin_1(text) or not _not_latin(text))
        out = []
        for part in slices(text):
            if by_pieces and self.by_ranks and not _many_spaces(part):
                out.append(self._packed(self.by_ranks.encode_ordinary(part)))
            elif by_pieces:
                out.append(b"".join(map(self.pieces.__getitem__, _latin_pieces(part))))
            else:
                out.append(b"".join(map(self.parts.__getitem__, _parts(part))))
        return out[0] if len(out) == 1 else b"".join(out)


class Windows:
    """Open sequences and the pieces in them; a piece is ``(head, start, length)`` with what the caller wants as head."""

    def __init__(self, capacity: int = CAPACITY, count: int = WINDOWS):
        self.capacity, self.count = capacity, count
        self.by_space: list[tuple[int, int]] = []    # (free, serial) of the open windows, sorted
        self.held: dict[int, list] = {}
        self.opened = 0

    def _open(self) -> int:
        self.opened += 1
        return self.opened - 1

    def place(self, head, start: int, length: int) -> Iterator[tuple[int, list]]:
        """Puts the piece somewhere; gives the windows, as (serial, pieces), that are full by it."""
        while length >= self.capacity:
            yield self._open(), [(head, start, self.capacity)]
            start, length = start + self.capacity, length - self.capacity
        while length:
            place = bisect_left(self.by_space, (length, -1))
            if place < len(self.by_space):
                free, serial = self.by_space.pop(place)
                taken = length
            elif len(self.by_space) < self.count:
                free, serial, taken = self.capacity, self._open(), length
                self.held[serial] = []
            else:
                free, serial = self.by_space.pop(0)
                taken = free
            self.held[serial].append((head, start, taken))
            start, length = start + taken, length - taken
            if free > taken:
                insort(self.by_space, (free - taken, serial))
            else:
                yield serial, self.held.pop(serial)

    def rest(self) -> Iterator[tuple[int, list]]:
        """The windows still open, the fullest first."""
        for _, serial in self.by_space:
            yield serial, self.held[serial]

    def finish(self) -> Iterator[tuple[int, list]]:
        """The pieces still open, joined into full windows and, at the end, windows of a power of two."""
        left = [piece for _, held in self.rest() for piece in held]
        total = sum(length for _, _, length in left)
        self.by_space, self.held = [], {}
        window, room = [], 0
        for head, start, length in left:
            while length:
                if not room:
                    room = self.capacity if total >= self.capacity else 1 << (total.bit_length() - 1)
                taken = min(room, length)
                window.append((head, start, taken))
                start, length, room, total = start + taken, length - taken, room - taken, total - taken
                if not room:
                    yield self._open(), window
                    window = []


class _Rows:
    """Collects piece rows and gives them as record batches."""

    NAMES = ["id", "start", "length", "doc_tokens", "unit", "serial", "offset", "open", "ids"]

    def __init__(self, id_type: pa.DataType, unit: int):
        types = [id_type, pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        self.schema, self.unit = pa.schema(list(zip(self.NAMES, types))), unit
        self.clear()

    def clear(self) -> None:
        self.rows, self.bytes = [], 0

    def add(self, serial: int, window: list, is_open: bool) -> None:
        offset = 0
        for (doc_id, doc_tokens, first, ids), start, length in window:
            part = ids[4 * (start - first):4 * (start - first + length)]
            self.rows.append((doc_id, start, length, doc_tokens, self.unit, serial, offset, is_open, part))
            self.bytes += len(part) + 64
            offset += length

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[] for _ in self.NAMES]
        out = pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(columns, self.schema)], schema=self.schema)
        self.clear()
        return out


_BATCH_BYTES = 1 << 23


def _pack(rows: _Rows, windows: Windows, documents, final: bool) -> Iterator[pa.RecordBatch]:
    """Packs ``(head, start, length)`` and gives the piece rows, the open windows last."""
    for head, start, length in documents:
        for serial, window in windows.place(head, start, length):
            rows.add(serial, window, False)
            if rows.bytes >= _BATCH_BYTES:
                yield rows.batch()
    for serial, window in windows.finish() if final else windows.rest():
        rows.add(serial, window, not final)
    yield rows.batch()


def _written(df: DataFrame, name: str) -> DataFrame:
    """As a table whose row groups are small, so that the few open rows at the end are read alone."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").option("parquet.block.size", 1 << 24).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = DEFAULT_TOKENIZER,
         end_id: int | None = END_ID, capacity: int = CAPACITY, windows: int = WINDOWS, fan: int = FAN) -> DataFrame:
    """One row per piece: ``id``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset`` and ``ids``.

    ``ids`` are packed little-endian unsigned 32-bit integers. Without an end id, an
    empty text has no piece.
    """
    if capacity < 1 or windows < 1 or fan < 2:
        raise ValueError("capacity and windows must be at least 1, fan at least 2")
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    rows = pick(df, {"id": id_col, "text": text_col})
    id_type = rows.schema["id"].dataType.simpleString()
    schema = (f"id {id_type}, start bigint, length bigint, doc_tokens bigint, unit int, serial bigint, "
              "offset bigint, open boolean, ids binary")

    def first(batches):
        from pyspark import TaskContext

        encoder, out = ByteTokenizer(tokenizer), None
        space, unit = Windows(capacity, windows), TaskContext.get().partitionId()

        def documents(batch):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.encode(text) + end
                yield (doc_id, len(ids) // 4, 0, ids), 0, len(ids) // 4

        for batch in pieces(batches, "text"):
            out = out or _Rows(batch.schema.field(0).type, unit)
            for head, start, length in documents(batch):
                for serial, window in space.place(head, start, length):
                    out.add(serial, window, False)
                    if out.bytes >= _BATCH_BYTES:
                        yield out.batch()
        if out:
            yield from _pack(out, space, (), False)

    def merge(unit_base: int, final: bool):
        def run(key, table):
            out = _Rows(table.schema.field("id").type, unit_base + key[0].as_py())
            table = table.sort_by([("unit", "ascending"), ("serial", "ascending"), ("offset", "ascending")])
            listed = table.select(["id", "doc_tokens", "start", "length", "ids"]).to_pylist()
            documents = (((r["id"], r["doc_tokens"], r["start"], r["ids"]), r["start"], r["length"]) for r in listed)
            return pa.Table.from_batches(list(_pack(out, Windows(capacity, windows), documents, final)), out.schema)
        return run

    packed = _written(rows.mapInArrow(first, schema), "packed")
    done, base = packed.filter(~F.col("open")), 0
    units = packed.agg(F.max("unit")).first()[0]
    units = 0 if units is None else units + 1
    while units:
        # The windows a partition leaves open; `fan` partitions together are at most fan * windows of them.
        left = packed.filter("open").withColumn("group", F.floor((F.col("unit") - base) / fan).cast("int"))
        groups = -(-units // fan)
        base += units
        packed = _written(left.groupBy("group").applyInArrow(merge(base, groups == 1), schema), "merged")
        done = done.unionByName(packed.filter(~F.col("open")))
        if groups == 1:
            break
        units = groups
    number = F.shiftleft(F.col("unit").cast("bigint"), _SERIAL_BITS) + F.col("serial")
    return done.select("id", "start", "length", "doc_tokens", number.alias("sequence_id"), "offset", "ids")


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """One row per sequence: ``sequence_id``, ``n_tokens``, ``ids`` padded to the capacity, and the ``pieces`` in order.

    A sequence whose length is a power of two is left as it is. A sequence has at
    most ``capacity`` pieces, so its row is bounded.
    """
    held = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("offset", "id", "start", "length", "ids"))).alias("held"))
    whole = F.bit_count("n_tokens") == 1
    pad = F.unhex(F.repeat(F.lit(int(pad_id).to_bytes(4, "little").hex()), F.when(whole, 0).otherwise(
        F.lit(capacity) - F.col("n_tokens")).cast("int")))
    joined = F.aggregate("held", F.lit(b""), lambda out, piece: F.concat(out, piece["ids"]))
    return held.select("sequence_id", "n_tokens", F.concat(joined, pad).alias("ids"), F.transform(
        "held", lambda p: F.struct(p["offset"].alias("offset"), p["id"].alias("id"), p["start"].alias("start"),
                                   p["length"].alias("length"))).alias("pieces"))


def packing_digest(df: DataFrame) -> DataFrame:
    """The contract's row per piece."""
    return pack(df).select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
                           "doc_tokens", "sequence_id", "offset")
