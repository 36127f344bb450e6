"""Byte-level BPE by a finite-state transducer that is determinised as it is used.

A text is split by the pattern and each match, a piece, is read byte by byte. A
state is (last token emitted, bytes read since); reading a byte gives the next
state and the tokens that no continuation can change any more. How far the
emitted tokens trail behind the input is bounded by the longest token: only
positions from which the bytes read so far can still grow into a token are open,
and everything before their common past is emitted. States and arcs are computed
when first needed and kept; both tables are emptied when they reach a bound, so
memory stays bounded and the results do not depend on it.

What makes this exact: the merges by rank leave the one sequence in which every
token and every two neighbours, encoded alone, come out unchanged. So the last
token of a prefix is found from the last tokens of shorter prefixes, which is
all a state has to know. A piece that is a token as a whole is that token.

Encoding gives ids as packed little-endian unsigned 32-bit integers, decoding
gives the bytes back, cut at character boundaries by an incremental UTF-8 state
machine while streaming. A null text counts as empty and has no ids. Rows are
independent: repeated rows and repeated or null ids give repeated results, an
empty table gives an empty result, other columns do not matter.
"""

from __future__ import annotations

import base64
import codecs
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmatch.llm.common import is_latin_1, numbered, pick, pieces, position_of

DEFAULT_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DEFAULT_PATTERN = public_tokenizers.PATTERN
MAX_STATES = 1 << 17   # states of the transducer kept at a time
MAX_PIECES = 1 << 17   # encoded pieces kept at a time
LONG_PIECE = 64        # longer pieces are not kept: they rarely come again


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Encodes one piece; see the module's text."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks = ranks
        self.max_states = max_states
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.never = len(ranks)
        self.prefixes = {token[:n] for token in ranks for n in range(1, len(token))}
        self._parts: dict[int, tuple] = {}  # these two are bounded by the vocabulary
        self._edges: dict[int, dict] = {0: {}, -1: {}}
        # For x and the first byte of y: when x and y can merge at the earliest, for all tokens x + y.
        self._extensions: dict[bytes, dict[int, list[int]]] = {}
        for token, rank in ranks.items():
            for n in range(1, len(token)):
                if token[:n] in ranks and (right := ranks.get(token[n:])) is not None:
                    times = self._extensions.setdefault(token[:n], {}).setdefault(token[n], [])
                    times.append(max(rank, right))
        for by_byte in self._extensions.values():
            for times in by_byte.values():
                times.sort()
        self._forget()

    def _forget(self) -> None:
        self._states: dict[tuple, tuple] = {}
        self._kinds: dict[tuple, tuple] = {}
        self.start = self._state(-1, b"", (0,), (-1,), (0,))

    def parts(self, rank: int) -> tuple[int, ...]:
        """The two tokens a token is merged from last; nothing for a byte, more if the merges never reach it."""
        known = self._parts.get(rank)
        if known is None:
            data = self.tokens[rank]
            parts = [data[i:i + 1] for i in range(len(data))]
            while len(parts) > 2:
                best, i = min((self.ranks.get(a + b, len(self.ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if best >= rank:
                    break
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            known = self._parts[rank] = () if len(data) == 1 else tuple(map(self.ranks.__getitem__, parts))
        return known

    def _edge(self, rank: int, side: int) -> tuple[tuple[int, bytes], ...]:
        """The token and the tokens inside it that touch its border on one side, the innermost first."""
        edge = self._edges[side].get(rank)
        if edge is None:
            inner = self.parts(rank)
            edge = (self._edge(inner[side], side) if inner else ()) + ((rank, self.tokens[rank]),)
            self._edges[side][rank] = edge
        return edge

    def fit(self, left: int, right: int) -> bool:
        """Whether merging ``left + right`` leaves these two tokens.

        The parts that touch the border grow, one merge after the other, in the
        order of ranks. If the two parts touching at some time make a token of a
        lower rank than the next growth on either side, they merge across the
        border. Of equal ranks the leftmost merge comes first.
        """
        ours, theirs, never = iter(self._edge(left, -1)), iter(self._edge(right, 0)), (self.never, b"")
        (_, ending), (_, starting) = next(ours), next(theirs)
        grown, begun = next(ours, never), next(theirs, never)
        while True:
            across = self.ranks.get(ending + starting)
            if across is not None and across < grown[0] and across <= begun[0]:
                return False
            if grown[0] <= begun[0]:
                if grown is never:
                    return True
                ending, grown = grown[1], next(ours, never)
            else:
                starting, begun = begun[1], next(theirs, never)

    def kind(self, left: int, byte: int) -> tuple:
        """What of a token decides which tokens beginning with a byte can follow it; empty if all can.

        For each part touching the border: how many tokens it could still merge
        into before it grows itself. Tokens of one kind allow the same followers.
        """
        known = self._kinds.get((left, byte))
        if known is None:
            edge, found = self._edge(left, -1), ()
            for i, (rank, part) in enumerate(edge):
                times = self._extensions.get(part, {}).get(byte)
                if times:
                    grown = edge[i + 1][0] if i + 1 < len(edge) else self.never
                    count = bisect_left(times, grown)
                    if count:
                        found += (rank, count)
            known = self._kinds[left, byte] = found
        return known

    def _state(self, last: int, pending: bytes, lengths: tuple, ends: tuple, open_: tuple) -> tuple:
        """lengths[n], ends[n]: the last token of the first n pending bytes; open_: where a token can still begin.

        The first part keeps the arcs. Of the token emitted last only its kind
        matters, and nothing when no token can begin right after it.
        """
        if open_[0]:
            last = -1
        if last >= 0 and pending:
            kind = self.kind(last, pending[0])
            key = (kind, pending)
            if not kind:
                last = -1
        else:
            key = (last, pending)
        state = self._states.get(key)
        if state is None:
            state = self._states[key] = ({}, last, pending, lengths, ends, open_)
        return state

    def _arc(self, state: tuple, byte: int) -> tuple[tuple, tuple]:
        _, last, pending, lengths, ends, open_ = state
        pending += bytes((byte,))
        ranks, prefixes, n, token, cut = self.ranks, self.prefixes, len(pending), None, len(pending)
        still = []
        for begin in open_:
            part = pending[begin:] if begin else pending
            if token is None and (rank := ranks.get(part)) is not None and len(self.parts(rank)) <= 2:
                left = ends[begin] if begin else last
                if left < 0 or not self.kind(left, part[0]) or self.fit(left, rank):
                    token = rank
                    lengths += (n - begin,)
                    ends += (rank,)
            if part in prefixes:
                still.append(begin)
        # The deepest past common to all positions where a token can still begin.
        for position in still:
            while cut != position:
                if cut > position:
                    cut -= lengths[cut]
                else:
                    position -= lengths[position]
        still.append(n)
        if not cut:
            return self._state(last, pending, lengths, ends, tuple(still)), ()
        emitted, at = [], cut
        while at:
            emitted.append(ends[at])
            at -= lengths[at]
        emitted.reverse()
        after = self._state(ends[cut], pending[cut:], (0,) + lengths[cut + 1:], (-1,) + ends[cut + 1:],
                            tuple([p - cut for p in still if p >= cut]))
        return after, tuple(emitted)

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self._states) > self.max_states or len(self._kinds) > 4 * self.max_states:
            self._forget()
        ids: list[int] = []
        state = self.start
        for byte in piece:
            arc = state[0].get(byte)
            if arc is None:
                if len(self._states) > 2 * self.max_states:  # inside a very long piece
                    self._forget()
                    state = self._state(*state[1:])
                arc = state[0][byte] = self._arc(state, byte)
            state, emitted = arc
            if emitted:
                ids += emitted
        _, _, pending, lengths, ends, _ = state
        rest, at = [], len(pending)
        while at:
            rest.append(ends[at])
            at -= lengths[at]
        rest.reverse()
        return ids + rest


class Pieces(dict):
    """Packed ids by piece, of the pieces used last: a full table becomes the old one, which is looked up once more."""

    def __init__(self, transducer: Transducer, most: int = MAX_PIECES):
        super().__init__()
        self.transducer, self.most, self.old = transducer, most, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.old.get(piece)
        if packed is None:
            packed = b"".join([id.to_bytes(4, "little") for id in self.transducer.encode(piece.encode())])
        if len(piece) <= LONG_PIECE:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[piece] = packed
        return packed


# The default pattern for texts below U+0250, where its classes can be written out: letters, numbers, white space.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
_LATIN_SPLIT = re.compile(
    rf" ?[{_L}]+| ?[{_N}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+").findall
_NOT_LATIN = re.compile("[^\x00-\u024f]").search


class Codec:
    def __init__(self, path: str, pattern: str):
        ranks = load_ranks(path)
        self.pieces = Pieces(Transducer(ranks))
        self._any_split = regex.compile(pattern).findall
        self._latin = pattern == DEFAULT_PATTERN
        self.bytes_of = {rank: token for token, rank in ranks.items()}

    def split(self, text: str) -> list[str]:
        return _LATIN_SPLIT(text) if self._latin and (is_latin_1(text) or not _NOT_LATIN(text)) else self._any_split(text)

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text))) if text else b""

    def decode_stream(self, packed: bytes, step: int = 1 << 14) -> Iterator[str]:
        """Text as far as its characters are complete, ``step`` ids at a time; broken bytes become U+FFFD."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        ids = np.frombuffer(packed, "<u4")
        for begin in range(0, len(ids), step):
            yield machine.decode(self.decode(ids[begin:begin + step]))
        yield machine.decode(b"", final=True)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids))


@lru_cache(maxsize=2)
def codec(path: str = DEFAULT_RANKS, pattern: str = DEFAULT_PATTERN) -> Codec:
    """One per worker; the files are installed on every machine."""
    return Codec(path, pattern)


def encode_texts(df: DataFrame, text_col: str = "text", path: str = DEFAULT_RANKS,
                 pattern: str = DEFAULT_PATTERN) -> DataFrame:
    """All rows and columns, the text column replaced by a binary column ``ids`` in its place."""
    names = df.columns
    at = position_of(df, text_col)
    rows = numbered(df)
    schema = ", ".join(f"{f.name} {'binary' if i == at else f.dataType.simpleString()}"
                       for i, f in enumerate(rows.schema.fields))

    def run(batches):
        encode = codec(path, pattern).encode
        for batch in pieces(batches, f"_{at}"):
            columns = list(batch.columns)
            columns[at] = pa.array([encode(t) for t in columns[at].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return rows.mapInArrow(run, schema).toDF(*[("ids" if i == at else name) for i, name in enumerate(names)])


def decode_ids(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str = DEFAULT_RANKS,
               pattern: str = DEFAULT_PATTERN) -> DataFrame:
    """``id``, ``ids`` and the decoded ``text`` of each row; null ids count as none."""
    def run(batches):
        stream = codec(path, pattern).decode_stream
        for batch in pieces(batches, "ids"):
            texts = ["".join(stream(ids or b"")) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             ["id", "ids", "text"])

    rows = pick(df, {"id": id_col, "ids": ids_col})
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids binary, text string")


def bpe_digest(df: DataFrame, path: str = DEFAULT_RANKS, pattern: str = DEFAULT_PATTERN) -> DataFrame:
    """The contract's row per document: encode, decode, and digests of both."""
    encoded = encode_texts(pick(df, {"doc_id": "doc_id", "text": "text"}), "text", path, pattern)
    return decode_ids(encoded, path=path, pattern=pattern).select(
        F.col("id").alias("doc_id"),
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "utf-8"), 256).alias("decoded_sha256"))
