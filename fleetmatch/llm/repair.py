"""Repair of conversation structure at the least cost, with the least audit among the cheapest repairs.

The rows of a conversation, by turn (nulls first), then role, then the text's
SHA-256, are edited so that the role initials match ``(s?(ua)+)?``. Keep (K) costs
0, Rerole (R) to user or assistant 2, Delete (D) 3, Insert (I) of an empty user or
assistant row 2; a truncated row that is not deleted adds 1, blank rows and
duplicates have to be deleted. The audit is the edits' initials in order.

1. Spark counts equal rows of a turn together, finds each text's first turn and
   gives every row a code of four bits: its fault and its role's initial.
2. Cost DP, backwards over the codes. A node is (rows consumed, state), with the
   states start, after s, after u, after a. The four costs of a layer, less their
   least, take few values, so a layer is one number of a table that grows as
   needed, and its optimal arcs are looked up.
3. Prefix doubling over the optimal arcs of many conversations at once: a node's
   rank by its first edit gives its rank by 2, 4, 8, ... edits, from the ranks of
   the node and of the one its doubled pointer leads to. A node has one arc of each
   initial, so the least one is its pointer. Equal ranks are equal audits; one path
   per rank is read off through the pointers.
4. Texts meet the audit of their conversation in a sorted stream.

A task holds a byte or two per row of the conversation it works on, about as much as
the audit it returns, and the arcs of ``BLOCK`` rows; texts pass through one by one.
All texts of one conversation pass through one task, as their SHA-256 is defined in
order.

Null conversation ids are one conversation, null turns stand first, null roles and
texts count as one space. Equal rows are told apart only by number. An empty table
has no conversations; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmatch.llm.common import pick

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1   # costs, the last one added to what is not deleted
BLOCK = 1 << 16

_BLANKS = " \t\n\x0b\x0c\r"
_SOUND, _BLANK, _DUPLICATE, _CUT = range(4)               # faults, the upper bits of a code
_S, _U, _A, _OTHER = range(4)                             # initials, the lower bits
_START, _AFTER_S, _AFTER_U, _AFTER_A = range(4)
_KEPT = {(_START, _S): _AFTER_S, (_START, _U): _AFTER_U, (_AFTER_S, _U): _AFTER_U, (_AFTER_U, _A): _AFTER_A,
         (_AFTER_A, _U): _AFTER_U}
_TURN = (_AFTER_U, _AFTER_U, _AFTER_A, _AFTER_U)          # the state after a rerole or insert
_ROLE = ("user", "user", "assistant", "user")
_INITIALS = np.frombuffer(b"\0DIKR", np.uint8)            # of the edits 1 to 4, in the order of their characters
_LEGAL = {(_S, _U), (_U, _A), (_A, _U)}


class Layers:
    """The costs of layers as numbers of a table, with the least optimal arc of each node.

    ``edit`` is 0 where a path ends, ``state`` and ``step`` tell where the arc leads.
    """

    def __init__(self):
        self.costs: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.base: list[int] = []                 # what the layer costs more than the one after it
        self.next: dict[int, int] = {}            # by layer * 16 + code: the layer before it
        self.rows: list[tuple] = []
        self._arrays = None
        self.last = self._layer(None, None)

    def _options(self, after, code, state):
        """(cost, edit, state after, rows consumed) of the edits of a row, without inserts."""
        if after is None:
            return [(0, 0, state, 0)] if state in (_START, _AFTER_A) else []
        fault, initial = divmod(code, 4)
        options = [(DELETE + after[state], 1, state, 1)]
        if fault in (_SOUND, _CUT):
            extra = TRUNCATED if fault == _CUT else 0
            if (state, initial) in _KEPT:
                to = _KEPT[state, initial]
                options.append((KEEP + extra + after[to], 3, to, 1))
            options.append((REROLE + extra + after[_TURN[state]], 4, _TURN[state], 1))
        return options

    def _layer(self, after, code) -> int:
        options = [self._options(after, code, state) for state in range(4)]
        best = [min((o[0] for o in found), default=1 << 30) for found in options]
        for _ in range(3):  # an insert after an insert after ...
            best = [min(cost, INSERT + best[_TURN[state]]) for state, cost in enumerate(best)]
        arcs = []
        for state, found in enumerate(options):
            found = found + [(INSERT + best[_TURN[state]], 2, _TURN[state], 0)]
            arcs.append(min(o[1:] for o in found if o[0] == best[state]))
        least = min(best)
        row = (tuple(cost - least for cost in best), tuple(arcs), least)
        if row not in self.numbers:
            self.numbers[row] = len(self.rows)
            self.rows.append(row)
            self._arrays = None
        return self.numbers[row]

    def solve(self, codes: bytes) -> tuple[int, np.ndarray]:
        """The least cost, and the number of each layer from the first row to the end."""
        layer, known, out, cost = self.last, self.next, [self.last], 0
        rows = self.rows
        for code in reversed(codes):
            key = layer << 4 | code
            layer = known.get(key)
            if layer is None:
                layer = known[key] = self._layer(rows[key >> 4][0], code)
            cost += rows[layer][2]
            out.append(layer)
        return cost + rows[layer][0][_START], np.array(out[::-1], np.uint16)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By layer number and state: edit, state after, rows consumed."""
        if self._arrays is None:
            arcs = np.array([row[1] for row in self.rows], np.int8)
            self._arrays = arcs[:, :, 0], arcs[:, :, 1], arcs[:, :, 2]
        return self._arrays


def audits(table: Layers, parts: list[np.ndarray], starts: list[int], open_end: bool = False) -> tuple[list[bytes], list[int]]:
    """The least audit from the first layer of each part in the state given, and the state it ends in.

    With ``open_end`` the last layer of a part belongs to the next one, and paths end on it.
    """
    sizes = np.array([len(part) for part in parts])
    first = np.cumsum(sizes) - sizes
    layers = np.concatenate(parts)
    edit, state, step = (array[layers] for array in table.arrays())
    if open_end:
        ends = first + sizes - 1
        edit = edit.copy()
        edit[ends] = 0
    nodes = np.arange(4 * len(layers)).reshape(-1, 4)
    heads = 4 * (np.arange(len(layers))[:, None] + step) + state
    pointer = np.where(edit > 0, heads, nodes).ravel()
    edit = edit.ravel()
    begin = 4 * first + np.array(starts)

    pointers, rank = [pointer], edit.astype(np.int64)
    length = (edit > 0).astype(np.int64)
    while (edit[pointers[-1][begin]] > 0).any():
        doubled = pointers[-1]
        length = length + length[doubled]
        _, rank = np.unique(rank * (rank.max() + 1) + rank[doubled], return_inverse=True)
        pointers.append(doubled[doubled])
    _, chosen, group = np.unique(rank[begin], return_index=True, return_inverse=True)
    lengths = length[begin[chosen]]
    places = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = np.repeat(begin[chosen], lengths)
    for level, doubled in enumerate(pointers):
        far = (places >> level & 1).astype(bool)
        at[far] = doubled[at[far]]
    text = _INITIALS[edit[at]].tobytes()
    stops = np.cumsum(lengths).tolist()
    found = [text[a:b] for a, b in zip([0, *stops], stops)]
    return [found[i] for i in group.tolist()], (pointers[-1][begin] & 3).tolist()


def least_audit(table: Layers, layers: np.ndarray, block: int = BLOCK) -> bytes:
    """The audit of one conversation, ``block`` rows at a time."""
    out, state = [], _START
    for begin in range(0, len(layers), block):
        part = layers[begin:begin + block + 1]
        is_last = begin + block + 1 >= len(layers)
        (found,), (state,) = audits(table, [part], [state], not is_last)
        out.append(found)
        if is_last:
            break
    return b"".join(out)


def _coded(rows: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``role``, ``key``, ``code``, ``times`` and ``first``: one row for equal rows of a turn."""
    seen = F.rtrim(F.col("text"), F.lit(_BLANKS))
    fault = F.when(seen == "", _BLANK).when(F.substring(seen, -1, 1).isin(".", "!", "?"), _SOUND).otherwise(_CUT)
    initial = F.substring("role", 1, 1)
    initial = F.when(initial == "s", _S).when(initial == "u", _U).when(initial == "a", _A).otherwise(_OTHER)
    counted = rows.select("conv", "turn", "role", "key", (fault * 4 + initial).alias("code"), "times").groupBy(
        "conv", "turn", "role", "key", "code").agg(F.sum("times").alias("times"))
    # A struct counts a null turn as the smallest; a plain minimum would leave it out.
    firsts = counted.filter("times > 0").groupBy("conv", "role", "key").agg(F.min(F.struct("turn")).alias("at"))
    c, f = counted.alias("c"), firsts.alias("f")
    # Joined by the turn too, so that a text said at very many turns stays spread.
    same = (F.col("c.conv").eqNullSafe(F.col("f.conv")) & (F.col("c.role") == F.col("f.role"))
            & (F.col("c.key") == F.col("f.key")) & F.col("c.turn").eqNullSafe(F.col("f.at.turn")))
    return c.join(f, same, "left").select("c.*", F.col("f.key").isNotNull().alias("first"))


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


class _Conversation:
    def __init__(self, conv):
        self.conv, self.codes = conv, bytearray()
        self.low = self.high = self.turn = None
        self.turns = 0

    def add(self, turn, code: int, times: int, first: bool) -> None:
        if not times:
            return
        if turn is not None and turn != self.turn:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
        repeated = code if code >> 2 == _BLANK else _DUPLICATE << 2 | code & 3
        if first:
            self.codes.append(code)
            times -= 1
        self.codes += bytes([repeated]) * times

    def counts(self) -> list[int]:
        codes = np.frombuffer(bytes(self.codes), np.uint8)
        faults, initials = codes >> 2, codes & 3
        legal = np.zeros(16, bool)
        legal[[a << 2 | b for a, b in _LEGAL]] = True
        illegal = int((~legal[initials[:-1] << 2 | initials[1:]]).sum())
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return [gaps, *(int((faults == f).sum()) for f in (_BLANK, _DUPLICATE, _CUT)), illegal]


def _solve(batches) -> Iterator[pa.RecordBatch]:
    """A row per conversation from its coded rows, which come in order."""
    table, id_type = Layers(), None
    names = ["conv", *_COUNTS, "audit"]

    def finished(conversations: list[_Conversation]) -> pa.RecordBatch:
        costs, layers = zip(*(table.solve(c.codes) for c in conversations))
        if len(conversations) == 1:
            found = [least_audit(table, layers[0])]
        else:
            found, _ = audits(table, list(layers), [_START] * len(layers))
        rows = [(c.conv, *c.counts(), cost, audit) for c, cost, audit in zip(conversations, costs, found)]
        types = [id_type, *[pa.int64()] * len(_COUNTS), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    held, size, current = [], 0, None
    for batch in batches:
        id_type = batch.schema.field(0).type
        for conv, turn, code, times, first in zip(*(column.to_pylist() for column in batch.columns)):
            if current is None or conv != current.conv:
                if current is not None:
                    if size and size + len(current.codes) > BLOCK:
                        yield finished(held)
                        held, size = [], 0
                    held.append(current)
                    size += len(current.codes) + 1
                current = _Conversation(conv)
            current.add(turn, code, times, first)
    if current is not None:
        if size and size + len(current.codes) > BLOCK:
            yield finished(held)
            held = []
        yield finished([*held, current])


def _normal(df: DataFrame, names: dict[str, str]) -> DataFrame:
    rows = pick(df, names)
    text = F.coalesce("text", F.lit(" "))
    return rows.select("conv", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                       text.alias("text"), F.unhex(F.sha2(text, 256)).alias("key"),
                       F.col("times").cast("int").alias("times") if "times" in names else F.lit(1).alias("times"))


def _in_order(frame: DataFrame, *order: str) -> DataFrame:
    return frame.repartition("conv").sortWithinPartitions("conv", *order)


def _audited(rows: DataFrame) -> DataFrame:
    id_type = rows.schema["conv"].dataType.simpleString()
    coded = _in_order(_coded(rows), "turn", "role", "key").select("conv", "turn", "code", "times", "first")
    return coded.mapInArrow(_solve, f"conv {id_type}, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", audit binary")


class _Edits:
    """Follows an audit through the rows of a conversation; gives (role, text, edit) of the repaired rows."""

    def __init__(self, audit: bytes):
        self.audit, self.place, self.state = audit, 0, _START

    def inserts(self):
        while self.place < len(self.audit) and self.audit[self.place] == ord("I"):
            yield _ROLE[self.state], "", "I"
            self.state = _TURN[self.state]
            self.place += 1

    def row(self, role: str, text: str):
        yield from self.inserts()
        edit = chr(self.audit[self.place])
        self.place += 1
        if edit == "K":
            self.state = _KEPT[self.state, "sua".index(role[0])]
            yield role, text, edit
        elif edit == "R":
            yield _ROLE[self.state], text, edit
            self.state = _TURN[self.state]


def _edited(rows: DataFrame) -> DataFrame:
    """The audit row of each conversation, then its rows in order, all conversations one after the other."""
    solved = _audited(rows)
    nothing = [F.lit(None).cast(solved.schema[name].dataType).alias(name) for name in [*_COUNTS, "audit"]]
    heads = solved.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"),
                          F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
                          F.lit(None).cast("binary").alias("key"), F.lit(0).alias("times"), *_COUNTS, "audit")
    texts = rows.filter("times > 0").select("conv", F.lit(1).alias("kind"), "turn", "role", "text", "key", "times", *nothing)
    return _in_order(heads.unionByName(texts), "kind", "turn", "role", "key").drop("turn", "key")


def repaired_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """The repaired conversations: ``conv``, ``place`` (from 0), ``role``, ``text`` and ``edit`` (K, R or I)."""
    rows = _normal(df, {"conv": conv_col, "turn": turn_col, "role": role_col, "text": text_col})

    def run(batches):
        conv = edits = None
        place = 0
        for batch in batches:
            out = []

            def add(found):
                nonlocal place
                for role, text, edit in found:
                    out.append((conv, place, role, text, edit))
                    place += 1

            listed = (batch.column(name).to_pylist() for name in ("conv", "kind", "role", "text", "times", "audit"))
            for row_conv, kind, role, text, times, audit in zip(*listed):
                if kind == 0:
                    if edits:
                        add(edits.inserts())
                    conv, edits, place = row_conv, _Edits(audit), 0
                for _ in range(times):
                    add(edits.row(role, text))
            yield _rows_of(out, batch.schema.field("conv").type)
            last_type = batch.schema.field("conv").type
        if edits:
            out = []
            for role, text, edit in edits.inserts():
                out.append((conv, place, role, text, edit))
                place += 1
            yield _rows_of(out, last_type)

    id_type = rows.schema["conv"].dataType.simpleString()
    return _edited(rows).mapInArrow(run, f"conv {id_type}, place bigint, role string, text string, edit string")


def _rows_of(rows: list, id_type: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 5
    types = [id_type, pa.int64(), pa.string(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                      ["conv", "place", "role", "text", "edit"])


def repair_report(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", times_col: str | None = None) -> DataFrame:
    """One row per conversation: ``conv``, the counts of faults, ``cost``, ``audit`` and ``repaired_sha256``.

    The checksum is that of the repaired rows as ``role:text``, joined by line
    breaks. A row counts as often as ``times_col`` says, also not at all; a
    conversation without rows has zeros and an empty audit.
    """
    names = {"conv": conv_col, "turn": turn_col, "role": role_col, "text": text_col}
    rows = _normal(df, names | ({"times": times_col} if times_col else {}))

    def run(batches):
        current = edits = None
        digest, begun = hashlib.sha256(), False

        def take(found):
            nonlocal begun
            for role, text, _ in found:
                digest.update(f"\n{role}:{text}".encode() if begun else f"{role}:{text}".encode())
                begun = True

        def ended():
            take(edits.inserts())
            return (*current, digest.hexdigest())

        id_type = None
        for batch in batches:
            id_type, out = batch.schema.field("conv").type, []
            listed = [batch.column(name).to_pylist() for name in
                      ("conv", "kind", "role", "text", "times", *_COUNTS, "audit")]
            for conv, kind, role, text, times, *counts, audit in zip(*listed):
                if kind == 0:
                    if edits:
                        out.append(ended())
                    current, edits = (conv, *counts, audit), _Edits(audit)
                    digest, begun = hashlib.sha256(), False
                for _ in range(times):
                    take(edits.row(role, text))
            yield batch_of(out, id_type)
        if edits:
            yield batch_of([ended()], id_type)

    def batch_of(out, id_type):
        types = [id_type, *[pa.int64()] * len(_COUNTS), pa.binary(), pa.string()]
        columns = list(zip(*out)) or [[]] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                          ["conv", *_COUNTS, "audit", "repaired_sha256"])

    schema = (f"conv {rows.schema['conv'].dataType.simpleString()}, " + ", ".join(f"{c} bigint" for c in _COUNTS)
              + ", audit binary, repaired_sha256 string")
    return _edited(rows).mapInArrow(run, schema).withColumn("audit", F.col("audit").cast("string"))


def damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """The contract's damage: ``conv_id``, ``turn``, ``role``, ``text`` and how many ``times`` the row is there."""
    rows = pick(df, {"conv_id": conv_col, "turn": turn_col, "role": role_col, "text": text_col})
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind, text = F.crc32(name.cast("binary")) % 20, F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"))


def repair_digest(df: DataFrame) -> DataFrame:
    """The contract's row per conversation, after the damage."""
    found = repair_report(damaged(df), times_col="times")
    return found.withColumnRenamed("conv", "conv_id")
