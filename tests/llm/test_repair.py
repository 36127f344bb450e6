import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import types as T

from fleetmatch.llm import repair
from fleetmatch.llm.common import read_table

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
    *[T.StructField(name, T.StringType()) for name in ("TEXT", "conv", "key", "times", "kind", "audit", "cost", "a.b")]])

sys.setrecursionlimit(20000)  # of the plain version

SEEN = "[^\x20\x09-\x0d]"


def conversations(spark, rows):
    return spark.createDataFrame([tuple(row) + ("x",) * 8 for row in rows], SCHEMA)


def faults_of(rows):
    found, seen = [], set()
    for role, text in rows:
        shown = re.findall(SEEN, text)
        if not shown:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def plain_repair(rows):
    """The least (cost, audit) over all edits, by trying each one, and the repaired rows."""
    faults = faults_of(rows)
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(None)
    def best(i, state, inserts):
        options = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        turn = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[turn]
        if inserts < 3:
            options.append(plus(2, "I", (name, ""), best(i, turn, inserts + 1)))
        if i < len(rows):
            role, text = rows[i]
            options.append(plus(3, "D", None, best(i + 1, state, 0)))
            if faults[i] not in ("blank", "duplicate"):
                cut = 1 if faults[i] == "truncated" else 0
                if (state, role[:1]) in after:
                    options.append(plus(cut, "K", (role, text), best(i + 1, role[:1], 0)))
                options.append(plus(2 + cut, "R", (name, text), best(i + 1, turn, 0)))
        return min(options, key=lambda o: o[:2], default=(10 ** 9, "", ()))

    def plus(cost, edit, row, rest):
        return rest[0] + cost, edit + rest[1], ((row,) if row else ()) + rest[2]

    return best(0, "", 0)


def expected(rows, harm=True):
    """The contract's rows by conversation."""
    held = {}
    for conv, turn, role, text in rows:
        kept = held.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20 if harm else 19
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept.extend([(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1))
    out = {}
    for conv, kept in held.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        turns = [r[0] for r in kept if r[0] is not None]
        pairs = [(role, text) for _, role, text in kept]
        faults = faults_of(pairs)
        cost, audit, repaired = plain_repair(tuple(pairs))
        initials = [role[:1] for role, _ in pairs]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"),
            faults.count("duplicate"), faults.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest())
    return out


def found(frame):
    rows = frame.collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r[1:]) for r in rows}


def random_rows(rng, convs, most=9):
    rows = []
    for conv in range(convs):
        for turn in range(rng.randrange(most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "USER", "sys"])
            text = rng.choice(["Hi.", "Yes!", "cut", "", " ", "Hi.", None, "why?\n", "a\x0b", "é", "x. y", "\x85", " "])
            rows.append((conv, rng.choice([turn, turn, turn + 3, 2, None]), role, text))
    return rows


@pytest.mark.parametrize("harm", [True, False])
def test_random_conversations(spark, harm):
    rows = random_rows(random.Random(harm), 1500)
    rows += rows[:50]  # repeated rows
    frame = conversations(spark, rows)
    result = repair.repair_digest(frame) if harm else repair.repair_report(frame)
    assert found(result) == expected(rows, harm)


def test_whole_table(spark, sf_dir):
    table = read_table(spark, sf_dir, "conversations")
    wanted = expected([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    result = repair.repair_digest(table)
    assert result.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                              "repaired_sha256"]
    assert found(result) == wanted


def test_long_conversations_in_blocks():
    rng = random.Random(5)
    for _ in range(60):
        codes = bytes(rng.randrange(16) for _ in range(rng.randrange(1, 300)))
        table = repair.Layers()
        cost, layers = table.solve(codes)
        whole = repair.least_audit(table, layers)
        assert whole == repair.audits(table, [layers], [0])[0][0]
        for block in (1, 2, 7, 64):
            assert repair.least_audit(table, layers, block) == whole
        assert sum({"K": 0, "R": 2, "D": 3, "I": 2}[chr(e)] for e in whole) <= cost
        rows, n = [], 0
        for code in codes:
            fault, initial = divmod(code, 4)
            n += 1
            rows.append((["system", "user", "assistant", "tool"][initial], ["ok %d." % n, "", "dup.", "cut %d" % n][fault]))
        if not any(code >> 2 == 2 for code in codes):  # the plain version tells duplicates by text
            assert plain_repair(tuple(rows))[:2] == (cost, whole.decode())
    assert len(table.rows) < 500


def test_a_hot_conversation(spark):
    """A third of all rows in one conversation, many of them equal; longer than a block."""
    rows = [(0, turn, "user" if turn % 2 else "assistant", f"text {turn}.") for turn in range(150)]
    rows += [(0, 7, "user", "again.")] * 300 + [(0, None, "system", None)] * 50
    rows += random_rows(random.Random(1), 250, 5)
    rows = [(r[0] + 1 if i >= 500 else r[0], *r[1:]) for i, r in enumerate(rows)]
    assert found(repair.repair_report(conversations(spark, rows).repartition(5))) == expected(rows, False)


def test_odd_rows_and_none(spark):
    rows = [(None, 1, "user", "Hi."), (None, None, None, None), (1, None, "user", "a. " * 100000), (2, 5, "", ""),
            (3, -9, "assistant", "é?"), (3, 9, "user", "é?"), (4, None, "system", "Be good.")]
    assert found(repair.repair_report(conversations(spark, rows))) == expected(rows, False)
    assert repair.repair_digest(conversations(spark, [])).count() == 0
    assert repair.repaired_turns(conversations(spark, [])).count() == 0
    # Every row dropped by the damage.
    gone = [(c, 0, "user", "Hi.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    for row in repair.repair_digest(conversations(spark, gone)).collect():
        assert tuple(row)[1:7] == (0,) * 6 and row.audit == "" and row.repaired_sha256 == hashlib.sha256(b"").hexdigest()


def test_repaired_rows(spark):
    rows = random_rows(random.Random(9), 200)
    held = {}
    for r in repair.repaired_turns(conversations(spark, rows)).collect():
        held.setdefault(r.conv, []).append((r.place, r.role, r.text, r.edit))
    for conv, wanted in expected(rows, False).items():
        kept = sorted(held.get(conv, []))
        assert [p for p, *_ in kept] == list(range(len(kept)))
        joined = "\n".join(f"{role}:{text}" for _, role, text, _ in kept)
        assert hashlib.sha256(joined.encode()).hexdigest() == wanted[-1]
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for _, role, _, _ in kept))
        assert "".join(e for *_, e in kept) == wanted[-2].replace("D", "")
