from zlib import crc32


from fleetmatch.llm import shards
from fleetmatch.llm.common import read_table
from tests.llm.helpers import documents, no_documents, odd_documents


def checked(frame, docs, n=40):
    """The rows, after the things that hold for any table."""
    rows = frame.collect()
    wanted = sorted((r.doc_id is not None, r.doc_id or 0, len((r[1] or "").encode()) + 16, crc32((r[1] or "").encode()))
                    for r in docs.collect())
    assert sorted((r.doc_id is not None, r.doc_id or 0, r["size"], r.text_crc32) for r in rows) == wanted
    by_shard = {}
    for row in rows:
        assert row.law == "bytes" and row.grown_shard is None and 0 <= row.shard < n
        by_shard.setdefault(row.shard, []).append(row)
    for members in by_shard.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
    return by_shard


def spread(by_shard, n=40):
    sizes = [sum(r["size"] for r in by_shard.get(i, [])) for i in range(n)]
    return max(sizes) - min(sizes)


def test_sizes_are_near_equal(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    by_shard = checked(shards.shard_digest(docs), docs)
    assert len(by_shard) == 40 and spread(by_shard) <= max(r["size"] for m in by_shard.values() for r in m)


def test_a_hot_text_and_equal_rows_are_cut(spark):
    rows = [(i, "the same text for all") for i in range(300)] + [(7, "one row again and again")] * 300
    rows += [(i, f"text {i} " * (1 + i % 7)) for i in range(300)]
    docs = documents(spark, rows)
    by_shard = checked(shards.shard_digest(docs), docs)
    assert len(by_shard) == 40 and spread(by_shard) < 250


def test_small_groups_of_copies_stay_together(spark):
    docs = documents(spark, [(i, f"text {i // 3} " * (1 + i // 3 % 20)) for i in range(1200)])
    by_shard = checked(shards.shard_digest(docs), docs)
    where = {}
    for shard, members in by_shard.items():
        for row in members:
            where.setdefault((row.text_crc32, row["size"]), set()).add(shard)
    assert sum(len(s) > 1 for s in where.values()) < 40


def test_odd_rows(spark):
    docs = odd_documents(spark)
    checked(shards.shard_digest(docs), docs)
    assert shards.shard_digest(no_documents(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = shards.shard_digest(odd_documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
