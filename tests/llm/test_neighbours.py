import numpy as np

from fleetmatch.llm import neighbours
from fleetmatch.llm.common import read_table


def brute(rows, k=10):
    """Query id -> [(id, distance)], nearest first, over rows of (id, vector)."""
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    out = {}
    for place, query in enumerate(ids):
        if query % 100 == 0:
            d = np.sqrt(((x - x[place]) ** 2).sum(axis=1))
            order = [i for i in np.lexsort((ids, d)) if i != place][:k]
            out[int(query)] = [(int(ids[i]), float(d[i])) for i in order]
    return out


def found(frame):
    out = {}
    for row in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row["rank"] == len(out[row.query_id])
    return out


def recall(ours, wanted):
    hits = sum(len({i for i, _ in ours.get(q, [])} & {i for i, _ in w}) for q, w in wanted.items())
    return hits / sum(map(len, wanted.values()))


def test_recall_on_the_table(spark):
    frame = read_table(spark, "/root/testdata/sf0.1", "embeddings")
    wanted = brute([(r.vec_id, r.embedding) for r in frame.collect()])
    ours = found(neighbours.neighbour_digest(frame))
    assert recall(ours, wanted) >= 0.9 and all(len(w) == 10 for w in ours.values())
    for query, near in ours.items():
        known = dict(brute_all(wanted, query))
        assert all(abs(known[i] - d) < 1e-12 for i, d in near if i in known)


def brute_all(wanted, query):
    return wanted[query]


def test_copies_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in rng.normal(size=8)]) for i in range(150)]
    same = [(1000 + i, [1.0] * 8) for i in range(150)]
    bad = [(5000, None), (5100, [0.0] * 8), (5200, [None] + [1.0] * 7), (5300, [float("nan")] * 8),
           (5400, [float("inf")] * 8), (5500, [1.0] * 3), (None, [2.0] * 8)]
    listed = rows + same
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in listed + bad + rows[:3]],
                                  "vec_id long, embedding array<float>, node string, d long")
    frame32 = [(i, np.array(v, np.float32).astype(float)) for i, v in listed]
    wanted, ours = brute(frame32), found(neighbours.neighbour_digest(frame))
    assert set(ours) == set(wanted)
    assert [i for i, _ in ours[1000]] == list(range(1001, 1011)) and [i for i, _ in ours[1100]] == list(range(1000, 1010))
    assert recall(ours, wanted) >= 0.9


def test_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (100, [0.0, 1.0]), (3, [1.0, 1.0])], schema)
    ours = found(neighbours.neighbour_digest(few))
    assert ours == {0: [(3, 1.0), (100, 2 ** 0.5)], 100: [(3, 1.0), (0, 2 ** 0.5)]}
    one = spark.createDataFrame([(0, [1.0, 0.0])], schema)
    assert neighbours.neighbour_digest(one).count() == 0
    assert neighbours.neighbour_digest(few.limit(0)).count() == 0


def grouped(groups, size):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(groups, 6)) * 1000
    return [(100 * (g * size + i), [float(np.float32(v)) for v in centers[g] + rng.normal(size=6)])
            for g in range(groups) for i in range(size)]


def test_distant_groups_are_all_met(spark):
    for groups, size in ((2, 4), (40, 5)):
        rows = grouped(groups, size)
        wanted = brute(rows)
        ours = found(neighbours.neighbour_digest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")))
        assert {q: [i for i, _ in w] for q, w in ours.items()} == {q: [i for i, _ in w] for q, w in wanted.items()}


def test_queries_the_search_leaves_with_too_few_are_compared_with_all(spark, monkeypatch):
    rows = grouped(2, 8)
    wanted = brute(rows)
    monkeypatch.setattr(neighbours, "search", lambda queries, *rest: queries.selectExpr("q", "q as w", "0L as first", "0d as d"))
    ours = found(neighbours.neighbour_digest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")))
    assert {q: [i for i, _ in w] for q, w in ours.items()} == {q: [i for i, _ in w] for q, w in wanted.items()}


def test_ties_go_to_the_smaller_id(spark):
    rows = [(100 + i * 37 % 61, [float(i == j) for j in range(60)]) for i in range(60)]
    ours = found(neighbours.neighbour_digest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")))
    assert [i for i, _ in ours[100]] == sorted(i for i, _ in rows if i != 100)[:10]
