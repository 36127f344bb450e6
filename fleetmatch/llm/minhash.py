"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is the weighted set of its shingles of ``SHINGLE`` case-folded words (all
its words, if it has fewer). A shingle's weight is its damped count in the text
times an inverse document frequency, counted over all rows per hash bucket of
the shingles, a table of fixed size. ``BANDS * ROWS`` samples are drawn from each
set, each of which is equal in two texts with the probability of their weighted
Jaccard similarity; texts that agree in all samples of a band are candidates.

Candidates become links only if their exact weighted Jaccard similarity is at least
``SIMILARITY``. In a bucket each text is first compared with leaders, which
already joins groups of copies without comparing all pairs in them. What then
still lies in different classes of one bucket is compared pair by pair; an exact
bound leaves out the pairs that cannot be similar. So no
candidate goes unchecked that could join two classes. Classes are the connected
components of equal texts and links, found by joins.

A null text counts as empty; all texts without a word are one class only if they
are equal. Rows with equal texts are one class, whatever their ids; repeated and
null ids keep their rows. An empty table gives an empty result; other columns do
not matter.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmatch.llm.common import numbered, pick, pieces, position_of, stored
from fleetmatch.llm.graph import components
from fleetmatch.llm.wordhash import mixed, window_hashes, words_of

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 4
FEATURE_BITS = 18      # buckets of the document frequencies
LEADER_ROUNDS = 2
CENTRAL_ROUNDS = 1     # of leaders in large buckets, chosen by how little they have of their own
CROWD = 32             # nodes of a bucket from which it gets such a leader
GROUPS = 64            # of the shingles, by hash, whose weights bound what two texts have in common
COARSE = 8             # parts of the groups, which are compared first

SLICE = 1 << 18        # bytes of text worked on at a time

_ELEMENT_BITS = 44     # of a shingle's hash; the other bits number the texts of a batch
_DRAWS = 16            # bits of a shingle and sample that choose its random numbers
_RANGE = 64.0          # of the logarithms compared in a sample
_rng = np.random.default_rng(8191)
_SAMPLE_FACTORS = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_BAND_FACTORS = _rng.integers(1, 1 << 63, ROWS, dtype=np.uint64) | np.uint64(1)
# Ioffe's r, c (both gamma of shape 2) and beta, for each draw.
_R = _rng.gamma(2.0, 1.0, 1 << _DRAWS)
_LOG_C = np.log(_rng.gamma(2.0, 1.0, 1 << _DRAWS))
_BETA = _rng.random(1 << _DRAWS)


@dataclass
class Sets:
    """The distinct shingles of several texts; those of text ``i`` are ``first[i]:first[i + 1]``."""

    elements: np.ndarray
    counts: np.ndarray
    first: np.ndarray


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> Sets:
    table = words_of(texts)
    hashes, first = table.hashes, table.first
    lengths = np.diff(first)
    windows = window_hashes(hashes, size)
    owners = np.repeat(np.arange(len(texts)), lengths)
    inside = np.arange(len(windows)) + size <= first[owners[:len(windows)] + 1]
    found, owned = [windows[inside]], [owners[:len(windows)][inside]]
    for length in range(1, size):
        short = np.flatnonzero(lengths == length)
        if len(short):
            found.append(window_hashes(hashes, length)[first[short]])
            owned.append(short)
    keys = np.concatenate(found) >> np.uint64(64 - _ELEMENT_BITS)
    keys |= np.concatenate(owned).astype(np.uint64) << np.uint64(_ELEMENT_BITS)
    keys.sort()
    new = np.flatnonzero(np.diff(keys, prepend=~keys[:1])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(new, len(keys)))
    keys = keys[new]
    bounds = np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(_ELEMENT_BITS)
    return Sets(keys & np.uint64((1 << _ELEMENT_BITS) - 1), counts, np.searchsorted(keys, bounds))


def features_of(elements: np.ndarray) -> np.ndarray:
    return (elements >> np.uint64(_ELEMENT_BITS - FEATURE_BITS)).astype(np.int64)


def count_features(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Rows, and for each bucket the number of rows with a shingle in it, from a column ``text``."""
    def run(batches):
        total, rows = np.zeros(1 << FEATURE_BITS, np.int64), 0
        for batch in pieces(batches, "text", SLICE):
            sets = shingle_sets(batch.column(0).to_pylist())
            owners = np.repeat(np.arange(batch.num_rows), np.diff(sets.first))
            keys = np.unique(owners << FEATURE_BITS | features_of(sets.elements))
            total += np.bincount(keys & ((1 << FEATURE_BITS) - 1), minlength=len(total))
            rows += batch.num_rows
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1), pa.int32()), pa.array(np.append(total[some], rows), pa.int64())],
            ["feature", "n"])

    counted = texts.mapInArrow(run, "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    found = counted.toPandas()  # as many rows as there are buckets, at most
    frequencies = np.zeros(1 << FEATURE_BITS, np.int64)
    real = found["feature"].to_numpy() >= 0
    frequencies[found["feature"].to_numpy()[real]] = found["n"].to_numpy()[real]
    return int(found["n"].to_numpy()[~real].sum()), frequencies


def inverse_frequencies(rows: int, frequencies: np.ndarray) -> np.ndarray:
    """1 + ln((rows + 1) / (n + 1)) / ln(rows + 2), in sixteenths.

    It stays between 1 and 2, so that a large group of near copies does not lose
    its similarity to what is common in it being common.
    """
    return 1 + np.rint(16 * np.log((rows + 1) / (frequencies + 1)) / np.log(rows + 2)) / 16


def weights_of(sets: Sets, inverse: np.ndarray) -> np.ndarray:
    """(1 + whole binary logarithm of the count) * inverse document frequency."""
    return np.frexp(sets.counts)[1] * inverse[features_of(sets.elements)]


_STEPS = 17            # weights from 1 to 2 in sixteenths, those of shingles that a text has once


@lru_cache(maxsize=1)
def _light() -> tuple[np.ndarray, np.ndarray]:
    """Ioffe's compared value and level of each light weight and draw, one weight after the other."""
    drawn = [_drawn(np.full(1 << _DRAWS, 1 + step / 16), np.arange(1 << _DRAWS)) for step in range(_STEPS)]
    return np.concatenate([value for value, _ in drawn]), np.concatenate([level for _, level in drawn])


def _drawn(weights: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    r, beta = _R[draws], _BETA[draws]
    level = np.floor(np.log(weights) / r + beta)
    scaled = np.clip((_LOG_C[draws] - r * (level + 1 - beta) + _RANGE) * ((1 << 31) / (2 * _RANGE)), 0, (1 << 31) - 1)
    return scaled.astype(np.uint32), level.astype(np.int32)


class Sampler:
    """Draws the samples of weighted sets.

    What each draw gives is looked up for the weights up to 2, in a table of fixed
    size, and computed for the others.
    """

    def __init__(self):
        self.values, self.levels = _light()

    def bands(self, sets: Sets, weights: np.ndarray) -> np.ndarray:
        """One bucket per band for each text that has a shingle, in their order."""
        texts = np.flatnonzero(np.diff(sets.first))
        out = np.zeros((len(texts), BANDS), np.uint64)
        if not len(texts):
            return out
        starts, elements = sets.first[texts], sets.elements
        heavy = np.flatnonzero(weights > 2)
        heavy_weights = weights[heavy]
        base = np.minimum(np.rint((weights - 1) * 16).astype(np.int64), _STEPS - 1) << _DRAWS
        places = np.arange(len(elements), dtype=np.uint64)
        shift, half, low = np.uint64(64 - _DRAWS), np.uint64(32), np.uint64((1 << 32) - 1)
        for band in range(BANDS):
            total = np.full(len(texts), band, np.uint64)
            for row in range(ROWS):
                draws = ((elements * _SAMPLE_FACTORS[band * ROWS + row]) >> shift).astype(np.int64)
                values = self.values[base + draws].astype(np.uint64)
                heavy_values, heavy_levels = _drawn(heavy_weights, draws[heavy])
                values[heavy] = heavy_values
                best = (np.minimum.reduceat(values << half | places, starts) & low).astype(np.int64)
                levels = self.levels[(base + draws)[best]]
                found = np.minimum(np.searchsorted(heavy, best), max(len(heavy) - 1, 0))
                if len(heavy):
                    levels = np.where(heavy[found] == best, heavy_levels[found], levels)
                sample = mixed(elements[best] * np.uint64(3) + levels.astype(np.int64).astype(np.uint64))
                total += sample * _BAND_FACTORS[row]
            out[:, band] = mixed(total)
        return out


def signatures(rows: DataFrame, text: str, inverse: np.ndarray) -> DataFrame:
    """The rows as a table, with ``row`` (a number), ``key`` (the text's checksum) and ``bands`` (none without words)."""
    shared = rows.sparkSession.sparkContext.broadcast(inverse)
    place = rows.columns.index(text)

    def run(batches):
        sampler = Sampler()
        for batch in pieces(batches, text, SLICE):
            sets = shingle_sets(batch.column(place).to_pylist())
            bands = sampler.bands(sets, weights_of(sets, shared.value))
            some = np.diff(sets.first) > 0
            offsets = np.concatenate([[0], np.cumsum(some * BANDS)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(bands.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "bands"])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields), "bands array<bigint>"])
    signed = rows.mapInArrow(run, schema)
    return stored(signed.withColumns({"row": F.monotonically_increasing_id(),
                                      "key": F.unhex(F.md5(F.coalesce(text, F.lit(""))))}), "signatures")


def similar(pairs: DataFrame, texts: DataFrame, inverse: np.ndarray, similarity: float) -> DataFrame:
    """The pairs ``a``, ``b`` whose texts (``node``, ``text``) are similar enough, with their ``similarity``."""
    shared = texts.sparkSession.sparkContext.broadcast(inverse)

    def run(batches):
        for batch in pieces(batches, "text_a", SLICE):
            a = shingle_sets(batch.column(2).to_pylist())
            b = shingle_sets(batch.column(3).to_pylist())
            weight_a, weight_b = weights_of(a, shared.value), weights_of(b, shared.value)
            shares = np.zeros(batch.num_rows)
            for i in range(batch.num_rows):
                in_a, in_b = slice(a.first[i], a.first[i + 1]), slice(b.first[i], b.first[i + 1])
                _, at, bt = np.intersect1d(a.elements[in_a], b.elements[in_b], True, return_indices=True)
                common = np.minimum(weight_a[in_a][at], weight_b[in_b][bt]).sum()
                union = weight_a[in_a].sum() + weight_b[in_b].sum() - common
                if union:
                    shares[i] = common / union
            kept = np.flatnonzero(shares >= similarity)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(kept)), batch.column(1).take(pa.array(kept)), pa.array(shares[kept])],
                ["a", "b", "similarity"])

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a bigint, b bigint, similarity double")


def limits(texts: DataFrame, inverse: np.ndarray) -> DataFrame:
    """``node`` with the ``weight`` of all its shingles and of those that another of these texts has, ``common``."""
    shared = texts.sparkSession.sparkContext.broadcast(inverse)

    def run(batches):
        for batch in pieces(batches, "text", SLICE):
            sets = shingle_sets(batch.column(1).to_pylist())
            owners = np.repeat(batch.column(0).to_numpy(), np.diff(sets.first))
            yield pa.RecordBatch.from_arrays(
                [pa.array(owners), pa.array(sets.elements.astype(np.int64)), pa.array(weights_of(sets, shared.value))],
                ["node", "element", "weight"])

    shingles = texts.select("node", "text").mapInArrow(run, "node bigint, element bigint, weight double")
    held = shingles.groupBy("element").agg(F.count("*").alias("held"))
    return shingles.join(held, "element").groupBy("node").agg(
        F.sum("weight").alias("weight"), F.sum(F.when(F.col("held") > 1, F.col("weight")).otherwise(0.0)).alias("common"))


def profiles(texts: DataFrame, inverse: np.ndarray) -> DataFrame:
    """``node`` with its weight in each of ``GROUPS`` hash groups of shingles, ``fine``, and their sum, ``total``.

    ``h0``, ``h1``, ... are the sums of ``COARSE`` parts of the groups. Two texts have in
    common at most the sum over the groups of the smaller weight. All are whole
    numbers of sixteenths, so the bound is exact.
    """
    shared = texts.sparkSession.sparkContext.broadcast(inverse)
    coarse = [f"h{i}" for i in range(COARSE)]

    def run(batches):
        for batch in pieces(batches, "text", SLICE):
            sets = shingle_sets(batch.column(1).to_pylist())
            rows = np.repeat(np.arange(batch.num_rows), np.diff(sets.first))
            groups = (mixed(sets.elements) % np.uint64(GROUPS)).astype(np.int64)
            weights = np.rint(weights_of(sets, shared.value) * 16)
            held = np.bincount(rows * GROUPS + groups, weights, batch.num_rows * GROUPS).astype(np.int64)
            fine = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * GROUPS), pa.array(held))
            held = held.reshape(-1, COARSE, GROUPS // COARSE).sum(2)
            parts = [pa.array(np.ascontiguousarray(held[:, i])) for i in range(COARSE)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held.sum(1)), *parts, fine],
                                             ["node", "total", *coarse, "fine"])

    schema = ", ".join(f"{name} bigint" for name in ("node", "total", *coarse)) + ", fine array<bigint>"
    return texts.select("node", "text").mapInArrow(run, schema)


def _can_be_similar(similarity: float):
    """Whether ``x`` and ``y`` with these profiles can reach the similarity; the quick tests come first.

    A little is added for the product of doubles.
    """
    def reaches(most):
        both = (F.col("x.total") + F.col("y.total")) * (similarity * (1 - 1e-9))
        return most * (1 + similarity) >= both

    coarse = F.least("x.h0", "y.h0")
    for i in range(1, COARSE):
        coarse = coarse + F.least(f"x.h{i}", f"y.h{i}")
    smaller = F.zip_with("x.fine", "y.fine", lambda x, y: F.least(x, y))
    fine = F.aggregate(smaller, F.lit(0).cast("bigint"), lambda total, x: total + x)
    return reaches(F.least("x.total", "y.total")) & reaches(coarse) & reaches(fine)


def _open(placed: DataFrame) -> DataFrame:
    """The rows of buckets with several classes, with the bucket's size."""
    buckets = placed.groupBy("band", "bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
    return placed.join(buckets.filter("low < high").select("band", "bucket", "size"), ["band", "bucket"])


def _led_pairs(rows: DataFrame, rank) -> DataFrame:
    """Each row of a bucket with its leader, the node of the lowest rank, if that is in another class."""
    leaders = rows.groupBy("band", "bucket").agg(
        F.min_by(F.struct(F.col("node").alias("leader"), F.col("component").alias("led_by")), rank).alias("led"))
    return (rows.join(leaders.select("band", "bucket", "led.*"), ["band", "bucket"]).filter("component <> led_by")
            .select(F.col("leader").alias("a"), F.col("node").alias("b")))


def _all_pairs(rows: DataFrame, similarity: float) -> DataFrame:
    """All pairs of one bucket and different classes that can be similar at all, each from the first bucket they share.

    The nodes' profiles, which are exact, rule out the other pairs before they are made.
    """
    keys = rows.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("band", "bucket"))).alias("keys"))
    rows = rows.join(keys, "node")  # at most one key per band
    first_in_common = F.get(F.array_intersect("x.keys", "y.keys"), F.lit(0))
    found = rows.alias("x").join(
        rows.alias("y"), (F.col("x.band") == F.col("y.band")) & (F.col("x.bucket") == F.col("y.bucket"))
        & (F.col("x.component") < F.col("y.component")) & _can_be_similar(similarity)
        & (first_in_common["band"] == F.col("x.band")))
    return found.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables about the rows of ``df``.

    ``members``: ``row``, ``id``, ``node`` (the smallest row with that text),
    ``class_row`` (the smallest node of the class). ``links``: ``a``, ``b``,
    ``similarity`` of the pairs of nodes whose links make the classes; pairs
    already joined by others are not among them. ``rows``: ``row`` and the
    columns of ``df`` as ``_0``, ``_1``, ...
    """
    number, frequencies = count_features(pick(df, {"text": text_col}))
    inverse = inverse_frequencies(number, frequencies)
    id_name, text_name = (f"_{position_of(df, name)}" for name in (id_col, text_col))
    signed = signatures(numbered(df), text_name, inverse)
    nodes = stored(signed.groupBy("key").agg(F.min("row").alias("node")), "nodes")

    banded = (signed.select("row", "bands").join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
              .select(F.col("row").alias("node"), F.posexplode("bands").alias("band", "bucket")))
    sizes = banded.groupBy("band", "bucket").agg(F.count("*").alias("n")).filter("n > 1").select("band", "bucket")
    shared = stored(banded.join(sizes, ["band", "bucket"]), "buckets")
    texts = stored(signed.select(F.col("row").alias("node"), F.col(text_name).alias("text"))
                   .join(shared.select("node").distinct(), "node", "left_semi"), "candidate-texts")

    links, tested = None, None
    classes = shared.select("node").distinct().withColumn("component", F.col("node"))
    bounds = None
    for turn in range(LEADER_ROUNDS + CENTRAL_ROUNDS + 1):
        rows = _open(shared.join(classes, "node"))
        if turn < LEADER_ROUNDS:
            pairs = _led_pairs(rows, F.xxhash64("node", F.lit(turn)))
        else:
            if turn < LEADER_ROUNDS + CENTRAL_ROUNDS:
                crowd = rows.filter(F.col("size") > CROWD)
                if bounds is None:
                    bounds = limits(texts.join(crowd.select("node").distinct(), "node", "left_semi"), inverse)
                    bounds = stored(bounds, "limits")
                # The text with the least of its own is the likeliest to be what the others were made from.
                own = F.struct(1 - F.col("common") / F.col("weight"), F.xxhash64("node", F.lit(turn)))
                # A text whose common part is too small for any partner is left out at once.
                able = bounds.filter(F.col("common") * (1 + 1e-9) >= similarity * F.col("weight"))
                pairs = _led_pairs(crowd.join(able, "node"), own)
            else:
                profile = profiles(texts.join(rows.select("node").distinct(), "node", "left_semi"), inverse)
                pairs = _all_pairs(rows.join(stored(profile, "profiles"), "node"), similarity)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        found = stored(similar(pairs, texts, inverse, similarity), "links")
        links = found if links is None else links.unionByName(found)
        tested = pairs if tested is None else tested.unionByName(pairs)
        # Only classes that the new links join are looked at again.
        ends = found.join(classes.select(F.col("node").alias("a"), F.col("component").alias("low")), "a")
        ends = ends.join(classes.select(F.col("node").alias("b"), F.col("component").alias("high")), "b")
        joined = components(ends.select(F.col("low").alias("a"), F.col("high").alias("b")))
        joined = joined.select(F.col("node").alias("component"), F.col("component").alias("root"))
        classes = stored(classes.join(joined, "component", "left")
                         .select("node", F.coalesce("root", "component").alias("component")), "classes")

    members = (signed.select("row", F.col(id_name).alias("id"), "key").join(nodes, "key")
               .join(classes.filter("node <> component"), "node", "left")
               .select("row", "id", "node", F.coalesce("component", "node").alias("class_row")))
    return members, links, signed.drop("key", "bands")


def duplicate_digest(df: DataFrame) -> DataFrame:
    """One row per document: its class, by the smallest id in it, and the class's size."""
    members, _, _ = near_duplicates(df)
    members = stored(members, "members")
    classes = members.groupBy("class_row").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"))
    return members.join(classes, "class_row").select(F.col("id").alias("doc_id"), "class_id", "class_size")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows and columns of ``df`` without all but one row of each class: the first by id, then by row."""
    members, _, rows = near_duplicates(df, id_col, text_col)
    first = members.groupBy("class_row").agg(F.min(F.struct("id", "row")).alias("first")).select("first.row")
    return rows.join(first, "row", "left_semi").drop("row").toDF(*df.columns)
