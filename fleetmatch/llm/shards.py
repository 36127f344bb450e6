"""Shards of near equal bytes by a k-d tree over the rows' metadata.

The tree starts with all rows and the number of shards wanted. A node that still
stands for several shards is cut along its widest dimension (ranges relative to
the whole table, ties to the first dimension named) at the weighted median, or
for an odd number at the matching weighted quantile, until each leaf holds the
target, the total bytes by the number of shards.

A row's place along a dimension is its value, then a hash of its text, then a
hash of its row number, in one integer. So rows of equal metadata and even equal
rows have different places, and a cut can go through a hot value or a hot group
of copies; other groups of equal texts mostly stay together. A quantile is found
by histograms: bytes per node and bucket, summed by Spark, then again inside the
one bucket that holds the cut. What reaches the driver is one row per node.

Size is the UTF-8 length of the text plus ``ROW_BYTES``. Null texts count as
empty, null metadata as the smallest value. Every row gets a shard and a slot,
repeated rows too; slots run without gaps in the order of the id. An empty table
gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetmatch.llm.common import pick, stored
from fleetmatch.operators.ordering import with_row_index

ROW_BYTES = 16
N_SHARDS = 40
VALUE_BITS, TEXT_BITS, ROW_BITS = 20, 26, 16
PLACE_BITS = VALUE_BITS + TEXT_BITS + ROW_BITS
BUCKET_BITS = 14
TOLERANCE = 1e-4  # a cut may be this share of the target away from the median


@dataclass
class Node:
    first: int            # the shards it stands for
    shards: int
    dimension: int = 0
    cut: int = 0          # places from here on go to the right


@dataclass
class _Search:
    target: float         # bytes wanted on the left
    low: int = 0          # the cut is in [low, low + 2 ** bits)
    before: int = 0       # bytes left of low
    done: bool = False


def metadata(df: DataFrame, id_col: str, text_col: str, dimensions: Sequence[tuple[str, str]]) -> DataFrame:
    """Id, size, checksum and, per dimension, a number; as a table with a row number."""
    rows = pick(df, {"id": id_col, "text": text_col, **{f"m{i}": name for i, (name, _) in enumerate(dimensions)}})
    data = F.encode(F.coalesce(F.col("text"), F.lit("")), "utf-8")
    numbers = []
    for i, (_, kind) in enumerate(dimensions):
        value = F.col(f"m{i}")
        if kind == "category":
            value = F.crc32(value.cast("string").cast("binary"))
        elif kind == "bytes":
            value = F.octet_length(value.cast("string"))
        numbers.append(value.cast("double").alias(f"m{i}"))
    return stored(rows.select("id", (F.octet_length(data) + ROW_BYTES).cast("long").alias("size"),
                              F.crc32(data).alias("crc"), *numbers,
                              F.monotonically_increasing_id().alias("row")), "shard-metadata")


def _places(table: DataFrame, dimensions: int) -> tuple[DataFrame, float]:
    """The table with ``places`` (one per dimension), and the sum of sizes."""
    bounds = table.agg(F.sum("size"), *[f(f"m{i}") for i in range(dimensions) for f in (F.min, F.max)]).first()
    tie = (F.shiftleft(F.pmod(F.xxhash64("size", "crc"), F.lit(1 << TEXT_BITS)), ROW_BITS)
           + F.pmod(F.xxhash64("row"), F.lit(1 << ROW_BITS)))
    values = []
    for i in range(dimensions):
        low, high = bounds[1 + 2 * i], bounds[2 + 2 * i]
        if low is None or not high > low:
            values.append(F.lit(0).cast("long"))
        else:
            share = (F.coalesce(F.col(f"m{i}"), F.lit(low)) - low) / (high - low)
            values.append(F.floor(share * ((1 << VALUE_BITS) - 1)).cast("long"))
    places = F.array(*[F.shiftleft(value, TEXT_BITS + ROW_BITS) + tie for value in values])
    return table.withColumn("places", places), bounds[0] or 0


def _descend(levels: list[list[Node]]) -> Column:
    """The node of a row after the cuts made so far; node ``n`` has the children ``2 n`` and ``2 n + 1``."""
    node = F.lit(0)
    if not levels:
        return node
    cuts = F.array(*[F.struct(
        F.array(*[F.lit(n.dimension) for n in level]).alias("dimension"),
        F.array(*[F.lit(n.cut).cast("long") for n in level]).alias("cut")) for level in levels])

    def step(at, level):
        place = F.get(F.col("places"), F.get(level["dimension"], at))
        return at * 2 + F.when(place >= F.get(level["cut"], at), 1).otherwise(0)

    return F.aggregate(cuts, node, step)


def _cut(rows: DataFrame, nodes: list[Node], count: int, target: float) -> None:
    """Find the cuts of all nodes that stand for several shards, together; ``count`` dimensions."""
    open_nodes = {i for i, node in enumerate(nodes) if node.shards > 1}
    widths = rows.groupBy("node").agg(F.sum("size").alias("bytes"), *[
        (F.max(F.get("places", F.lit(i))) - F.min(F.get("places", F.lit(i)))).alias(f"w{i}") for i in range(count)])
    searches: dict[int, _Search] = {}
    for node in nodes:
        node.cut = 1 << PLACE_BITS  # everything goes to the left
    for found in widths.collect():  # one row per node
        if found["node"] in open_nodes:
            node = nodes[found["node"]]
            spread = [found[f"w{i}"] >> (TEXT_BITS + ROW_BITS) for i in range(count)]
            node.dimension = spread.index(max(spread))
            searches[found["node"]] = _Search(found["bytes"] * (node.shards // 2) / node.shards)
    bits = PLACE_BITS
    while bits and any(not s.done for s in searches.values()):
        step = max(0, bits - BUCKET_BITS)
        active = {i: s for i, s in searches.items() if not s.done}

        def per_node(values, kind):
            return F.get(F.array(*[F.lit(values.get(i)).cast(kind) for i in range(len(nodes))]), F.col("node"))

        place = F.get("places", per_node({i: nodes[i].dimension for i in active}, "int"))
        offset = place - per_node({i: s.low for i, s in active.items()}, "long")
        histogram = (rows.select("node", "size", offset.alias("offset"))
                     .filter((F.col("offset") >= 0) & (F.col("offset") < (1 << bits)))
                     .groupBy("node", F.shiftright("offset", step).alias("bucket"))
                     .agg(F.sum("size").alias("bytes"), F.count("*").alias("n")))
        order = Window.partitionBy("node").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        reached = F.sum("bytes").over(order) + per_node({i: s.before for i, s in active.items()}, "long")
        wanted = per_node({i: s.target for i, s in active.items()}, "double")
        straddling = (histogram.withColumn("reached", reached).filter(F.col("reached") >= wanted)
                      .groupBy("node").agg(F.min_by(F.struct("bucket", "bytes", "n", "reached"), "bucket").alias("b")))
        for node, b in straddling.collect():  # one row per node
            search = active[node]
            search.low += b["bucket"] << step
            search.before = b["reached"] - b["bytes"]
            if b["n"] == 1 or b["bytes"] <= TOLERANCE * target or not step:
                # The bucket goes to the side that comes out nearer to the target.
                left = b["reached"] - search.target <= search.target - search.before
                nodes[node].cut = search.low + ((1 << step) if left else 0)
                search.done = True
        bits = step


def assign_shards(df: DataFrame, n_shards: int = N_SHARDS, id_col: str = "doc_id", text_col: str = "text",
                  dimensions: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """``id``, ``size``, ``crc``, ``shard`` and ``slot`` of every row.

    ``dimensions`` gives the metadata columns and their kinds: ``number``,
    ``category`` (ordered by a hash) or ``bytes`` (the length of a text). What all
    copies of a text share keeps them in one shard, unless a cut goes through them.
    """
    dimensions = dimensions or [(text_col, "bytes"), (text_col, "category")]
    table = metadata(df, id_col, text_col, dimensions)
    table, total = _places(table, len(dimensions))
    target = total / n_shards
    levels: list[list[Node]] = []
    level = [Node(0, n_shards)]
    while any(node.shards > 1 for node in level):
        _cut(table.withColumn("node", _descend(levels)), level, len(dimensions), target)
        levels.append(level)
        below = []
        for node in level:
            left = node.shards // 2 if node.shards > 1 else node.shards
            below += [Node(node.first, left), Node(node.first + left, node.shards - left)]
        level = below
    shard = F.get(F.array(*[F.lit(node.first) for node in level]), _descend(levels))
    placed = with_row_index(table.select("id", "size", "crc", "row", shard.alias("shard")),
                            ["shard", "id", "row"], "place", unique=True)
    firsts = {shard: place for shard, place in placed.groupBy("shard").agg(F.min("place")).collect()}  # one per shard
    first = F.get(F.array(*[F.lit(firsts.get(i, 0)).cast("long") for i in range(n_shards)]), F.col("shard"))
    return placed.select("id", "size", "crc", "shard", (F.col("place") - first).alias("slot"))


def shard_digest(df: DataFrame) -> DataFrame:
    """The contract's row per document."""
    dimensions = [("text", "bytes"), ("lang", "category"), ("text", "category")]
    return assign_shards(df, dimensions=dimensions).select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
