"""Flatten nested records; collect groups into lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmatch.operators.ordering import PART, PLACE, part_offsets, range_sorted
from fleetmatch.operators.projection import quoted
from fleetmatch.operators.records import record_text, with_record


def _leaves(schema: T.StructType, column: Column | None, prefix: str) -> dict[str, Column]:
    found: dict[str, Column] = {}
    for field in schema.fields:
        value = F.col(quoted(field.name)) if column is None else column.getField(field.name)
        name = f"{prefix}_{field.name}" if prefix else field.name
        if isinstance(field.dataType, T.StructType):
            found.update(_leaves(field.dataType, value, name))
        else:
            found[name] = value
    return found


def flatten(df: DataFrame) -> DataFrame:
    """Struct fields as ``parent_child`` columns; arrays, maps and scalars stay.

    On a name clash the later field wins; a struct without fields vanishes. Only
    the schema is walked, the data sees one projection.
    """
    return df.select(*[value.alias(name) for name, value in _leaves(df.schema, None, "").items()])


_Path = tuple[str, ...]
_ENTRIES = "map<string,variant>"
_LEVELS = 4


def leaf_paths(records: DataFrame, record: str, limit: int = 1000, depth: int = 64) -> dict[_Path, bool]:
    """The key paths of a VARIANT column that lead to something other than an object, sorted, and whether some lead to one.

    All rows are unfolded level by level in one plan and reduced to their distinct
    paths, first in each task; ``limit`` and ``depth`` bound what comes to the driver.
    Records with more than ``_LEVELS`` levels are read again, to twice the depth.
    """
    levels = min(_LEVELS, depth)
    while True:
        found = _paths_of(records, record, levels).limit(limit + 1).collect()
        if len(found) > limit:
            raise ValueError(f"the records have more than {limit} key paths")
        if not any(row["deeper"] for row in found):
            objects = {tuple(row["path"]) for row in found if row["empty"]}
            objects |= {tuple(row["path"][:i]) for row in found for i in range(1, len(row["path"]))}
            leaves = sorted(tuple(row["path"]) for row in found if row["leaf"])
            return {path: path in objects for path in leaves}
        if levels == depth:
            raise ValueError(f"the records are nested in more than {depth} levels")
        levels = min(2 * levels, depth)


def _paths_of(records: DataFrame, record: str, levels: int) -> DataFrame:
    """The distinct paths of at most ``levels`` keys, with whether they lead to a ``leaf``, an ``empty`` object, or ``deeper``."""
    step = records.select(F.array().cast("array<string>").alias("path"),
                          F.try_variant_get(quoted(record), "$", _ENTRIES).alias("entries"))
    step = step.where(F.col("entries").isNotNull())
    for _ in range(levels):
        # A leaf, and an object without keys, yields one row without a key and stays as it is.
        step = step.select("path", "entries", F.explode_outer("entries").alias("key", "child"))
        stays = F.col("key").isNull()
        step = step.select(
            F.when(stays, F.col("path")).otherwise(F.array_append("path", F.col("key"))).alias("path"),
            F.when(stays, F.col("entries")).otherwise(F.try_variant_get("child", "$", _ENTRIES)).alias("entries"))
    keys = F.coalesce(F.size("entries"), F.lit(-1))
    return step.groupBy("path").agg(F.max(keys < 0).alias("leaf"), F.max(keys == 0).alias("empty"),
                                    F.max(keys > 0).alias("deeper"))


def _step(value: Column, keys: Sequence[str]) -> Column:
    """The VARIANT below ``value`` at a path; NULL where the record has no such path."""
    for key in keys:
        if key and "'" not in key:
            value = F.try_variant_get(value, f"$['{key}']", "variant")
        else:  # not to be written in a path
            value = F.try_element_at(F.try_variant_get(value, "$", _ENTRIES), F.lit(key))
    return value


def _walk_order(text: Column, path: _Path) -> Column:
    """Where a walk through the record meets the path: the place of each key among its neighbours.

    Keys that are whole numbers come before all others.
    """
    places = []
    for level, key in enumerate(path):
        if any("'" in above or "?" in above or not above for above in path[:level]):
            raise ValueError(f"the order of keys below {path[:level]} cannot be read")
        inner = "$" + "".join(f"['{above}']" for above in path[:level])
        keys = F.json_object_keys(F.get_json_object(text, inner) if level else text)
        place = F.coalesce(F.array_position(keys, key), F.lit(0)).cast("bigint")
        is_index = key.isdecimal() and key.isascii() and (key == "0" or key[0] != "0") and int(key) < (1 << 32) - 1
        places.append(place - (1 << 32) if is_index else place)
    return F.array(*places)


def flatten_open(df: DataFrame, column: str, kind: str = "variant", limit: int = 1000, depth: int = 64) -> DataFrame:
    """Records whose keys are not known beforehand as columns ``column_key_key``, in place of ``column``.

    The column holds JSON text, VARIANT or maps. One aggregate over all rows finds the
    paths, then one projection reads them: a column per name that occurs in any row,
    by ``kind`` as ``variant`` (types stay, also a JSON null) or ``string``. Arrays and
    nulls stay as they are, an object without keys vanishes; a row without the
    path, or whose text is not a JSON object, has NULL. When two paths of a record
    give one name (``a: {b}`` and ``a_b``), the one that its walk meets later wins,
    row by row; VARIANT keeps its keys in alphabetical order. A column of ``df``
    with such a name gives way if it stands before ``column``, else it wins.
    """
    if kind not in ("variant", "string"):
        raise ValueError(f"unknown kind: {kind}")
    names, record, text = df.columns, "record of " + column, "text of " + column
    records = with_record(df.withColumn(text, record_text(df, column)), column, record)
    value = F.col(quoted(record))
    paths = leaf_paths(records, record, limit, depth)
    by_name: dict[str, list[_Path]] = {}
    for path in paths:
        by_name.setdefault("_".join((column, *path)), []).append(path)

    def leaf(path: _Path) -> Column:
        found = _step(value, path)
        # A key that holds an object in some rows is a leaf in the others only.
        return F.when(F.try_variant_get(found, "$", _ENTRIES).isNull(), found) if paths[path] else found

    def chosen(candidates: list[_Path]) -> Column:
        if len(candidates) == 1:
            return leaf(candidates[0])
        met = [F.when(leaf(path).isNotNull(), F.struct(_walk_order(F.col(quoted(text)), path).alias("place"),
                                                       F.lit(i).alias("which")))
               for i, path in enumerate(candidates)]
        last = F.array_max(F.array_compact(F.array(*met)))["which"]
        value = F.lit(None).cast("variant")
        for i, path in enumerate(candidates):
            value = F.when(last == i, leaf(path)).otherwise(value)
        return value

    columns: dict[str, Column] = {}
    for name in names:
        if name != column:
            columns[name] = F.col(quoted(name))
            continue
        for flat, candidates in by_name.items():
            found = chosen(candidates)
            columns[flat] = found if kind == "variant" else F.try_variant_get(found, "$", "string")
    return records.select(*[found.alias(name) for name, found in columns.items()])


def collect_groups(df: DataFrame, key: str, order: Sequence[str], chunk_rows: int = 1000) -> DataFrame:
    """Records per key as lists in order: (key, chunk, items); NULL is a key too.

    A list holds at most ``chunk_rows`` records; a larger group continues in the
    next chunk, so no record is lost and no group has to fit into one row or
    task. Positions in a group come from the sorted table, which splits hot keys;
    where a group begins is known per sorted partition and key, and joined on both,
    so that a hot key's rows never meet in one task.
    """
    items = [name for name in df.columns if name != key]
    placed = range_sorted(df, [key, *[name for name in order if name != key]])
    offsets = part_offsets(placed)
    per_part = placed.groupBy(PART, F.col(key).alias("group_key")).agg(F.min(PLACE).alias("first_place"))
    per_part = per_part.join(F.broadcast(offsets), PART)
    starts = per_part.groupBy("group_key").agg(F.min(F.col("offset") + F.col("first_place")).alias("start"))
    starts = (per_part.alias("p").join(starts.alias("s"), F.col("p.group_key").eqNullSafe(F.col("s.group_key")))
              .select(F.col(f"p.{PART}").alias("group_part"), "p.group_key", "offset", "start"))
    return (
        placed.join(starts, (F.col(PART) == F.col("group_part")) & F.col(key).eqNullSafe(F.col("group_key")))
        .withColumn("row_index", F.col("offset") + F.col(PLACE))
        .withColumn("chunk", F.floor((F.col("row_index") - F.col("start")) / chunk_rows).cast("bigint"))
        .groupBy(key, "chunk")
        .agg(F.sort_array(F.collect_list(F.struct("row_index", F.struct(*items).alias("item")))).alias("rows"))
        .select(key, "chunk", F.col("rows.item").alias("items"))
    )
