"""Records whose keys are not known beforehand, against a plain walk through each record."""

import json
import random

import pytest
from pyspark.sql import functions as F

from fleetmatch.operators.nested import flatten_open, leaf_paths
from fleetmatch.operators.records import with_record
from fleetmatch.operators.validate import validate_devices


def walk(record, prefix):
    """Names and values in the order of a walk; whole-number keys come first, by size."""
    flat = {}
    keys = sorted((k for k in record if k.isdecimal() and str(int(k)) == k), key=int)
    for key in keys + [k for k in record if k not in keys]:
        name, value = f"{prefix}_{key}", record[key]
        flat.update(walk(value, name) if isinstance(value, dict) else {name: value})
    return flat


def text_of(value):
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, list):
        return json.dumps(value, separators=(",", ":"))
    return json.dumps(value)


def random_record(rng, depth=3):
    record = {}
    for _ in range(rng.randrange(5)):
        key = rng.choice(["a", "b", "a_b", "b_a", "it's", "", "1", "x y", "Ä", "c.d", "[0]"])
        plain = not {"it's", ""} & {key}  # below these the order of keys is not read
        nested = depth and plain and rng.random() < 0.5
        record.pop(key, None)
        record[key] = random_record(rng, depth - 1) if nested else rng.choice([1, -2, "t", "", True, None, [1, {"k": 2}], []])
    return record


def test_random_records(spark):
    rng = random.Random(6)
    texts = [json.dumps(random_record(rng), ensure_ascii=False) for _ in range(400)]
    texts += [None, "", "nope", "[1, 2]", "3", "{}", '{"a": 1, "a": {"b": 2}}', '{"a": {"b": 3}, "a_b": 4, "a": {"b": 5}}']
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, r string")
    flat = flatten_open(rows, "r", "string")
    found = {row["id"]: row.asDict() for row in flat.collect()}
    names = set()
    for i, text in enumerate(texts):
        try:
            record = json.loads(text) if text else None
        except ValueError:
            record = None
        wanted = walk(record, "r") if isinstance(record, dict) else {}
        names |= wanted.keys()
        given = {name: value for name, value in found[i].items() if value is not None and name != "id"}
        assert given == {k: text_of(v) for k, v in wanted.items() if v is not None}, (i, text)
    assert set(flat.columns) == names | {"id"}


def test_types_stay_as_variants(spark):
    rows = spark.createDataFrame([(1, '{"n": 1, "f": 1.5, "s": "1", "z": null, "l": [1, {"q": 2}]}'), (2, '{"n": "x"}')],
                                 "id int, r string")
    flat = flatten_open(rows, "r")
    kinds = flat.orderBy("id").select(*[F.schema_of_variant(c).alias(c) for c in flat.columns if c != "id"]).collect()
    assert kinds[0].asDict() == {"r_n": "BIGINT", "r_f": "DECIMAL(2,1)", "r_s": "STRING", "r_z": "VOID",
                                 "r_l": "ARRAY<VARIANT>"}
    assert kinds[1]["r_n"] == "STRING" and kinds[1]["r_z"] is None


def test_maps_and_variants(spark):
    maps = spark.createDataFrame([(1, {"b": "x", "a": None}), (2, {}), (3, None)], "id int, m map<string,string>")
    assert sorted(map(tuple, flatten_open(maps, "m", "string").select("id", "m_a", "m_b").collect())) == [
        (1, None, "x"), (2, None, None), (3, None, None)]
    nested = spark.createDataFrame([(1, {"p": {"q": 1}}), (2, {"p_q": {"r": 2}})], "id int, m map<string,map<string,int>>")
    assert sorted(flatten_open(nested, "m", "string").columns) == ["id", "m_p_q", "m_p_q_r"]
    variants = spark.createDataFrame([('{"a": {"b": 1}, "a_b": 2}',)], "t string").select(F.parse_json("t").alias("v"))
    assert [tuple(r) for r in flatten_open(variants, "v", "string").collect()] == [("2",)]


def test_clashes_with_columns_and_odd_names(spark):
    rows = spark.createDataFrame([("first", '{"x": 1, "y": 2}', "last", 0)], "r_x string, r string, r_y string, `a.b` int")
    row = flatten_open(rows, "r", "string").first().asDict()
    assert row == {"r_x": "1", "r_y": "last", "a.b": 0}


def test_bounds_and_empty_tables(spark):
    rows = spark.createDataFrame([(f'{{"k{i}": {i}}}',) for i in range(30)], "r string")
    assert len(flatten_open(rows, "r", limit=30).columns) == 30
    with pytest.raises(ValueError, match="more than 29 key paths"):
        flatten_open(rows, "r", limit=29)
    deep = spark.createDataFrame([("{\"a\":" * 11 + "1" + "}" * 11,)], "r string")
    assert leaf_paths(with_record(deep, "r", "v"), "v") == {("a",) * 11: False}
    with pytest.raises(ValueError, match="more than 10 levels"):
        flatten_open(deep, "r", depth=10)
    assert flatten_open(rows.where("false"), "r").columns == []
    before = spark.conf.get("spark.sql.variant.allowDuplicateKeys", None)
    flatten_open(rows, "r")
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys", None) == before


def test_paths_are_reduced_before_the_shuffle(spark, sf_dir):
    from tests.conftest import plan_of

    from fleetmatch.operators.nested import _paths_of

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = plan_of(_paths_of(with_record(events, "props", "v"), "v", 4))
    assert plan.count("Exchange") == 1 and "partial_max" in plan and "Python" not in plan


def test_repeated_keys_of_devices(spark):
    cases = {'{"id": 1, "id": 2}': [], '{"id": 1, "id": ""}': ["Device must have an id or deviceId"],
             '{"id": "", "id": 1}': [], '{"id": 1, "name": 5, "name": "x"}': [],
             '{"id": 1, "isOnline": true, "isOnline": 1}': ["Device isOnline must be a boolean"],
             '{"id": 1, "lastActivity": "soon", "lastActivity": "2024-01-05"}': [],
             '{"id": 1, "x": {"y": 1, "y": 2}}': [], '{"id": 1': ["Record is not a JSON object"]}
    rows = spark.createDataFrame([(text,) for text in cases], "r string")
    for row in validate_devices(rows, "r").collect():
        assert row["errors"] == cases[row["r"]] and row["valid"] == (not row["errors"])
