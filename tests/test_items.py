"""Typed-attribute exports: known-schema decode, raw map form, profile."""

import gzip
import os

from conftest import rows
from tessera.sources.items import profile_items, read_typed_items, read_typed_items_raw

LINES = [
    '{"Item":{"id":{"S":"k1"},"n":{"N":"12.50"},"b":{"BOOL":true},"z":{"NULL":true}}}',
    '{"Item":{"id":{"S":"k2"},"tags":{"SS":["a","b"]},"m":{"M":{"q":{"N":"1"}}},"l":{"L":[{"S":"a"},{"N":"2"}]}}}',
    '{"Item":{"n":{"N":"1"}}}',
]


def _export(base):
    d = os.path.join(base.replace("file:", ""), "AWS", "01", "data")
    os.makedirs(d)
    with gzip.open(os.path.join(d, "part-0.json.gz"), "wt") as f:
        f.write("\n".join(LINES) + "\n")
    return base


def test_known_schema(spark, tmp_base):
    path = _export(tmp_base)
    df = read_typed_items(spark, path, {"id": "S", "n": "N", "b": "BOOL", "tags": "SS"}, cast={"n": "double"})
    assert rows(df) == [("k1", 12.5, True, None), ("k2", None, None, ["a", "b"]), (None, 1.0, None, None)]


def test_raw_and_profile(spark, tmp_base):
    path = _export(tmp_base)
    raw = read_typed_items_raw(spark, path)
    first = {r.item["id"]["S"] if "id" in r.item else None: r.item for r in raw.collect()}
    assert first["k2"]["m"]["M"] == '{"q":{"N":"1"}}'
    prof = {(r.attribute, r.type_code): r.n_items for r in profile_items(raw).collect()}
    assert prof == {("id", "S"): 2, ("n", "N"): 2, ("b", "BOOL"): 1, ("z", "NULL"): 1, ("tags", "SS"): 1,
                    ("m", "M"): 1, ("l", "L"): 1}


def test_big_numbers_keep_their_digits(spark, tmp_base):
    import os
    d = os.path.join(tmp_base.replace("file:", ""), "x")
    os.makedirs(d)
    with open(os.path.join(d, "p.json"), "w") as f:
        f.write('{"Item":{"n":{"N":"123456789012345678901234567890123"}}}\n')
    df = read_typed_items(spark, tmp_base, {"n": "N"}, cast={"n": "decimal(38,0)"})
    assert str(df.first().n) == "123456789012345678901234567890123"


def _items(spark, path, lines):
    import json
    spark.createDataFrame([(json.dumps({"Item": i}),) for i in lines], "value string").write.text(path)
    return path


def test_misfits_have_paths_at_every_depth(spark, tmp_base):
    from tessera.sources.items import read_typed_items
    path = _items(spark, tmp_base, [
        {"id": {"N": "1"}, "m": {"M": {"q": {"N": "5"}, "deep": {"M": {"a": {"N": "1"}, "b": {"S": "x"}}}}}, "l": {"L": [{"N": "1"}, {"N": "1.5"}, {"S": "z"}, {"M": {}}]}},
        {"id": {"N": "2"}, "m": {"M": {"q": {"S": "none"}}}, "l": {"NS": ["3", "4.5"]}},
        {"id": {"N": "3"}, "m": {"S": "not a map"}, "l": {"L": []}},
        {"id": {"M": {}}, "m": {"NULL": True}},
        {"id": {"N": "9.50"}}])
    got = read_typed_items(spark, path, {"id": "N", "m": "M", "l": "L"},
                           cast={"id": "int", "m": "struct<q:bigint,deep:map<string,int>>", "l": "array<int>"}, misfits="bad").collect()
    assert sorted((r["id"], sorted(r["bad"])) for r in got if r["id"]) == [
        (1, ["l[1]", "l[2]", "l[3]", "m.deep{b}"]), (2, ["l[1]", "m.q"]), (3, ["m"])]
    assert sorted(r["bad"] for r in got if r["id"] is None) == [["id"], ["id"]]
    one = next(r for r in got if r["id"] == 1)
    assert one["l"] == [1, None, None, None] and one["m"]["deep"] == {"a": 1, "b": None}


def test_what_is_discovered_decodes_without_loss(spark, tmp_base):
    from tessera.sources.items import discover_items, propose_types, read_typed_items
    path = _items(spark, tmp_base, [
        {"id": {"N": "1"}, "n": {"N": "12.50"}, "big": {"N": "1" * 30}, "huge": {"N": "1e60"}, "mix": {"S": "a"}, "odd": {"S": "a"}, "tags": {"SS": ["a"]},
         "m": {"M": {"q": {"N": "0.001"}, "in": {"M": {"x": {"BOOL": True}}}, "l": {"L": [{"N": "1"}, {"S": "b"}]}, "both": {"S": "s"}}}, "none": {"NULL": True}},
        {"id": {"N": "-20"}, "n": {"N": "-100000.1"}, "mix": {"N": "5"}, "odd": {"M": {"k": {"S": "v"}}}, "tags": {"L": [{"N": "1"}]},
         "m": {"M": {"q": {"N": "7"}, "both": {"L": []}}}, "keys": {"M": {f"k{i}": {"N": str(i)} for i in range(12)}}, "empty": {"M": {}},
         "lists": {"L": [{"L": [{"M": {"a": {"N": "1"}}}]}, {"L": []}]}}])
    found = discover_items(spark, path, max_fields=10)
    counted = {("/".join(r["path"]), r["code"]): r["n"] for r in found.collect()}
    assert counted[("m/in/x", "BOOL")] == 1 and counted[("keys/{}", "N")] == 12 and counted[("lists/[]/[]/a", "N")] == 1
    assert counted[("m/l/[]", "N")] == counted[("m/l/[]", "S")] == 1 and counted[("lists/[]", "L")] == 2
    attributes, cast = propose_types(found)
    ddl = {k: v.simpleString() for k, v in cast.items()}
    assert ddl["id"] == "bigint" and ddl["n"] == "decimal(7,1)" and ddl["big"] == "decimal(30,0)" and ddl["huge"] == "string" and ddl["mix"] == "string"
    assert ddl["tags"] == "array<string>" and ddl["keys"] == "map<string,bigint>" and ddl["empty"] == "map<string,string>"
    assert ddl["m"] == "struct<both:string,in:struct<x:boolean>,l:array<string>,q:decimal(4,3)>" and ddl["lists"] == "array<array<struct<a:bigint>>>"
    assert attributes["odd"] == "JSON" and attributes["none"] == "NULL"
    rows = read_typed_items(spark, path, attributes, cast, misfits="bad").orderBy("id").collect()
    assert [r["bad"] for r in rows] == [[], []]
    assert rows[1]["m"]["both"] == '{"S": "s"}' and rows[0]["odd"] == '{"M": {"k": {"S": "v"}}}' and rows[0]["keys"]["k11"] == 11
    assert str(rows[1]["n"]) == "12.5" and rows[1]["m"]["l"] == ["1", "b"] and rows[1]["huge"] == "1e60"


def test_nothing_to_discover(spark, tmp_base):
    from tessera.sources.items import discover_items, propose_types
    spark.createDataFrame([("",), ("{}",), ('{"Item":{}}',)], "value string").write.text(tmp_base)
    found = discover_items(spark, tmp_base)
    assert found.count() == 0 and propose_types(found) == ({}, {})


def test_only_maps_and_lists_are_written_between_levels(spark, tmp_base, monkeypatch):
    from tessera.sources import items
    written, fresh = [], items.scratch_path

    def noted(spark, name):
        written.append(fresh(spark, name))
        return written[-1]
    monkeypatch.setattr(items, "scratch_path", noted)
    lines = ['{"Item":{"id":{"N":"-7"},"m":{"M":{"k%d":{"M":{"x":{"N":"%d.50"}}},"n":{"NS":["1","2"]}}},"l":{"L":[{"S":"a"},{"L":[{"N":null}]}]}}}' % (k, k)
             for k in range(4)] + ['{"Item":{"id":{"S":"x"}}}', "not json", '{"Item":null}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(tmp_base)
    found = {(".".join(r["path"]), r["code"]): tuple(r)[2:] for r in items.discover_items(spark, tmp_base, max_fields=3).collect()}
    assert found == {("id", "N"): (4, 1, 0, True), ("id", "S"): (1, 0, 0, True), ("m", "M"): (4, 0, 0, True),
                     ("l", "L"): (4, 0, 0, True), ("m.{}", "M"): (4, 0, 0, True), ("m.{}", "NS"): (4, 0, 0, False),
                     ("l.[]", "S"): (4, 0, 0, True), ("l.[]", "L"): (4, 0, 0, True), ("m.{}.x", "N"): (4, 1, 1, True),
                     ("l.[].[]", "N"): (4, 0, 0, True)}
    staged = [spark.read.parquet(p) for p in written if "discover-level" in p]
    assert [sorted(r["code"] for r in s.select("code").distinct().collect()) for s in staged] == [["L", "M"], ["L", "M"]]
