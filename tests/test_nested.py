import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirefold.operators import nested as N
from quirefold.sources.loose_json import loads

PAGE = {"page_Id": 1, "page_dict": {"level": [1, 5, 5], "conf": [-1, 90, 40.5], "text": ["", "a \"b\"", "c"], "left": [1, 2, 3]}, "image_meta": {"canonical": {"stage": "s", "width_px": 10}, "render_raw": None}}


def test_loose_json():
    assert loads('{"a":[1,2,],}') == {"a": [1, 2]}
    assert loads('{"t":["10"x4","b","c"]}') == {"t": ['10"x4', "b", "c"]}
    assert loads('{"t":["a\\"b", "c"]}') == {"t": ['a"b', "c"]}
    for bad in (None, "", " ", '{"a":[1,2', '{"a":"b', "nonsense", '{"a": [1,'):
        assert loads(bad) is None
    assert loads('{"a":"x, y","b":"]}"}') == {"a": "x, y", "b": "]}"}


def test_variants_of_raw_ocr(spark):
    bare = PAGE["page_dict"]
    rows = [
        (1, json.dumps({"1": PAGE, "page_2": bare})), (2, json.dumps([PAGE, {"page_num": 7, "page_dict": {"conf": [1], "text": []}}, "junk"])), (3, None), (4, '{"1":{"page_dict":{"conf":[90'), (5, json.dumps({"x": {"page_dict": None, "conf": None}})),
        (6, json.dumps({"1": {"page_dict": {"conf": ["88", None, "z"], "text": ["a", 5, None]}}})), (7, json.dumps([{"page_dict": {"page_num": [4, 4], "conf": [5], "text": ["q"]}}])), (1, json.dumps({"1": PAGE, "page_2": bare})),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "rec_id long, raw_json string, page_pos string")
    records = N.read_pages(N.once(df, "rec_id"))
    assert {r.rec_id for r in records.filter("pages is null").collect()} == {3, 4}
    got = {(r.rec_id, r.page_key): r.page_id for r in N.pages_of_records(records).collect()}
    assert got == {(1, "1"): 1, (1, "page_2"): None, (2, "1"): 1, (2, "7"): None, (5, "x"): None, (6, "1"): None, (7, "4"): None}
    words = {(r.rec_id, r.page_key, r.word_pos): (r.conf, r.text, r.left) for r in N.words_of(records).collect()}
    assert words[1, "1", 1] == (90.0, 'a "b"', 2) and words[2, "7", 0] == (1.0, None, None) and not any(k[0] == 5 for k in words)
    assert [words[6, "1", i][:2] for i in range(3)] == [(88.0, "a"), (None, "5"), (None, None)]
    stages = [(r.rec_id, r.page_pos, r.slot, r.stage, r.width_px) for r in N.stages_of(records).collect()]
    assert sorted(stages) == [(1, 0, "canonical", "s", 10), (2, 0, "canonical", "s", 10)]
    assert N.words_of(N.read_pages(df.limit(0))).count() == 0


def test_shredding(spark):
    point = T.StructType([T.StructField("x", T.IntegerType())])
    item = T.StructType([T.StructField("name", T.StringType()), T.StructField("subs", T.ArrayType(T.StructType([T.StructField("v", T.IntegerType())]))), T.StructField("one", T.StructType([T.StructField("deep", T.StringType())]))])
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("items", T.ArrayType(item)), T.StructField("a", point), T.StructField("b", point), T.StructField("tags", T.ArrayType(T.StringType()))])
    rows = [(1, [("n", [(1,), None, (3,)], ("d",)), None, ("m", None, None)], (5,), None, ["t"]), (2, None, None, None, None), (3, [], (1,), (2,), [])]
    t = N.shred(spark.createDataFrame(rows, schema), "id")
    assert set(t) == {"root", "root_items", "root_items_subs", "root_tags", "root_shared0"}
    assert [tuple(r) for r in t["root"].orderBy("id").collect()] == [(1,), (2,), (3,)]
    assert sorted(tuple(r) for r in t["root_tags"].collect()) == [(1, 0, "t")]
    assert sorted(tuple(r) for r in t["root_items"].collect()) == [(1, 0, "n", "d"), (1, 2, "m", None)]
    assert sorted(tuple(r) for r in t["root_items_subs"].collect()) == [(1, 0, 0, 1), (1, 0, 2, 3)]
    assert sorted(tuple(r) for r in t["root_shared0"].collect()) == [(1, "a", 5), (3, "a", 1), (3, "b", 2)]
    back = t["root_items"].join(t["root_items_subs"].groupBy("id", "items_pos").agg(F.count("*").alias("n")), ["id", "items_pos"], "left")
    assert {(r.items_pos, r.n) for r in back.collect()} == {(0, 2), (2, None)}


def test_maps_lists_of_lists_shared_structs_and_clashing_names(spark):
    part = "struct<w: int, marks: array<struct<m: string, at: array<int>>>>"
    schema = f"id long, m map<string, int>, ms map<string, struct<id: long, x: int>>, grid array<array<int>>, up {part}, down {part}, deep struct<side: {part}>, one struct<id: string>, p struct<a: array<int>, b: array<string>>"
    up, down = (1, [("q", [7, None, 9]), None]), (2, None)
    rows = [(1, {"k": 5, "n": None}, {"z": (8, 4)}, [[1, None], None, [], [3]], up, down, (up,), ("inner",), ([1, 2], ["x"])), (2, None, {}, None, None, None, None, None, (None, ["y"])), (3,) + (None,) * 8]
    t = N.shred(spark.createDataFrame(rows, schema), "id", parallel=["p"])
    got = {n: sorted((tuple(r) for r in d.collect()), key=repr) for n, d in t.items()}
    assert got["root"] == [(1, "inner"), (2, None), (3, None)] and t["root"].columns == ["id", "one_id"]
    assert got["root_m"] == [(1, "k", 5)]
    assert got["root_ms"] == [(1, "z", 8, 4)] and t["root_ms"].columns == ["id", "ms_key", "root_ms_id", "x"]
    assert got["root_grid"] == [(1, 0), (1, 2), (1, 3)] and got["root_grid_value"] == [(1, 0, 0, 1), (1, 3, 0, 3)]
    assert got["root_p"] == [(1, 0, 1, "x"), (1, 1, 2, None), (2, 0, None, "y")]
    shared = next(n for n in got if "shared" in n and n.count("_") == 1)
    assert got[shared] == [(1, "deep_side", 1), (1, "down", 2), (1, "up", 1)]
    assert got[f"{shared}_marks"] == [(1, "deep_side", 0, "q"), (1, "up", 0, "q")]
    assert got[f"{shared}_marks_at"] == [(1, "deep_side", 0, 0, 7), (1, "deep_side", 0, 2, 9), (1, "up", 0, 0, 7), (1, "up", 0, 2, 9)]
    assert set(N.shred(spark.createDataFrame(rows, schema), "id", only=["root_grid_value"])) == {"root_grid_value"}
