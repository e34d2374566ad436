import random

from pyspark.sql import functions as F

from quirefold.functions.stems import stem_key
from quirefold.llm import splits as S


def _union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}


def test_merge_labels_against_union_find(spark):
    rng = random.Random(3)
    edges = [(f"n{rng.randrange(300):03}", f"n{rng.randrange(300):03}") for _ in range(180)]
    edges += [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)] + [("zhub", f"a{i:02}") for i in range(20)]
    df = spark.createDataFrame(edges + [(None, "x"), ("y", None), ("z", "z")], "a string, b string")
    want = _union_find([e for e in edges if e[0] != e[1]])
    assert {r.node: r.comp for r in S.merge_labels(df).collect()} == want


def test_updates_keep_splits_and_quarantine_conflicts(spark):
    nodes = spark.createDataFrame([(f"d{i:03}",) for i in range(200)], "node string")
    sizes = nodes.withColumn("n", F.lit(5).cast("long"))
    configs = [{"config_id": 1, "val_ratio": 0.2, "test_ratio": 0.1, "seed": 4}, {"config_id": 2, "val_ratio": 0.1, "test_ratio": None, "seed": 4}]
    none = spark.createDataFrame([], "a string, b string")
    c1 = S.update_components(None, nodes, none)
    s1 = S.assign(c1, sizes, configs)
    by = {(r.config_id, r.split): r["count"] for r in s1.groupBy("config_id", "split").count().collect()}
    assert sum(by.values()) == 400 and abs(by[1, "validation"] - 40) <= 3 and abs(by[1, "test"] - 20) <= 3 and (2, "test") not in by
    was = {(r.node, r.config_id): r.split for r in s1.collect()}
    val = next(n for (n, c), s in was.items() if c == 1 and s == "validation")
    train = next(n for (n, c), s in was.items() if c == 1 and s == "train")
    c2 = S.update_components(c1, spark.createDataFrame([("new",)], "node string"), spark.createDataFrame([(val, train), (val, "new")], "a string, b string"))
    comp = {r.node: r.comp for r in c2.collect()}
    assert comp[val] == comp[train] == comp["new"] and len(set(comp.values())) == 199
    now = {(r.node, r.config_id): (r.split, r.quarantined) for r in S.assign(c2, sizes, configs, s1).collect()}
    assert all(now[k][0] == v for k, v in was.items())
    assert now[val, 1][1] and now[train, 1][1] and now["new", 1][1] and sum(q for (_, c), (_, q) in now.items() if c == 1) == 3


def test_large_component_and_empty(spark):
    comps = spark.createDataFrame([("hot", "hot")] + [(f"s{i}", f"s{i}") for i in range(100)], "node string, comp string")
    sizes = spark.createDataFrame([("hot", 50)] + [(f"s{i}", 1) for i in range(100)], "node string, n long")
    got = S.assign(comps, sizes, [{"config_id": 1, "val_ratio": 0.2, "test_ratio": 0.2, "seed": 1}])
    n = {r.split: r.n for r in got.join(sizes, "node").groupBy("split").agg(F.sum("n").alias("n")).collect()}
    assert n["validation"] == 30 and n["test"] == 30 and n["train"] == 90
    assert S.assign(comps.limit(0), sizes.limit(0), [{"config_id": 1, "val_ratio": 0.2, "test_ratio": None, "seed": None}]).count() == 0


def test_stem_spellings(spark):
    same = ["Dal_Pump_Manual_1020.pdf", "dal--pump-manual-1020", "DAL PUMP MANUAL 1020 copy 2", "dal-pump-manual-1020 (2)", "dal_pump_manual_1020_scan", "Dal- Pump Manual 1020_1", "dal-pump-manual-1020-copy"]
    other = ["dal-pump-manual-1020-annex-b", "dal-pump-manual-102", "report-12"]
    df = spark.createDataFrame([(x,) for x in [*same, *other, None, " "]], "s string").select("s", stem_key(F.col("s")).alias("k"))
    got = {r.s: r.k for r in df.collect()}
    assert {got[x] for x in same} == {"dal-pump-manual-1020"}
    assert [got[x] for x in other] == other and got[None] is None and got[" "] is None


def test_nulls_repeats_and_extra_columns(spark):
    nodes = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2), (None, 3)], "node string, comp int")
    ties = spark.createDataFrame([("a", "b", "x"), ("b", "a", "x"), ("a", "b", None), (None, "a", "x"), ("b", "b", "x")], "a string, b string, now string")
    got = sorted((r.node, r.comp) for r in S.update_components(None, nodes, ties).collect())
    assert got == [("a", "a"), ("b", "a")]
    stems = spark.createDataFrame([("A", "a"), ("B", "b"), ("C", "c"), ("D", None), ("c2", "c")], "stem string, node string")
    pairs = sorted(tuple(r) for r in S.shared_pairs(stems, S.update_components(None, nodes, ties)).collect())
    assert pairs == [("A", "B"), ("C", "c2")]
    assert S.update_components(None, nodes.limit(0), ties.limit(0)).count() == 0


def test_store_keeps_versions(spark, tmp_path):
    store = S.Store(spark, f"file://{tmp_path}/components")
    assert store.load() is None
    none = spark.createDataFrame([], "a string, b string")
    c = store.save(S.update_components(store.load(), spark.createDataFrame([("a",), ("b",)], "node string"), none))
    assert store.versions() == [1] and c.count() == 2
    store.save(S.update_components(store.load(), spark.createDataFrame([("c",)], "node string"), spark.createDataFrame([("b", "c")], "a string, b string")))
    (tmp_path / "components" / "v000003").mkdir()  # a run that failed
    again = S.Store(spark, f"file://{tmp_path}/components")  # another run
    assert again.versions() == [1, 2] and sorted((r.node, r.comp) for r in again.load().collect()) == [("a", "a"), ("b", "b"), ("c", "b")]
    stems = spark.createDataFrame([("A", "a"), ("B", "b"), ("C", "c"), ("C2", "c"), ("X", None)], "stem string, node string")
    assert sorted(tuple(r) for r in S.component_stems(stems, again.load()).collect()) == [("A", "a", 0), ("B", "b", 2), ("C", "b", 2), ("C2", "b", 2)]


def test_configs(spark, tmp_path, monkeypatch):
    import pytest

    spark.createDataFrame([(1, 0.1, None, 5), (2, float("nan"), 0.1, 5), (1, 0.1, None, 5), (None, 0.1, 0.1, 5)], "config_id int, val_ratio double, test_ratio double, seed int").write.parquet(str(tmp_path / "c"))
    assert [(c["config_id"], c["val_ratio"]) for c in S.configs_of(spark, str(tmp_path / "c"))] == [(1, 0.1), (2, None)]
    monkeypatch.setattr(S, "MAX_CONFIGS", 1)
    with pytest.raises(ValueError):
        S.configs_of(spark, str(tmp_path / "c"))
