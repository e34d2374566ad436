from pyspark.sql import functions as F

from quirefold.operators import assorted as A
from quirefold.operators import earlier as EA
from quirefold.operators import evaluation as E
from quirefold.operators import model as M
from quirefold.operators import render as R
from quirefold.sources import files as S

SECTIONS = "doc long, seq long, section_number string"


def test_word_stream(spark):
    text = "intro here 1.1 First title body of\nit see Fig 2.2 on 2. Next"
    rows = [("d", 1, i * 100 + j, i, w) for i, line in enumerate(text.split("\n")) for j, w in enumerate([*line.split(), ""])]
    got = {r.ord: (r.number, r.title, r.content) for r in EA.word_stream(spark.createDataFrame(rows, "doc string, page int, word_idx int, line_num int, text string")).collect()}
    assert got == {0: (None, "", "intro here"), 1: ("1.1", "First title", "body of\nit see Fig 2.2 on"), 2: ("2.", "Next", "")}


def test_lists_and_chains(spark):
    nums = ["1", "2", "2.1", "3.1", "1", "2", "3", "3.2", "4", "5", "3.3", "4", "4.1", None]
    df = spark.createDataFrame([(1, i, n) for i, n in enumerate(nums)], SECTIONS)
    assert sorted((r.seq, r.run) for r in EA.list_runs(df).collect()) == [(4, 0), (5, 0), (6, 0)]
    assert sorted(r.seq for r in EA.false_chains(df).collect()) == [8, 9]
    assert EA.list_runs(df.limit(0)).count() == 0 and EA.false_chains(df.limit(0)).count() == 0


def test_names_and_captions(spark):
    df = spark.createDataFrame([("Doc A_table_page_3_12",), ("doc-p4",), ("p5_tab_7",), (None,)], "s string")
    got = [r.k and tuple(r.k) for r in df.select(A.table_key(F.col("s")).alias("k")).collect()]
    assert got == [("doc_a", 3, 12), None, ("unknown_doc", 5, 7), None]
    df = spark.createDataFrame([(" ", None, "c"), ("a ", "b", "c"), (None, None, None)], "a string, b string, c string")
    assert [r.o for r in df.select(A.caption(F.col("a"), F.col("b"), F.col("c")).alias("o")).collect()] == ["c", "a", ""]
    df = spark.createDataFrame([([["a"], None, ["b", None, "d"]],)], "r array<array<string>>")
    assert df.select(A.rectangular(F.col("r"), F.lit(2)).alias("o")).first().o == [["a", ""], ["", ""], ["b", ""]]


def test_balancing_and_splits(spark):
    df = spark.createDataFrame([(i, i % 2, i % 10 == 0) for i in range(400)], "sample long, class_id int, is_positive boolean")
    n = {(r.class_id, r.is_positive): r["count"] for r in A.balanced(df, 2.0).groupBy("class_id", "is_positive").count().collect()}
    assert n == {(0, True): 40, (0, False): 80}
    s = A.hash_split(df, "sample").groupBy("split").count().collect()
    assert sum(r["count"] for r in s) == 400 and 50 < {r.split: r["count"] for r in s}["val"] < 110
    assert A.presence(df, df.filter("sample < 390"), "sample").count() == 10


def test_pages_stems_and_sources(spark):
    t = spark.createDataFrame([("a", 1, "AMBIGUOUS"), ("a", 2, "TABLE_OF_CONTENTS"), ("b", 1, "TITLE_PAGE"), ("b", 2, "TITLE_PAGE"), ("b", 3, "CONTENT_BODY"), ("c", 1, "TABLE_OF_CONTENTS"), ("c", 2, "AMBIGUOUS")], "doc string, page int, page_type string")
    got = sorted(tuple(r) for r in A.toc_pages(t, spark.createDataFrame([("b", 3)], "doc string, start int")).collect())
    assert got == [("a", 1), ("a", 2), ("b", 2), ("c", 1)]
    r = A.resolve_stems(spark.createDataFrame([("A b",), ("x",), ("c",)], "stem string"), spark.createDataFrame([("a_b",), ("c",)], "stem string"))
    assert {(x.stem, x.found, x.how) for x in r.collect()} == {("A b", "a_b", "normalised"), ("c", "c", "exact"), ("x", None, None)}
    p = A.source_precedence(spark.createDataFrame([(1, None), (2, "own"), (3, "")], "table_key int, caption string"), spark.createDataFrame([(1, "j1"), (2, "j2")], "table_key int, json_caption string"), spark.createDataFrame([(1,)], "table_key int"))
    assert {tuple(x) for x in p.collect()} == {(1, "j1", "excel"), (2, "own", "json"), (3, None, "image")}


def test_more(spark, tmp_path):
    box = "image string, class_id int, det_id long, x1 double, y1 double, x2 double, y2 double"
    d = E.dedup(spark.createDataFrame([("i", 1, 2, 0.0, 0.0, 10.0, 9.5), ("i", 1, 1, 0.0, 0.0, 10.0, 10.0), ("i", 2, 3, 0.0, 0.0, 10.0, 10.0)], box))
    assert {r.det_id for r in d.collect()} == {1, 3}
    x = spark.range(200).withColumn("a", F.col("id") % 10).withColumn("b", F.rand(1)).withColumn("label", (F.col("a") > 4).cast("int"))
    imp = {r.feature: r for r in M.importances(x, ["a", "b"]).collect()}
    assert imp["a"].boosted > imp["b"].boosted and imp["a"].forest > imp["b"].forest
    t = spark.createDataFrame([("t", ["x", None], [["1", None]]), ("u", [], None)], "table_key string, columns array<string>, rows array<array<string>>")
    got = {r.table_key: [(c.is_header, c.cells) for c in r.rows] for r in R.from_names(t).collect()}
    assert got == {"t": [(True, ["x", ""]), (False, ["1", ""])], "u": []}
    (tmp_path / "f.csv").write_text("_doc,num,a\nd,1.10,2\n")
    f = S.feature_csv(spark, str(tmp_path / "f.csv"), "_doc string, num string, a double", ["num"])
    assert f.first().num == "1.10"
    c = S.classification_or_default(spark.createDataFrame([("a",), ("b",)], "doc string"), spark.createDataFrame([("a", 3, "standard")], "doc string, start int, document_type string"))
    assert {tuple(r) for r in c.collect()} == {("a", 3, "standard"), ("b", 1, "unknown")}
    ranked = A.rank_features(spark.createDataFrame([("a", 0.5, 0.2, 1.0), ("b", 0.25, 0.2, 1.0), ("flat", 0.9, 0.9, 0.0), ("none", 0.01, 0.001, 1.0)], "feature string, corr double, mi double, variance double"))
    assert [(r.feature, r.score) for r in ranked.orderBy("rank").collect()] == [("a", 1.0), ("b", 0.75)]
