import datetime
import random

from pyspark.sql import functions as F

from quirefold.operators import features as FE
from quirefold.operators import plugins as U
from quirefold.operators import render as R
from quirefold.operators import repair as RP
from quirefold.operators.grouped import fold_groups
from quirefold.plans import views as V

SECTIONS = "doc long, seq long, section_number string, topic string, page int, x_left int, y_top int, w int, h int"


def _sections(spark, rows):
    return spark.createDataFrame([(d, i, n, t, 1 + i // 3, 100, 100 * i, 50, 20) for d, items in rows.items() for i, (n, t) in enumerate(items)], SECTIONS)


def test_feature_table(spark):
    df = _sections(spark, {1: [("1", "Scope"), ("1.1", "THE PUMPS"), ("1,2", "May 2024"), (None, None), ("", " "), ("99.5", "x" * 600)], 2: [("7", "...")]})
    toc = spark.createDataFrame([(1, "1.1")], "doc long, num string")
    got = {(r.doc, r.seq): r for r in FE.section_features(df, toc, 1000.0, 1000.0).collect()}
    assert len(got) == 7 and len(got[1, 0]) == 2 + 17 + 162 and all(v is not None for r in got.values() for v in r)
    row = df.filter("doc = 1 and seq = 5").withColumn("leading_whitespace", F.lit(2)).withColumn("text_before_number", F.lit("See para ")).withColumn("conf_mean", F.lit(40.0)).withColumn("n_low", F.lit(3)).withColumn("n_words", F.lit(4)).withColumn("h", F.lit(90)).withColumn("seq", F.lit(9).cast("long"))
    more = df.filter("doc = 1").unionByName(row, allowMissingColumns=True)
    lang = spark.createDataFrame([(1, 9, 1, 7)], "doc long, seq long, lang_has_modal int, lang_word_count int")
    b = {r.seq: r for r in FE.section_features(more, toc, 1000.0, 1000.0, lang).filter("doc = 1").collect()}
    assert b[9].had_text_before_number == 1 and b[9].text_before_number_len == 9 and b[9].text_before_is_reference == 1 and b[9].leading_whitespace_len == 2 and b[0].had_leading_whitespace == 0
    assert b[9].ocr_mostly_low_conf == 1 and b[9].ocr_conf_below_50 == 1 and b[9].ocr_conf_below_30 == 0 and b[0].ocr_conf_below_30 == 1 and b[9].relative_height == 4.5 and b[9].height_is_very_tall == 1 and b[0].height_is_multiline == 0
    assert b[9].lang_has_modal == 1 and b[0].lang_has_modal == 0 and b[9].combined_confidence == 0.0 and b[3].section_major == -1 and b[3].section_num_length_to_depth_ratio == 0 and b[0].max_subsection_value == 0
    a = got[1, 1]
    assert a.in_toc_exact == 1 and a.is_logical_next == 1 and a.parent_exists == 1 and a.title_is_all_caps == 1 and a.title_starts_with_article == 1 and a.vertical_gap_from_prev_px == 80
    assert got[1, 2].looks_like_date == 1 and got[1, 2].section_depth == 2 and got[1, 4].title_is_whitespace_only == 1 and got[1, 5].title_absurdly_long == 1 and got[2, 0].title_is_punctuation_only == 1
    assert FE.section_features(df.limit(0), toc, 1000.0, 1000.0).count() == 0


def test_confidences(spark):
    rows = [("3.1.2.1", "Scope"), ("4", "The numbers in parenthesis refer to the list (see 4.2) below"), ("2", None), (None, "x"), ("A.B", "y")]
    df = _sections(spark, {1: rows}).withColumn("p", RP.legacy_parts(F.col("section_number")))
    got = [(r.t, r.s) for r in df.select("seq", RP.title_confidence(F.col("topic")).alias("t"), RP.section_confidence(F.col("p"), F.col("topic")).alias("s")).orderBy("seq").collect()]
    assert got[0][0] == 1.0 and got[0][1] > 0.96 and got[1][0] == 0.1 and got[1][1] == 0.2 and got[2][0] == 1.0 and got[3][1] == 0.0 and got[4][1] == 0.0


def test_tracker(spark):
    nums = ["1", "1.1", "2", "2.1", "3.1", "3.2", "1", "9.1", "60.1", "3.3", "4"]
    df = _sections(spark, {1: [(n, "Scope") for n in nums], 2: []})
    got = {r.seq: r.violation for r in RP.violations(df).collect()}
    assert got[6] == "suspicious_reset" and got[8] == "unrealistic_number" and 3 not in got and 5 not in got
    assert RP.violations(df.limit(0)).count() == 0
    e = df.withColumn("type", F.lit("section")).withColumn("content", F.lit("body")).withColumn("text", F.lit(None).cast("string"))
    d = {r.seq: r for r in RP.demote(e, RP.violations(df), spark.createDataFrame([(1, "60.1")], "doc long, num string")).collect()}
    assert d[6].text == "1 Scope body" and d[6].demoted_from == "1" and d[8].type == "section" and d[0].type == "section"


def test_render(spark):
    schema = "doc string, seq int, type string, section_number string, topic string, content string, caption string"
    rows = [("d", 0, "section", "1.2", "1.2. the scope of it", "one\n\n two ", None), ("d", 1, "figure", None, None, None, "A pump"), ("d", 2, "figure", None, None, None, " "), ("d", 3, "section", "1.1.1.1.1.1.1.1.1.1", "x", None, None)]
    got = [(r.kind, r.level, r.text) for r in R.plan(spark.createDataFrame(rows, schema)).orderBy("place").collect()]
    assert got == [("heading", 2, "1.2 The Scope of It"), ("text", None, "one"), ("text", None, "two"), ("caption", None, "Figure 1. A pump"), ("caption", None, "Figure 2"), ("heading", 9, "1.1.1.1.1.1.1.1.1.1 X")]
    cols = spark.createDataFrame([("t", 0, 1000, None), ("t", 1, None, 30.3), ("t", 2, None, None), ("t", 3, None, None), ("u", 0, None, None)], "table_key string, col int, width_dxa int, width_pct double")
    w = {(r.table_key, r.col): r.width for r in R.column_widths(cols).collect()}
    assert sum(v for (k, _), v in w.items() if k == "t") == 9360 and w["u", 0] == 9360 and abs(w["t", 2] - w["t", 3]) <= 1 and w["t", 0] == 1000


def test_json_in_answers(spark):
    assert U.extract_json('x ```json\n{"a": [1]}\n``` y') == {"a": [1]} and U.extract_json('say {"a": "}"} end') == {"a": "}"} and U.extract_json("[1, 2] it is") == [1, 2]
    assert U.extract_json('{"a": 1,}') == {"a": 1} and U.extract_json("none") is None and U.extract_json(None) is None and U.extract_json('{"a": [1') is None
    df = spark.createDataFrame([(1, "abc"), (2, None), (3, "boom")], "k int, t string")

    def call(t):
        if t == "boom":
            raise ValueError
        return t.upper()

    assert {r.k: r.o for r in U.model_column(df, "t", "o", call).collect()} == {1: "ABC", 2: None, 3: None}
    types = spark.createDataFrame([("d", 1, None), ("d", 2, "CONTENT_BODY")], "doc string, page int, page_type string")
    pages = spark.createDataFrame([("d", 1, "text"), ("d", 2, "text")], "doc string, page int, page_text string")
    assert {(r.page, r.page_type, r.method) for r in U.resolve_open_pages(types, pages).collect()} == {(1, "AMBIGUOUS", "model"), (2, "CONTENT_BODY", "fast")}


def test_folds_see_whole_groups_in_order(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(40), rng.random()) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k int, v double")
    got = {r.k: (r.n, r.first) for r in fold_groups(df, ["k"], ["v"], lambda key, rs: [(key[0], len(rs), rs[0][0])], "k int, n int, first double", flush=7).collect()}
    assert got == {k: (sum(a == k for a, _ in rows), min(v for a, v in rows if a == k)) for k in {a for a, _ in rows}}


def test_feature_table_goes_by_document_once(spark):
    df = _sections(spark, {1: [("1", "Scope"), ("1.1", "Pumps"), ("1.1.4", "Oil"), ("2.a", "Seals"), (None, None), ("1", "Scope")], 2: [("7", "..."), ("7.3.1", "x")], 3: [("1", "a"), ("1.1", "b")]})
    toc = spark.createDataFrame([(1, "1.1.2"), (1, "2"), (2, "7.3"), (4, "1")], "doc long, num string")
    x = FE.section_features(df, toc, 1000.0, 1000.0)
    plan = x._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan  # shuffles were dozens, and filled the disk
    got = {(r.doc, r.seq): (r.parent_exists, r.in_toc_exact, r.toc_fuzzy_score, r.parent_in_toc) for r in x.collect()}
    assert got == {(1, 0): (0, 0, 0.4, 0), (1, 1): (1, 0, 0.8, 0), (1, 2): (1, 0, 0.8, 0), (1, 3): (0, 0, 0.4, 1), (1, 4): (0, 0, 0.5, 0), (1, 5): (0, 0, 0.4, 0), (2, 0): (0, 0, 0.4, 0), (2, 1): (0, 0, 0.8, 1), (3, 0): (0, 0, 0.5, 0), (3, 1): (1, 0, 0.5, 0)}
    named = F.col("num") == "1.1"
    a, b = FE.section_features(df, named, 1000.0, 1000.0), FE.section_features(df, spark.createDataFrame([(1, "1.1"), (3, "1.1")], "doc long, num string"), 1000.0, 1000.0)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_sections_are_shuffled_without_names(spark, tmp_path):
    kinds = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp"
    day = datetime.datetime(2024, 1, 1)
    lines = [(k, 1 + k % 3, k % 5, k % 7, float(k % 4), float(k), day) for k in (-3, 0, 5, 15, 16, 31, 2**40, 2**40 + 1)] + [(5, 3, 0, 5, 1.0, p, None) for p in (9.5, 9.25, None)] + [(None, 1, 1, 1, 1.0, 1.0, day), (7, 1, None, 1, 1.0, 1.0, day)]
    spark.createDataFrame(lines, kinds).write.parquet(f"{tmp_path}/lineitem.parquet")
    shuffled = lambda x: x._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning")[1].split("BroadcastExchange")[0]
    for parts in ([(0, "a"), (1, "b"), (2, None), (4, "d"), (None, "e")], [(0, "a"), (0, "z"), (1, "b")]):
        spark.createDataFrame(parts, "p_partkey long, p_name string").write.mode("overwrite").parquet(f"{tmp_path}/part.parquet")
        x = V.sections(spark, str(tmp_path), 2)
        unique = len(parts) == 5
        assert "p_name" not in shuffled(x) and ("l_extendedprice" in shuffled(x)) != unique  # names and columns that decide nothing filled the disk
        if unique:
            assert sorted(map(str, x.collect())) == sorted(map(str, V.sections(spark, str(tmp_path)).collect()))
        else:
            by_price = [r.topic for r in x.filter("doc = 0 and section_number = '3'").orderBy("seq").collect()]
            assert [sorted(by_price[i:i + 2]) for i in range(0, len(by_price), 2)] == [["a", "z"]] * (len(by_price) // 2)
