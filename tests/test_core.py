import random
import statistics

from pyspark.sql import functions as F

from quirefold.functions import numbers as N
from quirefold.functions import text as T
from quirefold.operators import assets as A
from quirefold.operators import evaluation as E
from quirefold.operators import lines as L
from quirefold.operators import model as M
from quirefold.operators import pages as P
from quirefold.operators import sequence as Q
from quirefold.operators import tables as TB


def _col(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {kind}")
    return [r.o for r in df.select("i", expr(F.col("s")).alias("o")).orderBy("i").collect()]


def test_numbers(spark):
    assert _col(spark, ["1,2-3", "1..2", "1-2-3", None, ""], N.normalise) == ["1.2.3", "1.2", "1.2.3", None, ""]
    assert _col(spark, ["3.1.2", "1", "3.A", "10.2.1", "", None, ".1.", "2.abc.3", "x1"], N.parse) == [["3", "1", "2"], ["1"], ["3", "A"], ["10", "2", "1"], [], [], ["1"], ["2"], []]
    assert _col(spark, ["1", "31", "3.51", "3.A", "A", "", "3.AB"], N.valid_strict) == [True, False, False, True, False, False, False]
    assert _col(spark, ["1", "3.999", "3.1000", "3.AB"], N.valid_greedy) == [False, True, False, True]
    assert _col(spark, ["4.88", "1.05", "1.10", "2.50", "1.2.99"], N.decimal_classify) == [True, True, False, True, False]
    assert _col(spark, ["4.25", "4.49", "12.50", "3.10"], N.decimal_greedy) == [True, False, True, False]
    assert _col(spark, ["IV", "xxxix", "IIX", "XL", ""], N.roman_to_int) == [4, 39, None, None, None]
    df = spark.createDataFrame([("1.1", "1.2"), ("1.1", "1.1.1"), ("1.1.9", "1.2"), ("1.1", "1.3"), ("1", "2"), ("", "1"), ("1.A", "1.B")], "a string, b string")
    assert [r.o for r in df.select(N.logical_next(N.parse(F.col("a")), N.parse(F.col("b"))).alias("o")).collect()] == [True, True, True, False, True, False, False]


def test_headings(spark):
    cases = {
        "1. Scope": (True, "1", "Scope", "", None), "1.Scope and so": (True, "1", "Scope and so", "", None), "IV.3 Title -- the rest": (True, "4.3", "Title", "the rest", None), ". 1.2 Pumps. They run": (True, "1.2", "Pumps.", "They run", None),
        "A.1 Annex": (True, "A.1", "Annex", "", None), "5.0 GHz": (False, None, None, None, "unit_measurement"), "5 V": (False, None, None, None, "unit_measurement"), "1.1.2 and 1.3": (False, None, None, None, "cross_reference"),
        "3 May day": (False, None, None, None, "contains_month"), "plain text": (False, None, None, None, "no_regex_match"), "0.0 Zero": (False, None, None, None, "zero_section"), "95 Big": (False, None, None, None, "major_section_too_large"),
        "7": (False, None, None, None, "empty_topic"), "2 a b c d e f g h i j k l m": (False, None, None, None, "topic_too_long"), "": (False, None, None, None, "no_regex_match"), "3 ...": (False, None, None, None, "numbers_and_punctuation_only"),
    }
    got = _col(spark, [*cases, None], T.heading)
    assert [tuple(x) for x in got] == [*cases.values(), (False, None, None, None, "no_regex_match")]


def test_text(spark):
    assert _col(spark, ["the USA of a1b and me", ""], T.initial_caps) == ["The USA of a1b and Me", ""]
    assert _col(spark, ["Page 12 of 3!", "É_x"], T.repeat_signature) == ["page # of #", "é_x"]
    assert _col(spark, [None, " ", "Introduction", "x" * 120], T.title_quality) == [0.0, 0.0, 1.0, 0.4]


def _words(rng, n):
    out, idx = [], 0
    for page in (1, 2):
        for _ in range(n):
            out.append(("d", page, idx, rng.randrange(2), rng.randrange(2), rng.randrange(3), rng.randrange(900), rng.randrange(3000), rng.randrange(50), rng.randrange(40), rng.choice([-1, 10, 55, 93]), rng.choice(["a", "bb", "", None]), "extra"))
            idx += 1
    return out


WORDS = "doc string, page int, word_idx int, block_num int, par_num int, line_num int, `left` int, top int, width int, height int, conf int, text string, line_seq string"


def test_lines_against_a_plain_model(spark):
    rows = _words(random.Random(2), 40)
    want, last = {}, None
    for r in rows:
        key = (r[1], r[3], r[4], r[5])
        if key != last:
            seq = 0 if last is None or last[0] != r[1] else seq + 1
            want[r[1], seq] = []
            last = key
        want[r[1], seq].append(r)
    got = {(r.page, r.line_seq): r for r in L.lines(spark.createDataFrame(rows, WORDS)).collect()}
    assert set(got) == set(want)
    for k, ws in want.items():
        g = got[k]
        assert g.text == " ".join(w[11] or "" for w in ws) and g.n_words == len(ws) and g.left == min(w[6] for w in ws) and g.bottom == max(w[7] + w[9] for w in ws)
        conf = [w[10] for w in ws if w[10] >= 0]
        assert g.conf_mean == (round(statistics.fmean(conf), 1) if conf else None) and g.n_low == sum(c < 50 for c in conf)
    assert L.lines(spark.createDataFrame([], WORDS)).count() == 0


def test_sequence_scores(spark):
    nums = ["1", "1.1", "1.2", "2", "9", None]
    df = spark.createDataFrame([("d", i, n, "Scope of it", 1, 10 * i, 100 * i, 5, 20) for i, n in enumerate(nums)] + [("e", 0, "5", None, 1, 1, 1, 1, 1)], "doc string, seq int, section_number string, topic string, page int, x_left int, y_top int, w int, h int")
    x = Q.parsed(df)
    assert [r.is_next for r in Q.neighbours(x).filter("doc = 'd'").orderBy("seq").collect()] == [0, 1, 1, 1, 0, 0]
    fit = [r.fit_score for r in Q.fit_score(x).filter("doc = 'd'").orderBy("seq").collect()]
    assert fit == [1.0, 0.8, 1.0, 1.0, 0.0, 0.0]  # at the end a jump by seven and an unparseable number, far from the depth before
    ext = {r.doc: r.extended_score for r in Q.extended_score(x).filter("seq = 0").collect()}
    assert ext == {"d": 0.75, "e": 0.5}
    assert [r.gap for r in Q.gap_features(x).filter("doc = 'd'").orderBy("seq").collect()] == [-1, 80, 80, 80, 80, 80]
    toc = spark.createDataFrame([("d", "1.1"), ("d", "2.3.4")], "doc string, num string")
    got = {(r.doc, r.seq): r.toc_score for r in Q.toc_fuzzy(x, toc).collect()}
    assert got["d", 1] == 1.0 and got["d", 2] == 0.4 and got["d", 3] == 0.4 and got["d", 4] == 0.1 and got["e", 0] == 0.5
    assert Q.format_score(x).count() == 7


def test_detection(spark):
    truth = spark.createDataFrame([("i", 1, 1, 0, 0, 10, 10), ("i", 1, 2, 20, 20, 30, 30)], "image string, class_id int, gt_id long, x1 double, y1 double, x2 double, y2 double".replace("double", "int"))
    truth = truth.select("image", "class_id", "gt_id", *[F.col(c).cast("double") for c in ("x1", "y1", "x2", "y2")])
    pred = spark.createDataFrame([("i", 1, 1, 0.0, 0.0, 10.0, 9.0, 0.9), ("i", 1, 2, 0.0, 0.0, 10.0, 10.0, 0.8), ("i", 1, 3, 21.0, 21.0, 31.0, 31.0, 0.7), ("j", 1, 4, 0.0, 0.0, 0.0, 0.0, 0.5)], "image string, class_id int, det_id long, x1 double, y1 double, x2 double, y2 double, conf double")
    m = {r.det_id: r.gt_id for r in E.greedy_match(pred, truth).collect()}
    assert m == {1: 1, 2: None, 3: 2, 4: None}
    total = [r for r in E.precision_recall(E.greedy_match(pred, truth), truth).collect() if r.class_id is None][0]
    assert (total.tp, total.fp, total.fn) == (2, 2, 0) and total.precision == 0.5 and total.recall == 1.0
    fused = {r.fused_id: r for r in E.fuse(pred.filter("image = 'i'"), 2).collect()}
    assert len(fused) == 2 and fused[0].n_fused == 2 and abs(fused[0].conf - 0.85) < 1e-9 and abs(fused[1].conf - 0.35) < 1e-9
    assert {r.det_id for r in E.suppress(pred).collect()} == {1, 3, 4}
    assert E.greedy_match(pred.limit(0), truth).count() == 0 and E.fuse(pred.limit(0), 1).count() == 0


def test_tables(spark):
    schema = "rec_id long, n_rows int, n_cols int, ord int, row int, col int, row_span int, col_span int, text string, alignment string, confidence double"
    rows = [(1, 2, 4, 0, 0, 0, 1, 2, "head", None, 1.0), (1, 2, 4, 1, 1, 0, 1, 1, "a", None, 1.0), (1, 2, 4, 2, 1, 0, 1, 1, "b", None, 1.0), (1, 2, 4, 3, 1, 3, 5, 5, None, None, 1.0), (1, 2, 4, 4, 9, 9, 1, 1, "out", None, None), (1, 2, 4, 5, None, 0, 1, 1, "no", None, None)]
    g = TB.grid(spark.createDataFrame(rows, schema))
    assert {(r.row, r.col, r.text) for r in g.collect()} == {(0, 0, "head"), (1, 0, "b"), (1, 3, "")}
    o = TB.occupied(g)
    assert {(r.row, r.col): (r.o_row, r.o_col) for r in o.collect()} == {(0, 0): (0, 0), (0, 1): (0, 0), (1, 0): (1, 0), (1, 3): (1, 3)}
    p = TB.positions(g, o)
    assert p.count() == 8 and {r.kind: r["count"] for r in p.groupBy("kind").count().collect()} == {"content": 3, "covered": 1, "empty": 4}
    assert sorted((r.old_col, r.col, r.col_span) for r in TB.consolidate(g).collect()) == [(0, 0, 1), (0, 0, 2), (3, 2, 1)]
    t = TB.trim_bounds(g).first()
    assert (t.first_row, t.last_row, t.first_col, t.last_col) == (0, 1, 0, 0)
    assert abs(TB.widths(g).agg(F.sum("width_pct")).first()[0] - 100) < 1e-6


def test_html_tables():
    cap, rows = TB.html_rows("text <table><caption> A  b</caption><tr><th colspan=2>x<br>y</th></tr><tr><td rowspan='2'>1</td><td>2</td></tr><tr><td colspan=z>3</table>")
    assert cap == "A b" and rows[0] == [("x y", 1, 2, True)] and TB.html_rows("no") is None and TB.html_rows(None) is None
    assert TB.place_cells([[("a", 2, 1, False), ("b", 1, 1, False)], [("c", 1, 3, False)]]) == [(0, 0, 2, 1, "a", False), (0, 1, 1, 1, "b", False), (1, 1, 1, 3, "c", False)]
    clash = [[("a", 1, 1, False), ("b", 2, 1, False)], [("c", 1, 2, False)]]
    tall = [[("a", 2, 2, False), ("b", 1, 1, False)], [("c", 1, 2, False), ("d", 1, 1, False)], []]
    assert [x[:4] for x in TB.place_cells(tall, fill=True)] == [(0, 0, 2, 2), (0, 2, 1, 1), (1, 2, 1, 2), (1, 4, 1, 1), (0, 3, 1, 1), (0, 4, 1, 1), (2, 0, 1, 1), (2, 1, 1, 1), (2, 2, 1, 1), (2, 3, 1, 1), (2, 4, 1, 1)]
    cap, rows = TB.html_rows("<TABLE><tr><td>a &lt; b<!-- <td>x --><td COLSPAN = '2' data-rowspan=3>c</tr><tr></tr><tr><th><b>d</b>  e</table>")
    assert cap == "" and rows == [[("a < b", 1, 1, False), ("c", 1, 2, False)], [], [("d e", 1, 1, True)]]
    assert TB.place_cells(clash)[-1][:4] == (1, 0, 1, 1) and TB.place_cells(clash, shrink=False)[-1][:4] == (1, 0, 1, 1)


def test_listed_grid(spark):
    schema = "k long, rows array<array<struct<text: string, row_span: int, col_span: int, is_header: boolean>>>, cap string"
    rows = [(1, [[("a", 2, 1, True), ("b", 1, 1, None)], None, [(None, 0, None, None), None]], "C"), (2, None, "x"), (3, [], None)]
    df = spark.createDataFrame(rows, schema)
    got = sorted(tuple(r) for r in TB.listed_grid(df, "k", F.col("rows"), "cap").collect())
    assert got == [(1, "C", 0, 0, 2, 1, "a", True), (1, "C", 0, 1, 1, 1, "b", False), (1, "C", 1, 1, 1, 1, "", False), (1, "C", 2, 0, 1, 1, "", False), (1, "C", 2, 1, 1, 1, "", False)]


def test_pages(spark):
    toc = "TABLE OF CONTENTS\n" + "\n".join(f"{i}.{j} Some Title ....... {i * j}" for i in range(1, 4) for j in range(1, 4))
    prose = "the pump of the yard is in a box and " * 20
    rows = [("d", 1, toc), ("d", 2, prose), ("d", 3, "This page intentionally left blank"), ("d", 4, None), ("d", 5, "UNCLASSIFIED PROPRIETARY CONFIDENTIAL notice of the makers of it all")]
    got = {r.page: r.page_type for r in P.fast_type(spark.createDataFrame(rows, "doc string, page int, page_text string")).collect()}
    assert got == {1: "TABLE_OF_CONTENTS", 2: "CONTENT_BODY", 3: "BLANK_PAGE", 4: None, 5: "TITLE_PAGE"}
    t = lambda d, *k: [(d, i + 1, x) for i, x in enumerate(k)]
    seq = t("a", "CONTENT_BODY") + t("b", "TITLE_PAGE", "BLANK_PAGE", "CONTENT_BODY") + t("c", "TITLE_PAGE", "TABLE_OF_CONTENTS", "CONTENT_BODY") + t("e", "TITLE_PAGE", "TITLE_PAGE") + t("f", "BLANK_PAGE", "CONTENT_BODY")
    got = {r.doc: (r.start, r.document_type) for r in P.content_start(spark.createDataFrame(seq, "doc string, page int, page_type string")).collect()}
    assert got == {"a": (1, "no_title"), "b": (3, "no_toc"), "c": (3, "standard"), "e": (2, "unknown"), "f": (2, "standard")}


def test_model(spark):
    rng = random.Random(1)
    rows = [(float(rng.random()), float(rng.random()), float("nan"), None) for _ in range(300)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").withColumn("label", F.when(F.rand(1) < 0.8, (F.col("a") > 0.5).cast("int")))
    s = M.train_and_predict(df, ["a", "b", "c", "d"], {"a": 1, "b": -1})
    right = s.filter("label is not null").agg(F.avg((F.col("keep").cast("int") == F.col("label")).cast("int"))).first()[0]
    assert right > 0.9 and s.count() == 300
    against = M.train_and_predict(df, ["a"], {"a": -1}).select("prob").distinct().count()
    assert against == 1  # the direction forbids what the data say
    assert M.train_and_predict(df.limit(5), ["a"]).select("prob").distinct().count() == 1
    assert _col(spark, ["1", "-1", "0", "2", "x", None], M.label) == [1, 0, 0, None, None, None]


def test_assets(spark):
    schema = "asset_key long, asset_id string, doc string, page_number int, asset_type string, confidence double, x1 double, y1 double, x2 double, y2 double, iw double, ih double"
    rows = [(1, "a", "d", 1, "fig", 0.5, 0.0, 0.0, 100.0, 100.0, 1000.0, 1000.0), (2, "b", "d", None, "abandon", 0.5, 0.0, 0.0, 1.0, 1.0, 10.0, 10.0), (3, "c", "d", 2, None, None, None, None, None, None, 0.0, None), (4, "e", "d", 1, "TAB", 0.9, 0.0, 200.0, 50.0, 230.0, 1000.0, 1000.0)]
    a = A.kinds(spark.createDataFrame(rows, schema))
    assert {(r.asset_key, r.kind, r.page) for r in a.collect()} == {(1, "figure", 1), (3, "figure", 2), (4, "table", 1)}
    cap = spark.createDataFrame([("d", 1, "figure", 10, 0.0, 110.0, 90.0, 120.0), ("d", 1, "figure", 11, 0.0, 105.0, 20.0, 120.0), ("d", 1, "figure", 12, 0.0, 300.0, 90.0, 320.0)], "doc string, page int, kind string, caption_key long, x1 double, y1 double, x2 double, y2 double")
    assert [tuple(r) for r in A.nearest_caption(a, cap).collect()] == [(1, 10, 10.0)]
    assert {r.asset_key: r.is_hole for r in A.hole_punch(a).collect()} == {1: False, 3: False, 4: True}
