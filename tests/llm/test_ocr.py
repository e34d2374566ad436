import random

import numpy as np

from pyspark.sql import functions as F

from quirefold.llm.ocr import BODY, EDITS, LineModel, Repair, canon_keys, fold, fold_text, line_keys, lines_with, misread_forms, observe, page_number, reassemble, words_in

SCHEMA = "page_id long, doc_stem string, page_number int, source string, page_text string, line_no int"


def test_page_numbers_and_folding():
    for line, want in [("- 15 -", 15), ("Page l7", 17), ("p. 4", 4), ("[3]", 3), ("5/7", 5), ("  12 ", 12), ("iii", 3), ("Page 15 of 16", 15), ("— 4 —", 4)]:
        assert page_number(line)[0] == want
    assert page_number("12")[1] and not page_number("[12]")[1]
    for line in ("3 62", "see p. 4).", "TN-428", "", "Page", "1.5 Pumps", "lis."):
        assert page_number(line) is None
    assert fold("W0rks & Rcgisfry 12") == fold("works registry 7")
    text = "W0rks & Rcgisfry 12\n\n 5\n0a\nÉtat-major_1\n"
    assert lines_with("ab", "ab ab\n\nxab\nb\nab") == {0, 2, 4} and lines_with("ab", "") == set() and lines_with("7", "a\n7") == {1}
    assert fold_text(text).split("\n") == [fold(x) for x in text.split("\n")]
    assert page_number("[" + " " * 40 + "7" + " " * 40 + "]")[0] == 7 and page_number("1" * 9)[0] == 111_111_111 and page_number("1" * 10) is None and page_number("1" * 5000) is None


def test_misread_forms():
    for read, meant in [("inclicator", "indicator"), ("agitat0r", "agitator"), ("sparc", "spare"), ("mernbrane", "membrane"), ("fumace", "furnace"), ("endosure", "enclosure"), ("warrarity", "warranty"), ("siirvey", "survey"), ("va1ve", "valve")]:
        assert meant in misread_forms(read), read
    assert words_in("Heat-treated TN-428 pump") == ["heat-treated", "heat", "treated", "pump"]


def test_line_model():
    pages = [["Title of it", "The text runs on and on here", "and goes on to its end.", "Then more of the text follows", "12"]] * 20
    obs = [observe(p, {0}, set(), {4: False}) for p in pages] + [observe([], set(), set(), {}), observe(["one line"], set(), set(), {})]
    m = LineModel().fit(obs)
    for mat in (m.zone, m.kind, m.join, m.move):
        assert np.allclose(mat.sum(-1), 1)
    got = m.decode(obs)
    assert got[0][0] == 0 and got[0][4] == 1 and got[0][2] == BODY and len(got[-2]) == 0 and len(got[-1]) == 1


def test_reassemble():
    text = "Head\nThe ga5ket was lubri-\ncated. It holds\n\nNew par with cart-\n7"
    pars, on = reassemble(text, [0, 3, 2, 2, 3, 1], [{"line_no": 1, "word": "ga5ket", "meant": "gasket"}], [{"line_no": 1, "a": "lubri", "b": "cated", "meant": None, "here": True, "b_line": 2}, {"line_no": 4, "a": "cart", "b": "ridge", "meant": None, "here": False, "b_line": 1}], None)
    assert pars == ["The gasket was lubricated. It holds", "New par with cartridge"] and on
    assert reassemble("ridge near it.\n\nEnd", [2, 2, 3], [], [], {"b_line": 0, "b": "ridge"})[0] == ["near it.", "End"]


def _pages():
    rows = []
    for d in range(12):
        for p in range(1, 6):
            odd = "".join(chr(103 + (d * 7 + p * 3 + k * k) % 19) for k in range(9))
            body = [f"The hollow gasket was lubricated by {odd} near the", f"old boiler and the {odd[::-1]} was checked before the pump came", f"on. The boiler was then lubricated again by {odd[3:]} of them."]
            lines = [f"Alder{chr(97 + d)}n hollow pump survey    {p}", *body, f"- {p} -"]
            rows.append([d * 10 + p, f"alder{chr(97 + d)}n-pump-survey-10{d:02}", p, "src", lines])
    rows[0][4][1] = "The hollow ga5ket was lubricated in the workshop near the"
    rows[1][4][1] = "The hollow gasket was lubri-"
    rows[1][4].insert(2, "cated in the workshop near the low-")
    rows[1][4].insert(3, "pressure pump")
    rows[2][4][3] = "on. The boiler was then lubricated again by the gas-"
    rows[3][4][1] = "ket near the low-pressure pump in the workshop and so on the"
    rows[4][4][0] = "Aldcran hollow pump siirvey    5"
    rows[4][4][2] = "512"
    return [tuple([a, b, c, d, "\n".join(e), 1]) for a, b, c, d, e in rows]


def test_repair(spark):
    rows = _pages()
    extra = [(900, None, None, None, None, 1), (901, "x", 1, "s", "", 1), (902, "y", None, None, "\n\n", 1), (903, None, 3, "src", "one line", 1), rows[0]]
    df = spark.createDataFrame(rows + extra, SCHEMA)
    r = Repair(df)
    got = {(x.page_id, x.line_no, x.kind) for x in r.found().collect()}
    by = lambda k: {(p, i) for p, i, kind in got if kind == k}
    assert by("running") == {(row[0], 0) for row in rows}
    assert by("pageno") == {(row[0], row[4].count("\n")) for row in rows}
    assert by("hyphen") == {(2, 1), (3, 3)}
    assert (1, 1) in by("misread") and (5, 0) in by("misread") and len(by("misread")) == 2
    pars = {}
    for x in r.paragraphs().orderBy("page_id", "par_no").collect():
        pars.setdefault(x.page_id, []).append(x.text)
    assert "The hollow gasket was lubricated in the workshop" in pars[1][0] and "lubricated in the workshop near the low-" in pars[2][0]
    assert pars[3][-1].endswith("by the gasket") and pars[4][0].startswith("near the low-pressure") and 900 not in pars


def test_empty(spark):
    r = Repair(spark.createDataFrame([], SCHEMA))
    assert r.found().count() == 0 and r.paragraphs().count() == 0


def test_furniture_anywhere_and_words_beyond_the_bound(spark):
    rows = [list(r) for r in _pages()]
    deep = [f"{k} - 10{k}" for k in range(6)]
    for r in rows[:5]:  # six lines with the document's number above its title, which is the seventh
        head, rest = r[4].split("\n", 1)
        r[4] = "\n".join([f"Register sheet {x[0]} of number 1000 volume" for x in deep] + [head, rest])
    df = spark.createDataFrame([tuple(r) for r in rows], SCHEMA)
    want = {(x.page_id, x.line_no, x.kind) for x in Repair(df).found().collect()}
    assert {(r[0], i, "running") for r in rows[:5] for i in range(7)} <= want
    assert {(x.page_id, x.line_no, x.kind) for x in Repair(df, max_sent=0).found().collect()} == want  # by join instead of sent words


def test_sources_apart(spark):
    rows = [(i, f"doc{i}x-one-{1000 + i}", 1, None, f"All rights in this notice are reserved here\nSome text {i} of it\nand more of it", 1) for i in range(9)]
    shared = lambda src: {m.k for r in Repair(spark.createDataFrame([(*x[:3], src, *x[4:]) for x in rows], SCHEMA)).marked.collect() for m in r.marks or ()}
    assert shared(None) == set() and shared(" ") == set() and len(shared("S")) == 1


def test_many_repeated_lines_are_joined_by_a_shuffle(spark, monkeypatch):
    import quirefold.llm.ocr as O

    df = spark.createDataFrame(_pages(), SCHEMA)
    want = sorted(tuple(r) for r in Repair(df).found().collect())
    monkeypatch.setattr(O, "MAX_CANONS", -1)
    assert sorted(tuple(r) for r in Repair(df).found().collect()) == want


def test_keys_find_all_near_lines(spark):
    rng = random.Random(5)
    pairs = []
    for i in range(400):
        a = "".join(rng.choice("abcd") for _ in range(rng.randint(5, 45)))
        b = list(a)
        for _ in range(rng.randint(0, EDITS)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "y"])
        pairs.append((i, a, "".join(b)))
    df = spark.createDataFrame(pairs, "i long, canon string, letters string").filter("letters <> ''").filter(F.levenshtein("letters", "canon") <= EDITS)
    lines = df.select("i", F.explode(F.array(*line_keys("letters"))).alias("key"))
    hit = lines.join(canon_keys(df.select("i", "canon"), ["i"], "canon"), ["i", "key"]).select("i").distinct()
    assert hit.count() == df.count() > 300


def test_damaged_forms_count_together(spark):
    forms = ["bolleran valve survey", "bolleron valve snrvey", "bolleran valvc survcy x", "bollerun valve survey"]
    rows = [(k, "bolleran-valve-survey-2001", k, "s", f"{f}\nSome words of text number {k} run here\nand they end here.", 1) for k, f in enumerate(forms, 1)]
    got = {(x.page_id, x.line_no) for x in Repair(spark.createDataFrame(rows, SCHEMA)).found().filter("kind = 'running'").collect()}
    assert got >= {(1, 0), (3, 0)}


def test_model_is_fitted_on_all_pages(spark):
    # 14,000 pages: as many as were sampled before, and more
    rows = [(i, f"ABC-{1000 + i // 20}", i % 20 + 1, "s", f"Some words {i % 7}\nand more of them.\n" + "\n".join(f"Line {k}." for k in range(i % 5))) for i in range(14_000)]
    r = Repair(spark.createDataFrame(rows, SCHEMA.rpartition(",")[0]))
    obs = [np.frombuffer(x.obs, np.uint8) for x in r.marked.select("obs").collect()]
    assert len(obs) == 14_000
    m = LineModel()
    for _ in range(3):
        m.refit(m.counts(obs))
    for a, b in zip((m.zone, m.kind, m.join, m.move, m.first), (r.model.zone, r.model.kind, r.model.join, r.model.move, r.model.first)):
        assert (a == b).all()


def test_source_needs_all_its_documents_counted(spark):
    # every line is in five documents, the least that counts; an estimated count loses some
    n = 120
    word = lambda i: "".join(chr(97 + i // 26 ** k % 26) * 3 for k in range(4))
    rows = [(d * 1000 + i, f"D{d * 1000 + i}", 1, f"src{i}", f"Notice of {word(i * 977)} to all holders\n" + "\n".join(f"Body line {k} of it goes here." for k in range(12))) for i in range(n) for d in range(5)]
    r = Repair(spark.createDataFrame(rows, SCHEMA.rpartition(",")[0]))
    got = {x.page_id for x in r.marked.collect() for m in x.marks or () if m.k == 4 and m.line_no == 0}
    assert got == {x[0] for x in rows}
