import glob
import io
import json
import zipfile

from pyspark.sql import functions as F

from quirefold.sources import files as S
from quirefold.sources import sinks as K
from quirefold.streaming import incremental as I


def _sheet() -> bytes:
    out = io.BytesIO()
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>name</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><cols><col min="2" max="2" width="20.5"/></cols><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1"><v>4.5</v></c></row><row r="3"><c r="B3" t="inlineStr"><is><t>x</t></is></c></row></sheetData></worksheet>')
    return out.getvalue()


def test_sources(spark, tmp_path):
    (tmp_path / "a b.json").write_text('{"pages": {"1": "one",\n "2": "two",}}')
    (tmp_path / "c.json").write_text('{"7": {"page_text": "x "quoted" y", "page_Id": 7}, "8": {}}')
    (tmp_path / "d.json").write_text("{")
    got = sorted(tuple(r) for r in S.page_texts(S.json_documents(spark, str(tmp_path))).collect())
    assert got == [("a b", "1", "one"), ("a b", "2", "two"), ("c", "7", 'x "quoted" y')]
    (tmp_path / "p_page1.txt").write_text("3 0.5 0.5 0.2 0.4\n9 0.1 0.1 0.1 0.1 0.7\n1 2\nx 1 1 1 1\n3 1.5 0 0 0\n")
    (tmp_path / "p_page1.jpg").write_bytes(b"j")
    (tmp_path / "p_page22.png").write_bytes(b"j")
    boxes = S.labels(spark, str(tmp_path), [3]).collect()
    assert len(boxes) == 2 and abs(boxes[0].x1 - 0.4) < 1e-9 and abs(boxes[0].y2 - 0.7) < 1e-9
    issues = {r.line: r.issue for r in S.label_issues(spark, str(tmp_path), 5).collect()}
    assert issues == {"9 0.1 0.1 0.1 0.1 0.7": "wrong_token_count", "1 2": "wrong_token_count", "x 1 1 1 1": "not_a_number", "3 1.5 0 0 0": "out_of_range"}
    im = S.images(spark, str(tmp_path))
    assert sorted((r.doc, r.page) for r in im.collect()) == [("p", 1), ("p", 22)]
    assert [r.page for r in S.pair_images(im, S.labels(spark, str(tmp_path))).collect()] == [1]
    (tmp_path / "w.xlsx").write_bytes(_sheet())
    (tmp_path / "bad.xlsx").write_bytes(b"no zip")
    got = {r.stem: (r.widths, r.rows) for r in S.spreadsheets(spark, str(tmp_path)).collect()}
    assert got == {"w": ([8.43, 20.5], [["name", "4.5"], ["", ""], ["", "x"]]), "bad": (None, None)}


def test_sinks(spark, tmp_path):
    e = spark.createDataFrame([("d", 1, "text", "b"), ("d", 0, "section", "a"), ("e", 0, "text", None)], "doc string, seq int, type string, text string")
    m = spark.createDataFrame([("d", 1, 10), ("d", 2, 20)], "doc string, page int, n int")
    got = {r.doc: json.loads(r.json) for r in K.json_documents(e, m).collect()}
    assert [x["text"] for x in got["d"]["elements"]] == ["a", "b"] and got["d"]["page_metadata"] == {"1": {"n": 10}, "2": {"n": 20}} and "page_metadata" not in got["e"]
    assert K.csv_columns(["b", "_x", "a", "_a"]) == ["_x", "_a", "a", "b"]
    n = K.unique_names(spark.createDataFrame([(1, "a.json"), (2, "a.json"), (3, "b")], "k int, name string"), "name", F.col("k"))
    assert sorted(r.unique_name for r in n.collect()) == ["a.json", "a_1.json", "b"]
    plan = spark.createDataFrame([("d", 1, "text", None, "body & <more>"), ("d", 0, "heading", 2, "Head")], "doc string, seq int, kind string, level int, text string")
    blob = K.word_documents(plan).first().docx
    with zipfile.ZipFile(io.BytesIO(blob)) as z:
        x = z.read("word/document.xml").decode()
    assert x.index("Head") < x.index("body &amp; &lt;more&gt;") and "Heading2" in x
    K.write_csv(spark.createDataFrame([(1, 2)], "z int, _m int"), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["_m", "z"]


def test_incremental_run(spark, tmp_path):
    src, out, chk = (str(tmp_path / x) for x in ("src", "out", "chk"))
    rec = lambda i: (i, json.dumps({"1": {"conf": [90, 80], "text": ["a", "b"]}}))
    spark.createDataFrame([rec(1), rec(1)], "rec_id long, raw_json string").write.parquet(src)
    I.ocr_words(spark, src, out, chk)
    spark.createDataFrame([rec(2)], "rec_id long, raw_json string").write.mode("append").parquet(src)
    I.ocr_words(spark, src, out, chk)
    I.ocr_words(spark, src, out, chk)
    assert sorted((r.rec_id, r.word_pos) for r in spark.read.parquet(out).collect()) == [(1, 0), (1, 1), (2, 0), (2, 1)]
    ev = spark.createDataFrame([("2024-01-01 00:10:00", "a", 1.0), ("2024-01-01 00:50:00", "a", 2.0), ("2024-01-01 01:10:00", "a", 4.0)], "ts string, event_type string, value double")
    assert sorted((r.n, r.total) for r in I.event_windows(ev).collect()) == [(1, 4.0), (2, 3.0)]


def test_byte_ranges(spark, tmp_path):
    from quirefold.sources.byte_ranges import byte_ranges

    data = bytes(range(256)) * 9
    (tmp_path / "b").mkdir()
    (tmp_path / "a.bin").write_bytes(data)
    (tmp_path / "b" / "empty").write_bytes(b"")
    (tmp_path / "b" / "two").write_bytes(b"xy")
    got = byte_ranges(spark, [str(tmp_path)], 100, 7).orderBy("file", "range_no").collect()
    assert [r.file.rsplit("/", 1)[1] for r in got] == ["a.bin"] * 24 + ["two"]
    for r in got:
        assert r.data == (data if r.file.endswith("a.bin") else b"xy")[r.start : r.stop + 7] and r.stop == min(r.start + 100, r.size)
    assert b"".join(bytes(r.data[: r.stop - r.start]) for r in got[:24]) == data


def test_intermediates_are_deleted(spark):
    from quirefold.session import forget, release, written

    a, b = (written(spark.range(3), n) for n in "ab")
    assert a.count() == 3
    forget(a)
    forget(spark.range(1))  # not a written table
    assert b.count() == 3
    folder = b._written_at.removeprefix("file://")
    assert glob.glob(folder) and not glob.glob(a._written_at.removeprefix("file://"))
    release(spark)
    assert not glob.glob(folder)
