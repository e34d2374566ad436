"""File sources: one JSON document per file, label files, image listings, spreadsheets."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.sources.loose_json import loads


def stem_of(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]*$", "")


def json_documents(spark: SparkSession, folder: str) -> DataFrame:
    """stem, raw_json of every *.json of a folder; a file is a record, whatever line breaks it holds."""
    x = spark.read.text(f"{folder}/*.json", wholetext=True)
    return x.select(F.url_decode(stem_of(F.input_file_name())).alias("stem"), F.col("value").alias("raw_json"))


def page_texts(df: DataFrame, key: str = "stem", text: str = "raw_json") -> DataFrame:
    """key, page, page_text of documents in either form: {"pages": {n: text}} or {n: {"page_text": ...}}.

    Damaged JSON is repaired, hopeless ones give no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                o = loads(t)
                pages = o.get("pages", o) if isinstance(o, dict) else {}
                for n, v in pages.items() if isinstance(pages, dict) else ():
                    v = v.get("page_text") if isinstance(v, dict) else v
                    if isinstance(v, str):
                        rows.append((k, str(n), v))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=[key, "page", "page_text"])

    return df.select(key, text).mapInArrow(run, f"{key} string, page string, page_text string")


def labels(spark: SparkSession, folder: str, classes: list[int] | None = None) -> DataFrame:
    """Boxes of label files (`class cx cy w h`, parts of the image): stem, class_id, x1..y2. Lines of fewer tokens,
    or that are no numbers, are left out; see label_issues."""
    t = F.filter(F.split(F.trim("value"), r"\s+"), lambda w: w != "")
    x = spark.read.text(f"{folder}/*.txt").select(stem_of(F.input_file_name()).alias("stem"), t.alias("t")).filter(F.size("t") >= 5)
    x = x.select("stem", F.col("t")[0].try_cast("int").alias("class_id"), *[F.get("t", F.lit(i)).try_cast("double").alias(n) for i, n in ((1, "cx"), (2, "cy"), (3, "w"), (4, "h"))]).na.drop()
    if classes is not None:
        x = x.filter(F.col("class_id").isin(*classes))
    return x.select("stem", "class_id", (F.col("cx") - F.col("w") / 2).alias("x1"), (F.col("cy") - F.col("h") / 2).alias("y1"), (F.col("cx") + F.col("w") / 2).alias("x2"), (F.col("cy") + F.col("h") / 2).alias("y2"))


def label_issues(spark: SparkSession, folder: str, n_classes: int) -> DataFrame:
    """What is wrong with lines of label files: stem, line, issue."""
    t = F.filter(F.split(F.trim("value"), r"\s+"), lambda w: w != "")
    x = spark.read.text(f"{folder}/*.txt").select(stem_of(F.input_file_name()).alias("stem"), F.col("value").alias("line"), t.alias("t")).filter("trim(line) <> ''")
    num = F.transform(F.slice("t", 2, 4), lambda v: v.try_cast("double"))
    cls = F.get("t", F.lit(0)).try_cast("int")
    issue = (
        F.when(F.size("t") != 5, "wrong_token_count").when(cls.isNull() | F.exists(num, lambda v: v.isNull()), "not_a_number").when((cls < 0) | (cls >= n_classes), "unknown_class").when(F.exists(num, lambda v: (v < 0) | (v > 1)), "out_of_range")
    )
    return x.withColumn("issue", issue).filter("issue is not null").select("stem", "line", "issue")


def images(spark: SparkSession, folder: str) -> DataFrame:
    """path, doc, page of images named `<doc>_page<n>.<ending>`; their bytes aren't read."""
    x = spark.read.format("binaryFile").option("pathGlobFilter", "*.{jpg,jpeg,png,tif,tiff}").load(folder).select("path")
    p = r"([^/]+)_page(\d+)\.[A-Za-z]+$"
    return x.filter(F.col("path").rlike(p)).select("path", F.regexp_extract("path", p, 1).alias("doc"), F.regexp_extract("path", p, 2).cast("int").alias("page"))


def pair_images(images_: DataFrame, labels_: DataFrame) -> DataFrame:
    """Images that have a label file, by stem."""
    return images_.withColumn("stem", stem_of(F.col("path"))).join(labels_.select("stem").distinct(), "stem")


def feature_csv(spark: SparkSession, path: str, schema: str, required: list[str]) -> DataFrame:
    """A feature table from CSV under a declared schema, as section numbers are texts (1.10 is not 1.1). Columns that are
    required and missing are an error."""
    have = spark.read.option("header", True).csv(path).columns
    missing = [c for c in required if c not in have]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def classification_or_default(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Each document's class, or content from page 1 of an unknown kind where there is none. classes: doc, start, document_type."""
    x = docs.select("doc").distinct().join(classes.dropDuplicates(["doc"]), "doc", "left")
    return x.select("doc", F.coalesce("start", F.lit(1)).alias("start"), F.coalesce("document_type", F.lit("unknown")).alias("document_type"))


_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
DEFAULT_WIDTH = 8.43


def read_sheet(blob: bytes) -> tuple[list[float], list[list[str]]]:
    """(column widths, rows of texts) of a workbook's first sheet."""
    with zipfile.ZipFile(io.BytesIO(blob)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{_NS}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_NS}si")]
        sheet = next((n for n in sorted(names) if re.match(r"xl/worksheets/[^/]+\.xml$", n)), None)
        if sheet is None:
            return [], []
        root = ElementTree.fromstring(z.read(sheet))
    cells: dict[tuple[int, int], str] = {}
    for c in root.iter(f"{_NS}c"):
        letters, row = re.match(r"([A-Z]+)(\d+)", c.get("r")).groups()
        col = 0
        for ch in letters:
            col = col * 26 + ord(ch) - 64
        v, kind = c.find(f"{_NS}v"), c.get("t")
        if kind == "inlineStr":
            text = "".join(t.text or "" for t in c.iter(f"{_NS}t"))
        else:
            text = "" if v is None else shared[int(v.text)] if kind == "s" else v.text or ""
        cells[int(row) - 1, col - 1] = text
    n_rows, n_cols = (max((k[i] for k in cells), default=-1) + 1 for i in (0, 1))
    widths = [DEFAULT_WIDTH] * n_cols
    for c in root.iter(f"{_NS}col"):
        for i in range(int(c.get("min")) - 1, min(int(c.get("max")), n_cols)):
            widths[i] = float(c.get("width") or DEFAULT_WIDTH)
    return widths, [[cells.get((r, c), "") for c in range(n_cols)] for r in range(n_rows)]


def spreadsheets(spark: SparkSession, folder: str) -> DataFrame:
    """stem, widths, rows of every *.xlsx of a folder; files that are no workbook give null rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for s, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    got.append((s, *read_sheet(blob)))
                except (zipfile.BadZipFile, ElementTree.ParseError, ValueError, IndexError, AttributeError):
                    got.append((s, None, None))
            if got:
                types = (pa.string(), pa.list_(pa.float64()), pa.list_(pa.list_(pa.string())))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), types)], names=["stem", "widths", "rows"])

    x = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(folder)
    return x.select(stem_of(F.col("path")).alias("stem"), "content").mapInArrow(run, "stem string, widths array<double>, rows array<array<string>>")
