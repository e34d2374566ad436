"""Sinks: JSON documents, CSV with a fixed column order, split folders, Word files, presence-aware names."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def json_documents(elements: DataFrame, page_meta: DataFrame | None = None) -> DataFrame:
    """doc, json: one document of its ordered elements (doc, seq, ...) and its page metadata (doc, page, ...)."""
    body = [c for c in elements.columns if c != "doc"]
    e = elements.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("seq", *[c for c in body if c != "seq"]))).alias("elements"))
    if page_meta is None:
        return e.select("doc", F.to_json(F.struct("elements")).alias("json"))
    m = page_meta.groupBy("doc").agg(F.map_from_entries(F.collect_list(F.struct(F.col("page").cast("string"), F.struct(*[c for c in page_meta.columns if c not in ("doc", "page")])))).alias("page_metadata"))
    return e.join(m, "doc", "left").select("doc", F.to_json(F.struct("page_metadata", "elements")).alias("json"))


def csv_columns(columns: list[str]) -> list[str]:
    """Metadata columns (with a leading underscore) as they come, then the features in order."""
    return [c for c in columns if c.startswith("_")] + sorted(c for c in columns if not c.startswith("_"))


def write_csv(df: DataFrame, path: str) -> None:
    df.select(*csv_columns(df.columns)).write.mode("overwrite").option("header", True).csv(path)


def write_splits(df: DataFrame, path: str) -> None:
    """One folder for each split."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def unique_names(df: DataFrame, name: str, order: Column) -> DataFrame:
    """Flattened names made unique: the second and further get _1, _2 and so on before their ending."""
    n = F.row_number().over(Window.partitionBy(name).orderBy(order)) - 1
    base, ending = F.regexp_replace(name, r"(\.[^.]*)?$", ""), F.regexp_extract(name, r"(\.[^.]*)$", 1)
    return df.withColumn("unique_name", F.when(n == 0, F.col(name)).otherwise(F.concat(base, F.lit("_"), n.cast("string"), ending)))


_TYPES = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Default Extension="xml" ContentType="application/xml"/><Override PartName="/word/document.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/></Types>'
)
_RELS = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="word/document.xml"/></Relationships>'
)
_WORD = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def word_file(blocks: list[tuple[str, int, str]]) -> bytes:
    """A Word file of (kind, level, text): `heading` by level, `caption` and `text` paragraphs. The same blocks give
    the same bytes."""
    body = []
    for kind, level, text in blocks:
        style = f'<w:pPr><w:pStyle w:val="Heading{level}"/><w:outlineLvl w:val="{level - 1}"/></w:pPr>' if kind == "heading" else '<w:pPr><w:pStyle w:val="Caption"/></w:pPr>' if kind == "caption" else ""
        clean = "".join(c for c in text if c in "\t\n" or ord(c) >= 32)
        body.append(f'<w:p>{style}<w:r><w:t xml:space="preserve">{escape(clean)}</w:t></w:r></w:p>')
    doc = f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><w:document xmlns:w="{_WORD}"><w:body>{"".join(body)}</w:body></w:document>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in (("[Content_Types].xml", _TYPES), ("_rels/.rels", _RELS), ("word/document.xml", doc)):
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), data)
    return out.getvalue()


def word_documents(plan: DataFrame) -> DataFrame:
    """doc, docx from a render plan (doc, seq, kind, level, text). A document's blocks are held in one task."""
    g = plan.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("seq", "kind", F.coalesce("level", F.lit(0)).alias("level"), F.coalesce("text", F.lit("")).alias("text")))).alias("blocks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, blocks in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array([d], pa.string()), pa.array([word_file([(x["kind"], x["level"], x["text"]) for x in blocks])], pa.binary())], names=["doc", "docx"])

    return g.select(F.col("doc").cast("string").alias("doc"), "blocks").mapInArrow(run, "doc string, docx binary")
