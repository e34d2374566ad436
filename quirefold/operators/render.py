"""The render plan of a document: headings, paragraphs, tables and captions as ordered rows, and table widths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirefold.functions import text as T


def strip_number(title: Column, number: Column) -> Column:
    """A title without its own number in front, unless nothing is left."""
    t = F.ltrim(title)
    rest = F.substring(t, F.length(number) + 1, F.length(t))
    cut = F.regexp_extract(rest, r"^[.)]?\s+(.*)$", 1)
    return F.when(F.startswith(t, number) & (F.trim(cut) != ""), cut).otherwise(title)


def plan(elements: DataFrame) -> DataFrame:
    """doc, seq, kind, level, text: headings (level by the number's parts, 1 to 9), one row per non-blank line of body
    text, captions with a running number of their kind, tables by how they are shown.

    elements: doc, seq, type, section_number, topic, content, caption, n_cols."""
    c = F.col
    level = F.greatest(F.lit(1), F.least(F.lit(9), F.size(F.split(F.coalesce("section_number", F.lit("")), r"\."))))
    head = elements.filter("type = 'section'").select("doc", "seq", F.lit(0).alias("sub"), F.lit("heading").alias("kind"), level.alias("level"), F.concat_ws(" ", "section_number", T.initial_caps(strip_number(c("topic"), F.coalesce("section_number", F.lit(""))))).alias("text"))
    body = elements.filter("content is not null").select("doc", "seq", F.posexplode(F.split("content", "\n")).alias("i", "text"))
    body = body.filter(F.trim("text") != "").select("doc", "seq", (c("i") + 1).alias("sub"), F.lit("text").alias("kind"), F.lit(None).cast("int").alias("level"), F.trim("text").alias("text"))
    n = F.row_number().over(Window.partitionBy("doc", "type").orderBy("seq"))
    cap = elements.filter("type in ('figure', 'table', 'equation')").withColumn("n", n)
    cap = cap.select("doc", "seq", F.lit(0).alias("sub"), F.lit("caption").alias("kind"), F.lit(None).cast("int").alias("level"), F.concat(F.initcap("type"), F.lit(" "), c("n").cast("string"), F.when(F.trim("caption") != "", F.concat(F.lit(". "), F.trim("caption"))).otherwise("")).alias("text"))
    w = Window.partitionBy("doc").orderBy("seq", "sub", "kind")
    return head.unionByName(body).unionByName(cap).withColumn("place", F.row_number().over(w) - 1).select("doc", "place", "kind", "level", "text")


def table_route(tables: DataFrame) -> DataFrame:
    """How a table is shown (spreadsheet, rich, image or placeholder), which way the page lies and whether it gets a caption.

    tables: table_key, has_sheet, has_grid, has_image, landscape, kind."""
    route = F.when(F.col("has_sheet"), "spreadsheet").when(F.col("has_grid"), "rich").when(F.col("has_image"), "image").otherwise("placeholder")
    return tables.select("table_key", route.alias("route"), F.when(F.col("landscape") & route.isin("spreadsheet", "rich"), "landscape").otherwise("portrait").alias("orientation"), (F.coalesce(F.col("kind"), F.lit("")) != "table_layout").alias("captioned"))


def column_widths(columns: DataFrame, total: int = 9360, least: int = 360) -> DataFrame:
    """Absolute widths that add up to `total`: given ones, shares, or equal parts of the rest; what rounding leaves is
    spread one by one from the widest column on.

    columns: table_key, col, width_dxa, width_pct."""
    w = Window.partitionBy("table_key")
    given = F.coalesce(F.when(F.col("width_dxa") > 0, F.col("width_dxa")), F.when(F.col("width_pct") > 0, F.floor(total * F.col("width_pct") / 100)))
    x = columns.withColumn("w0", given.cast("long")).withColumn("open", F.sum(F.col("w0").isNull().cast("int")).over(w)).withColumn("left", total - F.sum(F.coalesce("w0", F.lit(0))).over(w))
    x = x.withColumn("w1", F.coalesce("w0", F.greatest(F.floor(F.try_divide("left", "open")), F.lit(least))))
    x = x.withColumn("diff", total - F.sum("w1").over(w)).withColumn("n", F.count("*").over(w)).withColumn("rank", F.row_number().over(w.orderBy(F.desc("w1"), "col")) - 1)
    extra = F.floor(F.abs("diff") / F.col("n")) + (F.col("rank") < F.abs("diff") % F.col("n")).cast("int")
    return x.select("table_key", "col", (F.col("w1") + F.signum("diff").cast("int") * extra).cast("int").alias("width"))


def from_names(tables: DataFrame) -> DataFrame:
    """Plain tables (column names, rows of texts) in the rich form: a header row from the names, then the rows.

    tables: table_key, columns array<string>, rows array<array<string>>."""
    cell = lambda t: F.coalesce(t, F.lit(""))
    head = F.struct(F.lit(True).alias("is_header"), F.transform("columns", cell).alias("cells"))
    body = F.transform(F.coalesce("rows", F.array().cast("array<array<string>>")), lambda r: F.struct(F.lit(False).alias("is_header"), F.transform(r, cell).alias("cells")))
    return tables.select("table_key", F.when(F.size("columns") > 0, F.concat(F.array(head), body)).otherwise(body).alias("rows"))


def sheet_orientation(n_cols: Column) -> Column:
    """A spreadsheet of its own lies across the page from eight columns on."""
    return F.when(n_cols > 7, "landscape").otherwise("portrait")


def title_page(data: DataFrame) -> DataFrame:
    """doc, place, kind, text of a title page: the title, then each field that is filled in, a draft date marked.

    data: doc, document_title and fields."""
    fields = [c for c in data.columns if c not in ("doc", "document_title")]
    parts = F.array(F.struct(F.lit("title").alias("kind"), F.col("document_title").alias("text")), *[F.struct(F.lit("draft_date" if "draft" in c else "field").alias("kind"), F.col(c).cast("string").alias("text")) for c in fields])
    return data.select("doc", F.posexplode(F.filter(parts, lambda p: F.trim(F.coalesce(p["text"], F.lit(""))) != "")).alias("place", "p")).select("doc", "place", "p.kind", "p.text")
