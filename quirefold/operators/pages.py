"""Page typing and where a document's content starts.

Pages come as rows (doc, page, page_text). Null texts count as blank. Types are BLANK_PAGE, TABLE_OF_CONTENTS,
TITLE_PAGE, CONTENT_BODY and AMBIGUOUS; a page the rules leave open (null) is for a model (see plugins).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirefold.functions import numbers as N
from quirefold.functions.text import words

#: Wording of cover pages, each counted once.
TITLE_PATTERNS = (
    r"\bDISTRIBUTION\s+STATEMENT\b", r"\bAPPROVED\s+FOR\s+(?:PUBLIC\s+)?RELEASE\b", r"\bFOREIGN\s+DISCLOSURE\b", r"\bUNCLASSIFIED\b", r"\bCONTROLLED\s+UNCLASSIFIED\b", r"\bCONTROLLED\s+BY\b",
    r"\bEXPORT\s+CONTROLLED\b", r"\bPROPRIETARY\b", r"\bCONFIDENTIAL\b", r"\bSECRET\b", r"\bNOFORN\b", r"\bREL\s+TO\b", r"\bITAR\b", r"\bEAR\b", r"\bEXPORT\s+ADMINISTRATION\s+ACT\b",
    r"\bDESTRUCTION\s+NOTICE\b", r"\bWARNING\b.{0,80}\b(?:EXPORT|DESTRUCTION|UNAUTHORIZED|DISCLOSURE|CRIMINAL|PENALTIES)\b", r"\bCONTRACT\s+(?:NO\.?|NUMBER)", r"\bPREPARED\s+(?:BY|FOR)\b",
    r"\bSPECIFICATION\s+(?:NO\.?|NUMBER)", r"\bDOCUMENT\s+(?:NO\.?|NUMBER)", r"\bREVISION\s+[A-Z0-9]+\b", r"\bCAGE\s+CODE\b", r"\bAFNWC\b",
)
#: Stop words of the prose test.
STOP_WORDS = ("the", "of", "and", "a", "to", "in", "is", "for", "on", "with", "as", "by", "this", "be")
#: Headings of contents pages, blank-page notices, numbers, entries and leaders.
TOC_HEADER = r"(?i)\b(?:TABLE\s+OF\s+CONTENTS?|CONTENTS|TOC)\b"
LIST_HEADER = r"(?i)\b(?:LIST\s+OF|TABLE\s+OF)\s+(?:FIGURES?|TABLES?|ILLUSTRATIONS?)\b"
BLANK = r"(?i)\b(?:THIS\s+PAGE\s+)?INTENTIONALLY\s+LEFT\s+BLANK\b"
SECTION = r"(?<![0-9\.])(\d{1,2}(?:\.\d{1,2}){1,5})(?=$|[^0-9\.])"
ENTRY = r"(?:^|\n)\s*(\d{1,2}(?:\.\d{1,2}){1,4})\s+[A-Z][A-Za-z\s\-/&,]+[\s\.]*\d{1,4}\s*(?:$|\n)"
LINE_ENTRY = r"(?im)^\s*(?:[IVXLC]+\.?\s+|[A-Z]\.\d+(?:\.\d+)*\.?\s+|\d{1,2}(?:\.\d{1,2}){0,5}\.?\s*)[A-Za-z0-9].{2,100}?[.\s_cseo-]{4,150}\d{1,4}\s*$"
LEADERS = r"(?i)([.\s_ceos-]{10,})"
MEASURE = r"(?i)\d+\.\d+\s*(?:g|gs|kg|lb|lbs|oz|mm|cm|m|km|in|ft|yd|mi|V|mV|kV|A|mA|W|kW|MW|Hz|kHz|MHz|GHz|°|deg|rad|%|pct|sec|s|ms|min|hr|per|/)\b"
#: Thresholds of the contents rules.
SPARSE, MANY_NUMBERS, HEADER_NUMBERS, MANY_ENTRIES, DENSITY, MANY_PERIODS = 1500, 10, 7, 8, 0.04, 40


def title_indicators(text: Column) -> Column:
    return sum((text.rlike("(?is)" + p).cast("int") for p in TITLE_PATTERNS), F.lit(0))


def _count(text: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def prose(text: Column) -> Column:
    """Dense prose: 150 words or more, over 15 % stop words, over 70 % of letters small, under 40 periods."""
    w = words(text)
    stop = F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS)))
    letters, small = F.length(F.regexp_replace(text, r"[^\p{L}]", "")), F.length(F.regexp_replace(text, r"[^\p{Ll}]", ""))
    return (F.size(w) >= 150) & (stop > 0.15 * F.size(w)) & (letters > 0) & (small > 0.70 * letters) & (F.length(F.regexp_replace(text, r"[^.]", "")) < 40)


def counters(pages: DataFrame) -> DataFrame:
    """The counts the rules are made of, each computed once."""
    t = F.coalesce("page_text", F.lit(""))
    nums = F.filter(F.regexp_extract_all(t, F.lit(SECTION), F.lit(1)), lambda n: ~N.decimal_classify(n))
    x = pages.withColumn("numbers", nums)
    return x.withColumn("n_chars", F.length(t)).withColumn("n_words", F.size(words(t))).withColumn("n_numbers", F.size(F.array_distinct("numbers"))).withColumn("number_chars", F.aggregate("numbers", F.lit(0), lambda a, b: a + F.length(b))).withColumn(
        "n_ink", F.length(F.regexp_replace(t, r"\s", ""))).withColumn("n_entries", _count(t, ENTRY)).withColumn("n_lines", _count(t, LINE_ENTRY)).withColumn("n_leaders", _count(t, LEADERS)).withColumn(
        "n_measures", _count(t, MEASURE)).withColumn("n_periods", F.length(F.regexp_replace(t, r"[^.]", ""))).withColumn("toc_header", t.rlike(TOC_HEADER)).withColumn("list_header", t.rlike(LIST_HEADER)).withColumn(
        "n_captions", _count(t, r"(?i)\b(?:Figure|Table|Fig\.?)\s*\d+")).withColumn("blank_note", t.rlike(BLANK)).withColumn("n_title", title_indicators(t)).withColumn("is_prose", prose(t)).drop("numbers")


def fast_type(pages: DataFrame) -> DataFrame:
    """doc, page, page_type: by rules in a fixed order, null where none is sure."""
    c = F.col
    sparse = c("n_ink") <= SPARSE
    density = F.coalesce(F.try_divide(c("number_chars").cast("double"), c("n_ink")), F.lit(0.0))
    toc = (
        (c("n_numbers") >= MANY_NUMBERS) & (c("n_measures") <= 5) & (density >= DENSITY) & sparse
        | c("toc_header") & (c("n_numbers") >= HEADER_NUMBERS) & sparse
        | (c("n_entries") >= MANY_ENTRIES) & sparse
        | (c("n_lines") >= 6) & sparse
        | c("toc_header") & (c("n_lines") >= 3) & sparse
        | c("list_header") & (c("n_captions") >= 5) & sparse
        | (c("n_leaders") >= 8) & ((c("n_numbers") >= 2) | (c("n_lines") >= 2))
        | c("toc_header") & (c("n_leaders") >= 4) & sparse
        | c("toc_header") & (c("n_periods") >= MANY_PERIODS) & sparse
        | (c("n_periods") >= 80) & (c("n_numbers") >= 3) & sparse
    )
    kind = (
        F.when(c("n_chars") < 20, None).when(c("blank_note") & (c("n_words") <= 30), "BLANK_PAGE").when(c("n_chars") < 50, None).when(toc, "TABLE_OF_CONTENTS")
        .when((c("n_title") >= 3) & (c("n_numbers") <= 2), "TITLE_PAGE").when(c("is_prose"), "CONTENT_BODY")
    )
    return counters(pages).select("doc", "page", kind.alias("page_type"))


def short_type(pages: DataFrame) -> DataFrame:
    """Pages of short documents (five pages or fewer): blank, title (first page only) or content; never open.

    Needs total_pages."""
    t = F.coalesce("page_text", F.lit(""))
    n, k = title_indicators(t), F.size(words(t))
    title = (F.col("page") == 1) & (F.col("total_pages") > 1) & ((n >= 2) | (n >= 1) & (k < 200))
    return pages.select("doc", "page", F.when(t.rlike(BLANK) | (F.length(F.regexp_replace(t, r"^\s+|\s+$", "")) < 50), "BLANK_PAGE").when(title, "TITLE_PAGE").otherwise("CONTENT_BODY").alias("page_type"))


def window_size(total: Column, cap: int = 100) -> Column:
    """How many pages are typed at most."""
    return F.when(total <= 20, F.greatest(F.lit(5), F.floor(total * 0.5))).otherwise(F.least(F.lit(cap), F.greatest(F.lit(10), F.floor(total * 0.15)))).cast("int")


def classified(types: DataFrame, run: int = 3, first: int = 20, more: int = 10) -> DataFrame:
    """The pages that get typed: batches of 20, then 10, up to the window, until `run` content pages in a row were seen.

    types: doc, idx (from 1), page_type, total."""
    w = Window.partitionBy("doc").orderBy("idx")
    x = types.withColumn("cap", window_size(F.col("total"))).filter("idx <= cap")
    hit = (F.col("page_type") == "CONTENT_BODY").cast("int")
    x = x.withColumn("streak", F.sum(hit).over(w.rowsBetween(-(run - 1), 0)))
    stop = x.filter(F.col("streak") == run).groupBy("doc").agg(F.min("idx").alias("stop"))
    x = x.join(stop, "doc", "left")
    batch = F.when(F.col("stop") <= first, first).otherwise(first + F.ceil((F.col("stop") - first) / more) * more)
    end = F.least(F.col("cap"), F.coalesce(batch, F.col("cap"))).cast("int")
    return x.filter(F.col("idx") <= end).select("doc", "idx", "page_type")


def content_pages(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """The rows (doc, page, ...) of pages from where their document's content starts (doc, start); documents without a
    start are content from their first page on, rows without a page are left out."""
    s = starts.select("doc", F.col("start").alias("__start"))
    return rows.join(s, "doc", "left").filter(F.col("page") >= F.coalesce("__start", "page")).drop("__start")


def content_start(types: DataFrame) -> DataFrame:
    """doc, start, document_type from the sequence of page types (doc, page, page_type)."""
    w = Window.partitionBy("doc").orderBy("page")
    solid = F.when(F.col("page_type") != "BLANK_PAGE", F.col("page_type"))
    x = types.withColumn("i", F.row_number().over(w)).withColumn("before", F.last(solid, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    content = F.col("page_type") == "CONTENT_BODY"
    move = content & (F.col("i") > 1)
    kind = F.when(move & (F.col("before") == "TABLE_OF_CONTENTS"), "standard").when(move & F.col("before").isin("TITLE_PAGE", "AMBIGUOUS"), "no_toc").when(move & F.col("before").isNull(), "standard")
    x = x.withColumn("kind", kind)
    g = x.groupBy("doc").agg(
        F.min(F.when(F.col("i") == 1, F.struct("page", content.alias("content")))).alias("one"), F.min(F.when(F.col("kind").isNotNull(), F.struct("page", "kind"))).alias("first"),
        F.min(F.when(content, F.col("page"))).alias("any"), F.min(F.when(F.col("i") == 2, F.col("page"))).alias("two"),
    )
    return g.select(
        "doc", F.when(F.col("one.content"), F.col("one.page")).otherwise(F.coalesce("first.page", "any", "two", "one.page")).alias("start"),
        F.when(F.col("one.content"), "no_title").otherwise(F.coalesce("first.kind", F.lit("unknown"))).alias("document_type"),
    )
