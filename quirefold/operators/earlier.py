"""Earlier ways to find sections: a word stream with short titles, and passes over sections that look like lists
or like chains of false numbers.

Words of a document come in reading order; sections as in operators.sequence. The list and chain passes depend on a document's
whole order and fold over it; the word stream is windows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirefold.operators.grouped import fold_groups
from quirefold.operators.repair import legacy_parts

#: Words behind which a number is a reference.
REFERENCE_WORDS = ("figure", "fig", "table", "tab", "ref", "reference", "see", "section", "paragraph", "para")
TITLE_WORDS = 2


def header_word(word: Column, before: Column) -> Column:
    """Whether a single word is a section number and not a reference to one."""
    shape = word.rlike(r"^[A-Z0-9]+(?:\.[A-Z0-9]+)+\.?$|^[A-Z0-9]+\.$|^\d+\.\d*$")
    clean = F.regexp_replace(F.lower(F.coalesce(before, F.lit(""))), r"^[.,:;]+|[.,:;]+$", "")
    return shape & ~clean.isin(*REFERENCE_WORDS)


def word_stream(words: DataFrame) -> DataFrame:
    """doc, ord, number, title, content: every number-like word opens a section, the next two words are its title.

    Words before the first are ord 0. Lines within content are joined by line breaks."""
    w = Window.partitionBy("doc").orderBy("page", "word_idx")
    x = words.filter(F.trim("text") != "").withColumn("word", F.trim("text"))
    x = x.withColumn("is_head", header_word(F.col("word"), F.lag("word").over(w))).withColumn("ord", F.sum(F.col("is_head").cast("int")).over(w))
    x = x.withColumn("k", F.row_number().over(Window.partitionBy("doc", "ord").orderBy("page", "word_idx")) - F.when(F.col("ord") > 0, 1).otherwise(0))
    new_line = ~(F.col("line_num").eqNullSafe(F.lag("line_num").over(w)) & F.col("page").eqNullSafe(F.lag("page").over(w)))
    x = x.withColumn("piece", F.concat(F.when(new_line, "\n").otherwise(" "), "word"))
    title = (F.col("ord") > 0) & F.col("k").between(1, TITLE_WORDS)
    body = (F.col("ord") == 0) | (F.col("k") > TITLE_WORDS)
    text = lambda c, v: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(c, F.struct("page", "word_idx", F.col(v).alias("v"))))), lambda s: s["v"]), " " if v == "word" else "")
    g = x.groupBy("doc", "ord").agg(F.max(F.when(F.col("is_head"), F.col("word"))).alias("number"), text(title, "word").alias("title"), text(body, "piece").alias("content"))
    return g.select("doc", "ord", "number", "title", F.regexp_replace("content", r"^\s+", "").alias("content"))


def _numbers(sections: DataFrame) -> DataFrame:
    x = sections.withColumn("parts", legacy_parts(F.col("section_number")))
    x = x.withColumn("m", F.regexp_extract(F.coalesce(F.get("parts", F.lit(0)), F.lit("")), r"(\d+)", 1).try_cast("int"))
    return x.filter("m is not null").select("doc", "seq", "m", (F.size("parts") > 1).alias("deep"))


def list_runs(sections: DataFrame) -> DataFrame:
    """doc, seq, run: plain numbers from 1 to 3 on that count up after the document is past them; runs of two or more."""

    def fold(key, rows):
        out, at, run, i = [], 0, 0, 0
        while i < len(rows):
            _, m, deep = rows[i]
            if deep:
                at = max(at, m)
            elif m == at + 1:
                at = m
            elif m <= 3 and at > m:
                j = i + 1
                while j < len(rows) and not rows[j][2] and rows[j][1] == m + j - i:
                    j += 1
                if j - i >= 2:
                    out += [(*key, rows[k][0], run) for k in range(i, j)]
                    run, i = run + 1, j
                    continue
            i += 1
        return out

    return fold_groups(_numbers(sections), ["doc"], ["seq"], fold, "doc long, seq long, run int")


def false_chains(sections: DataFrame) -> DataFrame:
    """doc, seq of plain numbers that jump ahead between dotted sections of one and the same major number."""
    w = Window.partitionBy("doc").orderBy("seq")
    x = _numbers(sections)
    deep = F.when(F.col("deep"), F.col("m"))
    x = x.withColumn("prev_deep", F.last(deep, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("next_deep", F.first(deep, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing)))
    return x.filter(~F.col("deep") & (F.col("m") > F.col("prev_deep")) & (F.col("prev_deep") == F.col("next_deep"))).select("doc", "seq")
