"""Document statistics, sequence features and checks over numbered sections.

Sections come as rows (doc, seq, section_number, topic, page, x_left, y_top, w, h), seq unique in a document. Null
or unparseable numbers have no parts and depth 0. Windows run over (doc, seq); a document's sections, not its
words, are what one task sorts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirefold.functions import numbers as N
from quirefold.functions import text as T


def parsed(sections: DataFrame) -> DataFrame:
    p = N.parse(F.col("section_number"))
    x = sections.withColumn("parts", p)
    return x.withColumn("depth", F.size("parts")).withColumn("major", N.major(F.col("parts"))).withColumn("num", F.array_join("parts", "."))


def doc_stats(x: DataFrame) -> DataFrame:
    """Medians, sample deviations (1 for a single section) and counts of a document's sections."""
    one = lambda c: F.coalesce(F.stddev_samp(c), F.lit(1.0))
    n = F.length("topic")
    return x.groupBy("doc").agg(
        F.count("*").alias("n_sections"), F.median("x_left").alias("x_median"), one("x_left").alias("x_dev"), F.median("y_top").alias("y_median"), one("y_top").alias("y_dev"),
        F.median(n).alias("len_median"), one(n).alias("len_dev"), F.median("depth").alias("depth_median"),
    )


def gaps(x: DataFrame) -> DataFrame:
    """The vertical gap to the section before on the same page; -1 where there is none or they overlap."""
    w = Window.partitionBy("doc").orderBy("seq")
    before = F.lag(F.col("y_top") + F.col("h")).over(w)
    ok = (F.lag("page").over(w) == F.col("page")) & (F.col("y_top") >= before)
    return x.withColumn("gap", F.when(ok, F.col("y_top") - before).otherwise(-1))


def gap_features(x: DataFrame) -> DataFrame:
    """Gap with its share of the document's usual gap: large over 1.5, small under half the median."""
    of = Window.partitionBy("doc")
    own = F.when(F.col("gap") >= 0, F.col("gap"))
    g = gaps(x).withColumns({"gap_median": F.median(own).over(of), "gap_dev": F.coalesce(F.stddev_samp(own).over(of), F.lit(1.0))})
    has = F.col("gap") >= 0
    z = F.when(has & (F.col("gap_dev") > 0), (F.col("gap") - F.col("gap_median")) / F.col("gap_dev")).otherwise(0.0)
    return g.withColumn("gap_z", z).withColumn("large", (has & (F.col("gap") > 1.5 * F.col("gap_median"))).cast("int")).withColumn("small", (has & (F.col("gap") < 0.5 * F.col("gap_median"))).cast("int"))


def neighbours(x: DataFrame) -> DataFrame:
    """Logical-next flags to either neighbour, and both (edges: the one there is)."""
    w = Window.partitionBy("doc").orderBy("seq")
    none = F.array().cast("array<string>")
    nxt = N.logical_next(F.coalesce(F.lag("parts").over(w), none), F.col("parts"))
    x = x.withColumn("is_next", nxt.cast("int"))
    x = x.withColumn("next_is", F.coalesce(F.lead("is_next").over(w), F.lit(0))).withColumn("first", F.row_number().over(w) == 1).withColumn("last", F.lead("seq").over(w).isNull())
    return x.withColumn("both", F.when(F.col("first") | F.col("last"), F.col("is_next")).otherwise(F.col("is_next") * F.col("next_is")))


def extended_score(x: DataFrame) -> DataFrame:
    """Consistency with up to three sections on either side, as a share of the checks that apply."""
    w = Window.partitionBy("doc").orderBy("seq")
    before, after = w.rowsBetween(-3, -1), w.rowsBetween(1, 3)
    y = x if "both" in x.columns else neighbours(x)
    y = y.withColumn("n", F.count("*").over(Window.partitionBy("doc")))
    for name, frame in (("p", before), ("a", after)):
        y = y.withColumn(f"{name}_min", F.min("major").over(frame)).withColumn(f"{name}_max", F.max("major").over(frame))
    m = F.col("major")
    on = lambda c, v: F.when(c, v).otherwise(0.0)
    score = (
        on(~F.col("first") & (F.col("is_next") == 1), 1.0) + on(~F.col("last") & (F.col("next_is") == 1), 1.0)
        + on(m.between(F.col("p_min"), F.col("p_max") + 2), 0.5) + on(F.col("a_min").between(m - 1, m + 2), 0.5)
    )
    checks = on(~F.col("first"), 1.0) + on(~F.col("last"), 1.0) + on(F.col("p_min").isNotNull(), 1.0) + on(F.col("a_min").isNotNull(), 1.0)
    ext = F.when(F.col("n") < 3, 0.5).when(m.isNull(), 0.3).otherwise(F.coalesce(F.round(F.try_divide(score, checks), 6), F.lit(0.5)))
    return y.withColumn("extended_score", ext)


def fit_score(x: DataFrame) -> DataFrame:
    """How well a section fits what its predecessors lead to expect, 0 to 1."""
    w = Window.partitionBy("doc").orderBy("seq")
    y = x if "both" in x.columns else neighbours(x)
    y = y.withColumn("idx", F.row_number().over(w) - 1).withColumn("prev_major", F.lag("major").over(w)).withColumn("avg_depth", F.avg("depth").over(w.rowsBetween(-3, -1)))
    gap = F.col("major") - F.col("prev_major")
    step = F.when(gap == 0, 0.3).when(gap == 1, 0.4).when(gap > 1, -0.1 * (gap - 1)).otherwise(0.0)
    later = 0.5 * F.col("is_next") + F.coalesce(step, F.lit(0.0)) + F.when((F.col("idx") >= 2) & (F.abs(F.col("depth") - F.col("avg_depth")) <= 1), 0.2).otherwise(0.0)
    start = F.when(F.col("num").isin("1", "1.1", "1.0"), 1.0).when(F.col("major") <= 3, 0.7).otherwise(0.3)
    return y.withColumn("fit_score", F.when(F.col("idx") == 0, start).otherwise(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), later)), 6)))


def format_score(x: DataFrame) -> DataFrame:
    """Left edge and title case against the other sections of the same depth in the document.

    Sections that are equal in every respect count as the same one. A depth's positions are listed once each with their
    count, so a depth with very many sections costs its distinct positions, not pairs. All of it by windows within a
    document: one shuffle, and two sorts."""
    # a section's twins are left out with it
    rest = ["section_number", "topic", "page", "y_top", "w", "h"]
    upper = (F.upper("topic") == F.col("topic")) & (F.lower("topic") != F.col("topic"))
    titled = F.col("topic").rlike(r"\p{L}") & ~F.col("topic").rlike(r"(?:^|[^\p{L}])\p{Ll}") & ~F.col("topic").rlike(r"\p{L}\p{Lu}")
    of, at = Window.partitionBy("doc", "depth"), Window.partitionBy("doc", "depth", "x_left")
    # the document first: what comes after is by parts of it
    y = x.filter("doc is not null").withColumns({"is_upper": upper.cast("int"), "is_title": titled.cast("int"), "n_doc": F.count("*").over(Window.partitionBy("doc"))})
    y = y.withColumn("k", F.count("*").over(Window.partitionBy("doc", "depth", "x_left", *rest))).withColumns({"c": F.count("*").over(at), "nth": F.row_number().over(at.orderBy(*rest))})
    y = y.withColumns({"hist": F.sort_array(F.collect_list(F.when(F.col("nth") == 1, F.struct("x_left", "c"))).over(of)), "n": F.count("*").over(of), "uppers": F.sum("is_upper").over(of), "titles": F.sum("is_title").over(of)}).drop("c", "nth", "n_doc")
    left = F.col("n") - F.col("k")

    def nth(i: Column) -> Column:
        """The i-th (from 1) position of the others in order, from the histogram without this section's twins."""
        walk = F.aggregate(
            "hist", F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("double").alias("v")),
            lambda s, e: F.struct((s["seen"] + e["c"] - F.when(e["x_left"] == F.col("x_left"), F.col("k")).otherwise(0)).alias("seen"),
                                  F.when(s["v"].isNull() & (s["seen"] + e["c"] - F.when(e["x_left"] == F.col("x_left"), F.col("k")).otherwise(0) >= i), e["x_left"].cast("double")).otherwise(s["v"]).alias("v")),
        )
        return walk["v"]

    med = (nth(F.floor((left + 1) / 2)) + nth(F.floor((left + 2) / 2))) / 2
    near = F.when(F.abs(F.col("x_left") - med) < 50, 0.5).otherwise(0.0)
    style = F.when(((F.col("uppers") - F.col("is_upper") * F.col("k")) > left / 2) & (F.col("is_upper") == 1), 0.3).when(((F.col("titles") - F.col("is_title") * F.col("k")) > left / 2) & (F.col("is_title") == 1), 0.3).otherwise(0.0)
    return y.withColumn("format_score", F.when(left <= 0, 0.5).otherwise(F.round((near + style) / 2, 6)))


def _heads(p: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(p)), lambda n: F.array_join(F.slice(p, 1, n), "."))


def _norm(p: Column) -> Column:
    return F.transform(p, lambda q: F.coalesce(q.try_cast("int").cast("string"), F.upper(q)))


def _toc_score(has: Column) -> Column:
    """From num, exact and best, the number of parts that some number of the contents has too."""
    b = F.coalesce("best", F.lit(0))
    return F.when(~F.coalesce(has, F.lit(False)) | (F.col("num") == ""), 0.5).when(F.col("exact"), 1.0).when(b >= 2, F.round(0.7 + 0.1 * F.least(b - 1, F.lit(3)), 6)).when(b == 1, 0.4).otherwise(0.1)


def looked_up(sections: DataFrame, toc: DataFrame | Column) -> DataFrame:
    """Sections parsed, with what their documents say of their numbers: there (the number above is a section's),
    in_toc, toc_parent, toc_score (as `toc_fuzzy`).

    toc: doc, num; or which of the parsed sections the contents name. Rows go by document once. There every section
    asks for its number, the number above and its prefixes in rows of their own beside it; who asks for the same is sorted
    together, and answers are sorted back to their section. So no table is joined, and no document is held."""
    x = sections.filter("doc is not null")
    # a number is parsed once: projections are copied to where they are used, generators aren't
    x = x.withColumn("num", F.explode(F.array(F.array_join(N.parse(F.col("section_number")), "."))))
    x = x.withColumn("parts", F.when(F.col("num") == "", F.array().cast("array<string>")).otherwise(F.split("num", r"\.")))
    x = x.withColumn("depth", F.size("parts")).withColumn("major", N.major(F.col("parts"))).withColumn("__own", F.lit(True))
    if isinstance(toc, DataFrame):
        named = toc.filter("doc is not null").select("doc", "num", F.lit(False).alias("__own"), F.lit(True).alias("__toc"))
        x = x.withColumn("__toc", F.lit(False)).unionByName(named, allowMissingColumns=True)
    else:
        x = x.withColumn("__toc", F.coalesce(toc, F.lit(False)))
    x = x.withColumn("has_toc", F.max("__toc").over(Window.partitionBy("doc")))
    ask = lambda i, head, key, own, named: F.struct(i.cast("int").alias("i"), F.lit(head).alias("head"), key.alias("key"), own.alias("own"), named.alias("named"))
    own, named, no = F.col("__own"), F.col("__toc"), F.lit(False)
    above = F.array_join(F.slice("parts", 1, F.greatest(F.size("parts") - 1, F.lit(0))), ".")
    numbers = F.array(ask(F.lit(0), False, F.col("num"), own, named), ask(F.lit(-1), False, above, no, no))
    heads = F.when(F.col("num") != "", T.let(_norm(F.split("num", r"\.")), _heads)).otherwise(F.array().cast("array<string>"))
    heads = F.transform(heads, lambda h, i: ask(i + 1, True, h, no, named))
    kept = [c for c in x.columns if c not in ("doc", "seq")]
    x = x.select("doc", "seq", *kept, F.explode(F.concat(numbers, heads)).alias("__k"))
    x = x.select("doc", "seq", F.when(F.col("__k.i") == 0, F.struct(*kept)).alias("__r"), *[F.col(f"__k.{c}").alias(f"__{c}") for c in ("i", "head", "key")], F.col("__k.own").alias("__n"), F.col("__k.named").alias("__t"))
    same, back = Window.partitionBy("doc", "__head", "__key"), Window.partitionBy("doc", "seq")
    x = x.withColumns({"__n": F.max("__n").over(same), "__t": F.max("__t").over(same)})
    up = F.col("__i") == -1
    x = x.withColumns({"there": F.max(F.when(up, F.col("__n"))).over(back), "toc_parent": F.max(F.when(up, F.col("__t"))).over(back), "best": F.max(F.when((F.col("__i") > 0) & F.col("__t"), F.col("__i"))).over(back)})
    x = x.filter("__i = 0 and seq is not null").select("doc", "seq", "__r.*", "there", "toc_parent", "best", F.col("__t").alias("exact")).filter("__own")
    return x.withColumn("toc_score", _toc_score(F.col("has_toc"))).withColumn("in_toc", F.col("exact")).drop("__own", "__toc", "has_toc", "best", "exact")


def toc_fuzzy(x: DataFrame, toc: DataFrame) -> DataFrame:
    """Longest common prefix with the document's table of contents as a score; 0.5 without one.

    The contents are exploded to their prefixes and joined by prefix, never pair by pair."""
    t = toc.select("doc", F.explode(_heads(_norm(F.split("num", r"\.")))).alias("head")).distinct()
    has = toc.select("doc").distinct().withColumn("has_toc", F.lit(True))
    own = x.filter("size(parts) > 0").select("doc", "seq", F.posexplode(_heads(_norm(F.col("parts")))).alias("i", "head"))
    best = own.join(t, ["doc", "head"]).groupBy("doc", "seq").agg((F.max("i") + 1).alias("best"))
    exact = toc.select("doc", "num", F.lit(True).alias("exact")).distinct()
    y = x.join(best, ["doc", "seq"], "left").join(has, "doc", "left").join(exact, ["doc", "num"], "left")
    return y.withColumn("toc_score", _toc_score(F.col("has_toc"))).withColumn("in_toc", F.coalesce("exact", F.lit(False)))


def toc_metrics(toc: DataFrame, output: DataFrame) -> DataFrame:
    """Set metrics of a document's table of contents against its output numbers; percentages to 2 places."""
    t, o = toc.select("doc", "num").distinct().withColumn("t", F.lit(1)), output.select("doc", "num").distinct().withColumn("o", F.lit(1))
    g = t.join(o, ["doc", "num"], "full").groupBy("doc").agg(F.count("t").alias("n_toc"), F.count("o").alias("n_output"), F.count(F.when(F.col("t").isNotNull() & F.col("o").isNotNull(), 1)).alias("n_both"), F.count("*").alias("n_union"))
    pct = lambda a, b: F.round(100 * F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0)), 2)
    return g.filter("n_toc > 0").select("doc", "n_toc", "n_output", "n_both", "n_union", pct("n_both", "n_union").alias("match_pct"), pct("n_both", "n_toc").alias("coverage_pct"), pct("n_both", "n_output").alias("precision_pct"))


def title_features(x: DataFrame) -> DataFrame:
    """Title length, case and date features, and its quality."""
    t = F.col("topic")
    w = T.words(t)
    cased = lambda r: t.rlike(r)
    return x.withColumn("title_len", F.length(t)).withColumn("title_words", F.size(w)).withColumn("title_caps", ((F.upper(t) == t) & cased(r"\p{L}")).cast("int")).withColumn(
        "starts_article", F.lower(F.get(w, F.lit(0))).isin("a", "an", "the").cast("int")).withColumn("has_paren", t.rlike(r"\([^)]*\)").cast("int")).withColumn("avg_word_len", F.round(F.coalesce(F.try_divide(F.aggregate(w, F.lit(0), lambda a, b: a + F.length(b)).cast("double"), F.size(w)), F.lit(0.0)), 6)).withColumn(
        "title_quality", T.title_quality(t))


def number_features(x: DataFrame) -> DataFrame:
    """Character features of the raw number."""
    s = F.col("section_number")
    count = lambda p: F.length(F.regexp_replace(s, p, ""))
    return x.withColumn("num_len", F.length(s)).withColumn("alpha_count", count(r"[^\p{L}]")).withColumn("dot_count", count(r"[^.]")).withColumn("separator_count", count(r"[^.,\-]")).withColumn(
        "pure_digits", s.rlike(r"^\d+$").cast("int")).withColumn("double_dot", s.contains("..").cast("int")).withColumn("len_per_depth", F.round(F.coalesce(F.try_divide(F.length(s).cast("double"), F.col("depth")), F.lit(999.0)), 6)).withColumn(
        "major_gt_6", F.coalesce(F.col("major") > 6, F.lit(False)).cast("int")).withColumn("possible_day", F.coalesce(F.col("major").between(1, 31), F.lit(False)).cast("int"))


def position_features(x: DataFrame, page_width: float, page_height: float) -> DataFrame:
    """Place in document and page: index, share, sections of the page, zones."""
    w = Window.partitionBy("doc").orderBy("seq")
    n = F.count("*").over(Window.partitionBy("doc"))
    y = F.col("y_top") / page_height
    return x.withColumn("idx", F.row_number().over(w) - 1).withColumn("idx_norm", F.round((F.row_number().over(w) - 1) / n, 6)).withColumn("same_page", F.count("*").over(Window.partitionBy("doc", "page"))).withColumn(
        "x_pct", F.round(F.col("x_left") / page_width, 6)).withColumn("y_pct", F.round(y, 6)).withColumn("in_header", (y < 0.10).cast("int")).withColumn("in_footer", (y > 0.90).cast("int")).withColumn(
        "bottom_third", (y > 2 / 3).cast("int")).withColumn("aspect", F.round(F.col("w") / F.col("h"), 6)).withColumn("page_norm", F.round(F.col("page") / F.max("page").over(Window.partitionBy("doc")), 6))
