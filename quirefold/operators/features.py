"""The section feature table: one row a section, its columns by the names of the CSV contract (17 that describe the
row and start with an underscore, 162 features).

Input: sections as in operators.sequence plus optional columns: conf_mean, conf_min, conf_max, conf_std, n_words, n_low,
n_blocks, n_pars, word_num_first, block_num, par_num, line_num, level (recognition), leading_whitespace,
text_before_number, original_line_length, newlines_before (where the number was found), content, label. Missing ones, and
nulls, count as absent: 0 or empty. Tagger columns (lang_*) come from a plug-in as a table by (doc, seq) and are 0
without it. Null titles and numbers are empty ones.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirefold.functions import numbers as N
from quirefold.functions import text as T
from quirefold.operators import sequence as Q

#: Words that open instructions, words of major sections.
IMPERATIVES = ("see", "refer", "note", "ensure", "verify", "check", "use", "apply", "follow", "review", "contact", "consult", "consider")
REFERENCE_WORDS = ("see", "refer", "section", "para", "paragraph", "item", "ref", "per")
LANGUAGE = ("lang_root_is_verb", "lang_root_is_noun", "lang_has_finite_verb", "lang_has_verb", "lang_starts_det", "lang_starts_imperative", "lang_has_subject", "lang_is_complete_sentence", "lang_has_modal", "lang_word_count")
#: What each feature adds to the combined confidence.
WEIGHTS = {
    "is_logical_next": 0.15, "next_is_logical_successor": 0.15, "in_toc_exact": 0.2, "parent_exists": 0.1, "title_has_section_keyword": 0.1, "has_large_vertical_gap": 0.05, "lang_root_is_noun": 0.05, "looks_like_date": -0.3,
    "title_absurdly_long": -0.2, "subsection_looks_like_decimal": -0.15, "has_small_vertical_gap": -0.05, "title_is_blank": -0.3, "title_is_useless": -0.2, "lang_root_is_verb": -0.1, "lang_has_finite_verb": -0.1, "lang_is_complete_sentence": -0.15,
    "lang_has_modal": -0.1, "lang_starts_imperative": -0.1, "late_page_bad_sequence": -0.15, "late_page_useless_title": -0.2, "height_is_multiline": -0.1, "height_is_very_tall": -0.15, "major_section_gt_10": -0.1, "major_section_gt_20": -0.1,
}
MAJOR_KEYWORDS = ("scope", "introduction", "overview", "requirements", "references", "documents", "definitions", "general", "verification", "quality", "packaging", "notes", "appendix")


#: Sections that a task sorts several times over without spilling.
ROWS_A_TASK = 25_000


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


def _part(a: Column, b: Column | float, otherwise: float = 0.0) -> Column:
    return F.round(F.coalesce(F.try_divide(a.cast("double"), b if isinstance(b, Column) else F.lit(b)), F.lit(otherwise)), 6)


def _names_any(s: Column, words: tuple[str, ...]) -> Column:
    """Whether a text contains one of the words, as a chain of tests: a function over an array of them would be interpreted for each row."""
    low = F.lower(s)
    return reduce(or_, [F.contains(low, F.lit(w)) for w in words])


def section_features(sections: DataFrame, toc: DataFrame | Column, page_width: float, page_height: float, language: DataFrame | None = None) -> DataFrame:
    """doc, seq, what describes the row, and the features. toc: doc, num, or which of the parsed sections the contents name; language: doc, seq and the lang_* columns."""
    have = set(sections.columns)
    if language is not None:
        sections = sections.join(language.select("doc", "seq", *[k for k in LANGUAGE if k in language.columns]), ["doc", "seq"], "left")
    # all by windows within a document, so that rows are shuffled once, by document; sorted by number asked for, seq, depth and page
    x = Q.gap_features(Q.fit_score(Q.extended_score(Q.neighbours(Q.looked_up(sections, toc))))).drop("n", "k")
    doc, w, dev = Window.partitionBy("doc"), Window.partitionBy("doc").orderBy("seq"), lambda c, v: F.coalesce(F.stddev_samp(c).over(v), F.lit(1.0))
    x = x.withColumns({"p_major": F.lag("major").over(w), "n_major": F.lead("major").over(w), "p_depth": F.lag("depth").over(w)})
    t_len = F.length("topic")
    x = x.withColumns({
        "n_sections": F.count("*").over(doc), "x_median": F.median("x_left").over(doc), "x_dev": dev("x_left", doc), "y_median": F.median("y_top").over(doc), "y_dev": dev("y_top", doc), "len_median": F.median(t_len).over(doc), "len_dev": dev(t_len, doc),
        "depth_median": F.median("depth").over(doc), "x_min": F.min("x_left").over(doc), "pages": F.max("page").over(doc), "h_median": F.median("h").over(doc),
    })
    x, depth = Q.format_score(x).drop("n", "k", "hist", "uppers", "titles"), Window.partitionBy("doc", "depth")
    x = x.withColumns({"depth_x": F.median("x_left").over(depth), "depth_x_dev": dev("x_left", depth)})
    x = x.withColumn("same_page", F.count("*").over(Window.partitionBy("doc", "page")))
    x = x.withColumn("parent", F.array_join(F.slice("parts", 1, F.greatest(F.size("parts") - 1, F.lit(0))), "."))
    c = F.col
    get = lambda n, d=0.0: F.coalesce(c(n), F.lit(d)) if n in have else F.lit(d)
    t, num = F.coalesce("topic", F.lit("")), F.coalesce("section_number", F.lit(""))
    strip, ws = T.py_strip(t), T.words(t)
    first = F.lower(F.coalesce(F.get(ws, F.lit(0)), F.lit("")))
    month = F.regexp_replace(first, r"[-.]+$", "").rlike(rf"^(?:{T.MONTHS})$")
    starts_month = F.lower(strip).rlike(rf"^(?:{T.MONTHS})")
    month_year = F.lower(t).rlike(rf"^\s*(?:{T.MONTHS})[\s,.\-]*\d{{2,4}}")
    day = c("major").between(1, 31)
    key, major_key = _names_any(t, T.TITLE_KEYWORDS), _names_any(t, MAJOR_KEYWORDS)
    upper = (F.upper(t) == t) & (F.lower(t) != t)
    titled = t.rlike(r"\p{L}") & ~t.rlike(r"(?:^|[^\p{L}])\p{Ll}") & ~t.rlike(r"\p{L}\p{Lu}")
    count = lambda p, v=num: F.length(F.regexp_replace(v, p, ""))
    blank, short = strip == "", F.length(strip).between(1, 2)
    punct, digits = strip.rlike(r"^[!-/:-@\[-`{-~]+$"), F.regexp_replace(strip, r"[.\-]", "").rlike(r"^\d+$")
    useless = blank | short | punct | digits
    bottom, right = c("y_top") + c("h"), c("x_left") + c("w")
    y_pct = c("y_top") / page_height
    body = F.coalesce(c("content"), F.lit("")) if "content" in have else F.lit("")
    chars, n_words = F.length(t), F.size(ws)
    tall = c("h_median") > 0
    rel = F.when(tall, c("h") / c("h_median")).otherwise(1.0)
    raw = F.regexp_replace(num, " ", "")
    raw_len, ratio = F.length(raw), F.coalesce(F.try_divide(F.length(raw).cast("double"), c("depth")), F.lit(0.0))
    pure = raw.rlike(r"^\p{Nd}+$")
    subs = F.array_max(F.slice(N.ints(c("parts")), 2, F.greatest(F.size("parts") - 1, F.lit(0))))
    largest = F.coalesce(subs, F.lit(0))
    text_of = lambda n: F.coalesce(c(n).cast("string"), F.lit("")) if n in have else F.lit("")
    led, before = get("leading_whitespace", 0), text_of("text_before_number")
    spread = get("conf_max") - get("conf_min")
    out = {
        # the row
        "_doc_name": c("doc").cast("string"), "_index": c("idx"), "_section_number_raw": num, "_title": F.substring(t, 1, 100), "_title_full_length": chars, "_page": F.coalesce(c("page"), F.lit(0)), "_label": text_of("label"),
        "_fingerprint": F.concat(c("doc").cast("string"), F.lit("|"), F.coalesce(c("page"), F.lit(0)).cast("string"), F.lit("|"), F.coalesce(c("x_left").cast("int"), F.lit(0)).cast("string"), F.lit("_"), F.coalesce(c("y_top").cast("int"), F.lit(0)).cast("string")),
        "_ocr_block_num": text_of("block_num"), "_ocr_par_num": text_of("par_num"), "_ocr_line_num": text_of("line_num"), "_ocr_word_count": text_of("n_words"), "_ocr_conf_mean": text_of("conf_mean"), "_ocr_conf_min": text_of("conf_min"),
        "_ocr_conf_max": text_of("conf_max"), "_ocr_level": text_of("level"), "_section_number_normalized": c("num"),
        # recognition
        "ocr_conf_mean": get("conf_mean"), "ocr_conf_min": get("conf_min"), "ocr_conf_max": get("conf_max"), "ocr_conf_std": get("conf_std"), "ocr_word_count": get("n_words", 0), "ocr_low_conf_word_count": get("n_low", 0),
        "ocr_conf_below_50": _flag(get("conf_mean") < 50), "ocr_conf_below_30": _flag(get("conf_mean") < 30), "ocr_has_low_conf_word": _flag(get("n_low", 0) > 0), "ocr_mostly_low_conf": _flag(get("n_low", 0) > get("n_words", 0) / 2) * _flag(get("n_words", 0) > 0),
        "ocr_conf_spread": spread, "ocr_conf_high_spread": _flag(spread > 50), "ocr_spans_multiple_blocks": _flag(get("n_blocks", 0) > 1), "ocr_spans_multiple_pars": _flag(get("n_pars", 0) > 1),
        "ocr_is_first_word_in_line": _flag(get("word_num_first", 0) <= 1), "ocr_word_num_first": get("word_num_first", 0),
        # number
        "section_depth": c("depth"), "section_depth_vs_median": F.when(F.coalesce("depth_median", F.lit(0.0)) != 0, c("depth") - c("depth_median")).otherwise(0.0), "section_major": F.coalesce("major", F.lit(-1)), "section_major_seen_before": _flag(c("major").isNotNull()),
        "is_simple_number": _flag(c("depth") == 1), "parent_exists": _flag(c("there") & (c("parent") != "")), "has_non_numeric_part": _flag(F.exists("parts", lambda p: ~p.rlike(r"^\d+$"))), "max_subsection_value": largest, "subsection_looks_like_decimal": _flag(largest >= 50),
        # number as written
        "section_num_alpha_count": count(r"[^\p{L}]"), "section_num_too_many_alpha": _flag(count(r"[^\p{L}]") > 2), "section_num_is_pure_digits": _flag(pure), "section_num_pure_digit_length": F.when(pure, raw_len).otherwise(0), "section_num_pure_digits_too_long": _flag(pure & (raw_len > 3)),
        "section_num_mixed_no_dot": _flag(num.rlike(r"\p{Nd}") & num.rlike(r"\p{L}") & ~F.contains(num, F.lit("."))), "section_num_length_to_depth_ratio": F.round(ratio, 6), "section_num_ratio_suspicious": _flag(ratio > 2), "section_num_raw_length": raw_len,
        "section_num_dot_count": count(r"[^.]"), "section_num_dots_match_depth": _flag(count(r"[^.]") == c("depth") - 1), "section_num_has_hyphen": _flag(F.contains(num, F.lit("-"))), "section_num_has_comma": _flag(F.contains(num, F.lit(","))), "section_num_has_space": _flag(F.contains(num, F.lit(" "))),
        "section_num_non_standard_char_count": count(r"[\p{Nd}.]"), "section_num_has_letters": _flag(num.rlike(r"\p{L}")), "section_num_has_double_dot": _flag(F.contains(num, F.lit(".."))), "section_num_starts_with_dot": _flag(F.startswith(num, F.lit("."))), "section_num_ends_with_dot": _flag(F.endswith(num, F.lit("."))),
        # context
        "had_leading_whitespace": _flag(led > 0), "leading_whitespace_len": led, "had_text_before_number": _flag(before != ""), "text_before_number_len": F.length(before), "text_before_is_reference": _flag(_names_any(before, REFERENCE_WORDS)),
        "original_line_length": get("original_line_length", 0), "newlines_before_section_num": get("newlines_before", 0),
        # horizontal place
        "x_near_left_margin": _flag(c("x_left") <= c("x_min") * 1.5), "x_distance_from_min": c("x_left") - c("x_min"), "x_matches_depth_indent": _flag(F.abs(c("x_left") - c("depth_x")) < 50),
        # sequence
        "major_gap_from_prev": F.coalesce(c("major") - c("p_major"), F.lit(0)), "major_gap_to_next": F.coalesce(c("n_major") - c("major"), F.lit(0)), "depth_change_from_prev": F.coalesce(c("depth") - c("p_depth"), F.lit(0)),
        "is_logical_next": F.when(c("first"), 1).otherwise(c("is_next")), "next_is_logical_successor": c("next_is"), "extended_sequence_score": c("extended_score"),
        # vertical gap
        "vertical_gap_from_prev_px": c("gap"), "vertical_gap_from_prev_pct": F.when(c("gap") >= 0, F.round(c("gap") / page_height, 6)).otherwise(-1.0), "vertical_gap_z_score": F.round("gap_z", 6), "has_large_vertical_gap": F.coalesce("large", F.lit(0)), "has_small_vertical_gap": F.coalesce("small", F.lit(0)),
        # box
        "bbox_left_px": c("x_left"), "bbox_top_px": c("y_top"), "bbox_width_px": c("w"), "bbox_height_px": c("h"), "bbox_left_pct": _part(c("x_left"), page_width), "bbox_right_pct": _part(right, page_width), "bbox_width_pct": _part(c("w"), page_width), "bbox_center_x_pct": _part(c("x_left") + c("w") / 2, page_width),
        "bbox_top_pct": _part(c("y_top"), page_height), "bbox_bottom_pct": _part(bottom, page_height), "bbox_height_pct": _part(c("h"), page_height), "bbox_center_y_pct": _part(c("y_top") + c("h") / 2, page_height), "x_deviation_from_median": _part(c("x_left") - c("x_median"), c("x_dev")),
        "y_deviation_from_median": _part(c("y_top") - c("y_median"), c("y_dev")), "x_deviation_from_depth_median": _part(c("x_left") - c("depth_x"), c("depth_x_dev")), "is_near_left_margin": _flag(c("x_left") / page_width < 0.15), "is_indented": _flag(c("x_left") / page_width > 0.10),
        "is_in_header_zone": _flag(y_pct < 0.10), "is_in_footer_zone": _flag(y_pct > 0.90),
        "x_position_relative": _part(c("x_left"), page_width), "y_position_relative": _part(c("y_top"), page_height), "width_relative": _part(c("w"), page_width),
        # title
        "title_length_chars": chars, "title_length_words": n_words, "title_length_z_score": _part(chars - c("len_median"), c("len_dev")), "title_is_empty": _flag(blank), "title_starts_capital": _flag(t.rlike(r"^\p{Lu}")), "title_is_all_caps": _flag(upper), "title_is_title_case": _flag(titled),
        "title_starts_with_article": _flag(first.isin("the", "a", "an", "this", "that")), "title_starts_with_imperative": _flag(first.isin(*IMPERATIVES)), "title_starts_with_month": _flag(month),
        # dates
        "section_num_is_possible_day": _flag(day), "title_starts_with_month_pattern": _flag(starts_month), "title_is_month_year": _flag(month_year), "looks_like_date": _flag(day & (starts_month | month_year)), "title_has_date_pattern": _flag(t.rlike(r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b")),
        # words
        "title_has_parenthetical": _flag(t.rlike(r"\([^)]*\)")), "title_has_section_keyword": _flag(key), "title_has_major_section_keyword": _flag(major_key), "is_major_with_keyword": _flag((c("depth") == 1) & major_key), "is_major_without_keyword": _flag((c("depth") == 1) & ~major_key),
        "title_avg_word_length": _part(F.aggregate(ws, F.lit(0), lambda a, b: a + F.length(b)), n_words),
        # length
        "title_suspiciously_long": _flag(chars > 100), "title_very_long": _flag(chars > 200), "title_absurdly_long": _flag(chars > 500), "title_too_many_words": _flag(n_words > 10), "title_sentence_length": _flag(n_words > 15), "title_has_newline": _flag(F.contains(t, F.lit("\n"))), "title_newline_count": count(r"[^\n]", t),
        "title_sentence_break_count": F.size(F.regexp_extract_all(t, F.lit(r"\.\s+[A-Z]"), F.lit(0))), "title_has_multiple_sentences": _flag(t.rlike(r"\.\s+[A-Z]")),
        # blank
        "title_is_whitespace_only": _flag((t != "") & blank), "title_is_truly_empty": _flag(t == ""), "title_is_blank": _flag(blank), "title_is_very_short": _flag(short), "title_is_punctuation_only": _flag(punct), "title_is_numeric_only": _flag(digits), "title_is_useless": _flag(useless),
        # language
        **{k: F.when(t == "", 0).otherwise(F.coalesce(c(k), F.lit(0))) if language is not None and k in language.columns else F.lit(0) for k in LANGUAGE},
        # height
        "relative_height": F.round(rel, 6), "height_is_multiline": _flag(tall & (c("h") > c("h_median") * 1.8)), "height_is_very_tall": _flag(tall & (c("h") > c("h_median") * 3)),
        # page
        "page_position_y_pct": F.round(y_pct, 6), "is_in_bottom_third": _flag(y_pct > 0.67), "is_in_bottom_quarter": _flag(y_pct > 0.75), "late_page_bad_sequence": _flag((y_pct > 0.67) & (c("is_next") == 0) & ~c("first")), "late_page_useless_title": _flag((y_pct > 0.67) & useless),
        # major
        "major_section_gt_6": _flag(c("major") > 6), "major_section_gt_10": _flag(c("major") > 10), "major_section_gt_20": _flag(c("major") > 20),
        # content
        "content_length_chars": F.length(body), "content_length_words": F.size(T.words(body)), "content_is_empty": _flag(T.py_strip(body) == ""), "title_to_content_ratio": F.when(F.length(body) > 0, F.round(chars / F.length(body), 6)).when(chars == 0, 0.0).otherwise(999.0),
        # contents page
        "in_toc_exact": _flag(c("in_toc")), "toc_fuzzy_score": c("toc_score"), "parent_in_toc": _flag(c("toc_parent")),
        # position
        "page_number": c("page"), "page_number_normalized": _part(c("page"), c("pages")), "sequence_position": c("idx"), "sequence_position_normalized": _part(c("idx"), c("n_sections")), "sections_on_same_page": c("same_page"),
        # scores
        "in_logical_sequence": F.when(c("first") | c("last"), F.when(c("first"), 1).otherwise(c("is_next"))).otherwise(c("both")), "sequence_fit_score": c("fit_score"), "format_consistency_score": c("format_score"), "title_quality_score": T.title_quality(t),
    }
    y = x.select("doc", "seq", *[v.alias(k) for k, v in out.items()])
    score = sum((c(k).cast("int") * w for k, w in WEIGHTS.items()), F.when(c("title_quality_score") > 0.5, 0.1).otherwise(0.0) + F.when(c("had_text_before_number") == 0, 0.1).otherwise(-0.1))
    return y.withColumn("combined_confidence", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 6))
