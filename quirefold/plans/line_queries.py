"""Queries of the line, number and heading operators (S, L, P, A1, N of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.functions import numbers as N
from quirefold.functions import text as T
from quirefold.operators import lines as L
from quirefold.plans import views as V
from quirefold.sources.tables import table


def l1_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.lines(V.words(spark, d)).select("doc", "page", "line_seq", "text", "left", "top", "right", "bottom", "n_words")


def l3_conf_stats(spark: SparkSession, d: str) -> DataFrame:
    return L.lines(V.words(spark, d)).select("doc", "page", "line_seq", "conf_mean", "conf_min", "conf_max", "conf_std", "n_low")


def l4_median_height(spark: SparkSession, d: str) -> DataFrame:
    return L.median_height(L.lines(V.words(spark, d)))


def l5_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return L.paragraphs(L.lines(V.words(spark, d)))


def l6_attach_content(spark: SparkSession, d: str) -> DataFrame:
    return L.attach_content(L.elements(L.lines(V.words(spark, d))))


def l7_page_metadata(spark: SparkSession, d: str) -> DataFrame:
    return L.page_metadata(V.words(spark, d))


def s5_flatten(spark: SparkSession, d: str) -> DataFrame:
    """Each page's words as one text, empty tokens included."""
    w = V.words(spark, d).groupBy("doc", "page").agg(F.array_sort(F.collect_list(F.struct("word_idx", "text"))).alias("a"))
    return w.select("doc", "page", F.array_join(F.col("a.text"), " ").alias("page_text"))


def _lines_by_stem(spark: SparkSession, d: str) -> DataFrame:
    return L.lines(V.words(spark, d))


def a1_running_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.running_lines(_lines_by_stem(spark, d), V.PAGE_H)


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    """One asset a page, placed by the page's number, in parts of the page."""
    p = table(spark, d, "page_text", "page_id", "doc_stem").filter("page_id is not null").dropDuplicates(["page_id"])
    top = F.pmod(F.col("page_id") * 37, F.lit(80)) / 100
    return p.select(F.coalesce("doc_stem", F.lit("?")).alias("doc"), F.col("page_id").alias("page"), F.lit(0.02).alias("left"), top.alias("top"), F.lit(0.6).alias("right"), (top + 0.1).alias("bottom"))


_BOXES = "boxes AS (SELECT doc, page, 0.02 AS a_left, y AS a_top, 0.6 AS a_right, y + 0.1 AS a_bottom FROM (SELECT coalesce(doc_stem, '?') AS doc, page_id AS page, CAST((page_id * 37) % 80 AS DOUBLE) / 100 AS y FROM pg))"


def p5_drop_reasons(spark: SparkSession, d: str) -> DataFrame:
    """P2-P5 and J1 in one column: the first reason that drops a line."""
    x = _lines_by_stem(spark, d)
    return L.drop_reasons(x, L.running_lines(x, V.PAGE_H), _boxes(spark, d), V.PAGE_W, V.PAGE_H)


def j1_overlap_anti(spark: SparkSession, d: str) -> DataFrame:
    x = _lines_by_stem(spark, d)
    return x.join(L.overlapped(x, _boxes(spark, d), V.PAGE_W, V.PAGE_H), ["doc", "page", "line_seq"], "left_anti").select("doc", "page", "line_seq", "text")


def n13_headings(spark: SparkSession, d: str) -> DataFrame:
    x = _lines_by_stem(spark, d).withColumn("h", T.heading(F.trim("text")))
    return x.select("doc", "page", "line_seq", F.col("h.ok").alias("ok"), F.col("h.number").alias("number"), F.col("h.topic").alias("topic"), F.col("h.remainder").alias("remainder"), F.col("h.reason").alias("reason"))


def n1_normalize(spark: SparkSession, d: str) -> DataFrame:
    return V.sections(spark, d).select("doc", "seq", N.normalise(F.col("section_number")).alias("normalized"), N.normalise_output(F.col("section_number")).alias("normalized_output"))


def n4_parse(spark: SparkSession, d: str) -> DataFrame:
    p = N.parse(F.col("section_number"))
    return V.sections(spark, d).select("doc", "seq", F.array_join(p, ".").alias("parts"), F.size(p).alias("depth"), N.major(p).alias("major"), F.array_join(F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))), ".").alias("parent"))


def n5_valid(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("section_number")
    return V.sections(spark, d).select("doc", "seq", N.valid_strict(s).alias("strict"), N.valid_greedy(s).alias("greedy"))


def n6_decimal(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("section_number")
    return V.sections(spark, d).select("doc", "seq", N.decimal_classify(s).alias("classify"), N.decimal_strict(s).alias("strict"), N.decimal_greedy(s).alias("greedy"))


def n7_natural_sort(spark: SparkSession, d: str) -> DataFrame:
    """Distinct normalised numbers of each document in natural order."""
    x = V.sections(spark, d).select("doc", N.normalise_output(F.col("section_number")).alias("num")).distinct()
    g = x.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct(N.sort_key(F.col("num")).alias("k"), "num"))).alias("a"))
    return g.select("doc", F.array_join(F.col("a.num"), " ").alias("ordered"))


def n8_toc_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Dotted and top-level numbers in texts, read as tables of contents."""
    t = table(spark, d, "documents", "doc_id", "text").filter("text is not null")
    deep = t.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"(?<![0-9])(\d{1,2}(?:\.\d{1,3}){1,6})(?![0-9])"), 1)).alias("num"))
    deep = deep.filter(N.valid_greedy(F.col("num")) & ~N.decimal_greedy(F.col("num")))
    top = t.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"(?<![0-9.])(\d{1,2})[ \t]+[A-Za-z]"), 1)).alias("num")).filter(F.col("num").cast("int").between(1, 30))
    return deep.union(top).select("doc_id", N.normalise_output(F.col("num")).alias("num")).distinct()


def n9_roman(spark: SparkSession, d: str) -> DataFrame:
    """Roman numerals among the words of pages."""
    w = V.words(spark, d).select(F.regexp_replace("text", r"[^A-Za-z]", "").alias("token")).filter("token <> ''").distinct()
    return w.select("token", N.roman_to_int(F.col("token")).alias("value")).filter("value is not null")


def n12_units(spark: SparkSession, d: str) -> DataFrame:
    """Why a number with the words behind it is no heading."""
    w = V.words(spark, d).select("doc", "page", "line_num", "word_idx", "text")
    from pyspark.sql import Window

    x = w.withColumn("nxt", F.lead("text").over(Window.partitionBy("doc", "page", "line_num").orderBy("word_idx"))).filter(F.col("text").rlike(r"^\d+(\.\d+)*$"))
    x = x.withColumn("reason", T.measurement_reason(F.col("text"), F.col("nxt")))
    return x.groupBy("reason").agg(F.count("*").alias("n"))


def n14_signature(spark: SparkSession, d: str) -> DataFrame:
    x = _lines_by_stem(spark, d).select(T.repeat_signature(F.col("text")).alias("signature")).filter("signature <> ''")
    return x.groupBy("signature").agg(F.count("*").alias("n"))


def n15_initial_caps(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "doc_register", "title").filter("title is not null").distinct().select("title", T.initial_caps(F.col("title")).alias("caps"))


def n17_stem_keys(spark: SparkSession, d: str) -> DataFrame:
    """Two normal forms of a stem: one underscore for any run of separators, and none."""
    s = table(spark, d, "detected_asset", "doc_stem").filter("doc_stem is not null").distinct()
    return s.select("doc_stem", F.trim(F.lower(F.regexp_replace("doc_stem", r"[\s_-]+", "_"))).alias("underscored"), F.trim(F.lower(F.regexp_replace("doc_stem", r"[\s_-]+", ""))).alias("joined"))


def w12_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Plain windows of 1,000 characters with a stride of 850 over page texts."""
    p = table(spark, d, "page_text", "page_id", "page_text").filter("page_id is not null and page_text is not null").dropDuplicates(["page_id"])
    x = p.select("page_id", "page_text", F.explode(F.sequence(F.lit(0), F.greatest(F.length("page_text") - 1, F.lit(0)), F.lit(850))).alias("start_pos"))
    return x.select("page_id", "start_pos", F.substring("page_text", F.col("start_pos") + 1, F.lit(1000)).alias("chunk"))


QUERIES = {f.__name__: f for f in (
    l1_lines, l3_conf_stats, l4_median_height, l5_paragraphs, l6_attach_content, l7_page_metadata, s5_flatten, a1_running_lines, p5_drop_reasons, j1_overlap_anti, n13_headings,
    n1_normalize, n4_parse, n5_valid, n6_decimal, n7_natural_sort, n8_toc_numbers, n9_roman, n12_units, n14_signature, n15_initial_caps, n17_stem_keys, w12_chunks)}
# p5_drop_reasons covers inventory items P2-P5; it is registered under another key, as pN_ names are those of the problems
QUERIES["drop_reasons"] = QUERIES.pop("p5_drop_reasons")


def _in(words) -> str:
    return ", ".join("'" + w + "'" for w in words)


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _heading_ctes(src: str) -> str:
    """CTEs `hd(doc, page, line_seq, ok, number, topic, remainder, reason)` from `src` with a text column."""
    junk = r"^([\s.`''\"‘’“”:\-;|!*#@^,~•·]+)[0-9IVXivx]"
    arabic, annex, roman = r"[0-9]+(?:[.\-,][0-9]+)*[.\-,]?[A-Za-z]?", r"[A-Z]\.[0-9]+(?:\.[0-9]+)*\.?", r"[IVXLC]+(?:\.[0-9]+)*\.?"
    p1, p1b = rf"^\s*((?:{arabic}|{annex}|{roman}))\s+(.+)", r"^\s*([0-9]+(?:[.\-,][0-9]+)*\.?)([A-Z][a-z].+)"
    p2, p3 = rf"^\s*((?:{arabic}|{annex}|{roman}))\s*$", r"(?:^|[:\s])([0-9]+(?:\.[0-9]+)+)\s+([A-Z][A-Za-z].*?)(?:\.|$)"
    romans = ", ".join(f"'{k}': {v}" for k, v in N.roman_table().items())
    number = f"CASE WHEN rv IS NOT NULL THEN rv || regexp_replace(regexp_replace(raw, '^[^.]*', ''), '\\.+$', '') ELSE {V.norm_sql('raw')} END"
    dash, one, dot = r"^(.*?)\s+(?:--|—|––)\s+(.*)$", r"^(.*?)\s+[-~=]\s+(.*)$", r"^(.*?\.)(\s+[A-Z][a-z].*)$"
    short = r"(?:^|\s)(?:[A-Z]|Dr|Mr|Mrs|Ms|Jr|Sr|Inc|Ltd|etc|vs|Vol|No|Fig)$"
    return rf"""
    h0 AS (SELECT doc, page, line_seq, trim(text) AS t0, regexp_extract(trim(text), '{junk}', 1) AS jk FROM {src}),
    h1 AS (SELECT doc, page, line_seq, CASE WHEN jk <> '' AND length({_strip('jk')}) <= 5 THEN substr(t0, length(jk) + 1) ELSE t0 END AS t FROM h0),
    h2 AS (SELECT *, CASE WHEN regexp_matches(t, '{p1}') THEN regexp_extract(t, '{p1}', 1) WHEN regexp_matches(t, '{p1b}') THEN regexp_extract(t, '{p1b}', 1) WHEN regexp_matches(t, '{p2}') THEN regexp_extract(t, '{p2}', 1)
            WHEN regexp_matches(t, '{p3}') THEN regexp_extract(t, '{p3}', 1) END AS raw,
        CASE WHEN regexp_matches(t, '{p1}') THEN regexp_extract(t, '{p1}', 2) WHEN regexp_matches(t, '{p1b}') THEN regexp_extract(t, '{p1b}', 2) WHEN regexp_matches(t, '{p2}') THEN ''
            WHEN regexp_matches(t, '{p3}') THEN regexp_extract(t, '{p3}', 2) END AS top FROM h1),
    h3 AS (SELECT *, map {{{romans}}}[upper(regexp_extract(raw, '^([^.]*)', 1))] AS rv,
        regexp_matches(top, '\s+(?:--|—|––)\s+') AS a, regexp_matches(top, '\s+[-~=]\s+') AND length(regexp_extract(top, '{one}', 1)) >= 3 AS b,
        regexp_extract(top, '{dot}', 1) <> '' AND NOT regexp_matches(regexp_replace(regexp_extract(top, '{dot}', 1), '\.$', ''), '{short}') AS c FROM h2),
    h4 AS (SELECT *, {number} AS num, {_strip(f"CASE WHEN a THEN regexp_extract(top, '{dash}', 1) WHEN b THEN regexp_extract(top, '{one}', 1) WHEN c THEN regexp_extract(top, '{dot}', 1) ELSE top END")} AS title,
        {_strip(f"CASE WHEN a THEN regexp_extract(top, '{dash}', 2) WHEN b THEN regexp_extract(top, '{one}', 2) WHEN c THEN regexp_extract(top, '{dot}', 2) ELSE '' END")} AS rem FROM h3),
    h5 AS (SELECT *, regexp_replace(trim(num), '\.+$', '') AS fin, [w FOR w IN regexp_split_to_array(title, '\s+') IF w <> ''] AS ws FROM h4),
    h6 AS (SELECT *, CASE WHEN raw IS NULL THEN 'no_regex_match' WHEN NOT regexp_matches(num, '\d') THEN 'no_digits' WHEN length(num) > 30 THEN 'too_long'
        WHEN len([p FOR p IN string_split(fin, '.') IF coalesce(try_cast(p AS BIGINT), 1) <> 0]) = 0 THEN 'zero_section'
        WHEN coalesce(try_cast(string_split(fin, '.')[1] AS BIGINT), 0) > 90 THEN 'major_section_too_large'
        WHEN title = '' THEN 'empty_topic' WHEN len(ws) >= 13 THEN 'topic_too_long' WHEN regexp_matches(lower(title), '\b(?:{T.MONTHS})\b') THEN 'contains_month'
        WHEN NOT regexp_matches(title, '[a-zA-Z]') THEN 'numbers_and_punctuation_only' WHEN lower(ws[1]) IN ({_in(T.LINK_WORDS)}) THEN 'cross_reference'
        WHEN regexp_replace(lower(ws[1]), '[^a-z%]', '', 'g') IN ({_in(T.UNITS_STRONG)}) THEN 'unit_measurement'
        WHEN regexp_replace(lower(ws[1]), '[^a-z%]', '', 'g') IN ({_in(T.UNITS_WEAK)}) AND regexp_matches(fin, '^\d*\.?\d*$') THEN 'unit_measurement' END AS reason FROM h5),
    hd AS (SELECT doc, page, line_seq, reason IS NULL AS ok, CASE WHEN reason IS NULL THEN fin END AS number, CASE WHEN reason IS NULL THEN title END AS topic, CASE WHEN reason IS NULL THEN rem END AS remainder, reason FROM h6)"""


_SIG = r"trim(regexp_replace(regexp_replace(lower(text), '\d+', '#', 'g'), '[^\p{L}\p{N}_#]+', ' ', 'g'))"
_RUN = LINES_H = "WITH " + V.LINES + "," + _heading_ctes("lines") + rf""",
    sg AS (SELECT l.doc, l.page, l.line_seq, l.text, l.top, l."left", l."right", l.bottom, h.ok, {_SIG} AS signature, CASE WHEN top / 3300.0 <= 0.12 THEN 'top' WHEN top / 3300.0 >= 0.88 THEN 'bottom' END AS band
        FROM lines l JOIN hd h ON l.doc = h.doc AND l.page = h.page AND l.line_seq = h.line_seq),
    np AS (SELECT doc, count(DISTINCT page) AS doc_pages FROM lines GROUP BY doc),
    running AS (SELECT sg.doc, signature, band, count(DISTINCT page) AS n_pages FROM sg JOIN np ON sg.doc = np.doc WHERE band IS NOT NULL AND trim(text) <> '' AND NOT ok AND signature <> '' AND doc_pages >= 3
        GROUP BY sg.doc, signature, band, doc_pages HAVING count(DISTINCT page) >= greatest(3, doc_pages // 2))"""
_OVER = f""", {_BOXES}, ov AS (SELECT DISTINCT l.doc, l.page, l.line_seq FROM lines l JOIN boxes b ON l.doc = b.doc AND l.page = b.page
        WHERE (l."right" - l."left") * (l.bottom - l.top) > 0 AND greatest(least(l."right" / 2550.0, a_right) - greatest(l."left" / 2550.0, a_left), 0) * greatest(least(l.bottom / 3300.0, a_bottom) - greatest(l.top / 3300.0, a_top), 0)
            >= 0.6 * (l."right" / 2550.0 - l."left" / 2550.0) * (l.bottom / 3300.0 - l.top / 3300.0))"""
_MI = r"regexp_replace(trim({0}), ',', '.', 'g')"


def _out_sql(x: str) -> str:
    one = f"replace(replace(trim({x}), ',', '.'), '..', '.')"
    for _ in range(2):
        one = rf"regexp_replace({one}, '(\d)-(\d)', '\1.\2', 'g')"
    return rf"coalesce(regexp_replace({one}, '\.+$', ''), '')"


def _two_sql(n: str) -> tuple[str, str]:
    return f"len(string_split({n}, '.')) = 2", f"string_split({n}, '.')[2]"


def _valid(n: str) -> tuple[str, str]:
    p = f"string_split({n}, '.')"
    strict = rf"(regexp_matches({n}, '\d') AND CASE WHEN len({p}) = 1 THEN coalesce(try_cast({p}[1] AS INTEGER) <= 30, false) ELSE len([x FOR x IN {p} IF NOT coalesce(try_cast(x AS INTEGER) <= 50, regexp_matches(x, '^[A-Za-z]$'))]) = 0 END)"
    greedy = rf"(regexp_matches({n}, '\d') AND len({p}) >= 2 AND len([x FOR x IN {p} IF NOT coalesce(try_cast(x AS INTEGER) <= 999, regexp_matches(x, '^[A-Za-z]{{1,2}}$'))]) = 0)"
    return strict, greedy


def _greedy_decimal(n: str) -> str:
    two, s = _two_sql(n)
    return f"coalesce({two} AND try_cast(string_split({n}, '.')[1] AS INTEGER) IS NOT NULL AND try_cast({s} AS INTEGER) IS NOT NULL AND ((length({s}) >= 2 AND {s}[1] = '0') OR (length({s}) = 2 AND (try_cast({s} AS INTEGER) >= 50 OR try_cast({s} AS INTEGER) IN (25, 75, 99)))), false)"


_N = _out_sql("section_number")
_T2, _S2 = _two_sql("section_number")
_T3, _S3 = _two_sql("num")
SQL = {
    "l1_lines": f'WITH {V.LINES} SELECT doc, page, line_seq, text, "left", top, "right", bottom, n_words FROM lines',
    "l3_conf_stats": f"WITH {V.LINES} SELECT doc, page, line_seq, conf_mean, CAST(conf_min AS DOUBLE) AS conf_min, CAST(conf_max AS DOUBLE) AS conf_max, conf_std, n_low FROM lines",
    "l4_median_height": f"WITH {V.LINES} SELECT doc, page, coalesce(median(bottom - top) FILTER (bottom > top), 10.0) AS median_h FROM lines GROUP BY doc, page",
    "l5_paragraphs": f"""WITH {V.LINES}, nb AS (SELECT *, CASE WHEN lag(page) OVER w IS NULL OR lag(block_num) OVER w <> block_num OR lag(par_num) OVER w <> par_num THEN 1 ELSE 0 END AS new FROM lines WHERE trim(text) <> ''
        WINDOW w AS (PARTITION BY doc, page ORDER BY line_seq)), r AS (SELECT *, sum(new) OVER (PARTITION BY doc, page ORDER BY line_seq) - 1 AS par_seq FROM nb)
        SELECT doc, page, par_seq, string_agg(trim(text), ' ' ORDER BY line_seq) AS text, count(*) AS n_lines, min("left") AS "left", min(top) AS top, max("right") AS "right", max(bottom) AS bottom FROM r GROUP BY doc, page, par_seq""",
    "l6_attach_content": f"""WITH {V.LINES}, {_heading_ctes('lines')}, el AS (SELECT l.doc, l.page, l.text, h.ok, h.number, h.topic, row_number() OVER (PARTITION BY l.doc ORDER BY l.page, l.line_seq) - 1 AS seq
            FROM lines l JOIN hd h ON l.doc = h.doc AND l.page = h.page AND l.line_seq = h.line_seq WHERE trim(l.text) <> ''),
        o AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY seq) AS ord FROM el)
        SELECT doc, ord, min(seq) AS seq, min(page) AS page, max(number) AS section_number, max(topic) AS topic, coalesce(string_agg(text, chr(10) ORDER BY seq) FILTER (NOT ok), '') AS content FROM o GROUP BY doc, ord""",
    "l7_page_metadata": f"""WITH {V.WORDS} SELECT doc, page, count(*) AS n_words, count(DISTINCT block_num) AS n_blocks, count(DISTINCT (block_num, par_num)) AS n_pars, count(DISTINCT (block_num, par_num, line_num)) AS n_lines,
        round(avg(conf) FILTER (conf >= 0), 4) AS conf_avg, CAST(min(conf) FILTER (conf >= 0) AS DOUBLE) AS conf_min, CAST(max(conf) FILTER (conf >= 0) AS DOUBLE) AS conf_max FROM words GROUP BY doc, page""",
    "s5_flatten": f"WITH {V.WORDS} SELECT doc, page, string_agg(text, ' ' ORDER BY word_idx) AS page_text FROM words GROUP BY doc, page",
    "a1_running_lines": _RUN + " SELECT doc, signature, band, n_pages FROM running",
    "drop_reasons": _RUN + _OVER + """ SELECT s.doc, s.page, s.line_seq, s.text, CASE WHEN r.doc IS NOT NULL AND NOT ok THEN 'running' WHEN top / 3300.0 < 0.07 AND NOT ok THEN 'header_band'
        WHEN top / 3300.0 > 0.93 AND NOT ok THEN 'footer_band' WHEN ov.doc IS NOT NULL THEN 'asset' END AS reason FROM sg s LEFT JOIN running r ON s.doc = r.doc AND s.signature = r.signature AND s.band = r.band
        LEFT JOIN ov ON s.doc = ov.doc AND s.page = ov.page AND s.line_seq = ov.line_seq""",
    "j1_overlap_anti": f"WITH {V.LINES}{_OVER} SELECT doc, page, line_seq, text FROM lines l WHERE NOT EXISTS (SELECT 1 FROM ov WHERE ov.doc = l.doc AND ov.page = l.page AND ov.line_seq = l.line_seq)",
    "n13_headings": f"WITH {V.LINES}, {_heading_ctes('lines')} SELECT * FROM hd",
    "n1_normalize": f"WITH {V.SECTIONS} SELECT doc, seq, {V.norm_sql('section_number')} AS normalized, {_N} AS normalized_output FROM sections",
    "n4_parse": f"WITH {V.PARSED} SELECT doc, seq, num AS parts, depth, major, array_to_string(parts[1:depth - 1], '.') AS parent FROM parsed",
    "n5_valid": f"WITH {V.SECTIONS}, x AS (SELECT doc, seq, {_N} AS num FROM sections) SELECT doc, seq, {_valid('num')[0]} AS strict, {_valid('num')[1]} AS greedy FROM x",
    "n6_decimal": f"""WITH {V.SECTIONS}, x AS (SELECT doc, seq, section_number, {_N} AS num FROM sections) SELECT doc, seq, coalesce({_T2} AND ((length({_S2}) >= 2 AND {_S2}[1] = '0') OR try_cast({_S2} AS INTEGER) > 30), false) AS classify,
        coalesce({_T3} AND try_cast({_S3} AS INTEGER) IS NOT NULL AND length({_S3}) >= 2 AND (try_cast({_S3} AS INTEGER) > 30 OR {_S3}[1] = '0'), false) AS strict, {_greedy_decimal('num')} AS greedy FROM x""",
    "n7_natural_sort": f"""WITH {V.SECTIONS}, x AS (SELECT DISTINCT doc, {_N} AS num FROM sections) SELECT doc, string_agg(num, ' ' ORDER BY try_cast(string_split(num, '.')[1] AS INTEGER), coalesce(try_cast(string_split(num, '.')[2] AS INTEGER), -1), coalesce(try_cast(string_split(num, '.')[3] AS INTEGER), -1)) AS ordered FROM x GROUP BY doc""",
    "n9_roman": f"WITH {V.WORDS}, t AS (SELECT DISTINCT regexp_replace(text, '[^A-Za-z]', '', 'g') AS token FROM words) SELECT token, map {{{', '.join(f'{chr(39)}{k}{chr(39)}: {v}' for k, v in N.roman_table().items())}}}[upper(token)] AS value FROM t WHERE token <> '' AND map {{{', '.join(f'{chr(39)}{k}{chr(39)}: {v}' for k, v in N.roman_table().items())}}}[upper(token)] IS NOT NULL",
    "n12_units": f"""WITH {V.WORDS}, x AS (SELECT text, lead(text) OVER (PARTITION BY doc, page, line_num ORDER BY word_idx) AS nxt FROM words), y AS (SELECT text, [w FOR w IN regexp_split_to_array(lower(nxt), '\\s+') IF w <> ''][1] AS w FROM x WHERE regexp_matches(text, '^\\d+(\\.\\d+)*$'))
        SELECT CASE WHEN w IN ({_in(T.LINK_WORDS)}) THEN 'cross_reference' WHEN regexp_replace(w, '[^a-z%]', '', 'g') IN ({_in(T.UNITS_STRONG)}) THEN 'unit_measurement'
            WHEN regexp_replace(w, '[^a-z%]', '', 'g') IN ({_in(T.UNITS_WEAK)}) AND regexp_matches(text, '^\\d*\\.?\\d*$') THEN 'unit_measurement' END AS reason, count(*) AS n FROM y GROUP BY 1""",
    "n14_signature": f"WITH {V.LINES}, s AS (SELECT {_SIG} AS signature FROM lines) SELECT signature, count(*) AS n FROM s WHERE signature <> '' GROUP BY signature",
    "n15_initial_caps": f"""WITH t AS (SELECT DISTINCT title, [w FOR w IN regexp_split_to_array(title, '\\s+') IF w <> ''] AS ws FROM doc_register WHERE title IS NOT NULL)
        SELECT title, array_to_string([CASE WHEN regexp_matches(w, '\\d') OR regexp_matches(w, '^[A-Z]{{2,4}}$') THEN w WHEN i > 1 AND lower(w) IN ({_in(T.MINOR_WORDS)}) THEN lower(w) ELSE upper(w[1]) || lower(substr(w, 2)) END FOR w, i IN ws], ' ') AS caps FROM t""",
    "n17_stem_keys": r"SELECT DISTINCT doc_stem, trim(lower(regexp_replace(doc_stem, '[\s_-]+', '_', 'g'))) AS underscored, trim(lower(regexp_replace(doc_stem, '[\s_-]+', '', 'g'))) AS joined FROM detected_asset WHERE doc_stem IS NOT NULL",
    "w12_chunks": "WITH p AS (SELECT DISTINCT page_id, page_text FROM page_text WHERE page_id IS NOT NULL AND page_text IS NOT NULL), x AS (SELECT page_id, page_text, unnest(range(0, greatest(length(page_text), 1), 850)) AS start_pos FROM p) SELECT page_id, CAST(start_pos AS INTEGER) AS start_pos, substr(page_text, start_pos + 1, 1000) AS chunk FROM x",
}
SQL["n8_toc_numbers"] = rf"""WITH tx AS (SELECT doc_id, regexp_extract_all(text, '[0-9.]+') AS runs, text FROM documents WHERE text IS NOT NULL),
    t1 AS (SELECT doc_id, unnest(runs) AS run FROM tx), cut AS (SELECT doc_id, unnest(regexp_extract_all(run, '[0-9]+(?:\.[0-9]+)*')) AS r FROM t1),
    deep AS (SELECT doc_id, regexp_extract(r, '^(\d{{1,2}}(?:\.\d{{1,3}}){{1,6}})$', 1) AS num FROM cut),
    top AS (SELECT doc_id, unnest(regexp_extract_all(text, '(?:^|[^0-9.])(\d{{1,2}})[ \t]+[A-Za-z]', 1)) AS num FROM tx)
    SELECT DISTINCT doc_id, num FROM deep WHERE num <> '' AND {_valid('num')[1]} AND NOT {_greedy_decimal('num')} UNION SELECT DISTINCT doc_id, num FROM top WHERE CAST(num AS INTEGER) BETWEEN 1 AND 30"""
