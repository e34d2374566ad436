"""Text helpers and heading detection as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names and their short forms.
MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|jun|jul|aug|sep|sept|oct|nov|dec"
#: Units that make a leading number a measurement.
UNITS_STRONG = (
    "hz khz mhz ghz thz mv kv vdc vac vrms rms ma ka ua mw kw kva kvar var ohm ohms kohm mohm db dbm dbi dbc dbw ms us ns ps sec secs second seconds msec usec nsec "
    "min mins minute minutes hr hrs hour hours mm cm km mil mils nm um micron microns mg kg lb lbs oz psi psia psig kpa mpa bar torr rpm hp gpm cfm percent pct kb mb gb tb "
    "bps kbps mbps gbps baud ppm mah ah wh kwh deg rad mrad sr %"
).split()
#: Units that do so only behind a plain value.
UNITS_WEAK = "v a w s m c f k g n in ft pa j t".split()
#: Words that make it a cross-reference.
LINK_WORDS = ("and", "or", "thru", "through", "&")
#: Words kept small in headings.
MINOR_WORDS = ("a", "an", "and", "as", "at", "but", "by", "for", "in", "nor", "of", "on", "or", "per", "the", "to", "vs", "via", "with")
#: Words typical of section titles.
TITLE_KEYWORDS = ("introduction", "scope", "requirements", "overview", "summary", "description", "specification", "interface", "design", "test", "general", "system", "software", "hardware", "definitions", "references")
MAX_MAJOR = 90


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def py_strip(s: Column) -> Column:
    return F.regexp_replace(s, r"^\s+|\s+$", "")


def words(s: Column) -> Column:
    """Words parted by any white space; none for null or blank."""
    return F.filter(F.split(F.coalesce(s, F.lit("")), r"\s+"), lambda w: w != "")


def repeat_signature(s: Column) -> Column:
    """Lower case, digit runs as #, everything that is no letter, digit or # as one blank."""
    t = F.regexp_replace(F.lower(s), r"\d+", "#")
    t = F.regexp_replace(t, r"[^\p{L}\p{N}_#]+", " ")
    return F.trim(t)


def clean_junk(s: Column) -> Column:
    """Drop marks that scanning leaves before a number: at most five of them, without blanks."""
    junk = F.regexp_extract(s, r"^([\s.`'\"‘’“”:\-;|!*#@^,~•·]+)(?=[0-9IVXivx])", 1)
    return F.when((junk != "") & (F.length(py_strip(junk)) <= 5), F.substring(s, F.length(junk) + 1, F.length(s))).otherwise(s)


def split_title(s: Column) -> Column:
    """(title, remainder) at the first separator: a double dash, a spaced - ~ or =, a sentence's period."""
    def cut(pattern: str) -> tuple[Column, Column]:
        return F.regexp_extract(s, pattern, 1), F.regexp_extract(s, pattern, 2)

    dash_t, dash_r = cut(r"(?s)^(.*?)\s+(?:--|—|––)\s+(.*)$")
    one_t, one_r = cut(r"(?s)^(.*?)\s+[-~=]\s+(.*)$")
    dot_t, dot_r = cut(r"(?s)^(.*?\.)(?=\s+[A-Z][a-z])(.*)$")
    short = F.regexp_replace(dot_t, r"\.$", "").rlike(r"(?:^|\s)(?:[A-Z]|Dr|Mr|Mrs|Ms|Jr|Sr|Inc|Ltd|etc|vs|Vol|No|Fig)$")
    pair = lambda t, r: F.struct(py_strip(t).alias("title"), py_strip(r).alias("remainder"))
    return (
        F.when(s.rlike(r"\s+(?:--|—|––)\s+"), pair(dash_t, dash_r))
        .when(s.rlike(r"\s+[-~=]\s+") & (F.length(one_t) >= 3), pair(one_t, one_r))
        .when((dot_t != "") & ~short, pair(dot_t, dot_r))
        .otherwise(pair(s, F.lit("")))
    )


def measurement_reason(number: Column, topic: Column) -> Column:
    """Why a numbered line is no heading: `cross_reference`, `unit_measurement` or null."""
    first = F.lower(F.get(words(topic), F.lit(0)))
    unit = F.regexp_replace(first, r"[^a-z%]", "")
    plain = F.regexp_replace(number, r"^(\d*)\.?(\d*)$", "$1$2").rlike(r"^\d+$")
    return (
        F.when(first.isin(*LINK_WORDS), "cross_reference")
        .when(unit.isin(*UNITS_STRONG), "unit_measurement")
        .when(unit.isin(*UNITS_WEAK) & plain, "unit_measurement")
    )


def heading(line: Column) -> Column:
    """struct(ok, number, topic, remainder, reason): whether a line is a numbered heading, and if not, why.

    Number, then title: arabic, annex-letter or roman numbers, with or without a blank, or a dotted number within
    the line. The reasons are tested in a fixed order and the first that holds is given."""
    from quirefold.functions import numbers as N

    arabic, annex, roman = r"[0-9]+(?:[.\-,][0-9]+)*[.\-,]?[A-Za-z]?", r"[A-Z]\.[0-9]+(?:\.[0-9]+)*\.?", r"[IVXLC]+(?:\.[0-9]+)*\.?"
    forms = [
        rf"^\s*((?:{arabic}|{annex}|{roman}))\s+(.+)",
        r"^\s*([0-9]+(?:[.\-,][0-9]+)*\.?)([A-Z][a-z].+)",
        rf"^\s*((?:{arabic}|{annex}|{roman}))\s*$()",
        r"(?:^|[:\s])([0-9]+(?:\.[0-9]+)+)\s+([A-Z][A-Za-z].*?)(?:\.|$)",
    ]

    def matched(t: Column) -> Column:
        out = None
        for p in forms:
            pair = F.struct(F.regexp_extract(t, p, 1).alias("raw"), F.regexp_extract(t, p, 2).alias("topic"))
            out = F.when(t.rlike(p), pair) if out is None else out.when(t.rlike(p), pair)
        return out

    def numbered(m: Column) -> Column:
        raw = m["raw"]
        lead = F.regexp_extract(raw, r"^([^.]*)", 1)
        rest = F.regexp_replace(F.regexp_replace(raw, r"^[^.]*", ""), r"\.+$", "")
        number = F.coalesce(F.concat(N.roman_to_int(lead).cast("string"), rest), N.normalise(raw))
        return F.struct(raw.alias("raw"), number.alias("number"), F.regexp_replace(F.trim(number), r"\.+$", "").alias("final"), split_title(m["topic"]).alias("cut"))

    def judged(x: Column) -> Column:
        number, final, title = x["number"], x["final"], x["cut"]["title"]
        zero = F.forall(F.split(final, r"\."), lambda p: F.coalesce(p.try_cast("long") == 0, F.lit(False)))
        big = F.coalesce(F.get(F.split(final, r"\."), F.lit(0)).try_cast("long") > MAX_MAJOR, F.lit(False))
        reason = (
            F.when(x["raw"].isNull(), "no_regex_match")
            .when(~number.rlike(r"\d"), "no_digits")
            .when(F.length(number) > 30, "too_long")
            .when(zero, "zero_section")
            .when(big, "major_section_too_large")
            .when(title == "", "empty_topic")
            .when(F.size(words(title)) >= 13, "topic_too_long")
            .when(F.lower(title).rlike(rf"\b(?:{MONTHS})\b"), "contains_month")
            .when(~title.rlike("[a-zA-Z]"), "numbers_and_punctuation_only")
            .otherwise(measurement_reason(final, title))
        )
        return F.struct(x.alias("x"), reason.alias("reason"))

    def told(y: Column) -> Column:
        ok, x = y["reason"].isNull(), y["x"]
        return F.struct(ok.alias("ok"), F.when(ok, x["final"]).alias("number"), F.when(ok, x["cut"]["title"]).alias("topic"), F.when(ok, x["cut"]["remainder"]).alias("remainder"), y["reason"].alias("reason"))

    return let(clean_junk(F.coalesce(line, F.lit(""))), lambda t: let(matched(t), lambda m: let(numbered(m), lambda x: let(judged(x), told))))


def initial_caps(s: Column) -> Column:
    """Each word with a capital; short all-capital words and words with digits stay, minor words are small
    unless first."""
    def one(w: Column, i: Column) -> Column:
        cap = F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 10_000)))
        return F.when(w.rlike(r"\d"), w).when(w.rlike("^[A-Z]{2,4}$"), w).when((i > 0) & F.lower(w).isin(*MINOR_WORDS), F.lower(w)).otherwise(cap)

    return F.array_join(F.transform(words(s), one), " ")


def title_quality(title: Column) -> Column:
    """0 to 1: how much a text looks like a title."""
    n, k = F.length(title), F.size(words(title))
    key = F.lit(False)
    for w in TITLE_KEYWORDS:
        key = key | F.lower(title).contains(w)
    score = (
        F.when(n.between(2, 50), 0.3).when(n.between(51, 100), 0.1).otherwise(0.0)
        + F.when(k.between(1, 8), 0.3).when(k.between(9, 15), 0.1).otherwise(0.0)
        + F.when(title.rlike(r"^\p{Lu}"), 0.1).otherwise(0.0)
        + F.when(title.rlike(r"\.\s+[A-Z]"), 0.0).otherwise(0.1)
        + F.when(key, 0.2).otherwise(0.0)
    )
    return F.when(title.isNull() | (F.trim(title) == ""), 0.0).otherwise(F.least(F.lit(1.0), F.round(score, 6)))
