"""Section numbers: normalising, parsing, validating, ordering. All are column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The small roman numerals that are read as section numbers.
ROMAN_UNITS = ("", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX")


def roman_table() -> dict[str, int]:
    """I to XXXIX."""
    return {"X" * t + u: 10 * t + i for t in range(4) for i, u in enumerate(ROMAN_UNITS) if t or i}


def roman_to_int(s: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in roman_table().items() for x in kv])
    return F.try_element_at(m, F.upper(F.trim(s)))


def normalise(raw: Column) -> Column:
    """Commas to dots, hyphens between digits to dots, runs of dots to one. Null stays null."""
    s = F.regexp_replace(raw, ",", ".")
    s = F.regexp_replace(s, r"(?<=\d)-(?=\d)", ".")
    return F.regexp_replace(s, r"\.{2,}", ".")


def normalise_output(raw: Column) -> Column:
    """The form of the validation step: trimmed, one pass over double dots, no dots at the end; null gives ''."""
    s = F.regexp_replace(F.trim(raw), ",", ".")
    s = F.regexp_replace(s, r"\.\.", ".")
    s = F.regexp_replace(s, r"(?<=\d)-(?=\d)", ".")
    return F.coalesce(F.regexp_replace(s, r"\.+$", ""), F.lit(""))


def parse(raw: Column) -> Column:
    """The leading valid parts (digits, or one or two letters) of a normalised number."""
    s = F.regexp_replace(normalise(F.coalesce(F.trim(raw), F.lit(""))), r"^\.+|\.+$", "")
    good = F.regexp_extract(s, r"^((?:\d+|[A-Za-z]{1,2})(?:\.(?:\d+|[A-Za-z]{1,2}))*)(?=\.|$)", 1)
    return F.when(good == "", F.array().cast("array<string>")).otherwise(F.split(good, r"\."))


def ints(parts: Column) -> Column:
    """Parts as integers, null where a part is no number."""
    return F.transform(parts, lambda p: p.try_cast("int"))


def major(parts: Column) -> Column:
    return F.get(ints(parts), F.lit(0))


def valid_strict(num: Column) -> Column:
    n = normalise_output(num)
    p = F.split(n, r"\.")
    single = F.coalesce(F.get(p, F.lit(0)).try_cast("int") <= 30, F.lit(False))
    many = F.forall(p, lambda x: F.coalesce(x.try_cast("int") <= 50, x.rlike("^[A-Za-z]$")))
    return n.rlike(r"\d") & F.when(F.size(p) == 1, single).otherwise(many)


def valid_greedy(num: Column) -> Column:
    n = normalise_output(num)
    p = F.split(n, r"\.")
    return n.rlike(r"\d") & (F.size(p) >= 2) & F.forall(p, lambda x: F.coalesce(x.try_cast("int") <= 999, x.rlike("^[A-Za-z]{1,2}$")))


def _two(num: Column) -> tuple[Column, Column, Column]:
    p = F.split(num, r"\.")
    second = F.get(p, F.lit(1))
    return F.size(p) == 2, second, second.try_cast("int")


def decimal_classify(num: Column) -> Column:
    """More likely a decimal than a section number, as page typing asks it."""
    two, s, v = _two(num)
    return F.coalesce(two & (s.rlike("^0.") | (v > 30)), F.lit(False))


def decimal_strict(num: Column) -> Column:
    two, s, v = _two(normalise_output(num))
    return F.coalesce(two & v.isNotNull() & (F.length(s) >= 2) & ((v > 30) | s.startswith("0")), F.lit(False))


def decimal_greedy(num: Column) -> Column:
    n = normalise_output(num)
    two, s, v = _two(n)
    first = F.get(F.split(n, r"\."), F.lit(0)).try_cast("int")
    hit = (F.length(s) >= 2) & s.startswith("0") | (F.length(s) == 2) & ((v >= 50) | v.isin(25, 75, 99))
    return F.coalesce(two & first.isNotNull() & v.isNotNull() & hit, F.lit(False))


def sort_key(num: Column) -> Column:
    """Orders numbers part by part, numeric parts before letters."""
    return F.transform(F.split(num, r"\."), lambda p: F.struct(F.when(p.rlike(r"^\d+$"), 0).otherwise(1).alias("k"), F.coalesce(p.try_cast("int"), F.lit(0)).alias("n"), F.when(p.rlike(r"^\d+$"), "").otherwise(p).alias("s")))


def logical_next(prev: Column, cur: Column) -> Column:
    """Whether parts `cur` may directly follow parts `prev`: last part plus one, a first child, or a step up
    that counts on. A part that is no number fails its test."""
    a, b = ints(prev), ints(cur)
    na, nb = F.size(prev), F.size(cur)
    heads = lambda x, n: F.slice(x, 1, F.greatest(n, F.lit(0)))
    # compare text forms, so that null parts of both sides count as equal
    key = lambda x: F.array_join(x, ".", "-")
    last_b = F.try_element_at(b, F.lit(-1))
    same = (na == nb) & (key(heads(a, na - 1)) == key(heads(b, nb - 1))) & (last_b == F.try_element_at(a, F.lit(-1)) + 1)
    child = (nb == na + 1) & (key(heads(b, nb - 1)) == key(a)) & (last_b == 1)
    up = (nb < na) & (key(heads(a, nb - 1)) == key(heads(b, nb - 1))) & (last_b == F.get(a, nb - 1) + 1)
    return (F.coalesce(na > 0, F.lit(False)) & (nb > 0)) & (F.coalesce(same, F.lit(False)) | F.coalesce(child, F.lit(False)) | F.coalesce(up, F.lit(False)))
