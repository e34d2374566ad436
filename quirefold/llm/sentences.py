"""Sentence units across languages and scripts.

Three statistics are learned from all documents, by language and without labels, with log-likelihood ratios:
abbreviations (words that come with a period more often than chance allows, weighed against length),
sentence starters (words that follow sure sentence ends more often than elsewhere) and collocations (a word
with a period, and the word behind it, met together too often for a sentence end between them). Together they
give each word with a period one of three classes - ends a sentence, doesn't, or depends on the next word -
by which every period is classified.

Rules: a blank line ends a unit, other line breaks don't; lines of a list are units; a period behind a unit's
first number is part of its heading; marks inside quotes and brackets end nothing while the larger sentence goes on;
ideographic and danda marks end a sentence without a space; where a script has neither marks nor spaces between
words, a space between two of its words ends a unit. Null and blank texts have no units; a unit may lack its
closing mark. Repeated rows count once.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Quotes and brackets.
OPEN, CLOSE = "([{（［｛【〈《「『", ")]}）］｝】〉》」』"
QUOTES = "\"“”„‟«»"
TAILS_SET = CLOSE + QUOTES + "'’"
TAILS = re.escape(TAILS_SET)
#: Marks that end a sentence without a space behind them, and those that need one.
FREE_MARKS, MARKS = "。！？｡।॥", ".!?…؟۔"
#: Common words by which texts in Latin script without a language tag are told apart.
COMMON = {
    "en": "the of and to in is was that for with by not from on at each".split(),
    "de": "der die das und ist nicht mit von wird wurde eine den im zu auf ein".split(),
    "fr": "le la les et est une des dans pas de du en sur qui par au".split(),
    "es": "el la los y es una de del en no por con las que se un".split(),
}
#: Thresholds of the statistics; the first three are those of the published method.
ABBREVIATION, STARTER, COLLOCATION = 0.3, 30.0, 7.88
ENDS, NEVER = 0.6, 0.2
#: How often a type must be met with a period to be called an abbreviation, or one by its collocations alone,
#: and what part of its count in the language it is most common in.
LEAST_ABBREVIATION, LEAST_COLLOCATION, GUEST = 3, 20, 0.1
#: From what part of all words behind an abbreviation, met so often, one word is bound to it.
BOUND, LEAST_BOUND = 0.5, 10
#: Most types of each kind that may be sent to the workers; more is an error, nothing is left out.
MOST = 200_000
FLUSH = 400_000

_LAST = frozenset(MARKS + FREE_MARKS + CLOSE + QUOTES + "'’")
_LEAD = re.compile(rf"^[{re.escape(OPEN)}{QUOTES}'‘’¿¡\-–—]+")
_SCRIPTS = (("th", re.compile("[฀-๿]")), ("ar", re.compile("[؀-ۿ]")), ("hi", re.compile("[ऀ-ॿ]")), ("ja", re.compile("[぀-ヿ]")), ("zh", re.compile("[一-鿿]")))
_LATIN = re.compile("[A-Za-z]")
_COMMON = {k: re.compile(r"\b(?:" + "|".join(v) + r")\b", re.I) for k, v in COMMON.items()}
_NUMBER = re.compile(r"[\d.,/]*\d")


def language(lang: str | None, text: str) -> str:
    """The tag if there is one, else a guess by script and common words."""
    tag = (lang or "").strip().lower()
    if tag and tag != "und":
        return tag
    n = {k: len(r.findall(text)) for k, r in _SCRIPTS}
    best = max(n, key=n.get)
    if n[best] and n[best] * 2 >= len(_LATIN.findall(text)):
        return "ja" if best == "zh" and n["ja"] else best
    n = {k: len(r.findall(text)) for k, r in _COMMON.items()}
    return max(n, key=n.get) if any(n.values()) else "und"


def _type(token: str) -> str:
    """A word as it is counted: without what stands before it, numbers as one type."""
    t = _LEAD.sub("", token)
    return "#" if _NUMBER.fullmatch(t) else t


def _start(token: str) -> str:
    """The next word as it is counted."""
    t = _LEAD.sub("", token).rstrip(MARKS + ",;:" + CLOSE + QUOTES)
    return "#" if t and t[0].isdigit() else t


def _lower(word: str) -> bool:
    """Whether a word can't open a sentence by its case: lower, and not a mixed one like pH."""
    return bool(word) and word[0].islower() and not (len(word) > 1 and word[1].isupper())


# ---- learning ----------------------------------------------------------------------------------------

WORD, PERIOD, NEXT, START, PAIR = range(5)


def count_parts(documents: DataFrame) -> DataFrame:
    """lang, kind, a, b, n: words, words with a period, next words behind a period and behind other marks, and pairs
    of both; counted in the partitions first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        pairs: dict[str, Counter] = {}

        def flush():
            rows = []
            for lang, c in words.items():
                merged: Counter = Counter()
                for w, n in c.items():
                    s = _LEAD.sub("", w).rstrip(",;:" + CLOSE + QUOTES)
                    if s:
                        merged[(PERIOD, s[:-1]) if s.endswith(".") and len(s) > 1 else (WORD, s.rstrip(MARKS + FREE_MARKS))] += n
                rows += [(lang, k, w, "", n) for (k, w), n in merged.items()]
            for lang, c in pairs.items():
                merged = Counter()
                for (a, b), n in c.items():
                    a = a.rstrip(TAILS_SET)
                    bare = a.rstrip(MARKS + FREE_MARKS)
                    if not bare or bare == a:
                        continue
                    if a[len(bare) :] == ".":
                        merged[PAIR, _type(bare), _start(b)] += n
                    elif a[len(bare) :] in ("!", "?", "؟", "।"):
                        merged[START, "", _start(b)] += n
                rows += [(lang, k, a, b, n) for (k, a, b), n in merged.items()]
            words.clear()
            pairs.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.string(), pa.string(), pa.int64()))], names=["lang", "kind", "a", "b", "n"]) if rows else None

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                k = language(lang, text)
                tokens = text.split()
                words.setdefault(k, Counter()).update(tokens)
                pairs.setdefault(k, Counter()).update([x for x in zip(tokens, tokens[1:]) if x[0][-1] in _LAST])
            if sum(map(len, words.values())) > FLUSH and (out := flush()) is not None:
                yield out
        if (out := flush()) is not None:
            yield out

    got = documents.select("lang", "text").mapInArrow(run, "lang string, kind int, a string, b string, n long")
    return got.groupBy("lang", "kind", "a", "b").agg(F.sum("n").alias("n"))


def _ll(k, n, p):
    """Log-likelihood of k of n at probability p, as a column."""
    p = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return k * F.log(p) + (n - k) * F.log(1 - p)


def ratio(k1, n1, k2, n2):
    """Twice the log-likelihood ratio of two shares being different."""
    p = (k1 + k2) / F.greatest(n1 + n2, F.lit(1.0))
    p1, p2 = k1 / F.greatest(n1, F.lit(1.0)), k2 / F.greatest(n2, F.lit(1.0))
    return 2 * (_ll(k1, n1, p1) + _ll(k2, n2, p2) - _ll(k1, n1, p) - _ll(k2, n2, p))


def learn(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(starters: lang, word), (classes: lang, type, class): class is `ends`, `never` or `mixed`."""
    from quirefold.session import written

    parts = written(count_parts(documents), "counts")
    one = F.lit(1.0)
    word = parts.filter(F.col("kind") == WORD).select("lang", F.col("a").alias("w"), F.col("n").alias("bare"))
    period = parts.filter(F.col("kind") == PERIOD).select("lang", F.col("a").alias("w"), F.col("n").alias("dot"))
    # numbers count as one type
    num = F.when(F.col("w").rlike(r"^[\d.,/]*\d$"), F.lit("#")).otherwise(F.col("w"))
    word = word.withColumn("w", num).groupBy("lang", "w").agg(F.sum("bare").alias("bare"))
    period = period.withColumn("w", num).groupBy("lang", "w").agg(F.sum("dot").alias("dot"))
    both = written(word.join(period, ["lang", "w"], "full").select("lang", "w", F.coalesce("bare", F.lit(0)).cast("double").alias("bare"), F.coalesce("dot", F.lit(0)).cast("double").alias("dot")), "words")
    total = both.groupBy("lang").agg(F.sum("dot").alias("all_dot"), F.sum(F.col("dot") + F.col("bare")).alias("all"))
    # abbreviations
    lower = both.withColumn("t", F.lower("w")).groupBy("lang", "t").agg(F.sum("bare").alias("bare"), F.sum("dot").alias("dot"))
    a = lower.filter("dot > 0").join(F.broadcast(total), "lang")
    letters = F.greatest(F.length(F.regexp_replace("t", r"[^\p{L}\p{M}\p{N}]", "")), F.lit(1))
    score = ratio(F.col("dot"), F.col("dot") + F.col("bare"), F.col("all_dot") - F.col("dot"), F.col("all") - F.col("dot") - F.col("bare"))
    more = F.col("dot") / (F.col("dot") + F.col("bare")) > F.col("all_dot") / F.col("all")
    score = F.when(more, score * F.exp(-letters.cast("double")) * (F.length(F.regexp_replace("t", r"[^.]", "")) + 1) * F.pow(one / letters, F.col("bare"))).otherwise(0.0)
    abbr = a.select("lang", "t", score.alias("abbr"))
    # starters: words behind marks that always end a sentence, and behind long words with a period
    pair = parts.filter(F.col("kind") == PAIR).select("lang", F.col("a").alias("w"), F.col("b").alias("nxt"), F.col("n").cast("double").alias("n"))
    pair = written(pair.withColumn("t", F.lower("w")).join(abbr, ["lang", "t"], "left").fillna(0.0, ["abbr"]), "pairs")
    sure = pair.filter((F.col("abbr") < ABBREVIATION) & (F.length("t") >= 4)).select("lang", "nxt", "n").unionByName(
        parts.filter(F.col("kind") == START).select("lang", F.col("b").alias("nxt"), F.col("n").cast("double").alias("n")))
    sure = sure.filter("nxt <> '' and nxt <> '#'").groupBy("lang", "nxt").agg(F.sum("n").alias("n"))
    n_sure = sure.groupBy("lang").agg(F.sum("n").alias("all_sure"))
    seen = both.select("lang", F.col("w").alias("nxt"), (F.col("bare") + F.col("dot")).alias("seen"))
    s = sure.join(seen, ["lang", "nxt"]).join(F.broadcast(n_sure), "lang").join(F.broadcast(total.select("lang", "all")), "lang")
    s = s.withColumn("seen", F.greatest("seen", "n"))
    sll = ratio(F.col("n"), F.col("seen"), F.col("all_sure") - F.col("n"), F.col("all") - F.col("seen"))
    first = F.substring("nxt", 1, 1)
    small = (first == F.lower(first)) & (first != F.upper(first)) & ~F.col("nxt").rlike(r"^\p{Ll}\p{Lu}")
    s = s.filter((sll >= STARTER) & (F.col("n") / F.col("seen") > 2 * F.col("all_sure") / F.col("all")) & (F.col("n") / F.col("seen") >= 0.1) & ~small)
    starters = written(s.select("lang", F.col("nxt").alias("word"), sll.alias("weight")), "starters")
    # what follows each type with a period
    p = pair.join(starters.select("lang", F.col("word").alias("nxt"), F.lit(1.0).alias("starts")), ["lang", "nxt"], "left").fillna(0.0, ["starts"])
    # a next word that is most of what follows a type is its collocation, also if it may start sentences
    p = p.groupBy("lang", "t", "nxt").agg(F.sum("n").alias("n"), F.max("starts").alias("starts"), F.max("abbr").alias("abbr"))
    total_t = p.filter(F.col("abbr") >= ABBREVIATION).groupBy("lang", "t").agg(F.sum("n").alias("of")).filter(F.col("of") >= LEAST_BOUND)
    p = p.join(total_t, ["lang", "t"], "left").withColumn("starts", F.when(F.col("n") >= BOUND * F.col("of"), 0.0).otherwise(F.col("starts"))).drop("of")
    by = p.groupBy("lang", "t").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("starts")).alias("n_start"), F.max("abbr").alias("abbr"))
    # collocations: of a pair's second words that are no starters, the strongest
    nxt = pair.groupBy("lang", "nxt").agg(F.sum("n").alias("n_nxt"))
    all_pairs = pair.groupBy("lang").agg(F.sum("n").alias("all_pairs"))
    c = p.filter("starts = 0").groupBy("lang", "t", "nxt").agg(F.sum("n").alias("k")).join(by.select("lang", "t", "n"), ["lang", "t"]).join(nxt, ["lang", "nxt"]).join(F.broadcast(all_pairs), "lang")
    c = c.withColumn("col", ratio(F.col("k"), F.col("n"), F.greatest(F.col("n_nxt") - F.col("k"), F.lit(0.0)), F.greatest(F.col("all_pairs") - F.col("n"), one)))
    c = c.filter((F.col("k") / F.col("n") > F.col("n_nxt") / F.col("all_pairs"))).groupBy("lang", "t").agg(F.max("col").alias("col"))
    by = by.join(c, ["lang", "t"], "left").fillna(0.0, ["col"])
    part = F.col("n_start") / F.col("n")
    odd = (F.col("abbr") >= ABBREVIATION) & (F.col("n") >= LEAST_ABBREVIATION) | (F.col("col") >= COLLOCATION) & (F.col("n") >= LEAST_COLLOCATION)
    # a word that is far more common in another language is a guest in this one
    most = by.groupBy("t").agg(F.max("n").alias("most"))
    by = by.join(most, "t").filter(F.col("n") >= GUEST * F.col("most"))
    classes = by.filter(odd & ~F.col("t").rlike(r"[)\]}»”\"]$")).select(
        "lang", F.col("t").alias("type"), F.when(part >= ENDS, "ends").when(part <= NEVER, "never").otherwise("mixed").alias("class"), F.greatest("abbr", "col").alias("weight"))
    return starters, written(classes.filter("class <> 'ends'"), "classes")


class Model:
    """The learned sets, as the workers get them: at most MOST entries of each kind."""

    def __init__(self, starters: list[tuple[str, str]], classes: list[tuple[str, str, str]]) -> None:
        self.starts: dict[str, set[str]] = {}
        self.kinds: dict[str, dict[str, str]] = {}
        for lang, w in starters:
            self.starts.setdefault(lang, set()).add(w)
        for lang, t, c in classes:
            self.kinds.setdefault(lang, {})[t] = c
        self.any_starts = {w for s in self.starts.values() for w in s}
        self.any_kinds: dict[str, str] = {}
        for d in self.kinds.values():
            for t, c in d.items():
                self.any_kinds[t] = c if self.any_kinds.get(t, c) == c else "mixed"

    @classmethod
    def of(cls, documents: DataFrame) -> Model:
        starters, classes = learn(documents)
        s, c = starters.limit(MOST + 1).collect(), classes.limit(MOST + 1).collect()
        if max(len(s), len(c)) > MOST:
            raise ValueError(f"more than {MOST} starters or abbreviations are sent to a worker; raise MOST or split the languages")
        return cls([(r.lang, r.word) for r in s], [(r.lang, r.type, r["class"]) for r in c])

    def kind(self, lang: str, word: str) -> str:
        own = self.kinds.get(lang, {}).get(word)
        return own or self.any_kinds.get(word, "ends")

    def starter(self, lang: str, word: str) -> bool:
        return word in self.starts.get(lang, ()) or word in self.any_starts


# ---- splitting ---------------------------------------------------------------------------------------

_BLOCK = re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+")
_ITEM = re.compile(r"^[^\S\n]*(?:[-*•‣◦·–—]|\(?[a-z\d]{1,3}[.)])[^\S\n]+\S", re.M)
_BULLET = re.compile(r"[^\S\n]*[-*•‣◦·–—][^\S\n]+\S")
_MARK = re.compile(rf"[{re.escape(MARKS + FREE_MARKS)}]+[{TAILS}]*")
_SPAN = re.compile(rf"[{re.escape(OPEN + CLOSE + QUOTES)}]")
_PLAIN_SPACE = re.compile("(?<=[฀-๿຀-໿ក-៿က-႟]) +(?=[฀-๿຀-໿ក-៿က-႟])")
_PAIRS = dict(zip(OPEN, CLOSE))
_QUOTE_PAIRS = {"„": "“”", "“": "”", "«": "»", "»": "«"}


def spans(block: str) -> list[tuple[int, int, bool]]:
    """(start, end, is quote) of the outermost quoted and bracketed stretches that are closed in the block.

    Brackets are matched with a stack for each kind, quotes with the next mark that closes them."""
    marks = [(m.start(), m.group()) for m in _SPAN.finditer(block)]
    if not marks:
        return []
    closes: dict[int, int] = {}
    stacks: dict[str, list[int]] = {}
    places: dict[str, list[int]] = {}
    for i, (_, c) in enumerate(marks):
        if c in _PAIRS:
            stacks.setdefault(_PAIRS[c], []).append(i)
        elif c in CLOSE:
            if stacks.get(c):
                closes[stacks[c].pop()] = i
        else:
            places.setdefault(c, []).append(i)
    out, i = [], 0
    while i < len(marks):
        at, c = marks[i]
        if c in _PAIRS:
            j = closes.get(i, -1)
        else:
            j = -1
            for q in _QUOTE_PAIRS.get(c, '"' if c == '"' else ""):
                later = places.get(q, [])
                k = bisect_right(later, i)
                if k < len(later) and (j < 0 or later[k] < j):
                    j = later[k]
        if j < 0:
            i += 1
            continue
        out.append((at, marks[j][0] + 1, c not in "([{（［｛"))
        i = j + 1
    return out


_NEXT = re.compile(r"\s*(\S+)")
_NAME = re.compile(r"[^\W\d_]+")
#: A letter by itself, or an initial with a name or another initial behind it.
_INITIAL = re.compile(r"[^\W\d_](?:(\s)|\.\s+([^\W\d_]))")
_OPENING = re.compile(rf"[{re.escape(OPEN + QUOTES)} \n\t]*")


def _words_before(block: str, start: int, at: int, most: int) -> list[str]:
    """The last words before `at`, in order, up to so many, not before start."""
    out = []
    while len(out) < most:
        while at > start and block[at - 1].isspace():
            at -= 1
        if at == start:
            break
        begin = _word_before(block, start, at)
        out.append(block[begin:at])
        at = begin
    return out[::-1]


def _word_before(block: str, start: int, at: int) -> int:
    """Where the word that ends at `at` begins, not before start."""
    while at > start and not block[at - 1].isspace():
        at -= 1
    return at


def _continues(block: str, end: int, quote: bool, opened: bool, lang: str, model: Model) -> bool:
    """Whether a sentence goes on behind a quote or bracket that holds a closing mark at its end.

    opened: the stretch began the sentence."""
    rest = block[end:].lstrip()
    if not rest:
        return False
    free = block[end - 2] in FREE_MARKS
    if free:  # no spaces to go by: a stretch that opens a sentence is its subject, one inside it ends it if it is a quote
        return opened == quote
    if rest[0] in ",;:،、，；：.)" or _lower(_LEAD.sub("", rest)) and rest[0] not in QUOTES:
        return True
    if quote and opened and block[end - 2] in "!?…":
        return not model.starter(lang, _start(rest.split(None, 1)[0])) and rest[0] not in OPEN + QUOTES and rest[0].isalpha() and rest[0].lower() == rest[0].upper()
    return not (quote or opened)


def _period_ends(block: str, start: int, at: int, stop: int, nxt: str, lang: str, model: Model) -> bool:
    """Whether the period at `at` in the sentence from start, with the text from stop behind it, ends it."""
    begin = _word_before(block, start, at)
    if begin == at:
        return True
    token = _LEAD.sub("", block[begin:at]).rstrip(CLOSE + QUOTES)
    core = token.lower()
    w = _start(nxt)
    opens = nxt[0] in OPEN + QUOTES + "¿¡"
    starter = opens or model.starter(lang, w)
    if not token or block[at - 1] in CLOSE + QUOTES:
        return True
    if _NUMBER.fullmatch(token):
        if _OPENING.match(block, start).end() >= begin:
            return False  # the number of a heading
        return model.kind(lang, "#") == "ends" or starter or not w
    if len(token) == 1 and token.isupper():  # an initial, or a letter that names something
        return starter and not (len(w) == 1 and w.isupper()) and model.kind(lang, core) != "never"
    kind = model.kind(lang, core)
    if kind == "never":
        return False
    if w == "#" or nxt[:1].isdigit():
        return len(core) >= 4
    if kind == "mixed":
        before = _words_before(block, start, begin, 4)
        if len(before) <= 2 or len(before) > 2 and any(x.endswith(",") for x in before[-2:]) and not starter:
            return False
        initial = len(w) == 1 and w.isupper()
        if initial and len(before) > 3:
            return not any(x.endswith(",") for x in before[-3:])
        return starter
    return True


def units(text: str, lang: str, model: Model) -> list[tuple[int, int]]:
    """(start, end) of every unit of a text."""
    out: list[tuple[int, int]] = []

    def add(a: int, b: int) -> None:
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if a < b:
            out.append((a, b))

    at = 0
    blocks = []
    for m in _BLOCK.finditer(text):
        blocks.append((at, m.start()))
        at = m.end()
    blocks.append((at, len(text)))
    for a, b in blocks:
        block = text[a:b]
        if not block.strip():
            continue
        if _BULLET.match(block):  # a list: each line that begins with a bullet is a unit, with its continuation lines
            lines, p = [], 0
            for line in block.split("\n"):
                if _BULLET.match(line) or not lines:
                    lines.append([a + p, a + p + len(line)])
                else:
                    lines[-1][1] = a + p + len(line)
                p += len(line) + 1
            for x, y in lines:
                add(x, y)
            continue
        for x, y in _sentences(block, lang, model):
            add(a + x, a + y)
    return out


def _sentences(block: str, lang: str, model: Model) -> list[tuple[int, int]]:
    out, start = [], 0
    held = spans(block)
    k = 0
    thai = [] if block.isascii() else [m.start() for m in _PLAIN_SPACE.finditer(block)]
    marks = [(m.start(), m.end()) for m in _MARK.finditer(block)]
    events = sorted([(s, e, False) for s, e in marks] + [(p, p, True) for p in thai])
    for s, e, space in events:
        if s < start:
            continue
        while k < len(held) and held[k][1] <= s:
            k += 1
        if space:
            if not (k < len(held) and held[k][0] < s):
                out.append((start, s))
                start = s
            continue
        first = block[s]
        # closing marks taken in must belong to the sentence: a straight quote may open the next one
        inside = k < len(held) and held[k][0] < s < held[k][1]
        run_end = s
        while run_end < len(block) and block[run_end] in MARKS + FREE_MARKS:
            run_end += 1
        if inside:
            a, b, quote = held[k]
            if b > e or block[run_end:b].strip(TAILS_SET):
                continue  # a mark within the stretch
            end = b
            opened = not block[start:a].strip()
            if _continues(block, end, quote, opened, lang, model):
                continue
            # the stretch ends with a mark; a period may still belong to an abbreviation
            while end < len(block) and block[end] in CLOSE + "'’" and not any(x[0] == end for x in held[k : k + 3]):
                end += 1
            out.append((start, end))
            start = end
            continue
        end = run_end
        while end < e and not any(x[0] == end for x in held[k : k + 2]):
            end += 1
        if first in FREE_MARKS:
            out.append((start, end))
            start = end
            continue
        spaced = end == len(block) or block[end].isspace()
        if spaced:
            m = _NEXT.match(block, end)
            if not m:
                break
            nxt = m.group(1)
        run = block[s:run_end]
        if not spaced:
            # a sentence end without its space: a word, the mark, a capitalised word
            before, word = block[max(start, s - 1) : s], _NAME.match(block, end)
            behind = bool(before) and (before.islower() or before in CLOSE + QUOTES)
            quoted = block[end] in QUOTES + "(¿¡" and block[end + 1 : end + 2].isupper()
            # a capitalised word, or an initial with a name or another initial behind it
            initial = _INITIAL.match(block, end)
            capital = word and word.group()[0].isupper() and (len(word.group()) > 1 and word.group()[1].islower() or initial and (initial.group(1) or initial.group(2).isupper()))
            if not behind or not (quoted or capital):
                continue
            if run == "." and model.kind(lang, _LEAD.sub("", block[_word_before(block, start, s) : s]).lower()) == "never":
                continue
            out.append((start, end))
            start = end
            continue
        w = _LEAD.sub("", nxt)
        if _lower(w):
            continue
        if run.startswith("..") or run == "…":
            if not model.starter(lang, _start(nxt)):
                continue
        elif run == "." and not _period_ends(block, start, s, end, nxt, lang, model):
            continue
        elif w and w[0] in ",;:":
            continue
        out.append((start, end))
        start = end
    out.append((start, len(block)))
    return [(a, b) for a, b in out if block[a:b].strip()]


def sentence_units(documents: DataFrame, model: Model | None = None, with_text: bool = True) -> DataFrame:
    """doc_id, unit_no, start_pos, end_pos (and unit) of every unit; documents: doc_id, text, lang."""
    docs = documents.select("doc_id", "lang", "text").filter("doc_id is not null and text is not null and text <> ''")
    model = model or Model.of(docs)
    sent = documents.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, unit_no int, start_pos long, end_pos long" + (", unit string" if with_text else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                ids, langs, texts = (c.to_pylist() for c in b.slice(at, 1000).columns)
                key, no, s, e, u = [], [], [], [], []
                for i, lang, t in zip(ids, langs, texts):
                    got = units(t, language(lang, t), m)
                    key += [i] * len(got)
                    no += range(len(got))
                    s += [x for x, _ in got]
                    e += [y for _, y in got]
                    if with_text:
                        u += [t[x:y] for x, y in got]
                cols = [pa.array(key, pa.int64()), pa.array(no, pa.int32()), pa.array(s, pa.int64()), pa.array(e, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols + ([pa.array(u, pa.string())] if with_text else []), names=["doc_id", "unit_no", "start_pos", "end_pos"] + ["unit"] * with_text)

    return docs.mapInArrow(run, schema)
