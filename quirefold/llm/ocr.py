"""Repair of text from scanned pages: running lines, page numbers, broken words, misread letters, paragraphs.

Lines of a page are labelled by a hidden Markov model with the states header, page number, body, break
(a body line that opens a paragraph) and footer. Its observations are layout features: place on the page, kind
of line (own title or name repeated on the document's pages, line repeated in the source, number of a page,
heading, list, blank), and how it joins the line before. It is fitted without labels by Viterbi training on all
pages (workers decode and count, only sums of counts come to the driver) and then decodes them. Labels tell running text from the rest: a running line is one labelled header or footer that repeats on
its document's pages, a page number one labelled so. Paragraphs are reassembled from the text, across pages too.

Words are counted over all pages. A rare word that one usual confusion of scanning turns into one that is RATIO times
as frequent is misread; where raw OCR is there, a low confidence lowers the ratio. A line end inside a word is
told from a hyphen of the word's own by the counts of the joined and of the hyphenated form.

A line with the document's name or number, or that tells a page's number, may stand anywhere on a page. Copies
that have lost the name, and lines repeated in the source, are looked for among the ZONE lines next to the head and
the foot of the page, such lines not counted.

Nothing is gathered by document: repeated lines are counted by (document, line), words by word, and pages are
joined to the next by (document, page number). Null and empty pages have no lines; pages without a stem are
documents of their own, pages without a source share no lines with others; repeated rows count once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.functions.stems import stem_key
from quirefold.llm.boilerplate import CONFUSED, CONFUSED_DIGITS
from quirefold.llm.mixing import source_key
from quirefold.session import counted, written

ZONE = 4
LEAST_PAGES, LEAST_DOCS = 3, 5
RATIO, LEAST_COUNT, LEAST_LENGTH = 20, 5, 4
LOW_CONF, LOW_RATIO = 50.0, 10
FIT_ROUNDS = 3
#: Misread words sent to a worker; if there are more, words of the pages are joined with them instead.
MAX_SENT = 300_000
#: Letters that a line must have to count as repeated in its source; copies may have lost some.
SHARED_LETTERS = 18
#: Edits that damage may make to a line of 20 letters or more, and to a shorter one.
EDITS, FEW_EDITS = 4, 2
#: Repeated lines whose keys (85 of each) are sent to all workers; if there are more, lines are joined with them by a shuffle.
MAX_CANONS = 5_000
#: Letters in a row that damaged forms of one line are brought together by.
GRAM = 5
#: Page numbers have so many digits at most.
NUMBER_DIGITS = 9
#: A line with more letters can't be a page number: `page N of N`, its digits read as letters.
NUMBER_LETTERS = 6 + 2 * NUMBER_DIGITS
#: What scanning makes of letters, as (read, meant).
CONFUSIONS = (
    ("c", "e"), ("o", "a"), ("f", "t"), ("l", "i"), ("q", "g"), ("b", "h"), ("ri", "n"), ("ii", "u"), ("rn", "m"), ("m", "rn"), ("cl", "d"), ("d", "cl"), ("vv", "w"),
    ("0", "o"), ("1", "l"), ("1", "i"), ("5", "s"), ("6", "b"), ("8", "b"), ("9", "g"),
)
HYPHENS = "-\xad‐¬"
STATES = ("header", "pageno", "body", "break", "footer")
HEADER, PAGENO, BODY, BREAK, FOOTER = range(5)

_DIGIT = r"[0-9lIO]"
_PAGE = re.compile(
    rf"\s*(?:p[ao]g[ec]\s+({_DIGIT}+|[ivxl]+)(?:\s+[o0]f\s+{_DIGIT}+)?|p\.\s*({_DIGIT}+|[ivxl]+)|\[\s*({_DIGIT}+|[ivxl]+)\s*\]|[-—–]\s*({_DIGIT}+|[ivxl]+)\s*[-—–]|({_DIGIT}+)\s*/\s*{_DIGIT}+|({_DIGIT}+)|([ivxl]+))\s*", re.I
)
_HEADING = re.compile(r"\s*\d{1,2}(?:\.\d{1,2})*[.)]?\s+[^\W\d_a-z]")
_BULLET = re.compile(r"\s*[-*•–—]\s+\S")
_BROKEN = re.compile(rf"([^\W\d_][\w]*(?:-[^\W_]+)*)[{HYPHENS}]\s*$")
_FIRST = re.compile(r"\s*[\"“(]*([^\W_]+(?:-[^\W_]+)*)")
_INNER_BREAK = re.compile(rf"\S+[{HYPHENS}]\s*\n\s*\S+")
_EDGE_BREAK = re.compile(rf"\S+[{HYPHENS}]\s*\Z")
_CODE = re.compile(r"\b[A-Z]{1,4}-\d[\w.]*")
_WORDS = re.compile(r"[^\W_]+(?:[-][^\W_]+)*")
_LONE = re.compile(r"(?<=[a-z])[01568](?=[a-z])|(?<=[a-z])[01568](?![0-9a-z])|(?<![0-9a-z])[01568](?=[a-z])")
_MAY_BE_LETTER = re.compile(r"[01568][a-z]|[a-z][01568]")
_FOLD = str.maketrans(CONFUSED)
_LETTERS = re.compile(r"[\W\d_]+")
_ROMAN = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9, "x": 10, "xi": 11, "xii": 12}


def fold(line: str) -> str:
    """A line's letters, those that scanning confuses made one."""
    s = line.lower()
    if _MAY_BE_LETTER.search(s):
        s = _LONE.sub(lambda m: CONFUSED_DIGITS[m.group()], s)
    return _LETTERS.sub("", s).translate(_FOLD)


_NOT_LETTERS = re.compile(r"[^\w\n]+|[\d_]+")


def lines_with(part: str, text: str) -> set[int]:
    """The numbers of the lines of a text that hold a part."""
    out, at, no, seen = set(), text.find(part), 0, 0
    while at >= 0:
        no += text.count("\n", seen, at)
        out.add(no)
        seen = at
        end = text.find("\n", at)
        at = text.find(part, end) if end >= 0 else -1
    return out


def fold_text(text: str) -> str:
    """`fold` of every line of a text, at one go."""
    s = text.lower()
    if _MAY_BE_LETTER.search(s):
        s = _LONE.sub(lambda m: CONFUSED_DIGITS[m.group()], s)
    return _NOT_LETTERS.sub("", s).translate(_FOLD)


def page_number(line: str) -> tuple[int | None, bool] | None:
    """(number, bare) if a line can only be the number of a page; bare: without any word or mark around it."""
    m = _PAGE.fullmatch(line)
    if not m:
        return None
    x = next(g for g in m.groups() if g)
    bare = m.lastindex is not None and m.lastindex >= 6
    d = re.sub("[lI]", "1", x.replace("O", "0"))
    if d.isdigit():
        return (int(d), bare) if len(d) <= NUMBER_DIGITS else None
    n = _ROMAN.get(x.lower())
    return (n, bare) if n else None


def misread_forms(word: str) -> set[str]:
    """What a word may have been before one confusion of scanning, met once or everywhere in the word."""
    out = set()
    for read, meant in CONFUSIONS:
        i = word.find(read)
        if i >= 0:
            out.add(word.replace(read, meant))
        while i >= 0:
            out.add(word[:i] + meant + word[i + len(read) :])
            i = word.find(read, i + 1)
    if any(c.isdigit() for c in word):
        out |= {g for f in list(out) if any(c.isdigit() for c in f) for read, meant in CONFUSIONS if read.isdigit() and read in f for g in [f.replace(read, meant)]}
    out.discard(word)
    return {f for f in out if not any(c.isdigit() for c in f)}


def words_in(text: str) -> list[str]:
    """Lower-case words of a text, compounds whole and in parts, codes left out."""
    out = []
    for w in _WORDS.findall(_CODE.sub(" ", text).lower()):
        out.append(w)
        if "-" in w:
            out += w.split("-")
    return out


# ---- first pass: words, and lines at the head and foot ------------------------------------------------

_PASS1 = "kind int, word string, n long, doc long, src long, page_id long, page int, line_no int, named boolean, num int"


def _count(pages: DataFrame) -> DataFrame:
    """kind 0: word, n. kind 1: lines that may be furniture (their folded letters as word). kind 2: page
    numbers (num = number less the page's place)."""
    names = [x.split()[0] for x in _PASS1.split(", ")]
    types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens: Counter = Counter()

        def flush():
            words: Counter = Counter()
            for t, n in tokens.items():
                for w in words_in(t):
                    words[w] += n
            tokens.clear()
            k = len(words)
            none = [None] * k
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(([0] * k, list(words), list(words.values()), *[none] * 7), types)], names=names)

        for b in batches:
            rows = []
            for pid, doc, src, key, page, text in zip(*[c.to_pylist() for c in b.columns]):
                tokens.update(_EDGE_BREAK.sub(" ", _INNER_BREAK.sub(" ", text)).split())
                lines, folded = text.split("\n"), fold_text(text)
                letters = folded.split("\n")
                full = [i for i, l in enumerate(lines) if l.strip()]
                name = fold((key or "").split("-")[0])
                number = next((p for p in (key or "").split("-")[1:] if p.isdigit()), None)
                nums = {i: g for i in full if len(letters[i]) <= NUMBER_LETTERS and (g := page_number(lines[i])) is not None}
                named = lines_with(name, folded) if len(name) >= 4 else set()
                if number is not None:
                    named |= {i for i in lines_with(number, text) if len(letters[i]) <= 40}
                named = {i for i in named if i not in nums and len(letters[i]) >= 4}
                edge = set()
                for side in (full, full[::-1]):
                    left = ZONE
                    for i in side:
                        if left == 0:
                            break
                        edge.add(i)
                        left -= i not in nums and i not in named
                rows += [(2, None, None, doc, src, pid, page, i, bare, n - page if page is not None else None) for i, (n, bare) in nums.items()]
                rows += [(1, letters[i], None, doc, src, pid, page, i, i in named, None) for i in sorted(edge | named) if i not in nums and len(letters[i]) >= 4]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)
            if len(tokens) > 300_000:
                yield flush()
        yield flush()

    x = pages.filter("page_text is not null and page_text <> ''").select("page_id", "doc", "src", "key", "page_number", "page_text")
    return x.mapInArrow(run, _PASS1)


def misreads(words: DataFrame, vocabulary: DataFrame, conf: DataFrame | None = None) -> DataFrame:
    """(word, meant) of the words (word, n) that are misread forms of far more frequent ones.

    conf: (word, conf), the mean confidence of words in raw OCR."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(w, n, f) for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for f in misread_forms(w)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string()))], names=["word", "n", "meant"])

    tried = words.filter((F.length("word") >= LEAST_LENGTH) & ~F.col("word").contains("-")).select("word", "n").mapInArrow(run, "word string, n long, meant string")
    got = tried.join(vocabulary.filter(F.col("n") >= LEAST_COUNT).select(F.col("word").alias("meant"), F.col("n").alias("m")), "meant")
    need = F.lit(RATIO)
    if conf is not None:
        got = got.join(conf, "word", "left")
        need = F.when(F.col("conf") < LOW_CONF, LOW_RATIO).otherwise(RATIO)
    got = got.filter(F.col("m") >= need * F.greatest("n", F.lit(1)))
    return got.groupBy("word").agg(F.max(F.struct("m", "meant")).alias("best")).select("word", F.col("best.meant").alias("meant"))


# ---- the line model ----------------------------------------------------------------------------------

N_ZONE, N_KIND, N_JOIN = 7, 8, 4
BLANK, NUMBER, BARE, OWN, SHARED, HEAD, LIST, TEXT = range(8)


def observe(lines: list[str], own: set[int], shared: set[int], numbers: dict[int, bool]) -> np.ndarray:
    """The features of a page's lines: zone, kind and join. numbers: line -> whether it is bare and unsupported."""
    full = [i for i, l in enumerate(lines) if l.strip()]
    rank = {i: k for k, i in enumerate(full)}
    n = len(full)
    out = np.zeros((len(lines), 3), np.int8)
    widths = sorted(len(lines[i].strip()) for i in full)
    wide = 0.8 * widths[(9 * n) // 10] if n else 0
    before = ""
    for i, line in enumerate(lines):
        s = line.strip()
        if not s:
            out[i] = (3, BLANK, 0)
            before = ""
            continue
        k = rank[i]
        zone = k if k < 3 and k < n - 1 - k else 6 - (n - 1 - k) if n - 1 - k < 3 else 3
        kind = OWN if i in own else SHARED if i in shared else (BARE if numbers[i] else NUMBER) if i in numbers else HEAD if _HEADING.match(line) else LIST if _BULLET.match(line) else TEXT
        closed = not before or before[-1] in ".!?:\"”)"
        out[i] = (zone, kind, 0 if s[0].islower() else 1 if not closed else 2 if len(before) >= wide else 3)
        before = s
    return out


def pack(obs: np.ndarray) -> np.ndarray:
    """A line's three features as one byte."""
    return ((obs[:, 0].astype(np.uint8) * N_KIND + obs[:, 1].astype(np.uint8)) * N_JOIN + obs[:, 2].astype(np.uint8)).astype(np.uint8)


def unpack(code: np.ndarray) -> np.ndarray:
    c = code.astype(int)
    return np.stack([c // (N_KIND * N_JOIN), c // N_JOIN % N_KIND, c % N_JOIN], -1)


class LineModel:
    """A hidden Markov model over the five states with independent features."""

    def __init__(self) -> None:
        z = np.array([[30, 20, 10, 1, .2, .2, .2], [6, 4, 2, .2, 1, 3, 30], [8, 8, 8, 80, 8, 8, 8], [8, 8, 8, 80, 8, 8, 8], [.2, .2, .2, 1, 10, 20, 30]])
        k = np.array([[.5, .2, .2, 60, 40, .5, .2, 4], [.1, 90, 8, .2, .2, .1, .1, .1], [2, .05, 1, .05, .2, .5, 2, 95], [2, .05, 1, .05, .2, 12, 6, 80], [.5, .2, .2, 60, 40, .5, .2, 4]])
        # starts small; behind an open line; behind a closed one of full width; behind a short one or a blank line
        j = np.array([[5, 30, 20, 45], [25, 25, 25, 25], [40, 30, 29, 1], [1, 6, 5, 88], [5, 30, 20, 45]])
        a = np.array([[30, 10, 40, 20, 1], [10, 2, 44, 40, 10], [.01, 2, 70, 24, 4], [.01, 2, 70, 24, 4], [.01, 40, 1, 1, 60]])
        norm = lambda m: m / m.sum(-1, keepdims=True)
        self.zone, self.kind, self.join, self.move = norm(z), norm(k), norm(j), norm(a)
        self.first = norm(np.array([30.0, 10, 30, 30, 1]))
        self.prior = [m.copy() for m in (self.zone, self.kind, self.join, self.move, self.first)]

    def scores(self, obs: np.ndarray) -> np.ndarray:
        lz, lk, lj = np.log(self.zone), np.log(self.kind), np.log(self.join)
        return (lz[:, obs[..., 0]] + lk[:, obs[..., 1]] + lj[:, obs[..., 2]]).transpose(*range(1, obs.ndim), 0)

    def decode(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """The most likely states of each page."""
        return self.paths([pack(p) for p in pages])

    def paths(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """`decode` of packed features; pages of like length are decoded together."""
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(pages)
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        lm, lf = np.log(self.move), np.log(self.first)
        scores = np.ascontiguousarray(self.scores(unpack(np.arange(N_ZONE * N_KIND * N_JOIN))).T)
        at = 0
        while at < len(order):
            top = len(pages[order[at]])
            end = at
            while end < len(order) and len(pages[order[end]]) <= top * 1.3 + 4 and end - at < 2048:
                end += 1
            ids = order[at:end]
            at = end
            n = np.array([len(pages[i]) for i in ids])  # ascending: pages that go on are those from a place on
            long_ = int(n[-1])
            if not long_:
                continue
            code = np.zeros((len(ids), long_), np.uint8)
            for r, i in enumerate(ids):
                code[r, : n[r]] = pages[i]
            code = np.ascontiguousarray(code.T)
            live = np.searchsorted(n, np.arange(long_), side="right")
            v = lf[:, None] + scores[:, code[0]]
            back = np.zeros((long_, 5, len(ids)), np.uint8)
            for t in range(1, long_):
                lo = live[t]
                u = v[:, lo:]
                best, of = u[0] + lm[0][:, None], back[t, :, lo:]
                for i in range(1, 5):
                    x = u[i] + lm[i][:, None]
                    np.copyto(of, i, where=x > best)
                    np.maximum(best, x, out=best)
                v[:, lo:] = best + scores[:, code[t, lo:]]
            s = v.argmax(0)
            path = np.zeros((long_, len(ids)), np.int8)
            every = np.arange(len(ids))
            for t in range(long_ - 1, -1, -1):
                lo = live[t]
                path[t, lo:] = s[lo:]
                if t:
                    s[lo:] = back[t, s[lo:], every[lo:]]
            path = np.ascontiguousarray(path.T)
            for r, i in enumerate(ids):
                out[i] = path[r, : n[r]]
        return out

    def counts(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """How often each state met each feature, state and beginning in the decoded pages (packed features)."""
        pages = [p for p in pages if len(p)]
        if not pages:
            return [np.zeros_like(m) for m in self.prior]
        s, obs = np.concatenate(self.paths(pages)).astype(int), unpack(np.concatenate(pages))
        begins = np.cumsum([0, *[len(p) for p in pages[:-1]]])
        goes_on = np.ones(len(s), bool)
        goes_on[begins] = False
        met = [(s, obs[:, c], m.shape[1]) for c, m in enumerate(self.prior[:3])] + [(s[:-1][goes_on[1:]], s[1:][goes_on[1:]], 5)]
        return [np.bincount(a * k + b, minlength=5 * k).reshape(5, k).astype(float) for a, b, k in met] + [np.bincount(s[begins], minlength=5).astype(float)]

    def refit(self, counts: list[np.ndarray], weight: float = 200.0) -> LineModel:
        """Mixes counts with what was believed before."""
        new = [c + weight * p for c, p in zip(counts, self.prior)]
        new[1][np.ix_([HEADER, FOOTER], [HEAD, LIST, TEXT])] *= 1e-3  # only what repeats is furniture
        self.zone, self.kind, self.join, self.move, self.first = [m / m.sum(-1, keepdims=True) for m in new]
        return self

    def fit(self, pages: list[np.ndarray], rounds: int = FIT_ROUNDS) -> LineModel:
        """Viterbi training on pages at hand: decode, count, refit."""
        packed = [pack(p) for p in pages]
        for _ in range(rounds):
            self.refit(self.counts(packed))
        return self


# ---- similar lines --------------------------------------------------------------------------------------


def _near(line: str, canon: str):
    """Whether two columns of letters differ by no more edits than damage makes."""
    may = F.when(F.length(canon) >= 20, EDITS).otherwise(FEW_EDITS)
    return (F.col(line) == F.col(canon)) | (F.abs(F.length(line) - F.length(canon)) <= may) & (F.levenshtein(line, canon, EDITS) >= 0) & (F.levenshtein(line, canon, EDITS) <= may)


def line_keys(letters: str) -> list:
    """The parts a line is cut into for `canon_keys`: EDITS + 1 of them, so that EDITS edits spare one."""
    n, k = F.length(letters), EDITS + 1
    size = F.floor(n / k).cast("int")
    longer = F.pmod(n, F.lit(k))
    out = []
    for i in range(k):
        at = size * i + F.greatest(F.lit(0), F.lit(i) - (k - longer))
        out.append(F.xxhash64(n, F.lit(i), F.substring(letters, at + 1, size + F.when(F.lit(i) >= k - longer, 1).otherwise(0))))
    return out


def canon_keys(canons: DataFrame, groups: list[str], canon: str) -> DataFrame:
    """groups, canon, key: the keys of `line_keys` that lines within EDITS edits of the canon have at least one of, for
    all their lengths and all places a part that was spared may have moved to: by no more than the edits that the
    parts before it, and those behind it, leave room for. Some 85 keys a canon."""
    k = EDITS + 1
    n, i = F.col("__n"), F.col("__i")
    more = F.length(canon) - n
    x = canons.select(*groups, canon, F.explode(F.sequence(F.greatest(F.lit(1), F.length(canon) - EDITS), F.length(canon) + EDITS)).alias("__n"))
    x = x.select("*", F.explode(F.sequence(F.lit(0), F.lit(EDITS))).alias("__i"), F.floor(n / k).cast("int").alias("__size"), F.pmod(n, F.lit(k)).alias("__longer"))
    size = F.col("__size") + F.when(F.col("__i") >= k - F.col("__longer"), 1).otherwise(0)
    at = F.col("__size") * F.col("__i") + F.greatest(F.lit(0), F.col("__i") - (k - F.col("__longer")))
    x = x.select(*groups, canon, "__n", "__i", size.alias("__size"), F.explode(F.sequence(at + F.greatest(-i, more - (EDITS - i)), at + F.least(i, more + (EDITS - i)))).alias("__at")).filter((F.col("__at") >= 0) & (F.col("__at") + F.col("__size") <= F.length(canon)))
    return x.select(*groups, canon, F.xxhash64("__n", "__i", F.substring(canon, F.col("__at") + 1, F.col("__size"))).alias("key")).distinct()


# ---- all of it ---------------------------------------------------------------------------------------


class Repair:
    """The operator: tables of labels, running lines, page numbers, broken words and misread words."""

    def __init__(self, pages: DataFrame, conf: DataFrame | None = None, max_sent: int = MAX_SENT) -> None:
        """pages: page_id, doc_stem, page_number, source, page_text. conf: (word, conf) from raw OCR."""
        self.max_sent = max_sent
        key = stem_key(F.col("doc_stem"))
        p = pages.filter("page_id is not null").select("page_id", key.alias("key"), "page_number", "source", "page_text").dropDuplicates(["page_id"])
        self.pages = p.select("page_id", F.xxhash64(F.coalesce("key", F.concat(F.lit("page:"), "page_id"))).alias("doc"), F.when(source_key(F.col("source")).isNotNull(), F.xxhash64(source_key(F.col("source")))).alias("src"), "key", "page_number", "page_text")
        parts = written(_count(self.pages), "parts")
        self.words = written(parts.filter("kind = 0").groupBy("word").agg(F.sum("n").alias("n")), "words")
        self.conf = conf
        self.dictionary = written(misreads(self.words, self.words, conf), "misreads")
        edge = parts.filter("kind = 1").select("page_id", "doc", "src", F.coalesce("page", "page_id").alias("page"), "line_no", F.col("word").alias("letters"), "named")
        # own lines: repeated on the document's pages, with its name or number
        by = edge.groupBy("doc", "letters").agg(F.countDistinct("page").alias("n"), F.avg(F.col("named").cast("int")).alias("named"))
        hot = written(by.filter((F.col("n") >= LEAST_PAGES) & (F.col("named") >= 0.5)).select("doc", F.col("letters").alias("canon")), "own")
        own = edge.join(hot, "doc").filter(_near("letters", "canon"))
        # a document's line may be damaged on so many pages that no form is on three: forms that share some letters in a row
        # on three pages have their first form for a canon, and those near it count together
        rare = written(edge.filter("named").join(hot.select("doc").distinct(), "doc", "left_anti").select("doc", "page", "letters").distinct(), "rare")
        gram = F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length("letters") - (GRAM - 1), F.lit(1))), lambda i: F.xxhash64(F.substring("letters", i, F.lit(GRAM))))))
        grams = rare.withColumn("gram", gram)
        lead = grams.groupBy("doc", "gram").agg(F.min("letters").alias("canon"), F.count_distinct("page").alias("n")).filter(F.col("n") >= LEAST_PAGES)
        pair = grams.join(lead.select("doc", "gram", "canon"), ["doc", "gram"]).select("doc", "page", "letters", "canon").distinct().filter(_near("letters", "canon"))
        full = pair.groupBy("doc", "canon").agg(F.count_distinct("page").alias("n")).filter(F.col("n") >= LEAST_PAGES)
        pair = pair.join(full.select("doc", "canon"), ["doc", "canon"], "left_semi")
        own = own.select("page_id", "line_no").union(edge.join(pair.select("doc", "letters").distinct(), ["doc", "letters"], "left_semi").select("page_id", "line_no")).distinct()
        # lines repeated in documents of the source, and copies that damage has left near them
        sourced = edge.filter("src is not null")
        shared = sourced.filter(F.length("letters") >= SHARED_LETTERS).groupBy("src", "letters").agg(F.count_distinct("doc").alias("n")).filter(F.col("n") >= LEAST_DOCS)
        shared, got = counted(shared.select("src", F.col("letters").alias("canon")), "shared", n=F.count(F.lit(1)))
        canon = canon_keys(shared, ["src"], "canon")
        # the planner can't tell how many keys a line has: only few lines are sent to all workers
        canon = F.broadcast(canon) if got["n"] <= MAX_CANONS else canon.hint("merge")
        loose = sourced.filter(F.length("letters") >= SHARED_LETTERS - EDITS).select("page_id", "line_no", "src", "letters", F.explode(F.array(*line_keys("letters"))).alias("key")).join(canon, ["src", "key"])
        loose = loose.filter((F.abs(F.length("letters") - F.length("canon")) <= EDITS) & (F.levenshtein("letters", "canon", EDITS) >= 0)).select("page_id", "line_no").distinct()
        shared = loose.join(own, ["page_id", "line_no"], "left_anti")
        # page numbers: bare ones need others with the same distance to their page's place in the document
        nums = parts.filter("kind = 2").select("page_id", "doc", F.coalesce("page", "page_id").alias("page"), "line_no", F.col("named").alias("bare"), F.col("num").alias("gap"))
        gaps = nums.groupBy("doc", "gap").agg(F.countDistinct("page").alias("n"))
        nums = nums.join(gaps, ["doc", "gap"], "left").select("page_id", "line_no", (F.col("bare") & ~((F.col("n") >= 2) | F.coalesce(F.col("gap").between(0, 20), F.lit(False)))).alias("odd"))
        mark = lambda df, kind: df.select("page_id", F.struct(F.lit(kind).alias("k"), "line_no").alias("m"))
        marks = mark(own, OWN).union(mark(shared, SHARED)).union(mark(nums.filter("not odd"), NUMBER)).union(mark(nums.filter("odd"), BARE))
        marks = marks.groupBy("page_id").agg(F.collect_list("m").alias("marks"))  # lines of one page
        marked = self.pages.join(marks, "page_id", "left").filter("page_text is not null and page_text <> ''").select("page_id", "doc", "page_number", "page_text", "marks")
        self.marked = written(marked.mapInArrow(_observer, "page_id long, doc long, page_number int, page_text string, marks array<struct<k:int,line_no:int>>, obs binary"), "pages")
        self.model = self._fit()
        self.lines = written(self._label(), "lines")

    def _fit(self) -> LineModel:
        """Workers decode all pages and count, the driver adds up their counts."""
        got = self.marked.select("obs")
        model = LineModel()
        for _ in range(FIT_ROUNDS):
            parts = [np.frombuffer(r.counts) for r in got.mapInArrow(_counter(model), "counts binary").collect()]  # one small row a task
            ends = np.cumsum([m.size for m in model.prior])[:-1]
            total = sum(parts, np.zeros(sum(m.size for m in model.prior)))
            model.refit([c.reshape(m.shape) for c, m in zip(np.split(total, ends), model.prior)])
        return model

    def _label(self) -> DataFrame:
        """page_id, doc, page_number, labels by line; the misread words of each line; line ends inside words; and
        the first words of the page's running text."""
        schema = ("page_id long, doc long, page_number int, labels array<int>, misread array<struct<line_no:int,word:string,meant:string>>, "
                  "broken array<struct<line_no:int,a:string,b:string,b_line:int>>, tail struct<line_no:int,a:string>, head array<struct<line_no:int,word:string>>")
        pages = self.marked.select("page_id", "doc", "page_number", "page_text", "obs")
        if self.dictionary.count() <= self.max_sent:
            words = {r.word: r.meant for r in self.dictionary.collect()}
            return pages.mapInArrow(_labeller(self.spark, self.model, words), schema)
        # too many for a worker: the words of the pages are joined with them; words too frequent to be misread are left out
        top = self.words.agg(F.max("n")).first()[0]
        common = [r.word for r in self.words.filter(F.col("n") * min(RATIO, LOW_RATIO) > top).collect()]  # at most the words that make up a text: total / (top / ratio)
        x = written(pages.mapInArrow(_labeller(self.spark, self.model, None, frozenset(common)), schema), "words")
        hit = x.select("page_id", F.explode("misread").alias("m")).select("page_id", "m.line_no", "m.word").join(self.dictionary, "word")
        hit = hit.groupBy("page_id").agg(F.collect_list(F.struct("line_no", "word", "meant")).alias("misread"))
        return x.drop("misread").join(hit, "page_id", "left").select(*[c.split()[0] for c in ("page_id", "doc", "page_number", "labels", "misread", "broken", "tail", "head")])

    @property
    def spark(self) -> SparkSession:
        return self.pages.sparkSession

    def breaks(self) -> DataFrame:
        """page_id, line_no, a, b, b_page, b_line, broken: line ends with a hyphen, and whether they break a word."""
        inner = self.lines.select("page_id", F.explode("broken").alias("x")).select("page_id", "x.line_no", "x.a", "x.b", F.col("page_id").alias("b_page"), "x.b_line")
        tail = self.lines.filter("tail is not null").select("page_id", "doc", (F.col("page_number") + 1).alias("page_number"), "tail.line_no", "tail.a")
        head = self.lines.filter("size(head) > 0").select(F.col("page_id").alias("b_page"), "doc", "page_number", "head")
        # a page scanned more than once: its versions that begin alike count once
        head = head.groupBy("doc", "page_number", F.transform("head", lambda h: h["word"]).alias("words")).agg(F.min(F.struct("b_page", "head")).alias("h")).select("doc", "page_number", "h.b_page", "h.head")
        over = tail.join(head, ["doc", "page_number"])
        # the running text of the next page goes on with a small letter
        over = over.withColumn("h", F.coalesce(F.get(F.filter("head", lambda h: F.lower(F.substring(h["word"], 1, 1)) == F.substring(h["word"], 1, 1)), F.lit(0)), F.get("head", F.lit(0))))
        over = over.select("page_id", "line_no", "a", F.col("h.word").alias("b"), "b_page", F.col("h.line_no").alias("b_line"))
        x = inner.unionByName(over).filter("b is not null")
        x = x.withColumn("la", F.lower("a")).withColumn("lb", F.lower("b"))
        small = F.col("lb") == F.col("b")
        fits = F.col("b").rlike(r"^\p{L}") & (small | (F.upper("b") == F.col("b")) & (F.upper("a") == F.col("a")) & (F.length("a") > 1))
        x = x.withColumn("joined", F.concat("la", "lb")).withColumn("whole", F.concat("la", F.lit("-"), "lb")).withColumn("fits", fits)
        x = written(x, "ends")
        pairs = x.filter("fits").select("la", "lb", "joined", "whole").distinct()
        v = self.words
        for c, n in (("joined", "n_joined"), ("whole", "n_whole"), ("la", "n_a"), ("lb", "n_b")):
            pairs = pairs.join(v.select(F.col("word").alias(c), F.col("n").alias(n)), c, "left")
        pairs = pairs.fillna(0, ["n_joined", "n_whole", "n_a", "n_b"])
        real = (F.col("n_a") >= LEAST_COUNT) & (F.col("n_b") >= LEAST_COUNT)
        pairs = pairs.withColumn("yes", F.when((F.col("n_joined") > 0) | (F.col("n_whole") > 0), F.col("n_joined") >= F.col("n_whole")).otherwise(~real))
        return x.join(pairs.select("la", "lb", "yes"), ["la", "lb"], "left").select("page_id", "line_no", "a", "b", "b_page", "b_line", "joined", (F.col("fits") & F.coalesce("yes", F.lit(False))).alias("broken"))

    def found(self) -> DataFrame:
        """page_id, line_no, kind."""
        x = self._edge_kinds()
        ends = written(self.breaks(), "breaks")
        hyphen = ends.filter("broken").select("page_id", "line_no", F.lit("hyphen").alias("kind"))
        fixed = self.lines.select("page_id", F.explode("misread").alias("m")).select("page_id", "m.line_no")
        return x.unionByName(hyphen).unionByName(fixed.union(self._joined_misreads(ends)).select("page_id", "line_no", F.lit("misread").alias("kind"))).distinct()

    def _edge_kinds(self) -> DataFrame:
        marked = self.marked.select("page_id", F.explode("marks").alias("m")).select("page_id", "m.line_no", F.col("m.k").alias("k"))
        state = self.lines.select("page_id", F.posexplode("labels").alias("line_no", "label")).filter(F.col("label").isin(HEADER, FOOTER, PAGENO))
        x = state.join(marked.filter(F.col("k") != SHARED), ["page_id", "line_no"])
        kind = F.when((F.col("k") == OWN) & (F.col("label") != PAGENO), "running").when((F.col("k") != OWN) & (F.col("label") == PAGENO), "pageno")
        return x.select("page_id", "line_no", kind.alias("kind")).filter("kind is not null")

    def _joined_misreads(self, ends: DataFrame) -> DataFrame:
        """Lines that hold the misread part of a word broken at a line end, or of a compound parted there."""
        broken = ends.filter("broken").select("page_id", "line_no", "b_page", "b_line", "joined", F.length("a").alias("la"))
        new = broken.select(F.col("joined").alias("word")).distinct().join(self.words, "word", "left_anti").withColumn("n", F.lit(1).cast("long"))
        fix = misreads(new, self.words).union(self.dictionary.join(broken.select(F.col("joined").alias("word")).distinct(), "word", "left_semi"))
        hit = broken.join(fix, broken.joined == fix.word)
        # the first letter that differs tells the part
        same = F.aggregate(F.sequence(F.lit(1), F.length("word")), F.lit(0), lambda n, i: F.when((n == i - 1) & (F.substring("word", i, F.lit(1)) == F.substring("meant", i, F.lit(1))), i).otherwise(n))
        first = F.when(same < F.col("la"), True).otherwise(False)
        one = hit.select(F.when(first, F.col("page_id")).otherwise(F.col("b_page")).alias("page_id"), F.when(first, F.col("line_no")).otherwise(F.col("b_line")).alias("line_no"))
        own = ends.filter("not broken")
        parts = own.select("page_id", "line_no", F.lower("a").alias("word")).union(own.select(F.col("b_page"), "b_line", F.lower("b"))).withColumn("word", F.explode(F.split("word", "-")))
        return one.union(parts.join(self.dictionary, "word", "left_semi").select("page_id", "line_no"))

    def paragraphs(self) -> DataFrame:
        """page_id, par_no, goes_on, text: readable paragraphs; goes_on: the next page's first paragraph continues it."""
        ends = written(self.breaks(), "breaks")
        fixes = misreads(ends.filter("broken").select(F.col("joined").alias("word")).distinct().withColumn("n", F.lit(1).cast("long")), self.words)
        ends = ends.filter("broken").join(fixes, F.col("joined") == F.col("word"), "left")
        mine = ends.groupBy("page_id").agg(F.collect_list(F.struct("line_no", "a", "b", F.col("meant"), (F.col("b_page") == F.col("page_id")).alias("here"), "b_line")).alias("joins"))
        gone = ends.filter("b_page <> page_id").groupBy(F.col("b_page").alias("page_id")).agg(F.first(F.struct("b_line", "b")).alias("gone"))
        x = self.marked.select("page_id", "page_text").join(self.lines.select("page_id", "labels", "misread"), "page_id").join(mine, "page_id", "left").join(gone, "page_id", "left")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = []
                for r in b.to_pylist():
                    pars, goes_on = reassemble(r["page_text"], r["labels"], r["misread"] or [], r["joins"] or [], r["gone"])
                    rows += [(r["page_id"], i, goes_on and i == len(pars) - 1, t) for i, t in enumerate(pars)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.bool_(), pa.string()))], names=["page_id", "par_no", "goes_on", "text"])

        return x.mapInArrow(run, "page_id long, par_no int, goes_on boolean, text string")


def _marks(marks) -> tuple[set[int], set[int], dict[int, bool]]:
    own, shared, numbers = set(), set(), {}
    for m in marks or ():
        k, i = m["k"], m["line_no"]
        if k == OWN:
            own.add(i)
        elif k == SHARED:
            shared.add(i)
        else:
            numbers[i] = k == BARE
    return own, shared, numbers


def _observer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages with the features of their lines, packed."""
    for b in batches:
        for at in range(0, b.num_rows, 2000):
            x = b.slice(at, 2000)
            obs = [pack(observe(t.split("\n"), *_marks(m))).tobytes() for t, m in zip(x.column("page_text").to_pylist(), x.column("marks").to_pylist())]
            yield pa.RecordBatch.from_arrays([*x.columns, pa.array(obs, pa.binary())], names=[*x.schema.names, "obs"])


def _counter(model: LineModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(sum(m.size for m in model.prior))
        for b in batches:
            obs = [np.frombuffer(o, np.uint8) for o in b.column(0).to_pylist()]
            total += np.concatenate([c.ravel() for c in model.counts(obs)])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])

    return run


def _labeller(spark: SparkSession, model: LineModel, words: dict[str, str] | None, common: frozenset[str] = frozenset()):
    """words: the misread words and what they mean; None: all words but the common ones are told, for a join."""
    sent = spark.sparkContext.broadcast((model, words, common))
    types = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.struct([("line_no", pa.int32()), ("word", pa.string()), ("meant", pa.string())])),
             pa.list_(pa.struct([("line_no", pa.int32()), ("a", pa.string()), ("b", pa.string()), ("b_line", pa.int32())])), pa.struct([("line_no", pa.int32()), ("a", pa.string())]), pa.list_(pa.struct([("line_no", pa.int32()), ("word", pa.string())]))]
    names = ["page_id", "doc", "page_number", "labels", "misread", "broken", "tail", "head"]

    def one(text: str, lines: list[str], path: np.ndarray, words: dict[str, str] | None, common: frozenset[str]):
        # line ends with a hyphen, and the line of running text behind each
        text_lines = [i for i, s in enumerate(path.tolist()) if s in (BODY, BREAK) and lines[i].strip()]
        broken, tail, loose = [], None, set()
        for k, i in enumerate(text_lines):
            m = _BROKEN.search(lines[i])
            if not m:
                continue
            loose.add((i, -1))
            if k + 1 < len(text_lines):
                j = text_lines[k + 1]
                f = _FIRST.match(lines[j])
                if k + 2 < len(text_lines) and f and not f.group(1)[0].islower() and not m.group(1).isupper():
                    # a line of another kind may stand between the parts
                    g = _FIRST.match(lines[text_lines[k + 2]])
                    if g and g.group(1)[0].islower():
                        j, f = text_lines[k + 2], g
                if f:
                    broken.append({"line_no": i, "a": m.group(1), "b": f.group(1), "b_line": j})
                    loose.add((j, 0))
                if k + 3 >= len(text_lines) and (not f or not f.group(1)[0].islower()):
                    tail = {"line_no": i, "a": m.group(1)}  # only lines of another kind follow: the rest may be on the next page
            else:
                tail = {"line_no": i, "a": m.group(1)}
        head = [{"line_no": i, "word": f.group(1)} for i in text_lines[:3] if (f := _FIRST.match(lines[i]))]
        seen = set(_WORDS.findall(text.lower()))
        seen |= {p for w in seen if "-" in w for p in w.split("-")}
        hits = words.keys() & seen if words is not None else {w for w in seen if len(w) >= LEAST_LENGTH} - common
        found = []
        if hits:
            first = text_lines[0] if text_lines else -1
            for i, line in enumerate(lines):
                if path[i] == PAGENO:
                    continue
                ws = [w for w in _WORDS.findall(_CODE.sub(" ", line).lower())]
                lo = 1 if ws and ((i, 0) in loose or i == first and line.lstrip()[:1].islower()) else 0
                hi = len(ws) - 1 if (i, -1) in loose else len(ws)
                found += [{"line_no": i, "word": p, "meant": words[p] if words is not None else None} for w in ws[lo:hi] for p in ([w] if w in hits else w.split("-")) if p in hits]
        return broken, tail, head, found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, words, common = sent.value
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                ids, docs, nums, texts, obs = b.slice(at, 2000).columns
                texts = texts.to_pylist()
                split = [t.split("\n") for t in texts]
                paths = model.paths([np.frombuffer(o, np.uint8) for o in obs.to_pylist()])
                got = [one(t, l, p, words, common) for t, l, p in zip(texts, split, paths)]
                cols = [ids, docs, nums, [p.tolist() for p in paths], [g[3] for g in got], [g[0] for g in got], [g[1] for g in got], [g[2] for g in got]]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, types)], names=names)

    return run


def _as(meant: str, like: str) -> str:
    return meant.upper() if like.isupper() and len(like) > 1 else meant.capitalize() if like[:1].isupper() else meant


def reassemble(text: str, labels: list[int], misread: list[dict], joins: list[dict], gone: dict | None) -> tuple[list[str], bool]:
    """A page's paragraphs, and whether the last goes on on the next page."""
    lines = text.split("\n")
    fix: dict[int, dict[str, str]] = {}
    for m in misread:
        fix.setdefault(m["line_no"], {})[m["word"]] = m["meant"]
    end = {j["line_no"]: j for j in joins}
    start = {j["b_line"]: j for j in joins if j["here"]}
    pars: list[str] = []
    goes_on, glue, new = False, False, True
    for i, line in enumerate(lines):
        s = line.strip()
        if not s:
            new = True
            continue
        if labels[i] not in (BODY, BREAK):
            continue
        if i in fix:
            s = re.sub(r"[^\W_]+", lambda m: _as(fix[i][m.group().lower()], m.group()) if m.group().lower() in fix[i] else m.group(), s)
        if i in start:
            s = s[s.find(start[i]["b"]) + len(start[i]["b"]) :] if start[i]["b"] in s[: len(start[i]["b"]) + 3] else s
        elif gone and gone["b_line"] == i:
            s = s[s.find(gone["b"]) + len(gone["b"]) :].lstrip() if gone["b"] in s[: len(gone["b"]) + 3] else s
        if i in end:
            j = end[i]
            whole = j["a"] + j["b"]
            cut = s.rstrip().rstrip(HYPHENS)
            s = cut[: len(cut) - len(j["a"])] + (_as(j["meant"], whole) if j["meant"] else whole)
        if not s.strip():
            continue
        opens = new or labels[i] == BREAK and not glue
        if pars and not opens:
            pars[-1] += ("" if glue else " ") + (s if glue else s.strip())
        else:
            pars.append(s.strip())
        glue, new = i in end and end[i]["here"], False
        goes_on = i in end and not end[i]["here"] or pars[-1][-1] not in ".!?:\"”)"
    return pars, goes_on
