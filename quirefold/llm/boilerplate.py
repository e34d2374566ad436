"""Lines repeated across one source's documents.

Text is reduced to letters (case folded, letters that scanning confuses made one) and cut into chunks where the
rolling hash of the content is smallest among its REACH neighbours on either side, so that a cut depends on the
letters around it alone; line ends end a chunk too, as the result is by line. For each source
the distinct documents of every chunk are counted. Lines of repeated chunks are candidates; an exact check
then counts documents by whole line, brings in scan-damaged forms that share a chunk and differ by one or
two letters, and keeps lines in at least MIN_DOCS documents and MIN_SHARE of the source's documents. Forms, not
copies, are compared, so that a chunk in a third of all rows costs no more than the forms it stands in.

Only hashes of repeated chunks are sent to workers, MAX_HOT of them at a time: if there are more, the pages are
read once for each part of the sources. Null and empty texts have no lines, pages without a source belong to no
source, pages without a stem are documents of their own; repeated rows count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.functions.stems import stem_key
from quirefold.llm.mixing import source_key
from quirefold.session import written

MIN_LETTERS, MIN_DOCS, MIN_SHARE = 20, 5, 0.1
#: A chunk is repeated from this part of the documents that a line needs, as copies may be damaged.
SLACK = 0.5
WINDOW = 6
#: Places on either side of a cut whose rolling hashes are no smaller.
REACH = 7
#: A line is a candidate from this part of its letters in repeated chunks.
LEAST_PART = 0.1
MAX_HOT = 2_000_000
#: Pages handled at once; arrays of so many stay in the processor's cache.
SLICE = 256
MAX_BROADCAST = 200_000
#: Letters and digits that scanning takes for one another, each class under one letter.
CONFUSED = {"a": "o", "c": "e", "q": "g", "f": "t", "h": "b", "i": "l"}
CONFUSED_DIGITS = {"0": "o", "1": "l", "5": "s", "6": "b", "8": "b"}

_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_BINV = np.uint64(pow(int(_B), -1, 1 << 64))
_TABLES: dict = {}


def _fold_table() -> np.ndarray:
    if "fold" not in _TABLES:
        t = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if chr(c).isalpha():
                t[c] = c
        for a, b in CONFUSED.items():
            t[ord(a)] = ord(b)
        d = np.zeros(128, np.uint32)
        for a, b in CONFUSED_DIGITS.items():
            d[ord(a)] = ord(b)
        _TABLES.update(fold=t, digit=d)
    return _TABLES["fold"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _low(x: np.ndarray, own: np.ndarray) -> np.ndarray:
    """For each place the smallest of its own and the REACH next values of its line."""
    out, span = x, 1
    while span < REACH + 1:
        step = min(span, REACH + 1 - span)
        if step >= len(x):
            break
        nxt = np.where(own[step:] == own[:-step], out[step:], np.iinfo(np.uint64).max)
        out = np.concatenate((np.minimum(out[:-step], nxt), out[-step:]))
        span += step
    return out


class Lines:
    """The lines of a batch of texts: letters, chunks and hashes, all as arrays."""

    def __init__(self, texts: list[str], salts: np.ndarray, least: int = MIN_LETTERS) -> None:
        fold = _fold_table()
        a = np.frombuffer(("\x01".join(texts) + "\x01").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        code = fold[a]
        letter, digit = code > 0, (a >= 48) & (a <= 57)
        off = lambda m, k: np.concatenate((m[1:], [False])) if k > 0 else np.concatenate(([False], m[:-1]))
        lone = np.flatnonzero(digit & ~off(digit, 1) & ~off(digit, -1) & (off(letter, 1) | off(letter, -1)))
        code = code.copy()
        code[lone] = _TABLES["digit"][a[lone]]
        ends = (a == 10) | (a == 1)
        line = np.cumsum(ends) - ends
        page_end = a == 1
        line_page = (np.cumsum(page_end) - page_end)[np.flatnonzero(ends)]
        first = np.searchsorted(line_page, np.arange(len(texts)))
        self.line_page, self.line_no = line_page, np.arange(len(line_page)) - first[line_page]
        at = np.flatnonzero(code)
        c, ln = code[at], line[at]
        n = np.bincount(ln, minlength=len(line_page))
        long_ = n >= least
        keep = long_[ln]
        c, ln = c[keep], ln[keep]
        self.lines = np.flatnonzero(long_)  # lines with enough letters
        self.n = n[self.lines]
        self.letters = c
        self.start = np.concatenate(([0], np.cumsum(self.n))).astype(np.int64)
        m = len(c)
        with np.errstate(over="ignore"):
            power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(m, _B))), dtype=np.uint64)
            self._inv = np.cumprod(np.concatenate(([np.uint64(1)], np.full(m, _BINV))), dtype=np.uint64)
            self._sum = np.concatenate(([np.uint64(0)], np.cumsum(_mix(c.astype(np.uint64) + np.uint64(77)) * power[:m], dtype=np.uint64)))
        salts = salts[self.line_page[self.lines]].astype(np.uint64) if len(self.lines) else np.zeros(0, np.uint64)
        if not m:
            self.cuts = self.owner = np.zeros(0, np.int64)
            self.keys = self.sig = np.zeros(0, np.uint64)
            self.size = np.zeros(0, np.int64)
            return
        own = np.repeat(np.arange(len(self.lines)), self.n)
        # rolling hashes; windows that leave their line count as largest
        roll = np.full(m, np.iinfo(np.uint64).max, np.uint64)
        if m > WINDOW:
            h = _mix(self._hash(np.arange(m - WINDOW), np.arange(m - WINDOW) + WINDOW))
            inside = own[: m - WINDOW] == own[WINDOW:]
            roll[: m - WINDOW][inside] = h[inside]
        cut = np.zeros(m, bool)
        cut[self.start[:-1]] = True
        starts = self.start[:-1]
        low = np.minimum(_low(roll, own), _low(roll[::-1], own[::-1])[::-1])
        cut[np.flatnonzero((roll == low) & (roll != np.iinfo(np.uint64).max)) + WINDOW // 2] = True
        b = np.flatnonzero(cut)
        e = np.concatenate((b[1:], [m]))
        self.cuts, self.owner, self.size = b, own[b], e - b
        self.keys = _mix(self._hash(b, e) ^ _mix(salts[self.owner]))
        self.sig = _mix(self._hash(starts, self.start[1:]))

    def _hash(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self._sum[j] - self._sum[i]) * self._inv[i]

    def text(self, k: int) -> str:
        return self.letters[self.start[k] : self.start[k + 1]].tobytes().decode("utf-32-le", "surrogatepass")


def _pages(pages: DataFrame, fields: list[str]) -> DataFrame:
    doc = F.coalesce(stem_key(F.col("doc_stem")), F.concat(F.lit("page:"), F.col("page_id")))
    src = source_key(F.col("source"))
    return pages.select("page_id", F.xxhash64(src).alias("src"), F.xxhash64(doc).alias("doc"), src.isNotNull().alias("has"), *fields).filter("has and page_id is not null").drop("has")


def _chunk_docs(pages: DataFrame) -> DataFrame:
    """key, doc, need of each chunk of page_text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                src, doc, need, text = b.slice(at, SLICE).columns
                L = Lines(text.to_pylist(), np.asarray(src).view(np.uint64))
                page = L.line_page[L.lines][L.owner]
                docs = np.asarray(doc)[page]
                one = np.unique(L.keys ^ _mix(docs.view(np.uint64)), return_index=True)[1]
                yield pa.RecordBatch.from_arrays([pa.array(x[one]) for x in (L.keys.view(np.int64), docs, np.asarray(need)[page])], names=["key", "doc", "need"])

    x = pages.select("src", "doc", F.col("need").cast("long"), "page_text").filter("page_text is not null and page_text <> ''")
    return x.mapInArrow(run, "key long, doc long, need long")


def _candidates(pages: DataFrame, sent) -> DataFrame:
    """sent: the sorted hashes of repeated chunks, as a broadcast value. Lines of both texts that hold repeated chunks: page_id, src, doc, field, line_no, sig, letters, keys, whole."""
    schema = "page_id long, src long, doc long, field int, line_no int, sig long, letters string, keys array<long>, whole boolean"
    names = [x.split()[0] for x in schema.split(", ")]
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = sent.value
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                ids, src, doc, *texts = b.slice(at, SLICE).columns
                first = texts[0].to_pylist()
                for field, text in enumerate(texts):
                    t = first if field == 0 else [None if x == y else x for x, y in zip(text.to_pylist(), first)]
                    L = Lines([x or "" for x in t], np.asarray(src).view(np.uint64))
                    if not len(L.keys):
                        continue
                    i = np.minimum(np.searchsorted(keys, L.keys.view(np.int64)), len(keys) - 1)
                    is_hot = keys[i] == L.keys.view(np.int64)
                    part = np.bincount(L.owner, is_hot * L.size, len(L.lines)) / L.n
                    took = np.flatnonzero(part >= LEAST_PART)
                    if not len(took):
                        continue
                    lo, hi = np.searchsorted(L.owner, took), np.searchsorted(L.owner, took, "right")
                    page = L.line_page[L.lines[took]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.asarray(x)[page]) for x in (ids, src, doc)]
                        + [pa.array(np.full(len(took), field), pa.int32()), pa.array(L.line_no[L.lines[took]], pa.int32()), pa.array(L.sig[took].view(np.int64)),
                           pa.array([L.text(k) for k in took]), pa.array([L.keys[x:y][is_hot[x:y]].view(np.int64).tolist() for x, y in zip(lo, hi)], pa.list_(pa.int64())), pa.array(part[took] == 1.0)],
                        names=names,
                    )

    return pages.select("page_id", "src", "doc", "page_text", "cleaned_text").mapInArrow(run, schema)


def repeated_lines(pages: DataFrame, max_hot: int = MAX_HOT) -> DataFrame:
    """page_id, field, line_no of every copy of a line repeated in its source.

    pages: page_id, doc_stem, source, page_text, cleaned_text. Where cleaned_text equals page_text its lines
    are those of page_text."""
    p = _pages(pages, ["page_text", "cleaned_text"])
    docs = p.select("src", "doc").distinct().groupBy("src").agg(F.count("*").alias("n"))
    need = docs.select("src", F.greatest(F.lit(MIN_DOCS), F.ceil(F.col("n") * MIN_SHARE - 1e-9)).cast("long").alias("need"))
    need = written(need, "sources")
    least = need.select("src", F.greatest(F.lit(2), F.ceil(F.col("need") * SLACK)).alias("need"))
    counted = _chunk_docs(p.join(least, "src")).groupBy("key").agg(F.countDistinct("doc").alias("n"), F.max("need").alias("need"))
    hot = written(counted.filter("n >= need").select("key"), "chunks")
    parts = max(1, -(-hot.count() // max_hot))
    rows = None
    for k in range(parts):  # one part unless repeated chunks exceed what is sent to a worker
        mine = hot if parts == 1 else hot.filter(F.pmod(F.xxhash64("key"), F.lit(parts)) == k)
        keys = np.sort(np.array([r.key for r in mine.collect()], np.int64))
        if len(keys):
            sent = pages.sparkSession.sparkContext.broadcast(keys)
            got = written(_candidates(p, sent), "lines")
            sent.unpersist()  # workers hold one part at a time
            rows = got if rows is None else rows.unionByName(got)
    spark = pages.sparkSession
    if rows is None:
        return spark.createDataFrame([], "page_id long, field string, line_no int")
    if parts > 1:  # a line's chunks may lie in several parts
        rows = written(rows.groupBy("page_id", "src", "doc", "field", "line_no", "sig", "letters").agg(F.flatten(F.collect_list("keys")).alias("keys"), F.max("whole").alias("whole")), "lines")
    small = lambda df: F.broadcast(df) if df.count() <= MAX_BROADCAST else df
    by_line = rows.filter("field = 0").groupBy("src", "sig").agg(F.countDistinct("doc").alias("n"), F.first("letters").alias("canon"), F.first("keys").alias("keys"))
    known = by_line.join(small(least), "src").filter("n >= need").drop("need").join(small(need), "src")
    known = written(known.select("src", "sig", "canon", "keys", (F.col("n") >= F.col("need")).alias("sure")), "known")
    ids = ["page_id", "src", "doc", "field", "line_no", "sig"]
    exact = rows.join(small(known.select("src", "sig")), ["src", "sig"], "left_semi").select(ids)
    # forms that don't reach the number of documents by themselves may be damaged ones of another, and count for it
    other = rows.join(small(known.filter("sure").select("src", "sig")), ["src", "sig"], "left_anti").groupBy("src", "sig").agg(F.first("letters").alias("letters"), F.first("keys").alias("keys"))
    other = other.select("src", F.col("sig").alias("own"), "letters", F.explode("keys").alias("key"))
    near = other.join(small(known.select(F.explode("keys").alias("key"), "canon", "sig")), "key").filter("own <> sig")
    may = F.when(F.length("canon") >= 40, 4).otherwise(2)  # two letters, each taken for two or two taken for one
    near = near.filter((F.abs(F.length("letters") - F.length("canon")) <= may) & (F.levenshtein("letters", "canon") <= may))
    near = written(near.select("src", "own", F.col("sig").alias("as")).distinct(), "forms")
    near = rows.join(small(near), (rows.src == near.src) & (rows.sig == near.own)).select("page_id", rows.src, "doc", "field", "line_no", F.col("as").alias("sig"))
    all_ = written(exact.unionByName(near), "copies")
    enough = all_.filter("field = 0").groupBy("src", "sig").agg(F.countDistinct("doc").alias("n")).join(small(need), "src").filter("n >= need").select("src", "sig")
    found = all_.join(small(enough), ["src", "sig"], "left_semi")
    same = pages.filter("page_text = cleaned_text").select("page_id").distinct()
    first = found.filter("field = 0").select("page_id", "line_no")
    out = first.withColumn("field", F.lit("page_text")).unionByName(found.filter("field = 1").select("page_id", "line_no").withColumn("field", F.lit("cleaned_text")))
    out = out.unionByName(first.join(same, "page_id", "left_semi").withColumn("field", F.lit("cleaned_text")))
    return out.select("page_id", "field", "line_no").distinct()


def without_lines(pages: DataFrame, found: DataFrame) -> DataFrame:
    """page_id, page_text, cleaned_text without the lines found; one row per page_id."""
    drop = found.groupBy("page_id").pivot("field", ["page_text", "cleaned_text"]).agg(F.collect_set("line_no"))
    drop = drop.select("page_id", F.col("page_text").alias("d0"), F.col("cleaned_text").alias("d1"))

    def cut(text: str, gone: str):
        kept = F.filter(F.transform(F.split(text, "\n", -1), lambda l, i: F.struct(l.alias("l"), i.alias("i"))), lambda x: ~F.array_contains(F.coalesce(gone, F.array().cast("array<int>")), x["i"]))
        return F.array_join(F.transform(kept, lambda x: x["l"]), "\n")

    p = pages.select("page_id", "page_text", "cleaned_text").filter("page_id is not null").dropDuplicates(["page_id"]).join(drop, "page_id", "left")
    return p.select("page_id", F.when(F.col("d0").isNull(), F.col("page_text")).otherwise(cut("page_text", F.col("d0"))).alias("page_text"),
                    F.when(F.col("d1").isNull(), F.col("cleaned_text")).otherwise(cut("cleaned_text", F.col("d1"))).alias("cleaned_text"))
