"""Pieces of oversized texts, cut at natural boundaries with an overlap.

Every text, whether a row or a file nobody loads whole, is cut by ranges. A range has a halo of the text behind it,
one chunk_size long, so that a worker sees every boundary (paragraph, sentence, clause, word end) a piece that
begins in its range can end at. A worker

1. makes the range's boundary map: for each place where the first piece of the range may begin, where the path of
   pieces from there first begins behind the range, and how many pieces begin inside it; paths soon run together, so
   maps are kept as steps. Boundaries that depend on a run (blanks, closing marks) from before the range are mapped
   for every state the run may be in, and the range tells how it passes that state on;
2. maps are stitched: those of a block of ranges are composed in parallel, blocks are chained, and every
   range of a block gets its first piece's place, its number and, from the lengths summed up so far, its offset;
3. pieces are emitted by offset from each range and its halo.

Cuts: a piece ends at the last paragraph end in the second half of what it may hold, else the last sentence
end there, else clause end, else word end, else the last of these (in that order) in the first half, else
hard at the limit, never before a combining mark if that can be helped. The next piece starts `overlap`
characters before the cut. Null and empty texts give no pieces, blank ones count as text. chunk_size null or
below 1 means 1200; overlap null or below 0 means 150; an overlap not below chunk_size can't be met, it counts
as half of chunk_size.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.operators.grouped import fold_groups
from quirefold.session import written
from quirefold.sources.byte_ranges import byte_ranges

CHUNK_SIZE, OVERLAP = 1200, 150
#: A range of a row's text holds so many chunk_sizes, and so many characters at least.
SPAN, RANGE = 4, 1024
#: Ranges whose maps are composed in one block.
BLOCK = 256

#: The marks that end a stretch.
MARKS = ".!?;:,。！？、，；।"
_SPLIT = re.compile(rf"[\s{MARKS}]+")
ENDS, CLOSERS = ".!?…", "\"'”’»)]"
FULL_ENDS, FULL_CLOSERS = "。！？।", "」』”’\"）》"
_PARA = re.compile(r"\n[^\S\n]*\n\s*")
_SENT = re.compile(rf"[{ENDS}]+[{re.escape(CLOSERS)}]*(?=\s)|[{FULL_ENDS}]+[{re.escape(FULL_CLOSERS)}]*")
_CLAUSE = re.compile(r"[;:,](?=\s)|[、，；]")
_WORD = re.compile(r"\s+")
_MARK = regex.compile(r"\p{M}+")
CLASSES = ("paragraph", "sentence", "clause", "word")
#: What may come before a range, as the shortest text with the same effect: nothing, blanks with no, one or more
#: line ends, a sentence end of either kind that closing marks may follow.
STATES = ("", " ", "\n", "\n\n", ".", "。")
_RUN = set(ENDS + CLOSERS + FULL_ENDS + FULL_CLOSERS)


def sizes(chunk_size: int | None, overlap: int | None) -> tuple[int, int]:
    """The chunk size and overlap that hold for a row."""
    size = chunk_size if chunk_size is not None and chunk_size >= 1 else CHUNK_SIZE
    over = overlap if overlap is not None and overlap >= 0 else OVERLAP
    return size, over if over < size else size // 2


class Cutter:
    """Cuts of a window of text; offsets are those of the window. `lead`: the state before it. `ends`: the
    window ends the text; else its last boundaries may be cut off, and its end is none."""

    def __init__(self, text: str, size: int, over: int, ends: bool = True, lead: str = "") -> None:
        self.text, self.size, self.over, self.n, self.ends = text, size, over, len(text), ends
        k, seen = len(lead), lead + text
        self.tables = [[p for m in r.finditer(seen) if 0 < (p := m.end() - k) and (ends or p < self.n)] for r in (_PARA, _SENT, _CLAUSE, _WORD)]
        self.marks = [(m.start(), m.end()) for m in _MARK.finditer(text)] if not text.isascii() else []
        self._mark_starts = [a for a, _ in self.marks]

    def _hard(self, low: int, limit: int) -> int:
        """The limit, or where the marks that combine over it begin, if that is behind low."""
        i = bisect_right(self._mark_starts, limit) - 1
        if i >= 0 and self.marks[i][1] > limit and self.marks[i][0] - 1 > low:
            return self.marks[i][0] - 1
        return limit

    def cut(self, start: int) -> tuple[int, str]:
        """Where the piece from start ends, and at what kind of boundary."""
        if self.n - start <= self.size and self.ends:
            return self.n, "end"
        limit, low = start + self.size, start + self.over
        half = max(low, start + self.size // 2)
        for least, below in ((half, limit), (low, half)):
            for kind, table in zip(CLASSES, self.tables):
                i = bisect_right(table, below)
                if i and table[i - 1] > least:
                    return table[i - 1], kind
        return self._hard(low, limit), "hard"

    def cuts(self, upto: int) -> np.ndarray:
        """The cuts from all starts below upto; -1 where the piece ends the text."""
        s = np.arange(upto)
        limit, low = s + self.size, s + self.over
        half = np.maximum(low, s + self.size // 2)
        out = np.zeros(upto, np.int64)
        for least, below in ((half, limit), (low, half)):
            for table in self.tables:
                if table:
                    t = np.array([-1, *table])
                    got = t[np.searchsorted(t, below, "right") - 1]
                    out = np.where((out == 0) & (got > least), got, out)
        for x in np.flatnonzero(out == 0) if self.marks else ():
            out[x] = self._hard(int(low[x]), int(limit[x]))
        out = np.where(out == 0, limit, out)
        return np.where(self.n - s <= self.size, -1, out) if self.ends else out


def state_after(text: str) -> list[int]:
    """For each state before a text, the state after it."""
    i = len(text)
    while i and (text[i - 1] in _RUN or text[i - 1].isspace()):
        i -= 1

    def run(s: int) -> int:
        for c in text[i:]:
            if c.isspace():
                s = 3 if s == 3 or s == 2 and c == "\n" else 2 if s == 2 or c == "\n" else 1
            else:
                s = 4 if c in ENDS else 5 if c in FULL_ENDS else s if s == 4 and c in CLOSERS or s == 5 and c in FULL_CLOSERS else 0
        return s

    return [run(0)] * len(STATES) if i else [run(s) for s in range(len(STATES))]


def solid_runs(text: str) -> tuple[int, int, int]:
    """Longest stretch without white space or marks, and those at the start and the end."""
    lens = [len(x) for x in _SPLIT.split(text)]
    return max(lens), lens[0], lens[-1]


# ---- boundary maps ------------------------------------------------------------------------------------

#: A map: the first places (from the range's start) of its steps; where their paths go on behind the range
#: (from its end; -1: the text ends in it); how many pieces begin in it.
Steps = tuple[list[int], list[int], list[int]]


def exit_map(win: str, core: int, size: int, over: int, ends: bool, lead: str, first: bool) -> Steps:
    """The map of a range of `core` characters at the start of win. first: the range begins the text."""
    c = Cutter(win, size, over, ends, lead)
    known: dict[int, tuple[int, int]] = {}  # places on paths: where they go on, pieces from there

    def follow(x: int, e: int) -> tuple[int, int]:
        """The same for a place x whose piece ends at e (-1: with the text)."""
        path = [x]
        x = e - over if e >= 0 else -1
        while 0 <= x < core and x not in known:
            path.append(x)
            e, how = c.cut(x)
            x = -1 if how == "end" else e - over
        out, n = known[x] if 0 <= x < core else (x - core if x >= 0 else -1, 0)
        for p in reversed(path):
            n += 1
            known[p] = (out, n)
        return out, n

    keys, k_out, k_num, last = [], [], [], None
    for s, e in enumerate(c.cuts(1 if first else min(size, core)).tolist()):
        if e == last:  # neighbours mostly end at the same place
            continue
        (out, n), last = follow(s, e), e
        if not keys or out != k_out[-1] or n != k_num[-1]:
            keys.append(s)
            k_out.append(out)
            k_num.append(n)
    return keys, k_out, k_num


def through(steps: Steps, chars: int, x: int) -> tuple[int, int]:
    """Where a path that enters at x goes on behind the range, and the pieces it leaves there."""
    if x < 0:
        return -1, 0
    if x >= chars:
        return x - chars, 0
    i = bisect_right(steps[0], x) - 1
    return steps[1][i], steps[2][i]


def compose(a: Steps, b: Steps, b_chars: int) -> Steps:
    """The map of two ranges that follow one another."""
    keys, out, num = [], [], []
    for k, x, n in zip(*a):
        y, m = through(b, b_chars, x)
        if not keys or y != out[-1] or n + m != num[-1]:
            keys.append(k)
            out.append(y)
            num.append(n + m)
    return keys, out, num


_MAPS = ("range_no long, chars long, states array<int>, alt array<int>, steps array<array<array<int>>>, "
         "solid long, head long, tail long")
_MAPS_ARROW = [("range_no", pa.int64()), ("chars", pa.int64()), ("states", pa.list_(pa.int32())), ("alt", pa.list_(pa.int32())),
               ("steps", pa.list_(pa.list_(pa.list_(pa.int32())))), ("solid", pa.int64()), ("head", pa.int64()), ("tail", pa.int64())]


def range_maps(ranges: DataFrame, key: str) -> DataFrame:
    """The boundary map of every range: its states passed on, a map for each state before it (`alt` tells which of
    `steps`), and its solid stretches."""
    kind = dict(ranges.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            keys, nos, wins, cores, ends, sz, ov = (c.to_pylist() for c in b.columns)
            for no, win, core, end, size, over in zip(nos, wins, cores, ends, sz, ov):
                text = win[:core]
                alone = not core or not (text[0] in _RUN or text[0].isspace())  # no run goes on into the range
                steps, alt = [], []
                for lead in STATES[:1] if no == 0 or alone else STATES:
                    got = [list(x) for x in exit_map(win, core, size, over, end, lead, no == 0)]
                    if got not in steps:
                        steps.append(got)
                    alt.append(steps.index(got))
                out.append((no, core, state_after(text), alt * (len(STATES) // len(alt)), steps, *solid_runs(text)))
            cols = zip(*out) if out else [[]] * len(_MAPS_ARROW)
            yield pa.RecordBatch.from_arrays([b.column(0)] + [pa.array(c, t) for c, (_, t) in zip(cols, _MAPS_ARROW)], names=[key] + [n for n, _ in _MAPS_ARROW])

    return ranges.select(key, "range_no", "win", "core", "ends", "size", "over").mapInArrow(run, f"{key} {kind}, {_MAPS}")


# ---- stitching ----------------------------------------------------------------------------------------


def _join_solid(a: tuple, b: tuple) -> tuple:
    """(longest, head, tail, chars) of two stretches of text that follow one another."""
    return max(a[0], b[0], a[2] + b[1]), a[1] + b[1] if a[1] == a[3] else a[1], a[2] + b[2] if b[2] == b[3] else b[2], a[3] + b[3]


def _block(key: tuple, rows: list[tuple]) -> list[tuple]:
    """The map of a block: as of a range."""
    states, maps, solid = list(range(len(STATES))), None, None
    for _, chars, after, alt, steps, longest, head, tail in rows:
        mine = [tuple(s) for s in steps]
        if maps is None:
            maps, solid = [mine[a] for a in alt], (longest, head, tail, chars)
        else:
            done: dict = {}
            new = []
            for m, s in zip(maps, states):
                k = (id(m), alt[s])
                if k not in done:
                    done[k] = compose(m, mine[alt[s]], chars)
                new.append(done[k])
            maps, solid = new, _join_solid(solid, (longest, head, tail, chars))
        states = [after[s] for s in states]
    distinct: list = []
    for m in maps:
        if m not in distinct:
            distinct.append(m)
    return [(*key, solid[3], states, [distinct.index(m) for m in maps], [[list(x) for x in m] for m in distinct], *solid[:3])]


def _chain(key: tuple, rows: list[tuple]) -> list[tuple]:
    """Where each block's first piece begins, the state before it, the pieces and characters before it; and, as
    block -1, the whole text's pieces, characters and longest solid stretch."""
    out, x, state, pieces, at, solid = [], 0, 0, 0, 0, (0, 0, 0, 0)
    for block, chars, after, alt, steps, longest, head, tail in rows:
        out.append((*key, block, x, state, pieces, at, None))
        x, n = through(tuple(steps[alt[state]]), chars, x)
        state, pieces, at, solid = after[state], pieces + n, at + chars, _join_solid(solid, (longest, head, tail, chars))
    return [*out, (*key, -1, x, state, pieces, at, solid[0])]


def _spread(key: tuple, rows: list[tuple]) -> list[tuple]:
    """The same for each range of a block."""
    out, (x, state, pieces, at) = [], rows[0][5:9]
    for no, chars, after, alt, steps, *_ in rows:
        y, n = through(tuple(steps[alt[state]]), chars, x)
        if n:
            out.append((key[0], no, x, state, pieces, at))
        x, state, pieces, at = y, after[state], pieces + n, at + chars
    return out


def stitch(maps: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(ranges' first pieces, texts): key, range_no, first, state, before, at; and key, pieces, chars, solid.

    maps has to be a written table, as it is read twice."""
    kind = dict(maps.dtypes)[key]
    m = maps.withColumn("block", F.floor(F.col("range_no") / BLOCK))
    cols = [c for c in maps.columns if c not in (key, "range_no")]
    blocks = fold_groups(m.select(key, "block", "range_no", *cols), [key, "block"], ["range_no"], _block, f"{key} {kind}, {_MAPS.replace('range_no', 'block')}")
    starts = written(fold_groups(blocks, [key], ["block"], _chain, f"{key} {kind}, block long, first long, state int, before long, at long, solid long"), "starts")
    texts = starts.filter("block = -1").select(key, F.col("before").alias("pieces"), F.col("at").alias("chars"), "solid")
    x = m.select(key, "block", "range_no", "chars", "states", "alt", "steps").join(starts.drop("solid"), [key, "block"])
    firsts = fold_groups(x, [key, "block"], ["range_no"], _spread, f"{key} {kind}, range_no long, first long, state int, before long, at long")
    return firsts, texts


def emit(ranges: DataFrame, firsts: DataFrame, key: str) -> DataFrame:
    """key, piece_no, start_pos, end_pos, cut, piece: the pieces that begin in each range."""
    kind = dict(ranges.dtypes)[key]
    types = [("piece_no", pa.int64()), ("start_pos", pa.int64()), ("end_pos", pa.int64()), ("cut", pa.string()), ("piece", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            held = 0
            for name, win, core, ends, size, over, first, state, before, at in zip(*[c.to_pylist() for c in b.columns]):
                c, x = Cutter(win, size, over, ends, STATES[state]), first
                while 0 <= x < core:
                    e, how = c.cut(x)
                    rows.append((name, before, at + x, at + e, how, win[x:e]))
                    held, before = held + e - x, before + 1
                    x = e - over if how != "end" else -1
                if held > 1 << 22:
                    yield out(rows)
                    rows, held = [], 0
            if rows:
                yield out(rows)

    def out(rows):
        k = pa.array([r[0] for r in rows], pa.string() if kind == "string" else pa.int64())
        return pa.RecordBatch.from_arrays([k] + [pa.array(c, t) for c, (_, t) in zip(list(zip(*rows))[1:], types)], names=[key] + [n for n, _ in types])

    x = ranges.join(firsts, [key, "range_no"]).select(key, "win", "core", "ends", "size", "over", "first", "state", "before", "at")
    return x.mapInArrow(run, f"{key} {kind}, piece_no long, start_pos long, end_pos long, cut string, piece string")


# ---- texts in rows ------------------------------------------------------------------------------------


def text_ranges(df: DataFrame, text: str, span: int | None = None) -> DataFrame:
    """The ranges of every text longer than its chunk_size: ctx_id, range_no, win (the range and its halo), core (the
    range's characters), ends, size, over. span: characters of a range, two chunk_sizes at least; by default SPAN chunk_sizes. Repeated rows of a ctx_id count once."""
    names = ["ctx_id", "range_no", "win", "core", "ends", "size", "over"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            held = 0
            for i in range(b.num_rows):
                key, t, size, over = (c[i].as_py() for c in b.columns)
                size, over = sizes(size, over)
                step = max(span or max(RANGE, SPAN * size), 2 * size)  # so that a piece never passes over a range
                for no, a in enumerate(range(0, len(t), step)):
                    rows.append((key, no, t[a : a + step + size + 2], min(step, len(t) - a), a + step + size + 2 >= len(t), size, over))
                    held += step + size
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t_) for c, t_ in zip(zip(*rows), types)], names=names)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t_) for c, t_ in zip(zip(*rows), types)], names=names)

    size = F.when(F.col("chunk_size") >= 1, F.col("chunk_size")).otherwise(CHUNK_SIZE)
    x = df.select("ctx_id", F.col(text).alias("text"), "chunk_size", "overlap").filter("ctx_id is not null").filter(F.length("text") > size).dropDuplicates(["ctx_id"])
    return x.mapInArrow(run, "ctx_id long, range_no long, win string, core int, ends boolean, size int, over int")


def split_texts(df: DataFrame, text: str = "full_context", span: int | None = None) -> DataFrame:
    """The pieces of every text longer than its chunk_size; df has ctx_id, the text, chunk_size and overlap.

    Ranges are written once: their reading spreads those of one long text over workers."""
    ranges = written(text_ranges(df, text, span), "ranges")
    firsts, _ = stitch(written(range_maps(ranges, "ctx_id"), "maps"), "ctx_id")
    return emit(ranges, firsts, "ctx_id")


def split_counts(df: DataFrame, text: str = "full_context", span: int | None = None) -> DataFrame:
    """ctx_id, size, pieces, chars, and the longest solid stretch of every text longer than its chunk_size, from the
    same ranges, maps and stitching; nothing is emitted."""
    ranges = written(text_ranges(df, text, span), "ranges")
    _, texts = stitch(written(range_maps(ranges, "ctx_id"), "maps"), "ctx_id")
    return texts.join(ranges.filter("range_no = 0").select("ctx_id", "size"), "ctx_id")


# ---- files --------------------------------------------------------------------------------------------


def file_ranges(spark: SparkSession, files: list[str], chunk_size: int, overlap: int, range_bytes: int) -> DataFrame:
    """The ranges of UTF-8 files, from byte ranges with a halo of four bytes a character; a character belongs to
    the range its first byte is in. Bytes that aren't UTF-8 are read as U+FFFD."""
    size, over = sizes(chunk_size, overlap)
    names = ["file", "range_no", "win", "core", "ends", "size", "over"]
    types = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, no, a, stop, n, raw in zip(*[c.to_pylist() for c in b.columns]):
                inner = lambda i: i < len(raw) and raw[i] & 0xC0 == 0x80
                lo = next(i for i in range(5) if i == 4 or not inner(i)) if a else 0
                hi = stop - a
                hi += next(i for i in range(5) if i == 4 or not inner(hi + i))
                end = len(raw)
                if a + end < n:  # the last character of the halo may be cut off
                    end = max(hi, end - 4)
                    while end > hi and inner(end):
                        end -= 1
                core, after = raw[lo:hi].decode("utf-8", "replace"), raw[hi:end].decode("utf-8", "replace")
                row = (file, no, core + after[: size + 2], len(core), a + end >= n and len(after) <= size + 2, size, over)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    x = byte_ranges(spark, files, range_bytes, 4 * (size + 4))
    return x.mapInArrow(run, "file string, range_no long, win string, core int, ends boolean, size int, over int")


def split_files(spark: SparkSession, files: list[str], chunk_size: int = CHUNK_SIZE, overlap: int = OVERLAP, range_bytes: int = 1 << 20) -> DataFrame:
    """Pieces of UTF-8 text files, however large: file, piece_no, start_pos, end_pos (characters), cut, piece.

    A range holds two chunk_sizes of four-byte characters at least. Bytes are read twice, for the maps and for the pieces; no worker
    holds more than a range and its halo."""
    ranges = file_ranges(spark, files, chunk_size, overlap, max(range_bytes, 8 * sizes(chunk_size, overlap)[0]))
    firsts, _ = stitch(written(range_maps(ranges, "file"), "maps"), "file")
    return emit(ranges, firsts, "file")
