"""Evaluation texts leaking into training text.

Every window of eight words of every test item is a pattern of one Aho-Corasick automaton over squeezed
text (letters and digits only, case folded), so capitals, punctuation, spacing and words broken at a line end
don't matter. Each document is scanned once. Hits of following windows at following places join to stretches,
stretches are chained in the item's order, and an item counts as leaked where the best chain holds at least a
third of its words. Offsets are mapped to the original text for documents with hits only.

The items are a fixed set: their text is sent to the workers and may not exceed MAX_ITEM_CHARS; more items go
in several calls. Null and empty texts hold nothing; repeated rows count once; items under eight words have no
stretch and are never found.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

STRETCH = 8
SHARE = 1 / 3
MAX_ITEM_CHARS = 4 << 20
_JUNK = re.compile(r"[\W_]+")
_CACHE: dict = {}


def squeeze(text: str) -> str:
    return _JUNK.sub("", text.casefold())


def offsets(text: str) -> list[int]:
    """For each squeezed character the place of the one it came from."""
    out: list[int] = []
    for i, c in enumerate(text):
        out.extend([i] * len(_JUNK.sub("", c.casefold())))
    return out


def words_of(text: str) -> list[str]:
    return [s for w in text.split() if (s := squeeze(w))]


def automaton(items: dict[int, str], stretch: int = STRETCH):
    """(automaton, words by item, squeezed offset of each word by item)."""
    import ahocorasick

    a, where = ahocorasick.Automaton(), defaultdict(list)
    words = {k: words_of(t) for k, t in items.items()}
    for k, ws in words.items():
        for i in range(len(ws) - stretch + 1):
            where["".join(ws[i : i + stretch])].append((k, i))
    for p, hits in where.items():
        a.add_word(p, (len(p), hits))
    if where:
        a.make_automaton()
    at = {}
    for k, ws in words.items():
        at[k] = [0]
        for w in ws:
            at[k].append(at[k][-1] + len(w))
    return a if where else None, words, at


def best_chain(runs: list[tuple[int, int, int]], n_words: int, least: int) -> tuple[int, int, int, int]:
    """runs: (place in the document, first word, last word + 1). The most words that pieces of runs, each of
    `least` words or more, hold in the item's order; with it the place of the first run, and the last run's
    place and end word.

    ends[e] is the best chain so far that ends at or before word e; a run is entered where that pays most."""
    ends = [(0, -1, -1, -1)] * (n_words + 1)
    for p, a, b in sorted(runs):
        new, pick = {}, (-1, 0, (0, -1, -1, -1))
        for e in range(a + least, b + 1):
            x = e - least
            if ends[x][0] - x > pick[0] - pick[1] or pick[0] < 0:
                pick = (ends[x][0], x, ends[x])
            v, first = pick[0] + e - pick[1], pick[2][1]
            new[e] = (v, p if first < 0 else first, p, e)
        top = ends[0]
        for e in range(n_words + 1):
            top = max(top, ends[e], new.get(e, ends[0]), key=lambda t: t[0])
            ends[e] = top
    return ends[-1]


def scan(text: str, auto, words, at, stretch: int = STRETCH, share: float = SHARE) -> list[tuple[int, int, int, int]]:
    """(item, words held, start, end in the original text) of each item that text holds."""
    squeezed = squeeze(text)
    hits: dict[int, set[tuple[int, int]]] = defaultdict(set)
    for end, (n, found) in auto.iter(squeezed):
        for k, i in found:
            hits[k].add((end - n + 1, i))
    out, places = [], None
    for k, got in hits.items():
        runs = []
        for p, i in sorted(got, key=lambda x: x[1]):
            if (p - (at[k][i] - at[k][i - 1]), i - 1) in got if i else False:
                continue
            j, q = i, p
            while (q + at[k][j + 1] - at[k][j], j + 1) in got:
                q, j = q + at[k][j + 1] - at[k][j], j + 1
            runs.append((p, i, j + stretch))
        n, first, last, e = best_chain(runs, len(words[k]), stretch)
        if n >= share * len(words[k]):
            places = places or offsets(text)
            a = next(a for p, a, b in runs if p == last and a < e <= b)
            out.append((k, n, places[first], places[last + at[k][e] - at[k][a] - 1] + 1))
    return out


def find_leaks(documents: DataFrame, items: dict[int, str]) -> DataFrame:
    """doc_id, item_id, n_words, n_item_words, start_pos, end_pos of every document that holds an item."""
    if sum(map(len, items.values())) > MAX_ITEM_CHARS:
        raise ValueError(f"more than {MAX_ITEM_CHARS} characters of items; give them in several calls")
    key = hash(tuple(sorted(items.items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _CACHE.get("key") != key:
            _CACHE.update(key=key, built=automaton(items))
        auto, words, at = _CACHE["built"]
        for b in batches:
            rows = []
            if auto is not None:
                for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if t:
                        rows += [(i, k, n, len(words[k]), s, e) for k, n, s, e in scan(t, auto, words, at)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "item_id", "n_words", "n_item_words", "start_pos", "end_pos"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, item_id long, n_words long, n_item_words long, start_pos long, end_pos long").distinct()
