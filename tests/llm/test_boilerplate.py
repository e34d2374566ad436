import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirefold.llm.boilerplate import REACH, WINDOW, Lines, repeated_lines, without_lines

SCHEMA = "page_id long, doc_stem string, source string, page_text string, cleaned_text string, field string"


def _line(rng, n=6):
    return " ".join("".join(rng.choice("bdeghklmnprstuvwyz") for _ in range(rng.randrange(3, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(2)
    out = []
    notices = {"Alpha": "Copying of this sheet needs leave of the alpha trustees, no 77", "beta": "Short notes 12 are for internal circulation only"}
    for i in range(160):
        src = "Alpha" if i % 3 else "beta"
        lines = [_line(rng) for _ in range(8)]
        said = notices[src]
        if i % 5 == 0:
            said = said.upper()
        if i % 7 == 0:
            said = said.replace("leave", "lcave").replace("internal", "intemal")
        if i % 11 == 0:
            said = "* " + said.replace("trustees", "truslees").replace("only", "0nly").replace("77", str(i)) + " *"
        if i % 2 == 0:
            lines[rng.randrange(8)] = said
        if i % 40 == 1:
            lines[0] = "a line that stands in very few of the documents here"
        t = "\n".join(lines)
        out.append((i, f"doc-{i % 80 + 1000}", src, t, t if i % 4 == 0 else None if i % 4 == 1 else t.replace("\n", "\n\n", 2), None))
    out += [(900, "x", "alpha", None, None, "f"), (901, None, "alpha", "", "", "f"), (902, "y", None, notices["beta"], None, "f"), (903, "z", "beta", "q" * 30000, None, "f"), out[0], out[0]]
    return out


def _hits(text):
    n = re.sub(r"[^a-z0]", "", (text or "").lower())
    return "copyingofthissheet" in n or "shortnotes" in n


def test_found_and_removed(spark, pages):
    df = spark.createDataFrame(pages, SCHEMA)
    got = {tuple(r) for r in repeated_lines(df).collect()}
    want = {(p, f, i) for p, _, s, t, c, _ in pages if s for f, x in (("page_text", t), ("cleaned_text", c)) for i, l in enumerate((x or "").split("\n")) if _hits(l)}
    assert got == want and want
    assert {tuple(r) for r in repeated_lines(df, max_hot=3).collect()} == want
    clean = {r.page_id: r for r in without_lines(df, repeated_lines(df)).collect()}
    assert set(clean) == {p[0] for p in pages}
    for p, _, s, t, c, _ in pages:
        for x, y in ((t, clean[p].page_text), (c, clean[p].cleaned_text)):
            assert y == (None if x is None else "\n".join(l for l in x.split("\n") if not (s and _hits(l))))


def test_empty(spark, pages):
    none = spark.createDataFrame([], SCHEMA)
    assert repeated_lines(none).count() == 0
    few = spark.createDataFrame(pages[:3], SCHEMA)
    assert repeated_lines(few).count() == 0 and without_lines(few, repeated_lines(few)).count() == 3


def test_chunks_depend_on_content_only():
    a = "one line of letters that is long enough to be cut"
    L = Lines([f"zz\n{a}\nqq", f"{a.upper()}, 123\nsomething else of enough letters here"], np.zeros(2, np.uint64))
    k = [L.keys[L.owner == i].tolist() for i in range(3)]
    assert k[0] == k[1] and not set(k[0]) & set(k[2]) and L.sig[0] == L.sig[1] != L.sig[2]
    assert L.line_no[L.lines].tolist() == [1, 0, 1] and L.line_page[L.lines].tolist() == [0, 1, 1]


def test_cuts_depend_on_the_letters_around_them_alone():
    rng = np.random.default_rng(2)
    for _ in range(30):
        core = "".join(chr(97 + c) for c in rng.integers(0, 26, 80))
        head, tail = ("".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(0, 90))) for _ in range(2))
        cuts = lambda t: set(Lines([t], np.zeros(1, np.int64)).cuts.tolist())
        far = REACH + WINDOW
        inner = {c for c in cuts(core) if far <= c < len(core) - far}
        assert inner == {c - len(head) for c in cuts(head + core + tail) if far <= c - len(head) < len(core) - far}
        several = Lines([core + "\n" + tail + "tailtailtailtailtail\n" + core], np.zeros(1, np.int64))
        first = several.cuts[several.owner == 0] - several.start[0]
        assert first.tolist() == (several.cuts[several.owner == 2] - several.start[2]).tolist() == sorted(cuts(core))
