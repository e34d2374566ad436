import random

from quirefold.llm.split import STATES, Cutter, compose, exit_map, sizes, solid_runs, split_counts, split_files, split_texts, state_after, through

SCHEMA = "ctx_id long, full_context string, chunk_size int, overlap int, text string"
WORDS = ["alpha", "b", "gamma.", "delta;", "x" * 45, "。", "終わり。", "」", "\n\n", "\n \t", "\n", "   ", "éé", "é̂", '."', "!)", " " * 30]


def _text(rng, n):
    out = ""
    while len(out) < n:
        out += rng.choice(WORDS) + rng.choice([" ", " ", ""])
    return out[:n]


def _whole(text, size, over):
    """The pieces of a text cut in one go."""
    c, x, out = Cutter(text, size, over), 0, []
    while True:
        e, how = c.cut(x)
        out.append((x, e, how, text[x:e]))
        if how == "end":
            return out
        x = e - over


def _check(pieces, text, size, over):
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    for s, e, _, p in pieces:
        assert p == text[s:e] and 0 < e - s <= size
    for a, b in zip(pieces, pieces[1:]):
        assert b[0] == a[1] - over and b[1] > a[1]


def test_ranges_give_the_pieces_of_the_whole(spark):
    rng = random.Random(1)
    rows = [(i, _text(rng, rng.choice([30, 400, 2500, 9000])), rng.choice([37, 80, 300]), rng.choice([0, 9, 500, None]), "x") for i in range(60)]
    rows += [(90, None, 10, 1, "x"), (91, "", 10, 1, "x"), (92, " " * 5000, 10, 3, None), (93, "a" * 5000, 10, 3, None), (94, _text(rng, 12000), None, None, None), (None, "a b " * 99, 10, 1, "")]
    df = spark.createDataFrame(rows + rows[:3], SCHEMA)
    for span in (1, None):  # the shortest ranges there are, and those of production
        got = {}
        for r in split_texts(df, span=span).orderBy("ctx_id", "piece_no").collect():
            assert r.piece_no == len(got.setdefault(r.ctx_id, []))
            got[r.ctx_id].append((r.start_pos, r.end_pos, r.cut, r.piece))
        counts = {r.ctx_id: (r.pieces, r.chars, r.solid) for r in split_counts(df, span=span).collect()}
        for key, text, c, o, _ in rows:
            size, over = sizes(c, o)
            if key is None or len(text or "") <= size:
                assert key not in got and key not in counts
                continue
            want = _whole(text, size, over)
            assert got[key] == want, (key, size, over)
            assert counts[key] == (len(want), len(text), solid_runs(text)[0])
            _check(got[key], text, size, over)


def test_blocks_of_ranges(spark, monkeypatch):
    import quirefold.llm.split as S

    monkeypatch.setattr(S, "BLOCK", 3)
    text = _text(random.Random(4), 6000)
    got = split_texts(spark.createDataFrame([(1, text, 40, 7, "")], SCHEMA), span=1).orderBy("piece_no").collect()
    assert [(r.start_pos, r.end_pos, r.cut, r.piece) for r in got] == _whole(text, 40, 7)


def test_files_above_the_range_size(spark, tmp_path):
    rng = random.Random(7)
    texts = {"a.txt": _text(rng, 30_000), "b.txt": "终" * 4000 + "𝄞" * 3000 + " end\n", "c.txt": "", "d.txt": "short"}
    for n, t in texts.items():
        (tmp_path / n).write_bytes(t.encode())
    got = {}
    for r in split_files(spark, [str(tmp_path)], 80, 9, range_bytes=1021).orderBy("file", "piece_no").collect():
        assert r.piece_no == len(got.setdefault(r.file.rsplit("/", 1)[1], []))
        got[r.file.rsplit("/", 1)[1]].append((r.start_pos, r.end_pos, r.cut, r.piece))
    assert set(got) == {"a.txt", "b.txt", "d.txt"}
    for n, p in got.items():
        assert p == _whole(texts[n], 80, 9), n


def test_maps():
    rng = random.Random(3)
    for _ in range(50):
        a, b = _text(rng, rng.randint(90, 200)), _text(rng, rng.randint(90, 200))
        size, over = rng.choice([(20, 3), (40, 0), (45, 20)])
        whole = exit_map(a + b + " " * 99, len(a) + len(b), size, over, False, "", True)
        for lead in STATES:  # what a range passes on is what the text before it would
            assert state_after(lead + a)[0] == state_after(a)[STATES.index(lead)]
        s = state_after(a)[0]
        one = exit_map((a + b + " " * 99)[: len(a) + size + 2], len(a), size, over, False, "", True)
        two = exit_map(b + " " * 99, len(b), size, over, False, STATES[s], False)
        assert through(compose(one, two, len(b)), len(a) + len(b), 0) == through(whole, len(a) + len(b), 0)
    assert state_after("a") == [0] * 6 and state_after("\n") == [2, 2, 3, 3, 2, 2] and state_after('"') == [0, 0, 0, 0, 4, 5] and state_after("。」") == [5] * 6


def test_natural_cuts_come_first():
    t = "One two. Three four.\n\nFive six seven"
    assert Cutter(t, 30, 5).cut(0) == (22, "paragraph")
    assert Cutter(t.replace("\n\n", " "), 30, 5).cut(0) == (21 - 1, "sentence")
    assert Cutter("a" * 50, 20, 3).cut(0) == (20, "hard")
    assert Cutter("a" * 19 + "é́" + "a" * 9, 20, 3).cut(0) == (19, "hard") and Cutter("́" * 50, 20, 3).cut(0) == (20, "hard")
    assert sizes(None, None) == (1200, 150) and sizes(100, 100) == (100, 50) and sizes(0, -1) == (1200, 150)


def test_solid_and_empty(spark):
    assert solid_runs("ab cdef") == (4, 2, 4)
    df = spark.createDataFrame([(1, "a" * 30, 10, 1, ""), (2, "ab " * 30, 10, 1, ""), (3, "a, " + "b" * 14 + " c", 10, 1, ""), (4, None, 10, 1, "")], SCHEMA)
    assert {r.ctx_id: r.solid for r in split_counts(df, span=1).collect()} == {1: 30, 2: 2, 3: 14}
    assert split_counts(df.limit(0)).count() == 0 and split_texts(df.limit(0)).count() == 0
