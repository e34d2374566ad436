import random

from quirefold.llm.leaks import automaton, best_chain, find_leaks, scan, words_of


def _brute(doc, item, stretch=8):
    """Most words of the item held in stretches in its order: a table over all pairs of prefixes."""
    d, w = words_of(doc), words_of(item)
    best = [[0] * (len(w) + 1) for _ in range(len(d) + 1)]
    for i in range(1, len(d) + 1):
        for j in range(1, len(w) + 1):
            best[i][j] = max(best[i - 1][j], best[i][j - 1])
            n = 0
            while n < min(i, j) and d[i - n - 1] == w[j - n - 1]:
                n += 1
                if n >= stretch:
                    best[i][j] = max(best[i][j], best[i - n][j - n] + n)
    return best[-1][-1]


def test_scan_against_brute_force():
    rng = random.Random(5)
    item = " ".join(f"w{i}x" for i in range(40))
    auto, words, at = automaton({7: item})
    for _ in range(200):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            a = rng.randrange(0, 40)
            parts.append(" ".join(f"W{i}x" for i in range(a, min(40, a + rng.randrange(5, 16)))))
        doc = " , filler here. ".join(parts)
        got = scan(doc, auto, words, at, share=0)
        assert (got[0][1] if got else 0) == _brute(doc, item), doc


def test_forms_and_offsets(spark):
    item = "One two three four five six seven eight nine ten. Eleven twelve?"
    broken = "xx ONE, two three fo-\nur five «Six» seven eight nine; zz"
    rows = [(1, broken), (1, broken), (2, None), (3, ""), (4, "one two three four five six seven"), (5, item * 3), (6, "nine one two three four five six")]
    got = {r.doc_id: r for r in find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), {1: item, 2: "too short", 3: ""}).collect()}
    assert set(got) == {1, 5} and got[1].n_words == 9
    assert broken[got[1].start_pos : got[1].end_pos].startswith("ONE") and broken[got[1].start_pos : got[1].end_pos].endswith("nine")
    assert got[5].n_words == 12
    assert find_leaks(spark.createDataFrame([(1, "a")], "doc_id long, text string"), {}).count() == 0
    assert best_chain([(0, 10, 20), (50, 0, 9)], 20, 8)[0] == 10


def test_extra_columns_nulls_and_long_texts(spark):
    item = " ".join(f"w{i}x" for i in range(30))
    rows = [(1, item + " zz" * 50_000, 5, "a"), (None, item, 5, "a"), (2, item.upper(), None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, item_id int, n_words string")
    got = {r.doc_id: (r.item_id, r.n_words) for r in find_leaks(df, {9: item}).collect()}
    assert got == {1: (9, 30), 2: (9, 30), None: (9, 30)}
