import random

import pytest

from quirefold.llm.sentences import Model, language, learn, sentence_units, spans, units

MODEL = Model(
    [("en", w) for w in ("The", "A", "It", "They", "Who", "Type", "After")] + [("de", w) for w in ("Die", "Der", "Am")] + [("fr", "Le")],
    [("en", t, "never") for t in ("dr", "fig", "vs", "rev", "no", "cf", "p", "messrs")] + [("en", "p.m", "mixed"), ("en", "#", "mixed"), ("de", "#", "never"), ("de", "z", "never"), ("de", "b", "never"), ("hi", "डॉ", "never")],
)

WANT = {
    "Dr. Hill saw Fig. 2, cf. Kent, p. 3. The end came.": ["Dr. Hill saw Fig. 2, cf. Kent, p. 3.", "The end came."],
    "It ran hot... then it broke. Type A vs. Type B was decided": ["It ran hot... then it broke.", "Type A vs. Type B was decided"],
    "At 6 p.m. Kent left the yard. They left at 6 p.m. The yard was shut.": ["At 6 p.m. Kent left the yard.", "They left at 6 p.m.", "The yard was shut."],
    '"Was it cut?" asked Kent. "Drain it. Close it," the card says. (See Fig. 2.) The log reads "Hold it." Who knows?! A dog.':
        ['"Was it cut?" asked Kent.', '"Drain it. Close it," the card says.', "(See Fig. 2.)", 'The log reads "Hold it."', "Who knows?!", "A dog."],
    "1. Handling of sets\n\nThe value is 4.5 mm.\nThey fell.The rest\nstayed. T. E. Kent left.\n\n- one item. x\n- two items\n": 
        ["1. Handling of sets", "The value is 4.5 mm.", "They fell.", "The rest\nstayed.", "T. E. Kent left.", "- one item. x", "- two items"],
    "It sank by 2 rpm. pH values rose. It is 3.14 cm.": ["It sank by 2 rpm.", "pH values rose.", "It is 3.14 cm."],
}
OTHER = {
    ("de", "Am 3. März kam er. „Erst lösen. Dann heben“, steht da. Der Typ, z. B. klein."): ["Am 3. März kam er.", "„Erst lösen. Dann heben“, steht da.", "Der Typ, z. B. klein."],
    ("fr", "« Ouvrez. Fermez », dit la fiche. Ne touchez pas ! Le Dr."): ["« Ouvrez. Fermez », dit la fiche.", "Ne touchez pas !", "Le Dr."],
    ("zh", "“先关。再开。”卡片上写着。他说：“没有。”“修好了！”她喊道。完"): ["“先关。再开。”卡片上写着。", "他说：“没有。”", "“修好了！”她喊道。", "完"],
    ("ja", "図1（弁の断面。）を見る。「直ったか？」と尋ねた。触れるな！"): ["図1（弁の断面。）を見る。", "「直ったか？」と尋ねた。", "触れるな！"],
    ("hi", "डॉ. Kent ने देखा। क्या?"): ["डॉ. Kent ने देखा।", "क्या?"],
    ("th", "ทีม Kent ยกบันได ห้ามแตะท่อ\n\nหมายเลข 5 คือท่อ"): ["ทีม Kent ยกบันได", "ห้ามแตะท่อ", "หมายเลข 5 คือท่อ"],
}


@pytest.mark.parametrize("text", WANT)
def test_english(text):
    assert [text[a:b] for a, b in units(text, "en", MODEL)] == WANT[text]


@pytest.mark.parametrize("case", OTHER)
def test_others(case):
    lang, text = case
    assert [text[a:b] for a, b in units(text, lang, MODEL)] == OTHER[case]


def test_units_lose_nothing():
    for text in [*WANT, *(t for _, t in OTHER), "  \n \n", "(", '"a. B', "...", "。" * 50, "x" * 100_000, "(" * 50_000, '"«' * 20_000, "p. X " * 20_000, '"A." ' * 10_000, "(a. B) " * 10_000]:
        got = units(text, "en", MODEL)
        assert all(a < b for a, b in got) and all(p[1] <= q[0] for p, q in zip(got, got[1:]))
        kept = "".join(text[a:b] for a, b in got)
        assert "".join(kept.split()) == "".join(text.split())


def test_language_and_spans():
    assert language(" EN ", "x") == "en" and language(None, "der die das und") == "de" and language("und", "第2号") == "zh"
    assert language(None, "圧力は") == "ja" and language(None, "???") == "und" and language(None, "ทีม Kent") == "th"
    assert spans('a "b" (c (d) e) „f“') == [(2, 5, True), (6, 15, False), (16, 19, True)] and spans('an open " one') == []


def test_learning_finds_abbreviations(spark):
    names = ["Kent", "Hill", "Moor", "Dale", "Ford", "Lake"]
    rng = random.Random(4)
    forms = ["The pump was tested by Dr. {n} today.", "After that Dr. {n} left the garden.", "They saw Fig. {i} there.", "It was green!", "The garden there is old today, says {n}.", "Who was there?", "They found a pump."]
    rows = [(i, " ".join(rng.choice(forms).format(n=rng.choice(names), i=i) for _ in range(8)), "en", "x") for i in range(120)]
    rows.append((800, "The pump was tested by Dr. Kent today. They saw Fig. 3 there. It was green! After that Dr. Ford left", "en", "x"))
    rows += [(900, None, "en", None), (901, "", None, None), (902, "  ", "en", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, unit string")
    starters, classes = learn(df.filter("text is not null"))
    kinds = {(r.lang, r.type): r["class"] for r in classes.collect()}
    assert kinds[("en", "dr")] == "never" and kinds[("en", "fig")] == "never" and ("en", "today") not in kinds
    assert {"The", "After", "They", "It"} <= {r.word for r in starters.collect()}
    got = sentence_units(df).filter("doc_id = 800").orderBy("unit_no").collect()
    assert [r.unit.split()[0] for r in got] == ["The", "They", "It", "After"]
    assert sentence_units(df).filter("doc_id >= 900").count() == 0 and sentence_units(df.limit(0)).count() == 0


def test_long_words_and_far_parts_count_whole():
    m = Model([("en", "Then"), ("en", "Thereafter" * 20)], [("en", "approx", "mixed"), ("en", "abbreviationlong", "never")])
    long_ = "w" * 900
    ends = lambda t, lang="en": [t[a:b] for a, b in units(t, lang, m)]
    # the words before a period are seen however far they reach back, and the next word however long it is
    assert len(ends(f"We saw {long_} {long_} approx. Then it went on.")) == 2
    assert len(ends(f"We saw {long_}, {long_} approx. Name it went on.")) == 1
    assert len(ends(f"We saw all of it approx. {'Thereafter' * 20} it went on.")) == 2
    # classes of long types hold for other languages too
    assert len(ends("Siehe abbreviationlong. Haus ist da.", "de")) == 1
