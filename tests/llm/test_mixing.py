import numpy as np
from pyspark.sql import functions as F

from quirefold.llm.mixing import Mixture, blocks_of, draw_shard, encoder, permute, quotas, slots, source_key, targets_of


def test_permutations_and_draws():
    for n in (1, 2, 7, 64, 1000):
        a = permute(np.arange(n), n, 5)
        assert sorted(a.tolist()) == list(range(n))
    assert permute(np.arange(1000), 1000, 5).tolist() != permute(np.arange(1000), 1000, 6).tolist()
    for want, size in (({"a": 70, "b": 5, "c": 0}, 16), ({"a": 3_000, "b": 900, "c": 1, "d": 97}, 10), ({"x": 3}, 5)):
        n = -(-sum(want.values()) // size)
        shards = [draw_shard(want, k, 1, size) for k in range(n)]
        assert [sum(c) for _, c, _ in shards] == [size] * (n - 1) + [sum(want.values()) - size * (n - 1)]
        for k, (names, counts, before) in enumerate(shards):
            assert names == sorted(want) and min(counts) >= 0
            assert before == np.sum([c for _, c, _ in shards[:k]], axis=0, dtype=int).tolist() if k else before == [0] * len(names)
        assert np.sum([c for _, c, _ in shards], axis=0).tolist() == [want[s] for s in sorted(want)]
    big = draw_shard({"a": 3 * 10**10, "b": 10**10}, 7_000_000, 1)[1]  # populations beyond numpy's exact draws
    assert sum(big) == 4096 and abs(big[0] - 3072) < 300


def test_slots_use_every_block_as_often_as_passes_say(spark):
    want, blocks = {"a": 1000, "b": 77}, {"a": 400, "b": 77}
    rows = slots(spark, want, blocks, size=64).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(k, i) for k in range(17) for i in range(64 if k < 16 else 1077 - 1024)]
    uses = {}
    for r in rows:
        uses[r.source, r.block] = uses.get((r.source, r.block), 0) + 1
    assert len(uses) == 477 and all(n in (2, 3) if s == "a" else n == 1 for (s, _), n in uses.items())


def test_targets(spark, tmp_path):
    spark.createDataFrame([("A", 0.5, 2), (" a ", 0.1, None), ("b", 0.4, 1), (None, 0.1, 1), ("b", 0.4, 1)], "source string, target_share double, max_repeats int").write.parquet(str(tmp_path / "t"))
    got = {s: (round(w, 9), r) for s, w, r in targets_of(spark, str(tmp_path / "t"))}
    assert got == {"a": (0.6, None), "b": (0.4, 1)}


def test_quotas_keep_caps():
    q = quotas({"a": 1000, "b": 1000, "x": 50}, [("a", 0.5, 1), ("b", 0.4, None), ("gone", 0.1, 2)], None, 10)
    assert q["a"] == 100 and q["b"] == 80 and set(q) == {"a", "b"}
    assert quotas({"a": 1000}, [("a", 1.0, 2)], 10_000, 10) == {"a": 200}
    assert quotas({}, [("a", 1.0, None)], None) == {}


def test_blocks_hold_every_token_once(spark):
    rows = [(i, f"s{i % 3}", list(range(i * 100, i * 100 + (i * 7) % 50))) for i in range(60)]
    df = spark.createDataFrame([(i, s, bytearray(np.array(t, "<u2").tobytes())) for i, s, t in rows], "doc_id long, source string, tokens binary")
    got = blocks_of(df, 16).collect()
    ints = lambda b: np.frombuffer(b, "<u2").tolist()
    assert sorted(t for r in got for t in ints(r.part)) == sorted(t for _, _, ts in rows for t in ts)
    filled = {}
    for r in got:
        filled.setdefault((r.source, r.block), []).append((r.pos, len(r.part) // 2))
    last = {s: max(b for t, b in filled if t == s) for s in ("s0", "s1", "s2")}
    for (s, b), parts in filled.items():
        at = 0
        for pos, n in sorted(parts):
            assert pos == at
            at += n
        assert at == 16 or b == last[s]


def test_mixture(spark):
    texts = [(i, "alpha beta gamma " * (5 + i % 9), s) for i, s in enumerate(["Big", "big ", " BIG", "small-one", "Small One", None] * 15)]
    texts += [(900, None, "big"), (901, "", "big"), (902, "終わり।", "big")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string").withColumn("block", F.lit(1))
    m = Mixture(docs, [("big", 0.5, 1), ("small-one", 0.4, 3), ("none", 0.1, None)], block=32)
    rows = m.mixed().collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(0, i) for i in range(len(rows))]
    by = {r.source: r for r in m.shares().collect()}
    assert by["none"].actual_share == 0 and by[None].tokens == 0
    assert abs(by["big"].actual_share - 5 / 9) < 0.05 and by["big"].passes == 1 and by["small-one"].passes <= 3
    assert sum(len(r.tokens) for r in rows) == sum(r.tokens for r in by.values())
    assert by["big"].own_tokens == sum(len(encoder().encode_ordinary(t)) for _, t, s in texts if t and s and s.strip().lower() == "big")
    empty = Mixture(docs.limit(0), [("big", 1.0, 1)])
    assert empty.mixed().count() == 0 and empty.shares().count() == 1
    keys = spark.createDataFrame([(" A_b ",), ("",), (None,)], "s string").select(source_key(F.col("s")).alias("k")).collect()
    assert [r.k for r in keys] == ["a-b", None, None]
