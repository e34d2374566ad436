"""Mixing sources to target shares of all tokens.

Texts are tokenised with a public tokenizer. Per source, documents in seeded order form one stream of tokens,
cut into blocks of fixed length: prefix sums over hash buckets and within them give each document its offset, so
no source is gathered in one task. The mixture has so many block slots that every source meets its share within
its cap; for each output shard the counts of the sources are drawn at random (multinomial draws on condition of
the totals, since free draws would overrun the caps). Draws go down a tree that halves the shards, each node seeded
by its place, so that a worker finds its shard's counts by itself, in as many steps as the tree is deep. The k-th slot
of a source takes block perm(k mod blocks), where perm is a pseudorandom permutation (Feistel network) that changes
with every pass over the source. Blocks are then joined by (source, block).

A pass uses each document once, and passes are at most max_repeats, so no document is used more often. Null and empty
texts have no tokens; sources without documents reach 0 and their share goes to the others in proportion;
documents of sources without a target are left out and reported. Spellings of a source (case, blanks) count as
one.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirefold.session import written

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
BLOCK = 512
SHARD_SLOTS = 4096
BUCKETS = 1024
#: Output shards of one task.
SHARDS_A_TASK = 8
#: Sources in a table of targets; more is an error.
MAX_TARGETS = 10_000
#: Fixed value: how the byte-level vocabularies split text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
_ENCODERS: dict = {}


def source_key(source: Column) -> Column:
    s = F.regexp_replace(F.lower(F.trim(source)), r"[\s_\- ]+", "-")
    s = F.regexp_replace(s, r"^-+|-+$", "")
    return F.when(s != "", s)


def encoder(folder: str = TOKENIZERS, name: str = VOCABULARY):
    """The tokenizer, once a worker."""
    if (folder, name) not in _ENCODERS:
        import tiktoken

        with open(f"{folder}/{name}", "rb") as h:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, h)}
        _ENCODERS[folder, name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[folder, name]


def tokenise(documents: DataFrame, folder: str = TOKENIZERS, name: str = VOCABULARY) -> DataFrame:
    """doc_id, source (its key), tokens: packed, two or four bytes each by the size of the vocabulary, little endian."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(folder, name)
        kind = np.dtype("<u2" if token_bytes(enc) == 2 else "<u4")
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                got = [np.array(enc.encode_ordinary(t), kind).tobytes() for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(got, pa.binary())], names=["doc_id", "source", "tokens"])

    x = documents.filter("text is not null and text <> ''").select("doc_id", source_key(F.col("source")).alias("source"), "text")
    return x.mapInArrow(run, "doc_id long, source string, tokens binary")


def token_bytes(enc) -> int:
    return 2 if enc.n_vocab <= 1 << 16 else 4


def unpack(blocks: DataFrame, column: str, size: int) -> DataFrame:
    """The packed tokens of a column as arrays of ints."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("array<int>")
    def ints(s: pd.Series) -> pd.Series:
        return s.map(lambda x: np.frombuffer(x, f"<u{size}").astype(np.int32))

    return blocks.withColumn(column, ints(column))


def blocks_of(tokens: DataFrame, block: int = BLOCK, seed: int = 42, size: int = 2) -> DataFrame:
    """(source, block, pos, doc_id, part): the pieces of documents that make up each block of a source's stream.

    size: bytes of a packed token."""
    t = tokens.filter("source is not null").withColumn("h", F.xxhash64("doc_id", F.lit(seed))).withColumn("bucket", F.pmod("h", F.lit(BUCKETS)).cast("int"))
    t = t.withColumn("n", F.floor(F.octet_length("tokens") / size))
    heads = t.groupBy("source", "bucket").agg(F.sum("n").alias("in_bucket"))
    # at most BUCKETS rows of a source
    heads = heads.withColumn("head", F.sum("in_bucket").over(Window.partitionBy("source").orderBy("bucket")) - F.col("in_bucket")).drop("in_bucket")
    # offsets are found on ids and lengths alone; the tokens join them afterwards
    ids = t.select("source", "bucket", "h", "doc_id", "n").join(heads, ["source", "bucket"])
    order = Window.partitionBy("source", "bucket").orderBy("h", "doc_id")
    ids = ids.select("source", "doc_id", (F.col("head") + F.sum("n").over(order) - F.col("n")).alias("off"))
    x = t.filter("n > 0").select("source", "doc_id", "n", "tokens").join(ids, ["source", "doc_id"])
    b = F.col("off")
    x = x.withColumn("block", F.explode(F.sequence(F.floor(b / block), F.floor((b + F.col("n") - 1) / block))))
    start = F.greatest(F.lit(0).cast("long"), F.col("block") * block - b)
    stop = F.least(F.col("n"), (F.col("block") + 1) * block - b)
    return x.select("source", "block", (b + start - F.col("block") * block).cast("int").alias("pos"), "doc_id", F.substring("tokens", (start * size + 1).cast("int"), ((stop - start) * size).cast("int")).alias("part"))


def quotas(have: dict[str, int], targets: list[tuple[str, float, int | None]], total: int | None, block: int = BLOCK) -> dict[str, int]:
    """Block slots of each source. have: tokens by source. Without a wanted total it is as many tokens as all
    sources can give at their shares within their caps, at most all there are."""
    open_ = [(s, w, r) for s, w, r in targets if have.get(s, 0) > 0 and w > 0 and (r is None or r > 0)]
    if not open_:
        return {}
    weight = sum(w for _, w, _ in open_)
    fit = min((have[s] * r * weight / w for s, w, r in open_ if r is not None), default=math.inf)
    tokens = total if total is not None else min(fit, sum(have.values()))
    out = {}
    for s, w, r in open_:
        blocks = -(-have[s] // block)
        n = max(1, round(tokens * w / weight / (have[s] / blocks)))
        out[s] = n if r is None else min(n, blocks * r)
    return out


def _mix64(x: np.ndarray, key: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1: a four-round Feistel network, walked on until it falls below n."""
    if n <= 1:
        return np.zeros_like(index)
    half = max(1, (int(n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    x = index.astype(np.uint64)
    todo = np.ones(len(x), bool)
    while todo.any():
        y = x[todo]
        lo, hi = y & mask, y >> np.uint64(half)
        for r in range(4):
            lo, hi = hi ^ (_mix64(lo, key * 4 + r) & mask), lo
        y = hi << np.uint64(half) | lo
        x[todo] = y
        todo[todo] = y >= n
    return x.astype(np.int64)


#: numpy draws hypergeometric counts from populations up to this; larger ones are drawn by their normal limit.
EXACT = 500_000_000


def _half(want: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """How many of n slots drawn at random from those wanted each source gets."""
    out, left = np.zeros_like(want), int(want.sum())
    for i, k in enumerate(want.tolist()):
        lo, hi = max(0, n - (left - k)), min(k, n)
        if lo == hi:
            got = lo
        elif left <= EXACT:
            got = int(rng.hypergeometric(k, left - k, n))
        else:
            mean = n * k / left
            got = min(hi, max(lo, round(rng.normal(mean, math.sqrt(mean * (1 - k / left) * (left - n) / (left - 1))))))
        out[i] = got
        left, n = left - k, n - got
    return out


def draw_shard(want: dict[str, int], shard: int, seed: int, size: int = SHARD_SLOTS) -> tuple[list[str], list[int], list[int]]:
    """(sources, slots of each, slots of each in the shards before) of one shard; over all shards they add up to want."""
    names = sorted(want)
    here, before = np.array([want[s] for s in names], np.int64), np.zeros(len(names), np.int64)
    lo, hi = 0, -(-int(here.sum()) // size)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = _half(here, (mid - lo) * size, np.random.default_rng([seed, lo, hi]))
        if shard < mid:
            here, hi = left, mid
        else:
            here, before, lo = here - left, before + left, mid
    return names, here.tolist(), before.tolist()


def slots(spark: SparkSession, want: dict[str, int], n_blocks: dict[str, int], seed: int = 42, size: int = SHARD_SLOTS) -> DataFrame:
    """shard, slot, source, block, pass: which block stands at each place of each output shard."""
    n_shards = -(-sum(want.values()) // size)

    def run(batches):
        for b in batches:
            for shard in b.column(0).to_pylist():
                names, counts, before = draw_shard(want, shard, seed, size)
                src, blk, use = [], [], []
                for i, (s, c, k0) in enumerate(zip(names, counts, before)):
                    if not c:
                        continue
                    k, n = np.arange(k0, k0 + c), n_blocks[s]
                    for p in np.unique(k // n):
                        idx = k[k // n == p] % n
                        src += [s] * len(idx)
                        blk.append(permute(idx, n, seed * 1_000_003 + i * 8191 + int(p)))
                        use.append(np.full(len(idx), p))
                place = np.random.default_rng([seed, shard]).permutation(len(src))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(src), shard), pa.int64()), pa.array(place, pa.int32()), pa.array(src), pa.array(np.concatenate(blk), pa.int64()), pa.array(np.concatenate(use), pa.int32())],
                    names=["shard", "slot", "source", "block", "pass"],
                )

    return spark.range(0, n_shards, 1, max(1, -(-n_shards // SHARDS_A_TASK))).mapInArrow(run, "shard long, slot int, source string, block long, pass int")


def targets_of(spark: SparkSession, path: str) -> list[tuple[str, float, int | None]]:
    """(source, share, cap) of mix_target, a fixed small table; spellings of a source are added up."""
    x = spark.read.parquet(path).dropDuplicates().withColumn("source", source_key(F.col("source"))).filter("source is not null")
    rows = x.groupBy("source").agg(F.sum("target_share").alias("w"), F.max("max_repeats").alias("r"), F.max(F.col("max_repeats").isNull()).alias("free")).limit(MAX_TARGETS + 1).collect()
    if len(rows) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} sources have a target share")
    return [(r.source, float(r.w or 0), None if r.free else int(r.r)) for r in rows]


class Mixture:
    """Tokens, packed blocks and slots of one mixture."""

    def __init__(self, documents: DataFrame, targets: list[tuple[str, float, int | None]], total: int | None = None, block: int = BLOCK, seed: int = 42, folder: str = TOKENIZERS, name: str = VOCABULARY) -> None:
        spark = documents.sparkSession
        self.targets, self.block = targets, block
        self.tokens = written(tokenise(documents, folder, name), "tokens")
        self.size = token_bytes(encoder(folder, name))
        by = self.tokens.groupBy("source").agg(F.sum(F.floor(F.octet_length("tokens") / self.size)).alias("n"), F.count("*").alias("docs"))
        wanted = spark.createDataFrame(targets, "source string, w double, r int")
        self.have = {r.source: r.n for r in by.join(F.broadcast(wanted.select("source")), "source", "left_semi").collect() if r.n}
        self.by_source = by
        self.want = quotas(self.have, targets, total, block)
        self.n_blocks = {s: -(-n // block) for s, n in self.have.items()}
        self.slots = slots(spark, self.want, self.n_blocks, seed)
        self.seed = seed

    def packed(self) -> DataFrame:
        """source, block, doc_ids, tokens (packed): at most `block` tokens each."""
        b = blocks_of(self.tokens, self.block, self.seed, self.size).groupBy("source", "block").agg(F.array_sort(F.collect_list(F.struct("pos", "doc_id", "part"))).alias("p"))
        return b.select("source", "block", F.col("p.doc_id").alias("doc_ids"), F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["part"])).alias("tokens"))

    def mixed(self) -> DataFrame:
        """shard, slot, source, block, pass, doc_ids, tokens."""
        # the planner can't tell how many slots a shard has, so it is told not to send them to all workers
        x = self.slots.hint("merge").join(self.packed(), ["source", "block"]).select("shard", "slot", "source", "block", "pass", "doc_ids", "tokens")
        return unpack(x, "tokens", self.size)

    def shares(self) -> DataFrame:
        """source, target_share, actual_share, tokens, own_tokens, passes: what was really reached."""
        spark = self.slots.sparkSession
        size = lambda s: self.have[s] - (self.n_blocks[s] - 1) * self.block
        last = spark.createDataFrame([(s, self.n_blocks[s] - 1, size(s)) for s in self.have], "source string, block long, short int")
        n = F.coalesce("short", F.lit(self.block))
        used = self.slots.join(F.broadcast(last), ["source", "block"], "left").groupBy("source").agg(F.sum(n).alias("tokens"), (F.max("pass") + 1).alias("passes"))
        wanted = spark.createDataFrame(self.targets, "source string, target_share double, max_repeats int")
        own = self.by_source.select("source", F.col("n").alias("own_tokens"))
        x = wanted.join(own, "source", "full").join(used, "source", "left")
        zero = F.lit(0).cast("long")
        all_ = F.sum(F.coalesce("tokens", zero)).over(Window.partitionBy(F.lit(1)))  # one row a source
        return x.select(
            "source", "target_share", "max_repeats", F.coalesce("own_tokens", zero).alias("own_tokens"), F.coalesce("tokens", zero).alias("tokens"),
            F.coalesce("passes", F.lit(0)).alias("passes"), F.when(all_ > 0, F.coalesce("tokens", zero) / all_).otherwise(0.0).alias("actual_share"),
        )
