r"""Line dedup by a sharded minimal perfect hash.

A line's key is the line without surrounding blanks, A-Z lower-cased. Keys that occur in at least min_docs documents
lose all their lines everywhere. Distinct keys are counted by two independent 64-bit hashes; over the distinct hashes
that reach min_docs a minimal perfect hash is built per shard (levels of collision-free bit vectors with ranks). It
indexes two compact arrays, a fingerprint (the second hash) and a count. Documents then probe those arrays; lines are
never joined. Keys outside the index land on some slot too and are told apart by the 64-bit fingerprint, which is
independent of the slot.

Up to BROADCAST_BYTES the arrays are sent to the executors whole, as files of the index that every worker opens once.
A larger index stays in its shards: lines' hashes (never lines) go to their shard and are answered by the same arrays,
with the same verdicts. Sending a larger index to every task would cost tasks times index size, which grows with the
square of the corpus; dealing hashes costs a fixed share of it.

Defined cases: a null text counts as one empty line and stays null; empty keys are never dropped; every row is a
document of its own, also when it repeats a doc_id; an empty table gives an empty result; extra columns are carried
along, by rewritten() whatever their names, by drop_lines() but for columns named ld_*, which are its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spillway.llm.common import BLANKS, holds, lower_ascii, materialize, only, set_aside, worker_cache

#: Arrays up to this size are broadcast; beyond it they are probed shard by shard.
BROADCAST_BYTES = 64 << 20
SHARD_KEYS = 1 << 19
LEVELS = 24

#: Hashes that a task answers for one shard, about, where the index stays in its shards.
CUT_LINES = 1 << 20

_SHARD = "shard int, n long, seed int, sizes array<long>, bits array<binary>, rest binary, prints binary, counts binary"


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash of distinct uint64 keys: a key's slot is the rank of its bit, over all levels."""

    def __init__(self, sizes: list[int], bits: list[np.ndarray], rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        self.ranks, total = [], 0
        for words in bits:
            ones = np.bitwise_count(words).astype(np.int64)
            self.ranks.append(total + np.cumsum(ones) - ones)
            total += int(ones.sum())
        self.n = total + len(rest)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, bits, left = [], [], keys
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(64, -(-2 * len(left) // 64) * 64)
            at = (_mixed(left, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            words = np.packbits(alone, bitorder="little").view(np.uint64)
            sizes.append(size)
            bits.append(words)
            left = left[~alone[at]]
        return cls(sizes, bits, np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slots of keys; a key outside the set gets some slot, or -1."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (size, words, ranks) in enumerate(zip(self.sizes, self.bits, self.ranks, strict=True)):
            if not len(open_):
                return out
            at = _mixed(keys[open_], level) % np.uint64(size)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[open_[hit]] = (ranks[word] + below)[hit]
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            hit = self.rest[at] == keys[open_]
            out[open_[hit]] = self.n - len(self.rest) + at[hit]
        return out


def _folded(h1: np.ndarray, h2: np.ndarray, seed: int) -> np.ndarray:
    """Both hashes in one uint64; keys that the first hash does not tell apart differ under one seed or another."""
    return h1.view(np.uint64) ^ (h2.view(np.uint64) * np.uint64(2 * seed + 1))


class Shard:
    """A perfect hash with the fingerprints and counts that it indexes."""

    def __init__(self, row):
        self.seed = row["seed"]
        self.hash = PerfectHash(list(row["sizes"]), [np.frombuffer(b, np.uint64) for b in row["bits"]], np.frombuffer(row["rest"], np.uint64))
        self.prints, self.counts = np.frombuffer(row["prints"], np.int64), np.frombuffer(row["counts"], np.uint32)

    def count(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """In how many documents the keys occur; 0 for those outside the index."""
        if not len(self.prints):
            return np.zeros(len(h1), np.uint32)
        slots = self.hash.slots(_folded(h1, h2, self.seed))
        return np.where((slots >= 0) & (self.prints[slots] == h2), self.counts[slots], 0)


def _build(pdf: pa.Table) -> pa.Table:
    h1, h2, counts = (pdf[c].to_numpy() for c in ("h1", "h2", "n"))
    seed = 0
    while len(np.unique(keys := _folded(h1, h2, seed))) < len(keys):
        seed += 1
    made = PerfectHash.build(keys)
    at = made.slots(keys)
    prints, seen = np.zeros(len(h1), np.int64), np.zeros(len(h1), np.uint32)
    prints[at], seen[at] = h2, np.minimum(counts, 2**32 - 1)
    row = {"shard": int(pdf["shard"][0].as_py()), "n": len(h1), "seed": seed, "sizes": made.sizes, "bits": [b.tobytes() for b in made.bits], "rest": made.rest.tobytes(), "prints": prints.tobytes(), "counts": seen.tobytes()}
    return pa.Table.from_pylist([row], schema=pa.schema([("shard", pa.int32()), ("n", pa.int64()), ("seed", pa.int32()), ("sizes", pa.list_(pa.int64())), ("bits", pa.list_(pa.binary())), ("rest", pa.binary()), ("prints", pa.binary()), ("counts", pa.binary())]))


def line_keys(text: Column) -> Column:
    """The keys of a text's lines, in order."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda line: lower_ascii(F.btrim(line, F.lit(BLANKS))))


def _shard_of(h1: Column, shards: int) -> Column:
    return F.pmod(F.shiftrightunsigned(h1, 40), F.lit(shards)).cast("int")


def build_index(docs: DataFrame, min_docs: int = 10, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int, int]:
    """The index table, its number of shards, its number of keys."""
    keys = only(docs, "text").select(F.explode(F.array_distinct(F.filter(line_keys(F.col("text")), lambda k: k != ""))).alias("k"))
    counted = keys.select(F.xxhash64("k").alias("h1"), F.xxhash64(F.lit("print"), "k").alias("h2")).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    frequent = materialize(counted.filter(F.col("n") >= min_docs), "line-counts")
    n = frequent.count()
    shards = max(8, -(-n // shard_keys))
    built = frequent.withColumn("shard", _shard_of(F.col("h1"), shards)).groupBy("shard").applyInArrow(_build, _SHARD)
    return materialize(built, "line-index"), shards, n


def _answer(texts: list, n_lines: np.ndarray, drop: np.ndarray) -> tuple[list, np.ndarray]:
    ends = np.cumsum(n_lines)
    sums = np.r_[0, np.cumsum(drop)]
    dropped = sums[ends] - sums[ends - n_lines]
    for i in np.flatnonzero(dropped):
        gone = drop[ends[i] - n_lines[i] : ends[i]]
        texts[i] = "\n".join(line for line, g in zip(texts[i].split("\n"), gone, strict=True) if not g)
    return texts, dropped


def _with_answers(batch: pa.RecordBatch, drop: np.ndarray, n_lines: np.ndarray, names: list[str]) -> pa.RecordBatch:
    texts, dropped = _answer(batch.column("text").to_pylist(), n_lines, drop)
    own = {"text": pa.array(texts, pa.string()), "ld_lines": pa.array(n_lines, pa.int64()), "ld_dropped": pa.array(dropped, pa.int64())}
    return pa.RecordBatch.from_arrays([own.get(n, batch.column(n) if n in batch.schema.names else None) for n in names], names=names)


def drop_lines(docs: DataFrame, min_docs: int = 10, broadcast_bytes: int = BROADCAST_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """docs with frequent lines taken out of text, and the long columns ld_lines (lines before) and ld_dropped."""
    spark = docs.sparkSession
    index, shards, n = build_index(docs, min_docs, shard_keys)
    base = docs.drop("ld_lines", "ld_dropped", "ld_hashes", "ld_row", "ld_drop")
    out = T.StructType([*base.schema.fields, T.StructField("ld_lines", T.LongType()), T.StructField("ld_dropped", T.LongType())])
    names = out.names

    def pair(k: Column) -> Column:
        one, two = F.when(k != "", F.xxhash64(k)).otherwise(F.lit(0)), F.when(k != "", F.xxhash64(F.lit("print"), k)).otherwise(F.lit(0))
        return F.struct(one.cast("long").alias("h1"), two.cast("long").alias("h2"))

    hashed = base.withColumn("ld_hashes", F.transform(line_keys(F.col("text")), pair))
    # One line costs 8 bytes of fingerprint, 4 of count and under 1 of hash.
    if n * 13 <= broadcast_bytes:
        sent = spark.sparkContext.broadcast({r["shard"]: r.asDict() for r in index.collect()})

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            holds("line dedup")
            arrays = _opened(sent)
            for batch in batches:
                lists = batch.column("ld_hashes")
                h1, h2 = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
                drop, at = np.zeros(len(h1), bool), (h1.view(np.uint64) >> np.uint64(40)) % np.uint64(shards)
                for s, arr in arrays.items():
                    mine = np.flatnonzero(at == s)
                    drop[mine] = arr.count(h1[mine], h2[mine]) >= min_docs
                drop &= h1 != 0
                yield _with_answers(batch, drop, pc.list_value_length(lists).to_numpy().astype(np.int64), names)

        return hashed.mapInArrow(probe, out)

    # The larger index: each line's hashes go to their shard once, as 24 bytes, and the numbers of dropped lines come back.
    keyed = materialize(base.withColumn("ld_row", F.expr("uuid()")), "line-docs")
    lines = keyed.select("ld_row", F.posexplode(F.transform(line_keys(F.col("text")), pair)).alias("pos", "h")).select("ld_row", "pos", "h.h1", "h.h2").filter("h1 != 0")
    dealt = materialize(lines.withColumn("shard", _shard_of(F.col("h1"), shards)), "line-hashes")
    # Shards are cut once more by row so that a line found everywhere does not meet in one task; the arrays are copied to each cut.
    cuts = max(16, -(-dealt.count() // (shards * CUT_LINES)))
    dealt = dealt.withColumn("cut", F.pmod(F.xxhash64("ld_row", "pos"), F.lit(cuts)).cast("int"))
    copied = index.withColumn("cut", F.explode(F.sequence(F.lit(0), F.lit(cuts - 1))))

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        hit = np.zeros(left.num_rows, bool)
        for row in right.to_pylist():
            hit |= Shard(row).count(left["h1"].to_numpy(), left["h2"].to_numpy()) >= min_docs
        return left.select(["ld_row", "pos"]).filter(pa.array(hit))

    found = dealt.groupBy("shard", "cut").cogroup(copied.groupBy("shard", "cut")).applyInArrow(answer, "ld_row string, pos int")
    drops = found.groupBy("ld_row").agg(F.collect_list("pos").alias("ld_drop"))

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.array([(t or "").count("\n") + 1 for t in batch.column("text").to_pylist()], np.int64)
            drop, starts = np.zeros(int(counts.sum()), bool), np.cumsum(counts) - counts
            for s, gone in zip(starts, batch.column("ld_drop").to_pylist(), strict=True):
                if gone:
                    drop[s + np.array(gone)] = True
            yield _with_answers(batch, drop, counts, names)

    return keyed.join(drops, "ld_row", "left").drop("ld_row").mapInArrow(rebuild, out)


_open: dict[int, dict[int, Shard]] = worker_cache()


def _opened(sent) -> dict[int, Shard]:
    """A broadcast index, opened once per worker process; only the latest is kept."""
    if id(sent.value) not in _open:
        _open.clear()
        _open[id(sent.value)] = {s: Shard(r) for s, r in sent.value.items()}
    return _open[id(sent.value)]


def rewritten(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """docs without frequent lines, in docs' own columns; n_chars, where it is a column, counts the new text."""
    own = set_aside(docs, "ld_")
    cut = drop_lines(own, min_docs)
    if "n_chars" in own.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("ld_dropped") > 0, F.char_length("text").cast(own.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return only(cut, *own.columns).toDF(*docs.columns)
