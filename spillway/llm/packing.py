"""Best-fit packing of documents into sequences by exact complements.

Every document becomes its token ids and an end id; only documents longer than a sequence are cut. Pieces are counted
by length, and the packing is decided on that histogram, which has at most `capacity` entries at any corpus size: the
exact-complement step fills the gap beside a length with single, pair and triple sums under the counts that are left,
by an index of these sums that follows the counts; then the rest is packed best-fit, longest first. Pieces then look up their places by their rank within their length.

Ranks are counted in cells: a length has one for about every `cell_rows` of its pieces, so a length that very many pieces share
is ranked by many tasks. Which cell a row is in was drawn when its ids were made, so that neither rows that repeat a
doc_id nor copies meet in one.

Defined cases: a null or empty text is the end id alone; rows that repeat a doc_id are packed one by one; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spillway.llm.common import holds, materialize, only
from spillway.llm.tokens import encoder

CAPACITY = 2048
#: Pieces of a cell, about, until there are CELLS of them; beyond, cells grow.
CELL_ROWS, CELLS = 1_000, 1 << 17


class SumIndex:
    """Which lengths are left, and by sum how many ordered pairs and triples of them there are.

    Taking a length out changes the three tables in place, so a gap is looked up under the counts that are left."""

    def __init__(self, avail: np.ndarray, capacity: int):
        self.avail, self.capacity = avail, capacity
        self.single = (avail > 0).astype(np.int64)
        self.pair = np.convolve(self.single, self.single)[: capacity + 1]
        self.triple = np.convolve(self.pair, self.single)[: capacity + 1]

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for x in lengths:
            self.avail[x] -= times
        for x in set(lengths):
            if not self.avail[x]:
                self._remove(x)

    def _remove(self, x: int) -> None:
        def later(table: np.ndarray, by: int) -> np.ndarray:
            out = np.zeros_like(table)
            if by <= self.capacity:
                out[by:] = table[: len(table) - by]
            return out

        one = np.zeros_like(self.single)
        one[0] = 1
        # Of the sums of sets without x: (s - x)^3 and (s - x)^2, multiplied out.
        self.triple += -3 * later(self.pair, x) + 3 * later(self.single, 2 * x) - later(one, 3 * x)
        self.pair += -2 * later(self.single, x) + later(one, 2 * x)
        self.single[x] = 0

    def fillings(self, gap: int, pieces: int) -> Iterator[tuple[int, ...]]:
        """So many lengths that add up to the gap, as the index has them; small ones, which fit anywhere, are used last."""
        live = self.single
        if pieces == 1:
            if live[gap]:
                yield (gap,)
        elif pieces == 2:
            if self.pair[gap]:
                yield from self._pairs(gap, gap)
        elif self.triple[gap]:
            x = np.arange(gap - 2, 0, -1)
            for first in x[(live[x] > 0) & (self.pair[gap - x] > 0)]:
                yield from ((int(first), *rest) for rest in self._pairs(gap - int(first), int(first)))

    def _pairs(self, total: int, most: int) -> Iterator[tuple[int, int]]:
        y = np.arange(total // 2, 0, -1)
        y = y[(self.single[y] > 0) & (self.single[total - y] > 0) & (total - y <= most)]
        yield from ((int(total - z), int(z)) for z in y)


Runs = list[tuple[tuple[int, ...], int]]


def _exact(avail: np.ndarray, capacity: int) -> Iterator[Runs]:
    """Consumes avail (counts by length) with combinations that fill a sequence exactly: lengths beside one other, then
    two, then three. After each of these levels, what it consumed."""
    index = SumIndex(avail, capacity)
    made: Runs = []
    if n := int(avail[capacity]):
        index.take((capacity,), n)
        made.append(((capacity,), n))
    for pieces in (1, 2, 3):
        for length in range(capacity - 1, 0, -1):
            while avail[length]:
                for rest in index.fillings(capacity - length, pieces):
                    combo = (length, *rest)
                    if times := min(int(avail[x]) // k for x, k in Counter(combo).items()):
                        index.take(combo, times)
                        made.append((combo, times))
                        break
                else:
                    break
        yield made
        made = []


def _best_fit(avail: np.ndarray, capacity: int) -> Runs:
    """Packs the counts that are left, longest first, each into the fullest open sequence that has room. Equal sequences are kept as one entry."""
    bins: dict[int, list[list]] = {}
    roomy = np.zeros(capacity + 1, np.int64)
    for length in range(capacity, 0, -1):
        left = int(avail[length])
        while left:
            gaps = np.flatnonzero(roomy[length:])
            if len(gaps):
                gap = length + int(gaps[0])
                pattern, n = bins[gap].pop()
                m = min(n, left)
                if n > m:
                    bins[gap].append([pattern, n - m])
                roomy[gap] -= m
                made, new = (*pattern, length), gap - length
                left -= m
            else:
                k = min(capacity // length, left)
                m = left // k
                made, new = (length,) * k, capacity - k * length
                left -= m * k
            bins.setdefault(new, []).append([made, m])
            roomy[new] += m
        avail[length] = 0
    return [(tuple(p), n) for group in bins.values() for p, n in group]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> Runs:
    """(lengths of one sequence, number of such sequences) so that the counts by length are used up.

    Single, pair and triple sums are consumed level by level. Pairs and triples can use up small lengths that best-fit
    needs, so after each level the rest is packed best-fit on trial, and the level with the fewest sequences stands
    (the last of equals). Single sums are always consumed."""
    avail = counts.astype(np.int64)
    exact: Runs = []
    found: Runs | None = None
    for made in _exact(avail, capacity):
        exact += made
        whole = [*exact, *_best_fit(avail.copy(), capacity)]
        if found is None or sum(m for _, m in whole) <= sum(m for _, m in found):
            found = whole
    return found or []


class Places:
    """Where the piece of some rank within its length goes."""

    def __init__(self, runs: Runs, capacity: int):
        rows: dict[int, list[tuple[int, int, int]]] = {}
        used, base = np.zeros(capacity + 1, np.int64), 0
        for pattern, m in runs:
            offset = 0
            for length in pattern:
                rows.setdefault(length, []).append((int(used[length]), base, offset))
                used[length] += m
                offset += length
            base += m
        self.sequences = base
        self.by = {length: tuple(np.array(x, np.int64) for x in zip(*r, strict=True)) for length, r in rows.items()}

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for x in np.unique(length):
            at = np.flatnonzero(length == x)
            starts, bases, offsets = self.by[int(x)]
            run = np.searchsorted(starts, rank[at], "right") - 1
            seq[at], off[at] = bases[run] + rank[at] - starts[run], offsets[run]
        return seq, off


def tokenised(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """(doc_id, n_ids, crcs, salt): the number of ids with the end id, a checksum per piece, a random number."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds("packing")
        enc, rng = encoder(path), np.random.default_rng()
        for b in batches:
            n, crcs = [], []
            for text in b.column("text").to_pylist():
                ids = enc.encode(text or "") + end
                n.append(len(ids) // 4)
                crcs.append([zlib.crc32(ids[i : i + 4 * capacity]) for i in range(0, len(ids), 4 * capacity)])
            salt = rng.integers(0, 2**31, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(salt, pa.int64())], names=["doc_id", "n_ids", "crcs", "salt"])

    return only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_ids long, crcs array<long>, salt long")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    tokens = materialize(tokenised(docs, path, capacity, end_id), "pack-tokens")
    pieces = tokens.select("doc_id", "n_ids", "salt", F.posexplode("crcs").alias("piece", "ids_crc32")).select(
        "doc_id",
        "piece",
        (F.col("piece").cast("long") * capacity).alias("start"),
        F.least(F.lit(capacity).cast("long"), F.col("n_ids") - F.col("piece").cast("long") * capacity).alias("length"),
        "ids_crc32",
        "salt",
    )
    # At most capacity rows, then capacity + CELLS, whatever the corpus.
    counted = pieces.groupBy("length").count().toArrow()
    counts = np.zeros(capacity + 1, np.int64)
    counts[counted["length"].to_numpy()] = counted["count"].to_numpy()
    cells = np.maximum(1, -(-counts // max(cell_rows, int(counts.sum()) // CELLS)))
    cell = F.pmod(F.col("salt") + F.col("piece"), F.element_at(F.array(*[F.lit(int(x)) for x in cells]), F.col("length").cast("int") + 1))
    celled = pieces.withColumn("cell", cell.cast("int")) if cells.max() > 1 else pieces.withColumn("cell", F.lit(0))
    held = celled.groupBy("length", "cell").count().toArrow() if cells.max() > 1 else pa.table({"length": counted["length"], "cell": np.zeros(len(counted), np.int32), "count": counted["count"]})
    # Cells of all lengths in one array: those of a length lie side by side.
    first = np.cumsum(cells) - cells
    sizes = np.zeros(int(cells.sum()), np.int64)
    sizes[first[held["length"].to_numpy()] + held["cell"].to_numpy()] = held["count"].to_numpy()
    before = np.cumsum(sizes) - sizes
    before -= np.repeat(before[first], cells)
    sent = spark.sparkContext.broadcast((Places(plan(counts, capacity), capacity), first, before))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, begin, ahead = sent.value
        for b in batches:
            length, cell = b.column("length").to_numpy(), b.column("cell").to_numpy()
            seq, off = where.find(length, b.column("rank").to_numpy() - 1 + ahead[begin[length] + cell])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(seq), pa.array(off)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    rank = F.row_number().over(Window.partitionBy("length", "cell").orderBy("salt", "doc_id", "piece", "ids_crc32"))
    return celled.withColumn("rank", rank.cast("long")).mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
