"""Token-id files: canonical length-limited Huffman codes, decoded by table in independent blocks.

A file holds documents in ascending doc_id order:

    magic, number of symbols, documents, documents without doc_id (which come first), blocks, ids per block at most,
    bytes of bits
    code lengths (one byte per symbol), doc_ids, ids per document, ids per block, bit offset of each block, bits

All numbers are little-endian. Every document begins a block and a block holds at most BLOCK ids of one document, so
any block can be decoded from its bit offset alone. Codes come from the id counts of the whole corpus and are at most
MAX_BITS long, so one table of 2**MAX_BITS entries decodes them.

Steps: documents are tokenised once into a table of ids; counts are summed; the documents are dealt by ranges of
(doc_id, length, hash, a number drawn for the row), so that neither a doc_id nor a text that a third of the rows share
meets in one task; each task encodes and writes its range, sorted, as files of about file_ids ids, of which it holds
one at a time (under a temporary name first, so that a repeated task's file is whole). What was written is listed in a table beside the files, with the ids before each file. The files are read back
by Spark's binary file source.

Defined cases: a null or empty text is the end id alone; rows that repeat a doc_id are adjacent, ordered by content; a
null doc_id sorts first, and how many there are is stored; an empty table gives no files and an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spillway.llm.common import holds, materialize, only, scratch_path
from spillway.llm.tokens import table_encoder

MAX_BITS = 18
BLOCK = 4096
#: Pieces that a worker keeps at most: about 170 MB. Characters that are tokenised at once, about.
CACHE_PIECES, AT_ONCE = 2_000_000, 1_000_000
#: Documents' ids per file, about, and tasks that write at most.
FILE_IDS, MAX_TASKS = 4_000_000, 20_000
#: Up to so many files the table of their starts is broadcast (under 20 MB); more are joined by a shuffle.
BROADCAST_FILES = 200_000
_HEAD, _HEAD_BYTES = "<8sqqqqqq", 56
_MAGIC = b"SPWHUFF2"


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most `limit` bits by package-merge; 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need codes longer than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.float64) if counts.sum() > 2**62 // len(used) else counts[order].astype(np.int64)
    n, merged, from_leaf = len(order), weight, []
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weight, pairs])
        at = np.argsort(both, kind="stable")
        from_leaf.append(at < n)
        merged = both[at]
    take, sizes = 2 * n - 2, np.zeros(n, np.int64)
    for leaf in reversed(from_leaf):
        leaves = int(leaf[:take].sum())
        sizes[:leaves] += 1
        take = 2 * (take - leaves)
    sizes[:take] += 1
    lengths[order] = sizes
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: in order of (length, id), counting up."""
    codes, order = np.zeros(len(lengths), np.uint32), np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    size = lengths[order].astype(np.int64)
    if len(order):
        step = np.left_shift(1, MAX_BITS - size)
        codes[order] = ((np.cumsum(step) - step) >> (MAX_BITS - size)).astype(np.uint32)
    return codes


def encode_bits(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, block: int = BLOCK) -> tuple[bytes, np.ndarray]:
    """The ids' bits, padded to whole bytes, and the bit offset of every block."""
    if not len(ids):
        return b"", np.zeros(0, np.int64)
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    begins = ends - size
    word, used = begins >> 5, (begins & 31) + size
    # A code of at most 33 bits lies in the 64 bits that start at its 32-bit word.
    value = codes[ids].astype(np.uint64) << (64 - used).astype(np.uint64)
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    both = np.bitwise_or.reduceat(value, first)
    out = np.zeros(int(word[-1]) + 2, np.uint32)
    at = word[first]
    out[at] |= (both >> np.uint64(32)).astype(np.uint32)
    out[at + 1] |= (both & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return out.astype(">u4").tobytes()[: -(-int(ends[-1]) // 8)], begins[::block]


def decode_table(lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By the next MAX_BITS bits: the id, and the bits that it takes."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    spans = np.left_shift(1, MAX_BITS - lengths[order].astype(np.int64))
    ids, sizes = np.zeros(1 << MAX_BITS, np.uint32), np.zeros(1 << MAX_BITS, np.uint8)
    filled = int(spans.sum())
    ids[:filled], sizes[:filled] = np.repeat(order, spans), np.repeat(lengths[order], spans)
    return ids, sizes


def decode_blocks(bits: bytes, offsets: np.ndarray, n_ids: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All blocks' ids, one after another. Blocks advance side by side, one id each a step."""
    raw = np.frombuffer(bits + b"\0" * 8, np.uint8).astype(np.uint32)
    windows = (raw[:-3] << np.uint32(24)) | (raw[1:-2] << np.uint32(16)) | (raw[2:-1] << np.uint32(8)) | raw[3:]
    order = np.argsort(-n_ids, kind="stable")
    at, left, starts = offsets[order].copy(), n_ids[order], (np.cumsum(n_ids) - n_ids)[order]
    out = np.zeros(int(n_ids.sum()), np.uint32)
    live = np.searchsorted(-left, -np.arange(int(left[0]) if len(left) else 0), "left")
    for step, n in enumerate(live):
        pos = at[:n]
        seen = (windows[pos >> 3] >> (np.uint32(32 - MAX_BITS) - (pos & 7).astype(np.uint32))) & np.uint32((1 << MAX_BITS) - 1)
        out[starts[:n] + step] = ids[seen]
        at[:n] = pos + sizes[seen]
    return out


def id_table(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, n_ids, ids, salt): each document's ids with the end id, as little-endian numbers, 16 bits each if all fit, and a random number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds("token files")
        enc, rng = table_encoder(path, end_id, CACHE_PIECES), np.random.default_rng()
        wide = "<u2" if enc.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            doc_ids, behind = b.column("doc_id").cast(pa.int64()), np.cumsum([len(t) for t in texts])
            lo = 0
            while lo < len(texts):
                hi = max(lo + 1, int(np.searchsorted(behind, (behind[lo - 1] if lo else 0) + AT_ONCE, "right")))
                ids, ends = enc.encode(texts[lo:hi])
                raw = ids.astype(wide)
                cuts = np.r_[0, ends]
                column = pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(cuts * raw.itemsize), pa.py_buffer(raw)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([doc_ids.slice(lo, hi - lo), pa.array(np.diff(cuts), pa.int64()), column, pa.array(rng.integers(0, 2**62, hi - lo))], names=["doc_id", "n_ids", "ids", "salt"])
                lo = hi

    return only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_ids long, ids binary, salt long")


def _numbers(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype(np.int64)


def count_ids(table: DataFrame) -> np.ndarray:
    """How often each id occurs; as many rows reach the driver as there are different ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in (whole.slice(lo, 256) for whole in batches for lo in range(0, whole.num_rows, 256)):
            # A table's ids are all of one width.
            part = np.bincount(_numbers(b"".join(b.column("ids").to_pylist()), sum(b.column("n_ids").to_pylist())))
            if len(part) > len(total):
                total = np.r_[total, np.zeros(len(part) - len(total), np.int64)]
            total[: len(part)] += part
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])

    summed = table.select("n_ids", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(int(max(summed["id"].to_pylist(), default=-1)) + 1, np.int64)
    counts[summed["id"].to_numpy()] = summed["n"].to_numpy()
    return counts


def _file_system(uri: str):
    """A folder's file system and its path there, as Python workers reach it."""
    from pyarrow import fs

    scheme, found, rest = uri.partition(":")
    if not found or uri.startswith("/"):
        return fs.FileSystem.from_uri("file://" + uri)
    if scheme == "file":
        return fs.FileSystem.from_uri("file:///" + rest.lstrip("/"))
    return fs.FileSystem.from_uri(("s3" if scheme in ("s3a", "s3n") else scheme) + ":" + rest)


_WRITTEN = "file string, task int, seq int, docs long, ids long"


def write_files(docs: DataFrame, path: str, out: str, end_id: int = 0, file_ids: int = FILE_IDS, block: int = BLOCK) -> DataFrame:
    """Writes the files into the folder out (shared by all executors) and returns (file, docs, ids, start) as written: start counts the ids in all files before."""
    spark = docs.sparkSession
    table = materialize(id_table(docs, path, end_id), "token-ids")
    counts = count_ids(table)
    lengths = code_lengths(counts)
    total = int(counts.sum())
    sent = spark.sparkContext.broadcast((lengths, canonical(lengths)))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, code = sent.value
        task = TaskContext.get().partitionId()
        system, folder = _file_system(out)
        held: list = []
        done: list[tuple] = []

        def close() -> None:
            doc_ids = np.array([r[0] or 0 for r in held], "<i8")
            n_ids = np.array([r[1] for r in held], "<i8")
            sizes = np.array([len(r[2]) for r in held], np.int64)
            base = (np.cumsum(sizes) - sizes) * 8
            offsets = np.concatenate([r[3] + o for r, o in zip(held, base, strict=True)])
            per = np.concatenate([np.r_[np.full((n - 1) // block, block), (n - 1) % block + 1] for n in n_ids]).astype("<i4")
            # A task that is repeated or runs twice writes files of names of its own; the table lists those that count.
            name = f"ids-{task:06d}-{len(done):04d}-{os.urandom(4).hex()}.huf"
            with system.open_output_stream(f"{folder}/_{name}") as f:
                f.write(struct.pack(_HEAD, _MAGIC, len(size), len(held), sum(r[0] is None for r in held), len(per), block, int(sizes.sum())))
                for part in (size.tobytes(), doc_ids.tobytes(), n_ids.tobytes(), per.tobytes(), offsets.astype("<i8").tobytes()):
                    f.write(part)
                for r in held:
                    f.write(r[2])
            system.move(f"{folder}/_{name}", f"{folder}/{name}")
            done.append((name, task, len(done), len(held), int(n_ids.sum())))
            held.clear()

        inside = 0
        for b in batches:
            for doc_id, n, data in zip(b.column("doc_id").to_pylist(), b.column("n_ids").to_pylist(), b.column("ids"), strict=True):
                if held and inside + n > file_ids:
                    close()
                    inside = 0
                bits, blocks = encode_bits(_numbers(data.as_buffer(), n), size, code, block)
                held.append((doc_id, n, bits, blocks))
                inside += n
        if held:
            close()
        yield pa.RecordBatch.from_pylist([dict(zip(("file", "task", "seq", "docs", "ids"), d, strict=True)) for d in done], schema=pa.schema([("file", pa.string()), ("task", pa.int32()), ("seq", pa.int32()), ("docs", pa.int64()), ("ids", pa.int64())]))

    system, folder = _file_system(out)
    system.create_dir(folder, recursive=True)
    tasks = int(min(max(1, -(-total // file_ids)), MAX_TASKS))
    # Dealing by ranges takes a sample first, in a pass of its own: so rows are dealt as they lie in the table, and encoded behind it.
    order = [F.col("doc_id").asc_nulls_first(), "n_ids", "hash", "salt"]
    ordered = table.withColumn("hash", F.xxhash64("ids")).repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    written = materialize(ordered.drop("hash", "salt").mapInArrow(write, _WRITTEN), "token-files")
    # One small row per file, in one ordered sum.
    before = Window.orderBy("task", "seq").rowsBetween(Window.unboundedPreceding, -1)
    written.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0))).coalesce(1).write.parquet(f"{out}/_starts")
    return starts(spark, out)


def starts(spark: SparkSession, folder: str) -> DataFrame:
    """(file, docs, ids, start) of the files of a folder that count."""
    return spark.read.schema("file string, docs long, ids long, start long").parquet(f"{folder}/_starts")


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids, ids_crc32): the documents of a folder of such files; ids are little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, data in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                view = data.as_buffer()
                magic, symbols, n_docs, n_nulls, n_blocks, block, n_bits = struct.unpack_from(_HEAD, view, 0)
                if magic != _MAGIC:
                    raise ValueError("not a token-id file")
                at, parts = _HEAD_BYTES, []
                for kind, n in (("u1", symbols), ("<i8", n_docs), ("<i8", n_docs), ("<i4", n_blocks), ("<i8", n_blocks)):
                    parts.append(np.frombuffer(view, kind, n, at))
                    at += parts[-1].nbytes
                lengths, doc_ids, n_ids, per, offsets = parts
                table = decode_table(lengths, canonical(lengths))
                blocks = np.r_[0, np.cumsum(-(-n_ids // block))] if n_docs else np.zeros(1, np.int64)
                inside = np.cumsum(n_ids) - n_ids
                step = 2000
                for lo in range(0, n_docs, step):
                    hi = min(n_docs, lo + step)
                    first, last = int(blocks[lo]), int(blocks[hi])
                    begin = int(offsets[first]) // 8
                    end = int(offsets[last]) // 8 if last < n_blocks else n_bits
                    ids = decode_blocks(bytes(view[at + begin : at + end]), offsets[first:last] - 8 * begin, per[first:last].astype(np.int64), *table)
                    cuts = np.r_[0, np.cumsum(n_ids[lo:hi])]
                    raw = [ids[i:j].astype("<u4").tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([path.rsplit("/", 1)[-1]] * (hi - lo), pa.string()),
                            pa.array(doc_ids[lo:hi], pa.int64(), mask=np.arange(lo, hi) < n_nulls),
                            pa.array(inside[lo:hi], pa.int64()),
                            pa.array(n_ids[lo:hi], pa.int64()),
                            pa.array(raw, pa.binary()),
                            pa.array([zlib.crc32(x) for x in raw], pa.int64()),
                        ],
                        names=["file", "doc_id", "inside", "n_tokens", "ids", "ids_crc32"],
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.huf").schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    found = files.select("path", "content").mapInArrow(run, "file string, doc_id long, inside long, n_tokens long, ids binary, ids_crc32 long")
    known = starts(spark, folder).select(F.col("file").alias("known"), F.col("start").alias("base"))
    few = known.count() <= BROADCAST_FILES
    joined = found.join(F.broadcast(known) if few else known, F.col("file") == F.col("known"))
    return joined.select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids", "ids_crc32")


def encode_corpus(docs: DataFrame, path: str, end_id: int = 0, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes docs as files into a new shared folder and reads them back."""
    out = scratch_path(docs.sparkSession, "huffman")
    write_files(docs, path, out, end_id, file_ids)
    return read_files(docs.sparkSession, out)
