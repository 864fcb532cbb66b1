r"""MinHash near-dedup with bottom-k sketches.

A document's set holds the hashes of its distinct shingles of five lower-cased words. One hash function orders
shingles; the k smallest values are the sketch. Documents with equal sets are one node, so copies never meet in pairs;
a node is named by the first half of the set's 128-bit fingerprint, whatever the ids of its rows.

1. Inverted lists of retained values: a pair of similarity 0.75 or more shares at least `least` values of its sketches
   (half of k; for sets that lie in the sketch whole, three quarters of the set, which is exact). So it also meets in
   the list of one of each document's rarest values, all but least - 1 of those that it shares with any other. Common
   passages fall out here; lists are never cut.
2. Each list is named after one member, its hub (the member whose values are the most common, which in a family of
   copies is about its origin). Lists of one hub are one group, so a family's many lists are worked on once.
3. Members of a group larger than a block are held against its hub first, on full sets. Those that link to it are
   settled: among themselves they need not be compared. That is linear in the family, however many its members.
4. The others meet in blocks: a small group is one block; of a large one, each block of members that are not settled
   meets each block of members, as a task of bounded size. Union-sketch estimation keeps the documents that have a
   likely partner there.
5. Exact Jaccard on the full sets of those verifies, again by blocks. Of the links within such a task a spanning forest
   is kept, so rows stay in proportion to documents.
6. Components of the links, by alternating large and small stars over tables.

Disk: what is filtered is not shuffled. Full sets and sketches are told by bitmaps of the nodes that take part, so texts
never meet in a join; joins on the nodes that follow take out what got through by chance. Sketches' values are shuffled
once, under nodes' numbers. Scratch tables and shuffle files go as soon as the step that reads them is done.

The chance to miss a link of similarity 0.75 is that of 64 trials at 0.75 giving under 32, about 3e-6, and falls
steeply above. Links are exact: they are confirmed on full sets (of 63-bit hashes).

Defined cases: a null or blank text has an empty set and links with nothing; under five words, the whole sequence is
the one shingle; rows that repeat a doc_id get the component of their own text; a row without doc_id takes part but
never names a component of documents that have one (a component without any has a null name); kept are the rows of the
component's smallest doc_id, of several texts under it those of one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from spillway.llm.common import discard, holds, materialize, only, set_aside, trim_driver

K = 64
SHINGLE = 5
#: Documents, and shingles, of a block, about.
BLOCK_DOCS, BLOCK_SHINGLES = 256, 400_000
#: Bits of a bitmap for each wanted hash, at least: one in 16 others passes at most; and of a whole one, at most (32 MB), beyond which more pass.
BITS, MOST_BITS = 16, 1 << 28

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """The sorted distinct 63-bit hashes of a text's shingles."""
    from xxhash import xxh3_64_intdigest

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six blanks only
    n = len(found)
    if not n:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, n)
    odd = np.resize(_ODD, width)
    if n < width:
        x = (h * odd[:n]).sum(keepdims=True) + np.uint64(n)
    else:
        x = h[: n - width + 1] * odd[0]
        for i in range(1, width):
            x = x + h[i : n - width + 1 + i] * odd[i]
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return np.unique((x ^ (x >> np.uint64(31))) >> np.uint64(1)).astype(np.int64)


def _name(s: np.ndarray) -> int:
    """A set's node."""
    from xxhash import xxh3_128_digest

    return int.from_bytes(xxh3_128_digest(s.tobytes())[:8], "little", signed=True)


def signatures(docs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, n, x, sketch): set size, the set's node, the k smallest values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds("near-dedup")
        for b in batches:
            n, names, sketches = [], [], []
            for text in b.column("text").to_pylist():
                s = shingles(text)
                n.append(len(s))
                names.append(_name(s))
                sketches.append(s[:k])
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(names, pa.int64()), pa.array(sketches, pa.list_(pa.int64()))], names=["doc_id", "n", "x", "sketch"])

    return only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n long, x long, sketch array<long>")


def _bitmap(wanted: DataFrame) -> Broadcast[np.ndarray]:
    """The hashes h of wanted, each by a bit."""
    bits = min(MOST_BITS, max(64, 1 << (BITS * wanted.count()).bit_length()))
    words = wanted.select(F.col("h").bitwiseAND(F.lit(bits - 1)).alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(at & 63 AS INT))")).alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return wanted.sparkSession.sparkContext.broadcast(out)


def _passes(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes may be wanted: all that are, few others."""
    at = h & (len(bitmap) * 64 - 1)
    return (bitmap[at >> 6] >> (at & 63)) & 1 == 1


def _among(sketches: DataFrame, nodes: DataFrame) -> DataFrame:
    """(x, sketch) of nodes (x) and few others."""
    sent = _bitmap(nodes.select(F.col("x").alias("h")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_passes(sent.value, b.column("x").to_numpy())))

    return sketches.select("x", "sketch").mapInArrow(run, "x long, sketch array<long>")


def _sets(docs: DataFrame, wanted: Broadcast[np.ndarray], ids: Broadcast[np.ndarray] | None = None) -> DataFrame:
    """(x, values) of the texts of docs (h, text) whose node may be wanted; ids: which texts are worth a look, by h."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b if ids is None else b.filter(pa.array(_passes(ids.value, b.column("h").to_numpy())))
            # Rows of one batch may hold long texts; sets leave a few at a time.
            for part in (b.slice(i, 256) for i in range(0, b.num_rows, 256)):
                sets = [(_name(s), s) for s in map(shingles, part.column("text").to_pylist())]
                here = _passes(wanted.value, np.array([x for x, _ in sets], np.int64))
                sets = [x for x, passes in zip(sets, here, strict=True) if passes]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in sets], pa.int64()), pa.array([s for _, s in sets], pa.list_(pa.int64()))], names=["x", "values"])

    return docs.select("h", "text").mapInArrow(run, "x long, values array<long>")


def _common(flat: np.ndarray, row: np.ndarray, m: int, wide: int = 4096) -> np.ndarray:
    """How many values each two of m rows have in common; flat: all values, row: whose they are."""
    order = np.argsort(flat, kind="stable")
    v, r = flat[order], row[order]
    new = np.r_[True, v[1:] != v[:-1]]
    at = np.cumsum(new) - 1
    shared = np.bincount(at)[at] > 1
    at, r = at[shared], r[shared]
    out = np.zeros((m, m), np.float32)
    if not len(at):
        return out
    at = np.cumsum(np.r_[True, at[1:] != at[:-1]]) - 1
    for lo in range(0, int(at[-1]) + 1, wide):
        i, j = np.searchsorted(at, [lo, lo + wide])
        grid = np.zeros((m, int(at[j - 1]) - lo + 1), np.float32)
        grid[r[i:j], at[i:j] - lo] = 1
        out += grid @ grid.T
    return out


def _table(t: pa.Table, values: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    lists = t[values].combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else lists.chunk(0)
    sizes = pc.list_value_length(lists).to_numpy()
    return t["x"].to_numpy(), t["block"].to_numpy(), sizes, lists.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)


def _across(x: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Which pairs a task answers for: those across its two sides, or all of its one side; never a document and itself."""
    sides = np.ones((len(block), len(block)), bool) if len(np.unique(block)) == 1 else block[:, None] != block[None, :]
    return sides & (x[:, None] != x[None, :])


def _likely(t: pa.Table, k: int) -> pa.Table:
    x, block, sizes, flat, row = _table(t, "sketch")
    m, n = len(x), t["n"].to_numpy()
    last = np.where(n > k, flat[np.cumsum(sizes) - 1], np.iinfo(np.int64).max)
    ends = np.cumsum(sizes)
    upto = np.array([np.searchsorted(flat[e - s : e], last, "right") for s, e in zip(sizes, ends, strict=True)])  # of each row's values, how many lie within each row's sketch
    low = last[:, None] <= last[None, :]
    mine, theirs = np.where(low, sizes[:, None], upto), np.where(low, upto.T, sizes[None, :])
    both = _common(flat, row, m)
    whole = (n[:, None] <= k) & (n[None, :] <= k)
    union = mine + theirs - both
    good = np.where(whole, 100 * both >= 75 * union, 2 * both >= union) & (4 * np.minimum(n[:, None], n[None, :]) >= 3 * np.maximum(n[:, None], n[None, :])) & _across(x, block)
    keep = pa.array(good.any(1))
    return t.select(["hub", "x", "n", "loose"]).filter(keep)


def _links(t: pa.Table) -> pa.Table:
    x, block, sizes, flat, row = _table(t, "values")
    both = _common(flat, row, len(x)).astype(np.int64)
    linked = (100 * both >= 75 * (sizes[:, None] + sizes[None, :] - both)) & _across(x, block)
    a, b, seen = [], [], np.zeros(len(x), bool)
    for root in np.argsort(x, kind="stable"):
        if seen[root]:
            continue
        seen[root] = True
        front = np.array([root])
        while len(front):
            new = np.flatnonzero(linked[front].any(0) & ~seen)
            seen[new] = True
            a.append(x[new])
            b.append(np.full(len(new), x[root]))
            front = new
    a, b = np.concatenate(a) if a else x[:0], np.concatenate(b) if b else x[:0]
    return pa.table({"a": a[a != b], "b": b[a != b]})


def _held_against_hub(t: pa.Table) -> pa.Table:
    """Which members of a cell link to the hub, whose set is in every cell."""
    x, cell, sizes, flat, row = _table(t, "values")
    at_hub = np.flatnonzero(x == t["hub"].to_numpy())[0]
    end = int(np.cumsum(sizes)[at_hub])
    hub = flat[end - sizes[at_hub] : end]
    both = np.bincount(row, hub[np.minimum(np.searchsorted(hub, flat), len(hub) - 1)] == flat, len(x)).astype(np.int64)
    linked = 100 * both >= 75 * (sizes + len(hub) - both)
    keep = pa.array((np.arange(len(x)) != at_hub) | (cell == 0))
    return t.select(["hub", "x", "n"]).append_column("loose", pa.array(~linked)).filter(keep)


def _sizes(members: DataFrame) -> DataFrame:
    """(hub, blocks, loose_blocks) of groups of two and more with a member that is not settled; one block is a whole group."""

    def blocks(docs: str, total: str) -> Column:
        return F.greatest(F.ceil(F.col(docs) / BLOCK_DOCS), F.ceil(F.col(total) / BLOCK_SHINGLES)).cast("int")

    each = members.groupBy("hub").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("total"), F.sum(F.when(F.col("loose"), 1).otherwise(0)).alias("free"), F.sum(F.when(F.col("loose"), F.col("n")).otherwise(0)).alias("free_total")
    )
    whole = F.least(blocks("members", "total"), F.ceil(F.col("members") / 2).cast("int"))
    return each.filter("members > 1 AND free > 0").select("hub", whole.alias("blocks"), F.greatest(F.least(blocks("free", "free_total"), F.col("free").cast("int")), F.lit(1)).alias("loose_blocks"))


def _dealt(members: DataFrame) -> DataFrame:
    """members (hub, x, n, loose, ...) copied to the tasks (hub, i, j) that they meet in, with the side that they are on there: block.

    A group of one block is one task with one side. In larger ones task (i, j) holds block i of the members that are
    not settled against block j of all members."""
    sized = members.join(_sizes(members), "hub")
    one = F.col("blocks") == 1
    mine = F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int")
    free = F.pmod(F.xxhash64("x", F.lit("loose")), F.col("loose_blocks")).cast("int")
    place = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("block"))
    as_any = F.transform(F.sequence(F.lit(0), F.when(one, 0).otherwise(F.col("loose_blocks") - 1)), lambda i: place(i, F.when(one, 0).otherwise(mine), 1))
    as_free = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: place(free, j, 0))
    places = F.when(one | ~F.col("loose"), as_any).otherwise(F.concat(as_any, as_free))
    return sized.withColumn("place", F.explode(places)).select(*members.columns, "place.i", "place.j", "place.block")


def links(docs: DataFrame, sketches: DataFrame, firsts: DataFrame, k: int = K) -> DataFrame:
    """Verified links (a, b) between nodes: enough of them to connect what is connected.

    sketches: (x, n, sketch, number), a scratch table, which is deleted; firsts: (x, first), the smallest doc_id of the
    node's rows; a row per node."""
    spark = docs.sparkSession
    entries = sketches.select("number", F.explode("sketch").alias("v"))
    known = entries.withColumn("freq", F.count(F.lit(1)).over(Window.partitionBy("v"))).filter("freq > 1").join(sketches.select("number", "x", "n"), "number")
    per = Window.partitionBy("number")
    least = F.when(F.col("n") <= k * 3 // 4, F.ceil(F.col("n") * 0.75)).otherwise(F.lit(k // 2))
    ranked = known.select(
        "x", "n", "v", F.row_number().over(per.orderBy("freq", "v")).alias("at"), F.count(F.lit(1)).over(per).alias("shared"), F.sum("freq").over(per).alias("score")
    )
    listed = materialize(ranked.filter(F.col("at") <= F.col("shared") - least + 1).select("x", "n", "v", "score"), "dup-lists")
    trim_driver(spark)
    hubs = listed.groupBy("v").agg(F.max(F.struct("score", "x")).alias("top"), F.count(F.lit(1)).alias("n_docs")).filter("n_docs > 1").select("v", F.col("top.x").alias("hub"))
    members = materialize(listed.join(hubs, "v").groupBy("hub", "x").agg(F.max("n").alias("n")).withColumn("loose", F.lit(True)), "dup-members")
    texts = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("first"), "text")

    def full_sets(nodes: DataFrame) -> DataFrame:
        """(x, values) of nodes (x): other texts under their ids come along, a join on x leaves them out."""
        ids = materialize(nodes.distinct().join(firsts, "x"), "dup-ids")
        ided, bare = ids.filter("first IS NOT NULL"), ids.filter("first IS NULL").select("x")
        bits = lambda of, h: _bitmap(of.select(h.alias("h")))
        h = F.xxhash64("first")
        named = _sets(texts.filter("first IS NOT NULL").withColumn("h", h), bits(ided, F.col("x")), bits(ided, h))
        unnamed = _sets(texts.filter("first IS NULL").withColumn("h", h), bits(bare, F.col("x"))).join(bare, "x", "left_semi").dropDuplicates(["x"])
        return named.union(unnamed)

    large = materialize(_sizes(members).filter("blocks > 1").select("hub", "blocks"), "dup-large")
    settled = None
    if large.limit(1).count():
        cells = F.when(F.col("x") == F.col("hub"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int")))
        inside = materialize(members.join(large, "hub").select("hub", "x", "n", F.explode(cells).alias("block")), "dup-inside")
        told = inside.join(full_sets(inside.select("x")), "x").select("hub", "x", "n", "block", "values")
        told = materialize(told.groupBy("hub", "block").applyInArrow(_held_against_hub, "hub long, x long, n long, loose boolean"), "dup-held").distinct()
        trim_driver(spark)
        settled = told.filter("NOT loose AND x <> hub").select(F.col("x").alias("a"), F.col("hub").alias("b"))
        members = members.join(large, "hub", "left_anti").unionByName(told)
    first = _dealt(members).join(_among(sketches, members), "x").select("hub", "i", "j", "x", "block", "n", "loose", "sketch")
    likely = first.groupBy("hub", "i", "j").applyInArrow(lambda t: _likely(t, k), "hub long, x long, n long, loose boolean").distinct()
    likely = materialize(likely, "dup-likely")
    discard(sketches)
    trim_driver(spark)
    second = _dealt(likely).join(full_sets(likely.select("x")), "x").select("hub", "i", "j", "x", "block", "values")
    found = second.groupBy("hub", "i", "j").applyInArrow(_links, "a long, b long")
    return found if settled is None else found.union(settled)


def components(edges: DataFrame) -> DataFrame:
    """(x, component) of all nodes with links: the smallest node that each can reach.

    Every round lets each node point its larger neighbours, then itself and its smaller ones, at the smallest node it
    sees; it ends when a round changes nothing, after about the logarithm of the longest chain.
    """

    def stars(e: DataFrame, large: bool) -> DataFrame:
        sym = e.union(e.select("b", "a")).toDF("a", "b") if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = sym.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        seen = sym.join(low, "a")
        if large:
            out = seen.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            out = seen.select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
        return out.filter("a <> b").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = materialize(edges.filter("a <> b").distinct(), "dup-links")
    before, at = None, state(now)
    while at != before:
        now = materialize(stars(stars(now, True), False), "dup-stars")
        before, at = at, state(now)
    return now.select(F.col("a").alias("x"), F.col("b").alias("component"))


def _told(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, x, component_id, kept), a row per row of docs."""
    base = only(docs, "doc_id", "text")
    sigs = materialize(signatures(base, k), "dup-signatures")
    rows = materialize(sigs.select("doc_id", "n", "x"), "dup-rows")
    firsts = materialize(rows.filter("n > 0").groupBy("x").agg(F.min("doc_id").alias("first")), "dup-nodes")
    # A node's sketch is any of its rows' (they are equal).
    nodes = sigs.filter("n > 0").select("x", "n", "sketch").dropDuplicates(["x"])
    sketches = materialize(nodes.withColumn("number", F.monotonically_increasing_id()), "dup-sketches")
    discard(sigs)
    trim_driver(base.sparkSession)
    found = components(links(base, sketches, firsts, k))
    named = firsts.join(found, "x", "left").select("x", "first", F.coalesce("component", "x").alias("component"))
    tops = named.groupBy("component").agg(F.min(F.struct(F.col("first").isNull().alias("none"), "first", "x")).alias("top"))
    named = named.join(tops, "component").select("x", F.col("top.first").alias("top_id"), F.col("top.x").alias("top_x"))
    own = rows.join(named, "x", "left")
    component = F.when(F.col("n") > 0, F.col("top_id")).otherwise(F.col("doc_id"))
    kept = (F.col("n") == 0) | (F.col("doc_id").eqNullSafe(F.col("top_id")) & (F.col("x") == F.col("top_x")))
    return own.select("doc_id", "n", "x", component.alias("component_id"), kept.alias("kept"))


def near_duplicates(docs: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row per row of docs."""
    return _told(docs, k).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "kept")


def dedup(docs: DataFrame, k: int = K) -> DataFrame:
    """docs with one row of each component left: of its smallest doc_id. Blank texts link with nothing, so all of them stay.

    Ids of one row name it; rows whose doc_id is null or repeated are told apart by their texts' nodes."""
    names, docs = docs.columns, set_aside(docs, "nd_")
    told = materialize(_told(docs, k), "dup-told")
    kept = told.filter("kept").select(F.col("doc_id").alias("nd_id"), F.col("x").alias("nd_x"), F.col("n").alias("nd_n"))
    repeated = materialize(told.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("nd_id")).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("nd_id"), "dup-repeated")
    plain = docs.join(kept.join(repeated, "nd_id", "left_anti"), docs["doc_id"] == kept["nd_id"], "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [_name(shingles(t)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(x, pa.int64())], names=[*b.schema.names, "nd_own"])

    vague = docs.filter(docs["doc_id"].isNull()).union(docs.join(repeated, docs["doc_id"] == repeated["nd_id"], "left_semi"))
    vague = vague.mapInArrow(run, StructType([*docs.schema.fields, StructField("nd_own", LongType())]))
    stay = kept.dropDuplicates(["nd_id", "nd_x"])
    vague = vague.join(stay, vague["doc_id"].eqNullSafe(stay["nd_id"]) & (vague["nd_own"] == stay["nd_x"]))
    one = only(vague.filter("nd_n > 0").dropDuplicates(["doc_id", "nd_own"]), *docs.columns)
    return plain.union(one).union(only(vague.filter("nd_n = 0"), *docs.columns)).toDF(*names)
