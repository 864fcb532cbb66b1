"""Mixing sources to target weights.

Tokens are aggregated per source, a source's repetition rate is its target over its size, and every document is
emitted floor(rate) times plus one hash-seeded Bernoulli copy whose probability is the fraction.

Defined cases: a null text has size 0; null sources form one source that sorts last; an empty table gives an empty
result; a source without any word has target 0 and gives no copies; rows that repeat a doc_id draw the same hash and so
the same number of copies; rows without a doc_id draw by their text; extra columns are carried along, by mix() whatever
their names.

Copies are drawn one by one, so a source's taken words spread around its target: with fraction p of a copy and sizes s
the standard deviation is sqrt(p (1 - p) sum s^2), which is small beside the target unless few documents hold most of
the source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spillway.llm.common import materialize, n_words, only, set_aside

#: Up to so many sources the table of targets is broadcast (under 40 MB); more are joined by a shuffle, with AQE's skew handling.
BROADCAST_SOURCES = 200_000


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the document's id (where that is null, its text) and the seed alone."""
    named = F.coalesce(doc_id.cast("string"), F.concat(F.lit("null|"), F.md5(F.coalesce(text, F.lit("")))))
    digest = F.md5(F.concat(named, F.lit("|" + seed)))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(2**48))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """Targets of sources given (source, source_size).

    Sources in code point order (null last) take the weights in turn and share the sum of all sizes by weight. No
    target exceeds cap times its source's size; what is over is reshared by weight among the others. That fixed point
    fills sources in the order of size / weight: those before the first that fits under its cap are capped, and the
    rest share what is left. The frame has one row per source, after full aggregation.
    """
    given = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod(F.col("rn") - 1, F.lit(len(weights))) + 1).cast("int"))
    every = Window.partitionBy()
    fill = Window.orderBy(F.col("source_size") / F.col("w"), "rn")
    before, onward = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return (
        sizes.withColumn("rn", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("w", given)
        .withColumn("pos", F.row_number().over(fill))
        .withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0)))
        .withColumn("w_left", F.sum("w").over(onward))
        .withColumn("fits", F.col("left") * F.col("w") <= F.col("source_size") * cap * F.col("w_left"))
        .withColumn("first", F.min(F.when(F.col("fits"), F.col("pos"))).over(every))
        .withColumn("share_left", F.max(F.when(F.col("pos") == F.col("first"), F.col("left"))).over(every))
        .withColumn("share_w", F.max(F.when(F.col("pos") == F.col("first"), F.col("w_left"))).over(every))
        .withColumn(
            "target",
            F.when(F.col("first").isNull() | (F.col("pos") < F.col("first")), (F.col("source_size") * cap).cast("double")).otherwise(
                F.col("share_left").cast("double") * F.col("w") / F.col("share_w")
            ),
        )
        .select("source", "source_size", "target")
    )


def plan(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, seed: str = "mix-1") -> DataFrame:
    """docs with the columns mx_size, mx_source_size, mx_target, mx_copies added (mx_* columns of docs are replaced)."""
    sizes = only(docs, "source", "text").select("source", n_words(F.col("text")).alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sizes, weights, cap), "mix-targets")
    renamed = targets.select(F.col("source").alias("mx_source"), F.col("source_size").alias("mx_source_size"), F.col("target").alias("mx_target"))
    few = targets.count() <= BROADCAST_SOURCES
    sized = docs.drop("mx_source", "mx_source_size", "mx_target", "mx_copies").withColumn("mx_size", n_words(F.col("text")))
    joined = sized.join(F.broadcast(renamed) if few else renamed, sized["source"].eqNullSafe(renamed["mx_source"]), "inner").drop("mx_source")
    rate = F.when(F.col("mx_source_size") > 0, F.col("mx_target") / F.col("mx_source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + F.when(draw(F.col("doc_id"), F.col("text"), seed) < rate - F.floor(rate), 1).otherwise(0)
    return joined.withColumn("mx_copies", copies.cast("long"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), cap: int = 3, seed: str = "mix-1") -> DataFrame:
    """The mixed corpus: each document's row as often as the mix takes it, with the columns of docs."""
    own = set_aside(docs, "mx_")
    planned = plan(own, weights, cap, seed).filter(F.col("mx_copies") > 0)
    copied = planned.withColumn("mx_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mx_copies"))))
    return only(copied, *own.columns).toDF(*docs.columns)
