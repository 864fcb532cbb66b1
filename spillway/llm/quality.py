r"""Quality rules: text statistics, then a hashed n-gram log-likelihood ratio, all in DataFrame functions.

Two multinomials over hashed word unigrams and bigrams are counted: one over trusted target documents, one over the
whole raw corpus. A document's score is the sum of log(p_target / p_raw) over its n-grams, divided by their number; it
is kept if no base rule fails and the score reaches a fixed threshold.

The target is a documented bounded sample: the max_target trusted ids that come first by hash. Everything else
counts the whole corpus. The model is one array of 2 * buckets doubles, whatever the size of the corpus.

Defined cases: a null text has no words, fails the base rules and scores 0; rows that repeat a doc_id are judged one
by one (and alike); without any trusted document both distributions are alike and the score is 0; an empty table
gives an empty result; extra columns are carried along (columns named q_* are the operator's own and replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spillway.llm.common import BLANKS, materialize, only, words

#: Rows of the model per n-gram length; trusted documents taken at most; additive smoothing; least score that is kept.
BUCKETS = 1 << 14
MAX_TARGET = 20_000
SMOOTHING = 1.0
THRESHOLD = -0.25
SYMBOLS = "#*$%&|<>"


def _bigram(u: Column, x: Column, i: Column, buckets: int) -> Column:
    return (F.pmod(F.xxhash64(x, F.get(u, i + 1)), F.lit(buckets)) + buckets).cast("int")


def _grams(u: Column, buckets: int) -> Column:
    """Buckets of all unigrams, and behind them of all bigrams, given the words' hashes."""
    one = F.transform(u, lambda x: F.pmod(x, F.lit(buckets)).cast("int"))
    return F.concat(one, F.transform(F.slice(u, 1, F.greatest(F.size(u) - 1, F.lit(0))), lambda x, i: _bigram(u, x, i, buckets)))


def fit(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, max_target: int = MAX_TARGET, smoothing: float = SMOOTHING) -> DataFrame:
    """(bucket, weight) for all 2 * buckets: the log ratio of the two smoothed multinomials.

    trusted has the doc_ids of target documents."""
    ids = trusted.select(F.col("doc_id").cast("long").alias("q_id")).filter("q_id IS NOT NULL").distinct()
    ids = ids.orderBy(F.xxhash64("q_id"), "q_id").limit(max_target).withColumn("q_target", F.lit(1))
    base = only(docs, "doc_id", "text")
    flagged = base.join(F.broadcast(ids), base["doc_id"] == ids["q_id"], "left").select("q_target", F.transform(words(F.col("text")), lambda x: F.xxhash64(x)).alias("q_u"))
    counted = flagged.select("q_target", F.explode(_grams(F.col("q_u"), buckets)).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("q_target").alias("target"))
    counts = materialize(counted, "quality-counts")
    total = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"), F.coalesce(F.sum("target"), F.lit(0)).alias("target")).first()
    every = docs.sparkSession.range(2 * buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")

    def share(count: str) -> Column:
        return F.log((F.coalesce(F.col(count), F.lit(0)) + smoothing) / F.lit(float(total[count] + 2 * buckets * smoothing)))

    blank = total["target"] == 0
    return materialize(every.select("bucket", (F.lit(0.0) if blank else share("target") - share("raw")).alias("weight")), "quality-weights")


def measured(docs: DataFrame) -> DataFrame:
    """docs with q_u (the words' hashes) and the base statistics q_n_words, q_word_chars, q_n_symbols, q_n_dup_lines, q_n_repeat_words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    w, u, h, p, at = (F.col(c) for c in ("q_words", "q_u", "q_h", "q_p", "q_at"))
    last = F.size(u) - 3
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    first = docs.drop("q_words", "q_u", "q_n_words", "q_word_chars", "q_n_symbols", "q_n_dup_lines", "q_n_repeat_words", "q_h", "q_p", "q_at", "q_lines")
    return (
        first.withColumns({"q_words": words(F.col("text")), "q_lines": lines})
        .withColumns(
            {
                "q_n_words": F.size(w).cast("long"),
                "q_word_chars": F.char_length(F.array_join(w, "")).cast("long"),
                "q_n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
                "q_n_dup_lines": (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long"),
                "q_u": F.transform(w, lambda x: F.xxhash64(x)),
            }
        )
        # A hash for each window of three words, by position.
        .withColumn("q_h", F.transform(F.slice(u, 1, F.greatest(last + 1, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(u, i + 1), F.get(u, i + 2))))
        # Windows sorted by hash, with their positions: one that occurs twice or more lies beside its like.
        # Columns that a lambda reads are named twice at least: Catalyst then computes them once a row instead of inlining them into the lambda.
        .withColumn("q_p", F.when(F.size(h) > F.size(F.array_distinct(h)), F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
        .withColumn("q_at", F.sort_array(F.transform(F.filter(p, lambda x, i: F.coalesce(x["h"] == F.get(p, i - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(p, i + 1)["h"], F.lit(False))), lambda x: x["i"])))
        .withColumn(
            "q_n_repeat_words",
            F.aggregate(at, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")), lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")), lambda a: a["n"]),
        )
        .drop("q_words", "q_h", "q_p", "q_at", "q_lines")
    )


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS, max_target: int = MAX_TARGET, smoothing: float = SMOOTHING) -> DataFrame:
    """docs with the base statistics, q_base_failed, q_score and q_kept."""
    weights = fit(docs, trusted, buckets, max_target, smoothing)
    model = weights.agg(F.transform(F.sort_array(F.collect_list(F.struct("bucket", "weight"))), lambda x: x["weight"]).alias("model")).scalar()
    graded = measured(docs).withColumn("q_model", model)
    u, n = F.col("q_u"), F.size("q_u")
    both = F.aggregate(
        F.sequence(F.lit(0), n - 1),
        F.lit(0.0),
        lambda a, i: a + F.get("q_model", F.pmod(F.get(u, i), F.lit(buckets)).cast("int")) + F.coalesce(F.get("q_model", F.when(i < n - 1, _bigram(u, F.get(u, i), i, buckets))), F.lit(0.0)),
    )
    score = F.when(n > 0, both / (2 * n - 1)).otherwise(F.lit(0.0))
    return (
        graded.withColumn("q_score", score)
        .withColumn("q_base_failed", (F.col("q_n_words") < 50) | (100 * F.col("q_n_repeat_words") > 50 * F.col("q_n_words")))
        .withColumn("q_kept", ~F.col("q_base_failed") & (F.col("q_score") >= threshold))
        .drop("q_u", "q_model")
    )
