"""The query opN_<name> of each operator, over its whole table, and SQL where that can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spillway.llm import ann, chat, huffman, licences, line_dedup, mixing, near_dup, packing, quality, toxicity
from spillway.llm.common import table
from spillway.llm.tokens import tokenizer_path


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), trusted)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
    return judged.select("doc_id", *[F.col(f"q_{n}").alias(n) for n in names])


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digest(chat.format_segments(given.unionByName(extra)), in_order=True)


# Characters that escaping adds: one per backslash and one per control string.
_ADDED = " + ".join([r"(length(x) - length(replace(x, '\\', '')))", *(f"(length(x) - length(replace(x, '{c}', ''))) // {len(c)}" for c in chat.Format(chat.INSTRUCT).t.controls())])
OP3_SQL = f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns AS (
  SELECT *, row_number() OVER w AS pos, lag(role, 1, '') OVER w AS before, lead(role) OVER w IS NULL AS ends,
    length(x) + {_ADDED} + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
      ELSE 21 + length(role) + length(regexp_replace(role, '[^\\\\]', '', 'g')) END AS chars
  FROM given WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, x))
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || x || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(x)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(x, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, CAST(sum(chars) AS BIGINT) AS formatted_chars,
  bool_and(CASE before WHEN '' THEN role IN ('system', 'user') AND pos = 1 WHEN 'system' THEN role = 'user' WHEN 'user' THEN role = 'assistant' WHEN 'assistant' THEN role = 'user' ELSE false END)
    AND bool_and(NOT ends OR role IN ('user', 'assistant')) AS valid
FROM turns GROUP BY conv_id
"""


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(table(spark, sf_dir, "documents"))
    return planned.select(
        "doc_id",
        F.col("mx_size").alias("size"),
        F.col("mx_source_size").alias("source_size"),
        F.col("mx_target").alias("target"),
        (F.col("mx_size") * F.col("mx_copies")).alias("taken"),
    )


OP4_SQL = """
WITH sized AS (
  SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rn FROM per),
weighed AS (SELECT *, CASE (rn - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM ranked),
filled AS (
  SELECT *, row_number() OVER (ORDER BY source_size / w, rn) AS pos,
    CAST(sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER (ORDER BY source_size / w, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest,
    CAST(sum(w) OVER (ORDER BY source_size / w, rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS w_rest
  FROM weighed),
first_fit AS (SELECT arg_min(rest, pos) AS rest0, arg_min(w_rest, pos) AS w0, min(pos) AS pos0 FROM filled WHERE rest * w <= source_size * 3 * w_rest),
targets AS (
  SELECT source, source_size, CASE WHEN pos0 IS NULL OR pos < pos0 THEN CAST(source_size * 3 AS DOUBLE) ELSE CAST(rest0 AS DOUBLE) * w / w0 END AS target
  FROM filled, first_fit),
rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    CAST(('0x' || substr(md5(coalesce(CAST(s.doc_id AS VARCHAR), 'null|' || md5(coalesce(s.text, ''))) || '|mix-1'), 1, 12)) AS BIGINT) / 281474976710656.0 AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""


def op5_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", F.col("ld_lines").alias("n_lines"), F.col("ld_dropped").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP6_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
frequent AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT keyed.*, frequent.k IS NOT NULL AS gone FROM keyed LEFT JOIN frequent ON keyed.k = frequent.k)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
items AS (SELECT doc_id, unnest(s) AS v FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM items a JOIN items b ON a.v = b.v AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * n >= 75 * (len(x.s) + len(y.s) - n)),
sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS start, doc_id AS here FROM sets UNION SELECT start, b FROM reach JOIN sym ON here = a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, low AS component_id, low = doc_id AS kept
FROM sets JOIN (SELECT start, min(here) AS low FROM reach GROUP BY 1) ON start = doc_id
"""


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    training = toxicity.training_rows(table(spark, sf_dir, "labels")).select("doc_id", "toxic")
    scored = toxicity.score(table(spark, sf_dir, "documents"), training)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"), "evidence")


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that begin with a notice lie at source/lang/doc_id and speak for that directory; others at source/lang/hundreds/doc_id."""
    docs = table(spark, sf_dir, "documents")
    voice = F.coalesce(F.substring_index(F.col("text"), "\n", 1).rlike("(?i)licen[cs]e"), F.lit(False))
    top = [F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit(""))]
    own = F.col("doc_id").cast("string")
    path = F.when(voice, F.concat_ws("/", *top, own)).otherwise(F.concat_ws("/", *top, F.floor(F.col("doc_id") / 100).cast("string"), own))
    found = licences.scan(docs.select("text", voice.alias("voice"), F.when(F.col("doc_id").isNotNull(), path).alias("path")), is_licence=F.col("voice"))
    return found.select(F.element_at(F.split("path", "/", -1), -1).cast("long").alias("doc_id"), "path", "licence", "score", "origin", "origin_path")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = huffman.encode_corpus(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return back.select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {"op1_quality_rules": op1_quality_rules, "op2_best_fit_packing": op2_best_fit_packing, "op3_chat_format": op3_chat_format, "op4_mix_sources": op4_mix_sources, "op5_nearest_vectors": op5_nearest_vectors, "op6_line_dedup": op6_line_dedup, "op7_near_dup": op7_near_dup, "op8_toxicity": op8_toxicity, "op9_licence_scan": op9_licence_scan, "op10_token_files": op10_token_files}
ORACLES = {"op3_chat_format": OP3_SQL, "op4_mix_sources": OP4_SQL, "op6_line_dedup": OP6_SQL, "op7_near_dup": OP7_SQL}
