"""The registered queries of the operators over the whole tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.llm import (
    decontaminate,
    exact_dedup,
    jaccard_join,
    mixing,
    pii,
    quality,
    secrets,
    seed_extend,
    sharding,
    suffix_dedup,
    token_alignment,
    toxicity,
    whitening,
)
from stratus.llm.common import table

#: The white space of the contracts in a DuckDB pattern.
_WORD = r"[^\x20\x09-\x0D]+"


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents")).drop("email", "ip", "card", "phone", "added")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = quality_weights(docs, table(spark, sf_dir, "labels"))
    return mixing.mix_sources(docs, weights).select("doc_id", "size", "source_size", "target", "taken")


def quality_weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, weight``: 1 for documents labelled good, 1/4 for bad ones, 1/2 for the rest."""
    quality = labels.groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    return (docs.select("doc_id").distinct().join(quality, "doc_id", "left")
            .select("doc_id", F.coalesce(F.lit(0.25) + 0.75 * F.col("quality"), F.lit(0.5)).alias("weight")))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_extend.remove_repeats(table(spark, sf_dir, "documents"), length=13)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated_strings(table(spark, sf_dir, "documents"), length=400)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = exact_dedup.mark_exact_duplicates(table(spark, sf_dir, "documents"))
    return marks.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents")).drop("assign", "access", "hex", "random")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_alignment.align_documents(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.withColumn("groups_sha256", digest).drop("groups")


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), n_shards=40, keep=["doc_id"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_personal_data": op3_personal_data,
    "op4_mix_sources": op4_mix_sources,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_quality": op8_quality,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_whitening": op11_whitening,
    "op12_token_alignment": op12_token_alignment,
    "op13_sharding": op13_sharding,
}

ORACLE: dict[str, str] = {
    "op2_jaccard_join": rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
      FROM d, unnest(range(1, greatest(len(w) - 1, 2))) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 90 * (na.n + nb.n - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents
          UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT x AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(y) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = x GROUP BY x""",
    "op4_mix_sources": rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('s' || source, 'z') AS src,
         len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
         -ln(((('0x' || substr(md5('0:' || doc_id), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0)
           / coalesce(0.25 + 0.75 * quality, 0.5) AS k
  FROM documents LEFT JOIN (SELECT doc_id, avg(quality) AS quality FROM labels GROUP BY doc_id) USING (doc_id)),
s0 AS (SELECT src, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY src) - 1) % 3) + 1 AS w
       FROM d GROUP BY src),
fill AS (
  -- round by round: share what is left among the sources below their caps; stop those above
  SELECT 0 AS step, src, source_size, w, false AS full_, sum(source_size) OVER () AS rest,
         sum(w) OVER () AS weights FROM s0
  UNION ALL
  SELECT step + 1, src, source_size, w, now_full,
         sum(source_size) OVER () - sum(CASE WHEN now_full THEN 3 * source_size ELSE 0 END) OVER (),
         sum(CASE WHEN now_full THEN 0 ELSE w END) OVER ()
  FROM (SELECT *, full_ OR rest::DOUBLE / weights * w > 3 * source_size AS now_full FROM fill) x
  WHERE step < 100 AND weights > 0),
t AS (
  SELECT src, source_size, round(CASE WHEN full_ THEN 3.0 * source_size ELSE rest::DOUBLE / weights * w END, 6) AS target
  FROM fill QUALIFY step = max(step) OVER ()),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.src ORDER BY d.k, d.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS epochs
  FROM d JOIN t USING (src))
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, round(target - epochs * source_size)::BIGINT - before)))::BIGINT AS taken
FROM p""",
    "op5_substring_dedup": rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents),
w AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 12], ' ')) AS h
  FROM d, unnest(range(1, len(words) - 11)) AS u(i)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS first FROM w)
        WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS pos FROM dup, unnest(range(13)) AS v(k)),
lists AS (SELECT doc_id, list(pos) AS gone FROM gone GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN words
                              ELSE list_select(words, list_filter(range(1, len(words) + 1),
                                                                  lambda j: NOT list_contains(gone, j))) END, ' ')) AS kept_sha256
FROM d LEFT JOIN lists USING (doc_id)""",
    "op9_exact_dedup": r"""
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS kept,
       h AS text_sha256
FROM (SELECT doc_id, length(coalesce(text, '')) AS n,
             sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents)""",
}
