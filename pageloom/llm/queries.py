"""The registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm.common import documents


def op1_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pageloom.llm.search import top_k

    return top_k(documents(spark, sf_dir), F.col("doc_id") % 50 == 0, k=10)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pageloom.llm.quality import score, train

    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    model = train(docs, labels, "quality", learn_from=~held_out)
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pageloom.llm.lm import score_texts

    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return score_texts(documents(spark, sf_dir), learn_from=~held_out).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pageloom.llm.suffix_dedup import remove_repeats

    def total(runs: str):
        return F.aggregate(runs, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])

    return remove_repeats(documents(spark, sf_dir), 400, passage=50).select(
        "doc_id", "n_bytes", total("spans").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        total("passages").alias("n_passage_words"),
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pageloom.llm.sharding import shard

    return shard(documents(spark, sf_dir), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pageloom.llm.fingerprints import fingerprint_with_edits

    return fingerprint_with_edits(documents(spark, sf_dir))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pageloom.llm.secrets import BASE_KINDS, scan

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    found = scan(documents(spark, sf_dir))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *map(count, BASE_KINDS), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from pageloom.llm.packing import pack

    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pageloom.llm.jaccard import jaccard_components

    return jaccard_components(documents(spark, sf_dir), width=3, percent=90)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pageloom.llm.mixing import mix_sources

    return mix_sources(documents(spark, sf_dir), weights=(5, 2, 1), max_epochs=3, share=1.0).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source, md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS no FROM s),
w AS (
  SELECT *, CASE (no - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight, source_size * 3 AS cap FROM r),
l AS (
  SELECT *, cap / weight AS ratio,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM w),
f AS (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, no LIMIT 1),
t AS (
  SELECT l.source, l.source_size,
         CASE WHEN (SELECT level FROM f) IS NULL OR (SELECT level FROM f) * weight > cap THEN cap::DOUBLE ELSE (SELECT level FROM f) * weight END AS target
  FROM l),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(round(target) / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
c AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole,
         CAST(round(p.target) AS BIGINT) - p.whole * p.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS start
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(size, rest - start)) AS BIGINT) AS taken
FROM c
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_search": op1_search,
    "op2_quality": op2_quality,
    "op3_lm": op3_lm,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_sharding": op5_sharding,
    "op6_fingerprints": op6_fingerprints,
    "op7_secrets": op7_secrets,
    "op8_packing": op8_packing,
    "op9_jaccard": op9_jaccard,
    "op10_mixing": op10_mixing,
}

ORACLE_SQL: dict[str, str] = {"op10_mixing": OP10_SQL}
