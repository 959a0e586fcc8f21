"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as the
next stage's docs.  All but the last return the columns of ``docs``:

* quality: documents that the classifier scores under 0.5 go;
* near_duplicates: of documents linked by five-word shingles at a similarity of 0.8, the least doc_id stays
  (rows under one doc_id are one document: the row with the least text stays);
* secrets: found secrets are replaced in the text;
* mixing: documents repeat, or go, as their source's share asks; the one document at the edge of a source's
  share stays with as many of its first words as are missing;
* packing: token pieces in sequences of 4096, one row per piece.

Null texts are empty, rows without a doc_id are never near-duplicates, repeated rows are near-duplicates of
each other, extra columns travel along, and an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm.common import WORD, bounded_batches, checkpoint_dir, cut_lineage, documents
from pageloom.llm.jaccard import jaccard_components
from pageloom.llm.mixing import mix_sources
from pageloom.llm.packing import pack
from pageloom.llm.quality import keep_good, train
from pageloom.llm.secrets import redact

#: Ids up to this many are sent to every task; beyond, the join shuffles.
BROADCAST_IDS = 1_000_000


def _with_length(docs: DataFrame) -> DataFrame:
    """n_chars as the text now has it, where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return keep_good(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    kept = cut_lineage(jaccard_components(docs, width=5, percent=80).where("component_id = doc_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_rows")))
    rows, several = kept.agg(F.count(F.lit(1)), F.max("_rows")).first()
    if rows <= BROADCAST_IDS:
        kept = F.broadcast(kept)
    named = docs.join(kept, "doc_id", "left_semi")
    if (several or 0) > 1:
        # Rows under one id are one document; the least of them stays, whichever task comes first.
        least = F.min(F.struct(*[F.col(f"`{c}`") for c in sorted(docs.columns, key=lambda c: c != "text")])).alias("_row")
        alone = docs.join(kept.where("_rows = 1"), "doc_id", "left_semi")
        named = alone.unionByName(docs.join(kept.where("_rows > 1"), "doc_id", "left_semi").groupBy("doc_id").agg(least).select(*[F.col(f"_row.`{c}`") for c in docs.columns]))
    return named.unionByName(docs.where("doc_id is null"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return _with_length(redact(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mix_sources(docs, weights=(5, 2, 1), max_epochs=3, share=1.0, carry=True).where("taken > 0")
    whole = F.floor(F.col("taken") / F.col("size")).cast("int")
    words = F.regexp_extract_all("row.text", F.lit(WORD), F.lit(0))
    part = F.array_join(F.slice(words, F.lit(1), (F.col("taken") % F.col("size")).cast("int")), " ")
    copies = F.concat(F.array_repeat(F.lit(False), whole), F.when(F.col("taken") % F.col("size") > 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")))
    repeated = mixed.select("row", "size", "taken", F.explode(copies).alias("_cut"))
    columns = [F.when(F.col("_cut"), part).otherwise(F.col("row.text")).alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return _with_length(repeated.select(*columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    bounded_batches(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("packing", packing),
]

#: The classifier and the tokenizer have no SQL form; every stage and run() are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is written to the shared checkpoint folder."""
    docs, folder = documents(spark, sf_dir), f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
