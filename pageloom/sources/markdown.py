"""Sources and sinks: text files, word lists, JSON payloads, and a content-addressed store."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import fixed


def read_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Whole text files as (doc_id, text); bytes that are not UTF-8 become U+FFFD."""
    return spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("text"))


def read_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, pos, line), split at line feeds only; a final line feed opens no line.

    Of documents in pieces (``operators.pieces``), the lines of each piece: (doc_id, piece, pos, line).
    """
    if "piece" in docs.columns:
        return docs.select("doc_id", "piece", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    body = F.regexp_replace("text", r"\n\z", "")
    parts = F.when(F.length("text") == 0, F.array().cast("array<string>")).otherwise(F.split(body, "\n", -1))
    return docs.select("doc_id", F.posexplode(parts).alias("pos", "line"))


def read_lexicon(spark: SparkSession, paths: str | list[str] | None = None) -> DataFrame:
    """Known words, lower case, distinct: the fixed ones and those of word files, one a line."""
    own = spark.createDataFrame([(w,) for w in fixed.LEXICON], "word string")
    if not paths:
        return own
    return spark.read.text(paths).select(F.lower(F.trim("value")).alias("word")).where("word <> ''").unionByName(own).distinct()


def read_stage_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """JSON payloads of a stage, in order of name and without templates: (stem, payload)."""
    rows = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True)
    name = F.col("_metadata.file_name")
    return (
        rows.where(~name.endswith(".template.json"))
        .select(F.regexp_replace(name, r"\.json$", "").alias("stem"), F.col("value").alias("payload"))
        .orderBy("stem")
    )


def template_path(path: Column) -> Column:
    return F.regexp_replace(path, r"\.[^./]*$", ".template.json")


def is_stage_output(name: Column) -> Column:
    return name.endswith(".json") & ~name.endswith(".template.json")


def write_documents(df: DataFrame, path: str) -> None:
    """Texts to a new place; the committer makes it whole or not at all, and inputs are never overwritten."""
    df.write.mode("errorifexists").parquet(path)


def write_json_lines(df: DataFrame, path: str, order: str) -> None:
    df.orderBy(order).write.mode("errorifexists").json(path)


def cache_key(stage: Column, payload: Column) -> Column:
    """SHA-256 of a stage's payload: the name under which its result is kept."""
    return F.sha2(F.concat(stage, F.lit("\n"), payload), 256)


def read_contract(spark: SparkSession, path: str) -> str:
    """The instructions that stand before every prompt: one text file, trimmed."""
    return (spark.read.text(path, wholetext=True).first() or [""])[0].strip()


def write_texts(rows: DataFrame, path: str, name: str = "name", text: str = "text") -> None:
    """One folder per name, each with its text: for readers outside of Spark."""
    rows.select(F.col(text).alias("value"), F.col(name).alias("name")).write.mode("errorifexists").partitionBy("name").text(path)


class CacheTable:
    """A content-addressed store: rows (key, payload) in a folder, appended and looked up by join."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path

    def _rows(self) -> DataFrame:
        try:
            rows = self._spark.read.schema("key string, payload string").parquet(self._path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self._spark.createDataFrame([], "key string, payload string")
        return rows.dropDuplicates(["key"])

    def load(self, requests: DataFrame) -> DataFrame:
        """Requests with their payload, null where there is none."""
        return requests.join(self._rows(), "key", "left")

    def missing(self, requests: DataFrame) -> DataFrame:
        return requests.join(self._rows(), "key", "left_anti")

    def save(self, rows: DataFrame) -> None:
        rows.select("key", "payload").write.mode("append").parquet(self._path)
