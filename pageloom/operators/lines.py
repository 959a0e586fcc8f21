"""Line operators: boilerplate profile and removal, list splitting, first lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.functions import text as t
from pageloom.operators.pieces import kept

#: How often a key must occur in a document for its lines to be boilerplate.
REPEATS = 4


def keyed(lines: DataFrame, repaired: bool = False) -> DataFrame:
    """Normalized lines with their repeat key and whether they are page lines."""
    clean = F.col("line") if repaired else t.repair_characters(F.col("line"))
    return lines.withColumn("line", t.normalize_line(clean)).withColumn("is_page", t.is_page_line(F.col("line"))).withColumn(
        "key", F.when(~F.col("is_page"), t.repeat_key(F.col("line")))
    )


def repeat_profile(lines: DataFrame) -> DataFrame:
    """(doc_id, key, n): how often each key occurs; page lines count under __page__."""
    key = F.when(F.col("is_page"), F.lit("__page__")).otherwise(F.col("key"))
    return keyed(lines).select("doc_id", key.alias("key")).where("key is not null").groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n"))


def first_lines(lines: DataFrame) -> DataFrame:
    return lines.where(~t.is_blank(F.col("line"))).groupBy("doc_id").agg(F.min("pos").alias("first_pos"))


def mark_boilerplate(lines: DataFrame, repeats: int = REPEATS, repaired: bool = False) -> DataFrame:
    """Lines with ``removed``: page lines, and lines whose key repeats, but for a first line and chapter headings.

    Keys are counted without lines, and lines meet the few keys that repeat: those of one document, and those
    without a key, are dealt over all tasks.
    """
    place = F.struct(*[c for c in ("piece", "pos") if c in lines.columns])
    marked = kept(keyed(lines, repaired))
    counts = marked.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(~t.is_blank(F.col("line")), place)).alias("_first"))
    often = F.when(F.col("key").isNotNull() & (F.col("n") >= repeats), F.struct("key", "n"))
    repeated = counts.groupBy("doc_id").agg(F.min("_first").alias("_first"), F.collect_list(often).alias("_k")).select("doc_id", "_first", F.explode("_k").alias("_k"))
    # A key has no line feed.
    dealt = marked.withColumn("_key", F.coalesce("key", F.concat(F.lit("\n"), F.xxhash64(place).cast("string"))))
    met = dealt.join(repeated.select("doc_id", F.col("_k.key").alias("_key"), F.col("_k.n").alias("n"), "_first"), ["doc_id", "_key"], "left")
    heading = F.ltrim(F.col("line")).startswith("#") & t.starts_with_any(F.lower(t.without_markers(F.col("line"))), ("chapter ", "book ", "part "))
    removed = F.when(t.is_blank(F.col("line")), False).otherwise(F.col("is_page") | (F.col("n").isNotNull() & (place != F.col("_first")) & ~heading))
    return met.withColumn("removed", removed).drop("_key", "_first")


def without_boilerplate(lines: DataFrame, repeats: int = REPEATS) -> DataFrame:
    return mark_boilerplate(lines, repeats).where(~F.col("removed")).select("doc_id", "pos", "line")


def list_items(line: Column) -> Column:
    """A line with several list marks as one line per item; other lines alone."""
    indent = F.regexp_extract(line, r"(?U)^(\s*)", 1)
    body = F.regexp_replace(line, r"(?U)^\s+", "")
    bullet = body.rlike(r"^[•*+-] ")
    bullets = F.transform(F.filter(F.transform(F.split(F.substr(body, F.lit(3)), " • "), t.strip), lambda p: p != ""), lambda p: F.concat(indent, F.lit("• "), p))
    mark = r"(?U)(?<!\S)(?=(?:\d{1,3}[.)]|[A-Za-z][.)])\s)"
    numbered = body.rlike(r"(?U)^(?:\d{1,3}[.)]|[A-Za-z][.)])\s")
    numbers = F.transform(F.filter(F.split(body, mark), lambda p: p != ""), lambda p: F.concat(indent, t.strip(p)))
    return (
        F.when(bullet & F.substr(body, F.lit(3)).contains(" • "), bullets).when(bullet, F.array(line)).when(numbered & (F.size(numbers) > 1), numbers).otherwise(F.array(line))
    )


def split_lists(lines: DataFrame) -> DataFrame:
    """Lines with compound list lines split; the order is (pos, part)."""
    return lines.select("doc_id", *[c for c in ("piece",) if c in lines.columns], "pos", F.posexplode(list_items(F.col("line"))).alias("part", "line"))


def ordered_dedup(rows: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """First rows of each trimmed value, compared by folded case, within ``by``."""
    cleaned = rows.withColumn(value, t.strip(F.col(value))).where(F.col(value) != "")
    first = Window.partitionBy(*by, t.casefold(F.col(value))).orderBy(*order)
    return cleaned.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
