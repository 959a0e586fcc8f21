"""Section operators: headings, contents tables, chapter anchors, heading paths, bodies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.functions import text as t
from pageloom.operators.pieces import in_pieces
from pageloom.session import settled

#: Unlike block headings, section headings need a blank after the marks.
SECTION_HEADING = r"(?U)^(#{1,6})\s+(.*\S)\s*$"
_BREAKS = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x85  ]"


def _lines(docs: DataFrame) -> Column:
    """A text's lines, split at every line boundary of Unicode.  A piece may have others behind it: it ends within a break."""
    end = r"\r\z" if "piece" in docs.columns else rf"(?:{_BREAKS})\z"
    return F.split(F.regexp_replace("text", end, ""), _BREAKS, -1)


def _marked(docs: DataFrame, head: Callable[[Column, Column], Column]) -> DataFrame:
    """(doc_id, piece, n_lines, heads): ``head`` of a piece's lines with a mark and their place, where it has a level."""
    found = F.filter(F.transform("lines", lambda x, i: F.when(x.contains("#"), head(x, i))), lambda h: h.isNotNull() & (h["level"] > 0))
    split = in_pieces(docs).select("doc_id", "piece", _lines(docs).alias("lines"))
    blank = (F.size("heads") == 0) & (t.strip(F.array_join("lines", "\n")) == "")
    return split.withColumn("heads", found).select("doc_id", "piece", F.size("lines").alias("n_lines"), "heads", blank.alias("blank"))


def _head(x: Column, i: Column) -> Column:
    line = t.strip(x)
    return F.struct(i.alias("at"), F.length(F.regexp_extract(line, SECTION_HEADING, 1)).alias("level"), F.regexp_extract(line, SECTION_HEADING, 2).alias("title"))


def outlined(docs: DataFrame) -> DataFrame:
    """(doc_id, piece, n_lines, heads, blank): a piece's headings (at, level, title), without its lines."""
    return _marked(docs, _head)


def headings(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, level, title) of a document's headings."""
    before = Window.partitionBy("doc_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    placed = outlined(docs).withColumn("_before", F.coalesce(F.sum("n_lines").over(before), F.lit(0))).select("doc_id", "_before", F.explode("heads").alias("h"))
    return placed.select("doc_id", (F.col("_before") + F.col("h.at")).cast("int").alias("pos"), "h.level", "h.title")


def book_titles(docs: DataFrame, default: Column | None = None, outline: DataFrame | None = None) -> DataFrame:
    """(doc_id, book_title): the first heading of level 1, else the document's name made readable."""
    name = F.regexp_extract(F.col("doc_id").cast("string"), r"([^/]*?)(?:\.[^./]*)?$", 1) if default is None else default
    first = F.get(F.filter("heads", lambda h: h["level"] == 1), F.lit(0))["title"]
    rows = (outlined(docs) if outline is None else outline).withColumn("_t", first)
    found = rows.groupBy("doc_id").agg(F.min_by("_t", F.when(F.col("_t").isNotNull(), F.col("piece"))).alias("_t"))
    return found.select("doc_id", F.coalesce("_t", F.trim(F.translate(name, "_-", "  "))).alias("book_title"))


def _entry(line: Column) -> Column:
    return t.strip(F.regexp_extract(t.strip(line), r"(?U)^\s*(?:[-*+]\s+)?(?:\d+[.):]?\s+)?(.+?)\s*$", 1))


def contents_titles(docs: DataFrame, outline: DataFrame | None = None) -> DataFrame:
    """(doc_id, title_key): entries between the first Contents heading and the next heading of another title."""
    rows = outlined(docs) if outline is None else outline
    heads = rows.select("doc_id", "piece", F.explode("heads").alias("h")).select("doc_id", F.struct("piece", "h.at").alias("_place"), (t.casefold(F.col("h.title")) == "contents").alias("_is"))
    begin = heads.where("_is").groupBy("doc_id").agg(F.min("_place").alias("_begin"))
    end = heads.where(~F.col("_is")).join(begin, "doc_id").where(F.col("_place") > F.col("_begin")).groupBy("doc_id").agg(F.min("_place").alias("_end"))
    # One row for each document with a contents table; only the pieces that it lies in are split.
    bounds = F.broadcast(begin.join(end, "doc_id", "left"))
    inside = in_pieces(docs).join(bounds, "doc_id").where((F.col("piece") >= F.col("_begin.piece")) & (F.col("_end").isNull() | (F.col("piece") <= F.col("_end.piece"))))
    lines = inside.select("doc_id", "piece", "_begin", "_end", F.posexplode(_lines(docs)).alias("at", "line")).withColumn("_place", F.struct("piece", "at"))
    within = lines.where((F.col("_place") > F.col("_begin")) & (F.col("_end").isNull() | (F.col("_place") < F.col("_end"))))
    entries = within.where(F.length(F.regexp_extract(t.strip(F.col("line")), SECTION_HEADING, 1)) == 0).select("doc_id", _entry(F.col("line")).alias("_e"))
    return entries.where("_e <> ''").select("doc_id", t.title_key(F.col("_e")).alias("title_key")).distinct()


def _placed(heads: DataFrame, listed: DataFrame) -> DataFrame:
    """Headings alone, numbered, with their chapter and path: the windows over a document see no text."""
    key = t.title_key(F.col("title"))
    chapter = F.col("title").rlike(r"(?iU)^(chapter|book|part|section|appendix|prologue|epilogue)\b")
    matter = (F.col("level") <= 2) & t.is_matter_title(F.col("title"))
    order = Window.partitionBy("doc_id").orderBy("_piece", "_at")
    named = heads.withColumn("_key", key).join(listed.select("doc_id", F.col("title_key").alias("_key"), F.lit(True).alias("_listed")), ["doc_id", "_key"], "left")
    rows = named.withColumn("_no", F.row_number().over(order)).withColumn("_anchor", F.coalesce("_listed", F.lit(False)) | chapter | matter | (F.col("_no") == 1))
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = lambda holds, x: F.last(F.when(holds, F.col(x)), True).over(before)
    at = {k: (last(F.col("level") == k, "_no").alias(f"_at{k}"), last(F.col("level") == k, "title").alias(f"_t{k}")) for k in range(1, 7)}
    placed = rows.select("doc_id", "_piece", "_at", "_no", "level", "title", *[c for pair in at.values() for c in pair], last(F.col("_anchor"), "title").alias("chapter_title"))
    shallower = [F.greatest(F.lit(-1), *[F.coalesce(F.col(f"_at{j}"), F.lit(-1)) for j in range(1, k)]) if k > 1 else F.lit(-1) for k in range(1, 7)]
    steps = F.array(*[F.when((F.col("level") >= k) & (F.col(f"_at{k}") > shallower[k - 1]), F.col(f"_t{k}")) for k in range(1, 7)])
    return placed.select("doc_id", "_piece", "_at", "_no", "level", "title", "chapter_title", F.filter(steps, lambda x: x.isNotNull()).alias("path"))


def _bodies(docs: DataFrame, outline: DataFrame) -> DataFrame:
    """(doc_id, _piece, _at, _body): the lines under each heading, known by its place; under none (-1) those before the first.

    A piece's lines before its own first heading go on with the last one before it.
    """
    here = F.element_at("heads", -1)
    owner = F.last(F.when(F.size("heads") > 0, F.struct(F.col("piece"), here["at"].alias("at"))), True).over(Window.partitionBy("doc_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    split = in_pieces(docs).withColumn("lines", _lines(docs)).drop("text").join(outline.select("doc_id", "piece", "heads", owner.alias("_owner")), ["doc_id", "piece"])
    body = lambda first, last: F.array_join(F.slice("lines", first, F.greatest(last, F.lit(0))), "\n")
    following = lambda k: F.coalesce(F.get(F.col("heads"), k)["at"], F.size("lines"))
    whole = lambda piece, at, text: F.struct(F.coalesce(piece, F.lit(-1)).alias("_piece"), F.coalesce(at, F.lit(-1)).alias("_at"), text.alias("_text"))
    parts = F.transform("heads", lambda h, k: whole(F.col("piece"), h["at"], body(h["at"] + 2, following(k + 1) - h["at"] - 1)))
    front = F.filter(F.array(whole(F.col("_owner.piece"), F.col("_owner.at"), body(F.lit(1), following(F.lit(0))))), lambda s: following(F.lit(0)) > 0)
    rows = split.select("doc_id", "piece", F.explode(F.concat(front, parts)).alias("_s")).select("doc_id", "piece", "_s.*")
    gathered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "_text"))), lambda s: s["_text"]), "\n")
    return rows.groupBy("doc_id", "_piece", "_at").agg(t.strip(gathered).alias("_body"))


def sections(docs: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """One row per section: doc_id, section_id, level, title, path, chapter_title, raw_text, token_estimate, pos.

    Texts are split and gathered by section, in as many tasks as there are; windows over a document are over its headings.
    """
    outline = settled(outlined(docs))
    heads = outline.select("doc_id", F.col("piece").alias("_piece"), F.explode("heads").alias("h")).select("doc_id", "_piece", F.col("h.at").alias("_at"), "h.level", "h.title")
    rows = _bodies(docs, outline).join(_placed(heads, contents_titles(docs, outline)), ["doc_id", "_piece", "_at"], "left").where(F.col("_no").isNotNull() | (F.col("_body") != ""))
    first, no = F.lit("Front Matter"), F.coalesce("_no", F.lit(0))
    raw = F.when(no == 0, F.col("_body")).otherwise(t.strip(F.concat(F.repeat(F.lit("#"), F.col("level")), F.lit(" "), F.col("title"), F.lit("\n\n"), F.col("_body"))))
    found = rows.select(
        "doc_id", F.format_string("s%04d", no).alias("section_id"), F.coalesce("level", F.lit(1)).alias("level"), F.coalesce("title", first).alias("title"),
        F.coalesce("path", F.array(first)).alias("path"), F.coalesce("chapter_title", first).alias("chapter_title"), raw.alias("raw_text"), no.cast("long").alias("pos"),
    )
    named = book_titles(docs, outline=outline) if titles is None else titles
    blank = outline.groupBy("doc_id").agg(F.bool_and("blank").alias("_blank")).where("_blank")
    empty = blank.select("doc_id").join(named, "doc_id").select(
        "doc_id", F.lit("s0001").alias("section_id"), F.lit(1).alias("level"), F.col("book_title").alias("title"), F.array("book_title").alias("path"),
        F.col("book_title").alias("chapter_title"), F.lit("").alias("raw_text"), F.lit(1).cast("long").alias("pos"),
    )
    return found.unionByName(empty).withColumn("token_estimate", t.token_estimate(F.col("raw_text")))


def heading_skips(docs: DataFrame) -> DataFrame:
    """(doc_id, heading_skips): how often a heading is more than one level below the one before."""
    marks = lambda x, i: F.struct(i.alias("at"), F.length(F.regexp_extract(x, r"^(#{1,6})", 1)).alias("level"))
    rows = _marked(docs, marks).select("doc_id", "piece", F.explode_outer("heads").alias("h")).select("doc_id", "piece", "h.*")
    jump = F.col("level") > F.lag("level", 1).over(Window.partitionBy("doc_id").orderBy(F.col("level").isNull(), "piece", "at")) + 1
    return rows.withColumn("_j", jump).groupBy("doc_id").agg(F.count_if("_j").alias("heading_skips"))
