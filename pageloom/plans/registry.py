"""Registered queries of the corpus-processing operators and their oracle SQL."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import fixed, schemas, spelling, text as t
from pageloom.operators import audit, blocks, bookmap, lines, packets, payloads, sections, work
from pageloom.plans import normalize as norm, summarize
from pageloom.plans.fixtures import markdown, markdown_sql
from pageloom.session import bounded_batches, settled
from pageloom.sources import markdown as src

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLE_SQL[f.__name__] = oracle
        return f

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _any(column: str, parts) -> str:
    return "(" + " OR ".join(f"contains({column}, '{p}')" for p in parts) + ")"


def _list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# ---------------------------------------------------------------- shared oracle fragments

_TOK = "CASE WHEN length({0}) = 0 THEN 0 ELSE greatest(1, length({0}) // 4) END"
_STRIP = r"regexp_replace(regexp_replace({0}, '^\s+', ''), '\s+$', '')"


def _lines_sql(noise: bool) -> str:
    return f"""
b AS ({markdown_sql(noise)}),
ls AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM b)"""


#: Spaced hash marks do not occur in these texts; a blank is put after the longest mark that leaves one over.
_NORM = r"regexp_replace(regexp_replace({0}, '^(#{{1,6}})([^\s])', '\1 \2'), '\s+$', '')"
_BARE = _STRIP.format(r"regexp_replace(regexp_replace({0}, '^\s*#{{1,6}}\s*', ''), '^\s*(?:[-+*•]|[0-9]{{1,3}}[.)]|[A-Za-z][.)])\s*', '')")
_KEYED = f"""
nl AS (SELECT doc_id, pos, {_NORM.format('line')} AS line FROM ls),
kl AS (
  SELECT doc_id, pos, line, regexp_matches(line, '(?i)^\\s*page\\s+([0-9]+|[ivxlcdm]+)\\s*$') AS is_page, {_BARE.format('line')} AS bare FROM nl),
ky AS (
  SELECT *, CASE WHEN NOT is_page AND bare <> '' AND length(bare) <= 80 AND NOT regexp_matches(bare, '[.!?]$')
              AND len(list_filter(string_split_regex(bare, '\\s+'), lambda w: w <> '')) <= 10
            THEN regexp_replace(regexp_replace(regexp_replace(lower(bare), '\\b[0-9]+\\b', '<n>', 'g'), '\\b[ivxlcdm]+\\b', '<r>', 'g'), '\\s+', ' ', 'g') END AS key
  FROM kl)"""
_HEADS = r"""
hd AS (
  SELECT doc_id, pos, line, length(regexp_extract(trim(line), '^(#{1,6})\s+(.*\S)\s*$', 1)) AS level,
         regexp_extract(trim(line), '^(#{1,6})\s+(.*\S)\s*$', 2) AS title FROM ls)"""
_TITLE_KEY = r"lower(regexp_replace(regexp_replace(regexp_replace(trim({0}), '(?i)^(chapter|book|part|section)\s+[0-9]+[.:]?\s*', ''), '^[0-9]+[.):]?\s*', ''), '\s+', ' ', 'g'))"

_SECTIONS = f"""
{_lines_sql(False)},
{_HEADS},
nn AS (SELECT *, sum(CASE WHEN level > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS no FROM hd),
tt AS (SELECT *, {_TITLE_KEY.format('title')} AS tkey FROM nn WHERE level > 0),
aa AS (
  SELECT *, regexp_matches(title, '(?i)^(chapter|book|part|section|appendix|prologue|epilogue)\\b') OR (level <= 2 AND tkey IN ({_list(fixed.MATTER_TITLES)})) AS anchor FROM tt),
hh AS (
  SELECT doc_id, no, level, title,
         last_value(CASE WHEN anchor OR no = 1 THEN title END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS chapter_title,
         last_value(CASE WHEN level = 1 THEN title END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS t1,
         last_value(CASE WHEN level = 2 THEN title END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS t2,
         coalesce(last_value(CASE WHEN level = 1 THEN pos END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING), -1) AS p1,
         coalesce(last_value(CASE WHEN level = 2 THEN pos END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING), -1) AS p2
  FROM aa),
bd AS (SELECT doc_id, no, string_agg(CASE WHEN level = 0 THEN line END, chr(10) ORDER BY pos) AS body FROM nn GROUP BY doc_id, no),
sx AS (
  SELECT hh.doc_id, hh.no AS pos, printf('s%04d', CAST(hh.no AS INTEGER)) AS section_id, hh.level, hh.title, hh.chapter_title,
         CASE WHEN hh.level = 1 THEN hh.title ELSE t1 || CASE WHEN hh.level = 2 THEN ' > ' || hh.title WHEN p2 > p1 THEN ' > ' || t2 || ' > ' || hh.title ELSE ' > ' || hh.title END END AS path,
         {_STRIP.format("repeat('#', CAST(hh.level AS INTEGER)) || ' ' || hh.title || chr(10) || chr(10) || " + _STRIP.format("coalesce(body, '')"))} AS raw_text
  FROM hh JOIN bd ON hh.doc_id = bd.doc_id AND hh.no = bd.no),
se AS (SELECT *, {_TOK.format('raw_text')} AS token_estimate FROM sx)"""


def _kind_sql(title: str, raw: str) -> str:
    key = _TITLE_KEY.format(title)
    near = f"({key} || chr(10) || lower(substr({raw}, 1, {fixed.KIND_WINDOW})))"
    hits = " + ".join(f"CAST(contains({near}, '{w}') AS INTEGER)" for w in fixed.PRINCIPLE_WORDS)
    years = f"len(regexp_extract_all({raw}, '\\b(?:18|19|20)[0-9][0-9]\\b'))"
    return f"""CASE WHEN {_any(key, fixed.REFERENCE_TITLES)} THEN 'reference' WHEN {_any(key, fixed.ENDMATTER_TITLES)} OR starts_with({key}, 'timeline') THEN 'endmatter'
      WHEN {_any(near, fixed.REFERENCE_WORDS)} THEN 'reference' WHEN {_any(near, fixed.ENDMATTER_WORDS)} THEN 'endmatter' WHEN {_any(near, fixed.FRAMING_WORDS)} THEN 'framing'
      WHEN {hits} >= 2 AND {years} <= 3 THEN 'core_argument' WHEN {years} >= 4 THEN 'case_study' ELSE 'mixed' END"""


_PRIORITY_SQL = "CASE {0} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in fixed.PRIORITY.items()) + " ELSE 3 END"

#: Runs of small sections by target; sections above ``most`` alone, by paragraphs.
_PACKETS = f"""
{_SECTIONS},
sk AS (SELECT *, token_estimate > {{most}} AS big, {_kind_sql('path', 'raw_text')} AS kind, {_any(_TITLE_KEY.format('path'), fixed.SUPPLEMENTAL_TITLES)} AS supp FROM se),
br AS (
  SELECT *, kind IN ('reference', 'endmatter') AS doc, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM sk),
bs AS (
  SELECT *, CASE WHEN i = 1 OR big OR lag(big) OVER w OR chapter_title <> lag(chapter_title) OVER w OR doc <> lag(doc) OVER w OR supp <> lag(supp) OVER w THEN 1 ELSE 0 END AS brk
  FROM br WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
fold(doc_id, i, packet, cum) AS (
  SELECT doc_id, i, CAST(1 AS BIGINT), CAST(token_estimate AS BIGINT) FROM bs WHERE i = 1
  UNION ALL
  SELECT n.doc_id, n.i, f.packet + CASE WHEN n.brk = 1 OR f.cum + n.token_estimate > {{target}} THEN 1 ELSE 0 END,
         CASE WHEN n.brk = 1 OR f.cum + n.token_estimate > {{target}} THEN n.token_estimate ELSE f.cum + n.token_estimate END
  FROM fold f JOIN bs n ON n.doc_id = f.doc_id AND n.i = f.i + 1),
pp AS (SELECT doc_id, pos, list_filter(list_transform(string_split_regex(raw_text, '\\n\\n+'), lambda p: {_STRIP.format('p')}), lambda p: p <> '') AS ps FROM se WHERE token_estimate > {{most}}),
pr AS (SELECT doc_id, pos, unnest(ps) AS paragraph, unnest(range(len(ps))) AS n FROM pp),
pt AS (SELECT *, {_TOK.format('paragraph')} AS tok FROM pr),
cuts(doc_id, pos, n, part, cum) AS (
  SELECT doc_id, pos, n, CAST(0 AS BIGINT), CAST(tok AS BIGINT) FROM pt WHERE n = 0
  UNION ALL
  SELECT x.doc_id, x.pos, x.n, f.part + CASE WHEN f.cum >= {{most}} OR f.cum + x.tok > {{target}} THEN 1 ELSE 0 END,
         CASE WHEN f.cum >= {{most}} OR f.cum + x.tok > {{target}} THEN x.tok ELSE f.cum + x.tok END
  FROM cuts f JOIN pt x ON x.doc_id = f.doc_id AND x.pos = f.pos AND x.n = f.n + 1),
ev AS (
  SELECT s.doc_id, min(s.pos) AS first, 0 AS part, min(s.chapter_title) AS chapter_title, list(s.path ORDER BY s.pos) AS labels,
         string_agg(s.raw_text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY s.pos) AS raw_text
  FROM fold f JOIN bs s ON s.doc_id = f.doc_id AND s.i = f.i WHERE NOT s.big GROUP BY s.doc_id, f.packet
  UNION ALL
  SELECT c.doc_id, c.pos, c.part, min(s.chapter_title), [min(s.path) || ' (part ' || (c.part + 1) || ')'], string_agg(p.paragraph, chr(10) || chr(10) ORDER BY p.n)
  FROM cuts c JOIN pt p ON p.doc_id = c.doc_id AND p.pos = c.pos AND p.n = c.n JOIN se s ON s.doc_id = c.doc_id AND s.pos = c.pos GROUP BY c.doc_id, c.pos, c.part),
pk AS (
  SELECT *, printf('p%04d', CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first, part) AS INTEGER)) AS packet_id, len(labels) AS n_sections FROM ev)"""


def _packets_sql(target: int, most: int) -> str:
    return _PACKETS.replace("{target}", str(target)).replace("{most}", str(most))


TARGET, MOST = 2000, 3000

# ---------------------------------------------------------------- lines


@query(f"""
WITH ls AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '\\n$', ''), chr(10))) AS line FROM documents WHERE text <> '')
SELECT doc_id, count(*) AS n_lines, CAST(sum({_TOK.format('line')}) AS BIGINT) AS tokens FROM ls GROUP BY doc_id""")
def line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = src.read_lines(_table(spark, sf_dir, "documents"))
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(t.token_estimate(F.col("line"))).alias("tokens"))


@query(f"SELECT source, count(*) AS docs, CAST(sum({_TOK.format('text')}) AS BIGINT) AS tokens FROM documents GROUP BY source")
def token_estimate_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return docs.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum(t.token_estimate(F.col("text"))).alias("tokens"))


@query(f"WITH {_lines_sql(True)}, {_KEYED} SELECT doc_id, CASE WHEN is_page THEN '__page__' ELSE key END AS key, count(*) AS n FROM ky WHERE is_page OR key <> '' GROUP BY ALL HAVING count(*) >= 4")
def repeat_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.repeat_profile(src.read_lines(markdown(spark, sf_dir, noise=True))).where("n >= 4")


@query(f"""
WITH {_lines_sql(True)}, {_KEYED},
mk AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, key) AS n, min(CASE WHEN trim(line) <> '' THEN pos END) OVER (PARTITION BY doc_id) AS first_pos FROM ky),
rm AS (
  SELECT *, trim(line) <> '' AND (is_page OR (key IS NOT NULL AND key <> '' AND n >= 4 AND pos <> first_pos
         AND NOT (starts_with(ltrim(line), '#') AND regexp_matches(lower(bare), '^(chapter|book|part) ')))) AS removed FROM mk)
SELECT doc_id, count(*) AS input_lines, CAST(sum(CAST(removed AS INTEGER)) AS BIGINT) AS removed,
       CAST(sum({_TOK.format('line')}) AS BIGINT) AS all_tokens, CAST(sum(CASE WHEN removed THEN 0 ELSE {_TOK.format('line')} END) AS BIGINT) AS kept_tokens
FROM rm GROUP BY doc_id""")
def boilerplate_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = lines.mark_boilerplate(src.read_lines(markdown(spark, sf_dir, noise=True)))
    tokens = t.token_estimate(F.col("line"))
    return marked.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("input_lines"), F.count_if("removed").alias("removed"), F.sum(tokens).alias("all_tokens"),
        F.sum(F.when(F.col("removed"), 0).otherwise(tokens)).alias("kept_tokens"),
    )


@query("""
WITH ls AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
r AS (SELECT doc_id, pos, trim(line) AS line, row_number() OVER (PARTITION BY doc_id, lower(trim(line)) ORDER BY pos) AS n FROM ls WHERE trim(line) <> '')
SELECT doc_id, CAST(pos AS INTEGER) AS pos, line FROM r WHERE n = 1""")
def ordered_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.ordered_dedup(src.read_lines(_table(spark, sf_dir, "documents")), ["doc_id"], ["pos"], "line")


@query("""
WITH d AS (SELECT doc_id, regexp_replace('• ' || replace(text, '. ', ' • '), '\\n$', '') AS text FROM documents),
ls AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM d),
it AS (
  SELECT doc_id, pos, CASE WHEN starts_with(line, '• ') AND contains(substr(line, 3), ' • ')
    THEN list_transform(list_filter(list_transform(string_split(substr(line, 3), ' • '), lambda p: trim(p)), lambda p: p <> ''), lambda p: '• ' || p) ELSE [line] END AS items FROM ls)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, CAST(unnest(range(len(items))) AS INTEGER) AS part, unnest(items) AS line FROM it""")
def list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("• "), F.replace("text", F.lit(". "), F.lit(" • "))).alias("text"))
    return lines.split_lists(src.read_lines(docs))


# ---------------------------------------------------------------- text functions


@query(r"""
SELECT doc_id, md5(nfc_normalize(replace(replace(replace(text, chr(65279), ''), chr(160), ' '), chr(64257), 'fi'))) AS composed FROM documents""")
def nfc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed_text = spelling.repair_characters(F.col("text"))
    return _table(spark, sf_dir, "documents").select("doc_id", F.md5(fixed_text.cast("binary")).alias("composed"))


@query(r"SELECT doc_id, CAST(len(regexp_extract_all(text, '[^\s]+')) AS BIGINT) AS words FROM documents")
def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", t.word_count(F.col("text")).alias("words"))


@query(r"""
WITH s AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS x FROM documents)
SELECT doc_id, CASE WHEN regexp_matches(x, '[.!?] ') THEN regexp_extract(x, '^(.*?[.!?]) ', 1) ELSE x END AS sentence FROM s""")
def leading_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", t.leading_sentence(F.col("text")).alias("sentence"))


@query(rf"""
WITH {_lines_sql(False)}, {_HEADS}
SELECT doc_id, CAST(pos AS INTEGER) AS pos, regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug, {_TITLE_KEY.format('title')} AS title_key
FROM hd WHERE level > 0""")
def title_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = sections.headings(markdown(spark, sf_dir))
    return heads.select("doc_id", "pos", t.slugify(F.col("title")).alias("slug"), t.title_key(F.col("title")).alias("title_key"))


@query(f"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[a-z0-9]+')) AS token FROM documents)
SELECT doc_id, count(DISTINCT token) AS tokens FROM w WHERE length(token) >= 4 AND token NOT IN ({_list(fixed.GROUNDING_STOPWORDS)}) GROUP BY doc_id""")
def significant_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "documents").select("doc_id", F.size(t.significant_tokens(F.col("text"))).cast("long").alias("tokens"))
    return rows.where("tokens > 0")


@query(f"""
WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[a-z0-9]+')) AS token FROM documents),
k AS (SELECT DISTINCT unnest(regexp_extract_all(replace(lower(text), 'ß', 'ss'), '[a-z0-9]+')) AS token FROM benchmark)
SELECT doc_id, count(*) AS shared FROM w WHERE length(token) >= 4 AND token NOT IN ({_list(fixed.GROUNDING_STOPWORDS)}) AND token IN (SELECT token FROM k) GROUP BY doc_id""")
def grounding_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _table(spark, sf_dir, "documents").select("doc_id", F.explode(t.significant_tokens(F.col("text"))).alias("token"))
    known = _table(spark, sf_dir, "benchmark").select(F.explode(t.significant_tokens(F.col("text"))).alias("token")).distinct()
    return own.join(known, "token", "left_semi").groupBy("doc_id").agg(F.count(F.lit(1)).alias("shared"))


@query("SELECT doc_id, sha256(lang || chr(10) || text) AS key FROM documents")
def cache_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", src.cache_key(F.col("lang"), F.col("text")).alias("key"))


@query("SELECT event_id, array_to_string(list_sort(json_keys(props)), ',') AS keys FROM events")
def json_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", F.array_join(F.array_sort(F.json_object_keys("props")), ",").alias("keys"))


@query()
def fix_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", spelling.repair_spacing(F.col("text")).alias("text"))


@query()
def split_glued(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.explode(F.array_distinct(t.words(F.col("text"))))
    rows = _table(spark, sf_dir, "documents").select("doc_id", words.alias("word"))
    return rows.select("doc_id", "word", spelling.split_glued(F.col("word"), ("the", "and", "for")).alias("parts"))


# ---------------------------------------------------------------- sections


@query(f"WITH {_lines_sql(False)}, {_HEADS} SELECT doc_id, CAST(pos AS INTEGER) AS pos, CAST(level AS INTEGER) AS level, title FROM hd WHERE level > 0")
def heading_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.headings(markdown(spark, sf_dir))


@query(f"""
WITH {_lines_sql(False)}, {_HEADS}, j AS (SELECT doc_id, level > lag(level) OVER (PARTITION BY doc_id ORDER BY pos) + 1 AS jump FROM hd WHERE level > 0)
SELECT doc_id, CAST(sum(CASE WHEN jump THEN 1 ELSE 0 END) AS BIGINT) AS heading_skips FROM j GROUP BY doc_id""")
def heading_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.heading_skips(markdown(spark, sf_dir))


@query(f"WITH {_lines_sql(False)}, {_HEADS} SELECT doc_id, arg_min(title, pos) AS book_title FROM hd WHERE level = 1 GROUP BY doc_id")
def book_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.book_titles(markdown(spark, sf_dir))


def _book(spark: SparkSession, sf_dir: str, noise: bool = False) -> DataFrame:
    """The Markdown for queries that read it several times."""
    bounded_batches(spark)
    return settled(markdown(spark, sf_dir, noise))


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.sections(_book(spark, sf_dir))


@query(f"WITH {_SECTIONS} SELECT doc_id, section_id, CAST(level AS INTEGER) AS level, title, path, chapter_title, CAST(token_estimate AS BIGINT) AS token_estimate, md5(raw_text) AS body FROM se")
def section_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sections(spark, sf_dir)
    return rows.select("doc_id", "section_id", "level", "title", F.array_join("path", " > ").alias("path"), "chapter_title", "token_estimate", F.md5(F.col("raw_text").cast("binary")).alias("body"))


@query(f"WITH {_SECTIONS} SELECT doc_id, section_id, {_kind_sql('path', 'raw_text')} AS kind FROM se")
def section_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets.with_flags(_sections(spark, sf_dir), MOST).select("doc_id", "section_id", "kind")


@query(f"""
WITH {_lines_sql(False)}, {_HEADS}
SELECT DISTINCT doc_id, {_TITLE_KEY.format("title")} AS title_key FROM hd WHERE level > 0 AND title <> '' AND level > 1""")
def toc_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each book's headings written out as a contents list before it, and read back from there."""
    docs = _book(spark, sf_dir)
    # The list's entries are pieces of their own before the book's, so that no task holds a list.
    heads = sections.outlined(docs).select("doc_id", "piece", F.explode("heads").alias("h")).where("h.level > 1")
    place = lambda k, piece, at: F.struct(F.lit(k).alias("s"), piece.alias("piece"), at.alias("at")).alias("piece")
    entries = heads.select("doc_id", place(1, F.col("piece"), F.col("h.at")), F.concat(F.lit("- "), "h.title").alias("text"))
    some, none = settled(entries.select("doc_id").distinct()), F.lit(0)
    begin, end = (some.select("doc_id", place(k, none, none), F.lit(x).alias("text")) for k, x in ((0, "## Contents\n"), (2, "")))
    own = docs.join(F.broadcast(some), "doc_id", "left_semi").select("doc_id", place(3, F.col("piece"), none), "text")
    return sections.contents_titles(begin.unionByName(entries).unionByName(end).unionByName(own))


# ---------------------------------------------------------------- packets and book map


def _packets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sections and their packets."""
    found = settled(_sections(spark, sf_dir))
    return found, packets.packets(found, TARGET, MOST)


@query(f"WITH RECURSIVE {_packets_sql(TARGET, MOST)} SELECT doc_id, packet_id, chapter_title, n_sections, CAST({_TOK.format('raw_text')} AS BIGINT) AS token_estimate, md5(raw_text) AS body FROM pk")
def packet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _packets(spark, sf_dir)[1].select(
        "doc_id", "packet_id", "chapter_title", F.size("section_labels").cast("long").alias("n_sections"), "token_estimate", F.md5(F.col("raw_text").cast("binary")).alias("body")
    )


@query(f"""
WITH RECURSIVE {_SECTIONS},
pp AS (SELECT doc_id, pos, list_filter(list_transform(string_split_regex(raw_text, '\\n\\n+'), lambda p: {_STRIP.format('p')}), lambda p: p <> '') AS ps FROM se WHERE token_estimate > 300),
pr AS (SELECT doc_id, pos, unnest(ps) AS paragraph, unnest(range(len(ps))) AS n FROM pp),
ps AS (SELECT doc_id, pos, n, {_TOK.format('paragraph')} AS tok FROM pr),
fold(doc_id, pos, n, part, cum) AS (
  SELECT doc_id, pos, n, CAST(0 AS BIGINT), CAST(tok AS BIGINT) FROM ps WHERE n = 0
  UNION ALL
  SELECT x.doc_id, x.pos, x.n, f.part + CASE WHEN f.cum >= 300 OR f.cum + x.tok > 200 THEN 1 ELSE 0 END, CASE WHEN f.cum >= 300 OR f.cum + x.tok > 200 THEN x.tok ELSE f.cum + x.tok END
  FROM fold f JOIN ps x ON x.doc_id = f.doc_id AND x.pos = f.pos AND x.n = f.n + 1)
SELECT doc_id, CAST(pos AS BIGINT) AS pos, CAST(n AS INTEGER) AS n, part FROM fold""")
def large_section_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets.large_section_parts(settled(_sections(spark, sf_dir)), 200, 300).select("doc_id", "pos", "n", "part")


_PROFILED = f"{_packets_sql(TARGET, MOST)}, pf AS (SELECT *, {_kind_sql("array_to_string(labels, ' ')", 'raw_text')} AS kind FROM pk)"


@query(f"WITH RECURSIVE {_PROFILED} SELECT doc_id, packet_id, kind AS packet_kind, CAST({_PRIORITY_SQL.format('kind')} AS INTEGER) AS priority_weight FROM pf")
def packet_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bookmap.packet_profiles(_packets(spark, sf_dir)[1]).select("doc_id", "packet_id", "packet_kind", "priority_weight")


_CHAPTERS = f"""{_PROFILED},
vo AS (SELECT *, {_PRIORITY_SQL.format('kind')} AS weight, kind IN ('reference', 'endmatter') AS doc FROM pf),
vt AS (SELECT *, min(CAST(doc AS INTEGER)) OVER (PARTITION BY doc_id, chapter_title) AS alldoc FROM vo),
vs AS (SELECT doc_id, chapter_title, kind, sum(weight) AS votes FROM vt WHERE alldoc = 1 OR NOT doc GROUP BY ALL),
vr AS (SELECT *, row_number() OVER (PARTITION BY doc_id, chapter_title ORDER BY votes DESC, {_PRIORITY_SQL.format('kind')} DESC, kind) AS r FROM vs),
cs AS (SELECT doc_id, chapter_title, count(*) AS section_count FROM se GROUP BY ALL),
ch AS (
  SELECT v.doc_id, v.chapter_title, r.kind AS chapter_kind, CAST(max(v.weight) AS INTEGER) AS priority_weight, count(*) AS packet_count, min(cs.section_count) AS section_count
  FROM vo v JOIN vr r ON r.doc_id = v.doc_id AND r.chapter_title = v.chapter_title AND r.r = 1 JOIN cs ON cs.doc_id = v.doc_id AND cs.chapter_title = v.chapter_title
  GROUP BY v.doc_id, v.chapter_title, r.kind)"""


@query(f"WITH RECURSIVE {_CHAPTERS} SELECT * FROM ch")
def chapter_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, made = _packets(spark, sf_dir)
    rows = bookmap.chapter_profiles(settled(bookmap.packet_profiles(made)), found)
    return rows.select("doc_id", "chapter_title", "chapter_kind", "priority_weight", "packet_count", "section_count")


_SUPPLEMENTAL = _any(r"lower(trim(regexp_replace(x, '\s+', ' ', 'g')))", fixed.AUDIT_SUPPLEMENTAL)


@query(f"""
WITH RECURSIVE {_CHAPTERS},
w AS (
  SELECT doc_id, 'packet' AS scope, packet_id AS item, 0 AS ord, packet_id || ': packet mixes likely supplemental/endmatter sections with core chapter material; consider splitting earlier' AS warning
  FROM vo WHERE len(list_filter(labels, lambda x: {_SUPPLEMENTAL})) BETWEEN 1 AND len(labels) - 1
  UNION ALL
  SELECT doc_id, 'packet', packet_id, 1, packet_id || ': packet is still classified as mixed at priority ' || weight || '; review weighting before summarizing' FROM vo WHERE kind = 'mixed' AND weight >= 3
  UNION ALL
  SELECT doc_id, 'chapter', chapter_title, 0, chapter_title || ': chapter remains mixed in the map; summaries may need extra proportion judgment' FROM ch WHERE chapter_kind = 'mixed' AND priority_weight >= 3
  UNION ALL
  SELECT doc_id, 'chapter', chapter_title, 1, chapter_title || ': chapter is classified as documentary despite high priority; review upstream packet splitting or weighting'
  FROM ch WHERE chapter_kind IN ('reference', 'endmatter') AND priority_weight >= 4)
SELECT doc_id, scope, item, CAST(ord AS INTEGER) AS ord, warning FROM w""")
def map_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, made = _packets(spark, sf_dir)
    profiles = settled(bookmap.packet_profiles(made))
    return bookmap.map_review(profiles, bookmap.chapter_profiles(profiles, found))


@query()
def book_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = summarize.structure(_book(spark, sf_dir))
    return bookmap.render_map(s.chapters, s.titles)


@query(f"""
WITH RECURSIVE {_packets_sql(6500, 8500)},
bt AS (SELECT doc_id, arg_min(title, pos) AS book_title FROM hd WHERE level = 1 GROUP BY doc_id),
s1 AS (SELECT doc_id, count(*) AS section_count, CAST(sum(token_estimate) AS BIGINT) AS source_token_estimate FROM se GROUP BY doc_id),
p1 AS (SELECT doc_id, count(*) AS packet_count, CAST(sum({_TOK.format('raw_text')}) AS BIGINT) AS packet_token_estimate, count(DISTINCT lower(trim(chapter_title))) AS book_map_chapter_count FROM pk GROUP BY doc_id)
SELECT * FROM bt JOIN s1 USING (doc_id) JOIN p1 USING (doc_id)""")
def run_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize.plan(_book(spark, sf_dir))


# ---------------------------------------------------------------- blocks


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of the texts: headings as parsed, numbers of titles dropped, everything else a paragraph."""
    raw = blocks.text_blocks(_book(spark, sf_dir))
    line = F.get("lines", F.lit(0))
    level = t.heading_level(line)
    title = F.regexp_replace(t.heading_text(line), r" \d+$", "")
    return raw.select(
        "doc_id", "piece", "block_no", F.when(level > 0, "heading").otherwise("paragraph").alias("kind"), F.when(level > 0, title).otherwise(F.array_join("lines", " ")).alias("text"),
        F.when(level > 0, level).alias("level"), (level > 0).alias("explicit"),
    )


_BLOCKS = f"""
{_lines_sql(False)},
isl AS (SELECT doc_id, pos, line, sum(CASE WHEN trim(line) = '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM ls),
gr AS (SELECT doc_id, run, min(pos) AS p, count(*) AS n_lines, string_agg(line, ' ' ORDER BY pos) AS body FROM isl WHERE trim(line) <> '' GROUP BY doc_id, run),
rb AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY run) AS block_no FROM gr),
bk AS (
  SELECT doc_id, block_no, n_lines, body, length(regexp_extract(trim(body), '^(#+)', 1)) AS level,
         CASE WHEN starts_with(trim(body), '#') THEN regexp_replace(trim(regexp_replace(trim(body), '^#+', '')), ' [0-9]+$', '') ELSE body END AS text FROM rb)"""


@query(f"WITH {_BLOCKS} SELECT doc_id, block_no, n_lines, md5(body) AS body FROM bk")
def raw_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = blocks.text_blocks(_book(spark, sf_dir))
    return rows.select("doc_id", "block_no", F.size("lines").cast("long").alias("n_lines"), F.md5(F.array_join("lines", " ").cast("binary")).alias("body"))


@query(f"""
WITH {_BLOCKS},
o AS (SELECT *, level > 0 AND lower(text) IN ({_list(fixed.BACK_MATTER)}) AS opens FROM bk),
i AS (SELECT *, coalesce(max(CAST(opens AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY block_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inside FROM o)
SELECT doc_id, block_no, CASE WHEN level > 0 AND NOT (inside = 1 AND NOT opens) THEN 'heading' ELSE 'paragraph' END AS kind FROM i""")
def backmatter_demote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.demote_backmatter(_blocks(spark, sf_dir)).select("doc_id", "block_no", "kind")


@query(f"""
WITH RECURSIVE {_BLOCKS},
h AS (SELECT doc_id, block_no, level, regexp_matches(lower(text), '^({"|".join(fixed.MAJOR_PREFIXES)})') AS major, row_number() OVER (PARTITION BY doc_id ORDER BY block_no) AS i FROM bk WHERE level > 0),
f(doc_id, block_no, i, level) AS (
  SELECT doc_id, block_no, i, CAST(1 AS BIGINT) FROM h WHERE i = 1
  UNION ALL
  SELECT h.doc_id, h.block_no, h.i, CAST(CASE WHEN h.major THEN 2 ELSE least(greatest(2, least(h.level, 4)), f.level + 1) END AS BIGINT) FROM f JOIN h ON h.doc_id = f.doc_id AND h.i = f.i + 1)
SELECT doc_id, block_no, CAST(level AS INTEGER) AS level FROM f""")
def heading_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.heading_levels(_blocks(spark, sf_dir).where("kind = 'heading'"))


@query(f"""
WITH {_BLOCKS},
c AS (SELECT doc_id, block_no, CASE WHEN level > 0 AND text = 'Sources' THEN 'Contents' ELSE text END AS text, level > 0 AS heading FROM bk WHERE level > 0 OR block_no % 7 = 0),
r AS (SELECT *, sum(CASE WHEN heading THEN 0 ELSE 1 END) OVER w AS run, lead(heading) OVER w AS nxt FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY block_no)),
m AS (SELECT *, min(CASE WHEN heading AND lower(text) = 'contents' THEN block_no END) OVER (PARTITION BY doc_id, run) AS c FROM r),
e AS (SELECT *, coalesce(heading AND block_no > c AND (nxt IS NULL OR nxt), false) AS entry FROM m),
u AS (
  SELECT doc_id, block_no, 0 AS sub, CASE WHEN heading THEN 'heading' ELSE 'paragraph' END AS kind, text FROM e WHERE NOT entry
  UNION ALL SELECT doc_id, c, 1, 'list', string_agg('- ' || text, chr(10) ORDER BY block_no) FROM e WHERE entry GROUP BY doc_id, c)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY block_no, sub) AS block_no, kind, md5(text) AS body FROM u""")
def contents_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings with one paragraph in seven between them, so that those after a contents heading run on."""
    rows = _blocks(spark, sf_dir).where((F.col("kind") == "heading") | (F.col("block_no") % 7 == 0))
    rows = rows.withColumn("text", F.when((F.col("kind") == "heading") & (F.col("text") == "Sources"), "Contents").otherwise(F.col("text")))
    return blocks.contents_to_list(rows).select("doc_id", "block_no", "kind", F.md5(F.col("text").cast("binary")).alias("body"))


@query()
def block_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm.segmented(_book(spark, sf_dir, noise=True)).groupBy("doc_id", "kind").agg(F.count(F.lit(1)).alias("blocks"))


@query()
def paragraph_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.merge_paragraphs(_blocks(spark, sf_dir)).drop("piece")


@query()
def normalized_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm.normalize(_book(spark, sf_dir, noise=True))


@query()
def file_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm.file_summary(_book(spark, sf_dir, noise=True))


# ---------------------------------------------------------------- work


def _work(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Prompts: documents by language; outputs: those that have a label."""
    prompts = _table(spark, sf_dir, "documents").select("lang", "doc_id")
    return prompts, prompts.join(_table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").select("lang", "doc_id")


@query("SELECT lang, doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def missing_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return work.missing(*_work(spark, sf_dir), ["lang", "doc_id"])


@query("SELECT lang, min(doc_id) AS doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY lang")
def next_work_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return work.next_items(*_work(spark, sf_dir), "lang", "doc_id")


@query("SELECT lang, count(*) AS total, count(l.doc_id) AS completed FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id GROUP BY lang")
def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return work.progress(*_work(spark, sf_dir), "lang", "doc_id")


_NEXT = (
    ("chunks", "complete_prompt", "p0001"), ("chapters", "run_command", "build-chapters"), ("chapters", "complete_prompt", "c001"), ("final", "run_command", "build-final"),
    ("final", "complete_prompt", "final"), ("verify", "run_command", "build-verify"), ("verify", "complete_prompt", "verify"), ("assemble", "run_command", "assemble"), ("done", "none", ""),
)


def _next_sql(c: int, name: str) -> str:
    return f"CASE doc_id % 9 {' '.join(f"WHEN {k} THEN '{x[c]}'" for k, x in enumerate(_NEXT))} END AS {name}"


@query(f"SELECT doc_id AS job, {_next_sql(0, 'stage')}, {_next_sql(1, 'action_type')}, {_next_sql(2, 'target')} FROM documents")
def next_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs that have come through the first steps: doc_id modulo 9 of them; what lies beyond the next step is as open."""
    done = F.col("doc_id") % 9
    status = _table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("job"), F.when(done < 1, "p0001").alias("next_chunk"), (done >= 2).alias("chapters_prepared"), F.when(done < 3, "c001").alias("next_chapter"), (done >= 4).alias("final_prompt"),
        (done >= 5).alias("final_output"), (done >= 6).alias("verify_prompt"), (done >= 7).alias("verify_output"), (done >= 8).alias("assembled"),
    )
    return work.next_action(status)


# ---------------------------------------------------------------- payloads and audit


def _chunk_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A synthetic chunk payload per conversation turn; every third is legacy, every seventh is broken."""
    rows = _table(spark, sf_dir, "conversations")
    item = F.concat_ws("-", "conv_id", "turn")
    some = F.array(F.substring("text", 1, 40), F.substring("text", 41, 40))
    legacy = F.struct(
        F.col("role").alias("chapter_title"), F.array("role").alias("covered_sections"), F.col("text").alias("summary"), some.alias("main_points"), some.alias("examples_or_evidence"),
        F.array().cast("array<string>").alias("ambiguity_flags"), F.when(F.col("turn") % 7 == 6, "unsure").otherwise("high").alias("confidence"),
    )
    added = F.struct(F.lit("case_study").alias("packet_kind"), F.col("role").alias("role_in_book"), some.alias("primary_claims"), F.array().cast("array<string>").alias("methods_or_principles"), F.array().cast("array<string>").alias("story_events"), (F.col("turn") % 9).cast("int").alias("priority_weight"))
    whole = F.concat(F.regexp_replace(F.to_json(legacy), r"\}$", ","), F.regexp_replace(F.to_json(added), r"^\{", ""))
    return rows.select(F.col("conv_id").cast("string").alias("doc_id"), item.alias("item_id"), F.when(F.col("turn") % 3 == 0, F.to_json(legacy)).otherwise(whole).alias("payload"))


def _chunk_map(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Packet profiles for every second turn (one in four without a kind), chapter profiles for two documents in three."""
    rows = _table(spark, sf_dir, "conversations")
    doc = F.col("conv_id").cast("string").alias("doc_id")
    kind = F.when(F.col("turn") % 4 == 0, "reference").otherwise("")
    profiles = rows.where("turn % 2 = 0").select(doc, F.concat_ws("-", "conv_id", "turn").alias("packet_id"), kind.alias("packet_kind"), F.concat(F.lit("packet of "), "role").alias("role_in_book"), (F.col("turn") % 5 + 1).cast("int").alias("priority_weight"))
    chapters = rows.where("conv_id % 3 <> 0").select(doc, F.col("role").alias("chapter_title"), F.lit("framing").alias("chapter_kind"), F.lit(2).alias("priority_weight")).distinct()
    return profiles, chapters


_TURNS = """
cv AS (
  SELECT CAST(conv_id AS VARCHAR) AS doc_id, conv_id || '-' || turn AS item_id, conv_id, turn, role, text, turn % 3 = 0 AS legacy, turn % 7 = 6 AS unsure, turn % 9 AS weight,
         list_filter([trim(substr(text, 1, 40)), trim(substr(text, 41, 40))], lambda p: p <> '') AS points, [substr(text, 1, 40), substr(text, 41, 40)] AS halves FROM conversations)"""
_UNSURE = "['$.confidence', 'expected one of [''high'', ''medium'', ''low''], got ''unsure''']"
_ADDED = ("packet_kind", "role_in_book", "primary_claims", "methods_or_principles", "story_events", "priority_weight")


def _said(fields, message: str) -> str:
    return ", ".join(f"['$.{c}', '{message}']" for c in fields)


@query(f"""
WITH {_TURNS},
er AS (
  SELECT doc_id, item_id, 'chunk' AS schema_name, list_concat(list_concat(
    CASE WHEN legacy THEN [{_said(_ADDED, "missing required property")}] ELSE [] END, CASE WHEN unsure THEN [{_UNSURE}] ELSE [] END),
    CASE WHEN NOT legacy AND weight < 1 THEN [['$.priority_weight', 'expected >= 1, got ' || weight]] WHEN NOT legacy AND weight > 5 THEN [['$.priority_weight', 'expected <= 5, got ' || weight]] ELSE [] END) AS found FROM cv
  UNION ALL
  SELECT doc_id, item_id, 'chunk_legacy', list_concat(
    CASE WHEN legacy THEN [] ELSE [{_said(sorted(_ADDED), "unexpected property")}] END, CASE WHEN unsure THEN [{_UNSURE}] ELSE [] END) FROM cv),
un AS (SELECT doc_id, item_id, schema_name, unnest(range(len(found))) AS ord, unnest(found) AS f FROM er)
SELECT doc_id, item_id, schema_name, CAST(ord AS INTEGER) AS ord, f[1] AS path, f[2] AS message FROM un""")
def schema_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.schema_errors(_chunk_payloads(spark, sf_dir), "chunk")


@query(f"""
WITH {_TURNS}
SELECT doc_id, item_id, CASE WHEN unsure THEN NULL WHEN legacy THEN 'chunk_legacy' WHEN weight BETWEEN 1 AND 5 THEN 'chunk' END AS matched FROM cv""")
def matched_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.matched_schema(_chunk_payloads(spark, sf_dir), "chunk").select("doc_id", "item_id", "matched")


_ENRICHED = f"""
{_TURNS},
mp AS (
  SELECT *, turn % 2 = 0 AS packed, conv_id % 3 <> 0 AS told,
         CASE WHEN NOT legacy THEN 'case_study' WHEN turn % 4 = 0 THEN 'reference' WHEN conv_id % 3 <> 0 THEN 'framing' ELSE 'mixed' END AS packet_kind FROM cv),
en AS (
  SELECT *, CASE WHEN NOT legacy THEN role WHEN packed THEN 'packet of ' || role WHEN packet_kind = 'framing' THEN 'Frames or transitions the book''s agenda around ' || role || '.'
                 ELSE 'Supports the book through mixed exposition and examples in ' || role || '.' END AS role_in_book,
         CASE WHEN legacy THEN halves ELSE [] END AS story_events,
         CAST(CASE WHEN NOT legacy THEN weight WHEN packed THEN turn % 5 + 1 WHEN told THEN 2 ELSE {_PRIORITY_SQL.format('packet_kind')} END AS INTEGER) AS priority_weight FROM mp)"""


@query(f"""
WITH {_ENRICHED}
SELECT doc_id, item_id, packet_kind, role_in_book, array_to_string(halves, '|') AS primary_claims, array_to_string(story_events, '|') AS story_events, priority_weight, md5(text) AS summary FROM en""")
def enriched_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = payloads.enrich_chunks(_chunk_payloads(spark, sf_dir), *_chunk_map(spark, sf_dir))
    listed = [F.array_join(c, "|").alias(c) for c in ("primary_claims", "story_events")]
    return rows.select("doc_id", "item_id", "packet_kind", "role_in_book", *listed, "priority_weight", F.md5(F.col("summary").cast("binary")).alias("summary"))


@query(rf"""
WITH {_ENRICHED},
f AS (
  SELECT *, len(regexp_extract_all(text, '[^\s]+')) AS n, packet_kind IN ('reference', 'endmatter') AS minor, CASE WHEN priority_weight = 0 THEN 3 ELSE priority_weight END AS w,
         len(list_filter(story_events, lambda x: trim(x) <> '')) AS events FROM en),
r AS (
  SELECT doc_id, item_id, unnest([
    CASE WHEN minor AND n > 180 THEN 'reference/endmatter chunk summary looks too long for its priority' END,
    CASE WHEN w >= 4 AND n < 90 THEN 'high-priority chunk summary looks too short for its weighting' END,
    CASE WHEN w >= 4 AND len(points) < 3 THEN 'high-priority chunk should usually preserve at least three main points' END,
    CASE WHEN packet_kind = 'case_study' AND events = 0 THEN 'case-study chunk is missing story_events' END]) AS warning, unnest([0, 1, 2, 5]) AS ord FROM f)
SELECT doc_id, 'chunk' AS scope, item_id AS item, CAST(ord AS INTEGER) AS ord, warning FROM r WHERE warning IS NOT NULL""")
def chunk_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.chunk_findings(payloads.enrich_chunks(_chunk_payloads(spark, sf_dir), *_chunk_map(spark, sf_dir)))


@query()
def chunk_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize.chunk_prompts(summarize.structure(_book(spark, sf_dir)))


@query()
def schema_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(k, json.dumps(schemas.template(s))) for k, s in schemas.SCHEMAS.items()], "stage string, template string")
