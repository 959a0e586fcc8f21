"""Text functions as column expressions: Column -> Column, all inside the JVM.

White space and word bounds are Unicode's, as ``(?U)`` asks; lengths are code points.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import fixed

BLANK = r"(?U)\s+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, though ``body`` may use it for every item of an array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Unicode's white space, as ``(?U)\\s`` has it.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(x: Column) -> Column:
    """Without white space at both ends, which are looked at alone."""
    return F.btrim(x, F.lit(WHITE))


def squeeze(x: Column) -> Column:
    return F.regexp_replace(x, BLANK, " ")


def casefold(x: Column) -> Column:
    """Full case folding: upper case first, which spells out what has no single small letter; the dotless i stays, and
    there is one small sigma."""
    dotless, kept = F.lit("ı"), F.lit("\ue131")
    # The replacement in between also keeps the optimizer from taking lower(upper(x)) for lower(x).
    upper = F.replace(F.upper(F.replace(x, dotless, kept)), kept, dotless)
    return F.when(x.rlike(r"[^\x00-\x7F]"), F.replace(F.lower(upper), F.lit("ς"), F.lit("σ"))).otherwise(F.lower(x))


def starts_with_any(x: Column, prefixes) -> Column:
    return reduce(lambda a, b: a | b, [x.startswith(p) for p in prefixes])


def contains_any(x: Column, parts) -> Column:
    return reduce(lambda a, b: a | b, [x.contains(p) for p in parts])


def words(x: Column) -> Column:
    return F.filter(F.split(x, BLANK), lambda w: w != "")


def word_count(x: Column) -> Column:
    """White-space words; null has none."""
    return F.coalesce(F.size(words(x)), F.lit(0)).cast("long")


def token_estimate(x: Column) -> Column:
    """A quarter of the characters, at least one unless empty."""
    n = F.length(x)
    return F.when(n == 0, F.lit(0)).otherwise(F.greatest(F.lit(1), F.floor(n / 4))).cast("long")


def repair_characters(x: Column) -> Column:
    """Mis-decoded sequences and ligatures in their fixed order (before composition to NFC)."""
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), fixed.CHARACTER_REPAIRS, x)


def normalize_line(x: Column) -> Column:
    """Tabs to two spaces, spaced hash marks joined, a space after hash marks, no trailing blanks."""
    line = F.replace(x, F.lit("\t"), F.lit("  "))
    spaced = F.regexp_extract(line, r"(?U)^\s*((?:#\s*){2,6})(?=\S)", 0)
    joined = F.concat(F.repeat(F.lit("#"), F.regexp_count(spaced, F.lit("#"))), F.lit(" "), F.substr(line, F.length(spaced) + 1))
    line = F.when(spaced != "", joined).otherwise(line)
    line = F.regexp_replace(line, r"(?U)^(#{1,6})(\S)", "$1 $2")
    return F.regexp_replace(line, r"(?U)\s+$", "")


def without_markers(x: Column) -> Column:
    """The line without one heading mark and one list mark."""
    line = F.regexp_replace(x, r"(?U)^\s*#{1,6}\s*", "")
    return strip(F.regexp_replace(line, r"(?U)^\s*(?:[-+*•]|\d{1,3}[.)]|[A-Za-z][.)])\s*", ""))


def repeat_key(x: Column) -> Column:
    """What repeated lines have in common, or null for lines that are never boilerplate."""
    text = without_markers(x)
    key = F.regexp_replace(F.lower(text), r"(?U)\b\d+\b", "<n>")
    key = strip(squeeze(F.regexp_replace(key, r"(?U)\b[ivxlcdm]+\b", "<r>")))
    plain = (text != "") & (F.length(text) <= 80) & (F.size(words(text)) <= 10) & ~text.rlike(r"[.!?]$")
    return F.when(plain & (key != ""), key)


def is_page_line(x: Column) -> Column:
    return x.rlike(r"(?iU)^\s*page\s+(?:\d+|[ivxlcdm]+)\s*$")


def is_blank(x: Column) -> Column:
    return ~x.rlike(r"(?U)\S")


def heading_level(x: Column) -> Column:
    """Hash marks of a heading line (0: none), for headings that need no space after them."""
    return F.length(F.regexp_extract(strip(x), r"^(#{1,6})", 1))


def heading_text(x: Column) -> Column:
    line = strip(x)
    return F.when(heading_level(x) > 0, strip(F.regexp_replace(line, r"^#{1,6}", ""))).otherwise(line)


def is_all_caps(x: Column) -> Column:
    return x.rlike(r"\p{L}") & ~x.rlike(r"[\p{L}&&[^\p{Lu}]]")


def is_title_like(x: Column) -> Column:
    """At most 12 words of which at least seven tenths look like a title's."""
    found = F.regexp_extract_all(x, F.lit(r"[A-Za-z0-9’'-]+"), F.lit(0))
    titled = F.filter(found, lambda w: F.lower(w).isin(*fixed.SMALL_TITLE_WORDS) | w.rlike(r"^[A-Z0-9]") | (w.rlike("[A-Z]") & ~w.rlike("[a-z]")))
    return (F.size(found) > 0) & (F.size(found) <= 12) & (F.size(titled) * 10 >= F.size(found) * 7)


def heading_parts(x: Column) -> Column:
    """struct(is_heading, level, text, explicit) of a line on its own."""
    level, text = heading_level(x), heading_text(x)
    low, explicit = F.lower(text), heading_level(x) > 0
    never = (
        (text == "") | starts_with_any(low, fixed.BYLINE_PREFIXES) | low.startswith("isbn:") | text.contains("|")
        | text.rlike(r"(?iU),\s*(?:[a-z]{1,3}\.)?\d") | (F.length(text) > 120)
    )
    short_caps = (F.length(text) <= 3) & is_all_caps(text)
    quoted = text.rlike("^[“\"']")
    major = starts_with_any(low, fixed.MAJOR_PREFIXES)
    titled = ~text.endswith(".") & (F.size(words(text)) <= 12) & (is_title_like(text) | is_all_caps(text))
    yes = F.when(never, False).when(explicit, ~short_caps & ~quoted).otherwise(major | titled)
    return F.struct(
        yes.alias("is_heading"), F.when(yes & explicit, level).when(yes & major, F.lit(2)).cast("int").alias("level"), text.alias("text"), (yes & explicit).alias("explicit")
    )


def _repaired(x: Column, steps: tuple[tuple[str, str], ...]) -> Column:
    return reduce(lambda c, step: F.regexp_replace(c, "(?U)" + step[0], step[1].replace("\\", "$")), steps, x)


def repair_urls(x: Column) -> Column:
    """Addresses that a scan broke by blanks, joined again."""
    return _repaired(x, fixed.ADDRESS_REPAIRS)


def repair_spacing(x: Column) -> Column:
    """The part of spacing repair that needs no word list: stops, abbreviations, numbers, marks, blanks, addresses."""
    return repair_urls(strip(_repaired(x, fixed.SPACING_REPAIRS)))


def slugify(x: Column, default: str = "book") -> Column:
    slug = F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(slug == "", F.lit(default)).otherwise(slug)


def title_key(x: Column) -> Column:
    """A title without chapter words and leading numbers, in lower case, for matching."""
    text = F.regexp_replace(strip(x), r"(?iU)^(?:chapter|book|part|section)\s+\d+[.:]?\s*", "")
    return casefold(squeeze(F.regexp_replace(text, r"(?U)^\d+[.):]?\s*", "")))


def matching_text(x: Column) -> Column:
    return casefold(squeeze(strip(x)))


def leading_sentence(x: Column) -> Column:
    return F.get(F.split(strip(squeeze(x)), r"(?<=[.!?]) ", 2), 0)


def significant_tokens(x: Column) -> Column:
    """Distinct ASCII words of four characters or more that are not stopwords."""
    # White space only parts words, and below U+0100 the sharp s alone folds to ASCII letters: most texts need no full folding.
    folded = F.when(x.rlike(r"[^\x00-\xFF]"), casefold(x)).otherwise(F.replace(F.lower(x), F.lit("ß"), F.lit("ss")))
    return F.array_except(F.regexp_extract_all(folded, F.lit("[a-z0-9]{4,}"), F.lit(0)), F.array(*map(F.lit, fixed.GROUNDING_STOPWORDS)))


def priority(kind: Column) -> Column:
    chosen = reduce(lambda c, kv: c.when(kind == kv[0], F.lit(kv[1])), fixed.PRIORITY.items(), F)
    return chosen.otherwise(F.lit(3))


def guidance(weight: Column, kind: Column) -> Column:
    g = fixed.GUIDANCE
    return (
        F.when(weight >= 5, g[5]).when(weight == 4, g[4]).when(weight == 3, g[3]).when(kind.isin(*fixed.DOCUMENTARY), g["documentary"]).otherwise(g["other"])
    )


def role(kind: Column, chapter: Column, labels: Column) -> Column:
    named = F.when(F.size(labels) > 0, F.array_join(F.slice(labels, 1, 3), ", ")).otherwise(chapter)
    say = lambda before, what, after="": F.concat(F.lit(before), what, F.lit(after))
    return (
        F.when(kind == "core_argument", say("Carries a main explanatory or prescriptive argument centered on ", chapter, "."))
        .when(kind == "case_study", say("Advances the book through concrete events, chronology, or examples in ", chapter, "."))
        .when(kind == "framing", say("Frames or transitions the book's agenda around ", chapter, "."))
        .when(kind == "reference", say("Documents supporting source material for ", named, "."))
        .when(kind == "endmatter", say("Wraps up or documents non-argumentative back matter related to ", named, "."))
        .otherwise(say("Supports the book through mixed exposition and examples in ", chapter, "."))
    )


def _kind(key: Column, near: Column, years: Column) -> Column:
    principles = sum((near.contains(w).cast("int") for w in fixed.PRINCIPLE_WORDS), F.lit(0))
    return (
        F.when(contains_any(key, fixed.REFERENCE_TITLES), "reference")
        .when(contains_any(key, fixed.ENDMATTER_TITLES) | key.startswith("timeline"), "endmatter")
        .when(contains_any(near, fixed.REFERENCE_WORDS), "reference")
        .when(contains_any(near, fixed.ENDMATTER_WORDS), "endmatter")
        .when(contains_any(near, fixed.FRAMING_WORDS), "framing")
        .when((principles >= 2) & (years <= 3), "core_argument")
        .when(years >= 4, "case_study")
        .otherwise("mixed")
    )


def _near(key: Column, raw: Column) -> Column:
    return F.concat(key, F.lit("\n"), casefold(F.substring(raw, 1, fixed.KIND_WINDOW)))


def _years(raw: Column) -> Column:
    return F.regexp_count(raw, F.lit("(?U)" + fixed.YEAR))


def section_kind(title: Column, raw: Column) -> Column:
    """One of six kinds: marks of the title first, then words near the start, then principles against years."""
    key = title_key(title)
    return _kind(key, _near(key, raw), _years(raw))


def with_kind(rows: DataFrame, title: Column, name: str, raw: str = "raw_text") -> DataFrame:
    """``section_kind`` as a column, its parts computed once a row."""
    keyed = rows.withColumn("_key", title_key(title)).withColumn("_near", _near(F.col("_key"), F.col(raw))).withColumn("_years", _years(F.col(raw)))
    return keyed.withColumn(name, _kind(F.col("_key"), F.col("_near"), F.col("_years"))).drop("_key", "_near", "_years")


def is_supplemental_title(label: Column) -> Column:
    return contains_any(title_key(label), fixed.SUPPLEMENTAL_TITLES)


def is_supplemental_label(label: Column) -> Column:
    """The audit's own, different test for supplemental matter."""
    return contains_any(matching_text(label), fixed.AUDIT_SUPPLEMENTAL)


def is_matter_title(title: Column) -> Column:
    return title_key(title).isin(*fixed.MATTER_TITLES)


def has_marker(x: Column, markers) -> Column:
    return contains_any(matching_text(x), markers)


def any_marker(texts: Column, markers) -> Column:
    return F.exists(texts, lambda t: has_marker(t, markers))


def mentions_uncertainty(notes: Column) -> Column:
    return contains_any(casefold(F.array_join(notes, " ")), fixed.UNCERTAINTY)


def clean_strings(values: Column) -> Column:
    """Trimmed non-blank items; a null list is empty."""
    return F.filter(F.transform(F.coalesce(values, F.array().cast("array<string>")), strip), lambda v: v != "")


def distinct_in_order(values: Column) -> Column:
    """Trimmed, without blanks, each text once by folded case, in order of first appearance."""
    return let(
        clean_strings(values),
        lambda cleaned: let(F.transform(cleaned, casefold), lambda keys: F.filter(cleaned, lambda v, i: F.array_position(keys, F.get(keys, i)) == i + 1)),
    )


def shares_tokens(text: Column, candidates: Column) -> Column:
    """Whether a text without significant tokens, or one with any token of any candidate."""
    own = significant_tokens(text)
    return (F.size(own) == 0) | F.arrays_overlap(own, significant_tokens(F.array_join(candidates, " ")))


def is_code(lines: Column) -> Column:
    dense = F.filter(
        lines,
        lambda x: (F.length(x) >= 10) & ((F.regexp_count(x, F.lit(r"[{}\[\]();=<>`]")) * 100 >= F.length(x) * 12) | x.rlike("[{}();=<>]{2,}")),
    )
    return (F.size(lines) >= 2) & F.forall(lines, lambda x: x.startswith("    ") | x.startswith("\t")) & (F.size(dense) >= 2)


def is_pipe_table(lines: Column) -> Column:
    pipes = F.transform(lines, lambda x: F.regexp_count(x, F.lit(r"\|")))
    return (F.size(lines) >= 3) & (F.array_min(pipes) >= 1) & (F.array_min(pipes) == F.array_max(pipes))


LIST_ITEM = r"(?U)^(\s*)((?:[-+*•])|(?:\d{1,3}[.)])|(?:[A-Za-z][.)]))\s+(.*)$"


def is_list(lines: Column) -> Column:
    items = F.size(F.filter(lines, lambda x: x.rlike(LIST_ITEM)))
    return items >= F.greatest(F.lit(1), F.floor(F.size(lines) / 2))
