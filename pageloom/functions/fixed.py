"""Lists, marks and limits that results depend on."""

# --- fixed values: character repair, in order of application (code points) ---
CHARACTER_REPAIRS = (
    ("﻿", ""),
    (" ", " "),
    ("â€™", "’"),
    ("â€˜", "‘"),
    ("â€œ", "“"),
    ("â€\u009d", "”"),
    ("â€“", "–"),
    ("â€”", "—"),
    ("â€¦", "…"),
    ("â€", '"'),
    ("ﬁ", "fi"),
    ("ﬂ", "fl"),
    ("ﬀ", "ff"),
    ("ﬃ", "ffi"),
    ("ﬄ", "ffl"),
)

# --- fixed values: headings ---
MAJOR_PREFIXES = (
    "chapter ", "book ", "part ", "contents", "preface", "foreword", "introduction", "conclusion", "appendix", "epilogue",
    "prologue", "timeline", "about the author", "acknowledgments", "acknowledgements", "important notes", "notes on this book",
    "roadmap stages",
)
BYLINE_PREFIXES = ("by ", "foreword by ", "visuals by ", "translated by ", "edited by ")
POINTING_PREFIXES = ("this ", "that ", "these ", "those ", "it ")
SMALL_TITLE_WORDS = (
    "a", "an", "and", "as", "at", "but", "by", "for", "from", "if", "in", "nor", "of", "on", "or", "per", "the", "to", "vs.", "via", "with",
)
BACK_MATTER = ("index", "sources", "references", "bibliography", "works cited")
MATTER_TITLES = (
    "preface", "foreword", "introduction", "conclusion", "acknowledgments", "acknowledgements", "illustration credits", "index",
    "about the author", "sources", "references", "bibliography",
)

# --- fixed values: words of the spelling repair ---
LEXICON = (
    "bitcoin", "cyberspace", "epinions", "linkedin", "naval", "neuralink", "palantir", "paypal", "spacex", "startupboy", "substack",
    "tesla", "twitter", "youtube", "isbn", "roadmap", "microprocessing", "incerto", "angelist",
)
SUFFIXES = ("s", "es", "ed", "ing", "ly", "er", "ers", "est", "ness", "ment")
NORMALIZER_STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "been", "being", "but", "by", "can", "did", "do", "does", "for", "from", "had", "has",
    "have", "he", "her", "hers", "him", "his", "i", "if", "in", "into", "is", "it", "its", "me", "more", "my", "no", "not", "of", "on",
    "one", "or", "our", "out", "she", "so", "than", "that", "the", "their", "them", "there", "they", "this", "those", "through", "to",
    "up", "us", "was", "we", "were", "what", "when", "which", "who", "why", "will", "with", "you", "your",
)
GROUNDING_STOPWORDS = (
    "a", "an", "and", "are", "as", "at", "be", "because", "by", "for", "from", "how", "if", "in", "into", "is", "it", "its", "more",
    "not", "of", "on", "or", "so", "than", "that", "the", "their", "them", "then", "there", "these", "they", "this", "to", "through",
    "was", "we", "what", "when", "which", "with", "you",
)

# --- fixed values: patterns of the spacing and address repairs, in order of application (groups are written as in Python) ---
SPACING_REPAIRS = (
    (r"(?<=[A-Za-z])\.(?=[A-Z])", ". "),
    (r"\bU\.\s*S\.\b", "U.S."),
    (r"\b([A-Z]\.[A-Z]\.)(?=[A-Za-z])", r"\1 "),
    (r"(?<=\d)(?=[A-Za-z]{3,})", " "),
    (r"\s+([,.;:?!])", r"\1"),
    (r"([(\[“‘])\s+", r"\1"),
    (r"\s{2,}", " "),
)
ADDRESS_REPAIRS = (
    (r"(?i)(https?://)\s+", r"\1"),
    (r"(https?://\S+)\s+([A-Za-z0-9/_#?=&%-])", r"\1\2"),
    (r"(www\.\S+)\s+([A-Za-z0-9/_#?=&%-])", r"\1\2"),
    (r"((?:https?://|www\.)[A-Za-z0-9.-]+)\.\s+([A-Za-z]{2,6}\b)", r"\1.\2"),
    (r"((?:https?://|www\.)[^\s]+/)\s+([A-Za-z0-9])", r"\1\2"),
)
ADDRESS_END = r"(?i)(?:https?://|www\.|\w+\.)[\w./?&=#:%+-]*$"
ADDRESS_START = r"[A-Za-z0-9/_#?=&%-]"
HYPHENED_WORDS = r"\b([A-Za-z]{2,})-\s+([A-Za-z]{2,})\b"
WORD_PAIR = r"\b([A-Za-z]{2,14})\s+([A-Za-z]{2,14})\b"

# --- fixed values: section kinds ---
PRIORITY = {"core_argument": 5, "case_study": 4, "mixed": 3, "framing": 2, "reference": 1, "endmatter": 1}
DOCUMENTARY = ("reference", "endmatter")
REFERENCE_TITLES = ("sources", "references", "bibliography", "recommended reading", "reading list")
ENDMATTER_TITLES = ("about the author", "acknowledgments", "acknowledgements", "appreciation", "want more", "bonus")
SUPPLEMENTAL_TITLES = (*REFERENCE_TITLES, *ENDMATTER_TITLES, "timeline", "timeline of", "69 core musk methods")
REFERENCE_WORDS = (
    "bibliography", "references", "sources", "citations", "works cited", "further reading", "endnotes", "footnotes", "recommended reading",
    "reading list",
)
ENDMATTER_WORDS = ("index", "acknowledg", "about the author", "credits", "copyright", "timeline", "appreciation", "want more", "bonus")
FRAMING_WORDS = (
    "contents", "preface", "foreword", "introduction", "prologue", "epilogue", "conclusion", "notes on this book", "welcome", "highlights",
)
PRINCIPLE_WORDS = ("principle", "strategy", "framework", "lesson", "method", "why ", "how ", "should ")
KIND_WINDOW = 3000
YEAR = r"\b(?:18|19|20)\d{2}\b"

GUIDANCE = {
    5: "High-detail material. Preserve the chapter's core claims, methods, pivots, and representative examples with generous space in the final summary.",
    4: "Detailed coverage. Keep the main argument or chronology specific enough that a serious reader could reconstruct the chapter's distinctive contribution.",
    3: "Moderate coverage. Preserve the chapter's distinct role and strongest examples, but do not expand every subsection equally.",
    "documentary": "Compressed coverage. Summarize this material honestly as supporting or documentary matter.",
    "other": "Light coverage. Preserve only the role this material plays in setting up or closing the book.",
}

# --- fixed values: sentences of every map and map review ---
OVERALL_GUIDANCE = (
    "Give the most space to chapters or packets with priority 4-5; compress priority 1-2 material unless it frames the thesis.",
    "Treat reference and endmatter sections as documentation, not as core argumentative chapters.",
    "Use framing sections to explain the book's setup and transitions, but do not let them crowd out the main argument.",
    "Aim for a substantial study-guide summary, not jacket-copy brevity: core chapters should carry enough detail to reconstruct the book's real argument and examples.",
)
REVIEW_INTRODUCTION = "These are pre-summary heuristics to review before completing chunk prompts."
REVIEW_NONE = "No map review warnings were detected."
REVIEW_GUIDANCE = (
    "Use these warnings as workflow guidance, not as evidence about the book itself.",
    "If a packet mixes core material with supplemental sections, give the core material the space and compress the supplemental sections aggressively.",
)

# --- fixed values: audit ---
AUDIT_SUPPLEMENTAL = ("sources", "recommended reading", "reading", "timeline", "about the author", "want more", "appreciation", "bonus")
EVALUATIVE = ("brilliant", "visionary", "genius", "remarkable", "inspiring", "iconic", "legendary", "masterful", "extraordinary", "amazing")
BOOK_FORMS = ("compilation", "compiled", "curated", "manual", "guide", "edited", "public words", "public statements")
# Warnings of the map review and the audit; those that begin with a colon follow a name.
AUDIT_SENTENCES = {
    "packet_mixes": ": packet mixes likely supplemental/endmatter sections with core chapter material; consider splitting earlier",
    "packet_mixed": ": packet is still classified as mixed at priority ",
    "packet_mixed_end": "; review weighting before summarizing",
    "chapter_mixed": ": chapter remains mixed in the map; summaries may need extra proportion judgment",
    "chapter_documentary": ": chapter is classified as documentary despite high priority; review upstream packet splitting or weighting",
    "chunk_long": "reference/endmatter chunk summary looks too long for its priority",
    "chunk_short": "high-priority chunk summary looks too short for its weighting",
    "chunk_points_few": "high-priority chunk should usually preserve at least three main points",
    "chunk_no_claims": "core-argument chunk is missing primary_claims",
    "chunk_no_methods": "core-argument chunk is missing methods_or_principles",
    "chunk_no_events": "case-study chunk is missing story_events",
    "chunk_points_many": "reference/endmatter chunk preserves too many points for compressed material",
    "chunk_no_sections": "chunk output is missing covered_sections content",
    "chapter_long": "reference/endmatter chapter summary looks too long for its priority",
    "chapter_short": "high-priority chapter summary looks too short for its weighting",
    "chapter_points_few": "high-priority chapter should usually preserve at least three major points",
    "chapter_no_story": "case-study chapter is missing story_progression",
    "chapter_no_methods": "core-argument chapter is missing methods_or_principles",
    "chapter_points_many": "reference/endmatter chapter preserves too many major points for compressed material",
    "chapter_no_cues": "chapter output is missing what_to_preserve_in_final guidance",
    "final_summary_brief": "executive_summary looks too brief for a publication-quality book synthesis",
    "final_structure_brief": "structural_overview should more clearly explain how the book is organized",
    "final_themes_thin": "major_themes looks too thin; preserve more of the book's recurring ideas",
    "final_examples_thin": "notable_examples looks too thin; preserve more representative episodes or examples",
    "final_takeaways_thin": "practical_takeaways looks too thin for a substantial final summary",
    "final_evaluative": "final summary contains evaluative language that may drift into admiration or critique",
    "final_form": "executive_summary should identify what kind of book this is when the source material does so",
    "final_uncertainty": "final faithfulness_notes should acknowledge chapter-level ambiguity or OCR uncertainty",
    "final_chapter_count": "final summary chapter count does not match the chapter profiles in the book map",
    "chapter_missing": "final summary is missing chapter coverage for ",
    "chapter_over_expanded": ": low-priority chapter summary looks over-expanded in the final synthesis",
    "chapter_compressed": ": high-priority chapter summary looks too compressed in the final synthesis",
    "chapter_ungrounded": ": final chapter summary may not be grounded in the chapter-stage evidence",
    "chapter_cues_lost": ": final synthesis may be under-preserving key chapter material (",
    "chapter_cues_none": ": none of the chapter preservation cues appear in the final synthesis",
    "chapter_unexpected": "final summary includes an unexpected chapter title: ",
    "example_ungrounded": "final notable example may not be grounded in chapter examples: ",
    "count_mismatch": " output count mismatch: expected ",
    "legacy_count": " outputs still use the legacy schema and are being auto-enriched",
    "prepared_count": "final summary chapter count does not match prepared chapter count",
    "final_missing": "final output is missing",
    "verify_missing": "verify output is missing",
    "verify_unchanged": "verify output lists issues but leaves the final summary unchanged",
}
UNCERTAINTY = ("ocr", "unclear", "ambigu", "truncat", "damaged", "noisy", "illegible", "run together")

# --- fixed values: packet sizes of the profiles (target, max, verify) ---
PROFILES = {"cheap": (5000, 7000, False), "compromise": (6500, 8500, True), "quality": (5000, 7000, True)}
