"""Secret scans: stated patterns, and sliding-window Shannon entropy over candidate strings.

Candidate strings are the runs of at least ``WINDOW`` key characters.  A window of fixed width moves over
each, one count goes up and one down a step, and the entropy follows from the change of two terms.  Windows
at or over the threshold of the class that their own characters are of join into spans.  A span is
suppressed when its text matches the allow-list (placeholders, repeated or counting characters); of the
others the parts outside pattern spans stay.  Redacting takes the whole token that such a part is in.

A numpy pass over the bytes finds the documents that hold a candidate run or a keyword; only those are
decoded and matched, which changes no result, since every pattern needs one of the two.

Defined cases: null text is empty and has no spans; repeated rows are scanned each; positions are code
points, end exclusive; an empty table gives an empty result; other columns are ignored (``redact`` keeps
them as they are).
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.textops import Piece, pieces

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "entropy")

_ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]+=*|=+")
_KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")

MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24

WINDOW = 20
#: Character class of a window, and the entropy in bits a character at which it counts: of 20,000 random
#: windows each, 3.0 % of hex, 0.9 % of one letter case with digits, 1.4 % of two-case letters and under 3 % of
#: one-case letters are below.
CLASSES = (
    ("hex", re.compile(r"(?=.*[0-9])[0-9a-fA-F]+"), 3.0),
    ("mixed", re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9+/_=-]+"), 3.4),
    ("letters", re.compile(r"(?=.*[a-z])(?=.*[A-Z].*[A-Z].*[A-Z].*[A-Z])[A-Za-z+/_=-]+"), 3.6),
    ("one case", re.compile(r"[a-z]+|[A-Z]+"), 3.3),
)
LEAST_BITS = min(bits for _, _, bits in CLASSES)
#: Texts that are placeholders rather than keys.
ALLOWED = (
    r"(?i)example|placeholder|changeme|dummy|x{6,}|\*{4,}",
    r"^(.)\1*$",
    r"(?i)0123456789|abcdefghij",
)

SCHEMA = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"

_RUN_BYTE = np.zeros(256, bool)
_RUN_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_=-"]] = True
_PLOGP = [0.0, *(c * math.log2(c) for c in range(1, WINDOW + 1))]


def window_entropies(text: str, width: int = WINDOW) -> Iterator[tuple[int, float]]:
    """(start, bits a character) of every window of the text, from incremental counts."""
    counts: dict[str, int] = {}
    total = 0.0
    for i, c in enumerate(text):
        n = counts.get(c, 0)
        total += _PLOGP[n + 1] - _PLOGP[n]
        counts[c] = n + 1
        if i >= width - 1:
            yield i - width + 1, math.log2(width) - total / width
            out = text[i - width + 1]
            n = counts[out]
            total += _PLOGP[n - 1] - _PLOGP[n]
            counts[out] = n - 1


def entropy_spans(text: str, allowed: list[re.Pattern]) -> list[tuple[int, int]]:
    spans = []
    for m in _RUN.finditer(text):
        run = m[0]
        first = last = -1
        found = []
        for start, bits in window_entropies(run):
            if bits < LEAST_BITS or bits < next((b for _, pattern, b in CLASSES if pattern.fullmatch(run, start, start + WINDOW)), math.inf):
                continue
            if first < 0 or start > last:
                if first >= 0:
                    found.append((first, last))
                first = start
            last = start + WINDOW
        if first >= 0:
            found.append((first, last))
        spans += [(m.start() + a, m.start() + b) for a, b in found if not any(p.search(run[a:b]) for p in allowed)]
    return spans


def outside(start: int, end: int, covers: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts of a span that sorted covers leave."""
    parts = []
    for a, b in covers:
        if a < end and start < b:
            if start < a:
                parts.append((start, a))
            start = max(start, b)
    return [*parts, (start, end)] if start < end else parts


def find_spans(text: str, allowed: list[re.Pattern]) -> list[tuple[str, int, int]]:
    """All spans of one text by start, then kind in the order of KINDS."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [("hex", *m.span()) for m in _HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    base = sorted((a, b) for _, a, b in found)
    found += [("entropy", *part) for a, b in entropy_spans(text, allowed) for part in outside(a, b, base)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def suspects(piece: Piece) -> np.ndarray:
    """Documents of the piece with a long run of key characters or a keyword."""
    data, offsets = piece.data, piece.offsets
    stops = np.unique(np.concatenate([[-1], np.flatnonzero(~_RUN_BYTE[data]), [len(data)]]))
    long = np.flatnonzero(np.diff(stops) > WINDOW)
    at = [stops[long] + 1]
    # A run that crosses documents is listed for each of them: too many suspects do no harm.
    at.append(stops[long + 1] - 1)
    lower = data.tobytes().lower()
    for word in _KEYWORDS:
        hits, k = [], lower.find(word)
        while k >= 0:
            hits.append(k)
            k = lower.find(word, k + 1)
        at.append(np.array(hits, np.int64))
    docs = np.searchsorted(offsets, np.concatenate(at), "right") - 1
    if len(long):
        inner = [np.arange(a, b + 1) for a, b in zip(*(np.searchsorted(offsets, x, "right") - 1 for x in at[:2]), strict=True)]
        docs = np.concatenate([docs, *inner])
    return np.unique(docs[(docs >= 0) & (docs < piece.rows)])


def spans_of(column: pa.Array, allowed: list[re.Pattern]) -> dict[int, list[tuple[str, int, int]]]:
    """Row number -> spans, for the rows of a text column that have any."""
    found = {}
    for piece in pieces(column):
        for k in suspects(piece).tolist():
            text = piece.data[piece.offsets[k] : piece.offsets[k + 1]].tobytes().decode("utf-8", "replace")
            if spans := find_spans(text, allowed):
                found[piece.first_row + k] = spans
    return found


def scan(docs: DataFrame, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """doc_id and its spans: array of (kind, start, end)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [re.compile(p) for p in allowed]
        item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            found = spans_of(batch.column(1), patterns)
            counts = np.zeros(batch.num_rows + 1, np.int32)
            for k, spans in found.items():
                counts[k + 1] = len(spans)
            flat = [{"kind": s[0], "start": s[1], "end": s[2]} for k in sorted(found) for s in found[k]]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(counts, dtype=np.int32)), pa.array(flat, item))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def widened(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The spans, those of entropy grown to their whole token: key characters, up to a ``=`` before and with those after."""
    tokens = [m.span() for m in _TOKEN.finditer(text)] if any(kind == "entropy" for kind, _, _ in spans) else []
    starts = [a for a, _ in tokens]
    out = []
    for kind, a, b in spans:
        if kind == "entropy":
            a = min(a, starts[max(bisect_right(starts, a) - 1, 0)])
            b = max(b, tokens[max(bisect_right(starts, b - 1) - 1, 0)][1])
        out.append((kind, a, b))
    return out


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    edges: list[list[int]] = []
    for _, a, b in sorted(spans, key=lambda s: s[1]):
        if edges and a <= edges[-1][1]:
            edges[-1][1] = max(edges[-1][1], b)
        else:
            edges.append([a, b])
    cuts = [0, *(x for e in edges for x in e), len(text)]
    return mark.join(text[a:b] for a, b in list(pairwise(cuts))[::2])


def redact(docs: DataFrame, mark: str = "[SECRET]", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """The same rows and columns, with every span of ``text`` replaced by ``mark``."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [re.compile(p) for p in allowed]
        for batch in batches:
            column = batch.column(at)
            found = spans_of(column, patterns)
            if found:
                texts = column.to_pylist()
                for k, spans in found.items():
                    texts[k] = redacted(texts[k], widened(texts[k], spans), mark)
                column = pa.array(texts, column.type)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], column, *batch.columns[at + 1 :]], schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
