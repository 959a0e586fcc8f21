"""Functions that need a word list or Unicode composition: Arrow-batched, and skipped where they change nothing."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pageloom.functions import fixed, text as t


@F.pandas_udf(StringType())
def _nfc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFC", v))


def nfc(x: Column) -> Column:
    """Canonical composition; ASCII rows never leave the JVM's result."""
    return F.when(x.rlike(r"[^\x00-\x7F]"), _nfc(x)).otherwise(x)


def repair_characters(x: Column) -> Column:
    return nfc(t.repair_characters(x))


class Lexicon:
    """A table of word forms: every listed word by itself, possessive, and with each regular ending (a final e may go)."""

    def __init__(self, words: Iterable[str] = fixed.LEXICON):
        self.words = frozenset(w.lower() for w in words)
        stems = {(w, w) for w in self.words} | {(w[:-1], w) for w in self.words if w.endswith("e")}
        endings = {stem + ending for stem, _ in stems for ending in fixed.SUFFIXES if len(stem) > 2}
        self.forms = self.words | endings | {w + "’s" for w in self.words}
        self._parts = self.words | _STOP

    def knows(self, word: str) -> bool:
        low = word.lower()
        return low in self.forms or ("-" in low and self._parts.issuperset(low.split("-")))

    def _cuts(self, low: str) -> Iterator[tuple[tuple[int, int, int, int], tuple[str, ...]]]:
        """All cuts into stopwords and one known word, two letters or more each, with their rank: the earliest first
        cut wins; at the same cut, a stopword and the rest, then three parts by their second cut, then a known word
        before a stopword."""
        n = len(low)
        for i in range(2, n - 1):
            head, tail = low[:i], low[i:]
            if head in _STOP and self.knows(tail):
                yield (i, 0, 0, 0), (head, tail)
            if tail in _STOP and self.knows(head):
                yield (i, 2, 0, 0), (head, tail)
            for j in range(i + 2, n - 1) if head in _STOP else ():
                middle, end = low[i:j], low[j:]
                if middle in _STOP and self.knows(end):
                    yield (i, 1, j, 0), (head, middle, end)
                if end in _STOP and self.knows(middle):
                    yield (i, 1, j, 1), (head, middle, end)

    def split(self, token: str) -> str:
        """A glued token of 7 to 22 letters as a known word with one or two stopwords around or before it."""
        if not (7 <= len(token) <= 22 and token.isalpha()) or self.knows(token):
            return token
        best = min(self._cuts(token.lower()), default=None)
        if best is None:
            return token
        first, *others = best[1]
        if token.istitle():
            return " ".join([first.capitalize(), *(w if w in fixed.SMALL_TITLE_WORDS else w.capitalize() for w in others)])
        whole = " ".join(best[1])
        return whole.upper() if token.isupper() else whole

    def join_words(self, text: str) -> str:
        """Words that a line end or a scan broke apart, joined where the whole is known, until nothing changes."""

        def whole(between: str):
            return lambda m: m[1] + m[2] if self.knows(m[1] + m[2]) else (m[0] if between == " " else m[1] + between + m[2])

        text, before = _HYPHENED.sub(whole("-"), text), None
        while text != before:
            text, before = _PAIR.sub(whole(" "), text), text
        return text


_STOP = frozenset(fixed.NORMALIZER_STOPWORDS)
_HYPHENED, _PAIR = re.compile(fixed.HYPHENED_WORDS), re.compile(fixed.WORD_PAIR)


@lru_cache(maxsize=4)
def _lexicon(words: tuple[str, ...]) -> Lexicon:
    return Lexicon(words)


def join_words(x: Column, words: tuple[str, ...] = fixed.LEXICON) -> Column:
    """Word joins over a bounded word list; rows without two neighbouring words stay in the JVM."""

    @F.pandas_udf(StringType())
    def run(values: pd.Series) -> pd.Series:
        known = _lexicon(words)
        return values.map(lambda v: None if v is None else known.join_words(v))

    return F.when(x.rlike(r"[A-Za-z]{2,}-?\s+[A-Za-z]{2,}"), run(x)).otherwise(x)


def repair_spacing(x: Column, words: tuple[str, ...] = fixed.LEXICON) -> Column:
    return t.repair_spacing(join_words(x, words))


def split_glued(x: Column, words: tuple[str, ...]) -> Column:
    @F.pandas_udf(StringType())
    def run(values: pd.Series) -> pd.Series:
        known = _lexicon(words)
        return values.map(lambda v: None if v is None else known.split(v))

    return F.when(x.rlike(r"^\p{L}{7,22}$"), run(x)).otherwise(x)


_ADDRESSES = tuple((re.compile(p), to) for p, to in fixed.ADDRESS_REPAIRS)
_SPACING = tuple((re.compile(p), to) for p, to in fixed.SPACING_REPAIRS)
#: Where two fragments meet: a word broken by a hyphen, or an address that goes on.
_BROKEN = re.compile(r"([A-Za-z]*)-\n([A-Za-z]*)")
_WITHIN = re.compile(f"{fixed.ADDRESS_END.removesuffix('$')}\\n(?={fixed.ADDRESS_START})")


def _replaced(text: str, steps) -> str:
    for pattern, to in steps:
        text = pattern.sub(to, text)
    return text


def urls_of(text: str) -> str:
    return _replaced(text, _ADDRESSES)


def spacing_of(text: str, known: Lexicon) -> str:
    """``repair_spacing`` for one string, for folds over a document's blocks."""
    return urls_of(_replaced(known.join_words(text), _SPACING).strip())


def joined(left: str, right: str, known: Lexicon) -> str:
    """Two fragments as one: across a hyphen, within an address, or with a blank between."""
    if "" in (left, right):
        return left + right
    seam = f"{left.rstrip()}\n{right.lstrip()}"
    if (m := _BROKEN.search(seam)) is not None:
        mark = "" if m[1] and m[2] and known.knows(m[1] + m[2]) else "-"
        return seam[: m.end(1)] + mark + seam[m.start(2) :]
    return seam.replace("\n", "" if _WITHIN.search(seam) else " ")
