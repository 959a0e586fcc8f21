"""Packing token streams into fixed-length training sequences, balanced by cost.

A piece of n tokens costs ``LINEAR * n + QUADRATIC * n**2`` (attention stays within a piece).  Documents
longer than a sequence give full pieces first.  What is left is placed in descending length, each to the
sequence of least cost that still has room; only a piece that fits nowhere whole is cut, and fills the
room there is, least cost first.  A block opens just as many sequences as its tokens need, so a block
wastes less than one sequence.  Blocks are runs of documents within an input partition: nothing is
shuffled, a task holds one block, and a lost task packs the same blocks again.

Tokenizing works on the distinct words of a run of texts: pieces between white space never share a token.
Those of Latin letters are split and merged together in numpy by the merges that the vocabulary file states;
the tokenizer itself codes all others, and a cache of few megabytes keeps those.

Defined cases: null and empty texts are the closing id alone; repeated rows are packed as documents of
their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import releasing
from pageloom.llm.textops import Piece, pieces, repeat_ranges

SEQUENCE = 4096
CLOSING_ID = 2
#: Sequences a block fills, about.
BLOCK_SEQUENCES = 256
#: Cost of a token by itself and with each other token of its piece: an attention layer's share at this width.
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

#: Words that only the tokenizer itself splits, kept per worker: at most so many, and bytes of them.
CACHE_WORDS, CACHE_BYTES = 100_000, 4 << 20

#: Bytes of texts whose distinct words are coded together.
WORDS_BYTES = 2 << 20
#: Bytes beyond which a word goes through the tokenizer: all words take as many rounds here as the longest.
LONG_WORD = 96

_NO_RANK = np.int64(1) << 62


class Merges:
    """The vocabulary's merges as arrays: byte symbols, and an open hash table from a pair to its rank and result."""

    def __init__(self, model: dict):
        vocab = model["vocab"]
        # The byte alphabet of byte-level vocabularies: printable Latin-1 stands for itself, the rest from 256 on.
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in set(own)]
        signs = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(others)}
        self.inner = np.array([vocab.get(signs[b], -1) for b in range(256)], np.int64)
        self.final = np.array([vocab.get(signs[b] + "</w>", -1) for b in range(256)], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[x] << 32 | vocab[y] for x, y in pairs], np.int64)
        self.result = np.array([vocab[x + y] for x, y in pairs], np.int64)
        self.mask = (1 << (8 * len(pairs)).bit_length()) - 1
        self.key, self.rank = np.full(self.mask + 1, -1, np.int64), np.full(self.mask + 1, _NO_RANK, np.int64)
        left = np.arange(len(keys))
        at = self._slot(keys)
        while len(left):
            free = self.key[at[left]] < 0
            self.key[at[left[free]]] = keys[left[free]]
            taken = self.key[at[left]] == keys[left]
            self.rank[at[left[taken]]] = left[taken]
            left = left[~taken]
            at[left] = (at[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(40)).astype(np.int64) & self.mask

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = self._slot(keys)
        found, out = self.key[at], self.rank[at]
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            found[open_], out[open_] = self.key[at[open_]], self.rank[at[open_]]
            open_ = open_[(found[open_] != keys[open_]) & (found[open_] >= 0)]
        return np.where(found == keys, out, _NO_RANK)

    def merged(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all parts end to end and their sizes, after all merges: in every part, the leftmost pair of the
        least rank first."""
        out_part: list[np.ndarray] = []
        out_symbol: list[np.ndarray] = []
        part = np.repeat(np.arange(len(sizes)), sizes)
        rank = np.full(len(symbols), _NO_RANK, np.int64)
        if len(symbols) > 1:
            inside = np.flatnonzero(part[1:] == part[:-1])
            rank[inside] = self.ranks(symbols[inside], symbols[inside + 1])
        while len(symbols):
            start = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            least = np.minimum.reduceat(rank, start)
            live = least < _NO_RANK
            if not live.all():
                size = np.diff(np.append(start, len(part)))
                kept = np.repeat(live, size)
                out_part.append(part[~kept])
                out_symbol.append(symbols[~kept])
                part, symbols, rank = part[kept], symbols[kept], rank[kept]
                least, size = least[live], size[live]
                start = np.cumsum(size) - size
                if not len(symbols):
                    break
            else:
                size = np.diff(np.append(start, len(part)))
            hits = np.flatnonzero(rank == np.repeat(least, size))
            hits = hits[np.concatenate([[True], part[hits[1:]] != part[hits[:-1]]])]
            symbols[hits] = self.result[least]
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            moved = hits - np.arange(len(hits))
            part, symbols, rank = part[keep], symbols[keep], rank[keep]
            for left in (moved[moved > 0] - 1, moved[moved < len(symbols) - 1]):
                same = part[left] == part[left + 1]
                rank[left[same]] = self.ranks(symbols[left[same]], symbols[left[same] + 1])
            last = moved[(moved == len(symbols) - 1) | (part[np.minimum(moved + 1, len(part) - 1)] != part[moved])]
            rank[last] = _NO_RANK
        parts = np.concatenate(out_part) if out_part else np.zeros(0, np.int64)
        found = np.concatenate(out_symbol) if out_symbol else np.zeros(0, np.int64)
        order = np.argsort(parts, kind="stable")
        return found[order], np.bincount(parts, minlength=len(sizes))


#: Classes of the bytes of plain words: letters, digits, marks; 0 sends a word to the tokenizer itself (an
#: apostrophe may open a contraction, a < a special token, other bytes need its normal forms).
_LETTER, _DIGIT, _MARK = 1, 2, 3
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = _MARK
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[[0x27, 0x3C]] = 0


class WordEncoder:
    """Ids of whole texts from ids of their distinct words.

    Words of ASCII and Latin-1 letters are split by byte classes and merged all at once (``Merges``); others go
    through the tokenizer.  A vocabulary file of another build than this one goes through the tokenizer throughout.
    """

    #: What the file must state for the split by byte classes to be its own.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        self._path, self._tokenizer = path, None
        self._others: dict[bytes, np.ndarray] = {}
        self._held = 0
        with open(path, encoding="utf-8") as f:
            stated = json.load(f)
        steps = [n.get("type") for n in (stated.get("normalizer") or {}).get("normalizers", [])]
        split = (stated.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        model = stated["model"]
        plain = steps == ["NFC", "Replace", "Lowercase"] and split == self.PATTERN and model.get("end_of_word_suffix") == "</w>"
        plain = plain and all(t["content"].startswith("<") for t in stated.get("added_tokens", []))
        self._merges = Merges(model) if plain else None

    def _by_tokenizer(self, words: list[bytes]) -> list[np.ndarray]:
        if self._tokenizer is None:
            # Many corpora never need it.
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(self._path)
            self._tokenizer.no_truncation()
        known = self._others
        fresh = list(dict.fromkeys(w for w in words if w not in known))
        coded = self._tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in fresh], add_special_tokens=False)
        new = {w: np.array(e.ids, np.int64) for w, e in zip(fresh, coded, strict=True)}
        found = [known[w] if w in known else new[w] for w in words]
        self._held += sum(len(w) + 8 * len(i) for w, i in new.items())
        known.update(new)
        if len(known) > CACHE_WORDS or self._held > CACHE_BYTES:
            self._others, self._held = {}, 0
        return found

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at starts .. ends, end to end, and how many each has."""
        n, length = len(starts), ends - starts
        text = data[repeat_ranges(starts, length)]
        at = np.cumsum(length) - length
        if self._merges is None:
            plain = np.zeros(n, bool)
        else:
            text, kind = text.copy(), _CLASS[text]
            # Two bytes C3 80 .. C3 BF are a Latin letter, but for C3 97 and C3 B7; C3 80 .. C3 9E are capitals.
            lead = np.flatnonzero(text[:-1] == 0xC3)
            follow = text[lead + 1]
            letter = (follow >= 0x80) & (follow <= 0xBF) & (follow != 0x97) & (follow != 0xB7)
            lead = lead[letter]
            kind[lead] = kind[lead + 1] = _LETTER
            capital = lead[(text[lead + 1] < 0x9F)]
            text[capital + 1] += 0x20
            text[(text >= 65) & (text <= 90)] += 32
            plain = (np.minimum.reduceat(kind, at) > 0) & (length <= LONG_WORD) if n else np.zeros(0, bool)
        sizes = np.zeros(n, np.int64)
        ids = np.zeros(0, np.int64)
        if plain.any():
            chosen = np.repeat(plain, length)
            text, kind, word = text[chosen], kind[chosen], np.repeat(np.flatnonzero(plain), length[plain])
            # A part begins with a word, at a change of class, and at every digit.
            begins = np.concatenate([[True], (word[1:] != word[:-1]) | (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)])
            first = np.flatnonzero(begins)
            part_sizes = np.diff(np.append(first, len(text)))
            symbols = self._merges.inner[text]
            final = first + part_sizes - 1
            symbols[final] = self._merges.final[text[final]]
            ids, counts = self._merges.merged(symbols, part_sizes)
            sizes += np.bincount(word[first], counts, n).astype(np.int64)
        rest = np.flatnonzero(~plain)
        if len(rest):
            raw = data.tobytes() if len(rest) > 1000 else None
            found = self._by_tokenizer([raw[a:b] if raw is not None else data[a:b].tobytes() for a, b in zip(starts[rest].tolist(), ends[rest].tolist(), strict=True)])
            sizes[rest] = [len(f) for f in found]
            whole = np.empty(int(sizes.sum()), np.int64)
            own = np.repeat(plain, sizes)
            whole[own] = ids
            whole[~own] = np.concatenate(found)
            ids = whole
        return ids, sizes

    def encode(self, piece: Piece) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the piece's documents end to end, and where each document starts."""
        starts, ends = piece.words
        codes, distinct = pd.factorize(piece.word_hashes())
        first = np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1) > 0)
        ids, sizes = self.words(piece.data, starts[first], ends[first])
        at = np.cumsum(sizes) - sizes
        length = sizes[codes]
        before = np.concatenate([[0], np.cumsum(length)])
        return ids[repeat_ranges(at[codes], length)], before[piece.word_bounds]


_encoders: dict[str, WordEncoder] = {}


def cost(tokens: np.ndarray | float) -> np.ndarray | float:
    return LINEAR * tokens + QUADRATIC * tokens * tokens


def pack_block(lengths: np.ndarray, sequence: int = SEQUENCE) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Pieces (document, start, length, sequence, offset) of a block, and how many sequences it has."""
    placed: list[tuple[int, int, int, int, int]] = []
    full, rest = np.divmod(lengths, sequence)
    used = 0
    for d in np.flatnonzero(full).tolist():
        for k in range(int(full[d])):
            placed.append((d, k * sequence, sequence, used, 0))
            used += 1
    open_count = int(-(-int(rest.sum()) // sequence))
    room = np.full(open_count, sequence, np.int64)
    load = np.zeros(open_count)

    def put(d: int, start: int, n: int, s: int) -> None:
        placed.append((d, start, n, used + s, sequence - int(room[s])))
        room[s] -= n
        load[s] += cost(float(n))

    for d in np.argsort(-rest, kind="stable").tolist():
        n, start = int(rest[d]), int(full[d]) * sequence
        if not n:
            break
        fits = room >= n
        if fits.any():
            put(d, start, n, int(np.argmin(np.where(fits, load, np.inf))))
            continue
        while n:
            s = int(np.argmin(np.where(room > 0, load, np.inf)))
            part = min(n, int(room[s]))
            put(d, start, part, s)
            start, n = start + part, n - part
    return placed, used + open_count


def pack(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, closing_id: int = CLOSING_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.setdefault(tokenizer_path, None) or WordEncoder(tokenizer_path)
        _encoders[tokenizer_path] = encoder
        base = TaskContext.get().partitionId() << 33
        names: list[int | None] = []
        tokens: list[np.ndarray] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal base, held, names, tokens
            if not names:
                return
            placed, used = pack_block(np.array([len(t) for t in tokens], np.int64), sequence)
            d, start, length, seq, offset = (list(c) for c in zip(*placed, strict=True))
            ids = [tokens[i][s : s + n].tobytes() for i, s, n in zip(d, start, length, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([names[i] for i in d], pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()),
                    pa.array([len(tokens[i]) for i in d], pa.int64()), pa.array(np.array(seq, np.int64) + base), pa.array(offset, pa.int64()),
                ],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )
            base += used
            names, tokens, held = [], [], 0

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for piece in pieces(batch.column(1), WORDS_BYTES):
                ids, at = encoder.encode(piece)
                for k in range(piece.rows):
                    own = np.empty(at[k + 1] - at[k] + 1, "<u4")
                    own[:-1] = ids[at[k] : at[k + 1]]
                    own[-1] = closing_id
                    names.append(doc_ids[piece.first_row + k])
                    tokens.append(own)
                    held += len(own)
                    if held >= BLOCK_SEQUENCES * sequence:
                        yield from flush()
        yield from flush()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(releasing(run), SCHEMA)
