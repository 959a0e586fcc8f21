"""The first byte of every word of a text, coded bit by bit by logistic mixing of hashed contexts that cross words.

A lead is the first LEAD bytes of a word and its closing space, or fewer if the space comes before; the end of a text is
the space alone.  Every bit's probability mixes, in the logistic domain,

* hashed contexts of the last 2, 3, 4 and 6 bytes of the text, which are the space before the word (the last byte
  alone tells nothing) and the end of the word before;
* the bytes of the word so far, which stand alone for no context;
* the whole word before with the bytes of the word so far.

All are counted over the training texts, bit after bit, every occurrence.  What a lead costs depends on the word before and
on the lead, so equal pairs of a run of texts are walked together, with their number, and so are bits with all of
the context in common.  The mixing weights are gated by how often the word before and the last four bytes were seen
and by whether the word before has been certain; they are learned online over all training texts, a bit's own occurrence
taken out of every count.  An adaptive map refines the mix (``lm_words.Mixer``).  Tables have a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd

from pageloom.llm.lm_words import GATES, Code, Mixer, bucket, context_slots, order_keys, stretch, without_one
from pageloom.llm.textops import Piece, mix64

LEAD = 1
#: Pairs of a lead and a word before that are predicted together.
AT_ONCE = 1 << 15
#: Orders in bytes, and the bits of their tables, of that of the bytes so far, and of that of the word before.
ORDERS = (2, 3, 4, 6)
BITS = [14, 17, 18, 19, 10, 20]
STARTS = np.concatenate([[0], np.cumsum([1 << b for b in BITS])]).astype(np.int64)
TOTAL, INPUTS = int(STARTS[-1]), len(BITS) + 1
#: Tables whose counts gate the weights: the last four bytes, and the word before.
GATE_TABLES = (2, len(BITS) - 1)
FIRST_WEIGHTS = [0.02, 0.05, 0.1, 0.1, 0.4, 0.4, 0.0]
#: The lead of the end, and the word and bytes before the first word.
END = np.uint32(1 << 24 | 0x20 << 8 * (LEAD - 1))
NO_WORD, NO_BYTES = np.uint64(0x5851F42D4C957F2D), np.uint64(0x202020202020)

_K = np.uint64(0xD6E8FEB86659FD93)
_PAIR = np.uint64(0xA0761D6478BD642F)
#: Which of the last five bytes are a word's own, by its size, and spaces for the others.
_OWN = np.array([(1 << 8 * k) - 1 for k in range(6)], np.uint64)
_SPACES = np.uint64(0x2020202020) & ~_OWN


def new_mixer() -> Mixer:
    return Mixer(np.tile(FIRST_WEIGHTS, (GATES, 1)))


@dataclass
class Leads:
    """Leads with the words (by hash) and the last bytes before them."""

    before: np.ndarray
    back: np.ndarray
    lead: np.ndarray

    def __len__(self) -> int:
        return len(self.lead)

    def take(self, k: np.ndarray) -> Leads:
        return Leads(self.before[k], self.back[k], self.lead[k])

    def keys(self) -> np.ndarray:
        return mix64(self.before + self.lead.astype(np.uint64) * _PAIR)

    @staticmethod
    def joined(parts: list[Leads]) -> Leads:
        return Leads(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("before", "back", "lead")))


def word_leads(low: Piece) -> np.ndarray:
    """The lead of every word of a lowered piece."""
    starts, ends = low.words
    size = ends - starts
    lead = np.minimum(size + 1, LEAD).astype(np.uint32) << np.uint32(24)
    last = max(len(low.data) - 1, 0)
    for p in range(LEAD):
        byte = np.where(size > p, low.data[np.minimum(starts + p, last)], np.where(size == p, 0x20, 0)) if len(size) else np.zeros(0)
        lead |= byte.astype(np.uint32) << np.uint32(8 * (LEAD - 1 - p))
    return lead


def last_bytes(low: Piece) -> np.ndarray:
    """The last six bytes up to the space that closes a word, for every word of a lowered piece."""
    starts, ends = low.words
    # Eight bytes before every place, as one number each.
    padded = np.concatenate([np.zeros(8, np.uint8), low.data])
    eight = np.ndarray(len(low.data) + 1, ">u8", padded, strides=(1,))
    own = np.minimum(ends - starts, 5)
    return ((eight[ends].astype(np.uint64) & _OWN[own]) | _SPACES[own]) << np.uint64(8) | np.uint64(0x20)


def text_leads(low: Piece, hashes: np.ndarray, lead: np.ndarray | None = None) -> Leads:
    """Every text's leads in order, the end's last: text d's begin at word_bounds[d] + d."""
    lead, back = word_leads(low) if lead is None else lead, last_bytes(low)
    bounds = low.word_bounds
    n = len(lead) + low.rows
    out = Leads(np.full(n, NO_WORD), np.full(n, NO_BYTES), np.full(n, END))
    at = np.arange(len(lead)) + np.repeat(np.arange(low.rows), np.diff(bounds))
    out.lead[at] = lead
    out.before[at + 1], out.back[at + 1] = hashes, back
    return out


def distinct(leads: Leads, n: np.ndarray | None = None) -> tuple[np.ndarray, Leads, np.ndarray]:
    """(number of each in the distinct ones, the distinct ones, how many of each)."""
    codes, found = pd.factorize(leads.keys())
    first = np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1) > 0) if len(codes) else np.zeros(0, np.int64)
    return codes, leads.take(first), np.bincount(codes, n, len(found)).astype(np.int64)


def _symbols(leads: Leads, code: Code) -> list[np.ndarray]:
    rank = np.frombuffer(code.rank, np.uint8)
    return [rank[(leads.lead >> np.uint32(8 * (LEAD - 1 - p)) & np.uint32(255)).astype(np.int64)] for p in range(LEAD)]


def _parts(leads: Leads, code: Code) -> Iterator[tuple[np.ndarray, Leads]]:
    """Some leads at a time; those after the same word are together, in the order of their bits."""
    key = leads.before >> np.uint64(8 * LEAD)
    for symbol in _symbols(leads, code):
        key = key << np.uint64(8) | symbol.astype(np.uint64)
    order = np.argsort(key)
    for a in range(0, len(order), AT_ONCE):
        yield order[a : a + AT_ONCE], leads.take(order[a : a + AT_ONCE])


def _walk(leads: Leads, code: Code) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """Per bit: the leads that have it; of these, where neighbours begin that share it, the word and all bits before; and for
    each beginning the bit and its slot in every table."""
    symbols, size = _symbols(leads, code), leads.lead >> np.uint32(24)
    back, whole = leads.back.copy(), np.zeros(len(leads), np.uint64)
    live = np.arange(len(leads))
    for p in range(LEAD):
        live = live[size[live] > p]
        if not len(live):
            return
        symbol = symbols[p][live]
        here, so_far = back[live], whole[live]
        partial = np.ones(len(live), np.uint64)
        pair = mix64(leads.before[live] + so_far)
        for k, bit in code.steps(symbol):
            node = partial[k]
            partial[k] = after = node << np.uint64(1) | bit.astype(np.uint64)
            first = np.flatnonzero(np.concatenate([[True], (after[1:] != after[:-1]) | (pair[k[1:]] != pair[k[:-1]])]))
            one, node = k[first], node[first]
            keys = [order_keys(n, here[one], node) for n in ORDERS] + [so_far[one] + node, pair[one] + node * _PAIR]
            yield live[k], first, bit[first], [context_slots(key, BITS[t], STARTS[t]) for t, key in enumerate(keys)]
        byte = (leads.lead[live] >> np.uint32(8 * (LEAD - 1 - p)) & np.uint32(255)).astype(np.uint64)
        back[live] = (here << np.uint64(8) | byte) & np.uint64(0xFFFFFFFFFFFF)
        whole[live] = (so_far + byte + np.uint64(1)) * _K


def count_leads(leads: Leads, n: np.ndarray, code: Code, out: np.ndarray) -> None:
    """Adds ``n`` occurrences of every lead to ``out``: (slot, bit) counts of all tables."""
    flat, n = out.reshape(-1), n.astype(out.dtype)
    for part, some in _parts(leads, code):
        for live, first, bit, slots in _walk(some, code):
            times = np.add.reduceat(n[part[live]], first, dtype=out.dtype)
            for s in slots:
                np.add.at(flat, s * 2 + bit, times)


def _seen(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What gates the weights: how often the last bytes were seen; how often the word, and whether it has been certain."""
    near, word = (slice(*STARTS[t : t + 2]) for t in GATE_TABLES)
    often = [bucket(zeros[x] + ones[x]) for x in (near, word)]
    return (often[0] * 2).astype(np.uint8), (often[1] * 16 + (np.minimum(zeros[word], ones[word]) == 0)).astype(np.uint8)


class LeadTables:
    def __init__(self, counts: np.ndarray):
        self.counts = np.ascontiguousarray(counts, np.float32)
        zeros, ones = self.counts.T
        self.all = stretch(ones, zeros), *_seen(zeros, ones)

    @cached_property
    def without(self) -> tuple[np.ndarray, ...]:
        """The same without one occurrence, by slot and the bit that is left out."""
        zeros, ones = self.counts.T
        seen = zip(_seen(np.maximum(zeros - 1, 0), ones), _seen(zeros, np.maximum(ones - 1, 0)), strict=True)
        return without_one(self.counts), *(np.stack(x, 1).ravel() for x in seen)

    def gate_and_inputs(self, slots: list[np.ndarray], own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``own`` is the bit whose one occurrence is left out of all counts."""
        stretched, *seen = self.all if own is None else self.without

        def at(slot: np.ndarray) -> np.ndarray:
            return slot if own is None else slot * 2 + own

        x = np.empty((len(slots[0]), INPUTS), np.float32)
        x[:, -1] = 0.3
        for t, s in enumerate(slots):
            x[:, t] = stretched.take(at(s))
        near, word = (g.take(at(slots[t] - STARTS[t])) for g, t in zip(seen, GATE_TABLES, strict=True))
        return (near + word).astype(np.int64), x


def learn_leads(leads: Leads, n: np.ndarray, code: Code, tables: LeadTables, mixer: Mixer) -> None:
    """Online pass over training leads; no context outweighs a thousandth of them."""
    most = max(1.0, float(n.sum()) / 1000)
    for part, some in _parts(leads, code):
        for live, first, bit, slots in _walk(some, code):
            weight = np.minimum(np.add.reduceat(n[part[live]], first), most).astype(float)
            mixer.learn(*tables.gate_and_inputs(slots, bit), bit.astype(float), weight)


def lead_scores(leads: Leads, code: Code, tables: LeadTables, mixer: Mixer) -> np.ndarray:
    """Natural-log probability of every lead after the word before it."""
    out = np.empty(len(leads))
    for part, some in _parts(leads, code):
        total = np.zeros(len(some))
        for live, first, bit, slots in _walk(some, code):
            gate, x = tables.gate_and_inputs(slots)
            one = mixer.refined(gate, mixer.mixed(gate, x))
            total[live] += np.repeat(np.log(np.where(bit == 1, one, 1 - one)), np.diff(first, append=len(live)))
        out[part] = total
    return out
