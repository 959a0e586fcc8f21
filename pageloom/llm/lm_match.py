"""The bit that comes before a word: is it the word that followed when the last words were read before?

A text reads on in its own past, and in the past of one like text if there is one.  Where the last four words, or
else the last two, were read before, the word that followed is the candidate, and one bit tells whether it comes
again.  The bit's probability mixes, in the logistic domain, what such bits were like so far

* after as many hits in a row along the same earlier passage, by the words matched;
* for candidates of the same frequency;
* where this candidate's earlier occurrence was itself a hit, a miss or unpredicted.

Weights are gated by the words matched and the hits in a row.  Weights, rates and the map that refines the mix are
learned online along the text, a few words at a time (``CHUNK``), and start anew with every text, so that a text's score
depends on no other but its like text.
"""

from __future__ import annotations

import numpy as np

from pageloom.llm.textops import mix64

#: Words of the two contexts, longest first.
LONG, SHORT = 4, 2
#: Words after which what came is learned: in the first EARLY words of a text, and from there on.
CHUNK, EARLY, LATE_CHUNK = 32, 1024, 256
RUNS, FREQUENCIES, PASTS = 8, 9, 6
GATES, INPUTS, CELLS = 6, 4, 17
RATE = 0.05
#: Rates of hits that every text starts from, and how many bits they count for: by hits in a row, short and long context.
FIRST_RATES = np.array([[0.3, 0.6, 0.8, 0.9, 0.95, 0.97, 0.98, 0.985], [0.8, 0.9, 0.95, 0.97, 0.98, 0.985, 0.99, 0.99]])
FIRST_PASTS = np.array([0.6, 0.4, 0.95, 0.7, 0.5, 0.95])
FIRST_COUNT = 4.0
FIRST_WEIGHTS = np.array([0.8, 0.1, 0.2, 0.0])

_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


def _earlier(tokens: np.ndarray, owner: np.ndarray, width: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per token the last earlier token of its owner with the same ``width`` words before it, or -1, and the tokens that
    share those words with another; ``at`` are the tokens that come into question."""
    found = np.full(len(tokens), -1, np.int64)
    key = owner[at].astype(np.uint64) * _K[4]
    for k in range(1, width + 1):
        key = mix64(key + tokens[at - k] * _K[k % 4])
    # Keys and places in one number sort fastest; should two keys share their upper bits, the whole keys are sorted.
    low = np.uint64((1 << len(at).bit_length()) - 1)
    packed = np.sort((key & ~low) | np.arange(len(at), dtype=np.uint64))
    order = (packed & low).astype(np.int64)
    upper = packed & ~low
    same = np.flatnonzero(upper[1:] == upper[:-1]) + 1
    if (key[order[same]] != key[order[same - 1]]).any():
        order = np.argsort(key, kind="stable")
        same = np.flatnonzero(key[order[1:]] == key[order[:-1]]) + 1
    found[at[order[same]]] = at[order[same - 1]]
    shared = np.zeros(len(at), bool)
    shared[order[same]] = shared[order[same - 1]] = True
    return found, at[shared]


def candidates(tokens: np.ndarray, place: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token whose word is the candidate or -1, whether the long context was found), for every token.

    ``place`` numbers the words of a text from 0; the like text of an owner comes before its own text."""
    short, shared = _earlier(tokens, owner, SHORT, np.flatnonzero(place >= SHORT))
    # Who shares the long context shares the short one.
    long, _ = _earlier(tokens, owner, LONG, shared[place[shared] >= LONG])
    return np.where(long >= 0, long, short), long >= 0


def _stretch(p: np.ndarray) -> np.ndarray:
    return np.log(p / (1 - p))


def hit_probabilities(doc: np.ndarray, place: np.ndarray, hit: np.ndarray, run: np.ndarray, long: np.ndarray, frequency: np.ndarray, past: np.ndarray, docs: int) -> np.ndarray:
    """Probability of a hit for every bit (in order of place within its text), learned along each text."""
    out = np.empty(len(doc))
    if not len(doc):
        return out
    long = long.astype(np.int64)
    run = np.minimum(run, RUNS - 1)
    starts = (FIRST_RATES.ravel(), np.full(FREQUENCIES, 0.7), FIRST_PASTS)
    # Flat tables by text: hits and bits of each context, weights by gate and input, and the map's hits and bits.
    contexts = [doc * len(p) + c for c, p in zip((long * RUNS + run, frequency, past), starts, strict=True)]
    rates = [(np.tile(p * FIRST_COUNT, docs), np.full(len(p) * docs, FIRST_COUNT)) for p in starts]
    gate = (doc * GATES + long * 3 + np.minimum((run + 2) // 3, 2)) * INPUTS
    weights = np.tile(FIRST_WEIGHTS, docs * GATES)
    cells = np.zeros(docs * CELLS), np.zeros(docs * CELLS)
    chunk = np.where(place < EARLY, place // CHUNK, EARLY // CHUNK + (place - EARLY) // LATE_CHUNK)
    order = np.argsort(chunk, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], np.diff(chunk[order]) != 0, [True]]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        k = order[a:b]
        y, g = hit[k].astype(float), gate[k]
        at = [c[k] for c in contexts]
        x = [_stretch(np.clip(h.take(i) / n.take(i), 0.002, 0.998)) for (h, n), i in zip(rates, at, strict=True)] + [0.3]
        mixed = np.clip(sum(weights.take(g + j) * v for j, v in enumerate(x)), -8, 8)
        p = 1 / (1 + np.exp(-mixed))
        cell = doc[k] * CELLS + np.rint(mixed).astype(np.int64) + CELLS // 2
        out[k] = np.clip((p + (cells[0].take(cell) + 16 * p) / (cells[1].take(cell) + 16)) / 2, 0.001, 0.999)
        # What came is learned at the end of the chunk.
        step = RATE * (y - p)
        for j, v in enumerate(x):
            np.add.at(weights, g + j, step * v)
        for (h, n), i in zip([*rates, cells], [*at, cell], strict=True):
            np.add.at(h, i, y)
            np.add.at(n, i, 1.0)
    return out


def match_bits(tokens: np.ndarray, place: np.ndarray, owner: np.ndarray, own: np.ndarray, common: np.ndarray, docs: int) -> tuple[np.ndarray, ...]:
    """(token, its candidate's token, whether it hit, probability of a hit) for every token of an owner's own text
    that has a candidate.

    ``own`` tells an owner's own words (and the end, which never hits) from those of its like text, and ``common``
    is a number below FREQUENCIES that says how frequent a token's word is."""
    source, long = candidates(tokens, place, owner)
    at = np.flatnonzero(own & (source >= 0))
    s = source[at]
    hit = tokens[at] == tokens[s]
    along = np.concatenate([[False], (at[1:] == at[:-1] + 1) & (s[1:] == s[:-1] + 1) & (owner[at[1:]] == owner[at[:-1]])]) if len(at) else np.zeros(0, bool)
    fresh = np.maximum.accumulate(np.where(along, 0, np.arange(len(at)))) if len(at) else np.zeros(0, np.int64)
    run = np.arange(len(at)) - fresh
    outcome = np.zeros(len(tokens), np.int64)
    outcome[at] = 1 + hit
    past = outcome[s] + 3 * ~own[s]
    return at, s, hit, hit_probabilities(owner[at], place[at], hit, run, long[at], common[s], past, docs)
