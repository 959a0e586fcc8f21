"""Words coded bit by bit by logistic context mixing.

A word is its lower-cased bytes and a closing space; the end of a text is the space alone.  Bytes have a prefix code,
frequent ones few bits.  Every bit's probability mixes, in the logistic domain,

* hashed contexts of the last 1, 2, 3, 4 and 6 bytes, from counts of every occurrence in the training texts;
* the last three bytes within a class of texts, once the class has seen the bytes of the word so far;
* all bytes of the word so far, over all texts and within the class, from counts of occurrences.

The last two are exact: words that share their first bytes (``depth`` of them) are held by one task, in sorted
order, where a context is a range and its count a difference of running sums; the bits before that depth are
counted in a table of prefixes for all tasks.

The mixing weights are gated by how often the two longest contexts were seen and whether they have been certain
so far.  They are learned online, bit after bit over all training words, each word's own occurrence taken out of
every count (so that a word seen once is predicted as if it was not).  An adaptive map refines the mixed
probability by what came of such predictions under the same gate.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cached_property

import numpy as np

from pageloom.llm.textops import repeat_ranges

CLASSES = 4
#: Orders of the hashed contexts and the bits of their tables.
ORDERS = ((1, 14), (2, 17), (3, 18), (4, 19), (6, 19))
CLASS_BITS, PREFIX_BITS = 17, 16
PRIOR = np.float32(0.05)
INPUTS, GATES, CELLS = len(ORDERS) + 4, 128, 33
RATE = 0.02
MIX_BATCHES = 4
#: Errors below this move no weight.
SURE = 0.002
#: Bytes of a word after which it is walked alone, many positions at once (``TAIL_STEP``), if no other word begins so.
DEEP_BYTES, TAIL_STEP = 48, 1 << 14

_ODD = np.uint64(0x9E3779B97F4A7C15)


class Layout:
    """Where each table's slots lie in one run of all counts."""

    bits = [b for _, b in ORDERS] + [CLASS_BITS] * CLASSES + [PREFIX_BITS] * (1 + CLASSES)
    starts = np.concatenate([[0], np.cumsum([1 << b for b in bits])]).astype(np.int64)
    total = int(starts[-1])
    of_class, of_prefix = len(ORDERS), len(ORDERS) + CLASSES


def context_slots(key: np.ndarray, bits: int, start: int) -> np.ndarray:
    return ((key * _ODD) >> np.uint64(64 - bits)).astype(np.int64) + start


def _slots(table: int, key: np.ndarray) -> np.ndarray:
    return context_slots(key, Layout.bits[table], Layout.starts[table])


def order_keys(order: int, back: np.ndarray, partial: np.ndarray) -> np.ndarray:
    return (back & np.uint64((1 << (8 * order)) - 1)) << np.uint64(16) | partial


def stretch(ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    return np.log(ones + PRIOR, dtype=np.float32) - np.log(zeros + PRIOR, dtype=np.float32)


def without_one(counts: np.ndarray) -> np.ndarray:
    """By slot and bit, what (slot, bit) counts stretch to if one occurrence of the bit is left out."""
    zeros, ones = counts[:, 0], counts[:, 1]
    return np.stack([stretch(ones, np.maximum(zeros - 1, 0)), stretch(np.maximum(ones - 1, 0), zeros)], 1).ravel()


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -20, 20)))


_BUCKETS = np.minimum(np.ceil(np.log2(np.arange(65) + 1.0)).astype(np.int64), 7)


def bucket(n: np.ndarray) -> np.ndarray:
    return _BUCKETS[np.minimum(n, 64).astype(np.int64)]


def _first_weights() -> np.ndarray:
    """Where learning starts: the longest contexts that were seen at all."""
    weights = np.tile([0.0, 0.02, 0.05, 0.07, 0.08, 0.05, 0.3, 0.5, 0.0], (GATES, 1))
    gate = np.arange(GATES) // 2
    weights[gate % 8 == 0] = [0.02, 0.05, 0.1, 0.15, 0.15, 0.15, 0.5, 0.0, 0.0]
    weights[gate == 0] = [0.05, 0.1, 0.15, 0.25, 0.25, 0.25, 0.0, 0.0, 0.0]
    weights[gate % 8 == 7] = [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.05, 0.95, 0.0]
    return weights


class Mixer:
    """Gated weights and the map that refines what they give."""

    def __init__(self, weights: np.ndarray | None = None, cells: np.ndarray | None = None):
        self.weights = _first_weights() if weights is None else weights
        self.cells = np.zeros((2, GATES, CELLS)) if cells is None else cells
        self._slope = np.full(self.weights.shape, 1e-3)
        self._size = np.full((GATES, 1), 1e-9)

    def mixed(self, gate: np.ndarray, inputs: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", self.weights.astype(np.float32).take(gate, 0), inputs)

    def _cell(self, gate: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        return gate * CELLS + (np.clip(mixed, -(CELLS // 4), CELLS // 4) * 2 + (CELLS // 2 + 0.5)).astype(np.int64)

    def refined(self, gate: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        """Probability of a one: the mix, half and half with the map's record of such mixes."""
        at = self._cell(gate, mixed)
        p = squash(mixed)
        seen, ones = (c.astype(np.float32).take(at) for c in self.cells)
        return np.clip((p + (ones + 8 * p) / (seen + 8)) * np.float32(0.5), 1e-6, 1 - 1e-6)

    def learn(self, gate: np.ndarray, inputs: np.ndarray, bit: np.ndarray, weight: np.ndarray) -> None:
        n = len(gate)
        cuts = [n * k // MIX_BATCHES for k in range(MIX_BATCHES + 1)] if n > 256 else [0, n]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            g, x, w, y = gate[a:b], inputs[a:b], weight[a:b], bit[a:b]
            mixed = self.mixed(g, x)
            error = y - squash(mixed)
            # A step counts by its words: the last bytes of the few longest words must not undo the rest.
            self._size = np.maximum(self._size, np.bincount(g, w, GATES)[:, None])
            at = self._cell(g, mixed)
            self.cells[0] = self.cells[0] * 0.999 + np.bincount(at, w, GATES * CELLS).reshape(GATES, CELLS)
            self.cells[1] = self.cells[1] * 0.999 + np.bincount(at, w * y, GATES * CELLS).reshape(GATES, CELLS)
            # Bits that were all but certain move no weight.
            k = np.flatnonzero(np.abs(error) > SURE)
            g, e = g[k], error[k] * w[k]
            step = np.stack([np.bincount(g, e * column, GATES) for column in np.ascontiguousarray(x[k].T)], 1) / self._size
            self._slope += step * step
            self.weights += RATE * step / np.sqrt(self._slope)


class Code:
    """A prefix code of bytes in which frequent bytes have few bits (Huffman's), in canonical order: sorting by ``rank``
    sorts by the code's bits."""

    def __init__(self, counts: np.ndarray | None = None):
        n = np.zeros(256) if counts is None else np.asarray(counts, float)
        # No byte is so rare as to have a very long code.
        n = n + max(float(n.sum()), 1.0) / 4000
        heap = [(float(x), k, (k,)) for k, x in enumerate(n)]
        heapq.heapify(heap)
        length = np.zeros(256, np.int64)
        made = 256
        while len(heap) > 1:
            (x, _, left), (y, _, right) = heapq.heappop(heap), heapq.heappop(heap)
            length[[*left, *right]] += 1
            heapq.heappush(heap, (x + y, made, left + right))
            made += 1
        order = np.lexsort((np.arange(256), length))
        self.length = length[order]
        steps = np.concatenate([[0], np.diff(self.length)])
        code, codes = 0, []
        for k, step in enumerate(steps.tolist()):
            code = (code + (k > 0)) << step if k else 0
            codes.append(code)
        first = int(self.length[0])
        self.bits = np.array(codes, np.int64)
        assert first and int(self.bits[-1]) == (1 << int(self.length[-1])) - 1
        rank = np.empty(256, np.uint8)
        rank[order] = np.arange(256)
        self.rank = rank.tobytes()

    def steps(self, symbol: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Bit after bit: which symbols have one more, and that bit."""
        length, bits = self.length[symbol], self.bits[symbol]
        some, j = np.arange(len(symbol)), 0
        while len(some):
            left = length[some]
            yield some, bits[some] >> (left - 1 - j) & 1
            j += 1
            some = some[left > j]


class Words:
    """Distinct words of a task in sorted order, walked bit by bit together."""

    def __init__(self, words: list[bytes], counts: np.ndarray, depth: np.ndarray, code: Code):
        closed = [(w + b" ").translate(code.rank) for w in words]
        order = sorted(range(len(closed)), key=closed.__getitem__)
        self.order, self.code = np.array(order, np.int64), code
        self.counts, self.depth = counts[self.order].astype(np.int64), depth[self.order]
        closed = [closed[k] for k in order]
        self.sizes = np.array([len(w) for w in closed], np.int64)
        self.text = np.frombuffer(b"".join(closed), np.uint8)
        self.base = np.cumsum(self.sizes) - self.sizes
        both = np.concatenate([self.counts.sum(1, keepdims=True), self.counts], 1)
        sums = np.concatenate([np.zeros((1, both.shape[1]), np.int64), np.cumsum(both, 0)])
        self.sums = sums.astype(np.int32) if sums[-1].max(initial=0) < 1 << 31 else sums

    def nodes(self, begin: int = 0) -> Iterator[tuple[np.ndarray, ...]]:
        """Per bit from byte ``begin`` on, once for all words that share it and every bit before: the first of them and the
        one after the last, the bit, bytes back, hash of the bytes so far, bits so far of this byte, whether the bit lies before
        the task's depth, and the counts of ones and zeros of the exact contexts (all texts first, then each class).

        From DEEP_BYTES on, a word that shares its bytes so far with no other leaves; what is left of such words
        comes at the end, many positions of a word at once: the word alone makes the counts there."""
        m = len(self.sizes)
        low, high = np.zeros(min(m, 1), np.int64), np.full(min(m, 1), m, np.int64)
        back, whole = np.zeros(len(low), np.uint64), np.zeros(len(low), np.uint64)
        shared, left, p = self._shared(), self.sizes.copy(), 0
        while len(low):
            # Ranges of words with equal bytes so far, and in each the words at which the next byte is another one.
            heads = repeat_ranges(low, high - low)
            heads = heads[shared[heads] <= p]
            parent = np.cumsum(shared[heads] < p) - 1
            symbol = self.text[self.base[heads] + p]
            partial = np.ones(len(heads), np.uint64)
            early = p < self.depth[heads]
            here, so_far = back[parent], whole[parent]
            a, b = low[parent], high[parent]
            for k, bit in self.code.steps(symbol):
                first, last, node = a[k], b[k], partial[k]
                # Heads of a range stand next to each other, those with a zero first.
                start = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
                size = np.diff(start, append=len(k))
                ones = np.add.reduceat(bit, start)
                middle = np.repeat(np.where(ones > 0, heads[k[np.minimum(start + size - ones, len(k) - 1)]], last[start]), size)
                a[k], b[k] = lower, upper = np.where(bit == 1, middle, first), np.where(bit == 1, last, middle)
                partial[k] = node << np.uint64(1) | bit.astype(np.uint64)
                if p >= begin:
                    one = np.flatnonzero(np.concatenate([[True], lower[1:] != lower[:-1]]))
                    at = self.sums.take(middle[one], 0)
                    of = k[one]
                    yield lower[one], upper[one], bit[one], here[of], so_far[of], node[one], early[of], self.sums.take(last[one], 0) - at, at - self.sums.take(first[one], 0)
            # The rarest byte stands for none before the word.
            byte = (255 - symbol).astype(np.uint64)
            p += 1
            stay = self.sizes[heads] > p
            if p >= DEEP_BYTES:
                alone = stay & (b - a == 1)
                left[heads[alone]] = p
                stay &= ~alone
            low, high = a[stay], b[stay]
            back = ((here << np.uint64(8) | byte) & np.uint64(0xFFFFFFFFFFFF))[stay]
            whole = ((so_far + byte + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))[stay]
        far = self.sizes - left
        ends = np.cumsum(far)
        for first in range(0, int(far.sum()), TAIL_STEP):
            k = np.arange(first, min(first + TAIL_STEP, int(ends[-1])))
            word = np.searchsorted(ends, k, "right")
            at = self.base[word] + left[word] + k - (ends[word] - far[word])
            behind = np.zeros(len(at), np.uint64)
            for back_by in range(6, 0, -1):
                behind = behind << np.uint64(8) | (255 - self.text[at - back_by]).astype(np.uint64)
            partial, nowhere = np.ones(len(at), np.uint64), np.zeros(len(at), bool)
            own = self.sums[word + 1] - self.sums[word]
            for k, bit in self.code.steps(self.text[at]):
                node = partial[k]
                yield word[k], word[k] + 1, bit, behind[k], behind[k], node, nowhere[k], own[k] * bit[:, None], own[k] * (1 - bit)[:, None]
                partial[k] = node << np.uint64(1) | bit.astype(np.uint64)

    def _shared(self) -> np.ndarray:
        """How many first bytes every word has in common with the one before it; -1 for the first."""
        shared = np.zeros(len(self.sizes), np.int64)
        shared[:1] = -1
        k, p = np.arange(1, len(self.sizes)), 0
        while len(k):
            # No word begins another, so two differ before either ends.
            k = k[self.text[self.base[k] + p] == self.text[self.base[k - 1] + p]]
            p += 1
            shared[k] = p
        return shared

    def walk(self, begin: int = 0) -> Iterator[tuple[np.ndarray, ...]]:
        """``nodes`` word by word: the word in the place of the range."""
        for low, high, *rest in self.nodes(begin):
            of = np.repeat(np.arange(len(low)), high - low)
            yield repeat_ranges(low, high - low), *(x[of] for x in rest)


def count_tables(words: Words, out: np.ndarray, begin: int = 0) -> None:
    """Adds the words' contexts to ``out``: (slot, bit) counts of all tables."""
    flat = out.reshape(-1)

    def put(table: int, keys: np.ndarray, bit: np.ndarray, times: np.ndarray) -> None:
        np.add.at(flat, _slots(table, keys) * 2 + bit, times)

    for _, _, bit, back, whole, partial, early, ones, zeros in words.nodes(begin):
        n = np.where(bit[:, None] == 1, ones, zeros).astype(out.dtype)
        for t, (order, _) in enumerate(ORDERS):
            put(t, order_keys(order, back, partial), bit, n[:, 0])
        three = order_keys(3, back, partial)
        for c in range(CLASSES):
            here = np.flatnonzero(n[:, 1 + c])
            put(Layout.of_class + c, three[here], bit[here], n[here, 1 + c])
        at = np.flatnonzero(early)
        if len(at):
            keys = whole[at] + partial[at]
            for c in range(1 + CLASSES):
                some = np.flatnonzero(n[at, c])
                put(Layout.of_prefix + c, keys[some], bit[at[some]], n[at[some], c])


class Tables:
    """The counts of all contexts, and for the hashed ones what they stretch to."""

    def __init__(self, counts: np.ndarray):
        self.pairs = np.ascontiguousarray(counts, np.float32).view(np.complex64).ravel()
        hashed = counts[: Layout.starts[Layout.of_prefix]]
        self.stretched = stretch(hashed[:, 1], hashed[:, 0])

    @cached_property
    def without(self) -> np.ndarray:
        """What the hashed counts stretch to without one occurrence, by slot and the bit that is left out."""
        return without_one(self.pairs[: Layout.starts[Layout.of_prefix]].view(np.float32).reshape(-1, 2))

    def counts(self, slots: np.ndarray) -> np.ndarray:
        return self.pairs.take(slots).view(np.float32).reshape(-1, 2)


class Predictors:
    """What the words of one bit have in common, over all classes."""

    def __init__(self, tables: Tables, step: tuple[np.ndarray, ...], own: np.ndarray | None = None):
        """``own`` is the words' bit, whose one occurrence is left out of all counts."""
        _, _, _, back, whole, partial, early, ones, zeros = step
        self.tables, self.own = tables, own
        self.mine = None if own is None else np.stack([1 - own, own], 1).astype(np.float32)
        self.three = order_keys(3, back, partial)
        n = len(back)
        self.common = np.empty((n, INPUTS), np.float32)
        for t, (order, _) in enumerate(ORDERS):
            self.common[:, t] = self._hashed(_slots(t, order_keys(order, back, partial)), own)
        exact = np.empty((n, 1 + CLASSES, 2), np.float32)
        exact[:, :, 0], exact[:, :, 1] = zeros, ones
        at = np.flatnonzero(early)
        if len(at):
            # The task does not hold all words that begin so: these counts come from the corpus.
            keys = whole[at] + partial[at]
            for c in range(1 + CLASSES):
                exact[at, c] = tables.counts(_slots(Layout.of_prefix + c, keys))
        if self.mine is not None:
            exact[:, 0] = np.maximum(exact[:, 0] - self.mine, 0)
        self.exact = exact
        self.common[:, -4] = self.common[:, -2] = 0.0
        self.common[:, -3] = stretch(exact[:, 0, 1], exact[:, 0, 0])
        self.common[:, -1] = 0.3
        self.total = exact[:, :, 0] + exact[:, :, 1]
        self.seen = bucket(self.total[:, 0]) * 8

    def _hashed(self, slots: np.ndarray, own: np.ndarray | None) -> np.ndarray:
        return self.tables.stretched.take(slots) if own is None else self.tables.without.take(slots * 2 + own)

    def outside(self) -> tuple[np.ndarray, np.ndarray]:
        """Gate and inputs for a class that has not seen the bytes so far: the class adds nothing."""
        return self.seen * 2 + 1, self.common

    def of_class(self, c: int | np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gate and inputs of the picked words in class ``c``, or each in its class; without counts of its own they are those of ``outside``."""
        zeros, ones, total = self.exact[pick, 1 + c, 0], self.exact[pick, 1 + c, 1], self.total[pick, 1 + c]
        own = None
        if self.mine is not None:
            own, mine = self.own[pick], self.mine.take(pick, 0)
            zeros, ones = np.maximum(zeros - mine[:, 0], 0), np.maximum(ones - mine[:, 1], 0)
            total = zeros + ones
        inputs = self.common.take(pick, 0)
        inputs[:, -4] = self._hashed(context_slots(self.three[pick], CLASS_BITS, Layout.starts[Layout.of_class + c]), own) * (total > 0)
        inputs[:, -2] = stretch(ones, zeros)
        return (self.seen[pick] + bucket(total)) * 2 + ((zeros == 0) | (ones == 0)), inputs


def learn_mixer(words: Words, tables: Tables, mixer: Mixer, begin: int = 0) -> None:
    """Online pass over a task's training words."""
    # No word may outweigh a thousandth of the class; below that, words weigh by their occurrences.
    weight = np.minimum(words.counts, np.maximum(1.0, words.counts.sum(0) / 1000))
    weight = np.concatenate([np.zeros((1, CLASSES)), np.cumsum(weight, 0)])
    for step in words.nodes(begin):
        low, high, bit = step[:3]
        common = Predictors(tables, step, own=bit)
        n = np.where(bit[:, None] == 1, step[-2], step[-1])
        for c in range(CLASSES):
            k = np.flatnonzero(n[:, 1 + c])
            if len(k):
                gate, inputs = common.of_class(c, k)
                mixer.learn(gate, inputs, bit[k].astype(float), weight[high[k], c] - weight[low[k], c])


def word_scores(words: Words, tables: Tables, mixer: Mixer, begin: int = 0) -> np.ndarray:
    """Natural-log probability of every word (in sorted order) in every class."""
    # What all words of a range pay is added at its first word and taken back after its last.
    m = len(words.sizes)
    total = np.zeros((1 + CLASSES, m + 1))

    def logs(gate: np.ndarray, inputs: np.ndarray, bit: np.ndarray) -> np.ndarray:
        one = mixer.refined(gate, mixer.mixed(gate, inputs))
        return np.log(np.where(bit == 1, one, 1 - one)).astype(float)

    for step in words.nodes(begin):
        low, high, bit = step[:3]
        common = Predictors(tables, step)
        outside = logs(*common.outside(), bit)
        # Row 0 is any class that has not seen the bytes; each class has its difference from there.
        pick, c = np.nonzero(common.total[:, 1:] > 0)
        differ = logs(*common.of_class(c, pick), bit[pick]) - outside[pick]
        for x, row, k in ((outside, 0, slice(None)), (differ, 1 + c, pick)):
            np.add.at(total.reshape(-1), row * (m + 1) + low[k], x)
            np.subtract.at(total.reshape(-1), row * (m + 1) + high[k], x)
    total = np.cumsum(total, 1)[:, :-1]
    return (total[1:] + total[:1]).T
