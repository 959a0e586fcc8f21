"""LM scoring by logistic context mixing, over the bits of words and over the words before.

A text is its lower-cased words and one end.  Before each of them comes one bit, if the last words were read
before in this text or in a like one: is it the word that followed then (``lm_match``).  If not, or if there is no
such candidate, the word is coded bit by bit, in the place of all words but the candidate: its first byte from the
text before it, the word before and its last bytes (``lm_lead``), what follows that byte from its spelling (``lm_words``).

The like text is the training text, another than the text itself, with which it shares most anchors: runs of
ANCHOR_WORDS words whose hash is a multiple of ANCHOR_EVERY.  Of the training texts with an anchor, the first and the
last stand for all.

Texts fall into ``CLASSES`` classes, found from which frequent words occur together.  A text's score mixes the
classes as experts whose weights follow the words read so far: the Bayesian posterior, which makes the total the
logarithm of a weighted sum of products.  First bytes cost the same in all classes.

Words travel once per block of rows: to the task of their first bytes, where they are counted and scored with all
words that begin so, and back to the block.  First bytes under which very many words lie are dealt by more bytes.
No task and no driver holds the vocabulary.  Blocks are numbered by the rows' place in the input, which must be read in the
same order each time, as files are; a block that has changed between passes raises an error.

Defined cases: null text is empty, one end token; without training rows all counts are 0 and the model codes
bits evenly; repeated rows are scored each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import cut_lineage, release_memory, releasing
from pageloom.llm.lm_lead import LEAD, TOTAL, Leads, LeadTables, count_leads, distinct, lead_scores, learn_leads, new_mixer, text_leads, word_leads
from pageloom.llm.lm_match import FREQUENCIES, match_bits
from pageloom.llm.lm_words import CELLS, CLASSES, Code, Layout, Mixer, Tables, Words, count_tables, learn_mixer, word_scores
from pageloom.llm.textops import Piece, lowered, mix64, pieces, prefix_hashes, repeat_ranges, span_hashes

TOP_WORDS = 256
#: Rows and bytes of a block, about.
BLOCK_ROWS, BLOCK_BYTES = 4096, 16 << 20
#: Bytes of texts, and words, that are handled together.
PIECE_BYTES, WORDS_AT_ONCE = 1 << 20, 1 << 16
#: First bytes of a word that decide its task: the first of these numbers under which few enough words lie.
DEPTHS = (3, 6, 12)
PREFIX_SLOTS = 4096
HOT_WORDS = 60_000
#: Distinct words of a task, and words of blocks that it joins, about.
TASK_WORDS, TASK_ENTRIES = 40_000, 2_000_000
#: Words of tasks that are walked together: a step of the walk costs little more for many words than for few.
WORDS_WALKED = 120_000
#: One word in so many is reported, for an estimate of how many there are.
SAMPLED = 64
ANCHOR_WORDS, ANCHOR_EVERY = 5, 48
#: Rows up to which a table is sent to every task; beyond, the join shuffles.
BROADCAST_ROWS = 500_000
#: Log-probabilities travel as multiples of this, rounded down.
LOG_UNIT = 1 / 1024
#: Pairs of a lead and the word before that are counted or learned from together.
LEADS_AT_ONCE = 1_500_000
#: Slots of the count tables that travel as one row.
TABLE_SLICE = 1 << 16


def planes(x: np.ndarray) -> bytes:
    """The bytes of 32- or 64-bit numbers, all lowest ones first: small numbers compress to little."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def numbers(data: bytes, dtype=np.int32) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def _first_bytes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    return span_hashes(prefix, starts, np.minimum(ends, starts + n))


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(52)).astype(np.int64) % PREFIX_SLOTS


def dealt(names: np.ndarray, ends: np.ndarray, hot: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(key of the first bytes that decide the task, how many bytes those are) of words that stand end to end."""
    starts = np.concatenate([[0], ends[:-1]])
    # A few first bytes matter, so that runs of words stay short however long a word is.
    prefix = prefix_hashes(names[repeat_ranges(starts, np.minimum(ends - starts, DEPTHS[-1]))])
    ends = np.cumsum(np.minimum(ends - starts, DEPTHS[-1]))
    starts = np.concatenate([[0], ends[:-1]])
    key, depth = _first_bytes(prefix, starts, ends, DEPTHS[0]), np.full(len(starts), DEPTHS[0])
    open_ = np.arange(len(starts))
    for level, n in enumerate(DEPTHS[1:]):
        open_ = open_[hot[level][_slot(key[open_])]]
        key[open_], depth[open_] = _first_bytes(prefix, starts[open_], ends[open_], n), n
    return key, depth


def _survey(placed: DataFrame) -> DataFrame:
    """Words that stand out in a piece's training texts, a sample of all words, the number of bytes, and how often each
    byte occurs in training words: kind, word (or byte), n, first and second slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, letters = 0, np.zeros(256, np.int64)
        for batch in batches:
            train = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
            for piece in pieces(batch.column(0), PIECE_BYTES):
                size += len(piece.data)
                low = lowered(piece)
                prefix = prefix_hashes(low.data)
                starts, ends = low.words
                codes, distinct = pd.factorize(span_hashes(prefix, starts, ends))
                learned = np.repeat(train[piece.first_row : piece.first_row + piece.rows], np.diff(low.word_bounds))
                n = np.bincount(codes[learned], minlength=len(distinct))
                first = np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1) > 0)
                known = first[n > 0]
                letters += np.bincount(low.data[repeat_ranges(starts[known], ends[known] - starts[known])], minlength=256)
                letters[0x20] += len(known)
                for kind, chosen in ((0, np.flatnonzero((n > 0) & (n * 5000 >= len(codes)))), (1, np.flatnonzero(distinct % np.uint64(SAMPLED) == 0))):
                    a, b = starts[first[chosen]], ends[first[chosen]]
                    slots = [pa.array(_slot(_first_bytes(prefix, a, b, d))) for d in DEPTHS[:2]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(chosen), kind)), pa.array(distinct[chosen].view(np.int64)), pa.array(n[chosen]), *slots], ["kind", "word", "n", "s0", "s1"])
        rows = [(2, 0, size, 0, 0), *((3, k, n, 0, 0) for k, n in enumerate(letters.tolist()) if n)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], ["kind", "word", "n", "s0", "s1"])

    found = placed.select("text", "train").mapInArrow(releasing(run), "kind long, word long, n long, s0 long, s1 long")
    return cut_lineage(found.groupBy("kind", "word").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pieces"), F.first("s0").alias("s0"), F.first("s1").alias("s1")))


def _marked(piece: Piece, top: np.ndarray, codes: np.ndarray, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, index in ``top``) of the frequent words of a lowered piece, whose words are ``distinct[codes]``."""
    at = np.minimum(np.searchsorted(top, distinct), len(top) - 1)
    words = np.flatnonzero((top[at] == distinct)[codes])
    return np.searchsorted(piece.word_bounds, words, "right") - 1, at[codes[words]]


def _word_classes(texts: DataFrame, top: np.ndarray) -> np.ndarray:
    """A class for every frequent word, from the texts they share: seeded k-means on co-occurrence."""
    t = len(top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together = np.zeros((t, t))
        for batch in batches:
            for piece in pieces(batch.column(0), PIECE_BYTES):
                low = lowered(piece)
                doc, word = _marked(low, top, *pd.factorize(low.word_hashes()))
                seen = np.zeros((piece.rows, t), np.float32)
                seen[doc, word] = 1
                together += seen.T @ seen
        if together.any():
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % 64]), pa.array([together.tobytes()], pa.binary())], ["part", "n"])

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x) for x in table.column("n").to_pylist())
        return pa.table({"part": table.column("part").slice(0, 1), "n": pa.array([total.tobytes()], pa.binary())})

    m = np.zeros((t, t))
    for r in texts.mapInArrow(releasing(run), "part long, n binary").groupBy("part").applyInArrow(added, "part long, n binary").collect():
        m += np.frombuffer(r["n"]).reshape(t, t)
    scale = np.sqrt(np.maximum(np.diag(m), 1))
    m = m / scale[:, None] / scale[None, :]
    m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9)
    centres = [m[int(np.argmax(scale))]]
    while len(centres) < min(CLASSES, t):
        centres.append(m[int(np.argmin(np.max([m @ c for c in centres], axis=0)))])
    for _ in range(25):
        label = np.argmax(m @ np.array(centres).T, axis=1)
        centres = [m[label == k].mean(0) if (label == k).any() else c for k, c in enumerate(centres)]
    return label


def _block_words(placed: DataFrame, top: np.ndarray, label: np.ndarray, hot: list[np.ndarray], tasks: int) -> DataFrame:
    """Distinct words of every block, by task: their numbers in the block, names, sizes, depths and training counts per
    class.  A block's words are numbered by hash; the end is the last, with the empty name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: int | None = None
        held: list[tuple[np.ndarray, ...]] = []
        ends = np.zeros(CLASSES, np.int64)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, ends
            if block is None:
                return
            # Every piece brings its distinct words: their bytes, sizes, hashes and counts per class.
            size, hashes = (np.concatenate([x[k] for x in held]) for k in (1, 2))
            codes, distinct = pd.factorize(hashes)
            first = np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1) > 0)
            order = np.argsort(distinct)
            counts = np.stack([np.bincount(codes, np.concatenate([x[3][c] for x in held]), len(distinct))[order] for c in range(CLASSES)]).astype(np.int64)
            starts = (np.cumsum(size) - size)[first][order]
            size = size[first][order]
            data = np.concatenate([x[0] for x in held])[repeat_ranges(starts, size)]
            held = []
            stops = np.append(np.cumsum(size), len(data))
            starts = np.append(stops[:-1] - size, len(data))
            counts = np.concatenate([counts, ends[:, None]], 1)
            ends = np.zeros(CLASSES, np.int64)
            chunks = [slice(a, a + WORDS_AT_ONCE) for a in range(0, len(starts), WORDS_AT_ONCE)]
            key, depth = (np.concatenate(x) for x in zip(*(dealt(data[starts[c][0] : stops[c][-1]], stops[c] - starts[c][0], hot) for c in chunks), strict=True))
            task = (key % np.uint64(tasks)).astype(np.int64)
            turn = np.argsort(task, kind="stable")
            edges = np.flatnonzero(np.concatenate([[True], np.diff(task[turn]) != 0, [True]]))
            out: list[list] = [[] for _ in range(7)]
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                k = turn[a:b]
                size = stops[k] - starts[k]
                for column, x in zip(out, (int(task[k[0]]), block, planes(k.astype(np.int32)), data[repeat_ranges(starts[k], size)].tobytes(), planes(size.astype(np.int32)), depth[k].astype(np.uint8).tobytes(), planes(counts[:, k].ravel().astype(np.int64))), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["task", "block", "number", "names", "sizes", "depth", "counts"])

        for batch in batches:
            blocks = batch.column(2).to_numpy()
            train = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
            cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if block != blocks[a]:
                    yield from flush()
                    block = int(blocks[a])
                for piece in pieces(batch.column(0).slice(a, b - a), PIECE_BYTES):
                    low = lowered(piece)
                    codes, distinct = pd.factorize(low.word_hashes())
                    votes = np.zeros((piece.rows, CLASSES), np.int64)
                    if len(top):
                        doc, word = _marked(low, top, codes, distinct)
                        np.add.at(votes, (doc, label[word]), 1)
                    kind = np.where(train[a + piece.first_row : a + piece.first_row + piece.rows], np.argmax(votes, axis=1), CLASSES)
                    ends += np.bincount(kind, minlength=CLASSES + 1)[:CLASSES]
                    of = np.repeat(kind, np.diff(low.word_bounds))
                    first = np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1) > 0)
                    begin, stop = (x[first] for x in low.words)
                    counts = np.bincount(of * len(distinct) + codes, minlength=(CLASSES + 1) * len(distinct)).reshape(CLASSES + 1, -1)
                    held.append((low.data[repeat_ranges(begin, stop - begin)], stop - begin, distinct, counts[:CLASSES].astype(np.int32)))
        yield from flush()

    return placed.select("text", "train", "block").mapInArrow(releasing(run), "task long, block long, number binary, names binary, sizes binary, depth binary, counts binary")


_VOCABULARY = "task long, m long, names binary, sizes binary, depth binary, counts binary, block binary, entries binary, number binary, word binary, known long, totals array<long>"


def _vocabulary(parts: DataFrame) -> DataFrame:
    """One row per task: its distinct words with counts, and for each block's words their numbers in the block and in the task."""

    def run(table: pa.Table) -> pa.Table:
        names = [np.frombuffer(x, np.uint8) for x in table.column("names").to_pylist()]
        sizes = [numbers(x) for x in table.column("sizes").to_pylist()]
        hashes = []
        for data, size in zip(names, sizes, strict=True):
            end = np.cumsum(size)
            hashes.append(span_hashes(prefix_hashes(data), end - size, end))
        codes, _ = pd.factorize(np.concatenate(hashes))
        first = np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1) > 0)
        size = np.concatenate(sizes).astype(np.int64)
        starts = np.cumsum(size) - size
        data = np.concatenate(names)[repeat_ranges(starts[first], size[first])]
        depth = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("depth").to_pylist()])[first]
        counts = np.zeros((len(first), CLASSES), np.int64)
        at = 0
        entries = []
        for x, n in zip(table.column("counts").to_pylist(), sizes, strict=True):
            counts[codes[at : at + len(n)]] += numbers(x, np.int64).reshape(CLASSES, -1).T
            entries.append(len(n))
            at += len(n)
        number = np.concatenate([numbers(x) for x in table.column("number").to_pylist()])
        row = {
            "task": int(table.column("task")[0].as_py()), "m": len(first), "names": data.tobytes(), "sizes": planes(size[first].astype(np.int32)), "depth": depth.tobytes(),
            "counts": planes(counts.ravel()), "block": planes(table.column("block").to_numpy().astype(np.int64)), "entries": planes(np.array(entries, np.int32)),
            "number": planes(number.astype(np.int32)), "word": planes(codes.astype(np.int32)), "known": int((counts.sum(1) > 0).sum()), "totals": counts.sum(0).tolist(),
        }
        return pa.table({k: [v] for k, v in row.items()}, schema=pa.schema([(k, pa.binary() if isinstance(v, bytes) else pa.list_(pa.int64()) if isinstance(v, list) else pa.int64()) for k, v in row.items()]))

    return parts.groupBy("task").applyInArrow(run, _VOCABULARY)


def _loaded(rows: list[dict], code: Code, trained_only: bool) -> Words | None:
    """The words of some tasks, or those that occur in training.  Words of different tasks share no bytes beyond their
    depth, so each has the contexts that it has in its task alone."""
    words, counts, depth = [], [], []
    for row in rows:
        ends = np.cumsum(numbers(row["sizes"]).astype(np.int64))
        n = numbers(row["counts"], np.int64).reshape(-1, CLASSES)
        k = np.flatnonzero(n.sum(1)) if trained_only else np.arange(len(n))
        data, begins = row["names"], np.concatenate([[0], ends[:-1]])
        words += [data[a:b] for a, b in zip(begins[k].tolist(), ends[k].tolist(), strict=True)]
        counts.append(n[k])
        depth.append(np.frombuffer(row["depth"], np.uint8).astype(np.int64)[k])
    return Words(words, np.concatenate(counts), np.concatenate(depth), code) if words else None


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _tasks_together(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of the vocabulary whose words are walked together."""
    held: list[dict] = []
    for row in _rows(batches):
        if held and sum(r["m"] for r in held) + row["m"] > WORDS_WALKED:
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _sums(counted: DataFrame, total: int) -> np.ndarray:
    """(slot, bit) counts of all tasks, which travel in slices: first slot, counts."""

    def added(table: pa.Table) -> pa.Table:
        total = sum(numbers(x, np.int64) for x in table.column("n").to_pylist())
        return pa.table({"first": table.column("first").slice(0, 1), "n": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    out = np.zeros((total, 2), np.float32)
    for r in counted.groupBy("first").applyInArrow(added, "first long, n binary").collect():
        part = np.frombuffer(r["n"], np.float32).reshape(-1, 2)
        out[r["first"] : r["first"] + len(part)] = part
    return out


def _slices(out: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(out), TABLE_SLICE):
        part = out[k : k + TABLE_SLICE].ravel()
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([planes(part.astype(np.int64))], pa.binary())], ["first", "n"])


def _summed_tables(vocabulary: DataFrame, code: Code) -> np.ndarray:
    """(slot, bit) counts of all contexts within words.  Their size is fixed, however large the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((Layout.total, 2), np.int64)
        for rows in _tasks_together(batches):
            words = _loaded(rows, code, trained_only=True)
            if words is not None:
                count_tables(words, out, LEAD)
        yield from _slices(out)

    return _sums(vocabulary.select("m", "names", "sizes", "depth", "counts").mapInArrow(releasing(run), "first long, n binary"), Layout.total)


def _runs_of_leads(batches: Iterator[pa.RecordBatch], at_once: int) -> Iterator[tuple[Leads, np.ndarray]]:
    """Distinct leads of runs of texts, and how often they occur."""
    held: list[tuple[Leads, np.ndarray]] = []

    def merged() -> tuple[Leads, np.ndarray]:
        return distinct(Leads.joined([x for x, _ in held]), np.concatenate([n for _, n in held]))[1:]

    for batch in batches:
        for piece in pieces(batch.column(0), PIECE_BYTES):
            low = lowered(piece)
            held.append(distinct(text_leads(low, low.word_hashes()))[1:])
            if sum(len(n) for _, n in held) > at_once:
                held = [merged()]
                if len(held[0][1]) > at_once // 2:
                    yield held.pop()
    if held:
        yield merged()


def _lead_tables(texts: DataFrame, code: Code) -> np.ndarray:
    """(slot, bit) counts of all contexts of leads, over all training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((TOTAL, 2), np.int32)
        for leads, n in _runs_of_leads(batches, LEADS_AT_ONCE):
            count_leads(leads, n, code, out)
        yield from _slices(out)

    return _sums(texts.mapInArrow(releasing(run), "first long, n binary"), TOTAL)


def _averaged(learned: DataFrame, fold: int, new: Callable[[], Mixer]) -> Mixer:
    """The tasks' mixers, weights averaged by what they saw."""

    def added(table: pa.Table) -> pa.Table:
        w, c = (np.sum([np.frombuffer(x) for x in table.column(k).to_pylist()], axis=0) for k in ("weights", "cells"))
        return pa.table({"weights": [w.tobytes()], "cells": [c.tobytes()], "n": [float(sum(table.column("n").to_pylist()))]})

    found = learned.withColumn("_g", F.pmod(F.xxhash64("weights"), F.lit(fold))).groupBy("_g").applyInArrow(lambda t: added(t), _MIXERS).collect()
    mixer = new()
    if not found:
        return mixer
    n = sum(r["n"] for r in found)
    return Mixer(
        (sum(np.frombuffer(r["weights"]) for r in found) / n).reshape(mixer.weights.shape),
        sum(np.frombuffer(r["cells"]) for r in found).reshape(mixer.cells.shape),
    )


_MIXERS = "weights binary, cells binary, n double"


def _mixer_row(mixer: Mixer, n: float) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([(mixer.weights * n).tobytes()]), pa.array([mixer.cells.tobytes()]), pa.array([n])], ["weights", "cells", "n"])


def _learned(vocabulary: DataFrame, code: Code, tables, fold: int) -> Mixer:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, n, known = Mixer(), 0.0, Tables(tables.value)
        for rows in _tasks_together(batches):
            words = _loaded(rows, code, trained_only=True)
            if words is not None:
                learn_mixer(words, known, mixer, LEAD)
                n += float(len(words.sizes))
        if n:
            yield _mixer_row(mixer, n)

    return _averaged(vocabulary.select("m", "names", "sizes", "depth", "counts").mapInArrow(releasing(run), _MIXERS), fold, Mixer)


def _learned_leads(texts: DataFrame, code: Code, tables, fold: int) -> Mixer:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, total, known = new_mixer(), 0.0, LeadTables(tables.value)
        for leads, n in _runs_of_leads(batches, LEADS_AT_ONCE):
            learn_leads(leads, n, code, known, mixer)
            total += float(n.sum())
        if total:
            yield _mixer_row(mixer, total)

    return _averaged(texts.mapInArrow(releasing(run), _MIXERS), fold, new_mixer)


def _scored(vocabulary: DataFrame, code: Code, tables, mixer: Mixer) -> DataFrame:
    """Back to the blocks: numbers of words, log-probabilities of what follows their leads per class in LOG_UNITs, and their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tables(tables.value)
        for rows in _tasks_together(batches):
            words = _loaded(rows, code, trained_only=False)
            every = np.empty((len(words.sizes), CLASSES), np.int32)
            every[words.order] = np.ceil(-word_scores(words, known, mixer, LEAD) / LOG_UNIT)
            del words
            done = 0
            for row in rows:
                logs = every[done : done + row["m"]]
                done += row["m"]
                counts = numbers(row["counts"], np.int64).reshape(-1, CLASSES).sum(1)
                blocks, entries = numbers(row["block"], np.int64), numbers(row["entries"])
                number, word = numbers(row["number"]), numbers(row["word"])
                ends = np.cumsum(entries)
                for block, a, b in zip(blocks.tolist(), (ends - entries).tolist(), ends.tolist(), strict=True):
                    k = word[a:b]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block]), *(pa.array([x], pa.binary()) for x in (planes(number[a:b]), planes(logs[k].T.ravel()), planes(counts[k]))), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64())],
                        ["block", "number", "logs", "counts", "row", "like"],
                    )

    return vocabulary.mapInArrow(releasing(run), "block long, number binary, logs binary, counts binary, row long, like long")


def _like_texts(placed: DataFrame) -> DataFrame:
    """(row, like): for rows that share anchors with training texts, the one with which they share most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1).to_numpy()
            train = np.asarray(batch.column(2).to_numpy(zero_copy_only=False), bool)
            for piece in pieces(batch.column(0), PIECE_BYTES):
                low = lowered(piece)
                h = low.word_hashes()
                at = np.arange(max(len(h) - ANCHOR_WORDS + 1, 0))
                run_of = np.zeros(len(at), np.uint64)
                for k in range(ANCHOR_WORDS):
                    run_of = mix64(run_of * np.uint64(0xA0761D6478BD642F) + h[at + k])
                doc = np.repeat(np.arange(piece.rows), np.diff(low.word_bounds))
                k = np.flatnonzero((run_of % np.uint64(ANCHOR_EVERY) == 0) & (doc[at] == doc[at + ANCHOR_WORDS - 1]))
                keys = np.unique(np.stack([doc[k], run_of[k].view(np.int64)], 1), axis=0)
                where = piece.first_row + keys[:, 0]
                yield pa.RecordBatch.from_arrays([pa.array(keys[:, 1]), pa.array(rows[where]), pa.array(train[where])], ["anchor", "row", "train"])

    anchors = cut_lineage(placed.select("text", "row", "train").mapInArrow(releasing(run), "anchor long, row long, train boolean"))
    ends = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n"), F.min(F.when(F.col("train"), F.col("row"))).alias("_a"), F.max(F.when(F.col("train"), F.col("row"))).alias("_b"))
    shared = ends.where("_n > 1 and _a is not null").drop("_n")
    like = F.when(F.col("row") != F.col("_a"), F.col("_a")).when(F.col("row") != F.col("_b"), F.col("_b"))
    pairs = anchors.join(shared, "anchor").select("row", like.alias("like")).where("like is not null")
    votes = pairs.groupBy("row", "like").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy("row").agg(F.max(F.struct("n", "like")).alias("_best")).select("row", F.col("_best.like").alias("like"))


def _word_lists(column: pa.ChunkedArray) -> Iterator[Piece]:
    for chunk in column.chunks:
        yield from pieces(chunk, PIECE_BYTES)


def _scores(rows: pa.Table, known: pa.Table, prior: np.ndarray, base_total: float, of_leads: Callable[[Leads], np.ndarray] | None = None) -> pa.Table:
    """Scores of a block's rows from its words' log-probabilities, those of leads, and its rows' like texts."""
    names = ["doc_id", "train", "n_bytes", "n_tokens", "n_known", "base_score", "score"]
    own = np.asarray(rows.column("own").to_numpy(zero_copy_only=False), bool)
    others, rows = rows.filter(pa.array(~own)), rows.filter(pa.array(own))
    if not rows.num_rows:
        return pa.table([pa.array([], t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())], names=names)
    lows = [lowered(p) for p in _word_lists(rows.column("text"))]
    hashes = [p.word_hashes() for p in lows]
    like_of, like_words = {r["row"]: r["like"] for r in known.filter(pc.is_null(known.column("number"))).select(["row", "like"]).to_pylist()}, {}
    told_rows, at = others.column("row").to_pylist(), 0
    for p in _word_lists(others.column("text")):
        low = lowered(p)
        h, bounds = low.word_hashes(), low.word_bounds
        for k in range(p.rows):
            like_words[told_rows[at + k]] = h[bounds[k] : bounds[k + 1]]
        at += p.rows

    # Words are numbered by hash, as they were when they left; the like texts' other words have no number.
    n_words = sum(map(len, hashes))
    found, seen = pd.factorize(np.concatenate([*hashes, *like_words.values()]))
    end = int(found[:n_words].max(initial=-1)) + 1
    turn = np.full(len(seen), -1, np.int32)
    turn[np.argsort(seen[:end])] = np.arange(end)
    found = turn[found]
    codes_of, like_codes, at = found[:n_words], {}, n_words
    for row, h in like_words.items():
        like_codes[row] = found[at : at + len(h)]
        at += len(h)
    del seen, turn

    log, count, filled = np.zeros((end + 1, CLASSES)), np.zeros(end + 1, np.int64), np.zeros(end + 1, bool)
    for r in known.filter(pc.is_valid(known.column("number"))).select(["number", "logs", "counts"]).to_pylist():
        k = numbers(r["number"])
        if len(k) and int(k.max()) > end:
            raise ValueError("the rows of a block have changed between passes")
        log[k], count[k], filled[k] = numbers(r["logs"]).reshape(CLASSES, -1).T * -LOG_UNIT, numbers(r["counts"], np.int64), True
    if not filled.all():
        raise ValueError("the rows of a block have changed between passes")
    base = np.log10(count + 1.0) - base_total
    lead_of, words_done = np.zeros(end + 1, np.uint32), 0
    # Leads after the same word are scored once in a block.
    lead_numbers, lead_parts = [], []
    for low, h in zip(lows, hashes, strict=True):
        own_leads = word_leads(low)
        lead_of[codes_of[words_done : words_done + len(h)]] = own_leads
        words_done += len(h)
        number, part, _ = distinct(text_leads(low, h, own_leads))
        lead_numbers.append(number.astype(np.int32))
        lead_parts.append(part)
    lead_places = np.cumsum([0, *map(len, lead_parts)])
    in_block, leads, _ = distinct(Leads.joined(lead_parts))
    lead_log, lead_keys = of_leads(leads), leads.keys()
    lead_turn = np.argsort(lead_keys)
    lead_keys = lead_keys[lead_turn]
    del lead_parts
    # How frequent a word is, by its training count; the last number is for words that are not the block's.
    frequency = np.append(np.clip(np.floor(base * (-math.log(10) / 2.5)), 0, FREQUENCIES - 2).astype(np.int64), FREQUENCIES - 1)
    row_of = rows.column("row").to_pylist()
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    done = words_done = 0
    none = np.zeros(0, np.uint64), np.zeros(0, np.int32)
    for piece, (low, h) in enumerate(zip(lows, hashes, strict=True)):
        number = in_block[lead_places[piece] + lead_numbers[piece]]
        bounds, docs = low.word_bounds, low.rows
        code = codes_of[words_done : words_done + len(h)]
        words_done += len(h)
        n = np.diff(bounds)
        # Every text's words and end, after the words of its like text; without words before it a text has nothing to match.
        likes = [like_of.get(row_of[done + k]) for k in range(docs)]
        told = [(like_words[x], like_codes[x]) if x in like_words else none for x in likes]
        before = np.array([len(x) for x, _ in told], np.int64)
        size = before + n + 1
        begin = np.cumsum(size) - size
        owner = np.repeat(np.arange(docs), size)
        place = np.arange(len(owner)) - begin[owner]
        is_own = place >= before[owner]
        place -= np.where(is_own, before[owner], 0)
        tokens, codes = np.zeros(len(owner), np.uint64), np.full(len(owner), end, np.int32)
        words = np.flatnonzero(is_own)
        words = words[place[words] < n[owner[words]]]
        tokens[words], codes[words] = h, code
        rest_of = np.flatnonzero(~is_own)
        tokens[rest_of], codes[rest_of] = np.concatenate([x for x, _ in told]), np.concatenate([x for _, x in told])
        at, s, hit, p = match_bits(tokens, place, owner, is_own, frequency[codes], docs)
        doc, own = owner[at], codes[at]
        paid = np.zeros(len(owner))
        paid[is_own] = lead_log[number]
        # Without a hit, the word is any but the candidate, if that is a word of the block.
        instead = np.where(hit[:, None], log[own] + paid[at][:, None], 0.0)
        other = np.flatnonzero(~hit & (codes[s] >= 0))
        behind = leads.take(number[place[at[other]] + (bounds[:-1] + np.arange(docs))[doc[other]]])
        asked = Leads(behind.before, behind.back, lead_of[codes[s[other]]])
        keys = asked.keys()
        found_at = np.minimum(np.searchsorted(lead_keys, keys), len(lead_keys) - 1)
        chance, new = lead_log[lead_turn[found_at]], np.flatnonzero(lead_keys[found_at] != keys)
        if len(new):
            turn_of, missing, _ = distinct(asked.take(new))
            chance[new] = of_leads(missing)[turn_of]
        instead[other] = np.log1p(-np.minimum(np.exp(chance[:, None] + log[codes[s[other]]]), 0.999))
        each = np.concatenate([log[code], np.zeros((1, CLASSES))])
        sums = np.add.reduceat(each, np.minimum(bounds[:-1], len(code)), axis=0) * (n > 0)[:, None] + log[end]
        bits = np.bincount(doc, np.log(np.where(hit, p, 1 - p)), docs) + np.bincount(owner, paid, docs)
        per = np.stack([sums[:, c] - np.bincount(doc, instead[:, c], docs) + prior[c] for c in range(CLASSES)])
        of = np.repeat(np.arange(docs), n)
        out[0].append(np.diff(low.offsets))
        out[1].append(n + 1)
        out[2].append(np.bincount(of, count[code] > 0, docs).astype(np.int64) + int(count[end] > 0))
        out[3].append(np.bincount(of, base[code], docs) + base[end])
        out[4].append((np.logaddexp.reduce(per, axis=0) + bits) / math.log(10))
        done += docs
    return pa.table([rows.column("doc_id"), rows.column("train"), *(pa.array(np.concatenate(x)) for x in out)], names=names)


def score_texts(docs: DataFrame, learn_from: Column) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, n_known, train_tokens, base_score, score (base-10 logs), bits_per_byte."""
    spark = docs.sparkSession
    placed = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), learn_from.alias("train"), F.monotonically_increasing_id().alias("row")
    )
    survey = _survey(placed)
    summary = survey.groupBy("kind").agg(F.sum("n"), F.count(F.lit(1)), F.sum("pieces")).collect()
    seen = {r[0]: r[1:] for r in summary}
    distinct, spread = (SAMPLED * int(seen.get(1, (0, 0, 0))[k]) for k in (1, 2))
    rows = docs.count()
    block_rows = max(1, min(BLOCK_ROWS, int(BLOCK_BYTES * rows / max(1, int(seen[2][0] if 2 in seen else 1)))))
    placed = placed.withColumn("block", F.floor(F.col("row") / block_rows).cast("long"))
    tasks = max(1, distinct // TASK_WORDS, spread // 2 // TASK_ENTRIES)
    hot = []
    for s in ("s0", "s1"):
        many = survey.where("kind = 1").groupBy(s).agg(F.count(F.lit(1)).alias("c")).where(F.col("c") * SAMPLED > HOT_WORDS).select(s).collect()
        hot.append(np.isin(np.arange(PREFIX_SLOTS), [r[0] for r in many]))
    frequent = survey.where("kind = 0").orderBy(F.desc("n"), "word").limit(TOP_WORDS).select("word").collect()
    top = np.sort(np.array([r[0] for r in frequent], np.int64).view(np.uint64))
    letters = np.zeros(256)
    for r in survey.where("kind = 3").select("word", "n").collect():
        letters[r[0]] = r[1]
    code = Code(letters)
    label = _word_classes(placed.where("train").select("text"), top) if len(top) else np.zeros(0, np.int64)

    parts = _block_words(placed, top, label, hot, tasks).repartition(min(tasks, 4096), "task")
    vocabulary = cut_lineage(_vocabulary(parts))
    totals = vocabulary.agg(F.sum("known"), *[F.sum(F.col("totals")[c]) for c in range(CLASSES)]).first()
    v, by_class = int(totals[0] or 0), np.array([float(x or 0) for x in totals[1:]])
    n = int(by_class.sum())
    tables = spark.sparkContext.broadcast(_summed_tables(vocabulary, code))
    mixer = _learned(vocabulary, code, tables, max(1, math.isqrt(tasks)))
    learning = placed.where("train").select("text")
    lead_tables = spark.sparkContext.broadcast(_lead_tables(learning, code))
    lead_mixer = _learned_leads(learning, code, lead_tables, max(1, math.isqrt(learning.rdd.getNumPartitions())))

    likes = cut_lineage(_like_texts(placed))
    pairs = likes.count()
    small = F.broadcast if pairs <= BROADCAST_ROWS else (lambda x: x)
    by_block = likes.withColumn("block", F.floor(F.col("row") / block_rows).cast("long"))
    needs = by_block.select(F.col("like").alias("row"), F.col("block").alias("_to")).distinct()
    told = placed.join(small(needs), "row").select(F.col("_to").alias("block"), "row", "doc_id", "train", "text", F.lit(False).alias("own"))
    texts = placed.select("block", "row", "doc_id", "train", "text", F.lit(True).alias("own")).unionByName(told)
    none = F.lit(None)
    known = _scored(vocabulary, code, tables, mixer).unionByName(
        by_block.select("block", none.cast("binary").alias("number"), none.cast("binary").alias("logs"), none.cast("binary").alias("counts"), "row", "like")
    )
    prior = np.log((by_class + 1) / (by_class + 1).sum())
    base_total = math.log10(n + v + 1)
    blocks = max(1, -(-rows // block_rows))

    held: list[LeadTables] = []

    def of_leads(leads: Leads) -> np.ndarray:
        if not held:
            held.append(LeadTables(lead_tables.value))
        return lead_scores(leads, code, held[0], lead_mixer)

    def total(a: pa.Table, b: pa.Table) -> pa.Table:
        found = _scores(a, b, prior, base_total, of_leads)
        release_memory()
        return found

    return (
        texts.repartition(min(blocks, 20_000), "block").groupBy("block")
        .cogroup(known.repartition(min(blocks, 20_000), "block").groupBy("block"))
        .applyInArrow(total, "doc_id long, train boolean, n_bytes long, n_tokens long, n_known long, base_score double, score double")
        .withColumn("train_tokens", F.lit(n).cast("long"))
        .withColumn("bits_per_byte", -F.col("score") * math.log2(10) / F.greatest(F.col("n_bytes"), F.lit(1)))
    )
