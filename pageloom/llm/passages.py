"""Passages of words that stand in several documents, and what finding repeats shares.

Every run of ``words`` words is a window.  It names an anchor: the leftmost of its GRAM_WORDS-word strings with the least
hash.  Equal windows have equal anchors, so only windows under an anchor that occurs in different texts can repeat;
a first pass sends anchors alone, a second the windows' hashes of texts that share one.  Windows under an anchor of very
many texts are combined where they are and dealt in parts, so no anchor is one task's.

Defined cases: a text with fewer words has no passage; null texts have none; texts that are equal share all their words;
words are compared as they are written, whatever white space stands between them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import cut_lineage, releasing
from pageloom.llm.textops import Piece, mix64, pieces, power_tables, repeat_ranges

GRAM_WORDS = 16
TEXT_KEY = "text_key struct<a:long,b:long>"
#: Slots of the sieve that keeps texts without repeats out of shuffles: a bound on what is broadcast.
SIEVE_SLOTS = 1 << 20
#: Windows handled at once; only one longer text is cut there.
STEP = 1 << 22
#: Windows that a task compares, about, and texts under one anchor from which its windows are dealt out.
TASK_WINDOWS, HOT_TEXTS = 400_000, 20_000
#: Shared anchors up to this many are sent to every task.
BROADCAST_ANCHORS = 500_000


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive keys, by running minima from both block ends."""
    n = len(keys) - width + 1
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def text_key(text: Column | str = "text") -> Column:
    """What stands for a text: 128 bits of hash."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def slot(key: str) -> Column:
    return F.pmod(F.col(f"{key}.a"), F.lit(SIEVE_SLOTS)).cast("int")


def sieve(rows: DataFrame, key: str) -> DataFrame:
    """The sieve: slots that any of the keys falls into, SIEVE_SLOTS rows at most, so safe to broadcast."""
    return F.broadcast(rows.select(slot(key).alias("_slot")).distinct())


def ranges_of(owner: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive starts of an owner as (owner, first, last)."""
    if not len(owner):
        return owner, start, start
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)]))
    last = np.concatenate([new[1:] - 1, [len(owner) - 1]])
    return owner[new], start[new], start[last]


def word_strings(hashes: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of every ``width`` consecutive words."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    power, inverse = power_tables(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix64(hashes + np.uint64(3)) * power[: len(hashes)], out=sums[1:])
    n = len(hashes) - width + 1
    return mix64((sums[width:] - sums[:n]) * inverse[:n])


def windows(piece: Piece, words: int) -> tuple[np.ndarray, ...]:
    """(document, anchor, first window, last window, hashes of all windows): runs of windows with one anchor; window
    numbers count within the document, and the hashes follow each other run by run."""
    h, bounds, gram = piece.word_hashes(), piece.word_bounds, min(GRAM_WORDS, words)
    found = [tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)]
    place = np.uint64((1 << 24) - 1)
    for at in range(0, len(h) - words + 1, STEP):
        part = h[at : at + STEP + words - 1]
        grams = word_strings(part, gram)
        keys = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
        anchor = (sliding_least(keys, words - gram + 1) & place).astype(np.int64)
        starts = np.arange(len(anchor)) + at
        doc = np.searchsorted(bounds, starts, "right") - 1
        valid = np.flatnonzero(starts + words <= bounds[doc + 1])
        if not len(valid):
            continue
        starts, doc, anchor = starts[valid], doc[valid], anchor[valid]
        # By the anchor's hash, not its place: words that go round and round are one run.
        anchor = grams[anchor].view(np.int64)
        first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]))
        last = np.concatenate([first[1:] - 1, [len(starts) - 1]])
        base = bounds[doc[first]]
        found.append((doc[first], anchor[first], starts[first] - base, starts[last] - base, word_strings(part, words)[starts - at]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def shared_passages(docs: DataFrame, words: int = 50) -> DataFrame:
    """(text_key, passages): for texts that have any, the word ranges (start, end), sorted, of which every ``words`` words
    stand in another row."""
    rows = docs.select(text_key().alias("text_key"), "text").where(F.col("text").isNotNull())

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(1)):
                doc, anchor, *_ = windows(piece, words)
                count = np.maximum(np.diff(piece.word_bounds) - words + 1, 0)
                # One row more per text, without an anchor, with how many windows it has: for texts that are equal.
                whole = np.flatnonzero(count)
                at = pa.array(piece.first_row + np.concatenate([doc, whole]))
                none = np.concatenate([np.zeros(len(doc), bool), np.ones(len(whole), bool)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), pa.array(np.concatenate([anchor, count[whole]])), pa.array(none)], ["text_key", "anchor", "whole"]
                )

    found = cut_lineage(rows.mapInArrow(releasing(anchors), f"{TEXT_KEY}, anchor long, whole boolean"))
    copies = found.where("whole").groupBy("text_key", "anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = copies.select("text_key", F.lit(0).cast("long").alias("lo"), (F.col("anchor") - 1).alias("hi"))
    named = found.where("not whole").select("anchor", F.col("text_key.a").alias("a"))
    per_anchor = named.groupBy("anchor").agg(F.min("a").alias("_a"), F.max("a").alias("_b"), F.count(F.lit(1)).alias("texts"))
    shared = cut_lineage(per_anchor.where("_a <> _b").select("anchor", "texts"))
    # Joined where they are while they are few, by a shuffle beyond.
    anchors_shared, total, most = shared.agg(F.count(F.lit(1)), F.sum("texts"), F.max("texts")).first()
    small = F.broadcast(shared) if anchors_shared <= BROADCAST_ANCHORS else shared
    sharing = cut_lineage(found.where("not whole").join(small, "anchor", "left_semi").select("text_key").distinct())

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            # Copies are looked at once a task.
            keys = list(zip(*(batch.column(0).field(c).to_pylist() for c in (0, 1)), strict=True))
            fresh = []
            for k, key in enumerate(keys):
                if key not in seen:
                    seen.add(key)
                    fresh.append(k)
            batch = batch.take(pa.array(fresh, pa.int64()))
            for piece in pieces(batch.column(1)):
                doc, anchor, first, last, codes = windows(piece, words)
                ends = np.concatenate([[0], np.cumsum(last - first + 1) * 8]).astype(np.int32)
                blobs = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(codes.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(piece.first_row + doc)), pa.array(anchor), pa.array(first), blobs], ["text_key", "anchor", "first", "windows"])

    texts = rows.join(sieve(sharing, "text_key"), slot("text_key") == F.col("_slot"), "left_semi")
    met = texts.mapInArrow(releasing(hashes), f"{TEXT_KEY}, anchor long, first long, windows binary").join(small, "anchor")
    tasks = max(1, int(total or 0) * words // 4 // TASK_WINDOWS + 1)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of hot anchors, combined before they are dealt: of a window that two texts of this task have, no third one is
        sent on, it is a mark at once; what is sent on goes to as many parts as the anchor needs, by the windows' hashes."""
        names = ["text_key", "anchor", "first", "last", "windows"]
        seen: dict[int, tuple[int, int] | None] = {}
        for batch in batches:
            count = batch.column(4).to_numpy()
            hot = count > HOT_TEXTS
            calm = batch.filter(pa.array(~hot))
            yield pa.RecordBatch.from_arrays([calm.column(0), calm.column(1), calm.column(2), calm.column(2), calm.column(3)], names)
            out: list[tuple[int, int, int, int, bytes | None]] = []
            for k in np.flatnonzero(hot).tolist():
                key, anchor, first = batch.column(0)[k].as_py(), int(batch.column(1)[k].as_py()), int(batch.column(2)[k].as_py())
                text, codes = (key["a"], key["b"]), np.frombuffer(batch.column(3)[k].as_py(), np.uint64)
                sent = np.zeros(len(codes), bool)
                for i, code in enumerate(codes.tolist()):
                    other = seen.setdefault(code, text)
                    sent[i] = other is not None
                    if sent[i] and other != text:
                        seen[code] = None
                part = np.where(sent, (codes % np.uint64(-(-int(count[k]) // HOT_TEXTS))).astype(np.int64), -1)
                begin = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])).tolist()
                for x, y in zip(begin, [*begin[1:], len(codes)], strict=True):
                    to = int(mix64(np.array([anchor], np.int64).view(np.uint64) + np.uint64(part[x]))[0].view(np.int64)) if part[x] >= 0 else text[0]
                    out.append((k, to, first + x, first + y - 1, codes[x:y].tobytes() if part[x] >= 0 else None))
            if out:
                rows_of, to, lo, hi, blobs = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows_of, pa.int64())), *(pa.array(x, pa.int64()) for x in (to, lo, hi)), pa.array(blobs, pa.binary())], names)

    def repeated(table: pa.Table) -> pa.Table:
        """Windows that two texts have, as ranges of each text; marks are passed on."""
        told = table.filter(pc.is_null(table.column("windows"))).select(["text_key", "first", "last"]).rename_columns(["text_key", "lo", "hi"])
        table = table.filter(pc.is_valid(table.column("windows"))).combine_chunks()
        if not table.num_rows:
            return told
        key = table.column("text_key").combine_chunks()
        codes = [np.frombuffer(w, np.uint64) for w in table.column("windows").to_pylist()]
        size, first = np.array([len(c) for c in codes]), table.column("first").to_numpy()
        row = np.repeat(np.arange(len(size)), size)
        code, start = np.concatenate(codes), repeat_ranges(first, size)
        a, b = (key.field(c).to_numpy() for c in (0, 1))
        _, text = np.unique(np.stack([a, b], 1), axis=0, return_inverse=True)
        text = text.ravel()[row]
        order = np.lexsort((text, code))
        code, text, row, start = code[order], text[order], row[order], start[order]
        group = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1], [True]]))
        several = np.repeat(text[group[:-1]] != text[group[1:] - 1], np.diff(group))
        text, row, start = text[several], row[several], start[several]
        order = np.lexsort((start, text))
        owner, lo, hi = ranges_of(text[order], start[order])
        at = np.zeros(int(text.max(initial=-1)) + 1, np.int64)
        at[text] = row
        found = pa.table([key.take(pa.array(at[owner])), pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], names=["text_key", "lo", "hi"])
        return pa.concat_tables([told, found.cast(told.schema)])

    met = met.select("text_key", "anchor", "first", "windows", "texts")
    if (most or 0) > HOT_TEXTS:
        met = met.mapInArrow(releasing(split), f"{TEXT_KEY}, anchor long, first long, last long, windows binary")
    else:
        met = met.withColumn("last", F.col("first"))
    dealt = met.select("text_key", F.pmod(F.xxhash64("anchor"), F.lit(tasks)).alias("task"), "first", "last", "windows")
    marks = dealt.groupBy("task").applyInArrow(repeated, f"{TEXT_KEY}, lo long, hi long").unionByName(copies)
    run = F.struct(F.col("lo").alias("start"), (F.col("hi") + words).alias("end"))
    return marks.groupBy("text_key").agg(F.array_sort(F.collect_set(run)).alias("passages"))
