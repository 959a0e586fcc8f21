"""Exact removal of repeated byte strings: suffix arrays over what may repeat, merged across shards.

A string of ``span`` bytes that starts in two places repeats.  Suffix arrays find them, but most bytes of a
corpus repeat nowhere; an exact sieve keeps those out.  Every window of ``span`` bytes names an anchor: the
leftmost of its GRAM-byte strings (a quarter of a shorter window) with the least hash.  Equal windows have equal anchors, so only windows
whose anchor hash occurs again somewhere can repeat.  The windows of one anchor are consecutive; their bytes
make a segment.  Segments that are equal as a whole repeat as a whole and are settled by counting.  Anchors
with different segments go on: one copy of each distinct segment is placed in a shard with all others of
its anchor.

Each shard builds a suffix array (Larsson-Sadakane refinement) and common prefixes (Kasai); windows in one
run of common prefixes of ``span`` bytes or more are equal.  An anchor with very many distinct segments is
dealt over several shards; each then publishes, sorted, the 64-bit hashes of the windows of that anchor,
and a merge looks every shard's windows up in the others' by binary search.

Defined cases: null text has no bytes; a text shorter than ``span`` keeps all; repeated rows are copies of
each other, so their long texts go entirely; cuts may split a character, so what is kept is binary; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import cut_lineage, releasing
from pageloom.llm.passages import TEXT_KEY, ranges_of, shared_passages, sieve, sliding_least, slot, text_key
from pageloom.llm.suffixes import common_prefixes, suffix_array
from pageloom.llm.textops import pieces, prefix_hashes, repeat_ranges, span_hashes

SPAN = 400
GRAM = 96
#: Window starts handled at once; only one longer text is cut there.
STEP = 3 << 20
#: Bytes of segments that a shard's suffix array has, about, and distinct segments of an anchor per shard.
SHARD_BYTES, SHARD_SEGMENTS = 1_000_000, 1200
#: Windows that a merge looks at, about, and the parts that a shard's windows are cut into at most.
MERGE_WINDOWS, MERGE_PARTS = 500_000, 200


def gram_of(span: int) -> int:
    """Bytes of an anchor: long enough that lines which many texts share name none, short against the window."""
    return min(GRAM, max(span // 4, 1))


def segments(data: np.ndarray, offsets: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """(document, anchor hash, segment hash, first start, last start) with starts relative to the document."""
    found: list[tuple[np.ndarray, ...]] = []
    gram = gram_of(span)
    for at in range(0, max(1, len(data) - span + 1), STEP):
        part = data[at : at + STEP + span - 1]
        if len(part) < span:
            break
        prefix = prefix_hashes(part)
        grams = np.arange(len(part) - gram + 1)
        hashes = span_hashes(prefix, grams, grams + gram)
        keys = (hashes & ~np.uint64((1 << 24) - 1)) | grams.astype(np.uint64)
        anchor = (sliding_least(keys, span - gram + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
        starts = np.arange(len(anchor)) + at
        doc = np.searchsorted(offsets, starts, "right") - 1
        valid = starts + span <= offsets[doc + 1]
        starts, doc, anchor = starts[valid], doc[valid], anchor[valid]
        if not len(starts):
            continue
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:] - 1, [len(starts) - 1]])
        whole = span_hashes(prefix, starts[first] - at, starts[last] - at + span)
        base = offsets[doc[first]]
        found.append((doc[first], hashes[anchor[first]].view(np.int64), whole.view(np.int64), starts[first] - base, starts[last] - base))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _anchored(docs: DataFrame, span: int) -> DataFrame:
    """Segments of every row: doc_id, text key, anchor, segment, first and last start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(2)):
                doc, anchor, segment, first, last = segments(piece.data, piece.offsets, span)
                rows = pa.array(doc + piece.first_row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(anchor), pa.array(segment), pa.array(first), pa.array(last)],
                    ["doc_id", "text_key", "anchor", "segment", "first", "last"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), "text").where(F.octet_length("text") >= span)
    return rows.mapInArrow(releasing(run), f"doc_id long, {TEXT_KEY}, anchor long, segment long, first long, last long")


def repeated_starts(segments_: list[bytes], windows: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, start, class) of every window; windows with one class are equal."""
    sizes = np.array([len(s) for s in segments_], np.int64)
    text = np.frombuffer(b"".join(segments_), np.uint8)
    base = np.cumsum(sizes) - sizes
    # Sorted to the last byte: Kasai's rule does not hold among ties.
    sa = suffix_array(text, len(text))
    run = np.cumsum(common_prefixes(text, sa, span) < span)
    kind = np.empty(len(text), np.int64)
    kind[sa] = run
    at = repeat_ranges(base, windows)
    owner = np.repeat(np.arange(len(segments_)), windows)
    return owner, at - base[owner], kind[at]


_MARKS = "anchor long, segment long, lo long, hi long, shard string, part long, windows binary"
_NAMES = ["anchor", "segment", "lo", "hi", "shard", "part", "windows"]
#: A published window: its hash, and the segment and start it stands for.
_WINDOW = np.dtype([("hash", "<u8"), ("segment", "<i8"), ("start", "<i8")])


def _mark_table(anchor, segment, lo, hi) -> pa.Table:
    n = len(anchor)
    columns = [pa.array(x, pa.int64()) for x in (anchor, segment, lo, hi)]
    return pa.table([*columns, pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], names=_NAMES)


def _published(anchor: int, shard: str, parts: int, windows: np.ndarray) -> pa.Table:
    """An anchor's windows in one shard, sorted by hash and cut at even hash bounds: one row per part."""
    windows = np.sort(windows, order="hash")
    bounds = np.searchsorted(windows["hash"], np.array([(k << 64) // parts for k in range(parts)], np.uint64))
    bounds = np.append(bounds, len(windows))
    own = [k for k in range(parts) if bounds[k] < bounds[k + 1]]
    none = pa.nulls(len(own), pa.int64())
    return pa.table(
        [pa.array([anchor] * len(own), pa.int64()), none, none, none, pa.array([shard] * len(own)), pa.array(own, pa.int64()), pa.array([windows[bounds[k] : bounds[k + 1]].tobytes() for k in own], pa.binary())],
        names=_NAMES,
    )


def _sharded(parts: DataFrame, span: int) -> DataFrame:
    """Per shard: ranges of starts that repeat within it; for split anchors also all their windows, published."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        anchor, segment, split = (table.column(c).to_numpy() for c in ("anchor", "segment", "parts"))
        data = table.column("bytes").to_pylist()
        windows = np.array([len(s) - span + 1 for s in data], np.int64)
        owner, start, kind = repeated_starts(data, windows, span)
        often = np.bincount(kind, minlength=int(kind.max()) + 1)
        again = often[kind] > 1
        o, lo, hi = ranges_of(owner[again], start[again])
        out = [_mark_table(anchor[o], segment[o], lo, hi)]
        # A split anchor has a shard to itself, or rather several.
        if split[0]:
            found = []
            for k, s in enumerate(data):
                w = np.empty(windows[k], _WINDOW)
                at = np.arange(windows[k])
                w["hash"], w["segment"], w["start"] = span_hashes(prefix_hashes(np.frombuffer(s, np.uint8)), at, at + span), segment[k], at
                found.append(w)
            out.append(_published(int(anchor[0]), table.column("shard")[0].as_py(), int(split[0]), np.concatenate(found)))
        return pa.concat_tables(out)

    return parts.groupBy("shard").applyInArrow(run, _MARKS)


def _merged(published: DataFrame) -> DataFrame:
    """Windows of split anchors that another shard has too, found by binary search in the others' sorted hashes."""

    def run(table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(w, _WINDOW) for w in table.column("windows").to_pylist()]
        hit = []
        for k, own in enumerate(lists):
            elsewhere = np.zeros(len(own), bool)
            for other in lists[:k] + lists[k + 1 :]:
                at = np.minimum(np.searchsorted(other["hash"], own["hash"]), len(other) - 1)
                elsewhere |= other["hash"][at] == own["hash"]
            hit.append(own[elsewhere])
        found = np.sort(np.concatenate(hit), order=("segment", "start"))
        segment, lo, hi = ranges_of(found["segment"], found["start"])
        return _mark_table(np.full(len(segment), table.column("anchor")[0].as_py()), segment, lo, hi)

    return published.groupBy("anchor", "part").applyInArrow(run, _MARKS)


def _united(ranges: list[dict] | None) -> list[list[int]]:
    """Sorted ranges that overlap or touch, as one."""
    runs: list[list[int]] = []
    for r in ranges or ():
        if runs and r["start"] <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], r["end"])
        else:
            runs.append([r["start"], r["end"]])
    return runs


def remove_repeats(docs: DataFrame, span: int = SPAN, passage: int | None = None) -> DataFrame:
    """doc_id, n_bytes, spans (maximal removed runs: start, end) and kept (the other bytes) of every row.

    With ``passage`` also ``passages``: the runs of words (start, end) in which every ``passage`` words stand in another
    row too.  They are reported only; what is removed follows ``span`` alone.
    """
    found = cut_lineage(_anchored(docs, span))
    distinct = found.groupBy("anchor", "segment").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_key", "first", "last")).alias("at")
    )
    per_anchor = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("total")).where("total > 1")
    contested = cut_lineage(distinct.join(per_anchor, "anchor"))
    whole = contested.where("n > 1").select("anchor", "segment", F.lit(0).cast("long").alias("lo"), (F.col("at.last") - F.col("at.first")).alias("hi"))

    # One copy of each distinct segment of a contested anchor, placed in the shard of its anchor.
    several = contested.where("kinds > 1")
    total = several.agg(F.sum(F.col("at.last") - F.col("at.first") + span)).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD_BYTES))
    parts_of = F.ceil(F.col("kinds") / SHARD_SEGMENTS)
    wanted = several.select(
        "anchor", "segment", F.col("at.doc_id").alias("doc_id"), F.col("at.text_key").alias("text_key"), F.col("at.first").alias("first"), F.col("at.last").alias("last"),
        F.when(parts_of > 1, F.least(F.lit(MERGE_PARTS), F.ceil(F.col("kinds") * (span - gram_of(span)) / 2 / MERGE_WINDOWS))).otherwise(F.lit(0)).cast("long").alias("parts"),
        F.when(parts_of > 1, F.concat_ws(":", F.lit("p"), "anchor", F.pmod("segment", parts_of.cast("long"))))
        .otherwise(F.concat(F.lit("s"), F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("string"))).alias("shard"),
    )
    per_text = wanted.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("anchor", "segment", "first", "last", "parts", "shard")).alias("cuts"))
    texts = docs.select(F.col("doc_id").cast("long"), text_key().alias("text_key"), "text").where(F.octet_length("text") >= span)
    texts = texts.join(sieve(wanted, "text_key"), slot("text_key") == F.col("_slot"), "left_semi")
    one = (
        texts.join(per_text, (texts["text_key"] == per_text["text_key"]) & texts["doc_id"].eqNullSafe(per_text["doc_id"]))
        .select("text", F.explode("cuts").alias("c"))
        .select("c.*", F.substring(F.col("text").cast("binary"), F.col("c.first").cast("int") + 1, (F.col("c.last") - F.col("c.first")).cast("int") + span).alias("bytes"))
        .dropDuplicates(["shard", "anchor", "segment"])
        .select("shard", "anchor", "segment", "parts", "bytes")
    )
    sharded = cut_lineage(_sharded(one, span))
    marks = whole.union(sharded.where("windows is null").select("anchor", "segment", "lo", "hi")).union(
        _merged(sharded.where("windows is not null")).select("anchor", "segment", "lo", "hi")
    )
    pair = lambda a, b: F.struct(a.alias("start"), b.alias("end"))
    removed = (
        found.join(marks, ["anchor", "segment"])
        .groupBy("text_key")
        .agg(F.array_sort(F.collect_set(pair(F.col("first") + F.col("lo"), F.col("first") + F.col("hi") + span))).alias("ranges"))
        .select(F.col("text_key").alias("_key"), "ranges")
    )
    if passage is not None:
        told = shared_passages(docs, passage).withColumnRenamed("text_key", "_key")
        removed = removed.join(told, "_key", "full")
    else:
        removed = removed.withColumn("passages", F.lit(None).cast(removed.schema["ranges"].dataType))
    removed = cut_lineage(removed)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            ranges, passages = (batch.column(c).to_pylist() for c in (2, 3))
            sizes, spans, kept, told = [], [], [], []
            for piece in pieces(batch.column(1)):
                for k in range(piece.rows):
                    text = piece.data[piece.offsets[k] : piece.offsets[k + 1]]
                    runs = _united(ranges[piece.first_row + k])
                    told.append([{"start": a, "end": b} for a, b in _united(passages[piece.first_row + k])])
                    edges = [0, *(x for r in runs for x in r), len(text)]
                    kept.append(b"".join(text[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2], strict=True)))
                    sizes.append(len(text))
                    spans.append([{"start": a, "end": b} for a, b in runs])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(item)), pa.array(kept, pa.binary()), pa.array(told, pa.list_(item))], ["doc_id", "n_bytes", "spans", "kept", "passages"])

    every = docs.select(F.col("doc_id").cast("long"), "text", text_key().alias("_text_key"))
    slots = sieve(removed, "_key")
    untouched = every.join(slots, slot("_text_key") == F.col("_slot"), "left_anti").select("doc_id", "text", *[F.lit(None).cast(removed.schema[c].dataType).alias(c) for c in ("ranges", "passages")])
    touched = (
        every.join(slots, slot("_text_key") == F.col("_slot"), "left_semi")
        .join(removed, F.col("_text_key") == F.col("_key"), "left")
        .select("doc_id", "text", "ranges", "passages")
    )
    runs = "array<struct<start:long,end:long>>"
    out = untouched.union(touched).mapInArrow(releasing(cut), f"doc_id long, n_bytes long, spans {runs}, kept binary, passages {runs}")
    return out if passage is not None else out.drop("passages")
