"""N-gram Jaccard join: all pairs of texts whose shingle sets reach a similarity, by grouped prefix join.

Sets are put in one global order, frequent shingles last.  Two sets of similarity t share an element among
their first n - ceil(t n) + 1.  Sets with the same prefix and size form one group, which stands for its
members in the candidate step.  Groups that meet under a prefix element are filtered in pairs by size and by
bitmap: bit h mod B of a set's bitmap is the parity of its elements there, so two bitmaps differ in at most
as many bits as the sets have unshared elements, and pairs that differ in more cannot link.  What passes is
kept as a spanning forest.  Under an element with more than ``BUCKET_GROUPS`` groups, and for groups with several
distinct sets, the filter is skipped and groups are linked to the least group there instead, which is looser
but needs one row each.

Connected candidate groups are then expanded into their distinct member sets and verified, each within a
task: small families share tasks, large ones are cut by set size into blocks of bounded count, and every
two blocks whose sizes allow a link meet once.  In a task, sets come in ascending size, prefix elements
in the task's own order of rarity give candidates, and only candidates of another component so far are
intersected.  What leaves a task is a spanning forest of the links it found, so links of equal sets or
within a family never multiply.

The order needs frequent elements only roughly: every partition reports what repeats within it and the
``FREQUENT`` most frequent are kept.  The result does not depend on which they are.

Equal sets are one node (a 64-bit key), so copies add rows but no work.

Defined cases: a text with fewer words than the shingle is one shingle; null or wordless texts have no set,
link to nothing and are their own component; repeated rows share a component; two texts under one doc_id
count as linked; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.llm.common import cut_lineage, releasing
from pageloom.llm.components import components
from pageloom.llm.textops import Piece, lowered, mix64, pieces, repeat_ranges

#: Elements of the order that are put last for being frequent: a bound on what tasks are sent.
FREQUENT = 1 << 17
#: Shingles among which a partition looks for repeats at a time, and the repeats that count.
REPEAT_WINDOW, REPEATS = 2_000_000, 3
#: Groups under one element that are compared with each other.
BUCKET_GROUPS = 2000
#: Elements a set may have per 512 bits of its bitmap.
BITMAP_WORDS, BITMAP_LOAD = 8, 900
#: Rows of (element, group) that a task compares.
MEETINGS_PER_TASK = 50_000
#: Sets verified by one task against each other.
BLOCK_SETS = 1500
#: Candidate rows up to this many are sent to every task; beyond, the join shuffles.
BROADCAST_ROWS = 500_000

_ORDER_BITS = 52
_SECOND = np.uint64(0xA0761D6478BD642F)


def shingles(piece: Piece, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, 64-bit hash) of every shingle of a piece's lower-cased texts."""
    low = lowered(piece)
    h = low.word_hashes()
    bounds = low.word_bounds
    counts = np.diff(bounds)
    full = np.where(counts >= width, counts - width + 1, 0)
    at = repeat_ranges(bounds[:-1], full)
    gram = np.zeros(len(at), np.uint64)
    for k in range(width):
        gram = mix64(gram * _SECOND + h[at + k])
    doc = np.repeat(np.arange(piece.rows), full)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        whole = []
        for d in short.tolist():
            x = np.zeros(1, np.uint64)
            for k in range(bounds[d], bounds[d + 1]):
                x = mix64(x * _SECOND + h[k] + np.uint64(1))
            whole.append(x)
        doc, gram = np.concatenate([doc, short]), np.concatenate([gram, *whole])
    return doc, gram


def ordered_sets(piece: Piece, width: int, frequent: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds per document and the elements of each set in the global order.

    ``frequent`` has sorted element hashes and ``rank`` their places; other elements go by their hash.
    """
    doc, gram = shingles(piece, width)
    place = gram >> np.uint64(64 - _ORDER_BITS + 1)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, place), len(frequent) - 1)
        place = np.where(frequent[at] == place, (np.uint64(1) << np.uint64(_ORDER_BITS - 1)) + rank[at], place)
    keys = (doc.astype(np.uint64) << np.uint64(_ORDER_BITS)) | place
    keys.sort()
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    bounds = np.searchsorted(keys, np.arange(piece.rows + 1, dtype=np.uint64) << np.uint64(_ORDER_BITS))
    return bounds, keys & np.uint64((1 << _ORDER_BITS) - 1)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - -(-n * percent // 100) + 1, 0)


def _sums(elements: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(elements + np.uint64(1)), dtype=np.uint64)])
    return total[ends] - total[starts]


def frequent_elements(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent elements, sorted by hash, and their places from rare to frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, size
            if not held:
                return
            x = np.sort(np.concatenate(held))
            first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
            n = np.diff(np.concatenate([first, [len(x)]]))
            often = n >= REPEATS
            held, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(x[first[often]].astype(np.int64)), pa.array(n[often])], ["element", "n"])

        seen: set[int] = set()
        none = np.zeros(0, np.uint64)
        for batch in batches:
            for piece in pieces(batch.column(0)):
                bounds, elements = ordered_sets(piece, width, none, none)
                keys = _sums(elements, bounds[:-1], bounds[1:]).tolist()
                fresh = []
                for d, k in enumerate(keys):
                    if k not in seen:
                        seen.add(k)
                        fresh.append(d)
                take = np.array(fresh, np.int64)
                held.append(elements[repeat_ranges(bounds[take], bounds[take + 1] - bounds[take])])
                size += len(held[-1])
                if size >= REPEAT_WINDOW:
                    yield from flush()
                    seen.clear()
        yield from flush()

    found = docs.select("text").mapInArrow(releasing(run), "element long, n long").groupBy("element").agg(F.sum("n").alias("n"))
    top = found.orderBy(F.desc("n"), "element").limit(FREQUENT).toPandas()
    by_count = top.element.to_numpy(np.uint64)[::-1]
    order = np.argsort(by_count)
    return by_count[order], order.astype(np.uint64)


def set_rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Per row: doc_id, n, key of the set, key of its group, and the prefix where a task first meets the group."""
    frequent, rank = frequent_elements(docs, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for piece in pieces(batch.column(1)):
                bounds, elements = ordered_sets(piece, width, frequent, rank)
                starts, n = bounds[:-1], np.diff(bounds)
                size = n.astype(np.uint64)
                key = mix64(_sums(elements, starts, bounds[1:]) + size).astype(np.int64)
                prefix = prefix_length(n, percent)
                group = mix64(_sums(elements, starts, starts + prefix) * _SECOND + size).astype(np.int64)
                shown = np.zeros(piece.rows, np.int64)
                for d, g in enumerate(group.tolist()):
                    if n[d] and g not in seen:
                        seen.add(g)
                        shown[d] = prefix[d]
                maps = [bitmap(elements[a:b]) if k else None for a, b, k in zip(starts.tolist(), bounds[1:].tolist(), shown.tolist(), strict=True)]
                flat = elements[repeat_ranges(starts, shown)].astype(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(shown)]).astype(np.int32)), pa.array(flat))
                ids = batch.column(0).slice(piece.first_row, piece.rows)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(key), pa.array(group), lists, pa.array(maps, pa.binary())], ["doc_id", "n", "key", "group", "prefix", "bitmap"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(releasing(run), "doc_id long, n long, key long, group long, prefix array<long>, bitmap binary")


def bitmap(elements: np.ndarray) -> bytes:
    """Parities of the set's elements by hash; a longer map folds into a shorter one by exclusive or."""
    words = BITMAP_WORDS
    while len(elements) > BITMAP_LOAD * words // BITMAP_WORDS:
        words *= 2
    bit = (mix64(elements + np.uint64(7)) >> np.uint64(20)).astype(np.int64) & (words * 64 - 1)
    return np.packbits((np.bincount(bit, minlength=words * 64) & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(maps: list[bytes | None]) -> np.ndarray:
    out = np.zeros((len(maps), BITMAP_WORDS), np.uint64)
    for k, m in enumerate(maps):
        if m is not None:
            out[k] = np.bitwise_xor.reduce(np.frombuffer(m, np.uint64).reshape(-1, BITMAP_WORDS), axis=0)
    return out


def _differing(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    size = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(v.reshape(-1, size), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def bucket_links(element: np.ndarray, group: np.ndarray, n: np.ndarray, maps: list[bytes | None], percent: int) -> np.ndarray:
    """Pairs of groups that meet under an element and may link (or a forest of them); rows come sorted by element."""
    short = _folded(maps)
    wild = np.array([m is None for m in maps])
    found = [np.zeros((0, 2), np.int64)]
    sizes = np.diff(np.flatnonzero(np.concatenate([[True], element[1:] != element[:-1], [True]])))
    for d in range(1, int(sizes.max(initial=1))):
        k = np.flatnonzero(element[:-d] == element[d:])
        if not len(k):
            break
        a, b = n[k], n[k + d]
        most = (100 - percent) * (a + b) // (100 + percent)
        near = (np.minimum(a, b) * 100 >= np.maximum(a, b) * percent) & (wild[k] | wild[k + d] | (np.bitwise_count(short[k] ^ short[k + d]).sum(1) <= most))
        k, most = k[near], most[near]
        long = np.flatnonzero((np.maximum(n[k], n[k + d]) > BITMAP_LOAD) & ~wild[k] & ~wild[k + d])
        if len(long):
            keep = np.ones(len(k), bool)
            keep[long] = [_differing(maps[i], maps[i + d]) <= m for i, m in zip(k[long].tolist(), most[long].tolist(), strict=True)]
            k = k[keep]
        found.append(np.unique(np.stack([group[k], group[k + d]], 1), axis=0))
        if sum(map(len, found)) > 200_000:
            found = [spanning_forest(np.concatenate(found))]
    return np.concatenate(found)


def spanning_forest(pairs: np.ndarray) -> np.ndarray:
    """As few of the pairs as connect the same groups."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.get(top, top)) != top:
            top = up
        while x != top:
            root[x], x = top, root.get(x, x)
        return top

    kept = []
    for a, b in pairs.tolist():
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append((a, b))
    return np.array(kept, np.int64).reshape(-1, 2)


def link_block(elements: np.ndarray, bounds: np.ndarray, percent: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among some sets (only those across sides, if sides are given)."""
    m = len(bounds) - 1
    n = np.diff(bounds)
    _, local, often = np.unique(elements, return_inverse=True, return_counts=True)
    # The task's own order: rarest first, so that prefixes hold what few sets share.
    rarest = np.empty(len(often), np.int64)
    rarest[np.argsort(often, kind="stable")] = np.arange(len(often))
    ranked = rarest[local]
    owner = np.repeat(np.arange(m), n)
    ranked = ranked[np.lexsort((ranked, owner))]
    prefix = prefix_length(n, percent)
    p_owner = np.repeat(np.arange(m), prefix)
    p_token = ranked[repeat_ranges(bounds[:-1], prefix)]
    by_token = np.lexsort((p_owner, p_token))
    posting = p_owner[by_token]
    token_start = np.searchsorted(p_token[by_token], np.arange(len(often) + 1))
    p_bounds = np.concatenate([[0], np.cumsum(prefix)])

    order = np.argsort(n, kind="stable")
    turn = np.empty(m, np.int64)
    turn[order] = np.arange(m)
    label = np.arange(m)
    mark = np.zeros(len(often) + 1, bool)
    links: list[tuple[int, int]] = []
    for x in order.tolist():
        tokens = p_token[p_bounds[x] : p_bounds[x + 1]]
        begin = token_start[tokens]
        found = posting[repeat_ranges(begin, token_start[tokens + 1] - begin)]
        found = found[(turn[found] < turn[x]) & (n[found] * 100 >= n[x] * percent)]
        if side is not None:
            found = found[side[found] != side[x]]
        if not len(found):
            continue
        found = np.unique(found)
        own = ranked[bounds[x] : bounds[x + 1]]
        mark[own] = True
        found = found[label[found] != label[x]]
        while len(found):
            some, found = found[:16], found[16:]
            common = np.add.reduceat(mark[ranked[repeat_ranges(bounds[some], n[some])]].astype(np.int64), np.concatenate([[0], np.cumsum(n[some])[:-1]]))
            for y in some[100 * common >= percent * (n[x] + n[some] - common)].tolist():
                if label[y] != label[x]:
                    links.append((x, y))
                    label[label == label[y]] = label[x]
            found = found[label[found] != label[x]]
        mark[own] = False
    return links


def _verified(blocks: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the nodes of every task; ``side`` tells the two blocks of a pair apart."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        nodes = table.column("node").to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in table.column("elements").to_pylist()]
        bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        sides = table.column("side").to_numpy()
        links = link_block(np.concatenate(sets), bounds, percent, None if (sides == sides[0]).all() and sides[0] < 0 else sides)
        a, b = (nodes[[p[k] for p in links]] if links else np.zeros(0, np.int64) for k in (0, 1))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return blocks.groupBy("task").applyInArrow(run, "a long, b long")


def jaccard_links(docs: DataFrame, width: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(rows, links): rows has doc_id, n, key, node per input row; links (a, b) between nodes.

    A node is the least doc_id of a set.  Links are a spanning forest of all pairs of sets whose
    similarity is at least ``percent`` of 100.
    """
    rows = cut_lineage(set_rows(docs, width, percent))
    sets = rows.where("n > 0").groupBy("key", "group").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"))
    crowded = sets.groupBy("group").agg(F.min("key").alias("_x"), F.max("key").alias("_y")).where("_x <> _y").select(F.col("group").alias("node"))
    shown = rows.where(F.size("prefix") > 0).select("group", "n", "prefix", "bitmap").dropDuplicates(["group"])
    shown = shown.join(crowded.withColumn("_wild", F.lit(True)), F.col("group") == F.col("node"), "left").drop("node")
    groups = cut_lineage(shown.withColumn("bitmap", F.when(F.col("_wild").isNull(), F.col("bitmap"))).drop("_wild"))

    postings = groups.select("group", F.explode("prefix").alias("element"))
    shared = cut_lineage(postings.groupBy("element").agg(F.count(F.lit(1)).alias("c"), F.min("group").alias("a")).where("c > 1"))
    met = postings.join(shared, "element")
    stars = met.where((F.col("c") > BUCKET_GROUPS) & (F.col("group") != F.col("a"))).select("a", F.col("group").alias("b"))
    meetings = shared.where(F.col("c") <= BUCKET_GROUPS).agg(F.sum("c")).first()[0] or 0
    tasks = max(1, int(meetings) // MEETINGS_PER_TASK + 1)
    few = met.where(F.col("c") <= BUCKET_GROUPS).select("element", "group").join(groups.select("group", "n", "bitmap"), "group")

    def filtered(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("element", "ascending"), ("group", "ascending")])
        element, group, n = (table.column(c).to_numpy() for c in ("element", "group", "n"))
        pairs = spanning_forest(bucket_links(element, group, n, table.column("bitmap").to_pylist(), percent))
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    close = few.withColumn("_task", F.pmod(F.xxhash64("element"), F.lit(tasks))).groupBy("_task").applyInArrow(filtered, "a long, b long")
    families = components(stars.union(close))
    families = families.union(crowded.join(families, "node", "left_anti").select("node", F.col("node").alias("component")))
    members = cut_lineage(
        sets.join(families.select(F.col("node").alias("group"), F.col("component").alias("family")), "group").where("node is not null").select("node", "n", "family", "key")
    )
    return rows, _verified(_blocks(docs, members, width, percent), percent)


def _blocks(docs: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """Rows (task, side, node, elements) such that all sets of a family that may link meet in a task."""
    total = members.count()
    runs = members.groupBy("family", "n").agg(F.count(F.lit(1)).alias("_c"))
    sizes = runs.groupBy("family").agg(F.sum("_c").alias("_size"))
    upto = Window.partitionBy("family").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    large = runs.join(sizes.where(F.col("_size") > BLOCK_SETS), "family").withColumn("_before", F.coalesce(F.sum("_c").over(upto), F.lit(0)))
    place = F.floor((F.col("_before") + F.pmod(F.xxhash64("node"), F.col("_c"))) / BLOCK_SETS).cast("long")
    cut = members.join(large, ["family", "n"], "left").withColumn("_block", F.when(F.col("_c").isNotNull(), place))

    small = cut.where("_block is null").select(
        F.concat(F.lit("s"), F.pmod(F.xxhash64("family"), F.lit(max(1, total // BLOCK_SETS + 1))).cast("string")).alias("task"), F.lit(-1).alias("side"), "node"
    )
    spans = cut.where("_block is not null").groupBy("family", "_block").agg(F.min("n").alias("_lo"), F.max("n").alias("_hi"))
    other = spans.select(F.col("family").alias("_f"), F.col("_block").alias("_j"), F.col("_lo").alias("_lo2"))
    # Blocks ascend by size: block j meets the earlier block i if its least set may still link to i's largest.
    pairs = spans.join(other, (F.col("family") == F.col("_f")) & (F.col("_j") >= F.col("_block")) & (F.col("_hi") * 100 >= F.col("_lo2") * percent))
    task = F.concat_ws(":", F.lit("p"), "family", "_block", "_j")
    ends = pairs.select(
        "family", task.alias("task"), F.explode(F.when(F.col("_block") == F.col("_j"), F.array(F.struct(F.col("_block").alias("_block"), F.lit(-1).alias("side")))).otherwise(
            F.array(F.struct(F.col("_block").alias("_block"), F.lit(0).alias("side")), F.struct(F.col("_j").alias("_block"), F.lit(1).alias("side"))))).alias("_e")
    ).select("family", "task", "_e._block", "_e.side")
    placed = small.union(cut.where("_block is not null").join(ends, ["family", "_block"]).select("task", "side", "node"))

    wanted = members.select(F.col("node").alias("doc_id"), "key")
    if total <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    none = np.zeros(0, np.uint64)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(1)):
                bounds, elements = ordered_sets(piece, width, none, none)
                data = [elements[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                ids = batch.column(0).slice(piece.first_row, piece.rows)
                yield pa.RecordBatch.from_arrays([ids, pa.array(data, pa.binary())], ["node", "elements"])

    built = docs.select(F.col("doc_id").cast("long"), "text").join(wanted, "doc_id").select("doc_id", "text").mapInArrow(releasing(build), "node long, elements binary")
    return placed.join(built, "node").select("task", "side", "node", "elements")


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id (the least doc_id reachable by links) of every row."""
    rows, links = jaccard_links(docs, width, percent)
    found = components(links)
    nodes = rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("node"))
    named = nodes.join(found, "node", "left").select(F.col("key").alias("_k"), F.coalesce("component", "node").alias("_c"))
    return rows.join(named, (F.col("n") > 0) & (F.col("key") == F.col("_k")), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("_c")).otherwise(F.col("doc_id")).alias("component_id")
    )
