"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Equal texts form one group that must stay together.  Groups, largest first, go to the bin whose remaining
capacity is the tightest that still holds them; remaining capacities live in a balanced search tree.
Groups of one size are interchangeable, so the packing runs over the histogram (size, groups): a bin that
took one group of a size stays the tightest fit for the next, until it cannot hold another, which places
a whole run at once and gives exactly what one-by-one placing would.  The histogram has at most one row
for each distinct group size, and is all the driver sees.

The capacity is the smallest one, to one part in 2**20, at which the groups fit the given number of bins,
so that sizes come out near equal unless a single group is larger than an even share.

Everything per row is a DataFrame operation.  A rank within a size or a shard is taken in two steps, over
hash buckets of bounded size and then over bucket counts, so no size and no shard is held by one task.

Defined cases: null text counts as no bytes (size 1) and joins the group of empty texts; repeated rows are
rows of their own in one group; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.llm.common import buckets_for, cut_lineage, text_or_empty

PRECISION = 2**20


class BinTree:
    """Remaining capacities in order, as a treap: tightest fit in logarithmic expected time."""

    class _Node:
        __slots__ = ("key", "left", "priority", "right")

        def __init__(self, key: tuple[int, int], priority: int):
            self.key, self.priority, self.left, self.right = key, priority, None, None

    def __init__(self) -> None:
        self._root: BinTree._Node | None = None

    def _split(self, node, key):
        if node is None:
            return None, None
        if node.key < key:
            node.right, right = self._split(node.right, key)
            return node, right
        left, node.left = self._split(node.left, key)
        return left, node

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a.priority > b.priority:
            a.right = self._join(a.right, b)
            return a
        b.left = self._join(a, b.left)
        return b

    def add(self, remaining: int, bin_no: int) -> None:
        key = (remaining, bin_no)
        left, right = self._split(self._root, key)
        self._root = self._join(self._join(left, self._Node(key, (bin_no * 2654435761 + remaining * 40503) % 2**32)), right)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the smallest (remaining, bin) with remaining >= size."""
        left, right = self._split(self._root, (size, -1))
        if right is None:
            self._root = left
            return None
        node = right
        while node.left is not None:
            node = node.left
        _, right = self._split(right, (node.key[0], node.key[1] + 1))
        self._root = self._join(left, right)
        return node.key


def best_fit_decreasing(histogram: list[tuple[int, int]], bins: int, capacity: int) -> list[tuple[int, int, int, int]] | None:
    """Runs (size, first rank, past-the-end rank, bin) for (size, groups) rows, or None if they don't fit."""
    tree = BinTree()
    for b in range(bins):
        tree.add(capacity, b)
    runs = []
    for size, groups in sorted(histogram, reverse=True):
        rank = 0
        while rank < groups:
            found = tree.take_tightest(size)
            if found is None:
                return None
            remaining, b = found
            n = min(groups - rank, remaining // size)
            runs.append((size, rank, rank + n, b))
            tree.add(remaining - n * size, b)
            rank += n
    return runs


def _smallest(histogram: list[tuple[int, int]], bins: int) -> list[tuple[int, int, int, int]]:
    """Best-fit decreasing at the smallest workable capacity."""
    total = sum(s * n for s, n in histogram)
    low = max(-(-total // bins), max(s for s, _ in histogram))
    step = max(1, low // PRECISION)
    slack = 0
    while (runs := best_fit_decreasing(histogram, bins, low + slack)) is None:
        slack = max(step, slack * 2)
    lower = slack // 2
    while slack - lower > step:
        middle = (slack + lower) // 2
        if (tighter := best_fit_decreasing(histogram, bins, low + middle)) is None:
            lower = middle
        else:
            runs, slack = tighter, middle
    return runs


def pack_into(histogram: list[tuple[int, int]], bins: int) -> list[tuple[int, int, int, int]]:
    """Runs (size, first rank, past-the-end rank, bin).  A group above an even share of what is left has a bin to itself;
    all others are packed into the other bins."""
    left, total, own = dict(histogram), sum(s * n for s, n in histogram), []
    for size in sorted(left, reverse=True):
        while left[size] and len(own) < bins - 1 and size * (bins - len(own)) > total:
            own.append(size)
            left[size] -= 1
            total -= size
    runs = [(size, own[:b].count(size), own[:b].count(size) + 1, b) for b, size in enumerate(own)]
    rest = [(s, n) for s, n in left.items() if n]
    if rest:
        runs += [(s, own.count(s) + a, own.count(s) + z, b + len(own)) for s, a, z, b in _smallest(rest, bins - len(own))]
    return runs


def rank_within(df: DataFrame, by: list[str], order: list[str], n_buckets: int, out: str) -> DataFrame:
    """Adds ``out``: a gapless number from 0 within ``by``, without one task holding all rows of a key."""
    bucketed = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(n_buckets)).cast("int"))
    counts = bucketed.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(upto), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*by, "_b").orderBy(*order)
    return (
        bucketed.join(offsets, [*by, "_b"])
        .withColumn(out, (F.col("_off") + F.row_number().over(inside) - 1).cast("long"))
        .drop("_b", "_off")
    )


def shard(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row; sizes of shards near equal."""
    text = text_or_empty()
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.sha2(text.cast("binary"), 256).alias("_group"),
    )
    rows = cut_lineage(rows)
    groups = cut_lineage(rows.groupBy("_group").agg(F.sum("size").alias("_bytes")))
    n_rows, n_groups = rows.count(), groups.count()
    histogram = [(int(r[0]), int(r[1])) for r in groups.groupBy("_bytes").count().collect()]
    spark = docs.sparkSession
    runs = spark.createDataFrame(pack_into(histogram, n_shards), "_bytes long, _first long, _past long, shard int")
    ranked = rank_within(groups, ["_bytes"], ["_group"], buckets_for(n_groups), "_rank")
    placed = (
        ranked.join(runs, (ranked["_bytes"] == runs["_bytes"]) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_past")))
        .select("_group", "shard")
    )
    assigned = cut_lineage(rows.join(placed, "_group").drop("_group"))
    return rank_within(assigned, ["shard"], ["doc_id", "text_crc32", "size"], buckets_for(n_rows), "slot")
