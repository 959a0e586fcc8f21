"""One-permutation MinHash fingerprints, in DataFrame operations only.

Words are runs of anything but ASCII white space; a text's set is its distinct shingles of five words
(fewer words: the whole sequence; no words: one fixed shingle, so that empty texts equal each other).
Each shingle is hashed once.  The top bits of the hash name its bin and the least hash of a bin is the
bin's value.  An array sorted once holds each bin's least value right where the bin changes, so binning
is one sort and one filter.

An empty bin j borrows from a full one (optimal densification): it probes bins a_j, a_j + s_j, a_j + 2 s_j
and so on modulo BINS, with s_j odd so that every bin comes up, until one is full.  A few probes nearly
always do; beyond them the least rank ((bin - a_j) / s_j) mod BINS over all full bins says where the same
probing would have stopped, so the result has no bound on probes.

A fingerprint keeps the low BITS bits of each bin's mixed value, two hex digits a bin.  Of two unequal
bins 2**-BITS agree by chance; likeness subtracts that.

The neighbour of a row in doc_id order is found inside parts of consecutive doc_ids; only the first row of each
part travels, to be the neighbour of the part before.

Defined cases: null text is an empty text; rows with equal doc_id follow each other by text; the row after
the last is the first (a single row is its own next); an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.llm.common import text_or_empty

SHINGLE = 5
BIN_BITS = 7
BINS = 1 << BIN_BITS
BITS = 8
#: Probes before the rank of all full bins is computed instead.
PROBES = 10
#: Rows of consecutive doc_id that are one part, about, and parts at most: what the driver holds of the doc_ids.
PART_ROWS, MOST_PARTS, EVEN = 128, 1 << 16, 8
#: Parts that a partition has, about: several, so that the hash of their numbers deals them evenly.
PARTS_TOGETHER = 16


def _odd_multiplier(n: int) -> int:
    """A fixed pseudo-random stream (splitmix64) for the densification ranks."""
    z = (n * 0x9E3779B97F4A7C15) & (2**64 - 1)
    z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
    z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & (2**64 - 1)
    return z ^ (z >> 31)


def shingle_hashes(text: Column, width: int = SHINGLE) -> Column:
    """Sorted 64-bit hashes of the text's shingles; repeats stay, a minimum does not see them."""
    words = F.transform(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""), lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        n = F.size(h)
        grams = F.transform(F.slice(h, 1, F.greatest(n - (width - 1), F.lit(1))), lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, width)]))
        return F.when(n >= width, grams).otherwise(F.array(F.xxhash64(F.lit(-1).cast("long"), h)))

    return F.transform(F.array(words), lambda h: F.sort_array(shingles(h)))[0]


def signature(text: Column, width: int = SHINGLE) -> Column:
    """BINS values, none empty, each below 2**BITS."""
    mask = BINS - 1
    first = [_odd_multiplier(2 * j + 2) & mask for j in range(BINS)]
    step = [(_odd_multiplier(2 * j + 1) & mask) | 1 for j in range(BINS)]
    probes = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(first[j]).alias("a"), F.lit(step[j]).alias("s"), F.lit(pow(step[j], -1, BINS)).alias("u")) for j in range(BINS)])

    def bin_of(x: Column) -> Column:
        return F.shiftright(x, 64 - BIN_BITS).cast("int") + BINS // 2

    def least(h: Column) -> Column:
        return F.filter(h, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(h, i - 1))))

    def value(x: Column) -> Column:
        # The least hash of a bin is small in its upper bits but uniform in its lower ones.
        return x.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")

    def dense(least_hashes: Column) -> Column:
        bins = F.transform(least_hashes, bin_of)
        by_bin = F.map_from_arrays(bins, F.transform(least_hashes, value))

        def borrow(m: Column, d: Column, p: Column) -> Column:
            tried = [F.get(d, (p["a"] + p["s"] * t).bitwiseAND(F.lit(mask))) for t in range(PROBES)]
            ranks = F.transform(F.map_keys(m), lambda b: ((b - p["a"]) * p["u"]).bitwiseAND(F.lit(mask)))
            found = (p["a"] + p["s"] * F.array_min(ranks)).bitwiseAND(F.lit(mask))
            return F.coalesce(F.get(d, p["j"]), *tried, F.get(d, found))

        def fill(m: Column) -> Column:
            sparse = F.transform(F.sequence(F.lit(0), F.lit(mask)), lambda j: F.element_at(m, j))
            return F.transform(F.array(sparse), lambda d: F.transform(probes, lambda p: borrow(m, d, p)))[0]

        return F.transform(F.array(by_bin), fill)[0]

    mins = F.transform(F.array(shingle_hashes(text, width)), least)
    return F.transform(mins, dense)[0]


def packed(sig: Column) -> Column:
    """The signature as text: two lower-case hex digits a bin."""
    return F.lower(F.array_join(F.transform(sig, lambda v: F.lpad(F.hex(v), BITS // 4, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two signatures, chance agreement removed, within 0 and 1."""
    agree = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(BINS))
    chance = 2.0**-BITS
    return F.greatest(F.lit(0.0), (agree - chance) / (1 - chance))


def fingerprint(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id and ``fingerprint`` of every row."""
    return docs.select("doc_id", packed(signature(text_or_empty(), width)).alias("fingerprint"))


def _bounds(docs: DataFrame) -> tuple[list[int], bool]:
    """Ascending doc_ids at which parts begin, the least first, MOST_PARTS at most, and whether there are rows without one.

    A doc_id is a bound by its hash, so every evaluation finds the same parts."""
    n, known, least = docs.agg(F.count(F.lit(1)), F.count("doc_id"), F.min("doc_id")).first()
    if not known:
        return [], n > 0
    # Of a finer sample every few are bounds: parts are then of much the same size.
    every = max(PART_ROWS // EVEN, n // (EVEN * MOST_PARTS), 1)
    chosen = docs.where(F.col("doc_id").isNotNull() & (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(every)) == 0)).select("doc_id").distinct()
    return sorted({int(least), *sorted(int(r[0]) for r in chosen.collect())[EVEN - 1 :: EVEN]}), known < n


def _array(values: list[int]) -> Column:
    """The values as one folded constant, however many they are."""
    return F.split(F.lit(",".join(map(str, values)) or "0"), ",").cast("array<bigint>")


def _part_of(x: Column, bounds: list[int]) -> Column:
    """How many bounds are at most ``x`` (null: 0), by a coarse and a fine look."""
    step = max(1, int(len(bounds) ** 0.5))
    upto = lambda values: F.size(F.filter(values, lambda b: b <= x))
    coarse = upto(_array(bounds[::step]))
    fine = F.transform(F.array(coarse), lambda k: (k - 1) * step + upto(F.slice(_array(bounds), F.greatest((k - 1) * step + 1, F.lit(1)), F.lit(step))))[0]
    return F.when(x.isNull() | (not bounds), F.lit(0)).otherwise(fine).cast("int")


def fingerprint_with_edits(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness to each other and to the next text.

    The edited text ends in the start of the next document instead of its own last quarter.
    """
    bounds, nulls = _bounds(docs)
    placed = docs.select("doc_id", text_or_empty().alias("text")).withColumn("_part", _part_of(F.col("doc_id"), bounds))
    # A part's first row has its bound for doc_id: those few rows travel on their own, each to the part before (the first
    # one's to the last).
    last = len(bounds)
    first = 0 if nulls or not last else 1
    is_first = F.when(F.col("_part") == 0, F.col("doc_id").isNull()).otherwise(F.element_at(_array(bounds), F.greatest(F.col("_part"), F.lit(1))) == F.col("doc_id"))
    firsts = placed.where(is_first).groupBy("_part").agg(F.min("text").alias("_head"))
    to = F.when(F.col("_part") == first, F.lit(last)).otherwise(F.col("_part") - 1)
    heads = firsts.select(to.alias("_part"), "_head", signature(F.col("_head"), width).alias("_head_sig"))
    placed = placed.repartition(max((last + 1) // PARTS_TOGETHER, 2 * docs.sparkSession.sparkContext.defaultParallelism), "_part")
    order = Window.partitionBy("_part").orderBy("doc_id", "text")

    q = F.floor(F.col("n_chars") / 4).cast("int")
    following = F.coalesce(F.lead("text").over(order), F.col("_head"))
    rows = (
        placed.join(heads, "_part")
        .withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("_next", following)
        .withColumn("_edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - q), F.substring("_next", F.lit(1), q)))
        .withColumn("_sig", signature(F.col("text"), width))
        .withColumn("_edited_sig", signature(F.col("_edited"), width))
    )
    next_sig = F.coalesce(F.lead("_sig").over(order), F.col("_head_sig"))
    return rows.withColumn("_next_sig", next_sig).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        packed(F.col("_sig")).alias("fingerprint"),
        packed(F.col("_edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("_sig"), F.col("_edited_sig")).alias("near_edited"),
        likeness(F.col("_sig"), F.col("_next_sig")).alias("near_next"),
    )
