"""Quality classifier: naive-Bayes support vectors.

A text's features are indicators of n-grams, hashed into ``BUCKETS``: words and word pairs, and one to
three consecutive word shapes (a word's runs of upper case, lower case, digits and each mark, and whether
it repeats the word before).  Every indicator is scaled by its naive-Bayes log-count ratio, the logarithm
of how much likelier it is in class 1 than in class 0, texts are scaled to unit length, and a linear
hinge-loss model is fitted by dual coordinate descent.

The ratios count all labelled training rows, in one pass that adds up per task before it shuffles; they
have BUCKETS rows however large the input.  The hinge-loss fit sees a sample of about SAMPLE_PER_CLASS rows
of each class, chosen by a hash of doc_id.

Defined cases: null text is empty; a text without words scores by the intercept alone; rows with no label,
or a null one, are scored but not learned from; a doc_id labelled twice counts with its smaller label;
repeated rows are scored each; without labels of both classes every score is the share of class 1 (0.5
without any label); an empty table gives an empty result; other columns are ignored (``keep_good`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import cut_lineage, releasing
from pageloom.llm.textops import Piece, lowered, mix64, pieces, prefix_hashes, span_hashes

BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
#: Rows of each class that the hinge-loss fit sees, in expectation.
SAMPLE_PER_CLASS = 3000
#: Labels up to this many rows are broadcast; beyond, the join shuffles.
BROADCAST_LABELS = 1_000_000
SMOOTHING = 1.0
PENALTY = 1.0
EPOCHS = 12
#: Slope of the logistic curve that maps margins to scores.
SLOPE = 4.0

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[48:58] = ord("0")
_CLASS[65:91] = ord("A")
_CLASS[97:123] = ord("a")
_CLASS[128:] = ord("a")


def word_shapes(piece: Piece) -> np.ndarray:
    """A hash per word of its byte classes with runs collapsed."""
    starts, ends = piece.words
    kinds = _CLASS[piece.data]
    kept = np.empty(len(kinds), bool)
    kept[:1] = True
    kept[1:] = kinds[1:] != kinds[:-1]
    kept[starts] = True
    at = np.concatenate([[0], np.cumsum(kept)])
    return span_hashes(prefix_hashes(kinds[kept]), at[starts], at[ends])


def features(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, bucket) pairs of a piece, by document."""
    starts, _ = piece.words
    doc = np.searchsorted(piece.offsets, starts, "right") - 1
    word, shape = piece.word_hashes(), word_shapes(piece)
    fold = lowered(piece).word_hashes()
    same = doc[1:] == doc[:-1]
    again = np.concatenate([[False], same & (fold[1:] == fold[:-1])]) if len(doc) else np.zeros(0, bool)
    shape = shape + again.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    pair, triple = same, same[1:] & same[:-1]
    k = np.uint64(0x100000001B3)
    two = mix64(shape[:-1] * k + shape[1:])
    grams = [
        (doc, mix64(word + np.uint64(1))),
        (doc[1:][pair], mix64(word[:-1] * k + word[1:])[pair]),
        (doc, mix64(shape + np.uint64(2))),
        (doc[1:][pair], two[pair]),
        (doc[2:][triple], mix64(two[:-1] * k + shape[2:])[triple]),
    ]
    keys = np.concatenate([(d.astype(np.uint64) << np.uint64(BUCKET_BITS)) | (h >> np.uint64(64 - BUCKET_BITS)) for d, h in grams])
    keys.sort()
    if len(keys):
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
    return (keys >> np.uint64(BUCKET_BITS)).astype(np.int64), (keys & np.uint64(BUCKETS - 1)).astype(np.int32)


@dataclass
class QualityModel:
    """Ratios, weights and intercept; BUCKETS values each, so a bounded size."""

    ratio: np.ndarray
    weight: np.ndarray
    intercept: float

    def scores(self, piece: Piece) -> np.ndarray:
        doc, bucket = features(piece)
        r = self.ratio[bucket].astype(np.float64)
        length = np.sqrt(np.bincount(doc, r * r, piece.rows))
        margin = np.bincount(doc, r * self.weight[bucket], piece.rows) / np.where(length > 0, length, 1.0) + self.intercept
        return 1.0 / (1.0 + np.exp(-np.clip(SLOPE * margin, -500, 500)))


def dual_coordinate_descent(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Hinge-loss weights over unit-length scaled indicators, and the intercept (a constant feature of 1)."""
    weight, intercept = np.zeros(BUCKETS), 0.0
    sign = np.where(labels > 0, 1.0, -1.0)
    values = []
    for bucket in rows:
        r = ratio[bucket].astype(np.float64)
        n = float(np.sqrt(r @ r))
        values.append(r / n if n else r)
    norms = np.array([float(v @ v) + 1.0 for v in values])
    # Both classes carry the same total penalty, whatever their sizes in the sample.
    share = np.array([(labels <= 0).mean(), (labels > 0).mean()])
    most = PENALTY * 0.5 / share[(labels > 0).astype(int)]
    dual = np.zeros(len(rows))
    shuffle = np.random.default_rng(11)
    for _ in range(EPOCHS):
        worst = 0.0
        for i in shuffle.permutation(len(rows)):
            bucket, v = rows[i], values[i]
            gradient = sign[i] * (float(weight[bucket] @ v) + intercept) - 1.0
            new = min(max(dual[i] - gradient / norms[i], 0.0), most[i])
            if (step := new - dual[i]) != 0.0:
                worst = max(worst, abs(step))
                dual[i] = new
                weight[bucket] += step * sign[i] * v
                intercept += step * sign[i]
        if worst < 1e-3:
            break
    return weight, intercept


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", learn_from: Column | None = None) -> QualityModel:
    """Fits a model on the labelled rows of ``docs`` for which ``learn_from`` holds (all by default)."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).cast("int").alias("_label"))
    if learn_from is not None:
        known = known.where(learn_from)
    sizes = {int(r[0]): int(r[1]) for r in known.groupBy((F.col("_label") > 0).cast("int")).count().collect()}
    none = QualityModel(np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, np.float32), 0.0)
    if len(sizes) < 2:
        none.intercept = 0.0 if not sizes else (1.0 if 1 in sizes else -1.0) * 500 / SLOPE
        return none
    if sum(sizes.values()) <= BROADCAST_LABELS:
        known = F.broadcast(known)
    chance = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000))
    picked = F.when(F.col("_label") > 0, chance < min(1.0, SAMPLE_PER_CLASS / sizes[1]) * 1e6).otherwise(chance < min(1.0, SAMPLE_PER_CLASS / sizes[0]) * 1e6)
    rows = docs.select("doc_id", "text").join(known, "doc_id").select("doc_id", "text", (F.col("_label") > 0).alias("_good"), picked.alias("_picked"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of (bucket, texts of class 1, of class 0), and of (doc_id, class, buckets) for the sample."""
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            ids, good, sampled = batch.column(0).to_pylist(), np.asarray(batch.column(2).to_numpy(zero_copy_only=False), bool), batch.column(3).to_pylist()
            for piece in pieces(batch.column(1)):
                doc, bucket = features(piece)
                of = good[piece.first_row + doc]
                counts[1] += np.bincount(bucket[of], minlength=BUCKETS)
                counts[0] += np.bincount(bucket[~of], minlength=BUCKETS)
                bounds = np.searchsorted(doc, np.arange(piece.rows + 1))
                chosen = [k for k in range(piece.rows) if sampled[piece.first_row + k]]
                if chosen:
                    yield emit(doc_id=[ids[piece.first_row + k] for k in chosen], good=[bool(good[piece.first_row + k]) for k in chosen], buckets=[bucket[bounds[k] : bounds[k + 1]].tobytes() for k in chosen])
        seen = np.flatnonzero(counts.any(0))
        if len(seen):
            yield emit(bucket=seen, n1=counts[1][seen], n0=counts[0][seen])

    kinds = {"bucket": pa.int32(), "n1": pa.int64(), "n0": pa.int64(), "doc_id": pa.int64(), "good": pa.bool_(), "buckets": pa.binary()}

    def emit(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in kinds.items()], list(kinds))

    counted = cut_lineage(rows.mapInArrow(releasing(count), "bucket int, n1 long, n0 long, doc_id long, good boolean, buckets binary"))
    sums = counted.where("bucket is not null").groupBy("bucket").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).toPandas()
    p, q = np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)
    p[sums.bucket], q[sums.bucket] = p[sums.bucket] + sums.n1, q[sums.bucket] + sums.n0
    ratio = np.log((p / p.sum()) / (q / q.sum())).astype(np.float32)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = sorted((row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True)), key=lambda r: (r[0], r[2]))
        if not sample:
            return
        weight, intercept = dual_coordinate_descent([np.frombuffer(r[2], np.int32) for r in sample], np.array([r[1] for r in sample], int), ratio)
        yield pa.RecordBatch.from_arrays([pa.array([weight.astype("<f4").tobytes()]), pa.array([intercept])], ["weight", "intercept"])

    sample = counted.where("buckets is not null").select("doc_id", "good", "buckets").coalesce(1)
    fitted = sample.mapInArrow(releasing(fit), "weight binary, intercept double").collect()
    if not fitted:
        return none
    return QualityModel(ratio, np.frombuffer(fitted[0][0], "<f4"), float(fitted[0][1]))


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score (0 to 1) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.scores(piece) for piece in pieces(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found) if found else np.zeros(0))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(releasing(run), "doc_id long, score double")


def keep_good(docs: DataFrame, model: QualityModel, least: float = 0.5) -> DataFrame:
    """The rows whose score is at least ``least``, with all their columns."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.scores(piece) for piece in pieces(batch.column(at))]
            if found:
                yield batch.filter(pa.array(np.concatenate(found) >= least))

    return docs.mapInArrow(releasing(run), docs.schema)
