"""Quality classifier by importance resampling over hashed n-gram generative models.

Two bag-of-n-gram models over ``buckets`` hash buckets are estimated: the target's (documents labelled
good) and the raw corpus' (all documents). A document's log weight is the log ratio of its two
generative probabilities, over the square root of its number of n-grams: neighbouring n-grams repeat each other's
evidence, and the plain sum would put all documents so far apart that no sampling could act; a bucket's ratio is drawn towards 1 by ``SMOOTHING`` counts, so that rare words
say little. The threshold on the log weight is the one that separates labelled good from labelled bad
documents with the fewest errors, each weighed by a model that has not seen its half of the labels; k is
the number of documents above it, and the k documents with the largest Gumbel-perturbed log weights are
kept (Gumbel top-k: sampling without replacement in proportion to the weights, at temperature 1). Far
from the threshold a document's fate is certain, close to it it is drawn.

N-grams are word unigrams and bigrams of token shapes. Tokens are runs of letters, of digits or of
other symbols; a word's shape is its case pattern, or that it repeats the word before it; a run of
symbols is its own shape. Shapes let the models learn shouting, stuttering and symbol noise from any
vocabulary.

Labels come as a broadcast of at most ``LABELS`` rows (a hash sample beyond that); everything else covers
all documents. Texts are never shuffled: the models are sums of per-task counts, and the k-th largest
weight is found by counting its leading bits in four rounds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from panelith.llm.staging import Stage
from panelith.llm.wordbatch import GAPS, LETTERS, chunks, mix, spans_hash

# columns that travel beside a caller's own
KEY, BODY, WEIGHT, SIZE, PLACE = "__key", "__body", "__log_weight", "__n_grams", "__place"
HALF, UNSEEN = "__half", "__unseen"
TAIL = f"`{WEIGHT}` double, `{SIZE}` long, `{PLACE}` long"
BUCKETS, LABELS, TEMPERATURE, SMOOTHING, SEED = 1 << 14, 100_000, 1.0, 20.0, 77
U = np.uint64
#: bytes of text whose n-grams are held at once
CHUNK, ROWS = 500_000, 1000
KIND = np.full(256, 3, np.int8)
KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
KIND[48:58] = 2
KIND[GAPS] = 0
UPPER = np.zeros(256, np.int64)
UPPER[65:91] = 1


def ngram_buckets(part: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every n-gram of the texts, ordered by kind, then by text."""
    raw = np.frombuffer(b" ".join(part) + b" ", np.uint8)
    offsets = np.cumsum([0, *(len(t) + 1 for t in part)])
    kind = KIND[raw]
    turn = np.flatnonzero(np.diff(kind, prepend=np.int8(0)))
    if not len(turn):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.append(turn[1:], len(raw))
    solid = kind[turn] > 0
    starts, ends = turn[solid], ends[solid]
    doc = np.searchsorted(offsets, starts, "right") - 1
    kinds = kind[starts]
    h = spans_hash(LETTERS[raw], starts, ends)
    ups = np.concatenate([[0], np.cumsum(UPPER[raw])])
    ups = ups[ends] - ups[starts]
    word = np.flatnonzero(kinds == 1)
    shape = h.copy()
    shape[kinds == 2] = U(9)
    shape[word] = np.where(ups[word] >= 2, 2, np.where(UPPER[raw[starts[word]]] == 1, 1, 0)).astype(U)
    again = np.flatnonzero((h[word[1:]] == h[word[:-1]]) & (doc[word[1:]] == doc[word[:-1]])) + 1
    shape[word[again]] = U(3)
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    grams = np.concatenate([mix(h[word], 11), mix(mix(shape[pair], 12) + shape[pair + 1], 13)])
    return np.concatenate([doc[word], doc[pair]]), (grams % U(buckets)).astype(np.int64)


def _slices(batches):
    """Batches of at most ``ROWS`` rows: texts become Python objects a slice at a time."""
    for rows in batches:
        for at in range(0, rows.num_rows, ROWS):
            yield rows.slice(at, ROWS)


def _count(buckets: int):
    """Per task: n-gram counts of all texts and of the good ones of either half of the labels."""

    def run(batches):
        raw, good = np.zeros(buckets, np.int64), np.zeros((2, buckets), np.int64)
        for rows in _slices(batches):
            texts = rows.column(BODY).to_pylist()
            quality, half = rows.column("quality").to_pylist(), rows.column("half").to_pylist()
            label = np.array([h if q == 1 else -1 for q, h in zip(quality, half)], np.int64)
            for a, b, part in chunks(texts, CHUNK):
                doc, at = ngram_buckets(part, buckets)
                raw += np.bincount(at, minlength=buckets)
                for h in (0, 1):
                    good[h] += np.bincount(at[(label[a:b] == h)[doc]], minlength=buckets)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (seen, raw[seen], good[0][seen], good[1][seen])], names=["bucket", "raw", "good0", "good1"]
        )

    return run


@dataclass(frozen=True)
class ImportanceModel:
    """Log ratios per bucket: from all labels, and from either half of them alone."""

    ratio: np.ndarray
    halves: tuple[np.ndarray, np.ndarray]
    temperature: float
    seed: int = SEED

    def weigh(self, rows: pa.RecordBatch, halves: list | None = None):
        """Log weights and n-gram counts of a batch with a ``body``; with ``halves``, the log weights of
        labelled texts by the model of the other half."""
        texts = rows.column(BODY).to_pylist()
        weights, sizes = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        unseen = np.zeros(len(texts))
        for a, b, part in chunks(texts, CHUNK):
            doc, at = ngram_buckets(part, len(self.ratio))
            sizes[a:b] = np.bincount(doc, minlength=b - a)
            scale = np.sqrt(np.maximum(sizes[a:b], 1))
            weights[a:b] = np.bincount(doc, self.ratio[at], b - a) / scale
            for h in (0, 1):
                mine = np.array([x == h for x in halves[a:b]], bool) if halves else np.zeros(0, bool)
                if mine.any():
                    unseen[a:b][mine] = (np.bincount(doc, self.halves[1 - h][at], b - a) / scale)[mine]
        return weights, sizes, unseen

    def perturb(self, keys: np.ndarray, weights: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Gumbel-perturbed log weights as whole numbers of the same order; texts without n-grams last."""
        u = (mix(keys.astype(np.int64).view(U), self.seed) >> U(11)).astype(float) / 2.0**53
        noisy = weights - self.temperature * np.log(-np.log(np.clip(u, 1e-300, 1 - 1e-16)))
        bits = (np.where(sizes > 0, noisy, -np.inf) + 0.0).view(np.int64)
        return np.where(bits < 0, ~bits ^ np.int64(-(2**63)), bits)


def _scored(model: ImportanceModel):
    def run(batches):
        for rows in _slices(batches):
            halves = rows.column(HALF).to_pylist() if HALF in rows.schema.names else None
            weights, sizes, unseen = model.weigh(rows, halves)
            keys = np.array([0 if k is None else k for k in rows.column(KEY).to_pylist()], np.int64)
            names = [n for n in rows.schema.names if n not in (BODY, KEY, HALF)]
            more = {WEIGHT: weights, SIZE: sizes, PLACE: model.perturb(keys, weights, sizes)}
            if halves is not None:
                more[UNSEEN] = unseen
            yield pa.RecordBatch.from_arrays(
                [rows.column(n) for n in names] + [pa.array(v) for v in more.values()], names=[*names, *more]
            )

    return run


def fit_importance(
    docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, bound: int = LABELS, temperature: float = TEMPERATURE,
    seed: int = SEED,
) -> tuple[ImportanceModel, DataFrame]:
    """The two models' log ratio per bucket, and the (broadcast) labels used."""
    used = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        .withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int"))
    )
    used = F.broadcast(used)
    counts = (
        _bodies(docs, "doc_id").join(used, "doc_id", "left").select(BODY, "quality", "half").mapInArrow(_count(buckets), "bucket long, raw long, good0 long, good1 long")
        .groupBy("bucket").agg(F.sum("raw"), F.sum("good0"), F.sum("good1")).collect()
    )
    raw, good = np.zeros(buckets), np.zeros((2, buckets))
    for at, r, g0, g1 in counts:
        raw[at], good[:, at] = r, (g0, g1)

    def ratio(seen: np.ndarray) -> np.ndarray:
        expected = raw * (seen.sum() / max(raw.sum(), 1.0))
        return np.log(seen + SMOOTHING) - np.log(expected + SMOOTHING)

    return ImportanceModel(ratio(good.sum(axis=0)), (ratio(good[0]), ratio(good[1])), temperature, seed), used


def _threshold(weights: np.ndarray, good: np.ndarray) -> float:
    """The log weight that separates good from bad with the fewest errors; the middle of the gap."""
    if not len(weights) or good.all():
        return -np.inf
    if not good.any():
        return np.inf
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    errors = np.concatenate([[(~g).sum()], (~g).sum() + np.cumsum(np.where(g, 1, -1))]).astype(float)
    errors[1:-1][w[1:] == w[:-1]] = np.inf
    at = int(errors.argmin())
    if at == 0:
        return -np.inf
    return np.inf if at == len(w) else (w[at - 1] + w[at]) / 2


def _kth_place(places: DataFrame, k: int) -> int:
    """The k-th largest ``place`` (a whole number), by counting 16 leading bits at a time."""
    low, high = -(2**63), 2**63 - 1
    for shift in (48, 32, 16, 0):
        counts = (
            places.where(F.col("place").between(low, high)).groupBy(F.shiftright("place", shift).alias("lead")).count()
            .orderBy(F.desc("lead")).collect()
        )
        for lead, n in counts:
            if n >= k:
                low, high = lead << shift, (lead << shift) + (1 << shift) - 1
                break
            k -= n
    return low


def _resample(docs: DataFrame, labels: DataFrame, buckets: int, bound: int, temperature: float, seed: int):
    """The fitted model, the narrow scores of all rows, and the place a kept row must reach."""
    stage = Stage(docs.sparkSession, "quality")
    model, used = fit_importance(docs, labels, buckets, bound, temperature, seed)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scores = stage.write(
        _bodies(docs, "doc_id").join(used, "doc_id", "left").withColumnRenamed("half", HALF)
        .mapInArrow(_scored(model), f"doc_id {kind}, quality int, {TAIL}, `{UNSEEN}` double")
    )
    known = scores.where(f"quality IS NOT NULL AND `{SIZE}` > 0").groupBy("doc_id").agg(
        F.max(UNSEEN).alias("log_weight"), F.max("quality").alias("quality")
    ).toPandas()  # at most ``bound`` rows
    line = _threshold(known["log_weight"].to_numpy(float), known["quality"].to_numpy() == 1)
    k = scores.where((F.col(WEIGHT) > F.lit(line)) & (F.col(SIZE) > 0)).count()
    place = _kth_place(scores.select(F.col(PLACE).alias("place")), k) if k else None
    return model, scores, place


def _kept(place: int | None):
    return F.lit(False) if place is None else (F.col(SIZE) > 0) & (F.col(PLACE) >= F.lit(place))


def _bodies(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select(
        *columns, F.col("doc_id").cast("long").alias(KEY), F.coalesce("text", F.lit("")).cast("binary").alias(BODY)
    )


def classify_quality(
    docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, bound: int = LABELS, temperature: float = TEMPERATURE,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, log_weight, n_grams, keep): whether importance resampling takes the document.

    ``labels`` hold (doc_id, quality 0 or 1); a doc_id labelled twice counts as the worse. Texts that
    are null or hold no letters, digits or symbols have log weight 0 and are not kept. Rows equal in
    doc_id and text share their fate (a tie at the k-th place is kept). Without labels of both kinds
    the threshold is open: every document with n-grams is kept (none, if all labelled ones are bad). A
    null doc_id draws the noise of id 0. Other columns are ignored. An empty table gives no rows.
    """
    _, scores, place = _resample(docs, labels, buckets, bound, temperature, seed)
    return scores.select(
        "doc_id", F.col(WEIGHT).alias("log_weight"), F.col(SIZE).alias("n_grams"), _kept(place).alias("keep")
    )


def filter_quality(
    docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, bound: int = LABELS, temperature: float = TEMPERATURE,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs``, all columns, that ``classify_quality`` keeps; texts are scored again, not shuffled."""
    model, _, place = _resample(docs, labels, buckets, bound, temperature, seed)
    own = [f"`{c}`" for c in docs.columns]
    tail = [StructField(WEIGHT, DoubleType()), StructField(SIZE, LongType()), StructField(PLACE, LongType())]
    schema = StructType([*docs.schema.fields, *tail])
    return _bodies(docs, *own).mapInArrow(_scored(model), schema).where(_kept(place)).select(*own)
