"""Hard negatives by exact inner-product search with pruning by length and by coordinates.

Vectors become whole numbers. Sorted by label and by falling length they are cut into buckets of at most
``BUCKET`` rows, each with the sorted list of every coordinate of its unit vectors. A score threshold and
the bucket's greatest length bound the angle between an anchor and the rows that can reach it; no bucket is
opened whose length is too small for any angle. The angle bounds each coordinate in turn: cos(b + a) to
cos(b - a), for a coordinate whose axis stands at angle b to the anchor. The anchor's ``FOCUS`` greatest
coordinates give ranges of the sorted lists, the ranges are intersected, and what is left is verified by
exact scores. Thresholds start at the bounds a caller sets and rise with what has been found.

In Spark, buckets stay on numbered shelves and packs of anchors travel to every shelf; a shelf holds a range of
the sorted rows, so one label with many rows spreads over many shelves. On a shelf a pack meets bucket
after bucket with rising thresholds, and leaves its best rows only.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelith.llm.staging import Stage, spread_count

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 3, 50, 95
BUCKET, PACK, FOCUS = 2048, 256, 4
#: a range with this share of a bucket or more is verified by one product of matrices
WIDE = 0.25
#: squared lengths from here on take no part: 100 times a score would not fit a long
TOO_LONG = 2.0**55
NONE, MOST = -(2**62), 2**62
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _clean(scale: int):
    """(vec_id, label, v, size, norm2): floor(scale * x) of valid rows, as 32-bit numbers."""

    def run(batches):
        for rows in batches:
            ids, labels = rows.column("vec_id").cast(pa.int64()), rows.column("label").cast(pa.int64())
            good, values, norms = [], [], []
            for i, v in enumerate(rows.column("embedding").cast(pa.list_(pa.float64()))):
                if not v.is_valid or not ids[i].is_valid or not labels[i].is_valid or v.values.null_count or not len(v.values):
                    continue
                x = np.floor(v.values.to_numpy() * scale)
                norm2 = float(x @ x)
                if norm2 < TOO_LONG:  # false for what is not finite
                    good.append(i)
                    values.append(x.astype(np.int32))
                    norms.append(int(norm2))
            take = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([
                ids.take(take), labels.take(take), pa.array([x.tobytes() for x in values], pa.binary()),
                pa.array([len(x) for x in values], pa.int32()), pa.array(norms, pa.int64()),
            ], names=["vec_id", "label", "v", "size", "norm2"])

    return run


def _rows(rows: pa.RecordBatch, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column("v").to_pylist()), np.int32).reshape(-1, size)


def _buckets(size: int, limit: int, shelves: int):
    """Buckets of a partition's sorted rows: full ones, or ended by a new label once a quarter full."""

    def ready(ids, labels, v):
        lengths = np.sqrt((v.astype(float) ** 2).sum(axis=1))
        unit = v / np.where(lengths > 0, lengths, 1.0)[:, None]
        lists = np.argsort(unit, axis=0, kind="stable").T.astype(np.uint16)
        shelf = TaskContext.get().partitionId() % shelves
        return pa.RecordBatch.from_pydict({
            "shelf": pa.array([shelf], pa.int32()), "first": pa.array([labels[0]], pa.int64()), "last": pa.array([labels[-1]], pa.int64()),
            "ids": [ids.tobytes()], "labels": [labels.tobytes()], "v": [v.tobytes()], "lists": [lists.tobytes()],
        })

    def run(batches):
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, size), np.int32))
        before = None
        for rows in batches:
            if not rows.num_rows:
                continue
            ids, labels, v = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), _rows(rows, size)
            new = np.ones(len(ids), bool)
            new[1:] = (ids[1:] != ids[:-1]) | (labels[1:] != labels[:-1]) | (v[1:] != v[:-1]).any(axis=1)
            if before is not None:
                new[0] = before[0] != ids[0] or before[1] != labels[0] or (before[2] != v[0]).any()
            before = ids[-1], labels[-1], v[-1]
            held = tuple(np.concatenate([a, b[new]]) for a, b in zip(held, (ids, labels, v)))
            while True:
                turn = np.flatnonzero(held[1][1 : limit + 1] != held[1][:limit][: len(held[1]) - 1]) + 1
                turn = turn[turn >= limit // 4]
                cut = int(turn[0]) if len(turn) else limit
                if len(held[0]) <= cut:
                    break
                yield ready(*(x[:cut] for x in held))
                held = tuple(x[cut:] for x in held)
        if len(held[0]):
            yield ready(*held)

    return run


def _packs(size: int, limit: int):
    """Packs of anchors sorted by label, with the bounds of each anchor's slots."""

    def run(batches):
        for rows in batches:
            for at in range(0, rows.num_rows, limit):
                part = rows.slice(at, limit)
                labels = part.column("label").to_numpy()
                bounds = [np.array(part.column(n).to_pylist(), np.int64) for n in ("low", "high")]
                yield pa.RecordBatch.from_pydict({
                    "asks": [part.column("ask").to_numpy().tobytes()], "anchors": [part.column("vec_id").to_numpy().tobytes()],
                    "anchor_labels": [labels.tobytes()], "q": [_rows(part, size).tobytes()],
                    "lows": [bounds[0].tobytes()], "highs": [bounds[1].tobytes()],
                    "from_label": pa.array([labels.min()], pa.int64()), "to_label": pa.array([labels.max()], pa.int64()),
                })

    return run


class Bucket:
    """Rows of one bucket in the order of their ids, and its sorted coordinate lists."""

    def __init__(self, row: dict, size: int):
        ids = np.frombuffer(row["ids"], np.int64)
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.ids, self.labels = ids[order], np.frombuffer(row["labels"], np.int64)[order]
        self.v = np.frombuffer(row["v"], np.int32).reshape(-1, size)[order].astype(float)
        lengths = np.sqrt((self.v**2).sum(axis=1))
        self.top = float(lengths.max())
        self.unit = self.v / np.where(lengths > 0, lengths, 1.0)[:, None]
        self.lists = place[np.frombuffer(row["lists"], np.uint16).reshape(size, -1)]


def feasible(unit: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of a coordinate of a unit vector whose cosine with the anchor is ``theta`` or
    more, given the anchor's own coordinate; a little wider, so that rounding loses nothing."""
    a, b = np.arccos(np.clip(theta, -1.0, 1.0))[:, None], np.arccos(np.clip(unit, -1.0, 1.0))
    return np.cos(np.minimum(np.pi, b + a)) - 1e-9, np.cos(np.maximum(0.0, b - a)) + 1e-9


def bucket_scores(bucket: Bucket, q: np.ndarray, lengths: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Exact scores of all rows that can reach ``least`` for an anchor; NONE for rows that cannot."""
    scores = np.full((len(q), len(bucket.ids)), NONE, np.int64)
    # scores below 2**53 are exact as doubles, whatever the order of summation
    exact = float(lengths.max(initial=0.0)) * bucket.top < 2.0**53
    reach = lengths * bucket.top
    bound = least > 0
    theta = np.where(bound, least / np.where(reach > 0, reach, 1.0), -1.0)
    theta[bound & (reach == 0)] = 2.0
    here = np.flatnonzero(theta <= 1 + 1e-9)
    unit = q[here] / np.where(lengths[here] > 0, lengths[here], 1.0)[:, None]
    focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
    low, high = feasible(np.take_along_axis(unit, focus, 1), theta[here])
    free = theta[here] <= -1
    low[free], high[free] = -2.0, 2.0
    begin, end = np.zeros(focus.shape, np.int64), np.zeros(focus.shape, np.int64)
    for f in np.unique(focus).tolist():
        at = focus == f
        values = bucket.unit[bucket.lists[f], f]
        begin[at], end[at] = np.searchsorted(values, low[at], "left"), np.searchsorted(values, high[at], "right")
    size = end - begin
    narrow = size.argmin(axis=1) if len(here) else np.zeros(0, int)
    wide = size.min(axis=1, initial=len(bucket.ids)) >= WIDE * len(bucket.ids)

    def product(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
        if exact:
            return np.rint(anchors @ rows.T).astype(np.int64)
        return anchors.astype(np.int64) @ rows.T.astype(np.int64)

    if wide.any():
        scores[here[wide]] = product(bucket.v, q[here[wide]])
    for i in np.flatnonzero(~wide).tolist():
        k = narrow[i]
        rows = bucket.lists[focus[i, k], begin[i, k] : end[i, k]]
        for j in range(focus.shape[1]):
            if j != k:
                x = bucket.unit[rows, focus[i, j]]
                rows = rows[(x >= low[i, j]) & (x <= high[i, j])]
        if len(rows):
            scores[here[i], rows] = product(bucket.v[rows], q[here[i]][None])[0]
    return scores


class Search:
    """The best rows of one pack of anchors for every slot, over the buckets it has met."""

    def __init__(self, row: dict, size: int, keep: int, same: bool):
        self.asks, self.anchors = np.frombuffer(row["asks"], np.int64), np.frombuffer(row["anchors"], np.int64)
        self.labels = np.frombuffer(row["anchor_labels"], np.int64)
        n = len(self.asks)
        self.q = np.frombuffer(row["q"], np.int32).reshape(n, size).astype(float)
        self.lengths = np.sqrt((self.q**2).sum(axis=1))
        self.low = np.frombuffer(row["lows"], np.int64).reshape(n, -1).copy()
        self.high = np.frombuffer(row["highs"], np.int64).reshape(n, -1)
        self.keep, self.same = keep, same
        self.found = [np.zeros(0, np.int64)] * 4

    def meet(self, bucket: Bucket) -> None:
        open_slots = self.low <= self.high
        least = np.where(open_slots, self.low, MOST).min(axis=1)
        alike = bucket.labels == self.labels[:, None]
        allowed = alike & (bucket.ids != self.anchors[:, None]) if self.same else ~alike
        least[~allowed.any(axis=1)] = MOST
        scores = bucket_scores(bucket, self.q, self.lengths, least)
        scores[~allowed] = NONE - 1
        parts = [self.found]
        for j in range(self.low.shape[1]):
            fits = (scores >= self.low[:, j : j + 1]) & (scores <= self.high[:, j : j + 1]) & (scores > NONE)
            many = np.flatnonzero(fits.sum(axis=1) > self.keep)
            if len(many):
                # rows stand in the order of their ids: a stable sort leaves ties to the smaller id
                best = np.argsort(np.where(fits[many], -scores[many], MOST), axis=1, kind="stable")[:, : self.keep]
                fits[many] = False
                fits[many[:, None], best] = True
            a, r = np.nonzero(fits)
            parts.append([a, np.full(len(a), j), scores[a, r], bucket.ids[r]])
        if all(not len(p[0]) for p in parts[1:]):
            return
        a, j, s, v = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((v, -s, j, a))
        a, j, s, v = a[order], j[order], s[order], v[order]
        begin = np.flatnonzero(np.append(True, (np.diff(a) != 0) | (np.diff(j) != 0)))
        rank = np.arange(len(a)) - np.repeat(begin, np.diff(np.append(begin, len(a))))
        full = rank == self.keep - 1
        self.low[a[full], j[full]] = s[full]
        self.found = [x[rank < self.keep] for x in (a, j, s, v)]

    def result(self) -> pa.RecordBatch:
        a, j, s, v = self.found
        return pa.RecordBatch.from_arrays(
            [pa.array(self.asks[a]), pa.array(j.astype(np.int32)), pa.array(s), pa.array(v)], names=["ask", "slot", "score", "vec_id"]
        )


PACK_COLUMNS = ("asks", "anchors", "anchor_labels", "q", "lows", "highs")


def _search(size: int, keep: int, same: bool):
    """Rows are (pack, bucket) pairs. Those of one pack follow each other, which keeps its thresholds; if
    they did not, a pack would only be answered in several parts."""

    def run(batches):
        search, mine = None, None
        for rows in batches:
            for i in range(rows.num_rows):
                row = {n: rows.column(n)[i].as_py() for n in rows.schema.names}
                if search is None or mine != row["asks"]:
                    if search is not None:
                        yield search.result()
                    search, mine = Search(row, size, keep, same), row["asks"]
                search.meet(Bucket(row, size))
        if search is not None:
            yield search.result()

    return run


def mine_hard_negatives(
    vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
    high: int = HIGH, scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` and ``anchors`` hold (vec_id, label, embedding). Components become floor(scale * x), scores
    are inner products as whole numbers. An anchor's positives are its ``positives`` best other rows (by
    vec_id) of its label; for each, the first ``negatives`` rows of other labels with low * positive_score
    <= 100 * negative_score <= high * positive_score, by falling score, ties to the smaller vec_id. Rows with a null
    vec_id, label or vector, an empty one, one of another length than most, with null or non-finite
    components or a squared whole-number length of 2**55 or more take no part. Rows equal in all three
    columns count once; different rows under one vec_id count each. Other columns are ignored; empty tables
    give no rows.
    """
    spark = vectors.sparkSession
    stage = Stage(spark, "negatives")
    schema = "vec_id long, label long, v binary, size int, norm2 long"

    def clean(rows: DataFrame) -> DataFrame:
        return rows.select("vec_id", "label", "embedding").mapInArrow(_clean(scale), schema)

    base = stage.write(clean(vectors))
    top = base.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    if top is None:
        return spark.createDataFrame([], RESULT)
    size, n = top["size"], spread_count(spark)
    shelves = max(1, min(n, -(-top["count"] // BUCKET)))
    order = ["label", F.desc("norm2"), "vec_id", "v"]
    sorted_rows = base.where(F.col("size") == size).repartitionByRange(shelves, *order).sortWithinPartitions(*order)
    bucket = "shelf int, first long, last long, ids binary, labels binary, v binary, lists binary"
    buckets = stage.write(sorted_rows.select("vec_id", "label", "v").mapInArrow(_buckets(size, BUCKET, shelves), bucket))
    stage.drop(base)
    shelves = buckets.agg(F.max("shelf")).first()[0] + 1
    asks = clean(anchors).where(F.col("size") == size).select("vec_id", "label", "v").distinct()
    asks = stage.write(asks.withColumn("ask", F.monotonically_increasing_id()))

    def best(asks: DataFrame, keep: int, same: bool) -> DataFrame:
        """(ask, slot, score, vec_id, rank) of the best rows whose scores lie between each slot's bounds."""
        pack = ", ".join(f"{c} binary" for c in PACK_COLUMNS) + ", from_label long, to_label long"
        packs = stage.write(asks.repartitionByRange("label", "ask").sortWithinPartitions("label", "ask").mapInArrow(_packs(size, PACK), pack))
        travelling = packs.withColumn("shelf", F.explode(F.sequence(F.lit(0), F.lit(shelves - 1)))).repartition(n, "shelf")
        meets = (F.col("first") <= F.col("to_label")) & (F.col("last") >= F.col("from_label"))
        if not same:
            meets = ~((F.col("first") == F.col("to_label")) & (F.col("last") == F.col("from_label")))
        staying = buckets.repartition(n, "shelf").withColumnRenamed("shelf", "place")
        pairs = travelling.hint("merge").join(staying, (F.col("shelf") == F.col("place")) & meets)
        pairs = pairs.select(*PACK_COLUMNS, "ids", "labels", "v", "lists")
        found = pairs.mapInArrow(_search(size, keep, same), "ask long, slot int, score long, vec_id long")
        window = Window.partitionBy("ask", "slot").orderBy(F.desc("score"), "vec_id")
        return stage.write(found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= keep))

    any_score = asks.withColumns({"low": F.array(F.lit(NONE).cast("long")), "high": F.array(F.lit(MOST).cast("long"))})
    near = best(any_score, positives, True).select("ask", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))

    # div rounds towards 0: right for scores from 0 on; below 0 no score lies between the bounds
    lowest, highest = F.expr(f"({low} * positive_score + 99) div 100"), F.expr(f"{high} * positive_score div 100")
    fits = F.col("positive_score") >= 0
    slots = near.groupBy("ask").agg(
        *[F.coalesce(F.max(F.when((F.col("slot") == i) & fits, lowest)), F.lit(1).cast("long")).alias(f"l{i}") for i in range(positives)],
        *[F.coalesce(F.max(F.when((F.col("slot") == i) & fits, highest)), F.lit(0).cast("long")).alias(f"h{i}") for i in range(positives)],
    )
    ranges = asks.join(slots, "ask").select(
        "ask", "vec_id", "label", "v", F.array(*[f"l{i}" for i in range(positives)]).alias("low"),
        F.array(*[f"h{i}" for i in range(positives)]).alias("high"),
    )
    hard = best(ranges, negatives, False)
    return hard.join(near, ["ask", "slot"]).join(asks.select("ask", F.col("vec_id").alias("anchor_id")), "ask").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


NEGATIVES_SQL = """
WITH valid AS (
  SELECT DISTINCT CAST(vec_id AS BIGINT) AS vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), ranked AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, a.v AS q, p.vec_id AS positive_id,
         CAST(list_inner_product(a.v, p.v) AS BIGINT) AS positive_score
  FROM valid a JOIN valid p ON a.label = p.label AND a.vec_id <> p.vec_id WHERE a.vec_id % 50 = 0
  QUALIFY row_number() OVER (PARTITION BY anchor_id, anchor_label, q ORDER BY positive_score DESC, positive_id) <= 5
), scored AS (
  SELECT r.anchor_id, r.anchor_label, r.q, r.positive_id, r.positive_score, n.vec_id AS negative_id,
         CAST(list_inner_product(r.q, n.v) AS BIGINT) AS negative_score
  FROM ranked r JOIN valid n ON n.label <> r.anchor_label
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, anchor_label, q, positive_id, positive_score ORDER BY negative_score DESC, negative_id) AS INTEGER) AS rank,
       negative_id, positive_score, negative_score
FROM scored
WHERE 50 * positive_score <= 100 * negative_score AND 100 * negative_score <= 95 * positive_score
QUALIFY rank <= 3
"""
