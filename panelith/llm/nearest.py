"""Nearest neighbours by largest inner product, over a tiny projected index.

Vectors are extended by one component that gives all of them the largest norm M, so the largest inner
products are the smallest distances (d*d = |q|*|q| + M*M - 2 q.x). ``dims`` random Gaussian (2-stable)
projections shrink the vectors: the squared projected distance of two vectors, over their squared
distance, is chi-square with ``dims`` degrees of freedom. A kd-tree over the projections yields a
query's projected neighbours from near to far; they are verified on the original vectors until the
projected distance reaches R with R*R = quantile(confidence) * d_k*d_k, where d_k is the distance of
the k-th best so far: a point nearer than that is beyond R with probability 1 - confidence at most.

In Spark, the upper levels of the tree (split on a bounded sample) deal the vectors to at most
``CELLS`` cells, cells to blocks of about ``BLOCK`` rows by hash, and each block holds the lower levels.
A query searches its own cell first; the bound found there decides which other cells its ball reaches.
Queries travel in packs, so a block's tree is built once per pack and no group grows with the data.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelith.llm.staging import Stage

K, DIMS, CONFIDENCE = 20, 10, 0.95
#: leaves of the first lot; each further lot has four times as many
FIRST_LEAVES = 4
CELL, CELLS, BLOCK, PACK, LEAF, SAMPLE = 4096, 1024, 8192, 512, 64, 20_000


def chi_square_quantile(dims: int, share: float) -> float:
    """Quantile of the chi-square distribution with an even number of degrees of freedom."""
    if dims % 2:
        raise ValueError("dims must be even")

    def beyond(x: float) -> float:
        return math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))

    low, high = 0.0, 20.0 * dims + 200
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if beyond(middle) > 1 - share else (low, middle)
    return high


@dataclass(frozen=True)
class Projection:
    """Stable projections of extended vectors, and the upper kd-tree's cells."""

    matrix: np.ndarray
    norm: float
    axis: np.ndarray
    split: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, norm: float, cells: int, dims: int = DIMS) -> Projection:
        matrix = np.random.default_rng(11).normal(size=(sample.shape[1] + 1, dims))
        bare = cls(matrix, norm, np.zeros(0, int), np.zeros(0))
        low = bare.points(sample)
        axis, split = np.zeros(cells - 1, int), np.zeros(cells - 1)
        groups = [np.arange(len(low))]
        for node in range(cells - 1):
            mine = groups[node]
            spread = np.ptp(low[mine], axis=0) if len(mine) else np.zeros(dims)
            axis[node] = int(spread.argmax())
            split[node] = np.median(low[mine, axis[node]]) if len(mine) else 0.0
            left = low[mine, axis[node]] <= split[node]
            groups += [mine[left], mine[~left]]
        return cls(matrix, norm, axis, split)

    def points(self, vectors: np.ndarray) -> np.ndarray:
        """Projections of stored vectors."""
        rest = np.sqrt(np.maximum(self.norm**2 - (vectors * vectors).sum(axis=1), 0.0))
        return vectors @ self.matrix[:-1] + rest[:, None] * self.matrix[-1]

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.matrix[:-1]

    def cell(self, low: np.ndarray) -> np.ndarray:
        node = np.zeros(len(low), int)
        while len(self.axis) and node.min() < len(self.axis):
            right = low[np.arange(len(low)), self.axis[node]] > self.split[node]
            node = 2 * node + 1 + right
        return node - len(self.axis)


class Tree:
    """kd-tree of one block: leaves of about LEAF points with their bounding boxes."""

    def __init__(self, low: np.ndarray):
        order, leaves, todo = np.arange(len(low)), [], [(0, len(low))]
        while todo:
            s, e = todo.pop()
            if e - s <= LEAF:
                leaves.append((s, e))
                continue
            mine = order[s:e]
            axis = int(np.ptp(low[mine], axis=0).argmax())
            middle = (e - s) // 2
            order[s:e] = mine[np.argpartition(low[mine, axis], middle)]
            todo += [(s, s + middle), (s + middle, e)]
        self.order = order
        self.starts, self.ends = np.array(leaves).T
        self.low = np.array([low[order[s:e]].min(axis=0) for s, e in leaves])
        self.high = np.array([low[order[s:e]].max(axis=0) for s, e in leaves])


class Block:
    """The vectors of a block in the order of their leaves, with their projections."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projection: Projection):
        low = projection.points(vectors)
        self.tree = Tree(low)
        order = self.tree.order
        self.ids, self.vectors, self.low = ids[order], vectors[order], low[order]
        by_place = np.argsort(self.tree.starts)
        self.boxes = self.tree.low[by_place], self.tree.high[by_place]
        self.sizes = (self.tree.ends - self.tree.starts)[by_place]
        self.norm2 = projection.norm**2


def box_distance(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point to boxes."""
    gap = np.maximum(0.0, np.maximum(low - q, q - high))
    return (gap * gap).sum(axis=1)


def search_block(block: Block, q: np.ndarray, query_id: int, query: np.ndarray, bound: float, k: int, factor: float):
    """(ids, scores) of the best k of a block for one query; q: its projection; ``bound``: a squared
    distance to beat."""
    base = float(query @ query) + block.norm2
    reach = box_distance(q, *block.boxes)
    leaves = np.argsort(reach, kind="stable")
    found_ids, found = np.zeros(0, np.int64), np.zeros(0)
    at, step = 0, FIRST_LEAVES
    while at < len(leaves) and reach[leaves[at]] <= factor * bound:
        lot = np.zeros(len(leaves), bool)
        lot[leaves[at : at + step]] = True
        rows = np.flatnonzero(np.repeat(lot & (reach <= factor * bound), block.sizes))
        gap = block.low[rows] - q
        rows = rows[(np.einsum("ij,ij->i", gap, gap) <= factor * bound) & (block.ids[rows] != query_id)]
        # row by row in one order of summation: equal vectors have equal scores
        scores = np.einsum("ij,j->i", block.vectors[rows], query)
        found_ids, found = np.concatenate([found_ids, block.ids[rows]]), np.concatenate([found, scores])
        if len(found) > k:
            best = np.lexsort((found_ids, -found))[:k]
            found_ids, found = found_ids[best], found[best]
        if len(found) == k:
            # a little wider, so that rounding does not part equals
            bound = min(bound, max(base - 2 * float(found.min()), 0.0) * (1 + 1e-9) + 1e-12)
        at, step = at + step, step * 4
    return found_ids, found


def _clean(batches):
    """Valid vectors as doubles, with their length and squared norm."""
    for rows in batches:
        ids, lists = rows.column("vec_id"), rows.column("embedding")
        lists = lists.cast(pa.list_(pa.float64()))
        good, values = [], []
        for i, v in enumerate(lists):
            if not v.is_valid or not ids[i].is_valid or len(v.values) == 0 or v.values.null_count:
                continue
            x = v.values.to_numpy()
            if np.isfinite(x).all() and x.any():
                good.append(i)
                values.append(x)
        yield pa.RecordBatch.from_arrays([
            ids.take(pa.array(good, pa.int64())).cast(pa.int64()), pa.array(values, pa.list_(pa.float64())),
            pa.array([len(x) for x in values], pa.int32()), pa.array([float(x @ x) for x in values], pa.float64()),
        ], names=["vec_id", "v", "size", "norm2"])


def _matrix(lists: pa.Array) -> np.ndarray:
    n = len(lists)
    return lists.flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, 1))


def _place(projection: Projection, as_query: bool):
    def run(batches):
        for rows in batches:
            if not rows.num_rows:
                continue
            vectors = _matrix(rows.column("v"))
            low = projection.queries(vectors) if as_query else projection.points(vectors)
            yield pa.RecordBatch.from_arrays([
                rows.column("vec_id"), rows.column("v"), pa.array(projection.cell(low).astype(np.int32)),
                pa.array(list(low), pa.list_(pa.float64())),
            ], names=["vec_id", "v", "cell", "low"])

    return run


def _search(projection: Projection, k: int, factor: float):
    """One row per (block, pack of queries): the best k of the block for each query."""

    def run(batches):
        for rows in batches:
            out_q, out_v, out_s = [], [], []
            for i in range(rows.num_rows):
                base, pack = rows.column("base")[i].values, rows.column("pack")[i].values
                ids, vectors = base.field("vec_id").to_numpy(), _matrix(base.field("v"))
                order = np.lexsort((*vectors.T[::-1], ids))
                ids, vectors = ids[order], vectors[order]
                fresh = np.ones(len(ids), bool)
                fresh[1:] = (ids[1:] != ids[:-1]) | (vectors[1:] != vectors[:-1]).any(axis=1)
                ids, vectors = ids[fresh], vectors[fresh]
                block, queries = Block(ids, vectors, projection), _matrix(pack.field("v"))
                asks = zip(
                    pack.field("vec_id").to_pylist(), projection.queries(queries), queries, pack.field("bound").to_pylist()
                )
                for query_id, q, query, bound in asks:
                    got, scores = search_block(block, q, query_id, query, bound, k, factor)
                    out_q.append(np.full(len(got), query_id, np.int64))
                    out_v.append(got)
                    out_s.append(scores)
            if out_q:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (out_q, out_v, out_s)], names=["query_id", "vec_id", "score"]
                )

    return run


def _spread(projection: Projection, boxes: list[tuple[int, np.ndarray, np.ndarray]], factor: float):
    """The other cells that a query's ball reaches."""

    def run(batches):
        cells = np.array([c for c, _, _ in boxes], np.int32)
        low, high = np.array([b for _, b, _ in boxes]), np.array([b for _, _, b in boxes])
        for rows in batches:
            if not rows.num_rows:
                continue
            home, bounds = rows.column("cell").to_numpy(), rows.column("bound").to_numpy()
            at, to = [], []
            for i, q in enumerate(projection.queries(_matrix(rows.column("v")))):
                hit = cells[(box_distance(q, low, high) <= factor * bounds[i]) & (cells != home[i])]
                at.append(np.full(len(hit), i))
                to.append(hit)
            at, to = np.concatenate(at), np.concatenate(to)
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [rows.column(n).take(take) for n in ("vec_id", "v")] + [pa.array(to), rows.column("bound").take(take)],
                names=["vec_id", "v", "cell", "bound"],
            )

    return run


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = K, dims: int = DIMS, confidence: float = CONFIDENCE
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest rows, by inner product in double precision.

    ``vectors`` and ``queries`` hold (vec_id, embedding). Rows of the query's own vec_id are no
    candidates. Fewer candidates than k give all of them. Ties go to the smaller vec_id. Rows with a
    null vec_id, and vectors that are null, empty, zero, of another length than most or with null or
    non-finite components take no part. A row repeated with the same vector counts once. Other columns
    are ignored. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    stage = Stage(spark, "nearest")
    schema = "vec_id long, v array<double>, size int, norm2 double"
    clean = stage.write(vectors.select("vec_id", "embedding").mapInArrow(_clean, schema))
    sizes = clean.groupBy("size").agg(F.count("*").alias("n"), F.max("norm2").alias("norm2"))
    top = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    if top is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    clean = clean.where(F.col("size") == top["size"])
    cells = 1 << max(0, min(CELLS, -(-top["n"] // CELL)) - 1).bit_length()
    sample = clean.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toPandas()["v"]
    projection = Projection.fit(np.array(sample.tolist()), math.sqrt(top["norm2"]), cells, dims)
    factor = chi_square_quantile(dims, confidence)

    placed = "vec_id long, v array<double>, cell int, low array<double>"
    base = stage.write(clean.select("vec_id", "v").mapInArrow(_place(projection, False), placed))
    edges = [F.min(F.col("low")[i]).alias(f"l{i}") for i in range(dims)]
    edges += [F.max(F.col("low")[i]).alias(f"h{i}") for i in range(dims)]
    cell_rows = base.groupBy("cell").agg(F.count("*").alias("n"), *edges).collect()  # at most CELLS rows
    boxes = [
        (r["cell"], np.array([r[f"l{i}"] for i in range(dims)]), np.array([r[f"h{i}"] for i in range(dims)]))
        for r in cell_rows
    ]
    blocks = spark.createDataFrame([(r["cell"], -(-r["n"] // BLOCK)) for r in cell_rows], "cell int, blocks long")
    block = F.pmod(F.xxhash64("vec_id"), F.col("blocks"))
    packed = stage.write(
        base.join(F.broadcast(blocks), "cell").groupBy("cell", block.alias("block"))
        .agg(F.collect_list(F.struct("vec_id", "v")).alias("base"))
    )

    def search(asks: DataFrame) -> DataFrame:
        """asks: (vec_id, v, cell, bound)."""
        counts = asks.groupBy("cell").agg(F.ceil(F.count("*") / PACK).alias("packs"))
        pack = F.pmod(F.xxhash64("vec_id"), F.col("packs")).alias("part")
        # at most CELLS counts
        packs = asks.join(F.broadcast(counts), "cell").groupBy("cell", pack).agg(
            F.collect_list(F.struct("vec_id", "v", "bound")).alias("pack")
        )
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        pairs = packed.join(packs, "cell").select("base", "pack").repartition(n)
        return pairs.mapInArrow(_search(projection, k, factor), "query_id long, vec_id long, score double")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def top_k(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    mine = queries.select("vec_id", "embedding").mapInArrow(_clean, schema).where(F.col("size") == top["size"])
    mine = stage.write(mine.select("vec_id", "v").dropDuplicates().mapInArrow(_place(projection, True), placed))
    near = stage.write(top_k(search(mine.withColumn("bound", F.lit(float("inf"))).drop("low"))))
    last = near.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("worst"))
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x) + top["norm2"]
    bound = F.coalesce(F.greatest(norm2 - 2 * F.col("worst"), F.lit(0.0)) * (1 + 1e-9) + 1e-12, F.lit(float("inf")))
    reached = stage.write(
        mine.join(last, "vec_id", "left").select("vec_id", "v", "cell", bound.alias("bound"))
        .mapInArrow(_spread(projection, boxes, factor), "vec_id long, v array<double>, cell int, bound double")
    )
    far = stage.write(search(reached))
    result = top_k(near.drop("rank").union(far))
    return result.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
