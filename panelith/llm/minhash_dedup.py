"""Near-duplicates by min-max hashing.

Each of ``perms`` hash functions is evaluated once per shingle, and both its minimum and its maximum
are kept: twice the signature for the same number of evaluations. Minima and maxima of different
functions are banded separately, ``rows`` values to a band; sets of similarity s share no band with
probability (1 - s**rows)**bands, that is 5e-8 at s = 0.8 with the default 32 bands of 4.

Documents with equal sets are one class from the start. Sets that share a band are candidates, and
candidates are confirmed on their full sets, in two steps. First a band's members are compared with a few leaders (the
smallest members of hash classes): most groups become one component here, at a cost linear in the band.
The leaders have then met everybody. Bands whose other members still lie in several components are
compared completely: members are dealt to packs of bounded size, and a task compares two packs by one
product of their incidence matrices and returns links between components only. So each candidate pair
is either compared or already connected - no cap, no lost link - and no pair of documents is ever a row
of a table. The second step is quadratic in what the first leaves unconnected within a band.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelith.llm.graph import components
from panelith.llm.staging import Stage, spread_count
from panelith.llm.wordbatch import WordBatch, chunks, mix, spans_hash

SHINGLE, PERCENT = 4, 80
PERMS, ROWS = 64, 4
LEADERS = 4
#: about so many members, and so many shingles, to a pack
PACK, PACK_GRAMS = 512, 40_000
NO_ID = 2**63 - 1
_RNG = np.random.default_rng(20240301)
FACTORS = _RNG.integers(0, 2**63, PERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _RNG.integers(0, 2**64, PERMS, dtype=np.uint64)


def shingle_sets(part: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text: of all its words, if they are fewer than width."""
    words = WordBatch(part, lower=True)
    h = words.hashes()
    counts = words.last - words.first
    at = np.arange(max(0, len(h) - width + 1))
    grams = spans_hash(h, at, at + width, 1)
    out = []
    for s, n in zip(words.first.tolist(), counts.tolist()):
        if n >= width:
            out.append(np.unique(grams[s : s + n - width + 1]))
        elif n:
            out.append(spans_hash(h, np.array([s]), np.array([s + n]), 1))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def min_max_bands(sets: list[np.ndarray], rows: int) -> list[np.ndarray]:
    """Band keys of non-empty sets, from the minima and the maxima of all hash functions."""
    if not sets:
        return []
    grams = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    low, high = np.empty((PERMS, len(sets)), np.uint64), np.empty((PERMS, len(sets)), np.uint64)
    for k in range(PERMS):
        values = grams * FACTORS[k] + SHIFTS[k]
        values ^= values >> np.uint64(29)
        values *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum.reduceat(values, starts, out=low[k])
        np.maximum.reduceat(values, starts, out=high[k])
    keys = []
    for band, at in enumerate(range(0, 2 * PERMS, rows)):
        key = np.zeros(len(sets), np.uint64)
        for k in range(at, at + rows):
            key = mix(key ^ (low[k] if k < PERMS else high[k - PERMS]), band)
        keys.append(key.view(np.int64))
    return list(np.stack(keys, axis=1))


def _survey(width: int, rows_per_band: int):
    def run(batches):
        for rows in batches:
            texts = rows.column("body").to_pylist()
            for a, b, part in chunks(texts):
                sets = shingle_sets(part, width)
                bands = iter(min_max_bands([s for s in sets if len(s)], rows_per_band))
                yield pa.RecordBatch.from_arrays([
                    rows.column("key").slice(a, b - a), rows.column("row").slice(a, b - a),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.sha256(s.tobytes()).digest()[:16] for s in sets], pa.binary()),
                    pa.array([next(bands) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ], names=["key", "row", "n", "set_id", "bands"])

    return run


def _sets(width: int):
    def run(batches):
        for rows in batches:
            texts = rows.column("body").to_pylist()
            for a, b, part in chunks(texts):
                sets = shingle_sets(part, width)
                yield pa.RecordBatch.from_arrays([
                    rows.column("key").slice(a, b - a),
                    pa.array([hashlib.sha256(s.tobytes()).digest()[:16] for s in sets], pa.binary()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ], names=["key", "set_id", "grams"])

    return run


def _incidence(grams: np.ndarray, owner: np.ndarray, count: int, common: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(common, grams), len(common) - 1)
    hit = common[at] == grams
    out = np.zeros((count, len(common)), np.float32)
    out[owner[hit], at[hit]] = 1
    return out


def pack_links(left, right, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the components of two packs (arrays of root and grams), one for each two roots."""
    sides = []
    for pack in (left, right):
        lists = pack.field("grams")
        sizes = np.diff(lists.offsets.to_numpy())
        sides.append((pack.field("root").to_numpy(), sizes, lists.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)))
    (root_a, n_a, grams_a, own_a), (root_b, n_b, grams_b, own_b) = sides
    common = np.intersect1d(grams_a, grams_b)
    if not len(common):
        return root_a[:0], root_b[:0]
    both = _incidence(grams_a, own_a, len(n_a), common) @ _incidence(grams_b, own_b, len(n_b), common).T
    both = np.rint(both).astype(np.int64)
    hit = (100 * both >= percent * (n_a[:, None] + n_b[None, :] - both)) & (root_a[:, None] != root_b[None, :])
    a, b = np.nonzero(hit)
    ends = np.unique(np.stack([np.minimum(root_a[a], root_b[b]), np.maximum(root_a[a], root_b[b])]), axis=1)
    return ends[0], ends[1]


def _compare(percent: int):
    def run(batches):
        for rows in batches:
            for i in range(rows.num_rows):
                a, b = pack_links(rows.column("left")[i].values, rows.column("right")[i].values, percent)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _linked(percent: int) -> Column:
    both = F.size(F.array_intersect("left", "right"))
    return 100 * both >= percent * (F.col("n_a") + F.col("n_b") - both)


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, rows_per_band: int = ROWS
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, family, row): the near-duplicate component of every row.

    A document's set holds the distinct shingles of ``width`` words (A-Z lower-cased) of its whole
    text, or its whole word sequence if that is shorter. Documents are linked if 100 * intersection >=
    ``percent`` * union. component_id is the smallest doc_id reachable; kept: it is the own one. ``family``
    numbers the components, those without any doc_id too; ``row`` is a hash of the text.

    One row per input row. Null, empty and blank texts have an empty set, are linked with nothing and
    have a null family.
    Rows with a null doc_id count as larger than every other; they have a null component_id unless a
    document with an id is reachable, and among themselves they are all kept. Rows with equal doc_id
    and linked texts are both kept. Other columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "minhash")
    body = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), F.xxhash64("text").alias("row"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"),
    )
    survey = stage.write(
        body.mapInArrow(_survey(width, rows_per_band), "key long, row long, n long, set_id binary, bands array<long>")
    )
    # a class per distinct set has a number; its smallest owner speaks for it
    classes = stage.write(
        survey.where("n > 0").groupBy("set_id").agg(F.min("key").alias("key"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    entries = (
        survey.join(classes, ["key", "set_id"]).dropDuplicates(["node"])
        .select("node", "n", "key", F.explode("bands").alias("band"))
    )
    # written, so that the join can split a band that very many sets share
    busy = stage.write(entries.groupBy("band").agg(F.count("*").alias("c")).where("c > 1").select("band"))
    members = stage.write(entries.join(busy, "band"))
    wanted = members.select("key", "node").distinct().join(classes.select("node", "set_id"), "node")
    sets = stage.write(
        body.join(wanted.select("key").distinct(), "key").mapInArrow(
            _sets(width), "key long, set_id binary, grams array<long>"
        ).join(wanted, ["key", "set_id"]).select("node", "grams").dropDuplicates(["node"])
    )

    # first step: every member of a band meets the band's leaders
    slot = F.pmod(F.xxhash64("node"), F.lit(LEADERS))
    leaders = stage.write(
        members.groupBy("band", slot.alias("slot")).agg(F.min(F.struct("key", "node", "n")).alias("lead")).drop("slot")
    )
    fits = F.least("n", "lead.n") * 100 >= F.greatest("n", "lead.n") * percent
    me, lead = F.struct("node", "n"), F.struct("lead.node", "lead.n")
    pairs = (
        members.join(leaders, "band").where(F.col("node") != F.col("lead.node")).where(fits)
        .select(F.least(me, lead).alias("x"), F.greatest(me, lead).alias("y")).distinct()
        .select(F.col("x.node").alias("a"), F.col("x.n").alias("n_a"), F.col("y.node").alias("b"), F.col("y.n").alias("n_b"))
    )
    links = (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("left")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("grams").alias("right")), "b")
        .where(_linked(percent)).select("a", "b")
    )
    stars = components(stage, links)
    rest = stage.write(
        members.join(leaders.select("band", F.col("lead.node").alias("node")), ["band", "node"], "left_anti")
        .join(stars, "node", "left").select("band", "node", "n", F.coalesce("root", "node").alias("root"))
    )
    open_bands = stage.write(
        rest.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("c"), F.sum("n").alias("size"))
        .where("low < high")
        .select("band", F.ceil(F.greatest(F.col("c") / PACK, F.col("size") / PACK_GRAMS)).alias("packs"))
    )
    named = classes.join(stars, "node", "left").select("set_id", "key", F.coalesce("root", "node").alias("root"))
    if not open_bands.isEmpty():
        # second step: what is left of such a band, completely, pack against pack
        packs = stage.write(
            rest.join(open_bands, "band").withColumn("pack", F.pmod(F.xxhash64("node"), F.col("packs")))
            .join(sets, "node").groupBy("band", "pack").agg(F.collect_list(F.struct("root", "grams")).alias("sets"))
        )
        left = packs.select("band", F.col("pack").alias("p"), F.col("sets").alias("left"))
        right = packs.select("band", F.col("pack").alias("q"), F.col("sets").alias("right"))
        more = left.join(right, "band").where("p <= q").select("left", "right").repartition(
            spread_count(spark)
        ).mapInArrow(_compare(percent), "a long, b long")
        moves = components(stage, more).withColumnRenamed("root", "to")
        named = named.join(moves, F.col("root") == F.col("node"), "left").select(
            "set_id", "key", F.coalesce("to", "root").alias("root")
        )
    stage.drop(sets, members, rest, leaders)

    named = stage.write(named)
    smallest = named.groupBy("root").agg(F.min("key").alias("component"))
    whole = stage.write(named.join(smallest, "root").select("set_id", "component", F.col("root").alias("family")))
    own = F.coalesce("component", "key")
    return survey.select("key", "row", "n", "set_id").join(whole, "set_id", "left").select(
        F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(own != NO_ID, own).alias("component_id"),
        (F.col("key") == own).alias("kept"),
        "family", "row",
    )
