"""Mixing sources to target weights.

Words are counted per source; each source's target is its weighted part of a total, stopped at a
multiple of what the source has, the excess reshared by weight (water filling, in closed form: the
sources that stop are a prefix of the order by cap per weight). A source's repetition rate is target
over size: each document is emitted floor(rate) times, plus one hash-seeded Bernoulli copy with
probability equal to the fraction. A source draws its Bernoulli copies with one of ``seeds`` fixed
seeds, that whose total comes nearest to the target: each is a plain Bernoulli draw, and small
sources land near their targets too. Draws come from MD5, so any engine can repeat them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelith.llm.staging import Stage, free_names

WEIGHTS = (3, 1, 2)
SHARE, REPEATS, SEEDS = 1.5, 2, 32
#: more sources than this are joined by a shuffle instead of a broadcast (two small columns each)
BROADCAST_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fair_targets(sources: DataFrame, weights=WEIGHTS, share=SHARE, repeats=REPEATS) -> DataFrame:
    """(source, source_size) with weight and target; one row per source, so windows are small.

    Sources by code point, null last, weigh ``weights`` in turn.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double"))
    cap = (F.col("source_size") * repeats).cast("double")
    total = F.sum("source_size").over(Window.partitionBy()) * share
    order = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = (total - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum("weight").over(after)
    rows = weighed.withColumn("cap", cap).withColumn("level", level)
    stops = F.col("level") * F.col("weight") <= F.col("cap")
    final = F.first(F.when(stops, F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.least(F.col("cap"), F.coalesce(final, F.lit(float("inf"))) * F.col("weight"))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def draw(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the key: one of the eight-digit pieces of an MD5 sum."""
    digest = F.md5(F.concat(F.lit(f"mix{seed // 4}:"), key))
    return F.conv(F.substring(digest, seed % 4 * 8 + 1, 8), 16, 10).cast("double") / float(2**32)


def _near(side: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(side) if few else side


def _key() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))


def plan_mix(docs: DataFrame, weights, share: float, repeats: int, seeds: int) -> tuple[DataFrame, DataFrame, bool]:
    """Sizes (doc_id, source, size), plans (its_source, mix), and whether plans are few enough to broadcast.

    ``mix`` holds source_size, target, rate and seed of a source.
    """
    stage = Stage(docs.sparkSession, "mix")
    rows = stage.write(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    targets = stage.write(
        fair_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, repeats)
    )
    few = targets.count() <= BROADCAST_SOURCES
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.withColumn("rate", rate)
    part = F.col("rate") - F.floor("rate")
    rates = targets.select(F.col("source").alias("its_source"), "rate")
    drawn = [F.sum(F.when(draw(_key(), s) < part, F.col("size")).otherwise(F.lit(0))) for s in range(seeds)]
    sums = rows.join(_near(rates, few), F.col("source").eqNullSafe(F.col("its_source"))).groupBy("its_source").agg(
        *[d.alias(f"drawn_{s}") for s, d in enumerate(drawn)]
    )
    miss = [
        F.struct(F.abs(F.floor("rate") * F.col("source_size") + F.col(f"drawn_{s}") - F.col("target")), F.lit(s).alias("seed"))
        for s in range(seeds)
    ]
    plans = targets.join(_near(sums, few), F.col("source").eqNullSafe(F.col("its_source"))).select(
        F.col("source").alias("its_source"),
        F.struct("source_size", "target", "rate", F.array_min(F.array(*miss))["seed"].alias("seed")).alias("mix"),
    )
    return rows, stage.write(plans), few


def _copies(mix: str = "mix") -> Column:
    """floor(rate) and the Bernoulli copy, for rows joined with their source's plan."""
    seed, rate = F.col(f"{mix}.seed"), F.col(f"{mix}.rate")
    digest = F.md5(F.concat(F.lit("mix"), F.floor(seed / 4).cast("string"), F.lit(":"), _key()))
    mine = F.conv(F.substring(digest, seed % 4 * 8 + 1, F.lit(8)), 16, 10).cast("double") / float(2**32)
    return (F.floor(rate) + (mine < rate - F.floor(rate)).cast("int")).cast("long")


def mix_sources(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seeds: int = SEEDS
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken): how often the mix takes each row.

    size: words of the text (null: 0). A null source is a source of its own, the last. Rows with equal
    doc_id draw the same number; a null doc_id draws as the text ``null``. A source without words has
    target 0 and no copies. Other columns are ignored. An empty table gives no rows.
    """
    rows, plans, few = plan_mix(docs, weights, share, repeats, seeds)
    joined = rows.join(_near(plans, few), F.col("source").eqNullSafe(F.col("its_source")))
    return joined.withColumn("copies", _copies()).select(
        "doc_id", "source", "size", "mix.source_size", "mix.target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix_documents(
    docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seeds: int = SEEDS
) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as ``mix_sources`` takes it; texts are not shuffled."""
    _, plans, few = plan_mix(docs, weights, share, repeats, seeds)
    its, mix = free_names(docs, "__source", "__mix")
    plans = plans.select(F.col("its_source").alias(its), F.col("mix").alias(mix))
    rows = docs.join(_near(plans, few), F.col("source").eqNullSafe(F.col(its)))
    own = [F.col(f"`{c}`") for c in docs.columns]
    copies = _copies(mix)
    return rows.where(copies > 0).select(*own, F.explode(F.array_repeat(F.lit(0), copies.cast("int")))).select(*own)


_SEEDS = ", ".join(
    f"({s}, 'mix{s // 4}:', {s % 4 * 8 + 1})" for s in range(SEEDS)
)
#: the same mix for DuckDB
MIX_SQL = f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, source_size * {REPEATS}.0::DOUBLE AS cap, CAST(sum(source_size) OVER () AS DOUBLE) * {SHARE}::DOUBLE AS total,
  [{', '.join(f'{x}::DOUBLE' for x in WEIGHTS)}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight FROM s),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT max(level) FILTER (level * weight <= cap) AS level FROM l),
t AS (SELECT source, source_size, least(cap, coalesce(f.level, CAST('inf' AS DOUBLE)) * weight) AS target FROM l, f),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
seeds(seed, prefix, place) AS (VALUES {_SEEDS}),
c AS (SELECT d.*, r.source_size, r.target, r.rate, seed,
  CAST(('0x' || substr(md5(prefix || coalesce(CAST(doc_id AS VARCHAR), 'null')), place, 8)) AS BIGINT) / 4294967296.0::DOUBLE < rate - floor(rate) AS extra
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source, seeds),
m AS (SELECT source, seed, abs(floor(any_value(rate)) * any_value(source_size) + sum(CASE WHEN extra THEN size ELSE 0 END) - any_value(target)) AS miss
  FROM c GROUP BY 1, 2),
b AS (SELECT source, seed FROM m QUALIFY row_number() OVER (PARTITION BY source ORDER BY miss, seed) = 1)
SELECT doc_id, size, source_size, target, CAST((floor(rate) + extra::INT) * size AS BIGINT) AS taken
FROM c JOIN b ON c.seed = b.seed AND c.source IS NOT DISTINCT FROM b.source"""
