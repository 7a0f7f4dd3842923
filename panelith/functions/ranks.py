"""Exact ranks inside groups of any size.

A plain window puts a whole group into one task. That is the right plan while a group is known
to be small (a cross-section of a few thousand names), so callers who know a bound pass it as
``group_bound`` and get the window. Without a bound, or beyond ``WINDOW_GROUP_LIMIT``, rows are sorted
over ranges of the session's number of partitions: each range is numbered on its own and shifted by
what the ranges before it hold. Both plans give the same result for every input: NaN is larger than
every number, NULL comes last, a NULL key is a group of its own, any orderable tiebreak will do, and
rows that tie on everything have different positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelith.functions.columns import RANK_DIGITS
from panelith.session import cut_lineage

WINDOW_GROUP_LIMIT = 500_000
#: (group, piece) rows of offsets that are broadcast
OFFSETS_LIMIT = 200_000


def fits_window(group_bound: int | None) -> bool:
    return group_bound is not None and group_bound <= WINDOW_GROUP_LIMIT


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, where NULL equals NULL; the right side's keys are dropped."""
    if not keys:
        return left.crossJoin(F.broadcast(right))
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def _ranged(df: DataFrame, order: list[Column]) -> DataFrame:
    """The rows dealt to ascending ranges (``_range``), written so that the ranges stay what they are."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()))


def _before(ranged: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Per (keys, _range): each measure's sum over the group's earlier ranges, and over the group."""
    totals = ranged.groupBy(*keys, "_range").agg(*[F.sum(m).alias(f"_n_{m}") for m in measures])
    # a group has at most one row per range here
    by_range = Window.partitionBy(*keys).orderBy("_range")
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    group = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return totals.select(
        *keys, "_range",
        *[F.coalesce(F.sum(f"_n_{m}").over(earlier), F.lit(0)).alias(f"_o_{m}") for m in measures],
        *[F.sum(f"_n_{m}").over(group).alias(f"{m}_total") for m in measures],
    )


def cumulative_table(
    df: DataFrame, keys: list[str], value: str, measures: dict
) -> DataFrame:
    """One row per (keys, distinct non-null value) with, for every measure (a summable aggregate),
    ``m``, ``m_below`` (its sum over smaller values) and ``m_total`` (its sum over the group).
    No task ever holds a whole group."""
    names = list(measures)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(*[agg.alias(m) for m, agg in measures.items()])
    )
    ranged = _ranged(counts, [*[F.col(k).asc() for k in keys], F.col(value).asc()])
    inside = Window.partitionBy(*keys, "_range").orderBy(value)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns(
        {f"_b_{m}": F.coalesce(F.sum(m).over(before), F.lit(0)) for m in names}
    )
    return join_same(local, _before(ranged, keys, names), [*keys, "_range"]).select(
        *keys,
        value,
        *names,
        *[(F.col(f"_b_{m}") + F.col(f"_o_{m}")).alias(f"{m}_below") for m in names],
        *[f"{m}_total" for m in names],
    )


def rank_table(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per (keys, distinct value): ``cnt``, ``below`` (rows with a smaller value), ``total``."""
    table = cumulative_table(df, keys, value, {"cnt": F.count(F.lit(1))})
    return table.withColumnsRenamed({"cnt_below": "below", "cnt_total": "total"})


def tie_rank(
    df: DataFrame,
    keys: list[str],
    value: str,
    rank: str = "rank",
    size: str | None = None,
    group_bound: int | None = None,
    digits: int | None = RANK_DIGITS,
    staged: bool = False,
) -> DataFrame:
    """Adds the tie-averaged 1-based rank of ``value`` within ``keys`` (NULL for a NULL value)
    and, on request, the number of non-null values in the group. Without a bound the input is used
    twice, so it is written once first unless it already comes from files (``staged``)."""
    windowed = fits_window(group_bound)
    if not windowed and not staged:
        df = cut_lineage(df)
    rounded = F.round(F.col(value), digits) if digits is not None else F.col(value)
    df = df.withColumn("_rv", rounded)
    if windowed:
        order = Window.partitionBy(*keys).orderBy(F.col("_rv").asc_nulls_last())
        ties = order.rangeBetween(Window.currentRow, Window.currentRow)
        whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        out = df.withColumn(
            rank,
            F.when(
                F.col("_rv").isNotNull(),
                F.rank().over(order) + (F.count("_rv").over(ties) - 1) / 2.0,
            ),
        )
        if size:
            out = out.withColumn(size, F.count("_rv").over(whole))
        return out.drop("_rv")
    table = rank_table(df, keys, "_rv").select(
        *keys,
        "_rv",
        (F.col("below") + (F.col("cnt") + 1) / 2.0).alias(rank),
    )
    # rows without a value have no rank: they stay out of the join, where they would meet on one key
    known = join_same(df.where("_rv IS NOT NULL"), table, [*keys, "_rv"])
    none = df.where("_rv IS NULL").withColumn(rank, F.lit(None).cast("double"))
    out = known.unionByName(none).drop("_rv")
    if size:
        totals = df.groupBy(*keys).agg(F.count("_rv").alias(size))
        out = join_same(out, totals, keys)
    return out


def value_cuts(df: DataFrame, values: list[str], pieces: int, keys: list[str] | None = None) -> tuple[dict[str, list[float]], int]:
    """For each of the (non-null) values the cut points between about equal shares of the rows, and roughly the
    number of groups: one pass, a few numbers for the driver. A value that holds several shares is a cut once."""
    share = F.array(*[F.lit(i / pieces) for i in range(1, pieces)])
    aggs = [F.percentile_approx(v, share, 100 * pieces).alias(v) for v in values] if pieces > 1 else []
    row = df.agg(*aggs, F.approx_count_distinct(F.struct(*keys) if keys else F.lit(1)).alias("_groups")).first()
    return {v: sorted(set(row[v] or [])) if pieces > 1 else [] for v in values}, row["_groups"]


def piece_of(value: Column, cuts: list[float]) -> Column:
    """The number of cuts below the value, by a search tree; equal values share a piece."""

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value <= F.lit(cuts[mid]), search(lo, mid)).otherwise(search(mid + 1, hi))

    return search(0, len(cuts))


def ranged_span(df: DataFrame, keys: list[str], value: str, cuts: list[float], lo: str, hi: str, piece: str) -> DataFrame:
    """Adds how many rows of the group have a smaller value (``lo``) and at most the value (``hi``), and the piece.

    ``df``: written rows without nulls in the value. They are shuffled once, by group and piece; what the pieces
    before hold is one broadcast row per group and piece.
    """
    placed = df.withColumn(piece, piece_of(F.col(value), cuts))
    before = Window.partitionBy(*keys).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(*keys, piece).agg(F.count(F.lit(1)).alias("_one"))
    offsets = sizes.select(*keys, piece, F.coalesce(F.sum("_one").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*keys, piece).orderBy(value)
    local = placed.withColumns({lo: F.rank().over(inside) - 1, hi: F.count(F.lit(1)).over(inside)})
    out = join_same(local, F.broadcast(offsets), [*keys, piece])
    return out.withColumns({lo: F.col(lo) + F.col("_off"), hi: F.col(hi) + F.col("_off")}).drop("_off")


def pooled_ranks(df: DataFrame, keys: list[str], names: dict[str, str], pieces: int | None = None) -> DataFrame:
    """Tie-averaged ranks of several (non-null) values of written rows, one shuffle each. Values that hold many of
    the rows, and many small groups, go through the counts per distinct value."""
    pieces = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rounded = {f"_rv_{v}": F.round(F.col(v), RANK_DIGITS) for v in names}
    cuts, groups = value_cuts(df.withColumns(rounded), list(rounded), pieces, keys)
    for v, rank in names.items():
        at = f"_rv_{v}"
        if len(cuts[at]) < pieces - 1 or groups * pieces > OFFSETS_LIMIT:
            df = tie_rank(df, keys, v, rank, staged=True)
        else:
            spans = ranged_span(df.withColumn(at, rounded[at]), keys, at, cuts[at], "_lo", "_hi", "_piece")
            df = spans.withColumn(rank, (F.col("_lo") + F.col("_hi") + 1) / 2.0).drop(at, "_lo", "_hi", "_piece")
    return df


def order_number(
    df: DataFrame,
    keys: list[str],
    value: str,
    tiebreak: str,
    number: str = "rn",
    descending: bool = False,
    group_bound: int | None = None,
    digits: int | None = RANK_DIGITS,
    staged: bool = False,
) -> DataFrame:
    """Adds a 1-based position by (value, tiebreak); ``tiebreak`` is any orderable column, always
    ascending. NULL values come last and NaN before them, in either direction."""
    windowed = fits_window(group_bound)
    if not windowed and not staged:
        df = cut_lineage(df)
    rounded = F.round(F.col(value), digits) if digits is not None else F.col(value)
    df = df.withColumn("_rv", -rounded if descending else rounded)
    if windowed:
        order = Window.partitionBy(*keys).orderBy(F.col("_rv").asc_nulls_last(), tiebreak)
        return df.withColumn(number, F.row_number().over(order)).drop("_rv")
    order = [F.col("_rv").asc_nulls_last(), F.col(tiebreak).asc()]
    ranged = _ranged(df.withColumn("_one", F.lit(1)), [*[F.col(k).asc() for k in keys], *order])
    inside = Window.partitionBy(*keys, "_range").orderBy(*order)
    local = ranged.withColumn(number, F.row_number().over(inside))
    shifts = _before(ranged, keys, ["_one"]).drop("_one_total")
    return (
        join_same(local, shifts, [*keys, "_range"])
        .withColumn(number, (F.col(number) + F.col("_o__one")).cast("long"))
        .drop("_rv", "_one", "_range", "_o__one")
    )


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, qs: list[float], name: str = "q"
) -> DataFrame:
    """(keys, q0, q1, ...): linearly interpolated quantiles of groups of any size, read off the
    counts per distinct value instead of one sorted buffer."""
    table = rank_table(df, keys, value)
    aggs = []
    for i, q in enumerate(qs):
        pos = F.lit(float(q)) * (F.col("total") - 1)
        first, last = F.col("below"), F.col("below") + F.col("cnt") - 1
        lo, hi = F.floor(pos), F.ceil(pos)
        at_lo = F.max(F.when((first <= lo) & (lo <= last), F.col(value)))
        at_hi = F.max(F.when((first <= hi) & (hi <= last), F.col(value)))
        frac = F.max(pos - lo)
        aggs.append((at_lo + (at_hi - at_lo) * frac).alias(f"{name}{i}"))
    return table.groupBy(*keys).agg(*aggs)
