"""Small column helpers shared by the operators: null hygiene, guards, frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

RANK_DIGITS = 10


def finite(col: Column | str) -> Column:
    """NaN and infinities become NULL; NULL stays NULL."""
    c = F.col(col) if isinstance(col, str) else col
    c = c.cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(c)


def null_hygiene(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: finite(c) for c in columns})


def ratio(num: Column, den: Column) -> Column:
    """Division where a zero denominator is missing, also under ANSI mode."""
    return num / F.when(den != 0, den)


def clamp(col: Column, lo: float | Column, hi: float | Column) -> Column:
    """Bounds keep NULL as NULL (greatest/least alone would skip it)."""
    lo_c = lo if isinstance(lo, Column) else F.lit(float(lo))
    hi_c = hi if isinstance(hi, Column) else F.lit(float(hi))
    return F.when(col.isNotNull(), F.least(hi_c, F.greatest(lo_c, col)))


def by_entity(entity: str = "entity", dt: str = "dt") -> WindowSpec:
    """Time order within an entity. Rows per entity are bounded by the calendar."""
    return Window.partitionBy(entity).orderBy(dt)


def full_frame(value: Column, agg: Column, frame: WindowSpec, size: int) -> Column:
    """``agg`` only when the frame holds ``size`` non-null values."""
    return F.when(F.count(value).over(frame) == size, agg.over(frame))


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation of the rows with both values; NULL when a side is constant (the built-in
    aggregate raises there under ANSI mode)."""
    both = x.isNotNull() & y.isNotNull()
    cx, cy = F.when(both, x), F.when(both, y)
    spread = F.stddev_pop(cx) * F.stddev_pop(cy)
    return F.covar_pop(cx, cy) / F.when(spread > 0, spread)


def guarded_corr(x: str, y: str, floor: int, digits: int = RANK_DIGITS) -> Column:
    """Pearson correlation of two columns, NULL below ``floor`` pairs or without spread.

    Spread is judged on rounded deviations so that constants which differ only in the last bits
    count as constants.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    cx, cy = F.when(both, F.col(x)), F.when(both, F.col(y))
    spread = (F.round(F.stddev_pop(cx), digits) > 0) & (F.round(F.stddev_pop(cy), digits) > 0)
    return F.when((F.count(cx) >= floor) & spread, safe_corr(F.col(x), F.col(y)))


def sigmoid(col: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col))


def map_lookup(mapping: dict, key: Column) -> Column:
    """A fixed lookup as a literal map; unknown keys give NULL."""
    flat = [F.lit(v) for kv in mapping.items() for v in kv]
    return F.try_element_at(F.create_map(*flat), key)
