"""Query registry: one Spark plan and (where SQL can say it) one independent DuckDB statement.

``cols`` declares the result once, as ``name:kind`` with kind i (whole number), f (real), s (text),
d (date, shown as text) or b (truth value, shown as 0/1). Both sides are shaped from it, so names,
types and rounding agree.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIGITS = 6
# Exact decimals often end in a 5 at the seventh place, where engines break ties differently; both
# sides move values off such ties before rounding.
NUDGE = 3e-8


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    cols: tuple[tuple[str, str], ...]
    uses: str
    body: str | None

    @property
    def sql(self) -> str | None:
        """The full statement; named table expressions are looked up once all plans are loaded."""
        return shape_sql(with_ctes(self.uses, self.body), self.cols) if self.body else None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return shape_frame(self.build(spark, sf_dir), self.cols)


REGISTRY: dict[str, Query] = {}
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def parse_cols(text: str) -> tuple[tuple[str, str], ...]:
    return tuple(tuple(part.split(":")) for part in text.split())


def shape_frame(df: DataFrame, cols) -> DataFrame:
    out = []
    for name, kind in cols:
        c = F.col(f"`{name}`")
        if kind == "i":
            c = c.cast("bigint")
        elif kind == "f":
            # adding zero turns a negative zero into a plain one
            c = F.round(c.cast("double") + NUDGE, DIGITS) + F.lit(0.0)
        elif kind == "b":
            c = c.cast("int").cast("bigint")
        else:
            c = c.cast("string")
        out.append(c.alias(name))
    return df.select(*out)


def shape_sql(body: str, cols) -> str:
    out = []
    for name, kind in cols:
        if kind == "i":
            e = f'CAST("{name}" AS BIGINT)'
        elif kind == "f":
            e = f'round(CAST("{name}" AS DOUBLE) + {NUDGE}, {DIGITS}) + 0.0'
        elif kind == "b":
            e = f'CAST(CAST("{name}" AS INTEGER) AS BIGINT)'
        else:
            e = f'CAST("{name}" AS VARCHAR)'
        out.append(f'{e} AS "{name}"')
    return f"SELECT {', '.join(out)} FROM ({body}) AS shaped"


def cte(name: str, deps: str, body: str) -> None:
    CTES[name] = (tuple(deps.split()), body)


def with_ctes(uses: str, body: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dep in CTES[name][0]:
            visit(dep)
        ordered.append(name)

    for use in uses.split():
        visit(use)
    if not ordered:
        return body
    parts = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered)
    return f"WITH RECURSIVE {parts}\n{body}"


def register(name: str, cols: str, uses: str = "", sql: str | None = None):
    """Decorator: ``sql`` may use the named table expressions listed in ``uses``."""
    parsed = parse_cols(cols)

    def wrap(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, parsed, uses, sql)
        return fn

    return wrap
