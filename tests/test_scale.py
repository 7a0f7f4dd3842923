"""Steps that must not grow faster than their input."""

import datetime as dt
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from panelith.operators import joins as J
from panelith.operators import models as M
from panelith.operators import states as S


def test_entities_are_dealt_to_more_parts_the_more_there_are(spark):
    rows = spark.range(50).withColumnRenamed("id", "entity")
    few, many = (J.deal_entities(rows, n) for n in (50, 20 * J.ENTITIES_A_TASK))
    assert (few.rdd.getNumPartitions(), many.rdd.getNumPartitions()) == (4, 20)
    assert sorted(r[0] for r in many.collect()) == list(range(50))


def test_realized_alpha_does_not_depend_on_the_parts(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=7 * i) for i in range(6)]
    prices = spark.createDataFrame([(e, d, float(e + i)) for e in (1, 2, 3) for i, d in enumerate(days)], "entity long, dt date, close double")
    bench = spark.createDataFrame([(s, d, 10.0 + i) for s in ("a", "market") for i, d in enumerate(days)], "symbol string, dt date, close double")
    dim = spark.createDataFrame([(1, "a"), (2, "none"), (2, "none")], "entity long, symbol string")
    # the repeated pair, the repeated entity and the missing day stay what they were
    pairs = spark.createDataFrame([(1, days[0]), (1, days[0]), (2, days[1]), (3, days[4]), (3, None)], "entity long, dt date")
    got = [Counter(map(tuple, J.realized_alpha(pairs, prices, bench, 2, dim, entities=n).collect())) for n in (None, 3, 5000)]
    assert got[0] == got[1] == got[2] and sum(got[0].values()) == 6


def test_places_of_whole_batches_are_a_bijection():
    for n in (1, 2, 17, 1000):
        for key in range(3):
            assert sorted(M.shuffled_places(np.arange(n), n, key)) == list(range(n))


def test_hazards_that_share_densities_equal_one_at_a_time():
    draw = np.random.default_rng(3)
    series = [draw.normal(size=k) for k in (9, 40, 25)]
    prior = S.ChangePointPrior(horizon=20)
    grid = np.array([[0.01] * 3, [0.1, 0.2, 0.3]])
    got = S.run_length_grid(series, grid, prior, [3, 8])
    for hazards, each in zip(grid, got):
        for x, h, table in zip(series, hazards, each):
            post, want = S.RunLengthPosterior(S.ChangePointPrior(hazard=h, horizon=20)), []
            for v in x:
                post.observe(v)
                want.append((post.short_mass(3), post.short_mass(8), post.top_mass()))
            np.testing.assert_allclose(table, want, rtol=1e-9)


def test_second_level_inputs_are_the_same_by_windows_and_by_joins(spark, tmp_path, monkeypatch):
    """One shuffle per entity where entities are single, joins where one repeats."""
    from panelith.plans import models as plans
    from panelith.sources import panel as P
    spark.createDataFrame([(i, i) for i in range(2)], "n_nationkey long, n_regionkey long").write.parquet(str(tmp_path / "nation.parquet"))
    spark.createDataFrame([(i, i % 2) for i in range(6)], "s_suppkey long, s_nationkey long").write.parquet(str(tmp_path / "supplier.parquet"))
    stamp = F.timestamp_add("day", F.col("id") % 700, F.lit(dt.datetime(1995, 1, 2)))
    spark.range(4200).select(
        (F.col("id") % 6).alias("l_suppkey"), (1.0 + F.col("id") % 7).alias("l_quantity"), (50.0 + F.col("id") % 31).alias("l_extendedprice"),
        F.when(F.col("id") % 501 != 0, stamp).alias("l_shipdate")).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(2000).select(
        F.element_at(F.array(*[F.lit(x) for x in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")]), (F.col("id") % 5 + 1).cast("int")).alias("o_orderpriority"),
        stamp.alias("o_orderdate"), (100.0 + F.col("id") % 13).alias("o_totalprice")).write.parquet(str(tmp_path / "orders.parquet"))

    def rows():
        frame = plans.meta_frame(spark, str(tmp_path))
        return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in frame.collect())

    assert P.single_entities(spark, str(tmp_path))
    single = rows()
    monkeypatch.setattr(P, "single_entities", lambda *_: False)
    assert single == rows() and len(single) > 100
