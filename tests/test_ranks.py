"""Ranks are one definition: the window of a bounded group and the ranges of an unbounded one agree."""

import math
import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from panelith.functions import ranks as R
from panelith.operators import evaluation as E
from panelith.operators import joins as J
from panelith.operators import windows as W
from panelith.session import cut_lineage, discard
from panelith.sources import files as FS
from panelith.streaming import stateful as ST

NAN = float("nan")
ROWS = [
    ("a", "x", 1.0), ("a", "y", 1.0), ("a", "z", None), ("a", "w", NAN), ("a", "v", -3.0), ("a", "u", None),
    ("b", "x", 2.0), ("b", "x", 2.0), ("b", "x", 2.0), ("b", "y", NAN), ("b", "z", NAN),
    (None, "x", 5.0), (None, "y", 4.0), (None, "z", None), ("c", "only", None), ("a", "t", math.inf), ("a", "s", -math.inf),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "dt string, entity string, v double")


def frame(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("descending", [False, True])
def test_positions_agree(rows, descending):
    bounded = R.order_number(rows, ["dt"], "v", "entity", descending=descending, group_bound=100)
    free = R.order_number(rows, ["dt"], "v", "entity", descending=descending)
    assert frame(bounded) == frame(free)
    counts = free.groupBy("dt").agg(F.count("*").alias("n"), F.count_distinct("rn").alias("d"), F.max("rn").alias("m"))
    assert all(r["n"] == r["d"] == r["m"] for r in counts.collect())


@pytest.mark.parametrize("digits", [None, 10])
def test_tie_ranks_agree(rows, digits):
    bounded = R.tie_rank(rows, ["dt"], "v", size="n", group_bound=100, digits=digits)
    free = R.tie_rank(rows, ["dt"], "v", size="n", digits=digits)
    assert frame(bounded) == frame(free.select(*bounded.columns))


def test_rank_normalize_agrees_and_keeps_rows(rows):
    bounded = W.rank_normalize(rows, ["v"], 100)
    free = W.rank_normalize(rows, ["v"])
    assert free.columns == rows.columns
    assert frame(bounded) == frame(free)


@pytest.mark.parametrize("limit", [R.WINDOW_GROUP_LIMIT, 40])
def test_unbounded_ranks_write_no_row_per_feature(spark, monkeypatch, limit):
    """Dates that fit a task and dates that go through ranges of the values, without the long form of all features."""
    draw = random.Random(4)
    value = lambda: draw.choice([None, NAN, 0.25, draw.random(), draw.random()])
    data = [(draw.choice(["a", "a", "a", "b", None]), str(i), value(), value(), draw.random()) for i in range(400)]
    rows = spark.createDataFrame(data, "dt string, entity string, f double, g double, h double")
    want = frame(W.rank_normalize(rows, ["f", "g", "h"], 1000))
    written, stage = [], W.cut_lineage

    def noted(df):
        out = stage(df)
        written.append(out.count())
        return out

    for module in (W, R):
        monkeypatch.setattr(module, "cut_lineage", noted)
        monkeypatch.setattr(module, "WINDOW_GROUP_LIMIT", limit, raising=False)
    assert frame(W.rank_normalize(rows, ["f", "g", "h"])) == want
    assert max(written) == 400


def test_staged_rows_leave_no_shuffle_files(spark):
    def files():
        held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {held.apply(i).getName() for i in range(held.size()) if held.apply(i).getName().startswith("shuffle_")}

    before = files()
    staged = cut_lineage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before and staged.count() == 7
    discard(staged.where("k > 2"))
    with pytest.raises(Exception, match="(?i)exist"):
        staged.count()


def test_upsert_with_text_keys(spark):
    old = spark.createDataFrame([("d", "AAPL", 0.1), ("d", "MSFT", 0.3)], "dt string, entity string, predicted_alpha double")
    new = spark.createDataFrame([("d", "AAPL", 0.5), ("d", "IBM", None)], old.schema)
    for bound in (10, None):
        got = {r["entity"]: r["combined_rank"] for r in J.upsert_predictions(old, new, group_bound=bound).collect()}
        assert got == {"AAPL": 1, "MSFT": 2, "IBM": 3}


def test_text_keys_in_files(spark, tmp_path):
    prices = spark.createDataFrame([("AAPL", "2024-01-02", 1.0)], "entity string, dt string, close double")
    prices = prices.withColumn("dt", F.to_date("dt"))
    got = FS.read_prices(spark, FS.write_panel(prices, str(tmp_path / "p"))).first()
    assert (got["entity"], got["close"], got["volume"]) == ("AAPL", 1.0, None)


def test_each_arrival_keeps_its_files(spark):
    parts = [spark.range(0, 100, 1, 3), spark.range(100, 150, 1, 3)]
    replay = ST.Replay(spark, parts, "several")
    first = list(Path(replay.path.removeprefix("file:")).glob("part-*"))
    assert len(first) == 3
    out = ST.drain(replay.stream, "several-out", replay)
    assert out.count() == 150
    assert len(list(Path(replay.path.removeprefix("file:")).glob("part-*"))) == 6


def test_promotion_reads_combinations_first(spark):
    combos = spark.createDataFrame([(1, 0.1), (2, None)], "fold_id int, ic double")
    walk = spark.createDataFrame([(1, 0.3), (2, 0.4)], "dt int, ic double")
    assert [tuple(r) for r in E.promotion_series(combos, walk).collect()] == [(0.1, "cpcv")]
    got = sorted(tuple(r) for r in E.promotion_series(combos.where("ic IS NULL"), walk).collect())
    assert got == [(0.3, "expanding_wf"), (0.4, "expanding_wf")]
