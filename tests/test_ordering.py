"""The splitting methods against the plain ones, with one key holding most rows."""

import numpy as np
import pandas as pd
import pytest
from row_helpers import by
from pyspark.sql import Window
from pyspark.sql import functions as F

from wharfline.functions.ordering import look_back, row_positions, running_totals
from wharfline.functions.quantiles import banded_quantiles, exact_quantiles
from wharfline.operators.series import lag_features, moving_average


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(1)
    n = 3000
    keys = np.where(rng.random(n) < 0.7, "hot", rng.choice(["a", "b", "c"], n))
    frame = pd.DataFrame(
        {"id": np.arange(n), "key": keys, "day": rng.integers(0, 40, n), "value": np.round(rng.lognormal(3, 1, n), 3)}
    )
    frame.loc[rng.random(n) < 0.3, "value"] = 7.0
    frame.loc[::97, "key"] = None
    return spark.createDataFrame(frame.astype({"day": int}), "id long, key string, day long, value double"), frame


def test_running_totals_equal_one_window(skewed):
    df, _ = skewed
    order = [F.desc("value"), F.asc("id")]
    whole = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    plain = by(df.withColumn("t", F.sum("value").over(whole)).select("id", "t"), "id")
    split = by(running_totals(df, order, "value", "t", "share").select("id", "t", "share"), "id")
    np.testing.assert_allclose([r["t"] for r in split], [r["t"] for r in plain], rtol=1e-9)
    assert max(r["share"] for r in split) == pytest.approx(1.0)


def test_positions_equal_row_numbers(skewed):
    df, _ = skewed
    window = Window.partitionBy("key").orderBy("day", "id")
    plain = by(df.withColumn("p", F.row_number().over(window)).select("id", "p"), "id")
    split = by(row_positions(df, ["key"], [F.col("day"), F.col("id")], "p").select("id", "p"), "id")
    assert split == plain


@pytest.mark.parametrize("keys", [["key"], []])
@pytest.mark.parametrize("chunk", [50, 700])
def test_chunked_lags_equal_one_window(skewed, keys, chunk):
    df, _ = skewed
    settings = dict(lags=(1, 3), windows=(7, 14), ties=["id"])
    plain = by(lag_features(df, "day", "value", keys, method="window", **settings), "id")
    split = by(lag_features(df, "day", "value", keys, method="chunked", chunk_rows=chunk, **settings), "id")
    assert len(plain) == len(split) and set(plain[0]) == set(split[0])
    for a, b in zip(plain, split):
        assert {k: a[k] for k in ("id", "value_lag_1", "value_lag_3")} == {k: b[k] for k in ("id", "value_lag_1", "value_lag_3")}
        for c in ("value_rolling_mean_14", "value_rolling_std_7"):
            assert (a[c] is None) == (b[c] is None)
            assert a[c] is None or a[c] == pytest.approx(b[c], abs=1e-6)


def test_auto_splits_only_large_groups(skewed):
    df, _ = skewed
    small = look_back(df, ["key"], [F.col("day"), F.col("id")], 1, lambda w: {"l": F.lag("id").over(w)}, chunk_rows=10_000)
    large = look_back(df, ["key"], [F.col("day"), F.col("id")], 1, lambda w: {"l": F.lag("id").over(w)}, chunk_rows=100)
    assert by(small.select("id", "l"), "id") == by(large.select("id", "l"), "id")
    with pytest.raises(ValueError):
        look_back(df, [], [F.col("id")], 1, lambda w: {}, method="other")


def test_default_lags_have_no_rolling_columns(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(40)], "d int, y double")
    out = lag_features(df, "d", "y", method="window")
    assert [c for c in out.columns if "rolling" in c] == []
    assert by(out, "d")[35]["y_lag_30"] == 5.0


def test_moving_average_needs_a_full_window(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (4, 4.0), (5, 5.0)], "d int, y double")
    rows = by(moving_average(df, "d", "y", rows=3, method="window"), "d")
    assert [r["y_ma_3"] for r in rows] == [None, None, None, None, 4.0]


@pytest.mark.parametrize("keys", [["key"], []])
def test_banded_quantiles_are_exact(skewed, keys):
    df, frame = skewed
    wanted = {"q1": ("value", 0.25), "median": ("value", 0.5), "top": ("value", 0.99), "day": ("day", 0.5)}
    banded = by(banded_quantiles(df, keys, wanted, bands=16), *keys)
    built_in = by(exact_quantiles(df, keys, wanted, "built_in"), *keys)
    assert len(banded) == len(built_in) == (4 if keys else 1)
    for a, b in zip(banded, built_in):
        for name in wanted:
            assert a[name] == pytest.approx(b[name], rel=1e-12)
    if not keys:
        assert banded[0]["median"] == pytest.approx(frame["value"].median())
