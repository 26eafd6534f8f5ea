"""Files, tables, stream, dashboards, models."""

import datetime as dt

import numpy as np
import pytest
from row_helpers import by
from pyspark.sql import functions as F

from wharfline.functions.durable import durable, scratch_path, shared_folder
from wharfline.operators import aggregates as agg
from wharfline.operators import boosting, costs, filters, linearfits, ml
from wharfline.plans import curation
from wharfline.sources import files, tables, views
from wharfline.streaming import file_cleaner


def test_durable_copy_is_in_the_shared_folder(spark):
    df = durable(spark.range(10))
    assert df.count() == 10 and spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(shared_folder(spark).rstrip("/"))


@pytest.mark.parametrize("extension", ["csv", "parquet", "json"])
def test_round_trips(spark, extension):
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, 2.5)], "id int, name string, x double")
    path = files.save_data(df, f"{scratch_path(spark, 'files')}.{extension}")
    back = files.load_data(spark, path, df.schema, records_array=False)
    assert by(back, "id") == by(df, "id")


def test_unknown_extension_and_discovery(spark):
    with pytest.raises(ValueError):
        files.load_data(spark, "data.xlsx")
    base = scratch_path(spark, "found")
    for name in ("one", "two"):
        spark.createDataFrame([(1, name)], "id int, n string").coalesce(1).write.option("header", True).csv(f"{base}/{name}")
    rows = files.discover(spark, f"{base}/*", "*.csv").collect()
    assert len(rows) == 2 and all(r["bytes"] > 0 for r in rows)
    assert files.read_folder(spark, f"{base}/*", "id int, n string").count() == 2
    assert files.to_json_records(spark.createDataFrame([(1,)], "a int")).first()["record"] == '{"a":1}'
    path = files.save_predictions(spark.createDataFrame([(1, 2.0)], "id int, prediction double"), f"{base}/p.json")
    assert spark.read.json(path).count() == 1


def test_zone_picks_up_new_partitions(spark):
    path = scratch_path(spark, "zone")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, part string")
    tables.write_zone(df, path, ["part"])
    assert tables.register_zone(spark, "test_zone", path, ["part"]).count() == 2
    df.where("part = 'a'").withColumn("part", F.lit("c")).write.mode("append").partitionBy("part").parquet(path)
    assert {r["part"] for r in tables.register_zone(spark, "test_zone", path, ["part"]).collect()} == {"a", "b", "c"}
    spark.sql("DROP TABLE test_zone")


def test_curation_partitions_by_month(spark):
    rows = [(1, "2023-01-31", "2023-02-02", 5.0, "N"), (2, "2023-02-01", None, None, "N"), (2, "2023-02-01", None, None, "N")]
    raw = spark.createDataFrame(rows, "order_id int, order_date string, delivery_date string, quantity double, region string")
    out = by(curation.run(raw, scratch_path(spark, "curated")), "order_id")
    assert [str(r["order_month"]) for r in out] == ["2023-01", "2023-02"] and out[0]["order_date_is_month_end"]
    assert out[1]["quantity"] == 5.0 and out[1]["lead_time"] == 1


def test_stream_handles_each_file_once(spark):
    base, schema = scratch_path(spark, "stream"), "id int, order_date string"
    clean = "id int, order_date timestamp"

    def drop(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").option("header", True).csv(f"{base}/raw")

    def run():
        file_cleaner.start_cleaner(spark, f"{base}/raw", f"{base}/out", f"{base}/state", schema).awaitTermination()
        return by(file_cleaner.processed_rows(spark, f"{base}/out", clean).select("id", "order_date"), "id")

    drop([(1, "2023-01-01"), (1, "2023-01-01"), (2, "bad")])
    first = run()
    assert [(r["id"], r["order_date"]) for r in first] == [(1, dt.datetime(2023, 1, 1)), (2, None)]
    drop([(1, "2023-01-01"), (3, "2023-01-03")])  # the same row in another file stays
    assert [r["id"] for r in run()] == [1, 1, 2, 3]
    assert [r["id"] for r in run()] == [1, 1, 2, 3]


WIDE = "date date, region string, product string, supplier string, lead_time double, fulfillment_rate double, stockout_probability double, total_cost double"
DAYS = [
    (dt.date(2023, 1, 1), "N", "A", "s1", 2.0, 1.0, 0.0, 10.0),
    (dt.date(2023, 1, 9), "S", "B", "s2", 4.0, 0.5, 0.2, 30.0),
    (dt.date(2023, 6, 1), "N", "C", "s1", 6.0, 0.6, 0.1, 50.0),
]


def test_filters(spark):
    df = spark.createDataFrame(DAYS, WIDE)
    assert filters.dashboard_filter(df).count() == 3
    assert filters.dashboard_filter(df, region="N", supplier="All", start="2023-01-01", end="2023-05-31").count() == 1
    assert filters.dashboard_filter(df, start="2023-01-01").count() == 3
    assert filters.last_days(df).count() == 1 and filters.latest_slice(df).first()["product"] == "C"
    assert {r["product"] for r in filters.first_products(df, 2).collect()} == {"A", "B"}
    assert [r["region"] for r in filters.options(df, "region").collect()] == ["N", "S"]


def test_cards_and_deltas(spark):
    df = spark.createDataFrame(DAYS, WIDE)
    card = agg.kpi_cards(df, F.avg("total_cost")).first()
    assert card["avg_lead_time"] == 4.0 and card["total_cost"] == 30.0
    delta = agg.kpi_deltas(df, F.col("region") == "N").first()
    assert delta["lead_time"] == 4.0 and delta["lead_time_delta"] == 0.0 and delta["total_cost_delta"] == -30.0
    quadrants = {r["supplier"]: r["quadrant"] for r in by(agg.group_quadrants(df, "supplier", "lead_time", "fulfillment_rate"))}
    assert quadrants == {"s1": "high / fast", "s2": "low / fast"}


def test_business_kpis_of_nothing(spark):
    orders = spark.createDataFrame([], "quantity double, price_per_unit double, ship_date timestamp, due_date timestamp, status string, order_date timestamp")
    stock = spark.createDataFrame([], "date timestamp, quantity double")
    moved = spark.createDataFrame([], "ship_date timestamp, delivery_date timestamp")
    row = agg.business_kpis(orders, stock, moved).first()
    assert set(row.asDict().values()) == {0, 0.0}


def test_status_and_pivot(spark):
    df = spark.createDataFrame([("2023-01-02", "2023-01-01"), (None, "2023-01-01"), (None, "2023-03-01")], "ship string, ordered string")
    rows = df.select(costs.order_status("ship", "ordered", F.lit("2023-02-01")).alias("s")).collect()
    assert [r["s"] for r in rows] == ["Delivered", "In Transit", "Pending"]
    sales = spark.createDataFrame([("A", "N", 1.0), ("A", "N", 2.0), ("B", "S", 4.0)], "p string, r string, q double")
    assert by(agg.pivot_sum(sales, "p", "r", "q", ["N", "S"]), "p") == [{"p": "A", "N": 3.0, "S": 0.0}, {"p": "B", "N": 0.0, "S": 4.0}]


@pytest.fixture(scope="module")
def samples(spark):
    rng = np.random.default_rng(4)
    x, kind = rng.normal(0, 1, 600), rng.choice(["a", "b", "c"], 600)
    y = 3 * x + np.where(kind == "b", 5.0, 0.0) + rng.normal(0, 0.1, 600)
    rows = [(i, float(x[i]), str(kind[i]), float(y[i])) for i in range(600)]
    return spark.createDataFrame(rows, "order_id int, x double, kind string, lead_time double")


def test_split_and_linear_model(samples):
    train, test = ml.hash_split(samples, ["order_id"])
    assert train.count() + test.count() == 600 and 80 < test.count() < 160
    pipeline, train, test = ml.prepare_features(samples)
    model, cv = ml.train_linear_model(train, "lead_time")
    row = ml.regression_metrics(ml.predict(model, test), "lead_time").first()
    assert row["rmse"] < 0.15 and row["r2"] > 0.99 and 0.08 < cv < 0.15
    path = ml.save_model(pipeline, scratch_path(samples.sparkSession, "features"))
    again = ml.load_model(path).transform(samples).first()["features"]
    assert again == pipeline.transform(samples).first()["features"]


def plain_rows(df):
    frame = df.select("features", "lead_time").toPandas()
    return np.stack([v.toArray() for v in frame["features"]]), frame["lead_time"].to_numpy()


def test_ridge_and_lasso_match_plain_solutions(samples):
    _, train, _ = ml.prepare_features(samples, drop_last=False)
    x, y = plain_rows(train)
    xc, yc = x - x.mean(0), y - y.mean()
    products = linearfits.fold_products(train, "lead_time", F.lit(0))[0]
    ridge = linearfits.solved(products, ridge=ml.RIDGE_ALPHA)
    np.testing.assert_allclose(ridge.coefficients, np.linalg.solve(xc.T @ xc + ml.RIDGE_ALPHA * np.eye(x.shape[1]), xc.T @ yc), rtol=1e-6)
    lasso = linearfits.solved(products, lasso=0.5)
    pull = xc.T @ (yc - xc @ lasso.coefficients) / len(y)  # at the solution: +-penalty where a coefficient is, less where it is not
    assert np.abs(pull).max() <= 0.5 + 1e-6 and (lasso.coefficients == 0).any()
    np.testing.assert_allclose(pull[lasso.coefficients != 0], 0.5 * np.sign(lasso.coefficients[lasso.coefficients != 0]), atol=1e-6)
    fitted = ridge.transform(train).select("prediction").toPandas()["prediction"].to_numpy()
    assert np.isclose(linearfits.mean_squared_error(ridge, products), ((y - fitted) ** 2).mean())


def test_folds_from_products_equal_refits(samples):
    _, train, _ = ml.prepare_features(samples)
    _, cv = ml.train_linear_model(train, "lead_time", folds=4)
    errors = []
    parts = [plain_rows(train.where(ml.hash_bucket(["order_id"], 4) == f)) for f in range(4)]
    for f in range(4):
        x, y = (np.concatenate([p[k] for g, p in enumerate(parts) if g != f]) for k in range(2))
        beta = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)[0]
        errors.append(np.sqrt(((parts[f][1] - beta[0] - parts[f][0] @ beta[1:]) ** 2).mean()))
    assert cv == pytest.approx(np.mean(errors), rel=1e-9)


def test_prefixes_of_an_ensemble_are_ensembles():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = np.where(x[:, 0] > 0, 3.0, -1.0) * (x[:, 1] > 0.3) + rng.normal(0, 0.1, 400)
    bins, test = boosting.binned(x), np.arange(400) % 5 == 0
    long = boosting.staged_errors(bins, y, test, [5, 20, 60], step=0.2, depth=3, share=0.8)
    assert [boosting.staged_errors(bins, y, test, [n], step=0.2, depth=3, share=0.8)[0] for n in (5, 20, 60)] == long
    assert long[-1] < 0.1 * y[test].var() and long[0] > long[-1]
    # One tree of one level is the best single cut.
    stump = boosting.staged_errors(bins, y, test, [1], step=1.0, depth=1)[0]
    train = ~test
    cuts = [(j, b) for j in range(3) for b in range(bins.max()) if 0 < (bins[train, j] <= b).sum() < train.sum()]

    def after(j, b, rows):
        left = bins[:, j] <= b
        means = np.where(left, y[train & left].mean(), y[train & ~left].mean())
        return ((y - means)[rows] ** 2).mean()

    assert stump == pytest.approx(after(*min(cuts, key=lambda c: after(*c, train)), test))


def test_leaves_keep_their_least_rows():
    bins, y = np.arange(12)[:, None], np.array([9.0] + [0.0] * 11)
    test = np.zeros(12, bool)
    test[0] = True
    assert boosting.staged_errors(np.minimum(bins, 5), y, test, [1], step=1.0, depth=4, least=6) == [81.0]


def test_forest_importances_and_intervals(samples):
    _, train, test = ml.prepare_features(samples)
    trained = ml.train_regression_models(train, test, "lead_time", names=["random_forest", "linear_regression"], folds=2, size=8)
    assert {r["model"] for r in trained.scores.collect()} == {"random_forest", "linear_regression"}
    assert all(r["cv_rmse"] > 0 for r in trained.scores.collect())
    shares = {r["feature"]: r["importance"] for r in trained.importances.collect()}
    assert sum(shares.values()) == pytest.approx(1.0)
    # The label is made of x and of kind b alone.
    assert {r["feature"] for r in ml.top_importances(trained.importances, 2).collect()} == {"x", "kind_onehot_b"}
    rows = by(ml.predict_with_uncertainty(trained.models["random_forest"], test))
    assert all(r["lower_ci"] <= r["upper_ci"] for r in rows)
    inside = sum(r["lower_ci"] <= r["prediction"] <= r["upper_ci"] for r in rows)
    assert inside > 0.9 * len(rows)
    plain = ml.predict_with_uncertainty(trained.models["linear_regression"], test)
    assert "prediction" in plain.columns and "lower_ci" not in plain.columns


def test_walked_trees_equal_the_models_own(samples):
    _, train, test = ml.prepare_features(samples, drop_last=False)
    for name in ("random_forest", "gradient_boosting"):
        model = ml.tree_regressors("lead_time", size=5)[name].fit(train)
        each = ml.predict(model, test)
        for i, tree in enumerate(model.trees):
            each = tree.copy().setPredictionCol(f"_tree{i}").transform(each)
        rows = each.select(F.array(*[f"_tree{i}" for i in range(5)]).alias("own"), ml.tree_predictions(model).alias("walked")).collect()
        assert rows and all(r["own"] == r["walked"] for r in rows)


def test_rows_are_built_once_for_all_fits(samples):
    """What lies behind the rows is run when they are stored, not by every fit and prediction."""
    runs = samples.sparkSession.sparkContext.accumulator(0)

    @F.udf("double")
    def costly(x):
        runs.add(1)
        return x

    made = samples.withColumn("x", costly("x"))
    _, train, test = ml.prepare_features(made)
    ml.train_linear_model(train, "lead_time")
    assert train.count() + test.count() == 600 and runs.value == 600


def test_trees_are_walked_by_batches(samples):
    """Bounds come from vectors of rows, not from expressions that step through every tree row by row."""
    _, train, test = ml.prepare_features(samples)
    model = ml.tree_regressors("lead_time", size=4)["random_forest"].fit(train)
    x, _ = plain_rows(test)
    trees = ml.tree_walker(model)(x)
    assert trees.shape == (len(x), 4)
    np.testing.assert_allclose(trees.mean(axis=1), [r["prediction"] for r in ml.predict(model, test).collect()])
    odd = np.array([[np.nan, 2.0, -1.0], [0.0, 0.5, 0.0]])[:, : x.shape[1]]  # no level of a named split: to the right
    assert np.isfinite(ml.tree_walker(model)(odd)).all()
    plan = ml.predict_with_uncertainty(model, test)._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan and "Generate" not in plan


def test_cleaned_files_are_compressed(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), tmp_path / "out"
    spark.createDataFrame([(1, "2023-01-01"), (1, "2023-01-01")], "id int, order_date string").coalesce(1).write.option("header", True).csv(raw)
    file_cleaner.start_cleaner(spark, raw, str(out), str(tmp_path / "state"), "id int, order_date string").awaitTermination()
    parts = list(out.rglob("part-*"))
    assert parts and all(p.name.endswith(".csv.gz") for p in parts)
    assert file_cleaner.processed_rows(spark, str(out), "id int, order_date timestamp, source_file string").first()["source_file"].startswith("file:")


def test_returned_lines_are_sent_twice_by_one_pass(spark, monkeypatch):
    runs = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def joined(x):
        runs.add(1)
        return x

    day = dt.datetime(2023, 1, 1)
    rows = [(i, i, 1, day, day, 1.0, 2.0, "EUROPE", flag) for i, flag in enumerate(["R", "N", None, "R"])]
    facts = spark.createDataFrame(
        rows, "order_id int, line_number int, product_id int, order_date timestamp, delivery_date timestamp, quantity double, "
        "line_value double, region string, return_flag string"
    ).withColumn("return_flag", joined("return_flag"))
    monkeypatch.setattr(views, "order_facts", lambda *_: facts)
    raw = views.raw_orders(spark, "")
    assert sorted(r["order_id"] for r in raw.collect()) == [0, 0, 1, 2, 3, 3]
    assert runs.value == 4 and "_copy" not in raw.columns


def test_boosting_grid(samples):
    _, train, _ = ml.prepare_features(samples)
    grid = {"maxIter": [2, 8], "maxDepth": [1, 3]}
    best, scores = ml.train_boosted_model(train, "lead_time", grid=grid, folds=2)
    rows = scores.collect()
    assert len(rows) == 4 and best.getMaxDepth() == 3 and best.getNumTrees == 8
    assert [r["mse"] for r in rows] == sorted(r["mse"] for r in rows)
    assert len(ml.BOOSTING_GRID) == 5 and all(len(v) == 3 for v in ml.BOOSTING_GRID.values())
    assert boosting.search_rows(train, "lead_time", ["order_id"], F.lit(0), 50)[0].shape[0] == 50


def plain_errors(df, folds, points, size):
    x, y = plain_rows(df)
    fold = df.select(ml.hash_bucket(["order_id"], folds).alias("f")).toPandas()["f"].to_numpy()
    return [np.mean([boosting.staged_errors(boosting.binned(x), y, fold == g, [size], **p)[0] for g in range(folds)]) for p in points]


@pytest.mark.parametrize("held", [boosting.HELD, 100])
def test_summed_rows_give_the_errors_of_all_rows(samples, monkeypatch, held):
    """Rows with the same bins are added up: no row is left out and no tree changes, in memory or in files."""
    monkeypatch.setattr(boosting, "HELD", held)
    monkeypatch.setattr(boosting, "AT_ONCE", 64)
    rounded = samples.unionAll(samples.withColumn("lead_time", F.col("lead_time") + F.col("order_id") % 7))
    _, train, _ = ml.prepare_features(rounded, drop_last=False, unknown="keep")
    points = [{"depth": 3, "step": 0.3}, {"depth": 2, "step": 0.1, "least": 9}]
    found = boosting.point_errors(train, "lead_time", ["order_id"], ml.hash_bucket(["order_id"], 3), 3, points, [4], rows=None)
    mse = {r["point"]: r["mse"] for r in found.collect()}
    assert [mse[0], mse[1]] == pytest.approx(plain_errors(train, 3, points, 4), rel=1e-9)
    x, _ = plain_rows(train)
    cuts = boosting.quantile_cuts(train.select(boosting.vector_to_array("features").alias("x")))
    assert np.array_equal(np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1), boosting.binned(x))
    with pytest.raises(ValueError):
        boosting.point_errors(train, "lead_time", ["order_id"], F.lit(0), 1, [{"share": 0.5}], [1], rows=None)


def test_compared_models_are_validated_on_all_rows(spark, monkeypatch):
    """More rows than the 20,000 that boosted models were once validated on; the hash decides nothing."""
    n = 24_000
    rows = spark.range(n).select(F.col("id").alias("order_id"), (F.col("id") % 50).cast("double").alias("x"))
    order = F.md5(F.col("order_id").cast("string"))
    last = rows.withColumn("_o", order).orderBy(F.desc("_o")).limit(2_000).select("order_id", F.lit(1000.0).alias("far"))
    made = rows.join(last, "order_id", "left").select("order_id", "x", (F.coalesce("far", F.lit(0.0)) + F.col("x")).alias("lead_time"))
    _, train, test = ml.prepare_features(made)
    trained = ml.train_regression_models(train, test, "lead_time", names=["gradient_boosting"], folds=2, size=2)
    row = trained.scores.first()
    both = train.unionByName(test)
    settings = [dict(ml.BOOSTED["gradient_boosting"])]
    assert row["cv_rmse"] == pytest.approx(plain_errors(both, 2, settings, 2)[0] ** 0.5, rel=1e-9)
    assert row["cv_rmse"] > 200


def test_registered_models_are_whole(samples, monkeypatch):
    """Five folds, whole ensembles and the whole grid reach the fits."""
    from wharfline.plans import ml_queries

    tree_regressors, point_errors, sizes, searched = ml.tree_regressors, boosting.point_errors, [], []

    def small_trees(target, seed=42, size=ml.ENSEMBLE_SIZE, depth=5):
        sizes.append(size)
        return tree_regressors(target, seed, 3, 2)

    def counted(df, target, keys, fold, folds, points, sizes, seed=42, rows=boosting.SEARCH_ROWS):
        searched.append((folds, len(points), list(sizes)))
        return point_errors(df, target, keys, fold, 2, points, [1] * (len(sizes) == 1) or [1, 2, 3], seed, 100).replace(
            {1: sizes[0], 2: sizes[-2] if len(sizes) > 1 else 0, 3: sizes[-1]}, subset=["size"]
        )

    keyed = samples.withColumns({k: samples["order_id"] for k in ml_queries.KEYS if k != "order_id"})
    monkeypatch.setattr(ml_queries, "features", lambda *_: keyed)
    monkeypatch.setattr(ml, "tree_regressors", small_trees)
    monkeypatch.setattr(boosting, "point_errors", counted)
    spark = samples.sparkSession
    rows = ml_queries.compared_lead_time_models(spark, "").collect()
    assert {r["model"] for r in rows} == set(ml.MODELS) and all(r["cv_rmse"] > 0 for r in rows)
    ml_queries.lead_time_feature_importances(spark, "")
    ml_queries.lead_time_intervals(spark, "")
    assert sizes == [ml.ENSEMBLE_SIZE] * 3
    grid = ml_queries.boosted_grid_scores(spark, "").collect()
    assert len(grid) == 243 and all(r["mse"] > 0 for r in grid)
    assert searched == [(5, 2, [ml.ENSEMBLE_SIZE]), (5, 81, [100, 200, 300])]


def test_copies_of_a_scope_are_removed(spark, tmp_path):
    from pathlib import Path

    from wharfline.functions.durable import scope, stored
    from wharfline.plans import registered

    shared = Path(shared_folder(spark).removeprefix("file:"))

    def files_in(folder):
        return sorted(str(p) for p in folder.rglob("*") if p.is_file())

    before = files_in(shared)
    for name in ("clean_orders", "saved_predictions", "customer_order_components", "registered_zone", "lead_time_scores"):
        with scope(spark) as place:
            assert registered.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
            assert files_in(Path(place.removeprefix("file:")))
        assert files_in(shared) == before, name
    with pytest.raises(RuntimeError), scope(spark):
        stored(durable(spark.range(10)))
        raise RuntimeError
    assert files_in(shared) == before
    with scope(spark) as outer:
        kept = stored(spark.range(10))
        with scope(spark):
            stored(spark.range(3))
        assert kept.count() == 10 and scratch_path(spark, "x").startswith(outer)
    durable(spark.range(5))
    assert len(files_in(shared)) > len(before)


def test_a_table_takes_up_what_its_folder_gains_and_loses(spark, tmp_path):
    import shutil

    path, name = str(tmp_path / "zone"), "wharfline_test_zone"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = [(1, "a b"), (2, "it's"), (3, None)]
    spark.createDataFrame(rows, "x int, part string").write.partitionBy("part").parquet(path)
    assert tables.register_zone(spark, name, path, ["part"]).count() == 3
    spark.createDataFrame([(4, 0.5, "new/part")], "x int, y double, part string").write.mode("append").partitionBy("part").parquet(path)
    shutil.rmtree(f"{path}/part=a b")
    grown = tables.register_zone(spark, name, path, ["part"], merge_schemas=True)
    assert by(grown.select("x", "y", "part"), "x") == [
        {"x": 2, "y": None, "part": "it's"}, {"x": 3, "y": None, "part": None}, {"x": 4, "y": 0.5, "part": "new/part"}
    ]
    spark.createDataFrame([("text", "z")], "x string, part string").write.partitionBy("part").parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="type"):
        tables.register_zone(spark, name, str(tmp_path / "other"), ["part"])
    spark.sql(f"DROP TABLE {name}")
