"""Split, scaling, models and monitoring."""

import numpy as np
import pytest
from fixtures import block_layout, examples, frame, plain_layout, rows_of
from pyspark.sql import functions as F

from tidemark.operators import features as feat
from tidemark.operators import models, monitoring
from tidemark.operators.series import LAGS, lag_names


@pytest.fixture(scope="module")
def data(spark):
    df = frame(spark, examples()).cache()
    return df, plain_layout(df)


@pytest.fixture(scope="module")
def table(data):
    return feat.build_features(*data).cache()


def test_split_is_chronological_and_complete(data, table):
    counted = {r["coin_id"]: r for r in models.series_status(table).collect()}
    for (coin, _currency), prices in examples().items():
        usable = [i for i in range(12, len(prices)) if all(prices[i - k] is not None for k in LAGS)]
        assert counted[coin]["train_rows"] == int(len(usable) * 0.8)
        assert counted[coin]["test_rows"] == len(usable) - int(len(usable) * 0.8)
    checked = monitoring.split_order(table).collect()
    assert all(r["valid_chronological_split"] for r in checked)


def test_train_and_test_together_are_the_lagged_rows(data, table):
    both = feat.train_rows(table).unionByName(feat.test_rows(table)).select(*lag_names("price"), "price")
    assert rows_of(both) == rows_of(feat.lag_features(*data).select(*lag_names("price"), "price"))


def test_scaled_training_rows_have_mean_0_and_deviation_1(table):
    for name in lag_names("price"):
        scaled = f"{name}_scaled"
        for row in feat.train_rows(table).groupBy("coin_id").agg(
                F.avg(scaled).alias("m"), F.stddev_samp(scaled).alias("s")).collect():
            assert row["m"] == pytest.approx(0, abs=1e-9) and row["s"] == pytest.approx(1, abs=1e-9)


def test_statistics_do_not_see_test_rows(spark, data, table):
    df, layout = data
    last = df.groupBy("coin_id").agg(F.max("event_id").alias("last"))
    # Prices of the last rows are read by test rows only.
    changed = df.join(last, "coin_id").withColumn(
        "price", F.when(F.col("event_id") >= F.col("last") - 2, 1e6).otherwise(F.col("price"))).drop("last")
    stats = [
        rows_of(feat.scaling_stats(feat.train_rows(feat.split_features(d, layout)), lag_names("price")))
        for d in (df, changed)]
    assert stats[0] == stats[1]


def test_series_of_edge_lengths(spark):
    df = frame(spark, {("one", "usd"): [1.0], ("twelve", "usd"): range(12), ("thirteen", "usd"): range(13),
                       ("flat", "usd"): [5.0] * 40})
    layout = plain_layout(df)
    table = feat.build_features(df, layout)
    status = {r["coin_id"]: (r["train_rows"], r["test_rows"], r["status"]) for r in models.series_status(table).collect()}
    assert status == {"thirteen": (0, 1, "no_train"), "flat": (22, 6, "ok")}
    alone = table.filter("coin_id = 'thirteen'").first()
    assert [alone[f"{n}_scaled"] for n in lag_names("price")] == [0.0] * 5
    with pytest.raises(ValueError, match="no_train"):
        models.require_complete(models.series_status(table))

    fitted, predictions = models.score_all(table, layout)
    flat = fitted.filter("coin_id = 'flat'").first()
    assert flat["intercept"] == 5.0 and list(flat["coefficients"]) == [0.0] * 5
    assert predictions.filter("coin_id = 'thirteen' AND prediction IS NOT NULL").isEmpty()
    performance = {r["coin_id"]: r for r in models.model_performance(predictions).collect()}
    assert performance["flat"]["rmse"] == 0 and performance["flat"]["r2"] is None
    assert performance["thirteen"]["rmse"] is None and performance["thirteen"]["test_rows"] == 1


def test_grouped_fit_equals_the_estimator(data, table):
    """The Spark ML estimator, fitted to each series by itself, is the check of the grouped fit."""
    from pyspark.ml.regression import LinearRegression

    _df, layout = data
    _fitted, predictions = models.score_all(table, layout)
    grouped = models.forecasts(predictions, layout).cache()
    for coin in ("noise", "ar", "walk"):
        one = feat.assemble(table.filter(F.col("coin_id") == coin), models.scaled_names())
        estimated = LinearRegression(labelCol="price", maxIter=100).fit(feat.train_rows(one)).transform(one)
        keys = ["coin_id", "timestamp", "prediction"]
        assert rows_of(grouped.filter(F.col("coin_id") == coin).select(*keys), 6) == rows_of(estimated.select(*keys), 6)


def test_single_model_is_its_part_of_the_grouped_fit(data, table, tmp_path):
    _df, layout = data
    _fitted, predictions = models.score_all(table, layout)
    grouped = models.forecasts(predictions, layout).cache()
    performance = {r["coin_id"]: r for r in models.model_performance(grouped).collect()}
    path = str(tmp_path / "model")
    for coin in ("noise", "ar"):
        fitted, single, metrics = models.single_model(
            table, layout, {"coin_id": coin, "vs_currency": "usd"}, path=path)
        assert rows_of(grouped.filter(F.col("coin_id") == coin), 6) == rows_of(single, 6)
        row = metrics.first()
        for name in ("rmse", "mae", "r2"):
            assert performance[coin][name] == pytest.approx(row[name], rel=1e-6, abs=1e-9)
        assert rows_of(table.sparkSession.read.parquet(path), 6) == rows_of(fitted, 6)
    with pytest.raises(ValueError, match="no rows"):
        models.single_model(table, layout, {"coin_id": "absent"})


def test_nearly_collinear_and_repeated_features(spark):
    rng = np.random.default_rng(3)
    walk = np.cumsum(rng.normal(size=3000)) * 0.01 + 1e5
    df = frame(spark, {("walk", "usd"): walk})
    layout = plain_layout(df)
    table = feat.build_features(df, layout).withColumn("copy", F.col("price_lag_1_scaled")).cache()
    names = [*models.scaled_names(), "copy"]
    train = feat.train_rows(table)
    predicted = models.predict(train, models.fit_models(train, names), names, layout).toPandas()
    x = np.column_stack([np.ones(len(predicted)), predicted[names].to_numpy()])
    y = predicted["price"].to_numpy()
    expected = x @ np.linalg.lstsq(x, y, rcond=None)[0]
    assert np.abs(predicted["prediction"].to_numpy() - expected).max() < 1e-6


def test_limits_come_from_training_residuals(data, table):
    _df, layout = data
    _fitted, predictions = models.score_all(table, layout)
    both = models.forecasts(predictions, layout)
    moved = models.forecasts(predictions.withColumn(
        "residual", F.when(F.col("dataset_type") == "test", 1e9).otherwise(F.col("residual"))), layout)
    limits = [rows_of(d.select("coin_id", *monitoring.LIMIT_COLUMNS).distinct(), 6) for d in (both, moved)]
    assert limits[0] == limits[1]
    row = both.first()
    assert row["ucl"] - row["lcl"] == pytest.approx(6 * row["residual_std"])


def test_vector_holds_the_scaled_columns(data):
    from pyspark.ml.functions import vector_to_array

    table = feat.build_features(*data, vector=True)
    row = feat.select_final(table).withColumn("v", vector_to_array("features")).first()
    assert list(row["v"]) == [row[n] for n in models.scaled_names()]


def test_long_series_route_gives_the_same_forecasts(data):
    df, layout = data
    blocks = block_layout(df)

    def made(lay):
        _fitted, predictions = models.score_all(feat.build_features(df, lay), lay)
        return rows_of(models.forecasts(predictions, lay), 6)

    assert made(blocks) == made(layout)
