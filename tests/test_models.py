import time
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from shelfcast import config
from shelfcast.operators import anomaly, bundles, evaluate, features, forecast, inventory, isolation, split
from shelfcast.functions import metrics
from shelfcast.plans import scoring

from test_panel import series

START = date(2020, 1, 1)


def residual_rows(spark, values_by_item):
    rows = [
        (item, "s", START + timedelta(days=i), float(v))
        for item, values in values_by_item.items()
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "item_id string, store_id string, date date, residual double")


def test_pinball_and_percentiles(spark):
    pairs = spark.createDataFrame([(10.0, 7.0, 13.0)], "y double, low double, high double")
    got = pairs.agg(
        metrics.pinball(F.col("y"), F.col("low"), 0.9), metrics.pinball(F.col("y"), F.col("high"), 0.9)
    ).first()
    assert tuple(got) == pytest.approx((2.7, 0.3))
    demand = np.random.default_rng(0).negative_binomial(5, 0.5, 2000).astype(float)
    df = spark.createDataFrame([(float(v),) for v in demand], "x double")
    levels = {r["quantile"]: r for r in evaluate.calibration(df, "x").collect()}
    for q, row in levels.items():
        assert row["level"] == pytest.approx(np.percentile(demand, 100 * q))
        assert row["coverage"] == pytest.approx((demand <= row["level"]).mean())
    counts, _ = np.histogram(demand, bins=30)
    assert [r.n for r in evaluate.histogram(df, "x").orderBy("bin").collect()] == counts.tolist()


@pytest.mark.parametrize("kind", ["even", "ties", "tails", "two", "one"])
def test_order_statistics_in_rounds(spark, kind):
    """Small brackets and a rough summary, so that several rounds are needed."""
    rng = np.random.default_rng(7)
    values = {
        "even": rng.normal(size=3000), "ties": rng.integers(0, 4, 3000).astype(float),
        "tails": np.exp(rng.normal(0, 60, 3000)) * rng.choice([-1, 1], 3000),
        "two": np.repeat([1.0, 2.0], 1500), "one": np.full(3000, 5.0),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(4)
    ranks = [0, 1, 749, 1499, 1500, 2998, 2999]
    got = evaluate.order_statistics(df, "x", ranks, small=4, accuracy=50)
    assert got == np.sort(values)[ranks].tolist()
    assert evaluate.percentiles(df, "x", [0.1, 0.5, 0.99]) == pytest.approx(np.percentile(values, [10, 50, 99]))


def test_percentiles_of_nothing(spark):
    nothing = spark.createDataFrame([(None,)], "x double")
    assert evaluate.percentiles(nothing, "x", [0.5]) == [None]
    assert nothing.select(evaluate.median(nothing, "x")).first()[0] is None
    assert [r["coverage"] for r in evaluate.calibration(nothing, "x").collect()] == [None] * 3


def test_split_and_inventory(spark):
    days = series(spark, list(range(40)))
    train, validation = split.time_split(days)
    assert (train.count(), validation.count()) == (12, 28)
    rng = np.random.default_rng(42)
    inputs = spark.createDataFrame(
        [(float(c), float(f)) for c, f in zip(rng.uniform(5, 12, 1000), rng.normal(1, 0.15, 1000))],
        "c double, f double",
    )
    stock = inputs.select(inventory.days_of_cover(F.lit(5.0), F.col("c"), F.col("f")).alias("v"))
    low, mean = stock.agg(F.min("v"), F.avg("v")).first()
    assert low >= 0 and mean == pytest.approx(42.5, abs=1.5)


def test_dimension_checks(spark):
    good = spark.createDataFrame(
        [("a", 30.0, 5, True), ("b", 400.0, 13, False)],
        "item_id string, max_order_capacity double, lead_time_days int, constrained boolean",
    )
    assert inventory.supplier_violations(good).isEmpty()
    bad = good.unionByName(good.limit(1))
    with pytest.raises(ValueError, match="supplier"):
        inventory.require_valid(inventory.supplier_violations(bad), "supplier")


def test_volatility_scaling(spark):
    rng = np.random.default_rng(1)
    stable, spiky = rng.normal(0, 0.5, 60), rng.normal(0, 3.0, 60)
    stable[40] = spiky[40] = 8.0
    scaled = anomaly.anomaly_features(residual_rows(spark, {"stable": stable, "spiky": spiky})).cache()
    on_day = {
        r.item_id: r.normalized_residual
        for r in scaled.where(F.col("date") == START + timedelta(days=40)).collect()
    }
    assert on_day["stable"] > 3 > on_day["spiky"]
    expected = np.std(stable[27:41], ddof=1)
    got = scaled.where((F.col("item_id") == "stable") & (F.col("date") == START + timedelta(days=40)))
    assert got.first().resid_roll_std == pytest.approx(expected)


def test_trailing_deviation_needs_five_rows_and_is_never_zero(spark):
    rows = residual_rows(spark, {"a": [1.0] * 14, "b": [1.0, 5.0, 2.0, 9.0, 4.0]})
    overall = rows.agg(F.stddev("residual")).first()[0]
    scaled = anomaly.anomaly_features(rows).orderBy("item_id", "date").collect()
    assert all(r.resid_roll_std == pytest.approx(overall) for r in scaled[:14])
    assert scaled[17].resid_roll_std == pytest.approx(overall)
    assert scaled[18].resid_roll_std == pytest.approx(np.std([1, 5, 2, 9, 4], ddof=1))


def test_isolation_forest_finds_the_outlier(spark):
    rng = np.random.default_rng(5)
    values = rng.normal(0, 1, 1500)
    values[700] = 25.0
    scaled = anomaly.anomaly_features(residual_rows(spark, {"a": values})).cache()
    model = isolation.fit_forest(scaled, trees=50)
    assert model.nodes.groupby("tree").size().max() <= 2 * config.FOREST_SAMPLE
    scored = model.transform(scaled).cache()
    assert scored.orderBy("anomaly_score").first().residual == 25.0
    assert scored.agg(F.avg("anomaly_flag")).first()[0] == pytest.approx(0.03, abs=0.004)
    again = isolation.fit_forest(scaled.repartition(3), trees=50)
    assert again.offset == pytest.approx(model.offset, abs=1e-9)


def test_learners_and_scoring_run(spark, tmp_path):
    """Learned models end to end on a small panel, down to the stored scored table."""
    rows = None
    for n, item in enumerate(["a", "b", "c"]):
        level = 10 * (n + 1)
        values = [level + (i % 7) + (i * 31 % 5) for i in range(120)]
        part = series(spark, values, item)
        rows = part if rows is None else rows.unionByName(part)
    fact = rows.cache()
    keys = fact.select(*config.SERIES_DAY)
    inputs = keys.select("*", F.lit(3.0).alias("cover_days"), F.lit(0.1).alias("factor"))
    scored = scoring.run_scoring(
        fact, inputs, str(tmp_path), "run1", F.lit("2020-01-01").cast("timestamp"),
        rounds=5, depth=4, trees=20,
    )
    assert scored.count() == 3 * 28
    assert scored.where("forecast IS NULL OR p90_forecast IS NULL OR anomaly_flag IS NULL").isEmpty()
    log = spark.read.parquet(f"{tmp_path}/model_metrics")
    names = {r["name"] for r in log.select("name").distinct().collect()}
    assert {"rmse", "mae", "mape", "pinball_loss", "p90_coverage", "anomaly_rate", "rounds"} <= names
    settings = {(r["model"], r["name"]) for r in log.where("kind = 'param'").collect()}
    assert {("demand_forecast", "rounds"), ("demand_risk_p90", "alpha"), ("demand_anomaly", "contamination")} <= settings

    # All three models score alike after a reload in another session.
    built = features.build_features(fact)
    _, validation = split.time_split(built)
    other = spark.newSession()
    for name, out, given in (
        ("demand_forecast", "forecast", "val_residuals"), ("demand_risk_p90", "p90_forecast", "val_risk")
    ):
        model = bundles.load_model(other, f"{tmp_path}/models/{name}")
        again = {tuple(r[:3]): r[3] for r in model.predict(validation).select(*config.SERIES_DAY, out).collect()}
        stored = spark.read.parquet(f"{tmp_path}/{given}").select(*config.SERIES_DAY, out).collect()
        assert len(stored) == 84 and again == {tuple(r[:3]): pytest.approx(r[3], abs=1e-9) for r in stored}
    forest = bundles.load_model(other, f"{tmp_path}/models/demand_anomaly")
    assert bundles.model_params(other, f"{tmp_path}/models/demand_anomaly")["trees"] == 20
    stored = spark.read.parquet(f"{tmp_path}/val_anomalies")
    off = forest.transform(stored.withColumnRenamed("anomaly_score", "known")).where("abs(anomaly_score - known) > 1e-9")
    assert off.isEmpty()

    # One shared model: same inputs, other ids, other predictions.
    built = features.build_features(fact)
    train, validation = split.time_split(built)
    model = forecast.fit_point_forecast(train, rounds=5, depth=4, step=0.3, min_rows=5)
    same = validation.limit(1).drop("item_id")
    probe = same.withColumn("item_id", F.explode(F.array(F.lit("a"), F.lit("c"))))
    predicted = {r.item_id: r.forecast for r in model.predict(probe).collect()}
    assert predicted["a"] != predicted["c"]
    top = model.importances(3).collect()
    assert len(top) == 3 and top[0].gain >= top[1].gain

    upper = forecast.fit_quantile_forecast(train, rounds=10, depth=3, step=0.3, min_rows=5)
    cover = upper.predict(train).agg(F.avg((F.col("sales") <= F.col("p90_forecast")).cast("int")))
    assert 0.84 <= cover.first()[0] <= 0.97


def test_packed_trees_score_as_the_fitted_ones(spark):
    """Numbers, categories and unseen values; 500 trees in a few seconds."""
    rng = np.random.default_rng(3)
    rows = [(int(c), float(a), float(b), float(a * 3 + (c in (1, 4)) * 5 + rng.normal()))
            for c, a, b in zip(rng.integers(0, 6, 600), rng.normal(size=600), rng.normal(size=600))]
    frame = spark.createDataFrame(rows, "c int, a double, b double, y double")
    meta = {"ml_attr": {"type": "nominal", "vals": list("012345"), "name": "c"}}
    frame = frame.withColumn("c", F.col("c").cast("double").alias("c", metadata=meta))
    frame = VectorAssembler(inputCols=["c", "a", "b"], outputCol="features").transform(frame)
    fitted = DecisionTreeRegressor(labelCol="y", maxDepth=5, seed=1).fit(frame)
    assert " in {" in fitted.toDebugString
    packed = forecast.pack_tree(fitted, [0, 1, 2])
    x = np.stack([r["features"].toArray() for r in frame.select("features").collect()])
    want = [r["prediction"] for r in fitted.transform(frame).select("prediction").collect()]
    assert packed.value[packed.leaves(x)].tolist() == want
    began = time.time()
    total = sum(packed.value[packed.leaves(x[:50])] for _ in range(500))
    assert time.time() - began < 5 and total == pytest.approx(500 * np.array(want[:50]))


def test_boosting_stops_early_and_targets_do_not_leak(spark):
    """A target drawn at random gains nothing from the means of its own series."""
    rng = np.random.default_rng(9)
    keys = [(f"i{n % 400}", f"s{n % 7}") for n in range(2400)]
    rows = [(i, s, START + timedelta(days=d // 400), float(v))
            for d, ((i, s), v) in enumerate(zip(keys, rng.normal(size=2400)))]
    frame = spark.createDataFrame(rows, "item_id string, store_id string, date date, sales double")
    coded = forecast._out_of_fold(frame, "sales").select("sales", "item_id_mean").toPandas()
    assert len(coded) == 2400 and abs(np.corrcoef(coded["sales"], coded["item_id_mean"])[0, 1]) < 0.08
    within = frame.groupBy("item_id").agg(F.avg("sales").alias("m"))
    leaky = frame.join(within, "item_id").select("sales", "m").toPandas()
    assert np.corrcoef(leaky["sales"], leaky["m"])[0, 1] > 0.3

    noise = None
    for n, item in enumerate(["a", "b"]):
        part = series(spark, rng.integers(0, 30, 110).tolist(), item)
        noise = part if noise is None else noise.unionByName(part)
    train, validation = split.time_split(features.build_features(noise))
    model = forecast.fit_quantile_forecast(
        train, validation, rounds=30, depth=3, step=0.8, min_rows=5, patience=3)
    assert len(model.losses) < 30 and len(model.trees) == int(np.argmin(model.losses)) + 1


def test_forest_samples_at_every_size(spark):
    """One rule of drawing: full trees of different rows, whatever the number of rows."""
    trees, size = 20, 32
    for total in (32, 45, 100, 700, 4000):
        rows = spark.range(total).select(F.col("id").alias("k"))
        drawn = isolation.draw_samples(rows, ["k"], trees, size, total, 1)
        got = drawn.groupBy("tree").agg(
            F.count("*").alias("n"), F.count_distinct("k").alias("different")
        ).collect()
        assert sorted(r.tree for r in got) == list(range(trees))
        assert all(r.n == r.different for r in got)
        assert all(r.n == size for r in got) if total <= 100 else all(r.n > size // 2 for r in got)
