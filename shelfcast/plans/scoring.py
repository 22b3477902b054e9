"""Raw tables to one scored table."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast import config
from shelfcast.operators import (
    anomaly,
    bundles,
    evaluate,
    features,
    forecast,
    inventory,
    isolation,
    panel,
    reshape,
    score,
    split,
)
from shelfcast.sources import artifacts, tables


def ingest(
    spark: SparkSession,
    folder: str,
    sales_file: str = "sales_train_validation.csv",
    calendar_file: str = "calendar.csv",
    prices_file: str = "sell_prices.csv",
) -> DataFrame:
    """Fact table from the wide sales, calendar and price files."""
    base = folder.rstrip("/")
    wide = tables.read_wide_sales(spark, f"{base}/{sales_file}")
    calendar = tables.read_calendar(spark, f"{base}/{calendar_file}")
    prices = tables.read_prices(spark, f"{base}/{prices_file}")
    return panel.build_fact(reshape.unpivot_days(wide), calendar, prices)


def history_start(last: date, validation_days: int = config.VALIDATION_DAYS) -> date:
    """First day that features of the validation window can depend on."""
    return last - timedelta(days=validation_days - 1 + max(config.LAG_DAYS))


def baseline_predictions(
    fact: DataFrame,
    inventory_inputs: tuple[Column, Column] | DataFrame,
    last: date,
    validation_days: int = config.VALIDATION_DAYS,
) -> DataFrame:
    """Stand-in predictions, stock and stockout flag for the validation window.

    Everything runs on rows partitioned by series; after the panel there is no shuffle.
    """
    built = features.build_features(fact)
    _, validation = split.time_split(built, validation_days, last)
    rows = score.baseline_predictions(validation)
    if isinstance(inventory_inputs, DataFrame):
        rows = inventory.with_inventory(rows, inventory_inputs)
        on_hand = F.col("on_hand_inventory")
    else:
        on_hand = inventory.days_of_cover(F.col("roll_mean_28"), *inventory_inputs)
    rounded = F.round(on_hand.cast("decimal(18,6)"), 4).cast("double")
    return inventory.with_stockout_flag(rows.withColumn("on_hand_inventory", rounded))


def baseline_scored(predictions: DataFrame, anomaly_limit: float = 2.0) -> DataFrame:
    """Scored rows from stored predictions, which are read twice: once for the overall
    deviation of the residuals and once for the rows."""
    scaled = anomaly.anomaly_features(predictions)
    return anomaly.threshold_flags(scaled, anomaly_limit).withColumnRenamed("sales", "actual_sales")


def run_scoring(
    fact: DataFrame,
    inventory_inputs: DataFrame,
    out: str,
    run: str,
    logged_at: Column,
    rounds: int = 500,
    depth: int = 7,
    trees: int = config.FOREST_TREES,
) -> DataFrame:
    """The learned models end to end. Every hand-off is a stored table below ``out``.

    The feature table is stored because three models read it; the scored table is stored
    by date, as the replay reads it day by day.
    """
    spark = fact.sparkSession
    base = out.rstrip("/")
    tables.write_table(
        features.build_features(fact), f"{base}/features", sort_by=config.SERIES_DAY
    )
    built = tables.read_parquet(spark, f"{base}/features", "features")
    train, validation = split.time_split(built)

    point = forecast.fit_point_forecast(train, validation, rounds=rounds, depth=depth)
    tables.write_table(
        point.predict(validation).select(*config.SERIES_DAY, "sales", "forecast", "residual"),
        f"{base}/val_residuals",
    )
    residuals = tables.read_parquet(spark, f"{base}/val_residuals", "val_residuals")

    upper = forecast.fit_quantile_forecast(train, validation, rounds=rounds, depth=depth)
    fill = evaluate.median(validation, "roll_mean_28")
    risk_rows = inventory.with_stockout_flag(
        inventory.with_inventory(upper.predict(validation), inventory_inputs, fill)
    )
    tables.write_table(
        risk_rows.select(
            *config.SERIES_DAY, "sales", "p90_forecast", "on_hand_inventory", "stockout_risk_flag"
        ),
        f"{base}/val_risk",
    )
    risk = tables.read_parquet(spark, f"{base}/val_risk", "val_risk")

    tables.write_table(anomaly.anomaly_features(residuals), f"{base}/anomaly_features")
    scaled = tables.read_parquet(spark, f"{base}/anomaly_features", "anomaly_features")
    forest = isolation.fit_forest(scaled, trees=trees)
    tables.write_table(forest.transform(scaled), f"{base}/val_anomalies")
    anomalies = tables.read_parquet(spark, f"{base}/val_anomalies", "val_anomalies")

    tables.write_table(
        score.merge_outputs(residuals, risk, anomalies), f"{base}/forecasts", ["date"]
    )
    scored = tables.read_parquet(spark, f"{base}/forecasts", "forecasts")

    shared = {"validation_days": config.VALIDATION_DAYS}
    boosting = {**shared, "rounds": rounds, "depth": depth}
    fitted = {
        "demand_forecast": (point, boosting),
        "demand_risk_p90": (upper, {**boosting, "alpha": config.RISK_QUANTILE, "trees": len(upper.trees)}),
        "demand_anomaly": (forest, {**shared, "trees": trees, "contamination": config.CONTAMINATION}),
    }
    for name, (model, params) in fitted.items():
        bundles.save_model(spark, model, f"{base}/models/{name}", params)
    log = f"{base}/model_metrics"
    for model, metrics in (
        ("demand_forecast", evaluate.point_metrics(residuals, "sales")),
        ("demand_risk_p90", evaluate.risk_metrics(risk, actual="sales")),
        ("demand_anomaly", anomalies.agg(F.avg("anomaly_flag").alias("anomaly_rate"))),
    ):
        artifacts.log_run(artifacts.metric_rows(metrics, run, model, logged_at), log)
    for name, (_, params) in fitted.items():
        artifacts.log_run(artifacts.param_rows(spark, params, run, name, logged_at), log)
    return scored
