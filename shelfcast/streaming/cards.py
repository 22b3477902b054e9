"""Card state kept up to date over a stream of scored days, and the day-by-day replay."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfcast import config
from shelfcast.operators import cards, decisions
from shelfcast.streaming.sinks import current_rows, update_table


def cumulative_state(
    scored: DataFrame,
    path: str,
    checkpoint: str,
    name: str = "cumulative_cards",
    compact_every: int = 16,
) -> StreamingQuery:
    """Latest state and persistence per series over everything seen so far.

    The state is one row per flagged series and needs no watermark; the order in which
    days arrive does not matter. Every ``compact_every`` micro-batches the stored changes become
    a new snapshot.
    """
    return update_table(cards.latest_state(scored), path, checkpoint, name, config.SERIES, compact_every)


def cumulative_cards(spark: SparkSession, path: str) -> DataFrame:
    return cards.render_cards(current_rows(spark, path, config.SERIES))


REPLAY_TABLES = ("cards", "routed", "reorders")


def replay_stream(
    scored: DataFrame,
    first: date,
    path: str,
    checkpoint: str,
    batch_days: int = 1,
    name: str = "replay_cards",
) -> StreamingQuery:
    """Replay of scored days with the rules inside: cards, routing and reorders per batch.

    A batch is ``batch_days`` consecutive days from the first day, wherever they come in the
    stream. Spark keeps no state: a micro-batch stores the state of its own rows per series and
    batch, reads back the stored parts of the batches it touched, and writes their cards, the
    topics these go to and the reorders that follow. A day counts however late it arrives. All folders
    are named by the micro-batch, so one that is repeated replaces what it wrote.
    """
    batch = F.floor(F.datediff(F.col("date"), F.lit(first)) / batch_days).cast("int")

    def write(rows: DataFrame, epoch: int) -> None:
        spark = rows.sparkSession
        state = cards.latest_state(rows.withColumn("batch", batch), ["batch"])
        state.write.mode("overwrite").partitionBy("batch").parquet(f"{path}/state/epoch={epoch}")
        own = spark.read.schema(state.schema).parquet(f"{path}/state/epoch={epoch}")
        touched = [r[0] for r in own.select("batch").distinct().collect()]
        if not touched:
            return
        # Only the folders of the touched batches are read.
        parts = spark.read.option("basePath", f"{path}/state").parquet(f"{path}/state").where(
            F.col("batch").isin(touched) & (F.col("epoch") <= epoch))
        cards.render_cards(cards.merge_states(parts, ["batch"]), ["batch"]).write.mode("overwrite").parquet(
            f"{path}/cards/epoch={epoch}")
        built = spark.read.parquet(f"{path}/cards/epoch={epoch}")
        routed = decisions.route_cards(built)
        routed.select("batch", "id", "topic").write.mode("overwrite").parquet(f"{path}/routed/epoch={epoch}")
        at_risk = decisions.on_topic(routed, config.TOPIC_STOCKOUT)
        reorders = decisions.positive_reorders(decisions.propose_reorders(at_risk, keep=["batch"]))
        reorders.write.mode("overwrite").parquet(f"{path}/reorders/epoch={epoch}")

    return (
        scored.writeStream.option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def replayed(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Cards, routing and reorders of every batch, as the last micro-batch that touched it left them."""
    tables = {n: spark.read.option("basePath", f"{path}/{n}").parquet(f"{path}/{n}") for n in REPLAY_TABLES}
    last = tables["cards"].groupBy("batch").agg(F.max("epoch").alias("epoch"))
    return {n: rows.join(last, ["batch", "epoch"], "left_semi").drop("epoch") for n, rows in tables.items()}


def replay_report(spark: SparkSession, path: str) -> DataFrame:
    """Per batch: cards, cards published as stockout risk, and positive reorders."""
    tables = replayed(spark, path)
    risks = tables["routed"].where(F.col("topic") == config.TOPIC_STOCKOUT)
    counted = tables["cards"].groupBy("batch").agg(F.count("*").alias("cards"))
    for name, rows in (("published", risks), ("reorders", tables["reorders"])):
        counted = counted.join(rows.groupBy("batch").agg(F.count("*").alias(name)), "batch", "left")
    return counted.fillna(0, ["published", "reorders"])
