"""The decision chain as streams: one per topic, each with its own checkpoint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfcast import config
from shelfcast.operators import cards as card_ops
from shelfcast.operators import decisions, topics
from shelfcast.plans.chain import Step, steps
from shelfcast.streaming.sinks import append_files, read_files


class TopicStreams:
    """Topic and action folders below one shared folder.

    The checkpoint of a consumer is its consumed mark: every message is worked on exactly
    once, also after a restart.
    """

    def __init__(self, spark: SparkSession, folder: str, now: Column | None = None):
        self._spark = spark
        self._folder = folder.rstrip("/")
        self._now = now if now is not None else F.current_timestamp()

    def topic_path(self, topic: str) -> str:
        return f"{self._folder}/topics/{topic}"

    def action_path(self, agent: str) -> str:
        return f"{self._folder}/actions/{agent}"

    def _append(self, stream: DataFrame, path: str, name: str) -> StreamingQuery:
        return append_files(stream, path, f"{self._folder}/checkpoints/{name}", name)

    def publish(self, cards: DataFrame) -> list[StreamingQuery]:
        """Route a stream of cards to the two first topics."""
        routed = decisions.route_cards(cards)
        started = []
        for topic in (config.TOPIC_STOCKOUT, config.TOPIC_DROP):
            batch = topics.messages(decisions.on_topic(routed, topic), topic, self._now, "id")
            started.append(self._append(batch, self.topic_path(topic), f"publish_{topic}"))
        return started

    def consume(self, step: Step, files_per_trigger: int | None = None) -> list[StreamingQuery]:
        """Run one consumer: its log, and its forward topic if it has one."""
        queue = read_files(
            self._spark, self.topic_path(step.topic), topics.MESSAGE_SCHEMA, files_per_trigger
        )
        result = step.rule(topics.read_payload(queue, step.schema).drop("message_id"))
        log = topics.actions(result, step.agent, step.action(), self._now)
        started = [self._append(log, self.action_path(step.agent), f"log_{step.agent}")]
        if step.forward:
            forwarded = topics.messages(result, step.forward, self._now)
            name = f"publish_{step.forward}"
            started.append(self._append(forwarded, self.topic_path(step.forward), name))
        return started

    def run_available(self, cards: DataFrame, supplier: DataFrame, cost: DataFrame) -> None:
        """Work off everything that is there, in dependency order, and stop."""
        for started in self.publish(cards):
            started.awaitTermination()
        for step in steps(supplier, cost):
            for started in self.consume(step):
                started.awaitTermination()

    def actions(self, agent: str) -> DataFrame:
        return self._spark.read.schema(topics.ACTION_SCHEMA).parquet(self.action_path(agent))

    def messages(self, topic: str) -> DataFrame:
        return self._spark.read.schema(topics.MESSAGE_SCHEMA).parquet(self.topic_path(topic))


def card_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    return read_files(spark, path, card_ops.CARD_SCHEMA, files_per_trigger)
