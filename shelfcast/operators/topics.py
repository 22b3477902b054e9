"""Topic messages, their consumption, the backlog and the action log."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast import config
from shelfcast.sources import versions
from shelfcast.sources.tables import MissingInput, append_table, read_parquet

MESSAGE_SCHEMA = (
    "id string, topic string, card_id string, payload string, created_at timestamp"
)
CONSUMED_SCHEMA = "id string, topic string, consumed_at timestamp, poll_id string"
CONSUMER = "default"
ACTION_SCHEMA = (
    "id string, agent string, card_id string, action string, details string, "
    "created_at timestamp"
)


def as_json(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns))


def message_id(topic: Column, card_id: Column, created_at: Column) -> Column:
    """Same message, same id: a repeated append can be recognised."""
    moment = F.unix_micros(created_at).cast("string")
    return F.md5(F.concat_ws("|", topic, card_id, moment))


def messages(
    rows: DataFrame,
    topic: Column | str,
    created_at: Column,
    card_id: str = "card_id",
    payload: Sequence[str] | None = None,
) -> DataFrame:
    """Rows as topic messages with a JSON payload."""
    topic = F.lit(topic) if isinstance(topic, str) else topic
    fields = payload or [c for c in rows.columns if c != "topic"]
    return rows.select(
        message_id(topic, F.col(card_id), created_at).alias("id"),
        topic.alias("topic"),
        F.col(card_id).alias("card_id"),
        as_json(fields).alias("payload"),
        created_at.alias("created_at"),
    )


def read_payload(queue: DataFrame, schema: str) -> DataFrame:
    """Payload fields as columns, next to the message id."""
    parsed = queue.select("id", F.from_json("payload", schema).alias("_p"))
    return parsed.select(F.col("id").alias("message_id"), "_p.*")


def actions(
    rows: DataFrame,
    agent: str,
    action: Column | str,
    created_at: Column,
    card_id: Column | str = "card_id",
    details: Sequence[str] | None = None,
) -> DataFrame:
    """Rows as entries of the action log."""
    action = F.lit(action) if isinstance(action, str) else action
    card = F.col(card_id) if isinstance(card_id, str) else card_id
    return rows.select(
        F.md5(
            F.concat_ws("|", F.lit(agent), action, card, F.unix_micros(created_at).cast("string"))
        ).alias("id"),
        F.lit(agent).alias("agent"),
        card.alias("card_id"),
        action.alias("action"),
        as_json(details or rows.columns).alias("details"),
        created_at.alias("created_at"),
    )


def pending(queue: DataFrame, consumed: DataFrame) -> DataFrame:
    """Published and not yet consumed."""
    return queue.join(consumed.select("id"), "id", "left_anti")


def poll(
    queue: DataFrame, consumed: DataFrame, topic: str, limit: int = config.POLL_LIMIT
) -> DataFrame:
    """The oldest pending messages of one topic, at most ``limit`` of them."""
    waiting = pending(queue.where(F.col("topic") == topic), consumed)
    return waiting.orderBy("created_at", "id").limit(limit)


def consumption(polled: DataFrame, consumed_at: Column, poll_id: str = "") -> DataFrame:
    return polled.select(
        "id", "topic", consumed_at.alias("consumed_at"), F.lit(poll_id).alias("poll_id")
    )


def backlog(queue: DataFrame, consumed: DataFrame) -> DataFrame:
    """Pending messages per topic."""
    return (
        pending(queue, consumed)
        .groupBy("topic")
        .agg(F.count("*").alias("pending"))
    )


def recent(actions_log: DataFrame, limit: int = config.RECENT_ACTIONS) -> DataFrame:
    """Newest actions first; only ``limit`` rows leave each task."""
    return actions_log.orderBy(F.desc("created_at"), "id").limit(limit)


class Mark(NamedTuple):
    """Up to where a consumer has worked a topic off.

    Consumed are all messages published up to ``upto`` that stand at or before (``at``, ``id``)
    in the order of time and id, but for the exceptions; and what its list of epoch ``epoch`` holds.
    """

    at: int  # microseconds
    id: str
    upto: int
    epoch: int
    folder: str | None  # of the exceptions


_NO_MARK = Mark(-(2**62), "", 0, 0, None)


class TopicStore:
    """Topic, consumption and action tables below one folder or URI.

    A topic has one publisher and any number of named consumers. Messages are stored by topic
    and publication, a consumer's list of consumed messages by topic, consumer and epoch, so
    that polling reads only what belongs to its topic. :meth:`compact` replaces the list by a
    high-water mark: messages below it are skipped by file statistics, and what is left to join
    are the messages consumed since, and the few that were published later than their time
    says (the exceptions).

    A poll writes its consumption before it hands out the rows (at most once, as the
    operator it stands for); consumers that must not lose work use the streaming form.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder.rstrip("/")

    def _path(self, name: str) -> str:
        return f"{self._folder}/{name}"

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            return read_parquet(self._spark, self._path(name), name, schema)
        except MissingInput:
            return self._spark.createDataFrame([], schema)

    def _marks(self, topic: str, consumer: str) -> str:
        return self._path(f"marks/{topic}/{consumer}")

    def _list(self, topic: str, consumer: str, epoch: int) -> str:
        return f"consumed/topic={topic}/consumer={consumer}/epoch={epoch}"

    def publish(self, batch: DataFrame) -> None:
        """Append messages; the number of a publication is the moment of its writing."""
        numbered = batch.withColumn("published", F.lit(time.time_ns() // 1000))
        append_table(numbered, self._path("queue"), ["topic", "published"])

    def log(self, batch: DataFrame) -> None:
        append_table(batch, self._path("actions"))

    def _queue(self) -> DataFrame:
        return self._read("queue", f"{MESSAGE_SCHEMA}, published long")

    def queue(self) -> DataFrame:
        return self._queue().drop("published")

    def actions(self) -> DataFrame:
        return self._read("actions", ACTION_SCHEMA)

    def mark_of(self, topic: str, consumer: str = CONSUMER) -> Mark:
        found = versions.newest(self._spark, self._marks(topic, consumer))
        return Mark(**json.loads(found.note), folder=found.folder) if found else _NO_MARK

    def _listed(self, topic: str, consumer: str, mark: Mark) -> DataFrame:
        """What the consumer has marked since the last compaction, each message once."""
        schema = "id string, consumed_at timestamp, poll_id string"
        return self._read(self._list(topic, consumer, mark.epoch), schema).dropDuplicates(["id"])

    def _exceptions(self, mark: Mark) -> DataFrame:
        if mark.folder is None:
            return self._spark.createDataFrame([], "id string")
        return read_parquet(self._spark, f"{mark.folder}/exceptions", "exceptions", "id string")

    def _open(self, topic: str, consumer: str, mark: Mark) -> DataFrame:
        """Messages of the topic that the mark does not cover."""
        rows = self._queue().where(F.col("topic") == topic)
        at = F.lit(mark.at).cast("long")
        moment = F.timestamp_micros(at)
        after = (F.col("created_at") > moment) | ((F.col("created_at") == moment) & (F.col("id") > mark.id))
        beyond = after if mark.folder is not None else F.lit(True)
        late = rows.where(~beyond & (F.col("published") > mark.upto))
        kept = rows.where(~beyond & (F.col("published") <= mark.upto)).join(self._exceptions(mark), "id", "left_semi")
        return rows.where(beyond).unionByName(late).unionByName(kept)

    def pending(self, topic: str, consumer: str = CONSUMER) -> DataFrame:
        """Messages of one topic that the consumer has not taken, each once."""
        mark = self.mark_of(topic, consumer)
        waiting = pending(self._open(topic, consumer, mark), self._listed(topic, consumer, mark))
        return waiting.drop("published").dropDuplicates(["id"])

    def consumed(self, consumer: str = CONSUMER) -> DataFrame:
        """Ids and topics of everything the consumer has taken, below its marks too."""
        found = self._spark.createDataFrame([], "id string, topic string")
        queue = self.queue()
        for topic in self._topics():
            taken = queue.where(F.col("topic") == topic).join(
                self.pending(topic, consumer).select("id"), "id", "left_anti")
            found = found.unionByName(taken.select("id", "topic"))
        return found

    def _topics(self) -> list[str]:
        return sorted(r[0] for r in self.queue().select("topic").distinct().collect())

    def poll(
        self, topic: str, now: Column, limit: int = config.POLL_LIMIT, consumer: str = CONSUMER
    ) -> DataFrame:
        """Take the oldest pending messages of a topic and mark them consumed.

        The mark is written first and then read back, so the rows handed out are exactly
        the rows marked, also when a task is repeated.
        """
        poll_id = uuid.uuid4().hex
        mark = self.mark_of(topic, consumer)
        taken = self.pending(topic, consumer).orderBy("created_at", "id").limit(limit)
        listed = self._list(topic, consumer, mark.epoch)
        append_table(consumption(taken, now, poll_id).drop("topic"), self._path(listed))
        marked = self._read(listed, "id string, consumed_at timestamp, poll_id string").where(
            F.col("poll_id") == poll_id).select("id")
        # The mark holds at most ``limit`` ids.
        return (
            self.queue()
            .where(F.col("topic") == topic)
            .join(marked, "id", "left_semi")
            .dropDuplicates(["id"])
        )

    def mark(self, batch: DataFrame, now: Column, topic: str, consumer: str = CONSUMER) -> None:
        """Mark messages consumed after their results are written.

        Merged by message id: a batch that is marked again adds nothing.
        """
        mark = self.mark_of(topic, consumer)
        waiting = self.pending(topic, consumer).select("id")
        fresh = consumption(batch, now).drop("topic").dropDuplicates(["id"]).join(waiting, "id", "left_semi")
        append_table(fresh, self._path(self._list(topic, consumer, mark.epoch)))

    def compact(self, topic: str, consumer: str = CONSUMER) -> Mark:
        """Raise the mark to just before the first pending message after it.

        The pending messages below it become exceptions, and only what was consumed after it
        stays in the list. Both are written to a new epoch, which is published last: a reader
        sees the old state or the new one. The consumer itself must not poll meanwhile.
        """
        path = self._marks(topic, consumer)
        old = self.mark_of(topic, consumer)
        rows = self._queue().where(F.col("topic") == topic)
        place = F.struct(F.unix_micros("created_at").alias("at"), "id")
        waiting = self.pending(topic, consumer).select(place.alias("place")).where(
            F.col("place") > F.struct(F.lit(old.at).cast("long").alias("at"), F.lit(old.id).alias("id")))
        upto = rows.agg(F.max("published")).first()[0] or 0
        first = waiting.agg(F.min("place")).first()[0]
        done = rows.where(F.col("published") <= upto).select(place.alias("place"))
        if first is not None:
            done = done.where(F.col("place") < F.struct(F.lit(first["at"]).alias("at"), F.lit(first["id"]).alias("id")))
        last = done.agg(F.max("place")).first()[0]
        if last is None or (last["at"], last["id"]) < (old.at, old.id):
            last = {"at": old.at, "id": old.id}
        folder, epoch = versions.draft(path), old.epoch + 1
        below = F.col("place") <= F.struct(F.lit(last["at"]).cast("long").alias("at"), F.lit(last["id"]).alias("id"))
        left = self.pending(topic, consumer).select("id", place.alias("place"))
        left.where(below).select("id").write.parquet(f"{folder}/exceptions")
        placed = rows.select("id", place.alias("place")).dropDuplicates(["id"])
        kept = self._listed(topic, consumer, old).join(placed.where(~below).select("id"), "id", "left_semi")
        kept.write.mode("overwrite").parquet(self._path(self._list(topic, consumer, epoch)))
        mark = {"at": last["at"], "id": last["id"], "upto": upto, "epoch": epoch}
        versions.publish(self._spark, path, folder, json.dumps(mark))
        return Mark(**mark, folder=folder)

    def backlog(self, consumer: str = CONSUMER) -> DataFrame:
        """Pending messages per topic; one topic's part is read at a time."""
        found = self._spark.createDataFrame([], MESSAGE_SCHEMA)
        for topic in self._topics():
            found = found.unionByName(self.pending(topic, consumer))
        return found.groupBy("topic").agg(F.count("*").alias("pending"))
