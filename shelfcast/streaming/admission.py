"""Rate admission and usage over a stream of asks."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import DataType, NumericType

from shelfcast import config
from shelfcast.operators.admission import Cell, Decision, KeyHistory, named_verdict

_LATE_CODE = 3
_SECOND = 1_000_000
_FRAME_ROWS = 10_000
_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


class AskHistory(StatefulProcessor):
    """State of :func:`admit_stream` for a group of keys: of each key the names of its cells and
    its newest cell as one entry, and its older cells as entries of their own.

    A group gives one call, and a key with one cell one read and one write of the state."""

    def __init__(self, kinds: dict[str, str], limits: tuple[int, int, int], late: int | None, cell_asks: int):
        self.kinds, self.limits, self.late, self.cell_asks = kinds, limits, late, cell_asks

    def init(self, handle: StatefulProcessorHandle) -> None:
        # State goes when its key has been silent for twice the time an ask can still need it.
        ttl = None if self.late is None else 2000 * (self.late + config.DAILY_SECONDS)
        cell = (
            f"times binary, ids array<{self.kinds['id']}>, verdicts binary, "
            "burst_used binary, daily_used binary, carry binary"
        )
        key = f"key {self.kinds['key']}"
        self.keys = handle.getMapState("keys", key, f"starts binary, newest long, {cell}", ttl)
        self.cells = handle.getMapState("cells", f"{key}, start long", cell, ttl)

    def _decide(self, key, asks: list[tuple[int, object]]) -> list[Decision]:
        known = self.keys.getValue((key,))
        starts, newest = (_numbers(known[0]), known[1]) if known else ([], None)
        held = {starts[-1]: _unpacked(known[2:])} if known else {}  # cells read or to be written
        before, changed = set(starts[:-1]), set()

        def load(start: int) -> Cell:
            if start not in held:
                held[start] = _unpacked(self.cells.getValue((key, start)))
            return held[start]

        def store(start: int, cell: Cell) -> None:
            held[start] = cell
            changed.add(start)

        def drop(start: int) -> None:
            changed.discard(start)
            if start in before:
                self.cells.removeKey((key, start))

        horizon = None if self.late is None or newest is None else newest - self.late * _SECOND
        refused = [a for a in asks if horizon is not None and a[0] < horizon]
        history = KeyHistory(starts, load, store, drop, *self.limits, cell_asks=self.cell_asks)
        changes = history.add([a for a in asks if horizon is None or a[0] >= horizon])
        changes += [Decision(name, at, _LATE_CODE, 0, 0) for at, name in refused]
        newest = max([at for at, _ in asks] + ([] if newest is None else [newest]))
        if self.late is not None:
            history.forget_before(newest - self.late * _SECOND)
        last = history.starts[-1]
        for start in changed - {last}:
            self.cells.updateValue((key, start), _packed(held[start]))
        # Only a cell that was split is no longer the newest, and its pieces are all stored.
        self.keys.updateValue((key,), (_bytes(history.starts), newest, *_packed(load(last))))
        return changes

    def handleInputRows(self, group, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        asks_of = defaultdict(list)
        for frame in rows:
            columns = (frame[c].tolist() for c in ("key", "no_key", "id", "no_id", "at"))
            for key, no_key, name, no_name, at in zip(*columns):
                asks_of[None if no_key else key].append((int(at), None if no_name else name))
        keys, changes = [], []
        for key, asks in asks_of.items():
            changed = self._decide(key, asks)
            keys += [key] * len(changed)
            changes += changed
            if len(changes) >= _FRAME_ROWS:
                yield self._frame(keys, changes)
                keys, changes = [], []
        if changes:
            yield self._frame(keys, changes)

    def _frame(self, keys: list, changes: list[Decision]) -> pd.DataFrame:
        frame = pd.DataFrame(changes, columns=Decision._fields)
        # As objects, so that a null among integers leaves the others whole.
        frame["id"] = pd.Series([c.id for c in changes], dtype="object")
        frame.insert(0, "key", pd.Series(keys, dtype="object"))
        return frame

    def close(self) -> None:
        pass


def _bytes(values: list[int], kind: str = "<i8") -> bytes:
    return np.array(values, dtype=kind).tobytes()


def _numbers(data: bytes, kind: str = "<i8") -> list[int]:
    return np.frombuffer(data, dtype=kind).tolist()


def _packed(cell: Cell) -> tuple:
    """A cell as it is stored: its numbers as bytes."""
    used = (_bytes(cell.burst_used, "<i4"), _bytes(cell.daily_used, "<i4"))
    return (_bytes(cell.times), cell.ids, _bytes(cell.verdicts, "i1"), *used, _bytes(cell.carry))


def _unpacked(stored: tuple) -> Cell:
    times, ids, verdicts, burst_used, daily_used, carry = stored
    used = (_numbers(burst_used, "<i4"), _numbers(daily_used, "<i4"))
    return Cell(_numbers(times), list(ids), _numbers(verdicts, "i1"), *used, _numbers(carry))


def _filled(column: Column, kind: DataType) -> Column:
    """A null among numbers would make them floats on their way to Python."""
    return F.coalesce(column, F.lit(0).cast(kind)) if isinstance(kind, NumericType) else column


def decide_stream(
    asks: DataFrame,
    key: str,
    time: str,
    ask_id: str,
    late: int | None,
    burst_max: int = config.BURST_MAX,
    burst_seconds: int = config.BURST_SECONDS,
    daily_max: int = config.DAILY_MAX,
    cell_asks: int = 4096,
    groups: int = 1024,
) -> DataFrame:
    """New and changed decisions of a stream of asks: key, id, time, verdict code and usage.

    Spark keeps a key's asks in its state store as cells of at most ``cell_asks`` in time order,
    each with the admitted times carried into it. An ask that comes late is decided in its
    place: its cell is decided again, and cells after it as long as the times carried on differ.
    So the work of a batch follows the cells it touches, not the length of the history.

    Keys are dealt by hash to ``groups``, whose asks of a batch come to Python together, as a call
    for each key costs more than deciding its asks. A task holds the asks of one group at a time;
    the number is fixed for the life of a checkpoint.

    ``late`` is by how many seconds an ask may come after a newer one of its key in an earlier
    batch. One that comes later is refused as late. Cells older than that are dropped, and the state
    of a silent key expires. With None every ask is kept and none is too late.
    """
    key_type, id_type = asks.schema[key].dataType, asks.schema[ask_id].dataType
    kinds = {"key": key_type.simpleString(), "id": id_type.simpleString()}
    narrow = asks.select(
        F.pmod(F.xxhash64(key), F.lit(groups)).cast("int").alias("group"),
        _filled(F.col(key), key_type).alias("key"),
        F.col(key).isNull().alias("no_key"),
        _filled(F.col(ask_id), id_type).alias("id"),
        F.col(ask_id).isNull().alias("no_id"),
        F.unix_micros(F.col(time).cast("timestamp")).alias("at"),
    )
    decided = narrow.groupBy("group").transformWithStateInPandas(
        statefulProcessor=AskHistory(kinds, (burst_max, burst_seconds, daily_max), late, cell_asks),
        outputStructType=(
            f"key {kinds['key']}, id {kinds['id']}, at long, verdict int, "
            "burst_used long, daily_used long"
        ),
        outputMode="Update",
        timeMode="None" if late is None else "ProcessingTime",
    )
    return decided.select(
        F.col("key").alias(key),
        F.col("id").alias(ask_id),
        F.timestamp_micros("at").alias(time),
        "verdict",
        "burst_used",
        "daily_used",
    )


def admit_stream(
    asks: DataFrame,
    key: str,
    time: str,
    ask_id: str,
    path: str,
    checkpoint: str,
    late: int | None,
    **limits: int,
) -> StreamingQuery:
    """Admit or refuse asks as they arrive, in any order; see :func:`decide_stream`.

    What a micro-batch decides is written below ``path`` under the id of the query and the
    number of the batch, so a repeated batch replaces its own folder. :func:`verdicts` and
    :func:`usage` read the newest decision of each ask.
    """

    def write(batch: DataFrame, number: int) -> None:
        name = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.write.mode("overwrite").parquet(f"{path}/_query={name}/_round={number}")

    decided = decide_stream(asks, key, time, ask_id, late, **limits).writeStream.outputMode("update")
    started = decided.foreachBatch(write).option("checkpointLocation", checkpoint)
    # State that expires asks for batches without data, and would never run out of them. Expired
    # entries are hidden at once and cleared with the next data. The query keeps its own copy of the
    # session's settings.
    conf = asks.sparkSession.conf
    before = conf.get(_NO_DATA, "true")
    conf.set(_NO_DATA, "false")
    try:
        return started.trigger(availableNow=True).start()
    finally:
        conf.set(_NO_DATA, before)


def _newest(spark: SparkSession, path: str, key: str, ask_id: str) -> DataFrame:
    rows = spark.read.option("basePath", path).parquet(f"{path}/_query=*/_round=*")
    if rows.select("_query").distinct().count() > 1:
        raise ValueError(f"{path} holds decisions of several checkpoints; give each a path of its own")
    others = [c for c in rows.columns if c not in (key, ask_id, "_query", "_round")]
    newest = F.max_by(F.struct(*others), "_round").alias("_newest")
    return rows.groupBy(key, ask_id).agg(newest).select(key, ask_id, "_newest.*")


def verdicts(spark: SparkSession, path: str, key: str, ask_id: str) -> DataFrame:
    """The newest verdict of each ask: key, ask id, time, ``admitted`` and ``refused_by``."""
    rows = _newest(spark, path, key, ask_id)
    plain = [c for c in rows.columns if c not in ("verdict", "burst_used", "daily_used")]
    return rows.select(*plain, *named_verdict(F.col("verdict")))


def usage(spark: SparkSession, path: str, key: str, ask_id: str) -> DataFrame:
    """For every admitted ask, the admitted asks of its key in the trailing windows up to it."""
    return _newest(spark, path, key, ask_id).where("verdict = 0").drop("verdict")
