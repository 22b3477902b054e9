"""Two-tier rate admission and usage counts over trailing time windows."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast import config
from shelfcast.functions.scalars import before
from shelfcast.sources.tables import stage

_SECOND = 1_000_000
_MINUTE = 60 * _SECOND

# Rows of one key a single task may take. A key with more is cut into chunks in time.
CHUNK_ROWS = 4_000_000
# Slots of time by which one task bounds the admissions of a key cut into chunks.
MOST_SLOTS = 1 << 20

ADMITTED, BURST, DAILY, LATE = "", "burst", "daily", "late"


def admit_in_order(
    times: np.ndarray,
    carry: list[int],
    burst_max: int = config.BURST_MAX,
    burst_seconds: int = config.BURST_SECONDS,
    daily_max: int = config.DAILY_MAX,
) -> tuple[np.ndarray, list[int]]:
    """Decide asks in time order, given the earlier admitted times that still count.

    Times are microseconds. Only admitted asks count, the burst limit is looked at first,
    and an ask exactly one window after an admission no longer sees it. After an
    admission the next one is found by search, so the work follows the admissions.
    Returns 0 admitted, 1 burst, 2 daily per ask, and the times to carry on.
    """
    burst, day = burst_seconds * _SECOND, config.DAILY_SECONDS * _SECOND
    kept, most = list(carry), max(burst_max, daily_max)
    listed = times.tolist()  # searched by bisect, as a call of numpy costs more than a short search
    verdict = np.zeros(len(times), dtype="int8")
    at = 0
    while at < len(listed):
        now = listed[at]
        burst_free = kept[-burst_max] + burst if len(kept) >= burst_max else now
        daily_free = kept[-daily_max] + day if len(kept) >= daily_max else now
        if max(burst_free, daily_free) > now:
            burst_end = bisect_left(listed, burst_free, at)
            daily_end = bisect_left(listed, daily_free, at)
            verdict[at:daily_end] = 2
            verdict[at:burst_end] = 1
            at = max(burst_end, daily_end)
        if at < len(listed):
            kept.append(listed[at])
            if len(kept) > 2 * most:
                kept = kept[-most:]
            at += 1
    kept = kept[-most:]
    return verdict, kept


class Cell(NamedTuple):
    """Consecutive asks of one key in time order, with what was decided about them.

    ``carry`` are the admitted times before the cell that can still count in it.
    """

    times: list[int]
    ids: list
    verdicts: list[int]
    burst_used: list[int]
    daily_used: list[int]
    carry: list[int]


class Decision(NamedTuple):
    id: object
    at: int
    verdict: int
    burst_used: int
    daily_used: int


FIRST_CELL = -(2**63)


def _time_then_id(ask: tuple) -> tuple:
    at, name = ask
    return (at, name is None, 0 if name is None else name)


class KeyHistory:
    """The asks of one key, kept as cells so that a late ask is replayed from its cell on.

    ``starts`` are the cells' names in order: a cell holds the asks from its name up to the next
    one. ``load``, ``store`` and ``drop`` reach a cell by name. A cell that outgrows
    ``cell_asks`` is split where the time changes.
    """

    def __init__(
        self,
        starts: list[int],
        load: Callable[[int], Cell],
        store: Callable[[int, Cell], None],
        drop: Callable[[int], None],
        burst_max: int = config.BURST_MAX,
        burst_seconds: int = config.BURST_SECONDS,
        daily_max: int = config.DAILY_MAX,
        cell_asks: int = 4096,
    ):
        self.starts, self.load, self.store, self.drop = list(starts), load, store, drop
        self.limits = (burst_max, burst_seconds, daily_max)
        self.cell_asks = cell_asks
        self.decided = 0  # asks looked at by :meth:`add`

    def _carried(self, cell: Cell, at: int) -> list[int]:
        """Admitted times of a cell and before it that still count at ``at``."""
        burst_max, _, daily_max = self.limits
        admitted = [t for t, v in zip(cell.times, cell.verdicts) if v == 0]
        since = at - config.DAILY_SECONDS * _SECOND
        return [t for t in cell.carry + admitted if t > since][-max(burst_max, daily_max) :]

    def _decide(self, times: list[int], ids: list, carry: list[int]) -> Cell:
        self.decided += len(times)
        at = np.array(times, dtype="int64")
        verdict, _ = admit_in_order(at, carry, *self.limits)
        admitted = np.concatenate([np.array(carry, dtype="int64"), at[verdict == 0]])
        now = np.searchsorted(admitted, at, "right")

        def used(seconds: int) -> list[int]:
            before = np.searchsorted(admitted, at - seconds * _SECOND, "right")
            return np.where(verdict == 0, now - before, 0).tolist()

        return Cell(
            times, ids, verdict.tolist(), used(self.limits[1]), used(config.DAILY_SECONDS), carry
        )

    def _split(self, start: int, cell: Cell) -> None:
        """Store a cell, in pieces if it has too many asks. Asks of one moment stay together."""
        begin = 0
        while len(cell.times) - begin > self.cell_asks:
            end = begin + self.cell_asks // 2
            while end < len(cell.times) and cell.times[end] == cell.times[end - 1]:
                end += 1
            if end == len(cell.times):
                break
            piece = Cell(*(c[begin:end] for c in cell[:5]), cell.carry)
            self.store(start, piece)
            start = cell.times[end]
            self.starts.insert(bisect_right(self.starts, start), start)
            cell = cell._replace(carry=self._carried(piece, start))
            begin = end
        self.store(start, Cell(*(c[begin:] for c in cell[:5]), cell.carry))

    def add(self, asks: list[tuple[int, object]]) -> list[Decision]:
        """Decide new asks (time, id), in any order. Returns what is new or has changed.

        The asks of a cell are decided again from the times carried into it, and so are the
        cells after it, up to the first one into which the same times are carried as before.
        """
        if not self.starts:
            self.starts = [FIRST_CELL]
            self.store(FIRST_CELL, Cell([], [], [], [], [], []))
        fresh = defaultdict(list)
        for at, ask in asks:
            fresh[self.starts[bisect_right(self.starts, at) - 1]].append((at, ask))
        changes: list[Decision] = []
        order = list(self.starts)
        place, carry = 0, None
        while place < len(order):
            start = order[place]
            cell = None
            if carry is None:  # nothing before has changed: go on with the next cell that has new asks
                waiting = [n for n in range(place, len(order)) if order[n] in fresh]
                if not waiting:
                    break
                place = waiting[0]
                start = order[place]
                cell = self.load(start)
                carry = cell.carry
            cell = cell or self.load(start)
            added = fresh.pop(start, [])
            if not added and carry == cell.carry:
                carry = None
                continue
            new = set(added)
            rows = sorted([*zip(cell.times, cell.ids), *added], key=_time_then_id)
            known = {}
            for row in zip(cell.ids, cell.times, cell.verdicts, cell.burst_used, cell.daily_used):
                known[row[1], row[0]] = Decision(*row)
            decided = self._decide([t for t, _ in rows], [i for _, i in rows], carry)
            for row in zip(decided.ids, decided.times, *decided[2:5]):
                decision = Decision(*row)
                if (row[1], row[0]) in new or known.get((row[1], row[0])) != decision:
                    changes.append(decision)
            self._split(start, decided)
            place += 1
            carry = self._carried(decided, order[place]) if place < len(order) else None
        return changes

    def forget_before(self, at: int) -> None:
        """Drop the cells that end before ``at``, but for the last, from which times are carried."""
        ended = bisect_right(self.starts, at) - 1
        for start in self.starts[: max(ended - 1, 0)]:
            self.drop(start)
        self.starts = self.starts[max(ended - 1, 0) :]


def _hot_minutes(asks: DataFrame, chunk_rows: int) -> DataFrame:
    """The chunk of each minute of a key with many rows, from its second chunk on.

    Works on counts per key and minute, so no key is gathered: the running count has at
    most one row per minute.
    """
    per_minute = asks.groupBy("_key", "_minute").agg(F.count("*").alias("n"))
    order = Window.partitionBy("_key").orderBy("_minute")
    before = F.sum("n").over(order) - F.col("n")
    numbered = per_minute.withColumn("_chunk", F.floor(before / F.lit(chunk_rows)).cast("int"))
    return numbered.where("_chunk > 0 and _minute is not null").select("_key", "_minute", "_chunk")


def _chunked(asks: DataFrame, minutes: DataFrame) -> DataFrame:
    return asks.join(minutes, ["_key", "_minute"], "left").withColumn(
        "_chunk", F.coalesce("_chunk", F.lit(0))
    )


def admission_bounds(
    first: np.ndarray,
    last: np.ndarray,
    count: np.ndarray,
    burst_max: int = config.BURST_MAX,
    burst_seconds: int = config.BURST_SECONDS,
    daily_max: int = config.DAILY_MAX,
) -> tuple[np.ndarray, np.ndarray]:
    """Earliest and latest time of each admission, from first, last and number of asks per slot.

    More asks never make the n-th admission later. Deciding only the known asks (first and last
    of a slot) gives the latest times, and letting a slot's other asks come whenever they suit
    gives the earliest. An admission that only the latter has can come up to the last ask.
    """
    ends = np.stack([first, last], axis=1).ravel()
    ends = ends[np.stack([count > 0, count > 1], axis=1).ravel()]
    verdict, _ = admit_in_order(ends, [], burst_max, burst_seconds, daily_max)
    latest = ends[verdict == 0]
    # A slot as its first ask, those between and its last ask.
    room = np.stack([count > 0, np.maximum(count - 2, 0), count > 1], axis=1).astype("int64").ravel()
    begins = np.stack([first, first, last], axis=1).ravel()[room > 0]
    ends = np.stack([first, last, last], axis=1).ravel()[room > 0]
    room = room[room > 0]
    burst, day = burst_seconds * _SECOND, config.DAILY_SECONDS * _SECOND
    kept: list[int] = []
    place = used = 0
    while True:
        free = kept[-1] if kept else int(begins[0])
        if len(kept) >= burst_max:
            free = max(free, kept[-burst_max] + burst)
        if len(kept) >= daily_max:
            free = max(free, kept[-daily_max] + day)
        here = max(int(np.searchsorted(ends, free, "left")), place)
        if here == place and used >= room[place]:
            here += 1
        if here == len(ends):
            break
        used = used + 1 if here == place else 1
        place = here
        kept.append(max(free, int(begins[here])))
    latest = np.concatenate([latest, np.full(len(kept) - len(latest), last[-1])])
    return np.array(kept, dtype="int64"), latest


def _spans(first: np.ndarray, last: np.ndarray) -> pd.DataFrame:
    """Union of spans whose ends never decrease, cut at minutes."""
    new = np.r_[True, first[1:] > last[:-1]]
    first, last = first[new], last[np.r_[new[1:], True]]
    minute = first // _MINUTE
    n = last // _MINUTE - minute + 1
    minute = np.repeat(minute, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    low = np.maximum(np.repeat(first, n), minute * _MINUTE)
    high = np.minimum(np.repeat(last, n), minute * _MINUTE + _MINUTE - 1)
    return pd.DataFrame({"_minute": minute, "_low": low, "_high": high})


def _possible(asks: DataFrame, chunk_rows: int, limits: tuple[int, int, int]) -> DataFrame:
    """The asks of hot keys that can be admitted at all; deciding them alone admits the same ones.

    A key's asks are summarised in slots of time. From the slots one task bounds the time of each
    admission, and only asks within these bounds are kept. With fewer asks left the slots are cut
    finer, until no key has more than ``chunk_rows`` asks or the bounds no longer help.
    """
    key_type = asks.schema["_key"].dataType.simpleString()
    schema = f"_key {key_type}, _minute long, _low long, _high long"

    def bound(slots: pd.DataFrame) -> pd.DataFrame:
        slots = slots.sort_values("_first")
        found = _spans(*admission_bounds(*(slots[c].to_numpy() for c in ("_first", "_last", "_n")), *limits))
        found.insert(0, "_key", [slots["_key"].iloc[0]] * len(found))
        return found

    lengths = asks.groupBy("_key").agg((F.max("_at") - F.min("_at") + 1).alias("_length"))
    most = None
    while True:
        rows = asks.groupBy("_key").count().agg(F.max("count"), F.sum("count")).first()
        if rows[0] is None or rows[0] <= chunk_rows or (most is not None and rows[1] > 0.8 * most):
            return asks
        most = rows[1]
        width = lengths.select("_key", F.greatest(F.lit(1), F.ceil(F.col("_length") / MOST_SLOTS)).alias("_width"))
        slots = asks.join(width, "_key").groupBy("_key", F.expr("_at div _width").alias("_slot")).agg(
            F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.count("*").alias("_n"))
        spans = stage(slots.groupBy("_key").applyInPandas(bound, schema), "spans")
        within = F.exists("_within", lambda s: (F.col("_at") >= s["_low"]) & (F.col("_at") <= s["_high"]))
        by_minute = spans.groupBy("_key", "_minute").agg(F.collect_list(F.struct("_low", "_high")).alias("_within"))
        asks = stage(asks.join(by_minute, ["_key", "_minute"]).where(within).drop("_within"), "possible")
        lengths = spans.groupBy("_key").agg(F.sum(F.col("_high") - F.col("_low") + 1).alias("_length"))


def rate_admission(
    asks: DataFrame,
    key: str,
    time: str,
    ask_id: str,
    burst_max: int = config.BURST_MAX,
    burst_seconds: int = config.BURST_SECONDS,
    daily_max: int = config.DAILY_MAX,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Admit or refuse every ask: key, ask id, time, ``admitted`` and ``refused_by``.

    Whether an ask passes depends on the admissions before it, so a key is decided in time
    order. Most keys fit one task. A key with more than ``chunk_rows`` rows is cut in time.
    First the asks that can be admitted at all are found (see :func:`_possible`) and decided
    alone; of a saturated key these are little more than the admitted ones. Then all chunks run
    in parallel, each starting from the times admitted before it, which is the exact sequential
    result. If more than ``chunk_rows`` possible asks are left, they are decided in chunks that
    hand their admitted times on until nothing changes, at worst in as many rounds as chunks.
    """
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    narrow = asks.select(
        F.col(key).alias("_key"),
        F.col(ask_id).alias("_id"),
        micros.alias("_at"),
        F.floor(micros / _MINUTE).alias("_minute"),
    )
    limits = (burst_max, burst_seconds, daily_max)
    key_type = narrow.schema["_key"].dataType.simpleString()
    id_type = narrow.schema["_id"].dataType.simpleString()
    decided_schema = f"_key {key_type}, _id {id_type}, _at long, _verdict int"

    def decide(asks_of: pd.DataFrame, carry: list[int]) -> tuple[pd.DataFrame, list[int]]:
        ordered = asks_of.sort_values(["_at", "_id"])
        verdict, kept = admit_in_order(ordered["_at"].to_numpy(), carry, *limits)
        ordered = ordered[["_key", "_id", "_at"]].assign(_verdict=verdict.astype("int32"))
        return ordered, kept

    minutes = _hot_minutes(narrow, chunk_rows).persist()
    if minutes.isEmpty():
        minutes.unpersist()
        decided = narrow.groupBy("_key").applyInPandas(
            lambda group: decide(group, [])[0], decided_schema
        )
    else:
        chunked = stage(_chunked(narrow, minutes), "asks")
        hot = chunked.where("_at is not null").join(minutes.select("_key").distinct(), "_key", "left_semi")
        possible = _possible(hot.drop("_chunk"), chunk_rows, limits)
        again = stage(_chunked(possible, _hot_minutes(possible, chunk_rows)), "possible")
        admitted = _decide_chunks(again, decide, key_type, decided_schema).where("_verdict = 0")
        starts = minutes.groupBy("_key", "_chunk").agg((F.min("_minute") * _MINUTE).alias("_start"))
        carry = _carried_in(stage(admitted.select("_key", "_at"), "admitted"), starts, limits).checkpoint()
        minutes.unpersist()
        decided = _settle(chunked, carry, decide, decided_schema)
    return decided.select(
        F.col("_key").alias(key),
        F.col("_id").alias(ask_id),
        F.timestamp_micros("_at").alias(time),
        *named_verdict(F.col("_verdict")),
    )


def named_verdict(code: Column) -> list[Column]:
    """``admitted`` and ``refused_by`` from the code of a decision."""
    reason = F.when(code == 1, BURST).when(code == 2, DAILY).when(code == 3, LATE)
    return [(code == 0).alias("admitted"), reason.otherwise(ADMITTED).alias("refused_by")]


def _carried_in(admitted: DataFrame, starts: DataFrame, limits: tuple[int, int, int]) -> DataFrame:
    """Per chunk the admitted times before its start that still count, at most ``daily_max``."""
    burst_max, burst_seconds, daily_max = limits
    window = max(burst_seconds, config.DAILY_SECONDS) * _SECOND
    near = F.floor(F.col("_at") / window)
    earlier = admitted.withColumn("_w", F.explode(F.array(near, near + 1)))
    pairs = starts.withColumn("_w", F.floor(F.col("_start") / window)).join(earlier, ["_key", "_w"])
    return (
        pairs.where((F.col("_at") < F.col("_start")) & (F.col("_at") > F.col("_start") - window))
        .groupBy("_key", "_chunk")
        .agg(F.array_sort(F.collect_list("_at")).alias("_carry"))
        .withColumn("_carry", F.reverse(F.slice(F.reverse("_carry"), 1, max(burst_max, daily_max))))
    )


def _carry_of(frame: pd.DataFrame) -> list[int]:
    return [int(v) for v in frame["_carry"].iloc[0]] if len(frame) else []


def _settle(chunked: DataFrame, carry: DataFrame, decide, decided_schema: str) -> DataFrame:
    """Decides every chunk from the times carried into it."""
    group = ["_key", "_chunk"]

    def settle(asks_of: pd.DataFrame, carry: pd.DataFrame) -> pd.DataFrame:
        if asks_of.empty:
            return pd.DataFrame({"_key": [], "_id": [], "_at": [], "_verdict": []})
        return decide(asks_of, _carry_of(carry))[0]

    return chunked.groupBy(*group).cogroup(carry.groupBy(*group)).applyInPandas(settle, decided_schema)


def _decide_chunks(chunked: DataFrame, decide, key_type: str, decided_schema: str) -> DataFrame:
    spark = chunked.sparkSession
    group = ["_key", "_chunk"]
    carry_schema = f"_key {key_type}, _chunk int, _carry array<long>"

    def hand_on(name, asks_of: pd.DataFrame, carry: pd.DataFrame) -> pd.DataFrame:
        if asks_of.empty:
            return pd.DataFrame({"_key": [], "_chunk": [], "_carry": []})
        kept = decide(asks_of, _carry_of(carry))[1]
        return pd.DataFrame({"_key": [name[0]], "_chunk": [int(name[1]) + 1], "_carry": [kept]})

    # Carry tables hold at most daily_max times per chunk. They are checkpointed to the
    # shared folder, so the lineage stays short and survives lost executors.
    carry = spark.createDataFrame([], carry_schema)
    exists = chunked.select(*group).distinct().checkpoint()
    active = exists
    while True:
        todo = chunked.join(active, group, "left_semi")
        handed = (
            todo.groupBy(*group)
            .cogroup(carry.join(active, group, "left_semi").groupBy(*group))
            .applyInPandas(hand_on, carry_schema)
            .join(exists, group, "left_semi")
        )
        new = handed.withColumnRenamed("_carry", "_new").join(carry, group, "left")
        changed = (
            new.where(~F.col("_new").eqNullSafe(F.coalesce("_carry", F.array().cast("array<long>"))))
            .select(*group, F.col("_new").alias("_carry"))
            .checkpoint()
        )
        if changed.isEmpty():
            break
        carry = carry.join(changed, group, "left_anti").unionByName(changed).checkpoint()
        active = changed.select(*group)
    return _settle(chunked, carry, decide, decided_schema)


def usage_counts(
    log: DataFrame, key: str, time: str, row_id: str, windows: dict[str, int]
) -> DataFrame:
    """For every logged row, how many rows of its key lie in each trailing window.

    ``windows`` maps column names to seconds; a window excludes its far end, so a row
    exactly one window old no longer counts. A count is the difference of two ranks: rows
    up to now, less rows up to the cutoff. A rank is the running count of earlier minutes
    plus the rank inside its minute, so rows are shuffled by key and minute and a hot key
    is spread over its minutes.
    """
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    names = list(windows)
    probes = F.array(
        F.struct(F.lit("").alias("name"), micros.alias("at")),
        *(
            F.struct(F.lit(name).alias("name"), (micros - windows[name] * _SECOND).alias("at"))
            for name in names
        ),
    )
    points = log.select(
        F.col(key).alias("_key"),
        F.col(row_id).alias("_id"),
        F.col(time).alias("_time"),
        F.explode(probes).alias("_p"),
    ).select(
        "_key", "_id", "_time",
        F.col("_p.name").alias("_name"),
        F.col("_p.at").alias("_at"),
        F.floor(F.col("_p.at") / _MINUTE).alias("_minute"),
    )
    counts = F.col("_name") == ""
    per_minute = points.groupBy("_key", "_minute").agg(F.count_if(counts).alias("_n"))
    earlier = Window.partitionBy("_key").orderBy("_minute")
    running = per_minute.select(
        "_key", "_minute", (F.sum("_n").over(earlier) - F.col("_n")).alias("_before")
    )
    inside = (
        Window.partitionBy("_key", "_minute")
        .orderBy("_at")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = points.withColumn("_in", F.count_if(counts).over(inside)).join(
        running, ["_key", "_minute"]
    )
    rank = F.col("_before") + F.col("_in")
    per_row = ranked.groupBy("_key", "_id", "_time").agg(
        F.max(F.when(counts, rank)).alias("_now"),
        *(F.max(F.when(F.col("_name") == n, rank)).alias(f"_{n}") for n in names),
    )
    return per_row.select(
        F.col("_key").alias(key),
        F.col("_id").alias(row_id),
        F.col("_time").alias(time),
        *((F.col("_now") - F.col(f"_{n}")).alias(n) for n in names),
    )


USAGE_WINDOWS = {"burst_used": config.BURST_SECONDS, "daily_used": config.DAILY_SECONDS}


def usage_snapshot(log: DataFrame, key: str, time: str, now) -> DataFrame:
    """Usage per key at one moment, next to the limits."""
    micros = F.unix_micros(F.col(time).cast("timestamp"))

    def used(seconds: int):
        return F.count_if((micros > F.unix_micros(before(now, seconds))) & (micros <= F.unix_micros(now)))

    return log.groupBy(key).agg(
        used(config.BURST_SECONDS).alias("burst_used"),
        F.lit(config.BURST_MAX).alias("burst_max"),
        used(config.DAILY_SECONDS).alias("daily_used"),
        F.lit(config.DAILY_MAX).alias("daily_max"),
    )
