"""Sharding by minimax contiguous partition of ordered atomic groups."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfcast.llm.common import stage

SHARDS = 8
# Groups are ordered by a 64-bit digest; the driver holds one sum per run of this many top bits.
BUCKET_BITS = 16
FINER_BITS = 8  # by which a bucket in question is split further
LISTED = 1024  # groups of a bucket that are rather listed
NEAR = 4  # buckets about a cut that are split before it is known which of them matter
CELL_ROWS = 2000  # rows numbered together


def greedy(ends: np.ndarray, capacity: int, parts: int) -> list[int] | None:
    """Cuts (numbers of groups before each part after the first) if ``parts`` parts of at most
    ``capacity`` hold all groups, taken in order; else None. ``ends`` are running totals."""
    cuts, at, filled = [], 0, 0
    for _ in range(parts):
        at = int(np.searchsorted(ends, filled + capacity, "right"))
        if at == len(ends):
            return cuts
        if at == 0 or ends[at - 1] == filled:
            return None  # one group alone exceeds the capacity
        filled = int(ends[at - 1])
        cuts.append(at)
    return None


def smallest_capacity(ends: np.ndarray, parts: int, low: int, high: int) -> int:
    """The smallest feasible capacity in (low, high], given that ``high`` is feasible."""
    while high - low > 1:
        middle = (low + high) // 2
        if greedy(ends, middle, parts) is None:
            low = middle
        else:
            high = middle
    return high


def _walk(ends: np.ndarray, single: np.ndarray, capacity: int, parts: int, early: bool) -> tuple[list[int], list[int]]:
    """Bytes before the end of each part, taken greedily, and the buckets that would have to be
    known finer. ``single`` buckets hold one group. Others are cut nowhere (``early``: exact
    cuts come no earlier) or anywhere (else: they come no later)."""
    filled, total, places, unsure = 0, int(ends[-1]), [], []
    for _ in range(parts):
        reach = filled + capacity
        if reach >= total:
            return [*places, total], unsure
        at = int(np.searchsorted(ends, reach, "right"))
        border = int(ends[at - 1]) if at else 0
        if reach > border and not single[at]:
            unsure.append(at)
        filled = max(filled, border) if early or single[at] else reach
        places.append(filled)
    return places, unsure


def _decided(ends: np.ndarray, single: np.ndarray, capacity: int, parts: int) -> bool | None:
    """Whether ``parts`` parts of ``capacity`` hold all groups; None if the buckets do not tell."""
    if _walk(ends, single, capacity, parts, True)[0][-1] == ends[-1]:
        return True
    return None if _walk(ends, single, capacity, parts, False)[0][-1] == ends[-1] else False


def _in_question(ends: np.ndarray, single: np.ndarray, low: int, high: int, parts: int) -> list[int]:
    """Buckets to split: where the cuts for the middle capacity fall, and those about each cut
    for any capacity from low to high, if they are few."""
    wanted = set()
    for early in (True, False):
        wanted.update(_walk(ends, single, (low + high) // 2, parts, early)[1])
    least, most = (_walk(ends, single, c, parts, e)[0] for c, e in ((low, True), (high, False)))
    for x, y in zip([0, *least], [0, *most]):
        first = int(np.searchsorted(ends, x + low, "right"))
        last = int(np.searchsorted(ends, min(y + high, int(ends[-1])), "left"))
        if last - first < NEAR:
            wanted.update(i for i in range(first, min(last, len(ends) - 1) + 1) if not single[i])
    return sorted(wanted)


def _summed(groups: DataFrame, bits: int | None) -> DataFrame:
    """A row per bucket of this many top bits, or per group: what it holds, and its first group."""
    by = [F.shiftright("digest", 64 - bits)] if bits else ["digest", "crc", "size"]
    first = F.min(F.struct("digest", "crc", "size"))
    return groups.groupBy(*by).agg(
        first.alias("first"), F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.max("bytes").alias("most")
    ).select("first.*", F.lit(bits or 64).alias("bits"), "n", "bytes", "most")


def _split(groups: DataFrame, buckets: pd.DataFrame) -> pd.DataFrame:
    """The rows of finer buckets within the given ones; of single groups where those are few."""
    listed = (buckets["n"] <= LISTED) | (buckets["bits"] + FINER_BITS > 64)
    found = None
    for (bits, single), part in buckets.groupby([buckets["bits"], listed]):
        bits = int(bits)
        tops = [int(x) >> (64 - bits) for x in part["digest"]]
        inside = groups.filter(F.shiftright("digest", 64 - bits).isin(tops))
        sums = _summed(inside, None if single else bits + FINER_BITS)
        found = sums if found is None else found.unionAll(sums)
    fetched = found.toPandas()
    bound = np.where(listed, buckets["n"], 1 << FINER_BITS).sum()
    assert len(fetched) <= bound, f"{len(fetched)} rows of {len(buckets)} buckets"
    return fetched


def minimax_cuts(spark: SparkSession, groups: DataFrame, parts: int) -> tuple[int, list[tuple]]:
    """Smallest capacity, and the key (digest, crc, size) that opens each part after the first.

    ``groups``: digest, crc, size, bytes. The driver gets one sum per bucket of digests (65,536
    at most) and searches the capacity. Where the sums do not tell whether a capacity will do,
    the buckets in which its cuts fall are split by more bits of the digest, in the end into
    single groups: a few per part in a round, however many documents and however large a group.
    """
    known = _summed(groups, BUCKET_BITS).toPandas()
    if not len(known):
        return 0, []
    total, most = int(known["bytes"].sum()), int(known["most"].max())
    low = max(-(-total // parts), most) - 1  # sure to fail
    high = -(-total // parts) + most  # sure to do
    while True:
        known = known.sort_values(["digest", "crc", "size"], ignore_index=True)
        ends = np.cumsum(known["bytes"].to_numpy(np.int64))
        single = known["n"].to_numpy() == 1
        # Both bounds move as far as the sums can prove.
        fails, does = (low, high), (low, high)
        while fails[1] - fails[0] > 1:
            middle = sum(fails) // 2
            fails = (middle, fails[1]) if _decided(ends, single, middle, parts) is False else (fails[0], middle)
        while does[1] - does[0] > 1:
            middle = sum(does) // 2
            does = (does[0], middle) if _decided(ends, single, middle, parts) else (middle, does[1])
        low, high = fails[0], does[1]
        if high - low == 1:
            places, _ = _walk(ends, single, high, parts, True)
            if places == _walk(ends, single, high, parts, False)[0]:
                break
        wanted = _in_question(ends, single, low + 1, high, parts)
        known = pd.concat([known.drop(index=wanted), _split(groups, known.iloc[wanted])])
    cuts = np.searchsorted(ends, places[:-1], "right")
    return high, [tuple(int(known[c][at]) for c in ("digest", "crc", "size")) for at in cuts]


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Put documents into shards of nearly equal bytes; equal texts stay together.

    Returns doc_id, size, text_crc32, law (`bytes`), shard, slot, grown_shard (null). Groups
    of equal texts, told apart by a 64-bit digest, crc and size, are ordered by digest, so
    hot sources spread. The largest shard is as small as any contiguous cut allows; a group
    larger than an even share fills one shard. Slots number the rows of a shard from 0 without
    gaps, by cells of about ``CELL_ROWS`` rows dealt by id and digest.

    A null text has size 1 and the crc of an empty one, with which it forms a group. Repeated
    rows get slots of their own. With few groups later shards stay empty; an empty table gives
    an empty result. Texts are read once and never shuffled.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.xxhash64(text)
    rows = stage(spark, docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"), digest.alias("digest")), "shard-rows")
    groups = stage(spark, rows.groupBy("digest", "crc", "size").agg(
        F.sum("size").alias("bytes")), "shard-groups")
    _, cuts = minimax_cuts(spark, groups, shards)
    key = F.struct("digest", "crc", "size")

    def at(cut: tuple) -> Column:
        return F.struct(*[F.lit(x).cast("long").alias(n) for x, n in zip(cut, ("digest", "crc", "size"))])

    shard = sum(((key >= at(cut)).cast("int") for cut in cuts), F.lit(0))
    dealt = rows.withColumn("shard", shard)
    counts = {r["shard"]: r["count"] for r in dealt.groupBy("shard").count().collect()}
    cells = F.lit(1)
    for number, count in counts.items():
        cells = F.when(F.col("shard") == number, -(-count // CELL_ROWS)).otherwise(cells)
    dealt = dealt.withColumn("cell", F.pmod(F.xxhash64("doc_id", "digest"), cells.cast("long")))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("shard").alias("s"), F.col("cell").alias("c"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "cell").orderBy("doc_id", "digest", "crc")
    return (
        dealt.withColumn("place", F.row_number().over(within) - 1)
        .join(starts, (F.col("shard") == F.col("s")) & (F.col("cell") == F.col("c")))
        .select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
                (F.col("start") + F.col("place")).cast("long").alias("slot"),
                F.lit(None).cast("int").alias("grown_shard"))
    )
