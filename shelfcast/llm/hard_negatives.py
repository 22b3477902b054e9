"""Hard-negative mining: pair scores sorted by (anchor, falling score, id) in the shuffle and read as a stream."""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm.common import stage
from shelfcast.session import scratch_path

BLOCK_MB = 64  # anchors that are broadcast at a time
TASK_ROWS = 1 << 16  # vectors a scoring task takes
TILE = 1024  # anchors scored together
STRIP = 4096  # vectors that meet a tile
EXACT = 2.0**53  # sums of float64 products stay whole numbers below this
_LIMIT = 2**63

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


class Anchors(NamedTuple):
    """One block of anchors of equal length, numbered by their place."""

    ids: np.ndarray
    labels: np.ndarray
    matrix: np.ndarray


class Best:
    """The k best (score, id) of each row: highest score first, then the smallest id."""

    def __init__(self, rows: int, k: int):
        self.k = k
        self.row, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(rows, -_LIMIT, np.int64)  # k-th best so far

    def add(self, wanted: np.ndarray, scores: np.ndarray, ids: np.ndarray, first_row: int) -> None:
        rows, columns = np.nonzero(wanted)
        if not len(rows):
            return
        row = np.concatenate((self.row, rows + first_row))
        score = np.concatenate((self.score, scores[rows, columns]))
        id_ = np.concatenate((self.id, ids[columns]))
        order = np.lexsort((id_, ~score, row))  # ~ turns the order without overflow
        row, score, id_ = row[order], score[order], id_[order]
        starts = np.searchsorted(row, row, "left")
        place = np.arange(len(row)) - starts
        keep = place < self.k
        last = place == self.k - 1
        self.floor[row[last]] = score[last]
        self.row, self.score, self.id = row[keep], score[keep], id_[keep]


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows; whole-number arithmetic where doubles may round."""
    most = np.abs(left.astype(float)).max(initial=0) * np.abs(right.astype(float)).max(initial=0) * left.shape[1]
    if most < EXACT:
        return (left.astype(float) @ right.astype(float).T).astype(np.int64)
    wide = left.astype(object) @ right.astype(object).T
    return np.array([[max(1 - _LIMIT, min(_LIMIT - 1, int(x))) for x in row] for row in wide], np.int64).reshape(
        len(left), len(right))


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """ids, labels and matrix of the rows of each length."""
    parts = batch.column("parts")
    lengths = parts.value_lengths().to_numpy(zero_copy_only=False)
    for dims in np.unique(lengths):
        of = batch.filter(pa.array(lengths == dims))
        flat = of.column("parts").flatten().to_numpy(zero_copy_only=False)
        yield (of.column("vec_id").to_numpy(), of.column("label").to_numpy(),
               flat.reshape(of.num_rows, int(dims)).astype(np.int64))


def _tiles(batches: Iterable[pa.RecordBatch], anchors: dict[int, Anchors]):
    """Scores of all vectors against the anchors of their length, tile by tile. The first strips
    are narrow, so that the floors rise before the wide ones come."""
    width = 128
    for batch in batches:
        for ids, labels, matrix in _vectors(batch):
            block = anchors.get(matrix.shape[1])
            if block is None:
                continue
            begin = 0
            while begin < len(ids):
                strip = slice(begin, begin + width)
                begin, width = begin + width, min(2 * width, STRIP)
                for first in range(0, len(block.ids), TILE):
                    tile = slice(first, first + TILE)
                    scores = _products(block.matrix[tile], matrix[strip])
                    same = block.labels[tile, None] == labels[None, strip]
                    other = block.ids[tile, None] != ids[None, strip]
                    yield matrix.shape[1], tile, scores, same, other, ids[strip]


# A key sorts as bytes: dims and number of the anchor, falling score, positives before negatives
# of the same score, rising id.
_KEY = ">IQQBQ"


def _pack(dims: int, anchor: int, score: int, kind: int, vec_id: int) -> bytes:
    return struct.pack(_KEY, dims, anchor, _LIMIT - 1 - score, kind, vec_id + _LIMIT)


def _unpack(key: bytes) -> tuple[tuple[int, int], int, int, int]:
    dims, anchor, falling, kind, vec_id = struct.unpack(_KEY, key)
    return (dims, anchor), _LIMIT - 1 - falling, kind, vec_id - _LIMIT


def _keys(best: dict[int, Best], kind: int) -> list[bytes]:
    return [_pack(dims, int(r), int(s), kind, int(i))
            for dims, of in best.items() for r, s, i in zip(of.row, of.score, of.id)]


def _positives(shared: Broadcast, k: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: dict[int, Anchors] = shared.value
        best = {dims: Best(len(block.ids), k) for dims, block in anchors.items()}
        for dims, tile, scores, same, other, ids in _tiles(batches, anchors):
            high = scores >= best[dims].floor[tile, None]
            best[dims].add(same & other & high, scores, ids, tile.start)
        yield pa.RecordBatch.from_arrays([pa.array(_keys(best, 0), pa.binary())], ["key"])

    return scan


def _negatives(shared: Broadcast, windows: Broadcast, k: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: dict[int, Anchors] = shared.value
        best = {(dims, n): Best(len(low[0]), k) for dims, (low, _) in windows.value.items() for n in range(len(low))}
        for dims, tile, scores, same, _, ids in _tiles(batches, anchors):
            low, high = windows.value[dims]
            for n in range(len(low)):
                one = best[dims, n]
                least = np.maximum(low[n, tile], one.floor[tile])[:, None]
                one.add(~same & (scores >= least) & (scores <= high[n, tile, None]), scores, ids, tile.start)
        found: set[bytes] = set()  # a row in several windows is sent once
        for (dims, _), of in best.items():
            found.update(_keys({dims: of}, 1))
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.binary())], ["key"])

    return scan


def _sorted_stream(keys: DataFrame, partitions: int) -> RDD:
    """Keys by anchor, sorted within the shuffle; an anchor is in one partition."""
    def place(key: bytes) -> int:
        return int.from_bytes(key[:12], "big") * 0x9E3779B97F4A7C15 % 2**64 >> 32

    return keys.rdd.map(lambda row: (bytes(row[0]), None)).repartitionAndSortWithinPartitions(
        partitions, lambda key: place(key) % partitions).keys()


def _first(k: int):
    """The first k keys of each anchor."""
    def first(keys: Iterator[bytes]) -> Iterator[tuple[bytes]]:
        last, seen = None, 0
        for key in keys:
            seen = seen + 1 if key[:12] == last else 1
            last = key[:12]
            if seen <= k:
                yield (key,)

    return first


def _window(score: int, low: int, high: int) -> tuple[int, int]:
    """Scores from ``low`` to ``high`` percent of a positive's."""
    return -(-low * score // 100), high * score // 100


def _emit(shared: Broadcast, k: int, low: int, high: int):
    """Reads an anchor's positives and negatives by falling score. A positive opens a window, a
    negative goes to every open window that holds its score. No more is kept than the windows."""
    def emit(keys: Iterator[bytes]) -> Iterator[tuple]:
        anchors: dict[int, Anchors] = shared.value
        last, windows = None, []
        for key in keys:
            anchor, score, kind, vec_id = _unpack(key)
            if anchor != last:
                last, windows = anchor, []
            if kind == 0:
                windows.append([*_window(score, low, high), score, vec_id, 0])
                continue
            for window in windows:
                if window[0] <= score <= window[1] and window[4] < k:
                    window[4] += 1
                    yield int(anchors[anchor[0]].ids[anchor[1]]), window[3], window[4], vec_id, window[2], score

    return emit


def _block(rows: list) -> dict[int, Anchors]:
    lengths = np.array([len(r["parts"]) for r in rows])
    return {
        int(dims): Anchors(*(np.array([r[c] for r, n in zip(rows, lengths) if n == dims], np.int64)
                             for c in ("vec_id", "label", "parts")))
        for dims in np.unique(lengths)
    }


def _windows_of(keys: list, anchors: dict[int, Anchors], k: int, low: int, high: int) -> dict:
    """Per length: bounds of the windows, an array (positive, anchor); empty where one is missing."""
    bounds = {d: (np.full((k, len(a.ids)), _LIMIT - 1, np.int64), np.full((k, len(a.ids)), -_LIMIT, np.int64))
              for d, a in anchors.items()}
    place: dict[tuple[int, int], int] = {}
    for row in keys:
        (dims, anchor), score, _, _ = _unpack(bytes(row[0]))
        n = place[dims, anchor] = place.get((dims, anchor), -1) + 1
        least, most = _window(score, low, high)
        if least <= most:
            bounds[dims][0][n, anchor], bounds[dims][1][n, anchor] = least, most
    return bounds


def mine(spark: SparkSession, rows: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         block_mb: int = BLOCK_MB) -> DataFrame:
    """Hard negatives of every anchor and positive.

    ``rows``: vec_id long, label long, parts array<long>, anchor boolean; none null. A score is
    the integer inner product with the anchor, higher first, ties by smaller vec_id. Positives
    are the anchor's first ``positives`` other rows of its label; each gets its first
    ``negatives`` rows of other labels with a score from ``low`` to ``high`` percent of its own.
    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are broadcast in blocks of ``block_mb`` at most, and each block scans all rows
    twice: first for the positives, then for the negatives of the windows they open. A task
    keeps the best of its rows per anchor and window, and only these are packed into keys and
    shuffled; no pair that cannot be returned by its task leaves it. The final stream is sorted
    in the shuffle, so no anchor is gathered. Work is anchors times rows, the stated search.

    Equal rows count once. Rows of one vec_id with other vectors or labels count each, but never
    against an anchor of the same id as its positive; as anchors they share an id in the result. Only
    rows with as many components as the anchor compete. A negative positive score has no
    window. Scores are cut to 64 bits. Empty tables, or no anchors, give an empty result. Extra
    columns play no part.
    """
    rows = rows.select("vec_id", "label", "parts", "anchor").distinct()
    rows = stage(spark, rows, "labelled")
    total, anchors, widest = rows.agg(
        F.count("*"), F.count_if("anchor"), F.coalesce(F.max(F.when(F.col("anchor"), F.size("parts"))), F.lit(0))).first()
    if not anchors:
        return spark.createDataFrame([], RESULT)
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_ROWS))
    rows = stage(spark, rows.repartition(tasks, F.xxhash64("vec_id", "label", "parts")), "dealt")
    scanned = rows.select("vec_id", "label", "parts").coalesce(tasks)
    blocks = -(-anchors * (8 * widest + 16) // (block_mb << 20))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = F.pmod(F.xxhash64("parts", "vec_id", "label"), F.lit(blocks))
    results = []
    for n in range(blocks):
        block = _block(rows.filter("anchor").filter(number == n).select("vec_id", "label", "parts").collect())
        if not block:
            continue
        shared = spark.sparkContext.broadcast(block)
        partial = scanned.mapInArrow(_positives(shared, positives), "key binary")
        first = stage(spark, _sorted_stream(partial, partitions).mapPartitions(_first(positives)).toDF("key binary"), "positives")
        windows = spark.sparkContext.broadcast(_windows_of(first.collect(), block, positives, low, high))
        found = scanned.mapInArrow(_negatives(shared, windows, negatives), "key binary")
        stream = _sorted_stream(first.unionAll(found), partitions)
        path = scratch_path(spark, "negatives")
        stream.mapPartitions(_emit(shared, negatives, low, high)).toDF(RESULT).write.parquet(path)
        results.append(path)
        shared.unpersist()
        windows.unpersist()
    return spark.read.schema(RESULT).parquet(*results)
