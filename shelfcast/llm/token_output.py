"""Token ids in training order: fixed-stride binary shards filled through a keyed permutation."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import zlib
import zstandard
from pyarrow.fs import FileSystem
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm.common import mixed, runs, small_batches, stage, text_bytes
from shelfcast.llm.token_count import VOCABULARY, read_pieces

LENGTH = 2048  # tokens of a sequence
SHARD_SLOTS = 4096
PATTERN = r" ?[^\s]+|\s+"
KEY = 6
ROUNDS = 6
BATCH_BYTES = 8 << 20
ID = np.dtype("<u2")
_U = np.uint64


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """Place of each number below ``size`` under a keyed permutation of all of them.

    A balanced Feistel network permutes the smallest power of four that holds ``size``; results
    beyond it walk on along their cycle until they fall inside.
    """
    bits = _U(max(1, -(-(max(size, 2) - 1).bit_length() // 2)))
    mask = (_U(1) << bits) - _U(1)
    keys = mixed(np.arange(ROUNDS, dtype=np.uint64) + _U((key * 0x9E3779B97F4A7C15) & (2**64 - 1)))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> bits, x & mask
        for k in keys:
            left, right = right, left ^ (mixed(right + k) & mask)
        return left << bits | right

    out = once(index.astype(np.uint64))
    while (beyond := out >= _U(size)).any():
        out[beyond] = once(out[beyond])
    return out.astype(np.int64)


def encoding(pieces: list[bytes]) -> tiktoken.Encoding:
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={p: i for i, p in enumerate(pieces)}, special_tokens={})


def _sequences(shared: Broadcast, length: int) -> Callable:
    """Texts of a task end to end, each closed by the end token, cut into sequences."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        encode, end = encoding(pieces), len(pieces)
        part, place = TaskContext.get().partitionId(), 0
        held, owners, filled = [], [], 0

        def row(ids: np.ndarray, docs: list) -> tuple:
            nonlocal place
            full = np.full(length, end, ID)
            full[: len(ids)] = ids
            place += 1
            return part, place - 1, len(ids), list(dict.fromkeys(docs)), zlib.crc32(full.tobytes()), full.tobytes()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = (pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                ["part", "place", "n_tokens", "doc_ids", "crc", "ids"])

        for batch in small_batches(batches, "bytes", BATCH_BYTES):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("bytes").to_pylist()):
                ids = np.array([*encode.encode_ordinary(text.decode("utf-8", "replace")), end], ID)
                at = 0
                while at < len(ids):
                    some = ids[at : at + length - filled]
                    held.append(some)
                    owners.append(doc)
                    filled += len(some)
                    at += len(some)
                    if filled == length:
                        rows.append(row(np.concatenate(held), owners))
                        held, owners, filled = [], [], 0
            if rows:
                yield batch_of(rows)
        if held:
            yield batch_of([row(np.concatenate(held), owners)])

    return cut


BUNDLE = "shard int, slots array<bigint>, n_tokens array<int>, doc_ids array<array<bigint>>, crcs array<bigint>, packed binary"


def _bundle(size: int, key: int, shard_slots: int) -> Callable:
    """Sequences of a batch by shard, with their slots; those of a shard compressed together."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            slots = permuted(batch.column("number").to_numpy(), size, key)
            order = np.argsort(slots, kind="stable")
            cuts = runs(slots[order] // shard_slots)
            n_tokens, docs, crcs, ids = (batch.column(c).to_pylist() for c in ("n_tokens", "doc_ids", "crc", "ids"))
            rows = []
            for x, y in zip(cuts[:-1], cuts[1:]):
                of = order[x:y].tolist()
                packed = zstandard.ZstdCompressor(level=3).compress(b"".join(ids[i] for i in of))
                rows.append((int(slots[of[0]] // shard_slots), slots[of].tolist(), [n_tokens[i] for i in of],
                             [[d for d in docs[i] if d is not None] for i in of], [crcs[i] for i in of], packed))
            long = pa.int64()
            types = (pa.int32(), pa.list_(long), pa.list_(pa.int32()), pa.list_(pa.list_(long)), pa.list_(long), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                ["shard", "slots", "n_tokens", "doc_ids", "crcs", "packed"])

    return bundle


def _write(folder: str, length: int, shard_slots: int) -> Callable:
    """Gather the bundles of a shard (bounded by the size of its file) and write it. The file
    appears under its name when complete, so a task that is run again replaces it by the same."""
    stride = length * ID.itemsize

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        attempt = TaskContext.get().taskAttemptId()

        def flush(shard: int, rows: list[tuple]) -> pa.RecordBatch:
            rows.sort()
            draft = f"{base}/_draft-{shard:06d}-{attempt}"
            with fs.open_output_stream(draft) as out:
                for *_, ids in rows:
                    out.write(ids)
            fs.move(draft, f"{base}/shard-{shard:06d}.bin")
            slots, n_tokens, docs, crcs, _ = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(slots, pa.int64()), pa.array([shard] * len(rows), pa.int32()), pa.array(n_tokens, pa.int32()),
                 pa.array(docs, pa.list_(pa.int64())), pa.array(crcs, pa.int64()),
                 pa.array([s % shard_slots * stride for s in slots], pa.int64())],
                ["slot", "shard", "n_tokens", "doc_ids", "crc", "offset"])

        now, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != now and held:
                    yield flush(now, held)
                    held = []
                now = row["shard"]
                data = zstandard.ZstdDecompressor().decompress(row["packed"])
                held.extend(
                    (s, n, d, c, data[i * stride : (i + 1) * stride]) for i, (s, n, d, c) in
                    enumerate(zip(row["slots"], row["n_tokens"], row["doc_ids"], row["crcs"])))
        if held:
            yield flush(now, held)

    return write


def write_training_order(spark: SparkSession, docs: DataFrame, folder: str, *, vocabulary: str = VOCABULARY,
                         length: int = LENGTH, shard_slots: int = SHARD_SLOTS, key: int = KEY) -> DataFrame:
    """Write the token ids of whole texts to ``folder`` in training order.

    Returns a row per sequence: slot, shard, n_tokens (without padding), doc_ids, crc (crc32 of
    the bytes), offset (in the shard's file). File ``shard-NNNNNN.bin`` holds ``shard_slots``
    sequences of ``length`` 16-bit little-endian ids, so slot s starts at byte
    s mod ``shard_slots`` * ``length`` * 2 of shard s div ``shard_slots``, and a reader can
    resume anywhere (:func:`read_slots`). The files are written when the result is computed.

    Each task lays its texts end to end, closed by the end token (the first id after the
    vocabulary), and cuts them; its last sequence is padded with end tokens. The sequences are
    staged with their task and place in it. Only the tasks' counts reach the driver; their
    running sum numbers all sequences, and a keyed Feistel permutation maps numbers to slots.
    Sequences shuffle once, by shard, compressed. Every file is written whole by one task and then renamed.

    A null or empty text is one end token; null ids are left out of doc_ids. Repeated rows are
    written each. An empty table gives no files and an empty result.
    """
    shared = spark.sparkContext.broadcast(read_pieces(vocabulary))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(F.col("text")).alias("bytes"))
    staged = stage(spark, read.mapInArrow(
        _sequences(shared, length),
        "part int, place long, n_tokens int, doc_ids array<bigint>, crc long, ids binary"), "sequences")
    counts = {r["part"]: r["count"] for r in staged.groupBy("part").count().collect()}
    firsts, size = [], 0
    for part in sorted(counts):
        firsts.append((part, size))
        size += counts[part]
    starts = F.broadcast(spark.createDataFrame(firsts, "p int, first long"))  # a row per task

    placed = staged.join(starts, F.col("part") == F.col("p")).select(
        (F.col("first") + F.col("place")).alias("number"), "n_tokens", "doc_ids", "crc", "ids")
    shards = max(1, -(-size // shard_slots))
    return (
        placed.mapInArrow(_bundle(size, key, shard_slots), BUNDLE).repartition(shards, "shard")
        .sortWithinPartitions("shard").mapInArrow(
            _write(folder, length, shard_slots),
            "slot long, shard int, n_tokens int, doc_ids array<bigint>, crc long, offset long")
    )


def read_slots(folder: str, first: int, count: int, length: int = LENGTH, shard_slots: int = SHARD_SLOTS) -> np.ndarray:
    """Token ids of ``count`` slots from ``first`` on, by sequential reads at computed places."""
    fs, base = FileSystem.from_uri(folder)
    stride, rows = length * ID.itemsize, []
    while count > 0:
        shard, at = divmod(first, shard_slots)
        n = min(count, shard_slots - at)
        with fs.open_input_file(f"{base}/shard-{shard:06d}.bin") as file:
            rows.append(np.frombuffer(file.read_at(n * stride, at * stride), ID).reshape(n, length))
        first, count = first + n, count - n
    return np.concatenate(rows) if rows else np.zeros((0, length), ID)
