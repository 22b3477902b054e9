"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.session import scratch_path

# A word is a run of anything but ASCII white space (fixed by the contracts).
WORD = "[^\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

KEYS_A_WORD = 4  # keys that share 64 bits of a filter
FILTER_WORDS = 1 << 20  # of a filter at most; with more keys more rows pass
FILTER_PROBES = 6


# Paths staged while a recording is open, innermost last.
_RECORDINGS: list[list[str]] = []


@contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """Note the tables staged meanwhile, so that :func:`release` can remove them later."""
    _RECORDINGS.append(paths)
    try:
        yield
    finally:
        _RECORDINGS.pop()


def release(spark: SparkSession, paths: list[str], docs: DataFrame) -> None:
    """Remove recorded tables that ``docs`` does not read from. Others stay recorded.

    Spark removes shuffle files of plans nobody holds once the driver's garbage is collected,
    which a driver with little to do may put off for half an hour; so it is collected here."""
    files = docs.inputFiles()
    kept = []
    for path in paths:
        if any(f"/{path.rsplit('/', 1)[1]}/" in file for file in files):
            kept.append(path)
            continue
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    paths[:] = kept
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fresh_names(docs: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``docs`` has, in any letter case."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts its lineage.

    The files survive lost executors, and every reader sees the same rows.
    """
    path = scratch_path(spark, name)
    if _RECORDINGS:
        _RECORDINGS[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def maybe_among(rows: DataFrame, key: Column, keys: DataFrame, flag: str) -> DataFrame:
    """``rows`` with a boolean ``flag`` that is true wherever ``key`` (a 64-bit hash) is among
    ``keys`` (a table of one column, key), and by chance, seldom, elsewhere.

    A Bloom filter of one word a key, broadcast as rows of words: so only rows that may have a
    partner need be shuffled for a join. It is bounded; more keys only let more rows pass.
    """
    words = max(1, min(FILTER_WORDS, -(-keys.count() // KEYS_A_WORD)))

    def place(h: Column) -> Column:
        return F.pmod(h, F.lit(words))

    def mask(h: Column) -> Column:
        bits = F.xxhash64(h)
        places = [F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(FILTER_PROBES)]
        return reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("long"), x) for x in places])

    own, word, bits = fresh_names(rows, "own", "word", "bits")
    held = keys.groupBy(place(F.col("key")).alias(word)).agg(F.bit_or(mask(F.col("key"))).alias(bits))
    met = rows.withColumn(own, key).join(F.broadcast(held), place(F.col(own)) == F.col(word), "left")
    hit = F.col(bits).bitwiseAND(mask(F.col(own))) == mask(F.col(own))
    return met.withColumn(flag, F.coalesce(hit, F.lit(False))).drop(own, word, bits)


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text; a null text has none."""
    return F.coalesce(text.cast("binary"), F.lit(b""))


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of an id as text; a null id counts as remainder 0 of everything."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0))


def byte_words(text: bytes) -> list[bytes]:
    """Words with A-Z in lower case. ``bytes`` methods touch ASCII letters and ASCII white
    space only, which is the contract's rule."""
    return text.lower().split()


class Vocabulary(dict):
    """Dense numbers of the distinct words seen, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        number = len(self)
        self[word] = number
        return number

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, by its number."""
        digest = xxhash.xxh3_64_intdigest
        return np.fromiter((digest(w) for w in self), np.uint64, len(self))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def small_batches(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows whose texts hold about ``most`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data = batch.column(batch.schema.get_field_index(column))
        offsets = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data) + 1]
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + most, "right"))
            end = min(max(end - 1, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def runs(keys: np.ndarray) -> np.ndarray:
    """Borders of the runs of equal neighbours, with 0 and the length."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


def components(spark: SparkSession, links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Connected components of ``links`` (a, b: long): one row (node, root) per linked node.

    ``root`` is the smallest node reachable. Distributed union-find by alternating stars: a
    large star hangs every larger neighbour of a node on its smallest neighbour, a small star
    does so for the smaller ones. Labels reach a star after a number of rounds logarithmic in
    the longest path. Each round is a grouped minimum, combined before its shuffle, and a join
    that AQE splits where a node is hot; its links are written to the shared folder. No links
    reach the driver, only their number and checksum. An empty table gives an empty table.
    """

    def least(pairs: DataFrame, node: str, other: str) -> DataFrame:
        # Written out, so that the join has a plain exchange on both sides, which AQE can split.
        lowest = F.least(F.min(other), F.first(node)).alias("m")
        return stage(spark, pairs.groupBy(F.col(node).alias("u")).agg(lowest), "least")

    def large(e: DataFrame) -> DataFrame:
        pairs = e.select(F.col("a").alias("x"), F.col("b").alias("v")).unionAll(
            e.select(F.col("b").alias("x"), F.col("a").alias("v")))
        joined = pairs.join(least(pairs, "x", "v"), F.col("x") == F.col("u"))
        return joined.filter("v > x").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()

    def small(e: DataFrame) -> DataFrame:
        lowest = least(e, "a", "b")
        lower = e.join(lowest, F.col("a") == F.col("u")).filter("b <> m")
        return (
            lower.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(lowest.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .distinct()
        )

    edges = links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    edges = stage(spark, edges, "links")
    before = None
    for _ in range(most_rounds):
        edges = stage(spark, small(stage(spark, large(edges), "links")), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before is not None and tuple(now) == before:
            break
        before = tuple(now)
    else:
        raise RuntimeError("the components did not settle")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
