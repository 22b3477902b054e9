"""JSON documents of any size: one array or one object, cut into its elements by many tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.sources.tables import _guard, stage

# Files are read as text in pieces that end with a closing brace; every split of a file can be
# read alone, and a piece never ends within an escape.
_END = b"}"
_CHUNK = 16 << 20

_WHOLE, _HEAD, _TAIL, _MIDDLE = range(4)
_PIN = "spark.sql.files.minPartitionNum"


def _lookup(codes: str, value: int, table: np.ndarray) -> None:
    for c in codes:
        table[ord(c)] = value


_STEP = np.zeros(256, np.int8)
_lookup("[{", 1, _STEP)
_lookup("]}", -1, _STEP)


def _quoted(data: np.ndarray, inside: bool) -> np.ndarray:
    """Which bytes stand in a string, its opening quote included, given the state before."""
    quotes = np.flatnonzero(data == ord('"'))
    slashes = data == ord("\\")
    if slashes.any():
        # A quote is escaped after an odd run of backslashes.
        plain = np.where(slashes, -1, np.arange(len(data)))
        last = np.maximum.accumulate(plain)  # last byte that is no backslash
        before = np.concatenate(([-1], last))[quotes]
        quotes = quotes[(quotes - 1 - before) % 2 == 0]
    turns = np.zeros(len(data) + 1, np.int8)
    turns[quotes] = 1
    return (np.cumsum(turns[:-1]) + int(inside)) % 2 == 1


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bytes]]:
    """The bytes of each split in order, some at a time."""
    split, held, size = None, [], 0
    for batch in batches:
        for path, start, piece in zip(*(batch.column(n).to_pylist() for n in ("path", "start", "value"))):
            if (path, start) != split or size > _CHUNK:
                if held:
                    yield split, b"".join(held)
                split, held, size = (path, start), [], 0
            held += (piece, _END)
            size += len(piece) + 1
    if held:
        yield split, b"".join(held)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: whether it turns the string state, and the change of depth for a split that
    begins outside a string and for one that begins inside."""
    found: dict[tuple[str, int], list[int]] = {}
    for split, chunk in _chunks(batches):
        turned, outside, inside = found.setdefault(split, [0, 0, 0])
        data = np.frombuffer(chunk, np.uint8)
        step, quoted = _STEP[data].astype(np.int64), _quoted(data, bool(turned))
        last = bool(quoted[-1])  # the last byte is a brace
        found[split] = [int(last), outside + int(step[~quoted].sum()), inside + int(step[quoted].sum())]
    rows = [(*split, *values) for split, values in found.items()]
    columns = list(zip(*rows)) if rows else [()] * 5
    yield pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])],
        ["path", "start", "turned", "outside", "inside"])


def _starts(summaries: list) -> dict[tuple[str, int], tuple[bool, int]]:
    """String state and depth at the start of each split, from those before it in its file."""
    states, at = {}, None
    for row in sorted(summaries, key=lambda r: (r["path"], r["start"])):
        if at is None or at[0] != row["path"]:
            at = (row["path"], False, 0)
        _, quoted, depth = at
        states[row["path"], row["start"]] = (quoted, depth)
        at = (row["path"], quoted != bool(row["turned"]), depth + row["inside" if quoted else "outside"])
    return states


class _Cutter:
    """Cuts the chunks of one split at commas of depth one and at the outer brackets."""

    def __init__(self, quoted: bool, depth: int):
        self.quoted, self.depth = quoted, depth
        self.open = [] if depth >= 1 else None  # bytes of the element that is open
        self.cut = False  # a border has been seen

    def _close(self) -> tuple[int, bytes]:
        kind = _WHOLE if self.cut else _HEAD
        self.cut = True
        return kind, b"".join(self.open)

    def feed(self, chunk: bytes) -> Iterator[tuple[int, bytes]]:
        if self.depth < 0 or (self.depth == 0 and self.cut):
            return  # after the document
        data = np.frombuffer(chunk, np.uint8)
        quoted = _quoted(data, self.quoted)
        step = np.where(quoted, 0, _STEP[data]).astype(np.int64)
        depth = self.depth + np.cumsum(step)
        outer = (step == 1) & (depth == 1) | (step == -1) & (depth == 0)
        borders = np.flatnonzero(outer | ((data == ord(",")) & (depth == 1) & ~quoted))
        begin = 0
        for border in borders.tolist():
            if self.open is None:  # the bracket that opens the document
                self.open, self.cut = [], True
            else:
                self.open.append(chunk[begin:border])
                yield self._close()
                self.open = []
            begin = border + 1
            if step[border] == -1:
                self.open, self.quoted, self.depth = None, False, -1
                return
        if self.open is not None:
            self.open.append(chunk[begin:])
        self.quoted, self.depth = bool(quoted[-1]), int(depth[-1])

    def rest(self) -> Iterator[tuple[int, bytes]]:
        if self.open is not None:
            yield (_TAIL if self.cut else _MIDDLE), b"".join(self.open)


def _cut(states: dict):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(split: tuple[str, int], found: Iterator[tuple[int, bytes]]) -> pa.RecordBatch:
            kinds, texts = zip(*found) if (found := list(found)) else ((), ())
            return pa.RecordBatch.from_pydict({
                "path": pa.array([split[0]] * len(kinds), pa.string()),
                "start": pa.array([split[1]] * len(kinds), pa.int64()),
                "part": pa.array(kinds, pa.int32()), "bytes": pa.array(texts, pa.binary())})

        split, cutter = None, None
        for now, chunk in _chunks(batches):
            if now != split:
                if cutter:
                    yield rows(split, cutter.rest())
                split, cutter = now, _Cutter(*states[now])
            yield rows(split, cutter.feed(chunk))
        if cutter:
            yield rows(split, cutter.rest())

    return cut


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """The elements of JSON documents: path and ``element``, the text of one array element or of
    one ``"key": value`` entry.

    Each file holds one array or one object. Two passes: the first tells for every split how it
    changes string state and depth, for both states it may begin in; the driver chains these,
    three numbers a split. In the second pass every split cuts its elements at depth one.
    Elements that reach over a border of splits leave a part in each, and these parts, two a
    split at most, are put together. So a document is read by as many tasks as it has splits,
    and no element passes through another task than its own.

    A blank element (an empty array or object) gives no row. The order of elements is not kept.
    """
    if spark.conf.get(_PIN, None) is None:  # both passes must see the same splits
        spark.conf.set(_PIN, str(spark.sparkContext.defaultParallelism))
    raw = spark.read.option("lineSep", _END.decode()).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("value"))
    summaries = raw.mapInArrow(_summaries, "path string, start long, turned long, outside long, inside long")
    states = _starts(summaries.collect())
    cut = stage(raw.mapInArrow(_cut(states), "path string, start long, part int, bytes binary"), "elements")
    # A tail opens an element; heads and middles belong to the one opened before their own split.
    order = Window.partitionBy("path").orderBy("start", "part").rowsBetween(Window.unboundedPreceding, -1)
    tail = F.when(F.col("part") == _TAIL, F.col("start"))
    owner = F.coalesce(tail, F.last(tail, ignorenulls=True).over(order), F.lit(-1))
    parts = cut.where(F.col("part") != _WHOLE).withColumn("owner", owner)
    pieces = F.array_sort(F.collect_list(F.struct("start", F.hex("bytes").alias("hex"))))
    joined = parts.groupBy("path", "owner").agg(F.array_join(F.transform(pieces, lambda p: p["hex"]), "").alias("hex"))
    whole = F.unhex("hex")
    every = cut.where(F.col("part") == _WHOLE).select("path", "bytes").unionByName(
        joined.select("path", whole.alias("bytes")))
    element = F.trim(F.regexp_replace(F.col("bytes").cast("string"), "^[\\s\\x{FEFF}]+|\\s+$", ""))
    return every.select("path", element.alias("element")).where("element <> ''")


def read_json_array(spark: SparkSession, path: str, schema, name: str) -> DataFrame:
    """Files that hold one JSON array of records each, whatever their size."""
    elements = _guard(lambda: read_elements(spark, path), name, path)
    return elements.select(F.from_json("element", schema).alias("_r")).select("_r.*")


def read_json_map(
    spark: SparkSession, path: str, value_schema: str, name: str, key: str = "item_id"
) -> DataFrame:
    """Files that hold one JSON object ``{key: {fields}}`` each, as one row per key."""
    elements = _guard(lambda: read_elements(spark, path), name, path)
    entry = F.concat(F.lit("{"), F.col("element"), F.lit("}"))
    entries = F.from_json(entry, f"map<string,struct<{value_schema}>>")
    return elements.select(F.explode(entries).alias(key, "_fields")).select(key, "_fields.*")


def _write_documents(texts: DataFrame, path: str, documents: int, brackets: str) -> None:
    """``texts(element)`` as that many files, each one document."""
    dealt = texts.groupBy(F.pmod(F.xxhash64("element"), F.lit(documents)).alias("document")).agg(
        F.concat(F.lit(brackets[0]), F.array_join(F.collect_list("element"), ",\n"), F.lit(brackets[1])).alias("value"))
    dealt.write.mode("overwrite").partitionBy("document").text(path)


def write_json_arrays(df: DataFrame, path: str, documents: int = 1) -> None:
    """Rows as JSON arrays. A document is built in one task: take more of them for more rows."""
    _write_documents(df.select(F.to_json(F.struct("*")).alias("element")), path, documents, "[]")


def write_json_maps(df: DataFrame, path: str, key: str, documents: int = 1) -> None:
    """Rows as JSON objects ``{key: {fields}}``; keys are unique within ``df``."""
    entry = F.to_json(F.map_from_arrays(
        F.array(F.col(key).cast("string")), F.array(F.struct(*[c for c in df.columns if c != key]))))
    inner = F.substr(entry, F.lit(2), F.length(entry) - 2)
    _write_documents(df.select(inner.alias("element")), path, documents, "{}")
