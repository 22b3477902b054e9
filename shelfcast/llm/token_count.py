"""Token counts by a linear longest-match automaton."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm.common import Vocabulary, small_batches, text_bytes

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
BATCH_BYTES = 16 << 20
REMEMBERED = 1 << 18  # word lengths a worker keeps at most


class LongestMatch:
    """Greedy longest-match piece counts in time linear in the word.

    Two tries share one table of nodes: pieces that open a word, and pieces that continue it.
    Where a node has no child for the next byte, its failure link leads to the node that spells
    what is left after the pieces that greedy matching is then sure to take. Only their number
    is stored, so a word's pieces are counted without being built.
    """

    def __init__(self, opening: Iterable[bytes], continuing: Iterable[bytes]):
        self.child: list[dict[int, int]] = [{}, {}]
        ends = [False, False]
        for root, pieces in ((0, opening), (1, continuing)):
            for piece in pieces:
                at = root
                for byte in piece:
                    if byte not in self.child[at]:
                        self.child[at][byte] = len(self.child)
                        self.child.append({})
                        ends.append(False)
                    at = self.child[at][byte]
                if at > 1:
                    ends[at] = True
        self.fail = [-1] * len(self.child)
        self.popped = [0] * len(self.child)
        level = [0, 1]
        while level:
            deeper = []
            for node in level:
                for byte, below in self.child[node].items():
                    deeper.append(below)
                    if ends[below]:
                        self.fail[below], self.popped[below] = 1, 1
                        continue
                    at, count = self.fail[node], self.popped[node]
                    while at >= 0 and byte not in self.child[at]:
                        count += self.popped[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[below], self.popped[below] = self.child[at][byte], count
            level = deeper

    def length(self, word: bytes) -> int:
        """Number of pieces; 0 if the word cannot be built from them (or is empty)."""
        child, fail, popped = self.child, self.fail, self.popped
        at = count = 0
        for byte in word:
            while byte not in child[at]:
                count += popped[at]
                at = fail[at]
                if at < 0:
                    return 0
            at = child[at][byte]
        while at > 1:
            count += popped[at]
            at = fail[at]
            if at < 0:
                return 0
        return count if at == 1 else 0


def read_pieces(path: str) -> list[bytes]:
    """Pieces of a vocabulary file with one base64 piece and its rank a line. The driver reads
    it; tens of thousands of pieces are sent to the tasks."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


_BUILT: dict[str, tuple[LongestMatch, dict[bytes, int]]] = {}


def _count(shared: Broadcast, mark: bytes, name: str) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _BUILT:  # once per worker
            _BUILT.clear()
            pieces = shared.value
            _BUILT[name] = LongestMatch(
                [p for p in pieces if p.startswith(mark)], [p for p in pieces if not mark or not p.startswith(mark)]), {}
        automaton, known = _BUILT[name]
        for batch in small_batches(batches, "bytes", BATCH_BYTES):
            vocabulary = Vocabulary()
            numbers: list[int] = []
            words = []
            for text in batch.column("bytes").to_pylist():
                found = text.split()
                numbers.extend(map(vocabulary.__getitem__, found))
                words.append(len(found))
            if len(known) + len(vocabulary) > REMEMBERED:
                known.clear()
            pieces = np.zeros(len(vocabulary) + 1, np.int64)
            for i, word in enumerate(vocabulary):
                length = known.get(word)
                if length is None:
                    length = known[word] = automaton.length(mark + word)
                pieces[i] = length
            each = pieces[np.array(numbers, np.int64)] if numbers else np.zeros(0, np.int64)
            ends = np.cumsum(words).astype(np.int64)
            sums = np.concatenate(([0], np.cumsum(np.maximum(each, 1))))
            odd = np.concatenate(([0], np.cumsum(each == 0)))
            starts = ends - np.array(words, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(sums[ends] - sums[starts]),
                 pa.array(odd[ends] - odd[starts])], ["doc_id", "n_words", "n_tokens", "n_unknown"])

    return count


def count_tokens(spark: SparkSession, docs: DataFrame, vocabulary: str = VOCABULARY, mark: bytes = b" ") -> DataFrame:
    """Word-piece lengths of whole texts: doc_id, n_words, n_tokens, n_unknown.

    Words are runs of anything but ASCII white space, letters as they are. Pieces that start
    with ``mark`` open a word, all others continue it; each word is matched greedily, longest
    piece first. A word that pieces cannot spell is one unknown token. A task looks every
    distinct word of a batch up once.

    A null or empty text has no tokens. Repeated rows are counted each. An empty table gives
    an empty result. One row per document, nothing is shuffled.
    """
    pieces = read_pieces(vocabulary)
    name = xxhash.xxh3_128_hexdigest(b"\n".join([mark, *pieces]))
    shared = spark.sparkContext.broadcast(pieces)
    read = docs.select("doc_id", text_bytes(F.col("text")).alias("bytes"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(_count(shared, mark, name), f"doc_id {id_type}, n_words long, n_tokens long, n_unknown long")
