"""Language-model scores from a log-frequency Bloom filter."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm.common import Vocabulary, byte_words, crc_of_id, mixed, runs, small_batches, stage, text_bytes

BASE = 1.5  # of the quantisation: level j stands for counts from BASE ** (j - 1)
BITS_PER_ENTRY = 14.0
PROBES = 6  # bits of one 64-bit word that an entry sets
MAX_FILTER_MB = 256  # of filters that are broadcast; texts that can need more are scored by shuffles
PIECE_MB = 16  # of segments that the driver holds at once, each piece a broadcast of its own
SEGMENTS = 256
HEAVY = 1 << 20  # tokens with at least 1 / HEAVY of all occurrences are looked up by broadcast
HOT_CONTEXTS = 64  # contexts with at least 1 / HOT_CONTEXTS of all tokens are split over segments
COUNT_BYTES = 24 << 20
SCORE_BYTES = 1 << 20  # a worker holds some 60 times as much while it scores
CODE_BYTES = 8 << 20  # of texts coded as one row
SEGMENT_TOKENS = 1 << 21  # of texts for a segment that is filled and asked in one task
KEYS_AT_ONCE = 1 << 16  # entered or probed
CONTEXT_BITS = np.uint64(28)  # low bits of a bigram key tell its word, the rest its context

END = b"\n"  # no word holds white space, so this cannot be one
_U = np.uint64


def _tokens(texts: pa.Array) -> tuple[Vocabulary, np.ndarray, np.ndarray]:
    """Vocabulary of a batch, its tokens as numbers (each text closed by the end token, which
    also opens the batch) and the number of tokens per text."""
    vocabulary = Vocabulary()
    end = vocabulary[END]
    numbers, lengths = [end], []
    for text in texts.to_pylist():
        words = byte_words(text)
        numbers.extend(map(vocabulary.__getitem__, words))
        numbers.append(end)
        lengths.append(len(words) + 1)
    return vocabulary, np.array(numbers, np.int64), np.array(lengths, np.int64)


def _bigrams(hashes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    context, word = hashes[numbers[:-1]], hashes[numbers[1:]]
    low = mixed(context + word * _U(0x9E3779B97F4A7C15)) & ((_U(1) << CONTEXT_BITS) - _U(1))
    return context >> CONTEXT_BITS << CONTEXT_BITS | low


def _context_keys(bigrams: np.ndarray, kind: int) -> np.ndarray:
    """Keys under which a context's number of tokens (1) or of successors (2) is stored."""
    return mixed((bigrams >> CONTEXT_BITS) + _U(kind * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))


def _unigram_keys(hashes: np.ndarray) -> np.ndarray:
    return mixed(hashes ^ _U(0xA5A5A5A5A5A5A5A5))


def levels(counts: np.ndarray) -> np.ndarray:
    """Quantised counts: 1 + floor(log_BASE(count))."""
    return 1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9).astype(np.int64)


def _estimates() -> np.ndarray:
    """Count that each level stands for: the middle of the whole numbers it covers."""
    floor = np.ceil(BASE ** np.arange(0, 100) - 1e-9)
    middle = (floor[:-1] + np.maximum(floor[:-1], floor[1:] - 1)) / 2
    return np.concatenate(([0.0], middle))


ESTIMATE = _estimates()


def _masks(keys: np.ndarray, level: np.ndarray | int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """For entries (key, level): a hash that picks the word, and the bits set in it."""
    h = mixed(keys + np.asarray(level).astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    bits, mask = mixed(h + _U(0x632BE59BD9B4E019)), np.zeros(len(h), np.uint64)
    for i in range(probes):
        mask |= _U(1) << (bits >> _U(6 * i) & _U(63))
    return h, mask


def _words_of(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Position of a hash among ``words`` words, without a division."""
    return ((h >> _U(32)) * words.astype(np.uint64) >> _U(32)).astype(np.int64)


def build_segment(keys: np.ndarray, counts: np.ndarray, bits_per_entry: float, probes: int) -> np.ndarray:
    """A bit array in which key is entered once for each level up to that of its count."""
    top = levels(counts)
    size = max(1, int(top.sum() * bits_per_entry / 64))
    array = np.zeros(size, np.uint64)
    for level in range(1, int(top.max(initial=0)) + 1):
        own = keys[top >= level]
        for begin in range(0, len(own), KEYS_AT_ONCE):
            h, mask = _masks(own[begin : begin + KEYS_AT_ONCE], level, probes)
            np.bitwise_or.at(array, _words_of(h, np.full(len(h), size)), mask)
    return array


class LogFrequencyFilter:
    """All segments laid end to end; ``held`` tells which are there. ``count`` probes level after level until one is missing, so
    its answer is never below the quantised count, and above it with a small known chance."""

    def __init__(self, segments: list[np.ndarray], probes: int, held: np.ndarray | None = None):
        self.held = np.ones(len(segments), bool) if held is None else held
        self.array = np.concatenate(segments)
        self.sizes = np.array([len(s) for s in segments], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.probes = probes

    def level(self, keys: np.ndarray, segments: np.ndarray) -> np.ndarray:
        found = np.zeros(len(keys), np.int8)
        for begin in range(0, len(keys), KEYS_AT_ONCE):
            left = np.arange(begin, min(begin + KEYS_AT_ONCE, len(keys)))
            for level in range(1, len(ESTIMATE)):
                h, mask = _masks(keys[left], level, self.probes)
                at = segments[left]
                hit = self.array[self.starts[at] + _words_of(h, self.sizes[at])] & mask == mask
                left = left[hit]
                if not len(left):
                    break
                found[left] = level
        return found

    def count(self, keys: np.ndarray, segments: np.ndarray) -> np.ndarray:
        return ESTIMATE[self.level(keys, segments)]


class PiecedFilter:
    """A filter whose segments come in several pieces; ``held`` tells which segments it answers for."""

    def __init__(self, pieces: list[LogFrequencyFilter], group: list[int]):
        self.pieces = pieces
        self.piece = np.full(SEGMENTS, -1)
        for i, piece in enumerate(pieces):
            self.piece[piece.held] = i
        self.held = np.isin(np.arange(SEGMENTS), group)

    def count(self, keys: np.ndarray, segments: np.ndarray) -> np.ndarray:
        found, of = np.zeros(len(keys)), self.piece[segments]
        for i, piece in enumerate(self.pieces):
            at = np.flatnonzero(of == i)
            if len(at):
                found[at] = piece.count(keys[at], segments[at])
        return found


def _segment(bigrams: np.ndarray, hot: np.ndarray, segments: int = SEGMENTS) -> np.ndarray:
    """Segment of each bigram: by its context; a hot context is split by its words."""
    context = bigrams >> CONTEXT_BITS
    by = np.where(np.isin(context, hot), bigrams, context)
    return (mixed(by) % _U(segments)).astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "bytes", COUNT_BYTES):
        vocabulary, numbers, _ = _tokens(batch.column("bytes"))
        counts = np.bincount(numbers[1:], minlength=len(vocabulary))
        seen = counts > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(vocabulary.hashes()[seen].view(np.int64)), pa.array(counts[seen])], ["h", "n"])


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers byte by byte, all first bytes first, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _count_pairs(hot: np.ndarray) -> Callable:
    """Counted pairs of a batch, one row per segment: differences of sorted keys, and counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "bytes", COUNT_BYTES):
            vocabulary, numbers, _ = _tokens(batch.column("bytes"))
            keys, counts = np.unique(_bigrams(vocabulary.hashes(), numbers), return_counts=True)
            segment = _segment(keys, hot)
            order = np.argsort(segment, kind="stable")
            keys, counts, cuts = keys[order], counts[order].astype(np.uint32), runs(segment[order])
            rows = [(int(segment[order[a]]), _planes(np.diff(keys[a:b], prepend=_U(0))), _planes(counts[a:b]))
                    for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))],
                ["segment", "keys", "counts"])

    return count


def _sum_by(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else []
    return (keys[starts], *(np.add.reduceat(v[order], starts) if len(keys) else v for v in values))


def _build(hot: np.ndarray, bits_per_entry: float, probes: int) -> Callable:
    """Filter segments from counted pairs, a hot context's sums as rows of their own."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        for batch in batches:
            for s, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("segment", "keys", "counts"))):
                parts.setdefault(s, []).append(
                    (np.cumsum(_from_planes(keys, np.uint64), dtype=np.uint64), _from_planes(counts, np.uint32).astype(np.int64)))
        for s, found in parts.items():
            keys, counts = _sum_by(np.concatenate([k for k, _ in found]), np.concatenate([n for _, n in found]))
            contexts, tokens, successors = _sum_by(keys >> CONTEXT_BITS << CONTEXT_BITS, counts, np.ones_like(counts))
            split = np.isin(contexts >> CONTEXT_BITS, hot)
            array = build_segment(
                np.concatenate([keys, _context_keys(contexts[~split], 1), _context_keys(contexts[~split], 2)]),
                np.concatenate([counts, tokens[~split], successors[~split]]), bits_per_entry, probes)
            rows = [(s, array.tobytes(), None, None, None)] + [
                (s, None, int(c), int(t), int(d)) for c, t, d in
                zip((contexts[split] >> CONTEXT_BITS).tolist(), tokens[split], successors[split])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()))],
                ["segment", "bits", "context", "tokens", "successors"])

    return build


def _build_unigrams(bits_per_entry: float, probes: int) -> Callable:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        for batch in batches:
            h = batch.column("h").to_numpy().view(np.uint64)
            n = batch.column("n").to_numpy()
            segment = (h % _U(SEGMENTS)).astype(np.int64)
            for s in np.unique(segment).tolist():
                parts.setdefault(s, []).append((h[segment == s], n[segment == s]))
        for s, found in parts.items():
            h = np.concatenate([x for x, _ in found])
            array = build_segment(_unigram_keys(h), np.concatenate([n for _, n in found]), bits_per_entry, probes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([array.tobytes()], pa.binary())], ["segment", "bits"])

    return build


@dataclass
class Model:
    """What the scoring tasks of a pass get by broadcast: a group of segments of each filter."""

    words: PiecedFilter
    pairs: PiecedFilter
    hot: np.ndarray  # contexts split over segments
    hot_tokens: np.ndarray
    hot_successors: np.ndarray
    heavy: np.ndarray  # hashes of frequent tokens, sorted
    heavy_counts: np.ndarray
    total: int
    distinct: int

    def unigram(self, hashes: np.ndarray) -> np.ndarray:
        """Add-one probability from the quantised count."""
        count = self.words.count(_unigram_keys(hashes), (hashes % _U(SEGMENTS)).astype(np.int64))
        return (np.minimum(count, self.total) + 1) / (self.total + self.distinct + 1)

    def contexts(self, bigrams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and distinct successors of each pair's context."""
        context = bigrams >> CONTEXT_BITS
        segment = (mixed(context) % _U(SEGMENTS)).astype(np.int64)
        tokens = self.pairs.count(_context_keys(bigrams, 1), segment)
        successors = self.pairs.count(_context_keys(bigrams, 2), segment)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, context), len(self.hot) - 1)
            known = self.hot[at] == context
            tokens[known], successors[known] = self.hot_tokens[at[known]], self.hot_successors[at[known]]
        return tokens, np.minimum(successors, tokens)


@dataclass
class Shared:
    """The broadcasts of a pass. Pieces of the filters stand apart, so that none is copied to be joined."""

    words: list[Broadcast]
    pairs: list[Broadcast]
    groups: tuple[list[int], list[int]]
    counts: Broadcast  # the other fields of the model

    def model(self) -> Model:
        words, pairs = (PiecedFilter([x.value for x in pieces], group)
                        for pieces, group in zip((self.words, self.pairs), self.groups))
        return Model(words, pairs, *self.counts.value)

    def destroy(self) -> None:
        for shared in (*self.words, *self.pairs):
            shared.destroy()


def _score(shared: Shared) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.model()
        for batch in small_batches(batches, "bytes", SCORE_BYTES):
            vocabulary, numbers, lengths = _tokens(batch.column("bytes"))
            hashes = vocabulary.hashes()
            ends = np.cumsum(lengths)
            owner = np.repeat(np.arange(len(lengths)), lengths)

            # Exact base score: frequent tokens here, the others are listed for a join.
            if len(model.heavy):
                at = np.minimum(np.searchsorted(model.heavy, hashes), len(model.heavy) - 1)
                exact = np.where(model.heavy[at] == hashes, model.heavy_counts[at], 0)
            else:
                exact = np.zeros(len(hashes), np.int64)
            count = exact[numbers[1:]]
            base = np.add.reduceat(np.log10(count + 1.0) * (count > 0), ends - lengths)
            known = np.add.reduceat((count > 0).astype(np.int64), ends - lengths)
            rare = count == 0
            rows, repeats = np.unique(
                np.stack([owner[rare], numbers[1:][rare]]), axis=1, return_counts=True) if rare.any() else (
                np.zeros((2, 0), np.int64), np.zeros(0, np.int64))
            offsets = np.searchsorted(rows[0], np.arange(len(lengths) + 1)).astype(np.int32)

            # Interpolated Witten-Bell bigrams over add-one unigrams, all from filter probes.
            first = model.unigram(hashes)[numbers[1:]]
            pairs, inverse = np.unique(_bigrams(hashes, numbers), return_inverse=True)
            contexts, of_context = np.unique(pairs >> CONTEXT_BITS << CONTEXT_BITS, return_inverse=True)
            tokens, successors = (x[of_context] for x in model.contexts(contexts))
            together = np.minimum(model.pairs.count(pairs, _segment(pairs, model.hot)), tokens)
            seen = (tokens > 0) & (successors > 0)  # a stray hit for one of them tells nothing
            scale = np.where(seen, tokens + successors, 1.0)
            direct = np.where(seen, together / scale, 0.0)
            backoff = np.where(seen, successors / scale, 1.0)
            chance = direct[inverse] + backoff[inverse] * first
            # A token counts in the one pass that holds the segments of its word and of its pair.
            mine = model.words.held[(hashes % _U(SEGMENTS)).astype(np.int64)][numbers[1:]]
            mine &= model.pairs.held[_segment(pairs, model.hot)][inverse]
            total = np.add.reduceat(np.where(mine, np.log10(chance), 0.0), ends - lengths)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), batch.column("held_out"), pa.array(lengths), pa.array(total),
                 pa.array(base), pa.array(known),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes[rows[1]].view(np.int64))),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(repeats))],
                ["doc_id", "digest", "held_out", "n_tokens", "score", "log_sum", "known", "rare", "times"])

    return score


def _share(spark: SparkSession, segments: DataFrame, probes: int) -> list[Broadcast]:
    """Broadcast all segments. They are read piece by piece and sent on, so that the driver never
    holds a whole filter."""
    shared: list[Broadcast] = []
    for group in packed(_sizes(segments), PIECE_MB * 1e6):
        found = {r["segment"]: np.frombuffer(r["bits"], np.uint64) for r in segments.filter(
            F.col("segment").isin(group) & F.col("bits").isNotNull()).select("segment", "bits").toLocalIterator()}
        arrays = [found.get(segment, np.zeros(1, np.uint64)) for segment in range(SEGMENTS)]
        shared.append(spark.sparkContext.broadcast(
            LogFrequencyFilter(arrays, probes, np.isin(np.arange(SEGMENTS), group))))
    return shared


def _sizes(segments: DataFrame) -> np.ndarray:
    """Bytes of each segment."""
    sizes = np.zeros(SEGMENTS, np.int64)
    for r in segments.filter(F.col("bits").isNotNull()).select("segment", F.octet_length("bits").alias("n")).collect():
        sizes[r["segment"]] = r["n"]
    return sizes


def packed(sizes: np.ndarray, room: float) -> list[list[int]]:
    """All segments in groups of neighbours that hold ``room`` bytes at most, or one segment."""
    groups, filled = [[]], 0
    for segment, size in enumerate(sizes.tolist()):
        if groups[-1] and filled + size > room:
            groups.append([])
            filled = 0
        groups[-1].append(segment)
        filled += size
    return groups


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as rows of about ``CODE_BYTES``: ids, lengths, tokens as numbers, hashes of the distinct
    words and how often each is in training texts."""
    number = TaskContext.get().partitionId() << 32
    for batch in small_batches(batches, "bytes", CODE_BYTES):
        vocabulary, numbers, lengths = _tokens(batch.column("bytes"))
        train = np.repeat(~batch.column("held_out").to_numpy(zero_copy_only=False), lengths)
        counts = np.bincount(numbers[1:][train], minlength=len(vocabulary))
        whole = pa.array([0, batch.num_rows], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), *(pa.ListArray.from_arrays(whole, batch.column(c)) for c in ("doc_id", "held_out")),
             *(pa.array([_planes(x)], pa.binary()) for x in (
                 lengths.astype(np.uint32), numbers.astype(np.uint32), vocabulary.hashes(), counts.astype(np.uint32)))],
            ["batch", "doc_id", "held_out", "lengths", "numbers", "hashes", "counts"])
        number += 1


CODED = "batch long, doc_id array<{}>, held_out array<boolean>, lengths binary, numbers binary, hashes binary, counts binary"
ASKED = "batch long, segment int, keys binary, counts binary"
ANSWERED = "batch long, segment int, first binary, second binary, third binary, key long, tokens long, successors long"


def _word_segments(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segment of each word, and the order by segment and hash in which words are asked."""
    segment = (hashes % _U(SEGMENTS)).astype(np.uint16)
    return segment, np.lexsort((hashes, segment))


def _asked(batch: int, segment: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """A row for each segment of sorted ones, with its sorted keys and their counts."""
    cuts = runs(segment)
    rows = [(batch, int(segment[a]), _planes(np.diff(keys[a:b], prepend=_U(0))), _planes(counts[a:b]))
            for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
        ["batch", "segment", "keys", "counts"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        hashes = _from_planes(row["hashes"], np.uint64)
        segment, order = _word_segments(hashes)
        yield _asked(row["batch"], segment[order], hashes[order], _from_planes(row["counts"], np.uint32)[order])


def _ask_pairs(hot: np.ndarray, segments: int) -> Callable:
    """Distinct pairs of each coded row, in order, with the number of times they are in training texts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            hashes, numbers = _from_planes(row["hashes"], np.uint64), _from_planes(row["numbers"], np.uint32)
            train = np.repeat(~np.array(row["held_out"], bool), _from_planes(row["lengths"], np.uint32))
            pairs, inverse = np.unique(_bigrams(hashes, numbers), return_inverse=True)
            counts = np.bincount(inverse[train], minlength=len(pairs)).astype(np.uint32)
            segment = _segment(pairs, hot, segments).astype(np.uint16)
            order = np.argsort(segment, kind="stable")
            yield _asked(row["batch"], segment[order], pairs[order], counts[order])

    return ask


def _runs_of_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, np.ndarray, np.ndarray]]]]:
    """Asked rows, which come sorted by segment: for each segment its (batch, keys, counts)."""
    own, found = None, []
    for batch in batches:
        for number, segment, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("batch", "segment", "keys", "counts"))):
            if segment != own and found:
                yield own, found
                found = []
            own = segment
            found.append((number, np.cumsum(_from_planes(keys, np.uint64), dtype=np.uint64), _from_planes(counts, np.uint32)))
    if found:
        yield own, found


def _together(found: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, list]:
    """Distinct keys of all rows of a segment, their summed counts, and of each row its batch, its keys and
    their places among the distinct ones. Empties ``found``, so that nothing is held twice."""
    batches, ends = [number for number, *_ in found], np.cumsum([len(keys) for _, keys, _ in found])
    asked, times = (np.concatenate([x[i] for x in found]) for i in (1, 2))
    found.clear()
    order = np.argsort(asked, kind="stable")
    keys, times = asked[order], times[order].astype(np.int64)
    new = np.concatenate(([True], keys[1:] != keys[:-1]))
    keys, counts = keys[new], np.add.reduceat(times, np.flatnonzero(new))
    place = np.empty(len(asked), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return keys, counts, list(zip(batches, np.split(asked, ends[:-1]), np.split(place, ends[:-1])))


def _answered(segment: int, answers: list[tuple], sums: list[tuple]) -> pa.RecordBatch:
    rows = [(number, segment, *data, *[None] * (6 - len(data))) for number, *data in answers] + [
        (None, segment, None, None, None, *x) for x in sums]
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
        ["batch", "segment", "first", "second", "third", "key", "tokens", "successors"])


def _answer_words(bits_per_entry: float, probes: int) -> Callable:
    """Fills the segments of the word filter. Answers levels and exact counts; rows without a batch hold a
    segment's tokens and distinct words, and words that can be hot."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, found in _runs_of_segments(batches):
            words, counts, rows = _together(found)
            known = counts > 0
            array = build_segment(_unigram_keys(words[known]), counts[known], bits_per_entry, probes)
            level = LogFrequencyFilter([array], probes).level(_unigram_keys(words), np.zeros(len(words), np.int64))
            answers = [(number, _planes(level[own]), _planes(counts[own])) for number, _, own in rows]
            often = known & (counts * HOT_CONTEXTS >= max(counts.sum(), 1))
            yield _answered(segment, answers, [(None, int(counts.sum()), int(known.sum()))] + [
                (h, n, None) for h, n in zip(words[often].view(np.int64).tolist(), counts[often].tolist())])

    return answer


def _answer_pairs(hot: np.ndarray, bits_per_entry: float, probes: int) -> Callable:
    """Fills the segments of the pair filter. Answers levels of pairs, and of the tokens and successors of their
    contexts; rows without a batch hold a hot context's sums."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, found in _runs_of_segments(batches):
            pairs, counts, rows = _together(found)
            known = counts > 0
            contexts, tokens, successors = _sum_by(
                pairs[known] >> CONTEXT_BITS << CONTEXT_BITS, counts[known], np.ones(int(known.sum()), np.int64))
            split = np.isin(contexts >> CONTEXT_BITS, hot)
            held = LogFrequencyFilter([build_segment(
                np.concatenate([pairs[known], _context_keys(contexts[~split], 1), _context_keys(contexts[~split], 2)]),
                np.concatenate([counts[known], tokens[~split], successors[~split]]), bits_per_entry, probes)], probes)
            level = held.level(pairs, np.zeros(len(pairs), np.int64))
            cuts = runs(pairs >> CONTEXT_BITS)
            none = np.zeros(len(cuts) - 1, np.int64)
            of_context = np.repeat(np.arange(len(none), dtype=np.int32), np.diff(cuts))
            heads = pairs[cuts[:-1]]
            levels_1, levels_2 = (held.level(_context_keys(heads, kind), none) for kind in (1, 2))
            answers = []
            for number, keys, own in rows:
                head = of_context[own[runs(keys >> CONTEXT_BITS)[:-1]]]
                answers.append((number, _planes(level[own]), _planes(levels_1[head]), _planes(levels_2[head])))
            yield _answered(segment, answers, list(zip(
                (contexts[split] >> CONTEXT_BITS).astype(np.int64).tolist(), tokens[split].tolist(), successors[split].tolist())))

    return answer


def _score_coded(hot: np.ndarray, segments: int, known: tuple, total: int, distinct: int) -> Callable:
    """Scores of a coded row's texts from the answers of all segments."""
    hot_known, hot_tokens, hot_successors = known

    def score(coded: pa.Table, answers: pa.Table) -> pa.Table:
        row = coded.to_pylist()[0]
        lengths, numbers = (_from_planes(row[c], np.uint32).astype(np.int64) for c in ("lengths", "numbers"))
        hashes = _from_planes(row["hashes"], np.uint64)
        starts, words = np.cumsum(lengths) - lengths, numbers[1:]
        answers = answers.sort_by("segment")
        of_words, of_pairs = (answers.filter(pc.is_null(answers["third"], nan_is_null=False)),
                              answers.filter(pc.is_valid(answers["third"])))

        def joined(table: pa.Table, column: str, kind: type) -> np.ndarray:
            return np.concatenate([_from_planes(x, kind) for x in table[column].to_pylist()])

        _, order = _word_segments(hashes)
        level, count = np.empty(len(hashes), np.int8), np.empty(len(hashes), np.int64)
        level[order], count[order] = joined(of_words, "first", np.int8), joined(of_words, "second", np.int64)
        base = np.add.reduceat(np.log10(count + 1.0)[words], starts)
        n_known = np.add.reduceat((count > 0).astype(np.int64)[words], starts)
        first = (np.minimum(ESTIMATE[level], total) + 1) / (total + distinct + 1)

        pairs, inverse = np.unique(_bigrams(hashes, numbers), return_inverse=True)
        segment = _segment(pairs, hot, segments).astype(np.uint16)
        order = np.argsort(segment, kind="stable")
        contexts, segment = (pairs >> CONTEXT_BITS)[order], segment[order]
        new = np.concatenate(([True], (contexts[1:] != contexts[:-1]) | (segment[1:] != segment[:-1])))
        heads = contexts[new]
        tokens, successors = (ESTIMATE[joined(of_pairs, c, np.int8)] for c in ("second", "third"))
        if len(hot_known):
            at = np.minimum(np.searchsorted(hot_known, heads), len(hot_known) - 1)
            exact = hot_known[at] == heads
            tokens[exact], successors[exact] = hot_tokens[at[exact]], hot_successors[at[exact]]
        of_head = np.cumsum(new) - 1
        tokens, successors = tokens[of_head], np.minimum(successors, tokens)[of_head]
        together = np.minimum(ESTIMATE[joined(of_pairs, "first", np.int8)], tokens)
        seen = (tokens > 0) & (successors > 0)
        scale = np.where(seen, tokens + successors, 1.0)
        direct, backoff = np.empty(len(pairs)), np.empty(len(pairs))
        direct[order], backoff[order] = np.where(seen, together / scale, 0.0), np.where(seen, successors / scale, 1.0)
        chance = direct[inverse] + backoff[inverse] * first[words]
        return pa.Table.from_arrays(
            [coded["doc_id"].combine_chunks().flatten(), coded["held_out"].combine_chunks().flatten(), pa.array(lengths),
             pa.array(n_known), pa.array(np.full(len(lengths), total)),
             pa.array(base - lengths * math.log10(total + distinct + 1)),
             pa.array(np.add.reduceat(np.log10(chance), starts))],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return score


def _score_by_shuffles(spark: SparkSession, docs: DataFrame, read: DataFrame, bits_per_entry: float, probes: int) -> DataFrame:
    """Scores without a filter sent to all. Texts are tokenised once, into coded rows. These send their
    distinct words, then their distinct pairs, to the segments they belong to; a task fills a segment and
    answers all rows that asked it, and the answers meet the rows."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    coded = stage(spark, read.select("doc_id", "held_out", "bytes").mapInArrow(_code, CODED.format(kind)), "lm-coded")

    def answers(ask: Callable, answer: Callable, columns: list[str], name: str) -> DataFrame:
        asked = coded.select("batch", *columns).mapInArrow(ask, ASKED)
        return stage(spark, asked.repartition("segment").sortWithinPartitions("segment").mapInArrow(answer, ANSWERED), name)

    of_words = answers(_ask_words, _answer_words(bits_per_entry, probes), ["hashes", "counts"], "lm-words")
    sums = of_words.filter("batch IS NULL")
    whole = sums.filter("key IS NULL").agg(F.sum("tokens"), F.sum("successors")).first()
    total, distinct = (int(x or 0) for x in whole)
    often = sums.filter((F.col("key").isNotNull()) & (F.col("tokens") * HOT_CONTEXTS >= max(total, 1))).select("key").collect()
    hot = np.unique(np.array([r["key"] for r in often], np.int64).view(np.uint64) >> CONTEXT_BITS)
    segments = SEGMENTS
    while segments < 1 << 15 and segments * SEGMENT_TOKENS < total:
        segments *= 2
    of_pairs = answers(_ask_pairs(hot, segments), _answer_pairs(hot, bits_per_entry, probes),
                       ["held_out", "lengths", "numbers", "hashes"], "lm-pairs")
    split = of_pairs.filter("batch IS NULL").groupBy("key").agg(
        F.sum("tokens").alias("tokens"), F.sum("successors").alias("successors")).orderBy("key").collect()
    known = (np.array([r["key"] for r in split], np.uint64),
             *(np.array([r[c] for r in split], float) for c in ("tokens", "successors")))
    given = of_words.unionAll(of_pairs).filter("batch IS NOT NULL").select("batch", "segment", "first", "second", "third")
    return coded.drop("counts").groupBy("batch").cogroup(given.groupBy("batch")).applyInArrow(
        _score_coded(hot, segments, known, total, distinct),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_documents(spark: SparkSession, docs: DataFrame, *, modulus: int = 7, held_remainder: int = 2,
                    bits_per_entry: float = BITS_PER_ENTRY, probes: int = PROBES, heavy: int = HEAVY,
                    max_filter_mb: int = MAX_FILTER_MB) -> DataFrame:
    """Score whole texts with a smoothed bigram model of the training documents.

    Training documents are those whose crc32(doc_id as text) mod ``modulus`` is not
    ``held_remainder``. Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score
    (exact add-one unigrams) and score (log10 probability by the model).

    Counts of all words and word pairs are combined per batch, shuffled by hash and summed. A
    task turns its counts into segments of a log-frequency Bloom filter: a pair whose count has
    the quantised level q is entered q times, as (pair, 1) to (pair, q). Contexts are entered
    with their numbers of tokens and of distinct successors. Scoring probes levels until one
    is missing, and interpolates pair and word estimates after Witten and Bell.

    Filters have ``bits_per_entry`` bits per entry at every size of the input. Where they take
    ``max_filter_mb`` at most whatever the texts hold, they are broadcast, piece by piece of
    ``PIECE_MB``, and the exact counts of the base score are broadcast for tokens with at least
    1 / ``heavy`` of all occurrences, of which there are ``heavy`` at most; all others are joined by
    hash. Otherwise no filter leaves the task that fills it: words and pairs are sent there and
    answered, so the work per text does not grow with the filter (see ``_score_by_shuffles``).

    A null text is an empty one: one token, the end. A null id counts as a training document.
    Repeated rows are scored and learnt from each. Without training rows all counts are 0. An
    empty table gives an empty result.
    """
    read = docs.select(
        F.col("doc_id"), (crc_of_id(F.col("doc_id")) % modulus == held_remainder).alias("held_out"),
        text_bytes(F.col("text")).alias("bytes")).withColumn("digest", F.xxhash64("bytes"))
    size = read.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("bytes")).alias("bytes")).first()
    tokens = 2 * size["n"] + (size["bytes"] or 0) // 2  # at most: a word and a space are two bytes
    # A token adds four entries at most: its word, its pair, a token and a successor of its context.
    if tokens * 4 * bits_per_entry / 8 > max_filter_mb * 1e6:
        return _score_by_shuffles(spark, docs, read, bits_per_entry, probes)
    train = read.filter(~F.col("held_out")).select("bytes")
    counts = stage(spark, train.mapInArrow(_count_words, "h long, n long").groupBy("h").agg(
        F.sum("n").alias("n")), "lm-words")
    sums = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = int(sums["n"] or 0), int(sums["v"])
    frequent = counts.filter(F.col("n") * heavy >= total).toPandas()
    order = np.argsort(frequent["h"].to_numpy(np.int64).view(np.uint64))
    heavy_hashes = frequent["h"].to_numpy(np.int64).view(np.uint64)[order]
    heavy_counts = frequent["n"].to_numpy(np.int64)[order]
    hot = np.unique(heavy_hashes[heavy_counts * HOT_CONTEXTS >= max(total, 1)] >> CONTEXT_BITS)

    pair_segments = stage(spark, train.mapInArrow(
        _count_pairs(hot), "segment int, keys binary, counts binary").repartition("segment").mapInArrow(
        _build(hot, bits_per_entry, probes),
        "segment int, bits binary, context long, tokens long, successors long"), "lm-pair-segments")
    word_segments = stage(spark, counts.repartition(F.pmod("h", F.lit(SEGMENTS))).mapInArrow(
        _build_unigrams(bits_per_entry, probes), "segment int, bits binary"), "lm-word-segments")
    split = {r["context"]: (r["tokens"], r["successors"]) for r in pair_segments.filter(
        F.col("context").isNotNull()).groupBy("context").agg(
        F.sum("tokens").alias("tokens"), F.sum("successors").alias("successors")).collect()}
    hot_known = np.array(sorted(split), np.uint64)
    hot_tokens, hot_successors = (np.array([split[int(c)][i] for c in hot_known], float) for i in (0, 1))
    counted = spark.sparkContext.broadcast((hot_known, hot_tokens, hot_successors, heavy_hashes, heavy_counts, total, distinct))

    every = list(range(SEGMENTS))
    shared = Shared(_share(spark, word_segments, probes), _share(spark, pair_segments, probes), (every, every), counted)
    scored = stage(spark, read.mapInArrow(_score(shared), (
        "doc_id " + docs.schema["doc_id"].dataType.simpleString() + ", digest long, held_out boolean, n_tokens long, "
        "score double, log_sum double, known long, rare array<long>, times array<long>")).withColumn(
        "row", F.monotonically_increasing_id()), "lm-scored")
    shared.destroy()
    listed = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "row", F.col("x.rare").alias("h"), F.col("x.times").alias("times"))
    joined = listed.join(counts, "h").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"), F.sum("times").alias("more_known"))
    return scored.join(joined, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("log_sum") + F.coalesce("more", F.lit(0.0))
         - F.col("n_tokens") * math.log10(total + distinct + 1)).alias("base_score"),
        "score")
