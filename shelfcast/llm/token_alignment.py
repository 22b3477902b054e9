"""Cross-tokenizer alignment: links between the tokens of two tokenizers, counted by minimal perfect hashing."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain, islice
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm.common import Vocabulary as Numbers, mixed, small_batches, stage

TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"
BATCH_BYTES = 1 << 22  # text read together
RUN_LETTERS = 1 << 10  # words encoded together
HELD_WORDS, HELD_LETTERS = 1 << 19, 1 << 24  # words a worker remembers
HELD = 1 << 22  # pairs a task holds before it combines them
SEGMENTS = 1024  # most parts of the pair space; a part holds V_A * V_B / SEGMENTS pairs at most
TABLE_MB = 64  # hash, keys and counts that are broadcast at a time
GROUP_LINKS = 1024  # groups with more links are taken as distinct ids with their numbers
_GAMMA = 2  # bits per key and level
_LEVELS = 64

RESULT = ("n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


# Minimal perfect hash ---------------------------------------------------------------------


def _spot(keys: np.ndarray, level: int) -> np.ndarray:
    return mixed(keys.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64))


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    return (_spot(keys, _LEVELS) % np.uint64(segments)).astype(np.int64)


def build_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of a minimal perfect hash of distinct keys, and the size of each level in bits.

    Each level has twice as many bits as keys are left. A key that meets no other sets its bit
    there, all others go on to the next level. A key's number is the number of bits before its own.
    """
    words, sizes, left = [], [], keys
    for level in range(_LEVELS):
        if not len(left):
            break
        size = -(-max(64, _GAMMA * len(left)) // 64) * 64
        at = (_spot(left, level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        sizes.append(size)
        left = left[~alone[at]]
    if len(left):
        raise ValueError("keys are not distinct")
    return np.concatenate(words) if words else np.zeros(0, np.uint64), np.array(sizes, np.int64)


class PairTable:
    """Counts of pairs, found by hash and verified by key, for some of the segments."""

    def __init__(self, segments: int, rows: list[dict]):
        self.segments = segments
        self.slot = np.full(segments, -1, np.int64)
        sizes = np.zeros((len(rows), _LEVELS), np.int64)
        for n, row in enumerate(rows):
            own = np.frombuffer(row["sizes"], np.int64)
            self.slot[row["segment"]], sizes[n, : len(own)] = n, own
        self.sizes = sizes
        self.starts = (np.cumsum(sizes.ravel()) - sizes.ravel()).reshape(sizes.shape)
        self.depth = int((sizes > 0).sum(1).max(initial=0))
        self.words = np.concatenate([np.zeros(0, np.uint64)] + [np.frombuffer(r["bits"], np.uint64) for r in rows])
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = (np.cumsum(counts) - counts).astype(np.uint32 if counts.sum() < 2**32 else np.int64)
        self.keys = _narrow([np.frombuffer(r["keys"], np.int64) for r in rows if r.get("keys") is not None])
        self.counts = _narrow([np.frombuffer(r["counts"], np.int64) for r in rows if r.get("counts") is not None])

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 in other segments and for keys that no level knows."""
        out = np.full(len(keys), -1, np.int64)
        slot = self.slot[segment_of(keys, self.segments)]
        left = np.flatnonzero(slot >= 0)
        slot = slot[left]
        for level in range(self.depth):
            size = self.sizes[slot, level]
            on = size > 0
            left, slot, size = left[on], slot[on], size[on]
            at = self.starts[slot, level] + (_spot(keys[left], level) % size.astype(np.uint64)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = self.before[at[hit] >> 6] + np.bitwise_count(below[hit])
            left, slot = left[~hit], slot[~hit]
        return out

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key; 0 for keys that are not in the table."""
        found = np.zeros(len(keys), np.int64)
        number = self.numbers(keys)
        known = np.flatnonzero(number >= 0)
        known = known[self.keys[number[known]] == keys[known]]
        found[known] = self.counts[number[known]]
        return found


def _narrow(parts: list[np.ndarray]) -> np.ndarray:
    """One array, of 32 bits where the values allow it."""
    if max((int(p.max(initial=0)) for p in parts), default=0) < 2**32:
        parts = [p.astype(np.uint32) for p in parts]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


# Tokens and groups ------------------------------------------------------------------------


def _byte_of_letter() -> dict[str, int]:
    """Letters of a byte-level vocabulary: printable Latin-1 stands for itself, all other bytes
    for the letters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers and the bytes of their entries."""

    def __init__(self, a_file: bytes, b_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the cores out
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        letters = _byte_of_letter()
        self.a_bytes = [
            bytes(letters[c] for c in word) if (word := self.a.id_to_token(i)) and all(c in letters for c in word)
            else (word or "").encode() for i in range(self.a.get_vocab_size())]
        self.b_bytes = [
            bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i)
            else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.width = len(self.b_bytes)
        entries = max(len(self.a_bytes), self.width)
        self.names = [f"{mark}{i}" for mark in ",;|" for i in range(entries)]
        self.entries = entries

        # Words can be encoded apart if no piece of B holds a space after another character and A
        # cuts words by the usual pattern before it merges.
        made = json.loads(a_file)
        cutter = made.get("pre_tokenizer") or {}
        self.apart = (
            all("▁" not in self.b.id_to_piece(i).lstrip("▁") for i in range(self.width))
            and self.b.encode_as_pieces("a  b") == ["▁a", "▁", "▁b"] and made.get("normalizer") is None
            and cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space"))

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Token ids of each text, A with a space before it; None where they do not spell both."""
        spaced = [" " + text for text in texts]
        out = []
        for text, a, b in zip(spaced, self.a.encode_batch_fast(spaced, add_special_tokens=False),
                              self.b.encode(texts, num_threads=1)):
            whole, ids = text.encode(), a.ids
            spelled = b"".join(map(self.a_bytes.__getitem__, ids)) == whole == b"".join(map(self.b_bytes.__getitem__, b))
            out.append((ids, b) if spelled else None)
        return out


def vocabulary_sizes(a_file: bytes, b_file: bytes) -> tuple[int, int]:
    import sentencepiece

    made = json.loads(a_file)
    entries = [*made["model"]["vocab"].values(), *(t["id"] for t in made.get("added_tokens", []))]
    return max(entries) + 1, sentencepiece.SentencePieceProcessor(model_proto=b_file).get_piece_size()


class Aligned(NamedTuple):
    """Words of a batch cut into groups; tokens and groups are numbered through the batch."""

    words: int
    a: np.ndarray
    b: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    a_ends: np.ndarray  # tokens up to the end of each word
    b_ends: np.ndarray
    group_ends: np.ndarray  # groups up to the end of each word


_SPACED = re.compile(r" \s")
_INNER = re.compile(r"(?<=\S) (?=\S)")


def cut_words(text: str) -> list[str]:
    """A text cut at spaces that open a word, without these; both tokenizers always cut there.

    A space between two other characters does, whatever white space comes before it.
    """
    if not text[0].isspace() and not _SPACED.search(text):
        return text.split(" ")
    return _INNER.split(text)


def _runs_of(words: list[str]) -> Iterator[list[str]]:
    """Runs of words that are encoded as one text. A word that ends with a space ends its run, as
    B would join that space with the next."""
    run, size = [], 0
    for word in words:
        run.append(word)
        size += len(word) + 1
        if size > RUN_LETTERS or not word or word[-1] == " ":
            yield run
            run, size = [], 0
    if run:
        yield run


def align(of: Tokenizers, words: list[str]) -> tuple[Aligned, np.ndarray]:
    """Groups of each word, and which words both tokenizers spell; the others have none.

    Groups end where tokens of both end. Words are encoded in runs, and byte offsets run on from
    one to the next.
    """
    runs = list(_runs_of(words))
    a, b, sizes, good = [], [], [], []
    for run, ids in zip(runs, of.encode([" ".join(run) for run in runs])):
        for part, found in [(run, ids)] if ids else [([w], x) for w, x in zip(run, of.encode(run))]:
            good += [found is not None] * len(part)
            sizes += [(len(w) if w.isascii() else len(w.encode())) + 1 if found else 0 for w in part]
            if found:
                a.append(found[0])
                b.append(found[1])
    a, b = (np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids))) for ids in (a, b))
    a_at, b_at = np.cumsum(of.a_size[a]), np.cumsum(of.b_size[b])
    common = np.intersect1d(a_at, b_at, assume_unique=True)
    ends = np.cumsum(sizes, dtype=np.int64)
    batch = Aligned(len(words), a, b, np.searchsorted(common, a_at), np.searchsorted(common, b_at),
                    *(np.searchsorted(at, ends, "right") for at in (a_at, b_at, common)))
    return batch, np.array(good, bool)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive parts that end at ``ends``."""
    running = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return np.diff(running[np.concatenate(([0], ends))])


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often each occurs, by one sort."""
    values = np.sort(values)
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
    return values[first], np.diff(first, append=len(values))


def links(batch: Aligned, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs as keys (A id * width + B id), the word of each and how often it is linked there.

    Every A token of a small group meets its B tokens one by one; of a group with more than
    ``GROUP_LINKS`` links the distinct ids meet, with the product of their numbers.
    """
    groups = int(batch.group_ends[-1]) if batch.words else 0
    n_a, n_b = np.bincount(batch.a_group, minlength=groups), np.bincount(batch.b_group, minlength=groups)
    word_of = np.repeat(np.arange(batch.words), np.diff(batch.group_ends, prepend=0))
    large = n_a * n_b > GROUP_LINKS
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    times = np.where(large[batch.a_group], 0, n_b[batch.a_group])
    ends = np.cumsum(times)
    within = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - times, times)
    group = np.repeat(batch.a_group, times)
    keys = np.repeat(batch.a, times) * width + batch.b[first_b[group] + within]
    yield keys, word_of[group], np.ones(len(keys), np.int64)
    for g in np.flatnonzero(large):
        a, many_a = np.unique(batch.a[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
        b, many_b = np.unique(batch.b[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
        for begin in range(0, len(a), max(1, HELD // len(b))):
            part = slice(begin, begin + max(1, HELD // len(b)))
            keys = (a[part, None] * width + b[None, :]).ravel()
            yield keys, np.full(len(keys), word_of[g]), (many_a[part, None] * many_b[None, :]).ravel()


def _spelled(of: Tokenizers, batch: Aligned) -> list[str]:
    """Each word's groups, written as ``a1,a2|b1;a3|b2``."""
    groups = int(batch.group_ends[-1]) if batch.words else 0
    n_a, n_b = np.bincount(batch.a_group, minlength=groups), np.bincount(batch.b_group, minlength=groups)
    opens_a, opens_b = np.diff(batch.a_group, prepend=-1) > 0, np.diff(batch.b_group, prepend=-1) > 0
    names = np.empty(len(batch.a) + len(batch.b), np.int64)
    names[np.arange(len(batch.a)) + (np.cumsum(n_b) - n_b)[batch.a_group]] = batch.a + of.entries * opens_a
    names[np.arange(len(batch.b)) + np.cumsum(n_a)[batch.b_group]] = batch.b + 2 * of.entries * opens_b
    out, begin, numbers = [], 0, names.tolist()
    for end in (batch.a_ends + batch.b_ends).tolist():
        out.append("".join(map(of.names.__getitem__, numbers[begin:end]))[1:])
        begin = end
    return out


class Words:
    """Alignments of the words a worker has met: counts, pairs and spelled groups by number."""

    def __init__(self, of: Tokenizers, spell: bool):
        self.of, self.spell = of, spell
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = Numbers()
        self.known = self.letters = 0
        self.spelled: list[str] = []
        self.good = np.zeros(0, bool)
        # Per word: tokens of A, of B, groups, links; and where its pairs begin and how many it has.
        self.totals = np.zeros((4, 0), np.int64)
        self.first, self.many = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.keys, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts, one after another, and where each text ends. A text with a
        word that is not spelled has no words."""
        if len(self.number) > HELD_WORDS or self.letters > HELD_LETTERS:
            self.forget()
        known = len(self.number)
        numbers, ends = [], []
        for text in texts:
            if text:
                numbers.extend(map(self.number.__getitem__, cut_words(text) if self.of.apart else [text]))
            ends.append(len(numbers))
        self._learn([*islice(self.number, known, None)])
        flat, ends = np.array(numbers, np.int64), np.array(ends, np.int64)
        lost = _sums(~self.good[flat], ends) > 0
        if lost.any():
            sizes = np.diff(ends, prepend=0)
            flat = flat[~np.repeat(lost, sizes)]
            ends = np.cumsum(np.where(lost, 0, sizes))
        return flat, ends

    def _learn(self, words: list[str]) -> None:
        if not words:
            return
        batch, good = align(self.of, words)
        self.letters += sum(map(len, words))
        found = list(links(batch, self.of.width))
        space = self.of.width * len(self.of.a_bytes)
        codes, times = _counted(found[0][1] * space + found[0][0])
        if len(found) > 1:
            codes, times = _combined([codes, *(w * space + k for k, w, _ in found[1:])], [times, *(t for *_, t in found[1:])])
        word, keys = codes // space, codes % space
        many = np.bincount(word, minlength=len(words))
        n_links = np.bincount(word, times, len(words)).astype(np.int64)
        ends = (batch.a_ends, batch.b_ends, batch.group_ends)
        totals = np.stack([*(np.diff(e, prepend=0) for e in ends), n_links])
        self.totals = np.concatenate((self.totals, totals), axis=1)
        self.first = np.concatenate((self.first, len(self.keys) + np.cumsum(many) - many))
        self.many = np.concatenate((self.many, many))
        self.keys = np.concatenate((self.keys, keys))
        self.times = np.concatenate((self.times, times))
        self.good = np.concatenate((self.good, good))
        self.known += len(words)
        if self.spell:
            self.spelled += _spelled(self.of, batch)

    def pairs(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``keys`` of the pairs of the given words, and for each the word's place."""
        many = self.many[numbers]
        ends = np.cumsum(many)
        within = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - many, many)
        return np.repeat(self.first[numbers], many) + within, np.repeat(np.arange(len(numbers)), many)


# Tasks ------------------------------------------------------------------------------------

_BUILT: dict[str, Words] = {}


def _words(shared: Broadcast, name: str, spell: bool) -> Words:
    """The worker's words; groups are spelled where the task needs them."""
    known = _BUILT.get(name)
    if known is None or known.spell != spell:
        _BUILT.clear()
        _BUILT[name] = Words(known.of if known else Tokenizers(*shared.value), spell)
    return _BUILT[name]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in small_batches(batches, "text", BATCH_BYTES):
        yield batch, batch.column("text").to_pylist()


def _combined(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sum of their counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(key) else count


def _count_pairs(shared: Broadcast, name: str, segments: int, space: int):
    """Per task and segment: the pairs of its documents and how many of them hold each."""
    def packed(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        segment = segment_of(keys, segments)
        order = np.argsort(segment, kind="stable")
        some, starts = np.unique(segment[order], return_index=True)
        keys, counts = (np.split(x[order], starts[1:]) for x in (keys, counts))
        task = TaskContext.get().partitionId()
        return pa.RecordBatch.from_pydict({
            "segment": pa.array(some, pa.int32()), "task": pa.array([task] * len(some), pa.int32()),
            "keys": pa.array([x.tobytes() for x in keys[: len(some)]], pa.binary()),
            "counts": pa.array([x.tobytes() for x in counts[: len(some)]], pa.binary())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _words(shared, name, False)
        keys, counts, held = [], [], 0
        for _, texts in _texts(batches):
            numbers, ends = known.read(texts)
            total = max(1, known.known)
            text = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
            once, _ = _counted(text * total + numbers)
            place, word = known.pairs(once % total)
            key, n = _counted(_counted((once // total)[word] * space + known.keys[place])[0] % space)
            keys.append(key)
            counts.append(n)
            held += len(key)
            if held > HELD:
                key, n = _combined(keys, counts)
                keys, counts, held = [key], [n], len(key)
            if held > HELD // 2 and len(keys) == 1:  # combining no longer helps
                yield packed(*_combined(keys, counts))
                keys, counts, held = [], [], 0
        if keys:
            yield packed(*_combined(keys, counts))

    return count


def _arrays(frame: pd.DataFrame, column: str) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int64) for x in frame[column]]


def _distinct(frame: pd.DataFrame) -> np.ndarray:
    return np.unique(np.concatenate(_arrays(frame, "keys")))


def _union(frame: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"segment": frame["segment"].iloc[:1], "keys": [_distinct(frame).tobytes()]})


def _hash_segment(segments: int):
    def build(frame: pd.DataFrame) -> pd.DataFrame:
        keys, segment = _distinct(frame), int(frame["segment"].iloc[0])
        bits, sizes = build_hash(keys)
        row = {"segment": segment, "n": len(keys), "bits": bits.tobytes(), "sizes": sizes.tobytes()}
        ordered = np.empty_like(keys)
        ordered[PairTable(segments, [row]).numbers(keys)] = keys
        return pd.DataFrame([{**row, "keys": ordered.tobytes()}])

    return build


def _dense(segments: int):
    """Counts of one branch of the tree as a vector indexed by hash."""
    def dense(pairs: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        if pairs.empty or index.empty:
            return pd.DataFrame({"segment": [], "counts": []})
        row = index.iloc[0].to_dict()
        table, total = PairTable(segments, [row]), np.zeros(int(row["n"]), np.int64)
        for keys, counts in zip(_arrays(pairs, "keys"), _arrays(pairs, "counts")):
            total[table.numbers(keys)] += counts  # a task's keys are distinct
        return pd.DataFrame({"segment": [row["segment"]], "counts": [total.tobytes()]})

    return dense


def _add(frame: pd.DataFrame) -> pd.DataFrame:
    total = np.sum(_arrays(frame, "counts"), axis=0, dtype=np.int64)
    return pd.DataFrame({"segment": frame["segment"].iloc[:1], "counts": [total.tobytes()]})


def _highest(width: int):
    """The highest count of each A id within a segment."""
    def highest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column("keys"), batch.column("counts")):
                a, n = np.frombuffer(keys.as_py(), np.int64) // width, np.frombuffer(counts.as_py(), np.int64)
                some, place = np.unique(a, return_inverse=True)
                best = np.zeros(len(some), np.int64)
                np.maximum.at(best, place, n)
                yield pa.RecordBatch.from_pydict({"a": some, "best": best})

    return highest


def _report(shared: Broadcast, name: str, lookup: Broadcast):
    """Second pass: alignment of each document and what its links count."""
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _words(shared, name, True)
        table, best = lookup.value
        for rows, texts in _texts(batches):
            numbers, ends = known.read(texts)
            some, where = np.unique(numbers, return_inverse=True)
            place, word = known.pairs(some)
            keys, times = known.keys[place], known.times[place]
            counts = table.look_up(keys)
            top = (counts > 0) & (counts == best[keys // known.of.width])
            borders = np.searchsorted(word, np.arange(len(some)), "right")
            found = [*known.totals[:, some], _sums(np.where(top, times, 0), borders), _sums(counts * times, borders)]
            digests, begin, listed = [], 0, numbers.tolist()
            for end in ends.tolist():
                spelled = ";".join(map(known.spelled.__getitem__, listed[begin:end]))
                digests.append(hashlib.sha256(spelled.encode()).hexdigest() if spelled else "")
                begin = end
            yield pa.RecordBatch.from_arrays(
                [c for n, c in zip(rows.schema.names, rows.columns) if n != "text"]
                + [pa.array(_sums(values[where], ends)) for values in found] + [pa.array(digests)],
                [n for n in rows.schema.names if n != "text"]
                + ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return report


def count_links(spark: SparkSession, docs: DataFrame, shared: Broadcast, name: str, space: int) -> DataFrame:
    """First pass: the table of pairs by segment (segment, n, bits, sizes, keys, counts).

    Distinct pairs are united in a tree of two levels and hashed; the counts of the tasks become
    vectors indexed by hash, which are added up in a tree of the same shape.
    """
    tasks = docs.rdd.getNumPartitions()
    segments = min(SEGMENTS, max(8, tasks))
    branches = max(1, round(tasks**0.5))
    pairs = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        _count_pairs(shared, name, segments, space), "segment int, task int, keys binary, counts binary")
    pairs = stage(spark, pairs, "pairs").withColumn("branch", F.col("task") % branches)
    index_schema = "segment int, n long, bits binary, sizes binary, keys binary"
    united = pairs.select("segment", "branch", "keys").groupBy("segment", "branch").applyInPandas(
        _union, "segment int, keys binary")
    index = stage(spark, united.groupBy("segment").applyInPandas(_hash_segment(segments), index_schema), "hash")
    dealt = index.drop("keys").withColumn("branch", F.explode(F.sequence(F.lit(0), F.lit(branches - 1))))
    dense = pairs.groupBy("segment", "branch").cogroup(dealt.groupBy("segment", "branch")).applyInPandas(
        _dense(segments), "segment int, counts binary")
    counts = dense.groupBy("segment").applyInPandas(_add, "segment int, counts binary")
    return stage(spark, index.join(counts, "segment").withColumn("segments", F.lit(segments)), "pair-counts")


def align_tokens(spark: SparkSession, docs: DataFrame, a_path: str = TOKENIZER_A, b_path: str = TOKENIZER_B,
                 table_mb: int = TABLE_MB) -> DataFrame:
    """Alignment of two tokenizers over whole texts, one row per document.

    A (a byte-level vocabulary in JSON) takes a space and the text, B (a sentence piece model)
    the text, to which it adds the space. Byte offsets at which tokens of both end cut them into
    groups; all A and B tokens of a group are linked. A pair's count is the number of documents
    that hold it linked. Returns doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count
    is the highest of their A id), count_sum and groups_sha256.

    Texts are cut at spaces that open a word, where both tokenizers always cut, and a worker
    aligns each distinct word once (vocabularies that do not cut there get whole texts). Every text
    is read twice: to count and to look up. The tables that go to the tasks (hash,
    keys and counts) are bounded by ``table_mb``; with more pairs the second pass is repeated
    over groups of segments. A pair is a pair of vocabulary ids, so the table has at most
    V_A * V_B entries, and the vector of highest counts V_A. Both files are read on the driver
    and sent to the tasks.

    A null or empty text, or one whose tokens do not spell it, has no tokens: zeros and an empty
    digest. Repeated rows and rows with a null id are documents of their own. Equal counts are
    all highest. An empty table gives an empty result; extra columns play no part.
    """
    with open(a_path, "rb") as a_file, open(b_path, "rb") as b_file:
        files = a_file.read(), b_file.read()
    name = hashlib.sha256(files[0] + files[1]).hexdigest()
    n_a, width = vocabulary_sizes(*files)
    shared = spark.sparkContext.broadcast(files)
    read = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    table = count_links(spark, read, shared, name, n_a * width)
    best = np.zeros(n_a, np.int64)
    for row in table.mapInArrow(_highest(width), "a long, best long").groupBy("a").agg(F.max("best")).collect():
        best[row[0]] = row[1]
    sizes = table.select("segment", "segments", (F.length("bits") * 1.5 + F.col("n") * 16).alias("bytes")).orderBy("segment").collect()
    groups: list[list[int]] = [[]]
    room = table_mb << 20
    for row in sizes:
        if groups[-1] and room < row["bytes"]:
            groups.append([])
            room = table_mb << 20
        groups[-1].append(row["segment"])
        room -= row["bytes"]
    segments = sizes[0]["segments"] if sizes else 1

    def reported(group: list[int], rows: DataFrame) -> DataFrame:
        parts = [r.asDict() for r in table.filter(F.col("segment").isin(group)).orderBy("segment").collect()]
        lookup = spark.sparkContext.broadcast((PairTable(segments, parts), best))
        kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
        return rows.mapInArrow(_report(shared, name, lookup), f"{kept}, {RESULT}")

    if len(groups) == 1:
        return reported(groups[0], read)
    # What a pass finds of a row is added up under its id and a digest of its text; equal rows
    # find the same, so their sum is shared out again.
    keyed = read.withColumn("digest", F.sha2("text", 256))
    passes = [stage(spark, reported(group, keyed), "alignment") for group in groups]
    union = passes[0]
    for other in passes[1:]:
        union = union.unionAll(other)
    fixed = ["n_a", "n_b", "n_groups", "n_links"]
    copies = F.count("*") / len(groups)
    summed = union.groupBy("doc_id", "digest").agg(
        *(F.first(c).alias(c) for c in [*fixed, "groups_sha256"]), copies.cast("int").alias("copies"),
        *((F.sum(c) / copies).cast("long").alias(c) for c in ("n_best", "count_sum")))
    return summed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        "doc_id", *fixed, "n_best", "count_sum", "groups_sha256")
