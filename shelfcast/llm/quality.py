"""Quality scores by a generalised additive model with pairwise interactions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm.common import crc_of_id, small_batches, stage, text_bytes

FIT_ROWS = 20_000  # labelled rows the model is fitted on at most
BAGS = 8
BINS = 64
CELLS = 8  # bins per axis of a pair
ROUNDS, PAIR_ROUNDS = 150, 60
PAIRS = 6
RATE = 0.1
THRESHOLD = 0.3
BATCH_BYTES = 2 << 20

FEATURES = (
    "log_words", "word_length", "letters", "digits", "marks", "capitals", "white", "distinct_words", "top_word",
    "repeated_lines", "line_length", "closed_lines", "marked_words", "repeated_triples", "long_words", "one_letter",
    "bars", "exclamations", "stops", "commas", "top_mark", "repeated_neighbours", "word_spread", "capital_words",
)
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_WHITE = b" \t\n\x0b\x0c\r"


def describe(text: bytes) -> list[float]:
    """Numbers that tell prose from debris in any language. An empty text gives zeros."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    size, n = len(text), len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    white = size - len(text.translate(None, _WHITE))
    dense = size - white
    capitals, small = size - len(text.translate(None, _UPPER)), size - len(text.translate(None, _LOWER))
    digits = size - len(text.translate(None, _DIGITS))
    only_marks = text.translate(None, bytes(c for c in range(256) if c not in _MARKS))
    marks = len(only_marks)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    triples = set(zip(words, words[1:], words[2:]))
    ends = sum(x.rstrip()[-1:] in b".!?" for x in lines)
    marked = sum(w[-1:] in b"#$%&*@|~^<>=+_/\\" for w in words)
    return [
        float(np.log1p(n)), dense / n, (dense - marks - digits) / dense, digits / dense, marks / dense,
        capitals / max(1, capitals + small), white / size, len(counts) / n, max(counts.values()) / n,
        1 - len(set(lines)) / len(lines), float(np.log1p(size / len(lines))), ends / len(lines), marked / n,
        1 - len(triples) / max(1, n - 2) if n > 2 else 0.0, float((lengths > 12).mean()), float((lengths == 1).mean()),
        text.count(b"|") / dense, text.count(b"!") / dense, text.count(b".") / n, text.count(b",") / n,
        max((only_marks.count(m) for m in set(only_marks)), default=0) / dense,
        sum(a == b for a, b in zip(words, words[1:])) / n, float(lengths.std()),
        sum(w[:1].isupper() for w in words) / n,
    ]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "bytes", BATCH_BYTES):
        rows = [describe(x) for x in batch.column("bytes").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "features"])


def bin_edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Inner borders of bins of about equal counts."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.zeros(0)


def _cut(gradient: np.ndarray, hessian: np.ndarray) -> tuple[float, int]:
    """Best gain of one cut of ordered bins, and how many bins are on its left side."""
    if len(gradient) < 2:
        return 0.0, 0
    g, h = np.cumsum(gradient), np.cumsum(hessian)
    left = g[:-1] ** 2 / (h[:-1] + 1)
    right = (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1)
    gain = left + right - g[-1] ** 2 / (h[-1] + 1)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _leaf(gradient: np.ndarray, hessian: np.ndarray) -> float:
    return float(gradient.sum() / (hessian.sum() + 1))


def shallow_tree(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    """Newton steps of a tree of depth two over ordered bins, as one value per bin."""
    step = np.full(len(gradient), _leaf(gradient, hessian))
    gain, at = _cut(gradient, hessian)
    if gain > 0:
        for a, b in ((0, at), (at, len(gradient))):
            gain, below = _cut(gradient[a:b], hessian[a:b])
            cuts = [a, a + below, b] if gain > 0 else [a, b]
            for x, y in zip(cuts[:-1], cuts[1:]):
                step[x:y] = _leaf(gradient[x:y], hessian[x:y])
    return step


def pair_tree(gradient: np.ndarray, hessian: np.ndarray) -> tuple[float, np.ndarray]:
    """The same over a grid: a cut along one axis, then one along the other on either side."""
    best = (0.0, np.full(gradient.shape, _leaf(gradient, hessian)))
    for turned in (False, True):
        g, h = (gradient.T, hessian.T) if turned else (gradient, hessian)
        base = g.sum() ** 2 / (h.sum() + 1)
        for at in range(1, len(g)):
            gain, step = -base, np.empty(g.shape)
            for part in (slice(0, at), slice(at, len(g))):
                gs, hs = g[part].sum(0), h[part].sum(0)
                more, below = _cut(gs, hs)
                gain += gs.sum() ** 2 / (hs.sum() + 1) + more
                step[part, :below] = _leaf(gs[:below], hs[:below]) if below else 0
                step[part, below:] = _leaf(gs[below:], hs[below:])
            if gain > best[0]:
                best = (float(gain), step.T if turned else step)
    return best


def fit_tables(features: np.ndarray, labels: np.ndarray, seed: int) -> dict:
    """Lookup tables of one bag: cyclic boosting of one shallow tree per feature and round, then
    of the pairs of features that explain most of what is left."""
    edges = [bin_edges(x, BINS) for x in features.T]
    coarse = [bin_edges(x, CELLS) for x in features.T]
    draw = np.random.default_rng(seed).integers(0, len(labels), len(labels)) if len(labels) else np.zeros(0, int)
    x, y = features[draw], labels[draw]
    bins = [np.searchsorted(e, c, "right") for e, c in zip(edges, x.T)]
    cells = [np.searchsorted(e, c, "right") for e, c in zip(coarse, x.T)]
    share = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(share / (1 - share)))
    tables = [np.zeros(len(e) + 1) for e in edges]
    raw = np.full(len(y), start)

    def sums(where: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-raw))
        return np.bincount(where, y - p, n), np.bincount(where, p * (1 - p), n)

    for _ in range(ROUNDS if len(y) else 0):
        for f, table in enumerate(tables):
            if len(table) > 1:
                step = RATE * shallow_tree(*sums(bins[f], len(table)))
                table += step
                raw += step[bins[f]]
    gains = []
    for a in range(len(tables)):
        for b in range(a + 1, len(tables)):
            shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
            if min(shape) > 1 and len(y):
                g, h = sums(cells[a] * shape[1] + cells[b], shape[0] * shape[1])
                gains.append((pair_tree(g.reshape(shape), h.reshape(shape))[0], a, b, shape))
    pairs = [(a, b, shape, np.zeros(shape)) for _, a, b, shape in sorted(gains, key=lambda x: -x[0])[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for a, b, shape, table in pairs:
            where = cells[a] * shape[1] + cells[b]
            g, h = sums(where, shape[0] * shape[1])
            step = RATE * pair_tree(g.reshape(shape), h.reshape(shape))[1]
            table += step
            raw += step.ravel()[where]
    return {
        "start": start, "edges": [e.tolist() for e in edges], "tables": [t.tolist() for t in tables],
        "coarse": [e.tolist() for e in coarse], "first": [p[0] for p in pairs], "second": [p[1] for p in pairs],
        "grids": [p[3].ravel().tolist() for p in pairs],
    }


_MODEL = ("start double, edges array<array<double>>, tables array<array<double>>, coarse array<array<double>>, "
          "first array<int>, second array<int>, grids array<array<double>>")


def _fit(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["place", "doc_id"])  # the same order on every run
    features = np.stack(rows["features"].to_numpy())
    return pd.DataFrame([fit_tables(features, rows["label"].to_numpy(float), int(rows["bag"].iloc[0]))])


def chances(models: list[dict], x: np.ndarray) -> np.ndarray:
    """Scores of rows of features: table values added up, averaged over the models."""
    raw = np.zeros(len(x))
    for m in models:
        raw += m["start"]
        for e, t, c in zip(m["edges"], m["tables"], x.T):
            raw += np.asarray(t)[np.searchsorted(e, c, "right")]
        for a, b, grid in zip(m["first"], m["second"], m["grids"]):
            row = np.searchsorted(m["coarse"][a], x[:, a], "right")
            at = np.searchsorted(m["coarse"][b], x[:, b], "right")
            raw += np.asarray(grid)[row * (len(m["coarse"][b]) + 1) + at]
    return 1 / (1 + np.exp(-raw / max(1, len(models))))


def _score(shared: Broadcast) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("features").flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(chances(shared.value, x))], ["doc_id", "score"])

    return score


def _score_rows(shared: Broadcast) -> Callable:
    """The same from the texts, with the whole rows passed on."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "bytes", BATCH_BYTES):
            x = np.array([describe(t) for t in batch.column("bytes").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(chances(shared.value, x)), batch.column("row")],
                ["doc_id", "score", "row"])

    return score


def fit_quality(spark: SparkSession, described: DataFrame, labels: DataFrame, modulus: int = 5,
                fit_rows: int = FIT_ROWS, bags: int = BAGS) -> list[dict]:
    """Lookup tables of ``bags`` models (their raw scores are averaged), from labelled documents
    whose crc32(doc_id as text) mod ``modulus`` is not 0.

    At most ``fit_rows`` documents are used, those with the smallest hash of their id. Each bag
    is fitted in a task of its own on a sample with repetition. Labels that are null are no
    labels; a document with several counts as good if any of them is. No labels, no models.
    """
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").alias("labelled")).agg(F.max("quality").alias("label"))
    learn = known.filter(crc_of_id(F.col("labelled")) % modulus != 0).withColumn("place", F.xxhash64("labelled"))
    sample = stage(spark, learn.orderBy("place", "labelled").limit(fit_rows), "quality-labels")
    rows = described.join(sample, F.col("doc_id") == F.col("labelled")).select(
        "doc_id", "features", "label", "place", F.explode(F.sequence(F.lit(0), F.lit(bags - 1))).alias("bag"))
    fitted = rows.groupBy("bag").applyInPandas(_fit, _MODEL).collect()
    return sorted((r.asDict() for r in fitted), key=lambda m: str(m))


def score_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, modulus: int = 5,
                  threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS, whole_rows: bool = False) -> DataFrame:
    """Quality of whole texts: doc_id, held_out, score (chance of label 1), predicted; with
    ``whole_rows`` also the input row as a struct ``row``.

    Features are counted from the text alone. A score adds one table value per feature and one
    per chosen pair. ``held_out`` marks remainder 0 of the id's crc32, which no label is taken
    from (a null id too). A null or empty text has all features 0 and gets a score as well.
    Without labels every score is 0.5. Repeated rows are scored each, but all of them count in
    the fit. An empty table gives an empty result.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select("doc_id", text_bytes(F.col("text")).alias("bytes"))
    described = stage(spark, read.mapInArrow(_describe, f"doc_id {id_type}, features array<double>"), "quality-features")
    shared = spark.sparkContext.broadcast(fit_quality(spark, described, labels, modulus, fit_rows))
    if whole_rows:
        rows = docs.select("doc_id", text_bytes(F.col("text")).alias("bytes"), F.struct(*docs.columns).alias("row"))
        scored = rows.mapInArrow(
            _score_rows(shared), f"doc_id {id_type}, score double, row {docs.schema.simpleString()}")
    else:
        scored = described.mapInArrow(_score(shared), f"doc_id {id_type}, score double")
    return scored.select(
        "doc_id", (crc_of_id(F.col("doc_id")) % modulus == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), *(["row"] if whole_rows else []))
