"""Exact top-k inner product search on an impact-ordered, score-at-a-time index."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfcast.llm.common import stage

CHUNK = 8192  # vectors indexed together
BLOCK = 2048  # queries that meet a chunk together
TOGETHER = 256  # queries of a block whose scores are held at a time
BITS = 5  # of a quantised impact; each has postings of its own
GROUPS = 128  # runs of vectors whose best scores give the floor of a query
ROUNDING = 1e-9  # share of a score by which sums of doubles may be off
# Sums of float64 products stay whole numbers below this.
EXACT = 2.0**53


class ImpactIndex:
    """Postings of one chunk, ordered by impact: for every bit of the quantised components, the
    highest first, a bitmap per dimension of the vectors that have it.

    A query scores every vector by its quantised distance from the end of the range that is
    worst for the query, so the impact of a posting, |q| times the step times the worth of its
    bit, is never negative and a running score is a lower bound. The distance from the upper end
    has the opposite bits, so one set of postings serves both signs. Queries of a block are
    scored together, a bit at a time.
    """

    def __init__(self, vectors: np.ndarray):
        self.low, high = vectors.min(0), vectors.max(0)
        self.step = np.maximum(1, -(-(high - self.low + 1) // 2**BITS)).astype(np.int64)
        levels = ((vectors - self.low) // self.step).T
        self.postings = [(levels >> bit & 1).astype(np.uint8) for bit in range(BITS)]

    def possible(self, queries: np.ndarray, k: int, own: list[np.ndarray]) -> list[np.ndarray]:
        """For each query, numbers of the vectors that can be among the k best; ``own`` are those
        of the query itself, which are left out."""
        n = self.postings[0].shape[1]
        weight = queries.astype(float) * self.step
        whole = np.abs(weight).sum(1)
        slack = np.abs(queries.astype(float)) @ (self.step - 1.0) + ROUNDING * 2**BITS * whole
        negative = np.maximum(-weight, 0).sum(1)
        found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
        active = np.arange(len(queries))
        score = np.zeros((len(queries), n))
        for i, mine in enumerate(own):
            score[i, mine] = -np.inf
        for bit in reversed(range(BITS)):
            score += 2.0**bit * (weight[active] @ self.postings[bit].astype(float) + negative[active, None])
            # What bits not yet seen can add to a score that is known from below.
            more = (2.0**bit - 1) * whole[active] + slack[active]
            floor = _floors(score, k)
            cut = floor - more
            least = score.min(1, initial=np.inf, where=score > -np.inf)
            hopeful = (least < cut) | (bit == 0)
            done = []
            for i in np.flatnonzero(hopeful):
                left = np.flatnonzero((score[i] >= cut[i]) & (score[i] > -np.inf))
                if bit == 0 or len(left) <= 8 * k:  # proof: nobody else can reach the k-th best
                    found[active[i]] = left
                    done.append(i)
            if done:
                score = np.delete(score, done, 0)
                active = np.delete(active, done)
            if not len(active):
                break
        return found


def _floors(score: np.ndarray, k: int) -> np.ndarray:
    """For each row a bound that its k-th highest score reaches: the k-th of the best of groups."""
    n = score.shape[1]
    if n < 2 * GROUPS or k > GROUPS:
        return np.partition(score, -k, 1)[:, -k] if n >= k else np.full(len(score), -np.inf)
    best = np.maximum.reduceat(score, np.arange(GROUPS) * n // GROUPS, 1)
    return np.partition(best, -k, 1)[:, -k]


def _exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products; whole-number arithmetic without limit where doubles may round."""
    bound = float(np.abs(query.astype(float)) @ np.abs(vectors.astype(float)).max(0)) if len(vectors) else 0
    if bound < EXACT:
        return (vectors.astype(float) @ query.astype(float)).astype(np.int64)
    wide = vectors.astype(object) @ query.astype(object)
    return np.array([max(-(2**63), min(2**63 - 1, int(x))) for x in wide], np.int64)


def _search(k: int):
    def search(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = [np.zeros((3, 0), np.int64)]
        if len(vectors) and len(queries):
            ids = vectors["vec_id"].to_numpy(np.int64)
            matrix = np.stack(vectors["parts"].to_numpy()).astype(np.int64)
            asked = np.stack(queries["parts"].to_numpy()).astype(np.int64)
            names = queries["vec_id"].to_numpy(np.int64)
            order = np.argsort(ids, kind="stable")
            begin, end = (np.searchsorted(ids[order], names, side) for side in ("left", "right"))
            small = np.abs(matrix.astype(float)).max(initial=0) < 2.0**24
            index = ImpactIndex(matrix) if small and matrix.shape[1] else None
            plain = (np.abs(asked.astype(float)).max(1, initial=0) >= 2.0**24) | (index is None)

            def add(i: int, left: np.ndarray) -> None:
                score = _exact(matrix[left], asked[i])
                best = np.lexsort((ids[left], -score))[:k]
                found.append(np.stack([np.full(len(best), names[i]), ids[left][best], score[best]]))

            for i in np.flatnonzero(plain):
                add(i, np.flatnonzero(ids != names[i]))
            indexed = np.flatnonzero(~plain)
            for at in range(0, len(indexed), TOGETHER):
                some = indexed[at : at + TOGETHER]
                for i, left in zip(some, index.possible(asked[some], k, [order[begin[i] : end[i]] for i in some])):
                    add(i, left)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), np.concatenate(found, 1))))

    return search


def whole_vectors(table: DataFrame) -> DataFrame:
    """vec_id and floor(256 * component), for vectors without null or non-finite components.

    Repeated rows (same id and vector) count once.
    """
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        table.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .filter(~odd)
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(
            "embedding", lambda x: F.floor(x.cast("double") * 256)).alias("parts"))
        .distinct()
    )


def top_k(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 5, chunk: int = CHUNK,
          block: int = BLOCK) -> DataFrame:
    """The k highest integer inner products of each query (all, if fewer), without its own id.

    Both inputs: vec_id long, parts array<long>. Returns query_id, rank (from 1), vec_id, score;
    ties go to the smaller vec_id. Only vectors with as many components as the query compete.

    Vectors are dealt to chunks and queries to blocks of bounded size by a hash; every block
    meets every chunk in a task of its own. The chunk's postings are read by descending impact,
    for many queries at once, until at most 8k vectors can still be among the k best of a query,
    or to the end; these are scored
    exactly. A score beyond 64 bits is cut to them. Empty tables give empty results.
    """
    vectors = stage(spark, vectors.withColumn("dims", F.size("parts")), "vectors")
    queries = stage(spark, queries.withColumn("dims", F.size("parts")), "queries")
    chunks = max(1, -(-vectors.count() // chunk))
    blocks = max(1, -(-queries.count() // block))
    place = F.xxhash64("vec_id", "parts")
    left = vectors.withColumn("c", F.pmod(place, F.lit(chunks))).withColumn(
        "b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = queries.withColumn("b", F.pmod(place, F.lit(blocks)).cast("int")).withColumn(
        "c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
    found = left.groupBy("dims", "c", "b").cogroup(right.groupBy("dims", "c", "b")).applyInPandas(
        _search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
