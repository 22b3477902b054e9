"""Near-duplicate documents by chosen-path set similarity join over minwise tokens."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.llm.common import (
    Vocabulary, byte_words, components, fresh_names, maybe_among, mixed, runs, small_batches, stage, text_bytes,
)

WIDTH = 4
PERCENT = 80  # of the union that the intersection must reach
TREES = 12  # independent trees; each starts from a minwise token of its own
BRANCHES = 3  # tokens by which a large node's documents are branched further
TOKENS = 24  # minwise tokens to choose paths from
SKETCH = 64  # bytes of the sketch by which small nodes are compared
# A pair at the threshold agrees in 51 of 64 places on average; 36 lies 4.7 deviations below.
ALIKE = 36
NODE = 1024  # documents of a node that is compared exhaustively
DENSE = 0.1  # share of a node alike to its head from which it is linked as a whole
DEPTH = 4
CLUSTER = 256  # documents whose full sets one task compares
PIVOTS = 64
BATCH_BYTES = 1 << 20
LINKS = 1 << 20  # links that one task turns into stars at a time

_U = np.uint64
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of all texts, sorted and distinct within each, and the
    number of each. A text with fewer words is one shingle, one without words has none."""
    vocabulary = Vocabulary()
    numbers: list[int] = []
    lengths = []
    for text in texts.to_pylist():
        words = byte_words(text)
        numbers.extend(map(vocabulary.__getitem__, words))
        lengths.append(len(words))
    hashes = vocabulary.hashes()[np.array(numbers, np.int64)] if numbers else np.zeros(0, np.uint64)
    lengths = np.array(lengths, np.int64)
    starts = np.cumsum(lengths) - lengths
    place = mixed(np.arange(1, width + 1, dtype=np.uint64) * _PLACES[0])
    count = np.where(lengths >= width, lengths - width + 1, np.minimum(lengths, 1))
    owner = np.repeat(np.arange(len(lengths)), count)
    first = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + starts[owner]
    whole = np.zeros(len(first), np.uint64)
    for i in range(width):
        inside = lengths[owner] > i
        at = np.minimum(first + i, max(len(hashes) - 1, 0))
        whole += np.where(inside, mixed(hashes[at] + place[i]), _U(0)) if len(first) else whole
    whole = mixed(whole)
    order = np.lexsort((whole, owner))
    whole, owner = whole[order], owner[order]
    new = np.ones(len(whole), bool)
    new[1:] = (whole[1:] != whole[:-1]) | (owner[1:] != owner[:-1])
    return whole[new], np.bincount(owner[new], minlength=len(lengths))


def _digests(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each (non-empty) set: a sum of mixed members, mixed again."""
    return mixed(np.add.reduceat(mixed(sets ^ _PLACES[1]), starts) ^ _PLACES[2])


def _sketch(width: int) -> Callable:
    factors = mixed(np.arange(1, SKETCH + 1, dtype=np.uint64) * _PLACES[3]) | _U(1)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "bytes", BATCH_BYTES):
            sets, counts = shingle_sets(batch.column("bytes"), width)
            some = counts > 0
            starts = (np.cumsum(counts) - counts)[some]
            digest = np.zeros(len(counts), np.int64)
            least = np.zeros((int(some.sum()), SKETCH), np.uint64)
            if len(starts):
                digest[some] = _digests(sets, starts).view(np.int64)
                for i, factor in enumerate(factors):
                    x = sets * factor
                    least[:, i] = np.minimum.reduceat(x ^ (x >> _U(32)), starts)
            least = mixed(least)
            offsets = np.concatenate(([0], np.cumsum(np.where(some, TOKENS, 0)))).astype(np.int32)
            sketches = np.ascontiguousarray((least & _U(255)).astype(np.uint8))
            rows, at = [], 0
            for x in some:
                rows.append(sketches[at].tobytes() if x else None)
                at += x
            tokens = np.ascontiguousarray(least[:, :TOKENS]).view(np.int64).ravel()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(counts), pa.array(digest, mask=~some),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens)), pa.array(rows, pa.binary())],
                ["doc_id", "mark", "n_shingles", "class", "tokens", "sketch"])

    return sketch


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of equal keys in sorted batches, each as one frame."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        frame = batch.to_pandas()
        if not len(frame):
            continue
        codes = frame.groupby(keys, sort=False).ngroup().to_numpy()
        cuts = runs(codes)
        if held and (held[-1][keys].iloc[-1] != frame[keys].iloc[0]).any():
            yield pd.concat(held)
            held = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            held.append(frame.iloc[a:b])
            if b < len(frame):
                yield pd.concat(held)
                held = []
    if held:
        yield pd.concat(held)


class Forest:
    """Union-find over the places of one list."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _stars(most: int) -> Callable:
    """Links of a task as stars around the smallest node reached, about ``most`` links at a time."""

    def star(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        forest = Forest(len(nodes))
        for x, y in zip(*at.reshape(2, -1).tolist()):
            forest.join(x, y)
        roots = np.array([forest.root(x) for x in range(len(nodes))])
        hung = roots != np.arange(len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[hung]), pa.array(nodes[roots[hung]])], ["a", "b"])

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
            rows += batch.num_rows
            if rows >= most:
                yield star(*map(np.concatenate, zip(*held)))
                held, rows = [], 0
        if rows:
            yield star(*map(np.concatenate, zip(*held)))

    return stars


def joined_links(spark: SparkSession, links: DataFrame, most: int = LINKS) -> DataFrame:
    """Connected components of ``links`` (a, b: long): one row (node, root) per linked node, root
    being the smallest node reachable.

    Links become stars in the tasks that find them, then again after they are dealt by node over
    one task per ``most`` of them. If that is a single task, its stars are the answer, being whole
    if it took them at once; otherwise :func:`components` joins what the tasks found. An empty
    table gives an empty table.
    """
    found = links.select("a", "b").filter("a <> b").mapInArrow(_stars(most), "a long, b long")
    found = stage(spark, found, "nd-stars")
    tasks = -(-found.count() // most) or 1
    if tasks > 1:
        return components(spark, found.repartition(tasks, "a").mapInArrow(_stars(most), "a long, b long"))
    # One task holds at most ``most`` links, so it takes them at once: the limit lies beyond.
    whole = stage(spark, found.repartition(1).mapInArrow(_stars(most + 1), "a long, b long").select(
        F.col("a").alias("node"), F.col("b").alias("root")), "nd-stars")
    return whole.unionAll(whole.select(F.col("root").alias("node"), "root").distinct())


def _matrix(sketches: pd.Series | list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), SKETCH)


def _alike(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    return (one[None, :] == many).sum(1) >= ALIKE


def _alike_to_head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            one, head = (_matrix(batch.column(c).to_pylist()) for c in ("sketch", "head_sketch"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(((one == head).sum(1) >= ALIKE).astype(np.int32))], ["path", "alike"])


def _links_of_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A forest over the alike members of each node: as many links as members at most."""
    for node in _groups(batches, ["path"]):
        classes, matrix = node["class"].to_numpy(), _matrix(node["sketch"])
        left = np.arange(len(classes))
        a, b = [], []
        while len(left) > 1:
            reached, left = [left[0]], left[1:]
            while reached and len(left):
                x = reached.pop()
                near = _alike(matrix[x], matrix[left])
                a.extend(classes[left[near]])
                b.extend([classes[x]] * int(near.sum()))
                reached.extend(left[near])
                left = left[~near]
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int((y[at] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _sets(column: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column]


def _links_of_clusters(percent: int) -> Callable:
    """Verified links that span the components of each small cluster."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cluster in _groups(batches, ["cluster"]):
            classes, matrix, sets = cluster["class"].to_numpy(), _matrix(cluster["sketch"]), _sets(cluster["members"])
            forest, a, b = Forest(len(sets)), [], []
            for i in range(1, len(sets)):
                for j in np.flatnonzero(_alike(matrix[i], matrix[:i])):
                    if forest.root(i) != forest.root(int(j)) and linked(sets[i], sets[j], percent):
                        forest.join(i, int(j))
                        a.append(classes[i])
                        b.append(classes[j])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return link


def _links_to_pivots(percent: int) -> Callable:
    """Verified links between a block of members and a block of pivots, one pivot after
    another. Pairs that are connected already are passed over."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _groups(batches, ["cluster", "block", "pivot_block"]):
            members, pivots = block[~block["pivot"]], block[block["pivot"]]
            if not len(members) or not len(pivots):
                continue
            classes, matrix, sets = members["class"].to_numpy(), _matrix(members["sketch"]), _sets(members["members"])
            known = {r: i for i, r in enumerate(pd.unique(np.concatenate([members["root"], pivots["root"]])))}
            root = members["root"].map(known).to_numpy()
            forest, a, b = Forest(len(known)), [], []
            for name, sketch, member, r in zip(pivots["class"], _matrix(pivots["sketch"]), _sets(pivots["members"]), pivots["root"]):
                for i in np.flatnonzero(_alike(sketch, matrix)):
                    if forest.root(known[r]) != forest.root(int(root[i])) and linked(sets[i], member, percent):
                        forest.join(known[r], int(root[i]))
                        a.append(classes[i])
                        b.append(name)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return link


def _members(width: int) -> Callable:
    """Full sets of the documents that stand for a class; others with the same id are left out."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "bytes", BATCH_BYTES):
            sets, counts = shingle_sets(batch.column("bytes"), width)
            ends = np.cumsum(counts)
            wanted = batch.column("class").to_numpy()
            some = counts > 0
            digest = np.zeros(len(counts), np.int64)
            if some.any():
                digest[some] = _digests(sets, (ends - counts)[some]).view(np.int64)
            good = np.flatnonzero(some & (digest == wanted))
            yield pa.RecordBatch.from_arrays(
                [batch.column("class").take(pa.array(good)), batch.column("cluster").take(pa.array(good)),
                 batch.column("size").take(pa.array(good)), batch.column("sketch").take(pa.array(good)),
                 pa.array([sets[ends[i] - counts[i] : ends[i]].tobytes() for i in good], pa.binary())],
                ["class", "cluster", "size", "sketch", "members"])

    return members


def _of_classes(paths: DataFrame, columns: DataFrame) -> DataFrame:
    """Paths (path, class) with ``columns`` (c and others) of their class. A class has as many paths
    as trees and branches at most; they are joined as one row."""
    listed = paths.groupBy("class").agg(F.collect_list("path").alias("paths"))
    return listed.join(columns, F.col("class") == F.col("c")).drop("c").withColumn(
        "path", F.explode("paths")).drop("paths")


def loose_links(spark: SparkSession, classes: DataFrame) -> DataFrame:
    """Links (a, b) whose components hold those of the true links, by chosen paths.

    Every tree starts with one minwise token: documents with the same value share a node. A
    node of up to ``NODE`` documents is compared exhaustively by sketches, in one task, which
    passes on a forest. In a larger node all documents are compared with its head. If many are
    alike to it, branching would not make the node smaller, so the whole node is linked to its
    head; the exact step tells its documents apart. Otherwise its documents branch by
    ``BRANCHES`` more tokens chosen by a hash of its path. What still shares a large node after
    ``DEPTH`` tokens is linked to the head as well.
    """
    tokens = F.transform(F.slice("tokens", 1, TREES), lambda x, i: F.xxhash64(i, x))
    paths = classes.select("class", F.explode(tokens).alias("path"))
    found, smalls = [], []
    for depth in range(1, DEPTH + 1):
        paths = stage(spark, paths, "nd-paths")  # a path tells its parent and place, so no row comes twice
        sizes = stage(spark, paths.groupBy("path").agg(
            F.count(F.lit(1)).alias("n"), F.min("class").alias("head")).filter("n > 1")
            .withColumnRenamed("path", "p"), "nd-nodes")
        smalls.append(paths.join(sizes.filter(F.col("n") <= NODE), F.col("path") == F.col("p")).select("path", "class"))
        nodes = sizes.filter(F.col("n") > NODE)
        if nodes.isEmpty():
            break
        nodes = stage(spark, nodes.select("p", "head"), "nd-large-nodes")
        large = stage(spark, paths.join(nodes, F.col("path") == F.col("p")).select("path", "class", "head"), "nd-large")
        sketches = classes.select(F.col("class").alias("c"), "sketch")
        heads = stage(spark, nodes.join(sketches, F.col("head") == F.col("c")).select(
            F.col("p").alias("q"), F.col("sketch").alias("head_sketch")), "nd-heads")
        alike = _of_classes(large, sketches).join(heads, F.col("path") == F.col("q")).select(
            "path", "sketch", "head_sketch").mapInArrow(_alike_to_head, "path long, alike int")
        dense = stage(spark, alike.groupBy(F.col("path").alias("q")).agg(F.avg("alike").alias("share")).filter(
            F.lit(depth == DEPTH) | (F.col("share") >= DENSE)).select("q"), "nd-dense")
        found.append(large.join(dense, F.col("path") == F.col("q")).select(
            F.col("class").alias("a"), F.col("head").alias("b")))
        sparse = _of_classes(large.join(dense, F.col("path") == F.col("q"), "left_anti"),
                             classes.select(F.col("class").alias("c"), "tokens"))
        chosen = F.array_distinct(F.array(*[F.pmod(F.xxhash64("path", F.lit(i)), F.lit(TOKENS)) for i in range(BRANCHES)]))
        paths = sparse.select("class", F.explode(F.transform(
            chosen, lambda i: F.xxhash64("path", i, F.element_at("tokens", (i + 1).cast("int"))))).alias("path"))
    # Nodes of all depths are compared together.
    small = _of_classes(reduce(DataFrame.unionAll, smalls), classes.select(F.col("class").alias("c"), "sketch"))
    found.append(small.select("path", "class", "sketch").repartition("path")
                 .sortWithinPartitions("path").mapInArrow(_links_of_nodes, "a long, b long"))
    return reduce(DataFrame.unionAll, found)


def _blocks(spark: SparkSession, members: DataFrame, pivots: DataFrame) -> DataFrame:
    """Members of large clusters and pivots of the same cluster, both dealt into blocks of about
    ``CLUSTER``, so that every member meets every pivot in one group (cluster, block, pivot_block)."""
    counted = stage(spark, pivots.groupBy(F.col("cluster").alias("k")).agg(
        F.ceil(F.count(F.lit(1)) / CLUSTER).cast("int").alias("pivot_blocks")), "nd-pivot-blocks")
    blocks = F.ceil(F.col("size") / CLUSTER).cast("int")

    def dealt(rows: DataFrame, block: Column, pivot_block: Column, pivot: bool) -> DataFrame:
        return rows.join(counted, F.col("cluster") == F.col("k")).withColumn("block", block).withColumn(
            "pivot_block", pivot_block).select(
            "cluster", "block", "pivot_block", F.lit(pivot).alias("pivot"), "class", "root", "sketch", "members")

    held = dealt(members, F.pmod(F.xxhash64("class", F.lit(7)), blocks).cast("int"),
                 F.explode(F.sequence(F.lit(0), F.col("pivot_blocks") - 1)), False)
    met = dealt(pivots, F.explode(F.sequence(F.lit(0), blocks - 1)),
                F.pmod(F.xxhash64("class", F.lit(11)), F.col("pivot_blocks")).cast("int"), True)
    return held.unionAll(met)


def _to_pivots(spark: SparkSession, members: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """Links between all members of large clusters and the pivots of the same cluster."""
    return (
        _blocks(spark, members, pivots).repartition("cluster", "block", "pivot_block")
        .sortWithinPartitions("cluster", "block", "pivot_block")
        .mapInArrow(_links_to_pivots(percent), "a long, b long")
    )


def _large_links(spark: SparkSession, members: DataFrame, percent: int) -> DataFrame:
    """Links that span the components of clusters too large for one task.

    First all members meet about ``PIVOTS`` random pivots, which connects groups of near copies.
    Then every member outside its cluster's largest component meets all members. A true link
    between two components has an end of that kind, so none is lost.
    """
    share = F.ceil(F.col("size") / PIVOTS)
    pivots = members.filter(F.pmod(F.xxhash64("class", F.lit(3)), share) == 0)
    alone = [x.withColumn("root", F.col("class")) for x in (members, pivots)]
    first = stage(spark, _to_pivots(spark, *alone, percent), "nd-first")
    roots = stage(spark, joined_links(spark, first), "nd-roots")
    rooted = members.join(roots, F.col("class") == F.col("node"), "left").withColumn(
        "root", F.coalesce("root", "class")).drop("node")
    rooted = stage(spark, rooted, "nd-rooted")
    largest = stage(spark, rooted.groupBy("cluster", "root").count().groupBy(F.col("cluster").alias("k")).agg(
        F.max_by("root", F.struct("count", "root")).alias("main")), "nd-main")
    outside = rooted.join(largest, (F.col("cluster") == F.col("k")) & (F.col("root") == F.col("main")), "left_anti")
    return first.unionAll(stage(spark, _to_pivots(spark, rooted, outside, percent), "nd-second"))


def near_duplicates(spark: SparkSession, docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Components of documents whose word-shingle sets have a similarity of ``percent`` or more.

    Returns doc_id, n_shingles, component_id (smallest doc_id of the component) and kept.

    Equal sets are one class from the start, by a 64-bit digest. Chosen paths over minwise
    tokens give loose clusters (:func:`loose_links`); a pair at the threshold is missed by all
    trees with a chance of about 0.2 ** 12 in small nodes. Only then full sets are made again,
    for classes in clusters, each shipped once. Small clusters are compared in one task, larger
    ones by blocks against pivots. Every link is confirmed on full sets of 64-bit shingle hashes.

    A text without words (or null) has no shingles, and is its own component. A null id is never
    the smallest unless all ids of the component are null. Rows with equal id and text share
    their fate, so all of them are kept if one is. An empty table gives an empty result.
    """
    text = text_bytes(F.col("text"))
    read = docs.select("doc_id", text.alias("bytes"), F.xxhash64(text).alias("mark"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = stage(spark, read.mapInArrow(_sketch(width), (
        f"doc_id {id_type}, mark long, n_shingles long, class long, tokens array<long>, sketch binary")), "nd-sketches")
    classes = stage(spark, rows.filter(F.col("class").isNotNull()).groupBy("class").agg(
        F.min("doc_id").alias("least_id"),
        F.coalesce(F.min_by("mark", "doc_id"), F.min("mark")).alias("least_mark"), F.any_value("tokens").alias("tokens"),
        F.any_value("sketch").alias("sketch")), "nd-classes")
    clusters = stage(spark, joined_links(spark, loose_links(spark, classes)), "nd-clusters")
    sizes = stage(spark, clusters.groupBy(F.col("root").alias("cluster")).agg(
        F.count(F.lit(1)).alias("size")), "nd-sizes")
    chosen = (
        clusters.join(sizes, F.col("root") == F.col("cluster")).select(F.col("node").alias("class"), "cluster", "size")
        .join(classes.select(F.col("class").alias("c"), "least_id", "least_mark", "sketch"), F.col("class") == F.col("c")).drop("c"))
    chosen = stage(spark, chosen, "nd-chosen")
    # By id and text: rows without an id, or with the same one, meet their own class only.
    same = F.col("doc_id").eqNullSafe(F.col("least_id")) & (F.col("mark") == F.col("least_mark"))
    wanted = chosen.select(F.xxhash64("least_id", "least_mark").alias("key"))
    few = maybe_among(read, F.xxhash64("doc_id", "mark"), wanted, "maybe").filter("maybe").drop("maybe")
    members = stage(spark, few.join(chosen, same).select(
        "bytes", "class", "cluster", "size", "sketch").mapInArrow(
        _members(width), "class long, cluster long, size long, sketch binary, members binary")
        .dropDuplicates(["class"]), "nd-members")
    links = members.filter(F.col("size") <= CLUSTER).repartition("cluster").sortWithinPartitions("cluster").mapInArrow(
        _links_of_clusters(percent), "a long, b long")
    if not sizes.filter(F.col("size") > CLUSTER).isEmpty():
        links = links.unionAll(_large_links(spark, members.filter(F.col("size") > CLUSTER), percent))
    roots = stage(spark, joined_links(spark, links), "nd-final")
    named = roots.join(classes.select("class", "least_id"), F.col("node") == F.col("class"))
    least = stage(spark, named.groupBy(F.col("root").alias("r")).agg(F.min("least_id").alias("lowest")), "nd-least")
    linked_classes = stage(spark, roots.join(least, F.col("root") == F.col("r")).select(
        F.col("node").alias("class"), "lowest"), "nd-linked")
    answer = classes.select("class", "least_id").join(linked_classes, "class", "left").select(
        F.col("class").alias("c"), F.coalesce("lowest", "least_id").alias("lowest"))
    answer = stage(spark, answer, "nd-answer")
    out = rows.select("doc_id", "n_shingles", "class").join(answer, F.col("class") == F.col("c"), "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("lowest"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def distinct_documents(spark: SparkSession, docs: DataFrame, **settings) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id.

    Documents are told apart by id and a digest of their text. Of rows that repeat both, one is
    kept. Documents without words are all kept.
    """
    named = docs.select(F.struct("doc_id", F.xxhash64("text").alias("digest")).alias("doc_id"), "text")
    found = near_duplicates(spark, named, **settings)
    own_id, digest, maybe = fresh_names(docs, "id", "digest", "maybe")
    key = [F.col("doc_id.doc_id").alias(own_id), F.col("doc_id.digest").alias(digest)]
    losers = stage(spark, found.filter(~F.col("kept")).select(*key).distinct(), "nd-losers")
    twice = found.filter(F.col("kept") & (F.col("n_shingles") > 0)).groupBy("doc_id").count().filter("count > 1")
    twice = stage(spark, twice.select(*key), "nd-twice")
    same = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.xxhash64("text") == F.col(digest))

    def split(rows: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows that may be among the named ones, and the others, which need no join."""
        keys = names.select(F.xxhash64(own_id, digest).alias("key"))
        flagged = maybe_among(rows, F.xxhash64("doc_id", F.xxhash64("text")), keys, maybe)
        return flagged.filter(F.col(maybe)).drop(maybe), flagged.filter(~F.col(maybe)).drop(maybe)

    some, others = split(docs, losers)
    kept = others.unionAll(some.join(losers, same, "left_anti"))
    if twice.isEmpty():
        return kept
    some, others = split(kept, twice)
    once = some.join(twice, same, "left_semi").withColumn(digest, F.xxhash64("text")).dropDuplicates(
        ["doc_id", digest]).drop(digest)
    return others.unionAll(some.join(twice, same, "left_anti")).unionAll(once)
