"""Benchmark decontamination: size-partitioned MinHash containment search, as DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.llm.common import fresh_names, stage

WIDTH = 5
PERCENT = 80  # of an item's shingles that a document must hold


def folded_words(text: Column) -> Column:
    """Lower-case words of a text; a null text has none."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t\\n\\x0B\\f\\r]+")
    return F.filter(words, lambda w: w != "")


def _spans(words: Column, width: int, one) -> Column:
    """``one(place)`` for each place at which ``width`` words start; none in shorter texts."""
    places = F.sequence(F.lit(1), F.size(words) - (width - 1))
    return F.when(F.size(words) >= width, F.transform(places, one))


def hashed_shingles(words: Column, width: int) -> Column:
    return _spans(words, width, lambda i: F.xxhash64(*[F.element_at(words, i + k) for k in range(width)]))


def word_shingles(words: Column, width: int) -> Column:
    """Distinct shingles, spelled out."""
    return F.array_distinct(_spans(words, width, lambda i: F.array_join(F.slice(words, i, width), " ")))


def _items(benchmark: DataFrame, width: int, percent: int) -> DataFrame:
    """item_id, width (of its shingles), shingles, n, need (how many a document must hold) and
    probes: its minwise shingles.

    Size classes are powers of two. A document that holds the item may lack n - need of its
    shingles, so one more than that, taken by smallest hash, cannot all be missing. The class's
    largest size fixes their number, the same for all items of a class.
    """
    words = benchmark.select("item_id", folded_words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    wide = words.withColumn("width", F.least(F.size("words"), F.lit(width)))
    shingles = F.lit(None).cast("array<string>")
    for w in range(1, width + 1):
        shingles = F.when(F.col("width") == w, word_shingles(F.col("words"), w)).otherwise(shingles)
    sized = wide.withColumn("shingles", shingles).withColumn("n", F.size("shingles"))
    top = F.pow(F.lit(2), F.ceil(F.log2("n"))).cast("int")  # largest size of the class
    lacking = F.floor(top * (100 - percent) / 100).cast("int")
    # Missing words of a narrower shingle are null, which a hash passes over.
    hashes = F.array_sort(F.transform("shingles", lambda s: F.xxhash64(*[
        F.get(F.split(s, " "), F.lit(i)) for i in range(width)])))
    return (
        sized.withColumn("need", F.ceil(F.col("n") * percent / 100).cast("int"))
        .withColumn("probes", F.slice(hashes, 1, lacking + 1))
        .select("item_id", "width", "shingles", "n", "need", "probes")
    )


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, width: int = WIDTH,
                 percent: int = PERCENT) -> DataFrame:
    """Pairs of a document and a benchmark item of whose word shingles it holds ``percent`` or more.

    Returns doc_id, item_id, n_shingles (of the item), n_shared, containment. Shingles are runs
    of ``width`` lower-case words; an item with fewer words is one shingle, looked for as it is.

    Items are partitioned by size, and each class has its length of MinHash sketch: the item's
    shingles of smallest hash, enough that no document over the limit can lack them all. The
    hashed shingles of every whole document are looked up among the sketches (a join on the
    hash; Spark broadcasts the sketches if they are small by its own limit). Documents too
    short for an item are no candidates. Only candidates are read again, and the shingles
    themselves are compared, so that chance and hash collisions leave no trace.

    Null or empty texts contain nothing and are contained in nothing. Repeated items give a pair
    each; rows with equal id and text give one. Empty tables give an empty result.
    """
    items = stage(spark, _items(benchmark, width, percent), "items")
    mark = F.xxhash64("text")
    found = None
    for w in sorted(r["width"] for r in items.select("width").distinct().collect()):
        probes = items.filter(F.col("width") == w).select(
            F.explode("probes").alias("probe"), "item_id", F.col("need").alias("needed"))
        words = folded_words(F.col("text"))
        spans = docs.select("doc_id", mark.alias("mark"), words.alias("words")).filter(F.size("words") >= w).select(
            "doc_id", "mark", F.size("words").alias("length"),
            F.explode(F.array_distinct(hashed_shingles(F.col("words"), w))).alias("hash"))
        hits = spans.join(probes, F.col("hash") == F.col("probe")).filter(
            F.col("length") - (w - 1) >= F.col("needed")).select(
            "doc_id", "mark", F.struct("item_id", F.lit(w).alias("width")).alias("item"))
        found = hits if found is None else found.unionAll(hits)
    if found is None:  # no item has words
        doc, item = (t.schema[c].dataType.simpleString() for t, c in ((docs, "doc_id"), (benchmark, "item_id")))
        return spark.createDataFrame(
            [], f"doc_id {doc}, item_id {item}, n_shingles int, n_shared int, containment double")
    candidates = stage(spark, found.distinct().groupBy("doc_id", "mark").agg(
        F.collect_set("item").alias("items")), "candidates").select(
        F.col("doc_id").alias("id"), F.col("mark").alias("seen"), "items")
    texts = docs.select("doc_id", "text", mark.alias("mark")).join(
        candidates, (F.col("mark") == F.col("seen")) & F.col("doc_id").eqNullSafe(F.col("id")))
    worded = texts.select("doc_id", "mark", folded_words(F.col("text")).alias("words"), F.explode("items").alias("item"))
    own = F.lit(None).cast("array<string>")
    for w in range(1, width + 1):
        own = F.when(F.col("item.width") == w, word_shingles(F.col("words"), w)).otherwise(own)
    pairs = worded.select("doc_id", "mark", F.col("item.item_id").alias("wanted"), own.alias("own"))
    shared = F.size(F.array_intersect("own", "shingles"))
    return (
        pairs.join(items, F.col("wanted").eqNullSafe(F.col("item_id")))
        .withColumn("n_shared", shared).filter(F.col("n_shared") >= F.col("need"))
        .select("doc_id", "mark", "item_id", F.col("n").alias("n_shingles"), "n_shared",
                (F.col("n_shared") / F.col("n")).alias("containment"))
        .distinct().drop("mark")
    )


def clean_documents(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns, whatever these are named.

    A document is told by its id and a digest of its text, so rows that repeat both share their
    fate. Null and empty texts are kept, whatever their id. Without items, or documents, the
    table comes back as it is."""
    keyed = docs.select(F.struct("doc_id", F.xxhash64("text").alias("digest")).alias("doc_id"), "text")
    own_id, digest = fresh_names(docs, "id", "digest")
    found = contaminated(spark, keyed, benchmark, **settings).select(
        F.col("doc_id.doc_id").alias(own_id), F.col("doc_id.digest").alias(digest)).distinct()
    found = stage(spark, found, "contaminated")
    same = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.xxhash64("text") == F.col(digest))
    return docs.join(found, same, "left_anti")
