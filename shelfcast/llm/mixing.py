"""Mixing sources to target weights by Sainte-Lague apportionment, as DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfcast.llm.common import SPACE_CHARS, WORD, stage

WEIGHTS = (5, 2, 1)  # by source in code point order, repeating
SHARE = 1.5  # words of the mix, as a share of all words
EPOCHS = 2  # a document is taken this often at most
BLOCK = 64  # words
SHARD_WORDS = 1 << 18
SEED = 20
_WITH_SPACE = WORD + "[\\x20\\x09-\\x0D]*"  # a word and the white space after it


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            epochs: float = EPOCHS) -> DataFrame:
    """Add ``number``, ``weight`` and ``target`` to one row per source (source, source_size).

    Targets share ``share`` of all words by weight. None exceeds ``epochs`` times its source;
    what is cut off is shared again by weight. Sources are visited by the ratio at which they
    reach their limit: the first one below it fixes the common rate for all that follow.
    Reads and writes one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("ratio", "number")
    everything = Window.partitionBy()
    earlier = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    numbered = (
        sizes.withColumn("number", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                           F.col("number") % len(weights) + 1))
        .withColumn("most", F.col("source_size") * F.lit(float(epochs)))
        .withColumn("ratio", F.col("most") / F.col("weight"))
    )
    rated = (
        numbered.withColumn("left", F.sum("source_size").over(everything) * F.lit(float(share))
                            - F.coalesce(F.sum("most").over(earlier), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(everything)
                    - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
        .withColumn("rate", F.col("left") / F.col("open"))
        .withColumn("full", F.col("rate") >= F.col("ratio"))
        .withColumn("common", F.max(F.when(~F.col("full"), F.col("rate"))).over(everything))
    )
    target = F.when(F.col("full"), F.col("most")).otherwise(
        F.least("most", F.col("common") * F.col("weight")))
    return rated.select("source", "source_size", "number", "weight", target.alias("target"))


def apportion(parties: DataFrame, group: str, party: str, weight: str, seats: str) -> DataFrame:
    """Add ``quota``: ``seats`` of each group shared among its parties by highest quotients
    weight / (2k + 1), ties to the smaller party.

    Rounding moves a share by half a seat at most, so the divisor that gives the right sum
    lies within half a seat per party of the plain one. Quotients below that band are sure to
    win; only the few within it (about four per party) are listed and ranked.
    """
    all_ = Window.partitionBy(group)
    known = (
        parties.withColumn("_sum", F.sum(weight).over(all_))
        .withColumn("_n", F.count(F.lit(1)).over(all_))
    )

    def seats_at(shift: Column) -> Column:
        return (F.col(seats) + shift) * F.col(weight) / F.col("_sum")

    positive = (F.col("_sum") > 0) & (F.col(weight) > 0)
    sure = F.when(positive, F.greatest(F.lit(0), F.ceil(seats_at(-F.col("_n") / 2) - 0.5) - 1)).otherwise(0)
    possible = F.when(positive, F.floor(seats_at(F.col("_n") / 2) + 0.5) + 1).otherwise(0)
    banded = (
        known.withColumn("_sure", sure.cast("long")).withColumn("_possible", possible.cast("long"))
        .withColumn("_open", F.col(seats) - F.sum("_sure").over(all_))
    )
    ranked = (
        banded.filter("_possible > _sure")
        .select(group, party, weight, "_open", F.explode(F.sequence("_sure", F.col("_possible") - 1)).alias("_k"))
        .withColumn("_quotient", F.col(weight) / (2 * F.col("_k") + 1))
        .withColumn("_rank", F.row_number().over(
            Window.partitionBy(group).orderBy(F.desc("_quotient"), party, "_k")))
        .filter("_rank <= _open")
        .groupBy(F.col(group).alias("_g"), F.col(party).alias("_p")).agg(F.count(F.lit(1)).alias("_won"))
    )
    return (
        banded.join(ranked, (F.col(group) == F.col("_g")) & (F.col(party) == F.col("_p")), "left")
        .withColumn("quota", F.col("_sure") + F.coalesce("_won", F.lit(0)))
        .drop("_sum", "_n", "_sure", "_possible", "_open", "_g", "_p", "_won")
    )


def draw(spark: SparkSession, docs: DataFrame, *, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
         epochs: int = EPOCHS, block: int = BLOCK, shard_words: int = SHARD_WORDS, seed: int = SEED,
         whole_rows: bool = False) -> DataFrame:
    """How many words of each document the mix takes.

    Returns a row per document: doc_id, size, source_size, target, taken; with ``whole_rows``
    also the input row as a struct ``row``, and ``spans``, the runs of words taken: an array of
    (from, to), from 0, without the word at ``to``. Each source gets whole blocks of equal words by Sainte-Lague, in proportion to its
    target. Within a source, documents are dealt by a seeded hash to shards of about
    ``shard_words`` words, and its blocks are shared among the shards in the same way. A shard
    lays its documents end to end in seeded order, starts at a seeded block and takes as many
    blocks as its quota, round the end if need be. Documents at the rim are taken in part. A
    hot source has more shards, not larger ones.

    A null text has size 0; the null source is a source, the last one. Documents without words
    take 0. Repeated rows are rows of their own. Empty tables give empty results.
    """
    keep = ["row", "spans"] if whole_rows else []
    rows = stage(spark, docs.select(
        "doc_id", "source", *[F.struct(*docs.columns).alias(c) for c in keep[:1]],
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("place"),
    ), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = targets(sizes, weights, share, epochs).withColumn("_one", F.lit(1)).withColumn(
        "_blocks", F.round(F.sum("target").over(Window.partitionBy()) / block).cast("long"))
    sources = stage(spark, apportion(shares, "_one", "number", "target", "_blocks").select(
        F.col("source").alias("name"), "number", "source_size", "target", F.col("quota").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long").alias("shards"),
    ), "mix-sources")
    placed = rows.join(sources, F.col("source").eqNullSafe(F.col("name"))).withColumn(
        "shard", F.pmod(F.col("place"), F.col("shards")))
    shards = placed.groupBy("number", "shard").agg(
        F.sum("size").alias("words"), F.max("blocks").alias("blocks"))
    quotas = apportion(shards, "number", "shard", "words", "blocks").select(
        F.col("number").alias("_number"), F.col("shard").alias("_shard"), "words",
        F.least(F.col("quota") * block, F.col("words") * epochs).alias("wanted"))
    joined = placed.join(quotas, (F.col("number") == F.col("_number")) & (F.col("shard") == F.col("_shard")))
    before = Window.partitionBy("number", "shard").orderBy("place", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    whole = F.when(F.col("words") > 0, F.floor(F.col("wanted") / F.col("words"))).otherwise(0)
    first = F.pmod(F.xxhash64(F.lit(seed + 1), "number", "shard"),
                   F.greatest(F.lit(1), F.ceil(F.col("words") / block))) * block
    laid = (
        joined.withColumn("a", F.coalesce(F.sum("size").over(before), F.lit(0)))
        .withColumn("b", F.col("a") + F.col("size"))
        .withColumn("whole", whole)
        .withColumn("start", first)
        .withColumn("end", F.col("start") + F.col("wanted") - F.col("whole") * F.col("words"))
    )
    low, high = F.greatest("a", "start"), F.least("b", "end")
    back = F.least("b", F.col("end") - F.col("words"))
    ahead = F.greatest(F.lit(0), high - low)
    round_ = F.greatest(F.lit(0), back - F.col("a"))
    taken = F.col("whole") * F.col("size") + ahead + round_

    def span(begin: Column, end: Column) -> Column:
        return F.struct(begin.cast("long").alias("from"), end.cast("long").alias("to"))

    spans = F.concat(
        F.array_repeat(span(F.lit(0), F.col("size")), F.col("whole").cast("int")),
        F.array(span(F.lit(0), back - F.col("a")), span(low - F.col("a"), high - F.col("a"))))
    laid = laid.withColumn("spans", F.filter(spans, lambda x: x["to"] > x["from"]))
    return laid.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), *keep)


def mixed_documents(spark: SparkSession, docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix: each as often as it is taken whole, and one more row for each
    run of words taken in part: these words of the text, with the white space between them.
    Same columns as ``docs``.

    The text length column ``n_chars`` follows a cut text. Documents of which nothing is taken
    are left out.
    """
    drawn = draw(spark, docs, whole_rows=True, **settings)
    out = drawn.withColumn("span", F.explode("spans"))
    first, n = F.col("span.from"), F.col("span.to") - F.col("span.from")
    words = F.regexp_extract_all("row.text", F.lit(_WITH_SPACE), F.lit(0))
    cut = F.rtrim(F.array_join(F.slice(words, (first + 1).cast("int"), n.cast("int")), ""), F.lit(SPACE_CHARS))
    out = out.withColumn("cut", F.when(n < F.col("size"), cut))
    final = {"text": F.coalesce("cut", "row.text")}
    if "n_chars" in docs.columns:
        final["n_chars"] = F.coalesce(
            F.length("cut").cast(docs.schema["n_chars"].dataType), "row.n_chars")
    return out.select(*[final.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
