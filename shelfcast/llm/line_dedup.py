"""Fuzzy line deduplication by MinHash over character shingles, as DataFrame operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfcast.llm.common import components, maybe_among, recorded, release, stage

WIDTH = 9  # characters of a shingle
PERCENT = 80  # of the union that the intersection must reach
SHORT = 100  # characters below which all shingles enter the signature
# Characters per space: up to the first, a long line samples the shingles that start a word;
# beyond the second, too few words start, and all shingles enter. Between them it does both.
DENSE, SPARSE = 14, 20
BANDS, ROWS = 12, 3
BITS = 5  # of each minwise value, kept in the sketch that compares lines of a bucket
PACK = 12  # values in one long of the sketch
EXACT = 1 << 20  # stands for the number of shingles drawn where all are
DEVIATIONS = 4  # below their mean, by which agreeing places of a pair at the threshold may fall
BUCKET = 16  # lines of a bucket in which all pairs are compared at once
PIVOTS = 8
FEW = 500_000  # rows (of two longs) that are broadcast at most
FEW_BYTES = 32 << 20  # of lines that are broadcast at most
TASK_PAIRS = 2000  # pairs verified by one task
WORDS = 16  # longs of the parity bitmap that bounds the difference of two lines
BLANK = " \t\r\x0b\x0c"

# A match may not begin inside a character of two UTF-16 units.
_WHOLE = r"\x{DC00}-\x{DFFF}"


def _runs(line: Column, width: int) -> Column:
    """All runs of ``width`` characters of a line that has as many."""
    return F.regexp_extract_all(line, F.lit(rf"(?s)(?=([^{_WHOLE}].{{{width - 1}}}))"), F.lit(1))


def _word_runs(line: Column, width: int) -> Column:
    """Those runs that start a word."""
    return F.regexp_extract_all(line, F.lit(rf"(?s)(?<![^ ])(?=([^ {_WHOLE}].{{{width - 1}}}))"), F.lit(1))


def shingles(line: Column, width: int) -> Column:
    """Character shingles, not made distinct; a shorter line is one shingle."""
    return F.when(F.char_length(line) < width, F.array(line)).otherwise(_runs(line, width))


def _signatures(lines: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """Per class of equal lines and kind of shingles: ``bands`` keys, and the sketch.

    Shingles become rows, and the minwise values their grouped minima, combined before the
    shuffle. A long line enters with the shingles that start a word, a short one, and one with
    few spaces, with all. Lines near a border enter with both kinds, since a line on the other
    side of it may be similar.
    """
    size = F.char_length("line")
    spaces = size - F.char_length(F.replace("line", F.lit(" "), F.lit("")))
    nothing = F.array().cast("array<string>")
    every = F.when((size < SHORT * 5 // 4) | (spaces * DENSE < size), shingles(F.col("line"), width)).otherwise(nothing)
    words = F.when((size >= SHORT) & (spaces * SPARSE >= size), _word_runs(F.col("line"), width)).otherwise(nothing)
    kinds = F.array(*[F.struct(F.lit(whole).alias("whole"), found.alias("found")) for whole, found in ((True, every), (False, words))])
    dealt = lines.select("class", F.explode(kinds).alias("kind")).select(
        "class", "kind.whole", F.when(F.col("kind.whole"), EXACT).otherwise(F.size("kind.found")).alias("drawn"),
        F.explode("kind.found").alias("shingle")).select("class", "whole", "drawn", F.xxhash64("shingle").alias("h"))
    least = dealt.groupBy("class", "whole").agg(
        F.max("drawn").alias("drawn"), *[F.min(F.hash(F.lit(i), "h")).alias(f"v{i}") for i in range(bands * rows)])
    keys = [F.xxhash64("whole", F.lit(b), *[f"v{b * rows + r}" for r in range(rows)]) for b in range(bands)]
    packs = []
    for begin in range(0, bands * rows, PACK):
        places = [F.shiftleft(F.col(f"v{i}").bitwiseAND(2**BITS - 1).cast("long"), BITS * (i - begin))
                  for i in range(begin, min(begin + PACK, bands * rows))]
        packs.append(reduce(Column.bitwiseOR, places).alias(f"s{begin // PACK}"))
    return least.select("class", F.struct("drawn", *packs).alias("sketch"), F.array(*keys).alias("bands"))


def _alike(one: str, other: str, places: int, percent: int) -> Column:
    """Whether two sketches agree in enough of their ``places`` for a pair at the threshold.

    The share of agreeing places strays by the number of places, and that of common shingles by
    the number of shingles drawn; both are taken as binomial.
    """
    lowest = sum(1 << (BITS * i) for i in range(PACK))
    differ = F.lit(0)
    for pack in range(-(-places // PACK)):
        x = F.col(f"{one}.s{pack}").bitwiseXOR(F.col(f"{other}.s{pack}"))
        any_bit = reduce(Column.bitwiseOR, [F.shiftrightunsigned(x, i) for i in range(BITS)])
        differ = differ + F.bit_count(any_bit.bitwiseAND(F.lit(lowest)))
    share = percent / 100
    spread = F.sqrt(share * (1 - share) * (1 / F.least(f"{one}.drawn", f"{other}.drawn") + 1 / places))
    return places - differ >= places * (share - DEVIATIONS * spread)


def _small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if its rows are few enough; else Spark joins by shuffling."""
    return F.broadcast(df) if df.count() <= FEW else df


def _bitmaps(texts: DataFrame, width: int) -> DataFrame:
    """Per class the number of its shingles, and their parities in the bits of ``WORDS`` longs."""
    dealt = texts.select("class", F.explode(F.array_distinct(shingles(F.col("line"), width))).alias("shingle")).select(
        "class", F.xxhash64("shingle").alias("h"))
    word = F.shiftrightunsigned("h", 6).bitwiseAND(F.lit(WORDS - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(F.lit(63)).cast("int"))
    return dealt.groupBy("class").agg(F.count(F.lit(1)).alias("n"), *[
        F.bit_xor(F.when(word == i, bit).otherwise(F.lit(0).cast("long"))).alias(f"w{i}") for i in range(WORDS)])


def _parities(bitmaps: DataFrame, name: str, n: str, words: str) -> DataFrame:
    """The same table with its columns named; the longs are one struct."""
    return bitmaps.select(F.col("class").alias(name), F.col("n").alias(n), F.struct(*[f"w{i}" for i in range(WORDS)]).alias(words))


def _may_reach(n1: str, n2: str, one: str, other: str, percent: int) -> Column:
    """Whether two lines may reach the similarity. Every odd bit of their bitmaps stands for a shingle at
    least that one line lacks, so no pair that reaches it is left out."""
    odd = reduce(Column.__add__, [F.bit_count(F.col(f"{one}.w{i}").bitwiseXOR(F.col(f"{other}.w{i}"))) for i in range(WORDS)])
    near = 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)
    return near & ((100 + percent) * odd <= (100 - percent) * (F.col(n1) + F.col(n2)))


def _possible(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may reach the similarity, by their bitmaps."""
    left, right = _parities(bitmaps, "a", "n1", "first"), _parities(bitmaps, "b", "n2", "second")
    if bitmaps.count() * 8 * (WORDS + 2) <= FEW_BYTES:
        left, right = F.broadcast(left), F.broadcast(right)
    return pairs.join(left, "a").join(right, "b").filter(
        _may_reach("n1", "n2", "first", "second", percent)).select("a", "b", "n1", "n2")


def _verified(spark: SparkSession, pairs: DataFrame, texts: DataFrame, bitmaps: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of lines whose shingle sets reach the similarity. ``pairs`` is a table."""
    pairs = stage(spark, _possible(pairs, bitmaps, percent), "line-possible")
    pairs = pairs.repartition(max(1, pairs.count() // TASK_PAIRS), "a", "b")
    left = texts.select(F.col("class").alias("a"), F.col("line").alias("first"))
    right = texts.select(F.col("class").alias("b"), F.col("line").alias("second"))
    if (texts.agg(F.sum(F.octet_length("line") + 16)).first()[0] or 0) <= FEW_BYTES:
        left, right = F.broadcast(left), F.broadcast(right)
    both = F.size(F.array_intersect(shingles(F.col("first"), width), shingles(F.col("second"), width)))
    # The union is what the intersection lacks of both sizes; written so that it is made once.
    alike = (100 + percent) * both >= percent * (F.col("n1") + F.col("n2"))
    checked = pairs.join(left, "a").join(right, "b")
    return stage(spark, checked.filter(alike).select("a", "b"), "line-links")


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.greatest(x, y).alias("a"), F.least(x, y).alias("b")]


def fuzzy_lines(spark: SparkSession, docs: DataFrame, width: int = WIDTH, percent: int = PERCENT,
                bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Every line of every document, and the line that stands for its component.

    Returns doc_id, line_no (from 0), keeper_doc_id, keeper_line_no, kept. Lines are
    cut at line feeds. Equal lines, and lines whose character-shingle sets have a similarity of
    ``percent`` or more, are linked; the first line (by doc_id and line_no) of each component
    is kept. Blank lines stay as they are.

    Equal lines are one class, by a 64-bit digest. Bands of minwise values deal classes to
    buckets; long lines sample the shingles that start a word, if enough do. All pairs of a bucket with up to
    ``BUCKET`` lines are verified on their full sets, unless their sketches are far apart.
    In a larger one every line meets ``PIVOTS`` of its lines; after the components of these
    links, every line outside the bucket's largest component meets all others, so no pair of
    different components stays unseen. Union-find is distributed.

    A null text has no line, an empty one a blank line. Null ids come last. Rows that repeat an
    id and its text count as one document. An empty table gives an empty result.
    """
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")).withColumn(
        "class", F.when(F.ltrim("line", F.lit(BLANK)) != "", F.xxhash64("line")))
    filled = lines.filter(F.col("class").isNotNull())
    read = stage(spark, lines.select("doc_id", "line_no", "class"), "lines")
    made: list[str] = []
    with recorded(made):
        signed = stage(spark, _signatures(filled, width, bands, rows), "line-signatures")
    release(spark, [], read)
    dealt = signed.select("class", "sketch", F.explode("bands").alias("bucket"))
    live = stage(spark, dealt.groupBy("bucket").agg(
        F.min("class").alias("low"), F.max("class").alias("high")).filter("low <> high").select(
        F.col("bucket").alias("k")), "line-live")
    release(spark, [], read)
    if live.count() > FEW:  # most classes are alone in a bucket; their rows with the sketch stay out of the shuffle
        dealt = maybe_among(dealt, F.col("bucket"), live.select(F.col("k").alias("key")), "maybe").filter("maybe").drop("maybe")
    members = stage(spark, dealt.join(_small(live), F.col("bucket") == F.col("k")).drop("k"), "line-members")
    del dealt, signed
    release(spark, made, members)
    sizes = stage(spark, members.groupBy(F.col("bucket").alias("k")).agg(F.count(F.lit(1)).alias("size")), "line-sizes")
    sized = members.join(sizes, F.col("bucket") == F.col("k")).drop("k")
    other = sized.select(F.col("bucket").alias("k"), F.col("class").alias("other"), F.col("size").alias("all"),
                         F.col("sketch").alias("seen"))
    same = F.col("bucket") == F.col("k")
    alike = _alike("sketch", "seen", bands * rows, percent)
    within = sized.filter(F.col("size") <= BUCKET).join(
        other.filter(F.col("all") <= BUCKET), same & (F.col("class") > F.col("other")) & alike).select(
        *_ordered(F.col("class"), F.col("other")))
    pivots = other.filter(F.col("all") > BUCKET).filter(
        F.pmod(F.xxhash64("other", "k"), F.ceil(F.col("all") / PIVOTS)) == 0)
    to_pivots = sized.filter(F.col("size") > BUCKET).join(
        pivots, same & (F.col("class") != F.col("other")) & alike).select(*_ordered(F.col("class"), F.col("other")))
    pairs = stage(spark, within.unionAll(to_pivots).distinct(), "line-pairs")

    wanted = pairs.select(F.col("a").alias("c")).unionAll(pairs.select("b")).distinct()
    if not sizes.filter(F.col("size") > BUCKET).isEmpty():
        wanted = wanted.unionAll(sized.filter(F.col("size") > BUCKET).select("class")).distinct()
    texts = stage(spark, filled.join(_small(stage(spark, wanted, "line-wanted")), F.col("class") == F.col("c")).select(
        "class", "line").dropDuplicates(["class"]), "line-texts")
    bitmaps = stage(spark, _bitmaps(texts, width), "line-bitmaps")
    release(spark, [], read)
    links = _verified(spark, pairs, texts, bitmaps, width, percent)
    large = stage(spark, sized.filter(F.col("size") > BUCKET), "line-large")
    if not large.isEmpty():
        roots = stage(spark, components(spark, links), "line-roots")
        held = large.join(roots, F.col("class") == F.col("node"), "left").join(
            _parities(bitmaps, "c", "n", "parities"), F.col("class") == F.col("c"))
        rooted = stage(spark, held.select(
            "bucket", "class", "sketch", "n", "parities", F.coalesce("root", "class").alias("root")), "line-rooted")
        largest = stage(spark, rooted.groupBy("bucket", "root").count().groupBy(F.col("bucket").alias("k")).agg(
            F.max_by("root", F.struct("count", "root")).alias("main")), "line-main")
        outside = rooted.join(largest, same & (F.col("root") == F.col("main")), "left_anti").select(
            F.col("bucket").alias("k"), F.col("class").alias("other"), F.col("root").alias("own"),
            F.col("sketch").alias("seen"), F.col("n").alias("n2"), F.col("parities").alias("second"))
        may = _may_reach("n", "n2", "parities", "second", percent)
        rest = rooted.join(outside, same & (F.col("root") != F.col("own")) & alike & may).select(
            *_ordered(F.col("class"), F.col("other"))).distinct()
        rest = stage(spark, rest.join(pairs, ["a", "b"], "left_anti"), "line-rest")
        # The trees found so far stand for their links.
        links = roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(
            _verified(spark, rest, texts, bitmaps, width, percent))
    roots = stage(spark, components(spark, links), "line-components")

    first = F.min(F.struct("doc_id", "line_no"))
    read, blank = read.filter(F.col("class").isNotNull()), read.filter(F.col("class").isNull())
    present = read.filter(F.col("doc_id").isNotNull())
    starts = stage(spark, present.groupBy("class").agg(first.alias("first")).unionAll(
        read.filter(F.col("doc_id").isNull()).groupBy("class").agg(first.alias("first"))).groupBy("class").agg(
        F.coalesce(F.min(F.when(F.col("first.doc_id").isNotNull(), F.col("first"))), F.min("first")).alias("first")),
        "line-starts")
    named = starts.join(roots, F.col("class") == F.col("node"), "left").select(
        "class", "first", F.coalesce("root", "class").alias("root"))
    named = stage(spark, named, "line-named")
    keepers = stage(spark, named.groupBy(F.col("root").alias("r")).agg(
        F.coalesce(F.min(F.when(F.col("first.doc_id").isNotNull(), F.col("first"))), F.min("first")).alias("keeper")),
        "line-keepers")
    answer = stage(spark, named.join(keepers, F.col("root") == F.col("r")).select(
        F.col("class").alias("c"), "keeper"), "line-answer")
    judged = read.join(answer, F.col("class") == F.col("c")).select(
        "doc_id", "line_no", F.col("keeper.doc_id").alias("keeper_doc_id"),
        F.col("keeper.line_no").alias("keeper_line_no"))
    blank = blank.select("doc_id", "line_no", F.col("doc_id").alias("keeper_doc_id"),
                         F.col("line_no").alias("keeper_line_no"))
    return judged.unionAll(blank).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("keeper_doc_id")) & (F.col("line_no") == F.col("keeper_line_no")))
