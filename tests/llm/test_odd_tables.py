"""Tables whose columns are named as inner ones, null ids, and the pipeline's stages by hand."""

import random

import pytest

import corpus_pipeline
from shelfcast.llm import common, decontaminate, near_dedup

NAMES = ["id", "id_", "digest", "DIGEST_", "_id", "_digest", "row", "span", "class", "mark", "kept"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` long" for n in NAMES)


def words(rng, n):
    return " ".join(f"w{rng.randrange(4000)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = [words(rng, 60) for _ in range(12)]
    odd = [(0, texts[0]), (1, texts[0] + " tail"), (2, texts[1]), (None, texts[2]), (None, texts[2]), (None, texts[3]),
           (5, None), (6, ""), (7, texts[4]), (7, texts[5]), (7, texts[4]), (8, f"{texts[6]} {texts[11]}")]
    return [(i, t, "en", "s", len(t or ""), *range(len(NAMES))) for i, t in odd], texts


def test_near_copies_with_null_ids_and_clashing_columns(spark, rows):
    table, _ = rows
    frame = spark.createDataFrame(table, SCHEMA).repartition(3)
    kept = near_dedup.distinct_documents(spark, frame)
    assert kept.columns == frame.columns
    got = sorted(((r[0], r[1]) for r in kept.collect()), key=str)
    want = {(i, t) for i, t, *_ in table} - {(1, table[1][1])}
    assert got == sorted(want, key=str) and all(tuple(r[5:]) == tuple(range(len(NAMES))) for r in kept.collect())


def test_null_ids_meet_their_own_class_only(spark):
    """Work for rows without an id follows their number: each class gets its text once."""
    rng = random.Random(5)
    texts = [words(rng, 40) for _ in range(300)]
    frame = spark.createDataFrame([(None, t) for t in texts + [t + " end" for t in texts]], "doc_id long, text string")
    with common.recorded(paths := []):
        found = near_dedup.near_duplicates(spark, frame).collect()
    members = [p for p in paths if "/nd-members-" in p]
    assert spark.read.parquet(*members).count() == 600
    assert len(found) == 600 and all(r.component_id is None for r in found)


def test_clean_documents_with_clashing_columns(spark, rows):
    table, texts = rows
    frame = spark.createDataFrame(table, SCHEMA).repartition(3)
    items = spark.createDataFrame([(1, texts[11]), (2, texts[2]), (3, None)], "item_id long, text string")
    kept = decontaminate.clean_documents(spark, frame, items)
    assert kept.columns == frame.columns
    left = sorted((r[0] is None, r[0] or 0) for r in kept.collect())
    assert left == sorted((i is None, i or 0) for i, t, *_ in table if t != texts[2] and i != 8)
    assert decontaminate.clean_documents(spark, frame.limit(0), items).count() == 0


def test_inner_tables_go_when_they_are_no_longer_read(spark, rows):
    table, _ = rows
    frame = spark.createDataFrame(table, SCHEMA)
    paths = []
    with common.recorded(paths):
        read = common.stage(spark, frame, "first")
        common.stage(spark, frame, "second")
    outside = common.stage(spark, frame, "third")
    common.release(spark, paths, read)
    assert len(paths) == 1 and read.count() == len(table)
    common.release(spark, paths, outside)
    assert not paths and outside.count() == len(table)
    with pytest.raises(Exception, match="(?i)not exist|FILE_NOT_EXIST|FileNotFound"):
        read.count()


def test_stages_keep_clashing_columns(spark, rows, tmp_path):
    """Near copies and benchmark stages against the hand-sized table, written between them."""
    table, texts = rows
    frame = spark.createDataFrame(table, SCHEMA).repartition(2)
    spark.createDataFrame([(1, texts[11])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    docs = common.stage(spark, frame, "docs")
    for name in ("near_dedup", "decontaminate", "mix"):
        docs = common.stage(spark, stages[name](spark, docs, str(tmp_path)), f"after-{name}")
        assert docs.columns == frame.columns
        got = {(r[0], r[1]) for r in docs.collect()}
        assert (1, table[1][1]) not in got
        if name != "near_dedup":
            assert 8 not in {i for i, _ in got}
    assert all(any(text in t for _, t, *_ in table if t) for _, text in got if text)
