"""The pipeline as a whole on a hand-sized corpus, against brute force from the classifier's verdicts on."""

import os
import random

import pytest

import corpus_pipeline
from shelfcast.llm import quality
from shelfcast.llm.token_count import VOCABULARY

DOCS = "doc_id long, text string, lang string, source string, n_chars long, `_id` long, span long"


def words(rng, n):
    return " ".join(rng.choice(["river", "stone", "cloud", "green", "paper", "table"]) + str(rng.randrange(500))
                    for _ in range(n))


def shingles(text, n):
    own = (text or "").lower().split()
    if len(own) < n:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}


def kept_by_hand(rows, items):
    """One of each group of near copies, then those without a benchmark item."""
    sets = [shingles(t, 5) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    first = {}
    for (i, t), g in zip(rows, group):
        if g not in first or i < first[g][0]:
            first[g] = (i, t)
    clean = []
    for i, t in first.values():
        held = [shingles(x, min(5, len(x.split()))) for x in items]
        own = [shingles(t, min(5, len(x.split()))) for x in items]
        if not any(len(a & b) >= 0.8 * len(a) for a, b in zip(held, own)):
            clean.append((i, t))
    return clean


@pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="needs the vocabulary file")
def test_run(spark, tmp_path):
    rng = random.Random(12)
    good = [words(rng, rng.randrange(40, 90)) for _ in range(60)]
    items = [words(rng, 12), words(rng, 8)]
    texts = [*good, *(f"{t} tail" for t in good[:8]), good[9], *(f"{t} {items[n % 2]} end" for n, t in enumerate(good[20:24]))]
    texts += ["!!! ### " * rng.randrange(10, 40) for _ in range(40)]
    rows = [(i, t, "en", ["a", "b", None][i % 3], len(t), 1, 2) for i, t in enumerate(texts)]
    rows += [rows[5], (500, None, "en", "a", 0, 1, 2), (501, "", "en", "b", 0, 1, 2), (None, good[30] + " x", "en", "a", 9, 1, 2)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, int(not t.startswith("!")), 0) for i, t, *_ in rows if i is not None and t]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    scored = quality.score_quality(spark, docs, spark.read.parquet(f"{tmp_path}/labels.parquet"), whole_rows=True)
    passed = {(r["row"]["doc_id"], r["row"]["text"]) for r in scored.filter("predicted = 1").collect()}
    assert {t for _, t in passed if t} >= set(good)
    want = kept_by_hand(sorted(((i, t) for i, t in passed if i is not None and t)), items)
    lost = {i for i, *_ in rows if i is not None} - {i for i, _ in want} - {i for i, t in passed if not t}

    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.slot for r in result) == list(range(len(result)))
    seen = {i for r in result for i in r.doc_ids}
    assert seen and not seen & lost
    assert len(seen & {i for i, _ in want}) > 0.5 * len(want)


def test_run_on_empty_tables(spark, tmp_path):
    if not os.path.exists(VOCABULARY):
        pytest.skip("needs the vocabulary file")
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
