"""Operators against brute force on small tables with nulls, ties, repeats and odd texts."""

import itertools
import math
import os
import random
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfcast.llm import (
    common, decontaminate, line_dedup, lm_score, mixing, near_dedup, quality, sharding, token_count, token_output, topk_search,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, class long, path long"


def words(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota"]) + str(
        rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    texts = [words(rng, rng.randrange(5, 90)) for _ in range(40)]
    near = [t.replace("alpha", "Alpha", 1) + " tail" for t in texts[:8]]
    long_one = words(rng, 6000)
    odd = [None, "", "  \n\t ", "one", "two words", "ONE", texts[3], texts[3], long_one, "a\nb\n\n" + texts[5], "é ß x y z"]
    all_ = [*texts, *near, *odd]
    out = [(i, t, "en", [None, "s1", "s2", "s0"][i % 4], len(t or ""), 7, 8, 9) for i, t in enumerate(all_)]
    out += [out[3], out[3]]  # repeated rows
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def tokens(text):
    return (text or "").encode().lower().split()


def test_language_model(spark, docs, rows, empty):
    got = lm_score.score_documents(spark, docs).collect()
    train = Counter()
    for i, t, *_ in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            train.update([*tokens(t), b"\n"])
    total, distinct = sum(train.values()), len(train)
    texts = {r[0]: r[1] for r in rows}
    assert len(got) == len(rows)
    for r in got:
        own = [*tokens(texts[r.doc_id]), b"\n"]
        want = sum(math.log10((train[w] + 1) / (total + distinct + 1)) for w in own)
        assert r.n_tokens == len(own) and r.train_tokens == total
        assert r.n_known == sum(train[w] > 0 for w in own)
        assert r.base_score == pytest.approx(want, rel=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert -math.inf < r.score < 0
    assert lm_score.score_documents(spark, empty).count() == 0


def test_language_model_in_passes(spark, docs, rows):
    """Probabilities by exact quantised counts, in one pass and where the filters exceed the room."""
    words, pairs = Counter(), Counter()
    for i, t, *_ in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            own = [*tokens(t), b"\n"]
            words.update(own)
            pairs.update(zip([b"\n", *own], own))
    total, context, successors = sum(words.values()), Counter(), Counter()
    for (c, _), n in pairs.items():
        context[c] += n
        successors[c] += 1
    hot = {w for w, n in words.items() if 64 * n >= total}

    def held(n):
        return lm_score.ESTIMATE[int(lm_score.levels(np.array([n]))[0])] if n else 0.0

    texts, want = {r[0]: r[1] for r in rows}, {}
    for i, t in texts.items():
        own, want[i] = [*tokens(t), b"\n"], 0.0
        for c, w in zip([b"\n", *own], own):
            first = (min(held(words[w]), total) + 1) / (total + len(words) + 1)
            n, s = (context[c], successors[c]) if c in hot else (held(context[c]), held(successors[c]))
            s = min(s, n)
            want[i] += math.log10((min(held(pairs[c, w]), n) + s * first) / (n + s) if n else first)
    small = 0.008  # MB, several passes over words and pairs
    for most in (256, small):
        got = lm_score.score_documents(spark, docs, max_filter_mb=most).collect()
        assert len(got) == len(rows)
        off = [abs(r.score - want[r.doc_id]) / r.n_tokens for r in got]
        assert sum(off) / len(off) < 0.02 and max(off) < 0.3
    assert lm_score.packed(np.array([3, 3, 9, 1, 1]), 6) == [[0, 1], [2], [3, 4]]


def test_language_model_is_scored_by_shuffles_alike(spark, docs, empty, monkeypatch):
    """Where the filters may not fit, words and pairs are sent to their segments: the same scores, and texts are read in one pass."""
    def rows(found):
        return sorted(map(tuple, found.collect()), key=repr)

    want = rows(lm_score.score_documents(spark, docs))
    held_only = docs.filter((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7) == 2)
    most = -1  # no room at all, also for an empty table
    for segment, code in ((1 << 21, 8 << 20), (1, 3000)):
        monkeypatch.setattr(lm_score, "SEGMENT_TOKENS", segment)
        monkeypatch.setattr(lm_score, "CODE_BYTES", code)
        seen = []
        with monkeypatch.context() as patched:
            patched.setattr(lm_score, "_share", lambda *a: seen.append(a))
            scored = lm_score.score_documents(spark, docs, max_filter_mb=most)
            got = rows(scored)
            assert [r[:5] for r in got] == [r[:5] for r in want] and not seen
            assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=1e-9)
            if segment > 1:  # the same segments, so the same filters
                assert [r[6] for r in got] == pytest.approx([r[6] for r in want], rel=1e-9)
            else:
                off = [abs(a[6] - b[6]) / a[2] for a, b in zip(got, want)]
                assert sum(off) / len(off) < 0.02
            assert lm_score.score_documents(spark, empty, max_filter_mb=most).schema == scored.schema
            assert lm_score.score_documents(spark, empty, max_filter_mb=most).count() == 0
            untrained = lm_score.score_documents(spark, held_only, max_filter_mb=most).collect()
    assert untrained and {(r.n_known, r.train_tokens, r.base_score, r.score) for r in untrained} == {(0, 0, 0.0, 0.0)}
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan


def test_segments_hold_little_of_what_they_are_asked():
    rng = np.random.default_rng(4)
    asked = [np.unique((rng.integers(0, 400, 20000) << 28 | rng.integers(0, 1 << 28, 20000)).astype(np.uint64)) for _ in range(25)]
    batch = pa.concat_batches([lm_score._asked(n, np.zeros(len(keys), np.uint16), keys, np.ones(len(keys), np.uint32)) for n, keys in enumerate(asked)])
    tracemalloc.start()
    answers = list(lm_score._answer_pairs(np.zeros(0, np.uint64), 14.0, 6)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(b.num_rows for b in answers) == 25 and peak < 60e6


def test_filter_holds_quantised_counts():
    keys = lm_score.mixed(np.arange(5000, dtype=np.uint64))
    counts = np.arange(5000) % 90 + 1
    array = lm_score.build_segment(keys, counts, 14.0, 6)
    held = lm_score.LogFrequencyFilter([array], 6)
    found = held.level(keys, np.zeros(5000, np.int64))
    assert (found >= lm_score.levels(counts)).all() and (found == lm_score.levels(counts)).mean() > 0.95
    other = held.level(lm_score.mixed(np.arange(10**6, 10**6 + 5000, dtype=np.uint64)), np.zeros(5000, np.int64))
    assert (other > 0).mean() < 0.05


def folded(text, width):
    w = (text or "").lower().split()
    n = min(width, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def test_decontamination(spark, docs, rows, empty):
    texts = {r[0]: r[1] for r in rows}
    items = [(1, " ".join(texts[48 + 8].split()[500:540])), (2, texts[2]), (3, "one"), (4, ""), (5, None), (6, "never seen here at all now")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in decontaminate.contaminated(spark, docs, bench).collect()}
    want = set()
    for (d, t), (i, x) in itertools.product(texts.items(), items):
        wanted = folded(x, 5)
        n = len(next(iter(wanted))) if wanted else 0
        w = (t or "").lower().split()
        own = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        if wanted and 100 * len(wanted & own) >= 80 * len(wanted):
            want.add((d, i, len(wanted), len(wanted & own)))
    assert want and got == want
    assert decontaminate.contaminated(spark, empty, bench).count() == 0
    assert decontaminate.contaminated(spark, docs, bench.filter("false")).count() == 0
    clean = decontaminate.clean_documents(spark, docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == sum(r[0] not in {w[0] for w in want} for r in rows)


def test_quality(spark, docs, rows, empty):
    rng = random.Random(2)
    table = [(i, " ".join(rng.choice(["ab", "cd", "efg"]) + ("###" if i % 2 else "") for _ in range(20 + i % 30)), i % 2) for i in range(300)]
    many = spark.createDataFrame([(i, t) for i, t, _ in table], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - y, 0) for i, _, y in table] + [(1, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.score_quality(spark, many, labels).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out]
    assert held and all(r.predicted == 1 - r.doc_id % 2 for r in held)
    assert {r.score for r in quality.score_quality(spark, docs, labels.filter("false")).collect()} == {0.5}
    assert quality.score_quality(spark, empty, labels).count() == 0
    whole = quality.score_quality(spark, docs, labels, whole_rows=True).select("row.*")
    assert whole.columns == docs.columns and whole.count() == len(rows)


def linked_groups(sets, percent):
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}


def test_near_duplicates(spark, docs, rows, empty, monkeypatch):
    sets = {}
    for i, t, *_ in rows:
        w = tokens(t)
        n = min(4, len(w))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set()
    want = linked_groups(sets, 80)
    for large in (False, True):
        if large:  # the ways for large nodes and clusters
            monkeypatch.setattr(near_dedup, "NODE", 1)
            monkeypatch.setattr(near_dedup, "CLUSTER", 1)
        got = near_dedup.near_duplicates(spark, docs).collect()
        assert {r.doc_id: r.component_id for r in got} == want
        assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (want[r.doc_id] == r.doc_id) for r in got)
        assert len(got) == len(rows)
    one = near_dedup.distinct_documents(spark, docs)
    assert one.columns == docs.columns
    assert sorted(r.doc_id for r in one.collect()) == sorted(i for i in want if want[i] == i)
    assert near_dedup.near_duplicates(spark, empty).count() == 0


def test_blocks_of_pivots_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CLUSTER", 16)
    members = spark.createDataFrame(
        [(i % 2, 150, i, i, b"s", b"m") for i in range(300)], "cluster long, size long, class long, root long, sketch binary, members binary")
    pivots = members.filter("class < 200")
    blocks = near_dedup._blocks(spark, members, pivots).collect()
    groups = {}
    for r in blocks:
        groups.setdefault((r.cluster, r.block, r.pivot_block), {True: [], False: []})[r.pivot].append(r["class"])
    assert max(len(g[x]) for g in groups.values() for x in g) <= 3 * 16  # 100 pivots of a cluster were in one
    met = Counter(p for g in groups.values() for p in itertools.product(g[False], g[True]))
    assert met == Counter((i, j) for i in range(300) for j in range(200) if i % 2 == j % 2)


def test_near_dedup_stage_takes_five_words(spark):
    rng = random.Random(7)
    one = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    texts = {1: one}
    for i, changes in ((2, 3), (3, 5), (4, 12)):  # similarity by five words about 0.86, 0.78, 0.54
        texts[i] = [f"x{i}" if k % (200 // changes) == 10 and k < 200 // changes * changes else w for k, w in enumerate(one)]
    texts[5], texts[6] = texts[3][:], [f"v{k}" for k in range(50)]
    fifths, fourths = ({i: {tuple(t[k : k + n]) for k in range(len(t) - n + 1)} for i, t in texts.items()} for n in (5, 4))
    for i in (3, 5):  # a pair between the two limits
        assert 100 * len(fifths[1] & fifths[i]) < 80 * len(fifths[1] | fifths[i])
        assert 100 * len(fourths[1] & fourths[i]) >= 80 * len(fourths[1] | fourths[i])
    texts.pop(2)  # it would link the two
    fifths.pop(2)
    want = linked_groups(fifths, 80)
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    kept = corpus_pipeline.keep_one_of_each(spark, table, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in want if want[i] == i) == [1, 3, 4, 6]


def test_fuzzy_lines(spark, rows, empty, monkeypatch):
    rng = random.Random(3)
    lines = [words(rng, rng.randrange(3, 40)) for _ in range(20)]
    texts = ["\n".join([lines[i % 20], "", lines[(i * 7) % 20] + "!" * (i % 3), "ab"]) for i in range(30)] + [None, ""]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    place = {}
    for i, t in enumerate(texts):
        for k, x in enumerate(t.split("\n") if t is not None else []):
            place[i, k] = x
    first = {}
    for at, x in sorted(place.items()):
        if x.strip():
            first.setdefault(x, at)
    sets = {at: {x[j : j + 9] for j in range(len(x) - 8)} if len(x) >= 9 else {x} for x, at in first.items()}
    want = linked_groups(sets, 80)
    for few in (16, 1):
        monkeypatch.setattr(line_dedup, "BUCKET", few)
        got = line_dedup.fuzzy_lines(spark, table).collect()
        assert {(r.doc_id, r.line_no): (r.keeper_doc_id, r.keeper_line_no) for r in got} == {
            at: want[first[x]] if x.strip() else at for at, x in place.items()}
    assert line_dedup.fuzzy_lines(spark, empty).count() == 0


def test_line_tables_are_removed(spark, monkeypatch):
    """Signatures go once the live buckets are read from them; only rows of live buckets are joined."""
    rng = random.Random(5)
    lines = [words(rng, rng.randrange(3, 40)) for _ in range(30)]
    texts = ["\n".join([lines[i], lines[(i * 7) % 30] + "!" * (i % 3)]) for i in range(30)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted(map(tuple, line_dedup.fuzzy_lines(spark, table).collect()))
    staged, filtered = {}, []
    stage, among = line_dedup.stage, line_dedup.maybe_among

    def kept(session, df, name):
        staged[name] = stage(session, df, name)
        return staged[name]

    def noted(rows, *rest):
        filtered.append(rows.columns)
        return among(rows, *rest)

    monkeypatch.setattr(line_dedup, "FEW", 0)
    monkeypatch.setattr(line_dedup, "stage", kept)
    monkeypatch.setattr(line_dedup, "maybe_among", noted)
    assert sorted(map(tuple, line_dedup.fuzzy_lines(spark, table).collect())) == want
    assert filtered == [["class", "sketch", "bucket"]]
    files = {name: staged[name].inputFiles() for name in ("line-signatures", "line-members")}
    assert not any(os.path.exists(f.removeprefix("file:").replace("//", "")) for f in files["line-signatures"])
    assert files["line-members"] and all(os.path.exists(f.removeprefix("file:").replace("//", "")) for f in files["line-members"])


def test_line_bitmaps(spark):
    """No pair that reaches the similarity is left out before the full sets; pairs far below it are."""
    rng = random.Random(8)
    lines = ["a", "b", "short one", "short ones", "ab" * 60, "ab" * 61]
    for size in (12, 60, 90, 200, 400, 3000):
        base = "".join(rng.choice("abcdefgh ") for _ in range(size))
        for edits in (0, 1, 2, 4, 8, size // 60, size // 40):
            x = list(base)
            for at in rng.sample(range(size), min(edits, size)):
                x[at] = "é"
            lines.append("".join(x) + "z" * (edits % 3))
    lines = sorted(set(lines))
    texts = spark.createDataFrame(list(enumerate(lines)), "class long, line string")
    sets = [{x[j : j + 9] for j in range(len(x) - 8)} if len(x) >= 9 else {x} for x in lines]
    every = [(a, b) for a in range(len(lines)) for b in range(a)]
    got = {(r.a, r.b): (r.n1, r.n2) for r in line_dedup._possible(
        spark.createDataFrame(every, "a long, b long"), line_dedup._bitmaps(texts, 9), 80).collect()}
    true = {(a, b) for a, b in every if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert len(true) > 10 and true <= set(got)
    assert all(got[a, b] == (len(sets[a]), len(sets[b])) for a, b in got)
    far = {(a, b) for a, b in every if 100 * len(sets[a] & sets[b]) < 50 * len(sets[a] | sets[b]) and len(sets[a]) < 500}
    assert not far & set(got)


def test_line_rest_is_bounded(spark, monkeypatch):
    """Lines outside a bucket's largest component meet those only that may reach the similarity."""
    rng = random.Random(12)
    base = [f"word{i}" for i in range(40)]
    lines = [" ".join(f"x{rng.randrange(9999)}" if i < 12 and k else w for i, w in enumerate(base)) for k in range(25)]
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    staged, stage = {}, line_dedup.stage

    def kept(session, df, name):
        staged[name] = stage(session, df, name)
        return staged[name]

    monkeypatch.setattr(line_dedup, "BUCKET", 2)
    monkeypatch.setattr(line_dedup, "PIVOTS", 1)
    monkeypatch.setattr(line_dedup, "stage", kept)
    assert all(r.kept for r in line_dedup.fuzzy_lines(spark, table).collect())
    rest = staged["line-rest"]
    assert rest.count() == line_dedup._possible(rest, staged["line-bitmaps"], 80).count()


def test_line_shingles(spark):
    lines = ["", "short", "exactly 9", "wide \U0001f600\U0001f601 signs \U0001f602\U0001f603!", "ß" * 300 + "\r x", "a  b " * 40]
    table = spark.createDataFrame([(x,) for x in lines], "line string")
    got = table.select("line", line_dedup.shingles(F.col("line"), 9).alias("cut"),
                       line_dedup._word_runs(F.col("line"), 9).alias("words")).collect()
    for r in got:
        every = [r.line[i : i + 9] for i in range(len(r.line) - 8)]
        assert r.cut == (every if len(r.line) >= 9 else [r.line])
        assert r.words == [x for i, x in enumerate(every) if x[0] != " " and (i == 0 or r.line[i - 1] == " ")]


def test_long_lines_without_spaces(spark):
    rng = random.Random(9)
    base = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(400)) for _ in range(6)]
    near = [x[:200] + "一" + x[201:] for x in base]  # 9 of 392 shingles differ
    table = spark.createDataFrame(list(enumerate(base + near)), "doc_id long, text string")
    got = {r.doc_id: r.keeper_doc_id for r in line_dedup.fuzzy_lines(spark, table).collect()}
    assert got == {i: i % 6 for i in range(12)}


@pytest.mark.parametrize("size", [1, 2, 3, 64, 1000, 4097])
def test_permutation(size):
    out = token_output.permuted(np.arange(size), size, 5)
    assert sorted(out) == list(range(size))
    assert (out == token_output.permuted(np.arange(size), size, 5)).all()


def test_tokens_round_trip(spark, docs, rows, empty, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    got = token_output.write_training_order(spark, docs, folder, length=64, shard_slots=10).collect()
    pieces = token_output.read_pieces(token_output.VOCABULARY)
    encode = token_output.encoding(pieces)
    assert sorted(r.slot for r in got) == list(range(len(got)))
    ids = token_output.read_slots(folder, 0, len(got), 64, 10)
    for r in got:
        assert zlib.crc32(ids[r.slot].tobytes()) == r.crc and r.offset == r.slot % 10 * 128
    found = Counter()
    for r in got:
        found.update(ids[r.slot][: r.n_tokens].tolist())
    want = Counter(itertools.chain.from_iterable([*encode.encode_ordinary(t or ""), len(pieces)] for _, t, *_ in rows))
    assert found == want
    assert {d for r in got for d in r.doc_ids} == {r[0] for r in rows}
    assert token_output.write_training_order(spark, empty, folder + "2").count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(4)
    table = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(120)]
    table += [(200, table[0][1]), (201, table[0][1]), (7, table[7][1]), (202, None), (203, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
              (204, [float("nan")] * 6), (205, [float("inf")] * 6), (None, table[1][1]), (300, []), (206, [1e12] * 6)]
    vectors = topk_search.whole_vectors(spark.createDataFrame(table, "vec_id long, embedding array<double>"))
    good = {i: [math.floor(256 * x) for x in v] for i, v in table if i is not None and v and None not in v and all(map(math.isfinite, v))}
    got = topk_search.top_k(spark, vectors, vectors.filter(F.col("vec_id") % 50 == 0), chunk=40, block=2).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in (i for i in good if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)[:5]
        assert sorted(found[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert topk_search.top_k(spark, vectors.filter("false"), vectors).count() == 0


def test_sharding(spark, docs, rows, empty):
    got = sharding.shard_documents(spark, docs).collect()
    texts = {r[0]: r[1] or "" for r in rows}
    place, bytes_, groups = {}, Counter(), {}
    for r in got:
        assert r["size"] == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        place.setdefault(r.shard, []).append(r.slot)
        bytes_[r.shard] += r["size"]
        groups.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert len(got) == len(rows) and all(sorted(v) == list(range(len(v))) for v in place.values())
    assert all(len(v) == 1 for v in groups.values())
    size = Counter()
    for r in rows:
        size[r[1] or ""] += len((r[1] or "").encode()) + 1
    assert max(bytes_.values()) == max(size.values())  # one text outweighs an even share here
    assert sharding.shard_documents(spark, empty).count() == 0


@pytest.mark.parametrize("offset", [0.03, 0.2, 0.55])
def test_sharding_with_a_giant_group(spark, monkeypatch, offset):
    """The cuts of all groups in one list, from a small share of them."""
    monkeypatch.setattr(sharding, "BUCKET_BITS", 12)
    rng, n = np.random.default_rng(8), 20000
    digests = np.sort(rng.integers(-2**63, 2**63, n))
    sizes = rng.integers(50, 5000, n)
    sizes[int(offset * n)] = sizes.sum() // 2
    table = pd.DataFrame({"digest": digests, "crc": 1, "size": 2, "bytes": sizes, "bucket": (digests >> 52) + 2048})
    groups, fetched, plain = spark.createDataFrame(table), [], type(spark.range(0)).toPandas
    monkeypatch.setattr(type(groups), "toPandas", lambda df: fetched.append(plain(df)) or fetched[-1])
    capacity, cuts = sharding.minimax_cuts(spark, groups, 8)
    ends = np.cumsum(sizes)
    assert capacity == sharding.smallest_capacity(ends, 8, 0, int(ends[-1]))
    assert cuts == [(int(digests[at]), 1, 2) for at in sharding.greedy(ends, capacity, 8)]
    assert sum(len(x) for x in fetched[1:]) < n // 20


def test_smallest_capacity():
    rng = random.Random(5)
    for _ in range(60):
        sizes = [rng.randrange(1, 30) for _ in range(rng.randrange(1, 10))]
        parts = rng.randrange(1, 5)
        ends = np.cumsum(sizes)
        best = min(
            max(sum(sizes[a:b]) for a, b in zip((0, *cut), (*cut, len(sizes))))
            for n in range(parts) for cut in itertools.combinations(range(1, len(sizes)), n))
        assert sharding.smallest_capacity(ends, parts, 0, int(ends[-1])) == best


def test_token_counts(spark, docs, rows, empty):
    rng = random.Random(6)
    for _ in range(40):
        some = {bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 5))) for _ in range(12)}
        opening, continuing = set(list(some)[:7]), set(list(some)[4:])
        automaton = token_count.LongestMatch(opening, continuing)
        for _ in range(60):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 12)))
            at = n = 0
            while at < len(word):
                known = continuing if n else opening
                end = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
                if end is None:
                    n = 0
                    break
                at, n = end, n + 1
            assert automaton.length(word) == n
    got = token_count.count_tokens(spark, docs).collect()
    texts = {r[0]: r[1] or "" for r in rows}
    assert len(got) == len(rows)
    assert all(r.n_words == len(texts[r.doc_id].encode().split()) and r.n_tokens >= r.n_words for r in got)
    assert token_count.count_tokens(spark, empty).count() == 0


def test_mixing(spark, docs, rows, empty):
    got = mixing.draw(spark, docs, block=4, shard_words=500).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(tokens(r[1]))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), list(order)
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if share * weight[s] > 2 * sizes[s]]
        if not full:
            target.update({s: share * weight[s] for s in open_})
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.remove(s)
    assert {r.doc_id: r['size'] for r in got} == {r[0]: len(tokens(r[1])) for r in rows}
    source = {r[0]: r[3] for r in rows}
    taken = Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s]) and 0 <= r.taken <= 2 * r["size"]
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 40 for s in sizes)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.draw(spark, docs, block=4, shard_words=500).collect()))
    copies = mixing.mixed_documents(spark, docs, block=4, shard_words=500)
    assert copies.columns == docs.columns
    assert sum(len(tokens(r.text)) for r in copies.collect()) == sum(taken.values())
    assert mixing.draw(spark, empty).count() == 0


def test_mixed_texts_are_the_spans_drawn(spark, docs):
    rng, n = random.Random(10), 403
    text = "\n " + "".join(f"w{i}{rng.choice([' ', chr(10), '  ', chr(9), chr(10) * 2])}" for i in range(n))
    table = spark.createDataFrame([(1, text, "en", "s", len(text), 7, 8, 9)], SCHEMA)
    starts = set()
    for seed, share, copies in ((0, 0.5, 0), (1, 0.5, 0), (2, 1.3, 1)):
        settings = dict(block=4, share=share, seed=seed)
        drawn = mixing.draw(spark, table, whole_rows=True, **settings).first()
        got = [r for r in mixing.mixed_documents(spark, table, **settings).collect()]
        assert sum(r.text == text for r in got) == copies
        parts = [r.text for r in got if r.text != text]
        assert all(p in text and r.n_chars == len(r.text) for p, r in zip(parts, got))
        cuts = sorted([int(x[1:]) for x in p.split()] for p in parts)
        assert all(c == list(range(c[0], c[-1] + 1)) for c in cuts)
        assert cuts == sorted(list(range(s["from"], s["to"])) for s in drawn.spans if s["to"] - s["from"] < n)
        assert sum(map(len, cuts)) + copies * n == drawn.taken
        # one run of blocks, round the end if need be
        assert len(cuts) == 1 or (len(cuts) == 2 and cuts[0][0] == 0 and cuts[1][-1] == n - 1)
        assert cuts[-1][0] % 4 == 0
        starts.add(cuts[-1][0])
    assert len(starts) > 1
    for r in mixing.draw(spark, docs, block=4, shard_words=500, whole_rows=True).collect():
        assert sum(s["to"] - s["from"] for s in r.spans) == r.taken
        assert all(0 <= s["from"] < s["to"] <= r["size"] for s in r.spans)


@pytest.mark.parametrize("most", [1 << 20, 40])
def test_joined_links_equal_a_plain_search(spark, most):
    rng = np.random.default_rng(5)
    pairs = [(i, i + 1) for i in range(1000, 1060)] + [(5000, int(x)) for x in rng.integers(6000, 9000, 150)]
    pairs += [tuple(map(int, x)) for x in rng.integers(0, 400, (150, 2))] + [(77, 77), (-3, 2), (2, -3), (-3, 2)]
    near: dict[int, set[int]] = {}
    for a, b in pairs:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for start in sorted(near):
        reached = [] if start in want else [start]
        while reached:
            x = reached.pop()
            if x not in want:
                want[x] = start
                reached.extend(near[x])
    links = spark.createDataFrame(pairs, "a long, b long").repartition(7)
    got = near_dedup.joined_links(spark, links, most).collect()
    assert len(got) == len(want) and {r["node"]: r["root"] for r in got} == want
    assert near_dedup.joined_links(spark, links.limit(0), most).count() == 0


def test_topk_search_scores_blocks_of_queries():
    random = np.random.default_rng(7)
    parts = (random.normal(size=(8192, 64)) * 60).astype(np.int64)
    vectors = pd.DataFrame({"vec_id": np.arange(8192), "parts": list(parts)})
    queries = vectors.iloc[::10]
    begin = time.process_time()
    got = topk_search._search(5)(vectors, queries)
    assert time.process_time() - begin < 5  # 11 to 15 seconds with a query at a time
    score = parts[::10] @ parts.T
    score[np.arange(len(queries)), np.arange(0, 8192, 10)] = -(2**60)
    want = np.lexsort((np.broadcast_to(np.arange(8192), score.shape), -score), 1)[:, :5]
    assert (got["vec_id"].to_numpy().reshape(-1, 5) == want).all()
    assert (got["score"].to_numpy() == np.take_along_axis(score, want, 1).ravel()).all()


def test_lm_score_holds_little_of_a_batch():
    class Held:
        def __init__(self, value):
            self.value = value

    segments = [np.zeros(64, np.uint64)] * lm_score.SEGMENTS
    pieces = [Held(lm_score.LogFrequencyFilter(segments, 6))]
    none = np.zeros(0, np.uint64)
    counts = Held((none, np.zeros(0), np.zeros(0), none, np.zeros(0, np.int64), 10, 5))
    shared = lm_score.Shared(pieces, pieces, (list(range(lm_score.SEGMENTS)),) * 2, counts)
    rng = random.Random(5)
    texts = [" ".join(str(rng.randrange(5000)) for _ in range(2000)).encode() for _ in range(800)]
    n = len(texts)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(n)), pa.array(range(n)), pa.array([False] * n), pa.array(texts, pa.binary())],
        ["doc_id", "digest", "held_out", "bytes"])
    tracemalloc.start()
    scored = sum(b.num_rows for b in lm_score._score(shared)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert scored == n
    assert peak < 120e6


def test_maybe_among_passes_all_partners_and_few_others(spark):
    rows = spark.range(4000).select((F.col("id") % 1000).alias("key"), F.lit("x").alias("Word"), F.lit(1).alias("own"))
    keys = spark.range(0, 1000, 10).select(F.xxhash64("id").alias("key"))
    found = common.maybe_among(rows, F.xxhash64("key"), keys, "maybe")
    assert found.columns == ["key", "Word", "own", "maybe"]
    got = Counter((r.key % 10 == 0, r.maybe) for r in found.collect())
    assert got[True, True] == 400 and got[True, False] == 0 and got[False, True] < 400
    assert got.total() == 4000
    assert common.maybe_among(rows, F.xxhash64("key"), keys.filter("false"), "maybe").filter("maybe").count() == 0


def test_paths_of_a_class_are_joined_as_one_row(spark):
    paths = spark.range(60).select((F.col("id") % 7).alias("path"), (F.col("id") % 5).alias("class"))
    columns = spark.range(5).select(F.col("id").alias("c"), (F.col("id") * 10).alias("sketch"))
    got = near_dedup._of_classes(paths, columns)
    want = sorted((i % 7, i % 5, i % 5 * 10) for i in range(60))
    assert sorted((r["path"], r["class"], r["sketch"]) for r in got.collect()) == want
    join = got._jdf.queryExecution().optimizedPlan().toString()
    assert join.index("Generate") < join.index("Join")  # the join's rows are classes, not paths


def test_near_dedup_shuffles_texts_only_to_join_them(spark):
    rng = random.Random(8)
    texts = [words(rng, 60) for _ in range(60)]
    rows = [(i, t, i) for i, t in enumerate(texts + [texts[0] + " more"] + texts[:2])] + [(100, None, 1), (100, None, 2)]
    docs = spark.createDataFrame([*rows, rows[5]], "doc_id long, text string, maybe long")
    got = near_dedup.distinct_documents(spark, docs, width=5)
    assert sorted(tuple(r) for r in got.collect()) == sorted([*rows[:60], *rows[63:]], key=lambda r: (r[0], r[2]))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "maybe" in got.columns and "LeftAnti" in plan and "BroadcastExchange" not in plan
    assert "rightHint=(strategy=broadcast)" in plan  # the filter that lets most rows pass the join by
