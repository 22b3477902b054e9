import random
import tracemalloc
from collections import Counter
from datetime import datetime, timedelta
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import admission, cells, retrieval
from shelfcast.streaming import admission as admission_streams
from shelfcast.sources import versions
from shelfcast.streaming import sinks

BASE = datetime(2024, 1, 1)


def vectors(spark, n=120, size=16, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    data = centres[rng.integers(0, 6, n)] + 0.3 * rng.normal(size=(n, size))
    rows = [(i, [float(v) for v in data[i]]) for i in range(n)]
    return data, spark.createDataFrame(rows, "id long, vector array<float>").repartition(5)


def brute_force(data, k):
    unit = data.astype("float32").astype("float64")
    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    scores = np.round(unit @ unit.T, 6)
    np.fill_diagonal(scores, -np.inf)
    ids = np.arange(len(data))
    return {i: [int(j) for j in np.lexsort((ids, -scores[i]))[:k]] for i in ids}


def found(hits):
    out = {}
    for r in hits.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.id)
    return out


@pytest.mark.parametrize("block", [4096, 50])
def test_exact_top_k_equals_brute_force(spark, block):
    data, points = vectors(spark)
    asked = points.withColumnRenamed("id", "query_id")
    hits = retrieval.cosine_top_k(asked, points, 5, drop_same=True, block=block)
    assert found(hits) == brute_force(data, 5)


def test_approximate_top_k_has_high_recall(spark):
    data, points = vectors(spark)
    unit = points.select(
        "id", F.transform("vector", lambda v: v / 10.0).alias("vector")
    )
    asked = unit.withColumnRenamed("id", "query_id")
    hits = found(retrieval.cosine_top_k_lsh(asked, unit, 5, drop_same=True))
    want = brute_force(data, 5)
    recall = np.mean([len(set(hits.get(i, [])) & set(want[i])) / 5 for i in want])
    assert recall > 0.85


@pytest.mark.parametrize("n", [3, 400, 3000])
def test_best_pairs_equal_sorting_every_score(n, monkeypatch):
    """Ties beyond the tile, vectors with NaN, few points, shared buckets, and a known floor."""
    monkeypatch.setattr(retrieval, "QUESTION_TILE", 7)
    monkeypatch.setattr(retrieval, "POINT_TILE", 500)
    rng = np.random.default_rng(n)
    ids = rng.permutation(n)
    points = retrieval._unit_rows(rng.integers(-2, 3, (n, 4)).astype(float) + [0.5, 0, 0, 0])
    points[1] = np.nan
    codes = rng.integers(0, 3, (n, 2))
    scores = np.round(points @ points.T, 6)
    scores[ids[:, None] == ids[None, :]] = np.nan
    for shared in (None, (codes, codes)):
        if shared:
            scores[(codes[:, None] != codes[None, :]).all(axis=2)] = np.nan
        want = set()
        for q in range(min(n, 30)):
            good = np.flatnonzero(np.isfinite(scores[q]))
            want |= {(q, p) for p in good[np.lexsort((ids[good], -scores[q, good]))[:5]].tolist()}
        cut = [None if c is None else c[:30] for c in (shared or (None,))]
        both = (cut[0], codes) if shared else None
        floor = np.array([min([scores[q, p] for r, p in want if r == q], default=-2.0) for q in range(min(n, 30))])
        for known in (None, floor):
            q, p, score = retrieval.top_pairs(ids[:30], points[:30], ids, points, 5, True, both, known)
            assert set(zip(q.tolist(), p.tolist())) == want and len(q) == len(want)
            assert (score == scores[q, p]).all()


def test_many_questions_are_dealt_into_blocks(spark, monkeypatch):
    """They do not pass through the driver, and are not one scan of all points a piece."""
    monkeypatch.setattr(retrieval, "LEAST_DEALT", 30)
    data, points = vectors(spark)
    asked = points.withColumnRenamed("id", "query_id")
    hits = retrieval.cosine_top_k(asked, points, 5, drop_same=True, block=50)
    assert "Union" not in hits._jdf.queryExecution().toString()
    assert found(hits) == brute_force(data, 5)
    model = retrieval.fit_buckets(points)
    both = [retrieval.with_buckets(model, rows) for rows in (asked, points)]
    few, many = (found(retrieval.cosine_top_k(*both, 5, True, block=b)) for b in (4096, 50))
    assert few == many


def test_context_and_no_hit(spark):
    cards = spark.createDataFrame(
        [("a", "risk at store one"), ("b", "calm at store two")], "id string, summary string"
    )
    asked = spark.createDataFrame([("q1", "which risk"), ("q2", "else")], "query_id string, question string")
    hits = spark.createDataFrame([("q1", "b", 2), ("q1", "a", 1)], "query_id string, id string, rank int")
    got = {r.query_id: r for r in retrieval.assemble_context(asked, hits, cards).collect()}
    assert got["q1"].context == "- risk at store one\n- calm at store two"
    assert got["q1"].prompt.endswith("Question: which risk")
    assert got["q2"].prompt == retrieval.NO_HIT


def test_question_finds_its_card(spark):
    from shelfcast.plans import chain

    cards = spark.createDataFrame(
        [(f"i{n}_s", f"Item i{n} at store s{n % 3}: stockout risk.") for n in range(20)],
        "id string, summary string",
    )
    asked = spark.createDataFrame([("q", "why is item i7 at risk")], "query_id string, question string")
    assert "Item i7" in chain.card_contexts(cards, asked, 1).first().context


def one_by_one(times, burst_max=5, seconds=60, daily_max=100):
    """Counting the whole log for every ask, as plainly as possible."""
    log, out = [], []
    for t in times:
        burst = sum(1 for x in log if x > t - timedelta(seconds=seconds))
        daily = sum(1 for x in log if x > t - timedelta(days=1))
        verdict = "burst" if burst >= burst_max else "daily" if daily >= daily_max else ""
        if not verdict:
            log.append(t)
        out.append(verdict)
    return out


def asks(spark, times_by_key):
    rows = [(k, i, t) for k, times in times_by_key.items() for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "user string, ask long, at timestamp").repartition(3)


def test_cells_give_the_hits_of_a_full_scan(spark, tmp_path, monkeypatch):
    """Also where a cell is dealt into many blocks; rows without a whole vector take no part."""
    monkeypatch.setattr(cells, "POINT_BLOCK", 7)
    monkeypatch.setattr(cells, "QUESTION_BLOCK", 5)
    data, points = vectors(spark)
    odd = spark.createDataFrame([(900, None), (901, [None] * 16)], points.schema)
    cells.store_points(points.unionByName(odd), str(tmp_path), cells=9)
    index = cells.open_points(spark, str(tmp_path))
    assert len(index.centres) == 9 and sum(n for n, _ in index.sizes.values()) == 120
    asked = points.unionByName(odd).withColumnRenamed("id", "query_id")
    want = brute_force(data, 5)
    for probes in (1, 3, 9):
        got = {}
        for r in cells.search_cells(asked, index, probes=probes, drop_same=True, exact=True).orderBy("rank").collect():
            got.setdefault(r.query_id, []).append(r.id)
        assert got == want
    near = cells.search_cells(asked, index, probes=cells.choose_probes(asked, index, drop_same=True), drop_same=True)
    found = {(r.query_id, r.id) for r in near.collect()}
    assert len(found & {(q, i) for q, ids in want.items() for i in ids}) >= 0.9 * 600


def test_small_cells_share_a_block(monkeypatch):
    """A question goes once to a block, not once to each of its cells; a large cell is several blocks."""
    monkeypatch.setattr(cells, "POINT_BLOCK", 10)
    sizes = {n: (size, 0.0) for n, size in enumerate([4, 5, 3, 25, 1, 9])}
    assert cells._blocks(sizes, range(6)) == {0: (0, 1), 1: (0, 1), 2: (1, 1), 3: (2, 3), 4: (5, 1), 5: (5, 1)}


class Batches:
    """Stands for a table: hands a function one batch after another and measures what it holds meanwhile."""

    def __init__(self, batch):
        self.batch, self.columns, self.sparkSession, self.sparkContext = batch, list(batch.columns), self, self
        self.schema = {c: SimpleNamespace(dataType=SimpleNamespace(simpleString=lambda: "any")) for c in batch.columns}

    def broadcast(self, value):
        return SimpleNamespace(value=value)

    def mapInPandas(self, function, schema):
        self.rows = 0
        tracemalloc.start()
        for part in function(iter([self.batch])):
            self.rows += len(part)
        self.peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return self

    def where(self, condition):
        return self


def test_cells_of_a_batch_are_taken_in_parts(spark):
    """A worker holds as little where a question has all of many cells as where it has a few."""
    rng = np.random.default_rng(6)
    rows, count = 3000, 800
    held = pd.DataFrame({"query_id": np.arange(rows), "vector": list(rng.normal(size=(rows, 16)).astype("float32"))})
    centres = cells._unit_rows(rng.normal(size=(count, 16)))
    placed = cells._placed(Batches(held), centres, count)
    assert placed.rows == rows and placed.peak < 30e6
    held["cells"], held["floor"] = [np.zeros(1, "int32")] * rows, -2.0
    index = cells.CellIndex(centres, None, {n: (1, -1.0) for n in range(count)})
    left = cells._open_cells(Batches(held), index, 1)
    assert left.rows == rows and left.peak < 30e6


def test_questions_are_sent_in_parts_to_each_block_once(monkeypatch):
    monkeypatch.setattr(cells, "SENT_AT_ONCE", 500)
    rng = np.random.default_rng(7)
    dealt = cells._blocks({n: (int(size), 0.0) for n, size in enumerate(rng.integers(1, 300, 800))} | {5: (70000, 0.0)}, range(0, 799))
    lists = [rng.permutation(800)[: n % 800].astype("int32") for n in range(2000)]
    ids, vectors = np.arange(2000), [np.full(64, n, "float32") for n in range(2000)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(vectors), pa.array(lists, pa.list_(pa.int32())), pa.array(ids / 7), pa.array(ids.astype("int32"))],
        ["query_id", "vector", "cells", "floor", "qb"])
    want = {}
    for n, names in enumerate(lists):
        for name in names.tolist():
            first, pieces = dealt.get(name, (0, 0))
            for block in range(first, first + pieces):
                want.setdefault((n, block), []).append(name)
    got = {}
    for part in cells._spread(dealt, 800)(iter([batch.slice(0, 700), batch.slice(700, 0), batch.slice(700)])):
        assert part.num_rows <= 500 or len(set(part.column("query_id").to_pylist())) == 1
        for row in part.to_pylist():
            assert row["vector"] == [row["query_id"]] * 64 and row["floor"] == row["query_id"] / 7 and row["qb"] == row["query_id"]
            assert (row["query_id"], row["pb"]) not in got
            got[row["query_id"], row["pb"]] = row["cells"]
    assert got == want


def test_a_collection_is_replaced_as_a_whole(spark, tmp_path):
    _, points = vectors(spark)
    rows = points.withColumn("note", F.lit("old"))
    path = str(tmp_path)
    cells.store_points(rows.where("id < 50"), path, cells=3, payload=["note"])
    before = cells.open_points(spark, path)
    draft = versions.draft(path)
    rows.write.parquet(f"{draft}/points")  # not published: nobody sees it
    assert cells.open_points(spark, path).points.count() == 50
    cells.store_points(rows.withColumn("note", F.lit("new")), path, cells=4, payload=["note"])
    assert before.points.count() == 50  # a reader goes on with its version
    index = cells.open_points(spark, path)
    assert index.points.count() == 120 and len(index.centres) == 4
    asked = points.where("id = 7").withColumnRenamed("id", "query_id")
    hits = cells.with_payload(cells.search_cells(asked, index, exact=True), index, ["note"]).collect()
    assert {h.note for h in hits} == {"new"} and min(hits, key=lambda h: h["rank"]).id == 7
    assert [v.number for v in versions.history(spark, path)] == [2, 1]
    with pytest.raises(FileNotFoundError):
        cells.open_points(spark, f"{path}/none")


def test_vectors_that_are_all_alike_or_empty(spark, tmp_path):
    same = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(30)], "id long, vector array<float>")
    cells.store_points(same, f"{tmp_path}/same", cells=4)
    index = cells.open_points(spark, f"{tmp_path}/same")
    asked = same.withColumnRenamed("id", "query_id").where("query_id = 9")
    assert [r.id for r in cells.search_cells(asked, index, exact=True).orderBy("rank").collect()] == [0, 1, 2, 3, 4]
    cells.store_points(same.limit(0), f"{tmp_path}/none")
    assert cells.search_cells(asked, cells.open_points(spark, f"{tmp_path}/none"), exact=True).count() == 0


def verdicts(decided):
    out = {}
    for r in decided.orderBy("user", "ask").collect():
        out.setdefault(r.user, []).append(r.refused_by)
    return out


def test_burst_and_daily_limits(spark):
    burst = [BASE + timedelta(seconds=s) for s in (0, 10, 20, 30, 40, 50, 60, 60)]
    daily = [BASE + timedelta(seconds=15 * i) for i in range(101)] + [BASE + timedelta(days=1)]
    got = verdicts(admission.rate_admission(asks(spark, {"b": burst, "d": daily}), "user", "at", "ask"))
    assert got["b"] == ["", "", "", "", "", "burst", "", "burst"]
    assert got["d"] == [""] * 100 + ["daily", ""]


def test_chunks_give_the_sequential_result(spark):
    rng = np.random.default_rng(11)
    hot = sorted(BASE + timedelta(seconds=float(s)) for s in rng.uniform(0, 4 * 86400, 1500))
    cold = sorted(BASE + timedelta(seconds=float(s)) for s in rng.uniform(0, 600, 40))
    want = {"hot": one_by_one(hot), "cold": one_by_one(cold)}
    data = asks(spark, {"hot": hot, "cold": cold}).cache()
    assert verdicts(admission.rate_admission(data, "user", "at", "ask")) == want
    cut = admission.rate_admission(data, "user", "at", "ask", chunk_rows=300)
    assert verdicts(cut) == want


@pytest.mark.parametrize("slots", [7, 60, 4000])
def test_bounds_hold_every_admission(slots):
    rng = np.random.default_rng(slots)
    for n, days in ((40, 1), (3000, 3), (3000, 40)):
        at = np.sort(rng.integers(0, days * 86_400, n)) * 1_000_000  # with ties
        want = at[admission.admit_in_order(at, [], 3, 60, 10)[0] == 0]
        place = at * slots // (at[-1] + 1)
        first, last, count = (np.array([f(at[place == p]) for p in np.unique(place)]) for f in (np.min, np.max, len))
        low, high = admission.admission_bounds(first, last, count, 3, 60, 10)
        assert len(low) >= len(want) and (low[: len(want)] <= want).all() and (want <= high[: len(want)]).all()
        spans = admission._spans(low, high)
        assert all(((spans["_low"] <= t) & (t <= spans["_high"])).any() for t in want)


def test_chunks_of_a_saturated_key_are_decided_from_few_asks(spark, monkeypatch):
    """The rounds from chunk to chunk see the asks that can be admitted, not all of them."""
    rng = np.random.default_rng(5)
    micros = np.sort(rng.integers(0, 3 * 86_400 * 10**6, 30_000))
    hot = [BASE + timedelta(microseconds=int(t)) for t in micros]
    seen, rounds = [], admission._decide_chunks
    monkeypatch.setattr(
        admission, "_decide_chunks", lambda rows, *rest: seen.append(rows.count()) or rounds(rows, *rest))
    decided = admission.rate_admission(asks(spark, {"u": hot}), "user", "at", "ask", chunk_rows=500)
    names = np.array(["", "burst", "daily"])
    assert verdicts(decided)["u"] == names[admission.admit_in_order(micros, [])[0]].tolist()
    assert seen[0] <= 500


def test_usage_counts_equal_a_scan(spark):
    rng = np.random.default_rng(2)
    times = sorted(BASE + timedelta(seconds=int(s)) for s in rng.integers(0, 2 * 86400, 200))
    times += [times[-1], times[-1] + timedelta(seconds=60)]
    rows = admission.usage_counts(
        asks(spark, {"u": times}), "user", "at", "ask", admission.USAGE_WINDOWS
    ).orderBy("ask").collect()
    for r, t in zip(rows, times):
        assert r.burst_used == sum(1 for x in times if t - timedelta(seconds=60) < x <= t)
        assert r.daily_used == sum(1 for x in times if t - timedelta(days=1) < x <= t)


def test_admission_stream_equals_batch(spark, tmp_path):
    rng = np.random.default_rng(4)
    times = sorted(BASE + timedelta(seconds=float(s)) for s in rng.uniform(0, 3000, 300))
    data = asks(spark, {"u": times, "v": times[::7]})
    # Out of order, over several micro-batches.
    data.repartition(5, "ask").write.parquet(f"{tmp_path}/asks")
    stream = sinks.read_files(
        spark, f"{tmp_path}/asks", "user string, ask long, at timestamp", files_per_trigger=1
    )
    admission_streams.admit_stream(
        stream, "user", "at", "ask", f"{tmp_path}/out", f"{tmp_path}/cp", late=None, cell_asks=32
    ).awaitTermination()
    decided = admission_streams.verdicts(spark, f"{tmp_path}/out", "user", "ask")
    got = {}
    for r in decided.orderBy("user", "ask").collect():
        got.setdefault(r.user, []).append(r.refused_by)
    assert got["u"] == list(one_by_one(times))
    assert got["v"] == list(one_by_one(times[::7]))


def deal(asks_of, rng, size):
    while asks_of:
        taken = rng.randint(1, size)
        yield asks_of[:taken]
        asks_of = asks_of[taken:]


@pytest.mark.parametrize("spread", [0, 90, 10**6])
def test_history_equals_deciding_in_order(spread):
    """Asks in order, a little late, or in any order; few and many in a cell."""
    rng = random.Random(spread)
    for n, span in ((5, 300), (300, 4000), (300, 300_000)):
        rows = [(rng.randrange(2 * span) * 500_000, i) for i in range(n)]
        cells, starts, latest, decided = {}, [], {}, []
        for batch in deal(sorted(rows, key=lambda r: r[0] + rng.randrange(spread + 1) * 1_000_000), rng, 30):
            history = admission.KeyHistory(
                starts, cells.__getitem__, cells.__setitem__, cells.__delitem__, 3, 60, 10, cell_asks=16)
            latest |= {d.id: d for d in history.add(batch)}
            starts = history.starts
            decided.append(history.decided)
            assert sorted(cells) == starts
        rows.sort()
        at = np.array([t for t, _ in rows])
        want, _ = admission.admit_in_order(at, [], 3, 60, 10)
        taken = at[want == 0]
        for (t, i), verdict in zip(rows, want):
            got = latest[i]
            assert (got.at, got.verdict) == (t, verdict)
            for used, seconds in ((got.burst_used, 60), (got.daily_used, 86_400)):
                assert used == (((taken <= t) & (taken > t - seconds * 10**6)).sum() if verdict == 0 else 0)


def test_decided_asks_do_not_grow_with_the_history():
    """Batches of the same lateness look at about as many asks at the end as at the start."""
    rng = random.Random(8)
    rows = sorted(((n * 2_000_000, n) for n in range(20_000)), key=lambda r: r[0] + rng.randrange(60) * 10**6)
    cells, starts, decided = {}, [], []
    for begin in range(0, len(rows), 100):
        history = admission.KeyHistory(starts, cells.__getitem__, cells.__setitem__, cells.__delitem__, cell_asks=64)
        history.add(rows[begin : begin + 100])
        history.forget_before(rows[begin][0] - 3600 * 10**6)
        starts = history.starts
        decided.append(history.decided)
    assert max(decided[100:]) <= max(decided[2:100]) + 64
    assert len(cells) < 100


def test_asks_beyond_the_lateness_are_refused_as_late(spark, tmp_path):
    for number, seconds in enumerate([[100_000], [100_020, 40_000], [99_990]]):
        rows = asks(spark, {"u": [BASE + timedelta(seconds=s) for s in seconds]})
        rows.withColumn("ask", F.col("ask") + 10 * number).coalesce(1).write.mode("append").parquet(f"{tmp_path}/asks")
    stream = sinks.read_files(
        spark, f"{tmp_path}/asks", "user string, ask long, at timestamp", files_per_trigger=1
    )
    decided = admission_streams.admit_stream(
        stream, "user", "at", "ask", f"{tmp_path}/out", f"{tmp_path}/cp", late=3600
    )
    decided.awaitTermination()
    got = admission_streams.verdicts(spark, f"{tmp_path}/out", "user", "ask")
    late = {r["at"] for r in got.where("refused_by = 'late'").collect()}
    assert late == {BASE + timedelta(seconds=40_000)}
    used = admission_streams.usage(spark, f"{tmp_path}/out", "user", "ask").collect()
    assert {(r["at"] - BASE).total_seconds(): r.burst_used for r in used} == {99_990: 1, 100_000: 2, 100_020: 3}


def test_stream_keeps_null_and_large_keys_apart(spark, tmp_path):
    times = [BASE + timedelta(seconds=s) for s in range(7)]
    for part in (0, 1):
        rows = [(key, 2**60 + 10 * n + i, t) for n, key in enumerate((None, 2**60 + 1, 2**60 + 2))
                for i, t in enumerate(times) if i % 2 == part]
        spark.createDataFrame(rows, "user long, ask long, at timestamp").coalesce(1).write.mode("append").parquet(
            f"{tmp_path}/asks")
    stream = sinks.read_files(spark, f"{tmp_path}/asks", "user long, ask long, at timestamp", files_per_trigger=1)
    admission_streams.admit_stream(
        stream, "user", "at", "ask", f"{tmp_path}/out", f"{tmp_path}/cp", late=3600, groups=1).awaitTermination()
    got = admission_streams.verdicts(spark, f"{tmp_path}/out", "user", "ask").collect()
    assert {(r.user, r.ask): r.refused_by for r in got} == {
        (key, 2**60 + 10 * n + i): "" if i < 5 else "burst"
        for n, key in enumerate((None, 2**60 + 1, 2**60 + 2)) for i in range(7)}
    assert len(got) == 21


class MapOfState(dict):
    def __init__(self):
        self.calls = 0

    def getValue(self, key):
        self.calls += 1
        return self.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value

    def removeKey(self, key):
        self.calls += 1
        del self[key]


@pytest.mark.parametrize("late", [None, 400])
def test_a_group_of_keys_is_one_call_with_few_state_calls(late):
    rng = random.Random(6)
    maps = {"keys": MapOfState(), "cells": MapOfState()}
    handle = type("Handle", (), {"getMapState": lambda self, name, *rest: maps[name]})()
    history = admission_streams.AskHistory({"key": "long", "id": "long"}, (3, 60, 10), late, 16)
    history.init(handle)
    asks_of = {key: sorted(rng.randrange(3000) for _ in range(8 if key else 200)) for key in range(50)}
    latest = {}
    for batch in range(4):
        rows = [(key, False, 1000 * key + i, False, at * 1_000_000) for key, ats in asks_of.items()
                for i, at in enumerate(ats) if i * 4 // len(ats) == batch]
        frame = pd.DataFrame(rows, columns=["key", "no_key", "id", "no_id", "at"])
        before = maps["keys"].calls
        for out in history.handleInputRows((0,), iter([frame[:20], frame[20:]]), None):
            latest |= {(r.key, r.id): r.verdict for r in out.itertuples()}
        assert maps["keys"].calls - before == 2 * 50
    assert {name for name, _ in maps["cells"]} == {0}  # only the key with many asks has older cells
    for key, ats in asks_of.items():
        want, _ = admission.admit_in_order(np.array(ats) * 1_000_000, [], 3, 60, 10)
        assert [latest[key, 1000 * key + i] for i in range(len(ats))] == want.tolist()
