from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import check_queries
from shelfcast.operators import retrieval
from shelfcast.sources import artifacts

FOLDER = "/root/testdata/sf0.001"

needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not there")


@pytest.fixture(scope="module")
def con():
    return check_queries.connect(FOLDER)


@needs_tables
@pytest.mark.parametrize(
    "name",
    [
        "fact_panel",
        "feature_profile",
        "unpivot_long",
        "insight_cards",
        "decision_chain",
        "queue_depth",
        "replay_stream",
        "decision_stream",
        "rate_limit_global",
    ],
)
def test_query_equals_sql(spark, con, name):
    good, note = check_queries.compare(spark, con, FOLDER, name)
    assert good, note


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert isinstance(duckdb.__version__, str)


@needs_tables
def test_entry(spark):
    assert contract.entry(spark).where(F.col("lag_28").isNull()).isEmpty()


def test_points_and_tables_are_replaced(spark, tmp_path):
    rows = spark.createDataFrame(
        [("a", [1.0, 0.0], "x"), ("b", [0.0, 1.0], "y")],
        "id string, vector array<float>, summary string",
    )
    points = retrieval.build_points(rows, "id", ["id", "summary"])
    path = str(tmp_path / "points")
    assert retrieval.replace_points(points, path) == 2
    assert retrieval.replace_points(points.limit(1), path) == 1
    artifacts.publish_tables(spark, {"points": path}, str(tmp_path / "copy"))
    assert spark.read.parquet(str(tmp_path / "copy" / "points")).count() == 1


def test_text_vectors_use_the_whole_text(spark):
    words = [f"w{i}" for i in range(3000)]
    texts = spark.createDataFrame(
        [("a", " ".join(words)), ("b", " ".join([*words, "last"])), ("c", "w1 w2"),
         ("d", "other words")],
        "id string, text string",
    )
    model = retrieval.fit_embedder(texts, size=1 << 14)
    got = {r.id: r.vector for r in retrieval.embed(model, texts).collect()}
    assert got["a"] != got["b"]
    for vector in got.values():
        assert sum(v * v for v in vector) == pytest.approx(1.0, abs=1e-3)
