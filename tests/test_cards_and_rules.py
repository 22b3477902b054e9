from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shelfcast import config
from shelfcast.operators import cards, decisions, replay, reports, topics
from shelfcast.plans import chain
from shelfcast.sources import documents, tables, versions
from shelfcast.streaming import sinks

START = date(2020, 3, 1)


def now():
    return F.lit("2020-04-01 12:00:00").cast("timestamp")


SCHEMA = (
    "item_id string, store_id string, date date, actual_sales long, forecast double, "
    "p90_forecast double, on_hand_inventory double, stockout_risk_flag int, anomaly_flag int, "
    "anomaly_score double, normalized_residual double"
)


def day(n):
    return START + timedelta(days=n)


def row(item, n, risk, odd, residual=1.0, score=-0.5, p90=10.0, stock=50.0):
    return (item, "s", day(n), 4, 3.25, p90, stock, risk, odd, score, residual)


def scored(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def by_item(df):
    return {r.item_id: r for r in df.collect()}


def test_cards(spark):
    rows = [row("chronic", n, 1, 0) for n in range(6)]
    rows += [row("once", 0, 0, 0), row("once", 1, 1, None, score=None)]
    rows += [row("mixed", 0, 1, 0), row("mixed", 4, 0, 1, residual=-2.5)]
    rows += [row("calm", 0, 0, 0), row("late_null", 0, 1, 0), row("late_null", 1, 1, 0, score=None)]
    table = scored(spark, rows).cache()
    got = by_item(cards.build_cards(table))
    assert set(got) == {"chronic", "once", "mixed", "late_null"}
    assert got["chronic"].days_flagged == 6
    assert got["chronic"].first_flagged_date == "2020-03-01"
    assert got["chronic"].summary == (
        "Item chronic at store s, latest as of 2020-03-06: forecasted demand 3.3, actual 4.0. "
        "Stockout risk: P90 demand (10.0) exceeds on-hand inventory (50.0) — "
        "flagged for 6 of the last 28 days (since 2020-03-01)."
    )
    assert "flagged today" in got["once"].summary and got["once"].anomaly_flag == 0
    assert (got["mixed"].stockout_risk_flag, got["mixed"].days_flagged) == (0, 1)
    assert got["mixed"].summary.endswith("unusually lower than expected.")
    # Every field comes from the latest row, also when it is null there.
    assert got["late_null"].anomaly_score is None and got["late_null"].date == "2020-03-02"
    assert cards.flagged_series_count(table).first()[0] == 4
    routed = {(r.item_id, r.topic) for r in decisions.route_cards(cards.build_cards(table)).collect()}
    assert routed == {
        ("chronic", "stockout_risk"), ("once", "stockout_risk"),
        ("late_null", "stockout_risk"), ("mixed", "anomaly_drop"),
    }
    none = cards.build_cards(scored(spark, [row("calm", 0, 0, None)]))
    assert none.isEmpty() and none.columns == cards.build_cards(table).columns
    kpi = reports.kpi(table, cards.build_cards(table)).first()
    assert (kpi.rows_scored, kpi.n_cards) == (13, 4)
    assert reports.default_series(table).first().item_id == "chronic"


def test_replay_sees_each_batch_alone(spark):
    table = scored(spark, [row("a", n, int(n in (0, 2, 5)), 0) for n in range(6)])
    built = replay.batch_cards(table, batch_days=1).orderBy("batch").collect()
    assert [(r.batch, r.days_flagged) for r in built] == [(0, 1), (2, 1), (5, 1)]
    report = replay.batch_report(replay.batch_cards(table, batch_days=3)).orderBy("batch").collect()
    assert [tuple(r) for r in report] == [(0, 1, 1, 1), (1, 1, 1, 1)]
    assert replay.batch_cards(table, 1, max_batches=2).count() == 1


def card_rows(spark, rows):
    return cards.build_cards(scored(spark, rows))


def test_rules(spark):
    built = card_rows(
        spark, [row("need", 0, 1, 0), row("none", 0, 1, 0, p90=1.0), row("big", 0, 1, 0, p90=79.8214)]
    )
    reorders = by_item(decisions.propose_reorders(built))
    assert (reorders["need"].reorder_qty, reorders["none"].reorder_qty) == (34.0, 0.0)
    requests = spark.createDataFrame(
        [("c1", "tight", "s", 100.0, 10.0, 0.0), ("c2", "tight", "s", 60.0, 10.0, 0.0),
         ("c3", "unknown", "s", 501.0, 10.0, 0.0)],
        chain.REORDER_SCHEMA,
    )
    supplier = spark.createDataFrame(
        [("tight", 60.0, 4)], "item_id string, max_order_capacity double, lead_time_days int"
    )
    outcome = {r.card_id: r for r in decisions.check_capacity(requests, supplier).collect()}

    def shape(r):
        return r.procurement_status, r.fulfilled_qty, r.backordered_qty, r.lead_time_days

    assert shape(outcome["c1"]) == ("delayed", 60.0, 40.0, 4)
    assert shape(outcome["c2"]) == ("confirmed", 60.0, 0.0, 4)
    assert shape(outcome["c3"]) == ("delayed", 500.0, 1.0, 7)
    spend = spark.createDataFrame(
        [("c1", "x", "s", 1.0, 2500.0, 0.0, "confirmed", 1.0, 0.0, 3),
         ("c2", "x", "s", 1.0, 2500.002, 0.0, "confirmed", 1.0, 0.0, 3)],
        chain.OUTCOME_SCHEMA,
    )
    cost = spark.createDataFrame([("x", 1.0)], "item_id string, cost_ratio double")
    decided = {r.card_id: r for r in decisions.approve_spend(spend, cost).collect()}
    assert (decided["c1"].finance_status, decided["c2"].finance_status) == (
        "approved", "flagged_for_review",
    )
    assert decided["c2"].estimated_order_cost == 5000.0
    drops = spark.createDataFrame([(-3.0,), (-2.0,), (-1.99,)], "r double")
    steps = [r[0] for r in drops.select(decisions.discount_for(F.col("r"))).collect()]
    assert steps == [20.0, 15.0, 10.0]


def test_bounded_poll_and_backlog(spark, tmp_path):
    store = topics.TopicStore(spark, str(tmp_path))
    rows = spark.range(60).select(
        F.format_string("c%03d", "id").alias("card_id"), F.col("id").alias("value")
    )
    store.publish(topics.messages(rows, "t", now()))
    first = store.poll("t", now(), 50).select("id").collect()
    assert len(first) == 50
    assert {r.topic: r.pending for r in store.backlog().collect()} == {"t": 10}
    second = store.poll("t", now(), 50).select("id").collect()
    assert len(second) == 10 and not {r.id for r in first} & {r.id for r in second}
    assert store.backlog().isEmpty()


def test_chain_over_stored_topics(spark, tmp_path):
    built = card_rows(
        spark,
        [row("need", 0, 1, 0), row("none", 0, 1, 0, p90=1.0), row("drop", 0, 0, 1, residual=-2.04)],
    ).cache()
    supplier = spark.createDataFrame(
        [("need", 30.0, 5)], "item_id string, max_order_capacity double, lead_time_days int"
    )
    cost = spark.createDataFrame([("need", 0.5)], "item_id string, cost_ratio double")
    store = topics.TopicStore(spark, str(tmp_path / "topics"))
    reorders = decisions.positive_reorders(decisions.propose_reorders(built))
    rationales = chain.reorder_rationales(built, reorders)
    chain.run_chain(built, supplier, cost, store, now(), rationales=rationales)
    log = store.actions().cache()
    names = {r.action: r["count"] for r in log.groupBy("action").count().collect()}
    assert names == {
        "published_insights": 1, "reorder_recommended": 1, "procurement_delayed": 1,
        "finance_approved": 1, "promo_proposed": 1,
    }
    backlog, latest = reports.chain_report(store.queue(), store.consumed(), log)
    assert backlog.isEmpty() and latest.count() == 5
    lifted = {r.action: r.reorder_qty for r in reports.recent_actions(log).collect()}
    assert lifted["reorder_recommended"] == 34.0 and lifted["finance_approved"] is None
    rationale = reports.rationale_of(log, "need_s").first().rationale
    assert "Item need at store s" in rationale
    promo = log.where("action = 'promo_proposed'").first().details
    assert "Sales ran 2.0 deviations under the forecast" in promo
    # The lazy chain gives the same decision.
    decided, promos = decisions.decide(built, supplier, cost)
    assert [(r.fulfilled_qty, r.finance_status) for r in decided.collect()] == [(30.0, "approved")]
    assert promos.count() == 1


def test_card_documents_and_maps(spark, tmp_path):
    built = card_rows(spark, [row("a", 0, 1, 0), row("b", 0, 1, 1)])
    tables.write_json_lines(built, str(tmp_path / "cards"))
    back = tables.read_json_lines(spark, str(tmp_path / "cards"), cards.CARD_SCHEMA, "cards")
    assert sorted(back.collect()) == sorted(built.collect())
    (tmp_path / "array.json").write_text('[{"id": "x", "days_flagged": 2},\n {"id": "y"}]')
    array = documents.read_json_array(
        spark, str(tmp_path / "array.json"), "id string, days_flagged int", "cards"
    )
    assert sorted(tuple(r) for r in array.collect() if r.days_flagged) == [("x", 2)]
    (tmp_path / "map.json").write_text('{\n "i1": {"cost_ratio": 0.5},\n "i2": {"cost_ratio": 0.7}\n}')
    cost = documents.read_json_map(spark, str(tmp_path / "map.json"), "cost_ratio double", "item_cost")
    assert sorted(tuple(r) for r in cost.collect()) == [("i1", 0.5), ("i2", 0.7)]
    with pytest.raises(tables.MissingInput, match="item_cost"):
        documents.read_json_map(spark, str(tmp_path / "no.json"), "cost_ratio double", "item_cost")


def test_feed_filter(spark):
    built = card_rows(spark, [row("a", 0, 1, 0)])
    assert reports.card_feed(built, []).count() == 1
    assert reports.card_feed(built, ["other"]).count() == 0
    assert list(reports.card_feed(built).columns) == list(reports.FEED_COLUMNS)
    assert config.TOPIC_STOCKOUT == "stockout_risk"


def test_marks_and_late_messages(spark, tmp_path):
    """A repeated batch marks once; a message published late under an old time is not lost."""
    store = topics.TopicStore(spark, str(tmp_path))

    def published(ids, hour):
        rows = spark.createDataFrame([(f"c{i:03d}",) for i in ids], "card_id string")
        store.publish(topics.messages(rows, "t", F.lit(f"2024-01-01 {hour:02d}:00:00").cast("timestamp")))
        return rows

    def cards_of(df):
        return sorted(int(r.card_id[1:]) for r in df.collect())

    published(range(10), 5)
    published(range(10, 20), 7)
    published(range(5), 5)  # published again: the same messages
    assert cards_of(store.pending("t")) == list(range(20))
    assert len(cards_of(store.poll("t", now(), 12))) == 12
    batch = store.pending("t").orderBy("card_id").limit(3)
    kept = spark.createDataFrame(batch.collect(), batch.schema)
    for _ in range(2):
        store.mark(kept, now(), "t")
    left = cards_of(store.pending("t"))
    assert len(left) == 5
    first = store.compact("t")
    assert cards_of(store.pending("t")) == left
    published(range(20, 24), 6)  # between what is marked already
    published([30], 9)
    assert cards_of(store.pending("t")) == sorted([*left, 20, 21, 22, 23, 30])
    second = store.compact("t")
    assert (second.at, second.id) >= (first.at, first.id) and second.epoch == 2
    assert cards_of(store.pending("t")) == sorted([*left, 20, 21, 22, 23, 30])
    oldest = cards_of(store.poll("t", now(), 4))
    assert oldest == [20, 21, 22, 23]
    store.compact("t")
    while cards_of(store.poll("t", now(), 4)):
        pass
    assert store.backlog().isEmpty() and store.pending("t").isEmpty()
    mark = store.compact("t")
    assert spark.read.parquet(f"{tmp_path}/consumed/topic=t/consumer=default/epoch={mark.epoch}").isEmpty()
    assert cards_of(store.pending("t", "other")) == [*range(24), 30]
    assert {r.id for r in store.consumed().collect()} == {r.id for r in store.queue().collect()}


def test_a_table_of_changes_is_compacted(spark, tmp_path):
    """Reads stay right before, between and after snapshots; merging again changes nothing."""
    path = str(tmp_path / "table")
    want = {}
    for epoch in range(7):
        rows = [(k, epoch * 10 + k) for k in range(epoch, epoch + 3)]
        want |= dict(rows)
        spark.createDataFrame(rows, "k long, v long").write.parquet(f"{path}/changes/epoch={epoch}")
        if epoch in (1, 4):
            sinks.compact_table(spark, path, ["k"], epoch, "q")
            sinks.compact_table(spark, path, ["k"], epoch, "q")
        assert {r.k: r.v for r in sinks.current_rows(spark, path, ["k"]).collect()} == want
    assert len(versions.history(spark, f"{path}/snapshots")) == 2
    left = sinks._changes(spark, path, sinks._snapshot(spark, path)[1])
    assert {r.epoch for r in left.select("epoch").distinct().collect()} == {5, 6}
    with pytest.raises(FileNotFoundError):
        sinks.current_rows(spark, str(tmp_path / "none"), ["k"])
