"""Named queries over the test tables: each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast import config
from shelfcast.functions.scalars import round_decimal
from shelfcast.operators import (
    admission,
    anomaly,
    bundles,
    cards,
    cells,
    decisions,
    evaluate,
    features,
    forecast,
    inventory,
    isolation,
    panel,
    replay,
    reports,
    reshape,
    retrieval,
    score,
    split,
    topics,
)
from shelfcast.plans import chain, scoring
from shelfcast.session import scratch_path, tune
from shelfcast.sources import documents, retail
from shelfcast.sources.tables import read_table, stage
from shelfcast.streaming import admission as admission_streams
from shelfcast.streaming import cards as card_streams
from shelfcast.streaming import sinks
from shelfcast.streaming.decisions import TopicStreams, card_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(tune(spark), folder)

    QUERIES[build.__name__] = run
    return run


def _text_dates(df: DataFrame) -> DataFrame:
    dates = [f.name for f in df.schema.fields if f.dataType.typeName() == "date"]
    return df.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else df


def _rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: round_decimal(c, places) for c in columns})


# Shared inputs ------------------------------------------------------------------------


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    """Scored validation window of every fine series, from staged predictions."""
    span = retail.span_of(spark, folder)
    fact = retail.fact_table(spark, folder, since=scoring.history_start(span.last))
    predictions = scoring.baseline_predictions(fact, retail.cover_columns(), span.last)
    return scoring.baseline_scored(stage(predictions, "predictions"))


def _cards(spark: SparkSession, folder: str) -> DataFrame:
    return cards.build_cards(_scored(spark, folder))


def _coarse_features(spark: SparkSession, folder: str) -> DataFrame:
    return features.build_features(retail.fact_table(spark, folder, "coarse"))


def _decisions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return decisions.decide(
        _cards(spark, folder),
        retail.supplier_dimension(spark, folder),
        retail.cost_dimension(spark, folder),
    )


def _card_time() -> Column:
    return F.to_timestamp("date")


def _queue(spark: SparkSession, folder: str) -> DataFrame:
    routed = decisions.route_cards(_cards(spark, folder))
    fields = [c for c in routed.columns if c != "topic"]
    queue = topics.messages(routed, F.col("topic"), _card_time(), "id", fields)
    return stage(queue, "queue")


def _consumed(queue: DataFrame) -> DataFrame:
    """Consumption log after one bounded poll of the stockout topic."""
    nothing = queue.sparkSession.createDataFrame([], topics.CONSUMED_SCHEMA)
    taken = topics.poll(queue, nothing, config.TOPIC_STOCKOUT)
    return topics.consumption(taken, F.col("created_at"), "first")


def _action_log(spark: SparkSession, folder: str) -> DataFrame:
    """Actions of the reorder step and the promo step, dated by their card."""
    built = _cards(spark, folder)
    routed = decisions.route_cards(built)
    at_risk = decisions.on_topic(routed, config.TOPIC_STOCKOUT)
    reorders = decisions.positive_reorders(
        decisions.propose_reorders(at_risk, keep=["date", F.col("summary").alias("rationale")])
    )
    recommended = topics.actions(
        reorders,
        "inventory_agent",
        "reorder_recommended",
        _card_time(),
        details=["item_id", "store_id", "reorder_qty", "rationale"],
    )
    dropped = decisions.on_topic(routed, config.TOPIC_DROP)
    promos = decisions.propose_promos(dropped, keep=["date"])
    proposed = topics.actions(
        promos,
        "marketing_agent",
        "promo_proposed",
        _card_time(),
        details=[c for c in promos.columns if c != "date"],
    )
    return recommended.unionByName(proposed)


# Ingest and features ------------------------------------------------------------------


@query
def features_(spark, folder):
    """Leakage-free features per series and day, full history of the coarse series."""
    rows = _coarse_features(spark, folder)
    return _text_dates(
        _rounded(rows, "roll_mean_7", "roll_std_7", "roll_mean_28", "roll_std_28")
    )


QUERIES["features"] = QUERIES.pop("features_")


@query
def feature_profile(spark, folder):
    """Features of every fine series and day, summed up per series."""
    rows = features.build_features(retail.fact_table(spark, folder))

    def exact(column):
        return F.sum(F.round(F.col(column).cast("decimal(18,6)"), 6)).cast("double").alias(column)

    def whole(column):
        return F.sum(column).cast("long").alias(column)

    return rows.groupBy(*config.HIERARCHY).agg(
        F.count("*").alias("n_rows"),
        *(whole(c) for c in ("sales", "is_weekend", "has_event", "snap_active")),
        *(whole(f"lag_{n}") for n in config.LAG_DAYS),
        *(exact(f"roll_mean_{n}") for n in config.ROLL_WINDOWS),
        *(round_decimal(F.sum(f"roll_std_{n}"), 3).alias(f"roll_std_{n}") for n in config.ROLL_WINDOWS),
        F.count("sell_price").alias("n_priced"),
        F.count("price_change_7d").alias("n_price_changes"),
        round_decimal(F.sum("price_change_7d"), 3).alias("price_change"),
    )


def _monthly_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Wide table with one row per series and month and one column per day of the month.

    Days a month does not have are NULL."""
    span = retail.span_of(spark, folder)
    long = retail.sales_long(retail.daily_sales(spark, folder, "coarse"), span)
    dated = long.withColumns(
        {
            "month": F.date_format("date", "yyyy-MM"),
            "d": F.concat(F.lit("d_"), F.dayofmonth("date")),
        }
    )
    days = [f"d_{i}" for i in range(1, 32)]
    return reshape.pivot_days(dated, (*config.HIERARCHY, "month"), days)


@query
def unpivot_long(spark, folder):
    """Wide monthly table back to one row per series and day."""
    return reshape.unpivot_days(_monthly_wide(spark, folder), (*config.HIERARCHY, "month"))


@query
def melt_keep_nulls(spark, folder):
    """The wide monthly table molten with its nulls, counted per series."""
    wide = _monthly_wide(spark, folder)
    molten = reshape.melt(wide, (*config.SERIES, "month"), reshape.day_columns(wide))
    return molten.groupBy(*config.SERIES).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("sales").isNull()).alias("n_null"),
        F.sum("sales").alias("total"),
    )


@query
def dense_panel(spark, folder):
    span = retail.span_of(spark, folder)
    long = retail.sales_long(retail.daily_sales(spark, folder), span)
    return _text_dates(
        long.groupBy(*config.SERIES).agg(
            F.count("*").alias("n_days"),
            F.min("date").alias("first_day"),
            F.max("date").alias("last_day"),
            F.sum("sales").alias("total"),
            F.count_if(F.col("sales") == 0).alias("n_zero"),
        )
    )


@query
def fact_panel(spark, folder):
    """Long sales joined with the calendar and the weekly prices."""
    span = retail.span_of(spark, folder)
    daily = stage(retail.daily_sales(spark, folder, "coarse"), "daily")
    fact = panel.build_fact(
        retail.sales_long(daily, span),
        retail.calendar(spark, span),
        retail.weekly_prices(daily, span),
    )
    return _text_dates(fact)


@query
def price_left_join(spark, folder):
    """Weekly prices joined to every fine series: days without a price are kept."""
    span = retail.span_of(spark, folder)
    daily = stage(retail.daily_sales(spark, folder), "daily")
    days = panel.with_calendar(retail.sales_long(daily, span), retail.calendar(spark, span))
    priced = panel.with_prices(days, retail.weekly_prices(daily, span))
    return priced.groupBy(*config.SERIES).agg(
        F.count("*").alias("n_days"),
        F.count("sell_price").alias("n_priced"),
        round_decimal(F.sum("sell_price"), 3).alias("price_sum"),
    )


@query
def series_count(spark, folder):
    return panel.fact_counts(retail.fact_table(spark, folder))


@query
def sampled_series(spark, folder):
    """All days of the first three fine series, by a semi-join on the key set."""
    daily = retail.daily_sales(spark, folder)
    chosen = panel.first_series(daily, 3)
    return _text_dates(chosen.select(*config.SERIES_DAY, "sales"))


@query
def first_rows(spark, folder):
    daily = retail.daily_sales(spark, folder).select(*config.SERIES_DAY, "sales")
    return _text_dates(panel.first_rows(daily, config.SERIES_DAY, 10))


@query
def shifted_features(spark, folder):
    """Yesterday's sales, full-frame statistics, and the leaky mean they differ from."""
    over = features.series_window()
    rows = retail.fact_table(spark, folder, "coarse").select(
        *config.SERIES_DAY,
        *features.lags("sales", [1], over),
        *features.trailing_full("sales", 7, over),
        features.leaky_mean("sales", 7, over),
    )
    return _text_dates(_rounded(rows, "roll_mean_7", "roll_std_7", "leaky_mean_7"))


@query
def panel_coverage(spark, folder):
    return panel.series_coverage(retail.daily_sales(spark, folder))


# Split and quality --------------------------------------------------------------------


@query
def time_split_counts(spark, folder):
    train, validation = split.time_split(_coarse_features(spark, folder))

    def part(rows, name):
        return rows.agg(
            F.lit(name).alias("part"),
            F.count("*").alias("n_rows"),
            F.min("date").cast("string").alias("first_day"),
            F.max("date").cast("string").alias("last_day"),
        )

    return part(train, "train").unionByName(part(validation, "validation"))


@query
def point_metrics(spark, folder):
    return _rounded(evaluate.point_metrics(_scored(spark, folder)), "rmse", "mae", "mape", places=4)


@query
def risk_metrics(spark, folder):
    return _rounded(
        evaluate.risk_metrics(_scored(spark, folder)),
        "pinball_loss",
        "p90_coverage",
        "flagged_stockout_rate",
    )


@query
def flag_rates(spark, folder):
    return evaluate.flag_rates(_scored(spark, folder))


@query
def calibration(spark, folder):
    return evaluate.calibration(stage(retail.daily_sales(spark, folder), "daily"), "sales")


@query
def median_demand(spark, folder):
    rows = stage(_coarse_features(spark, folder).select("roll_mean_28"), "means")
    return rows.agg(
        F.first(evaluate.median(rows, "roll_mean_28")).alias("median_roll_mean_28"),
        F.count("*").alias("n_rows"),
    )


@query
def histogram(spark, folder):
    return evaluate.histogram(retail.daily_sales(spark, folder), "sales")


@query
def share_above_mean(spark, folder):
    return evaluate.share_above_mean(retail.daily_sales(spark, folder), "sales")


# Risk, anomaly and scored table ---------------------------------------------------------


@query
def anomaly_features(spark, folder):
    rows = _scored(spark, folder).select(
        *config.SERIES_DAY, "residual", "resid_roll_std", "normalized_residual", "abs_residual"
    )
    return _text_dates(_rounded(rows, "resid_roll_std", "normalized_residual"))


@query
def labelled_residuals(spark, folder):
    """Residuals of the first and the last series, one below the other."""
    rows = _scored(spark, folder)
    pair = F.struct(*config.SERIES)

    def residuals_of(which):
        chosen = rows.select(which(pair)).scalar()
        return rows.where(pair == chosen).select(*config.SERIES_DAY, "residual")

    parts = {"A": residuals_of(F.min), "B": residuals_of(F.max)}
    return _text_dates(anomaly.labelled_union(parts))


@query
def inventory_levels(spark, folder):
    rows = _scored(spark, folder).select(*config.SERIES_DAY, "roll_mean_28", "on_hand_inventory")
    return _text_dates(_rounded(rows, "roll_mean_28"))


@query
def stockout_flags(spark, folder):
    return _text_dates(
        _scored(spark, folder).select(
            *config.SERIES_DAY, "p90_forecast", "on_hand_inventory", "stockout_risk_flag"
        )
    )


@query
def scored(spark, folder):
    """The three outputs as separate tables, merged on the series-day key."""
    rows = _scored(spark, folder)
    merged = score.merge_outputs(
        rows.withColumnRenamed("actual_sales", "sales"),
        rows.where(F.col("on_hand_inventory") > 0),
        rows.where(F.col("normalized_residual").isNotNull()),
    )
    return _text_dates(_rounded(merged, "anomaly_score", "normalized_residual"))


# Cards and reports ------------------------------------------------------------------------


@query
def insight_cards(spark, folder):
    return _rounded(_cards(spark, folder), "anomaly_score", "normalized_residual")


@query
def card_documents(spark, folder):
    """The cards, written as documents of one JSON array each and read back by splits."""
    built = stage(_cards(spark, folder), "cards")
    path = scratch_path(spark, "card-documents")
    documents.write_json_arrays(built, path, documents=1 + built.count() // 10_000)
    back = documents.read_json_array(spark, path, built.schema, "cards")
    return _rounded(back, "anomaly_score", "normalized_residual")


@query
def part_documents(spark, folder):
    """Parts as JSON objects keyed by part, read back as one row per key."""
    part = read_table(spark, folder, "part").select("p_partkey", "p_name", "p_retailprice")
    path = scratch_path(spark, "part-documents")
    documents.write_json_maps(part, path, "p_partkey", documents=1 + part.count() // 10_000)
    return documents.read_json_map(spark, path, "p_name string, p_retailprice double", "parts", "part")


@query
def persistence(spark, folder):
    return _text_dates(cards.persistence(_scored(spark, folder)))


@query
def latest_state(spark, folder):
    return _text_dates(
        cards.latest_state(_scored(spark, folder)).select(
            *config.SERIES_DAY, "actual_sales", "forecast", "stockout_risk_flag", "anomaly_flag",
            "days_flagged", "first_flagged_date",
        )
    )


@query
def flagged_series(spark, folder):
    return cards.flagged_series_count(_scored(spark, folder))


@query
def kpi(spark, folder):
    rows = _scored(spark, folder)
    return reports.kpi(rows, cards.build_cards(rows))


@query
def series_list(spark, folder):
    return reports.series_list(_scored(spark, folder))


@query
def default_series(spark, folder):
    return reports.default_series(_scored(spark, folder))


@query
def series_slice(spark, folder):
    rows = _scored(spark, folder)
    chosen = reports.default_series(rows)
    return _text_dates(
        reports.series_slice(
            rows, chosen.select("item_id").scalar(), chosen.select("store_id").scalar()
        )
    )


@query
def card_feed(spark, folder):
    return reports.card_feed(_cards(spark, folder), ["NATION_3", "NATION_7"])


# Decision rules -----------------------------------------------------------------------------


@query
def route(spark, folder):
    return decisions.route_cards(_cards(spark, folder)).select("id", "topic")


@query
def routing_counts(spark, folder):
    return decisions.routing_counts(decisions.route_cards(_cards(spark, folder)))


@query
def reorder(spark, folder):
    at_risk = decisions.on_topic(
        decisions.route_cards(_cards(spark, folder)), config.TOPIC_STOCKOUT
    )
    return decisions.propose_reorders(at_risk)


@query
def procurement(spark, folder):
    at_risk = decisions.on_topic(
        decisions.route_cards(_cards(spark, folder)), config.TOPIC_STOCKOUT
    )
    reorders = decisions.positive_reorders(decisions.propose_reorders(at_risk))
    return decisions.check_capacity(reorders, retail.supplier_dimension(spark, folder))


@query
def finance(spark, folder):
    return _decisions(spark, folder)[0]


@query
def promos(spark, folder):
    """Promotions for every flagged series-day, as a replay of single days proposes them."""
    days = _scored(spark, folder).withColumn("day", F.col("date"))
    routed = decisions.route_cards(cards.build_cards(days, ["day"]))
    proposed = decisions.propose_promos(
        decisions.on_topic(routed, config.TOPIC_DROP), keep=[F.col("day").cast("string").alias("day")]
    )
    return proposed


@query
def decision_chain(spark, folder):
    """Outcome counts of the whole chain."""
    decided, promo = _decisions(spark, folder)
    outcomes = decided.groupBy(
        F.concat(F.lit("procurement_"), "procurement_status").alias("step"),
        F.concat(F.lit("finance_"), "finance_status").alias("result"),
    ).agg(F.count("*").alias("n"))
    proposed = promo.groupBy(
        F.lit("promo_proposed").alias("step"),
        F.col("proposed_discount_pct").cast("int").cast("string").alias("result"),
    ).agg(F.count("*").alias("n"))
    return outcomes.unionByName(proposed)


@query
def supplier_lookup(spark, folder):
    supplier = retail.supplier_dimension(spark, folder)
    cost = retail.cost_dimension(spark, folder)
    return supplier.join(cost, "item_id")


@query
def dimension_violations(spark, folder):
    """Checks of both dimension tables; valid tables give zero."""
    wrong = inventory.supplier_violations(retail.supplier_dimension(spark, folder)).unionByName(
        inventory.cost_violations(retail.cost_dimension(spark, folder))
    )
    return wrong.agg(F.count("*").alias("n_invalid"))


# Topics and actions ---------------------------------------------------------------------------


@query
def pending(spark, folder):
    queue = _queue(spark, folder)
    return topics.pending(queue, _consumed(queue)).select("id", "topic", "card_id")


@query
def poll_bounded(spark, folder):
    queue = _queue(spark, folder)
    taken = topics.poll(queue, _consumed(queue), config.TOPIC_STOCKOUT)
    parsed = topics.read_payload(taken, cards.CARD_SCHEMA)
    return parsed.select("message_id", "item_id", "store_id", "p90_forecast", "on_hand_inventory")


@query
def queue_depth(spark, folder):
    queue = _queue(spark, folder)
    return topics.backlog(queue, _consumed(queue))


@query
def marked_queue(spark, folder):
    """What waits in the stockout topic of a store after polls, compactions, a repeated mark and a
    second publication under old times."""
    queue = _queue(spark, folder)
    store = topics.TopicStore(spark, scratch_path(spark, "topics"))
    now = F.lit("2024-01-01").cast("timestamp")
    early = F.substring("id", 1, 1) < "8"
    store.publish(queue.where(early))
    taken = store.poll(config.TOPIC_STOCKOUT, now)
    for _ in range(2):
        store.mark(taken, now, config.TOPIC_STOCKOUT)
    store.compact(config.TOPIC_STOCKOUT)
    store.publish(queue.where(~early))
    store.poll(config.TOPIC_STOCKOUT, now, 20)
    store.compact(config.TOPIC_STOCKOUT)
    store.poll(config.TOPIC_STOCKOUT, now, 20)
    return store.pending(config.TOPIC_STOCKOUT).select("id", "topic", "card_id")


@query
def recent_actions(spark, folder):
    rows = reports.recent_actions(_action_log(spark, folder))
    return rows.withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss"))


@query
def action_fields(spark, folder):
    """The rationale of every recommended reorder, lifted out of the JSON details."""
    log = _action_log(spark, folder)
    return reports.rationale_of(log, F.col("card_id"))


# Retrieval --------------------------------------------------------------------------------------


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector")
    )


@query
def cosine_topk(spark, folder):
    """Nearest five other vectors of every vector."""
    points = _vectors(spark, folder)
    asked = points.withColumnRenamed("id", "query_id")
    return retrieval.cosine_top_k(asked, points, drop_same=True)


@query
def cosine_topk_lsh(spark, folder):
    points = _vectors(spark, folder)
    asked = points.withColumnRenamed("id", "query_id")
    return retrieval.cosine_top_k_lsh(asked, points, drop_same=True)


def _stored_vectors(spark: SparkSession, folder: str, replaced: int = 0) -> cells.CellIndex:
    """The vectors as a stored collection, with their label as payload."""
    path = scratch_path(spark, "points")
    points = _vectors(spark, folder).join(
        read_table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "label"), "id"
    )
    for _ in range(replaced):
        cells.store_points(points.where("id % 2 = 0"), path, payload=["label"])
    cells.store_points(points, path, payload=["label"])
    return cells.open_points(spark, path)


@query
def cosine_topk_cells(spark, folder):
    """Nearest five other vectors by cells, with the second round that makes it exact."""
    asked = _vectors(spark, folder).withColumnRenamed("id", "query_id")
    hits = cells.search_cells(asked, _stored_vectors(spark, folder), drop_same=True, exact=True)
    return hits.drop("cell")


@query
def stored_search(spark, folder):
    """Hits in the newest version of a stored collection, with the payload kept there."""
    index = _stored_vectors(spark, folder, replaced=1)
    asked = _vectors(spark, folder).withColumnRenamed("id", "query_id").where("query_id % 10 = 0")
    hits = cells.search_cells(asked, index, drop_same=True, exact=True)
    return cells.with_payload(hits, index, ["label"]).drop("cell")


@query
def cells_recall(spark, folder):
    """Search of as many cells as a sample asks for, against the exact one: per question its hits,
    scores that differ from the cosine of the pair, and whether nine in ten true hits are found."""
    index = _stored_vectors(spark, folder)
    points = _vectors(spark, folder)
    asked = points.withColumnRenamed("id", "query_id")
    probes = cells.choose_probes(asked, index, drop_same=True)
    found = stage(cells.search_cells(asked, index, probes=probes, drop_same=True), "found")
    true = retrieval.cosine_top_k(asked, points, drop_same=True).select("query_id", "id")
    shared = found.join(true, ["query_id", "id"]).agg(F.count("*").alias("shared"))
    all_true = true.agg(F.count("*").alias("true"))
    recall = shared.select(F.col("shared")).scalar() / all_true.select(F.col("true")).scalar()
    pairs = found.join(asked.withColumnRenamed("vector", "_q"), "query_id").join(
        points.withColumnRenamed("vector", "_p"), "id"
    )
    off = F.abs(F.col("score") - retrieval.cosine(F.col("_q"), F.col("_p"))) > 1e-5
    return pairs.groupBy("query_id").agg(
        F.least(F.count("*"), F.lit(5)).alias("n_hits"),
        F.count_if(off).alias("n_wrong"),
        F.first(recall >= 0.9).alias("recall_reached"),
    )


@query
def context_assembly(spark, folder):
    """Context per vector from its nearest neighbours' labels; unlike hits give none."""
    rows = read_table(spark, folder, "embeddings")
    points = _vectors(spark, folder)
    hits = retrieval.cosine_top_k(points.withColumnRenamed("id", "query_id"), points, drop_same=True)
    text = F.concat(F.lit("vector "), F.col("vec_id"), F.lit(" label "), F.col("label"))
    known = rows.select(F.col("vec_id").alias("id"), text.alias("summary"))
    asked = rows.select(
        F.col("vec_id").alias("query_id"),
        F.concat(F.lit("What is like vector "), "vec_id", F.lit("?")).alias("question"),
    )
    close = hits.where(F.col("score") >= 0.3)
    return retrieval.assemble_context(asked, close, known).select("query_id", "context", "prompt")


@query
def text_vectors(spark, folder):
    """Unit vectors of all documents: their number of non-zero terms and their length."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    model = retrieval.fit_embedder(docs)
    vector = F.col("vector")
    squared = F.aggregate(
        vector, F.lit(0.0), lambda total, v: total + v.cast("double") * v.cast("double")
    )
    return retrieval.embed(model, docs).select(
        "doc_id",
        F.size(F.filter(vector, lambda v: v != 0)).alias("n_terms"),
        F.round(F.sqrt(squared), 4).alias("length"),
    )


@query
def card_retrieval(spark, folder):
    """Cards found for the question behind each recommended reorder."""
    stored = stage(_cards(spark, folder), "cards")
    at_risk = decisions.on_topic(decisions.route_cards(stored), config.TOPIC_STOCKOUT)
    reorders = decisions.positive_reorders(decisions.propose_reorders(at_risk))
    return chain.reorder_rationales(stored, reorders)


# Learners ------------------------------------------------------------------------------------------


def _stored_features(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return split.time_split(stage(_coarse_features(spark, folder), "features"))


@query
def gbt_forecast(spark, folder):
    train, validation = _stored_features(spark, folder)
    model = forecast.fit_point_forecast(train, rounds=10, depth=5, step=0.2)
    return _text_dates(
        model.predict(validation).select(*config.SERIES_DAY, "sales", "forecast", "residual")
    )


@query
def feature_importance(spark, folder):
    train, _ = _stored_features(spark, folder)
    return forecast.fit_point_forecast(train, rounds=5, depth=5, step=0.3).importances()


@query
def quantile_forecast(spark, folder):
    train, validation = _stored_features(spark, folder)
    model = forecast.fit_quantile_forecast(train, rounds=8, depth=4, step=0.3)
    return _text_dates(model.predict(validation).select(*config.SERIES_DAY, "sales", "p90_forecast"))


@query
def reloaded_models(spark, folder):
    """The three models, saved and loaded again: rows scored per series, scores that the reloaded
    model gives otherwise, and scores out of their range."""
    train, validation = _stored_features(spark, folder)
    point = forecast.fit_point_forecast(train, validation, rounds=6, depth=4, step=0.3)
    upper = forecast.fit_quantile_forecast(train, validation, rounds=6, depth=4, step=0.5, patience=2)
    residuals = stage(point.predict(validation).select(*config.SERIES_DAY, "residual"), "residuals")
    scaled = stage(anomaly.anomaly_features(residuals), "scaled")
    forest = isolation.fit_forest(scaled, trees=50)
    base = scratch_path(spark, "models")
    reports_of = []
    for name, model, apply, out, low in (
        ("point", point, lambda m: m.predict(validation), "forecast", 0.0),
        ("quantile", upper, lambda m: m.predict(validation), "p90_forecast", 0.0),
        ("forest", forest, lambda m: m.transform(scaled), "anomaly_score", -1.0),
    ):
        bundles.save_model(spark, model, f"{base}/{name}")
        again = apply(bundles.load_model(spark, f"{base}/{name}")).select(*config.SERIES_DAY, F.col(out).alias("again"))
        both = apply(model).select(*config.SERIES_DAY, out).join(again, [*config.SERIES_DAY])
        differs = ~(F.abs(F.col(out) - F.col("again")) <= 1e-9)
        reports_of.append(both.groupBy(F.lit(name).alias("model"), *config.SERIES).agg(
            F.count("*").alias("n_rows"),
            F.count_if(F.coalesce(differs, F.lit(True))).alias("n_differ"),
            F.count_if(F.coalesce(F.col(out) < low, F.lit(True))).alias("n_out_of_range"),
        ))
    return reports_of[0].unionByName(reports_of[1]).unionByName(reports_of[2])


@query
def isolation_forest(spark, folder):
    scaled = _scored(spark, folder).select(*config.SERIES_DAY, *anomaly.ANOMALY_FEATURES)
    rows = stage(scaled, "residuals")
    model = isolation.fit_forest(rows)
    return _text_dates(
        model.transform(rows).select(*config.SERIES_DAY, "residual", "anomaly_flag", "anomaly_score")
    )


# Replay, streams, admission ---------------------------------------------------------------------------


def _replayed(spark: SparkSession, folder: str) -> DataFrame:
    return replay.batch_cards(_scored(spark, folder), batch_days=2)


@query
def replay_cards(spark, folder):
    """Cards of every two-day batch, each batch seen alone."""
    return _replayed(spark, folder).select(
        "batch", *config.SERIES_DAY, "days_flagged", "stockout_risk_flag", "p90_forecast",
        "on_hand_inventory",
    )


@query
def replay_reorders(spark, folder):
    """Cards, published risks and reorders per batch."""
    return replay.batch_report(_replayed(spark, folder))


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts")
    )


def _admitted(spark: SparkSession, folder: str) -> DataFrame:
    decided = admission.rate_admission(_events(spark, folder), "user_id", "ts", "event_id")
    return decided.where("admitted").select("event_id", "user_id", "ts")


@query
def usage_window(spark, folder):
    """Admitted events per user in the 60 seconds and 24 hours up to each of them."""
    rows = admission.usage_counts(
        _admitted(spark, folder), "user_id", "ts", "event_id", admission.USAGE_WINDOWS
    )
    return rows.drop("ts")


@query
def usage_now(spark, folder):
    """Admitted usage per user at the moment of the newest admitted event."""
    log = _admitted(spark, folder)
    now = log.select(F.max("ts")).scalar()
    return admission.usage_snapshot(log, "user_id", "ts", now)


@query
def rate_limit(spark, folder):
    """Admission of every event per user."""
    rows = admission.rate_admission(_events(spark, folder), "user_id", "ts", "event_id")
    return rows.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query
def rate_limit_global(spark, folder):
    """All events under one global limit, cut into chunks in time."""
    rows = _events(spark, folder).withColumn("scope", F.lit("all"))
    decided = admission.rate_admission(rows, "scope", "ts", "event_id", chunk_rows=5000)
    return decided.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def _replay_stream(spark: SparkSession, folder: str) -> str:
    """The two-day batches as a stream over the scored days, and the path of its tables."""
    rows = _scored(spark, folder)
    base = scratch_path(spark, "replay")
    # Dealt by item, so that every file reaches over the whole time and most days arrive late.
    rows.select(*score.SCORED_COLUMNS).repartition(8, "item_id").write.parquet(f"{base}/days")
    first = rows.agg(F.min("date")).first()[0]
    schema = spark.read.parquet(f"{base}/days").schema
    stream = sinks.read_files(spark, f"{base}/days", schema, files_per_trigger=2)
    card_streams.replay_stream(
        stream, first, f"{base}/replayed", f"{base}/checkpoint", batch_days=2
    ).awaitTermination()
    return f"{base}/replayed"


@query
def replay_stream(spark, folder):
    """Cards of every two-day batch, replayed as a stream."""
    built = card_streams.replayed(spark, _replay_stream(spark, folder))["cards"]
    return built.select(
        "batch", *config.SERIES_DAY, "days_flagged", "stockout_risk_flag", "p90_forecast",
        "on_hand_inventory",
    )


@query
def replay_stream_reorders(spark, folder):
    """Cards, published risks and reorders per batch, as the stream decides them."""
    return card_streams.replay_report(spark, _replay_stream(spark, folder))


@query
def cumulative_cards(spark, folder):
    """Cards from the state a stream over the scored days keeps."""
    base = scratch_path(spark, "cumulative")
    rows = _scored(spark, folder).select(*score.SCORED_COLUMNS)
    rows.repartitionByRange(8, "date").write.parquet(f"{base}/days")
    stream = sinks.read_files(
        spark, f"{base}/days", spark.read.parquet(f"{base}/days").schema, files_per_trigger=3
    )
    card_streams.cumulative_state(
        stream, f"{base}/state", f"{base}/checkpoint", compact_every=2
    ).awaitTermination()
    built = card_streams.cumulative_cards(spark, f"{base}/state")
    return _rounded(built, "anomaly_score", "normalized_residual")


@query
def decision_stream(spark, folder):
    """The decision chain as one stream per topic; the finance decisions it logs."""
    base = scratch_path(spark, "decisions")
    _cards(spark, folder).write.parquet(f"{base}/cards")
    streams = TopicStreams(spark, base)
    streams.run_available(
        card_stream(spark, f"{base}/cards"),
        retail.supplier_dimension(spark, folder),
        retail.cost_dimension(spark, folder),
    )
    details = F.from_json("details", chain.DECISION_SCHEMA)
    return streams.actions("finance_agent").select(details.alias("_d")).select("_d.*")


def _decided_stream(spark: SparkSession, folder: str, late: int | None) -> str:
    """Decisions of a stream over all events, and the path they are stored at.

    Without a bound on lateness the files are dealt by id, so that each reaches over the whole
    time and most asks come late. With a bound they are cut in time, and every tenth ask waits
    for the file after its own.
    """
    base = scratch_path(spark, "admission")
    rows = _events(spark, folder)
    if late is None:
        rows.repartition(4, "event_id").write.parquet(f"{base}/events")
    else:
        bounds = rows.agg(F.min("ts"), F.max("ts")).first()
        width = max((bounds[1] - bounds[0]).total_seconds() / 6, 1)
        since = (F.unix_micros("ts") - F.unix_micros(F.lit(bounds[0]))) / 1_000_000
        part = F.floor(since / width) + (F.col("event_id") % 10 == 0).cast("int")
        numbered = rows.withColumn("_file", part.cast("int"))
        for number in range(8):  # one task writes a file, all read
            numbered.where(F.col("_file") == number).drop("_file").repartition(1).write.mode("append").parquet(
                f"{base}/events"
            )
    stream = sinks.read_files(
        spark, f"{base}/events", "event_id long, user_id long, ts timestamp", files_per_trigger=1
    )
    admission_streams.admit_stream(
        stream, "user_id", "ts", "event_id", f"{base}/decided", f"{base}/checkpoint", late=late
    ).awaitTermination()
    return f"{base}/decided"


@query
def usage_stream(spark, folder):
    """Admitted events per user in the trailing windows up to each, as a stream keeps them."""
    path = _decided_stream(spark, folder, None)
    return admission_streams.usage(spark, path, "user_id", "event_id").drop("ts")


@query
def rate_limit_stream(spark, folder):
    """Admission of every event per user, as a stream of several out-of-order batches."""
    path = _decided_stream(spark, folder, None)
    rows = admission_streams.verdicts(spark, path, "user_id", "event_id")
    return rows.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query
def rate_limit_bounded_stream(spark, folder):
    """The same from files in time order with late asks, and state that lets old asks go."""
    span = _events(spark, folder).agg(F.max("ts") - F.min("ts")).first()[0]
    late = int(span.total_seconds() / 3) + 1 if span else 1
    path = _decided_stream(spark, folder, late)
    rows = admission_streams.verdicts(spark, path, "user_id", "event_id")
    return rows.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
