"""Cards to actions: the decision chain over stored topics, and retrieval for its texts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast import config
from shelfcast.operators import cards as card_ops
from shelfcast.operators import decisions, retrieval, topics

REORDER_SCHEMA = (
    "card_id string, item_id string, store_id string, reorder_qty double, "
    "p90_forecast double, on_hand_inventory double"
)
OUTCOME_SCHEMA = (
    f"{REORDER_SCHEMA}, procurement_status string, fulfilled_qty double, "
    "backordered_qty double, lead_time_days int"
)
DECISION_SCHEMA = f"{OUTCOME_SCHEMA}, estimated_order_cost double, finance_status string"
PROMO_SCHEMA = (
    "card_id string, item_id string, store_id string, proposed_discount_pct double, reason string"
)


@dataclass(frozen=True)
class Step:
    """One consumer: what it reads, its rule, what it logs and where it forwards to."""

    agent: str
    topic: str
    schema: str
    rule: Callable[[DataFrame], DataFrame]
    action: Callable[[], Column]
    forward: str | None = None


def steps(supplier: DataFrame, cost: DataFrame) -> list[Step]:
    """Consumers in dependency order."""

    def composed(prefix: str, column: str) -> Callable[[], Column]:
        return lambda: F.concat(F.lit(f"{prefix}_"), F.col(column))

    return [
        Step(
            "inventory_agent",
            config.TOPIC_STOCKOUT,
            card_ops.CARD_SCHEMA,
            lambda rows: decisions.positive_reorders(decisions.propose_reorders(rows)),
            lambda: F.lit("reorder_recommended"),
            config.TOPIC_REORDER,
        ),
        Step(
            "procurement_agent",
            config.TOPIC_REORDER,
            REORDER_SCHEMA,
            lambda rows: decisions.check_capacity(rows, supplier),
            composed("procurement", "procurement_status"),
            config.TOPIC_PROCUREMENT,
        ),
        Step(
            "finance_agent",
            config.TOPIC_PROCUREMENT,
            OUTCOME_SCHEMA,
            lambda rows: decisions.approve_spend(rows, cost),
            composed("finance", "finance_status"),
        ),
        Step(
            "marketing_agent",
            config.TOPIC_DROP,
            card_ops.CARD_SCHEMA,
            decisions.propose_promos,
            lambda: F.lit("promo_proposed"),
        ),
    ]


def publish_cards(cards: DataFrame, store: topics.TopicStore, now: Column) -> None:
    """Route the cards to their topics and log how many went to each."""
    routed = decisions.route_cards(cards)
    store.publish(
        topics.messages(
            routed, F.col("topic"), now, "id", [c for c in cards.columns if c != "topic"]
        )
    )
    counts = decisions.routing_counts(routed)
    store.log(
        topics.actions(counts, "demand_planning_agent", "published_insights", now, F.lit("batch"))
    )


def run_step(
    step: Step,
    store: topics.TopicStore,
    now: Column,
    limit: int | None = None,
    rationales: DataFrame | None = None,
) -> None:
    """Read a topic, apply the rule, log, forward, and mark the messages consumed.

    With a limit the oldest messages are taken and marked first, as a bounded poll; without
    one everything pending is worked on and marked after the writes.
    """
    if limit is None:
        batch = store.pending(step.topic)
    else:
        batch = store.poll(step.topic, now, limit)
    result = step.rule(topics.read_payload(batch, step.schema).drop("message_id"))
    logged = result
    if step.agent == "inventory_agent":
        logged = decisions.with_rationale(result, rationales).select(
            "card_id", "item_id", "store_id", "reorder_qty", "rationale"
        )
    details = [c for c in logged.columns if step.agent != "inventory_agent" or c != "card_id"]
    store.log(topics.actions(logged, step.agent, step.action(), now, details=details))
    if step.forward:
        store.publish(topics.messages(result, step.forward, now))
    if limit is None:
        store.mark(batch, now, step.topic)


def run_chain(
    cards: DataFrame,
    supplier: DataFrame,
    cost: DataFrame,
    store: topics.TopicStore,
    now: Column,
    limit: int | None = None,
    rationales: DataFrame | None = None,
) -> None:
    publish_cards(cards, store, now)
    for step in steps(supplier, cost):
        run_step(step, store, now, limit, rationales)


def card_contexts(cards: DataFrame, questions: DataFrame, k: int = config.TOP_K) -> DataFrame:
    """Embed cards and questions with one model, search, and assemble the contexts."""
    model = retrieval.fit_embedder(cards.select(F.col("summary").alias("text")))
    points = retrieval.embed(model, cards.withColumn("text", F.col("summary")))
    asked = retrieval.embed(model, questions.withColumn("text", F.col("question")))
    hits = retrieval.cosine_top_k(
        asked.select("query_id", "vector"), points.select("id", "vector"), k
    )
    return retrieval.assemble_context(questions, hits, cards)


def reorder_rationales(cards: DataFrame, reorders: DataFrame, k: int = 2) -> DataFrame:
    """Retrieved context per recommended reorder."""
    contexts = card_contexts(cards, decisions.rationale_questions(reorders), k)
    return contexts.select(F.col("query_id").alias("card_id"), F.col("context").alias("rationale"))
