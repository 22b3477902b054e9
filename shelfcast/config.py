"""Fixed values of the product: windows, thresholds, topic names and defaults."""

from __future__ import annotations

# Columns ------------------------------------------------------------------
SERIES = ("item_id", "store_id")
HIERARCHY = ("item_id", "dept_id", "cat_id", "store_id", "state_id")
SERIES_DAY = ("item_id", "store_id", "date")
DAY_PREFIX = "d_"

# Features (fixed values) -----------------------------------------------------
LAG_DAYS = (7, 14, 28)
ROLL_WINDOWS = (7, 28)
PRICE_LAG_DAYS = 7
WEEKEND_WDAYS = (1, 7)
SNAP_COLUMNS = ("snap_ca", "snap_tx", "snap_wi")

# Split, risk and anomaly (fixed values) ---------------------------------------
VALIDATION_DAYS = 28
RISK_QUANTILE = 0.9
VOLATILITY_ROWS = 14
VOLATILITY_MIN_ROWS = 5
CONTAMINATION = 0.03
FOREST_TREES = 200
FOREST_SAMPLE = 256
MAPE_SHIFT = 1e-6
HISTOGRAM_BINS = 30

# Decision rules (fixed values) -------------------------------------------------
REORDER_LEAD_TIME_DAYS = 7
REORDER_SAFETY_FACTOR = 1.2
DEFAULT_ORDER_CAPACITY = 500.0
DEFAULT_LEAD_TIME_DAYS = 7
DEFAULT_COST_RATIO = 0.6
DEFAULT_P90 = 1.0
UNIT_PRICE_SCALE = 2.0
AUTO_APPROVE_LIMIT = 5000.0
DISCOUNT_STEPS = ((3.0, 20.0), (2.0, 15.0))
DISCOUNT_FLOOR = 10.0

# Topics (fixed values) -----------------------------------------------------------
TOPIC_STOCKOUT = "stockout_risk"
TOPIC_DROP = "anomaly_drop"
TOPIC_REORDER = "reorder_request"
TOPIC_PROCUREMENT = "procurement_confirmed"
POLL_LIMIT = 50
RECENT_ACTIONS = 20

# Retrieval and admission (fixed values) ------------------------------------------
TOP_K = 5
VECTOR_SIZE = 384
BURST_MAX = 5
BURST_SECONDS = 60
DAILY_MAX = 100
DAILY_SECONDS = 24 * 60 * 60

# Model inputs (fixed values) -------------------------------------------------------
FEATURE_COLUMNS = (
    *HIERARCHY,
    "sell_price",
    "price_change_7d",
    "wday",
    "month",
    "year",
    "is_weekend",
    "has_event",
    "snap_active",
    *(f"lag_{n}" for n in LAG_DAYS),
    *(f"roll_{stat}_{n}" for n in ROLL_WINDOWS for stat in ("mean", "std")),
)
TARGET = "sales"
