"""The catalogue's queries as plain SQL over the test tables, written independently."""

from __future__ import annotations


def _keys(grain: str) -> str:
    if grain == "fine":
        return """p_brand AS item_id,
            'DEPT_' || (CAST(substr(p_brand, 7) AS INT) % 7) AS dept_id,
            'CAT_' || ((CAST(substr(p_brand, 7) AS INT) % 7) % 3) AS cat_id,
            n_name AS store_id, r_name AS state_id"""
    return """p_type AS item_id, 'DEPT_0' AS dept_id, 'CAT_0' AS cat_id,
            r_name AS store_id, r_name AS state_id"""


def _dec(expr: str, places: int) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(18,6)), {places}) AS DOUBLE)"


def _daily(grain: str) -> str:
    return f"""daily AS (
        SELECT {_keys(grain)}, CAST(l_shipdate AS DATE) AS date,
            CAST(sum(l_quantity) AS BIGINT) AS sales,
            sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue
        FROM lineitem JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        GROUP BY ALL),
    span AS (SELECT min(date) AS lo, max(date) AS hi FROM daily)"""


def _panel(grain: str, days: str = "") -> str:
    return f"""{_daily(grain)},
    calendar AS (
        SELECT date, idx, CAST(idx // 7 + 1 AS BIGINT) AS wm_yr_wk, dayname(date) AS weekday,
            CAST(dayofweek(date) + 1 AS BIGINT) AS wday, CAST(month(date) AS BIGINT) AS month,
            CAST(year(date) AS BIGINT) AS year, 'd_' || (idx + 1) AS d,
            CASE WHEN month(date) = 12 AND day(date) = 25 THEN 'EventA'
                 WHEN month(date) = 7 AND day(date) = 4 THEN 'EventB' END AS event_name_1,
            CAST(day(date) <= 10 AS BIGINT) AS snap_ca,
            CAST(day(date) <= 15 AND day(date) % 2 = 1 AS BIGINT) AS snap_tx,
            CAST(day(date) IN (2,3,5,6,8,9,11,12,14,15) AS BIGINT) AS snap_wi
        FROM (SELECT lo + CAST(i AS INT) AS date, i AS idx
              FROM span, generate_series(0, (SELECT hi - lo FROM span)) AS g(i)) t),
    series AS (SELECT DISTINCT item_id, dept_id, cat_id, store_id, state_id FROM daily),
    prices AS (
        SELECT item_id, store_id, wm_yr_wk,
            CAST(sum(revenue) AS DOUBLE) / CAST(sum(sales) AS DOUBLE) AS sell_price
        FROM daily JOIN calendar USING (date) GROUP BY ALL),
    fact AS (
        SELECT s.*, c.date, c.d, c.wm_yr_wk, c.weekday, c.wday, c.month, c.year, c.event_name_1,
            CASE WHEN c.event_name_1 IS NOT NULL THEN 'Cultural' END AS event_type_1,
            c.snap_ca, c.snap_tx, c.snap_wi, coalesce(x.sales, 0) AS sales, p.sell_price
        FROM series s CROSS JOIN calendar c
        LEFT JOIN daily x ON x.item_id = s.item_id AND x.store_id = s.store_id AND x.date = c.date
        LEFT JOIN prices p ON p.item_id = s.item_id AND p.store_id = s.store_id
            AND p.wm_yr_wk = c.wm_yr_wk
        {days})"""


def _features(grain: str, days: str = "") -> str:
    lags = ", ".join(f"lag(sales, {n}) OVER w AS lag_{n}" for n in (7, 14, 28))
    rolls = ", ".join(
        f"avg(sales) OVER w{n} AS roll_mean_{n}, stddev_samp(sales) OVER w{n} AS roll_std_{n}"
        for n in (7, 28)
    )
    frames = ", ".join(
        f"w{n} AS (PARTITION BY item_id, store_id ORDER BY date "
        f"ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        for n in (7, 28)
    )
    return f"""{_panel(grain, days)},
    feats AS (
        SELECT * FROM (
            SELECT item_id, dept_id, cat_id, store_id, state_id, date, sales, sell_price,
                sell_price - lag(sell_price, 7) OVER w AS price_change_7d, wday, month, year,
                CASE WHEN wday IN (1, 7) THEN 1 ELSE 0 END AS is_weekend,
                CASE WHEN event_name_1 IS NOT NULL THEN 1 ELSE 0 END AS has_event,
                snap_ca + snap_tx + snap_wi AS snap_active, {lags}, {rolls}
            FROM fact
            WINDOW w AS (PARTITION BY item_id, store_id ORDER BY date), {frames}) t
        WHERE lag_28 IS NOT NULL)"""


def _uniform(seed: int, tag: str, key: str) -> str:
    text = f"concat_ws('|', {key}, '{seed}', '{tag}')"
    return f"(CAST(CAST(concat('0x', substr(md5({text}), 1, 8)) AS BIGINT) AS DOUBLE) / 4294967296.0)"


_DAY_KEY = "item_id, store_id, CAST(date AS VARCHAR)"

_SCORED = f"""{_features("fine", "WHERE c.date >= (SELECT hi FROM span) - 55")},
    predicted AS (
        SELECT *, {_dec("roll_mean_7", 6)} AS forecast,
            {_dec("roll_mean_28 + 1.2816::DOUBLE * roll_std_28", 6)} AS p90_forecast,
            {_dec("sales - roll_mean_7", 6)} AS residual,
            {_dec(f'''roll_mean_28 * (5.0 + 7.0 * {_uniform(42, "cover", _DAY_KEY)})
                * greatest(0.0, 1.0 + 0.15 * sqrt(-2.0 * ln(1.0 - {_uniform(42, "noise1", _DAY_KEY)}))
                * cos(2 * pi() * {_uniform(42, "noise2", _DAY_KEY)}))''', 4)} AS on_hand_inventory
        FROM feats WHERE date > (SELECT hi FROM span) - 28),
    spread AS (SELECT stddev_samp(residual) AS overall FROM predicted),
    scaled AS (
        SELECT *, coalesce(nullif(own, 0), (SELECT overall FROM spread)) AS resid_roll_std
        FROM (SELECT *, CASE WHEN count(residual) OVER v >= 5
                THEN stddev_samp(residual) OVER v END AS own
              FROM predicted
              WINDOW v AS (PARTITION BY item_id, store_id ORDER BY date
                           ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)) t),
    scored AS (
        SELECT *, sales AS actual_sales, residual / resid_roll_std AS normalized_residual,
            abs(residual) AS abs_residual,
            CASE WHEN p90_forecast > on_hand_inventory THEN 1 ELSE 0 END AS stockout_risk_flag,
            CASE WHEN abs(residual / resid_roll_std) > 2.0 THEN 1 ELSE 0 END AS anomaly_flag,
            -abs(residual / resid_roll_std) AS anomaly_score
        FROM scaled)"""


def _fixed(expr: str) -> str:
    return f"CAST(CAST(round(CAST({expr} AS DECIMAL(18,6)), 1) AS DECIMAL(18,1)) AS VARCHAR)"


_CARDS = f"""{_SCORED},
    active AS (SELECT * FROM scored WHERE stockout_risk_flag = 1 OR anomaly_flag = 1),
    risk_days AS (
        SELECT item_id, store_id, count(*) AS days_flagged, min(date) AS first_flagged_date
        FROM active WHERE stockout_risk_flag = 1 GROUP BY ALL),
    latest AS (
        SELECT a.*, coalesce(r.days_flagged, 0) AS days_flagged, r.first_flagged_date
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id, store_id ORDER BY date DESC) AS rn
              FROM active) a
        LEFT JOIN risk_days r ON a.item_id = r.item_id AND a.store_id = r.store_id
        WHERE a.rn = 1),
    cards AS (
        SELECT item_id || '_' || store_id AS id, item_id, store_id, CAST(date AS VARCHAR) AS date,
            forecast, CAST(actual_sales AS DOUBLE) AS actual_sales, p90_forecast, on_hand_inventory,
            stockout_risk_flag, CAST(days_flagged AS INT) AS days_flagged,
            CAST(first_flagged_date AS VARCHAR) AS first_flagged_date, anomaly_flag, anomaly_score,
            normalized_residual,
            'Item ' || item_id || ' at store ' || store_id || ', latest as of '
            || CAST(date AS VARCHAR) || ': forecasted demand ' || {_fixed("forecast")}
            || ', actual ' || {_fixed("actual_sales")} || '.'
            || CASE WHEN stockout_risk_flag = 1 THEN
                ' Stockout risk: P90 demand (' || {_fixed("p90_forecast")}
                || ') exceeds on-hand inventory (' || {_fixed("on_hand_inventory")} || ') — '
                || CASE WHEN days_flagged > 1 THEN 'flagged for ' || days_flagged
                    || ' of the last 28 days (since ' || CAST(first_flagged_date AS VARCHAR) || ')'
                    ELSE 'flagged today' END || '.' ELSE '' END
            || CASE WHEN anomaly_flag = 1 THEN
                ' Anomalous demand detected — actual sales were unusually '
                || CASE WHEN normalized_residual > 0 THEN 'higher' ELSE 'lower' END
                || ' than expected.' ELSE '' END AS summary
        FROM latest)"""

_ITEM_U = {tag: _uniform(7, tag, "item_id") for tag in ("constrained", "capacity", "lead", "cost")}

_DIMENSIONS = f"""supplier_dim AS (
        SELECT item_id,
            {_dec(f'''CASE WHEN {_ITEM_U["constrained"]} < 0.10
                THEN 20.0 + 40.0 * {_ITEM_U["capacity"]}
                ELSE 200.0 + 800.0 * {_ITEM_U["capacity"]} END''', 1)} AS max_order_capacity,
            CAST(floor(11 * {_ITEM_U["lead"]}) + 3 AS INT) AS lead_time_days,
            {_ITEM_U["constrained"]} < 0.10 AS constrained,
            {_dec(f'0.45::DOUBLE + 0.30::DOUBLE * {_ITEM_U["cost"]}', 3)} AS cost_ratio
        FROM (SELECT DISTINCT p_brand AS item_id FROM part) t)"""

_ROUTED = f"""{_CARDS},
    routed AS (
        SELECT *, 'stockout_risk' AS topic FROM cards WHERE stockout_risk_flag = 1
        UNION ALL
        SELECT *, 'anomaly_drop' AS topic FROM cards
        WHERE anomaly_flag = 1 AND normalized_residual < 0)"""

_CHAIN = f"""{_ROUTED}, {_DIMENSIONS},
    reorders AS (
        SELECT id AS card_id, item_id, store_id, date, summary,
            {_dec("greatest(0.0, p90_forecast * 7 * 1.2::DOUBLE - on_hand_inventory)", 1)} AS reorder_qty,
            p90_forecast, on_hand_inventory
        FROM routed WHERE topic = 'stockout_risk'),
    outcomes AS (
        SELECT r.card_id, r.item_id, r.store_id, r.reorder_qty, r.p90_forecast, r.on_hand_inventory,
            CASE WHEN reorder_qty <= cap THEN 'confirmed' ELSE 'delayed' END AS procurement_status,
            CASE WHEN reorder_qty <= cap THEN reorder_qty ELSE {_dec("cap", 1)} END AS fulfilled_qty,
            CASE WHEN reorder_qty <= cap THEN 0.0::DOUBLE ELSE {_dec("reorder_qty - cap", 1)} END
                AS backordered_qty, lead_time_days, cost_ratio
        FROM (SELECT r.*, coalesce(s.max_order_capacity, 500.0) AS cap,
                coalesce(s.lead_time_days, 7) AS lead_time_days,
                coalesce(s.cost_ratio, 0.6) AS cost_ratio
              FROM reorders r LEFT JOIN supplier_dim s ON r.item_id = s.item_id
              WHERE r.reorder_qty > 0) r),
    decided AS (
        SELECT * EXCLUDE (cost_ratio, est), {_dec("est", 2)} AS estimated_order_cost,
            CASE WHEN est <= 5000 THEN 'approved' ELSE 'flagged_for_review' END AS finance_status
        FROM (SELECT *, p90_forecast * 2 * cost_ratio * fulfilled_qty AS est FROM outcomes) t),
    promos AS (
        SELECT id AS card_id, item_id, store_id, date,
            CASE WHEN abs(normalized_residual) >= 3 THEN 20.0::DOUBLE
                 WHEN abs(normalized_residual) >= 2 THEN 15.0::DOUBLE ELSE 10.0::DOUBLE END
                AS proposed_discount_pct,
            'Sales ran ' || {_fixed("abs(normalized_residual)")}
            || ' deviations under the forecast; a price cut may bring them back.' AS reason
        FROM routed WHERE topic = 'anomaly_drop')"""

_MICROS = "CAST(epoch_us(CAST(date AS TIMESTAMP)) AS VARCHAR)"

_QUEUE = f"""{_ROUTED},
    queue AS (
        SELECT md5(concat_ws('|', topic, id, {_MICROS})) AS id, topic, id AS card_id, item_id,
            store_id, p90_forecast, on_hand_inventory, date AS created_at
        FROM routed),
    consumed AS (
        SELECT id FROM queue WHERE topic = 'stockout_risk' ORDER BY created_at, id LIMIT 50),
    waiting AS (SELECT * FROM queue WHERE id NOT IN (SELECT id FROM consumed))"""

_ACTIONS = f"""{_CHAIN},
    actions AS (
        SELECT md5(concat_ws('|', 'inventory_agent', 'reorder_recommended', card_id, {_MICROS})) AS id,
            'inventory_agent' AS agent, card_id, 'reorder_recommended' AS action, date,
            item_id, store_id, reorder_qty, summary AS rationale
        FROM reorders WHERE reorder_qty > 0
        UNION ALL
        SELECT md5(concat_ws('|', 'marketing_agent', 'promo_proposed', card_id, {_MICROS})),
            'marketing_agent', card_id, 'promo_proposed', date, NULL, NULL, NULL, NULL
        FROM promos)"""

_USAGE = """asks AS (SELECT event_id, user_id, epoch_us(ts) AS us FROM events)"""

_HITS = """pairs AS (
        SELECT a.vec_id AS query_id, b.vec_id AS id,
            round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6)
                AS score
        FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
    hits AS (
        SELECT * FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INT)
                AS rank FROM pairs) t
        WHERE rank <= 5)"""


def _by_day(columns: str) -> str:
    return f"item_id, store_id, CAST(date AS VARCHAR) AS date, {columns}"


_REPLAY = f"""{_SCORED},
    active AS (SELECT * FROM scored WHERE stockout_risk_flag = 1 OR anomaly_flag = 1),
    batched AS (
        SELECT *, CAST((dense_rank() OVER (ORDER BY date) - 1) // 2 AS INT) AS batch
        FROM scored),
    flagged AS (SELECT * FROM batched WHERE stockout_risk_flag = 1 OR anomaly_flag = 1),
    replayed AS (
        SELECT batch, item_id, store_id,
            CAST(count(*) FILTER (WHERE stockout_risk_flag = 1) AS INT) AS days_flagged,
            CAST(max(date) AS VARCHAR) AS date,
            arg_max(p90_forecast, date) AS p90_forecast,
            arg_max(on_hand_inventory, date) AS on_hand_inventory,
            arg_max(stockout_risk_flag, date) AS stockout_risk_flag
        FROM flagged GROUP BY ALL)"""

ORACLES: dict[str, str] = {
    "features": f"""WITH {_features("coarse")}
        SELECT item_id, dept_id, cat_id, store_id, state_id, CAST(date AS VARCHAR) AS date, sales,
            sell_price, price_change_7d, wday, month, year, is_weekend, has_event, snap_active,
            lag_7, lag_14, lag_28, {_dec("roll_mean_7", 6)} AS roll_mean_7,
            {_dec("roll_std_7", 6)} AS roll_std_7, {_dec("roll_mean_28", 6)} AS roll_mean_28,
            {_dec("roll_std_28", 6)} AS roll_std_28 FROM feats""",
    "feature_profile": f"""WITH {_features("fine")}
        SELECT item_id, dept_id, cat_id, store_id, state_id, count(*) AS n_rows,
            {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("sales", "is_weekend", "has_event",
                "snap_active", "lag_7", "lag_14", "lag_28"))},
            {", ".join(f"CAST(sum(round(CAST(roll_mean_{n} AS DECIMAL(18,6)), 6)) AS DOUBLE) AS roll_mean_{n}"
                for n in (7, 28))},
            {", ".join(f"{_dec(f'sum(roll_std_{n})', 3)} AS roll_std_{n}" for n in (7, 28))},
            count(sell_price) AS n_priced, count(price_change_7d) AS n_price_changes,
            {_dec("sum(price_change_7d)", 3)} AS price_change
        FROM feats GROUP BY ALL""",
    "unpivot_long": f"""WITH {_panel("coarse")}
        SELECT item_id, dept_id, cat_id, store_id, state_id, strftime(date, '%Y-%m') AS month,
            'd_' || day(date) AS d, CAST(sales AS BIGINT) AS sales
        FROM fact""",
    "melt_keep_nulls": f"""WITH {_panel("coarse")},
        months AS (
            SELECT item_id, store_id, date_trunc('month', date) AS m, count(*) AS days,
                sum(sales) AS total
            FROM fact GROUP BY ALL)
        SELECT item_id, store_id, 31 * count(*) AS n_rows,
            CAST(sum(31 - days) AS BIGINT) AS n_null, CAST(sum(total) AS BIGINT) AS total
        FROM months GROUP BY ALL""",
    "dense_panel": f"""WITH {_panel("fine")}
        SELECT item_id, store_id, count(*) AS n_days, CAST(min(date) AS VARCHAR) AS first_day,
            CAST(max(date) AS VARCHAR) AS last_day, CAST(sum(sales) AS BIGINT) AS total,
            count(*) FILTER (WHERE sales = 0) AS n_zero
        FROM fact GROUP BY ALL""",
    "fact_panel": f"""WITH {_panel("coarse")}
        SELECT item_id, dept_id, cat_id, store_id, state_id, CAST(date AS VARCHAR) AS date,
            wm_yr_wk, weekday, wday, month, year, event_name_1, event_type_1, snap_ca, snap_tx,
            snap_wi, CAST(sales AS BIGINT) AS sales, sell_price FROM fact""",
    "price_left_join": f"""WITH {_panel("fine")}
        SELECT item_id, store_id, count(*) AS n_days, count(sell_price) AS n_priced,
            {_dec("sum(sell_price)", 3)} AS price_sum FROM fact GROUP BY ALL""",
    "series_count": f"""WITH {_panel("fine")}
        SELECT count(*) AS n_rows, count(DISTINCT (item_id, store_id)) AS n_series FROM fact""",
    "sampled_series": f"""WITH {_daily("fine")},
        chosen AS (SELECT DISTINCT item_id, store_id FROM daily ORDER BY item_id, store_id LIMIT 3)
        SELECT item_id, store_id, CAST(date AS VARCHAR) AS date, sales
        FROM daily JOIN chosen USING (item_id, store_id)""",
    "first_rows": f"""WITH {_daily("fine")}
        SELECT item_id, store_id, CAST(date AS VARCHAR) AS date, sales
        FROM daily ORDER BY item_id, store_id, daily.date LIMIT 10""",
    "shifted_features": f"""WITH {_panel("coarse")}
        SELECT item_id, store_id, CAST(date AS VARCHAR) AS date, lag(sales, 1) OVER w AS lag_1,
            CASE WHEN count(sales) OVER s = 7 THEN {_dec("avg(sales) OVER s", 6)} END AS roll_mean_7,
            CASE WHEN count(sales) OVER s = 7 THEN {_dec("stddev_samp(sales) OVER s", 6)} END
                AS roll_std_7,
            {_dec("avg(sales) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)", 6)} AS leaky_mean_7
        FROM fact
        WINDOW w AS (PARTITION BY item_id, store_id ORDER BY fact.date),
            s AS (PARTITION BY item_id, store_id ORDER BY fact.date
                  ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
    "panel_coverage": f"""WITH {_daily("fine")}
        SELECT count(*) AS n_series, avg(n) AS avg_rows_per_series
        FROM (SELECT item_id, store_id, count(*) AS n FROM daily GROUP BY ALL) t""",
    "time_split_counts": f"""WITH {_features("coarse")},
        cut AS (SELECT max(date) - 28 AS cutoff FROM feats)
        SELECT CASE WHEN date <= cutoff THEN 'train' ELSE 'validation' END AS part,
            count(*) AS n_rows, CAST(min(date) AS VARCHAR) AS first_day,
            CAST(max(date) AS VARCHAR) AS last_day
        FROM feats, cut GROUP BY 1""",
    "reloaded_models": f"""WITH {_features("coarse")},
        cut AS (SELECT max(date) - 28 AS cutoff FROM feats)
        SELECT model, item_id, store_id, count(*) AS n_rows, 0::BIGINT AS n_differ, 0::BIGINT AS n_out_of_range
        FROM feats, cut, (VALUES ('point'), ('quantile'), ('forest')) AS m(model)
        WHERE date > cutoff GROUP BY ALL""",
    "point_metrics": f"""WITH {_SCORED}
        SELECT {_dec("sqrt(avg((actual_sales - forecast) * (actual_sales - forecast)))", 4)} AS rmse,
            {_dec("avg(abs(actual_sales - forecast))", 4)} AS mae,
            {_dec("avg(abs((actual_sales + 1e-6) - (forecast + 1e-6)) / abs(actual_sales + 1e-6))", 4)} AS mape
        FROM scored""",
    "risk_metrics": f"""WITH {_SCORED}
        SELECT {_dec('''avg(greatest(0.9::DOUBLE * (actual_sales - p90_forecast),
                (0.9::DOUBLE - 1) * (actual_sales - p90_forecast)))''', 6)} AS pinball_loss,
            {_dec("avg(CAST(actual_sales <= p90_forecast AS INT))", 6)} AS p90_coverage,
            {_dec("avg(stockout_risk_flag)", 6)} AS flagged_stockout_rate FROM scored""",
    "flag_rates": f"""WITH {_SCORED}
        SELECT avg(stockout_risk_flag) AS stockout_rate, avg(anomaly_flag) AS anomaly_rate
        FROM scored""",
    "calibration": f"""WITH {_daily("fine")},
        levels AS (
            SELECT unnest([0.6::DOUBLE, 0.9::DOUBLE, 0.99::DOUBLE]) AS quantile,
                unnest(quantile_cont(CAST(sales AS DOUBLE), [0.6, 0.9, 0.99])) AS level FROM daily)
        SELECT quantile, level, CAST(count(*) FILTER (WHERE sales <= level) AS DOUBLE) / count(*)
            AS coverage
        FROM daily, levels GROUP BY ALL""",
    "median_demand": f"""WITH {_features("coarse")}
        SELECT median(roll_mean_28) AS median_roll_mean_28, count(*) AS n_rows FROM feats""",
    "histogram": f"""WITH {_daily("fine")},
        edge AS (SELECT CAST(min(sales) AS DOUBLE) AS lo, CAST(max(sales) AS DOUBLE) AS hi FROM daily)
        SELECT bin, count(x.sales) AS n
        FROM generate_series(1, 30) AS g(bin) LEFT JOIN (
            SELECT sales, least(CAST(floor(30 * (sales - lo) / (hi - lo)) AS BIGINT) + 1, 30) AS b
            FROM daily, edge) x ON x.b = bin
        GROUP BY bin""",
    "share_above_mean": f"""WITH {_daily("fine")}
        SELECT avg(CAST(sales > (SELECT avg(sales) FROM daily) AS INT)) AS share_above_mean
        FROM daily""",
    "anomaly_features": f"""WITH {_SCORED}
        SELECT {_by_day("residual")}, {_dec("resid_roll_std", 6)} AS resid_roll_std,
            {_dec("normalized_residual", 6)} AS normalized_residual, abs_residual FROM scored""",
    "labelled_residuals": f"""WITH {_SCORED},
        ends AS (SELECT min((item_id, store_id)) AS a, max((item_id, store_id)) AS b FROM scored)
        SELECT {_by_day("residual")}, CASE WHEN (item_id, store_id) = a THEN 'A' ELSE 'B' END AS series
        FROM scored, ends WHERE (item_id, store_id) IN (a, b)""",
    "inventory_levels": f"""WITH {_SCORED}
        SELECT {_by_day(_dec("roll_mean_28", 6) + " AS roll_mean_28")}, on_hand_inventory
        FROM scored""",
    "stockout_flags": f"""WITH {_SCORED}
        SELECT {_by_day("p90_forecast, on_hand_inventory, stockout_risk_flag")} FROM scored""",
    "scored": f"""WITH {_SCORED}
        SELECT {_by_day("actual_sales")}, forecast,
            CASE WHEN on_hand_inventory > 0 THEN p90_forecast END AS p90_forecast,
            CASE WHEN on_hand_inventory > 0 THEN on_hand_inventory END AS on_hand_inventory,
            CASE WHEN on_hand_inventory > 0 THEN stockout_risk_flag END AS stockout_risk_flag,
            anomaly_flag, {_dec("anomaly_score", 6)} AS anomaly_score,
            {_dec("normalized_residual", 6)} AS normalized_residual
        FROM scored""",
    "insight_cards": f"""WITH {_CARDS}
        SELECT * REPLACE ({_dec("anomaly_score", 6)} AS anomaly_score,
            {_dec("normalized_residual", 6)} AS normalized_residual) FROM cards""",
    "persistence": f"""WITH {_CARDS}
        SELECT item_id, store_id, days_flagged, CAST(first_flagged_date AS VARCHAR)
            AS first_flagged_date FROM risk_days""",
    "latest_state": f"""WITH {_CARDS}
        SELECT {_by_day('''actual_sales, forecast, stockout_risk_flag, anomaly_flag,
            CAST(days_flagged AS INT) AS days_flagged,
            CAST(first_flagged_date AS VARCHAR) AS first_flagged_date''')} FROM latest""",
    "flagged_series": f"""WITH {_CARDS}
        SELECT count(*) AS n_series_flagged
        FROM (SELECT DISTINCT item_id, store_id FROM active) t""",
    "kpi": f"""WITH {_CARDS}
        SELECT count(*) AS rows_scored, avg(stockout_risk_flag) AS stockout_rate,
            avg(anomaly_flag) AS anomaly_rate, (SELECT count(*) FROM cards) AS n_cards FROM scored""",
    "series_list": f"""WITH {_SCORED} SELECT DISTINCT item_id, store_id FROM scored""",
    "default_series": f"""WITH {_SCORED}
        SELECT item_id, store_id FROM scored WHERE stockout_risk_flag = 1
        ORDER BY item_id, store_id LIMIT 1""",
    "series_slice": f"""WITH {_SCORED},
        pick AS (SELECT item_id, store_id FROM scored WHERE stockout_risk_flag = 1
                 ORDER BY item_id, store_id LIMIT 1)
        SELECT CAST(date AS VARCHAR) AS date, actual_sales, forecast, p90_forecast
        FROM scored JOIN pick USING (item_id, store_id)""",
    "card_feed": f"""WITH {_CARDS}
        SELECT id, item_id, store_id, date, forecast, actual_sales, stockout_risk_flag,
            anomaly_flag, summary FROM cards WHERE store_id IN ('NATION_3', 'NATION_7')""",
    "route": f"WITH {_ROUTED} SELECT id, topic FROM routed",
    "routing_counts": f"""WITH {_ROUTED}
        SELECT count(*) FILTER (WHERE topic = 'stockout_risk') AS stockout_risk,
            count(*) FILTER (WHERE topic = 'anomaly_drop') AS anomaly_drop FROM routed""",
    "reorder": f"""WITH {_CHAIN}
        SELECT card_id, item_id, store_id, reorder_qty, p90_forecast, on_hand_inventory
        FROM reorders""",
    "procurement": f"WITH {_CHAIN} SELECT * EXCLUDE (cost_ratio) FROM outcomes",
    "finance": f"WITH {_CHAIN} SELECT * FROM decided",
    "promos": f"""WITH {_SCORED}
        SELECT item_id || '_' || store_id AS card_id, item_id, store_id, CAST(date AS VARCHAR) AS day,
            CASE WHEN abs(normalized_residual) >= 3 THEN 20.0::DOUBLE
                 WHEN abs(normalized_residual) >= 2 THEN 15.0::DOUBLE ELSE 10.0::DOUBLE END
                AS proposed_discount_pct,
            'Sales ran ' || {_fixed("abs(normalized_residual)")}
            || ' deviations under the forecast; a price cut may bring them back.' AS reason
        FROM scored WHERE anomaly_flag = 1 AND normalized_residual < 0""",
    "decision_chain": f"""WITH {_CHAIN}
        SELECT 'procurement_' || procurement_status AS step, 'finance_' || finance_status AS result,
            count(*) AS n FROM decided GROUP BY ALL
        UNION ALL
        SELECT 'promo_proposed', CAST(CAST(proposed_discount_pct AS INT) AS VARCHAR), count(*)
        FROM promos GROUP BY ALL""",
    "supplier_lookup": f"WITH {_DIMENSIONS} SELECT * FROM supplier_dim",
    "dimension_violations": f"""WITH {_DIMENSIONS}
        SELECT count(*) AS n_invalid FROM (
            SELECT item_id FROM supplier_dim GROUP BY item_id
            HAVING count(*) > 1 OR min(lead_time_days) < 3 OR max(lead_time_days) > 13
            UNION ALL
            SELECT item_id FROM supplier_dim WHERE cost_ratio NOT BETWEEN 0.45 AND 0.75) t""",
    "pending": f"WITH {_QUEUE} SELECT id, topic, card_id FROM waiting",
    "marked_queue": f"""WITH {_QUEUE},
        risks AS (SELECT * FROM queue WHERE topic = 'stockout_risk'),
        one AS (SELECT id FROM risks WHERE id < '8' ORDER BY created_at, id LIMIT 50),
        two AS (SELECT id FROM risks WHERE id NOT IN (SELECT id FROM one) ORDER BY created_at, id LIMIT 40)
        SELECT id, topic, card_id FROM risks
        WHERE id NOT IN (SELECT id FROM one) AND id NOT IN (SELECT id FROM two)""",
    "poll_bounded": f"""WITH {_QUEUE}
        SELECT id AS message_id, item_id, store_id, p90_forecast, on_hand_inventory
        FROM waiting WHERE topic = 'stockout_risk' ORDER BY created_at, id LIMIT 50""",
    "queue_depth": f"WITH {_QUEUE} SELECT topic, count(*) AS pending FROM waiting GROUP BY topic",
    "recent_actions": f"""WITH {_ACTIONS}
        SELECT date || ' 00:00:00' AS time, agent, action, card_id, item_id, store_id, reorder_qty
        FROM actions ORDER BY date DESC, id LIMIT 50""",
    "action_fields": f"""WITH {_ACTIONS}
        SELECT card_id, rationale FROM actions WHERE action = 'reorder_recommended'""",
    "cosine_topk": f"WITH {_HITS} SELECT query_id, id, score, rank FROM hits",
    "cosine_topk_cells": f"WITH {_HITS} SELECT query_id, id, score, rank FROM hits",
    "stored_search": f"""WITH {_HITS}
        SELECT query_id, id, score, rank, label FROM hits JOIN embeddings ON vec_id = id
        WHERE query_id % 10 = 0""",
    "cells_recall": """SELECT vec_id AS query_id, least(5, (SELECT count(*) FROM embeddings) - 1) AS n_hits,
            0::BIGINT AS n_wrong, true AS recall_reached
        FROM embeddings""",
    "context_assembly": f"""WITH {_HITS},
        lines AS (
            SELECT query_id, string_agg('- vector ' || id || ' label ' || label, chr(10)
                ORDER BY rank) AS context
            FROM hits JOIN embeddings ON vec_id = id WHERE score >= 0.3 GROUP BY query_id)
        SELECT vec_id AS query_id, coalesce(context, '') AS context,
            coalesce('Use only these insight cards; say so if they do not hold the answer.'
                || chr(10) || chr(10) || context || chr(10) || chr(10)
                || 'Question: What is like vector ' || vec_id || '?',
                'None of the stored cards fits what was asked.') AS prompt
        FROM embeddings LEFT JOIN lines ON query_id = vec_id""",
    "usage_window": f"""WITH {_USAGE}
        SELECT event_id, user_id,
            count(*) OVER (PARTITION BY user_id ORDER BY us
                RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW) AS burst_used,
            count(*) OVER (PARTITION BY user_id ORDER BY us
                RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW) AS daily_used
        FROM asks""",
    "usage_now": f"""WITH {_USAGE}, newest AS (SELECT max(us) AS moment FROM asks)
        SELECT user_id, count(*) FILTER (WHERE us > moment - 60000000) AS burst_used, 5 AS burst_max,
            count(*) FILTER (WHERE us > moment - 86400000000) AS daily_used, 100 AS daily_max
        FROM asks, newest GROUP BY user_id""",
    "replay_cards": f"WITH {_REPLAY} SELECT * FROM replayed",
    "replay_reorders": f"""WITH {_REPLAY}
        SELECT batch, count(*) AS cards, count(*) FILTER (WHERE stockout_risk_flag = 1) AS published,
            count(*) FILTER (WHERE stockout_risk_flag = 1
                AND {_dec("p90_forecast * 7 * 1.2::DOUBLE - on_hand_inventory", 1)} > 0) AS reorders
        FROM replayed GROUP BY batch""",
}


def _admission(key: str, column: str) -> str:
    """Asks decided one after the other; the list keeps the admitted times."""
    burst = "len(list_filter(s.kept, lambda k: k > o.us - 60000000)) >= 5"
    daily = "len(list_filter(s.kept, lambda k: k > o.us - 86400000000)) >= 100"
    return f"""WITH RECURSIVE ordered AS (
        SELECT {key} AS k, event_id, ts, epoch_us(ts) AS us,
            row_number() OVER (PARTITION BY {key} ORDER BY ts, event_id) AS n
        FROM events),
    step AS (
        SELECT k, event_id, ts, n, [us] AS kept, '' AS refused_by FROM ordered WHERE n = 1
        UNION ALL
        SELECT o.k, o.event_id, o.ts, o.n,
            CASE WHEN {burst} OR {daily} THEN s.kept ELSE list_append(
                list_filter(s.kept, lambda k: k > o.us - 86400000000), o.us) END,
            CASE WHEN {burst} THEN 'burst' WHEN {daily} THEN 'daily' ELSE '' END
        FROM step s JOIN ordered o ON o.k = s.k AND o.n = s.n + 1)
    SELECT k AS {column}, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
        refused_by = '' AS admitted, refused_by FROM step"""


ORACLES["rate_limit"] = _admission("user_id", "user_id")
ORACLES["rate_limit_global"] = _admission("'all'", "scope")
ORACLES["rate_limit_stream"] = ORACLES["rate_limit"]
ORACLES["rate_limit_bounded_stream"] = ORACLES["rate_limit"]
for _name in ("usage_window", "usage_now"):  # usage counts admitted events only
    ORACLES[_name] = ORACLES[_name].replace(
        "epoch_us(ts) AS us FROM events",
        f"epoch_us(CAST(ts AS TIMESTAMP)) AS us FROM ({ORACLES['rate_limit']}) r WHERE admitted",
    )
ORACLES["replay_stream"] = ORACLES["replay_cards"]
ORACLES["replay_stream_reorders"] = ORACLES["replay_reorders"]
ORACLES["usage_stream"] = ORACLES["usage_window"]
ORACLES["cumulative_cards"] = ORACLES["insight_cards"]
ORACLES["card_documents"] = ORACLES["insight_cards"]
ORACLES["part_documents"] = "SELECT CAST(p_partkey AS VARCHAR) AS part, p_name, p_retailprice FROM part"
ORACLES["decision_stream"] = ORACLES["finance"]
