import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import features, panel, reshape
from shelfcast.plans import scoring
from shelfcast.sources import tables

IDS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
START = date(2020, 1, 1)


def wide_csv(folder, n_series=5, n_days=40, hole=True):
    """The three input files with a known content; item 0 has an empty first day."""
    days = [f"d_{i + 1}" for i in range(n_days)]
    lines = [",".join(IDS + days)]
    for s in range(n_series):
        ids = [f"i{s}_s1", f"i{s}", "D1", "C1", "s1", "CA"]
        values = [str((s + 1) * (d % 5)) for d in range(n_days)]
        if hole and s == 0:
            values[0] = ""
        lines.append(",".join(ids + values))
    (folder / "sales_train_validation.csv").write_text("\n".join(lines) + "\n")
    header = "date,wm_yr_wk,weekday,wday,month,year,d,event_name_1,event_type_1,snap_CA,snap_TX,snap_WI"
    rows = [header]
    for i in range(n_days):
        day = START + timedelta(days=i)
        event = "Fest,Cultural" if i == 3 else ","
        rows.append(
            f"{day},{i // 7 + 1},X,{(i % 7) + 1},{day.month},{day.year},d_{i + 1},{event},{i % 2},1,0"
        )
    (folder / "calendar.csv").write_text("\n".join(rows) + "\n")
    prices = ["store_id,item_id,wm_yr_wk,sell_price"]
    prices += [f"s1,i{s},{w},{s + w}.5" for s in range(n_series) for w in range(2, 6)]
    (folder / "sell_prices.csv").write_text("\n".join(prices) + "\n")


def test_ingest_from_files(spark, tmp_path):
    wide_csv(tmp_path)
    wide = tables.read_wide_sales(spark, str(tmp_path / "sales_train_validation.csv"))
    assert len(reshape.day_columns(wide)) == 40
    assert reshape.unpivot_days(wide).count() == 5 * 40 - 1
    assert reshape.melt(wide, IDS, reshape.day_columns(wide)).count() == 5 * 40
    fact = scoring.ingest(spark, str(tmp_path)).cache()
    assert fact.columns == list(panel.FACT_COLUMNS)
    # Week 1 has no price: its sales are kept with a null price.
    assert fact.where("wm_yr_wk = 1").count() == 5 * 7 - 1
    assert fact.where("wm_yr_wk = 1 AND sell_price IS NOT NULL").count() == 0
    assert panel.fact_counts(fact).first().asDict() == {"n_rows": 199, "n_series": 5}
    built = features.build_features(fact, drop_short_history=False)
    on_event_day = built.where(F.col("date") == START + timedelta(days=3)).first()
    assert (on_event_day.has_event, on_event_day.snap_active) == (1, 2)


def test_very_wide_table(spark):
    days = [f"d_{i + 1}" for i in range(1913)]
    cells = [f"cast(id + {i} as bigint) as {d}" for i, d in enumerate(days)]
    wide = spark.range(3).selectExpr("cast(id as string) as id", *cells)
    long = reshape.unpivot_days(wide, ["id"])
    got = long.agg(F.count("*"), F.sum("sales"), F.countDistinct("d")).first()
    total = sum(k + i for k in range(3) for i in range(1913))
    assert tuple(got) == (3 * 1913, total, 1913)
    assert long.where("id = '2' AND d = 'd_1913'").first().sales == 2 + 1912


def test_missing_input_names_the_table(spark, tmp_path):
    with pytest.raises(tables.MissingInput, match="val_residuals"):
        tables.read_parquet(spark, str(tmp_path / "none"), "val_residuals", hint="Run scoring.")


def series(spark, values, item="a"):
    rows = [
        (item, "D", "C", "s", "S", START + timedelta(days=i), v, 2.0 + i // 7, i % 7 + 1, None, 0, 0, 1)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(
        rows,
        "item_id string, dept_id string, cat_id string, store_id string, state_id string, "
        "date date, sales long, sell_price double, wday long, event_name_1 string, "
        "snap_ca long, snap_tx long, snap_wi long",
    ).withColumns({"month": F.month("date"), "year": F.year("date")})


def test_lags_and_frames_agree_with_hand_values(spark):
    fact = series(spark, list(range(40)))
    rows = features.build_features(fact, drop_short_history=False).orderBy("date").collect()
    assert [r.lag_7 for r in rows[:8]] == [None] * 7 + [0]
    assert rows[10].roll_mean_7 == 6.0
    assert rows[0].roll_mean_7 is None and rows[1].roll_std_7 is None
    assert rows[2].roll_std_7 == pytest.approx(0.5**0.5)
    assert rows[7].price_change_7d == 1.0
    kept = features.build_features(fact)
    assert kept.count() == 12


def test_running_totals_equal_window_frames(spark):
    values = [(i * 7919) % 23 for i in range(60)]
    fact = series(spark, values).unionByName(series(spark, [5] * 60, "b"))
    columns = ["roll_mean_7", "roll_std_7", "roll_mean_28", "roll_std_28"]
    fast = features.build_features(fact, drop_short_history=False, running_totals=True)
    slow = features.build_features(fact, drop_short_history=False, running_totals=False)
    order = ["item_id", "date"]
    for a, b in zip(fast.orderBy(*order).collect(), slow.orderBy(*order).collect()):
        for c in columns:
            assert a[c] == (None if b[c] is None else pytest.approx(b[c], abs=1e-12))


def test_running_totals_of_large_counts(spark):
    values = [10**9 + (i * 7919) % 23 % 3 for i in range(60)]
    rows = features.build_features(
        series(spark, values), drop_short_history=False, running_totals=True
    ).orderBy("date").collect()
    for i, row in enumerate(rows):
        for n in (7, 28):
            before = values[max(0, i - n) : i]
            if len(before) > 1:
                exact = statistics.stdev(v - 10**9 for v in before)
                assert row[f"roll_std_{n}"] == pytest.approx(exact, abs=1e-12)


def test_no_leakage(spark):
    values = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3] * 4
    changed = values[:-1] + [999]
    over = features.series_window()

    def last(v):
        fact = series(spark, v).withColumn("leaky", features.leaky_mean("sales", 7, over))
        built = features.build_features(fact).orderBy(F.desc("date")).drop("sales").first()
        return built, fact.orderBy(F.desc("date")).first().leaky

    (safe_a, leaky_a), (safe_b, leaky_b) = last(values), last(changed)
    assert safe_a == safe_b
    assert leaky_a != leaky_b


def test_full_frames_only(spark):
    over = features.series_window()
    rows = series(spark, list(range(10))).select(
        "date", *features.trailing_full("sales", 7, over)
    ).orderBy("date").collect()
    assert [r.roll_mean_7 for r in rows] == [None] * 7 + [3.0, 4.0, 5.0]


def test_densify_fills_gaps_and_carries_prices(spark):
    day = START + timedelta(days=1)
    sparse = spark.createDataFrame(
        [
            ("a", "D", "C", "s", "S", day, 4, 1.5),
            ("a", "D", "C", "s", "S", START + timedelta(days=5), 2, 1.5),
            ("a", "D", "C", "s", "S", START + timedelta(days=15), 7, 9.0),
            ("b", "D", "C", "s", "S", START + timedelta(days=20), 1, 3.0),
        ],
        "item_id string, dept_id string, cat_id string, store_id string, state_id string, "
        "date date, sales long, price double",
    )

    def week(column):
        return F.floor(F.datediff(column, F.lit(START)) / 7)

    dense = reshape.densify(
        sparse, first=START, last=START + timedelta(days=20), period=week, period_values=["price"]
    ).cache()
    assert dense.count() == 2 * 21
    a = [r for r in dense.where("item_id = 'a'").orderBy("date").collect()]
    assert [r.sales for r in a] == [0, 4, 0, 0, 0, 2] + [0] * 9 + [7] + [0] * 5
    assert [r.price for r in a] == [1.5] * 7 + [None] * 7 + [9.0] * 7
    late = START + timedelta(days=10)
    clipped = reshape.densify(
        sparse, first=START, last=START + timedelta(days=20), since=late,
        period=week, period_values=["price"],
    )
    assert sorted(clipped.collect()) == sorted(dense.where(F.col("date") >= late).collect())
    # Without given bounds the newest and oldest days come from the data.
    assert reshape.densify(sparse).count() == 2 * 20
