"""Daily and weekly facts on hand-written rows."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from shelfline.plans import facts, metrics
from shelfline.sources.sample_retail import SampleRetail
from tests.conftest import CATALOG, INVENTORY, SAMPLE, WEB, day_key, rows

SUN, MON, SAT = day_key("1999-12-26"), day_key("1999-12-27"), day_key("2000-01-01")
NEXT_SUN = day_key("2000-01-02")


def sale(warehouse, item, day, qty, price="2.00", profit="1.00"):
    money = [None if v is None else Decimal(v) for v in (price, profit)]
    return (warehouse, item, day, qty, *money)


def channels(spark, catalog, web):
    return spark.createDataFrame(catalog, CATALOG), spark.createDataFrame(web, WEB)


def stock(spark, data):
    return spark.createDataFrame(data, INVENTORY)


def daily(spark, calendar, catalog, web=(), **kwargs):
    return facts.daily_sales(*channels(spark, list(catalog), list(web)), calendar, **kwargs)


def test_daily_sums_both_channels_and_drops_incomplete_lines(spark, calendar):
    result = daily(
        spark,
        calendar,
        [
            sale(1, 7, MON, 3, "2.50", "1.25"),
            sale(1, 7, MON, None),
            sale(1, 7, MON, 5, None),
            sale(1, 7, None, 5),
        ],
        [sale(1, 7, MON, 4, "1.10", "-0.75"), sale(None, 7, MON, 1, "9.99", None)],
    )
    assert rows(result) == [
        (1, 7, MON, 52, 1999, 7, 11.9, 0.5),
        (None, 7, MON, 52, 1999, 1, 9.99, None),
    ]


def test_daily_keeps_days_missing_from_the_calendar(spark, calendar):
    result = daily(spark, calendar, [sale(1, 7, 5, 2)])
    assert rows(result, "sold_date_sk", "sold_wk_num", "sold_yr_num") == [(5, None, None)]


def test_money_sums_do_not_depend_on_order(spark, calendar):
    lines = [sale(1, 7, MON, 1, "0.10", "0.10") for _ in range(1000)]
    result = daily(spark, calendar, lines)
    assert rows(result, "daily_sales_amt", "daily_net_profit") == [(100.0, 100.0)]


def test_refresh_rebuilds_last_day_and_never_reads_older_ones(spark, calendar):
    target = daily(spark, calendar, [sale(1, 7, SUN, 1), sale(1, 7, MON, 1)])
    result = daily(
        spark,
        calendar,
        # SUN now has a late line, MON has been corrected, SAT is new.
        [sale(1, 7, SUN, 1), sale(1, 8, SUN, 9), sale(1, 7, MON, 6), sale(2, 7, SAT, 2)],
        target=target,
    )
    assert rows(result, "warehouse_sk", "item_sk", "sold_date_sk", "daily_qty") == [
        (1, 7, SUN, 1),
        (1, 7, MON, 6),
        (2, 7, SAT, 2),
    ]


def test_refresh_of_an_empty_target_is_a_full_load(spark, calendar):
    lines = [sale(1, 7, SUN, 1), sale(1, 7, MON, 1)]
    full = daily(spark, calendar, lines)
    assert rows(daily(spark, calendar, lines, target=full.limit(0))) == rows(full)


def test_refresh_again_changes_nothing(spark, calendar):
    lines = [sale(1, 7, SUN, 1), sale(1, 7, MON, 4), sale(2, 9, MON, 4)]
    once = daily(spark, calendar, lines)
    assert rows(daily(spark, calendar, lines, target=once)) == rows(once)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_sequence_of_loads_equals_one_full_load(spark, calendar, seed):
    rng = random.Random(seed)
    days = [day_key("1999-12-22") + d for d in range(25)]
    lines = [
        sale(rng.choice([1, 2, None]), rng.randrange(3), rng.choice(days), rng.randrange(-1, 9))
        for _ in range(120)
    ]
    shelves = stock(
        spark,
        [
            (rng.choice(days), rng.randrange(3), rng.choice([None, 0, 5, 11]), rng.choice([1, 2]))
            for _ in range(60)
        ],
    )
    target = mart = None
    for cut in sorted(rng.sample(days[:-1], 3)) + [days[-1]]:
        # The last day of each load is incomplete until the next one.
        seen = [s for s in lines if s[2] < cut or (s[2] == cut and rng.random() < 0.5)]
        if cut == days[-1]:
            seen = lines
        target = daily(spark, calendar, seen, target=target)
        target = spark.createDataFrame(target.collect(), target.schema)
        mart = facts.weekly_sales_inventory(target, shelves, calendar, mart)
        mart = spark.createDataFrame(mart.collect(), mart.schema)
    full = daily(spark, calendar, lines)
    assert rows(target) == rows(full)
    assert rows(mart) == rows(facts.weekly_sales_inventory(full, shelves, calendar))


def weekly(spark, calendar, lines, shelves=(), **kwargs):
    return facts.weekly_sales_inventory(
        daily(spark, calendar, lines), stock(spark, list(shelves)), calendar, **kwargs
    )


def test_week_is_keyed_by_its_sunday_across_the_year_end(spark, calendar):
    result = weekly(spark, calendar, [sale(1, 7, MON, 3), sale(1, 7, SAT, 4)])
    assert rows(result, "sold_wk_sk", "sold_wk_num", "sold_yr_num", "sum_qty_wk") == [
        (SUN, 52, 1999, 7)
    ]


def test_week_without_sunday_is_dropped_and_counted(spark, calendar):
    lines = [sale(1, 7, MON, 3), sale(1, 7, NEXT_SUN, 4), sale(1, 7, 5, 2)]
    gappy = calendar.filter(f"d_date_sk != {SUN}")
    facts_daily = daily(spark, gappy, lines)
    result = facts.weekly_sales_inventory(facts_daily, stock(spark, []), gappy)
    assert rows(result, "sold_wk_sk", "sum_qty_wk") == [(NEXT_SUN, 4)]
    assert rows(facts.weeks_without_sunday(facts_daily, gappy)) == [(2, 5)]


def test_measures_of_one_week(spark, calendar):
    result = weekly(
        spark, calendar, [sale(1, 7, MON, 20, "2.00", "1.50")], [(SUN, 7, 50, 1)]
    )
    assert rows(result)[0][5:] == (
        20,
        40.0,
        1.5,
        Decimal("2.857143"),
        50,
        Decimal("2.500000"),
        False,
    )


def test_each_stock_row_repeats_the_sales_unless_asked_not_to(spark, calendar):
    lines = [sale(1, 7, MON, 20, "2.00", "1.50")]
    shelves = [(SUN, 7, 50, 1), (MON, 7, None, 1), (SAT, 7, 10, 1)]
    columns = ["sum_qty_wk", "sum_amt_wk", "sum_profit_wk", "inv_qty_wk", "wks_sply"]
    repeated = weekly(spark, calendar, lines, shelves)
    once = weekly(spark, calendar, lines, shelves, fanout="safe")
    assert rows(repeated, *columns) == [(60, 120.0, 4.5, 60, Decimal("1.000000"))]
    assert rows(once, *columns) == [(20, 40.0, 1.5, 60, Decimal("3.000000"))]


def test_one_stock_row_per_week_makes_both_fanouts_agree(spark, calendar):
    lines = [sale(1, 7, MON, 20), sale(2, 7, SAT, 3), sale(1, 8, NEXT_SUN, 5)]
    shelves = [(SUN, 7, 50, 1), (SUN, 7, 1, 2), (NEXT_SUN, 8, 2, 1)]
    assert rows(weekly(spark, calendar, lines, shelves)) == rows(
        weekly(spark, calendar, lines, shelves, fanout="safe")
    )


def test_zero_and_negative_weeks_are_left_out(spark, calendar):
    lines = [sale(1, 7, MON, 3), sale(1, 7, SAT, -3), sale(1, 8, MON, -1), sale(1, 9, MON, 1)]
    assert rows(weekly(spark, calendar, lines), "item_sk") == [(9,)]


def test_null_warehouse_sells_but_never_finds_stock(spark, calendar):
    result = weekly(spark, calendar, [sale(None, 7, MON, 3)], [(SUN, 7, 50, 1)])
    assert rows(result, "warehouse_sk", "inv_qty_wk", "wks_sply") == [
        (None, 0, Decimal("0.000000"))
    ]


def test_stock_without_a_warehouse_or_without_sales_adds_nothing(spark, calendar):
    shelves = [(SUN, 7, 50, None), (SUN, 8, 5, 1), (SUN, 7, None, 1)]
    inventory = spark.createDataFrame(shelves, INVENTORY)
    sold = daily(spark, calendar, [sale(None, 7, MON, 3), sale(1, 7, MON, 4)])
    result = facts.weekly_sales_inventory(sold, inventory, calendar)
    assert rows(result, "warehouse_sk", "item_sk", "sum_qty_wk", "inv_qty_wk") == [
        (1, 7, 4, 0),
        (None, 7, 3, 0),
    ]


@pytest.mark.parametrize("qty, shelf, flag", [(7, 1, False), (8, 1, True), (1, None, True)])
def test_low_stock_flag_compares_daily_average_with_stock(spark, calendar, qty, shelf, flag):
    result = weekly(spark, calendar, [sale(1, 7, MON, qty)], [(SUN, 7, shelf, 1)])
    assert rows(result, "low_stock_flg_wk") == [(flag,)]


def test_daily_watermark_only_adds_groups_first_sold_on_the_last_day(spark, calendar):
    first = [sale(1, 7, MON, 3)]
    mart = weekly(spark, calendar, first)
    later = first + [sale(1, 7, SAT, 1), sale(1, 8, SAT, 2), sale(1, 9, MON, 5)]
    columns = ["item_sk", "sold_wk_sk", "sum_qty_wk"]
    assert rows(weekly(spark, calendar, later, target=mart, watermark="daily"), *columns) == [
        (7, SUN, 3),
        (8, SUN, 2),
    ]
    assert rows(weekly(spark, calendar, later, target=mart), *columns) == [
        (7, SUN, 4),
        (8, SUN, 2),
        (9, SUN, 5),
    ]


def test_weekly_quantity_is_daily_quantity_less_what_is_counted_as_dropped(spark, calendar):
    lines = [sale(w, i, MON + d, 1 + d) for w in (1, None) for i in (7, 8) for d in range(12)]
    gappy = calendar.filter(f"d_date_sk != {NEXT_SUN}")
    facts_daily = daily(spark, gappy, lines)
    shelves = stock(spark, [(SUN, 7, 5, 1), (MON, 7, 5, 1)])
    mart = facts.weekly_sales_inventory(facts_daily, shelves, gappy, fanout="safe")
    total = sum(r[0] for r in rows(facts_daily, "daily_qty"))
    kept = sum(r[0] for r in rows(mart, "sum_qty_wk"))
    dropped = rows(facts.weeks_without_sunday(facts_daily, gappy), "daily_qty")[0][0]
    assert dropped > 0 and kept == total - dropped


def test_calendar_with_a_repeated_day_is_refused(spark, calendar):
    with pytest.raises(ValueError, match="d_date_sk"):
        facts.check_calendar(calendar.unionByName(calendar.filter(f"d_date_sk = {MON}")))


def test_unknown_choices_are_refused(spark, calendar):
    mart = weekly(spark, calendar, [sale(1, 7, MON, 3)])
    with pytest.raises(ValueError):
        weekly(spark, calendar, [], target=mart, watermark="monthly")
    with pytest.raises(ValueError):
        weekly(spark, calendar, [], fanout="twice")


def test_two_sundays_of_a_week_make_one_row_that_counts_twice(spark, calendar):
    # Week 52 of one year: its first days, and the days of another Sunday far behind them.
    far = day_key("2000-01-16")
    twice = calendar.filter(f"d_date_sk not between {far} and {far + 6}").unionByName(
        calendar.filter(f"d_date_sk between {far} and {far + 6}")
        .withColumn("wk_num", F.lit(52).cast("bigint"))
        .withColumn("yr_num", F.lit(1999).cast("bigint"))
    )
    lines = [sale(1, 7, MON, 20, "2.00", "1.50"), sale(1, 7, far + 1, 1, "2.00", "1.50")]
    shelves = stock(spark, [(SUN, 7, 4, 1), (SAT, 7, 5, 1)])
    sold = daily(spark, twice, lines)
    columns = ["sold_wk_sk", "sum_qty_wk", "sum_amt_wk", "sum_profit_wk", "inv_qty_wk", "wks_sply"]
    mart = facts.weekly_sales_inventory(sold, shelves, twice)
    # Two Sundays times two stock rows; the ratio is nine of stock, twice, to 84.
    assert rows(mart, *columns) == [(SUN, 84, 168.0, 12.0, 18, Decimal("0.214286"))]
    once = facts.weekly_sales_inventory(sold, shelves, twice, fanout="safe")
    assert rows(once, *columns) == [(SUN, 21, 42.0, 3.0, 9, Decimal("0.428571"))]
    assert facts.check_calendar(twice) is twice


def test_the_sample_has_weeks_with_two_sundays_and_with_none(spark):
    sample = SampleRetail(spark, SAMPLE)
    sundays = sample.date_dim.filter("day_of_wk_num = 0").groupBy("wk_num", "yr_num").count()
    assert sundays.filter("count > 1").count() > 0
    sold = facts.daily_sales(sample.catalog_sales, sample.web_sales, sample.date_dim)
    assert rows(facts.weeks_without_sunday(sold, sample.date_dim))[0][0] > 0
    flags = metrics.low_stock_flag(sample.catalog_sales, sample.web_sales, sample.inventory, sample.date_dim)
    assert rows(flags.select("low_stock_flg_wk").distinct()) == [("False",), ("True",)]


def test_rows_dropped_for_want_of_a_sunday_are_counted_by_the_mart_itself(spark, calendar):
    lines = [sale(1, 7, MON, 3), sale(2, 7, SAT, 2), sale(1, 7, NEXT_SUN, 4), sale(1, 7, 5, 2)]
    gappy = calendar.filter(f"d_date_sk != {SUN}")
    sold = daily(spark, gappy, lines)
    dropped = Observation()
    mart = facts.weekly_sales_inventory(sold, stock(spark, []), gappy, dropped=dropped)
    assert rows(mart) == rows(facts.weekly_sales_inventory(sold, stock(spark, []), gappy))
    assert dropped.get == {"daily_rows": 3, "daily_qty": 7}
    assert rows(facts.weeks_without_sunday(sold, gappy)) == [(3, 7)]
