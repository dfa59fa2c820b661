"""Sums of money against exact arithmetic."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfline.functions import LIMBS, Money, money, together
from shelfline.plans import facts, metrics
from tests.conftest import INVENTORY, day_key, rows

MON, NEXT_MON = day_key("1999-12-27"), day_key("2000-01-03")
FLOAT_SALES = """cs_warehouse_sk long, cs_item_sk long, cs_sold_date_sk long, cs_quantity long,
    cs_sales_price double, cs_net_profit double"""


def summed(spark, groups, levels=1):
    """Totals of groups of doubles, summed in one or two levels."""
    data = [(g, i % 7, x) for g, values in groups.items() for i, x in enumerate(values)]
    df = spark.createDataFrame(data, "g long, part long, x double").repartition(4)
    if levels == 2:
        per_part = df.groupBy("g", "part").agg(*LIMBS.sums("m", F.col("x")))
        out = per_part.groupBy("g").agg(*LIMBS.sums("m"))
    else:
        out = df.groupBy("g").agg(*LIMBS.sums("m", F.col("x")))
    return {r["g"]: r["total"] for r in out.select("g", LIMBS.double("m").alias("total")).collect()}


def groups_of(seed):
    rng = random.Random(seed)
    draw = [
        lambda: rng.uniform(-1, 1),
        lambda: round(rng.uniform(-1e6, 1e6), rng.randrange(7)),
        lambda: rng.choice([-1, 1]) * math.ldexp(rng.random(), rng.randint(-30, 60)),
        lambda: rng.choice([0.1, 0.2, 0.3, -0.6, 1e15, -1e15, 1e-9, 3e-5]),
        lambda: float(rng.randint(-(2**53), 2**53)),
    ]
    return {g: [draw[g % len(draw)]() for _ in range(rng.randint(1, 60))] for g in range(200)}


@pytest.mark.parametrize("levels", [1, 2])
def test_sums_of_doubles_are_the_nearest_to_the_exact_sum(spark, levels):
    groups = groups_of(levels)
    groups[900] = [2.0**62, 1.0, 2.0**-20, -(2.0**62)]
    groups[901] = [2.0**53, 1.0, 2.0**-30]  # just above a tie
    groups[902] = [2.0**53, 1.0]  # a tie goes to the even neighbour
    groups[903] = [1e308 * 0, -0.0]
    assert summed(spark, groups, levels) == {g: math.fsum(v) for g, v in groups.items()}


def test_totals_that_are_one_integer_round_as_the_digits_do(spark):
    """Quarters and the like lie in two limbs; beyond 53 bits, or with bits elsewhere, a total is still the nearest double."""
    rng = random.Random(11)
    groups = {g: [rng.choice([-1, 1]) * rng.randrange(4**k) / 4 for _ in range(40)] for g, k in enumerate([1, 5, 9, 13, 16, 17, 18] * 4)}
    edge = 2.0**34
    groups |= {
        100: [edge, 2.0**-27], 101: [-edge, -(2.0**-27)], 102: [2.0**33, 2.0**-27, 2.0**-21], 103: [-(2.0**33), 2.0**-20, -(2.0**-27)],
        104: [2.0**26 + 2.0**-27, 2.0**26], 105: [1.25, -1.25], 106: [0.25, 2.0**-40], 107: [2.0**40, -(2.0**40), 0.75], 108: [None, -0.5],
    }
    exact = {g: math.fsum(x for x in v if x is not None) for g, v in groups.items()}
    for levels in (1, 2):
        assert summed(spark, groups, levels) == exact


def test_nan_infinity_and_huge_amounts_show_and_stop_nothing(spark):
    inf, nan = math.inf, math.nan
    found = summed(spark, {1: [1.0, nan], 2: [1.0, inf], 3: [inf, -inf], 4: [1e300, 2.0], 5: [nan], 6: [0.5]})
    assert math.isnan(found[1]) and found[2] == inf and math.isnan(found[3])
    assert found[4] == 1e300 and math.isnan(found[5]) and found[6] == 0.5


def test_nulls_are_passed_over_and_only_nulls_are_null(spark):
    assert summed(spark, {1: [None, 0.25, None], 2: [None, None]}) == {1: 0.25, 2: None}


def test_bits_below_the_last_limb_are_rounded_off_row_by_row(spark):
    assert summed(spark, {1: [2.0**-88, 2.0**-88], 2: [2.0**-87]}) == {1: 0.0, 2: 2.0**-87}


def test_differences_and_multiples_are_exact(spark):
    df = spark.createDataFrame([(0.1, 0.3, 3), (0.2, 0.1, 3)], "a double, b double, n long")
    out = df.groupBy("n").agg(*LIMBS.sums("a", F.col("a")), *LIMBS.sums("b", F.col("b")))
    out = out.select("n", *LIMBS.minus("a", "b")).select(*LIMBS.scaled("a", F.col("n")))
    exact = (Decimal(0.1) + Decimal(0.2) - Decimal(0.3) - Decimal(0.1)) * 3
    assert out.select(LIMBS.double("a")).first()[0] == float(exact)


def test_the_way_follows_the_types(spark):
    df = spark.createDataFrame([], "a decimal(12,6), b decimal(9,2), c long, d double")
    assert money(df, "a", "b") == Money(6) and money(df, "c") == Money(0) and money(df, "a", "d") == LIMBS
    assert together(Money(2), Money(6)) == Money(6) and together(Money(2), LIMBS) == LIMBS


def test_long_totals_of_units_round_once(spark):
    cents = 2**53 + 3
    df = spark.createDataFrame([(cents,)], "m long")
    assert df.select(Money(2).double("m")).first()[0] == float(Decimal(cents) / 100)


def lines(spark, *data):
    catalog = spark.createDataFrame([(1, 7, *line) for line in data], FLOAT_SALES)
    web = spark.createDataFrame([], FLOAT_SALES.replace("cs_", "ws_"))
    return catalog, web


def test_money_of_doubles_is_not_cut(spark, calendar):
    catalog, web = lines(spark, (MON, 1000, 1.23456, 0.00003), (MON, 1, 1e-7, math.nan))
    daily = facts.daily_sales(catalog, web, calendar)
    amount, profit = daily.select("daily_sales_amt", "daily_net_profit").first()
    assert amount == math.fsum([1.23456 * 1000, 1e-7]) and math.isnan(profit)
    clean = facts.daily_sales(*lines(spark, (MON, 1000, 1.23456, 0.00003)), calendar)
    shelves = spark.createDataFrame([], INVENTORY)
    mart = facts.weekly_sales_inventory(clean, shelves, calendar)
    # What multiplying the doubles gives: 1234.56 to the last bit but one.
    assert rows(mart, "sum_amt_wk", "sum_profit_wk") == [(1.23456 * 1000, 0.00003)]
    assert rows(mart.select(F.round("sum_amt_wk", 9))) == [(1234.56,)]
    assert rows(metrics.weekly_metric(catalog, calendar, "amt"), "sum_amt_wk") == [(amount,)]


def test_six_decimals_survive_into_the_mart(spark, calendar):
    kind = "decimal(12,6)"
    schema = FLOAT_SALES.replace("double", kind)
    price, profit = Decimal("0.000001"), Decimal("-0.000007")
    catalog = spark.createDataFrame([(1, 7, MON, 3, price, profit), (1, 7, MON + 1, 4, price, profit)], schema)
    web = spark.createDataFrame([], schema.replace("cs_", "ws_"))
    daily = facts.daily_sales(catalog, web, calendar)
    assert rows(daily, "daily_sales_amt") == [(0.000003,), (0.000004,)]
    mart = facts.weekly_sales_inventory(daily, spark.createDataFrame([], INVENTORY), calendar)
    assert rows(mart, "sum_amt_wk", "sum_profit_wk") == [(math.fsum([0.000003, 0.000004]), -0.000014)]
    assert rows(metrics.weekly_metric(catalog, calendar, "amt"), "sum_amt_wk") == [(Decimal("0.000007"),)]


WEB = """ws_bill_customer_sk long, ws_net_paid double, ws_wholesale_cost double, ws_sold_date_sk long,
    ws_sales_price double"""


def test_metrics_of_double_money(spark, calendar):
    rng = random.Random(9)
    data = [(1, rng.uniform(0, 1e6), rng.uniform(0, 1e6), rng.choice([MON, NEXT_MON]), rng.uniform(0, 9)) for _ in range(500)]
    web = spark.createDataFrame(data, WEB).repartition(4)
    customers = spark.createDataFrame([(1,), (1,)], "c_customer_sk long")
    value = metrics.customer_lifetime_value(customers, web).first()["customer_lifetime_value"]
    assert value == math.fsum([x for d in data for x in (d[1], d[1], -d[2], -d[2])])
    months = {(r["year"], r["month"]): r["total_sales"] for r in metrics.seasonal_sales(web, calendar).collect()}
    for day, key in ((MON, (1999, 12)), (NEXT_MON, (2000, 1))):
        assert months[key] == math.fsum(d[1] for d in data if d[3] == day)
    quarters = [r["total_sales"] for r in metrics.sales_by_period(web, calendar, "quarter").collect()]
    assert quarters == [math.fsum(d[4] for d in data if d[3] == day) for day in (MON, NEXT_MON)]
