"""Metric queries on hand-written rows."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.functions import exact_ratio
from shelfline.plans import metrics
from tests.conftest import CATALOG, INVENTORY, WEB, day_key, rows

SUN, MON, FEB = day_key("1999-12-26"), day_key("1999-12-27"), day_key("2000-02-01")

WEB_FULL = """ws_warehouse_sk long, ws_item_sk long, ws_sold_date_sk long, ws_quantity long,
    ws_sales_price decimal(7,2), ws_net_profit decimal(7,2), ws_net_paid decimal(7,2),
    ws_wholesale_cost decimal(7,2), ws_bill_customer_sk long, ws_ship_addr_sk long,
    ws_order_number long, ws_promo_sk long, ws_ship_mode_sk long, ws_web_site_sk long,
    ws_ship_date_sk long"""


def web(spark, *lines):
    names = [field.strip().split(" ")[0] for field in WEB_FULL.replace("(7,2)", "").split(",")]
    given = [tuple(line.get(n.removeprefix("ws_")) for n in names) for line in lines]
    return spark.createDataFrame(given, WEB_FULL)


def catalog(spark, *lines):
    return spark.createDataFrame(list(lines), CATALOG)


def shelf(spark, *lines):
    return spark.createDataFrame(list(lines), INVENTORY)


@pytest.mark.parametrize(
    "metric, expected",
    [
        ("qty", 5),
        ("amt", D("11.50")),
        ("profit", D("-0.25")),
        ("avg_qty_dy", D("0.714286")),
    ],
)
def test_weekly_metric(spark, calendar, metric, expected):
    sales = catalog(
        spark,
        (1, 7, SUN, 2, D("2.00"), D("0.50")),
        (2, 7, MON, 3, D("2.50"), D("-0.75")),
        (1, 7, None, 99, D("1.00"), D("1.00")),
        (1, 7, 5, 99, D("1.00"), D("1.00")),  # not in the calendar
    )
    assert rows(metrics.weekly_metric(sales, calendar, metric)) == [(7, 52, expected)]


def test_weekly_metric_needs_a_known_channel_and_metric(spark, calendar):
    with pytest.raises(ValueError):
        metrics.weekly_metric(calendar, calendar, "qty")
    with pytest.raises(ValueError):
        metrics.weekly_metric(catalog(spark), calendar, "volume")


def test_weekly_sums_of_nothing_but_nulls_are_null(spark, calendar):
    sales = catalog(spark, (1, 7, SUN, None, None, None))
    for metric in ("qty", "amt", "profit", "avg_qty_dy"):
        assert rows(metrics.weekly_metric(sales, calendar, metric)) == [(7, 52, None)]


def test_weeks_of_supply_pairs_each_channel_with_each_warehouse(spark, calendar):
    first = catalog(spark, (9, 7, SUN, 4, D("1"), D("1")), (9, 8, SUN, 4, D("1"), D("1")))
    second = spark.createDataFrame(
        [(9, 7, MON, 0, D("1"), D("1")), (9, 9, MON, None, D("1"), D("1"))], WEB
    )
    shelves = shelf(spark, (SUN, 7, 10, 1), (MON, 7, 2, 1), (SUN, 7, None, 2))
    result = metrics.weeks_of_supply(first, second, shelves, calendar)
    assert rows(result, "item_sk", "warehouse_sk", "wks_sply") == [
        (7, 1, D("0.000000")),
        (7, 1, D("3.000000")),
        (7, 2, D("0.000000")),
        (7, 2, None),
        (8, 0, None),
        (9, 0, D("0.000000")),
    ]


def test_low_stock_compares_the_higher_mean_with_the_fullest_warehouse(spark, calendar):
    first = catalog(
        spark,
        (9, 7, SUN, 4, D("1"), D("1")),
        (9, 7, MON, 7, D("1"), D("1")),
        (9, 8, SUN, 5, D("1"), D("1")),
    )
    second = spark.createDataFrame([(9, 7, MON, 1, D("1"), D("1"))], WEB)
    key = ["item_sk", "low_stock_flg_wk"]
    low = shelf(spark, (SUN, 7, 2, 1), (MON, 7, 3, 1), (SUN, 7, 1, 2))
    assert rows(metrics.low_stock_flag(first, second, low, calendar), *key) == [
        (7, "True"),  # mean 5.5 against 5
        (8, "False"),  # no stock row
    ]
    enough = shelf(spark, (SUN, 7, 6, 1))
    assert rows(metrics.low_stock_flag(first, second, enough, calendar), *key) == [
        (7, "False"),
        (8, "False"),
    ]


def test_customer_lifetime_value(spark):
    sales = web(
        spark,
        {"bill_customer_sk": 1, "net_paid": D("10.50"), "wholesale_cost": D("4.25")},
        {"bill_customer_sk": 1, "net_paid": D("1.00"), "wholesale_cost": D("5.00")},
        {"bill_customer_sk": 1, "net_paid": D("99.00")},
        {"bill_customer_sk": 2, "wholesale_cost": D("1.00")},
        {"bill_customer_sk": 3, "net_paid": D("1.00"), "wholesale_cost": D("1.00")},
        {"net_paid": D("1.00"), "wholesale_cost": D("1.00")},
    )
    known = spark.createDataFrame([(1,), (2,)], "c_customer_sk long")
    assert rows(metrics.customer_lifetime_value(known, sales)) == [(1, D("2.25"))]
    # As in a row-by-row join, a customer listed twice counts twice.
    twice = known.unionAll(known)
    assert rows(metrics.customer_lifetime_value(twice, sales)) == [(1, D("4.50"))]


def test_marketing_attribution_counts_an_order_once_per_name(spark):
    sales = web(
        spark,
        {"promo_sk": 1, "order_number": 100},
        {"promo_sk": 2, "order_number": 100},
        {"promo_sk": 2, "order_number": 101},
        {"promo_sk": 3, "order_number": 100},
        {"promo_sk": 3},
        {"promo_sk": 4, "order_number": 102},
        {"order_number": 103},
    )
    promotion = spark.createDataFrame(
        [(1, "A"), (2, "A"), (3, "B")], "p_promo_sk long, p_promo_name string"
    )
    assert rows(metrics.marketing_attribution(promotion, sales)) == [("A", 2), ("B", 1)]


def test_seasonal_totals(spark, calendar):
    sales = web(
        spark,
        {"sold_date_sk": SUN, "net_paid": D("1.10"), "sales_price": D("5.00"), "quantity": 9},
        {"sold_date_sk": MON, "net_paid": D("2.20"), "sales_price": D("6.00"), "quantity": 9},
        {"sold_date_sk": FEB, "net_paid": None, "sales_price": D("7.00")},
        {"net_paid": D("9.00"), "sales_price": D("9.00")},
    )
    assert [tuple(r) for r in metrics.seasonal_sales(sales, calendar).collect()] == [
        (1999, 12, D("3.30")),
        (2000, 2, None),
    ]
    assert [tuple(r) for r in metrics.sales_by_period(sales, calendar, "month").collect()] == [
        ("1999-12", D("11.00")),
        ("2000-02", D("7.00")),
    ]
    assert [tuple(r) for r in metrics.sales_by_period(sales, calendar, "quarter").collect()] == [
        ("1999 Q4", D("11.00")),
        ("2000 Q1", D("7.00")),
    ]
    with pytest.raises(ValueError):
        metrics.sales_by_period(sales, calendar, "decade")


def test_avg_shipping_time_weighs_lines_not_days(spark, calendar):
    sales = web(
        spark,
        {"sold_date_sk": SUN, "ship_date_sk": SUN + 1},
        {"sold_date_sk": SUN, "ship_date_sk": SUN + 2},
        {"sold_date_sk": MON, "ship_date_sk": MON + 5},
        {"sold_date_sk": MON},
    )
    assert rows(metrics.avg_shipping_time(sales, calendar)) == [(1999, 12, D("2.666667"))]


def _shipped(spark, sites=None, warehouses=(1,), **changes):
    line = {
        "warehouse_sk": 1,
        "ship_addr_sk": 5,
        "web_site_sk": 3,
        "ship_date_sk": FEB,
        "order_number": 77,
        "ship_mode_sk": 2,
        "sold_date_sk": SUN,
        **changes,
    }
    return metrics.shipping_time(
        web(spark, line),
        spark.createDataFrame([(w,) for w in warehouses], "w_warehouse_sk long"),
        spark.createDataFrame([(5,)], "ca_address_sk long"),
        spark.createDataFrame(
            sites or [(3, "Main St", "Town", "CA", "90001")],
            """web_site_sk long, web_street_name string, web_city string, web_state string,
               web_zip string""",
        ),
    )


def test_shipping_row(spark):
    assert rows(_shipped(spark)) == [(FEB, 77, FEB, FEB, "Air", "Main St Town, CA 90001")]


@pytest.mark.parametrize(
    "code, name", [(1, "Standard"), (3, "Truck"), (4, "Mail"), (0, "Other"), (9, "Other")]
)
def test_ship_modes(spark, code, name):
    assert rows(_shipped(spark, ship_mode_sk=code), "shipping_method") == [(name,)]


@pytest.mark.parametrize(
    "column",
    [
        "ship_date_sk",
        "order_number",
        "ship_mode_sk",
        "sold_date_sk",
        "warehouse_sk",
        "ship_addr_sk",
        "web_site_sk",
    ],
)
def test_shipments_missing_a_required_value_are_left_out(spark, column):
    assert rows(_shipped(spark, **{column: None})) == []


def test_address_with_a_missing_part_is_null(spark):
    result = _shipped(spark, sites=[(3, "Main St", "Town", None, "90001")])
    assert rows(result, "shipping_address") == [(None,)]


def test_repeated_warehouse_repeats_the_shipment(spark):
    assert _shipped(spark, warehouses=(1, 1)).count() == 2


def test_over_long_address_raises(spark):
    with pytest.raises(PySparkException, match="longer than 255"):
        _shipped(spark, sites=[(3, "x" * 300, "Town", "CA", "90001")]).collect()


def test_dates_far_from_1970_label_correctly(spark):
    one = spark.createDataFrame(
        [(day_key("2009-11-30"), dt.date(2009, 11, 30))], "d_date_sk long, cal_dt date"
    )
    sales = web(spark, {"sold_date_sk": day_key("2009-11-30"), "sales_price": D("1.00")})
    assert rows(metrics.sales_by_period(sales, one, "quarter"), "quarter") == [("2009 Q4",)]


@pytest.mark.parametrize(
    "above, below",
    [(20, 7), (1, 3), (2, 3), (5, 2_000_000), (0, 5), (5, 0), (-20, 7), (20, -7), (None, 3)]
    + [(3, None), (4 * 10**12, 3), (4 * 10**12 + 1, 3), (9 * 10**18, 7), (1, 9 * 10**18)],
)
def test_exact_ratio_equals_decimal_division(spark, above, below):
    df = spark.createDataFrame([(above, below)], "a long, b long")
    whole = "cast({} as decimal(38,0))"
    plain = F.expr(f"try_divide({whole.format('a')}, {whole.format('b')})")
    found, expected = df.select(exact_ratio(F.col("a"), F.col("b")), plain).first()
    assert found == expected
    kind = df.select(exact_ratio(F.col("a"), F.col("b"))).schema[0].dataType
    assert kind == T.DecimalType(38, 6)
