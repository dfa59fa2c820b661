"""Daily sales fact and weekly sales-and-inventory mart.

``date_dim`` must have one row per ``d_date_sk``; ``check_calendar`` verifies it. A (``wk_num``, ``yr_num``) may have no Sunday,
then its sales are left out of the mart, or several, then the first one is its key and its rows count once for each.
"""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfline.functions import LIMBS, Money, exact_ratio, money, together
from shelfline.operators.quality import require_unique
from shelfline.operators.refresh import as_mark, mark_of, rows_from, rows_kept
from shelfline.sources.schemas import DAILY_SALES, WEEKLY_SALES_INVENTORY, conform

DAILY_KEY = "sold_date_sk"
WEEKLY_KEY = "sold_wk_sk"
WEEK = ["sold_wk_num", "sold_yr_num"]
MART_KEY = ["warehouse_sk", "item_sk", *WEEK]
DAYS_IN_WEEK = 7

Watermark = Literal["weekly", "daily"]
Fanout = Literal["reference", "safe"]


def check_calendar(date_dim: DataFrame) -> DataFrame:
    """Return ``date_dim``, or raise when a date repeats."""
    return require_unique(date_dim, ["d_date_sk"], "date_dim")


def channel_lines(sales: DataFrame, prefix: str, way: Money) -> DataFrame:
    """Sale lines of one channel (``cs`` or ``ws``) under common names, money as it is summed."""
    return sales.select(
        F.col(f"{prefix}_warehouse_sk").alias("warehouse_sk"),
        F.col(f"{prefix}_item_sk").alias("item_sk"),
        F.col(f"{prefix}_sold_date_sk").alias("sold_date_sk"),
        F.col(f"{prefix}_quantity").alias("quantity"),
        (way.amount(sales, f"{prefix}_sales_price") * F.col(f"{prefix}_quantity")).alias("sales"),
        way.amount(sales, f"{prefix}_net_profit").alias("profit"),
    )


def daily_sales(
    catalog_sales: DataFrame,
    web_sales: DataFrame,
    date_dim: DataFrame,
    target: DataFrame | None = None,
    mark: Column | int | None = None,
) -> DataFrame:
    """Sales of both channels per (warehouse, item, day) with the day's week and year.

    With ``target`` the result is its whole new state: the last loaded day is
    rebuilt and later days are added. ``mark`` overrides the high-water mark read
    from ``target``.
    """
    if mark is None:
        mark = 0 if target is None else mark_of(target, DAILY_KEY)
    way = together(
        money(catalog_sales, "cs_sales_price", "cs_net_profit"),
        money(web_sales, "ws_sales_price", "ws_net_profit"),
    )
    # One filter above the union: Catalyst copies it into both scans.
    lines = channel_lines(catalog_sales, "cs", way).unionByName(
        channel_lines(web_sales, "ws", way)
    )
    lines = rows_from(lines, DAILY_KEY, mark).filter(
        F.col("quantity").isNotNull() & F.col("sales").isNotNull()
    )

    # Sum first, look the day up afterwards: the lookup then runs once per group.
    per_day = lines.groupBy("warehouse_sk", "item_sk", "sold_date_sk").agg(
        F.sum("quantity").alias("daily_qty"),
        *way.sums("sales", F.col("sales")),
        *way.sums("profit", F.col("profit")),
    )
    per_day = per_day.select(
        "warehouse_sk",
        "item_sk",
        "sold_date_sk",
        "daily_qty",
        way.double("sales").alias("daily_sales_amt"),
        way.double("profit").alias("daily_net_profit"),
    )
    calendar = date_dim.select(
        "d_date_sk",
        F.col("wk_num").alias("sold_wk_num"),
        F.col("yr_num").alias("sold_yr_num"),
    )
    dated = per_day.join(calendar, F.col("sold_date_sk") == F.col("d_date_sk"), "left")
    fresh = conform(dated, DAILY_SALES)
    if target is None:
        return fresh
    return rows_kept(target, DAILY_KEY, mark).unionByName(fresh)


def _sundays(date_dim: DataFrame) -> DataFrame:
    """The Sundays of each (week, year): none, one, or several where a calendar year's last days share a number with its first."""
    return date_dim.filter("day_of_wk_num = 0").select(
        F.col("wk_num").alias("sold_wk_num"),
        F.col("yr_num").alias("sold_yr_num"),
        F.col("d_date_sk").alias("sunday_sk"),
    )


def first_day_to_read(date_dim: DataFrame, mark: Column | int) -> DataFrame:
    """One row, ``first_day``: the earliest day of any week that reaches ``mark``.

    A week group whose first sale is at or after the mark has no sale before this
    day, so older daily rows need not be read at all.
    """
    weeks = date_dim.groupBy("wk_num", "yr_num").agg(
        F.min("d_date_sk").alias("first_sk"), F.max("d_date_sk").alias("last_sk")
    )
    return weeks.filter(F.col("last_sk") >= as_mark(mark)).agg(
        F.coalesce(F.min("first_sk"), as_mark(mark)).alias("first_day")
    )


def _sales_by_week(daily: DataFrame) -> DataFrame:
    """Daily rows as addends of the mart."""
    return daily.select(
        *MART_KEY,
        F.col("sold_date_sk").alias("first_sold_sk"),
        F.col("daily_qty").alias("qty"),
        *LIMBS.parts(LIMBS.amount(daily, "daily_sales_amt"), "amt"),
        *LIMBS.parts(LIMBS.amount(daily, "daily_net_profit"), "profit"),
        F.lit(None).cast("bigint").alias("stock"),
    )


def _stock_by_week(inventory: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Stock rows as addends of the mart. A row without its full key belongs to no week."""
    calendar = date_dim.select(
        F.col("d_date_sk").alias("inv_date_sk"),
        F.col("wk_num").alias("sold_wk_num"),
        F.col("yr_num").alias("sold_yr_num"),
    )
    nothing = F.lit(None).cast("bigint")
    return (
        inventory.join(calendar, "inv_date_sk")
        .withColumnsRenamed({"inv_warehouse_sk": "warehouse_sk", "inv_item_sk": "item_sk"})
        .dropna(subset=MART_KEY)
        .select(
            *MART_KEY,
            *[nothing.alias(c) for c in ("first_sold_sk", "qty")],
            *LIMBS.nothing("amt"),
            *LIMBS.nothing("profit"),
            F.coalesce("inv_quantity_on_hand", F.lit(0)).alias("stock"),
        )
    )


def _sold_sums() -> list[Column]:
    return [
        F.min("first_sold_sk").alias("first_sold_sk"),
        F.sum("qty").alias("qty"),
        *LIMBS.sums("amt"),
        *LIMBS.sums("profit"),
        F.count("first_sold_sk").alias("daily_rows"),
    ]


def _stock_sums() -> list[Column]:
    return [F.sum("stock").alias("stock"), F.count("stock").alias("stock_rows")]


def sales_sums(daily: DataFrame) -> DataFrame:
    """Sales of each week, item and warehouse as sums that can be stored: one half of ``weekly_sums``."""
    return _sales_by_week(daily).groupBy(*MART_KEY).agg(*_sold_sums())


def stock_sums(inventory: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Stock of each week, item and warehouse: the other half."""
    return _stock_by_week(inventory, date_dim).groupBy(*MART_KEY).agg(*_stock_sums())


def weekly_sums(sold: DataFrame, stock: DataFrame) -> DataFrame:
    """``sales_sums`` with the ``stock_sums`` of their group. Stored in as many buckets by ``MART_KEY``, neither side moves."""
    met = sold.join(stock, MART_KEY, "left")
    return met.withColumn("stock_rows", F.coalesce("stock_rows", F.lit(0).cast("bigint")))


def weekly_from_sums(
    per_week: DataFrame,
    date_dim: DataFrame,
    fanout: Fanout = "reference",
    mark: Column | int = 0,
    dropped: Observation | None = None,
) -> DataFrame:
    """The mart's rows from the sums of each week, item and warehouse; the arguments are those of ``weekly_sales_inventory``."""
    per_week = per_week.filter(F.col("first_sold_sk") >= as_mark(mark))
    if dropped is None:
        joined = per_week.join(_sundays(date_dim), WEEK)
    else:
        lost = F.col("sunday_sk").isNull()
        joined = (
            per_week.join(_sundays(date_dim), WEEK, "left")
            .observe(
                dropped,
                F.coalesce(F.sum(F.when(lost, F.col("daily_rows"))), F.lit(0)).alias("daily_rows"),
                F.coalesce(F.sum(F.when(lost, F.col("qty"))), F.lit(0)).alias("daily_qty"),
            )
            .filter(~lost)
        )

    # One row a group, with its first Sunday and their number. The groups stay where they are: no shuffle.
    joined = joined.groupBy(*MART_KEY).agg(
        F.min("sunday_sk").alias("sunday_sk"),
        F.count("*").alias("sundays"),
        *[
            F.any_value(c).alias(c)
            for c in ("qty", "stock", "stock_rows", *LIMBS.names("amt"), *LIMBS.names("profit"))
        ],
    )

    # A row joined to several Sundays, or to several stock rows, counts that often.
    copies, sundays = F.lit(1), F.lit(1)
    if fanout == "reference":
        copies = F.greatest(F.col("stock_rows"), F.lit(1)) * F.col("sundays")
        sundays = F.col("sundays")
    measured = joined.select(
        "warehouse_sk",
        "item_sk",
        F.col("sunday_sk").alias(WEEKLY_KEY),
        *WEEK,
        (F.col("qty") * copies).alias("sum_qty_wk"),
        *LIMBS.scaled("amt", copies),
        *LIMBS.scaled("profit", copies),
        (F.coalesce("stock", F.lit(0)) * sundays).alias("inv_qty_wk"),
    ).filter("sum_qty_wk > 0")
    measured = measured.withColumns(
        {"sum_amt_wk": LIMBS.double("amt"), "sum_profit_wk": LIMBS.double("profit")}
    )
    sold, stocked = F.col("sum_qty_wk"), F.col("inv_qty_wk")
    return conform(
        measured.withColumns(
            {
                "avg_qty_dy": exact_ratio(sold, DAYS_IN_WEEK),
                "wks_sply": exact_ratio(stocked, sold),
                # The daily average is positive here; it exceeds the stock when this does.
                "low_stock_flg_wk": sold > stocked * DAYS_IN_WEEK,
            }
        ),
        WEEKLY_SALES_INVENTORY,
    )


def weekly_sales_inventory(
    daily: DataFrame,
    inventory: DataFrame,
    date_dim: DataFrame,
    target: DataFrame | None = None,
    watermark: Watermark = "weekly",
    fanout: Fanout = "reference",
    mark: Column | int | None = None,
    first_day: Column | int | None = None,
    dropped: Observation | None = None,
) -> DataFrame:
    """Weekly sales joined to the week's stock, with supply ratio and low-stock flag.

    ``fanout='reference'`` counts a week's sales once per stock row of the week,
    which is what joining the two tables row by row gives; here the sales are
    multiplied by the number of stock rows instead, and the repeated rows never
    exist. ``fanout='safe'`` counts sales once.

    Sales and stock meet on the very key both are summed by, so their left join is
    one sum over their union: one shuffle, no sort, and no key can be hot. A sale
    without a warehouse finds no stock, since stock rows have full keys.

    Groups whose first sale lies before the mark are left out, as are weeks that
    have no Sunday in ``date_dim``.

    With ``target`` the result is its whole new state. ``watermark`` says whose
    greatest key is the mark: that of the mart (``weekly``) or that of the daily
    fact (``daily``, which adds only groups first sold on the last loaded day).

    ``dropped`` counts, while the result is computed, the ``daily_rows`` and ``daily_qty`` of groups
    whose week has no Sunday.
    """
    if mark is None:
        if target is None:
            mark = 0
        elif watermark == "weekly":
            mark = mark_of(target, WEEKLY_KEY)
        elif watermark == "daily":
            mark = mark_of(daily, DAILY_KEY)
        else:
            raise ValueError(f"unknown watermark {watermark!r}")
    if first_day is None and target is not None:
        first_day = first_day_to_read(date_dim, mark).scalar()
    if fanout not in ("reference", "safe"):
        raise ValueError(f"unknown fanout {fanout!r}")

    if first_day is not None:
        daily = daily.filter(F.col(DAILY_KEY) >= as_mark(first_day))
        inventory = inventory.filter(F.col("inv_date_sk") >= as_mark(first_day))
    per_week = (
        _sales_by_week(daily)
        .unionByName(_stock_by_week(inventory, date_dim))
        .groupBy(*MART_KEY)
        .agg(*_sold_sums(), *_stock_sums())
    )
    fresh = weekly_from_sums(per_week, date_dim, fanout, mark, dropped)
    if target is None:
        return fresh
    return rows_kept(target, WEEKLY_KEY, mark).unionByName(fresh)


def weeks_without_sunday(daily: DataFrame, date_dim: DataFrame) -> DataFrame:
    """One row: daily rows and quantity that the weekly mart drops for want of a Sunday."""
    # Reduce to weeks before looking for the Sunday; a null week never finds one.
    per_week = daily.groupBy(*WEEK).agg(
        F.count("*").alias("row_count"), F.sum("daily_qty").alias("qty")
    )
    return per_week.join(_sundays(date_dim), WEEK, "left_anti").agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("daily_rows"),
        F.coalesce(F.sum("qty"), F.lit(0)).alias("daily_qty"),
    )
