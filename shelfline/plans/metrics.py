"""Business-metric queries."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import (
    Money,
    exact_ratio,
    money,
    month_label,
    quarter_label,
    ship_method,
)
from shelfline.sources.schemas import SHIPPING_TIME, conform

Metric = Literal["qty", "amt", "profit", "avg_qty_dy"]
Period = Literal["month", "quarter"]


def channel_of(sales: DataFrame) -> str:
    """``cs`` or ``ws``: the column prefix of a sales table."""
    for prefix in ("cs", "ws"):
        if f"{prefix}_sold_date_sk" in sales.columns:
            return prefix
    raise ValueError("neither a catalog nor a web sales table")


def _with_week(df: DataFrame, date_key: str, date_dim: DataFrame) -> DataFrame:
    calendar = date_dim.select(F.col("d_date_sk").alias(date_key), F.col("wk_num").alias("week_num"))
    return df.join(calendar, date_key)


def weekly_metric(sales: DataFrame, date_dim: DataFrame, metric: Metric) -> DataFrame:
    """One measure per (item, week number) of one channel. Years are not told apart."""
    prefix = channel_of(sales)
    quantity = F.col(f"{prefix}_quantity")
    per_week = _with_week(sales, f"{prefix}_sold_date_sk", date_dim).groupBy(
        F.col(f"{prefix}_item_sk").alias("item_sk"), "week_num"
    )
    if metric == "qty":
        return per_week.agg(F.sum(quantity).alias("sum_qty_wk"))
    if metric == "avg_qty_dy":
        return per_week.agg(exact_ratio(F.sum(quantity), 7).alias("avg_qty_dy"))
    if metric == "amt":
        name, source, times = "sum_amt_wk", f"{prefix}_sales_price", quantity
    elif metric == "profit":
        name, source, times = "sum_profit_wk", f"{prefix}_net_profit", F.lit(1)
    else:
        raise ValueError(f"unknown metric {metric!r}")
    way = money(sales, source)
    summed = per_week.agg(*way.sums("total", way.amount(sales, source) * times))
    return summed.select("item_sk", "week_num", way.decimal("total").alias(name))


def weekly_inventory(inventory: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Stock on hand per (item, warehouse, week number)."""
    return (
        _with_week(inventory, "inv_date_sk", date_dim)
        .groupBy(
            F.col("inv_item_sk").alias("item_sk"),
            F.col("inv_warehouse_sk").alias("warehouse_sk"),
            "week_num",
        )
        .agg(F.sum("inv_quantity_on_hand").alias("inv_on_hand_qty_wk"))
    )


def weeks_of_supply(
    catalog_sales: DataFrame, web_sales: DataFrame, inventory: DataFrame, date_dim: DataFrame
) -> DataFrame:
    """Stock over sales per (item, week, warehouse), one row for each channel that sold.

    The warehouse is 0 and the ratio null where the week has no stock row; the
    ratio is 0 where the sold quantity is zero or unknown.
    """
    sales = weekly_metric(catalog_sales, date_dim, "qty").unionByName(
        weekly_metric(web_sales, date_dim, "qty")
    )
    stock = weekly_inventory(inventory, date_dim)
    sold = F.col("sum_qty_wk")
    return sales.join(stock, ["item_sk", "week_num"], "left").select(
        "week_num",
        "item_sk",
        F.coalesce("warehouse_sk", F.lit(0)).alias("warehouse_sk"),
        F.when(sold != 0, exact_ratio(F.col("inv_on_hand_qty_wk"), sold))
        .otherwise(F.lit(0))
        .alias("wks_sply"),
    )


def _mean_quantity(sales: DataFrame, date_dim: DataFrame) -> DataFrame:
    prefix = channel_of(sales)
    quantity = F.col(f"{prefix}_quantity")
    return (
        _with_week(sales, f"{prefix}_sold_date_sk", date_dim)
        .groupBy(F.col(f"{prefix}_item_sk").alias("item_sk"), "week_num")
        .agg(exact_ratio(F.sum(quantity), F.count(quantity)).alias("avg_qty"))
    )


def low_stock_flag(
    catalog_sales: DataFrame, web_sales: DataFrame, inventory: DataFrame, date_dim: DataFrame
) -> DataFrame:
    """'True' per (item, week) where the mean sold quantity exceeds every warehouse's stock.

    The mean is per sale line, the higher of the two channels. Only the greatest
    stock matters, so stock is reduced to it before the join and no row fans out.
    """
    key = ["item_sk", "week_num"]
    best = (
        _mean_quantity(catalog_sales, date_dim)
        .unionByName(_mean_quantity(web_sales, date_dim))
        .groupBy(*key)
        .agg(F.max("avg_qty").alias("avg_qty"))
    )
    most = (
        weekly_inventory(inventory, date_dim)
        .groupBy(*key)
        .agg(F.max("inv_on_hand_qty_wk").alias("stock"))
    )
    low = (F.col("avg_qty") > 0) & (F.col("avg_qty") > F.col("stock"))
    return best.join(most, key, "left").select(
        *key, F.when(low, "True").otherwise("False").alias("low_stock_flg_wk")
    )


def customer_lifetime_value(customer: DataFrame, web_sales: DataFrame) -> DataFrame:
    """Net paid minus wholesale cost per known customer, over lines that have both.

    Lines are summed per billed customer before meeting the customer table, so a
    customer holding much of the sales costs no more to shuffle than any other.
    """
    paid, cost = "ws_net_paid", "ws_wholesale_cost"
    way = money(web_sales, paid, cost)
    per_customer = (
        web_sales.filter(
            F.col("ws_bill_customer_sk").isNotNull()
            & F.col(paid).isNotNull()
            & F.col(cost).isNotNull()
        )
        .groupBy(F.col("ws_bill_customer_sk").alias("customer_id"))
        .agg(
            *way.sums("paid", way.amount(web_sales, paid)),
            *way.sums("cost", way.amount(web_sales, cost)),
        )
        .select("customer_id", *way.minus("paid", "cost"))
    )
    # A key listed twice would match its lines twice.
    known = customer.groupBy(F.col("c_customer_sk").alias("customer_id")).agg(
        F.count("*").alias("times")
    )
    value = per_customer.join(known, "customer_id").select(
        "customer_id", *way.scaled("paid", F.col("times"))
    )
    return value.select("customer_id", way.decimal("paid").alias("customer_lifetime_value"))


def marketing_attribution(promotion: DataFrame, web_sales: DataFrame) -> DataFrame:
    """Distinct orders per promotion name."""
    promoted = web_sales.select(
        F.col("ws_promo_sk").alias("p_promo_sk"), "ws_order_number"
    ).join(promotion.select("p_promo_sk", "p_promo_name"), "p_promo_sk")
    return promoted.groupBy("p_promo_name").agg(
        F.count_distinct("ws_order_number").alias("attributed_sales")
    )


def _on_sold_day(per_day: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Attach calendar dates to sums already taken per sold day."""
    calendar = date_dim.select(F.col("d_date_sk").alias("ws_sold_date_sk"), "cal_dt")
    return per_day.join(calendar, "ws_sold_date_sk")


def _year() -> Column:
    return F.year("cal_dt").cast("bigint").alias("year")


def _month() -> Column:
    return F.month("cal_dt").cast("bigint").alias("month")


def _per_day(web_sales: DataFrame, column: str, way: Money) -> DataFrame:
    return web_sales.groupBy("ws_sold_date_sk").agg(
        *way.sums("day", way.amount(web_sales, column))
    )


def seasonal_sales(web_sales: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Net paid per calendar year and month."""
    way = money(web_sales, "ws_net_paid")
    return (
        _on_sold_day(_per_day(web_sales, "ws_net_paid", way), date_dim)
        .groupBy(_year(), _month())
        .agg(*way.sums("day"))
        .select("year", "month", way.decimal("day").alias("total_sales"))
        .orderBy("year", "month")
    )


def prices_by_day(web_sales: DataFrame) -> DataFrame:
    """Unit sales prices summed per sold day: one small row for every day.

    A stand-in for the sales table in ``sales_by_period``, which reads the same
    two columns; store it once when several periods are wanted.
    """
    way = money(web_sales, "ws_sales_price")
    return _per_day(web_sales, "ws_sales_price", way).select(
        "ws_sold_date_sk", way.decimal("day").alias("ws_sales_price")
    )


def sales_by_period(web_sales: DataFrame, date_dim: DataFrame, period: Period) -> DataFrame:
    """Unit sales prices summed per 'YYYY-MM' month or 'YYYY Qn' quarter."""
    if period not in ("month", "quarter"):
        raise ValueError(f"unknown period {period!r}")
    label = month_label if period == "month" else quarter_label
    way = money(web_sales, "ws_sales_price")
    return (
        _on_sold_day(_per_day(web_sales, "ws_sales_price", way), date_dim)
        .groupBy(label(F.col("cal_dt")).alias(period))
        .agg(*way.sums("day"))
        .select(period, way.decimal("day").alias("total_sales"))
        .orderBy(period)
    )


def avg_shipping_time(web_sales: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Mean days from sale to shipment per calendar year and month of sale."""
    days = F.col("ws_ship_date_sk") - F.col("ws_sold_date_sk")
    per_day = web_sales.groupBy("ws_sold_date_sk").agg(
        F.sum(days).alias("days"), F.count(days).alias("lines")
    )
    return (
        _on_sold_day(per_day, date_dim)
        .groupBy(_year(), _month())
        .agg(exact_ratio(F.sum("days"), F.sum("lines")).alias("avg_shipping_time"))
        .orderBy("year", "month")
    )


def shipping_time(
    web_sales: DataFrame, warehouse: DataFrame, customer_address: DataFrame, web_site: DataFrame
) -> DataFrame:
    """Shipment rows: ship mode by name and the web site's address in one line.

    Warehouse and customer address only have to exist, so just their keys are
    read; they stay inner joins because a repeated key repeats the shipment. The
    small tables come first, the possibly large address table last.
    """
    shipped = web_sales.filter(
        F.col("ws_ship_date_sk").isNotNull()
        & F.col("ws_order_number").isNotNull()
        & F.col("ws_ship_mode_sk").isNotNull()
        & F.col("ws_sold_date_sk").isNotNull()
    )
    address = F.concat(
        "web_street_name", F.lit(" "), "web_city", F.lit(", "), "web_state", F.lit(" "), "web_zip"
    )
    sites = web_site.select(F.col("web_site_sk"), address.alias("shipping_address"))
    rows = (
        shipped.join(
            warehouse.select(F.col("w_warehouse_sk").alias("ws_warehouse_sk")), "ws_warehouse_sk"
        )
        .join(sites, F.col("ws_web_site_sk") == F.col("web_site_sk"))
        .join(
            customer_address.select(F.col("ca_address_sk").alias("ws_ship_addr_sk")),
            "ws_ship_addr_sk",
        )
        .select(
            F.col("ws_ship_date_sk").alias("shipment_id"),
            F.col("ws_order_number").alias("order_id"),
            F.col("ws_ship_date_sk").alias("shipping_date"),
            F.col("ws_ship_date_sk").alias("delivery_date"),
            ship_method(F.col("ws_ship_mode_sk")).alias("shipping_method"),
            "shipping_address",
        )
    )
    return conform(rows, SHIPPING_TIME)
