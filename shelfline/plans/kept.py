"""Metric tables that are kept up to date from stored partial states.

A state table has sums, counts and words of bits of the web sales by span of days and is partitioned by the span. A run recomputes
the last stored span and the ones after it, from the sales of these days alone, and replaces these partitions; the metric
tables are finished from the states, which have a row for each day, or for each customer or promotion and span, not for each
sale. As everywhere here, sales older than the last stored span are not read again.

Money is kept as it is summed, whole units or limbs, so a metric from states equals the metric from all sales to the last bit.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions import exact_ratio, money, month_label, quarter_label
from shelfline.operators.bitmaps import BITS, WORD, distinct_counts, distinct_state
from shelfline.sources.tables import TableStore

#: Days of a span.
SPAN_DAYS = 32
DAYS, CUSTOMERS, PROMOTIONS = (f"intermediate/web_{name}" for name in ("days", "customer_values", "promotion_order_words"))
_SPAN = "span"


def _span() -> Column:
    return F.call_function("div", F.col("ws_sold_date_sk"), F.lit(SPAN_DAYS)).cast("bigint").alias(_SPAN)


def day_states(web_sales: DataFrame) -> DataFrame:
    """One row a sold day: sums of unit prices, of net paid and of days to shipment, and how many lines have such days."""
    price, paid = money(web_sales, "ws_sales_price"), money(web_sales, "ws_net_paid")
    days = F.col("ws_ship_date_sk") - F.col("ws_sold_date_sk")
    return web_sales.groupBy(_span(), "ws_sold_date_sk").agg(
        *price.sums("price", price.amount(web_sales, "ws_sales_price")),
        *paid.sums("paid", paid.amount(web_sales, "ws_net_paid")),
        F.sum(days).alias("ship_days"),
        F.count(days).alias("ship_lines"),
    )


def customer_states(web_sales: DataFrame) -> DataFrame:
    """One row a billed customer and span: net paid and wholesale cost of the lines that have both."""
    paid, cost = "ws_net_paid", "ws_wholesale_cost"
    way = money(web_sales, paid, cost)
    both = F.col("ws_bill_customer_sk").isNotNull() & F.col(paid).isNotNull() & F.col(cost).isNotNull()
    return (
        web_sales.filter(both)
        .groupBy(_span(), F.col("ws_bill_customer_sk").alias("customer_id"))
        .agg(*way.sums("paid", way.amount(web_sales, paid)), *way.sums("cost", way.amount(web_sales, cost)))
    )


def promotion_states(web_sales: DataFrame) -> DataFrame:
    """One word of order numbers seen for each promotion, span and range of 64 numbers."""
    sales = web_sales.select(_span(), F.col("ws_promo_sk").alias("p_promo_sk"), "ws_order_number")
    return distinct_state(sales, [_SPAN, "p_promo_sk"], "ws_order_number").select(_SPAN, "p_promo_sk", WORD, BITS)


_STATES = {DAYS: day_states, CUSTOMERS: customer_states, PROMOTIONS: promotion_states}


def refresh_states(store: TableStore, web_sales: DataFrame) -> None:
    """Bring all state tables up to date. A sale without a day is in none of them."""
    for table, build in _STATES.items():
        from_span = store.last_key(table, _SPAN)
        # A plain comparison, so that the scan of the sales skips what is older.
        changed = web_sales.filter(F.col("ws_sold_date_sk") >= from_span * SPAN_DAYS)
        store.refresh_partitions(table, build(changed), _SPAN, from_span)


def kept_metrics(
    store: TableStore, raw: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """The metric tables, by name, finished from the stored states.

    They equal the functions of the same names in ``metrics`` over all sales that have a day. ``raw`` holds the sales for
    their types only, and the small tables.
    """
    sales, date_dim = raw["web_sales"], raw["date_dim"]
    calendar = date_dim.select(F.col("d_date_sk").alias("ws_sold_date_sk"), "cal_dt")
    by_day = store.read(DAYS).join(calendar, "ws_sold_date_sk")
    year, month = F.year("cal_dt").cast("bigint").alias("year"), F.month("cal_dt").cast("bigint").alias("month")
    paid, price = money(sales, "ws_net_paid"), money(sales, "ws_sales_price")

    def by_label(name: str, label: Column) -> DataFrame:
        summed = by_day.groupBy(label.alias(name)).agg(*price.sums("price"))
        return summed.select(name, price.decimal("price").alias("total_sales")).orderBy(name)

    seasons = by_day.groupBy(year, month).agg(*paid.sums("paid"))
    shipping = by_day.groupBy(year, month).agg(
        exact_ratio(F.sum("ship_days"), F.sum("ship_lines")).alias("avg_shipping_time")
    )

    way = money(sales, "ws_net_paid", "ws_wholesale_cost")
    per_customer = store.read(CUSTOMERS).groupBy("customer_id").agg(*way.sums("paid"), *way.sums("cost"))
    known = raw["customer"].groupBy(F.col("c_customer_sk").alias("customer_id")).agg(F.count("*").alias("times"))
    value = per_customer.select("customer_id", *way.minus("paid", "cost")).join(known, "customer_id")
    value = value.select("customer_id", *way.scaled("paid", F.col("times")))

    names = raw["promotion"].select("p_promo_sk", "p_promo_name")
    orders = store.read(PROMOTIONS).join(names, "p_promo_sk")
    return {
        "customer_lifetime_value": value.select("customer_id", way.decimal("paid").alias("customer_lifetime_value")),
        "marketing_attribution": distinct_counts(orders, ["p_promo_name"], "attributed_sales"),
        "seasonal_sales": seasons.select("year", "month", paid.decimal("paid").alias("total_sales")).orderBy("year", "month"),
        "seasonal_sales_monthly": by_label("month", month_label(F.col("cal_dt"))),
        "seasonal_sales_quarterly": by_label("quarter", quarter_label(F.col("cal_dt"))),
        "avg_shipping_time": shipping.orderBy("year", "month"),
    }
