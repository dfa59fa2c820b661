"""Metrics from stored states equal those from all sales, and a run reads only the days that can have changed."""

import random

import pytest
from pyspark.sql import functions as F

from shelfline.operators import distinct_counts, distinct_state, merged_states
from shelfline.plans import kept, metrics
from shelfline.sources.tables import TableStore, written
from tests.conftest import day_key, rows

WEB = """ws_sold_date_sk long, ws_ship_date_sk long, ws_bill_customer_sk long, ws_promo_sk long,
    ws_order_number long, ws_sales_price {money}, ws_net_paid {money}, ws_wholesale_cost {money}"""
FIRST = day_key("1999-12-20")


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def sales_of(spark, money, n=400, seed=1):
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        day = FIRST + rng.randrange(45)
        amounts = [rng.choice([None, round(rng.uniform(-99, 99), 2)]) for _ in range(3)]
        data.append((day, rng.choice([None, day + 3, day + 9]), rng.choice([None, 1, 2, 3]), rng.randrange(5), rng.randrange(60) * 1000, *amounts))
    df = spark.createDataFrame(data, WEB.format(money="double"))
    kinds = [F.col(c).cast(money).alias(c) if c.endswith(("price", "paid", "cost")) else c for c in df.columns]
    return written(df.select(*kinds))


@pytest.mark.parametrize("money", ["decimal(9,2)", "double"])
def test_three_increments_equal_all_sales(spark, calendar, store, money):
    sales = sales_of(spark, money)
    raw = {
        "web_sales": sales,
        "date_dim": calendar,
        "customer": spark.createDataFrame([(1,), (2,), (2,)], "c_customer_sk long"),
        "promotion": spark.createDataFrame([(k, f"p{k % 2}") for k in range(4)], "p_promo_sk long, p_promo_name string"),
    }
    for cut in (FIRST + 10, FIRST + 33, FIRST + 99):
        kept.refresh_states(store, sales.filter(F.col("ws_sold_date_sk") <= cut))
    found = kept.kept_metrics(store, raw)
    whole = {
        "customer_lifetime_value": metrics.customer_lifetime_value(raw["customer"], sales),
        "marketing_attribution": metrics.marketing_attribution(raw["promotion"], sales),
        "seasonal_sales": metrics.seasonal_sales(sales, calendar),
        "seasonal_sales_monthly": metrics.sales_by_period(sales, calendar, "month"),
        "seasonal_sales_quarterly": metrics.sales_by_period(sales, calendar, "quarter"),
        "avg_shipping_time": metrics.avg_shipping_time(sales, calendar),
    }
    assert set(found) == set(whole)
    for name, df in whole.items():
        assert found[name].columns == df.columns and rows(found[name]) == rows(df), name


def test_a_run_reads_only_the_last_span_and_later_ones(spark, store, tmp_path):
    sales = sales_of(spark, "double")
    kept.refresh_states(store, sales)
    span = store.last_key(kept.DAYS, "span")
    days = store.read(kept.DAYS)
    assert 1 < days.select("span").distinct().count() and days.agg(F.max("span")).first()[0] == span
    # Rows below the last span that would stop the run if they were read.
    trap = F.when(F.col("ws_sold_date_sk") < span * kept.SPAN_DAYS, F.raise_error(F.lit("read an old day")).cast("double"))
    trapped = sales.withColumn("ws_net_paid", F.coalesce(trap, F.col("ws_net_paid")))
    before = rows(days)
    kept.refresh_states(store, trapped)
    assert rows(store.read(kept.DAYS)) == before
    changed = sales.filter(F.col("ws_sold_date_sk") >= span * kept.SPAN_DAYS)
    assert "GreaterThanOrEqual(ws_sold_date_sk" in changed._jdf.queryExecution().executedPlan().toString()


def test_distinct_counts_merge_with_repeats_negatives_and_nulls(spark):
    rng = random.Random(3)
    data = [(rng.choice("ab"), rng.choice([None, rng.randrange(-40_000, 140_000), 7])) for _ in range(900)]
    parts = [spark.createDataFrame(data[k : k + 400], "g string, n long") for k in (0, 300, 500)]
    state = None
    for part in parts:
        new = distinct_state(part, ["g"], "n")
        state = new if state is None else merged_states(state.unionByName(new), ["g"])
    whole = spark.createDataFrame(data, "g string, n long").groupBy("g").agg(F.count_distinct("n").alias("found"))
    assert rows(distinct_counts(state, ["g"], "found")) == rows(whole)


def test_states_of_scattered_numbers_stay_small(spark):
    """Numbers far apart, as those of a day are: the rows of a state are no larger than what they count."""
    df = spark.range(2000).selectExpr("id % 5 as g", "id * 40009 - 1000000 as n")
    state = distinct_state(df, ["g"], "n")
    assert state.count() == 2000 and all(f.dataType.typeName() == "long" for f in state.schema)
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert rows(distinct_counts(state, ["g"], "found")) == [(k, 400) for k in range(5)]


def test_no_sales(spark, calendar, store):
    sales = sales_of(spark, "double").limit(0)
    kept.refresh_states(store, sales)
    raw = {"web_sales": sales, "date_dim": calendar, "customer": spark.createDataFrame([], "c_customer_sk long"), "promotion": spark.createDataFrame([], "p_promo_sk long, p_promo_name string")}
    assert all(df.count() == 0 for df in kept.kept_metrics(store, raw).values())
