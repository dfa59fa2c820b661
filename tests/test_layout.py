"""Stored layouts: buckets that are met without shuffles, rows clustered along two keys, pruning at run time."""

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfline.functions import clustering
from shelfline.operators.history import scd2_merge, scd2_merge_in_place
from shelfline.plans import facts, pipeline
from shelfline.sources.sample_retail import SampleRetail
from shelfline.sources.tables import TableStore, buckets_for, written
from tests.conftest import SAMPLE, rows
from tests.test_plans import _rows_scanned, conf, plan_of, shuffles  # noqa: F401


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


# Rows along two keys.


def _z(a: int, b: int, bits: int) -> int:
    return sum(((a >> k & 1) << 2 * k + 1) + ((b >> k & 1) << 2 * k) for k in range(bits))


def test_interleaved_places_equal_brute_force(spark):
    rng = random.Random(5)
    data = [(rng.choice([None, *range(50)]), rng.choice([7] * 30 + [None, *range(-20, 20)])) for _ in range(400)]
    df = spark.createDataFrame(data, "a long, b long")
    cuts = clustering.edges(df, ["a", "b"], 3)
    assert all(v == sorted(set(v)) and len(v) <= 7 for v in cuts.values())

    def at(name, value):
        return 0 if value is None else bisect.bisect_right(cuts[name], value)

    want = sorted((_z(at("a", a), at("b", b), 3) for a, b in data))
    assert sorted(r[0] for r in df.select(clustering.interleaved(cuts, 3)).collect()) == want


def test_order_of_nothing_and_of_one_value(spark):
    nothing = spark.createDataFrame([], "a long, b long")
    cuts = clustering.edges(nothing, ["a", "b"])
    assert cuts == {"a": [], "b": []}
    one = spark.createDataFrame([(1, None), (1, None)], "a long, b long")
    assert len({r[0] for r in one.select(clustering.interleaved(cuts)).collect()}) == 1
    same = clustering.edges(one, ["a", "b"])
    assert same == {"a": [1], "b": []}
    with pytest.raises(ValueError, match="62 bits"):
        clustering.interleaved({c: [1] for c in "abc"}, 30)


@pytest.mark.parametrize("column", ["item_sk", "warehouse_sk"])
def test_a_filter_on_either_key_skips_three_quarters_of_a_partition(spark, store, column):
    """A third of the rows are of one item; row groups of one partition's file are skipped by their extremes."""
    item = F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 977)
    week = spark.range(200_000).select(
        F.lit(7).cast("long").alias("k"), item.alias("item_sk"), F.expr("(id div 3) * 7919 % 1009").alias("warehouse_sk"), "id"
    )
    keys = clustering.interleaved(clustering.edges(week, ["item_sk", "warehouse_sk"]))
    store.refresh_partitions("raw/z", week, "k", 0, (keys, "item_sk", "warehouse_sk"), row_group=64 * 1024)
    stored = store.read("raw/z")
    assert stored.count() == 200_000
    found = stored.filter(F.col(column) == 123)
    assert found.count() == week.filter(F.col(column) == 123).count() > 0
    found.collect()
    assert 0 < _rows_scanned(found._jdf.queryExecution().executedPlan()) <= 200_000 / 4


def test_a_partition_is_sorted_by_columns_not_by_expressions(spark, store):
    """An expression in a sort is worked out for every comparison of two rows: the longer the partition, the more of them."""
    week = spark.range(3000).selectExpr("id % 3 as k", "id % 97 as item_sk", "id % 11 as warehouse_sk")
    keys = clustering.interleaved(clustering.edges(week, ["item_sk", "warehouse_sk"]))
    store.refresh_partitions("raw/z", week, "k", 0, (keys, "item_sk"))
    done = spark._jsparkSession.sharedState().statusStore().executionsList()
    plan = done.apply(done.size() - 1).physicalPlanDescription()
    sorts = [d.split("\n\n")[0] for d in plan.split("\n(") if " Sort" in d.split("\n")[0]]
    assert sorts and not any("lambda" in s for s in sorts)
    stored = store.read("raw/z")
    assert stored.columns == week.columns and rows(stored) == rows(week)


# Buckets.


def test_buckets_grow_with_the_files_read(spark, tmp_path):
    for name, n in (("one", 1), ("four", 4)):
        spark.range(0, 200_000 * n, 1, n).write.parquet(str(tmp_path / name))
    one, four = (spark.read.parquet(str(tmp_path / name)) for name in ("one", "four"))
    size = sum(f.stat().st_size for f in (tmp_path / "one").glob("*.parquet"))
    assert buckets_for(one) == 8 and buckets_for(one, each=size, least=1) == 1
    assert 3 <= buckets_for(four, each=size, least=1) <= 5
    assert buckets_for(one, four, four.filter("id > 5"), each=size, least=1) == buckets_for(four, each=size, least=1) + 1
    assert buckets_for(spark.range(0)) == 8


def test_a_bucketed_table_is_read_whole_by_version_and_in_a_new_store(spark, store):
    df = spark.range(1000).select((F.col("id") % 97).alias("k"), F.col("id").cast("string").alias("v"))
    store.replace_bucketed("raw/b", df.filter("k < 50"), ["k"], 4)
    store.replace_bucketed("raw/b", df, ["k"], 4)
    again = TableStore(spark, store.root)
    assert rows(again.read("raw/b")) == rows(df) and again.read("raw/b").dtypes == df.dtypes
    assert rows(again.read("raw/b", 1)) == rows(df.filter("k < 50"))
    assert shuffles(plan_of(again.read("raw/b").groupBy("k").count())) == 0
    store.replace_bucketed("raw/b", df.limit(0), ["k"], 4)
    assert store.versions("raw/b") == [2, 3] and store.read("raw/b").count() == 0
    assert store.truncate("raw/b").count() == 0


def test_the_weekly_roll_up_of_stored_buckets_moves_nothing(spark, store, conf):  # noqa: F811
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    sample = SampleRetail(spark, SAMPLE)
    daily = facts.daily_sales(sample.catalog_sales, sample.web_sales, sample.date_dim)
    date_dim = written(sample.date_dim)
    sold, stock = pipeline.store_weekly_inputs(store, daily, sample.inventory, date_dim, 8)
    sums = facts.weekly_sums(sold, stock)
    plan = plan_of(sums)
    assert shuffles(plan) == 0 and "SortMergeJoin" in plan
    conf("spark.sql.autoBroadcastJoinThreshold", "10m")
    mart = facts.weekly_from_sums(sums, date_dim)
    assert shuffles(plan_of(mart)) == 0
    assert rows(mart) == rows(facts.weekly_sales_inventory(daily, sample.inventory, sample.date_dim))


COLUMNS = ["k", "name", "code"]


def versions(spark, *data):
    return spark.createDataFrame(list(data), "k long, name string, code long, start_date timestamp_ntz, end_date timestamp_ntz")


def test_merge_in_place_equals_the_null_safe_merge(spark):
    day = dt.datetime(2000, 1, 1)
    old = versions(
        spark, (1, "a", 1, day, None), (2, "b", None, day, None), (3, "c", 3, day, None), (4, None, 4, day, None),
        (5, "gone", 5, day, None), (6, "x", 6, day, None), (6, "y", 6, day, None), (None, "n", 0, day, None),
    )
    source = spark.createDataFrame(
        [(1, "a", 1), (2, "b", None), (3, "c", None), (4, "d", 4), (6, "y", 6), (7, None, None)], "k long, name string, code long")
    got = scd2_merge_in_place(old, source, "k", COLUMNS, "2000-02-01")
    assert rows(got.select(*[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in got.columns])) == rows(
        (w := scd2_merge(old, source, "k", COLUMNS, "2000-02-01")).select(*[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in w.columns]))
    assert scd2_merge_in_place(old.limit(0), source, "k", COLUMNS, "2000-02-01").count() == 6
    assert scd2_merge_in_place(old, source.limit(0), "k", COLUMNS, "2000-02-01").filter("end_date is not null").count() == 0


@pytest.mark.parametrize("bad", [(1, "b", 1), (None, "b", 1)])
def test_merge_in_place_refuses_a_key_twice_or_missing(spark, bad):
    source = spark.createDataFrame([(1, "a", 1), bad], "k long, name string, code long")
    with pytest.raises(Exception, match="one expected"):
        scd2_merge_in_place(versions(spark).limit(0), source, "k", COLUMNS, "2000-02-01").collect()


def test_bucketed_customers_are_merged_without_a_shuffle(spark, store, conf):  # noqa: F811
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    sample = SampleRetail(spark, SAMPLE)
    key, columns = "c_customer_sk", sample.customer.columns
    open_ = sample.customer_snapshot.filter("end_date is null")
    old = store.replace_bucketed("raw/open", open_, [key], 8)
    new = store.replace_bucketed("raw/customer", sample.customer, [key], 8)
    merged = scd2_merge_in_place(old, new, key, columns, "2002-01-01")
    assert shuffles(plan_of(merged)) == 0
    text = [F.col(c).cast("string") for c in merged.columns]
    assert rows(merged.select(*text)) == rows(scd2_merge(open_, sample.customer, key, columns, "2002-01-01").select(*text))


# Pruning at run time.


def test_a_filtered_calendar_prunes_days_of_the_registered_fact(spark, store, conf):  # noqa: F811
    sample = SampleRetail(spark, SAMPLE)
    store.refresh_partitions("raw/daily", written(sample.catalog_sales).filter("cs_sold_date_sk % 20 = 0"), "cs_sold_date_sk", 0)
    store.register("raw/daily", store.read("raw/daily"))
    written(sample.date_dim).createOrReplaceTempView("calendar_days")
    one = store.read("raw/daily").agg(F.min("cs_sold_date_sk")).first()[0]
    found = spark.sql(
        f"select d.* from raw.daily d join calendar_days on cs_sold_date_sk = d_date_sk where cal_dt = (select max(cal_dt) from calendar_days where d_date_sk = {one})")
    found.collect()
    assert "dynamicpruning" in plan_of(found)
    everything = store.read("raw/daily").count()
    assert 0 < _rows_scanned(found._jdf.queryExecution().executedPlan()) <= everything / 4


def test_shipments_of_chosen_addresses_and_sites_meet_bloom_filters(spark, conf):  # noqa: F811
    """Both existence joins of the shipments drop rows at the scan where a lookup is filtered and too large to broadcast."""
    from shelfline.plans import metrics

    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    sample = SampleRetail(spark, SAMPLE)
    web, address, site = (written(getattr(sample, n)) for n in ("web_sales", "customer_address", "web_site"))
    few = address.filter(F.col("ca_address_sk") % 50 == 1)
    some = site.filter(F.col("web_site_sk") % 2 == 1)
    found = metrics.shipping_time(web, sample.warehouse, few, some)
    assert plan_of(found).count("might_contain") >= 2
    conf("spark.sql.optimizer.runtime.bloomFilter.enabled", "false")
    assert rows(found) == rows(metrics.shipping_time(web, sample.warehouse, few, some))


def test_the_pipeline_stores_the_same_facts_in_either_order(spark, tmp_path):
    sample = SampleRetail(spark, SAMPLE)
    raw = {n: getattr(sample, n) for n in ("catalog_sales", "web_sales", "date_dim", "inventory")}
    found = []
    for name, options in (("sorted", pipeline.Options()), ("interleaved", pipeline.Options(interleaved=True))):
        store = TableStore(spark, str(tmp_path / name))
        order = pipeline.row_order(raw["inventory"], options)
        daily = pipeline.refresh_daily(store, raw, order)
        found.append((rows(daily), rows(pipeline.refresh_weekly(store, raw["inventory"], raw["date_dim"], options, order=order))))
    assert found[0] == found[1] and found[0][1]
