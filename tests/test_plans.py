"""Plans: what is shuffled, broadcast, pushed down and split."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from shelfline.operators.history import scd2_merge
from shelfline.operators.refresh import mark_of
from shelfline.plans import dimensions, facts, metrics
from shelfline.sources.sample_retail import SampleRetail
from shelfline.sources.tables import written
from tests.conftest import SAMPLE


def plan_of(df) -> str:
    """The physical plan; after an action, the one adaptive execution settled on."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def shuffles(plan: str) -> int:
    return len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan))


@pytest.fixture(scope="module")
def stored(spark):
    """The sample tables as stored files, the way the plans meet them in use."""
    sample = SampleRetail(spark, SAMPLE)
    names = "date_dim catalog_sales web_sales inventory warehouse customer_address web_site customer"
    found = {name: written(getattr(sample, name)) for name in names.split()}
    found["daily"] = written(
        facts.daily_sales(found["catalog_sales"], found["web_sales"], found["date_dim"])
    )
    return found


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", registered._BUILDERS)
def test_no_cartesian_product_and_no_python(spark, name):
    plan = plan_of(registered.queries()[name](spark, SAMPLE))
    for node in ("CartesianProduct", "NestedLoop", "Python", "InPandas", "ObjectHashAggregate"):
        assert node not in plan


def test_daily_sales_shuffles_once_and_reads_only_its_columns(stored, conf):
    conf("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(
        facts.daily_sales(
            stored["catalog_sales"], stored["web_sales"], stored["date_dim"], mark=2451545
        )
    )
    assert shuffles(plan) == 1
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "GreaterThanOrEqual(cs_sold_date_sk,2451545)" in plan
    assert "GreaterThanOrEqual(ws_sold_date_sk,2451545)" in plan
    assert "ws_net_paid" not in plan and "day_of_wk_num" not in plan


def test_mark_from_the_target_skips_row_groups_at_run_time(stored):
    by_day = written(stored["daily"].repartitionByRange(8, "sold_date_sk"))
    last = by_day.filter(F.col("sold_date_sk") >= mark_of(by_day, "sold_date_sk"))
    last.collect()
    read = _rows_scanned(last._jdf.queryExecution().executedPlan())
    assert 0 < read <= by_day.count() / 4


def _rows_scanned(node) -> int:
    """Output rows of the main scan, found below adaptive and codegen wrappers."""
    while True:
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            node = node.executedPlan()
        elif "QueryStage" in name:
            node = node.plan()
        elif name.startswith("Scan"):
            return node.metrics().apply("numOutputRows").value()
        else:
            node = node.children().apply(0)


def test_weekly_mart_needs_one_shuffle_and_no_sort(stored):
    mart = facts.weekly_sales_inventory(stored["daily"], stored["inventory"], stored["date_dim"])
    plan = plan_of(mart)
    assert shuffles(plan) == 1
    assert "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") == 2  # the two calendar lookups


@pytest.mark.parametrize("query", ["qty", "amt", "profit", "avg_qty_dy"])
def test_weekly_metrics_shuffle_once(stored, query):
    plan = plan_of(metrics.weekly_metric(stored["catalog_sales"], stored["date_dim"], query))
    assert shuffles(plan) == 1 and "BroadcastHashJoin" in plan


def test_weeks_of_supply_joins_where_the_sales_already_are(stored, conf):
    conf("spark.sql.adaptive.enabled", "false")
    plan = plan_of(
        metrics.weeks_of_supply(
            stored["catalog_sales"], stored["web_sales"], stored["inventory"], stored["date_dim"]
        )
    )
    # Two channel sums, the stock sum and the stock's move to (item, week).
    assert shuffles(plan) == 4


def test_lifetime_value_sums_before_it_meets_customers(stored):
    plan = plan_of(metrics.customer_lifetime_value(stored["customer"], stored["web_sales"]))
    assert shuffles(plan) == 2


def test_large_calendar_is_not_broadcast(stored, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "1")
    plan = plan_of(
        facts.daily_sales(stored["catalog_sales"], stored["web_sales"], stored["date_dim"])
    )
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


@pytest.fixture
def split_small_partitions(conf):
    """Sort-merge joins only, and partitions of a few kilobytes already count as skewed."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "8k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.shuffle.partitions", "16")


def assert_split_and_equal(build, conf):
    """``build()`` splits a hot partition and returns what it returns without splitting."""
    df = build()
    split = df.collect()
    assert "skew=true" in plan_of(df)
    conf("spark.sql.adaptive.skewJoin.enabled", "false")
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(split, key=key) == sorted(build().collect(), key=key)


def test_hot_shipping_address_is_split(stored, conf, split_small_partitions):
    """A third of the shipments go to one address."""
    address = stored["customer_address"].agg(F.min("ca_address_sk")).first()[0]
    hot = F.when(F.col("ws_order_number") % 3 == 0, address).otherwise(F.col("ws_ship_addr_sk"))
    web = written(stored["web_sales"].withColumn("ws_ship_addr_sk", hot).repartition(8))
    tables = (stored["warehouse"], stored["customer_address"], stored["web_site"])
    assert_split_and_equal(lambda: metrics.shipping_time(web, *tables), conf)


@pytest.fixture
def hot_versions(spark):
    """A third of all customer versions belong to one customer."""
    sample = SampleRetail(spark, SAMPLE)
    versions = sample.customer_snapshot.withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.lit(20)))
    )
    one = F.expr("c_customer_sk * 20 + copy")
    hot = F.when(F.col("copy") % 3 == 0, F.lit(42)).otherwise(one)
    closed = F.when(F.col("copy") % 3 == 0, F.expr("timestamp_ntz '2000-06-01 00:00:00'"))
    return written(
        versions.withColumn("c_customer_sk", hot)
        .withColumn("c_login", F.concat("c_login", F.col("copy").cast("string")))
        .withColumn("end_date", closed)
        .drop("copy")
        .repartition(8)
    )


@pytest.mark.parametrize("missing", [False, True])
def test_hot_customer_address_is_split(spark, stored, conf, split_small_partitions, missing, hot_versions):
    """A third of the versions share one address, or have none."""
    sample = SampleRetail(spark, SAMPLE)
    address = stored["customer_address"].agg(F.min("ca_address_sk")).first()[0]
    hot = F.lit(None).cast("bigint") if missing else F.lit(address)
    versions = written(
        hot_versions.withColumn(
            "c_current_addr_sk",
            F.when(F.col("c_customer_sk") == 42, hot).otherwise(F.col("c_current_addr_sk")),
        )
    )
    lookups = (
        stored["customer_address"],
        sample.customer_demographics,
        sample.household_demographics,
        sample.income_band,
    )
    assert_split_and_equal(lambda: dimensions.customer_dim(versions, *lookups), conf)


def test_customer_with_a_third_of_all_versions_is_split(
    spark, conf, split_small_partitions, hot_versions
):
    customers = written(SampleRetail(spark, SAMPLE).customer)
    assert_split_and_equal(
        lambda: dimensions.customer_scd2(hot_versions, customers, "2002-01-01", "reference"), conf
    )


def test_closed_history_takes_no_part_in_the_null_safe_merge(spark, conf, hot_versions):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    customers = written(SampleRetail(spark, SAMPLE).customer)
    merged = dimensions.customer_scd2(hot_versions, customers, "2002-01-01")
    assert merged.filter("c_customer_sk = 42 and end_date = timestamp_ntz '2000-06-01'").count() == (
        hot_versions.filter("c_customer_sk = 42").count()
    )
    # Open versions by row and by key, their rows, and the source's rows twice and keys.
    assert shuffles(plan_of(merged)) == 6


def test_the_reference_merge_needs_five_exchanges_and_no_second_branch(spark, conf, hot_versions):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    customers = written(SampleRetail(spark, SAMPLE).customer)
    plan = plan_of(dimensions.customer_scd2(hot_versions, customers, "2002-01-01", "reference"))
    # Known rows, the source's rows, all versions by key, and the extremes: source rows by key, then a row for each key.
    assert shuffles(plan) == 5 and plan.count("SortMergeJoin") == 2


def test_versions_meet_one_row_however_often_the_source_repeats_their_key(spark, conf):
    source = spark.range(3000).selectExpr("1L as k", "cast(id as string) as name", "id as code")
    start = F.expr("timestamp_ntz '2000-01-01 00:00:00'")
    snapshot = source.withColumn("start_date", start).withColumn("end_date", F.lit(None).cast("timestamp_ntz"))
    merged = scd2_merge(snapshot, source, "k", ["k", "name", "code"], "2000-02-01", "reference")
    assert merged.filter("end_date is not null").count() == merged.count() == 3000
