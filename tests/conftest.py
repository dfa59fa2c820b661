import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shelfline.functions import day_of_week_num, julian_day, week_start  # noqa: E402
from shelfline.session import build_session  # noqa: E402

SAMPLE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "shelfline-tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__driver__host="127.0.0.1",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__sources__parallelPartitionDiscovery__parallelism="4",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


def day_key(text: str) -> int:
    """Julian day number of an ISO date."""
    return (dt.date.fromisoformat(text) - dt.date(1970, 1, 1)).days + 2440588


@pytest.fixture(scope="session")
def calendar(spark):
    """Days of 1999-12-19 (a Sunday) to 2000-02-05; week and year are those of the Sunday."""
    days = spark.sql(
        "select explode(sequence(date '1999-12-19', date '2000-02-05')) as cal_dt"
    )
    day, sunday = F.col("cal_dt"), week_start(F.col("cal_dt"))
    return days.select(
        julian_day(day).alias("d_date_sk"),
        day,
        day_of_week_num(day).alias("day_of_wk_num"),
        F.year(sunday).cast("bigint").alias("yr_num"),
        F.ceil(F.dayofyear(sunday) / 7).cast("bigint").alias("wk_num"),
    ).cache()


CATALOG = """cs_warehouse_sk long, cs_item_sk long, cs_sold_date_sk long, cs_quantity long,
    cs_sales_price decimal(7,2), cs_net_profit decimal(7,2)"""
WEB = CATALOG.replace("cs_", "ws_")
INVENTORY = """inv_date_sk long, inv_item_sk long, inv_quantity_on_hand long,
    inv_warehouse_sk long"""


def rows(df, *columns):
    """All rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is None, v) for v in t])
