"""Retail-shaped views over the supplied order tables.

The pipelines expect retail tables (sales by channel, inventory, customers and
their lookups). These views derive every one of them from whole supplied tables,
so the work grows with the data. Remainders only spread values over codes and
place nulls; they never select rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.labels import UNIX_EPOCH_JULIAN_DAY

# Supplied tables. Declared, so that no job has to look them up.
SUPPLIED = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
}

ITEM_OF_PART = "l_partkey div 100"
WAREHOUSE_OF_SUPPLIER = "case when l_suppkey % 17 = 0 then null else l_suppkey % 6 end"


def _money(expression: str) -> str:
    """Amounts in quarters: ``floor`` gives the same value in every engine, and sums of doubles stay exact."""
    return f"cast(floor(4 * ({expression})) * 0.25D as decimal(12,2))"


def _julian(day: str) -> str:
    return f"cast(unix_date(cast({day} as date)) + {UNIX_EPOCH_JULIAN_DAY} as bigint)"


def _sunday(day: str) -> str:
    return f"date_sub(cast({day} as date), dayofweek(cast({day} as date)) - 1)"


class SampleRetail:
    """The retail tables for one folder of supplied Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        return self.spark.read.schema(SUPPLIED[name]).parquet(path)

    @cached_property
    def date_dim(self) -> DataFrame:
        """Every day from the week of the first order to the week of the last shipment.

        Weeks are numbered from their Mondays, years are calendar years: the days around New Year make
        some (week, year) with two Sundays and some without any.
        """
        ordered = self.table("orders").selectExpr("cast(o_orderdate as date) as d")
        shipped = self.table("lineitem").selectExpr("cast(l_shipdate as date) as d")
        span = ordered.unionAll(shipped).selectExpr("min(d) as lo", "max(d) as hi")
        first, last = _sunday("lo"), f"date_add({_sunday('hi')}, 6)"
        days = span.selectExpr(f"explode(sequence({first}, {last})) as cal_dt")
        return days.selectExpr(
            f"{_julian('cal_dt')} as d_date_sk",
            "cal_dt",
            "cast(dayofweek(cal_dt) - 1 as bigint) as day_of_wk_num",
            "cast(year(cal_dt) as bigint) as yr_num",
            "cast(weekofyear(cal_dt) as bigint) as wk_num",
        )

    @cached_property
    def _sales_line(self) -> DataFrame:
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        lines = self.table("lineitem").join(orders, F.expr("l_orderkey = o_orderkey"))
        return lines.selectExpr(
            "l_linestatus",
            f"{WAREHOUSE_OF_SUPPLIER} as warehouse_sk",
            f"{ITEM_OF_PART} as item_sk",
            f"case when l_orderkey % 50 != 0 then {_julian('o_orderdate')} end as sold_date_sk",
            f"{_julian('l_shipdate')} as ship_date_sk",
            "case when l_partkey % 97 != 0 then cast(l_quantity as bigint) end as quantity",
            f"{_money('l_extendedprice / l_quantity')} as sales_price",
            f"{_money('l_extendedprice * (0.4 - l_discount)')} as net_profit",
            f"{_money('l_extendedprice * (1 - l_discount)')} as net_paid",
            f"""case when l_orderkey % 41 != 0 then {_money("l_extendedprice * 0.5")} end
                as wholesale_cost""",
            "l_partkey % 27 as promo_sk",
            "l_orderkey % 6 as ship_mode_sk",
            "l_suppkey as web_site_sk",
            "l_orderkey as order_number",
            "o_custkey as customer_sk",
        )

    def _channel(self, line_status: str, prefix: str, names: dict[str, str]) -> DataFrame:
        lines = self._sales_line.filter(f"l_linestatus = '{line_status}'")
        return lines.selectExpr([f"{source} as {prefix}{name}" for name, source in names.items()])

    @cached_property
    def catalog_sales(self) -> DataFrame:
        return self._channel(
            "F",
            "cs_",
            {
                "warehouse_sk": "warehouse_sk",
                "item_sk": "item_sk",
                "sold_date_sk": "sold_date_sk",
                "quantity": "quantity",
                "sales_price": "sales_price",
                "net_profit": "net_profit",
            },
        )

    @cached_property
    def web_sales(self) -> DataFrame:
        return self._channel(
            "O",
            "ws_",
            {
                "warehouse_sk": "warehouse_sk",
                "item_sk": "item_sk",
                "sold_date_sk": "sold_date_sk",
                "ship_date_sk": "ship_date_sk",
                "quantity": "quantity",
                "sales_price": "sales_price",
                "net_profit": "net_profit",
                "net_paid": "net_paid",
                "wholesale_cost": "wholesale_cost",
                "bill_customer_sk": "customer_sk",
                "ship_addr_sk": "customer_sk",
                "order_number": "order_number",
                "promo_sk": "promo_sk",
                "ship_mode_sk": "ship_mode_sk",
                "web_site_sk": "web_site_sk",
            },
        )

    @cached_property
    def inventory(self) -> DataFrame:
        """Sunday stock per shipped item and warehouse; warehouse 0 counts on Wednesday too."""
        shipped = (
            self.table("lineitem")
            .selectExpr(
                f"{ITEM_OF_PART} as item",
                f"{WAREHOUSE_OF_SUPPLIER} as warehouse",
                f"{_julian(_sunday('l_shipdate'))} as sunday",
                "cast(l_quantity as bigint) as quantity",
            )
            .filter("warehouse is not null")
            .groupBy("item", "warehouse", "sunday")
            .agg(F.sum("quantity").alias("shipped"))
        )
        counted = shipped.selectExpr(
            "*", "explode(case when warehouse = 0 then array(0, 3) else array(0) end) as day"
        )
        return counted.selectExpr(
            "sunday + day as inv_date_sk",
            "item as inv_item_sk",
            """case when (shipped + item) % 11 != 0
               then (shipped * 7 + item * 13 + warehouse * 29 + day * 17)
                         % case when item % 4 = 0 then 3 else 60 end end
               as inv_quantity_on_hand""",
            "warehouse as inv_warehouse_sk",
        )

    @cached_property
    def item(self) -> DataFrame:
        return self.table("part")

    @cached_property
    def warehouse(self) -> DataFrame:
        """Five warehouses; lines of the sixth code find none."""
        return self.table("region").select(
            F.col("r_regionkey").cast("bigint").alias("w_warehouse_sk"),
            F.col("r_name").alias("w_warehouse_name"),
        )

    @cached_property
    def promotion(self) -> DataFrame:
        """Twenty-five promotions sharing five names."""
        return self.table("nation").select(
            F.col("n_nationkey").cast("bigint").alias("p_promo_sk"),
            F.concat(F.lit("PROMO_"), F.col("n_regionkey").cast("string")).alias("p_promo_name"),
        )

    @cached_property
    def web_site(self) -> DataFrame:
        places = self.table("nation").join(
            self.table("region"), F.expr("n_regionkey = r_regionkey")
        )
        return (
            self.table("supplier")
            .join(places, F.expr("s_nationkey = n_nationkey"))
            .select(
                F.col("s_suppkey").alias("web_site_sk"),
                F.col("s_name").alias("web_street_name"),
                F.col("n_name").alias("web_city"),
                F.when(F.expr("s_suppkey % 10 != 0"), F.col("r_name")).alias("web_state"),
                F.expr("cast(10000 + s_suppkey as string)").alias("web_zip"),
            )
        )

    @cached_property
    def customer(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "case when c_custkey % 9 != 0 then c_mktsegment end as c_salutation",
            """case when c_custkey % 23 != 0
               then case when c_acctbal > 0 then 'Y' else 'N' end end as c_preferred_cust_flag""",
            """case when c_custkey % 8 != 0
               then 2449719 + c_custkey % 2000 end as c_first_sales_date_sk""",
            "c_custkey as c_customer_sk",
            """case when c_custkey % 19 != 0
               then concat('login', cast(c_custkey as string)) end as c_login""",
            """case when c_custkey % 5 != 0
               then cast(c_nationkey * 2 % 27 as bigint) end as c_current_cdemo_sk""",
            "c_name as c_first_name",
            """case when c_custkey % 6 != 0
               then cast(c_nationkey + 1 as bigint) end as c_current_hdemo_sk""",
            "case when c_custkey % 29 != 0 then c_custkey end as c_current_addr_sk",
            "concat('Family', cast(c_nationkey as string)) as c_last_name",
            "concat('ID', cast(c_custkey as string)) as c_customer_id",
            """case when c_custkey % 4 != 0
               then 2450000 + c_custkey % 300 end as c_last_review_date_sk""",
            "case when c_custkey % 21 != 0 then c_custkey % 12 + 1 end as c_birth_month",
            """case when c_custkey % 31 != 0
               then concat('Country', cast(c_nationkey as string)) end as c_birth_country""",
            "case when c_custkey % 22 != 0 then 1930 + c_custkey % 70 end as c_birth_year",
            "c_custkey % 28 + 1 as c_birth_day",
            """case when c_custkey % 37 != 0
               then concat('c', cast(c_custkey as string), '@example.com') end as c_email_address""",
            """case when c_custkey % 10 != 3
               then 2450100 + c_custkey % 500 end as c_first_shipto_date_sk""",
        )

    @cached_property
    def customer_snapshot(self) -> DataFrame:
        """History before a merge: one segment is known by keys that have left the source, some customers
        have moved, some have a closed version, nulls and zeros have changed places."""
        versions = (
            self.customer.join(
                self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment"),
                F.expr("c_customer_sk = c_custkey"),
            )
            .withColumn(
                "version",
                F.explode(F.expr("case when c_nationkey < 5 then array(0, 1) else array(1) end")),
            )
        )
        replaced = {
            "c_salutation": "case when c_customer_sk % 13 != 0 then c_salutation end",
            "c_login": """case when version = 0 and c_customer_sk % 2 = 0
                          then 'earlier' else c_login end""",
            "c_current_cdemo_sk": "nullif(c_current_cdemo_sk, 0)",
            "c_current_addr_sk": """case when version = 1 and c_customer_sk % 7 = 0
                                    then c_current_addr_sk + 1 else c_current_addr_sk end""",
            "c_customer_sk": "case when c_mktsegment = 'MACHINERY' then -c_customer_sk else c_customer_sk end",
        }
        columns = [F.expr(replaced.get(c, c)).alias(c) for c in self.customer.columns]
        return versions.select(
            *columns,
            F.expr(
                """case when version = 0 then timestamp_ntz '1999-01-01 00:00:00'
                   else timestamp_ntz '2000-01-01 00:00:00' end"""
            ).alias("start_date"),
            F.expr("case when version = 0 then timestamp_ntz '2000-01-01 00:00:00' end").alias(
                "end_date"
            ),
        )

    @cached_property
    def customer_address(self) -> DataFrame:
        """An address for each customer; those of customers in debt have keys that nothing refers to."""
        return (
            self.table("customer")
            .selectExpr(
                "case when c_acctbal >= 0 then c_custkey else -c_custkey end as ca_address_sk",
                "concat('Street', cast(c_custkey % 90 as string)) as ca_street_name",
                "concat('Suite', cast(c_custkey % 40 as string)) as ca_suite_number",
                "concat('State', cast(c_nationkey as string)) as ca_state",
                "case when c_acctbal > 5000 then 'house' else 'apartment' end as ca_location_type",
                "concat('Country', cast(c_nationkey as string)) as ca_country",
                "concat('ADDR', cast(c_custkey as string)) as ca_address_id",
                "concat('County', cast(c_custkey % 15 as string)) as ca_county",
                "cast(c_custkey % 999 as string) as ca_street_number",
                "cast(10000 + c_custkey % 80000 as string) as ca_zip",
                "concat('City', cast(c_custkey % 60 as string)) as ca_city",
                "cast(c_nationkey % 24 - 12 as double) as ca_gmt_offset",
            )
        )

    @cached_property
    def customer_demographics(self) -> DataFrame:
        """One row per nation; customers with code 26 find nothing."""
        return self.table("nation").selectExpr(
            "cast(n_nationkey as bigint) as cd_demo_sk",
            "cast(n_nationkey % 3 as bigint) as cd_dep_employed_count",
            "cast(n_nationkey % 7 as bigint) as cd_dep_count",
            "case when n_nationkey % 2 = 0 then 'Good' else 'Low Risk' end as cd_credit_rating",
            "concat('Level', cast(n_regionkey as string)) as cd_education_status",
            "cast(500 * (n_nationkey + 1) as bigint) as cd_purchase_estimate",
            "case when n_nationkey % 3 = 0 then 'M' else 'S' end as cd_marital_status",
            "cast(n_nationkey % 4 as bigint) as cd_dep_college_count",
            "case when n_nationkey % 2 = 0 then 'F' else 'M' end as cd_gender",
        )

    @cached_property
    def household_demographics(self) -> DataFrame:
        """One row per nation; customers with code 25 find nothing."""
        return self.table("nation").selectExpr(
            "cast(n_nationkey as bigint) as hd_demo_sk",
            "concat('Buys', cast(n_nationkey % 6 as string)) as hd_buy_potential",
            "cast(n_nationkey % 9 as bigint) as hd_dep_count",
            "cast(n_nationkey % 5 as bigint) as hd_vehicle_count",
            "cast(n_regionkey + 2 as bigint) as hd_income_band_sk",
        )

    @cached_property
    def income_band(self) -> DataFrame:
        """Bands 1 to 5; households of band 6 find none."""
        return self.table("region").selectExpr(
            "cast(r_regionkey + 1 as bigint) as ib_income_band_sk",
            "cast(r_regionkey * 10000 + 1 as bigint) as ib_lower_bound",
            "cast((r_regionkey + 1) * 10000 as bigint) as ib_upper_bound",
        )
