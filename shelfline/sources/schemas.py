"""Declared table schemas.

Column names, their order and their types are fixed values: consumers of the
tables rely on them. Whole-number keys and counts are ``LongType``, money at a
table boundary is ``DoubleType`` and ratios are ``decimal(38,6)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_KINDS = {
    "long": T.LongType(),
    "double": T.DoubleType(),
    "ratio": T.DecimalType(38, 6),
    "string": T.StringType(),
    "bool": T.BooleanType(),
    "stamp": T.TimestampNTZType(),
}


def _schema(kinds: dict[str, str], required: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType(
        [T.StructField(name, _KINDS[kind], name not in required) for name, kind in kinds.items()]
    )


# Inventory snapshot as landed.
INVENTORY_REQUIRED = ("inv_date_sk", "inv_item_sk", "inv_warehouse_sk")
INVENTORY = _schema(
    {
        "inv_date_sk": "long",
        "inv_item_sk": "long",
        "inv_quantity_on_hand": "long",
        "inv_warehouse_sk": "long",
    },
    INVENTORY_REQUIRED,
)

# Daily sales fact.
DAILY_SALES = _schema(
    {
        "warehouse_sk": "long",
        "item_sk": "long",
        "sold_date_sk": "long",
        "sold_wk_num": "long",
        "sold_yr_num": "long",
        "daily_qty": "long",
        "daily_sales_amt": "double",
        "daily_net_profit": "double",
    }
)

# Weekly sales and inventory mart.
WEEKLY_SALES_INVENTORY = _schema(
    {
        "warehouse_sk": "long",
        "item_sk": "long",
        "sold_wk_sk": "long",
        "sold_wk_num": "long",
        "sold_yr_num": "long",
        "sum_qty_wk": "long",
        "sum_amt_wk": "double",
        "sum_profit_wk": "double",
        "avg_qty_dy": "ratio",
        "inv_qty_wk": "long",
        "wks_sply": "ratio",
        "low_stock_flg_wk": "bool",
    }
)

# The source columns of a customer, in table order.
CUSTOMER = _schema(
    {
        "c_salutation": "string",
        "c_preferred_cust_flag": "string",
        "c_first_sales_date_sk": "long",
        "c_customer_sk": "long",
        "c_login": "string",
        "c_current_cdemo_sk": "long",
        "c_first_name": "string",
        "c_current_hdemo_sk": "long",
        "c_current_addr_sk": "long",
        "c_last_name": "string",
        "c_customer_id": "string",
        "c_last_review_date_sk": "long",
        "c_birth_month": "long",
        "c_birth_country": "string",
        "c_birth_year": "long",
        "c_birth_day": "long",
        "c_email_address": "string",
        "c_first_shipto_date_sk": "long",
    }
)
CUSTOMER_KEY = "c_customer_sk"

# Customer columns in which a null counts as 0 when versions are compared.
CUSTOMER_ZERO_DEFAULT = (
    "c_first_sales_date_sk",
    "c_current_cdemo_sk",
    "c_current_hdemo_sk",
    "c_last_review_date_sk",
    "c_birth_month",
    "c_birth_year",
    "c_birth_day",
    "c_first_shipto_date_sk",
)

_VALIDITY = _schema({"start_date": "stamp", "end_date": "stamp"})
CUSTOMER_SNAPSHOT = T.StructType(CUSTOMER.fields + _VALIDITY.fields)

# What each lookup table adds to the customer dimension.
CUSTOMER_ADDRESS_ATTRIBUTES = _schema(
    {
        "ca_street_name": "string",
        "ca_suite_number": "string",
        "ca_state": "string",
        "ca_location_type": "string",
        "ca_country": "string",
        "ca_address_id": "string",
        "ca_county": "string",
        "ca_street_number": "string",
        "ca_zip": "string",
        "ca_city": "string",
        "ca_gmt_offset": "double",
    }
)
CUSTOMER_DEMOGRAPHICS_ATTRIBUTES = _schema(
    {
        "cd_dep_employed_count": "long",
        "cd_dep_count": "long",
        "cd_credit_rating": "string",
        "cd_education_status": "string",
        "cd_purchase_estimate": "long",
        "cd_marital_status": "string",
        "cd_dep_college_count": "long",
        "cd_gender": "string",
    }
)
HOUSEHOLD_ATTRIBUTES = _schema(
    {
        "hd_buy_potential": "string",
        "hd_dep_count": "long",
        "hd_vehicle_count": "long",
        "hd_income_band_sk": "long",
    }
)
INCOME_BAND_ATTRIBUTES = _schema({"ib_lower_bound": "long", "ib_upper_bound": "long"})
CUSTOMER_DIM = T.StructType(
    CUSTOMER.fields
    + CUSTOMER_ADDRESS_ATTRIBUTES.fields
    + CUSTOMER_DEMOGRAPHICS_ATTRIBUTES.fields
    + HOUSEHOLD_ATTRIBUTES.fields
    + INCOME_BAND_ATTRIBUTES.fields
    + _VALIDITY.fields
)

# Shipment rows.
SHIPPING_TIME = T.StructType(
    [
        T.StructField("shipment_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("shipping_date", T.LongType()),
        T.StructField("delivery_date", T.LongType()),
        T.StructField("shipping_method", T.VarcharType(50)),
        T.StructField("shipping_address", T.VarcharType(255)),
    ]
)


def _declared(field: T.StructField) -> str:
    if isinstance(field.dataType, T.VarcharType):
        text, limit = f"cast(`{field.name}` as string)", field.dataType.length
        problem = f"concat('{field.name} is longer than {limit} characters: ', {text})"
        return (
            f"case when length({text}) > {limit} then raise_error({problem})"
            f" else {text} end as `{field.name}`"
        )
    return f"cast(`{field.name}` as {field.dataType.simpleString()}) as `{field.name}`"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring ``df`` to a declared schema: order, types, and text lengths.

    An over-long text raises, as it would on insert into a ``varchar(n)`` column.
    """
    return df.selectExpr([_declared(field) for field in schema.fields])
