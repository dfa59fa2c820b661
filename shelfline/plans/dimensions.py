"""Customer history and the customer dimension built on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.operators.history import Mode, scd2_merge
from shelfline.sources.schemas import (
    CUSTOMER,
    CUSTOMER_ADDRESS_ATTRIBUTES,
    CUSTOMER_DEMOGRAPHICS_ATTRIBUTES,
    CUSTOMER_DIM,
    CUSTOMER_KEY,
    CUSTOMER_SNAPSHOT,
    CUSTOMER_ZERO_DEFAULT,
    HOUSEHOLD_ATTRIBUTES,
    INCOME_BAND_ATTRIBUTES,
    conform,
)


def customer_scd2(
    snapshot: DataFrame,
    customer: DataFrame,
    as_of: Column | str | None = None,
    mode: Mode = "null_safe",
) -> DataFrame:
    """The customer snapshot after merging today's customers into it."""
    merged = scd2_merge(
        snapshot,
        customer,
        CUSTOMER_KEY,
        CUSTOMER.fieldNames(),
        as_of,
        mode,
        CUSTOMER_ZERO_DEFAULT,
    )
    return conform(merged, CUSTOMER_SNAPSHOT)


def _looked_up(
    df: DataFrame, table: DataFrame, key: str, table_key: str, attributes: T.StructType
) -> DataFrame:
    """Left join that takes only the listed attributes of ``table``.

    Left to Spark's own size check: small tables are broadcast, large ones are
    joined by key with skewed partitions split at run time.
    """
    wanted = table.select(F.col(table_key).alias("lookup_key"), *attributes.fieldNames())
    return df.join(wanted, F.col(key) == F.col("lookup_key"), "left").drop("lookup_key")


def customer_dim(
    snapshot: DataFrame,
    customer_address: DataFrame,
    customer_demographics: DataFrame,
    household_demographics: DataFrame,
    income_band: DataFrame,
) -> DataFrame:
    """Every customer version with address, demographics, household and income band."""
    wide = _looked_up(
        snapshot,
        customer_demographics,
        "c_current_cdemo_sk",
        "cd_demo_sk",
        CUSTOMER_DEMOGRAPHICS_ATTRIBUTES,
    )
    wide = _looked_up(
        wide, household_demographics, "c_current_hdemo_sk", "hd_demo_sk", HOUSEHOLD_ATTRIBUTES
    )
    wide = _looked_up(
        wide, income_band, "hd_income_band_sk", "ib_income_band_sk", INCOME_BAND_ATTRIBUTES
    )
    wide = _looked_up(
        wide, customer_address, "c_current_addr_sk", "ca_address_sk", CUSTOMER_ADDRESS_ATTRIBUTES
    )
    return conform(wide, CUSTOMER_DIM)


def customer_dim_current(dim: DataFrame) -> DataFrame:
    """Open versions only."""
    return dim.filter(F.col("end_date").isNull())
