"""Inventory landing files written from the sample tables, with typical faults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.sources.sample_retail import SampleRetail
from shelfline.sources.tables import shared_folder


def inventory_lines(r: SampleRetail) -> DataFrame:
    """(line, day): one text line per inventory row, some of them spoilt."""
    calendar = r.date_dim.select(
        F.col("d_date_sk").alias("inv_date_sk"), F.col("day_of_wk_num").alias("day")
    )
    mixed = F.col("inv_date_sk") + F.col("inv_item_sk")
    text = {c: F.col(c).cast("string") for c in r.inventory.columns}
    # A third of the good quantities are written as decimals that round to them.
    quantity = F.concat("inv_quantity_on_hand", F.when(mixed % 3 == 0, ".4").otherwise(""))
    fields = [
        F.when(mixed % 47 == 0, "").otherwise(text["inv_date_sk"]),
        text["inv_item_sk"],
        F.when(mixed % 43 == 0, "n/a").otherwise(F.coalesce(quantity, F.lit(""))),
        text["inv_warehouse_sk"],
    ]
    line = F.concat_ws(",", *fields)
    line = F.when(mixed % 41 == 0, F.concat(line, F.lit(",extra"))).otherwise(line)
    return r.inventory.join(calendar, "inv_date_sk").select(line.alias("line"), "day")


def write_inventory_files(r: SampleRetail) -> str:
    """Write the lines as text files, one folder per weekday, and return the path."""
    path = f"{shared_folder(r.spark)}/inventory"
    inventory_lines(r).write.partitionBy("day").text(path)
    return path
