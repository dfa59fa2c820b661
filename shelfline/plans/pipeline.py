"""One ordered run of everything: landing, facts, history, dimensions, metric tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.clustering import edges, interleaved
from shelfline.operators.history import Mode
from shelfline.operators.quality import copy_dimension
from shelfline.operators.refresh import read_mark
from shelfline.plans import dimensions, facts, metrics
from shelfline.sources import landing
from shelfline.sources.schemas import (
    CUSTOMER_SNAPSHOT,
    DAILY_SALES,
    INVENTORY,
    INVENTORY_REQUIRED,
    WEEKLY_SALES_INVENTORY,
)
from shelfline.sources.tables import TableStore, shared_folder

DAILY = "intermediate/daily_aggregated_sales"
SNAPSHOT = "intermediate/customer_snapshot"
SALES_SUMS = "intermediate/weekly_sales_sums"
STOCK_SUMS = "intermediate/weekly_stock_sums"
WEEKLY = "analytics/weekly_sales_inventory"
RAW_INVENTORY = "raw/inventory"
INVENTORY_REJECTS = "raw/inventory_rejects"
INVENTORY_AUDIT = "raw/inventory_load_audit"
DROPPED = "analytics/weeks_without_sunday"


@dataclass(frozen=True)
class Options:
    """Choices a run can make; the defaults are those of the functions called."""

    as_of: Column | str | None = None
    mode: Mode = "null_safe"
    watermark: facts.Watermark = "weekly"
    fanout: facts.Fanout = "reference"
    inventory_landing: str | None = None
    register: bool = False
    interleaved: bool = False


#: The order of rows within a partition of the facts.
ORDER: tuple[str | Column, ...] = ("item_sk", "warehouse_sk")
#: Bytes of a row group where rows are interleaved: what a filter on an item or a warehouse can skip.
ROW_GROUP = 16 * 1024 * 1024


def row_order(inventory: DataFrame, options: Options) -> tuple[str | Column, ...]:
    """By item, then warehouse; or along both at once, by shares of the stock rows, so that filters on either skip rows.

    The shares take one more pass over two columns of the stock.
    """
    if not options.interleaved:
        return ORDER
    keys = inventory.select(F.col("inv_item_sk").alias("item_sk"), F.col("inv_warehouse_sk").alias("warehouse_sk"))
    return (interleaved(edges(keys, ["item_sk", "warehouse_sk"])), *ORDER)


def _row_group(order: tuple[str | Column, ...]) -> int | None:
    return None if all(isinstance(c, str) for c in order) else ROW_GROUP


def load_inventory(spark: SparkSession, store: TableStore, path: str) -> DataFrame:
    """Replace raw inventory with the good lines of the landing files; keep rejects and audit.

    The files are read and parsed once.
    """
    target = f"{shared_folder(spark)}/stage"
    staged = landing.stage(spark, path, target, INVENTORY, INVENTORY_REQUIRED)
    store.replace(INVENTORY_REJECTS, staged.rejects)
    store.replace(INVENTORY_AUDIT, staged.audit)
    return store.replace(RAW_INVENTORY, staged.good)


def read_daily(store: TableStore, from_key: int | None = None) -> DataFrame:
    return store.read_partitioned(DAILY, DAILY_SALES, facts.DAILY_KEY, from_key)


def read_weekly(store: TableStore, from_key: int | None = None) -> DataFrame:
    return store.read_partitioned(WEEKLY, WEEKLY_SALES_INVENTORY, facts.WEEKLY_KEY, from_key)


def refresh_daily(
    store: TableStore, raw: Mapping[str, DataFrame], order: tuple[str | Column, ...] = ORDER
) -> DataFrame:
    """Rebuild the last loaded day of the daily fact and add the days after it.

    The mark is the last partition. What is kept lies before it, so the stored
    fact itself is neither read nor listed beyond its folder names.
    """
    mark = store.last_key(DAILY, facts.DAILY_KEY)
    fresh = facts.daily_sales(
        raw["catalog_sales"], raw["web_sales"], raw["date_dim"], mark=mark
    )
    store.refresh_partitions(DAILY, fresh, facts.DAILY_KEY, mark, order, row_group=_row_group(order))
    return read_daily(store)


def refresh_weekly(
    store: TableStore,
    inventory: DataFrame,
    date_dim: DataFrame,
    options: Options = Options(),
    daily: DataFrame | None = None,
    dropped: Observation | None = None,
    order: tuple[str | Column, ...] = ORDER,
) -> DataFrame:
    """Rebuild the last loaded week of the mart and add the weeks after it.

    Reads only the daily rows and mart weeks that can take part. ``dropped`` counts, in the same
    job, what of them is left out for want of a Sunday.
    """
    if options.watermark == "weekly":
        mark = store.last_key(WEEKLY, facts.WEEKLY_KEY)
    elif daily is None:
        mark = store.last_key(DAILY, facts.DAILY_KEY)
    else:
        mark = read_mark(daily, facts.DAILY_KEY)
    first_day = facts.first_day_to_read(date_dim, mark).first()["first_day"]
    from_key = min(mark, first_day)
    target = read_weekly(store, from_key)
    if options.watermark == "weekly":
        target = target.filter(F.col(facts.WEEKLY_KEY) < mark)
    state = facts.weekly_sales_inventory(
        read_daily(store, first_day) if daily is None else daily,
        inventory,
        date_dim,
        target,
        options.watermark,
        options.fanout,
        mark,
        first_day,
        dropped,
    )
    store.refresh_partitions(
        WEEKLY, state, facts.WEEKLY_KEY, from_key, order, row_group=_row_group(order)
    )
    return read_weekly(store)


def store_weekly_inputs(
    store: TableStore, daily: DataFrame, inventory: DataFrame, date_dim: DataFrame, buckets: int
) -> tuple[DataFrame, DataFrame]:
    """The sums of ``facts.weekly_sums`` as tables bucketed by the roll-up key, of which few rows share one.

    What is read from them often, with either fan-out or other measures, is then joined where it lies.
    """
    sold = store.replace_bucketed(SALES_SUMS, facts.sales_sums(daily), facts.MART_KEY, buckets)
    return sold, store.replace_bucketed(STOCK_SUMS, facts.stock_sums(inventory, date_dim), facts.MART_KEY, buckets)


def refresh_customers(
    spark: SparkSession, store: TableStore, raw: Mapping[str, DataFrame], options: Options
) -> tuple[DataFrame, DataFrame]:
    """Merge today's customers into the snapshot and rebuild the dimension from it."""
    if options.mode == "null_safe" and store.exists(SNAPSHOT):
        # Closed versions stay as they are: only the open part is read and written.
        merged = dimensions.customer_scd2(
            store.open_part(SNAPSHOT), raw["customer"], options.as_of, options.mode
        )
    else:
        known = store.read(SNAPSHOT) if store.exists(SNAPSHOT) else None
        if known is None:
            known = spark.createDataFrame([], CUSTOMER_SNAPSHOT)
        merged = dimensions.customer_scd2(known, raw["customer"], options.as_of, options.mode)
    if options.mode == "null_safe":
        snapshot = store.evolve(SNAPSHOT, merged, F.col("end_date").isNotNull())
    else:
        snapshot = store.replace(SNAPSHOT, merged)
    dim = dimensions.customer_dim(
        snapshot,
        raw["customer_address"],
        raw["customer_demographics"],
        raw["household_demographics"],
        raw["income_band"],
    )
    return snapshot, store.replace("analytics/customer_dim", dim)


def run_pipeline(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    store: TableStore,
    options: Options = Options(),
) -> dict[str, DataFrame]:
    """Bring every derived table up to date and return them as stored, by name.

    ``raw`` holds the source tables by name; inventory comes from the landing
    files instead when ``options.inventory_landing`` is given. Each stored table
    is read back before the next step uses it, so no step recomputes another.
    With ``options.register`` the tables can then be queried as ``layer.name``.
    """
    date_dim = facts.check_calendar(raw["date_dim"])
    done: dict[str, DataFrame] = {}
    if options.inventory_landing is None:
        inventory = raw["inventory"]
    else:
        inventory = load_inventory(spark, store, options.inventory_landing)
        done[RAW_INVENTORY] = inventory

    order = row_order(inventory, options)
    done[DAILY] = refresh_daily(store, raw, order)
    dropped = Observation()
    done[WEEKLY] = refresh_weekly(store, inventory, date_dim, options, dropped=dropped, order=order)
    lost = spark.createDataFrame([dropped.get], "daily_rows bigint, daily_qty bigint")
    done[DROPPED] = store.replace(DROPPED, lost)
    done[SNAPSHOT], done["analytics/customer_dim"] = refresh_customers(spark, store, raw, options)

    web = raw["web_sales"]
    # Both period tables come from one pass over the sales.
    by_day = store.replace("intermediate/web_prices_by_day", metrics.prices_by_day(web))
    rebuilt = {
        "date_dim": copy_dimension(date_dim),
        "item_dim": copy_dimension(raw["item"]),
        "warehouse_dim": copy_dimension(raw["warehouse"]),
        "customer_lifetime_value": metrics.customer_lifetime_value(raw["customer"], web),
        "marketing_attribution": metrics.marketing_attribution(raw["promotion"], web),
        "seasonal_sales_monthly": metrics.sales_by_period(by_day, date_dim, "month"),
        "seasonal_sales_quarterly": metrics.sales_by_period(by_day, date_dim, "quarter"),
        "shipping_time": metrics.shipping_time(
            web, raw["warehouse"], raw["customer_address"], raw["web_site"]
        ),
    }
    for name, df in rebuilt.items():
        done[f"analytics/{name}"] = store.replace(f"analytics/{name}", df)
    if options.register:
        for table, df in done.items():
            store.register(table, df)
    return done
