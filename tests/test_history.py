"""Type-2 history: both rule sets on a narrow table, and the full customer tables."""

import datetime as dt

import pytest

from shelfline.operators.history import scd2_merge
from shelfline.plans import dimensions
from shelfline.sources import schemas
from tests.conftest import rows

SOURCE = "k long, name string, code long"
SNAPSHOT = SOURCE + ", start_date timestamp_ntz, end_date timestamp_ntz"
JAN, FEB, MAR = (dt.datetime(2000, m, 1) for m in (1, 2, 3))


def merge(spark, snapshot, source, as_of="2000-03-01", mode="null_safe"):
    return scd2_merge(
        spark.createDataFrame(snapshot, SNAPSHOT) if isinstance(snapshot, list) else snapshot,
        spark.createDataFrame(source, SOURCE),
        "k",
        ["k", "name", "code"],
        as_of,
        mode,
        zero_default=["code"],
    )


@pytest.mark.parametrize("mode", ["null_safe", "reference"])
def test_new_changed_and_unchanged_rows(spark, mode):
    snapshot = [(1, "a", 1, JAN, None), (2, "b", 1, JAN, None), (3, "c", 1, JAN, None)]
    source = [(1, "a", 1), (2, "B", 1), (4, "d", 1)]
    assert rows(merge(spark, snapshot, source, mode=mode)) == [
        (1, "a", 1, JAN, None),
        (2, "B", 1, MAR, None),
        (2, "b", 1, JAN, MAR),
        (3, "c", 1, JAN, None),  # gone from the source, still open
        (4, "d", 1, MAR, None),
    ]


@pytest.mark.parametrize("mode", ["null_safe", "reference"])
def test_first_load_opens_every_row(spark, mode):
    result = merge(spark, [], [(1, "a", None), (2, None, 3)], mode=mode)
    assert rows(result) == [(1, "a", None, MAR, None), (2, None, 3, MAR, None)]


def test_same_day_rerun_changes_nothing(spark):
    source = [(1, "a", None), (2, None, 0), (None, "x", 1)]
    once = merge(spark, [(1, "A", 1, JAN, None)], source)
    assert rows(merge(spark, once, source)) == rows(once)


def test_null_to_value_closes_the_old_version(spark):
    snapshot = [(1, None, 1, JAN, None)]
    assert rows(merge(spark, snapshot, [(1, "a", 1)])) == [
        (1, "a", 1, MAR, None),
        (1, None, 1, JAN, MAR),
    ]


def test_reference_rules_leave_two_open_versions_after_null_to_value(spark):
    snapshot = [(1, None, 1, JAN, None)]
    assert rows(merge(spark, snapshot, [(1, "a", 1)], mode="reference")) == [
        (1, "a", 1, MAR, None),
        (1, None, 1, JAN, None),
    ]


def test_reference_rules_insert_a_row_with_a_null_on_every_run(spark):
    once = merge(spark, [], [(1, None, 1)], as_of="2000-02-01", mode="reference")
    twice = merge(spark, once, [(1, None, 1)], mode="reference")
    assert rows(twice) == [(1, None, 1, FEB, None), (1, None, 1, MAR, None)]


def test_reference_rules_take_null_for_zero_in_code_columns(spark):
    snapshot = [(1, "a", None, JAN, None)]
    assert rows(merge(spark, snapshot, [(1, "a", 0)], mode="reference")) == snapshot
    assert len(rows(merge(spark, snapshot, [(1, "a", 0)]))) == 2


def test_return_to_an_earlier_value(spark):
    snapshot = [(1, "a", 1, JAN, FEB), (1, "b", 1, FEB, None)]
    assert rows(merge(spark, snapshot, [(1, "a", 1)])) == [
        (1, "a", 1, JAN, FEB),
        (1, "a", 1, MAR, None),
        (1, "b", 1, FEB, MAR),
    ]
    # The looser rules find the closed version, insert nothing and leave none open.
    assert rows(merge(spark, snapshot, [(1, "a", 1)], mode="reference")) == [
        (1, "a", 1, JAN, FEB),
        (1, "b", 1, FEB, MAR),
    ]


def test_closed_versions_are_closed_again_only_by_the_reference_rules(spark):
    snapshot = [(1, "old", 1, JAN, FEB), (1, "a", 1, FEB, None)]
    assert rows(merge(spark, snapshot, [(1, "a", 1)])) == [
        (1, "a", 1, FEB, None),
        (1, "old", 1, JAN, FEB),
    ]
    assert rows(merge(spark, snapshot, [(1, "a", 1)], mode="reference")) == [
        (1, "a", 1, FEB, None),
        (1, "old", 1, JAN, MAR),
    ]


def test_two_open_versions_heal(spark):
    snapshot = [(1, "a", 1, JAN, None), (1, None, 1, JAN, None)]
    assert rows(merge(spark, snapshot, [(1, "a", 1)])) == [
        (1, "a", 1, JAN, None),
        (1, None, 1, JAN, MAR),
    ]


def test_repeated_source_rows_do_not_multiply_versions(spark):
    snapshot = [(1, "a", 1, JAN, None), (2, "b", 1, JAN, None)]
    source = [(1, "a", 1)] * 3 + [(2, "x", 1), (2, "y", 1)]
    for mode in ("null_safe", "reference"):
        result = rows(merge(spark, snapshot, source, mode=mode))
        assert [r for r in result if r[1] in "ab"] == [
            (1, "a", 1, JAN, None),
            (2, "b", 1, JAN, MAR),
        ]


def test_at_most_one_open_version_per_key_over_many_runs(spark):
    state = spark.createDataFrame([], SNAPSHOT)
    for run in range(4):
        source = [(k, None if (k + run) % 3 == 0 else f"v{(k * run) % 2}", run // 2) for k in range(9)]
        state = merge(spark, state, source, as_of=f"2000-0{run + 1}-01")
        state = spark.createDataFrame(state.collect(), state.schema)
        opened = [r["k"] for r in state.filter("end_date is null").collect()]
        assert sorted(opened) == list(range(9))


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError):
        merge(spark, [], [], mode="loose")


def customer(key, **changes):
    """A customer row; every unnamed column is null but the key."""
    values = {"c_customer_sk": key, **changes}
    return tuple(values.get(name) for name in schemas.CUSTOMER.fieldNames())


def test_every_customer_column_is_compared(spark):
    names = [f for f in schemas.CUSTOMER.fields if f.name != schemas.CUSTOMER_KEY]
    value = {"string": "x", "bigint": 1}
    snapshot = spark.createDataFrame(
        [customer(k) + (JAN, None) for k in range(len(names))], schemas.CUSTOMER_SNAPSHOT
    )
    source = spark.createDataFrame(
        [
            customer(k, **{f.name: value[f.dataType.simpleString()]})
            for k, f in enumerate(names)
        ],
        schemas.CUSTOMER,
    )
    merged = dimensions.customer_scd2(snapshot, source, "2000-03-01")
    assert merged.schema == schemas.CUSTOMER_SNAPSHOT
    assert merged.filter("end_date is null").count() == len(names)
    assert merged.filter("end_date is not null").count() == len(names)


def test_default_run_date_is_today(spark):
    empty = spark.createDataFrame([], schemas.CUSTOMER_SNAPSHOT)
    merged = dimensions.customer_scd2(empty, spark.createDataFrame([customer(1)], schemas.CUSTOMER))
    assert merged.selectExpr("start_date = cast(current_date() as timestamp_ntz)").first()[0]


def test_customer_dim_keeps_versions_that_find_nothing(spark):
    snapshot = spark.createDataFrame(
        [
            customer(1, c_current_addr_sk=10, c_current_cdemo_sk=20, c_current_hdemo_sk=30)
            + (JAN, None),
            customer(2, c_current_addr_sk=11, c_current_hdemo_sk=31) + (JAN, FEB),
        ],
        schemas.CUSTOMER_SNAPSHOT,
    )

    def table(key, attributes, keys, **given):
        names = attributes.fieldNames()
        data = [(k, *(given.get(n) for n in names)) for k in keys]
        ddl = f"{key} long, " + ", ".join(
            f"{f.name} {f.dataType.simpleString()}" for f in attributes.fields
        )
        return spark.createDataFrame(data, ddl)

    dim = dimensions.customer_dim(
        snapshot,
        table("ca_address_sk", schemas.CUSTOMER_ADDRESS_ATTRIBUTES, [10], ca_city="Town"),
        table("cd_demo_sk", schemas.CUSTOMER_DEMOGRAPHICS_ATTRIBUTES, [20], cd_gender="F"),
        table("hd_demo_sk", schemas.HOUSEHOLD_ATTRIBUTES, [30, 31], hd_income_band_sk=5),
        table("ib_income_band_sk", schemas.INCOME_BAND_ATTRIBUTES, [5], ib_lower_bound=100),
    )
    assert dim.columns == schemas.CUSTOMER_DIM.fieldNames()
    assert rows(dim, "c_customer_sk", "ca_city", "cd_gender", "ib_lower_bound") == [
        (1, "Town", "F", 100),
        (2, None, None, 100),
    ]
    assert rows(dimensions.customer_dim_current(dim), "c_customer_sk") == [(1,)]
