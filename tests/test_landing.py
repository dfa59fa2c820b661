"""Landing files: what loads, what is set aside and why."""

import pytest

from shelfline.sources import landing
from shelfline.sources.schemas import INVENTORY, INVENTORY_REQUIRED
from tests.conftest import rows

LINES = {
    "inv_date_sk,inv_item_sk,inv_quantity_on_hand,inv_warehouse_sk": "unreadable value",
    "1,2,3,4": (1, 2, 3, 4),
    "1,3,,4": (1, 3, None, 4),
    " 1 ,4, 3,4": (1, 4, 3, 4),
    "1,5,3.5,4": (1, 5, 4, 4),
    "1,6,-2,4": (1, 6, -2, 4),
    "1,x,3,4": "unreadable value",
    '"1",2,3,4': "unreadable value",
    "1,7,99999999999999999999,4": "unreadable value",
    "1,2,3": "field count",
    "1,2,3,4,5": "field count",
    "1,2,3,4,": "field count",
    "": "field count",
    ",2,3,4": "required value missing",
    "1,,3,4": "required value missing",
    "1,2,3,": "required value missing",
}
GOOD = sorted((v for v in LINES.values() if isinstance(v, tuple)), key=str)


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    lines = list(LINES)
    (folder / "a.csv").write_text("\n".join(lines[:8]) + "\n")
    (folder / "b.csv").write_text("\n".join(lines[8:]) + "\n")
    return str(folder)


def test_good_rows(spark, path):
    good, _ = landing.load_csv(spark, path, INVENTORY, INVENTORY_REQUIRED)
    assert [f.dataType for f in good.schema] == [f.dataType for f in INVENTORY]
    assert sorted((tuple(r) for r in good.collect()), key=str) == GOOD


def test_rejects_keep_line_reason_and_file(spark, path):
    _, rejects = landing.load_csv(spark, path, INVENTORY, INVENTORY_REQUIRED)
    expected = sorted((line, v) for line, v in LINES.items() if isinstance(v, str))
    assert rows(rejects, "line", "reason") == expected
    assert {r[0].rsplit("/", 1)[1] for r in rows(rejects, "file_path")} == {"a.csv", "b.csv"}


def test_counts_do_not_depend_on_the_columns_read(spark, path):
    good, rejects = landing.load_csv(spark, path, INVENTORY, INVENTORY_REQUIRED)
    assert good.count() == len(GOOD) == good.select("inv_item_sk").count()
    assert rejects.count() == len(LINES) - len(GOOD)


def test_audit_counts_lines_per_file(spark, path):
    audit = landing.load_audit(spark, path, INVENTORY, INVENTORY_REQUIRED)
    found = {r["file_path"].rsplit("/", 1)[1]: tuple(r)[1:] for r in audit.collect()}
    # The first file holds the header, five good lines and two unreadable ones.
    assert found == {"a.csv": (8, 5, 3), "b.csv": (8, 0, 8)}


def test_other_separators_and_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text("'1'|2|3|4\n")
    good, _ = landing.load_csv(
        spark, str(tmp_path), INVENTORY, INVENTORY_REQUIRED, sep="|", quote="'"
    )
    assert rows(good) == [(1, 2, 3, 4)]


def test_no_required_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",,,\n")
    good, _ = landing.load_csv(spark, str(tmp_path), INVENTORY)
    assert rows(good) == [(None, None, None, None)]


def test_one_parse_gives_rows_rejects_audit_and_counts(spark, path, tmp_path):
    target = str(tmp_path / "stage")
    staged = landing.stage(spark, path, target, INVENTORY, INVENTORY_REQUIRED)
    good, rejects = landing.load_csv(spark, path, INVENTORY, INVENTORY_REQUIRED)
    assert rows(staged.good) == rows(good) and staged.good.columns == INVENTORY.fieldNames()
    assert rows(staged.rejects) == rows(rejects)
    assert rows(staged.audit) == rows(landing.load_audit(spark, path, INVENTORY, INVENTORY_REQUIRED))
    n = len(LINES)
    assert staged.counts == {"rows_read": n, "rows_loaded": len(GOOD), "rows_rejected": n - len(GOOD)}
    for df in (staged.good, staged.rejects, staged.audit):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" not in plan and "FileScan parquet" in plan
    # Good rows are read from their own folder, without the text of rejected lines.
    plan = staged.good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(outcome" in plan and "line" not in plan.split("ReadSchema")[1]


def test_stage_of_nothing(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    staged = landing.stage(spark, str(tmp_path / "empty.csv"), str(tmp_path / "stage"), INVENTORY)
    assert staged.good.count() == staged.rejects.count() == staged.audit.count() == 0
    assert staged.counts == {"rows_read": 0, "rows_loaded": 0, "rows_rejected": 0}
