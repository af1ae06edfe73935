"""Layouts and first rows without sorting or broadcasting whole sheet rows."""

import contextlib
import io

from sheetloom.operators import normalize as n
from sheetloom.session import written

SCHEMA = "run_id string, source_file string, row_number int, headers array<string>, keys array<string>, cells array<string>"
HEADERS, KEYS = ["Catalogue Name", "Item Code", "Supplier Name"], ["catalogue_name", "item_code", "supplier_name"]


def sheet(spark, rows):
    made = spark.createDataFrame([(run, run + ".csv", no, HEADERS, KEYS, cells) for run, no, cells in rows], SCHEMA)
    return written(made, "sheet")  # a table of known, small size, as the given ones are to the planner


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue().splitlines()


def test_sheet_rows_are_never_the_broadcast_side(spark):
    rows = sheet(spark, [("a", 2, ["Kriti", "S1", None])])
    keyed = n.keyed_rows(rows)
    for df in (n.detect_profiles(rows), keyed, n.build_products(keyed)):
        assert not [line for line in plan(df) if "Broadcast" in line]


def test_whole_rows_are_picked_before_they_are_aggregated(spark):
    rows = sheet(spark, [("a", 2, ["Kriti", "S1", None])])
    lines = plan(n.detect_profiles(rows))
    sorted_at = next(i for i, line in enumerate(lines) if "partial_min_by" in line)
    assert any("Join" in line for line in lines[sorted_at:])


def test_a_long_sheet_keeps_the_layout_of_its_first_row(spark):
    rows = sheet(spark, [("a", 2, ["Kriti", "S1", "Amra Textiles"]), ("a", 70_000, ["Kriti", "S2", None]),
                         ("a", 200_000, ["Noor", "S3", None]), ("b", 140_000, ["Eradi", "S4", None])])
    keyed = n.keyed_rows(rows)
    got = {(r.run_id, r.row_number): (r.profile, r.group_key) for r in keyed.select("run_id", "row_number", "profile", "group_key").collect()}
    assert got == {("a", 2): ("amra_adapter", "Kriti"), ("a", 70_000): ("amra_adapter", "Kriti"),
                   ("a", 200_000): ("amra_adapter", "Noor"), ("b", 140_000): ("generic_tabular", "Eradi")}
    products = {(r.run_id, r.group_key): (r.product_ord, r.row_count) for r in n.build_products(keyed).collect()}
    assert products == {("a", "Kriti"): (2, 2), ("a", "Noor"): (200_000, 1), ("b", "Eradi"): (140_000, 1)}


def test_equal_row_numbers_give_one_layout(spark):
    rows = sheet(spark, [("a", 2, ["Kriti", "S1", None]), ("a", 2, ["Kriti", "S2", None])])
    assert n.detect_profiles(rows).count() == 1
    assert n.keyed_rows(rows).count() == 2
    assert [r.row_count for r in n.build_products(n.keyed_rows(rows)).collect()] == [2]
