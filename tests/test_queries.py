"""Registered queries against their SQL in DuckDB on the smallest given tables."""

import decimal
import math
from pathlib import Path

import pytest

import __spark_entry__ as driver
from sheetloom.plans import catalogue

SMALL = Path("/root/testdata/sf0.001")
SAMPLE = ["catalogue_report", "build_products", "build_variants_wholesale", "expand_placeholders", "merge_attributes",
          "dq_all", "validation_summary", "match_all", "match_candidates", "gallery_order", "all_facts", "reconcile_prices", "enrich_variants",
          "dominant_colour", "upload_collisions", "merge_conflicts", "consolidation_summary", "scan_catalogue_cells",
          "export_import26", "export_canonical_nested", "run_catalogue", "run_store_import", "run_refined", "run_totals", "read_manifest", "apply_review_decisions", "read_canonical_nested", "canonical_summary", "create_manifest", "run_uploads", "hero_and_gallery", "export_canonical_flat", "dq_shared_supplier_sku", "validate_batch_manifest", "run_metrics"]

pytestmark = pytest.mark.skipif(not SMALL.exists(), reason="given tables are absent")


def test_every_query_has_a_counterpart():
    assert set(catalogue.ORACLE) == set(catalogue.QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def _value(x):
    if isinstance(x, decimal.Decimal):
        x = float(x)
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9)
    return x


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str([_value(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in SMALL.glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, str(SMALL))
    result = duck.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, result.fetchall())
