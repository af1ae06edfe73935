"""Queries that begin with the same products and variants: none of their own steps is planned as a broadcast."""

import contextlib
import importlib
import io

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from sheetloom.operators import normalize as n
from sheetloom.plans import bindings as b
from sheetloom.plans import normalise_queries as nq
from sheetloom.plans.catalogue import QUERIES

SMALL = "/root/testdata/sf0.001"
PLANS = [importlib.import_module(f"sheetloom.plans.{m}_queries") for m in ("normalise", "io", "match", "review", "run")]
NAMES = [
    "hosted_status", "match_product_scope", "product_number",
    "export_canonical_flat",
    "export_canonical_nested",
    "export_import26",
    "export_store_import",
    "field_provenance",
    "hero_and_gallery",
    "match_scoped_tokens",
    "match_sequence_index",
    "match_unscoped_facts",
    "positional_image_fallback",
]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Folder of the keyed rows, products and variants, made once for all these queries."""
    folder = str(tmp_path_factory.mktemp("made"))
    keyed = nq._written_keyed(spark, SMALL)
    products = n.build_products(keyed)
    for name, df in (("keyed", keyed), ("products", products), ("variants", n.build_variants(keyed, products))):
        df.write.parquet(f"{folder}/{name}")
    return folder


def spied(monkeypatch):
    """Lines of a broadcast in the plans of tables that are written from here on."""
    found, write = [], DataFrameWriter.parquet

    def spy(self, path, *args, **kwargs):
        found.extend(planned(self._df))
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    return found


@pytest.fixture
def fresh(spark):
    """A session whose thresholds nobody has set."""
    other = spark.newSession()
    other.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    other.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    return other


def planned(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return [line for line in text.getvalue().splitlines() if "Broadcast" in line]


@pytest.mark.parametrize("name", NAMES)
def test_no_step_goes_through_the_driver_by_its_size_on_disk(fresh, made, monkeypatch, name):
    def read(session, sf, *tables):
        b.table(session, sf, "part")  # as the step that is left out does
        return [session.read.parquet(f"{made}/{t}") for t in tables]

    for plans in PLANS:
        if hasattr(plans, "products_variants"):
            monkeypatch.setattr(plans, "products_variants", lambda s, sf: tuple(read(s, sf, "products", "variants")))
    monkeypatch.setattr(nq, "_written_keyed", lambda s, sf: read(s, sf, "keyed")[0])
    found = spied(monkeypatch)
    found.extend(planned(QUERIES[name](fresh, SMALL)))
    assert not found


def test_the_rows_that_merge_attributes_begins_with_do_not_either(fresh, monkeypatch):
    found = spied(monkeypatch)
    found.extend(planned(QUERIES["merge_attributes"](fresh, SMALL)))
    assert not found
