"""No step that a query writes on its way is planned as a broadcast either."""

import contextlib
import io

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from sheetloom.plans.catalogue import QUERIES

SMALL = "/root/testdata/sf0.001"


def planned(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return [line for line in text.getvalue().splitlines() if "Broadcast" in line]


@pytest.mark.parametrize("name", ["catalogue_report", "expand_placeholders", "check_manifest"])
def test_steps_are_not_planned_as_broadcasts(spark, monkeypatch, name):
    fresh = spark.newSession()
    fresh.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    fresh.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    found, steps, write = [], [], DataFrameWriter.parquet

    def spy(self, path, *args, **kwargs):
        steps.append(path)
        found.extend(planned(self._df))
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    found.extend(planned(QUERIES[name](fresh, SMALL)))
    assert steps and not found
