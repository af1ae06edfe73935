"""No side of a join goes through the driver because its file is small."""

import contextlib
import io

import pytest

from sheetloom.plans import bindings as b
from sheetloom.plans.catalogue import QUERIES
from sheetloom.session import broadcast_by_measure

PLANNED, ADAPTIVE = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def fresh(spark):
    """A session whose thresholds nobody has set."""
    other = spark.newSession()
    other.conf.unset(PLANNED), other.conf.unset(ADAPTIVE)
    return other


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue().splitlines()


def test_a_small_file_is_no_reason_to_plan_a_broadcast_but_a_small_measure_is(fresh):
    orders, parts = b.table(fresh, SMALL, "orders"), b.table(fresh, SMALL, "part")
    joined = orders.join(parts, orders.o_custkey == parts.p_partkey)
    assert [line for line in plan(joined) if "SortMergeJoin" in line]
    joined.collect()
    assert [line for line in plan(joined) if "BroadcastHashJoin" in line]


@pytest.mark.parametrize("name", ["hero_and_gallery", "match_exact_identity"])
def test_written_tables_are_not_planned_as_broadcasts(fresh, name):
    assert not [line for line in plan(QUERIES[name](fresh, SMALL)) if "Broadcast" in line]


def test_the_callers_threshold_is_kept(fresh):
    fresh.conf.set(PLANNED, "123k")
    broadcast_by_measure(fresh)
    broadcast_by_measure(fresh)
    assert (fresh.conf.get(PLANNED), fresh.conf.get(ADAPTIVE)) == ("-1", "123k")
    fresh.conf.set(PLANNED, "1m")
    fresh.conf.set(ADAPTIVE, "2m")
    broadcast_by_measure(fresh)
    assert (fresh.conf.get(PLANNED), fresh.conf.get(ADAPTIVE)) == ("-1", "2m")
