"""Every registered query against its SQL, and the plans of the ones that matter at scale."""

import re

import pytest

import __spark_entry__ as entry
from filingmill.plans import catalog, oracle
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(catalog.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, duck, name):
    assert difference(duck, catalog.queries()[name](spark, FOLDER), oracle.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[-1] == "qoq_growth_rank" and df.count() == 1203


def planned(spark, name):
    return entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


RELATIONAL = {
    "dedupe", "clean", "quarantine", "scd2", "fct", "mart", "dim", "dq", "bank", "state", "load",
}
LAZY = [name for name in catalog.queries() if name.split("_")[0] in RELATIONAL]


@pytest.mark.parametrize("name", LAZY)
def test_no_plan_multiplies_rows_or_leaves_the_jvm(spark, name):
    plan = planned(spark, name)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python", plan)


@pytest.mark.parametrize("name", ["dedupe_financials", "dedupe_branches", "scd2_history"])
def test_repeated_deliveries_are_pruned_before_the_shuffle(spark, name):
    assert planned(spark, name).count("WindowGroupLimit") >= 2


def test_a_join_on_part_of_the_key_does_not_replace_the_shuffle_by_all_of_it(spark):
    limits = planned(spark, "scd2_history").split("WindowGroupLimit")
    assert re.search(r"hashpartitioning\(cert#\d+L?, snapshot_date#\d+", limits[1])


def test_periods_are_pruned_by_folder(spark):
    assert re.search(r"PartitionFilters: \[.*dt#", planned(spark, "period_range"))


@pytest.mark.parametrize(
    "name", ["mart_asset_growth", "mart_deposit_concentration", "fct_financials", "scd2_history"]
)
def test_no_mart_is_built_in_one_task(spark, name):
    assert "SinglePartition" not in planned(spark, name)


def test_growth_rank_has_no_window_over_a_whole_date(spark):
    plan = planned(spark, "mart_asset_growth")
    over_dates = re.findall(r"Window \[([a-z]+)\([^]]*\], \[repdte#\d+\]", plan)
    assert set(over_dates) == {"sum"}  # only over the counts per bin


def test_one_institutions_key_reaches_the_scan(spark):
    plan = planned(spark, "institution_financials")
    assert re.search(r"DataFilters: \[[^]]*o_custkey#\d+L?\W+= 7|o_custkey#\d+L = 7", plan)


def test_only_the_needed_columns_are_read(spark):
    plan = planned(spark, "bank_state_deposits")
    assert "l_discount" not in plan and "o_orderstatus" not in plan
