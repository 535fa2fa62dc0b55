"""Marts brought up to date against marts built anew, and what their plans read."""

import datetime as dt
import random

import pytest

from filingmill.operators import marts, propagate
from filingmill.plans.quality import changed_rows

QUARTERS = [dt.date(2020 + k // 4, 3 * (k % 4) + 1, 1) for k in range(12)]
FACT = "cert long, repdte date, stalp string, bkclass string, asset double, roa double, roe double"
BRANCH = "cert long, uninumbr long, stalpbr string, depsumbr double, repdte date"
NAMES = ["latest_financials", "profitability_trends", "asset_growth"]


def facts(rng, certs, dates, rows=None):
    kept = {k: v for k, v in (rows or {}).items() if k[1] not in dates}
    new = {(c, d): (rng.choice("AB"), "N", float(rng.randrange(5)), rng.random(), None) for c in certs for d in dates}
    return kept | {k: v for k, v in new.items() if rng.random() < 0.7}


def frame(spark, rows):
    return spark.createDataFrame([(*k, *v) for k, v in sorted(rows.items())], FACT)


@pytest.mark.parametrize("days", [[0], [5], [11], [2, 3, 9]])
def test_equal_to_marts_built_anew(spark, tmp_path, days):
    rng = random.Random(sum(days))
    before = facts(rng, range(40), QUARTERS)
    dates = [QUARTERS[d] for d in days]
    after = facts(rng, range(45), dates, before)
    old, new = frame(spark, before), frame(spark, after)
    for name in NAMES:
        mart = getattr(marts, name)(old)
        expected = getattr(marts, name)(new)
        assert changed_rows(expected, getattr(propagate, name)(mart, old, new, dates)).collect() == [], name


def test_nothing_changed_and_everything_gone(spark):
    rows = facts(random.Random(1), range(10), QUARTERS[:3])
    old, none = frame(spark, rows), frame(spark, rows).limit(0)
    for name in NAMES:
        mart = getattr(marts, name)(old)
        assert changed_rows(mart, getattr(propagate, name)(mart, old, old, QUARTERS[:3])).count() == 0
        assert getattr(propagate, name)(mart, old, none, QUARTERS[:3]).count() == 0


def test_shares_by_state(spark):
    rng = random.Random(2)
    rows = [(c, u, rng.choice(["A", "B", None]), float(rng.randrange(9)), d) for c in range(8) for u in range(6) for d in QUARTERS[:3]]
    late = [r for r in rows if r[4] != QUARTERS[1]]
    late += [(*r[:3], r[3] + (r[2] == "A"), r[4]) for r in rows if r[4] == QUARTERS[1] and r[1] != 5]
    old, new = (spark.createDataFrame(x, BRANCH) for x in (rows, late))
    mart = marts.deposit_concentration(old)
    found = propagate.deposit_concentration(mart, old, new, [QUARTERS[1]])
    key = ["cert", "state", "repdte"]
    assert found.select(*key).exceptAll(marts.deposit_concentration(new).select(*key)).count() == 0
    want = {(r.cert, r.state, r.repdte): r for r in marts.deposit_concentration(new).collect()}
    assert len(want) == found.count()
    for r in found.collect():
        assert r.deposit_share == pytest.approx(want[r.cert, r.state, r.repdte].deposit_share)
        assert r.state_hhi == pytest.approx(want[r.cert, r.state, r.repdte].state_hhi)


def test_only_the_dates_concerned_are_compared(spark, tmp_path):
    """Folders of other dates are pruned where facts are compared and where ranks are counted."""
    rows = facts(random.Random(3), range(30), QUARTERS)
    for name, df in (("fact", frame(spark, rows)), ("mart", marts.asset_growth(frame(spark, rows)))):
        df.write.partitionBy("repdte").parquet(str(tmp_path / name))
    fact, mart = (spark.read.parquet(str(tmp_path / name)) for name in ("fact", "mart"))
    changed = propagate.changed_keys(fact, fact, [QUARTERS[10]], ["cert", "repdte"])
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [repdte") + plan.count("PartitionFilters: [isnotnull(repdte") >= 2
    after = fact.withColumn("asset", propagate.F.when(fact.repdte == QUARTERS[10], 1.0).otherwise(fact.asset))
    found = propagate.asset_growth(mart.select(*marts.asset_growth(after).columns), fact, after, [QUARTERS[10]])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "repdte" in plan and "NOT repdte" in plan
    assert changed_rows(marts.asset_growth(after), found).count() == 0


def test_facts_are_compared_once(spark, tmp_path):
    """The plan that is left reads stored rows: neither the compared facts nor the growth of what changed."""
    rows = facts(random.Random(4), range(30), QUARTERS)
    late = facts(random.Random(5), range(30), [QUARTERS[6]], rows)
    for name, kept in (("old", rows), ("new", late)):
        frame(spark, kept).write.parquet(str(tmp_path / name))
    old, new = (spark.read.parquet(str(tmp_path / name)) for name in ("old", "new"))
    marts.asset_growth(old).write.parquet(str(tmp_path / "mart"))
    found = propagate.asset_growth(spark.read.parquet(str(tmp_path / "mart")), old, new, [QUARTERS[6]])
    files = list(found.inputFiles())
    assert not any(f"/{name}/" in file for file in files for name in ("old", "new"))
    assert any("/mart/" in file for file in files)
    assert changed_rows(marts.asset_growth(new), found).count() == 0


def test_a_change_that_a_mart_does_not_hold_reaches_nothing(spark):
    rows = facts(random.Random(6), range(10), QUARTERS[:6])
    old = frame(spark, rows)
    new = old.withColumn("roa", propagate.F.col("roa") + 1)
    assert propagate._reached(old, new, QUARTERS[:6], ["asset"], 4).count() == 0
    assert propagate._reached(old, new, QUARTERS[:6], ["roa", "roe"], 1).count() == len(rows)
