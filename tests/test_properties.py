"""Operators against plain Python on generated data."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from filingmill.operators.asof import join_as_of
from filingmill.operators.dedupe import latest_per_key
from filingmill.operators.marts import asset_growth_unranked, deposit_concentration, latest_financials
from filingmill.operators.quarantine import clean_tagged, rejected
from filingmill.operators.scd2 import build_history
from filingmill.plans.quality import changed_rows, overlapping_windows
from filingmill.schemas import HISTORY
from filingmill.sources.warehouse import typed

few = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=n) for n in range(8)]
ONE_DAY = dt.timedelta(days=1)

keys = st.sampled_from([1, 2, None])
small = st.integers(0, 3)
delivery = st.tuples(keys, st.sampled_from(["a", None]), small, small, st.integers(-2, 9))
DELIVERY = "k int, p string, _ingested_at string, _batch_id string, v double"


def deliveries(spark, rows):
    return spark.createDataFrame([(k, p, str(a), str(b), float(v)) for k, p, a, b, v in rows], DELIVERY)


def winners(rows):
    best = {}
    for k, p, a, b, v in rows:
        best[k, p] = max(best.get((k, p), (-1, -1, -9)), (a, b, v))
    return best


@few
@given(st.lists(delivery, min_size=1, max_size=40))
def test_dedupe_keeps_the_greatest_delivery(spark, rows):
    out = latest_per_key(deliveries(spark, rows).repartition(3), ["k", "p"]).collect()
    got = {(r.k, r.p): (int(r._ingested_at), int(r._batch_id), r.v) for r in out}
    assert len(out) == len(got) and got == winners(rows)


@few
@given(st.lists(delivery, min_size=1, max_size=40))
def test_no_reject_is_lost(spark, rows):
    tagged = clean_tagged(deliveries(spark, rows), ["k", "p"], ["v"], keep_all_rejects=True)
    keyless = sum(k is None or p is None for k, p, *_ in rows)
    negative = sum(w[2] < 0 for key, w in winners(rows).items() if None not in key)
    assert rejected(tagged).count() == keyless + negative


snapshot = st.tuples(st.sampled_from([1, 2]), st.sampled_from(DAYS), st.sampled_from(["A", "B", "", None]))
SNAPSHOT = "cert long, snapshot_date date, name string, city string, state string, bkclass string, regagnt string, holding_company string"


def snapshots(spark, seen):
    return spark.createDataFrame([(c, d, n, "c", "s", "b", None, None) for (c, d), n in seen.items()], SNAPSHOT)


def versions_of(seen):
    """`{cert: [(first day, name)]}` where null and empty names are the same."""
    found = defaultdict(list)
    for (cert, day), name in sorted(seen.items(), key=lambda item: item[0]):
        if not found[cert] or found[cert][-1][1] != (name or ""):
            found[cert].append((day, name or ""))
    return found


@few
@given(st.lists(snapshot, min_size=1, max_size=16))
def test_history_and_the_versions_facts_take(spark, rows):
    seen = {(cert, day): name for cert, day, name in rows}
    expected = versions_of(seen)
    history = typed(build_history(snapshots(spark, seen)), HISTORY, "yyyy-MM-dd")
    got = defaultdict(list)
    for r in history.orderBy("cert", "valid_from").collect():
        got[r.cert].append(r)
    assert {c: [v.name or "" for v in vs] for c, vs in got.items()} == {
        c: [name for _, name in vs] for c, vs in expected.items()
    }
    for cert, versions in got.items():
        starts = [day for day, _ in expected[cert]]
        assert [v.valid_from for v in versions] == [dt.date(1900, 1, 1), *starts[1:]]
        assert [v.valid_to for v in versions] == [*(d - ONE_DAY for d in starts[1:]), dt.date(9999, 12, 31)]
        assert [v.is_current for v in versions] == [False] * (len(starts) - 1) + [True]
    assert overlapping_windows(history, touching=True).count() == 0

    facts = spark.createDataFrame([(c, d) for c in (1, 2, 3) for d in DAYS], "cert long, repdte date")
    named = join_as_of(facts, history, "cert", "repdte", {"name": "name", "is_current": "found"}).collect()
    assert len(named) == 3 * len(DAYS)
    for r in named:
        valid = [name for k, (day, name) in enumerate(expected.get(r.cert, [])) if k == 0 or day <= r.repdte]
        assert (r.found is not None) == bool(valid) and (not valid or (r.name or "") == valid[-1])


window = st.tuples(st.sampled_from([1, 2]), st.integers(0, 7), st.integers(0, 4))


@few
@given(st.lists(window, min_size=1, max_size=12, unique_by=lambda w: w[:2]))
def test_overlaps_equal_the_comparison_of_all_pairs(spark, rows):
    spans = [(c, DAYS[0] + ONE_DAY * a, DAYS[0] + ONE_DAY * (a + n)) for c, a, n in rows]
    df = spark.createDataFrame(spans, "cert long, valid_from date, valid_to date")
    for touching in (False, True):
        expected = {
            (c, a)
            for c, a, _ in spans
            for other, x, y in spans
            if other == c and x < a and (a <= y if touching else a < y)
        }
        assert {(r.cert, r.valid_from) for r in overlapping_windows(df, touching).collect()} == expected


fact = st.tuples(st.sampled_from([1, 2]), st.integers(0, 7), st.integers(-2, 3))


@few
@given(st.lists(fact, min_size=1, max_size=14, unique_by=lambda f: f[:2]))
def test_growth_and_latest(spark, rows):
    df = spark.createDataFrame(
        [(c, DAYS[d], "s", "b", float(a)) for c, d, a in rows],
        "cert long, repdte date, stalp string, bkclass string, asset double",
    )
    series = defaultdict(list)
    for c, d, a in sorted(rows):
        series[c].append((DAYS[d], float(a)))

    def change(values, k, back):
        prior = values[k - back][1] if k >= back else 0
        return (values[k][1] - prior) / prior if prior else None

    expected = {
        (c, vs[k][0]): (change(vs, k, 1), change(vs, k, 4)) for c, vs in series.items() for k in range(len(vs))
    }
    got = {(r.cert, r.repdte): (r.asset_growth_qoq, r.asset_growth_yoy) for r in asset_growth_unranked(df).collect()}
    assert got == expected
    latest = {r.cert: (r.latest_repdte, r.latest_asset) for r in latest_financials(df).collect()}
    assert latest == {c: vs[-1] for c, vs in series.items()}


branch = st.tuples(st.sampled_from([1, 2, 3]), st.sampled_from(["VA", "TX", None]), st.integers(0, 5))


@few
@given(st.lists(branch, min_size=1, max_size=20))
def test_concentration(spark, rows):
    df = spark.createDataFrame(
        [(c, s, DAYS[0], float(d)) for c, s, d in rows], "cert long, stalpbr string, repdte date, depsumbr double"
    )
    banks, totals = defaultdict(float), defaultdict(float)
    for c, s, d in rows:
        if s is not None:
            banks[c, s] += d
            totals[s] += d
    out = {(r.cert, r.state): r for r in deposit_concentration(df).collect()}
    assert out.keys() == banks.keys()
    for (c, s), r in out.items():
        if totals[s] == 0:
            assert r.deposit_share is None and r.state_hhi is None
            continue
        shares = [d / totals[s] for (_, state), d in banks.items() if state == s]
        assert abs(r.deposit_share - banks[c, s] / totals[s]) < 1e-12
        assert abs(r.state_hhi - 10000 * sum(x * x for x in shares)) < 1e-6


@few
@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), min_size=1, max_size=12))
def test_changed_rows(spark, before, after):
    a, b = (spark.createDataFrame([(v,) for v in rows], "v int") for rows in (before, after))
    got = {r.v: r.copies if r.change == "added" else -r.copies for r in changed_rows(a, b).collect()}
    assert got == {v: n for v in range(4) if (n := after.count(v) - before.count(v))}
