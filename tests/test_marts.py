"""Marts and ranks against plain computations, including groups and values that are hot."""

import datetime as dt
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filingmill.operators import marts
from filingmill.operators.ranking import BINS, _bin, _edges, rank_descending, ranked_page

FACT = (
    "institution_sk string, cert long, repdte date, stalp string, bkclass string, "
    "asset double, roa double, roe double"
)
QUARTERS = [dt.date(2024, 3, 31), dt.date(2024, 6, 30), dt.date(2024, 9, 30), dt.date(2024, 12, 31), dt.date(2025, 3, 31)]


def facts(spark, assets):
    """One institution per list, its assets on consecutive quarters."""
    rows = [
        ("sk", cert, QUARTERS[k], "VA", "N", asset, asset, asset)
        for cert, series in assets.items()
        for k, asset in enumerate(series)
    ]
    return spark.createDataFrame(rows, FACT)


def test_growth_over_previous_and_fourth_previous_report(spark):
    rows = marts.asset_growth(facts(spark, {1: [100.0, 110.0, 0.0, 50.0, 200.0]})).orderBy("repdte").collect()
    assert [r.asset_growth_qoq for r in rows] == [None, pytest.approx(0.1), -1.0, None, 3.0]
    assert [r.asset_growth_yoy for r in rows] == [None] * 4 + [1.0]


def test_growth_rank_shares_ties_and_puts_unknown_growth_last(spark):
    fact = facts(spark, {1: [100.0, 150.0], 2: [10.0, 15.0], 3: [10.0, 11.0], 4: [0.0, 5.0]})
    ranks = {r.cert: r.qoq_growth_rank for r in marts.asset_growth(fact).filter("repdte = '2024-06-30'").collect()}
    assert ranks == {1: 1, 2: 1, 3: 3, 4: 4}


def test_profitability_change(spark):
    rows = marts.profitability_trends(facts(spark, {1: [1.0, 3.0], 2: [5.0]})).orderBy("cert", "repdte").collect()
    assert [(r.cert, r.roa_qoq_change) for r in rows] == [(1, None), (1, 2.0), (2, None)]


def test_latest_report_may_be_an_old_one(spark):
    rows = marts.latest_financials(facts(spark, {1: [1.0, 2.0], 2: [7.0], 3: [4.0, None]})).collect()
    assert {r.cert: (r.latest_repdte, r.latest_asset) for r in rows} == {
        1: (QUARTERS[1], 2.0), 2: (QUARTERS[0], 7.0), 3: (QUARTERS[1], None),
    }


def test_concentration(spark):
    day = dt.date(2024, 6, 30)
    rows = [(1, "VA", day, 30.0), (1, "VA", day, 30.0), (2, "VA", day, 40.0), (3, None, day, 9.0), (4, "DC", day, 0.0)]
    df = spark.createDataFrame(rows, "cert long, stalpbr string, repdte date, depsumbr double")
    out = {r.cert: r for r in marts.deposit_concentration(df).collect()}
    assert set(out) == {1, 2, 4}
    assert out[1].deposit_share == pytest.approx(0.6) and out[2].deposit_share == pytest.approx(0.4)
    assert out[1].state_hhi == pytest.approx(5200.0)
    assert out[4].deposit_share is None and out[4].state_hhi is None


def expected_ranks(rows):
    """Ranks by comparing every pair: null after NaN after numbers."""

    def key(v):
        return (0, 0.0) if v is None else (1, 0.0) if math.isnan(v) else (2, v)

    return sorted(
        (g is None, g or 0, str(v), 1 + sum(key(w) > key(v) for h, w in rows if h == g)) for g, v in rows
    )


def actual_ranks(spark, rows):
    df = spark.createDataFrame(rows, "g int, v double")
    out = rank_descending(df, ["g"], "v", "rank").collect()
    return sorted((r.g is None, r.g or 0, str(r.v), r["rank"]) for r in out)


VALUES = st.one_of(
    st.none(),
    st.sampled_from([0.0, 1.0, -1.0, 1e-9, -1e-9, math.inf, -math.inf, math.nan]),
    st.floats(min_value=-1e300, max_value=1e300).map(lambda v: v + 0.0),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([1, 2, None]), VALUES), min_size=1, max_size=40))
def test_rank_equals_pairwise_count(spark, rows):
    assert actual_ranks(spark, rows) == expected_ranks(rows)


def test_rank_with_a_hot_group_and_a_hot_value(spark):
    rng = random.Random(5)
    rows = [(1, 0.0)] * 400 + [(1, rng.uniform(-1, 1)) for _ in range(400)] + [(2, rng.random()) for _ in range(50)]
    rows += [(1, None)] * 200
    assert actual_ranks(spark, rows) == expected_ranks(rows)


def test_pages_of_a_ranking_join_up_to_the_whole(spark):
    rng = random.Random(7)
    rows = [(n, float(rng.randint(0, 9))) for n in range(60)]
    df = spark.createDataFrame(rows, "cert long, value double")
    whole = [(r["rank"], r.cert) for r in ranked_page(df, "value", "cert", 60, 0).collect()]
    pages = [
        (r["rank"], r.cert) for k in range(0, 60, 17) for r in ranked_page(df, "value", "cert", 17, k).collect()
    ]
    assert pages == whole
    ordered = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert whole == [(1 + sum(w > v for _, w in rows), c) for c, v in ordered]


@pytest.mark.parametrize("ties", [5, 400])
def test_deep_pages_are_the_same_without_gathering_what_comes_before(spark, ties):
    rng = random.Random(11)
    rows = [(n, rng.choice([None, float("nan"), *map(float, range(4))]) if n < ties else rng.random()) for n in range(500)]
    df = spark.createDataFrame(rows, "cert long, value double")
    for limit, offset in [(40, 0), (37, 210), (50, 470), (10, 600)]:
        near, deep = (
            [(r["rank"], r.cert) for r in ranked_page(df, "value", "cert", limit, offset, most_kept=most).collect()]
            for most in (10_000, 0)
        )
        assert near == deep


def test_bins_follow_the_data(spark):
    """100,000 values inside a thousandth: a bin holds its share of them, not all."""
    df = spark.range(100_000).selectExpr("1 g", "1 + id / 1e8 value")
    edges = df.agg(_edges(F.col("value")).alias("e"))
    sizes = df.join(edges).groupBy(_bin(F.col("value"), F.col("e"))).count()
    assert sizes.agg(F.max("count")).first()[0] < 3 * 100_000 / BINS
    last = rank_descending(df, ["g"], "value", "rank").agg(F.max("rank"), F.count_distinct("rank")).first()
    assert tuple(last) == (100_000, 100_000)


def test_bins_count_the_edges_below(spark):
    """Also with fewer edges than bins, equal ones, or none at all."""
    rng = random.Random(13)
    lists = [sorted(rng.choice([-math.inf, math.inf, *map(float, range(50))]) for _ in range(n)) for n in (63, 63, 40, 1, 0)]
    values = [-math.inf, math.inf, 0.0, -0.0, *(k / 2 for k in range(-2, 101)), None, math.nan]
    rows = [(value, edges) for value in values for edges in [*lists, None]]
    df = spark.createDataFrame(rows, "v double, e array<double>")
    for r in df.withColumn("bin", _bin(F.col("v"), F.col("e"))).collect():
        expected = -2 if r.v is None else -1 if math.isnan(r.v) else sum(edge < r.v for edge in r.e or [])
        assert r.bin == expected


def test_counts_of_a_ranking_are_shuffled_once(spark, tmp_path):
    """The quantiles read the counts that the ranks are made of, so what is ranked is computed for both at once."""
    rng = random.Random(17)
    spark.createDataFrame([(n % 3, rng.random()) for n in range(300)], "g int, v double").write.parquet(str(tmp_path / "rows"))
    ranked = rank_descending(spark.read.parquet(str(tmp_path / "rows")), ["g"], "v", "rank")
    assert ranked.collect()
    plan = ranked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 2
