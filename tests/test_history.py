"""Validity windows and the joins against them."""

import datetime as dt
import hashlib

from filingmill.operators.asof import join_as_of
from filingmill.operators.projection import project_snapshots
from filingmill.operators.scd2 import build_history, rejected_snapshots
from filingmill.plans.models import dim_institution, fct_financials
from filingmill.plans.quality import overlapping_windows
from filingmill.schemas import FINANCIALS, HISTORY
from filingmill.sources.warehouse import typed

SNAPSHOT = (
    "CERT long, dt string, NAME string, CITY string, STALP string, BKCLASS string, "
    "REGAGNT string, NAMEHCR string"
)


def history(spark, *rows):
    full = [(cert, day, name, city, "VA", "N", "OCC", None) for cert, day, name, city in rows]
    return build_history(project_snapshots(spark.createDataFrame(full, SNAPSHOT)))


def windows(df):
    return [(r.name, r.valid_from, r.valid_to, r.is_current) for r in df.orderBy("cert", "valid_from").collect()]


def test_single_snapshot_is_open_on_both_sides(spark):
    assert windows(history(spark, (1, "20260731", "A", "X"))) == [("A", "1900-01-01", "9999-12-31", True)]


def test_unchanged_snapshots_are_one_version(spark):
    assert len(windows(history(spark, (1, "20250101", "A", "X"), (1, "20260101", "A", "X")))) == 1


def test_a_change_closes_the_old_version_the_day_before(spark):
    assert windows(history(spark, (1, "20250101", "A", "X"), (1, "20260731", "B", "X"))) == [
        ("A", "1900-01-01", "2026-07-30", False),
        ("B", "2026-07-31", "9999-12-31", True),
    ]


def test_going_back_to_old_values_is_a_third_version(spark):
    rows = [(1, "20250101", "A", "X"), (1, "20250201", "B", "X"), (1, "20250301", "A", "X")]
    assert [w[0] for w in windows(history(spark, *rows))] == ["A", "B", "A"]


def test_null_and_empty_are_the_same_value(spark):
    rows = [(1, "20250101", "A", None), (1, "20250201", "A", ""), (1, "20250301", "A", None)]
    assert len(windows(history(spark, *rows))) == 1


def test_repeated_and_keyless_snapshots(spark):
    rows = [(1, "20250101", "A", "X"), (1, "20250101", "B", "X"), (None, "20250101", "C", "X")]
    assert len(windows(history(spark, *rows))) == 1
    full = [(*row[:3], row[3], "VA", "N", None, None) for row in rows]
    lost = rejected_snapshots(project_snapshots(spark.createDataFrame(full, SNAPSHOT)))
    assert [(r.name, r._reject_reason) for r in lost.collect()] == [("C", "missing_key")]


def test_days_that_lack_a_field_or_stamps_still_union(spark):
    stamped = "CERT long, dt string, NAME string, _ingested_at string, _batch_id string"
    new = spark.createDataFrame([(1, "20250101", "A", "t", "b")], stamped)
    old = spark.createDataFrame([(1, "20240101", "A")], "CERT long, dt string, NAME string")
    both = project_snapshots(new).unionByName(project_snapshots(old))
    assert windows(build_history(both)) == [("A", "1900-01-01", "9999-12-31", True)]


def test_hash_joins_attributes_and_treats_null_as_empty(spark):
    row = history(spark, (1, "20250101", "A", None)).first()
    assert row._hash == hashlib.sha256(b"A||VA|N|OCC|").hexdigest()


def test_facts_take_the_version_of_their_date(spark):
    versions = typed(
        history(spark, (1, "20250101", "A", "X"), (1, "20260731", "B", "X")), HISTORY, "yyyy-MM-dd"
    )
    dim = dim_institution(versions)
    days = [dt.date(2023, 3, 31), dt.date(2026, 7, 30), dt.date(2026, 7, 31), dt.date(2027, 3, 31)]
    facts = spark.createDataFrame([(1, d) for d in days] + [(2, days[0])], "cert long, repdte date")
    named = join_as_of(facts, dim, "cert", "repdte", {"name": "name"}).orderBy("cert", "repdte")
    assert [r.name for r in named.collect()] == ["A", "A", "B", "B", None]


def test_unknown_institutions_share_one_member(spark):
    dim = dim_institution(typed(history(spark, (1, "20250101", "A", "X")), HISTORY, "yyyy-MM-dd"))
    row = (2, dt.date(2024, 3, 31), "n", "s", "s", "N", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, "t", "b")
    fact = fct_financials(spark.createDataFrame([row, (1, *row[1:])], FINANCIALS), dim)
    keys = {r.cert: r.institution_sk for r in fact.collect()}
    assert keys == {2: "unknown", 1: hashlib.md5(b"1|1900-01-01").hexdigest()}
    assert "name" not in fact.columns


def test_overlaps_are_found_against_any_earlier_window(spark):
    def day(n):
        return dt.date(2025, 1, n)

    rows = [(1, day(1), day(20)), (1, day(2), day(3)), (1, day(10), day(12)), (1, day(20), day(25)),
            (2, day(1), day(5)), (2, day(1), day(9)), (None, day(1), day(9)), (None, day(2), day(9))]
    df = spark.createDataFrame(rows, "cert long, valid_from date, valid_to date")
    found = {(r.cert, r.valid_from.day, r.prior_valid_to.day) for r in overlapping_windows(df).collect()}
    assert found == {(1, 2, 20), (1, 10, 20)}
    touching = overlapping_windows(df, touching=True).count()
    assert touching == 3


def test_snapshots_with_a_bad_key_or_day_are_rejected_with_their_values(spark):
    rows = [("1", "20230331"), ("x", "20230331"), ("1.5", "20230331"), ("2", "2023-13"), ("3", None), (None, "20230331")]
    raw = spark.createDataFrame([(c, d, "n") for c, d in rows], "CERT string, dt string, NAME string")
    snapshots = project_snapshots(raw.selectExpr("*", "'t' _ingested_at", "'b' _batch_id"))
    assert [(r.cert, r.valid_from) for r in build_history(snapshots).collect()] == [(1, "1900-01-01")]
    found = sorted((r._reject_reason, r._bad_values or "") for r in rejected_snapshots(snapshots).collect())
    assert found == [("bad_cast", '{"cert":"1.5"}'), ("bad_cast", '{"cert":"x"}'), ("bad_cast", '{"snapshot_date":"2023-13"}'),
                     ("missing_key", ""), ("missing_key", "")]
