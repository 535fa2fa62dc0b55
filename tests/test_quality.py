"""Every check with data that passes and data that fails."""

import datetime as dt

import pytest

from filingmill.plans import quality, serving
from filingmill.plans.quality import Accepted, NoOverlap, NotNull, Reference, Unique
from filingmill.schemas import INSTITUTION

DAY = [dt.date(2024, 1, n) for n in range(1, 29)]


@pytest.fixture(scope="module")
def tables(spark):
    child = spark.createDataFrame(
        [(1, "a", "x"), (1, "b", "x"), (2, None, "y"), (None, "c", None)],
        "k int, ref string, code string",
    )
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    window = "cert long, valid_from date, valid_to date"
    crossing = [(1, DAY[0], DAY[9]), (1, DAY[8], DAY[20]), (2, DAY[0], DAY[5])]
    span = spark.createDataFrame(crossing, window)
    good = spark.createDataFrame([(1, DAY[0], DAY[5]), (1, DAY[6], DAY[9])], window)
    return {"child": child, "parent": parent, "span": span, "good": good}


@pytest.mark.parametrize(
    "check, name, failures",
    [
        (NotNull("child", ("k",)), "not_null", 1),
        (NotNull("parent", ("id",)), "not_null", 0),
        (Unique("child", ("k",)), "unique", 1),
        (Unique("child", ("k", "ref")), "unique", 0),
        (Unique("parent", ("id",)), "unique", 1),
        (Accepted("child", "code", ("x",)), "accepted_values", 1),
        (Accepted("child", "code", ("x", "y")), "accepted_values", 0),
        (Reference("child", "ref", "parent", "id"), "relationships", 1),
        (Reference("parent", "id", "child", "ref"), "relationships", 0),
        (NoOverlap("span"), "no_overlapping_windows", 1),
        (NoOverlap("good"), "no_overlapping_windows", 0),
        (NoOverlap("good", touching=True), "no_touching_windows", 0),
    ],
)
def test_check(tables, check, name, failures):
    row = quality.check_report(tables, [check]).first()
    assert (row.check, row.model, row.failures) == (name, check.model, failures)


def test_row_checks_of_a_table_share_one_pass(tables):
    checks = [NotNull("child", ("k", "ref")), Accepted("child", "code", ("x",))]
    report = quality.check_report(tables, checks)
    assert [r.failures for r in report.collect()] == [1, 1, 1]
    assert report._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_offenders_are_returned(tables):
    child = tables["child"]
    assert [r.ref for r in quality.null_rows(child, ["k"]).collect()] == ["c"]
    counted = {
        "repeated": quality.repeated_keys(child, ["k"]),
        "unaccepted": quality.unaccepted_values(child, "code", ["x"]),
        "orphans": quality.orphan_keys(child, "ref", tables["parent"], "id"),
    }
    assert {name: [tuple(r) for r in df.collect()] for name, df in counted.items()} == {
        "repeated": [(1, 2)], "unaccepted": [("y", 1)], "orphans": [("c", 1)],
    }


def test_changed_rows_count_duplicates(spark):
    before = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "v int")
    after = spark.createDataFrame([(1,), (2,), (3,), (None,)], "v int")
    found = sorted((r.change, r.v, r.copies) for r in quality.changed_rows(before, after).collect())
    assert found == [("added", 3, 1), ("removed", 1, 2)]
    assert quality.changed_rows(before, before.repartition(2)).count() == 0


def test_response_contract(spark):
    good = spark.createDataFrame([], INSTITUTION)
    assert serving.contract(good.withColumn("extra", good.cert), INSTITUTION).columns == INSTITUTION.names
    with pytest.raises(ValueError, match="name is missing"):
        serving.contract(good.withColumnRenamed("name", "title"), INSTITUTION)
    with pytest.raises(ValueError, match="cert is"):
        serving.contract(good.withColumn("cert", good.cert.cast("string")), INSTITUTION)
