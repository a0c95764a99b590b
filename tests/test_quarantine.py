"""Quarantine: all reasons of a row, both sides whole, one read of the source."""

import datetime as dt

from mercatura.operators import quality, quarantine
from mercatura.session import staged_path

RULES = [
    quality.not_null("a"),
    quality.accepted_values("b", ["x", "y"]),
    {"expectation_type": quality.BETWEEN, "kwargs": {"column": "c", "min_value": 0, "max_value": 10, "strict_min": True}},
    quality.unique("a"),  # no single row breaks it
]
SCHEMA = "a int, b string, c double, at timestamp_ntz"
NOW = dt.datetime(2020, 1, 1)
ROWS = [
    (1, "x", 1.0, NOW), (2, "y", 10.0, None), (None, "z", 0.0, NOW), (4, None, None, NOW),
    (5, "x", 10.5, NOW), (5, "x", 10.5, NOW), (None, "x", 3.0, NOW),
]


def test_reasons_counts_and_sides(spark):
    path, table = staged_path(spark, "q"), spark.createDataFrame(ROWS, SCHEMA)
    told = quarantine.split(table, RULES, path)
    assert (told.good, told.bad) == (3, 4)
    assert told.per_rule == {"a: not_be_null": 2, "b: be_in_set": 1, "c: be_between": 3}
    good, bad = (side(spark, path, table) for side in (quarantine.good_rows, quarantine.bad_rows))
    assert sorted(map(str, good.collect())) == sorted(str(r) for r in table.collect() if r.a in (1, 2, 4))
    assert good.dtypes == table.dtypes
    found = sorted((r.a or 0, list(r.violated_rules)) for r in bad.collect())
    assert found == [
        (0, ["a: not_be_null"]), (0, ["a: not_be_null", "b: be_in_set", "c: be_between"]),
        (5, ["c: be_between"]), (5, ["c: be_between"]),
    ]


def test_one_read_and_no_shuffle(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(source)
    marked = quarantine.with_reasons(spark.read.parquet(source), RULES)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("split", "split")
    quarantine.split(spark.read.schema(marked.schema).parquet(source).drop("violated_rules"), RULES, staged_path(spark, "q"))
    assert len(jobs.getJobIdsForGroup("split")) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_only_good_rows_and_none(spark):
    table = spark.createDataFrame(ROWS[:2], SCHEMA)
    for given in (table, table.limit(0)):
        path = staged_path(spark, "q")
        told = quarantine.split(given, RULES, path)
        assert told.bad == 0 and quarantine.good_rows(spark, path, table).count() == told.good
        assert quarantine.bad_rows(spark, path, table).count() == 0
    assert quarantine.split(table, [], staged_path(spark, "q")).good == 2
