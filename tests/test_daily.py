"""The whole run, twice, from CSV files to tested marts."""

import datetime as dt

import pytest

from mercatura.operators.quality import QualityGateError
from mercatura.plans import suites
from mercatura.plans.daily import daily_run, freshness
from mercatura.plans.models import Models
from mercatura.sources import versions
from mercatura.sources.contracts import CONTRACTS
from mercatura.sources.marketplace import Marketplace, RawTables
from oracles.loads_sql import as_text, short_states, write_csv

FOLDER = "/root/testdata/sf0.001"


def _without_row_count():
    # The fixture has fewer orders than the floor of the real suite.
    return suites.SUITES | {"orders": suites.SUITES["orders"][1:]}


def test_two_runs(spark, tmp_path):
    files, warehouse = str(tmp_path / "files"), str(tmp_path / "warehouse")
    market = Marketplace(spark, FOLDER)
    raw = RawTables(**{name: short_states(getattr(market, name)) for name in CONTRACTS})
    for name in CONTRACTS:
        write_csv(as_text(getattr(raw, name)), f"{files}/{name}")

    with pytest.raises(QualityGateError, match="1 failed checks: orders"):
        daily_run(spark, files, warehouse, dt.datetime(2008, 1, 1))
    audit = spark.read.parquet(f"{warehouse}/audit").collect()
    assert [(r.table_name, r.total_failed) for r in audit] == [("orders", 1)]

    counts = []
    for run in (dt.datetime(2008, 1, 1), dt.datetime(2008, 1, 2)):
        results = daily_run(spark, files, warehouse, run, _without_row_count())
        assert results.where("not success").collect() == []
        read = spark.read.parquet
        kept = [versions.read(spark, f"{warehouse}/{path}").count() for path in ("staging/stg_orders", "snapshots/sellers")]
        counts.append([*kept, read(f"{warehouse}/marts/mart_rfm_segmentation").count()])
    assert counts[0] == counts[1]

    # Text files keep whole seconds, so compare a mart that orders nothing by time.
    direct = Models(raw).mart_delivery_analysis
    stored = read(f"{warehouse}/marts/mart_delivery_analysis")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, direct.collect()))

    ages = freshness(raw, dt.datetime(2018, 1, 1)).collect()
    assert {r.table_name: r.status for r in ages}["orders"] == "error"
