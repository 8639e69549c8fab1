import os

import pytest

from tallymill.operators.caching import persisted
from tallymill.plans import reports, stand_ins
from tallymill.sources.writers import write_table
from tests.conftest import MEDIUM, SMALL, plan_of, rows_of


@pytest.fixture(scope="module")
def flights(spark):
    rows = [
        (2000, 1, "A", "B", 15, 0),
        (2001, 1, "A", "B", 60, 1),
        (2001, 2, "A", "C", 14, 1),
        (2002, 3, "B", "A", None, 1),
        (2002, 3, "B", "A", -5, None),
        (1999, 4, "A", "B", 99, 1),
        (None, 4, "A", "B", 99, 1),
        (2003, 3, None, "A", 61, 0),
    ]
    schema = "year int, quarter int, origin string, dest string, depdelay int, cancelled int"
    return spark.createDataFrame(rows, schema)


def test_reports_by_hand(flights):
    found = reports.build_reports(reports.report_base(flights))
    plain = {name: [tuple(row) for row in frame.collect()] for name, frame in found.items()}
    assert plain == {
        "top_departures": [("A", 3), ("B", 2), (None, 1)],
        "top_short_delays": [("A", 2), (None, 1)],
        "top_long_delays": [("A", 1), (None, 1)],
        "top_cancellations": [("A", 2), ("B", 1)],
        "rank_quarter_cancellations": [(1, 1), (2, 1), (3, 1)],
        "popular_flights": [("A", "B", 2), ("B", "A", 2), ("A", "C", 1), (None, "A", 1)],
    }


@pytest.mark.parametrize("limit, generated", [(1, False), (2, False), (10, False), (10, True)])
def test_single_pass_equals_the_separate_reports(spark, flights, limit, generated):
    base = reports.report_base(stand_ins.flights(spark, SMALL) if generated else flights)
    types = dict(base.dtypes)
    with persisted(base):
        long_form = reports.single_pass_reports(base, limit)
        for report in reports.REPORTS:
            separate = reports.build_report(base, report, limit)
            restored = reports.restore_report(long_form, report, types)
            assert restored.dtypes == separate.dtypes
            assert [tuple(row) for row in restored.collect()] == [tuple(row) for row in separate.collect()]


def test_numeric_keys_are_ordered_as_numbers(spark):
    rows = [(2000, quarter, "10", "9", 0, 1) for quarter in (10, 9, 100, None)] + [(2000, 9, "9", "10", 0, 0)] * 4
    schema = "year int, quarter int, origin string, dest string, depdelay int, cancelled int"
    base = reports.report_base(spark.createDataFrame(rows, schema))
    long_form = reports.single_pass_reports(base)
    for report in reports.REPORTS:
        separate = reports.build_report(base, report).collect()
        assert reports.restore_report(long_form, report, dict(base.dtypes)).collect() == separate


def test_published_first_rows(spark):
    base = reports.report_base(stand_ins.flights(spark, MEDIUM))
    assert base.count() == 16_025
    found = reports.build_reports(base)
    assert [tuple(row) for row in found["top_departures"].collect()][:3] == [
        ("NATION_9", 1603), ("NATION_6", 1106), ("NATION_11", 1095)
    ]
    assert [tuple(row) for row in found["rank_quarter_cancellations"].collect()] == [
        (3, 1474), (2, 1471), (1, 1466), (4, 1018)
    ]


def test_year_hint_changes_no_result(spark):
    hinted = reports.report_base(stand_ins.flights(spark, SMALL, since_year=2000))
    assert rows_of(hinted) == rows_of(reports.report_base(stand_ins.flights(spark, SMALL)))
    assert "GreaterThanOrEqual(l_shipdate" in plan_of(hinted)


def test_filter_and_columns_reach_the_scan(spark, flights, tmp_path):
    path = str(tmp_path / "flights")
    write_table(flights.selectExpr("*", "1 as unused"), path)
    base = reports.report_base(spark.read.parquet(path))
    plan = plan_of(reports.single_pass_reports(base))
    assert "GreaterThanOrEqual(year,2000)" in plan and "unused" not in plan
    assert plan.count("FileScan") == 1
    assert "Join" not in plan and "Cartesian" not in plan


def test_stand_in_joins_have_keys(spark):
    plan = plan_of(stand_ins.flights(spark, SMALL))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("single_pass", [True, False])
def test_files(spark, flights, tmp_path, single_pass):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_table(flights, source)
    paths = reports.run_reports(spark, source, out, single_pass)
    again = reports.run_reports(spark, source, out, single_pass)
    assert len(os.listdir(out)) == 2 and set(paths.values()).isdisjoint(again.values())
    endings = {
        name: {file.rsplit(".", 1)[1] for file in os.listdir(path) if file.startswith("part-")}
        for name, path in paths.items()
    }
    assert endings == {report.name: {report.fmt} for report in reports.REPORTS}
    types = dict(flights.dtypes)
    base = reports.report_base(flights)
    assert rows_of(reports.read_reports(spark, paths, types)) == rows_of(
        reports.single_pass_reports(base).drop("position")
    )


def test_separate_reports_share_the_kept_flights(spark, flights):
    base = reports.report_base(flights)
    base.persist()
    try:
        for report in reports.build_reports(base).values():
            assert "InMemoryTableScan" in plan_of(report)
    finally:
        base.unpersist()
