"""The six flight reports."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymill.operators.caching import coalesce_after_filter, persisted
from tallymill.operators.ranking import top_counts
from tallymill.sources.readers import read_flights
from tallymill.sources.writers import fresh_root, write_reports


@dataclass(frozen=True)
class Report:
    name: str
    keys: tuple[str, ...]
    count_name: str
    fmt: str
    column: str | None = None
    at_least: int | None = None
    equals: int | None = None

    def predicate(self) -> Column | None:
        """Which rows count; a null value never does."""
        if self.at_least is not None:
            return F.col(self.column) >= self.at_least
        if self.equals is not None:
            return F.col(self.column) == self.equals
        return None


# Report names, column names, thresholds and formats.
SINCE_YEAR = 2000
LIMIT = 10
REPORTS = (
    Report("top_departures", ("origin",), "total_departures", "csv"),
    Report("top_short_delays", ("origin",), "total_delays", "json", "depdelay", at_least=15),
    Report("top_long_delays", ("origin",), "total_delays", "parquet", "depdelay", at_least=60),
    Report("top_cancellations", ("origin",), "total_cancellations", "csv", "cancelled", equals=1),
    Report("rank_quarter_cancellations", ("quarter",), "total_cancellations", "csv", "cancelled", equals=1),
    Report("popular_flights", ("origin", "dest"), "total_flights", "csv"),
)


def report_base(flights: DataFrame, since_year: int = SINCE_YEAR) -> DataFrame:
    """The rows and columns that the reports share."""
    return flights.where(F.col("year") >= since_year).select(
        "quarter", "origin", "dest", "depdelay", "cancelled"
    )


def build_report(base: DataFrame, report: Report, limit: int = LIMIT) -> DataFrame:
    return top_counts(base, report.keys, report.count_name, report.predicate(), limit)


def build_reports(base: DataFrame, limit: int = LIMIT) -> dict[str, DataFrame]:
    """One query per report; worth a persisted ``base``."""
    return {report.name: build_report(base, report, limit) for report in REPORTS}


def single_pass_reports(base: DataFrame, limit: int = LIMIT) -> DataFrame:
    """All reports in long form ``(report, position, key1, key2, n)`` from one scan of ``base``.

    The scan is reduced to one row per combination of the keys with a counter per report, which is
    as small as the number of routes times four. Only those rows are fanned out to the reports.
    """
    keys = sorted({key for report in REPORTS for key in report.keys})
    counters = [
        F.count("*").alias(report.name)
        if report.predicate() is None
        else F.count_if(report.predicate()).alias(report.name)
        for report in REPORTS
    ]
    entries = F.array(
        *[
            F.struct(
                F.lit(report.name).alias("report"),
                F.col(report.keys[0]).cast("string").alias("key1"),
                _second_key(report).alias("key2"),
                F.col(report.name).alias("n"),
            )
            for report in REPORTS
        ]
    )
    totals = (
        base.groupBy(*keys)
        .agg(*counters)
        .select(F.inline(entries))
        .where(F.col("n") > 0)
        .groupBy("report", "key1", "key2")
        .agg(F.sum("n").alias("n"))
    )
    # All keys share text columns here, so numeric ones are compared as numbers first.
    types = dict(base.dtypes)
    numeric = [report.name for report in REPORTS if types[report.keys[0]] != "string"]
    as_number = F.when(F.col("report").isin(numeric), F.col("key1").cast("bigint"))
    order = [F.desc("n"), as_number.asc_nulls_last(), F.asc_nulls_last("key1"), F.asc_nulls_last("key2")]
    position = F.row_number().over(Window.partitionBy("report").orderBy(*order))
    return (
        totals.withColumn("position", position)
        .where(F.col("position") <= limit)
        .select("report", "position", "key1", "key2", "n")
    )


def restore_report(long_form: DataFrame, report: Report, types: dict[str, str]) -> DataFrame:
    """A report of ``single_pass_reports`` with its own columns, in rank order."""
    columns = [
        F.col(f"key{number}").cast(types[key]).alias(key)
        for number, key in enumerate(report.keys, start=1)
    ]
    return (
        long_form.where(F.col("report") == report.name)
        # A handful of rows, so one partition is sorted in place.
        .coalesce(1)
        .sortWithinPartitions("position")
        .select(*columns, F.col("n").alias(report.count_name))
    )


def write_all_reports(base: DataFrame, out: str, single_pass: bool = True) -> dict[str, str]:
    """Write the six reports below ``out``; return their paths.

    The single pass keeps the few result rows; the other way keeps the filtered flights and runs
    one query per report over them.
    """
    formats = {report.name: report.fmt for report in REPORTS}
    if not single_pass:
        with persisted(base):
            return write_reports(build_reports(base), out, formats)
    types = dict(base.dtypes)
    long_form = single_pass_reports(base)
    with persisted(long_form):
        reports = {report.name: restore_report(long_form, report, types) for report in REPORTS}
        return write_reports(reports, out, formats)


def run_reports(
    spark: SparkSession, flights_path: str, out: str, single_pass: bool = True
) -> dict[str, str]:
    """Scan, filter and write all reports into a root of their own below ``out``."""
    scan = read_flights(spark, flights_path)
    base = report_base(scan)
    if not single_pass:
        base = coalesce_after_filter(base, scan)
    return write_all_reports(base, fresh_root(out), single_pass)


def read_reports(spark: SparkSession, paths: dict[str, str], types: dict[str, str]) -> DataFrame:
    """Written reports back in long form ``(report, key1, key2, n)``."""
    parts = []
    for report in REPORTS:
        columns = [f"{key} {types[key]}" for key in report.keys] + [f"{report.count_name} bigint"]
        table = spark.read.schema(", ".join(columns)).format(report.fmt).load(paths[report.name])
        parts.append(
            table.select(
                F.lit(report.name).alias("report"),
                F.col(report.keys[0]).cast("string").alias("key1"),
                _second_key(report).alias("key2"),
                F.col(report.count_name).alias("n"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _second_key(report: Report) -> Column:
    if len(report.keys) > 1:
        return F.col(report.keys[1]).cast("string")
    return F.lit(None).cast("string")
