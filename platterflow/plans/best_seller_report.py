"""Best seller per observed month, its summary, and the text parts of the printed report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platterflow.operators import cleaning, reports
from platterflow.plans import publish
from platterflow.plans.daily_forecast import DailyForecast
from platterflow.session import pin
from platterflow.sources import exports, records


def run(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(best sellers, one-row summary with them nested) from the lines of an export."""
    totals = pin(reports.month_item_totals(cleaning.report_lines(lines)))
    winners = pin(reports.best_sellers(totals))
    # One row per month.
    rows = winners.agg(F.array_sort(F.collect_list(F.struct(*winners.columns)))).scalar()
    summary = reports.report_summary(totals).select(rows.alias("rows"), "*")
    return winners, summary


def run_files(spark: SparkSession, pattern: str, output: str) -> DataFrame:
    """Read the exports, write the report as CSV and its summary as JSON; returns the best sellers."""
    lines = exports.read_exports(spark, pattern)
    winners, summary = run(lines)
    names = records.files(spark, pattern).agg(F.array_sort(F.collect_list(F.element_at(F.split("file", "/"), -1)))).scalar()
    with publish.Publication(spark, output) as sections:
        written = sections.write(winners, "monthly_top_sellers", format="csv")
        sections.write(summary.withColumn("source_files", names), "summary")
        return pin(written)


def printed_parts(result: DailyForecast) -> dict[str, DataFrame]:
    """The tables and lines the printed report shows of a daily forecast."""
    return {
        "kpis": reports.kpi_strip(result.evaluation, result.stations, result.routes, result.alerts),
        "stations": reports.station_table(result.stations),
        "routes": reports.route_line(result.routes),
        "alerts": reports.alert_line(result.alerts),
    }
