"""Writing results where readers expect them, one job per result."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from shoplens.plans import reports
from shoplens.sources.writers import write_table


def report_tables(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The six reports over customers, transactions and clickstream, by the names they are stored under."""
    tx, customers = tables["transactions"], tables["customers"]
    return {
        "revenue_by_method_ranked": reports.revenue_ranked(tx),
        "customer_ltv": reports.customer_ltv(tx, customers),
        "promo_effectiveness": reports.promo_effectiveness(tx),
        "monthly_revenue_trend": reports.monthly_trend(tx),
        "clickstream_funnel": reports.funnel(tables["clickstream"]),
        "revenue_by_country_segment": reports.segment_revenue(tx, customers),
    }


def publish(results: Mapping[str, DataFrame], out: str, fmt: str = "csv") -> dict[str, str]:
    """Write each result under its name and return the paths."""
    return {name: write_table(df, f"{out.rstrip('/')}/{name}", fmt) for name, df in results.items()}
