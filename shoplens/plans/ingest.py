"""From raw CSV to clean Parquet."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from shoplens.operators.clean import (
    clean_strings,
    fill_nulls,
    parse_dates,
    parse_json,
    parse_timestamps,
    rename_columns,
)
from shoplens.sources.catalog import load_raw
from shoplens.sources.schemas import EVENT_META_JSON, ORDER_ITEMS_JSON
from shoplens.sources.writers import write_table

# The text columns that are trimmed.
CUSTOMER_TEXT = [
    "first_name", "last_name", "username", "email", "gender", "device_type", "home_location", "home_country",
]
PRODUCT_TEXT = [
    "gender", "masterCategory", "subCategory", "articleType", "baseColour", "season", "usage", "productDisplayName",
]


def customers(raw: DataFrame) -> DataFrame:
    return clean_strings(parse_dates(raw, ["first_join_date", "birthdate"]), CUSTOMER_TEXT)


def products(raw: DataFrame) -> DataFrame:
    return clean_strings(rename_columns(raw, {"id": "product_id"}), PRODUCT_TEXT)


def transactions(raw: DataFrame) -> DataFrame:
    typed = parse_dates(parse_timestamps(raw, ["created_at"]), ["shipment_date_limit"])
    parsed = parse_json(typed, "product_metadata", ORDER_ITEMS_JSON, "parsed_metadata")
    return fill_nulls(parsed, {"promo_amount": 0.0})


def clickstream(raw: DataFrame) -> DataFrame:
    typed = parse_timestamps(raw, ["event_time"])
    return parse_json(typed, "event_metadata", EVENT_META_JSON, "parsed_event_meta")


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": customers,
    "products": products,
    "transactions": transactions,
    "clickstream": clickstream,
}


def load_clean(spark: SparkSession, name: str, bases: str | Sequence[str]) -> DataFrame:
    """Raw table ``name``, cleaned and typed; nothing runs yet."""
    return CLEANERS[name](load_raw(spark, name, bases))


def ingest(spark: SparkSession, bases: str | Sequence[str], out: str) -> dict[str, str]:
    """Clean every raw table once and store it, so that later jobs read Parquet."""
    return {
        name: write_table(load_clean(spark, name, bases), f"{out.rstrip('/')}/{name}.parquet")
        for name in CLEANERS
    }
