"""Schemas of every table the library reads or writes, and the fixed column lists."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original pipeline's for compatible tables).
# ---------------------------------------------------------------------------

# Dimension measure columns of the US-state table, in file order.
DIMENSION_COLUMNS = [
    "Employment.Nonemployer Establishments",
    "Housing.Households",
    "Housing.Housing Units",
    "Housing.Median Value of Owner-Occupied Units",
    "Miscellaneous.Manufacturers Shipments",
    "Miscellaneous.Veterans",
    "Population.2020 Population",
    "Population.2010 Population",
    "Sales.Accommodation and Food Services Sales",
    "Sales.Retail Sales",
    "Employment.Firms.Total",
    "Employment.Firms.Women-Owned",
    "Employment.Firms.Men-Owned",
    "Employment.Firms.Minority-Owned",
    "Employment.Firms.Nonminority-Owned",
    "Employment.Firms.Veteran-Owned",
    "Employment.Firms.Nonveteran-Owned",
    "Income.Median Houseold Income",
    "Income.Per Capita Income",
]
DIMENSION_KEY = "state_abbreviation"
ENRICHED_PREFIX = "State_"
# The 50 state abbreviations used by the synthetic generator (no DC).
US_STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
]
SHIPPING_TYPES = ["2-Day", "3-Day", "Standard"]
# Bootstrap value of the high-water mark when the target is empty.
BOOTSTRAP_WATERMARK = "1990-01-01 00:00:00"
# Default expectation thresholds and batch size.
DEFAULT_MAX_FILES = 5
DEFAULT_ROW_COUNT = (500, 500)
DEFAULT_YEAR_RANGE = (2020, 2025)
DEFAULT_MIN_PASS_RATE = 100.0
DEFAULT_MIN_RECORDS = 500
DATE_REGEX = r"^\d{4}-\d{2}-\d{2}$"

# ---------------------------------------------------------------------------

_ODD = re.compile(r"[.\s-]")


def normalise_name(name: str) -> str:
    """Dots, white space and hyphens become underscores (``a.b c-d`` -> ``a_b_c_d``)."""
    return _ODD.sub("_", name)


def enriched_name(dim_column: str, prefix: str = ENRICHED_PREFIX) -> str:
    return prefix + normalise_name(dim_column)


LANDING_SCHEMA = T.StructType([
    T.StructField("invoiceid", T.LongType()),
    T.StructField("itemid", T.LongType()),
    T.StructField("customerid", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("orderdate", T.LongType()),  # Unix epoch seconds
    T.StructField("state", T.StringType()),
    T.StructField("shippingtype", T.StringType()),
    T.StructField("referral", T.StringType()),
])

RAW_SCHEMA = T.StructType([
    T.StructField("invoiceid", T.LongType()),
    T.StructField("itemid", T.LongType()),
    T.StructField("customerid", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("orderdate", T.TimestampType()),
    T.StructField("processed_date", T.TimestampType()),
    T.StructField("state", T.StringType()),
    T.StructField("shippingtype", T.StringType()),
    T.StructField("referral", T.StringType()),
])


def dimension_schema(columns: list[str] = DIMENSION_COLUMNS) -> T.StructType:
    """Dimension table: key, integer measures (widened to bigint), income means (double)."""
    fields = [T.StructField(DIMENSION_KEY, T.StringType())]
    for c in columns:
        dtype = T.DoubleType() if c.startswith("Income") else T.LongType()
        fields.append(T.StructField(c, dtype))
    return T.StructType(fields)


def enriched_schema(dim: T.StructType | None = None, key: str = DIMENSION_KEY,
                    prefix: str = ENRICHED_PREFIX) -> T.StructType:
    """Raw columns followed by the dimension measures renamed ``State_<normalised>``."""
    dim = dim or dimension_schema()
    extra = [T.StructField(enriched_name(f.name, prefix), f.dataType) for f in dim.fields if f.name != key]
    return T.StructType(list(RAW_SCHEMA.fields) + extra)


AUDIT_SCHEMA = T.StructType([
    T.StructField("success", T.BooleanType()),
    T.StructField("total_expectations", T.LongType()),
    T.StructField("passed_expectations", T.LongType()),
    T.StructField("failed_expectations", T.LongType()),
    T.StructField("pass_rate", T.DoubleType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("execution_date", T.StringType()),
    T.StructField("validation_timestamp", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("decision", T.StringType()),
])

# One row per state change of a landing file; the current state is the latest row per file.
# A file is (path, version): version = modification time in ms, so a file delivered again
# under the same name is a new file.
LEDGER_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("batch_time", T.TimestampType()),
    T.StructField("state", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("seq", T.LongType()),
    T.StructField("watermark_us", T.LongType()),
    T.StructField("version", T.LongType()),
    # range of the (integral) merge keys the batch inserted; min > max means none
    T.StructField("key_min", T.LongType()),
    T.StructField("key_max", T.LongType()),
    # bitmaps of the key index of the batch's folder; NULL: not indexed
    T.StructField("key_blocks", T.IntegerType()),
])

LEDGER_STATES = ("pending", "loaded", "archived", "quarantined")

VALIDATION_RESULT_SCHEMA = T.StructType([
    T.StructField("expectation", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("observed", T.DoubleType()),
    T.StructField("unexpected_count", T.LongType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("record_count", T.LongType()),
])
