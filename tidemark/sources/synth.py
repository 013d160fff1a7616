"""Synthetic landing transactions (S12), generated on executors.

Values are pure functions of (row key, seed), so a frame is reproducible
whatever its partitioning. Unique ids come from a bijection of the key.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import LANDING_SCHEMA, SHIPPING_TYPES, US_STATES

# Ranges of the original generator.
PRICE_RANGE = (10.0, 100.0)
QUANTITY_RANGE = (1, 5)
DATE_RANGE = (datetime(2020, 1, 1, tzinfo=timezone.utc), datetime(2025, 12, 31, tzinfo=timezone.utc))

# Our own small vocabulary for the free-text word columns (category, referral).
WORDS = ["alpha", "bravo", "charlie", "delta", "echo", "foxtrot", "golf", "hotel", "india", "juliet"]


def _u(key: Column, seed: int, field: int) -> Column:
    """Uniform [0, 1) from the first 52 bits of the md5 of (key, seed, field)."""
    text = F.concat_ws(":", key.cast("string"), F.lit(str(seed)), F.lit(str(field)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def _permute(key: Column, digits: int, mult: int) -> Column:
    """Bijection of [0, 10^digits): (mult * key + 1) mod 10^digits, mult coprime to 10."""
    m = 10 ** digits
    return F.pmod(key * F.lit(mult) + F.lit(1), F.lit(m))


def synth_transactions(keys: DataFrame, key_col: str = "id", seed: int = 42,
                       id_digits: tuple[int, int, int] = (7, 3, 5)) -> DataFrame:
    """One landing row per key (keys must be distinct integers below 10^digits for unique ids)."""
    k = F.col(key_col).cast("long")
    lo, hi = (int(d.timestamp()) for d in DATE_RANGE)
    cents = [round(100 * p) for p in PRICE_RANGE]
    states = F.array(*[F.lit(s) for s in US_STATES])
    ships = F.array(*[F.lit(s) for s in SHIPPING_TYPES])
    words = F.array(*[F.lit(w) for w in WORDS])
    pick = lambda arr, n, f: F.element_at(arr, (F.floor(_u(k, seed, f) * n) + 1).cast("int"))
    out = keys.select(
        _permute(k, id_digits[0], 7_654_321).alias("invoiceid"),
        _permute(k, id_digits[1], 373).alias("itemid"),
        _permute(k, id_digits[2], 45_673).alias("customerid"),
        pick(words, len(WORDS), 1).alias("category"),
        ((F.floor(_u(k, seed, 2) * (cents[1] - cents[0] + 1)) + cents[0]) / 100.0).alias("price"),
        (F.floor(_u(k, seed, 3) * (QUANTITY_RANGE[1] - QUANTITY_RANGE[0] + 1)) + QUANTITY_RANGE[0])
        .cast("int").alias("quantity"),
        (F.floor(_u(k, seed, 4) * (hi - lo)) + lo).cast("long").alias("orderdate"),
        pick(states, len(US_STATES), 5).alias("state"),
        pick(ships, len(SHIPPING_TYPES), 6).alias("shippingtype"),
        pick(words, len(WORDS), 7).alias("referral"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in LANDING_SCHEMA.fields])


def id_digits_for(n: int) -> tuple[int, int, int]:
    """Digits of the three ids for keys below ``n``: the original widths, more where ids would repeat."""
    need = len(str(max(n - 1, 0)))
    return max(7, need), max(3, need), max(5, need)


def synth_range(spark: SparkSession, n: int, seed: int = 42, partitions: int | None = None) -> DataFrame:
    return synth_transactions(spark.range(0, n, 1, partitions), "id", seed, id_digits_for(n))


def write_landing_files(df: DataFrame, folder: str, n_files: int) -> None:
    """``n_files`` parquet files in ``folder``."""
    df.repartition(n_files).write.mode("append").parquet(folder)
