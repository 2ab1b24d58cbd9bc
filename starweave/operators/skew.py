"""Joins and groups whose keys may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more rows than this is split over salts of about so many rows.
SALT_ROWS = 50_000


def hot_salts(counts: DataFrame, key: str, n: str, rows: int = SALT_ROWS) -> DataFrame:
    """(key, salts) of the keys with more than ``rows`` rows: how many salts of about ``rows`` rows each needs.

    ``counts`` has one row per key. There is at most one such key in ``rows`` rows, so the table is small beside the data,
    but not bounded: it is joined, never collected."""
    return counts.where(F.col(n) > rows).select(key, batch_count(F.col(n), rows).alias("salts"))


def join_hot(big: DataFrame, small: DataFrame, key: str, hot: DataFrame | None, salt_by: str | None = None) -> DataFrame:
    """Inner join of ``big`` with ``small`` (one row per key): the rows of a hot key are spread over its
    salts, and only the hot rows of ``small`` are repeated. ``hot``: see ``hot_salts``, None if no key is hot; Catalyst broadcasts it if it is small."""
    if hot is None:
        return big.join(small, key)
    source = F.xxhash64(*([salt_by] if salt_by else [c for c in big.columns if c != key] or [key]))
    salts = F.coalesce("salts", F.lit(1))
    salted = big.join(hot, key, "left").withColumn("_salt", F.pmod(source, salts).cast("int")).drop("salts")
    copies = small.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    return salted.join(copies, [key, "_salt"]).drop("_salt")


def batch_count(n: Column, rows: int) -> Column:
    """How many batches of about ``rows`` rows a group of ``n`` rows is split into."""
    return F.greatest(F.lit(1), F.ceil(n / F.lit(rows))).cast("int")
