"""One row per key out of repeated deliveries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_values(df: DataFrame, key: str, columns: dict[str, Column], at: str) -> DataFrame:
    """(id, columns): per key the latest non-missing value of every column.

    Rows without a key are dropped; deliveries of equal time give the greater value; a NULL time is
    the earliest. One aggregation with map-side combine, so a key may hold any number of rows."""
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("id"), F.coalesce(F.unix_micros(F.col(at).cast("timestamp")), F.lit(0)).alias("_at"), *[c.alias(n) for n, c in columns.items()])
    return rows.groupBy("id").agg(*[F.max(F.when(F.col(n).isNotNull(), F.struct("_at", n))).getField(n).alias(n) for n in columns])
