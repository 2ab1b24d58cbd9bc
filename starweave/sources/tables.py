"""Readers: the given tables, tolerant Parquet, text tables with a YAML header, maps, overrides."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.functions.numeric import parse_id, plain_word
from starweave.session import ship_package


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ship_package(spark).read.parquet(f"{folder}/{name}.parquet")


def conform(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Exactly the columns of ``schema`` in its order: missing ones as typed NULL, unreadable values
    as NULL, unsigned 64-bit ids (decimal in Spark) back to integers, bytes as text."""
    df = text_of_bytes(df)
    return df.select(*[(F.col(c).try_cast(kind) if c in df.columns else F.lit(None).cast(kind)).alias(c) for c, kind in schema.items()])


def text_of_bytes(df: DataFrame) -> DataFrame:
    """Columns of bytes as UTF-8 text; bytes that are none become the replacement sign."""
    return df.withColumns({c: F.make_valid_utf8(F.col(c).cast("string")) for c, kind in df.dtypes if kind == "binary"})


def read_parquet_files(spark: SparkSession, paths: list[str], schema: dict[str, str]) -> DataFrame:
    """Several Parquet files or folders whose columns may differ, in one relation; a file with none
    of the wanted columns is left out."""
    frames = [ship_package(spark).read.option("pathGlobFilter", "*.parquet").parquet(p) for p in paths]
    kept = [conform(f, schema) for f in frames if set(f.columns) & set(schema)]
    out = kept[0] if kept else spark.createDataFrame([], ", ".join(f"`{c}` {k}" for c, k in schema.items()))
    for f in kept[1:]:
        out = out.unionByName(f)
    return out


def read_ecsv(spark: SparkSession, path: str, schema: dict[str, str]) -> DataFrame:
    """The data of an ECSV file: its YAML header is comment lines, its fields are parted by blanks.

    Types come from ``schema``; headers are taken without case."""
    rows = spark.read.csv(path, sep=" ", comment="#", header=True, quote='"', escape='"', nullValue="", emptyValue="")
    return conform(rows.toDF(*[c.lower() for c in rows.columns]), {c.lower(): k for c, k in schema.items()})


def read_overrides(df: DataFrame, actions: tuple[str, ...]) -> DataFrame:
    """(catalog_name, source_id) of overrides with one of the actions; only three columns are read."""
    rows = df.select(plain_word("source").alias("catalog_name"), parse_id("source_id").alias("source_id"), plain_word("override_action").alias("a"))
    return rows.where(F.col("a").isin(*actions) & F.col("source_id").isNotNull()).select("catalog_name", "source_id").distinct()
