"""Writers: Parquet, single-file CSV, JSON reports; nothing is replaced unless asked for."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, overwrite: bool = False) -> None:
    df.write.mode("overwrite" if overwrite else "errorifexists").option("compression", "zstd").parquet(path)


def write_csv(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """One CSV file with a header in folder ``path``; for result tables of bounded size. Missing values are blank, NaN too."""
    clean = df.select(*[F.nanvl(F.col(c), F.lit(None)).alias(c) if k in ("double", "float") else F.col(c) for c, k in df.dtypes])
    clean.coalesce(1).write.mode("overwrite" if overwrite else "errorifexists").csv(path, header=True, nullValue="", emptyValue="")


def write_table_twice(df: DataFrame, stem: str, overwrite: bool = False) -> None:
    """The same rows as ``stem.parquet`` and ``stem_csv``."""
    write_parquet(df, f"{stem}.parquet", overwrite)
    write_csv(df, f"{stem}_csv", overwrite)


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _hadoop(spark, path)
    return system.exists(target)


def write_report(spark: SparkSession, values: dict, path: str, overwrite: bool = False) -> None:
    """Scalars and small lists as JSON with sorted keys, in the file system the path names."""
    system, target = _hadoop(spark, path)
    if system.exists(target) and not overwrite:
        raise FileExistsError(path)
    system.mkdirs(target.getParent())
    out = system.create(target, overwrite)
    try:
        out.write(bytearray((json.dumps(values, indent=2, sort_keys=True, default=str) + "\n").encode()))
    finally:
        out.close()


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, sha256) of the files under a folder, hashed by the tasks; files of up to 2 GB, as Spark reads them whole."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))
