"""Session settings and lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the settings every plan here is written for: UTC, ANSI casts, AQE."""
    builder = SparkSession.builder.master(master).config("spark.ui.enabled", "false")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.driver.memory": "8g",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package to the executors' Python workers, once per application."""
    context = spark.sparkContext
    if not getattr(context, "_starweave_shipped", False):
        root = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="spark-")) / "starweave_package.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(root.rglob("*.py")):
                z.write(file, file.relative_to(root.parent))
        context.addPyFile(str(archive))
        context._starweave_shipped = True
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a session on this machine alone gets a temporary one where none is set;
    on a cluster executors could not share it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, own, True)
        folder = "file://" + own
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` in at least as many partitions as there are cores, for costly work on few or small files.

    Inputs with more splits than cores, which is any large table, are left as they are. Rows are placed by
    the hash of ``keys``, so a repeated task sees the same rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: the lineage ends at files
    every executor can reach, so a lost executor costs at most the tasks that were running on it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    _written(spark).add(path)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._starweave_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(df: DataFrame) -> None:
    """Delete what ``materialise`` wrote for ``df``; nothing may read it afterwards."""
    path = getattr(df, "_starweave_path", None)
    if path:
        _delete(df.sparkSession, path)
        _written(df.sparkSession).discard(path)


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of finished plans: it does so when the driver's JVM has collected what refers to
    them, which may be long after the tables made of them are written. Spark's listeners hold the plan whose end they were
    told last until they are told of another, so one without tasks ends first."""
    spark.sql("SELECT 1").collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def hash_joins(spark: SparkSession):
    """AQE joins by a hash table, without sorting, where no part of one side is larger than the parts it aims at; larger ones are
    sorted as ever."""
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def discard_all(spark: SparkSession) -> None:
    """Delete every table that ``materialise`` wrote in this application and nobody deleted: for the end of a run, when its
    results are written. Results that are still lazy read such tables."""
    for path in sorted(_written(spark)):
        _delete(spark, path)
    _written(spark).clear()


def _written(spark: SparkSession) -> set[str]:
    context = spark.sparkContext
    if not hasattr(context, "_starweave_written"):
        context._starweave_written = set()
    return context._starweave_written
