"""Candidate pairs for survey deliveries as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starweave.functions.numeric import finite
from starweave.operators.cone_join import cone_pairs, with_unit_vector
from starweave.session import ship_package


def delivery_stream(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 8) -> DataFrame:
    """New Parquet files of a folder as a stream of survey rows."""
    return ship_package(spark).readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def stream_pairs(deliveries: DataFrame, hip: DataFrame, max_sep: float, delay: str = "2 hours") -> DataFrame:
    """(gaia_source_id, hip_source_id, sep_arcsec, loaded_at), each delivery once.

    A delivery that comes again within ``delay`` is the same one: state for repeats is kept only that
    long. ``hip`` as of ``secondary_sources``; the join with it is stateless, so it may be of any size."""
    once = deliveries.where(finite("ra_deg") & finite("dec_deg")).withColumn("loaded_at", F.col("loaded_at").cast("timestamp")).withWatermark("loaded_at", delay).dropDuplicatesWithinWatermark(["source_id", "loaded_at"])
    placed = with_unit_vector(once, "ra_deg", "dec_deg").select(F.col("source_id").alias("gaia_source_id"), "loaded_at", "x", "y", "z")
    return cone_pairs(placed, hip.select(F.col("id").alias("hip_source_id"), "x", "y", "z"), max_sep)


def append_pairs(pairs: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Write the pairs of all files there are now, exactly once; a later start goes on from there."""
    return pairs.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
