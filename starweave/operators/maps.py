"""Pair relations between two catalogues ("maps"): reading, lookups, building, merging, validating."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starweave.functions.numeric import finite

MAP_COLUMNS = {"gaia_source_id": "bigint", "hip_source_id": "bigint", "mapping_source": "string", "number_of_neighbours": "smallint", "angular_distance": "float"}
#: The other naming a map may come with.
OTHER_NAMES = {"source_id": "gaia_source_id", "original_ext_source_id": "hip_source_id"}
LOCAL_SOURCE = "local_close_pair_v1"
#: Fixed value: the source of a map that has the flag of the best-neighbour table.
FLAG, FLAG_SOURCE = "xm_flag", "hipparcos2_best_neighbour"


def inferred_source(df: DataFrame) -> str:
    """The source of a map without source column: the best-neighbour table by its flag, else unknown."""
    return FLAG_SOURCE if FLAG in {c.lower() for c in df.columns} else "unknown"


def strict_ids(df: DataFrame) -> DataFrame:
    """The rows themselves; reading them fails at an id that is no finite, positive, whole number."""
    df = df.toDF(*[c.lower() for c in df.columns])
    for name in (*OTHER_NAMES, *OTHER_NAMES.values()):
        if name in df.columns:
            text = F.col(name).cast("string")
            value = text.try_cast("double")
            number = F.coalesce(text.try_cast("bigint"), F.when(F.floor(value) == value, value.try_cast("bigint")))
            unsound = F.when(finite(value) & (value > 0), F.lit("crossmatch contains fractional ids")).when(finite(value), F.lit("crossmatch contains non-positive ids")).otherwise(F.lit("crossmatch contains non-finite ids"))
            df = df.withColumn(name, F.when(number > 0, number).otherwise(F.raise_error(unsound).cast("bigint")))
    return df


def normalise_map(df: DataFrame, default_source: str = "") -> DataFrame:
    """The five map columns, one row per pair of readable positive ids.

    Headers are taken without case and in either naming. Missing columns and values get their
    defaults: the given source, 0 neighbours, no distance. Of repeated pairs the one with a source,
    then the least distance, then the least source name stays. Raises ValueError without both ids."""
    df = df.toDF(*[c.lower() for c in df.columns])
    if "gaia_source_id" not in df.columns:
        for old, new in OTHER_NAMES.items():
            df = df.withColumnRenamed(old, new)
    if not {"gaia_source_id", "hip_source_id"} <= set(df.columns):
        raise ValueError("a map needs gaia_source_id and hip_source_id, or source_id and original_ext_source_id")
    for name, kind in MAP_COLUMNS.items():
        value = F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind)
        df = df.withColumn(name, value)
    rows = df.where((F.col("gaia_source_id") > 0) & (F.col("hip_source_id") > 0)).select(
        "gaia_source_id", "hip_source_id",
        F.struct(F.col("mapping_source").isNull().alias("none"), F.coalesce("angular_distance", F.lit(float("inf")).cast("float")).alias("far"), F.coalesce("mapping_source", F.lit(default_source)).alias("mapping_source"), F.coalesce("number_of_neighbours", F.lit(0).cast("smallint")).alias("number_of_neighbours"), "angular_distance").alias("best"),
    )
    return rows.groupBy("gaia_source_id", "hip_source_id").agg(F.min("best").alias("b")).select("gaia_source_id", "hip_source_id", "b.mapping_source", "b.number_of_neighbours", "b.angular_distance")


def partner_lookup(pairs: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """(key, name): one partner per key; of several the greatest, so the result has no order to depend on."""
    return pairs.groupBy(key).agg(F.max(value).alias(name))


def supplemental_map(evidence: DataFrame, decision: str = "supplemental_match", source: str = LOCAL_SOURCE) -> DataFrame:
    """The pairs of one decision as a map."""
    return evidence.where(F.col("decision") == decision).select(
        F.col("gaia_source_id").cast("bigint").alias("gaia_source_id"), F.col("hip_source_id").cast("bigint").alias("hip_source_id"),
        F.lit(source).alias("mapping_source"), F.lit(1).cast("smallint").alias("number_of_neighbours"), F.col("separation_arcsec").cast("float").alias("angular_distance"),
    )


def combine_maps(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union of two maps; of a pair in both the row of ``first`` stays."""
    both = first.withColumn("rank", F.lit(0)).unionByName(second.withColumn("rank", F.lit(1)))
    order = Window.partitionBy("gaia_source_id", "hip_source_id").orderBy("rank", "mapping_source", "angular_distance")
    return both.withColumn("n", F.row_number().over(order)).where("n = 1").select(*MAP_COLUMNS)


def repeated_ids(pairs: DataFrame) -> DataFrame:
    """(catalog_name, source_id, n): ids that stand in more than one pair of a map."""
    parts = [pairs.groupBy(F.col(c).alias("source_id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit(name).alias("catalog_name"), "source_id", "n") for name, c in (("gaia", "gaia_source_id"), ("hip", "hip_source_id"))]
    return parts[0].unionByName(parts[1])


def require_one_to_one(pairs: DataFrame, sample: int = 5) -> DataFrame:
    """The map itself; raises ValueError naming a few repeated ids if it is not one-to-one."""
    for name in ("gaia", "hip"):
        found = [str(r.source_id) for r in repeated_ids(pairs).where(F.col("catalog_name") == name).orderBy("source_id").limit(sample).collect()]
        if found:
            raise ValueError(f"repeated {name} ids in the map: {', '.join(found)}")
    return pairs
