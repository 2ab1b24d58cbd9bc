"""Review tables out of evidence and quality issues, and the sharded sidecar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starweave.functions.healpix import nested_cell
from starweave.functions.numeric import finite
from starweave.sources.tables import conform

#: The columns of the review table and of the manual queue, in order.
REVIEW = {"source": "string", "source_id": "string", "issue_type": "string", "severity": "string", "display_action": "string", "linked_source": "string", "linked_source_id": "string", "reasons": "string", "ra_deg": "double", "dec_deg": "double", "r_pc": "double", "mag_abs": "double", "separation_arcsec": "double", "apparent_mag_delta": "double"}
MANUAL = {
    "issue_type": "string", "severity": "string", "recommended_action": "string", "reasons": "string", "source": "string", "source_id": "string", "gaia_source_id": "string", "hip_source_id": "string", "label": "string",
    "separation_arcsec": "double", "apparent_mag_delta": "double", "distance_ratio": "double", "distance_frac_diff": "double", "gaia_r_pc": "double", "hip_r_pc": "double", "gaia_mag_abs": "double", "hip_mag_abs": "double",
    "merged_r_pc": "double", "merged_mag_abs": "double", "astrometry_quality": "double", "gaia_score": "double", "hip_score": "double", "gaia_ruwe": "double", "hip_solution_type": "double",
}


def review_table(evidence: DataFrame, issues: DataFrame) -> DataFrame:
    """Close pairs marked for review and suspicious merged rows, in one relation."""
    lit = F.lit
    evidence = evidence if "hip_mag_abs" in evidence.columns else evidence.withColumn("hip_mag_abs", lit(None).cast("double"))
    pairs = evidence.where(F.col("decision") == "octree_review").withColumns({
        "source": lit("hip"), "source_id": F.col("hip_source_id"), "issue_type": lit("close_cross_catalog_pair"), "display_action": lit("suppress_candidate_duplicate"), "linked_source": lit("gaia"),
        "linked_source_id": F.col("gaia_source_id"), "ra_deg": F.col("hip_ra_deg"), "dec_deg": F.col("hip_dec_deg"), "r_pc": F.col("hip_r_pc"), "mag_abs": F.col("hip_mag_abs"),
    })
    extreme = issues.where(F.col("issue_type") == "merged_row_extreme").withColumn("display_action", lit("quarantine_suspicious_star"))
    for new, old in (("ra_deg", "merged_ra_deg"), ("dec_deg", "merged_dec_deg"), ("r_pc", "merged_r_pc"), ("mag_abs", "merged_mag_abs")):
        extreme = extreme.drop(new)
        if old in extreme.columns:
            extreme = extreme.withColumnRenamed(old, new)
    extreme = extreme.drop("separation_arcsec", "apparent_mag_delta", "linked_source", "linked_source_id")
    return conform(pairs, REVIEW).unionByName(conform(extreme, REVIEW))


def manual_queue(evidence: DataFrame, issues: DataFrame) -> DataFrame:
    """Everything a person should look at, in the queue's alphabetic order."""
    lit = F.lit
    pairs = evidence.where(F.col("decision") == "manual_review").withColumns({"issue_type": lit("close_pair_manual_review"), "source": lit("hip"), "source_id": F.col("hip_source_id")})
    for new, old in (("gaia_score", "gaia_astrometry_quality"), ("hip_score", "hip_astrometry_quality")):
        if old in pairs.columns:
            pairs = pairs.withColumn(new, F.col(old))
    bad = issues.where(F.col("issue_type").isin("matched_pair_conflict", "merged_row_extreme")).withColumn("recommended_action", lit("create_or_review_override"))
    if "angular_distance_arcsec" in bad.columns:
        bad = bad.drop("separation_arcsec").withColumnRenamed("angular_distance_arcsec", "separation_arcsec")
    both = conform(pairs, MANUAL).unionByName(conform(bad, MANUAL))
    return both.orderBy(*[F.col(c).asc_nulls_last() for c in ("severity", "issue_type", "source", "source_id", "gaia_source_id")])


def write_sidecar(rows: DataFrame, folder: str, order: int, overwrite: bool = False) -> int:
    """Rows with a place, in one folder per HEALPix cell; the number of rows written, counted as they pass."""
    seen = Observation()
    placed = rows.where(finite("ra_deg") & finite("dec_deg")).withColumn("hpx", nested_cell(F.col("ra_deg"), F.col("dec_deg"), order)).observe(seen, F.count(F.lit(1)).alias("n"))
    placed.repartition("hpx").write.mode("overwrite" if overwrite else "errorifexists").option("compression", "zstd").partitionBy("hpx").parquet(folder)
    return seen.get["n"]
