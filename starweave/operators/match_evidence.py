"""Candidate pairs of two raw catalogues with their evidence and decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.functions import geometry as geo
from starweave.functions.numeric import finite, finite_or_null
from starweave.operators.cone_join import cone_pairs, with_unit_vector
from starweave.operators.latest import latest_values
from starweave.operators.rules import Rule, decide
from starweave.session import materialise

MAX_SEP_ARCSEC, AUTO_SEP_ARCSEC, MAX_3D_PC = 5.0, 0.25, 1.0
STAND_IN_MAG = 50.0


def primary_sources(df: DataFrame) -> DataFrame:
    """Survey rows as sources: latest values per id; only those with a place and a brightness."""
    f = finite_or_null
    cols = {"ra": f("ra_deg"), "dec": f("dec_deg"), "g": f("phot_g_mean_mag"), "bp": f("phot_bp_mean_mag"), "rp": f("phot_rp_mean_mag"), "plx": f("parallax"), "e_plx": f("parallax_error")}
    rows = latest_values(df, "source_id", cols, "loaded_at").where(F.col("g").isNotNull())
    return with_unit_vector(rows.withColumn("ra", F.pmod("ra", F.lit(360.0))), "ra", "dec")


def secondary_sources(df: DataFrame, years: float = geo.EPOCH_PRIMARY - geo.EPOCH_SECONDARY) -> DataFrame:
    """Catalogue rows as sources, moved to the survey's epoch; all of position, motion and
    brightness must be there, parallax and solution type may be missing."""
    f = finite_or_null
    cols = {"ra0": f("rarad"), "dec0": f("derad"), "pmra": f("pmra"), "pmdec": f("pmde"), "mag": F.when(f("hpmag") < STAND_IN_MAG, F.col("hpmag")), "plx": f("plx"), "e_plx": f("e_plx"), "sn": F.col("sn").cast("double"), "bv": f("b_v")}
    rows = latest_values(df, "hip", cols, "loaded_at")
    for c in ("ra0", "dec0", "pmra", "pmdec", "mag"):
        rows = rows.where(F.col(c).isNotNull())
    ra, dec = geo.propagated(F.col("ra0"), F.col("dec0"), F.col("pmra"), F.col("pmdec"), years)
    return with_unit_vector(rows.withColumns({"ra": ra, "dec": dec, "ra0": F.pmod("ra0", F.lit(360.0))}), "ra", "dec")


def facts_by_key(pairs: DataFrame, key: str, counted: dict[str, Column], partners: DataFrame, partner: str, marks: dict[str, DataFrame]) -> DataFrame:
    """(key, counts, partner, marks): all that is known of the keys of ``pairs``, in one aggregation.

    ``counted``: names of counts and which pairs they count. ``partners``: (key, value), of several values the greatest
    stays. ``marks``: names of flags and the keys that have them."""
    null = lambda kind: F.lit(None).cast(kind)
    parts = [pairs.select(key, *[F.when(cond, 1).otherwise(0).alias(n) for n, cond in counted.items()])]
    parts.append(partners.toDF(key, "_partner"))
    parts += [keys.toDF(key).withColumn(n, F.lit(True)) for n, keys in marks.items()]
    rows = parts[0].withColumn("_here", F.lit(True))
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    found = rows.groupBy(key).agg(F.max("_here").alias("_here"), *[F.sum(n).cast("int").alias(n) for n in counted], F.max("_partner").alias(partner), *[F.coalesce(F.max(n) if n in rows.columns else null("boolean"), F.lit(False)).alias(n) for n in marks])
    return found.where("_here").drop("_here")


def candidate_pairs(gaia: DataFrame, hip: DataFrame, official: DataFrame, neighbourhood: DataFrame, max_sep: float, max_mag_delta: float | None) -> DataFrame:
    """Pairs with all measures of both sides, counts and official evidence; sky counts are taken before the magnitude gate,
    candidate counts after it.

    The join's pairs are written once, as they are read for the facts of either key; the wide rows move once per key."""
    names = {"ra": "gaia_ra_deg", "dec": "gaia_dec_deg", "g": "gaia_apparent_mag", "bp": "gaia_phot_bp_mean_mag", "rp": "gaia_phot_rp_mean_mag", "plx": "gaia_plx_mas", "e_plx": "gaia_e_plx_mas"}
    names2 = {
        "id": "id2", "ra": "hip_ra_deg", "dec": "hip_dec_deg", "ra0": "hip_ra_deg_epoch1991", "dec0": "hip_dec_deg_epoch1991", "mag": "hip_apparent_mag", "plx": "hip_plx_mas", "e_plx": "hip_e_plx_mas",
        "pmra": "hip_pmra_masyr", "pmdec": "hip_pmdec_masyr", "sn": "hip_solution_type",
    }
    near = materialise(cone_pairs(gaia.withColumnsRenamed(names), hip.drop("bv").withColumnsRenamed(names2), max_sep))
    alike = F.lit(True) if max_mag_delta is None else F.abs(F.col("hip_apparent_mag") - F.col("gaia_apparent_mag")) <= max_mag_delta
    g, h = F.col("gaia_source_id"), F.col("hip_source_id")
    by_g = facts_by_key(near, "id", {"gaia_sky_neighbour_count": F.lit(True), "gaia_candidate_count": alike}, official.select(g, h), "gaia_official_hip_source_id", {"near_g": neighbourhood.select(g)})
    by_h = facts_by_key(near, "id2", {"hip_sky_neighbour_count": F.lit(True), "hip_candidate_count": alike}, official.select(h, g), "hip_official_gaia_source_id", {"near_h": neighbourhood.select(h)})
    by_pair = neighbourhood.select(g.alias("id"), h.alias("id2")).distinct().withColumn("near_pair", F.lit(True))
    rows = near.where(alike).join(by_g, "id").join(by_h, "id2").join(by_pair, ["id", "id2"], "left").withColumnRenamed("sep_arcsec", "separation_arcsec")
    c = F.col
    rows = rows.withColumns({
        "apparent_mag_delta": F.abs(c("hip_apparent_mag") - c("gaia_apparent_mag")),
        "gaia_bp_rp": c("gaia_phot_bp_mean_mag") - c("gaia_phot_rp_mean_mag"),
        "gaia_r_pc": geo.distance_pc(c("gaia_plx_mas")), "hip_r_pc": geo.distance_pc(c("hip_plx_mas")),
        "gaia_parallax_frac_error": geo.parallax_frac_error(c("gaia_plx_mas"), c("gaia_e_plx_mas")),
        "hip_parallax_frac_error": geo.parallax_frac_error(c("hip_plx_mas"), c("hip_e_plx_mas")),
    })
    return rows.withColumn("rendered_3d_separation_pc", geo.separation_3d_pc(c("gaia_r_pc"), c("hip_r_pc"), c("separation_arcsec")))


def with_official_evidence(rows: DataFrame) -> DataFrame:
    """Agreement and conflict with the official map, and with the neighbourhood."""
    no, c = F.lit(False), F.col
    agrees_g, agrees_h = c("gaia_official_hip_source_id") == c("id2"), c("hip_official_gaia_source_id") == c("id")
    return rows.withColumns({
        "gaia_has_official_map": c("gaia_official_hip_source_id").isNotNull(), "hip_has_official_map": c("hip_official_gaia_source_id").isNotNull(),
        "official_pair": F.coalesce(agrees_g & agrees_h, no), "official_conflict": F.coalesce(~agrees_g, no) | F.coalesce(~agrees_h, no),
        "in_official_neighbourhood": c("near_pair").isNotNull(), "official_neighbourhood_conflict": c("near_pair").isNull() & (c("near_g") | c("near_h")),
    }).drop("near_pair", "near_g", "near_h")


def raw_match_evidence(gaia: DataFrame, hip: DataFrame, official: DataFrame, neighbourhood: DataFrame, max_sep: float = MAX_SEP_ARCSEC, max_mag_delta: float | None = None, auto_sep: float = AUTO_SEP_ARCSEC, max_3d_pc: float = MAX_3D_PC) -> DataFrame:
    """One row per pair within ``max_sep`` with the 47 evidence columns.

    ``gaia`` and ``hip`` as of ``primary_sources`` and ``secondary_sources``; the maps as of ``normalise_map``."""
    rows = with_official_evidence(candidate_pairs(gaia, hip, official, neighbourhood, max_sep, max_mag_delta))
    c, no = F.col, F.lit(False)
    rows = rows.withColumns({
        "one_to_one_candidate": (c("gaia_candidate_count") == 1) & (c("hip_candidate_count") == 1),
        "isolated_sky_pair": (c("gaia_sky_neighbour_count") == 1) & (c("hip_sky_neighbour_count") == 1),
        "within_tight_sky_threshold": F.coalesce(c("separation_arcsec") <= auto_sep, no),
        "within_rendered_distance_threshold": F.coalesce(c("rendered_3d_separation_pc") <= max_3d_pc, no),
    })
    single = c("one_to_one_candidate")
    rules = [
        Rule(c("official_pair") & single, "official_confirmed", "already_in_official_crossmatch", "info", ("official_crossmatch_pair",)),
        Rule(c("official_pair"), "manual_review", "inspect_ambiguous_official_pair", "medium", ("official_crossmatch_pair", "official_pair_has_local_ambiguity")),
        Rule(c("official_conflict"), "manual_review", "inspect_official_best_conflict", "high", ("official_best_conflict",)),
        Rule(c("official_neighbourhood_conflict"), "manual_review", "inspect_official_neighbourhood_conflict", "medium", ("official_neighbourhood_conflict",)),
        Rule(~single, "manual_review", "inspect_ambiguous_raw_match", "medium", ("ambiguous_candidate_field",)),
        Rule(c("within_tight_sky_threshold"), "supplemental_match", "add_supplemental_crossmatch", "medium", ("clean_one_to_one_tight_sky_candidate",)),
        Rule(c("within_rendered_distance_threshold"), "supplemental_match", "add_supplemental_crossmatch", "medium", ("clean_one_to_one_rendered_distance_candidate",)),
        Rule(finite("rendered_3d_separation_pc"), "display_separate", "keep_both_visible", "info", ("rendered_3d_separation_gt_threshold",)),
        Rule(F.lit(True), "display_separate", "keep_both_visible", "info", ("missing_rendered_distance",)),
    ]
    common = [
        F.lit("close_sky_position"),
        F.when(finite("apparent_mag_delta"), F.lit("apparent_magnitude_recorded")),
        F.when(c("isolated_sky_pair"), F.lit("isolated_within_scan_radius")).when(single, F.lit("one_to_one_candidate_but_not_sky_isolated")),
    ]
    text = {n: c(n).cast("string") for n in ("gaia_official_hip_source_id", "hip_official_gaia_source_id")}
    named = rows.withColumns({**decide(rules, common), **text, "gaia_source_id": c("id").cast("string"), "hip_source_id": c("id2").cast("string")})
    return named.select(*EVIDENCE_COLUMNS)


#: The columns of the evidence, in order.
EVIDENCE_COLUMNS = (
    "gaia_source_id", "hip_source_id", "decision", "recommended_action", "severity", "reasons", "separation_arcsec", "apparent_mag_delta", "gaia_ra_deg", "gaia_dec_deg", "hip_ra_deg", "hip_dec_deg",
    "hip_ra_deg_epoch1991", "hip_dec_deg_epoch1991", "gaia_apparent_mag", "hip_apparent_mag", "gaia_phot_bp_mean_mag", "gaia_phot_rp_mean_mag", "gaia_bp_rp", "gaia_plx_mas", "gaia_e_plx_mas", "gaia_r_pc",
    "hip_plx_mas", "hip_e_plx_mas", "hip_r_pc", "gaia_parallax_frac_error", "hip_parallax_frac_error", "rendered_3d_separation_pc", "hip_pmra_masyr", "hip_pmdec_masyr", "hip_solution_type",
    "gaia_sky_neighbour_count", "hip_sky_neighbour_count", "gaia_candidate_count", "hip_candidate_count", "one_to_one_candidate", "isolated_sky_pair", "official_pair", "gaia_has_official_map",
    "hip_has_official_map", "official_conflict", "in_official_neighbourhood", "official_neighbourhood_conflict", "within_tight_sky_threshold", "within_rendered_distance_threshold",
    "gaia_official_hip_source_id", "hip_official_gaia_source_id",
)


def display_order(evidence: DataFrame) -> DataFrame:
    """Evidence in its published order; the second id settles what the others leave open."""
    return evidence.orderBy("decision", F.col("separation_arcsec").asc_nulls_last(), F.col("apparent_mag_delta").asc_nulls_last(), "gaia_source_id", "hip_source_id")


def match_report(evidence: DataFrame) -> DataFrame:
    """The report's scalars in one row and one pass."""
    count = lambda cond, name: F.count_if(cond).alias(name)
    d = F.col("decision")
    return evidence.agg(
        F.count(F.lit(1)).alias("evidence_pairs"), count(d == "official_confirmed", "official_confirmed"), count(d == "supplemental_match", "supplemental_match"),
        count(d == "manual_review", "manual_review"), count(d == "display_separate", "display_separate"), count(F.col("official_pair"), "official_pairs_in_evidence"),
        count(F.col("one_to_one_candidate"), "one_to_one"), count(F.col("isolated_sky_pair"), "isolated"),
    )
