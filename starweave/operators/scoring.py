"""Priority scores of review candidates: transparent sums of small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starweave.functions.numeric import finite, finite_or_null
from starweave.operators.cohorts import COHORT_SIZE, COHORTS

#: Weights of cohorts and flags, and score steps.
COHORT_WEIGHTS = {"brightest": 30.0, "nearest": 30.0, "high_pm": 18.0}
FLAG_WEIGHTS = {
    "ruwe_gt_1p4": 10.0, "astrometric_excess_noise_gt_1": 8.0, "ipd_frac_multi_peak_gt_10": 8.0, "duplicated_source": 8.0, "non_single_star": 6.0, "astrometric_params_not_31_or_95": 6.0, "visibility_periods_lt_8": 5.0,
    "missing_bp_or_rp": 5.0, "parallax_frac_error_gt_0p1": 5.0, "non_positive_parallax": 10.0, "phot_variable": 2.0, "hip_solution_type_not_5": 10.0, "hip_component_flag": 8.0,
}
QUALITY_CAP = 30.0
MAGNITUDE_STEPS = ((2.0, 12.0), (4.0, 8.0), (6.0, 5.0), (8.0, 2.0))
DISTANCE_STEPS = ((5.0, 12.0), (10.0, 8.0), (20.0, 4.0))
MOTION_STEPS = ((3000.0, 12.0), (2000.0, 9.0), (1000.0, 6.0))


def rank_map(text: Column) -> Column:
    """``name:rank;...`` as a map; parts without a whole number are left out, of repeated names the last counts."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ";"), lambda p: F.struct(F.trim(F.substring_index(p, ":", 1)).alias("k"), F.when(F.contains(p, F.lit(":")), F.trim(F.substr(p, F.instr(p, ":") + 1))).try_cast("int").alias("v")))
    good = F.filter(parts, lambda p: p["v"].isNotNull())
    last = F.filter(good, lambda p, i: ~F.exists(F.slice(good, i + 2, F.greatest(F.size(good) - i - 1, F.lit(0))), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)


def steps(value: Column, table: tuple[tuple[float, float], ...], at_most: bool) -> Column:
    """The points of the first step a finite value meets, else 0."""
    out = F.lit(0.0)
    for limit, points in reversed(table):
        out = F.when((value <= limit) if at_most else (value >= limit), F.lit(points)).otherwise(out)
    return F.when(finite(value), out).otherwise(F.lit(0.0))


def split_list(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ";"), lambda part: F.trim(part)), lambda x: (x != "") & ~F.lower(x).isin("nan", "none", "<na>"))


def truthy(c: Column) -> Column:
    """Yes in any usual spelling; missing is no."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("true", "1", "yes", "y"), F.lit(False))


def cohort_score(ranks: Column) -> Column:
    parts = [F.coalesce(F.lit(w) * F.greatest(F.lit(0.0), (F.lit(COHORT_SIZE + 1) - F.try_element_at(ranks, F.lit(c))) / F.lit(float(COHORT_SIZE))), F.lit(0.0)) for c, w in COHORT_WEIGHTS.items()]
    many = F.size(F.map_keys(ranks))
    return F.round(sum(parts[1:], parts[0]) + F.when(many == 2, 10.0).when(many >= 3, 18.0).otherwise(0.0), 3)


def quality_score(flags: Column) -> Column:
    weights = F.create_map(*[F.lit(x) for pair in FLAG_WEIGHTS.items() for x in pair])
    return F.least(F.aggregate(split_list(flags), F.lit(0.0), lambda acc, f: acc + F.coalesce(F.try_element_at(weights, f), F.lit(0.0))), F.lit(QUALITY_CAP))


def score_candidates(df: DataFrame) -> DataFrame:
    """Candidates with their component scores, total, tier, reasons and rank.

    Needs catalog_name, id, cohorts, cohort_ranks, quality_flags, quality_flag_count, mag,
    r_pc_parallax, pm_total_masyr, the three match flags and the two id lists. The rank is a total
    order (catalogue and id come last); it runs over the selected candidates, a few thousand rows."""
    c = F.col
    df = df.withColumns({"ranks": rank_map(c("cohort_ranks")), "cohort_count": F.size(split_list(c("cohorts"))), "apparent_mag": finite_or_null("mag"), **{f: truthy(c(f)) for f in ("has_official_best_neighbour", "has_fis_supplemental_match", "has_any_gaia_hip_match")}})
    unmatched, lonely = ~c("has_any_gaia_hip_match"), ~c("has_official_best_neighbour")
    nearby = F.coalesce(c("official_neighbourhood_ids"), F.lit("")) != ""
    df = df.withColumns({
        "cohort_score": cohort_score(c("ranks")), "quality_score": quality_score(c("quality_flags")),
        "visibility_score": steps(c("apparent_mag"), MAGNITUDE_STEPS, True) + steps(c("r_pc_parallax"), DISTANCE_STEPS, True) + steps(c("pm_total_masyr"), MOTION_STEPS, False),
        "crossmatch_gap_score": F.when(unmatched, 22.0).when(c("has_fis_supplemental_match") & lonely, 6.0).otherwise(0.0) + F.when(nearby & lonely, 8.0).otherwise(0.0),
    })
    df = df.withColumn("priority_score", F.round(c("cohort_score") + c("visibility_score") + c("quality_score") + c("crossmatch_gap_score"), 3))
    total, quality, several = c("priority_score"), c("quality_score"), c("cohort_count") >= 2
    tier = F.when((total >= 105) | (unmatched & several & (quality >= 15)), "P1").when((total >= 80) | (unmatched & (quality >= 10)), "P2").when(total >= 55, "P3").otherwise("P4")
    named = [F.when(F.map_contains_key("ranks", F.lit(n)), F.concat(F.lit(f"{n}_rank="), F.try_element_at("ranks", F.lit(n)).cast("string"))) for n in COHORTS]
    notes = [
        *named, F.when(several, F.concat(F.lit("multi_cohort="), c("cohort_count").cast("string"))),
        F.when(unmatched, "no_official_or_fis_gaia_hip_match").when(c("has_fis_supplemental_match") & lonely, "fis_supplemental_only_match"), F.when(nearby & lonely, "official_neighbourhood_without_best_match"),
    ]
    df = df.withColumns({"priority_tier": tier, "priority_reasons": F.array_join(F.concat(F.array_compact(F.array(*notes)), split_list(c("quality_flags"))), ";")})
    keys = [c(k).desc() for k in ("priority_score", "cohort_score", "visibility_score", "quality_score", "crossmatch_gap_score")]
    order = Window.orderBy(*keys, "catalog_name", c("id").cast("string"))
    return df.withColumn("priority_rank", F.row_number().over(order)).select(
        "priority_rank", "priority_score", "priority_tier", "catalog_name", c("id").cast("string").alias("source_id"), "cohorts", "cohort_ranks", "cohort_count", "cohort_score", "visibility_score", "quality_score",
        "crossmatch_gap_score", "priority_reasons", "quality_flags", "quality_flag_count", "has_official_best_neighbour", "has_fis_supplemental_match", "has_any_gaia_hip_match", "official_neighbourhood_ids",
        "counterpart_ids", "apparent_mag", "r_pc_parallax", "pm_total_masyr",
    )
