"""Queries over review cohorts and priority scores, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.functions.numeric import finite_or_null
from starweave.operators import cohorts as co
from starweave.operators import scoring as sc
from starweave.operators.latest import latest_values
from starweave.operators.maps import supplemental_map
from starweave.operators.packed_fields import explode_packed_fields
from starweave.plans import match_queries as mq
from starweave.plans import problem_queries as pq
from starweave.session import materialise
from starweave.sources.tables import table

KEEP = ["mag", "quality_flags", "quality_flag_count", "pm_total_masyr", "r_pc_parallax", "parallax_frac_error"]
#: Cohorts of each catalogue: name, metric, ascending.
SURVEY_COHORTS = (("brightest", "mag", True), ("nearest", "parallax", False))
CATALOGUE_COHORTS = (("brightest", "mag", True), ("nearest", "parallax", False), ("high_pm", "pm_total_masyr", False))


def survey(spark: SparkSession, sf: str) -> DataFrame:
    f = finite_or_null
    cols = {"mag": f("phot_g_mean_mag"), "phot_bp_mean_mag": f("phot_bp_mean_mag"), "phot_rp_mean_mag": f("phot_rp_mean_mag"), "parallax": f("parallax"), "parallax_error": f("parallax_error")}
    return co.with_quality(latest_values(table(spark, sf, "raw_gaia"), "source_id", cols, "loaded_at"), co.survey_flags)


def catalogue(spark: SparkSession, sf: str) -> DataFrame:
    f = finite_or_null
    cols = {"mag": F.when(f("hpmag") < 50, F.col("hpmag")), "parallax": f("plx"), "parallax_error": f("e_plx"), "pmra": f("pmra"), "pmdec": f("pmde"), "sn": F.col("sn")}
    return co.with_quality(latest_values(table(spark, sf, "raw_hip"), "hip", cols, "loaded_at"), co.catalogue_flags)


def cohort_rows(spark: SparkSession, sf: str, size: int = co.COHORT_SIZE) -> DataFrame:
    """All cohorts of both catalogues with their ranks."""
    parts = [co.top_cohorts(survey(spark, sf), SURVEY_COHORTS, size).withColumn("catalog_name", F.lit("gaia")), co.top_cohorts(catalogue(spark, sf), CATALOGUE_COHORTS, size).withColumn("catalog_name", F.lit("hip"))]
    cols = ["catalog_name", F.col("id").alias("source_id"), "cohort", "cohort_rank", "quality_flags", "quality_flag_count", "r_pc_parallax", "parallax_frac_error"]
    return mq.rounded(parts[0].select(*cols).unionByName(parts[1].select(*cols)), 7)


def _candidates(spark: SparkSession, sf: str, size: int) -> DataFrame:
    """Rolled-up candidates of both catalogues with their cross-match context."""
    official, near = mq.official(spark, sf), mq.neighbourhood(spark, sf)
    local = materialise(supplemental_map(mq.evidence(spark, sf)))
    g, h = co.roll_up(co.top_cohorts(survey(spark, sf), SURVEY_COHORTS, size), KEEP), co.roll_up(co.top_cohorts(catalogue(spark, sf), CATALOGUE_COHORTS, size), KEEP)
    rolled = materialise(g.withColumn("catalog_name", F.lit("gaia")).unionByName(h.withColumn("catalog_name", F.lit("hip"))))
    g = co.with_context(rolled.where("catalog_name = 'gaia'"), "gaia_source_id", "hip_source_id", official, local, near)
    h = co.with_context(rolled.where("catalog_name = 'hip'"), "hip_source_id", "gaia_source_id", official, local, near)
    return g.unionByName(h)


def review_candidates(spark: SparkSession, sf: str, size: int = co.COHORT_SIZE) -> DataFrame:
    cols = ["catalog_name", F.col("id").alias("source_id"), "cohorts", "cohort_ranks", "quality_flags", "quality_flag_count", "official_ids", "supplemental_ids", "official_neighbourhood_ids", "counterpart_ids", "has_any_gaia_hip_match"]
    return _candidates(spark, sf, size).select(*cols)


def candidate_flag_counts(spark: SparkSession, sf: str, size: int = co.COHORT_SIZE) -> DataFrame:
    return co.flag_counts(_candidates(spark, sf, size), ["catalog_name"])


def candidate_links(spark: SparkSession, sf: str, size: int = co.COHORT_SIZE) -> DataFrame:
    """Official pairs with both ends among the candidates."""
    return co.linked_pairs(mq.official(spark, sf), co.top_cohorts(survey(spark, sf), SURVEY_COHORTS, size), co.top_cohorts(catalogue(spark, sf), CATALOGUE_COHORTS, size))


def candidate_link_count(spark: SparkSession, sf: str, size: int = co.COHORT_SIZE) -> DataFrame:
    """How many official pairs have both ends among the candidates."""
    return candidate_links(spark, sf, size).agg(F.count(F.lit(1)).alias("n_links"))


def priority_scores(spark: SparkSession, sf: str, size: int = co.COHORT_SIZE) -> DataFrame:
    return mq.rounded(sc.score_candidates(_candidates(spark, sf, size)), 7, r_pc_parallax=5, pm_total_masyr=5)


def priority_tiers(spark: SparkSession, sf: str, size: int = co.COHORT_SIZE) -> DataFrame:
    return sc.score_candidates(_candidates(spark, sf, size)).groupBy("catalog_name", "priority_tier").agg(F.count(F.lit(1)).alias("n"))


def rescored_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """Quality scores from the recorded flags of every review, however they are packed, by tier."""
    rows = table(spark, sf, "review_scores").dropDuplicates(["review_id"])
    flags = explode_packed_fields(rows, "review_id", ["quality_flags"], "review_scores")
    weights = F.create_map(*[F.lit(x) for pair in sc.FLAG_WEIGHTS.items() for x in pair])
    points = flags.groupBy(F.col("record_id").alias("review_id")).agg(F.least(F.sum(F.coalesce(F.try_element_at(weights, F.col("item_value")), F.lit(0.0))), F.lit(sc.QUALITY_CAP)).alias("points"))
    scored = rows.select("review_id", "priority_tier").join(points, "review_id", "left")
    return scored.groupBy("priority_tier").agg(F.count(F.lit(1)).alias("n"), F.round(F.coalesce(F.sum("points"), F.lit(0.0)), 3).alias("quality_total"))


QUERIES = {f.__name__: f for f in (cohort_rows, review_candidates, candidate_flag_counts, candidate_links, candidate_link_count, priority_scores, priority_tiers, rescored_tiers)}

_N = co.COHORT_SIZE
_FLAGS_G = "concat_ws(';', CASE WHEN abs(e_plx) / abs(nullif(plx, 0)) > 0.1 THEN 'parallax_frac_error_gt_0p1' END, CASE WHEN plx <= 0 THEN 'non_positive_parallax' END, CASE WHEN bp IS NULL OR rp IS NULL THEN 'missing_bp_or_rp' END)"
_FLAGS_H = "concat_ws(';', CASE WHEN abs(e_plx) / abs(nullif(plx, 0)) > 0.1 THEN 'parallax_frac_error_gt_0p1' END, CASE WHEN plx <= 0 THEN 'non_positive_parallax' END, CASE WHEN sn <> 5 THEN 'hip_solution_type_not_5' END)"


def _top(table_name: str, catalog: str, cohort: str, order: str, where: str) -> str:
    pick = f"SELECT '{catalog}' AS cat, '{cohort}' AS cohort, row_number() OVER (ORDER BY {order}, id) AS rk, * FROM {table_name} WHERE {where}"
    return f"SELECT * FROM ({pick}) WHERE rk <= {_N}"


_RANKED = f"""
gq AS (SELECT id, g AS mag, plx, e_plx, CAST(NULL AS DOUBLE) AS pm, {_FLAGS_G} AS flags FROM g0),
hq AS (SELECT id, mag, plx, e_plx, sqrt(pmra * pmra + pmdec * pmdec) AS pm, {_FLAGS_H} AS flags FROM h0),
ranked AS ({_top("gq", "gaia", "brightest", "mag", "mag IS NOT NULL")} UNION ALL {_top("gq", "gaia", "nearest", "plx DESC", "plx > 0")} UNION ALL {_top("hq", "hip", "brightest", "mag", "mag IS NOT NULL")}
  UNION ALL {_top("hq", "hip", "nearest", "plx DESC", "plx > 0")} UNION ALL {_top("hq", "hip", "high_pm", "pm DESC", "pm IS NOT NULL")}),
o1 AS (SELECT *, list_position(['brightest', 'nearest', 'high_pm'], cohort) AS o FROM ranked),
rolled AS (SELECT cat, id, any_value(mag) AS mag, any_value(plx) AS plx, any_value(e_plx) AS e_plx, any_value(pm) AS pm, any_value(flags) AS flags, string_agg(cohort, ';' ORDER BY rk, o) AS cohorts, string_agg(cohort || ':' || rk, ';' ORDER BY rk, o) AS ranks,
  count(*) AS n, max(rk) FILTER (cohort = 'brightest') AS rb, max(rk) FILTER (cohort = 'nearest') AS rn, max(rk) FILTER (cohort = 'high_pm') AS rh FROM o1 GROUP BY 1, 2)
"""


def _ids(src: str) -> str:
    both = f"SELECT 'gaia' AS cat, gaia_source_id AS id, hip_source_id AS v FROM {src} UNION SELECT 'hip', hip_source_id, gaia_source_id FROM {src}"
    return f"(SELECT cat, id, string_agg(CAST(v AS VARCHAR), ';' ORDER BY v) AS l, list(CAST(v AS VARCHAR) ORDER BY v) AS a FROM ({both}) GROUP BY 1, 2)"


_CANDIDATES = mq._evidence() + f""", {_RANKED}, sp AS (SELECT gid AS gaia_source_id, hid AS hip_source_id FROM ev WHERE decision = 'supplemental_match'),
cand AS (SELECT r.*, CASE WHEN flags = '' THEN 0 ELSE length(flags) - length(replace(flags, ';', '')) + 1 END AS nf, coalesce(a.l, '') AS oi, coalesce(b.l, '') AS si, coalesce(c.l, '') AS ni,
  array_to_string(list_concat(coalesce(a.a, []), list_filter(coalesce(b.a, []), lambda x: NOT list_contains(coalesce(a.a, []), x))), ';') AS ci
  FROM rolled r LEFT JOIN {_ids("o")} a USING (cat, id) LEFT JOIN {_ids("sp")} b USING (cat, id) LEFT JOIN {_ids("nb")} c USING (cat, id)),
s1 AS (SELECT *, round(coalesce(30.0 * (501 - rb) / 500.0, 0) + coalesce(30.0 * (501 - rn) / 500.0, 0) + coalesce(18.0 * (501 - rh) / 500.0, 0) + CASE n WHEN 1 THEN 0 WHEN 2 THEN 10 ELSE 18 END, 3) AS cs,
  least(30.0, CASE WHEN flags LIKE '%parallax_frac%' THEN 5 ELSE 0 END + CASE WHEN flags LIKE '%non_positive%' THEN 10 ELSE 0 END + CASE WHEN flags LIKE '%missing_bp%' THEN 5 ELSE 0 END + CASE WHEN flags LIKE '%solution_type%' THEN 10 ELSE 0 END) AS qs,
  CASE WHEN plx > 0 THEN 1000.0 / plx END AS r, oi <> '' AS ho, si <> '' AS hs, ci <> '' AS ha FROM cand),
s2 AS (SELECT *, CAST(CASE WHEN mag <= 2 THEN 12 WHEN mag <= 4 THEN 8 WHEN mag <= 6 THEN 5 WHEN mag <= 8 THEN 2 ELSE 0 END + CASE WHEN r <= 5 THEN 12 WHEN r <= 10 THEN 8 WHEN r <= 20 THEN 4 ELSE 0 END + CASE WHEN pm >= 3000 THEN 12 WHEN pm >= 2000 THEN 9 WHEN pm >= 1000 THEN 6 ELSE 0 END AS DOUBLE) AS vs,
  CAST(CASE WHEN NOT ha THEN 22 WHEN hs AND NOT ho THEN 6 ELSE 0 END + CASE WHEN ni <> '' AND NOT ho THEN 8 ELSE 0 END AS DOUBLE) AS gs FROM s1),
s3 AS (SELECT *, round(cs + vs + qs + gs, 3) AS ps FROM s2),
s4 AS (SELECT *, CASE WHEN ps >= 105 OR (NOT ha AND n >= 2 AND qs >= 15) THEN 'P1' WHEN ps >= 80 OR (NOT ha AND qs >= 10) THEN 'P2' WHEN ps >= 55 THEN 'P3' ELSE 'P4' END AS tier,
  concat_ws(';', CASE WHEN rb IS NOT NULL THEN 'brightest_rank=' || rb END, CASE WHEN rn IS NOT NULL THEN 'nearest_rank=' || rn END, CASE WHEN rh IS NOT NULL THEN 'high_pm_rank=' || rh END, CASE WHEN n >= 2 THEN 'multi_cohort=' || n END,
    CASE WHEN NOT ha THEN 'no_official_or_fis_gaia_hip_match' WHEN hs AND NOT ho THEN 'fis_supplemental_only_match' END, CASE WHEN ni <> '' AND NOT ho THEN 'official_neighbourhood_without_best_match' END, nullif(flags, '')) AS why,
  row_number() OVER (ORDER BY ps DESC, cs DESC, vs DESC, qs DESC, gs DESC, cat, CAST(id AS VARCHAR)) AS pr FROM s3)
"""

ORACLES = {
    "cohort_rows": f"WITH {mq.SOURCES}, {_RANKED} SELECT cat AS catalog_name, id AS source_id, cohort, CAST(rk AS INTEGER) AS cohort_rank, flags AS quality_flags, CAST(CASE WHEN flags = '' THEN 0 ELSE length(flags) - length(replace(flags, ';', '')) + 1 END AS INTEGER) AS quality_flag_count, round(CASE WHEN plx > 0 THEN 1000.0 / plx END, 7) AS r_pc_parallax, round(abs(e_plx) / abs(nullif(plx, 0)), 7) AS parallax_frac_error FROM ranked",
    "review_candidates": _CANDIDATES + "SELECT cat AS catalog_name, id AS source_id, cohorts, ranks AS cohort_ranks, flags AS quality_flags, CAST(nf AS INTEGER) AS quality_flag_count, oi AS official_ids, si AS supplemental_ids, ni AS official_neighbourhood_ids, ci AS counterpart_ids, ha AS has_any_gaia_hip_match FROM s4",
    "candidate_flag_counts": _CANDIDATES + "SELECT cat AS catalog_name, flag, count(*) AS n FROM (SELECT cat, unnest(string_split(flags, ';')) AS flag FROM cand) WHERE flag <> '' GROUP BY ALL",
    "candidate_links": f"WITH {mq.SOURCES}, {mq.MAPS}, {_RANKED} SELECT DISTINCT gaia_source_id, hip_source_id FROM o WHERE gaia_source_id IN (SELECT id FROM ranked WHERE cat = 'gaia') AND hip_source_id IN (SELECT id FROM ranked WHERE cat = 'hip')",
    "candidate_link_count": f"WITH {mq.SOURCES}, {mq.MAPS}, {_RANKED} SELECT count(DISTINCT (gaia_source_id, hip_source_id)) AS n_links FROM o WHERE gaia_source_id IN (SELECT id FROM ranked WHERE cat = 'gaia') AND hip_source_id IN (SELECT id FROM ranked WHERE cat = 'hip')",
    "priority_scores": _CANDIDATES + "SELECT CAST(pr AS INTEGER) AS priority_rank, ps AS priority_score, tier AS priority_tier, cat AS catalog_name, CAST(id AS VARCHAR) AS source_id, cohorts, ranks AS cohort_ranks, CAST(n AS INTEGER) AS cohort_count, cs AS cohort_score, vs AS visibility_score, CAST(qs AS DOUBLE) AS quality_score, gs AS crossmatch_gap_score, why AS priority_reasons, flags AS quality_flags, CAST(nf AS INTEGER) AS quality_flag_count, ho AS has_official_best_neighbour, hs AS has_fis_supplemental_match, ha AS has_any_gaia_hip_match, ni AS official_neighbourhood_ids, ci AS counterpart_ids, round(mag, 7) AS apparent_mag, round(r, 5) AS r_pc_parallax, round(pm, 5) AS pm_total_masyr FROM s4",
    "priority_tiers": _CANDIDATES + "SELECT cat AS catalog_name, tier AS priority_tier, count(*) AS n FROM s4 GROUP BY ALL",
}
ORACLES["rescored_tiers"] = f"""SELECT priority_tier, count(*) AS n, CAST(round(coalesce(sum(q), 0), 3) AS DOUBLE) AS quality_total FROM (SELECT review_id, any_value(priority_tier) AS priority_tier FROM review_scores GROUP BY 1)
  LEFT JOIN (SELECT record_id AS review_id, least(30.0, sum(CASE item_value {" ".join(f"WHEN '{k}' THEN {v}" for k, v in sc.FLAG_WEIGHTS.items())} ELSE 0.0 END)) AS q
    FROM ({pq.ORACLES["p1_found"]}) WHERE field_name = 'quality_flags' GROUP BY 1) USING (review_id) GROUP BY 1"""
