"""Queries over the processed-catalogue audit and the review tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.functions.geometry import distance_pc
from starweave.functions.numeric import finite_or_null
from starweave.operators import match_audit as ma
from starweave.operators import match_evidence as me
from starweave.operators.latest import latest_values
from starweave.operators.maps import supplemental_map
from starweave.operators.review import manual_queue, review_table
from starweave.plans import match_queries as mq
from starweave.sources.tables import read_overrides, table


def processed_gaia(spark: SparkSession, sf: str) -> DataFrame:
    """The survey in processed form: distance from parallax, absolute magnitude, relative error as quality."""
    rows = me.primary_sources(table(spark, sf, "raw_gaia"))
    r = distance_pc(F.col("plx"))
    return rows.withColumnRenamed("g", "phot_g_mean_mag").select("phot_g_mean_mag", F.lit("gaia").alias("source"), F.col("id").alias("source_id"), F.col("ra").alias("ra_deg"), F.col("dec").alias("dec_deg"), r.alias("r_pc"), (F.col("phot_g_mean_mag") - 5.0 * F.log10(r) + 5.0).alias("mag_abs"), (F.col("e_plx") / F.when(F.col("plx") > 0, F.col("plx"))).alias("astrometry_quality"))


def processed_hip(spark: SparkSession, sf: str) -> DataFrame:
    names = ("ra_deg", "dec_deg", "r_pc", "mag_abs", "astrometry_quality", "photometry_quality", "sn", "hpmag")
    rows = latest_values(table(spark, sf, "processed_hip").where(F.col("source") == "hip"), "source_id", {c: finite_or_null(c) for c in names}, "loaded_at")
    return rows.withColumnRenamed("id", "source_id")


def audit(spark: SparkSession, sf: str) -> DataFrame:
    keys = read_overrides(table(spark, sf, "overrides"), ma.OVERRIDE_ACTIONS)
    return ma.match_audit(ma.processed_sources(processed_gaia(spark, sf), "gaia"), ma.processed_sources(processed_hip(spark, sf), "hip"), mq.official(spark, sf), keys)


def diagnosed(spark: SparkSession, sf: str) -> DataFrame:
    return ma.diagnostics(audit(spark, sf))


def audit_evidence(spark: SparkSession, sf: str) -> DataFrame:
    quality = dict.fromkeys(("gaia_astrometry_quality", "hip_astrometry_quality", "gaia_photometry_quality", "hip_photometry_quality", "gaia_apparent_mag", "hip_apparent_mag", "gaia_phot_g_mean_mag", "hip_hpmag"), 7)
    return mq.rounded(audit(spark, sf), 5, separation_arcsec=4, gaia_r_pc=4, hip_r_pc=4, distance_ratio=7, **quality)


def audit_diagnostics(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["gaia_source_id", "hip_source_id", "distance_pct_diff", "distance_abs_diff_pc", "worst_quality", "best_quality", "quality_ratio", "separation_3d_pc", "is_clean"]
    return mq.rounded(diagnosed(spark, sf).select(cols), 7, separation_3d_pc=3, distance_abs_diff_pc=4, distance_pct_diff=5, quality_ratio=5)


def audit_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return ma.distance_histogram(diagnosed(spark, sf))


def audit_quality_bins(spark: SparkSession, sf: str) -> DataFrame:
    return mq.rounded(ma.quality_summary(diagnosed(spark, sf)), 8, median_distance_pct=5)


def audit_policies(spark: SparkSession, sf: str) -> DataFrame:
    return ma.policy_table(diagnosed(spark, sf))


def audit_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return mq.rounded(ma.exact_quantiles(diagnosed(spark, sf).where("is_clean"), "distance_pct_diff"), 5)


def audit_cdf(spark: SparkSession, sf: str) -> DataFrame:
    rows = diagnosed(spark, sf).withColumn("tenth", F.round("distance_pct_diff", 1))
    return mq.rounded(ma.empirical_cdf(rows, "tenth", "decision"))


def audit_categories(spark: SparkSession, sf: str) -> DataFrame:
    return mq.rounded(ma.scatter_categories(diagnosed(spark, sf)), 5)


def audit_supplemental(spark: SparkSession, sf: str) -> DataFrame:
    return supplemental_map(audit(spark, sf), "auto_match").select("gaia_source_id", "hip_source_id", "mapping_source")


def issues(spark: SparkSession, sf: str) -> DataFrame:
    """Quality issues in the processed catalogue: rows far off in distance or brightness."""
    rows = processed_hip(spark, sf).where((F.col("r_pc") > 2000) | (F.col("mag_abs") < -6))
    return rows.select(F.lit("merged_row_extreme").alias("issue_type"), F.lit("high").alias("severity"), F.lit("hip").alias("source"), F.col("source_id").cast("string").alias("source_id"), F.lit("extreme_distance_or_brightness").alias("reasons"), F.col("ra_deg").alias("merged_ra_deg"), F.col("dec_deg").alias("merged_dec_deg"), F.col("r_pc").alias("merged_r_pc"), F.col("mag_abs").alias("merged_mag_abs"))


def review_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence pairs kept apart go to review as close pairs, with the extreme rows."""
    e = mq.evidence(spark, sf).withColumn("decision", F.when(F.col("decision") == "display_separate", "octree_review").otherwise(F.col("decision")))
    cols = ["source", "source_id", "issue_type", "severity", "display_action", "linked_source", "linked_source_id", "reasons", "ra_deg", "dec_deg", "r_pc", "separation_arcsec"]
    return mq.rounded(review_table(e, issues(spark, sf)).select(cols), 4)


def manual_rows(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["issue_type", "severity", "recommended_action", "reasons", "source", "source_id", "gaia_source_id", "hip_source_id", "separation_arcsec", "merged_r_pc"]
    e = audit(spark, sf).withColumns({c: F.col(c).cast("string") for c in ("gaia_source_id", "hip_source_id")})
    return mq.rounded(manual_queue(e, issues(spark, sf)).select(cols), 4)


def conflict_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Official pairs whose processed distances differ by more than half, as issues in the manual queue."""
    g = processed_gaia(spark, sf).select(F.col("source_id").alias("gaia_source_id"), F.col("r_pc").alias("gaia_r_pc")).where("gaia_r_pc IS NOT NULL")
    h = processed_hip(spark, sf).select(F.col("source_id").alias("hip_source_id"), F.col("r_pc").alias("hip_r_pc")).where("hip_r_pc > 0")
    pairs = mq.official(spark, sf).join(g, "gaia_source_id").join(h, "hip_source_id")
    off = F.abs(F.col("gaia_r_pc") - F.col("hip_r_pc")) / F.greatest("gaia_r_pc", "hip_r_pc")
    bad = pairs.withColumn("distance_frac_diff", off).where(off > 0.5).withColumn("source_id", F.col("hip_source_id").cast("string"))
    marks = {"issue_type": "matched_pair_conflict", "severity": "medium", "source": "hip", "reasons": "distance_conflict"}
    bad = bad.withColumns({k: F.lit(v) for k, v in marks.items()}).withColumnRenamed("angular_distance", "angular_distance_arcsec")
    cols = ["issue_type", "severity", "recommended_action", "reasons", "source", "source_id", "gaia_source_id", "hip_source_id", "separation_arcsec", "distance_frac_diff", "gaia_r_pc", "hip_r_pc"]
    return mq.rounded(manual_queue(spark.createDataFrame([], "decision string, hip_source_id string"), bad).select(cols), 4, separation_arcsec=3)


QUERIES = {f.__name__: f for f in (conflict_rows, audit_evidence, audit_diagnostics, audit_histogram, audit_quality_bins, audit_policies, audit_quantiles, audit_cdf, audit_categories, audit_supplemental, review_rows, manual_rows)}

_L = mq._last
_KEY = "TRY_CAST(regexp_extract(regexp_replace(source_id, '(?i)^\\s*gaia\\s*e?dr\\s*[0-9]+($|[^0-9])', '\\1'), '([0-9]+)[^0-9]*$', 1) AS BIGINT)"
_HIP = f"hq AS (SELECT source_id AS id, {_L('ra_deg')} AS ra, {_L('dec_deg')} AS dec, {_L('r_pc')} AS r, {_L('mag_abs')} AS ma, {_L('astrometry_quality')} AS q, {_L('photometry_quality')} AS pq, {_L('sn')} AS sn, {_L('hpmag')} AS hpmag FROM processed_hip WHERE source = 'hip' GROUP BY 1)"
_AUDIT = f"""WITH {mq.SOURCES}, {mq.MAPS}, {_HIP},
pg AS (SELECT *, 1000.0 / plx AS r, g - 5.0 * log10(1000.0 / plx) + 5.0 AS ma, e_plx / plx AS q FROM g WHERE plx > 0),
pg2 AS (SELECT *, ma + 5.0 * log10(r) - 5.0 AS m FROM pg),
ph AS (SELECT *, ma + 5.0 * log10(r) - 5.0 AS m, cos(radians(dec)) * cos(radians(ra)) AS x, cos(radians(dec)) * sin(radians(ra)) AS y, sin(radians(dec)) AS z FROM hq WHERE r > 0 AND ma IS NOT NULL AND ra IS NOT NULL AND dec IS NOT NULL),
ov AS (SELECT DISTINCT lower(trim(source)) AS s, {_KEY} AS k FROM overrides WHERE lower(trim(override_action)) IN ('replace', 'drop', 'add')),
a0 AS (SELECT a.id AS gid, b.id AS hid, pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2) AS d2, abs(a.m - b.m) AS dm, a.r AS gr, b.r AS hr, a.q AS gq, b.q AS hq, a.ra AS gra, a.dec AS gdec, b.ra AS hra, b.dec AS hdec, a.ma AS gma, b.ma AS hma, a.m AS gm, b.m AS hm, a.g AS gg, b.pq AS hpq, b.sn AS hsn, b.hpmag AS hhp FROM pg2 a JOIN ph b ON a.dec BETWEEN b.dec - 0.0015 AND b.dec + 0.0015),
a1 AS (SELECT *, degrees(2 * asin(least(sqrt(d2) / 2, 1))) * 3600 AS sep, count(*) OVER (PARTITION BY gid) AS gc, count(*) OVER (PARTITION BY hid) AS hc FROM a0
       WHERE d2 <= pow(2 * sin(radians(5.0 / 3600.0) / 2), 2) AND dm <= 0.5 AND NOT EXISTS (FROM o WHERE gaia_source_id = gid AND hip_source_id = hid)),
a2 AS (SELECT *, greatest(gr, hr) / least(gr, hr) AS ratio, abs(gr - hr) / greatest(gr, hr) AS frac, gc = 1 AND hc = 1 AS one, sep <= 0.25 AND dm <= 0.25 AS tight,
       EXISTS (FROM o WHERE gaia_source_id = gid) OR EXISTS (FROM o WHERE hip_source_id = hid) AS conf, EXISTS (FROM ov WHERE s = 'gaia' AND k = gid) OR EXISTS (FROM ov WHERE s = 'hip' AND k = hid) AS over FROM a1),
a3 AS (SELECT *, CASE WHEN over THEN 1 WHEN conf THEN 2 WHEN NOT one THEN 3 WHEN tight THEN 4 ELSE 5 END AS rule FROM a2),
au AS (SELECT *, CASE WHEN rule <= 3 THEN 'manual_review' ELSE 'auto_match' END AS decision, ['inspect_override_interaction', 'inspect_conflicting_crossmatch', 'inspect_ambiguous_close_pair', 'add_supplemental_crossmatch', 'add_supplemental_crossmatch'][rule] AS recommended_action,
       CASE WHEN rule <= 3 THEN 'high' ELSE 'medium' END AS severity, 'close_cross_catalog_position;similar_apparent_magnitude;' || ['manual_override_present', 'official_crossmatch_conflict', 'ambiguous_many_to_one_candidate', 'clean_one_to_one_broad_scan_match;tight_sky_mag_match', 'clean_one_to_one_broad_scan_match;distance_disagreement_recorded_not_vetoed'][rule] AS reasons,
       frac * 100.0 AS pct, coalesce(greatest(gq, hq), gq, hq) AS worst, coalesce(least(gq, hq), gq, hq) AS best, NOT conf AND NOT over AND one AS clean FROM a3)
"""
_EDGES = ", ".join(f"({float(a)}, {float(b)})" for a, b in zip(ma.HISTOGRAM_EDGES[:-1], ma.HISTOGRAM_EDGES[1:], strict=True))
_QBINS = ", ".join(f"({float(a)}, {float(b)}, '{a:g}-{b:g}')" for a, b in zip(ma.QUALITY_EDGES[:-1], ma.QUALITY_EDGES[1:], strict=True)) + f", (10.0, 1e300, '>=10')"
_QUANT = ", ".join(f"({float(q)})" for q in ma.QUANTILES)
_ISSUES = "SELECT CAST(id AS VARCHAR) AS source_id, ra, dec, r FROM hq WHERE r > 2000 OR ma < -6"

ORACLES = {
    "conflict_rows": _AUDIT + """SELECT 'matched_pair_conflict' AS issue_type, 'medium' AS severity, 'create_or_review_override' AS recommended_action, 'distance_conflict' AS reasons, 'hip' AS source, CAST(hip_source_id AS VARCHAR) AS source_id, CAST(gaia_source_id AS VARCHAR) AS gaia_source_id,
      CAST(hip_source_id AS VARCHAR) AS hip_source_id, round(CAST(angular_distance AS DOUBLE), 3) AS separation_arcsec, round(abs(pg.r - hq.r) / greatest(pg.r, hq.r), 4) AS distance_frac_diff, round(pg.r, 4) AS gaia_r_pc, round(hq.r, 4) AS hip_r_pc
      FROM o JOIN pg ON pg.id = gaia_source_id JOIN hq ON hq.id = hip_source_id WHERE hq.r > 0 AND abs(pg.r - hq.r) / greatest(pg.r, hq.r) > 0.5""",
    "audit_evidence": _AUDIT + """SELECT gid AS gaia_source_id, hid AS hip_source_id, decision, recommended_action, severity, reasons, round(sep, 4) AS separation_arcsec, round(dm, 5) AS apparent_mag_delta, round(ratio, 7) AS distance_ratio, round(frac, 5) AS distance_frac_diff,
      round(gra, 5) AS gaia_ra_deg, round(gdec, 5) AS gaia_dec_deg, round(hra, 5) AS hip_ra_deg, round(hdec, 5) AS hip_dec_deg, round(gr, 4) AS gaia_r_pc, round(hr, 4) AS hip_r_pc, round(gma, 5) AS gaia_mag_abs, round(hma, 5) AS hip_mag_abs, round(gm, 7) AS gaia_apparent_mag, round(hm, 7) AS hip_apparent_mag,
      round(gq, 7) AS gaia_astrometry_quality, round(hq, 7) AS hip_astrometry_quality, CAST(NULL AS DOUBLE) AS gaia_photometry_quality, round(hpq, 7) AS hip_photometry_quality, CAST(NULL AS DOUBLE) AS gaia_ruwe, round(gg, 7) AS gaia_phot_g_mean_mag, CAST(hsn AS DOUBLE) AS hip_solution_type, round(hhp, 7) AS hip_hpmag,
      gp IS NOT NULL AS gaia_has_official_map, hp IS NOT NULL AS hip_has_official_map, conf AS official_conflict, gp AS gaia_official_hip_source_id, hp AS hip_official_gaia_source_id, CAST(gc AS INTEGER) AS gaia_candidate_count, CAST(hc AS INTEGER) AS hip_candidate_count, one AS one_to_one, tight AS within_auto_thresholds,
      frac <= 0.10 AS within_distance_threshold, over AS overridden
      FROM au LEFT JOIN (SELECT gaia_source_id AS gk, max(hip_source_id) AS gp FROM o GROUP BY 1) ON gid = gk LEFT JOIN (SELECT hip_source_id AS hk, max(gaia_source_id) AS hp FROM o GROUP BY 1) ON hid = hk""",
    "audit_diagnostics": _AUDIT + "SELECT gid AS gaia_source_id, hid AS hip_source_id, round(pct, 5) AS distance_pct_diff, round(abs(gr - hr), 4) AS distance_abs_diff_pc, round(worst, 7) AS worst_quality, round(best, 7) AS best_quality, round(worst / nullif(best, 0), 5) AS quality_ratio, round(sqrt(greatest(0.0, gr * gr + hr * hr - 2.0 * gr * hr * cos(radians(sep / 3600.0)))), 3) AS separation_3d_pc, clean AS is_clean FROM au",
    "audit_histogram": _AUDIT + f"SELECT CAST(b.a AS DOUBLE) AS bin_start_pct, CAST(b.e AS DOUBLE) AS bin_end_pct, count(pct) FILTER (clean) AS clean_auto_eligible_count, count(pct) AS all_candidate_count FROM (VALUES {_EDGES}) b(a, e) LEFT JOIN au ON pct >= b.a AND (pct < b.e OR (b.e = 100.0 AND pct = 100.0)) GROUP BY 1, 2",
    "audit_quality_bins": _AUDIT + f"SELECT b.l AS worst_quality_bin, count(pct) AS n_rows, count(*) FILTER (frac <= 0.10) AS distance_pct_le_10, count(*) FILTER (frac > 0.10 AND frac <= 0.25) AS distance_pct_10_to_25, count(*) FILTER (frac > 0.25) AS distance_pct_gt_25, round(median(pct), 5) AS median_distance_pct, round(median(gq), 8) AS median_gaia_quality, round(median(hq), 8) AS median_hip_quality FROM (VALUES {_QBINS}) b(a, e, l) LEFT JOIN au ON clean AND worst >= b.a AND worst < b.e GROUP BY 1",
    "audit_policies": _AUDIT + "SELECT p.policy, count(*) FILTER (p.lim >= 9 OR tight OR frac <= p.lim) AS matched_clean_count, count(*) FILTER (p.lim >= 9 OR tight OR frac <= p.lim) - count(*) AS delta_vs_broad_scan_policy, count(*) FILTER (NOT tight AND (p.lim >= 9 OR frac <= p.lim)) AS non_tight_added FROM (VALUES ('tight sky/mag only', -1.0), ('tight or distance <= 10%', 0.10), ('tight or distance <= 25%', 0.25), ('broad clean one-to-one', 9.0)) p(policy, lim) CROSS JOIN (SELECT * FROM au WHERE clean) GROUP BY 1",
    "audit_quantiles": _AUDIT + "SELECT CAST(quantile AS DOUBLE) AS quantile, round(value, 5) AS value FROM (SELECT unnest([" + ", ".join(str(float(q)) for q in ma.QUANTILES) + "]) AS quantile, unnest(quantile_cont(pct, [" + ", ".join(str(float(q)) for q in ma.QUANTILES) + "])) AS value FROM au WHERE clean)",
    "audit_cdf": _AUDIT + ", t AS (SELECT decision, round(pct, 1) AS tenth, count(*) AS n FROM au GROUP BY ALL) SELECT decision, tenth, round(sum(n) OVER (PARTITION BY decision ORDER BY tenth) / sum(n) OVER (PARTITION BY decision), 6) AS cdf FROM t",
    "audit_categories": _AUDIT + "SELECT CASE WHEN over THEN 'overridden' WHEN conf THEN 'official conflict' WHEN NOT one THEN 'ambiguous' ELSE 'clean' END AS category, count(*) AS n, round(CASE WHEN count(*) > 1 THEN corr(log10(worst), log10(pct)) END, 5) AS log_correlation FROM au WHERE pct > 0 AND worst > 0 GROUP BY 1",
    "audit_supplemental": _AUDIT + "SELECT gid AS gaia_source_id, hid AS hip_source_id, 'local_close_pair_v1' AS mapping_source FROM au WHERE decision = 'auto_match'",
    "review_rows": mq._evidence() + f", {_HIP} SELECT 'hip' AS source, CAST(hid AS VARCHAR) AS source_id, 'close_cross_catalog_pair' AS issue_type, severity, 'suppress_candidate_duplicate' AS display_action, 'gaia' AS linked_source, CAST(gid AS VARCHAR) AS linked_source_id, reasons, round(hra, 4) AS ra_deg, round(hdec, 4) AS dec_deg, round(hr, 4) AS r_pc, round(sep, 4) AS separation_arcsec FROM ev WHERE decision = 'display_separate' UNION ALL SELECT 'hip', source_id, 'merged_row_extreme', 'high', 'quarantine_suspicious_star', NULL, NULL, 'extreme_distance_or_brightness', round(ra, 4), round(dec, 4), round(r, 4), NULL FROM ({_ISSUES})",
    "manual_rows": _AUDIT + f"SELECT 'close_pair_manual_review' AS issue_type, severity, recommended_action, reasons, 'hip' AS source, CAST(hid AS VARCHAR) AS source_id, CAST(gid AS VARCHAR) AS gaia_source_id, CAST(hid AS VARCHAR) AS hip_source_id, round(sep, 4) AS separation_arcsec, NULL AS merged_r_pc FROM au WHERE decision = 'manual_review' UNION ALL SELECT 'merged_row_extreme', 'high', 'create_or_review_override', 'extreme_distance_or_brightness', 'hip', source_id, NULL, NULL, NULL, round(r, 4) FROM ({_ISSUES})",
}
