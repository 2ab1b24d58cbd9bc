"""The queries of the general training-data problems: packed fields, orphans, near points."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.functions.numeric import parse_id, plain_word
from starweave.operators.orphan_references import orphan_references, orphan_report, parent_keys
from starweave.operators.packed_fields import explode_packed_fields
from starweave.operators.sky_quadtree import near_points, sky_points
from starweave.sources.tables import table

NEAR_ARCSEC = 8.0


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    evidence = explode_packed_fields(table(spark, sf, "match_evidence"), "evidence_id", ["reasons"], "match_evidence")
    scores = explode_packed_fields(table(spark, sf, "review_scores"), "review_id", ["quality_flags", "cohort_ranks", "counterpart_ids"], "review_scores")
    return evidence.unionByName(scores)


def p1_value_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How often each value stands in each of the four fields, and its first place."""
    return p1_found(spark, sf).groupBy("table_name", "field_name", "item_value").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"))


def _orphans(spark: SparkSession, sf: str) -> DataFrame:
    evidence = table(spark, sf, "match_evidence").select(F.lit("match_evidence").alias("from_table"), F.col("evidence_id").alias("record_id"), F.lit("raw_hip").alias("target"), parse_id("gaia_official_hip_source_id").alias("key"), F.col("recorded_at").alias("ref_time"))
    outliers = table(spark, sf, "magnitude_outliers").select(F.lit("magnitude_outliers").alias("from_table"), F.col("outlier_id").alias("record_id"), F.col("hip_source_id").alias("key"), F.col("reported_at").alias("ref_time"), "has_processed_hip_row")
    raw = outliers.withColumn("target", F.lit("raw_hip"))
    done = outliers.where(F.col("has_processed_hip_row")).withColumn("target", F.lit("processed_hip"))
    cols = ["from_table", "record_id", "target", "key", "ref_time"]
    refs = evidence.select(cols).unionByName(raw.select(cols)).unionByName(done.select(cols))
    targets = {
        "raw_hip": table(spark, sf, "raw_hip").select(F.col("hip").alias("key"), "loaded_at"),
        "processed_hip": table(spark, sf, "processed_hip").where(plain_word("source") == "hip").select(F.col("source_id").alias("key"), "loaded_at"),
    }
    decisions = table(spark, sf, "overrides").where(plain_word("source") == "hip").select(parse_id("source_id").alias("key"), F.col("override_action").alias("action"), "decided_at")
    return orphan_references(refs, parent_keys(targets, decisions))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return _orphans(spark, sf).select("from_table", "record_id", "target_table", F.col("key").alias("hip_source_id"), "status", F.date_format("ref_time", "yyyy-MM").alias("ref_month"))


def p3_report(spark: SparkSession, sf: str) -> DataFrame:
    return orphan_report(_orphans(spark, sf))


def _near(spark: SparkSession, sf: str) -> DataFrame:
    evidence = table(spark, sf, "match_evidence")
    hip = sky_points(evidence, parse_id("hip_source_id"), F.col("hip_ra_deg"), F.col("hip_dec_deg"))
    gaia = sky_points(evidence, parse_id("gaia_source_id"), F.col("gaia_ra_deg"), F.col("gaia_dec_deg"))
    return near_points(hip, gaia, NEAR_ARCSEC).select(F.col("probe_id").alias("hip_source_id"), F.col("base_id").alias("gaia_source_id"), "sep_arcsec")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _near(spark, sf).select("hip_source_id", "gaia_source_id")


def p4_near_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _near(spark, sf).groupBy("hip_source_id").agg(F.count(F.lit(1)).alias("n_gaia"), F.round(F.min("sep_arcsec"), 4).alias("nearest_arcsec"))


QUERIES = {f.__name__: f for f in (p1_found, p1_value_counts, p3_found, p3_report, p4_found, p4_near_counts)}

_SPLIT = r"""
SELECT table_name, record_id, field_name, CAST(pos AS INTEGER) AS pos,
       CASE WHEN v LIKE '"%' AND raw LIKE '[%' THEN replace(v[2:-2], '\"', '"')
            WHEN v LIKE '"%' THEN replace(v[2:-2], '""', '"')
            WHEN v LIKE '''%' THEN v[2:-2] ELSE v END AS item_value
FROM (SELECT table_name, record_id, field_name, raw, unnest(l) AS v, generate_subscripts(l, 1) AS pos FROM (
  SELECT *, regexp_extract_all(raw, '"(?:[^"\\]|""|\\.)*"|''[^'']*''|[^\s;,|/；\[\]{}"'']+') AS l FROM (
    SELECT DISTINCT 'match_evidence' AS table_name, evidence_id AS record_id, 'reasons' AS field_name, trim(reasons) AS raw FROM match_evidence
    UNION ALL SELECT DISTINCT 'review_scores', review_id, 'quality_flags', trim(quality_flags) FROM review_scores
    UNION ALL SELECT DISTINCT 'review_scores', review_id, 'cohort_ranks', trim(cohort_ranks) FROM review_scores
    UNION ALL SELECT DISTINCT 'review_scores', review_id, 'counterpart_ids', trim(counterpart_ids) FROM review_scores)
  WHERE raw IS NOT NULL AND lower(raw) NOT IN ('', 'nan', 'none', '<na>')))
"""

_ID = "TRY_CAST(regexp_extract(regexp_replace({0}, '(?i)^\\s*gaia\\s*e?dr\\s*[0-9]+($|[^0-9])', '\\1'), '([0-9]+)[^0-9]*$', 1) AS BIGINT)"

_ORPHANS = f"""
WITH refs AS (
  SELECT DISTINCT 'match_evidence' AS from_table, evidence_id AS record_id, 'raw_hip' AS target, {_ID.format("gaia_official_hip_source_id")} AS k, recorded_at AS t FROM match_evidence
  UNION SELECT 'magnitude_outliers', outlier_id, 'raw_hip', hip_source_id, reported_at FROM magnitude_outliers
  UNION SELECT 'magnitude_outliers', outlier_id, 'processed_hip', hip_source_id, reported_at FROM magnitude_outliers WHERE has_processed_hip_row),
parents AS (
  SELECT 'raw_hip' AS target, hip AS k, min(loaded_at) AS l FROM raw_hip GROUP BY 2
  UNION ALL SELECT 'processed_hip', source_id, min(loaded_at) FROM processed_hip WHERE lower(trim(source)) = 'hip' GROUP BY 2),
last AS (
  SELECT {_ID.format("source_id")} AS k, lower(trim(override_action)) AS a,
         row_number() OVER (PARTITION BY {_ID.format("source_id")} ORDER BY decided_at DESC, lower(trim(override_action)) DESC) AS n
  FROM overrides WHERE lower(trim(source)) = 'hip' AND decided_at IS NOT NULL),
found AS (
  SELECT r.*, CASE WHEN p.k IS NULL THEN 'missing' WHEN d.a = 'drop' THEN 'deleted' WHEN p.l > r.t THEN 'late' END AS status
  FROM refs r LEFT JOIN parents p ON p.target = r.target AND p.k = r.k LEFT JOIN last d ON d.k = r.k AND d.n = 1 WHERE r.k IS NOT NULL)
"""

_NEAR = f"""
WITH h AS (SELECT {_ID.format("hip_source_id")} AS id, min(radians(hip_ra_deg)) AS a, min(radians(hip_dec_deg)) AS d FROM match_evidence
           WHERE isfinite(hip_ra_deg) AND isfinite(hip_dec_deg) AND abs(hip_dec_deg) <= 90 GROUP BY 1),
g AS (SELECT {_ID.format("gaia_source_id")} AS id, min(radians(gaia_ra_deg)) AS a, min(radians(gaia_dec_deg)) AS d FROM match_evidence
      WHERE isfinite(gaia_ra_deg) AND isfinite(gaia_dec_deg) AND abs(gaia_dec_deg) <= 90 GROUP BY 1),
near AS (SELECT h.id AS hip_source_id, g.id AS gaia_source_id,
         3600 * degrees(2 * asin(least(1, sqrt(pow(sin((h.d - g.d) / 2), 2) + cos(h.d) * cos(g.d) * pow(sin((h.a - g.a) / 2), 2))))) AS sep
         FROM h JOIN g ON g.d BETWEEN h.d - radians(0.0023) AND h.d + radians(0.0023) WHERE h.id IS NOT NULL AND g.id IS NOT NULL)
"""

ORACLES = {
    "p1_found": _SPLIT,
    "p3_found": _ORPHANS + "SELECT from_table, record_id, target AS target_table, k AS hip_source_id, status, strftime(t, '%Y-%m') AS ref_month FROM found WHERE status IS NOT NULL",
    "p3_report": _ORPHANS + "SELECT from_table, target AS target_table, strftime(t, '%Y-%m') AS ref_month, status, count(*) AS n_references, count(DISTINCT k) AS n_keys FROM found WHERE status IS NOT NULL GROUP BY ALL",
    "p4_found": _NEAR + "SELECT hip_source_id, gaia_source_id FROM near WHERE sep <= 8",
    "p4_near_counts": _NEAR + "SELECT hip_source_id, count(*) AS n_gaia, round(min(sep), 4) AS nearest_arcsec FROM near WHERE sep <= 8 GROUP BY 1",
}
ORACLES["p1_value_counts"] = f"SELECT table_name, field_name, item_value, count(*) AS n, min(pos) AS first_pos FROM ({_SPLIT}) GROUP BY ALL"
