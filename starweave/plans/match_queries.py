"""Queries over the raw match: sources, evidence, maps and reports, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.functions.geometry import distance_pc, separation_arcsec
from starweave.functions.healpix import nested_cell
from starweave.functions.numeric import finite, finite_or_null
from starweave.operators import match_evidence as me
from starweave.operators.colour_fit import fit_polynomial, with_colour_residual
from starweave.operators.latest import latest_values
from starweave.operators.maps import combine_maps, normalise_map, repeated_ids, supplemental_map
from starweave.operators.match_audit import with_external_distance
from starweave.operators.quantiles import quantiles_by
from starweave.sources.tables import table

NEIGHBOURHOOD = "neighbourhood_import"


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Doubles and floats rounded for display; ids, flags and text as they are."""
    return df.select(*[F.round(F.col(c).cast("double"), special.get(c, digits)).alias(c) if kind in ("double", "float") else F.col(c) for c, kind in df.dtypes])


def gaia(spark: SparkSession, sf: str) -> DataFrame:
    return me.primary_sources(table(spark, sf, "raw_gaia"))


def hip(spark: SparkSession, sf: str) -> DataFrame:
    return me.secondary_sources(table(spark, sf, "raw_hip"))


def official(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "official_map")
    return normalise_map(rows.where(F.coalesce("mapping_source", F.lit("")) != NEIGHBOURHOOD), "unknown")


def neighbourhood(spark: SparkSession, sf: str) -> DataFrame:
    return normalise_map(table(spark, sf, "official_map").where(F.col("mapping_source") == NEIGHBOURHOOD))


def evidence(spark: SparkSession, sf: str, max_mag_delta: float | None = None) -> DataFrame:
    return me.raw_match_evidence(gaia(spark, sf), hip(spark, sf), official(spark, sf), neighbourhood(spark, sf), max_mag_delta=max_mag_delta)


def prepared_secondary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(hip(spark, sf).select(F.col("id").alias("source_id"), F.col("ra").alias("ra_deg"), F.col("dec").alias("dec_deg"), F.col("ra0").alias("ra_deg_epoch1991"), F.col("mag").alias("apparent_mag"), "pmra", "pmdec", F.col("plx").alias("plx_mas"), F.col("sn").cast("int").alias("solution_type")))


def raw_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """All 47 evidence columns."""
    return rounded(evidence(spark, sf), separation_arcsec=4, rendered_3d_separation_pc=3, gaia_r_pc=5, hip_r_pc=5)


def gated_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """With a magnitude gate of 0.5: sky counts stay those before the gate."""
    cols = ["gaia_source_id", "hip_source_id", "decision", "reasons", "gaia_sky_neighbour_count", "hip_sky_neighbour_count", "gaia_candidate_count", "hip_candidate_count", "isolated_sky_pair", "one_to_one_candidate"]
    return evidence(spark, sf, max_mag_delta=0.5).select(cols)


def evidence_report(spark: SparkSession, sf: str) -> DataFrame:
    return me.match_report(evidence(spark, sf))


def scan_report(spark: SparkSession, sf: str) -> DataFrame:
    """What a raw match read, left out and found, in one row."""
    n = F.count(F.lit(1))
    e = evidence(spark, sf)
    parts = [
        (table(spark, sf, "raw_gaia"), {"gaia_rows_scanned": n, "gaia_ids": F.countDistinct("source_id")}), (gaia(spark, sf), {"gaia_sources": n}), (table(spark, sf, "raw_hip"), {"hip_rows_raw": n}), (hip(spark, sf), {"hip_rows_prepared": n}),
        (official(spark, sf), {"official_rows": n}), (neighbourhood(spark, sf), {"official_neighbourhood_rows": n}),
        (e, {"evidence_rows": n, "official_pairs_in_evidence": F.count_if("official_pair"), "official_pairs_confirmed": F.count_if(F.col("decision") == "official_confirmed"), "supplemental_rows": F.count_if(F.col("decision") == "supplemental_match")}),
    ]
    rows = None
    for df, counts in parts:
        one = df.agg(*[c.alias(k) for k, c in counts.items()])
        rows = one if rows is None else rows.unionByName(one, allowMissingColumns=True)
    out = rows.agg(*[F.max(c).alias(c) for c in rows.columns])
    return out.withColumn("gaia_ids_skipped", F.col("gaia_ids") - F.col("gaia_sources"))


def official_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Official pairs with the survey's measures of their source."""
    g = gaia(spark, sf).select(F.col("id").alias("gaia_source_id"), F.col("g").alias("gaia_apparent_mag"), (F.col("bp") - F.col("rp")).alias("gaia_bp_rp"), F.col("plx").alias("gaia_plx_mas"))
    return rounded(official(spark, sf).select("gaia_source_id", "hip_source_id").join(g, "gaia_source_id"))


def external_distances(spark: SparkSession, sf: str) -> DataFrame:
    """Prepared catalogue entries that the processed catalogue has an eligible distance for, beside their own."""
    other = table(spark, sf, "processed_hip").where(F.col("source") == "hip").select("source_id", F.col("r_pc").alias("external_r_pc"))
    own = hip(spark, sf).select(F.col("id").alias("source_id"), distance_pc(F.col("plx")).alias("own_r_pc"))
    return rounded(with_external_distance(own, other), 4)


def magnitude_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles of the difference of both magnitudes over all official pairs, as it is and without sign."""
    at = (0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0)
    return rounded(quantiles_by(_official_magnitudes(spark, sf), [], {"delta": F.col("delta"), "abs_delta": F.abs("delta")}, at), 6)


def outlier_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Outliers with the columns that the raw and the processed catalogue have of them, and presence flags."""
    f = finite_or_null
    rows = table(spark, sf, "magnitude_outliers").select("outlier_id", "hip_source_id", "gaia_source_id").distinct()
    h = latest_values(table(spark, sf, "raw_hip"), "hip", {"raw_hpmag": F.when(f("hpmag") < 50, F.col("hpmag")), "raw_bv": f("b_v"), "raw_plx_mas": f("plx")}, "loaded_at").withColumn("in_raw", F.lit(True))
    p = latest_values(table(spark, sf, "processed_hip").where(F.col("source") == "hip"), "source_id", {"r_pc": f("r_pc"), "mag_abs": f("mag_abs"), "astrometry_quality": f("astrometry_quality"), "photometry_quality": f("photometry_quality")}, "loaded_at").withColumn("in_processed", F.lit(True))
    both = rows.join(h.withColumnRenamed("id", "hip_source_id"), "hip_source_id", "left").join(p.withColumnRenamed("id", "hip_source_id"), "hip_source_id", "left")
    return rounded(both.withColumns({n: F.coalesce(n, F.lit(False)) for n in ("in_raw", "in_processed")}), 6)


def decision_counts(spark: SparkSession, sf: str) -> DataFrame:
    return evidence(spark, sf).groupBy("decision", "recommended_action", "severity").agg(F.count(F.lit(1)).alias("n"))


def official_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(official(spark, sf))


def supplemental_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(supplemental_map(evidence(spark, sf)), angular_distance=3)


def combined_pairs(spark: SparkSession, sf: str) -> DataFrame:
    both = combine_maps(official(spark, sf), supplemental_map(evidence(spark, sf)))
    return both.select("gaia_source_id", "hip_source_id", "mapping_source", "number_of_neighbours")


def repeated_map_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids that break the one-to-one rule of the combined map."""
    return repeated_ids(combined_pairs(spark, sf))


def repeated_official_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids that stand in several pairs of the official map and the neighbourhood together."""
    return repeated_ids(normalise_map(table(spark, sf, "official_map")))


def colour_fit(spark: SparkSession, sf: str) -> DataFrame:
    """The difference of both magnitudes of official pairs as a line in the survey's colour, with one gate on the residuals."""
    pairs = _official_magnitudes(spark, sf)
    fit = fit_polynomial(pairs, "gaia_bp_rp", "delta", 1, 2.5, 2)
    rated = with_colour_residual(pairs, "gaia_bp_rp", "delta", fit, 3.0)
    values = [F.lit(v).alias(n) for n, v in zip(("constant", "slope", "spread"), (*fit.coefficients, fit.spread), strict=True)]
    return rounded(rated.agg(F.count("colour_residual").alias("n_pairs"), F.count_if("within_colour_gate").alias("n_within_gate")).select("*", F.lit(fit.n).cast("bigint").alias("n_fitted"), *values), 4)


def _official_magnitudes(spark: SparkSession, sf: str) -> DataFrame:
    """Official pairs with the magnitudes and colours of both sides."""
    g = gaia(spark, sf).select(F.col("id").alias("gaia_source_id"), F.col("g").alias("gaia_mag"), (F.col("bp") - F.col("rp")).alias("gaia_bp_rp"))
    h = hip(spark, sf).select(F.col("id").alias("hip_source_id"), F.col("mag").alias("hip_mag"), F.floor(F.col("bv") / 0.25).cast("int").alias("colour_bin"))
    return official(spark, sf).join(g, "gaia_source_id").join(h, "hip_source_id").withColumn("delta", F.col("gaia_mag") - F.col("hip_mag"))


def official_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Official pairs without evidence, by why: a side has no source row, or the pair is too far apart."""
    keys = ["gaia_source_id", "hip_source_id"]
    found = evidence(spark, sf).select(*[F.col(k).cast("bigint").alias(k) for k in keys])
    lost = official(spark, sf).join(found, keys, "left_anti")
    g = gaia(spark, sf).select(F.col("id").alias("gaia_source_id"), F.col("g").alias("gaia_mag"))
    h = hip(spark, sf).select(F.col("id").alias("hip_source_id"), F.col("mag").alias("hip_mag"))
    both = lost.join(g, "gaia_source_id", "left").join(h, "hip_source_id", "left")
    delta = F.abs(F.col("gaia_mag") - F.col("hip_mag"))
    bucket = F.when(F.col("gaia_mag").isNull(), "no primary").when(F.col("hip_mag").isNull(), "no secondary").when(delta <= 0.5, "far, alike").otherwise("far, unlike")
    return both.groupBy(bucket.alias("why")).agg(F.count(F.lit(1)).alias("n"))


def neighbourhood_overlap(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["decision", "recommended_action", "in_official_neighbourhood", "official_neighbourhood_conflict"]
    return evidence(spark, sf).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def separation_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    """How many pairs stay at each gate and separation."""
    steps = [0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0]
    e = evidence(spark, sf)
    sep, delta = F.col("separation_arcsec"), F.col("apparent_mag_delta")
    gates = F.explode(F.array(*[F.struct(F.lit(n).alias("gate"), F.lit(g).alias("limit")) for n, g in (("none", 99.0), ("1.0", 1.0), ("0.5", 0.5), ("0.25", 0.25))])).alias("g")
    rows = e.select("separation_arcsec", "apparent_mag_delta", gates).where(delta <= F.col("g.limit"))
    return rows.groupBy(F.col("g.gate").alias("gate")).agg(*[F.count_if(sep <= s).alias(f"within_{str(s).replace('.', 'p')}") for s in steps])


def outlier_presence(spark: SparkSession, sf: str) -> DataFrame:
    """Outlier rows enriched with what the raw and processed catalogues hold of them."""
    rows = table(spark, sf, "magnitude_outliers").select("outlier_id", "hip_source_id", "gaia_source_id").distinct()
    h = table(spark, sf, "raw_hip").select(F.col("hip").alias("hip_source_id")).distinct().withColumn("in_raw", F.lit(True))
    p = table(spark, sf, "processed_hip").select(F.col("source_id").alias("hip_source_id")).distinct().withColumn("in_processed", F.lit(True))
    m = official(spark, sf).groupBy("hip_source_id").agg(F.count(F.lit(1)).alias("n_official"), F.max("gaia_source_id").alias("official_gaia"))
    both = rows.join(h, "hip_source_id", "left").join(p, "hip_source_id", "left").join(m, "hip_source_id", "left")
    no = F.lit(False)
    return both.select("outlier_id", "hip_source_id", F.coalesce("in_raw", no).alias("in_raw"), F.coalesce("in_processed", no).alias("in_processed"), F.coalesce("n_official", F.lit(0)).cast("bigint").alias("n_official"), F.coalesce(F.col("official_gaia") == F.col("gaia_source_id"), no).alias("agrees"))


def sky_density(spark: SparkSession, sf: str) -> DataFrame:
    """Sources per level-3 cell, from the id."""
    cell = F.shiftright("source_id", 53).cast("int").alias("healpix_l3")
    return table(spark, sf, "raw_gaia").select("source_id").distinct().groupBy(cell).agg(F.count(F.lit(1)).alias("n_sources"))


def sky_cells(spark: SparkSession, sf: str) -> DataFrame:
    """The level-3 cell of each position, computed; the given column is its check."""
    rows = table(spark, sf, "raw_gaia").where(F.abs("dec_deg") < 90)
    return rows.select("source_id", nested_cell(F.col("ra_deg"), F.col("dec_deg"), 3).cast("int").alias("healpix_l3")).distinct()


def footprint(spark: SparkSession, sf: str) -> DataFrame:
    """Cells that the catalogue's brighter and fainter halves cover, with their area."""
    h = hip(spark, sf).select(F.when(F.col("mag") <= 9, "bright").otherwise("faint").alias("selection"), nested_cell(F.col("ra"), F.col("dec"), 3).alias("cell"))
    area = F.round(F.countDistinct("cell") * F.lit(4 * 180.0 * 180.0 / 3.141592653589793 / (12 * 64)), 4)
    return h.groupBy("selection").agg(F.countDistinct("cell").alias("n_cells"), area.alias("area_deg2"))


def magnitude_recovery(spark: SparkSession, sf: str) -> DataFrame:
    """How well the official partner's magnitude agrees, by colour: counts, medians and spread."""
    both = _official_magnitudes(spark, sf)
    near = lambda limit: F.count_if(F.abs("delta") <= limit)
    counts = both.groupBy("colour_bin").agg(F.count(F.lit(1)).alias("n"), near(0.25).alias("within_0p25"), near(0.5).alias("within_0p5"), near(1.0).alias("within_1p0"))
    found = quantiles_by(both, ["colour_bin"], {"delta": F.col("delta")}, (0.1, 0.5, 0.9))
    at = lambda q: F.max(F.when(F.col("quantile") == q, F.col("value")))
    spread = found.groupBy(F.col("colour_bin").alias("of_bin")).agg(at(0.5).alias("median_delta"), (at(0.9) - at(0.1)).alias("spread_10_90"))
    return rounded(counts.join(spread, F.col("colour_bin").eqNullSafe(F.col("of_bin")), "left").drop("of_bin"), 7)


def recorded_separations(spark: SparkSession, sf: str) -> DataFrame:
    """Recorded separations against those of the recorded places."""
    e = table(spark, sf, "match_evidence").where(F.abs("gaia_dec_deg") <= 90).where(F.abs("hip_dec_deg") <= 90)
    for c in ("gaia_ra_deg", "hip_ra_deg", "separation_arcsec"):
        e = e.where(finite(c))
    sep = separation_arcsec(F.col("gaia_ra_deg"), F.col("gaia_dec_deg"), F.col("hip_ra_deg"), F.col("hip_dec_deg"))
    off = F.abs(sep - F.col("separation_arcsec"))
    near = F.when(off < 0.001, "same").when(off < 1, "near").when(off >= 1, "other")
    return e.select("evidence_id", near.alias("agreement")).distinct().groupBy("agreement").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (prepared_secondary, raw_evidence, gated_evidence, evidence_report, scan_report, official_sources, external_distances, magnitude_quantiles, outlier_rows, decision_counts, official_pairs, supplemental_pairs, combined_pairs, repeated_map_ids, repeated_official_ids, colour_fit, official_recall, neighbourhood_overlap, separation_thresholds, outlier_presence, sky_density, sky_cells, footprint, magnitude_recovery, recorded_separations)}


def _mod360(x: str) -> str:
    return f"(CASE WHEN ({x}) % 360.0 < 0 THEN (({x}) % 360.0 + 360.0) % 360.0 ELSE ({x}) % 360.0 END)"


def _last(c: str, ok: str = "") -> str:
    return f"arg_max({c}, loaded_at) FILTER (WHERE isfinite({c}){ok})"


_K = "(24.75 * pi() / 648000000.0)"
SOURCES = f"""
g0 AS (SELECT source_id AS id, {_last("ra_deg")} AS ra, {_last("dec_deg")} AS dec, {_last("phot_g_mean_mag")} AS g, {_last("phot_bp_mean_mag")} AS bp, {_last("phot_rp_mean_mag")} AS rp,
       {_last("parallax")} AS plx, {_last("parallax_error")} AS e_plx FROM raw_gaia GROUP BY 1),
g AS (SELECT * REPLACE ({_mod360("ra")} AS ra), cos(radians(dec)) * cos(radians({_mod360("ra")})) AS x, cos(radians(dec)) * sin(radians({_mod360("ra")})) AS y, sin(radians(dec)) AS z
      FROM g0 WHERE ra IS NOT NULL AND dec IS NOT NULL AND g IS NOT NULL),
h0 AS (SELECT hip AS id, {_last("rarad")} AS ra0, {_last("derad")} AS dec0, {_last("pmra")} AS pmra, {_last("pmde")} AS pmdec, {_last("hpmag", " AND hpmag < 50")} AS mag,
       {_last("plx")} AS plx, {_last("e_plx")} AS e_plx, CAST(arg_max(sn, loaded_at) AS DOUBLE) AS sn, {_last("b_v")} AS bv FROM raw_hip GROUP BY 1),
h1 AS (SELECT *, radians(ra0) AS a, radians(dec0) AS d, pmra * {_K} AS me, pmdec * {_K} AS mn FROM h0
       WHERE ra0 IS NOT NULL AND dec0 IS NOT NULL AND pmra IS NOT NULL AND pmdec IS NOT NULL AND mag IS NOT NULL),
h2 AS (SELECT *, cos(d) * cos(a) - me * sin(a) - mn * cos(a) * sin(d) AS vx, cos(d) * sin(a) + me * cos(a) - mn * sin(a) * sin(d) AS vy, sin(d) + mn * cos(d) AS vz FROM h1),
h3 AS (SELECT *, {_mod360("degrees(atan2(vy, vx))")} AS ra, degrees(atan2(vz, sqrt(vx * vx + vy * vy))) AS dec FROM h2),
h AS (SELECT id, ra, dec, {_mod360("ra0")} AS ra0, dec0, pmra, pmdec, mag, plx, e_plx, sn, bv, cos(radians(dec)) * cos(radians(ra)) AS x, cos(radians(dec)) * sin(radians(ra)) AS y, sin(radians(dec)) AS z FROM h3)
"""

MAPS = f"""
om AS (SELECT gaia_source_id, hip_source_id, coalesce(mapping_source, 'unknown') AS mapping_source, coalesce(number_of_neighbours, 0) AS number_of_neighbours, angular_distance,
       row_number() OVER (PARTITION BY gaia_source_id, hip_source_id ORDER BY mapping_source IS NULL, coalesce(angular_distance, CAST('inf' AS FLOAT)), mapping_source, coalesce(number_of_neighbours, 0)) AS n
       FROM official_map WHERE gaia_source_id > 0 AND hip_source_id > 0 AND coalesce(mapping_source, '') <> '{NEIGHBOURHOOD}'),
o AS (SELECT * EXCLUDE (n) FROM om WHERE n = 1),
nb AS (SELECT DISTINCT gaia_source_id, hip_source_id FROM official_map WHERE gaia_source_id > 0 AND hip_source_id > 0 AND mapping_source = '{NEIGHBOURHOOD}')
"""


def _evidence(gate: str = "true") -> str:
    return f"""WITH {SOURCES}, {MAPS},
near0 AS (SELECT g.id AS gid, h.id AS hid, pow(g.x - h.x, 2) + pow(g.y - h.y, 2) + pow(g.z - h.z, 2) AS d2, g.ra AS gra, g.dec AS gdec, g.g, g.bp, g.rp, g.plx AS gplx, g.e_plx AS geplx,
          h.ra AS hra, h.dec AS hdec, h.ra0, h.dec0, h.mag, h.plx AS hplx, h.e_plx AS heplx, h.pmra, h.pmdec, h.sn
          FROM g JOIN h ON g.dec BETWEEN h.dec - 0.0015 AND h.dec + 0.0015),
near AS (SELECT *, degrees(2 * asin(least(sqrt(d2) / 2, 1))) * 3600 AS sep, count(*) OVER (PARTITION BY gid) AS gsky, count(*) OVER (PARTITION BY hid) AS hsky FROM near0 WHERE d2 <= pow(2 * sin(radians(5.0 / 3600.0) / 2), 2)),
m AS (SELECT *, abs(mag - g) AS dm, CASE WHEN gplx > 0 THEN 1000.0 / gplx END AS gr, CASE WHEN hplx > 0 THEN 1000.0 / hplx END AS hr, count(*) OVER (PARTITION BY gid) AS gcand, count(*) OVER (PARTITION BY hid) AS hcand FROM near WHERE {gate}),
e AS (SELECT m.*, CASE WHEN gr IS NOT NULL AND hr IS NOT NULL THEN sqrt(greatest(0.0, gr * gr + hr * hr - 2.0 * gr * hr * cos(radians(sep / 3600.0)))) END AS r3, gcand = 1 AND hcand = 1 AS one, gsky = 1 AND hsky = 1 AS iso, a.p AS goff, b.p AS hoff,
      coalesce(a.p = hid AND b.p = gid, false) AS opair, coalesce(a.p <> hid, false) OR coalesce(b.p <> gid, false) AS oconf,
      EXISTS (FROM nb WHERE gaia_source_id = gid AND hip_source_id = hid) AS innb, EXISTS (FROM nb WHERE gaia_source_id = gid) OR EXISTS (FROM nb WHERE hip_source_id = hid) AS anynb
      FROM m LEFT JOIN (SELECT gaia_source_id AS k, max(hip_source_id) AS p FROM o GROUP BY 1) a ON a.k = gid LEFT JOIN (SELECT hip_source_id AS k, max(gaia_source_id) AS p FROM o GROUP BY 1) b ON b.k = hid),
c AS (SELECT *, CASE WHEN opair AND one THEN 1 WHEN opair THEN 2 WHEN oconf THEN 3 WHEN NOT innb AND anynb THEN 4 WHEN NOT one THEN 5 WHEN sep <= 0.25 THEN 6 WHEN r3 <= 1.0 THEN 7 WHEN r3 IS NOT NULL THEN 8 ELSE 9 END AS rule FROM e),
ev AS (SELECT *, ['official_confirmed', 'manual_review', 'manual_review', 'manual_review', 'manual_review', 'supplemental_match', 'supplemental_match', 'display_separate', 'display_separate'][rule] AS decision,
       ['already_in_official_crossmatch', 'inspect_ambiguous_official_pair', 'inspect_official_best_conflict', 'inspect_official_neighbourhood_conflict', 'inspect_ambiguous_raw_match', 'add_supplemental_crossmatch', 'add_supplemental_crossmatch', 'keep_both_visible', 'keep_both_visible'][rule] AS recommended_action,
       ['info', 'medium', 'high', 'medium', 'medium', 'medium', 'medium', 'info', 'info'][rule] AS severity,
       concat_ws(';', 'close_sky_position', CASE WHEN dm IS NOT NULL THEN 'apparent_magnitude_recorded' END, CASE WHEN iso THEN 'isolated_within_scan_radius' WHEN one THEN 'one_to_one_candidate_but_not_sky_isolated' END,
         ['official_crossmatch_pair', 'official_crossmatch_pair;official_pair_has_local_ambiguity', 'official_best_conflict', 'official_neighbourhood_conflict', 'ambiguous_candidate_field', 'clean_one_to_one_tight_sky_candidate', 'clean_one_to_one_rendered_distance_candidate', 'rendered_3d_separation_gt_threshold', 'missing_rendered_distance'][rule]) AS reasons FROM c)
"""


_SUPPLEMENT = "SELECT gid AS gaia_source_id, hid AS hip_source_id, 'local_close_pair_v1' AS mapping_source, 1 AS number_of_neighbours, CAST(sep AS FLOAT) AS angular_distance FROM ev WHERE decision = 'supplemental_match'"
_COMBINED = f"SELECT gaia_source_id, hip_source_id, mapping_source, number_of_neighbours FROM o UNION ALL SELECT gaia_source_id, hip_source_id, mapping_source, number_of_neighbours FROM ({_SUPPLEMENT}) s WHERE NOT EXISTS (FROM o WHERE o.gaia_source_id = s.gaia_source_id AND o.hip_source_id = s.hip_source_id)"

ORACLES = {
    "prepared_secondary": f"WITH {SOURCES} SELECT id AS source_id, round(ra, 6) AS ra_deg, round(dec, 6) AS dec_deg, round(ra0, 6) AS ra_deg_epoch1991, round(mag, 6) AS apparent_mag, round(pmra, 6) AS pmra, round(pmdec, 6) AS pmdec, round(plx, 6) AS plx_mas, CAST(sn AS INTEGER) AS solution_type FROM h",
    "raw_evidence": _evidence() + """SELECT CAST(gid AS VARCHAR) AS gaia_source_id, CAST(hid AS VARCHAR) AS hip_source_id, decision, recommended_action, severity, reasons, round(sep, 4) AS separation_arcsec, round(dm, 6) AS apparent_mag_delta,
      round(gra, 6) AS gaia_ra_deg, round(gdec, 6) AS gaia_dec_deg, round(hra, 6) AS hip_ra_deg, round(hdec, 6) AS hip_dec_deg, round(ra0, 6) AS hip_ra_deg_epoch1991, round(dec0, 6) AS hip_dec_deg_epoch1991,
      round(g, 6) AS gaia_apparent_mag, round(mag, 6) AS hip_apparent_mag, round(bp, 6) AS gaia_phot_bp_mean_mag, round(rp, 6) AS gaia_phot_rp_mean_mag, round(bp - rp, 6) AS gaia_bp_rp, round(gplx, 6) AS gaia_plx_mas, round(geplx, 6) AS gaia_e_plx_mas,
      round(gr, 5) AS gaia_r_pc, round(hplx, 6) AS hip_plx_mas, round(heplx, 6) AS hip_e_plx_mas, round(hr, 5) AS hip_r_pc, round(CASE WHEN gplx > 0 THEN abs(geplx / gplx) END, 6) AS gaia_parallax_frac_error,
      round(CASE WHEN hplx > 0 THEN abs(heplx / hplx) END, 6) AS hip_parallax_frac_error, round(r3, 3) AS rendered_3d_separation_pc, round(pmra, 6) AS hip_pmra_masyr, round(pmdec, 6) AS hip_pmdec_masyr, round(sn, 6) AS hip_solution_type,
      CAST(gsky AS INTEGER) AS gaia_sky_neighbour_count, CAST(hsky AS INTEGER) AS hip_sky_neighbour_count, CAST(gcand AS INTEGER) AS gaia_candidate_count, CAST(hcand AS INTEGER) AS hip_candidate_count, one AS one_to_one_candidate, iso AS isolated_sky_pair,
      opair AS official_pair, goff IS NOT NULL AS gaia_has_official_map, hoff IS NOT NULL AS hip_has_official_map, oconf AS official_conflict, innb AS in_official_neighbourhood, NOT innb AND anynb AS official_neighbourhood_conflict,
      sep <= 0.25 AS within_tight_sky_threshold, coalesce(r3 <= 1.0, false) AS within_rendered_distance_threshold, CAST(goff AS VARCHAR) AS gaia_official_hip_source_id, CAST(hoff AS VARCHAR) AS hip_official_gaia_source_id FROM ev""",
    "gated_evidence": _evidence("abs(mag - g) <= 0.5") + "SELECT CAST(gid AS VARCHAR) AS gaia_source_id, CAST(hid AS VARCHAR) AS hip_source_id, decision, reasons, CAST(gsky AS INTEGER) AS gaia_sky_neighbour_count, CAST(hsky AS INTEGER) AS hip_sky_neighbour_count, CAST(gcand AS INTEGER) AS gaia_candidate_count, CAST(hcand AS INTEGER) AS hip_candidate_count, iso AS isolated_sky_pair, one AS one_to_one_candidate FROM ev",
    "evidence_report": _evidence() + "SELECT count(*) AS evidence_pairs, count(*) FILTER (decision = 'official_confirmed') AS official_confirmed, count(*) FILTER (decision = 'supplemental_match') AS supplemental_match, count(*) FILTER (decision = 'manual_review') AS manual_review, count(*) FILTER (decision = 'display_separate') AS display_separate, count(*) FILTER (opair) AS official_pairs_in_evidence, count(*) FILTER (one) AS one_to_one, count(*) FILTER (iso) AS isolated FROM ev",
    "scan_report": _evidence() + """SELECT (SELECT count(*) FROM raw_gaia) AS gaia_rows_scanned, (SELECT count(DISTINCT source_id) FROM raw_gaia) AS gaia_ids, (SELECT count(*) FROM g) AS gaia_sources, (SELECT count(*) FROM raw_hip) AS hip_rows_raw, (SELECT count(*) FROM h) AS hip_rows_prepared, (SELECT count(*) FROM o) AS official_rows,
      (SELECT count(*) FROM nb) AS official_neighbourhood_rows, count(*) AS evidence_rows, count(*) FILTER (opair) AS official_pairs_in_evidence, count(*) FILTER (decision = 'official_confirmed') AS official_pairs_confirmed, count(*) FILTER (decision = 'supplemental_match') AS supplemental_rows,
      (SELECT count(DISTINCT source_id) FROM raw_gaia) - (SELECT count(*) FROM g) AS gaia_ids_skipped FROM ev""",
    "official_sources": f"WITH {SOURCES}, {MAPS} SELECT gaia_source_id, hip_source_id, round(g.g, 6) AS gaia_apparent_mag, round(bp - rp, 6) AS gaia_bp_rp, round(plx, 6) AS gaia_plx_mas FROM o JOIN g ON g.id = gaia_source_id",
    "external_distances": f"WITH {SOURCES} SELECT h.id AS source_id, round(CASE WHEN plx > 0 THEN 1000.0 / plx END, 4) AS own_r_pc, round(x.r, 4) AS external_r_pc FROM h JOIN (SELECT source_id, min(r_pc) AS r FROM processed_hip WHERE source = 'hip' AND isfinite(r_pc) AND r_pc > 0 GROUP BY 1) x ON x.source_id = h.id",
    "magnitude_quantiles": f"WITH {SOURCES}, {MAPS}, d AS (SELECT g.g - h.mag AS d FROM o JOIN g ON g.id = gaia_source_id JOIN h ON h.id = hip_source_id), m AS (SELECT 'delta' AS measure, d AS v FROM d UNION ALL SELECT 'abs_delta', abs(d) FROM d) SELECT measure, CAST(q.q AS DOUBLE) AS quantile, round(list_extract(quantile_cont(v, [0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]), CAST(any_value(q.k) AS INTEGER)), 6) AS value FROM m, (VALUES (0.0, 1), (0.01, 2), (0.05, 3), (0.25, 4), (0.5, 5), (0.75, 6), (0.95, 7), (0.99, 8), (1.0, 9)) q(q, k) GROUP BY measure, q.q",
    "outlier_rows": f"""SELECT m.*, round(raw_hpmag, 6) AS raw_hpmag, round(raw_bv, 6) AS raw_bv, round(raw_plx_mas, 6) AS raw_plx_mas, round(r_pc, 6) AS r_pc, round(mag_abs, 6) AS mag_abs, round(aq, 6) AS astrometry_quality, round(pq, 6) AS photometry_quality, h.k IS NOT NULL AS in_raw, p.k IS NOT NULL AS in_processed
      FROM (SELECT DISTINCT outlier_id, hip_source_id, gaia_source_id FROM magnitude_outliers) m LEFT JOIN (SELECT hip AS k, {_last("hpmag", " AND hpmag < 50")} AS raw_hpmag, {_last("b_v")} AS raw_bv, {_last("plx")} AS raw_plx_mas FROM raw_hip WHERE hip IS NOT NULL GROUP BY 1) h ON h.k = m.hip_source_id
      LEFT JOIN (SELECT source_id AS k, {_last("r_pc")} AS r_pc, {_last("mag_abs")} AS mag_abs, {_last("astrometry_quality")} AS aq, {_last("photometry_quality")} AS pq FROM processed_hip WHERE source = 'hip' AND source_id IS NOT NULL GROUP BY 1) p ON p.k = m.hip_source_id""",
    "decision_counts": _evidence() + "SELECT decision, recommended_action, severity, count(*) AS n FROM ev GROUP BY ALL",
    "official_pairs": f"WITH {MAPS} SELECT gaia_source_id, hip_source_id, mapping_source, number_of_neighbours, round(CAST(angular_distance AS DOUBLE), 6) AS angular_distance FROM o",
    "supplemental_pairs": _evidence() + f"SELECT gaia_source_id, hip_source_id, mapping_source, CAST(number_of_neighbours AS SMALLINT) AS number_of_neighbours, round(CAST(angular_distance AS DOUBLE), 3) AS angular_distance FROM ({_SUPPLEMENT})",
    "combined_pairs": _evidence() + f"SELECT * REPLACE (CAST(number_of_neighbours AS SMALLINT) AS number_of_neighbours) FROM ({_COMBINED})",
    "repeated_map_ids": _evidence() + f", cm AS ({_COMBINED}) SELECT 'gaia' AS catalog_name, gaia_source_id AS source_id, count(*) AS n FROM cm GROUP BY 2 HAVING count(*) > 1 UNION ALL SELECT 'hip', hip_source_id, count(*) FROM cm GROUP BY 2 HAVING count(*) > 1",
    "repeated_official_ids": "WITH p AS (SELECT DISTINCT gaia_source_id AS g, hip_source_id AS h FROM official_map WHERE gaia_source_id > 0 AND hip_source_id > 0) SELECT 'gaia' AS catalog_name, g AS source_id, count(*) AS n FROM p GROUP BY 2 HAVING count(*) > 1 UNION ALL SELECT 'hip', h, count(*) FROM p GROUP BY 2 HAVING count(*) > 1",
    "colour_fit": f"""WITH {SOURCES}, {MAPS}, p AS (SELECT g.bp - g.rp AS x, g.g - h.mag AS y FROM o JOIN g ON g.id = gaia_source_id JOIN h ON h.id = hip_source_id), q AS (FROM p WHERE x IS NOT NULL AND y IS NOT NULL),
      f1 AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM q), s1 AS (SELECT a, b, sqrt(avg(pow(y - a - b * x, 2))) AS s FROM q, f1 GROUP BY a, b),
      k AS (SELECT x, y FROM q, s1 WHERE abs(y - a - b * x) <= 2.5 * s), f2 AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, count(*) AS n FROM k), s2 AS (SELECT a, b, n, sqrt(avg(pow(y - a - b * x, 2))) AS s FROM k, f2 GROUP BY a, b, n)
      SELECT count(*) AS n_pairs, count(*) FILTER (abs(y - a - b * x) <= 3.0 * s) AS n_within_gate, any_value(n) AS n_fitted, round(any_value(a), 4) AS constant, round(any_value(b), 4) AS slope, round(any_value(s), 4) AS spread FROM q, s2""",
    "official_recall": _evidence() + "SELECT CASE WHEN g.g IS NULL THEN 'no primary' WHEN h.mag IS NULL THEN 'no secondary' WHEN abs(g.g - h.mag) <= 0.5 THEN 'far, alike' ELSE 'far, unlike' END AS why, count(*) AS n FROM o LEFT JOIN g ON g.id = o.gaia_source_id LEFT JOIN h ON h.id = o.hip_source_id WHERE NOT EXISTS (FROM ev WHERE gid = o.gaia_source_id AND hid = o.hip_source_id) GROUP BY 1",
    "neighbourhood_overlap": _evidence() + "SELECT decision, recommended_action, innb AS in_official_neighbourhood, NOT innb AND anynb AS official_neighbourhood_conflict, count(*) AS n FROM ev GROUP BY ALL",
    "separation_thresholds": _evidence() + "SELECT v.gate, " + ", ".join(f"count(*) FILTER (sep <= {s}) AS within_{str(s).replace('.', 'p')}" for s in (0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0)) + " FROM ev JOIN (VALUES ('none', 99.0), ('1.0', 1.0), ('0.5', 0.5), ('0.25', 0.25)) v(gate, lim) ON dm <= lim GROUP BY 1",
    "outlier_presence": f"WITH {MAPS} SELECT DISTINCT m.outlier_id, m.hip_source_id, EXISTS (FROM raw_hip r WHERE r.hip = m.hip_source_id) AS in_raw, EXISTS (FROM processed_hip p WHERE p.source_id = m.hip_source_id) AS in_processed, coalesce(k.n, 0) AS n_official, coalesce(k.p = m.gaia_source_id, false) AS agrees FROM magnitude_outliers m LEFT JOIN (SELECT hip_source_id AS h, count(*) AS n, max(gaia_source_id) AS p FROM o GROUP BY 1) k ON k.h = m.hip_source_id",
    "sky_density": "SELECT CAST(source_id >> 53 AS INTEGER) AS healpix_l3, count(DISTINCT source_id) AS n_sources FROM raw_gaia GROUP BY 1",
    "sky_cells": "SELECT DISTINCT source_id, healpix_l3 FROM raw_gaia WHERE abs(dec_deg) < 90",
    "footprint": f"""WITH {SOURCES}, t AS (SELECT CASE WHEN mag <= 9 THEN 'bright' ELSE 'faint' END AS selection, z, ra / 90.0 AS tt, abs(cos(radians(dec))) / sqrt((1 + abs(z)) / 3) * 8 AS w FROM h),
      f AS (SELECT *, floor(8 * (0.5 + tt) - 6 * z) AS jp, floor(8 * (0.5 + tt) + 6 * z) AS jm, least(floor(tt), 3) AS q FROM t)
      SELECT selection, count(DISTINCT cell) AS n_cells, round(count(DISTINCT cell) * (4 * 180.0 * 180.0 / 3.141592653589793 / 768), 4) AS area_deg2 FROM (
        SELECT selection, CASE WHEN abs(z) <= 2.0 / 3 THEN concat('b ', CASE WHEN floor(jp / 8) = floor(jm / 8) THEN (floor(jp / 8) % 4) + 4 WHEN floor(jp / 8) < floor(jm / 8) THEN floor(jp / 8) % 4 ELSE (floor(jm / 8) % 4) + 8 END, ' ', jm % 8, ' ', 7 - jp % 8)
          WHEN z > 0 THEN concat('b ', q, ' ', 7 - least(floor((1 - tt + q) * w), 7), ' ', 7 - least(floor((tt - q) * w), 7)) ELSE concat('b ', q + 8, ' ', least(floor((tt - q) * w), 7), ' ', least(floor((1 - tt + q) * w), 7)) END AS cell FROM f) GROUP BY 1""",
    "magnitude_recovery": f"WITH {SOURCES}, {MAPS}, b AS (SELECT CAST(floor(h.bv / 0.25) AS INTEGER) AS colour_bin, g.g - h.mag AS d FROM o JOIN g ON g.id = o.gaia_source_id JOIN h ON h.id = o.hip_source_id) SELECT colour_bin, count(*) AS n, count(*) FILTER (abs(d) <= 0.25) AS within_0p25, count(*) FILTER (abs(d) <= 0.5) AS within_0p5, count(*) FILTER (abs(d) <= 1.0) AS within_1p0, round(median(d), 7) AS median_delta, round(quantile_cont(d, 0.9) - quantile_cont(d, 0.1), 7) AS spread_10_90 FROM b GROUP BY 1",
    "recorded_separations": "SELECT agreement, count(*) AS n FROM (SELECT DISTINCT evidence_id, CASE WHEN off < 0.001 THEN 'same' WHEN off < 1 THEN 'near' WHEN off >= 1 THEN 'other' END AS agreement FROM (SELECT evidence_id, abs(degrees(2 * asin(least(sqrt(pow(cos(gd) * cos(ga) - cos(hd) * cos(ha), 2) + pow(cos(gd) * sin(ga) - cos(hd) * sin(ha), 2) + pow(sin(gd) - sin(hd), 2)) / 2, 1))) * 3600 - separation_arcsec) AS off FROM (SELECT evidence_id, separation_arcsec, radians(gaia_ra_deg) AS ga, radians(gaia_dec_deg) AS gd, radians(hip_ra_deg) AS ha, radians(hip_dec_deg) AS hd FROM match_evidence WHERE abs(gaia_dec_deg) <= 90 AND abs(hip_dec_deg) <= 90 AND isfinite(gaia_ra_deg) AND isfinite(hip_ra_deg) AND isfinite(separation_arcsec)))) GROUP BY 1",
}
