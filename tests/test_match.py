import pytest
from pyspark.sql import functions as F

from starweave.operators import match_audit as ma
from starweave.operators import match_evidence as me
from starweave.operators.maps import combine_maps, normalise_map, require_one_to_one, supplemental_map
from starweave.operators.review import manual_queue, review_table, write_sidecar

AS = 1 / 3600
GAIA = "source_id long, ra_deg double, dec_deg double, phot_g_mean_mag double, phot_bp_mean_mag double, phot_rp_mean_mag double, parallax double, parallax_error double, loaded_at timestamp_ntz"
HIP = "hip long, rarad double, derad double, pmra double, pmde double, hpmag double, plx double, e_plx double, sn int, b_v double, loaded_at timestamp_ntz"
MAP = "gaia_source_id long, hip_source_id long, mapping_source string, number_of_neighbours short, angular_distance float"


def gaia(spark, rows):
    """(id, ra, mag, parallax)"""
    return me.primary_sources(spark.createDataFrame([(i, ra, 0.0, m, m, m, p, 0.1, None) for i, ra, m, p in rows], GAIA))


def hip(spark, rows):
    return me.secondary_sources(spark.createDataFrame([(i, ra, 0.0, 0.0, 0.0, m, p, 0.1, 5, 0.5, None) for i, ra, m, p in rows], HIP))


def pairs(spark, rows):
    return normalise_map(spark.createDataFrame([(g, h, "m", 1, 0.1) for g, h in rows], MAP))


def decisions(evidence):
    return {(int(r.gaia_source_id), int(r.hip_source_id)): r for r in evidence.collect()}


def test_raw_mix(spark):
    g = gaia(spark, [(100, 10 + 0.1 * AS, 9.1, 10.0), (101, 20 + 0.1 * AS, 8.1, 20.0), (102, 30 + 0.1 * AS, 10.1, 1.0), (103, 30 + 0.2 * AS, 10.2, 1.0), (104, 40 + 0.1 * AS, 7.1, 5.0)])
    h = hip(spark, [(10, 10.0, 9.0, 10.0), (11, 20.0, 8.0, 20.0), (12, 30.0, 10.0, -1.0), (13, 40.0, 7.0, 5.0)])
    official = pairs(spark, [(101, 11), (999, 13)])
    e = me.raw_match_evidence(g, h, official, pairs(spark, []))
    d = decisions(e)
    assert {k: r.decision for k, r in d.items()} == {(100, 10): "supplemental_match", (101, 11): "official_confirmed", (102, 12): "manual_review", (103, 12): "manual_review", (104, 13): "manual_review"}
    assert d[104, 13].reasons.endswith("official_best_conflict") and d[104, 13].severity == "high"
    assert combine_maps(official, supplemental_map(e)).count() == 3
    assert e.columns == list(me.EVIDENCE_COLUMNS)
    assert [r.decision for r in me.display_order(e).collect()] == sorted(r.decision for r in d.values())


@pytest.mark.parametrize(("plx", "decision"), [(10.05, "supplemental_match"), (5.0, "display_separate"), (None, "display_separate")])
def test_rendered_distance(spark, plx, decision):
    e = me.raw_match_evidence(gaia(spark, [(100, 10 + AS, 11.0, plx)]), hip(spark, [(10, 10.0, 9.0, 10.0)]), pairs(spark, []), pairs(spark, []))
    row = e.first()
    assert row.decision == decision
    assert row.reasons.split(";")[-1] == {10.05: "clean_one_to_one_rendered_distance_candidate", 5.0: "rendered_3d_separation_gt_threshold", None: "missing_rendered_distance"}[plx]


def test_neighbourhood_conflict_and_large_ids(spark):
    a, b = 6068663998977123328, 6068663998977123456
    e = me.raw_match_evidence(gaia(spark, [(a, 10 + AS, 9.0, 1.0), (b, 10.0, 9.0, 1.0)]), hip(spark, [(10, 10.0, 9.0, 1.0)]), pairs(spark, []), pairs(spark, [(999, 10)]))
    d = decisions(e)
    assert set(d) == {(a, 10), (b, 10)}
    assert all(r.decision == "manual_review" and "official_neighbourhood_conflict" in r.reasons for r in d.values())


def test_gate_keeps_sky_counts(spark):
    g = gaia(spark, [(1, 10 + 0.1 * AS, 9.0, 1.0), (2, 10 + 2 * AS, 12.0, 1.0)])
    e = decisions(me.raw_match_evidence(g, hip(spark, [(10, 10.0, 9.0, 1.0)]), pairs(spark, []), pairs(spark, []), max_mag_delta=0.5))
    assert set(e) == {(1, 10)}
    assert e[1, 10].one_to_one_candidate and not e[1, 10].isolated_sky_pair and "one_to_one_candidate_but_not_sky_isolated" in e[1, 10].reasons


def test_empty_and_missing(spark):
    none = hip(spark, [])
    assert me.raw_match_evidence(gaia(spark, [(1, 1.0, 9.0, 1.0)]), none, pairs(spark, []), pairs(spark, [])).count() == 0
    assert gaia(spark, [(1, 1.0, float("nan"), 1.0), (2, None, 3.0, 1.0), (3, 400.0, 3.0, None)]).select("id", F.round("ra", 3).alias("ra")).collect() == [(3, 40.0)]


def processed(spark, rows, role):
    df = spark.createDataFrame([(role, i, ra, 0.0, r, m, 0.1, 0.1) for i, ra, r, m in rows], "source string, source_id long, ra_deg double, dec_deg double, r_pc double, mag_abs double, astrometry_quality double, photometry_quality double")
    return ma.processed_sources(df, role)


def test_audit_cases(spark):
    g = processed(spark, [(i, ra, 100.0, 4.0) for i, ra in ((100, 10.0), (101, 11.0), (102, 12.0), (103, 12 + 0.02 * AS), (104, 13.0), (105, 14.0), (106, 16.0), (300, 15.0))], "gaia")
    h = processed(spark, [(200, 10 + 0.03 * AS, 100.0, 4.0), (201, 11 + 0.03 * AS, 100.0, 4.0), (202, 12 + 0.01 * AS, 100.0, 4.0), (203, 13 + 0.03 * AS, 100.0, 4.0), (204, 14 + 2 * AS, 100.0, 4.3), (205, 16 + 2 * AS, 125.0, 3.6), (400, 15 + 0.03 * AS, 100.0, 4.0)], "hip")
    official = pairs(spark, [(999, 201), (300, 400)])
    keys = spark.createDataFrame([("hip", 203)], "catalog_name string, source_id long")
    e = ma.match_audit(g, h, official, keys)
    d = decisions(e)
    assert {k: r.decision for k, r in d.items()} == {(100, 200): "auto_match", (101, 201): "manual_review", (102, 202): "manual_review", (103, 202): "manual_review", (104, 203): "manual_review", (105, 204): "auto_match", (106, 205): "auto_match"}
    assert combine_maps(official, supplemental_map(e, "auto_match")).count() == 5
    rows = ma.diagnostics(e)
    table = {r.policy: r.matched_clean_count for r in ma.policy_table(rows).collect()}
    assert table == {"tight sky/mag only": 1, "tight or distance <= 10%": 2, "tight or distance <= 25%": 3, "broad clean one-to-one": 3}
    assert sum(r.n_rows for r in ma.quality_summary(rows).collect()) == 3
    bins = ma.distance_histogram(rows).collect()
    assert len(bins) == 16 and sum(r.clean_auto_eligible_count for r in bins) == 3
    assert len(ma.exact_quantiles(rows.limit(0), "distance_pct_diff").collect()) == 11


def test_map_reader_and_validation(spark):
    raw = spark.createDataFrame([(1, 5, None), (1, 5, "s"), (0, 4, "s"), (None, 3, "s"), (2, 6, None)], "Source_ID long, Original_Ext_Source_ID long, mapping_source string")
    got = {(r.gaia_source_id, r.hip_source_id): (r.mapping_source, r.number_of_neighbours) for r in normalise_map(raw, "unknown").collect()}
    assert got == {(1, 5): ("s", 0), (2, 6): ("unknown", 0)}
    with pytest.raises(ValueError, match="a map needs"):
        normalise_map(raw.drop("Source_ID"))
    with pytest.raises(ValueError, match="repeated hip ids.*5"):
        require_one_to_one(pairs(spark, [(1, 5), (2, 5)]))
    assert require_one_to_one(pairs(spark, [(1, 5), (2, 6)])).count() == 2
    first = combine_maps(pairs(spark, [(1, 5)]), pairs(spark, [(1, 5), (2, 6)]).withColumn("mapping_source", F.lit("other")))
    assert {r.gaia_source_id: r.mapping_source for r in first.collect()} == {1: "m", 2: "other"}


def test_review_and_sidecar(spark, tmp_path):
    e = spark.createDataFrame([("100", "200", "octree_review", "low", "r", 0.5, 0.3, 20.0, 5.0, 100.0, 4.0), ("1", "2", "manual_review", "high", "r", 0.5, 0.3, 20.0, 5.0, 100.0, 4.0)], "gaia_source_id string, hip_source_id string, decision string, severity string, reasons string, separation_arcsec double, apparent_mag_delta double, hip_ra_deg double, hip_dec_deg double, hip_r_pc double, hip_mag_abs double")
    issues = spark.createDataFrame([("merged_row_extreme", "high", "hip", "90910", "far", 100.0, 10.0, 50_000.0, -12.0), ("other", "low", "hip", "1", "x", 1.0, 1.0, 1.0, 1.0)], "issue_type string, severity string, source string, source_id string, reasons string, merged_ra_deg double, merged_dec_deg double, merged_r_pc double, merged_mag_abs double")
    review = review_table(e, issues)
    assert review.count() == 2
    assert write_sidecar(review, str(tmp_path / "octree_review"), 1) == 2
    assert spark.read.parquet(str(tmp_path / "octree_review")).select("hpx").distinct().count() == 2
    queue = manual_queue(e, issues).collect()
    assert [(r.severity, r.issue_type) for r in queue] == [("high", "close_pair_manual_review"), ("high", "merged_row_extreme")]
    assert review_table(e.limit(0), issues.limit(0)).columns == review.columns
