import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from starweave.functions.numeric import parse_id
from starweave.operators import cohorts as co
from starweave.operators import scoring as sc
from starweave.operators.colour_fit import fit_polynomial, with_colour_residual
from starweave.operators.quantiles import quantiles_by
from starweave.plans import problem_queries, review_queries
from starweave.sources.sinks import write_csv, write_parquet, write_report
from starweave.sources.tables import conform, read_ecsv, read_overrides, read_parquet_files, table
from tests.conftest import DATA


def test_top_cohort_ties_and_missing(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, None), (4, float("nan")), (5, 0.5)], "id long, mag double")
    got = [(r.id, r.cohort_rank) for r in co.top_cohort(df, "brightest", "mag", True, 2).orderBy("cohort_rank").collect()]
    assert got == [(5, 1), (1, 2)]


def test_roll_up_keeps_best_rank_and_cohort_order(spark):
    rows = [(1, "nearest", 3, "a"), (1, "brightest", 3, "b"), (1, "high_pm", 9, "c"), (2, "high_pm", 1, "d")]
    got = {r.id: (r.cohorts, r.cohort_ranks, r.v) for r in co.roll_up(spark.createDataFrame(rows, "id long, cohort string, cohort_rank int, v string"), ["v"]).collect()}
    assert got == {1: ("brightest;nearest;high_pm", "brightest:3;nearest:3;high_pm:9", "b"), 2: ("high_pm", "high_pm:1", "d")}


def test_flags(spark):
    g = spark.createDataFrame([(1, -1.0, 0.5, 1.5, None, True, "VARIABLE"), (2, 10.0, 0.1, 1.0, 3.0, None, None)], "id long, parallax double, parallax_error double, ruwe double, phot_bp_mean_mag double, duplicated_source boolean, phot_variable_flag string").withColumn("phot_rp_mean_mag", F.lit(2.0))
    got = {r.id: (r.quality_flags, r.quality_flag_count) for r in co.with_quality(g, co.survey_flags).collect()}
    assert got == {1: ("ruwe_gt_1p4;parallax_frac_error_gt_0p1;non_positive_parallax;duplicated_source;missing_bp_or_rp;phot_variable", 6), 2: ("", 0)}
    h = spark.createDataFrame([(1, 10.0, 0.1, 1.0, 1.0, 7, "A"), (2, 10.0, None, 1.0, 1.0, 5, " ")], "id long, parallax double, parallax_error double, pmra double, pmdec double, sn int, n_hip string")
    assert [r.quality_flags for r in co.with_quality(h, co.catalogue_flags).orderBy("id").collect()] == ["hip_solution_type_not_5;hip_component_flag", ""]


def test_rank_map_and_lists(spark):
    df = spark.createDataFrame([("brightest:1; nearest:x;nearest:7;brightest:4;bad",), (None,), ("",)], "t string")
    assert [r.m for r in df.select(sc.rank_map(F.col("t")).alias("m")).collect()] == [{"brightest": 4, "nearest": 7}, {}, {}]
    assert df.limit(1).select(co.merged_lists(F.lit("b; a;;b"), F.lit(None).cast("string"), F.lit("c;a")).alias("x")).first().x == "b;a;c"
    assert [r.x for r in spark.createDataFrame([("Yes",), (None,), ("0",), (" TRUE ",)], "t string").select(sc.truthy(F.col("t")).alias("x")).collect()] == [True, False, False, True]


def test_scores_by_hand(spark):
    cols = "catalog_name string, id long, cohorts string, cohort_ranks string, quality_flags string, quality_flag_count int, mag double, r_pc_parallax double, pm_total_masyr double, has_official_best_neighbour boolean, has_fis_supplemental_match boolean, has_any_gaia_hip_match boolean, official_neighbourhood_ids string, counterpart_ids string"
    rows = [("gaia", 1, "brightest;nearest", "brightest:1;nearest:1", "ruwe_gt_1p4;non_positive_parallax", 2, 1.5, 4.0, 3500.0, False, False, False, "9", ""), ("hip", 2, "high_pm", "high_pm:251", "", 0, None, None, None, True, False, True, "", "5"), ("hip", 3, "high_pm", "high_pm:251", "", 0, None, None, None, False, True, True, "", "5")]
    got = sc.score_candidates(spark.createDataFrame(rows, cols)).orderBy("priority_rank").collect()
    a, b, c = got
    assert (a.cohort_score, a.visibility_score, a.quality_score, a.crossmatch_gap_score, a.priority_score, a.priority_tier) == (70.0, 36.0, 20.0, 30.0, 156.0, "P1")
    assert a.priority_reasons == "brightest_rank=1;nearest_rank=1;multi_cohort=2;no_official_or_fis_gaia_hip_match;official_neighbourhood_without_best_match;ruwe_gt_1p4;non_positive_parallax"
    assert (b.source_id, b.priority_score, b.priority_tier) == ("3", 15.0, "P4") and b.priority_reasons.endswith("fis_supplemental_only_match")
    assert (c.source_id, c.cohort_score, c.crossmatch_gap_score) == ("2", 9.0, 0.0)


def test_parse_id(spark):
    rows = ["12", " HIP 0012 ", "HIP12", "Gaia DR3 6068663998977123328", "gaia 5", "Gaia DR3", "", "nan", None, "99999999999999999999", "\t7"]
    got = [r.i for r in spark.createDataFrame([(r,) for r in rows], "t string").select(parse_id("t").alias("i")).collect()]
    assert got == [12, 12, 12, 6068663998977123328, 5, None, None, None, None, None, 7]


def test_readers(spark, tmp_path):
    text = "# %ECSV 1.0\n# ---\n# datatype: []\nHIP RArad Name\n1 10.5 \"a b\"\n2 \"\" c\n"
    (tmp_path / "t.ecsv").write_text(text)
    got = read_ecsv(spark, str(tmp_path / "t.ecsv"), {"HIP": "bigint", "RArad": "double", "Name": "string", "Plx": "double"}).collect()
    assert [tuple(r) for r in got] == [(1, 10.5, "a b", None), (2, None, "c", None)]
    spark.range(3).selectExpr("cast(id as decimal(20,0)) AS source_id").write.parquet(str(tmp_path / "a"))
    spark.range(1).selectExpr("'x' AS mag", "5L AS source_id").write.parquet(str(tmp_path / "b"))
    spark.range(1).selectExpr("1 AS other").write.parquet(str(tmp_path / "c"))
    df = read_parquet_files(spark, [str(tmp_path / p) for p in "abc"], {"source_id": "bigint", "mag": "double"})
    assert dict(df.dtypes) == {"source_id": "bigint", "mag": "double"} and df.count() == 4 and df.where("mag is not null").count() == 0
    assert conform(spark.range(1), {"q": "string"}).columns == ["q"]
    ov = spark.createDataFrame([(" HIP", "HIP 03", "Drop "), ("gaia", "x", "drop"), ("hip", "4", "keep")], "source string, source_id string, override_action string")
    assert [tuple(r) for r in read_overrides(ov, ("drop",)).collect()] == [("hip", 3)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan"), None), (2, 1.5, "")], "a int, b double, c string")
    write_csv(df, str(tmp_path / "csv"))
    lines = next((tmp_path / "csv").glob("*.csv")).read_text().splitlines()
    assert lines == ["a,b,c", "1,,", "2,1.5,"]
    write_parquet(df, str(tmp_path / "p"))
    with pytest.raises(Exception, match="already exists"):
        write_parquet(df, str(tmp_path / "p"))
    write_parquet(df, str(tmp_path / "p"), overwrite=True)
    write_report(spark, {"b": 1, "a": [2]}, str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text()) == {"a": [2], "b": 1}
    with pytest.raises(FileExistsError):
        write_report(spark, {}, str(tmp_path / "r.json"))


def test_whole_cohorts_rank_up_to_cohort_size(spark):
    had = {(r.catalog_name, r.cohort): r.n for r in review_queries.QUERIES["cohort_rows"](spark, DATA).groupBy("catalog_name", "cohort").agg(F.max("cohort_rank").alias("n")).collect()}
    bright = review_queries.survey(spark, DATA).where("mag IS NOT NULL").count()
    assert had["gaia", "brightest"] == min(bright, co.COHORT_SIZE)


def test_cohorts_in_one_pass_equal_single_ones(spark):
    rng = np.random.default_rng(3)
    rows = [(k, float(rng.integers(0, 40)) if k % 7 else None, float(rng.integers(-5, 40)) if k % 5 else float("nan")) for k in range(400)]
    df = spark.createDataFrame(rows, "id long, mag double, parallax double").withColumn("order", F.lit("clash"))
    for size in (1, 30, 1000):
        want = {(r.id, r.cohort, r.cohort_rank) for d in (co.top_cohort(df, "brightest", "mag", True, size), co.top_cohort(df.where("parallax > 0"), "nearest", "parallax", False, size)) for r in d.collect()}
        assert {(r.id, r.cohort, r.cohort_rank) for r in co.top_cohorts(df, (("brightest", "mag", True), ("nearest", "parallax", False)), size).collect()} == want


def test_quantiles_by_ranges_equal_the_exact_ones(spark):
    rng = np.random.default_rng(8)
    rows = [(None if k % 11 == 0 else f"g{k % 3}", float(rng.choice([1.5, 2.5, rng.normal()])), None if k % 4 else float(k)) for k in range(3000)] + [("one", 7.0, None), ("none", None, float("nan"))]
    df = spark.createDataFrame(rows, "g string, a double, b double").withColumn("range", F.lit(1)).withColumn("value", F.lit("x"))
    at = (0.0, 0.1, 0.5, 0.99, 1.0)
    got = {(r.g, r.measure, r.quantile): r.value for r in quantiles_by(df, ["g"], {"a": F.col("a"), "b": F.col("b")}, at).collect()}
    want = {}
    for r in df.groupBy("g").agg(*[F.percentile(F.when(~F.isnan(c), F.col(c)), F.array(*map(F.lit, at))).alias(c) for c in "ab"]).collect():
        want |= {(r.g, c, q): v for c in "ab" if r[c] for q, v in zip(at, r[c], strict=True)}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert quantiles_by(df.limit(0), [], {"a": F.col("a")}, at).count() == 0


def test_polynomial_equals_numpy_and_gates(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(-0.5, 3, 600)
    y = 0.2 - 0.4 * x + 0.3 * x**2 - 0.05 * x**3 + rng.normal(0, 0.02, 600)
    rows = [(float(a), float(b)) for a, b in zip(x, y, strict=True)]
    schema = "x double, y double"
    assert np.allclose(fit_polynomial(spark.createDataFrame(rows, schema), "x", "y", 3, rounds=1).coefficients, np.polyfit(x, y, 3)[::-1], atol=1e-6)
    far = rows + [(1.0, 9.0)] * 30 + [(None, 1.0), (float("nan"), 1.0), (1.0, None)]
    fit = fit_polynomial(spark.createDataFrame(far, schema), "x", "y", 3, rounds=6)
    assert np.allclose(fit.coefficients, (0.2, -0.4, 0.3, -0.05), atol=0.03) and fit.n <= 600
    rated = with_colour_residual(spark.createDataFrame(far, schema), "x", "y", fit)
    assert rated.where("y = 9.0 AND within_colour_gate").isEmpty() and rated.where("colour_residual IS NULL").count() == 3
    assert fit_polynomial(spark.createDataFrame([(2.0, 5.0)] * 3, schema), "x", "y").coefficients == (5.0, 0.0, 0.0, 0.0)
    assert fit_polynomial(spark.createDataFrame([], schema), "x", "y").n == 0


def test_whole_queries_leave_no_record_or_field_out(spark):
    tiers = review_queries.QUERIES["rescored_tiers"](spark, DATA).agg(F.sum("n")).first()[0]
    assert tiers == table(spark, DATA, "review_scores").select("review_id").distinct().count()
    fields = problem_queries.QUERIES["p1_value_counts"](spark, DATA).select("field_name").distinct().collect()
    assert {r.field_name for r in fields} == {"reasons", "quality_flags", "cohort_ranks", "counterpart_ids"}
