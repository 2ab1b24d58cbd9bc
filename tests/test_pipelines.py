import hashlib
import json

import pytest
from pyspark.sql import functions as F

from starweave.__main__ import main, parser
from starweave.operators.match_audit import AUDIT_COLUMNS, with_external_distance
from starweave.plans import pipelines as pl
from starweave.plans import review_queries as rq
from starweave.plans.audit_queries import issues, processed_gaia, processed_hip
from starweave.plans.match_queries import neighbourhood, official
from starweave.sources.sinks import manifest, write_report
from starweave.sources.tables import conform, table
from tests.conftest import DATA


@pytest.fixture(scope="module")
def one_to_one(spark, tmp_path_factory):
    """The official map without repeated ids, as a file: only such a map can be combined."""
    path = str(tmp_path_factory.mktemp("maps") / "official.parquet")
    rows = official(spark, DATA)
    for key in ("gaia_source_id", "hip_source_id"):
        rows = rows.join(rows.groupBy(key).count().where("count = 1").select(key), key, "left_semi")
    rows.write.parquet(path)
    return path


def test_raw_match_files(spark, one_to_one, tmp_path):
    out = str(tmp_path / "raw")
    files = (f"{DATA}/raw_hip.parquet", f"{DATA}/raw_gaia.parquet", one_to_one)
    report = pl.run_raw_match(spark, *files, out)
    assert report["evidence_pairs"] == spark.read.parquet(f"{out}/match_evidence.parquet").count() > 0
    assert report["combined_rows"] == spark.read.parquet(f"{out}/combined_map.parquet").count()
    assert json.load(open(f"{out}/report.json"))["hip_sources"] == report["hip_sources"]
    with pytest.raises(FileExistsError):
        pl.run_raw_match(spark, *files, out)
    with pytest.raises(FileNotFoundError):
        pl.run_raw_match(spark, "/nowhere.parquet", *files[1:], out, force=True)


def test_repeated_ids_stop_before_maps_are_written(spark, tmp_path):
    out = str(tmp_path / "raw")
    bad = str(tmp_path / "bad.parquet")
    spark.createDataFrame([(1, 5), (2, 5)], "gaia_source_id long, hip_source_id long").write.parquet(bad)
    assert main(["raw-match", f"{DATA}/raw_hip.parquet", f"{DATA}/raw_gaia.parquet", bad, out]) == 1
    assert not pl.exists(spark, f"{out}/combined_map.parquet")
    with pytest.raises(ValueError, match="lacks the columns"):
        pl.read_any(spark, bad, pl.RAW_HIP, pl.REQUIRED_HIP)


def test_audit_and_report_files(spark, one_to_one, tmp_path):
    g, h, i = (str(tmp_path / n) for n in ("gaia.parquet", "hip.parquet", "issues.parquet"))
    processed_gaia(spark, DATA).write.parquet(g)
    processed_hip(spark, DATA).withColumn("source", F.lit("hip")).write.parquet(h)
    issues(spark, DATA).write.parquet(i)
    out = str(tmp_path / "audit")
    report = pl.run_match_audit(spark, g, h, one_to_one, f"{DATA}/overrides.parquet", out)
    assert sum(report["decisions"].values()) == spark.read.parquet(f"{out}/evidence").count() > 0
    assert spark.read.csv(f"{out}/policies", header=True).count() == 4
    written = spark.read.parquet(f"{out}/evidence")
    assert tuple(written.columns) == AUDIT_COLUMNS and dict(written.dtypes)["gaia_source_id"] == "string"
    found = pl.run_audit_report(spark, f"{out}/evidence", i, str(tmp_path / "report"), 1)
    assert found["manual_rows"] == spark.read.parquet(str(tmp_path / "report/manual.parquet")).count() > 0
    assert found["sharded_rows"] == found["review_rows"] == spark.read.parquet(str(tmp_path / "report/octree_review")).count()
    again = ["report", f"{out}/evidence", i, str(tmp_path / "report"), "--healpix-order", "1"]
    assert main(again) == 1 and main([*again, "--force"]) == 0
    assert json.load(open(tmp_path / "report/report.json")) == json.loads(json.dumps(found))
    spark.range(1).write.csv(str(tmp_path / "half/manual_csv"))
    assert main(["report", f"{out}/evidence", i, str(tmp_path / "half")]) == 1 and not pl.exists(spark, str(tmp_path / "half/manual.parquet"))
    narrow = str(tmp_path / "narrow")
    assert main(["audit", g, h, one_to_one, narrow, "--max-sep", "1.0", "--max-mag", "0.2"]) == 0
    some = spark.read.parquet(f"{narrow}/evidence")
    assert some.where("separation_arcsec > 1.0 OR apparent_mag_delta > 0.2").isEmpty() and 0 < some.count() < written.count()


def test_review_files(spark, one_to_one, tmp_path):
    sources = [rq.survey(spark, DATA), rq.catalogue(spark, DATA)]
    slim = [s.drop("quality_flags", "quality_flag_count", "r_pc_parallax", "parallax_frac_error", "pm_total_masyr") for s in sources]
    known = spark.read.parquet(one_to_one)
    report = pl.run_review(spark, *slim, known, known.limit(0), neighbourhood(spark, DATA), str(tmp_path / "review"), size=20)
    assert report["candidates"] == sum(report["tiers"].values()) > 20
    assert table(spark, str(tmp_path / "review"), "scores").select("priority_rank").distinct().count() == report["candidates"]
    files = []
    for name, df in (("g", slim[0]), ("h", slim[1]), ("s", known.limit(0)), ("n", neighbourhood(spark, DATA))):
        files.append(str(tmp_path / name))
        df.write.parquet(files[-1])
    assert main(["review", files[0], files[1], one_to_one, files[2], files[3], str(tmp_path / "by_files"), "--size", "20"]) == 0
    assert json.load(open(tmp_path / "by_files/report.json"))["candidates"] == report["candidates"]
    rows = spark.read.csv(str(tmp_path / "by_files/candidates_csv"), header=True, inferSchema=True).where("catalog_name = 'gaia'").select("quality_flag_count", "id").collect()
    assert [tuple(r) for r in rows] == sorted((tuple(r) for r in rows), key=lambda r: (-r[0], r[1]))


def test_orders_of_what_is_written(spark, one_to_one, tmp_path):
    out = str(tmp_path / "raw")
    pl.run_raw_match(spark, f"{DATA}/raw_hip.parquet", f"{DATA}/raw_gaia.parquet", one_to_one, out)
    ids = [tuple(r) for r in spark.read.parquet(f"{out}/combined_map.parquet").coalesce(1).select("gaia_source_id", "hip_source_id").collect()]
    assert ids == sorted(ids)
    rows = [tuple(r) for r in spark.read.parquet(f"{out}/match_evidence.parquet").coalesce(1).select("decision", "separation_arcsec").collect()]
    assert rows == sorted(rows)


def test_strict_maps_and_sources(spark, tmp_path):
    big = 9_007_199_254_740_993
    for n, (ids, said) in enumerate((([("1.5", 2)], "fractional"), ([("-3", 2)], "non-positive"), ([("0", 2)], "non-positive"), ([("nan", 2)], "non-finite"), ([(None, 2)], "non-finite"), ([("x", 2)], "non-finite"))):
        path = str(tmp_path / f"m{n}")
        spark.createDataFrame(ids, "source_id string, original_ext_source_id long").write.parquet(path)
        assert pl.read_map(spark, path).count() == 0
        with pytest.raises(Exception, match=said):
            pl.read_map(spark, path, strict=True).collect()
    sound = str(tmp_path / "sound")
    spark.createDataFrame([(str(big), 7.0, 0), ("12.0", 8.0, 0)], "SOURCE_ID string, original_ext_source_id double, xm_flag int").write.parquet(sound)
    rows = {r.gaia_source_id: (r.hip_source_id, r.mapping_source) for r in pl.read_map(spark, sound, None, strict=True).collect()}
    assert rows == {big: (7, "hipparcos2_best_neighbour"), 12: (8, "hipparcos2_best_neighbour")}
    plain = str(tmp_path / "plain")
    spark.createDataFrame([(1, 2)], "gaia_source_id long, hip_source_id long").write.parquet(plain)
    assert pl.read_map(spark, plain, None).first().mapping_source == "unknown"


def test_bytes_manifest_settings_and_distances(spark, tmp_path):
    df = spark.createDataFrame([(bytearray("é".encode()), 1), (bytearray(b"\xff"), 2), (None, 3)], "t binary, n int")
    assert [r.t for r in conform(df, {"t": "string"}).collect()] == ["é", "\ufffd", None]
    write_report(spark, {"a": 1}, str(tmp_path / "deep/er/r.json"))
    with pytest.raises(FileExistsError):
        write_report(spark, {"a": 2}, str(tmp_path / "deep/er/r.json"))
    row = manifest(spark, str(tmp_path / "deep")).first()
    assert row.sha256 == hashlib.sha256(open(tmp_path / "deep/er/r.json", "rb").read()).hexdigest() and row.length > 0
    (tmp_path / "p.toml").write_text("[hip]\npath = 'x'\n")
    assert pl.project_settings(str(tmp_path / "p.toml"), ("hip",))["hip"]["path"] == "x"
    with pytest.raises(ValueError, match="gaia"):
        pl.project_settings(str(tmp_path / "p.toml"), ("hip", "gaia"))
    far = spark.createDataFrame([(1, 5.0), (1, 4.0), (2, float("nan")), (3, None), (4, -1.0), (9, 2.0)], "source_id long, external_r_pc double")
    got = with_external_distance(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "source_id long, name string"), far)
    assert [tuple(r) for r in got.collect()] == [(1, "a", 4.0)]


def test_command_line_defaults():
    a = parser().parse_args(["raw-match", "h", "g", "o", "out"])
    assert (a.max_sep, a.max_mag_delta, a.auto_sep, a.max_3d_pc, a.force) == (5.0, None, 0.25, 1.0, False)
