"""Whole runs from files to files: raw match, processed audit, review report, cohorts and scores.

Each run checks its inputs and the absence of its outputs first, validates maps before any is written, and ends with a
JSON report of scalars. Evidence is written to the shared folder before its many readers; that table is deleted at the end."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.operators import cohorts as co
from starweave.operators import match_audit as ma
from starweave.operators import match_evidence as me
from starweave.operators.maps import LOCAL_SOURCE, combine_maps, inferred_source, normalise_map, require_one_to_one, strict_ids, supplemental_map
from starweave.operators.review import manual_queue, review_table, write_sidecar
from starweave.operators.scoring import score_candidates
from starweave.session import discard, materialise, ship_package
from starweave.sources.sinks import exists, write_csv, write_parquet, write_report, write_table_twice
from starweave.sources.tables import conform, read_ecsv, read_overrides, text_of_bytes

RAW_HIP = {"hip": "bigint", "rarad": "double", "derad": "double", "pmra": "double", "pmde": "double", "hpmag": "double", "plx": "double", "e_plx": "double", "sn": "int", "b_v": "double", "loaded_at": "timestamp"}
RAW_GAIA = {"source_id": "bigint", "ra_deg": "double", "dec_deg": "double", "phot_g_mean_mag": "double", "phot_bp_mean_mag": "double", "phot_rp_mean_mag": "double", "parallax": "double", "parallax_error": "double", "loaded_at": "timestamp"}
#: Names a survey file may use instead.
GAIA_NAMES = {"ra": "ra_deg", "dec": "dec_deg"}
REQUIRED_HIP = ("hip", "rarad", "derad", "pmra", "pmde", "hpmag")
REQUIRED_GAIA = ("source_id", "ra_deg", "dec_deg", "phot_g_mean_mag")


def prepare(spark: SparkSession, inputs: list[str], outputs: list[str], force: bool) -> None:
    """Raises FileNotFoundError for a missing input and FileExistsError for an output that would be replaced."""
    ship_package(spark)
    for path in inputs:
        if not exists(spark, path):
            raise FileNotFoundError(path)
    there = [] if force else [p for p in outputs if exists(spark, p)]
    if there:
        raise FileExistsError("outputs exist: " + ", ".join(there))


def read_any(spark: SparkSession, path: str, schema: dict[str, str], required: tuple[str, ...] = ()) -> DataFrame:
    """Parquet or ECSV by the file's suffix, with lower-case names and the given columns."""
    if path.endswith(".ecsv"):
        df = read_ecsv(spark, path, schema)
    else:
        df = spark.read.parquet(path)
        df = df.toDF(*[c.lower() for c in df.columns]).withColumnsRenamed(GAIA_NAMES)
    lost = [c for c in required if c not in df.columns]
    if lost:
        raise ValueError(f"{path} lacks the columns {', '.join(lost)}")
    return conform(df, schema)


def read_map(spark: SparkSession, path: str, default_source: str | None = "", strict: bool = False) -> DataFrame:
    """A map file. ``default_source`` None: taken from the map's flag column. ``strict``: unsound ids raise instead of
    being left out."""
    if path.endswith(".ecsv"):
        names = {"source_id": "bigint", "original_ext_source_id": "bigint", "gaia_source_id": "bigint", "hip_source_id": "bigint", "mapping_source": "string", "number_of_neighbours": "smallint", "angular_distance": "float"}
        df = read_ecsv(spark, path, names)
        own = df.where(F.col("gaia_source_id").isNotNull()).isEmpty()
        return normalise_map(df.drop("gaia_source_id", "hip_source_id") if own else df, default_source)
    df = spark.read.parquet(path)
    return normalise_map(strict_ids(df) if strict else df, inferred_source(df) if default_source is None else default_source)


def by_ids(pairs: DataFrame) -> DataFrame:
    """A map in the order of its ids, range-partitioned for the writer."""
    return pairs.orderBy("gaia_source_id", "hip_source_id")


@dataclass(frozen=True)
class RawMatch:
    max_sep: float = me.MAX_SEP_ARCSEC
    max_mag_delta: float | None = None
    auto_sep: float = me.AUTO_SEP_ARCSEC
    max_3d_pc: float = me.MAX_3D_PC


def run_raw_match(spark: SparkSession, hip: str, gaia: str, official: str, out: str, neighbourhood: str | None = None, options: RawMatch = RawMatch(), force: bool = False) -> dict:  # noqa: B008
    """Prepared secondary sources, evidence, supplemental and combined map, report."""
    paths = {n: f"{out}/{n}" for n in ("hip_sources.parquet", "match_evidence.parquet", "supplemental_map.parquet", "combined_map.parquet", "report.json")}
    prepare(spark, [hip, gaia, official, *([neighbourhood] if neighbourhood else [])], list(paths.values()), force)
    raw_hip, raw_gaia = read_any(spark, hip, RAW_HIP, REQUIRED_HIP), read_any(spark, gaia, RAW_GAIA, REQUIRED_GAIA)
    secondary, primary = me.secondary_sources(raw_hip), me.primary_sources(raw_gaia)
    known = read_map(spark, official, "unknown")
    near = read_map(spark, neighbourhood) if neighbourhood else known.limit(0)
    evidence = materialise(me.raw_match_evidence(primary, secondary, known, near, options.max_sep, options.max_mag_delta, options.auto_sep, options.max_3d_pc))
    supplemental = require_one_to_one(supplemental_map(evidence))
    combined = require_one_to_one(combine_maps(known, supplemental))
    write_parquet(secondary.drop("x", "y", "z").sortWithinPartitions("id"), paths["hip_sources.parquet"], force)
    write_parquet(me.display_order(evidence), paths["match_evidence.parquet"], force)
    write_parquet(by_ids(supplemental), paths["supplemental_map.parquet"], force)
    write_parquet(by_ids(combined), paths["combined_map.parquet"], force)
    scanned, used = raw_gaia.count(), primary.count()
    report = me.match_report(evidence).first().asDict() | {"gaia_rows": scanned, "gaia_sources": used, "gaia_rows_skipped": scanned - used, "hip_rows": raw_hip.count(), "hip_sources": secondary.count(), "official_rows": known.count(), "combined_rows": combined.count(), "options": vars(options)}
    write_report(spark, report, paths["report.json"], force)
    discard(evidence)
    return report


def run_match_audit(spark: SparkSession, gaia: str, hip: str, official: str, overrides: str | None, out: str, force: bool = False, limits: ma.AuditLimits = ma.LIMITS) -> dict:
    """Processed-catalogue evidence, maps and the distance diagnostics."""
    names = ("evidence", "supplemental_map", "combined_map", "distance_histogram", "quality_summary", "policies")
    prepare(spark, [gaia, hip, official, *([overrides] if overrides else [])], [f"{out}/{n}" for n in names] + [f"{out}/report.json"], force)
    known = read_map(spark, official, strict=True)
    keys = read_overrides(spark.read.parquet(overrides), ma.OVERRIDE_ACTIONS) if overrides else spark.createDataFrame([], "catalog_name string, source_id bigint")
    side = lambda path, role: ma.processed_sources(spark.read.parquet(path), role)
    evidence = materialise(ma.match_audit(side(gaia, "gaia"), side(hip, "hip"), known, keys, limits))
    supplemental = require_one_to_one(supplemental_map(evidence, "auto_match", LOCAL_SOURCE))
    combined = require_one_to_one(combine_maps(known, supplemental))
    rows = ma.diagnostics(evidence)
    for name, df in (("evidence", me.display_order(ma.with_text_ids(evidence))), ("supplemental_map", by_ids(supplemental)), ("combined_map", by_ids(combined))):
        write_parquet(df, f"{out}/{name}", force)
    for name, df in (("distance_histogram", ma.distance_histogram(rows)), ("quality_summary", ma.quality_summary(rows)), ("policies", ma.policy_table(rows, limits.auto_frac))):
        write_csv(df, f"{out}/{name}", force)
    counts = {r.decision: r["count"] for r in evidence.groupBy("decision").count().collect()}
    quantiles = {str(r["quantile"]): r["value"] for r in ma.exact_quantiles(rows.where("is_clean"), "distance_pct_diff").collect()}
    report = {"decisions": counts, "supplemental_rows": supplemental.count(), "combined_rows": combined.count(), "quantiles_clean_pct_diff": quantiles, "limits": vars(limits)}
    write_report(spark, report, f"{out}/report.json", force)
    discard(evidence)
    return report


def run_audit_report(spark: SparkSession, evidence: str, issues: str, out: str, healpix_order: int = 3, force: bool = False) -> dict:
    """Review table in cells of the sky, manual queue as Parquet and CSV, report."""
    prepare(spark, [evidence, issues], [f"{out}/octree_review", f"{out}/manual.parquet", f"{out}/manual_csv", f"{out}/report.json"], force)
    e, i = spark.read.parquet(evidence), spark.read.parquet(issues)
    review = materialise(review_table(e, i))
    written = write_sidecar(review, f"{out}/octree_review", healpix_order, force)
    queue = materialise(manual_queue(e, i))
    write_table_twice(queue, f"{out}/manual", force)
    report = {"review_rows": review.count(), "sharded_rows": written, "manual_rows": queue.count(), "issue_types": {r.issue_type: r["count"] for r in i.groupBy("issue_type").count().collect()}}
    write_report(spark, report, f"{out}/report.json", force)
    discard(review)
    discard(queue)
    return report


#: Cohorts per catalogue: name, metric, ascending.
COHORTS = (("brightest", "mag", True), ("nearest", "parallax", False), ("high_pm", "pm_total_masyr", False))
KEPT = ["mag", "quality_flags", "quality_flag_count", "pm_total_masyr", "r_pc_parallax", "parallax_frac_error"]


def review_candidates(gaia: DataFrame, hip: DataFrame, official: DataFrame, supplemental: DataFrame, neighbourhood: DataFrame, size: int = co.COHORT_SIZE) -> DataFrame:
    """Rolled-up candidates of both catalogues with context. Both sides: id, mag, parallax,
    parallax_error and whatever else their flags can use."""
    out = None
    for name, df, flags, key, value in (("gaia", gaia, co.survey_flags, "gaia_source_id", "hip_source_id"), ("hip", hip, co.catalogue_flags, "hip_source_id", "gaia_source_id")):
        rows = co.top_cohorts(co.with_quality(df, flags), COHORTS, size)
        one = co.with_context(materialise(co.roll_up(rows, KEPT)), key, value, official, supplemental, neighbourhood).withColumn("catalog_name", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


def run_review(spark: SparkSession, gaia: DataFrame, hip: DataFrame, official: DataFrame, supplemental: DataFrame, neighbourhood: DataFrame, out: str, size: int = co.COHORT_SIZE, force: bool = False) -> dict:
    """Candidates and their priority scores as Parquet and CSV, with flag counts in the report."""
    prepare(spark, [], [f"{out}/{n}" for n in ("candidates.parquet", "candidates_csv", "scores.parquet", "scores_csv", "report.json")], force)
    candidates = materialise(review_candidates(gaia, hip, official, supplemental, neighbourhood, size))
    scores = materialise(score_candidates(candidates))
    write_table_twice(by_flags(candidates), f"{out}/candidates", force)
    write_table_twice(scores, f"{out}/scores", force)
    tiers = {r.priority_tier: r["count"] for r in scores.groupBy("priority_tier").count().collect()}
    flags = {f"{r.catalog_name}.{r.flag}": r.n for r in co.flag_counts(candidates, ["catalog_name"]).collect()}
    report = {"candidates": candidates.count(), "tiers": tiers, "flags": flags}
    write_report(spark, report, f"{out}/report.json", force)
    discard(candidates)
    discard(scores)
    return report


def by_flags(candidates: DataFrame) -> DataFrame:
    """Candidates of both catalogues, those with the most flags first."""
    return candidates.orderBy("catalog_name", F.col("quality_flag_count").desc(), "id")


#: Columns of a source table for the review, those that must be there first.
SOURCES = {"id": "bigint", "mag": "double", "parallax": "double", "parallax_error": "double", "pmra": "double", "pmdec": "double", "sn": "double", "ruwe": "double", "phot_bp_mean_mag": "double", "phot_rp_mean_mag": "double"}
REQUIRED_SOURCES = ("id", "mag", "parallax", "parallax_error")


def run_review_files(spark: SparkSession, gaia: str, hip: str, official: str, supplemental: str, neighbourhood: str, out: str, size: int = co.COHORT_SIZE, force: bool = False) -> dict:
    """``run_review`` from files. Source tables need id, mag, parallax and parallax_error; what else they have their flags use."""
    prepare(spark, [gaia, hip, official, supplemental, neighbourhood], [], force)
    sides = []
    for path in (gaia, hip):
        df = text_of_bytes(spark.read.parquet(path))
        lost = [c for c in REQUIRED_SOURCES if c not in df.columns]
        if lost:
            raise ValueError(f"{path} lacks the columns {', '.join(lost)}")
        sides.append(df.withColumns({c: F.col(c).try_cast(k) for c, k in SOURCES.items() if c in df.columns}))
    return run_review(spark, *sides, *(read_map(spark, p, None) for p in (official, supplemental, neighbourhood)), out, size, force)


def project_settings(path: str, required: tuple[str, ...]) -> dict:
    """The sections of a TOML project file; ValueError without one that is required."""
    with open(path, "rb") as f:
        settings = tomllib.load(f)
    lost = [s for s in required if not isinstance(settings.get(s), dict)]
    if lost:
        raise ValueError(f"{path} lacks the sections {', '.join(lost)}")
    return settings
