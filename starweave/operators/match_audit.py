"""The processed-catalogue audit: cone and magnitude join with overrides, and its diagnostics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starweave.functions.geometry import apparent_magnitude, separation_3d_pc
from starweave.functions.numeric import finite, finite_or_null
from starweave.operators.cone_join import cone_pairs, with_unit_vector
from starweave.operators.match_evidence import facts_by_key
from starweave.operators.rules import Rule, decide
from starweave.operators.quantiles import quantiles_by
from starweave.session import materialise


@dataclass(frozen=True)
class AuditLimits:
    """Separation in arcsec and magnitude difference of a candidate, those of a tight one, and the relative distance
    difference that diagnostics report."""

    max_sep: float = 5.0
    max_mag: float = 0.5
    auto_sep: float = 0.25
    auto_mag: float = 0.25
    auto_frac: float = 0.10


LIMITS = AuditLimits()
#: Histogram edges in percent, quality bin edges, reported quantiles, override actions that count.
HISTOGRAM_EDGES = (0, 1, 2, 3, 4, 5, 7.5, 10, 12.5, 15, 20, 25, 30, 40, 50, 75, 100)
QUALITY_EDGES = (0, 0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 1, 2, 5, 10)
QUANTILES = (0, 0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99, 1.0)
OVERRIDE_ACTIONS = ("replace", "drop", "add")
#: Columns a processed source may lack; they are then NULL.
PROCESSED = {
    "source_id": "bigint", "ra_deg": "double", "dec_deg": "double", "r_pc": "double", "mag_abs": "double", "astrometry_quality": "double", "photometry_quality": "double", "ruwe": "double", "phot_g_mean_mag": "double",
    "sn": "double", "hpmag": "double",
}
#: The columns of the audit's evidence, in order.
AUDIT_COLUMNS = (
    "gaia_source_id", "hip_source_id", "decision", "recommended_action", "severity", "reasons", "separation_arcsec", "apparent_mag_delta", "distance_ratio", "distance_frac_diff", "gaia_ra_deg", "gaia_dec_deg", "hip_ra_deg", "hip_dec_deg",
    "gaia_r_pc", "hip_r_pc", "gaia_mag_abs", "hip_mag_abs", "gaia_apparent_mag", "hip_apparent_mag", "gaia_astrometry_quality", "hip_astrometry_quality", "gaia_photometry_quality", "hip_photometry_quality", "gaia_ruwe",
    "gaia_phot_g_mean_mag", "hip_solution_type", "hip_hpmag", "gaia_has_official_map", "hip_has_official_map", "official_conflict", "gaia_official_hip_source_id", "hip_official_gaia_source_id", "gaia_candidate_count",
    "hip_candidate_count", "one_to_one", "within_auto_thresholds", "within_distance_threshold", "overridden",
)
AUDIT_IDS = ("gaia_source_id", "hip_source_id", "gaia_official_hip_source_id", "hip_official_gaia_source_id")


def processed_sources(df: DataFrame, role: str) -> DataFrame:
    """Rows of one role that can be matched, with apparent magnitude and unit vector."""
    source = F.coalesce("source", F.lit(role)) if "source" in df.columns else F.lit(role)
    rows = df.where(source == role).select(*[(F.col(c) if c in df.columns else F.lit(None)).try_cast(k).alias(c) for c, k in PROCESSED.items()])
    rows = rows.where(finite("r_pc") & (F.col("r_pc") > 0) & finite("mag_abs")).distinct()
    rows = rows.withColumns({"mag": apparent_magnitude(F.col("mag_abs"), F.col("r_pc")), "id": F.col("source_id")})
    return with_unit_vector(rows.where(finite("mag")), "ra_deg", "dec_deg")


def match_audit(gaia: DataFrame, hip: DataFrame, official: DataFrame, override_keys: DataFrame, limits: AuditLimits = LIMITS) -> DataFrame:
    """Pairs close in place and magnitude that the official map does not have, with decision: AUDIT_COLUMNS, ids as numbers.

    ``override_keys``: (catalog_name, source_id). A side that is mapped at all is a conflict here."""
    carried = {"ra_deg": "ra_deg", "dec_deg": "dec_deg", "r_pc": "r_pc", "mag_abs": "mag_abs", "mag": "apparent_mag", "astrometry_quality": "astrometry_quality", "photometry_quality": "photometry_quality"}
    own = {"gaia": {"ruwe": "ruwe", "phot_g_mean_mag": "phot_g_mean_mag"}, "hip": {"sn": "solution_type", "hpmag": "hpmag"}}
    side = lambda df, p, key: df.select(F.col("id").alias(key), "x", "y", "z", *[F.col(c).alias(f"{p}_{n}") for c, n in (carried | own[p]).items()])
    rows = cone_pairs(side(gaia, "gaia", "id"), side(hip, "hip", "id2"), limits.max_sep)
    rows = rows.withColumn("apparent_mag_delta", F.abs(F.col("gaia_apparent_mag") - F.col("hip_apparent_mag"))).where(F.col("apparent_mag_delta") <= limits.max_mag)
    g, h = F.col("gaia_source_id"), F.col("hip_source_id")
    kept = materialise(rows.join(official.select(g.alias("id"), h.alias("id2")).distinct(), ["id", "id2"], "left_anti"))
    over = {name: override_keys.where(F.col("catalog_name") == name).select("source_id") for name in ("gaia", "hip")}
    by_g = facts_by_key(kept, "id", {"gaia_candidate_count": F.lit(True)}, official.select(g, h), "gaia_official_hip_source_id", {"gaia_over": over["gaia"]})
    by_h = facts_by_key(kept, "id2", {"hip_candidate_count": F.lit(True)}, official.select(h, g), "hip_official_gaia_source_id", {"hip_over": over["hip"]})
    rows = kept.join(by_g, "id").join(by_h, "id2")
    c, no = F.col, F.lit(False)
    greater, less = F.greatest("gaia_r_pc", "hip_r_pc"), F.least("gaia_r_pc", "hip_r_pc")
    rows = rows.withColumns({
        "separation_arcsec": c("sep_arcsec"), "distance_ratio": greater / less, "distance_frac_diff": F.abs(c("gaia_r_pc") - c("hip_r_pc")) / greater,
        "one_to_one": (c("gaia_candidate_count") == 1) & (c("hip_candidate_count") == 1), "gaia_has_official_map": c("gaia_official_hip_source_id").isNotNull(), "hip_has_official_map": c("hip_official_gaia_source_id").isNotNull(),
        "overridden": c("gaia_over") | c("hip_over"), "within_auto_thresholds": (c("sep_arcsec") <= limits.auto_sep) & (c("apparent_mag_delta") <= limits.auto_mag),
    })
    rows = rows.withColumns({"official_conflict": c("gaia_has_official_map") | c("hip_has_official_map"), "within_distance_threshold": F.coalesce(c("distance_frac_diff") <= limits.auto_frac, no)})
    clean = "clean_one_to_one_broad_scan_match"
    rules = [
        Rule(c("overridden"), "manual_review", "inspect_override_interaction", "high", ("manual_override_present",)),
        Rule(c("official_conflict"), "manual_review", "inspect_conflicting_crossmatch", "high", ("official_crossmatch_conflict",)),
        Rule(~c("one_to_one"), "manual_review", "inspect_ambiguous_close_pair", "high", ("ambiguous_many_to_one_candidate",)),
        Rule(c("within_auto_thresholds"), "auto_match", "add_supplemental_crossmatch", "medium", (clean, "tight_sky_mag_match")),
        Rule(finite("distance_frac_diff"), "auto_match", "add_supplemental_crossmatch", "medium", (clean, "distance_disagreement_recorded_not_vetoed")),
        Rule(F.lit(True), "auto_match", "add_supplemental_crossmatch", "medium", (clean, "distance_unavailable_not_vetoed")),
    ]
    decided = decide(rules, [F.lit("close_cross_catalog_position"), F.lit("similar_apparent_magnitude")])
    return rows.withColumns({**decided, "gaia_source_id": c("id"), "hip_source_id": c("id2")}).select(*AUDIT_COLUMNS)


def with_text_ids(evidence: DataFrame) -> DataFrame:
    """Evidence as it is published: ids as text, which no reader rounds."""
    return evidence.withColumns({n: F.col(n).cast("string") for n in AUDIT_IDS})


def diagnostics(evidence: DataFrame) -> DataFrame:
    """Evidence with the derived distance measures; missing values stay NULL, never NaN."""
    c = F.col
    qualities = [finite_or_null(f"{p}_astrometry_quality") for p in ("gaia", "hip")]
    out = evidence.withColumns({"worst_quality": F.greatest(*qualities), "best_quality": F.least(*qualities), "distance_pct_diff": c("distance_frac_diff") * 100.0, "distance_abs_diff_pc": F.abs(c("gaia_r_pc") - c("hip_r_pc")), "separation_3d_pc": separation_3d_pc(c("gaia_r_pc"), c("hip_r_pc"), c("separation_arcsec"))})
    return out.withColumns({"quality_ratio": F.try_divide("worst_quality", "best_quality"), "is_clean": ~c("official_conflict") & ~c("overridden") & c("one_to_one") & finite("distance_frac_diff")})


def bin_of(value: Column, edges: tuple[float, ...], closed_end: bool) -> Column:
    """The number of the bin [edge, next edge) a value is in; NULL outside. ``closed_end``: the last edge
    belongs to the last bin; otherwise the last bin is open-ended."""
    passed = sum((F.when(value >= F.lit(float(e)), 1).otherwise(0) for e in edges[1:]), F.lit(0))
    inside = (value >= F.lit(float(edges[0]))) & ((value <= F.lit(float(edges[-1]))) if closed_end else F.lit(True))
    last = len(edges) - 2 if closed_end else len(edges) - 1
    return F.when(inside, F.least(passed, F.lit(last)))


def _with_all_bins(found: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """Counts by bin, with the empty bins; the bin table is a fixed list of a few rows."""
    return found.sparkSession.createDataFrame(rows, schema).join(found, "bin", "left")


def distance_histogram(rows: DataFrame, edges: tuple[float, ...] = HISTOGRAM_EDGES) -> DataFrame:
    """Fixed-edge histogram of the percent difference, for clean rows and for all."""
    counts = rows.groupBy(bin_of(F.col("distance_pct_diff"), edges, True).alias("bin")).agg(F.count_if("is_clean").alias("clean"), F.count(F.lit(1)).alias("n"))
    bins = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]
    zero = F.lit(0)
    return _with_all_bins(counts, bins, "bin int, bin_start_pct double, bin_end_pct double").select("bin_start_pct", "bin_end_pct", F.coalesce("clean", zero).alias("clean_auto_eligible_count"), F.coalesce("n", zero).alias("all_candidate_count"))


def quality_summary(rows: DataFrame, edges: tuple[float, ...] = QUALITY_EDGES) -> DataFrame:
    """Counts and medians by the worse of both qualities; the last bin is open, empty bins have NULL medians."""
    f = F.col("distance_frac_diff")
    clean = rows.where("is_clean").withColumn("bin", bin_of(F.col("worst_quality"), edges, False))
    counts = clean.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.count_if(f <= 0.10).alias("le10"), F.count_if((f > 0.10) & (f <= 0.25)).alias("le25"), F.count_if(f > 0.25).alias("gt25"))
    medians = quantiles_by(clean, ["bin"], {"median_distance_pct": F.col("distance_pct_diff"), "median_gaia_quality": F.col("gaia_astrometry_quality"), "median_hip_quality": F.col("hip_astrometry_quality")}, (0.5,))
    one = lambda n: F.max(F.when(F.col("measure") == n, F.col("value"))).alias(n)
    counts = counts.join(medians.groupBy("bin").agg(*map(one, ("median_distance_pct", "median_gaia_quality", "median_hip_quality"))), "bin", "left")
    labels = [f"{a:g}-{b:g}" for a, b in zip(edges[:-1], edges[1:], strict=True)] + [f">={edges[-1]:g}"]
    out = _with_all_bins(counts, list(enumerate(labels)), "bin int, worst_quality_bin string")
    zero = F.lit(0)
    return out.select("worst_quality_bin", *[F.coalesce(c, zero).alias(n) for c, n in (("n", "n_rows"), ("le10", "distance_pct_le_10"), ("le25", "distance_pct_10_to_25"), ("gt25", "distance_pct_gt_25"))], "median_distance_pct", "median_gaia_quality", "median_hip_quality")


def policy_table(rows: DataFrame, frac: float = LIMITS.auto_frac) -> DataFrame:
    """What each acceptance policy would match among clean rows: one pass, one row per policy."""
    tight, far = F.col("within_auto_thresholds"), F.col("distance_frac_diff")
    policies = {"tight sky/mag only": tight, f"tight or distance <= {frac:.0%}": tight | (far <= frac), "tight or distance <= 25%": tight | (far <= 0.25), "broad clean one-to-one": F.lit(True)}
    one = rows.where("is_clean").agg(F.count(F.lit(1)).alias("total"), *[x for i, p in enumerate(policies.values()) for x in (F.count_if(p).alias(f"m{i}"), F.count_if(p & ~tight).alias(f"a{i}"))])
    cells = F.array(*[F.struct(F.lit(n).alias("policy"), F.col(f"m{i}").alias("matched"), F.col(f"a{i}").alias("added")) for i, n in enumerate(policies)])
    return one.select("total", F.explode(cells).alias("p")).select("p.policy", F.col("p.matched").alias("matched_clean_count"), (F.col("p.matched") - F.col("total")).alias("delta_vs_broad_scan_policy"), F.col("p.added").alias("non_tight_added"))


def exact_quantiles(rows: DataFrame, column: str, at: tuple[float, ...] = QUANTILES) -> DataFrame:
    """(quantile, value), linear between ranks, over finite values; NULL where there are none."""
    found = quantiles_by(rows, [], {column: F.col(column)}, at)
    asked = rows.sparkSession.createDataFrame([(float(q),) for q in at], "quantile double")
    return asked.join(found.select("quantile", "value"), "quantile", "left")


def empirical_cdf(rows: DataFrame, column: str, by: str) -> DataFrame:
    """Share of rows at or below each distinct value, per group: counts first, then a running sum over them."""
    counts = rows.where(finite(column)).groupBy(by, column).agg(F.count(F.lit(1)).alias("n"))
    upto, whole = Window.partitionBy(by).orderBy(column), Window.partitionBy(by)
    return counts.select(by, column, (F.sum("n").over(upto) / F.sum("n").over(whole)).alias("cdf"))


def scatter_categories(rows: DataFrame) -> DataFrame:
    """Disjoint display classes of the quality plot, with counts and the log-log correlation."""
    kind = F.when(F.col("overridden"), "overridden").when(F.col("official_conflict"), "official conflict").when(~F.col("one_to_one"), "ambiguous").otherwise("clean")
    pos = rows.where((F.col("distance_pct_diff") > 0) & (F.col("worst_quality") > 0))
    return pos.groupBy(kind.alias("category")).agg(F.count(F.lit(1)).alias("n"), F.corr(F.log10("worst_quality"), F.log10("distance_pct_diff")).alias("log_correlation"))


def with_external_distance(sources: DataFrame, distances: DataFrame, least: float = 0.0) -> DataFrame:
    """Sources with the distance another table has for them, where that is finite and above ``least``: the eligible ones."""
    eligible = distances.where(finite("external_r_pc") & (F.col("external_r_pc") > least)).groupBy("source_id").agg(F.min("external_r_pc").alias("external_r_pc"))
    return sources.join(eligible, "source_id")
