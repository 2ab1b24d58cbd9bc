"""Review cohorts: top-k selections, quality flags, roll-up per source and cross-match context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starweave.functions.geometry import distance_pc, parallax_frac_error_abs
from starweave.functions.numeric import finite, finite_or_null

COHORT_SIZE = 500
#: Fixed order of cohorts; it settles equal ranks.
COHORTS = ("brightest", "nearest", "high_pm")
GOOD_SOLUTIONS, GOOD_HIP_SOLUTION = (31, 95), 5
STEADY = ("", "NOT_AVAILABLE", "NAN")


def top_cohort(df: DataFrame, cohort: str, metric: str, ascending: bool, size: int = COHORT_SIZE) -> DataFrame:
    """The ``size`` first rows by a finite metric, ids settling ties, with cohort and cohort_rank.

    ``orderBy().limit()`` is a top-k per partition, so only ``size`` rows reach the ranking window."""
    order = [F.col(metric).asc() if ascending else F.col(metric).desc(), F.col("id").asc()]
    top = df.where(finite(metric)).orderBy(*order).limit(size)
    return top.select("*", F.lit(cohort).alias("cohort"), F.row_number().over(Window.orderBy(*order)).alias("cohort_rank"))


def top_cohorts(df: DataFrame, kinds: tuple[tuple[str, str, bool], ...], size: int = COHORT_SIZE, salts: int = 64) -> DataFrame:
    """Several cohorts in one pass over ``df``: (name, metric, ascending) each, with cohort and cohort_rank.

    A nearest cohort takes positive parallaxes only. Ranks are cut off per salt first, so a task that ranks a whole cohort
    gets ``size`` rows per salt at most."""
    keys = []
    for name, metric, ascending in kinds:
        value = F.col(metric).cast("double")
        fit = finite(metric) & (value > 0) if name == "nearest" else finite(metric)
        keys.append(F.struct(F.lit(name).alias("cohort"), F.when(fit, value if ascending else -value).alias("order")))
    rows = df.withColumn("_k", F.explode(F.filter(F.array(*keys), lambda k: k["order"].isNotNull()))).withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    rows = rows.select("*", F.col("_k.cohort").alias("cohort"), F.col("_k.order").alias("_order"))
    for within in (["cohort", "_salt"], ["cohort"]):
        rows = rows.withColumn("cohort_rank", F.row_number().over(Window.partitionBy(*within).orderBy("_order", "id"))).where(F.col("cohort_rank") <= size)
    return rows.drop("_k", "_salt", "_order")


def joined(flags: list[tuple[str, Column]]) -> Column:
    """``;``-joined names of the conditions that hold, in their order; NULL conditions do not hold."""
    return F.array_join(F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in flags])), ";")


def survey_flags(have: set[str]) -> Column:
    """Quality flags of survey rows; a column the table lacks raises no flag."""
    f = lambda c: finite_or_null(c) if c in have else F.lit(None).cast("double")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in have else F.lit(False)
    variable = ~F.upper("phot_variable_flag").isin(*STEADY) if "phot_variable_flag" in have else F.lit(False)
    return joined([
        ("ruwe_gt_1p4", f("ruwe") > 1.4), ("parallax_frac_error_gt_0p1", F.col("parallax_frac_error") > 0.1), ("non_positive_parallax", f("parallax") <= 0),
        ("astrometric_params_not_31_or_95", ~f("astrometric_params_solved").cast("int").isin(*GOOD_SOLUTIONS)), ("visibility_periods_lt_8", f("visibility_periods_used") < 8),
        ("astrometric_excess_noise_gt_1", f("astrometric_excess_noise") > 1.0), ("ipd_frac_multi_peak_gt_10", f("ipd_frac_multi_peak") > 10), ("duplicated_source", yes("duplicated_source")),
        ("non_single_star", f("non_single_star").cast("int") != 0), ("missing_bp_or_rp", f("phot_bp_mean_mag").isNull() | f("phot_rp_mean_mag").isNull()), ("phot_variable", variable),
    ])


def catalogue_flags(have: set[str]) -> Column:
    component = (F.trim("n_hip") != "") if "n_hip" in have else F.lit(False)
    return joined([("parallax_frac_error_gt_0p1", F.col("parallax_frac_error") > 0.1), ("non_positive_parallax", F.col("parallax") <= 0), ("hip_solution_type_not_5", F.col("sn") != GOOD_HIP_SOLUTION), ("hip_component_flag", component)])


def flag_count(flags: Column) -> Column:
    return F.size(F.filter(F.split(flags, ";"), lambda x: x != ""))


def with_quality(df: DataFrame, flags) -> DataFrame:
    """Derived distance, fractional error, proper motion and flags. ``flags``: one of the two lists above."""
    have = set(df.columns)
    motion = F.hypot("pmra", "pmdec") if {"pmra", "pmdec"} <= have else F.lit(None).cast("double")
    df = df.withColumns({"r_pc_parallax": distance_pc(F.col("parallax")), "parallax_frac_error": parallax_frac_error_abs(F.col("parallax"), F.col("parallax_error")), "pm_total_masyr": motion})
    df = df.withColumn("quality_flags", flags(have))
    return df.withColumn("quality_flag_count", flag_count(F.col("quality_flags")))


def roll_up(cohorts: DataFrame, keep: list[str]) -> DataFrame:
    """One row per id: values of its best rank, cohorts and ``cohort:rank`` in rank order.

    The input holds a few cohorts of bounded size, so the lists per id are short."""
    place = F.array_position(F.array(*map(F.lit, COHORTS)), F.col("cohort"))
    order = F.struct(F.col("cohort_rank").alias("r"), place.alias("o"), F.col("cohort").alias("c"))
    rolled = cohorts.groupBy("id").agg(F.array_sort(F.collect_list(order)).alias("all"), *[F.min_by(c, F.struct("cohort_rank", place)).alias(c) for c in keep])
    names = F.transform("all", lambda x: x["c"])
    ranks = F.transform("all", lambda x: F.concat(x["c"], F.lit(":"), x["r"].cast("string")))
    return rolled.select("id", *keep, F.array_join(F.array_distinct(names), ";").alias("cohorts"), F.array_join(F.array_distinct(ranks), ";").alias("cohort_ranks"))


def id_list(pairs: DataFrame, key: str, value: str, name: str, wanted: DataFrame) -> DataFrame:
    """(id, name): the distinct partners of each wanted id, in number order, ``;``-joined."""
    rows = pairs.select(F.col(key).alias("id"), F.col(value).alias("v")).join(wanted.select("id").distinct(), "id", "left_semi").distinct()
    text = F.transform(F.array_sort(F.collect_list("v")), lambda x: x.cast("string"))
    return rows.groupBy("id").agg(F.array_join(text, ";").alias(name))


def merged_lists(*lists: Column) -> Column:
    """Several ``;`` lists in one: trimmed, without empty parts, first places kept."""
    parts = [F.transform(F.split(F.coalesce(x, F.lit("")), ";"), lambda part: F.trim(part)) for x in lists]
    return F.array_join(F.array_distinct(F.filter(F.concat(*parts), lambda x: x != "")), ";")


def with_context(candidates: DataFrame, key: str, value: str, official: DataFrame, supplemental: DataFrame, neighbourhood: DataFrame) -> DataFrame:
    """Partner ids in the official map, the supplemental map and the neighbourhood, with flags.

    ``candidates``: a written table, as each lookup reads them again to keep only the wanted ids."""
    wanted = candidates
    for pairs, name in ((official, "official_ids"), (supplemental, "supplemental_ids"), (neighbourhood, "official_neighbourhood_ids")):
        candidates = candidates.join(id_list(pairs, key, value, name, wanted), "id", "left").withColumn(name, F.coalesce(name, F.lit("")))
    both = merged_lists(F.col("official_ids"), F.col("supplemental_ids"))
    candidates = candidates.withColumn("counterpart_ids", both)
    return candidates.withColumns({"has_official_best_neighbour": F.col("official_ids") != "", "has_fis_supplemental_match": F.col("supplemental_ids") != "", "has_any_gaia_hip_match": F.col("counterpart_ids") != ""})


def flag_counts(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """How many rows carry each flag."""
    rows = df.select(*(by or []), F.explode(F.split(F.coalesce("quality_flags", F.lit("")), ";")).alias("flag")).where("flag <> ''")
    return rows.groupBy(*(by or []), "flag").agg(F.count(F.lit(1)).alias("n"))


def linked_pairs(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs with both ends among the candidates."""
    g, h = left.select(F.col("id").alias("gaia_source_id")).distinct(), right.select(F.col("id").alias("hip_source_id")).distinct()
    return pairs.select("gaia_source_id", "hip_source_id").join(g, "gaia_source_id", "left_semi").join(h, "hip_source_id", "left_semi").distinct()
