"""The queries of the language-model training-data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starweave.functions.numeric import parse_id, plain_word
from starweave.llm.components import connected_components
from starweave.llm.entity_match import match_entities
from starweave.llm.leaked_passages import leaked_passages
from starweave.llm.template_residue import template_residue
from starweave.llm.tokenise_corpus import tokenise
from starweave.sources.tables import table

#: Decisions that count as a match.
MATCH_DECISIONS = ("official_confirmed", "supplemental_match", "manual_review")
#: HIP numbers carry the sign bit as graph nodes: they cannot meet a gaia id and are always the least.
SIGN = -(2**63)


#: A pair counts as one thing from this confidence on.
MATCH_CONFIDENCE = 0.5


def _matches(spark: SparkSession, sf: str) -> DataFrame:
    return match_entities(table(spark, sf, "raw_gaia"), table(spark, sf, "raw_hip"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    found = _matches(spark, sf).where(F.col("confidence") >= MATCH_CONFIDENCE)
    return found.select(F.col("id2").alias("hip_source_id"), F.col("id").alias("gaia_source_id"))


def p2_confidence(spark: SparkSession, sf: str) -> DataFrame:
    """How many candidate pairs have which confidence, in tenths."""
    tenth = F.least(F.floor(F.col("confidence") * 10), F.lit(9)).cast("int").alias("tenth")
    return _matches(spark, sf).groupBy(tenth).agg(F.count(F.lit(1)).alias("n_pairs"), F.round(F.avg("cosine"), 3).alias("mean_cosine"))


def _components(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "match_evidence").where(plain_word("decision").isin(*MATCH_DECISIONS))
    links = rows.select(parse_id("hip_source_id").bitwiseOR(F.lit(SIGN)).alias("hip"), parse_id("gaia_source_id").alias("gaia"))
    found = connected_components(links, "hip", "gaia")
    number = lambda c: F.col(c).bitwiseAND(F.lit(-SIGN - 1))
    name = F.when(F.col("node") < 0, F.lit("hip")).otherwise(F.lit("gaia"))
    return found.select(name.alias("catalog_name"), number("node").alias("source_id"), number("component").alias("group_id"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return _components(spark, sf)


def p5_group_sizes(spark: SparkSession, sf: str) -> DataFrame:
    members = _components(spark, sf).groupBy("group_id").agg(F.count_if(F.col("catalog_name") == "gaia").alias("n_gaia"), F.count_if(F.col("catalog_name") == "hip").alias("n_hip"))
    return members.groupBy("n_gaia", "n_hip").agg(F.count(F.lit(1)).alias("n_groups"))


def p6_ids(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    return tokenise(table(spark, sf, "documents"), "doc_id", "text", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def _leaks(spark: SparkSession, sf: str) -> DataFrame:
    return leaked_passages(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "eval_items").select("item_id", "item_text"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return _leaks(spark, sf).select("item_id", "doc_id")


def p7_leaks(spark: SparkSession, sf: str) -> DataFrame:
    """What leaked, per item: documents, longest passage, and documents that hold the answer too."""
    return _leaks(spark, sf).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs"), F.max("passage_words").alias("longest"), F.count_if("has_answer").alias("n_with_answer"))


def _residue(spark: SparkSession, sf: str) -> DataFrame:
    return template_residue(table(spark, sf, "documents"), "doc_id", "text")


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return _residue(spark, sf).select("doc_id")


def p8_kinds(spark: SparkSession, sf: str) -> DataFrame:
    return _residue(spark, sf).groupBy("kind").agg(F.count(F.lit(1)).alias("n_docs"), F.count_if(F.col("coverage") >= 0.5).alias("n_mostly_residue"))


QUERIES = {f.__name__: f for f in (p2_found, p2_confidence, p5_found, p5_group_sizes, p6_ids, p7_found, p7_leaks, p8_found, p8_kinds)}

_ID = "TRY_CAST(regexp_extract(regexp_replace({0}, '(?i)^\\s*gaia\\s*e?dr\\s*[0-9]+($|[^0-9])', '\\1'), '([0-9]+)[^0-9]*$', 1) AS BIGINT)"

_GROUPS = f"""
WITH RECURSIVE links AS (
  SELECT DISTINCT {_ID.format("hip_source_id")} AS h, {_ID.format("gaia_source_id")} AS g FROM match_evidence
  WHERE trim(lower(decision)) IN ('official_confirmed', 'supplemental_match', 'manual_review')),
hops AS (SELECT DISTINCT a.h AS x, b.h AS y FROM links a JOIN links b USING (g) WHERE a.h IS NOT NULL AND b.h IS NOT NULL),
reach AS (SELECT DISTINCT h AS x, h AS y FROM links WHERE h IS NOT NULL AND g IS NOT NULL UNION SELECT r.x, s.y FROM reach r JOIN hops s ON r.y = s.x),
least AS (SELECT x AS h, min(y) AS group_id FROM reach GROUP BY 1),
members AS (
  SELECT 'hip' AS catalog_name, h AS source_id, group_id FROM least
  UNION SELECT 'gaia', g, group_id FROM links JOIN least USING (h) WHERE g IS NOT NULL)
"""

ORACLES = {
    "p5_found": _GROUPS + "SELECT * FROM members",
    "p5_group_sizes": _GROUPS + """SELECT n_gaia, n_hip, count(*) AS n_groups FROM (
      SELECT group_id, count(*) FILTER (catalog_name = 'gaia') AS n_gaia, count(*) FILTER (catalog_name = 'hip') AS n_hip FROM members GROUP BY 1) GROUP BY ALL""",
}
