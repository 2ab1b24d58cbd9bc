"""Exact quantiles of large groups, without any group in one task.

Equal values are counted first. The distinct values are range-partitioned; counts per group and range
give the rank at which each range begins, ranks inside a range come from a window over that range of one group,
and only the rows that hold a wanted rank go on. A group's size only decides how many ranges it fills.

Defined results: NULL, NaN and infinite values do not count; a group without values has no rows; between
two ranks the value is linear; ties take part with their number.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starweave.functions.numeric import finite
from starweave.session import materialise


def quantiles_by(rows: DataFrame, by: list[str], measures: dict[str, Column], at: tuple[float, ...]) -> DataFrame:
    """(by, measure, quantile, value) for each of ``measures`` and each quantile in ``at``."""
    stacked = F.array(*[F.struct(F.lit(n).alias("measure"), c.cast("double").alias("value")) for n, c in measures.items()])
    long = rows.select(*by, F.explode(stacked).alias("m")).select(*by, "m.measure", "m.value").where(finite("value"))
    group = [*by, "measure"]
    counted = long.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("n"))
    ranged = materialise(counted.repartitionByRange("value").withColumn("range", F.spark_partition_id()))
    before, whole = Window.partitionBy(*group).orderBy("range"), Window.partitionBy(*group)
    starts = ranged.groupBy(*group, "range").agg(F.sum("n").alias("held"))  # a row per group and range
    starts = starts.select(*group, "range", (F.sum("held").over(before) - F.col("held")).alias("start"), F.sum("held").over(whole).alias("total"))
    keys = [*group, "range"]
    starts = starts.withColumnsRenamed({c: f"_{c}" for c in keys})
    # groups may be NULL, which plain equality never joins
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
    joined = ranged.join(starts, same).drop(*[f"_{c}" for c in keys])
    upto = F.col("start") + F.sum("n").over(Window.partitionBy(*group, "range").orderBy("value"))
    ranked = joined.withColumn("upto", upto).withColumn("first", F.col("upto") - F.col("n"))
    place = lambda q: F.lit(float(q)) * (F.col("total") - 1)
    wanted = F.array(*[F.struct(F.lit(float(q)).alias("quantile"), F.floor(place(q)).alias("low"), F.ceil(place(q)).alias("high"), (place(q) - F.floor(place(q))).alias("share")) for q in at])
    inside = lambda k: (k >= F.col("first")) & (k < F.col("upto"))
    hit = ranked.select(*group, "value", "first", "upto", F.explode(F.filter(wanted, lambda w: inside(w["low"]) | inside(w["high"]))).alias("w"))
    ends = hit.groupBy(*group, F.col("w.quantile").alias("quantile")).agg(F.max(F.when(inside(F.col("w.low")), F.col("value"))).alias("low"), F.max(F.when(inside(F.col("w.high")), F.col("value"))).alias("high"), F.max("w.share").alias("share"))
    return ends.select(*group, "quantile", (F.col("low") * (1 - F.col("share")) + F.col("high") * F.col("share")).alias("value"))
