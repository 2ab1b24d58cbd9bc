"""A polynomial between two measures of many pairs, by least squares with a gate on the residuals.

The sums of powers that the normal equations need are one aggregation per round; only these few numbers reach the driver.
Each round after the first leaves out pairs whose residual is beyond ``gate`` times the spread.

Defined results: pairs without a finite value on either side take no part; with fewer different values than
coefficients the polynomial is the mean; without pairs every coefficient is 0."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.functions.numeric import finite


@dataclass(frozen=True)
class Polynomial:
    """Coefficients from the constant on, the spread of the residuals, and how many pairs took part."""

    coefficients: tuple[float, ...]
    spread: float
    n: int

    def at(self, x: Column) -> Column:
        value = F.lit(0.0)
        for c in reversed(self.coefficients):
            value = value * x + F.lit(float(c))
        return value


def fit_polynomial(pairs: DataFrame, x: str, y: str, degree: int = 3, gate: float = 2.5, rounds: int = 3) -> Polynomial:
    rows = pairs.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where(finite("x") & finite("y"))
    found = None
    for _ in range(rounds):
        kept = rows if found is None else rows.where(F.abs(F.col("y") - found.at(F.col("x"))) <= gate * found.spread + 1e-12)
        power = lambda k: F.pow("x", F.lit(float(k)))
        sums = [F.sum(power(k)).alias(f"x{k}") for k in range(2 * degree + 1)] + [F.sum(F.col("y") * power(k)).alias(f"y{k}") for k in range(degree + 1)]
        row = kept.agg(*sums, F.sum(F.col("y") * F.col("y")).alias("yy"), F.count(F.lit(1)).alias("n")).first()
        if not row["n"]:
            return found or Polynomial((0.0,) * (degree + 1), 0.0, 0)
        moments = np.array([row[f"x{k}"] for k in range(2 * degree + 1)])
        right = np.array([row[f"y{k}"] for k in range(degree + 1)])
        left = moments[np.add.outer(np.arange(degree + 1), np.arange(degree + 1))]
        scale = np.sqrt(np.diag(left))
        if (scale > 0).all() and np.linalg.matrix_rank(left / np.outer(scale, scale)) == degree + 1:
            c = np.linalg.solve(left / np.outer(scale, scale), right / scale) / scale
        else:
            c = np.array([right[0] / row["n"]] + [0.0] * degree)
        rest = row["yy"] - 2 * c @ right + c @ left @ c
        found = Polynomial(tuple(c), float(np.sqrt(max(rest, 0.0) / row["n"])), int(row["n"]))
    return found


def with_colour_residual(pairs: DataFrame, x: str, y: str, fit: Polynomial, gate: float = 3.0) -> DataFrame:
    """Pairs with ``colour_residual`` and ``within_colour_gate``, NULL where either side is missing."""
    ok = finite(x) & finite(y)
    residual = F.when(ok, F.col(y).cast("double") - fit.at(F.col(x).cast("double")))
    return pairs.withColumn("colour_residual", residual).withColumn("within_colour_gate", F.abs("colour_residual") <= gate * fit.spread)
