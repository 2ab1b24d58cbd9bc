"""All pairs of two point sets within an angle, as an equi-join.

The unit sphere is cut by a 3-D grid whose cells are a few radii wide. Each primary point has one
cell; each secondary point is repeated into the one to eight cells its cone can touch. Equal cells
join, and the exact chord decides. A pair appears at most once because the primary point has one
cell. Seams and poles need no rule. Catalyst picks the join by the sides' sizes; nothing is forced.

Defined results: points without finite coordinates join nothing; the limit is inclusive; an empty
side gives no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starweave.functions.geometry import arcsec_of_chord2, chord2, chord_of_arcsec, grid_cell, unit_vector
from starweave.functions.numeric import finite

CELL_RADII = 4.0
AXES = ("x", "y", "z")
CELLS = ("cx", "cy", "cz")


def with_unit_vector(df: DataFrame, ra: str, dec: str) -> DataFrame:
    """Rows that have a place, with their unit vector."""
    x, y, z = unit_vector(F.col(ra), F.col(dec))
    return df.where(finite(ra) & finite(dec)).withColumns({"x": x, "y": y, "z": z})


def cone_pairs(primary: DataFrame, secondary: DataFrame, radius_arcsec: float) -> DataFrame:
    """All columns of both sides but the unit vectors, and sep_arcsec.

    Both sides: x, y, z and what is to be carried along, under different names. Carrying the measures
    through the join saves joining them to the pairs afterwards."""
    radius = chord_of_arcsec(radius_arcsec)
    edge = CELL_RADII * radius
    left = primary.select("*", *[c.alias(n) for c, n in zip(grid_cell(*map(F.col, AXES), edge), CELLS, strict=True)])
    right = secondary.withColumnsRenamed({a: f"{a}2" for a in AXES})
    for axis, cell in zip(AXES, CELLS, strict=True):
        v = F.col(f"{axis}2")
        span: list[Column] = grid_cell(v - radius, v + radius, v, edge)[:2]
        right = right.withColumn(cell, F.explode(F.sequence(*span)))
    d2 = chord2(tuple(map(F.col, AXES)), tuple(F.col(f"{a}2") for a in AXES))
    near = left.join(right, list(CELLS)).where(d2 <= F.lit(radius * radius)).withColumn("sep_arcsec", arcsec_of_chord2(d2))
    return near.drop(*CELLS, *AXES, *[f"{a}2" for a in AXES])
