"""HEALPix cell numbers in the nested scheme (Górski et al. 2005), as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _spread_bits(v: Column, order: int) -> Column:
    """Every bit of ``v`` moved to twice its place."""
    out = F.lit(0).cast("bigint")
    for b in range(order):
        out = out + F.shiftleft(F.shiftright(v, b).bitwiseAND(F.lit(1).cast("bigint")), 2 * b)
    return out


def nested_cell(ra: Column, dec: Column, order: int) -> Column:
    """The cell of a position in degrees at ``nside = 2 ** order``."""
    nside = 1 << order
    z = F.sin(F.radians(dec))
    tt = F.pmod(ra, F.lit(360.0)) / 90.0
    # equatorial belt: along the two diagonal line families
    up, down = nside * (0.5 + tt), nside * z * 0.75
    jp, jm = F.floor(up - down), F.floor(up + down)
    fp, fm = F.floor(jp / nside), F.floor(jm / nside)
    belt_face = F.when(fp == fm, F.pmod(fp, F.lit(4)) + 4).when(fp < fm, F.pmod(fp, F.lit(4))).otherwise(F.pmod(fm, F.lit(4)) + 8)
    bx = F.pmod(jm, F.lit(nside))
    by = nside - 1 - F.pmod(jp, F.lit(nside))
    # polar caps; cos(dec) keeps 1 - |z| exact near the poles
    quarter = F.least(F.floor(tt), F.lit(3))
    tp = tt - quarter
    away = F.abs(F.cos(F.radians(dec))) / F.sqrt((1.0 + F.abs(z)) / 3.0) * nside
    cp = F.least(F.floor(tp * away), F.lit(nside - 1))
    cm = F.least(F.floor((1.0 - tp) * away), F.lit(nside - 1))
    north = z >= 0
    cap_face = F.when(north, quarter).otherwise(quarter + 8)
    px = F.when(north, nside - 1 - cm).otherwise(cp)
    py = F.when(north, nside - 1 - cp).otherwise(cm)
    in_belt = F.abs(z) <= 2.0 / 3.0
    face = F.when(in_belt, belt_face).otherwise(cap_face).cast("bigint")
    x, y = F.when(in_belt, bx).otherwise(px).cast("bigint"), F.when(in_belt, by).otherwise(py).cast("bigint")
    return face * (nside * nside) + _spread_bits(x, order) + 2 * _spread_bits(y, order)
