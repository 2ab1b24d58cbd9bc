"""Sphere geometry on doubles, as Catalyst expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from starweave.functions.numeric import finite, finite_or_null

#: The two catalogue epochs (Julian years) and the unit conversion.
EPOCH_SECONDARY = 1991.25
EPOCH_PRIMARY = 2016.0
MAS_TO_RAD = math.pi / (180.0 * 3600.0 * 1000.0)


def chord_of_arcsec(arcsec: float) -> float:
    """Straight-line distance between two unit vectors that are ``arcsec`` apart."""
    return 2.0 * math.sin(math.radians(arcsec / 3600.0) / 2.0)


def unit_vector(ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    a, d = F.radians(ra), F.radians(dec)
    return F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)


def arcsec_of_chord2(chord2: Column) -> Column:
    """Great-circle separation from the squared chord; exact at small angles, unlike arccos."""
    return F.degrees(F.lit(2.0) * F.asin(F.least(F.sqrt(chord2) / 2.0, F.lit(1.0)))) * 3600.0


def chord2(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]) -> Column:
    parts = [(p - q) * (p - q) for p, q in zip(a, b, strict=True)]
    return parts[0] + parts[1] + parts[2]


def separation_arcsec(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    return arcsec_of_chord2(chord2(unit_vector(ra1, dec1), unit_vector(ra2, dec2)))


def propagated(ra: Column, dec: Column, pmra: Column, pmdec: Column, years: float) -> tuple[Column, Column]:
    """Position after ``years`` of proper motion (mas/yr, right ascension scaled by cos dec).

    The unit vector moves along its two tangent vectors; the result needs no normalising because
    only angles are taken from it."""
    a, d = F.radians(ra), F.radians(dec)
    east, north = pmra * (MAS_TO_RAD * years), pmdec * (MAS_TO_RAD * years)
    x = F.cos(d) * F.cos(a) - east * F.sin(a) - north * F.cos(a) * F.sin(d)
    y = F.cos(d) * F.sin(a) + east * F.cos(a) - north * F.sin(a) * F.sin(d)
    z = F.sin(d) + north * F.cos(d)
    return F.pmod(F.degrees(F.atan2(y, x)), F.lit(360.0)), F.degrees(F.atan2(z, F.hypot(x, y)))


def distance_pc(parallax: Column) -> Column:
    """1000 / parallax for a finite positive parallax, else NULL."""
    p = finite_or_null(parallax)
    return F.when(p > 0, F.lit(1000.0) / p)


def parallax_frac_error(parallax: Column, error: Column) -> Column:
    """abs(error / parallax), NULL where the parallax is not positive (match evidence)."""
    p, e = finite_or_null(parallax), finite_or_null(error)
    return F.when(p > 0, F.abs(e / p))


def parallax_frac_error_abs(parallax: Column, error: Column) -> Column:
    """abs(error) / abs(parallax): a negative parallax keeps a value (review cohorts)."""
    p, e = finite_or_null(parallax), finite_or_null(error)
    return F.when(p != 0, F.abs(e) / F.abs(p))


def separation_3d_pc(r1: Column, r2: Column, sep_arcsec: Column) -> Column:
    """Distance between two bodies by the law of cosines, never below 0; NULL if any part is missing."""
    a, b = finite_or_null(r1), finite_or_null(r2)
    cos = F.cos(F.radians(finite_or_null(sep_arcsec) / 3600.0))
    square = a * a + b * b - 2.0 * a * b * cos
    return F.when(square.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), square)))  # greatest() would pass over a NULL


def apparent_magnitude(absolute: Column, r_pc: Column) -> Column:
    return finite_or_null(absolute) + 5.0 * F.log10(F.when(finite(r_pc) & (r_pc > 0), r_pc)) - 5.0


def grid_cell(x: Column, y: Column, z: Column, edge: float) -> list[Column]:
    """Integer cell of a 3-D grid; neighbours in space never need a wrap or pole rule."""
    return [F.floor(v / F.lit(edge)).cast("int") for v in (x, y, z)]
