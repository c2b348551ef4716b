"""Forest mensuration formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arborframe.functions.numeric import half_even

# Fixed coefficients of the under-bark diameter model.
BARK_A, BARK_B, BARK_C = 0.7016, 0.5646, -0.6188


def under_bark(diameter: Column, height: Column, dbh_height: float) -> Column:
    z = (height - dbh_height) / height
    return diameter * F.sqrt(F.lit(BARK_A) + BARK_B * z + BARK_C * z * z)


def frustum(d1: Column, d2: Column, length: Column) -> Column:
    return F.pi() / 12.0 * length * (d1 * d1 + d2 * d2 + d1 * d2)


def cone_over_cylinder(dbh: Column, height: Column, dbh_bin: Column) -> Column:
    return F.pi() * dbh * dbh / 4.0 * ((height - dbh_bin) / 3.0 + dbh_bin)


def qc_cone_volume(dbh_mm: Column, height: Column, dbh_height: Column) -> Column:
    return half_even(cone_over_cylinder(dbh_mm / 1000.0, height, dbh_height), 2)


def metres_to_mm(c: Column) -> Column:
    return F.rint(c * 1000.0)


def cm_to_mm(c: Column) -> Column:
    return c * 10.0
