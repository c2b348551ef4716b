"""Numeric column helpers shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed multipliers of the id hash (Lehmer-type generators).
HASH_M1, HASH_M2, HASH_M3 = 48271, 69621, 40692
HASH_P1, HASH_P2, HASH_P3 = 2147483647, 2147483399, 65521


def half_even(c: Column, decimals: int = 0) -> Column:
    """Round half to even on the binary value, as array libraries do."""
    if decimals == 0:
        return F.rint(c)
    scale = float(10**decimals)
    return F.rint(c * scale) / scale


def id_hash(id_col: Column, seed: int) -> Column:
    """Order-free pseudo random integer in [0, 2147483399) from a row id."""
    ident = F.pmod(id_col.cast("long"), F.lit(HASH_P1))
    h = F.pmod(ident * HASH_M1 + F.lit(seed % 65536) * 16807 + 11, F.lit(HASH_P1))
    h = F.pmod(h * HASH_M2 + F.pmod(id_col.cast("long"), F.lit(HASH_P3)) * 7919 + 7, F.lit(HASH_P1))
    return F.pmod(h * HASH_M3 + F.pmod(id_col.cast("long"), F.lit(HASH_P3)), F.lit(HASH_P2))


def id_uniform(id_col: Column, seed: int) -> Column:
    """Uniform (0, 1) number derived from a row id; same on every run and partitioning."""
    return (id_hash(id_col, seed) + 0.5) / float(HASH_P2)


def id_normal(id_col: Column, seed: int) -> Column:
    """Standard normal number from two id-derived uniforms."""
    u1, u2 = id_uniform(id_col, seed), id_uniform(id_col, seed + 7717)
    return F.sqrt(-2.0 * F.log(u1)) * F.cos(2.0 * F.pi() * u2)
