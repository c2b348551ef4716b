"""Small text helpers for the DuckDB side of the checks."""

from __future__ import annotations

from arborframe.fixtures import duck_ctes

PI = "pi()"


def even(expr: str, decimals: int = 0) -> str:
    """Half-even rounding with the same arithmetic as ``half_even``."""
    if decimals == 0:
        return f"round_even({expr}, 0)"
    scale = f"CAST({10**decimals} AS DOUBLE)"
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"


def fx(*names: str) -> str:
    return duck_ctes(*names) + "\n"


def hash_sql(ident: str, seed: int) -> str:
    p1, p2, p3 = 2147483647, 2147483399, 65521
    i = f"({ident} % {p1})"
    h = f"(({i} * 48271 + {(seed % 65536) * 16807} + 11) % {p1})"
    h = f"(({h} * 69621 + ({ident} % {p3}) * 7919 + 7) % {p1})"
    return f"(({h} * 40692 + ({ident} % {p3})) % {p2})"


def uniform_sql(ident: str, seed: int) -> str:
    return f"((CAST({hash_sql(ident, seed)} AS DOUBLE) + 0.5) / CAST(2147483399 AS DOUBLE))"


def normal_sql(ident: str, seed: int) -> str:
    return f"(sqrt(-2.0 * ln({uniform_sql(ident, seed)})) * cos(2.0 * pi() * {uniform_sql(ident, seed + 7717)}))"
