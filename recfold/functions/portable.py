"""Expressions that give the same answer in Spark and in a plain SQL engine.

The seeded hash replaces NumPy permutations (which no engine can replay): it
uses BIGINT arithmetic with non-negative terms only, so Spark and DuckDB agree
bit for bit, and it is a pure function of the row, so a recomputed task after
an executor loss draws exactly the same values.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the portable hash (a Lehmer-style mix modulo 2^31 - 1).
_P = 2147483647
_A = 1000003
_B = 7919
_S = 104729
_C = 12345
_M1 = 48271
_M2 = 69621


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def portable_hash(a: str | Column, b: str | Column | int = 0, seed: int = 42) -> Column:
    """Deterministic BIGINT hash of two ids and a seed. Ids are reduced modulo
    P first, so that no product overflows."""
    a_ = F.pmod(_col(a).cast("bigint"), F.lit(_P).cast("bigint"))
    b_ = F.lit(b % _P).cast("bigint") if isinstance(b, int) else F.pmod(_col(b).cast("bigint"), F.lit(_P).cast("bigint"))
    x = (a_ * _A + b_ * _B + F.lit(seed * _S + _C)) % _P
    x = (x * _M1) % _P
    return ((x + b_) * _M2) % _P


def portable_hash_sql(a: str, b: str | int = 0, seed: int = 42) -> str:
    """The same hash as SQL text (for the DuckDB oracles)."""
    a_, b_ = (f"((CAST({v} AS BIGINT) % {_P} + {_P}) % {_P})" for v in (a, b))
    x = f"(({a_} * {_A} + {b_} * {_B} + {seed * _S + _C}) % {_P})"
    x = f"(({x} * {_M1}) % {_P})"
    return f"((({x} + {b_}) * {_M2}) % {_P})"


def clip(c: str | Column, lo: float = 1.0, hi: float = 5.0) -> Column:
    return F.least(F.greatest(_col(c), F.lit(float(lo))), F.lit(float(hi)))


def require_columns(df, required: Iterable[str], what: str = "DataFrame") -> None:
    """Raise when required columns are missing (plan-time check)."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")


def validate_ratios(*ratios: float, tol: float = 1e-6) -> None:
    """Split ratios must sum to 1 within ``tol``."""
    total = sum(ratios)
    if abs(total - 1.0) > tol:
        raise ValueError(f"Ratios must sum to 1.0, got {total}")


def sql_round(c: str | Column, digits: int) -> Column:
    """Round half away from zero on the binary value scaled by 10^digits (the
    rule SQL engines use for DOUBLE), not on the shortest decimal form as
    Spark's ``round`` does: both agree except on values whose shortest form
    ends in a 5 right after the kept digits, which rational metrics (means of
    small integers) produce often. Large or non-finite values pass through."""
    x = _col(c)
    scale = 10.0 ** digits
    big = F.abs(x) * scale >= F.lit(4503599627370496.0)  # 2^52: already integral
    r = F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / scale
    return F.when(F.isnan(x) | big, x).otherwise(r)


EXACT_SCALE = 1e12


def exact_avg(c: str | Column) -> Column:
    """Mean of non-negative per-entity metrics that is independent of the
    summation order: each value is fixed to 12 decimals as a BIGINT, the
    integers are summed exactly and divided once. Means of rationals with
    small denominators (MAP, precision) often sit exactly on a rounding half,
    where a last-bit difference between engines would change the printed
    digit; this makes every engine produce the same double. The sum is a
    128-bit integer, so it has room for any number of entities."""
    x = _col(c)
    n = F.count(x)
    s = F.sum(F.floor(x * EXACT_SCALE + 0.5).cast("bigint").cast("decimal(38,0)")).cast("double")
    return F.when(n > 0, s / n / EXACT_SCALE)


def exact_avg_sql(x: str) -> str:
    """SQL twin of ``exact_avg``."""
    return (f"(CASE WHEN count({x}) > 0 THEN sum(CAST(floor({x} * 1e12 + 0.5) AS BIGINT)) "
            f"/ count({x}) / 1e12 END)")
