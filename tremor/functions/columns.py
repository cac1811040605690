"""Small column expressions used across the operators.

All of them are plain Spark SQL expressions, so they stay inside whole-stage
codegen.  ANSI mode is assumed on: divisions go through ``try_divide``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_double(c: Column | str) -> Column:
    """Numeric coercion: junk -> NULL, and NaN -> NULL (``pd.to_numeric(errors='coerce')``).

    ``try_cast`` keeps the strings ``nan`` / ``Infinity`` as NaN / inf; NaN is
    folded to NULL so that no NaN gets past the scan.  Infinity stays.
    """
    col = F.col(c) if isinstance(c, str) else c
    v = col.try_cast("double")
    return nan_to_null(v)


def nan_to_null(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)


# exact powers of ten 1e0 .. 1e22 (every one is a double without rounding)
_POW10 = [float(f"1e{i}") for i in range(23)]
# decimal scale tables for sig(): 10^-e and 10^e for e = -30 .. 30, parsed
# from their decimal literals (both engines parse them to the same doubles)
SIG_E = 30
_DOWN = [float(f"1e{-e}") for e in range(-SIG_E, SIG_E + 1)]
_UP = [float(f"1e{e}") for e in range(-SIG_E, SIG_E + 1)]


def pow10(k: Column) -> Column:
    """10 ** k for an integer column 0 <= k, exact up to 1e22 (a literal lookup)."""
    return F.coalesce(F.element_at(F.array(*[F.lit(v) for v in _POW10]), k + 1),
                      F.pow(F.lit(10.0), k))


# from here on every double is an integer: nothing is left to round
WHOLE = 9007199254740992.0


def round_half_away(c: Column, decimals: int) -> Column:
    """Round half away from zero with plain double arithmetic (no BigDecimal):
    sign(x) * floor(|x| * 10^d + 0.5) / 10^d; -0.0 becomes 0.0.  A value whose
    scaled form is a whole number anyway passes unchanged (``floor`` gives a
    long, which would saturate)."""
    q = F.lit(_POW10[decimals])
    scaled = F.abs(c) * q
    return F.when(scaled >= F.lit(WHOLE), c).otherwise(F.signum(c) * F.floor(scaled + F.lit(0.5)) / q) + F.lit(0.0)


def sig(c: Column | str, digits: int = 9) -> Column:
    """Round to ``digits`` significant digits; NULL, 0, NaN, +-inf and values
    beyond 1e+-30 pass through unchanged.

    Used to make doubles from two engines hash alike; the oracle SQL spells
    the same formula: x * 10^-e, rounded half away from zero to digits - 1
    decimals, times 10^e, with the scale factors taken from literal tables
    (the same doubles in both engines).  The expression is small, so wide
    results stay inside whole-stage code generation.
    """
    col = F.col(c) if isinstance(c, str) else c
    e = F.floor(F.log10(F.abs(col)))
    i = (F.greatest(F.least(e, F.lit(SIG_E)), F.lit(-SIG_E)) + F.lit(SIG_E)).cast("int")
    # get(): 0-based, NULL out of range, no error path (small generated code)
    down = F.get(F.array(*[F.lit(v) for v in _DOWN]), i)
    up = F.get(F.array(*[F.lit(v) for v in _UP]), i)
    rounded = round_half_away(col * down, digits - 1) * up
    ok = (col != 0) & ~F.isnan(col) & (F.abs(col) <= F.lit(float(f"1e{SIG_E}"))) \
        & (F.abs(col) >= F.lit(float(f"1e{-SIG_E}")))
    return F.when(ok, rounded).otherwise(col)


def fitted(one_row: DataFrame) -> Column:
    """A one-row table (fitted statistics) as a struct-valued scalar subquery.

    Spark evaluates it once per query and ships the row to the tasks; every
    field reference reuses the same subquery.  No join is involved.
    """
    return one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns]).alias("__fit")).scalar()


def safe_corr(a: Column | str, b: Column | str) -> Column:
    """Pearson r over pairwise-complete rows; NULL (not an ANSI error) for a constant."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    both = a.isNotNull() & b.isNotNull()
    aa = F.when(both, a)
    bb = F.when(both, b)
    return F.try_divide(F.covar_pop(aa, bb), F.stddev_pop(aa) * F.stddev_pop(bb))


def _hash_hex(cols: Sequence[Column | str], seed: int) -> Column:
    parts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def hash_bigint(cols: Sequence[Column | str], seed: int = 42) -> Column:
    """Deterministic 60-bit non-negative integer from md5 (same value in DuckDB)."""
    return F.conv(F.substring(_hash_hex(cols, seed), 1, 15), 16, 10).cast("bigint")


def hash_unit(cols: Sequence[Column | str], seed: int = 42) -> Column:
    """Deterministic uniform number in [0, 1) from md5 of the columns and a seed."""
    return hash_bigint(cols, seed) / F.lit(float(1 << 60))
