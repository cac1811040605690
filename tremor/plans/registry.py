"""Query registry: each entry pairs a Spark query with its DuckDB twin.

A Spark query is ``fn(spark, sf_dir) -> DataFrame``; every double column of
its result is rounded to ``DIGITS`` significant digits so that two engines'
last-bit differences do not change the hash.  The oracle SQL names the
double columns to round the same way (``dbl``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.functions import sig
from tremor.functions.columns import WHOLE, round_half_away

DIGITS = 9
ABS_DECIMALS = 9


@dataclass
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    dbl: Sequence[str] = field(default_factory=tuple)
    note: str = ""
    # dimensionless columns whose true value may be 0: rounded to ABS_DECIMALS
    # decimals (absolute) instead of significant digits
    absr: Sequence[str] = field(default_factory=tuple)
    digits: int = DIGITS


REGISTRY: dict[str, Entry] = {}


def sql_round(expr: str, decimals: int) -> str:
    """DuckDB spelling of :func:`tremor.functions.columns.round_half_away`."""
    q = f"1e{decimals}"
    return (f"(CASE WHEN abs({expr}) * {q} >= {WHOLE} THEN {expr} "
            f"ELSE sign({expr}) * floor(abs({expr}) * {q} + 0.5) / {q} END + 0.0)")


_E = 30
_DOWN_SQL = "(CAST([" + ", ".join(f"1e{-e}" for e in range(-_E, _E + 1)) + "] AS DOUBLE[]))"
_UP_SQL = "(CAST([" + ", ".join(f"1e{e}" for e in range(-_E, _E + 1)) + "] AS DOUBLE[]))"


def sql_sig(expr: str, digits: int = DIGITS) -> str:
    """DuckDB spelling of :func:`tremor.functions.sig`."""
    x = f"({expr})"
    i = f"CAST(greatest(least(floor(log10(abs({x}))), {_E}), -{_E}) + {_E + 1} AS INTEGER)"
    return (
        f"CASE WHEN {x} IS NULL OR {x} = 0 OR isnan({x}) OR abs({x}) > 1e{_E} OR abs({x}) < 1e-{_E} THEN {x} "
        f"ELSE {sql_round(f'{x} * {_DOWN_SQL}[{i}]', digits - 1)} * {_UP_SQL}[{i}] END"
    )


def rounded_sql(inner: str, dbl: Sequence[str], absr: Sequence[str] = (), digits: int = DIGITS) -> str:
    if not dbl:
        return inner
    repl = ", ".join((f"{sql_round(c, ABS_DECIMALS)} AS {c}" if c in absr else f"{sql_sig(c, digits)} AS {c}")
                     for c in dbl)
    return f"SELECT * REPLACE ({repl}) FROM (\n{inner}\n) AS _q"


WIDE = 16


def round_doubles(df: DataFrame, digits: int = DIGITS, absr: Sequence[str] = ()) -> DataFrame:
    """Round every double column (``absr`` ones to fixed decimals).

    With more than ``WIDE`` double columns the rounding runs inside one
    ``transform`` over an array of the values: inline expressions for dozens
    of columns would make the generated method of a fused aggregate too large
    for the JVM, and the whole stage would fall back to interpreted mode.
    """
    fields = df.schema.fields
    dbl = [f.name for f in fields if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in absr]
    if len(dbl) <= WIDE:
        out = []
        for f in fields:
            if f.name in absr:
                out.append(round_half_away(df[f.name].cast("double"), ABS_DECIMALS).alias(f.name))
            elif f.name in dbl:
                out.append(sig(df[f.name].cast("double"), digits).alias(f.name))
            else:
                out.append(df[f.name])
        return df.select(*out)
    arr = F.transform(F.array(*[df[c].cast("double") for c in dbl]), lambda x: sig(x, digits))
    tmp = df.withColumn("__rounded", arr)
    pos = {c: i for i, c in enumerate(dbl)}
    out = []
    for f in fields:
        if f.name in absr:
            out.append(round_half_away(tmp[f.name].cast("double"), ABS_DECIMALS).alias(f.name))
        elif f.name in pos:
            out.append(F.col("__rounded")[pos[f.name]].alias(f.name))
        else:
            out.append(tmp[f.name])
    return tmp.select(*out)


def register(name: str, sql: str | None = None, dbl: Sequence[str] = (), note: str = "",
             absr: Sequence[str] = (), digits: int = DIGITS):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[name] = Entry(name, fn, sql, tuple(dbl), note, tuple(absr), digits)
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(e: Entry):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(e.fn(spark, sf_dir), digits=e.digits, absr=e.absr)
        run.__name__ = e.name
        run.__doc__ = e.fn.__doc__
        return run
    return {name: wrap(e) for name, e in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: rounded_sql(e.sql, e.dbl, e.absr, e.digits) for name, e in REGISTRY.items() if e.sql}
