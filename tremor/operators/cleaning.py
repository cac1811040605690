"""Cleaning: coercion, gap filling, imputation, projections, vector fixes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.functions import hash_unit, to_double
from tremor.operators.ordering import DEFAULT_BLOCK_ROWS, carry_fill
from tremor.operators.selection import quantiles


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every listed column to double; junk and NaN become NULL."""
    return df.withColumns({c: to_double(c) for c in cols})


def _filled(c: str, how: str) -> Column:
    x, pv, pi, nv, ni = (F.col(c), F.col(f"{c}__pv"), F.col(f"{c}__pi").cast("double"),
                         F.col(f"{c}__nv"), F.col(f"{c}__ni").cast("double"))
    if how == "ffill_bfill":
        return F.coalesce(x, pv, nv)
    if how == "bfill_ffill":
        return F.coalesce(x, nv, pv)
    if how == "linear":
        # inside a gap: weighted mean of the neighbours by position; head -> next
        # value (bfill); tail -> last value (pandas carries it forward)
        idx = F.col("__idx_d")
        inner = pv + (nv - pv) * F.try_divide(idx - pi, ni - pi)
        return F.coalesce(x, F.when(pv.isNotNull() & nv.isNotNull(), inner), nv, pv)
    raise ValueError(f"unknown fill method {how!r}")


def fill_gaps(
    df: DataFrame,
    keys: Sequence[str],
    idx: str,
    cols: Sequence[str],
    how: str = "linear",
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """Fill NULLs in sample order inside each recording.

    ``linear``: pandas ``interpolate('linear')`` then ``bfill`` (and ``ffill``,
    a no-op after it) — P2 and P4.  ``ffill_bfill``: forward then backward
    fill — P3.  Gaps of any length, also across blocks, are filled exactly.
    An all-NULL channel stays NULL.
    """
    carried = carry_fill(df, keys, idx, cols, block_rows=block_rows)
    carried = carried.withColumn("__idx_d", F.col(idx).cast("double"))
    out = carried.select(*[(_filled(c, how).alias(c) if c in cols else F.col(c)) for c in df.columns])
    return out


def fill_compare(
    df: DataFrame,
    keys: Sequence[str],
    idx: str,
    col: str,
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """The three fills of one channel side by side.

    ``ffill`` = forward then backward fill, ``interp`` = linear then bfill,
    ``median`` = the recording's median (exact).
    """
    carried = carry_fill(df, keys, idx, [col], block_rows=block_rows)
    carried = carried.withColumn("__idx_d", F.col(idx).cast("double"))
    med = quantiles(df, keys, col, [0.5], names=["__median"]).drop("n")
    return (
        carried.join(med, on=list(keys), how="left")
        .select(
            *df.columns,
            _filled(col, "ffill_bfill").alias(f"{col}_ffill"),
            _filled(col, "linear").alias(f"{col}_interp"),
            F.coalesce(F.col(col), F.col("__median")).alias(f"{col}_median"),
        )
    )


def column_medians(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Exact medians of ``cols`` (per ``keys`` if given) as one wide row per key.

    Long form + :func:`quantiles`, so no single task holds a whole column.
    """
    long = unpivot(df, cols, keys)
    q = quantiles(long, [*keys, "feature"], "value", [0.5], names=["median"])
    wide = q.groupBy(*keys).pivot("feature", list(cols)).agg(F.first("median"))
    return wide


def unpivot(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (),
            var: str = "feature", val: str = "value") -> DataFrame:
    """Wide -> long ``(keys..., feature, value)``, all values as double."""
    d = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols])
    return d.unpivot(list(keys), list(cols), var, val)


def impute_median(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """P5: NULL -> the column median (over the whole table, or per ``keys``).

    Exact median (SimpleImputer / pandas), not ``Imputer``'s approximation.
    Whole-table medians are one row, broadcast and attached by an equi-join
    on a constant; a per-key table is joined normally (AQE broadcasts it at
    run time when small).
    """
    med = column_medians(df, cols, keys).select(
        *keys, *[F.col(c).alias(f"__med_{c}") for c in cols]
    )
    if keys:
        joined = df.join(med, on=list(keys), how="left")
        return joined.select(
            *[F.coalesce(F.col(c), F.col(f"__med_{c}")).alias(c) if c in cols else F.col(c)
              for c in df.columns])
    one = F.broadcast(med.limit(1).withColumn("__one", F.lit(1)))
    joined = df.withColumn("__one", F.lit(1)).join(one, on="__one", how="inner")
    return joined.select(*[F.coalesce(F.col(c), F.col(f"__med_{c}")).alias(c) if c in cols else F.col(c)
                           for c in df.columns])


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL -> 0."""
    return df.na.fill(0.0, subset=list(cols))


def inject_nulls(df: DataFrame, cols: Sequence[str], rate: float = 0.05, seed: int = 42,
                 id_cols: Sequence[str] = ()) -> DataFrame:
    """Blank about ``rate`` of the cells, repeatably (md5 of row id + column)."""
    if not id_cols:
        raise ValueError("id_cols is needed for repeatable masking")
    return df.withColumns({
        c: F.when(hash_unit([*id_cols, F.lit(c)], seed) < rate, F.lit(None).cast("double")).otherwise(F.col(c))
        for c in cols
    })


def drop_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P9."""
    return df.na.drop(subset=list(cols))


def feature_columns(df: DataFrame, target: str = "fault_label") -> list[str]:
    """P10: all columns except the target."""
    return [c for c in df.columns if c != target]


def select_features(df: DataFrame, target: str = "fault_label") -> DataFrame:
    return df.select(*feature_columns(df, target))


def select_target(df: DataFrame, target: str = "fault_label") -> DataFrame:
    """P11."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} missing")
    return df.select(target)


def columns_like(df: DataFrame, suffix: str = "_mean", limit: int | None = None) -> list[str]:
    """The columns containing ``suffix``, at most ``limit`` if the caller gives one; none if none has it."""
    return [c for c in df.columns if suffix in c][:limit]


def inf_to_zero(c: Column) -> Column:
    """+-inf -> 0 (NaN / NULL stay)."""
    return F.when(F.abs(c) == F.lit(float("inf")), F.lit(0.0)).otherwise(c)


def validate_readings(df: DataFrame, readings: str, names: Sequence[str]) -> DataFrame:
    """Compare the key set of a ``map<string,double>`` with ``names``.

    Adds ``missing`` and ``extra`` arrays and an ``error`` string (NULL when
    the sets are equal).
    """
    expected = F.array(*[F.lit(n) for n in names])
    keys = F.map_keys(F.col(readings))
    missing = F.array_sort(F.array_except(expected, keys))
    extra = F.array_sort(F.array_except(keys, expected))
    err = F.when(
        (F.size(missing) > 0) | (F.size(extra) > 0),
        F.concat(F.lit("names differ from the model's; absent: "), F.array_join(missing, ","),
                 F.lit("; unknown: "), F.array_join(extra, ",")),
    )
    return df.withColumns({"missing": missing, "extra": extra, "error": err})


def readings_to_vector(readings: str, names: Sequence[str]) -> Column:
    """``[m[name] for name in names]`` as ``array<double>``."""
    m = F.col(readings)
    return F.array(*[F.try_element_at(m, F.lit(n)).cast("double") for n in names])


def pad_vector(c: Column | str, n: int) -> Column:
    """Pad with zeros or cut to ``n`` elements."""
    col = F.col(c) if isinstance(c, str) else c
    zeros = F.array_repeat(F.lit(0.0), F.lit(n))
    return F.slice(F.concat(col.cast("array<double>"), zeros), 1, n)
