"""Window features over sample order inside a recording.

All functions take a DataFrame with recording ``keys`` and a dense sample
index ``idx`` (see :func:`tremor.operators.ordering.with_sample_index`).
Windows are evaluated inside ``(key, block)`` partitions with a halo of
predecessor rows (:func:`tremor.operators.ordering.blocked`), so one very
long recording is spread over many tasks instead of one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.functions import safe_corr
from tremor.operators.ordering import DEFAULT_BLOCK_ROWS, blocked

BLK, HOME = "__blk", "__home"


def _frame(keys: Sequence[str], idx: str, size: int) -> Window:
    return Window.partitionBy(*keys, BLK).orderBy(idx).rowsBetween(-(size - 1), 0)


def _ordered(keys: Sequence[str], idx: str) -> Window:
    return Window.partitionBy(*keys, BLK).orderBy(idx)


def _run(df: DataFrame, keys: Sequence[str], idx: str, halo: int, block_rows: int,
         exprs: list[Column]) -> DataFrame:
    b = blocked(df, idx, halo=halo, block_rows=max(block_rows, halo))
    return b.select(*df.columns, *exprs, HOME).where(F.col(HOME)).drop(HOME)


def rolling_stats(
    df: DataFrame,
    keys: Sequence[str],
    idx: str,
    col: str,
    sizes: Sequence[int] = (5, 10, 20),
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """Rolling mean, sample std, min and max over ``size`` rows.

    NULL until the window holds ``size`` non-null values (pandas
    ``rolling(size)``); std is the sample std (ddof 1).
    """
    exprs: list[Column] = []
    for s in sizes:
        w = _frame(keys, idx, s)
        full = F.count(F.col(col)).over(w) == s
        exprs += [
            F.when(full, F.avg(col).over(w)).alias(f"roll_mean_{s}"),
            F.when(full, F.stddev_samp(col).over(w)).alias(f"roll_std_{s}"),
            F.when(full, F.min(col).over(w)).alias(f"roll_min_{s}"),
            F.when(full, F.max(col).over(w)).alias(f"roll_max_{s}"),
        ]
    return _run(df, keys, idx, max(sizes) - 1, block_rows, exprs)


def lag_features(
    df: DataFrame,
    keys: Sequence[str],
    idx: str,
    col: str,
    lags: Sequence[int] = (1, 2, 5, 10),
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """``<col>_lag_k`` = value k samples earlier (NULL at the head)."""
    w = _ordered(keys, idx)
    exprs = [F.lag(col, k).over(w).alias(f"{col}_lag_{k}") for k in lags]
    return _run(df, keys, idx, max(lags), block_rows, exprs)


def lag_correlation(
    df: DataFrame,
    keys: Sequence[str],
    idx: str,
    col: str,
    lags: Sequence[int] = (1, 2, 5, 10),
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """Per recording and lag, Pearson r(x_t, x_{t-k}) over complete pairs."""
    lagged = lag_features(df, keys, idx, col, lags, block_rows)
    stacked = lagged.select(
        *keys,
        F.explode(F.array(*[
            F.struct(F.lit(k).alias("lag"), F.col(col).alias("x"), F.col(f"{col}_lag_{k}").alias("y"))
            for k in lags
        ])).alias("__p"),
    ).select(*keys, "__p.lag", "__p.x", "__p.y")
    return stacked.groupBy(*keys, "lag").agg(
        F.count(F.when(F.col("y").isNotNull() & F.col("x").isNotNull(), 1)).alias("n_pairs"),
        safe_corr("x", "y").alias("corr"),
    )


def rate_of_change(
    df: DataFrame,
    keys: Sequence[str],
    idx: str,
    col: str,
    slope_window: int = 5,
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """First difference, percent change and least-squares slope.

    pct_change: (x - prev) / prev; a division of a non-zero change by zero
    (pandas +-inf) becomes 0, and 0/0 stays NULL (pandas NaN).
    slope: ``regr_slope(x, idx)`` over the last ``slope_window`` samples,
    NULL until the window is full (``np.polyfit(range(5), x, 1)[0]``).
    """
    w = _ordered(keys, idx)
    prev = F.lag(col, 1).over(w)
    diff = F.col(col) - prev
    pct = F.when((prev == 0) & (diff != 0), F.lit(0.0)).otherwise(F.try_divide(diff, prev))
    fw = _frame(keys, idx, slope_window)
    full = F.count(F.col(col)).over(fw) == slope_window
    slope = F.when(full, F.regr_slope(F.col(col), F.col(idx).cast("double")).over(fw))
    exprs = [diff.alias(f"{col}_diff"), pct.alias(f"{col}_pct_change"), slope.alias(f"{col}_slope")]
    return _run(df, keys, idx, max(slope_window - 1, 1), block_rows, exprs)


def _rolling_std(b: DataFrame, keys: Sequence[str], idx: str, channels: Sequence[str], window: int) -> DataFrame:
    """Adds ``__rs_<c>``, the sample std of the last ``window`` values of each
    channel, to blocks ``b`` that start ``window`` rows early.

    Rows are cut into tiles of ``window`` rows.  A window is the end of one tile
    and the start of the next; count, mean and variance of every start come
    from a running frame (updated value by value, which is stable), those of
    every end from a running frame in reverse order, and the two are merged by
    the pairwise variance formula.  That is O(1) per row, and no difference
    of large sums is ever taken, so an outlier elsewhere cannot spoil a window.
    """
    tile = F.floor(F.col(idx) / F.lit(window)).cast("long")
    d = b.withColumn("__tile", tile)
    part = Window.partitionBy(*keys, BLK, "__tile")
    first = part.orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    after = part.orderBy(F.col(idx).desc()).rowsBetween(Window.unboundedPreceding, 0)
    stats = {"n": F.count, "m": F.avg, "v": F.var_pop}
    d = d.select("*", *[fn(c).over(w).alias(f"__{side}{s}_{c}")
                        for c in channels for side, w in (("a", after), ("b", first)) for s, fn in stats.items()])
    order = Window.partitionBy(*keys, BLK).orderBy(idx)
    head = F.pmod(F.col(idx), F.lit(window)) == window - 1  # the window is this tile alone
    d = d.select("*", *[F.when(~head, F.lag(f"__a{s}_{c}", window - 1).over(order)).alias(f"__p{s}_{c}")
                        for c in channels for s in stats])
    out = []
    for c in channels:
        na, nb = F.coalesce(F.col(f"__pn_{c}"), F.lit(0)), F.col(f"__bn_{c}")
        zero = lambda x: F.coalesce(F.col(x), F.lit(0.0))
        delta = zero(f"__bm_{c}") - zero(f"__pm_{c}")
        m2 = zero(f"__pv_{c}") * na + zero(f"__bv_{c}") * nb + F.when((na > 0) & (nb > 0), delta * delta * na * nb / (na + nb)).otherwise(0.0)
        out.append(F.when(na + nb == window, F.sqrt(m2 / F.lit(float(window - 1)))).alias(f"__rs_{c}"))
    return d.select(*b.columns, *out)


def rolling_std_mean(
    df: DataFrame,
    keys: Sequence[str],
    idx: str,
    channels: Sequence[str],
    window: int = 100,
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """Per recording, the mean over all full windows of the
    ``window``-row rolling sample std; ``<c>_roll_std_w`` is NULL when no
    window holds ``window`` non-null values."""
    b = blocked(df, idx, halo=window, block_rows=max(block_rows, window))
    rolled = _rolling_std(b.select(*keys, idx, BLK, HOME, *channels), keys, idx, channels, window).where(F.col(HOME))
    return rolled.groupBy(*keys).agg(*[F.avg(f"__rs_{c}").alias(f"{c}_roll_std_w") for c in channels])


def rolling_std_rows(
    df: DataFrame,
    keys: Sequence[str],
    idx: str,
    col: str,
    window: int = 100,
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """W1 row by row: ``<col>_roll_std_<window>``, NULL until the window holds ``window`` non-null values."""
    b = blocked(df, idx, halo=window, block_rows=max(block_rows, window))
    return _rolling_std(b, keys, idx, [col], window).where(F.col(HOME)).select(
        *df.columns, F.col(f"__rs_{col}").alias(f"{col}_roll_std_{window}"))
