"""Per-recording statistics: one row of time-domain features per recording.

A recording is any group of rows (``keys``) with numeric channel columns.
A1-A9 are one grouped aggregate (partial + final aggregation, so a huge
recording is pre-reduced map-side).  A10 (mean of the 100-row rolling
sample std) needs sample order and runs on :mod:`tremor.operators.windows`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.operators import windows

# Feature suffixes of the per-recording summary, in table order.
STATS = ["mean", "std", "min", "max", "rms", "p2p", "kurt", "skew", "crest", "roll_std"]

# The eight sensor channels of a raw recording, in file order.
CHANNELS = ["current", "vib_x", "vib_y", "vib_z", "volt_a", "volt_b", "volt_c", "volt_d"]


def channel_stats(c: str) -> list[Column]:
    """A1-A9 for one channel over its non-null values.

    std is the population std (ddof 0), kurtosis is excess and biased,
    skewness biased; crest = max|x| / rms and 0 when rms is 0.  A constant
    channel gives NULL kurtosis / skewness.
    """
    x = F.col(c)
    rms = F.sqrt(F.avg(x * x))
    return [
        F.avg(x).alias(f"{c}_mean"),
        F.stddev_pop(x).alias(f"{c}_std"),
        F.min(x).alias(f"{c}_min"),
        F.max(x).alias(f"{c}_max"),
        rms.alias(f"{c}_rms"),
        (F.max(x) - F.min(x)).alias(f"{c}_p2p"),
        F.kurtosis(x).alias(f"{c}_kurt"),
        F.skewness(x).alias(f"{c}_skew"),
        F.when(rms == 0, F.lit(0.0)).otherwise(F.try_divide(F.max(F.abs(x)), rms)).alias(f"{c}_crest"),
    ]


def recording_features(df: DataFrame, keys: Sequence[str], channels: Sequence[str]) -> DataFrame:
    """A1-A9, A11, A12 without sample order: one row per recording.

    An all-null channel yields NULL features (they are filled later by the
    median imputer, as the reference does).
    """
    aggs: list[Column] = [F.count(F.lit(1)).alias("n_samples")]
    for c in channels:
        aggs += channel_stats(c)
    return df.groupBy(*keys).agg(*aggs)


def recording_summary(
    df: DataFrame,
    keys: Sequence[str],
    idx: str,
    channels: Sequence[str],
    roll_window: int = 100,
    block_rows: int = windows.DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """The full 10-statistic summary (A1-A12) of ordered recordings.

    ``idx`` is the dense sample index (:func:`ordering.with_sample_index`).
    ``<c>_roll_std`` is the mean of the ``roll_window``-row rolling sample
    std; with fewer values than the window it falls back to ``<c>_std``.
    """
    base = recording_features(df, keys, channels)
    roll = windows.rolling_std_mean(df, keys, idx, channels, roll_window, block_rows)
    joined = base.join(roll, on=list(keys), how="left")
    cols = [F.col(k) for k in keys] + [F.col("n_samples")]
    for c in channels:
        for s in STATS[:-1]:
            cols.append(F.col(f"{c}_{s}"))
        cols.append(F.coalesce(F.col(f"{c}_roll_std_w"), F.col(f"{c}_std")).alias(f"{c}_roll_std"))
    return joined.select(*cols)
