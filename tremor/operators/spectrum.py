"""Frequency-domain features (W10-W13), for every block of every recording.

The reference looks at the first 256 non-null samples of one file; here the
non-null samples of every recording are numbered and cut into blocks of
``n_fft``, each with a spectrum.  The last block of a recording may be shorter;
it is padded with zeros and its ``n_samples`` says so.

Blocks are independent, so a long recording is many small units of work:
rows are hash-partitioned by ``(key, block)`` and sorted inside partitions;
``mapInPandas`` stacks the blocks of a batch into a 2-D array and runs one
vectorised ``np.fft.fft`` over it.  A block is one row with its magnitudes as
an array, so the summary needs no further shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.operators.ordering import with_sample_index

# Block length 256, first 128 bins kept, PSD epsilon 1e-10.
N_FFT = 256
N_BINS = 128
EPS = 1e-10


def spectrum_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, n_fft: int = N_FFT,
                    n_bins: int = N_BINS) -> DataFrame:
    """One row per block: keys, block, n_samples, magnitudes (``|X_k|`` for k < ``n_bins``)."""
    keys = list(keys)
    indexed = with_sample_index(df.where(F.col(value).isNotNull()), keys, order, name="__i")
    b = indexed.select(*keys, F.floor(F.col("__i") / n_fft).cast("long").alias("block"),
                       (F.col("__i") % n_fft).cast("int").alias("pos"), F.col(value).cast("double").alias("x"))
    out_schema = T.StructType([*[b.schema[k] for k in keys], T.StructField("block", T.LongType()),
                               T.StructField("n_samples", T.IntegerType()),
                               T.StructField("magnitudes", T.ArrayType(T.DoubleType()))])
    gcols = [*keys, "block"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry = None
        for pdf in batches:
            if carry is not None:
                pdf = pd.concat([carry, pdf], ignore_index=True)
            if pdf.empty:
                continue
            # the last block may go on in the next batch; every block starts at position 0
            last = int(np.flatnonzero(pdf["pos"].to_numpy() == 0)[-1])
            carry = pdf.iloc[last:]
            if last:
                yield _fft_frame(pdf.iloc[:last], gcols, n_fft, n_bins)
        if carry is not None and len(carry):
            yield _fft_frame(carry, gcols, n_fft, n_bins)

    # whole blocks per partition
    ordered = b.repartition(*[F.col(c) for c in gcols]).sortWithinPartitions(*gcols, "pos")
    return ordered.mapInPandas(run, out_schema)


def _fft_frame(pdf: pd.DataFrame, gcols: list[str], n_fft: int, n_bins: int) -> pd.DataFrame:
    """One vectorised FFT over the blocks of a sorted frame."""
    pos = pdf["pos"].to_numpy()
    heads = np.flatnonzero(pos == 0)
    x = np.zeros((len(heads), n_fft))
    x[np.cumsum(pos == 0) - 1, pos] = pdf["x"].to_numpy(dtype="float64")
    out = pdf.iloc[heads][gcols].reset_index(drop=True)
    out["n_samples"] = np.diff(np.append(heads, len(pos))).astype("int32")
    out["magnitudes"] = list(np.abs(np.fft.fft(x, axis=1))[:, :n_bins])
    return out


def spectrum(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, n_fft: int = N_FFT,
             n_bins: int = N_BINS) -> DataFrame:
    """Keys, block, n_samples, bin, freq (= bin / n_fft), magnitude."""
    blocks = spectrum_blocks(df, keys, order, value, n_fft, n_bins)
    return blocks.select(*keys, "block", "n_samples", F.posexplode("magnitudes").alias("bin", "magnitude")).select(
        *keys, "block", "n_samples", "bin", (F.col("bin") / F.lit(float(n_fft))).alias("freq"), "magnitude")


def spectral_summary(blocks: DataFrame, keys: Sequence[str], n_fft: int = N_FFT) -> DataFrame:
    """W11-W13 per block: dominant frequency (argmax, DC included, first bin
    on ties), energy = sum |X|^2, entropy = -sum p ln(p + 1e-10) with
    p = |X|^2 / (sum |X|^2 + 1e-10)."""
    b = blocks.withColumn("energy", F.aggregate("magnitudes", F.lit(0.0), lambda acc, m: acc + m * m))

    def entropy(acc: Column, m: Column) -> Column:
        p = m * m / (F.col("energy") + F.lit(EPS))
        return acc - p * F.log(p + F.lit(EPS))

    top = F.array_position("magnitudes", F.array_max("magnitudes")) - 1
    return b.select(*keys, "block", "n_samples", (top / F.lit(float(n_fft))).alias("dominant_freq"), "energy",
                    F.aggregate("magnitudes", F.lit(0.0), entropy).alias("entropy"))
