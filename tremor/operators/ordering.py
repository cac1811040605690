"""Order-dependent building blocks that stay safe when one key is huge.

A naive ``Window.partitionBy(key).orderBy(...)`` puts a whole key into one
task.  When one recording (or one feature, or one class) may hold a third of
all rows, that task is the job.  The helpers here split a hot key across
many tasks:

* :func:`prefix_sums` range-partitions by ``(key, order)`` so a hot key is
  cut into many partitions, computes running sums inside each
  ``(partition, key)`` piece, and adds an offset taken from a window over the
  tiny per-piece totals table (one row per piece).
* :func:`with_sample_index` is a prefix count: the dense 0-based row number
  of each row inside its key.
* :func:`blocked` cuts a dense index into fixed blocks and copies the last
  ``halo`` rows of each block into the next one, so any frame that looks at
  most ``halo`` rows back is exact inside ``(key, block)`` partitions.
* :func:`carry_fill` finds the previous / next non-null value of a column at
  any distance, block-locally plus a carry over the small per-block table.

Quantiles and other wanted ranks need no order at all: see :mod:`tremor.operators.selection`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.functions import fitted
from tremor.session import cut_lineage

DEFAULT_BLOCK_ROWS = 1 << 16

_PID = "__pid"


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _local_running_sums(sums: list[str]):
    """mapInArrow body: running sums of ``sums`` over runs of equal ``__key``
    inside one sorted partition; a run may go on from one Arrow batch into the
    next.  The other columns pass through as they are."""
    import numpy as np
    import pandas as pd
    import pyarrow as pa

    def run(batches):
        last, carry = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch["__key"].to_numpy()
            changed = np.append(last is None or key[0] != last, key[1:] != key[:-1])
            number = np.cumsum(changed)  # 0 for rows that continue the last batch
            local = pd.DataFrame({c: batch[c].to_numpy(zero_copy_only=False) for c in sums}).groupby(number).cumsum()
            if not changed[0]:
                goes_on = int(np.searchsorted(number, 1))
                local.iloc[:goes_on] += carry
            last, carry = key[-1], local.iloc[-1]
            cols = [batch[n] for n in batch.schema.names] + [
                pa.array(local[c].to_numpy(), batch.schema.field(c).type) for c in sums]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names, *[f"__l_{c}" for c in sums]])

    return run


def _key_number(keys: Sequence[str]) -> Column:
    """One long per key value for telling neighbouring keys apart (nulls count as a value)."""
    return F.xxhash64(*[x for k in keys for x in (F.col(k).isNull(), F.col(k))]) if keys else F.lit(0).cast("long")


def prefix_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    sums: Sequence[str],
    prefix: str = "cum_",
    total_prefix: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Inclusive running sums of ``sums`` (non-null numeric columns) per
    ``keys`` in ``order``.

    ``order`` should make rows unique inside a key (pre-aggregate ties first,
    or add a unique id).  With ``total_prefix`` the key totals are added too.

    Plan: one range exchange by ``(keys, order)``, sorted inside partitions
    and materialised by a checkpoint (piece ids must not change between the
    reads below).  Running sums inside each partition come from an Arrow pass
    (no further shuffle) that computes on the sum columns only; all other
    columns pass through unread.  Only a key that crosses a
    partition boundary needs an offset; range partitioning lets at most one
    key cross each boundary, so the offsets table has at most about two rows
    per partition and is broadcast with that bound.
    """
    from pyspark.sql import types as T

    keys, sums = list(keys), list(sums)
    order_cols = _as_cols(order)
    sort_cols = [F.col(k) for k in keys] + order_cols
    # without an explicit count there are spark.sql.shuffle.partitions ranges, of which AQE merges
    # small neighbours
    rp = (df.repartitionByRange(int(num_partitions), *sort_cols) if num_partitions
          else df.repartitionByRange(*sort_cols))
    ranged = cut_lineage(rp.sortWithinPartitions(*sort_cols).withColumn(_PID, F.spark_partition_id()))

    keyed = ranged.withColumn("__key", _key_number(keys))
    out_schema = T.StructType(
        list(keyed.schema.fields)
        + [T.StructField(f"__l_{c}", keyed.schema[c].dataType, True) for c in sums]
    )
    local = keyed.mapInArrow(_local_running_sums(sums), out_schema)

    # offsets only for keys present in more than one partition (<= n of them)
    totals = ranged.groupBy(_PID, *keys).agg(*[F.sum(c).alias(f"__t_{c}") for c in sums])
    w_key = Window.partitionBy(*keys)
    split = totals.withColumn("__pieces", F.count(F.lit(1)).over(w_key)).where(F.col("__pieces") > 1)
    w_before = Window.partitionBy(*keys).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = split.select(
        _PID, *keys,
        *[F.coalesce(F.sum(f"__t_{c}").over(w_before), F.lit(0)).alias(f"__o_{c}") for c in sums],
    )
    joined = local.join(F.broadcast(offsets), on=_null_safe_keys(local, offsets, [_PID, *keys]), how="left")
    result = joined.select(
        *[local[c] for c in df.columns],
        *[(local[f"__l_{c}"] + F.coalesce(offsets[f"__o_{c}"], F.lit(0))).alias(f"{prefix}{c}") for c in sums],
    )
    if total_prefix:
        key_totals = ranged.groupBy(*keys).agg(*[F.sum(c).alias(f"{total_prefix}{c}") for c in sums])
        if keys:
            result = result.join(key_totals, on=_null_safe_keys(result, key_totals, keys), how="left") \
                .select(*[result[c] for c in result.columns], *[key_totals[f"{total_prefix}{c}"] for c in sums])
        else:
            tot = fitted(key_totals)
            result = result.withColumns({f"{total_prefix}{c}": tot.getField(f"{total_prefix}{c}") for c in sums})
    return result


def _null_safe_keys(left: DataFrame, right: DataFrame, cols: Sequence[str]):
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[c])
        cond = e if cond is None else (cond & e)
    return cond


def with_sample_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    name: str = "sample_idx",
    num_partitions: int | None = None,
) -> DataFrame:
    """Dense 0-based position of each row inside its key, in ``order``.

    ``order`` must be unique inside a key (e.g. ``ts, event_id``).
    """
    one = "__one"
    counted = prefix_sums(df.withColumn(one, F.lit(1).cast("long")), keys, order, [one],
                          prefix="__cum", num_partitions=num_partitions)
    return counted.withColumn(name, F.col(f"__cum{one}") - 1).drop(one, f"__cum{one}")


def blocked(
    df: DataFrame,
    idx: str,
    halo: int,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    block: str = "__blk",
    home: str = "__home",
) -> DataFrame:
    """Assign rows to blocks of ``block_rows`` and copy the last ``halo`` rows
    of each block into the next block (``home`` is false on the copies).

    A window partitioned by ``(key, block)`` and ordered by ``idx`` then sees
    up to ``halo`` true predecessors of every home row, so lags up to
    ``halo`` and frames of ``halo + 1`` rows are exact; keep only home rows
    afterwards.  Task size is bounded by ``block_rows + halo``.
    """
    if halo > block_rows:
        raise ValueError("halo must not exceed block_rows")
    b = F.floor(F.col(idx) / F.lit(block_rows)).cast("long")
    pos = F.col(idx) - b * F.lit(block_rows)
    blocks = F.when(pos >= F.lit(block_rows - halo), F.array(b, b + 1)).otherwise(F.array(b))
    return (
        df.withColumn("__own_blk", b)
        .withColumn(block, F.explode(blocks))
        .withColumn(home, F.col(block) == F.col("__own_blk"))
        .drop("__own_blk")
    )


def carry_fill(
    df: DataFrame,
    keys: Sequence[str],
    idx: str,
    cols: Sequence[str],
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """For each column ``c`` add ``c__pv, c__pi`` (previous non-null value and its
    index, current row included) and ``c__nv, c__ni`` (next non-null, current
    included), at any distance.

    Works block by block (bounded tasks), then fills the gaps that cross
    blocks from a carry over the per-block summary (one row per block).
    """
    keys = list(keys)
    blk = "__cblk"
    d = df.withColumn(blk, F.floor(F.col(idx) / F.lit(block_rows)).cast("long"))
    # Frames that run to "unbounded following" are re-evaluated row by row
    # (quadratic); the next non-null value is the last one of the reversed
    # order instead, an incrementally evaluated running frame.
    w_prev = Window.partitionBy(*keys, blk).orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    w_next = Window.partitionBy(*keys, blk).orderBy(F.col(idx).desc()).rowsBetween(Window.unboundedPreceding, 0)
    exprs = []
    for c in cols:
        nn_idx = F.when(F.col(c).isNotNull(), F.col(idx))
        exprs += [
            F.last(c, ignorenulls=True).over(w_prev).alias(f"{c}__pv"),
            F.last(nn_idx, ignorenulls=True).over(w_prev).alias(f"{c}__pi"),
            F.last(c, ignorenulls=True).over(w_next).alias(f"{c}__nv"),
            F.last(nn_idx, ignorenulls=True).over(w_next).alias(f"{c}__ni"),
        ]
    local = d.select("*", *exprs)

    # per-block last / first non-null (value, idx), then carried across blocks
    aggs = []
    for c in cols:
        s = F.when(F.col(c).isNotNull(), F.struct(F.col(idx).alias("i"), F.col(c).alias("v")))
        aggs += [F.max(s).alias(f"{c}__bl"), F.min(s).alias(f"{c}__bf")]
    summary = d.groupBy(*keys, blk).agg(*aggs)
    w_before = Window.partitionBy(*keys).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
    w_after = Window.partitionBy(*keys).orderBy(F.col(blk).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry_exprs = []
    for c in cols:
        carry_exprs += [
            F.last(f"{c}__bl", ignorenulls=True).over(w_before).alias(f"{c}__cp"),
            F.last(f"{c}__bf", ignorenulls=True).over(w_after).alias(f"{c}__cn"),
        ]
    carry = summary.select(*keys, blk, *carry_exprs)

    named = carry.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate([*keys, blk])],
                         *[f"{c}__c{x}" for c in cols for x in ("p", "n")])
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate([*keys, blk])]
    out = local.join(named, on=same, how="left")
    fills = []
    for c in cols:
        fills += [
            F.coalesce(F.col(f"{c}__pv"), F.col(f"{c}__cp.v")).alias(f"{c}__pv"),
            F.coalesce(F.col(f"{c}__pi"), F.col(f"{c}__cp.i")).alias(f"{c}__pi"),
            F.coalesce(F.col(f"{c}__nv"), F.col(f"{c}__cn.v")).alias(f"{c}__nv"),
            F.coalesce(F.col(f"{c}__ni"), F.col(f"{c}__cn.i")).alias(f"{c}__ni"),
        ]
    return out.select(*df.columns, *fills)
