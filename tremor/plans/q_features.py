"""Queries: per-recording features, cleaning and window features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tremor.operators import cleaning, features, windows
from tremor.plans import bindings as B
from tremor.plans.registry import register

STAT9 = ["mean", "std", "min", "max", "rms", "p2p", "kurt", "skew", "crest"]


def _sql_channel_stats(c: str, m: str) -> str:
    """DuckDB twin of A1-A9 (population moments from a mean CTE column ``m``)."""
    m2 = f"avg(({c} - {m}) * ({c} - {m}))"
    return ",\n  ".join([
        f"avg({c}) AS {c}_mean",
        f"stddev_pop({c}) AS {c}_std",
        f"min({c}) AS {c}_min",
        f"max({c}) AS {c}_max",
        f"sqrt(avg({c} * {c})) AS {c}_rms",
        f"max({c}) - min({c}) AS {c}_p2p",
        f"avg(power({c} - {m}, 4)) / nullif({m2} * {m2}, 0) - 3 AS {c}_kurt",
        f"avg(power({c} - {m}, 3)) / nullif(power({m2}, 1.5), 0) AS {c}_skew",
        f"CASE WHEN sqrt(avg({c} * {c})) = 0 THEN 0.0 ELSE max(abs({c})) / sqrt(avg({c} * {c})) END AS {c}_crest",
    ])


def _sql_features(table: str, key: str, channels: list[str]) -> str:
    means = ", ".join(f"avg({c}) AS __m_{c}" for c in channels)
    stats = ",\n  ".join(_sql_channel_stats(c, f"__m_{c}") for c in channels)
    return f"""
WITH __m AS (SELECT {key}, {means} FROM {table} GROUP BY {key})
SELECT t.{key}, count(*) AS n_samples,
  {stats}
FROM {table} t JOIN __m USING ({key})
GROUP BY t.{key}"""


def _dbl(channels, stats=STAT9):
    return [f"{c}_{s}" for c in channels for s in stats]


@register("recording_features", sql=_sql_features("lineitem", "l_suppkey", B.LINEITEM_CHANNELS),
          dbl=_dbl(B.LINEITEM_CHANNELS),
          absr=[f"{c}_{s}" for c in B.LINEITEM_CHANNELS for s in ("kurt", "skew")])
def q_recording_features(spark, sf_dir):
    """One row of time-domain statistics per supplier recording."""
    rec = B.lineitem_recordings(spark, sf_dir)
    return features.recording_features(rec, ["l_suppkey"], B.LINEITEM_CHANNELS)


_EV_ORDER = "ts, event_id"


def _sql_events_idx(key: str, value_expr: str = "value") -> str:
    return (f"SELECT {key}, event_id, ts, {value_expr} AS value, "
            f"row_number() OVER (PARTITION BY {key} ORDER BY {_EV_ORDER}) - 1 AS sample_idx FROM events")


_ROLL_SQL = f"""
WITH __m AS (SELECT event_type, avg(value) AS __m_value FROM events GROUP BY event_type),
__r AS (
  SELECT event_type,
    CASE WHEN count(value) OVER w = 100 THEN stddev_samp(value) OVER w END AS rs
  FROM events
  WINDOW w AS (PARTITION BY event_type ORDER BY {_EV_ORDER} ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)
),
__rm AS (SELECT event_type, avg(rs) AS rsm FROM __r GROUP BY event_type),
__f AS (
  SELECT t.event_type, count(*) AS n_samples,
  {_sql_channel_stats("value", "__m_value")}
  FROM events t JOIN __m USING (event_type) GROUP BY t.event_type
)
SELECT __f.*, coalesce(__rm.rsm, __f.value_std) AS value_roll_std
FROM __f LEFT JOIN __rm USING (event_type)"""


@register("roll_std_mean", sql=_ROLL_SQL, dbl=_dbl(["value"], STAT9 + ["roll_std"]),
          absr=["value_kurt", "value_skew"])
def q_roll_std_mean(spark, sf_dir):
    """A1-A12 with A10: the full 10-statistic summary per event type, the
    rolling 100-sample std averaged over each recording."""
    rec = B.events_recordings(spark, sf_dir, "event_type")
    return features.recording_summary(rec, ["event_type"], "sample_idx", ["value"], roll_window=100)


def _sql_gaps(key: str) -> str:
    mask = ("CAST('0x' || substr(md5(concat_ws('|', CAST(event_id AS VARCHAR), 'value', '42')), 1, 15) AS BIGINT)"
            " / 1152921504606846976.0 < 0.05")
    return _sql_events_idx(key, f"CASE WHEN {mask} THEN NULL ELSE value END")


def _sql_fill_cols(key: str) -> str:
    w_prev = f"PARTITION BY {key} ORDER BY sample_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    w_next = f"PARTITION BY {key} ORDER BY sample_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    return f"""
  last_value(value IGNORE NULLS) OVER ({w_prev}) AS pv,
  last_value(CASE WHEN value IS NOT NULL THEN sample_idx END IGNORE NULLS) OVER ({w_prev}) AS pi,
  first_value(value IGNORE NULLS) OVER ({w_next}) AS nv,
  first_value(CASE WHEN value IS NOT NULL THEN sample_idx END IGNORE NULLS) OVER ({w_next}) AS ni"""


_INTERP_EXPR = ("coalesce(value, CASE WHEN pv IS NOT NULL AND nv IS NOT NULL THEN "
                "pv + (nv - pv) * ((sample_idx - pi) / (ni - pi)) END, nv, pv)")

_INTERP_SQL = f"""
WITH g AS ({_sql_gaps("user_id")}),
c AS (SELECT *, {_sql_fill_cols("user_id")} FROM g)
SELECT user_id, event_id, sample_idx, value AS value_raw, {_INTERP_EXPR} AS value
FROM c"""


@register("interpolate_linear", sql=_INTERP_SQL, dbl=["value_raw", "value"])
def q_interpolate_linear(spark, sf_dir):
    """P2/P4 (P7 mask): linear interpolation in sample order per user, head
    back-filled, tail carried; 5% of values blanked by an md5 mask."""
    rec = B.events_with_gaps(spark, sf_dir, "user_id").withColumn("value_raw", F.col("value"))
    filled = cleaning.fill_gaps(rec, ["user_id"], "sample_idx", ["value"], how="linear")
    return filled.select("user_id", "event_id", "sample_idx", "value_raw", "value")


_FILLCMP_SQL = f"""
WITH g AS ({_sql_gaps("user_id")}),
med AS (SELECT user_id, quantile_cont(value, 0.5) AS med FROM g GROUP BY user_id),
c AS (SELECT *, {_sql_fill_cols("user_id")} FROM g)
SELECT c.user_id, c.event_id, c.sample_idx, c.value,
  coalesce(c.value, c.pv, c.nv) AS value_ffill,
  {_INTERP_EXPR.replace("value", "c.value").replace("sample_idx", "c.sample_idx")} AS value_interp,
  coalesce(c.value, med.med) AS value_median
FROM c JOIN med USING (user_id)"""


@register("fill_compare", sql=_FILLCMP_SQL, dbl=["value", "value_ffill", "value_interp", "value_median"])
def q_fill_compare(spark, sf_dir):
    """forward/backward fill, linear interpolation and the
    recording median, side by side for one channel with 5% blanked values."""
    rec = B.events_with_gaps(spark, sf_dir, "user_id")
    out = cleaning.fill_compare(rec, ["user_id"], "sample_idx", "value")
    return out.select("user_id", "event_id", "sample_idx", "value", "value_ffill", "value_interp", "value_median")


_IMPUTE_SQL = f"""
WITH g AS ({_sql_gaps("user_id")}),
med AS (SELECT quantile_cont(value, 0.5) AS med FROM g)
SELECT event_id, value AS value_raw, coalesce(value, med.med) AS value FROM g, med"""


@register("impute_median", sql=_IMPUTE_SQL, dbl=["value_raw", "value"])
def q_impute_median(spark, sf_dir):
    """P5: NULL -> exact whole-column median (SimpleImputer(strategy='median'))."""
    rec = B.gappy_events(spark, sf_dir).select("event_id", F.col("value").alias("value_raw"), F.col("value"))
    return cleaning.impute_median(rec, ["value"])


_NULLS_SQL = f"""
WITH g AS ({_sql_gaps("user_id")})
SELECT count(*) AS n_rows, count(*) - count(value) AS n_null_value,
       CAST(count(*) - count(event_id) AS BIGINT) AS n_null_event_id FROM g"""


@register("null_counts", sql=_NULLS_SQL)
def q_null_counts(spark, sf_dir):
    """Remaining-null count per column and table size."""
    from tremor.operators import stats
    rec = B.gappy_events(spark, sf_dir)
    return stats.null_counts(rec, ["value", "event_id"])


_ROLLING_SQL = f"""
SELECT event_type, event_id, sample_idx, value,
{{cols}}
FROM ({_sql_events_idx("event_type")}) e
WINDOW w5 AS (PARTITION BY event_type ORDER BY sample_idx ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
       w10 AS (PARTITION BY event_type ORDER BY sample_idx ROWS BETWEEN 9 PRECEDING AND CURRENT ROW),
       w20 AS (PARTITION BY event_type ORDER BY sample_idx ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""
_ROLLING_COLS = ",\n".join(
    f"  CASE WHEN count(value) OVER w{s} = {s} THEN {fn}(value) OVER w{s} END AS roll_{nm}_{s}"
    for s in (5, 10, 20) for nm, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
)


@register("rolling_stats", sql=_ROLLING_SQL.replace("{cols}", _ROLLING_COLS),
          dbl=["value"] + [f"roll_{nm}_{s}" for s in (5, 10, 20) for nm in ("mean", "std", "min", "max")])
def q_rolling_stats(spark, sf_dir):
    """Rolling mean / std / min / max over 5, 10, 20 samples per event type."""
    rec = B.events_recordings(spark, sf_dir, "event_type")
    out = windows.rolling_stats(rec, ["event_type"], "sample_idx", "value", (5, 10, 20))
    return out.drop("ts")


@register("rolling_stats_gaps", sql=_ROLLING_SQL.replace("{cols}", _ROLLING_COLS).replace(_sql_events_idx("event_type"), _sql_gaps("event_type")),
          dbl=["value"] + [f"roll_{nm}_{s}" for s in (5, 10, 20) for nm in ("mean", "std", "min", "max")])
def q_rolling_stats_gaps(spark, sf_dir):
    """W2-W4 with 5% of the values blanked: a window with a NULL in it gives NULL."""
    rec = B.events_with_gaps(spark, sf_dir, "event_type")
    return windows.rolling_stats(rec, ["event_type"], "sample_idx", "value", (5, 10, 20)).drop("ts")


_LAG_SQL = f"""
SELECT event_type, event_id, sample_idx, value,
  lag(value, 1) OVER w AS value_lag_1, lag(value, 2) OVER w AS value_lag_2,
  lag(value, 5) OVER w AS value_lag_5, lag(value, 10) OVER w AS value_lag_10
FROM ({_sql_events_idx("event_type")}) e
WINDOW w AS (PARTITION BY event_type ORDER BY sample_idx)"""


@register("lag_features", sql=_LAG_SQL, dbl=["value", "value_lag_1", "value_lag_2", "value_lag_5", "value_lag_10"])
def q_lag_features(spark, sf_dir):
    """Lags 1, 2, 5, 10 of the value channel per event type."""
    rec = B.events_recordings(spark, sf_dir, "event_type")
    return windows.lag_features(rec, ["event_type"], "sample_idx", "value").drop("ts")


_LAGCORR_SQL = f"""
WITH l AS ({_LAG_SQL}),
p AS (
  SELECT event_type, 1 AS lag, value AS x, value_lag_1 AS y FROM l UNION ALL
  SELECT event_type, 2, value, value_lag_2 FROM l UNION ALL
  SELECT event_type, 5, value, value_lag_5 FROM l UNION ALL
  SELECT event_type, 10, value, value_lag_10 FROM l)
SELECT event_type, lag, count(y) AS n_pairs, corr(x, y) AS corr FROM p GROUP BY event_type, lag"""


@register("lag_correlation", sql=_LAGCORR_SQL, dbl=["corr"], absr=["corr"])
def q_lag_correlation(spark, sf_dir):
    """r(x_t, x_{t-k}) per event type for k = 1, 2, 5, 10."""
    rec = B.events_recordings(spark, sf_dir, "event_type")
    return windows.lag_correlation(rec, ["event_type"], "sample_idx", "value").withColumn(
        "lag", F.col("lag").cast("int"))


_ROC_SQL = f"""
SELECT event_type, event_id, sample_idx, value,
  value - lag(value) OVER w AS value_diff,
  CASE WHEN lag(value) OVER w = 0 AND value - lag(value) OVER w <> 0 THEN 0.0
       ELSE (value - lag(value) OVER w) / nullif(lag(value) OVER w, 0) END AS value_pct_change,
  CASE WHEN count(value) OVER w5 = 5 THEN regr_slope(value, sample_idx) OVER w5 END AS value_slope
FROM ({_sql_events_idx("event_type")}) e
WINDOW w AS (PARTITION BY event_type ORDER BY sample_idx),
       w5 AS (PARTITION BY event_type ORDER BY sample_idx ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""


@register("diff_pct_change", sql=_ROC_SQL, dbl=["value", "value_diff", "value_pct_change", "value_slope"])
def q_diff_pct_change(spark, sf_dir):
    """First difference, percent change (inf -> 0) and 5-sample slope."""
    rec = B.events_recordings(spark, sf_dir, "event_type")
    return windows.rate_of_change(rec, ["event_type"], "sample_idx", "value", 5).drop("ts")


_ROLLSTD_SQL = f"""
SELECT event_type, event_id, sample_idx, value,
  CASE WHEN count(value) OVER w = 100 THEN stddev_samp(value) OVER w END AS value_roll_std_100
FROM ({_sql_events_idx("event_type")}) e
WINDOW w AS (PARTITION BY event_type ORDER BY sample_idx ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)"""


@register("rolling_std_100", sql=_ROLLSTD_SQL, dbl=["value", "value_roll_std_100"])
def q_rolling_std_100(spark, sf_dir):
    """100-sample rolling sample std per event type (O(1) per row from running sums)."""
    rec = B.events_recordings(spark, sf_dir, "event_type")
    return windows.rolling_std_rows(rec, ["event_type"], "sample_idx", "value", 100).drop("ts")


_SHIFTED = "CASE WHEN sample_idx = 0 THEN 0.0 ELSE value + 1e8 END"


@register("rolling_std_offset", sql=f"""
WITH e AS (SELECT event_type, event_id, sample_idx, {_SHIFTED} AS value FROM ({_sql_events_idx("event_type")}) x)
SELECT event_type, event_id, sample_idx, value,
  CASE WHEN count(value) OVER w = 100 THEN stddev_samp(value) OVER w END AS value_roll_std_100
FROM e WINDOW w AS (PARTITION BY event_type ORDER BY sample_idx ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)""",
          dbl=["value", "value_roll_std_100"], digits=6)
def q_rolling_std_offset(spark, sf_dir):
    """W1 on values far from zero after a first sample of zero (a sensor that starts up)."""
    rec = B.events_recordings(spark, sf_dir, "event_type").withColumn("value", F.expr(_SHIFTED))
    return windows.rolling_std_rows(rec, ["event_type"], "sample_idx", "value", 100).drop("ts")


@register("all_null_channel", sql="""
SELECT event_type, count(*) AS n_samples, """ + ", ".join(f"CAST(NULL AS DOUBLE) AS none_{s}" for s in STAT9) + """
FROM events GROUP BY event_type""", dbl=[f"none_{s}" for s in STAT9])
def q_all_null_channel(spark, sf_dir):
    """A channel without any value gives NULL features."""
    e = B.table(spark, sf_dir, "events").withColumn("none", F.lit(None).cast("double"))
    return features.recording_features(e, ["event_type"], ["none"])


_FRAME_CH = B.LINEITEM_CHANNELS


def _blank(c: str) -> str:
    return (f"CASE WHEN CAST('0x' || substr(md5(concat_ws('|', CAST(l_suppkey AS VARCHAR), '{c}', '42')), 1, 15) AS BIGINT)"
            f" / 1152921504606846976.0 < 0.2 THEN NULL ELSE {c} END")


@register("feature_frame", sql=f"""
SELECT l_suppkey, coalesce({_blank("l_quantity_mean")}, 0.0) AS l_quantity_mean, l_extendedprice_mean, l_discount_mean, l_tax_mean,
  CAST(l_suppkey % 2 AS INTEGER) AS fault_label
FROM ({_sql_features("lineitem", "l_suppkey", _FRAME_CH)}) f WHERE {_blank("l_tax_mean")} IS NOT NULL""",
          dbl=[f"{c}_mean" for c in _FRAME_CH])
def q_feature_frame(spark, sf_dir):
    """A feature table with blanked cells: rows without a tax mean dropped, missing quantity means set to 0,
    features and target picked by name."""
    f = features.recording_features(B.lineitem_recordings(spark, sf_dir), ["l_suppkey"], _FRAME_CH)
    f = f.withColumn("fault_label", (F.col("l_suppkey") % 2).cast("int"))
    f = cleaning.inject_nulls(f, ["l_quantity_mean", "l_tax_mean"], rate=0.2, id_cols=["l_suppkey"])
    f = cleaning.fill_zero(cleaning.drop_nulls(f, ["l_tax_mean"]), ["l_quantity_mean"])
    names = [c for c in cleaning.columns_like(f, "_mean") if c in cleaning.feature_columns(f)]
    return f.select("l_suppkey", *names, *cleaning.select_target(f).columns)


def _sql_summary(src: str, key: str, channels: list[str], order: str) -> str:
    """DuckDB twin of ``recording_summary``: A1-A9 per channel plus the mean
    of the 100-row rolling sample std (std when there is no full window)."""
    means = ", ".join(f"avg({c}) AS __m_{c}" for c in channels)
    stats = ",\n  ".join(_sql_channel_stats(c, f"__m_{c}") for c in channels)
    rolls = ", ".join(f"CASE WHEN count({c}) OVER w = 100 THEN stddev_samp({c}) OVER w END AS __rs_{c}"
                      for c in channels)
    rmeans = ", ".join(f"avg(__rs_{c}) AS __rsm_{c}" for c in channels)
    outs = ", ".join(f"coalesce(__rm.__rsm_{c}, __f.{c}_std) AS {c}_roll_std" for c in channels)
    return f"""
WITH __s AS ({src}),
__m AS (SELECT {key}, {means} FROM __s GROUP BY {key}),
__r AS (SELECT {key}, {rolls} FROM __s
        WINDOW w AS (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)),
__rm AS (SELECT {key}, {rmeans} FROM __r GROUP BY {key}),
__f AS (SELECT t.{key}, {stats} FROM __s t JOIN __m USING ({key}) GROUP BY t.{key})
SELECT __f.*, {outs} FROM __f JOIN __rm USING ({key})"""


_FILE_CH = ["value", "k"]
_FILE_SRC = ("SELECT event_type || '|' || weekofyear(ts) AS rec, ts, event_id, value, "
             "CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events")
_FILE_SQL = f"""
SELECT s.* EXCLUDE (rec), split_part(rec, '|', 1) AS severity,
  CAST(CASE WHEN split_part(rec, '|', 1) = 'error' THEN 1 ELSE 0 END AS INTEGER) AS fault_label
FROM ({_sql_summary(_FILE_SRC, "rec", _FILE_CH, "ts, event_id")}) s"""


@register("file_recordings", sql=_FILE_SQL, dbl=_dbl(_FILE_CH, STAT9 + ["roll_std"]),
          absr=[f"{c}_{s}" for c in _FILE_CH for s in ("kurt", "skew")])
def q_file_recordings(spark, sf_dir):
    """Events written as headerless CSV recordings
    (one file per event type and week, class from the folder), then scanned, put in
    file order, interpolated, summarised (10 statistics per channel) and
    median-filled by the library."""
    from tremor.plans import flows
    root = B.events_csv_recordings(spark, sf_dir)
    return flows.feature_table(spark, root, channels=_FILE_CH).drop("file_path")


@register("first_rows", sql="""
SELECT event_type AS severity, CAST(weekofyear(ts) AS BIGINT) AS week, i AS sample_idx, value, k FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, weekofyear(ts) ORDER BY ts, event_id) - 1 AS i,
    CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events) e WHERE i < 50""", dbl=["value", "k"])
def q_first_rows(spark, sf_dir):
    """The first 50 rows of each recording file, in file order."""
    from tremor.sources.recordings import read_recordings
    root = B.events_csv_recordings(spark, sf_dir)
    rec = read_recordings(spark, root, _FILE_CH, max_rows=50)
    week = F.regexp_extract("file_path", "week(?:=|%3D)([0-9]+)", 1).cast("long")
    return rec.select("severity", week.alias("week"), "sample_idx", "value", "k")
