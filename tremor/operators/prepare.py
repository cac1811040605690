"""Scaling, stratified split, class weights and oversampling.

Fitted statistics are one-row tables (one column per feature), broadcast
and attached to the data.  Ranks inside a class come from
:func:`tremor.operators.ordering.prefix_sums`, so a class holding most rows
is still cut over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremor.functions import fitted, hash_bigint, hash_unit
from tremor.operators.cleaning import unpivot
from tremor.operators.neighbours import nearest_neighbours
from tremor.operators.ordering import prefix_sums
from tremor.operators.selection import quantiles, select_ranks
from tremor.session import cut_lineage

METHODS = ("standard", "minmax", "robust")
STRETCH = 1 << 16  # draws that one row of the drawing plan stands for


def fit_scaler(df: DataFrame, cols: Sequence[str], method: str = "standard") -> DataFrame:
    """The fitted centre and scale of every column, one row, columns
    ``<c>__c`` and ``<c>__s``.

    standard: mean and population std; minmax: min and max - min; robust:
    median and IQR (exact quantiles).  A zero scale becomes 1, so a constant
    column maps to 0 (sklearn).  Unknown method -> ValueError.
    """
    if method not in METHODS:
        raise ValueError(f"Unknown scaling method: {method}")
    long = unpivot(df, cols).where(F.col("value").isNotNull())
    if method == "standard":
        st = long.groupBy("feature").agg(F.avg("value").alias("c"), F.stddev_pop("value").alias("s"))
    elif method == "minmax":
        st = long.groupBy("feature").agg(F.min("value").alias("c"),
                                         (F.max("value") - F.min("value")).alias("s"))
    else:
        q = quantiles(long, ["feature"], "value", [0.25, 0.5, 0.75], names=["q1", "q2", "q3"])
        st = q.select("feature", F.col("q2").alias("c"), (F.col("q3") - F.col("q1")).alias("s"))
    st = st.select("feature", "c", F.when(F.col("s") == 0, F.lit(1.0)).otherwise(F.col("s")).alias("s"))
    wide = st.groupBy().pivot("feature", list(cols)).agg(F.first(F.struct("c", "s")))
    return wide.select(*[c for col in cols for c in (F.col(f"`{col}`.c").alias(f"{col}__c"),
                                                      F.col(f"`{col}`.s").alias(f"{col}__s"))])


def apply_scaler(df: DataFrame, fitted: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - centre) / scale with a fitted one-row table.

    The single fitted row (one centre and one scale per column) is broadcast
    and attached by an equi-join on a constant; with many columns this keeps
    the plan small (a scalar subquery would be copied into every column
    expression).
    """
    one = F.broadcast(fitted.limit(1).withColumn("__one", F.lit(1)))
    d = df.withColumn("__one", F.lit(1)).join(one, on="__one", how="inner")
    return d.select(*[((F.col(c) - F.col(f"{c}__c")) / F.col(f"{c}__s")).alias(c) if c in cols
                      else F.col(c) for c in df.columns])


def scale(df: DataFrame, cols: Sequence[str], method: str = "standard",
          fit_on: DataFrame | None = None) -> DataFrame:
    """Fit on ``fit_on`` (default: ``df`` itself) and transform ``df``."""
    return apply_scaler(df, fit_scaler(fit_on if fit_on is not None else df, cols, method), cols)


def stratified_split(
    df: DataFrame,
    label: str,
    id_col: str,
    test_size: float = 0.2,
    seed: int = 42,
    stratify: bool = True,
) -> DataFrame:
    """Adds ``is_test``.  Exact sizes, repeatable.

    Total test size = ceil(test_size * n) (sklearn).  With ``stratify`` it is
    shared out over classes in proportion: floor of each share, then the
    remainder to the classes with the largest fractional parts (ties: lower
    label).  Inside a class, rows are ranked by md5(id, seed) and the first
    ones form the test set.
    """
    d = df.withColumn("__h", hash_bigint([id_col], seed))
    key = label if stratify else "__all"
    if not stratify:
        d = d.withColumn("__all", F.lit(0))
    sizes = d.groupBy(key).agg(F.count(F.lit(1)).alias("__nc"))
    w_all = Window.partitionBy(F.lit(0))
    n = F.sum("__nc").over(w_all)
    n_test = F.ceil(F.lit(float(test_size)) * n)
    # n_test * n_c = floor * n + rest, in whole numbers that may exceed a long
    share = sizes.select(key, "__nc", n.cast("decimal(38,0)").alias("__n"), n_test.cast("long").alias("__nt"),
                         (n_test.cast("decimal(19,0)") * F.col("__nc").cast("decimal(19,0)")).cast("decimal(38,0)").alias("__prod"))
    share = share.withColumn("__rest", F.col("__prod") % F.col("__n"))
    share = share.withColumn("__fl", ((F.col("__prod") - F.col("__rest")) / F.col("__n")).cast("long"))
    w_frac = Window.partitionBy(F.lit(0)).orderBy(F.col("__rest").desc(), F.col(key))
    left = F.col("__nt") - F.sum("__fl").over(w_all)
    share = share.withColumn("__rk", F.row_number().over(w_frac)).withColumn(
        "__take", (F.col("__fl") + F.when(F.col("__rk") <= left, 1).otherwise(0)).cast("long"))
    # the hash of the last test row and that of the row after it; rows are compared with it, not sorted
    last = lambda n: F.array(*[F.struct(F.lit(i).alias("id"), (F.col("__take") - 1 + i).alias("rank")) for i in (0, 1)])
    found = select_ranks(d, [key], "__h", last, wanted=share.select(key, "__take"))
    cuts = cut_lineage(found.groupBy(F.col(key).alias("__k")).agg(
        F.max(F.when(F.col("id") == 0, F.col("value"))).alias("__cut"), F.max(F.when(F.col("id") == 1, F.col("value"))).alias("__next")))
    d = d.join(cuts, on=F.col(key).eqNullSafe(F.col("__k")), how="left")  # a NULL label is a class like any other
    chosen = F.coalesce(F.col("__h") <= F.col("__cut"), F.lit(False))
    tied = cuts.where("__cut = __next")
    if tied.isEmpty():
        return d.select(*df.columns, chosen.alias("is_test"))
    # rows of one hash on both sides of a cut: the first ones by id
    split = F.coalesce((F.col("__cut") == F.col("__next")) & (F.col("__h") == F.col("__cut")), F.lit(False))
    below = d.where(F.col("__cut") == F.col("__next")).groupBy("__k").agg(F.count(F.when(F.col("__h") < F.col("__cut"), 1)).alias("__below"))
    room = below.join(share.select(F.col(key).alias("__s"), "__take"), F.col("__k").eqNullSafe(F.col("__s"))).select(
        F.col("__k").alias("__t"), (F.col("__take") - F.col("__below")).alias("__room"))
    few = d.where(split).join(room, F.col("__k").eqNullSafe(F.col("__t")))
    place = F.row_number().over(Window.partitionBy("__k").orderBy(id_col))
    return (d.where(~split).select(*df.columns, chosen.alias("is_test"))
            .unionByName(few.select(*df.columns, (place <= F.col("__room")).alias("is_test"))))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (k * n_c) per class (k = number of classes)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    w = Window.partitionBy(F.lit(0))
    return c.select(label, "n_c",
                    (F.sum("n_c").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_c"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Adds the balanced weight column (for ``weightCol``); the per-class
    table has one row per class (AQE broadcasts it at run time)."""
    w = class_weights(df, label).select(label, F.col("weight").alias(name))
    return df.join(w, on=[label], how="left")


def pos_weight(df: DataFrame, label: str) -> DataFrame:
    """n_negative / n_positive (one row)."""
    return df.agg(F.try_divide(F.count(F.when(F.col(label) == 0, 1)).cast("double"),
                               F.count(F.when(F.col(label) == 1, 1))).alias("scale_pos_weight"))


def oversample_random(df: DataFrame, label: str, id_col: str, seed: int = 42) -> DataFrame:
    """Draw rows of every smaller class with replacement until each class
    has as many rows as the largest; adds ``synthetic`` and ``draw``.

    Draw j of class c takes the row of rank md5(c, j, seed) mod n_c.  Draws are numbered from the table of class sizes, in
    stretches of ``STRETCH`` over many partitions, and joined to the class rows on (class, rank): no group is held whole and
    nothing is read on the driver.  A NULL class is one like others.
    """
    sizes = df.groupBy(F.col(label).alias("__c")).agg(F.count(F.lit(1)).alias("__n"))
    need = fitted(sizes.agg(F.max("__n").alias("top"))).getField("top") - F.col("__n")
    stretch = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__need") - 1) / STRETCH)))
    within = F.sequence(F.col("__s") * STRETCH, F.least(F.col("__need"), (F.col("__s") + 1) * STRETCH) - 1)
    draws = (sizes.withColumn("__need", need).where("__need > 0").withColumn("__s", stretch).repartition("__c", "__s")
             .withColumn("draw", F.explode(within))
             .select("__c", "draw", F.pmod(hash_bigint([F.col("__c"), F.col("draw")], seed), F.col("__n")).alias("__rank")))
    ranked = prefix_sums(df.withColumn("__one", F.lit(1).cast("long")), [label], [hash_bigint([id_col], seed), id_col], ["__one"],
                         prefix="__r")
    extra = draws.join(ranked, on=draws["__c"].eqNullSafe(ranked[label]) & (draws["__rank"] == ranked["__r__one"] - 1), how="inner")
    base = df.withColumns({"synthetic": F.lit(False), "draw": F.lit(None).cast("long")})
    return base.unionByName(extra.withColumn("synthetic", F.lit(True)).select(*base.columns))


def balanced_counts(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """Class counts before and after balancing."""
    a = before.groupBy(label).agg(F.count(F.lit(1)).alias("n")).withColumn("stage", F.lit("before"))
    b = after.groupBy(label).agg(F.count(F.lit(1)).alias("n")).withColumn("stage", F.lit("after"))
    return a.unionByName(b)


def smote(df: DataFrame, label: str, id_col: str, vec: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Synthetic minority rows x + u * (neighbour - x) until the two
    classes are equal; k = min(k, n_minority - 1); with k < 1 random
    oversampling is used instead (the reference's fall-back).

    Synthetic row j takes base point (rank of md5(id) in the minority) and
    neighbour slot from md5(j, seed) mod (n_min * k), and u from md5(j,
    seed + 1); the draws come from ``spark.range`` and are joined to the
    base points and their nearest neighbours
    (:func:`tremor.operators.neighbours.nearest_neighbours`).  Output: the
    input rows plus synthetic ones (``synthetic`` true, ``base_id``, ``nb_id``,
    ``u``; these three are NULL on drawn copies).
    """
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) != 2:
        raise ValueError("SMOTE needs exactly two classes")
    (c_min, n_min), (c_maj, n_maj) = sorted(counts.items(), key=lambda t: (t[1], t[0]))
    kk = min(k, n_min - 1)
    base = df.select(id_col, label, F.col(vec).cast("array<double>").alias(vec)).withColumns({
        "synthetic": F.lit(False), "draw": F.lit(None).cast("long"), "base_id": F.lit(None).cast(df.schema[id_col].dataType),
        "nb_id": F.lit(None).cast(df.schema[id_col].dataType), "u": F.lit(None).cast("double")})
    need = n_maj - n_min
    if kk < 1:
        drawn = oversample_random(df, label, id_col, seed)
        return drawn.select(id_col, label, F.col(vec).cast("array<double>").alias(vec), "synthetic", "draw",
                            *[F.lit(None).cast(base.schema[c].dataType).alias(c) for c in ("base_id", "nb_id", "u")])
    if need == 0:
        return base
    mino = df.where(F.col(label) == F.lit(c_min)).select(F.col(id_col).alias("id"),
                                                          F.col(vec).cast("array<double>").alias("x"))
    nn = nearest_neighbours(mino, "id", "x", kk).select("id", "slot", "nb_id")
    hr = prefix_sums(mino.withColumn("__one", F.lit(1).cast("long")), [],
                     [hash_bigint(["id"], seed), "id"], ["__one"], prefix="__r") \
        .select("id", "x", (F.col("__r__one") - 1).alias("hrank"))
    spark = df.sparkSession
    pick = F.pmod(hash_bigint([F.col("draw")], seed), F.lit(n_min * kk))
    draws = spark.range(need).select(F.col("id").alias("draw")).select(
        "draw", (pick / F.lit(kk)).cast("long").alias("hrank"), (pick % F.lit(kk)).cast("int").alias("slot"),
        hash_unit([F.col("draw")], seed + 1).alias("u"))
    j = draws.join(hr, "hrank").join(nn, ["id", "slot"]).join(
        mino.select(F.col("id").alias("nb_id"), F.col("x").alias("nbx")), "nb_id")
    new = F.zip_with(F.col("x"), F.col("nbx"), lambda a, b: a + F.col("u") * (b - a))
    syn = j.select(F.lit(None).cast(df.schema[id_col].dataType).alias(id_col),
                   F.lit(c_min).cast(df.schema[label].dataType).alias(label), new.alias(vec),
                   F.lit(True).alias("synthetic"), "draw", F.col("id").alias("base_id"), "nb_id", "u")
    return base.unionByName(syn)


def smote_columns(df: DataFrame, cols: Sequence[str], label: str, id_col: str, k: int = 5, seed: int = 42) -> DataFrame:
    """B6 on a wide table: SMOTE over the columns ``cols`` (no nulls); other columns are NULL on synthetic rows."""
    out = smote(df.withColumn("__v", F.array(*[F.col(c).cast("double") for c in cols])), label, id_col, "__v", k, seed)
    wide = out.select(id_col, label, *[F.col("__v")[i].alias(c) for i, c in enumerate(cols)], "synthetic", "draw", "base_id", "nb_id", "u")
    rest = [c for c in df.columns if c not in (id_col, label, *cols)]
    if rest:
        own = df.select(F.col(id_col).alias("__id"), *rest)
        wide = wide.join(own, F.col(id_col) == F.col("__id"), "left").drop("__id")
    return wide.select(*df.columns, "synthetic", "draw", "base_id", "nb_id", "u")
