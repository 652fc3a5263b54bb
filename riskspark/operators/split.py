"""Stratified, repeatable train/test split and fold assignment.

Order inside each class is by ``md5(seed|id)``, a pure function of the key, so
the split never depends on row order, partitioning or recompute.  The rank
inside a class is computed in two levels so no class (which may hold nearly all
rows) is ever ranked in one task:

1. ``b`` = first four hex digits of the hash (65,536 buckets, near uniform,
   enough window tasks for a large cluster); count rows per (class, b) - a
   frame of at most classes x 65,536 rows;
2. running sum of those counts inside the class gives each bucket's offset;
   broadcast back (bounded by the same 131,072 rows for a binary label);
3. ``rank = offset + row_number() over (partition by class, b order by h, id)``.

Test rows: ``rank <= rint(test_size * n_class)``.  Train rows get
``fold = (rank - n_test_class - 1) mod n_folds``, stratified as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K

HASH_PREFIX = 4  # hex digits -> 16**4 buckets


def id_hash(key: str, seed: int = K.RANDOM_STATE) -> F.Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def stratified_rank(df: DataFrame, label: str = K.LABEL, key: str = K.KEY,
                    seed: int = K.RANDOM_STATE) -> DataFrame:
    """Adds ``__rank`` (1-based, per class) and ``__n_class``; unlabelled rows
    get null rank."""
    h = id_hash(key, seed)
    base = df.withColumn("__h", h).withColumn("__b", F.substring("__h", 1, HASH_PREFIX))
    labelled = base.where(F.col(label).isNotNull())
    counts = labelled.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__cnt"))
    w_before = Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        label, "__b",
        F.coalesce(F.sum("__cnt").over(w_before), F.lit(0)).alias("__before"),
        F.sum("__cnt").over(Window.partitionBy(label)).alias("__n_class"),
    )
    # offsets has at most (#classes x 65,536) rows: broadcast is size-bounded.
    # A left join keeps unlabelled rows in the same pass: their null label
    # matches no offset, so their rank and class size stay null.
    ranked = base.join(F.broadcast(offsets), [label, "__b"], "left")
    w = Window.partitionBy(label, "__b").orderBy("__h", key)
    ranked = ranked.withColumn("__rank", F.col("__before") + F.row_number().over(w)) \
        .drop("__before")
    return ranked.drop("__b")


def stratified_split(df: DataFrame, label: str = K.LABEL, key: str = K.KEY,
                     test_size: float = K.TEST_SIZE, n_folds: int = K.N_FOLDS,
                     seed: int = K.RANDOM_STATE) -> DataFrame:
    """Adds ``split`` ("train"/"test", null when unlabelled) and ``fold``
    (0..n_folds-1 on train rows, null elsewhere)."""
    r = stratified_rank(df, label, key, seed)
    n_test = F.rint(F.col("__n_class") * F.lit(float(test_size))).cast("long")
    is_test = F.col("__rank") <= n_test
    split = F.when(F.col("__rank").isNull(), F.lit(None).cast("string")) \
        .when(is_test, F.lit("test")).otherwise(F.lit("train"))
    fold = F.when(F.col("__rank").isNotNull() & ~is_test,
                  F.pmod(F.col("__rank") - n_test - 1, F.lit(n_folds)).cast("int"))
    return r.withColumn("split", split).withColumn("fold", fold) \
        .drop("__h", "__rank", "__n_class")
