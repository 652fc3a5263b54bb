"""Target-leakage audit (I1 with B6, B9, H8).

All numeric columns are audited at once: a row's columns are its scores, ranked
by ``stages.ranked_scores``.  Tasks count each column's values by bucket; only
values that share a stretch between bucket edges with the other class are
shuffled, once, to be ranked there.  Nothing is unpivoted or written.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.formatting import fold_auc
from .quality import numeric_columns
from .stages import ranked_scores

SCHEMA = "column_name string, n_values long, auc double, auc_folded double, suspicious boolean, status string"


def column_auc(df: DataFrame, cols: list[str], label: str = K.LABEL) -> DataFrame:
    """(column_name, n_values, auc_roc) of each column against the label; rows
    without a label, and null and NaN values, are left out."""
    x = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in cols])
    ranked = ranked_scores(df.select(F.col(label).alias("label"), x.alias("x")), "x", label="label")
    name = F.get(F.array(*[F.lit(c) for c in cols]), F.col("score"))
    return ranked.exact().select(name.alias("column_name"), (F.col("n_pos") + F.col("n_neg")).alias("n_values"),
                                 F.col("auc").alias("auc_roc"))


def leakage_audit(df: DataFrame, label: str = K.LABEL, key: str = K.KEY,
                  exclude: Iterable[str] = (), threshold: float = K.LEAKAGE_AUC,
                  min_values: int = K.LEAKAGE_MIN_VALUES) -> DataFrame:
    """Per numeric column: non-null count, AUC of raw value vs label, folded
    AUC, suspicious flag and a status (``ok``, ``too_few_values``,
    ``one_class``) instead of a swallowed error.  ``df`` is read several times:
    pass a written table.
    """
    cols = numeric_columns(df, exclude={key, label, *exclude})
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], SCHEMA)
    names = spark.createDataFrame([(c,) for c in cols], "column_name string")
    res = names.join(column_auc(df, cols, label), "column_name", "left")
    n = F.coalesce(F.col("n_values"), F.lit(0)).cast("long")
    enough = n >= min_values
    auc = F.when(enough, F.col("auc_roc"))
    folded = fold_auc(auc)
    return res.select(
        "column_name",
        n.alias("n_values"),
        auc.alias("auc"),
        folded.alias("auc_folded"),
        F.coalesce(folded > F.lit(threshold), F.lit(False)).alias("suspicious"),
        F.when(~enough, F.lit("too_few_values"))
        .when(F.col("auc_roc").isNull(), F.lit("one_class"))
        .otherwise(F.lit("ok")).alias("status"),
    )


def suspicious_columns(audit: DataFrame) -> DataFrame:
    """The flagged columns only."""
    return audit.where(F.col("suspicious"))
