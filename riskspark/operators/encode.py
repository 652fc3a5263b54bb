"""Column-wise preprocessing fit on train rows only.

* numeric: exact median imputation, then standardisation by the population
  std of the imputed column (zero std divides by 1); all-null columns are
  dropped, as the imputer does;
* low-cardinality text: null -> "missing", one-hot over the train categories
  in sorted order; an unseen category gives all zeros;
* high-cardinality text: target encoding with variance-based shrinkage; train
  rows are encoded out of fold (from the other folds' statistics), every other
  row from the full train fit; an unseen category gets the overall mean.

Fitted parameters are small: per-column scalars and category lists go through
the driver (bounded by the number of columns and, for one-hot, by the
cardinality cut), target-encoding maps stay DataFrames derived from one
checkpointed statistics table, and are broadcast only when their row count is
proven small.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..session import materialize
from .joins import BROADCAST_MAX_ROWS
from .quality import categorical_columns, column_cardinality, numeric_columns
from .selection import column_quantiles

NULL_CATEGORY = "\u0000null"


@dataclass
class ColumnGroups:
    numeric: list[str]
    low_card: list[str]
    high_card: list[str]


def identify_column_types(df: DataFrame, exclude: Sequence[str] = (),
                          cut: int = K.CARDINALITY_CUT) -> ColumnGroups:
    """B2 + D8: numeric columns, and text columns routed by distinct count."""
    numeric = numeric_columns(df, exclude)
    cats = categorical_columns(df, exclude)
    card = {r["column_name"]: r["n_distinct"] for r in column_cardinality(df, cats, cut).collect()}
    return ColumnGroups(numeric=numeric,
                        low_card=[c for c in cats if card.get(c, 0) < cut],
                        high_card=[c for c in cats if card.get(c, 0) >= cut])


@dataclass
class TargetEncoding:
    column: str
    full: DataFrame        # cat -> enc (full train fit)
    oof: DataFrame         # (fold, cat) -> enc (other folds)
    fold_mean: DataFrame   # fold -> mean label of the other folds
    mean: float            # overall train mean
    rows: int              # rows of the largest of the three maps, counted in the fit


@dataclass
class Preprocessor:
    groups: ColumnGroups
    medians: dict[str, float] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    scales: dict[str, float] = field(default_factory=dict)
    categories: dict[str, list[str]] = field(default_factory=dict)
    target: dict[str, TargetEncoding] = field(default_factory=dict)

    def feature_names(self) -> list[str]:
        """Names after the transformer prefix is cut."""
        names = [c for c in self.groups.numeric if c in self.medians]
        for c in self.groups.low_card:
            names += [f"{c}_{v}" for v in self.categories[c]]
        names += list(self.groups.high_card)
        return names

    def params_frame(self, spark) -> DataFrame:
        """Fitted numeric parameters as a table (column, median, mean, scale)."""
        rows = [(c, self.medians[c], self.means[c], self.scales[c]) for c in self.medians]
        return spark.createDataFrame(rows, "column_name string, median double, mean double, scale double")

    def save(self, path: str) -> str:
        """A10: scalars and category lists as one JSON document, target
        encoding maps as Parquet tables, all under ``path``."""
        spark = next(iter(self.target.values())).full.sparkSession if self.target else None
        from pyspark.sql import SparkSession
        spark = spark or SparkSession.getActiveSession()
        doc = {"groups": {"numeric": self.groups.numeric, "low_card": self.groups.low_card,
                          "high_card": self.groups.high_card},
               "medians": self.medians, "means": self.means, "scales": self.scales,
               "categories": self.categories,
               "target_means": {c: te.mean for c, te in self.target.items()}}
        spark.createDataFrame([(json.dumps(doc, sort_keys=True),)], "doc string") \
            .coalesce(1).write.mode("overwrite").text(f"{path}/params")
        for c, te in self.target.items():
            for part in ("full", "oof", "fold_mean"):
                getattr(te, part).write.mode("overwrite").parquet(f"{path}/target/{c}/{part}")
        return path

    def transform(self, df: DataFrame, split_col: str = "split", fold_col: str = "fold",
                  keep: Sequence[str] = (K.KEY, K.LABEL, "split", "fold")) -> DataFrame:
        out = df
        enc_cols = []
        # rows without split/fold (new applicants, streams) take the full fit
        has_folds = split_col in df.columns and fold_col in df.columns
        for c, te in self.target.items():
            key = F.coalesce(F.col(c), F.lit(NULL_CATEGORY))
            out = out.withColumn(f"__cat_{c}", key)
            full = te.full.withColumnRenamed("cat", f"__cat_{c}").withColumnRenamed("enc", f"__full_{c}")
            small = F.broadcast if te.rows <= BROADCAST_MAX_ROWS else (lambda df: df)
            out = out.join(small(full), f"__cat_{c}", "left")
            full_enc = F.coalesce(F.col(f"__full_{c}"), F.lit(te.mean))
            if has_folds:
                oof = (te.oof.withColumnRenamed("cat", f"__cat_{c}").withColumnRenamed("enc", f"__oof_{c}")
                       .withColumnRenamed("fold", fold_col))
                fm = te.fold_mean.withColumnRenamed("fold", fold_col).withColumnRenamed("mean", f"__fm_{c}")
                out = (out.join(small(oof), [fold_col, f"__cat_{c}"], "left")
                       .join(small(fm), fold_col, "left"))
                is_train = (F.col(split_col) == "train") & F.col(fold_col).isNotNull()
                enc = F.when(is_train, F.coalesce(F.col(f"__oof_{c}"), F.col(f"__fm_{c}"))).otherwise(full_enc)
            else:
                enc = full_enc
            enc_cols.append(enc.alias(c))
        cols = [F.col(k) for k in keep if k in df.columns]
        for c in self.groups.numeric:
            if c not in self.medians:
                continue
            v = F.coalesce(_number(c), F.lit(self.medians[c]))
            cols.append(((v - F.lit(self.means[c])) / F.lit(self.scales[c])).alias(c))
        for c in self.groups.low_card:
            v = F.coalesce(F.col(c), F.lit(K.MISSING_CATEGORY))
            for cat in self.categories[c]:
                cols.append(F.when(v == F.lit(cat), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{c}_{cat}"))
        cols += enc_cols
        return out.select(*cols)


def _number(c: str) -> F.Column:
    """A numeric column as double, NaN as null."""
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


def _moments(train: DataFrame, cols: list[str]) -> dict[str, tuple]:
    """{column: (rows, values, their mean, their population std)} in one pass."""
    if not cols:
        return {}
    stats = [f(_number(c)).alias(f"{n}_{i}") for i, c in enumerate(cols)
             for n, f in (("n", F.count), ("m", F.avg), ("s", F.stddev_pop))]
    row = train.agg(F.count(F.lit(1)).alias("rows"), *stats).first()
    return {c: (row["rows"], row[f"n_{i}"], row[f"m_{i}"], row[f"s_{i}"]) for i, c in enumerate(cols)}


def _imputed(medians: dict[str, float], moments: dict[str, tuple], cols: list[str]) -> tuple[dict, dict, dict]:
    """Medians, and means and scales of the columns once nulls are their median: the
    values' moments joined with those of as many medians as there are nulls."""
    means, scales = {}, {}
    kept = [c for c in cols if c in medians]
    for c in kept:
        rows, n, mean, std = moments[c]
        if std == 0:  # one value, which the mean may miss by its rounding
            mean = medians[c]
        gap, share = medians[c] - mean, (rows - n) / rows
        means[c] = mean + gap * share
        scale = math.sqrt((n / rows) * (std * std + gap * gap * share))
        scales[c] = scale if scale > 0 else 1.0
    return {c: float(medians[c]) for c in kept}, means, scales


def _fit_onehot(train: DataFrame, cols: list[str]) -> dict[str, list[str]]:
    if not cols:
        return {}
    long = (train.select(*[F.coalesce(F.col(c), F.lit(K.MISSING_CATEGORY)).alias(c) for c in cols])
            .unpivot([], cols, "column_name", "value").distinct())
    cats: dict[str, list[str]] = {c: [] for c in cols}
    # low-cardinality by routing: at most cut values + "missing" per column;
    # the collect is capped and checked rather than trusted
    bound = len(cols) * (K.CARDINALITY_CUT + 1)
    rows = long.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"one-hot columns {cols} have more than {K.CARDINALITY_CUT} categories")
    for r in rows:
        cats[r["column_name"]].append(r["value"])
    return {c: sorted(v) for c, v in cats.items()}


def shrink(n, s, ss, M, V) -> F.Column:
    """Variance shrinkage: lambda = V n / (V n + s2), enc = lambda m + (1-lambda) M."""
    m = s / n
    s2 = ss / n - m * m
    s2 = F.greatest(s2, F.lit(0.0))
    denom = V * n + s2
    lam = (V * n) / denom
    return F.when(n <= 0, M).when(denom == 0, M).otherwise(lam * m + (F.lit(1.0) - lam) * M)


def _fit_target(train: DataFrame, col: str, label: str, fold_col: str) -> TargetEncoding:
    y = F.col(label).cast("double")
    cat = F.coalesce(F.col(col), F.lit(NULL_CATEGORY))
    # one shuffle: statistics per (fold, category)
    st = (train.select(F.col(fold_col).alias("fold"), cat.alias("cat"), y.alias("y"))
          .groupBy("fold", "cat")
          .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("ss")))
    st = materialize(st)
    # totals by category and by fold (both bounded by categories or folds)
    by_cat = st.groupBy("cat").agg(F.sum("n").alias("cn"), F.sum("s").alias("cs"), F.sum("ss").alias("css"))
    tot = st.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.count(F.lit(1)).alias("rows")).first()
    N, S, SS = float(tot["n"]), float(tot["s"]), float(tot["ss"])
    M = S / N
    V = max(SS / N - M * M, 0.0)
    full = by_cat.select("cat", shrink(F.col("cn"), F.col("cs"), F.col("css"),
                                       F.lit(M), F.lit(V)).alias("enc"))
    by_fold = st.groupBy("fold").agg(F.sum("n").alias("fn"), F.sum("s").alias("fs"), F.sum("ss").alias("fss"))
    # statistics of the other folds: totals minus this fold
    rest = by_fold.select("fold", (F.lit(N) - F.col("fn")).alias("rn"), (F.lit(S) - F.col("fs")).alias("rs"),
                          (F.lit(SS) - F.col("fss")).alias("rss"))
    rest = rest.select("fold", "rn", (F.col("rs") / F.col("rn")).alias("rM"),
                       F.greatest(F.col("rss") / F.col("rn") - (F.col("rs") / F.col("rn")) ** 2,
                                  F.lit(0.0)).alias("rV"))
    oof = (st.join(by_cat, "cat").join(F.broadcast(rest), "fold")
           .select("fold", "cat",
                   shrink(F.col("cn") - F.col("n"), F.col("cs") - F.col("s"), F.col("css") - F.col("ss"),
                          F.col("rM"), F.col("rV")).alias("enc")))
    fold_mean = rest.select("fold", F.col("rM").alias("mean"))
    # the maps derive from the checkpointed statistics (folds x categories
    # rows), so recomputing them is cheap and they need no checkpoint of their own
    return TargetEncoding(column=col, full=full, oof=oof, fold_mean=fold_mean, mean=M, rows=int(tot["rows"]))


def fit_preprocessor(train: DataFrame, groups: ColumnGroups, label: str = K.LABEL,
                     fold_col: str = "fold", checkpoint: bool = True) -> Preprocessor:
    """Fit every column group on the train rows.

    The fit makes several passes (medians, moments, categories, target
    statistics), so the needed train columns are checkpointed once, unless the
    caller passes a frame that already reads from a checkpoint or table.
    """
    cols = [*groups.numeric, *groups.low_card, *groups.high_card, label, fold_col]
    train = train.select(*[c for c in dict.fromkeys(cols) if c in train.columns])
    if checkpoint:
        train = materialize(train)
    # the fits do not depend on one another: their jobs share the cluster
    with ThreadPoolExecutor(max_workers=3 + len(groups.high_card)) as ex:
        medians = ex.submit(column_quantiles, train, groups.numeric, [0.5])
        moments = ex.submit(_moments, train, groups.numeric)
        categories = ex.submit(_fit_onehot, train, groups.low_card)
        target = {c: ex.submit(_fit_target, train, c, label, fold_col) for c in groups.high_card}
        med, means, scales = _imputed({c: v for (c, _), v in medians.result().items()}, moments.result(), groups.numeric)
        return Preprocessor(groups=groups, medians=med, means=means, scales=scales, categories=categories.result(),
                            target={c: t.result() for c, t in target.items()})


def load_preprocessor(spark, path: str) -> Preprocessor:
    """Inverse of ``Preprocessor.save``."""
    doc = json.loads(spark.read.text(f"{path}/params").first()[0])
    g = doc["groups"]
    pre = Preprocessor(groups=ColumnGroups(g["numeric"], g["low_card"], g["high_card"]),
                       medians=doc["medians"], means=doc["means"], scales=doc["scales"],
                       categories=doc["categories"])
    for c, mean in doc["target_means"].items():
        parts = {p: spark.read.parquet(f"{path}/target/{c}/{p}") for p in ("full", "oof", "fold_mean")}
        pre.target[c] = TargetEncoding(column=c, mean=float(mean), rows=parts["oof"].count(), **parts)
    return pre


def assemble(df: DataFrame, names: Sequence[str], output: str = "features") -> DataFrame:
    """Dense feature vector whose ML attributes carry the feature names."""
    return VectorAssembler(inputCols=list(names), outputCol=output, handleInvalid="keep").transform(df)
