"""Durable trial table of a search.

Each finished (trial, fold) is one row of a table in a shared folder, written
when its fit ends.  A search that is started again over the same table, after
its driver was lost or with more trials, fits only what is not there yet.  Rows
carry a digest of what decides a fit (parameters, seed, weight, early stopping,
data), so a changed search finds none of another's rows.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "digest string, trial int, fold int, auc_roc double, best_iteration int, n_trees int"


def trial_digest(**parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def data_digest(df: DataFrame, *columns: str) -> str:
    """Digest of a table's rows in ``columns``, whatever their order: count and sum of row hashes."""
    r = df.select(F.xxhash64(*columns).cast("decimal(38,0)").alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("h").alias("h")).first()
    return f"{r['n']}-{r['h']}"


@dataclass
class TrialTable:
    spark: SparkSession
    path: str

    def done(self) -> dict[tuple[str, int], tuple]:
        """{(digest, fold): (auc, best iteration, trees)} of the finished fits: a row per trial and fold."""
        from ..sources.io import path_exists
        if not path_exists(self.spark, self.path):
            return {}
        rows = self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(self.path).collect()
        return {(r["digest"], r["fold"]): (r["auc_roc"], r["best_iteration"], r["n_trees"]) for r in rows}

    def add(self, digest: str, trial: int, fold: int, auc: float | None, best_iteration: int, n_trees: int) -> None:
        """A folder of its own for each fit: trials run side by side, and writers of one folder disturb each other."""
        row = (digest, trial, fold, auc, best_iteration, n_trees)
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{digest}-{fold}")
