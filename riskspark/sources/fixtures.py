"""Map the driver's star-schema tables onto the credit-risk data model.

One applicant per customer (``SK_ID_CURR = c_custkey``), label
``TARGET = c_acctbal < 0``.  ``c_acctbal`` itself stays in the feature table as
the planted leak the audit must find; modelling drops it explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..session import read_table
from ..operators.joins import broadcast_checked

# Columns the model must never see: the label's source (planted leak).
LEAK_COLUMNS = ("c_acctbal",)


class Tables:
    """Lazy handles on the fixture tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)


def application(t: Tables) -> DataFrame:
    """The application table: key, label, raw applicant attributes.

    ``nation`` is a fixed 25-row dimension; it is broadcast only after its
    row count is checked.
    """
    nation = broadcast_checked(t.nation.select("n_nationkey", "n_name"), max_rows=10_000)
    c = t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return (
        c.join(nation, c.c_nationkey == nation.n_nationkey, "left")
        .select(
            F.col("c_custkey").alias(K.KEY),
            (F.col("c_acctbal") < 0).cast("int").alias(K.LABEL),
            "c_nationkey", "c_acctbal", "c_mktsegment", "n_name",
        )
    )


def applicant_labels(t: Tables) -> DataFrame:
    """Key and label alone: two columns of ``customer``."""
    return t.customer.select(F.col("c_custkey").alias(K.KEY), (F.col("c_acctbal") < 0).cast("int").alias(K.LABEL))


def document_application(t: Tables) -> DataFrame:
    """Second labelled table: documents with the ``toxic`` label."""
    d = t.documents.select("doc_id", "lang", "source", "n_chars")
    lab = t.labels.select("doc_id", F.col("toxic").alias(K.LABEL))
    return d.join(lab, "doc_id", "inner").withColumnRenamed("doc_id", K.KEY)
