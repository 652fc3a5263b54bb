"""Column typing, sentinel handling and data-quality reports.

Every report is one pass over the table: a single wide ``agg`` of per-column
expressions, then an ``unpivot`` of that one row into a long table.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions.formatting import report_round


# --- B2 / B3: column selection -------------------------------------------------

def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns in schema order (``prepared`` casts booleans before, Q4)."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in ex]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ex]


def unsupported_columns(df: DataFrame) -> list[str]:
    """Columns neither numeric nor text (dates, booleans...): the caller must drop them."""
    return [f.name for f in df.schema.fields
            if not isinstance(f.dataType, (T.NumericType, T.StringType))]


def prepared(df: DataFrame) -> DataFrame:
    """Booleans as 0/1 and NaN as null; raises on columns that are then neither
    numeric nor text, which the caller must drop or convert."""
    def column(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BooleanType):
            return c.cast("int").alias(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            return F.when(~F.isnan(c), c).alias(f.name)
        return c
    out = df.select(*[column(f) for f in df.schema.fields])
    bad = unsupported_columns(out)
    if bad:
        raise ValueError(f"columns neither numeric nor text: {bad}")
    return out


def days_columns(df: DataFrame) -> list[str]:
    """Every column whose name *contains* the marker, not only as prefix."""
    return [c for c in df.columns if K.SENTINEL_NAME_PART in c]


def _is_missing(df: DataFrame, c: str):
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


# --- B4 / B5: sentinel ---------------------------------------------------------

def replace_sentinels(df: DataFrame, sentinel: int = K.SENTINEL_VALUE) -> DataFrame:
    """Exact equality with the sentinel becomes null, in ``DAYS_`` columns only."""
    targets = set(days_columns(df))
    return df.select(*[
        F.nullif(F.col(c), F.lit(sentinel).cast(df.schema[c].dataType)).alias(c)
        if c in targets else F.col(c)
        for c in df.columns
    ])


def sentinel_counts(df: DataFrame, sentinel: int = K.SENTINEL_VALUE) -> DataFrame:
    """Per ``DAYS_`` column: how many values equal the sentinel (long form)."""
    cols = days_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, n_sentinel long")
    wide = df.agg(*[F.count_if(F.col(c) == sentinel).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "n_sentinel")


# --- D6 / F1: missingness ------------------------------------------------------

def missingness(df: DataFrame) -> DataFrame:
    """Null (or NaN) count and percent of rows per column, two decimals."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(_is_missing(df, c)).alias(c) for c in cols])
    long = wide.unpivot(["__n"], cols, "column_name", "n_missing")
    return long.select(
        "column_name",
        F.col("n_missing").cast("long").alias("n_missing"),
        report_round(F.try_divide(F.col("n_missing"), F.col("__n")) * F.lit(100.0), 2).alias("pct_missing"),
    )


_STATISTICS = {"spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.useV1SourceList": ""}


def footer_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row: rows and non-null values of every column of a Parquet table, from
    the statistics in its file footers; no column is read.  To be run while
    ``_STATISTICS`` is set."""
    df = spark.read.parquet(path)
    return df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])


def missingness_of_table(spark: SparkSession, path: str) -> DataFrame:
    """``missingness`` of a written Parquet table: nulls from the file statistics;
    only floating-point columns are read, for their NaN."""
    df = spark.read.parquet(path)
    real = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    before = {k: spark.conf.get(k) for k in _STATISTICS}
    try:
        for k, v in _STATISTICS.items():
            spark.conf.set(k, v)
        counts = footer_counts(spark, path).first()  # one row
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    nan = df.agg(*[F.count_if(F.isnan(F.col(f"`{c}`"))).alias(c) for c in real]).first().asDict() if real else {}
    n = counts["__n"]
    rows = [(c, n - counts[c] + nan.get(c, 0), n) for c in df.columns]
    long = spark.createDataFrame(rows, "column_name string, n_missing long, n long")
    return long.select("column_name", "n_missing",
                       report_round(F.try_divide(F.col("n_missing"), F.col("n")) * F.lit(100.0), 2).alias("pct_missing"))


def top_missing(df: DataFrame, k: int = K.TOP_MISSING) -> DataFrame:
    """Columns with any missing value, most missing first, at most ``k`` (F1)."""
    return (missingness(df).where(F.col("n_missing") > 0)
            .orderBy(F.desc("n_missing"), F.asc("column_name")).limit(k))


# --- D7: label distribution ----------------------------------------------------

def target_distribution(df: DataFrame, label: str = K.LABEL) -> DataFrame:
    """Count and percent per label value; nulls out of the groups, in the total.

    The grouped frame has one row per label value (at most three), so the
    un-partitioned total window runs over a handful of rows.
    """
    g = df.groupBy(F.col(label).alias(label)).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return (g.withColumn("__total", total)
            .where(F.col(label).isNotNull())
            .select(label, F.col("n").alias("count"),
                    report_round(F.try_divide(F.col("n"), F.col("__total")) * F.lit(100.0), 2).alias("pct")))


# --- D8: distinct counts and routing -------------------------------------------

def column_cardinality(df: DataFrame, columns: Sequence[str] | None = None,
                       cut: int = K.CARDINALITY_CUT) -> DataFrame:
    """Exact distinct non-null count per column, routed low (< cut) or high.

    One unpivot to (column, value), a distinct on the pairs (map-side
    de-duplicated), then a count per column: a single shuffle for all columns.
    """
    cols = list(columns) if columns is not None else categorical_columns(df)
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "column_name string, n_distinct long, cardinality string")
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]) \
        .unpivot([], cols, "column_name", "value")
    n = (long.where(F.col("value").isNotNull()).distinct()
         .groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct")))
    # columns that are entirely null still get a row with 0 distinct values
    names = spark.createDataFrame([(c,) for c in cols], "column_name string")
    out = names.join(F.broadcast(n), "column_name", "left") \
        .select("column_name", F.coalesce("n_distinct", F.lit(0)).cast("long").alias("n_distinct"))
    return out.withColumn("cardinality",
                          F.when(F.col("n_distinct") < cut, F.lit("low")).otherwise(F.lit("high")))


def class_rows(df: DataFrame, cls: int, label: str = K.LABEL) -> DataFrame:
    """The rows of one class (a pushed-down filter on Parquet)."""
    return df.where(F.col(label) == F.lit(cls))
