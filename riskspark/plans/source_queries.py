"""Queries over the source and lookup operators: each writes, reads back or looks
up rows of the given tables, through the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import quality, report
from ..functions.formatting import report_round
from ..operators.marts import build_features, bureau_features, pos_cash_features, previous_app_features
from ..operators.monitor import score_table
from ..session import read_table, scratch_path
from ..sources import io
from ..sources.artifacts import ArtifactStore
from ..sources.fixtures import Tables, applicant_labels
from .oracle import _MARTS, SCORES, numpy_rounding, oracle_queries
from .scoring import (FORMULA_INTERCEPT, FORMULA_ORDERS_CENTER, FORMULA_ORDERS_COEF, FORMULA_PRICE_CENTER,
                      FORMULA_PRICE_COEF, split_assignment)

#: Ids looked up by ``key_lookup``: the first is an applicant, the last is none.
LOOKUP_IDS = (7, 42, -1)


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"sources/{name}-{uuid.uuid4().hex}")


def q_csv_round_trip(spark, sf_dir) -> DataFrame:
    """A1 + A2: customers as CSV (quotes and commas in their comments) read back
    with inferred types; an absent source is reported by name and has no rows."""
    base = _folder(spark, "csv")
    customers = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", F.col("c_acctbal").cast("double").alias("c_acctbal"), "c_mktsegment",
        F.concat(F.lit('says "'), F.col("c_mktsegment"), F.lit('",\nthen '), F.col("c_custkey")).alias("note"))
    customers.write.option("header", "true").option("escape", '"').csv(f"{base}/customer.csv")
    tables, skipped = io.load_tables(spark, base, [("customer", "customer.csv"), ("absent", "absent.csv")])
    return tables["customer"].select(
        F.col("c_custkey").cast("long").alias("c_custkey"), F.col("c_nationkey").cast("long").alias("c_nationkey"),
        F.round("c_acctbal", 6).alias("c_acctbal"), "c_mktsegment", "note", F.lit(",".join(skipped)).alias("skipped"))


def q_table_round_trip(spark, sf_dir) -> DataFrame:
    """A3 + A4 + A8: a table written twice (the second replaces the first),
    counted as written and summed as read back."""
    path = _folder(spark, "orders")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    io.write_table(orders.limit(5), path)
    _, written = io.write_counted(orders, path)
    cents = F.rint(F.col("o_totalprice") * F.lit(100.0)).cast("long")
    return (spark.read.parquet(path).groupBy("o_orderpriority")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(cents).cast("long").alias("cents"))
            .withColumn("n_written", F.lit(written).cast("long")))


def q_named_queries(spark, sf_dir) -> DataFrame:
    """Named roll-ups written in order, the last reading the views of the first two."""
    t = Tables(spark, sf_dir)
    done = io.run_named({
        "named_bureau": lambda: bureau_features(t).select(K.KEY, "BURO_N_ORDERS"),
        "named_previous": lambda: previous_app_features(t).select(K.KEY, "PREV_N_OPEN"),
        "named_joined": lambda: spark.sql(
            f"SELECT b.BURO_N_ORDERS AS n_orders, count(*) AS applicants, sum(p.PREV_N_OPEN) AS n_open "
            f"FROM named_bureau b JOIN named_previous p ON b.{K.KEY} = p.{K.KEY} GROUP BY b.BURO_N_ORDERS"),
    }, _folder(spark, "named"))
    return done["named_joined"]


def q_metrics_document(spark, sf_dir) -> DataFrame:
    """Metrics of each table written as a document and read back."""
    t, parts = Tables(spark, sf_dir), []
    for name, column in (("customer", "c_acctbal"), ("orders", "o_totalprice")):
        parts.append(getattr(t, name).agg(F.count(F.lit(1)).cast("double").alias("rows"),
                                          F.max(F.col(column).cast("double")).alias("largest"))
                     .select(F.lit(name).alias("model"), "rows", "largest")
                     .unpivot(["model"], ["rows", "largest"], "metric", "value"))
    path = io.write_metrics(parts[0].unionByName(parts[1]), _folder(spark, "metrics"))
    return io.read_metrics(spark, path).withColumn("value", F.round("value", 6))


def q_key_lookup(spark, sf_dir) -> DataFrame:
    """Applicants by id from a table sorted on the key; an unknown id has no row."""
    path = io.write_by_key(applicant_labels(Tables(spark, sf_dir)), _folder(spark, "by-key"), K.KEY, 8)
    cards = spark.read.parquet(path)
    out = report.applicant_card(cards, LOOKUP_IDS[0])
    for i in LOOKUP_IDS[1:]:
        out = out.unionByName(report.applicant_card(cards, i))
    return out.select(K.KEY, K.LABEL)


def q_class_rows(spark, sf_dir) -> DataFrame:
    """The applicants in default."""
    return quality.class_rows(applicant_labels(Tables(spark, sf_dir)), 1).select(K.KEY, K.LABEL)


def q_key_lookup_bloom(spark, sf_dir) -> DataFrame:
    """Applicants by id and orders by customer, tables in no order of their key;
    Bloom filters tell which row groups to read."""
    t = Tables(spark, sf_dir)
    people = io.write_with_bloom(applicant_labels(t).repartition(8, F.xxhash64(K.KEY)), _folder(spark, "bloom"), [K.KEY])
    orders = io.write_with_bloom(t.orders.select("o_orderkey", "o_custkey"), _folder(spark, "bloom-orders"), ["o_orderkey", "o_custkey"])
    out = None
    for i in LOOKUP_IDS:
        card = report.applicant_card(spark.read.parquet(people), i)
        own = spark.read.parquet(orders).where(F.col("o_custkey") == i).agg(F.count(F.lit(1)).alias("n_orders"))
        row = card.select(K.KEY, K.LABEL).join(own.withColumn(K.KEY, F.lit(i).cast("long")), K.KEY)
        out = row if out is None else out.unionByName(row)
    return out


def q_bucketed_marts(spark, sf_dir) -> DataFrame:
    """A3 + A5 + C1: marts saved as catalog tables bucketed and sorted on the
    applicant, listed, and joined bucket by bucket without a shuffle."""
    t, base = Tables(spark, sf_dir), _folder(spark, "bucketed")
    database = f"marts_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}'")
    marts = {"applicants": applicant_labels(t), "previous": previous_app_features(t), "events": pos_cash_features(t)}
    for name, df in marts.items():
        io.save_as_table(df.withColumn(K.KEY, F.col(K.KEY).cast("long")), f"{database}.{name}", K.KEY, 8, path=f"{base}/{name}")
    joined = bucketed_join(spark, database, list(marts))
    rows = (joined.groupBy(K.LABEL).agg(F.count(F.lit(1)).alias("n"), F.sum("PREV_N_ORDERS").alias("n_orders"),
                                        F.sum("POS_N_EVENTS").alias("n_events")).withColumn("one", F.lit(1)))
    listed = io.catalog_tables_summary(spark, database).agg(F.sum("n_rows").alias("rows_listed"), F.sum("n_columns").alias("columns_listed"))
    return rows.join(F.broadcast(listed.withColumn("one", F.lit(1))), "one").drop("one")  # one row


def bucketed_join(spark: SparkSession, database: str, names: list[str]) -> DataFrame:
    """Catalog tables bucketed alike on the applicant, left-joined to the first."""
    out = spark.table(f"{database}.{names[0]}")
    for name in names[1:]:
        out = out.join(spark.table(f"{database}.{name}").hint("merge"), K.KEY, "left")  # sorted buckets: merge in place
    return out


def q_artifact_store(spark, sf_dir) -> DataFrame:
    """A10: the formula as a stored model, its inputs as a stored table and the card
    as a document, saved, verified, loaded and scored from the store alone."""
    t = Tables(spark, sf_dir)
    z = (f"{FORMULA_INTERCEPT} + {FORMULA_ORDERS_COEF} * (PREV_N_ORDERS - {FORMULA_ORDERS_CENTER}) "
         f"+ {FORMULA_PRICE_COEF} * (PREV_AVG_PRICE - {FORMULA_PRICE_CENTER})")
    model = PipelineModel([SQLTransformer(statement=f"SELECT *, 1 / (1 + exp(-({z.replace('0.00001', '0.00001D')}))) AS probability FROM __THIS__")])
    table = split_assignment(t).join(previous_app_features(t), K.KEY, "left")
    store = ArtifactStore(spark, _folder(spark, "store"))
    store.save({"formula": model}, {"applicants": table.select(K.KEY, K.LABEL, "split", "PREV_N_ORDERS", "PREV_AVG_PRICE")},
               {"card": {"pdo": K.PDO, "base_score": K.BASE_SCORE}})
    loaded = store.load()
    scored = score_table(loaded["models"]["formula"].transform(loaded["tables"]["applicants"]), keep=[K.LABEL, "split"])
    return scored.select(K.KEY, report_round("probability", 6).alias("probability"), "score", "risk_band", K.LABEL, "split",
                         F.lit(loaded["docs"]["card"]["pdo"]).cast("int").alias("pdo"))


def q_missingness_of_table(spark, sf_dir) -> DataFrame:
    """Missing values of the written feature table, nulls from its file statistics."""
    path = io.write_table(build_features(Tables(spark, sf_dir)), _folder(spark, "features"))
    return quality.missingness_of_table(spark, path)


SOURCE_QUERIES = {
    "csv_round_trip": q_csv_round_trip,
    "table_round_trip": q_table_round_trip,
    "named_queries": q_named_queries,
    "metrics_document": q_metrics_document,
    "key_lookup": q_key_lookup,
    "class_rows": q_class_rows,
    "key_lookup_bloom": q_key_lookup_bloom,
    "bucketed_marts": q_bucketed_marts,
    "artifact_store": q_artifact_store,
    "missingness_of_table": q_missingness_of_table,
}

_LABELS = f"SELECT c_custkey AS {K.KEY}, CAST(c_acctbal < 0 AS INTEGER) AS {K.LABEL} FROM customer"

SOURCE_ORACLES = {
    "missingness_of_table": oracle_queries()["missingness"],
    "csv_round_trip": (
        "SELECT c_custkey, c_nationkey, round(CAST(c_acctbal AS DOUBLE), 6) AS c_acctbal, c_mktsegment, "
        "'says \"' || c_mktsegment || '\",' || chr(10) || 'then ' || c_custkey AS note, 'absent' AS skipped "
        "FROM customer"),
    "table_round_trip": (
        "SELECT o_orderpriority, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, "
        "(SELECT count(*) FROM orders) AS n_written FROM orders GROUP BY o_orderpriority"),
    "named_queries": (
        "SELECT n_orders, count(*) AS applicants, CAST(sum(n_open) AS BIGINT) AS n_open FROM ("
        "SELECT o_custkey, count(*) AS n_orders, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_open "
        "FROM orders GROUP BY o_custkey) GROUP BY n_orders"),
    "metrics_document": " UNION ALL ".join(
        f"SELECT '{t}' AS model, '{m}' AS metric, round(CAST({e} AS DOUBLE), 6) AS value FROM {t}"
        for t, c in (("customer", "c_acctbal"), ("orders", "o_totalprice"))
        for m, e in (("rows", "count(*)"), ("largest", f"max({c})"))),
    "key_lookup": f"SELECT * FROM ({_LABELS}) WHERE {K.KEY} IN ({', '.join(map(str, LOOKUP_IDS))})",
    "class_rows": f"SELECT * FROM ({_LABELS}) WHERE {K.LABEL} = 1",
    "key_lookup_bloom": f"SELECT l.*, (SELECT count(*) FROM orders WHERE o_custkey = l.{K.KEY}) AS n_orders "
                        f"FROM ({_LABELS}) l WHERE {K.KEY} IN ({', '.join(map(str, LOOKUP_IDS))})",
    "bucketed_marts": "WITH " + _MARTS + f"""
SELECT TARGET, count(*) AS n, sum(PREV_N_ORDERS)::BIGINT AS n_orders, sum(POS_N_EVENTS)::BIGINT AS n_events,
       2 * (SELECT count(*) FROM customer) + (SELECT count(*) FROM prev) AS rows_listed, {2 + 9 + 6}::BIGINT AS columns_listed
FROM app LEFT JOIN prev USING (SK_ID_CURR) LEFT JOIN pos USING (SK_ID_CURR) GROUP BY TARGET""",
    "artifact_store": numpy_rounding(SCORES + f"SELECT SK_ID_CURR, round(probability, 6) AS probability, score, risk_band, TARGET, "
                                     f"split, {K.PDO} AS pdo FROM scores"),
}
