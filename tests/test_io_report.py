"""Sources, sinks and report tables (round trips in a scratch folder)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from riskspark.functions.formatting import age_years, bin_label, currency_text, outcome_label
from riskspark.operators import report
from riskspark.sources import io


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="riskspark-test-")


def test_csv_load_skips_missing(spark, scratch):
    path = os.path.join(scratch, "a.csv")
    with open(path, "w") as fh:
        fh.write("SK_ID_CURR,AMT_CREDIT,NAME\n1,10.5,x\n2,20.0,y\n3,,z\n4,1.25,w\n5,3,v\n")
    tables, skipped = io.load_tables(spark, scratch, [("app", "a.csv"), ("gone", "missing.csv")])
    assert skipped == ["gone"]
    df = tables["app"]
    assert df.count() == 5
    assert dict(df.dtypes)["AMT_CREDIT"] == "double"


def test_parquet_round_trip_and_catalog(spark, scratch):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 3, "test").otherwise("train"))
    p = io.write_table(df, os.path.join(scratch, "t"), partition_by=["split"])
    back = spark.read.parquet(p)
    assert back.count() == 10 and back.where("split = 'test'").count() == 3
    s = {r["table_name"]: (r["n_rows"], r["n_columns"]) for r in io.catalog_summary({"t": back}).collect()}
    assert s == {"t": (10, 2)}


def test_metrics_document_round_trip(spark, scratch):
    m = io.metrics_frame(spark, {"gbt": {"auc_roc": 0.7, "gini": 0.4}, "lr": {"auc_roc": 0.6}})
    p = io.write_metrics(m, os.path.join(scratch, "metrics"))
    back = {(r["model"], r["metric"]): r["value"] for r in io.read_metrics(spark, p).collect()}
    assert back[("gbt", "gini")] == 0.4 and len(back) == 3


def test_named_queries_in_order(spark, scratch):
    done = io.run_named({"a": lambda: spark.range(3),
                         "b": lambda: spark.table("a").selectExpr("id * 2 AS x")},
                        out_dir=os.path.join(scratch, "named"))
    assert sorted(r["x"] for r in done["b"].collect()) == [0, 2, 4]


def test_artifacts_store(spark, scratch):
    paths = io.save_artifacts(spark, scratch, tables={"t": spark.range(2)}, docs={"card": {"pdo": 20}})
    assert io.read_doc(spark, paths["card"]) == {"pdo": 20}


def test_formatting(spark):
    df = spark.createDataFrame([(-12053, 1234567.5, 1, 306.5, 327.8)], "d int, m double, y int, lo double, hi double")
    r = df.select(age_years("d").alias("age"), currency_text("m").alias("m"),
                  outcome_label("y").alias("o"), outcome_label(F.lit(None)).alias("u"),
                  bin_label("lo", "hi").alias("b")).first()
    assert r["age"] == 33.0 and r["m"] == "1,234,568" and r["o"] == "Defaulted" and r["u"] == "Unknown"
    assert r["b"] == f"{306.5:.0f}–{327.8:.0f}"


def test_card_unknown_id_is_empty(spark):
    import __spark_entry__ as entry
    cards = entry.queries()["applicant_cards"](spark, SF001)
    some = cards.select("SK_ID_CURR").first()[0]
    assert report.applicant_card(cards, some).count() == 1
    assert report.applicant_card(cards, -1).count() == 0


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert {"decile", "count", "default_rate", "monotone_violation"} <= set(df.columns)


def test_write_counted_observes_rows(spark, scratch):
    path, n = io.write_counted(spark.range(37), os.path.join(scratch, "obs"))
    assert n == 37 and spark.read.parquet(path).count() == 37


def test_catalog_tables_summary(spark):
    spark.range(4).write.mode("overwrite").saveAsTable("riskspark_tmp_catalog")
    try:
        rows = {r["table_name"]: r["n_rows"] for r in io.catalog_tables_summary(spark).collect()}
        assert rows.get("riskspark_tmp_catalog") == 4
    finally:
        spark.sql("DROP TABLE IF EXISTS riskspark_tmp_catalog")


def test_class_rows_and_not_explained(spark):
    from riskspark.operators import quality
    df = spark.createDataFrame([(i, i % 3 == 0) for i in range(9)], "SK_ID_CURR long, d boolean") \
        .withColumn("TARGET", F.col("d").cast("int"))
    assert io.row_count(quality.class_rows(df, 1)) == 3
    sample = df.where("SK_ID_CURR < 4")
    assert sorted(r[0] for r in report.not_explained(df, sample).collect()) == [4, 5, 6, 7, 8]


def test_csv_keeps_late_values(spark, scratch):
    path = os.path.join(scratch, "b.csv")
    with open(path, "w") as fh:
        fh.write("k,v\n" + "".join(f"{i},{i}\n" for i in range(5)) + "5,x\n6,1.5\n")
    df = io.read_csv(spark, path)
    assert dict(df.dtypes) == {"k": "int", "v": "string"}
    assert [r["v"] for r in df.orderBy("k").collect()] == ["0", "1", "2", "3", "4", "x", "1.5"]
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        io.read_csv(spark, path, "k int, v int").collect()


def test_csv_quoted_line_breaks(spark, scratch):
    path = os.path.join(scratch, "q.csv")
    with open(path, "w") as fh:
        fh.write('k,v\n1,"a\nb"\n2,"say ""hi"""\n')
    assert [r["v"] for r in io.read_csv(spark, path).orderBy("k").collect()] == ["a\nb", 'say "hi"']


def test_only_absent_sources_are_skipped(spark, scratch):
    with open(os.path.join(scratch, "broken.parquet"), "w") as fh:
        fh.write("not parquet")
    with pytest.raises(Exception):
        io.load_tables(spark, scratch, [("t", "broken.parquet")], fmt="parquet")[0]["t"].count()


def test_booleans_and_nan_are_prepared(spark):
    from riskspark.operators import quality
    df = spark.createDataFrame([(1, True, float("nan"), "a"), (2, None, 1.0, "b")], "k int, b boolean, x double, c string")
    out = quality.prepared(df)
    assert quality.numeric_columns(out) == ["k", "b", "x"]
    assert [tuple(r) for r in out.orderBy("k").collect()] == [(1, 1, None, "a"), (2, None, 1.0, "b")]
    with pytest.raises(ValueError, match="d"):
        quality.prepared(df.selectExpr("k", "current_date() AS d"))


def test_bucketed_tables_join_without_shuffle(spark):
    a = spark.range(200).withColumnRenamed("id", "SK_ID_CURR").withColumn("x", F.col("SK_ID_CURR") * 2)
    b = spark.range(200).withColumnRenamed("id", "SK_ID_CURR").withColumn("y", F.col("SK_ID_CURR") * 3)
    io.save_as_table(a, "riskspark_tmp_bucket_a", bucket_by="SK_ID_CURR", n_buckets=4)
    io.save_as_table(b, "riskspark_tmp_bucket_b", bucket_by="SK_ID_CURR", n_buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        j = spark.table("riskspark_tmp_bucket_a").join(spark.table("riskspark_tmp_bucket_b"), "SK_ID_CURR")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and j.count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS riskspark_tmp_bucket_a")
        spark.sql("DROP TABLE IF EXISTS riskspark_tmp_bucket_b")


def test_checkpoint_dir_taken_from_session(spark):
    from riskspark.session import cluster_settings, ensure_checkpoint_dir, scratch_path
    configured = spark.conf.get("spark.checkpoint.dir", None)
    d = ensure_checkpoint_dir(spark)
    assert d == spark.sparkContext.getCheckpointDir()
    if configured:
        assert configured.rstrip("/").split(":")[-1] in d
    assert scratch_path(spark, "x").startswith(d.rstrip("/"))
    conf = cluster_settings(total_cores=8000, shuffle_bytes=24 * 1024 ** 4)
    assert int(conf["spark.sql.shuffle.partitions"]) == 24 * 1024 ** 4 // (256 * 1024 ** 2)
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"


def _csv_of(rows, line_end="\n"):
    def field(v):
        return "" if v is None else '"' + v.replace('"', '""') + '"' if any(c in v for c in ',"\r\n') else v
    return line_end.join(",".join(field(v) for v in r) for r in rows) + line_end


@pytest.mark.parametrize("split", ["64", "200", "1000", "10m"])
def test_csv_records_over_byte_ranges(spark, scratch, split):
    """Quoted line breaks anywhere, records over many ranges: equal to the reader that takes a file in one task."""
    import random
    rng = random.Random(int(split[:2]))
    texts = ['plain', 'two\nlines', 'a "quoted" word', '"', '\n', '\n\n"\n', 'comma, and\n"both"', 'x' * 90, 'y\n' * 60, 'é\nñ', 'tail"']
    rows = [("k", "v", "n")] + [(str(i), rng.choice(texts), str(rng.randint(-5, 5))) for i in range(400)]
    for name in ("one", "two"):
        with open(os.path.join(scratch, f"{name}.csv"), "w", newline="") as fh:
            fh.write(_csv_of(rows if name == "one" else rows[:7]))
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        for schema in (None, "k int, v string, n int"):
            got = io.read_csv(spark, scratch, schema)
            one = (spark.read.option("header", "true").option("escape", '"').option("multiLine", "true")
                   .option("inferSchema", str(schema is None).lower()))
            want = one.schema(schema).csv(scratch) if schema else one.csv(scratch)
            assert got.dtypes == want.dtypes == [("k", "int"), ("v", "string"), ("n", "int")]
            assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 406
            if split != "10m":
                assert got.rdd.getNumPartitions() > 4  # the file is read by many tasks
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_csv_records_refuse_bad_files(spark, scratch):
    """A value that does not fit, a missing value and an open quote raise; CRLF ends and a header alone are fine."""
    path = os.path.join(scratch, "c.csv")

    def written(text):
        with open(path, "w", newline="") as fh:
            fh.write(text)
        return path
    for text in ('k,v\n1,"a\nb"\nx,c\n', 'k,v\n1,"a\nb"\n2\n'):
        with pytest.raises(Exception, match="(?i)malformed|parse"):
            io.read_csv(spark, written(text), "k int, v string").collect()
    with pytest.raises(ValueError, match="not closed"):
        io.read_csv(spark, written('k,v\n1,"a\n'))
    got = io.read_csv(spark, written('﻿k,"v\nw"\r\n1,"a\r\nb"\r\n2,c\r\n'))
    assert got.columns == ["k", "v\nw"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a\r\nb"), (2, "c")]
    head = io.read_csv(spark, written('k,"v\nw"\n'))
    assert head.columns == ["k", "v\nw"] and head.count() == 0
    assert io.load_tables(spark, scratch, [("t", "c.csv")], multi_line=False)[0]["t"].columns


def test_store_refuses_what_was_not_committed(spark, scratch):
    """A save cut short is not read; a changed, missing or added file is refused."""
    from riskspark.sources.artifacts import ArtifactStore, StoreError
    store = ArtifactStore(spark, os.path.join(scratch, "store"))
    with pytest.raises(StoreError):
        store.load()
    store.save(tables={"t": spark.range(3)}, docs={"card": {"pdo": 20}})
    # a second save loses its driver before the manifest is written
    keep = ArtifactStore.commit
    ArtifactStore.commit = lambda self, name: None
    try:
        store.save(tables={"t": spark.range(99)})
    finally:
        ArtifactStore.commit = keep
    got = store.load()
    assert got["tables"]["t"].count() == 3 and got["docs"] == {"card": {"pdo": 20}}
    store.save(tables={"t": spark.range(5)})
    assert store.load()["tables"]["t"].count() == 5 and store.load()["docs"] == {}
    folder = store.verified().replace("file:", "")
    part = next(os.path.join(r, f) for r, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))
    whole = open(part, "rb").read()
    os.remove(os.path.join(os.path.dirname(part), f".{os.path.basename(part)}.crc"))
    with open(part, "ab") as fh:
        fh.write(b"x")
    with pytest.raises(StoreError, match="not as committed"):
        store.load()
    with open(part, "wb") as fh:
        fh.write(whole)
    assert store.load()["tables"]["t"].count() == 5
    with open(os.path.join(os.path.dirname(part), "part-99999.parquet"), "wb") as fh:
        fh.write(whole)
    with pytest.raises(StoreError, match="part-99999"):
        store.load()


def test_store_keeps_fitted_models(spark, scratch):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    from riskspark.sources.artifacts import ArtifactStore
    df = spark.createDataFrame([(float(i % 2), Vectors.dense([float(i % 2) + 0.1 * (i % 7), float(i)])) for i in range(40)],
                               ["label", "features"])
    model = LogisticRegression(regParam=0.1).fit(df)
    store = ArtifactStore(spark, os.path.join(scratch, "models"))
    store.save(models={"lr": model})
    loaded = store.load()["models"]["lr"]
    a = model.transform(df).select("prediction", "probability").collect()
    assert loaded.transform(df).select("prediction", "probability").collect() == a


def test_bloom_filters_skip_row_groups(spark, scratch):
    """Keys in no order: min/max keeps every file, Bloom filters read one (or a false match)."""
    df = spark.range(40_000).selectExpr("id * 7 AS k", "id AS v").repartition(20, F.xxhash64("k"))

    def scanned(path, key):
        found = spark.read.parquet(path).where(F.col("k") == key)
        assert found.count() == (1 if key % 7 == 0 else 0)
        plan = found._jdf.queryExecution().executedPlan()
        found._jdf.queryExecution().executedPlan().execute().count()
        node = plan
        while node.children().size():
            node = node.children().apply(0)
        return node.metrics().apply("numOutputRows").value()
    plain = io.write_table(df, os.path.join(scratch, "plain"))
    bloom = io.write_with_bloom(df, os.path.join(scratch, "bloom"), ["k"], expected=4_000)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for key in (7 * 1234, 7 * 1234 + 1):
            assert scanned(plain, key) > 10 * 2_000  # most files' ranges cover the key
            assert scanned(bloom, key) <= 3 * 2_200
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_bucketed_marts_join_without_exchange(spark):
    """Below the report's aggregate no shuffle: buckets are joined in place."""
    from conftest import SF001 as folder
    from riskspark.plans import source_queries as sq
    plans, keep = [], sq.bucketed_join

    def watched(*args):
        out = keep(*args)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out
    sq.bucketed_join = watched
    try:
        assert sq.q_bucketed_marts(spark, folder).count() == 2
    finally:
        sq.bucketed_join = keep
    assert "SortMergeJoin" in plans[0] and "Exchange" not in plans[0]
