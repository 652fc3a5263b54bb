"""CSV files whose quoted values hold line breaks, read by many tasks (A1).

Spark's own reader gives such a file to one task, as a line break ends a record
only outside quotes.  Quotes are doubled inside quoted values, so whether a line
starts within quotes is the parity of the quotes before it:

1. each byte range of a file counts its quotes (``quote_counts``); a prefix sum
   over the ranges gives the parity each starts with;
2. each range cuts its lines into records by its running parity.  Records that
   begin and end in a range leave the task whole; the piece before the first
   record's start and an open last record are fragments, at most two a range;
3. fragments are put together in order, and all records are parsed by Spark's
   CSV parser.

Where no line break is inside quotes (the counts tell), every line is a record
and Spark's own splitting reader takes over.

The rule needs quotes to open and close values and to be doubled inside them; a
file whose quotes do not pair up is refused.  One number a byte range reaches
the driver.
"""

from __future__ import annotations

import itertools

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import ship_package

RECORDS = "file string, start long, nth long, kind int, value string"
#: Kinds of rows: a record; the end of a record that began before the range; the open begin of one.
WHOLE, TAIL, HEAD = 0, 1, 2


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start of its byte range, value) of every line; a range's lines come in order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def quote_counts(spark: SparkSession, path: str) -> list[tuple[str, int, int, int]]:
    """(file, start, quotes, lines with an odd number of them) of each byte range, in order."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    rows = (_lines(spark, path).select("file", "start", quotes.alias("q")).groupBy("file", "start")
            .agg(F.sum("q").alias("q"), F.count_if(F.col("q") % 2 == 1).alias("odd")).collect())
    return sorted((r["file"], r["start"], r["q"], r["odd"]) for r in rows)


def starting_parity(counts: list[tuple[str, int, int, int]]) -> dict[tuple[str, int], int]:
    """Parity of the quotes before each byte range."""
    out = {}
    for file, ranges in itertools.groupby(counts, key=lambda c: c[0]):
        before = 0
        for _, start, q, _ in ranges:
            out[file, start] = before % 2
            before += q
        if before % 2:
            raise ValueError(f"{file}: a quoted value is not closed")
    return out


def _cut(shared):
    """Cut the lines of byte ranges, which follow one another in a task, into records."""
    def rows(key, records):
        return pa.record_batch([pa.array([key[0]] * len(records)), pa.array([key[1]] * len(records), pa.int64()),
                                pa.array([r[0] for r in records], pa.int64()), pa.array([r[1] for r in records], pa.int32()),
                                pa.array([r[2] for r in records], pa.string())], names=[c.split()[0] for c in RECORDS.split(", ")])

    def run(batches):
        parity, key, odd, nth, open_, head = shared.value, None, 0, 0, [], False
        out: list[tuple] = []

        def close():
            """The lines left when a range ends belong to a record that goes on."""
            if open_:
                out.append((nth, HEAD if head else TAIL, "\n".join(open_)))

        for batch in batches:
            files, starts, values = (batch.column(i).to_pylist() for i in range(3))
            for k, line in zip(zip(files, starts), values):
                if k != key:
                    if key is not None:
                        close()
                        if out:
                            yield rows(key, out)
                    # a range that starts within quotes goes on with a record of another range
                    key, odd, nth, open_, out = k, parity[k], 0, [], []
                    head = not odd
                if '"' in line:
                    odd ^= line.count('"') & 1
                if odd:
                    open_.append(line)
                    continue
                if open_ or not head:
                    open_.append(line)
                    out.append((nth, WHOLE if head else TAIL, "\n".join(open_)))
                    open_ = []
                else:
                    out.append((nth, WHOLE, line))
                head, nth = True, nth + 1
            if out and key is not None:
                yield rows(key, out)
                out = []
        if key is not None:
            close()
            if out:
                yield rows(key, out)
    return run


def records(spark: SparkSession, path: str, counts: list[tuple[str, int, int, int]]) -> DataFrame:
    """(file, start, nth, value): every record of the files of ``path`` as one
    string, in file order by (file, start, nth); a file's first has start and nth 0."""
    parity = starting_parity(counts)
    lines = _lines(spark, path)
    ship_package(spark)
    cut = lines.mapInArrow(_cut(spark.sparkContext.broadcast(parity)), RECORDS)  # a number per byte range
    whole = cut.where(F.col("kind") == WHOLE).drop("kind")
    # fragments in file order: a head opens a record, the tails after it go on with it
    order = Window.partitionBy("file").orderBy("start", "nth")  # two rows a byte range at most
    pieces = cut.where(F.col("kind") != WHOLE).withColumn("record", F.count_if(F.col("kind") == HEAD).over(order))
    joined = (pieces.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("start", "nth", "value"))).alias("p"))
              .select("file", F.col("p")[0]["start"].alias("start"), F.col("p")[0]["nth"].alias("nth"),
                      F.array_join(F.transform("p", lambda s: s["value"]), "\n").alias("value")))
    return whole.unionByName(joined)


def _strings(df: DataFrame):
    """The JVM side of a one-column frame as a data set of strings."""
    return getattr(df._jdf, "as")(df.sparkSession._jvm.org.apache.spark.sql.Encoders.STRING())


def read_records(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Rows of CSV files with a header each.  With a schema a value that does not
    fit it raises, as does a record of another number of values; else types are
    inferred from every record."""
    reader = spark.read.option("mode", "FAILFAST").option("escape", '"')
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    counts = quote_counts(spark, path)
    if not any(odd for *_, odd in counts):  # every line is a record
        return reader.option("header", "true").csv(path)
    every = records(spark, path, counts).withColumn("value", F.regexp_replace("value", r"\r$", ""))
    header = (F.col("start") == 0) & (F.col("nth") == 0)
    body = every.where(~header).select("value")
    out = DataFrame(reader._jreader.csv(_strings(body)), spark)
    if schema is not None:
        return out
    first = every.where(header).select(F.regexp_replace("value", "^\ufeff", "").alias("value")).limit(1)
    names = DataFrame(spark.read.option("escape", '"')._jreader.csv(_strings(first)), spark).first()
    if not out.columns:  # no records: columns of text
        return spark.createDataFrame([], StructType([StructField(n, StringType()) for n in names]))
    return out.toDF(*names)
