"""Exact quantiles of many columns by radix selection.

The bits of a double, with the negative ones flipped, order like the value.  A
round counts, for all columns at once, how many values have each next 16 bits
after the bits known so far; running sums over these counts tell which 16 bits
the wanted order statistics have.  A bucket that holds one distinct value ends
the search for it, so few values take one round, and no data more than four.

Tasks keep counts only, so what is shuffled is at most 65,536 rows a column and
task, whatever the number of rows; no value is sorted or unpivoted beyond a
batch.  ``exact_quantiles`` is the form for grouped long tables.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package

BITS = 16
#: Columns counted together; bounds the counts a task holds.
COLUMN_BATCH = 64
COUNTS = "target int, digit int, n long, low long, high long"
_SIGN = np.int64(np.iinfo(np.int64).min)


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """64-bit integers that order like the values; both zeros are one."""
    bits = (np.asarray(values, np.float64) + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(np.iinfo(np.int64).max), bits)


def value_of(bits: int) -> float:
    """Inverse of ``ordered_bits``."""
    bits = np.int64(bits)
    return float((bits ^ np.int64(np.iinfo(np.int64).max) if bits < 0 else bits).view(np.float64))


def _add(old: tuple | None, digit, n, low, high) -> tuple:
    """Merge counts by digit."""
    if old is not None:
        digit, n, low, high = (np.concatenate([a, b]) for a, b in zip(old, (digit, n, low, high)))
    order = np.argsort(digit, kind="stable")
    digit, n, low, high = digit[order], n[order], low[order], high[order]
    first = np.flatnonzero(np.append(True, digit[1:] != digit[:-1])[:len(digit)])
    if not len(first):
        return digit, n, low, high
    return digit[first], np.add.reduceat(n, first), np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)


def _count(targets: list[tuple[int, int]], known: int):
    """Counts of the next digit for each (column index, known leading bits)."""
    def run(batches):
        total: dict[int, tuple] = {}
        for batch in batches:
            keys: dict[int, np.ndarray] = {}
            for t, (c, prefix) in enumerate(targets):
                if c not in keys:
                    column = batch.column(c)
                    values = column.to_numpy(zero_copy_only=False).astype(np.float64)
                    keys[c] = np.sort(ordered_bits(values[~np.isnan(values)]))  # null is NaN here
                key = keys[c]
                if known:
                    low = prefix << (64 - known)
                    key = key[np.searchsorted(key, low):np.searchsorted(key, low + ((1 << (64 - known)) - 1), "right")]
                if len(key):
                    digit = ((key ^ _SIGN).view(np.uint64) >> np.uint64(64 - known - BITS)) & np.uint64((1 << BITS) - 1)
                    total[t] = _add(total.get(t), digit.astype(np.int64), np.ones(len(key), np.int64), key, key)
        for t, (digit, n, low, high) in total.items():
            yield pa.record_batch([pa.array(np.full(len(digit), t), pa.int32()), pa.array(digit, pa.int32()), pa.array(n),
                                   pa.array(low), pa.array(high)], names=["target", "digit", "n", "low", "high"])
    return run


def digit_counts(df: DataFrame, targets: list[tuple[int, int]], known: int) -> DataFrame:
    """(target, digit, n, low, high, before, total) of the columns of ``df``, one
    small shuffle of counts."""
    ship_package(df.sparkSession)
    run = Window.partitionBy("target")
    return (df.mapInArrow(_count(targets, known), COUNTS).repartition("target").groupBy("target", "digit")
            .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
            .withColumn("before", F.sum("n").over(run.orderBy("digit")) - F.col("n"))
            .withColumn("total", F.sum("n").over(run)))


def _interpolated(q: float, n: int, low: float, high: float) -> float:
    """numpy's linear interpolation between the order statistics around q * (n - 1)."""
    t = q * (n - 1) - math.floor(q * (n - 1))
    if low == high:
        return low
    return high - (high - low) * (1 - t) if t >= 0.5 else low + (high - low) * t


def _batch(df: DataFrame, cols: list[str], probs: Sequence[float]) -> dict[tuple[str, float], float]:
    spark = df.sparkSession
    narrow = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    counts, ranks, found = {}, {}, {}  # rows of a column; (column, rank) -> (known bits, rank among them); -> value
    targets, known = [(c, 0) for c in range(len(cols))], 0
    while targets:
        table = digit_counts(narrow, targets, known)
        if known == 0:
            # the total comes with the counts: the wanted ranks follow from it
            at = F.array(*[F.floor(F.lit(q) * (F.col("total") - 1)) for q in probs],
                         *[F.ceil(F.lit(q) * (F.col("total") - 1)) for q in probs])
            wanted = table.withColumn("rank", F.explode(F.array_distinct(at)))
        else:
            asked = spark.createDataFrame([(targets.index((c, prefix)), left, rank) for (c, rank), (prefix, left) in ranks.items()],
                                          "target int, inside long, rank long")  # two rows a column and quantile at most
            wanted = table.join(F.broadcast(asked), "target")
        inside = F.col("rank") if known == 0 else F.col("inside")
        rows = wanted.where((inside >= F.col("before")) & (inside < F.col("before") + F.col("n"))).select(
            "target", "rank", inside.alias("inside"), "digit", "low", "high", "before", "total").collect()
        ranks = {}
        for r in rows:
            c, prefix = targets[r["target"]]
            if known == 0:
                counts[c] = r["total"]
            if r["low"] == r["high"]:
                found[c, r["rank"]] = value_of(r["low"])
            else:
                # leading bits as a signed number, so that they order like the keys
                bits = r["low"] >> (64 - known - BITS)
                ranks[c, r["rank"]] = (bits, r["inside"] - r["before"])
        known += BITS
        targets = sorted({(c, prefix) for (c, _), (prefix, _) in ranks.items()})
    return {(cols[c], q): _interpolated(q, n, found[c, math.floor(q * (n - 1))], found[c, math.ceil(q * (n - 1))])
            for c, n in counts.items() for q in probs}


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[tuple[str, float], float]:
    """{(column, q): exact quantile} with linear interpolation; null and NaN are
    left out, and a column of nothing else has no entry.  ``df`` is read once a
    round, in its columns ``cols`` only: pass a written table."""
    out: dict[tuple[str, float], float] = {}
    for i in range(0, len(cols), COLUMN_BATCH):
        out.update(_batch(df, list(cols[i:i + COLUMN_BATCH]), probs))
    return out
