"""Quality rules by distribution divergence.

Each document gives two histograms: character classes and the common words of
its language.  The references are the same histograms summed over all documents
of that language; a document whose Jensen-Shannon distance from either reference
is too great is not kept.  Short documents are guarded: the bound grows by what
sampling alone explains, and below ``min_words`` words only the base rules count.

Only DataFrame functions are used.  Texts are read twice: once for the common
words of each language (a frequent-items sketch), once for all counts, which are
written and small; references and verdicts come from those counts.

Defined cases: null or empty text has no words and fails the base rules; a null
language is a language of its own; rows without a doc_id are left out, repeated
rows are judged one by one; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, written

#: Common words per language.
COMMON_WORDS = 32
#: Words the frequent-items sketch tracks per language.
SKETCH_ITEMS = 8192
#: Words in a window of the repetition count.
WINDOW = 8
#: Below so many words the histograms say too little to reject a document.
MIN_WORDS = 50
#: Greatest Jensen-Shannon distance (base 2, from 0 to 1) beyond sampling noise.
MAX_CLASS_DISTANCE = 0.17
MAX_WORD_DISTANCE = 0.25

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
#: Character classes taken from a text one after the other; the rest is the last class.
CLASSES = (("lower", r"\p{Ll}+"), ("space", SPACES), ("upper", r"[\p{Lu}\p{Lt}]+"), ("letter", r"\p{L}+"),
           ("digit", r"\p{N}+"), ("symbol", r"[#*$%&|<>]+"), ("mark", r"\p{P}+"))


def let(value: Column, body) -> Column:
    """Bind ``value`` to a lambda variable, so that ``body`` evaluates it once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside windows of ``width`` words found at least twice in the text."""
    def covered(windows: Column) -> Column:
        by_hash = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(by_hash, lambda s: F.filter(
            s, lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"]))
            | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))))
        at = F.array_sort(F.transform(twice, lambda x: x["i"]))
        return let(at, lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width)))),
            F.lit(0).cast("long"), lambda a, b: a + b))

    def of(hashes: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(hashes) - (width - 1)),
                              lambda i: F.xxhash64(F.slice(hashes, i, width)))
        return let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long"))
                   .otherwise(covered(w)))

    return F.when(F.size(words) < width, F.lit(0).cast("long")).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), of))


def repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def common_words(docs: DataFrame, k: int = COMMON_WORDS) -> DataFrame:
    """(lang, common array<string>): the most frequent words of each language, ties by word."""
    found = (docs.select("lang", F.explode(words_of(F.col("text"))).alias("w"))
             .groupBy("lang").agg(F.expr(f"approx_top_k(w, {k}, {SKETCH_ITEMS})").alias("top")))
    ordered = F.array_sort(F.transform("top", lambda x: F.struct((-x["count"]).alias("n"), x["item"].alias("w"))))
    return found.select("lang", F.transform(ordered, lambda x: x["w"]).alias("common"))


def counts(docs: DataFrame, common: DataFrame) -> DataFrame:
    """One row per document: base counts and both histograms."""
    rest, sizes = F.col("text"), []
    parts = {}
    df = docs.join(common, "lang", "left").withColumn(
        "common", F.coalesce("common", F.array().cast("array<string>")))
    df = df.withColumn("_words", words_of(F.col("text")))
    left = F.length("text")
    for name, pattern in CLASSES:
        after = F.regexp_replace(rest, pattern, "")
        df = df.withColumn(f"_{name}", after)
        rest = F.col(f"_{name}")
        parts[name] = left - F.length(rest)
        left = F.length(rest)
        sizes.append(parts[name])
    sizes.append(left)
    seen = F.filter(F.transform("_words", lambda w: F.array_position(F.col("common"), w)), lambda i: i > 0)
    per_word = let(seen, lambda s: F.transform(
        F.sequence(F.lit(1), F.lit(COMMON_WORDS + 1)),
        lambda i: F.when(i > COMMON_WORDS, F.size("_words") - F.size(s)).otherwise(
            F.size(F.filter(s, lambda x: x == i)))))
    return df.select(
        "doc_id", "lang", F.size("_words").cast("long").alias("n_words"),
        (F.length("text") - parts["space"]).cast("long").alias("word_chars"),
        parts["symbol"].cast("long").alias("n_symbols"),
        repeated_lines(F.col("text")).alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.array(*[s.cast("double") for s in sizes]).alias("classes"),
        F.transform(per_word, lambda x: x.cast("double")).alias("commons"))


def shares(histogram: Column) -> Column:
    """Histogram as shares; all zero where it is empty."""
    return let(histogram, lambda h: let(
        F.aggregate(h, F.lit(0.0), lambda a, b: a + b),
        lambda total: F.transform(h, lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0)))))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (square root of the divergence, base 2)."""
    def term(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    each = F.zip_with(p, q, lambda a, b: (term(a, b) + term(b, a)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(each, F.lit(0.0), lambda a, b: a + b)))


def references(counted: DataFrame) -> DataFrame:
    """Histograms of each language, every document with equal weight so that no
    long or repetitive document bends them."""
    def total(column: str, n: int) -> Column:
        return F.array(*[F.sum(F.col(column)[i]) for i in range(n)])

    each = counted.where(F.col("n_words") > 0).select(
        "lang", shares(F.col("classes")).alias("classes"), shares(F.col("commons")).alias("commons"))
    return each.groupBy("lang").agg(
        shares(total("classes", len(CLASSES) + 1)).alias("ref_classes"),
        shares(total("commons", COMMON_WORDS + 1)).alias("ref_commons"))


def judged(counted: DataFrame, max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE,
           min_words: int = MIN_WORDS) -> DataFrame:
    def noise(bins: int, n: Column) -> Column:  # distance that sampling n items alone explains, about
        return F.sqrt(F.lit(bins) / (8 * F.log(F.lit(2.0)) * F.greatest(n, F.lit(1))))

    distance = (counted.join(references(counted), "lang", "left")
                .withColumn("class_distance", js_distance(shares(F.col("classes")), F.col("ref_classes")))
                .withColumn("word_distance", js_distance(shares(F.col("commons")), F.col("ref_commons"))))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    like = ((F.col("n_words") < min_words)
            | ((F.col("class_distance") <= max_class + noise(len(CLASSES) + 1, F.col("word_chars")))
               & (F.col("word_distance") <= max_word + noise(COMMON_WORDS, F.col("n_words")))))
    return distance.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.coalesce(like, F.lit(True))).alias("kept"),
        F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text, lang) to base counts, distances and the verdict."""
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang")).where(F.col("doc_id").isNotNull())
    common = written(common_words(narrow), "common-words")
    return judged(written(counts(narrow, common), "histograms"))


def op6_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))
