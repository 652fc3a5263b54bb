"""Secret scan with a random forest that removes false positives.

Candidates are the values inside words: every long run of key characters with a
digit, every web token with its dots, and whatever is assigned to a secret's name
(in the word or in the ones before), however short and with or without a digit.
A word gives one candidate for each.  A value assigned by a colon in a word of its
own needs a quote or a digit, as prose has colons; values with spaces are several
words and found by their first.  Candidates' features are length, shares and transitions of character classes, coverage by
the corpus's common words, signs of a path or address, and neighbouring words.
A random forest learns from labelled findings and scores every candidate.

The forest takes any table of labelled findings (the feature columns and
``label``).  The given tables hold none, so the query labels the clear cases by
their form: issued key prefixes and values assigned to a secret's name are
secrets; card-like numbers, addresses, paths and plain words are not.  The rest
is left to the forest, which never sees the label rules' verdict on them.  It is
fitted on at most ``SAMPLE`` labelled findings of each label, chosen by a hash of
where they stand, with a label's findings weighted up to their full number.

Only DataFrame, SQL and Spark ML functions are used.

Defined cases: null or empty text has no candidates; rows without a doc_id are
left out of the findings and kept by ``redacted``; repeated rows give their
findings each; without labels of both kinds the clear cases keep their label and
the rest scores 0; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, small, texts, with_text, written
from .divergence import SPACES, let, words_of

#: Labelled findings of each label the forest is fitted on, at most.
SAMPLE = 20_000
TREES = 30
DEPTH = 6
THRESHOLD = 0.5
#: Common words that count as dictionary, and items their sketch tracks.
DICTIONARY = 1000
SKETCH_ITEMS = 16384
MASK = "[SECRET]"

LEAST = 12
KEY = "A-Za-z0-9_+/-"
QUOTE = "\"'`"
#: A name that says its value is secret, what may follow the name, and the assignment.
SECRET_NAME = (r"(?:password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|"
               r"credentials?|auth|bearer)")
SUFFIX = r"(?:[_-](?:key|value|prod|dev|test|old|new|v?[0-9]{1,3}))?[0-9]{0,3}"
CLOSE = rf"[{QUOTE}\\\])]{{0,4}}"
ASSIGN = rf"{CLOSE}(?::=|=>|==?|:)[{QUOTE}\\]{{0,2}}"
#: A word with a run of key characters that holds a digit, tried at the run's start alone, or a web token.
CANDIDATE = rf"(?<![{KEY}])(?=[{KEY}]{{{LEAST}}})[A-Za-z_+/-]*+[0-9]|eyJ[A-Za-z0-9_-]{{8,}}+\."
#: A word with a value assigned to a secret's name; the end of the words before one; a text that may have either.
NAMED = rf"(?i){SECRET_NAME}{SUFFIX}{ASSIGN}[^\s{QUOTE}]"
NAMED_BEFORE = rf"(?i)({SECRET_NAME}){SUFFIX}{CLOSE}\s?(:=|=>|==?|:)[{QUOTE}\\]{{0,2}}$"
NAMED_TEXT = rf"(?i){SECRET_NAME}{SUFFIX}{CLOSE}\s*[:=]"
JWT = r"eyJ[A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]+){1,4}"
#: No value: placeholders, references, addresses.
HOLDER = (r"(?i:(?:null|none|nil|true|false|undefined|required|optional|string|str)\b|\$\{?[a-z_]|%[sdv(]|\*+|<|\{|"
          r"[a-z]+://)")
#: The value assigned to a secret's name goes on to a quote, comma, semicolon or ampersand, less closing signs.
START = rf"(?!{HOLDER})[^\s{QUOTE},;&=:>\\(\[{{]"
DIRECT = (rf"(?<=(?i:{SECRET_NAME}){SUFFIX}{ASSIGN}){START}"
          rf"(?:[^\s{QUOTE},;&]*[^\s{QUOTE},;&)\]}}>.!?\\#])?")
#: Padding ends the word or stands before a closing sign; else "=" assigns.
PLAIN_RUN = rf"[{KEY}]++(?:={{1,2}}(?=[{QUOTE}]?(?:[,;&)\]}}.#<|]|$)))?"
#: Values and names of a word (group 1), and the assignment of what follows to each, if any (group 2).
RUN = rf"({JWT}|{DIRECT}|{PLAIN_RUN})({ASSIGN}(?={START}))?"
ISSUED = r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}|^xox[abprs]-|^sk-[A-Za-z0-9]{20}|^eyJ[A-Za-z0-9_-]{10}"
NAMES = (r"(?i)(password|passwd|pwd|secret|token|api[_-]?key|apikey|access[_-]?key|private[_-]?key|auth|credential|"
         r"bearer)")
OTHERS = r"(?i)(commit|sha\d*|md5|hash|checksum|digest|uuid|guid|revision|build|version|isbn|phone|tel|card|order)"

FEATURES = ("length", "digits", "uppers", "lowers", "hexes", "changes", "case_changes", "distinct", "covered", "slashes",
            "address", "assigned", "quoted", "named", "other_named")


def common_words(docs: DataFrame, k: int = DICTIONARY) -> DataFrame:
    """One row with the array ``dictionary`` of the most frequent words of three letters or more."""
    found = (docs.select(F.explode(words_of(F.col("text"))).alias("w")).where(F.length("w").between(3, 20))
             .agg(F.expr(f"approx_top_k(w, {k}, {SKETCH_ITEMS})").alias("top")))
    return found.select(F.coalesce(F.transform("top", lambda x: F.lower(x["item"])),
                                   F.array().cast("array<string>")).alias("dictionary"))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, place, word, before) of every word with candidates; place is the word's index."""
    def wanted(words: Column, w: Column, i: Column) -> Column:
        return (((F.length(w) >= LEAST) & w.rlike(CANDIDATE))
                | (F.col("_named") & (w.rlike(NAMED) | F.concat_ws(" ", F.get(words, i - 2), F.get(words, i - 1))
                                      .rlike(NAMED_BEFORE))))

    def at(words: Column) -> Column:
        return F.filter(F.transform(words, lambda w, i: F.when(wanted(words, w, i), i)), lambda i: i.isNotNull())

    def around(words: Column) -> Column:
        return F.transform(at(words), lambda i: F.struct(
            i.alias("place"), F.get(words, i).alias("word"),
            F.concat_ws(" ", F.get(words, i - 3), F.get(words, i - 2), F.get(words, i - 1)).alias("before")))

    return (docs.select("doc_id", "text", F.col("text").rlike(NAMED_TEXT).alias("_named"))
            .select("doc_id", F.explode(let(F.split("text", SPACES), around)).alias("c"))
            .select("doc_id", "c.place", "c.word", "c.before"))


def values(found: DataFrame) -> DataFrame:
    """One row for each value in the words of ``candidates``, with the name it is
    assigned to; ``direct`` if that is a secret's.  What the word alone tells is
    taken before, so that a long word is not repeated with each of its values."""
    name, sign = (F.regexp_extract("before", NAMED_BEFORE, g) for g in (1, 2))
    carried = (name != "") & ((sign != ":") | F.col("word").rlike(rf"^[{QUOTE}]|[0-9]"))
    known = F.when(carried, F.concat(name, F.lit("="), "word")).otherwise(F.col("word"))
    split = found.withColumn("_known", known).select(
        "doc_id", "place", F.concat_ws(" ", "before", F.regexp_extract("word", r"^(.*?)[=:]", 1)).alias("lead"),
        F.col("before").rlike(r"[=:]\s*$").alias("_after_sign"),
        F.regexp_count("word", F.lit(r"[/\\]")).alias("_slashes"),
        F.col("word").rlike(r"(?i)https?:|www\.|@|\.[a-z]{2,4}($|[/?#])").alias("_address"),
        F.col("word").rlike(rf"[{QUOTE}]").alias("_quoted"),
        F.regexp_extract_all("_known", F.lit(RUN), F.lit(1)).alias("_runs"),
        F.regexp_extract_all("_known", F.lit(RUN), F.lit(2)).alias("_signs"))

    def described(v: Column, i: Column) -> Column:
        assigned = F.coalesce(F.get("_signs", i - 1) != "", F.lit(False))
        owner = F.when(assigned, F.get("_runs", i - 1)).otherwise(F.lit(""))
        return F.struct(v.alias("value"), owner.alias("name"), assigned.alias("assigned"),
                        owner.rlike(rf"(?i){SECRET_NAME}{SUFFIX}$").alias("direct"),
                        (F.get("_signs", i) != "").alias("followed"), (i == 0).alias("first"))

    def admitted(x: Column) -> Column:
        v = x["value"]
        is_name = x["followed"] & v.rlike(rf"(?i){SECRET_NAME}{SUFFIX}$")
        return ~is_name & ((x["direct"] & ~v.rlike(rf"^(?:{HOLDER})")) | v.rlike(rf"^{JWT}$")
                           | ((F.length(v) >= LEAST) & v.rlike("[0-9]")))

    return (split.withColumn("_v", F.explode(F.filter(F.transform("_runs", described), admitted)))
            .select("doc_id", "place", "_v.value", "_v.direct", F.concat_ws(" ", "lead", "_v.name").alias("lead"),
                    (F.col("_v.assigned") | (F.col("_v.first") & F.col("_after_sign"))).alias("assigned"),
                    F.when(F.col("_v.direct"), F.regexp_count("_v.value", F.lit(r"[/\\]"))).otherwise(F.col("_slashes"))
                    .alias("_slashes"), "_quoted",
                    (F.col("_address") & ~F.col("_v.direct") & ~F.col("_v.value").rlike(ISSUED)).alias("_address")))


def featured(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The candidate values of ``candidates`` and the feature columns."""
    c = values(found)
    v, lead = F.col("value"), F.col("lead")
    length = F.length(v).cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(v, F.lit(pattern)) / length

    covered = F.aggregate(
        F.filter(F.regexp_extract_all(F.lower(v), F.lit("[a-z]{3,}"), F.lit(0)),
                 lambda p: F.array_contains(F.col("dictionary"), p)),
        F.lit(0), lambda a, p: a + F.length(p)) / length
    one_row = F.broadcast(dictionary)  # one row of at most DICTIONARY words
    return c.join(one_row).select(
        "doc_id", "place", "value", "direct", length.alias("length"),
        share("[0-9]").alias("digits"), share("[A-Z]").alias("uppers"), share("[a-z]").alias("lowers"),
        share("[0-9a-f]").alias("hexes"),
        share("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])").alias("changes"),
        share("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])").alias("case_changes"),
        (F.size(F.array_distinct(F.split(v, ""))) / length).alias("distinct"), covered.alias("covered"),
        (F.col("_slashes") / length).alias("slashes"), F.col("_address").cast("double").alias("address"),
        F.col("assigned").cast("double").alias("assigned"), F.col("_quoted").cast("double").alias("quoted"),
        lead.rlike(NAMES).cast("double").alias("named"), lead.rlike(OTHERS).cast("double").alias("other_named"))


def rule_label() -> Column:
    """1 and 0 for the clear cases, null for the rest."""
    secret = F.col("value").rlike(ISSUED) | ((F.col("named") > 0) & (F.col("assigned") > 0) & (F.col("digits") > 0.1)
                                             & (F.col("covered") < 0.3) & (F.col("digits") < 1)
                                             ) | (F.col("direct") & (F.col("covered") < 0.3) & (F.col("digits") < 1))
    plain = ((F.col("digits") >= 0.95) | (F.col("address") > 0) | (F.col("covered") >= 0.6)
             | ((F.col("slashes") > 0) & (F.col("named") == 0)))
    return F.when(secret & (F.col("address") == 0), 1.0).when(plain & ~F.col("direct"), 0.0)


def training_sample(labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(features, label, weight): of each label at most ``sample`` findings by a
    hash of where they stand, not of their features, as equal findings would
    share it; a table without these columns is taken in an order of its own."""
    known = labelled.where("label is not null")
    place = [c for c in ("doc_id", "place", "value") if c in known.columns]
    order = F.xxhash64(*(place if "doc_id" in place else [F.monotonically_increasing_id()]))
    total = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    rows = known.withColumn("_order", order).select(*FEATURES, F.col("label").cast("double").alias("label"), "_order")
    parts = [rows.where(F.col("label") == y).orderBy("_order", *FEATURES).limit(sample)
             .withColumn("weight", F.lit(max(1.0, total.get(y, 0) / sample))) for y in (0.0, 1.0)]
    return parts[0].unionByName(parts[1]).drop("_order").coalesce(1)


def fit_forest(labelled: DataFrame, sample: int = SAMPLE):
    """Forest on at most ``sample`` labelled findings of each label, or None without both labels."""
    chosen = written(training_sample(labelled, sample), "sample").coalesce(1)
    if chosen.select("label").distinct().count() < 2:
        return None
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(chosen)
    return RandomForestClassifier(featuresCol="vector", labelCol="label", weightCol="weight", numTrees=TREES,
                                  maxDepth=DEPTH, seed=7).fit(vectors.select("vector", "label", "weight"))


def findings(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, place, value, score, secret) of every candidate in documents (doc_id, text)."""
    docs = texts(docs)
    found = written(featured(candidates(docs), written(common_words(docs), "dictionary"))
                    .withColumn("label", rule_label()), "candidates")
    forest = fit_forest(found if labelled is None else labelled)
    if forest is None:
        scored = found.withColumn("score", F.coalesce("label", F.lit(0.0)))
    else:
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(found)
        scored = (forest.transform(vectors)
                  .withColumn("score", vector_to_array("probability")[1]))
    return scored.select("doc_id", F.col("place").cast("long").alias("place"), "value", "score",
                         (F.col("score") >= threshold).alias("secret"))


def alone(value: Column) -> Column:
    """Pattern of a value that no letter or digit adjoins."""
    return F.concat(F.lit("(?<![A-Za-z0-9])"), F.regexp_replace(value, r"([^\p{L}\p{N}\s])", r"\\$1"),
                    F.lit("(?![A-Za-z0-9])"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets in ``text`` replaced by a mask; all columns kept.  A
    short one is replaced where it stands alone, not inside longer words."""
    own = (findings(docs).where("secret").groupBy(F.col("doc_id").alias("_secret_id"))
           .agg(F.collect_set("value").alias("_secrets")))  # bounded by the document itself
    longest_first = F.array_sort(F.transform("_secrets", lambda v: F.struct((-F.length(v)).alias("n"), v.alias("v"))))
    own = written(own.select("_secret_id", F.transform(longest_first, lambda x: x["v"]).alias("_secrets")), "secrets")
    docs = docs.withColumn("text", F.col("text").cast("string"))
    joined = docs.join(small(own), docs["doc_id"].cast("long") == F.col("_secret_id"), "left")
    clean = F.when(F.col("_secrets").isNull(), F.col("text")).otherwise(
        F.aggregate("_secrets", F.col("text"), lambda t, v: F.when(F.length(v) >= LEAST, F.replace(t, v, F.lit(MASK)))
                    .otherwise(F.regexp_replace(t, alone(v), F.lit(MASK)))))
    return with_text(docs, joined, clean)


def op4_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings(documents(spark, sf_dir)).select(
        "doc_id", "place", F.length("value").cast("long").alias("length"), F.sha2("value", 256).alias("value_sha256"),
        F.round("score", 6).alias("score"), "secret")
