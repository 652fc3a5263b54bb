"""Small corpora with the awkward cases, and brute-force versions of the operators."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()),
                     T.StructField("tag", T.StringType()), T.StructField("key", T.StringType())])


def words(text):
    return WORD.findall(text or "")


def sample_texts(seed=3, n=60):
    """Texts with shared passages, near and exact copies, odd spaces and long runs."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(["ba", "ko", "ri", "tu", "né", "ßa", "Lo"]) for _ in range(rng.randint(1, 4)))
                  for _ in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(70)]
    out = []
    for i in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 12, 13, 40, 90, 200]))]
        if i % 4 == 0:
            at = rng.randint(0, len(w))
            w[at:at] = passage[rng.randint(0, 20):rng.randint(45, 70)]
        if i % 7 == 3 and out:
            w = words(out[rng.randint(0, len(out) - 1)])
            if i % 2 and len(w) > 30:
                w[rng.randint(0, len(w) - 1)] = "edited"
        out.append("".join(x + rng.choice([" ", " ", " ", "\n", "\t", "  ", "\r\n"]) for x in w))
    out += ["a " * 40, "a " * 25 + "b " * 25, "x y z", "", "   \n", "the\x1cone two " * 12, "w" * 5000]
    out.append(" ".join(rng.choice(vocabulary) for _ in range(20_000)))
    return out


def rows(texts, shuffle=True):
    found = [(i * 3 % (len(texts) * 3 + 1), t, ["en", "de", None][i % 3], "s", len(t or ""), "x", "y", "z")
             for i, t in enumerate(texts)]
    if shuffle:
        random.Random(5).shuffle(found)
    return found


def frame(spark, texts, extra=()):
    return spark.createDataFrame(rows(texts) + list(extra), DOCS).repartition(3)


#: Rows with nulls: no text, no id, nothing at all.
AWKWARD = [(10_001, None, None, None, None, None, None, None), (None, "some words without an id", "en", None, 1, "", "", ""),
           (None, None, None, None, None, None, None, None)]


def empty(spark):
    return spark.createDataFrame([], DOCS)
