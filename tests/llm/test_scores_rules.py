"""Toxicity, secrets, quality rules and resampling."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from corpus import AWKWARD, DOCS, WORD, empty, frame, rows, sample_texts, words
from pyspark.sql import functions as F

from riskspark.llm import divergence, resampling, secrets, toxicity

INSULTS = ["dumbkin", "grobnik", "zilchard"]


def labelled(seed=1, n=400):
    """Clean prose, a third of it with an insult; (doc_id, text, label)."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice(["an", "ti", "re", "on", "st", "el"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    out = []
    for i in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(5, 60))]
        toxic = i % 3 == 0
        if toxic:
            w[rng.randint(0, len(w) - 1)] = rng.choice(INSULTS)
        out.append((i, ". ".join([" ".join(w[:len(w) // 2]), " ".join(w[len(w) // 2:])]), int(toxic)))
    return out


def test_machine_separates_held_out_documents_and_altered_insults():
    data = labelled()
    machine = toxicity.fit([(t, y) for i, t, y in data if i % 4])
    held = [(t, y) for i, t, y in data if i % 4 == 0]
    best = np.array([machine.decisions(sorted(toxicity.instances(t))).max() for t, _ in held])
    predicted = machine.score(best) >= toxicity.THRESHOLD
    assert (predicted == np.array([y == 1 for _, y in held])).mean() > 0.97
    assert (machine.score(machine.decisions(["dumb.kin", "g-r-o-b-n-i-k", "zilchardd", "dumbbkin"])) >= 0.5).all()
    assert (machine.score(machine.decisions(["antire", "onstel", ""])) < 0.5).all()


def test_training_uses_the_whole_sample(spark, monkeypatch):
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    ys = [y for _, y in toxicity.training_sample(docs, labels)]
    assert (ys.count(1), ys.count(0)) == (1500, 2500)
    learned, inner = [], toxicity.kernel
    monkeypatch.setattr(toxicity, "kernel", lambda words, *a: learned.append(set(words)) or inner(words, *a))
    clean = [" ".join(f"cl{k:04d}x" for k in range(i, i + 500)) for i in range(0, 8000, 500)]
    toxicity.fit([(t, 0) for t in clean] + [(f"dumbkin {t}", 1) for t in clean])
    assert all(set(" ".join(clean).split()) <= words for words in learned)


def test_scores_of_awkward_rows(spark):
    data = labelled(n=120)
    texts = [t for _, t, _ in data] + ["x" * 50_000, "", "d u m b k i n"]
    docs = frame(spark, texts, AWKWARD + rows(texts)[:2])
    ids = {t: i for i, t, *_ in rows(texts)}
    labels = spark.createDataFrame([(ids[t], y, 1) for _, t, y in data] + [(None, 1, 1), (5, None, None)],
                                   "doc_id long, toxic int, quality int")
    machine = toxicity.fit_machine(docs, labels)
    got = toxicity.scored(docs, machine).collect()
    assert len(got) == len(texts) + 3 and all(0 <= r["score"] <= 1 for r in got)
    score = {r["doc_id"]: r["score"] for r in got}
    assert score[10_001] == score[ids[""]] < 0.5
    kept = toxicity.without_toxic(docs, machine)
    assert kept.columns == docs.columns
    left = {r["doc_id"] for r in kept.collect()}
    assert {i for i, s in score.items() if s < toxicity.THRESHOLD} <= left and None in left
    nothing = toxicity.fit_machine(docs, labels.where("false"))
    assert toxicity.scored(docs, nothing).where("score > 0.5").count() == 0
    assert toxicity.scored(empty(spark), machine).count() == 0


def test_held_out_rows_are_crc32_remainders(spark):
    import zlib
    got = spark.range(200).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in got)


def test_kernel_features_match_the_definition():
    """k(a, b) by enumerating subsequences, against the folded features."""
    def phi(word):
        s = "\x02" + word + "\x03"
        out = Counter()
        for pattern in toxicity.PATTERNS:
            for i in range(len(s) - pattern[-1]):
                out[s[i] + "".join(s[i + k] for k in pattern)] += toxicity.DECAY ** (pattern[-1] - len(pattern) + 1)
        return out
    a, b = "insult", "inxsult"
    rows_, cols, vals = toxicity.features([a, b])
    dense = np.zeros((2, 1 << toxicity.BITS))
    np.add.at(dense, (rows_, cols), vals)
    pa, pb = phi(a), phi(b)

    def occurrences(word):
        n = len(word) + 2
        return math.sqrt(sum(max(0, n - p[-1]) * toxicity.DECAY ** (2 * (p[-1] - len(p) + 1)) for p in toxicity.PATTERNS))
    expected = sum(pa[u] * pb[u] for u in pa) / occurrences(a) / occurrences(b)
    assert abs(float(dense[0] @ dense[1]) - expected) < 1e-3


def test_secrets_are_found_and_masked(spark):
    rng = random.Random(2)
    digest = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    held, texts = [], []
    for i in range(60):
        kind = i % 4
        key = "AKIA" + "".join(rng.choice("ABCDEFGHJK0123456789") for _ in range(16)) if kind == 0 else digest(24)
        held.append(key if kind < 2 else None)
        texts.append({0: f"the on {key} in", 1: f"of password={key} and", 2: f"card {rng.randint(10**15, 10**16)} the",
                      3: f"see http://site.example.com/{digest(16)}/page the"}[kind])
    texts += ["y" * 30_000 + " z", ""]
    docs = frame(spark, texts, AWKWARD)
    found = secrets.findings(docs).where("secret").collect()
    assert {r["value"] for r in found} == {k for k in held if k}
    out = secrets.redacted(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    masked = {r["doc_id"]: r for r in out.collect()}
    for (i, t, *_), key in zip(rows(texts, shuffle=False), held + [None, None]):
        assert masked[i]["text"] == (t.replace(key, secrets.MASK) if key else t)
        assert masked[i]["n_chars"] == len(masked[i]["text"])
    assert secrets.findings(empty(spark)).count() == 0 and secrets.redacted(empty(spark)).count() == 0


def test_every_value_of_a_word_is_scanned(spark):
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N-XgL0n3I9P"
    hexes = "9b0b4fd1c27e4a9f8d6b", "77aa31c0de5f4b8e9a12"
    secret = {  # text: the values to be masked
        "set aws_secret_access_key=wJalrXUtnFEMIK7MDENGbPxRfiCYzEXAMPLE in": ["wJalrXUtnFEMIK7MDENGbPxRfiCYzEXAMPLE"],
        f"GITHUB_TOKEN=ghp_{hexes[0]}abcdef{hexes[1][:10]}": [f"ghp_{hexes[0]}abcdef{hexes[1][:10]}"],
        f"at access_token:{hexes[0]} at": [hexes[0]],
        f'{{"client_secret":"{hexes[0]}","api_key":"{hexes[1]}"}}': list(hexes),
        f"sent {jwt} so": [jwt],
        f"see https://site.example.com/a?access_token={hexes[1]}&page=2 in": [hexes[1]],
        "my password=hunter2, the shunter2s": ["hunter2"],
        "on DB_PASSWORD='correcthorse' on": ["correcthorse"],
        "a password: p!x@9z# b": ["p!x@9z"],
        "key secret_key=c2VjcmV0a2V5MTIzNDU2Nw==; end": ["c2VjcmV0a2V5MTIzNDU2Nw=="],
    }
    plain = ["the secret: always be kind", "token=${DB_TOKEN} password=null", "author:Smith tokens", "card 4485275742308327 in",
             "see http://site.example.com/0123456789abcdef/page at"]
    texts = [*secret, *plain] + [f"card {4485275742300000 + i} x" for i in range(20)]
    found = {}
    docs = frame(spark, texts)
    for r in secrets.findings(docs).where("secret").collect():
        found.setdefault(r["doc_id"], set()).add(r["value"])
    masked = {r["doc_id"]: r["text"] for r in secrets.redacted(docs).collect()}
    for i, t, *_ in rows(texts, shuffle=False):
        assert found.get(i, set()) == set(secret.get(t, [])), t
        expected = t
        for v in secret.get(t, []):
            expected = re.sub(rf"(?<![A-Za-z0-9]){re.escape(v)}(?![A-Za-z0-9])", secrets.MASK, expected)
        assert masked[i] == expected


def test_forest_takes_labelled_findings(spark):
    docs = frame(spark, [f"id 7{i:04d}abcdef99{i:04d}xy at" for i in range(40)])
    found = secrets.featured(secrets.candidates(docs.select("doc_id", "text")), secrets.common_words(docs))
    wanted = found.withColumn("label", F.when(F.col("length") > 0, 1.0))
    other = wanted.withColumn("label", F.lit(0.0)).withColumn("digits", F.lit(0.01))
    assert secrets.findings(docs, wanted.unionByName(other)).where("secret").count() == 40


def test_forest_sample_holds_both_labels_and_many_findings(spark):
    """Findings with equal features fill the sample in whole if it is ordered by them."""
    zeros = {c: F.lit(0.0) for c in secrets.FEATURES}
    many = spark.range(300).select(F.col("id").alias("doc_id"), F.lit(1).alias("place"), F.lit("v").alias("value"))
    same = [many.withColumns(zeros | {"digits": F.lit(float(y)), "label": F.lit(float(y))}) for y in (0, 1)]
    labelled = same[0].unionByName(same[1].withColumn("doc_id", F.col("doc_id") + 1000))
    assert secrets.fit_forest(labelled, sample=50) is not None
    assert secrets.fit_forest(labelled.drop("doc_id", "place", "value"), sample=50) is not None
    assert secrets.fit_forest(same[0], sample=50) is None
    spread = labelled.withColumn("length", F.when(F.col("doc_id") % 3 == 0, F.xxhash64("doc_id") % 100).otherwise(7.0)
                                 .cast("double"))
    rows = secrets.training_sample(spread, sample=60).collect()
    for y in (0, 1):
        own = [r for r in rows if r["label"] == y]
        assert len(own) == 60 and sum(r["weight"] for r in own) == 300
        assert 25 < sum(r["length"] == 7 for r in own) < 55  # 200 of 300 findings


def brute_rules(text):
    w = words(text)
    lines, seen = 0, set()
    for line in (text or "").split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    windows = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    covered = {p for k in range(len(w) - 7) if windows[tuple(w[k:k + 8])] > 1 for p in range(k, k + 8)}
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), lines, len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))


def test_base_counts_match_brute_force(spark):
    texts = sample_texts() + ["l1 x\nl1 x\n\n \nl1 x\r\nl1 x", "#*$%&|<> " * 30, "one two three four five six seven eight " * 4,
                              "z q   é\u0085x"]
    got = {r["doc_id"]: r for r in divergence.quality_rules(frame(spark, texts, AWKWARD)).collect()}
    for r in rows(texts) + [(10_001, None)]:
        g = got[r[0]]
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"],
                g["base_failed"]) == brute_rules(r[1])
        assert not (g["base_failed"] and g["kept"])
    assert divergence.quality_rules(empty(spark)).count() == 0


def test_divergence_keeps_prose_and_rejects_noise(spark):
    rng = random.Random(4)
    common = ["the", "of", "and", "to", "in", "is"]
    rare = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(500)]
    prose = [" ".join(rng.choice(common) if rng.random() < 0.4 else rng.choice(rare) for _ in range(150)) + "."
             for _ in range(80)]
    noise = ["||| " + " ".join(rng.choice(rare).upper() + "$$%%" for _ in range(150)) for _ in range(4)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(prose + noise)], "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in divergence.quality_rules(docs).where("kept").collect()}
    assert kept == set(range(80))


def test_js_distance(spark):
    p, q = [0.5, 0.5, 0.0], [0.1, 0.3, 0.6]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a)
    got = spark.createDataFrame([(p, q)], "p array<double>, q array<double>").select(
        divergence.js_distance(F.col("p"), F.col("q"))).collect()[0][0]
    assert abs(got - math.sqrt((kl(p) + kl(q)) / 2)) < 1e-12


def test_top_k_is_exact(spark, monkeypatch):
    monkeypatch.setattr(resampling, "LAST_KEYS", 20)
    monkeypatch.setattr(resampling, "EDGES", 10)
    rng = random.Random(6)
    data = [(i, round(rng.gauss(0, 3), 1)) for i in range(500)] + [(1000 + i, 2.0) for i in range(100)]
    keys = spark.createDataFrame(data, "doc_id long, key double")
    order = [i for i, _ in sorted(data, key=lambda x: (-x[1], x[0]))]
    for k in (0, 1, 57, 200, 599, 600):
        assert {r["doc_id"] for r in resampling.top_k(keys, k).where("selected").collect()} == set(order[:k])


def test_resampling_prefers_the_target(spark):
    rng = random.Random(8)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(40)) for _ in range(60)]
    bad = [" ".join(rng.choice(["$$", "##", "win", "click"]) for _ in range(40)) for _ in range(20)]
    docs = frame(spark, good + bad + [""], AWKWARD)
    ids = {t: r[0] for r in rows(good + bad + [""]) for t in [r[1]]}
    target = spark.createDataFrame([(ids[t],) for t in good[:20]], "doc_id long")
    got = resampling.resampled(docs, target, share=0.6).collect()
    assert sum(r["selected"] for r in got) == math.ceil(0.6 * len(got))
    assert {r["doc_id"] for r in got if r["selected"]} <= {ids[t] for t in good}
    again = resampling.resampled(docs, target, share=0.6).where("selected").collect()
    assert {r["doc_id"] for r in again} == {r["doc_id"] for r in got if r["selected"]}
    assert resampling.resampled(empty(spark), target).count() == 0
    assert resampling.resampled(docs, target.where("false")).count() == len(got)


@pytest.mark.parametrize("last", [4, 50_000])
def test_top_k_with_ties_and_repeated_rows(spark, monkeypatch, last):
    """Exactly k rows, whatever is tied: keys, ids, or all of them."""
    monkeypatch.setattr(resampling, "LAST_KEYS", last)
    monkeypatch.setattr(resampling, "EDGES", 6)
    rng = random.Random(last)
    for keyed in ([1.5] * 30, [float(rng.randint(0, 3)) for _ in range(40)], [rng.random() for _ in range(40)]):
        data = [(rng.randint(0, 8), key, i) for i, key in enumerate(keyed)]
        keys = spark.createDataFrame(data, "doc_id long, key double, row long")
        for k in (7, len(data) - 1):
            want = {r for _, _, r in sorted(data, key=lambda d: (-d[1], d[0], d[2]))[:k]}
            assert {r["row"] for r in resampling.top_k(keys, k).where("selected").collect()} == want, (k, keyed[:3])


@pytest.mark.parametrize("scale", [None, 64.0])
def test_importance_matches_the_models(spark, scale):
    """Weights by brute force: smoothed shares of each hashed n-gram under both models."""
    import pyarrow as pa
    texts_ = ["a b!! a b", "", None, "x", "good words here, good words there", "bad bad bad $$$", "a b a b a b"]
    rows_ = [(i, t) for i, t in enumerate(texts_)]
    target = {4, 6}
    docs = spark.createDataFrame(rows_, "doc_id long, text string")
    ids = spark.createDataFrame([(i,) for i in target], "doc_id long")
    got = {r["doc_id"]: r["log_weight"] for r in resampling.resampled(docs, ids, scale=scale).collect()}
    row, bucket = resampling.grams(pa.array([t or "" for t in texts_]))
    assert Counter(row.tolist())[0] == 5 + 4 and Counter(row.tolist())[3] == 1 and 1 not in row
    assert len(set(bucket[row == 0].tolist())) == 3 + 3
    size = 1 << resampling.BUCKETS_BITS
    raw, good = Counter(bucket.tolist()), Counter(b for r, b in zip(row.tolist(), bucket.tolist()) if r in target)
    n_raw, n_good = sum(raw.values()) + size, sum(good.values())

    def ratio(b):
        share = (raw[b] + 1) / n_raw
        prior = 0.001 * n_good
        return math.log((good[b] + prior * share) / (n_good + prior)) - math.log(share)
    for i, _ in rows_:
        own = [ratio(b) for r, b in zip(row.tolist(), bucket.tolist()) if r == i]
        if own:
            want = sum(own) if scale is None else scale * sum(own) / len(own)
            assert got[i] == pytest.approx(want, rel=1e-9)
        else:
            assert got[i] == pytest.approx((scale or 1.0) * min(ratio(b) for b in {*raw, 0, size - 1}), rel=0.2)


def test_candidates_are_found_in_linear_time(spark):
    """A word of a million letters, and one of a million key characters with a late digit."""
    import time
    long = [("q" * 1_000_000,), ("k" * 999_999 + "7",), ("a-b_" * 250_000,), ("x=" * 500_000,)]
    df = spark.createDataFrame([(i, t) for i, (t,) in enumerate(long)], "doc_id long, text string")
    secrets.candidates(df.limit(1)).count()
    start = time.time()
    assert {r["doc_id"] for r in secrets.candidates(df).select("doc_id").collect()} == {1}
    assert time.time() - start < 10


def test_candidate_words_by_brute_force(spark):
    """The pattern tried at a run's start alone finds the words that trying everywhere finds."""
    rng = random.Random(12)
    words_ = ["".join(rng.choice("ab1+/-_.=,") for _ in range(rng.randint(8, 40))) for _ in range(3000)]
    slow = re.compile(r"(?=[A-Za-z0-9_+/-]{12,})[A-Za-z_+/-]*[0-9]")
    df = spark.createDataFrame([(w,) for w in words_], "w string")
    got = {r["w"] for r in df.where(F.col("w").rlike(secrets.CANDIDATE)).collect()}
    assert got == {w for w in words_ if slow.search(w)} and 100 < len(got) < 2900
