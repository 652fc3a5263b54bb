"""Toxicity by a support vector machine over a gapped subsequence kernel.

The kernel of two strings sums, over the character subsequences of 3 and 4 they
share, a decay per character spanned; gaps of up to two characters keep a word
similar to itself with letters or signs inserted.  The machine works in the
Nystroem space of landmark words: k(landmarks, landmarks)^(-1/2) k(landmarks, w).
Since the kernel has explicit features, the trained machine folds into one
weight per (hashed) subsequence, and scoring a word is a sum over its own.

Training is on the words of labelled documents, which take their document's
label: no word of a clean document is an insult, and each toxic document has
some word that is one.  The word standing for a toxic document is its best
under the machine so far (multiple-instance rounds, first chosen by document
frequencies); copies of it with inserted characters are added.  A logistic curve
fitted on the training documents turns the best decision value in a text into
its score.

The machine is fitted on a bounded sample (``TOXIC_DOCS``, ``CLEAN_DOCS`` labelled
documents, chosen by hash) on the driver, of whose clean words ``NEGATIVES`` and
the hardest of each document are negatives; every whole text is scored.

Defined cases: a null or empty text has no word and scores as the curve does at
the lowest decision; rows without a doc_id are left out, repeated rows are scored
one by one; without labels of both kinds all scores are 0; an empty table gives
no rows; other columns, labels among them, are never read for a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SMALL_BLOCK, blocks, documents, map_arrow, read_table, texts
from .wordhash import U, mix

#: Labelled documents the machine is fitted on, at most.
TOXIC_DOCS = 1500
CLEAN_DOCS = 2500
LANDMARKS = 256
#: Words of clean documents the machine is fitted on, beside the hardest of each.
NEGATIVES = 20_000
DECAY = 0.6
#: Hashed subsequences.
BITS = 20
#: Longer words are scored in overlapping parts.
PART = 32
#: Words whose features are held at once.
CHUNK = 4_000
ROUNDS = 3
#: Cost of the hinge losses, which have total weight 2, beside the machine's norm.
COST = 5e4
#: Log-likelihood by which a word of toxic documents alone counts as an insult outright.
CERTAIN = 12.0
#: Weight of a word with inserted characters beside a document when the curve is fitted.
ALTERED = 0.05
THRESHOLD = 0.7
#: Words a worker remembers the decision of.
CACHE_WORDS = 150_000

EDGES = ".,;:!?\"'()[]{}|"
SENTENCE = re.compile(r"[.!?\n]+")
#: Offsets of the characters of a subsequence from its first, up to two skipped.
PATTERNS = tuple((1 + a, 2 + a + b) for a in range(3) for b in range(3 - a)) + tuple(
    (1 + a, 2 + a + b, 3 + a + b + c) for a in range(3) for b in range(3 - a) for c in range(3 - a - b))


FACTORS = mix(np.arange(1, 5, dtype=np.uint64)) | U(1)


def instances(text: str) -> set[str]:
    """What a text's decision ranges over: its words in lower case without signs
    at the edges, and runs of three or more single characters as one word."""
    words = text.lower().split()
    out = {w.strip(EDGES) for w in words}
    single = []
    for w in (w.strip(EDGES) for w in words) if any(len(w) == 1 for w in out) else ():
        if len(w) == 1:
            single.append(w)
        else:
            if len(single) > 2:
                out.add("".join(single))
            single = []
    if len(single) > 2:
        out.add("".join(single))
    out.discard("")
    return out


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word index, hashed subsequence, value) of each occurrence; values of a
    word have unit length.  A mark stands before and after each word."""
    joined = "\x02" + "\x03\x02".join(words) + "\x03"
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    owner = np.repeat(np.arange(len(words)), sizes)
    rows, cols, vals = [], [], []
    terms = [codes * f for f in FACTORS]
    for pattern in PATTERNS:
        n = len(codes) - pattern[-1]
        if n <= 0:
            continue
        at = np.flatnonzero(owner[:n] == owner[pattern[-1]:])
        h = terms[0][at] + U(len(pattern))
        for term, step in zip(terms[1:], pattern):
            h += term[at + step]
        h ^= h >> U(31)
        h *= U(0xBF58476D1CE4E5B9)
        rows.append(owner[at])
        cols.append((h >> U(64 - BITS)).astype(np.int32))
        vals.append(np.full(len(at), DECAY ** (pattern[-1] - len(pattern) + 1), np.float32))
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.float32)
    rows, cols, vals = np.concatenate(rows), np.concatenate(cols), np.concatenate(vals)
    norm = np.sqrt(np.bincount(rows, vals * vals, minlength=len(words)))
    return rows, cols, vals / np.maximum(norm, 1e-9)[rows].astype(np.float32)


@dataclass
class Machine:
    weights: np.ndarray  # per hashed subsequence
    bias: float
    slope: float
    shift: float

    def decisions(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.empty(0)
        parts, owner = [], []
        for i, w in enumerate(words):
            if not w.isalpha():  # signs between letters are tried without, too
                bare = "".join(c for c in w if c.isalpha())
                if len(bare) > 2:
                    parts += [bare[k:k + PART] for k in range(0, max(1, len(bare) - PART // 2), PART // 2)]
                    owner += [i] * (len(parts) - len(owner))
            if len(w) <= PART:
                parts.append(w)
                owner.append(i)
            else:
                for lo in range(0, len(w) - PART // 2, PART // 2):
                    parts.append(w[lo:lo + PART])
                    owner.append(i)
        out = np.full(len(words), -np.inf)
        for lo in range(0, len(parts), CHUNK):
            rows, cols, vals = features(parts[lo:lo + CHUNK])
            n = len(parts[lo:lo + CHUNK])
            np.maximum.at(out, owner[lo:lo + CHUNK],
                          np.bincount(rows, self.weights[cols] * vals, minlength=n) + self.bias)
        return out

    def score(self, best: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.maximum(best, -5) + self.shift, -60, 60)))


def kernel(words: list[str], landmarks: np.ndarray, column: np.ndarray) -> np.ndarray:
    """k(words, landmarks); ``column`` maps a hashed subsequence to its column of ``landmarks``, or -1."""
    out = np.zeros((len(words), landmarks.shape[0]), np.float32)
    by_column = np.ascontiguousarray(landmarks.T)
    for lo in range(0, len(words), 250):
        rows, cols, vals = features(words[lo:lo + 250])
        hit = np.flatnonzero(column[cols] >= 0)
        hit = hit[np.argsort(rows[hit], kind="stable")]
        if len(hit):
            own, first = np.unique(rows[hit], return_index=True)
            out[lo + own] = np.add.reduceat(by_column[column[cols[hit]]] * vals[hit][:, None], first)
    return out


def fit_svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = COST) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps over its support
    vectors; a step's sums are taken chunk by chunk."""
    size = z.shape[1] + 1
    w, ridge = np.zeros(size), np.eye(size)
    ridge[-1, -1] = 1e-3
    for _ in range(30):
        gradient, hessian = ridge @ w, ridge.copy()
        for lo in range(0, len(z), CHUNK):
            x = np.hstack([z[lo:lo + CHUNK], np.ones((len(z[lo:lo + CHUNK]), 1))])
            yx, wx = y[lo:lo + CHUNK], weight[lo:lo + CHUNK]
            slack = 1 - yx * (x @ w)
            on = slack > 0
            xs, ws = x[on], wx[on]
            gradient -= 2 * c * xs.T @ (ws * yx[on] * slack[on])
            hessian += 2 * c * (xs * ws[:, None]).T @ xs
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def with_insertions(words: list[str], seed: int = 7) -> list[str]:
    """Each word again with one and with two characters or signs inserted, in turn."""
    rng, out = np.random.default_rng(seed), []
    for w in words:
        for k in (1, 2):
            v = w
            for _ in range(k):
                i = int(rng.integers(1, max(2, len(v))))
                v = v[:i] + "abcdefghijklmnopqrstuvwxyz.-*_"[int(rng.integers(30))] + v[i:]
            out.append(v)
    return out


def fit(samples: list[tuple[str, int]], landmarks: int = LANDMARKS) -> Machine:
    """Machine from (text, label) pairs."""
    size = 1 << BITS
    bags = [(sorted(set().union(*(instances(s) for s in SENTENCE.split(t)))), y) for t, y in samples]
    toxic = [b for b, y in bags if y and b]
    clean = [b for b, y in bags if not y and b]
    if not toxic or not clean:
        return Machine(np.zeros(size, np.float32), 0.0, 0.0, -60.0)
    seen = [{}, {}]
    for k, group in enumerate((clean, toxic)):
        for bag in group:
            for w in bag:
                seen[k][w] = seen[k].get(w, 0) + 1
    odds = {w: np.log((n + 0.1) / len(toxic)) - np.log((seen[0].get(w, 0) + 0.1) / len(clean)) + 0.5 * np.log(n)
            for w, n in seen[1].items()}
    certain = sorted(telling_words(seen, toxic, len(clean)), key=lambda w: (-seen[1][w], w))
    telling = list(dict.fromkeys(certain + sorted(odds, key=lambda w: (-odds[w], w))))[:landmarks * 3 // 4]
    plain = sorted(seen[0], key=_hash)[:NEGATIVES]
    marks = telling + plain[:landmarks - len(telling)]
    rows, cols, vals = features(marks)
    used = np.unique(cols)
    column = np.full(size, -1, np.int32)
    column[used] = np.arange(len(used))
    matrix = np.zeros((len(marks), len(used)), np.float32)
    np.add.at(matrix, (rows, column[cols]), vals)
    value, vector = np.linalg.eigh((matrix @ matrix.T).astype(np.float64))
    keep = value > 1e-6
    root = vector[:, keep] / np.sqrt(value[keep])
    witness = [max(b, key=lambda w: (odds[w], w)) for b in toxic]
    hard: set[str] = set()
    machine = None
    for _ in range(ROUNDS):
        positive = sorted({*witness, *certain})
        positive += with_insertions(positive)
        negative = sorted((set(plain) | hard) - set(positive))
        z = kernel(positive + negative, matrix, column) @ root
        y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
        often = np.sqrt([seen[1].get(w, 1) for w in positive])
        rare = np.where([w in hard for w in negative], 4.0, 1.0)
        w, bias = fit_svm(z, y, np.r_[often / often.mean() / len(positive), rare / rare.mean() / len(negative)])
        alpha = (root @ w).astype(np.float32)
        weights = np.zeros(size, np.float32)
        weights[used] = alpha @ matrix
        machine = Machine(weights, bias, 1.0, 0.0)
        del z
        decision = dict(zip(odds | seen[0], machine.decisions(list(odds | seen[0])).tolist()))
        witness = [max(b, key=lambda v: (decision[v], v)) for b in toxic]
        hard |= {max(b, key=lambda v: (decision[v], v)) for b in clean}
    best = np.array([max(decision[v] for v in b) if b else -5 for b, _ in bags])
    label = np.array([y for _, y in bags], float)
    altered = machine.decisions(with_insertions(witness, seed=11)[::2])  # count as toxic texts, too
    machine.slope, machine.shift = _logistic(np.r_[np.maximum(best, -5), altered], np.r_[label, np.ones(len(altered))],
                                              np.r_[np.ones(len(label)), np.full(len(altered), ALTERED)])
    return machine


def telling_words(seen: list[dict[str, int]], toxic: list[list[str]], clean: int) -> list[str]:
    """Words of no clean document in so many toxic ones that chance is out; of
    documents sharing most words, as copies do, one counts."""
    need = int(np.ceil(CERTAIN / np.log((len(toxic) + clean) / len(toxic))))
    where: dict[str, list[set[str]]] = {
        w: [] for w, n in seen[1].items() if n >= need and w not in seen[0]}
    for bag in toxic:
        own = set(bag)
        for w in bag:
            kept = where.get(w)
            if kept is not None and len(kept) < need and not any(2 * len(own & k) > min(len(own), len(k))
                                                                 for k in kept):
                kept.append(own)
    return [w for w, kept in where.items() if len(kept) >= need]


def _hash(word: str) -> int:
    import zlib
    return zlib.crc32(word.encode())


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve with smoothed targets (Platt)."""
    n1, n0 = (weight * y).sum(), (weight * (1 - y)).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a = np.c_[x, np.ones(len(x))]
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -60, 60)))
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, a.T @ (weight * (p - target)) + 1e-2 * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 0.0)), float(w[1])


def _best(machine: Machine, known: dict[str, float], values: list) -> np.ndarray:
    """Best decision in each text; ``known`` remembers words."""
    bags = [instances(t or "") for t in values]
    if len(known) > CACHE_WORDS:
        known.clear()
    new = [w for w in set().union(*bags) if w not in known]
    known.update(zip(new, machine.decisions(new).tolist()))
    return np.array([max(map(known.__getitem__, b), default=-5.0) for b in bags])


def _score(shared):
    def run(batches):
        machine = shared.value
        known: dict[str, float] = {}
        for batch in blocks(batches, limit=SMALL_BLOCK):
            best = _best(machine, known, batch.column("text").to_pylist())
            yield pa.record_batch([batch.column("doc_id"), pa.array(machine.score(best), pa.float64())],
                                  names=["doc_id", "score"])
    return run


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def training_sample(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC_DOCS,
                    clean: int = CLEAN_DOCS) -> list[tuple[str, int]]:
    """Labelled training documents, at most ``toxic`` and ``clean``, chosen by hash of the id."""
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
            .where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id"))))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = (rows.where("toxic = 1").orderBy(*order).limit(toxic)
              .unionByName(rows.where("toxic = 0").orderBy(*order).limit(clean)))
    found = (texts(docs).join(F.broadcast(chosen), "doc_id")  # toxic + clean rows at most
             .select("doc_id", "text", "toxic").collect())
    once = {r["doc_id"]: (r["text"], r["toxic"]) for r in sorted(found)}
    return [once[k] for k in sorted(once)]


def fit_machine(docs: DataFrame, labels: DataFrame) -> Machine:
    return fit(training_sample(docs, labels))


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    return map_arrow(texts(docs), _score(shared), "doc_id long, score double")


def _keep(shared, threshold: float):
    def run(batches):
        machine = shared.value
        known: dict[str, float] = {}
        for batch in blocks(batches, limit=SMALL_BLOCK):
            best = _best(machine, known, batch.column("text").to_pylist())
            yield batch.filter(pa.array(machine.score(best) < threshold))
    return run


def without_toxic(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` scoring below ``threshold``, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    return map_arrow(docs, _keep(shared, threshold), docs.schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    machine = fit_machine(docs, read_table(spark, sf_dir, "labels"))
    return scored(docs, machine).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
