"""Cross-tokenizer alignment by galloping intersection.

Two tokenizers cut the same bytes.  The ends of their tokens are two sorted
lists; the shorter one drives an exponential and then binary search into the
longer one, and the ends found in both cut the tokens into groups.  Common
indices slice the groups, and the differences of their ranks in the two lists
are how many tokens of either side a group holds.  The last tokens of a group
end together: they are a link, and its id pair is counted over the corpus.

One Arrow pass tokenizes and aligns blocks of texts, each distinct word once
while it is remembered, and writes, a document, its counts and its distinct
linked pairs.  Spark sums the pairs over the corpus and
joins the sums back to the documents' pairs.  A pair in every document is summed
map-side; the join broadcasts the sums where they are few, else it shuffles.

Defined cases: null and empty texts, and texts whose tokens do not spell them
(the second tokenizer writes spaces as U+2581, so a text with that sign), have
no tokens: zeros and an empty digest; special tokens' strings are plain text;
rows without a doc_id are left out, repeated rows are aligned one by one, and
each counts; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SMALL_BLOCK, blocks, documents, map_arrow, small, texts, written

FIRST = "byte_bpe_50k.json"
SECOND = "piece_bpe_32k.model"

SCHEMA = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "pairs array<long>, times array<int>")
#: A pair is first id * PAIR + second id.
PAIR = 1 << 32


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path(FIRST), public_tokenizers.path(SECOND)


def _byte_of() -> dict[str, int]:
    """Byte of each sign in which a byte-level vocabulary writes its tokens:
    visible Latin-1 signs stand for themselves, the other bytes follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, first: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.first = Tokenizer.from_file(first)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        byte = _byte_of()
        vocabulary = self.first.get_vocab()
        self.first_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.first_bytes[i] = bytes(map(byte.__getitem__, token)) if all(c in byte for c in token) else token.encode()
        self.second_bytes = []
        for i in range(self.second.vocab_size()):
            piece = self.second.id_to_piece(i)
            self.second_bytes.append(bytes([int(piece[3:-1], 16)]) if self.second.is_byte(i)
                                     else piece.replace("▁", " ").encode())

    def encode(self, found: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; none where the tokens do not spell the text."""
        ask = [i for i, t in enumerate(found) if t]
        a, b = [[]] * len(found), [[]] * len(found)
        spaced = [" " + found[i] for i in ask]
        first = self.first.encode_batch_fast(spaced, add_special_tokens=False)
        second = self.second.encode([found[i] for i in ask], num_threads=1)
        for i, text, x, y in zip(ask, spaced, first, second):
            raw, x = text.encode(), x.ids
            if b"".join(map(self.first_bytes.__getitem__, x)) == raw == b"".join(map(self.second_bytes.__getitem__, y)):
                a[i], b[i] = x, y
        return a, b


def gallop(values: np.ndarray, inside: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Index in sorted ``inside`` of the first element that is not below each of
    ``values``: from ``start`` on, steps double until they pass the value, then
    the last step is halved.  All values search in lockstep."""
    n, at = len(inside), np.clip(start, 0, max(len(inside) - 1, 0))
    low, high = np.full(len(values), -1), np.full(len(values), n)  # inside[low] < value <= inside[high]
    if not n:
        return high
    less = inside[at] < values
    low[less], high[~less] = at[less], at[~less]
    for side, sign in ((np.flatnonzero(less), 1), (np.flatnonzero(~less), -1)):
        step = 1
        while len(side):
            probe = at[side] + sign * step
            side, probe = side[(probe >= 0) & (probe < n)], probe[(probe >= 0) & (probe < n)]
            below = inside[probe] < values[side]
            low[side[below]], high[side[~below]] = probe[below], probe[~below]
            side = side[below == (sign > 0)]
            step *= 2
    side = np.flatnonzero(high - low > 1)
    while len(side):
        middle = (low[side] + high[side]) >> 1
        below = inside[middle] < values[side]
        low[side[below]], high[side[~below]] = middle[below], middle[~below]
        side = side[high[side] - low[side] > 1]
    return high


def common_ends(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the ends that stand in both lists.  The lists hold the ends of
    several texts after each other; of each text the shorter list searches."""
    in_a, in_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    for short, long, n_s, n_l, at_s, at_l, own, other, mine in (
            (a, b, n_a, n_b, first_a, first_b, in_a, in_b, n_a <= n_b),
            (b, a, n_b, n_a, first_b, first_a, in_b, in_a, n_b < n_a)):
        doc = np.repeat(np.arange(len(n_s)), n_s)
        index = np.flatnonzero(mine[doc])
        doc = doc[index]
        guess = at_l[doc] + (index - at_s[doc]) * n_l[doc] // np.maximum(n_s[doc], 1)
        place = gallop(short[index], long, guess)
        hit = place < len(long)
        hit[hit] = long[place[hit]] == short[index[hit]]
        own[index[hit]], other[place[hit]] = True, True
    return np.flatnonzero(in_a), np.flatnonzero(in_b)


def _strings(n: int, end: str) -> np.ndarray:
    """Decimal ids of a vocabulary, followed by a comma; after them the same followed by ``end``."""
    return np.array([f"{i}{e}".encode() for e in (",", end) for i in range(n)], object)


#: Places where both tokenizers start anew whatever follows or precedes: a space after a sign that is not white space.
#: One space that ends the text stays with its word: tokenized by itself it would be the empty text.
_CUT = re.compile(r"(?<=\S)(?= )(?! \Z)")
_RUN = re.compile(r"\s\s|^\s|\s$")
#: Units remembered between blocks, and their characters; all are forgotten beyond either.
CACHE_UNITS = 200_000
CACHE_CHARS = 8_000_000
#: Characters of new units tokenized in one call's text.
CALL_CHARS = 4_000


def units(text: str) -> list[str]:
    """A text after a space, cut where both tokenizers start anew: its words, each with the spaces before it."""
    if _RUN.search(text):
        return _CUT.split(" " + text)
    return [" " + w for w in text.split(" ")]


class Aligner:
    """Rows of ``SCHEMA`` for blocks of texts.

    Both tokenizers end a token at the end of every unit, so the groups of a text
    are those of its units, one after the other; a unit is aligned when first met."""

    def __init__(self, first: str, second: str):
        self.tokenizers = Tokenizers(first, second)
        self.sizes = [np.array([len(x) for x in v], np.int64)
                      for v in (self.tokenizers.first_bytes, self.tokenizers.second_bytes)]
        self.names = [_strings(len(v), end) for v, end in zip(self.sizes, "|;")]
        if any("▁" in self.tokenizers.second.id_to_piece(i).lstrip("▁") for i in range(len(self.sizes[1]))):
            self.units = lambda text: [" " + text]  # a piece may span words: the text is one unit
        else:
            self.units = units
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.groups: list[bytes] = []  # digest text of a unit
        self.counts = np.empty((0, 3), np.int64)  # tokens of either side and links; none of a unit that is not spelled
        self.links = np.empty(0, np.int64)  # pairs of all units, by unit
        self.first = np.empty(0, np.int64)  # where a unit's begin
        self.pairs: dict[int, int] = {}  # pair -> its number

    def learn(self, new: list[str]) -> None:
        """Align units not met before."""
        calls, size = [[]], 0
        for u in new:  # one that ends in white space ends its text, too
            if calls[-1] and (size + len(u) > CALL_CHARS or calls[-1][-1][-1].isspace()):
                calls.append([])
                size = 0
            calls[-1].append(u)
            size += len(u)
        ids = self.tokenizers.encode(["".join(c)[1:] for c in calls])
        # where the units of a call do not spell it, each is tokenized by itself
        alone = [u for c, x in zip(calls, ids[0]) if not x for u in c]
        calls = [c for c, x in zip(calls, ids[0]) if x] + [[u] for u in alone]
        again = self.tokenizers.encode([u[1:] for u in alone])
        ids = [[x for x in side if x] + more for side, more in zip(ids, again)]
        calls, ids = [c for c, x in zip(calls, ids[0]) if x], [[x for x in side if x] for side in ids]
        good = [u for c in calls for u in c]
        n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in ids)
        a, b = (np.array([i for x in side for i in x], np.int64) for side in ids)
        # calls spell the same bytes on both sides, so running ends agree between calls, too
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        at_a, at_b = common_ends(ends_a, ends_b, n_a, n_b)
        ends = np.cumsum([len(u.encode()) for u in good]) if good else np.empty(0, np.int64)
        upto = [np.searchsorted(x, ends, "right") for x in (ends_a, ends_b, ends_a[at_a])]
        counts = np.stack([np.diff(x, prepend=0) for x in upto], axis=1) if good else np.empty((0, 3), np.int64)

        # tokens in the order of the digest: a group's first-side tokens, then its second-side ones
        out = np.empty(len(a) + len(b), object)
        for tokens, at, other, names in ((a, at_a, np.append(0, at_b + 1), self.names[0]),
                                         (b, at_b, at_a + 1, self.names[1])):
            last = np.zeros(len(tokens), np.int64)
            last[at] = 1
            group = np.cumsum(last) - last
            out[np.arange(len(tokens)) + other[group]] = names[tokens + last * (len(names) // 2)]
        out, lo = out.tolist(), 0
        for hi in (upto[0] + upto[1]).tolist():
            self.groups.append(b"".join(out[lo:hi]))
            lo = hi
        pair = (a[at_a] * PAIR + b[at_b]).tolist()
        links = np.array([self.pairs.setdefault(p, len(self.pairs)) for p in pair], np.int64)
        bad = sorted(set(new) - set(good)) if len(good) < len(new) else []
        self.groups += [b""] * len(bad)
        for u in good + bad:
            self.known[u] = len(self.known)
            self.chars += len(u)
        self.counts = np.concatenate([self.counts, counts, np.zeros((len(bad), 3), np.int64)])
        self.links = np.concatenate([self.links, links])
        self.first = np.cumsum(self.counts[:, 2]) - self.counts[:, 2]

    def rows(self, doc_ids, found: list[str]) -> pa.RecordBatch:
        cut = [self.units(t) if t else [] for t in found]
        if len(self.known) > CACHE_UNITS or self.chars > CACHE_CHARS:
            self.forget()
        self.learn(list({u for us in cut for u in us if u not in self.known}))
        size = np.array([len(us) for us in cut], np.int64)
        unit = np.array([self.known[u] for us in cut for u in us], np.int64)
        doc = np.repeat(np.arange(len(found)), size)
        spelled = np.bincount(doc[self.counts[unit, 0] == 0], minlength=len(found)) == 0
        unit, doc = unit[spelled[doc]], doc[spelled[doc]]
        totals = [np.bincount(doc, weights=self.counts[unit, i], minlength=len(found)).astype(np.int64) for i in range(3)]
        digests, lo, ids = [], 0, unit.tolist()
        for n, ok in zip(size.tolist(), spelled.tolist()):
            hi = lo + n * ok
            text = b"".join(map(self.groups.__getitem__, ids[lo:hi]))
            digests.append(hashlib.sha256(text[:-1]).hexdigest() if text else "")
            lo = hi

        each = self.counts[unit, 2]
        link = self.links[np.repeat(self.first[unit] - (np.cumsum(each) - each), each) + np.arange(each.sum())]
        key, times = np.unique(np.repeat(doc, each) * max(len(self.pairs), 1) + link, return_counts=True)
        doc, pair = key // max(len(self.pairs), 1), np.array(list(self.pairs), np.int64)[key % max(len(self.pairs), 1)]
        offsets = pa.array(np.append(0, np.cumsum(np.bincount(doc, minlength=len(found)))), pa.int32())
        return pa.record_batch([
            doc_ids, *[pa.array(totals[i], pa.int64()) for i in (0, 1, 2, 2)], pa.array(digests, pa.string()),
            pa.ListArray.from_arrays(offsets, pa.array(pair, pa.int64())),
            pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))],
            names=[c.split()[0] for c in SCHEMA.split(", ")])


#: Kept while Spark reuses a worker: vocabularies and, within the bounds above, units.
_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _align(paths: tuple[str, str]):
    def run(batches):
        aligner = _ALIGNERS.get(paths) or _ALIGNERS.setdefault(paths, Aligner(*paths))
        for batch in blocks(batches, limit=SMALL_BLOCK):
            yield aligner.rows(batch.column("doc_id"), batch.column("text").to_pylist())
    return run


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): links that hold a pair, corpus-wide, and whether no
    other pair of its second id has more."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.pairs", "p.times")
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"))
    own = Window.partitionBy(F.col("pair") % PAIR)
    return counts.select("pair", "count", (F.col("count") == F.max("count").over(own)).alias("best"))


def align(docs: DataFrame, paths: tuple[str, str] | None = None, small_rows: int | None = None) -> DataFrame:
    """Per document its tokens, groups and links, the digest of its groups, and
    how common its links are corpus-wide."""
    found = map_arrow(texts(docs), _align(paths or tokenizer_paths()), SCHEMA)
    aligned = written(found.withColumn("row", F.monotonically_increasing_id()), "aligned")  # repeated doc_ids stay apart
    counts = written(pair_counts(aligned), "aligned-pairs")
    counts = small(counts) if small_rows is None else small(counts, small_rows)
    each = (aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
            .select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times")))
    sums = (each.join(counts, "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                 F.sum(F.col("times") * F.col("count")).alias("count_sum")))
    return (aligned.drop("pairs", "times").join(sums, "row", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
                    F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256"))


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir))
