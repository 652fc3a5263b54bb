"""Best-fit packing of tokenized documents by minimum bin slack.

A document becomes its token ids plus one end id; one longer than a sequence is
cut into sequence-sized pieces.  Only piece lengths matter for packing, so Spark
counts pieces per length (at most ``capacity`` numbers) and the plan is made on
these counts: take the longest length left, find by a bitset subset-sum over the
lengths left the fullest completion, and repeat that bin for as long as its
lengths last.  Every step uses up at least one length to less than the bin
needs, so the plan's size depends on ``capacity`` alone, never on the corpus.
Each piece then finds its place from its rank among pieces of its length.

Defined cases: null or empty text is the single end id; rows without a doc_id
and repeated rows are packed like any other; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import blocks, documents, map_arrow, written

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Words and signs whose ids a task remembers; those not met again are forgotten beyond that.
CACHE_WORDS = 400_000
#: Words of texts whose ids are put together at once.
STRETCH = 250_000
#: Signs that may follow a word's letters; the tokenizer cuts between the two.
SIGNS = ".,;:!?&$*#%"
#: Letters that normalization leaves as they are, but for case.
LATIN = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+$"

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


class WordIds:
    """Ids of distinct words.  The tokenizer drops white space and never joins
    across it, so a text's ids are its words' ids.  Words of letters are learned many
    to a call.  Latin ones are cut from the signs after them and learned once, in
    lower case, by the tokenizer's model alone: its other steps ignore case and
    leave such words as they are.  Other letters may hold marks, which join signs."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        size = max(self.tokenizer.get_vocab().values()) + 1
        self.ends = np.zeros(size, dtype=bool)  # tokens that end a word
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith(self.tokenizer.model.end_of_word_suffix or "\0")

    def _plain(self, words: list[str]) -> None:
        for lo in range(0, len(words), 20_000):
            part = words[lo:lo + 20_000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.parts[w] = np.asarray(e.ids, dtype="<u4").tobytes()

    def _letters(self, tokenizer, words: list[str]) -> None:
        groups = [words[lo:lo + 200] for lo in range(0, len(words), 200)]
        for lo in range(0, len(groups), 100):
            some = groups[lo:lo + 100]
            joined = tokenizer.encode_batch_fast([" ".join(g) for g in some], add_special_tokens=False)
            for group, e in zip(some, joined):
                ids = np.asarray(e.ids, dtype="<u4")
                cuts = np.flatnonzero(self.ends[ids]) + 1
                if len(cuts) != len(group):
                    self._plain(group)
                    continue
                raw, at = ids.tobytes(), 0
                for w, hi in zip(group, (cuts * 4).tolist()):
                    self.parts[w] = raw[at:hi]
                    at = hi

    def forget(self) -> None:
        """Give the memory of words back: a worker outlives its tasks."""
        self.parts, self.older = {}, {}

    def _encode(self, words: list[str]) -> None:
        latin = re.compile(LATIN).match
        self._letters(self.bare, [w for w in words if latin(w)])
        self._letters(self.tokenizer, [w for w in words if not latin(w)])

    def _learned(self, words: list[str], encode) -> list[bytes]:
        """Ids of distinct words; ``encode`` learns those not known."""
        if self.older:
            again = [w for w in words if w not in self.parts and w in self.older]
            self.parts.update(zip(again, map(self.older.__getitem__, again)))
        encode([w for w in words if w not in self.parts])
        return list(map(self.parts.__getitem__, words))

    def ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all distinct ``words`` one after the other, and how many each has."""
        if len(self.parts) > CACHE_WORDS // 2:  # parts not met again since the last time are forgotten
            self.older, self.parts = self.parts, {}
        core = pc.utf8_rtrim(words, SIGNS)
        signs = pc.binary_length(words).to_numpy() - pc.binary_length(core).to_numpy()
        latin = pc.match_substring_regex(core, LATIN)
        lettered = pc.or_(latin, pc.utf8_is_alpha(words))
        key = pc.if_else(latin, pc.utf8_lower(core), core)
        letters = key.filter(lettered).dictionary_encode()
        lettered = lettered.to_numpy(zero_copy_only=False)
        signed, plain = np.flatnonzero(lettered & (signs > 0)), np.flatnonzero(~lettered)
        rest = pa.array([w[-n:] for w, n in zip(words.take(pa.array(signed)).to_pylist(), signs[signed].tolist())]
                        + words.take(pa.array(plain)).to_pylist(), pa.string()).dictionary_encode()
        parts = self._learned(letters.dictionary.to_pylist(), self._encode) + \
            self._learned(rest.dictionary.to_pylist(), self._plain) + [b""]
        first = np.full(len(words), len(parts) - 1)
        second = first.copy()
        first[lettered] = letters.indices.to_numpy()
        second[np.concatenate([signed, plain])] = len(letters.dictionary) + rest.indices.to_numpy()
        sizes = np.array(list(map(len, parts)), np.int64) // 4
        both = np.column_stack([first, second]).ravel()
        return _gathered(np.frombuffer(b"".join(parts), "<u4"), sizes, both), sizes[first] + sizes[second]


def _gathered(flat: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Stretches of ``flat``, which has one of each size after the other, in the order ``which``."""
    n = sizes[which]
    shift = (np.cumsum(sizes) - sizes)[which] - (np.cumsum(n) - n)
    return flat[np.repeat(shift, n) + np.arange(n.sum())]


#: Tokenizers kept while Spark reuses a worker; their words go with each task.
_KNOWN: dict[str, WordIds] = {}


def _texts_ids(known: WordIds, text: pa.Array, end_id: int):
    """Ids of each text and the end id, as bytes."""
    text = pc.fill_null(text, "")
    for sign in "\n\t":
        text = pc.replace_substring(text, sign, " ")
    split = pc.split_pattern(text, " ")
    bounds = np.append(0, np.cumsum(pc.list_value_length(split).to_numpy().astype(np.int64)))
    coded = split.flatten().dictionary_encode()
    del text, split
    flat, sizes = known.ids(coded.dictionary)
    flat, sizes, end = np.append(flat, np.uint32(end_id)), np.append(sizes, 1), len(sizes)
    at, lo = coded.indices.to_numpy(), 0
    while lo < len(bounds) - 1:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + STRETCH, "right")) - 1)
        ends = bounds[lo + 1:hi + 1] - bounds[lo]
        words = np.insert(at[bounds[lo]:bounds[hi]], ends, end)
        raw = memoryview(_gathered(flat, sizes, words).astype("<u4", copy=False)).cast("B")
        cuts = 4 * np.cumsum(sizes[words])[ends + np.arange(hi - lo)]
        start = 0
        for stop in cuts.tolist():
            yield raw[start:stop]
            start = stop
        lo = hi


def _tokenize(path: str, capacity: int, end_id: int):
    def run(batches):
        import gc
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        known = _KNOWN.get(path)
        if known is None:
            known = _KNOWN[path] = WordIds(path)
        gc.disable()  # many small values, no cycles
        for batch in blocks(batches):
            out = ([], [], [], [], [])
            for doc, ids in zip(batch.column("doc_id").to_pylist(), _texts_ids(known, batch.column("text"), end_id)):
                for piece, lo in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[lo:lo + 4 * capacity]
                    for col, v in zip(out, (doc, piece, lo // 4, len(part) // 4, zlib.crc32(part))):
                        col.append(v)
            yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                                   *[pa.array(c, pa.int64()) for c in out[2:]]],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32"])
        known.forget()
        gc.enable()
    return run


def tokenized_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
                     end_id: int = END_ID) -> DataFrame:
    """One row per piece: where it starts in its document, its length, the CRC-32 of its ids."""
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(df, _tokenize(path or tokenizer_path(), capacity, end_id), PIECES)


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> list[int]:
    """Lengths (each at most ``counts`` times) with the greatest sum within
    ``room``: subset sums as the bits of one integer, traced back."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in lengths:
        if length > room:
            continue
        for _ in range(min(counts[length], room // length)):
            grown = (reach | (reach << length)) & mask
            if grown == reach:
                break
            steps.append((length, reach))
            reach = grown
        if reach >> room:
            break
    left, chosen = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        if not (before >> left) & 1:
            chosen.append(length)
            left -= length
    return chosen


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(bin as a list of lengths, times it is repeated) until no piece is left."""
    counts = {k: v for k, v in histogram.items() if v > 0}
    lengths = sorted(counts, reverse=True)
    plan = []
    while lengths:
        first = lengths[0]
        counts[first] -= 1
        bin_ = [first, *fullest(lengths, counts, capacity - first)]
        counts[first] += 1
        need = {}
        for x in bin_:
            need[x] = need.get(x, 0) + 1
        times = min(counts[x] // k for x, k in need.items())
        for x, k in need.items():
            counts[x] -= times * k
        if any(counts[x] == 0 for x in need):
            lengths = [x for x in lengths if counts[x]]
        plan.append((bin_, times))
    return plan


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (columns of ``PIECES``)."""
    spark = pieces.sparkSession
    per_length = {r["length"]: r["n"] for r in  # at most `capacity` rows
                  pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    used, sequence, slots = {}, 0, []
    for bin_, times in plan_bins(per_length, capacity):
        offset = 0
        for length in bin_:
            lo = used.get(length, 0)
            slots.append((length, lo, lo + times, sequence - lo, offset))
            used[length] = lo + times
            offset += length
        sequence += times
    table = spark.createDataFrame(slots, "length long, lo long, hi long, shift long, offset long")
    # rank within a length: numbered per salt, so one frequent length is not one task
    salts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = (salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("n"))
              .select("length", "_salt", (F.sum("n").over(
                  Window.partitionBy("length").orderBy("_salt")) - F.col("n")).alias("_before")))
    place = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (salted.withColumn("_nth", F.row_number().over(place) - 1)
              .join(before, ["length", "_salt"])
              .withColumn("_rank", F.col("_before") + F.col("_nth")))
    slot = F.broadcast(table.withColumnRenamed("length", "_length"))  # bounded by the capacity, see plan_bins
    return (ranked.join(slot, (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("lo"))
                        & (F.col("_rank") < F.col("hi")))
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("shift") + F.col("_rank")).alias("sequence_id"), "offset"))


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Documents (doc_id, text) to packed pieces."""
    return pack_pieces(written(tokenized_pieces(docs, path, capacity, end_id), "pieces"), capacity)


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
