"""Substring deduplication by recompression.

Each text's words are compressed by rounds of the recompression technique: a
round names every maximal run of one symbol, then names every pair of a "left"
symbol followed by a "right" one, sides being a hash bit of the symbol.  Names
are 64-bit hashes of what they stand for, so all tasks give equal substrings
equal names without a dictionary, and a symbol's boundaries depend only on the
few words around it (its context).  Hence two equal windows of ``window`` words
hold the same interior symbols wherever they occur: those whose context lies
inside the window.  A window is keyed by the longest of them (ties by name); if
none is certain, by a single word.

One shuffle brings each key's windows together; a window counts as repeated if
the same key and the same 56-bit hash of its words occur in a smaller doc_id; the
words themselves are not compared.  After ``ROUNDS`` rounds a key spans few words,
so the hash decides: of m different windows under one key about m * m / 2^57 meet
another's hash.
Pre-aggregation keeps hot passages small: of the windows in one block of texts
only those of the smallest doc_id travel, the others are known to repeat.  A
second shuffle brings the repeated places back to their texts, which travel
compressed, and whose covered words are removed.

Defined cases: null or empty text has no words; texts shorter than a window lose
nothing; rows without a doc_id are left out of the digests and kept unchanged by
``deduplicated``; repeated rows are treated one by one and never count as each
other's source; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SMALL_BLOCK, blocks, documents, map_arrow, texts
from .wordhash import U, Words, mix, runs

WINDOW = 13
ROUNDS = 2

#: Words whose windows' keys are found at once.
PART_WORDS = 50_000

#: Bytes of a window's hash that travel, and bits of the hash of its symbol.
CHECK = 7
KEY_BITS = 32

#: ``checks`` has a hash for each of the windows; without a key, how many they are.
PLACES = "key long, doc_id long, place long, checks binary"
SPANS = "doc_id long, tag long, span long"


class Symbols:
    """Symbols of a block at one level: names, words [start, end), contexts [cs, ce)."""

    def __init__(self, name, start, end, cs, ce, text):
        self.name, self.start, self.end, self.cs, self.ce, self.text = name, start, end, cs, ce, text

    def take(self, first, last, name, cs, ce) -> "Symbols":
        return Symbols(name, self.start[first], self.end[last], cs, ce, self.text[first])

    def around(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the contexts of the left and right neighbours reach; beyond the
        text there is an unknown word."""
        left, right = self.start - 1, self.end + 1
        same = self.text[1:] == self.text[:-1]
        left[1:][same] = self.cs[:-1][same]
        right[:-1][same] = self.ce[1:][same]
        return left, right


def name_runs(s: Symbols) -> Symbols:
    """Every maximal run of one symbol becomes one symbol named by symbol and length."""
    new = np.ones(len(s.name), bool)
    new[1:] = (s.name[1:] != s.name[:-1]) | (s.text[1:] != s.text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(s.name)) - 1
    length = (last - first + 1).astype(np.uint64)
    named = s.name[first]
    long = length > 1
    named[long] = mix(named[long] ^ mix(length[long] + U(0x632BE59BD9B4E019)))
    left, right = s.around()
    return s.take(first, last, named, left[first], right[last])


def name_pairs(s: Symbols, level: int) -> Symbols:
    """Every left symbol followed by a right symbol becomes one symbol with it."""
    right_side = (mix(s.name + U(0x9E3779B97F4A7C15 * (level + 1) & (2**64 - 1))) & U(1)).astype(bool)
    joined = np.zeros(len(s.name), bool)  # with the next symbol
    joined[:-1] = ~right_side[:-1] & right_side[1:] & (s.text[1:] == s.text[:-1])
    second = np.zeros(len(s.name), bool)
    second[1:] = joined[:-1]
    first = np.flatnonzero(~second)
    pair = joined[first]
    last = first + pair
    named = s.name[first]
    a = first[pair]
    named[pair] = mix(mix(s.name[a]) * U(3) + s.name[a + 1])
    left, right = s.around()
    cs = np.where(right_side[first] & ~pair, left[first], s.cs[first])
    ce = np.where(~right_side[first] & ~pair, right[first], s.ce[last])
    return s.take(first, last, named, cs, ce)


def window_keys(hashes: np.ndarray, text: np.ndarray, window: int, rounds: int) -> np.ndarray:
    """Key of the window starting at each word, valid where the window lies in one text."""
    n = len(hashes)
    best = np.zeros(n, np.uint64)
    at = np.arange(n)
    s = Symbols(hashes, at, at + 1, at, at + 1, text)
    for level in range(rounds):
        s = name_pairs(name_runs(s), level)
        size = s.ce - s.cs
        rank = (np.minimum(s.end - s.start, 255).astype(np.uint64) << U(56)) | (mix(s.name) >> U(8))
        for back in range(window):
            fits = np.flatnonzero((size + back <= window) & (s.cs >= back))
            if not len(fits):
                break
            np.maximum.at(best, s.cs[fits] - back, rank[fits])
    bare = np.flatnonzero(best[:max(0, n - window + 1)] == 0)
    if len(bare):  # no certain symbol: the window's largest word hash
        word = (U(1) << U(56)) | (mix(hashes) >> U(8))
        for k in range(window):
            best[bare] = np.maximum(best[bare], word[bare + k])
    return best


def keys_by_parts(hashes: np.ndarray, bounds: np.ndarray, text: np.ndarray, window: int, rounds: int,
                  most: int = PART_WORDS) -> np.ndarray:
    """``window_keys`` of texts (words from ``bounds`` to the next) over ``most``
    words at a time, or one longer text: a key depends on its text alone, and the
    arrays on the way take many times the words' memory."""
    best, lo = np.zeros(len(hashes), np.uint64), 0
    while lo < len(bounds) - 1:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + most, "right")) - 1)
        part = slice(bounds[lo], bounds[hi])
        if part.stop > part.start:
            best[part] = window_keys(hashes[part], text[part], window, rounds)
        lo = hi
    return best


def _ranges(at: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each stretch of neighbouring ``at``, cut also where ``breaks``."""
    if not len(at):
        return at, at
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | breaks[1:]
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(at)))


def _places(window: int, rounds: int):
    def run(batches):
        for batch in blocks(batches, limit=2 * SMALL_BLOCK):
            words = Words(batch.column("text"))
            hashes = words.hashes()
            n = len(hashes)
            if n < window:
                continue
            sizes = np.diff(words.bounds)
            text = np.repeat(np.arange(len(sizes)), sizes)
            keys = keys_by_parts(hashes, words.bounds, text, window, rounds)
            full = runs(hashes, window)
            at = np.flatnonzero(text[:n - window + 1] == text[window - 1:])
            doc = batch.column("doc_id").to_numpy()
            tag = (batch.column("tag").to_numpy().astype(np.uint64) & U(0xFFFFFFFF))
            owner = text[at]
            # smallest doc_id of each window in this block
            order = np.argsort(full[at], kind="stable")
            value, ids = full[at][order], doc[owner][order]
            new = np.ones(len(at), bool)
            new[1:] = value[1:] != value[:-1]
            least = np.minimum.reduceat(ids, np.flatnonzero(new)) if len(at) else ids
            repeated = np.zeros(len(at), bool)
            repeated[order] = ids > least[np.cumsum(new) - 1]
            # doc_id and tag stand beside each other in a row, and compress together
            place = ((at - words.bounds[owner]).astype(np.uint64) << U(32)) | tag[owner]
            yield from _known(at[repeated], owner[repeated], doc, place[repeated])
            at, owner, place = at[~repeated], owner[~repeated], place[~repeated]
            key = keys[at]
            change = np.ones(len(at), bool)
            change[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
            first, _ = _ranges(at, change)
            checks = np.ascontiguousarray(full[at].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :CHECK])
            bounds = np.append(first, len(at)).astype(np.int32) * CHECK
            yield pa.record_batch([
                pa.array((mix(key[first]) >> U(64 - KEY_BITS)).view(np.int64)), pa.array(doc[owner[first]], pa.int64()),
                pa.array(place[first].view(np.int64)),
                pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(checks)])],
                names=["key", "doc_id", "place", "checks"])

    return run


def _known(at, owner, doc, place):
    change = np.ones(len(at), bool)
    change[1:] = owner[1:] != owner[:-1]
    first, count = _ranges(at, change)
    yield pa.record_batch([
        pa.nulls(len(first), pa.int64()), pa.array(doc[owner[first]], pa.int64()),
        pa.array(place[first].view(np.int64)),
        pa.array([int(c).to_bytes(4, "little") for c in count], pa.binary())], names=["key", "doc_id", "place", "checks"])


def _repeats(batches):
    """Rows sorted by (key, doc_id); a window met under its key in a smaller
    doc_id repeats.  Between batches only the last key's windows are carried."""
    last, seen = None, {}
    for batch in batches:
        known = batch.filter(pa.compute.is_null(batch.column("key")))
        times = np.frombuffer(b"".join(known.column("checks").to_pylist()), "<u4")
        yield _spans(known.column("doc_id").to_numpy(), known.column("place").to_numpy(), times.astype(np.int64))
        batch = batch.filter(pa.compute.is_valid(batch.column("key")))
        if not batch.num_rows:
            continue
        key, doc, place = (batch.column(c).to_numpy() for c in ("key", "doc_id", "place"))
        same = np.zeros(len(key) + 1, bool)  # as the row before
        same[1:-1] = key[1:] == key[:-1]
        shared = same[:-1] | same[1:]
        shared |= (key == last) | (key == key[-1])
        rows = np.flatnonzero(shared)
        checks = batch.column("checks").take(pa.array(rows)).to_pylist()
        wide = np.zeros((sum(map(len, checks)) // CHECK, 8), np.uint8)
        wide[:, :CHECK] = np.frombuffer(b"".join(checks), np.uint8).reshape(-1, CHECK)
        value = wide.view("<u8").reshape(-1)
        count = np.array([len(c) // CHECK for c in checks], np.int64)
        row = np.repeat(rows, count)
        nth = np.arange(len(value)) - np.repeat(np.cumsum(count) - count, count)
        order = np.lexsort((doc[row], value, key[row]))
        k, v, d = key[row][order], value[order], doc[row][order]
        new = np.ones(len(v), bool)
        new[1:] = (k[1:] != k[:-1]) | (v[1:] != v[:-1])
        heads = np.flatnonzero(new)
        least = d[heads]
        if last is not None:
            for i in np.flatnonzero(k[heads] == last).tolist():
                least[i] = min(least[i], seen.get(int(v[heads[i]]), least[i]))
        repeated = np.zeros(len(v), bool)
        repeated[order] = d > least[np.cumsum(new) - 1]
        tail = k[heads] == key[-1]
        if key[-1] != last:
            last, seen = key[-1], {}
        seen.update(zip(v[heads][tail].tolist(), least[tail].tolist()))
        hit = np.flatnonzero(repeated)
        change = np.ones(len(hit), bool)
        change[1:] = row[hit][1:] != row[hit][:-1]
        first, length = _ranges(nth[hit], change)
        head = hit[first]
        yield _spans(doc[row[head]], place[row[head]] + (nth[head] << 32), length.astype(np.int64))


def _spans(doc, place, n) -> pa.RecordBatch:
    """Rows of ``SPANS``: of a text, told by doc_id and tag, ``n`` windows from a word on."""
    at, tag = (place >> 32) & 0xFFFFFFFF, place & 0xFFFFFFFF
    return pa.record_batch([pa.array(doc, pa.int64()), pa.array(tag, pa.int64()), pa.array(at << 32 | n, pa.int64())],
                           names=["doc_id", "tag", "span"])


def repeated_places(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, tag, span): neighbouring windows of a text that repeat a smaller
    doc_id's; ``span`` holds the first one's word index and how many they are."""
    places = map_arrow(docs.withColumn("tag", F.xxhash64("text")), _places(window, rounds), PLACES)
    dealt = places.repartition(F.coalesce("key", F.xxhash64("doc_id", "place"))).sortWithinPartitions("key", "doc_id")
    return map_arrow(dealt, _repeats, SPANS)


def _pack(batches):
    """Texts as compressed bytes, for the way through a shuffle."""
    pack = zstandard.ZstdCompressor(level=6).compress
    for batch in blocks(batches):
        i = batch.schema.get_field_index("text")
        raw = batch.column(i).cast(pa.binary()).to_pylist()
        yield batch.set_column(i, "text", pa.array([None if t is None else pack(t) for t in raw], pa.binary()))


def kept_words(text: bytes, spans, window: int) -> tuple[list[bytes], int]:
    """Words left of a text and how many were removed."""
    words = text.split()  # bytes: exactly the six spaces of the word pattern
    if not spans:
        return words, 0
    gone = np.zeros(len(words), bool)
    for span in spans:
        gone[span >> 32:(span >> 32) + (span & 0xFFFFFFFF) + window - 1] = True
    return [words[i] for i in np.flatnonzero(~gone).tolist()], int(gone.sum())


def _digests(window: int):
    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            n, removed, digest = [], [], []
            for text, spans in zip(*(batch.column(c).to_pylist() for c in ("text", "_spans"))):
                words, gone = kept_words(unpack(text), spans, window)
                n.append(len(words) + gone)
                removed.append(gone)
                digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                   pa.array(digest, pa.string())],
                                  names=["doc_id", "n_words", "n_removed", "kept_sha256"])
    return run


def _cut(window: int, columns: list[str]):
    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for text, spans in zip(*(batch.column(c).to_pylist() for c in ("text", "_spans"))):
                text = None if text is None else unpack(text)
                if spans:
                    words, gone = kept_words(text or b"", spans, window)
                    text = b" ".join(words) if gone else text
                out.append(None if text is None else text.decode())
            batch = batch.select(columns)
            i = batch.schema.get_field_index("text")
            yield batch.set_column(i, "text", pa.array(out, pa.string()))
    return run


def with_places(docs: DataFrame, window: int, rounds: int) -> DataFrame:
    """``docs`` with the text compressed and its repeated spans."""
    found = (repeated_places(texts(docs), window, rounds).groupBy(F.col("doc_id").alias("_id"), F.col("tag").alias("_of"))
             .agg(F.collect_list("span").alias("_spans")))  # bounded by the document itself
    tag = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).bitwiseAND(F.lit(0xFFFFFFFF))
    tagged = docs.withColumn("_tag", tag)
    kinds = T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == "text" else f for f in tagged.schema.fields])
    tagged = map_arrow(tagged, _pack, kinds)
    same = (tagged["doc_id"].cast("long") == F.col("_id")) & (F.col("_tag") == F.col("_of"))
    return tagged.join(found.hint("shuffle_merge"), same, "left").drop("_id", "_of")


def removal_digests(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    return map_arrow(with_places(texts(docs), window, rounds), _digests(window),
                     "doc_id long, n_words long, n_removed long, kept_sha256 string")


def deduplicated(docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS) -> DataFrame:
    """``docs`` with repeated passages cut from ``text`` (kept words then joined by
    one space); all columns kept, n_chars following the text.  A document that
    loses every word has an empty text; rows without doc_id stay as they are."""
    docs = docs.withColumn("text", F.col("text").cast("string"))
    named = docs.where(F.col("doc_id").isNotNull())
    before = F.length("text").alias("_before")
    named = named.select("*", before)
    cut = map_arrow(with_places(named, window, rounds), _cut(window, named.columns), named.schema)
    if "n_chars" in docs.columns:  # a cut text is shorter
        kind = dict(docs.dtypes)["n_chars"]
        cut = cut.withColumn("n_chars", F.when(F.length("text") < F.col("_before"), F.length("text").cast(kind))
                             .otherwise(F.col("n_chars")))
    return cut.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def op8_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(documents(spark, sf_dir))
