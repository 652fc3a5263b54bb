"""Byte-level BPE encoding and decoding with recursive SQL inside each partition.

A task cuts its texts by the split pattern and hands the distinct pieces it has
not met to an in-process DuckDB.  There a piece is rows (word, position, token)
of single bytes; a recursive query joins neighbouring tokens with the merge
table, contracts each word's leftmost pair of least rank, and repeats that for
the words which still have a pair.  Its ordered rows are each word's ids; looked
up in the vocabulary they are its decoded bytes.  A document's ids and bytes are
its words' in order.  Tasks are independent, so a lost executor costs only its
own partitions; nothing is shuffled.

Memory is bounded by the block of texts in hand, ``CHUNK_BYTES`` of new words at
a time and twice ``CACHE_WORDS`` remembered words.

Defined cases: null or empty text has no tokens; rows without a doc_id are left
out, repeated rows are encoded one by one; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import blocks, documents, map_arrow, texts

VOCABULARY = "byte_bpe_50k.tiktoken"
CACHE_WORDS = 400_000
#: Bytes of new words encoded by one query.
CHUNK_BYTES = 1 << 20

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

#: One step contracts one pair per word; ``best`` holds rank and position of the
#: pair, ``k`` the word above 32 bits of position.
ENCODE = """
WITH RECURSIVE step(k, id, more) AS (
  SELECT k, id, true FROM start
  UNION ALL
  (
    WITH n AS MATERIALIZED (
      SELECT k, id, k >> 32 AS w, lead(id) OVER own AS next, lead(k) OVER own AS after, lag(k) OVER own AS before
      FROM step WHERE more WINDOW own AS (ORDER BY k)
    ), least AS MATERIALIZED (
      SELECT n.w, min((m.merged::BIGINT << 32) | (n.k & 4294967295)) AS best
      FROM n JOIN merges m ON m.pair = (n.id::BIGINT << 32 | n.next) WHERE n.after >> 32 = n.w GROUP BY n.w
    )
    SELECT n.k, CASE WHEN n.k & 4294967295 = best & 4294967295 THEN (best >> 32)::INTEGER ELSE n.id END, best IS NOT NULL
    FROM n LEFT JOIN least ON least.w = n.w
    WHERE best IS NULL OR before IS NULL OR before >> 32 <> n.w OR before & 4294967295 <> best & 4294967295
  )
)
SELECT k, id FROM step WHERE NOT more ORDER BY k
"""


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def split_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Encoder:
    """Words to ids and back, by DuckDB, with a bounded memory of words."""

    def __init__(self, path: str):
        import duckdb
        self.ranks = load_ranks(path)
        left, right, merged = [], [], []
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.con = duckdb.connect()
        self.con.execute("SET threads = 1")
        self.con.execute("SET memory_limit = '500MB'")
        self.con.execute("SET temp_directory = ''")  # nothing is spilled to a folder of one machine
        merges = pa.table({"pair": np.array(left, np.int64) << 32 | np.array(right, np.int64), "merged": pa.array(merged, pa.int32())})
        self.con.register("given", merges)
        self.con.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.con.unregister("given")
        self.by_id = {i: t for t, i in self.ranks.items()}
        self.names = {i: str(i) for i in self.by_id}
        self.forget()

    def forget(self) -> None:
        """Give the memory of words back: a worker outlives its tasks."""
        self.words: dict[str, tuple[int, str, bytes]] = {}
        self.older: dict[str, tuple[int, str, bytes]] = {}

    def _encode(self, words: list[str], raws: list[bytes]) -> None:
        """Encode words that are not tokens themselves by the recursive query."""
        sizes = np.array([len(r) for r in raws])
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(raws), dtype=np.int64), sizes)
        pos = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
        ids = self.byte_ids[np.frombuffer(b"".join(raws), np.uint8)]
        start = pa.table({"k": owner << 32 | pos, "id": ids})
        self.con.register("start", start)
        rows = self.con.sql(ENCODE).to_arrow_table()
        self.con.unregister("start")
        tokens = rows.column("id").to_pylist()
        names, parts = list(map(self.names.__getitem__, tokens)), list(map(self.by_id.__getitem__, tokens))
        first = np.flatnonzero(np.diff(rows.column("k").to_numpy() >> 32, prepend=-1)).tolist()  # every word has a token
        for word, lo, hi in zip(words, first, [*first[1:], len(tokens)]):
            self.words[word] = (hi - lo, " ".join(names[lo:hi]), b"".join(parts[lo:hi]))

    def learn(self, new) -> None:
        words, raws, size = [], [], 0
        if len(self.words) > CACHE_WORDS:  # words not met again since the last time are forgotten
            self.older, self.words = self.words, {}
        for word in new:
            if word in self.words:
                continue
            if word in self.older:
                self.words[word] = self.older[word]
                continue
            raw = word.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                self.words[word] = (1, str(rank), self.by_id[rank])  # decoded by its id, as all are
                continue
            words.append(word)
            raws.append(raw)
            size += len(raw)
            if size >= CHUNK_BYTES:
                self._encode(words, raws)
                words, raws, size = [], [], 0
        if words:
            self._encode(words, raws)


_ENCODERS: dict[str, Encoder] = {}


def _codec(path: str, pattern: str):
    def run(batches):
        import gc

        import regex
        pieces = regex.compile(pattern).findall
        encoder = _ENCODERS.setdefault(path, None) or Encoder(path)
        _ENCODERS[path] = encoder  # kept while Spark reuses the worker
        gc.disable()  # many small values, no cycles
        for batch in blocks(batches):
            cut = [pieces(t) for t in batch.column("text").to_pylist()]
            encoder.learn(set().union(*cut))
            known = encoder.words
            counts, ids, decoded = [], [], []
            for words in cut:
                found = [known[w] for w in words]
                counts.append(sum([f[0] for f in found]))
                ids.append(hashlib.sha256(" ".join([f[1] for f in found]).encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join([f[2] for f in found])).hexdigest())
            yield pa.record_batch([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()),
                                   pa.array(decoded, pa.string())],
                                  names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        encoder.forget()
        gc.enable()
    return run


def encode_digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encode and decode every text; token count and digests of ids and decoded bytes."""
    return map_arrow(texts(docs), _codec(path or vocabulary_path(), pattern or split_pattern()), SCHEMA)


def op3_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(documents(spark, sf_dir))
