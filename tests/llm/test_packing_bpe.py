"""Packing and the byte-level codec against their libraries."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from corpus import AWKWARD, empty, frame, rows, sample_texts
from hypothesis import given, settings
from hypothesis import strategies as st

from riskspark.llm import bpe, packing

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_pieces_match_the_tokenizer_and_fill_sequences(spark):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    texts = sample_texts() + ["It's a dog's LIFE, isn't it?! 12.5% end...", "ΟΔΟΣ ΣΑΣ, İstanbul", "été. Été!"]
    docs = frame(spark, texts, AWKWARD + rows(texts)[:2])
    got = packing.pack(docs, capacity=256).collect()
    expected = Counter()
    for r in docs.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        for k, lo in enumerate(range(0, len(ids), 256)):
            part = np.asarray(ids[lo:lo + 256], "<u4")
            expected[(r["doc_id"], k, lo, len(part), zlib.crc32(part.tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == expected
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    total = sum(r["length"] for r in got)
    assert len(sequences) <= -(-total // 256) + 2


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 9), min_size=1, max_size=12))
def test_plan_uses_each_length_once_and_first_bin_is_fullest(histogram):
    plan = packing.plan_bins(histogram, 40)
    used = Counter()
    for bin_, times in plan:
        assert sum(bin_) <= 40 and times > 0
        for x in bin_:
            used[x] += times
    assert used == Counter(histogram)
    lengths = sorted(histogram, reverse=True)
    sums = {0}  # brute force of the first bin: the longest length and the fullest completion
    counts = dict(histogram)
    counts[lengths[0]] -= 1
    for x, n in counts.items():
        for _ in range(n):
            sums |= {s + x for s in sums if s + x <= 40 - lengths[0]}
    assert sum(plan[0][0]) == lengths[0] + max(sums)


def test_packing_of_nothing(spark):
    assert packing.pack(empty(spark)).count() == 0


def test_codec_matches_library_and_round_trips(spark):
    import tiktoken
    path = bpe.vocabulary_path()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = sample_texts() + ["Don't  stop 123² 你好 \U0001f600!!\n\n\n x", "aaaa" * 200, "\u0000\u0085 ​"]
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])
           for r in bpe.encode_digests(frame(spark, texts, AWKWARD)).collect()}
    expected = set()
    for r in rows(texts) + [(10_001, "")]:
        ids = library.encode_ordinary(r[1])
        expected.add((r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                      hashlib.sha256(r[1].encode()).hexdigest()))
    assert got == expected
    assert bpe.encode_digests(empty(spark)).count() == 0


def test_words_of_one_query_keep_their_own_tokens():
    """Words of one call, of one byte to a hundred, get their own ids in order, whatever stands beside them."""
    import tiktoken
    encoder = bpe.Encoder(bpe.vocabulary_path())
    library = tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=encoder.ranks, special_tokens={})
    words = ["q", "zq", "\u0085", " ", "ab" * 50, "é", "zqxv", "日本"]
    encoder._encode(words, [w.encode() for w in words])
    for w in words:
        ids = library.encode_ordinary(w)
        assert encoder.words[w] == (len(ids), " ".join(map(str, ids)), w.encode()), w[:10]


def test_word_memory_forgets_without_changing_results(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    encoder = bpe.Encoder(bpe.vocabulary_path())
    first = {}
    for k in range(4):
        batch = [f"wordy{k}", " again", f"zq{k}xv"]
        encoder.learn(batch)
        for w in batch:
            first.setdefault(w, encoder.words[w])
            assert encoder.words[w] == first[w]
            assert encoder.words[w][2].decode() == w


def test_words_and_signs_match_the_tokenizer():
    """Letters that normalization takes apart end in a mark, which joins the sign after it."""
    import pyarrow as pa
    from tokenizers import Tokenizer
    tokenizer, known = Tokenizer.from_file(packing.tokenizer_path()), packing.WordIds(packing.tokenizer_path())
    texts = ["क़. aक़!", "İ. İstanbul, AİB.", "École, ÉCOLE! été... ÿ? ß& straße.", "Война, мир.", "", None,
             "  a.  B,\n\nc\td e.\rf ", "K Å. ‘Yes.’ <|endoftext|> x<|startoftext|>."]
    texts += [f"{chr(c)}. a{chr(c)}b, É{chr(c)}?!" for c in [*range(1, 0xD800, 7), *range(0xC0, 0x250)]]
    for _ in range(2):  # learned, then known
        got = [np.frombuffer(x, "<u4").tolist() for x in packing._texts_ids(known, pa.array(texts), 1)]
        assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_a_word_is_encoded_once_by_the_model_alone():
    import pyarrow as pa
    known, seen = packing.WordIds(packing.tokenizer_path()), {}

    class Counted:
        def __init__(self, name):
            self.name, self.inner = name, getattr(known, name)

        def encode_batch_fast(self, texts, **kw):
            seen[self.name] = seen.get(self.name, []) + " ".join(texts).split()
            return self.inner.encode_batch_fast(texts, **kw)

    for name in ("bare", "tokenizer"):
        setattr(known, name, Counted(name))
    for _ in range(2):
        list(packing._texts_ids(known, pa.array(["Word, word; WORD été! ÉTÉ 12", "word. мир word"] * 50), 1))
    assert sorted(seen["bare"]) == ["word", "été"]
    assert sorted(seen["tokenizer"]) == sorted([",", ";", "!", ".", "12", "мир"])
