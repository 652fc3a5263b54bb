"""Near duplicates, repeated passages and components against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from corpus import AWKWARD, LOWER, empty, frame, rows, sample_texts, words

from riskspark.llm import common, ngram_join, recompression, wordhash
from riskspark.llm.components import connected


def brute_components(docs, width, percent):
    sets = {}
    for i, t in docs:
        w = words((t or "").translate(LOWER))
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]) and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {(i, len(sets[i]), find(i)) for i in sets}


def edited_copies(seed, base_words, copies, edits):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 9999)}" for _ in range(base_words)]
    out = [" ".join(base)]
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randint(0, len(w) - 1)] = f"e{rng.randint(0, 99999)}"
        out.append(" ".join(w))
    return out


def test_components_match_brute_force(spark):
    texts = sample_texts() + edited_copies(1, 120, 40, 7) + edited_copies(2, 30, 30, 3) + ["A b C", "a B c", "a b"] * 2
    docs = frame(spark, texts, AWKWARD)
    for width, percent in ((4, 85), (5, 80)):
        got = {tuple(r) for r in ngram_join.near_duplicates(docs, width, percent).collect()}
        assert got == brute_components([(r[0], r[1]) for r in rows(texts)] + [(10_001, None)], width, percent)


def test_join_over_listed_texts_and_by_shuffle_agree(spark, monkeypatch):
    docs = frame(spark, edited_copies(3, 60, 25, 5))
    listed = {tuple(r) for r in ngram_join.near_duplicates(docs).collect()}
    monkeypatch.setattr(ngram_join, "LISTED", 0)
    assert {tuple(r) for r in ngram_join.near_duplicates(docs).collect()} == listed


def test_one_of_each_keeps_columns_and_awkward_rows(spark):
    texts = edited_copies(4, 80, 10, 1) + ["unlike " + "the rest of them in every word"]
    docs = frame(spark, texts, AWKWARD + rows(texts)[:1])
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    components = brute_components([(r[0], r[1]) for r in rows(texts)], 4, 85)
    assert sorted(i for i in ids if i is not None and i != 10_001) == sorted({c for _, _, c in components})
    assert ids.count(None) == 2 and ids.count(10_001) == 1


def test_near_duplicates_of_nothing(spark):
    assert ngram_join.near_duplicates(empty(spark)).count() == 0
    assert ngram_join.one_of_each(empty(spark)).count() == 0


def test_connected_components(spark):
    rng = random.Random(9)
    edges = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1040)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if find(a) != find(b):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    loops = {a for a, b in edges if a == b}
    assert {x: c for x, c in got.items()} == {x: find(x) for x in parent if x in got}
    assert set(parent) - set(got) <= loops


def brute_removed(docs, window=13):
    first, out = {}, {}
    for i, t in sorted(docs):
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first.setdefault(tuple(w[k:k + window]), i) < i:
                gone[k:k + window] = [True] * window
        out[i] = (len(w), [x for x, g in zip(w, gone) if not g], sum(gone))
    return out


def test_removed_words_match_brute_force(spark):
    texts = sample_texts(n=120)
    docs = [(r[0], r[1]) for r in rows(texts)] + [(10_001, None)]
    expected = {(i, n, gone, hashlib.sha256(" ".join(kept).encode()).hexdigest())
                for i, (n, kept, gone) in brute_removed(docs).items()}
    got = {tuple(r) for r in recompression.removal_digests(frame(spark, texts, AWKWARD)).collect()}
    assert got == expected
    assert sum(x[2] for x in got) > 500


def test_deduplicated_texts(spark):
    texts = sample_texts(n=40)
    docs = frame(spark, texts, AWKWARD)
    out = recompression.deduplicated(docs)
    assert out.columns == docs.columns
    expected = brute_removed([(r[0], r[1]) for r in rows(texts)])
    before = {r[0]: r[1] for r in rows(texts)}
    seen = Counter()
    for r in out.collect():
        seen[r["doc_id"]] += 1
        if r["doc_id"] in expected:
            n, kept, gone = expected[r["doc_id"]]
            assert r["text"] == (" ".join(kept) if gone else before[r["doc_id"]])
            assert r["n_chars"] == len(r["text"])
    assert seen[None] == 2 and seen[10_001] == 1 and len(seen) == len(expected) + 2


def test_windows_are_keyed_alike_wherever_they_stand():
    import numpy as np
    from riskspark.llm.wordhash import mix
    rng = np.random.default_rng(1)
    shared = mix(rng.integers(0, 6, 40).astype(np.uint64))
    for _ in range(30):
        left = mix(rng.integers(0, 6, rng.integers(0, 9)).astype(np.uint64))
        right = mix(rng.integers(0, 6, rng.integers(0, 9)).astype(np.uint64))
        whole = np.concatenate([left, shared, right])
        a = recompression.window_keys(shared, np.zeros(len(shared), int), 13, 2)[:28]
        b = recompression.window_keys(whole, np.zeros(len(whole), int), 13, 2)[len(left):len(left) + 28]
        assert (a == b).all()


def test_dedup_of_nothing(spark):
    assert recompression.removal_digests(empty(spark)).count() == 0
    assert recompression.deduplicated(empty(spark)).count() == 0


def test_windows_alike_in_half_of_their_hash_are_not_repeats(monkeypatch):
    whole = recompression.runs
    monkeypatch.setattr(recompression, "runs", lambda *a: whole(*a) & np.uint64(0xFFFFFFFF) | np.uint64(7 << 32))
    monkeypatch.setattr(recompression, "window_keys", lambda hashes, *a: np.full(len(hashes), 5, np.uint64))
    batch = pa.record_batch([pa.array(range(20)), pa.array([" ".join(f"w{i}x{k}" for k in range(40)) for i in range(20)]),
                             pa.array(range(20), pa.int64())], names=["doc_id", "text", "tag"])
    places = pa.Table.from_batches(recompression._places(13, 2)([batch])).sort_by([("key", "ascending"), ("doc_id", "ascending")])
    assert places.num_rows
    assert not sum(b.num_rows for b in recompression._repeats(places.combine_chunks().to_batches()))


def test_rows_of_a_text_share_the_low_half_of_their_place():
    """Beside doc_id stands the text's tag, equal in all rows of a text, then the word index."""
    texts = [" ".join(f"w{i}v{k % 97}" for k in range(200)) for i in (1, 2)] * 2
    batch = pa.record_batch([pa.array([5, 6, 7, 8], pa.int64()), pa.array(texts), pa.array([-3, 11 << 40 | 9, -3, 11 << 40 | 9], pa.int64())],
                            names=["doc_id", "text", "tag"])
    rows = pa.Table.from_batches(recompression._places(13, recompression.ROUNDS)([batch]))
    doc, place = (rows.column(c).to_numpy() for c in ("doc_id", "place"))
    assert set(doc.tolist()) == {5, 6, 7, 8}
    assert ((place & 0xFFFFFFFF) == np.where(doc % 2 == 1, 0xFFFFFFFD, 9)).all()
    assert (place >> 32).min() == 0 and (place >> 32).max() <= 187


def test_keys_and_hashes_by_parts_equal_those_of_the_whole(monkeypatch):
    texts = sample_texts(n=40) + ["", "a b c", "a " * 500, "x y z " * 300]
    words = wordhash.Words(pa.array(texts))
    hashes = words.hashes()
    text = np.repeat(np.arange(len(texts)), np.diff(words.bounds))
    valid = np.flatnonzero(text[:-12] == text[12:])
    want = recompression.window_keys(hashes, text, 13, 2)[valid]
    for most in (1, 100, 10**9):
        assert (recompression.keys_by_parts(hashes, words.bounds, text, 13, 2, most)[valid] == want).all()
        monkeypatch.setattr(wordhash, "PART_WORDS", most)
        assert (words.hashes() == hashes).all()


def test_windows_of_a_block_take_a_bounded_part_of_memory():
    import tracemalloc
    rng = np.random.default_rng(1)
    texts = [" ".join(map("w{}".format, rng.integers(0, 50_000, 500))) for _ in range(600)]
    batch = pa.record_batch([pa.array(range(600), pa.int64()), pa.array(texts), pa.array(range(600), pa.int64())],
                            names=["doc_id", "text", "tag"])
    tracemalloc.start()
    rows = sum(len(c) // recompression.CHECK for b in recompression._places(13, 2)(iter([batch])) for c in b.column("checks").to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 600 * 488
    assert peak < 25 * batch.column("text").nbytes


def test_arrow_batches_hold_a_block(spark):
    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.nbytes])], names=["n"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    docs = spark.range(12_000).coalesce(1).selectExpr("repeat(cast(id as string), 400) as text")
    try:
        got = [r["n"] for r in common.map_arrow(docs, sizes, "n long").collect()]
        assert len(got) > 1 and max(got) < 1.5 * common.BLOCK_BYTES
        spark.conf.set(key, str(16 << 20))  # a session's own size stays
        assert max(r["n"] for r in common.map_arrow(docs, sizes, "n long").collect()) > 2 * common.BLOCK_BYTES
    finally:
        spark.conf.unset(key)


def test_counting_in_place_equals_bincount():
    texts = pa.array(sample_texts(n=20))
    (batch,) = ngram_join._count_rows(4, 12)([pa.record_batch([texts], names=["text"])])
    got = {p: np.frombuffer(zstandard.ZstdDecompressor().decompress(c), np.int64)
           for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())}
    want = np.bincount((np.concatenate(ngram_join.shingle_sets(texts, 4)) >> np.uint64(52)).astype(int), minlength=1 << 12)
    assert np.concatenate([got[p] for p in sorted(got)]).tolist() == want.tolist()
