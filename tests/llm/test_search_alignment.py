"""Ranked lexical search, cross-tokenizer alignment and exact top-k against brute force."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from riskspark.llm import alignment, maxscore, threshold

from corpus import AWKWARD, LOWER, empty, frame, rows, sample_texts

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, doc_id long, score string, rank int"


# ---------------------------------------------------------------- ranked lexical search

def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_search(docs, items, k):
    held = [(i, collections.Counter(split(t))) for i, t in docs if i is not None and split(t)]
    n_docs, all_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in held:
            m = 10 + 90 * sum(c.values()) * n_docs // all_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in set(split(text)) if t in c)
            if s > 0:
                found.append((-s, doc))
        out += [(item, r + 1, doc, -s) for r, (s, doc) in enumerate(sorted(found)[:k])]
    return sorted(out)


def test_terms():
    text = "Ab-cD_9 né\x00ß\x7fÉ  x\ny"
    assert [t.decode() for t in maxscore.terms(text) if t] == split(text) == ["ab", "cd", "9", "né", "ß", "É", "x", "y"]
    assert [t for t in maxscore.terms(None) if t] == []


@pytest.mark.parametrize("chunk, block_terms, reach", [(16_384, 50_000, 3), (7, 30, 1), (9, 1, 10), (20, 500, 0)])
def test_search_equals_brute_force(spark, chunk, block_terms, reach):
    found = sample_texts(n=80)
    docs = rows(found, shuffle=False)
    docs += [(90_001, docs[0][1], None, None, 0, "", "", ""), (90_001, docs[0][1], None, None, 0, "", "", "")]  # repeated rows
    items = [(3 * i, found[i][:300], 7, "s", 1) for i in range(25)]
    items += [(500, "Lo lo LO ba", 1, "", 1), (501, "unmet terms only zzzz", 1, "", 1), (502, "", 1, "", 1), (503, " -- ", 1, "", 1)]
    extra = [(None, "ba ko", 1, "", 1), (504, None, 1, "", 1)]
    got = maxscore.search(spark.createDataFrame(docs + AWKWARD, frame(spark, []).schema).repartition(5),
                          spark.createDataFrame(items + extra, ITEMS), 10, chunk, block_terms, reach).collect()
    want = brute_search([d[:2] for d in docs], [i[:2] for i in items], 10)
    assert sorted(map(tuple, got)) == want


def test_search_of_nothing(spark):
    some = spark.createDataFrame([(1, "ba", 1, "", 1)], ITEMS)
    none = spark.createDataFrame([], ITEMS)
    assert maxscore.search(empty(spark), some).count() == 0
    assert maxscore.search(frame(spark, ["ba", "ko"]), none).count() == 0
    assert maxscore.search(frame(spark, ["", "ko"]), some).count() == 0
    assert maxscore.search(frame(spark, ["", "ko"]), some).columns == ["item_id", "rank", "doc_id", "score"]


def test_texts_of_one_item_are_united(spark):
    docs = frame(spark, ["ba ko", "ko", "ri", "tu"])
    two = maxscore.search(docs, spark.createDataFrame([(1, "ba", 1, "", 1), (1, "ko ri", 1, "", 1), (1, "ba", 1, "", 1)], ITEMS))
    one = maxscore.search(docs, spark.createDataFrame([(1, "ri ba ko ko", 1, "", 1)], ITEMS))
    assert sorted(two.collect()) == sorted(one.collect()) and two.count() == 3


def random_lists(rng, n_rows, n_terms):
    lists = {}
    for t in range(n_terms):
        r = np.sort(rng.choice(n_rows, rng.integers(1, n_rows // (1 + t % 7)), replace=False))
        lists[t] = r, rng.integers(1, 1000, len(r))
    return lists


def test_bounds_hold_and_skip():
    """No set of lists adds more than its bound; pairs make bounds tighter and skip more; results are the same."""
    rng = np.random.default_rng(3)
    skipped = []
    for _ in range(30):
        lists = random_lists(rng, 400, 12)
        total = np.zeros(400, np.int64)
        for r, x in lists.values():
            total[r] += x
        weights = np.array([x.max() for _, x in lists.values()])
        joint = {(a, b): int(maxscore.intersect(*lists[a], *lists[b])[1].max(initial=0))
                 for a, b in maxscore.item_pairs(list(lists), weights, 12)}
        tops = {t: int(x.max()) for t, (_, x) in lists.items()}
        order = sorted(lists, key=lambda t: (-tops[t], t))
        bounds, plain = maxscore.pair_bounds(order, tops, joint), maxscore.pair_bounds(order, tops, {})
        for i in range(len(order)):
            rest = np.zeros(400, np.int64)
            for t in order[i:]:
                rest[lists[t][0]] += lists[t][1]
            assert rest.max() <= bounds[i] <= plain[i] == sum(tops[t] for t in order[i:])
        want = sorted(total[total > 0].tolist())[::-1][:10]
        looked = []
        for known in (joint, {}):
            for floor in (0, want[-1]):
                found, score, n = maxscore.search_chunk(lists, known, list(lists), 400, 10, floor)
                assert sorted(score[found].tolist())[::-1][:10] == want and (score[found] == total[found]).all()
                assert set(np.flatnonzero(total >= want[-1])) == set(found.tolist())
                looked.append(n)
        assert looked[1] <= looked[0]
        skipped.append((looked[0], looked[2]))
    assert sum(a for a, _ in skipped) < sum(b for _, b in skipped)


# ---------------------------------------------------------------- cross-tokenizer alignment

@pytest.fixture(scope="module")
def tokenizers():
    return alignment.Tokenizers(*alignment.tokenizer_paths())


def brute_align(tokenizers, texts):
    """Literal reading of the definition: every pair of tokens whose byte ranges end together."""
    docs, counts = [], collections.Counter()
    for text in texts:
        a, b = ([], []) if not text else (tokenizers.first.encode(" " + text, add_special_tokens=False).ids,
                                          tokenizers.second.encode(text))
        size_a, size_b = [tokenizers.first_bytes[i] for i in a], [tokenizers.second_bytes[i] for i in b]
        if b"".join(size_a) != (" " + (text or "")).encode() or b"".join(size_b) != b"".join(size_a):
            a, b, size_a, size_b = [], [], [], []
        ends_a, ends_b = ({sum(map(len, s[:i + 1])): i for i in range(len(s))} if len(s) < 400 else
                          dict(zip(np.cumsum([len(x) for x in s]).tolist(), range(len(s)))) for s in (size_a, size_b))
        common = sorted(set(ends_a) & set(ends_b))
        links = [(a[ends_a[e]], b[ends_b[e]]) for e in common]
        groups, i, j = [], 0, 0
        for e in common:
            groups.append(",".join(map(str, a[i:ends_a[e] + 1])) + "|" + ",".join(map(str, b[j:ends_b[e] + 1])))
            i, j = ends_a[e] + 1, ends_b[e] + 1
        docs.append((len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
        counts.update(links)
    best = collections.Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [(n_a, n_b, len(links), len(links), sum(counts[p] == best[p[1]] for p in links),
             sum(counts[p] for p in links), digest) for n_a, n_b, links, digest in docs]


STRANGE = ["a▁b", "<|endoftext|> and <s> </s> <unk>", "日本語 ñandú 🙂 ́x", "  two  spaces ", "\n\ttab\r\nline", "x" * 9_000,
           "na ïve ﬁ", "\x00 zero", "ab " * 4_000, " ", "▁"]


@pytest.mark.parametrize("small_rows", [None, 0])
def test_alignment_equals_brute_force(spark, tokenizers, small_rows):
    texts = STRANGE + sample_texts(n=30) + ["", None]
    given = rows(texts, shuffle=False) + [(0, texts[0], None, None, 0, "", "", ""), (6, texts[2], None, None, 0, "", "", "")]
    given.append((6, texts[2], None, None, 0, "", "", ""))  # a document three times
    got = alignment.align(spark.createDataFrame(given + AWKWARD, frame(spark, []).schema).repartition(4), small_rows=small_rows)
    want = brute_align(tokenizers, [g[1] for g in given])
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted([(g[0], *w) for g, w in zip(given, want)] + [(10_001, *[0] * 6, "")])
    assert alignment.align(empty(spark)).count() == 0


def test_units_learned_one_by_one_spell_their_text(tokenizers):
    """Whatever units share a call: a single space at a text's end is no unit."""
    aligner = alignment.Aligner(*alignment.tokenizer_paths())
    for text in ["ab ", "ab cd ", "a ", "ab  ", " ab", "ab \n", "ab\n ", "a  b ", " ", "  ", "ab \x85", "ab\u3000"]:
        aligner.forget()
        for unit in alignment.units(text):
            aligner.learn([unit])
        row = aligner.rows(pa.array([1], pa.int64()), [text]).to_pylist()[0]
        n_a, n_b, n_groups, n_links, *_, digest = brute_align(tokenizers, [text])[0]
        assert n_a > 0, text
        assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"], row["groups_sha256"]) == (n_a, n_b, n_groups, n_links, digest), text


def test_gallop_equals_searchsorted():
    rng = np.random.default_rng(5)
    for _ in range(200):
        inside = np.unique(rng.integers(0, 500, rng.integers(0, 120)))
        values = rng.integers(-5, 505, rng.integers(0, 60))
        start = rng.integers(-3, 130, len(values))
        assert (alignment.gallop(values, inside, start) == np.searchsorted(inside, values)).all()


def test_common_ends_of_several_texts():
    rng = random.Random(8)
    for _ in range(100):
        a, b, n_a, n_b, base = [], [], [], [], 0
        for _ in range(rng.randint(0, 6)):
            size = rng.randint(0, 40)
            for out, n in ((a, n_a), (b, n_b)):
                cuts = sorted({*rng.sample(range(1, size + 1), rng.randint(0, size)), size} - {0})
                out += [base + c for c in cuts]
                n.append(len(cuts))
            base += size
        at_a, at_b = alignment.common_ends(*(np.array(x, np.int64) for x in (a, b, n_a, n_b)))
        assert [a[i] for i in at_a] == [b[i] for i in at_b] == sorted(set(a) & set(b))


# ---------------------------------------------------------------- exact top-k

VECTORS = "vec_id long, embedding array<float>, label int, score string, rank long, rep long"


def vector_rows(pairs):
    return [(i, v, 1, "", 2, 3) for i, v in pairs]


def brute_topk(pairs, k, step):
    one = {}
    for i, v in pairs:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(1024 * float(np.float32(x))) for x in v]
        one[i] = min(one.get(i, v), v)
    out = []
    for q in (i for i in one if i % step == 0):
        found = sorted((-sum(a * b for a, b in zip(one[q], v)), i) for i, v in one.items() if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("lists, depth, block, query_block", [(2, 50, 8_192, 1_024), (2, 1, 40, 3), (5, 10, 100, 7), (1, 10, 64, 64)])
def test_topk_equals_brute_force(spark, lists, depth, block, query_block):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(6, 24))
    pairs = [(int(i), (centres[i % 6] + 0.3 * rng.normal(size=24)).tolist()) for i in range(400)]
    pairs += [(1_000 + i, [0.5] * 24) for i in range(150)]  # one vector very often
    pairs += [(i, [float(i % 3)] * 24) for i in range(2_000, 2_060)]  # many ties
    pairs += [(3, pairs[3][1]), (10, [0.25] * 24), (5_000, [1.0, 2.0]), (5_010, []), (5_020, [0.0] * 24)]
    pairs += [(6_000, None), (6_010, [None] * 24), (6_020, [float("nan")] * 24), (6_030, [float("inf")] + [0.0] * 23), (None, [1.0] * 24)]
    got = threshold.top_k(spark.createDataFrame(vector_rows(pairs), VECTORS).repartition(4), step=10, k=7, lists=lists,
                          depth=depth, block=block, query_block=query_block)
    assert sorted(map(tuple, got.collect())) == brute_topk(pairs, 7, 10)


def test_topk_of_few(spark):
    frame_of = lambda pairs: spark.createDataFrame(vector_rows(pairs), VECTORS)
    assert threshold.top_k(frame_of([])).count() == 0
    assert threshold.top_k(frame_of([(100, [1.0])])).count() == 0
    pairs = [(100, [1.0]), (200, [1.0]), (7, [-2.0])]
    assert sorted(map(tuple, threshold.top_k(frame_of(pairs)).collect())) == brute_topk(pairs, 10, 100)
    assert threshold.top_k(frame_of(pairs)).columns == ["query_id", "rank", "vec_id", "score"]


def test_products_are_exact():
    for x in (2_000_000_011, 3_000_000_019):
        big = np.array([[x, -7]])
        assert threshold.products(big, big).tolist() == [[x * x + 49]]
    with pytest.raises(OverflowError):
        threshold.products(big * 2, big * 2)


def test_cutoff_prunes_the_lists(spark):
    """The second phase sends a small part of the entries."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3_000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    vectors = spark.createDataFrame(vector_rows([(i, v.tolist()) for i, v in enumerate(x)]), VECTORS)
    rows_ = threshold.quantised(vectors)
    reps = threshold.distinct_vectors(rows_, 10)
    table = threshold.Lists(reps, rows_.where("vec_id % 300 = 0").withColumnRenamed("vec_id", "query_id"), 2, 1_000, 100)
    cutoffs = threshold._kth(table.totals(table.gather(threshold._deepest(50))), 10, "cutoff")
    sent = table.gather(threshold._above(2), cutoffs).count()
    assert 100 <= sent < 0.2 * 10 * 3_000 * 2
    assert isinstance(threshold._matrix(pa.array([[1, 2], [], [3]], pa.list_(pa.int64())), 2), np.ndarray)
