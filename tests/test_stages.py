"""Many scores ranked in one job, and early stopping on them, against brute force."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskspark.operators import stages


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    if not len(pos) or not len(neg):
        return None
    return float(((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg)))


def scored(spark, y, s, part=None):
    rows = [(None if v is None else int(v), list(map(float, x)), int(p)) for v, x, p in
            zip(y, s, part if part is not None else [0] * len(y))]
    return spark.createDataFrame(rows, "TARGET int, scores array<double>, fold int").repartition(3)


@pytest.mark.parametrize("edge_rows, edges", [(2048, 255), (10, 3), (1, 1)])
def test_auc_of_many_scores(spark, edge_rows, edges):
    """Whatever the edges, the exact values are exact and lie within the bounds."""
    rng = np.random.default_rng(6)
    y = (rng.random(700) < 0.3).astype(int)
    fold = rng.integers(0, 3, 700)
    s = np.column_stack([rng.normal(size=700), rng.normal(size=700) + y, np.round(rng.normal(size=700)), np.zeros(700),
                         y * 1.0, rng.normal(size=700)])
    s[::5, 5] = np.nan
    ranked = stages.ranked_scores(scored(spark, y, s, fold), "scores", part="fold", edge_rows=edge_rows, edges=edges)
    low = {(r["part"], r["score"]): (r["low"], r["high"]) for r in ranked.bounds().collect()}
    got = {(r["part"], r["score"]): r for r in ranked.exact().collect()}
    assert len(got) == 18
    for (p, i), r in got.items():
        own = (fold == p) & ~np.isnan(s[:, i])
        assert r["auc"] == pytest.approx(brute_auc(y[own], s[own, i]), abs=1e-12)
        assert low[p, i][0] - 1e-12 <= r["auc"] <= low[p, i][1] + 1e-12
        assert r["n_pos"] == y[own].sum() and r["n_neg"] == (1 - y[own]).sum()
    some = ranked.exact([(0, 1), (2, 4)]).collect()
    assert sorted((r["part"], r["score"]) for r in some) == [(0, 1), (2, 4)]
    assert all(r["auc"] == got[r["part"], r["score"]]["auc"] for r in some)


def test_values_travel_by_stretch():
    """A task sends one row per stretch, not one per value, and pairs beyond 64 bits count."""
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(5_000, 2)), rng.integers(0, 2, 5_000)
    batch = pa.record_batch([pa.array(np.zeros(5_000), pa.int32()), pa.array(y, pa.int32()), pa.array(list(x))], names=["part", "label", "x"])
    edges = [np.array([-0.5, 0.5])] * 2
    shared = SimpleNamespace(value=(stages.own_scores, edges, {0: {0: np.array([4, 0]), 1: np.array([2])}}))
    sent = pa.Table.from_batches(stages._values(shared)([batch]))
    assert sent.select(["score", "bucket"]).to_pylist() == [{"score": i, "bucket": b} for i, b in ((0, 0), (0, 4), (1, 2))]
    inside = [x[:, 0] < -0.5, x[:, 0] > 0.5, (x[:, 1] > -0.5) & (x[:, 1] < 0.5)]
    assert [len(v) for v in sent.column("value").to_pylist()] == [w.sum() for w in inside]
    # in batches of any size
    for rows in (1, 2, 3):
        got = [r for out in stages._inside(sent.to_batches(rows)) for r in out.to_pylist()]
        for i in (0, 1):
            pairs = sum(2 * brute_auc(y[w], x[w, j]) * y[w].sum() * (1 - y[w]).sum()
                        for j, w in zip((0, 0, 1), inside) if j == i)
            assert float(sum(r["_in"] for r in got if r["score"] == i)) == pytest.approx(pairs)
    many = pa.table({"part": pa.array([0], pa.int32()), "score": pa.array([0], pa.int32()), "bucket": pa.array([0], pa.int32()),
                     "value": [[1.0, 2.0]], "pos": [[3, 10 ** 10]], "neg": [[10 ** 10, 1]]})
    assert stages._ordered_pairs(many).column("_in").to_pylist() == [3 * 10 ** 10 + 10 ** 10 * (2 * 10 ** 10 + 1)]


def test_scores_without_a_class_or_rows(spark):
    one = stages.ranked_scores(scored(spark, [1, 1, None], [[1.0], [2.0], [0.0]]), "scores")
    assert [r["auc"] for r in one.exact().collect()] == [None]
    stop = stages.stopping_rounds(one).first()
    assert stop["best_round"] == 1 and stop["best_auc"] is None
    none = stages.ranked_scores(scored(spark, [], []), "scores")
    assert none.exact().count() == 0 and stages.stopping_rounds(none).count() == 0


@pytest.mark.parametrize("patience", [1, 3, 50])
def test_stopping_equals_the_rule_on_exact_values(spark, patience):
    """Bounds and refinement choose the round that patience on the exact AUCs chooses."""
    rng = np.random.default_rng(patience)
    y = (rng.random(400) < 0.4).astype(int)
    steps = rng.normal(size=(400, 60)) * 0.3 + y[:, None] * np.concatenate([np.full(20, 0.2), np.full(40, -0.05)])
    s = np.cumsum(steps, axis=1)
    fold = rng.integers(0, 2, 400)
    got = {r["part"]: r for r in stages.stopping_rounds(
        stages.ranked_scores(scored(spark, y, s, fold), "scores", part="fold", edges=15), patience).collect()}
    for p in (0, 1):
        auc = [brute_auc(y[fold == p], s[fold == p, i]) for i in range(60)]
        keep = stages.best_round([-a for a in auc], patience)
        assert got[p]["best_round"] == keep and got[p]["best_auc"] == pytest.approx(auc[keep - 1])
        assert got[p]["fired"] == (keep + patience <= 60)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 10)), min_size=1, max_size=40), st.integers(1, 10), st.data())
def test_open_rounds_lose_nothing(bounds, patience, data):
    """Rounds outside ``open_rounds`` never improve: leaving their values out keeps the choice."""
    low, high = [a for a, _ in bounds], [a + b for a, b in bounds]
    exact = [data.draw(st.integers(lo, hi)) for lo, hi in zip(low, high)]
    open_ = set(stages.open_rounds(low, high))
    known = [-v if i in open_ else float("inf") for i, v in enumerate(exact)]
    assert stages.best_round(known, patience) == stages.best_round([-v for v in exact], patience)


def test_linear_scores(spark):
    w = np.array([[1.0, 0.0], [0.0, -1.0]])
    rows = spark.createDataFrame([(1, [3.0, 1.0]), (0, [2.0, 5.0]), (0, [4.0, 0.0])], "TARGET int, z array<double>")
    got = {r["score"]: r["auc"] for r in stages.ranked_scores(rows, "z", stages.LinearScores(w)).exact().collect()}
    assert got == {0: 0.5, 1: 0.5}
