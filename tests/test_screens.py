"""Neighbour screens in small numbers, and outlier factors that stay exact at any size."""

import numpy as np
import pytest

from floodmark.operators.detect import neighbors


def _brute(x, y, ids, k, metric, own, reach):
    for q, name, most in zip(x, own, reach):
        gap = neighbors._pair_distances(np.broadcast_to(q, y.shape), y, metric)
        c = np.flatnonzero((ids != name) & (gap <= most))
        yield [(int(ids[j]), float(gap[j])) for j in c[np.lexsort((ids[c], np.round(gap[c], 12)))[:k]]]


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
@pytest.mark.parametrize("kind", ["even", "whole", "copies", "far", "tiny", "tight"])
def test_pieces_of_references_give_the_nearest_rows(metric, kind, monkeypatch):
    """Many pieces, ids that repeat, and rows that single precision cannot part."""
    monkeypatch.setattr(neighbors, "PIECE_ROWS", 300)
    rng = np.random.default_rng(5)
    y, x = rng.normal(size=(1_000, 7)), rng.normal(size=(90, 7))
    if kind == "whole":
        x, y = np.round(x), np.round(y)
    elif kind == "copies":
        y = y[rng.integers(0, 9, 1_000)]
        x = y[:90].copy()
    elif kind == "far":
        x, y = 1e6 + 1e-3 * x, 1e6 + 1e-3 * y
    elif kind == "tiny":
        x, y = 1e-9 * x, 1e-9 * y
    elif kind == "tight":
        y[:-1] = y[0] + 1e-13 * rng.normal(size=(999, 7))
        x[:] = y[0]
    ids = rng.permutation(1_000) // 2
    own = rng.choice(ids, 90)
    for reach in (None, rng.uniform(0.5, 3.0, 90) * (x.std() + 1e-9)):
        q, n, dist, rank = neighbors.top_k(x, y, ids, 6, metric, own, reach)
        for i, want in enumerate(_brute(x, y, ids, 6, metric, own, np.full(90, np.inf) if reach is None else reach)):
            got = [(int(a), float(b)) for a, b in zip(n[q == i], dist[q == i]) if reach is None or b <= reach[i]]
            assert got == want and rank[q == i].tolist() == list(range(1, 1 + (q == i).sum()))


def test_screens_are_off_by_no_more_than_they_say():
    rng = np.random.default_rng(6)
    x, y = 3.0 + rng.normal(size=(40, 33)), 3.0 + rng.normal(size=(500, 33))
    rows, cols = slice(0, 40), slice(100, 500)
    for metric in ("euclidean", "manhattan"):
        screen = neighbors._screen(x, y, metric)
        rough = screen.rough(rows, cols)
        exact = np.stack([neighbors._pair_distances(np.broadcast_to(q, y[cols].shape), y[cols], metric) for q in x])
        for j in range(400):
            assert (exact[:, j] <= screen.upper(rough[:, j], rows, cols)).all() and (rough[:, j] <= screen.most(exact[:, j], rows, cols)).all()
    assert neighbors._screen(x, np.where(y > 5, np.nan, y), "euclidean") is None and neighbors._screen(x, y, "hamming") is None


def test_outlier_factors_stay_exact_at_any_size(spark, monkeypatch):
    """More numbers than a broadcast may hold, in more dimensions than boxes take, change no factor."""
    x = np.random.default_rng(9).normal(size=(700, 9))
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "row_id long, vector array<double>")
    few = {r["row_id"]: r["score"] for r in neighbors.lof_fit(rows, "row_id", k=8).scores.collect()}
    monkeypatch.setattr(neighbors, "BROADCAST_VALUES", 100)
    whole = neighbors.knn_join
    monkeypatch.setattr(neighbors, "knn_join", lambda *a, **o: whole(*a, **{"broadcast_values": 100, "block_rows": 64, "query_rows": 50, **o}))
    model = neighbors.lof_fit(rows, "row_id", k=8)
    assert model.index is None
    many = {r["row_id"]: r["score"] for r in model.scores.collect()}
    assert many.keys() == few.keys() and all(abs(many[i] - few[i]) < 1e-9 for i in few)
    scored = neighbors.lof_score(rows.limit(20), model, "row_id").collect()
    monkeypatch.undo()
    want = {r["row_id"]: r["score"] for r in neighbors.lof_score(rows.limit(20), neighbors.lof_fit(rows, "row_id", k=8), "row_id").collect()}
    assert len(scored) == 20 and all(abs(r["score"] - want[r["row_id"]]) < 1e-9 for r in scored)
