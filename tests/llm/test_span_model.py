"""The span model of personal data against enumeration and numeric gradients, and its training sample."""

from __future__ import annotations

import math
import random
import tracemalloc

import pyarrow as pa
import pytest

from floodmark.llm import personal


def segmentations(lattice, i=0):
    """All ways to cut the atoms from ``i`` on: lists of (start, end, kind or None)."""
    if i == len(lattice.atoms):
        yield []
        return
    for rest in segmentations(lattice, i + 1):
        yield [(i, i + 1, None), *rest]
    for j in lattice.candidates(i):
        for rest in segmentations(lattice, j):
            for kind in personal.KINDS:
                yield [(i, j, kind), *rest]


def score(model, lattice, cut) -> float:
    return sum(sum(model.weights.get((kind, f), 0.0) for f in lattice.features(i, j)) for i, j, kind in cut if kind)


def random_model(lattice, rng):
    names = {f for i in range(len(lattice.atoms)) for j in lattice.candidates(i) for f in lattice.features(i, j)}
    return personal.SpanModel({(k, f): rng.uniform(-1, 0.7) for k in personal.KINDS for f in names})


TEXTS = ["a@b 12", "+1 234", "1.2.3", "x 4 5", "(12) y"]


@pytest.mark.parametrize("text", TEXTS)
def test_decode_finds_the_best_of_all_segmentations(text):
    rng = random.Random(text)
    lattice = personal.Lattice(text, 0, len(text))
    for _ in range(20):
        model = random_model(lattice, rng)
        best = max(score(model, lattice, cut) for cut in segmentations(lattice))
        found = model.decode(lattice)
        assert sum(s for *_, s in found) == pytest.approx(best)
        assert score(model, lattice, [(i, j, k) for k, i, j, _ in found]) == pytest.approx(best)


@pytest.mark.parametrize("text", TEXTS)
def test_gradient_is_that_of_the_log_likelihood(text):
    rng = random.Random(text)
    lattice = personal.Lattice(text, 0, len(text))
    model = random_model(lattice, rng)
    cuts = list(segmentations(lattice))
    truth = next((c for c in cuts if any(k for *_, k in c)), cuts[0])
    labels = {(i, j): k for i, j, k in truth if k}

    def likelihood() -> float:
        return score(model, lattice, truth) - math.log(sum(math.exp(score(model, lattice, c)) for c in cuts))

    gradient = model._gradient(lattice, labels)
    for key in rng.sample(sorted(model.weights), min(30, len(model.weights))):
        before = model.weights[key]
        model.weights[key] = before + 1e-5
        up = likelihood()
        model.weights[key] = before - 1e-5
        down = likelihood()
        model.weights[key] = before
        assert gradient.get(key, 0.0) == pytest.approx((up - down) / 2e-5, abs=2e-3)


def test_long_numeric_text_is_decoded_in_little_memory():
    rng = random.Random(3)
    text = " ".join(str(rng.randint(0, 10**6)) for _ in range(30_000))
    (_, hits), = personal.scanned(pa.array([text]))
    tracemalloc.start()
    personal.spans_of(text, hits, personal.SpanModel())
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 400 * len(text)


def test_training_covers_long_lines(spark):
    """Everything of a sampled row trains: labels far behind, in lattices of bounded length, none cut through a label."""
    numbers = " ".join(f"{i} 10.0.{i % 200}.{i % 250}" for i in range(2_000))
    (_, hits), = personal.scanned(pa.array([numbers]))
    lattices = list(personal.labelled(numbers, hits))
    assert sum(len(labels) for _, labels in lattices) == 2_000
    assert all(len(lattice.atoms) <= personal.TRAIN_ATOMS + personal.MOST_ATOMS for lattice, _ in lattices)
    rows = [(1, "mail a@b.de here")] * 50 + [(i, f"call +1 377 555-0{i:03d} or x{i}@y.org, host 10.0.0.{i % 250}") for i in range(2, 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one, two = (personal.train(d, rows=100).weights for d in (df.repartition(3), df.repartition(7, "text")))
    assert dict(one) == dict(two) and one
