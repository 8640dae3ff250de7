from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from floodmark.operators.detect import autoencoder, deep
from floodmark.plans.staging import scratch_path
from floodmark.sources.models import load_model, save_model

NAMES = ["a", "b", "c"]


def rows(spark, n=3000, odd=0):
    rng = np.random.default_rng(5)
    t = rng.uniform(0.2, 0.8, n)
    x = np.column_stack([t, 1 - t, t * 0.5]) + rng.normal(0, 0.01, (n, 3))
    x[:odd] = rng.uniform(0, 1, (odd, 3)) * [0.1, 0.1, 1.0]
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "row_id long, a double, b double, c double"), x


@pytest.mark.parametrize("normalised,sigmoid", [([0], True), ([0, 1], False), ([1], True), ([], True)])
def test_gradient_against_differences(normalised, sigmoid):
    sizes, rng = [3, 5, 4, 3], np.random.default_rng(1)
    x = rng.uniform(size=(7, 3))
    flat = deep.deep_initial(sizes, normalised, 1) + rng.normal(0, 0.05, len(deep.deep_initial(sizes, normalised, 1)))
    masks = {i: deep.dropout_mask(x, sizes[i + 1], i, 0.3, 4, 42) for i in normalised}
    _, g = deep.deep_gradient(x, flat, sizes, normalised, masks, sigmoid)
    for i in range(len(flat)):
        step = np.zeros(len(flat))
        step[i] = 1e-6
        up, down = (deep.deep_gradient(x, flat + s, sizes, normalised, masks, sigmoid)[0] for s in (step, -step))
        assert abs((up - down) / 2e-6 - g[i]) < 1e-6


def test_without_normalised_layers_it_is_the_plain_network():
    sizes, x = [3, 4, 3], np.random.default_rng(2).uniform(size=(6, 3))
    flat = autoencoder.initial_weights(sizes)
    np.testing.assert_allclose(deep.deep_gradient(x, flat, sizes, [], {}, True)[1], autoencoder.loss_gradient(x, flat, sizes, True)[1])
    np.testing.assert_allclose(deep.deep_forward(x, flat, sizes, [], [], True), autoencoder.reconstruct(x, flat, sizes, True))


def test_masks_depend_on_rows_step_layer_and_seed_only():
    x = np.random.default_rng(3).uniform(size=(200, 3))
    mask = deep.dropout_mask(x, 30, 0, 0.2, 7, 42)
    assert (mask == deep.dropout_mask(x.copy(), 30, 0, 0.2, 7, 42)).all()
    for other in (deep.dropout_mask(x, 30, 0, 0.2, 8, 42), deep.dropout_mask(x, 30, 1, 0.2, 7, 42), deep.dropout_mask(x, 30, 0, 0.2, 7, 43), deep.dropout_mask(x + 1, 30, 0, 0.2, 7, 42)):
        assert (mask != other).any()
    assert set(np.unique(mask)) == {0.0, 1.25} and abs((mask == 0).mean() - 0.2) < 0.02


@pytest.mark.parametrize("partitions", [1, 7])
def test_moments_of_all_layers_equal_one_pass_in_memory(spark, partitions):
    df, x = rows(spark, 500)
    sizes, normalised = [3, 6, 4, 3], [0, 1]
    flat = deep.deep_initial(sizes, normalised, 3)
    got = deep.layer_moments(df.repartition(partitions), NAMES, flat, sizes, normalised)
    (w, b), (w2, b2) = autoencoder._layers(flat, sizes)[:2]
    h = np.maximum(x @ w + b, 0)
    h2 = np.maximum((h - h.mean(axis=0)) / np.sqrt(h.var(axis=0) + deep.EPSILON) @ w2 + b2, 0)
    for (mean, variance), want in zip(got, (h, h2)):
        np.testing.assert_allclose(mean, want.mean(axis=0), atol=1e-12)
        np.testing.assert_allclose(variance, want.var(axis=0), atol=1e-12)
    empty = deep.layer_moments(df.limit(0), NAMES, flat, sizes, normalised)
    assert all((v == 0).all() for _, v in empty)


def test_learns_flags_and_does_not_depend_on_partitions(spark):
    df, x = rows(spark, 3000, odd=60)
    train = df.filter("row_id >= 60")
    fits = [deep.deep_fit(train.repartition(p), NAMES, "row_id", [3, 12, 2, 12, 3], epochs=12, learning_rate=1e-2, dropout=0.1, rows_per_partition=1000) for p in (2, 8)]
    (model, history), (again, _) = fits
    np.testing.assert_allclose(model.weights, again.weights, atol=1e-9)
    assert min(h[1] for h in history) < 0.5 * history[0][1]
    flat = np.asarray(model.weights)
    (w, b) = autoencoder._layers(flat, model.sizes)[0]
    held_out = autoencoder.below_fraction(autoencoder.order_hash("42-validation", "row_id"), 0.2)
    kept = np.array(train.filter(~held_out).select(*NAMES).collect())
    np.testing.assert_allclose(model.means[0], np.maximum(kept @ w + b, 0).mean(axis=0), atol=1e-9)
    model = deep.deep_threshold(train, model)
    flagged = deep.deep_predict(df, model).filter("y_pred = -1").agg(F.count_if(F.col("row_id") < 60), F.count("*")).first()
    assert flagged[0] >= 54 and flagged[1] - flagged[0] <= 0.05 * 2940 + 1
    path = scratch_path(spark, "deep-model")
    save_model(spark, model, path)
    assert load_model(spark, path, [deep.DeepModel]) == model


def test_only_hidden_layers_are_normalised(spark):
    df, _ = rows(spark, 10)
    with pytest.raises(ValueError, match="hidden"):
        deep.deep_fit(df, NAMES, "row_id", [3, 4, 3], normalised=[1])


def test_sigmoid_models_are_scored_with_their_sigmoid(spark):
    df, x = rows(spark, 50)
    sizes = [3, 4, 3]
    flat = autoencoder.initial_weights(sizes)
    model = autoencoder.AutoencoderModel(NAMES, sizes, flat.tolist(), None, True)
    want = np.square(autoencoder.reconstruct(x, flat, sizes, True) - x).mean(axis=1)
    got = [r.mse for r in autoencoder.autoencoder_score(df, model).orderBy("row_id").collect()]
    np.testing.assert_allclose(got, want)
    assert autoencoder.autoencoder_threshold(df, model).sigmoid and replace(model, threshold=1.0).sigmoid
