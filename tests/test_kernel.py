"""Kernel machine with probabilities."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from panelspark.operators import kernel as K


def test_landmark_features_give_the_kernel():
    x = np.random.default_rng(0).normal(size=(40, 5))
    z = K.kernel(x, x, 0.3) @ K.whitening(x, 0.3)
    assert np.allclose(z @ z.T, K.kernel(x, x, 0.3), atol=1e-8)


def test_coupling_recovers_a_distribution():
    """Chances that come from one distribution give it back."""
    p = np.random.default_rng(1).dirichlet([1, 2, 3], 50)
    chance = p[:, :, None] / (p[:, :, None] + p[:, None, :])
    assert np.allclose(K.coupled(chance), p, atol=1e-9)
    two = np.array([[[0.5, 0.9], [0.1, 0.5]]])
    assert np.allclose(K.coupled(two), [[0.9, 0.1]])


def rings(n, seed):
    """Three classes by distance from the origin, which no line parts, a tenth of them mislabelled."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2)) * 1.5
    label = np.digitize(np.hypot(x[:, 0], x[:, 1]), [1.2, 2.2])
    wrong = rng.random(n) < 0.1
    return x, np.where(wrong, rng.integers(0, 3, n), label)


def frame(spark, x, label):
    rows = [(i, v.tolist(), None if y is None else int(y)) for i, (v, y) in enumerate(zip(x, label))]
    return spark.createDataFrame(rows, "ID long, v array<double>, label int").select("ID", array_to_vector("v").alias("features"), "label")


def test_probabilities_follow_the_classes(spark):
    model = K.KernelMachine(landmarks=60).fit(frame(spark, *rings(500, 1)))
    x, label = rings(1500, 2)
    rows = model.transform(frame(spark, x, label)).collect()
    p = np.array([r["probability"].toArray() for r in rows])
    y = np.array([r["label"] for r in rows])
    assert np.allclose(p.sum(1), 1) and (p >= 0).all()
    assert all(r["prediction"] == int(np.argmax(q)) for r, q in zip(rows, p))
    assert np.mean(p.argmax(1) == y) > 0.8
    # A tenth of the labels is wrong, so no chances do better than about 0.4 nats; even chances make 1.1.
    assert -np.log(p[np.arange(len(y)), y]).mean() < 0.55
    for k in range(3):  # on average over the chances given, their gap to the share of rows that have the class is small
        bins = np.digitize(p[:, k], [0.2, 0.4, 0.6, 0.8])
        gaps = [abs(p[bins == b, k].mean() - (y[bins == b] == k).mean()) * (bins == b).mean() for b in np.unique(bins)]
        assert sum(gaps) < 0.1


def test_missing_class_and_empty_tables(spark):
    x, label = rings(90, 3)
    two = [None if y == 1 else y for y in label]
    df = frame(spark, x, two)
    model = K.KernelMachine(landmarks=20).fit(df)
    p = np.array([r["probability"].toArray() for r in model.transform(df).collect()])
    assert (p[:, 1] == 0).all() and np.allclose(p.sum(1), 1)
    assert model.transform(df.limit(0)).count() == 0
    one = K.KernelMachine(landmarks=5).fit(frame(spark, x[:9], [2] * 9))
    assert {r["prediction"] for r in one.transform(df).collect()} == {2.0}
    with pytest.raises(ValueError):
        K.KernelMachine().fit(df.where("label = 7"))
