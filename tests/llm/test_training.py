"""The trained models against plain loops."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from strata.llm import quality, toxicity


def plain_ftrl(rows, epochs, alpha, beta, l1, l2):
    """Follow-the-regularised-leader, one coordinate at a time."""
    z, n, zb, nb, bias = {}, {}, 0.0, 0.0, 0.0
    ones = sum(label for *_, label in rows)
    weigh = {1: len(rows) / (2 * max(ones, 1)), 0: len(rows) / (2 * max(len(rows) - ones, 1))}

    def weight(i):
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= l1 else -(zi - math.copysign(l1, zi)) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for at in order.permutation(len(rows)):
            index, value, label = rows[at]
            w = {i: weight(i) for i in index}
            error = (1 / (1 + math.exp(-(bias + sum(w[i] * v for i, v in zip(index, value))))) - label) * weigh[label]
            for i, v in zip(index, value):
                g = error * v
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha * w[i]
                n[i] = n.get(i, 0.0) + g * g
            zb += error - (math.sqrt(nb + error * error) - math.sqrt(nb)) / alpha * bias
            nb += error * error
            bias = -zb / ((beta + math.sqrt(nb)) / alpha)
    return {i: weight(i) for i in z}, bias


def test_ftrl_against_a_plain_loop():
    rng, rows = random.Random(1), []
    for _ in range(60):
        label = rng.randrange(2)
        index = rng.sample(range(30), 8)
        rows.append((np.array(index), np.array([rng.random() + (label and i < 10) for i in index], np.float32), label))
    options = {"epochs": 3, "alpha": 0.7, "beta": 1.0, "l1": 0.05, "l2": 0.1}
    model = quality.train_ftrl(rows, **options)
    weights, bias = plain_ftrl([(i.tolist(), v.astype(float).tolist(), y) for i, v, y in rows], **options)
    assert model.bias == pytest.approx(bias, rel=1e-9) and model.rows == 60
    assert {i: w for i, w in enumerate(model.weights) if w} == {i: pytest.approx(w, rel=1e-5) for i, w in weights.items() if w}
    assert len(weights) == 30 and np.count_nonzero(model.weights) <= 30


def plain_raw(net, vectors, ids):
    """The network's response by plain loops over windows."""
    total, out = net.bias, 0
    for width, weights, shift in zip(toxicity.WIDTHS, net.filters, net.shift):
        for f in range(toxicity.FILTERS):
            best = max(
                sum(float(vectors[ids[at + k]][d]) * float(weights[k * toxicity.SIZE + d, f]) for k in range(width) for d in range(toxicity.SIZE))
                for at in range(len(ids) - width + 1))
            total += max(best + float(shift[f]), 0.0) * float(net.out[out])
            out += 1
    return total


def test_network_against_plain_windows():
    rng = np.random.default_rng(3)
    size, many = toxicity.SIZE, len(toxicity.WIDTHS) * toxicity.FILTERS
    net = toxicity.Net(
        {i: i for i in range(20)}, rng.normal(size=(20, size)).astype(np.float32),
        [rng.normal(size=(w * size, toxicity.FILTERS)).astype(np.float32) for w in toxicity.WIDTHS],
        [rng.normal(size=toxicity.FILTERS).astype(np.float32) for _ in toxicity.WIDTHS], rng.normal(size=many).astype(np.float32), 0.3)
    vectors = net.vectors([(), *[tuple(rng.choice(20, 2, replace=False)) for _ in range(9)]])
    for n in (8, 15):
        ids = rng.integers(0, 10, n)
        assert net.raw(vectors, ids) == pytest.approx(plain_raw(net, vectors, ids), rel=1e-4)


def test_cutting_runs_of_unknown_words_changes_no_response():
    index = toxicity._Words({p: i for i, p in enumerate(toxicity.parts_of("badword"))})
    words = ["badword", *["plain"] * 300, "badword", "plain", "badword"]
    ids = index.sequence(words)
    margin = [0] * toxicity._MARGIN
    whole = np.array([*margin, *[index[w] for w in words], *margin])
    windows = lambda a, w: {tuple(a[i:i + w]) for i in range(len(a) - w + 1)}
    assert len(ids) < 60 and all(windows(ids, w) == windows(whole, w) for w in toxicity.WIDTHS)


def test_training_tells_planted_words():
    rng = random.Random(4)
    texts, labels = [], []
    for _ in range(400):
        toxic = rng.random() < 0.3
        words = [f"word{rng.randrange(200)}" for _ in range(30)]
        if toxic:
            words[rng.randrange(30)] = rng.choice(["nastyone", "foulterm"])
        texts.append(words)
        labels.append(int(toxic))
    net = toxicity.train_net(texts, np.array(labels), ["en"] * 400)
    index = toxicity._Words(net.known)
    score = lambda words: (ids := index.sequence(words), net.calibrated(np.array([net.raw(net.vectors(list(index.sets)), ids)]))[0])[1]
    clean = [[f"word{rng.randrange(200)}" for _ in range(30)] for _ in range(40)]
    assert sum(score(w) >= toxicity.THRESHOLD for w in clean) <= 4
    assert sum(score([*w[:15], "nastyone", *w[15:]]) >= toxicity.THRESHOLD for w in clean) >= 36
