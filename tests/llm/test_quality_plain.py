"""Boosted trees against a version that walks row by row and tries every split by itself."""

import math

import numpy as np

from graphloom.llm import quality


def plain_gain(rows, slope, bend, goes_left):
    def part(chosen):
        return sum(slope[i] for i in chosen) ** 2 / (sum(bend[i] for i in chosen) + quality.SHRINK)

    left, right = [i for i in rows if goes_left(i)], [i for i in rows if not goes_left(i)]
    if len(left) < quality.LEAF_ROWS or len(right) < quality.LEAF_ROWS:
        return 0.0
    return part(left) + part(right) - part(rows)


def plain_train(x, y, trees, depth, rate):
    n, width = len(x), len(x[0])
    p = (sum(y) + 0.5) / (n + 1)
    score, base, inner = [math.log(p / (1 - p))] * n, math.log(p / (1 - p)), 2 ** depth - 1
    edges = [sorted(set(np.quantile([r[f] for r in x], np.linspace(0, 1, quality.BINS + 1)[1:-1]).tolist())) for f in range(width)]
    forest = []
    for _ in range(trees):
        slope = [y[i] - 1 / (1 + math.exp(-score[i])) for i in range(n)]
        bend = [q * (1 - q) for q in (1 / (1 + math.exp(-s)) for s in score)]
        splits, place = {}, [0] * n
        for node in range(inner):
            rows = [i for i in range(n) if place[i] == node]
            best = (1e-9, 0, math.inf)
            for f in range(width):
                for edge in edges[f]:
                    gain = plain_gain(rows, slope, bend, lambda i: x[i][f] <= edge)
                    if gain > best[0] + 1e-12:
                        best = (gain, f, edge)
            splits[node] = best[1:]
            for i in rows:
                place[i] = 2 * node + (2 if x[i][best[1]] > best[2] else 1)
        leaves = {}
        for leaf in range(inner, 2 * inner + 1):
            rows = [i for i in range(n) if place[i] == leaf]
            leaves[leaf] = rate * sum(slope[i] for i in rows) / (sum(bend[i] for i in rows) + quality.SHRINK)
        score = [score[i] + leaves[place[i]] for i in range(n)]
        forest.append((splits, leaves))
    return base, forest


def plain_score(base, forest, row):
    total = base
    for splits, leaves in forest:
        node = 0
        while node in splits:
            feature, edge = splits[node]
            node = 2 * node + (2 if row[feature] > edge else 1)
        total += leaves[node]
    return 1 / (1 + math.exp(-total))


def test_trees_equal_plain_ones():
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=160), rng.integers(0, 5, 160), rng.random(160)]).astype(float)
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > 2) ^ (rng.random(160) < 0.1)).astype(float)
    model = quality.train(x, y, trees=3, depth=2, rate=0.3)
    plain = plain_train(x.tolist(), y.tolist(), 3, 2, 0.3)
    for (splits, leaves), feature, threshold, value in zip(plain[1], model.feature, model.threshold, model.value, strict=True):
        assert [splits[i] for i in range(3)] == list(zip(feature.tolist(), threshold.tolist(), strict=True))
        assert np.allclose([leaves[i] for i in range(3, 7)], value)
    other = np.column_stack([rng.normal(size=500), rng.integers(0, 5, 500), rng.random(500)]).astype(float)
    assert np.allclose(quality.evaluate(model, other), [plain_score(*plain, r) for r in other.tolist()])
