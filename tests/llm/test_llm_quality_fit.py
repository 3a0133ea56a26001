"""The quality classifier's fit: a plain restatement of the boosting, and no dependence on the order of rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_llm import sentence
from traitmatch.llm import quality_model as qm


def sums(bins, values, n):
    out = [0.0] * n
    for b, v in zip(bins, values):
        out[b] += v
    return out


def cut(g, h):
    """Best split position of binned sums by its gain, 0 without one."""
    best, at, all_g, all_h = 1e-9, 0, sum(g), sum(h)
    for i in range(1, len(g)):
        gl, hl = sum(g[:i]), sum(h[:i])
        if hl < qm.LEAF_HESSIAN or all_h - hl < qm.LEAF_HESSIAN:
            continue
        gain = gl ** 2 / (hl + qm.RIDGE) + (all_g - gl) ** 2 / (all_h - hl + qm.RIDGE) - all_g ** 2 / (all_h + qm.RIDGE)
        if gain > best + 1e-12:
            best, at = gain, i
    return (best, at) if at else (0.0, 0)


def leaf(g, h):
    return sum(g) / (sum(h) + qm.RIDGE)


def plain_tree(g, h):
    _, first = cut(g, h)
    if not first:
        return [0.0] * len(g)
    (gain_l, l), (gain_r, r) = cut(g[:first], h[:first]), cut(g[first:], h[first:])
    edges = sorted({0, first, len(g), *([l] if gain_l and gain_l >= gain_r else []), *([first + r] if gain_r > gain_l else [])})
    return [leaf(g[a:b], h[a:b]) for a, b in zip(edges, edges[1:]) for _ in range(b - a)]


def plain_fit(x, y, rounds):
    """Intercept and one table per feature, row by row; the pairs are left out."""
    n, d = x.shape
    cuts = [sorted({float(np.quantile(x[:, j], q)) for q in np.linspace(0, 1, qm.BINS + 1)[1:-1]}) for j in range(d)]
    bins = [[sum(v > c for c in cuts[j]) for v in x[:, j]] for j in range(d)]
    rate = sum(y) / n
    f = [math.log(rate / (1 - rate))] * n
    tables = [[0.0] * (len(c) + 1) for c in cuts]
    for _ in range(rounds):
        for j in range(d):
            p = [1 / (1 + math.exp(-v)) for v in f]
            step = plain_tree(sums(bins[j], [a - b for a, b in zip(y, p)], len(tables[j])),
                              sums(bins[j], [b * (1 - b) for b in p], len(tables[j])))
            tables[j] = [a + qm.RATE * b for a, b in zip(tables[j], step)]
            f = [v + qm.RATE * step[b] for v, b in zip(f, bins[j])]
    return math.log(rate / (1 - rate)), tables, f


def test_boosting_equals_a_plain_restatement(monkeypatch):
    monkeypatch.setattr(qm, "ROUNDS", 6)
    monkeypatch.setattr(qm, "PAIR_ROUNDS", 0)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(150, 3)).round(1)
    y = (x[:, 0] + x[:, 1] ** 2 + rng.normal(size=150) * 0.3 > 0.8).astype(float)
    intercept, tables, f = plain_fit(x, y, 6)
    model = qm.AdditiveModel(x, y)
    assert model.intercept == pytest.approx(intercept)
    for mine, plain in zip(model.tables, tables):
        assert mine.tolist() == pytest.approx(plain, abs=1e-9)
    assert model.score(x) == pytest.approx([1 / (1 + math.exp(-v)) for v in f])
    assert all(not t.any() for t in model.pair_tables)


def test_pairs_add_what_single_features_cannot_say():
    rng = np.random.default_rng(9)
    x = rng.uniform(-1, 1, size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)              # no feature alone says anything
    model = qm.AdditiveModel(x, y)
    assert (0, 1) in model.pairs and ((model.score(x) >= 0.5) == y).mean() > 0.95
    one = model.pair_tables[model.pairs.index((0, 1))]
    assert one[0, 0] < 0 < one[0, -1] and one[-1, -1] < 0 < one[-1, 0]


def test_scores_do_not_depend_on_the_order_of_rows_and_copies(spark):
    rng = random.Random(2)
    rows = [(i, sentence(rng, rng.randint(30, 80)) if i % 2 else "x | " * rng.randint(5, 60)) for i in range(80)]
    rows += [(i, t.upper()) for i, t in rows[:40]] + rows[:40] * 3            # other texts and copies under the same ids
    labels = [(i, i % 2) for i in range(80)] + [(i, 1) for i in range(10)] + [(3, 1), (3, 0)] * 2
    docs, marks = (spark.createDataFrame(rows, "doc_id bigint, text string"),
                   spark.createDataFrame(labels, "doc_id bigint, quality int"))

    def scores(parts, max_rows):
        out = qm.score_quality(docs.repartition(parts), marks.repartition(parts), max_rows=max_rows).collect()
        return sorted((r.doc_id, r.score) for r in out)

    for max_rows in (20, 1000):
        assert scores(1, max_rows) == scores(7, max_rows)
    sample = qm.labelled_sample(docs, marks, "quality", 5, 0, 30)
    assert sample.count() == 30 and sample.select("doc_id").distinct().count() == 30
    assert sample.where(F.col("doc_id").isNull()).count() == 0
