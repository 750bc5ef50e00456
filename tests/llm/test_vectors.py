"""Operators over vectors against brute force."""

import math
from collections import Counter
from functools import reduce

import numpy as np
import pytest

from redress.llm import hard_negatives, nearest
from redress.llm.hard_negatives import negatives_table, products

COLUMNS = "vec_id long, embedding array<double>, label int, score string, rank string, slot string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], COLUMNS).repartition(3)


def usable(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def mined(rows):
    """Every anchor against every row, in whole numbers."""
    kept = {}
    for i, vector, label in rows:
        if i is not None and label is not None and usable(vector):
            label = (label + 1) % 10 if i % 7 == 0 else label
            row = (label, [math.floor(256 * x) for x in vector])
            kept[i] = min(kept.get(i, row), row)
    out = []
    for a, (label, vector) in kept.items():
        if a % 100:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(vector, v, strict=False)), i, own == label)
            for i, (own, v) in kept.items() if i != a
        )
        for p, i, same in [x for x in scored if x[2]][:5]:
            fits = [(n, s) for s, n, own in scored if not own and 30 * -p <= 100 * -s <= 90 * -p]
            out += [(a, i, r, n, -p, -s) for r, (n, s) in enumerate(fits[:10], 1)]
    return Counter(out)


def cloud(n, ids, seed, dims=6, step=0.25):
    rnd = np.random.default_rng(seed)
    values = np.round(rnd.normal(size=(n, dims)) / step) * step
    return [(int(i), v.tolist(), int(k)) for i, v, k in zip(ids, values, rnd.integers(0, 3, n), strict=True)]


ODD = [
    (None, [1.0, 1.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [math.nan, 1.0], 1),
    (4, [math.inf, 1.0], 1), (5, [], 2), (6, [0.0, 0.0], 2), (8, [1.0, 1.0], None), (9, [2.0], 1),
    (100, [1.0, 2.0, 3.0], 1), (100, [1.0, 2.0, 3.0], 1), (200, [1.0, 2.0, 3.0], 2),
    (200, [3.0, 2.0, 1.0], 2), (300, [-1.0, -2.0, -3.0], 1), (-100, [0.5, 0.5], 1),
]


@pytest.mark.parametrize("rows", [
    ODD,
    ODD + cloud(700, range(10, 710), 1),
    # One label for a third, copies of one vector, equal scores by the hundred.
    cloud(400, range(0, 4000, 10), 2, dims=2, step=1.0) + [(4001 + i, [1.0, 1.0], 1) for i in range(300)],
])
def test_hard_negatives_equal_brute_force(spark, rows):
    got = negatives_table(frame(spark, rows))
    assert Counter(map(tuple, got.collect())) == mined(rows)


def test_hard_negatives_of_an_empty_table(spark):
    assert negatives_table(frame(spark, [])).count() == 0


def test_tiles_change_nothing(spark, monkeypatch):
    rows = cloud(900, range(0, 9000, 10), 3)
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 100)
    monkeypatch.setattr(hard_negatives, "TILE_ANCHORS", 16)
    got = negatives_table(frame(spark, rows))
    assert Counter(map(tuple, got.collect())) == mined(rows)


def test_products_beyond_doubles():
    a, b = np.array([[2**40 + 1, 3]]), np.array([[2**20 + 1, 5], [2**60, 0]])
    assert products(a, b)[0].tolist() == [(2**40 + 1) * (2**20 + 1) + 15, 2**63 - 1]
    assert products(np.array([[5]]), np.array([[2, 7]])).tolist() == [[10]]


# -- nearest neighbours ---------------------------------------------------------------


def neighbours(rows, k=20, every=20):
    """Every query against every row: the score of every pair, and the lists."""
    kept = {}
    for i, vector, *_ in rows:
        if i is not None and usable(vector) and any(vector):
            kept[i] = min(kept.get(i, vector), vector)
    out = Counter()
    for q, own in kept.items():
        if q % every == 0:
            # Not sum(), which corrects rounding.
            scored = sorted(
                (-reduce(lambda s, p: s + p[0] * p[1], zip(own, v, strict=False), 0.0), i)
                for i, v in kept.items() if i != q
            )
            for r, (score, i) in enumerate(scored[:k], 1):
                out[q, r, i, -score] += 1
    return out


@pytest.mark.parametrize("rows", [
    ODD,
    ODD + cloud(450, range(10, 460), 4),
    # A third of all rows is one vector, more rows have equal scores; norms differ widely.
    cloud(300, range(0, 3000, 10), 5, dims=3, step=0.5) + [(5000 + i, [2.0, -1.0, 0.5], 1) for i in range(160)]
    + [(9000, [1e200, 1.0, 0.0], 1), (9020, [1e-200, 0.0, 0.0], 2)],
])
def test_nearest_equal_brute_force(spark, rows):
    got = nearest.nearest_table(frame(spark, rows))
    assert [t for _, t in got.dtypes] == ["bigint", "int", "bigint", "double"]
    assert Counter(map(tuple, got.collect())) == neighbours(rows)


def test_nearest_of_an_empty_table(spark):
    assert nearest.nearest_table(frame(spark, [])).count() == 0
    assert nearest.nearest_table(frame(spark, [(20, [1.0], 1)])).count() == 0


def recall(rows, got):
    want = neighbours(rows)
    found = {(r.query_id, r.vec_id): r.score for r in got.collect()}
    scores = {(q, i): s for q, _, i, s in want}
    right = [p for p in scores if p in found]
    assert all(found[p] == scores[p] for p in right)
    return len(right) / len(scores)


def test_recall_where_vectors_have_no_structure(spark):
    """Directions without structure: the windows grow until they hold the neighbours."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding", "label").collect()]
    assert recall(rows, nearest.nearest_table(table)) >= 0.9


def test_recall_with_windows_that_hold_a_part(spark, monkeypatch):
    """Groups of near vectors: a small share of the rows is visited."""
    rnd = np.random.default_rng(8)
    centres = rnd.normal(size=(150, 24))
    values = np.repeat(centres, 40, axis=0) + rnd.normal(size=(6000, 24)) * 0.1
    rows = [(int(i), v, 1) for i, v in zip(rnd.permutation(6000), values.tolist(), strict=True)]
    monkeypatch.setattr(nearest, "LEAST_WINDOW", 16)
    monkeypatch.setattr(nearest, "BLOCK", 256)
    monkeypatch.setattr(nearest, "SPAN", 1000)
    seen = []
    window = nearest.Index.window
    monkeypatch.setattr(nearest.Index, "window", lambda *a: seen.append(window(*a)) or seen[-1])
    assert recall(rows, nearest.nearest_table(frame(spark, rows))) >= 0.9
    curves, reach = seen[0]
    assert curves * 2 * reach < 6000 / 2


def test_hilbert_keys_walk_from_cell_to_neighbour():
    cells = np.array([(i, j, k) for i in range(8) for j in range(8) for k in range(8)])
    keys = nearest.hilbert_keys(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()
