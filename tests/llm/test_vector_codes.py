"""Product codes against rounds that compute every distance."""

import math

import numpy as np
import pytest

from offerquarry.llm import vector_codes


def plain(vectors, parts, entries, rounds):
    """Codes, errors and codebooks with whole numbers in plain lists."""
    rows = [[math.floor(256 * x) for x in v] for v in vectors]
    width = len(rows[0]) // parts
    cut = [[r[p * width : (p + 1) * width] for p in range(parts)] for r in rows]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        distances = [sum((a - b) ** 2 for a, b in zip(part, e)) for e in book]
        return distances.index(min(distances)), min(distances)

    for _ in range(rounds):
        for p, book in enumerate(books):
            of = [nearest(c[p], book)[0] for c in cut]
            for e in range(len(book)):
                mine = [c[p] for c, o in zip(cut, of) if o == e]
                if mine:
                    book[e] = [sum(v) // len(mine) for v in zip(*mine)]
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    return [bytes(i for i, _ in f) for f in found], [sum(d for _, d in f) for f in found], books


@pytest.mark.parametrize("entries, rounds, scale", [(64, 2, 0.3), (10, 5, 0.02), (8, 3, 2000.0)])
def test_codes_equal_the_plain_version(spark, entries, rounds, scale):
    rng = np.random.default_rng(entries)
    vectors = (rng.normal(size=(300, 32)) * scale).round(4)
    vectors[50:80] = vectors[3]  # repeated rows
    rows = [(i, i % 3, v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(4)
    found, books = vector_codes.train_and_encode(table, parts=8, entries=entries, rounds=rounds)
    codes, errors, expected = plain(vectors.tolist(), 8, entries, rounds)
    assert [b.tolist() for b in books] == expected
    by_id = {r.vec_id: r for r in found.collect()}
    assert [bytes(by_id[i].codes) for i in range(300)] == codes
    assert [by_id[i].error for i in range(300)] == errors


def test_bounds_save_distances_and_give_exact_codes():
    rng = np.random.default_rng(2)
    centres = rng.integers(-5000, 5000, (64, 4))
    x = centres[rng.integers(0, 64, 4000)] + rng.integers(-300, 300, (4000, 4))
    history = [x[:64].copy()]
    state = (np.zeros(4000, np.uint8), np.full((4000, vector_codes.GROUPS), -np.inf, np.float32), np.zeros((4000, vector_codes.GROUPS), np.uint8))
    scans = []
    for _ in range(8):
        codes, bounds, stamps, best, scanned = vector_codes.reassigned(x, *state, history)
        everything = ((x[:, None] - history[-1][None]) ** 2).sum(2)
        assert (codes == everything.argmin(1)).all() and (best == everything.min(1)).all()
        scans.append(scanned)
        book = history[-1].copy()
        for e in range(64):
            if (codes == e).any():
                book[e] = x[codes == e].sum(0) // (codes == e).sum()
        history.append(book)
        state = codes.astype(np.uint8), bounds, stamps
    assert scans[0] == 4000 * 64 and scans[-1] < scans[0] / 3


def test_net_moves_are_not_longer_than_the_sum_of_moves():
    rng = np.random.default_rng(3)
    history = [rng.integers(0, 100, (64, 4))]
    for _ in range(4):
        history.append(history[-1] + rng.integers(-5, 6, (64, 4)))
    steps = [np.sqrt(((b - a) ** 2).sum(1)) for a, b in zip(history, history[1:])]
    for t, net in enumerate(vector_codes.net_moves(history)):
        drift = sum(steps[t:], np.zeros(64))
        assert all(n <= drift[g].max() * (1 + 1e-6) for n, g in zip(net, vector_codes.groups_of(64)))


def test_edge_rows(spark):
    kinds = "vec_id long, label int, embedding array<float>, codes string, error string"
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, 1, [0.5] * 32, "x", "y"), (2, None, [0.25] * 32, "x", "y"), (2, None, [0.25] * 32, "x", "y"),
        (None, 1, [1e30] * 32, "x", "y"), (4, 1, None, "x", "y"), (5, 1, [nan] * 32, "x", "y"),
        (6, 1, [inf] * 32, "x", "y"), (7, 1, [None] * 32, "x", "y"), (8, 1, [1.0] * 16, "x", "y"), (9, 1, [], "x", "y"),
    ]
    found, books = vector_codes.train_and_encode(spark.createDataFrame(rows, kinds))
    kept = sorted(((r.vec_id, r.label, r.error) for r in found.collect()), key=str)
    assert kept == [(1, 1, 0), (2, None, 0), (2, None, 0), (None, 1, 0)]
    assert len(books) == 16 and len(books[0]) == 4
    empty, none = vector_codes.train_and_encode(spark.createDataFrame([], kinds))
    assert empty.collect() == [] and none == []
