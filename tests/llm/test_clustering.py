"""Ns-bounds clustering against plain k-means in whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from ledgerloom.llm import ns_clusters as ns


def plain(rows, clusters=8, rounds=10, seed=3, size=64):
    kept = []
    for i, e in rows:
        if e is not None and len(e) == size and all(x is not None and math.isfinite(x) for x in e):
            kept.append((i, [math.floor(1024 * float(np.float32(x))) for x in e]))
    order = sorted(kept, key=lambda r: ((r[0] is None), hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    c = [v for _, v in order[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), k) for k, m in enumerate(c))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for k in range(len(c)):
            mine = [v for (_, v), o in zip(kept, own) if o == k]
            if mine:
                c[k] = [sum(col) // len(mine) for col in zip(*mine)]
    end = [nearest(v) for _, v in kept]
    whole = sum(d for d, _ in end)
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return [(i, k, d, sum(x for x, y in end if y == k), whole, sha[k]) for (i, _), (d, k) in zip(kept, end)]


def rows_of(seed, n, spread, size=64):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(size)] for _ in range(6)]
    return [(i, [x + r.gauss(0, spread) for x in r.choice(centres)]) for i in range(n)]


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    return [tuple(r) for r in ns.clustered(df, **more).collect()]


def key(r):
    return tuple((x is not None, x) for x in r)


NAN = float("nan")
ODD = [(100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [None] + [1.0] * 63), (105, [NAN] + [0.0] * 63), (106, [float("inf")] + [0.0] * 63), (107, [-0.0001] * 64), (None, [0.5] * 64), (3, [0.25] * 64), (3, [0.25] * 64)]


@pytest.mark.parametrize("rows", [
    rows_of(1, 150, 0.3), rows_of(2, 120, 2.0), rows_of(3, 60, 0.05) + ODD, [(i, [float(i % 3)] * 64) for i in range(40)], [(i, [1.0] * 64) for i in range(20)], rows_of(4, 5, 1.0), ODD, []])
def test_assignments_are_those_of_the_plain_method(spark, rows):
    assert sorted(run(spark, rows), key=key) == sorted(plain(rows), key=key)


def test_bounds_save_work_and_change_nothing():
    r = np.random.default_rng(1)
    v = (r.normal(size=(6, 64))[r.integers(0, 6, 3000)] * 1024 + r.normal(size=(3000, 64)) * 300).astype(np.int64)
    history = v[:8][None]
    n = len(v)
    state = np.full(n, -1, np.int32), np.zeros(n), np.zeros(n, np.int32), np.zeros((n, 8)), np.zeros((n, 8), np.int32)
    work = []
    for t in range(11):
        *state, measured = ns.assign(v, history, *state)
        exact = np.square(v[:, None, :] - history[-1][None]).sum(-1)
        assert (state[0] == exact.argmin(1)).all()
        work.append(int(measured.sum()))
        # stored bounds, loosened by the total displacement, still hold
        drift = np.sqrt(np.square((history - history[-1]).astype(float)).sum(-1))
        others = np.arange(8)[None, :] != state[0][:, None]
        low = state[3] - drift[state[4], np.arange(8)[None, :]]
        assert (low[others] <= np.sqrt(exact)[others] + 1e-6).all()
        new = np.array([v[state[0] == k].sum(0) // max((state[0] == k).sum(), 1) if (state[0] == k).any() else history[-1][k] for k in range(8)])
        history = np.concatenate([history, new[None]])
    assert work[0] == 8 * n and sum(work[1:]) < 0.5 * 8 * n * 10


def test_too_large_a_component_is_an_error(spark):
    with pytest.raises(Exception, match="after scaling"):
        run(spark, [(1, [3e6] * 64)])


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, [1.0] * 64, 3, "x")], "vec_id bigint, embedding array<float>, cluster int, v string")
    assert ns.clustered(df).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
