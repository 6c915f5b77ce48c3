"""Centroid clustering against plain loops."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docwatch.llm import centroids as cl

SCHEMA = "vec_id long, embedding array<float>, label int, v string, cluster string, distance string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "y", "z") for i, v in rows], SCHEMA)


def plain(rows, how):
    kept = [
        (i, tuple(int(np.floor(how.scale * float(np.float32(x)))) for x in v))
        for i, v in rows
        if v is not None and len(v) == how.dimension and all(x is not None and np.isfinite(x) for x in v)
    ]
    digest = lambda i: (i is None, hashlib.sha256(f"{how.seed}:{i}".encode()).hexdigest())
    centres = [v for _, v in sorted(kept, key=lambda r: (*digest(r[0]), r[1]))[: how.k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(how.rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, own in groups.items():
            centres[j] = tuple(sum(x) // len(own) for x in zip(*own))
    placed = [(i, *nearest(v)[::-1]) for i, v in kept]
    inside = {}
    for _, j, d in placed:
        inside[j] = inside.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((i is None, i or 0, j, d, inside[j], sum(inside.values()), sha[j]) for i, j, d in placed)


def ours(table, how):
    rows = cl.cluster_vectors(table, how).collect()
    return sorted(
        (r.vec_id is None, r.vec_id or 0, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in rows
    )


@pytest.mark.parametrize("n, k", [(300, 16), (5, 16), (40, 40), (1, 3)])
def test_equals_plain_rounds(spark, n, k):
    draw = np.random.default_rng(n)
    how = cl.Clustering(dimension=8, k=k)
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(draw.normal(size=(n, 8)))]
    rows += [(i, rows[0][1]) for i in range(1000, 1000 + n)]  # half of all rows are one vector
    rows += [(rows[0][0], rows[0][1]), (None, rows[-1][1]), (None, [0.5] * 8)]
    odd = [(2001, None), (2002, []), (2003, [1.0] * 7), (2004, [1.0] * 7 + [None]), (2005, [float("nan")] * 8),
           (2006, [float("inf")] + [0.0] * 7)]
    assert ours(frame(spark, rows + odd).repartition(5), how) == plain(rows + odd, how)


def test_nothing(spark):
    assert cl.cluster_vectors(frame(spark, [])).count() == 0
    assert cl.cluster_vectors(frame(spark, [(1, [1.0]), (2, None)])).count() == 0


def test_far_components_raise(spark):
    table = frame(spark, [(1, [float(cl.limit(64))] * 64)])
    with pytest.raises(Exception, match="a component times 64 exceeds"):
        cl.cluster_vectors(table).collect()


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.lists(st.integers(-3, 3), min_size=3, max_size=3), min_size=1, max_size=12),
    st.lists(st.lists(st.integers(-3, 3), min_size=3, max_size=3), min_size=1, max_size=30),
)
def test_search_with_many_ties(centres, vectors):
    label, distance = cl.Searcher(np.array(centres)).nearest(np.array(vectors))
    for v, j, d in zip(vectors, label, distance):
        assert (d, j) == min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centres))


def test_largest_components():
    most = cl.limit(64)
    rows = np.array([[most] * 64, [-most] * 64, [most, -most] * 32, [0] * 64])
    search = cl.Searcher(rows)
    label, distance = search.nearest(rows)
    assert label.tolist() == [0, 1, 2, 3] and not distance.any()
    assert cl.Searcher(rows[:1]).nearest(rows[1:2])[1][0] == 64 * (2 * most) ** 2


def test_inequalities_save_distances():
    draw = np.random.default_rng(1)
    centres = draw.integers(-64, 64, size=(64, 16)) + draw.integers(-200, 200, size=(64, 1))
    vectors = centres[draw.integers(0, 64, size=2000)] + draw.integers(-5, 6, size=(2000, 16))
    search = cl.Searcher(centres)
    label, _ = search.nearest(vectors)
    apart = ((vectors[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (label == apart.argmin(axis=1)).all()
    assert search.summed < search.possible / 5
