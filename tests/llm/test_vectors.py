"""Near-equal vectors against all pairs in plain numpy."""

import numpy as np
import pytest

from flowgraph.llm import vector_near


def plain(rows, least=0.98):
    """(id, n_links, component, kept) of (id, label, vector) rows."""

    def usable(label, v):
        return label is not None and v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = len(rows)
    links, parent = np.zeros(n, int), list(range(n))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            (_, la, a), (_, lb, b) = rows[i], rows[j]
            if usable(la, a) and usable(lb, b) and la == lb and len(a) == len(b):
                a, b = np.array(a, float), np.array(b, float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                    links[i] += 1
                    links[j] += 1
                    parent[top(i)] = top(j)
    groups = {}
    for i in range(n):
        groups.setdefault(top(i), []).append(rows[i][0])
    out = []
    for i in range(n):
        component = min((x for x in groups[top(i)] if x is not None), default=None)
        out.append((rows[i][0], int(links[i]), component, rows[i][0] is not None and rows[i][0] == component))
    return sorted(out, key=repr)


def found(spark, rows, **more):
    df = spark.createDataFrame([(i, l, v, "x", 1, 2) for i, l, v in rows], "vec_id long, label int, embedding array<float>, node string, n int, d int")
    return sorted((tuple(r) for r in vector_near.link(df, **more).collect()), key=repr)


def clustered(seed, d, centres, size, spread):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(centres):
        centre = rng.standard_normal(d)
        for _ in range(size):
            v = centre / np.linalg.norm(centre) + rng.standard_normal(d) * spread * rng.random() / np.sqrt(d)
            rows.append([float(x) for x in np.float32(v * rng.uniform(0.1, 5))])
    order = rng.permutation(len(rows))
    return [(int(i), int(rng.integers(0, 2)), rows[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("d,cell_rows", [(64, 4096), (64, 20), (13, 16), (3, 8), (1, 4)])
def test_links_equal_all_pairs(spark, d, cell_rows):
    rows = clustered(d, d, 12, 30, 0.4)
    want = plain(rows)
    assert found(spark, rows, cell_rows=cell_rows) == want
    if d > 3:
        assert 0 < sum(r[1] for r in want) < len(rows) ** 2 / 8


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, 0, [1.0, 0.0]), (2, 0, [2.0, 0.0]), (2, 0, [1.0, 0.0]), (2, 0, [0.0, 1.0]), (None, 0, [0.0, 1.0]), (None, 0, [-1.0, 0.0]), (3, None, [1.0, 0.0]),
        (4, 0, None), (5, 0, []), (6, 0, [0.0, 0.0]), (7, 0, [nan, 1.0]), (8, 0, [inf, 1.0]), (9, 0, [None, 1.0]), (10, 1, [1.0, 0.0]),
        (11, 0, [1.0, 0.0, 0.0]), (12, 0, [1e-38, 1e-42]), (13, 0, [3e38, -0.0]), (14, 0, [1.0, -0.0]), (4, 0, None),
    ]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []


def test_one_class_with_most_rows_and_a_large_cluster(spark):
    rows = [(i, 1, [0.6, 0.8, 0.0]) for i in range(300)] + [(1000 + i, l, v) for i, l, v in clustered(4, 3, 1, 300, 0.05)]
    assert found(spark, rows, cell_rows=32) == plain(rows)


def test_cells_hold_every_neighbour():
    rng = np.random.default_rng(8)
    d, part = 64, slice(0, 8)
    base = rng.standard_normal((3000, d))
    vectors = np.concatenate([base, base + rng.standard_normal((3000, d)) * 0.15])
    rotated = np.rint(vector_near.units(vectors) @ vector_near.rotation(d) * vector_near.UNIT).astype(np.int16)
    cuts = vector_near.quantiles(list(vectors[:500]))[d][part]
    budget = vector_near.share(8, d, 0.98)
    row, cell, home = vector_near.cells(rotated[:, part], cuts, 9, budget)
    assert home.sum() == len(vectors) and len({*zip(row, cell)}) == len(row)
    at_home = dict(zip(row[home], cell[home]))
    seen = {*zip(row.tolist(), cell.tolist())}
    away = ((rotated[:3000, part].astype(int) - rotated[3000:, part]) ** 2).sum(1)
    near = np.flatnonzero(away <= budget)
    assert len(near) > 100 and all((3000 + i, at_home[i]) in seen and (i, at_home[3000 + i]) in seen for i in near.tolist())
    assert max(np.bincount(list(at_home.values()))) < 300


def test_a_group_of_pairs_is_returned_as_a_forest():
    n, d = 500, 16
    vectors = vector_near.units(np.random.default_rng(9).standard_normal((n, d)) * 0.01 + 1)
    q = np.rint(vectors @ vector_near.rotation(d) * vector_near.UNIT).astype(np.int16)
    group = vector_near.Group(np.arange(n), np.ones(n, bool), np.ones(n), vectors, q, 0, 0.98)
    group.meet(np.arange(n), np.arange(n))
    assert (group.links == n - 1).all() and (group.parent == 0).all()
    later = vector_near.Group(np.arange(n), np.ones(n, bool), np.ones(n), vectors, q, 1, 0.98)
    later.meet(np.arange(n), np.arange(n))
    assert not later.links.any()  # every pair belongs to the first block
