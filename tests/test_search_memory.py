"""What a task of an exact search holds, and what it finds beside a plain search."""

import tracemalloc

import numpy as np
import pyarrow as pa

from docloom.operators import search as R
from docloom.operators.index import nearest_cells


def lists_of(table):
    return pa.ListArray.from_arrays(pa.array(np.arange(len(table) + 1, dtype=np.int32) * table.shape[1]), pa.array(table.ravel()))


def test_a_block_of_queries_is_scored_in_parts():
    rng = np.random.default_rng(1)
    points, asks = rng.normal(size=(R.ROWS, 8)), rng.normal(size=(R.BLOCK, 8))
    asks[5] = 0
    points[7] = 0
    points[100:120] = points[99]  # ties go by id
    lists, names = lists_of(points), np.arange(R.ROWS).astype(object)
    best = R.Best(list(range(R.BLOCK)), asks, 10)
    tracemalloc.start()
    for _ in range(2):
        best.add(names, lists)
        names = names + R.ROWS
    found = pa.Table.from_batches(list(best.rows())).to_pydict()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100 << 20  # a matrix of all scores alone has 256 MB
    got = {}
    for q, i in zip(found["query_id"], found["id"]):
        got.setdefault(q, []).append(i)
    assert len(got) == R.BLOCK - 1 and 5 not in got and all(len(x) == 10 for x in got.values())
    unit = points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-300)
    for q in range(0, R.BLOCK, 97):
        scores = unit @ (asks[q] / np.linalg.norm(asks[q]))
        order = sorted((-round(s, 9), i + c * R.ROWS) for i, s in enumerate(scores) if i != 7 for c in range(2))[:10]
        assert sorted(-s for s, _ in order) == sorted(round(scores[i % R.ROWS], 9) for i in got[q])


def test_cells_are_compared_in_parts():
    rng = np.random.default_rng(2)
    table, centroids = rng.normal(size=(3000, 4)), rng.normal(size=(4096, 4))
    tracemalloc.start()
    near = nearest_cells(table, centroids, 3)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60 << 20 and near.shape == (3000, 3)
    assert (near[:50] == np.argsort(-(table[:50] @ centroids.T), axis=1, kind="stable")[:, :3]).all()
    assert nearest_cells(table[:0], centroids, 3).shape == (0, 3)
