import numpy as np
import pytest

from muster.llm.vectors import link_vectors, spherical_centres, units


def brute(rows, least):
    def known(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    linked = [[j for j, (_, w, m) in enumerate(rows) if j != i and l is not None and l == m and known(v) and known(w) and len(v) == len(w)
               and float(units([v])[0] @ units([w])[0]) >= least] for i, (_, v, l) in enumerate(rows)]
    part = list(range(len(rows)))
    while True:
        new = [min([part[i], *(part[j] for j in own)]) for i, own in enumerate(linked)]
        if new == part:
            break
        part = new
    ids = {p: min([r[0] for r, q in zip(rows, part) if q == p and r[0] is not None], default=None) for p in part}
    return [(r[0], len(own), ids[p], r[0] is not None and r[0] == ids[p]) for r, own, p in zip(rows, linked, part)]


@pytest.mark.parametrize("cell_rows,block", [(1500, 2048), (7, 5)])
def test_against_all_pairs(spark, cell_rows, block):
    draw = np.random.default_rng(4)
    rows = []
    for i in range(90):
        base = draw.normal(size=6)
        rows.append((i, base.tolist(), int(draw.integers(0, 3))))
        if i % 3 == 0:
            rows += [(200 + i + k * 100, (base + draw.normal(size=6) * 0.12).tolist(), rows[-1][2]) for k in range(3)]
    rows += [(900 + k, rows[0][1], rows[0][2]) for k in range(20)]  # copies
    rows += [(901, rows[0][1], rows[0][2]), (None, rows[0][1], rows[0][2]), (None, rows[5][1], None), (950, None, 1), (951, [0.0] * 6, 1), (952, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1),
             (953, [float("nan")] * 6, 1), (954, [float("inf"), 1.0, 0.0, 0.0, 0.0, 0.0], 1), (955, [1e300] * 6, 1), (956, [1e-300] * 6, 1), (957, [1.0, 1.0], 1), (958, [2.0, 2.0], 1), (959, [], 1)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, node string").repartition(3)
    key = lambda r: tuple(-1 if x is None else x for x in r)
    found = link_vectors(frame, cell_rows=cell_rows, block=block, sample=60)
    assert sorted(key((r.vec_id, r.n_links, r.component_id, r.kept)) for r in found.collect()) == sorted(map(key, brute(rows, 0.93)))


def test_chains_over_blocks(spark):
    """Chains of distinct vectors in cells with more blocks of visitors than of homes: no tie of two homes may get lost."""
    draw, rows, want = np.random.default_rng(6), [], []
    for _ in range(400):
        plane = np.linalg.qr(draw.normal(size=(60, 2)))[0]
        ids = [int(i) for i in len(rows) + draw.permutation(4)]
        rows += [(i, (plane @ [np.cos(0.35 * k), np.sin(0.35 * k)]).tolist(), 1) for k, i in enumerate(ids)]
        want += [(i, 1 + (k in (1, 2)), min(ids), i == min(ids)) for k, i in enumerate(ids)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = link_vectors(frame, cell_rows=400, block=1000)
    assert sorted(tuple(r) for r in found.select("vec_id", "n_links", "component_id", "kept").collect()) == sorted(want)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert link_vectors(empty).collect() == []


def test_centres_follow_the_directions():
    draw = np.random.default_rng(2)
    axes = np.eye(4)
    rows = units([(axes[i % 4] + draw.normal(size=4) * 0.05).tolist() for i in range(200)])
    centres = spherical_centres(rows, 4, seed=1)
    assert np.allclose(np.linalg.norm(centres, axis=1), 1)
    assert (rows @ centres.T).max(axis=1).mean() > 0.7
