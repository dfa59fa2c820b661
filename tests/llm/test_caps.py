import numpy as np

from shelfline.llm import caps

SCHEMA = "vec_id long, embedding array<float>, node string, e int"


def test_links_and_components_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((150, 32))
    near = base[:50] + rng.standard_normal((50, 32)) * 0.15
    v = np.concatenate([base, near, base[:10], base[10:15] * 3]).astype(np.float32)
    odd = [None, [], [0.0] * 32, [float("nan")] * 32, [1.0, None], [float("inf")] * 32, [1.0, 2.0], [1.0]]
    rows = [(i, x.tolist(), "x", 1) for i, x in enumerate(v)] + [(1000 + i, x, None, None) for i, x in enumerate(odd)]
    rows.append((None, v[0].tolist(), None, None))
    got = {r["vec_id"]: r for r in caps.groups(spark.createDataFrame(rows, SCHEMA)).collect()}

    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    linked = unit @ unit.T >= 0.95
    want = linked.sum(axis=1) - 1
    found = np.array([got[i]["n_links"] for i in range(len(v))])
    assert (found <= want).all() and found.sum() >= 0.95 * want.sum()
    least = np.arange(len(v))
    for _ in range(10):
        least = np.array([least[row].min() for row in linked])
    same = np.array([got[i]["component_id"] for i in range(len(v))]) == least
    assert same.mean() >= 0.95
    for i in range(len(odd)):
        assert tuple(got[1000 + i]) == (1000 + i, 0, 1000 + i, True)
    assert tuple(got[None]) == (None, 0, None, True)


def test_empty_table(spark):
    assert caps.groups(spark.createDataFrame([], SCHEMA)).count() == 0
