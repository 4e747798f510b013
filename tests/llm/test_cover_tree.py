import numpy as np
import pytest

from statlab.llm.cover_tree import chord, linked_pairs, near_duplicates, units

EXTRA = "vec_id long, embedding array<double>, label int, cell string, cid string, vector string, links int"


def odd_vectors():
    rng, rows = np.random.default_rng(3), []
    for label in (0, 1, None):
        for centre in rng.normal(size=(25, 8)):
            rows += [(len(rows) + k, (centre + rng.normal(size=8) * 0.28).tolist(), label) for k in range(8)]
    n = len(rows)
    rows += [(n + i, rows[5][1], 0) for i in range(60)]
    rows += [(n + 60, None, 0), (n + 61, [0.0] * 8, 0), (n + 62, [float("nan")] * 8, 0), (n + 63, [1.0] * 7, 0), (n + 64, [], 0),
             (n + 65, [1e200] * 8, 1), (n + 66, [1e199] * 8, 1), (n + 67, [1.0, None] + [0.0] * 6, 1), (n + 68, [float("inf")] * 8, 1),
             (None, rows[5][1], 0), (7, rows[7][1], 0)]
    return [(*r, "c", "i", "v", 1) for r in rows]


def brute(rows, cosine):
    def usable(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    index = [i for i, r in enumerate(rows) if usable(r[1], r[2])]
    unit = {i: units(np.array([rows[i][1]]))[0] for i in index}
    near = {i: [j for j in index if j != i and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in index}
    label = {i: 10**9 if r[0] is None else r[0] for i, r in enumerate(rows)}
    changed = True
    while changed:
        changed = False
        for i in index:
            least = min([label[i], *(label[j] for j in near[i])])
            changed, label[i] = changed or least < label[i], least
    return sorted((str(r[0]), len(near.get(i, [])), None if r[0] is None else label[i]) for i, r in enumerate(rows))


@pytest.mark.parametrize("leaf", [40, 2048])
def test_same_as_brute_force(spark, leaf):
    rows = odd_vectors()
    found = near_duplicates(spark.createDataFrame(rows, EXTRA).repartition(3), leaf=leaf).collect()
    want = brute(rows, 0.93)
    assert sum(n for _, n, _ in want) > 1000
    assert sorted((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in found) == want
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in found)


def test_pruned_pairs_are_exact():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16))
    points = units(np.concatenate([c + rng.normal(size=(40, 16)) * 0.1 for c in centres]))
    i, j = linked_pairs(points, None, 0.93)
    want = np.argwhere(np.triu(points @ points.T >= 0.93, 1))
    assert sorted(zip(i, j)) == sorted(map(tuple, want)) and len(want)
    i, j = linked_pairs(points[:500], points[500:], 0.93)
    assert sorted(zip(i, j)) == sorted(map(tuple, np.argwhere(points[:500] @ points[500:].T >= 0.93)))
    assert chord(1.0) == 0.0


def test_many_vectors_of_one_direction(spark):
    rows = [(i, [float(i + 1), 2.0 * (i + 1)], 3) for i in range(90)]
    found = near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), leaf=20).collect()
    assert {(r["n_links"], r["component_id"]) for r in found} == {(89, 0)}


def test_empty_table(vectors_none):
    assert near_duplicates(vectors_none).collect() == []
