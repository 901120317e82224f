import hashlib
import math

import numpy as np
import pytest

from citypulse.llm import vector_codes as V


def brute(rows, parts=16, entries=64, rounds=2):
    """Plain Lloyd over all distances; rows (vec_id, vector, label)."""
    kept = [(i, [math.floor(256 * c) for c in v], label) for i, v, label in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([r[1] for r in kept]).reshape(len(kept), parts, -1)
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = x[first].swapaxes(0, 1).copy()
    for k in range(rounds + 1):
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        code = d.argmin(axis=2)
        error = d.min(axis=2).sum(axis=1)
        if k < rounds:
            for p in range(parts):
                for e in range(books.shape[1]):
                    mine = x[code[:, p] == e, p]
                    if len(mine):
                        books[p, e] = mine.sum(axis=0) // len(mine)
    by_label = {}
    for (_, _, label), e in zip(kept, error):
        by_label[label] = by_label.get(label, 0) + int(e)
    sha = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return sorted((i if i is not None else -1, "".join(f"{c:02x}" for c in cs), int(e), by_label[label], sha)
                  for (i, _, label), cs, e in zip(kept, code, error))


def got(df):
    out = V.coded(df)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in out.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def vectors(seed, n, dim=32, spread=0.3):
    r = np.random.default_rng(seed)
    return [(int(i), r.normal(0, spread, dim).astype(np.float32).tolist(), int(r.integers(3)) if i % 7 else None)
            for i in r.permutation(n)]


@pytest.mark.parametrize("seed, spread", [(1, 0.3), (2, 0.004), (3, 50.0)])
def test_against_brute_force(spark, seed, spread):
    # the small spread gives many equal parts, equal entries and ties
    rows = vectors(seed, 700, spread=spread)
    assert got(frame(spark, rows).repartition(5)) == brute(rows)


def test_hot_vector_and_repeated_ids(spark):
    rows = vectors(4, 300)
    hot = rows[5][1]
    rows = [(i, hot if i % 3 == 0 else v, label) for i, v, label in rows]
    rows += [(7, rows[0][1], 1), (7, rows[0][1], 1), (None, rows[1][1], 2)]
    assert got(frame(spark, rows)) == brute(rows)


def test_dropped_rows_and_few_rows(spark):
    rows = [(1, [0.5] * 32, 1), (2, None, 1), (3, [None] + [0.1] * 31, 1), (4, [float("nan")] * 32, 1),
            (5, [float("inf")] * 32, 1), (6, [-0.001] * 32, None), (9, [0.25, -0.5] * 16, 2)]
    assert got(frame(spark, rows)) == brute(rows)
    assert len(got(frame(spark, rows))) == 3
    assert got(frame(spark, [])) == []
    assert got(frame(spark, rows[1:5])) == []


def test_other_lengths_and_clashing_names(spark):
    # 20 components are filled up to 32; rows of 3 components are the fewer
    rows = [(i, [((i * 7 + k) % 11) / 9 for k in range(20)], 1) for i in range(9)] + [(100, [1.0, 2.0, 3.0], 1), (101, [], 1)]
    full = [(i, v + [0.0] * 12, label) for i, v, label in rows[:9]]
    df = frame(spark, rows).selectExpr("*", "'a' as x", "'b' as code", "'c' as error", "1 as ids", "2 as trees")
    got_codes = {r["vec_id"]: (r["code"], r["error"]) for r in V.coded(df).collect()}
    width = 2  # 20 components in 16 parts
    want = brute([(i, v[:16 * width], label) for i, v, label in full])
    assert got_codes == {r[0]: (r[1], r[2]) for r in want}


def test_tree_covers_its_points():
    r = np.random.default_rng(5)
    for rows in (r.integers(-100, 100, (900, 4)), r.integers(0, 3, (900, 4)), np.zeros((50, 4), np.int64),
                 np.concatenate([r.integers(0, 50, (300, 4)), np.full((500, 4), 7)])):
        t = V.build(rows)
        assert (t.points[t.row] == rows).all()
        assert t.count[0] == len(rows) and (t.total[0] == rows.sum(axis=0)).all()
        for k in range(len(t.start)):
            own = t.points[t.start[k]:t.stop[k]].astype(int)
            assert np.sqrt(((own - own[0]) ** 2).sum(axis=1)).max() <= t.radius[k] + 1e-9
            kids = range(t.child[k], t.child[k] + t.children[k])
            if t.children[k]:
                assert t.start[kids[0]] == t.start[k] and t.stop[kids[-1]] == t.stop[k]
                assert all(t.stop[a] == t.start[a + 1] for a in kids[:-1])
                assert sum(t.count[a] for a in kids) == t.count[k]


def test_whole_subtrees_are_assigned():
    """Clusters far apart are settled at inner nodes: no leaf is compared."""
    r = np.random.default_rng(6)
    centres = np.array([[0, 0, 0, 0], [10_000, 0, 0, 0], [0, 10_000, 0, 0]])
    rows = centres[r.integers(0, 3, 6000)] + r.integers(-40, 40, (6000, 4))
    t = V.build(rows)
    count, total = V.nearest(t, centres)
    d = ((rows[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert count.tolist() == np.bincount(d, minlength=3).tolist()
    t2 = t._replace(points=np.where(np.isin(np.arange(len(t.points)), t.start[t.children > 0])[:, None], t.points, 10 ** 4))
    assert V.nearest(t2, centres)[0].tolist() == count.tolist()  # points below settled nodes are never read
