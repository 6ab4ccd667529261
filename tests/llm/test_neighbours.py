import numpy as np

from promptmill.llm import neighbours as n


def brute(rows, asked, k):
    out = []
    for q in sorted({i for i, _ in asked}):
        v = min(tuple(x) for i, x in asked if i == q)
        near = []
        for i, x in rows:
            if i != q and len(x) == len(v):
                total = 0.0
                for a, b in zip(v, x):
                    total += a * b
                near.append((-total, i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(near)[:k])]
    return out


def vectors(seed=0, size=900, dim=24):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, dim))
    rows = [(i, (centres[i % 12] + 0.3 * r.normal(size=dim)).astype(np.float32).astype(float).tolist()) for i in range(size)]
    rows += [(5000 + i, rows[0][1]) for i in range(200)]  # one very common vector
    return rows


def run(spark, rows, k=20):
    df = spark.createDataFrame([(i, x, "mine") for i, x in rows], "vec_id long, embedding array<double>, block string").repartition(5)
    own = n.usable(df, "vec_id", "embedding")
    return sorted(tuple(r) for r in n.nearest(own, own.filter("id % 20 = 0"), k).collect())


def test_equals_brute_force_for_small_blocks(spark, monkeypatch):
    rows = vectors()
    want = brute(rows, [x for x in rows if x[0] % 20 == 0], 20)
    for room, asked, pairs in ((n.BLOCK_BYTES, n.QUERY_ROWS, n.TILE), (24 * 8 * 50, 10, 300)):
        monkeypatch.setattr(n, "BLOCK_BYTES", room)
        monkeypatch.setattr(n, "QUERY_ROWS", asked)
        monkeypatch.setattr(n, "TILE", pairs)
        assert run(spark, rows) == want


def test_rows_that_take_no_part(spark):
    good = [(i, [float(i % 7 - 3), 1.0, float(i % 5)]) for i in range(0, 60)]
    odd = [(100, None), (120, []), (140, [0.0, 0.0, 0.0]), (160, [None, 1.0, 2.0]), (180, [float("nan"), 1.0, 1.0]), (200, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    other = [(220, [1.0, 2.0]), (221, [3.0, 4.0]), (20, [9.0, 9.0, 9.0])]
    rows = good + other
    assert run(spark, rows + odd, 3) == brute(rows, [x for x in rows if x[0] % 20 == 0], 3)
    few = [(0, [1.0]), (1, [2.0]), (1, [2.0])]
    assert run(spark, few) == [(0, 1, 1, 2.0), (0, 2, 1, 2.0)]
    assert run(spark, []) == [] and run(spark, [(20, [1.0])]) == []


def test_bound_holds():
    r = np.random.default_rng(1)
    for scale in (1e-6, 1.0, 1e6):
        q, c = scale * r.normal(size=(40, 33)) ** 3, r.normal(size=(50, 33)) ** 5
        (qa, qs, q1), (ca, cs, c1) = n._quantised(q), n._quantised(c)
        near = qa.astype(float) @ ca.astype(float).T * np.outer(qs, cs)
        error = (np.outer(qs, c1) + np.outer(q1, cs)) / 2 + 33 / 4 * np.outer(qs, cs)
        assert (np.abs(q @ c.T - near) <= error * n.ROOM).all()


def test_products_beyond_the_range_of_doubles(spark):
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=6).tolist()) for i in range(200)]
    rows += [(1000 + i, (r.random(6) * 10.0 ** e).tolist()) for i, e in enumerate((154, 154, 155, 155, 160, 300, 307, -300))]
    rows += [(2000, (r.random(6) * 1e154).tolist()), (2020, (r.random(6) * 1e155).tolist()), (2040, (r.random(6) * 1e-200).tolist())]
    assert run(spark, rows) == brute(rows, [x for x in rows if x[0] % 20 == 0], 20)
