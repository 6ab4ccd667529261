import random

import numpy as np

from promptmill.llm import quality


def corpus(n=300):
    r = random.Random(3)
    words = ["".join(r.choices(["an", "the", "er", "on", "ti", "es"], k=r.choice([1, 2, 3]))) for _ in range(400)]
    rows = []
    for i in range(n):
        own = r.choices(words, k=r.choice([3, 40, 200]))
        good = i % 4 != 0
        if not good:
            own = [w + "$$$" for w in own] if i % 8 else [own[0]] * len(own)
        rows.append((i, " ".join(own), good))
    return rows


def test_dual_coordinate_descent_meets_the_optimum():
    r = np.random.default_rng(0)
    rows = [np.unique(r.integers(0, 12, 5)) for _ in range(30)]
    scale, y = r.normal(size=12), np.where(r.random(30) < 0.5, 1.0, -1.0)
    w = quality._dual_coordinate_descent(rows, scale, y, 1.0, 2000)
    x = np.zeros((30, 12))
    for i, own in enumerate(rows):
        x[i, own] = scale[own]

    def loss(v):
        return 0.5 * v @ v + np.maximum(0, 1 - y * (x @ v)).sum()

    for _ in range(300):
        assert loss(w) <= loss(w + r.normal(size=12) * 0.01) + 1e-3


def test_repeats_and_shapes_are_seen():
    assert set(quality.indicators("x")) != set(quality.indicators("X"))
    assert len(quality.indicators("")) == 1 and quality.indicators("")[0] == 0
    a, b = quality.indicators("da da da da"), quality.indicators("mo mo mo mo")
    assert len(set(a) & set(b)) >= 3  # the shapes of repeats


def test_held_out_documents(spark, docs):
    rows = corpus()
    held = {i for i, _, _ in rows if __import__("zlib").crc32(str(i).encode()) % 4 == 2}
    table = docs([(i, t) for i, t, _ in rows] + [(1, rows[1][1]), (None, None), (9000, "")])
    labels = spark.createDataFrame([(i, int(g), "x") for i, _, g in rows if i not in held] + [(1, None, "x"), (None, 1, "x")],
                                   "doc_id long, quality int, text string")
    model = quality.fit(table, labels)
    found = quality.score(table, model).collect()
    assert len(found) == len(rows) + 3
    score = {r.doc_id: r.score for r in found}
    right = [(score[i] >= 0.7) == g for i, _, g in rows if i in held]
    assert sum(right) / len(right) > 0.95
    assert all(0 <= s <= 1 for s in score.values()) and score[9000] == score[None]


def test_one_class_or_no_rows(spark, docs):
    table = docs([(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(table, quality.fit(table, none)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (1, 1)], "doc_id long, quality int")
    assert {round(r.score, 6) for r in quality.score(table, quality.fit(table, one)).collect()} == {round(2 / 3, 6)}
    assert quality.score(table.limit(0), quality.fit(table.limit(0), one)).count() == 0


def test_query_and_stage(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.op1_quality(spark, sf).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert held and sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    left = quality.stage(spark, docs, sf)
    assert left.columns == docs.columns
    assert left.count() == quality.op1_quality(spark, sf).filter("predicted = 1").count()
