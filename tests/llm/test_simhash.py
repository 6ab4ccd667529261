import random

import numpy as np
import xxhash

from promptmill.llm import simhash


def slow_fingerprint(text, words=3):
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    h = [xxhash.xxh64_intdigest(b" ".join(parts[i:i + words]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > n)


def brute(pairs, bits=2):
    fps = [(i, slow_fingerprint(t)) for i, t in pairs]
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for a in range(len(fps)):
            for b in range(len(fps)):
                if (fps[a][1] ^ fps[b][1]).bit_count() <= bits and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    least = {}
    for (i, _), c in zip(fps, label):
        least[c] = min([x for x in (least.get(c), i) if x is not None], default=None)
    return sorted([(i, f, least[c]) for (i, f), c in zip(fps, label)], key=str)


def test_every_near_pair_meets_at_a_home():
    r = random.Random(1)
    fps = np.array([r.getrandbits(64) for _ in range(200)], np.uint64)
    for codes in (1, 2, 3):
        home = {}
        row, anchor, own = simhash.anchors(fps, 2, codes)
        assert np.array_equal(np.sort(row[own]), np.arange(200))
        for i, a in zip(row[own], anchor[own]):
            home[i] = a
        for i in range(200):
            for k in range(3):
                y = int(fps[i])
                for bit in r.sample(range(64), k):
                    y ^= 1 << bit
                _, near, _ = simhash.anchors(np.array([y], np.uint64), 2, codes)
                assert home[i] in set(near)


def test_against_brute_force(spark, docs):
    r = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    pairs = []
    for i in range(60):
        own = r.choices(words, k=r.choice([1, 2, 5, 400, 900]))
        pairs.append((10 * i, " ".join(own)))
        for k in range(r.choice([0, 0, 3])):
            own[r.randrange(len(own))] = "other"
            pairs.append((10 * i + k + 1, "\t".join(own).upper()))
    pairs += [(7000, ""), (7001, None), (7002, " \n"), (7003, "a b"), (7003, "a b"), (7003, "entirely else"), (None, "w1"), (None, None)]
    found = simhash.near_duplicates(docs(pairs)).collect()
    got = sorted([(x.doc_id, x.fp & (1 << 64) - 1, x.component_id) for x in found], key=str)
    assert got == brute(pairs)


def test_a_dense_cluster_and_a_chain_stay_whole(spark):
    base = 0x0123456789ABCDEF
    dense = [base ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)]
    chain, x = [], 1 << 62
    for bit in range(0, 60, 2):
        x ^= 3 << bit
        chain.append(x)
    signed = [int(np.uint64(v).astype(np.int64)) for v in {*dense, *chain}]
    fps = spark.createDataFrame([(v, i) for i, v in enumerate(signed)], "fp long, label long")
    edges = simhash.links(fps.select("fp"))
    found = {r.fp: r.component for r in simhash.components(fps, edges).collect()}
    of = {v: i for i, v in enumerate(signed)}
    for group in (dense, chain):
        own = [int(np.uint64(v).astype(np.int64)) for v in group]
        assert {found[v] for v in own} == {min(of[v] for v in own)}
    assert edges.count() < 61 * len(signed)


def test_empty_and_stage(spark, docs):
    assert simhash.near_duplicates(docs([]).limit(0)).count() == 0
    some = docs([(3, "one two three four"), (1, "ONE two three four"), (1, "one two three four"), (9, "something else is here"), (None, "x")])
    left = simhash.stage(spark, some, "")
    assert left.columns == some.columns
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 1, 9]
