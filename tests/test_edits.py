import random

import numpy as np
import pytest

from promptmill.operators import edits as ed


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_path(a, b):
    """Steps of a best alignment from the end: both, then a word of ``a`` alone, then one of ``b``."""
    best = {(i, j): plain_distance(a[:i], b[:j]) for i in range(len(a) + 1) for j in range(len(b) + 1)}
    i, j, steps = len(a), len(b), []
    while i or j:
        if i and j and best[i, j] == best[i - 1, j - 1] + (a[i - 1] != b[j - 1]):
            i, j = i - 1, j - 1
            steps.append((i, j))
        elif i and best[i, j] == best[i - 1, j] + 1:
            i -= 1
            steps.append((i, None))
        else:
            j -= 1
            steps.append((None, j))
    return steps[::-1]


def plain_edits(a, b):
    """Greedy shifts, one move after the other."""
    a, made = list(a), 0
    while a and b and plain_distance(a, b):
        place, bad_a, bad_b, at = -1, set(), set(), {}
        for i, j in plain_path(a, b):
            place = place if i is None else i
            if j is not None:
                at[j] = place
            if i is None or j is None or a[i] != b[j]:
                bad_a |= {i}
                bad_b |= {j}
        now, best = plain_distance(a, b), None
        for s in range(len(a)):
            for r in range(len(b)):
                for n in range(1, 11):
                    if abs(s - r) > 50 or s + n > len(a) or r + n > len(b) or a[s:s + n] != b[r:r + n]:
                        break
                    if not bad_a & set(range(s, s + n)) or not bad_b & set(range(r, r + n)) or s <= at[r] < s + n:
                        continue
                    for to in {at[r - 1] + 1 if r else 0, *(at[k] + 1 for k in range(r, r + n))}:
                        rest = a[:s] + a[s + n:]
                        k = to - n if to > s + n else to
                        order = (plain_distance(rest[:k] + a[s:s + n] + rest[k:], b), -n, s, to)
                        if order[0] < now and (best is None or order < best[0]):
                            best = order, rest[:k] + a[s:s + n] + rest[k:]
        if best is None:
            break
        a, made = best[1], made + 1
    return plain_distance(a, b) + made, made


def test_against_the_plain_version():
    r = random.Random(5)
    for k in range(250):
        words = "abcdefghij"[:r.choice([2, 4, 10])]
        a, b = ([r.choice(words) for _ in range(r.randrange(9))] for _ in range(2))
        if k % 3 == 0 and a:
            cut = r.randrange(len(a))
            b = a[cut:] + a[:cut]
        assert ed.shifted_edits(a, b) == plain_edits(a, b), (a, b)
        assert ed.shifted_edits(a, b, cells=1) == plain_edits(a, b)
        if a and b:
            assert ed.distance_table(np.array([ord(x) for x in a]), np.array([ord(x) for x in b]))[-1, -1] == plain_distance(a, b)


@pytest.mark.parametrize("hypothesis, reference, edits, shifts", [
    # worked examples: one moved run counts once, whatever its length
    ("THIS WEEK THE SAUDIS denied information published in the new york times",
     "SAUDI ARABIA denied THIS WEEK information published in the AMERICAN new york times", 4, 1),
    ("a b c d e", "d e a b c", 1, 1), ("a b c", "a b c", 0, 0), ("", "x y", 2, 0), ("x y", "", 2, 0), ("", "", 0, 0),
    ("the cat sat", "the cat sat down", 1, 0), ("b a", "a b", 1, 1), ("x y z w", "w x y z", 1, 1)])
def test_worked_examples(hypothesis, reference, edits, shifts):
    assert ed.shifted_edits(hypothesis.split(), reference.split()) == (edits, shifts)


def test_texts_together_and_over_64_words():
    r = random.Random(6)
    pairs = []
    for k in range(12):
        b = [r.choice("abcdefghijklmnopqrst"[:r.choice([6, 20])]) for _ in range(r.choice([0, 3, 63, 64, 65, 130]))]
        cut = r.randrange(len(b) + 1)
        a = [w for w in b[cut:] + b[:cut] if r.random() < 0.9] + ["z"] * (k % 3)
        pairs.append((a, b))
    for a, b in pairs:
        if a and b:
            table = ed.distance_table(np.array([ord(x) for x in a]), np.array([ord(x) for x in b]))
            assert table[-1, -1] == plain_distance(a, b) and table[len(a) // 2, -1] == plain_distance(a[:len(a) // 2], b)
    one = [ed.shifted_edits(a, b) for a, b in pairs]
    assert one == ed.shifted_edits_of(pairs) == ed.shifted_edits_of(pairs, cells=5_000)
    a, b = (f"{x} ".split() * 33 for x in ("p q", "q p"))
    assert ed.shifted_edits(a, b) == (2, 0)


def test_tasks_follow_rows(spark):
    rows = spark.range(64).selectExpr("id", "'a b c' as prediction", "array('c a b') as references").coalesce(1)
    assert ed.edit_rows(rows, "id", "prediction", "references").rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def test_table(spark):
    rows = [(1, "A b  c\n", ["a b c", "x"]), (2, None, ["one two"]), (3, "d e a b c", ["a b c d e", "q q q q q q q q q"]), (4, "x", []), (5, "", [""]), (6, "x y", [None])]
    df = spark.createDataFrame(rows, "id long, prediction string, references array<string>").repartition(4)
    found = {r.id: (r.edits, r.shifts, r.words) for r in ed.edit_rows(df, "id", "prediction", "references").collect()}
    assert found == {1: (0, 0, 2.0), 2: (2, 0, 2.0), 3: (1, 1, 7.0), 4: (1, 0, 0.0), 5: (0, 0, 0.0), 6: (2, 0, 0.0)}
    one = ed.corpus_ter(df, "id").first()
    assert (one.edits, one.words, round(one.ter, 9)) == (6, 11.0, round(600 / 11, 9))
    assert {r.id: r.ter for r in ed.corpus_ter(df, "id", by=("id",)).collect()} == {1: 0.0, 2: 100.0, 3: 100 / 7, 4: 100.0, 5: 0.0, 6: 100.0}
    assert ed.corpus_ter(df, "id", case=True).first().edits == 7
    assert [tuple(r) for r in ed.corpus_ter(df.limit(0), "id").collect()] == [(0, 0.0, 0.0)]
