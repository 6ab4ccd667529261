import random
import re
from collections import Counter

import numpy as np
import pytest
import zstandard

from promptmill.llm import phrases as p


def plain(rows, least=10, first=2000):
    """The query's rows from (lang, text) by counting every phrase."""
    f, total = {}, Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                f.setdefault(lang, Counter()).update(" ".join(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        often = {s: n for s, n in counts.items() if n >= least and " " in s}
        scored = []
        for s, a in often.items():
            w = s.split(" ")
            if len(w) == 2 and any(100 * n >= 50 * a for t, n in often.items() if t.count(" ") == 2 and (t.startswith(s + " ") or t.endswith(" " + s))):
                continue
            cuts = []
            for k in range(1, len(w)):
                l, r = counts[" ".join(w[:k])], counts[" ".join(w[k:])]
                cuts.append((1_000_000 * a * a // (l * r), k, l, r))
            score, _, l, r = min(cuts)
            scored.append((-score, -a, s.encode(), l, r))
        for rank, (score, a, s, l, r) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, s.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def some(seed, n=120, hot=False):
    r = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "a", "é", "İ", "b\x00c", "z\x1fz", "日本", "x-y", "über", "ÜBER"] + [f"w{i}" for i in range(25)]
    signs = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "! ", "\x0b", "\xa0", " ; "]
    rows = []
    for _ in range(n):
        line = "".join(x for _ in range(r.randrange(60)) for x in (r.choices(words, [9, 2, 7, 4, 4, 3, 3] + [1] * (len(words) - 7))[0], r.choice(signs)))
        if hot:
            line += " of the " + r.choice(words) + " of the of the" * r.randrange(4)
        rows.append((r.choice(["en", "en", "en", "fr", None, "und"]), line))
    return rows + [("en", None), (None, ""), ("de", "..."), ("en", "one two three " * 4000), ("en", "one two three " * 12)] + [("fr", "same text each time. other piece")] * 30


def frame(spark, rows, parts=3):
    rows = [(i, lang, t, 5, "mine") for i, (lang, t) in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string, n long, phrase string").repartition(parts)


@pytest.mark.parametrize("few", [1, 5, 40, 10_000])
def test_equal_partitions_equal_plain_counts(few):
    r = random.Random(few)
    rows = [(r.randrange(3), min(r.randrange(40), r.randrange(40)), r.choice([1, 2, 2, 9]), r.randrange(5)) for _ in range(3000)]
    weight = np.array([r.randrange(1, 4) for _ in rows])
    keys = [np.array(c) for c in zip(*rows)]
    for depth, (at, n) in enumerate(p.equal_partitions(keys, weight, 10, max(few, 31)), 1):
        want = Counter()
        for row, w in zip(rows, weight.tolist()):
            want[row[:depth]] += w
        got = [(rows[i][:depth], k) for i, k in zip(at.tolist(), n.tolist())]
        assert sorted(got) == sorted((row, k) for row, k in want.items() if k >= 10)


def test_merging_within_a_target():
    held = {}
    for together in (0, 500, 10 ** 9):
        suffixes = p.Suffixes(together)
        import zstandard
        for chunk in (some(3, 20), some(4, 30), some(3, 20)):
            block = p.Block([(lang or "und", t or "") for lang, t in chunk])
            for t, langs, n, data in p._parcels(block, *p._suffixes(block, {("en", b"one", b"two")}), 1, zstandard.ZstdCompressor()):
                suffixes.add(langs, n, zstandard.ZstdDecompressor().decompress(data))
        held[together] = sorted(x for c in p._found(suffixes, 10) for x in zip(*(a.to_pylist() for a in c)))
    assert held[0] == held[500] == held[10 ** 9] and len(held[0]) > 10


@pytest.mark.parametrize("tuning", [{}, {"chars": 300, "share": 8, "room": 200}, {"chars": 1, "share": 2, "room": 20}, {"chars": 5000, "share": 64, "room": 2000}])
def test_collocations_equal_the_plain_rows(spark, tuning):
    rows = some(5, hot=True)
    assert found(p.collocations(frame(spark, rows), **tuning)) == plain(rows)


def test_first_rows_ties_and_few_rows(spark):
    rows = some(6)
    assert found(p.collocations(frame(spark, rows), first=7)) == plain(rows, first=7)
    ties = [("en", "b a. a b. d c. c d")] * 10
    assert found(p.collocations(frame(spark, ties))) == plain(ties) and len(plain(ties)) == 4
    assert p.collocations(frame(spark, rows).limit(0)).count() == 0
    assert p.collocations(frame(spark, [("en", None), ("en", " "), (None, "a")])).count() == 0
