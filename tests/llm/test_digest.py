import hashlib
import math
import random

import numpy as np
import pytest

from promptmill.llm import digest as d


def plain_counts(data):
    """Bucket counts byte by byte."""
    counts, x = [0] * 256, bytes(4) + data
    for j in range(4, len(x)):
        for k, (a, b) in enumerate(d.TRIPLETS, 1):
            code = (k << 24) + (x[j] << 16 | x[j - a] << 8 | x[j - b])
            counts[(code * 0x9E3779B1 & 0xFFFFFFFF) >> 24] += 1
    return counts


def plain_codes(data):
    counts = plain_counts(data)
    ranked = sorted(counts)
    return [d.length_code(len(data)), *[sum(c > ranked[64 * q - 1] for q in (1, 2, 3)) for c in counts]]


def plain_likeness(a, b):
    apart, most = sum(abs(x - y) for x, y in zip(a[1:], b[1:])), sum(map(max, a[1:], b[1:]))
    return (1 - (apart / most if most else 0)) * (1 - min(abs(a[0] - b[0]), 32) / 64)


def plain_rows(pairs):
    """The query's rows, one document at a time; equal doc_ids must have equal texts here."""
    order = sorted([(i, t or "") for i, t in pairs], key=lambda r: (r[0] is not None, r[0] or 0))
    rows = []
    for k, (i, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        half = math.floor(len(t) / 2)
        ed = t[:len(t) - half] + nxt[:half]
        own, other, after = (plain_codes(x.encode()) for x in (t, ed, nxt))
        rows.append((i, len(t), hashlib.sha256(ed.encode()).hexdigest(), d.spelt(np.array([own]))[0], d.spelt(np.array([other]))[0],
                     round(plain_likeness(own, other), 12), round(plain_likeness(own, after), 12)))
    return sorted(rows, key=str)


def found_rows(df):
    return sorted([(*r[:5], round(r[5], 12), round(r[6], 12)) for r in df.collect()], key=str)


def query(df):
    return d.neighbours(df, d._compared, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


TEXTS = ["", None, "a", "ab", "abc", "İé日本🙂", "\x00\x00", "same words here", "same words here", "x" * 999, "lorem ipsum " * 40, "LOREM ipsum " * 40]


def test_counts_in_any_grouping(monkeypatch):
    r = random.Random(2)
    batch = [bytes(r.choices(b"abcd \xc3\xa9", k=r.randrange(60))) for _ in range(50)] + [b"", b"z" * 500]
    want = [plain_counts(t) for t in batch]
    for size in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(d, "BYTES_AT_ONCE", size)
        assert d.bucket_counts(batch).tolist() == want
    assert [d.length_code(n) for n in (0, 1, 2, 3, 4, 8, 9)] == [0, 1, 9, 13, 17, 25, 26]


def test_digest_and_difference():
    codes = d.digests([(t or "").encode() for t in TEXTS])
    for t, row, text in zip(TEXTS, codes, d.spelt(codes)):
        assert row.tolist() == plain_codes((t or "").encode())
        assert d.read(text).tolist() == row.tolist() and len(text) == 130
    for a in codes:
        gaps = d.difference(np.broadcast_to(a, codes.shape), codes)
        assert ((0 <= gaps) & (gaps <= 1)).all()
        assert np.allclose(gaps, d.difference(codes, np.broadcast_to(a, codes.shape)))
        assert all((g == 0) == (a == b).all() for g, b in zip(gaps, codes))


@pytest.mark.parametrize("rows_a_range", [1, 3, 10_000])
def test_neighbours_equal_the_plain_rows(spark, docs, monkeypatch, rows_a_range):
    monkeypatch.setattr(d, "ROWS_A_RANGE", rows_a_range)
    r = random.Random(rows_a_range)
    pairs = [(i * 3 - 20, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (None, "no id"), (50, "twice"), (50, "twice"), (50, "twice"), (60, "long word " * 40_000)]
    r.shuffle(pairs)
    assert found_rows(query(docs(pairs))) == plain_rows(pairs)


def test_few_rows(spark, docs):
    assert query(docs([]).limit(0)).count() == 0
    assert found_rows(query(docs([(5, "alone in the table")]))) == plain_rows([(5, "alone in the table")])
    many = [(7, "one row again")] * 600 + [(8, "another")]
    assert found_rows(query(docs(many))) == plain_rows(many)


def test_query_tells_edits_from_neighbours(spark, sf):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = d.op11_fingerprints(spark, sf).collect()
    assert sorted(r.doc_id for r in found) == sorted(rows)
    assert found_rows(d.op11_fingerprints(spark, sf).filter("doc_id % 20 = 0")) == [r for r in plain_rows(list(rows.items())) if r[0] % 20 == 0]
    assert sum(r.near_edited > r.near_next for r in found) > 0.97 * len(found)
    by_text = {}
    for r in found:
        assert by_text.setdefault(rows[r.doc_id], r.fingerprint) == r.fingerprint
    own = {r.doc_id: r.fingerprint for r in d.fingerprints(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    assert own == {r.doc_id: r.fingerprint for r in found}
