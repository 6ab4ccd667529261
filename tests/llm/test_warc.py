import gzip
import hashlib
import random
import time

from promptmill.llm import warc


def content(i, n=300):
    return (f"<p>page {i}</p>é" * n).encode()


def members(n=6):
    made = []
    for i in range(n):
        body = content(i)
        made.append(gzip.compress(warc.record(i, f"http://x/{i}", body, hashlib.sha256(body).hexdigest(), None), mtime=0))
    return made


def good(data):
    return [f["page_id"] for f, *_ in warc.records(data) if f]


def gaps(data):
    return [(a, b) for f, a, b, _ in warc.records(data) if f is None]


def test_reads_on_after_damage():
    whole = members()
    data = warc.EMPTY_MEMBER.join(whole)
    assert good(data) == list(range(6)) and gaps(data) == []
    r = random.Random(2)
    for _ in range(60):
        hit = sorted(r.sample(range(6), r.choice([1, 2])))
        broken = []
        for i, m in enumerate(whole):
            if i in hit:
                m = bytearray(m)
                how = r.randrange(3)
                if how == 0:
                    m[r.randrange(12, len(m))] ^= 1 << r.randrange(8)
                elif how == 1:
                    m = m[:r.randrange(1, len(m) - 9)]
                else:
                    m = bytes(r.randrange(256) for _ in range(50))
            broken.append(bytes(m))
        data = b"".join(broken)
        assert good(data) == [i for i in range(6) if i not in hit]
        covered = sum(b - a for a, b in gaps(data))
        assert covered == sum(len(broken[i]) for i in hit)


def test_plain_records_and_false_starts():
    one = [gzip.decompress(m) for m in members(4)]
    data = one[0] + b"WARC/1.1 not a record\r\n\r\n" + one[1][:-9] + one[2] + b"junk" + warc.MEMBER + one[3]
    assert good(data) == [0, 2, 3]
    lengths = [data.index(b"WARC/1.1 not"), data.index(one[2]), data.index(b"junk"), data.index(one[3])]
    assert gaps(data) == [(lengths[0], lengths[1]), (lengths[2], lengths[3])]
    assert good(b"") == [] and gaps(b"abc") == [(0, 3)]
    payload = b"x" * 500 + b"WARC/1.1\r\n" + warc.MEMBER
    inside = warc.record(9, None, payload, hashlib.sha256(payload).hexdigest(), None)
    assert good(inside * 2) == [9, 9]


def test_round_trip(spark, tmp_path):
    rows = [(i, f"http://h/{i}?q=ä b", content(i % 4, 20).decode()) for i in range(40)]
    rows += [(50, "u", None), (51, None, ""), (52, "u", "short"), (53, "u", "short"), (0, "again", rows[0][2]), (None, "u", rows[1][2]), (None, "u", "z" * 200),
             (60, "u", "w" * 3_000_000)]
    pages = spark.createDataFrame([(i, u, h, "mine") for i, u, h in rows], "page_id long, url string, html string, digest string").repartition(3)
    warc.write(pages, str(tmp_path / "w"))
    found = warc.read(spark, str(tmp_path / "w")).collect()
    assert len(found) == len(rows) and not any(r.reason for r in found)
    least = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= 100 and i is not None:
            least[h] = min(least.get(h, i), i)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        to = least.get(h) if least.get(h) != i else None
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if to is None else "revisit", to, b if to is None else None))
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) if r.payload != b"" else b"") for r in found], key=str) \
        == sorted(want, key=str)
    for name in (tmp_path / "w").glob("part-*"):
        assert gzip.decompress(name.read_bytes()).startswith(b"WARC/1.1")
    warc.write(pages.limit(0), str(tmp_path / "none"))
    assert warc.read(spark, str(tmp_path / "none")).count() == 0


def test_gaps_are_logged(spark, tmp_path):
    whole = members(3)
    (tmp_path / "part-0").write_bytes(whole[0] + whole[1][:-20] + whole[2])
    rows = warc.read(spark, str(tmp_path)).collect()
    assert [r.page_id for r in rows if not r.reason] == [0, 2]
    gap = next(r for r in rows if r.reason)
    assert (gap.start, gap.end) == (len(whole[0]), len(whole[0]) + len(whole[1]) - 20)


def test_damage_takes_linear_time():
    good = gzip.compress(warc.record(5, "u", b"x" * 200, hashlib.sha256(b"x" * 200).hexdigest(), None), mtime=0)
    for junk in (b"WARC/1.1\r\n" * 800_000, b"WARC/1." * 400_000, b"WARC/1.1\r\nA: b\r\n" * 200_000, b"A: WARC/1.1\r\n" * 20_000, b"\x1f\x8b\x08" * 300_000,
                 b"WARC/1.1\r\nContent-Length: 99999999\r\n\r\n" * 60_000):
        start = time.process_time()
        found = list(warc.records(junk + good))
        assert time.process_time() - start < 15
        assert found[-1][0]["page_id"] == 5 and all(f is None for f, *_ in found[:-1]) and found[0][1:3] == (0, len(junk))


def test_files_are_cut_by_bytes(spark, tmp_path):
    rows = [(k, f"u{k}", str(k) * (3000 if k % 9 else 300_000)) for k in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    warc.write(pages, str(tmp_path / "w"), row_bytes=2000, rows_a_file=4)
    names = [f for f in (tmp_path / "w").iterdir() if f.name.startswith("part-")]
    assert len(names) > 5
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read(spark, str(tmp_path / "w")).filter("record_type = 'response'").collect()}
    assert all(got[k] == html for k, _, html in rows)
