import io
import random
import struct
import zlib

import numpy as np
import pytest
import xxhash
import zstandard

from promptmill.llm import tokenfiles as t

LIBRARY = t.Encoder(t.default_model(), 1).library


def ids(text):
    return np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()


def text_hash(text):
    """XXH64 with seed 42, signed."""
    return (xxhash.xxh64_intdigest(text.encode(), 42) ^ 1 << 63) - (1 << 63)


def strings(n):
    r = random.Random(3)
    parts = [" ", "\n\t", " ", "\x1c", "\x85", "the", "Thntion's", "'s", "É", "é", "ΣΑΣ", "日本", "🙂", "<|endoftext|>", "<|ENDOFTEXT|>", "J\u030c", "H\u0331", "I\u0307", "e", "\u0301", "_", "Aa", "$$$", ".", ",", "12", "!?", "a", "İ", "i", "ß", "Ⅷ", "ſ", "K", "ǰ", "x" * 70, "aGVsbG8" * 11, " ", "​"]
    return ["".join(r.choices(parts, k=r.randrange(12))) for _ in range(n)]


def test_word_by_word_equals_the_library():
    own = t.Encoder(t.default_model(), 1)
    batch = strings(4000) + ["", " ", "x" * 3000, "İ!", "İ,", "DİYARBAKİ,", "İİ ... İ. i̇!", "a\x1c! b\x7f? \x00.", "Σ! ΑΣ, ΑΣ", "Ⅷ! ½. x²,", "aÅ!", "\u1e9e!"]
    assert own.batch(batch) == [ids(x) for x in batch]
    assert not any(len(w) > t.LONGEST_KEPT for w in own.units)


def test_results_do_not_depend_on_batches(monkeypatch):
    monkeypatch.setattr(t, "UNITS_KEPT", 30)
    monkeypatch.setattr(t, "LONGEST_KEPT", 4)
    batch = strings(400) + ["DİYARBAKİ, İ!"] * 3
    want = [ids(x) for x in batch]
    for size in (1, 3, 64, 1000):
        own = t.Encoder(t.default_model(), 1)
        assert [x for k in range(0, len(batch), size) for x in own.batch(batch[k:k + size])] == want


def file_of(data):
    press = zstandard.ZstdCompressor()
    return t.pack([(i, press.compress(x), len(x), xxhash.xxh64_intdigest(x) & 0xFFFFFFFF) for i, x in data], (2, 5))


def test_file_reads_only_what_is_asked_for_and_sees_damage():
    data = [(i if i else None, struct.pack(f"<{i + 1}I", *range(i + 1))) for i in range(30)]
    raw = file_of(data)
    file = t.TokenFile(io.BytesIO(raw))
    assert file.place == (2, 5) and file.doc_ids == [i for i, _ in data]
    assert [file.ids(k) for k in range(30)] == [x for _, x in data]
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert whole == b"".join(x for _, x in data)
    start, size = int(file.starts[7]), int(file.table[7, 0])
    hurt = bytearray(raw)
    hurt[start:start + size] = bytes(size)
    file = t.TokenFile(io.BytesIO(bytes(hurt)))
    assert file.ids(8) == data[8][1]
    with pytest.raises(ValueError):
        file.ids(7)
    for bad in (b"", raw[:-1], raw[5:], raw[:20]):
        with pytest.raises(ValueError):
            t.TokenFile(io.BytesIO(bad))


def test_round_trip(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(t, "ROWS_A_RANGE", 40)
    rows = [(7 * i - 300, x) for i, x in enumerate(strings(300))]
    rows += [(None, "first of all"), (0, None), (5, "b c"), (5, "b c"), (5, "again other words"), (9, "long " * 200_000)]
    t.write(docs(rows), str(tmp_path / "t"), file_bytes=300)
    found = t.positions(t.read(spark, str(tmp_path / "t"))).collect()
    assert len({(r.range, r.number) for r in found}) > 10
    want, at = [], 0
    for i, x in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, text_hash(x[1] or ""))):
        own = ids(x)
        want.append((i, at, len(own) // 4, own))
        at += len(own) // 4
    assert sorted([(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in found], key=lambda x: x[1]) == want
    some = t.read(spark, str(tmp_path / "t"), [5, 9]).collect()
    assert sorted(r.doc_id for r in some) == [5, 5, 5, 9]
    t.write(docs([]).limit(0), str(tmp_path / "none"))
    assert t.positions(t.read(spark, str(tmp_path / "none"))).count() == 0


def test_query(spark, sf):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    at, want = 0, []
    for i, x in rows:
        own = ids(x)
        want.append((i, at, len(own) // 4, zlib.crc32(own)))
        at += len(own) // 4
    assert sorted(tuple(r) for r in t.op9_tokenfiles(spark, sf).collect()) == want
