import hashlib
import random

import sentencepiece

from promptmill.llm import pieces as p

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=p.default_model())


def strings(n=1500):
    r = random.Random(8)
    parts = [" ", "  ", " " * 17, "\n", "\t", "▁", "the", "There", "ing", "é", "日本", "🙂", "</s>", "<0x0A>", "<unk>", "a", "b", "\x00", "​", " ", "ﬁ", "!!", "12", "\r"]
    return ["", " ", "\n", "\n\n a", *["".join(r.choices(parts, k=r.randrange(14))) for _ in range(n)]]


def test_encode_and_decode_equal_the_library():
    own = p.Pieces(p.default_model())
    assert own.plain
    for t in strings():
        ids = LIBRARY.encode(t, add_eos=True)
        assert own.encode(t) == ids, t
        assert own.decode(ids) == LIBRARY.decode(ids), t
    r = random.Random(9)
    for _ in range(500):
        ids = [r.randrange(len(LIBRARY)) if r.random() < 0.6 else r.randrange(3, 259) for _ in range(r.randrange(8))]
        if own.unknown not in ids and not (ids and own.text[ids[0]] == " "):
            assert own.decode(ids) == LIBRARY.decode(ids), ids


def test_whole_text_agenda_and_long_texts():
    own = p.Pieces(p.default_model())
    text = "Was thntherti " * 3000 + "x" * 20_000
    assert own.merge(own._spaced(text)) + [own.end] == LIBRARY.encode(text, add_eos=True)


def test_operator(spark, docs, monkeypatch):
    monkeypatch.setattr(p, "WORDS_KEPT", 50)
    rows = [(i, t) for i, t in enumerate(strings(300))] + [(None, "x y"), (7, None), (7, "twice"), (7, "twice"), (8, "long word " * 50_000)]
    found = p.encoded(docs(rows)).collect()
    want = sorted([(i, LIBRARY.encode(t or "", add_eos=True), LIBRARY.decode(LIBRARY.encode(t or ""))) for i, t in rows], key=str)
    assert sorted([(r.doc_id, list(r.ids), r.decoded) for r in found], key=str) == want
    assert sum(r.repaired for r in found) == 0
    assert p.encoded(docs([]).limit(0)).count() == 0


def test_query(spark, sf):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in p.op3_pieces(spark, sf).collect():
        ids = LIBRARY.encode(rows[r.doc_id], add_eos=True)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
