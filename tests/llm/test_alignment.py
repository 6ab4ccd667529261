import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from promptmill.llm import alignment as al

A, B = al.default_models()
OWN = al.Tokenizers(A, B)
LIBRARY_A = Tokenizer.from_file(A)
LIBRARY_A.encode_special_tokens = True
LIBRARY_B = sentencepiece.SentencePieceProcessor(model_file=B)


def strings(n, seed=8):
    r = random.Random(seed)
    parts = [" ", "  ", " " * 17, "\n", "\n\n", "\t", "\r", "\r\n", "▁", "the", "There", "ing", "é", "e\u0301", "日本", "🙂", "İ", "</s>", "<0x0A>", "<unk>", "<|endoftext|>", "a", "b",
             "\x00", "\x1c", "\x1f", "\x85", "\xa0", "\u2009", "\u200b", "\u3000", "\ufeff", "\u180e", "\u2028", "ﬁ", "!!", "12", "'s", "it's", "x-y", ";\r", "))", "\u0307"]
    return ["", " ", "\n", "\n\n a", *["".join(r.choices(parts, k=r.randrange(14))) for _ in range(n)]]


def plain_tokens(text):
    """Ids and bytes of A and B from whole texts, by the definitions."""
    if not text:
        return [], [], [], []
    a, b = LIBRARY_A.encode(" " + text, add_special_tokens=False), LIBRARY_B.encode(text)
    letters = al.byte_letters()
    bytes_a = [bytes(letters[c] for c in LIBRARY_A.id_to_token(i)) for i in a.ids]
    names = [LIBRARY_B.id_to_piece(i) for i in b]
    bytes_b = [bytes([int(p[3:-1], 16)]) if LIBRARY_B.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, names)]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return [], [], [], []
    return a.ids, bytes_a, b, bytes_b


def plain_row(text):
    """n_a, n_b, n_groups, groups as text, and all links, by comparing every pair of ranges."""
    a, bytes_a, b, bytes_b = plain_tokens(text)
    ends_a, ends_b = np.cumsum([len(t) for t in bytes_a]).tolist(), np.cumsum([len(t) for t in bytes_b]).tolist()
    both, groups, i, j = sorted(set(ends_a) & set(ends_b)), [], 0, 0
    for end in both:
        i2, j2 = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
        i, j = i2, j2
    links = []
    for x, (s1, e1) in enumerate(zip([0, *ends_a], ends_a)):
        links += [(a[x], b[y]) for y, (s2, e2) in enumerate(zip([0, *ends_b], ends_b)) if s1 < e2 and s2 < e1]
    return len(a), len(b), len(groups), ";".join(groups), links


def plain(rows):
    """The query's rows from (doc_id, text)."""
    own = [(i, plain_row(t or "")) for i, t in rows]
    count = Counter(p for _, r in own for p in set(r[4]))
    best = {}
    for (x, _), n in count.items():
        best[x] = max(best.get(x, 0), n)
    return sorted([(i, a, b, g, len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(told.encode()).hexdigest() if a else "") for i, (a, b, g, told, links) in own], key=str)


def found(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("stretch", [1, 2, 7, 32, 1000])
def test_gallop_equals_a_plain_search(stretch):
    r = random.Random(stretch)
    for _ in range(60):
        long = np.array(sorted(r.sample(range(500), r.randrange(1, 200))))
        short = np.array(sorted(r.sample(range(520), r.randrange(1, 120))))
        assert al.gallop(short, long, stretch).tolist() == np.searchsorted(long, short).tolist()


def test_words_give_the_tokens_of_whole_texts():
    assert OWN.cuts
    batch = strings(4000)
    kept = 0
    for t, (a, b) in zip(batch, OWN.batch(batch)):
        want_a, _, want_b, _ = plain_tokens(t)
        kept += bool(want_a)
        assert np.frombuffer(a, "<i4").tolist() == want_a and np.frombuffer(b, "<i4").tolist() == want_b, repr(t)
    assert kept > 1500


def test_results_do_not_depend_on_the_words_kept(monkeypatch):
    batch = strings(300, 5)
    want = OWN.batch(batch)
    monkeypatch.setattr(al, "WORDS_KEPT", 20)
    monkeypatch.setattr(al, "LONGEST_KEPT", 3)
    few = al.Tokenizers(A, B)
    assert [x for t in range(0, len(batch), 7) for x in few.batch(batch[t:t + 7])] == want
    monkeypatch.setattr(few, "cuts", False)
    monkeypatch.setattr(few, "words", {})
    monkeypatch.setattr(few, "before", {})
    assert few.batch(batch) == want


def test_sections_equal_the_whole():
    r = random.Random(4)
    for t in ["many words of text, it's long\n " * 40, "x" * 300, " ".join(strings(60, 3)), "odd ▁ " + "word " * 50, "a  b \n c\t d\r\ne " * 30]:
        (whole,), _, codes, links = al.align_texts(OWN, [t], 10 ** 9)
        for chars in (1, 5, 17, 100, r.randrange(200)):
            (cut,), text, more, n = al.align_texts(OWN, [t], chars)
            assert cut == whole and more.tolist() == codes.tolist() and n.tolist() == links.tolist() and not text.any()


@pytest.mark.parametrize("tuning", [{}, {"slice_pairs": 40, "held_pairs": 30}, {"slice_pairs": 1000, "held_pairs": 1}])
def test_rows_equal_the_plain_rows(spark, docs, tuning):
    rows = [(i, t) for i, t in enumerate(strings(150, 6))] + [(None, "x y"), (7, None), (7, "twice here"), (7, "twice here"), (8, "long word " * 300)]
    assert found(al.aligned(docs(rows), **tuning)) == plain(rows)


def test_few_rows(spark, docs):
    assert al.aligned(docs([]).limit(0)).count() == 0
    rows = [(1, None), (2, ""), (3, "▁")]
    assert found(al.aligned(docs(rows))) == plain(rows) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if len(r.text) < 3000]
    assert found(al.aligned(spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) < 3000"))) == plain(rows)
    assert al.op13_alignment(spark, sf).count() == spark.read.parquet(f"{sf}/documents.parquet").count()
