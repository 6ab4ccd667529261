import random

from promptmill.llm import decontaminate as d


def material(seed=5):
    r = random.Random(seed)
    words = ["the", "of", "and", "to"] * 40 + [f"word{i}" for i in range(500)]
    items = [(i, " ".join(r.choices(words, k=n))) for i, n in enumerate([3, 5, 7, 12, 31, 32, 33, 64, 65, 90, 300, 40, 41, 42])]
    items += [(100, None), (101, ""), (11, items[11][1])]
    docs = []
    for i in range(120):
        own = r.choices(words, k=r.choice([0, 1, 4, 50, 700]))
        for _ in range(r.choice([0, 0, 1, 2])):
            text = r.choice(items[:14])[1].split()
            if r.random() < 0.4:
                for _ in range(len(text) // 20):
                    text[r.randrange(len(text))] = "changed"
            at = r.randrange(len(own) + 1)
            own[at:at] = text
        docs.append((i, ", ".join(own).title()))
    return items, docs + [(500, None), (3, docs[3][1])]


def brute(items, docs):
    out = []
    for i, t in docs:
        own = d.words(t or "")
        for k, x in items:
            parts = [d.shingles(p) for p in d.question_answer(d.words(x or ""))]
            if not parts[0]:
                continue
            grams = {tuple(own[a:a + n]) for n in range(1, 6) for a in range(len(own) - n + 1)}
            share = [len(p & grams) / len(p) for p in parts]
            if min(share) >= 0.8:
                out.append((i, k, round(share[0], 6), round(share[1], 6)))
    return sorted(out)


def test_against_brute_force(spark, docs, monkeypatch):
    items, texts = material()
    bench = spark.createDataFrame([(k, x, "mine") for k, x in items], "item_id long, text string, item string")
    want = brute(items, texts)
    assert len(want) > 20
    for chars in (d.SHARD_CHARS, 1500):  # one index, then several
        monkeypatch.setattr(d, "SHARD_CHARS", chars)
        found = d.contaminated(docs(texts), bench).collect()
        assert sorted((r.doc_id, r.item_id, round(r.question_overlap, 6), round(r.answer_overlap, 6)) for r in found) == want
    assert d.contaminated(docs([]).limit(0), bench).count() == 0
    assert d.contaminated(docs([(1, "the of and to"), (2, "not one of them")]), bench).filter("doc_id = 2").count() == 0
    assert d.contaminated(docs(texts), bench.limit(0)).count() == 0


def test_wand_gives_every_segment_above_the_threshold():
    r = random.Random(1)
    items = [(i, [f"w{min(199, int(r.expovariate(0.03)))}" for _ in range(r.choice([4, 10, 30, 70]))]) for i in range(200)]
    df, n, size = {}, 0, 0
    for _, own in items:
        for piece in d.segments(own):
            n, size = n + 1, size + len(piece)
            for w in set(piece):
                df[w] = df.get(w, 0) + 1
    index = d.Index(items, df, n, size / n)
    for threshold in (0.1, 0.3, 0.6):
        for _ in range(40):
            terms = sorted(r.sample(range(len(index.term)), 30))
            score = [0.0] * len(index.item)
            for t in terms:
                for s, x in zip(index.where[t], index.weight[t]):
                    score[s] += x
            want = [s for s, x in enumerate(score) if x >= threshold]
            assert [s for s, _ in index.wand(terms, threshold)] == want


def test_stage_leaves_clean_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = d.stage(spark, docs, sf)
    bad = {r.doc_id for r in d.op10_decontaminate(spark, sf).collect()}
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.collect()} - bad


def test_question_and_answer_apart(spark, docs):
    r = random.Random(9)
    common = ["the", "of", "and", "to"] * 5 + [f"word{i}" for i in range(50)]
    other = [f"other{i}" for i in range(50)]
    items = [(i, r.choices(common, k=n - k) + [f"rare{i}x{j}" for j in range(k)])
             for i, (n, k) in enumerate([(10, 0), (10, 5), (12, 0), (12, 5), (20, 0), (20, 5), (32, 8), (32, 0), (60, 15), (200, 50)])]
    items.append((50, ["a", "b", "c", "d", "e"] * 12))  # its shingles repeat
    texts = []
    for i, own in items:
        parts = d.question_answer(own)
        for apart in (0, 200):
            texts.append((len(texts), " ".join([*parts[1], *r.choices(other, k=apart), *parts[0]])))
        # every shingle of its own, far from the others
        texts.append((len(texts), " ".join(w for p in parts for s in sorted(d.shingles(p)) for w in [*s, *r.choices(other, k=70)])))
    items = [(i, " ".join(own)) for i, own in items]
    want = brute(items, texts)
    assert {(n, i) for i, _ in items[:10] for n in range(3 * i, 3 * i + 3)} <= {(n, i) for n, i, *_ in want}
    found = d.contaminated(docs(texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((x.doc_id, x.item_id, round(x.question_overlap, 6), round(x.answer_overlap, 6)) for x in found) == want
