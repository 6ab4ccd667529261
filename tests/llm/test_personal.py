import hashlib
import random
import re
from collections import Counter

from promptmill.llm import personal as p

FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def slow_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def slow(text):
    out = []
    for k, (kind, form) in enumerate(FORMS.items()):
        for m in re.finditer(form, text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False,
                  "card": 13 <= len(digits) <= 19 and slow_luhn(digits or "0"), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((k, *m.span()))
    return out


def test_fixed_forms_against_plain_patterns():
    r = random.Random(4)
    parts = ["a", "B.c", "@", "@x.org", "x@y.z", ".", "-", " ", "  ", "+", "+49", "(030)", "1", "12", "255", "256", "0255", "1.2.3.4", "é", "４", "\n",
             "4111 1111-1111 1111", "4111111111111111", "378282246310005", "+1 (279) 555-0024", "%", "_", "@@", "a@b", "000000000000000000000"]
    for _ in range(6000):
        text = "".join(r.choices(parts, k=r.randrange(12)))
        assert p.base_spans(text) == slow(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000 + " @", "1" * 300_000 + ".", "1." * 100_000, "+" * 100_000, "1 " * 100_000, "+1 " * 100_000):
        p.base_spans(text)
        p.identifiers(text, [])


def planted():
    r = random.Random(6)
    words = [f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz"]

    def text(middle):
        return " ".join([*r.choices(words, k=r.randrange(3, 30)), middle, *r.choices(words, k=r.randrange(3, 30))])

    rows = [(i, text(f"please mail {r.choice(words)}{i}@example.org")) for i in range(30)]
    rows += [(100 + i, text(f"my number is +1 (279) 555-{1000 + i}")) for i in range(30)]
    rows += [(200, text("number is 030-5551234")), (201, text("please mail user-77412")), (202, text("in the year 1987 there")), (203, text("wa 5512345"))]
    rows += [(i, text("wa wb wc")) for i in range(300, 340)]
    return rows


def plain_patterns(texts):
    """Patterns that hold at the fixpoint, by rounds over all mentions in memory: words -> (confidence, support)."""
    edges, kinds, total = Counter(), {}, Counter()
    seeds = {}
    for t in texts:
        t = t or ""
        base = p.base_spans(t)
        for s, e, seed in [(s, e, True) for _, s, e in base] + [(s, e, False) for s, e in p.identifiers(t, base)]:
            for words, _ in p.contexts(t, s):
                edges[words, t[s:e].lower()] += 1
                seeds[t[s:e].lower()] = max(seeds.get(t[s:e].lower(), 0), float(seed))
        own = [p._masked(w) for w in t.split()]
        total.update(own[:-1])
        total.update(" ".join(own[k:k + 2]) for k in range(len(own) - 2))
    for (words, _), n in edges.items():
        kinds.setdefault(words, [0, 0])
        kinds[words][0] += 1
        kinds[words][1] += n
    score, before = dict(seeds), None
    while score != before:
        before, rated = dict(score), {}
        for words, (different, seen) in kinds.items():
            if different >= p.SUPPORT:
                mine = [(i, n) for (w, i), n in edges.items() if w == words]
                rated[words] = (sum(before[i] * n for i, n in mine) / max(seen, total[words]), sum(before[i] >= p.CONFIDENCE for i, _ in mine))
        for (words, i), _ in edges.items():
            if words in rated and rated[words][1] >= p.SUPPORT:
                score[i] = max(score[i], int(rated[words][0] * p.STEPS) / p.STEPS)
    return {w: (round(c, 9), n) for w, (c, n) in rated.items() if n >= p.SUPPORT and c >= p.CONFIDENCE}


def chain(hops):
    """Pattern k is known only by the mentions that pattern k - 1 accepts."""
    rows = [f"so mail k0 u{i}x@example.org now" for i in range(5)]
    for k in range(hops):
        rows += [f"we say k{'abcdefghij'[k]} ID{k}-{n}77 and go" for n in range(4)]
        rows += [f"then c{'abcdefghij'[k + 1]} k{'abcdefghij'[k + 1]} ID{k}-{n}77 too" for n in range(4)]
    rows += [f"we say ka u{i}x@example.org and go" for i in range(9)]
    return rows


def test_patterns_equal_the_plain_version(spark, docs):
    r = random.Random(11)
    tables = [chain(6), ["call 123 45 6789 now", "call a@b.cd now", "call c@d.ef now", "call e@f.gh now", "call 99 8 then"]]
    for _ in range(3):
        words = ["call", "mail", "id", "no", "ref", "x", "y"]
        things = [f"u{i}@ex.org" for i in range(6)] + [f"A{i}{i}B-{i}" for i in range(12)] + ["1987", "12", "123 45 6789"]
        tables.append([" ".join(r.choice(words if r.random() < 0.6 else things) for _ in range(r.randrange(2, 14))) for _ in range(120)])
    for texts in tables:
        table = docs(list(enumerate(texts)))
        strong = p.strong_patterns(table, "text", p.materialise(p.mentions(table, "doc_id", "text"), "m"))
        assert {x.pattern: (round(x.confidence, 9), x.support) for x in strong.collect()} == plain_patterns(texts)
    found = plain_patterns(chain(6))
    assert {f"k{c}" for c in "abcdefg"} <= set(found)


def test_identifiers_over_digit_groups():
    def spans(text):
        return [text[a:b] for a, b in p.identifiers(text, p.base_spans(text))]
    assert spans("nr 123 45 6789, then 12 or 1 2") == ["123 45 6789"] and spans("in 1987, 2004 (55 55) a12 3456") == ["1987", "2004", "55 55", "3456"]
    assert spans("12  34 12\n34") == ["34 12"] and spans("1.2.3.4 5678 9 x1y2") == ["5678 9", "x1y2"] and spans("12\t345") == []


def test_contexts_find_unseen_identifiers(spark, docs):
    rows = planted() + [(400, None), (401, ""), (None, "mail a@b.cd"), (0, planted()[0][1])]
    found = p.personal_data(docs(rows)).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    text = dict(rows)
    for i, (t, r) in [(i, (text[i], by[i])) for i in text]:
        assert [tuple(s) for s in r.base] == slow(t)
    assert [text[i][s.start:s.end] for i in (200, 201) for s in by[i].more] == ["030-5551234", "user-77412"]
    assert not any(by[i].more for i in (202, 203, 400, 401, *range(300, 340)))
    assert p.personal_data(docs([]).limit(0)).count() == 0


def test_stage_redacts(spark, docs, sf):
    rows = planted()
    left = {r.doc_id: r for r in p.stage(spark, docs(rows + [(7, "x"), (7, None), (None, "at a@b.cd now")]), sf).collect() if r.doc_id != 7}
    assert "[OTHER]" in left[200].text and "030" not in left[200].text and "[EMAIL]" in left[0].text and "@" not in left[0].text
    assert left[None].text == "at [EMAIL] now" and left[None].n_chars == len(left[None].text)
    assert left[300].text == dict(rows)[300]
    assert p.redact("ab12cd", [(0, 1, 3), (1, 2, 5)]) == "a[EMAIL]d"


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in p.op8_personal(spark, sf).collect():
        base = slow(texts[r.doc_id])
        listed = ",".join(f"{p.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and r.spans.startswith(listed)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x[0] == k for x in base) for k in range(4))
