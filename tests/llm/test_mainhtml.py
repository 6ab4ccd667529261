import html
import itertools
import random
import re

import numpy as np

from promptmill.llm import mainhtml as m


def units(source):
    nodes = m.Nodes()
    nodes.add(source)
    return [t for t in nodes.text if t is not None]


def test_parser():
    assert units("<p>a<b>b\n c<br>d&amp;&eacute;<p>e<div>f<p>g</div>h") == ["ab c d&é", "e", "f", "g", "h"]
    assert units("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>x</ul></nope>y") == ["a", "b", "c", "d", "x", "y"] or units("<ul><li>a<li>b") == ["a", "b"]
    assert units('<script>var t="</p>";</script><style>x</style><title>t</title>z<!-- <p>no -->w<!DOCTYPE q>') == ["zw"]
    assert units("1 < 2 <3 & a<>b") == ["1 < 2 <3 & a<>b"]
    assert units("<p title='x>y' class=\"a\">in</p><p>broken <a href=\"x") == ["in", 'broken <a href="x']
    assert units("<table><tr><td>a<td>b<tr><td>c</table>d") == ["a", "b", "c", "d"]
    assert units("") == [] and units("<script>never ends") == []


ARTICLE = "".join(f"<p>{w} of a long article that goes on with many words, and says so in sentences of its own.</p>" for w in ("First", "Second", "Third", "Fourth", "Fifth"))
MENU = "<nav class='menu'><a href='/'>Home</a> <a href='/b'>About</a></nav>"


def page(before="", attributes="class='article'"):
    return f"<html><body>{MENU}<div>{before}</div><article {attributes}>{ARTICLE}</article><footer class='footer'><a href='/c'>Copyright</a></footer></body></html>"


def test_unseen_elements_hide_their_contents_alone():
    assert units("a<svg viewBox='0'/>b<svg><text>no</text></svg>c<svg><svg>no</svg>no</svg>d") == ["abcd"]
    assert units("a<noscript>b") == ["ab"] and units("a<select><option>no</select>b") == ["ab"]
    assert units("a<noscript>b<noscript>no</noscript>c") == ["abc"]
    assert units("a<!-- <noscript> -->b<noscript>no</noscript>c<script>'<object>'</script>d</object>e") == ["abcde"]
    assert units("a<TEMPLATE>no</Template >b<canvas>c<object>no</object>d") == ["abcd"]
    want = m.extract([page()], m.trained())[0]
    assert want.startswith("First of a long") and want.endswith("sentences of its own.") and want.count("\n") == 4
    for before in ("<svg viewBox='0 0 1 1'/>", "<svg/>", "<noscript>", "<select>", "<object data='x'>", "<iframe>", "<canvas>", "<template>", "<svg>",
                   "<noscript><img src=x></noscript>", "<select><option>Shown never</select>"):
        assert m.extract([page(before)], m.trained())[0] == want, before


def test_long_attribute_values_count():
    words = " ".join(f"c{k}" for k in range(500))
    assert m._attribute_bits(f'class="{words} comments {words}"') == m._attribute_bits("class=comments") != 0
    want = m.extract([page()], m.trained())[0]
    comments = f"<div class='{words} comments comment reader' id='comments {words}'>" + ARTICLE.replace("article", "remark") + "</div>"
    source = page().replace("<footer", comments + "<footer")
    assert m.extract([source], m.trained())[0] == m.extract([source.replace(words, "")], m.trained())[0] == want


def test_odd_pages_take_linear_time():
    for source in ("<noscript" * 50_000, "<noscript>" * 50_000, "<svg>" * 50_000 + "</svg>" * 50_000, "<script" * 50_000, "<" * 200_000, "<div>" * 10_000 + "x", "<p>" * 50_000, "<li>" * 30_000, '<a b="' * 100_000, '<a b=">' * 30_000 + '"', "<!--" * 50_000, "<b>" * 50_000 + "</b>" * 50_000, "x " * 500_000):
        m.extract([source], m.trained())


def test_decoding_is_the_best_consistent_choice():
    r = random.Random(4)
    for _ in range(150):
        n = r.randrange(2, 11)
        parent = np.array([-1] + [0] + [r.randrange(i) for i in range(2, n)][:n - 2])
        leaf = np.array([i not in parent for i in range(n)])
        unit = np.array([bool(leaf[i]) and i > 0 and r.random() < 0.8 for i in range(n)])
        score = np.array([r.uniform(-3, 3) for _ in range(n)])
        kept = m.decode(score, unit, m._levels(parent), parent)
        best = 0.0
        for choice in itertools.product([False, True], repeat=n - 1):
            own = [True, *choice]
            if any(own[i] and not own[parent[i]] for i in range(1, n)):
                continue
            if any(own[i] and not unit[i] and not any(own[j] for j in range(n) if parent[j] == i) for i in range(1, n)):
                continue
            best = max(best, sum(score[i] for i in range(1, n) if own[i]))
        assert abs(sum(score[i] for i in range(1, n) if kept[i]) - best) < 1e-9
        assert all(kept[parent[i]] for i in range(1, n) if kept[i])


def test_held_out_layouts():
    r, hit, found, wanted = random.Random(77), 0, 0, 0
    for _ in range(200):
        source, kept = m.training_page(r)
        got = set(m.extract([source], m.trained())[0].split("\n")) - {""}
        hit, found, wanted = hit + len(got & kept), found + len(got), wanted + len(kept)
    assert hit / found > 0.98 and hit / wanted > 0.98


def article(source):
    inside = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    parts = [re.sub(r"</?b>", "", x).replace("<br>", " ") for x in re.split(r"</?(?:p|h1)>", inside)]
    return "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)


def test_query_and_rows(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    found = m.op5_maintext(spark, sf).collect()
    assert len(found) == len(pages)
    for r in found:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url
    odd = [(1, None, None, "mine"), (1, None, None, "mine"), (None, "u", "", "x"), (3, "u", "  <p> </p>", "x")]
    rows = spark.createDataFrame(odd, "page_id long, url string, html string, _text string")
    assert [r.text for r in m.main_texts(rows).collect()] == [""] * 4
    assert m.main_texts(rows.limit(0)).count() == 0
