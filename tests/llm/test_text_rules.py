"""Personal data and main text of pages against plain Python; odd input."""

import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textrisk.llm import html_text, privacy
from textrisk.llm.queries import QUERIES

# Personal data --------------------------------------------------------------------------

# The four kinds in their plain form.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def plain_entities(text):
    out = []
    for kind, pattern in PLAIN.items():
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match[0])
            if kind == "ip" and any(int(part) > 255 for part in match[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, match.start(), match.end(), match[0]))
    return out


def plain_words(text):
    return [
        (m[0].lower(), m.start(), m.end()) for m in re.finditer(r"[^\W\d_][^\W_]*", text or "")
    ]


def plain_terms(rows, limits):
    """Per row the revealing words, by counting over all rows."""
    reach = limits.surroundings
    near, spread = [], defaultdict(set)
    for doc_id, text in rows:
        for word, *_ in plain_words(text):
            spread[word].add(doc_id)
    for doc_id, text in rows:
        words = plain_words(text)
        for kind, start, end, value in plain_entities(text):
            own = [w for w in words if start - reach <= w[1] and w[2] <= start]
            own += [w for w in words if end <= w[1] and w[2] <= end + reach]
            near.append((doc_id, f"{kind}:{value.lower()}", own))
    support, met, contexts = defaultdict(set), defaultdict(set), defaultdict(set)
    for doc_id, entity, own in near:
        surroundings = tuple(w[0] for w in own)
        contexts[entity].add(surroundings)
        for word, *_ in own:
            support[entity, word].add(surroundings)
            met[entity, word].add(doc_id)
    found = set()
    for (entity, word), settings_ in support.items():
        share = len(met[entity, word]) / len(spread[word])
        lift = (len(settings_) / len(contexts[entity])) / (len(spread[word]) / len(rows))
        if len(settings_) >= limits.support and share >= limits.share and math.log2(lift) >= limits.bits:
            found.add((entity, word))
    out = defaultdict(set)
    for doc_id, entity, own in near:
        out[doc_id].update((s, e, w) for w, s, e in own if (entity, w) in found)
    return out


def revealing_rows():
    rng = random.Random(6)
    words = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(10) for j in range(10)]
    rows = []
    for doc_id in range(300):
        text = " ".join(rng.choices(words, k=30))
        if doc_id % 25 == 0:
            text += f" Zebulon writes from zeb@mail.example.org {' '.join(rng.choices(words, k=6))}"
        if doc_id % 60 == 1:
            text = "Quentin calls +1 (988) 555-2485 daily and éa " + " ".join(rng.choices(words, k=9))
        if doc_id % 40 == 2:  # copies of one passage
            text = "same words near only@copy.example.org each time"
        rows.append((doc_id, text))
    return rows


def test_terms_equal_brute_force(spark):
    rows = revealing_rows()
    limits = privacy.Disclosure(support=3, share=0.4, bits=3.0, surroundings=40)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = {r.doc_id: r for r in privacy.find_personal_data(frame, limits).collect()}
    terms = plain_terms(rows, limits)
    assert any(terms.values())
    for doc_id, text in rows:
        assert [tuple(s) for s in found[doc_id].base] == plain_entities(text)
        assert {(s.start, s.end, s.value) for s in found[doc_id].terms} == terms.get(doc_id, set())
    assert {s.value for r in found.values() for s in r.terms} >= {"zebulon", "quentin"}
    assert not any(s.value == "same" for r in found.values() for s in r.terms)
    clean = {r.doc_id: r.text for r in privacy.sanitise(frame, limits).collect()}
    assert "Zebulon" not in clean[0] and "[TERM]" in clean[0] and "[EMAIL]" in clean[0]
    assert clean[3] == rows[3][1]


def test_revealing_words_go_wherever_they_stand(spark):
    rows = revealing_rows()
    far = " ".join(["filler"] * 20)
    rows[0] = (0, f"{rows[0][1]} {far} ZEBULON and zebulon, zebulons")
    rows += [(400, f"🙂 no address, Zebulon {far} zebulon"), (401, "zebu lon")]
    limits = privacy.Disclosure(support=3, share=0.4, bits=3.0, surroundings=40)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = {r.doc_id: r for r in privacy.find_personal_data(frame, limits).collect()}
    for doc_id, text in rows:
        places = [(s, e) for word, s, e in plain_words(text) if word == "zebulon"]
        assert [(s.start, s.end) for s in found[doc_id].terms if s.value == "zebulon"] == places
    assert len(found[0].terms) >= 3 and len(found[400].terms) == 2
    clean = {r.doc_id: r.text for r in privacy.sanitise(frame, limits).collect()}
    assert clean[400] == rows[-2][1].replace("Zebulon", "[TERM]").replace("zebulon", "[TERM]")
    assert "zebulons" in clean[0] and clean[401] == "zebu lon"


def test_repeated_rows_count_once(spark):
    rows = revealing_rows()
    limits = privacy.Disclosure(support=3, share=0.4, bits=3.0, surroundings=40)
    # All rows three times; one that merely has a revealing word many times more.
    hot = (500, "zebulon is only named here")
    terms = plain_terms([*rows, hot], limits)
    frame = spark.createDataFrame(rows * 3 + [hot] * 60, "doc_id bigint, text string").repartition(4)
    found = privacy.find_personal_data(frame, limits).collect()
    assert len(found) == 3 * len(rows) + 60
    for row in found:
        if row.doc_id != 500:
            assert {(s.start, s.end, s.value) for s in row.terms} == terms.get(row.doc_id, set())
    assert {s.value for r in found for s in r.terms} >= {"zebulon", "quentin"}
    assert privacy.sanitise(frame, limits).count() == len(found)


CHARACTERS = st.sampled_from(list("ab1 2.3@-+()45é🙂_%\n"))
HEAVY = st.lists(
    st.one_of(
        st.text(CHARACTERS, max_size=8),
        st.sampled_from(["a@b.c", "_d@e.f", "1.2.3.4", "256.1.1.1", ".5", "4041894974608795", "4111 1111 1111 1111",
                         "+1 (988) 555-2485", "0000000000000000", "-", "٣"]),
    ),
    max_size=12,
).map("".join)


@settings(max_examples=2, deadline=None)
@given(st.lists(HEAVY, min_size=60, max_size=120))
def test_entities_equal_plain_patterns(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for row in frame.select("doc_id", privacy.entities(F.col("text")).alias("found")).collect():
        assert [tuple(s) for s in row.found] == plain_entities(texts[row.doc_id])


def test_personal_data_of_odd_rows(spark):
    schema = "doc_id bigint, text string, base string, n_chars bigint, terms string"
    long = "x" * 20_000 + " a@b.cc " + "1" * 10_000 + " " + "9." * 400
    rows = [(1, None, "k", None, None), (2, "", None, 0, None), (3, "mail a@b.cc!", "k", 12, "t"),
            (3, "mail a@b.cc!", "k", 12, "t"), (None, "ip 1.2.3.4", None, None, None), (4, long, "k", len(long), None)]
    frame = spark.createDataFrame(rows, schema)
    found = privacy.find_personal_data(frame).collect()
    got = sorted((str(r.doc_id), [tuple(s) for s in r.base]) for r in found)
    assert got == sorted((str(r[0]), plain_entities(r[1])) for r in rows)
    clean = privacy.sanitise(frame)
    assert clean.columns == frame.columns
    texts = sorted((str(r.doc_id), str(r.text)[:20], r.base, r.n_chars) for r in clean.collect() if r.doc_id != 4)
    assert texts == sorted(
        [("1", "None", "k", None), ("2", "", None, 0), ("3", "mail [EMAIL]!", "k", 13),
         ("3", "mail [EMAIL]!", "k", 13), ("None", "ip [IP]", None, 7)]
    )
    empty = frame.where("false")
    assert privacy.find_personal_data(empty).count() == 0 and privacy.sanitise(empty).count() == 0


def test_overlapping_spans_become_one_placeholder(spark):
    spans = [("email", 2, 6, ""), ("card", 4, 9, ""), ("phone", 0, 1, ""), ("term", 12, 14, "")]
    frame = spark.createDataFrame(
        [("0123456789abcdef", spans)], "text string, spans array<struct<kind:string,start:int,end:int,value:string>>"
    )
    row = frame.select(privacy._replaced(F.col("text"), F.col("spans")).alias("t")).first()
    assert row.t == "[PHONE]1[EMAIL]9ab[TERM]ef"


# Main text ------------------------------------------------------------------------------


def blocks(source):
    """Text blocks and what is marked above them."""
    nodes = html_text.Nodes([html_text.parse_page(source)])
    return [text for text in nodes.text if text]


@pytest.mark.parametrize(
    "source, expected",
    [
        (None, []), ("", []), ("plain &amp; simple", ["plain & simple"]),
        ("<p>a<p>b</p>c", ["a", "b", "c"]), ("<p>a <b>b</b>\n c<br>d</p>", ["a b c d"]),
        ("<ul><li>1<li>2<ul><li>3</ul></ul>", ["1", "2", "3"]),
        ("<p><b>x<br><p>y", ["x", "y"]), ("a<!-- <p>no</p> -->b", ["ab"]), ("a<!-- open", ["a"]),
        ("<script>var t='</p>';<p></script>z<style>p{}</style>", ["z"]), ("<title>t</title><h1>h</h1>", ["h"]),
        ("<div title='a>b' class=\"x\">t</div></div></p>u", ["t", "u"]), ("1 < 2 & 3", ["1 < 2 & 3"]),
        ("x<div class=\"open", ["x"]), ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
        ("&nbsp;&eacute;&#128578;&bogus;", ["é🙂&bogus;"]), ("<p>" * 3000 + "deep", ["deep"]),
        ("<div>" * 3000 + "deep", ["deep"]),
    ],
)
def test_parse(source, expected):
    assert blocks(source) == expected


@pytest.mark.parametrize(
    "source, expected",
    [
        ("<html><head><title>t</title><meta charset=u><body><p>a</body>", ["a"]),
        ("<head><script>x</script><p>a</p></head><p>b", ["a", "b"]), ("<head>\n<link href=x>a", ["a"]),
        ("<head><a href=x>a</a><body>b", ["a", "b"]), ("<body><head><title>t</title><p>a", ["a"]),
        ("<head><title>t</title></head><body>a", ["a"]),
        ("<p>a<svg viewBox='0 0 1 1'/>b<p>c<svg><text>no</text></svg>d", ["ab", "cd"]),
        ("<p>a<svg class=\"x>y\"><title>no</title></svg >b", ["ab"]), ("<p>a<svg><path d=x>b<p>c", ["a", "b", "c"]),
        ("<svg-icon name=x></svg-icon><p>a", ["a"]), ("<template-x>a</template-x><p>b", ["a", "b"]),
        ("<style-guide/><p>a<title-bar>b</title-bar>", ["a", "b"]), ("<script>x</script foo>a", ["a"]),
        ("<p>if <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding=t>no</annotation></math> then", ["if x=2 then"]),
        ("<p>a <object data=x><param name=y>b</object> <canvas>c</canvas> d", ["a b c d"]),
    ],
)
def test_parse_keeps_text_after_open_heads_and_embedded_things(source, expected):
    assert blocks(source) == expected


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["<p>", "</p>", "<div class='ad'>", "</div>", "<b>", "<li>", "<ul>", "</ul>", "<td>", "<script>", "</script>",
     "<!--", "-->", "<", ">", "&amp;", "x", " ", "<a href=\"u\">", "</a>", "<article>", "</article>", "\"", "'", "<br"]),
    max_size=40).map("".join))
def test_decoding_never_contradicts(source):
    nodes = html_text.Nodes([html_text.parse_page(source), html_text.parse_page("<p>other")])
    features = nodes.features()
    assert features.shape == (len(nodes), len(html_text.FEATURES)) and np.isfinite(features).all()
    rng = np.random.default_rng(len(source))
    odds = rng.normal(0, 3, len(nodes))
    texts = html_text.decode(nodes, odds)
    assert len(texts) == 2
    kept = [line for text in texts for line in text.split("\n") if line]
    all_blocks = [text for text in nodes.text if text]
    assert len(kept) <= len(all_blocks) and set(kept) <= set(all_blocks)
    assert html_text.decode(nodes, np.full(len(nodes), 5.0)) == [
        "\n".join(t for t, page in zip(nodes.text, nodes.page) if t and page == own) for own in (0, 1)
    ]
    assert html_text.decode(nodes, np.full(len(nodes), -5.0)) == ["", ""]


def plain_article(source):
    body = re.search(r"<article>(.*?)(?:</article>|$)", source, re.S)[1]
    pieces = re.split(r"</?(?:p|h1)>", re.sub(r"<(?!/?(?:p|h1)>)[^>]*>", " ", body))
    import html

    return "\n".join(t for t in (" ".join(html.unescape(p).split()) for p in pieces) if t)


def test_pages_query_equals_marked_articles(spark):
    folder = "/root/testdata/sf0.01"
    found = {r.page_id: r for r in QUERIES["op3_html"](spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(found) == len(pages)
    for page in pages:
        assert found[page.page_id].text == plain_article(page.html)
        assert found[page.page_id].n_chars == len(found[page.page_id].text)


def test_trees_learn_other_layouts(spark):
    rng = random.Random(8)

    def prose(n):
        return " ".join(rng.choices(["one", "two,", "three.", "four", "five"], k=n)) + "."

    def page(i):
        parts = [f"<header><a href=x>{prose(2)}</a></header>", f"<nav><ul><li><a>{prose(1)}</a><li><a>b</a></ul></nav>"]
        parts += [f"<div class=\"cookie-notice\">{prose(8)}</div>"]
        article = f"<h1>{prose(4)}</h1>" + "".join(f"<p>{prose(rng.randint(20, 60))}</p>" for _ in range(4))
        article += f"<form><label>{prose(2)}</label><button>go</button></form>"
        parts += [f"<main>{article}<div class=\"ad\">{prose(10)}</div></main>"]
        parts += [f"<aside>{prose(9)}</aside>", f"<section id=comments><p>{prose(25)}</p></section>"]
        parts += [f"<footer>{prose(5)}</footer>"]
        return "<html><body>" + "".join(parts) + "</body></html>"

    sources = [page(i) for i in range(120)]
    frame = spark.createDataFrame(list(enumerate(sources)), "page_id bigint, html string").withColumn("url", F.lit("u"))
    frame = frame.withColumn("text", F.lit("clash"))
    trees = html_text.fit_node_trees(frame, 1000, trees=10)
    assert trees is not None
    for row in html_text.extract_text(frame, trees).collect():
        main = re.search("<main>(.*)</main>", sources[row.page_id])[1]
        expected = re.findall("<h1>(.*?)</h1>|<p>(.*?)</p>", main)
        assert row.text.split("\n") == [a or b for a, b in expected]


def test_pages_without_anything_to_learn(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<nav>x</nav><p>y</p>"), (3, "u", "<p>" + "z" * 300_000),
            (3, "u", "<p>" + "z" * 300_000)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert html_text.fit_node_trees(frame) is None
    got = sorted((str(r.page_id), r.n_chars) for r in html_text.extract_text(frame, None).collect())
    assert got == [("1", 0), ("2", 0), ("3", 300_000), ("3", 300_000), ("None", 1)]
    empty = frame.where("false")
    assert html_text.fit_node_trees(empty) is None and html_text.extract_text(empty, None).count() == 0
