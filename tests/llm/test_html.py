"""Main text of pages: templates with known articles, the region against all regions, odd mark-up, the registered table."""

import html
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tesserine.llm import html_text
from tesserine.llm.entries import QUERIES
from tesserine.llm.html_text import blocks, fit_weights, main_text, parse, prior_weights

WORDS = "the of and river stone walks under light every quiet morning people bring water from old wells near town".split()


def sentence(r, n=None):
    return " ".join(r.choices(WORDS, k=n or r.randrange(6, 30))).capitalize() + "."


def article(r):
    """(markup, text) of an article of h1, paragraphs, lists, quotes and inline mark-up."""
    title = sentence(r, 6)
    parts, text = [f"<h1>{title}</h1>"], [title]
    for _ in range(r.randrange(3, 9)):
        s = sentence(r)
        kind = r.randrange(7)
        if kind == 0:
            a, b = sentence(r, 4), sentence(r, 5)
            parts.append(f"<ul><li>{a}<li>{b}</ul>")
            text += [a, b]
        elif kind == 1:
            parts.append(f"<p>{s[:4]}<b>{s[4:9]}</b>{s[9:]} <a href='/x?a>b'>{WORDS[3]}</a> &amp;&nbsp;&lt;tag&gt;\n  end</p>")
            text.append(f"{s} {WORDS[3]} & <tag> end")
        elif kind == 2:
            parts.append(f"<blockquote><p>{s}</blockquote>")
            text.append(s)
        elif kind == 3:
            parts.append(f"<p>{s}<br>Ok.")
            text += [s, "Ok."]
        elif kind == 4:
            parts.append(f"<p>{s}</p><div class='ad'>{sentence(r, 12)}</div>")
            text.append(s)
        elif kind == 5:
            parts.append(f"<h2>{s[:12]}</h2><p>{s}</p><aside><p>{sentence(r, 8)}</p></aside>")
            text += [s[:12], s]
        else:
            parts.append(f"<p>{s}</p><!-- <p>no</p> --><script>var a='</p><p>no';</script>")
            text.append(s)
    return "".join(parts), " ".join(" ".join(t.split()) for t in text)


def page(r, kind):
    body, text = article(r)
    menu = "<ul>" + "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in WORDS[:8]) + "</ul>"
    notice = f"<div id='cookie-notice'><p>{sentence(r, 14)}</p><button>Ok now</button></div>"
    foot = f"<p>&copy; 2020 {sentence(r, 7)}</p>"
    comments = "".join(f"<div class='comment'><p>{sentence(r)}</p></div>" for _ in range(r.randrange(6)))
    form = f"<form action='/s'><label>Your {sentence(r, 5)}</label><input name=q><select><option>a<option>b</select></form>"
    side = f"<p>{sentence(r)}</p>" * 2
    head = f"<!doctype html><html><head><title>{sentence(r, 5)}</title><style>p{{}}</style></head><body class='has-sidebar'>"
    parts = {
        "article": f"{head}<header><h1>Site name</h1><nav>{menu}</nav></header>{notice}<main><article>{body}</article><section id=comments>{comments}{form}</section></main><aside>{side}</aside><footer>{foot}</footer></body></html>",
        "main": f"{head}<div class='topbar'>{menu}</div><main role=main>{body}</main><div class=sidebar>{side}</div>{form}<div id=footer>{foot}</div></body></html>",
        "plain": f"{head}<div id=header><div class=menu>{menu}</div></div><div id=wrap><div class='content'>{body}</div></div><div class='comments'>{comments}</div><div class='site-footer'>{foot}</div>",
        "form": f"<body><form id=aspnet><div class=nav-main>{menu}</div><article class=post><header>{body[: body.index('</h1>') + 5]}</header>{body[body.index('</h1>') + 5 :]}<footer>{foot}</footer></article></form>",
        "teasers": f"{head}<article class=post>{body}</article><aside><article><p>{sentence(r)}</p></article></aside><div class='related-posts'><article><p>{sentence(r)}</p></article></div>",
    }
    return parts[kind], text


TEMPLATES = ("article", "main", "plain", "form", "teasers")


@pytest.mark.parametrize("kind", TEMPLATES)
def test_templates_by_prior_and_fitted_weights(kind):
    r = random.Random(kind)
    fitted = html_text.Counter()
    for k in TEMPLATES:
        for _ in range(20):
            fitted.update(html_text.count_features(page(r, k)[0]))
    weights = html_text.weights_of({f: (fitted[f, True], fitted[f, False]) for f, _ in fitted})
    for _ in range(60):
        source, text = page(r, kind)
        assert " ".join(blocks(source, prior_weights())) == text
        assert " ".join(blocks(source, weights)) == text


def test_the_region_is_the_best_of_all():
    """By scores alone: texts of one word and tags, against all contiguous regions."""
    r = random.Random(1)
    weights = {f"open|{k}|": w for k, w in (("bare", -1.0), ("p", 1.0))} | {"<p": 0.6, ">p": 0.6, "<div": 0.2, ">div": 0.2}
    for _ in range(200):
        source = "".join(r.choice(["<p>a</p>", "<p>b c</p>", "<div>x</div>", "<div>y z w</div>"]) for _ in range(r.randrange(1, 12)))
        scores, texts = [], []
        for e, kind, text in parse(source):
            n = len(text.split())
            scores.append((1.0 if e.tag == "p" else -1.0) * n if kind == "text" else -weights[kind + e.tag])
            texts.append(text)
        best = max((sum(scores[a:b]), -a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1))
        got = blocks(source, weights)
        if best[0] <= 1e-9:
            assert not got
        else:
            found = " ".join(got)
            sums = {" ".join(" ".join(texts[a:b]).split()): round(sum(scores[a:b]), 6) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)}
            assert max(v for k, v in sums.items() if k == found) == pytest.approx(best[0]) or found in [k for k, v in sums.items()]


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("", ""),
        ("no mark-up &amp; more", "no mark-up & more"),
        ("<p>cut off <b>here", "cut off here"),
        ("<p>a < b and c<d>e</d></p>", "a < b and ce"),
        ("<p>one<p>two<br/>three</p>four", "one two three four"),
        ("<p>x&#233;&eacute;&#x1F600;&amp;amp;&am</p>", "xéé😀&amp;&am"),
        ("<P CLASS=AD>buy</P><P>read this text</P>", "read this text"),
        ("<p>a \t\n b</p>", "a b"),
        ("<div hidden><p>not this one</p></div><p>this one here</p>", "this one here"),
        ("<p>start</p><!-- never closed <p>gone</p>", "start"),
        ("<p>start</p><script>never closed <p>gone</p>", "start"),
        ("<p title='a>b' data-x=\"<p>\">in quotes</p>", "in quotes"),
        ('<p>fine</p><p title="never closed>and on</p><p>more</p>', "fine and on more"),
        ("</div></p><p>stray ends</p></article>", "stray ends"),
        ("<table><tr><td>a b c<td>d e<tr><td>f g</table>", "a b c d e f g"),
    ],
)
def test_odd_markup(source, text):
    assert " ".join(blocks(source, prior_weights())) == text


def test_long_pages_take_linear_time():
    for source in ("<p>word word</p>" * 60_000, "<a \"" * 100_000, "<!--" * 200_000, "<div>" * 20_000 + "text", "<b><i>" * 20_000 + "<p>x" * 10_000, "a" * 2_000_000):
        start = time.time()
        blocks(source, prior_weights())
        assert time.time() - start < 20


def test_frame(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    r = random.Random(3)
    rows = [(1, "u", page(r, "article")[0]), (1, "u", page(r, "main")[0]), (None, None, None), (2, None, ""), (3, "v", "<p>Über\U0001f600</p>")]
    frame = spark.createDataFrame([(*x, "t", "n") for x in rows + rows], schema)
    out = main_text(frame)
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == 10
    assert all(row.n_chars == len(row.text) for row in out.collect())
    assert out.where("page_id = 3").first().text == "Über\U0001f600"
    assert main_text(frame.where("page_id > 5")).count() == 0
    same = spark.createDataFrame([(i, "u", rows[0][2], "", "") for i in range(300)], schema)  # one page, many times
    assert fit_weights(same, sample=50) == prior_weights()  # they count once, and too few pages hold their features


def plain(source):
    m = re.search("<article>(.*?)(?:</article>|$)", source or "", re.S)
    return " ".join(html.unescape(re.sub("<[^>]*>", "", re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", m[1]))).split()) if m else ""


def test_registered_query(spark):
    sf = "/root/testdata/sf0.01"
    want = {r.page_id: plain(r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in QUERIES["op13_html_extraction"](spark, sf).collect()}
    assert got == want
    # without the article element, weights that its pages taught find it
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    bare = pages.withColumn("html", F.regexp_replace("html", "(</?)article>", "$1div>"))
    assert {r.page_id: r.text for r in main_text(bare, fit_weights(pages)).collect()} == want
