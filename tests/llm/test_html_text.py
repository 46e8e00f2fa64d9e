"""Main text of hand-written pages, generated pages with known text, and odd rows."""

import html
import random

import numpy as np
import pytest

from tests.llm.helpers import CLASHING
from tillroll.llm import html_text as ht

LONG = "This sentence is long enough to be the body of an article, with clauses, commas and a full stop."


def test_article_without_the_rest():
    page = f"""<!doctype html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head>
    <body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a><li><a href=/b>B</a></ul></nav>
    <div class="cookie-notice"><p>{LONG}</p></div><div id="topAd">Buy</div>
    <main><article><header><h1>A &amp; B&nbsp;&copy; 5 &lt; 6</h1><p>by someone</p></header>
    <p>{LONG}   <b>bold
    text</b><i>joined</i>.<br>After a break</p><p>Be.</p><aside>See also</aside>
    <p>Short <span class="ad">buy now</span> one.</p><ul><li>first point</li><li>second <a href=x>point</a></li></ul>
    <form><label>Mail</label><input><button>Send</button></form><p>{LONG}</article>
    <section id="comments"><p>{LONG}</p></section></main><footer><p>&copy; {LONG}</p></footer></body></html>"""
    assert ht.main_text(page).split("\n") == [
        "A & B © 5 < 6", LONG + " bold textjoined. After a break", "Be.", "Short one.", "first point", "second point",
        LONG]


def test_no_article_element():
    """Threshold clustering finds the region; link lists inside it go, short paragraphs stay."""
    menu = "".join(f'<li><a href="/{i}">Entry {i}</a></li>' for i in range(9))
    page = f"""<body><div><div><ul>{menu}</ul></div><h1>Headline</h1><div><p>{LONG}</p><p>{LONG}</p><p>Yes.</p>
    <p>{LONG}</p><ul>{menu}</ul><p>{LONG}</p></div><div><a href=a>Terms</a> <a href=b>Help</a></div></div></body>"""
    assert ht.main_text(page).split("\n") == ["Headline", LONG, LONG, "Yes.", LONG, LONG]


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("<p></p>", ""), ("only text", "only text"), ("<article>x", "x"),
    ("<article><h1>A</h1><p><b>one<br><p>two<p>thr", "A\none\ntwo\nthr"), ("<head><title>T</title><p>body text", "body text"),
    ("<article><p>cut &am", "cut &am"), ("<article><p>a</b></div>b</p></article></html></html>", "a\nb"),
    ("<nav>menu</nav><script>x</script>", ""), ("<article><!-- c --><p>a<![CDATA[ x ]]>b<![if !ie]>c</p>", "abc"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n2\n3"), ("<p>a<", "a<"),
    ("<article><p>a<script>if (x < y) '<p>'</script>b</p></article>", "ab"),
])
def test_small_and_broken_pages(page, text):
    assert ht.main_text(page) == text


def test_generated_pages():
    """Blocks of random length, entities and white space come back whole, whatever stands around them."""
    rng = random.Random(4)
    for _ in range(60):
        blocks = [" ".join("".join(rng.choice("abé<&\"中") for _ in range(rng.randint(1, 9)))
                           for _ in range(rng.choice([1, 2, 40, 300]))) for _ in range(rng.randint(1, 12))]
        body = "".join(f"<p>{html.escape(b).replace(' ', rng.choice([' ', chr(10), ' &#32; ']))}"
                       + rng.choice(["</p>", "", "<br>"]) for b in blocks)
        page = (f"<html><body><nav>{'<a href=x>link</a>' * 5}</nav><div class=ad>{LONG}</div><article>{body}</article>"
                f"<footer>{LONG}</footer>")
        assert ht.main_text(page).split("\n") == blocks


def test_smoothing_keeps_a_constant_and_spreads_a_spike():
    assert np.allclose(ht._smooth(np.full(5, 3.0)), 3.0) and ht._smooth(np.array([2.0]))[0] == 2.0
    spread = ht._smooth(np.eye(11)[5])
    assert spread.argmax() == 5 and spread[4] == pytest.approx(spread[6]) and spread[1] == 0


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + LONG + "<p>" + LONG
    assert ht.main_text(deep) == f"{LONG}\n{LONG}"
    long = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    assert ht.main_text(long) == "\n".join([LONG] * 20_000)


def test_odd_rows(spark):
    from pyspark.sql import functions as F
    rows = [(1, "u", f"<article><p>{LONG}</p>"), (1, "u", f"<article><p>{LONG}</p>"), (2, None, None), (None, "", ""),
            (3, "v", "\x00<p>�</p>")]
    schema = "page_id bigint, url string, html string"
    pages = spark.createDataFrame(rows, schema).withColumns({c: F.lit(1) for c in (*CLASHING, "text", "n_chars")})
    out = sorted(map(tuple, ht.extract_text(pages).collect()), key=str)
    assert out == sorted([(1, "u", LONG, len(LONG))] * 2 + [(2, None, "", 0), (None, "", "", 0), (3, "v", "\x00\n�", 3)],
                         key=str)
    assert ht.extract_text(spark.createDataFrame([], schema)).collect() == []
