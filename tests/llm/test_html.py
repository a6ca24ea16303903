import html
import re
from pathlib import Path

import pytest

from pitlane.llm.html import extract, main_text

LONG = "A sentence of the story that goes on for some time, as sentences do, until it ends. " * 3


def words(text):
    return " ".join(text.split())


def test_article_without_boilerplate():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{a>b}}</style><script>var t="</p>";x()</script></head>
    <body class="page"><header>Site name</header><nav><ul><li><a href=/a>Home</a></ul></nav><!-- <p>no</p> -->
    <div class="ad">Buy {LONG}</div><div id='cookie-notice'>We use cookies</div>
    <article><header><h1>Title &amp; more</h1></header><p><b>Bold</b>er\n&lt;b&gt;&nbsp; {LONG}<br>next
    <p title="x>y">Short.</p><aside>Read also {LONG}</aside><form><input name=q>Sign up</form>
    <p>En<em>d</em>.</p><section class="comments"><p>Reader: {LONG}</p></section></article>
    <div class="sidebar">{LONG}</div><footer>&copy; me</footer></body></html>"""
    assert main_text(page) == words(f"Title & more Bolder <b> {LONG} next Short. End.")


def test_surge_and_dive_without_article_element():
    links = "".join(f"<li><a href=#{i}>link number {i}</a></li>" for i in range(12))
    page = f"<body><div>Menu</div><ul>{links}</ul><div><p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div><ul>{links}</ul><p>tiny</p></body>"
    assert main_text(page) == words(f"{LONG} Yes. {LONG}")


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""), ("", ""), ("<p></p>", ""), ("plain text", "plain text"), ("<article>That it.</article>", "That it."),
        ("<article><p>a < b &am", "a < b &am"), ("<article>x<p>y</p><scr", "x y"), ("<nav>menu<article>text</article>", "text"),
        ("<article>" + "<p>a" * 30_000, " ".join("a" * 30_000)), ('<a title="' * 3000, ""), ("<!--" * 5000, ""),
    ],
)
def test_cases(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("quote", ['"', "'"])
@pytest.mark.parametrize("inside", ["x", "x>", "</p><p class=ad>"])
@pytest.mark.parametrize("rest", ["", " id=a", " alt=it's", " href='/b' rel=\"c\"", "/"])
def test_long_attributes(quote, inside, rest):
    value = (inside * 5000)[:5000]
    page = f"<article><p data-x={quote}{value}{quote}{rest}>{LONG}<a href=\"/a\">link</a> it's \"so\"<p title='b'>End.</p></article>"
    assert main_text(page) == words(f"{LONG} link it's \"so\" End.")
    page = f"<article><p>{LONG}<iframe srcdoc={quote}</iframe>{value}{quote}{rest}>no</iframe><p>End.</article>"
    assert main_text(page) == words(f"{LONG} End.")


def test_quotes_that_never_close_stay_linear():
    assert main_text("<article>" + "<p a='x>b" + "<p a=\"x>b" * 30_001).startswith("b")
    assert main_text("<article>" + "<p title=it's>a" * 30_000) == " ".join("a" * 30_000)


def test_rows(spark):
    rows = [(1, "u", None, 0), (None, None, "<article>x</article>", 1), (2, "u", "<p>é&#233;</p>", 2), (2, "u", "<p>é&#233;</p>", 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    out = sorted(map(tuple, extract(df).collect()), key=str)
    assert out == sorted([(1, "u", "", 0), (None, None, "x", 1), (2, "u", "éé", 2), (2, "u", "éé", 2)], key=str)
    assert extract(df.limit(0)).count() == 0


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="no test tables")
def test_whole_pages_equal_their_article(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    pages = {r.page_id: r.html for r in df.collect()}
    for r in extract(df).collect():
        inner = re.split("</?article>", pages[r.page_id])[1]
        want = words(html.unescape(re.sub("<(br|/?p|/?h1)>", " ", inner).replace("<b>", "").replace("</b>", "")))
        assert r.text == want and r.n_chars == len(want)


PAGES = [
    # Optional end tags.
    (f"<ul><li class='nav-item'>Home<li class='nav-item'>Other</ul><p>{LONG}</p>", LONG),
    (f"<datalist><option value=a>A<option value=b>B</datalist><p>{LONG}</p>", LONG),
    (f"<article><table><tr><td class=ad>Buy<td>cell<tr><td>two</table><dl><dt>t<dd class='related'>x<dt>u<dd>v</dl><p>{LONG}</article>", f"cell two t u v {LONG}"),
    (f"<body><p class=advert>Buy now {LONG}<p>{LONG}<div class=share>Share</div><p>End.", f"{LONG} End."),
    # Whole class tokens only.
    (f"<article><p>{LONG}</p><div class='share-price-table'>12.5</div><section class='social-history'>h</section><section id='side-effects'>e</section></article>", f"{LONG} 12.5 h e"),
    (f"<body><div class='share-price-story'><p>{LONG}</p></div></body>", LONG),
    (f"<article><div class='ad-box'>{LONG}</div><div class='relatedPosts'>r</div><p>{LONG}</p><div id='cookie_notice'>c</div></article>", LONG),
    # Reader comments.
    (f"<article><p>{LONG}</p></article><section class='comments'><article class='comment'>{LONG}</article></section>", LONG),
    (f"<article><p>{LONG}</p><div id='comments'><article class='comment-body'>{LONG}</article></div></article>", LONG),
    (f"<aside><article>Teaser {LONG}</article></aside><main><p>{LONG}</p></main>", LONG),
    (f"<article><p>{LONG}</p><p class='advert'>Buy</p></article><article class='comment'>Reader {LONG}</article>", LONG),
    # Short lines around the text, without an article element.
    (f"<body><h1>Title</h1><p>{LONG}</p><ul><li>a<li>b<li>c<li>d<li>e</ul><p>Last words.</p></body>", f"Title {LONG} a b c d e Last words."),
    (f"<body><div>Menu</div><div><h1>T</h1><p>{LONG}</p><ul><li>a</li><li>b</li><li>c</li><li>d</li></ul><p>x</p></div><div>tail</div>", f"T {LONG} a b c d x"),
    # Never closed, and closed twice.
    (f"<div class=menu>m<article><p>{LONG}</article>", LONG), (f"<article></div></span><p>{LONG}</p></b></article></article>", LONG),
    (f"<article><p><a href=x>one <a href=y>two</a> {LONG}</p></article>", f"one two {LONG}"),
    (f"<article><article><p>in {LONG}</p></article><p>out</p></article>", f"in {LONG} out"),
    (f"<article><span class=ad>buy <span>this</span> now</span><p>{LONG}</p></article>", LONG),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_structure(page, text):
    assert main_text(page) == words(text)


def test_random_pages_equal_a_plain_reader():
    """Pages of nested blocks, some of them boilerplate, against the text they were made of."""
    import random

    draw = random.Random(10)
    noise = ["<nav>{}</nav>", "<aside>{}</aside>", "<div class='ad'>{}</div>", "<section id='comments'>{}</section>", "<p class='share-links'>{}</p>"]
    blocks = ["<p>{}</p>", "<p>{}", "<div>{}</div>", "<blockquote><p>{}</blockquote>", "<ul><li>{}<li class='x-y'>{}</ul>", "<section class='price-ad-history'>{}</section>"]
    count = [0]

    def sentence():
        count[0] += 1
        return f"Sentence {count[0]} " + "with words " * draw.randint(0, 20) + "ends."

    def made(depth):
        """(markup, kept sentences)"""
        markup, kept = [], []
        for _ in range(draw.randint(1, 4)):
            if draw.random() < 0.25:
                markup.append(draw.choice(noise).format(sentence()))
            elif depth and draw.random() < 0.3:
                inner = made(depth - 1)
                markup.append(draw.choice(["<div>{}</div>", "<section>{}</section>", "<article>{}</article>"]).format(inner[0]))
                kept += inner[1]
            else:
                block = draw.choice(blocks)
                own = [sentence() for _ in range(block.count("{}"))]
                markup.append(block.format(*own))
                kept += own
        return "\n".join(markup), kept

    for _ in range(300):
        markup, kept = made(3)
        page = f"<html><body><nav><ul><li><a href=/>Home</a></ul></nav><article>{markup}</article><footer>me</footer></body></html>"
        assert main_text(page) == words(" ".join(kept)), page


def test_large_pages_take_linear_time():
    import time

    def seconds(page):
        began = time.perf_counter()
        main_text(page)
        return time.perf_counter() - began

    for piece in (f"<p class=x>{LONG}</p>", "<div>", "</div>", "<li>a", "<span class=ad>x", "<td>x</p>", "<a href=x>y", "<b>x</i>"):
        size = 500_000 // len(piece)
        small, large = seconds("<body>" + piece * size), seconds("<body>" + piece * size * 4)
        assert large < 9 * small + 1, piece
    assert seconds(f"<article><p>{LONG}</p></article>" + f"<p>{LONG}</p>" * (5_000_000 // len(LONG))) < 20
