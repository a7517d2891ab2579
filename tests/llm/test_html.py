import itertools
import time

import pytest
from pyspark.sql import functions as F

from marketlake.llm import html_extract as h

PAGES = {
    "semantic": (
        "<body><header><a href=/>Home</a></header><main><article><h1>Title</h1><p>One para of text here.</p><aside>Related</aside>"
        "<div class='ad-box'>Buy now</div><form><label>Mail</label><input></form><p>Short.</p></article><section id=comments>"
        "<h2>Comments</h2><article class=comment><p>I like this very long comment which goes on and on for many words.</p></article>"
        "</section></main><footer>(c)</footer>",
        "Title\nOne para of text here.\nShort.",
    ),
    "divisions": (
        '<html><body class="has-sidebar"><div id="header">Site</div><div class="menu"><a href=a>a</a></div><div id="content">'
        "<h1>T &amp; U</h1><p>Real words in a long long paragraph with many words that go on and on.</p><p>Short one.</p></div>"
        '<div class="cookie-notice">We use cookies and a lot of words to say so in this long paragraph ok.</div></body>',
        "T & U\nReal words in a long long paragraph with many words that go on and on.\nShort one.",
    ),
    "cut off": ("<article><p>Hello <b>wor</b>ld <a href='x>y'>link</a> a < b<p>Next&nbsp;<br>\n one<p cla", "Hello world link a < b\nNext one"),
    "raw": ("<title>no</title><article><script>if (a<b) '</p>'</script><style>p{}</style><p>&lt;kept&gt;</p><!-- <p>no</p> --></article>", "<kept>"),
    "wrapped": (
        '<div class="page-header-wrap"><div class="sidebar">many other things</div><article><p>Inside the wrapper stands the text.</p>'
        "</article></div>",
        "Inside the wrapper stands the text.",
    ),
    "nothing": ("", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    html, text = PAGES[name]
    assert h.main_text(html) == text


def test_minimum_cut_is_least():
    """Against all labellings of small graphs."""
    import random

    random.seed(3)
    for _ in range(200):
        n = random.randint(1, 7)
        score = [random.choice([-2.0, -1.0, -0.3, 0.0, 0.4, 1.0, 2.5]) for _ in range(n)]
        edges = {i: {} for i in range(n)}
        for i, j in itertools.combinations(range(n), 2):
            if random.random() < 0.5:
                edges[i][j] = edges[j][i] = random.choice([0.3, 0.5, 1.0])

        def cost(label):
            lost = sum(abs(s) for s, x in zip(score, label, strict=True) if (s > 0) != x and s != 0)
            return lost + sum(c for i in edges for j, c in edges[i].items() if i < j and label[i] != label[j])

        least = min(cost(x) for x in itertools.product([False, True], repeat=n))
        assert cost(h.minimum_cut(score, edges)) == pytest.approx(least)


def test_rows(spark, rows):
    table = spark.createDataFrame(
        [(1, "u", None), (None, None, "<p>x"), (2, "u", "<article>" + "<p>word word" * 20_000), (2, "u", "<article><div><p>deep" + "</div>" * 5)],
        "page_id long, url string, html string",
    ).withColumn("text", F.lit("clash"))
    out = rows(h.extract(table), "page_id", "url", "n_chars")
    assert out == sorted([(1, "u", 0), (None, None, 0), (2, "u", 20_000 * 10 - 1), (2, "u", 4)], key=repr)
    assert h.extract(table.limit(0)).count() == 0


def test_deep_page():
    assert h.main_text("<div>" * 30_000 + "<article><p>text of some words") == "text of some words"


ARTICLE = "<nav><a href=/>Home</a></nav><article><h1>Title</h1>{}<p>The last words.</p></article><footer>(c)</footer>"


@pytest.mark.parametrize(
    "piece",
    [
        '<div class="overflow-hidden"><p>Kept.</p></div>', '<div class="sm-hidden md:block">Kept.</div>',
        '<section title="the hidden city"><p>Kept.</p></section>', '<div data-note="display:none">Kept.</div>',
        '<div hidden="until-found">Kept.</div>', '<h2 id="related-work">Kept.</h2>', '<p class="warning">Kept.</p>',
        '<section id="related-work"><p>Kept.</p></section>', '<h2 id="comments">Kept.</h2>', '<div class="warning">Kept.</div>',
        '<div class="author-note"><p>Kept.</p></div>', '<p class="text-header">Kept.</p>',
    ],
)
def test_names_and_values_that_hide_nothing(piece):
    assert h.main_text(ARTICLE.format(piece)) == "Title\nKept.\nThe last words."


@pytest.mark.parametrize(
    "piece",
    [
        "<div hidden>Gone.</div>", '<div hidden="">Gone.</div>', "<div class=x HIDDEN>Gone.</div>", '<div aria-hidden="true">Gone.</div>',
        '<div style="color:red; display : none">Gone.</div>', '<div class="ad">Gone.</div>', '<div class="text-center related-posts">Gone.</div>',
        '<div id="shareButtons">Gone.</div>', '<div role="navigation">Gone.</div>', '<p class="ad">Gone.</p>', '<section id="comments">Gone.</section>',
        '<div class="notice">Gone.</div>', '<div class="user-comment">Gone.</div>', '<div class="responses"><p>Gone.</p></div>',
        '<ol class="reader-comments"><li>Gone.</li></ol>',
    ],
)
def test_hidden_elements_and_boilerplate_containers(piece):
    assert h.main_text(ARTICLE.format(piece)) == "Title\nThe last words."


def test_names_of_the_article_itself():
    for name in ("overflow-hidden", "post category-social", "comments-open"):
        assert h.main_text(f'<article class="{name}"><p>Some words.</p></article>') == "Some words."


NEUTRAL = {
    "paragraphs": ("<p>It rained.</p><p>Nobody came.</p><p>The lamp went out.</p>", "It rained.\nNobody came.\nThe lamp went out."),
    "dialogue": ("<div>Who is it?</div><div>Me.</div><div>Come in, then.</div>", "Who is it?\nMe.\nCome in, then."),
    "verse": ("<h2>Song</h2><p>Down the long road<br>the wind goes<p>and home again", "Song\nDown the long road the wind goes\nand home again"),
    "list": ("<ul><li>two eggs</li><li>flour</li><li>milk</li></ul>", "two eggs\nflour\nmilk"),
    "one": ("<p>Only one paragraph.</p>", "Only one paragraph."),
}


@pytest.mark.parametrize("name", NEUTRAL)
def test_short_blocks_without_article_or_main(name):
    html, text = NEUTRAL[name]
    menu = "<nav><a href=a>Home</a></nav><ul><li><a href=b>News</a></li><li><a href=c>About us</a></li></ul>"
    assert h.main_text(html) == text
    assert h.main_text(f"{menu}{html}<div class=sidebar>Buy this</div><footer>(c) us</footer>") == text


LONG = "It had rained for a week when the boat came in at last, and nobody was there to see it."


def test_a_form_around_the_whole_page():
    menu = "<nav><a href=a>Home</a></nav>"
    for body in (f"<h2>News</h2><p>{LONG}</p><p>{LONG}</p>", f"<article><h1>News</h1><p>{LONG}</p></article>"):
        wanted = h.main_text(f"<body>{menu}{body}</body>")
        assert LONG in wanted
        assert h.main_text(f'<body><form id="aspnetForm" method=post>{menu}{body}<input type=hidden></form></body>') == wanted
    login = f"<p>{LONG}</p><p>{LONG}</p><form><label>Name</label><input><p>Send us a message and we will answer as soon as we can, or even sooner.</p></form>"
    assert h.main_text(login) == f"{LONG}\n{LONG}"


def test_wrong_nesting_costs_no_walks():
    start = time.process_time()
    assert h.main_text("<p>" + "<b id=x>" * 60_000 + LONG + "</i>" * 60_000) == LONG
    assert time.process_time() - start < 5
