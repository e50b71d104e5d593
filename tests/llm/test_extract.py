import html
import re
import time

import duckdb
import pytest

from martflow.llm import extract as x
from martflow.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
TREE = x.trained()


def main(page):
    return x.main_text(page, TREE)


def article(page):
    """What stands between the article's tags, cut at its block tags."""
    begin = page.find("<article>")
    if begin < 0:
        return ""
    end = page.find("</article>", begin)
    body = page[begin : end if end >= 0 else len(page)].split("<footer")[0]
    body = re.sub(r"<[^<>]*$", "", body)
    parts = re.split(r"</?(?:article|p|h1|div|footer)[^>]*>", body.replace("<br>", " "))
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
    return "\n".join(p for p in parts if p)


def test_articles_of_all_pages_are_whole(spark):
    pages = dict(duckdb.connect().execute(f"SELECT page_id, html FROM read_parquet('{SMALL}/pages.parquet')").fetchall())
    got = QUERIES["op9_extract"](spark, SMALL).collect()
    assert {r.page_id: r.text for r in got} == {k: article(p or "") for k, p in pages.items()}
    assert all(r.n_chars == len(r.text) for r in got)


PARTS = [
    "<nav><ul><li><a href=x>Home</a><li><a href=y>News of the whole long week in town</a></ul></nav>",
    "<header><p>The site's own words, some of them in a long row that says nothing</p></header>",
    '<div class="sidebar">Most read <a href=z>one</a></div><aside><p>Something beside it</p></aside>',
    '<div id="cookie-notice"><p>We use cookies for all sorts of things that we like to do here.</p></div>',
    '<div class="ad banner">Buy this now, it is the best of all that you can buy today</div>',
    "<form><label>Your name</label><input><button>Send</button><textarea>text</textarea></form>",
    '<section id="comments"><h2>Comments</h2><p>I was there and I can tell you that it was so.</p></section>',
    "<script>var a = '<p>not text</p>';</script><style>p{}</style><noscript>Turn it on</noscript><!-- <p>no</p> -->",
    "<footer><p>&copy; the site, with an address and a long line of law</p></footer>",
]


@pytest.mark.parametrize("tag", ["<article>{}</article>", "<main>{}</main>", '<div class="post">{}</div>', "<div role=main>{}</div>"])
def test_parts_around_the_article_go(tag):
    body = "<h1>A title</h1><p>First &amp; second&nbsp;part,\n <b>of</b> it.<br>More</p><p>Short.</p><ul><li>an item</ul>"
    want = "A title\nFirst & second part, of it. More\nShort.\nan item"
    for k in range(len(PARTS)):
        page = "".join(PARTS[:k]) + tag.format(body) + "".join(PARTS[k:])
        assert main(f"<html><head><title>T</title></head><body>{page}</body></html>") == want
    inside = tag.format(body + PARTS[2] + PARTS[4] + PARTS[5] + PARTS[6] + PARTS[8])
    assert main(inside) == want


def test_pages_without_an_article():
    long = "This is a paragraph of prose that has a good number of words in it, and more of them to come. " * 2
    long = long.strip()
    title = "Some title of a page of that kind"
    page = PARTS[0] + PARTS[3] + f"<h1>{title}</h1><p>{long}</p><p>Yes.</p><p>{long}</p>" + PARTS[8]
    assert main(page) == f"{title}\n{long}\nYes.\n{long}"
    assert main("<ul>" + "<li><a href=x>one two</a></li>" * 9 + "</ul>") == ""


PROSE = "This is the running text of the page, and it has a good number of words in it. " * 5
ARTICLE = f"<h1>A title of some words</h1><p>{PROSE}</p><p>Short end.</p>"
WHOLE = f"A title of some words\n{PROSE.strip()}\nShort end."


@pytest.mark.parametrize(
    "tag",
    [
        '<article class="post comments-open">{}</article>',
        '<article class="post category-search">{}</article>',
        '<article id="post-social">{}</article>',
        '<article class="comments">{}</article>',
        '<form id="aspnetForm"><nav><a href=x>Home</a></nav><article>{}</article></form>',
        '<div class="search-results legal"><main>{}</main></div>',
        '<div class="content-with-sidebar">{}</div>',
        '<div class="widget">{}</div>',
        '<form id="aspnetForm">{}</form>',
    ],
)
def test_words_of_a_class_do_not_decide_alone(tag):
    assert main(f"<html><body>{tag.format(ARTICLE)}</body></html>") == WHOLE


def test_what_a_doubtful_element_holds_decides():
    soup = '<table class="menu"><tr><td>Soup of the day</td><td>4 euros</td></tr></table>'
    links = '<ul class="menu">' + "<li><a href=x>one two</a></li>" * 4 + "</ul>"
    assert main(f"<article>{ARTICLE}{soup}</article>") == WHOLE + "\nSoup of the day\n4 euros"
    assert main(f"<article>{ARTICLE}{links}</article>") == WHOLE


def test_comments_that_are_articles_go_where_there_is_another():
    comment = '<article class="comment"><p>I was there and I say so to all of you who read this here.</p></article>'
    assert main(f"<article>{ARTICLE}</article><section id=comments>{comment * 3}</section>") == WHOLE
    assert main(f"<article>{ARTICLE}<section id=comments>{comment * 3}</section></article>") == WHOLE
    bare = comment.replace(' class="comment"', "")
    assert main(f"<main>{ARTICLE}</main><div class=comments>{bare * 3}</div>") == WHOLE


def test_more_than_one_feature_is_used():
    used = set()

    def visit(node):
        if node.feature >= 0:
            used.add(x.FEATURES[node.feature])
            visit(node.left)
            visit(node.right)

    visit(TREE)
    assert {"words", "links", "clean", "tag", "strong", "weak"} <= used
    assert used & {"words_before", "words_after"}


@pytest.mark.parametrize("unit", ["<b ", '<b "', "<b '", "<!", "<b<b", "</div><ul>", "<ul></div>", '<b a="x" ', "<p>a", "&amp"])
def test_a_very_long_page_of_broken_tags_takes_linear_time(unit):
    began = time.perf_counter()
    main(unit * (300_000 // len(unit)))
    short = time.perf_counter() - began
    began = time.perf_counter()
    main(unit * (1_200_000 // len(unit)))
    assert time.perf_counter() - began < 10 * short + 0.5


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("<article><p>cut off in the mid", "cut off in the mid"),
        ("<article><p>a tag cut <a hre", "a tag cut"),
        ("<article><p>a comment <!-- cut", "a comment"),
        ("<article><p>a script</p><script>if (1 < 2) {", "a script"),
        ("<article><p>1 < 2 and 3 > 2 &#233;&eacute;&#x1F600;</p>", "1 < 2 and 3 > 2 éé\U0001f600"),
        ('<article><p title="a > b">quoted</p></article>', "quoted"),
    ],
)
def test_broken_pages(page, text):
    assert main(page) == text


def test_odd_rows(spark):
    schema = "page_id bigint, url string, html string, text string, _page string"
    rows = [(1, None, None, "mine", "x"), (1, None, None, "mine", "x"), (None, "u", "<article>" + "<p>word</p>" * 20_000, "mine", "x")]
    got = x.extract(spark.createDataFrame(rows, schema), into="text").collect()
    assert sorted(len(r["text_"]) for r in got) == [0, 0, 20_000 * 5 - 1] and {r["text"] for r in got} == {"mine"}
    assert x.extract(spark.createDataFrame([], schema)).count() == 0
