"""Equality of slots: whole texts, distinct pages, and never inside the article."""

import re

import pytest
from pyspark.sql import functions as F

from retailmarts.llm import wrappers
from retailmarts.llm.common import read
from tests.conftest import SF
from tests.llm.test_wrappers import text_of


@pytest.mark.parametrize("start, end", [("<main>", "</main>"), ("<div class=post>", "</div>")])
def test_blocks_that_begin_alike_stay(start, end):
    begin = "same words " * 30
    pages = [f"<body><div><p>x{i}</p></div>{start}<h1>t</h1><div>{begin}{i}</div>{end}</body>" for i in range(9)]
    assert text_of(pages[3], *pages) == f"t\n{begin}3"


def test_copies_of_one_page_keep_their_text():
    page = "<body><div class=post><h1>Title</h1><div>One paragraph.</div></div></body>"
    assert text_of(page, *[page] * 10) == "Title\nOne paragraph."


def slots(pages):
    nodes = [wrappers.from_page(wrappers.parse(p)) for p in pages]
    whole = nodes[0]
    for node in nodes[1:]:
        whole = wrappers.merge(whole, wrappers.Node.unpacked(node.packed()))
    return wrappers.constant(whole)


def test_slots_are_constant_by_whole_text_on_distinct_pages():
    page = lambda i, text: f"<body><div>{text}</div><main><p>{i}</p></main></body>"
    long = "w " * 200
    assert len(slots([page(i, long) for i in range(8)])) == 1
    assert len(slots([page(i, long) for i in range(7)] * 3)) == 0
    assert len(slots([page(i, long + str(i)) for i in range(8)])) == 0


def test_a_page_without_the_article_loses_only_equal_blocks():
    long = "w " * 150
    pages = [f"<body><div>{long}a</div><main><p>{i}</p></main></body>" for i in range(9)]
    others = [f"<body><div>{long}{x}</div></body>" for x in "ab"]
    wrapper = wrappers.from_page(wrappers.parse(pages[0]))
    for p in pages[1:]:
        wrapper = wrappers.merge(wrapper, wrappers.from_page(wrappers.parse(p)))
    path, fixed = wrappers.article(wrapper), wrappers.constant(wrapper)
    assert [wrappers.main_text(p, path, fixed) for p in others] == ["", f"{long}b"]


def plain(page):
    """A page whose elements do not tell what they are."""
    return re.sub(r"<(/?)(article|main|nav|header|footer|aside)\b", r"<\1div", re.sub(r" (class|id)=(\"[^\"]*\"|'[^']*'|\S+?)(?=[ >])", "", page))


def test_the_article_is_found_without_names(spark, scratch):
    """The given pages with plain elements give the same text, through the wrapper alone."""
    pages = read(spark, SF, "pages")
    want = {r["page_id"]: r["text"] for r in wrappers.extract(pages, scratch).collect()}
    bare = spark.createDataFrame([(r["page_id"], r["url"], plain(r["html"])) for r in pages.collect()], "page_id BIGINT, url STRING, html STRING")
    assert not bare.where("html RLIKE '<(article|nav|footer)' OR html LIKE '% class=%'").count()
    assert {r["page_id"]: r["text"] for r in wrappers.extract(bare, scratch).collect()} == want
    # Without the wrapper no page comes out right.
    assert not [r for r in bare.collect() if wrappers.main_text(r["html"], [], set()) == want[r["page_id"]]]


SITE = (
    "<html><body><div><ul><li><a href=a>Home page</a></li><li><a href=b>Other page</a></li></ul></div><div>Notice {n}</div>"
    "{article}<div>Terms of use for all readers of this site, the same on every page.</div></body></html>"
)


@pytest.mark.parametrize("article, text", [
    ("<div><h1>Title {n}</h1><p>First {n} of some words.</p><p>Second {n} of some words.</p></div>", "Title {n}\nFirst {n} of some words.\nSecond {n} of some words."),
    ("<div><h2>Title {n}</h2><div>A text {n} without paragraphs</div><div>in two blocks {n}</div></div>", "Title {n}\nA text {n} without paragraphs\nin two blocks {n}"),
    ("<div><h1>Title {n}</h1><div><p>A {n} b c d e f g</p><p>h i j {n}</p></div><div><p>k l m {n}</p></div></div>", "Title {n}\nA {n} b c d e f g\nh i j {n}\nk l m {n}"),
])
def test_slots_that_vary_and_repeat_are_the_article(article, text):
    pages = [SITE.format(n="x" * n, article=article.format(n="word " * n + "end")) for n in range(1, 13)]
    assert text_of(pages[4], *pages) == text.format(n="word " * 5 + "end")


def test_wrappers_of_many_tasks_are_merged_in_a_tree(spark, scratch, monkeypatch):
    monkeypatch.setattr(wrappers, "FAN", 4)
    pages = wrappers.with_host(read(spark, SF, "pages").withColumn("url", F.lit("http://one/x")))
    many = wrappers.infer(pages.repartition(40), scratch).collect()
    one = wrappers.infer(pages.coalesce(1), scratch).collect()
    node = lambda rows: wrappers.Node.unpacked(wrappers.json.loads(rows[0]["wrapper"]))
    assert len(many) == len(one) == 1
    assert node(many).expression() == node(one).expression() and wrappers.article(node(many)) == wrappers.article(node(one))
