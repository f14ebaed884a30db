"""Block rules of HTML extraction: against marked articles, and case by case."""

import html
import re
from collections import Counter

import duckdb
import pytest

from strandlake.llm import html_text

D = "/root/testdata/sf0.01"
PROSE = "The keeper of the house went to the market in the morning and it was there that he saw what they had for the winter, as the people of the town had said to her. "


def marked(page):
    """Brute force for the given pages: all text of the article element."""
    inner = re.search(r"<article[^>]*>(.*?)</article>", page or "", re.S)
    text = re.sub(r"<[^>]+>", "", re.sub(r"</?(?:p|h[1-6]|br|div|ul|li)\b[^>]*>", " ", inner[1])) if inner else ""
    return " ".join(html.unescape(text).split())


def test_whole_table_equals_the_marked_articles(spark):
    pages = duckdb.sql(f"select page_id, html from '{D}/pages.parquet'").fetchall()
    got = {r.page_id: r for r in html_text.op3_html_text(spark, D).collect()}
    assert len(got) == len(pages)
    for i, page in pages:
        assert got[i].text == marked(page) and got[i].n_chars == len(got[i].text)


def test_text_rules_decide():
    """Most blocks are decided in pass one, some in pass two, and names alone decide few: the text rules never contradict."""
    seen = Counter()
    for (page,) in duckdb.sql(f"select html from '{D}/pages.parquet'").fetchall():
        blocks = html_text.blocks_of(page)
        evidence, labels = html_text.first_pass(blocks)
        for b, label, out in zip(blocks, labels, html_text.second_pass(blocks, evidence, labels), strict=True):
            alone = html_text.text_evidence(b)
            seen["one" if label is not None else "two"] += 1
            seen["agree" if (alone >= html_text.GOOD) == out and abs(alone) >= html_text.GOOD else "contradict" if abs(alone) >= html_text.GOOD else "silent"] += 1
    assert seen["one"] > 5 * seen["two"] > 0 and seen["agree"] > seen["silent"] and not seen["contradict"]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("   ", ""), ("plain words", "plain words"), ("<p>a&amp;b&nbsp; c</p><p>d", "a&b c d"),
        (f"<nav><a href=x>Home</a></nav><p>{PROSE}</p><p>Short.</p><footer>&copy; us</footer>", PROSE + "Short."),
        (f"<article><p>{PROSE}</p><figure><figcaption>A map.</figcaption></figure><math><mi>x</mi></math><canvas>chart</canvas></article>", PROSE + "A map. x chart"),
        (f'<article><p>{PROSE}</p><section id="side-effects"><p>Mild.</p></section><p class="related-work">Others.</p></article>', PROSE + "Mild. Others."),
        (f'<article><p>{PROSE}</p><div class="comments"><p>{PROSE}</p></div></article>', PROSE.strip()),
        (f'<article><p>{PROSE}</p><ol class="comment-list"><li><article class="comment">{PROSE}</article></ol></article>', PROSE.strip()),
        (f'<div class="content has-sidebar"><p>{PROSE}</p><div class="sidebar">{PROSE}</div></div>', PROSE.strip()),
        (f'<div class="layout sidebar-right"><main><p>{PROSE}</p></main></div>', PROSE.strip()),
        (f'<article><p>{PROSE}</p></article><div class="sidebar"><article><p>{PROSE}</p></article></div>', PROSE.strip()),
        (f'<div class="cookie-notice">{PROSE}</div><form><p>{PROSE}</p></form><h1>Title</h1><p>{PROSE}</p>', "Title " + PROSE.strip()),
        (f"<aside>{PROSE}</aside><header>{PROSE}</header><article><header><h1>Title</h1></header><p>{PROSE}<script>x</script></p><style>p</style></article>", "Title " + PROSE.strip()),
        (f"<p>{PROSE}<p>unclosed<div hidden>{PROSE}</div><!-- no end {PROSE}", PROSE + "unclosed"),
        ("<article><h1>Only</h1></article><footer>Foot of the page</footer>", "Only"),
    ],
)
def test_cases(page, text):
    assert html_text.main_text(page) == text


def test_long_page_is_read_whole():
    page = "<article>" + f"<p>{PROSE}</p>" * 20_000 + "</article>"
    assert len(html_text.main_text(page)) == 20_000 * len(PROSE) - 1


def test_table_without_rows_and_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "u", f"<p>{PROSE}</p>", "x"), (1, "u", f"<p>{PROSE}</p>", "x"), (None, None, None, None)], "page_id long, url string, html string, text string")
    assert [r.text for r in html_text.extract_text(pages).orderBy("page_id").collect()] == ["", PROSE.strip(), PROSE.strip()]
    assert html_text.extract_text(pages.limit(0)).count() == 0
