import random
import time

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks.oracle import html_texts
from docwatch.functions import text as tx
from docwatch.functions.main_text import main_blocks

STORY = "A sentence of the story that is long enough to count as text."


def lines(markup):
    return [line.strip() for line in main_blocks(markup).split("\n") if line.strip()]


def test_menu_of_links_stays_outside():
    menu = "".join(f"<li><a href='/{i}'>Section number {i}</a></li>" for i in range(9))
    page = f"<div><ul>{menu}</ul><p>{STORY}</p><p>Short.</p><p>{STORY}</p><ul>{menu}</ul></div>"
    assert lines(page) == [STORY, "Short.", STORY]


def test_article_keeps_its_short_blocks():
    page = f"<p>{STORY}</p><p>x</p><p>x</p><article><h1>Head</h1><p>{STORY * 3}</p><p>End</p></article><p>Imprint</p>"
    assert lines(page)[-3:] == ["Head", STORY * 3, "End"]


@pytest.mark.parametrize(
    "name", ["class=comments", 'id="comment-list"', "class='x sidebar'", 'class="related-posts"', 'CLASS = "Share_Bar"']
)
def test_named_boxes_go_with_all_they_hold(name):
    page = f"<div><p>{STORY}</p></div><div {name}><div><p>{STORY} No.</p></div><p>{STORY * 9}</p></div>"
    assert lines(page) == [STORY]


@pytest.mark.parametrize("name", ["class=commentary", 'href="/comments"', 'class="has-sidebar"', 'data-x="menu"'])
def test_other_names_stay(name):
    assert lines(f"<div {name}><p>{STORY}</p></div>") == [STORY]


def test_unclosed_and_crossed_boxes():
    # the aside ends with the section it stands in; the second </section> closes nothing
    page = f"<section><div class=ad><p>{STORY * 2}</section></section><p>{STORY}<p>More of the same story, told at length."
    assert lines(page) == [STORY, "More of the same story, told at length."]
    # a body ends a head that was left open
    assert lines(f"<head><title>{STORY}</title><body><p>{STORY} Body.</p>") == [STORY + " Body."]
    # a link that was left open ends with its box
    assert lines(f"<div><a href=x>{STORY}</div><div><p>{STORY} Text.</p></div>") == [STORY + " Text."]


def test_without_a_good_run_everything_counts():
    assert lines("<p>One</p><p>Two</p><nav>Menu</nav>") == ["One", "Two"]
    assert lines("") == [] and lines("<nav>only</nav>") == []


def test_scripts_that_are_not_closed(one, spark):
    rows = spark.createDataFrame([(f"<p>{STORY}</p><script>if (a < b) document.write('<p>no</p>')",)], "x string")
    assert tx.with_html_text(rows, F.col("x"), "t").first().t == STORY


@pytest.mark.parametrize("piece", ["<div>", "</div>", "<", "<a ", "<div class=\"", "<p>x</p>", "<div id='", "x > y < "])
def test_time_grows_with_the_page(piece):
    page = piece * (500_000 // len(piece))
    start = time.perf_counter()
    main_blocks(page)
    assert time.perf_counter() - start < 10


def test_equal_to_sql_on_tag_soup(spark):
    deal = random.Random(5)
    pieces = [
        "<div>", "</div>", "<section>", "</section>", "<div class='ad x'>", '<ul id="menu">', "</ul>", "<article>", "</article>",
        "<p>", "</p>", "<br/>", "<a href=x>", "</a>", "<nav>", "</nav>", "<body>", "</body>", "<b>", "<>", "< no tag", " 1 > 0 ",
        "<!-- no <p> -->", "<script>x</script>", "&amp;", "word ", "several words of a text ", STORY, STORY, "\n \t\n", "</ p>", "<P CLASS=ads>",
    ]
    pages = pd.DataFrame({"k": range(400), "x": ["".join(deal.choices(pieces, k=deal.randint(1, 40))) for _ in range(400)]})
    con = duckdb.connect()
    con.register("soup", pages)
    expected = dict(con.execute(f"WITH RECURSIVE {html_texts('soup')} SELECT k, t FROM read_texts").fetchall())
    rows = tx.with_html_text(spark.createDataFrame(pages), F.col("x"), "t").collect()
    assert {r.k: r.t for r in rows} == expected
    assert len(set(expected.values())) > 150
