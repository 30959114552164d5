"""Main text of odd pages: open elements, inline noise, passages on many pages of a host, long and hostile html."""

import time

import pytest

from caselake.llm import page_templates

SCHEMA = "page_id long, url string, html string"
PAGES = {
    "<html><head><title>t</title><p>Hello world": "Hello world",
    "<head>Some words<p>and more": "Some words\nand more",
    "<article><p>one<button>Share<p>two</article>": "one\ntwo",
    "<article><p>one<svg><path d='x'><p>two</article>": "one\ntwo",
    "<div><button><div>Share</div></button><p>one</div>": "one",
    "<p>See <a class='share-link'>the link</a> now": "See the link now",
    "<p>a <span hidden>h <span>g</span> f</span> b": "a b",
    "<div class='side-effects'><p>of drugs</p></div><div class='tags-of-war'>seen</div><div class='left-side'>menu</div>": "of drugs\nseen",
    "<p class=ad>buy<p>real": "real",
    "<ul><li class=share>x<li>y</ul>": "y",
    "<p title='hidden gem' data-class='ad'>seen": "seen",
    "<p title='a > b'>quoted</p><p title=\"open>": "quoted",
    "a < b &amp; c <d": "a < b & c <d",
    "<article><p>Teaser</article><div>" + "<p>The text itself is long." * 4 + "</div>": "Teaser\n" + "\n".join(["The text itself is long."] * 4),
    "<article><p>The text itself</article><div><p>See also</div>": "The text itself",
    "<p>one<script>if (a < b) '<p>no'</script> two<style>p": "one two",
    "<p>one<!-- <p>no --> two<![CDATA[ no ]]><?php no ?><!no> three<!-- open": "one two three",
}


def test_odd_pages(spark):
    rows = [(i, f"http://h{i}.example/", html) for i, html in enumerate(PAGES)]
    got = {r.page_id: r.text for r in page_templates.main_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == dict(enumerate(PAGES.values()))


def test_articles_on_many_pages_of_a_host_stay(spark):
    page = "<body><div><p>Welcome here</p><p>All news</p></div><article><p>First part{0}</p><p>Second part{0}</p></article></body>"
    rows = [(i, f"http://one.example/{i}", page.format("" if i < 6 else " of another")) for i in range(7)] + [(9, None, page.format(""))]
    got = {r.page_id: r.text for r in page_templates.main_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] == "First part\nSecond part" for i in (*range(6), 9)) and got[6] == "First part of another\nSecond part of another"


@pytest.mark.parametrize("part", ["<a ", '<a ">" ', "<!-- ", "<button>", "</p>", "<p hidden>", "<span hidden>x</span>"])
def test_long_hostile_html_takes_linear_time(part):
    started = time.monotonic()
    page_templates.blocks(part * (1_000_000 // len(part)))
    assert time.monotonic() - started < 5


def texts_of(spark, pages):
    rows = [(i, f"http://one.example/{i}", html) for i, html in enumerate(pages)]
    return [r.text for r in page_templates.main_texts(spark.createDataFrame(rows, SCHEMA)).orderBy("page_id").collect()]


def test_a_text_is_template_in_one_gap_and_content_in_another(spark):
    # "Share" is part of the template and, on some pages, of the text: only its place tells them apart.
    page = "<body><p>Welcome here</p><p>Share</p><p>All news</p><p>Story {0}</p>{1}<p>Imprint</p></body>"
    got = texts_of(spark, [page.format(i, "<p>Share</p>" * (i % 3)) for i in range(9)])
    assert got == ["\n".join([f"Story {i}", *["Share"] * (i % 3)]) for i in range(9)]


def test_roles_are_told_apart_until_the_template_grows_no_more(spark):
    # "b" is told apart by the template of the first round; only then does it part the gap in which "d" stands twice.
    page = "<body><p>a</p><p>d</p><p>b</p><p>Story {0}</p>{1}<p>c</p>{2}<p>z</p></body>"
    got = texts_of(spark, [page.format(i, "<p>d</p>" * (i % 3), "<p>b</p>" * (i % 2)) for i in range(12)])
    assert got == ["\n".join([f"Story {i}", *["d"] * (i % 3), *["b"] * (i % 2)]) for i in range(12)]


def test_texts_in_changing_order_are_no_template(spark):
    page = "<body><p>Welcome here</p><p>All news</p><p>Story {0}</p>{1}<p>Imprint</p><p>Contact</p></body>"
    both = ["<p>Rain in the north</p><p>Sun in the south</p>", "<p>Sun in the south</p><p>Rain in the north</p>"]
    got = texts_of(spark, [page.format(i, both[i % 2]) for i in range(8)])
    north, south = "Rain in the north", "Sun in the south"
    assert got == [f"Story {i}\n" + "\n".join([north, south] if i % 2 == 0 else [south, north]) for i in range(8)]


def test_of_crossing_classes_the_smaller_one_goes():
    template = {1: (1, 0, 3), 2: (1, 1, 3), 3: (1, 2, 3), 7: (7, 0, 2), 8: (7, 1, 2)}
    assert page_templates._crossed("h", 0, [1, 7, 2, 8, 3], template) == {("h", 7)}
    assert page_templates._crossed("h", 0, [1, 7, 8, 2, 7, 8, 3, 7, 8], template) == set()
