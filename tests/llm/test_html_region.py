import time

import pytest

from ticketmill.llm import html_region

WEIGHTS = html_region.weights_of({"word": 900, "<p>": 40, "link": 3}, {"link": 60, "chrome": 90, "<li>": 60, "<a>": 60, "word": 4})
ARTICLE = "<h1>Title &amp; more</h1><p>First <b>bo</b>ld words here.\n  Next</p><p>Second&nbsp;part<br>goes on &amp;amp; ends</p>"
TEXT = "Title & more First bold words here. Next Second part goes on &amp; ends"
AROUND = (
    '<html><head><title>T</title><style>p{x:1}</style></head><body class="has-sidebar"><header><p>Site name here</p></header>'
    "<nav><ul><li><a href=/a>One</a></li><li><a>Two</a></li></ul></nav><div class='cookie-notice'>We use cookies</div>"
    "{}<aside>Other things</aside><form><label>Mail</label><input name=q><button>Go</button></form>"
    "<section id=comments><p>Great read, thanks a lot for it</p></section><footer>&copy; us</footer></body></html>"
)


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div class='content'>{}</div>", "<main>{}</main>", "{}"])
def test_article_alone(wrap):
    page = AROUND.replace("{}", wrap.replace("{}", ARTICLE))
    assert html_region.main_text(page, WEIGHTS) == TEXT


def test_furniture_inside_the_article_goes():
    inner = "<p>One two three.</p><div class='ad'>Buy this</div><script>var t='</p>'</script><!-- x --><p>Four five.</p>"
    page = AROUND.replace("{}", f"<article>{inner}</article>")
    assert html_region.main_text(page, WEIGHTS) == "One two three. Four five."


@pytest.mark.parametrize("page", [None, "", "<nav>a b c</nav>", "<p>", "<", "<!--", "<script>x", "</p></p>"])
def test_nothing_to_find(page):
    assert html_region.main_text(page, WEIGHTS) in ("", "<")


def test_unclosed_and_odd_markup():
    assert html_region.main_text('<p class="a>b">x y<p title=\'>\'>z <b>w', WEIGHTS) == "x y z w"
    assert html_region.main_text("<p>" + "word " * 200_000, WEIGHTS) == ("word " * 200_000).strip()


@pytest.mark.parametrize("wrap", [
    '<div class="layout with-sidebar"><article>{}</article></div>', '<div id="page" class="site no-sidebar header-fixed"><article>{}</article></div>',
    '<form id=aspnet><div class="content">{}</div></form>', '<div class="sidebarRight menu-open"><div>{}</div></div>'])
def test_names_on_wrappers_say_nothing(wrap):
    more = "<p>" + "some more words of the article that fill the page " * 8 + "</p>"
    page = AROUND.replace("{}", wrap.replace("{}", ARTICLE + more))
    assert html_region.main_text(page, WEIGHTS).startswith(TEXT + " some more") and "thanks" not in html_region.main_text(page, WEIGHTS)


def test_long_comments_do_not_become_the_article():
    page = "<article><h1>Title</h1><p>" + "short text " * 6 + "</p></article><div class=comments><p>" + "long reply here " * 60 + "</p></div>"
    assert "reply" not in html_region.main_text(page, WEIGHTS)


@pytest.mark.parametrize("page", [
    "<i>" * 150_000 + "x y z" + "</b>" * 150_000, '<a href="x ' * 150_000, '<a href="x ' * 150_000 + ">", "<a '>' \">\" " * 100_000,
    "<script <style " * 100_000, "<!-- " * 200_000, "<p><div>" * 100_000 + "</p>" * 100_000])
def test_time_grows_with_the_length(page):
    start = time.perf_counter()
    html_region.main_text(page, WEIGHTS)
    assert time.perf_counter() - start < 10


def test_best_region_is_the_highest_sum():
    weights = {**WEIGHTS, "word": 1.0, "<div>": -3.0, "<p>": -0.5}
    page = "<div>a b</div><div></div><div></div><p>c d e f</p><p>g h</p><div></div><div></div>i"
    stream = [(k, p, html_region.weight_of(k, p)) for k, p, _ in html_region.tokens(page)]
    value = [n * weights[html_region.key(k, p)] for k, p, n in stream]
    best = max(sum(value[a:b]) for a in range(len(value)) for b in range(a + 1, len(value) + 1))
    got = html_region.main_text(page, weights)
    assert got == "c d e f g h" and best == 6 - 0.5 * 2


def test_frame(spark):
    rows = [(1, "u", AROUND.replace("{}", f"<article>{ARTICLE}</article>")), (2, None, None), (None, "v", ""), (1, "u", "<p>a b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "9 AS n_chars")
    got = sorted(map(tuple, html_region.extract(pages).collect()), key=str)
    assert (1, "u", TEXT, len(TEXT)) in got and (2, None, "", 0) in got and (None, "v", "", 0) in got and len(got) == 4
    assert html_region.extract(pages.limit(0)).count() == 0


def test_whole_table_against_the_labelled_articles(spark):
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in html_region.extract(pages).collect():
        inner = re.search("<article>(.*?)</article>", source[r["page_id"]], re.S)[1]
        parted = re.sub(r"<[^>]*>", lambda m: "" if m[0] in ("<b>", "</b>") else " ", inner)
        assert r["text"] == " ".join(html.unescape(parted).split())
