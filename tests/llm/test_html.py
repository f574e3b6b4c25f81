import time

import pytest

from meterlake.llm import html

LONG = "Some words that make a block long enough to lift the curve of text lengths. " * 3


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("no markup but " + LONG, "no markup but " + LONG.strip()),
    ("<html><body><nav><a href=/x>Menu</a></nav><article><h1>T</h1><p>a &amp; b&nbsp; c</p><p>d<br>e</article><footer>f</footer>", "T\n\na & b c\n\nd e"),
    ("<article><p>one<div class='ad'>Buy <p>now</div><p>two<section id=comments><p>nice</section></article>", "one\n\ntwo"),
    ("<article><p>un<b>closed <i>tags<p>next</article>", "unclosed tags\n\nnext"),
    ("<nav><ul><li>never closed<article><p>x</article>", "x"),
    ("<article><script>var t='</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes</p><form><input name=q><button>Go</button></form></article>", "yes"),
    ("<main><header><h1>Head</h1></header><p>x</p><aside>side</aside></main>", "Head\n\nx"),
    ("<article><p>a</p></article><article class=comment><p>me too</p></article>", "a"),
    ("<article><p title='a>b'>q&lt;r&gt; &#233;&eacute;</p></article>", "q<r> éé"),
    ("<article><p>cut off &am", "cut off &am"),
    ("<article></article>", ""),
    ("<article><p id='related-work'>a</p><div class='notice-period'>b</div><blockquote class='share price'>c</blockquote>"
     "<div class='share-bar mobile-only'>d</div><div id=adSlot2>e</div></article>", "a\n\nb\n\nc"),
    ("<article><p>a</p><b <i>b</i><p title=\"x>c</p><p>d</article>", "a\n\nb\n\nc\n\nd"),
    ("<article><script data-x='<'>no</script><p>a</p></article>", "a"),
])
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_density_decides_without_an_article():
    page = ("<body><div><a href=1>Home</a> <a href=2>News</a></div>" + "".join(f"<div><p>{LONG}{i}</p></div>" for i in range(4))
            + "<div>short</div><div>x</div><div>y</div><div>z</div><p>© site</p></body>")
    text = html.main_text(page)
    assert [b[-1] for b in text.split("\n\n")[:4]] == list("0123") and "Home" not in text and "©" not in text


def test_short_blocks_between_long_ones_stay():
    page = f"<div><p>{LONG}</p><p>ok</p><p>{LONG}</p></div>"
    assert html.main_text(page).split("\n\n")[1] == "ok"


def test_unmarked_pages_keep_every_surge():
    gap = "".join(f"<p><a href={i}>more about this {i}</a></p>" for i in range(4))
    text = html.main_text(f"<div><p>{LONG}1</p><p>{LONG}2</p>{gap}<p>{LONG}3</p></div>")
    assert [b[-1] for b in text.split("\n\n")] == list("123")
    assert html.main_text("<div><h1>Title</h1><p>A short note of few words.</p></div>") == "Title\n\nA short note of few words."
    rich = "See <a href=x>a long link text that makes most of this paragraph's words</a> for it."
    assert "See a long link" in html.main_text(f"<div><p>{LONG}</p><p>{rich}</p><p>{LONG}</p></div>")
    assert html.main_text("<ul><li><a href=1>Home</a><li><a href=2>News</a></ul>") == ""


def test_a_page_of_very_many_lines():
    n = 200_000  # quadratic sums would take hours
    assert html.between_surge_and_dive([1] * n, 1, n) == (0, n)


def test_marked_pages_go_by_the_same_windows(monkeypatch):
    """The curve of a marked page has windows of WINDOW lines, and short marked lines far apart surge by themselves."""
    seen, real = [], html.all_surges
    monkeypatch.setattr(html, "all_surges", lambda *a: seen.append(a) or real(*a))
    gap = "<aside>advert</aside>" * 5
    page = f"<p>{LONG}</p><article><h1>T</h1>{gap}<p>{LONG}1</p>{gap}<p>end</p></article>{gap}<article>more</article><p>{LONG}</p>"
    assert html.main_text(page) == f"T\n\n{LONG}1\n\nend\n\nmore"
    (weights, least), = seen
    n, most = len(weights), html.SURGE
    assert least == most and n == 21 and [w > 0 for w in weights] == [i in (1, 7, 13, 19) for i in range(n)]
    lifted = {j for i in range(n) if sum(weights[i:i + html.WINDOW]) >= least for j in range(i, min(n, i + html.WINDOW))}
    assert lifted != set(range(n)) and {i for i, w in enumerate(weights) if w} <= lifted


def test_surge_and_dive():
    assert html.between_surge_and_dive([0, 0, 90, 5, 90, 0, 0, 0, 10], 80) == (2, 5)
    assert html.between_surge_and_dive([1, 2, 3], 80) == (0, 0)
    assert html.between_surge_and_dive([], 1) == (0, 0)


def test_rows(spark):
    rows = [(1, "u", "<article><p>x y</p></article>", 5), (2, None, None, 6), (1, "u", "<article><p>x y</p></article>", 5), (None, "v", "", 7)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "u", "x y", 3), (2, None, "", 0), (1, "u", "x y", 3), (None, "v", "", 0)], key=str)
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("broken", ["<b ", '<b "', "<b '\" ", "<div ", "<script ", '<script a="', "<", "<!", "</b", '<p x="<b \''])
def test_broken_markup_takes_linear_time(broken):
    start = time.process_time()
    assert html.main_text("<article><p>first</p>" + broken * (1_000_000 // len(broken))).split()[0] == "first"
    assert time.process_time() - start < 30  # the square of it would take hours
