from __future__ import annotations

import random

import pytest

from cadastra.llm import html_extract as h

HEAD = "<!DOCTYPE html><html><head><title>The title</title><style>p{}</style><script>var t='</p>'; a<b</script></head><body>"
NAV = "<nav><ul><li><a href='/a'>Home page</a></li><li><a href='/b'>About us all</a></li></ul></nav>"
AD = '<div class="ad">Buy one now and get two.</div>'
ARTICLE = "<article><h1>A   heading</h1><p><b>First &amp; best\nparagraph of the page.<br><p>Second &eacute;tude &lt;here&gt;.</p><p>Third, 1 < 2.</p></article>"
FOOT = "<footer>&copy; someone &middot; all rights kept by someone else</footer></body></html>"
WANT = "A heading\n\nFirst & best paragraph of the page.\n\nSecond étude <here>.\n\nThird, 1 < 2."
WEIGHTS: dict[str, float] = {"html": -9.0, "body": -9.0, "article": -9.0, "/article": -9.0, "/body": -9.0, "p": -0.1, "/p": -0.1, "h1": -0.1, "/h1": -0.1}


@pytest.mark.parametrize("weights", [WEIGHTS, {}])
@pytest.mark.parametrize("page", [
    HEAD + NAV + AD + ARTICLE + FOOT,
    HEAD + NAV + "<!-- ad > -->" + ARTICLE + AD + FOOT,
    HEAD + ARTICLE,
    HEAD + NAV + ARTICLE.replace("</article>", '<aside>Read also this and that.</aside></article>') + FOOT,
    HEAD + '<form action="x"><label>Your name</label><input type="text" value="a>b"></form>' + ARTICLE + '<div id="comments"><p>Nice page, very nice.</p></div>' + FOOT,
    HEAD + '<div class="page"><div class="cookie-notice">We use cookies for all things.</div>' + ARTICLE + '</div><section class="related">More like this one</section>' + FOOT,
    HEAD + '<div class="ad">never closed' + ARTICLE + FOOT,
])
def test_the_article_is_found(page, weights):
    assert h.main_text(page, weights) == WANT


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("<<<>>>", "<<<>>>"), ("plain words only", "plain words only"), ("<p>cut off <b", "cut off"), ("<!-- never closed", ""),
    ("<script>a b c", ""), ("<p>a&nbsp;&#160; b&#x41;&bogus;</p>", "a bA&bogus;"), ("</p></div>text", "text"), ("<pre>a\n  b</pre>", "a b"),
])
def test_odd_pages(page, text):
    assert h.main_text(page, {}) == text


def test_best_stretch_equals_brute_force():
    draw = random.Random(0)
    for _ in range(300):
        scores = [draw.choice([-3.0, -1.0, -0.5, 1.0, 2.0]) for _ in range(draw.randint(0, 12))]
        sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)]
        start, end = h.best_stretch(scores)
        assert sum(scores[start:end]) == max([0.0, *sums])


def test_weights_are_learned_and_negative(spark):
    rows = [(i, "u", HEAD + NAV + AD + ARTICLE + FOOT) for i in range(30)] + [(90, "u", "<p>no label"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    weights = h.learn_weights(pages)
    assert all(w < 0 for w in weights.values()) and weights["body"] < weights["p"] == h.MOST_TAG
    assert h.learn_weights(pages.limit(0)) == {}


def test_tables(spark):
    rows = [(1, "u", HEAD + ARTICLE + FOOT, 3), (1, "u", HEAD + ARTICLE + FOOT, 3), (None, None, None, None), (2, "v", "", 1), (3, "w", "<p>" + "long word " * 200_000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = h.extract(pages, WEIGHTS)
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    found = sorted((r["page_id"] or 0, r["text"][:20], r["n_chars"]) for r in got.collect())
    assert found == [(0, "", 0), (1, WANT[:20], len(WANT)), (1, WANT[:20], len(WANT)), (2, "", 0), (3, "long word long word ", 1_999_999)]
    assert h.extract(pages.limit(0), {}).collect() == []


FIRST, BOX, LAST = (" ".join(f"{w}{i}" for i in range(n)) for w, n in (("first", 40), ("box", 60), ("last", 200)))


@pytest.mark.parametrize("weights", [WEIGHTS | {"aside": -12.0, "/aside": -12.0, "form": -12.0, "/form": -12.0, "div": -6.0, "/div": -6.0}, {}])
@pytest.mark.parametrize("box", [
    f"<aside>{BOX}</aside>", f'<div class="advert"><div><p>{BOX}</p></div></div>', f"<form><label>{BOX}</label></form>", f'<div class="newsletter">{BOX}</div>',
    f'<p class="ad">{BOX}',
])
@pytest.mark.parametrize("open_,close", [("<article>", "</article>"), ("<main><div>", "</div></main>"), ("<div>", "</div>"), ('<article><div class="entry has-sidebar">', "</div></article>")])
def test_a_box_within_the_text_ends_nothing(box, open_, close, weights):
    page = f"{HEAD}{NAV}{open_}<p>{FIRST}</p>{box}<p>{LAST}</p>{close}{FOOT}"
    assert h.main_text(page, weights) == f"{FIRST}\n\n{LAST}"


@pytest.mark.parametrize("name", ["entry has-sidebar", "no-sidebar", "with-comments", "layout_without_ads", "post-has-menu-left"])
def test_a_wrapper_named_by_what_it_has_is_no_boilerplate(name):
    assert h.main_text(f'{HEAD}<article><div class="{name}"><p>{FIRST}</p></div></article>{FOOT}', WEIGHTS) == FIRST


def test_boxes_beside_the_text_still_end_it():
    page = f'{HEAD}<p>Skip all this.</p><nav>{BOX}</nav><div><p>{LAST}</p></div><div class="sidebar no-border">{BOX}</div><p>Made by someone.</p>{FOOT}'
    assert h.main_text(page, {}) == LAST


IN_MAIN = '<article><div class="article-header"><h1>The head</h1></div><p>{first}</p>{box}<p>{last}</p></article>'


@pytest.mark.parametrize("box,text", [
    ("<video-player></video-player>", ""), ("<svg-icon><p>icon words</p></svg-icon>", "icon words"), ("<title-card>card words</title-card>", "card words"),
    ("<select-box>chosen words</select-box>", "chosen words"), ('<h2 class="section-header">A section</h2>', "A section"),
    ('<div class="share price"><p>The price of it</p></div>', "The price of it"), ('<p class="social science">The science</p>', "The science"),
    ('<div class="ad-slot">Buy now</div>', ""), ('<div class="comments"><p>Nice page</p></div>', ""), ('<div id="related-links"><a>More</a></div>', ""),
    ("<svg><text>drawn</text></svg>", ""), ("<select><option>one</select>", ""), ("<SCRIPT src=x>a < b</SCRIPT\n>", ""),
    ("</b></i></div></nowhere>", ""),
])
@pytest.mark.parametrize("weights", [WEIGHTS, {}])
def test_names_inside_the_main_element(box, text, weights):
    first, last = " ".join(f"first{i}" for i in range(30)), " ".join(f"last{i}" for i in range(30))
    page = HEAD + NAV + IN_MAIN.format(first=first, box=box, last=last) + FOOT
    assert h.main_text(page, weights) == "\n\n".join(x for x in ("The head", first, text, last) if x)


def test_a_page_may_begin_with_a_custom_element():
    assert h.main_text("<body><video-player></video-player><p>Words of the page.</p></body>", {}) == "Words of the page."


def test_stray_end_tags_are_cheap():
    import time

    began = time.perf_counter()
    h.main_text("<div>" * 100_000 + "</b>" * 130_000 + "</div>" * 100_000, {})
    assert time.perf_counter() - began < 5  # 1.6 MB; about 0.6 s


def test_weights_are_those_of_html_elements(spark):
    pages = [(i, f"<nav><a>x</a></nav><article><my-tag-{i}><p>words here</p></my-tag-{i}></article>") for i in range(50)]
    weights = h.learn_weights(spark.createDataFrame(pages, "page_id long, html string"))
    assert "p" in weights and "/nav" in weights and not any("my-tag" in key for key in weights)
