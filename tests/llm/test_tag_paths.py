import pytest

from hazeline.llm import tag_paths
from hazeline.llm.tag_paths import main_text

LONG = "A long sentence of the article, with words, commas and a stop. It goes on for a while, as articles do."


def text(html):
    return main_text(html)[0]


def test_article_without_its_surroundings():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{x:1}}</style><script>var t="</p>";</script></head><body>
    <header><h1>Site</h1><p>Motto, of the site.</p></header><nav><ul><li><a href="/a">Home</a></ul></nav>
    <div class="cookie-notice">We use cookies, really.</div><!-- ad > 1 --><div class="ad">Buy, now.</div>
    <article><h1>Title</h1><p>{LONG}</p><p><b>Un&eacute; &amp; deux.<br><p>Short.</p><aside>Related, links.</aside>
    <form><input name=q><button>Send</button></form><ul><li>One, item<li>Two</ul></article>
    <div id="comments"><p>Great post, I liked it. Really, a lot of text stands here.</p></div><footer>&copy; 2020</footer></body></html>"""
    assert text(page) == f"Title {LONG} Uné & deux. Short. One, item Two"


def test_page_of_divisions_only():
    page = f"<div class=wrap><div class='menu'><a>Home</a></div><div class=post><p>{LONG}</p><p>{LONG}</p></div><div class=sidebar>More</div></div>"
    assert text(page) == f"{LONG} {LONG}"


def test_ratios_drop_link_lists_without_telling_names():
    links = "".join(f"<li><a href=/{i}>Item {i}</a></li>" for i in range(40))
    page = f"<div><ul>{links}</ul></div><div><p>{LONG}</p><p>{LONG}</p></div>"
    assert text(page) == f"{LONG} {LONG}"


MENU = "<div class=k1><ul>" + "".join(f"<li><a href=/{i}>Item {i}.</a></li>" for i in range(12)) + "</ul></div>"


def test_ratios_decide_where_no_tag_or_name_tells(monkeypatch):
    page = f"{MENU}<div class=k2><h1>A title of words</h1><p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div>{MENU}"
    assert text(page) == f"A title of words {LONG} Yes. {LONG}"
    monkeypatch.setattr(tag_paths, "content_paths", lambda nodes: {n.path for n in nodes})
    assert text(page).startswith("Item 0. Item 1.") and text(page).endswith("Item 11.")


@pytest.mark.parametrize("name", ["legal", "post tags", "notice", "widget", "search related"])
def test_articles_are_not_lost_by_a_name(name):
    body = f"<p>{LONG}</p><p>{LONG}</p>"
    assert text(f"{MENU}<div class='{name}'>{body}</div><div class=cookie-notice>We use cookies, really.</div>") == f"{LONG} {LONG}"
    assert text(f"<div id='{name}'><article>{body}</article></div><div class=related><article><p>{LONG}</p></article></div>") == f"{LONG} {LONG}"
    assert text(f"<article>{body}<div class='{name}'>Also of this, a sentence.</div></article>") == f"{LONG} {LONG}"


def test_articles_inside_a_form_are_kept():
    page = f"<form id=aspnetForm><input name=q><select><option>One</select><nav>Home</nav><article><p>{LONG}</p></article><button>Go</button></form>"
    assert text(page) == LONG
    assert text(page.replace("article>", "div>")) == LONG
    assert text(f"<article><p>{LONG}</p><form><p>Write to us, we will answer.</p></form></article>") == LONG


def test_comments_go_though_longer_than_the_article():
    said = "".join(f"<p>{LONG}</p>" for _ in range(30))
    for around in ("<div>{}</div>", "<article>{}</article>"):
        assert text(around.format(f"<p>{LONG}</p>") + f"<div id=comments>{said}</div>") == LONG
        assert text(around.format(f"<p>{LONG}</p><div class='user comments'>{said}</div>")) == LONG
    assert text(f"<main><p>{LONG}</p><article class=comment>{said}</article></main>") == LONG


def test_pages_without_sentences_keep_their_suspicions():
    assert text("<div class=ad>Buy</div><form>Name</form>") == ""
    assert text("<div class=ad>Buy</div><p>x</p>") == "x"


def test_blocks_and_white_space():
    assert text("<p>a<b>b</b>c<br>d</p>\n<p> e \n\t f&nbsp;g </p>") == "abc d e f g"
    assert text("<table><tr><td>a<td>b<tr><td>c</table>") == "a b c"
    assert text('<p title="x > y">z</p>') == "z"


def test_broken_markup():
    assert text("plain") == "plain"
    assert text("<p>a <i>b <p>c </i> d") == "a b c d"
    assert text("a < b and c > d") == "a < b and c > d"
    assert text("<script>alert('x')") == ""
    assert text("<p>x</p><!-- never closed") == "x"
    assert text("</div></p>y") == "y"


def test_awkward_rows(spark):
    deep = "<div>" * 3000 + LONG + "</div>" * 3000
    rows = [(1, "u", None), (2, None, ""), (None, "v", f"<p>{LONG}</p>"), (3, "w", f"<p>{LONG * 5000}</p>"), (3, "w", deep), (4, "w", "<" * 50_000)]
    pages = spark.createDataFrame([r + ("x",) for r in rows], "page_id long, url string, html string, text string")
    found = tag_paths.extracted(pages).collect()
    assert len(found) == 6
    texts = {(r.page_id, r.n_chars): r.text for r in found}
    assert texts[1, 0] == "" and texts[2, 0] == "" and texts[None, len(LONG)] == LONG
    assert (3, len(LONG) * 5000) in texts and (3, len(LONG)) in texts


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert tag_paths.extracted(pages).collect() == []


def test_given_pages_equal_their_article(spark):
    import html
    import re

    for row in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        expected = html.unescape(re.sub(r"<(?!/?b>)[^>]*>", " ", inner).replace("<b>", "").replace("</b>", ""))
        assert text(row.html) == " ".join(expected.split())
