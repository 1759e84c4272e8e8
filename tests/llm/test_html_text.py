import html
import re
import time

import pytest
from lumivox.llm import html_text

DATA = "/root/testdata/sf0.001"
TREE = html_text.trained_tree()
FRAME = "<html><head><title>T of page</title><style>p{x:1}</style><script>var a='</p>';</script></head><body>{0}</body></html>"
STORY = "The long story goes on for many words until it ends in a way that nobody had thought of before."


@pytest.mark.parametrize(
    ("body", "text"),
    [
        (f"<nav><a href=x>home</a></nav><article><h1>Head</h1><p>{STORY}</p></article><footer>&copy; me</footer>", f"Head\n{STORY}"),
        (f"<article><p>a &amp; b&nbsp;&lt;c&gt;<br>d<b> e<i>f</i></b><p>{STORY}</article>", f"a & b <c> d ef\n{STORY}"),
        (f"<div class='cookie-notice'>We use cookies, of course, for this and that and much more.</div><main><p>{STORY}</p></main>", STORY),
        (f"<main><p>{STORY}</p><aside>Read also this and that</aside><div class=comments><p>{STORY}</p></div></main>", STORY),
        (f"<article><p>{STORY}</p><form><label>Name</label><input name=a></form><!-- <p>no</p> --></article>", STORY),
        (f"<header><h1>Site</h1></header><div id=content><h1>Head</h1><p>{STORY}</p><p>{STORY}</p></div><div id=sidebar><p>{STORY}</p></div>", f"Head\n{STORY}\n{STORY}"),
        (f"<div><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul></div><div><p>{STORY}</p><p>{STORY}</p></div>", f"{STORY}\n{STORY}"),
        (f"<article><p>{STORY}</p><ul><li>first point</li><li>second</li></ul><p>one &#x27;two&#39;", f"{STORY}\nfirst point\nsecond\none 'two'"),
        ("<nav><a href=x>home</a></nav><footer>end</footer>", ""),
    ],
)
def test_main_text(body, text):
    assert html_text.main_text(FRAME.replace("{0}", body), TREE) == text


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!--", "<script>", "</p></p>", "<article><p>&am", "<a <b>c", "\x00<p>\x00"])
def test_broken_pages_do_not_crash(page):
    assert isinstance(html_text.main_text(page, TREE), str)


@pytest.mark.parametrize(
    ("body", "text"),
    [
        (f'<div class="wrap header-fixed"><article><p>{STORY}</p></article></div>', STORY),
        (f'<main><div class="search-results"><p>{STORY}</p></div></main>', STORY),
        (f'<article><section class="notice-of-law"><p>{STORY}</p></section></article>', STORY),
        (f"<article><fieldset><p>{STORY}</p></fieldset></article>", STORY),
        (f"<h1>News</h1><p>{STORY}</p><p>Short one.</p><p>Yes.</p><p>{STORY}</p>", f"News\n{STORY}\nShort one.\nYes.\n{STORY}"),
        (f"<p>{STORY}</p><p>Yes.</p><div class=sidebar><p>{STORY}</p></div>", f"{STORY}\nYes."),
        (f"<article><p>let <math><mi>x</mi> = 2</math> and <object>a picture</object> be</p><p>{STORY}</article>", f"let x = 2 and a picture be\n{STORY}"),
        (f"<article><svg><title>one</title><g><p>{STORY}</article>", STORY),
        (f"<article><p>{STORY}</p></article><aside><article><h2>Other</h2><p>{STORY}</p></article></aside>", STORY),
        (f"<article><p>{STORY}</p></article><div class=comments><article class=comment-body><p>{STORY}</p></article></div>", STORY),
        (f"<div class=content><p>{STORY}</p><p>Now.</p></div><div class='newsletter-signup'><p>{STORY}</p></div><div class='cookie-banner'>{STORY}</div>", f"{STORY}\nNow."),
        (f"<article><header><h1>Title here</h1></header><p>{STORY}</p><noscript>{STORY}</noscript></article>", f"Title here\n{STORY}\n{STORY}"),
    ],
)
def test_places_and_names(body, text):
    assert html_text.main_text(FRAME.replace("{0}", body), TREE) == text


def test_tree_separates_its_pages():
    for page, labels in html_text.LABELLED:
        found = html_text.blocks(page)
        assert "".join(str(int(p >= 0.5)) for p in TREE.predict(html_text.features(found))) == labels, page[:80]


def test_registered_query_against_the_pages_layout(spark):
    """Supplied pages have one layout, so plain patterns find the article's headline and paragraphs."""
    got = {r["page_id"]: r for r in html_text.op9_html_extraction(spark, DATA).collect()}
    pages = spark.read.parquet(f"{DATA}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        parts = re.split(r"</?(?:h1|p)>", re.sub(r"<!--.*?-->", "", inner, flags=re.S))
        texts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", re.sub("<br>", " ", p)))).strip() for p in parts]
        want = "\n".join(t for t in texts if t)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


@pytest.mark.parametrize("mess", ["</p>", "</b>", "<title>", "<svg>", "</a>", "<p>"])
def test_deep_nesting_is_linear(mess):
    def seconds(n):
        began = time.monotonic()
        html_text.blocks("<div>" * n + mess * n)
        return time.monotonic() - began

    assert seconds(32_000) < 8 * max(seconds(8_000), 0.05)


def test_long_page_is_linear():
    page = FRAME.replace("{0}", "<article>" + f"<p>{STORY} <a href=x>link</a></p>" * 5000 + "</article>")
    assert html_text.main_text(page, TREE).count("\n") == 4999


def test_frame(spark):
    df = spark.createDataFrame([(1, "u", None, "t"), (1, "u", FRAME.replace("{0}", f"<article><p>{STORY}"), "t")], "page_id long, url string, html string, text string")
    got = html_text.extract_text(df)
    assert set(got.columns) == {"page_id", "url", "html", "text"}
    assert sorted(r["text"] for r in got.collect()) == ["", STORY]
    assert html_text.extract_text(df.limit(0)).count() == 0
