"""Main text of web pages: flat text blocks classified by a small decision tree.

A page becomes a list of text blocks with the features of shallow text analysis (word
count and link density of the block and of its neighbours) and what its enclosing
tags and their class or id names say: an element made for menus, adverts and the like
is a fact, a name that only sounds like it a hint.  A decision tree, grown here from the
blocks of the labelled pages below, keeps the blocks of the article.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, table

# HTML elements by their part in a page.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no text; all but the first two count as ordinary elements where they aren't closed.
RAW_TAGS = frozenset("script style textarea title template iframe noframes xmp svg".split())
#: Parts of a page beside its article: for certain, and only where nothing else speaks for the text.
CHROME_TAGS = frozenset("nav footer aside form menu dialog button select label option legend head".split())
WEAK_TAGS = frozenset(("header",))
MAIN_TAGS = frozenset("article main".split())
#: Words of class and id names of parts that may hold an article element which isn't the page's own.
FOREIGN_NAMES = frozenset(
    "ad ads adv advert adverts advertisement aside comment comments disqus promo promoted promotion recommended related "
    "replies reply respond sidebar sponsor sponsored sponsors teaser teasers widget widgets hidden".split()
)
CHROME_NAMES = FOREIGN_NAMES | frozenset(
    "alert banner breadcrumb breadcrumbs consent cookie cookies copyright disclaimer footer form gdpr header legal login "
    "masthead menu menus modal nav navbar navigation newsletter notice notices overlay pager pagination popup search share "
    "sharing signup skip social subscribe tags toast toolbar topbar".split()
)
#: Words that say nothing of the part; a name made of others besides those above is only a hint.
NEUTRAL_NAMES = frozenset(
    "area bar block bottom box buttons col column container content div group icons inner item items left links list main "
    "outer page panel posts primary right row secondary section site text thread top view wrap wrapper".split()
)
MAIN_NAMES = frozenset("article content entry main post story body".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Elements whose blocks are running text, and entries of lists and tables.
TEXT_TAGS = frozenset("p blockquote pre figcaption h1 h2 h3 h4 h5 h6".split())
ENTRY_TAGS = frozenset("li dd dt td th caption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([A-Za-z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=\s|/|\Z)", re.I)
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    """Text between two block boundaries with what is known of its place.

    ``tags`` and ``names``: 2 in an element that is no part of the article for certain, by
    its tag or by its class, id or role; 1 where that is only a hint; 0 else.  ``kind``: 2
    running text, 1 an entry of a list or table, 0 any other.
    """

    text: str
    words: int
    linked: int
    tags: int
    names: int
    main: bool
    kind: int
    heading: bool


@dataclass(slots=True)
class _Open:
    tag: str
    tags: int = 0
    names: int = 0
    foreign: bool = False
    main: bool = False


def _name_mark(value: str) -> tuple[int, bool, bool]:
    """Mark of a class or id attribute, whether an article inside isn't the page's, whether it names the article."""
    mark, foreign, main = 0, False, False
    for name in value.split():
        parts = _WORD.findall(name)
        if any(p in CHROME_NAMES for p in parts):
            certain = all(p in CHROME_NAMES or p in NEUTRAL_NAMES or p in MAIN_NAMES for p in parts)
            mark = max(mark, 2 if certain else 1)
            foreign = foreign or (certain and any(p in FOREIGN_NAMES for p in parts))
        elif any(p in MAIN_NAMES for p in parts):
            main = True
    return mark, foreign, main


def _place(tag: str, attributes: str, outer: _Open) -> _Open:
    """The place that an element makes; an article of the page's own, and any main element, begins afresh."""
    own = _Open(tag, outer.tags, outer.names, outer.foreign, outer.main)
    if tag in MAIN_TAGS and (tag == "main" or not outer.foreign):
        own = _Open(tag, main=True)
    elif tag in CHROME_TAGS:
        own.tags = 2
        own.foreign = own.foreign or tag in ("nav", "footer", "aside", "menu")
    elif tag in WEAK_TAGS:
        own.tags = max(own.tags, 1)
    for name, a, b, c in _NAMES.findall(attributes) if attributes else ():
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id") and tag not in ("body", "html"):
            mark, foreign, main = _name_mark(value)
            if tag in MAIN_TAGS:
                mark = 2 if foreign else 0
            own.names, own.foreign, own.main = max(own.names, mark), own.foreign or foreign, own.main or main
        elif name == "role":
            if value in CHROME_ROLES:
                own.names = 2
            elif value == "main" or (value == "article" and not outer.foreign):
                own = _Open(tag, main=True)
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
            own.names, own.foreign = 2, True
    return own


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order; scripts, styles and comments hold none.  Linear in the page."""
    out: list[Block] = []
    stack = [_Open("")]
    opened: Counter[str] = Counter()  # elements on the stack by tag
    unclosed: set[str] = set()  # raw tags without an end tag from here on
    pieces: list[str] = []
    linked = 0
    kind = ""
    at, end = 0, len(page)

    def close() -> None:
        nonlocal linked
        if pieces:
            text = _SPACE.sub(" ", html.unescape("".join(pieces))).strip()
            if text:
                n = text.count(" ") + 1
                place = stack[-1]
                level = 2 if kind in TEXT_TAGS else 1 if kind in ENTRY_TAGS else 0
                out.append(Block(text, n, min(linked, n), place.tags, place.names, place.main, level, kind in HEADINGS))
            pieces.clear()
        linked = 0

    def drop(depth: int) -> None:
        opened.subtract(x.tag for x in stack[depth:])
        del stack[depth:]

    while at < end:
        found = _TOKEN.search(page, at)
        if found is None:
            pieces.append(page[at:])
            break
        if found.start() > at:
            text = page[at : found.start()]
            pieces.append(text)
            if opened["a"] > 0:
                linked += len(text.split())
        at = found.end()
        tag = found[2]
        if tag is None:
            if found[0].startswith("<![CDATA["):
                pieces.append(html.escape(found[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if found[1]:  # an end tag closes what it opened and all inside; one without a start tag closes nothing
            if tag in BLOCK_TAGS:
                close()
                kind = ""
            if opened[tag] > 0:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        drop(depth)
                        break
                    if tag not in BLOCK_TAGS and stack[depth].tag in BLOCK_TAGS:
                        break
            continue
        attributes = found[3] or ""
        if tag in RAW_TAGS and tag not in unclosed and not attributes.rstrip().endswith("/"):
            close_tag = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, at)
            if close_tag or tag in ("script", "style"):
                at = (page.find(">", close_tag.start()) + 1 if close_tag else end) or end
                continue
            unclosed.add(tag)
        if tag == "br":
            pieces.append(" ")
        if tag in BLOCK_TAGS:
            close()
            kind = tag
            if tag == "p" or tag == "li":  # an open paragraph ends here
                for depth in range(len(stack) - 1, 0, -1) if opened[tag] > 0 else ():
                    if stack[depth].tag == tag:
                        drop(depth)
                        break
                    if stack[depth].tag in BLOCK_TAGS:
                        break
        if tag not in VOID_TAGS and not attributes.endswith("/"):
            if tag in BLOCK_TAGS or tag in CHROME_TAGS or tag in WEAK_TAGS or tag in ("a", "span"):
                stack.append(_place(tag, attributes, stack[-1]))
                opened[tag] += 1
    close()
    return out


FEATURES = ("words", "link density", "previous words", "previous link density", "next words", "next link density",
            "tags", "names", "in main", "page has main", "kind", "heading")


def features(page_blocks: list[Block]) -> np.ndarray:
    """A row of FEATURES for each block; beyond the page's ends lie empty blocks."""
    n = len(page_blocks)
    words = np.array([0, *(b.words for b in page_blocks), 0], float)
    density = np.array([0, *(b.linked / b.words for b in page_blocks), 0], float)
    main = np.array([b.main for b in page_blocks], float)
    sure = [b.main and b.tags < 2 and b.names < 2 for b in page_blocks]
    return np.column_stack(
        [words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:],
         [b.tags for b in page_blocks], [b.names for b in page_blocks], main, np.full(n, float(any(sure))),
         [b.kind for b in page_blocks], [b.heading for b in page_blocks]]
    )


# The labelled pages, with 1 for each block of the article and 0 for each other block, in page order.
_S = "A sentence of some length, as articles have them, that says one thing after the other until it is told. "
_M = "This one is shorter but still runs on for a while."
_MENU = "<ul><li><a href=1>Home</a></li><li><a href=2>News of the day</a></li><li><a href=3>Contact</a></li></ul>"
LABELLED = (
    # a marked article between menu, advert and footer
    (f"<nav>{_MENU}</nav><div class=ad>{_M}</div><article><h1>A title</h1><p>{_S * 3}</p><p>{_S}<a href=4>a link</a></p><p>Yes.</p></article><footer>Imprint and rights</footer>",
     "000011110"),
    (f"<header><h1>The site</h1><p>{_M}</p></header><main><h2>Title</h2><p>{_M}</p><ul><li>one</li><li>two words</li></ul><p>{_S * 9}</p></main><footer><p>{_S}</p></footer>",
     "00111110"),
    # notices, adverts, comments, forms and sidebars inside and outside of a marked article
    (f"<div class=cookie-notice><p>{_S}</p></div><div class=site-header><p>{_M}</p></div><article><h1>Title</h1><p>{_S}</p><div class=ad>{_M}</div><p>{_M}</p><aside>{_M}</aside></article><div class=comments><p>{_S}</p><p>{_M}</p></div>",
     "001101000"),
    (f"<article><h1>T</h1><p>{_S}</p><form><label>Your name</label><p>{_M}</p></form><section class=related-posts><h2>More</h2><p>{_S}</p></section></article><aside><h2>Aside</h2><p>{_S}</p></aside>",
     "11000000"),
    (f"<article><h1>T</h1><p>{_S}</p><nav><a href=1>Next page of it</a></nav><footer><p>{_M}</p></footer><div class='share-buttons'>Share this</div><p>{_S}</p><div id=comments><h3>Two replies</h3><p>{_S * 2}</p></div></article>",
     "11000100"),
    # hints alone don't take text out of a marked article
    (f"<div class='wrap header-fixed'><article><h1>Title</h1><p>{_S}</p></article></div>", "11"),
    (f"<main><div class=search-results><h2>Found</h2><p>{_S}</p><p>{_M}</p><div>{_M}</div></div></main>", "1111"),
    (f"<article><section class=notice-of-law><p>{_S * 2}</p><p>{_M}</p><div>{_S}</div></section><p>{_S}</p></article>", "1111"),
    (f"<article><header><h1>Title of it</h1><div>By someone</div></header><p>{_S}</p></article>", "101"),
    (f"<article><header><h2>The head</h2><p>By a person</p></header><p>{_M}</p><p>{_S}</p></article>", "1011"),
    (f"<main><header><h1>Head</h1></header><div>{_S * 2}</div></main><header><h2>Site of this and that</h2></header>", "110"),
    (f"<article><fieldset><p>{_S}</p></fieldset><table><tr><td>cell</td><td>{_M}</td></tr></table><pre>some code</pre><blockquote>{_M}</blockquote></article>", "11111"),
    (f"<main><div>{_S}</div><div>{_M}</div><div>Two words</div><p><a href=1>a linked paragraph</a></p><p>{_S}</p></main>", "11111"),
    (f"<article><h2><a href=1>A linked title</a></h2><ul><li><a href=1>a linked entry</a></li><li>plain {_M}</li></ul><p>{_S}</p></article>", "1111"),
    # text beside a marked article
    (f"<div>{_M}</div><p>{_S}</p><article><h1>T</h1><p>{_S}</p><p>{_M}</p></article><p>{_M}</p><div>{_S}</div><h3>Other</h3><ul><li>entry</li></ul>", "001110000"),
    # pages without a marked article
    (f"<div>{_MENU}</div><h1>News</h1><p>{_S}</p><p>Short one.</p><p>Yes.</p><p>{_S * 2}</p><div id=sidebar><p>{_S}</p></div><div>{_MENU}</div>", "000111110000"),
    (f"<div><a href=1>Home</a> <a href=2>About</a></div><div>{_S * 2}</div><div>{_S}</div><div>{_M}</div><div>Home</div>", "01110"),
    (f"<h1>Title</h1><p>One.</p><p>{_M}</p><ul><li>first point</li><li>second point</li></ul><p>{_S}</p>", "111111"),
    (f"<div class=header>{_M}</div><h2>Head</h2><p>{_S}</p><blockquote>{_M}</blockquote><div class=footer>{_M}</div><form><p>{_S}</p></form>", "011100"),
    (f"<div>Menu</div><div><a href=1>Log in</a></div><h1>Head</h1><div>{_S * 4}</div><div>{_S}<a href=1>more of it</a></div><div>Top</div>", "001110"),
    (f"<p><a href=1>one</a> <a href=2>two</a> <a href=3>three</a></p><h2>Head</h2><p>{_S}</p><p><a href=5>See all of the other news that we have</a></p>", "0110"),
    (f"<header><h1>Site</h1></header><p>{_S}</p><table><tr><td>A cell</td><td>{_M}</td></tr></table><h3>Part</h3><p>End.</p><footer><p>{_M}</p></footer>", "0111110"),
    (f"<h1>A page of one line</h1><p>{_M}</p>", "11"),
    (f"<div class=page-header-box><p>{_S}</p></div><div class=news-share-page><p>{_S}</p></div><p>{_S}</p>", "011"),
    # pages without any article
    (f"<nav>{_MENU}</nav><footer>The end</footer>", "0000"),
    (f"<form><p>{_M}</p><label>Name</label></form><div class=login>{_M}</div>", "000"),
)


class DecisionTree:
    """Binary splits of least Gini impurity, grown until the leaves are pure (or ``depth`` is reached)."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, depth: int = 8):
        self.label, self.split = float(labels.mean()), None
        if depth == 0 or self.label in (0.0, 1.0):
            return
        best = None
        for feature in range(rows.shape[1]):
            values = np.unique(rows[:, feature])
            for cut in (values[1:] + values[:-1]) / 2:
                left = rows[:, feature] <= cut
                p, q = labels[left], labels[~left]
                impurity = len(p) * p.mean() * (1 - p.mean()) + len(q) * q.mean() * (1 - q.mean())
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, feature, cut, left)
        if best:
            _, feature, cut, left = best
            self.split = (feature, cut)
            self.low = DecisionTree(rows[left], labels[left], depth - 1)
            self.high = DecisionTree(rows[~left], labels[~left], depth - 1)

    def predict(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.label)
        if self.split and len(rows):
            feature, cut = self.split
            low = rows[:, feature] <= cut
            out[low] = self.low.predict(rows[low])
            out[~low] = self.high.predict(rows[~low])
        return out


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of the labelled pages."""
    rows = [features(blocks(page)) for page, _ in LABELLED]
    return np.concatenate(rows), np.array([float(c) for _, labels in LABELLED for c in labels])


def trained_tree() -> DecisionTree:
    return DecisionTree(*labelled_table(), depth=12)


def main_text(page: str | None, tree: DecisionTree) -> str:
    """The article's blocks, one a line."""
    found = blocks(page or "")
    if not found:
        return ""
    keep = tree.predict(features(found)) >= 0.5
    return "\n".join(b.text for b, kept in zip(found, keep) if kept)


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text``: the main text of the whole html (a column of that name is replaced).

    Null or empty html and pages without an article give an empty text.  Character
    references are decoded, white space inside a block becomes one space.  Rows that
    repeat are extracted each; an empty table gives no rows.
    """
    tree = trained_tree()
    others = [f for f in pages.schema.fields if f.name != "text"]
    names = [f.name for f in others]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = [main_text(x, tree) for x in part.column(html_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(texts, pa.string())], names=[*names, "text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return map_texts(pages.select(*names), run, f"{schema}, text string")


def op9_html_extraction(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
