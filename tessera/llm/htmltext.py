"""Main text of a web page.

A page becomes a flat list of text blocks. Each has its number of words, its
link density and those of the blocks before and after it, and what its open
elements say (navigation, footer, advert, form, article, heading). A decision
tree trained on a small labelled table of blocks keeps or drops each one.

Pages are parsed in Python tasks; the fitted tree becomes one DataFrame
expression over the array of blocks, so that nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html.parser import HTMLParser

from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import map_texts, quoted

FEATURES = ["words", "links", "prev_words", "prev_links", "next_words", "next_links", "boilerplate", "article", "heading"]
BLOCK = "struct<text:string," + ",".join(f"{f}:double" for f in FEATURES) + ">"

#: Elements that begin and end a block.
_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre search section select "
    "summary table tbody td textarea tfoot th thead tr ul".split())
#: Elements whose content is never text of the page.
_SILENT = frozenset("head script style noscript template title svg math iframe object canvas audio video".split())
#: Elements that may stand in a head; any other one ends it.
_IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: Elements and name parts (class, id, role) of boilerplate.
_FRAME = frozenset("nav header footer aside form menu dialog button select textarea search".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NAMES = re.compile(
    r"(?<![a-z])(ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|header|masthead|footer|foot|"
    r"side-?bar|aside|widget|related|recommend\w*|share|sharing|social|comments?|commentlist|replies|reply|respond|disqus|"
    r"notice|cookies?|consent|gdpr|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|search|"
    r"copyright|legal|disclaimer|pagination|pager|toolbar|skip\w*|alert)(?![a-z])")
#: Layout words that tell of a part elsewhere on the page, not of the element that bears them.
_LAYOUT = re.compile(r"(?<![a-z])(has|no|with|without)[-_][a-z_-]*|[a-z_-]+[-_](wrap|wrapper|container|layout|page|wide)(?![a-z])|"
                     r"(?<![a-z])(wrap|wrapper|container|layout|page)[-_][a-z_-]*")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
#: Decimal references that may have more digits than Python reads as a number.
_LONG_REFERENCE = re.compile(r"&#([0-9]{1000,})")
#: Elements that end an open paragraph.
_ENDS_P = _BLOCKS - {"body", "html", "button", "option", "select", "textarea", "caption", "legend", "summary", "tbody", "td", "tfoot", "th", "thead", "tr"}


class _Blocks(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        #: Open elements: (tag, silent, frame, named, article, heading, link); frame by an element, named by a name around the text
        self.open: list[tuple] = [("", False, False, False, False, False, False)]
        #: Places of the open elements by name, and under "*" those of the blocks.
        self.at: defaultdict[str, list[int]] = defaultdict(list)
        self.text: list[str] = []
        self.linked: list[str] = []
        self.flags = (0.0, 0.0, 0.0)
        self.blank = True
        self.blocks: list[list] = []

    def cut(self) -> None:
        """End the present block."""
        words = "".join(self.text).split()
        if words:
            links = len("".join(self.linked).split())
            self.blocks.append([" ".join(words), float(len(words)), min(1.0, links / len(words)), *self.flags])
        self.text, self.linked, self.blank = [], [], True

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # no section that the parser knows: a comment up to ">"
            return self.parse_bogus_comment(i)

    def end_head(self) -> None:
        """End every open head; it may lack its end tag."""
        while self.at["head"]:
            self._close("head")

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "body" or (tag not in _IN_HEAD and self.open[-1][0] == "head"):
            self.end_head()
        if tag in _BLOCKS:
            self.cut()
            if tag in _ENDS_P:
                self._close("p", stop=("td", "th", "li", "div", "article", "section", "body", "button", "form"))
            if tag == "li":
                self._close("li", stop=("ul", "ol", "menu"))
        elif tag == "br":
            self.handle_data(" ")
        if tag in _VOID:
            return
        _, silent, frame, named, article, heading, link = self.open[-1]
        given, content = dict(attrs), tag in ("article", "main")
        names = _LAYOUT.sub(" ", " ".join((given.get(k) or "") for k in ("class", "id", "role")).lower())
        hidden = "hidden" in given or given.get("aria-hidden") == "true" or bool(_HIDDEN.search(given.get("style") or ""))
        for name in (tag, "*") if tag in _BLOCKS else (tag,):
            self.at[name].append(len(self.open))
        self.open.append((
            tag, silent or tag in _SILENT or hidden,
            frame or tag in _FRAME, not content and (named or (tag not in ("html", "body") and bool(_NAMES.search(names)))),
            article or content, heading or tag in ("h1", "h2", "h3", "h4", "h5", "h6"), link or tag == "a"))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # "<div/>" opens a div

    def _close(self, tag: str, stop: tuple[str, ...] = ()) -> None:
        """End the last open element of this name, unless one of ``stop`` began in it."""
        at = self.at
        if not at[tag] or any(at[s] and at[s][-1] > at[tag][-1] for s in stop):
            return
        k = at[tag][-1]
        for name, *_ in self.open[k:]:
            at[name].pop()
            if name in _BLOCKS:
                at["*"].pop()
        del self.open[k:]

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCKS:
            self.cut()
        elif tag == "br":
            self.handle_data(" ")
        self._close(tag, stop=() if tag in _BLOCKS or tag in _SILENT else ("*",))

    def handle_data(self, data: str) -> None:
        if self.open[-1][0] == "head" and data.strip():
            self.end_head()
        _, silent, frame, named, article, heading, link = self.open[-1]
        if silent:
            return
        if self.blank:  # the first visible text decides
            self.flags = (float(frame or named), float(article), float(heading))
            self.blank = not data.strip()
        self.text.append(data)
        if link:
            self.linked.append(data + " ")


def _short_reference(found: re.Match) -> str:
    """The same character in few digits; what is no character stays none."""
    digits = found[1].lstrip("0")
    return f"&#{digits or 0}" if len(digits) <= 7 else f"&#{0x110000}"


def _ended(html: str) -> str:
    """Unfinished markup as text: a ``<`` behind the last ``>``, and a comment
    behind the last ``-->`` as a declaration up to ``>``. The parser would
    search for each one's end up to the end of the page."""
    tags, comments = html.rfind(">") + 1, html.rfind("-->") + 1
    head, middle, tail = html[:comments], html[comments:max(tags, comments)], html[max(tags, comments):]
    return head + middle.replace("<!--", "<!") + tail.replace("<", "&lt;")


def blocks(html: str | None) -> list[tuple]:
    """Blocks of a page in order, as ``(text, *FEATURES)``. None and pages
    without text have none; unknown declarations are comments up to ``>``, and
    a tag that the page does not end is text."""
    if not html:
        return []
    p = _Blocks()
    p.feed(_LONG_REFERENCE.sub(_short_reference, _ended(html)))
    p.close()
    p.cut()
    own = p.blocks
    side = lambda k: own[k][1:3] if 0 <= k < len(own) else [0.0, 0.0]
    return [(b[0], b[1], b[2], *side(k - 1), *side(k + 1), *b[3:]) for k, b in enumerate(own)]


#: Small labelled table: pages whose kept blocks are marked by a plus sign.
LABELLED = (
    '<body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><div class="ad">Buy two lamps and '
    'get a third one for half the price today.</div><article><h1>+ Rain in the north</h1><p>+ It rained for nine days and the '
    'river rose above the old bridge before the town could close it.</p><p>+ Short.</p><p>+ See <a href="/x">the report</a> '
    'for more.</p></article><footer>&copy; 2020 The Paper. All rights reserved by the owners of this site.</footer></body>',
    '<body><header><h1>The Daily Example</h1><p>News for the whole family since the year of the flood</p></header><main><h2>+ '
    'Bread</h2><p>+ Mix flour, water and salt and let the dough rest until it has doubled in size.</p><ul><li>+ Flour</li><li>'
    '+ Salt</li></ul><aside><p>You may also like our long list of cakes for every season of the year.</p></aside><p>+ Bake it '
    'hot.</p></main><div id="comments"><p>I tried this at home and the whole family liked it a lot, thanks.</p></div></body>',
    '<body><div class="menu"><a href="/1">One</a> <a href="/2">Two</a> <a href="/3">Three</a></div><div class="post"><p>+ A plain '
    'page has no article element, yet its long paragraphs of prose stand next to one another.</p><p>+ The next one is about as '
    'long as the first, and holds <a href="/q">one link</a> among its many words.</p></div><div><a href="/p">Previous</a> <a '
    'href="/n">Next</a></div><div class="cookie-notice">We use cookies to make this site work well for you and others.</div>',
    '<body><article><header><p>By a writer, on a Monday in the month of May</p></header><p>+ One.</p><p>+ Two words.</p><form>'
    '<label>Your address</label><p>Sign up to get one letter from us each week of the year</p></form><div class="sidebar"><p>'
    'Older stories that other readers of this page have liked</p></div><p>+ And the last part of the story ends right here.</p>'
    '</article><section class="comments"><p>+1</p></section><footer><p>Contact us by mail or at the desk.</p></footer></body>',
    '<body><div><a href="/a">All</a> | <a href="/b">Top</a> | <a href="/c">New</a></div><div><h1>+ Notes on a walk through the '
    'hills</h1><p>+ We left early and walked along the ridge while the sun came up over the sea.</p><p>+ By noon it had grown '
    'too hot, so we slept under a tree until the wind came back.</p></div><div>Tags: <a href="/t">hills</a> <a href="/s">sea</a>'
    '</div><div class="ad">Good boots for bad roads, now at every shop near you.</div></body>',
)


def labelled_blocks() -> list[tuple]:
    """The labelled table: a feature vector and 1.0 (keep) or 0.0 for each block."""
    return [(list(b[1:]), 1.0 if b[0].startswith("+ ") else 0.0) for page in LABELLED for b in blocks(page)]


def fit(spark: SparkSession, labelled: list[tuple] | None = None, depth: int = 5) -> DecisionTreeClassificationModel:
    """Train the tree on ``(features, label)`` rows, by default ``labelled_blocks()``."""
    rows = spark.createDataFrame(labelled or labelled_blocks(), "f array<double>, label double")
    tree = DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=1, seed=7)
    return tree.fit(rows.select(array_to_vector("f").alias("features"), "label").coalesce(1))


def tree_column(model: DecisionTreeClassificationModel, block: Column) -> Column:
    """The tree's decision for a block struct, as one expression."""

    def of(node) -> Column:
        if node.subtreeDepth() == 0:
            return F.lit(node.prediction() == 1.0)
        split = node.split()
        return F.when(block[FEATURES[split.featureIndex()]] <= float(split.threshold()), of(node.leftChild())).otherwise(of(node.rightChild()))

    return of(model._java_obj.rootNode())


def _parse():
    names = ["text", *FEATURES]
    return lambda html: ([dict(zip(names, b)) for b in blocks(html)],)


def extract(pages: DataFrame, model: DecisionTreeClassificationModel, html_col: str = "html", keep: tuple[str, ...] = (),
            text_out: str = "text") -> DataFrame:
    """One row per row: the columns ``keep`` and the kept blocks, one a line.

    Null and empty pages and pages without a kept block give the empty text.
    Very long pages are parsed whole, in time that grows with their length.
    Repeated rows give repeated rows. Columns that are not kept are not read,
    and no kept name clashes with one used here. No rows give no rows."""
    blocks_out = "__blocks" + "_" * max((len(k) for k in keep), default=0)  # longer than any kept name
    parsed = map_texts(pages, keep, pages[html_col], _parse, f"{blocks_out} array<{BLOCK}>")
    kept = F.filter(blocks_out, lambda b: tree_column(model, b))
    return parsed.select(*quoted(keep), F.array_join(F.transform(kept, lambda b: b["text"]), "\n").alias(text_out))
