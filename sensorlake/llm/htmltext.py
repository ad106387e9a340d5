"""Main text of web pages by two passes over their blocks.

The first pass decides blocks by themselves: zones that are no article (menus, headers,
footers, sidebars, adverts, notices, forms, reader comments) and blocks full of links are
out; blocks long enough that hold enough stop words are in. The second pass gives every
block still open (a short one, or one with few stop words) the label of the nearest
decided block within the same element. An element without a decided block looks at the
nearest ones around it in its article, or in the page outside all articles, whose borders
count as decided, too: in for an article, out for the page. Pages that mark their article
keep only blocks of it, others are judged by the two passes alone.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from sensorlake.llm.common import bounded_batches, pieces_of, without

# Frequent function words of English, French, German, Spanish, Italian, Portuguese.
STOP_WORDS = frozenset("""
the of and to in a is that it for was on are as with be at by this have from or an not but
de la le les et des du une en un que dans est pour qui sur au par pas plus avec
der die das und zu den mit von ist im dem nicht ein eine auf als auch es sich
el los las y del se por con una su para lo como al
il di che per sono della non
o e os da em um uma com
""".split())

# Elements that end a block, those whose content is no text, those that make a zone.
BLOCKS = frozenset("""
address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td
tfoot th thead tr ul
""".split())
SILENT = ("script", "style", "noscript", "template", "title", "textarea", "select", "button", "datalist", "iframe",
          "object", "svg", "canvas", "audio", "video")
HEAD = frozenset(("head", "meta", "link", "base", *SILENT))
OUTSIDE = frozenset(("nav", "aside", "footer", "form", "dialog", "menu"))
NESTING = frozenset("article aside body center details dialog div dl fieldset figure footer form header main menu nav ol "
                    "section table td th tr ul".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# Words of class, id or role that name a zone which is no article.
ZONE_WORDS = frozenset("""
ad ads adv advert advertisement adverts advertising adsense sponsor sponsored promo promotion banner
cookie cookies consent gdpr notice notices notification alert popup modal overlay disclaimer
newsletter subscribe subscription signup login search form
sidebar widget widgets related recommended recommendations complementary trending
menu nav navbar navigation breadcrumb breadcrumbs toolbar pagination pager contentinfo
header masthead footer comment comments commentlist disqus respond replies reply share sharing social
""".split())
COMMENT_WORDS = frozenset(("comment", "comments", "commentlist", "reply", "disqus"))
# Parts of a name that turn it into a remark about the layout, e.g. has-sidebar.
REMARKS = frozenset(("has", "with", "without", "no", "not", "is", "hide", "show"))

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>"""
                   r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.DOTALL)
NAMES = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|[\s"'])(?:hidden(?=[\s/=]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""",
                    re.IGNORECASE)
ENDS = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.IGNORECASE) for name in SILENT}
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Rules:
    """Limits of the first pass: characters, and shares of stop words and of linked characters."""

    short: int = 70
    stop_words: float = 0.15
    links: float = 0.33


@dataclass
class Block:
    """Text of a block with what the passes look at; ``kept`` is None while undecided."""

    text: str
    linked: int
    tag: str
    article: int
    outside: bool
    parent: int
    kept: bool | None = None


def zone_of(attributes: str) -> set[str]:
    """Zone words in an element's class, id and role."""
    found = set()
    for name, value in NAMES.findall(attributes):
        for word in value.strip("\"'").split():
            pieces = [p for p in re.split(r"[^a-z0-9]+", CAMEL.sub("-", word).lower()) if p]
            if pieces and pieces[0] not in REMARKS:
                found |= {pieces[0], pieces[-1]} & ZONE_WORDS
    return found


class Reader:
    """Blocks of one page. Tags may be missing, crossed or cut off."""

    def __init__(self, page: str):
        self.page, self.blocks, self.articles = page, [], 0
        self.main: set[int] = set()
        self.nested: list[tuple[str, int, bool, int]] = []
        self.place = (0, False, 0)
        self.elements = 0
        self.parts: list[str] = []
        self.tag, self.links, self.linked = "body", 0, 0
        self.at = 0
        self.read()

    def read(self) -> None:
        page, head = self.page, False
        while True:
            token = TOKEN.search(page, self.at)
            if not head:
                self.add(page[self.at:token.start() if token else len(page)])
            if token is None:
                break
            self.at = token.end()
            closing, name, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
            if not name:
                continue
            name = name.lower()
            if name == "head":
                head = not closing
            elif head and name not in HEAD:
                head = False
            if closing:
                self.close(name)
            else:
                self.open(name, attributes)
        self.end_block()

    def add(self, raw: str) -> None:
        if raw:
            text = html.unescape(raw)
            self.parts.append(text)
            if self.links:
                self.linked += len("".join(text.split()))

    def end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(text, self.linked, self.tag, *self.place))
        self.parts, self.linked = [], 0

    def open(self, name: str, attributes: str) -> None:
        if name in SILENT:
            if attributes.endswith("/") and name in ("svg", "object", "iframe"):
                return
            end = ENDS[name].search(self.page, self.at)
            self.at = end.start() if end else len(self.page)
            return
        if name == "a":
            self.links = 1
        elif name == "br":
            self.parts.append(" ")
        if name in BLOCKS:
            self.end_block()
            self.tag, self.links = name, 0
        if name in NESTING:
            self.nested.append((name, *self.place))
            self.elements += 1
            self.place = (*self.inside(name, attributes), self.elements)

    def inside(self, name: str, attributes: str) -> tuple[int, bool]:
        """(article, outside) of what an element holds."""
        article, outside, _ = self.place
        zone = zone_of(attributes) if attributes else set()
        hidden = bool(attributes and HIDDEN.search(attributes))
        if name in ("article", "main") and not hidden and not zone & COMMENT_WORDS:
            # An article within a sidebar, menu or footer is a teaser; a page's form or frame may hold the article.
            held = any(n in ("aside", "nav", "footer", "menu", "dialog") for n, *_ in self.nested[:-1])
            if name == "main" or not held and not (outside and article):
                if article and not outside and name == "article" and article not in self.main:
                    return article, False
                self.articles += 1
                if name == "main":
                    self.main.add(self.articles)
                return self.articles, False
        if name == "body" or name == "main":
            return article, outside
        if name in OUTSIDE or name == "header" and not article or zone or hidden:
            return article, True
        return article, outside

    def close(self, name: str) -> None:
        if name == "a":
            self.links = 0
        if name in BLOCKS:
            self.end_block()
            self.tag, self.links = "body", 0
        if name in NESTING:
            for i in range(len(self.nested) - 1, -1, -1):
                other = self.nested[i][0]
                if other == name:
                    self.place = self.nested[i][1:]
                    del self.nested[i:]
                    break
                # A stray end tag closes nothing beyond the section that it stands in.
                if other in ("article", "main", "aside", "nav", "form", "body") and name not in ("body", "main", "article"):
                    break


def stop_share(text: str) -> float:
    words = WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def first_pass(blocks: list[Block], rules: Rules) -> None:
    """Decide the blocks that can be judged by themselves."""
    for block in blocks:
        size = len(block.text.replace(" ", ""))
        if block.outside or block.linked > rules.links * size:
            block.kept = False
        elif len(block.text) >= rules.short and stop_share(block.text) >= rules.stop_words:
            block.kept = True


def inherit(blocks: list[Block], edge: bool | None) -> None:
    """Give undecided blocks the label of the nearest decided one; ``edge`` stands at both ends.

    Between a kept and a dropped neighbour at one distance, a block of an article, a
    paragraph and a heading before a kept block are kept.
    """
    def nearest(order: list[Block]) -> list[tuple[int, bool | None]]:
        found, near = [], (0, edge)
        for label in [b.kept for b in order]:
            near = (near[0] + 1, near[1]) if label is None else (0, label)
            found.append(near)
        return found

    sides = list(zip(blocks, nearest(blocks), nearest(blocks[::-1])[::-1]))
    for block, (left, before), (right, after) in sides:
        if block.kept is not None:
            continue
        if before is None or after is None or before == after:
            block.kept = after if before is None else before
        elif left != right:
            block.kept = before if left < right else after
        else:
            block.kept = block.article > 0 or block.tag == "p" or after and block.tag in HEADINGS


def second_pass(blocks: list[Block]) -> None:
    """Label the blocks that the first pass left open, within their element, then their article."""
    parents: dict[tuple[int, int], list[Block]] = {}
    articles: dict[int, list[Block]] = {}
    for block in blocks:
        if not block.outside:
            parents.setdefault((block.article, block.parent), []).append(block)
            articles.setdefault(block.article, []).append(block)
    for own in parents.values():
        inherit(own, None)
    for article, own in articles.items():
        inherit(own, article > 0 or all(b.kept is None for b in own))


def classify(page: str | None, rules: Rules = Rules()) -> list[Block]:
    """All blocks of a page in its order, each with its label."""
    reader = Reader(page or "")
    blocks = reader.blocks
    first_pass(blocks, rules)
    second_pass(blocks)
    held = {b.article for b in blocks if b.kept and b.article}
    # An article element says more than the main element around it.
    chosen = held - reader.main or held
    if chosen:
        for block in blocks:
            block.kept = bool(block.kept) and block.article in chosen
    return blocks


def main_text(page: str | None, rules: Rules = Rules()) -> str:
    return " ".join(b.text for b in classify(page, rules) if b.kept)


def extract_main_text(pages: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``pages`` with ``text`` (string) and ``n_chars`` (long, code points), read from ``html``.

    A null or empty page has an empty text and 0 characters; a page without tags is one
    block of text. Repeated rows are repeated; columns of ``pages`` named like a result column
    are replaced; an empty table gives an empty result.
    """
    bounded_batches(pages.sparkSession)
    rows = without(pages, "text", "n_chars").withColumn("html", F.col("html").cast("string"))
    out = rows.selectExpr("*", "'' AS text").schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces_of(batch, "html"):
                texts = [main_text(page.as_py(), rules) for page in piece.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [*[c.cast(f.type) for c, f in zip(piece.columns, arrow)], pa.array(texts, arrow.field("text").type)],
                    schema=arrow)

    return rows.mapInArrow(run, out).withColumn("n_chars", F.length("text").cast("long"))
