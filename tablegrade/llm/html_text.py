"""Main text of web pages: flat text blocks classified by a decision tree.

A page is read as a flat list of text blocks, parted wherever a block-level tag starts or ends. A block is described by its number of
words and its link density (the share of its words inside links), by the same figures of the blocks before and after it, and
by whether it stands in an element that names itself an article or something else than one. A decision tree trained on
the small labelled pages below tells main text from the rest.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pandas as pd
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegrade.llm.common import col, small_batches, table

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.DOTALL,
)
_NAMES = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_LABEL = re.compile(r"\bdata-main\b")

#: Elements whose content is no text of the page.
SKIPPED = {"script", "style", "noscript", "template", "textarea", "select", "iframe", "svg", "math", "object", "title", "head", "canvas", "audio", "video"}
#: Of these, elements whose content runs to the page's end if they aren't closed.
TO_THE_END = {"script", "style", "textarea", "title"}
#: Elements with another purpose than main text.
OTHER = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "fieldset"}
MAIN = {"article", "main"}
#: Elements without an end tag.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that don't part blocks.
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
    "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
#: Words in classes, ids and roles of elements with another purpose.
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|"
    r"comments?|replies|disqus|respond|sidebar|widget|nav\w*|menu|breadcrumbs?|pagination|pager|footer|header|masthead|copyright|legal|"
    r"share|sharing|social|related|recommended|search|login|signup|complementary|contentinfo|navigation|tags?)(?=$|[\s_-])",
    re.IGNORECASE,
)

#: Classes of single reader comments, which are often articles of their own; looked for in whole class names.
COMMENT = re.compile(r"(?:^|\s)(?:comments?|comment[_-](?!open|closed|status)[\w-]+|repl(?:y|ies)|review|respond)(?=$|\s)", re.IGNORECASE)
#: A part of the main text may have a header.
HEADER = re.compile(r"(?<![a-z])header(?![a-z])", re.IGNORECASE)

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "main", "other"]


@dataclass
class Block:
    text: str
    words: int
    links: float
    main: bool
    other: bool
    label: bool = False


@dataclass
class _Open:
    """An element that was opened: its name and what it changes."""

    name: str
    main: bool
    other: bool
    label: bool
    comment: bool = False


@dataclass
class Reader:
    """Reads a page into blocks."""

    blocks: list[Block] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    opened: list[_Open] = field(default_factory=list)
    in_link: bool = False

    def flush(self) -> None:
        text = " ".join(html.unescape("".join(self.parts)).split())
        if text:
            words = len(text.split())
            linked = len(html.unescape(" ".join(self.linked)).split())
            top = self.opened[-1] if self.opened else _Open("", False, False, False)
            self.blocks.append(Block(text, words, min(1.0, linked / words), top.main, top.other, top.label))
        self.parts.clear()
        self.linked.clear()

    def text(self, piece: str) -> None:
        self.parts.append(piece)
        if self.in_link:
            self.linked.append(piece)

    def start(self, name: str, rest: str) -> None:
        if name == "a":
            self.in_link = True
        if name == "br" or name == "img":
            self.text(" ")
        if name in INLINE and not (name not in VOID and _NAMES.search(rest)):
            return
        if name not in INLINE:
            self.flush()
            self.in_link = self.in_link and name not in {"p", "div", "li", "article", "nav"}
        if name in VOID or rest.rstrip().endswith("/"):
            return
        if name in {"p", "li", "td", "th", "dt", "dd", "option"}:  # their end tags may be left out
            for i in range(len(self.opened) - 1, -1, -1):
                if self.opened[i].name == name:
                    del self.opened[i:]
                    break
                if self.opened[i].name not in INLINE and self.opened[i].name not in {"p", "dt", "dd", "td", "th"}:
                    break
        top = self.opened[-1] if self.opened else _Open("", False, False, False)
        names = " ".join(next(filter(None, m), "") for m in _NAMES.findall(rest))
        main = top.main or name in MAIN
        comment = top.comment or bool(name not in {"html", "body", "main"} and COMMENT.search(names))
        marked = HEADER.sub("", names) if top.main else names
        other = comment or (top.other and name != "article") or (name in OTHER and not (name == "header" and top.main))
        other = other or bool(name not in {"html", "body", "article", "main"} and MARKS.search(marked))
        self.opened.append(_Open(name, main, other, top.label or bool(_LABEL.search(rest)), comment))

    def end(self, name: str) -> None:
        if name == "a":
            self.in_link = False
        if name not in INLINE:
            self.flush()
        for i in range(len(self.opened) - 1, -1, -1):
            if self.opened[i].name == name:
                del self.opened[i:]
                break


def blocks_of(page: str | None) -> list[Block]:
    """The text blocks of a page in order, their character references decoded and white space made one space. Nothing is cut off: a
    page that ends inside a tag or comment loses only that tag, and an element that isn't closed only its tag, but for scripts and the like
    (``TO_THE_END``)."""
    page, reader, at = page or "", Reader(), 0
    while at < len(page):
        mark = page.find("<", at)
        if mark < 0:
            reader.text(page[at:])
            break
        if mark > at:
            reader.text(page[at:mark])
        tag = _TAG.match(page, mark)
        if tag is None:
            reader.text("<")
            at = mark + 1
            continue
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name:
            continue
        if tag["end"]:
            reader.end(name)
        elif name in SKIPPED and name != "head":
            if not tag["rest"].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                if end or name in TO_THE_END:
                    at = end.end() if end else len(page)
            reader.flush() if name in {"title", "iframe"} else None
        else:
            reader.start(name, tag["rest"])
    reader.flush()
    return reader.blocks


def features(blocks: list[Block]) -> list[list[float]]:
    """A row of ``FEATURES`` per block; beyond the page's ends stand empty blocks."""
    ends = [(0.0, 0.0)]
    near = ends + [(float(b.words), b.links) for b in blocks] + ends
    return [[*near[i + 1], *near[i], *near[i + 2], float(b.main), float(b.other)] for i, b in enumerate(blocks)]


def _filler(words: int) -> str:
    return " ".join(["lorem"] * words)


def _links(count: int, words: int = 1) -> str:
    return "".join(f'<li><a href="#">{_filler(words)}</a></li>' for _ in range(count))


def _main(*lengths: int) -> str:
    return "".join(f"<p data-main>{_filler(n)}</p>" for n in lengths)


def labelled_pages() -> list[str]:
    """The small labelled table: pages whose main blocks carry ``data-main``."""
    text = _filler
    return [
        f"<nav><ul>{_links(5)}</ul></nav><div class='ad'>{text(9)}</div><article><h1 data-main>{text(8)}</h1>{_main(40, 3, 70, 1, 25)}</article><footer>{text(7)}</footer>",
        f"<header><p>{text(4)}</p>{_links(3)}</header><main><h1 data-main>{text(6)}</h1>{_main(30, 60)}<aside>{text(30)}</aside>{_main(2, 45)}</main><footer>{text(12)}<p>{text(3)}</p></footer>",
        f"<div class='cookie-notice'>{text(25)}</div><article><h2 data-main>{text(2)}</h2>{_main(1, 2, 5)}<div class='comments'><p>{text(20)}</p><p>{text(45)}</p></div></article>",
        f"<div>{_links(8, 2)}</div><div><h1 data-main>{text(7)}</h1>{_main(50, 80, 35)}<p data-main>{text(12)}</p>{_main(40)}</div><div>{_links(6, 3)}</div><div>{text(6)}</div>",
        f"<ul>{_links(6)}</ul><h1 data-main>{text(9)}</h1>{_main(65, 20, 90)}<p>{text(4)}</p><ul>{_links(4, 4)}</ul>",
        f"<div class='sidebar'><h3>{text(2)}</h3><p>{text(35)}</p>{_links(3)}</div><main>{_main(15, 22, 4)}<form><p>{text(5)}</p></form></main><div id='footer'>{text(18)}</div>",
        f"<article>{_main(6)}<ul><li data-main>{text(3)}</li><li data-main>{text(5)}</li></ul><blockquote data-main>{text(28)}</blockquote>{_main(44)}<p data-main>{text(10)} <a href='#'>{text(3)}</a></p></article><div>{_links(5)}</div><p>{text(3)}</p>",
        f"<div>{text(3)}</div><div>{_links(7)}</div><div>{_main(120)}</div><div>{_main(85)}</div><div>{_main(28)}</div><div>{_links(2, 5)}</div><div>{text(5)}</div>",
        f"<nav>{text(3)}</nav><p>{text(5)}</p><ul>{_links(9, 2)}</ul><p>{text(2)}</p>",
        f"<article>{_main(60)}</article>",
        f"<article><h1 data-main>{text(2)}</h1>{_main(60)}</article>",
        f"<nav>{text(4)}</nav><article><h1 data-main>{text(7)}</h1>{_main(30, 4, 50, 12)}</article>",
        f"<article><h1 data-main>{text(1)}</h1>{_main(150, 2, 110, 1, 3, 130, 4, 2)}</article><footer>{text(5)}</footer>",
        f"<ul>{_links(4)}</ul><article>{_main(95, 1, 200, 4, 1, 1, 90, 3)}</article>",
        f"<main>{_main(1, 22, 100, 2, 1, 120, 4)}</main><div>{_links(3, 2)}</div>",
        f"<h1 data-main>{text(6)}</h1>{_main(40, 60)}",
        f"<ul>{_links(6)}</ul><div>{_main(90, 40, 25)}</div>",
        f"<article><h1 data-main>{text(5)}</h1>{_main(18)}</article><article><h1 data-main>{text(4)}</h1>{_main(33)}</article><aside><p>{text(50)}</p></aside>",
    ]


@dataclass
class Tree:
    """A decision tree as nested tuples ``(feature, threshold, at most, above)``; leaves are booleans."""

    root: tuple | bool

    def main(self, row: list[float]) -> bool:
        node = self.root
        while not isinstance(node, bool):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node


def train(spark: SparkSession, pages: list[str] | None = None) -> Tree:
    """The decision tree of the labelled pages."""
    rows = []
    for page in pages or labelled_pages():
        blocks = blocks_of(page)
        rows += [(*row, float(block.label)) for row, block in zip(features(blocks), blocks, strict=True)]
    frame = spark.createDataFrame(rows, [*FEATURES, "label"])
    given = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(frame).select("features", "label").coalesce(1)
    model = DecisionTreeClassifier(maxDepth=6, minInstancesPerNode=1, seed=1).fit(given)

    def read(node) -> tuple | bool:
        if node.subtreeDepth() == 0:
            return bool(node.prediction() > 0.5)
        split = node.split()
        return split.featureIndex(), split.threshold(), read(node.leftChild()), read(node.rightChild())

    return Tree(read(model._java_obj.rootNode()))


def main_text(page: str | None, tree: Tree) -> str:
    """The main blocks of a page, one a line."""
    blocks = blocks_of(page)
    return "\n".join(b.text for b, row in zip(blocks, features(blocks), strict=True) if tree.main(row))


def extract(pages: DataFrame, tree: Tree, html_column: str = "html", text_column: str = "text") -> DataFrame:
    """The pages with ``text_column``, all other columns as they are; a column of that name is replaced.

    A null or empty page, and one without main text, has an empty text. Pages may repeat.
    """
    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def found(values: pd.Series) -> pd.Series:
        return pd.Series([main_text(value, tree) for value in values], dtype=object)

    return pages.withColumn(text_column, found(col(html_column)))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text and its length in code points."""
    pages = extract(table(spark, sf_dir, "pages"), train(spark))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
