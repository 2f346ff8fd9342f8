"""Operator 1: main text of web pages from flat text blocks and a decision tree.

A page is flattened into blocks, the runs of text between block-level tags, with white space made single. Each block has
its number of words and its link density (share of words inside links), those of the block before and the one
after, and what its markup says: inside an article or main part, inside a navigation, header, footer, aside or form
part (or one whose class or id names such a thing), heading, paragraph, sentence end. A form
that holds an article, a main part or most of the page's words is no frame. A decision tree
trained on a small labelled table (``training_pages``) decides which blocks are main text; these are joined by
newlines in page order.

Scripts, styles, templates, comments, hidden parts and form fields give no blocks. Character references are decoded
after the markup is removed. Unclosed and crossing tags are closed as their parents are.

Nulls: null html is an empty page with an empty text; null url or page_id pass through. Repeated rows are extracted
each. An empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch.llm.common import slices

FEATURES = ("words", "link_density", "words_before", "links_before", "words_after", "links_after", "in_main", "in_frame",
            "content_name", "heading", "paragraph", "sentence", "page_has_main")

# A comment, a declaration, a tag whose quoted attribute values may hold ">", or one with an open quote. What is
# not closed ends with the page.
_TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|"
                  r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_SKIPPED = {"script", "style", "noscript", "template", "iframe", "svg", "textarea", "select", "button", "title", "object",
            "canvas", "math", "audio", "video", "datalist"}
_SKIP_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in _SKIPPED}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
           "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
           "u", "var", "wbr", "img", "br", "input", "nobr"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_FRAME = {"nav", "footer", "aside", "form", "menu", "dialog"}
_HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
_PARAGRAPH = {"p", "pre", "blockquote", "dd", "figcaption"}
_CLOSED_BY_LIKE = {"li", "dt", "dd", "tr", "td", "th", "option"}
_NAMED = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_FRAME_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|banner\w*|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|notice\w*|notification\w*|alert\w*|popup|modal|"
    r"newsletter|subscri\w*|signup|login|share|sharing|social|related|recommend\w*|sidebar\w*|side|widget\w*|menu\w*|nav|navbar|"
    r"navigation|breadcrumb\w*|topbar|masthead|footer\w*|foot|copyright|legal|disclaimer|comment\w*|repl(?:y|ies)|respond|disqus|"
    r"form|search\w*|pagination|pager|toolbar|complementary|contentinfo|skip)(?:$|[\s_\d-])", re.I)
#: Tokens that tell how a page looks, not what a part is; and names of the content itself, whatever stands beside them.
_STATE_NAME = re.compile(r"(?:^|[_-])(?:no|not|non|has|have|with|without|open|opened|closed|enabled|disabled)(?:$|[_-])", re.I)
_SURE_CONTENT = re.compile(r"(?:^|\s)(?:article|post|entry|story|main)[_-](?:content|body|text)(?:$|\s)", re.I)
#: Lists whose items are often articles, and roles that are frames like the tags.
_LIST_NAME = re.compile(r"(?:^|[\s_-])(?:comment\w*|repl(?:y|ies)|respond|disqus|related|recommend\w*)(?:$|[\s_\d-])", re.I)
_FRAME_ROLE = {"navigation", "complementary", "contentinfo", "search", "form", "dialog", "menu"}
_HEADER_NAME = re.compile(r"(?:^|[\s_-])(?:header\w*|hd)(?:$|[\s_\d-])", re.I)
_CONTENT_NAME = re.compile(r"(?:^|[\s_-])(?:article\w*|content|post|entry|story|main|text)(?:$|[\s_\d-])", re.I)
#: Names that say nothing about what stands inside an article: there a part may well be called so.
_AMBIGUOUS_NAME = re.compile(r"(?:^|[\s_-])(?:legal|disclaimer|copyright|menu\w*|form|search\w*|side|foot|topbar|masthead|skip)(?:$|[\s_\d-])", re.I)
#: Inline elements with these names are buttons or adverts; others take part in their block.
_BUTTON_NAME = re.compile(r"(?:^|[\s_-])(?:share|sharing|social|ad|ads|advert\w*|sponsor\w*)(?:$|[\s_\d-])", re.I)
_SENTENCE = re.compile(r"[.!?:;…。！？][\"'”’»)\]]*$")


def _frame_named(named: str, in_main: bool = False) -> bool:
    if not _FRAME_NAME.search(named) or _SURE_CONTENT.search(named):
        return False
    tokens = [token for token in named.split() if _FRAME_NAME.search(token) and not _STATE_NAME.search(token)]
    return any(not _AMBIGUOUS_NAME.search(token) for token in tokens) if in_main else bool(tokens)


class _Page:
    """Collects the blocks of one page: (text, words, linked words, in_main, in_frame, content_name, tag).

    With ``unwrap`` an article or main part inside a frame by name alone is main; ``wrapped`` tells if there is one.
    Forms are numbered in page order; those in ``plain`` are no frames. ``forms`` has for each whether it holds an article
    or main part, and its words.
    """

    def __init__(self, unwrap: bool = False, plain: frozenset[int] = frozenset()):
        self.blocks, self.parts, self.links = [], [], []
        # Open block-level elements: (tag, in_main, in_frame, content_name, framed by more than a name).
        self.open = [("", False, False, False, False)]
        self.count: dict[str, int] = {}  # of the open elements by tag
        self.unwrap, self.wrapped, self.plain = unwrap, False, plain
        self.forms, self.form_depth = [], 0  # depth of the outermost open form, 0 outside
        self.in_link = False

    def push(self, element: tuple) -> None:
        self.open.append(element)
        self.count[element[0]] = self.count.get(element[0], 0) + 1

    def pop(self) -> str:
        tag = self.open.pop()[0]
        self.count[tag] -= 1
        if len(self.open) <= self.form_depth:
            self.form_depth = 0
        return tag

    def text(self, piece: str) -> None:
        if piece:
            self.parts.append(piece)
            if self.in_link:
                self.links.append(piece)

    def end_block(self) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                linked = len(html.unescape(" ".join(self.links)).split()) if self.links else 0
                words = text.count(" ") + 1
                tag, main, frame, named, _ = self.open[-1]
                self.blocks.append((text, words, min(linked, words), main, frame, named, tag))
                if self.form_depth:
                    self.forms[-1][1] += words
            self.parts, self.links = [], []

    def start(self, tag: str, attributes: str) -> None:
        if tag == "a":
            self.in_link = True
        if tag in _INLINE and not attributes.strip():
            if tag == "br":
                self.parts.append(" ")
            return
        names = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _NAMED.finditer(attributes)} if attributes.strip() else {}
        named = f"{names.get('class', '')} {names.get('id', '')} {names.get('role', '')}"
        hidden = "hidden" in names or names.get("aria-hidden", "").lower() == "true" or "display:none" in names.get("style", "").replace(" ", "").lower()
        if tag in _INLINE:
            # An inline element takes part in its block unless it is hidden or names itself something else.
            if tag == "br":
                self.parts.append(" ")
            elif tag not in _VOID and tag != "a" and (hidden or _BUTTON_NAME.search(named)):
                self.end_block()
                self.push((tag, False, True, False, True))
            return
        self.end_block()
        self.in_link = self.in_link and tag == "a"
        if self.open[-1][0] == "p" or (tag in _CLOSED_BY_LIKE and self.open[-1][0] == tag):
            self.pop()
        if tag in _VOID:
            return
        _, main, frame, content, sure = self.open[-1]
        role = names.get("role", "").lower()
        article = tag in ("article", "main") or role == "main"
        by_name = tag not in ("html", "body") and _frame_named(named, main)
        listed = by_name and bool(_LIST_NAME.search(named))
        framed = tag in _FRAME
        if tag == "form" and not self.form_depth:
            framed = len(self.forms) not in self.plain
            by_name = by_name and framed
            self.forms.append([False, 0])
            self.form_depth = len(self.open)
        elif article and self.form_depth:
            self.forms[-1][0] = True
        sure = sure or hidden or framed or role in _FRAME_ROLE or listed or (by_name and main)
        if article and not sure and (frame or by_name):
            self.wrapped = True
            if self.unwrap:
                frame = by_name = False
        header = tag == "header" or (tag not in ("html", "body") and bool(_HEADER_NAME.search(named)) and not article)
        frame = frame or hidden or framed or (header and not main) or by_name
        main = (main or article) and not frame
        content = (content or bool(_CONTENT_NAME.search(named))) and not frame
        self.push((tag, main, frame, content, sure))

    def end(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
        if tag in _INLINE:
            if self.open[-1][0] == tag:
                self.end_block()
                self.pop()
            return
        self.end_block()
        if self.count.get(tag):  # else nothing is open that it could close
            while self.pop() != tag:
                pass


def flatten(page: str) -> list[tuple]:
    """The blocks of a page in order."""
    out = _read(page)
    total = sum(b[1] for b in out.blocks)
    plain = frozenset(k for k, (holds, words) in enumerate(out.forms) if holds or 2 * words > total)
    if plain:
        out = _read(page, plain=plain)
    if out.wrapped and not any(b[3] for b in out.blocks):
        out = _read(page, True, plain)
    return out.blocks


def _read(page: str, unwrap: bool = False, plain: frozenset[int] = frozenset()) -> _Page:
    out, at = _Page(unwrap, plain), 0
    while m := _TAG.search(page, at):
        out.text(page[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag = name.lower()
        if m[1] or m[4]:
            out.end(tag)
        elif tag in _SKIPPED:
            if not (m[3] or m[6] or "").endswith("/") or tag in ("script", "style", "textarea", "title"):
                ended = _SKIP_END[tag].search(page, at)
                at = ended.end() if ended else len(page)
        else:
            out.start(tag, m[3] or m[6] or "")
    out.text(page[at:])
    out.end_block()
    return out


def features(blocks: list[tuple]) -> list[tuple[float, ...]]:
    """One row of ``FEATURES`` per block."""
    size = [(b[1], b[2] / b[1]) for b in blocks]
    around = [(0, 0.0), *size, (0, 0.0)]
    has_main = any(b[3] for b in blocks)
    return [(*size[i], *around[i], *around[i + 2], float(b[3]), float(b[4]), float(b[5]), float(b[6] in _HEADING),
             float(b[6] in _PARAGRAPH), float(bool(_SENTENCE.search(b[0]))), float(has_main)) for i, b in enumerate(blocks)]


def _words(n: int, end: str = ".") -> str:
    return " ".join(f"w{i}" for i in range(n)) + end


def _links(*n: int) -> str:
    return "".join(f'<li><a href="/x">{_words(k, "")}</a></li>' for k in n)


#: Stands at the start of the main blocks of the labelled pages.
MARK = "§"


def training_pages() -> list[str]:
    """The labelled table: small pages of the usual makes, each with short and with long blocks."""
    pages = []
    for n in (2, 5, 9, 16, 30, 55, 120):
        text, tail = _words(n), _words(max(2, n // 3))
        keep = MARK if n >= 16 else ""
        # An article between a menu, an advert and a footer; blocks of every length inside and outside.
        pages += [
            f"<nav><ul>{_links(1, 1, 2, 1)}</ul></nav><div class='ad'>{text}</div><article><h1>{MARK}{_words(9, '')}</h1><p>{MARK}{text}<p>{MARK}{tail}</p>"
            f"<p>{MARK}{_words(1)}</p></article><footer>{text}</footer>",
            f"<header><h1>{_words(3, '')}</h1><p>{text}</p></header><main><h1>{MARK}{_words(6, '')}</h1><p>{MARK}{text}</p><ul><li>{MARK}{tail}</li>"
            f"<li>{MARK}{_words(4, '')}</li></ul><blockquote>{MARK}{text}</blockquote></main><aside><h2>{_words(2, '')}</h2><p>{text}</p></aside>"
            f"<footer><p>{tail}</p><p>{text}</p></footer>",
            f"<article><header><h1>{MARK}{_words(8, '')}</h1></header><p>{MARK}{text}</p><div class='related'><a href='/r'>{_words(n, '')}</a></div>"
            f"<p>{MARK}<a href='/y'>{_words(n, '')}</a> {_words(4)}</p><table><tr><td>{MARK}{_words(2, '')}</td><td>{MARK}{_words(1, '')}</td></tr></table>"
            f"<section id='comments'><p>{text}</p><p>{tail}</p></section></article>",
            f"<div class='cookie-notice'><p>{text}</p></div><article><h2>{MARK}{_words(2, '')}</h2><p>{MARK}{_words(3, '')}</p><div>{MARK}{text}</div>"
            f"<form><p>{text}</p></form><pre>{MARK}{_words(n, '')}</pre></article><div class='sidebar'><p>{text}</p></div>",
            # Plain blocks outside a main part.
            f"<div>{text}</div><main><p>{MARK}{_words(2)}</p><p>{MARK}{text}</p><p>{MARK}<a href='/p'>{_words(n, '')}</a></p></main><p>{text}</p><div>{tail}</div>",
            f"<p>{text}</p><h2>{_words(3, '')}</h2><article><h1>{MARK}{_words(1, '')}</h1><div>{MARK}{text}</div></article><p>{text}</p><h2>{_words(4, '')}</h2>",
            # Wrappers of the whole page whose names hold a frame's.
            f"<body class='single no-sidebar'><nav><ul>{_links(1, 2)}</ul></nav><article><h1>{MARK}{_words(6, '')}</h1><p>{MARK}{text}</p></article>"
            f"<div class='sidebar'><p>{text}</p></div></body>",
            f"<div class='sidebar-left'><div class='menu'>{_links(1, 1)}</div><main><p>{MARK}{text}</p><p>{MARK}{tail}</p></main><footer>{text}</footer></div>",
            # Content only by name.
            f"<div id='menu'>{_links(1, 2, 1)}</div><div class='content'><h1>{MARK}{_words(5, '')}</h1><p>{MARK}{text}</p><p>{MARK}{_words(6)}</p>"
            f"<p>{MARK}{tail}</p></div><div class='footer'><p>{text}</p></div>",
            f"<div class='post'><h3>{MARK}{_words(4, '')}</h3><div>{MARK}{text}</div><div>{MARK}{tail}</div></div><div class='comments'><div>{text}</div></div>",
            # Words and links alone.
            f"<ul>{_links(2, 1, 3, 1, 2)}</ul><h1>{MARK}{_words(7, '')}</h1><p>{MARK}{_words(50)}</p><p>{MARK}{text}</p><p>{MARK}{_words(40)}</p><p>{MARK}{_words(8)}</p>"
            f"<ul>{_links(4, 5, 2)}</ul><div>{_words(6, '')}</div>",
            f"<div><a href='/'>{_words(1, '')}</a></div><div><a href='/a'>{_words(2, '')}</a> | <a href='/b'>{_words(1, '')}</a></div><p>{MARK}{_words(28)}</p>"
            f"<p>{MARK}{text}</p><p>{MARK}{_words(35)}</p><div>{_words(4, '')}</div><div><a href='/c'>{_words(n, '')}</a></div>",
            f"<div>{_words(3, '')}</div><div>{_links(1, 1)}</div><h2>{MARK}{_words(5, '')}</h2><div>{MARK}{_words(36)}</div><div>{MARK}{_words(25)}</div>"
            f"<div><a href='/m'>{_words(2, '')}</a></div><div>{_words(5, '')}</div>",
            f"<p>{MARK}{_words(40)}</p><p>{MARK}{text}</p><p>{MARK}{_words(60)}</p><p><a href='/n'>{_words(n, '')}</a></p><p><a href='/o'>{_words(12, '')}</a></p>",
            # A page of one block, and one block among links.
            f"{keep}{_words(n, '.' if keep else '')}",
            f"<div>{keep}{_words(n, '.' if keep else '')}</div>",
            f"<p>{keep}{text}</p>" if keep else f"<div>{_words(n, '')}</div>",
            f"<ul>{_links(1, 2)}</ul><div>{keep}{_words(n, '.' if keep else '')}</div><ul>{_links(2, 1)}</ul>",
        ]
    return pages


def labelled() -> list[tuple[float, list[float]]]:
    rows = []
    for page in training_pages():
        blocks = flatten(page)
        rows += [(float(b[0].startswith(MARK)), list(f)) for b, f in zip(blocks, features(blocks))]
    return rows


def train_tree(spark: SparkSession) -> tuple:
    """The tree as nested (feature, threshold, left, right) with 0.0 or 1.0 at its leaves."""
    frame = spark.createDataFrame([(y, Vectors.dense(x)) for y, x in labelled()], ["label", "features"]).coalesce(1)
    model = DecisionTreeClassifier(maxDepth=10, maxBins=256, minInstancesPerNode=1, seed=7).fit(frame)

    def plain(node):
        if node.getClass().getSimpleName() == "LeafNode":
            return float(node.prediction())
        split = node.split()
        return int(split.featureIndex()), float(split.threshold()), plain(node.leftChild()), plain(node.rightChild())

    return plain(model._call_java("rootNode"))


def is_main(tree, row: tuple[float, ...]) -> bool:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree > 0.5


def main_text(page: str, tree) -> str:
    blocks = flatten(page)
    return "\n".join(b[0] for b, f in zip(blocks, features(blocks)) if is_main(tree, f))


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    tree = train_tree(pages.sparkSession)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(p, tree) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html")) \
        .mapInArrow(extract, "page_id long, url string, text string, n_chars long")
