"""Main text of web pages by composite text density (Sun, Song and Liao, SIGIR 2011).

Every element gets its characters per tag, adjusted for links:

    density = C / T * log(C / LC * T / LT) / log(ln(C / (C - LC) * LC + LC_body / C_body * C + e))

with C, T, LC, LT the characters, tags, link characters and link tags below it; zero denominators
count as one, and without any link the adjustment is 1.  An element's density sum is the sum of
its children's densities, text between them included.  The threshold is the least density on the
path from the body to the container of largest density sum.  That container is rarely the whole
article (a section or a list may have the largest sum).  Inside an article element (or main, on a page
without one) the main text is that whole element; an article inside an article is a reader's remark and
goes, if the outer one has dense text of its own.  On other pages the container grows to the parents
that hold further blocks at or above the threshold, but only such that are its like: paragraphs,
headings, lists and tables beside it, and containers with its own class and id; other containers beside
it stay out.  Containers that are mostly links and below the threshold are left out there, unless they
stand between two dense blocks.

Elements that are never part of an article (menus, forms, scripts, elements whose class, id or
role names an advert, a notice, a side bar or reader comments, ...) have no density and no text.  A
class or id names such a part if it consists of the names below and of qualifiers of place and
shape ("sidebar-left", but not "has-sidebar" or "article-header"), or if its last word names adverts,
notices, sharing, lists of other texts or reader comments ("user-comments").  An element named for its
place alone stays if it holds all article and main elements of the page or, on a page without these, most
characters outside links; one named for such contents never does.

Defined cases: a null or empty page, and a page without text, give an empty text; unclosed and
stray tags are repaired as far as paragraphs, list items and table cells close one another;
repeated rows are extracted alike; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: what HTML says of its elements
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option
    p pre section summary table tbody td tfoot th thead tr ul""".split())
CONTAINERS = frozenset("article blockquote body center details div dl fieldset figure main ol section table tbody td tr ul".split())
CLOSED_BY = {"p": BLOCKS - {"body", "html"}, "li": frozenset(["li"]), "dd": frozenset(["dd", "dt"]), "dt": frozenset(["dd", "dt"]),
             "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
             "option": frozenset(["option", "optgroup"])}
#: A start tag closes an open element of CLOSED_BY only inside these.
SCOPES = frozenset("body html article section div main table ul ol dl td th blockquote button".split())
# fixed values: elements and names that are no part of an article
NO_ARTICLE = frozenset("nav footer aside form button select menu dialog head header object canvas audio video".split())
NO_ARTICLE_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner
    sidebar side comment comments disqus respond cookie cookies consent gdpr notice notices alert nav navbar navigation menu
    breadcrumb breadcrumbs footer header masthead related recommended share sharing social subscribe newsletter signup popup
    modal overlay toolbar pagination pager search contentinfo complementary""".split())
#: What may stand beside these names in a class or id, and what only before those of READERS.
QUALIFIERS = frozenset("""left right top bottom upper lower middle first last primary secondary main site page global box block
    container wrapper wrap inner outer holder list item items area region section widget widgets unit slot space zone bar links
    link buttons button icons form panel column col row text title menu mobile desktop sticky fixed google dfp id js wp the
    small large big wide label thread post""".split())
#: Names of contents: these are never part of an article, however long.
CONTENTS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion comment comments
    disqus respond cookie cookies consent gdpr notice notices related recommended share sharing social subscribe newsletter
    signup popup modal""".split())
#: Before such a name: the element says whether there is one, and is none.
STATES = frozenset("has no not with without is are hide hides show shows enable disable".split())
BESIDE_ARTICLE = frozenset("post article entry story content".split())
READERS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion sidebar comment comments
    disqus respond related recommended share sharing social subscribe newsletter signup nav navigation pagination""".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]{0,4096}+"|'[^']{0,4096}+'){0,4096}+)>|<[!?/][^>]*>""", re.S)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_CLOSERS = frozenset().union(*CLOSED_BY.values())
#: Blocks of text that belong to the container they stand in.
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hgroup center address caption".split())


class Node:
    __slots__ = ("tag", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "out", "named", "contents", "own", "inner",
                 "dense", "articles", "kind", "in_article", "mark")

    def __init__(self, tag: str, parent: Node | None, out: bool, named: bool = False, contents: bool = False, kind: tuple = ()):
        self.tag, self.parent, self.out, self.named, self.contents, self.kind = tag, parent, out, named, contents, kind
        self.children: list = []                       # nodes and texts in page order
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = 0.0
        self.own = self.dense = 0                      # characters outside inner blocks; dense blocks from here down
        self.inner = False                             # has blocks below it
        self.articles = 0                              # article and main elements from here down
        self.in_article = tag == "article" or parent is not None and parent.in_article
        #: The nearest element from here up that a start tag may close, or beyond which it closes none.
        self.mark = self if parent is None or tag in SCOPES or tag in CLOSED_BY else parent.mark


def _no_article(tag: str, inside_article: bool) -> bool:
    return tag in NO_ARTICLE and not (tag == "header" and inside_article)


def _named(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether a class, id or role names a part outside the article, and whether it names contents."""
    named = contents = False
    if not attributes or tag in ("body", "html", "article", "main"):
        return named, contents
    for found in _NAMES.findall(attributes):
        for value in "".join(found).lower().split():
            words = [w for w in _WORD.findall(value) if not w.replace("x", "").isdigit()]
            names = NO_ARTICLE_NAMES.intersection(words)
            if not names:
                continue
            if words[-1] in CONTENTS and not STATES.intersection(words):
                return True, True
            if len(words) > 1 and words[0] in BESIDE_ARTICLE and names <= READERS:
                words = words[1:]
            if all(w in NO_ARTICLE_NAMES or w in QUALIFIERS for w in words):
                named, contents = True, contents or bool(names & CONTENTS)
    return named, contents


def _kind(attributes: str) -> tuple:
    """The class and id values of an element, by which its like are known."""
    return tuple(sorted({w for found in _NAMES.findall(attributes) for w in "".join(found).lower().split()})) if attributes else ()


def _exclude(nodes: list[Node]) -> None:
    """Strike out the named elements, with all below them, that do not hold the article."""
    body = nodes[0]
    for node in reversed(nodes):
        node.articles += node.tag in ("article", "main") and not node.out
        if node.parent is not None:
            node.parent.articles += node.articles
    for node in nodes[1:]:
        holds = not node.contents and (node.articles == body.articles if body.articles else
                                       2 * (node.chars - node.link_chars) > body.chars - body.link_chars)
        node.out = node.out or node.parent.out or node.named and not holds


def parse(page: str) -> tuple[Node, list[Node]]:
    """The body of a page and all its elements, parents first."""
    root = Node("body", None, False)
    nodes, at, here, size, last = [root], 0, root, len(page), page.rfind(">")
    open_: dict[str, int] = {}                         # open elements by tag: a stray end tag closes nothing

    def text(piece: str):
        if "&" in piece:
            piece = entities.unescape(piece)
        if piece:
            here.children.append(piece)

    def close(until: Node) -> Node:
        """Closes the elements from here up to ``until``; its parent is where the page goes on."""
        node = here
        while True:
            open_[node.tag] -= 1
            if node is until:
                return node.parent
            node = node.parent

    while at < size:
        start = page.find("<", at)
        if start < 0 or start > last and not page.startswith("<!--", start):
            text(page[at:])
            break
        # the second form is a tag with an unbalanced quote or very many attributes
        found = _TAG.match(page, start) or _LOOSE.match(page, start)
        if found is None:                              # a bare "<"
            text(page[at:start + 1])
            at = start + 1
            continue
        if start > at:
            text(page[at:start])
        at = found.end()
        if found.lastindex is None:                    # a comment or declaration
            continue
        closing, tag, attributes = found.group(1), found.group(2).lower(), found.group(3)
        if closing:
            if tag in RAW or tag in VOID or not open_.get(tag):
                continue
            node = here
            while node.tag != tag:
                node = node.parent
            here = close(node)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag in ("html", "body"):
            continue
        node = here.mark
        while tag in _CLOSERS and node.parent is not None:
            if tag in CLOSED_BY.get(node.tag, ()):     # and what that one stood in: a list item closes
                here = close(node)                     # the paragraph of the item before, and the item
                node = here.mark
            elif node.tag in SCOPES:
                break
            else:
                node = node.parent.mark
        made = Node(tag, here, here.out or _no_article(tag, here.in_article), *_named(tag, attributes), kind=_kind(attributes))
        here.children.append(made)
        nodes.append(made)
        if tag not in VOID and not attributes.endswith("/"):
            here = made
            open_[tag] = open_.get(tag, 0) + 1
    return root, nodes


def _count(nodes: list[Node]) -> None:
    """Characters and tags below each element, by one pass from the leaves up."""
    for node in reversed(nodes):
        node.own = sum(len(" ".join(c.split())) for c in node.children if isinstance(c, str))
        node.chars += node.own
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
        up = node.parent
        if up is not None:
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags + (node.tag == "a")
            up.inner = up.inner or node.inner or node.tag in BLOCKS


def _density(node: Node, body: Node) -> float:
    c, t, lc, lt = node.chars, max(node.tags, 1), node.link_chars, node.link_tags
    if not c:
        return 0.0
    scale = math.log(math.log(c / max(c - lc, 1) * lc + body.link_chars / max(body.chars, 1) * c + math.e))
    return c / t * (math.log(c / max(lc, 1) * t / max(lt, 1)) / scale if scale > 1e-9 else 1.0)


def main_text(page: str | None) -> str:
    """The article's blocks, joined by line ends."""
    if not page:
        return ""
    body, nodes = parse(page)
    _count(nodes)
    _exclude(nodes)
    for node in nodes:
        node.density = _density(node, body)
    best, most = body, -1.0
    for node in nodes:                                 # parents first: a tie goes to the outer one
        if node.out or node.tag not in CONTAINERS:
            continue
        total = sum((len(" ".join(c.split())) if isinstance(c, str) else 0.0 if c.out else c.density) for c in node.children)
        if total > most:
            best, most = node, total
    threshold, node = best.density, best
    while node.parent is not None:
        node = node.parent
        threshold = min(threshold, node.density)
    _mark_dense(nodes, threshold)
    article = _article(best, nodes)
    if article is not None:
        _strike_remarks(article, nodes)
        return _blocks(article, None)
    return _blocks(_around(best), threshold)


def _mark_dense(nodes: list[Node], threshold: float) -> None:
    """Counts the blocks whose own text reaches the threshold.  Text beside inner blocks counts by its
    characters, as in the density sum."""
    for node in reversed(nodes):
        if node.tag in BLOCKS:
            node.dense += (not node.out and node.own > 0 and 2 * node.link_chars <= node.chars
                           and (node.own if node.inner else node.density) >= threshold)
        elif node.parent is not None and not node.out:
            node.parent.own += node.own
        if node.parent is not None:
            node.parent.dense += node.dense


def _article(best: Node, nodes: list[Node]) -> Node | None:
    """The article element (main, on a page without one) that holds the container of largest density
    sum; if none does, the one of most characters, unless the container has more than twice as many."""
    for tag in ("article", "main"):
        found = [n for n in nodes if n.tag == tag and not n.out]
        if not found:
            continue
        node, outer = best, None
        while node is not None:
            outer = node if node.tag == tag else outer
            node = node.parent
        if outer is not None:
            return outer
        longest = max(found, key=lambda n: n.chars)
        if best.parent is None or best.chars <= 2 * longest.chars or _holds(best, longest):
            return longest
        return None
    return None


def _holds(outer: Node, node: Node | None) -> bool:
    while node is not None and node is not outer:
        node = node.parent
    return node is outer


def _strike_remarks(article: Node, nodes: list[Node]) -> None:
    inner = [n for n in nodes if n.tag == "article" and n is not article and not n.out and n.in_article]
    first = [n for n in inner if not n.parent.in_article or _nearest_article(n.parent) is article]
    if article.dense > sum(n.dense for n in first):
        for n in first:
            n.out = True


def _nearest_article(node: Node) -> Node | None:
    while node is not None and node.tag != "article":
        node = node.parent
    return node


def _around(best: Node) -> Node:
    """The least element that holds ``best`` and the dense blocks of its like; containers of another kind
    on the way are struck out."""
    top, node = best, best
    while node.parent is not None:
        up, more = node.parent, False
        for child in up.children:
            if isinstance(child, str) or child is node or child.out or not child.dense:
                continue
            if child.tag in PLAIN or child.tag not in CONTAINERS or child.kind == node.kind:
                more = True
            else:
                child.out = True
        if more or up.own and up.dense > sum(c.dense for c in up.children if isinstance(c, Node)):
            top = up
        node = up
    return top


def _blocks(top: Node, threshold: float | None) -> str:
    """Texts of the blocks below ``top``.  With a threshold, containers below it that are mostly links
    are kept only between dense blocks."""
    blocks: list[tuple[str, bool]] = []                # texts, and whether they stand in such a container
    line: list[str] = []
    dense_at: list[int] = []
    doubtful = 0

    def end():
        if line and (block := " ".join("".join(line).split())):
            blocks.append((block, doubtful > 0))
        line.clear()

    stack: list = [iter(top.children)]
    open_ = [(top, False)]
    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
            node, doubt = open_.pop()
            if node.tag in BLOCKS:
                end()
                if node.dense and not node.inner:
                    dense_at.append(len(blocks) - 1)
            doubtful -= doubt
        elif isinstance(child, str):
            line.append(child)
        elif child.out:
            if child.tag in BLOCKS:
                end()
        else:
            if child.tag in BLOCKS:
                end()
            elif child.tag == "br":
                line.append(" ")
            doubt = threshold is not None and child.tag in CONTAINERS and child.density < threshold and 2 * child.link_chars > child.chars
            doubtful += doubt
            stack.append(iter(child.children))
            open_.append((child, doubt))
    end()
    first, last = (dense_at[0], dense_at[-1]) if dense_at else (len(blocks), -1)
    return "\n".join(b for i, (b, doubt) in enumerate(blocks) if not doubt or first < i < last)


def extract(pages: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of each page's html in the column ``name``."""
    pages = pages.drop(name)                           # an old column of that name is replaced
    schema = T.StructType([*pages.schema.fields, T.StructField(name, T.StringType())])

    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(batch.schema.get_field_index(html))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, name])
    return pages.mapInArrow(run, schema)


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without the html, with text and n_chars (code points)."""
    return extract(pages, html).withColumn("n_chars", F.length("text").cast("long")).drop(html)
