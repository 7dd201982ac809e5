"""Main text of web pages by tree scoring.

The page becomes a tree. What is never part of an article goes first: scripts, forms, navigation
and elements whose role, class or id says menu, advert, notice, comments and the like. Inside an
article or main element such a name is not enough: headings stay, and so do elements that are
neither short nor full of links, or that hold most of its text. On a page without such an element a
name that may as well be an article's subject (``SUBJECTS``) is set aside first, and counts for nothing
if what was set aside by far outweighs the rest of the page. A form around the page's paragraphs
is no form but a wrapper; its fields go and the rest stays. Buttons and labels go with their forms
and stay within a sentence. Every text block that is left then gives points to its ancestors, for being there, for its length and for its
commas: all to its parent, half to the next, a third to the one after. A container's points are
discounted by the share of its text that lies in links. The best container is kept, widened to
the article or main element around it, and so are those of its siblings that look like part of the
same text. Of what is kept nothing is dropped or cut.

Pages are independent: one pass, no shuffle, a lost task is run again. Sizes come from one walk over
the tree, so the work for a page grows with its length, however deep its elements lie.

Defined cases: null or empty pages and pages without text give an empty text; plain text without
markup is one block; unclosed and wrongly nested elements are closed as browsers do; ``<`` that
starts no tag is text; the tree is walked without recursion, so depth has no limit; repeated pages
each get a row; columns named like a result are replaced and all others kept.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from miasma.llm.common import replaced, slices, texts_of

# Element names as HTML defines them, and words of class, id and role by custom.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol
    optgroup option p pre section summary table tbody td tfoot th thead tr ul""".split())
MENUS = frozenset("ul ol dl table p".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER_TEXT = frozenset("""script style noscript template head title meta link nav footer aside form button
    select option textarea input label iframe object embed applet svg annotation annotation-xml canvas audio
    video map menu dialog noembed noframes""".split())
FIELDS = frozenset("input select textarea".split())
UNLIKELY = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion
    banner nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidebars aside rail footer foot
    masthead cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter
    subscribe subscription signup login register social share sharing sharebar related recommended
    recommendations trending popular comment comments commentlist disqus reply replies respond responses
    widget widgets toolbar pagination pager skip skiplink search searchbox copyright legal tags tagcloud
    topbar bottombar outbrain taboola discussion feedback disclaimer paywall toast teaser teasers""".split())
# Those of them that an article may be about, or that its container may be called.
SUBJECTS = frozenset("""banner rail alert notice notices register social share sharing related recommended recommendations
    trending popular search copyright legal tags discussion feedback promotion sponsor subscription""".split())
# Stems that say the same inside a longer word.
STEMS = ("comment", "sidebar", "advert", "cookie", "newsletter", "breadcrumb", "masthead", "navbar", "subscri")
# What an article element may still be: someone's comment, or a pointer to another article.
NO_ARTICLE = frozenset("comment comments reply replies ad ads advert promo sponsored related recommended teaser".split())
UNLIKELY_ROLES = frozenset("""navigation banner contentinfo complementary search dialog alertdialog alert menu
    menubar toolbar tablist form""".split())
LONG = 200  # characters, without spaces, of an element that no name makes an advert
OUTWEIGHS = 4  # times the rest of the page, of text set aside for its names
LAYOUT = frozenset("with has no".split())
# Opening one of these ends an open element of the given names, within the given border.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<![^>]*+>|<\?[^>]*+>
    |<(/?)([a-zA-Z][a-zA-Z0-9:_-]*+)((?>[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |<(/?)([a-zA-Z][a-zA-Z0-9:_-]*+)([^>]*+)>""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.I)
_SELF_CLOSED = re.compile(r"""(?:^|[\s"'])/$""")  # not <a href=/>
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "attributes", "parent", "children", "score", "length", "linked", "size", "size_linked", "links",
                 "prose", "fields")

    def __init__(self, tag: str, attributes: str = "", parent: Node | None = None):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []
        self.score, self.length, self.linked = 0.0, 0, 0
        self.size = self.size_linked = self.links = 0
        self.prose = self.fields = False


def parse(page: str) -> Node:
    """The page as a tree of elements and decoded texts."""
    root = node = Node("#root")
    known: set[str] = set()  # names opened so far: other end tags close nothing
    at, size = 0, len(page)
    token = _TOKEN.search(page)
    while at < size:
        start = token.start() if token else size
        if start > at:
            node.children.append(html.unescape(page[at:start]) if "&" in page[at:start] else page[at:start])
        if not token:
            break
        at = token.end()
        closing, name, attributes = token[1] or token[4], token[2] or token[5], token[3] or token[6] or ""
        if name:
            name = name.lower()
            if closing:
                if name in known or name in HEADINGS:
                    node = _closed(node, name)
            else:
                known.add(name)
                node = _opened(node, name)
                child = Node(name, attributes, node)
                node.children.append(child)
                if name in RAW:  # its content is no markup
                    end = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(page, at)
                    close = page.find(">", end.start()) if end else -1
                    at = close + 1 if close >= 0 else size
                elif name not in VOID and not _SELF_CLOSED.search(attributes):
                    node = child
        token = _TOKEN.search(page, at)
    return root


def _opened(node: Node, name: str) -> Node:
    """Where an element of this name goes, after what its start tag ends."""
    if name in BLOCKS:
        above = node
        while above.parent and above.tag not in BLOCKS:
            above = above.parent
        if above.tag == "p" or (name in HEADINGS and above.tag in HEADINGS):
            node = above.parent
    if name in CLOSES:
        ends, border = CLOSES[name]
        above, found = node, None
        while above.parent and above.tag not in border:
            if above.tag in ends:
                found = above
            above = above.parent
        if found:
            node = found.parent
    return node


def _closed(node: Node, name: str) -> Node:
    """The open element after an end tag; one that closes nothing is ignored."""
    above = node
    while above.parent:
        if above.tag == name or (name in HEADINGS and above.tag in HEADINGS):
            return above.parent
        # An inline end tag does not reach over a block; that of a list of choices ends its options.
        if name not in BLOCKS and above.tag in BLOCKS and not (name == "select" and above.tag in ("option", "optgroup")):
            return node
        above = above.parent
    return node


def _names(attributes: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTRIBUTE.finditer(attributes)}


def unlikely(node: Node, inside: bool) -> bool:
    """Not part of an article. ``inside``: an article or main element lies around it."""
    tag = node.tag
    if tag in NEVER_TEXT:
        return True
    if tag in ("html", "body", "main", "#root"):
        return False
    if tag == "header":
        return not inside
    if not node.attributes:
        return False
    names = _names(node.attributes)
    if "hidden" in names or names.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(names.get("style", "")):
        return True
    if UNLIKELY_ROLES & set(names.get("role", "").lower().split()):
        return True
    return any(_telling(name, tag, inside) for name in _class_and_id(names))


def _class_and_id(names: dict[str, str]) -> list[str]:
    return f"{names.get('class', '')} {names.get('id', '')}".split()


def _telling(name: str, tag: str, inside: bool) -> set[str]:
    """The words of a class or id that say menu, advert and the like."""
    words = {w.lower() for w in _NAME.findall(name)}
    if tag == "article":
        return words & NO_ARTICLE
    if words & LAYOUT:  # "with-sidebar" is a page's layout, not its side bar
        return set()
    found = words & UNLIKELY | {s for s in STEMS if s in name.lower()}
    return found | {"header"} if "header" in words and not inside else found


def measure(root: Node) -> None:
    """For every element the characters that may be text, those of them in links, its links, and whether
    it holds paragraphs or fields of a form: one walk, from the leaves up."""
    for part, parent, entering in _walk(root):
        if isinstance(part, str):
            parent.size += len("".join(part.split()))
        elif not entering:
            if part.tag == "a":
                part.size_linked = part.size
                part.links += 1
            elif part.tag in NEVER_TEXT and part.tag != "form":
                part.size = part.size_linked = 0
            if parent:
                parent.size += part.size
                parent.size_linked += part.size_linked
                parent.links += part.links
                parent.prose |= part.prose or part.tag in ("p", "article", "main")
                parent.fields |= part.fields or part.tag in FIELDS


def _is_menu(node: Node) -> bool:
    """Three links or more that make up nearly all of its text."""
    return node.links >= 3 and node.size_linked >= 0.8 * node.size


def _wraps(form: Node, whole: int) -> bool:
    """A form that holds paragraphs or an article, and most of the page's text."""
    return form.prose and 2 * form.size > whole


def _in_sentence(node: Node) -> bool:
    """A label or button within a paragraph that has words of its own and is no row of a form."""
    above = node.parent
    while above.parent and above.tag not in BLOCKS:
        above = above.parent
    return above.tag == "p" and above.size > 0 and not above.fields


def _named_only(node: Node) -> bool:
    """Unlikely by the words of its class or id alone."""
    names = _names(node.attributes)
    return (node.tag not in NEVER_TEXT and node.tag not in ("article", "header") and "hidden" not in names
            and names.get("aria-hidden", "").lower() != "true" and not _HIDDEN.search(names.get("style", ""))
            and not UNLIKELY_ROLES & set(names.get("role", "").lower().split()))


def _may_be_subject(node: Node) -> bool:
    """Long, poor in links, and unlikely only by words that an article may be about."""
    if node.size < LONG or node.size_linked >= 0.3 * node.size or not _named_only(node):
        return False
    return all(_telling(name, node.tag, False) <= SUBJECTS for name in _class_and_id(_names(node.attributes)))


def _is_text(node: Node, whole: int) -> bool:
    """Part of the article around it, whatever its name says."""
    if node.tag in HEADINGS:
        return True
    if 2 * node.size > whole:
        return True
    return node.size >= LONG and node.size_linked < 0.3 * node.size


def prune(root: Node) -> None:
    """Take away what is never part of an article."""
    measure(root)
    aside: list[Node] = []  # outermost elements set aside for their names
    rest, articles = 0, False  # characters of the page outside of these
    todo = [(root, False, 0, False)]
    while todo:
        node, inside, whole, doubtful = todo.pop()
        if node.tag in ("article", "main"):
            inside, whole = True, node.size if not inside or node.tag == "article" else whole
            articles |= node.size > 0 and not doubtful
        kept = []
        for c in node.children:
            unsure = doubtful
            if isinstance(c, Node):
                if c.tag == "form" and _wraps(c, root.size):
                    c.tag, c.attributes = "div", ""
                elif c.tag in ("label", "button") and _in_sentence(c):
                    c.tag, c.attributes = "span", ""
                if unlikely(c, inside):
                    if inside:
                        if not (_named_only(c) and _is_text(c, whole)):
                            continue
                    elif _may_be_subject(c):
                        if not doubtful:
                            aside.append(c)
                        unsure = True
                    else:
                        continue
                elif not inside and c.tag in MENUS and _is_menu(c):
                    continue
                todo.append((c, inside, whole, unsure))
            elif not doubtful and node.tag != "a":
                rest += len("".join(c.split()))
            kept.append(c)
        node.children = kept
    if articles or sum(n.size for n in aside) <= OUTWEIGHS * rest:
        gone = set(map(id, aside))
        for above in {id(n.parent): n.parent for n in aside}.values():
            above.children = [c for c in above.children if id(c) not in gone]


def _walk(root: Node) -> Iterator[tuple[Node | str, Node | None, bool]]:
    """(node or text, parent, entering?) in page order."""
    todo: list[tuple[Node | str, Node | None, bool]] = [(root, None, True)]
    while todo:
        node, parent, entering = todo.pop()
        yield node, parent, entering
        if entering and isinstance(node, Node):
            todo.append((node, parent, False))
            todo += [(c, node, True) for c in reversed(node.children)]


def blocks(root: Node) -> list[tuple[str, Node, int]]:
    """(text, innermost block element, characters in links) of every text block, in page order."""
    out: list[tuple[str, Node, int]] = []
    pieces: list[str] = []
    linked = links = 0
    holder = root

    def flush() -> None:
        nonlocal pieces, linked
        text = " ".join("".join(pieces).split())
        if text:
            out.append((text, holder, min(linked, len(text))))
        pieces, linked = [], 0

    for node, parent, entering in _walk(root):
        if isinstance(node, str):
            if not pieces:
                holder = parent
                while holder.parent and holder is not root and holder.tag not in BLOCKS:
                    holder = holder.parent
            pieces.append(node)
            if links:
                linked += len(" ".join(node.split()))
        elif node.tag in BLOCKS:
            flush()
        elif node.tag == "br":
            pieces.append(" ")
        elif node.tag == "a":
            links += 1 if entering else -1
    flush()
    return out


def score(root: Node) -> Node:
    """Points for all ancestors of blocks; returns the best container."""
    best, top = root, -1.0
    touched: dict[int, Node] = {}
    for text, holder, linked in blocks(root):
        points = 1 + text.count(",") + min(len(text) / 100, 3)
        if holder.tag in HEADINGS:
            points = 0.5
        # A paragraph's container is its parent; text straight in a division is in its container.
        above = holder.parent if holder.tag in ("p", "pre", "li", "td", "th", "dd", "dt", "blockquote", *HEADINGS) and holder.parent else holder
        above.length += len(text)
        above.linked += linked
        for level in (1, 2, 3):
            above.score += points / level
            touched[id(above)] = above
            above = above.parent
            if above is None:
                break
    for node, parent, entering in _walk(root):
        if not entering and parent and isinstance(node, Node):
            parent.length += node.length
            parent.linked += node.linked
    for node in touched.values():
        value = node.score * (1 - node.linked / max(node.length, 1))
        if value > top:
            best, top = node, value
    return best


def main_text(page: str) -> str:
    """The article's blocks, joined by empty lines."""
    root = parse(page)
    prune(root)
    best = score(root)
    around = best
    while around is not None and around.tag != "article":
        around = around.parent
    if around is None:
        around = best
        while around is not None and around.tag != "main" and "main" not in _names(around.attributes).get("role", "").lower().split():
            around = around.parent
    if around is not None:
        kept = [around]
    elif best.parent is None or best.tag == "body":
        kept = [best]
    else:
        kept = [c for c in best.parent.children if isinstance(c, Node) and (c is best or _belongs(c, best))]
    return "\n\n".join(text for node in kept for text, _, _ in blocks(node))


def _belongs(node: Node, best: Node) -> bool:
    """A sibling that is part of the text: heading, paragraph, or container with enough points."""
    found = blocks(node)
    length = sum(len(t) for t, _, _ in found)
    density = sum(n for _, _, n in found) / max(length, 1)
    if node.tag in HEADINGS or node.tag in ("header", "hgroup"):
        return True
    if node.tag in ("p", "pre", "blockquote", "table", "figure", "ul", "ol", "dl"):
        return density < 0.5
    same = bool(node.attributes) and _names(node.attributes).get("class") == _names(best.attributes).get("class")
    return density < 0.3 and (node.score >= 0.2 * best.score or same)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All rows and columns, with ``text`` and ``n_chars``."""
    names = ["text", "n_chars"]
    schema = T.StructType([f for f in pages.schema.fields if f.name.lower() not in names]
                          + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html_col):
            texts = [main_text(t.decode("utf-8", "replace")) for t in texts_of(batch.column(html_col))]
            yield replaced(batch, names, [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())])

    return pages.mapInArrow(run, schema)
