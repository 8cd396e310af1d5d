"""Main text of web pages, by wrappers inferred from pages of one host.

A wrapper is a union-free regular expression over the block elements of a page:
elements that occur once, optionally (``?``), repeatedly (``+``) or both (``*``), and
texts that are either fixed or a slot. It starts as one page and is aligned with one
page after the other: elements found on one side only become optional, neighbours
with one label become one repeated element, texts that differ become slots. Aligning
two wrappers is the same operation, so wrappers of parts of a host are merged.

The host's wrapper names the elements that may hold the article: all article or main
elements of the host, else the element that gathers most of the text that varies
between pages. On a page the one with most text is the article. Texts that all pages of
a host have at one place are template and go, in an article only if they stand in a
box of their own and are a small part of it. Elements whose name, role or whole class says menu, header, footer, sidebar,
notice, advert, form or comment are left out everywhere, but by class only if they hold no
article or page heading. Where only a part of a class name says so, as in
``comment-list`` or ``has-sidebar``, the wrapper decides: on its host such an element goes
unless it holds the article.
"""

from __future__ import annotations

import difflib
import html
import json
import operator
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.session import materialize

# Parts of a host whose wrappers are merged apart from each other first.
PARTS = 64
# Pages that must agree before a text counts as template.
TEMPLATE_PAGES = 3
# Share of the varying text that an element must gather to be descended into.
MAIN_SHARE = 0.6
# Share of a host's text from which an element is what its pages are about, whatever its name.
WHOLE_SHARE = 0.8
# Elements nested deeper are text of the one around them.
MAX_DEPTH = 100

# --- Fixed values: HTML element names ---
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg")
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre "
    "search section select summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_PARAGRAPH = BLOCKS - frozenset("button caption legend option optgroup summary tbody td tfoot th thead tr".split())
# An opening tag ends an open element of these names, unless one of the second group lies between.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
DROPPED = frozenset(
    "head nav footer aside form fieldset button select option menu dialog search legend optgroup".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
# Whole classes or ids that mark an element as something else than the article.
DROPPED_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright dialog disclaimer disqus footer form header hidden login masthead menu menus modal nav navbar "
    "navigation newsletter notice notices notification pager pagination paywall popup promo promotion recommended "
    "related replies reply search share sharing sidebar sidebars signup social sponsor sponsored subscribe "
    "subscription toolbar topbar widget widgets".split()
)

# Elements whose own text in an article is template if all pages of the host have it. Headings,
# paragraphs and lists are the article's, also where a host holds nothing but copies of a page.
BOXES = frozenset(("div", "section", "address", "center"))
# Parts of a class that make it suspicious, and first parts of classes that tell a state.
SUSPICIOUS_PARTS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disqus footer login menu modal nav navbar navigation newsletter pager pagination paywall popup "
    "promo promotion promotions recommended related replies share sharing sidebar sidebars signup social sponsor "
    "sponsored subscribe subscription toolbar widget widgets".split()
)
STATES = frozenset("has no not is with without js".split())

_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(" + "|".join(RAW) + r")\b(?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|<[a-zA-Z][^>]*+\Z",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


@dataclass
class Element:
    """A block element: what it is called, and its texts and block elements in page order."""

    name: str
    label: str
    dropped: bool
    items: list[str | Element] = field(default_factory=list)
    by_class: bool = False


def _suspicious(name: str) -> bool:
    """Whether a part of a class name speaks against the article."""
    parts = [p.lower() for p in _PART.findall(name)]
    return bool(parts) and parts[0] not in STATES and not SUSPICIOUS_PARTS.isdisjoint(parts)


def _label_suspicious(label: str) -> bool:
    name, _, shown = label.partition(".")
    return name not in ("html", "body", "main", "section", *_HEADINGS) and _suspicious(shown)


def _described(name: str, attributes: str) -> tuple[str, bool, bool]:
    """An element's label for alignment, whether it is ruled out, and whether only its class or id does that."""
    values = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)} if "=" in attributes else {}
    classes = values.get("class", "").split()
    # The class that says most about the element: a suspicious one, else the first.
    shown = next((c for c in [*classes, values.get("id", "")] if _suspicious(c)), classes[0] if classes else "")
    label = name + (f".{re.sub(r'[0-9]+', '', shown)}" if shown else "")
    if values.get("itemprop") == "articleBody":
        label += "@article"
    dropped = name in DROPPED or values.get("role", "").lower() in DROPPED_ROLES
    by_class = False
    if not dropped and name not in ("html", "body", "article", "main") and name not in _HEADINGS:
        # The id of a section is often made from its heading.
        names = classes if name == "section" else [*classes, values.get("id", "")]
        by_class = not DROPPED_WORDS.isdisjoint(n.lower() for n in names)
    return label, dropped or by_class, by_class


def parse(page: str) -> Element:
    """The block elements of a page; markup inside a block is removed and references are decoded."""
    root = Element("", "", False)
    stack, held = [root], []

    def flush() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            stack[-1].items.append(text)

    def close(names: Iterable[str], barriers: Iterable[str] = ()) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in names:
                flush()
                del stack[depth:]
                return
            if stack[depth].name in barriers:
                return

    at = 0
    for match in _TOKEN.finditer(page):
        held.append(page[at : match.start()])
        at = match.end()
        name = (match[3] or match[6] or "").lower()
        if name == "br":
            held.append(" ")
        if name not in BLOCKS:
            continue
        if match[2] or match[5]:
            close((name,))
            continue
        flush()
        if name in CLOSES_PARAGRAPH:
            close(("p",), ("td", "th", "button", "caption"))
        if name in SIBLINGS:
            close(*SIBLINGS[name])
        if name == "body":
            close(("head",))
        if name not in VOID and len(stack) < MAX_DEPTH:
            label, dropped, by_class = _described(name, match[4] or match[7] or "")
            element = Element(name, label, dropped, by_class=by_class)
            if name in ("article", "main", "h1") or label.endswith("@article"):
                for outer in stack:
                    outer.dropped &= not outer.by_class
            # A page header is not the article, the header of an article is.
            if name == "header" and not any(e.name in ("article", "main") for e in stack):
                element.dropped = True
            stack[-1].items.append(element)
            stack.append(element)
    held.append(page[at:])
    flush()
    return root


def blocks(element: Element, out: frozenset[str] = frozenset()) -> Iterator[str]:
    """The texts of an element in page order, without those of elements that are ruled out, by themselves or by label."""
    todo = [iter(element.items)]
    while todo:
        for item in todo[-1]:
            if isinstance(item, str):
                yield item
            elif not item.dropped and item.label not in out:
                todo.append(iter(item.items))
                break
        else:
            todo.pop()


# --- Wrappers -----------------------------------------------------------------


@dataclass
class Node:
    """A wrapper node: label, how often it occurs, its own text and its children.

    ``text`` is a fixed text, or None for a slot; ``size`` counts the characters seen in
    a slot, ``pages`` the different pages behind the node.
    """

    label: str
    text: str | None
    size: int = 0
    pages: int = 1
    optional: bool = False
    repeated: bool = False
    children: list[Node] = field(default_factory=list)

    def __str__(self) -> str:
        """The wrapper as a regular expression."""
        own = "" if self.text == "" else "#TEXT " if self.text is None else json.dumps(self.text) + " "
        inner = own + " ".join(map(str, self.children))
        mark = {(False, False): "", (True, False): "?", (False, True): "+", (True, True): "*"}
        return f"<{self.label}>({inner.strip()}){mark[self.optional, self.repeated]}"

    def packed(self) -> list:
        flags = self.optional + 2 * self.repeated
        return [self.label, self.text, self.size, self.pages, flags, [c.packed() for c in self.children]]

    @classmethod
    def unpacked(cls, row: list) -> Node:
        label, text, size, pages, flags, children = row
        return cls(label, text, size, pages, bool(flags & 1), bool(flags & 2), [cls.unpacked(c) for c in children])


def align(a: Node, b: Node, pages: Callable[[int, int], int]) -> Node:
    """The smallest wrapper of this kind that both sides match. Labels are equal.

    ``pages`` gives how many pages are behind a node that both sides have: their sum
    for sides of different pages, the larger for neighbours of one side.
    """
    same = a.text == b.text and a.text is not None
    size = 0 if same else a.size + b.size + sum(len(x.text or "") for x in (a, b) if x.text)
    node = Node(a.label, a.text if same else None, size, pages(a.pages, b.pages), a.optional or b.optional, a.repeated or b.repeated)
    left, right = [c.label for c in a.children], [c.label for c in b.children]
    if left == right:
        node.children = [align(x, y, pages) for x, y in zip(a.children, b.children)]
        return node
    merged: list[Node] = []
    for kind, i, j, k, m in difflib.SequenceMatcher(None, left, right, autojunk=False).get_opcodes():
        if kind == "equal":
            merged += [align(x, y, pages) for x, y in zip(a.children[i:j], b.children[k:m])]
        else:
            for child in (*a.children[i:j], *b.children[k:m]):
                child.optional = True
                merged.append(child)
    node.children = _folded(merged)
    return node


def _folded(nodes: Iterable[Node]) -> list[Node]:
    """Neighbours with one label become one repeated node."""
    out: list[Node] = []
    for node in nodes:
        if out and out[-1].label == node.label:
            optional = out[-1].optional and node.optional
            out[-1] = align(out[-1], node, max)
            out[-1].optional, out[-1].repeated = optional, True
        else:
            out.append(node)
    return out


def page_wrapper(element: Element) -> Node:
    """A page as a wrapper that only it matches, its repetitions folded. Ruled-out elements are left out."""
    texts = [i for i in element.items if isinstance(i, str)]
    children = [page_wrapper(i) for i in element.items if isinstance(i, Element) and not i.dropped]
    return Node(element.label, "\n".join(texts), children=_folded(children))


def merge(a: Node | None, b: Node) -> Node:
    return b if a is None else align(a, b, operator.add)


def _article_like(label: str) -> bool:
    return label.endswith("@article") or label.split(".")[0] == "article"


def _found(node: Node, wanted, out: frozenset[str], path: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
    """Paths to the outermost nodes that are wanted."""
    for child in node.children:
        here = (*path, child.label)
        if child.label in out:
            continue
        if wanted(child.label):
            yield here
        else:
            yield from _found(child, wanted, out, here)


def _at(node: Node, path: tuple[str, ...]) -> Iterator[Node]:
    if not path:
        yield node
    for child in node.children if path else ():
        if child.label == path[0]:
            yield from _at(child, path[1:])


def _mass(node: Node, out: frozenset[str] = frozenset()) -> int:
    """Characters seen in slots."""
    return (node.size if node.text is None else 0) + sum(_mass(c, out) for c in node.children if c.label not in out)


def _weight(node: Node) -> int:
    """Characters seen, those of fixed texts once for each page."""
    own = node.size if node.text is None else len(node.text) * node.pages
    return own + sum(map(_weight, node.children))


def _holds_article(node: Node) -> bool:
    return any(
        _article_like(c.label) or c.label.split(".")[0] in ("main", "h1") or _holds_article(c) for c in node.children
    )


def _ruled_out(node: Node, whole: int) -> Iterator[str]:
    """Labels of suspicious nodes that are not what the host's pages are about."""
    for child in node.children:
        if _label_suspicious(child.label) and not _holds_article(child) and _weight(child) < WHOLE_SHARE * whole:
            yield child.label
        else:
            yield from _ruled_out(child, whole)


def _fixed_texts(node: Node, out: frozenset[str], pages: int, names: frozenset[str] = BLOCKS | {""}) -> Iterator[str]:
    """Texts that at least ``pages`` pages have at one place, in elements of these names."""
    if node.text and node.pages >= pages and node.label.split(".")[0] in names:
        yield from node.text.split("\n")
    for child in node.children:
        if child.label not in out:
            yield from _fixed_texts(child, out, pages, names)


@dataclass
class Rule:
    """Where a host's article may lie: paths of labels from the root down, texts that are template there, labels to leave out."""

    paths: tuple[tuple[str, ...], ...] = ()
    template: frozenset[str] = frozenset()
    out: frozenset[str] = frozenset()

    def packed(self) -> str:
        return json.dumps([self.paths, sorted(self.template), sorted(self.out)])

    @classmethod
    def unpacked(cls, packed: str) -> Rule:
        paths, template, out = json.loads(packed)
        return cls(tuple(map(tuple, paths)), frozenset(template), frozenset(out))


def main_rule(wrapper: Node) -> Rule:
    """All article or else main elements, or the element that gathers the varying text."""
    out = frozenset(_ruled_out(wrapper, _weight(wrapper)))
    for wanted in (_article_like, lambda label: label.split(".")[0] == "main"):
        paths = tuple(dict.fromkeys(_found(wrapper, wanted, out)))
        if paths:
            nodes = [n for path in paths for n in _at(wrapper, path)]
            pages = max(TEMPLATE_PAGES, wrapper.pages)
            fixed = frozenset(t for n in nodes for t in _fixed_texts(n, out, pages, BOXES))
            varying = sum(_mass(n, out) for n in nodes)
            small = sum(map(len, fixed)) * wrapper.pages <= (1 - WHOLE_SHARE) * varying
            return Rule(paths, fixed if small else frozenset(), out)
    node, path = wrapper, ()
    while inner := [c for c in node.children if c.label not in out]:
        best = max(inner, key=lambda c: _mass(c, out))
        if _mass(best, out) < MAIN_SHARE * _mass(node, out) or not _mass(best, out) or best.repeated:
            break
        node, path = best, (*path, best.label)
    template = frozenset(_fixed_texts(node, out, TEMPLATE_PAGES)) if _mass(node, out) else frozenset()
    return Rule((path,) if path else (), template, out)


def _descend(element: Element, paths: Iterable[tuple[str, ...]]) -> list[Element]:
    every = []
    for path in paths:
        found = [element]
        for label in path:
            found = [i for e in found for i in e.items if isinstance(i, Element) and not i.dropped and i.label == label]
        every += found
    return every


def main_text(page: str, rule: Rule | None) -> str:
    """The article's blocks, joined by line breaks.

    Of several elements at the rule's places the one with most text is the article.
    A page that has none follows a rule of its own, and if that finds nothing, one that
    looks into elements ruled out by class too.
    """
    root = parse(page)
    texts = [list(blocks(e, rule.out)) for e in _descend(root, rule.paths)] if rule else []
    if not any(texts):
        if not any(blocks(root)):
            _admit(root)
        rule = main_rule(page_wrapper(root))
        if not rule.paths:
            # Nothing varies on one page: the largest element, as if all text did.
            rule = Rule((_largest(root, rule.out),), frozenset(), rule.out)
        texts = [list(blocks(e, rule.out)) for e in _descend(root, rule.paths)]
    best = max(texts, key=lambda t: sum(map(len, t)), default=[])
    return "\n".join(t for t in best if t not in rule.template)


def _admit(root: Element) -> None:
    """Takes back what was ruled out by class only."""
    todo = [root]
    while todo:
        element = todo.pop()
        element.dropped &= not element.by_class
        todo += [i for i in element.items if isinstance(i, Element)]


def _largest(root: Element, out: frozenset[str]) -> tuple[str, ...]:
    """Labels of the element that still has most of the text, as deep as one child holds most of it."""
    path: list[str] = []
    element = root
    while True:
        inner = [i for i in element.items if isinstance(i, Element) and not i.dropped and i.label not in out]
        if not inner:
            return tuple(path)
        sizes = [sum(map(len, blocks(i, out))) for i in inner]
        most = max(sizes)
        best = inner[sizes.index(most)]
        alone = sum(i.label == best.label for i in inner) == 1
        if not alone or best.name == "p" or most < MAIN_SHARE * sum(map(len, blocks(element, out))):
            return tuple(path)
        path.append(best.label)
        element = best


# --- Over tables --------------------------------------------------------------


def _with_host(pages: DataFrame) -> DataFrame:
    host = F.coalesce(F.expr("try_parse_url(url, 'HOST')"), F.lit(""))
    return pages.withColumn("host", F.lower(host))


def host_wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper``: each host's wrapper as JSON, inferred from all its pages.

    Tasks align the pages of each batch, one wrapper per host and batch; those are
    merged in ``PARTS`` parts per host and then as one, so a host with a third of all
    pages sends a few small rows per task. Equal pages of a batch count once.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(batches):
            wrappers: dict[str, Node | None] = defaultdict(lambda: None)
            seen = set()
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                if (host, page) not in seen:
                    seen.add((host, page))
                    wrappers[host] = merge(wrappers[host], page_wrapper(parse(page)))
            rows = [(h, number % PARTS, json.dumps(w.packed())) for h, w in wrappers.items()]
            yield pa.RecordBatch.from_pylist([dict(zip(("host", "part", "wrapper"), r)) for r in rows], _SCHEMA)

    def merged(table: pa.Table) -> pa.Table:
        wrapper = None
        for packed in sorted(table.column("wrapper").to_pylist()):
            wrapper = merge(wrapper, Node.unpacked(json.loads(packed)))
        return table.slice(0, 1).set_column(
            table.schema.get_field_index("wrapper"), "wrapper", pa.array([json.dumps(wrapper.packed())])
        )

    rows = _with_host(pages).filter("html is not null").select("host", "html")
    kind = "host string, part int, wrapper string"
    parts = rows.mapInArrow(partial, kind).withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(PARTS)).cast("int"))
    some = parts.groupBy("host", "part").applyInArrow(merged, kind)
    return some.groupBy("host").applyInArrow(merged, kind).select("host", "wrapper")


_SCHEMA = pa.schema([("host", pa.string()), ("part", pa.int32()), ("wrapper", pa.string())])


def host_rules(wrappers: DataFrame) -> DataFrame:
    """``host, rule``: where the article lies on each host's pages, as JSON."""

    def rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_rule(Node.unpacked(json.loads(w))) for w in batch.column("wrapper").to_pylist()]
            packed = [r.packed() for r in found]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(packed, pa.string())], ["host", "rule"])

    return wrappers.mapInArrow(rules, "host string, rule string")


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (page_id, url, html).

    ``text`` has the blocks of the article in page order, one per line, references
    decoded and white space inside a block made one space; it is empty for null, empty
    and article-less pages. ``n_chars`` counts its code points. Pages without a
    readable host are one host. Repeated rows are extracted each; extra columns are
    ignored. Rules, one row per host, are written first, so that Spark ships them if
    their size allows and otherwise joins by host, splitting large hosts.
    """
    rules = materialize(host_rules(host_wrappers(pages)), "host-rules")
    rows = _with_host(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")))
    rows = rows.join(rules, "host", "left").select("page_id", "url", "html", "rule")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Rule] = {}
        for batch in batches:
            texts = []
            for page, packed in zip(batch.column("html").to_pylist(), batch.column("rule").to_pylist()):
                if packed is not None and packed not in known:
                    known[packed] = Rule.unpacked(packed)
                texts.append(main_text(page, known.get(packed)))
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text"])

    found = rows.mapInArrow(extract, "page_id long, url string, text string")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
