"""Main texts of pages by wrappers that are inferred per host from aligned pages."""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import stage

#: Hosts whose wrappers a task holds before it hands them on.
MOST_HOSTS = 5_000
#: Of deeper elements, paths name only articles, main elements and surroundings.
MOST_DEPTH = 64
#: From so many pages of a host on, what is the same in all its articles is no part of them.
TOLD_PAGES = 5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title)(?![\w:-]).*?(?:</\1\s*>|\Z)"
    r"|<[/!?a-z](?:[^>\"']|\"[^\"]*\"|'[^']*')*+>"
    r"|<[/!?a-z][^>]*(?:>|\Z)",
    re.S | re.I,
)
#: Elements without text of the page, which count as empty where their end is missing.
_UNSEEN = frozenset("noscript template svg iframe select object canvas".split())
_UNSEEN_NAME = rf"(?:{'|'.join(sorted(_UNSEEN))})(?![\w:-])"
_UNSEEN_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title)(?![\w:-])(?![^>]*/>)"
    rf".*?(?:</\1\s*>|(?=</{_UNSEEN_NAME})|\Z)"
    rf"|<(/?)({_UNSEEN_NAME})(?:(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*>)",
    re.S | re.I,
)
#: A slash before the end of a tag, other than that of an address without quotes.
_EMPTY_TAG = re.compile(r"(?<!=)(?:\s|[\"']|<[a-z]+|\s[^\s=\"'>]+)/>\Z", re.I)
_TAG = re.compile(r"<(/?)([a-z][a-z0-9:-]*)", re.I)
_NUMBERED = re.compile(r"[^\W_]*\d[^\W_]*")
_NAMED = re.compile(r"""(?<![\w-])(?:class|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"

#: Elements that end a block of text; others stand within it.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
    "ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements without an end.
_EMPTY = frozenset("hr option".split())
#: Elements within a block that have no end.
_VOID = frozenset("img input br wbr area base col embed link meta param source track".split())
#: A new one ends an open one of its kind, up to the nearest of the elements that hold it.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"},
}
_HOLDS = frozenset("ul ol dl table div section article body menu".split())
#: Elements and names of what surrounds an article.
AROUND = frozenset("nav header footer aside form menu dialog head fieldset button".split())
AROUND_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored banner promo nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar footer header masthead topbar cookie cookies "
    "consent notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "share sharing social related recommended pagination pager comment comments reply replies "
    "respond disqus complementary contentinfo".split()
)
_INSIDE = frozenset({"article", "main"})
_WHOLE = _INSIDE | {"html", "body"}
#: Elements that are no part of a page by themselves, but of the text or list around them.
_PARTS_OF_TEXT = frozenset(
    "p blockquote pre li dt dd h1 h2 h3 h4 h5 h6 caption figcaption legend summary thead tbody "
    "tfoot tr td th".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ARTICLE_NAMES = frozenset("article entry post story content".split())
#: Classes of articles that are not that of the page.
_OTHER_ARTICLES = frozenset("comment comments reply related teaser promo advert ad".split())

#: The labels of an element and those around it, the outermost first.
Path = tuple[str, ...]


@dataclass
class Node:
    """An element of a page, or of a wrapper that stands for it on many pages.

    ``weight`` counts the characters of its own text slots, ``text`` is a digest of the text
    where that is the same on all ``pages``, None where it differs.
    """

    label: str
    children: list[Node] = field(default_factory=list)
    repeated: bool = False
    optional: bool = False
    weight: int = 0
    text: str | None = ""
    pages: int = 1

    def dump(self) -> list:
        flags = self.repeated + 2 * self.optional
        inner = [child.dump() for child in self.children]
        return [self.label, flags, self.weight, self.text, self.pages, inner]

    @classmethod
    def load(cls, raw: list) -> Node:
        label, flags, weight, text, pages, inner = raw
        children = [cls.load(child) for child in inner]
        return cls(label, children, bool(flags & 1), bool(flags & 2), weight, text, pages)


def align(one: Node, other: Node, *, within_page: bool = False) -> Node:
    """The wrapper of two elements with the same label.

    Children are aligned by label; those that one side lacks become optional, texts that
    differ become slots. Neighbours within a page become one repeated element instead, whose
    text is that of both.
    """
    left, right = one.children, other.children
    children: list[Node] = []
    i = j = 0
    for a, b in _common([c.label for c in left], [c.label for c in right]):
        children += map(_optional, [*left[i:a], *right[j:b]])
        children.append(align(left[a], right[b], within_page=within_page))
        i, j = a + 1, b + 1
    children += map(_optional, [*left[i:], *right[j:]])
    if within_page:
        text = _both_texts(one.text, other.text)
    else:
        text = one.text if one.text == other.text else None
    return Node(
        one.label,
        _squash(children),
        one.repeated or other.repeated,
        one.optional or other.optional,
        one.weight + other.weight,
        text,
        one.pages if within_page else one.pages + other.pages,
    )


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode(), digest_size=8).hexdigest()


def _both_texts(one: str | None, other: str | None) -> str | None:
    return None if one is None or other is None else _digest(one + other)


def _optional(node: Node) -> Node:
    node.optional = True
    return node


def _common(left: list[str], right: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence."""
    if left == right:
        return [(i, i) for i in range(len(left))]
    rows = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i in range(len(left) - 1, -1, -1):
        below, row = rows[i + 1], rows[i]
        for j in range(len(right) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if left[i] == right[j] else max(below[j], row[j + 1])
    pairs, i, j = [], 0, 0
    while i < len(left) and j < len(right):
        if left[i] == right[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif rows[i + 1][j] >= rows[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def _squash(children: list[Node]) -> list[Node]:
    """Neighbours with the same label become one repeated element."""
    result: list[Node] = []
    for child in children:
        if result and result[-1].label == child.label:
            optional = result[-1].optional and child.optional
            result[-1] = align(result[-1], child, within_page=True)
            result[-1].repeated, result[-1].optional = True, optional
        else:
            result.append(child)
    return result


def _unseen(page: str) -> dict[int, int]:
    """Starts and ends of unseen elements, without empty ones and those that never end."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for match in _UNSEEN_TAG.finditer(page):
        if not match[3]:
            continue
        starts = opened.setdefault(match[3].lower(), [])
        if not match[2]:
            if not _EMPTY_TAG.search(match[0]):
                starts.append(match.start())
        elif starts:
            ends[starts.pop()] = match.end()
    return ends


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """The token stream of a page: kind (text, open, close), name, rest."""
    at = 0
    ends: dict[int, int] | None = None
    matches = _TOKEN.finditer(page)
    while match := next(matches, None):
        if match.start() > at:
            yield "text", "", page[at : match.start()]
        at = match.end()
        tag = None if match[1] else _TAG.match(match[0])
        if not tag:
            continue
        name = tag[2].lower()
        if name not in _UNSEEN:
            yield "close" if tag[1] else "open", name, match[0]
        elif not tag[1]:
            ends = _unseen(page) if ends is None else ends
            if match.start() in ends:
                at = ends[match.start()]
                matches = _TOKEN.finditer(page, at)
    if at < len(page):
        yield "text", "", page[at:]


def _label(name: str, tag: str) -> str:
    """An element's name and classes; numbers in classes tell which one it is, not its kind."""
    if "=" not in tag:
        return name
    return ".".join([name, *sorted({_NUMBERED.sub("0", found) for found in _names(tag)})])


def _names(tag: str) -> list[str]:
    """Classes and roles of an element. Its id says which one it is, not of what kind."""
    return " ".join("".join(found) for found in _NAMED.findall(tag)).lower().split()


class Page:
    """A page's elements with their text blocks, in page order."""

    def __init__(self, page: str) -> None:
        self.blocks: list[tuple[Path, str]] = []
        #: Names and paths of the open elements, and the places of each name among them.
        self._names: list[str] = []
        self._paths: list[Path] = [()]
        self._places: dict[str, list[int]] = {}
        self._text: list[str] = []
        #: Open elements of the name of an advert or button that stands within a block.
        aside, depth = "", 0
        for kind, name, rest in tokens(page):
            if name in BLOCKS:
                aside, depth = "", 0  # at the latest where the block ends
            elif depth and name == aside:
                depth += 1 if kind == "open" else -1
            elif not depth and kind == "open" and _aside(name, rest):
                aside, depth = name, 1
            if kind == "text":
                if not depth:
                    self._text.append(rest)
            elif name == "br":
                self._text.append(" ")
            elif name in BLOCKS:
                self._end_block()
                if kind == "close":
                    self._close(name)
                else:
                    self._open(name, rest)
        self._end_block()

    def _end_block(self) -> None:
        if self._text:
            text = " ".join(html.unescape("".join(self._text)).split())
            self._text.clear()
            if text:
                self.blocks.append((self._paths[-1], text))

    def _last(self, names: Iterable[str]) -> int:
        """The place of the innermost open element of these names, or -1."""
        return max((self._places[name][-1] for name in names if self._places.get(name)), default=-1)

    def _end(self, at: int) -> None:
        """End the elements from this place on."""
        for name in self._names[at:]:
            self._places[name].pop()
        del self._names[at:], self._paths[at + 1 :]

    def _close(self, name: str) -> None:
        at = self._last([name])
        if at >= 0:
            self._end(at)

    def _open(self, name: str, tag: str) -> None:
        if self._names and self._names[-1] == "p":
            self._end(len(self._names) - 1)
        if name in _CLOSES:
            at = self._last(_CLOSES[name])
            if at > self._last(_HOLDS):
                self._end(at)
        if name not in _EMPTY:
            self._places.setdefault(name, []).append(len(self._names))
            self._names.append(name)
            self._paths.append(_deeper(self._paths[-1], _label(name, tag)))

    def wrapper(self) -> Node:
        """The page as a tree, neighbours of one kind aligned into repeated elements."""
        root = Node("")
        for path, text in self.blocks:
            node = root
            for label in path:
                if not node.children or node.children[-1].label != label:
                    node.children.append(Node(label))
                node = node.children[-1]
            node.repeated = node.repeated or node.weight > 0
            node.text = _digest((node.text or "") + text)
            node.weight += len(text)
        return root


def _aside(name: str, tag: str) -> bool:
    """Whether an element within a block is a button, an advert or the like."""
    if name in _VOID or tag.endswith("/>"):
        return False
    return name in AROUND or "=" in tag and any(found in AROUND_NAMES for found in _names(tag))


def surrounds(label: str) -> bool:
    """Whether an element is a menu, notice, advert or the like.

    Elements that hold whole pages are not, whatever they are called, nor is the header of an
    article. An article is one of the readers' or of another page if its class says just that.
    """
    name, *names = label.split(".")
    if name == "article":
        return any(found in _OTHER_ARTICLES for found in names)
    if name in _WHOLE:
        return False
    return name in AROUND or any(map(_names_surroundings, names))


def _names_surroundings(name: str) -> bool:
    parts = re.split(r"[-_]", name)
    if parts[-1] == "header" and parts[0] in _ARTICLE_NAMES:
        return False
    return any(part in AROUND_NAMES for part in parts)


def _deeper(path: Path, label: str) -> Path:
    """The path of an element within another.

    Below ``MOST_DEPTH`` only elements that tell what is text have a part in it, one of each
    kind in a row: the first is what decides.
    """
    if len(path) >= MOST_DEPTH:
        kind = _kind(label)
        since = [_kind(x) for x in path[MOST_DEPTH:]]
        for at in range(len(since) - 1, -1, -1):
            if since[at] in _INSIDE and kind not in _INSIDE:
                del since[:at]
                break
        if not kind or kind in since:
            return path
    return (*path, label)


def _kind(label: str) -> str:
    name = label.split(".")[0]
    return name if name in {"header", *_INSIDE} else "around" if surrounds(label) else ""


def _holds_article(node: Node) -> bool:
    return any(
        child.label.split(".")[0] in _INSIDE or _holds_article(child) for child in node.children
    )


def _own_header(label: str, parent: str, *, told: bool) -> bool:
    """Whether a header outside articles may be that of the text.

    One at the top of the page is only if ``told``: if enough pages are aligned to tell
    whether it is the same on all.
    """
    name, *names = label.split(".")
    if name != "header" or any(map(_names_surroundings, names)):
        return False
    return told or parent.split(".")[0] not in {"", *_WHOLE}


def varying(wrapper: Node) -> tuple[list[Path], list[Path]]:
    """The lowest element with all text that differs from page to page, and what it leaves out.

    Surroundings, articles and main elements do not count. Left out are surroundings and
    the parts (divisions, lists, tables, ...) whose text is the same on all pages; a heading
    or paragraph that is the same on all pages stays beside text that differs. Texts of one
    or two pages cannot be told from constant ones and count as different.
    """
    lowest: Path | None = None
    kept: set[Path] = set()
    left: list[Path] = []

    def visit(node: Node, path: Path) -> bool:
        nonlocal lowest
        varies = node.weight > 0 and not (node.pages > 2 and node.text)
        if varies:
            lowest = path if lowest is None else _shared(lowest, path)
        for child in node.children:
            name, where = child.label.split(".")[0], (*path, child.label)
            if name in _INSIDE:
                continue
            told = child.pages > 2
            around = surrounds(child.label) and not _own_header(
                child.label, node.label, told=told
            )
            if not around and visit(child, where):
                varies = True
                kept.add(where)
            elif around or name not in _PARTS_OF_TEXT:
                left.append(where)
        return varies

    visit(wrapper, ())
    if lowest is None:
        return [], []
    while lowest and lowest[-1].split(".")[0] in _PARTS_OF_TEXT:
        lowest = lowest[:-1]
    out = [path for path in left if path not in kept and _shared(lowest, path) == lowest]
    return [lowest], list(dict.fromkeys(out))


def _shared(one: Path, other: Path) -> Path:
    at = 0
    while at < min(len(one), len(other)) and one[at] == other[at]:
        at += 1
    return one[:at]


def template_parts(article: Node, where: Path) -> tuple[set[Path], set[Path]]:
    """Paths of an article's parts that belong to its host's template, and of its own parts.

    The template's are the parts (divisions, lists, tables, ...) that the articles of all
    pages have with the same text. Headings and paragraphs that are always the same stay
    beside other text. An article of fewer than ``TOLD_PAGES`` pages, and one in which at
    most headings differ from page to page, has own parts only: its pages may be copies.
    """
    same: set[Path] = set()
    own: set[Path] = set()
    told = False

    def visit(node: Node, path: Path) -> bool:
        nonlocal told
        name = node.label.split(".")[0]
        differs = node.weight > 0 and node.text is None
        told = told or (differs and name not in _HEADINGS)
        constant = node.pages == article.pages and not differs
        for child in node.children:
            if surrounds(child.label) and child.label.split(".")[0] != "header":
                continue
            constant = visit(child, (*path, child.label)) and constant
        part = name not in _PARTS_OF_TEXT and name not in _INSIDE
        (same if constant and part else own).add(path)
        return constant

    visit(article, where)
    if told and article.pages >= TOLD_PAGES:
        return same, own
    return set(), same | own


def regions(wrapper: Node) -> list[tuple[list[Path], list[Path]]]:
    """Paths of the elements that hold the main text, and of parts of them that do not.

    Articles; for pages without, main elements; then either of them within what would
    surround an article; for pages without any, the lowest element that holds all text that
    differs from page to page. Parts that are the same on all pages are left out of each.
    """
    same: set[Path] = set()
    own: set[Path] = set()
    found: dict[tuple[str, bool], list[Path]] = {
        (name, around): [] for around in (False, True) for name in ("article", "main")
    }

    def visit(node: Node, path: Path, around: bool) -> None:
        for child in node.children:
            name, where = child.label.split(".")[0], (*path, child.label)
            inside = any(label.split(".")[0] in _INSIDE for label in path)
            within = around
            if surrounds(child.label) and not (name == "header" and inside):
                if not _holds_article(child):
                    continue
                within = True
            if name in _INSIDE and not (name == "article" and surrounds(child.label)):
                found[name, within].append(where)
                if not inside:
                    for paths, parts in zip((same, own), template_parts(child, where)):
                        paths |= parts
            visit(child, where, within)

    visit(wrapper, (), False)
    ranks = []
    for paths in found.values():
        left = [x for x in sorted(same - own) if any(x[: len(path)] == path for path in paths)]
        ranks.append((list(dict.fromkeys(paths)), left))
    return [rank for rank in (*ranks, varying(wrapper)) if rank[0]]


def region(wrapper: Node) -> list[Path]:
    """Paths of the elements that hold the main text of most pages."""
    return next((inside for inside, _ in regions(wrapper)), [])


def main_text(page: Page, ranks: list[tuple[list[Path], list[Path]]]) -> str:
    """The blocks within the first regions that a page has, without what surrounds articles."""

    def chosen(where: list[Path], left: list[Path]) -> list[str]:
        texts = []
        for path, text in page.blocks:
            for start in where:
                if path[: len(start)] == start:
                    inner = path[len(start) :]
                    around = any(surrounds(x) and x.split(".")[0] != "header" for x in inner)
                    if not around and not any(path[: len(x)] == x for x in left):
                        texts.append(text)
                    break
        return texts

    for where, left in ranks:
        if texts := chosen(where, left):
            return "\n\n".join(texts)
    for where, left in regions(page.wrapper()):
        if texts := chosen(where, left):
            return "\n\n".join(texts)
    return ""


def _dump(wrapper: Node) -> str:
    return json.dumps(wrapper.dump(), ensure_ascii=False, separators=(",", ":"))


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper for the pages of each host that this task has."""
    held: dict[str, Node] = {}
    for batch in batches:
        for host, text in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            wrapper = Page(text).wrapper()
            held[host] = _both(held[host], wrapper) if host in held else wrapper
        if len(held) > MOST_HOSTS:
            yield _wrappers(held)
            held = {}
    yield _wrappers(held)


def _both(one: Node, other: Node) -> Node:
    return align(one, other)


def _wrappers(held: dict[str, Node]) -> pa.RecordBatch:
    texts = [_dump(node) for node in held.values()]
    return pa.RecordBatch.from_arrays(
        [pa.array(held, pa.string()), pa.array(texts, pa.string())], ["host", "wrapper"]
    )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Align the wrappers of each host, which come one after another."""
    current: tuple[str, Node] | None = None
    for batch in batches:
        done: dict[str, Node] = {}
        for host, raw in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist()):
            node = Node.load(json.loads(raw))
            if current and current[0] == host:
                current = (host, _both(current[1], node))
            else:
                if current:
                    done[current[0]] = current[1]
                current = (host, node)
        yield _regions(done)
    if current:
        yield _regions(dict([current]))


def _regions(held: dict[str, Node]) -> pa.RecordBatch:
    where = [json.dumps(regions(node), ensure_ascii=False) for node in held.values()]
    texts = [_dump(node) for node in held.values()]
    columns = [pa.array(column, pa.string()) for column in (list(held), texts, where)]
    return pa.RecordBatch.from_arrays(columns, ["host", "wrapper", "regions"])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, list[tuple[list[Path], list[Path]]]] = {}
    for batch in batches:
        texts = []
        for text, raw in zip(batch.column("html").to_pylist(), batch.column("regions").to_pylist()):
            if raw not in known:
                if len(known) > MOST_HOSTS:
                    known.clear()
                known[raw] = [
                    (list(map(tuple, where)), list(map(tuple, left)))
                    for where, left in json.loads(raw or "[]")
                ]
            texts.append(main_text(Page(text), known[raw]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array([len(text) for text in texts], pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )


def _pages(pages: DataFrame) -> DataFrame:
    url = F.col("url").cast("string")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        url.alias("url"),
        F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1)).alias("host"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper and regions (both JSON): one union-free expression for each host.

    Each task aligns the pages of a host that it reads one after another; then the tasks'
    wrappers of a host, at most one or a few from each, are aligned with each other.
    """
    partial = stage(
        _pages(pages).select("host", "html").mapInArrow(_infer, "host string, wrapper string"),
        "page_wrappers",
    )
    return (
        partial.repartition("host")
        .sortWithinPartitions("host", "wrapper")
        .mapInArrow(_merge, "host string, wrapper string, regions string")
    )


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page with its main text.

    A page is a tree of its block elements, with the text blocks as leaves. Neighbours of
    one kind are aligned into a repeated element; pages of a host are aligned into its
    wrapper, in which elements that some pages lack are optional and texts that differ are
    slots. The wrapper tells which elements hold the article, and which parts of it are the
    same in all articles of the host and so none of its text; where a page does not have
    such elements, the text that differs from page to page does, then its own tree.

    Columns: page_id, url, text, n_chars. A null html is empty and has an empty text; pages
    without a host in their url are one host; repeated rows give repeated results; an
    empty table gives no rows; other columns are ignored.
    """
    regions = stage(infer_wrappers(pages).select("host", "regions"), "page_regions")
    return (
        _pages(pages)
        .join(regions, "host", "left")
        .select("page_id", "url", "html", "regions")
        .mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
    )
