"""Main text of web pages by tree scoring.

A page becomes a tree of elements with a forgiving parser. Parts that are never main text are left
out (scripts, forms, navigation, footers, hidden elements). Elements whose class, id or role says advert,
sidebar, comments and the like do not take part in the choice; inside what is chosen, and in any article, only
those go that a whole name calls a menu, advert or comment list and whose own text does not deny it. Every paragraph earns
points for its length and its commas and passes them to its ancestors, in full to the parent, half to the grandparent, a
sixth to the next and two thirds of that with each further level; a container's points are discounted by the share of its
text that is links. The best container is kept, together with siblings that score well or read like text, all that stands
between these and is no collection of links, a heading before them and lists, tables and quotes right after them.

Parsing and scoring visit every element a fixed number of times, however deep the page is nested.
"""

from __future__ import annotations

import html as html_entities
import re
from collections import Counter, defaultdict

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import arrow_input, arrow_output, small_batches

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                   r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
#: One attribute; values in quotes are taken with it, so nothing inside them is read as another one.
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>]+)))?|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)")

#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is raw text.
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
#: Elements that never hold main text.
DROPPED = frozenset("head script style noscript template nav footer aside form button select option textarea input "
                    "iframe object embed svg canvas audio video map dialog menu title xmp noembed noframes plaintext".split())
#: Elements that end a block of text.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table "
                   "tbody td tfoot th thead tr ul caption".split())
#: Start tags that close an open p; and those that close an open sibling of the listed kinds.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"),
          "tfoot": ("tbody", "thead", "tr", "td", "th")}
SCOPES = frozenset("table ul ol dl body html article section div main".split())
#: Words in class, id or role that mark other content.
UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|adsense|sponsor(?:ed)?|promo(?:tion)?s?|banner|cookies?|"
    r"consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|subscription|paywall|signup|login|"
    r"sidebar|side-bar|aside|widget|related|recommend(?:ed|ations)?|share|sharing|social|toolbar|breadcrumbs?|pagination|"
    r"pager|menu|nav|navbar|navigation|complementary|contentinfo|search|skip|masthead|site-header|page-header|topbar|"
    r"footer|foot|copyright|disclaimer|legal|comments?|commentlist|disqus|replies|reply|respond|discussion|feedback|tags|"
    r"hidden|sr-only)(?=$|[\s_-])", re.I)
LIKELY = re.compile(r"(?:^|[\s_-])(?:article|content|main|story|post|entry|body|text)(?=$|[\s_-])", re.I)
#: Whole names (class or id) of boxes inside an article; what they say must fit their text (see _is_other).
ADVERT = re.compile(r"(?:ads?|advert\w*|adsense|sponsor(?:ed)?|promo(?:tion)?s?|banner|comment)"
                    r"(?:-(?:ads?|banner|box|slot|unit|container|wrapper|block|space|area|content|label|text|inline|item|body|\d+))*")
COMMENTS = re.compile(r"comments|comment-?list|comments-(?:area|list|section|wrapper|container)|disqus(?:-thread)?|replies|respond")
MENU = re.compile(r"(?:(?:site|page|main|top|side|sub|post|article|entry|social|share|sharing|related|recommended)-)*"
                  r"(?:menu|nav|navbar|navigation|breadcrumbs?|pagination|pager|toolbar|topbar|sidebar|side-bar|share|sharing|social|"
                  r"related|recommended|recommendations|tags|widget|newsletter|subscribe|skip|footer|masthead|buttons|links|posts|"
                  r"articles|stories|bar)(?:-(?:menu|list|links|bar|box|buttons|container|wrapper|items))*")
#: Roles that say the same as nav, aside, footer, dialog and the like.
ROLES = frozenset("navigation complementary contentinfo search banner menu menubar toolbar dialog alertdialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold other blocks; those of a whole page are no article text for being there.
HOLDERS = frozenset("div section ul ol dl table tbody tr td header aside fieldset details".split())
#: What belongs to the text before it, if no link is in it.
APPENDED = frozenset("ul ol dl blockquote pre table figure".split())
#: Ends of a sentence.
STOPS = re.compile("[.!?…。！？．｡]")
#: Where the search for an open p ends.
PARAGRAPH_STOPS = SCOPES | {"p", "td", "th", "li"}
#: Cells and tables keep these end tags from what is open around them.
CELLS = frozenset("td th table".split())
KEPT_BY_CELLS = frozenset("p b i a span".split())
SPACE = re.compile(r"\s+")


class Node:
    """An element. Besides its own marks it knows the nearest element, itself included, at which the search for an open
    p ends, the depths of the nearest scope and cell, and whether an article (or main) surrounds or is it."""

    __slots__ = ("tag", "parent", "children", "hint", "names", "dropped", "soft", "score", "length", "linked", "order", "own",
                 "depth", "stop", "scope", "cell", "article", "inside", "freed")

    def __init__(self, tag, parent, hint="", names=(), dropped=False, soft=False):
        self.tag, self.parent, self.hint, self.names = tag, parent, hint, names
        self.dropped, self.soft = dropped or soft, soft and not dropped  # soft: dropped by its hint alone
        self.children = []
        self.score = 0.0
        self.length = self.linked = 0
        self.freed = False
        self.depth = depth = parent.depth + 1 if parent else 0
        self.stop = self if parent is None or tag in PARAGRAPH_STOPS else parent.stop
        self.scope = depth if parent is None or tag in SCOPES else parent.scope
        self.cell = depth if tag in CELLS else parent.cell if parent else -1
        self.article = tag == "article" or parent is not None and parent.article
        self.inside = tag in ("article", "main") or parent is not None and parent.inside


class OpenElements:
    """The path from the root to the element that takes what comes next, with the open elements of every tag."""

    def __init__(self, root: Node):
        self.here = root
        self._by_tag = defaultdict(list)

    def enter(self, node: Node) -> None:
        self.here = node
        self._by_tag[node.tag].append(node)

    def close(self, node: Node) -> None:
        """End ``node`` and all that is open inside it."""
        while self.here is not node.parent:
            self._by_tag[self.here.tag].pop()
            self.here = self.here.parent

    def nearest(self, tags, below: int) -> Node | None:
        """The deepest open element of the tags that is deeper than ``below``."""
        found = [self._by_tag[t][-1] for t in tags if self._by_tag.get(t)]
        best = max(found, key=lambda n: n.depth, default=None)
        return best if best is not None and best.depth > below else None


def parse(source: str) -> Node:
    """The element tree; children are nodes and strings. Unclosed and stray tags are tolerated."""
    root = Node("html", None)
    path, at = OpenElements(root), 0
    size = len(source)
    while at < size:
        found = TOKEN.search(source, at)
        if not found:
            path.here.children.append(source[at:])
            break
        if found.start() > at:
            path.here.children.append(source[at:found.start()])
        at = found.end()
        closing, tag, attributes = found[1], found[2], found[3]
        if tag is None:
            if found[0].startswith("<![CDATA["):
                path.here.children.append(found[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        tag = tag.lower()
        if closing:
            ended = path.nearest((tag,), path.here.cell if tag in KEPT_BY_CELLS else -1)
            if ended is not None:
                path.close(ended)
            continue
        if tag in BLOCKS and path.here.stop.tag == "p":  # a block ends an open paragraph, with whatever is open inside it
            path.close(path.here.stop)
        if tag in CLOSES:
            ended = path.nearest(CLOSES[tag], path.here.scope)
            while ended is not None and ended is not root and ended.tag in CLOSES[tag]:
                path.close(ended)
                ended = path.here
        here = path.here
        found_attributes = {}
        for name, *values in ATTRIBUTE.findall(attributes) if attributes else ():
            if name:
                found_attributes.setdefault(name.lower(), "".join(values))  # the first of a name counts
        if tag in ("html", "body") and here is root and tag == "html":
            continue
        own = [found_attributes.get(n, "") for n in ("class", "id", "role")]
        hint = " ".join(own).strip()
        hide = "hidden" in found_attributes or re.search(r"display\s*:\s*none", found_attributes.get("style", ""), re.I)
        node = Node(tag, here, hint, own[0].split() if tag in HEADINGS else [*own[0].split(), *own[1].split()],
                    bool(hide) or _never(tag, own[2], here), _unwanted(tag, hint))
        if tag == "main" and not node.dropped:
            up = here
            while up is not None and up.tag != "main" and not up.freed:  # what holds the main part is no menu
                up.dropped, up.freed = up.dropped and not up.soft, True
                up = up.parent
        here.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
            at = end.end() if end else size
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            path.enter(node)
    return root


def _never(tag: str, role: str, parent) -> bool:
    """Elements that are dropped wherever they are."""
    if tag in DROPPED or tag == "header" and not parent.inside:
        return True
    return tag not in ("html", "body", "article", "main") and not ROLES.isdisjoint(role.lower().split())


def _unwanted(tag: str, hint: str) -> bool:
    if tag in ("html", "body", "article", "main") or not hint:
        return False
    return bool(UNLIKELY.search(hint)) and not (LIKELY.search(hint) and not re.search(r"comment|sidebar|\bad|footer|nav", hint, re.I))


def _weigh(root: Node) -> None:
    """own of all elements that are not dropped for good: length, length of link text, commas, and how many
    items of one kind the element holds."""
    order = _order(root, True)
    for node in reversed(order):
        length = linked = commas = items = 0
        kinds = Counter()
        for c in node.children:
            if isinstance(c, str):
                length += len(c.strip())
                commas += c.count(",") + c.count("、") + c.count("，")
            elif c.soft or not c.dropped:
                n, k, m, i = c.own
                length, linked, commas, items = length + n, linked + (n if c.tag == "a" else k), commas + m, max(items, i)
                if c.tag in ("li", "div", "article", "section"):
                    kinds[c.tag, c.hint.split(" ")[0]] += 1
        node.own = length, linked, commas, max([items, *kinds.values()])


def _is_other(node: Node) -> bool:
    """Whether a whole name of an element in an article calls it a menu, advert or comment list, and its own
    text does not deny it: a menu has links, an advert or comment few words, a comment list several items."""
    length, linked, commas, items = node.own
    density = linked / length if length else 0.0
    points = (1 + commas + min(length / 100, 3)) * (1 - density)
    reads = length >= 200 and density < 0.25 and points >= 4
    names = [n.lower().replace("_", "-") for n in node.names]
    return (any(MENU.fullmatch(n) for n in names) and density >= 0.25 or any(ADVERT.fullmatch(n) for n in names) and not reads
            or any(COMMENTS.fullmatch(n) for n in names) and not (reads and items < 2))


def _settle(top: Node, holders: bool = True) -> None:
    """Bring back what hints alone dropped under ``top``, but for menus, adverts and comment lists; without
    ``holders`` only elements that hold no blocks."""
    stack = [top]
    while stack:
        node = stack.pop()
        for c in node.children:
            if isinstance(c, Node):
                if c.soft and c.dropped and (holders or c.tag not in HOLDERS):
                    c.dropped = _is_other(c)
                if not c.dropped:
                    stack.append(c)


def _order(root: Node, soft: bool = False) -> list[Node]:
    """Kept nodes, and with ``soft`` those that their hints alone dropped, parents before children."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.dropped and not (soft and node.soft):
            continue
        node.order = len(out)
        out.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return out


def blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks under the nodes, in page order: references decoded, white space made one blank."""
    out, now = [], []

    def end():
        text = SPACE.sub(" ", html_entities.unescape("".join(now))).strip()
        if text:
            out.append(text)
        now.clear()

    stack = [(n, False) for n in reversed(nodes)]
    while stack:
        node, done = stack.pop()
        if isinstance(node, str):
            now.append(node)
            continue
        if node.dropped:
            continue
        block = node.tag in BLOCKS
        if done:
            end()
            continue
        if node.tag == "br":
            now.append(" ")
            continue
        if block:
            end()
            stack.append((node, True))
        stack.extend((c, False) for c in reversed(node.children))
    end()
    return out


def _own_text(node: Node) -> str:
    """Text directly in a node and its inline descendants."""
    parts, stack = [], list(reversed(node.children))
    while stack:
        c = stack.pop()
        if isinstance(c, str):
            parts.append(c)
        elif not c.dropped and c.tag not in BLOCKS:
            stack.extend(reversed(c.children))
    return SPACE.sub(" ", html_entities.unescape("".join(parts))).strip()


def main_nodes(root: Node) -> list[Node]:
    """The best container, with siblings that belong to it, in page order."""
    _weigh(root)
    for node in _order(root):
        if node.tag == "article" and not node.parent.article:
            _settle(node)
    kept = _choose(root)
    for node in kept:
        if isinstance(node, str):
            continue
        _settle(node, node.tag not in ("html", "body"))
    return kept


def _choose(root: Node) -> list[Node]:
    order = _order(root)
    for node in reversed(order):  # lengths of text and of link text, from the leaves up
        for c in node.children:
            if isinstance(c, str):
                node.length += len(c.strip())
            elif not c.dropped:
                node.length += c.length
                node.linked += c.length if c.tag == "a" else c.linked
    given, candidates = defaultdict(float), set()
    for node in order:
        if node.tag not in BLOCKS and node is not root:
            continue
        text = _own_text(node)
        if not text or node.tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            continue
        density = node.linked / node.length if node.length else 0.0
        points = (1 + text.count(",") + text.count("、") + text.count("，") + min(len(text) / 100, 3)) * (1 - density)
        if len(text) < 25:
            points *= 0.25
        holder = node if node.tag in ("div", "section", "article", "main", "body", "td", "html") else node.parent or node
        given[holder] += points
        candidates.add(holder)
    near, far = defaultdict(float), defaultdict(float)  # points from children, and from below these
    for node in reversed(order):
        if node in candidates:
            node.score = given[node] + near[node] / 2 + far[node]
            if node.parent is not None:
                near[node.parent] += given[node]
                far[node.parent] += near[node] / 6 + far[node] * 2 / 3
                candidates.add(node.parent)
    if not candidates:
        return [root]
    for node in candidates:
        if node.tag in ("article", "main") or LIKELY.search(node.hint):
            node.score = 1.5 * node.score + 5
        node.score *= 1 - (node.linked / node.length if node.length else 0.0)
    best = max(candidates, key=lambda n: (n.score, -n.order))
    while best.parent is not None and best.tag not in ("article", "main") and best.parent.inside:
        best = best.parent  # an article is kept whole
    if best.parent is None:
        return [best]
    floor, kept = max(10.0, 0.2 * best.score), []
    for c in best.parent.children:
        if not isinstance(c, Node) or c.dropped:
            continue
        density = c.linked / c.length if c.length else 0.0
        if c is best or c in candidates and c.score >= floor and (c.tag == best.tag or density < 0.25) \
                or c.tag == "p" and (c.length > 80 and density < 0.25 or 0 < c.length <= 80 and not c.linked and STOPS.search(_own_text(c))):
            kept.append(c)
    if best.tag in ("article", "main"):
        return kept
    return _with_neighbours(best.parent.children, kept)


def _heading_only(node: Node) -> bool:
    """Whether an element is a heading, or holds nothing but one."""
    while node.tag not in HEADINGS:
        inner = [c for c in node.children if (c.strip() if isinstance(c, str) else not c.dropped and c.length)]
        if len(inner) != 1 or isinstance(inner[0], str):
            return False
        node = inner[0]
    return True


def _with_neighbours(siblings: list, kept: list[Node]) -> list:
    """The kept siblings, what stands between them unless it is mostly links, the last heading before them, and lists,
    tables and quotes without links that follow at once."""
    chosen = {id(c) for c in kept}
    first, last = (next(i for i in places if id(siblings[i]) in chosen)
                   for places in (range(len(siblings)), reversed(range(len(siblings)))))
    heads = [c for c in siblings[:first] if isinstance(c, Node) and not c.dropped and c.length and c.linked < c.length
             and _heading_only(c)]
    out = heads[-1:]
    for c in siblings[first:last + 1]:
        if isinstance(c, Node) and c.dropped and c.soft and c.tag not in HOLDERS:
            c.dropped = _is_other(c)
        if isinstance(c, str) or id(c) in chosen or not c.dropped and c.linked < 0.5 * max(c.length, 1):
            out.append(c)
    for c in siblings[last + 1:]:
        if isinstance(c, str) and not c.strip() or isinstance(c, Node) and c.tag in APPENDED and not c.dropped and not c.linked:
            out.append(c)
        else:
            break
    return out


def main_text(source: str | None) -> str:
    """Blocks of the main text joined by an empty line; empty for null, empty and textless pages."""
    return "\n\n".join(blocks(main_nodes(parse(source)))) if source else ""


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url"),
            names: tuple[str, str] = ("text", "n_chars")) -> DataFrame:
    """``keep`` columns, the main text of every page and its code points.

    Null and empty pages, and pages without text, give the empty text. Pages are read whole, whatever their
    length and nesting; repeated rows give equal texts, an empty table no rows; other columns are not read,
    and ``names`` renames the added ones should they clash.
    """
    import pyarrow as pa

    small_batches(pages.sparkSession)
    taken, schema, place = arrow_input(pages, keep, html)

    def read(batches):
        for batch in batches:
            texts = [main_text(t) for t in batch.column(place).to_pylist()]
            yield arrow_output(batch, len(keep), [pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())])

    return taken.mapInArrow(read, schema + "p0 string, p1 long").toDF(*keep, *names)
