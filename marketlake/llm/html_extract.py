"""Main text of web pages: block classifier costs and smoothness edges, cut by max-flow."""

from __future__ import annotations

import re
from collections import deque
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map, batch

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_UNSHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: Elements whose content is not markup or not shown: skipped up to their end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes template svg math canvas object".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option"
    " p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag of the key ends an open element of the values, not above the nearest stop.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody", "thead"),
}
STOPS = frozenset("ul ol dl table select menu body article section div".split())

#: Costs, in units of evidence: above 0 speaks for content.
ELEMENT = {
    "nav": -8.0, "footer": -8.0, "aside": -8.0, "form": -8.0, "menu": -8.0, "noscript": -8.0, "dialog": -8.0, "button": -8.0,
    "select": -8.0, "search": -8.0, "head": -20.0, "header": -4.0, "fieldset": -4.0, "article": 4.0, "main": 2.0, "h1": 3.5, "h2": 1.0,
}
NEGATIVE = frozenset(
    "ad ads adv advert advertisement advertising adverts alert author banner breadcrumb breadcrumbs byline comment commentary"
    " comments consent contact cookie cookies copyright disclaimer discussion disqus dropdown feedback foot footer gdpr head header"
    " legal login masthead menu menubar meta modal nav navbar navigation newsletter notice notification outbrain pager pagination"
    " paywall popup popular privacy promo promoted promotion rail rating recommended register related replies reply respond"
    " search share sharing shoutbox sidebar signup skip social sponsor sponsored subscribe subscription taboola tags teaser"
    " toolbar tooltip topbar trending warning widget widgets complementary contentinfo navigation dialog".split()
)
#: Names that stand for a container of boilerplate when a whole class, id or role is made of them and
#: of FILLER; inside an article, and on elements that hold text themselves, only these count.
CONTAINER = frozenset(
    "ad ads adv advert adverts advertisement advertisements banner breadcrumb breadcrumbs comment comments consent cookie"
    " cookies disqus gdpr menu menubar modal nav navbar newsletter notice notices outbrain pager pagination paywall popup promo"
    " promoted related replies responses share sharing shoutbox sidebar signup social sponsor sponsored subscribe taboola teaser toolbar topbar trending"
    " widget widgets".split()
)
FILLER = frozenset(
    "area articles bar block bottom box btn button buttons container content form group icons inner item items left link links"
    " list main outer overlay panel popular post posts reader readers right row section site slot stories tools top unit user users"
    " visitor visitors wrap wrapper".split()
)
ROLES = frozenset("banner complementary contentinfo dialog menu menubar navigation search toolbar".split())
TEXT = frozenset("article main h1 h2 h3 h4 h5 h6 p li dt dd td th pre blockquote figure figcaption caption address".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
POSITIVE = frozenset("article body content entry main post story text prose".split())
CLASS_COST, CLASS_GAIN = -7.0, 1.0
LINK_COST, LONG_GAIN, SHORT_GAIN, SHORT_COST, OUTSIDE_COST = -4.0, 1.0, 0.9, -1.0, -2.0
#: Words of a long block, and the share inside links from which a short one speaks for a menu.
LONG_WORDS, LINKED = 12, 0.25
#: Capacity between neighbours in page order, and more where they share their parent element.
ADJACENT, SIBLING = 0.4, 0.6


def _attributes(text: str) -> dict[str, str]:
    """The first value of each attribute, by lower-cased name; a bare name has an empty value."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), "".join(values))
    return out


def _names(value: str) -> set[str]:
    return {w.lower() for w in _WORDS.findall(value)}


def _container(tag: str, given: dict[str, str]) -> bool:
    """Whether a class, id or role as a whole names a container of boilerplate."""
    if given.get("role", "").lower() in ROLES:
        return True
    # a heading's id is made of its title
    tokens = given.get("class", "").split() + (given.get("id", "").split() if tag not in HEADINGS else [])
    return any((names := _names(t)) & CONTAINER and names <= CONTAINER | FILLER for t in tokens)


def _hidden(given: dict[str, str]) -> bool:
    return (
        given.get("hidden", "false").lower() not in ("false", "until-found")
        or given.get("aria-hidden", "").strip().lower() == "true"
        or _UNSHOWN.search(given.get("style", "")) is not None
    )


class _Element:
    __slots__ = ("tag", "parent", "cost", "marked", "named", "wraps", "chars")

    def __init__(self, tag, parent, attributes):
        self.tag, self.parent, self.wraps, self.chars = tag, parent, False, 0
        self.cost, self.marked, self.named = ELEMENT.get(tag, 0.0), 0.0, 0.0  # `named` holds inside an article
        if attributes and tag not in ("html", "body"):
            given = _attributes(attributes)
            names = {w for a in ("class", "id", "role") for w in _names(given.get(a, ""))}
            gain = CLASS_GAIN if names & POSITIVE else 0.0
            self.named = CLASS_COST if _container(tag, given) else gain
            self.marked = self.named if tag in TEXT else CLASS_COST if names & NEGATIVE else gain
            if _hidden(given):
                self.cost -= 20.0


def blocks(html: str) -> list[tuple[str, _Element, float]]:
    """(text, element, share of it inside links) of each text block, in page order."""
    root = _Element("", None, "")
    out, here, text, linked, link_depth = [], root, [], 0, 0
    at, size = 0, len(html)
    count: dict[str, int] = {}  # open elements by tag: an end tag without its start costs no walk

    def flush():
        nonlocal text, linked
        if text:
            joined = " ".join(unescape("".join(text)).split())
            if joined:
                out.append((joined, here, min(1.0, linked / max(1, sum(map(len, text))))))
                up = here
                while up is not None:
                    up.chars += len(joined)
                    up = up.parent
            text, linked = [], 0

    def opened(names, stops=frozenset()):
        if not any(count.get(n) for n in names):
            return None
        up = here
        while up is not root:
            if up.tag in names:
                return up
            if up.tag in stops:
                return None
            up = up.parent
        return None

    def close(match):
        nonlocal here
        while here is not match.parent:
            count[here.tag] -= 1
            here = here.parent

    while at < size:
        found = _TOKEN.search(html, at)
        if found is None or found.start() > at:
            piece = html[at : found.start() if found else size]
            text.append(piece)
            if link_depth:
                linked += len(piece)
        if found is None:
            break
        at = found.end()
        end, tag, attributes = found[1] or found[4], found[2] or found[5], found[3] or found[6] or ""
        if not tag:
            continue
        tag = tag.lower()
        if end:
            if tag == "a":
                link_depth = 0
            if tag in BLOCK:
                flush()
                if (match := opened({tag})) is not None:
                    close(match)
            elif (match := opened({tag}, BLOCK)) is not None:
                close(match)
            continue
        if tag in RAW:
            ended = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, at)
            at = ended.end() if ended else size
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK:
            flush()
            link_depth = link_depth if tag != "p" else 0
            if tag not in ("button", "option", "select") and (match := opened({"p"}, STOPS)) is not None:
                close(match)
            while tag in ENDS and (match := opened(ENDS[tag], STOPS)) is not None:
                close(match)
            if tag == "body" and (match := opened({"head"})) is not None:
                close(match)
        if tag in VOID:
            continue
        if tag == "a":
            link_depth = 1
        elif tag not in BLOCK and "=" not in attributes and "hidden" not in attributes:
            continue  # plain inline markup changes nothing
        if not attributes.rstrip().endswith("/") or tag in BLOCK:
            here = _Element(tag, here, attributes)
            count[tag] = count.get(tag, 0) + 1
    flush()
    return out


def scores(found: list[tuple[str, _Element, float]]) -> list[float]:
    """Evidence of each block for content (above 0) or boilerplate (below)."""
    bodies = {}
    for _, element, _ in found:
        up = element
        while up is not None:
            if up.tag in ("article", "main") and up.marked >= 0:
                bodies[id(up)] = up
            up = up.parent
    if bodies:  # the elements around the longest body are wrappers: their names say nothing of it
        up = max(bodies.values(), key=lambda e: (e.chars, e.tag == "article")).parent
        while up is not None:
            up.wraps = True
            up = up.parent
    # a form around most of the page, running text included, is a page's frame and no form to fill in
    page = sum(len(text) for text, _, _ in found)
    for text, element, linked in found:
        if linked <= LINKED and text.count(" ") + 1 >= LONG_WORDS:
            while element is not None:
                if element.tag == "form" and 2 * element.chars >= page:
                    element.wraps = True
                element = element.parent
    known: dict[int, tuple[float, bool]] = {id(None): (0.0, False)}

    def inherited(element):
        if id(element) not in known:
            total, inside = inherited(element.parent) if element.parent is not None else (0.0, False)
            total += element.cost if not (element.wraps and element.cost < 0) else 0.0
            marked = element.named if inside else element.marked
            total += marked if not (element.wraps and marked < 0) else 0.0
            known[id(element)] = (total, inside or element.tag in ("article", "main"))
        return known[id(element)]

    several = len(found) > 1 or any(" " in text for text, _, _ in found)  # a page of one bare word has no main text
    out = []
    for text, element, linked in found:
        chain, up = [], element
        while up is not None and id(up) not in known:
            chain.append(up)
            up = up.parent
        for up in reversed(chain):  # from the top, so that deep pages need no deep recursion
            inherited(up)
        total, inside = known[id(element)]
        total += LINK_COST * linked
        if text.count(" ") + 1 >= LONG_WORDS:
            total += LONG_GAIN
        elif not inside:  # shortness alone says nothing of a block, on pages that name no body
            total += SHORT_COST if bodies or linked > LINKED or total < LINK_COST * linked else SHORT_GAIN if several else 0.0
        if bodies and not inside:
            total += OUTSIDE_COST
        out.append(total)
    return out


def minimum_cut(score: list[float], edges: dict[int, dict[int, float]]) -> list[bool]:
    """Labels (True: content) of least cost: sum of |score| given up plus the capacities cut.

    A block whose score outweighs its edges keeps its side in every minimum cut, so it
    joins its terminal first and hands its edges to its neighbours' scores; the rest is
    settled by max-flow along shortest augmenting paths.  A block that no cut decides is boilerplate.
    """
    score, label = list(score), [None] * len(score)
    edges = {i: dict(e) for i, e in edges.items()}
    ready = list(range(len(score)))
    while ready:
        i = ready.pop()
        if label[i] is not None or abs(score[i]) <= sum(edges[i].values()) and edges[i] or not edges[i] and score[i] == 0:
            continue
        label[i] = score[i] > 0
        for j, c in edges[i].items():
            score[j] += c if label[i] else -c
            del edges[j][i]
            ready.append(j)
    rest = [i for i, x in enumerate(label) if x is None]
    if not rest:
        return label
    source, sink = -1, -2
    flow: dict[int, dict[int, float]] = {source: {}, sink: {}}
    for i in rest:
        flow.setdefault(i, {}).update(edges[i])
        a, b = (source, i) if score[i] > 0 else (i, sink)
        flow.setdefault(a, {})[b] = abs(score[i])
        flow.setdefault(b, {}).setdefault(a, 0.0)
    while True:
        came, queue = {source: source}, deque([source])
        while queue and sink not in came:
            i = queue.popleft()
            for j, c in flow[i].items():
                if c > 1e-12 and j not in came:
                    came[j] = i
                    queue.append(j)
        if sink not in came:
            break
        path, j = [], sink
        while j != source:
            path.append((came[j], j))
            j = came[j]
        least = min(flow[i][j] for i, j in path)
        for i, j in path:
            flow[i][j] -= least
            flow[j][i] = flow[j].get(i, 0.0) + least
    for i in rest:
        label[i] = i in came  # what the source still reaches
    return label


def main_text(html: str | None) -> str:
    """The page's content blocks, joined by newlines; empty for a null or empty page."""
    found = blocks(html or "")
    edges: dict[int, dict[int, float]] = {i: {} for i in range(len(found))}

    def join(i, j, c):
        edges[i][j] = edges[j][i] = edges[i].get(j, 0.0) + c

    last: dict[int, int] = {}
    for i, (_, element, _) in enumerate(found):
        if i:
            join(i - 1, i, ADJACENT)
        above = id(element.parent if element.tag in ("p", "li", "td", "h1", "h2", "h3", "h4", "h5", "h6") else element)
        if above in last:
            join(last[above], i, SIBLING)
        last[above] = i
    label = minimum_cut(scores(found), edges)
    return "\n".join(text for (text, _, _), keep in zip(found, label, strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of (page_id, url, html).

    Null and empty pages, and pages without content, give an empty text.  Ids and urls
    pass through as they are, null or repeated; other columns are ignored.  Whole pages are
    read, whatever their length; each row is worked on by itself, so there is no shuffle.
    """

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(html) for html in b.column("html").to_pylist()]
        return batch(page_id=b.column("page_id"), url=b.column("url"), text=texts, n_chars=[len(t) for t in texts])

    rows = pages.select("page_id", "url", "html")
    kinds = dict(rows.dtypes)
    return arrow_map(rows, run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
