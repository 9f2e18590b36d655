"""A forgiving HTML reader: nodes, generalised paths, container scores and block text of one page.

Small helpers for `html_consensus`, which votes on the containers per host.
"""

import html
import re

import xxhash

#: Fixed values of the HTML standard: element kinds that matter for blocks and nesting.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body html td th tr tbody thead tfoot li dd dt".split())
SCOPE = frozenset("table td th caption button object template html".split())
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
#: Elements and names of parts that are not the article.
DROPPED = frozenset(
    "head nav footer aside form button select option input label svg canvas object audio video template dialog menu search map math".split()
) | RAW
DROPPED_NAMES = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar aside footer masthead topbar toolbar ad ads advert adverts "
    "advertisement advertisements adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations comment "
    "comments respond disqus replies reply pagination pager widget skip search".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*)[^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|(?<![^\s/])(hidden)(?![^\s/>])")
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_DIGITS = re.compile(r"\d+")
#: Labels that a path spells out; those further out are one hash.
DEEPEST_PATH = 64


class Node:
    __slots__ = ("tag", "label", "parent", "start", "end", "dropped", "linked", "depth", "block")

    def __init__(self, tag, label, parent, start, dropped, linked):
        self.tag, self.label, self.parent, self.start, self.end = tag, label, parent, start, None
        self.dropped, self.linked, self.depth = dropped, linked, parent.depth + 1 if parent else 0
        self.block = self if tag in BLOCK or parent is None else parent.block


def _label(tag, raw, parent):
    """(tag.class without digits, whether the element is not part of an article)."""
    dropped = tag in DROPPED
    if tag == "header":
        dropped = not (parent and inside(parent, "article"))
    if not raw or "=" not in raw and "hidden" not in raw:
        return tag, dropped
    found = {}
    for name, a, b, c, alone in _ATTRIBUTE.findall(raw):
        found.setdefault((name or alone).lower(), a or b or c)
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    for name in names:
        words = _WORDS.findall(_CAMEL.sub("-", name).lower())
        if words and words[0] not in ("has", "with", "no", "without") and not DROPPED_NAMES.isdisjoint(words):
            dropped = dropped or tag not in ("html", "body", "article", "main") or "comment" in words
    style = found.get("style", "").replace(" ", "").lower()
    if found.get("role", "").lower() in DROPPED_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style:
        dropped = dropped or tag not in ("html", "body")
    classes = sorted({_DIGITS.sub("", c).lower() for c in found.get("class", "").split()} - {""})
    return ".".join([tag, *classes]), dropped


def inside(node, tag):
    while node is not None:
        if node.tag == tag:
            return True
        node = node.parent
    return False


class Page:
    """Events (text, or a white space for a block's edge or line break) and nodes with their event ranges."""

    def __init__(self, source):
        self.events, self.owners, self.nodes = [], [], []
        root = Node("#root", "", None, 0, False, False)
        self.nodes.append(root)
        self.stack, self.open, self.chains = [root], {}, {root: ""}
        at, tags = 0, _TAG
        while True:
            found = tags.search(source, at)
            text = source[at : found.start()] if found else source[at:]
            if text:
                self._text(html.unescape(text) if "&" in text else text)
            if not found:
                break
            at = found.end()
            if found[2]:
                tag = found[2].lower()
                self._start(tag, found[3])
                if tag in RAW:
                    end = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)", re.I).search(source, at)
                    at = end.start() if end else len(source)
            elif found[1]:
                self._end(found[1].lower())
            elif found[0].startswith("<![CDATA["):
                self._text(found[0][9:].removesuffix("]]>"))
        while self.stack:
            self._pop()

    def _text(self, text):
        self.events.append(text)
        self.owners.append(self.stack[-1])

    def _pop(self):
        node = self.stack.pop()
        if node.tag in BLOCK:
            self.events.append(" ")
            self.owners.append(node)
        node.end = len(self.events)
        self.open[node.tag] = self.open.get(node.tag, 1) - 1

    def _close(self, tags, barriers):
        """End the nearest open element of `tags`, with all inside it, unless a barrier is met first."""
        if not any(self.open.get(t) for t in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in tags:
                while len(self.stack) > i:
                    self._pop()
                return
            if self.stack[i].tag in barriers:
                return

    def _start(self, tag, raw):
        if tag in CLOSES_P:
            self._close({"p"}, SCOPE)
        if tag in ENDED_BY:
            self._close(*ENDED_BY[tag])
        above = self.stack[-1]
        label, dropped = _label(tag, raw, above)
        node = Node(tag, label, above, len(self.events), dropped or above.dropped, above.linked or tag == "a")
        if tag in BLOCK or tag == "br":
            self.events.append(" ")
            self.owners.append(node)
        self.nodes.append(node)
        if tag in VOID or (raw or "").endswith("/") and tag not in BLOCK:
            node.end = len(self.events)
            return
        self.stack.append(node)
        self.open[tag] = self.open.get(tag, 0) + 1

    def _end(self, tag):
        if self.open.get(tag):
            self._close({tag}, frozenset() if tag in BLOCK else BLOCK - {"p"})

    def path(self, node):
        """Generalised path: tag.class of the node and what it is in, from the outside in; one hash for the outer part of a deep chain."""
        labels = []
        while node.parent is not None and len(labels) < DEEPEST_PATH:
            labels.append(node.label)
            node = node.parent
        if node.parent is not None:
            labels.append(self._chain(node))
        return ">".join(reversed(labels))

    def _chain(self, node):
        """Hash of the labels of the node and of all that it is in, kept for every node on the way."""
        way = []
        while node not in self.chains:
            way.append(node)
            node = node.parent
        chain = self.chains[node]
        for node in reversed(way):
            chain = self.chains[node] = "#" + xxhash.xxh3_128_hexdigest(f"{chain}>{node.label}".encode("utf-8", "surrogatepass"))
        return chain

    def scores(self):
        """Score of every container: long, comma-rich, link-poor blocks count for their parent, and half for its parent."""
        size, links, commas = {}, {}, {}
        for text, node in zip(self.events, self.owners):
            if node.dropped or text == " ":
                continue
            block, n = node.block, len(text.strip())
            size[block] = size.get(block, 0) + n
            commas[block] = commas.get(block, 0) + text.count(",")
            if node.linked:
                links[block] = links.get(block, 0) + n
        found = {}
        for block, n in size.items():
            if n < 25:
                continue
            points = (1 + min(commas[block], 10) + min(n / 100, 5)) * (1 - links.get(block, 0) / n)
            holder = block
            if block.tag in ("p", "li", "td", "th", "dd", "dt", "blockquote", "pre", "h1", "h2", "h3", "h4", "h5", "h6", "figcaption"):
                holder = block.parent
            for weight in (1, 0.5):
                if holder is None or holder.parent is None:
                    break
                bonus = 1.25 if holder.tag in ("article", "main") else 1
                found[holder] = found.get(holder, 0) + points * weight * bonus
                holder = holder.parent
        return found

    def text(self, nodes):
        """Text of the nodes in page order without dropped parts, white space squeezed to single spaces."""
        parts, at = [], 0
        for node in sorted(nodes, key=lambda n: n.start):
            if node.start < at:
                continue  # inside the one before
            parts.append(" ")
            for i in range(node.start, node.end):
                if not self.owners[i].dropped or self.events[i] == " ":
                    parts.append(self.events[i])
            at = node.end
        return " ".join("".join(parts).split())


def votes(source):
    """(path, share in millionths) of the containers of a page, the best first."""
    page = Page(source)
    scored = sorted(page.scores().items(), key=lambda x: (-x[1], x[0].start))
    total = sum(s for _, s in scored)
    return [(page.path(n), round(1_000_000 * s / total)) for n, s in scored] if total > 0 else []


def main_text(source, path):
    """Text of the nodes at the winning path, else of the page's own best container, else of its body."""
    page = Page(source)
    chosen = [n for n in page.nodes if not n.dropped and n.parent is not None and page.path(n) == path] if path else []
    found = page.text(chosen)
    if not found:
        scored = page.scores()
        if scored:
            found = page.text([min(scored, key=lambda n: (-scored[n], n.start))])
    if not found:
        found = page.text([page.nodes[0]])
    return found
