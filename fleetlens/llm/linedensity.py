"""Main text of web pages by the line-block distribution.

Markup is stripped to lines, one per block element. A line weighs its text outside links; lines of menus,
footers, adverts, forms, comments and the like weigh nothing. Sums over sliding windows of lines make
the distribution; text begins where it surges and ends where it dives to zero. The edges of left-out
containers and of articles count as empty lines, so a window doesn't reach from the main text into what
surrounds it; what lies in one container with a surge is judged together with it.
"""

from __future__ import annotations

import bisect
import html
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import map_arrow

WINDOW = 3
# A stretch surges if some window holds this share of the window that a character of the page lies in on average.
SURGE_SHARE = 0.5
# A stretch belongs to the innermost container that holds this share of its weight.
HELD_SHARE = 0.8
# A line with a larger share of link text is navigation.
MOST_LINK_SHARE = 0.5

# Element names of HTML by what they mean here.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
DROPPED = {
    "head", "nav", "footer", "aside", "form", "menu", "dialog", "template", "svg", "select", "button",
    "object", "canvas", "audio", "video", "map", "datalist",
}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track",
    "wbr",
}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre",
    "search", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul", "caption",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SPACES = {"br", "td", "th", "option", "img", "input"}
# An element that starts closes an open one of these.
CLOSED_BY = {
    "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
# Words of class, id or role that name what is not the article.
HINTS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer",
    "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
    "notices", "pagination", "popup", "promo", "promotion", "related", "replies", "search", "share", "sharing",
    "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar", "widget",
}
# Others' text has the distribution of an article: these words decide unless a main text is named beside them.
REPLIES = {"comment", "comments", "disqus", "replies"}
# Words before a hint that make it a property of what bears it, and words that name a main text.
PROPERTIES = {"has", "with", "without", "no", "category", "cat", "tag", "tagged", "topic", "format", "type"}
CONTENT = {"article", "body", "content", "entry", "main", "post", "story", "text"}
CONTAINERS = {
    "article", "body", "center", "details", "div", "fieldset", "figure", "header", "hgroup", "html", "main", "search",
    "section",
}
# Words after a hint that make it a state of what bears it.
STATES = {"open", "opened", "closed", "enabled", "disabled", "allowed", "on", "off", "count", "none"}
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
# Quotes count after an equals sign only, as in "title=it's"; an unclosed one is an ordinary character.
_ATTRIBUTES = re.compile(r"(?:[^>=]+|=\s*(?:\"[^\"]*\"|'[^']*'|))*+>")
_COMMENTS = re.compile(r"(?:\d+ )?(?:(?:reader|readers'?|user|all|your) )?(?:comments?|replies|responses)(?: ?\(\d+\))?:?", re.I)
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b(?!-)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _hidden(attributes: str) -> bool:
    return bool(_HIDDEN.search(re.sub(r"=\s*\"[^\"]*hidden[^\"]*\"", "=", attributes)))


def _hint(attributes: str) -> str:
    """What class, id and role say: "replies", "strong", "weak" beside a name of a main text, or nothing."""
    found, content, replies = "", False, False
    for mark in " ".join("".join(m) for m in _MARKS.findall(attributes)).split():
        words = [w.lower() for w in _WORDS.findall(mark)]
        hints = [
            w for i, w in enumerate(words)
            if w in HINTS and not PROPERTIES & set(words[:i]) and not STATES & set(words[i + 1 : i + 2])
        ]
        if hints:
            found = "strong"
            replies = replies or bool(REPLIES & set(hints))
        elif CONTENT & set(words):
            content = True
    if replies:
        # Beside a name of a main text they decide only for what is not most of the page.
        return "strong" if content else "replies"
    return "weak" if found and content else found


class _Region:
    """A container that a hint names, with the text of its own lines: it is judged when the page is read."""

    def __init__(self, hint: str, parent: int) -> None:
        self.hint, self.parent, self.gone = hint, parent, False
        self.size = self.linked = self.weight = self.lines = 0


class _Lines:
    """Lines of a page: (text, weight, container, region); None stands for an edge."""

    def __init__(self) -> None:
        self.lines: list[tuple[str, int, int, int] | None] = []
        self.text: list[str] = []
        self.linked = 0
        # Open elements: name, whether its text is left out, whether it lies in an article, whether its edge
        # counts, its container and region.
        self.open: list[tuple[str, bool, bool, bool, int, int]] = []
        # Containers as [parent, first line, line after the last, whether it is the page]; the first is the page.
        self.containers: list[list] = [[-1, 0, None, True]]
        self.regions: list[_Region] = []
        self.closed: list[int] = []
        self.count: Counter[str] = Counter()
        self.links = 0

    @property
    def dropped(self) -> bool:
        return bool(self.open) and self.open[-1][1]

    @property
    def article(self) -> bool:
        return bool(self.open) and self.open[-1][2]

    @property
    def container(self) -> int:
        return self.open[-1][4] if self.open else 0

    @property
    def region(self) -> int:
        return self.open[-1][5] if self.open else -1

    def add(self, raw: str) -> None:
        if raw and not self.dropped:
            if "&" in raw:
                raw = html.unescape(raw)
            self.text.append(raw)
            if self.links:
                self.linked += len("".join(raw.split()))

    def end_line(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                if self.open and self.open[-1][0] in HEADINGS and _COMMENTS.fullmatch(text):
                    self.mark_replies()
                size = len(text.replace(" ", ""))
                weight = 0 if self.linked > MOST_LINK_SHARE * size else size
                self.lines.append((text, weight, self.container, self.region))
                if self.region >= 0:
                    own = self.regions[self.region]
                    own.size += size
                    own.linked += self.linked
                    own.weight += weight
                    own.lines += weight > 0
            self.text, self.linked = [], 0

    def mark_replies(self) -> None:
        """A section or div that begins with a heading "Comments" holds replies."""
        home = self.container
        outer, first, _, whole = self.containers[home]
        if whole or outer < 0 or any(self.lines[first:]):
            return
        at = len(self.open)
        while at and self.open[at - 1][4] == home:
            at -= 1
        if self.open[at][0] not in ("section", "div"):
            return
        before = self.open[at - 1][5] if at else -1
        if any(top[5] != before for top in self.open[at:]):
            return
        self.regions.append(_Region("replies", before))
        region = len(self.regions) - 1
        self.open[at:] = [(*top[:5], region) for top in self.open[at:]]

    def pop(self, name: str) -> None:
        """Close the innermost open element of that name, and what is open inside it."""
        if not self.count[name]:
            return
        while self.open:
            top, _, _, edge, container, region = self.open[-1]
            if edge:
                self.end_line()
            self.open.pop()
            self.count[top] -= 1
            if top == "a":
                self.links -= 1
            if edge:
                self.lines.append(None)
            if container != self.container:
                self.containers[container][2] = len(self.lines)
            if region != self.region:
                self.closed.append(region)
            if top == name:
                return

    def start(self, name: str, attributes: str, closed: bool) -> None:
        block = name in BLOCKS
        if block:
            # A paragraph ends before any block.
            while self.open and self.open[-1][0] in ("p", "b", "i", "em", "strong", "a", "span", "font", "u"):
                if not self.count["p"]:
                    break
                top = self.open[-1][0]
                self.end_line()
                self.pop(top)
            self.end_line()
        for other in CLOSED_BY.get(name, ()):
            if self.open and self.open[-1][0] == other:
                self.end_line()
                self.pop(other)
        if name in SPACES:
            self.add(" ")
        if name in VOID or closed:
            return
        inside, out, edge = self.article, self.dropped, False
        container, region = self.container, self.region
        named = name not in ("html", "body") and bool(attributes)
        hint = _hint(attributes) if named and not out else ""
        if hint and (name in ("article", "main") or not block):
            # The name of an article outweighs a hint; a weak one of a few words in a line says nothing.
            hint = "weak" if block else hint.replace("weak", "")
        if name in ("article", "main"):
            # A form around a whole page doesn't hide its article.
            if out and all(top[0] == "form" for top in self.open if top[1] and top[0] in DROPPED):
                out = False
            inside = edge = True
        if named and _hidden(attributes) or name in DROPPED or (name == "header" and not inside):
            edge, out = edge or not out, True
        elif hint:
            edge, region = True, len(self.regions)
            self.regions.append(_Region(hint, self.region))
        if edge:
            self.end_line()
            self.lines.append(None)
        if name in CONTAINERS:
            self.containers.append([container, len(self.lines), None, name in ("html", "body")])
            container = len(self.containers) - 1
        self.open.append((name, out, inside, edge, container, region))
        self.count[name] += 1
        if name == "a":
            self.links += 1

    def finish(self) -> None:
        self.end_line()
        while self.open:
            self.pop(self.open[-1][0])
        for container in self.containers:
            if container[2] is None:
                container[2] = len(self.lines)


def _markup(page: str) -> Iterator[tuple[int, int, str, str, bool]]:
    """Tags in order: (start, end, name, attributes, whether it closes); comments and declarations without a
    name, scripts and the like up to the end of their closing tag.

    The page is read once from left to right. A tag ends at the first ">" outside quoted values; from the first
    tag on whose quotes leave none, the page's tags end at the first ">" of all, or with the page.
    """
    at, quoted = page.find("<"), True
    while at >= 0:
        m = _NAME.match(page, at)
        if m:
            strict = _ATTRIBUTES.match(page, m.end()) if quoted else None
            quoted = strict is not None
            end = strict.end() - 1 if quoted else page.find(">", m.end())
            end = len(page) if end < 0 else end
            name, closes = m[1].lower(), page[at + 1] == "/"
            attributes, end = page[m.end() : end], min(end + 1, len(page))
            if name in RAW and not closes:
                # What it holds is no markup.
                close = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, end)
                end = close.end() if close else len(page)
            yield at, end, name, attributes, closes
            at = page.find("<", end)
            continue
        if page.startswith(("<!", "<?"), at):
            comment = page.startswith("<!--", at)
            end = page.find("-->", at + 4) + 2 if comment else page.find(">", at)
            end = len(page) if end < at else end + 1
            yield at, end, "", "", False
            at = page.find("<", end)
            continue
        at = page.find("<", at + 1)


def lines_of(page: str) -> _Lines:
    """The lines of a page without those of elements that hold no main text; None marks an edge."""
    out, at = _Lines(), 0
    for start, end, name, attributes, closes in _markup(page):
        out.add(page[at:start])
        at = end
        if not name or (name in RAW and not closes):
            continue
        if closes:
            if name in BLOCKS:
                out.end_line()
            elif name in SPACES:
                out.add(" ")
            out.pop(name)
        else:
            out.start(name, attributes, attributes.endswith("/"))
    out.add(page[at:])
    out.finish()
    return out


def stretches(weights: list[int], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """Surge and dive points of the distribution: (first line, line after the last, highest window sum)."""
    found, start, peak, total = [], None, 0, 0
    for i in range(len(weights) + window):
        total += weights[i] if i < len(weights) else 0
        total -= weights[i - window] if i >= window else 0
        if total and start is None:
            start, peak = i, 0
        if start is not None:
            peak = max(peak, total)
            if not total:
                found.append((start, i - window + 1, peak))
                start = None
    return found


def surge_level(weights: list[int], window: int = WINDOW) -> float:
    """The height from which a window surges: a share of the mean height over the page's characters."""
    total = first = second = 0
    for i in range(len(weights) + window):
        total += weights[i] if i < len(weights) else 0
        total -= weights[i - window] if i >= window else 0
        first += total
        second += total * total
    return SURGE_SHARE * second / first if first else 0.0


def _judge(page: _Lines) -> None:
    """Let a hint drop its container only if the container's own lines look like boilerplate too.

    Mostly links do, and so does what is too small to surge. Beside a name of a main text that is all; a
    strong hint stands unless the container holds most of the page in several lines.
    """
    shaded = []
    for own in page.regions:
        shaded.append(own.hint != "weak" or (own.parent >= 0 and shaded[own.parent]))
    weights = []
    for line in page.lines:
        weights += [0] * WINDOW if line is None else [0 if line[3] >= 0 and shaded[line[3]] else line[1]]
    level, total = surge_level(weights), sum(line[1] for line in page.lines if line)
    for i in page.closed:
        own = page.regions[i]
        small = own.weight < level if own.hint == "weak" else own.lines < WINDOW or 2 * own.weight <= total
        own.gone = own.hint == "replies" or small or own.linked > MOST_LINK_SHARE * own.size
        if not own.gone and own.parent >= 0:
            outer = page.regions[own.parent]
            outer.size += own.size
            outer.linked += own.linked
            outer.weight += own.weight
            outer.lines += own.lines
    for own in page.regions:
        own.gone = own.gone or (own.parent >= 0 and page.regions[own.parent].gone)


def main_text(page: str) -> str:
    """The main text: blocks in order, joined by an empty line.

    Stretches whose distribution reaches the page's surge level stay, and with each all from the first surge
    to the last dive in its container, links between kept lines included. Where the container is the page
    itself, only lines right in it count as its first and last.
    """
    read = lines_of(page)
    _judge(read)
    texts, weights, homes, place = [], [], [], []
    for line in read.lines:
        place.append(len(texts))
        gone = line is None or (line[3] >= 0 and read.regions[line[3]].gone)
        texts += [""] * WINDOW if line is None else [""] if gone else [line[0]]
        weights += [0] * WINDOW if line is None else [0] if gone else [line[1]]
        homes += [-1] * WINDOW if line is None else [line[2]]
    place.append(len(texts))
    level = surge_level(weights)
    before = [0, *itertools.accumulate(weights)]
    rooted: dict[int, list[int]] = {}
    for i, weight in enumerate(weights):
        if weight and read.containers[homes[i]][3]:
            rooted.setdefault(homes[i], []).append(i)
    keep: set[tuple[int, int]] = set()
    for a, b, peak in stretches(weights):
        if peak < level:
            continue
        keep.add((a, b))
        weight = before[b] - before[a]
        # A container of over half the weight holds the line at its middle.
        home = homes[bisect.bisect_left(before, before[a] + (weight + 1) // 2, a + 1, b + 1) - 1]
        while True:
            outer, low, high, whole = read.containers[home]
            low, high = place[low], place[high]
            if outer < 0 or before[min(high, b)] - before[max(low, a)] >= HELD_SHARE * weight:
                break
            home = outer
        if whole:
            own = rooted.get(home, [])
            keep.update([(own[0], own[-1] + 1)] if own else [])
        else:
            first = bisect.bisect_right(before, before[low]) - 1
            last = bisect.bisect_left(before, before[high])
            keep.add((first, last))
    out, at = [], 0
    for a, b in sorted(keep):
        out += [t for t in texts[max(a, at) : b] if t]
        at = max(at, b)
    return "\n\n".join(out)


def extract(pages: DataFrame, text: str = "html", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The given key columns plus text and n_chars, its code points.

    A null or empty page, or one without main text, gives an empty text. Every row gets one; columns
    other than the keys and the page are not read.
    """
    rows = pages.select(*keys, F.col(text).alias("_html"))

    def run(batch: pa.RecordBatch) -> dict:
        found = [main_text(v.as_py() or "") for v in batch.column(len(keys))]
        out = {name: batch.column(i) for i, name in enumerate(keys)}
        return out | {"text": found, "n_chars": [len(t) for t in found]}

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_arrow(rows, run, f"{fields}, text string, n_chars bigint")
