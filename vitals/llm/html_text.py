"""Main text of web pages by the consensus of their host.

A page's containers are scored: text counts for its container, link text against it.
The page votes for the generalised path of its best container, tags and classes from
the root with digits replaced. Votes are counted per host and path in Spark; a path
wins if at least a tenth of the host's pages vote for it, so a host has ten at most.
Each page is then extracted again: its text is what lies in the containers of one
winning path, in page order: the path it voted for if that won, else of the winning paths
that it has the one with the best score on the page. A page that has none, or whose
winning containers are empty, gives the text of its own best container. Headings and
paragraphs that stand beside the chosen container, not in it, are kept with it.

Menus, headers, footers, side bars, notices, adverts, forms, comments, scripts and
styles are left out wherever they stand, by tag, role, or class. Inside the main
container a header's headings stay. A form, or a class or id that only sounds like one of
these, stays if the page's text lies in it: if all else has at most a quarter of its score,
or, for what may well be longer than an article (comments, notices), no sentence.

The parser is tolerant: end tags may be missing, quotes open, the page cut off. Time and memory
are in proportion to the page, however deep its containers are or how many tags stay open.

Defined results: a null or empty html, or a page without text, gives an empty text;
pages with no or a broken url do not vote and give their own best container; repeated rows vote and are
returned as often as they come; ties go to the path that sorts first; an empty table
gives an empty result. A host may hold most of the pages: votes are combined before the
shuffle, and the winners (ten rows a host at most) are joined to the pages by a broadcast
if their table is small enough for Spark's limit, else by a join whose large
partitions adaptive execution splits.
"""

import re
from collections import Counter
from html import unescape

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm.common import table, text_map, written

WINNING_SHARE = 0.1

# HTML's void, raw-text and inline elements, and what ends a paragraph or item
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "label", "mark", "q", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
    "var", "wbr",
}
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
TEXT_LEVEL = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "blockquote", "pre", "tr", "td", "th", "table", "tbody", "thead", "figure", "figcaption", "center"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# What is left out: tags, roles, and words of classes and ids
SKIPPED_TAGS = {"head", "nav", "footer", "aside", "button", "select", "svg", "canvas", "template", "dialog", "menu", "object", "audio", "video", "map", *RAW}
SKIPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "alertdialog", "dialog", "menu", "menubar", "toolbar"}
SKIPPED_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "alert", "aside", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "consent", "cookie", "cookies", "copyright", "disclaimer", "discussion", "disqus", "footer", "gdpr",
    "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "overlay", "pager",
    "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "reply", "respond", "search", "share",
    "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "topbar",
    "warning", "widget", "widgets",
}
# Of these, what may be much longer than the article beside it
LONG_WORDS = {
    "comment", "comments", "consent", "cookie", "cookies", "copyright", "disclaimer", "discussion", "disqus", "gdpr", "modal",
    "newsletter", "notice", "notices", "overlay", "popup", "replies", "reply", "respond", "signup", "subscribe", "subscription",
}
HOLDS_MOST = 4  # times the score of all text that is surely kept
HEADER_WORDS = {"header", "head", "hero"}
NOT_ABOUT = {"has", "with", "no", "without", "is"}

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.DOTALL,
)
_SENTENCE = re.compile(r".{24,}[.!?…。！？][\"'”’»)\]]*$", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): unescape(v.strip("\"'")) for k, v in reversed(_ATTRIBUTE.findall(text))} if text and not text.isspace() else {}


def _generalised(tag: str, attributes: dict[str, str]) -> str:
    classes = sorted({re.sub(r"\d+", "#", c.lower()) for c in attributes.get("class", "").split()})
    return ".".join([tag, *(c.replace(">", "") for c in classes)])


def _kind(tag: str, attributes: dict[str, str]) -> str:
    """``skip``, ``header`` or an empty text."""
    if tag in SKIPPED_TAGS:
        return "skip"
    if tag in ("html", "body"):
        return ""
    if attributes:
        if attributes.get("role", "").lower() in SKIPPED_ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true":
            return "skip"
        if re.search(r"display\s*:\s*none", attributes.get("style", "")):
            return "skip"
        for _, words in _names(attributes):
            if words[-1] in HEADER_WORDS:
                return "header"
    return "header" if tag == "header" else ""


def _names(attributes: dict[str, str]) -> list[tuple[str, list[str]]]:
    """The classes and the id with their words, without those that only tell what an element has."""
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    split = [(name, [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", name)]) for name in names]
    return [(name, words) for name, words in split if words and words[0] not in NOT_ABOUT]


def _doubts(tag: str, attributes: dict[str, str], number: str, nested: bool) -> frozenset[tuple[str, bool]]:
    """Why an element may be boilerplate: names that sound so, and whether such a part may be long.

    The last word of an article's names may be its topic, unless it is ``nested`` in another.
    """
    if tag in ("html", "body"):
        return frozenset()
    found = {(f"form {number}", False)} if tag == "form" or attributes.get("role", "").lower() == "form" else set()
    topic = tag == "main" or tag == "article" and not nested
    for name, words in _names(attributes):
        said = {words[0]} if topic else {words[0], words[-1]}
        if said & SKIPPED_WORDS:
            # names that begin with the same word are one kind, whatever number or code follows
            found.add((words[0] if words[0] in SKIPPED_WORDS else re.sub(r"\d+", "#", name.lower()), bool(said & LONG_WORDS)))
    return frozenset(found)


def _worth(text: str, linked: int) -> int:
    return len(text) - 2 * min(linked, len(text)) + 20 * sum(text.count(c) for c in ".,;!?")


class Page:
    """The blocks of a page: (text, link characters, number of its container, place).

    The place is ``header`` (its headings), ``heading`` or ``text``.
    ``elements`` has for each container its tag, the number of its path and the number of its parent.
    A path's number stands for its last name and the path before, so deep pages take linear memory.
    """

    def __init__(self, html: str):
        self.elements: list[tuple[str, int, int]] = []
        self._paths: dict[tuple[int, str], int] = {}  # the path before and a name: number
        self.blocks: list[tuple[str, int, int, str]] = []  # text, link characters, container, place
        self._doubted: list[frozenset[tuple[str, bool]]] = []  # of each block, why it may be boilerplate
        self._parse(html)
        if any(self._doubted):
            self._decide()

    def _parse(self, html: str) -> None:
        stack: list[tuple] = []  # tag, container number, kind, doubts of it and all around it
        parts: list[str] = []
        opened: Counter[str] = Counter()  # tags on the stack
        hidden, hiding, level = "", 0, 0  # an inline element that is left out, how often it is open, the stack around it
        links = linked = at = skipping = headers = headed = 0

        def flush() -> None:
            nonlocal linked
            if parts:
                text = " ".join("".join(parts).split())
                parts.clear()
                if text:
                    place = "header" if headers else "heading" if headed else "text"
                    self.blocks.append((text, linked, stack[-1][1] if stack else -1, place))
                    self._doubted.append(stack[-1][3] if stack else frozenset())
            linked = 0

        def pop() -> None:
            nonlocal skipping, headers, headed, hidden
            tag, _, kind, _ = stack.pop()
            opened[tag] -= 1
            if len(stack) < level:
                hidden = ""
            skipping -= kind == "skip"
            headers -= kind == "header"
            headed -= tag in HEADINGS

        def say(text: str) -> None:
            nonlocal linked
            if text and not skipping and not hidden and (not headers or headed):
                text = unescape(text)
                parts.append(text)
                if links:
                    linked += len(text)

        end = len(html)
        while at < end:
            found = _TOKEN.search(html, at)
            if not found:
                say(html[at:])
                break
            say(html[at : found.start()])
            at = found.end()
            tag = found[2] or found[5]
            if not tag:
                if found[0].startswith("<![CDATA["):
                    say(found[0][9:].removesuffix("]]>").replace("&", "&amp;"))
                continue
            tag, closing, text = tag.lower(), found[1] or found[4], (found[3] or found[6] or "")
            if tag in INLINE:
                if hidden and tag == hidden:
                    hiding += -1 if closing else 0 if text.endswith("/") else 1
                    if not hiding:
                        hidden = ""
                    continue
                if tag == "a":
                    links = 0 if closing else 1
                elif closing or not text:
                    continue
                if closing or tag in VOID or tag == "a" or hidden or text.endswith("/"):
                    continue
                attributes = _attributes(text)
                if _kind(tag, attributes) == "skip" or _doubts(tag, attributes, "", False):
                    # an inline element to leave out ends with its own end tag, or with the element around it
                    hidden, hiding, level = tag, 1, len(stack)
                continue
            flush()
            if tag in VOID:
                continue
            if closing:
                if opened[tag]:
                    while stack[-1][0] != tag:
                        pop()
                    pop()
                    links = 0
                continue
            if stack and stack[-1][0] == "p" or tag in HEADINGS and stack and stack[-1][0] in HEADINGS:
                pop()
            if tag == "body":
                while stack and stack[-1][0] != "html":
                    pop()
            if tag in CLOSES:
                same, limit = CLOSES[tag]
                for depth in range(len(stack) - 1, -1, -1) if any(opened[t] for t in same) else ():
                    if stack[depth][0] in limit:
                        break
                    if stack[depth][0] in same:
                        while len(stack) > depth:
                            pop()
                        break
            attributes = _attributes(text)
            if tag in RAW:
                close = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(html, at)
                at = close.end() if close else end
                continue
            kind = _kind(tag, attributes)
            above = stack[-1][1] if stack else -1
            if tag not in TEXT_LEVEL:
                before = self.elements[above][1] if above >= 0 else -1
                path = self._paths.setdefault((before, _generalised(tag, attributes)), len(self._paths))
                self.elements.append((tag, path, above))
                above = len(self.elements) - 1
            doubts = stack[-1][3] if stack else frozenset()
            if attributes or tag == "form":
                doubts |= _doubts(tag, attributes, f"{self.elements[above][1] if above >= 0 else -1}/{at}", opened["article"] > 0)
            stack.append((tag, above, kind, doubts))
            opened[tag] += 1
            skipping += kind == "skip"
            headers += kind == "header"
            headed += tag in HEADINGS
        flush()

    def _decide(self) -> None:
        """Leave out the doubtful blocks, but not the names in which the page's text lies.

        Forms of one path that hold sentences are kept or left out alike.
        """
        told_in = {
            name
            for (text, linked, *_), doubts in zip(self.blocks, self._doubted)
            for name, _ in doubts
            if name.startswith("form ") and 2 * linked < len(text) and _SENTENCE.match(text)
        }
        if told_in:
            alike = lambda name: name.split("/")[0] if name in told_in else name
            self._doubted = [frozenset((alike(name), long) for name, long in doubts) for doubts in self._doubted]
        held: dict[frozenset[tuple[str, bool]], int] = {}
        prose = set()
        for (text, linked, *_), doubts in zip(self.blocks, self._doubted):
            held[doubts] = held.get(doubts, 0) + max(_worth(text, linked), 1)
            if 2 * linked < len(text) and _SENTENCE.match(text):
                prose.add(doubts)
        trusted: frozenset[tuple[str, bool]] = frozenset()
        while True:
            kept = sum(worth for doubts, worth in held.items() if doubts <= trusted)
            told = any(doubts <= trusted for doubts in prose)
            left = sorted((d for d in held if not d <= trusted), key=lambda d: (len(d), sorted(d)))
            gain = {d: sum(worth for other, worth in held.items() if other <= trusted | d) - kept for d in left}
            most = [d for d in left if gain[d] >= HOLDS_MOST * kept and not (told and any(long for _, long in d - trusted))]
            if not most:
                break
            chosen = min(most, key=lambda d: (len(d), -gain[d]))
            # first the parts around it, so that what they hold themselves is weighed against the rest
            trusted |= next(d for d in left if d <= chosen | trusted)
        self.blocks = [block for block, d in zip(self.blocks, self._doubted) if d <= trusted]

    def _totals(self) -> tuple[dict[int, float], dict[int, float]]:
        """The scores of containers by the text directly in them, and with what lies deeper."""
        score: dict[int, float] = {}
        for text, linked, container, _ in self.blocks:
            score[container] = score.get(container, 0.0) + _worth(text, linked)
        total: dict[int, float] = dict.fromkeys(range(-1, len(self.elements)), 0.0)
        for number in range(len(self.elements) - 1, -1, -1):  # children come after their parents
            total[number] += score.get(number, 0.0)
            total[self.elements[number][2]] += max(total[number], 0.0)
        total[-1] += score.get(-1, 0.0)
        return score, total

    def path(self, number: int) -> str:
        """The path of a container, spelled out."""
        names, at = [], self.elements[number][1]
        entries = list(self._paths)  # in the order of their numbers
        while at >= 0:
            at, name = entries[at]
            names.append(name)
        return ">".join(reversed(names))

    def with_path(self, path: str) -> set[int]:
        """The containers that have a path."""
        at: int | None = -1
        for name in path.split(">"):
            at = self._paths.get((at, name))
            if at is None:
                return set()
        return {n for n, element in enumerate(self.elements) if element[1] == at}

    def best(self) -> int:
        """The number of the container with the best score; -1 for the whole page."""
        score, total = self._totals()
        if not score:
            return -1
        best = up = max(score, key=lambda n: (score[n], -n))
        article: list[bool] = []  # of each container, whether it is or lies in an article
        for tag, _, above in self.elements:
            article.append(tag in ("article", "main") or above >= 0 and article[above])
        # the container's own article, or the outermost container that has more text of this kind
        # than what is inside; those that only wrap are looked past
        while up >= 0 and self.elements[up][0] not in ("article", "main", "body"):
            up = self.elements[up][2]
            if up >= 0 and article[up] or total[up] >= 1.1 * total[best]:
                best = up
        return best

    def within(self, roots: set[int]) -> list[tuple[str, int, int, str]]:
        """The blocks inside the containers ``roots`` (all blocks if -1 is one)."""
        inside = self._inside(roots)
        return [block for block in self.blocks if inside[block[2]]]

    def _inside(self, roots: set[int]) -> dict[int, bool]:
        inside = {-1: -1 in roots}
        for number, (_, _, above) in enumerate(self.elements):
            inside[number] = number in roots or inside[above]
        return inside

    def text(self, roots: set[int]) -> str:
        """The text inside the containers ``roots``, with the headings and paragraphs beside them."""
        inside = self._inside(roots)
        if inside[-1] or not any(inside.values()):
            return " ".join([block[0] for block in self.blocks if inside[block[2]]])
        _, total = self._totals()
        beside = {up for up in (self._around(root, total) for root in roots) if up is not None}
        most = sum(total[n] for n in roots)
        side: dict[int, int] = {}  # of what lies deeper beside the roots, the outermost container
        for number, (_, _, above) in enumerate(self.elements):
            if not inside[number] and (above in beside or above in side):
                side[number] = number if above in beside else side[above]
        kept = []
        for text, linked, container, place in self.blocks:
            if inside[container] or container in beside and _worth(text, linked) > 0:
                kept.append(text)
            elif container in side and 0 < total[side[container]] < most and _worth(text, linked) > 0:
                above = self.elements[side[container]][2]
                site = above < 0 or self.elements[above][0] in ("body", "html")
                if _SENTENCE.match(text) or place == "heading" or place == "header" and not site:
                    kept.append(text)
        return " ".join(kept)

    def _around(self, root: int, total: dict[int, float]) -> int | None:
        """The nearest container around ``root`` with other text; none around articles and bodies."""
        up = root
        while up >= 0 and self.elements[up][0] not in ("article", "main", "body"):
            up = self.elements[up][2]
            if total[up] > total[root]:
                return up
        return None


def vote(html: str | None) -> str | None:
    """The path of a page's best container; None if it has no container with text."""
    page = Page(html or "")
    best = page.best()
    return page.path(best) if best >= 0 and page.blocks else None


def extract(html: str, winners: list[str]) -> str:
    page = Page(html)
    best = page.best()
    own = page.path(best) if best >= 0 else None
    chosen, most = {best}, None
    for path in filter(None, [own] if own in winners else winners):
        roots = page.with_path(path)
        blocks = page.within(roots)
        score = sum(_worth(text, linked) for text, linked, *_ in blocks)
        if blocks and (most is None or score > most):
            chosen, most = roots, score
    return page.text(chosen)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(host, F.lit("")))


def winning_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html", share: float = WINNING_SHARE) -> DataFrame:
    """``host`` and ``paths``, the winners by votes, of each host that has any."""
    udf = text_map(pages.sparkSession, "path string", lambda: lambda html: (vote(html),))
    voted = pages.select(host_of(F.col(url_col)).alias("host"), udf(F.col(html_col))["path"].alias("path"))
    voted = voted.filter(F.col("host") != "")
    counts = written(voted.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes")), "votes")
    totals = counts.groupBy("host").agg(F.sum("votes").alias("pages"))
    won = counts.filter(F.col("path").isNotNull()).join(totals, "host").filter(F.col("votes") >= share * F.col("pages"))
    ranked = won.groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("order"), "path"))).alias("ranked"))
    return ranked.select("host", F.col("ranked.path").alias("paths"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", share: float = WINNING_SHARE) -> DataFrame:
    """``page_id``, ``url`` and ``text`` of every page."""
    winners = written(winning_paths(pages, url_col, html_col, share), "winners")
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html")
    ).withColumn("host", host_of(F.col("url")))
    udf = text_map(pages.sparkSession, "text string", lambda: lambda given: (extract(given[0], list(given[1:])),))
    given = F.concat(F.array("html"), F.coalesce("paths", F.array().cast("array<string>")))
    return rows.join(winners, "host", "left").select("page_id", "url", udf(given)["text"].alias("text"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
