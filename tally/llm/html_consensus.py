"""Main text of web pages by the paths that a host's pages agree on.

Each page's containers are scored by the text that stands right in them, links
counting against it. A container in an article or main element votes for that
whole, so that headline, lead and all parts stay together. Spark adds up, per
host, the votes for each generalised tag-class path; the winning path is then used to read every page
of the host again. A page without that path falls back to its own best one.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from hashlib import blake2b
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.shared import free_name, ship_package, written

VOTES = 1000            # of a page for its best container; the others get less by score
LEAST_SHARE = 0.2       # containers scoring below this share of the page's best get no vote
#: Hosts up to which the winning paths (some 100 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_HOSTS = 100_000

#: Fixed values of HTML.
CONTAINERS = {"body", "main", "article", "section", "div", "center"}
BLOCKS = CONTAINERS | {
    "address", "aside", "blockquote", "br", "caption", "dd", "details", "dl", "dt", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "nav", "ol", "option", "p", "pre",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
SKIPPED = {"head", "script", "style", "title", "noscript", "template", "textarea", "iframe", "svg", "math", "select", "object"}
#: What isn't part of an article, by tag and by the leading word of a class or id.
BOILERPLATE = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog"}
#: What a class or id never makes boilerplate ("no-sidebar", "comments-open"): it tells of the page or its state. An
#: article is, only by a class that is such a word ("related").
PAGE_PARTS = {"body", "main"}
BOILERPLATE_WORD = re.compile(
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|sidebar|menu|nav|navbar|navigation|"
    r"breadcrumbs?|footer|header|masthead|share|sharing|social|related|recommended|recommendations|comments?|replies|"
    r"newsletter|subscribe|signup|login|search|pagination|pager|toolbar|widget|popup|modal)\Z", re.IGNORECASE)
#: Within an article a name of several words is boilerplate only if it goes on with one of these ("share-buttons", not "header-image").
BOILERPLATE_PART = re.compile(
    r"(?:area|articles?|bar|blocks?|box|buttons?|container|content|form|icons?|inner|items?|labels?|links?|lists?|menu|nav|panel|placeholder|posts?|"
    r"section|slots?|stories|top|bottom|units?|widgets?|wrap|wrapper|[0-9]+)\Z", re.IGNORECASE)
PATH_STEPS = 40   # of a deeper path, the steps above are one digest

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)", re.DOTALL)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)


@dataclass(slots=True)
class _Container:
    step: str
    parent: int
    first: int = 0      # its blocks are first .. last - 1
    last: int = -1
    score: float = 0.0
    kind: str = ""      # "article" or "main", by tag or role
    depth: int = 0
    digest: bytes = b""  # of the whole path


@dataclass
class Page:
    """Blocks of text in page order and the containers that they stand in."""

    blocks: list[str] = field(default_factory=list)
    containers: list[_Container] = field(default_factory=list)

    def path(self, i: int) -> str:
        """The tag-class path of a container; of one deeper than ``PATH_STEPS``, a digest stands for the upper part."""
        steps = []
        while i >= 0 and len(steps) < PATH_STEPS:
            steps.append(self.containers[i].step)
            i = self.containers[i].parent
        if i >= 0:
            steps.append(f"#{self.containers[i].digest.hex()}")
        return ">".join(reversed(steps))

    def wholes(self) -> list[int]:
        """Of each container, the one that holds the whole it belongs to.

        That is its outermost article, else its outermost main element, else
        itself; and the main element around that, if at least half of its
        text stands in it.
        """
        upto = [0, *accumulate(map(len, self.blocks))]
        size = [upto[c.last] - upto[c.first] for c in self.containers]
        article, main, out = [], [], []
        for i, c in enumerate(self.containers):  # parents come first
            article.append(article[c.parent] if c.parent >= 0 and article[c.parent] >= 0 else i if c.kind == "article" else -1)
            main.append(main[c.parent] if c.parent >= 0 and main[c.parent] >= 0 else i if c.kind == "main" else -1)
            whole = article[i] if article[i] >= 0 else main[i] if main[i] >= 0 else i
            around = main[whole]
            out.append(around if around >= 0 and 2 * size[whole] >= size[around] else whole)
        return out

    def votes(self) -> dict[str, int]:
        """Votes by path of a whole: those of its best container."""
        best = max((c.score for c in self.containers), default=0)
        best_of: dict[int, float] = {}
        for c, whole in zip(self.containers, self.wholes()):
            if c.score > 0 and c.score >= LEAST_SHARE * best:
                best_of[whole] = max(best_of.get(whole, 0), c.score)
        out: dict[str, int] = {}
        for whole, score in best_of.items():
            at = self.path(whole)
            out[at] = max(out.get(at, 0), round(VOTES * score / best))
        return out

    def text(self, path: str | None) -> str:
        """The blocks of the containers at ``path``, each with the whole it belongs to; without any, of the page's best container."""
        step = (path or "").rpartition(">")[2]
        chosen = [i for i, c in enumerate(self.containers) if c.step == step and c.last > c.first and self.path(i) == path]
        if not chosen:
            chosen = [max(range(len(self.containers)), key=lambda i: self.containers[i].score)]
        wholes = self.wholes()
        out, done = [], 0
        for i in sorted({wholes[i] for i in chosen}):  # in page order; one may stand in another
            c = self.containers[i]
            out += self.blocks[max(c.first, done):c.last]
            done = max(done, c.last)
        return " ".join(out)


def _marks(word: str, tag: str, in_article: bool) -> bool:
    """Whether a class or id marks boilerplate: by its leading word; in an article, and of one, only by a name that says nothing else."""
    first, *rest = re.split(r"[-_]+", word.lstrip("-_"))
    if not BOILERPLATE_WORD.match(first):
        return False
    if tag == "article":
        return not rest
    return not in_article or all(BOILERPLATE_WORD.match(x) or BOILERPLATE_PART.match(x) for x in rest)


def _step(tag: str, attributes: str, by_class: bool, in_article: bool) -> tuple[str, bool, str]:
    """The element's generalised step in a path (digits as #), whether it is boilerplate, and "article" or "main" if it is one.

    A header within an article or main element holds its headline.
    """
    kind = tag if tag in ("article", "main") else ""
    by_class = by_class and tag not in PAGE_PARTS
    classes, boiler = "", tag in BOILERPLATE and not (tag == "header" and in_article)
    if attributes:
        for name, *values in _NAMES.findall(attributes):
            words = "".join(values).split()
            if name.lower() == "role" and words and words[0].lower() in ("article", "main"):
                kind = words[0].lower()
            if name.lower() == "class" and not classes:
                classes = "".join(f".{re.sub('[0-9]+', '#', w)}" for w in sorted(set(words)))
            boiler |= by_class and any(_marks(w, tag, in_article) for w in words)
        boiler |= bool(_HIDDEN.search(attributes if by_class and tag != "article" else _NAMES.sub(" ", attributes)))
    return tag + classes + (f"[{kind}]" if kind and kind != tag else ""), boiler, kind


def _digest(above: bytes, step: str) -> bytes:
    return blake2b(above + b">" + step.encode("utf-8", "surrogatepass"), digest_size=12).digest()


def parse_page(html: str) -> Page:
    """Read a page leniently: unclosed and stray tags, comments and scripts never stop it.

    A page that has no text but what a class or id marks as boilerplate is read without that rule.
    """
    page = _parsed(html, by_class=True)
    return page if page.blocks else _parsed(html, by_class=False)


def _parsed(html: str, by_class: bool) -> Page:
    page = Page(containers=[_Container("body", -1, digest=b"body")])
    tags = Counter()      # open elements by tag, so that a stray end tag costs nothing
    articles = [False]    # of each open element: in an article or main element
    # Open containers and boilerplate: (tag, container, boilerplate or inside it).
    open_: list[tuple[str, int, bool]] = [("body", 0, False)]
    run: list[str] = []
    linked = 0
    in_link = False

    def end_block() -> None:
        nonlocal linked
        text = " ".join("".join(run).split())
        run.clear()
        if text and not open_[-1][2]:
            at = open_[-1][1]
            page.blocks.append(text)
            gain = max(0, len(text) - 2 * linked)
            page.containers[at].score += gain
            if page.containers[at].parent >= 0:
                page.containers[page.containers[at].parent].score += gain / 2
        linked = 0

    def close(down_to: int) -> None:
        while len(open_) > down_to:
            tag, at, _ = open_.pop()
            tags[tag] -= 1
            articles.pop()
            if at != open_[-1][1]:
                page.containers[at].last = len(page.blocks)

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = unescape(raw) if "&" in raw else raw
            run.append(text)
            if in_link:
                linked += len(text)

    at, n = 0, len(html)
    while at < n:
        token = _TOKEN.search(html, at)
        if token is None:
            add(html[at:])
            break
        add(html[at:token.start()])
        at = token.end()
        tag = (token[2] or token[5] or "").lower()
        if not tag:
            continue
        closing, attributes = token[1] or token[4], token[3] or token[6] or ""
        if tag in BLOCKS or tag in BOILERPLATE:
            end_block()
            if open_[-1][0] == "p":
                close(len(open_) - 1)
        if tag == "a":
            in_link = not closing
        if closing:
            level = next((i for i in range(len(open_) - 1, 0, -1) if open_[i][0] == tag), 0) if tags[tag] > 0 else 0
            if level:
                end_block()
                close(level)
        elif tag in SKIPPED:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>|\Z" if tag != "head" else r"</head\b[^>]*>|(?=<body\b)|\Z", re.IGNORECASE).search(html, at)
                at = max(end.end(), at)
        elif tag not in VOID and tag not in ("html",):
            step, boiler, kind = _step(tag, attributes, by_class, articles[-1])
            _, inside, hidden = open_[-1]
            if boiler or hidden and tag in CONTAINERS:
                end_block()
                open_.append((tag, inside, True))
                tags[tag] += 1
                articles.append(articles[-1])
            elif tag == "body":
                page.containers[0].step, page.containers[0].digest = step, _digest(b"", step)
            elif tag in CONTAINERS:
                above = page.containers[inside]
                page.containers.append(_Container(step, inside, len(page.blocks), kind=kind, depth=above.depth + 1, digest=_digest(above.digest, step)))
                open_.append((tag, len(page.containers) - 1, False))
                tags[tag] += 1
                articles.append(articles[-1] or bool(kind))
    end_block()
    close(1)
    page.containers[0].last = len(page.blocks)
    return page


def host_of(url: Column) -> Column:
    """The host of a URL in lower case; empty if null or without one."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def winning_paths(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``(host, path)``: of each host, the path with the most votes of all its pages; ties to the path last by name."""
    ship_package(pages.sparkSession)

    @F.arrow_udf("array<struct<path string, votes long>>")
    def ballots(column: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("path", pa.string()), ("votes", pa.int64())]))
        return pa.array([[{"path": p, "votes": v} for p, v in parse_page(x.as_py() or "").votes().items()] for x in column], kind)

    cast = pages.select(host_of(F.col(url)).alias("host"), F.explode(ballots(F.col(html))).alias("v"))
    totals = cast.groupBy("host", F.col("v.path").alias("path")).agg(F.sum("v.votes").alias("votes"))
    return totals.groupBy("host").agg(F.max(F.struct("votes", "path"))["path"].alias("path"))


def extract_main_text(pages: DataFrame, html: str = "html", url: str = "url", out: str = "text") -> DataFrame:
    """``pages`` with ``out``, the main text of the whole page by its host's winning path.

    White space inside a block becomes one blank, blocks are joined by one.
    Null and empty pages, and pages without text, give the empty text; a null
    URL belongs to the host without a name. An existing ``out`` is replaced.
    """
    winners = written(winning_paths(pages, html, url), "paths")
    own, of = free_name(pages, "host"), free_name(pages, "of_host")
    path = free_name(pages, "main_path")
    winners = winners.select(F.col("host").alias(of), F.col("path").alias(path))
    if winners.count() <= BROADCAST_HOSTS:
        winners = F.broadcast(winners)

    @F.arrow_udf("string")
    def extracted(column: pa.Array, paths: pa.Array) -> pa.Array:
        return pa.array([parse_page(x.as_py() or "").text(p.as_py()) for x, p in zip(column, paths)], pa.string())

    joined = pages.withColumn(own, host_of(F.col(url))).join(winners, F.col(own) == F.col(of), "left")
    return joined.withColumn(out, extracted(F.col(html), F.col(path))).drop(own, of, path)
