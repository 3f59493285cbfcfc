"""Main-text extraction by consensus host paths.

Pass 1 parses every page, scores its containers and lets them vote, by their generalised tag-class
path (kept as a 64-bit hash), within their host.  Votes are added up in Spark.  Pass 2 parses again and takes, of the page's
containers, the one whose path has most votes on its host (the page's own best where no path is
known).  Menus, headers, footers, sidebars, notices, adverts, forms, scripts and comments are left
out of the chosen container by tag, role and class.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import Stored, ship

#: Host paths, or pages that their host outvotes, that may be broadcast: about 50 bytes each.
BROADCAST_PATHS = 200_000
#: Steps of a path's label; the path itself is hashed whole.
STEPS = 8

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body html caption td th tr tbody thead tfoot option optgroup summary".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "tbody", "thead"}, "body": {"head"}}
FENCE = frozenset("table ul ol dl select html body td th div article section main".split())
CONTAINER = frozenset("article body center div main section td".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())

# What is not main text.
DROP_TAG = frozenset("nav footer aside form script style noscript template button select textarea title head iframe object embed canvas audio video dialog menu input annotation annotation-xml search".split())
DROP_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form status".split())
DROP_CLASS = re.compile(r"(?:^|[\s_-])(?:ads?|adbox|adslot|adverts?|advertis\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|notifications?|sidebar\w*|side|menu\w*|nav\w*|breadcrumbs?|footer\w*|header\w*|masthead|topbar|comments?\w*|commentlist|disqus\w*|respond|repl(?:y|ies)|discussion|share\w*|sharing|social\w*|related\w*|recommend\w*|popup|modal|overlay|newsletter\w*|subscri\w*|signup|sign-up|login|widget\w*|toolbar|pagination|pager|skip\w*|alert\w*|disclaimer|taboola|outbrain)(?:[\s_-]|$)", re.I)
GOOD_CLASS = re.compile(r"(?:^|[\s_-])(?:article\w*|content|post\w*|entry\w*|story\w*|main\w*|text|body)(?:[\s_-]|$)", re.I)

#: Class names that speak of something beside the element, and of an article's own head.
BESIDE = re.compile(r"(?:with|without|has|no)[-_]", re.I)
TITLE_CLASS = re.compile(r"(?:^|\s)(?:article|post|entry|page|story)[-_]?(?:header|head)(?:\s|$)", re.I)

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_DIGITS = re.compile(r"[0-9]+")


class Node:
    """An element. What depends on its ancestors is settled when it opens, so depth costs nothing."""

    __slots__ = ("tag", "name", "drop", "good", "up", "parts", "score", "link", "head", "depth", "fence", "key", "main", "heading")

    def __init__(self, tag: str, up: Node | None, attrs: str = ""):
        self.tag, self.up, self.parts, self.score = tag, up, [], 0.0
        self.name, self.good = tag, False
        self.drop = (up is not None and up.drop) or tag in DROP_TAG
        self.link = tag == "a" or (up is not None and up.link)
        self.head = tag == "header" or (up is not None and up.head)
        self.depth = 0 if up is None else up.depth + 1
        self.fence = self if up is None or tag in FENCE else up.fence
        self.main = up is not None and (up.main or up.tag in ("article", "main"))
        self.heading = up is not None and (up.heading or up.tag in HEADING)
        if attrs and not attrs.isspace():
            a = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attrs)}
            marks = f"{a.get('class', '')} {a.get('id', '')}"
            if "class" in a:
                self.name = ".".join([tag, *sorted({_DIGITS.sub("#", c) for c in a["class"].split()})])
            if not self.drop and tag not in ("html", "body", "article", "main"):
                own = " ".join(t for t in marks.split() if not BESIDE.match(t))
                if TITLE_CLASS.search(own):
                    self.head = True
                else:
                    self.drop = bool(DROP_CLASS.search(own))
            self.drop = self.drop or a.get("role", "").lower() in DROP_ROLE or a.get("aria-hidden") == "true" or "display:none" in a.get("style", "").replace(" ", "") or bool(re.search(r"(?:^|\s)hidden(?:\s|$)", attrs))
            self.good = bool(GOOD_CLASS.search(marks)) or a.get("role") == "main"
        if tag == "header" and not self.drop:
            self.drop = not self.main
        self.key = 0 if up is None else xxhash.xxh64_intdigest(self.name.encode("utf-8", "surrogatepass"), up.key)

    @property
    def path(self) -> int:
        """Signed 64-bit hash of the generalised tag-class path."""
        return self.key - (self.key >> 63 << 64)

    def label(self) -> str:
        """The last steps of the path, to be read by people."""
        steps, x = [], self
        while x.up is not None and len(steps) < STEPS:
            steps.append(x.name)
            x = x.up
        return "/".join(reversed(steps))


def parse(page: str) -> Node:
    """The page as a tree, whatever is unclosed, misnested or left open in it. One forward scan."""
    root = Node("", None)
    here, at, n = root, 0, len(page)
    opened: defaultdict[str, list[Node]] = defaultdict(list)  # by tag, outermost first

    def leave(last: Node) -> Node:
        """Close all down from `last`."""
        x = here
        while x is not last.up:
            opened[x.tag].pop()
            x = x.up
        return x

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            here.parts.append(page[at:])
            break
        if lt > at:
            here.parts.append(page[at:lt])
        c = page[lt + 1 : lt + 2]
        if c == "!" or c == "?":
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            elif page.startswith("<![CDATA[", lt):
                end = page.find("]]>", lt)
                here.parts.append(entities.escape(page[lt + 9 : n if end < 0 else end]))
                at = n if end < 0 else end + 3
            else:
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            continue
        m = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if m is None:
            if c.isalpha() or c == "/":
                end = page.find(">", lt)
                if end < 0 and c.isalpha():
                    break  # a tag that the page's end cuts off
            here.parts.append("&lt;")
            at = lt + 1
            continue
        at, tag = m.end(), m[2].lower()
        if m[1]:
            if opened[tag]:
                here = leave(opened[tag][-1])
            elif tag == "p":
                here.parts.append(Node("p", here))  # as browsers do: it ends a block
            continue
        if tag in CLOSES_P and opened["p"] and opened["p"][-1].depth > here.fence.depth:
            here = leave(opened["p"][-1])
        if tag in CLOSES:
            scope = here.fence
            while scope.tag in CLOSES[tag]:
                scope = scope.up.fence
            inside = [v[k] for t in CLOSES[tag] if (v := opened[t]) and (k := bisect_right(v, scope.depth, key=lambda x: x.depth)) < len(v)]
            if inside:
                here = leave(min(inside, key=lambda x: x.depth))
        node = Node(tag, here, m[3])
        here.parts.append(node)
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
            if end is None:
                break
            close = page.find(">", end.end())
            at = n if close < 0 else close + 1
        elif tag not in VOID and not m[3].endswith("/"):
            opened[tag].append(node)
            here = node
    return root


def blocks(top: Node) -> Iterator[tuple[str, Node, float]]:
    """(text, block element, share of it in links) of what is kept below `top`, in page order."""
    buf: list[str] = []
    linked, owner = 0, top
    stack: list = [(top, False)]

    def take():
        nonlocal linked
        text = " ".join(entities.unescape("".join(buf)).split())
        share = min(1.0, linked / max(1, len(text)))
        buf.clear()
        linked = 0
        return text, owner, share

    while stack:
        x, leave = stack.pop()
        if isinstance(x, tuple):
            text, node = x
            if not node.head or node.tag in HEADING or node.heading:
                buf.append(text)
                linked += len(text) if node.link else 0
            continue
        if leave:
            if x.tag in BLOCK:
                if buf and (got := take())[0]:
                    yield got
                owner = x.up or x
            continue
        if x.drop and x is not top:
            if x.tag in BLOCK:
                if buf and (got := take())[0]:
                    yield got
            else:
                buf.append(" ")
            continue
        if x.tag == "br":
            buf.append(" ")
            continue
        if x.tag in BLOCK:
            if buf and (got := take())[0]:
                yield got
            owner = x
        stack.append((x, True))
        stack.extend(((p, x), False) if isinstance(p, str) else (p, False) for p in reversed(x.parts))
    if buf and (got := take())[0]:
        yield got


def containers(root: Node) -> list[Node]:
    """Scored containers, best first, ties in page order: a block counts for its ancestors, less with each container above it."""
    order, stack = [], [root]
    while stack:
        x = stack.pop()
        order.append(x)
        stack.extend(p for p in reversed(x.parts) if not isinstance(p, str) and not p.drop)
    for text, node, share in blocks(root):
        if node.up is not None:
            node.score += len(text) * (1 - share)
    found = []
    for x in reversed(order):  # every element after those inside it
        held = x.tag in CONTAINER or x.up is None
        if x.up is not None and x.score:
            x.up.score += x.score * (0.6 if held else 1.0)
        if held and x.score > 0:
            x.score *= 1.6 if x.tag in ("article", "main") else 1.2 if x.good else 0.6 if x.tag in ("body", "") else 1.0
            found.append(x)
    return sorted(reversed(found), key=lambda x: -x.score)


def host_of(url: str | None) -> str | None:
    try:
        return urlsplit((url or "").strip()).hostname or None
    except ValueError:
        return None


def text_of(page: str | None, votes: dict[int, float]) -> str:
    """The page's main text, given its host's votes by path."""
    root = parse(page or "")
    boxes = containers(root)
    known = [(votes[x.path], x) for x in boxes if x.path in votes]
    top = max(known, key=lambda k: k[0])[1] if known else boxes[0] if boxes else root
    return "\n".join(t for t, _, _ in blocks(top))


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for key, url, page in zip(b["key"], b["url"], b["html"], strict=True):
            host = host_of(url)
            boxes = containers(parse(page or "")) if host else []
            first: dict[int, tuple] = {}
            for i, x in enumerate(boxes):
                first.setdefault(x.path, (key, host, x.path, x.label(), x.score / boxes[0].score, i))
            rows += first.values()
        yield pd.DataFrame(rows, columns=["key", "host", "path", "label", "share", "at"])


def candidates(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(key, host, path, label, share, at): the best container of each path of every page that has a host; key is a hash of url and page."""
    ship(pages.sparkSession)
    src = pages.select(F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return src.withColumn("key", F.xxhash64("url", "html")).mapInPandas(_candidates, "key long, host string, path long, label string, share double, at int")


def host_votes(boxes: DataFrame) -> DataFrame:
    """(host, path, label, votes) of all paths of each host.

    Votes are the mean share over the pages that have the path, with one page of share 0 added: a path
    of few templates isn't outvoted by what all pages share, nor a path of many by that of one page.
    """
    return boxes.groupBy("host", "path").agg(F.round(F.sum("share") / (F.count("share") + 1), 6).alias("votes"), F.min("label").alias("label"))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, rank, votes, path, key): the generalised paths of each host by rank, winners first, `path` being
    the last steps and `key` the hash of the whole path. A row each, so no host is one value."""
    votes = host_votes(candidates(pages, url_col, html_col))
    return votes.select("host", F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path")).alias("rank"), "votes", F.col("label").alias("path"), F.col("path").alias("key"))


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_PATHS else df


def outvoted(boxes: DataFrame) -> DataFrame:
    """(key, path) of the pages whose host's votes choose another container than the page's own best."""
    votes = Stored(host_votes(boxes), "votes").read()
    best = boxes.drop("label").join(_few(votes.drop("label")), ["host", "path"]).groupBy("key").agg(F.max(F.struct("votes", (-F.col("at")).alias("at"), "path")).alias("best"))
    return best.where("best.at < 0").select(F.col("key").alias("_key"), "best.path")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every row.

    A null or empty page, and one without main text, has the empty text; a page whose url is null or
    has no host stands for itself; repeated rows vote as often as they occur and come back as often.
    """
    ship(pages.sparkSession)
    other = Stored(outvoted(Stored(candidates(pages, url_col, html_col), "boxes").read()), "outvoted").read()
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    joined = src.join(_few(other), F.xxhash64("url", "html") == F.col("_key"), "left").select("page_id", "url", "html", F.col("path").cast("string"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [text_of(h, {} if p is None else {int(p): 1.0}) for h, p in zip(b["html"], b["path"], strict=True)]
            yield b[["page_id", "url"]].assign(text=texts)

    kind = src.schema["page_id"].dataType.simpleString()
    return joined.mapInPandas(run, f"page_id {kind}, url string, text string")
