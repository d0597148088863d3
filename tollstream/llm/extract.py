"""Main text of HTML pages by tag-path ratios.

A page becomes text nodes with the path of block tags from the root; inline
tags belong to the block around them. Per path the text length and the
punctuation of its nodes are added up and divided by the number of nodes. The
two ratios are smoothed over the nodes in page order (a Gaussian window that
weighs a neighbour by how much of the path it shares) and fused into one
value with what else is known: whether the path lies in an article, and how
much of the text of the node's block is links (a line of a link list is all
link, a paragraph is not; headings may be links). What has a value over a
share of the values' standard deviation is content. A block with a class, id
or role that is often beside the content ("legal", "social") must also have a
ratio near that of the rest. So in an article short
lines stay and link lists and such blocks go, unless they hold text as long
and punctuated as the rest.

Parts that never are content (scripts, navigation, asides, blocks whose class
or id names an advert, a menu, comments and the like) take no part. Wrappers
around the content may have such words too ("has-sidebar"), or be a form:
such a block takes part if the page's article is in it, no article text is
outside such blocks and less other text than the article has; if it holds
most of the text and next to none is outside them; or if there is no text
outside such blocks at all.

One page at a time, linear in its length: no shuffle, no state.

Defined cases: a null or empty page has the text ''; a page without any tag
is one text node; unclosed tags, comments and scripts end with the page;
repeated rows get equal texts; other columns are ignored by the query and
kept by ``with_main_text``.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ship, table

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q ruby
rt rp s samp small span strike strong sub sup time tt u var wbr""".split())
RAW = frozenset("script style textarea title noscript template iframe svg math".split())
NEVER = frozenset("""head script style noscript template iframe svg math nav header footer aside form button select
option textarea input label object canvas audio video menu dialog""".split())
CLOSES_P = frozenset("""address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3
h4 h5 h6 header hr main menu nav ol p pre section table ul""".split())
SAME_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
         "th": ("tr", "table"), "option": ("select",)}
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in class, id or role that name parts beside the content.
BESIDE = re.compile(r"(?:^|[\s_-])(?:ads?|ad(?:box|slot|unit|block|sense)\w*|advert\w*|banner|sponsor\w*|promo\w*|sidebar|side|"
                    r"menu|nav\w*|breadcrumbs?|footer|header|masthead|comments?|commentary|discussion|threads?|replies|"
                    r"respond|disqus|cookies?|consent|notice|popup|modal|overlay|newsletter|subscribe|signup|login|share|"
                    r"sharing|related|recommended|copyright|toolbar|pager|pagination|complementary|contentinfo|navigation)"
                    r"(?=$|[\s_\d-])", re.I)
# Words that parts of the content have as well: the text decides.
OFTEN_BESIDE = re.compile(r"(?:^|[\s_-])(?:social|widget|legal|search|tags?)(?=$|[\s_\d-])", re.I)
WITHIN = frozenset(("article", "main"))
IN_ARTICLE = 20.0  # weight of a path
# A block with a word of OFTEN_BESIDE is content if its ratio is this share
# of that of the content without such words.
NAMED_SHARE = 0.25
# A block with over half of the text is a wrapper if the text outside such
# blocks is less than this share of its own.
OUTSIDE = 0.1

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"""
                     r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_SPACE = re.compile(r"\s+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？«»„“”]")


# How sure it is that a block is beside the content.
_SURELY, _MAYBE = 1, 2


class Paths:
    """The tag paths of a page as a tree: a path is its number."""

    def __init__(self):
        self.parent, self.depth, self.weight, self.heading = [0], [0], [1.0], [False]
        self.named = [0]  # the outermost path above, or itself, with a word of OFTEN_BESIDE; 0 if none
        self._known: dict[tuple[int, str, bool], int] = {}

    def below(self, path: int, tag: str, named: bool = False) -> int:
        """The path that goes on with the block ``tag``, or itself for an
        inline tag; ``named``: with a word of OFTEN_BESIDE."""
        if tag in INLINE:
            return path
        key = path, tag, named
        if key not in self._known:
            self._known[key] = len(self.parent)
            self.parent.append(path)
            self.depth.append(self.depth[path] + 1)
            self.weight.append(IN_ARTICLE if tag in WITHIN else self.weight[path])
            self.named.append(self.named[path] or (self._known[key] if named else 0))
            self.heading.append(tag in HEADING or self.heading[path])
        return self._known[key]

    def likeness(self, a: int, b: int) -> float:
        """Share of the longer path that both have from the root."""
        longer = max(self.depth[a], self.depth[b])
        while a != b:
            if self.depth[a] >= self.depth[b]:
                a = self.parent[a]
            else:
                b = self.parent[b]
        return (1 + self.depth[a]) / (1 + longer)


def nodes(html: str, paths: Paths) -> list[tuple[int, str, int, bool]]:
    """(path, raw text, block, in a link) of the text nodes that may be content."""
    out: list[tuple[int, str, int, bool]] = []
    stack: list[tuple[str, int]] = []  # tag, 0 or how it is beside the content: _SURELY or _MAYBE
    doubts = [0]  # the block around each _MAYBE block; 0 is the page
    doubt_of: list[int] = []  # the innermost _MAYBE block of each text
    in_article: list[bool] = []
    open_tags: dict[str, int] = {}  # how often each is on the stack
    trail = [0]  # the path at each depth of the stack
    at = block = 0
    beside = doubt = 0

    def leave(n: int) -> None:
        nonlocal beside, doubt
        for t, b in stack[n:]:
            beside -= b == _SURELY
            doubt = doubts[doubt] if b == _MAYBE else doubt
            open_tags[t] -= 1
        del stack[n:]
        del trail[n + 1:]

    def text(part: str) -> None:
        if part and not beside:
            out.append((trail[-1], part, block, bool(open_tags.get("a"))))
            doubt_of.append(doubt)
            in_article.append(any(open_tags.get(t) for t in WITHIN))

    size, last = len(html), html.rfind(">")
    while at < size:
        m = _MARKUP.search(html, at) if at <= last or html.find("<!", at) >= 0 else None
        if m is None:
            text(html[at:])
            break
        text(html[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:].removesuffix("]]>"))
            continue
        tag, closing, attributes = tag.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag not in INLINE:
            block += 1
        if closing:
            if open_tags.get(tag):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        leave(k)
                        break
                    if tag in INLINE and stack[k][0] not in INLINE:
                        break  # an inline end tag doesn't close blocks
            continue
        if tag in CLOSES_P and open_tags.get("p"):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    leave(k)
                    break
                if stack[k][0] not in INLINE:
                    break
        if tag in SAME_ENDS and any(open_tags.get(t) for t in SAME_ENDS[tag]):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in SAME_ENDS[tag]:
                    leave(k)
                    break
                if stack[k][0] in SCOPE[tag]:
                    break
        if tag in VOID or attributes.rstrip().endswith("/") and tag not in RAW and tag not in CLOSES_P:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = end.end() if end else size
            continue
        aside = _SURELY if tag in NEVER and tag != "form" else 0
        named = False
        if not aside and attributes and tag not in ("html", "body") and tag not in WITHIN:
            words = " ".join(a or b or c for _, a, b, c in _NAMED.findall(attributes))
            if _HIDDEN.search(attributes):
                aside = _SURELY
            elif BESIDE.search(words):
                aside = _MAYBE
            else:
                named = bool(OFTEN_BESIDE.search(words))
        if tag == "form" and not aside:
            aside = _MAYBE
        stack.append((tag, aside))
        open_tags[tag] = open_tags.get(tag, 0) + 1
        trail.append(paths.below(trail[-1], tag, named))
        beside += aside == _SURELY
        if aside == _MAYBE:
            doubts.append(doubt)
            doubt = len(doubts) - 1
    if len(doubts) == 1:
        return out
    wrappers = _wrappers(doubts, doubt_of, [len(t) - t.count(" ") if not t.isspace() else 0 for _, t, _, _ in out], in_article)
    return [x for x, d in zip(out, doubt_of) if d in wrappers]


def _wrappers(around: list[int], block_of: list[int], lengths: list[int], in_article: list[bool]) -> set[int]:
    """The blocks that are no parts beside the content but hold it: from the
    page (block 0) inwards, one in the other."""
    inside: list[list[int]] = [[] for _ in around]
    own = [[0, 0] for _ in around]  # text, and text in an article
    for d, n, a in zip(block_of, lengths, in_article):
        own[d][0] += n
        own[d][1] += n * a
    held = [list(x) for x in own]
    for d in range(len(around) - 1, 0, -1):  # a block comes after the one around it
        inside[around[d]].append(d)
        for k in (0, 1):
            held[around[d]][k] += held[d][k]
    found = {0}
    outside, article = own[0]
    at = last = 0
    while inside[at]:
        at = max(inside[at], key=lambda d: (held[d][1] if not article else 0, held[d][0]))
        has_article = not article and held[at][1] > outside
        if not has_article and (2 * held[at][0] <= held[0][0] or outside >= OUTSIDE * held[at][0]):
            break
        found.add(at)
        outside, article, last = outside + own[at][0], article + own[at][1], at
    return found if outside else found | set(inside[last])  # no text outside such blocks: they hold it


def link_share(tree: Paths, paths: np.ndarray, blocks: np.ndarray, lengths: np.ndarray, linked: np.ndarray) -> np.ndarray:
    """For every node the share of its block's text that is links; 0 in
    headings. ``linked``: the length again where the node is a link, else 0."""
    _, of = np.unique(blocks, return_inverse=True)
    share = (np.bincount(of, weights=linked) / np.bincount(of, weights=lengths))[of]
    return np.where([tree.heading[p] for p in paths.tolist()], 0.0, share)


def named_like_the_rest(named: np.ndarray, lengths: np.ndarray, marks: np.ndarray, content: np.ndarray) -> np.ndarray:
    """The content without the blocks of ``named`` (0: none) whose text is
    much shorter and less punctuated than the rest."""
    ratio = lambda at: lengths[at].mean() * (1 + marks[at].mean())
    rest = content & (named == 0)
    if not rest.any():
        return content
    least = NAMED_SHARE * ratio(rest)
    out = rest.copy()
    for name in np.unique(named[named > 0]):
        at = content & (named == name)
        if at.any() and ratio(at) >= least:
            out |= at
    return out


def path_values(tree: Paths, paths: np.ndarray, lengths: np.ndarray, marks: np.ndarray, sigma: float = 1.0,
                reach: int = 3) -> tuple[np.ndarray, float]:
    """For every node the fused, smoothed ratio of its path; and the standard
    deviation of the ratios before they are fused with the path's weight."""
    names, of = np.unique(paths, return_inverse=True)
    count = np.bincount(of)
    ratios = np.stack([np.bincount(of, weights=lengths) / count, np.bincount(of, weights=marks) / count])[:, of]
    total, weight = ratios.copy(), np.ones(len(of))
    for d in range(1, min(reach, len(of) - 1) + 1):
        like = _likeness(tree, paths[:-d], paths[d:]) * np.exp(-d * d / (2 * sigma * sigma))
        total[:, :-d] += like * ratios[:, d:]
        total[:, d:] += like * ratios[:, :-d]
        weight[:-d] += like
        weight[d:] += like
    smooth = total / weight
    fused = smooth[0] * (1 + smooth[1])
    by_path = np.array([tree.weight[p] for p in names.tolist()]) * np.bincount(of, weights=fused) / count
    return by_path[of], float(np.std(fused))


def _likeness(tree: Paths, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    pairs, of = np.unique(np.stack([a, b], axis=1), axis=0, return_inverse=True)
    return np.array([tree.likeness(x, y) for x, y in pairs.tolist()])[of.ravel()]


def main_text(html: str | None, threshold: float = 0.2) -> str:
    """Blocks of the content, one space between them."""
    if not html:
        return ""
    tree = Paths()
    found = nodes(html, tree)
    plain = [unescape(t) for _, t, _, _ in found]
    real = [k for k, t in enumerate(plain) if t and not t.isspace()]
    if not real:
        return ""
    lengths = np.array([len(_SPACE.sub(" ", plain[k]).strip()) for k in real], dtype=float)
    marks = np.array([len(_PUNCTUATION.findall(plain[k])) for k in real], dtype=float)
    paths = np.array([found[k][0] for k in real])
    blocks, links = (np.array([found[k][i] for k in real]) for i in (2, 3))
    value, spread = path_values(tree, paths, lengths, marks)
    value = value * (1 - link_share(tree, paths, blocks, lengths, lengths * links)) ** 2
    content = np.zeros(len(plain), bool)
    content[real] = named_like_the_rest(np.array([tree.named[p] for p in paths.tolist()]), lengths, marks,
                                        (value > 0) & (value >= threshold * spread))
    parts: list[str] = []
    last = None
    for (_, _, block, _), t, kept in zip(found, plain, content.tolist()):
        if kept or t.isspace():
            if block != last:
                parts.append(" ")
                last = block
            parts.append(t)
    return _SPACE.sub(" ", "".join(parts)).strip()


def with_main_text(pages: DataFrame, html: str = "html", column: str = "text") -> DataFrame:
    """The pages, all columns, and the main text of ``html``; a column of the
    name ``column`` is replaced."""
    ship(pages.sparkSession)

    @F.pandas_udf("string")
    def of(raw: pd.Series) -> pd.Series:
        return pd.Series([main_text(x) for x in raw], dtype=object)

    return pages.withColumn(column, of(F.col(html).cast("string")))


def n_chars(text: Column) -> Column:
    return F.char_length(text).cast("long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: every page with its main text."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return with_main_text(pages).select("page_id", "url", "text", n_chars(F.col("text")).alias("n_chars"))
