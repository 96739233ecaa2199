"""Main text of web pages: flat blocks, classified by a decision tree.

A page becomes a flat list of text blocks. Each block is described by its number of words
and its link density, those of the blocks before and after it, and the place it stands in.
A decision tree, trained by Spark on the small labelled table of ``labelled_pages``, says
which blocks belong to the article.

A place that its tag or name calls a menu, an advert and the like is one feature among
others, beside the share of the page's article-like words that stand in it: a layout called
``with-sidebar`` that holds the whole article is told from the sidebar by that share. On pages
that name nothing, word counts and link densities decide.

Defined results: NULL or empty html, and a page without article blocks, give the empty text
and 0 characters. Every input row gives one row, repeated rows too. Markup that is never
closed ends with the page; an unfinished tag at the end of a cut page is dropped. Pages of
any length are read whole, in time that grows with their length. Columns other than page_id,
url and html are left aside, whatever their names.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdgrid.llm.labelled_pages import labelled

# Tag names of HTML.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label "
    "legend li main menu nav ol optgroup option p pre section select summary table tbody td "
    "tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HIDDEN_TAGS = (
    "script", "style", "template", "noscript", "svg", "math", "iframe", "object", "canvas",
    "textarea", "title",
)
ARTICLE_TAGS = frozenset(["article", "main"])
OUTER_TAGS = frozenset(["nav", "footer", "aside", "menu", "dialog"])
CONTROL_TAGS = frozenset(["button", "select", "label", "head"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
# Words in a class, id or role that name a place outside, or inside, the article.
OUTER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs "
    "comment comments commentlist complementary contentinfo cookie cookies consent copyright "
    "dialog disclaimer disqus footer gdpr header hidden login masthead menu menubar modal nav "
    "navbar navigation newsletter notice notices notification pager pagination popup privacy "
    "promo promoted recommended related replies reply respond search share sharing sidebar "
    "signup skip social sponsor sponsored subscribe subscription tags toolbar widget widgets "
    "alert toc".split()
)
INNER_WORDS = frozenset("article content entry story main".split())
# Before such a word a name tells what a place has or lacks, not what it is.
HAVING_WORDS = frozenset("with has have without no non".split())
# What calls a place outer: part of a name, a whole name or a form, a tag, a thing never read.
PART, NAME, TAG, UNSEEN = 1, 2, 3, 4
# A block of this many words with less than this share of them in links reads like an article.
LONG_WORDS = 10
LONG_DENSITY = 0.34

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(HIDDEN_TAGS) + r")(?=[\s/>])[^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE) for t in HIDDEN_TAGS}
_PLACE = re.compile(
    r"(?:^|\s)(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE
)
_UNSEEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.IGNORECASE)
_WORDS = re.compile(r"[a-z0-9]+")
_SAID = re.compile(r"\S*\w\S*")
_NOTICE = re.compile(r"©|\(c\)\s*\d{4}|\bcopyright\b|\brights reserved\b", re.IGNORECASE)

FEATURES = (
    "words", "link_density", "words_before", "link_density_before", "words_after",
    "link_density_after", "outer_kind", "outer_lacks", "article_place", "page_has_article",
    "heading", "notice", "long_before", "long_after",
)
Tree = tuple


@dataclass
class Outer:
    """A place called outer, and the number of the outer place around it."""

    kind: int
    around: int | None


@dataclass
class Open:
    """An open tag: what it makes of the text in it."""

    tag: str
    outer: int | None = None  # number of the innermost outer place
    article: int = 0  # 2: in an article by its tag, 1: by a name


@dataclass
class Block:
    """A run of text between two block tags."""

    outer: int | None
    article: int
    heading: bool
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)

    def text(self) -> str:
        return " ".join(entities.unescape("".join(self.parts)).split())

    def link_density(self, text: str) -> float:
        """The share of the words in links; signs between links are no words."""
        if not self.linked:
            return 0.0
        linked = len(_SAID.findall(entities.unescape(" ".join(self.linked))))
        return min(1.0, linked / (len(_SAID.findall(text)) or 1))


class _Open:
    """The open tags, innermost last, and where each name and the block tags stand among them,
    so that a tag is found or closed without a search."""

    def __init__(self) -> None:
        self.tags: list[Open] = []
        self.places: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []

    def push(self, entry: Open) -> None:
        self.places[entry.tag].append(len(self.tags))
        if entry.tag in BLOCK_TAGS:
            self.blocks.append(len(self.tags))
        self.tags.append(entry)

    def close_from(self, place: int) -> None:
        while len(self.tags) > place:
            self.places[self.tags.pop().tag].pop()
        while self.blocks and self.blocks[-1] >= place:
            self.blocks.pop()

    def close(self, tag: str) -> None:
        if self.places[tag]:
            self.close_from(self.places[tag][-1])

    def close_implied(self, tag: str) -> None:
        """A block tag ends an open paragraph and what is open in it; an item ends its sibling."""
        ended = tag if tag in ("li", "dt", "dd", "option", "tr", "td", "th", "a") else "p"
        if self.places[ended] and self.places[ended][-1] >= (self.blocks or [0])[-1]:
            self.close_from(self.places[ended][-1])

    def block(self) -> str:
        return self.tags[self.blocks[-1]].tag if self.blocks else ""


def blocks_of(page: str | None) -> list[tuple[str, list[float]]]:
    """The blocks of a page in order, each with its features in the order of ``FEATURES``."""
    found: list[Block] = []
    outers: list[Outer] = []
    open_ = _Open()
    page, at, block = page or "", 0, None

    def say(piece: str) -> None:
        nonlocal block
        if block is None:
            around = open_.tags[-1] if open_.tags else Open("")
            block = Block(around.outer, around.article, open_.block() in HEADINGS)
            found.append(block)
        block.parts.append(piece)
        if open_.places["a"]:
            block.linked.append(piece)

    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        if m["raw"]:
            close = _RAW_END[m["raw"].lower()].search(page, at)
            at = close.end() if close else len(page)
            continue
        if not m["name"]:
            continue
        tag = m["name"].lower()
        if tag in BLOCK_TAGS:
            block = None
        elif tag == "br":
            if block is not None:
                block.parts.append(" ")
        if tag in VOID_TAGS:
            continue
        if m["end"]:
            open_.close(tag)
        elif not m["attrs"].endswith("/") or tag in BLOCK_TAGS:
            if tag in BLOCK_TAGS or tag == "a":
                open_.close_implied(tag)
            open_.push(_place(tag, m["attrs"], open_.tags, outers))
    return _described(found, outers)


def _called(attrs: str) -> tuple[int, bool]:
    """What the names of a place call it: the kind of outer place or 0, and whether inner."""
    kind, inner = 0, False
    for m in _PLACE.finditer(attrs):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            words = _WORDS.findall(name)
            inner = inner or not INNER_WORDS.isdisjoint(words)
            for before, word in zip([""] + words, words):
                if word in OUTER_WORDS and before not in HAVING_WORDS:
                    kind = max(kind, NAME if len(words) == 1 else PART)
    return kind, inner and not kind


def _place(tag: str, attrs: str, stack: list[Open], outers: list[Outer]) -> Open:
    around = stack[-1] if stack else Open("")
    named = attrs and tag not in ("html", "body")
    kind, inner = _called(attrs) if named else (0, False)
    article = max(around.article, 2 if tag in ARTICLE_TAGS else int(inner and tag != "a"))
    if tag in ARTICLE_TAGS or tag in HEADINGS:
        kind = 0
    elif tag in OUTER_TAGS or (tag == "header" and not article):
        kind = TAG
    elif tag == "form":
        kind = NAME
    if tag in CONTROL_TAGS or (named and _UNSEEN.search(attrs)):
        kind = UNSEEN
    if not kind:
        return Open(tag, around.outer, article)
    # A part of a menu is no less a menu for what its own name says.
    if around.outer is not None and outers[around.outer].kind >= TAG:
        kind = max(kind, outers[around.outer].kind)
    outers.append(Outer(kind, around.outer))
    return Open(tag, len(outers) - 1, article)


def _described(found: list[Block], outers: list[Outer]) -> list[tuple[str, list[float]]]:
    kept = [(b, t) for b in found if (t := b.text())]
    words = [float(len(t.split())) for _, t in kept]
    density = [b.link_density(t) for b, t in kept]
    kinds = [outers[b.outer].kind if b.outer is not None else 0 for b, _ in kept]
    long_ = [n >= LONG_WORDS and d < LONG_DENSITY for n, d in zip(words, density)]
    # The article-like blocks: those in an article by tag, else by name, else the long ones.
    level = max((b.article for (b, _), k in zip(kept, kinds) if k < TAG), default=0)
    likely = [
        k < TAG and d < LONG_DENSITY and (b.article == level if level else far)
        for (b, _), k, d, far in zip(kept, kinds, density, long_)
    ]
    held = [0.0] * len(outers)
    for (b, _), n, is_likely in zip(kept, words, likely):
        if is_likely and b.outer is not None:
            held[b.outer] += n
    for at in range(len(outers) - 1, -1, -1):  # a place comes after the one around it
        if outers[at].around is not None:
            held[outers[at].around] += held[at]
    total = sum(n for n, is_likely in zip(words, likely) if is_likely)
    first, at = set(), next((b.outer for (b, _), is_likely in zip(kept, likely) if is_likely), None)
    while at is not None:
        first.add(at)
        at = outers[at].around
    out, before, after = [], 0, sum(long_)
    for i, (b, t) in enumerate(kept):
        after -= long_[i]
        last = i + 1 == len(kept)
        around = [
            words[i], density[i],
            words[i - 1] if i else 0.0, density[i - 1] if i else 0.0,
            0.0 if last else words[i + 1], 0.0 if last else density[i + 1],
        ]
        place = [
            float(kinds[i]),
            # The share of the article-like words that its outer place does not hold; one that
            # does not hold the first of them stands apart as a whole, whatever it holds.
            float(b.outer is not None) if b.outer not in first else 1.0 - held[b.outer] / total,
            float(b.article), float(level), float(b.heading),
            float(words[i] <= 30 and bool(_NOTICE.search(t))), float(min(before, 2)), float(min(after, 2)),
        ]
        out.append((t, around + place))
        before += long_[i]
    return out


def train(spark: SparkSession, pages: list[tuple[str, tuple[str, ...]]] | None = None) -> Tree:
    """Train on labelled pages: (html, the texts of its article blocks)."""
    rows = [
        (float(text in wanted), Vectors.dense(features))
        for page, wanted in pages or labelled()
        for text, features in blocks_of(page)
    ]
    model = DecisionTreeClassifier(
        featuresCol="features", labelCol="label", maxDepth=12, maxBins=256, minInstancesPerNode=1, seed=1
    ).fit(spark.createDataFrame(rows, ["label", "features"]).coalesce(1))
    return _tree(model._java_obj.rootNode())


def _tree(node) -> Tree:
    """The learnt tree as plain tuples: (feature, threshold, left, right) or (prediction,)."""
    if node.subtreeDepth() == 0:
        return (node.prediction(),)
    split = node.split()
    left, right = _tree(node.leftChild()), _tree(node.rightChild())
    return split.featureIndex(), split.threshold(), left, right


def belongs(tree: Tree, features: list[float]) -> bool:
    while len(tree) > 1:
        feature, threshold, left, right = tree
        tree = left if features[feature] <= threshold else right
    return tree[0] > 0.5


def main_text(page: str | None, tree: Tree) -> str:
    return "\n".join(text for text, features in blocks_of(page) if belongs(tree, features))


def extract(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``."""
    learnt = tree or train(pages.sparkSession)

    @F.arrow_udf("string")
    def read(values: pa.Array) -> pa.Array:
        return pa.array([main_text(v.as_py(), learnt) for v in values], type=pa.string())

    return pages.select("page_id", "url", read(F.col("html")).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
