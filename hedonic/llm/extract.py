"""Main text of web pages by the maximum-scoring stretch of words and tags.

A page is a row of units: stretches of text and tags.  Words score positive and tags
negative, and one linear scan finds the contiguous stretch of units with the highest sum;
its text is the article.  The weights come from labelled pages: pages whose article is
marked (one ``article`` or ``main`` element) say for every tag how often it stands inside
an article and how often outside.  A tag's penalty is the log-odds of being outside, and a
container (by its name, class, id or role) whose words were nearly always outside is
clutter: its words score nothing and are left out, also in the middle of an article.
Usual names of menus, adverts, forms, notices and reader comments are clutter from the
start, for pages unlike the labelled ones; a form, or a name like ``has-sidebar``, around more
than half of a page's words is a wrapper instead.  Articles in a container of comments or
of teasers are part of it.

Weights are sums over a bounded sample of labelled pages (``SAMPLE`` expected rows, by a
hash of the id) made on the executors; one row per distinct tag or container comes to the
driver.  Extraction is one pass, a page at a time, whatever its length.

Text: character references are decoded, white space inside a block becomes one space,
blocks are joined in page order by one space.  Comments, scripts, styles and other parts
that are not shown never count.  A page without words, a missing page or one that is all
clutter has an empty text.  Repeated rows are extracted each; other columns are kept, and
an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hedonic.llm.common import query, table

#: Labelled pages expected in the sample that weights are fitted on.
SAMPLE = 4000
#: A container is clutter if words in it are outside articles by at least these log-odds.
CLUTTER = 3.0

#: Largest learned penalty of a tag that is no edge of an article.
MOST = 2.0

#: Elements whose content is never shown as text.
HIDDEN = ("script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "title", "select", "textarea", "button")
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements of running text, cheap where no label tells otherwise.
PROSE = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 br hr li blockquote pre".split())
#: Elements that can be clutter as a whole.
CONTAINERS = frozenset("nav aside footer header form div section ul ol table dialog menu figure details fieldset".split())
#: Elements that are clutter, and name parts that make a container clutter.
CLUTTER_TAGS = frozenset("nav aside footer header form dialog menu".split())
CLUTTER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar footer header masthead cookie cookies consent notice notices popup modal overlay newsletter subscribe signup "
    "login form search share sharing social related recommended comment comments disqus reply replies respond discussion pagination "
    "pager toolbar widget widgets complementary contentinfo".split()
)
ARTICLE = ("article", "main")
#: First name parts of containers whose articles are not the page's own.
FOREIGN = frozenset("comment comments disqus reply replies respond discussion related recommended".split())

START = re.compile(r"<!--|<[!?]|<(/?)([a-zA-Z][^\s/>]*)")
#: The rest of a tag.  A value may hold ``>`` between quotes; nothing is tried twice.
REST = re.compile(r"((?>=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)>")
NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PART = re.compile(r"[a-z0-9]+")


def _end_of(name: str, page: str, start: int) -> int:
    found = re.compile(rf"</{name}\b", re.I).search(page, start)
    return page.find(">", found.end()) + 1 or len(page) if found else len(page)


def tags_of(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """``start, end, name, whether an end tag, attributes`` of every tag; comments and the like have no name.

    Time is linear: a tag whose quotes never end closes at the next ``>``, and what no ``>`` follows is text.
    The caller may send the place to go on from, to pass over what a tag hides.
    """
    at, last = 0, page.rfind(">")
    while (m := START.search(page, at)) is not None:
        start, name = m.start(), (m[2] or "").lower()
        rest = ""
        if m[0] == "<!--":
            found = page.find("-->", m.end())
            end = found + 3 if found >= 0 else len(page)
        elif m.end() > last:
            at = m.end()
            continue
        elif not name:
            end = page.index(">", m.end()) + 1
        else:
            found = REST.match(page, m.end())
            end = found.end() if found else page.index(">", m.end()) + 1
            rest = page[m.end() : end - 1]
        at = (yield start, end, name, bool(m[1]), rest) or end


def containers_of(name: str, attributes: str) -> tuple[str, ...]:
    """Names under which an element can be known as clutter: itself, and its class, id and role."""
    found = [name]
    for m in NAMED.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        found += [f"{name}.{part}" for part in value.split()]
    return tuple(found)


def foreign(names: tuple[str, ...]) -> bool:
    """Is this a container of comments or of other articles' teasers?"""
    return any(label and not FOREIGN.isdisjoint(PART.findall(label)[:1]) for label in (n.partition(".")[2] for n in names))


@dataclass
class Container:
    """An element: its names, those that no element around it has, and the container around it (-1: none)."""

    tag: str
    names: tuple[str, ...]
    new: tuple[str, ...]
    around: int


@dataclass
class Units:
    """A page: for each unit its kind (tag name, ``""`` for text), text, innermost container (-1: none) and whether it lies in an article."""

    tags: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    inside: list[int] = field(default_factory=list)
    article: list[bool] = field(default_factory=list)
    containers: list[Container] = field(default_factory=list)
    articles: int = 0

    def add(self, tag: str, text: str, inside: int, article: bool) -> None:
        self.tags.append(tag)
        self.texts.append(text)
        self.inside.append(inside)
        self.article.append(article)

    def whole(self, counts: list[int]) -> list[int]:
        """Counts of containers with those of the containers inside them added."""
        counts = list(counts)
        for i in range(len(counts) - 1, -1, -1):  # a container comes after the one around it
            if self.containers[i].around >= 0:
                counts[self.containers[i].around] += counts[i]
        return counts


def units_of(page: str | None) -> Units:
    """Tags and texts of a page in order; parts never shown are gone."""
    out = Units()
    page = page or ""
    open_: list[int] = []  # containers, outermost first
    held: Counter = Counter()  # names and, as "<tag>", tags of open containers
    apart = depth = at = 0  # open containers whose articles are foreign; how deep in articles we are

    def text(upto: int) -> None:
        if upto > at:
            out.add("", page[at:upto], open_[-1] if open_ else -1, depth > 0)

    def enter(name: str, names: tuple[str, ...]) -> None:
        nonlocal apart
        new = tuple(dict.fromkeys(n for n in names if not held[n]))
        out.containers.append(Container(name, names, new, open_[-1] if open_ else -1))
        open_.append(len(out.containers) - 1)
        held.update([f"<{name}>", *new])
        apart += foreign(names)

    def leave() -> str:
        nonlocal apart
        done = out.containers[open_.pop()]
        held.subtract([f"<{done.tag}>", *done.new])
        apart -= foreign(done.names)
        return done.tag

    found = tags_of(page)
    tag = next(found, None)
    while tag is not None:
        start, end, name, closing, rest = tag
        text(start)
        at, skip = end, None
        if name in HIDDEN and not closing:
            if not rest.endswith("/"):
                at = skip = _end_of(name, page, end)
        elif name:
            if name in ARTICLE:
                names = containers_of(name, rest)
                if closing and held[f"<{name}>"]:
                    while leave() != name:
                        pass
                elif closing:
                    depth = max(0, depth - 1)
                elif apart or foreign(names):
                    enter(name, names)
                elif depth == 0:
                    # An article ends whatever clutter was left open before it.
                    while open_:
                        leave()
                    depth, out.articles = 1, out.articles + 1
                else:
                    depth += 1
            elif name in CONTAINERS:
                if not closing:
                    enter(name, containers_of(name, rest))
                elif held[f"<{name}>"]:
                    while leave() != name:
                        pass
            out.add(f"/{name}" if closing else name, "", open_[-1] if open_ else -1, depth > 0)
        try:
            tag = found.send(skip)
        except StopIteration:
            tag = None
    text(len(page))
    return out


def known_clutter(names: tuple[str, ...]) -> int:
    """2 for clutter, 1 for what may as well wrap a whole page, 0 for other containers."""
    most = 0
    for name in names:
        tag, _, label = name.partition(".")
        if not label and tag in CLUTTER_TAGS:
            most = max(most, 1 if tag == "form" else 2)
        parts = PART.findall(label)
        if not CLUTTER_NAMES.isdisjoint(parts):
            most = max(most, 2 if parts[0] in CLUTTER_NAMES else 1)
    return most


@dataclass(frozen=True)
class Weights:
    """``tags``: penalty of each tag; ``clutter``: containers learned to be clutter."""

    tags: dict[str, float] = field(default_factory=dict)
    clutter: frozenset[str] = frozenset()
    word: float = 1.0
    unseen: float = 1.0

    def clutter_of(self, units: Units, words: list[int]) -> list[bool]:
        """Whether each container of a page is clutter, or inside of some.

        A form, or a name such as ``has-sidebar``, does not make clutter of what holds most of the page.
        """
        own = [0] * len(units.containers)
        for at, n in zip(units.inside, words, strict=True):
            if at >= 0:
                own[at] += n
        sizes, total, out = units.whole(own), sum(words), []
        known: dict[tuple[str, ...], int] = {}
        for c, n in zip(units.containers, sizes, strict=True):
            if c.names not in known:
                known[c.names] = 2 if not self.clutter.isdisjoint(c.names) else known_clutter(c.names)
            sure = known[c.names]
            out.append(sure == 2 or (sure == 1 and 2 * n <= total) or (c.around >= 0 and out[c.around]))
        return out

    def penalty(self, tag: str) -> float:
        found = self.tags.get(tag)
        return found if found is not None else 0.1 if tag.lstrip("/") in PROSE else self.unseen

    def text(self, page: str | None) -> str:
        """The main text of a page."""
        units = units_of(page)
        sizes = [len(t.split()) for t in units.texts]
        clutter = [*self.clutter_of(units, sizes), False]  # the last stands for no container
        kept, best, sum_, start, span = [], 0.0, 0.0, 0, (0, 0)
        for i, (tag, words, at) in enumerate(zip(units.tags, sizes, units.inside, strict=True)):
            kept.append(not clutter[at])
            if clutter[at]:
                continue
            score = -self.penalty(tag) if tag else self.word * words
            if sum_ <= 0:
                sum_, start = 0.0, i
            sum_ += score
            if sum_ > best:
                best, span = sum_, (start, i + 1)
        out: list[str] = []
        for i in range(*span):
            tag = units.tags[i]
            if tag:
                if tag.lstrip("/") not in INLINE:
                    out.append(" ")
            elif kept[i]:
                out.append(entities.unescape(units.texts[i]))
        return " ".join("".join(out).split())


def counts_of(page: str | None) -> Counter:
    """``(kind, name, inside an article)`` -> tags (kind ``t``) or words in a container (kind ``c``) of a labelled page."""
    units, found = units_of(page), Counter()
    if units.articles != 1:
        return found
    own = {True: [0] * len(units.containers), False: [0] * len(units.containers)}
    for tag, words, at, inside in zip(units.tags, units.texts, units.inside, units.article, strict=True):
        if tag:
            # The mark itself is no evidence for what else stands in an article.
            found["t", tag, inside and tag not in ARTICLE] += 1
        elif at >= 0:
            own[inside][at] += len(words.split())
    for inside, counts in own.items():
        for c, n in zip(units.containers, units.whole(counts), strict=True):
            for name in c.new if n else ():
                found["c", name, inside] += n
    return found


def fit(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> Weights:
    """Weights from the labelled ones of a sample of ``pages``."""
    rows = pages.where(F.col(html_col).isNotNull())
    share = min(1.0, sample / max(rows.count(), 1))
    drawn = rows.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)) <= int(share * (1 << 30))).select(F.col(html_col).alias("html"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column("html").to_pylist():
                total.update(counts_of(page))
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in ((([k[0] for k in keys]), pa.string()), ([k[1] for k in keys], pa.string()),
                                         ([k[2] for k in keys], pa.bool_()), ([total[k] for k in keys], pa.int64()))],
            names=["kind", "name", "inside", "n"],
        )

    n = F.sum("n")
    counted = drawn.mapInArrow(count, "kind string, name string, inside boolean, n long").groupBy("kind", "name")
    both = counted.agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("within"), n.alias("n")).where(F.col("n") >= 20).collect()
    tags, clutter = {}, set()
    for r in both:
        odds = math.log((r.n - r.within + 0.5) / (r.within + 0.5))
        if r.kind == "t":
            # Every tag costs something: the more, the more surely it stands outside articles.
            # Lists and links are rarer in articles than in menus, but no end of one.
            edge = r.name.lstrip("/") in (*ARTICLE, "body", "html")
            tags[r.name] = 0.1 + min(max(0.0, odds), math.inf if edge else MOST)
        elif odds >= CLUTTER and ("." in r.name or r.name in CLUTTER_TAGS):
            clutter.add(r.name)
    return Weights(tags, frozenset(clutter))


def extract(pages: DataFrame, weights: Weights, *, html_col: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text in ``into``."""
    shipped = pages.sparkSession.sparkContext.broadcast(weights)

    def main_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shipped.value.text(p) for p in batch], dtype=object)

    return pages.withColumn(into, F.pandas_udf(main_text, "string")(F.col(html_col).cast("string")))


@query("op6_extract")
def op6_extract(spark, sf_dir):
    """The main text of all pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract(pages, fit(pages)).select("page_id", "url", "text")
    return found.withColumn("n_chars", F.length("text").cast("long"))
