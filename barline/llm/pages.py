"""Main text of web pages by the maximum-scoring subsequence.

A page is read as one sequence of words and tags. A word scores by the most telling element around
it, a tag by its name; both weights come from labelled pages: those that mark their article up
themselves (one article or main element) tell which words belong. The best contiguous
region is found by one linear scan (largest running sum). It is completed by its container: the element
that holds the region, or the outermost one around it that speaks for content. There, all blocks count that some element
speaks for, so a title or a last paragraph that an advert or a menu cuts off comes back. Blocks whose elements
speak against them (menus, forms, comments, adverts inside an article) are left out.

Weights are log-odds of a word inside against outside the article for each element name and each
class or id word; an element's are added up, so that `content search-results` is no search form. Few prior counts stand in for
names that the labelled pages don't show. The article mark itself is an element like any other, so pages
without one are judged by their other elements. Open elements are linked to their parents, so a page costs time and
memory in proportion to its length, however deep it is nested.

Defined cases: a null or empty page, or one without text, has the text ''; a page that breaks off
keeps what it holds; equal pages have equal texts; without labelled pages the prior counts alone
decide. Character references are decoded, also nested in text, never in tags. An input column with the name of the
new one is replaced.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm.common import bounded_sample

SAMPLE_PAGES = 4000
MOST_FEATURES = 20_000
PRIOR = 3.0
AGAINST_FROM = -1.0
SPEAKS_FROM = 0.5

# Elements by their meaning in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = "script style noscript template svg math iframe object canvas head title textarea select button form audio video datalist dialog".split()
BLOCKS = set(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
AGAINST = "nav aside footer menu".split()
FOR = "article main p h1 h2 h3 blockquote pre".split()
# Names in classes and ids; a trailing part of a name counts, too (site-nav, cookie_banner).
NAMES_AGAINST = (
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disclaimer"
    " footer form masthead menu modal nav navbar navigation newsletter notice overlay pager pagination popup promo promoted promotion recommended"
    " related reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe tags toc toolbar topbar widget"
    " alert header disqus login gdpr outbrain taboola teaser rail"
).split()
NAMES_FOR = "article content body post entry story main text prose".split()
ROLES_AGAINST = "navigation banner complementary contentinfo search form dialog alert menu menubar".split()

# A value may hold any quote if it has none around it; a quote that is never closed is a plain character.
_ATTRIBUTES = r"(?:[^<>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s<>]*+)|[\"'])*+"
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(script|style|noscript|template|svg|math|iframe|textarea|title|select)\b[^>]*+(?:>.*?(?:</\1\s*+>|\Z)|\Z)"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)({_ATTRIBUTES})(?:>|(?=<)|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++))?", re.I)
NAME_PART = re.compile(r"[a-z]+")
SPACES = re.compile(r"\s+")


def features(name: str, attributes: str) -> tuple[str, ...]:
    """What an element says about the words in it: its name, and the words of its class, id and role."""
    out = [name]
    if attributes and "=" in attributes or "hidden" in attributes:
        for key, value in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key == "hidden" or key == "aria-hidden" and value == "true":
                out.append("!hidden")
            elif key == "role":
                out.append("@" + value)
            else:
                out += ["." + part for part in NAME_PART.findall(value)]
    return tuple(dict.fromkeys(out))


class Page:
    """A page as items (text or None, name or '', element) in order, and its elements as linked lists by number.

    An item is a block of text between block-level tags, or a tag. Element 0 is the page itself.
    """

    def __init__(self, page: str):
        self.items: list[tuple[str | None, str, int]] = []
        self.parent, self.features, self.name = [0], [()], [""]
        self.first, self.end = [0], [0]
        stack, blocks, open_at = [0], [], {}
        parts, at = [], 0

        def flush():
            text = SPACES.sub(" ", entities.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                self.items.append((text, "", stack[-1]))

        def close(size: int):
            while len(stack) > size:
                element = stack.pop()
                self.end[element] = len(self.items)
                open_at[self.name[element]].pop()
                if blocks and blocks[-1] == len(stack):
                    blocks.pop()

        for m in MARKUP.finditer(page):
            if m.start() > at:
                parts.append(page[at : m.start()])
            at = m.end()
            name = (m[3] or "").lower()
            if not name:
                continue
            block = name in BLOCKS or name in HIDDEN
            if block:
                flush()
            if m[2]:
                # A closing inline tag never closes a block around it.
                if open_at.get(name) and (block or not blocks or blocks[-1] <= open_at[name][-1]):
                    close(open_at[name][-1])
            elif name not in VOID and not m[4].endswith("/"):
                if block:
                    # A block starts: open inline elements and an open paragraph end here.
                    while len(stack) > 1 and (self.name[stack[-1]] not in BLOCKS or self.name[stack[-1]] == "p"):
                        close(len(stack) - 1)
                    if name in ("li", "dt", "dd", "tr", "td", "th", "option") and self.name[stack[-1]] == name:
                        close(len(stack) - 1)
                self.parent.append(stack[-1])
                self.features.append(features(name, m[4]))
                self.name.append(name)
                self.first.append(len(self.items))
                self.end.append(0)
                open_at.setdefault(name, []).append(len(stack))
                if name in BLOCKS:
                    blocks.append(len(stack))
                stack.append(len(self.name) - 1)
            self.items.append((None, name, stack[-1]))
        if at < len(page):
            parts.append(page[at:])
        flush()
        close(1)
        self.end[0] = len(self.items)


@dataclass
class Model:
    words: dict[str, float]  # log-odds of a word in an element with this feature
    tags: dict[str, float]

    def own(self, features: tuple) -> float:
        return sum(self.words.get(x, 0.0) for x in features)

    def spoken(self, page: Page) -> tuple[list[float], list[float], list[float]]:
        """For every element what it says itself, and the strongest that it or one around it says against and for its words."""
        own, low, high = [], [], []
        for features, parent in zip(page.features, page.parent, strict=True):
            w = self.own(features)
            own.append(w)
            low.append(min(low[parent] if low else 0.0, w))
            high.append(max(high[parent] if high else 0.0, w))
        return own, low, high

    def tag(self, name: str) -> float:
        return self.tags.get(name, -0.3)


def word_score(low: float, high: float) -> float:
    """Score of one word: the strongest voice against it, else the strongest for it."""
    return max(low, -4.0) if low < AGAINST_FROM else min(1.0, 0.5 + high / 4)


def prior() -> Counter:
    """Counts (feature, inside) that stand in for pages that no labelled page shows."""
    out = Counter()
    for names, mark, inside in ((AGAINST + HIDDEN, "", 0), (FOR, "", 1), (NAMES_AGAINST, ".", 0), (NAMES_FOR, ".", 1), (ROLES_AGAINST, "@", 0)):
        for n in names:
            out[mark + n, inside] += PRIOR
    out["!hidden", 0] += PRIOR
    out["@main", 1] += PRIOR
    # These hold anything.
    for n in "html body div span section".split():
        out[n, 0] += 1e9
        out[n, 1] += 1e9
    return out


def counted(page: str) -> Counter:
    """Words by (feature, inside the article) and tags by ('<name', inside), for a page with one article or main element."""
    p = Page(page)
    marks = [n for n in p.name if n in ("article", "main")]
    if not marks or marks.count("article") > 1:
        return Counter()
    drop = set(AGAINST) | set(HIDDEN)
    in_article, dropped = [], []
    for name, parent in zip(p.name, p.parent, strict=True):
        in_article.append(name in ("article", "main") or bool(in_article) and in_article[parent])
        dropped.append(name in drop or bool(dropped) and dropped[parent])
    out, held = Counter(), [[0, 0] for _ in p.name]
    for text, name, element in p.items:
        inside = int(in_article[element] and not dropped[element])
        if text is None:
            out["<" + name, inside] += 1
        else:
            held[element][inside] += text.count(" ") + 1
    # Elements come after those around them, so sums go up in one pass from the end.
    for element in range(len(p.name) - 1, 0, -1):
        for side in (0, 1):
            n = held[element][side]
            if n:
                held[p.parent[element]][side] += n
                for f in p.features[element]:
                    out[f, side] += n
    return out


def _counts(batches):
    for batch in batches:
        total = Counter()
        for page in batch.column(0).to_pylist():
            if page:
                total.update(counted(page))
        names = [k[0] for k in total]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([k[1] for k in total], pa.int32()), pa.array([int(v) for v in total.values()], pa.int64())], ["feature", "inside", "n"]
        )


def learned(counts: Counter) -> Model:
    total = Counter(counts)
    total.update(prior())
    words, tags = {}, {}
    sums = [sum(v for (f, s), v in counts.items() if f.startswith("<") and s == side) + 1 for side in (0, 1)]
    for f in {f for f, _ in total}:
        if f.startswith("<"):
            share = [(total[f, side] + 0.5) / sums[side] for side in (0, 1)]
            tags[f[1:]] = -0.1 - min(1.0, max(0.0, log(share[0] / share[1]) / 2))
        else:
            words[f] = log((total[f, 1] + 1) / (total[f, 0] + 1))
    return Model(words, tags)


def fit(pages: DataFrame, html: str = "html", key: str = "page_id") -> Model:
    """Learns from at most about SAMPLE_PAGES pages that mark their article."""
    marked = pages.where(F.col(html).rlike("(?i)<(article|main)\\b")).select(key, html)
    rows = bounded_sample(marked, key, SAMPLE_PAGES).select(html)
    found = rows.mapInArrow(_counts, "feature string, inside int, n long").groupBy("feature", "inside").agg(F.sum("n").alias("n"))
    found = found.orderBy(F.desc("n"), "feature", "inside").limit(MOST_FEATURES).collect()
    return learned(Counter({(r.feature, r.inside): r.n for r in found}))


def _container(page: Page, own: list[float], first: int, last: int) -> int:
    """The element that holds the items from `first` to `last`, or the outermost around it that speaks for content."""
    element = page.items[first][2]
    while element and page.end[element] <= last:
        element = page.parent[element]
    found, around = element, element
    while around and own[around] >= AGAINST_FROM and page.name[around] not in ("html", "body"):
        if own[around] > SPEAKS_FROM:
            found = around
        around = page.parent[around]
    return found


def main_text(page: str | None, model: Model) -> str:
    """The best contiguous region and what else of its container some element speaks for, without blocks spoken against."""
    if not page:
        return ""
    p = Page(page)
    own, low, high = model.spoken(p)
    best, best_span, run, start = 0.0, (0, 0), 0.0, 0
    for k, (text, name, element) in enumerate(p.items):
        gain = model.tag(name) if text is None else word_score(low[element], high[element]) * (text.count(" ") + 1)
        if run <= 0:
            run, start = 0.0, k
        run += gain
        if run > best:
            best, best_span = run, (start, k + 1)
    region = [k for k in range(*best_span) if p.items[k][0] is not None and low[p.items[k][2]] >= AGAINST_FROM]
    if not region:
        return ""
    container = _container(p, own, region[0], region[-1])
    more = range(p.first[container], p.end[container]) if container and p.name[container] not in ("html", "body") else ()
    kept = set(region) | {k for k in more if p.items[k][0] is not None and low[p.items[k][2]] >= AGAINST_FROM and high[p.items[k][2]] > SPEAKS_FROM}
    return "\n".join(p.items[k][0] for k in sorted(kept))


def extract(pages: DataFrame, model: Model, html: str = "html", into: str = "text") -> DataFrame:
    """Adds the main text of every whole page."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([main_text(p, model) for p in column.to_pylist()], pa.string())

    return pages.withColumn(into, run(F.col(html)))


def query(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html")
    rows = extract(pages, fit(pages))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
