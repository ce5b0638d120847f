"""Main text of web pages by a maximum-scoring subsequence.

A page is read as one sequence of tags and words. Words score above zero and tags below; how much, depends on the element
that they are in, or are, and is learned from labelled pages: log odds of content against the rest. One linear scan finds the
contiguous region of the largest sum; the text is that of its words, and nothing outside it is taken.

Where a page marks its content (an article, else a main element), words in it score most and its tags least, and words
outside it score below zero. Words of elements that HTML keeps for other things (``NEVER``: menus, footers, asides, forms,
scripts) are no text, and score nothing. Class, id and role names are evidence that is added to the score of the words below
them: learned from labelled pages, and until enough pages speak, from two short lists of names (``STRONG``, ``WEAK``). Words
whose sum is not above zero are no text. Inside a marked article only overwhelming evidence brings it there: a name of the
weak list does not, whatever its element holds.

Labelled pages are a bounded sample of the input (PAGES, the first by a hash of their id) in which an article or main
element marks the content; without any, DEFAULT weights are used. Pages are extracted in one pass without a shuffle, each
in time linear in its length.

Defined results: a null page is empty, and a page without words or without markup for content gives its words or the
empty text; a null id or url is kept; repeated rows get equal results; tags that are not closed, or closed twice, are
closed by their parent, or passed over; no rows in, no rows out; other columns are not looked at.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fringelake.llm.common import blocks, first_by_hash, text_of

#: Pages of the labelled sample, and characters read of each.
PAGES, CHARS = 400, 200_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var wbr img".split()
)
NEVER = frozenset(
    "script style noscript template head title nav header footer aside form button select option optgroup textarea iframe"
    " object svg canvas audio video dialog menu fieldset legend input datalist".split()
)
RAW = frozenset("script style noscript template textarea title iframe svg xmp".split())
#: Elements that end an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu"
    " nav ol p pre section table ul".split()
)
ITEMS = frozenset("li dt dd tr td th option".split())
#: Names that speak against content until labelled pages say otherwise: so much (STRONG) that they do within an article too.
STRONG = frozenset(
    "ad ads advert adverts advertisement advertising sponsored cookie cookies gdpr consent sidebar comment comments disqus"
    " replies navigation contentinfo complementary".split()
)
WEAK = frozenset(
    "nav navbar menu breadcrumb breadcrumbs banner header masthead footer topbar toolbar notice alert popup modal overlay promo"
    " promotion sponsor share sharing social related recommended newsletter subscribe signup login search pagination pager"
    " widget widgets form skip".split()
)
#: Parts of names that say nothing.
PLAIN = frozenset("list section box wrap wrapper container main site page area".split())
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[^-_]+")
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z) | <[!?][^>]*(?:>|\Z) | <(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+(?=>|\Z)|[^>]*+)(?:>|\Z)
    | (?P<text>[^<]++|<)""",
    re.S | re.X,
)
#: Bounds of a learned weight; the evidence of a name on either list, and how many pages it takes to outweigh it.
LOW, HIGH, SURE, HINT, PRIOR_PAGES = 0.05, 2.0, -5.0, -3.0, 20
#: Score of a word in marked content, and of one outside it.
INSIDE, OUTSIDE = 4.0, -1.0
#: Weights where no page is labelled: of a word, by the block that it is in, of a tag, and of a name (none learned).
_TEXT = "p h1 h2 h3 h4 h5 h6 blockquote pre br".split()
DEFAULT = {"word": {}, "tag": {**dict.fromkeys(_TEXT, -0.2), **dict.fromkeys(INLINE - {"a"}, -0.2)}, "name": {}, "other_word": 1.0, "other_tag": -2.0}


def prior(name: str) -> float:
    """Evidence of a class, id or role name that no labelled page has."""
    parts = _PARTS.findall(name.lower())
    if WEAK.isdisjoint(parts) and STRONG.isdisjoint(parts):
        return 0.0
    return SURE if not STRONG.isdisjoint(parts) and (STRONG | WEAK | PLAIN).issuperset(parts) else HINT


class Page:
    """The sequence: `tokens` are (text or None, element). Of each element its tag, parent, nearest element that is not inline,
    whether it is NEVER text, the nearest article and main around it (or itself), and its names."""

    def __init__(self, source: str):
        self.tag, self.parent, self.block, self.never, self.article, self.main = ["#root"], [-1], [0], [False], [0], [0]
        self.names: dict[int, list[str]] = {}
        self.tokens: list[tuple[str | None, int]] = []
        tag, parent, block, tokens = self.tag, self.parent, self.block, self.tokens
        opened: Counter = Counter()
        node, at, end, match = 0, 0, len(source), _TOKEN.match

        def close_to(node: int, last: int) -> int:
            while node != last:
                opened[tag[node]] -= 1
                node = parent[node]
            return node

        while at < end:
            found = match(source, at)
            at = found.end()
            close, name, rest, text = found.groups()
            if text is not None:
                tokens.append((text, node))
            elif name is not None:
                name = name.lower()
                if close:
                    if opened[name] > 0:
                        while tag[node] != name:
                            opened[tag[node]] -= 1
                            node = parent[node]
                        tokens.append((None, node))
                        node = close_to(node, parent[node])
                    continue
                around = block[node]
                if around and (tag[around] == "p" if name in ENDS_P else name in ITEMS and tag[around] == name):
                    node = close_to(node, parent[around])
                element = self._open(name, node, rest)
                tokens.append((None, element))
                if name in RAW and not rest.endswith("/"):
                    ends = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                    at = ends.end() if ends else end
                elif name not in VOID and not (rest.endswith("/") and name not in INLINE and name not in ENDS_P):
                    node = element
                    opened[name] += 1

    def _open(self, name: str, parent: int, rest: str) -> int:
        element = len(self.tag)
        self.tag.append(name)
        self.parent.append(parent)
        self.block.append(self.block[parent] if name in INLINE else element)
        self.article.append(element if name == "article" else self.article[parent])
        self.main.append(element if name == "main" else self.main[parent])
        marked = self.article[parent] or self.main[parent]
        self.never.append(self.never[parent] or name in NEVER and not (name == "header" and marked))
        if rest and "=" in rest and name not in ("body", "html"):
            names = {n for groups in _NAMES.findall(rest) for n in "".join(groups).split()}
            if names:
                self.names[element] = sorted(names)
        return element

    def marked(self) -> list[int] | None:
        """For each element the article that it is in, or main element where there is no article; None without either."""
        return self.article if "article" in self.tag else self.main if "main" in self.tag else None


def learn(pages: list[str]) -> dict:
    """Weights from pages whose article or main element marks the content."""
    words, tags, names = ({True: Counter(), False: Counter()} for _ in range(3))
    seen: Counter = Counter()  # pages that have a name
    for source in pages:
        page = Page(source)
        inside = page.marked()
        if inside is None:
            continue
        below = {True: [0] * len(page.tag), False: [0] * len(page.tag)}
        for text, node in page.tokens:
            content = bool(inside[node if text is not None else page.parent[node]]) and not page.never[node]
            if text is not None:
                n = len(text.split())
                words[content][page.tag[page.block[node]]] += n
                below[content][node] += n
            else:
                tags[content][page.tag[node]] += 1
        for content, sums in below.items():
            for node in range(len(sums) - 1, 0, -1):  # elements are numbered in page order, children after their parent
                sums[page.parent[node]] += sums[node]
            for node, its in page.names.items():
                for name in its:
                    names[content][name] += sums[node]
        seen.update({name for its in page.names.values() for name in its})
    if not words[True]:
        return DEFAULT

    n_words, n_tags = ({side: sum(c.values()) for side, c in counts.items()} for counts in (words, tags))

    def odds(counts, totals, key):
        return math.log((counts[True][key] + 0.5) / (totals[True] + 1)) - math.log((counts[False][key] + 0.5) / (totals[False] + 1))

    # Words stay above zero and tags below: a word counts as much as its element speaks for content, a tag as much against.
    word = {n: min(HIGH, max(LOW, odds(words, n_words, n))) for n in set(words[True]) | set(words[False])}
    tag = {n: -min(HIGH, max(LOW, -odds(tags, n_tags, n))) for n in set(tags[True]) | set(tags[False])}
    name = {n: (PRIOR_PAGES * prior(n) + k * min(0.0, max(SURE, odds(names, n_words, n)))) / (PRIOR_PAGES + k) for n, k in seen.items()}
    return {"word": word, "tag": tag, "name": name, "other_word": 1.0, "other_tag": -HIGH}


def best_region(scores: list[float]) -> tuple[int, int]:
    """(first, last + 1) of the contiguous run of largest sum, the first of equal ones; (0, 0) if no sum is above zero."""
    best, where, total, start = 0.0, (0, 0), 0.0, 0
    for k, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += score
        if total > best:
            best, where = total, (start, k + 1)
    return where


def scored(page: Page, weights: dict) -> list[float]:
    """The score of each token. Words that are no text have 0, or OUTSIDE times their number outside marked content."""
    inside, learned = page.marked(), weights["name"]
    evidence = [0.0] * len(page.tag)
    for node in range(1, len(page.tag)):
        own = page.names.get(node)
        told = min(learned[n] if n in learned else prior(n) for n in own) if own else 0.0
        evidence[node] = min(evidence[page.parent[node]], told)  # the strongest that is on the way
    tag, word, other_tag, other_word = weights["tag"], weights["word"], weights["other_tag"], weights["other_word"]
    out = []
    for text, node in page.tokens:
        if text is None:
            out.append(-LOW if inside and inside[node] else tag.get(page.tag[node], other_tag))
        elif page.never[node]:
            out.append(0.0)
        elif inside and not inside[node]:
            out.append(OUTSIDE * len(text.split()))
        else:
            base = INSIDE if inside else word.get(page.tag[page.block[node]], other_word)
            out.append(max(0.0, base + evidence[node]) * len(text.split()))
    return out


def text_of_region(page: Page, scores: list[float], first: int, last: int) -> str:
    """The words of a region that score above zero, block by block."""
    parts, run = [], []
    for (text, node), score in zip(page.tokens[first:last], scores[first:last]):
        if text is None:
            if page.tag[node] not in INLINE and run:
                parts.append("".join(run))
                run = []
        elif score > 0 or not page.never[node] and text.isspace():
            run.append(text)
    parts.append("".join(run))
    blocks_ = (" ".join(html.unescape(part).split()) for part in parts)
    return " ".join(block for block in blocks_ if block)


def extract(source: str, weights: dict = DEFAULT) -> str:
    page = Page(source)
    scores = scored(page, weights)
    return text_of_region(page, scores, *best_region(scores))


def _extracted(batches, weights):
    for batch in batches:
        for part in blocks(batch, "html"):
            texts = [extract(source, weights.value) for source in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars."""
    read = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), text_of(html_col).alias("html"))
    chosen = read.filter(F.col("html").rlike("(?i)<(article|main)[ >]")).select("page_id", F.substring("html", 1, CHARS).alias("html"))
    sample = first_by_hash(chosen, "page_id", PAGES, chosen.count()).collect()
    weights = pages.sparkSession.sparkContext.broadcast(learn([row["html"] for row in sample]))
    return read.mapInArrow(lambda batches: _extracted(batches, weights), "page_id long, url string, text string, n_chars long")


def op2_html_extract(spark, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
