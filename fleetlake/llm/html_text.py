"""Main text of web pages by boosted trees over the nodes of the document tree.

A page is read into a tree. Each element is described by its tag and attribute tokens,
its depth, the density of text, links and marks in its subtree, and its siblings. Boosted
trees give the odds that it belongs to the article. Decoding chooses, from the leaves
up, whether an element is better dropped with all below it or kept with the best choice
for each child; so nothing is kept below what is dropped.

The trees are fitted once per driver on generated pages whose elements are labelled
(`html_training`), `TRAINING_PAGES` of them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Trees
from .common import ship

TRAINING_PAGES = 400
_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>)", re.S
)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|itemprop|aria-label|hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_TOKEN = re.compile(r"[a-z]+")

# The roles of tags, and the words that name parts of pages.
_GROUPS = {
    "heading": "h1 h2 h3 h4 h5 h6 hgroup",
    "paragraph": "p blockquote pre figcaption address dd dt summary",
    "list": "ul ol dl menu",
    "item": "li",
    "link": "a",
    "container": "div section center details body html figure fieldset",
    "article": "article main",
    "nav": "nav",
    "header": "header",
    "footer": "footer",
    "aside": "aside dialog",
    "form": "form button input select option textarea label legend",
    "code": "script style noscript template iframe object svg head title meta link base",
    "table": "table thead tbody tfoot tr td th caption",
}
_GROUP = {tag: i + 1 for i, tags in enumerate(_GROUPS.values()) for tag in tags.split()}
_NUMBER = {name: i + 1 for i, name in enumerate(_GROUPS)}
_GOOD = frozenset("article articlebody content entry main post story text body blog page".split())
_BAD = frozenset(
    "ad ads advert advertisement adverts advertising sponsor sponsored banner promo breadcrumb breadcrumbs comment comments "
    "reply replies discussion disqus cookie cookies consent gdpr notice alert message header masthead topbar footer bottom "
    "menu nav navbar navigation sidebar side widget related recommended popular share sharing social subscribe newsletter "
    "signup login register search form popup modal overlay pagination pager toolbar skip copyright legal tags meta byline".split()
)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe template svg select".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
FEATURES = 27


@lru_cache(maxsize=4096)
def _attributes(text: str) -> tuple[int, int, int]:
    """Words for the article, words against it, and whether it is hidden."""
    words: list[str] = []
    hidden = 0
    for name, value in _ATTRIBUTE.findall(text):
        if name.lower() == "hidden":
            hidden = 1
        words += _TOKEN.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
    return sum(w in _GOOD for w in words), sum(w in _BAD for w in words), hidden


class Page:
    """Elements in page order, and text pieces as (element, block, text)."""

    def __init__(self, source: str) -> None:
        self.tags, self.parents, self.depths, self.marks = ["#page"], [-1], [0], [(0, 0, 0)]
        self.pieces: list[tuple[int, int, str]] = []
        stack, opened, block, at = [0], {}, 0, 0

        def close(n: int) -> None:
            for i in stack[n:]:
                opened[self.tags[i]] -= 1
            del stack[n:]

        while True:
            m = _MARK.search(source, at)
            text = source[at : m.start() if m else len(source)]
            if text:
                self.pieces.append((stack[-1], block, text))
            if not m:
                break
            at = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                if opened.get(tag, 0):
                    n = len(stack) - 1
                    while self.tags[stack[n]] != tag:
                        n -= 1
                    close(n)
                block += tag not in _INLINE
                continue
            inline = tag in _INLINE
            block += not inline
            if not inline and opened.get("p", 0) and tag not in ("html", "body"):
                n = len(stack) - 1
                while self.tags[stack[n]] in _INLINE:
                    n -= 1
                if self.tags[stack[n]] == "p":
                    close(n)
            if tag in _CLOSES:
                closed, limit = _CLOSES[tag]
                n = len(stack) - 1
                while n > 0 and self.tags[stack[n]] not in closed and self.tags[stack[n]] not in limit and len(stack) - n < 32:
                    n -= 1
                if self.tags[stack[n]] in closed:
                    close(n)
            attributes = m[3][:-1]
            self.tags.append(tag)
            self.parents.append(stack[-1])
            self.depths.append(len(stack))
            self.marks.append(_attributes(attributes) if attributes.strip("/ ") else (0, 0, 0))
            me = len(self.tags) - 1
            if tag == "br":
                self.pieces.append((stack[-1], block, " "))
            if tag in _RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
                self.pieces.append((me, block, source[at : end.start() if end else len(source)]))
                at = end.end() if end else len(source)
                block += 1
            elif tag not in _VOID and not attributes.endswith("/"):
                stack.append(me)
                opened[tag] = opened.get(tag, 0) + 1


class Forest:
    """The elements of many pages as arrays; an element stands after its parent."""

    def __init__(self, pages: list[Page]) -> None:
        sizes = [len(p.tags) for p in pages]
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        shift = np.repeat(self.first[:-1], sizes)
        self.parent = np.array([x for p in pages for x in p.parents], np.int64) + shift
        depth = np.array([x for p in pages for x in p.depths])
        self.root = depth == 0
        self.parent[self.root] = self.first[:-1]
        self.depth = depth
        order = np.argsort(depth, kind="stable")
        cuts = np.searchsorted(depth[order], np.arange(1, depth.max(initial=0) + 2))
        self.levels = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]  # below the roots, from the top
        self.group = np.array([_GROUP.get(t, 0) for p in pages for t in p.tags])
        self.mark = np.array([x for p in pages for x in p.marks]).reshape(-1, 3)
        n = len(depth)
        self.chars, self.stops, self.runs = np.zeros(n), np.zeros(n), np.zeros(n)
        for page, start in zip(pages, self.first.tolist()):
            for element, _, text in page.pieces:
                size = len(text) if not text.isspace() else 0
                if size:
                    self.chars[start + element] += size
                    self.stops[start + element] += text.count(".") + text.count(",") + text.count("?") + text.count("!")
                    self.runs[start + element] += 1

    def below(self, values: np.ndarray) -> np.ndarray:
        """Sums over subtrees."""
        out = values.astype(float)
        for level in reversed(self.levels):
            np.add.at(out, self.parent[level], out[level])
        return out

    def above(self, flags: np.ndarray) -> np.ndarray:
        """Whether an element or one above it is flagged."""
        out = flags.copy()
        for level in self.levels:
            out[level] |= out[self.parent[level]]
        return out

    def features(self) -> np.ndarray:
        is_group = {name: self.group == number for name, number in _NUMBER.items()}
        code = self.above(is_group["code"])
        own = np.where(code, 0, self.chars)
        chars, stops, runs = self.below(own), self.below(np.where(code, 0, self.stops)), self.below(np.where(code, 0, self.runs))
        in_link = self.above(is_group["link"])
        linked = self.below(np.where(in_link, own, 0))
        nodes = self.below(np.ones(len(own)))
        prose = self.below(np.where(is_group["paragraph"] | is_group["heading"], 1, 0))
        controls = self.below(is_group["form"])
        items = self.below(is_group["item"])
        n = len(own)
        siblings = np.bincount(self.parent[~self.root], minlength=n)
        nth = np.zeros(n)
        before, after = np.zeros(n), np.zeros(n)
        inner = np.flatnonzero(~self.root)
        by_parent = inner[np.argsort(self.parent[inner], kind="stable")]
        if len(by_parent):
            parent = self.parent[by_parent]
            new = np.concatenate([[True], parent[1:] != parent[:-1]])
            starts = np.flatnonzero(new)
            nth[by_parent] = np.arange(len(parent)) - np.repeat(starts, np.diff(np.append(starts, len(parent))))
            same = ~new
            before[by_parent[same]] = chars[by_parent[np.flatnonzero(same) - 1]]
            after[by_parent[np.flatnonzero(same) - 1]] = chars[by_parent[same]]
        whole = np.repeat(chars[self.first[:-1]], np.diff(self.first))
        p = self.parent
        bad_above = self.above(self.mark[:, 1] > 0)
        good_above = self.above((self.mark[:, 0] > 0) & (self.mark[:, 1] == 0))
        return np.column_stack(
            [
                self.group,
                self.group[p],
                self.depth,
                np.log1p(chars),
                linked / (chars + 1),
                nodes / (chars + 1) * 100,
                stops / (chars + 1) * 100,
                chars / (runs + 1),
                chars / (whole + 1),
                np.log1p(nodes),
                prose,
                controls,
                items / nodes,
                self.mark[:, 0],
                self.mark[:, 1],
                self.mark[p, 1],
                self.mark[:, 2] + code,
                siblings[p],
                nth / np.maximum(siblings[p], 1),
                chars / (chars[p] + 1),
                np.log1p(before),
                np.log1p(after),
                self.above(is_group["article"]) & ~is_group["article"],
                self.above(is_group["nav"] | is_group["aside"] | is_group["footer"]),
                self.above(is_group["header"] | is_group["form"]),
                bad_above,
                good_above,
            ]
        ).astype(np.float64)

    def decode(self, margin: np.ndarray) -> np.ndarray:
        """Which elements are kept; the roots always are."""
        keep = -np.logaddexp(0, -margin)
        drop = self.below(-np.logaddexp(0, margin))
        best = keep.copy()
        for level in reversed(self.levels):
            best[level] = np.maximum(best[level], drop[level])
            np.add.at(best, self.parent[level], best[level])
        # `best` of an inner element now holds the choices below it and its own
        kept = self.root.copy()
        for level in self.levels:
            kept[level] = kept[self.parent[level]] & (best[level] > drop[level])
        return kept


@lru_cache(maxsize=1)
def trained(pages: int = TRAINING_PAGES) -> Trees:
    from .html_training import labelled_pages

    sources, labels = labelled_pages(pages)
    return Trees.fit(Forest([Page(s) for s in sources]).features(), np.concatenate(labels).astype(float))


def extract(sources: list[str], trees: Trees) -> list[str]:
    """Main text of each page: blocks in page order, one to a line."""
    pages = [Page(s) for s in sources]
    forest = Forest(pages)
    kept = forest.decode(trees.margin(forest.features()))
    out = []
    for page, start in zip(pages, forest.first.tolist()):
        mine = kept[start : start + len(page.tags)].tolist()
        blocks: list[str] = []
        current, parts = -1, []
        for element, block, text in page.pieces:
            if mine[element]:
                if block != current:
                    blocks.append("".join(parts))
                    current, parts = block, []
                parts.append(text)
        blocks.append("".join(parts))
        lines = [" ".join(html.unescape(b).split()) for b in blocks]
        out.append("\n".join(line for line in lines if line))
    return out


def main_text(pages: DataFrame, html_column: str = "html", names: tuple[str, str] = ("text", "n_chars"), group: int = 64) -> DataFrame:
    """All rows and columns, with the page's main text and its length in code points.

    A null or empty page, and one without an article, has the empty text. Rows stay one to
    one, also repeated ones; `names` must not clash with columns. Pages of any length are
    read whole; an empty table gives no rows. Malformed marks are read as text.
    """
    clash = set(names) & set(pages.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist; choose other names")
    ship(pages.sparkSession)
    trees = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, group):
                part = batch.slice(at, group)
                sources = [s or "" for s in part.column(part.schema.get_field_index(html_column)).to_pylist()]
                texts = extract(sources, trees)
                yield part.append_column(names[0], pa.array(texts, pa.string())).append_column(
                    names[1], pa.array([len(t) for t in texts], pa.int64())
                )

    schema = pages.limit(0).withColumn(names[0], F.lit("")).withColumn(names[1], F.lit(0).cast("long")).schema
    return pages.mapInArrow(run, schema)
