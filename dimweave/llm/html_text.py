"""Main text of web pages by a decision tree over flat text blocks.

A page is cut into blocks at block-level tags. Each block has its word count and link density, those of
the blocks before and after it, and where it stands: within an article or main element, within an element
for something else (menus, adverts, forms, comments and so on, by tag, role or the words of class and
id), on a page with an article at all. The innermost such element counts. A decision tree that Spark
ML trains on ``LABELLED`` decides which blocks stay, one for pages with an article and one for the others, where the
neighbours tell a heading from a stray line; the trees' leaves are compiled to tests on the features.

A page is read once from start to end, however deep its elements nest. Pages are handled where they lie; nothing is shuffled. A null html is empty and gives an empty text;
null page_ids and urls are kept; repeated rows each get their row. An empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimweave.llm.common import slices

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "in_article", "in_other", "page_has_article"]

#: Labelled blocks, made up: the features in their order, then 1 if the block is main text.
LABELLED = [
    # pages with an article: paragraphs, headings and short lines of it
    (120, 0.0, 80, 0.0, 95, 0.0, 1, 0, 1, 1), (6, 0.0, 9, 0.0, 110, 0.0, 1, 0, 1, 1), (1, 0.0, 60, 0.0, 70, 0.0, 1, 0, 1, 1), (45, 0.1, 6, 0.0, 0, 0.0, 1, 0, 1, 1),
    (12, 0.9, 50, 0.0, 40, 0.0, 1, 0, 1, 1), (2, 1.0, 30, 0.0, 20, 0.1, 1, 0, 1, 1), (300, 0.02, 8, 0.0, 8, 0.0, 1, 0, 1, 1), (8, 0.0, 5, 1.0, 200, 0.0, 1, 0, 1, 1),
    (3, 0.0, 3, 0.0, 3, 0.0, 1, 0, 1, 1), (70, 0.0, 1, 0.0, 1, 0.0, 1, 0, 1, 1), (25, 0.3, 1, 1.0, 12, 0.0, 1, 0, 1, 1), (15, 0.0, 0, 0.0, 0, 0.0, 1, 0, 1, 1),
    # ... menus, adverts, forms, notices and comments beside or within it
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 1, 0), (9, 0.0, 1, 1.0, 7, 0.0, 0, 1, 1, 0), (30, 0.0, 60, 0.0, 80, 0.0, 0, 1, 1, 0), (6, 0.2, 90, 0.0, 0, 0.0, 0, 1, 1, 0),
    (110, 0.0, 6, 0.0, 4, 0.0, 0, 1, 1, 0), (2, 0.5, 4, 0.0, 3, 0.0, 0, 1, 1, 0), (55, 0.0, 120, 0.0, 40, 0.0, 0, 1, 1, 0), (4, 0.0, 30, 0.0, 2, 0.0, 0, 1, 1, 0),
    (14, 0.1, 14, 0.1, 14, 0.1, 0, 1, 1, 0), (200, 0.0, 2, 0.0, 9, 0.0, 0, 1, 1, 0),
    # ... and plain blocks outside of it
    (5, 0.0, 1, 1.0, 9, 0.0, 0, 0, 1, 0), (40, 0.0, 3, 0.0, 80, 0.0, 0, 0, 1, 0), (90, 0.0, 70, 0.0, 3, 0.0, 0, 0, 1, 0), (3, 1.0, 3, 1.0, 4, 1.0, 0, 0, 1, 0),
    (12, 0.5, 60, 0.0, 8, 0.0, 0, 0, 1, 0), (150, 0.0, 6, 0.0, 4, 0.0, 0, 0, 1, 0), (60, 0.0, 40, 0.0, 10, 0.0, 0, 0, 1, 0), (25, 0.0, 25, 0.0, 25, 0.0, 0, 0, 1, 0),
    # pages without one: running text
    (80, 0.0, 6, 0.0, 75, 0.0, 0, 0, 0, 1), (40, 0.1, 60, 0.0, 55, 0.0, 0, 0, 0, 1), (22, 0.0, 40, 0.0, 3, 1.0, 0, 0, 0, 1), (150, 0.05, 3, 1.0, 8, 0.0, 0, 0, 0, 1),
    (30, 0.2, 4, 0.0, 90, 0.0, 0, 0, 0, 1), (18, 0.0, 50, 0.0, 60, 0.0, 0, 0, 0, 1), (12, 0.0, 70, 0.0, 80, 0.0, 0, 0, 0, 1), (95, 0.0, 80, 0.0, 85, 0.0, 0, 0, 0, 1),
    (17, 0.1, 30, 0.0, 2, 0.0, 0, 0, 0, 1), (60, 0.25, 20, 0.0, 20, 0.0, 0, 0, 0, 1), (12, 0.0, 20, 0.1, 40, 0.0, 0, 0, 0, 1), (14, 0.0, 9, 0.0, 25, 0.0, 0, 0, 0, 1),
    (60, 0.0, 1, 1.0, 50, 0.0, 0, 0, 0, 1), (40, 0.0, 2, 1.0, 70, 0.0, 0, 0, 0, 1), (90, 0.0, 3, 1.0, 60, 0.0, 0, 0, 0, 1), (30, 0.0, 1, 1.0, 45, 0.0, 0, 0, 0, 1),
    # ... headings and short lines within it
    (4, 0.0, 60, 0.0, 90, 0.0, 0, 0, 0, 1), (6, 0.0, 75, 0.0, 110, 0.0, 0, 0, 0, 1), (2, 0.0, 90, 0.0, 70, 0.0, 0, 0, 0, 1), (1, 0.0, 45, 0.0, 60, 0.0, 0, 0, 0, 1),
    (8, 0.0, 30, 0.0, 40, 0.0, 0, 0, 0, 1), (5, 0.0, 40, 0.1, 35, 0.0, 0, 0, 0, 1), (7, 0.0, 120, 0.0, 150, 0.1, 0, 0, 0, 1), (3, 0.0, 25, 0.0, 50, 0.0, 0, 0, 0, 1),
    # ... menus, link lists and stray lines
    (1, 0.0, 1, 1.0, 60, 0.0, 0, 0, 0, 0), (3, 0.0, 2, 1.0, 80, 0.0, 0, 0, 0, 0), (2, 0.0, 1, 1.0, 45, 0.0, 0, 0, 0, 0), (4, 0.0, 3, 1.0, 100, 0.0, 0, 0, 0, 0),
    (4, 0.0, 80, 0.0, 1, 1.0, 0, 0, 0, 0), (7, 0.0, 60, 0.0, 0, 0.0, 0, 0, 0, 0), (5, 0.0, 90, 0.0, 4, 0.0, 0, 0, 0, 0), (3, 0.0, 2, 1.0, 6, 0.0, 0, 0, 0, 0),
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0), (3, 1.0, 2, 1.0, 4, 1.0, 0, 0, 0, 0), (14, 0.9, 10, 1.0, 12, 0.8, 0, 0, 0, 0), (25, 0.7, 2, 1.0, 40, 0.0, 0, 0, 0, 0),
    (5, 0.0, 3, 1.0, 4, 1.0, 0, 0, 0, 0), (4, 0.5, 80, 0.0, 6, 0.3, 0, 0, 0, 0), (2, 0.0, 5, 1.0, 1, 0.0, 0, 0, 0, 0), (40, 0.6, 8, 1.0, 9, 1.0, 0, 0, 0, 0),
    (6, 0.0, 6, 0.5, 5, 0.0, 0, 0, 0, 0), (8, 0.4, 4, 0.0, 3, 0.0, 0, 0, 0, 0),
    # ... and elements for something else
    (35, 0.0, 70, 0.0, 60, 0.0, 0, 1, 0, 0), (90, 0.0, 80, 0.0, 0, 0.0, 0, 1, 0, 0), (12, 0.1, 40, 0.0, 50, 0.0, 0, 1, 0, 0), (60, 0.0, 60, 0.0, 60, 0.0, 0, 1, 0, 0),
    (60, 0.0, 1, 1.0, 4, 0.0, 0, 1, 0, 0), (80, 0.0, 2, 1.0, 70, 0.0, 0, 1, 0, 0), (110, 0.0, 3, 1.0, 2, 1.0, 0, 1, 0, 0),
    (150, 0.05, 90, 0.0, 75, 0.0, 0, 1, 0, 0), (20, 0.0, 30, 0.0, 55, 0.0, 0, 1, 0, 0),
]

#: Fixed values of HTML: elements that end a block, that have no end tag, and whose content is no text of the page.
BLOCK_TAGS = set("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
                 " head header hgroup hr html iframe legend li main menu nav noscript ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = set("script style title textarea template noframes iframe object svg canvas audio video".split())

#: What an element is for, by its tag, its role or a word of its class or id.
ARTICLE_TAGS = {"article", "main"}
OTHER_TAGS = set("nav aside form menu dialog button select noscript header footer".split())
OTHER_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
OTHER_WORDS = set("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar nav navbar navigation menu breadcrumb breadcrumbs"
                  " header masthead topbar footer bottombar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup"
                  " login comment comments commentlist respond reply replies disqus discussion share sharing social related recommended widget toolbar search pagination"
                  " pager legal copyright skip disclaimer form paywall".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[a-zA-Z/!?][^>]*+>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")


@dataclass
class Block:
    pieces: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    role: str | None = None
    blank: bool = True


def purpose(tag: str, attributes: str, within_article: bool) -> str | None:
    """"article", "main", "other" or None if the element says nothing. An article's own header is part of it."""
    if tag in ARTICLE_TAGS:
        return tag
    if tag in OTHER_TAGS and not (tag == "header" and within_article):
        return "other"
    if attributes.strip(" /"):
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), html.unescape("".join(values)).lower()
            if name == "hidden" or name == "role" and value.strip() in OTHER_ROLES or name == "style" and "display:none" in value.replace(" ", ""):
                return "other"
            if name in ("class", "id") and tag not in ("body", "html"):
                words = OTHER_WORDS.intersection(re.split(r"[^a-z0-9]+", value))
                if words - ({"header"} if within_article else set()):
                    return "other"
    return None


def blocks(page: str) -> list[tuple[str, float, bool, bool]]:
    """Text, link density, in an article, in something else, of every block with text."""
    found: list[Block] = []
    block = Block()
    open_: list[tuple[str, str | None, str | None, str]] = []  # tag, purpose, and the innermost purpose with the tag that has it
    opened: Counter = Counter()
    links = articles = 0

    def text(piece: str) -> None:
        if not piece:
            return
        *_, role, holder = open_[-1] if open_ else (None, "")
        if role == "other" and holder not in BLOCK_TAGS:
            return  # a note within a line
        if block.blank:
            block.role, block.blank = role, not piece.strip()
        block.pieces.append(piece)
        if links:
            block.linked.append(piece)

    def flush() -> None:
        nonlocal block
        if block.pieces:
            found.append(block)
        block = Block()

    at, end = 0, len(page)
    while at < end:
        token = _TOKEN.search(page, at)
        if not token:
            text(page[at:])
            break
        text(page[at: token.start()])
        at = token.end()
        if token[2]:
            closing, tag, attributes = token[1], token[2].lower(), token[3]
        else:
            named = _NAME.match(token[0])
            if not named:
                continue
            closing, tag, attributes = "/" if token[0][1] == "/" else "", named[1].lower(), ""
        if tag in RAW_TAGS and not closing:
            stop = re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else end
            if tag in BLOCK_TAGS or tag == "title":
                flush()
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
        if closing:
            while opened[tag]:
                name, own, *_ = open_.pop()
                opened[name] -= 1
                links -= name == "a"
                articles -= own == "article"
                if name == tag:
                    break
        elif tag not in VOID_TAGS:
            own = purpose(tag, attributes, articles > 0)
            open_.append((tag, own, own, tag) if own else (tag, None, *(open_[-1][2:] if open_ else (None, ""))))
            opened[tag] += 1
            links += tag == "a"
            articles += own == "article"
    flush()
    out, article = [], "article" if any(b.role == "article" for b in found) else "main"
    for b in found:
        words = " ".join(html.unescape("".join(b.pieces)).split())
        if words:
            linked = len(html.unescape(" ".join(b.linked)).split())
            out.append((words, min(1.0, linked / len(words.split())), b.role == article, b.role == "other"))
    return out


def features(page: list[tuple[str, float, bool, bool]]) -> np.ndarray:
    """A row of ``FEATURES`` for each block."""
    words = np.array([len(b[0].split()) for b in page], float)
    links = np.array([b[1] for b in page], float)
    article, other = np.array([b[2] for b in page], float), np.array([b[3] for b in page], float)

    def moved(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        padded = np.concatenate(([0.0], x, [0.0]))
        return padded[:-2], padded[2:]

    (wb, wa), (lb, la) = moved(words), moved(links)
    return np.stack([words, links, wb, lb, wa, la, article, other, np.full(len(page), float(article.any()))], axis=1)


def train(spark: SparkSession) -> list[list[tuple[int, str, float]]]:
    """Train a tree on the labelled blocks of pages with an article and one on the others; the paths of comparisons that lead to main text."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.functions import array_to_vector

    kind, paths = FEATURES.index("page_has_article"), []
    for has_article, sign in ((0, "<="), (1, ">")):
        own = [([float(v) for v in r[:-1]], float(r[-1])) for r in LABELLED if r[kind] == has_article]
        rows = spark.createDataFrame(own, "features array<double>, label double").coalesce(1)
        tree = DecisionTreeClassifier(maxDepth=6, maxBins=64, minInstancesPerNode=1, seed=1).fit(rows.select("label", array_to_vector("features").alias("features")))
        paths += [[(kind, sign, 0.5), *path] for path in main_text_paths(tree.toDebugString)]
    return paths


def main_text_paths(description: str) -> list[list[tuple[int, str, float]]]:
    path: list[tuple[int, str, float]] = []
    kept, top = [], None
    for line in description.splitlines():
        if test := re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dE]+)\)", line):
            top = len(test[1]) if top is None else top
            path = [*path[: len(test[1]) - top], (int(test[2]), test[3], float(test[4]))]
        elif (leaf := re.match(r"\s*Predict: ([\d.]+)", line)) and float(leaf[1]) == 1.0:
            kept.append(path)
    return kept


def is_main(rows: np.ndarray, paths: list[list[tuple[int, str, float]]]) -> np.ndarray:
    keep = np.zeros(len(rows), bool)
    for path in paths:
        own = np.ones(len(rows), bool)
        for column, sign, value in path:
            own &= rows[:, column] <= value if sign == "<=" else rows[:, column] > value
        keep |= own
    return keep


def main_text(page: str, paths: list[list[tuple[int, str, float]]]) -> str:
    found = blocks(page)
    if not found:
        return ""
    return "\n\n".join(b[0] for b, keep in zip(found, is_main(features(found), paths), strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    paths = train(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b, "html")):
            texts = [main_text(h, paths) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
