"""Main text of web pages: flat text blocks, told apart by a decision tree on their words and links."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plugtide.llm.words import slices

# Elements whose content is no text of the page.
SKIPPED = {
    "script", "style", "noscript", "template", "title", "svg", "math", "iframe", "object", "canvas",
    "audio", "video", "select", "option", "button", "textarea", "datalist",
}
# Elements that stand inside a line of text.
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "img", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span",
    "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
# Elements that never hold others.
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
# Elements that hold what surrounds an article, and those that hold one.
CHROME = {"nav", "aside", "footer", "header", "form", "menu", "dialog", "fieldset"}
ARTICLE = {"article", "main"}
# Names of classes, ids and roles that mark what surrounds an article.
MARKS = re.compile(
    r"(?:^|[_-])(?:ads?\d*|ad-?(?:box|unit|slot|container|wrapper)|adverts?"
    r"|advertisements?|adsense|banners?|sponsor(?:ed|s)?|promos?|promotions?"
    r"|nav|navbar|navigation|menus?|breadcrumbs?|footer|site-header|page-header|masthead|topbar|toolbar"
    r"|side-?bars?|widgets?|share|sharing|social|comments?|replies|discussion|disqus"
    r"|cookies?|consent|gdpr|notices?|alerts?|popups?|modals?|overlays?|newsletter|subscribe|subscription"
    r"|sign-?up|log-?in|search|pagination|pager|copyright|disclaimer|complementary|contentinfo"
    r"|(?:related|recommended)[_-](?:posts?|articles?|stories|links?|news|items?|pages?|products?|topics?|videos?)"
    r")(?:$|[_-])",
    re.IGNORECASE,
)
# Names that mark surroundings when they stand alone; within a longer name they may as
# well say what a part of the article is about.
LOOSE_MARKS = re.compile(r"(?:^|[_-])(?:related|recommended|legal)(?:$|[_-])", re.IGNORECASE)
# Names that tell an article's subject where they stand on the article's own element.
SUBJECTS = {
    "legal", "social", "share", "sharing", "search", "copyright", "discussion", "notice", "notices",
    "alert", "alerts", "consent", "gdpr", "cookie", "cookies", "subscription",
}
# How names begin that tell what else a page has, not what the element is.
LAYOUT = re.compile(r"(?:with|without|has|no)[_-]", re.IGNORECASE)
CONTENT_MARKS = re.compile(
    r"(?:^|[_-])(?:article|article-?body|post|post-?body|post-?content|entry|entry-?content"
    r"|main|main-?content|content|story|prose)(?:$|[_-])",
    re.IGNORECASE,
)
# Raw text ends only with the element's own end tag; whatever else looks like a tag belongs to it.
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|title|textarea|iframe|xmp|noembed)(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-z][^\s>/]*)((?:[^>\"']+|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
NAMES = re.compile(r"""(?:^|[\s"'])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none""", re.IGNORECASE)

FEATURES = [
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
    "in_article", "mark",
]
# The labelled table. One block per row: the features in the order above, and 1 for
# blocks of an article. `mark` is 2 in a page's surroundings, 1 under a name that may mark some.
# First pages that mark their article, then pages that mark nothing.
LABELLED = [
    (9, 0.00, 8, 0.00, 60, 0.00, 1, 0, 1),
    (60, 0.00, 9, 0.00, 45, 0.02, 1, 0, 1),
    (45, 0.02, 60, 0.00, 1, 0.00, 1, 0, 1),
    (1, 0.00, 45, 0.02, 80, 0.00, 1, 0, 1),
    (80, 0.00, 1, 0.00, 12, 0.00, 1, 0, 1),
    (2, 0.00, 1, 0.00, 6, 0.50, 1, 0, 1),
    (12, 0.25, 80, 0.00, 30, 0.10, 1, 0, 1),
    (1, 0.00, 0, 0.00, 0, 0.00, 1, 0, 1),
    (3, 0.00, 6, 1.00, 3, 0.00, 1, 0, 1),
    (150, 0.05, 3, 0.00, 6, 1.00, 1, 0, 1),
    (5, 0.40, 20, 0.00, 20, 0.00, 1, 0, 1),
    (7, 0.00, 1, 1.00, 2, 0.00, 1, 0, 1),
    (25, 0.00, 14, 0.00, 9, 0.00, 1, 0, 1),
    (11, 0.00, 9, 0.00, 7, 0.10, 1, 0, 1),
    (200, 0.00, 0, 0.00, 10, 0.10, 1, 0, 1),
    (16, 0.60, 40, 0.00, 25, 0.00, 1, 0, 1),
    (4, 0.00, 3, 0.00, 4, 0.00, 1, 0, 1),
    (30, 0.10, 200, 0.00, 5, 0.00, 1, 0, 1),
    (6, 1.00, 70, 0.00, 5, 1.00, 1, 0, 0),
    (4, 1.00, 5, 1.00, 4, 1.00, 1, 0, 0),
    (8, 0.95, 6, 1.00, 3, 0.00, 1, 0, 0),
    (1, 1.00, 0, 0.00, 1, 1.00, 0, 2, 0),
    (1, 1.00, 1, 1.00, 8, 0.00, 0, 2, 0),
    (8, 0.00, 1, 1.00, 9, 0.00, 0, 2, 0),
    (40, 0.00, 1, 1.00, 9, 0.00, 0, 2, 0),
    (14, 0.10, 80, 0.00, 0, 0.00, 0, 2, 0),
    (90, 0.00, 14, 0.00, 20, 0.00, 0, 2, 0),
    (2, 0.00, 0, 0.00, 60, 0.00, 0, 2, 0),
    (55, 0.00, 40, 0.00, 70, 0.00, 0, 2, 0),
    (120, 0.02, 90, 0.00, 35, 0.00, 0, 2, 0),
    (10, 0.00, 50, 0.00, 45, 0.10, 0, 2, 0),
    (25, 0.00, 60, 0.00, 30, 0.00, 1, 2, 0),
    (6, 0.00, 90, 0.00, 25, 0.00, 1, 2, 0),
    (70, 0.02, 25, 0.00, 6, 0.00, 1, 2, 0),
    (3, 1.00, 70, 0.00, 3, 1.00, 1, 2, 0),
    (1, 0.00, 40, 0.00, 2, 0.00, 1, 2, 0),
    (60, 0.00, 45, 0.00, 80, 0.00, 1, 2, 0),
    (12, 0.00, 150, 0.05, 60, 0.00, 1, 2, 0),
    (70, 0.00, 2, 0.00, 50, 0.00, 1, 1, 1),
    (35, 0.05, 60, 0.00, 45, 0.00, 1, 1, 1),
    (2, 0.00, 60, 0.00, 70, 0.00, 1, 1, 1),
    (15, 0.00, 70, 0.00, 30, 0.00, 1, 1, 1),
    (20, 0.30, 35, 0.05, 60, 0.00, 1, 1, 1),
    (60, 0.00, 2, 0.00, 0, 0.00, 1, 1, 1),
    (45, 0.05, 70, 0.00, 5, 0.50, 1, 1, 1),
    (30, 0.00, 45, 0.00, 4, 0.00, 1, 1, 1),
    (5, 0.00, 40, 0.00, 0, 0.00, 1, 1, 0),
    (2, 0.00, 80, 0.00, 6, 1.00, 1, 1, 0),
    (6, 1.00, 2, 0.00, 7, 1.00, 1, 1, 0),
    (30, 0.90, 5, 1.00, 28, 0.90, 1, 1, 0),
    (40, 0.00, 70, 0.00, 0, 0.00, 0, 1, 0),
    (25, 0.05, 30, 0.00, 9, 0.00, 0, 1, 0),
    (4, 1.00, 2, 0.00, 5, 1.00, 0, 1, 0),
    (35, 0.00, 20, 0.00, 40, 0.00, 0, 0, 1),
    (60, 0.05, 35, 0.00, 50, 0.00, 0, 0, 1),
    (120, 0.10, 5, 0.00, 80, 0.00, 0, 0, 1),
    (18, 0.00, 4, 0.00, 30, 0.00, 0, 0, 1),
    (40, 0.00, 2, 1.00, 4, 0.00, 0, 0, 1),
    (50, 0.02, 4, 0.00, 8, 0.00, 0, 0, 1),
    (22, 0.10, 9, 0.00, 3, 1.00, 0, 0, 1),
    (8, 0.00, 2, 1.00, 60, 0.00, 0, 0, 1),
    (6, 0.00, 50, 0.00, 45, 0.00, 0, 0, 1),
    (12, 0.00, 40, 0.00, 18, 0.00, 0, 0, 1),
    (5, 0.00, 30, 0.05, 90, 0.00, 0, 0, 1),
    (3, 0.00, 2, 1.00, 3, 1.00, 0, 0, 0),
    (2, 1.00, 0, 0.00, 2, 1.00, 0, 0, 0),
    (2, 1.00, 2, 1.00, 3, 0.00, 0, 0, 0),
    (30, 0.80, 2, 1.00, 20, 0.70, 0, 0, 0),
    (20, 0.60, 60, 0.00, 4, 1.00, 0, 0, 0),
    (45, 0.70, 3, 0.00, 50, 0.00, 0, 0, 0),
    (4, 1.00, 35, 0.00, 40, 0.50, 0, 0, 0),
    (7, 0.00, 4, 1.00, 5, 0.20, 0, 0, 0),
    (9, 0.00, 5, 0.20, 0, 0.00, 0, 0, 0),
    (10, 0.30, 7, 0.00, 0, 0.00, 0, 0, 0),
    (4, 0.00, 60, 0.00, 3, 1.00, 0, 0, 0),
    (5, 0.00, 9, 0.00, 8, 0.00, 0, 0, 0),
]


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 6):
    """A decision tree: a label, or (feature, threshold, tree at most, tree above).

    Each node takes the split with the least Gini impurity, the first of equals, halfway between
    two values.
    """
    share = labels.mean()
    if depth == 0 or share in (0, 1):
        return int(share >= 0.5)
    best = (2 * share * (1 - share) * len(labels) - 1e-9, None, None)
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for threshold in (values[1:] + values[:-1]) / 2:
            sides = [labels[rows[:, feature] <= threshold], labels[rows[:, feature] > threshold]]
            impurity = sum(2 * s.mean() * (1 - s.mean()) * len(s) for s in sides)
            if impurity < best[0] - 1e-12:
                best = (impurity, feature, threshold)
    _, feature, threshold = best
    if feature is None:
        return int(share >= 0.5)
    low = rows[:, feature] <= threshold
    return feature, float(threshold), grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1)


def trained_tree():
    table = np.array(LABELLED, float)
    return grow(table[:, :-1], table[:, -1])


def decide(tree, features: tuple) -> int:
    while not isinstance(tree, int):
        feature, threshold, low, high = tree
        tree = low if features[feature] <= threshold else high
    return tree


def _ends(tags: list[re.Match]) -> dict[int, int]:
    """Per tag that opens an element without text of the page, the tag that closes it, if one does."""
    ends: dict[int, int] = {}
    open_tags: dict[str, list[int]] = {}
    for i, tag in enumerate(tags):
        name = (tag[3] or "").lower()
        if name in SKIPPED:
            if not tag[2]:
                open_tags.setdefault(name, []).append(i)
            elif open_tags.get(name):
                ends[open_tags[name].pop()] = i
    return ends


def blocks(page: str) -> list[tuple[str, int, int, bool, int]]:
    """The page's text blocks in order: text, words, words in links, in an article, grade of its mark.

    A block ends where an element begins or ends that does not stand inside a line. Open elements
    that hold others are kept on a stack; an end tag closes the innermost one of its name, and one
    that was never opened closes nothing, so markup that is cut off or badly nested does no harm. An
    element without text of the page goes up to its end tag, or else up to the next block.
    """
    found: list[tuple[str, int, int, bool, int]] = []
    pieces: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, bool, int]] = []
    links, resume, unclosed = 0, -1, False

    def close() -> None:
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                words = len(text.split(" "))
                in_links = len(entities.unescape(" ".join(linked)).split())
                article = any(s[1] for s in stack)
                found.append((text, words, min(in_links, words), article, stack[-1][2] if stack else 0))
            pieces.clear()
            linked.clear()

    at = 0
    tags = list(TAG.finditer(page))
    ends = _ends(tags)
    for i, match in enumerate(tags):
        if i > resume and not unclosed and match.start() > at:
            pieces.append(page[at : match.start()])
            if links:
                linked.append(pieces[-1])
        at = match.end()
        name = (match[3] or "").lower()
        if not name or i <= resume:
            continue
        if name in SKIPPED:
            if not match[2] and not match[4].rstrip().endswith("/"):
                if i in ends:
                    resume = ends[i]
                else:
                    unclosed = True
            continue
        if unclosed and (name in INLINE or name == "br"):
            continue
        unclosed = False
        if name == "a":
            links = 0 if match[2] else 1
            continue
        if name == "br":
            pieces.append("\n")
            continue
        if name in INLINE:
            continue
        close()
        links = 0
        if name in VOID or name in ("p", "html", "body"):
            continue
        if match[2]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
            continue
        stack.append((name, *_place(name, match[4], stack)))
    if not unclosed and at < len(page):
        pieces.append(page[at:])
        if links:
            linked.append(pieces[-1])
    close()
    return found


def _grade(token: str, content: bool) -> int:
    """How much a name marks surroundings: 2 if it does, 1 if it may. On an article's own element it
    does only when it stands alone, and then not if it may be the article's subject."""
    if LAYOUT.match(token):
        return 0
    mark = MARKS.search(token) or LOOSE_MARKS.search(token)
    if not mark:
        return 0
    alone = mark.span() == (0, len(token))
    if content:
        return 2 if alone and token.lower() not in SUBJECTS else 0
    return 2 if alone or MARKS.search(token) else 1


def _place(name: str, attributes: str, stack: list[tuple[str, bool, int]]) -> tuple[bool, int]:
    """Whether an element holds an article, and the grade of what marks it as surroundings of one."""
    outside = stack[-1][2] if stack else 0
    in_article = any(s[1] for s in stack)
    names = " ".join(m.strip("\"'") for m in NAMES.findall(attributes)).split() if attributes else []
    named = any(CONTENT_MARKS.search(t) and not MARKS.search(t) for t in names)
    article = name in ARTICLE or named
    own = max((_grade(t, article) for t in names), default=0)
    # A comment in an article is often an article of its own, told by how its name begins.
    if article and in_article and not named:
        own = max([own, *(2 for t in names if (m := MARKS.search(t)) and m.start() == 0)])
    # The heading of an article stands in a header of its own.
    if name in CHROME and not (name == "header" and in_article) or attributes and HIDDEN.search(attributes):
        own = 2
    if article and not in_article and own < 2:
        return True, own
    return article, max(outside, own)


def main_text(page: str | None, tree) -> str:
    """The text of the blocks that the tree takes for an article's, joined by spaces."""
    found = blocks(page or "")
    density = [links / words for _, words, links, _, _ in found]
    kept = []
    for i, (text, words, _, article, mark) in enumerate(found):
        before = (found[i - 1][1], density[i - 1]) if i else (0, 0.0)
        after = (found[i + 1][1], density[i + 1]) if i + 1 < len(found) else (0, 0.0)
        if decide(tree, (words, density[i], *before, *after, article, mark)):
            kept.append(text)
    return " ".join(kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of `pages`: page_id, url, text, n_chars. No shuffle; each page is read whole.

    A null or empty page, and one without an article, has an empty text. Null ids and urls are
    passed on, repeated rows each get their own row.
    """
    tree = trained_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(page, tree) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array(map(len, texts), pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html")
    )
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
