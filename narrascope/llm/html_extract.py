"""Main text of web pages by minimum-cut labelling of their blocks.

A page is read as blocks of text. A classifier gives each block the odds of being part of the
article; they are its capacity to the source or the sink. Blocks that follow each other, and
blocks that are near in the tree of elements, are joined by edges, the stronger the more
elements are around both. The maximum flow saturates the cheapest cut, and the blocks on the
source's side are the text: one doubtful block is decided by its neighbours.

The classifier is a logistic regression on the look of a block (length, share of links,
punctuation, kind of element). It is fitted by weak supervision: blocks of a sample of the
pages themselves, labelled by the elements that say what they are (``article`` and ``main``;
``nav``, ``aside``, ``footer``), pulled towards stated weights where there is little to learn
from. On every page what elements, roles and names say is added to its odds, and outweighs it.

Defined results: null and empty pages have an empty text; every row has its own result, also
with a null or repeated id; pages without a tag are one block; a page of any length is read
whole; an empty table gives an empty result; of the other columns those asked for are kept.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrascope.llm.common import col, slices, texts_of
from narrascope.llm.html_blocks import HEADINGS, Block, Page, read_page

#: Pages, about, and labelled blocks of each at most that the classifier is fitted on.
SAMPLE_PAGES, SAMPLE_BLOCKS = 2000, 64
#: Odds (as logarithms): the most that the look of a block gives; what elements and names say;
#: being outside of the page's article; being named like content.
MOST_LOOK, SAID, OUTSIDE, NAMED = 4.0, 8.0, -4.0, 2.0
#: Edges between blocks that follow each other, and by the share of common elements.
NEXT, NEAR = 0.3, 1.2
_UNITS = 1000  # capacities are whole numbers, so a cut is exact
_PULL = 2.0

FEATURES = ["bias", "words", "short", "links", "ended", "commas", "heading", "paragraph", "item", "capitals"]
#: What blocks look like, when a sample says nothing else.
USUAL = np.array([-1.6, 0.7, -0.8, -4.0, 1.2, 0.6, 0.3, 1.0, -0.6, -0.8])


def looks(block: Block) -> list[float]:
    """Features of a block, in the order of FEATURES."""
    words = block.text.split(" ")
    n, chars = len(words), max(1, len(block.text) - len(words) + 1)
    return [
        1.0, np.log1p(n), float(n <= 3), min(1.0, block.link_chars / chars), float(block.text[-1] in ".!?…\"'”»:"),
        min(1.0, 4 * (block.text.count(",") + block.text.count(".")) / n), float(block.tag in HEADINGS),
        float(block.tag in ("p", "blockquote", "pre")), float(block.tag in ("li", "td", "th", "dt", "dd")),
        sum(word[0].isupper() for word in words) / n,
    ]


def _applies(page: Page, at: int, total: int, in_article: bool) -> int:
    """What an element says of the text in it: 1, -1 or 0."""
    element = page.elements[at]
    if element.hint == -2:
        return 0 if element.holds_article and 2 * element.chars > total else -1
    if element.hint == -3:
        return 0 if in_article else -1
    return element.hint


def said(page: Page) -> list[tuple[int, bool]]:
    """Of each block what the elements around it say (1, -1 or 0), and whether a name does.

    What is not part of the text stays so inside an article; comments are one as often as not.
    """
    total = sum(len(block.text) for block in page.blocks)
    told = [(0, False)]
    for at, element in enumerate(page.elements[1:], 1):
        above, weak = told[element.parent]
        here = _applies(page, at, total, above == 1)
        told.append((above if above == -1 or here == 0 else here, weak or element.weak))
    return [told[block.element] for block in page.blocks]


def odds(page: Page, weights: np.ndarray) -> np.ndarray:
    """Logarithm of the odds that each block is part of the text."""
    values = np.clip(np.array([looks(block) for block in page.blocks]) @ weights, -MOST_LOOK, MOST_LOOK)
    told = said(page)
    outside = OUTSIDE if any(what == 1 for what, _ in told) else 0.0
    return values + np.array([SAID * what if what else outside + NAMED * weak for what, weak in told])


def _paths(page: Page) -> list[list[int]]:
    """From the root to the element of each block."""
    paths = []
    for block in page.blocks:
        path, at = [], block.element
        while at >= 0:
            path.append(at)
            at = page.elements[at].parent
        paths.append(path[::-1])
    return paths


def edges(page: Page) -> list[tuple[int, int, float]]:
    """Between neighbours in the page, and between blocks of one parent with others between."""
    paths, last, found = _paths(page), {}, []
    for i, path in enumerate(paths):
        if i:
            other = paths[i - 1]
            common = 0
            for a, b in zip(path, other):
                if a != b:
                    break
                common += 1
            found.append((i - 1, i, NEXT + NEAR * common / max(len(path), len(other))))
        parent = path[-2] if len(path) > 1 else path[-1]
        if last.get(parent, i - 1) != i - 1:
            found.append((last[parent], i, NEAR))
        last[parent] = i
    return found


def min_cut(gains: list[int], links: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the source in a cheapest cut.

    A node of positive gain costs that much on the sink's side, one of negative gain on the
    source's; a link costs its weight where it is cut. Of equal cuts the one with the fewest
    nodes at the source is taken. Shortest paths are filled level by level.
    """
    n = len(gains)
    source, sink = n, n + 1
    heads, room, of = [], [], [[] for _ in range(n + 2)]

    def join(a: int, b: int, forth: int, back: int) -> None:
        of[a].append(len(heads))
        heads.append(b)
        room.append(forth)
        of[b].append(len(heads))
        heads.append(a)
        room.append(back)

    for i, gain in enumerate(gains):
        if gain > 0:
            join(source, i, gain, 0)
        elif gain < 0:
            join(i, sink, -gain, 0)
    for a, b, weight in links:
        join(a, b, weight, weight)
    while True:
        level = [-1] * (n + 2)
        level[source], queue = 0, deque([source])
        while queue:
            at = queue.popleft()
            for e in of[at]:
                if room[e] and level[heads[e]] < 0:
                    level[heads[e]] = level[at] + 1
                    queue.append(heads[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        tried, path, at = [0] * (n + 2), [], source
        while True:
            if at == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                first = next(k for k, e in enumerate(path) if not room[e])
                at = heads[path[first] ^ 1]
                del path[first:]
            while tried[at] < len(of[at]):
                e = of[at][tried[at]]
                if room[e] and level[heads[e]] == level[at] + 1:
                    break
                tried[at] += 1
            if tried[at] < len(of[at]):
                path.append(e)
                at = heads[e]
            elif path:
                at = heads[path.pop() ^ 1]
                tried[at] += 1
            else:
                break


def main_text(html: str, weights: np.ndarray = USUAL) -> str:
    """The text of one page, its blocks joined by empty lines."""
    page = read_page(html)
    if not page.blocks:
        return ""
    gains = np.rint(_UNITS * odds(page, weights)).astype(int).tolist()
    links = [(a, b, round(_UNITS * weight)) for a, b, weight in edges(page)]
    kept = min_cut(gains, links)
    return "\n\n".join(block.text for block, keep in zip(page.blocks, kept) if keep)


def _labelled(html: str) -> Iterator[tuple[list[float], int]]:
    """Features and label of blocks whose elements say what they are, evenly over the page."""
    page = read_page(html)
    told = [(block, what) for block, (what, _) in zip(page.blocks, said(page)) if what]
    for i in range(0, len(told), -(-len(told) // SAMPLE_BLOCKS) or 1):
        block, what = told[i]
        yield looks(block), int(what == 1)


def fit(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression, pulled towards USUAL; both labels count the same."""
    if not 0 < labels.sum() < labels.size:
        return USUAL
    share = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (labels.size - labels.sum())) * min(labels.size, 1000)
    weights = USUAL.copy()
    for _ in range(20):
        p = 1 / (1 + np.exp(-np.clip(features @ weights, -30, 30)))
        slope = features.T @ (share * (labels - p)) - _PULL * (weights - USUAL)
        bend = (features * (share * p * (1 - p))[:, None]).T @ features + _PULL * np.eye(weights.size)
        step = np.linalg.solve(bend, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-9:
            break
    return weights


def train_blocks(pages: DataFrame, html_col: str = "html", most_pages: int = SAMPLE_PAGES) -> np.ndarray:
    """Weights fitted on about ``most_pages`` pages, taken by a hash of their text.

    Equal pages are taken or left together; at most SAMPLE_BLOCKS blocks of a page and four
    times the pages reach the driver, as numbers.
    """
    total = pages.count()
    digest = F.xxhash64(F.coalesce(col(html_col), F.lit("")))
    every = -(-total // most_pages) or 1
    some = pages.select(col(html_col).alias("html")).filter(F.pmod(digest, F.lit(every)) == 0).distinct().limit(4 * most_pages)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row for html in texts_of(batch.column(0)) for row in _labelled(html)]
            lists = pa.array([f for f, _ in rows], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([lists, pa.array([y for _, y in rows], pa.int32())], ["features", "label"])

    rows = some.mapInArrow(features, "features array<double>, label int").toArrow()
    if not rows.num_rows:
        return USUAL
    table = np.array(rows["features"].to_pylist())
    labels = rows["label"].to_numpy()
    order = np.lexsort([*table.T, labels])  # sums do not depend on the order of tasks
    return fit(table[order], labels[order])


def extract_main_text(
    pages: DataFrame, keep: list[str], html_col: str = "html", weights: np.ndarray | None = None
) -> DataFrame:
    """The columns ``keep`` of every page, then text and n_chars (its code points).

    Without ``weights`` the classifier is fitted on the pages first.
    """
    weights = train_blocks(pages, html_col) if weights is None else weights
    kept = pages.select(*[col(name) for name in keep])
    schema = T.StructType([*kept.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1):
                texts = [main_text(html, weights) for html in texts_of(part.columns[-1])]
                lengths = pa.array([len(text) for text in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string()), lengths], schema.names)

    return pages.select(*[col(name) for name in keep], col(html_col)).mapInArrow(run, schema)
