"""Main text of web pages: boosted trees over DOM nodes, decoded over the tree.

The model is a gradient-boosted tree classifier of Spark's ML library, fitted on
``SAMPLE_PAGES`` labelled pages (see ``sample_pages``; this number bounds the
sample). Its features are those of ``dom.features``: tags, attribute tokens,
depth, subtree text and link density, sibling statistics.

Decoding is over the whole tree of a page. Every element is before the article,
in it, or an excluded part inside it; on the way down from the root the state may
only move forward along before -> in -> excluded; inline markup shares the
state of its block. Of all labellings without such
a contradiction the one with the highest probability is taken, by dynamic
programming from the leaves up. The text of the elements that are in comes out
block by block.

One ``mapInArrow`` pass over the pages; the fitted trees, a few thousand numbers,
travel with the task.

Defined cases: a null or empty page, or one without readable text, gives an empty
string. Broken and cut-off markup is read as far as it goes, very long pages
whole. Repeated rows give repeated results, an empty table an empty one; other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession

from nimbusmart.llm import dom
from nimbusmart.llm.sample_pages import sample_pages

SAMPLE_PAGES = 400
ROUNDS, DEPTH = 30, 5


def labels(page: dom.Page) -> np.ndarray:
    """1 for elements of the marked article, 0 for the others."""
    y = np.zeros(len(page.tag), dtype=bool)
    for i in range(1, len(y)):
        y[i] = page.mark[i] == "1" or (y[page.parent[i]] and page.mark[i] != "0")
    return y


def fit(spark: SparkSession, n_pages: int = SAMPLE_PAGES, seed: int = 5) -> list[tuple[np.ndarray, ...]]:
    """The trees as arrays: feature (-1 in leaves), threshold, left, right, value."""
    rows = []
    for source in sample_pages(n_pages, seed):
        page = dom.parse(source)
        y, x = labels(page), dom.features(page)
        rows += [(float(a), Vectors.dense(b)) for a, b in zip(y, x, strict=True)]
    data = spark.createDataFrame(rows, ["label", "features"]).coalesce(4).cache()
    model = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.3, seed=seed).fit(data)
    data.unpersist()
    return [_arrays(t, w) for t, w in zip(model.trees, model.treeWeights, strict=True)]


_fitted: dict[tuple[int, int], list[tuple[np.ndarray, ...]]] = {}


def fitted(spark: SparkSession, n_pages: int = SAMPLE_PAGES, seed: int = 5) -> list[tuple[np.ndarray, ...]]:
    """The trees for a sample, fitted once: they depend on nothing else."""
    if (n_pages, seed) not in _fitted:
        _fitted[n_pages, seed] = fit(spark, n_pages, seed)
    return _fitted[n_pages, seed]


def _arrays(tree, weight: float) -> tuple[np.ndarray, ...]:
    feature, threshold, left, right, value = [], [], [], [], []

    def add(node) -> int:
        i = len(feature)
        leaf = node.subtreeDepth() == 0
        feature.append(-1 if leaf else node.split().featureIndex())
        threshold.append(0.0 if leaf else node.split().threshold())
        value.append(weight * node.prediction())
        left.append(i)
        right.append(i)
        if not leaf:
            left[i] = add(node.leftChild())
            right[i] = add(node.rightChild())
        return i

    add(tree._call_java("rootNode"))
    return np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value)


def log_odds(trees: list[tuple[np.ndarray, ...]], x: np.ndarray) -> np.ndarray:
    """Log odds of being in the article, for every row of features."""
    total = np.zeros(len(x))
    rows = np.arange(len(x))
    for feature, threshold, left, right, value in trees:
        at = np.zeros(len(x), dtype=np.int64)
        for _ in range(DEPTH):
            goes_left = x[rows, np.maximum(feature[at], 0)] <= threshold[at]
            at = np.where(goes_left, left[at], right[at])
        total += value[at]
    return 2 * total


def decode(page: dom.Page, odds: np.ndarray) -> np.ndarray:
    """Elements in the article, under the best labelling without contradiction."""
    n = len(page.tag)
    # Unnamed inline markup belongs to the block around it.
    inline = [t in dom.INLINE and not k for t, k in zip(page.tag, page.kinds, strict=True)]
    weight = np.where(inline, 0.0, np.clip(odds, -6, 6))
    # Best sums of the subtree by the element's own state; "excluded" sums are 0
    # like "before" ones: only elements that are in count with their odds.
    before = np.zeros(n)
    inside = weight.copy()
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        before[p] += before[i] if inline[i] else max(before[i], inside[i])
        inside[p] += inside[i] if inline[i] else max(inside[i], 0.0)
    state = np.zeros(n, dtype=np.int8)
    state[0] = 1 if inside[0] > before[0] else 0
    for i in range(1, n):
        p = state[page.parent[i]]
        if inline[i]:
            state[i] = p
        elif p == 0:
            state[i] = 1 if inside[i] > before[i] else 0
        elif p == 1:
            state[i] = 1 if inside[i] > 0 else 2
        else:
            state[i] = 2
    return state == 1


def extract_page(source: str | None, trees: list[tuple[np.ndarray, ...]]) -> str:
    if not source:
        return ""
    page = dom.parse(source)
    return "\n".join(dom.blocks(page, decode(page, log_odds(trees, dom.features(page)))))


def extract(pages: DataFrame, n_pages: int = SAMPLE_PAGES) -> DataFrame:
    """page_id, url and the main text of every page."""
    trees = fitted(pages.sparkSession, n_pages)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                texts = [extract_page(s, trees) for s in part.column(2).to_pylist()]
                columns = [part.column(0).cast(pa.int64()), part.column(1).cast(pa.string()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string")
