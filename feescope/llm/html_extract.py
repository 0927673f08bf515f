"""Main text of web pages by gradient-boosted trees over DOM nodes.

Every block element and text run of a page gets a probability of holding main
text from boosted trees over subtree density, attribute tokens, depth and
sibling statistics.  Hierarchical decoding then takes the likeliest consistent
choice for the whole page: what an element leaves out takes everything below it
along, and an element is only kept with some kept text.

Training.  Pages carry no labels, so the trees (``GBTClassifier``) learn from
pages that are made for it: the text blocks of ``train_pages`` pages (a
documented bound; chosen by a hash of page_id) are laid out in varied designs,
with and without telling tags and class names, together with menus, headers,
footers, sidebars, notices, adverts, forms and comments.  Each sampled page is
laid out ``layouts`` times.  A fixed filler stands in if the sample has no text.

Defined cases: null and empty pages, and pages without main text, give an empty
text; every row gives one row, repeated or not; cut-off pages, unclosed and
misnested tags are read as far as they go; an empty table gives an empty result.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feescope.llm.common import hash_unit, ship_code
from feescope.session import materialize
from feescope.llm.html_dom import decode, features, main_text, parse
from feescope.llm.html_layouts import Layout

TRAIN_PAGES = 200
LAYOUTS = 3
TREES = 24
DEPTH = 5
SEED = 11
FILLER = ("The committee met on Tuesday to discuss the plan, and most members agreed with it. Some asked for more time.",
          "Read more about it here", "A short note.", "In the end, the river was lower than in any summer since the records began, and "
          "the boats stayed where they were; nobody in the village could remember such a year.")


# ---------------------------------------------------------------- trees

@dataclass
class Trees:
    """Boosted trees as arrays, one row per tree: inner nodes have a feature, leaves a value."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(x))
        rows = np.arange(len(x))
        for f, t, left, right, v in zip(self.feature, self.threshold, self.left, self.right, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(64):
                k = f[at]
                inner = k >= 0
                if not inner.any():
                    break
                at = np.where(inner, np.where(x[rows, np.maximum(k, 0)] <= t[at], left[at], right[at]), at)
            margin += v[at]
        return 1 / (1 + np.exp(-2 * margin))


def exported(model) -> Trees:
    """The trees of a fitted ``GBTClassificationModel``, weights multiplied in."""
    trees = []
    for tree, weight in zip(model.trees, model.treeWeights):
        rows: list[list[float]] = []

        def walk(node) -> int:
            i = len(rows)
            rows.append([-1, 0.0, i, i, node.prediction() * weight])
            if node.subtreeDepth():
                split = node.split()
                rows[i][:2] = [split.featureIndex(), split.threshold()]
                rows[i][2:4] = [walk(node.leftChild()), walk(node.rightChild())]
            return i

        walk(tree._java_obj.rootNode())
        trees.append(rows)
    width = max(map(len, trees))
    table = np.array([t + [[-1, 0.0, 0, 0, 0.0]] * (width - len(t)) for t in trees])
    return Trees(table[:, :, 0].astype(int), table[:, :, 1], table[:, :, 2].astype(int), table[:, :, 3].astype(int), table[:, :, 4])


# ---------------------------------------------------------------- training

def node_labels(dom) -> np.ndarray:
    """1 for runs of marked elements and for what holds one."""
    y = np.array([bool(t) and dom.main[p] for t, p in zip(dom.text, dom.parent)], bool)
    for i in range(len(y) - 1, 0, -1):
        y[dom.parent[i]] |= y[i]
    return y


def _training_rows(layouts: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            blocks, pages = list(FILLER), []
            for page_id, page in zip(b.column(0).to_pylist(), b.column(1)):
                own = [t for t in parse(page.as_py() or "").text if t]
                blocks += own
                pages.append((page_id, own))
            blocks = blocks[len(FILLER):] or blocks
            for page_id, own in pages:
                rng = random.Random(f"{seed}:{page_id}")
                for _ in range(layouts):
                    k = rng.randint(1, 14)
                    main = [rng.choice(own or blocks) for _ in range(k)]
                    if rng.random() < 0.7:  # like a real article: some long blocks
                        main.append(max((rng.choice(blocks) for _ in range(6)), key=len))
                        rng.shuffle(main)
                    dom = parse(Layout(rng).page(main, blocks))
                    y = node_labels(dom)
                    x = features([dom])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(y.astype(float)), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["label", "x"])
    return run


def train(pages: DataFrame, train_pages: int = TRAIN_PAGES, layouts: int = LAYOUTS, trees: int = TREES,
          depth: int = DEPTH, seed: int = SEED) -> Trees:
    """Trees from a bounded sample of ``pages`` (page_id, html)."""
    spark = pages.sparkSession
    ship_code(spark)
    n = pages.count()
    share = min(1.0, 1.2 * train_pages / max(1, n))
    drawn = hash_unit(F.col("page_id"), F.lit(seed))
    some = pages.select("page_id", "html").where(drawn <= share).orderBy(  # the sample depends on the pages, not on their files
        drawn, "page_id", F.xxhash64("html")).limit(train_pages)
    if not n:
        some = spark.createDataFrame([(0, "")], "page_id long, html string")
    rows = some.repartition(4).mapInArrow(_training_rows(layouts, seed), "label double, x array<double>")
    rows = materialize(rows, "html-training").select("label", array_to_vector("x").alias("features"))
    rows = rows.coalesce(4).persist()  # a bounded sample; lost parts are read again from the table
    model = GBTClassifier(maxIter=trees, maxDepth=depth, maxBins=32, stepSize=0.4, subsamplingRate=0.7,
                          featureSubsetStrategy="0.5", seed=seed, checkpointInterval=-1).fit(rows)
    rows.unpersist()
    return exported(model)


# ---------------------------------------------------------------- extraction

def extract(page: str | None, trees: Trees) -> str:
    if not page:
        return ""
    dom = parse(page)
    if not any(dom.text):
        return ""
    return main_text(dom, decode(dom, trees.probability(features([dom]))))


def _extract_batch(pages: list[str | None], trees: Trees) -> Iterator[str]:
    """Texts of several pages; the trees are applied to the nodes of all at once."""
    doms = [parse(p or "") for p in pages]
    p = trees.probability(features(doms)) if doms else np.zeros(0)
    at = 0
    for d in doms:
        n = len(d.tag)
        yield main_text(d, decode(d, p[at:at + n])) if any(d.text) else ""
        at += n


def extract_main_text(pages: DataFrame, trees: Trees) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    ship_code(pages.sparkSession)
    held = pages.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            while at < b.num_rows:  # about a million characters at a time
                group, chars = [], 0
                while at + len(group) < b.num_rows and chars < 1_000_000:
                    group.append(b.column(2)[at + len(group)].as_py())
                    chars += len(group[-1] or "")
                text = list(_extract_batch(group, held.value))
                part = b.slice(at, len(group))
                at += len(group)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(text, pa.string()), pa.array(list(map(len, text)), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
