"""Quality classifier: histogram gradient-boosted trees over document statistics.

Training reads at most ``train_limit`` labelled rows (documented bound, see
``labelled.py``), computes their statistics in Spark tasks and fits the trees
with numpy: features are cut into at most ``bins`` quantile bins, a tree grows
level by level from gradient histograms per (node, feature, bin), and the loss
is logistic. The trees are flattened into arrays (feature, threshold, left,
right, value), and scoring walks all rows of a batch through all trees at
once, one vectorised step per level.

A score needs nothing but the text. Defined results: a null or empty text is
scored from its all-zero statistics; repeated rows and ids give repeated rows;
an empty table gives an empty result; with no labelled rows, or labels of one
class only, every score is the (smoothed) share of label 1. Extra columns of
the input are kept by ``score_quality`` unless they are named like its result
columns, which replace them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .docstats import FEATURES, document_features
from .labelled import held_out, training_texts
from .textarrays import slices, utf8

TRAIN_LIMIT = 20_000
THRESHOLD = 0.3


@dataclass(frozen=True)
class Forest:
    """Trees of one depth-first array each; a leaf points to itself."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int

    def margins(self, x: np.ndarray) -> np.ndarray:
        if len(self.roots) == 0 or len(x) == 0:
            return np.full(len(x), self.base)
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            below = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(below, self.left[at], self.right[at])
        return self.base + self.value[at].sum(1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def fit_forest(x: np.ndarray, y: np.ndarray, *, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
               ridge: float = 1.0, least: int = 10, base_bounds: tuple[float, float] = (0.01, 0.99)) -> Forest:
    """Second-order boosting of ``y`` in {0, 1} on the rows of ``x``."""
    share = float(np.clip((y.sum() + 1) / (len(y) + 2), *base_bounds))
    base = float(np.log(share / (1 - share)))
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    if len(y) and 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
        margin = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            roots.append(len(nodes))
            margin += _grow(binned, cuts, p - y, p * (1 - p), nodes, depth, rate, bins, ridge, least)
    columns = list(zip(*nodes, strict=True)) if nodes else [[]] * 5
    as_ints = lambda v: np.array(v, np.int64)
    return Forest(base, as_ints(columns[0]), np.array(columns[1], float), as_ints(columns[2]), as_ints(columns[3]),
                  np.array(columns[4], float), as_ints(roots), depth)


def _grow(binned, cuts, g, h, nodes, depth, rate, bins, ridge, least) -> np.ndarray:
    """Append one tree to ``nodes``; its contribution to every training row."""
    n, width = binned.shape
    nodes.append([0, 0.0, len(nodes), len(nodes), 0.0])
    level = [len(nodes) - 1]
    slot = np.zeros(n, np.int64)  # place of a row's node within the level, -1 once in a leaf
    where = np.full(n, level[0])
    for step in range(depth + 1):
        live = slot >= 0
        k = len(level)
        if not live.any() or k == 0:
            break
        totals = [np.bincount(slot[live], w[live], k) for w in (g, h)]
        for i, node in enumerate(level):
            nodes[node][4] = -rate * totals[0][i] / (totals[1][i] + ridge)
        if step == depth:
            break
        key = ((slot[live][:, None] * width + np.arange(width)) * bins + binned[live]).ravel()
        sums = [np.bincount(key, np.repeat(w[live], width), k * width * bins).reshape(k, width, bins).cumsum(2)
                for w in (g, h, np.ones(n))]
        gl, hl, cl = (s[:, :, :-1] for s in sums)
        gt, ht, ct = (s[:, :, -1:] for s in sums)
        gain = gl**2 / (hl + ridge) + (gt - gl)**2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
        gain[(cl < least) | (ct - cl < least)] = 0
        best = gain.reshape(k, -1).argmax(1)
        following: list[int] = []
        next_slot = np.full(n, -1)
        for i, node in enumerate(level):
            f, b = divmod(int(best[i]), bins - 1)
            if gain[i, f, b] <= 1e-9:
                continue
            mine = np.flatnonzero(slot == i)
            low = binned[mine, f] <= b
            left, right = len(nodes), len(nodes) + 1
            nodes[node][:4] = [f, float(cuts[f][b]), left, right]
            for child, rows in ((left, mine[low]), (right, mine[~low])):
                nodes.append([0, 0.0, child, child, 0.0])
                next_slot[rows] = len(following)
                where[rows] = child
                following.append(child)
        slot, level = next_slot, following
    return np.array([node[4] for node in nodes])[where]


def _features_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            x = document_features(*utf8(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))],
                ["label", "x"])


def train_quality(docs: DataFrame, labels: DataFrame, *, label: str = "quality", train_limit: int = TRAIN_LIMIT) -> Forest:
    """Fit the classifier on at most ``train_limit`` labelled rows; about 200
    bytes a row reach the driver."""
    rows = training_texts(docs, labels, label, train_limit).mapInArrow(_features_task, "label int, x array<double>").toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    y = rows["label"].to_numpy(float)
    order = np.lexsort([*x.T, y])  # the fit doesn't depend on the order in which rows arrive
    return fit_forest(x[order], y[order])


def score_quality(df: DataFrame, model: Forest, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``score`` (probability of label 1) and ``predicted``."""
    kept = [c for c in df.columns if c not in ("score", "predicted")]
    kept_df = df.select(*[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*kept_df.schema.fields, T.StructField("score", T.DoubleType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                score = model.scores(document_features(*utf8(part.column(text_col))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], [*part.schema.names, "score"])

    return kept_df.mapInArrow(task, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train and score: ``doc_id, held_out, score, predicted`` per document."""
    model = train_quality(docs, labels)
    return (score_quality(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"))
