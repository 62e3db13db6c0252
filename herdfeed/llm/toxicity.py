"""Toxicity (operator 9): a linear classifier over character n-grams whose features are scaled
by naive Bayes log-count ratios, trained on labelled text.

Features are the n-grams a text holds at all, hashed to ``2 ** BITS`` columns. The log ratio of
a feature's document counts in both classes scales it; ratios within ``MIN_SIGMA`` standard
errors of zero are noise and count 0 (of the others, the clearest ``MAX_FEATURES`` stay). These
counts are over all labelled rows. Logistic regression on the scaled rows, cut to unit length,
gives the weights. It is fitted on at most ``SAMPLE`` labelled rows of each class (see
:func:`~herdfeed.llm.linear.sampled_labels`), weighed so that the classes count as in all labelled
rows; every whole text is scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import PARTIAL_COUNTS, partial_counts, share, shared, sum_counts
from .linear import SparseRows, class_weights, distinct, grams, labelled_texts, letters, minimise, sampled_labels, texts_of_labels, usable_labels

BITS = 20
SIZES = (3, 4, 5, 6)
SAMPLE = 2000
SMOOTHING = 2.0
MIN_SIGMA = 3.0
MAX_FEATURES = 60_000
POSITIVE_WEIGHT = 2.0
THRESHOLD = 0.7


@dataclass
class Model:
    """``column`` holds the kept features; ``scale`` their log ratios, ``weight`` the linear
    weights, in the same order. No kept feature means a constant score."""

    column: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self.place = np.full(1 << BITS, -1, np.int32)
        self.place[self.column] = np.arange(len(self.column))
        self.scratch = np.zeros(len(self.column), np.int32)

    def rows(self, text: str | None) -> np.ndarray:
        """Positions (in ``column``) of the text's kept features, each once."""
        found = self.place[grams(letters(text), SIZES, BITS)]
        return distinct(found[found >= 0], self.scratch)

    def score(self, text: str | None) -> float:
        at = self.rows(text)
        x = self.scale[at]
        margin = self.bias + float(self.weight[at] @ x) / max(1.0, float(np.sqrt(x @ x)))
        return float(1 / (1 + np.exp(-np.clip(margin, -40, 40))))


def _ratios(counts: np.ndarray, sizes: tuple[int, int]) -> Model:
    """Log ratios of document counts ``counts[class, column]`` among ``sizes[class]`` documents."""
    share_of = np.array(sizes) / sum(sizes)
    smooth = counts + SMOOTHING * share_of[:, None]
    ratio = np.log(smooth[1] / (sizes[1] + SMOOTHING)) - np.log(smooth[0] / (sizes[0] + SMOOTHING))
    spread = np.sqrt((1 / smooth).sum(axis=0))
    column = np.flatnonzero(np.abs(ratio) >= MIN_SIGMA * spread)
    # The clearest ratios, if there are more than the fit has room for.
    column = np.sort(column[np.argsort(-np.abs(ratio[column]) / spread[column], kind="stable")[:MAX_FEATURES]])
    return Model(column, ratio[column], np.zeros(len(column)), 0.0)


def train(docs: DataFrame, labels: DataFrame, keep: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Model:
    """Fit on the labelled rows whose ``doc_id`` passes ``keep``: document counts behind the log
    ratios over all of them, the linear weights on a sample. NULL texts count as empty; ids without
    a label or with labels that disagree are left out; of a sampled id's repeated rows one is learnt
    from, the counts take each row; other columns are not read. Without rows of both classes the
    model scores 0 for every text."""
    usable = usable_labels(labels, "doc_id", label_col, keep)
    learnt = texts_of_labels(docs, usable, id_col, text_col)

    def count(batches):
        total, scratch = np.zeros((2, (1 << BITS) + 1), np.int64), np.zeros(1 << BITS, np.int32)
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[label, distinct(grams(letters(text), SIZES, BITS), scratch)] += 1
                total[label, -1] += 1
        yield from partial_counts(total.ravel())

    # The join's tasks: as many as a shuffle has, or a few more where Spark splits one.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = sum_counts(learnt.mapInArrow(count, PARTIAL_COUNTS), tasks, 2 * ((1 << BITS) + 1)).reshape(2, -1)
    sizes = (int(counts[0, -1]), int(counts[1, -1]))
    if not all(sizes):
        return Model(np.zeros(0, np.int64), np.zeros(0), np.zeros(0), -np.inf)
    chosen = sampled_labels(labels, "doc_id", label_col, keep, SAMPLE)
    weights = class_weights(labels, "doc_id", label_col, keep, SAMPLE)
    sample = labelled_texts(docs, chosen, id_col, text_col).select("label", "text")
    model = _ratios(counts[:, :-1], sizes)
    handle = share(docs.sparkSession, model)

    def reduce(batches):
        own = shared(handle)
        for batch in batches:
            found = [own.rows(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32()))], names=["label", "found"])

    rows = sample.mapInArrow(reduce, "label int, found array<int>").toArrow()
    label = rows["label"].to_numpy()
    found = rows["found"].combine_chunks()
    column = found.flatten().to_numpy()
    bounds = np.concatenate(([0], np.cumsum(found.value_lengths().to_numpy(), dtype=np.int64)))
    value = model.scale[column].astype(np.float32)
    length = np.sqrt(np.diff(np.concatenate(([0.0], np.cumsum(value.astype(np.float64) ** 2)))[bounds]))
    value /= np.repeat(np.maximum(1.0, length), np.diff(bounds)).astype(np.float32)
    x, y = SparseRows.flat(bounds, column, value, len(model.column)), np.where(label == 1, 1.0, -1.0)
    del rows, found, column, value
    weight = weights[label]
    importance = np.where(y > 0, POSITIVE_WEIGHT, 1.0) * weight / weight.sum()

    def gradient(w):
        slope = -y * importance / (1 + np.exp(np.clip(y * (x.dot(w[:-1]) + w[-1]), -40, 40)))
        return np.concatenate((x.back(slope) + 1e-5 * w[:-1], [slope.sum()]))

    w = minimise(gradient, len(model.column) + 1, 200, 0.1)
    return Model(model.column, model.scale, w[:-1], float(w[-1]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, score, predicted)`` of each row; NULL and empty texts have no feature and get
    the model's base rate. Repeated rows each give a row; other columns are not read."""
    handle = share(docs.sparkSession, model)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def judge(batches):
        own = shared(handle)
        for batch in batches:
            scores = np.array([own.score(text) for text in batch.column(1).to_pylist()], float)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"doc_id {kind}, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``; all columns unchanged."""
    handle = share(docs.sparkSession, model)
    at = docs.columns.index(text_col)

    def judge(batches):
        own = shared(handle)
        for batch in batches:
            yield batch.filter(pa.array([own.score(text) < threshold for text in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(judge, docs.schema)
